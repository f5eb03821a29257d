"""SimHash groups against brute force."""

import random

import pytest

from censusmart.llm import components, simhash


def brute_components(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_self_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200), (-5, 300)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute_components([l for l in links if l[0] != l[1]], {n for l in links for n in l})
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def words(rng, n):
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()) + str(rng.randrange(40)) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng, docs = random.Random(3), []
    for i in range(60):
        base = words(rng, 120)
        docs.append((len(docs), " ".join(base)))
        for _ in range(i % 3):
            near = list(base)
            near[rng.randrange(120)] = "changed"
            docs.append((len(docs), " ".join(near)))
    text = docs[0][1]
    docs += [(900, text), (901, text), (901, text), (None, text), (902, None), (903, ""), (904, "  \n"), (905, "two words"), (906, "Two  WORDS")]
    return docs


def test_fingerprint_components_equal_brute_force(spark, corpus):
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in
                 simhash.fingerprint_components(spark.createDataFrame(corpus, "doc_id long, text string")).collect())
    prints = [simhash.simhash(simhash.shingles_of(simhash.words_of((t or "").encode()), 3)) for _, t in corpus]
    links = [(a, b) for a in set(prints) for b in set(prints) if a < b and (a ^ b).bit_count() <= 2]
    root = brute_components(links, set(prints))
    first = {}
    for (i, _), p in zip(corpus, prints):
        if i is not None:
            first[root[p]] = min(i, first.get(root[p], i))
    assert got == sorted((str(i), f"{p:016x}", first[root[p]]) for (i, _), p in zip(corpus, prints))
    assert prints[-5] == prints[-4] == 0 and prints[-1] == prints[-2]


def test_fingerprint_is_a_majority_of_xxh64():
    import xxhash
    one = xxhash.xxh64_intdigest(b"a b c", 42)
    assert simhash.simhash([b"a b c"]) == one and simhash.simhash([]) == 0
    assert simhash.simhash([b"a b c", b"b c d"]) == one & xxhash.xxh64_intdigest(b"b c d", 42)


def brute_kept(corpus):
    """The (id, text) of the row that stays of each component: smallest id, null last."""
    prints = [simhash.simhash(simhash.shingles_of(simhash.words_of((t or "").encode()), 3)) for _, t in corpus]
    root = brute_components([(a, b) for a in set(prints) for b in set(prints) if a < b and (a ^ b).bit_count() <= 2], set(prints))
    first = {}
    for (i, _), p in zip(corpus, prints):
        key = (i is None, i)
        first[root[p]] = min(key, first.get(root[p], key), key=lambda k: (k[0], k[1] or 0))
    return sorted((str(i) for _, i in first.values()))


def test_one_document_of_each_component_stays(spark, corpus):
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in corpus], "doc_id long, text string, _h1 string, fp int, _stay_h1 int").repartition(5)
    kept = simhash.without_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == brute_kept(corpus)


def test_one_row_stays_of_many_equal_ones(spark):
    rows = [(None, "same text of all")] * 300 + [(5, "same text of all")] * 300 + [(5, "other words stand here")] * 20 + [(None, None), (None, "")]
    kept = simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == [("5", "other words stand here"), ("5", "same text of all"), ("None", "")]


def test_long_texts(spark):
    text = "alpha beta gamma delta " * 250_000
    rows = [(2, text), (1, text), (3, "x" * 5_000_000)]
    assert sorted(r.doc_id for r in simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [1, 3]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.fingerprint_components(empty).count() == 0 and simhash.without_near_duplicates(empty).count() == 0
