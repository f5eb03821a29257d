"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from censusmart.llm import spelling


def brute_words(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def brute(docs):
    counts = brute_words(docs)
    around = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(around[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def corpus():
    rng, docs = random.Random(4), []
    vocabulary = ["".join(rng.choice(["th", "an", "er", "in", "é", "ß", "ou", "z"]) for _ in range(rng.randrange(2, 6))) for _ in range(150)]
    vocabulary += ["aaaaa", "aaaaaa", "aaaab", "baaaa", "abcde", "edcba", "abcdé", "×÷×÷×", "x" * 3000, "x" * 2999 + "y"]
    for i in range(160):
        words = [rng.choice(vocabulary) for _ in range(60)]
        for k in rng.sample(range(60), 8):
            w = words[k]
            at = rng.randrange(len(w))
            words[k] = rng.choice([w[:at] + w[at + 1:], w[:at] + "q" + w[at:], w[:at] + "é" + w[at + 1:]])
        docs.append((i, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words)))
    docs.append((902, "helloxx " * 3 + "hellox " * 7 + "hello " * 20))
    docs += [(7, "Abcde-abcde4abcde"), (None, "abcde漢abcdé Ωabcde"), (900, None), (901, ""), (903, "..."), (7, "Abcde-abcde4abcde")]
    return docs


def test_variants_equal_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id long, text string, n int, word string").repartition(5)
    got = sorted(tuple(r) for r in spelling.spelling_variants(frame).select("word", "form", "root", "n", "n_near", "form_n").collect())
    expected = brute(docs)
    assert got == expected
    assert any(r[1] and r[2] != r[1] for r in expected) and sum(r[1] is not None for r in expected) > 20


def test_many_flushes_and_small_partings_change_nothing(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(spelling, "FLUSH_WORDS", 1)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.word: r.n for r in spelling.word_counts(frame).where("n >= 3").collect()} == brute_words(docs)


def test_words_one_edit_apart_share_a_signature():
    rng = random.Random(9)
    for _ in range(300):
        word = bytes(rng.choice(b"abcdefg\xe9") for _ in range(rng.randrange(5, 14)))
        at = rng.randrange(len(word))
        other = word[:at] + bytes([rng.choice(b"abcxyz\xe9\xff")]) + word[at + 1:]
        shorter = word[:at] + word[at + 1:]
        own, changed = spelling.signatures([word, other], 6, 2, np.array([len(word)] * 2))
        assert (own == changed).any()
        longer, less = spelling.signatures([word, shorter], 5, 1, np.array([len(word)] * 2))
        assert (longer == less).any()


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(empty).count() == 0
    same = spark.createDataFrame([(1, "alpha alphb " * 200_000)], "doc_id long, text string")
    assert sorted(tuple(r) for r in spelling.spelling_variants(same).collect()) == [("alpha", None, "alpha", 200_000, 1, None), ("alphb", None, "alphb", 200_000, 1, None)]
