"""Collocations against brute force, and the tiles against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from censusmart.llm import collocations


def brute(docs, min_count, absorbed, top):
    count, total = Counter(), Counter()
    for _, lang, text in docs:
        lang = "und" if lang is None else lang
        total[lang] += 0
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in (1, 2, 3, 4):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i:i + k])] += 1
    chosen = {key: a for key, a in count.items() if len(key[1]) > 1 and a >= min_count}
    rows = {}
    for (lang, p), a in chosen.items():
        longer = [b for (other, q), b in chosen.items() if other == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= absorbed * a for b in longer):
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = count[lang, p[:k]], count[lang, p[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r, total[lang]))
    return sorted((lang, rank, phrase.decode(), -a, l, r, n, -score) for lang, found in rows.items()
                  for rank, (score, a, phrase, l, r, n) in enumerate(sorted(found)[:top], 1))


def corpus():
    rng, docs = random.Random(2), []
    vocabulary = [f"w{i}" for i in range(40)] + ["the", "of", "É", "ß漢", "x" * 90, "\x00", "."]
    phrases = [rng.sample(vocabulary[:40], 4) for _ in range(12)] + [["the", "of", "the", "of"], ["É", "ß漢"], ["x" * 90, "w1", "the"]]
    for i in range(150):
        words = []
        for _ in range(25):
            words += rng.choice(phrases) if rng.random() < 0.5 else [rng.choice(vocabulary)]
            if rng.random() < 0.15:
                words[-1] += rng.choice([".", ",", " ;", "!\n", "\r", "\x0b"])
        docs.append((i, rng.choice(["en", "de", None, "und", "e"]), rng.choice([" ", "  ", "\t"]).join(words).replace("the", "The")))
    return docs + [(1, "en", "aa " * 400), (2, "en", None), (3, "xx", ""), (4, None, "a,b"), (4, None, "a,b")]


@pytest.mark.parametrize("head", [1 << 18, 7, 0])
def test_collocations_equal_brute_force(spark, head):
    docs = corpus()
    frame = spark.createDataFrame([(*d, 1, "r") for d in docs], "doc_id long, lang string, text string, n int, row string").repartition(4)
    got = sorted(tuple(r) for r in collocations.collocations(frame, min_count=9, top=60, head=head).collect())
    expected = brute(docs, 9, 80, 60)
    assert got == expected and len({r[0] for r in expected}) >= 4 and any(len(r[2].split()) == 4 for r in expected)


def test_tiles_equal_plain_counting():
    rng = np.random.default_rng(1)
    items, words = (rng.pareto(0.5, 30_000) * 3).astype(np.int64) % 5000, (rng.pareto(0.7, 30_000) * 3).astype(np.int64) % 3000
    expected = Counter(((items << collocations.WORD_BITS) | words).tolist())
    for bits, dense in ((10, 1 << 16), (4, 20), (6, 1), (10, 1)):
        codes, counts = collocations.tile_counts(collocations.tile_keys(items, words, bits), bits, dense)
        assert dict(zip(codes.tolist(), counts.tolist())) == expected and len(codes) == len(expected)
    assert all(len(x) == 0 for x in collocations.tile_counts(np.zeros(0, np.int64)))


def test_small_chunks_change_nothing(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(collocations, "CHUNK_PAIRS", 50)
    monkeypatch.setattr(collocations, "FLUSH_WORDS", 10)
    monkeypatch.setattr(collocations, "SLICE_TEXTS", 3)
    frame = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(frame, min_count=12, top=5).collect()) == brute(docs, 12, 80, 5)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert collocations.collocations(empty).count() == 0
    long = spark.createDataFrame([(1, None, "b c " * 500_000)], "doc_id long, lang string, text string")
    rows = [tuple(r) for r in collocations.collocations(long).orderBy("rank").collect()]
    assert ("und", "b c b c") in {(r[0], r[2]) for r in rows} and all(r[6] == 1_000_000 for r in rows)
