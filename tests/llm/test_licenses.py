"""License scans against brute force over all blocks."""

import random
import re
from fractions import Fraction

import pytest

from censusmart.llm import licenses
from censusmart.llm.licenses import PHRASES, TEMPLATES, Template


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, templates):
    rows = []
    for i, text in docs:
        words, places, base, labels, score = plain_words(text), [], set(), set(), 0.0
        for t in templates:
            own = plain_words(t.text)
            if t.exact:
                at = [k for k in range(len(words)) if words[k:k + len(own)] == own]
                places += at
                if at:
                    base.add(t.label)
                    score = 1.0
                continue
            width = 16
            while width < 2 * len(own):
                width *= 2
            for start in range(0, len(words), width // 2):
                shared = len(set(words[start:start + width]) & set(own))
                if Fraction(shared, len(set(own))) >= Fraction(t.threshold):
                    labels.add(t.label)
                    score = max(score, shared / len(set(own)))
        rows.append((i, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
    return sorted(rows, key=str)


def corpus():
    rng, docs = random.Random(8), []
    filler = "of the and software license copy to any this in rights by all general cc public version 2 3 0 é 漢 under licensed work".split()
    for i in range(150):
        words = [rng.choice(filler) for _ in range(rng.randrange(0, 300))]
        for _ in range(rng.randrange(3)):
            own = plain_words(rng.choice(TEMPLATES).text)
            for k in rng.sample(range(len(own)), rng.choice([0, 0, len(own) // 10, len(own) // 4])):
                own[k] = "other"
            words[rng.randrange(len(words) + 1):0] = own
        docs.append((i, rng.choice([" ", ", ", "\n", "-"]).join(w.upper() if rng.random() < 0.05 else w for w in words)))
    docs += [(1000, None), (1001, ""), (None, "All rights reserved."), (1002, "CC BY cc-by CC.BY, all rights reserved all rights reserved"),
             (1002, "CC BY cc-by CC.BY, all rights reserved all rights reserved"), (1003, "\x00cc\x00by éCC by"), (1004, "GNU general public license v3")]
    return docs


@pytest.mark.parametrize("templates", [TEMPLATES, PHRASES, (Template("same", "a a b c a", "0.5"), Template("one", "rights", "1"), Template("pair", "of of", "1", True))])
def test_scan_equals_brute_force(spark, templates):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, 1, "r", 2) for i, t in docs], "doc_id long, text string, row int, label string, width int").repartition(4)
    got = licenses.scan_documents(frame, templates)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, templates)


def test_small_batches_change_nothing(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(licenses, "FLUSH_IDS", 1)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in licenses.scan_documents(frame).collect()), key=str) == brute(docs, TEMPLATES)


def test_odd_tables_and_templates(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan_documents(empty).count() == 0
    text = "all rights reserved by the MIT License " * 100_000
    row = licenses.scan_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.labels) == (700_000, 100_000, 0, 699_993, "mit,reserved")
    for bad in (Template("x", " "), Template("x", "a " * 300_000)):
        with pytest.raises(ValueError):
            licenses.scan_documents(empty, (bad,))
