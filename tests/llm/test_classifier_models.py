"""The trained models against plain versions, and their data against its bounds."""

import math
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from censusmart.llm import labelled, quality_classifier, toxicity

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(900_001, None), (900_002, ""), (900_003, "a"), (900_004, "Word (word) word!")], "doc_id long, text string")
    return docs.unionByName(extra).cache(), spark.read.parquet(f"{SF}/labels.parquet")


def in_order(docs, labels, label):
    """(label, text) of all rows to learn from, by the hash of their ids."""
    hashed = docs.join(labels.select("doc_id", F.col(label).alias("y")), "doc_id").withColumn("h", F.xxhash64("doc_id")).collect()
    return [(int(r.y), r.text or "") for r in sorted(hashed, key=lambda r: r.h) if zlib.crc32(str(r.doc_id).encode()) % 5]


def plain_places(text):
    """Places of words, neighbours and words with one between, in whole numbers."""
    hashes = [xxhash.xxh64_intdigest(w.strip(b".,;:!?\"'()[]{}<>#*$%&|")) for w in text.lower().encode().split()]
    m = [int(x) for x in toxicity._MIX]
    grams = [h * m[0] for h in hashes] + [a * m[1] + b * m[2] for a, b in zip(hashes, hashes[1:])] + [
        a * m[3] + b * m[4] for a, b in zip(hashes, hashes[2:])]
    return {((((g & MASK) ^ (g & MASK) >> 29) * m[0]) & MASK) >> 44 for g in grams}


def test_weights_equal_plain_ftrl(given):
    docs, labels = given
    rows = [(y, plain_places(t)) for y, t in in_order(docs, labels, "toxic")]
    share = sum(y for y, _ in rows) / len(rows)
    z, n, bias = {}, {}, 1 << 20

    def weight(i):
        own, l1 = z.get(i, 0.0), 0.0 if i == bias else toxicity.L1
        if abs(own) <= l1:
            return 0.0
        return -(own - math.copysign(l1, own)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.PASSES):
        for y, places in rows:
            own = {i: weight(i) for i in [*sorted(places), bias]}
            score = 1 / (1 + math.exp(-min(30, max(-30, sum(own.values())))))
            g = max(1.0, (1 / share - 1 if y else share / (1 - share))) ** 0.5 * (score - y)
            for i, w in own.items():
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / toxicity.ALPHA * w
                n[i] = before + g * g
    plain = {i: weight(i) for i in z if weight(i)}
    model = toxicity.train(docs, labels)
    assert 0 < len(plain) and model.keys() == plain.keys()
    assert all(abs(model[i] - w) < 1e-6 * max(1, abs(w)) for i, w in plain.items())

    # Scores of all rows by the plain weights.
    for r in toxicity.score_documents(docs, model).join(docs, "doc_id").collect():
        total = plain.get(bias, 0.0) + sum(plain.get(i, 0.0) for i in plain_places(r.text or ""))
        assert abs(r.score - 1 / (1 + math.exp(-min(30, max(-30, total))))) < 1e-4


def test_scores_equal_plain_compression(given):
    docs, labels = given
    model = quality_classifier.train(docs, labels)
    rows = [(y, t.encode()) for y, t in in_order(docs, labels, "quality")]
    for label, content in ((1, model.good), (0, model.bad)):
        assert content == quality_classifier.dictionary([t for y, t in rows if y == label][::2])

    def size(text, content):
        total = 0
        for at in range(0, len(text), 2048):
            data = zstandard.ZstdCompressionDict(content)
            data.precompute_compress(level=1)
            pack = zstandard.ZstdCompressor(level=1, dict_data=data, write_content_size=False, write_dict_id=False, write_checksum=False)
            total += len(pack.compress(text[at:at + 2048]))
        return total

    a, b, c = model.curve
    for r in quality_classifier.score_documents(docs, model).join(docs, "doc_id").collect():
        text = (r.text or "").encode()
        good, bad = size(text, model.good), size(text, model.bad)
        x = a * (bad - good) / (bad + good) + b * good / len(text) + c if text else c
        assert abs(r.score - 1 / (1 + math.exp(-min(30, max(-30, x))))) < 1e-9 and r.predicted == (r.score >= 0.3)


def test_training_data_of_a_text_is_bounded_and_spread():
    text = b"".join(b"%07d " % i for i in range(700_000))
    kept = quality_classifier.spread(text)
    assert len(kept) == quality_classifier.TRAIN_BYTES and kept.startswith(b"0000000 ")
    assert int(kept[-2048:][:7]) > 600_000 and quality_classifier.spread(text[:9000]) == text[:9000]
    places = toxicity.learned_places(np.arange(1_000_000, 0, -1))
    assert len(places) == toxicity.TRAIN_PLACES and places[0] == 1 and places[-1] > 990_000
    assert toxicity.learned_places(np.array([3, 1, 3])).tolist() == [1, 3]


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality_classifier, "quality")])
def test_odd_rows_and_columns(spark, given, module, label):
    """Empty tables, ids and labels that are null or repeat, texts of 5 MB, and columns with names that the operator uses."""
    docs, labels = given
    names = ["label", "place", "data", "held_out", "score", "predicted", "_id", label]
    wide = docs.unionByName(spark.createDataFrame([(None, "x"), (900_003, "a"), (900_009, "good words here. " * 300_000)], "doc_id long, text string"))
    for n in names:
        wide = wide.withColumn(n, F.lit("other"))
    more = labels.unionByName(labels.limit(3)).unionByName(labels.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    more = more.unionByName(labels.limit(2).withColumn(label, F.lit(None).cast(labels.schema[label].dataType)))
    got = module.score_documents(wide, module.train(wide, more)).collect()
    assert len(got) == wide.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id == 900_003} == {next(r.score for r in got if r.doc_id == 900_003)}
    assert module.score_documents(wide.limit(0), module.train(wide.limit(0), labels)).count() == 0
    assert list(labelled.training_sample(docs, labels, label, 7, lambda: str.encode).columns) == ["label", "data"]
    assert labelled.training_sample(docs, labels, label, 7, lambda: str.encode).count() == 7
