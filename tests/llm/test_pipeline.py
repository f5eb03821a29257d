"""The whole pipeline over odd documents, and its result against the files' tokens counted plainly."""

import zlib

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from censusmart.llm import quality_rules

SF = "/root/testdata/sf0.001"
CLASH = ["matches", "_range", "size", "key", "words", "passes", "partition", "fingerprint", "kept", "_row"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The given documents with copies, passages of the benchmark, null values, repeated rows, a text of 3 MB and clashing columns."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    good = quality_rules.clean_documents(docs).orderBy("doc_id").limit(6).collect()
    texts = [r.text for r in docs.where(F.col("doc_id").isin([r.doc_id for r in good])).orderBy("doc_id").collect()]
    ids = [r.doc_id for r in good]
    passage = benchmark.where("text is not null").orderBy(F.length("text").desc()).first().text
    giant = " ".join(f"Sentence {i} tells of {i * 7919 % 10007} and {i * 104729 % 99991} things." + ("\n" if i % 9 == 0 else "") for i in range(60_000))
    rows = [(90_001, texts[0]), (90_002, texts[0]), (90_003, texts[1] + "\n\n" + passage), (90_004, None), (90_005, ""), (90_006, giant),
            (None, texts[2]), (90_007, " \n "), (90_007, " \n ")]
    extra = spark.createDataFrame([(i, t, None if i == 90_006 else "hot") for i, t in rows], "doc_id long, text string, source string")
    wide = docs.unionByName(extra.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)), allowMissingColumns=True)
    for name in CLASH:
        wide = wide.withColumn(name, F.lit("other"))
    folder = str(tmp_path_factory.mktemp("planted"))
    wide.write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    return folder, ids


def test_planted_documents(spark, planted, monkeypatch):
    folder, ids = planted
    kept = {}
    whole = corpus_pipeline.saved

    def watched(df, name):
        kept[name] = whole(df, name)
        return kept[name]

    monkeypatch.setattr(corpus_pipeline, "saved", watched)
    got = corpus_pipeline.run(spark, folder).collect()
    given = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == list(kept)
    assert all(kept[n].columns == given.columns for n in list(kept)[:-1])
    at = {n: {r.doc_id for r in kept[n].select("doc_id").collect()} for n in kept}
    assert {90_001, 90_002, 90_003, 90_006, *ids} <= at["quality_rules"] and not at["quality_rules"] & {90_004, 90_005, 90_007}
    assert not at["simhash_near_dedup"] & {90_001, 90_002} and {90_003, 90_006} <= at["simhash_near_dedup"]
    assert at["simhash_near_dedup"] - at["decontamination"] >= {90_003} and 90_006 in at["decontamination"]
    assert at["mixing"] <= at["decontamination"] and at["token_files"] == at["mixing"]

    # The rows of the files, by the library: one per mixed document, in order of id, each with its end id.
    tokenizer = tokenizers.Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    want = []
    for r in kept["mixing"].select("doc_id", "text").collect():
        tokens = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((r.doc_id, len(tokens), zlib.crc32(tokens.tobytes())))
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((i or -1, n, c) for i, n, c in want)
    upto = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == upto
        upto += r.n_tokens
    known = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert known == sorted(known)


def test_an_empty_corpus(spark, planted, tmp_path):
    folder, _ = planted
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
