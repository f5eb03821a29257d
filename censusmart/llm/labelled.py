"""Which rows a classifier may learn from, and the bounded sample it takes of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no model learns from (a null id counts as the text null)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % FOLDS == 0


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, reduced: Callable[[], Callable[[str], bytes]],
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(label, data): at most ``rows`` labelled documents outside the held-out fold, in one partition.

    The sample is that of the smallest hashes of the ids, so it does not depend on order. Only its ids and labels (at most
    16 bytes times ``rows``) are broadcast; the texts are filtered where they are read, and ``reduced()``, a function made in
    each task, takes what a model learns from out of each whole text there. It must return a bounded number of bytes, which
    bounds the partition. Rows without a label or id are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take = reduced()
        for batch in batches:
            data = pa.array([take(t.as_py()) for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data], names=["place", "label", "data"])

    chosen = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
              .where(F.col("_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("_id")))
              .withColumn("place", F.xxhash64("_id")).orderBy("place", "_id", "label").limit(rows))
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    taken = texts.join(F.broadcast(chosen), "_id").select("place", "label", "text").mapInArrow(run, "place long, label int, data binary")
    return taken.repartition(1).sortWithinPartitions("place", "label", "data").select("label", "data")
