"""Incremental pulls by watermark. The census runs in scheduled batches: each run reads what
changed since the last success and then moves the watermark, or lands the files that arrived since."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censusmart.operators.keys import first_per_key
from censusmart.sources.schemas import schema
from censusmart.sources.warehouse import Warehouse

WATERMARK = "dw_audit.etl_watermark"


def last_success(watermarks: DataFrame, source: str) -> Column:
    """The source's watermark as a scalar subquery; NULL when it never ran."""
    return watermarks.filter(F.col("source_name") == source).agg(F.max("last_success_ts")).scalar()


def incremental(df: DataFrame, ts_col: str, watermark: Column) -> DataFrame:
    """Rows changed at or after the watermark; without one, all rows.

    Pass a literal to let the comparison reach the file scan as a pushed filter.
    """
    return df.filter(watermark.isNull() | (F.col(ts_col) >= watermark))


def advance(watermarks: DataFrame, source: str, reached: DataFrame, ts_col: str, run_id: int) -> DataFrame:
    """The watermark table after a successful run that read ``reached``; never moves backwards."""
    fresh = reached.agg(F.max(ts_col).cast("timestamp").alias("last_success_ts")).filter(
        "last_success_ts is not null"
    ).select(F.lit(source).alias("source_name"), "last_success_ts", F.lit(run_id).alias("last_run_id"))
    both = watermarks.select(fresh.columns).unionByName(fresh)
    newest = F.max(F.struct("last_success_ts", "last_run_id"))
    return both.groupBy("source_name").agg(newest.alias("n")).select("source_name", "n.*")


def pull_files(
    store: Warehouse, folder: str, table: str, keys: Sequence[str], ts_col: str, source: str, run_id: int,
    files_per_batch: int | None = None,
) -> int:
    """Land the files that arrived in ``folder`` since the last pull in ``table``, every key once; the number of batches.

    The files hold rows of the table's declared schema. The stream's checkpoint below the warehouse's root remembers which
    were read, so none is listed by time: a late file with old rows is pulled, and rows with the watermark's own time are not
    read again. A batch lands rows with unseen keys only (of a key repeated within it, the newest row; equal times by
    the row's hash), then moves the watermark, which never goes back. So a pull that dies anywhere, between the two as well,
    repeats its batch without loss or repeats. ``files_per_batch`` bounds a batch after a long pause.
    """
    declared = schema(table)
    stream = store.spark.readStream.schema(declared).option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    landed = []

    def land(batch: DataFrame, number: int) -> None:
        order = [F.col(ts_col).desc_nulls_last(), F.xxhash64(*declared.names)]
        store.load_absent(table, first_per_key(batch, keys, order), keys)
        store.refresh(WATERMARK, advance(store[WATERMARK], source, batch, ts_col, run_id))
        landed.append(number)

    query = (
        stream.parquet(folder).writeStream.foreachBatch(land).trigger(availableNow=True)
        .option("checkpointLocation", f"{store.root}/_pulls/{source}").start()
    )
    query.awaitTermination()
    return len(landed)
