"""Intermediate tables and binary files in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder's name below ``spark.checkpoint.dir``, or below the warehouse where that setting is absent; executors share both."""
    shared = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
              or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: a cut in the lineage that
    survives lost executors and gives the planner the table's real size."""
    spark = df.sparkSession
    folder = work_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def write_files(segments: DataFrame, name: str) -> str:
    """Write each row of a one-column binary frame as one file of its own; returns the folder.

    Spark's text sink does the writing, so that files reach any store that Spark can write and a
    retried task leaves no half-written file. The sink ends each row with the line separator, here
    an empty Zstandard skippable frame, which readers of the formats skip or ignore.
    """
    folder = work_folder(segments.sparkSession, name)
    column = segments.columns[0]
    (segments.select(F.col(column).cast("string").alias("value")).write
     .option("lineSep", TRAILER.decode("ascii")).option("maxRecordsPerFile", 1).text(folder))
    return folder


# Fixed value: the magic number 0x184D2A50 of a skippable frame, then a length of zero.
TRAILER = b"P*M\x18\x00\x00\x00\x00"


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder as rows of (path, content)."""
    return (spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
            .load(folder).where(F.col("length") > 0).select("path", "content"))
