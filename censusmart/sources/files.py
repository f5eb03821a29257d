"""Reads from source systems: declared schemas, pruned columns, counted rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """A CSV extract in which the empty text is NULL."""
    return spark.read.csv(path, schema=schema, header=header, nullValue="", emptyValue="")


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per row; unreadable documents stay as rows with ``_corrupt_record`` set."""
    with_reject = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(with_reject).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def parse_json_rows(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Rows kept as JSON text (``row_to_json``) back to columns, rejects marked like above.

    A reader fails the whole document on a type error; here too any bad field rejects the row.
    """
    with_reject = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        column, with_reject, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return df.select(parsed.alias("r")).select("r.*")


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows without the marker, rejected rows)``."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull())


def copy_counts(df: DataFrame) -> DataFrame:
    """One row: how many rows of a marked frame were copied and skipped."""
    bad = F.col(CORRUPT).isNotNull()
    return df.agg(F.count_if(~bad).alias("copied"), F.count_if(bad).alias("skipped"))


def read_jdbc(
    spark: SparkSession, url: str, table: str, columns: Sequence[str],
    split: Mapping[str, str | int] | None = None, properties: Mapping[str, str] | None = None,
    fetch_rows: int = 100_000,
) -> DataFrame:
    """A source table over JDBC, read in parallel when ``split`` gives a partition column.

    ``split`` holds partitionColumn, lowerBound, upperBound and numPartitions. Column pruning and
    filters reach the database.
    """
    options = {"url": url, "dbtable": table, "fetchsize": fetch_rows, **(split or {}), **(properties or {})}
    return spark.read.format("jdbc").options(**options).load().select(*columns)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               batch_rows: int = 10_000) -> None:
    """Append to a database table in batches, one connection per task."""
    options = {"url": url, "dbtable": table, "batchsize": batch_rows, **(properties or {})}
    df.write.format("jdbc").mode("append").options(**options).save()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; missing ones become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of the given schema, known to the optimizer as such."""
    nothing = spark.range(1).filter(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
