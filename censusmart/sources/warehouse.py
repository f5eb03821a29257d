"""Mart tables as Parquet folders: full refresh to a new folder, append, partition rewrite."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusmart.operators.keys import require_unique
from censusmart.operators.upsert import absent, upsert
from censusmart.sources.files import conform, empty
from censusmart.sources.schemas import schema

BATCH = "__batch"
POINTERS = ("table_name string, seq bigint, folder string, current_col string, past array<string>, partition_col string, "
            "parts array<struct<folder: string, values: array<string>>>")


class Warehouse:
    """Tables under one root folder on storage that all executors share.

    A refresh writes a new folder and then appends one pointer row, so readers see the old or the
    new table and a failed job leaves no trace but an unused folder. A versioned dimension has one
    folder of current rows and a list of folders with expired ones: a merge reads and replaces the
    current rows only, however long the history is. An upserted table lists the folder that holds each of its
    partitions: an upsert writes the touched ones to a new folder, and the pointer row that names it there is
    the switch. Tables have one writer at a time: a pointer that moved since it was read refuses the write. The root defaults to
    the folder the cluster names in ``spark.checkpoint.dir``.

    ``affected`` holds, per table, what the last write did to it, observed while it was written.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        base = root or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise ValueError("give a root folder or set spark.checkpoint.dir")
        self.root = base.rstrip("/")
        self._latest: dict[str, Row] | None = None
        self.affected: dict[str, dict[str, int]] = {}

    def _pointers(self) -> dict[str, Row]:
        """Newest pointer of every table; one small row per table and refresh."""
        if self._latest is None:
            try:
                log = self.spark.read.schema(POINTERS).json(f"{self.root}/_pointers")
                newest = log.groupBy("table_name").agg(F.max_by(F.struct(*log.columns), "seq").alias("p"))
                self._latest = {r.table_name: r.p for r in newest.collect()}
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                self._latest = {}
        return self._latest

    def _stored(self, table: str) -> Row | None:
        """The table's newest pointer as stored now."""
        try:
            log = self.spark.read.schema(POINTERS).json(f"{self.root}/_pointers").filter(F.col("table_name") == table)
            return log.agg(F.max_by(F.struct(*log.columns), "seq").alias("p")).first().p
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _point(self, table: str, folder: str | None, current_col: str | None = None, past: Sequence[str] = (),
               partition_col: str | None = None, parts: Sequence[tuple[str, list[str | None]]] = ()) -> None:
        old, stored = self._pointers().get(table), self._stored(table)
        if (old.seq if old else 0) != (stored.seq if stored else 0):
            raise RuntimeError(f"{table} was written by another job in the meantime")
        row = (table, old.seq + 1 if old else 1, folder, current_col, list(past), partition_col, list(parts))
        df = self.spark.createDataFrame([row], POINTERS)
        df.coalesce(1).write.mode("append").json(f"{self.root}/_pointers")
        self._pointers()[table] = df.first()

    def _write(self, table: str, df: DataFrame, folder: str, partition_by: Sequence[str] = (), mode: str = "error",
               **counts: Column) -> None:
        """Write ``df`` below the root; ``affected`` takes the number of rows and the ``counts``, observed on the way.

        Rows are rebalanced by the partition columns, so that a partition has few files and a hot one several.
        """
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])
        if partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        df.write.mode(mode).partitionBy(*partition_by).parquet(f"{self.root}/{folder}")
        try:
            found = seen.get
        except Py4JJavaError:
            # Spark drops the observation from the plan of a frame that it finds to be empty at run time.
            found = dict.fromkeys(["rows", *counts], 0)
        self.affected[table] = {name: n or 0 for name, n in found.items()}

    def exists(self, table: str) -> bool:
        return table in self._pointers()

    def path(self, table: str) -> str:
        return f"{self.root}/{self._pointers()[table].folder}"

    def read(self, table: str) -> DataFrame:
        """The table, or an empty frame with its declared schema before the first load."""
        declared = schema(table.removesuffix(BATCH))
        if not self.exists(table):
            return empty(self.spark, declared)
        at = self._pointers()[table]
        if at.parts:
            return reduce(DataFrame.unionByName, [
                self.spark.read.schema(declared).parquet(f"{self.root}/{p.folder}").filter(_holds(at.partition_col, p["values"])).select(declared.names)
                for p in at.parts
            ])
        if at.current_col is None:
            return self.spark.read.schema(declared).parquet(self.path(table)).select(declared.names)
        sides = [(True, [at.folder] if at.folder else []), (False, at.past or [])]
        return reduce(DataFrame.unionByName, [
            self._versions(declared, at.current_col, flag, folders) for flag, folders in sides if folders
        ])

    def _versions(self, declared: T.StructType, current_col: str, flag: bool, folders: list[str]) -> DataFrame:
        """Versions of one kind. The flag is a constant, so a filter on it drops the other kind's scan."""
        stored = T.StructType([f for f in declared.fields if f.name != current_col])
        df = self.spark.read.schema(stored).parquet(*[f"{self.root}/{f}" for f in folders])
        return df.withColumn(current_col, F.lit(flag)).select(declared.names)

    def __getitem__(self, table: str) -> DataFrame:
        return self.read(table)

    def refresh(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace the table by ``df`` (which may read the old one)."""
        folder = f"{table}/{uuid.uuid4().hex}"
        self._write(table, conform(df, schema(table.removesuffix(BATCH))), folder, partition_by)
        self._point(table, folder)
        return self.read(table)

    def load_versions(self, table: str, merged: DataFrame, current_col: str, as_of: date) -> DataFrame:
        """Publish a merge of the current rows: what it expired joins the history, the rest replaces
        the current rows. ``merged`` holds no older history.

        The ids that ``as_of`` added are proven unique, among all versions, before the switch.
        """
        old = self._pointers().get(table)
        if old and old.current_col is None:
            merged = merged.unionByName(self.read(table).filter(~F.col(current_col)), allowMissingColumns=True)
        folder = f"{table}/{uuid.uuid4().hex}"
        current, new = F.col(current_col), F.col("effective_date") == F.lit(as_of)
        self._write(table, conform(merged, schema(table)), folder, [current_col], inserted=F.count_if(current & new),
                    expired=F.count_if(~current & (F.col("expiration_date") == F.lit(as_of - timedelta(days=1)))),
                    unchanged=F.count_if(current & ~new))
        written = self.spark.read.parquet(f"{self.root}/{folder}")
        ids = written.select("id")
        past = list(old.past or []) if old else []
        if past:
            ids = ids.unionByName(self.read(table).filter(~F.col(current_col)).select("id"))
        added = written.filter(F.col("effective_date") == F.lit(as_of)).select("id").distinct()
        require_unique(ids.join(added, "id", "left_semi"), ["id"], table)

        flags = {r[0] for r in written.select(F.col(current_col).cast("boolean")).distinct().collect()}
        if False in flags:
            past.append(f"{folder}/{current_col}=false")
        self._point(table, f"{folder}/{current_col}=true" if True in flags else None, current_col, past)
        return self.read(table)

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Add rows to the current folder; nothing already written is read or rewritten."""
        if not self.exists(table):
            return self.refresh(table, df, partition_by)
        if self._pointers()[table].parts:
            raise ValueError(f"{table} is written by upserts")
        self._write(table, conform(df, schema(table)), self._pointers()[table].folder, partition_by, "append")
        return self.read(table)

    def load_absent(
        self, table: str, new: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Append the rows with unseen keys: cost follows the new rows, not the table.

        The batch is written aside first: an append that read its own target while Spark retried
        it could see its own files. Rerunning after a lost job skips what already arrived.
        """
        if not self.exists(table):
            return self.refresh(table, new, partition_by)
        target = self.read(table)
        for column in partition_by:
            # Dynamic pruning: only partitions that the batch touches are scanned for keys.
            target = target.join(new.select(column).distinct(), column, "left_semi")
        return self.append_batch(table, absent(target, new, keys), partition_by)

    def append_batch(self, table: str, batch: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Append rows that were computed from the table itself: they are written aside first."""
        if not self.exists(table):
            return self.refresh(table, batch, partition_by)
        return self.append(table, self.refresh(f"{table}{BATCH}", batch), partition_by)

    def load_upsert(
        self, table: str, new: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
        partition_by: str | None = None,
    ) -> DataFrame:
        """Upsert; with ``partition_by`` only the partitions that ``new`` touches are rewritten.

        The batch is written aside once, and the merged partitions to a new folder. One pointer row then says which folder holds
        which partition: a job that dies before it leaves the table as it was, and can simply be repeated.
        """
        batch = self.refresh(f"{table}{BATCH}", new)
        taken = self.affected[f"{table}{BATCH}"]
        batch = batch.select([c for c in batch.columns if c in new.columns])
        if not partition_by:
            self.refresh(table, upsert(self.read(table), batch, keys, update_cols) if self.exists(table) else batch)
        else:
            values = [r[0] for r in batch.select(F.col(partition_by).cast("string")).distinct().collect()]
            target = self.read(table)
            touched = target.filter(_holds(partition_by, values))
            folder = f"{table}/{uuid.uuid4().hex}"
            self._write(table, conform(upsert(touched, batch, keys, update_cols), schema(table)), folder, [partition_by])
            self._point(table, folder, partition_col=partition_by, parts=[*self._kept(table, partition_by, set(values)), (folder, values)])
        self.affected[table] = {"rows": taken["rows"]}
        return self.read(table)

    def _kept(self, table: str, partition_by: str, replaced: set[str | None]) -> list[tuple[str, list[str | None]]]:
        """The folders of the partitions that an upsert leaves, with what they still hold."""
        if not self.exists(table):
            return []
        at = self._pointers()[table]
        held = [(p.folder, p["values"]) for p in at.parts or []]
        if not held:
            own = self.read(table).select(F.col(partition_by).cast("string")).distinct().collect()
            held = [(at.folder, [r[0] for r in own])]
        left = [(folder, [v for v in values if v not in replaced]) for folder, values in held]
        return [(folder, values) for folder, values in left if values]


def _holds(column: str, values: Sequence[str | None]) -> Column:
    """Whether a partition column has one of the values, given as text; a filter on it prunes folders."""
    known = [v for v in values if v is not None]
    test = F.col(column).cast("string").isin(known) if known else F.lit(False)
    return test | F.col(column).isNull() if None in values else test
