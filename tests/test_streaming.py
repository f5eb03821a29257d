"""Pulls of arrived files into the warehouse."""

from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from censusmart.sources.schemas import schema
from censusmart.sources.warehouse import Warehouse
from censusmart.streaming.incremental import WATERMARK, pull_files

TABLE = "dw_audit.etl_error_log"


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"))


@pytest.fixture
def arrive(spark, tmp_path):
    """Writes ``(error_id, day)`` rows as one more file of the folder."""
    def write(*rows_):
        data = [(i, None, None, None, f"{i} at {day}", None, day and datetime(2024, 1, day)) for i, day in rows_]
        spark.createDataFrame(data, schema(TABLE)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return write


def pull(store, tmp_path, run_id, **options):
    return pull_files(store, str(tmp_path / "in"), TABLE, ["error_id", "logged_at"], "logged_at", "errors", run_id, **options)


def mark(store):
    return store[WATERMARK].select(F.dayofmonth("last_success_ts"), "last_run_id").collect()


def landed(store):
    return sorted((r.error_id, r.logged_at.day) for r in store[TABLE].collect())


def test_every_row_lands_once(store, arrive, tmp_path):
    arrive((1, 5), (2, 6), (2, 6))
    assert pull(store, tmp_path, 1) == 1
    assert landed(store) == [(1, 5), (2, 6)] and mark(store) == [(6, 1)]
    assert pull(store, tmp_path, 2) == 0 and mark(store) == [(6, 1)]
    # A late file with old rows, a row with the watermark's own time, a row that came before, a changed row.
    arrive((3, 2), (4, 6), (1, 5))
    arrive((1, 9))
    assert pull(store, tmp_path, 3, files_per_batch=1) == 2
    assert landed(store) == [(1, 5), (1, 9), (2, 6), (3, 2), (4, 6)] and mark(store) == [(9, 3)]
    arrive((5, 1))
    assert pull(Warehouse(store.spark, store.root), tmp_path, 4) == 1
    again = Warehouse(store.spark, store.root)
    assert (5, 1) in landed(again) and mark(again)[0][0] == 9


def test_a_pull_that_dies_between_write_and_watermark_is_repeated(store, arrive, tmp_path, monkeypatch):
    arrive((1, 5))
    pull(store, tmp_path, 1)
    arrive((2, 6), (3, 7))
    dying = Warehouse(store.spark, store.root)
    whole = dying.refresh

    def refresh(table, *rest):
        if table == WATERMARK:
            raise RuntimeError("lost")
        return whole(table, *rest)

    monkeypatch.setattr(dying, "refresh", refresh)
    with pytest.raises(StreamingQueryException):
        pull(dying, tmp_path, 2)
    between = Warehouse(store.spark, store.root)
    assert landed(between) == [(1, 5), (2, 6), (3, 7)] and mark(between) == [(5, 1)]
    arrive((4, 8))
    pull(between, tmp_path, 3)
    assert landed(between) == [(1, 5), (2, 6), (3, 7), (4, 8)] and mark(between) == [(8, 3)]


def test_a_pull_that_dies_before_the_write_loses_nothing(store, arrive, tmp_path, monkeypatch):
    arrive((1, 5))
    dying = Warehouse(store.spark, store.root)
    monkeypatch.setattr(dying, "load_absent", lambda *rest: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(StreamingQueryException):
        pull(dying, tmp_path, 1)
    again = Warehouse(store.spark, store.root)
    assert not again.exists(TABLE)
    pull(again, tmp_path, 2)
    assert landed(again) == [(1, 5)] and mark(again) == [(5, 2)]
