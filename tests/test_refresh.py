"""Incremental refresh, stored tables and streams."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from frames import frame, order
from martlens.catalog.queries import tables
from martlens.operators.kpi import daily_revenue
from martlens.plans.tables import refresh
from martlens.sources.schemas import BASE_TABLES, read_base
from martlens.sources.store import append_rows, new_table_path, shared_folder, write_snapshot
from martlens.streaming import events
from martlens.streaming.refresh import initial_load, merge_partials, read_daily, refresh_days


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_only_touched_days_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "daily")
    old = frame(spark, "orders", [order(1, "2026-01-01"), order(2, "2026-01-02")])
    initial_load(old, path)
    kept = {p.name for p in (tmp_path / "daily" / "order_date=2026-01-01").glob("*.parquet")}
    new = frame(spark, "orders", [order(3, "2026-01-02", 4.0), order(4, "2026-01-03", 6.0)])
    both = old.unionByName(new)
    refresh_days(both, new, path)
    assert _same(read_daily(spark, path), daily_revenue(both))
    assert {p.name for p in (tmp_path / "daily" / "order_date=2026-01-01").glob("*.parquet")} == kept


def test_merged_partials_equal_recomputation(spark):
    a = frame(spark, "orders", [order(i, "2026-01-01", 1.01 * i) for i in range(1, 8)])
    b = frame(spark, "orders", [order(i, "2026-01-01", 2.02 * i) for i in range(8, 12)] + [order(99, "2026-01-05")])
    assert _same(merge_partials(daily_revenue(a), daily_revenue(b)), daily_revenue(a.unionByName(b)))


def test_refresh_stores_targets_in_order(spark, sf_dir, tmp_path):
    t = refresh(spark, tables(spark, sf_dir), ["spend_daily", "daily_revenue", "mmm_weighted"], str(tmp_path))
    stored = t["mmm_contributions"]
    assert str(tmp_path) in stored._jdf.queryExecution().optimizedPlan().toString() or stored.inputFiles()[0].startswith(
        f"file://{tmp_path}")
    assert _same(stored, tables(spark, sf_dir)["mmm_contributions"])


def test_base_table_round_trip_and_append(spark, tmp_path):
    rows = frame(spark, "orders", [order(1, "2026-01-01")])
    write_snapshot(rows, str(tmp_path / "orders"))
    append_rows(frame(spark, "orders", [order(2, "2026-01-02")]), str(tmp_path / "orders"))
    back = read_base(spark, str(tmp_path), "orders")
    assert back.count() == 2 and [f.name for f in back.schema] == [f.name for f in BASE_TABLES["orders"]]


def test_shared_folder_is_one_place(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert new_table_path(spark, "x") != new_table_path(spark, "x")


def _write_events(spark, folder, rows, name):
    data = [(i, ts, 1, "purchase", 10.0, '{"k": 1}') for i, ts in rows]
    spark.createDataFrame(data, events.EVENTS).coalesce(1).write.parquet(f"{folder}/{name}")


def test_late_event_is_dropped_by_the_stream(spark, tmp_path):
    first = dt.datetime(2026, 1, 1, 12)
    feed = str(tmp_path / "feed")
    _write_events(spark, feed, [(i, first + dt.timedelta(days=i)) for i in range(10)], "a")
    # the watermark that a batch raises judges rows from the batch after the next one on
    _write_events(spark, feed, [(40, first + dt.timedelta(days=10))], "b")
    _write_events(spark, feed, [(50, first + dt.timedelta(hours=1)), (51, first + dt.timedelta(days=20))], "c")
    for n, part in enumerate("abc"):  # files are read in the order of their time stamps
        for f in (tmp_path / "feed" / part).glob("*.parquet"):
            os.utime(f, (1_700_000_000 + n * 1000,) * 2)
    stream = events.read_stream(spark, f"{feed}/*", files_per_batch=1)
    events.run_to_table(events.daily_revenue_windows(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    out = spark.read.parquet(str(tmp_path / "out"))
    days = {r.order_date: r.order_count for r in out.collect()}
    assert days[dt.date(2026, 1, 1)] == 1  # the late second event of that day is gone
    assert dt.date(2026, 1, 21) not in days  # its window is still open


def test_accumulated_windows_are_whole(spark, sf_dir):
    whole = events.whole_daily_revenue(spark, f"{sf_dir}/events.parquet*")
    batch = events.daily_revenue_windows(spark.read.schema(events.EVENTS).parquet(f"{sf_dir}/events.parquet"))
    assert _same(whole, batch)


def test_every_file_of_a_feed_counts_and_a_second_run_goes_on(spark, tmp_path):
    first = dt.datetime(2026, 1, 1, 12)
    feed, path, state = (str(tmp_path / n) for n in ("feed", "table", "state"))
    _write_events(spark, feed, [(i, first + dt.timedelta(days=i)) for i in range(10)], "a")
    _write_events(spark, feed, [(100 + i, first + dt.timedelta(days=i)) for i in range(10)], "b")  # an id counts once
    assert events.whole_daily_revenue(spark, f"{feed}/*", path, state).agg(F.sum("order_count")).first()[0] == 20
    _write_events(spark, feed, [(99, first)], "c")  # later than any watermark would allow
    whole = events.whole_daily_revenue(spark, f"{feed}/*", path, state)
    days = {r.order_date: (r.order_count, r.total_revenue) for r in whole.collect()}
    assert days[dt.date(2026, 1, 1)] == (3, 30.0)
    newest = max(tmp_path.joinpath("table").iterdir(), key=lambda p: int(p.name.removeprefix("batch=")))
    assert spark.read.parquet(str(newest)).agg(F.sum("order_count")).first()[0] == 1  # only the new file was read


def test_emptied_day_loses_its_partition(spark, tmp_path):
    path = str(tmp_path / "daily")
    old = frame(spark, "orders", [order(1, "2026-01-01"), order(2, "2026-01-02")])
    initial_load(old, path)
    moved = frame(spark, "orders", [order(1, "2026-01-01"), order(2, "2026-01-03")])
    refresh_days(moved, old.where("order_id = 2").unionByName(moved.where("order_id = 2")), path)
    assert _same(read_daily(spark, path), daily_revenue(moved))


@pytest.mark.parametrize("days", [1, 7])
def test_window_functions_work_on_a_batch(spark, sf_dir, days):
    batch = spark.read.schema(events.EVENTS).parquet(f"{sf_dir}/events.parquet*")
    rows = events.weekly_spend_windows(batch) if days == 7 else events.daily_revenue_windows(batch)
    n = rows.agg(F.sum("n" if days == 7 else "order_count")).first()[0]
    kinds = ["view", "click", "signup"] if days == 7 else ["purchase"]
    assert n == days * batch.where(F.col("event_type").isin(kinds)).count()
