"""Ordered refresh, counted deltas, events delivered twice, compaction, as-of joins."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from functools import partial

import pytest

from frames import cost, frame, order
from martlens.catalog import queries
from martlens.functions.money import cents
from martlens.operators import asof, enrich, kpi, mmm
from martlens.plans.semantic import LazyTables
from martlens.plans.upkeep import file_mark, refresh_stale, row_mark
from martlens.streaming import deltas, events


def _same(a, b):
    return Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


# -- ordered refresh ---------------------------------------------------------------------------------------------------
def _tables(orders, spend):
    makers = {
        "orders": lambda: orders, "spend": lambda: spend,
        "daily_revenue": lambda: kpi.daily_revenue(t["orders"]), "spend_daily": lambda: kpi.spend_daily(t["spend"]),
        "mmm_weighted": lambda: mmm.mmm_weighted(t["spend_daily"], t["daily_revenue"]),
        "mmm_weekly": lambda: mmm.mmm_weekly(t["mmm_weighted"]), "product_revenue": lambda: kpi.product_revenue(t["orders"]),
    }
    t = LazyTables(makers)
    return t


TARGETS = ["mmm_weekly", "product_revenue", "daily_revenue", "spend_daily"]


def _folders(root):
    return {n: {p.name for p in (root / n).iterdir()} for n in TARGETS}


def test_refresh_rewrites_stale_tables_in_order_and_no_others(spark, tmp_path):
    orders = frame(spark, "orders", [order(k, f"2026-01-0{1 + k % 7}", 10.0 + k) for k in range(20)])
    spend = frame(spark, "marketing_spend", [cost(k, 1, f"2026-01-0{1 + k % 7}") for k in range(10)])
    first = refresh_stale(spark, _tables(orders, spend), TARGETS, str(tmp_path))
    assert sorted(first) == sorted(TARGETS) and first.index("mmm_weekly") > max(first.index("daily_revenue"), first.index("spend_daily"))
    before = _folders(tmp_path)
    assert refresh_stale(spark, _tables(orders.repartition(3), spend), TARGETS, str(tmp_path)) == []
    assert _folders(tmp_path) == before

    more = orders.unionByName(frame(spark, "orders", [order(99, "2026-01-03", 50.0)]))
    now = _tables(more, spend)
    assert set(refresh_stale(spark, now, TARGETS, str(tmp_path))) == {"daily_revenue", "product_revenue", "mmm_weekly"}
    after = _folders(tmp_path)
    assert {n for n in TARGETS if after[n] != before[n]} == {"daily_revenue", "product_revenue", "mmm_weekly"}
    assert all(len(v) == 1 for v in after.values())  # old versions are gone
    plain = _tables(more, spend)
    assert all(_same(now[n], plain[n]) for n in TARGETS)


def test_same_rows_stop_the_refresh(spark, tmp_path):
    """An order that changes in a column nobody reads changes its table's mark and no stored table."""
    rows = [order(k, "2026-01-02", 10.0) for k in range(5)]
    spend = frame(spark, "marketing_spend", [cost(1, 1, "2026-01-02")])
    refresh_stale(spark, _tables(frame(spark, "orders", rows), spend), TARGETS, str(tmp_path))
    before = _folders(tmp_path)
    moved = frame(spark, "orders", [{**r, "campaign_id": 7} for r in rows])
    assert row_mark(moved) != row_mark(frame(spark, "orders", rows))
    assert refresh_stale(spark, _tables(moved, spend), TARGETS, str(tmp_path)) == []
    assert _folders(tmp_path) == before


def test_changed_definition_and_lost_copy_are_rebuilt(spark, tmp_path):
    orders = frame(spark, "orders", [order(k, "2026-01-02", 10.0) for k in range(5)])
    spend = frame(spark, "marketing_spend", [cost(1, 1, "2026-01-02")])
    refresh_stale(spark, _tables(orders, spend), TARGETS, str(tmp_path))
    other = _tables(orders, spend)
    other._makers["product_revenue"] = lambda: kpi.product_revenue(other["orders"]).where("total_revenue > 1000")
    assert refresh_stale(spark, other, TARGETS, str(tmp_path)) == ["product_revenue"]
    for copy in (tmp_path / "spend_daily").iterdir():
        (copy / "_SUCCESS").unlink()
    assert "spend_daily" in refresh_stale(spark, other, TARGETS, str(tmp_path))


def test_files_are_marked_without_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    mark = file_mark(spark.read.parquet(path))
    assert mark == file_mark(spark.read.parquet(path)) != file_mark(spark.read.parquet(path).where("id > 1"))
    spark.range(5).write.mode("append").parquet(path)
    assert mark != file_mark(spark.read.parquet(path))
    assert file_mark(spark.read.parquet(path).unionByName(spark.createDataFrame([(1,)], "id long"))) is None


# -- counted deltas ----------------------------------------------------------------------------------------------------
UPKEEP = deltas.Upkeep(keys=("customer_id",), values=("order_date", "product_category"), sums={"_revenue": partial(cents, "revenue")},
                       result=enrich.customer_history, buckets=8)


def _history(spark, path):
    return {r.customer_id: tuple(r)[1:] for r in deltas.read_result(spark, path, queries.CUSTOMER_COLUMNS).collect()}


def test_withdrawn_rows_take_their_values_back(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [order(1, "2026-01-01", 5.0, customer=1, category="a"), order(2, "2026-01-05", 7.0, customer=1, category="b"),
            order(3, "2026-01-05", 7.0, customer=1, category="b"), order(4, "2026-01-09", 1.0, customer=2, category=None)]
    deltas.apply_changes(UPKEEP, UPKEEP.counted(frame(spark, "orders", rows)), path, 0)
    d = dt.date
    assert _history(spark, path) == {1: (3, 19.0, d(2026, 1, 1), d(2026, 1, 5), 2, "b"), 2: (1, 1.0, d(2026, 1, 9), d(2026, 1, 9), 0, None)}
    gone = frame(spark, "orders", [rows[0], rows[2], rows[3]])
    new = frame(spark, "orders", [order(3, "2026-01-04", 7.5, customer=1, category="a")])
    changes = UPKEEP.counted(gone, -1).unionByName(UPKEEP.counted(new))
    touched = deltas.apply_changes(UPKEEP, changes, path, 1)
    want = {1: (2, 14.5, d(2026, 1, 4), d(2026, 1, 5), 2, "a")}
    assert _history(spark, path) == want and len(touched) <= 2
    deltas.apply_changes(UPKEEP, changes, path, 1)  # a repeated run replaces itself
    assert _history(spark, path) == want
    deltas.compact(UPKEEP, spark, path)
    assert [p.name for p in (tmp_path / "s" / "state").iterdir()] == ["run=000000000001-m"]
    again = frame(spark, "orders", [order(9, "2026-02-01", 1.0, customer=1, category="c")])
    deltas.apply_changes(UPKEEP, UPKEEP.counted(again), path, 2)
    assert _history(spark, path) == {1: (3, 15.5, d(2026, 1, 4), d(2026, 2, 1), 3, "a")}


def test_only_touched_buckets_are_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [order(k, "2026-01-01", 5.0, customer=k) for k in range(60)]
    deltas.apply_changes(UPKEEP, UPKEEP.counted(frame(spark, "orders", rows)), path, 0)
    files = {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "s" / "result").glob("_bucket=*")}
    touched = deltas.apply_changes(UPKEEP, UPKEEP.counted(frame(spark, "orders", [order(99, "2026-01-02", 1.0, customer=3)])), path, 1)
    now = {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "s" / "result").glob("_bucket=*")}
    assert len(touched) == 1 and {n for n in files if files[n] != now[n]} == {f"_bucket={touched[0]}"}


def test_a_row_that_never_came_cannot_leave(spark, tmp_path):
    path = str(tmp_path / "s")
    with pytest.raises(Exception, match="withdrawn"):
        deltas.apply_changes(UPKEEP, UPKEEP.counted(frame(spark, "orders", [order(1, "2026-01-01")]), -1), path, 0)


# -- events delivered twice --------------------------------------------------------------------------------------------
FIRST = dt.datetime(2026, 1, 1, 12)


def _write(spark, feed, rows, name):
    spark.createDataFrame([(i, ts, 1, "purchase", 10.0, '{"k": 1}') for i, ts in rows], events.EVENTS).coalesce(1).write.parquet(f"{feed}/{name}")


def _days(spark, path):
    return {r.order_date: (r.order_count, r.total_revenue) for r in
            events.merged(spark, path, events.daily_revenue_windows, events.added(events.DAILY_SUMS)).collect()}


def test_events_count_once_however_late_and_compaction_keeps_the_result(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "table")
    sums = events.added(events.DAILY_SUMS)

    def run():
        events.accumulate(events.read_stream(spark, f"{feed}/*"), events.daily_revenue_windows, path, str(tmp_path / "state"))

    _write(spark, feed, [(1, FIRST), (1, FIRST), (None, FIRST), (None, FIRST)], "a")
    run()
    assert _days(spark, path) == {FIRST.date(): (3, 30.0)}  # events without an id cannot be told apart
    _write(spark, feed, [(k, FIRST + dt.timedelta(days=k)) for k in range(2, 9)], "b")
    run()
    _write(spark, feed, [(1, FIRST), (10, FIRST), (8, FIRST + dt.timedelta(days=8))], "c")  # far behind any watermark
    run()
    want = {FIRST.date(): (4, 40.0), **{(FIRST + dt.timedelta(days=k)).date(): (1, 10.0) for k in range(2, 9)}}
    assert _days(spark, path) == want
    assert len(list((tmp_path / "table").iterdir())) == 3
    events.compact(spark, path, events.daily_revenue_windows, sums)
    assert _days(spark, path) == want
    assert [p.name for p in (tmp_path / "table").iterdir()] == ["batch=2m"] == [p.name for p in (tmp_path / "table-ids").iterdir()]
    _write(spark, feed, [(10, FIRST), (11, FIRST)], "d")  # a run after a restart goes on
    run()
    assert _days(spark, path) == want | {FIRST.date(): (5, 50.0)}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """A batch that fails after its ledger was written is done again with the same result."""
    ledger = str(tmp_path / "table-ids")
    batch = spark.createDataFrame([(k, FIRST, 1, "purchase", 10.0, '{"k": 1}') for k in (1, 2, 2)], events.EVENTS)
    for _ in range(2):
        assert events._new_events(batch, 0, ledger).count() == 2
    assert events._new_events(batch, 1, ledger).count() == 0


def test_keyed_state_drops_repeats_within_the_watermark(spark, tmp_path):
    feed = str(tmp_path / "feed")
    _write(spark, feed, [(1, FIRST), (2, FIRST)], "a")
    _write(spark, feed, [(1, FIRST), (3, FIRST + dt.timedelta(hours=1))], "b")
    stream = events.once(events.read_stream(spark, f"{feed}/*", files_per_batch=1))
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


# -- as-of joins -------------------------------------------------------------------------------------------------------
def test_as_of_join_equals_a_search(spark):
    rng = random.Random(6)
    keys = ["hot"] * 20 + ["a", "b", "unseen", None]
    day = dt.date(2026, 1, 1)
    left = [(k, rng.choice(keys), day + dt.timedelta(days=rng.randrange(90)) if rng.random() > 0.05 else None) for k in range(400)]
    right = [(rng.choice([k for k in keys if k != "unseen"]), day + dt.timedelta(days=rng.randrange(0, 90, 4)) if rng.random() > 0.05 else None, v, None if v % 5 == 0 else "x")
             for v in range(120)]
    got = asof.as_of_join(
        spark.createDataFrame(left, "id long, key string, at date"),
        spark.createDataFrame(right, "key string, known_at date, v long, w string"), ["key"], "at", "known_at", slice_days=7)
    want = []
    for i, key, at in left:
        fits = [(t, v, w or "") for k, t, v, w in right if None not in (key, at, t) and k == key and t <= at]
        t, v, w = max(fits, default=(None, None, None))
        want.append((i, key, at, t, v, w or None))
    assert sorted(map(tuple, got.collect())) == sorted(want, key=lambda r: r[0])


def test_as_of_join_compares_no_ranges(spark, sf_dir):
    for name in ("orders_as_of_spend", "purchases_as_of_touch"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "_slice" in plan


def test_as_of_join_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", dt.date(2026, 1, 1))], "id long, key string, at date")
    right = spark.createDataFrame([], "key string, known_at date, v long")
    assert [tuple(r) for r in asof.as_of_join(left, right, ["key"], "at", "known_at").collect()] == [(1, "a", dt.date(2026, 1, 1), None, None)]
    assert asof.as_of_join(left.where("false"), right, ["key"], "at", "known_at").count() == 0
