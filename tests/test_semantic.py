"""Rules of the metric layer."""

from __future__ import annotations

import pytest

from frames import campaign, cost, frame, order
from martlens.plans.models import MARKETING, MODELS
from martlens.plans.semantic import LazyTables


@pytest.fixture()
def small(spark):
    campaigns = frame(spark, "campaigns", [campaign(1, "email"), campaign(2, "social"), campaign(3, "search")])
    orders = frame(spark, "orders", [
        order(1, "2026-01-01", 10.0, campaign=1), order(2, "2026-01-01", 20.0, campaign=1), order(3, "2026-01-02", 5.0, campaign=3),
        order(4, "2026-01-02", 7.0, campaign=99)])
    spend = frame(spark, "marketing_spend", [
        cost(1, 1, "2026-01-01", 4.0), cost(2, 1, "2026-01-02", 6.0), cost(3, 2, "2026-01-01", 1.0, impressions=0, clicks=0)])
    tiers = spark.createDataFrame(
        [(1, "c1", "DTC", "email", 3.0, "Top Performer")],
        "campaign_id long, campaign_name string, channel string, sub_channel string, roas double, performance_tier string")
    return {"campaigns": campaigns, "orders": orders, "spend": spend, "campaign_tiers": tiers}


def test_two_facts_do_not_multiply(small):
    rows = MARKETING.query(small, dimensions=["campaigns.sub_channel"],
                           metrics=["orders.total_revenue", "orders.total_orders", "spend.total_spend", "spend.ctr"])
    got = {r.sub_channel: tuple(r)[1:] for r in rows.collect()}
    assert got["email"] == (30.0, 2, 10.0, 10.0)
    assert got["social"] == (None, None, 1.0, 0.0)  # spend only; click rate of nothing is 0
    assert got["search"] == (5.0, 1, None, None)  # orders only
    assert got[None] == (7.0, 1, None, None)  # an order of an unknown campaign is kept


def test_no_dimensions_gives_one_row(small):
    assert tuple(MARKETING.query(small, metrics=["orders.total_revenue", "spend.total_spend"]).first()) == (42.0, 11.0)


def test_shared_parent_path(small):
    rows = MARKETING.query(small, dimensions=["campaign_tiers.performance_tier"], metrics=["orders.total_orders"])
    assert {tuple(r) for r in rows.collect()} == {("Top Performer", 2), (None, 2)}


def test_where_order_limit(small):
    rows = MARKETING.query(
        small, dimensions=["campaigns.sub_channel"], metrics=["orders.total_revenue"],
        where=["campaigns.sub_channel IN ('email', 'search')", "orders.order_date = '2026-01-01' OR orders.revenue < 6"],
        order=["total_revenue desc"], limit=1)
    assert [tuple(r) for r in rows.collect()] == [("email", 30.0)]


def test_equal_dimension_names_are_qualified(small):
    rows = MARKETING.query(small, dimensions=["orders.channel", "campaigns.channel"], metrics=["orders.total_orders"])
    assert rows.columns == ["orders_channel", "campaigns_channel", "total_orders"]


@pytest.mark.parametrize("request_, message", [
    ({"dimensions": ["orders.channel"], "facts": ["spend.amount"]}, "one entity"),
    ({"dimensions": ["partners.tier"], "metrics": ["spend.total_spend"]}, "no many-to-one path"),
    ({"dimensions": ["orders.nothing"]}, "no dimension"),
    ({"metrics": ["orders.nothing"]}, "no metric"),
    ({"facts": ["orders.revenue"], "metrics": ["orders.total_orders"]}, "together"),
    ({}, "nothing asked"),
])
def test_refused_requests(small, request_, message):
    with pytest.raises(ValueError, match=message):
        MARKETING.query(small, **request_)


@pytest.mark.parametrize("condition", ["month = 3", "orders.order_date > '2026-01-01' AND year > 2025", "day = 1 OR orders.channel = 'DTC'"])
def test_bare_date_words_are_refused(small, condition):
    with pytest.raises(ValueError, match="no field"):
        MARKETING.query(small, dimensions=["orders.channel"], metrics=["orders.total_orders"], where=condition)


def test_interval_units_and_date_functions_are_allowed(small):
    where = "orders.order_date + INTERVAL 1 DAY > DATE '2000-01-01' AND month(orders.order_date) BETWEEN 1 AND 12 AND orders.order_date > DATE '2100-01-01' - INTERVAL '200' YEAR"
    rows = MARKETING.query(small, dimensions=["orders.channel"], metrics=["orders.total_orders"], where=where)
    assert rows.count() == MARKETING.query(small, dimensions=["orders.channel"], metrics=["orders.total_orders"]).count()


def test_key_check_finds_faults(spark, small):
    small = {**small, "campaigns": small["campaigns"].unionByName(small["campaigns"].where("campaign_id = 1"))}
    rows = {(r.check, r.entity): r.violations for r in MARKETING.key_check(small, ["campaigns", "orders"]).collect()}
    assert rows == {("duplicate_key", "campaigns"): 1, ("duplicate_key", "orders"): 0, ("orphan_reference", "orders"): 1}


def test_declared_sizes():
    def size(model):
        m = MODELS[model]
        return (len(m.entities), len(m.relationships), *(sum(len(v) for v in part.values())
                                                         for part in (m.facts, m.dimensions, m.metrics)))

    assert size("marketing") == (11, 8, 25, 28, 6)
    assert size("model_results") == (3, 0, 10, 9, 1)
    assert size("reviews") == (3, 1, 3, 12, 3)
    assert size("advanced") == (11, 1, 28, 32, 9)


def test_lazy_tables_build_only_what_is_used():
    made = []
    t = LazyTables({"a": lambda: made.append("a") or 1, "b": lambda: made.append("b") or t["a"] + 1})
    assert t["b"] == 2 and t["b"] == 2 and made == ["b", "a"]
    assert set(t) == {"a", "b"} and len(t) == 2
