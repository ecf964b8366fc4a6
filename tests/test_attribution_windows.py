"""Credits of all models for long look-backs, against exact fractions; factors of the what-if."""

from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from frames import campaign, cost, frame, order
from martlens.operators import attribution as attr
from martlens.operators import spine

START = dt.date(2026, 1, 1)


def _day(k):
    return (START + dt.timedelta(days=k)).isoformat()


def _half_up(x: Fraction, digits: int) -> float:
    sign = -1 if x < 0 else 1
    scaled = abs(x) * 10**digits
    return sign * ((2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)) / 10**digits


@pytest.mark.parametrize("window", [7, 30, 42, 60, 90, 365])
def test_credits_of_every_model_are_exact(spark, window):
    rng = random.Random(window)
    names = ["email", "search", "social", "video", "radio", "print", "partner", "affiliate"]
    campaigns = frame(spark, "campaigns", [campaign(k, sub_channel=n) for k, n in enumerate(names)])
    spent = [(k, rng.randrange(400)) for k in range(len(names)) for _ in range(6)]
    spend = frame(spark, "marketing_spend", [cost(i, k, _day(d)) for i, (k, d) in enumerate(spent)])
    placed = [(i, rng.randrange(400), rng.choice([0.01, 0.05, 19.99, -12.35, 100_100.0, 7.77])) for i in range(60)]
    orders = frame(spark, "orders", [order(i, _day(d), revenue) for i, d, revenue in placed])
    rows = {(r.conversion_id, r.sub_channel, r.model_name): (r.attributed_revenue, r.attribution_weight)
            for r in attr.credits(attr.conversions_with_touches(orders, spend, campaigns, window)).collect()}
    n_rows = 0
    for i, day, revenue in placed:
        first = {}
        for k, d in spent:
            if day - window <= d <= day:
                first[names[k]] = min(first.get(names[k], d), d)
        ordered = sorted(first, key=lambda n: (first[n], n))
        n, cents = len(ordered), Fraction(round(revenue * 100), 100)
        total = sum(Fraction(1, day - d + 1) for d in first.values())
        for seq, name in enumerate(ordered, 1):
            decay = Fraction(1, day - first[name] + 1) / total
            edge = Fraction(1) if n == 1 else Fraction(1, 2) if n == 2 else Fraction(2, 5) if seq in (1, n) else Fraction(1, 5) / (n - 2)
            for model, share in {"first_touch": Fraction(seq == 1), "last_touch": Fraction(seq == n), "linear": Fraction(1, n),
                                 "time_decay": decay, "position_based": edge}.items():
                assert rows[i, name, model] == (_half_up(cents * share, 2), _half_up(share, 4)), (model, share)
                n_rows += 1
    assert n_rows == len(rows)


def test_decay_is_worked_out_for_time_decay_alone(spark):
    orders = frame(spark, "orders", [order(1, _day(3))])
    touched = attr.conversions_with_touches(orders, frame(spark, "marketing_spend", [cost(1, 1, _day(1))]), frame(spark, "campaigns", [campaign(1)]), 365)
    for frame_, has in ((attr.attribution(touched, "linear"), False), (attr.attribution(touched, "time_decay"), True), (touched, False)):
        assert ("_decay" in frame_._jdf.queryExecution().optimizedPlan().toString()) is has


def test_what_if_multiplies_exactly_and_rounds_once(spark):
    rows = [order(1, "2026-01-20", 100_100.0, channel="DTC", category="outerwear"), order(2, "2026-03-01", -0.5, channel="DTC", category="tents"),
            order(3, "2026-03-01", None, channel="wholesale", category="tents")]
    got = spine.revenue_what_if(frame(spark, "orders", rows), {1: 1.15, 3: 0.333}, [("DTC", "2026-01-20", "2026-01-22", 1.25)], {"outerwear": 1.1}).collect()
    paid = {(r.product_category, r.channel): r.adjusted_revenue for r in got}
    exact = Decimal("100100") * Decimal("1.15") * Decimal("1.25") * Decimal("1.1")
    assert paid["outerwear", "DTC"] == 158_283.13 == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert paid["tents", "DTC"] == -0.17 and paid["tents", "wholesale"] is None
    plain = spine.revenue_what_if(frame(spark, "orders", rows), {}, [], {}).collect()
    assert all(r.adjusted_revenue == r.revenue for r in plain)
