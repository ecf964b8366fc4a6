"""Robust bounds: planted training days, new series, ranks, against a plain version."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from martlens.operators import robust, series

START = dt.date(2025, 1, 1)
CUTOFF = START + dt.timedelta(days=240)


def _value(i, factor=1.0):
    noise = ((i * 7919) % 101) / 101 - 0.5
    weekend = 80 if (START + dt.timedelta(days=i)).weekday() >= 5 else 0
    return (1000 + 60 * noise + weekend + 0.5 * i) * factor


def _frame(spark, rows):
    return spark.createDataFrame(
        [(name, START + dt.timedelta(days=i), None if v is None else float(v)) for name, i, v in rows], "series string, ds date, y double")


def _plain(values):
    """The same fit in numpy: (expected over all days, residuals of the training days)."""
    n, t = 240, np.arange(len(values), dtype=float)
    day = np.array([(START + dt.timedelta(days=i)).weekday() for i in range(len(values))])
    y = np.asarray(values[:n], dtype=float)

    def base(held):
        slope = np.cov(t[:n], held, bias=True)[0, 1] / np.var(t[:n])
        line = held.mean() + slope * (t - t[:n].mean())
        effect = np.array([(held - line[:n])[day[:n] == d].mean() for d in range(7)])
        return line + effect[day]

    def at(sample, rank):
        return np.sort(sample)[int(np.ceil(rank * len(sample) - 1e-9)) - 1]

    fitted = base(y)
    for _ in range(robust.ROUNDS):
        left = y - fitted[:n]
        far = robust.REACH * (at(left, 0.75) - at(left, 0.25)) / robust.QUARTILE_SPAN
        centre = fitted[:n] + at(left, 0.5)
        fitted = base(np.clip(y, centre - far, centre + far))
    return fitted, y - fitted[:n], at


def test_equal_to_a_plain_version(spark):
    values = [_value(i, 9.0 if 100 <= i < 107 else 1.0) for i in range(300)]
    rows = robust.detect_robust(_frame(spark, [("s", i, v) for i, v in enumerate(values)]), "m", CUTOFF).orderBy("ts").collect()
    fitted, left, at = _plain(values)
    half = series.Z_SCORES[0.99] * (at(left, 0.75) - at(left, 0.25)) / robust.QUARTILE_SPAN
    assert len(rows) == 60
    for r, i in zip(rows, range(240, 300), strict=True):
        middle = fitted[i] + at(left, 0.5)
        assert [r.forecast, r.lower_bound, r.upper_bound] == pytest.approx([middle, middle - half, middle + half], abs=0.02)
        assert abs(r.percentile - (left <= values[i] - fitted[i]).mean()) <= 0.002 + 1 / 240


def test_planted_training_week_does_not_widen_the_bounds(spark):
    def bounds(detect, factor):
        rows = _frame(spark, [("s", i, _value(i, factor if 100 <= i < 107 else 1.0)) for i in range(300)])
        return [r.upper_bound - r.lower_bound for r in detect(rows, "m", CUTOFF).orderBy("ts").collect()]

    clean, planted = bounds(robust.detect_robust, 1.0), bounds(robust.detect_robust, 9.0)
    assert max(planted) < 1.15 * max(clean)
    assert max(bounds(series.detect_anomalies, 9.0)) > 5 * max(clean)


def test_every_later_series_has_rows(spark):
    known = [(n, i, _value(i)) for n in "ab" for i in range(300)]
    new = [("new", i, 5000.0) for i in (250, 252)] + [("usual", i, _value(120)) for i in range(260, 300)]
    rows = robust.detect_robust(_frame(spark, known + new), "m", CUTOFF)
    by = {k: [r for r in rows.collect() if r.series == k] for k in ("a", "b", "new", "usual")}
    assert [len(by[k]) for k in ("a", "b", "new", "usual")] == [60, 60, 50, 40]
    first = min(by["new"], key=lambda r: r.ts)
    assert first.judged_by == "all series" and first.is_anomaly and first.percentile == 1.0
    assert not any(r.is_anomaly for r in by["usual"])
    assert {r.judged_by for r in by["a"]} == {"own past"}
    plain = series.detect_anomalies(_frame(spark, known + new), "m", CUTOFF).where("series = 'new'").collect()
    assert [(r.y, r.forecast, r.lower_bound, r.percentile, r.is_anomaly) for r in plain] == [(5000.0, None, None, None, False)] * 2


def test_without_a_past_or_without_later_days(spark):
    rows = robust.detect_robust(_frame(spark, [("s", 250, 3.0), ("s", 251, 4.0)]), "m", CUTOFF).collect()
    assert [(r.y, r.forecast, r.is_anomaly, r.judged_by) for r in rows] == [(3.0, None, False, "nothing"), (4.0, None, False, "nothing")]
    assert robust.detect_robust(_frame(spark, [("s", i, 1.0) for i in range(20)]), "m", CUTOFF).count() == 0
    assert robust.detect_robust(_frame(spark, []), "m", CUTOFF).count() == 0


def test_constant_series_and_null_values(spark):
    rows = [("c", i, 7.0) for i in range(250)] + [("c", 250, 8.0), ("n", 10, None), ("n", 245, None)]
    out = robust.detect_robust(_frame(spark, rows), "m", CUTOFF, fill_gaps=False).where("series = 'c'").orderBy("ts").collect()
    assert [r.is_anomaly for r in out] == [False] * 10 + [True]
    assert out[0].lower_bound == out[0].upper_bound == 7.0
