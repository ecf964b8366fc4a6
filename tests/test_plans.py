"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from martlens.catalog.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["mta_touchpoints", "mta_touchpoints_customer", "attr_summary", "mta_journeys", "geo_targeting"])
def test_no_pairwise_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_orders_meet_their_day_by_one_equi_join(spark, sf_dir):
    """The band condition is gone; whether the day table is broadcast is Spark's choice by its measured size."""
    for name in ("mta_touchpoints", "attr_linear"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert re.search(r"(SortMerge|BroadcastHash|ShuffledHash)Join \[order_date#\d+\], \[order_date#\d+\], Inner", text), name


def test_no_python_in_the_plans(spark, sf_dir):
    for name, query in QUERIES.items():
        if name != "forecast_pandas" and not name.startswith(("stream_", "daily_revenue_incremental")):
            text = plan(query(spark, sf_dir))
            assert "Python" not in text and "InPandas" not in text, name


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["daily_weather"](spark, sf_dir))
    assert "EqualTo(event_type,error)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in text
    wide = plan(QUERIES["daily_revenue"](spark, sf_dir))
    assert "l_tax" not in wide and "l_shipdate" not in wide and "part.parquet" not in wide


def test_review_scores_need_no_shuffle_beyond_the_input_split(spark, sf_dir):
    text = plan(QUERIES["review_extract"](spark, sf_dir))
    assert "hashpartitioning" not in text


def test_top_terms_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["channel_themes"](spark, sf_dir))
    assert "WindowGroupLimit" in text and text.count("Partial") >= 1
