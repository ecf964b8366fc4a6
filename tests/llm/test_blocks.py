"""Blocks of hot groups: every pair across components meets once, no pair of blocks lies in one component."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from martlens.llm import common, minhash


@pytest.mark.parametrize("size", [4, 16, 1024])
def test_block_pairs_hold_each_pair_across_components_once(spark, size):
    rng = random.Random(size)
    rows = [(g, rng.choice([-7, 0, 1, 2, *range(10, 30)]) if g else 5, 1000 * g + k) for g in range(3) for k in range(150)]
    rows += [(9, 1, 1), (9, 2, 2), (-4, 0, 3), (-4, -1, 4)]
    frame = spark.createDataFrame(rows, "bucket long, component long, id long")
    found = common.block_pairs(frame, "bucket", size)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    tasks = defaultdict(list)
    for r in found.collect():
        tasks[(r.bucket, *(r[c] for c in common.PAIR))].append(r)
    met = Counter()
    for members in tasks.values():
        left, right = [r for r in members if r.side != 1], [r for r in members if r.side != 0]
        assert len(members) <= max(6 * size, 12)
        for x in left:
            for y in right:
                if x.component != y.component and (x.side != 2 or x.id < y.id):
                    met[tuple(sorted((x.id, y.id)))] += 1
    want = {tuple(sorted((x[2], y[2]))) for x in rows for y in rows if x[0] == y[0] and x[1] != y[1]}
    assert set(met) == want and set(met.values()) <= {1}
    homes = [set(r.component for r in members) for members in tasks.values() if {r.side for r in members} == {0, 1}]
    assert all(len(h) > 1 for h in homes)  # two blocks of one component never meet


def test_a_group_of_one_component_is_not_moved(spark):
    frame = spark.range(500).selectExpr("1L bucket", "7L component", "id")
    assert common.block_pairs(frame, "bucket", 16).count() == 0


def test_stored_rows_and_layout_give_the_same_pairs(spark, tmp_path):
    frame = spark.range(300).selectExpr("id % 3 bucket", "id % 7 component", "id")
    plain, kept = (common.block_pairs(frame, "bucket", 16, f) for f in (None, str(tmp_path)))
    order = ["bucket", *common.PAIR, "component", "id"]
    assert kept.columns == plain.columns and kept.orderBy(order).collect() == plain.orderBy(order).collect()


def test_near_groups_plans_stay_small(spark, tmp_path, monkeypatch):
    """Plans are kept and announced by the driver at every stage, so a plan of a hundred joins takes its memory."""
    joins, stored = [], common.stored

    def noted(df, path, *args):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return stored(df, path, *args)

    monkeypatch.setattr(common, "stored", noted)
    words = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(k, " ".join([*words[:50 - k], f"own{k}", *words[50 - k:]])) for k in range(20)], "doc_id long, text string")
    assert minhash.near_groups(docs, 80, str(tmp_path / "run")).count() == 20
    assert max(joins) <= 8
