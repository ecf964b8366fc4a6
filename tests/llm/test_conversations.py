"""Prefix trie and repair of conversations against SQL and plain versions, on awkward rows."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest

from compare import compare
from martlens.llm import common, oracle, repair, trie

TURNS = "conv_id long, turn long, role string, text string, p string, level long, a long"


@pytest.fixture(scope="module", autouse=True)
def attached(spark):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        pytest.skip("spark.checkpoint.dir is not set")
    common.attach(spark)


def awkward_rows():
    """Nulls, ties, repeated rows, gaps, shared beginnings, strange roles, a long and a very long turn, a negative id."""
    rng, rows = random.Random(5), []
    shared = [("system", "Be kind."), ("user", "Hello there."), ("assistant", "Hello!"), ("user", "Go on ..."), ("assistant", "Yes?")]
    for conv in range(60):
        turns = list(shared[: rng.randrange(6)])
        turns += [(rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                   rng.choice(["A line.", "No end", " \t\n", "", None, "Ä ß?\n", "x" * 50 + "!"])) for _ in range(rng.randrange(12))]
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
    rows += [(100, k, "user" if k % 2 == 0 else "assistant", f"Turn {k % 50}.") for k in range(130)]
    rows += [(101, k, "user" if k % 2 == 0 else "assistant", f"Turn {k % 50}.") for k in range(90)]
    rows += [(7, 3, "user", "Same turn."), (7, 3, "user", "Same turn."), (7, 3, "assistant", "Same turn."), (8, None, "user", "No turn."), (8, None, None, None)]
    rows += [(-3, 0, "user", "Below zero."), (-4, 5, "assistant", "Gap."), (-4, 9, "user", "Gap.")]
    rows += [(200, 0, "user", "word " * 50_000 + "."), (9_223_372_036_854_775_807, 0, "user", "Last id."), (300, None, None, None)]
    rows += [(None, 0, "user", "Nobody."), (None, None, None, None)]
    return [(*r, "x", 1, 2) for r in rows]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = awkward_rows()
    con = duckdb.connect()
    kinds = {"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()}
    con.register("conversations", pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(kinds.items())}))
    yield spark.createDataFrame(rows, TURNS), con
    con.close()


def test_trie_equals_sql_on_awkward_rows(awkward):
    frame, con = awkward
    assert compare(trie.conversation_trie(frame), con, oracle.ORACLE["op11_trie"]) == []


@pytest.mark.parametrize("block", [1024, 4])
def test_repair_equals_sql_on_awkward_rows(awkward, block, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", block)
    frame, con = awkward
    assert compare(repair.repair_table(frame), con, oracle.ORACLE["op13_repair"]) == []


def test_trie_root_of_turnless_conversations(spark):
    """2 borrows from the absent 0 more turns than it has, so it is left without any."""
    conv = next(c for c in range(1, 500) if c % 5 and trie_borrowed(c) >= 2)
    got = trie.conversation_trie(spark.createDataFrame([(conv, 0, "user", "Only.", "", 0, 0)], TURNS)).collect()
    assert [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in got] == [(conv, 0, None, 1, 0, 1, 0)]


def trie_borrowed(conv):
    import zlib

    return zlib.crc32(str(conv).encode()) % 9


def test_ids_of_a_shared_end_are_hashed_in_order_over_pieces(spark, monkeypatch):
    import hashlib

    ends = spark.range(20_000).selectExpr("cast(1 as long) a", "cast(2 as long) b", "id * 7 as conv_id").repartition(6)
    got = trie.ends_sha256(ends).collect()
    assert [tuple(r) for r in got] == [(1, 2, hashlib.sha256(",".join(str(7 * k) for k in range(20_000)).encode()).hexdigest())]


def test_no_rows_for_empty_tables(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie.conversation_trie(none).count() == 0
    assert repair.repair_table(none).count() == 0


# -- repair without Spark ----------------------------------------------------------------------------------------------
def plain_repair(kinds):
    """Least (cost, letters) by whole strings over all paths, row by row."""
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                new = (c + 5, a + "I")
                best[repair.NEXT[s]] = min(best.get(repair.NEXT[s], new), new)
        return best

    for initial, fault in kinds:
        after = {}
        for s, (c, a) in inserted(dict(best)).items():
            extra = 5 if fault == "t" else 0
            moves = [(2, "D", s)]
            if fault in "ot":
                moves.append((1 + extra, "R", repair.NEXT[s]))
                if initial == "uuau"[s]:
                    moves.append((extra, "K", repair.NEXT[s]))
                if initial == "s" and s == 0:
                    moves.append((extra, "K", 1))
            for price, letter, to in moves:
                new = (c + price, a + letter)
                after[to] = min(after.get(to, new), new)
        best = after
    best = inserted(dict(best))
    return min(best[s] for s in (0, 3) if s in best)


@pytest.mark.parametrize("size", [0, 1, 2, 5, 9, 40, 300])
def test_divide_and_conquer_equals_whole_strings(size):
    rng = random.Random(size)
    for _ in range(60 if size < 50 else 5):
        kinds = [rng.choice("suax") + rng.choice("oootdb") for _ in range(size)]
        cost, letters = plain_repair(kinds)
        tables = [repair.block_table("".join(kinds[k:k + 7])) for k in range(0, size, 7)]
        states = repair.crossings(tables, 0, [c for _, c in repair.END])
        got = "".join(repair.block_letters("".join(kinds[7 * k:7 * k + 7]), a, b) for k, (a, b) in enumerate(zip([0, *states], states)))
        got += repair.END[states[-1]][0] if states else ""
        assert got == letters
        assert cost == sum({"K": 0, "R": 1, "D": 2, "I": 5}[x] for x in letters) + 5 * sum(
            k[1] == "t" and x != "D" for k, x in zip(kinds, letters.replace("I", "")))
