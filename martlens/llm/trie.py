"""Prefix trie of conversations by Spark SQL ROLLUP over positional turn-id columns.

A conversation is cut into blocks of ``BLOCK`` turns. One row per block holds the turn ids as columns ``t1`` to ``t8``
and, in ``p``, the block's number and the node at which the block before it ended: 128 bits, the exclusive or of one
hash per turn and place, which a window adds up. ``GROUP BY p, ROLLUP (t1, ..., t8)`` then aggregates all prefixes of
all lengths at once; ``grouping_id`` tells the depth, and no round is needed for long conversations.

Sums over a subtree become sums over members, so that two passes of the same ROLLUP are enough, whatever the depth. A
conversation is the *head* of the nodes of which it is the smallest member: those from some depth on along its path.
With ``w`` the text bytes before the first node that it heads, the tokens saved in the subtree of a node are the sum of
(w - bytes before the node's last turn) over all members but the head, and the head has the smallest ``w`` of all. The
leaves of a subtree are the members that head a leaf.

Turn ids come from SHA-256 of role and text; texts are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm import common

#: Turns of a column block.
BLOCK = 8

#: A conversation borrows the first turns of the one whose id is the next lower multiple of this, fewer than ``HEADS``.
SPREAD, HEADS = 5, 9

#: Ids joined to one text piece before the pieces of a node are hashed in order.
PIECE_IDS = 8192


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, n): place from 1 on, 128-bit id of (role, text) and UTF-8 bytes of the text.

    Turns are in order of ``turn``, null first; equal turn numbers in order of the SHA-256 of (role, text), repeated
    rows one after the other. Null role and text are empty. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", sha.alias("sha"), F.octet_length(text).cast("long").alias("n"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "sha")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"),
                       F.xxhash64("sha").alias("a"), F.xxhash64(F.lit(1), "sha").alias("b"), "n")


def borrowed_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes over."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> DataFrame:
    """The rebuilt conversations as ``turn_rows``, and a row with pos 0 and n 0 for each of them.

    Conversation c has the first h turns of conversation c - c % 5, as far as there are any, and then its own turns
    after the first h. One generator gives every turn to all conversations that hold it, nine at most.
    """
    def row(conv: Column, part: int, pos: Column, a: Column, b: Column, n: Column) -> Column:
        return F.struct(conv.alias("conv_id"), F.lit(part).alias("part"), pos.alias("pos"), a.alias("a"), b.alias("b"), n.alias("n"))

    conv, pos, zero = F.col("conv_id"), F.col("pos"), F.lit(0).cast("long")
    turn = [F.col(c) for c in ("pos", "a", "b", "n")]
    is_base = conv % SPREAD == 0
    head = F.when(pos == 1, F.array(row(conv, 0, zero, zero, zero, zero)))
    own = F.when(is_base | (pos > borrowed_turns(conv)), F.array(row(conv, 2, *turn)))
    others = F.array(*[F.lit(k).cast("long") for k in range(1 - SPREAD, SPREAD) if k])
    lent = F.when(is_base & (pos < HEADS), F.transform(
        F.filter(F.transform(others, lambda k: F.try_add(conv, k)),
                 lambda c: c.isNotNull() & (c - c % SPREAD == conv) & (borrowed_turns(c) >= pos)),
        lambda c: row(c, 1, *turn)))
    none = F.array().cast("array<struct<conv_id:bigint,part:int,pos:bigint,a:bigint,b:bigint,n:bigint>>")
    dealt = turns.select(F.explode(F.concat(*[F.coalesce(x, none) for x in (head, lent, own)])).alias("r")).select("r.*")
    order = Window.partitionBy("conv_id").orderBy("part", "pos")
    return dealt.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "a", "b", "n",
                        F.first("part").over(order).alias("first")).where("first = 0").drop("first")


def _term(a: Column, b: Column, depth: Column) -> tuple[Column, Column]:
    """What the turn with id (a, b) at this depth adds to the 128 bits of a node."""
    return F.xxhash64(a, b, depth), F.xxhash64(F.lit(1), b, a, depth)


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, p, t1 .. t8, total, end): one row per conversation and block; see the module text."""
    is_turn = F.col("pos") > 0
    term = [F.when(is_turn, x).otherwise(F.lit(0).cast("long")) for x in _term(F.col("a"), F.col("b"), F.col("pos"))]
    before = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    placed = turns.select("*", term[0].alias("ta"), term[1].alias("tb")).select(
        "conv_id", "a", "b", "n", F.when(is_turn, F.floor((F.col("pos") - 1) / BLOCK)).otherwise(F.lit(0).cast("long")).alias("block"),
        F.when(is_turn, (F.col("pos") - 1) % BLOCK + 1).otherwise(F.lit(0).cast("long")).alias("slot"),
        *[F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")).alias(f"p{c}") for c in ("ta", "tb")],
        F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("before"),
        *[F.bit_xor(c).over(whole).alias(f"e{c}") for c in ("ta", "tb")], F.sum("n").over(whole).alias("total"))
    # The first row of a block is that of pos 0 or of slot 1; all that holds for the block is taken from slot 1 or 0.
    opens = F.col("slot") <= 1

    def at(slot: int, c: str) -> Column:
        return F.max(F.when(F.col("slot") == slot, F.col(c))).alias(f"{c}{slot}")

    wide = placed.groupBy("conv_id", "block").agg(
        *[at(k, c) for k in range(1, BLOCK + 1) for c in ("a", "b", "n")],
        *[F.max(F.when(opens, F.col(c))).alias(c) for c in ("pta", "ptb", "before", "eta", "etb", "total")])
    return wide.select(
        "conv_id", F.struct("block", F.col("pta").alias("a"), F.col("ptb").alias("b"), "before").alias("p"),
        *[F.when(F.col(f"n{k}").isNotNull(), F.struct(F.col(f"a{k}").alias("a"), F.col(f"b{k}").alias("b"), F.col(f"n{k}").alias("n"))).alias(f"t{k}")
          for k in range(1, BLOCK + 1)],
        "total", F.struct(F.col("eta").alias("a"), F.col("etb").alias("b")).alias("end"))


def prefixes(block_rows: DataFrame, totals: str) -> DataFrame:
    """One row per node: its 128 bits (a, b), those of its parent (pa, pb), depth, bytes before its last turn, ``totals``."""
    slots = [f"t{k}" for k in range(1, BLOCK + 1)]
    rolled = block_rows.sparkSession.sql(
        f"SELECT p, {', '.join(slots)}, {BLOCK} - bit_count(grouping_id()) AS level, {totals} "  # noqa: S608
        f"FROM {{rows}} GROUP BY p, ROLLUP ({', '.join(slots)})", rows=block_rows)
    # Groups past the end of a conversation repeat its last node; a block's empty prefix repeats the node before it.
    last = F.element_at(F.array(F.lit(None).cast("struct<a:bigint,b:bigint,n:bigint>"), *slots), (F.col("level") + 1).cast("int"))
    nodes = rolled.where(((F.col("level") == 0) & (F.col("p.block") == 0)) | last.isNotNull())
    depth = F.col("p.block") * BLOCK

    def sums(to: Column) -> tuple[Column, Column, Column]:
        a, b, n = F.col("p.a"), F.col("p.b"), F.col("p.before")
        for k, t in enumerate(slots, 1):
            inside = F.lit(k) <= to
            ta, tb = _term(F.col(f"{t}.a"), F.col(f"{t}.b"), depth + k)
            zero = F.lit(0).cast("long")
            a, b = a.bitwiseXOR(F.when(inside, ta).otherwise(zero)), b.bitwiseXOR(F.when(inside, tb).otherwise(zero))
            n = n + F.when(inside, F.col(f"{t}.n")).otherwise(zero)
        return a, b, n

    key, parent = sums(F.col("level")), sums(F.col("level") - 1)
    kept = [c for c in rolled.columns if c not in {"p", "level", *slots}]
    return nodes.select(key[0].alias("a"), key[1].alias("b"), parent[0].alias("pa"), parent[1].alias("pb"),
                        (depth + F.col("level")).alias("depth"), parent[2].alias("before"), *kept)


def prefix_trie(turns: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The trie of conversations given as by ``rebuilt``: its nodes, and the node at which each conversation ends.

    Nodes: a, b (128 bits that name the node), conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves, saved_tokens. Ends: a, b, conv_id. Blocks and nodes are written to ``folder``.
    Without conversations there is no node, not even a root.
    """
    block_rows = common.stored(blocks(turns), f"{folder}/blocks")
    heads = common.stored(prefixes(block_rows, "min(conv_id) AS conv_id"), f"{folder}/heads")
    children = heads.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    marks = heads.join(children, ["a", "b"], "left").groupBy("conv_id").agg(
        F.min("before").alias("w"), F.max(F.when(F.col("n_children").isNull(), 1).otherwise(0)).cast("long").alias("leaf"))
    marked = block_rows.join(marks, "conv_id", "left").select(
        *block_rows.columns, F.coalesce("w", "total").alias("w"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"))
    nodes = prefixes(marked, "min(conv_id) AS conv_id, count(*) AS n_convs, sum(w) AS w, min(w) AS least, sum(leaf) AS n_leaves")
    parents = heads.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"))
    full = nodes.join(children, ["a", "b"], "left").join(parents, ["pa", "pb"], "left")
    trie = full.select(
        "a", "b", "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
        (F.col("w") - F.col("least") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"))
    return trie, block_rows.where("p.block = 0").select("end.a", "end.b", "conv_id")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined pieces of the ids of each node, from rows sorted by node and id."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        a, b, ids = (batch.column(c).to_numpy() for c in ("a", "b", "conv_id"))
        opens = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        cuts = np.unique(np.concatenate([[0], opens, np.arange(0, len(ids), PIECE_IDS)]))
        parts = [",".join(map(str, part.tolist())) for part in np.split(ids, cuts[1:])]
        yield pa.record_batch([pa.array(a[cuts]), pa.array(b[cuts]), pa.array(ids[cuts]), pa.array(parts, pa.string())],
                              names=["a", "b", "first", "piece"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of each node, from pieces sorted by node and first id; one digest is held."""
    key, digest, done = None, None, []
    for batch in batches:
        for a, b, piece in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "piece")), strict=True):
            if (a, b) != key:
                if digest:
                    done.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        if done:
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b, "sha": s} for a, b, s in done], _SHA)
            done = []
    if digest:
        yield pa.RecordBatch.from_pylist([{"a": key[0], "b": key[1], "sha": digest.hexdigest()}], _SHA)


_SHA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sha", pa.string())])


def ends_sha256(ends: DataFrame) -> DataFrame:
    """(a, b, sha): SHA-256 of the comma-joined ids, ascending, of the conversations that end at each node.

    Ids are dealt by ranges of (node, id), so the ids of one node that many conversations share are sorted and joined
    by many tasks; a last task reads the joined pieces in order.
    """
    pieces = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInArrow(
        _pieces, "a long, b long, first long, piece string")
    return pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_digests, "a long, b long, sha string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node, with the digest of the conversations that end there.

    Null role and text are empty; null turns come first; rows without a conv_id are left out; conversations of equal
    turns share all nodes; a rebuilt conversation without turns is a member of the root alone. An empty table has no
    node. Columns other than conv_id, turn, role and text do not matter.
    """
    folder = common.run_folder(conversations.sparkSession, "op11")
    trie, ends = prefix_trie(rebuilt(turn_rows(conversations)), folder)
    empty = hashlib.sha256(b"").hexdigest()
    return trie.join(ends_sha256(ends), ["a", "b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(empty)).alias("ends_sha256"))
