"""Repair of broken conversations at least cost, by Hirschberg's divide and conquer.

The roles of a repaired conversation read ``(s?(ua)+)?``. Four states accept that: 0 nothing yet, 1 after the system
turn, 2 after a user turn, 3 after an assistant turn. A row is kept (K), given another role (R) or deleted (D), and
empty turns may be inserted (I) before it and after the last; from a given state the letter alone tells the next
state. So a row is a 4 x 4 table: from the state in which a path arrives at the row to the state in which it arrives at
the next, the least cost and, of equal costs, the ASCII-least letters. Letters up to an arrival are free of prefixes,
so the audit-least of two different beginnings stays so whatever follows, and its rank among four is all that need be
kept.

Hirschberg: a forward and a backward vector of four costs meet at the middle; the audit-least crossing among the
optimal ones is fixed and both halves are solved alone, in linear space. The tables combine associatively, so a
conversation is cut into blocks of ``BLOCK`` rows. Each block is reduced to one such table by one task per block, the
same recursion over the blocks of a conversation (a hundred bytes each) fixes the states between them, and every
block is solved alone again. Only the texts of a conversation pass one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm import common

#: Costs of the edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Rows of a block.
BLOCK = 1024

#: What a user or assistant turn leads to, by state; the role that comes next, by state.
NEXT, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")

#: Letters and cost that lead from a state to the accepting ones after the last row (none needed after nothing).
END = (("", 0), ("II", 2 * INSERT), ("I", INSERT), ("", 0))

NO = 1 << 50

WHITE = r"\x20\x09-\x0D"


# -- damage and faults -------------------------------------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped, copy): nulls are one space, and one row in twenty of each kind is damaged.

    The kind is crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (marked here, so that its conversation stays
    known), 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 makes it a user turn.
    """
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(known[0], F.lit(":"), known[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                                text.alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _order() -> list[Column]:
    """Rows of a conversation: by turn, null first; equal turns by role and SHA-256 of the text."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha"), F.col("copy")]


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with ``conv``, the id as text (one space for null), and ``sha``, the SHA-256 of the text."""
    return rows.select("*", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), F.sha2("text", 256).alias("sha"))


def faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, ord, fault, initial, illegal): one row per row, without texts.

    ``ord`` counts the rows of a conversation from 0; ``fault`` is b for no visible character, d for a role and text
    seen before, t for a last visible character other than ``.``, ``!`` and ``?``, else o; ``illegal`` tells that the
    initials of the row before and this one are not su, ua or au.
    """
    blank = ~F.col("text").rlike(f"[^{WHITE}]")
    broken = ~F.col("text").rlike(f"[.!?][{WHITE}]*\\z")
    order = Window.partitionBy("conv").orderBy(*_order())
    seen = Window.partitionBy("conv", "role", "sha").orderBy("ord")
    slim = rows.select("conv", "turn", "role", "sha", "copy", F.substring("role", 1, 1).alias("initial"),
                       F.when(blank, "b").when(broken, "t").otherwise("o").alias("fault"))
    placed = slim.select("*", (F.row_number().over(order) - 1).cast("long").alias("ord"), F.lag("initial").over(order).alias("was"))
    pair = F.concat("was", "initial")
    return placed.select(
        "conv", "turn", "ord", F.when((F.col("fault") != "b") & (F.row_number().over(seen) > 1), "d").otherwise(F.col("fault")).alias("fault"),
        "initial", (F.col("was").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"))


# -- least cost --------------------------------------------------------------------------------------------------------
@lru_cache
def row_table(kind: str) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """From arrival state to next arrival state: least cost and letters, for a row of this kind (initial, fault)."""
    initial, fault = kind[0], kind[1]
    extra = TRUNCATED if fault == "t" else 0
    table = [[None] * 4 for _ in range(4)]
    for start in range(4):
        state, before, paid = start, "", 0
        for _ in range(3):  # more than two insertions come back to a state that was there before
            moves = [(DELETE, "D", state)]
            if fault not in "bd":
                moves.append((REROLE + extra, "R", NEXT[state]))
                if initial == ROLE[state][0]:
                    moves.append((extra, "K", NEXT[state]))
                elif initial == "s" and state == 0:
                    moves.append((extra, "K", 1))
            for cost, letter, to in moves:
                new = (paid + cost, before + letter)
                if table[start][to] is None or new < table[start][to]:
                    table[start][to] = new
            state, before, paid = NEXT[state], before + "I", paid + INSERT
    return tuple(map(tuple, table))


#: A table with ranks in place of letters: [from][to] = (cost, rank among the four).
Table = tuple[tuple[tuple[int, int], ...], ...]


@lru_cache
def ranked(kind: str) -> Table:
    rows = []
    for options in row_table(kind):
        letters = sorted(x[1] for x in options if x)
        rows.append(tuple((x[0], letters.index(x[1])) if x else (NO, 0) for x in options))
    return tuple(rows)


Vector = list[tuple[int, int]]


def forward(vector: Vector, tables: list[Table]) -> Vector:
    """Costs and ranks of the four states after ``tables``, from those before."""
    for table in tables:
        best = []
        for to in range(4):
            # Cost, then the order of the beginnings, then the order of what this step adds to the same beginning.
            best.append(min((vector[s][0] + table[s][to][0], vector[s][1], table[s][to][1]) for s in range(4)))
        order = sorted((b[1], b[2]) for b in best if b[0] < NO)
        vector = [(b[0], order.index((b[1], b[2]))) if b[0] < NO else (NO, 0) for b in best]
    return vector


def backward(costs: list[int], tables: list[Table]) -> list[int]:
    """Least costs from the four states before ``tables``, given those after."""
    for table in reversed(tables):
        costs = [min(table[s][to][0] + costs[to] for to in range(4)) for s in range(4)]
    return costs


def start_at(state: int) -> Vector:
    return [(0, 0) if s == state else (NO, 0) for s in range(4)]


def crossings(tables: list[Table], start: int, end: list[int]) -> list[int]:
    """The states in which the audit-least of the cheapest paths arrives after each of ``tables``; ``end`` are costs from there."""
    states = [0] * len(tables)
    work = [(0, len(tables), start, end)]
    while work:
        low, high, first, costs = work.pop()
        if low == high:
            continue
        middle = (low + high) // 2 if high - low > 1 else high
        ahead = forward(start_at(first), tables[low:middle])
        back = backward(costs, tables[middle:high])
        _, _, at = min((ahead[s][0] + back[s], ahead[s][1], s) for s in range(4))
        states[middle - 1] = at
        if high - low > 1:
            work.append((low, middle, first, [0 if s == at else NO for s in range(4)]))
            work.append((middle, high, at, costs))
    return states


def combined(tables: list[Table]) -> Table:
    """One table for several in a row."""
    return tuple(tuple(forward(start_at(s), tables)) for s in range(4))


#: Rows whose tables and letters a worker remembers; there are 16 kinds of rows that differ.
CHUNK = 4


@lru_cache(1 << 16)
def chunk_table(kinds: str) -> Table:
    return combined([ranked(kinds[k:k + 2]) for k in range(0, len(kinds), 2)])


@lru_cache(1 << 18)
def chunk_letters(kinds: str, start: int, to: int) -> str:
    rows = [kinds[k:k + 2] for k in range(0, len(kinds), 2)]
    states = crossings([ranked(k) for k in rows], start, [0 if s == to else NO for s in range(4)])
    return "".join(row_table(k)[a][b][1] for k, a, b in zip(rows, [start, *states], states, strict=False))


def _chunks(kinds: str) -> list[str]:
    return [kinds[k:k + 2 * CHUNK] for k in range(0, len(kinds), 2 * CHUNK)]


def block_table(kinds: str) -> Table:
    """One table for a block of rows, given as two characters a row."""
    return combined([chunk_table(c) for c in _chunks(kinds)])


def block_letters(kinds: str, start: int, to: int) -> str:
    """Letters of a block that is entered and left in known states."""
    chunks = _chunks(kinds)
    states = crossings([chunk_table(c) for c in chunks], start, [0 if s == to else NO for s in range(4)])
    return "".join(chunk_letters(c, a, b) for c, a, b in zip(chunks, [start, *states], states, strict=False))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [[v for row in block_table(k) for pair in row for v in pair] for k in batch.column("kinds").to_pylist()]
        yield pa.record_batch([batch.column("conv"), batch.column("block"), pa.array(made, pa.list_(pa.int64()))], names=["conv", "block", "made"])


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States around each block, from block tables sorted by conversation and block; one conversation's tables are held."""
    conv, tables = None, []

    def solved() -> list[tuple]:
        states = crossings(tables, 0, [cost for _, cost in END])
        return [(conv, k, a, b, k == len(states) - 1) for k, (a, b) in enumerate(zip([0, *states], states, strict=False))]

    for batch in batches:
        out = []
        for c, made in zip(batch.column("conv").to_pylist(), batch.column("made").to_pylist(), strict=True):
            if c != conv:
                out += solved() if tables else []
                conv, tables = c, []
            pairs = list(zip(made[::2], made[1::2], strict=True))
            tables.append(tuple(tuple(pairs[4 * s:4 * s + 4]) for s in range(4)))
        yield from _state_rows(out)
    yield from _state_rows(solved() if tables else [])


def _state_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    names = ["conv", "block", "into", "out", "last"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    if rows:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("kinds", "into", "out", "last"))
        made = [block_letters(k, a, b) + (END[b][0] if last else "") for k, a, b, last in zip(*columns, strict=True)]
        yield pa.record_batch([batch.column("conv"), batch.column("block"), pa.array(made, pa.string())], names=["conv", "block", "letters"])


def edits(found: DataFrame, folder: str) -> DataFrame:
    """(conv, block, letters): the cheapest, ASCII-least edits of every block of ``BLOCK`` rows of ``faults`` rows.

    Initials other than s, u and a count alike. The rows of a block and the tables of a conversation are bounded or
    small; blocks are solved by as many tasks as there are.
    """
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    listed = found.select("conv", F.floor(F.col("ord") / BLOCK).alias("block"), "ord", F.concat(initial, "fault").alias("kind"))
    made = listed.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("ord", "kind"))).alias("rows"))
    blocks = common.stored(made.select("conv", "block", F.array_join("rows.kind", "").alias("kinds")), f"{folder}/blocks")
    tables = blocks.repartition("conv", "block").mapInArrow(_tables, "conv string, block long, made array<long>")
    states = tables.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(
        _states, "conv string, block long, into long, out long, last boolean")
    return blocks.join(states, ["conv", "block"]).mapInArrow(_letters, "conv string, block long, letters string")


# -- repaired turns ----------------------------------------------------------------------------------------------------
def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edited turns, from letters and then rows of each conversation in order; the letters of one are held."""
    conv, letters, at, state, pos = None, [], 0, 0, 0
    out: list[tuple] = []

    def insert(until_end: bool) -> None:
        nonlocal at, state, pos
        whole = letters[0]
        while at < len(whole) and whole[at] == "I":
            out.append((conv, pos, "I", ROLE[state], ""))
            state, at, pos = NEXT[state], at + 1, pos + 1
        if until_end and at != len(whole):
            raise RuntimeError("letters and rows of a conversation do not agree")

    for batch in batches:
        for c, piece, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv", "letters", "role", "text")), strict=True):
            if c != conv:
                if conv is not None:
                    letters[:] = ["".join(letters)]
                    insert(True)
                conv, letters, at, state, pos = c, [], 0, 0, 0
            if piece is not None:
                letters.append(piece)
                continue
            if len(letters) > 1:
                letters[:] = ["".join(letters)]
            insert(False)
            letter = letters[0][at]
            at += 1
            if letter != "D":
                role = ROLE[state] if letter == "R" else role
                state = 1 if state == 0 and letter == "K" and role[:1] == "s" else NEXT[state]
            out.append((conv, pos, letter, role, text))
            pos += 1
        yield from _turn_rows(out)
        out.clear()
    if conv is not None:
        letters[:] = ["".join(letters)]
        insert(True)
    yield from _turn_rows(out)


def _turn_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    if rows:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                              names=["conv", "pos", "edit", "role", "text"])


def repaired_turns(rows: DataFrame, letters: DataFrame) -> DataFrame:
    """(conv, pos, edit, role, text): every edit in order, with the turn that it leaves, or for D the turn deleted.

    Conversations are whole and in order within a partition. Texts are moved once, by conversation, and streamed.
    """
    piece = letters.select("conv", F.lit(0).alias("part"), "block", "letters", F.lit(None).cast("long").alias("turn"),
                           *[F.lit(None).cast("string").alias(c) for c in ("role", "sha")], F.lit(0).alias("copy"), F.lit(None).cast("string").alias("text"))
    body = rows.select("conv", F.lit(1).alias("part"), F.lit(0).cast("long").alias("block"), F.lit(None).cast("string").alias("letters"),
                       "turn", "role", "sha", "copy", "text")
    both = piece.unionByName(body).repartition("conv").sortWithinPartitions("conv", "part", "block", *_order())
    return both.mapInArrow(_apply, "conv string, pos long, edit string, role string, text string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation, from its edits in order."""
    conv, audit, digest, any_turn, out = None, [], None, False, []

    def done() -> dict:
        return {"conv": conv, "audit": "".join(audit), "sha": digest.hexdigest()}

    for batch in batches:
        for c, edit, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv", "edit", "role", "text")), strict=True):
            if c != conv:
                if conv is not None:
                    out.append(done())
                conv, audit, digest, any_turn = c, [], hashlib.sha256(), False
            audit.append(edit)
            if edit != "D":
                digest.update(f"{chr(10) if any_turn else ''}{role}:{text}".encode())
                any_turn = True
        if out:
            yield pa.RecordBatch.from_pylist(out, _DIGEST)
            out = []
    if conv is not None:
        yield pa.RecordBatch.from_pylist([done()], _DIGEST)


_DIGEST = pa.schema([("conv", pa.string()), ("audit", pa.string()), ("sha", pa.string())])


def repair_table(conversations: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repair of every damaged conversation, one row per conv_id.

    Null roles and texts are one space; rows without a conv_id are one conversation with a null conv_id; rows of equal
    turns are in order of role and SHA-256 of the text; a conversation all of whose rows are dropped has zeros, an
    empty audit and the digest of the empty text. An empty table gives no rows. Other columns do not matter.
    """
    folder = common.run_folder(conversations.sparkSession, "op13")
    rows = keyed(damaged(conversations))
    left = rows.where("not dropped")
    found = common.stored(faults(left), f"{folder}/faults")
    letters = common.stored(edits(found, folder), f"{folder}/letters")
    first = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "ord")
    stepped = found.select("*", (F.col("turn").isNotNull() & ~F.lag("turn").over(first).eqNullSafe(F.col("turn"))).alias("new"))
    counts = stepped.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("new"), F.lit(0).cast("long")).alias("gaps"),
        *[F.count_if(F.col("fault") == k[0]).alias(k) for k in ("blank", "duplicate", "truncated")], F.count_if("illegal").alias("illegal"))
    digests = repaired_turns(left, letters).mapInArrow(_digest, "conv string, audit string, sha string")
    costs = _cost(found, letters)
    zero, empty = F.lit(0).cast("long"), hashlib.sha256(b"").hexdigest()
    every = rows.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    joined = every.join(counts, "conv", "left").join(costs, "conv", "left").join(digests, "conv", "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(empty)).alias("repaired_sha256"))


def _cost(found: DataFrame, letters: DataFrame) -> DataFrame:
    """(conv, cost): the letters' own costs, and TRUNCATED for each truncated row less those deleted."""
    def count(letter: str) -> Column:
        return F.length("letters") - F.length(F.translate("letters", letter, ""))

    edit = letters.select("conv", (count("R") * REROLE + count("D") * DELETE + count("I") * INSERT).cast("long").alias("cost"), "block",
                          F.translate("letters", "I", "").alias("plain"))
    # The k-th letter of a block other than I belongs to its k-th row.
    rows = found.where("fault = 't'").select("conv", F.floor(F.col("ord") / BLOCK).alias("block"), (F.col("ord") % BLOCK).alias("k"))
    listed = rows.groupBy("conv", "block").agg(F.collect_list("k").alias("at"))
    undeleted = F.size(F.filter("at", lambda k: F.substr(F.col("plain"), (k + 1).cast("int"), F.lit(1)) != "D"))
    both = edit.join(listed, ["conv", "block"], "left")
    return both.groupBy("conv").agg(F.sum(F.col("cost") + F.coalesce(F.greatest(undeleted, F.lit(0)), F.lit(0)) * TRUNCATED).cast("long").alias("cost"))
