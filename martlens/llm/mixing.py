"""Mixing sources to target weights by Pfair scheduling, as DataFrame expressions only.

Each source is cut into blocks of ``block_docs`` documents. With weight w, block j may start from slot ``floor(j / w)``
(release) and must be placed before slot ``ceil((j + 1) / w)`` (deadline). In every slot the released block with the
earliest deadline goes next. Weights are made to add up to a frame of whole slots, so the schedule repeats after one
frame, which is worked out once for all data; a document finds its slot by its rank in its source. In every prefix of
the mix, each source is less than one block away from its share, as long as no source has run out. Slots of a source
that has run out stay empty; no document is dropped or repeated.

The rank of a document in its source follows a hash. It is the count of the documents in the source's earlier hash
buckets, plus the rank in its own bucket, so a source with a third of all rows is spread over ``BUCKETS`` groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets of a source: three hexadecimal digits.
BUCKETS = 16**3

#: The name under which documents without a source take part.
NO_SOURCE = "(none)"


def shares(weights: dict[str, int], frame: int = 1000) -> dict[str, int]:
    """Slots of each source in a frame: one each, the rest in proportion by largest remainder (ties by name).

    ``weights`` are whole numbers above 0. The frame grows to four slots per source where that is more.
    """
    if not weights:
        return {}
    free, total = max(frame, 4 * len(weights)) - len(weights), sum(weights.values())
    out = {s: 1 + free * w // total for s, w in weights.items()}
    left = free + len(weights) - sum(out.values())
    for s in sorted(weights, key=lambda s: (-(free * weights[s] % total), s))[:left]:
        out[s] += 1
    return out


def damped_weights(docs: DataFrame, power: float = 0.5) -> dict[str, int]:
    """Weights in proportion to the document count to the given power, in thousandths; one number per source."""
    name = F.coalesce("source", F.lit(NO_SOURCE))
    rows = docs.groupBy(name.alias("name")).agg(F.floor(F.pow(F.count("*"), F.lit(power)) * 1000).alias("w")).collect()
    return {r.name: r.w for r in rows}


def schedule(spark, slots: dict[str, int]) -> DataFrame:
    """(mix_name, mix_turn, mix_slot, mix_release, mix_deadline): one frame, earliest deadline first.

    ``mix_turn`` numbers the blocks of a source within the frame.
    """
    names = sorted(slots)
    frame = sum(slots.values())
    size = F.lit([slots[n] for n in names] or [1])

    def release(turn, i):
        return F.floor(turn * frame / F.get(size, i))

    def deadline(turn, i):
        return F.ceil((turn + 1) * frame / F.get(size, i))

    def step(state, slot):
        ready = F.filter(
            F.transform(state["done"], lambda turn, i: F.struct(
                deadline(turn, i).alias("deadline"), i.alias("i"), turn.alias("turn"), release(turn, i).alias("release"))),
            lambda c: (c["release"] <= slot) & (c["turn"] < F.get(size, c["i"])))
        return F.get(F.transform(F.array(F.array_min(ready)), lambda pick: F.struct(
            F.transform(state["done"], lambda turn, i: F.when(i == pick["i"], turn + 1).otherwise(turn)).alias("done"),
            F.concat(state["order"], F.array(F.struct(
                pick["i"].alias("i"), pick["turn"].alias("turn"), slot.alias("slot"),
                pick["release"].alias("release"), pick["deadline"].alias("deadline")))).alias("order"))), F.lit(0))

    start = F.struct(
        F.lit([0] * len(names)).cast("array<int>").alias("done"),
        F.array().cast("array<struct<i:int,turn:int,slot:int,release:bigint,deadline:bigint>>").alias("order"))
    plan = F.aggregate(F.sequence(F.lit(0), F.lit(max(frame, 1) - 1)), start, step, lambda s: s["order"])
    entry = spark.range(1 if names else 0).select(F.explode(plan).alias("e"))
    return entry.select(F.get(F.lit(names or [""]), F.col("e.i")).alias("mix_name"), F.col("e.turn").cast("long").alias("mix_turn"),
                        F.col("e.slot").cast("long").alias("mix_slot"), F.col("e.release").alias("mix_release"), F.col("e.deadline").alias("mix_deadline"))


def mix(docs: DataFrame, weights: dict[str, int], *, block_docs: int = 16, frame: int = 1000) -> DataFrame:
    """``docs`` as a struct column ``row`` with mix_name, mix_block, mix_place, mix_slot, mix_release, mix_deadline.

    ``docs`` has doc_id and source. Sorting by (mix_slot, mix_place) gives the mix. Documents of a source without a
    weight have null slots. A null source takes part as ``(none)``. Equal rows take neighbouring ranks; rows that
    repeat an id are ranked by the id's hash and then arbitrarily. An empty table gives no rows.
    """
    slots = shares(weights, frame)
    total = sum(slots.values())
    spark = docs.sparkSession
    digest = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("mix_id"), F.coalesce("source", F.lit(NO_SOURCE)).alias("mix_name"),
                       digest.alias("mix_hash"), F.substring(digest, 1, 3).alias("mix_bucket"))
    counts = rows.groupBy("mix_name", "mix_bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("mix_name").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("mix_name", "mix_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("mix_before"))
    own = Window.partitionBy("mix_name", "mix_bucket").orderBy("mix_hash", "mix_id")
    ranked = rows.withColumn("mix_own", F.row_number().over(own) - 1).join(offsets, ["mix_name", "mix_bucket"])
    rank = F.col("mix_before") + F.col("mix_own")
    size = spark.range(1).select(F.explode(F.lit(sorted(slots) or [""])).alias("mix_name")).withColumn(
        "mix_size", F.get(F.lit([slots[s] for s in sorted(slots)] or [1]), F.array_position(F.lit(sorted(slots) or [""]), F.col("mix_name")).cast("int") - 1).cast("long"))
    placed = ranked.select("row", "mix_name", F.floor(rank / block_docs).alias("mix_block"), (rank % block_docs).alias("mix_place")).join(
        size, "mix_name", "left")
    turned = placed.withColumn("mix_turn", F.col("mix_block") % F.col("mix_size")).withColumn(
        "mix_base", F.floor(F.col("mix_block") / F.col("mix_size")) * total)
    timed = turned.join(schedule(spark, slots), ["mix_name", "mix_turn"], "left")
    return timed.select("row", "mix_name", "mix_block", "mix_place", *[
        (F.col("mix_base") + F.col(c)).alias(c) for c in ("mix_slot", "mix_release", "mix_deadline")])


def mixed_rows(docs: DataFrame, weights: dict[str, int], **options) -> DataFrame:
    """The rows of ``docs``, all columns as they were, in mixing order; documents without a slot come last."""
    timed = mix(docs, weights, **options)
    last = F.coalesce("mix_slot", F.lit((1 << 62)))
    return timed.withColumn("mix_order", last).repartitionByRange("mix_order", "mix_name", "mix_place").sortWithinPartitions(
        "mix_order", "mix_name", "mix_place").select("row.*")


def mix_table(docs: DataFrame, weights: dict[str, int] | None = None, **options) -> DataFrame:
    """doc_id, source, block, place, slot, release, deadline for every row; weights default to ``damped_weights``."""
    own = docs.select("doc_id", "source")
    timed = mix(own, damped_weights(own) if weights is None else weights, **options)
    return timed.select("row.doc_id", F.col("mix_name").alias("source"), *[
        F.col(f"mix_{c}").alias(c) for c in ("block", "place", "slot", "release", "deadline")])
