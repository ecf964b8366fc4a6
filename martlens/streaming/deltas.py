"""Upkeep of aggregates that do not add up: distinct counts, modes, minima and maxima.

The state of an aggregate is a counted projection of its table: how often each combination of the group's key and of
the values that matter occurs, with the sums over those rows. A change is a set of signed counts: +1 for a row that
came, -1 for one that left, both for one that changed. Signed counts add up, so a withdrawn row takes its value back:
where the count comes to zero the value is gone, and the next smallest, next largest or next most frequent takes over.

Changes are appended as one folder per run, each split by a hash of the key into ``buckets``. A refresh reads, adds up
and replaces only the buckets of the keys that changed. ``compact`` merges the runs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.sources.store import folder_names, overwrite_partitions, path_exists, remove_path

COUNT, BUCKET = "_n", "_bucket"


@dataclass(frozen=True)
class Upkeep:
    """An aggregate kept up to date.

    ``keys`` name the group, ``values`` the columns whose distinct values matter, ``sums`` additive whole-number
    measures by name (made when a session is there), and ``result`` makes the aggregate from the counted projection (keys, values, ``_n``, sums).
    """

    keys: Sequence[str]
    values: Sequence[str]
    result: Callable[[DataFrame], DataFrame]
    sums: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    buckets: int = 64

    def counted(self, rows: DataFrame, sign: Column | int = 1) -> DataFrame:
        """Signed counts of ``rows``; ``sign`` is 1 or -1, for all or by row."""
        s = F.lit(sign) if isinstance(sign, int) else sign
        return rows.withColumn("_sign", s.cast("bigint")).groupBy(*self.keys, *self.values).agg(
            F.sum("_sign").alias(COUNT), *[F.sum(m() * F.col("_sign")).alias(n) for n, m in self.sums.items()])

    def merged(self, parts: DataFrame) -> DataFrame:
        """Counts added up, without what has gone; a negative count is an error, as a row left that never came."""
        n = F.sum(COUNT)
        added = parts.groupBy(*self.keys, *self.values).agg(n.alias(COUNT), *[F.sum(c).alias(c) for c in self.sums])
        wrong = F.raise_error(F.lit("more rows were withdrawn than there are")).cast("bigint")
        return added.withColumn(COUNT, F.when(F.col(COUNT) < 0, wrong).otherwise(F.col(COUNT))).where(F.col(COUNT) != 0)

    def difference(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Signed counts that lead from ``old`` rows to ``new`` ones; unchanged rows cancel out and touch no group."""
        parts = self.counted(old, -1).unionByName(self.counted(new))
        return parts.groupBy(*self.keys, *self.values).agg(
            F.sum(COUNT).alias(COUNT), *[F.sum(c).alias(c) for c in self.sums]).where(self._moved())

    def _moved(self) -> Column:
        moved = F.col(COUNT) != 0
        for c in self.sums:
            moved = moved | (F.col(c) != 0)
        return moved

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


def state_parts(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame:
    """All runs that hold: the newest merged one and those after it."""
    return spark.read.option("basePath", f"{path}/state").parquet(*[f"{path}/state/{r}" for r in runs or _valid(spark, path)])


def _valid(spark: SparkSession, path: str) -> list[str]:
    names = [n for n in folder_names(spark, f"{path}/state") if path_exists(spark, f"{path}/state/{n}/_SUCCESS")]
    merged = max((n for n in names if n.endswith("-m")), default="")
    return [n for n in names if n == merged or (not n.endswith("-m") and n > merged)]


def apply_changes(upkeep: Upkeep, changes: DataFrame, path: str, run: int) -> list[int]:
    """Append signed counts (as made by ``counted``) as run number ``run`` and refresh the groups they touch.

    Gives the buckets read and replaced. The same run applied again replaces itself.
    """
    spark = changes.sparkSession
    name = f"run={run:012d}"
    placed = changes.withColumn(BUCKET, upkeep.bucket())
    placed.repartition(BUCKET, *upkeep.keys).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/state/{name}")
    touched = sorted(int(b.partition("=")[2]) for b in folder_names(spark, f"{path}/state/{name}") if b.startswith(BUCKET))
    if touched:
        parts = state_parts(spark, path).where(F.col(BUCKET).isin(touched))
        fresh = upkeep.result(upkeep.merged(parts)).withColumn(BUCKET, upkeep.bucket())
        overwrite_partitions(fresh.repartition(BUCKET, *upkeep.keys), f"{path}/result", (BUCKET,))
        held = {r[0] for r in upkeep.merged(parts).select(upkeep.bucket()).distinct().collect()}
        for b in sorted(set(touched) - held):  # all groups of a bucket are gone
            remove_path(spark, f"{path}/result/{BUCKET}={b}")
    return touched


def compact(upkeep: Upkeep, spark: SparkSession, path: str) -> None:
    """Merge all runs into one; a reader meets either the old runs or the merged one."""
    runs = _valid(spark, path)
    last = max(runs)
    if len(runs) > 1:
        name = f"{last.removesuffix('-m')}-m"
        whole = upkeep.merged(state_parts(spark, path, runs)).withColumn(BUCKET, upkeep.bucket())
        whole.repartition(BUCKET, *upkeep.keys).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/state/{name}")
        for run in folder_names(spark, f"{path}/state"):
            if run < name:
                remove_path(spark, f"{path}/state/{run}")


def read_result(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(f"{path}/result").select(*columns)


def with_modes(counts: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(keys, value columns): the mode of each value column, null if a group has none."""
    pairs = F.array(*[F.struct(F.lit(v).alias("field"), F.col(v).cast("string").alias("value")) for v in values])
    each = counts.select(*keys, COUNT, F.inline(pairs)).where("value is not null")
    per_value = each.groupBy(*keys, "field", "value").agg(F.sum(COUNT).alias(COUNT))
    # the smallest of the most frequent: least by (falling count, value)
    best = [F.min(F.when(F.col("field") == v, F.struct((-F.col(COUNT)).alias("n"), F.col("value").alias("value")))).alias(v) for v in values]
    modes = per_value.groupBy(*keys).agg(*best).select(*keys, *[F.col(f"{v}.value").alias(v) for v in values])
    return counts.select(*keys).distinct().join(modes, list(keys), "left")
