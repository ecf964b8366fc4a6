"""Continuous daily revenue and weekly spend from an event feed.

The feed is read as a file stream. ``accumulate`` reduces each micro-batch to partial sums per
event-time window, and ``merged`` adds the parts up, so a reader sees every event once, late or
not. ``run_to_table`` is the variant for consumers of final windows: it appends a window when the
watermark has closed it, holds one row of state per open window and group, and drops later events.

A feed may deliver an event more than once. ``accumulate`` keeps a ledger of the ids that have
counted, by day of the event: a batch is freed of its own repeats and then joined against the
ledger of its days only, so a repeat is found however late it comes, while an on-time batch reads
the ledger of a day or two. ``run_to_table`` drops repeats within the watermark by keyed state
(``once``). Parts and ledger are merged by ``compact``; a reader takes the newest merged
folder and the batches after it, so nothing counts twice at any moment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.functions.money import sum_usd
from martlens.sources.store import folder_names, new_table_path, path_exists, remove_path

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
WATERMARK = "2 days"


def _event_time(ts: str = "ts") -> Column:
    """Instant of a zone-less timestamp read as UTC, whatever the session zone."""
    c = F.col(ts)
    seconds = F.unix_date(F.to_date(c)).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.timestamp_seconds(seconds)


def _utc_date(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def read_stream(spark: SparkSession, feed: str, files_per_batch: int = 100) -> DataFrame:
    """New files of a feed as a stream of events: every file below ``feed``, which may be a folder or a name pattern."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(feed)


def daily_revenue_windows(events: DataFrame) -> DataFrame:
    """Purchases per day and channel; works on a stream and on a batch alike."""
    k = F.get_json_object("props", "$.k").cast("int")
    channel = F.when(k % 3 == 0, "wholesale").otherwise("DTC")
    rows = events.where(F.col("event_type") == "purchase").select(
        _event_time().alias("at"), channel.alias("channel"), "value"
    )
    if rows.isStreaming:
        rows = rows.withWatermark("at", WATERMARK)
    return rows.groupBy(F.window("at", "1 day").alias("w"), "channel").agg(
        F.count(F.lit(1)).alias("order_count"), sum_usd("value").alias("total_revenue")
    ).select(_utc_date(F.col("w.start")).alias("order_date"), "channel", "order_count", "total_revenue")


def weekly_spend_windows(events: DataFrame) -> DataFrame:
    """Advertising cost per seven-day window, one window starting each day."""
    rows = events.where(F.col("event_type").isin("view", "click", "signup")).select(
        _event_time().alias("at"), F.col("event_type").alias("source"), "value"
    )
    if rows.isStreaming:
        rows = rows.withWatermark("at", WATERMARK)
    return rows.groupBy(F.window("at", "7 days", "1 day").alias("w"), "source").agg(
        F.count(F.lit(1)).alias("n"), sum_usd("value").alias("total_spend")
    ).select(_utc_date(F.col("w.start")).alias("window_start"), "source", "n", "total_spend")


def run_to_table(windows: DataFrame, path: str, state: str) -> None:
    """Process what has arrived and append closed windows to the Parquet table at ``path``.

    ``state`` is the query's checkpoint: a later run with the same paths reads new files only.
    Events behind the watermark are dropped here; ``accumulate`` keeps them.
    """
    query = (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def once(events: DataFrame) -> DataFrame:
    """A stream without the repeats of an event id that arrive within the watermark; state ends with it."""
    return events.withColumn("_at", _event_time()).withWatermark("_at", WATERMARK).dropDuplicatesWithinWatermark(["event_id"]).drop("_at")


def _number(folder: str) -> int:
    return int(folder.removeprefix("batch=").removesuffix("m"))


def _batches(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Number of the last batch in the newest merged folder, and the folders to read: that one and the batches after it.

    ``batch=7`` holds one batch, ``batch=7m`` all up to that one.
    """
    done = [n for n in folder_names(spark, path) if n.startswith("batch=") and path_exists(spark, f"{path}/{n}/_SUCCESS")]
    merged = [_number(n) for n in done if n.endswith("m")]
    last = max(merged, default=-1)
    later = sorted((n for n in done if not n.endswith("m") and _number(n) > last), key=_number)
    return last, [*([f"batch={last}m"] if merged else []), *later]


def _new_events(batch: DataFrame, number: int, ledger: str) -> DataFrame:
    """The events of a batch that have not counted yet; their ids are added to the ledger as those of this batch.

    An event without an id cannot be told from another and always counts.
    """
    spark = batch.sparkSession
    day = F.to_date("ts")
    # one event of each id and day: repeats are alike, and the least row is as good as any
    columns = [c for c in batch.columns if c != "event_id"]
    known = batch.where("event_id is not null").groupBy("event_id", day.alias("_day")).agg(F.min(F.struct(*columns)).alias("_e"))
    days = [r[0] for r in known.select("_day").distinct().collect()]  # the days of one batch
    folders = [f"{ledger}/{n}" for n in _batches(spark, ledger)[1] if n != f"batch={number}"]
    if folders and days:
        seen = spark.read.schema("event_id long, _day date").option("basePath", ledger).parquet(*folders)
        in_days = F.col("_day").isin([d for d in days if d is not None])
        in_days = in_days | F.col("_day").isNull() if None in days else in_days
        before = seen.where(in_days).select("event_id", F.col("_day").alias("_before"))
        known = known.join(before, (known["event_id"] == before["event_id"]) & known["_day"].eqNullSafe(before["_before"]), "left_anti")
    path = f"{ledger}/batch={number}"
    known.select("event_id", "_day").write.mode("overwrite").partitionBy("_day").parquet(path)
    return known.select("event_id", "_e.*").select(*batch.columns).unionByName(batch.where("event_id is null"))


def accumulate(events: DataFrame, windows: Callable[[DataFrame], DataFrame], path: str, state: str) -> None:
    """Add the windows' partial sums of newly arrived files to the table at ``path``.

    Each micro-batch writes one folder named after its number, so a repeated batch replaces
    itself. An event counts however late it is, and once however often it is delivered.
    """
    path = path.rstrip("/")

    def add(batch: DataFrame, number: int) -> None:
        fresh = _new_events(batch, number, f"{path}-ids")
        windows(fresh).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        events.writeStream.foreachBatch(add).option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def merged(spark: SparkSession, path: str, windows: Callable[[DataFrame], DataFrame], sums: dict[str, Column]) -> DataFrame:
    """The whole table: parts of a window added up over all batches. ``sums`` gives the added columns."""
    path = path.rstrip("/")
    shape = windows(spark.createDataFrame([], EVENTS)).schema
    folders = [f"{path}/{n}" for n in _batches(spark, path)[1]]
    if not folders:
        return spark.createDataFrame([], shape)
    parts = spark.read.schema(shape).option("basePath", path).parquet(*folders)
    keys = [c for c in shape.names if c not in sums]
    return parts.groupBy(*keys).agg(*[total.alias(name) for name, total in sums.items()]).select(*shape.names)


def compact(spark: SparkSession, path: str, windows: Callable[[DataFrame], DataFrame], sums: dict[str, Column]) -> None:
    """Merge the parts of all batches, and their ledgers, into one folder each.

    To be called between runs. The merged folder counts from the moment it is complete, and the batches in it
    no longer do; they are removed afterwards, or by the next call.
    """
    path = path.rstrip("/")
    for place, whole in ((path, lambda: merged(spark, path, windows, sums)), (f"{path}-ids", lambda: _ledger(spark, f"{path}-ids"))):
        last, folders = _batches(spark, place)
        newest = max([last, *map(_number, folders)])
        if newest > last:
            writer = whole().write.mode("overwrite")
            (writer if place == path else writer.partitionBy("_day")).parquet(f"{place}/batch={newest}m")
        for name in folder_names(spark, place):
            if name.startswith("batch=") and name != f"batch={newest}m" and _number(name) <= newest:
                remove_path(spark, f"{place}/{name}")


def _ledger(spark: SparkSession, ledger: str) -> DataFrame:
    folders = [f"{ledger}/{n}" for n in _batches(spark, ledger)[1]]
    return spark.read.schema("event_id long, _day date").option("basePath", ledger).parquet(*folders).repartition("_day", F.pmod("event_id", F.lit(64)))


DAILY_SUMS = {"order_count": F.sum, "total_revenue": sum_usd}
WEEKLY_SUMS = {"n": F.sum, "total_spend": sum_usd}


def added(how: dict[str, Callable[[str], Column]]) -> dict[str, Column]:
    return {name: total(name) for name, total in how.items()}


def _whole(spark: SparkSession, feed: str, windows, name: str, sums: dict[str, Column], path: str | None, state: str | None) -> DataFrame:
    path = path or new_table_path(spark, name)
    accumulate(read_stream(spark, feed), windows, path, state or f"{path}-state")
    return merged(spark, path, windows, sums)


def whole_daily_revenue(spark: SparkSession, feed: str, path: str | None = None, state: str | None = None) -> DataFrame:
    """Daily revenue of everything that has arrived; give ``path`` and ``state`` to go on from an earlier run."""
    return _whole(spark, feed, daily_revenue_windows, "daily-revenue", added(DAILY_SUMS), path, state)


def whole_weekly_spend(spark: SparkSession, feed: str, path: str | None = None, state: str | None = None) -> DataFrame:
    """Spend per seven-day window of everything that has arrived; see ``whole_daily_revenue``."""
    return _whole(spark, feed, weekly_spend_windows, "weekly-spend", added(WEEKLY_SUMS), path, state)
