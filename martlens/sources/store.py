"""Sinks and shared-folder results."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, named in ``spark.checkpoint.dir`` or set on the context."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named and context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    named = named or context.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return named


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written table."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute a result once and keep it in the shared folder.

    Later plans read the stored rows, so a lost executor costs a re-read and
    not a recomputation.
    """
    spark = df.sparkSession
    shared_folder(spark)
    return df.checkpoint(eager=True)


def write_snapshot(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a table with the rows of ``df``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a result table with a shared schema."""
    df.write.mode("append").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace only the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it, for results that are no longer read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in store.listStatus(place) if f.isDirectory()) if store.exists(place) else []


def remove_partition(spark: SparkSession, path: str, values: Mapping[str, object]) -> None:
    """Delete one partition of a table written with ``partitionBy``."""
    remove_path(spark, "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in values.items())]))
