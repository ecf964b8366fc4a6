"""Refresh of stored tables in the order in which they read each other.

Every stored table has a record: which base and stored tables it was built from, the mark that each of them had then,
a digest of its definition and the mark of its own rows. A refresh walks the tables from the base on. A table is
rebuilt when a mark or the definition differs from its record, else its folder is left untouched; if the rebuilt rows
turn out the same, the old folder stays and consumers are not rebuilt either.

A base table that only reads files is marked by their names, sizes and times, without a scan; any other frame by the
number and the hash sums of its rows, in one aggregate. A new version is written beside the old one and takes its
place with the record, so a reader never meets half a table, and a refresh that was cut short is made up by the next.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.plans.semantic import LazyTables
from martlens.sources.store import path_exists, remove_path, write_snapshot

RECORD = "name string, path string, definition string, mark string, reads string"


def row_mark(frame: DataFrame) -> str:
    """Number and hash sums of the rows: the same for the same rows in any order."""
    names = sorted(frame.columns)
    h = [F.xxhash64(F.lit(seed), *[F.col(f"`{n}`") for n in names]) for seed in (1, 2)]
    sums = frame.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(x.cast("decimal(38,0)")), F.lit(0)) for x in h], F.bit_xor(h[0])).first()
    kinds = ",".join(f"{n}:{t}" for n, t in sorted(frame.dtypes))
    return hashlib.sha256(f"{kinds}|{tuple(map(str, sums))}".encode()).hexdigest()


def _leaves(frame: DataFrame) -> list:
    found = frame._jdf.queryExecution().analyzed().collectLeaves()
    return [found.apply(k) for k in range(found.size())]


def file_mark(frame: DataFrame) -> str | None:
    """Names, sizes and times of the files behind a frame and what is made of them; None if it reads anything else."""
    if not all(leaf.getClass().getSimpleName() == "LogicalRelation" for leaf in _leaves(frame)):
        return None
    spark, lines = frame.sparkSession, []
    for name in sorted(frame.inputFiles()):
        place = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
        lines.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join([definition(frame), *lines]).encode()).hexdigest()


def definition(frame: DataFrame) -> str:
    """Digest of a frame's logical plan, without the numbers that Spark gives to columns."""
    plan = frame._jdf.queryExecution().analyzed().canonicalized().toString()
    return hashlib.sha256(re.sub(r"#\d+L?|_\d+\b", "", plan).encode()).hexdigest()


def _record(spark: SparkSession, root: str, name: str):
    path = f"{root}/_records/{name}"
    return spark.read.schema(RECORD).parquet(path).first() if path_exists(spark, f"{path}/_SUCCESS") else None


def _inputs(tables: LazyTables, name: str, stored: set[str]) -> set[str]:
    """The nearest stored or base tables from which ``name`` is built."""
    found, todo = set(), set(tables.reads[name])
    while todo:
        one = todo.pop()
        if one in stored or not tables.reads.get(one):
            found.add(one)
        else:
            todo |= tables.reads[one]
    return found


def refresh_stale(spark: SparkSession, tables: LazyTables, targets: Sequence[str], root: str) -> list[str]:
    """Bring the stored copies of ``targets`` below ``root`` up to date; gives the names rewritten, in order.

    The order of ``targets`` does not matter. Afterwards ``tables`` holds the stored copies.
    """
    root, stored = root.rstrip("/"), set(targets)
    for name in targets:
        tables[name]  # builds plans only, which tells what each table reads
    inputs = {name: _inputs(tables, name, stored) for name in targets}
    tables.forget()
    marks: dict[str, str] = {}
    rewritten = []
    for name in TopologicalSorter(inputs).static_order():
        if name not in stored:
            base = tables[name]
            marks[name] = file_mark(base) or row_mark(base)
            continue
        frame, last = tables[name], _record(spark, root, name)
        plan, reads = definition(frame), json.dumps({n: marks[n] for n in sorted(inputs[name])})
        if last and last.definition == plan and last.reads == reads and path_exists(spark, f"{last.path}/_SUCCESS"):
            marks[name], path = last.mark, last.path
        else:
            path = f"{root}/{name}/v-{uuid.uuid4().hex}"
            write_snapshot(frame, path)
            mark = row_mark(spark.read.parquet(path))
            if last and last.mark == mark and path_exists(spark, f"{last.path}/_SUCCESS"):
                remove_path(spark, path)
                path, old = last.path, None
            else:
                old = last.path if last else None
                rewritten.append(name)
            row = spark.createDataFrame([(name, path, plan, mark, reads)], RECORD)
            write_snapshot(row.coalesce(1), f"{root}/_records/{name}")
            if old:
                remove_path(spark, old)
            marks[name] = mark
        tables.replace(name, spark.read.parquet(path))
    return rewritten
