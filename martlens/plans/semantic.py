"""Metric layer: measures and dimensions declared once, queried across tables.

A query aggregates every fact entity on its own and *before* it is joined to
dimension entities: rows are first reduced to the entity's own dimensions and
the foreign keys in use, then joined to the (unique) parent keys, then the
partial results of all facts are unioned and merged in one last aggregate.
Hence measures of two facts never multiply each other, a hot foreign key is
reduced before it is joined, and groups found in one fact only are kept.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.money import MEASURE_STEPS, cents, div0, ratio, steps, sum_cents, usd


@dataclass(frozen=True)
class Metric:
    """A measure as additive parts plus the expression that finishes them."""

    parts: Mapping[str, Callable[[], Column]]
    finish: Callable[[Callable[[str], Column]], Column]


def total(column: str, money: bool = False) -> Metric:
    if money:
        return Metric({"sum": lambda: sum_cents(column)}, lambda p: usd(p("sum")))
    return Metric({"sum": lambda: F.sum(column)}, lambda p: p("sum"))


def row_count(column: str) -> Metric:
    return Metric({"n": lambda: F.count(column)}, lambda p: p("n"))


def count_where(condition: str, weight: str | None = None) -> Metric:
    """Rows that meet a condition; with ``weight``, a row counts as often as that column says."""
    if weight is None:
        return Metric({"n": lambda: F.count_if(F.expr(condition))}, lambda p: p("n"))
    return Metric({"n": lambda: F.sum(F.when(F.expr(condition), F.col(weight)).otherwise(0))}, lambda p: p("n"))


def mean(column: str, money: bool = False, weight: str | None = None) -> Metric:
    """Mean from an exact sum of cents or of billionths, so that it does not depend on the order of rows."""
    def one() -> Column:
        return F.lit(1).cast("bigint") if weight is None else F.col(weight)

    scale = 100 if money else MEASURE_STEPS
    return Metric(
        {
            "sum": lambda: F.sum((cents(column) if money else steps(column)) * one()),
            "n": lambda: F.sum(F.when(F.col(column).isNotNull(), one()).otherwise(0)),
        },
        lambda p: ratio(p("sum"), p("n") * F.lit(scale)),
    )


def share(numerator: str, denominator: str, scale: int = 100) -> Metric:
    """Ratio of two sums times ``scale``, 0 when the denominator is 0."""
    return Metric(
        {"num": lambda: F.sum(numerator), "den": lambda: F.sum(denominator)},
        lambda p: div0(p("num"), p("den")) * scale,
    )


#: Words of a condition that are not fields.
CONDITION_WORDS = frozenset(
    "AND OR NOT IN IS NULL LIKE RLIKE BETWEEN TRUE FALSE CASE WHEN THEN ELSE END DATE TIMESTAMP INTERVAL CAST AS "
    "INT BIGINT DOUBLE STRING ESCAPE".split())

#: Words of a condition only behind ``INTERVAL n``; elsewhere they would be columns.
INTERVAL_UNITS = frozenset("DAY DAYS MONTH MONTHS YEAR YEARS WEEK WEEKS HOUR HOURS".split())


@dataclass(frozen=True)
class Relationship:
    """``child.column`` refers to ``parent.key``."""

    child: str
    column: str
    parent: str
    key: str


@dataclass(frozen=True)
class SemanticView:
    name: str
    entities: Mapping[str, tuple[str, ...]]  # entity -> primary key, may be empty
    relationships: Sequence[Relationship] = ()
    facts: Mapping[str, Sequence[str]] = field(default_factory=dict)
    dimensions: Mapping[str, Sequence[str]] = field(default_factory=dict)
    metrics: Mapping[str, Mapping[str, Metric]] = field(default_factory=dict)
    weights: Mapping[str, str] = field(default_factory=dict)  # entity -> column saying for how many rows a row stands

    def _split(self, qualified: str, kind: Mapping[str, object], label: str) -> tuple[str, str]:
        entity, _, name = qualified.partition(".")
        if entity not in self.entities or name not in kind.get(entity, ()):
            raise ValueError(f"{self.name} has no {label} {qualified}")
        return entity, name

    def _fields_in(self, condition: str) -> list[tuple[str, str]]:
        """Dimensions and facts named in a condition; any other name than ``entity.field`` is refused."""
        bare = re.sub(r"'(?:[^']|'')*'", "''", condition)
        found = []
        for m in re.finditer(r"[A-Za-z_]\w*(?:\s*\.\s*[A-Za-z_]\w*)*", bare):
            name = re.sub(r"\s", "", m.group())
            if name.upper() in CONDITION_WORDS or bare[m.end():].lstrip().startswith("("):
                continue
            if name.upper() in INTERVAL_UNITS and re.search(r"\binterval\s+(?:''|[-+]?\d+)\s*$", bare[:m.start()], re.IGNORECASE):
                continue
            entity, _, column = name.partition(".")
            if column not in (*self.dimensions.get(entity, ()), *self.facts.get(entity, ())):
                raise ValueError(f"{self.name} has no field {name}; conditions name declared entity.field")
            found.append((entity, column))
        return list(dict.fromkeys(found))

    def path(self, start: str, goal: str) -> list[tuple[str, str, str, str]]:
        """Shortest chain of many-to-one steps ``(from, column, to, key)``.

        A relationship may be followed backwards only when the child's column is
        the child's own primary key and the parent's key the parent's, so that
        the step is one-to-one.
        """
        steps = []
        for r in self.relationships:
            steps.append((r.child, r.column, r.parent, r.key))
            if self.entities[r.child] == (r.column,) and self.entities[r.parent] == (r.key,):
                steps.append((r.parent, r.key, r.child, r.column))
        queue, seen = deque([(start, [])]), {start}
        while queue:
            here, taken = queue.popleft()
            if here == goal:
                return taken
            for step in steps:
                if step[0] == here and step[2] not in seen:
                    seen.add(step[2])
                    queue.append((step[2], [*taken, step]))
        raise ValueError(f"{self.name}: no many-to-one path from {start} to {goal}")

    def query(
        self,
        tables: Mapping[str, DataFrame],
        dimensions: Sequence[str] = (),
        metrics: Sequence[str] = (),
        facts: Sequence[str] = (),
        where: str | Sequence[str] = (),
        order: Sequence[str] = (),
        limit: int | None = None,
    ) -> DataFrame:
        """Run one query.

        Dimensions with metrics group; dimensions with facts project rows of one
        entity; dimensions alone give distinct values. ``where`` holds SQL
        conditions on declared fields and acts before aggregation; ``order``
        entries name result columns, optionally followed by ``desc``.
        """
        if facts and metrics:
            raise ValueError("facts and metrics cannot be asked for together")
        if not (dimensions or metrics or facts):
            raise ValueError("nothing asked for")
        conditions = [where] if isinstance(where, str) else list(where)
        dims = [self._split(d, self.dimensions, "dimension") for d in dimensions]
        names = self._output_names(dims)
        if facts:
            out = self._rows(tables, dims, names, facts, conditions)
        elif metrics:
            out = self._grouped(tables, dims, names, metrics, conditions)
        else:
            out = self._distinct(tables, dims, names, conditions)
        if order:
            out = out.orderBy(*[
                F.desc_nulls_last(o.split()[0]) if o.lower().endswith(" desc") else F.asc_nulls_last(o.split()[0])
                for o in order
            ])
        return out if limit is None else out.limit(limit)

    @staticmethod
    def _output_names(dims: Sequence[tuple[str, str]]) -> list[str]:
        bare = [d for _, d in dims]
        return [d if bare.count(d) == 1 else f"{e}_{d}" for e, d in dims]

    def _join_parents(
        self, frame: DataFrame, tables: Mapping[str, DataFrame], entity: str, wanted: Sequence[tuple[str, str]]
    ) -> DataFrame:
        """Left joins from ``entity`` along the paths to every other entity in ``wanted``."""
        joined = {entity}
        steps = [s for other in dict.fromkeys(e for e, _ in wanted) for s in self.path(entity, other)]
        for here, column, there, key in steps:
            if there in joined:
                continue
            joined.add(there)
            onward = [s[1] for s in steps if s[0] == there]
            needed = dict.fromkeys([key, *onward, *[c for e, c in wanted if e == there]])
            parent = tables[there].select(*needed).alias(there)
            frame = frame.join(parent, F.col(f"{here}.{column}") == F.col(f"{there}.{key}"), "left")
        return frame

    def _rows(self, tables, dims, names, facts, conditions) -> DataFrame:
        wanted = [self._split(f, self.facts, "fact") for f in facts]
        used = dims + wanted + [f for c in conditions for f in self._fields_in(c)]
        entities = list(dict.fromkeys(e for e, _ in used))
        if len(entities) != 1:
            raise ValueError(f"facts and dimensions must belong to one entity, got {entities}")
        frame = tables[entities[0]].alias(entities[0])
        for condition in conditions:
            frame = frame.where(condition)
        return frame.select(
            *[F.col(f"{e}.{c}").alias(n) for (e, c), n in zip(dims, names)], *[F.col(f"{e}.{c}") for e, c in wanted]
        )

    def _distinct(self, tables, dims, names, conditions) -> DataFrame:
        used = dims + [f for c in conditions for f in self._fields_in(c)]
        entities = list(dict.fromkeys(e for e, _ in used))
        start, problem = None, None
        for candidate in entities:
            try:
                for other in entities:
                    self.path(candidate, other)
                start = candidate
                break
            except ValueError as error:
                problem = error
        if start is None:
            raise problem
        frame = self._join_parents(tables[start].alias(start), tables, start, used)
        for condition in conditions:
            frame = frame.where(condition)
        return frame.select(*[F.col(f"{e}.{c}").alias(n) for (e, c), n in zip(dims, names)]).distinct()

    def _grouped(self, tables, dims, names, metrics, conditions) -> DataFrame:
        asked = [self._split(m, self.metrics, "metric") for m in metrics]
        by_entity: dict[str, list[str]] = {}
        for entity, metric in asked:
            by_entity.setdefault(entity, []).append(metric)
        pieces = [self._partials(tables, e, ms, dims, names, conditions) for e, ms in by_entity.items()]
        merged = pieces[0]
        for piece in pieces[1:]:
            merged = merged.unionByName(piece, allowMissingColumns=True)
        parts = [c for c in merged.columns if c not in names]
        merged = merged.groupBy(*names).agg(*[F.sum(p).alias(p) for p in parts])
        finished = []
        metric_names = [m for _, m in asked]
        for entity, metric in asked:
            spec = self.metrics[entity][metric]
            label = metric if metric_names.count(metric) == 1 else f"{entity}_{metric}"
            finished.append(spec.finish(lambda p, m=f"_{entity}_{metric}": F.col(f"{m}_{p}")).alias(label))
        return merged.select(*names, *finished)

    def _partials(self, tables, entity, metrics, dims, names, conditions) -> DataFrame:
        """Additive parts of one fact entity's metrics, by the query's dimensions."""
        own, across = [], []
        for condition in conditions:
            local = {e for e, _ in self._fields_in(condition)} <= {entity}
            (own if local else across).append(condition)
        frame = tables[entity].alias(entity)
        for condition in own:
            frame = frame.where(condition)
        wanted = dims + [f for c in across for f in self._fields_in(c)]
        others = [(e, c) for e, c in wanted if e != entity]
        steps = [s for e in dict.fromkeys(e for e, _ in others) for s in self.path(entity, e)]
        keys = dict.fromkeys([c for e, c in wanted if e == entity] + [s[1] for s in steps if s[0] == entity])
        parts = [
            make().alias(f"_{entity}_{metric}_{part}")
            for metric in metrics
            for part, make in self.metrics[entity][metric].parts.items()
        ]
        reduced = frame.groupBy(*[F.col(f"{entity}.{k}").alias(k) for k in keys]).agg(*parts).alias(entity)
        joined = self._join_parents(reduced, tables, entity, others)
        for condition in across:
            joined = joined.where(condition)
        part_names = [c for c in reduced.columns if c not in keys]
        return joined.select(
            *[F.col(f"{e}.{c}").alias(n) for (e, c), n in zip(dims, names)], *[F.col(f"{entity}.{p}") for p in part_names]
        )

    def _rows_of(self, entity: str) -> Column:
        return F.sum(self.weights[entity]) if entity in self.weights else F.count(F.lit(1))

    def key_check(self, tables: Mapping[str, DataFrame], entities: Sequence[str] | None = None) -> DataFrame:
        """Duplicate primary keys and orphaned references of the declared model.

        Both are counted on key-level aggregates, not on rows.
        """
        chosen = list(self.entities if entities is None else entities)
        checks = []
        for entity in chosen:
            key = self.entities[entity]
            if key:
                groups = tables[entity].groupBy(*key).agg(self._rows_of(entity).alias("n"))
                checks.append(groups.agg(
                    F.lit("duplicate_key").alias("check"), F.lit(entity).alias("entity"),
                    F.lit(", ".join(key)).alias("columns"), F.count_if(F.col("n") > 1).alias("violations"),
                ))
        for r in self.relationships:
            if r.child in chosen and r.parent in chosen:
                refs = (
                    tables[r.child].where(F.col(r.column).isNotNull())
                    .groupBy(F.col(r.column).alias("k")).agg(self._rows_of(r.child).alias("n"))
                )
                known = tables[r.parent].select(F.col(r.key).alias("k")).distinct()
                checks.append(refs.join(known, "k", "left_anti").agg(
                    F.lit("orphan_reference").alias("check"), F.lit(r.child).alias("entity"),
                    F.lit(r.column).alias("columns"), F.coalesce(F.sum("n"), F.lit(0)).alias("violations"),
                ))
        out = checks[0]
        for check in checks[1:]:
            out = out.unionByName(check)
        return out.select("check", "entity", "columns", F.col("violations").cast("bigint").alias("violations"))


class LazyTables(Mapping):
    """Entity frames built on first use, so a query touches only its own tables.

    ``reads`` tells for each table built so far which tables its maker asked for.
    """

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}
        self._building: list[str] = []
        self.reads: dict[str, set[str]] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if self._building:
            self.reads[self._building[-1]].add(name)
        if name not in self._made:
            self.reads[name] = set()
            self._building.append(name)
            try:
                self._made[name] = self._makers[name]()
            finally:
                self._building.pop()
        return self._made[name]

    def replace(self, name: str, frame: DataFrame) -> None:
        """Use ``frame`` from now on, also in tables not built yet."""
        self._made[name] = frame

    def forget(self) -> None:
        """Build every table that reads another one anew when it is next asked for."""
        for name in [n for n in self._made if self.reads.get(n)]:
            del self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
