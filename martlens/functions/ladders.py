"""First-match rules kept as tables of fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# (measure, comparison, threshold, outcome)
Rule = tuple[str, str, float, str]


def first_match(rules: Sequence[Rule], default: str, missing: dict[str, float] | None = None) -> Column:
    """Outcome of the first rule that holds, else ``default``.

    ``missing`` gives the value to assume for a NULL measure; without one a NULL
    measure matches no rule.
    """
    assumed = missing or {}
    chain = None
    for name, sign, threshold, outcome in rules:
        value = F.coalesce(F.col(name), F.lit(assumed[name])) if name in assumed else F.col(name)
        holds = {"<": value < threshold, "<=": value <= threshold, ">": value > threshold, ">=": value >= threshold}[sign]
        chain = F.when(holds, outcome) if chain is None else chain.when(holds, outcome)
    return chain.otherwise(default)


def first_flag(rules: Sequence[tuple[str, Sequence[str]]], default: str, value: str = "Single") -> Column:
    """Outcome of the first rule with any of its flag columns equal to ``value``."""
    chain = None
    for outcome, flags in rules:
        hit = F.col(flags[0]).eqNullSafe(value)
        for flag in flags[1:]:
            hit = hit | F.col(flag).eqNullSafe(value)
        chain = F.when(hit, outcome) if chain is None else chain.when(hit, outcome)
    return chain.otherwise(default)
