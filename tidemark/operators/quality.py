"""Named data-quality rules: count violations, optionally drop the rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN = "warn"
DROP = "drop"


@dataclass(frozen=True)
class Rule:
    """A predicate in SQL. A predicate that is NULL for a row counts as violated."""

    name: str
    predicate: str
    action: str = WARN

    def __post_init__(self) -> None:
        if self.action not in (WARN, DROP):
            raise ValueError(f"rule {self.name!r}: unknown action {self.action!r}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect(name: str, predicate: str) -> Rule:
    return Rule(name, predicate, WARN)


def expect_or_drop(name: str, predicate: str) -> Rule:
    return Rule(name, predicate, DROP)


def keep_valid(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """The rows that pass every dropping rule.

    The plain predicates are used: a filter drops NULL by itself, and unlike the wrapped form they reach the scan.
    """
    predicates = [F.expr(r.predicate) for r in rules if r.action == DROP]
    return df.filter(reduce(and_, predicates)) if predicates else df


def rule_metrics(rules: Sequence[Rule]) -> list[Column]:
    """A row count and one violation count per rule, each over all input rows."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(~r.holds).alias(r.name) for r in rules]]


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], name: str = "quality"
) -> tuple[DataFrame, Observation | None]:
    """Count all rules on the way past and drop the rows that a dropping rule rejects.

    In batch the counts arrive in the returned ``Observation`` once an action has run; on a stream they are in
    ``lastProgress.observedMetrics[name]`` of each micro-batch and no observation is returned. Spark may count a task
    twice when it is run again after a lost executor, so exact figures come from :func:`quality_report`.
    """
    metrics = rule_metrics(rules)
    if df.isStreaming:
        return keep_valid(df.observe(name, *metrics), rules), None
    observation = Observation(name)
    return keep_valid(df.observe(observation, *metrics), rules), observation


def quality_report(df: DataFrame, rules: Sequence[Rule], table: str = "", by: Sequence[str] = ()) -> DataFrame:
    """One row per rule with its passed and failed row counts, from a single pass over the data; with ``by``, for each group."""
    counts = df.groupBy(*by).agg(*rule_metrics(rules))
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            (F.col("rows") - F.col(r.name)).alias("passed"),
            F.col(r.name).alias("failed"),
        )
        for r in rules
    ]
    return counts.select(*by, F.inline(F.array(*entries)))
