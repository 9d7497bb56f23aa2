"""Equi-joins.

No join is hinted. Spark broadcasts a side only below ``spark.sql.autoBroadcastJoinThreshold``, which it checks against
the statistics and, under adaptive execution, against the real size; beyond it the join is a sort-merge join whose
skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scd import current


def join_using(left: DataFrame, right: DataFrame, k: str | list[str], how: str = "inner") -> DataFrame:
    return left.join(right, k, how)


def join_via(fact: DataFrame, bridge: DataFrame, dim: DataFrame, bridge_key: str, dim_key: str) -> DataFrame:
    """Reach a dimension whose key only the bridge table carries."""
    return fact.join(bridge, bridge_key, "inner").join(dim, dim_key, "inner")


def join_current(fact: DataFrame, history: DataFrame, k: str) -> DataFrame:
    """Facts with the open version of a history dimension; columns of the fact win on a name clash."""
    open_rows = current(history)
    taken = [c for c in open_rows.columns if c != k and c in fact.columns]
    return fact.join(open_rows.drop(*taken), k, "inner")


def count_per_key(fact: DataFrame, k: str | list[str], counted: str, total: str | None = None) -> DataFrame:
    """Facts reduced to one row per foreign key, to be joined in place of the facts.

    A join on a unique key followed by sums over any grouping of the dimension gives the same result on these partial
    sums as on the rows, but shuffles one row per key instead of one per fact, so a hot key costs nothing.
    """
    aggs = [F.count(counted).alias("__rows")]
    if total is not None:
        aggs.append(F.sum(total).alias("__total"))
    return fact.groupBy(*([k] if isinstance(k, str) else k)).agg(*aggs)
