"""What several operators share: cutting lineage, numbering rows and connected components, all distributed."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

# Ranks are counted in so many buckets of a key side by side; a constant, so that ranks don't depend on the cluster.
RANK_BUCKETS = 512


def cut(df: DataFrame) -> DataFrame:
    """The same rows, kept in the folder that all executors share; Spark removes them when nothing uses them."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def running_total(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the same key that come before, in an order fixed by the rows.

    The order is by a hash of the order columns, then by themselves. A key's rows are summed in ``RANK_BUCKETS`` parts, so
    a key with a third of all rows is spread over as many tasks; one small row for each part is summed in a second step.
    Ties (rows equal in all order columns) come in any order.
    """
    parted = df.withColumns(
        {"_part": F.pmod(F.xxhash64(*order), F.lit(RANK_BUCKETS)).cast("int"), "_value": value.cast("long")}
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_key{i}" for i in range(len(keys))]
    totals = parted.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_part").alias("_piece"))
    before = Window.partitionBy(*names).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.agg(F.sum("_value").alias("_total"))
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    counted = parted.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip([*keys, "_part"], [*names, "_piece"])]
    joined = counted.join(totals, same).withColumn(name, F.col("_inside") + F.col("_before"))
    return joined.select(*df.columns, name)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` of every node of the undirected edges ``a``, ``b``: the smallest node reachable.

    Large-star and small-star steps in turn, each a grouped minimum and a join, until the edges stay the same; then every
    node points to the smallest of its component. A step's rows are written to the shared folder.
    """
    pair = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pair, before = cut(pair), None
    while True:
        state = pair.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if state == before:
            return pair.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                pair.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        both = pair.unionByName(pair.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        down = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        pair = cut(down.unionByName(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct())


# Documents in one stretch of the order by id, and the most stretches. A stretch is a stream and never held whole, so its
# size needs no bound; the number of stretches does, as the driver holds a few numbers for each.
STRETCH = 2_000
STRETCHES = 1 << 14


def stretch_bounds(df: DataFrame, key: str = "doc_id", rows: int = STRETCH) -> list[int]:
    """Keys that cut the order by ``key`` into parts of about ``rows`` rows, ``STRETCHES`` parts at most.

    They come from approximate quantiles; whatever they are, the parts follow each other in key order.
    """
    parts = min(-(-df.count() // rows), STRETCHES)
    if parts < 2:
        return []
    shares = ", ".join(f"{i / parts:.6f}D" for i in range(1, parts))
    found = df.agg(F.expr(f"percentile_approx({key}, array({shares}), {max(10_000, 20 * parts)})").alias("b")).first()
    return sorted(set(found.b or []))


def with_stretch(df: DataFrame, bounds: list[int], key: str = "doc_id") -> DataFrame:
    """Adds ``stretch``, the number of the part that the row's key is in; null keys are in the first."""

    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(bounds, dtype=np.int64), keys.to_numpy(), side="left")).astype("int32")

    lowest = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    return df.withColumn("stretch", F.pandas_udf(place, "int")(lowest) if bounds else F.lit(0))


def in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows of a stretch together, in order, as a stream; a task has whole stretches, one after the other."""
    return df.repartition("stretch").sortWithinPartitions("stretch", *order)
