"""Slowly changing dimensions derived from a change log.

A log is an append-only set of row versions in any order. Both dimension types order it by its sequence columns, never
by arrival, so late, replayed and shuffled changes give the same dimension.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.operators.dedupe import dedupe_latest
from tidemark.session import fresh_dir

START = "__START_AT"
END = "__END_AT"
IS_CURRENT = "__IS_CURRENT"

# Fixed value: the end of an interval that is still open, for readers that cannot take NULL.
FOREVER = "9999-12-31 23:59:59"

# A key with more log rows than this is worked on in pieces, this many for every so many rows.
HOT_ROWS = 1_000_000
PIECES = 8

_SEGMENT = "__segment"


def scd1(log: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The newest row per key."""
    return dedupe_latest(log, keys, sequence_by)


def scd2(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    track: Sequence[str],
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """All versions per key, each with the interval in which it held.

    A version opens when a tracked column differs from the preceding row (NULL equals NULL); rows that change only
    other columns update the open version, so it carries the values of its last row. ``__START_AT`` is the first
    sequence column of its first row, ``__END_AT`` that of the next version's first row, NULL while it is open. Rows
    with equal key and sequence count once. The first sequence column must not be NULL; extraction never yields a row
    without it.

    Ordinary keys need one shuffle and one sort. Keys whose log exceeds ``hot_rows`` would make a single task sort
    their whole history; they are found first and cut into ranges of the sequence, see :func:`_segmented`.
    """
    keys, sequence_by, track = list(keys), list(sequence_by), list(track)
    hot = _hot_keys(log, keys, hot_rows)
    if hot is None:
        return _versions(log, keys, sequence_by, track)
    hot_frame, hot_total = hot
    on = _same(log, hot_frame, keys)
    rest = log.join(F.broadcast(hot_frame), on, "left_anti")
    # Never so many pieces that one is smaller than a quarter of an average partition, should all rows be hot.
    pieces = min(math.ceil(PIECES * hot_total / hot_rows), 4 * _shuffle_partitions(log))
    cut = _segmented(
        log.join(F.broadcast(hot_frame), on, "left_semi"),
        keys,
        sequence_by,
        pieces,
        scratch or fresh_dir(log.sparkSession, "hot-keys"),
    )
    return _versions(rest, keys, sequence_by, track).unionByName(
        _versions(cut, keys, sequence_by, track, _SEGMENT)
    )


def current(history: DataFrame) -> DataFrame:
    """The open versions."""
    return history.filter(F.col(END).isNull())


def with_current_flag(history: DataFrame) -> DataFrame:
    return history.withColumn(IS_CURRENT, F.col(END).isNull())


def closed_intervals(history: DataFrame) -> DataFrame:
    """History with ``is_current``, ``valid_from`` and ``valid_to``; open versions end in the far future."""
    end_type = history.schema[END].dataType
    return history.select(
        *[c for c in history.columns if c not in (START, END)],
        F.col(END).isNull().alias("is_current"),
        F.col(START).alias("valid_from"),
        F.coalesce(F.col(END), F.lit(FOREVER).cast(end_type)).alias("valid_to"),
    )


def _versions(
    rows: DataFrame, keys: list[str], sequence: list[str], track: list[str], segment: str | None = None
) -> DataFrame:
    """Versions from the log; with a segment, from a log cut into segments."""
    columns = [c for c in rows.columns if c != segment]
    grouping = keys if segment is None else [*keys, segment]
    unique = _unique_in_place(rows, grouping, sequence)

    # The adjacent rows of the same key: their start, which is never NULL in a row, and their tracked values.
    shown = [sequence[0], *track]
    w = Window.partitionBy(*grouping).orderBy(*sequence)
    near = unique.withColumns(
        {
            **{f"__prev_{i}": F.lag(c).over(w) for i, c in enumerate(shown)},
            **{f"__next_{i}": F.lead(c).over(w) for i, c in enumerate(shown)},
        }
    )
    start = F.col(sequence[0])
    opens = F.col("__prev_0").isNull() | ~_equal(track, "__prev_", 1)
    closes = F.col("__next_0").isNull() | ~_equal(track, "__next_", 1)
    end, carried = F.col("__next_0"), F.lit(None)
    if segment is not None:
        near = _joined_up(near, keys, segment, shown)
        alone, same = F.col("__before").isNull(), _equal(track, "__before.v", 1)
        opens = F.when(F.col("__prev_0").isNull(), alone | ~same).otherwise(opens)
        alone, same = F.col("__after").isNull(), _equal(track, "__after.v", 1)
        closes = F.when(F.col("__next_0").isNull(), alone | ~same).otherwise(closes)
        end, carried = F.coalesce(end, F.col("__after.v0")), F.col("__carried")

    # Starts ascend with the rows, so the largest so far is that of the version a row belongs to.
    flagged = near.withColumns({"__opened": F.when(opens, start), "__closes": closes, END: end})
    opened = F.max("__opened").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    versions = flagged.withColumn(START, F.coalesce(opened, carried))
    return versions.filter("__closes").select(*columns, START, END)


def _joined_up(near: DataFrame, keys: list[str], segment: str, shown: list[str]) -> DataFrame:
    """Tell every row what precedes and follows its segment within its key.

    Adds ``__before`` and ``__after``, the shown values of the row before and after the segment, and ``__carried``, the
    start of the version that is open when the segment begins. All come from one summary row per key and segment, of
    which there are at most as many as segments and hot keys together: five times the shuffle partitions.
    """
    values = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(shown)])
    is_first, is_last = F.col("__prev_0").isNull(), F.col("__next_0").isNull()
    opens_inside = ~is_first & ~_equal(shown[1:], "__prev_", 1)
    ends = near.groupBy(*keys, segment).agg(
        F.first(F.when(is_first, values), ignorenulls=True).alias("__first"),
        F.first(F.when(is_last, values), ignorenulls=True).alias("__last"),
        F.max(F.when(opens_inside, F.col(shown[0]))).alias("__inside"),
    )

    across = Window.partitionBy(*keys).orderBy(segment)
    linked = ends.withColumns({"__before": F.lag("__last").over(across), "__after": F.lead("__first").over(across)})
    same = [F.col(f"__first.v{i}").eqNullSafe(F.col(f"__before.v{i}")) for i in range(1, len(shown))]
    first_opens = F.col("__before").isNull() | ~reduce(and_, same)
    newest = F.coalesce("__inside", F.when(first_opens, F.col("__first.v0")))
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    grouping = [*keys, segment]
    summary = linked.withColumn("__newest", newest).select(
        *[F.col(c).alias(f"__key_{i}") for i, c in enumerate(grouping)],
        "__before",
        "__after",
        F.last("__newest", ignorenulls=True).over(earlier).alias("__carried"),
    )
    # Not hinted: the rows carry the tracked values, so Spark measures them before it broadcasts them.
    return near.join(summary, _equal(grouping, "__key_"), "inner")


def _unique_in_place(rows: DataFrame, grouping: list[str], sequence: list[str]) -> DataFrame:
    """One row per key and sequence, using the partitioning and order that the version windows need anyway."""
    rest = [c for c in rows.columns if c not in grouping and c not in sequence]
    w = Window.partitionBy(*grouping).orderBy(*sequence, *rest)
    following = rows.withColumns({f"__next_{i}": F.lead(c).over(w) for i, c in enumerate(sequence)})
    return following.filter(~_equal(sequence, "__next_")).select(*rows.columns)


def _equal(columns: list[str], prefix: str, first: int = 0) -> Column:
    """Whether the columns equal the numbered ones of that prefix; NULL equals NULL."""
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"{prefix}{i}")) for i, c in enumerate(columns, first)])


def _hot_keys(log: DataFrame, keys: list[str], hot_rows: int) -> tuple[DataFrame, int] | None:
    """The keys with more than about ``hot_rows`` rows, and about how many rows they have in total.

    Their sizes are estimated from a sample in which a key of that size has a thousand rows; only the choice between two
    ways to the same result hangs on it. At most one key per shuffle partition is taken, largest first. Any other key
    holds no more rows than an average partition, so it is no hot spot, and the list stays small enough to collect and
    broadcast.
    """
    fraction = min(1.0, 1000 / hot_rows)
    sample = log.select(*keys)
    if fraction < 1.0:
        sample = sample.sample(fraction, seed=17)
    found = (
        sample.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") > hot_rows * fraction)
        .orderBy(F.desc("__rows"), *keys)
        .limit(_shuffle_partitions(log))
        .collect()
    )
    if not found:
        return None
    schema = StructType([StructField(k, log.schema[k].dataType) for k in keys])
    frame = log.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], schema)
    return frame, math.ceil(sum(r["__rows"] for r in found) / fraction)


def _segmented(rows: DataFrame, keys: list[str], sequence: list[str], pieces: int, path: str) -> DataFrame:
    """Rows of hot keys with the number of the key-and-sequence range they fall in.

    Spark samples the ranges anew in every plan, and several plans read these rows, so the numbering is fixed by
    writing the rows to the shared folder. Redelivered copies are merged before that, inside the map tasks first.
    """
    (
        rows.distinct()
        .repartitionByRange(pieces, *keys, *sequence)
        .withColumn(_SEGMENT, F.spark_partition_id())
        .write.mode("overwrite")
        .parquet(path)
    )
    return rows.sparkSession.read.schema(_plain(rows.schema).add(_SEGMENT, "integer")).parquet(path)


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in cols])


def _plain(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema])
