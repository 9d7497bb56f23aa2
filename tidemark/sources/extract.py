"""Extraction from relational or parquet sources by a change column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, NumericType, TimestampNTZType, TimestampType

from tidemark.sources.control import DEFAULT_SCHEMA, TableSpec
from tidemark.sources.watermarks import mark_value


def extract_since(df: DataFrame, c: str, value: str, inclusive: bool = False) -> DataFrame:
    """Rows whose change column lies after ``value`` (or on it). Rows without a value are never extracted.

    The literal takes the type of the column, so the comparison is typed and reaches the source scan.
    """
    bound = _bound(df, c, value)
    return df.filter(F.col(c) >= bound if inclusive else F.col(c) > bound)


def extract_from(df: DataFrame, c: str, date: str) -> DataFrame:
    """Backfill: rows from ``date`` on."""
    return extract_since(df, c, date, inclusive=True)


def extract_window(df: DataFrame, c: str, low: str, high: str) -> DataFrame:
    """Rows from ``low`` to ``high``, both included: a batch whose end is fixed before it is read."""
    return df.filter((F.col(c) >= _bound(df, c, low)) & (F.col(c) <= _bound(df, c, high)))


def _bound(df: DataFrame, c: str, value: str) -> Column:
    """A configured date or a watermark in the type of the change column."""
    return mark_value(F.lit(value), df.schema[c].dataType)


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    schema: str = DEFAULT_SCHEMA,
    key: str | None = None,
    partitions: int = 1,
    where: str | None = None,
) -> DataFrame:
    """A table of a relational database over JDBC; filters on it are sent to the database.

    With ``key``, an indexed integer key, the read is split into ``partitions`` queries by ranges of the key, so each uses
    the index. The bounds are taken from the keys themselves, by one query that the database answers with a few rows: keys
    that are spread unevenly still give ranges with about as many rows each. ``where``, in SQL of the database, limits the read;
    the bounds are those of the rows that it leaves, so also a few changed rows with high keys are spread over all queries.
    """
    name = f"{schema}.{table}" if schema else table
    options = dict(properties or {})
    if key is None or partitions <= 1:
        shown = f"(SELECT * FROM {name} WHERE {where}) b" if where else name
        return spark.read.jdbc(url, shown, properties=options)
    found = spark.read.jdbc(url, f"({bounds_query(name, key, partitions, where)}) b", properties=options)
    bounds = [row[0] for row in found.orderBy(found.columns[0]).collect()]
    return spark.read.jdbc(url, name, predicates=range_predicates(key, bounds, where), properties=options)


def bounds_query(name: str, key: str, partitions: int, where: str | None = None) -> str:
    """The largest key of each of so many parts with equally many rows, in SQL that all common databases share."""
    only = f"{key} IS NOT NULL" + (f" AND ({where})" if where else "")
    parts = f"SELECT {key} AS k, NTILE({partitions}) OVER (ORDER BY {key}) AS part FROM {name} WHERE {only}"
    return f"SELECT MAX(k) AS bound FROM ({parts}) p GROUP BY part"


def range_predicates(key: str, bounds: Sequence[int], where: str | None = None) -> list[str]:
    """Disjoint ranges that together cover every key, also below, above and NULL; at most one more than bounds."""
    cuts = sorted(set(bounds))[:-1]
    inner = [f"{key} > {low} AND {key} <= {high}" for low, high in zip(cuts, cuts[1:])]
    ranges = [f"{key} <= {cuts[0]} OR {key} IS NULL", *inner, f"{key} > {cuts[-1]}"] if cuts else ["1 = 1"]
    return [f"({r}) AND ({where})" for r in ranges] if where else ranges


# How databases write a moment and a day; all others take the standard's literals.
_CASTS = {"sqlserver": ("CAST('{0}' AS datetime2)", "CAST('{0}' AS date)"), "sqlite": ("'{0}'", "'{0}'")}


def since_sql(url: str, c: str, value: str, kind: DataType) -> str:
    """Rows whose change column lies on or after a mark, or is NULL, in SQL of the database that the URL names."""
    parts = url.split(":")
    moment, day = _CASTS.get(parts[1] if len(parts) > 1 else "", ("TIMESTAMP '{0}'", "DATE '{0}'"))
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        shown = moment.format(value if " " in value else f"{value} 00:00:00")
    elif isinstance(kind, DateType):
        shown = day.format(value[:10])
    elif isinstance(kind, NumericType):
        shown = value
    else:
        shown = "'" + value.replace("'", "''") + "'"
    return f"{c} >= {shown} OR {c} IS NULL"


@dataclass(frozen=True)
class RelationalSource:
    """A database as the source of an ingest. Its tables are read whole, or since a mark, in ranges of their first key."""

    spark: SparkSession
    url: str
    properties: Mapping[str, str] | None = None
    partitions: int = 64

    def __call__(self, spec: TableSpec) -> DataFrame:
        return read_relational(self.spark, self.url, spec.table, self.properties, spec.schema)

    def since(self, spec: TableSpec, df: DataFrame, value: str) -> DataFrame:
        """The table from a mark on, in ranges with equally many of these rows each; a table without keys in one."""
        kind = df.schema[spec.cdc_col].dataType
        where = since_sql(self.url, spec.cdc_col, self._shown(value, kind), kind)
        key = spec.keys[0] if spec.keys and isinstance(df.schema[spec.keys[0]].dataType, IntegralType) else None
        return read_relational(self.spark, self.url, spec.table, self.properties, spec.schema, key, self.partitions, where)

    def _shown(self, value: str, kind: DataType) -> str:
        """A mark as the database shows it, in the session's time zone, in which Spark reads and writes its moments."""
        return self.spark.range(1).select(mark_value(F.lit(value), kind).cast("string")).first()[0]
