"""Schema registry with add-new-columns evolution, and rescue of values that do not fit."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.rows import RESCUED
from tidemark.sources.tables import read_or_empty

_REGISTRY = "version int, schema_json string"


def registered_schema(spark: SparkSession, registry: str, table: str) -> StructType | None:
    """The newest schema of a table, or None before its first batch."""
    return _newest(spark, registry, table)[1]


def evolve(
    spark: SparkSession, registry: str, table: str, incoming: StructType, declared: StructType | None = None
) -> StructType:
    """Add columns not seen before, as nullable, and return the schema now in force.

    Known columns keep their registered type. The first batch starts from ``declared`` where given.
    """
    version, known = _newest(spark, registry, table)
    merged = merge_schemas(declared if known is None else known, incoming)
    if merged != known:
        entry = spark.createDataFrame([(version + 1, merged.json())], _REGISTRY)
        entry.coalesce(1).write.mode("append").parquet(f"{registry}/{table}")
    return merged


def _newest(spark: SparkSession, registry: str, table: str) -> tuple[int, StructType | None]:
    versions = read_or_empty(spark, f"{registry}/{table}", _REGISTRY)
    newest = versions.agg(F.max(F.struct("version", "schema_json")).alias("v")).first()["v"]
    if newest is None:
        return 0, None
    return newest["version"], StructType.fromJson(json.loads(newest["schema_json"]))


def merge_schemas(known: StructType | None, incoming: StructType) -> StructType:
    """The known columns in their order, then the new ones."""
    fields = list(known.fields) if known is not None else []
    names = {f.name for f in fields}
    fields += [f for f in incoming.fields if f.name not in names and f.name != RESCUED]
    return StructType([StructField(f.name, f.dataType, True) for f in fields])


def conform(df: DataFrame, schema: StructType, rescue: str = RESCUED) -> DataFrame:
    """Cast a frame to a schema without losing anything.

    A missing column becomes NULL. A value that does not cast, or whose cast would lose something (``1.5`` to an
    integer), becomes NULL and its original goes, as text, into the JSON object in the ``rescue`` column, as does every
    value of a column that the schema lacks. The column is NULL for rows with nothing to rescue.
    """
    present = {f.name: f.dataType for f in df.schema}
    out: list[Column] = []
    lost: list[Column] = []
    for f in schema.fields:
        if f.name == rescue:
            continue
        source = F.col(f"`{f.name}`")
        if f.name not in present:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif present[f.name] == f.dataType:
            out.append(source)
        else:
            cast = source.try_cast(f.dataType)
            fits = cast.isNotNull()
            if not isinstance(present[f.name], StringType):
                fits = fits & cast.try_cast(present[f.name]).eqNullSafe(source)
            out.append(F.when(fits, cast).alias(f.name))
            lost.append(F.when(~fits, _text(source)).alias(f.name))
    extra = [c for c in present if c not in schema.names and c != rescue]
    lost += [_text(F.col(f"`{c}`")).alias(c) for c in extra]
    if not lost:
        rescued = F.lit(None).cast(StringType())
    else:
        rescued = F.nullif(F.to_json(F.struct(*lost)), F.lit("{}"))
    if rescue not in present:
        return df.select(*out, rescued.alias(rescue))
    both = df.select(*out, F.col(rescue).cast("string").alias("__earlier"), rescued.alias("__new"))
    merged = both.withColumn(rescue, _merged(F.col("__earlier"), F.col("__new")))
    return merged.drop("__earlier", "__new")


def _merged(earlier: Column, new: Column) -> Column:
    """Both JSON objects in one. Of a name in both, the earlier value moves to the name with ``.earlier`` behind it; an
    earlier rescue that isn't an object is kept whole under the name of the column."""
    texts = "map<string,string>"
    was = F.coalesce(F.from_json(earlier, texts), F.create_map(F.lit(RESCUED), earlier))
    now = F.from_json(new, texts)
    moved = F.transform_keys(was, lambda k, _: F.when(F.map_contains_key(now, k), F.concat(k, F.lit(".earlier"))).otherwise(k))
    return F.when(earlier.isNull(), new).when(new.isNull(), earlier).otherwise(F.to_json(F.map_concat(moved, now)))


def _text(value: Column) -> Column:
    return value.cast("string")

