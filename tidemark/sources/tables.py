"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


_STAMP = "derived_from"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def write_table(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    path: str | None = None,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Write a catalog table (overwriting by default) with its comment and properties.

    With ``bucket_by``, the columns that it is joined on, its rows lie in ``buckets`` files by their hash, sorted. Tables with as
    many buckets of the same columns are joined, and one of them is summed by these columns, without a shuffle. The rows are
    dealt to the buckets before they are written, so a bucket is one file; a key with a huge share of all rows makes a huge one.
    """
    if bucket_by:
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.mode(mode).format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    describe_table(df.sparkSession, name, comment, properties)


def describe_table(
    spark: SparkSession, name: str, comment: str | None = None, properties: Mapping[str, str] | None = None
) -> None:
    entries = dict(properties or {})
    if comment is not None:
        entries["comment"] = comment
    if entries:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in entries.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def register_folder(spark: SparkSession, name: str, path: str) -> None:
    """Make a partitioned parquet folder a catalog table, or let the table know of new folders and columns."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def create_target(spark: SparkSession, name: str, schema: StructType, comment: str | None = None) -> None:
    """Declare a table before the flow that fills it; an existing table is left alone."""
    if not spark.catalog.tableExists(name):
        write_table(spark.createDataFrame([], schema), name, comment, mode="ignore")


def write_path(df: DataFrame, path: str) -> None:
    """Replace the parquet files of a derived table."""
    df.write.mode("overwrite").parquet(path)


def publish_run(df: DataFrame, path: str) -> None:
    """Write a derived table as its next run. The run before stays for those who still read it; older ones go."""
    spark = df.sparkSession
    runs = sorted(int(n.removeprefix("run=")) for n in children(spark, path))
    df.write.mode("overwrite").parquet(f"{path}/run={runs[-1] + 1 if runs else 0}")
    for run in runs[:-1]:
        delete_path(spark, f"{path}/run={run}")


def read_run(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The last run of a derived table that was written whole; no rows before the first."""
    runs = sorted((int(n.removeprefix("run=")) for n in children(spark, path)), reverse=True)
    whole = next((r for r in runs if path_exists(spark, f"{path}/run={r}/_SUCCESS")), None)
    return spark.createDataFrame([], schema) if whole is None else spark.read.schema(schema).parquet(f"{path}/run={whole}")


def publish_table(
    df: DataFrame, name: str, path: str, comment: str | None = None, properties: Mapping[str, str] | None = None, stamp: str | None = None
) -> None:
    """Show a derived table in the catalog: it is written as the next run below ``path`` and the table is pointed at it.

    Readers see the run before until then, and after a crash. With ``stamp``, what the table is derived from, nothing is written
    if the catalog shows that already.
    """
    spark = df.sparkSession
    known = spark.catalog.tableExists(name)
    if known and stamp is not None:
        held = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(f"key = '{_STAMP}'").first()
        if held is not None and held["value"] == stamp and set(df.columns) <= set(spark.read.table(name).columns):
            return
    publish_run(df, path)
    runs = sorted(int(n.removeprefix("run=")) for n in children(spark, path))
    folder = f"{path}/run={runs[-1]}"
    if known:
        missing = [f for f in df.schema.fields if f.name not in spark.read.table(name).columns]
        if missing:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in missing)})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(folder)}")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)
    describe_table(spark, name, comment, {**(properties or {}), **({_STAMP: stamp} if stamp is not None else {})})


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A parquet folder, or no rows if the folder does not exist. Any other failure is raised."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = file_system(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies directly in a folder, hidden names aside; none if it does not exist."""
    files, target = file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(n for n in (f.getPath().getName() for f in files.listStatus(target)) if n[0] not in "._")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files, if it is there."""
    files, target = file_system(spark, path)
    files.delete(target, True)


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
