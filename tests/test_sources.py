import json
from datetime import datetime

import pytest
from conftest import values
from pyspark.sql.types import DateType, IntegerType, StructType, TimestampType

from tidemark.plans.model import MODEL
from tidemark.sources.bronze import bronze_folder, land_bronze, read_bronze
from tidemark.sources.control import TableSpec, load_specs
from tidemark.sources.extract import bounds_query, extract_from, extract_since, extract_window, range_predicates
from tidemark.sources.tables import create_target, read_or_empty, read_table, write_table
from tidemark.sources.watermarks import Watermark, commit_watermark, get_watermark, watermark_table


def at(day):
    return datetime(2025, 1, day)


@pytest.fixture
def source(rows):
    return rows("id int, at timestamp", (1, at(1)), (2, at(2)), (3, at(3)), (4, None))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_extract_bounds(source):
    assert ids(extract_since(source, "at", "2025-01-02")) == [3]
    assert ids(extract_since(source, "at", "2025-01-02", inclusive=True)) == [2, 3]
    assert ids(extract_from(source, "at", "1900-01-01")) == [1, 2, 3]
    assert ids(extract_window(source, "at", "2025-01-01", "2025-01-02")) == [1, 2]


def test_date_column_is_compared_as_a_date(rows):
    df = rows("id int, d string", (1, "2025-10-07")).selectExpr("id", "cast(d AS date) AS d")
    assert ids(extract_since(df, "d", "2025-10-07 00:00:00", inclusive=True)) == [1]


def test_extract_reaches_the_scan(spark, source, tmp_path):
    source.write.parquet(f"{tmp_path}/s")
    plan = extract_since(spark.read.parquet(f"{tmp_path}/s"), "at", "2025-01-02")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(at), GreaterThan(at," in text


@pytest.mark.parametrize("bounds", [[], [5], [-7, 3, 9, 20], [3, 3, 3], [-20, 20]])
def test_range_predicates_cover_every_key_once(spark, rows, bounds):
    df = rows("k int", *[(i,) for i in range(-30, 31)], (None,))
    parts = [df.filter(p).count() for p in range_predicates("k", bounds)]
    assert sum(parts) == 62 and all(parts) and len(parts) == max(len(set(bounds)), 1)


def test_bounds_query_balances_uneven_keys(spark, rows):
    rows("k int", *[(i * i * i,) for i in range(40)], (None,)).createOrReplaceTempView("uneven")
    bounds = [r[0] for r in spark.sql(bounds_query("uneven", "k", 4)).collect()]
    parts = [spark.table("uneven").filter(p).count() for p in range_predicates("k", bounds)]
    assert sum(parts) == 41 and max(parts) <= 11
    assert "MOD" not in bounds_query("t", "k", 4) + " ".join(range_predicates("k", bounds))


def test_watermark_is_typed_and_never_regresses(spark, tmp_path):
    state = str(tmp_path)
    assert get_watermark(spark, state, "t", TimestampType()) == Watermark("1900-01-01", 0)
    commit_watermark(spark, state, "n", Watermark("9", 1), "a")
    commit_watermark(spark, state, "n", Watermark("10", 2), "b")
    commit_watermark(spark, state, "n", Watermark("2", 5), "c")
    assert get_watermark(spark, state, "n", IntegerType()) == Watermark("10", 2)
    commit_watermark(spark, state, "d", Watermark("2025-10-07", 3), "a")
    marks = watermark_table(spark, state, {"d": DateType(), "n": IntegerType(), "x": DateType()})
    assert values(marks) == [("d", "2025-10-07"), ("n", "10"), ("x", "1900-01-01")]


def test_bronze_is_dated_and_append_only(spark, source, tmp_path):
    folder = bronze_folder(str(tmp_path), "T", "run1", datetime(2025, 10, 7, 1, 2, 3))
    assert folder == f"{tmp_path}/T/2025-10-07/T_20251007_010203_run1"
    assert land_bronze(source, folder, "at", "2025-01-03")[:2] == (4, 1)
    other = source.filter("id = 1").withColumn("new", source["id"])
    land_bronze(other, bronze_folder(str(tmp_path), "T", "run2"), "at", "2025-01-01")
    with pytest.raises(Exception):
        land_bronze(source, folder, "at", "2025-01-03")
    back = read_bronze(spark, str(tmp_path), "T", StructType.fromDDL("id int, at timestamp, new int"))
    assert back.count() == 5
    assert back.columns == ["id", "at", "new", "_rescued_data"]
    assert [r["new"] for r in back.filter("new IS NOT NULL").collect()] == [1]


def test_control_list(spark, tmp_path):
    entries = [
        {"schema": "dbo", "table": "DimUser", "cdc_col": "updated_at", "from_date": ""},
        {"schema": "sales", "table": "Other", "cdc_col": "changed", "from_date": "2024-01-01"},
    ]
    (tmp_path / "tables.json").write_text(json.dumps(entries, indent=2))
    user, other = load_specs(spark, f"{tmp_path}/tables.json", MODEL)
    assert user == MODEL["DimUser"] and user.qualified == "dbo.DimUser"
    assert other == TableSpec("Other", "changed", schema="sales", from_date="2024-01-01")


def test_unknown_dedupe_is_refused():
    with pytest.raises(ValueError):
        TableSpec("t", "c", dedupe="sometimes")


def test_missing_folder_is_empty_but_corruption_is_not_hidden(spark, tmp_path):
    assert read_or_empty(spark, f"{tmp_path}/none", "x int").collect() == []
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, f"{tmp_path}/bad", "x int").collect()


def test_table_metadata(spark, rows):
    write_table(rows("x int", (1,)), "gold_t", "It's a table", {"quality": "gold"})
    write_table(rows("x int", (2,), (3,)), "gold_t", "It's a table", {"quality": "gold"})
    assert read_table(spark, "gold_t").count() == 2
    shown = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED gold_t").collect()}
    assert shown["Comment"] == "It's a table" and "quality=gold" in shown["Table Properties"]
    create_target(spark, "gold_t", StructType.fromDDL("y int"))
    create_target(spark, "target_t", StructType.fromDDL("y int"), "declared")
    assert read_table(spark, "gold_t").columns == ["x"] and read_table(spark, "target_t").columns == ["y"]
