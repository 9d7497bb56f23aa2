import json

from pyspark.sql.types import StructType
from conftest import values

from tidemark.sources.schemas import conform, evolve, merge_schemas, registered_schema

DECLARED = StructType().add("id", "integer").add("v", "integer")


def test_new_columns_are_added_and_known_types_stay(spark, tmp_path):
    registry = str(tmp_path)
    assert registered_schema(spark, registry, "t") is None
    first = evolve(spark, registry, "t", StructType.fromDDL("id int, v int"), DECLARED)
    again = evolve(spark, registry, "t", StructType.fromDDL("v string, id int"), DECLARED)
    wider = evolve(spark, registry, "t", StructType.fromDDL("id int, v int, w string, _rescued_data string"))
    assert first == again == DECLARED
    assert wider.names == ["id", "v", "w"]
    assert registered_schema(spark, registry, "t") == wider
    assert spark.read.parquet(f"{registry}/t").count() == 2


def test_merge_makes_columns_nullable():
    strict = StructType().add("id", "integer", nullable=False)
    assert all(f.nullable for f in merge_schemas(None, strict))


def test_conform_fills_missing_and_rescues_extra(rows):
    df = rows("id int, extra string", (1, "e"), (2, None))
    result = conform(df, DECLARED)
    assert result.columns == ["id", "v", "_rescued_data"]
    assert values(result) == [(1, None, '{"extra":"e"}'), (2, None, None)]


def test_conform_rescues_what_does_not_cast(rows):
    df = rows("id int, v string", (1, "7"), (2, "seven"), (3, None))
    assert values(conform(df, DECLARED)) == [(1, 7, None), (2, None, '{"v":"seven"}'), (3, None, None)]


def test_conform_rescues_what_a_cast_would_change(rows):
    df = rows("id int, v double", (1, 7.0), (2, 7.5), (3, 1e30))
    result = {r["id"]: (r["v"], r["_rescued_data"]) for r in conform(df, DECLARED).collect()}
    assert result[1] == (7, None)
    assert result[2] == (None, '{"v":"7.5"}')
    assert float(json.loads(result[3][1])["v"]) == 1e30


def test_conform_keeps_earlier_rescue(rows):
    df = rows("id int, v int, _rescued_data string", (1, 2, "old"))
    assert values(conform(df, DECLARED)) == [(1, 2, "old")]


def test_an_earlier_rescue_is_kept(rows):
    df = rows(
        "id int, v string, _rescued_data string",
        (1, "x", '{"old":"1"}'),
        (2, "y", '{"v":"first"}'),
        (3, "z", "no object"),
        (4, "5", '{"old":"2"}'),
        (5, "w", None),
    )
    assert [(r["id"], r["v"], json.loads(r["_rescued_data"])) for r in conform(df, DECLARED).orderBy("id").collect()] == [
        (1, None, {"old": "1", "v": "x"}),
        (2, None, {"v.earlier": "first", "v": "y"}),
        (3, None, {"_rescued_data": "no object", "v": "z"}),
        (4, 5, {"old": "2"}),
        (5, None, {"v": "w"}),
    ]
