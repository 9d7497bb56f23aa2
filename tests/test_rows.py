from conftest import values
from pyspark.sql import functions as F

from tidemark.functions import average, minutes
from tidemark.operators.aggregates import max_value, table_counts, value_counts
from tidemark.operators.rows import (
    clean_title,
    drop_columns,
    duration_flag,
    event_date,
    keep_in,
    keep_not_null,
    keep_positive,
    preview,
    ranked,
    search_rows,
    standardize_name,
    union_batches,
)


def test_drop_columns_ignores_missing_names(rows):
    df = rows("user_id int, user_name string, _rescued_data string", (1, "a", None))
    assert drop_columns(df, ["_rescued_data", "absent"]).columns == ["user_id", "user_name"]


def test_standardize_name_trims_spaces_only(rows):
    df = rows("user_name string", ("  ann ",), ("\tann",), (None,))
    assert [r[0] for r in standardize_name(df).collect()] == ["ANN", "\tANN", None]
    assert standardize_name(df, "absent").columns == df.columns


def test_clean_title(rows):
    df = rows("track_name string", ("-a-b-",), ("a--b",), (None,))
    assert [r[0] for r in clean_title(df).collect()] == ["a b", "a  b", None]
    assert clean_title(df, "absent").columns == df.columns


def test_duration_flag_bands(rows):
    df = rows("duration_sec int", (149,), (150,), (299,), (300,), (None,), (0,))
    flags = [r["durationFlag"] for r in duration_flag(df).collect()]
    assert flags == ["low", "medium", "medium", "high", "high", "low"]
    assert duration_flag(df, "absent").columns == df.columns
    assert [r["f"] for r in duration_flag(df, out="f", low=1, medium=2).collect()][-1] == "low"


def test_filters(rows):
    df = rows("id int, v int", (1, 1), (2, 0), (3, -1), (4, None))
    assert values(keep_positive(df, "v")) == [(1, 1)]
    assert values(keep_not_null(df, "v")) == [(1, 1), (2, 0), (3, -1)]
    assert values(keep_in(df, "v", [0, 1])) == [(1, 1), (2, 0)]


def test_event_date(rows):
    df = rows("ts string", ("2025-10-07 23:59:59",)).select(F.col("ts").cast("timestamp").alias("stream_timestamp"))
    assert str(event_date(df).first()["stream_date"]) == "2025-10-07"


def test_minutes_round_half_up(rows):
    df = rows("s double", (0.3,), (60.3,), (None,))
    assert [r[0] for r in df.select(minutes(F.col("s"))).collect()] == [0.01, 1.01, None]


def test_average_of_nothing_is_null(rows):
    df = rows("s bigint, n bigint", (3, 2), (None, 0))
    assert [r[0] for r in df.select(average(F.col("s"), F.col("n"))).collect()] == [1.5, None]


def test_search_rows_is_a_regex_over_all_columns(rows):
    df = rows("id int, a string, b string", (1, "Rock", None), (2, "jazz", "x"), (31, None, None))
    assert [r[0] for r in search_rows(df, "ROCK").collect()] == [1]
    assert [r[0] for r in search_rows(df, "^3|z{2}").collect()] == [2, 31]


def test_preview_and_ranked_break_ties_by_key(rows):
    df = rows("k int, m int", (3, 5), (1, 5), (2, 9), (4, None))
    assert [r["k"] for r in ranked(df, "m", ["k"], n=3).collect()] == [2, 1, 3]
    assert [r["k"] for r in ranked(df, "m", ["k"], ascending=True).collect()] == [4, 1, 3, 2]
    assert [r["k"] for r in preview(df, 2, ["k"]).collect()] == [1, 2]
    assert preview(df, 3).count() == 3


def test_union_batches_fills_missing_columns(rows):
    a, b = rows("x int, y string", (1, "p")), rows("x int", (2,))
    assert values(union_batches(a, b)) == [(1, "p"), (2, None)]


def test_value_counts_skip_null(rows):
    df = rows("g string", ("a",), ("b",), ("b",), (None,), ("c",))
    assert [tuple(r) for r in value_counts(df, "g").collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_table_counts_and_max(rows):
    df = rows("x int", (1,), (4,), (None,))
    assert values(table_counts({"a": df, "empty": df.filter("x > 9")})) == [("a", 3), ("empty", 0)]
    assert max_value(df, "x").first()[0] == 4
