import random

from conftest import values

from tidemark.operators.dedupe import dedupe_any, dedupe_first, dedupe_latest, dedupe_version

SCHEMA = "k int, seq int, v string"


def test_any_keeps_one_row_per_key(rows):
    df = rows(SCHEMA, (1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d"), (None, 2, "e"))
    assert sorted(str(r["k"]) for r in dedupe_any(df, ["k"]).collect()) == ["1", "2", "None"]


def test_first_latest_version(rows):
    df = rows(SCHEMA, (1, 2, "b"), (1, 1, "a"), (1, 2, "b"), (2, 5, None), (None, 3, "n"))
    assert values(dedupe_first(df, ["k"], ["seq"])) == [(1, 1, "a"), (2, 5, None), (None, 3, "n")]
    assert values(dedupe_latest(df, ["k"], ["seq"])) == [(1, 2, "b"), (2, 5, None), (None, 3, "n")]
    assert values(dedupe_version(df, ["k"], ["seq"])) == [
        (1, 1, "a"),
        (1, 2, "b"),
        (2, 5, None),
        (None, 3, "n"),
    ]


def test_ties_do_not_depend_on_order(spark):
    data = [(k, 7, f"v{i}") for k in range(5) for i in range(9)]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, SCHEMA).repartition(seed + 1)
        results.add((str(values(dedupe_latest(df, ["k"], ["seq"]))), str(values(dedupe_first(df, ["k"], ["seq"])))))
    assert len(results) == 1


def test_column_order_is_kept_and_keys_alone_work(rows):
    df = rows("v string, k int", ("a", 1), ("b", 1))
    assert dedupe_latest(df, ["k"], ["v"]).columns == ["v", "k"]
    assert values(dedupe_version(rows("k int", (1,), (1,), (2,)), ["k"], [])) == [(1,), (2,)]


def test_copies_are_reduced_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("cast(0 as int) AS k", "id AS seq", "'x' AS v")
    plan = dedupe_latest(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "partial_max" in plan[exchange:]
