import random
from datetime import datetime, timedelta

from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.scd import closed_intervals, current, scd1, scd2, with_current_flag

T0 = datetime(2025, 1, 1)
SCHEMA = "k int, tier string, country string, name string, at timestamp"


def t(n):
    return T0 + timedelta(hours=n)


def row(k, tier, n, country="US", name="x"):
    return (k, tier, country, name, t(n))


def expected(log):
    """Versions by walking each key's rows in order."""
    unique = {}
    for r in log:
        key = (r[0], r[4])
        unique[key] = max(unique.get(key, r), r, key=lambda x: tuple((v is not None, str(v)) for v in x[1:4]))
    by_key = {}
    for r in sorted(unique.values(), key=lambda r: (str(r[0]), r[4])):
        by_key.setdefault(r[0], []).append(r)
    out = []
    for versions in by_key.values():
        mine = []
        for r in versions:
            if mine and mine[-1][0][1:3] == r[1:3]:
                mine[-1][0] = r
            else:
                if mine:
                    mine[-1][2] = r[4]
                mine.append([r, r[4], None])
        out += [(*r, start, end) for r, start, end in mine]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def history(spark, log, **options):
    df = spark.createDataFrame(log, SCHEMA)
    return scd2(df, ["k"], ["at"], ["tier", "country"], **options)


def intervals(df):
    return [(r["tier"], r["__START_AT"], r["__END_AT"]) for r in df.orderBy("k", "__START_AT").collect()]


def test_version_opens_on_tracked_change_only(spark):
    log = [row(1, "Free", 1), row(1, "Free", 5), row(1, "Premium", 10), row(1, "Free", 20)]
    assert intervals(history(spark, log)) == [
        ("Free", t(1), t(10)),
        ("Premium", t(10), t(20)),
        ("Free", t(20), None),
    ]


def test_late_row_splits_history(spark):
    log = [row(1, "Free", 1), row(1, "Premium", 20), row(1, "Family", 10)]
    assert intervals(history(spark, log)) == [
        ("Free", t(1), t(10)),
        ("Family", t(10), t(20)),
        ("Premium", t(20), None),
    ]


def test_untracked_change_updates_open_version(spark):
    log = [row(1, "Free", 1, name="old"), row(1, "Free", 2, name="new")]
    (only,) = history(spark, log).collect()
    assert (only["name"], only["at"], only["__START_AT"], only["__END_AT"]) == ("new", t(2), t(1), None)


def test_null_equals_null(spark):
    log = [row(1, "Free", 1, None), row(1, "Free", 2, None), row(1, "Free", 3, "US")]
    assert [(s, e) for _, s, e in intervals(history(spark, log))] == [(t(1), t(3)), (t(3), None)]


def test_redelivered_and_conflicting_copies(spark):
    log = [row(1, "Free", 1), row(1, "Free", 1), row(1, "Premium", 2), row(1, "Family", 2)]
    assert intervals(history(spark, log)) == [("Free", t(1), t(2)), ("Premium", t(2), None)]


def test_empty_log(spark):
    assert history(spark, []).collect() == []


def test_hot_keys_in_pieces_give_the_same_versions(spark):
    rng = random.Random(3)
    log = [
        row(rng.choice([None, 1, 1, 1, 2, 3, 4]), rng.choice("AB"), rng.randrange(400), rng.choice(["x", None]), str(i))
        for i in range(600)
    ]
    log += [log[5]] * 200
    whole = values(history(spark, log))
    assert whole == expected(log)
    for hot_rows in (5, 40, 250):
        assert values(history(spark, log, hot_rows=hot_rows)) == whole


def test_hot_key_is_spread_over_tasks(spark):
    log = [row(1, "AB"[i % 2], i, name=str(i)) for i in range(400)] + [row(2, "A", 1)]
    result = history(spark, log, hot_rows=50)
    assert values(result) == expected(log)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # or it gathers so few rows into one task
    try:
        tasks = result.filter("k = 1").groupBy(F.spark_partition_id()).count()
        assert tasks.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


_rows = st.lists(
    st.tuples(
        st.integers(1, 3),
        st.sampled_from(["A", "B", None]),
        st.sampled_from(["X", "Y"]),
        st.sampled_from(["p", "q"]),
        st.integers(0, 12).map(t),
    ),
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(log=_rows, data=st.randoms(use_true_random=False))
def test_versions_match_a_walk_in_any_arrival_order(spark, log, data):
    wanted = expected(log)
    assert values(history(spark, log)) == wanted
    data.shuffle(log)
    got = history(spark, log, hot_rows=4).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: tuple((v is None, str(v)) for v in r)) == wanted
    for k in {r["k"] for r in got}:
        mine = sorted((r for r in got if r["k"] == k), key=lambda r: r["__START_AT"])
        assert [r["__END_AT"] for r in mine[:-1]] == [r["__START_AT"] for r in mine[1:]]
        assert mine[-1]["__END_AT"] is None
        assert all((a["tier"], a["country"]) != (b["tier"], b["country"]) for a, b in zip(mine, mine[1:]))


def test_scd1_ignores_arrival_order(spark):
    df = spark.createDataFrame([row(1, "new", 9), row(1, "old", 2), row(2, "z", 1)], SCHEMA)
    assert [(r["k"], r["tier"]) for r in scd1(df, ["k"], ["at"]).orderBy("k").collect()] == [(1, "new"), (2, "z")]


def test_current_views(spark):
    versions = history(spark, [row(1, "Free", 1), row(1, "Premium", 2)])
    assert [r["tier"] for r in current(versions).collect()] == ["Premium"]
    assert sorted(r["__IS_CURRENT"] for r in with_current_flag(versions).collect()) == [False, True]
    closed = closed_intervals(versions).orderBy("valid_from").collect()
    assert [(r["is_current"], str(r["valid_to"])) for r in closed] == [
        (False, str(t(2))),
        (True, "9999-12-31 23:59:59"),
    ]


def test_ordinary_keys_need_one_shuffle_and_one_sort(spark, tmp_path):
    spark.createDataFrame([row(1, "Free", 1)], SCHEMA).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    plan = scd2(log, ["k"], ["at"], ["tier"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1
