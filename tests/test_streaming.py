from datetime import datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.dedupe import dedupe_stream
from tidemark.operators.quality import apply_rules, expect, expect_or_drop
from tidemark.operators.scd import scd1, scd2
from tidemark.sources.control import TableSpec
from tidemark.streaming import dimensions
from tidemark.streaming.dimensions import DimensionStore
from tidemark.streaming.files import (
    append_stream,
    available_now,
    await_all,
    counted_sink,
    rule_totals,
    stream_files,
    stream_table,
)
from tidemark.streaming.silver import append_unseen, read_silver, run_silver

SCHEMA = StructType().add("k", "integer").add("tier", "string").add("at", "timestamp")
T0 = datetime(2025, 1, 1)


def t(n):
    return T0 + timedelta(days=n)


class Lake:
    """A bronze folder that batches are dropped into, and a silver copy brought up to date on demand."""

    def __init__(self, spark, base):
        self.spark, self.base, self.batches = spark, str(base), 0

    def drop(self, data, schema=SCHEMA):
        self.batches += 1
        df = self.spark.createDataFrame(data, schema)
        df.coalesce(1).write.parquet(f"{self.base}/bronze/t/2025-01-{self.batches:02d}/batch")

    def source(self, schema=SCHEMA, **options):
        return stream_files(self.spark, f"{self.base}/bronze/t", schema, **options)

    def run(self, df, out="silver", **options):
        query = append_stream(df, f"{self.base}/{out}/data", f"{self.base}/{out}/checkpoint", **options)
        await_all([query])
        return query

    def read(self, schema=SCHEMA, out="silver"):
        return self.spark.read.schema(schema).parquet(f"{self.base}/{out}/data")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_nested_files_arrive_once(lake):
    lake.drop([(1, "Free", t(1))])
    lake.run(lake.source())
    lake.drop([(2, "Free", t(2))])
    lake.run(lake.source(max_files=1))
    lake.run(lake.source())
    assert lake.read().count() == 2


@pytest.mark.parametrize("spread", [1, 16])
def test_dedupe_by_key_and_by_version(lake, spread):
    lake.drop([(1, "Free", t(1)), (1, "Free", t(1)), (2, "Free", t(1))])
    for out, keys in (("by_key", ["k"]), ("by_version", ["k", "at"])):
        lake.run(dedupe_stream(lake.source(), keys, spread=spread), out)
    lake.drop([(1, "Premium", t(2)), (2, "Free", t(1))])
    for out, keys in (("by_key", ["k"]), ("by_version", ["k", "at"])):
        lake.run(dedupe_stream(lake.source(), keys, spread=spread), out)
    assert values(lake.read(out="by_key")) == [(1, "Free", t(1)), (2, "Free", t(1))]
    assert values(lake.read(out="by_version")) == [
        (1, "Free", t(1)),
        (1, "Premium", t(2)),
        (2, "Free", t(1)),
    ]


def test_dedupe_with_bounded_state(lake):
    lake.drop([(1, "Free", t(1)), (1, "Free", t(1))])
    lake.run(dedupe_stream(lake.source(), ["k"], "at", "30 days"))
    lake.drop([(1, "Free", t(2)), (2, "Free", t(2))])
    query = lake.run(dedupe_stream(lake.source(), ["k"], "at", "30 days"))
    assert sorted(r["k"] for r in lake.read().collect()) == [1, 2]
    assert query.exception() is None


def test_a_wider_schema_on_restart_adds_a_column(lake):
    wide = StructType([*SCHEMA.fields]).add("country", "string")
    lake.drop([(1, "Free", t(1))])
    lake.run(dedupe_stream(lake.source(), ["k", "at"]))
    lake.drop([(2, "Free", t(2), "US")], wide)
    lake.run(dedupe_stream(lake.source(wide), ["k", "at"]))
    assert values(lake.read(wide)) == [(1, "Free", t(1), None), (2, "Free", t(2), "US")]


def test_catalog_table_grows_and_can_be_streamed(spark, lake):
    wide = StructType([*SCHEMA.fields]).add("country", "string")
    lake.drop([(1, "Free", t(1))])
    lake.run(lake.source(), table="silver_t")
    lake.drop([(2, "Free", t(2), "US")], wide)
    lake.run(lake.source(wide), table="silver_t")
    assert "country" in spark.read.table("silver_t").columns
    assert spark.read.table("silver_t").count() == 2
    lake.run(stream_table(spark, "silver_t").select("k"), "copy")
    assert values(lake.read(StructType([SCHEMA["k"]]), "copy")) == [(1,), (2,)]


RULES = [expect("has_tier", "tier IS NOT NULL"), expect_or_drop("positive", "k > 0")]


def test_rules_are_observed_on_a_stream(lake):
    lake.drop([(1, None, t(1)), (0, "Free", t(1)), (None, "Free", t(1))])
    valid, nothing = apply_rules(lake.source(), RULES, "t_rules")
    query = lake.run(valid)
    assert nothing is None
    assert query.lastProgress.observedMetrics["t_rules"].asDict() == {"rows": 3, "has_tier": 1, "positive": 2}
    assert values(lake.read()) == [(1, None, t(1))]


def test_rules_are_counted_over_all_batches(spark, lake, monkeypatch):
    """More batches than a query keeps progress for, a repeated batch, and a stream that starts anew."""
    landed = []
    for n in range(6):
        lake.drop([(n, None if n % 2 else "Free", t(1))])
    counts, checkpoint = f"{lake.base}/counts", f"{lake.base}/checkpoint"
    sink = counted_sink(RULES, "t", counts, checkpoint, lambda batch, number: landed.append(batch.count()))
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = available_now(lake.source(max_files=1), checkpoint).foreachBatch(sink).start()
        await_all([query])
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert len(query.recentProgress) <= 2 and len(landed) == 6 and sum(landed) == 5
    expected = [("t", "has_tier", "warn", 3, 3), ("t", "positive", "drop", 5, 1)]
    assert values(rule_totals(spark, counts)) == expected
    sink(spark.createDataFrame([(5, None, t(1))], SCHEMA), 5)  # the last batch comes again
    assert sum(r["passed"] + r["failed"] for r in rule_totals(spark, counts).collect()) == 12
    again = f"{lake.base}/other"
    sink = counted_sink(RULES, "t", counts, again, lambda batch, number: None)
    await_all([available_now(lake.source(), again).foreachBatch(sink).start()])
    assert sum(r["passed"] + r["failed"] for r in rule_totals(spark, counts).collect()) == 24


def test_a_failing_stream_fails_the_wait(spark, lake):
    lake.drop([(1, "Free", t(1))])
    good = append_stream(lake.source(), f"{lake.base}/a/data", f"{lake.base}/a/checkpoint")
    bad = available_now(lake.source(), f"{lake.base}/b/checkpoint").foreachBatch(_explode).start()
    with pytest.raises(Exception, match="boom"):
        await_all([bad, good])
    assert lake.read(out="a").count() == 1


def _explode(batch, number):
    raise RuntimeError("boom")


def test_append_unseen_is_repeatable(spark, tmp_path):
    path = f"{tmp_path}/fact"
    first = [(1, "a", t(1)), (1, "a", t(1)), (2, "b", t(2)), (None, "n", t(2)), (3, "x", None)]
    append_unseen(spark.createDataFrame(first, SCHEMA), path, ["k"], "at")
    append_unseen(spark.createDataFrame(first, SCHEMA), path, ["k"], "at")
    append_unseen(spark.createDataFrame([(2, "b", t(2)), (2, "b", t(3))], SCHEMA), path, ["k"], "at")
    assert values(spark.read.parquet(path).select("k", "tier", "at")) == [
        (1, "a", t(1)),
        (2, "b", t(2)),
        (2, "b", t(3)),
        (3, "x", None),
        (None, "n", t(2)),
    ]


def test_append_unseen_by_key(spark, tmp_path):
    path = f"{tmp_path}/fact"
    append_unseen(spark.createDataFrame([(1, "a", t(1)), (1, "b", t(2)), (5, "c", t(2))], SCHEMA), path, ["k"], "at", True)
    again = [(1, "late", t(9)), (3, "new", t(1)), (None, "n", t(1)), (5, "c", t(2))]
    append_unseen(spark.createDataFrame(again, SCHEMA), path, ["k"], "at", True)
    append_unseen(spark.createDataFrame(again, SCHEMA), path, ["k"], "at", True)
    assert values(spark.read.parquet(path).select("k", "tier", "at")) == [
        (1, "b", t(2)),
        (3, "new", t(1)),
        (5, "c", t(2)),
        (None, "n", t(1)),
    ]


@pytest.mark.parametrize("tracked", [(), ("tier",)])
def test_store_survives_a_new_checkpoint(spark, lake, tracked):
    store = DimensionStore(f"{lake.base}/store", ("k",), ("at",), tracked, buckets=3)
    for n, part in enumerate((LOG[:4], LOG[4:])):
        lake.drop(part)
        checkpoint = f"{lake.base}/checkpoint-{n}"  # a new one each time, so batches are numbered from 0 again
        await_all([available_now(lake.source(), checkpoint).foreachBatch(store.sink(checkpoint)).start()])
    log = spark.createDataFrame(LOG, SCHEMA)
    whole = scd2(log, ["k"], ["at"], ["tier"]) if tracked else scd1(log, ["k"], ["at"])
    assert values(store.read(spark, SCHEMA)) == values(whole)


def test_store_refuses_another_layout(spark, tmp_path):
    DimensionStore(f"{tmp_path}/s", ("k",), ("at",), ("tier",), buckets=3).apply(spark.createDataFrame(LOG, SCHEMA), "a")
    for other in ({"buckets": 4}, {"track": ()}, {"keys": ("tier",)}):
        store = DimensionStore(f"{tmp_path}/s", **{"keys": ("k",), "sequence_by": ("at",), "track": ("tier",), "buckets": 3, **other})
        with pytest.raises(ValueError, match="opened as"):
            store.apply(spark.createDataFrame(LOG, SCHEMA), "b")


def test_store_stays_small_over_many_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dimensions, "LOG_RUNS", 4)
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at",), ("tier",), buckets=2)
    rows, files = [], []
    for run in range(12):
        part = [(k, "AB"[(run + k) % 2], t(run)) for k in range(4)]
        rows += part
        store.apply(spark.createDataFrame(part, SCHEMA), f"s/{run}")
        files.append(sum(p.suffix == ".parquet" for p in tmp_path.rglob("*")))
    assert values(store.read(spark, SCHEMA)) == values(scd2(spark.createDataFrame(rows, SCHEMA), ["k"], ["at"], ["tier"]))
    assert max(files[6:]) <= max(files[:6]) + 4
    for run in range(12):  # batches of compacted runs are still known
        store.apply(spark.createDataFrame([(9, "Z", t(99))], SCHEMA), f"s/{run}")
    assert store.read(spark, SCHEMA).filter("k = 9").count() == 0


@pytest.mark.parametrize("dedupe", ["version", "unseen", "unseen_key", "key", "none"])
def test_run_silver(spark, lake, dedupe):
    spec = TableSpec("t", "at", keys=("k",), sequence=("at",), dedupe=dedupe)
    for batch in ([(1, "Free", t(1)), (1, "Free", t(1))], [(1, "Free", t(1)), (1, "Premium", t(2))]):
        lake.drop(batch)
        run_silver(spark, [spec], {"t": SCHEMA}, f"{lake.base}/bronze", f"{lake.base}/silver")
    rows = read_silver(spark, spec, SCHEMA, f"{lake.base}/silver").count()
    assert rows == {"version": 2, "unseen": 2, "unseen_key": 1, "key": 1, "none": 4}[dedupe]


LOG = [
    (k, tier, t(n))
    for k, tier, n in [
        (1, "Free", 1),
        (1, "Premium", 20),
        (2, "Free", 3),
        (1, "Family", 10),
        (3, "A", 4),
        (2, "Free", 1),
        (None, "A", 2),
        (1, "Family", 12),
        (3, "A", 9),
        (None, "B", 1),
    ]
]


@pytest.mark.parametrize("cuts, backwards", [([10], False), ([3, 10], True), ([2, 6, 10], False)])
def test_history_by_batches_equals_history_at_once(spark, tmp_path, cuts, backwards):
    log = LOG[::-1] if backwards else LOG
    store = DimensionStore(f"{tmp_path}/store", ("k",), ("at",), ("tier",), buckets=3)
    start = 0
    for run, end in enumerate(cuts):
        batch = spark.createDataFrame(log[start:end], SCHEMA)
        store.apply(batch, f"s/{run}")
        store.apply(batch, f"s/{run}")  # a repeated batch changes nothing
        start = end
    whole = scd2(spark.createDataFrame(log, SCHEMA), ["k"], ["at"], ["tier"])
    assert values(store.read(spark, SCHEMA)) == values(whole)


def test_latest_rows_by_batches_equal_latest_at_once(spark, tmp_path):
    store = DimensionStore(f"{tmp_path}/store", ("k",), ("at",), buckets=3)
    for run, part in enumerate((LOG[:4], LOG[4:7], LOG[7:7], LOG[7:])):
        store.apply(spark.createDataFrame(part, SCHEMA), f"s/{run}")
        store.apply(spark.createDataFrame(part, SCHEMA), f"s/{run}")
    whole = scd1(spark.createDataFrame(LOG, SCHEMA), ["k"], ["at"])
    assert values(store.read(spark, SCHEMA)) == values(whole)


def test_history_survives_a_run_that_died(spark, tmp_path, monkeypatch):
    store = DimensionStore(f"{tmp_path}/store", ("k",), ("at",), ("tier",), buckets=2)
    store.apply(spark.createDataFrame(LOG[:5], SCHEMA), "s/0")
    before = values(store.read(spark, SCHEMA))

    real = DimensionStore._write

    def dies_after_rows(self, df, folder):
        real(self, df, folder)
        if "/rows/" in folder:
            raise RuntimeError("lost")

    monkeypatch.setattr(DimensionStore, "_write", dies_after_rows)
    with pytest.raises(RuntimeError):
        store.apply(spark.createDataFrame(LOG[5:], SCHEMA), "s/1")
    monkeypatch.setattr(DimensionStore, "_write", real)
    assert values(store.read(spark, SCHEMA)) == before

    store.apply(spark.createDataFrame(LOG[5:], SCHEMA), "s/1")
    whole = scd2(spark.createDataFrame(LOG, SCHEMA), ["k"], ["at"], ["tier"])
    assert values(store.read(spark, SCHEMA)) == values(whole)


def test_history_from_a_stream(spark, lake):
    store = DimensionStore(f"{lake.base}/store", ("k",), ("at",), ("tier",), buckets=4)
    for part in (LOG[:4], LOG[4:]):
        lake.drop(part)
        checkpoint = f"{lake.base}/history-checkpoint"
        await_all([available_now(lake.source(), checkpoint).foreachBatch(store.sink(checkpoint)).start()])
    whole = scd2(spark.createDataFrame(LOG, SCHEMA), ["k"], ["at"], ["tier"])
    assert values(store.read(spark, SCHEMA)) == values(whole)
    assert store.read(spark, SCHEMA).filter(F.col("__END_AT").isNull()).count() == 4
