"""The key index of a table, the cursor over landed batches, and reads that are narrowed at their source."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructType, TimestampType

from tidemark.operators.joins import join_using
from tidemark.plans import ingest
from tidemark.plans.ingest import LakePaths, ingest_all
from tidemark.sources import extract
from tidemark.sources.bronze import read_bronze
from tidemark.sources.commits import CommitLog, ConcurrentCommit
from tidemark.sources.control import TableSpec
from tidemark.sources.extract import RelationalSource, bounds_query, range_predicates, since_sql
from tidemark.sources.tables import publish_table, write_table
from tidemark.streaming import keyindex, landed, silver
from tidemark.streaming.keyindex import KeyIndex
from tidemark.streaming.landed import LandedFolders
from tidemark.streaming.silver import append_unseen

SCHEMA = StructType().add("id", "long").add("v", "string").add("at", "timestamp")
T0 = datetime(2025, 1, 1)


def t(n):
    return T0 + timedelta(days=n)


# ---- key index -----------------------------------------------------------------------------------------------------
def first_landed(batches):
    """What a table has after these batches: of each id the row that landed first, in a batch the latest."""
    table = {}
    for batch in batches:
        best = {}
        for row in batch:
            if row[0] not in best or (row[2] is not None, row[2], row[1]) > (best[row[0]][2] is not None, best[row[0]][2], best[row[0]][1]):
                best[row[0]] = row
        for key, row in best.items():
            table.setdefault(key, row)
    return sorted(table.values(), key=lambda r: (r[0] is None, str(r[0])))


def test_random_ids_land_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "INDEX_RUNS", 2)
    rng, path, batches = random.Random(1), f"{tmp_path}/fact", []
    for n in range(6):
        ids = [rng.choice([None, *range(40), rng.getrandbits(60)]) for _ in range(12)]
        batches.append([(i, f"{n}-{k}", t(rng.randrange(5))) for k, i in enumerate(ids)])
        df = spark.createDataFrame(batches[-1], SCHEMA)
        for _ in range(1 + n % 2):  # some batches come again
            append_unseen(df, path, ["id"], "at", by_key=True)
    got = sorted((tuple(r) for r in spark.read.parquet(path).select("id", "v", "at").collect()), key=lambda r: (r[0] is None, str(r[0])))
    assert got == first_landed(batches)


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/fact"
    rows = [(random.Random(i).getrandbits(62), "x", t(i % 7)) for i in range(2000)]
    append_unseen(spark.createDataFrame(rows, SCHEMA), path, ["id"], "at", by_key=True)
    index = KeyIndex(f"{path}_keys", ("id",), SCHEMA)
    few = spark.createDataFrame([rows[3], (5, "new", t(1))], SCHEMA)
    found = index.unseen(few)
    assert [r["id"] for r in found.collect()] == [5]
    plan = found._jdf.queryExecution().executedPlan().toString()
    touched = [r[0] for r in few.select(F.pmod(F.hash("id"), F.lit(index.buckets))).distinct().collect()]
    assert "PartitionFilters: [bucket" in plan and all("/fact_keys/keys/" in f for f in found.inputFiles())
    scanned = spark.read.option("basePath", f"{path}_keys/keys").parquet(f"{path}_keys/keys").filter(F.col("bucket").isin(touched))
    assert len(touched) <= 2 and scanned.count() < 100


@pytest.mark.parametrize("appended", [False, True])
def test_an_append_that_died_is_settled(spark, tmp_path, monkeypatch, appended):
    path, first, second = f"{tmp_path}/fact", [(1, "a", t(1)), (2, "b", t(2))], [(2, "late", t(9)), (3, "c", t(3)), (4, "d", None)]
    append_unseen(spark.createDataFrame(first, SCHEMA), path, ["id"], "at", by_key=True)
    real = silver._append_days

    def dies(fresh, path, keys):
        if appended:
            real(fresh.filter("id = 3"), path, keys)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(silver, "_append_days", dies)
        with pytest.raises(RuntimeError):
            append_unseen(spark.createDataFrame(second, SCHEMA), path, ["id"], "at", by_key=True)
    for _ in range(2):
        append_unseen(spark.createDataFrame(second, SCHEMA), path, ["id"], "at", by_key=True)
    assert values(spark.read.parquet(path).select("id", "v")) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_an_index_is_built_for_a_table_that_has_none(spark, tmp_path):
    path = f"{tmp_path}/fact"
    append_unseen(spark.createDataFrame([(1, "a", t(1))], SCHEMA), path, ["id"], "at")
    append_unseen(spark.createDataFrame([(1, "again", t(2)), (2, "b", t(2))], SCHEMA), path, ["id"], "at", by_key=True)
    assert values(spark.read.parquet(path).select("id", "v")) == [(1, "a"), (2, "b")]


# ---- landed batches ------------------------------------------------------------------------------------------------
def drop(spark, base, day, name, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.parquet(f"{base}/t/{day}/{name}")


def test_only_days_from_the_cursor_on_are_listed(spark, tmp_path, monkeypatch):
    """A thousand old batches, of which a later run lists none."""
    for n in range(1000):
        folder = tmp_path / "t" / f"2024-{1 + n // 250:02d}-{1 + n // 10 % 25:02d}" / f"t_{n:04d}"
        folder.mkdir(parents=True)
        (folder / "_SUCCESS").touch()
    drop(spark, tmp_path, "2025-01-01", "t_a", (1, "a", t(0)))
    source, got = LandedFolders(f"{tmp_path}/t", f"{tmp_path}/cursor"), []
    assert source.run(spark, SCHEMA, lambda batch, _: got.extend(batch.collect())) == 1001
    assert [r["id"] for r in got] == [1]
    listed, real = [], landed.children
    monkeypatch.setattr(landed, "children", lambda spark, path: listed.append(path) or real(spark, path))
    drop(spark, tmp_path, "2025-01-02", "t_b", (2, "b", t(1)))
    assert source.run(spark, SCHEMA, lambda batch, _: got.extend(batch.collect())) == 1
    assert [r["id"] for r in got] == [1, 2]
    assert len({p for p in listed if p != f"{tmp_path}/t"}) <= landed.OVERLAP + 1
    assert len(str(CommitLog(f"{tmp_path}/cursor").latest(spark)[1])) < 2000


def test_batches_of_a_day_and_late_ones_are_found_once(spark, tmp_path):
    source, got = LandedFolders(f"{tmp_path}/t", f"{tmp_path}/cursor"), []
    land = lambda batch, _: got.append(sorted(r["id"] for r in batch.collect()))
    assert source.run(spark, SCHEMA, land) == 0
    drop(spark, tmp_path, "2025-01-02", "t_b", (2, "b", t(1)))
    source.run(spark, SCHEMA, land)
    drop(spark, tmp_path, "2025-01-01", "t_a", (1, "a", t(0)))  # an earlier day becomes whole later
    drop(spark, tmp_path, "2025-01-02", "t_a", (3, "c", t(1)))
    (tmp_path / "t" / "2025-01-02" / "t_z").mkdir()  # still being written
    source.run(spark, SCHEMA, land)
    assert source.run(spark, SCHEMA, land) == 0
    drop(spark, tmp_path, "2025-01-03", "t_d", (4, "d", t(2)))
    source.run(spark, SCHEMA, land)
    assert got == [[2], [1, 3], [4]]


def test_a_batch_is_split_and_a_failed_one_comes_again(spark, tmp_path):
    for n in range(5):
        drop(spark, tmp_path, f"2025-01-0{n + 1}", "t", (n, "x", t(n)))
    source, got = LandedFolders(f"{tmp_path}/t", f"{tmp_path}/cursor"), []

    def land(batch, number):
        if number == 1 and len(got) == 1:
            got.append("lost")
            raise RuntimeError("lost")
        got.append(sorted(r["id"] for r in batch.collect()))

    with pytest.raises(RuntimeError):
        source.run(spark, SCHEMA, land, most=2)
    assert source.run(spark, SCHEMA, land, most=2) == 3
    assert got == [[0, 1], "lost", [2, 3], [4]]


def test_of_two_runs_one_is_refused(spark, tmp_path):
    drop(spark, tmp_path, "2025-01-01", "t", (1, "x", t(0)))
    source = LandedFolders(f"{tmp_path}/t", f"{tmp_path}/cursor")
    with pytest.raises(ConcurrentCommit):
        source.run(spark, SCHEMA, lambda batch, _: source.run(spark, SCHEMA, lambda b, n: None))


# ---- narrowed reads ------------------------------------------------------------------------------------------------
def test_since_in_the_databases_own_words():
    moment, day = "2025-01-02 03:04:05.678", "2025-01-02"
    pg, ms = "jdbc:postgresql://h/d", "jdbc:sqlserver://h;d"
    assert since_sql(pg, "at", moment, TimestampType()) == f"at >= TIMESTAMP '{moment}' OR at IS NULL"
    assert since_sql(ms, "at", moment, TimestampType()) == f"at >= CAST('{moment}' AS datetime2) OR at IS NULL"
    assert since_sql("jdbc:oracle:thin:@h", "d", day, DateType()) == "d >= DATE '2025-01-02' OR d IS NULL"
    assert since_sql(ms, "d", day, DateType()) == "d >= CAST('2025-01-02' AS date) OR d IS NULL"
    assert since_sql(pg, "at", day, TimestampType()) == "at >= TIMESTAMP '2025-01-02 00:00:00' OR at IS NULL"
    assert since_sql(pg, "n", "17", IntegerType()) == "n >= 17 OR n IS NULL"
    assert since_sql(pg, "s", "o'clock", StringType()) == "s >= 'o''clock' OR s IS NULL"


class Database:
    """Stands in for a database: answers queries from a view, and remembers the ranges."""

    def __init__(self, spark):
        self.spark, self.parts = spark, []

    def jdbc(self, url, table, predicates=None, properties=None):
        rows = self.spark.sql(f"SELECT * FROM {table}") if table.startswith("(") else self.spark.table(table.split(".")[-1])
        if predicates is None:
            return rows
        self.parts = [rows.filter(p).count() for p in predicates]
        out = rows.filter(predicates[0])
        for p in predicates[1:]:
            out = out.unionAll(rows.filter(p))
        return out


@pytest.fixture
def changed(spark, monkeypatch):
    """A thousand rows of which the forty with the highest keys have changed."""
    data = [(i, f"v{i}", t(100) if i >= 960 else t(1)) for i in range(1000)] + [(None, "no key", t(100)), (5000, "no mark", None)]
    spark.createDataFrame(data, SCHEMA).createOrReplaceTempView("changed")
    database = Database(spark)
    monkeypatch.setattr(extract.SparkSession, "read", property(lambda self: database))
    yield database
    spark.catalog.dropTempView("changed")


def test_ranges_are_those_of_the_changed_rows(spark, changed):
    spec = TableSpec("changed", "at", schema="", keys=("id",), sequence=("at",))
    source = RelationalSource(spark, "jdbc:postgresql://h/d", partitions=4)
    whole = source(spec)
    got = source.since(spec, whole, "us:" + str(int((t(50) - datetime(1970, 1, 1)).total_seconds() * 1_000_000)))
    assert sorted((r["id"] is None, r["id"] or 0) for r in got.collect()) == [*((False, i) for i in range(960, 1000)), (False, 5000), (True, 0)]
    assert len(changed.parts) == 4 and max(changed.parts) <= 12
    plain = range_predicates("id", [249, 499, 749, 5000])
    assert max(spark.table("changed").filter(p).filter("at > '2025-02-01'").count() for p in plain) >= 40  # what it was before


def test_bounds_without_a_filter_are_as_before():
    assert "WHERE k IS NOT NULL)" in bounds_query("t", "k", 4) and "AND (a > 1)" in bounds_query("t", "k", 4, "a > 1")
    assert range_predicates("k", [1, 2], "a > 1") == ["(k <= 1 OR k IS NULL) AND (a > 1)", "(k > 1) AND (a > 1)"]


def test_an_ingest_reads_what_its_source_narrows(spark, tmp_path):
    class Source:
        asked = []

        def __call__(self, spec):
            return spark.createDataFrame([(n, "x", t(n)) for n in range(5)], SCHEMA)

        def since(self, spec, df, value):
            self.asked.append(value)
            return df

    spec, source = TableSpec("a", "at", keys=("id",), sequence=("at",)), Source()
    ingest_all(spark, [spec], source, LakePaths(str(tmp_path)))
    assert source.asked == ["1900-01-01"]
    assert ingest_all(spark, [spec], source, LakePaths(str(tmp_path))).first()["status"] == "EMPTY" and len(source.asked) == 1


# ---- publication ---------------------------------------------------------------------------------------------------
def test_a_table_is_pointed_at_whole_runs(spark, tmp_path, rows):
    name, path = "published_t", f"{tmp_path}/p"
    publish_table(rows("x int", (1,)), name, path, "first", {"quality": "gold"}, "1")
    publish_table(rows("x int", (9,)), name, path, "first", {"quality": "gold"}, "1")  # from the same: not written
    assert values(spark.read.table(name)) == [(1,)]
    held = spark.read.table(name)
    publish_table(rows("x int, y string", (2, "b")), name, path, "second", {"quality": "gold"}, "2")
    assert values(spark.read.table(name)) == [(2, "b")] and values(held) == [(1,)]
    shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert shown["Comment"] == "second" and "quality=gold" in shown["Table Properties"]


    broken = rows("x int, y string", (3, "c")).withColumn("x", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        publish_table(broken, name, path, "third", {}, "3")
    assert values(spark.read.table(name)) == [(2, "b")]


# ---- two ingests, and tables in buckets ----------------------------------------------------------------------------
def test_of_two_ingests_one_is_refused(spark, tmp_path, monkeypatch):
    """The other one starts and ends while the first is landing: no row lands twice and no mark is lost."""
    spec, paths = TableSpec("a", "at", keys=("id",), sequence=("at",)), LakePaths(str(tmp_path))
    rows = spark.createDataFrame([(n, "x", t(n)) for n in range(5)], SCHEMA)
    real, others = ingest.land_bronze, []

    def meanwhile(df, folder, cdc_col, high):
        if not others:
            others.append(None)
            others[0] = ingest_all(spark, [spec], {"a": rows}, paths).first()["status"]
        return real(df, folder, cdc_col, high)

    monkeypatch.setattr(ingest, "land_bronze", meanwhile)
    first = ingest_all(spark, [spec], {"a": rows}, paths).first()
    assert others == ["OK"] and first["status"] == "FAILED" and "ConcurrentCommit" in first["error"]
    landed = read_bronze(spark, paths.bronze, "a", SCHEMA)
    assert sorted(r["id"] for r in landed.collect()) == list(range(5))
    assert ingest_all(spark, [spec], {"a": rows}, paths).first()["status"] == "EMPTY"
    more = rows.unionAll(spark.createDataFrame([(9, "x", t(9))], SCHEMA))
    assert ingest_all(spark, [spec], {"a": more}, paths).first()["status"] == "OK"


def test_tables_in_buckets_meet_without_a_shuffle(spark, tmp_path):
    fact = spark.createDataFrame([(n, n % 7, float(n)) for n in range(100)], "f long, k long, x double")
    dim = spark.createDataFrame([(n, f"d{n}") for n in range(7)], "k long, name string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in (("fact_b", fact), ("dim_b", dim)):
            write_table(df, name, path=f"{tmp_path}/{name}", bucket_by=["k"], buckets=4)
        joined = join_using(spark.read.table("fact_b"), spark.read.table("dim_b"), "k").groupBy("k", "name").agg(F.sum("x").alias("x"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert values(joined) == values(join_using(fact, dim, "k").groupBy("k", "name").agg(F.sum("x").alias("x")))
        assert len(list((tmp_path / "fact_b").glob("*.parquet"))) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("fact_b", "dim_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
