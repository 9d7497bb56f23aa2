"""Every operator as a query over whole benchmark tables.

The tables stand in for the published model as follows: ``events`` and ``lineitem`` for facts, ``customer`` for users,
``part`` for items, ``supplier`` with ``nation`` for creators, and ``events`` keyed by user for a change feed.

Measures are doubles with two decimals there. They are summed as decimals, so that a sum does not depend on the order of
its addends, and shown as doubles.

Results whose order is part of the operator have a ``position``, taken from the order in which the rows come.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import minutes
from tidemark.operators.aggregates import max_value, table_counts, value_counts
from tidemark.operators.dedupe import dedupe_any, dedupe_first, dedupe_latest, dedupe_stream, dedupe_version
from tidemark.operators.joins import join_current, join_using, join_via
from tidemark.operators.quality import apply_rules, expect, expect_or_drop, keep_valid, quality_report
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
from tidemark.operators.scd import closed_intervals, current, scd1, scd2, with_current_flag
from tidemark.operators.star import StarEntry, star_join
from tidemark.plans.cycle import DAILY_TABLE, TOP_TABLE, run_cycle
from tidemark.plans.ingest import LakePaths, ingest_all
from tidemark.plans.marts import (
    daily_kpis,
    daily_metrics,
    tier_distribution,
    top_creators,
    top_creators_minutes,
)
from tidemark.plans.model import MODEL, star_query
from tidemark.session import fresh_dir, shared_dir
from tidemark.sources.bronze import bronze_folder, land_bronze, read_bronze
from tidemark.sources.control import TableSpec, load_specs
from tidemark.sources.extract import extract_from, extract_since, extract_window
from tidemark.sources.schemas import conform, evolve
from tidemark.sources.tables import create_target, delete_path, read_table, write_table
from tidemark.streaming.dimensions import DimensionStore
from tidemark.streaming.files import (
    append_stream,
    available_now,
    await_all,
    counted_sink,
    rule_totals,
    stream_files,
    stream_table,
    with_source_file,
)
from tidemark.streaming.silver import append_unseen, read_silver, run_silver

Query = Callable[[SparkSession, str], DataFrame]

_SPLIT = "2024-01-15 00:00:00"
_CHANGE_KEY = ("user_id",)
_CHANGE_ORDER = ("ts", "event_id")
_TRACKED = ("event_type",)

_RULES = (
    expect("valid_user_id", "user_id IS NOT NULL"),
    expect_or_drop("known_type", "event_type IN ('view', 'click', 'purchase', 'signup')"),
    expect_or_drop("positive_value", "value > 0"),
    expect("large_value", "value >= 150"),
)

_TIERS = {"view": "Free", "click": "Premium", "purchase": "Family", "signup": "Student", "error": "Unknown"}

_STAR = (
    StarEntry("lineitem", "f", ("f.l_orderkey", "f.l_linenumber", "f.l_quantity", "f.l_extendedprice")),
    StarEntry("orders", "o", ("o.o_orderstatus", "o.o_orderdate"), "f.l_orderkey = o.o_orderkey"),
    StarEntry("customer", "c", ("c.c_name", "c.c_mktsegment"), "o.o_custkey = c.c_custkey"),
    StarEntry("part", "p", ("p.p_name", "p.p_brand"), "f.l_partkey = p.p_partkey"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as listening facts, the value as seconds."""
    return event_date(_table(spark, sf_dir, "events"), "ts", "stream_date").select(
        F.col("event_id").alias("stream_id"),
        "user_id",
        F.col("value").cast("decimal(18,2)").alias("listen_duration"),
        "stream_date",
    )


def _positioned(df: DataFrame) -> DataFrame:
    """The place of each row in the order of the result, which is a short report."""
    return df.coalesce(1).withColumn("position", F.monotonically_increasing_id() + 1)


def _as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(_events(spark, sf_dir), _CHANGE_KEY, _CHANGE_ORDER, _TRACKED)


# ---- extraction ----------------------------------------------------------------------------------------------------


def _moment(spark: SparkSession, sf_dir: str) -> str:
    """The time of the event in the middle, so that one event lies right on it."""
    events = _events(spark, sf_dir)
    middle = events.agg(F.floor(F.max("event_id") / 2).alias("event_id"))
    return events.join(middle, "event_id").select(F.col("ts").cast("string")).first()[0]


def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_since(_events(spark, sf_dir), "ts", _moment(spark, sf_dir))


def backfill_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_from(_events(spark, sf_dir), "ts", _moment(spark, sf_dir))


def window_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_window(
        _table(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01 00:00:00", "1997-12-31 00:00:00"
    )


def watermark_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    return union_batches(
        *[
            max_value(_table(spark, sf_dir, t), c, "watermark").select(F.lit(t).alias("table_name"), "watermark")
            for t, c in marks.items()
        ]
    )


# ---- rows ----------------------------------------------------------------------------------------------------------


def drop_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(_table(spark, sf_dir, "events"), ["props", "_rescued_data"])


def standardize_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_name(_table(spark, sf_dir, "customer"), "c_name").select("c_custkey", "c_name")


def clean_title_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_title(_table(spark, sf_dir, "orders"), "o_orderpriority").select("o_orderkey", "o_orderpriority")


def duration_flag_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duration_flag(_events(spark, sf_dir), "value", "duration_flag").select(
        "event_id", "value", "duration_flag"
    )


def event_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_date(_events(spark, sf_dir), "ts", "event_date").select("event_id", "event_date")


def in_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_in(_events(spark, sf_dir), "event_type", ["view", "purchase"])


def not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that lost their user where they are errors."""
    user = F.when(F.col("event_type") != "error", F.col("user_id"))
    return keep_not_null(_events(spark, sf_dir).withColumn("user_id", user), "user_id")


def positive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_positive(_table(spark, sf_dir, "customer"), "c_acctbal")


def minutes_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _event_facts(spark, sf_dir).groupBy("user_id").agg(F.sum("listen_duration").alias("seconds"))
    return sums.select("user_id", minutes(F.col("seconds")).alias("total_minutes"))


def search_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_rows(_table(spark, sf_dir, "customer"), "build")


def preview_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positioned(preview(_table(spark, sf_dir, "orders"), 100, ["o_orderkey"]))


def union_batches_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    split = F.lit(_SPLIT).cast("timestamp_ntz")
    return union_batches(events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split).drop("props"))


# ---- joins ---------------------------------------------------------------------------------------------------------


def _orders_by_line(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), "o_orderpriority"
    )
    return lines, orders


def inner_join_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_using(*_orders_by_line(spark, sf_dir), "l_orderkey")


def bucketed_bridge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge join with lines and orders published in buckets of the order, so that neither is shuffled to meet."""
    base, suffix, tables = fresh_dir(spark, "buckets"), uuid.uuid4().hex[:8], []
    for name, df in zip(("lines", "orders"), _orders_by_line(spark, sf_dir)):
        tables.append(f"{name}_{suffix}")
        write_table(df, tables[-1], path=f"{base}/{name}", bucket_by=["l_orderkey"], buckets=16)
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    shared_dir(spark)
    rows = join_via(*(read_table(spark, t) for t in tables), customers, "l_orderkey", "c_custkey").checkpoint()
    for name in tables:
        spark.sql(f"DROP TABLE {name}")
    return rows


def bridge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = _orders_by_line(spark, sf_dir)
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return join_via(lines, orders, customers, "l_orderkey", "c_custkey")


def star_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_join(spark, _STAR, {e.table: _table(spark, sf_dir, e.table) for e in _STAR})


def join_current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = _history(spark, sf_dir).select(
        "user_id", F.col("event_type").alias("current_type"), "__START_AT", "__END_AT"
    )
    joined = join_current(_events(spark, sf_dir), now, "user_id")
    return joined.select("event_id", "user_id", "event_type", "current_type")


# ---- marts ---------------------------------------------------------------------------------------------------------


def daily_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(daily_metrics(_event_facts(spark, sf_dir)), "total_listen_seconds")


def daily_metrics_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = daily_metrics(_event_facts(spark, sf_dir), extended=True)
    return _as_double(_positioned(metrics), "total_listen_seconds")


def daily_kpis_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positioned(daily_kpis(daily_metrics(_event_facts(spark, sf_dir))))


def _creators(spark: SparkSession, sf_dir: str, n: int | None) -> DataFrame:
    """Lines as facts, their order as the item, the customer who placed it as the creator, nations as the label."""
    facts = _table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("stream_id"),
        F.col("l_orderkey").alias("track_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("listen_duration"),
    )
    items = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("track_id"), F.col("o_custkey").alias("artist_id")
    )
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("genre"))
    creators = (
        _table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("artist_id"), F.col("c_name").alias("artist_name"), "genre")
    )
    return top_creators(facts, items, creators, n=n)


def top_creators_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(_creators(spark, sf_dir, None), "total_listen_duration_sec")


def top_creators_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(_positioned(_creators(spark, sf_dir, 10)), "total_listen_duration_sec")


def top_creators_minutes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_creators_minutes(_creators(spark, sf_dir, None))
    return _as_double(_positioned(top), "total_listen_duration_sec")


def top_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The creator mart with the supplier straight on the fact: the item is its own bridge."""
    facts = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("stream_id"),
        F.col("l_suppkey").alias("track_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("listen_duration"),
    )
    suppliers = _table(spark, sf_dir, "supplier")
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("genre"))
    items = suppliers.select(F.col("s_suppkey").alias("track_id"), F.col("s_suppkey").alias("artist_id"))
    creators = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist_name"), "genre"
    )
    return _as_double(top_creators(facts, items, creators, n=10), "total_listen_duration_sec")


def tier_distribution_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _event_facts(spark, sf_dir)
    return tier_distribution(facts, _history(spark, sf_dir), tier="event_type")


def segment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.lit(None).cast("timestamp_ntz").alias("__END_AT")
    )
    return tier_distribution(orders, customers, user="c_custkey", tier="c_mktsegment", event="o_orderkey")


def value_counts_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(_table(spark, sf_dir, "events"), "event_type", "row_count")


def value_counts_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(_table(spark, sf_dir, "part"), "p_brand", "row_count")


def current_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(current(_history(spark, sf_dir)), "event_type", "row_count")


def table_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return table_counts({n: _table(spark, sf_dir, n) for n in names})


def top_creators_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top ten in chart order."""
    top = top_creators_ten(spark, sf_dir).drop("position")
    return _positioned(ranked(top, "total_streams", ["artist_id"], ascending=True))


# ---- dedupe --------------------------------------------------------------------------------------------------------


def dedupe_any_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_any(_events(spark, sf_dir), ["user_id"]).select("user_id")


def dedupe_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_first(_events(spark, sf_dir), _CHANGE_KEY, _CHANGE_ORDER)


def dedupe_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(_events(spark, sf_dir), _CHANGE_KEY, _CHANGE_ORDER)


def dedupe_version_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which a part was delivered twice."""
    events = _events(spark, sf_dir)
    again = extract_since(events, "ts", _SPLIT)
    return dedupe_version(union_batches(events, again), _CHANGE_KEY, _CHANGE_ORDER)


# ---- quality -------------------------------------------------------------------------------------------------------


def expect_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_events(spark, sf_dir), _RULES, "events")


def expect_or_drop_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(_events(spark, sf_dir), _RULES)


def expect_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, with the rules counted on the way past."""
    return apply_rules(_events(spark, sf_dir), _RULES, "events")[0]


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_date(keep_valid(_events(spark, sf_dir), _RULES), "ts", "stream_date")


# ---- slowly changing dimensions ------------------------------------------------------------------------------------


def scd1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return scd1(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)


def scd2_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log, arriving newest part first."""
    events = _events(spark, sf_dir)
    split = F.lit(_SPLIT).cast("timestamp_ntz")
    log = union_batches(events.filter(F.col("ts") >= split), events.filter(F.col("ts") < split))
    return scd2(log, _CHANGE_KEY, _CHANGE_ORDER, _TRACKED)


def scd2_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return scd2(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderpriority"])


def scd2_few_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys, each with a fifth of all rows, so every key is worked on in pieces, also in a small log."""
    return scd2(_events(spark, sf_dir), ["event_type"], _CHANGE_ORDER, ["user_id"], hot_rows=100)


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_current_flag(current(_history(spark, sf_dir))).drop("__END_AT")


def scd2_closed_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_intervals(_history(spark, sf_dir))


def history_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positioned(preview(_history(spark, sf_dir), 20, ["user_id", "__START_AT", "event_id"]))


# ---- streams -------------------------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return stream_files(spark, path, spark.read.parquet(path).schema)


def _landed(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Append a stream to files and read them back."""
    base = fresh_dir(spark, purpose)
    await_all([append_stream(rows, f"{base}/data", f"{base}/checkpoint")])
    return spark.read.schema(rows.schema).parquet(f"{base}/data")


def stream_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered twice, in different files."""
    events, base = _events(spark, sf_dir), fresh_dir(spark, "stream-twice")
    for name in ("first", "again"):
        events.write.parquet(f"{base}/{name}")
    arriving = stream_files(spark, base, events.schema)
    return _landed(spark, dedupe_stream(arriving, [*_CHANGE_KEY, *_CHANGE_ORDER]), "stream-silver")


def stream_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, apply_rules(_event_stream(spark, sf_dir), _RULES, "events")[0], "stream-quality")


def stream_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrival per user; which event arrives first is not determined, so only the users are shown."""
    return _landed(spark, dedupe_stream(_event_stream(spark, sf_dir), ["user_id"]), "stream-first").select("user_id")


def stream_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts appended by day; the second run finds all of them there already."""
    path = f"{fresh_dir(spark, 'stream-facts')}/data"
    for _ in range(2):
        sink = available_now(_event_stream(spark, sf_dir), fresh_dir(spark, "stream-facts-checkpoint"))
        await_all([sink.foreachBatch(lambda batch, _: append_unseen(batch, path, ["event_id"], "ts")).start()])
    return spark.read.parquet(path).select(*_events(spark, sf_dir).columns)


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History kept up to date batch by batch, the newer half of the log arriving first."""
    base = fresh_dir(spark, "stream-scd2")
    store = DimensionStore(f"{base}/store", _CHANGE_KEY, _CHANGE_ORDER, _TRACKED, buckets=8)
    events = _events(spark, sf_dir)
    store.apply(extract_since(events, "ts", _SPLIT), "newer")
    older = _event_stream(spark, sf_dir).filter(F.col("ts") <= F.lit(_SPLIT).cast("timestamp_ntz"))
    sink = available_now(older, f"{base}/checkpoint")
    await_all([sink.foreachBatch(store.sink(f"{base}/checkpoint")).start()])
    return store.read(spark, events.schema)


def store_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store whose stream started anew twice: batch 0 comes three times, with the clicks, without them, and with them."""
    base = fresh_dir(spark, "store-replay")
    store = DimensionStore(f"{base}/store", _CHANGE_KEY, _CHANGE_ORDER, _TRACKED, buckets=8)
    for name, part in (("a", "event_type = 'click'"), ("b", "event_type <> 'click'"), ("c", "event_type = 'click'")):
        sink = available_now(_event_stream(spark, sf_dir).filter(part), f"{base}/checkpoint-{name}")
        await_all([sink.foreachBatch(store.sink(f"{base}/checkpoint-{name}")).start()])
    return store.read(spark, _events(spark, sf_dir).schema)


def stream_rule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules counted batch by batch, over many batches; then the stream starts anew, in larger batches."""
    base, events = fresh_dir(spark, "stream-rules"), _events(spark, sf_dir)
    events.repartition(12).write.parquet(f"{base}/events")
    for checkpoint, most in ((f"{base}/first", 1), (f"{base}/second", 5)):
        arriving = with_source_file(stream_files(spark, f"{base}/events", events.schema, max_files=most))
        sink = counted_sink(_RULES, "events", f"{base}/counts", checkpoint, lambda batch, number: None)
        await_all([available_now(arriving, checkpoint).foreachBatch(sink).start()])
    return rule_totals(spark, f"{base}/counts")


# ---- schemas and the cycle -----------------------------------------------------------------------------------------


def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first batch without ``props``, a second one with it, read under the schema that the registry has then."""
    events = _table(spark, sf_dir, "events")
    split = F.lit(_SPLIT).cast("timestamp_ntz")
    first = events.filter(F.col("ts") < split).drop("props")
    second = events.filter(F.col("ts") >= split)
    registry = fresh_dir(spark, "registry")
    for batch in (first, second):
        schema = evolve(spark, registry, "events", batch.schema)
    return union_batches(conform(first, schema), conform(second, schema))


def rescue_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``props`` declared as a number, which no row satisfies, and ``ts``, ``event_type`` and ``value`` not declared at all."""
    events = _table(spark, sf_dir, "events")
    declared = events.select("event_id", "user_id", F.col("props").cast("string").try_cast("int").alias("props"))
    return conform(events, declared.schema)


def rescue_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was rescued is rescued again when the rows move on to a narrower table."""
    first = rescue_malformed(spark, sf_dir)
    return conform(first, first.select("event_id").schema)


def bronze_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed as one dated batch, read back with all batches of the table."""
    orders = _table(spark, sf_dir, "orders")
    base = fresh_dir(spark, "bronze")
    high = max_value(orders, "o_orderdate").select(F.col("max_value").cast("string")).first()[0]
    land_bronze(orders, bronze_folder(base, "orders", "first"), "o_orderdate", high)
    return read_bronze(spark, base, "orders", orders.schema)


def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as a described catalog table, streamed from there into another, and read from that."""
    base, suffix = fresh_dir(spark, "tables"), uuid.uuid4().hex[:8]
    source, copy = f"parts_{suffix}", f"parts_copy_{suffix}"
    parts = _table(spark, sf_dir, "part")
    write_table(parts, source, "Parts", {"quality": "silver"}, path=f"{base}/{source}")
    query = append_stream(stream_table(spark, source), f"{base}/{copy}", f"{base}/checkpoint", copy)
    await_all([query])
    shared_dir(spark)
    rows = read_table(spark, copy).checkpoint()
    for name in (source, copy):
        spark.sql(f"DROP TABLE {name}")
    return rows


def table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that is declared before it is filled, and what the catalog says of it."""
    name, parts = f"target_{uuid.uuid4().hex[:8]}", _table(spark, sf_dir, "part")
    create_target(spark, name, parts.schema, "Parts to come")
    declared = spark.table(name).count()
    create_target(spark, name, parts.schema, "Another comment")
    write_table(parts, name, "Parts", {"quality": "gold"}, mode="append")
    shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    facts = [
        ("comment", shown["Comment"]),
        ("declared rows", str(declared)),
        ("quality", "gold" if "quality=gold" in shown["Table Properties"] else "none"),
        ("rows", str(spark.table(name).count())),
    ]
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(facts, "fact string, value string")


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per table of an ingest over three sources, of which one is missing."""
    columns = {"events": "ts", "orders": "o_orderdate", "returns": "r_date", "lineitem": "l_shipdate"}
    sources = {t: _table(spark, sf_dir, t) for t in columns if t != "returns"}
    specs = [TableSpec(t, c) for t, c in columns.items()]
    audit = ingest_all(spark, specs, sources, LakePaths(fresh_dir(spark, "ingest-audit")))
    return audit.select("table_name", "status", "row_count", "null_cdc_rows", "watermark")


def control_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests over the tables of a control list; the second finds nothing new."""
    base = fresh_dir(spark, "control")
    entries = [("dbo", "events", "ts", ""), ("", "orders", "o_orderdate", ""), ("dbo", "lineitem", "l_shipdate", "1990-01-01")]
    rows = spark.createDataFrame(entries, "schema string, table string, cdc_col string, from_date string")
    rows.select(F.to_json(F.collect_list(F.struct("*")))).write.text(f"{base}/control")
    specs = load_specs(spark, f"{base}/control")
    sources = {s.table: _table(spark, sf_dir, s.table) for s in specs}
    runs = [ingest_all(spark, specs, sources, LakePaths(f"{base}/lake")).withColumn("run", F.lit(n)) for n in (1, 2)]
    return union_batches(*runs).select("run", "table_name", "status", "row_count", "watermark")


def watermark_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year: on the mark, the second delivery has as many orders as the first but not the same."""
    orders = _table(spark, sf_dir, "orders").withColumn("year", F.date_trunc("year", F.col("o_orderdate").cast("timestamp")))
    last = orders.agg(F.max("year").alias("year"))
    ends = orders.join(last, "year").agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    paths = LakePaths(fresh_dir(spark, "watermark-ties"))
    spec = TableSpec("orders", "year", columns=orders.schema, keys=("o_orderkey",), sequence=("year",), dedupe="unseen")
    for missing in ("high", "low"):
        arrived = orders.join(ends.select(F.col(missing).alias("o_orderkey")), "o_orderkey", "left_anti").select(*orders.columns)
        ingest_all(spark, [spec], {"orders": arrived}, paths)
        run_silver(spark, [spec], {"orders": orders.schema}, paths.bronze, paths.silver)
    return read_silver(spark, spec, orders.schema, paths.silver).drop("year")


def _model_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five source tables of the published model, from whole benchmark tables; a user plays one part."""
    events, parts = _table(spark, sf_dir, "events"), _table(spark, sf_dir, "part")
    moment = F.col("ts").cast("timestamp")
    tier = F.create_map(*[F.lit(x) for pair in _TIERS.items() for x in pair])[F.col("event_type")]
    day = F.to_date("ts")
    since = F.lit("2024-01-01 00:00:00").cast("timestamp")
    suppliers = _table(spark, sf_dir, "supplier")
    return {
        "DimUser": events.select(
            F.col("user_id").cast("int"),
            F.concat(F.lit(" user "), "user_id").alias("user_name"),
            F.lit("none").alias("country"),
            tier.alias("subscription_type"),
            day.alias("start_date"),
            F.lit(None).cast("date").alias("end_date"),
            moment.alias("updated_at"),
        ),
        "DimTrack": parts.select(
            F.col("p_partkey").cast("int").alias("track_id"),
            F.translate("p_name", " ", "-").alias("track_name"),
            F.col("p_size").alias("artist_id"),
            F.col("p_brand").alias("album_name"),
            (F.col("p_size") * 10).alias("duration_sec"),
            F.lit(None).cast("date").alias("release_date"),
            since.alias("updated_at"),
        ),
        "DimArtist": suppliers.select(
            F.col("s_suppkey").cast("int").alias("artist_id"),
            F.col("s_name").alias("artist_name"),
            F.lit("Pop").alias("genre"),
            F.col("s_nationkey").cast("string").alias("country"),
            since.alias("updated_at"),
        ),
        "DimDate": events.select(day.alias("date"))
        .distinct()
        .select(
            F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
            "date",
            F.dayofmonth("date").alias("day"),
            F.month("date").alias("month"),
            F.year("date").alias("year"),
            F.date_format("date", "EEEE").alias("weekday"),
        ),
        "FactStream": events.select(
            F.col("event_id").alias("stream_id"),
            F.col("user_id").cast("int"),
            F.col("user_id").cast("int").alias("track_id"),
            F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
            F.floor("value").cast("int").alias("listen_duration"),
            F.col("event_type").alias("device_type"),
            moment.alias("stream_timestamp"),
        ),
    }


def full_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published model end to end, shown as the star query: events with user, track and artist as they are now."""
    paths = LakePaths(fresh_dir(spark, "full-cycle"))
    report = run_cycle(spark, list(MODEL.values()), _model_sources(spark, sf_dir), paths, buckets=4)
    return star_query(spark, report.gold).withColumn(
        "stream_timestamp", F.col("stream_timestamp").cast("timestamp_ntz")
    )


def _two_cycles(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, DataFrame]:
    """The gold tables of these source tables after two cycles: the clicks come late, the second cycle delivers all rows
    again, and the streams of the marts start anew."""
    paths, sources = LakePaths(fresh_dir(spark, "two-cycles")), _model_sources(spark, sf_dir)
    early = {
        **sources,
        "DimUser": sources["DimUser"].filter("subscription_type <> 'Premium'"),
        "FactStream": sources["FactStream"].filter("device_type <> 'click'"),
    }
    specs = [spec for spec in MODEL.values() if spec.table in tables]
    run_cycle(spark, specs, early, paths, buckets=4)
    for mart in (DAILY_TABLE, TOP_TABLE):
        delete_path(spark, f"{paths.gold}/{mart}/checkpoint")
    return run_cycle(spark, specs, sources, paths, backfill=True, buckets=4).gold


def cycle_user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _two_cycles(spark, sf_dir, "DimUser")["gold_dim_user_scd2"]
    moments = {c: F.col(c).cast("timestamp_ntz") for c in ("updated_at", "__START_AT", "__END_AT")}
    return users.withColumns(moments)


def cycle_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_cycles(spark, sf_dir, "DimDate")["gold_dim_date"]


def cycle_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_cycles(spark, sf_dir, "FactStream")["gold_daily_streaming_metrics"]


def cycle_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_cycles(spark, sf_dir, "DimTrack", "DimArtist", "FactStream")["gold_top_artists_by_streams"]


def ingest_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extractions into bronze, the second picking up what came after the first, then silver."""
    events = _events(spark, sf_dir)
    paths = LakePaths(fresh_dir(spark, "ingest-cycle"))
    spec = TableSpec(
        "events", "ts", columns=events.schema, keys=("event_id",), sequence=("ts",), dedupe="unseen"
    )
    split = F.lit(_SPLIT).cast("timestamp_ntz")
    for arrived in (events.filter(F.col("ts") <= split), events):
        ingest_all(spark, [spec], {"events": arrived}, paths)
        run_silver(spark, [spec], {"events": events.schema}, paths.bronze, paths.silver)
    return read_silver(spark, spec, events.schema, paths.silver)


QUERIES: dict[str, Query] = {
    "incremental_extract": incremental_extract,
    "backfill_extract": backfill_extract,
    "window_extract": window_extract,
    "watermark_max": watermark_max,
    "drop_columns": drop_columns_query,
    "standardize_name": standardize_name_query,
    "clean_title": clean_title_query,
    "duration_flag": duration_flag_query,
    "event_date": event_date_query,
    "in_list_filter": in_list_filter,
    "not_null_filter": not_null_filter,
    "positive_filter": positive_filter,
    "minutes_rounding": minutes_rounding,
    "search_rows": search_rows_query,
    "preview": preview_query,
    "union_batches": union_batches_query,
    "inner_join_using": inner_join_using,
    "bridge_join": bridge_join,
    "bucketed_bridge_join": bucketed_bridge_join,
    "star_join": star_join_query,
    "join_current_version": join_current_version,
    "daily_metrics": daily_metrics_query,
    "daily_metrics_extended": daily_metrics_extended,
    "daily_kpis": daily_kpis_query,
    "top_creators_all": top_creators_all,
    "top_creators": top_creators_ten,
    "top_creators_minutes": top_creators_minutes_query,
    "top_creators_ascending": top_creators_ascending,
    "top_suppliers": top_suppliers,
    "tier_distribution": tier_distribution_query,
    "segment_distribution": segment_distribution,
    "value_counts_type": value_counts_type,
    "value_counts_brand": value_counts_brand,
    "current_tier_counts": current_tier_counts,
    "table_counts": table_counts_query,
    "dedupe_any": dedupe_any_query,
    "dedupe_first": dedupe_first_query,
    "dedupe_latest": dedupe_latest_query,
    "dedupe_version": dedupe_version_query,
    "expect_report": expect_report,
    "expect_or_drop": expect_or_drop_query,
    "expect_observed": expect_observed,
    "fact_table": fact_table,
    "scd1_latest": scd1_latest,
    "scd2_history": scd2_history,
    "scd2_out_of_order": scd2_out_of_order,
    "scd2_two_columns": scd2_two_columns,
    "scd2_few_keys": scd2_few_keys,
    "scd2_current": scd2_current,
    "scd2_closed_intervals": scd2_closed_intervals,
    "history_preview": history_preview,
    "stream_to_silver": stream_to_silver,
    "stream_quality": stream_quality,
    "stream_dedupe_first": stream_dedupe_first,
    "stream_facts": stream_facts,
    "stream_scd2": stream_scd2,
    "store_replay": store_replay,
    "stream_rule_totals": stream_rule_totals,
    "schema_evolve": schema_evolve,
    "rescue_malformed": rescue_malformed,
    "rescue_twice": rescue_twice,
    "bronze_round_trip": bronze_round_trip,
    "table_round_trip": table_round_trip,
    "table_metadata": table_metadata,
    "control_cycle": control_cycle,
    "watermark_ties": watermark_ties,
    "ingest_audit": ingest_audit,
    "ingest_cycle": ingest_cycle,
    "full_cycle": full_cycle,
    "cycle_user_history": cycle_user_history,
    "cycle_dates": cycle_dates,
    "cycle_daily": cycle_daily,
    "cycle_top": cycle_top,
}
