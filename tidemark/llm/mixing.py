"""Mixing sources to target weights, in blocks.

The words of a source, document after document in a fixed pseudorandom order, are cut into blocks of ``BLOCK`` words; the
last may be shorter. The mix is made in shards of ``SLOTS`` blocks. Each shard draws how many of its blocks each source
gives: the whole part of the expected counts, and the rest by one multinomial draw of the remainders, so that the sum over
shards strays from the target by a few blocks and not by the square root of them all. A source's slots are numbered through
the shards; slot k takes block permutation(k mod blocks) in round k div blocks, the permutation being another one for each
source and round. Slots and documents meet by a join on (source, block).

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating, and share the size of all documents; a target
stops at ``REPEATS`` times its source's size and the excess goes to the others by weight, until none is above. A source
never gives a block more than ``REPEATS`` times: draws beyond that are left out.

A null text has no words; a document without words takes 0. A null source is a source. Rows that share a doc_id are
documents of their own. If no document has a word, every target is 0. An empty table gives no rows. The driver sees one row
per source, never a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import cut, running_total
from tidemark.llm.text import pieces, words_of

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK = 32
SLOTS = 8192
SEED = 11


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words) of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            n = np.diff(words_of(batch.column("text")).first)
            columns = [batch["doc_id"], batch["source"], pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "source", "size"])

    kept = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text")
    return kept.mapInArrow(count, "doc_id long, source string, size long")


def targets(totals: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> dict:
    """The target of each source, from (source, size)."""
    order = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    size = {s: n for s, n in order}
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    target, left = {}, float(sum(size.values()))
    open_ = [s for s, _ in order]
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > repeats * size[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = float(repeats * size[s])
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    return target


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """index -> another index below n, a bijection for each (n, key): a Feistel network, walked until below n."""
    half = (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))).astype(np.uint64) + np.uint64(1)) // np.uint64(2)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, walk = index.astype(np.uint64), np.arange(len(index))
    while len(walk):
        x, h, m, k = out[walk], half[walk], low[walk], key[walk]
        left, right = x >> h, x & m
        for turn in range(4):
            f = (right + k + np.uint64(turn * 0x9E3779B9)) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, (left ^ (f >> np.uint64(32))) & m
        out[walk] = (left << h) | right
        walk = walk[out[walk] >= n[walk].astype(np.uint64)]
    return out.astype(np.int64)


def draws(spark, plan: list[tuple], slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """shard, place (of the source in the plan), n: how many blocks each output shard takes from each source."""
    expected = np.array([row[3] for row in plan], dtype=np.float64)
    total = expected.sum()
    shards = int(np.ceil(total / slots)) if total else 0

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                here = min(slots, total - shard * slots)
                mean = expected / total * here
                n = np.floor(mean + 1e-9)
                rest = np.maximum(mean - n, 0)
                free = int(round(here - n.sum()))
                if free > 0 and rest.sum() > 0:
                    n = n + np.random.default_rng([seed, shard]).multinomial(free, rest / rest.sum())
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard)), pa.array(at), pa.array(n[at].astype(np.int64))], names=["shard", "place", "n"]
                )

    return spark.range(shards).select(F.col("id").alias("shard")).mapInArrow(draw, "shard long, place long, n long")


def mix(docs: DataFrame, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix: ``sources`` (place, source, source_size, target, blocks), ``slots`` (shard, slot, place, block: the blocks of
    each output shard), and ``spans`` (doc_id, source, size, place, start: where a document lies in its source)."""
    spark = docs.sparkSession
    sized = sizes(docs)
    spans = cut(running_total(sized, ["source"], ["doc_id", "size"], F.col("size"), "start"))
    totals = [(r.source, r.size) for r in spans.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    goal = targets(totals)
    plan = []
    for i, (source, size) in enumerate(sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))):
        # A source's blocks hold size / blocks words on average, so that is what a draw of it is worth.
        blocks = -(-size // block)
        plan.append((i, source, size, goal[source] * blocks / size if size else 0.0, goal[source], blocks))
    schema = T.StructType.fromDDL("place long, source string, source_size long, expected double, target double, blocks long")
    sources = spark.createDataFrame(plan, schema)
    places = sources.select("place", F.col("source").alias("_source"))
    spans = spans.join(places, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    drawn = running_total(draws(spark, plan, slots, seed), ["place"], ["shard"], F.col("n"), "first")
    # A few rows make many slots, so they are spread by number and not by their size.
    drawn = drawn.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "place", "shard")
    amounts = {p[0]: p[5] for p in plan}

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.array([amounts[i] for i in range(len(amounts))], dtype=np.int64)
        for batch in batches:
            shard, place, n, first = (batch.column(c).to_numpy() for c in ("shard", "place", "n", "first"))
            row = np.repeat(np.arange(len(n)), n)
            slot = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[row]
            place, shard = place[row], shard[row]
            blocks = size[place]
            turn = slot // blocks
            fits = turn < REPEATS
            place, shard, slot, blocks, turn = (x[fits] for x in (place, shard, slot, blocks, turn))
            key = (place * 1_000_003 + turn * 7919 + seed * 104_729).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            at = permuted(slot % blocks, blocks, key)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shard, slot, place, at)], names=["shard", "slot", "place", "block"])

    return sources, drawn.mapInArrow(take, "shard long, slot long, place long, block long"), spans


def taken(docs: DataFrame, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words that the mix takes of each document, repeats counted."""
    sources, chosen, spans = mix(docs, block, slots, seed)
    times = chosen.groupBy("place", "block").agg(F.count("*").alias("times"))
    spans = cut(spans.withColumn("row", F.monotonically_increasing_id()))
    # A document in one block is the common case; a long one is spread over all its blocks.
    held = spans.where("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})"))
    )
    part = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block)
    met = held.select("row", "place", "block", part.alias("part")).join(times, ["place", "block"])
    sums = met.groupBy("row").agg(F.sum(F.col("part") * F.col("times")).alias("taken"))
    facts = sources.select(F.col("place").alias("_place"), "source_size", "target")
    return (
        spans.join(sums, "row", "left")
        .join(facts, F.col("place") == F.col("_place"))
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed(docs: DataFrame, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """doc_id, shard, slot, start, length: the word range of a document that a slot of the mix holds, one row per piece."""
    _, chosen, spans = mix(docs, block, slots, seed)
    held = spans.where("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})"))
    )
    begin = F.greatest("start", F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    ranges = held.select("doc_id", "source", "place", "block", (begin - F.col("start")).alias("start"), (end - begin).alias("length"))
    return chosen.join(ranges, ["place", "block"]).select("doc_id", "source", "shard", "slot", "start", "length")


def resample(docs: DataFrame, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """As many words of each document as the mix takes: whole copies, and a run of its words for what is left.

    The run begins at a place hashed from doc_id. So a source has the mix's words exactly, up to one word for each row of a
    doc_id that several rows share. A document of which the mix takes nothing, or that has no words, goes. ``n_chars`` of a run
    is its own.
    """
    shares = taken(docs, block, slots, seed).where("taken > 0").groupBy(F.col("doc_id").alias("_id"))
    shares = shares.agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
    names, schema = docs.columns, docs.schema
    text = names.index("text")
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")), F.lit(1_000_000)).alias("_chance")
    packed = docs.select(F.col("doc_id").cast("long").alias("_doc"), chance, F.struct(*names).alias("_row"))
    met = packed.join(shares.hint("merge"), F.col("_doc").eqNullSafe(F.col("_id"))).select("_row", "_taken", "_size", "_chance")

    def copies(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = words_of(batch.column(text))
        size = np.diff(words.first)
        share, whole, chance = (batch.column(len(names) + k).to_numpy() for k in range(3))
        # In floating point a long source's product would lose words; in 64 bits it would pass their end.
        goal = np.array([n * t // w for n, t, w in zip(size.tolist(), share.tolist(), whole.tolist())], dtype=np.int64)
        times, rest = goal // np.maximum(size, 1), goal % np.maximum(size, 1)
        columns = [batch.column(k) for k in range(len(names))]
        at = pa.array(np.repeat(np.arange(batch.num_rows), times))
        yield pa.RecordBatch.from_arrays([c.take(at) for c in columns], names=names)
        some = np.flatnonzero(rest)
        begin = words.first[some] + (size[some] - rest[some] + 1) * chance[some] // 1_000_000
        ends = words.ends[begin + rest[some] - 1] if len(some) else begin
        starts = words.starts[begin] if len(some) else begin
        runs = [words.raw[a:b].tobytes().decode("utf-8", "surrogatepass") for a, b in zip(starts.tolist(), ends.tolist())]
        parts = [c.take(pa.array(some)) for c in columns]
        parts[text] = pa.array(runs, pa.string()).cast(columns[text].type)
        if "n_chars" in names and pa.types.is_integer(columns[names.index("n_chars")].type):
            parts[names.index("n_chars")] = pa.array([len(x) for x in runs], columns[names.index("n_chars")].type)
        yield pa.RecordBatch.from_arrays(parts, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [*batch.column(0).flatten(), *(batch.column(k) for k in (1, 2, 3))]
            flat = pa.RecordBatch.from_arrays(columns, names=[str(k) for k in range(len(columns))])
            for piece in pieces(iter([flat]), str(text)):
                yield from copies(piece)

    return met.mapInArrow(run, schema)
