"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has bit i set if over half of the text's shingle hashes have it. Two fingerprints link if they differ in at
most ``radius`` bits. Bit i of a fingerprint gets a random nonzero vector of radius + 1 bits; table v (every nonzero vector)
keeps the bits whose vector has an odd product with v. For any radius or fewer differing bits some v is orthogonal to all
their vectors, so that table sees equal bits: every pair within the radius meets in some table, none is lost by chance.

Equal fingerprints are one class before any table is built. A table's bucket is walked inside a task, which
returns the links of a spanning forest only. Fingerprints of buckets with more than ``BUCKET`` classes link another way,
as exact: each is expanded to every value within radius // 2 + radius % 2 flips, and all that meet at a value that one of
them reaches within radius // 2 flips link to that one. That is linear in the bucket's size.

Nulls, empty and white texts have fingerprint 0 and link like others. Rows that share a doc_id are documents of their own
that get the component of any of them. Rows without a doc_id get a fingerprint and component null. An empty table gives no
rows. Long texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import components, cut
from tidemark.llm.text import release

SHINGLE = 3
RADIUS = 3
SEED = 42

# Classes of a bucket that are compared with each other inside one task; half a megabyte.
BUCKET = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> bytes:
    """The 64 bits, most significant byte first."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return bytes(8)
    runs = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_digest
    total, count, held = np.zeros(64, dtype=np.int64), 0, []

    def add() -> None:
        bits = np.unpackbits(np.frombuffer(b"".join(held), dtype=np.uint8).reshape(-1, 8), axis=1)
        np.add(total, bits.sum(axis=0, dtype=np.int64), out=total)

    for run in runs:
        held.append(digest(b" ".join(run), SEED))
        if len(held) == 65536:
            count += len(held)
            add()
            held = []
    if held:
        count += len(held)
        add()
    return np.packbits(2 * total > count).tobytes()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``carried``, and fp (long, the 64 bits)."""
    names = ["doc_id", *carried]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            bits = b"".join(fingerprint(t.as_py(), shingle) for t in batch.column("text"))
            fps = pa.array(np.frombuffer(bits, dtype=">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), fps], names=[*names, "fp"])
        release()

    kept = docs.select(F.col("doc_id").cast("long"), *carried, "text")
    shape = ", ".join(f"{c} {kind}" for c, kind in kept.drop("text").dtypes)
    return kept.mapInArrow(batches, f"{shape}, fp long")


def masks(radius: int = RADIUS, seed: int = 7) -> list[int]:
    """One mask of 64 bits for each of the 2 ** (radius + 1) - 1 tables, as signed longs."""
    vectors = np.random.default_rng(seed).integers(1, 2 ** (radius + 1), 64)
    tables = []
    for v in range(1, 2 ** (radius + 1)):
        bits = sum(1 << i for i, m in enumerate(vectors) if bin(int(m) & v).count("1") % 2)
        tables.append(bits - 2**64 if bits >= 2**63 else bits)
    return tables


def _forest(fps: np.ndarray, ids: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links of a spanning forest of all pairs within the radius, by walking from each class to those not yet reached."""
    left, right = [], []
    waiting = np.arange(len(fps))
    while len(waiting):
        stack, waiting = [int(waiting[0])], waiting[1:]
        while stack and len(waiting):
            at = stack.pop()
            near = np.bitwise_count(fps[waiting] ^ fps[at]) <= radius
            if near.any():
                hit, waiting = waiting[near], waiting[~near]
                left += [int(ids[at])] * len(hit)
                right += ids[hit].tolist()
                stack += hit.tolist()
    return left, right


def _flips(radius: int) -> list[int]:
    """All 64-bit values with at most ``radius`` bits set, as signed longs."""
    found = [sum(1 << i for i in some) for k in range(radius + 1) for some in combinations(range(64), k)]
    return [x - 2**64 if x >= 2**63 else x for x in found]


def _crowded_links(classes: DataFrame, radius: int) -> DataFrame:
    """Links among many classes, one to each value that they reach by flipping bits."""
    near, far = _flips(radius // 2), set(_flips(radius - radius // 2))

    def reached(flips: list[int], close: bool) -> DataFrame:
        def expand(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn = np.array(flips, dtype=np.int64)
            for batch in rows:
                fps, ids = (batch.column(c).to_numpy() for c in ("fp", "rep"))
                for at in range(0, len(fps), 256):
                    value = (fps[at : at + 256, None] ^ turn[None, :]).ravel()
                    rep = np.repeat(ids[at : at + 256], len(turn))
                    low = rep if close else np.full(len(rep), np.iinfo(np.int64).max)
                    yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(rep), pa.array(low)], names=["value", "rep", "low"])

        return classes.mapInArrow(expand, "value long, rep long, low long")

    hub = reached(near, True).groupBy("value").agg(F.min("low").alias("hub"))
    met = reached(sorted(far), False).select("value", "rep").join(hub, "value")
    return met.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()


def links(classes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """a, b: links between the class ids ``rep`` of distinct ``fp`` that connect all pairs within the radius."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).alias("m")) for t, m in enumerate(masks(radius))])
    spread = classes.withColumn("table", F.explode(tables)).select(
        F.col("table.t").alias("t"), F.col("fp").bitwiseAND(F.col("table.m")).alias("key"), "rep", "fp"
    )
    full = spread.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = cut(spread.join(full, ["t", "key"]))

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        ids, fps = group["rep"].to_numpy(), group["fp"].to_numpy().view(np.uint64)
        order = np.argsort(ids, kind="stable")
        a, b = _forest(fps[order], ids[order], radius)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    pairs = met.where("n = 2").groupBy("t", "key").agg(
        F.min_by("fp", "rep").alias("x"), F.max_by("fp", "rep").alias("y"), F.min("rep").alias("a"), F.max("rep").alias("b")
    )
    pairs = pairs.where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= radius).select("a", "b")
    groups = met.where((F.col("n") > 2) & (F.col("n") <= bucket)).select("t", "key", "rep", "fp")
    found = groups.groupBy("t", "key").applyInArrow(compare, "a long, b long").unionByName(pairs)
    crowd = met.where(F.col("n") > bucket).select("rep", "fp").distinct()
    return found.unionByName(_crowded_links(crowd, radius)).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links)."""
    marked = cut(fingerprints(docs, shingle))
    classes = marked.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    label = components(links(classes, radius, bucket))
    named = classes.join(label, classes.rep == label.node, "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component", "rep").alias("component_id")
    )
    out = marked.join(named, marked.fp == named["_fp"], "left")
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """One row of each component, whatever ids the rows have: the smallest doc_id, null last, then by a hash of the row.

    A component is one of texts here, so rows that share a doc_id part if their texts do. Rows with neither a doc_id nor a
    word stay.
    """
    id_ = F.col("doc_id").cast("long")
    # Rows with the same id and hash are equal in all columns.
    hashed, bare = F.xxhash64(*docs.columns), id_.isNull() & ~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    keyed = docs.where(~bare).select(F.coalesce(id_, F.lit(0)).alias("doc_id"), id_.isNull().alias("none"), hashed.alias("hash"), "text")
    marked = cut(fingerprints(keyed, shingle, ("none", "hash")))
    classes = marked.groupBy("fp").agg(F.min(F.struct("none", "doc_id", "hash")).alias("least")).withColumn("rep", F.col("fp"))
    label = components(links(classes.select("rep", "fp"), radius, bucket))
    named = classes.join(label, classes.rep == label.node, "left").withColumn("group", F.coalesce("component", "rep"))
    first = named.groupBy("group").agg(F.min("least").alias("least"))
    stays = first.select(F.col("least.doc_id").alias("_kept_id"), F.col("least.hash").alias("_kept_hash"))
    same = docs.where(~bare).withColumns({"_kept_id": F.coalesce(id_, F.lit(0)), "_kept_hash": hashed})
    # Dealt by the join's keys already, so texts are shuffled once.
    one = same.join(stays.hint("merge"), ["_kept_id", "_kept_hash"], "left_semi").dropDuplicates(["_kept_id", "_kept_hash"])
    return one.select(*docs.columns).unionByName(docs.where(bare))
