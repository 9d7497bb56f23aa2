"""Approximate nearest neighbours by inner product: an inverted file whose lists are scanned dimension by dimension.

A vector x of norm up to M gets one more component, sqrt(M * M - |x| * |x|), and a query a zero; then the largest inner product is
the smallest distance. All are turned by one random rotation, after which any d of D dimensions hold about d / D of a squared
distance, with a spread that is known. Rows are dealt to the list of their nearest centre; a list is kept in blocks of about
``BLOCK`` rows, each as columns of dimensions. A query looks into the lists whose centres are nearest.

A scan adds up squared distances, ``STEP`` dimensions at a time. After each step a candidate is abandoned if its partial
distance is further above the expected share of the distance to beat than ``SIGMAS`` spreads: the hypothesis that it is near
enough is rejected. The others are measured on the original vectors, in double precision. The distance to beat is first that of the
``k``-th best in a part of the query's nearest list, then that of the ``k``-th best of the whole list, which is known before the
other lists are scanned.

The centres are fitted to ``SAMPLE`` rows at most, those with the smallest hashes; there are ``LISTS`` lists at most. The
number of lists to look into is measured: ``TRIALS`` queries at most are answered exactly by reading every block, and the
number is the smallest that holds ``RECALL`` of the answers. A query that finds too few looks into all other lists.

Blocks and queries meet by list, block and part of the queries, so a list with a third of all rows, or that all queries look
into, is spread over many tasks; a task holds one block and about ``QUERIES`` queries. Centres, trials and numbers of
lists are all that is broadcast or seen by the driver; all have fixed bounds.

Rows without vec_id, and vectors that are null, zero, or hold a null or a component that isn't finite, take no part. Shorter
vectors count as if they ended with zeros. Rows that share a vec_id are candidates of their own, but none for a query with that
id; of queries that share an id the one with the smallest vector asks. An empty table gives no rows. All other vectors are
found, if there are ``k`` or fewer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import cut
from tidemark.llm.text import release
from tidemark.llm.vectors import kept, matrix, packed, unpacked

EVERY = 20
NEAREST = 20
ROWS = 512
LISTS = 4096
BLOCK = 1024
QUERIES = 2048
SAMPLE = 1 << 16
TRIALS = 64
RECALL = 0.96
STEP = 16
SIGMAS = 3.0
SEED = 13
# Rounds that fit the centres, and queries that are scanned side by side.
FITTING = 8
SIDE = 128
_FOUND = "query_id long, vec_id long, score double"


@dataclass
class Index:
    """What a task needs to know: the width of the vectors, the largest squared norm, the rotation and the centres."""

    width: int
    kind: str
    norm: float
    turn: np.ndarray
    centres: np.ndarray

    def turned(self, vectors: np.ndarray, candidate: bool) -> np.ndarray:
        """Rotated vectors with their added component."""
        vectors = vectors.astype(np.float64)
        extra = np.sqrt(np.maximum(self.norm - np.einsum("ij,ij->i", vectors, vectors), 0)) if candidate else np.zeros(len(vectors))
        return np.column_stack((vectors, extra)) @ self.turn

    def order(self, turned: np.ndarray) -> np.ndarray:
        """The lists of each row by the distance of their centres, nearest first."""
        return np.argsort(gaps(turned, self.centres), axis=1, kind="stable")


def gaps(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances less the points' squared norms."""
    return np.einsum("ij,ij->i", centres, centres) - 2 * points @ centres.T


def rotation(width: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, the same for each seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def fit(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centres of a sample that fits in memory; each starts on a row of it."""
    centres = sample[:lists].copy()
    for _ in range(FITTING):
        label = np.concatenate([np.argmin(gaps(part, centres), axis=1) for part in np.array_split(sample, -(-len(sample) // 4096))])
        order = np.argsort(label, kind="stable")
        some, first = np.unique(label[order], return_index=True)
        centres[some] = np.add.reduceat(sample[order], first) / np.diff(np.append(first, len(label)))[:, None]
    return centres


def shares(width: int, sigmas: float = SIGMAS) -> list[tuple[int, float]]:
    """After how many dimensions a distance is tested, and the share of the whole it may have by then.

    After a random rotation the share in d of D dimensions is distributed as Beta(d / 2, (D - d) / 2).
    """
    out = []
    for d in range(STEP, width, STEP):
        mean = d / width
        out.append((d, min(1.0, mean + sigmas * np.sqrt(2 * mean * (1 - mean) / (width + 2)))))
    return [*out, (width, 1.0)]


def _best(qid: np.ndarray, vid: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of each query's ``k`` best, ties to the smaller vec_id."""
    order = np.lexsort((vid, -score, qid))
    ids = qid[order]
    first = np.searchsorted(ids, ids)
    return order[np.arange(len(ids)) - first < k]


def scan(index: Index, ids, vectors, columns, qids, queries, beat, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """query_id, vec_id and score of what a block has for its queries, ``k`` each at most; and how many pairs were measured.

    ``columns`` are the rotated vectors, a row for each dimension. ``beat`` is the score to reach, or minus infinity.
    """
    turned, steps, out, measured = index.turned(queries, False), shares(len(columns)), [], 0
    head = columns[: steps[0][0]].astype(np.float64)
    heads = np.einsum("ij,ij->j", head, head)
    for at in range(0, len(qids), SIDE):
        qid, q, own, least = qids[at : at + SIDE], turned[at : at + SIDE], queries[at : at + SIDE].astype(np.float64), beat[at : at + SIDE]
        blind = np.flatnonzero(np.isneginf(least))
        if len(blind) and len(ids) > k:
            # Without a score to reach, the first rows of the block set one.
            some = slice(0, 8 * k)
            known = np.where(ids[some] == qid[blind, None], -np.inf, own[blind] @ vectors[some].astype(np.float64).T)
            least = least.copy()
            kth = np.sort(known, axis=1)[:, -k] if known.shape[1] >= k else np.full(len(blind), -np.inf)
            least[blind] = kth - 1e-9 * (1 + np.abs(kth))
        # With the norms of the turned vectors a score is a squared distance; a little more for rounding.
        scale = index.norm + np.einsum("ij,ij->i", q, q)
        radius = scale - 2 * least + 1e-5 * scale
        far = np.einsum("ij,ij->i", q[:, : len(head)], q[:, : len(head)])[:, None] + heads - 2 * q[:, : len(head)] @ head
        one, two = np.nonzero((far <= (radius * steps[0][1])[:, None]) & (ids != qid[:, None]))
        partial = far[one, two]
        for (begin, _), (end, share) in zip(steps, steps[1:]):
            partial += ((columns[begin:end, two] - q[one, begin:end].T) ** 2).sum(axis=0)
            stay = partial <= radius[one] * share
            one, two, partial = one[stay], two[stay], partial[stay]
        measured += len(one)
        for begin in range(0, max(len(one), 1), 1 << 16):
            i, j = one[begin : begin + (1 << 16)], two[begin : begin + (1 << 16)]
            score = (own[i] * vectors[j].astype(np.float64)).sum(axis=1)
            enough = score >= least[i]
            out.append((qid[i[enough]], ids[j[enough]], score[enough]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0
    qid, vid, score = (np.concatenate(x) for x in zip(*out))
    top = _best(qid, vid, score, k)
    return qid[top], vid[top], score[top], measured


def _table(qid: np.ndarray, vid: np.ndarray, score: np.ndarray) -> pa.Table:
    return pa.table({"query_id": pa.array(qid, pa.int64()), "vec_id": pa.array(vid, pa.int64()), "score": pa.array(score, pa.float64())})


def usable(df: DataFrame, vector: str) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    return kept(df, vector).where(F.col("vec_id").isNotNull() & F.exists("vector", lambda x: x != 0))


def prepare(vectors: DataFrame, rows: int = ROWS) -> tuple[Index, int] | None:
    """The centres, fitted to a sample, and the number of vectors; None if there are none."""
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    whole = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.max(norm).alias("norm")).first()
    if not whole.n:
        return None
    hashed = vectors.withColumn("_hash", F.xxhash64("vec_id", F.lit(SEED)))
    if whole.n > 4 * SAMPLE:
        hashed = hashed.where(F.col("_hash") < F.lit(int(2 * SAMPLE / whole.n * 2**64) - 2**63))
    some = matrix(hashed.orderBy("_hash", "vec_id", "vector").limit(SAMPLE).select("vector").toArrow()["vector"], whole.width)
    kind = "<f4" if vectors.schema["vector"].dataType.simpleString() == "array<float>" else "<f8"
    index = Index(whole.width, kind, whole.norm, rotation(whole.width + 1), np.zeros((0, whole.width + 1)))
    lists = max(1, min(LISTS, whole.n // rows, len(some)))
    index.centres = fit(index.turned(some, True), lists)
    return index, whole.n


def _home(index: Index, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of a batch, rotated, and the list of each."""
    own = matrix(vectors, index.width)
    turned = index.turned(own, True)
    return own, turned, np.argmin(gaps(turned, index.centres), axis=1)


def list_sizes(vectors: DataFrame, index: Index) -> np.ndarray:
    sent = vectors.sparkSession.sparkContext.broadcast(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value.centres), np.int64)
        for batch in batches:
            total += np.bincount(_home(sent.value, batch["vector"])[2], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["list", "n"])

    found = vectors.mapInArrow(count, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect()
    sizes = np.zeros(len(index.centres), np.int64)
    for r in found:
        sizes[r.list] = r.n
    return sizes


def build(vectors: DataFrame, index: Index, blocks: np.ndarray) -> DataFrame:
    """list, block, ids, vectors and columns: one row for each block, in the shared folder."""
    sent = vectors.sparkSession.sparkContext.broadcast((index, blocks))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, blocks = sent.value
            own, _, place = _home(index, batch["vector"])
            block = batch["place"].to_numpy() % blocks[place]
            columns = [pa.array(place.astype(np.int32)), pa.array(block.astype(np.int32)), batch["vec_id"], packed(own.astype(index.kind))]
            yield pa.RecordBatch.from_arrays(columns, names=["list", "block", "vec_id", "vector"])

    def pack(rows: pa.Table) -> pa.Table:
        index = sent.value[0]
        rows = rows.sort_by([("vec_id", "ascending"), ("vector", "ascending")]).combine_chunks()
        own = unpacked(rows["vector"], index.kind, index.width)
        columns = index.turned(own, True).T.astype("<f4")
        parts = {"ids": rows["vec_id"].to_numpy().astype("<i8").tobytes(), "vectors": own.tobytes(), "columns": columns.tobytes()}
        return pa.table({"list": rows["list"][:1], "block": rows["block"][:1], **{c: pa.array([x], pa.binary()) for c, x in parts.items()}})

    # The place of a row in the table deals also rows with one id to all blocks of their list.
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)).alias("place")
    dealt = vectors.select("vec_id", "vector", spread).mapInArrow(deal, "list int, block int, vec_id long, vector binary")
    return cut(dealt.groupBy("list", "block").applyInArrow(pack, "list int, block int, ids binary, vectors binary, columns binary"))


def _block(index: Index, row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    vectors = np.frombuffer(row["vectors"], index.kind).reshape(-1, index.width)
    return ids, vectors, np.frombuffer(row["columns"], "<f4").reshape(-1, len(ids))


def probes(blocks: DataFrame, asked: DataFrame, index: Index, k: int, recall: float = RECALL) -> int:
    """How many lists a query must look into, from the exact answers to a few of them."""
    trials = asked.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(TRIALS).toArrow()
    own = matrix(trials["vector"], index.width)
    sent = blocks.sparkSession.sparkContext.broadcast((index, trials["vec_id"].to_numpy(), own))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        for batch in batches:
            for row in batch.to_pylist():
                index, qids, own = sent.value
                ids, vectors, _ = _block(index, row)
                score = own @ vectors.astype(np.float64).T
                score[ids == qids[:, None]] = -np.inf
                top = np.argsort(-score, axis=1)[:, :k]
                more = [np.repeat(qids, top.shape[1]), ids[top].ravel(), np.take_along_axis(score, top, 1).ravel()]
                more = [np.concatenate(x) for x in zip(best, [*more, np.full(top.size, row["list"])])]
                more = [x[more[2] > -np.inf] for x in more]
                best = [x[_best(*more[:3], k)] for x in more]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=["query_id", "vec_id", "score", "list"])

    every = blocks.mapInArrow(read, f"{_FOUND}, list long")
    lists = dict(zip(trials["vec_id"].to_pylist(), index.order(index.turned(own, False))))
    ranks = sorted(int(np.flatnonzero(lists[r.query_id] == r.list)[0]) for r in top(every, k, "list").collect())
    return ranks[int(np.ceil(recall * len(ranks))) - 1] + 1 if ranks else len(index.centres)


def top(found: DataFrame, k: int, *more: str) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` best."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", *more)


def look(blocks: DataFrame, asked: DataFrame, index: Index, dealt: np.ndarray, first: int, last: int, k: int) -> DataFrame:
    """query_id, vec_id and score of what the queries (vec_id, vector, beat) find in their lists from number ``first`` to before
    ``last``."""
    spark = asked.sparkSession
    sent = spark.sparkContext.broadcast((index, dealt))

    def lists_of(index: Index, batch: pa.RecordBatch) -> np.ndarray:
        return index.order(index.turned(matrix(batch["vector"], index.width), False))[:, first:last]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value[1]), np.int64)
        for batch in batches:
            total += np.bincount(lists_of(sent.value[0], batch).ravel(), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["list", "n"])

    parts = np.zeros(len(dealt), np.int64)
    for r in asked.mapInArrow(count, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect():
        parts[r.list] = -(-r.n // QUERIES)
    shown = spark.sparkContext.broadcast(parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (index, dealt), parts = sent.value, shown.value
            own, ids = matrix(batch["vector"], index.width).astype(index.kind), batch["vec_id"].to_numpy()
            lists, beat = lists_of(index, batch), batch["beat"].to_numpy()
            row = np.repeat(np.arange(len(ids)), lists.shape[1])
            part = batch["spread"].to_numpy()[row] % parts[lists.ravel()]
            order = np.lexsort((part, lists.ravel()))
            row, place, part = row[order], lists.ravel()[order], part[order]
            edges = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (part[1:] != part[:-1])))
            for begin, end in zip(edges.tolist(), np.append(edges[1:], len(row)).tolist()):
                some, n = row[begin:end], int(dealt[place[begin]])
                values = [ids[some].astype("<i8").tobytes(), own[some].tobytes(), beat[some].astype("<f8").tobytes()]
                columns = [pa.array([x] * n, t) for x, t in zip((place[begin], part[begin]), (pa.int32(), pa.int32()))]
                columns += [pa.array(np.arange(n, dtype=np.int32)), *[pa.array([v] * n, pa.binary()) for v in values]]
                yield pa.RecordBatch.from_arrays(columns, names=["list", "part", "block", "qids", "queries", "beat"])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        index = sent.value[0]
        qids, queries, beat = (np.frombuffer(b"".join(right[c].to_pylist()), t) for c, t in (("qids", "<i8"), ("queries", index.kind), ("beat", "<f8")))
        found = scan(index, *_block(index, left.to_pylist()[0]), qids, queries.reshape(-1, index.width), beat, k)
        return _table(*found[:3])

    sides = spark.createDataFrame([(i, int(n)) for i, n in enumerate(parts) if n], "_list int, _parts int")
    wide = blocks.join(F.broadcast(sides), F.col("list") == F.col("_list"))
    wide = wide.select("list", "block", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"), "ids", "vectors", "columns")
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)).alias("spread")
    chunks = asked.select("vec_id", "vector", "beat", spread).mapInArrow(
        deal, "list int, part int, block int, qids binary, queries binary, beat binary"
    )
    key = ("list", "block", "part")
    return wide.groupBy(*key).cogroup(chunks.groupBy(*key)).applyInArrow(meet, _FOUND)


def _better(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The queries with the ``k``-th best score so far."""
    kth = found.where(F.col("rank") == k).select(F.col("query_id").alias("_id"), F.col("score").alias("_kth"))
    unknown: Column = F.lit(float("-inf"))
    return asked.join(kth, F.col("vec_id") == F.col("_id"), "left").select("vec_id", "vector", F.coalesce("_kth", unknown).alias("beat"))


def search(df: DataFrame, vector: str = "embedding", every: int = EVERY, k: int = NEAREST, rows: int = ROWS, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of each query, the rows whose vec_id ``every`` divides."""
    vectors = usable(df, vector)
    made = prepare(vectors, rows)
    if made is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, _ = made
    dealt = np.maximum(-(-list_sizes(vectors, index) // BLOCK), 1)
    blocks = build(vectors, index, dealt)
    asked = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = cut(asked.withColumn("beat", F.lit(float("-inf"))))
    lists = len(index.centres)
    found = cut(top(look(blocks, asked, index, dealt, 0, 1, k), k))
    if lists > 1:
        most = max(2, probes(blocks, asked, index, k, recall))
        more = look(blocks, _better(asked, found, k), index, dealt, 1, most, k)
        found = cut(top(found.drop("rank").unionByName(more), k))
        if most < lists:
            enough = found.where(F.col("rank") == k).select(F.col("query_id").alias("_id"))
            short = cut(asked.join(enough, F.col("vec_id") == F.col("_id"), "left_anti"))
            if not short.isEmpty():
                rest = look(blocks, short, index, dealt, most, lists, k)
                found = top(found.drop("rank").unionByName(rest), k)
    release()
    return found
