"""Importance resampling towards a target: documents drawn with weights that favour what the target texts are made of.

Words are lower-cased runs of ASCII letters, digits and characters beyond ASCII. A feature is a run of up to ``NGRAMS`` words,
its bucket the CRC-32 of its bytes modulo ``BUCKETS``. All documents and all target texts are counted bucket by bucket: an
array for each task, added up by bucket, so the driver sees ``BUCKETS`` sums. A bucket's gain is the whole part of a thousand
times the logarithm of how much more frequent it is in the target. The gains are an array of fixed size; a document is scored
by looking up its features in it. Adding pseudorandom Gumbel noise to the weight and keeping the highest scores draws
without replacement in proportion to the weights.

The cutoff is found by weighted medians of medians. Each task gives the median of its remaining keys and their number; the
median of these, weighted by the numbers, has at least a quarter of all remaining keys on either side, so each round
discards at least a quarter, and the number of keys before it tells which. A round is one pass, as tasks give the medians of
both sides; rows that are out of question are left out of the table once it has shrunk to an eighth. A key is the score
(highest first), the doc_id, a hash of the text and the row's number, so no two are equal. The winners are sorted by ranges
of the key and numbered.

A null text has no features and weight 0. A null doc_id counts as empty text in the hash and comes last in ties. Rows that
share a doc_id are documents of their own. An empty target, or an empty table of documents, is counted as zero. Long texts
are taken whole; memory depends on the longest text, not on the table.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import cut
from tidemark.llm.text import SIGNS, Words, pieces, words_of

NGRAMS = 1
BUCKETS = 10_000
SEED = 2024
SHARE = 10
LEAST_WORDS = 20
# Partitions of the scored rows, each of which gives a row of medians; and keys that are sorted where medians end.
PARTS = 2048
FEW = 32
# Longer words take the standard function one by one.
_SHORT = 48

_KEY = ["a", "b", "c", "d"]


def _table() -> np.ndarray:
    """CRC-32 of each byte, from the polynomial 0xEDB88320."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _table()


def word_crcs(words: Words) -> np.ndarray:
    """The running CRC-32 (without the last inversion) after each word, all words of a batch side by side."""
    lengths = words.ends - words.starts
    return continued(np.full(len(lengths), 0xFFFFFFFF, dtype=np.uint32), words, np.arange(len(lengths)))


def continued(crc: np.ndarray, words: Words, which: np.ndarray) -> np.ndarray:
    """Running CRC-32s after one more word each."""
    starts, lengths = words.starts[which], (words.ends - words.starts)[which]
    crc, order = crc.copy(), np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    for k in range(min(_SHORT, int(ordered[-1]) if len(ordered) else 0)):
        rows = order[np.searchsorted(ordered, k, side="right") : np.searchsorted(ordered, _SHORT, side="right")]
        crc[rows] = _CRC[(crc[rows] ^ words.raw[starts[rows] + k]) & np.uint32(255)] ^ (crc[rows] >> np.uint32(8))
    for i in order[np.searchsorted(ordered, _SHORT, side="right") :].tolist():
        text = words.raw[starts[i] : starts[i] + lengths[i]].tobytes()
        crc[i] = zlib.crc32(text, int(crc[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return crc


def features(texts: pa.Array, most: int = NGRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, its row, and the number of words of each row."""
    words = words_of(texts, SIGNS, fold=True)
    rows, counts = words.rows, np.diff(words.first)
    crc, found, where = word_crcs(words), [], []
    heads = np.arange(len(crc))
    for n in range(1, most + 1):
        found.append((~crc % np.uint32(buckets)).astype(np.int64))
        where.append(rows[heads])
        if n < most:
            # Runs whose next word is in the same text grow by a space and that word.
            on = heads + n < words.first[1:][rows[heads]]
            heads, crc = heads[on], crc[on]
            crc = _CRC[(crc ^ np.uint32(0x20)) & np.uint32(255)] ^ (crc >> np.uint32(8))
            crc = continued(crc, words, heads + n)
    return np.concatenate(found), np.concatenate(where), counts


def bucket_counts(texts: DataFrame, most: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in pieces(batches):
            total += np.bincount(features(batch.column("text"), most, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share of the target against its share of the source, rounded down."""
    s_all, t_all, buckets = int(source.sum()), int(target.sum()), len(source)
    values = [
        math.floor(1000 * math.log(float(t + 1) * (s_all + buckets) / (float(s + 1) * (t_all + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ]
    return np.array(values, dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel draw that depends on the id alone."""
    shown = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{shown}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, most: int = NGRAMS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, n_words, weight, score and text_hash of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            gain = sent.value
            found, rows, counts = features(batch.column("text"), most, len(gain))
            sums = np.concatenate(([0], np.cumsum(gain[found][np.argsort(rows, kind="stable")], dtype=np.int64)))
            size = np.bincount(rows, minlength=batch.num_rows)
            ends = np.cumsum(size)
            weight = sums[ends] - sums[ends - size]
            drawn = np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], dtype=np.int64)
            columns = [batch.column("doc_id"), *map(pa.array, (size.astype(np.int64), counts.astype(np.int64), weight, weight + drawn))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("text_hash")], names=names)

    names = ["doc_id", "n_features", "n_words", "weight", "score", "text_hash"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(score, ", ".join(f"{c} long" for c in names))


def _before(keys: np.ndarray, pivot: tuple[int, ...]) -> np.ndarray:
    """Which keys come before the pivot or are it."""
    out = np.ones(len(keys), dtype=bool)
    for column in range(keys.shape[1] - 1, -1, -1):
        out = (keys[:, column] < pivot[column]) | ((keys[:, column] == pivot[column]) & out)
    return out


def _median(keys: np.ndarray) -> tuple[int, list[int]]:
    """How many keys there are, and the middle one."""
    if not len(keys):
        return 0, [0] * keys.shape[1]
    order = np.lexsort(keys.T[::-1])
    return len(keys), keys[order[(len(keys) - 1) // 2]].tolist()


def _medians(keys: DataFrame, pivot: tuple[int, ...] | None) -> dict[bool, list[tuple[int, tuple[int, ...]]]]:
    """The number and the median of each partition's keys up to the pivot (True) and after it (False)."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.stack([b.column(c).to_numpy() for c in _KEY], axis=1) for b in batches if b.num_rows]
        mine = np.concatenate(found) if found else np.zeros((0, len(_KEY)), np.int64)
        early = np.ones(len(mine), dtype=bool) if pivot is None else _before(mine, pivot)
        rows = [(side, *_median(mine[early == side])) for side in (True, False)]
        rows = [(side, n, *key) for side, n, key in rows if n]
        columns = [pa.array([r[0] for r in rows], pa.bool_())]
        columns += [pa.array([r[i] for r in rows], pa.int64()) for i in range(1, len(_KEY) + 2)]
        yield pa.RecordBatch.from_arrays(columns, names=["early", "n", *_KEY])

    schema = "early boolean, n long, " + ", ".join(f"{c} long" for c in _KEY)
    sides: dict[bool, list[tuple[int, tuple[int, ...]]]] = {True: [], False: []}
    for r in keys.mapInArrow(look, schema).collect():
        sides[r.early].append((r.n, tuple(r[c] for c in _KEY)))
    return sides


def weighted_median(medians: list[tuple[int, tuple[int, ...]]]) -> tuple[int, ...]:
    """The first key at which half of all weight is reached."""
    ordered, reached = sorted(medians, key=lambda m: m[1]), 0
    half = sum(n for n, _ in ordered) / 2
    for n, key in ordered:
        reached += n
        if reached >= half:
            return key
    raise ValueError("no keys")


def _upto(pivot: tuple[int, ...]):
    return F.struct(*_KEY) <= F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(_KEY, pivot)])


def cutoff(keys: DataFrame, wanted: int, few: int = FEW) -> tuple[int, ...] | None:
    """The key that is the ``wanted``-th in order; all keys are different. None if none is wanted."""
    keys = keys.coalesce(PARTS)
    sides = {True: _medians(keys, None)[True], False: []}
    total = size = sum(n for n, _ in sides[True])
    if not 0 < wanted <= total:
        return None
    side = True
    while size > few:
        pivot = weighted_median(sides[side])
        sides = _medians(keys, pivot)
        early = sum(n for n, _ in sides[True])
        side = wanted <= early
        if not side:
            wanted -= early
        keys = keys.where(_upto(pivot) if side else ~_upto(pivot))
        size = early if side else size - early
        if total >= 8 * size:
            keys, total = cut(keys).coalesce(PARTS), size
    return sorted(tuple(r) for r in keys.select(*_KEY).collect())[wanted - 1]


def _numbered(winners: DataFrame) -> DataFrame:
    """Adds the place of each row in the order of the keys: sorted by ranges, numbered inside, behind the ranges before."""
    shown = cut(winners.orderBy(*_KEY).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted((r.part, r.n) for r in shown.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = np.cumsum([0] + [n for _, n in sizes]).tolist()
    # One row for each range of the sort.
    starts = winners.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_part long, _before long")
    inside = F.col("_at") - F.shiftleft(part, 33)
    return shown.join(F.broadcast(starts), part == F.col("_part")).withColumn("rank", F.col("_before") + inside + 1)


def resample(
    docs: DataFrame, target: DataFrame, share: int = SHARE, least: int = LEAST_WORDS, most: int = NGRAMS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every document: of those with ``least`` words or more,
    ``share`` percent are drawn."""
    gain = gains(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets))
    # The doc_id comes after all others where it is null, so its key is above every long but one.
    key = {
        "a": -F.col("score"),
        "b": F.coalesce("doc_id", F.lit(2**63 - 1)),
        "c": F.coalesce("text_hash", F.lit(0)),
        "d": F.monotonically_increasing_id(),
    }
    rows = cut(scored(docs, gain, most, seed).withColumns(key))
    able = rows.where(F.col("n_words") >= least)
    wanted = share * able.count() // 100
    last = cutoff(able.select(*_KEY), wanted)
    shown = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*shown, F.lit(None).cast("long").alias("rank"))
    won = (F.col("n_words") >= least) & _upto(last)
    lost = rows.where(~won).select(*shown, F.lit(None).cast("long").alias("rank"))
    return _numbered(rows.where(won)).select(*shown, "rank").unionByName(lost)
