"""Document fingerprints: one-permutation MinHash, densified, a few bits of each bin.

A text's shingles (runs of ``SHINGLE`` words, or all its words if it has fewer) are hashed once. The top bits of a hash name
one of ``BINS`` bins, the rest is the value; a bin keeps its smallest value. An empty bin i takes the value of the first
filled bin in a pseudorandom order of all bins that belongs to i, the same for every text, so two texts agree in a bin
with the probability of their shingle sets' Jaccard likeness. ``BITS`` low bits of each bin are packed into the fingerprint.
Of m agreeing bins, some agree by chance: likeness = (m / BINS - c) / (1 - c) with c = 2 ** -BITS, held between 0 and 1.

A null, empty or white text has the empty fingerprint: likeness 1 to another empty one, 0 to others. Equal texts have equal
fingerprints. Long texts are hashed whole, a megabyte at a time. In ``edited_pairs`` documents with the same doc_id follow
each other by text; a null doc_id comes first; a lone document follows itself; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import in_order, stretch_bounds, with_stretch
from tidemark.llm.text import pieces, shingle_hashes, word_hashes, words_of

SHINGLE = 5
BINS = 512
BITS = 4
_EMPTY = np.uint64(2**64 - 1)


def _bins(texts: pa.Array, shingle: int) -> np.ndarray:
    """The smallest value of each bin (columns) of each text (rows); all bits set where there is none."""
    words = words_of(texts)
    hashes, row = shingle_hashes(word_hashes(words), words.first, shingle)
    out = np.full(len(texts) * BINS, _EMPTY, dtype=np.uint64)
    width = np.uint64(64 - (BINS - 1).bit_length())
    place = row * BINS + (hashes >> width).astype(np.int64)
    np.minimum.at(out, place, hashes & ((np.uint64(1) << width) - np.uint64(1)))
    return out.reshape(-1, BINS)


def _densified(bins: np.ndarray) -> np.ndarray:
    """Empty bins filled from others; rows without any value stay empty."""
    random = np.random.default_rng(17)
    start, step = random.integers(0, BINS, BINS), random.integers(0, BINS // 2, BINS) * 2 + 1
    out, filled = bins.copy(), bins != _EMPTY
    row, at = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    for turn in range(BINS):
        if not len(row):
            break
        other = (start[at] + turn * step[at]) % BINS
        hit = filled[row, other]
        out[row[hit], at[hit]] = bins[row[hit], other[hit]]
        row, at = row[~hit], at[~hit]
    return out


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """One row of packed bits for each text, as bytes; and a last column that is 1 where a text has no shingle."""
    dense = _densified(_bins(texts, shingle))
    none = dense[:, 0] == _EMPTY
    low = (dense & np.uint64(2**BITS - 1)).astype(np.uint8)
    bits = np.unpackbits(low[:, :, None], axis=2)[:, :, 8 - BITS :].reshape(len(low), -1)
    packed = np.packbits(bits, axis=1)
    packed[none] = 0
    return np.column_stack((packed, none.astype(np.uint8)))


def shown(prints: np.ndarray) -> list[str]:
    """Fingerprints as text: the packed bits in base 64; empty where a text has no shingle."""
    return ["" if p[-1] else base64.b64encode(p[:-1].tobytes()).decode() for p in prints]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The estimated Jaccard likeness of rows of fingerprints, without the agreement that comes by chance."""
    differ = np.unpackbits(a[:, :-1] ^ b[:, :-1], axis=1).reshape(len(a), BINS, BITS).any(axis=2)
    chance = 2.0**-BITS
    out = np.clip(((1 - differ.mean(axis=1)) - chance) / (1 - chance), 0, 1)
    none = a[:, -1] + b[:, -1]
    return np.where(none == 2, 1.0, np.where(none == 1, 0.0, out))


def fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            prints = shown(fingerprints(batch.column("text"), shingle))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def _with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, stretch and borrowed, streams in order; each stretch ends with a copy of the next one's first row."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    bounds = stretch_bounds(ids)
    placed = with_stretch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), bounds)
    # One small row for each stretch: the key that it begins with, and the stretch before it; the first follows the last.
    starts = with_stretch(ids, bounds).groupBy("stretch")
    starts = starts.agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("k"))
    rows = sorted((r.stretch, r.k.doc_id) for r in starts.collect())
    before = {s: rows[i - 1][0] for i, (s, _) in enumerate(rows)}
    low = {s: k for s, k in rows}
    if not rows:
        return placed.withColumn("borrowed", F.lit(False)).limit(0)
    heads = placed.sparkSession.createDataFrame([(s, low[s], before[s]) for s in before], "own int, head long, give int")
    match = (F.col("stretch") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head"))
    here = F.struct(F.col("stretch"), F.lit(False).alias("borrowed"))
    there = F.struct(F.col("give").alias("stretch"), F.lit(True).alias("borrowed"))
    places = F.when(F.col("own").isNotNull(), F.array(here, there)).otherwise(F.array(here))
    # At most STRETCHES rows.
    spread = placed.join(F.broadcast(heads), match, "left").withColumn("at", F.explode(places))
    moved = spread.select("doc_id", "text", F.col("at.stretch").alias("stretch"), F.col("at.borrowed").alias("borrowed"))
    return in_order(moved, [F.col("borrowed"), F.col("doc_id").asc_nulls_first(), F.col("text")])


def edited_pairs(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Every document against its edited text (its last quarter replaced by the beginning of the next document) and against
    the next document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in pieces(batches):
            table = pa.Table.from_batches([batch])
            table = table if last is None else pa.concat_tables([last, table])
            last = table.slice(len(table) - 1)
            stretch, borrowed = (table.column(c).to_numpy() for c in ("stretch", "borrowed"))
            pair = np.flatnonzero((stretch[1:] == stretch[:-1]) & ~borrowed[:-1].astype(bool))
            if not len(pair):
                continue
            texts = table.column("text").to_pylist()
            edited = []
            for i in pair.tolist():
                text, k = texts[i], len(texts[i]) // 4
                edited.append(text[: len(text) - k] + texts[i + 1][:k])
            own = fingerprints(table.column("text"), shingle)
            other = fingerprints(pa.array(edited, pa.string()), shingle)
            ids = table.column("doc_id").combine_chunks().take(pa.array(pair))
            columns = [
                ids,
                pa.array([len(texts[i]) for i in pair], pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited], pa.string()),
                pa.array(shown(own[pair]), pa.string()),
                pa.array(shown(other), pa.string()),
                pa.array(likeness(own[pair], other)),
                pa.array(likeness(own[pair], own[pair + 1])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return _with_next(docs).mapInArrow(run, schema)
