"""Packing documents into sequences of at most ``CAPACITY`` tokens, as a cutting-stock problem.

A document of n tokens is cut into pieces of ``CAPACITY``, a piece whose length is a multiple of ``STEP``, and a tail shorter
than ``STEP``; so there are fewer than CAPACITY / STEP + STEP different lengths below the capacity, whatever the corpus. The
histogram of lengths is all that the driver sees. Column generation solves the linear program over patterns (how many pieces
of each length share a sequence): a basis of patterns gives a price for each length, a knapsack recursion over the capacity
finds the pattern of most worth at these prices, and it enters the basis until none is worth more than a sequence. The uses
of each pattern are rounded down; what is left over, less than one use of each, fills sequences one by one, each beginning
with the largest piece and then filled as far as any sum of the others goes.

Pieces of a length are ranked, and ranks are dealt to the patterns' uses in order. As all pieces of a length are alike, a
piece's sequence and its offset there follow from its rank by arithmetic, without another shuffle.

A null or empty text is the end id alone. Rows that share a doc_id, or have none, are packed one by one. An empty table makes
no pieces. Long texts are encoded whole. Ids are never moved: a piece's checksum is taken where it is cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import cut, running_total
from tidemark.llm.text import pieces as small_batches
from tidemark.llm.text import release
from tidemark.llm.tokens import BATCH_BYTES, Vocabulary, encoder, with_end

CAPACITY = 2048
STEP = 32
_ROUNDS = 5000


def cuts(n: int) -> list[int]:
    """The lengths of the pieces of a document of n tokens."""
    full, rest = divmod(n, CAPACITY)
    tail = rest % STEP
    return [CAPACITY] * full + [x for x in (rest - tail, tail) if x]


def cut_documents(docs: DataFrame, vocabulary: Vocabulary, end: int) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of every piece."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary.content, vocabulary.cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*sent.value)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            ids, ends = with_end(*encode.encode(batch.column("text")), end)
            ids = ids.astype("<u4")
            row, start, length, crc = [], [], [], []
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                at = 0
                for size in cuts(b - a):
                    row.append(i)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[a + at : a + at + size]))
                    at += size
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64()))]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            columns.append(pa.array(np.diff(ends)[np.array(row, dtype=np.int64)], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        encode.forget()
        release()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def best_pattern(lengths: np.ndarray, prices: np.ndarray) -> tuple[float, np.ndarray]:
    """The pattern of most worth, by the knapsack recursion; any number of pieces of each length."""
    worth = np.zeros((len(lengths) + 1, CAPACITY + 1))
    for i, (length, price) in enumerate(zip(lengths.tolist(), prices.tolist())):
        row = worth[i].copy()
        step = length
        gain = price
        while step <= CAPACITY and price > 0:
            row[step:] = np.maximum(row[step:], row[:-step] + gain)
            step, gain = 2 * step, 2 * gain
        worth[i + 1] = row
    left, pattern = CAPACITY, np.zeros(len(lengths), dtype=np.int64)
    for i in range(len(lengths) - 1, -1, -1):
        k = np.arange(left // lengths[i] + 1)
        pattern[i] = int(np.argmax(worth[i, left - k * lengths[i]] + k * prices[i]))
        left -= int(pattern[i] * lengths[i])
    return float(pattern @ prices), pattern


def linear_program(lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The patterns (columns) of an optimal basis and how often each is used, in fractions."""
    base = np.diag(CAPACITY // lengths).astype(np.float64)
    used = counts / np.diag(base)
    for _ in range(_ROUNDS):
        prices = np.linalg.solve(base.T, np.ones(len(lengths)))
        value, pattern = best_pattern(lengths, prices)
        if value <= 1 + 1e-9:
            break
        change = np.linalg.solve(base, pattern.astype(np.float64))
        ratio = np.where(change > 1e-9, used / np.where(change > 1e-9, change, 1), np.inf)
        out = int(np.argmin(ratio))
        step = ratio[out]
        used = np.maximum(used - step * change, 0)
        used[out] = step
        base[:, out] = pattern
    return np.round(base).astype(np.int64), used


def fill(lengths: np.ndarray, left: np.ndarray) -> np.ndarray:
    """One sequence from what is left: the largest piece, then the fullest sum that others make; as a pattern."""
    pattern = np.zeros(len(lengths), dtype=np.int64)
    first = int(np.flatnonzero(left)[np.argmax(lengths[left > 0])])
    pattern[first] = 1
    free = CAPACITY - int(lengths[first])
    sums, steps = 1, []  # bit s is set if some pieces sum to s
    for i in np.argsort(lengths):
        n = int(left[i] - pattern[i])
        size = 1
        while n > 0 and lengths[i] <= free:
            take = min(size, n)
            steps.append((int(i), take, sums))
            sums |= (sums << (take * int(lengths[i]))) & ((1 << (free + 1)) - 1)
            n, size = n - take, size * 2
    at = sums.bit_length() - 1
    for i, take, before in reversed(steps):
        if not before >> at & 1:
            pattern[i] += take
            at -= take * int(lengths[i])
    return pattern


def plan(histogram: dict[int, int]) -> list[tuple[int, np.ndarray]]:
    """(uses, pattern) over the sorted lengths below the capacity: together, every piece once."""
    lengths = np.array(sorted(x for x in histogram if x < CAPACITY), dtype=np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[x] for x in lengths.tolist()], dtype=np.int64)
    base, used = linear_program(lengths, counts.astype(np.float64))
    out, left = [], counts.copy()
    for k in np.argsort(-used):
        pattern = base[:, k]
        uses = int(used[k] + 1e-6)
        some = pattern > 0
        uses = min(uses, int((left[some] // pattern[some]).min()))
        if uses:
            out.append((uses, pattern))
            left -= uses * pattern
    while left.any():
        pattern = fill(lengths, left)
        some = pattern > 0
        uses = int((left[some] // pattern[some]).min())
        out.append((uses, pattern))
        left -= uses * pattern
    return out


def deal(histogram: dict[int, int]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length: (first rank, first sequence, pieces in a sequence, first offset) of every pattern that has it."""
    lengths = sorted(x for x in histogram if x < CAPACITY)
    hands: dict[int, list] = {x: [] for x in lengths}
    rank = dict.fromkeys(lengths, 0)
    sequence = histogram.get(CAPACITY, 0)
    for uses, pattern in plan(histogram):
        offset = 0
        for length, n in zip(lengths, pattern.tolist()):
            if n:
                hands[length].append((rank[length], sequence, n, offset))
                rank[length] += uses * n
                offset += n * length
        sequence += uses
    if histogram.get(CAPACITY):
        hands[CAPACITY] = [(0, 0, 1, 0)]
    return hands


def pack(docs: DataFrame, vocabulary: Vocabulary, end: int) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    found = cut(cut_documents(docs, vocabulary, end))
    histogram = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    hands = deal(histogram)
    ranked = running_total(found, ["length"], ["doc_id", "start", "ids_crc32"], F.lit(1), "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: np.array(v, dtype=np.int64) for k, v in hands.items()}
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length).tolist():
                at = np.flatnonzero(length == size)
                hand = tables[size]
                ranks, sequences, n, first = hand[np.searchsorted(hand[:, 0], rank[at], side="right") - 1].T
                sequence[at] = sequences + (rank[at] - ranks) // n
                offset[at] = first + (rank[at] - ranks) % n * size
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
