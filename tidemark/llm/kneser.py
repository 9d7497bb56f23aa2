"""Quality by an n-gram model: interpolated modified Kneser-Ney over word pairs, trained on trusted text.

A text is its words between a start and an end. Pairs of words are counted over all text of ``TRAINED`` in ``FOLDS`` of the
trusted documents, by a hash of doc_id; trusted are those whose labels all say quality 1. The others, which the model hasn't
seen, set the thresholds. A pair's discounted probability falls back on its second word's, by the number of different words
before it, and a word's on its spelling: a model of the same kind over bytes folded to ``SYMBOLS`` classes, in runs of
``ORDER`` inside a word, each byte an even share of its class. So every text has a probability. Each model has three
discounts for each order from the counts of counts.

The pairs and words grow with the corpus, and neither the driver nor a task sees all of them. Texts are written once as blocks of
about ``BLOCK_BYTES``: the block's different words, and for each of its words a number. From then on only blocks are read. Counts
are joined by shard of a 64-bit hash: each block sends each shard its different pairs, sorted and as differences, with
their trained counts; the shard adds the counts of all blocks up and answers each block, in the order in which it has asked, so no
key and no row's id travels back. Of the blocks that have trained on a pair one is told that the pair is its own, so that
block counts it for its two words: once before the second, and with its count after the first. These sums go through shards in
the same way. Then a block has what it needs to score its texts. All this goes in ``ROUNDS`` rounds: in each a part of the shards
is asked, or of the blocks scored, and what it has shuffled is removed when it ends, so the lists are never all on disk at once.
A frequent pair or word is one entry a block, however often it occurs. A shard has the keys of about two blocks, up to
``SHARDS`` shards. Only the spellings' SYMBOLS ** ORDER = 1,048,576 runs are sent to the tasks, four megabytes. A pair's surprise is a whole number of micronats, so sums are the same in any order.

A document's score is its mean surprise for a symbol (a word's, and one for each word's end and the text's); its perplexity is
exp of it. A language's threshold is the ``QUANTILE`` over its unseen trusted documents of surprise less SLACK /
sqrt(length), as the mean over a short text strays further, plus ``MARGIN``. It is drawn towards the quantile over all languages,
which weighs as much as ``PRIOR`` documents of the language, so a language with few of them leans on the others and one
with many does not; one without any uses that quantile.

A text without words (null, empty, white) has perplexity null and is kept, as nothing speaks against it. A null language is a
language. Rows that share a doc_id are scored one by one; a document without doc_id isn't trusted. Without trusted documents
nothing is rejected. An empty table gives no rows. Long texts are scored whole; one beyond the size of a block is a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import cut
from tidemark.llm.text import WHITE, Words, buffers, mix, pieces, release, word_hashes, words_of
from tidemark.session import fresh_dir, shuffles_removed

ORDER = 4
BITS = 5
SYMBOLS = 1 << BITS
QUANTILE = 0.99
SLACK = 1.5
MARGIN = 0.15
PRIOR = 30
FOLDS = 5
TRAINED = 4
_BIN = 1000
BLOCK_BYTES = 4 << 20
SHARDS = 4096
BUCKETS = 1 << 14
# The shards are asked, and the blocks scored, in so many rounds; what a round has shuffled is removed before the next.
ROUNDS = 4

_DROP = 255
_CLASS = np.full(256, 31, dtype=np.uint8)
_CLASS[WHITE] = 0
_CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x41:0x5B] = 27
_CLASS[0xC0:] = 28
_CLASS[0x30:0x3A] = 29
_CLASS[list(b".,;:!?'\"()-")] = 30
_CLASS[0x80:0xC0] = _DROP
# Micronats of a byte among those of its class.
_WITHIN = np.round(1e6 * np.log(np.bincount(_CLASS, minlength=256)[_CLASS])).astype(np.int64)

# Fixed values that stand for a text's start and end.
_START = np.uint64(0x51A27)
_END = np.uint64(0xE4D)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code of the run that ends at each symbol, and the offsets of the rows. White space stands before each text."""
    raw, offsets = buffers(texts)
    folded = _CLASS[raw]
    solid = folded != _DROP
    offsets = np.concatenate(([0], np.cumsum(solid)))[offsets]
    folded = folded[solid]
    counts = np.diff(offsets)
    at = np.arange(len(folded)) + (ORDER - 1) * (np.repeat(np.arange(len(counts)), counts) + 1)
    padded = np.zeros(len(folded) + (ORDER - 1) * len(counts), dtype=np.uint32)
    padded[at] = folded
    code = padded[at]
    for k in range(1, ORDER):
        code = code | (padded[at - k] << np.uint32(BITS * k))
    return code, offsets


def trusted_ids(labels: DataFrame, trained: bool) -> DataFrame:
    """The doc_ids whose labels all say quality 1: those that the model is trained on, or the others."""
    labels = labels.where((F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FOLDS)) < TRAINED) == F.lit(trained))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return marks.agg(F.min(F.coalesce("quality", F.lit(0))).alias("quality")).where("quality = 1").select("doc_id")


class Sequences:
    """Texts as numbers of their different words, with a start and an end around each text that has words.

    ``words`` are the different words, ``which`` the number of each word, ``counts`` the words of each row. ``ids`` has starts and
    ends too, whose numbers follow those of the words; ``hashes`` has the hash of each number, ``rows`` the row of each of ``ids``.
    """

    def __init__(self, words: Words, which: np.ndarray, counts: np.ndarray):
        self.words, self.which, self.counts = words, which, counts
        self.start = len(words.starts)
        self.hashes = np.concatenate((word_hashes(words), [_START, _END]))
        sizes = np.where(counts > 0, counts + 2, 0)
        self.rows = np.repeat(np.arange(len(sizes)), sizes)
        stops = np.cumsum(sizes)
        heads, tails = (stops - sizes)[sizes > 0], stops[sizes > 0] - 1
        inner = np.ones(len(self.rows), dtype=bool)
        inner[heads] = inner[tails] = False
        self.ids = np.zeros(len(self.rows), dtype=np.int64)
        self.ids[inner] = which
        self.ids[heads], self.ids[tails] = self.start, self.start + 1

    @staticmethod
    def of(texts: pa.Array) -> Sequences:
        """The frequent words have the small numbers."""
        words = words_of(texts)
        _, at, which, times = np.unique(word_hashes(words), return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        different = Words(words.raw, words.starts[at[order]], words.ends[at[order]], np.zeros(0, np.int64))
        return Sequences(different, number[which], np.diff(words.first))

    def packed(self) -> bytes:
        texts, _ = self.spellings()
        raw, _ = buffers(texts)
        sizes = np.array([len(raw), len(self.which), len(self.counts)], dtype=np.int64)
        parts = (sizes, raw, _planes(self.which.astype(np.uint32)), _planes(self.counts.astype(np.uint32)))
        return sizes.tobytes() + pa.compress(b"".join(x.tobytes() for x in parts[1:]), codec="zstd", asbytes=True)

    @staticmethod
    def unpacked(data: pa.Buffer) -> Sequences:
        n, m, rows = (int(x) for x in np.frombuffer(data, np.int64, 3))
        flat = np.frombuffer(pa.decompress(data.slice(24), n + 4 * (m + rows), codec="zstd"), np.uint8)
        raw = flat[:n]
        # Each word ends with a white; the last is the text's end, which has no letters.
        ends = np.flatnonzero(WHITE[raw])[:-1]
        starts = np.concatenate(([0], ends + 1))[: len(ends)]
        which = _numbers(flat[n : n + 4 * m], np.uint32).astype(np.int64)
        counts = _numbers(flat[n + 4 * m :], np.uint32).astype(np.int64)
        return Sequences(Words(raw, starts, ends, np.zeros(0, np.int64)), which, counts)

    def spellings(self, of: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
        """Each different word with a white after it, last the end (no word, and a white), and how often they occur in rows
        that ``of`` marks."""
        words = self.words
        lengths = np.append(words.ends - words.starts, 0)
        offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
        flat = np.full(offsets[-1], 0x20, dtype=np.uint8)
        word = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        flat[offsets[:-1][word] + place] = words.raw[np.append(words.starts, 0)[word] + place]
        made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
        times = np.bincount(self.ids if of is None else self.ids[of[self.rows]], minlength=self.start + 2)
        return made, np.delete(times, self.start)

    def spelled(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and micronats of the spelling of each number; nothing for a start."""
        texts, _ = self.spellings()
        code, offsets = runs(texts)
        raw, ends = buffers(texts)
        nats = np.concatenate(([0], np.cumsum(table[code], dtype=np.int64)))[offsets]
        within = np.concatenate(([0], np.cumsum(_WITHIN[raw])))[ends]
        # A white is one of several, but only ends a word.
        found = np.diff(offsets), np.diff(nats) + np.diff(within) - _WITHIN[0x20]
        return tuple(np.insert(x, self.start, 0) for x in found)

    def pair_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The place of the second of each pair of words, and the pair's key."""
        at = np.flatnonzero(self.ids != self.start)
        return at, mix((mix(self.hashes) * _PAIR)[self.ids[at - 1]] + self.hashes[self.ids[at]])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the different pairs, in order, their first and second numbers; for each pair of words which it is, and its row."""
        at, every = self.pair_keys()
        keys, which = np.unique(every, return_inverse=True)
        one = np.empty(len(keys), dtype=np.int64)
        one[which] = at
        return keys, self.ids[one - 1], self.ids[one], which, self.rows[at]

    def sums(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The sum of whole numbers over each row; ``rows`` ascend."""
        total = np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
        return np.diff(total[np.searchsorted(rows, np.arange(len(self.counts) + 1))])


def _planes(x: np.ndarray) -> np.ndarray:
    """The lowest bytes of all numbers, then the next ones and so on: high ones are mostly zero and compress."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T


def _numbers(flat: np.ndarray, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(kind).ravel()


def _pack(columns: list[np.ndarray]) -> bytes:
    return pa.compress(b"".join(_planes(c.astype(np.uint64)).tobytes() for c in columns), codec="zstd", asbytes=True)


def _unpack(data: pa.Buffer, n: int, width: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(data, 8 * n * width, codec="zstd"), np.uint8)
    return np.stack([_numbers(flat[8 * n * i : 8 * n * (i + 1)], np.uint64) for i in range(width)])


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """In the order of the keys, so that sorted keys lie shard by shard."""
    return (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


# What a block asks of a shard: keys (as differences) and columns of n numbers.
_LIST = "block long, shard long, n long, data binary"


def rounds(shards: int) -> list[range]:
    """All shards, in parts of nearly one size: ``ROUNDS``, or as many as there are shards."""
    edges = np.linspace(0, shards, min(ROUNDS, shards) + 1).astype(int).tolist()
    return [range(a, b) for a, b in zip(edges, edges[1:])]


def lists(block: int, keys: np.ndarray, columns: list[np.ndarray], shards: int, of: range | None = None) -> pa.Table:
    """One row for each shard, among those ``of`` has, that has some of the block's sorted keys."""
    of = range(shards) if of is None else of
    edges = np.searchsorted(shard_of(keys, shards), np.arange(of.start, of.stop + 1))
    full = np.flatnonzero(np.diff(edges))
    data = []
    for a, b in zip(edges[full], edges[full + 1]):
        data.append(_pack([np.diff(keys[a:b], prepend=np.uint64(0)), *[c[a:b] for c in columns]]))
    ids = np.full(len(full), block, dtype=np.int64)
    return pa.table([pa.array(ids), pa.array(full + of.start), pa.array(np.diff(edges)[full]), pa.array(data, pa.binary())], ["block", "shard", "n", "data"])


def added(asked: DataFrame, width: int, owned: bool = False) -> DataFrame:
    """The answers: for each list the sums of its keys' columns over all blocks. With ``owned`` the first is twice its sum, and one
    more if the key is the block's own.

    ``few`` has the number of the shard's different keys whose first column is 1, 2, 3, 4, at least 1, and that column's sum; it
    stands with one of the shard's lists.
    """

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        ns = table["n"].to_numpy()
        found = [_unpack(d.as_buffer(), n, width + 1) for d, n in zip(table["data"], ns)]
        keys = np.concatenate([np.cumsum(f[0], dtype=np.uint64) for f in found])
        columns = np.concatenate([f[1:] for f in found], axis=1).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, columns = keys[order], columns[:, order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        begin, group = np.flatnonzero(new), np.cumsum(new) - 1
        sums = np.add.reduceat(columns, begin, axis=1)
        answers = np.empty((width, len(keys)), dtype=np.int64)
        answers[:, order] = sums[:, group]
        if owned:
            # The first block, in order, that has counted the key.
            has = np.flatnonzero(columns[0] > 0)
            mine = has[np.unique(group[has], return_index=True)[1]]
            answers[0] *= 2
            answers[0, order[mine]] += 1
        ends = np.cumsum(ns)
        data = [_pack(list(answers[:, e - n : e])) for e, n in zip(ends, ns)]
        few = [int((sums[0] == k).sum()) for k in (1, 2, 3, 4)] + [int((sums[0] > 0).sum()), int(sums[0].sum())]
        fews = pa.array([few] + [None] * (len(ns) - 1), pa.list_(pa.int64()))
        return pa.table([table["block"], table["shard"], table["n"], pa.array(data, pa.binary()), fews], ["block", "shard", "n", "data", "few"])

    return asked.groupBy("shard").applyInArrow(add, f"{_LIST}, few array<long>")


def _answer(table: pa.Table, width: int) -> np.ndarray:
    """The columns of a block's answers, in the order of its keys."""
    table = table.sort_by("shard")
    found = [_unpack(d.as_buffer(), n, width) for d, n in zip(table["data"], table["n"].to_pylist())]
    return np.concatenate(found, axis=1).astype(np.int64) if found else np.zeros((width, 0), np.int64)


def few_of(answers: DataFrame) -> list[int]:
    sums = answers.agg(*[F.coalesce(F.sum(F.col("few")[i]), F.lit(0)).alias(f"f{i}") for i in range(6)])
    return list(sums.first())


def row_key():
    """Rows with equal keys have the same doc_id and text, so the same score."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def _stored(parts: Iterator[DataFrame], purpose: str) -> DataFrame:
    """The rows of all parts as a table in the shared folder. A part is written, and what it has shuffled removed, before the next."""
    path = None
    for part in parts:
        path = path or fresh_dir(part.sparkSession, purpose)
        part.write.mode("append").parquet(path)
    return part.sparkSession.read.parquet(path)


@contextmanager
def stored_blocks(docs: DataFrame) -> Iterator[DataFrame]:
    """The blocks of documents as a table in the shared folder, in buckets by block, so that what is known of a block comes to
    it and blocks are never shuffled. The catalog knows the table as long as it is in use."""
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(docs.rdd.getNumPartitions(), BUCKETS))
    path = fresh_dir(spark, "word-blocks")
    name = "word_blocks_" + path.rsplit("-", 1)[1]
    blocks(docs).write.format("parquet").option("path", path).bucketBy(buckets, "block").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def blocks(docs: DataFrame) -> DataFrame:
    """block, data, and doc_id, lang and row (its key) of each of the block's rows."""
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), row_key().alias("row"), "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only one try of a task is committed, so a block's number is its own.
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(pieces(batches, most=BLOCK_BYTES)):
            names = ["doc_id", "lang", "row"]
            known = [pa.array([batch.column(c).to_pylist()], pa.list_(batch.schema.field(c).type)) for c in names]
            data = pa.array([Sequences.of(batch.column("text")).packed()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([first + number]), data, *known], names=["block", "data", *names])

    return kept.mapInArrow(pack, "block long, data binary, doc_id array<long>, lang array<string>, row array<long>")


def trained_rows(encoded: DataFrame, labels: DataFrame) -> DataFrame:
    """block and trained: the places of the block's rows that the model is trained on; only blocks that have such rows."""
    rows = encoded.select("block", F.posexplode("doc_id").alias("at", "doc_id"))
    # Labels grow with the corpus, so the join is never planned as a broadcast, however few they are.
    rows = rows.join(trusted_ids(labels, True).hint("merge"), "doc_id", "left_semi")
    return rows.groupBy("block").agg(F.collect_list("at").alias("trained"))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Sequences, np.ndarray]]:
    """The blocks of batches, and which of their rows the model is trained on."""
    for batch in batches:
        for i in range(batch.num_rows):
            found = Sequences.unpacked(batch.column("data")[i].as_buffer())
            trained = np.zeros(len(found.counts), dtype=bool)
            if "trained" in batch.schema.names and batch.column("trained")[i].is_valid:
                trained[batch.column("trained")[i].values.to_numpy()] = True
            yield batch.column("block")[i].as_py(), found, trained
    release()


def count_runs(encoded: DataFrame, trained: DataFrame) -> DataFrame:
    """gram (the run's code) and c, inside each word, and the end, of the texts that the model is trained on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, dtype=np.int64)
        for _, found, of in _each(batches):
            texts, times = found.spellings(of)
            code, offsets = runs(texts)
            np.add.at(total, code, np.repeat(times, np.diff(offsets)))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "c"])

    every = encoded.select("block", "data").join(trained.hint("shuffle_hash"), "block")
    return every.mapInArrow(count, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def ask_pairs(encoded: DataFrame, trained: DataFrame, shards: int, of: range | None = None) -> DataFrame:
    """The pairs of all blocks with the number of times that the model is trained on them; ``of``: of these shards."""
    of = range(shards) if of is None else of

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, found, trained_on in _each(batches):
            at, keys = found.pair_keys()
            shard = shard_of(keys, shards)
            inside = (shard >= of.start) & (shard < of.stop)
            keys, which = np.unique(keys[inside], return_inverse=True)
            counts = np.bincount(which[trained_on[found.rows[at[inside]]]], minlength=len(keys))
            yield from lists(block, keys, [counts], shards, of).to_batches()

    every = encoded.select("block", "data").join(trained.hint("shuffle_hash"), "block", "left")
    return every.mapInArrow(ask, _LIST)


def ask_words(encoded: DataFrame, answers: DataFrame, shards: int, of: range | None = None) -> DataFrame:
    """The words of all blocks; ``of``: of these shards. Of the block's own pairs: before the word (their number), after it (their
    counts' sum, and the number of those with a count of 1, 2 and more)."""

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block, found, _ in _each(left.to_batches()):
            _, first, second, _, _ = found.pairs()
            c, own = np.divmod(_answer(right, 1)[0], 2)
            size, own = len(found.hashes), own > 0
            f, s, c = first[own], second[own], c[own]
            after = np.zeros(size, dtype=np.int64)
            np.add.at(after, f, c)
            kinds = [np.bincount(f[k], minlength=size) for k in (c == 1, c == 2, c > 2)]
            keys = mix(found.hashes)
            order = np.argsort(keys)
            columns = [x[order] for x in (np.bincount(s, minlength=size), after, *kinds)]
            out.append(lists(block, keys[order], columns, shards, of))
        return pa.concat_tables(out) if out else lists(0, np.zeros(0, np.uint64), [], 1)

    asked = encoded.select("block", "data").groupBy("block").cogroup(answers.select("block", "shard", "n", "data").groupBy("block"))
    return asked.applyInArrow(ask, _LIST)


def discounts(n: dict[int, int]) -> tuple[float, float, float]:
    """The discounts for counts 1, 2 and 3 or more, from how many runs were counted 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9)
    return tuple(min(max(d, 0.05), k) for d, k in zip(found, (0.95, 1.9, 2.9)))


def surprise_table(counts: DataFrame) -> np.ndarray:
    """Micronats of every run, seen or not: SYMBOLS ** ORDER whole numbers, whatever the size of the corpus."""
    found = counts.toArrow()
    level = np.zeros(SYMBOLS**ORDER, dtype=np.int64)
    level[found["gram"].to_numpy()] = found["c"].to_numpy()
    levels = [level]
    for _ in range(ORDER - 1):
        levels.append((levels[-1].reshape(SYMBOLS, -1) > 0).sum(axis=0))
    below = np.full(1, 1.0 / SYMBOLS)
    for level in reversed(levels):
        c = level.reshape(-1, SYMBOLS)
        minus = _minus(c, discounts({k: int((c == k).sum()) for k in (1, 2, 3, 4)}))
        total = c.sum(axis=1, keepdims=True)
        some = np.maximum(total, 1)
        gamma = np.where(total > 0, minus.sum(axis=1, keepdims=True) / some, 1.0)
        below = ((c - minus) / some + gamma * np.tile(below, c.size // len(below)).reshape(c.shape)).ravel()
    return np.round(-1e6 * np.log(np.maximum(below, 1e-12))).astype(np.int32)


def _minus(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """The discount of each count."""
    return np.array((0.0, *d))[np.minimum(c, 3)]


@dataclass
class Fallbacks:
    """Discounts of pairs and of words, what the words leave to the spelling, and the number of different trained pairs."""

    d2: tuple[float, float, float]
    d1: tuple[float, float, float]
    left: float
    types: int


def pair_nats(first: np.ndarray, second: np.ndarray, c: np.ndarray, words: np.ndarray, spelled: np.ndarray, to: Fallbacks) -> np.ndarray:
    """Micronats of each different pair, from its count and the five sums of each word."""
    before, after, *kinds = words
    some = np.maximum(after, 1)
    gamma = np.where(after > 0, sum(k * d for k, d in zip(kinds, to.d2)) / some, 1.0)
    below = (before - _minus(before, to.d1)) / max(to.types, 1) + to.left * np.exp(-spelled / 1e6)
    prob = (c - _minus(c, to.d2)) / some[first] + gamma[first] * below[second]
    # A long unknown word's probability may be too small for a double, its logarithm isn't.
    unknown = (c == 0) & (before[second] == 0)
    log = np.log(np.where(unknown, gamma[first] * to.left, prob))
    return np.round(np.where(unknown, spelled[second], 0) - 1e6 * log).astype(np.int64)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, row (its key), n_symbols and micronats of every document."""
    with shuffles_removed(docs.sparkSession), stored_blocks(docs) as encoded:
        return block_scores(encoded, labels)


def block_scores(encoded: DataFrame, labels: DataFrame) -> DataFrame:
    """The scores of the rows of all blocks, kept in the shared folder."""
    shards = max(1, min(encoded.count() // 2, SHARDS))
    trained = cut(trained_rows(encoded, labels))
    table = surprise_table(count_runs(encoded, trained))
    pairs = _stored((added(ask_pairs(encoded, trained, shards, of), 1, owned=True) for of in rounds(shards)), "pair-counts")
    n1, n2, n3, n4, _, _ = few_of(pairs)
    d2 = discounts({1: n1, 2: n2, 3: n3, 4: n4})
    words = _stored((added(ask_words(encoded, pairs, shards, of), 5) for of in rounds(shards)), "word-counts")
    n1, n2, n3, n4, kinds, types = few_of(words)
    d1 = discounts({1: n1, 2: n2, 3: n3, 4: n4})
    left = (n1 * d1[0] + n2 * d1[1] + (kinds - n1 - n2) * d1[2]) / types if types else 1.0
    to = Fallbacks(d2, d1, left, types)
    sent = encoded.sparkSession.sparkContext.broadcast(table)

    def score(one: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for _, found, _ in _each(one.to_batches()):
            kind = answers["kind"].to_numpy()
            _, first, second, which, rows = found.pairs()
            c = _answer(answers.filter(pa.array(kind == 2)), 1)[0] // 2
            order = np.argsort(mix(found.hashes))
            sums = np.empty((5, len(order)), dtype=np.int64)
            sums[:, order] = _answer(answers.filter(pa.array(kind == 1)), 5)
            symbols, spelled = found.spelled(sent.value)
            nats = pair_nats(first, second, c, sums, spelled, to)
            full = [found.sums(symbols[found.ids], found.rows), found.sums(nats[which], rows)]
            known = [one[c].combine_chunks().flatten() for c in ("doc_id", "lang", "row")]
            out.append(pa.table([*known, *[pa.array(x) for x in full]], ["doc_id", "lang", "row", "n_symbols", "micronats"]))
        return pa.concat_tables(out)

    both = pairs.select("block", "shard", "n", "data", F.lit(2).alias("kind")).unionByName(
        words.select("block", "shard", "n", "data", F.lit(1).alias("kind"))
    )
    parts = len(rounds(shards))
    scored = []
    for k in range(parts):
        mine = F.pmod(F.xxhash64("block"), F.lit(parts)) == k
        met = encoded.where(mine).groupBy("block").cogroup(both.where(mine).groupBy("block"))
        scored.append(cut(met.applyInArrow(score, "doc_id long, lang string, row long, n_symbols long, micronats long")))
    return reduce(DataFrame.unionByName, scored)


def _lowered(micronats: str = "micronats", n: str = "n_symbols"):
    """The mean surprise in micronats, less what a text of this length is allowed to stray."""
    return F.col(micronats) / F.col(n) - F.lit(SLACK * 1e6) / F.sqrt(F.col(n))


def thresholds(scored: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """lang and limit (micronats): the quantile over the unseen trusted documents, by counts of bins of a thousandth of a nat.

    One row has lang_known false: the quantile of all trusted documents, towards which those of the languages are drawn.
    """
    known = scored.where("n_symbols > 0").join(trusted_ids(labels, False), "doc_id", "left_semi")
    bins = known.groupBy("lang", F.ceil(_lowered() / _BIN).alias("bin")).agg(F.count("*").alias("n"))
    every = bins.groupBy("bin").agg(F.sum("n").alias("n"))
    every = every.select(F.lit(None).cast("string").alias("lang"), "bin", "n", F.lit(False).alias("lang_known"))
    bins = bins.withColumn("lang_known", F.lit(True)).unionByName(every)
    up = Window.partitionBy("lang_known", "lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy("lang_known", "lang")
    ranked = bins.withColumns({"below": F.sum("n").over(up), "all": F.sum("n").over(all_)})
    reached = ranked.where(F.col("below") >= F.col("all") * quantile).groupBy("lang_known", "lang")
    found = reached.agg((F.min("bin") * _BIN).alias("own"), F.max("all").alias("all"))
    # One row for each language.
    pooled = F.max(F.when(~F.col("lang_known"), F.col("own"))).over(Window.partitionBy(F.lit(0)))
    drawn = F.round((F.col("all") * F.col("own") + PRIOR * F.col("_pooled")) / (F.col("all") + PRIOR)).cast("long")
    limit = F.when(F.col("lang_known"), drawn).otherwise(F.col("own")) + int(MARGIN * 1e6)
    return found.withColumn("_pooled", pooled).select("lang_known", "lang", limit.alias("limit"))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold (both as perplexities at the document's length) and kept."""
    return _judged(docs, labels, quantile).drop("row")


def _judged(docs: DataFrame, labels: DataFrame, quantile: float) -> DataFrame:
    scored = scores(docs, labels)
    limits = cut(thresholds(scored, labels, quantile))
    own = limits.where("lang_known").select(F.col("lang").alias("_lang"), F.col("limit").alias("_own"))
    other = limits.where("NOT lang_known").agg(F.max("limit")).first()[0]
    joined = scored.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    joined = joined.withColumn("limit", F.coalesce("_own", F.lit(other).cast("bigint")))
    allowed = F.col("limit") + F.lit(SLACK * 1e6) / F.sqrt(F.col("n_symbols"))
    mean = F.when(F.col("n_symbols") > 0, F.col("micronats") / F.col("n_symbols"))
    return joined.select(
        "row",
        "doc_id",
        "lang",
        "n_symbols",
        F.exp(mean / 1e6).alias("perplexity"),
        F.when(F.col("n_symbols") > 0, F.exp(allowed / 1e6)).alias("threshold"),
        F.coalesce(mean <= allowed, F.lit(True)).alias("kept"),
    )


def keep(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The documents that the model doesn't reject, with all their columns."""
    # A row's language decides its limit, so equal texts under one doc_id may fare differently.
    gone = _judged(docs, labels, quantile).where("NOT kept").select(F.col("row").alias("_gone"), F.col("lang").alias("_of")).distinct()
    same = (row_key() == F.col("_gone")) & F.col("lang").cast("string").eqNullSafe(F.col("_of"))
    return docs.join(gone.hint("merge"), same, "left_anti")
