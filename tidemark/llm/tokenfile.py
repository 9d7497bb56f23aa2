"""Token ids of all documents in a binary format, and back.

A file holds blocks in ascending doc_id order; a block is a byte string that can be read alone:

    b"TIDM", version (1 byte), bytes an id (1 byte: 2 or 4), leading null doc_ids (4 bytes), smallest doc_id (8 bytes),
    Elias-Fano sequence of the documents' ends in the block's ids, Elias-Fano sequence of the doc_ids less the smallest,
    ids, little-endian

Each document's ids end with ``end``. A block has at most ``BLOCK`` ids, or one document, so positions fit in 32 bits
and no table of 64-bit offsets is needed: a document's place in the whole is its block's first id, a sum over a handful
of numbers a block, plus an end from the block's select structure. Blocks are written as the rows of a Parquet table, by the
stretch of the doc_id order and the block's number in it, because Spark's writers work on every store and write each task's
files whole or not at all.

A null or empty text is the end id alone. Rows that share a doc_id follow each other, by text; null doc_ids come first. An
empty table makes a table without blocks. Long texts are encoded whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.eliasfano import Sequence, encode
from tidemark.llm.frames import in_order, stretch_bounds, with_stretch
from tidemark.llm.text import pieces, release
from tidemark.llm.tokens import BATCH_BYTES, Vocabulary, encoder, with_end

BLOCK = 1 << 18
_HEAD = "<4sBBIq"
_SCHEMA = "stretch int, block int, n_docs long, n_tokens long, data binary"


def write_block(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> bytes:
    """One block: doc_ids in ascending order (nulls first), all their ids, and where each document's ids end."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    head = struct.pack(_HEAD, b"TIDM", 1, width, len(doc_ids) - len(known), least)
    spread = known.astype(np.uint64) - np.uint64(least & (2**64 - 1))
    return head + encode(ends) + encode(spread) + ids.astype(f"<u{width}").tobytes()


class Block:
    """Reads a block."""

    def __init__(self, data: bytes):
        magic, version, width, self.nulls, self.least = struct.unpack_from(_HEAD, data)
        if magic != b"TIDM" or version != 1:
            raise ValueError("not a block of token ids")
        self.ends = Sequence(data, struct.calcsize(_HEAD))
        self.known = Sequence(data, self.ends.end)
        self.ids = np.frombuffer(data, f"<u{width}", -1, self.known.end)

    def __len__(self) -> int:
        return self.ends.n

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.known.all() + self.least).tolist()

    def document(self, i: int) -> np.ndarray:
        """The ids of document i, by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def write_tokens(docs: DataFrame, vocabulary: Vocabulary, end: int, path: str, block: int = BLOCK) -> None:
    """Encodes every document and writes the blocks to ``path``."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = in_order(with_stretch(texts, stretch_bounds(ids)), [F.col("doc_id").asc_nulls_first(), F.col("text")])
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary.content, vocabulary.cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_ = encoder(*sent.value)
        stretch, number, held, size = None, 0, [], 0

        def flush() -> pa.RecordBatch:
            keys = [k for key, _, _ in held for k in key]
            flat = np.concatenate([i for _, i, _ in held])
            lengths = np.concatenate([n for _, _, n in held])
            data = write_block(keys, flat, np.cumsum(lengths))
            row = [[stretch], [number], [len(keys)], [len(flat)], [data]]
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(v, t) for v, t in zip(row, types)]
            return pa.RecordBatch.from_arrays(columns, names=["stretch", "block", "n_docs", "n_tokens", "data"])

        for batch in pieces(batches, "text", BATCH_BYTES):
            flat, ends = with_end(*encode_.encode(batch.column("text")), end)
            stretches, keys = batch.column("stretch").to_numpy(), batch.column("doc_id").to_pylist()
            row = 0
            while row < len(keys):
                if stretches[row] != stretch:
                    if held:
                        yield flush()
                    stretch, number, held, size = int(stretches[row]), 0, [], 0
                last = int(np.searchsorted(stretches, stretch, side="right"))
                fits = int(np.searchsorted(ends, ends[row] + block - size, side="right")) - 1
                if fits <= row and held:
                    yield flush()
                    number, held, size = number + 1, [], 0
                    continue
                stop = min(last, max(fits, row + 1))
                held.append((keys[row:stop], flat[ends[row] : ends[stop]], np.diff(ends[row : stop + 1])))
                size += int(ends[stop] - ends[row])
                row = stop
        if held:
            yield flush()
        encode_.forget()
        release()

    placed.mapInArrow(run, _SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of every document, from the blocks alone."""
    blocks = spark.read.schema(_SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stretch, number, data in zip(*(batch.column(c) for c in ("stretch", "block", "data"))):
                found = Block(data.as_py())
                ends = found.ends.many(np.arange(len(found)))
                starts = np.concatenate(([0], ends[:-1]))
                ids = found.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(found)
                columns = [
                    pa.array(np.full(n, stretch.as_py(), np.int32)),
                    pa.array(np.full(n, number.as_py(), np.int32)),
                    pa.array(found.doc_ids(), pa.int64()),
                    pa.array(starts),
                    pa.array(ends - starts),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["stretch", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = blocks.select("stretch", "block", "data").mapInArrow(
        run, "stretch int, block int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    # First ids: stretches before (a few numbers for each stretch), then blocks before in the same stretch.
    size = blocks.groupBy("stretch").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    size = size.select(F.col("stretch").alias("_s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = blocks.select("stretch", "block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inner"))
    first = first.join(size, F.col("stretch") == F.col("_s")).select(
        F.col("stretch").alias("_stretch"), F.col("block").alias("_block"), (F.col("base") + F.col("inner")).alias("first")
    )
    same = (F.col("stretch") == F.col("_stretch")) & (F.col("block") == F.col("_block"))
    return rows.join(first, same).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
