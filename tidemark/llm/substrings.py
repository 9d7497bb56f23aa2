"""Removal of long byte strings that occur more than once, by suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts somewhere else, in the same document or another one;
strings don't cross documents and are judged on the input.

1. Candidates. Every string of ``LENGTH`` bytes has an anchor: the run of ``GRAM`` bytes in it with the smallest hash, the
   first one of equals. Equal strings have equal anchors at the same place, so only strings with the same anchor can be equal,
   and no pair is missed. Consecutive strings that share an anchor form its context. Contexts meet by the anchor's hash. An
   anchor that occurs once is done. Equal contexts are covered whole, and one stands for all of them. Equal contexts of a task
   are combined before the shuffle, so that a passage that a third of the corpus has sends a row or two from each task.
2. Suffix arrays. Different contexts of an anchor are brought together with their bytes, and many anchors make a shard. A
   context is a sequence of blocks of ``BLOCK`` bytes, counted from the anchor. Runs of blocks of which each occurs twice or
   more are suffix-sorted by linear grouping; neighbours that agree in the blocks that every string of ``LENGTH`` bytes has
   inside form an interval. Within an interval the bytes before and behind these blocks decide, for every position of a string.
   An anchor with more than ``CONTEXTS`` different contexts isn't brought together; its strings are counted one by one.
3. The intervals of a document are merged and cut out.

Text is shuffled once; both steps that need it read the same shuffle. A null or empty text has nothing to remove. Repeated
rows are occurrences of their own, so a repeated text of ``LENGTH`` bytes or more goes whole. Rows that share a doc_id or have
none are documents of their own. An empty table gives no rows. Long texts are anchored in overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.suffixes import suffix_array
from tidemark.llm.text import mix, release
from tidemark.session import fresh_dir

LENGTH = 200
GRAM = 64
BLOCK = 32
# Blocks that lie inside any string of LENGTH bytes, wherever it starts.
INSIDE = (LENGTH - BLOCK + 1) // BLOCK
CONTEXTS = 50_000
_PIECE = 1 << 18
_COMBINED = 1_000_000
_SYMBOLS = 60_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))


def _slide(x: np.ndarray, width: int, smallest: bool) -> np.ndarray:
    """The smallest or largest of every ``width`` neighbours."""
    n, op = len(x), np.minimum if smallest else np.maximum
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1) if smallest else np.uint64(0), dtype=np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = op.accumulate(rows, axis=1).ravel()
    back = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - width + 1], ahead[width - 1 : n])


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of every anchor, and the first and last start of the strings that it anchors."""
    width = LENGTH - GRAM + 1
    words, n = _words(raw), len(raw) - GRAM + 1
    hashes = np.zeros(n, dtype=np.uint64)
    for k in range(0, GRAM, 8):
        hashes = hashes * _ODD + words[k : k + n]
        hashes ^= hashes >> np.uint64(29)
    hashes = mix(hashes)
    low = _slide(hashes, width, True)
    wide = np.zeros(n + width - 1, dtype=np.uint64)
    wide[width - 1 : n] = low
    chosen = np.flatnonzero(_slide(wide, width, False) == hashes)
    at = np.searchsorted(chosen, np.arange(len(low)))
    while True:
        other = np.flatnonzero(hashes[chosen[at]] != low)
        if not len(other):
            break
        at[other] += 1
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(first[1:], len(at)) - 1
    place = chosen[at[first]]
    return hashes[place], place, first, last


def _contexts(docs: DataFrame) -> DataFrame:
    """h, context, key, th, place (anchor, how far before and behind it strings start, flags) of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            h, context, key, th, place = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((context, h))
            h, context, key, th, place = (x[order] for x in (h, context, key, th, place))
            same = np.zeros(len(h), dtype=bool)
            same[1:] = (h[1:] == h[:-1]) & (context[1:] == context[:-1])
            twice = np.append(same[1:], False) & ~same
            # All but the first of equal contexts are decided here and go anywhere.
            h = np.where(same, mix(place.view(np.uint64) + context), h)
            place = place | same.astype(np.int64) | (twice.astype(np.int64) << 1)
            arrays = [pa.array(x.view(np.int64)) for x in (h, context)] + [pa.array(x) for x in (key, th, place)]
            return pa.RecordBatch.from_arrays(arrays, names=["h", "context", "key", "th", "place"])

        for batch in batches:
            for key, th, text in zip(*(batch.column(c) for c in ("key", "th", "text"))):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for start in range(0, max(len(data) - LENGTH + 1, 0), _PIECE):
                    part = data[start : start + _PIECE + LENGTH - 1]
                    h, at, first, last = anchors(np.frombuffer(part, dtype=np.uint8))
                    context = [
                        xxhash.xxh64_intdigest(part[a : b + LENGTH], p - a) for p, a, b in zip(at.tolist(), first.tolist(), last.tolist())
                    ]
                    place = ((at + start) << 18) | ((at - first) << 10) | ((at - last) << 2)
                    n = len(h)
                    held.append([h, np.array(context, np.uint64), np.full(n, key.as_py()), np.full(n, th.as_py(), np.int32), place])
                    count += n
            if count > _COMBINED:
                yield flush()
                held, count = [], 0
        if held:
            yield flush()
            held.clear()
        release()

    return docs.mapInArrow(run, "h long, context long, key long, th int, place long")


def _classified(contexts: DataFrame) -> DataFrame:
    """Of the anchors that occur again: key, th, h, place, whole (covered whole) and open (to be compared with others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head = None, None  # the last row, which waits for the next one, and the first context of its anchor
        names = ["h", "context", "key", "th", "place"]

        def decide(columns: list[np.ndarray], ended: bool) -> pa.RecordBatch:
            nonlocal head
            h, context, key, th, place = columns
            n = len(h) if ended else len(h) - 1
            settled = (place & 1) > 0
            same_h = np.zeros(len(h) + 1, dtype=bool)
            same_h[1:-1] = (h[1:] == h[:-1]) & ~settled[1:] & ~settled[:-1]
            same = np.zeros(len(h) + 1, dtype=bool)
            same[1:-1] = same_h[1:-1] & (context[1:] == context[:-1])
            # same_h[i] and same[i] compare row i with the row before; what row 0 has before it was decided a batch ago.
            if head is not None and len(h):
                same_h[0], same[0] = head[1], head[2]
            begins = np.flatnonzero(~same_h[:-1])
            run_of = np.cumsum(~same_h[:-1]) - 1
            firsts = np.where(run_of >= 0, context[begins[np.maximum(run_of, 0)]] if len(begins) else 0, head[0] if head is not None else 0)
            whole = settled | ((place & 2) > 0) | same[:-1] | same[1:]
            opens = (same_h[:-1] & ~same[:-1]) | (same_h[1:] & ~same[1:] & (context == firsts))
            if not ended:
                head = (firsts[-1], same_h[len(h) - 1], same[len(h) - 1])
            kept = np.flatnonzero((whole | opens)[:n])
            arrays = [pa.array(x[kept]) for x in (key, th, h, place >> 2, whole, opens)]
            return pa.RecordBatch.from_arrays(arrays, names=["key", "th", "h", "place", "whole", "open"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in names]
            if last is not None:
                columns = [np.concatenate((a, b)) for a, b in zip(last, columns)]
            yield decide(columns, False)
            last = [c[-1:] for c in columns]
        if last is not None:
            yield decide(last, True)

    ordered = contexts.repartition("h").sortWithinPartitions("h", "context")
    return ordered.mapInArrow(run, "key long, th int, h long, place long, whole boolean, open boolean")


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of a packed place without flags."""
    at = place >> 16
    return at, at - ((place >> 8) & 255), at - (place & 255)


def _covered(h: np.ndarray, offset: np.ndarray, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of every string of ``LENGTH`` bytes that two contexts of the same anchor have, by a suffix array.

    ``offset`` is the anchor's place in the context; equal anchors are next to each other.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(bytes(BLOCK) + b"".join(data) + bytes(BLOCK + LENGTH), dtype=np.uint8)
    words = _words(raw)
    head = np.cumsum(size) - size + BLOCK  # where the context's bytes begin
    before, behind = offset // BLOCK, (size - offset) // BLOCK
    blocks = before + behind
    row = np.repeat(np.arange(len(data)), blocks)
    turn = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks) - before[row]
    at = head[row] + offset[row] + turn * BLOCK
    symbol = mix(h[row].view(np.uint64) + turn.astype(np.uint64))
    for k in range(0, BLOCK, 8):
        symbol = mix(symbol * _ODD + words[at + k])
    _, symbol, times = np.unique(symbol, return_inverse=True, return_counts=True)
    # Runs of blocks that occur again, long enough to lie inside a string.
    again = times[symbol] > 1
    starts = again & ~(np.append(False, again[:-1]) & np.append(False, row[1:] == row[:-1]))
    run = np.cumsum(starts) - 1
    lengths = np.bincount(run[again], minlength=max(int(starts.sum()), 1))
    kept = np.flatnonzero(again)
    kept = kept[lengths[run[kept]] >= INSIDE]
    if not len(kept):
        return none
    edge = np.flatnonzero(np.append(True, run[kept][1:] != run[kept][:-1]))
    length = np.diff(np.append(edge, len(kept)))
    # A separator behind every run, and the smallest symbol at the end.
    place = np.arange(len(kept)) + np.repeat(np.arange(len(edge)), length)
    text = np.ones(len(kept) + len(edge) + 1, dtype=np.int64)
    text[place] = symbol[kept] + 2
    text[-1] = 0
    source = np.full(len(text), -1, dtype=np.int64)  # the block that a place of the text is, if enough blocks follow
    left = np.repeat(edge + length, length) - np.arange(len(kept))
    source[place[left >= INSIDE]] = kept[left >= INSIDE]
    sa = suffix_array(text)
    sa = sa[source[sa] >= 0]
    ahead = text[sa[:, None] + np.arange(INSIDE)]
    alike = (ahead[1:] == ahead[:-1]).all(axis=1)
    group = np.cumsum(np.append(True, ~alike)) - 1
    full = np.bincount(group)[group] > 1
    group, block = group[full].astype(np.uint64), source[sa[full]]
    base, owner = at[block], row[block]
    lefts = [words[base - k] for k in range(8, BLOCK + 1, 8)]
    rights = [words[base + INSIDE * BLOCK + k] for k in range(0, LENGTH - INSIDE * BLOCK, 8)]
    found = []
    for q in range(BLOCK):
        start = base - q - head[owner]
        fits = np.flatnonzero((start >= 0) & (start + LENGTH <= size[owner]))
        value = mix(group[fits])
        for words_, total, upper in ((lefts, q, True), (rights, LENGTH - INSIDE * BLOCK - q, False)):
            for k, word in enumerate(words_):
                some = min(max(total - 8 * k, 0), 8)
                if some:
                    part = word[fits]
                    if some < 8:
                        part = part >> np.uint64(8 * (8 - some)) if upper else part & np.uint64((1 << 8 * some) - 1)
                    value = mix(value * _ODD + part)
        order = np.argsort(value, kind="stable")
        equal = value[order][1:] == value[order][:-1]
        hit = np.zeros(len(fits), dtype=bool)
        hit[order[1:][equal]] = True
        hit[order[:-1][equal]] = True
        found.append((owner[fits[hit]], start[fits[hit]]))
    return np.concatenate([r for r, _ in found]), np.concatenate([s for _, s in found])


def _runs(owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first byte and end of the stretches that strings at these starts cover."""
    if not len(owner):
        return owner, start, start
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    begins = np.ones(len(owner), dtype=bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + LENGTH)
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], start[last] + LENGTH


def _compared(contexts: DataFrame) -> DataFrame:
    """key, th, first and end of what strings that other contexts have cover, from suffix arrays over shards of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def sort(table: pa.Table) -> pa.RecordBatch:
            h, key, th, first = (table.column(c).to_numpy() for c in ("h", "key", "th", "first"))
            owner, start = _covered(h, table.column("offset").to_numpy(), table.column("data").to_pylist())
            asked = ~table.column("whole").to_numpy()[owner]
            owner, begin, end = _runs(owner[asked], start[asked])
            arrays = [pa.array(x) for x in (key[owner], th[owner], first[owner] + begin, first[owner] + end)]
            return pa.RecordBatch.from_arrays(arrays, names=["key", "th", "first", "end"])

        def shards(table: pa.Table) -> Iterator[pa.RecordBatch]:
            h = table.column("h").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h))
            blocks = np.append(0, np.cumsum(pa.compute.binary_length(table.column("data")).to_numpy() // BLOCK + 1))
            at = 0
            while at < len(edges) - 1:
                stop = max(at + 1, int(np.searchsorted(blocks[edges], blocks[edges[at]] + _SYMBOLS, side="right")) - 1)
                yield sort(table.slice(edges[at], edges[stop] - edges[at]))
                at = stop

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            h = table.column("h").to_numpy()
            cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0
            yield from shards(table.slice(0, cut)) if cut else ()
            rest = table.slice(cut)
        if rest is not None:
            yield from shards(rest)
        release()

    ordered = contexts.repartition("h").sortWithinPartitions("h", "key", "th", "first")
    return ordered.mapInArrow(run, "key long, th int, first long, end long")


def _counted(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many contexts: every string is counted, copies combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("h", "key", "th", "first", "offset", "whole", "data")
            for h, key, th, first, offset, whole, data in zip(*(batch.column(c).to_pylist() for c in names)):
                n = len(data) - LENGTH + 1
                digests = [xxhash.xxh3_128_digest(data[s : s + LENGTH], s - offset + LENGTH) for s in range(n)]
                halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                owner = [np.full(n, key), np.full(n, th, np.int32), first + np.arange(n), np.full(n, whole)]
                columns = [pa.array(c) for c in (halves[:, 0] ^ h, halves[:, 1], *owner)]
                yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "key", "th", "first", "whole"])

    strings = contexts.mapInArrow(run, "x long, y long, key long, th int, first long, whole boolean")
    again = strings.groupBy("x", "y").agg(F.count("*").alias("n")).where("n > 1").select("x", "y")
    found = strings.where("NOT whole").join(again, ["x", "y"])
    return found.select("key", "th", "first", (F.col("first") + LENGTH).alias("end"))


def _keyed(docs: DataFrame, others: list[str]) -> DataFrame:
    """Documents with what tells them apart: key and th, 64 and 32 bits of two hashes; other columns in ``rest``.

    Rows that are equal in both have the same doc_id and the same text, so the same is covered in them.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.xxhash64(F.col("doc_id").cast("long"), text)
    rest = [F.struct(*[F.col(c) for c in others]).alias("rest")] if others else []
    return docs.select(key.alias("key"), F.hash(text).alias("th"), text.alias("text"), *rest)


def spans(docs: DataFrame, contexts: int = CONTEXTS, others: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents (key, th, text, and ``others`` as rest), dealt by key and th; and _key, _th, spans: what is covered, in
    pieces that may overlap."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "anchors")
    _classified(_contexts(_keyed(docs, []).where(F.octet_length("text") >= LENGTH))).write.parquet(path)
    found = spark.read.parquet(path)
    dealt = _keyed(docs, others or []).repartition("key", "th")
    opened = found.where("open")
    crowded = opened.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > contexts)
    crowded = crowded.select("h", F.lit(True).alias("crowd"))
    flagged = opened.join(crowded, "h", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, th, text, list_ in zip(*(batch.column(c) for c in ("key", "th", "text", "found"))):
                data = text.as_py().encode("utf-8", "surrogatepass")
                h, place, whole = list_.values.flatten()
                at, first, last = _unpacked(place.to_numpy())
                n = len(at)
                columns = [
                    h,
                    pa.array(np.full(n, key.as_py())),
                    pa.array(np.full(n, th.as_py(), np.int32)),
                    pa.array(first),
                    pa.array(at - first),
                    whole,
                    pa.array([data[a : b + LENGTH] for a, b in zip(first.tolist(), last.tolist())], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "key", "th", "first", "offset", "whole", "data"])

    def with_bytes(places: DataFrame) -> DataFrame:
        lists = places.groupBy(F.col("key").alias("_key"), F.col("th").alias("_th"))
        lists = lists.agg(F.collect_list(F.struct("h", "place", "whole")).alias("found"))
        # All columns of the dealt documents go on, so that this is the same shuffle as the one of the last step.
        met = dealt.join(lists, (F.col("key") == F.col("_key")) & (F.col("th") == F.col("_th")))
        schema = "h long, key long, th int, first long, offset long, whole boolean, data binary"
        return met.select(*dealt.columns, "found").mapInArrow(cut, schema)

    some = _compared(with_bytes(flagged.where("crowd IS NULL"))).unionByName(_counted(with_bytes(flagged.where("crowd"))))
    at = F.shiftright("place", 16)
    first = at - F.shiftright("place", 8).bitwiseAND(F.lit(255))
    end = at - F.col("place").bitwiseAND(F.lit(255)) + LENGTH
    all_ = found.where("whole").select("key", "th", first.alias("first"), end.alias("end")).unionByName(some)
    covered = all_.groupBy(F.col("key").alias("_key"), F.col("th").alias("_th"))
    return dealt, covered.agg(F.collect_list(F.struct("first", "end")).alias("spans"))


def _merged(list_: pa.StructArray | None) -> list[tuple[int, int]]:
    """The spans of a document, merged where they touch, in order."""
    if list_ is None or not len(list_):
        return []
    first, end = (x.to_numpy() for x in list_.flatten())
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    begins = np.append(True, first[1:] > end[:-1])
    return list(zip(first[begins].tolist(), end[np.append(begins[1:], True)].tolist()))


def _kept(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    """What is left of the bytes."""
    at, parts = 0, []
    for first, end in gone:
        parts.append(data[at:first])
        at = end
    return b"".join([*parts, data[at:]])


def _with_spans(docs: DataFrame, contexts: int, others: list[str] | None = None) -> DataFrame:
    dealt, covered = spans(docs, contexts, others)
    joined = dealt.join(covered, (F.col("key") == F.col("_key")) & (F.col("th") == F.col("_th")), "left")
    return joined.select(*dealt.columns, "spans")


def report(docs: DataFrame, contexts: int = CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, list_ in zip(batch.column("text"), batch.column("spans")):
                data, gone = text.as_py().encode("utf-8", "surrogatepass"), _merged(list_.values)
                rows.append((len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(_kept(data, gone)).hexdigest()))
            if rows:
                columns = [batch.column("rest").field("doc_id").cast(pa.int64()), *[pa.array(list(c)) for c in zip(*rows)]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_spans(docs, contexts, ["doc_id"]).mapInArrow(run, schema)


def remove(docs: DataFrame, contexts: int = CONTEXTS) -> DataFrame:
    """The documents with the covered bytes cut out of their texts, and n_chars counted anew; all other columns as they are.

    A character that loses some of its bytes loses all. A null text becomes an empty one.
    """
    joined = _with_spans(docs, contexts, [c for c in docs.columns if c != "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for text, list_ in zip(batch.column("text"), batch.column("spans")):
                data = text.as_py().encode("utf-8", "surrogatepass")
                left.append(_kept(data, _merged(list_.values)).decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(left, pa.string())], names=["rest", "text"])

    schema = T.StructType([joined.schema["rest"], joined.schema["text"]])
    found = joined.select("rest", "text", "spans").mapInArrow(run, schema)
    columns = {c: F.col("rest")[c] for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])
