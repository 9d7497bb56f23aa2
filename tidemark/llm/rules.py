"""Quality rules as a short-circuit cascade.

Every rule says which documents it rejects; a document is kept if no rule rejects it. On a sample of about ``SAMPLE``
documents each rule's cost (CPU seconds a document, on the executors) and its share of rejections are measured; the rules
then run by falling rejections per cost, and each sees only what the rules before it have left. The verdict doesn't depend
on the order, so neither the sample nor the clock can change it; only the time depends on them.

Words are runs of bytes other than ASCII white space. A null, empty or white text has no words and fails the base rule.
Long texts are measured whole. Rows that share a doc_id, or have none, are judged one by one. An empty table gives no rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import WHITE, Words, buffers, pieces, shingle_hashes, word_hashes, words_of

# Documents on which costs and rejections are estimated.
SAMPLE = 2000

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOL_PERCENT = 10
DUPLICATE_LINE_PERCENT = 30
SHORT_WORD, LONG_WORD = 2, 20
UPPER_PERCENT = 50

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[list(range(0x41, 0x5B))] = True
_LETTER = _UPPER.copy()
_LETTER[list(range(0x61, 0x7B))] = True


class Texts:
    """The texts of a piece with the measures taken of them so far."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        self._known: dict[str, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.texts)

    def get(self, name: str) -> np.ndarray:
        if name not in self._known:
            self._known[name] = MEASURES[name](self)
        return self._known[name]

    def take(self, rows: np.ndarray) -> Texts:
        """Some of the texts, with what is known of them."""
        out = Texts(self.texts.take(pa.array(rows)))
        out._known = {k: v[rows] for k, v in self._known.items() if isinstance(v, np.ndarray)}
        return out

    @property
    def words(self) -> Words:
        if "_words" not in self._known:
            self._known["_words"] = words_of(self.texts)
        return self._known["_words"]


def _per_row(texts: Texts, marks: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return np.diff(total[buffers(texts.texts)[1]])


def _n_words(texts: Texts) -> np.ndarray:
    return np.diff(texts.words.first)


def _word_chars(texts: Texts) -> np.ndarray:
    raw = texts.words.raw
    return _per_row(texts, ~WHITE[raw] & ((raw & 0xC0) != 0x80))


def _n_symbols(texts: Texts) -> np.ndarray:
    return _per_row(texts, SYMBOLS[texts.words.raw])


def _n_upper(texts: Texts) -> np.ndarray:
    return _per_row(texts, _UPPER[texts.words.raw])


def _n_letters(texts: Texts) -> np.ndarray:
    return _per_row(texts, _LETTER[texts.words.raw])


def _lines(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    if "_lines" not in texts._known:
        full, again = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts.texts):
            lines = [x for x in (text.as_py() or "").encode("utf-8", "surrogatepass").split(b"\n") if x.strip()]
            full[row], again[row] = len(lines), len(lines) - len(set(lines))
        texts._known["_lines"] = (full, again)
    return texts._known["_lines"]


def _n_repeat_words(texts: Texts) -> np.ndarray:
    """Words inside a run of ``WINDOW`` words that the same text has twice or more."""
    words = texts.words
    out = np.zeros(len(texts), dtype=np.int64)
    counts = np.diff(words.first)
    if not len(words.starts) or counts.max() <= WINDOW:
        return out
    runs, row = shingle_hashes(word_hashes(words), words.first, WINDOW)
    # Equal runs of different rows differ by their rows; the last runs of a row are those that start on its last words.
    order = np.lexsort((runs, row))
    same = (runs[order][1:] == runs[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(runs), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    heads = np.cumsum(np.where(counts == 0, 0, np.maximum(counts - WINDOW + 1, 1)))
    heads = np.concatenate(([0], heads[:-1]))
    start = (np.arange(len(runs)) - heads[row] + words.first[:-1][row])[twice]
    edge = np.zeros(len(words.starts) + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.diff(np.concatenate(([0], np.cumsum(covered)))[words.first])


MEASURES: dict[str, Callable[[Texts], np.ndarray]] = {
    "n_words": _n_words,
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_dup_lines": lambda texts: _lines(texts)[1],
    "n_lines": lambda texts: _lines(texts)[0],
    "n_repeat_words": _n_repeat_words,
    "n_upper": _n_upper,
    "n_letters": _n_letters,
}


@dataclass(frozen=True)
class Rule:
    """Rejects the texts for which ``rejects`` is true."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


BASE = (
    Rule("few_words", lambda t: t.get("n_words") < MIN_WORDS),
    Rule("repeated_words", lambda t: 100 * t.get("n_repeat_words") > REPEAT_PERCENT * t.get("n_words")),
)
RULES = (
    *BASE,
    Rule("symbols", lambda t: 100 * t.get("n_symbols") > SYMBOL_PERCENT * t.get("n_words")),
    Rule("short_words", lambda t: t.get("word_chars") < SHORT_WORD * t.get("n_words")),
    Rule("long_words", lambda t: t.get("word_chars") > LONG_WORD * t.get("n_words")),
    Rule("duplicate_lines", lambda t: 100 * t.get("n_dup_lines") > DUPLICATE_LINE_PERCENT * t.get("n_lines")),
    Rule("upper_case", lambda t: 100 * t.get("n_upper") > UPPER_PERCENT * t.get("n_letters")),
)


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE, known: tuple[str, ...] = ()) -> dict:
    """(CPU seconds a document, share rejected) of each rule on a sample; what is ``known`` anyway costs nothing."""
    every = max(1, docs.count() // sample)
    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, gone, rows = np.zeros(len(rules)), np.zeros(len(rules), np.int64), 0
        for batch in pieces(batches):
            rows += batch.num_rows
            for i, rule in enumerate(rules):
                texts = Texts(batch.column("text"))
                for name in known:
                    texts.get(name)
                began = time.thread_time()
                gone[i] += int(rule.rejects(texts).sum())
                spent[i] += time.thread_time() - began
        names = pa.array(range(len(rules)), pa.int32())
        columns = [names, pa.array(spent), pa.array(gone), pa.array(np.full(len(rules), rows))]
        yield pa.RecordBatch.from_arrays(columns, names=["rule", "s", "gone", "rows"])

    found = some.mapInArrow(measure, "rule int, s double, gone long, rows long").groupBy("rule")
    found = found.agg(F.sum("s").alias("s"), F.sum("gone").alias("gone"), F.sum("rows").alias("rows")).collect()
    return {rules[r.rule].name: (r.s / r.rows, r.gone / r.rows) for r in found if r.rows}


def cascade_order(rules: tuple[Rule, ...], costs: dict) -> tuple[Rule, ...]:
    """By falling rejections per cost; rules without an estimate, and ties, stay in the given order."""

    def gain(rule: Rule) -> float:
        seconds, share = costs.get(rule.name, (1.0, 0.0))
        return share / max(seconds, 1e-9)

    return tuple(sorted(rules, key=gain, reverse=True))


def cascade(texts: Texts, rules: tuple[Rule, ...]) -> np.ndarray:
    """True for the texts that no rule rejects; a rule sees only what those before it have left."""
    left, rest = np.arange(len(texts)), texts
    for rule in rules:
        bad = rule.rejects(rest)
        if bad.any():
            left = left[~bad]
            rest = rest.take(np.flatnonzero(~bad))
        if not len(left):
            break
    out = np.zeros(len(texts), dtype=bool)
    out[left] = True
    return out


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    measures: tuple[str, ...] = (),
    base: tuple[Rule, ...] = BASE,
    sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, the ``measures`` (long), base_failed and kept."""
    order = cascade_order(rules, estimate(docs, rules, sample, measures))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = Texts(batch.column("text"))
            columns = [pa.array(texts.get(m).astype(np.int64)) for m in measures]
            failed = np.zeros(len(texts), dtype=bool)
            for rule in base:
                failed |= rule.rejects(texts)
            kept = np.zeros(len(texts), dtype=bool)
            rows = np.flatnonzero(~failed)
            if len(rows):
                kept[rows] = cascade(texts.take(rows), tuple(r for r in order if r not in base))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(failed), pa.array(kept)], names=["doc_id", *measures, "base_failed", "kept"]
            )

    schema = ", ".join(["doc_id long", *[f"{m} long" for m in measures], "base_failed boolean", "kept boolean"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """The documents that no rule rejects, with all their columns, judged in the cascade's order."""
    order = cascade_order(rules, estimate(docs, rules, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield batch.filter(pa.array(cascade(Texts(batch.column("text")), order)))

    return docs.mapInArrow(run, docs.schema)
