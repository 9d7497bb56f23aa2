"""The helpers: words, stretches, running totals, components, token pieces, suffix arrays, Elias-Fano, packing plans."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import eliasfano, frames, mixing, packing, tokenfile
from tidemark.llm.suffixes import suffix_array
from tidemark.llm.text import pieces, shingle_hashes, word_hashes, words_of
from tidemark.llm.tokens import Encoder, Vocabulary, with_end

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\r\x1cabAB'é.1 ", max_size=30)), max_size=6)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_a_split(texts):
    words = words_of(pa.array(texts, pa.string()))
    found = [bytes(words.raw[a:b]) for a, b in zip(words.starts, words.ends)]
    expected = [(t or "").encode().split() for t in texts]
    assert found == [w for ws in expected for w in ws]
    assert np.diff(words.first).tolist() == [len(ws) for ws in expected]
    hashes = dict(zip(found, word_hashes(words).tolist()))
    assert len(set(hashes.values())) == len(hashes)


def test_shingles_know_their_row_and_order():
    words = words_of(pa.array(["a b c d", "a b c", "b a c", "a b", "", "a b c d"]))
    hashes, row = shingle_hashes(word_hashes(words), words.first, 3)
    assert row.tolist() == [0, 0, 1, 2, 3, 5, 5]
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[6] and len(set(hashes.tolist())) == 4


def test_pieces_keep_rows_and_bound_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 5, 50, 0, 1)])], names=["text"])
    parts = list(pieces(iter([batch]), "text", 10))
    assert [p.num_rows for p in parts] == [2, 1, 2]


def test_running_total_is_exact_for_a_hot_key(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, F.lit(None)).otherwise(F.col("id") % 3).alias("k"), "id")
    got = frames.running_total(df, ["k"], ["id"], F.lit(1), "rank").collect()
    for key in {r.k for r in got}:
        ranks = sorted(r["rank"] for r in got if r.k == key)
        assert ranks == list(range(len(ranks)))


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1100)]
    edges += [(i, i + 1) for i in range(2000, 2040)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in frames.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in {n for e in edges if e[0] != e[1] for n in e}}


def test_stretches_follow_the_order(spark):
    df = spark.createDataFrame([(i * i % 1009,) for i in range(500)] + [(None,)] * 3, "doc_id long")
    bounds = frames.stretch_bounds(df, rows=50)
    rows = frames.with_stretch(df, bounds).collect()
    key = lambda r: -1 if r.doc_id is None else r.doc_id
    assert [r.stretch for r in sorted(rows, key=key)] == sorted(r.stretch for r in rows)
    assert len(set(r.stretch for r in rows)) > 5


@pytest.mark.parametrize(("file", "cut"), [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "bytes")])
def test_pieces_have_the_ids_of_the_whole_text(file, cut):
    path = public_tokenizers.path(file)
    vocabulary, plain = Vocabulary.read(path, cut), Tokenizer.from_file(path)
    encoder = Encoder(vocabulary.content, vocabulary.cut)
    rng = random.Random(1)
    alphabet = list("  \n\t'sdlabcXYZ019.,;é́ßİǅ  日€") + ["'ll", "<|endoftext|>", "  ", "\r\n", "don't", "\x00"]
    texts = [None, "", " "] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(1500)]
    ids, ends = encoder.encode(pa.array(texts, pa.string()))
    for i, expected in enumerate(plain.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[ends[i] : ends[i + 1]].tolist() == expected.ids, texts[i]
    longer, bounds = with_end(ids, ends, 1)
    assert all(longer[bounds[1:] - 1] == 1) and len(longer) == len(ids) + len(texts)


@given(st.lists(st.integers(1, 4), max_size=60), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_suffixes_are_sorted(symbols, times):
    text = symbols * times + [0]
    assert suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@given(st.lists(st.integers(0, 2**40), max_size=700))
@settings(max_examples=100, deadline=None)
def test_elias_fano_round_trip(values):
    values = np.array(sorted(values), dtype=np.int64)
    data = eliasfano.encode(values)
    found = eliasfano.Sequence(b"xyz" + data + b"tail", 3)
    assert found.end == 3 + len(data) and found.all().tolist() == values.tolist()
    assert [found.select(i) for i in range(len(values))] == values.tolist()
    with pytest.raises(IndexError):
        found.select(len(values))


def test_elias_fano_is_smaller_than_a_table():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 10_000))
    assert len(eliasfano.encode(ends)) < 10_000 * 13 / 8 + 1000


def test_blocks_give_single_documents():
    ids, ends = np.array([5, 1, 1, 70_000, 2, 1], np.uint32), np.array([2, 3, 6])
    block = tokenfile.Block(tokenfile.write_block([None, -4, 9], ids, ends))
    assert block.doc_ids() == [None, -4, 9]
    assert [block.document(i).tolist() for i in range(3)] == [[5, 1], [1], [70_000, 2, 1]]
    with pytest.raises(ValueError):
        tokenfile.Block(b"x" * 80)


@given(st.lists(st.integers(1, 9000), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_plans_use_every_piece_once(lengths):
    histogram = {}
    for n in lengths:
        assert sum(packing.cuts(n)) == n
        for x in packing.cuts(n):
            histogram[x] = histogram.get(x, 0) + 1
    small = sorted(x for x in histogram if x < packing.CAPACITY)
    used = np.zeros(len(small), dtype=int)
    for uses, pattern in packing.plan(histogram):
        assert pattern @ np.array(small) <= packing.CAPACITY
        used += uses * pattern
    assert used.tolist() == [histogram[x] for x in small]


def test_knapsack_equals_brute_force():
    rng = np.random.default_rng(2)
    lengths = np.array([300, 450, 700, 1100])
    for _ in range(20):
        prices = rng.random(4)
        value, pattern = packing.best_pattern(lengths, prices)
        best = 0.0
        for a in range(7):
            for b in range(5):
                for c in range(3):
                    for d in range(2):
                        if lengths @ [a, b, c, d] <= packing.CAPACITY:
                            best = max(best, prices @ [a, b, c, d])
        assert lengths @ pattern <= packing.CAPACITY and abs(value - best) < 1e-9


@given(st.lists(st.integers(0, 500), min_size=1, max_size=8))
@settings(max_examples=100, deadline=None)
def test_targets_share_everything_below_the_limit(sizes):
    totals = [(f"s{i}" if i else None, n) for i, n in enumerate(sizes)]
    goal = mixing.targets(totals)
    assert abs(sum(goal.values()) - sum(sizes)) < 1e-6
    assert all(goal[s] <= 3 * n + 1e-6 for s, n in totals)


def test_targets_by_weight():
    assert mixing.targets([("b", 100), (None, 100), ("a", 100), ("c", 100)]) == pytest.approx(
        {"a": 400 * 5 / 13, "b": 400 * 2 / 13, "c": 400 / 13, None: 400 * 5 / 13}
    )
    assert mixing.targets([("a", 10), ("b", 1000)])["a"] == 30


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations_are_bijections(n):
    index = np.arange(n)
    for key in range(4):
        out = mixing.permuted(index, np.full(n, n), np.full(n, key * 7919, np.uint64))
        assert sorted(out.tolist()) == list(range(n))


@given(st.lists(st.integers(0, 3), max_size=1200), st.randoms())
@settings(max_examples=60, deadline=None)
def test_selects_of_many_places(steps, rng):
    values = np.cumsum([s * rng.choice([1, 1, 1, 500]) for s in steps]).astype(np.int64)
    found = eliasfano.Sequence(eliasfano.encode(values))
    wanted = sorted(rng.sample(range(len(values)), len(values) // 2)) if len(values) else []
    assert found.many(np.array(wanted)).tolist() == values[wanted].tolist()
    assert found.many(np.arange(len(values))).tolist() == found.all().tolist() == values.tolist()
    with pytest.raises(IndexError):
        found.many(np.array([len(values)]))
