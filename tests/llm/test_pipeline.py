"""The pipeline's stages against plain versions of their decisions, on the small tables and a fixture."""

import os
import random
from collections import Counter, defaultdict

import pytest
from llm_fixtures import docs, odd  # noqa: F401
from test_llm_operators import brute_components, brute_fingerprint, brute_substrings, brute_tokens
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from tidemark.llm import kneser, mixing, packing, pipeline, substrings
from tidemark.session import fresh_dir

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def results(spark):
    """The documents before and after each stage."""
    found = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = fresh_dir(spark, f"test-stage-{number}")
        stage(spark, found[-1], SF_DIR).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def test_stages_are_registered_in_order(spark):
    assert [f for _, f in corpus_pipeline.STAGES] == [
        pipeline.quality,
        pipeline.near_duplicates,
        pipeline.repeated_substrings,
        pipeline.mix_sources,
        pipeline.pack,
    ]
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    names = [n for n in registry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_columns_stay(results):
    for df in results[:-1]:
        assert df.columns == list(pipeline.COLUMNS)


def test_quality_keeps_what_the_model_keeps(spark, results):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = {r.doc_id for r in kneser.judge(results[0], labels).where("kept").collect()}
    assert {r.doc_id for r in results[1].collect()} == kept
    marks = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(i in kept for i, q in marks.items() if q == 1) >= 0.97 * sum(q == 1 for q in marks.values())
    assert sum(i in kept for i, q in marks.items() if q == 0) <= 0.5 * sum(q == 0 for q in marks.values())


def test_near_duplicates_keep_one_of_each_group(results):
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in results[1].collect()]
    assert sorted(r.doc_id for r in results[2].collect()) == sorted(set(brute_components(prints).values()))


def test_substrings_leave_what_brute_force_leaves(results):
    before = [(r.doc_id, r.text) for r in results[2].collect()]
    expected = {k: n - gone for k, n, gone, _, _ in brute_substrings(before)}
    for r in results[3].collect():
        assert r.n_chars == len(r.text)
        # A character that loses a byte loses all, so a few bytes more may go.
        assert expected[r.doc_id] - 12 <= len(r.text.encode()) <= expected[r.doc_id]


def test_mix_repeats_documents_by_their_share(results):
    taken = {r.doc_id: r for r in mixing.taken(results[3]).collect()}
    copies = Counter(r.doc_id for r in results[4].collect())
    for i, r in taken.items():
        share = r.taken / r["size"] if r["size"] else 0
        assert copies[i] in (int(share), int(share) + (share % 1 > 0))


def test_packing_packs_every_copy(results):
    rows = [(r.doc_id, r.text) for r in results[4].collect()]
    total = defaultdict(int)
    for k, ids in brute_tokens(rows, "byte_bpe_50k.json"):
        total[k] += len(ids)
    got = results[5].collect()
    found = defaultdict(int)
    for r in got:
        found[r.doc_id] += r.length
    assert found == total
    assert len({r.sequence_id for r in got}) == -(-sum(total.values()) // packing.CAPACITY)


def test_run_gives_the_last_stage(spark, results):
    got = corpus_pipeline.run(spark, SF_DIR).groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, results[5].groupBy("doc_id").agg(F.sum("length")).collect()))


def test_stages_of_odd_tables(spark, odd, docs):
    for df in (odd, docs()):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF_DIR)
            assert out.count() <= 3 * df.count() + 60


def test_a_removed_passage_is_gone_and_clean_text_stays(docs):
    rng = random.Random(2)
    passage = " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(1000)}" for _ in range(60))
    rows = [(i, " ".join(f"{rng.choice('ijklmnop')}{rng.randrange(10**6)}" for _ in range(50)) + "\n" + (passage if i < 5 else "")) for i in range(10)]
    out = {r.doc_id: r.text for r in substrings.remove(docs(*rows)).collect()}
    assert all(passage[5:-5] not in out[i] for i in range(10))
    assert all(out[i] == rows[i][1] for i in range(5, 10))

