"""Every operator against a brute-force version on a small fixture, and on odd tables."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from llm_fixtures import clashing, docs, odd  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import extract, frames, kneser, mixing, oph, packing, rules, simhash, substrings, tokenfile, toxicity
from tidemark.llm.tokens import Vocabulary
from tidemark.session import fresh_dir

WORDS = Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"), "words")
BYTES = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"), "bytes")
LABELS = "doc_id long, quality int, toxic int"


def prose(rng, n, words="the of and river stone light under carry morning quiet window garden letter answer hundred".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(n)).strip()


def corpus(seed=1, n=60):
    """Documents with copies, near copies, shared passages and hot sources."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    rows = []
    for i in range(n):
        text = prose(rng, rng.randrange(1, 160))
        if i % 7 == 3:
            text = rows[-1][1]
        elif i % 7 == 5:
            text = rows[-2][1] + " end"
        elif i % 5 == 1:
            text = text + " " + passage + " " + prose(rng, 10)
        rows.append((i, text, rng.choice(["en", "fr"]), "hot" if i % 3 == 0 else f"s{i % 4}"))
    return rows


# ---- 1 mixing ------------------------------------------------------------------------------------------------------
def test_mix_meets_its_targets(docs):
    rows = corpus(n=200)
    df = docs(*rows)
    got = mixing.taken(df, block=8, slots=256).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = {r[0]: len(r[1].split()) for r in rows}
    by = defaultdict(int)
    for r in rows:
        by[r[3]] += sizes[r[0]]
    goal, total = mixing.targets(list(by.items())), defaultdict(int)
    for r in got:
        assert r["size"] == sizes[r.doc_id] and r.source_size == by[r.source] and r.target == pytest.approx(goal[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        total[r.source] += r.taken
    for source, words in goal.items():
        assert abs(total[source] - words) <= 0.03 * words + 40
    again = mixing.taken(df.repartition(2), block=8, slots=256).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_slots_hold_what_is_taken(docs):
    df = docs(*corpus(n=80))
    taken = {r.doc_id: r.taken for r in mixing.taken(df, block=8, slots=128).collect()}
    pieces, held, places = mixing.mixed(df, block=8, slots=128).collect(), defaultdict(int), defaultdict(set)
    for r in pieces:
        held[r.doc_id] += r.length
        places[(r.source, r.slot)].add(r.shard)
    assert {k: v for k, v in taken.items() if v} == dict(held)
    assert all(len(shards) == 1 for shards in places.values())


def test_mix_of_odd_tables(docs, odd, clashing):
    assert mixing.taken(odd).count() == odd.count()
    assert mixing.taken(clashing(odd)).count() == odd.count()
    assert mixing.taken(docs()).count() == 0
    assert [r.taken for r in mixing.taken(docs((1, None), (2, " "))).collect()] == [0, 0]
    assert mixing.resample(clashing(odd)).columns == clashing(odd).columns and mixing.resample(docs()).count() == 0


def test_resampled_words_are_those_of_the_mix(docs):
    rng = random.Random(9)
    long = " ".join(f"w{i}" for i in range(4000))
    rows = [(0, long, "en", "a")] + [(i, prose(rng, 30), "en", "b" if i % 2 else "c") for i in range(1, 300)]
    df = docs(*rows)
    words, texts = Counter(), {r[0]: r[1] for r in rows}
    for r in mixing.resample(df).collect():
        words[r.source] += len(r.text.split())
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text)
    goal = {r.source: r.target for r in mixing.taken(df).collect()}
    want = Counter()
    for r in mixing.taken(df).collect():
        want[r.source] += r.taken
    assert words == want
    for source, target in goal.items():
        assert abs(words[source] - target) <= 0.05 * target


# ---- 2 rules -------------------------------------------------------------------------------------------------------
def brute_rules(text):
    words = (text or "").encode().split()
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    chars, symbols = sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or "")
    upper = sum("A" <= c <= "Z" for c in text or "")
    letters = upper + sum("a" <= c <= "z" for c in text or "")
    n, dup = len(words), len(lines) - len(set(lines))
    failed = n < 10 or 100 * len(repeated) > 20 * n
    bad = 100 * symbols > 10 * n or chars < 2 * n or chars > 20 * n or 100 * dup > 30 * len(lines) or 100 * upper > 50 * letters
    return n, chars, symbols, dup, len(repeated), failed, not (failed or bad)


def test_rules_equal_brute_force(docs, odd, clashing):
    rows = [*corpus(), (100, "A B " * 30), (101, "x#y* " * 40), (102, "same line here\n" * 20), (103, " ".join(map(str, range(60))) + " É&é|")]
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for df in (docs(*rows), clashing(odd)):
        texts = sorted((repr(r.doc_id), brute_rules(r.text)) for r in df.collect())
        got = rules.judge(df, measures=measures).collect()
        assert sorted((repr(r[0]), tuple(r)[1:]) for r in got) == texts
        assert rules.keep(df).count() == sum(t[1][-1] for t in texts)
    assert rules.judge(docs()).count() == 0


def test_cascade_is_ordered_and_skips(docs):
    import pyarrow as pa

    seen = []

    def rule(name, bad):
        return rules.Rule(name, lambda t: seen.append((name, len(t))) or np.array([x in bad for x in t.texts.to_pylist()]))

    all_ = (rule("rare", "a"), rule("often", "abc"), rule("never", ""))
    order = rules.cascade_order(all_, {"rare": (1.0, 0.1), "often": (0.5, 0.9), "never": (0.01, 0.0)})
    assert [r.name for r in order] == ["often", "rare", "never"]
    assert rules.cascade(rules.Texts(pa.array(["a", "b", "c", "d"])), order).tolist() == [False, False, False, True]
    assert seen == [("often", 4), ("rare", 1), ("never", 1)]
    costs = rules.estimate(docs(*corpus()), sample=10)
    assert set(costs) == {r.name for r in rules.RULES} and all(0 <= share <= 1 for _, share in costs.values())


# ---- 3 simhash -----------------------------------------------------------------------------------------------------
def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    """prints: (id, value); the smallest id reachable of each."""
    ids = sorted({i for i, _ in prints})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in prints:
        for b, y in prints:
            if bin(x ^ y).count("1") <= radius:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(docs, clashing):
    rows = [*corpus(n=90), (900, None), (901, ""), (902, "one two"), (903, "ONE two"), (904, "tWo words more and more")]
    got = simhash.near_duplicates(clashing(docs(*rows))).collect()
    prints = {r[0]: brute_fingerprint(r[1]) for r in rows}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{x:016x}" for i, x in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == brute_components(list(prints.items()))


@pytest.mark.parametrize("bucket", [1 << 15, 3])
def test_links_lose_no_pair(spark, bucket):
    """A dense cluster, chains and lone values; with a small bucket the crowded way runs."""
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(40)}
    centre = rng.getrandbits(64)
    values |= {centre ^ (1 << a) ^ (1 << b) for a in range(0, 20) for b in range(20, 24)}
    for _ in range(5):
        x = rng.getrandbits(64)
        for _ in range(12):
            values.add(x)
            for bit in rng.sample(range(64), 3):
                x ^= 1 << bit
    prints = list(enumerate(sorted(values)))
    signed = [(i, x - 2**64 if x >= 2**63 else x) for i, x in prints]
    edges = simhash.links(spark.createDataFrame(signed, "rep long, fp long"), bucket=bucket).collect()
    assert all(bin(prints[e.a][1] ^ prints[e.b][1]).count("1") <= 3 for e in edges)
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in edges:
        p, q = find(e.a), find(e.b)
        root[max(p, q)] = min(p, q)
    assert {i: find(i) for i in root} == brute_components(prints)


def test_masks_cover_every_pair_within_the_radius():
    masks = [m % 2**64 for m in simhash.masks()]
    rng = random.Random(4)
    assert len(masks) == 15
    for _ in range(2000):
        differ = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(differ & m == 0 for m in masks)


def test_simhash_of_odd_tables(docs, odd, clashing):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert simhash.near_duplicates(docs()).count() == 0
    kept = simhash.keep_one(clashing(odd))
    assert kept.columns == clashing(odd).columns and kept.where("doc_id IN (2, 3)").count() == 0 and kept.where("doc_id IS NULL").count() == 2


def test_one_row_of_each_group_stays(docs):
    rng = random.Random(6)
    one, two, three, four = (prose(rng, 80) for _ in range(4))
    kept = simhash.keep_one(docs((1, one), (1, one), (2, one + " end"), (3, two), (3, three), (4, two), (None, four), (None, four), (None, one)))
    # A row that shares its id with another's copy stays, if its own text is unlike any other.
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(0, four), (1, one), (3, two), (3, three)])
    kept = simhash.keep_one(docs((1, one), (2, one), (2, two)))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, one), (2, two)])


# ---- 4 fingerprints ------------------------------------------------------------------------------------------------
def shingles(text):
    words = text.encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


@pytest.mark.parametrize("stretch", [7, 2000])
def test_fingerprints_estimate_likeness(docs, clashing, monkeypatch, stretch):
    from tidemark.llm import frames

    monkeypatch.setattr(frames.stretch_bounds, "__defaults__", ("doc_id", stretch))
    rows = [*corpus(n=80), (500, None), (501, ""), (502, "a b"), (503, "a b")]
    got = {r.doc_id: r for r in oph.edited_pairs(clashing(docs(*rows))).collect()}
    assert len(got) == len(rows)
    errors = []
    for at, (i, text, *_) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [got[i].near_edited - jaccard(shingles(text), shingles(edited)), got[i].near_next - jaccard(shingles(text), shingles(after))]
        if text == edited:
            assert got[i].near_edited == 1 and got[i].fingerprint == got[i].edited_fingerprint
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.15
    assert got[502].fingerprint == got[503].fingerprint and got[502].near_next == 1


def test_fingerprints_of_odd_tables(docs, odd):
    got = oph.edited_pairs(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.near_edited <= 1 for r in got)
    assert oph.edited_pairs(docs()).count() == 0
    alone = oph.edited_pairs(docs((5, "only one text here"))).collect()
    assert [r.near_next for r in alone] == [1.0]
    assert oph.fingerprint(odd).count() == odd.count()


# ---- 5 extraction --------------------------------------------------------------------------------------------------
PAGES = [
    (None, ""),
    ("", ""),
    ("just text", "just text"),
    ("<p>a&amp;b &lt;x&gt; caf&eacute;<p>two\n  lines<br>here", "a&b <x> café\ntwo lines here"),
    (
        "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav>"
        "<div class='ad banner'>Buy</div><article><header><h1>Head</h1><span>by me</span></header><p>First paragraph of it.</p><p>Second."
        "<aside>no</aside><ul><li>x<li>y</ul><section id=comments><p>Nice post</p></section><footer>tags</footer></article>"
        "<footer>&copy; me</footer></body></html>",
        "Head\nFirst paragraph of it.\nSecond.\nx\ny",
    ),
    (
        "<body><div class=menu><a href=1>one</a><a href=2>two</a></div><div id=main><h2>Title</h2><p>A long paragraph that has a lot of text in it.</p>"
        "<p>Another long paragraph that has a lot of text in it.</p></div><div class=cookie-notice>We use cookies, a lot of them, really.</div>",
        "Title\nA long paragraph that has a lot of text in it.\nAnother long paragraph that has a lot of text in it.",
    ),
    ("<form><main><p>Inside a page-wide form.</p></main></form>", "Inside a page-wide form."),
    ("<nav><ul><li>never closed<article><p>Text of the article.</article>", "Text of the article."),
    ("<![bad <p>still read</p>", None),
    ("<p style='display: none'>hidden</p><p>shown</p>", "shown"),
    ("<article><p><b>One.<br><p>Two.</p></article>", "One.\nTwo."),
]


def test_extracts_the_article(spark):
    df = spark.createDataFrame([(i, f"u{i}", h) for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r.page_id: r for r in extract.extract(df.withColumn("text", F.lit("clash"))).collect()}
    for i, (_, expected) in enumerate(PAGES):
        assert expected is None or got[i].text == expected
        assert got[i].n_chars == len(got[i].text) and got[i].url == f"u{i}"
    assert extract.extract(df.limit(0)).count() == 0


def test_long_and_repeated_pages(spark):
    long = "<article>" + "".join(f"<p>paragraph {i} of many</p>" for i in range(20_000)) + "</article>"
    df = spark.createDataFrame([(1, None, long), (1, None, long), (None, None, None)], "page_id long, url string, html string")
    got = extract.extract(df).collect()
    assert sorted(r.text.count("\n") for r in got) == [0, 19_999, 19_999]


def test_ratios_choose_the_lines():
    long = ["The first long paragraph, which says a lot about its subject and a little of others.",
            "The second long paragraph, which goes on with it and comes to no end for a while.",
            "The third long paragraph, which ends it, as everything has been said by now."]
    paragraphs = "".join(f"<p>{x}</p>" for x in long)
    card = "<article><h3><a href=1>Another page</a></h3><p>Short words on it.</p></article>"
    # The main text lies beside an article element that is only a card.
    assert extract.main_text(f"<body><div>{paragraphs}</div>{card}</body>") == "\n".join(long)
    # Rows of links inside the article are none of its text; a short paragraph is.
    links = "".join(f"<li><a href={i}>Page {i}</a></li>" for i in range(6))
    assert extract.main_text(f"<article>{paragraphs}<p>So.</p><p>Yes.</p><ul>{links}</ul></article>") == "\n".join([*long, "So.", "Yes."])
    # Elements of the same kind of content come together.
    two = f"<article>{paragraphs}</article>" * 2
    assert extract.main_text(f"<body>{two}</body>") == "\n".join(long * 2)


# ---- 6 toxicity ----------------------------------------------------------------------------------------------------
def toxic_corpus(n=600):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        text = prose(rng, rng.randrange(20, 80), [f"{a}{b}{c}" for a in ("mo", "ti", "ka") for b in ("ren", "lu", "so", "vel") for c in ("", "na", "dir", "po")]).split(" ")
        for _ in range(rng.choice([1, 2, 5]) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["vermin", "Filthy", "rotten,", "vermins"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_documents(spark, docs, clashing):
    rows, labels = toxic_corpus()
    df = clashing(docs(*rows))
    model = toxicity.train(df, spark.createDataFrame(labels[:400], LABELS))
    got = {r.doc_id: r for r in toxicity.severity(df, model).collect()}
    assert (np.diff(model.thresholds) > 0).all()
    unseen = [(got[i], bad) for i, _, bad in labels[400:]]
    assert not [r for r, bad in unseen if r.toxic and not bad]
    assert sum(r.toxic for r, bad in unseen if bad) >= 0.9 * sum(bad for _, bad in unseen)
    assert all(0 <= r.severity <= toxicity.GRADES - 1 for r in got.values())
    many = [got[i].severity for i, text in rows if text.lower().count("vermin") >= 3]
    few = [got[i].severity for i, text in rows if got[i].toxic and text.lower().count("vermin") <= 1]
    assert np.mean(many) > np.mean(few)


def test_toxicity_of_odd_tables(spark, docs, odd):
    none = spark.createDataFrame([], LABELS)
    assert toxicity.train(odd, none) is None
    assert {r.severity for r in toxicity.severity(odd, None).collect()} == {0.0}
    marks = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (5, 1, 0), (6, None, None), (None, 1, 1)], LABELS)
    assert toxicity.severity(odd, toxicity.train(odd, marks)).count() == odd.count()
    assert toxicity.severity(docs(), toxicity.train(docs(), marks)).count() == 0


def test_gradient_fits_ordered_grades():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, 500)
    weights, thresholds = toxicity.fit(np.arange(500), np.zeros(500, np.int64), x.astype(float), x, 1)
    assert weights[0] > 2 and (np.diff(thresholds) > 0).all()


# ---- 7 substrings --------------------------------------------------------------------------------------------------
def brute_substrings(rows, length=200):
    data = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(x[i : i + length] for _, x in data for i in range(len(x) - length + 1))
    out = []
    for k, x in data:
        marks = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                marks[i : i + length] = b"\1" * length
        spans = sum(1 for i, m in enumerate(marks) if m and (not i or not marks[i - 1]))
        kept = bytes(b for b, m in zip(x, marks) if not m)
        out.append((k, len(x), sum(marks), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def substring_rows(seed):
    rng = random.Random(seed)
    rows = [(r[0], r[1]) for r in corpus(seed, 50)]
    base = prose(rng, 200)
    for i in range(12):  # near copies: an edit here and there
        cut = rng.randrange(len(base))
        rows.append((200 + i, base[:cut] + f" edit{i} " + base[cut + rng.randrange(9) :]))
    rows += [(300, "ab" * 400), (301, "a" * 700), (302, "x" + "a" * 199), (303, "é" * 250), (304, "z" + "é" * 130), (305, None), (306, "")]
    exact = "".join(rng.choice("abcdefghij") for _ in range(200))
    rows += [(400, "1" + exact + "2"), (401, "3" + exact + "4"), (402, exact[1:] + "5"), (403, exact[:199])]
    return rows


@pytest.mark.parametrize(("seed", "contexts"), [(1, substrings.CONTEXTS), (2, substrings.CONTEXTS), (3, 2)])
def test_substrings_equal_brute_force(docs, clashing, seed, contexts):
    rows = substring_rows(seed)
    got = substrings.report(clashing(docs(*rows)), contexts).collect()
    assert sorted(map(tuple, got), key=repr) == brute_substrings(rows)


def test_substrings_in_pieces_and_small_shards(docs, monkeypatch):
    monkeypatch.setattr(substrings, "_PIECE", 300)
    monkeypatch.setattr(substrings, "_COMBINED", 50)
    monkeypatch.setattr(substrings, "_SYMBOLS", 10)
    rows = substring_rows(4)
    assert sorted(map(tuple, substrings.report(docs(*rows)).collect()), key=repr) == brute_substrings(rows)


def test_substrings_of_odd_tables(docs, odd, clashing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, substrings.report(odd).collect()), key=repr) == brute_substrings(rows)
    assert substrings.report(docs()).count() == 0
    wide = clashing(odd)
    out = substrings.remove(wide)
    assert out.columns == wide.columns and out.count() == odd.count()
    assert {r.text for r in out.collect() if r.doc_id == 6} == {"end"}
    twice = docs((1, "q" * 250), (1, "q" * 250), (1, "other"))
    assert sorted(r.n_removed for r in substrings.report(twice).collect()) == [0, 250, 250]


def test_texts_are_shuffled_once(docs):
    """Both steps that need texts read the same shuffle, with and without other columns."""
    rows = substring_rows(1)
    for df in (substrings.report(docs(*rows)), substrings.remove(docs(*rows))):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        dealt = [x for x in plan.split("\n") if "hashpartitioning(key" in x and "REPARTITION_BY_COL" in x]
        assert sum("ReusedExchange" not in x for x in dealt) == 1 and sum("ReusedExchange" in x for x in dealt) >= 1


# ---- 8 token files -------------------------------------------------------------------------------------------------
def brute_tokens(rows, file, end=1):
    plain = Tokenizer.from_file(public_tokenizers.path(file))
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    return [(k, np.array([*plain.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for k, t in rows]


@pytest.mark.parametrize("block", [64, tokenfile.BLOCK])
def test_token_files_round_trip(spark, docs, odd, clashing, monkeypatch, block):
    from tidemark.llm import frames

    monkeypatch.setattr(frames.stretch_bounds, "__defaults__", ("doc_id", 9))
    for df in (docs(*corpus()), clashing(odd)):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        path = fresh_dir(spark, "tokens")
        tokenfile.write_tokens(df, WORDS, 1, path, block)
        got = tokenfile.read_tokens(spark, path).collect()
        at, expected = 0, []
        for k, ids in brute_tokens(rows, "word_bpe_49k.json"):
            expected.append((at, k, len(ids), zlib.crc32(ids)))
            at += len(ids)
        assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected


def test_token_files_of_an_empty_table(spark, docs):
    path = fresh_dir(spark, "tokens")
    tokenfile.write_tokens(docs(), WORDS, 1, path)
    assert tokenfile.read_tokens(spark, path).count() == 0


# ---- 9 packing -----------------------------------------------------------------------------------------------------
def test_packing_holds_every_id_once(docs, odd, clashing):
    for df in (docs(*corpus(n=150)), clashing(odd)):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = packing.pack(df, BYTES, 1).collect()
        expected = Counter()
        for k, ids in brute_tokens(rows, "byte_bpe_50k.json"):
            at = 0
            for n in packing.cuts(len(ids)):
                expected[(k, at, n, zlib.crc32(ids[at : at + n]), len(ids))] += 1
                at += n
        assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expected
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        assert sorted(sequences) == list(range(len(sequences)))
        for pieces in sequences.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= packing.CAPACITY
        assert len(sequences) <= -(-sum(r.length for r in got) // packing.CAPACITY) + 2
    assert packing.pack(docs(), BYTES, 1).count() == 0


# ---- 10 quality classifier -----------------------------------------------------------------------------------------
def encoded(df, labels):
    """The blocks of documents, and their trained rows."""
    blocks = frames.cut(kneser.blocks(df))
    return blocks, frames.cut(kneser.trained_rows(blocks, labels))


def trusting(spark, ids):
    return spark.createDataFrame([(i, 1, 0) for i in ids], LABELS)


def trained_ids(labels):
    return {r.doc_id for r in kneser.trusted_ids(labels, True).collect()}


def test_counts_and_probabilities(spark, docs):
    df = docs(*corpus(n=30))
    labels = trusting(spark, range(-40, 40))
    counts = kneser.count_runs(*encoded(df, labels))
    expected, of = Counter(), trained_ids(labels)
    fold = lambda b: int(kneser._CLASS[b])
    for r in df.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text) if r.doc_id in of else []
        for word in [*words, ""] if words else []:
            symbols = [0] * (kneser.ORDER - 1) + [fold(b) for b in word.encode() + b" " if fold(b) != 255]
            for i in range(kneser.ORDER - 1, len(symbols)):
                code = 0
                for x in symbols[i - kneser.ORDER + 1 : i + 1]:
                    code = code * kneser.SYMBOLS + x
                expected[code] += 1
    assert expected and {r.gram: r.c for r in counts.collect()} == dict(expected)
    table = kneser.surprise_table(counts)
    mass = np.exp(-table / 1e6).reshape(-1, kneser.SYMBOLS).sum(axis=1)
    assert np.allclose(mass, 1, atol=1e-3)  # every context's probabilities sum to one
    seen = np.array(list(expected))
    assert table[seen].mean() < table.mean()


def test_discounts_follow_the_counts():
    d = kneser.discounts({1: 100, 2: 40, 3: 20, 4: 10})
    y = 100 / 180
    assert d == pytest.approx((1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.5))
    assert kneser.discounts({}) == (0.5, 0.75, 0.9)


def test_classifier_on_held_out_documents(spark, docs, clashing):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        good = i % 5 != 0
        text = prose(rng, rng.randrange(5, 80))
        rows.append((i, text if good else " ".join(w.upper() + "$%&!!" for w in text.split()), rng.choice(["en", "de"])+"", "s"))
        labels.append((i, int(good), 0))
    df = clashing(docs(*rows))
    got = {r.doc_id: r for r in kneser.judge(df, spark.createDataFrame(labels[:250], LABELS)).collect()}
    for i, good, _ in labels:
        assert got[i].kept == bool(good), (rows[i], got[i])
    kept = kneser.keep(df, spark.createDataFrame(labels[:250], LABELS))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_classifier_of_odd_tables(spark, docs, odd):
    none = spark.createDataFrame([], LABELS)
    assert all(r.kept for r in kneser.judge(odd, none).collect())
    marks = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (6, 1, 0), (None, 1, 0), (7, None, None)], LABELS)
    got = kneser.judge(odd, marks).collect()
    assert len(got) == odd.count() and all(r.kept and r.perplexity is None for r in got if not (r.text if "text" in r else r.n_symbols))
    assert kneser.judge(docs(), marks).count() == 0 and kneser.keep(docs(), marks).count() == 0


def test_classifier_tells_word_order_and_letters(spark, docs):
    rng = random.Random(4)
    letters = "бвгджзклмнпрст"
    words = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(60)]
    other = [w.translate({ord(a): ord(b) for a, b in zip(letters, "βγδζθκλμνξπρστ")}) for w in words]

    def text(n):
        at, out = rng.randrange(60), []
        for _ in range(n):
            out.append(words[at])
            at = (at + 1 + rng.randrange(3)) % 60
        return out

    rows, labels = [], []
    for i in range(300):
        rows.append((i, " ".join(text(120)), "ru", "s"))
        labels.append((i, 1, 0))
    shuffled, foreign = [], []
    for i in range(300, 330):
        salad = text(120)
        rng.shuffle(salad)
        shuffled.append((i, " ".join(salad), "ru", "s"))
        foreign.append((i + 100, " ".join(other[words.index(w)] for w in text(120)), "ru", "s"))
    marks = spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r.kept for r in kneser.judge(docs(*rows, *shuffled, *foreign), marks).collect()}
    assert all(got[r[0]] for r in rows)
    assert not any(got[r[0]] for r in shuffled) and not any(got[r[0]] for r in foreign)


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 20])
def test_scores_are_the_probabilities_of_the_counts(spark, docs, monkeypatch, block_bytes):
    """Worked out by hand from the counts, with one, a few or all texts in a block, and words that only some texts have."""
    monkeypatch.setattr(kneser, "BLOCK_BYTES", block_bytes)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("the the the a b c dd éa f".split()) for _ in range(rng.randrange(0, 30)))) for i in range(60)]
    rows += [(100, "the unknown word " + "x" * 3000), (101, None), (3, "the the a"), (None, "the b the b")]
    df, labels = docs(*rows), trusting(spark, range(50))
    of = trained_ids(labels)
    table = kneser.surprise_table(kneser.count_runs(*encoded(df, labels)))
    texts = [["<", *r.text.split(), ">"] for r in df.collect() if r.doc_id in of and (r.text or "").split()]
    count = Counter(p for t in texts for p in zip(t, t[1:]))
    d2 = kneser.discounts(Counter(count.values()))
    types = Counter(b for _, b in count)
    d1 = kneser.discounts(Counter(types.values()))
    minus = lambda c, d: d[min(c, 3) - 1] if c else 0
    left = sum(minus(c, d1) for c in types.values()) / len(count)

    def spelled(word):
        raw = b"" if word == ">" else word.encode()
        found = kneser.Sequences.of(pa.array([raw.decode()])) if raw else kneser.Sequences.of(pa.array([""]))
        return int(found.spelled(table)[1][0 if raw else 1])

    def nats(a, b):
        after = {w: c for (x, w), c in count.items() if x == a}
        n, c = sum(after.values()), count[a, b]
        gamma = sum(minus(k, d2) for k in after.values()) / n if n else 1
        if not c and not types[b]:
            return spelled(b) / 1e6 - np.log(gamma * left)
        low = (types[b] - minus(types[b], d1)) / len(count) + left * np.exp(-spelled(b) / 1e6)
        return -np.log(((c - minus(c, d2)) / n if c else 0) + gamma * low)

    got = Counter((r.doc_id, r.row, r.micronats) for r in kneser.scores(df, labels).collect())
    assert sum(got.values()) == len(rows)
    micronats = {(i, row): m for i, row, m in got}
    for r in df.select("doc_id", "text", kneser.row_key().alias("row")).collect():
        seq = ["<", *r.text.split(), ">"] if (r.text or "").split() else []
        total = sum(nats(a, b) for a, b in zip(seq, seq[1:]))
        assert micronats[r.doc_id, r.row] / 1e6 == pytest.approx(total, abs=1e-3)


def test_words_of_a_block_come_back(spark):
    texts = pa.array(["a bb  a\tccc", None, "", " \n", "日本 a bb", "x" * 5000 + " a"])
    made = kneser.Sequences.of(texts)
    back = kneser.Sequences.unpacked(pa.py_buffer(made.packed()))
    assert (back.hashes == made.hashes).all() and (back.ids == made.ids).all() and (back.rows == made.rows).all()
    assert back.counts.tolist() == [4, 0, 0, 0, 3, 2]


# ---- rows that only a hash tells apart -----------------------------------------------------------------------------
def test_substrings_of_rows_without_ids_and_with_one_hash(spark, docs):
    """Two texts with one 32-bit hash: what repeats in the one isn't cut out of the other."""
    many = spark.range(200_000).select(F.concat(*[F.sha2(F.concat(F.lit(f"{i}:"), F.col("id").cast("string")), 256) for i in range(5)]).alias("text"))
    twins = many.withColumn("h", F.hash("text")).groupBy("h").agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").first().texts
    one, two = twins[:2]
    for ids in ((None, None, None), (7, 7, 7)):
        rows = list(zip(ids, (one, two, one[40:290] + " and an end")))
        got = sorted((r.n_bytes, r.n_removed) for r in substrings.report(docs(*rows)).collect())
        assert got == [(261, 250), (320, 0), (320, 250)]


def test_rules_are_estimated_without_ids(spark, docs):
    rows = [(None, f"some text number {i} " * 5) for i in range(300)]
    found = rules.estimate(docs(*rows), sample=50)
    assert found.keys() == {r.name for r in rules.RULES}


def test_names_that_an_article_may_be_about(spark):
    """Classes that look like page furniture at first sight, and an element that says something."""
    text = "The committee met in the morning and heard the report of its three members on the state of the bridges."
    parts = "".join(f"<{e}><p>{i} {text}</p></{e.split()[0]}>" for i, e in enumerate(('div class="share-prices"', 'section class="related-work"', 'div id="search-engines"')))
    gone = "".join(f'<div class="{c}"><p>Share this with all of your friends today and tomorrow, please.</p></div>' for c in ("share-buttons", "related-posts", "related", "social"))
    page = f"<html><body><article><h1>Bridges</h1><p>{text}</p>{parts}<p>So <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds. {text}</p>{gone}</article></body></html>"
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    got = extract.extract(df).first().text
    assert all(f"{i} {text}" in got for i in range(3)) and "So E=m holds." in got.replace(" =", "=").replace("= ", "=")
    assert "friends" not in got


# ---- the classifier's shuffle and thresholds -----------------------------------------------------------------------
def test_lists_are_hardly_larger_over_more_shards(spark, docs):
    """What blocks send to shards, also with one word that is a third of all."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40_000)]
    rows = [(i, " ".join("the" if rng.random() < 0.33 else rng.choice(words) for _ in range(300))) for i in range(2000)]
    blocks, trained = encoded(docs(*rows).coalesce(1), trusting(spark, range(2000)))
    assert blocks.count() == 1

    def size(shards):
        asked = kneser.ask_pairs(blocks, trained, shards)
        return asked.agg(F.sum(F.length("data") + 24).alias("s"), F.max("n").alias("n")).first()

    few, many = size(12), size(1000)
    assert many.n < few.n / 20 and few.s <= many.s < 1.15 * few.s


def test_thresholds_lean_on_all_languages_by_their_number(spark):
    """A language with very many documents keeps its own quantile, one with few is drawn to the others."""
    rows = [(i, "many", 100, 100 * 1_000_000) for i in range(3000)] + [(i + 5000, "few", 100, 100 * 3_000_000) for i in range(3)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_symbols long, micronats long")
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows], LABELS)
    got = {(r.lang_known, r.lang): r.limit for r in kneser.thresholds(scored, labels).collect()}
    low, plus = 1e6 - 1.5e6 / 10, kneser.MARGIN * 1e6
    assert got[(False, None)] == pytest.approx(low + plus, abs=1000) and got[(True, "many")] == pytest.approx(low + plus, abs=1000)
    if (True, "few") in got:
        n = sum(1 for r in kneser.trusted_ids(labels, False).collect() if r.doc_id >= 5000)
        assert got[(True, "few")] == pytest.approx((n * (low + 2e6) + kneser.PRIOR * low) / (n + kneser.PRIOR) + plus, abs=2000)


# ---- the classifier's disk -----------------------------------------------------------------------------------------
def shuffled(spark):
    """Shuffle files on this machine."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_what_a_round_has_shuffled_is_removed(spark, docs, monkeypatch):
    """No list that blocks have sent to shards is on disk any more when the next round begins, or when the counts are read."""
    monkeypatch.setattr(kneser, "BLOCK_BYTES", 500)
    df, labels = docs(*corpus(n=60)), trusting(spark, range(60))
    before, seen = [], []

    def watched(f):
        def call(*args, **kwargs):
            if not before:
                before.append(shuffled(spark))  # what was there when the first round began
            # Files are removed in the background.
            until = time.time() + 10
            while (left := shuffled(spark) - before[0]) and time.time() < until:
                time.sleep(0.1)
            seen.append(left)
            return f(*args, **kwargs)

        return call

    for name in ("added", "few_of"):
        monkeypatch.setattr(kneser, name, watched(getattr(kneser, name)))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    assert kneser.scores(df, labels).count() == df.count()
    assert len(seen) == 2 * kneser.ROUNDS + 2 and not any(seen)
    assert spark.conf.get(name) == was


def test_rounds_ask_all_shards_once(spark, docs, monkeypatch):
    for shards in (1, 2, 3, 4, 5, 23, kneser.SHARDS):
        found = kneser.rounds(shards)
        assert [s for of in found for s in of] == list(range(shards)) and len(found) == min(shards, kneser.ROUNDS) and all(found)
    monkeypatch.setattr(kneser, "BLOCK_BYTES", 500)
    blocks, trained = encoded(docs(*corpus(n=60)), trusting(spark, range(60)))
    columns = lambda df: Counter((r.block, r.shard, r.n, bytes(r.data)) for r in df.collect())
    whole, parts = columns(kneser.ask_pairs(blocks, trained, 7)), Counter()
    for of in kneser.rounds(7):
        part = columns(kneser.ask_pairs(blocks, trained, 7, of))
        assert part and {shard for _, shard, _, _ in part} <= set(of)
        parts += part
    assert parts == whole
