"""Known results on seed data, given as two SQL scripts of INSERT statements in the folder ``TEST_SEED_DIR``.

The scripts are read as text: first the rows a new database starts with, then later changes. The expected figures were
counted independently and are listed in FIXTURES.md.
"""

import os
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.scd import current, scd1, scd2
from tidemark.plans.marts import daily_metrics, tier_distribution, top_creators
from tidemark.plans.model import MODEL, dimension, fact_stream

SEED_DIR = os.environ.get("TEST_SEED_DIR", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(SEED_DIR), reason="no seed scripts")

_INSERT = re.compile(r"INSERT INTO (\w+) \(([^)]*)\) VALUES \((.*)\);")
_VALUE = re.compile(r"'((?:[^']|'')*)'|([^,\s]+)")

# Date, events, users, seconds.
DAYS = """
2025-09-27 92 84 10965
2025-09-28 94 86 10217
2025-09-29 109 97 14147
2025-09-30 77 71 9935
2025-10-01 86 78 9253
2025-10-02 103 92 12065
2025-10-03 81 75 9495
2025-10-04 95 87 11786
2025-10-05 104 93 11340
2025-10-06 78 71 9720
2025-10-07 81 76 8612
"""


def rows_of(path, table, columns):
    found = []
    for line in path.read_text().splitlines():
        m = _INSERT.match(line.strip())
        if m and m[1] == table:
            named = [c.strip() for c in m[2].split(",")]
            given = [a.replace("''", "'") if b == "" else None if b == "NULL" else b for a, b in _VALUE.findall(m[3])]
            row = dict(zip(named, given, strict=True))
            found.append(tuple(row.get(c) for c in columns))
    return found


@pytest.fixture(scope="module")
def seed(spark):
    """(initial, change) frames of each table of the model."""
    scripts = sorted(Path(SEED_DIR).glob("*.sql"), key=lambda p: "initial" not in p.name)

    def frame(path, spec):
        names = spec.columns.names
        text = spark.createDataFrame(rows_of(path, spec.table, names), ", ".join(f"{c} string" for c in names))
        return text.select(*[F.col(f.name).cast(f.dataType) for f in spec.columns])

    return {t: tuple(frame(p, spec) for p in scripts[:2]) for t, spec in MODEL.items()}


def test_row_counts(seed):
    counts = {t: (a.count(), b.count()) for t, (a, b) in seed.items()}
    assert counts["DimUser"] == (500, 70) and counts["FactStream"] == (1000, 300)
    assert counts["DimArtist"] == counts["DimTrack"] == (500, 50) and counts["DimDate"][0] == 365


def test_user_history(seed):
    initial, change = seed["DimUser"]
    history = scd2(initial.unionAll(change), ["user_id"], ["updated_at"], ["subscription_type", "country"])
    versions = Counter(r["user_id"] for r in history.collect())
    assert sum(versions.values()) == 568 and Counter(versions.values()) == {1: 433, 2: 66, 3: 1}
    assert current(history).count() == 500
    own = history.filter("user_id = 44").orderBy("__START_AT").collect()
    assert [r["subscription_type"] for r in own] == ["Family", "Free", "Premium"]


@pytest.mark.parametrize(("table", "key", "replaced"), [("DimArtist", "artist_id", 26), ("DimTrack", "track_id", 29)])
def test_latest_rows(seed, table, key, replaced):
    initial, change = seed[table]
    latest = scd1(initial.unionAll(change), [key], ["updated_at"])
    assert latest.count() == 500
    assert latest.join(initial, [key, "updated_at"], "left_anti").count() == replaced


def test_daily_metrics(seed):
    got = daily_metrics(fact_stream(seed["FactStream"][0]), extended=True).collect()
    shown = [(str(r["stream_date"]), r["total_streams"], r["unique_listeners"], r["total_listen_seconds"]) for r in got]
    assert shown == [(d, int(a), int(b), int(c)) for d, a, b, c in (x.split() for x in DAYS.split("\n") if x)]
    assert got[0]["total_listen_minutes"] == 182.75 and got[0]["avg_listen_duration_seconds"] == 119.2


def test_top_and_tiers(seed):
    fact = fact_stream(seed["FactStream"][0])
    tracks, artists = seed["DimTrack"][0], seed["DimArtist"][0]
    top = top_creators(fact, tracks, artists).collect()
    assert len(top) == 289
    assert [(r["artist_id"], r["total_streams"], r["total_listen_duration_sec"]) for r in top[:3]] == [
        (452, 13, 1385),
        (29, 11, 908),
        (376, 10, 1042),
    ]
    assert [r["artist_id"] for r in top[3:10]] == [22, 68, 98, 100, 143, 153, 455]
    history = dimension("gold_dim_user_scd2", seed["DimUser"][0])
    tiers = {r["subscription_type"]: (r["total_streams"], r["active_users"]) for r in tier_distribution(fact, history).collect()}
    assert tiers == {"Free": (343, 151), "Family": (331, 137), "Premium": (326, 140)}
