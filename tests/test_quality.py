import pytest
from conftest import values

from tidemark.operators.quality import Rule, apply_rules, expect, expect_or_drop, keep_valid, quality_report

RULES = [expect("has_id", "id IS NOT NULL"), expect_or_drop("positive", "v > 0"), expect_or_drop("small", "v < 9")]


@pytest.fixture
def df(rows):
    return rows("id int, v int", (1, 1), (2, 0), (3, None), (None, 2), (5, 10), (None, -1))


def test_dropping_rules_drop_false_and_null(df):
    assert values(keep_valid(df, RULES)) == [(1, 1), (None, 2)]
    assert keep_valid(df, RULES[:1]).count() == 6


def test_report_counts_each_rule_over_all_rows(df):
    assert [tuple(r) for r in quality_report(df, RULES, "t").collect()] == [
        ("t", "has_id", "warn", 4, 2),
        ("t", "positive", "drop", 3, 3),
        ("t", "small", "drop", 4, 2),
    ]


def test_observation_agrees_with_report(df):
    kept, observed = apply_rules(df, RULES)
    assert kept.count() == 2
    assert observed.get == {"rows": 6, "has_id": 2, "positive": 3, "small": 2}


def test_report_of_nothing_is_zero(df):
    assert [r["failed"] for r in quality_report(df.filter("v > 99"), RULES).collect()] == [0, 0, 0]


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Rule("r", "true", "fail")
