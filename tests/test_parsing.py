"""Parsing table: one row per case."""

import pytest

from uvlens.sources.behaviors import parse_messages, split_messages

CASES = [
    ('{"userId":"a","page":"p","behaviorTime":5}', True),
    ("{'userId':'a',page:'p',behaviorTime:5}", True),
    ('{"userId":"a","page":"p","behaviorTime":5,"zz":1}', True),
    ("bad", False),
    ("", False),
    ("   ", False),
    ('{"userId":"a"}', False),
    ('{"page":"p","behaviorTime":5}', False),
    (None, False),
]


@pytest.mark.parametrize("text,valid", CASES)
def test_parse_case(spark, text, valid):
    df = spark.createDataFrame([(text,)], "value string")
    row = parse_messages(df).first()
    assert row.valid is valid
    if valid:
        assert (row.user_id, row.page, row.behavior_ms) == ("a", "p", 5)


def test_split_valid_and_rejected(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "value string")
    good, bad = split_messages(df)
    assert good.count() == sum(v for _, v in CASES)
    assert bad.count() == sum(not v for _, v in CASES)
