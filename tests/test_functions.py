"""Expression helpers: exact half-even rates, user-agent rules, contract checks."""

from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from inboxlens.functions import client_columns, half_even_percent, rate_or_zero, violations
from inboxlens.sources.fixture import USER_AGENTS


def _rate(spark, pairs):
    df = spark.createDataFrame(pairs, "num long, den long")
    return [r[0] for r in df.select(half_even_percent("num", "den")).collect()]


def test_half_even_cases(spark):
    got = _rate(spark, [(3, 96), (2, 0), (3, 2), (None, 4), (4, None), (1, 3), (0, 5)])
    assert got == [3.12, 0.0, 150.0, None, None, 33.33, 0.0]


def test_rate_or_zero_fills_missing(spark):
    df = spark.createDataFrame([(None, 4), (2, None), (1, 8)], "num long, den long")
    assert [r[0] for r in df.select(rate_or_zero("num", "den")).collect()] == [0.0, 0.0, 12.5]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=1, max_size=40))
def test_half_even_matches_decimal(spark, pairs):
    expected = [float((Decimal(n) * 100 / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_EVEN))
                for n, d in pairs]
    assert _rate(spark, pairs) == expected


def test_user_agent_rules(spark):
    df = spark.createDataFrame([(a,) for a in USER_AGENTS] + [(None,)], "user_agent string")
    got = [tuple(r) for r in df.select(*client_columns()).collect()]
    assert got == [("Chrome", "Windows", "Desktop"), ("Firefox", "Linux", "Desktop"),
                   ("IE", "Windows", "Desktop"), ("Safari", "iOS", "iPhone"),
                   ("Other", "Other", "Other"), ("None", "None", "None")]


def test_contract_violations(spark):
    df = spark.createDataFrame(
        [(1, "a", "SENT", "2024-01-01", "c" * 31), (None, None, "SENT", None, "ok"),
         (1, "a" * 151, "S", "2024-01-01", None)],
        "customer_id long, campaign_id string, type_event string, event_date string, city string")
    got = [r[0] for r in df.select(violations(limits={"campaign_id": 150, "city": 30})).collect()]
    assert got == [["city"], ["customer_id", "campaign_id", "event_date"], ["campaign_id"]]
