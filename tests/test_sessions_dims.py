"""Sessions against a brute-force reference; dimension cleaning and flattening."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from inboxlens.operators import dims
from inboxlens.operators.sessions import sessions
from tests.helpers import event, events_df

GAP_MIN = 12 * 60


def brute_sessions(evs, gap_min):
    """Sort each customer's times; a new session when the step exceeds the gap."""
    out = []
    by_cust = {}
    for e in evs:
        by_cust.setdefault(e[0], []).append(e[3])
    for c, ts in by_cust.items():
        ts.sort()
        start = prev = ts[0]
        n = 1
        for t in ts[1:]:
            if t - prev > dt.timedelta(minutes=gap_min):
                out.append((c, start, prev + dt.timedelta(minutes=gap_min), n))
                start, n = t, 0
            prev = t
            n += 1
        out.append((c, start, prev + dt.timedelta(minutes=gap_min), n))
    return sorted(out)


def test_gap_is_inclusive(spark):
    evs = [event(customer_id=1, minutes=0), event(customer_id=1, minutes=GAP_MIN),
           event(customer_id=1, minutes=2 * GAP_MIN + 1)]
    got = sorted(tuple(r) for r in sessions(events_df(spark, evs), "12 hours").collect())
    assert got == brute_sessions(evs, GAP_MIN)
    assert [r[3] for r in got] == [2, 1]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20 * 24 * 60)), min_size=1, max_size=60))
def test_sessions_match_brute_force(spark, pts):
    evs = [event(customer_id=c, minutes=m) for c, m in pts]
    got = sorted(tuple(r) for r in sessions(events_df(spark, evs), "12 hours").collect())
    assert got == brute_sessions(evs, GAP_MIN)


def test_hot_customer_is_reduced_before_the_window(spark):
    # one customer holds almost every row: the window sees one row per bucket
    evs = [event(customer_id=1, minutes=i % 30) for i in range(2000)] + [event(customer_id=2)]
    out = sessions(events_df(spark, evs), "12 hours")
    assert sorted((r[0], r[3]) for r in out.collect()) == [(1, 2000), (2, 1)]


def test_price_cleaning(spark):
    landed = spark.createDataFrame([(1, "12.5"), (2, "12,5"), (3, None)], "id int, price string")
    valid, rejected = dims.clean_prices(landed)
    assert sorted(tuple(r) for r in valid.collect()) == [(1, 12.5), (2, 0.0)]
    assert [tuple(r) for r in rejected.collect()] == [(3, None, "price")]


def test_tag_counts_and_join(spark):
    df = spark.createDataFrame([("BTC, ETH",), ("ETH",), (None,)], "tags string")
    assert sorted(tuple(r) for r in dims.tag_counts(df).collect()) == [("BTC", 1), ("ETH", 2)]
    arr = spark.createDataFrame([(["a", "b"],)], "tags array<string>")
    assert dims.join_tags(arr, "tags").first()[0] == "a, b"


def test_flatten_users_and_audience(spark):
    users = spark.createDataFrame(
        [(3, ("Ann", "Lee"), "female", ("UK", "Leeds", "WY", ("GMT",)), 5, "yahoo")],
        "user_key long, name struct<first:string,last:string>, gender string, "
        "location struct<country:string,city:string,state:string,timezone:struct<description:string>>, "
        "email_number long, email_domain string")
    flat = dims.flatten_users(users).first().asDict()
    assert flat["name_customer"] == "Ann Lee"
    assert flat["email"] == "Ann-5@yahoo.com.co"
    no_domain = dims.flatten_users(users.withColumn("email_domain", F.lit(None).cast("string"))).first()
    assert no_domain["email"] is None and no_domain["name_customer"] == "Ann Lee"
    assert flat["description_customer"] == "GMT"
    ev = events_df(spark, [event(customer_id=3, campaign_id="a"), event(customer_id=3, campaign_id="a"),
                           event(customer_id=3, campaign_id="b"), event(customer_id=9)])
    aud = dims.audience(ev, dims.flatten_users(users))
    assert sorted((r["id"], r["campaign_id"]) for r in aud.collect()) == [(3, "a"), (3, "b")]


def test_campaign_links(spark):
    landed = spark.createDataFrame([("c1", "Bob", 4)], "uuid_campaign string, created_by string, product_id int")
    assert [tuple(r) for r in dims.campaign_links(landed).collect()] == [(4, "c1", "Bob")]

