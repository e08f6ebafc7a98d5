import datetime as dt

from inboxlens.schemas import EVENT_SCHEMA

BASE = dt.datetime(2024, 1, 1, 0, 0, 0)


def event(customer_id=1, campaign_id="a", type_event="SENT", minutes=0, city="X",
          product_id=None, user_agent=None, country="C", state="S", gender=None, email=None):
    return (customer_id, campaign_id, type_event, BASE + dt.timedelta(minutes=minutes), gender,
            email, user_agent, country, city, state, product_id)


def events_df(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def one(df):
    out = df.collect()
    assert len(out) == 1, out
    return out[0]
