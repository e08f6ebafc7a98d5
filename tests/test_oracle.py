"""Every registered query against its DuckDB oracle on the smallest generated scale."""

import os

import duckdb
import pytest

from inboxlens.plans.catalog import queries
from inboxlens.plans.oracle import oracle_sql
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, canon


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    scols, srows = canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(oracle_sql()[name])
    ocols, orows = canon([d[0] for d in res.description], res.fetchall())
    assert scols == ocols
    assert len(srows) == len(orows)
    assert srows == orows


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(set(queries()) - {n for n in queries() if n.startswith(
    ("stream_", "changelog_", "fanout_"))}))
def test_output_types_equal_the_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}
    rel = duck.sql(oracle_sql()[name])
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert ours == theirs
