"""The corpus pipeline, stage by stage, and the registered queries."""

import importlib

import pytest

import corpus_pipeline
from inboxlens.llm import queries
from tests.conftest import SF_SMALL

from .helpers import EDGES, corpus, docs_df
from .test_line_dedup import brute as deduped
from .test_simhash import fingerprint, roots

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_queries_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "pack"]
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" in entry.queries() and set(queries.queries()) <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


@pytest.fixture(scope="module")
def rows():
    return corpus(n=60) + [(1000 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(EDGES)]


def test_line_dedup_stage(spark, rows):
    docs = docs_df(spark, rows, extra=("removed",))
    got = corpus_pipeline.line_dedup(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    out = got.collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=repr) == deduped(rows)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)


def test_near_dedup_stage(spark, rows):
    docs = docs_df(spark, rows, extra=("id", "count"))
    got = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    out = [(r.doc_id, r.text) for r in got.collect()]
    # one row of each group, and it is one of its least doc_id
    fps = [fingerprint(r[1]) for r in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i)
                             if bin(fps[i] ^ fps[j]).count("1") <= 2])
    ids, own = {}, {}
    for r, at in zip(rows, root, strict=True):
        ids[at] = min((x for x in (ids.get(at), r[0]) if x is not None), default=None)
    for r, at in zip(rows, root, strict=True):
        if r[0] == ids[at]:
            own.setdefault(at, set()).add((r[0], r[1]))
    assert len(out) == len(own)
    assert all(len(texts & set(out)) == 1 for texts in own.values())


def test_pipeline_runs_whole(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], SF_SMALL)
        assert out.columns == COLUMNS
        kept.append(spark.createDataFrame(out.collect(), docs.schema))
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    assert ids[2] == ids[1]  # line dedup keeps every document
    good = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").collect()}
    assert len(good & ids[1]) >= 0.97 * len(good & ids[0])
    packed = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    times = kept[4].groupBy("doc_id").count().toPandas().set_index("doc_id")["count"].to_dict()
    assert packed[packed["piece"] == 0].groupby("doc_id").size().to_dict() == times
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_covers_its_table(spark, name):
    got = queries.queries()[name](spark, SF_SMALL)
    if name.startswith("op7_"):
        n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").where("vec_id % 20 = 0").count()
        assert got.select("query_id").distinct().count() == n
    else:
        key, source = {"op12_": ("conv_id", "conversations"), "op13_": ("vec_id", "embeddings")}.get(
            name[:5], ("doc_id", "documents"))
        whole = spark.read.parquet(f"{SF_SMALL}/{source}.parquet").select(key).distinct()
        assert got.select(key).distinct().count() == whole.count()
