"""Registered queries and the corpus pipeline, stage by stage."""

import collections

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from daybook.llm import pieces, quality
from daybook.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE_SQL) <= set(oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(ORACLE_SQL[name])
    at = [[d[0] for d in res.description].index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in res.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        seen.append((docs, after))
        docs = after
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.op7_quality(seen[0][0], labels)
    accepted = {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    assert {r["doc_id"] for r in seen[0][1].collect()} == accepted
    assert {r["doc_id"] for r in seen[1][1].collect()} <= accepted
    assert {r["doc_id"] for r in seen[2][1].collect()} == {r["doc_id"] for r in seen[2][0].collect()}
    times = collections.Counter(r["doc_id"] for r in seen[3][1].collect())
    assert max(times.values()) <= 2
    codec = pieces.Codec(pieces.read_model())
    texts = {r["doc_id"]: r["text"] for r in seen[3][1].collect()}
    for r in seen[4][1].collect():
        assert r["round_trip"] and codec.decode(r["ids"]) == texts[r["doc_id"]]


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
