"""Exact top-k where float64 rounds, and with repeated rows."""

import math
import random

import duckdb
import pytest

from daybook.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows):
    """Python integers, every query against every row."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in kept:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in kept if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:5])]
    return sorted(out)


def answer(spark, rows):
    df = topk.op5_topk(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def sql(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(folder / "e"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/e/*.parquet'")
    return sorted(db.sql(topk.ORACLE).fetchall())


def test_large_components_keep_their_order(spark, tmp_path):
    rows = [(0, [2e6, 1.0]), (1, [2e6, 2 / 256]), (2, [2e6, 3 / 256]), (3, [2e6, 5 / 256]), (4, [-2e6, 1.0])]
    want = plain(rows)
    assert [r[2] for r in want] == [3, 2, 1, 4]
    assert answer(spark, rows) == want == sql(spark, rows, tmp_path)


def test_repeated_rows_and_queries(spark, tmp_path):
    rows = [(50, [1.0, 0.5]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [0.5, 0.5]), (50, [0.5, 0.75]), (50, [0.5, 0.75]), (100, [2.0, 0.0])]
    assert answer(spark, rows) == plain(rows) == sql(spark, rows, tmp_path)


def test_random_against_plain(spark, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    for scale in (1.0, 1e5, 3e6):
        rows = [(rng.randrange(300), [rng.uniform(-scale, scale) + rng.random() for _ in range(4)]) for _ in range(300)]
        rows += [(0, [scale] * 4), (50, [scale, -scale, 0.0, 1 / 256])]
        assert answer(spark, rows) == plain(rows)


def test_a_result_beyond_a_long_raises(spark):
    with pytest.raises(Exception, match="exceeds a long"):
        answer(spark, [(0, [1e9, 1e9]), (1, [1e9, 1e9])])
