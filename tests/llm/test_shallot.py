"""Shallot clustering against the plain iteration in Python integers, and against its SQL."""

import hashlib
import math
import random

import duckdb
import pytest

from daybook.llm import shallot

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, components=64, centroids=40, rounds=5):
    """Every vector against every centroid in Python integers: sorted result rows."""
    kept = [(i, tuple(math.floor(float(x) * 256) for x in v)) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]

    def rank(row):
        return ("g" if row[0] is None else hashlib.sha256(f"2:{row[0]}".encode()).hexdigest(), row[1])

    c = [v for _, v in sorted(kept, key=rank)[:centroids]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, w)), k) for k, w in enumerate(c))

    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in kept]
        for k in range(len(c)):
            group = [v for (_, v), m in zip(kept, mine) if m == k]
            if group:
                c[k] = tuple(sum(col) // len(group) for col in zip(*group))
    last = [nearest(v) for _, v in kept]
    per = {k: sum(d for d, m in last if m == k) for k in range(len(c))}
    return sorted([(i, k, d, per[k], sum(per.values()), hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest())
                   for (i, _), (d, k) in zip(kept, last)], key=str)


def answer(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted([tuple(r) for r in df.collect()], key=str)


def random_vectors(seed, n, spread):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(64)] for _ in range(12)]
    return [(i, [rng.gauss(m, 0.05) for m in rng.choice(centres)]) for i in range(n)]


def floats(spark, rows):
    """The rows as Spark holds them: 4-byte floats."""
    return [(r["vec_id"], r["embedding"]) for r in spark.createDataFrame(rows, SCHEMA).collect()]


@pytest.mark.parametrize("spread", [0.0, 0.2])
def test_plain_iteration(spark, spread):
    rows = floats(spark, random_vectors(1, 400, spread))
    assert answer(shallot.op13_cluster(spark.createDataFrame(rows, SCHEMA).repartition(5))) == plain(rows)


def test_ties_repeats_and_rows_left_out(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.choice([0, 0, 0, 1])) / 256 if j < 3 else 0.0 for j in range(64)]) for i in range(120)]
    rows += rows[:30] + [(None, [0.5] * 64), (None, [0.25] * 64), (500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 65),
                         (504, [float("nan")] * 64), (505, [float("inf")] + [0.0] * 63), (506, [None] + [0.0] * 63)]
    got = answer(shallot.op13_cluster(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain(rows)
    wide = spark.createDataFrame([(*r, 1, 2.0) for r in rows], SCHEMA + ", rows int, lower double")
    assert answer(shallot.op13_cluster(wide)) == got


@pytest.mark.parametrize("n", [0, 1, 2, 7])
def test_few_vectors(spark, n):
    rows = floats(spark, random_vectors(2, n, 0.3)) if n else []
    assert answer(shallot.op13_cluster(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(6)
    rows = floats(spark, [(i, [rng.choice([1e6, 1e6 + 0.25, 1e6 - 40]) + rng.random() for _ in range(64)]) for i in range(80)])
    assert answer(shallot.op13_cluster(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    with pytest.raises(Exception, match="too large"):
        shallot.op13_cluster(spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)).collect()


def test_sql(spark, tmp_path):
    rows = random_vectors(3, 300, 0.1) + [(7, [0.0] * 64), (None, [0.1] * 64), (9, None), (10, [1.0])]
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.write.parquet(str(tmp_path / "e"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    result = db.sql(shallot.ORACLE)
    got = shallot.op13_cluster(frame)
    order = [result.columns.index(c) for c in got.columns]
    assert answer(got) == sorted([tuple(r[i] for i in order) for r in result.fetchall()], key=str)


def test_bounds_prune(spark):
    """Once the centroids settle, bounds spare most vectors the search, and results stay those of a full search."""
    import numpy as np
    rows = random_vectors(8, 300, 0.5)
    x = np.array([[math.floor(c * 256) for c in v] for _, v in rows])
    start = [list(map(int, v)) for v in x[:12]]
    model = shallot.Model(start, None)
    near, second, upper, lower, _ = model.assign(x, None, False)
    again = shallot.Model(start, start)
    searched = []
    again.search = lambda *a: searched.append(len(a[1]))
    assert (again.assign(x, (near, second, upper, lower), False)[0] == near).all()
    assert sum(searched) < 30
