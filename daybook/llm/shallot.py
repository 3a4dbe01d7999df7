"""Centroid clustering of integer vectors: exact k-means by Shallot search.

Vectors with exactly ``components`` components, none null or non-finite, become
integers floor(scale * x).  Every vector keeps its nearest centroid, its second
nearest, an upper bound of its distance to the first and a lower bound of its
distance to all others.  Per round the bounds give way by what the centroids
moved.  Only where they cross is the distance to the own centroid taken, and only
where they still cross, the distance to the second.  From the closer of the two
the others are visited in order of their distance to it, and only as far as its
distance plus that of the second best so far: a ball that shrinks as the scan
finds better ones.  Bounds are floats with a margin (MARGIN); whatever survives
them is compared in exact integers, ties to the smaller number.

Scale: no vector is ever shuffled.  A round is one pass, task by task, that
writes the vectors with their bounds to the shared scratch folder (the round
before is deleted then, so two copies exist at most) and one row of sums per task
and cluster.  Spark adds those up; the driver gets clusters x components numbers,
the model itself, which is also all that goes back to the tasks.  A cluster that
holds a third of all rows costs nothing extra.  Lost tasks are run again from the
written round.

Defined cases: vectors of another length, null ones and ones with null or
non-finite components take no part; equal vectors and repeated vec_ids each count
and keep a row; a null vec_id takes part and comes last among the initial
centroids; of equal hashes the smaller vector is first; fewer vectors than
centroids leave as many centroids as vectors; an empty centroid stays where it is
and has no rows; an empty table gives no rows; components from 2**62 on after
scaling, and distances or sums of distances beyond a long, raise an error; columns
besides vec_id and embedding are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import forget
from daybook.session import scratch_path

COMPONENTS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Bounds decide only when they differ by this fraction; their rounding error is far below it.
MARGIN = 1e-9
#: Integers up to this have squared distances in a long; larger ones are computed as Python integers.
FAST = 1 << 27

STATE = ("vec_id long, vector array<long>, nearest int, second int, upper double, lower double, distance long, "
         "rows long, sums array<decimal(38,0)>, inertia decimal(38,0)")
_BATCH = pa.schema([
    ("vec_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("nearest", pa.int32()), ("second", pa.int32()),
    ("upper", pa.float64()), ("lower", pa.float64()), ("distance", pa.int64()),
    ("rows", pa.int64()), ("sums", pa.list_(pa.decimal128(38))), ("inertia", pa.decimal128(38))])


def integer_vectors(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, vector (array of long) of the rows that take part."""
    def whole(x):
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0 ** 62, F.floor(scaled)).otherwise(
            F.raise_error(F.lit("a component is too large to cluster")).cast("bigint"))

    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return rows.where((F.size("embedding") == components) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("vector"))


def initial(vectors: DataFrame, centroids: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "vector").limit(centroids)
    return [r["vector"] for r in first.select("vector").collect()]


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to rows of ``c`` (one each, or one for all)."""
    difference = x - c
    return (difference * difference).sum(axis=1)


def root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Model:
    """Centroids of a round with what the search needs: their neighbours in order, and how far they moved."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None):
        dtype = np.int64 if all(abs(c) <= FAST for row in centroids for c in row) else object
        self.c = np.array(centroids, dtype=dtype)
        apart = np.stack([root(distances(self.c.astype(dtype), row)) for row in self.c])
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        if before is None:
            self.moved = self.others = None
            return
        moved = np.array([float(sum((p - q) ** 2 for p, q in zip(a, b))) ** 0.5 for a, b in zip(centroids, before)])
        self.moved = moved * (1 + MARGIN)
        # What any centroid but the own one moved at most.
        self.others = np.array([max([m for j, m in enumerate(self.moved) if j != i], default=0.0) for i in range(len(moved))])

    def assign(self, x: np.ndarray, state: tuple | None, exact: bool) -> tuple:
        """(nearest, second, upper, lower, distance or None) of every row."""
        c, k, n = self.c, len(self.c), len(x)
        if state is None:
            near, other = np.zeros(n, np.int64), np.full(n, min(1, k - 1))
            upper, lower = np.full(n, np.inf), np.zeros(n)
        else:
            near, other, upper, lower = (a.copy() for a in state)
            upper, lower = upper + self.moved[near], lower - self.others[near]
        squares = np.zeros(n, dtype=x.dtype)
        if k == 1:
            squares = distances(x, c[near])
            return near, other, root(squares), np.full(n, np.inf), squares
        open_ = np.flatnonzero((upper * (1 + MARGIN) >= lower) | exact)
        squares[open_] = distances(x[open_], c[near[open_]])
        upper[open_] = root(squares[open_]) * (1 + MARGIN)
        open_ = open_[upper[open_] * (1 + MARGIN) >= lower[open_]]
        if len(open_):
            self.search(x, open_, near, other, upper, lower, squares)
        return near, other, upper, lower, squares if exact else None

    def search(self, x, rows, near, other, upper, lower, squares) -> None:
        """The two nearest centroids of ``rows``, from the closer of the two they remember."""
        c, k = self.c, len(self.c)
        a, b = near[rows].copy(), other[rows].copy()
        da, db = squares[rows], distances(x[rows], c[b])
        swap = (db < da) | ((db == da) & (b < a))
        a[swap], b[swap] = b[swap], a[swap].copy()
        da, db = np.where(swap, db, da), np.where(swap, da, db)
        start, known, radius = a.copy(), b.copy(), root(da)
        at = np.arange(len(rows))
        for rank in range(1, k):
            at = at[self.apart[start[at], rank] <= (radius[at] + root(db[at])) * (1 + MARGIN)]
            if not len(at):
                break
            j = self.order[start[at], rank]
            # The centre itself may not stand first in its own order where centroids coincide.
            new = (j != known[at]) & (j != start[at])
            on, j = at[new], j[new]
            d = distances(x[rows[on]], c[j])
            first = (d < da[on]) | ((d == da[on]) & (j < a[on]))
            then = ~first & (d < db[on])
            b[on[first]], db[on[first]] = a[on[first]], da[on[first]]
            a[on[first]], da[on[first]] = j[first], d[first]
            b[on[then]], db[on[then]] = j[then], d[then]
        near[rows], other[rows], squares[rows] = a, b, da
        upper[rows], lower[rows] = root(da) * (1 + MARGIN), root(db) * (1 - MARGIN)


def round_pass(model: Model, started: bool, last: bool) -> Callable:
    """Arrow pass of one round: vectors with new bounds, then one row of sums per cluster the task met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = model.c.shape
        sums, rows, inertia = np.zeros((k, width), object), [0] * k, [0] * k
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("vector")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            if model.c.dtype == object or np.abs(x).max() > FAST:
                x = x.astype(object)
            state = None if not started else tuple(
                batch.column(n).to_numpy(zero_copy_only=False).astype(t)
                for n, t in (("nearest", np.int64), ("second", np.int64), ("upper", np.float64), ("lower", np.float64)))
            near, second, upper, lower, exact = model.assign(x, state, last)
            for cluster in np.unique(near):
                mine = near == cluster
                rows[cluster] += int(mine.sum())
                if last:
                    inertia[cluster] += sum(int(d) for d in exact[mine])
                else:
                    sums[cluster] += x[mine].sum(axis=0).astype(object)
            none = pa.nulls(batch.num_rows)
            distance = pa.array([int(d) for d in exact], pa.int64()) if last else none.cast(pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), lists.cast(pa.list_(pa.int64())), pa.array(near.astype(np.int32)), pa.array(second.astype(np.int32)),
                pa.array(upper), pa.array(lower), distance, none.cast(pa.int64()),
                pa.nulls(batch.num_rows, pa.list_(pa.decimal128(38))), none.cast(pa.decimal128(38))], schema=_BATCH)
        found = [{"nearest": i, "rows": rows[i], "sums": [Decimal(int(s)) for s in sums[i]], "inertia": Decimal(inertia[i])}
                 for i in range(k) if rows[i]]
        if found:
            yield pa.RecordBatch.from_pylist(found, _BATCH)
    return run


def moved(spark: SparkSession, path: str, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor of the mean of every non-empty cluster of a written round."""
    parts = spark.read.schema(STATE).parquet(path).where("rows IS NOT NULL").select("nearest", "rows", F.posexplode("sums").alias("at", "sum"))
    new = [list(c) for c in centroids]
    for r in parts.groupBy("nearest", "at").agg(F.sum("rows").alias("rows"), F.sum("sum").alias("sum")).collect():
        new[r["nearest"]][r["at"]] = int(r["sum"]) // r["rows"]
    return new


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every row of ``vectors`` (vec_id, vector)."""
    spark = vectors.sparkSession
    now, before, path = initial(vectors, centroids, seed), None, None
    if not now:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    for k in range(rounds + 1):
        rows = vectors if path is None else spark.read.schema(STATE).parquet(path).where("rows IS NULL")
        held, path = path, scratch_path(spark, "shallot")
        rows.mapInArrow(round_pass(Model(now, before), k > 0, k == rounds), STATE).write.parquet(path)
        if held:
            forget(spark, held)
        if k < rounds:
            now, before = moved(spark, path, now), now
    state = spark.read.schema(STATE).parquet(path)
    per = {r["nearest"]: int(r["inertia"]) for r in state.where("rows IS NOT NULL").groupBy("nearest").agg(
        F.sum("inertia").alias("inertia")).collect()}
    if sum(per.values()) >= 1 << 63:
        raise ValueError("the sum of the squared distances exceeds a long")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]

    def of_cluster(values: list) -> F.Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)

    return state.where("rows IS NULL").select("vec_id", F.col("nearest").alias("cluster"), "distance").select(
        "*", of_cluster([per.get(i, 0) for i in range(len(now))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(per.values())).cast("long").alias("inertia"), of_cluster(digests).alias("centroid_sha256"))


def op13_cluster(embeddings: DataFrame) -> DataFrame:
    """The contract's query."""
    return cluster(integer_vectors(embeddings))


def _oracle() -> str:
    """The plain iteration, every vector against every centroid (DuckDB)."""
    first = f"ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, c"
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS c
  FROM embeddings WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS})""",
        "comp AS MATERIALIZED (SELECT rid, unnest(c) AS x, generate_subscripts(c, 1) AS j FROM kept)",
        f"c0 AS MATERIALIZED (SELECT k, unnest(c) AS x, generate_subscripts(c, 1) AS j FROM (SELECT row_number() OVER ({first}) - 1 AS k, c FROM kept {first} LIMIT {CENTROIDS}))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, k, d FROM (SELECT rid, k, sum((comp.x - c.x) * (comp.x - c.x)) AS d FROM comp JOIN c{r} c USING (j) GROUP BY rid, k)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.k, c.j, CAST(coalesce(m.x, c.x) AS BIGINT) AS x FROM c{r} c LEFT JOIN (
  SELECT k, j, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x FROM a{r} JOIN comp USING (rid) GROUP BY k, j) m USING (k, j))""")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, CAST(k AS INTEGER) AS "cluster", CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN kept USING (rid) JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k) USING (k)"""


ORACLE = _oracle()
