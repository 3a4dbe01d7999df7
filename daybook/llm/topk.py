"""Exact top-k inner products by norm-bucketed retrieval.

Vectors become whole numbers and are grouped by length into buckets (a bin of
the length's logarithm), split into blocks of bounded size.  A query's scores
against the blocks of the greatest lengths give a first threshold; a block
takes part only if its greatest length times the query's can reach it.  Inside
a block the local cosine threshold (threshold over the product of lengths)
chooses the pruning: high thresholds prune by the interval that the query's
largest coordinate leaves for a candidate's same coordinate, low ones by the
candidates' lengths.  What is left is verified by exact products: in float64 where
lengths bound every product by 2**53, else what may count within the rounding error
is multiplied again in Python integers.

Scale: queries and candidates meet in blocks, one pair of blocks a row; a
bucket of equal lengths is split by a hash of the id; each pair yields at most
k rows per query.  Defined cases: vectors that are null, empty or hold null or
non-finite components take no part, nor do rows without id; vectors meet only
those of equal dimension; rows with the query's id are its own; a repeated row is a
candidate as often as it is there; a repeated query id asks its smallest vector, once;
a result beyond a long raises an error; columns besides vec_id and embedding are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import cut

K = 5
SCALE = 256
QUERY_STEP = 50
BLOCK_ROWS = 4096
QUERY_ROWS = 512
BINS_PER_DOUBLING = 16
#: Local cosine threshold from which a coordinate prunes better than lengths do.
COORDINATE_FROM = 0.5
#: Below this float64 holds every product and sum of whole numbers.
EXACT = 2.0 ** 53


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (whole components), dim, norm, bin."""
    ok = "embedding IS NOT NULL AND vec_id IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    v = F.expr(f"transform(embedding, x -> cast(floor({SCALE} * cast(x AS double)) AS double))")
    return (
        embeddings.where(F.expr(ok)).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .withColumn("dim", F.size("v"))
        .withColumn("norm", F.sqrt(F.expr("aggregate(v, 0D, (a, x) -> a + x * x)")))
        .withColumn("bin", F.floor(F.log2(F.greatest("norm", F.lit(2.0 ** -20))) * BINS_PER_DOUBLING).cast("int"))
    )


def _block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["norm", "vec_id"], ascending=[False, True])
    return pd.DataFrame({
        "dim": [key[0]], "bin": [key[1]], "salt": [key[2]], "n": [len(rows)], "top": [float(rows["norm"].max())],
        "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "mat": [np.stack(rows["v"].to_numpy()).astype(np.float64).tobytes()]})


BLOCK_SCHEMA = "dim int, bin int, salt int, n int, top double, ids binary, mat binary"


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors packed into blocks of about ``rows``, within one bin of one dimension."""
    counts = vectors.groupBy("dim", "bin").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts"))
    # By row, not by id: an id that most rows have is spread, too.
    salted = vectors.withColumn("row", F.monotonically_increasing_id()).join(counts, ["dim", "bin"]).withColumn(
        "salt", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("row")
    return salted.groupBy("dim", "bin", "salt").applyInPandas(_block, BLOCK_SCHEMA)


def best_of(q: np.ndarray, own: int, threshold: float, ids: np.ndarray, c: np.ndarray, norms: np.ndarray, k: int):
    """(ids, scores) of the k best candidates of one query whose score reaches the threshold."""
    length = float(np.sqrt(q @ q))
    use = slice(None)
    if threshold > 0:
        if length == 0 or length * norms[0] < threshold * (1 - 1e-12):
            return ids[:0], ids[:0]
        cosine = threshold / (length * norms[0])
        if cosine >= COORDINATE_FROM:
            f = int(np.argmax(np.abs(q)))
            unit = q[f] / length
            spread = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - unit * unit)))
            x = c[:, f] / np.where(norms > 0, norms, 1.0)
            # Cosine at least t means the angle to the axis is within the query's angle plus acos(t).
            low = cosine * unit - spread if cosine > -unit else -1.0
            high = cosine * unit + spread if cosine > unit else 1.0
            use = np.flatnonzero((x >= low - 1e-9) & (x <= high + 1e-9))
        else:
            use = slice(0, int(np.searchsorted(-norms, -threshold * (1 - 1e-12) / length, side="right")))
    c, ids, own_length = c[use], ids[use], length * (float(norms[0]) if len(norms) else 0.0)
    if own_length * (1 + 1e-9) >= EXACT:
        return exact_best(q, own, threshold, ids, c, k)
    scores = c @ q
    keep = (ids != own) & (scores >= threshold)
    scores, ids = scores[keep], ids[keep]
    if len(scores) > k:
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order].astype(np.int64)


def exact_best(q: np.ndarray, own: int, threshold: float, ids: np.ndarray, c: np.ndarray, k: int):
    """``best_of`` where float64 rounds: it only says which candidates may count, integers decide."""
    rough = c @ q
    error = (np.abs(c) @ np.abs(q)) * ((len(q) + 4) * 2.0 ** -52)
    may = np.flatnonzero((ids != own) & (rough + error >= threshold - abs(threshold) * 2.0 ** -52))
    if len(may) > k:
        sure = (rough - error)[may]
        may = may[(rough + error)[may] >= np.partition(sure, len(sure) - k)[len(sure) - k]]
    whole = [int(x) for x in q]
    best = sorted((-sum(int(x) * y for x, y in zip(c[i], whole)), int(ids[i])) for i in may)[:k]
    if any(abs(score) >= 1 << 63 for score, _ in best):
        raise OverflowError("an inner product exceeds a long")
    return np.array([i for _, i in best], np.int64), np.array([-score for score, _ in best], np.int64)


def _pairs(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                q = np.frombuffer(r.q_mat).reshape(r.q_n, -1)
                q_ids, ids = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.ids, np.int64)
                c = np.frombuffer(r.mat).reshape(r.n, -1)
                norms = np.sqrt((c * c).sum(axis=1))
                least = np.frombuffer(r.least) if r.least is not None else np.full(len(q), -np.inf)
                for i in range(len(q)):
                    got, scores = best_of(q[i], q_ids[i], least[i], ids, c, norms, k)
                    out.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": got, "score": scores}))
            yield pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(np.int64)
    return run


RESULT = "query_id long, vec_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score."""
    vectors = cut(vectors)
    candidates = cut(blocks(vectors, BLOCK_ROWS))
    fixed = queries.groupBy("vec_id").agg(F.min(F.struct("v", "dim", "norm", "bin")).alias("q")).select("vec_id", "q.*")
    asked = cut(blocks(cut(fixed), QUERY_ROWS).select(
        "dim", F.col("bin").alias("q_bin"), F.col("salt").alias("q_salt"), F.col("n").alias("q_n"), F.col("top").alias("q_top"),
        F.col("ids").alias("q_ids"), F.col("mat").alias("q_mat")))
    # First threshold: the k-th score among the candidates of the greatest lengths (one block per dimension).
    first = Window.partitionBy("dim").orderBy(F.desc("bin"), "salt")
    names = candidates.select("dim", "bin", "salt", "n", "top")
    heads = names.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place", "n", "top")
    seed = asked.join(heads.join(candidates, ["dim", "bin", "salt"]), "dim").withColumn("least", F.lit(None).cast("binary"))
    seeded = cut(_ranked(seed.repartition("dim", "q_bin", "q_salt").mapInPandas(_pairs(k), RESULT), k))
    least = seeded.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))

    def with_least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                yield pd.DataFrame({"dim": r.dim, "q_bin": r.q_bin, "q_salt": r.q_salt,
                                    "place": np.arange(r.q_n), "query_id": np.frombuffer(r.q_ids, np.int64),
                                    "norm": np.sqrt((np.frombuffer(r.q_mat).reshape(r.q_n, -1) ** 2).sum(axis=1))})

    members = asked.mapInPandas(with_least, "dim int, q_bin int, q_salt int, place int, query_id long, norm double")
    # One array of thresholds per query block (bounded by QUERY_ROWS), and the length a candidate must have to matter.
    known = members.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    per_block = known.groupBy("dim", "q_bin", "q_salt").agg(
        F.min(F.when((F.col("least") > 0) & (F.col("norm") > 0), F.col("least") / F.col("norm")).otherwise(F.lit(0.0))).alias("need"),
        F.sort_array(F.collect_list(F.struct("place", "least"))).alias("listed"))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({**{c: batch[c] for c in ("dim", "q_bin", "q_salt", "need")},
                                "least": [np.array([x["least"] for x in xs], float).tobytes() for xs in batch["listed"]]})

    needs = per_block.mapInPandas(packed, "dim int, q_bin int, q_salt int, need double, least binary")
    pairs = (
        needs.join(names.select("dim", "bin", "salt", "top"), "dim").where(F.col("top") * (1 + 1e-12) >= F.col("need")).drop("top")
        .join(asked, ["dim", "q_bin", "q_salt"]).join(candidates, ["dim", "bin", "salt"])
    )
    found = pairs.repartition("dim", "q_bin", "q_salt", "bin", "salt").mapInPandas(_pairs(k), RESULT)
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_topk(embeddings: DataFrame) -> DataFrame:
    vectors = whole_vectors(embeddings)
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), asked AS (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % {QUERY_STEP} = 0 GROUP BY vec_id), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM asked q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
