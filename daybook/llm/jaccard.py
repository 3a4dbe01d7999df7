"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; documents with equal sets form a
class, and only its smallest doc_id takes part further.  MinHash values in
BANDS bands of ROWS propose candidates: documents that agree in a band meet in
the cell of the band bucket's smallest member (a pair at the threshold is
missed with probability (1 - 0.8**ROWS)**BANDS, below 1e-7).  Within a cell,
pairs compare their MinHash values CHUNK by CHUNK and are dropped as soon as
the posterior probability that their similarity reaches the threshold, under a
uniform prior, falls below TOLERANCE; the pairs left are verified exactly on
their shingle sets.

Scale: a cell is cut into tiles of at most two blocks of BLOCK_ROWS members,
so no task holds a group, and a tile returns links per member and a spanning
forest, never its pairs.  A pair that meets in several cells counts in the
first.  Band buckets only move (document, key) rows; texts move once, and only
those of documents that share a bucket are read for shingles again.  Groups
are closed by label propagation over the forests' edges with checkpoints.

Defined cases: null and word-less texts have no shingles, link to nothing and
each are their own group; texts of one to four words have one shingle of all
their words; repeated rows of one doc_id are one document; rows without
doc_id take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
CHUNK, TOLERANCE = 16, 1e-9
BLOCK_ROWS = 256
SEED = 20_231

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    inverse = pow(int(BASE), -1, 1 << 64)
    up, down = np.full(n, BASE, U64), np.full(n, U64(inverse), U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return np.empty(0, U64)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], white, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, U64)
    up, down = _powers(1 << max(12, len(raw).bit_length()))
    sums = np.zeros(len(raw) + 1, U64)
    np.cumsum((raw.astype(U64) + U64(1)) * up[:len(raw)], out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))
    width = min(WORDS, len(words))
    h = np.zeros(len(words) - width + 1, U64)
    for k in range(width):
        h = _mix(h + words[k:k + len(h)])
    return np.unique(h)


@lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | U64(1), rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def minhashes(s: np.ndarray) -> np.ndarray:
    """BANDS * ROWS MinHash values (32 bits each) of a non-empty set."""
    a, b = _multipliers()
    out = np.full(len(a), np.iinfo(U64).max, U64)
    for at in range(0, len(s), 512):
        part = s[at:at + 512]
        np.minimum(out, (part[None, :] * a[:, None] + b[:, None]).min(axis=1), out=out)
    return (out >> U64(32)).astype(np.uint32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, ROWS).astype(U64)
    key = np.arange(BANDS, dtype=U64)
    for k in range(ROWS):
        key = _mix(key * BASE + rows[:, k])
    return key.view(np.int64)


def _signed(x) -> int:
    return int(np.array([x], U64).view(np.int64)[0])


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text in batch["text"]:
            s = shingles(text)
            if len(s):
                out.append((len(s), _signed(np.bitwise_xor.reduce(s)), _signed(_mix(s + BASE).sum()), band_keys(minhashes(s))))
            else:
                out.append((0, 0, 0, None))
        frame = pd.DataFrame(out, columns=["n", "x", "y", "bands"])
        yield pd.concat([batch["doc_id"].reset_index(drop=True), frame], axis=1)


@lru_cache(maxsize=1)
def least_matches() -> list[int]:
    """For each number of values compared (CHUNK, 2 CHUNK, ...): the fewest matches that keep a pair.

    With a uniform prior the posterior of the similarity after m matches of n
    is Beta(m + 1, n - m + 1); its mass above the threshold is the chance of
    at most m successes in n + 1 trials at the threshold.
    """
    out = []
    for n in range(CHUNK, BANDS * ROWS + 1, CHUNK):
        mass, m = 0.0, 0
        while m <= n:
            mass += math.comb(n + 1, m) * THRESHOLD ** m * (1 - THRESHOLD) ** (n + 1 - m)
            if mass >= TOLERANCE:
                break
            m += 1
        out.append(m)
    return out


def _first_cell(leaders: list[np.ndarray], others: list[np.ndarray], cell: int) -> np.ndarray:
    """Whether no smaller cell holds both, for all pairs of the two lists of sorted leaders."""
    smaller = sorted({x for x in (y for z in leaders for y in z) if x < cell})
    place = {x: i for i, x in enumerate(smaller)}
    held = [np.zeros((len(z), max(1, len(smaller))), np.float32) for z in (leaders, others)]
    for matrix, z in zip(held, (leaders, others), strict=True):
        for i, row in enumerate(z):
            for x in row:
                if x in place:
                    matrix[i, place[x]] = 1
    return held[0] @ held[1].T == 0


def linked_pairs(left: list, right: list, same: bool, cell: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs at or above the threshold among two blocks of members.

    A member is (sorted shingles, MinHash values, leaders).
    """
    live = _first_cell([m[2] for m in left], [m[2] for m in right], cell)
    if same:
        live = np.triu(live, 1)
    i, j = np.nonzero(live)
    a, b = np.stack([m[1] for m in left]), np.stack([m[1] for m in right])
    matches = np.zeros(len(i), np.int32)
    for step, least in enumerate(least_matches()):
        part = slice(step * CHUNK, (step + 1) * CHUNK)
        matches += (a[i, part] == b[j, part]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        i, j, matches = i[keep], j[keep], matches[keep]
        if not len(i):
            return i, j
    ok = np.empty(len(i), bool)
    sizes_a, sizes_b = np.array([len(m[0]) for m in left]), np.array([len(m[0]) for m in right])
    if len(i) > 4 * (len(left) + len(right)):
        # Many pairs: one column per distinct shingle, common counts by a matrix product over slices of the columns.
        every = np.unique(np.concatenate([m[0] for m in [*left, *right]]))
        common = np.zeros((len(left), len(right)), np.float32)
        at = [[np.searchsorted(every, m[0]) for m in side] for side in (left, right)]
        for low in range(0, len(every), 8192):
            dense = [np.zeros((len(side), 8192), np.float32) for side in at]
            for matrix, side in zip(dense, at, strict=True):
                for row, columns in enumerate(side):
                    matrix[row, columns[np.searchsorted(columns, low):np.searchsorted(columns, low + 8192)] - low] = 1
            common += dense[0] @ dense[1].T
        shared = common[i, j].astype(np.int64)
    else:
        shared = np.array([len(np.intersect1d(left[p][0], right[q][0], assume_unique=True)) for p, q in zip(i, j, strict=True)], np.int64)
    ok = shared * 10 >= (sizes_a[i] + sizes_b[j] - shared) * 8
    return i[ok], j[ok]


def _tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    cell, low, high = key
    rows = rows.sort_values("rep")
    blocks = []
    for block in dict.fromkeys((low, high)):
        part = rows[rows["block"] == block]
        members = [(np.frombuffer(s, U64), np.frombuffer(m, np.uint32), np.asarray(l, np.int64))
                   for s, m, l in zip(part["shingles"], part["signature"], part["leaders"], strict=True)]
        blocks.append((part["rep"].to_numpy(np.int64), part["copies"].to_numpy(np.int64), members))
    left, right = blocks[0], blocks[-1]
    empty = pd.DataFrame({"rep": [], "links": [], "other": []}).astype(np.int64)
    if not left[2] or not right[2]:
        return empty
    i, j = linked_pairs(left[2], right[2], low == high, cell)
    if not len(i):
        return empty
    links: dict[int, int] = {}
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for p, q in zip(i, j, strict=True):
        u, v = int(left[0][p]), int(right[0][q])
        links[u] = links.get(u, 0) + int(right[1][q])
        links[v] = links.get(v, 0) + int(left[1][p])
        ru, rv = root(u), root(v)
        if ru != rv:
            parent[max(ru, rv)] = min(ru, rv)
    return pd.DataFrame({"rep": list(links), "links": list(links.values()), "other": [root(x) for x in links]})


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingles(t) for t in batch["text"]]
        yield pd.DataFrame({"rep": batch["rep"], "copies": batch["copies"], "leaders": batch["leaders"],
                            "shingles": [s.tobytes() for s in sets], "signature": [minhashes(s).tobytes() for s in sets]})


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) from edges (rep, other), other <= rep allowed either way."""
    both = cut(edges.select("rep", "other").unionByName(edges.select(F.col("other").alias("rep"), F.col("rep").alias("other")))
               .where("rep <> other").distinct())
    labels = cut(both.groupBy("rep").agg(F.least("rep", F.min("other")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("rep").alias("other"), "label"), "other").groupBy("rep").agg(F.min("label").alias("near"))
        lower = labels.join(near, "rep").select("rep", "label", F.least("label", "near").alias("low"))
        # Pointer jumping: take over the label of one's label.
        heads = labels.select(F.col("rep").alias("low"), F.col("label").alias("top"))
        jumped = cut(lower.join(heads, "low", "left").select("rep", "label", F.least("low", "top").alias("new")))
        changed = jumped.where("new < label").limit(1).count()
        labels = jumped.select("rep", F.col("new").alias("label"))
        if not changed:
            return labels.select(F.col("rep").alias("node"), "label")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, copy_of (smallest doc_id with the same shingles), class_id (smallest of its group), n_links.

    n_links counts the other documents at or above the threshold, copies included.
    """
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = cut(texts.mapInPandas(_sets, "doc_id long, n int, x long, y long, bands array<long>").dropDuplicates(["doc_id"]))
    classes = cut(sets.where("n > 0").groupBy("n", "x", "y").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")))
    keyed = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = keyed.groupBy("band", "key").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("members")).where("members > 1")
    met = keyed.join(buckets.drop("members"), ["band", "key"]).groupBy("rep").agg(
        F.sort_array(F.collect_set("leader")).alias("leaders"))
    met = cut(met.join(classes.select("rep", "copies"), "rep"))
    members = met.join(texts.dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "rep"), "rep").mapInPandas(
        _members, "rep long, copies long, leaders array<long>, shingles binary, signature binary")
    cells = met.select(F.explode("leaders").alias("cell")).groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = (
        members.withColumn("cell", F.explode("leaders")).join(cells, "cell")
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with"))
    )
    found = cut(placed.groupBy("cell", "low", "high").applyInPandas(_tile, "rep long, links long, other long"))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select("rep", "other"))
    per_class = classes.select("n", "x", "y", "rep", "copies").join(linked, "rep", "left").join(
        groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "x", "y", F.col("rep").alias("copy_of"), F.coalesce("label", "rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    with_words = sets.where("n > 0").join(per_class, ["n", "x", "y"]).select("doc_id", "copy_of", "class_id", "n_links")
    without = sets.where("n = 0").select(
        "doc_id", F.col("doc_id").alias("copy_of"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return with_words.unionByName(without)


def op8_jaccard(docs: DataFrame) -> DataFrame:
    return join(docs)


def keep_one(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the document with the smallest doc_id of each group; rows without doc_id stay."""
    first = join(docs).where("doc_id = class_id").select(F.col("doc_id").alias("kept_id"))
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"))
    ids = rows.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).join(first, F.col("doc_id") == F.col("kept_id"), "left_semi")
    return ids.unionByName(rows.where("doc_id IS NULL")).select("row.*")
