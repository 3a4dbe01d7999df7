"""Backward, inclusive as-of left join.

For every left row, the right row with the same ``by`` value and the
greatest ``right_on <= left_on``; no such row → NULL payload.

Plan ("key spine"), chosen so that neither a hot ``by`` value nor a long
right history concentrates work:

1. Take the distinct left keys ``(by, left_on)`` and the right rows reduced
   to one per ``(by, right_on)`` (right ties keep the largest payload, a
   deterministic choice).  Both are partial (map-side) aggregates, so
   duplicate keys collapse before the shuffle.
2. Union them and forward-fill the last right payload with a window
   partitioned by ``by`` (a right row sorts before a left key it equals).
   The window sees at most two rows per distinct key, so its size per
   ``by`` value is bounded by the number of distinct key values (days, for
   daily keys) and not by the number of rows.
3. Equi-join the left rows to the spine on ``(by, left_on)``: exactly one
   spine row per key, so no candidate pairs are enumerated.  AQE turns the
   join into a broadcast at run time only when the measured spine is small,
   and splits skewed left partitions otherwise.

Keys with unboundedly many values per ``by`` (timestamps) split the fill of
step 2 by key ranges: either by a function of the key (``bucket``) or, with
``split_rows``, by ranges that are found in the data.  The ``by`` values with
more than ``split_rows`` spine rows get range edges at equal shares of their
own rows (approximate percentiles, a partial aggregate), one small array each;
all others keep one range.  A window then sees about ``split_rows`` rows
whatever a single ``by`` holds, and the last payload of every range is carried
to the next ones over one row per range.

Right rows with a NULL ``by`` or NULL key can never match and are dropped
first; left rows with NULLs find no spine row and keep NULL payloads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

_BY, _KEY, _MATCH, _IS_LEFT = "__asof_by", "__asof_key", "__asof_match", "__asof_left"
_BUCKET, _PREV, _EDGES, _OWN = "__asof_bucket", "__asof_prev", "__asof_edges", "__asof_own"

#: Ranges that one ``by`` value is split into at most, and spine rows a range aims at.
MAX_RANGES = 512
SPLIT_ROWS = 1_000_000


def asof_spine(
    left_keys: DataFrame,
    right: DataFrame,
    *,
    by: str,
    left_on: str,
    right_on: str,
    payload: list[str],
    matched_key: str,
    bucket: Callable[[Column], Column] | None = None,
    right_by: str | None = None,
    split_rows: int | None = None,
) -> DataFrame:
    """One row per distinct left key with the matched right payload struct."""
    rby = right_by or by
    key_type = left_keys.schema[left_on].dataType
    by_type = left_keys.schema[by].dataType
    match = F.struct(
        F.col(right_on).cast(key_type).alias(matched_key), *[F.col(c) for c in payload]
    )
    # Right: one row per (by, key); ties keep the largest payload.
    r = (
        right.where(F.col(rby).isNotNull() & F.col(right_on).isNotNull())
        .select(
            F.col(rby).cast(by_type).alias(_BY),
            F.col(right_on).cast(key_type).alias(_KEY),
            match.alias(_MATCH),
        )
        .groupBy(_BY, _KEY)
        .agg(F.max(_MATCH).alias(_MATCH))
        .withColumn(_IS_LEFT, F.lit(False))
    )
    match_type = r.schema[_MATCH].dataType
    # Left: the distinct keys only (a map-side hash aggregate).
    lk = (
        left_keys.where(F.col(by).isNotNull() & F.col(left_on).isNotNull())
        .select(F.col(by).alias(_BY), F.col(left_on).alias(_KEY))
        .distinct()
        .select(
            _BY,
            _KEY,
            F.lit(None).cast(match_type).alias(_MATCH),
            F.lit(True).cast(BooleanType()).alias(_IS_LEFT),
        )
    )
    # On equal keys the right row sorts first, so it is visible to the left key.
    spine = lk.unionByName(r)
    if split_rows is not None:
        if bucket is not None:
            raise ValueError("either bucket or split_rows")
        return _two_level_fill(_ranged(spine, split_rows))
    if bucket is None:
        carry = (
            Window.partitionBy(_BY)
            .orderBy(_KEY, _IS_LEFT)
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        return (
            spine.withColumn(_MATCH, F.last(_MATCH, ignorenulls=True).over(carry))
            .where(F.col(_IS_LEFT))
            .drop(_IS_LEFT)
        )
    return _two_level_fill(spine.withColumn(_BUCKET, bucket(F.col(_KEY))))


def range_edges(rows: DataFrame, by: str, key: str, split_rows: int = SPLIT_ROWS, max_ranges: int = MAX_RANGES) -> DataFrame:
    """``by, edges``: range edges of ``key`` for the ``by`` values with more than ``split_rows`` rows.

    ``edges`` cuts a value's rows into equal shares of about ``split_rows``, at most
    ``max_ranges``.  The frame has at most (all rows / ``split_rows``) rows.  Keys may be
    numbers, dates or timestamps.
    """
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split_rows)
    # One row per split_rows rows at most: bounded by the parameter, never by the number of ``by`` values.
    hot = rows.select(by, key).join(F.broadcast(sizes), by)
    shares = [k / max_ranges for k in range(1, max_ranges)]
    marks = hot.groupBy(by).agg(F.max("n").alias("n"), F.percentile_approx(key, shares, 10 * max_ranges).alias("marks"))
    ranges = F.least(F.ceil(F.col("n") / split_rows), F.lit(max_ranges)).cast("int")
    picked = F.transform(F.sequence(F.lit(1), ranges - 1), lambda k: F.element_at("marks", F.greatest(F.round(k * max_ranges / ranges).cast("int"), F.lit(1))))
    return marks.select(by, F.array_distinct(picked).alias("edges"))


def _ranged(spine: DataFrame, split_rows: int) -> DataFrame:
    """The spine with the range each row falls into (0 for ``by`` values that are not split)."""
    edges = range_edges(spine, _BY, _KEY, split_rows).withColumnRenamed("edges", _EDGES)
    split = spine.join(F.broadcast(edges), _BY, "left")
    below = F.size(F.filter(F.col(_EDGES), lambda e: e < F.col(_KEY)))
    return split.withColumn(_BUCKET, F.when(F.col(_EDGES).isNull(), 0).otherwise(below)).drop(_EDGES)


def _two_level_fill(spine: DataFrame, kept: tuple[str, ...] = (), order: tuple[str, ...] = (_KEY, _IS_LEFT)) -> DataFrame:
    """Forward fill split by key bucket, for keys with very many values per ``by``.

    Within a (by, bucket) the last right payload so far is carried as usual.
    Across buckets, one row per (by, bucket) holds the bucket's last right
    payload; a window over those rows (bounded by the number of buckets)
    gives each bucket the last payload of any earlier bucket, which fills
    left keys that have no right row earlier in their own bucket.  ``kept``
    names further columns of the spine to return, ``order`` what sorts it
    within a bucket.

    Both levels need every column of the spine, and the join's test for NULLs
    stops at the aggregate (its ``by`` is an aggregated one): so a spine that is
    dealt by (by, bucket) is made and moved once, and read by both.
    """
    within = (
        Window.partitionBy(_BY, _BUCKET)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = spine.withColumn(_MATCH, F.last(_MATCH, ignorenulls=True).over(within))
    per_bucket = spine.groupBy(_BY, _BUCKET).agg(
        F.max_by(_MATCH, F.when(F.col(_MATCH).isNotNull(), F.col(_KEY))).alias(_PREV),
        F.bool_or(_IS_LEFT).alias(_IS_LEFT),
        F.max(_BY).alias(_OWN),
    ).select(F.col(_OWN).alias(_BY), _BUCKET, _PREV, _IS_LEFT)
    earlier = Window.partitionBy(_BY).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    # Only buckets that have left keys, and something to fill them with, go back.
    carried = (
        per_bucket.withColumn(_PREV, F.last(_PREV, ignorenulls=True).over(earlier))
        .where(F.col(_IS_LEFT) & F.col(_PREV).isNotNull())
        .drop(_IS_LEFT)
    )
    return (
        filled.where(F.col(_IS_LEFT))
        .join(carried, [_BY, _BUCKET], "left")
        .select(_BY, _KEY, F.coalesce(F.col(_MATCH), F.col(_PREV)).alias(_MATCH), *kept)
    )


def filled_by_bucket(keys: DataFrame, by: str, key: str, match: str, left: str, bucket: str) -> DataFrame:
    """``by, key, match, left`` of the keys that hold a left row (``left`` not NULL), ``match`` carried forward in two levels.

    ``keys`` has one row per (``by``, ``key``), with what the key has of either side and
    its ``bucket``.  Dealt by (``by``, ``bucket``), it isn't moved again.
    """
    spine = keys.select(F.col(by).alias(_BY), F.col(key).alias(_KEY), F.col(match).alias(_MATCH), left,
                        F.col(left).isNotNull().alias(_IS_LEFT), F.col(bucket).alias(_BUCKET))
    return _two_level_fill(spine, (left,), (_KEY,)).select(F.col(_BY).alias(by), F.col(_KEY).alias(key), F.col(_MATCH).alias(match), left)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: str,
    left_on: str,
    right_on: str,
    payload: list[str],
    matched_key: str = "matched_key",
    left_keys: DataFrame | None = None,
    bucket: Callable[[Column], Column] | None = None,
    right_by: str | None = None,
    split_rows: int | None = None,
) -> DataFrame:
    """Left rows (all, with multiplicity) + ``matched_key`` + ``payload`` columns.

    ``by`` names the grouping column (on the right too, unless ``right_by``
    names it there); ``left_on`` / ``right_on`` the ordered keys.  The right
    key and group are cast to the left side's types.
    ``left_keys`` may name a cheaper frame with the same distinct
    ``(by, left_on)`` values as ``left`` (e.g. the input of a dedup step).
    ``bucket`` (key → coarser, order-preserving key, e.g. the day of a
    timestamp) splits the forward fill per (by, bucket) for keys with
    unboundedly many distinct values per ``by``; daily keys do not need it
    (it costs about 1.6× on 6M daily rows).  ``split_rows`` (e.g. ``SPLIT_ROWS``)
    finds such ranges itself, for any ``by`` value with more rows than that.
    """
    spine = asof_spine(
        (left_keys if left_keys is not None else left).select(by, left_on),
        right,
        by=by,
        left_on=left_on,
        right_on=right_on,
        payload=payload,
        matched_key=matched_key,
        bucket=bucket,
        right_by=right_by,
        split_rows=split_rows,
    )
    joined = left.join(
        spine,
        (left[by] == spine[_BY]) & (left[left_on] == spine[_KEY]),
        "left",
    )
    return joined.select(
        *[left[c] for c in left.columns],
        F.col(f"{_MATCH}.{matched_key}").alias(matched_key),
        *[F.col(f"{_MATCH}.{c}").alias(c) for c in payload],
    )
