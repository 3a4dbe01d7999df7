"""Dimensions: assets (T2), currency pairs (T3) and the ticker→CIK map."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import zero_pad_cik
from daybook.session import checkpoint_root

# The asset class every listed ticker gets.
EQUITY_CLASS = "equity"

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def dense_index(df: DataFrame, order: list[str], id_col: str, partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = 0-based position of each row in ``order`` (dense, unique).

    Equal to ``row_number() over (order by ...) - 1`` without a single-task
    window over the data:

    * range-partition on ``order`` plus a per-row tie-breaker, so even one
      value holding most rows is split over many partitions, and sort within
      partitions;
    * checkpoint (reliable, in the shared checkpoint folder) so the layout is
      fixed even if a task is retried or an executor is lost;
    * count rows per partition (one row per partition), turn the counts into
      offsets, and add each row's index within its partition.

    Rows that tie on ``order`` get consecutive ids in an unspecified order.
    """
    checkpoint_root(df.sparkSession)
    tagged = df.withColumn("__tb", F.monotonically_increasing_id())
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = tagged.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order], "__tb")
    ranged = ranged.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order], "__tb")
    fixed = ranged.checkpoint(eager=True)
    placed = fixed.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    )
    # One row per partition: bounded by the partition count, not the data.
    counts = placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    return (
        placed.join(F.broadcast(offsets), "__pid")
        .withColumn(id_col, (F.col("__offset") + F.col("__local")).cast("long"))
        .drop("__tb", "__pid", "__local", "__offset")
    )


#: Ranges that distinct values are ranked in, and ids that one row is expanded to at a time.
RANK_RANGES, EXPAND = 256, 10_000


def dense_rank_of_values(df: DataFrame, value: str, id_col: str, ranges: int = RANK_RANGES) -> DataFrame:
    """``value, id_col``: every row of ``df``'s column with its 0-based position in value order.

    Two passes in one lazy plan; no job runs while the frame is built, and no window
    sees more than one range of values:

    * equal values are counted (a partial aggregate, so a value that most rows have is
      one row from here on);
    * range edges are a sample of the distinct values, the ``ranges`` with the smallest
      hashes, as a scalar subquery: the same on every run, bounded by the parameter;
    * a running sum of the counts within each range, plus the total of all ranges before
      it (one row per range), is the position of a value's first row;
    * a value with n rows is expanded to n consecutive positions again, in steps, so that
      no long array is made of a value that most rows have.

    NULLs come first.
    """
    sizes = df.groupBy(F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    # Distinct values in the order of their hashes: an even sample of them.
    sample = sizes.where(F.col("__v").isNotNull()).orderBy(F.xxhash64("__v"), "__v").limit(ranges - 1)
    edges = sample.agg(F.array_sort(F.collect_list("__v"))).scalar()
    # Edges up to the value, by halving steps: beyond the last edge the comparison is NULL.
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(ranges.bit_length()))])
    in_range = F.aggregate(halves, F.lit(0), lambda at, step: F.when(F.get("__edges", at + step - 1) <= F.col("__v"), at + step).otherwise(at))
    # Never NULL, in Spark's eyes too: else it tests that before the grouping, on every row and for every edge.
    ranged = sizes.withColumn("__edges", edges).withColumn(
        "__range", F.coalesce(F.when(F.col("__v").isNull(), -1).otherwise(in_range), F.lit(0))).drop("__edges")
    within = Window.partitionBy("__range").orderBy(F.col("__v").asc_nulls_first())
    # One row per range: at most ``ranges`` + 1.
    totals = ranged.groupBy("__range").agg(F.sum("__n").alias("__total"))
    offsets = totals.select("__range", (F.sum("__total").over(Window.orderBy("__range")) - F.col("__total")).alias("__offset"))
    first = ranged.withColumn("__first", F.sum("__n").over(within) - F.col("__n")).join(F.broadcast(offsets), "__range").select(
        "__v", "__n", (F.col("__offset") + F.col("__first")).alias("__first"))
    steps = first.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(EXPAND).cast("long"))).alias("__step"))
    last = F.least(F.col("__step") + EXPAND, F.col("__n")) - 1
    return steps.select(F.col("__v").alias(value), F.explode(F.sequence("__step", last)).alias("__k"), "__first").select(
        value, (F.col("__first") + F.col("__k")).cast("long").alias(id_col))


def asset_dimension(tickers: DataFrame) -> DataFrame:
    """T2 ``asset_id, ticker, asset_class``: one row per listed ticker.

    ``asset_id`` is dense and deterministic: the row's position in ticker
    order.  Duplicates in the list are kept (each gets its own id).
    """
    indexed = dense_rank_of_values(tickers.select("ticker"), "ticker", "asset_id")
    return indexed.select(
        "asset_id", "ticker", F.lit(EQUITY_CLASS).alias("asset_class")
    )


def cik_map(entries: DataFrame) -> DataFrame:
    """``ticker, cik`` from company→CIK entries ``ticker, cik_str, pos``
    (and ``doc`` when the mapping spans several files).

    A ticker listed twice resolves to its last entry in document order.
    CIKs are zero-padded to 10 characters and never truncated.  A partial
    (map-side) aggregate, so a repeated ticker costs nothing extra.
    """
    order = F.struct("doc", "pos") if "doc" in entries.columns else F.col("pos")
    last = entries.groupBy("ticker").agg(F.max_by("cik_str", order).alias("cik_str"))
    return last.select("ticker", zero_pad_cik("cik_str").alias("cik"))


def currency_pairs(pairs: DataFrame) -> DataFrame:
    """T3: the pair list as read (see ``sources.read_currency_pairs``)."""
    return pairs.select("currency", "transaction_currency")
