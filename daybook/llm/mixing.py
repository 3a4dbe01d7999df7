"""Mixing sources to target weights by a low-discrepancy slot schedule.

Method: the schedule has ``2**k`` slots.  Slot ``i`` holds the van der Corput
point ``reverse_bits(i) / 2**k``; mapped through the sources' cumulative target
shares, the point names the source the slot draws from, so every stretch of
the schedule holds each source in about its share and the whole holds it to
within one slot.  A source's documents, shuffled by a hash of their id and
repeated where the target exceeds the source, form one stream of words that is
cut into blocks of equal length; the source's n-th slot joins its n-th block.

Scale: nothing is gathered per source.  Word positions and slot ranks are
two-level prefix sums (within about sqrt(n) buckets of a source, then over the
buckets' totals); block keys are unique, so the block join has no hot key.
Only per-source totals (one row per source) meet in one window.

Defined cases: null text and word-less texts have size 0 and are never taken;
null sources form one source, ordered last; an empty table gives an empty mix;
repeated rows each take their own place in the stream; documents are carried
in a struct, so extra columns of any name are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import cut, word_count

# Fixed values of the production mix: weights of the sources in code-point
# order (repeating), words drawn in all, and the cap, both times the input.
WEIGHTS = (3, 1, 2)
VOLUME = 1.5
CAP = 2.0
#: Words of a block, and slots a source gets on average at least.
BLOCK_WORDS = 1024
SLOTS_PER_SOURCE = 256
#: Slots made by one row of the schedule's first expansion.
SLOTS_PER_ROW = 4096


def source_targets(sized: DataFrame, weights=WEIGHTS, volume: float = VOLUME, cap: float = CAP) -> DataFrame:
    """One row per source: src (its order), source, source_size, n_docs, target.

    Targets share ``volume`` times all words by weight; those above ``cap``
    times their source stop there and the rest is shared again by weight.
    With the sources ordered by cap/weight the final level is the largest of
    the levels reached by filling the sources before each one.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    return (
        totals.withColumn("src", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("spent", F.coalesce(
            F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("all", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(volume)))
        .withColumn("level", F.max((F.col("all") - F.col("spent")) / F.col("rest")).over(Window.partitionBy()))
        .withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
        .select("src", "source", "source_size", "n_docs", "target")
    )


def stream_positions(sized: DataFrame, targets: DataFrame, order: Column) -> DataFrame:
    """Adds src, source_size, target and start (the row's first word in its source's stream).

    ``order`` is a hex digest; a bucket is a range of its first 32 bits, so
    going through the buckets in order and by digest within them is one
    global order per source.
    """
    # The hash of the name keeps nulls joinable and is compared with the name itself.
    per_source = targets.select("src", F.col("source").alias("t_source"), "source_size", "target",
                                F.ceil(F.sqrt("n_docs")).alias("n_buckets"))
    placed = (
        sized.join(per_source, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
        .withColumn("digest", order)
        .withColumn("bucket", F.floor(
            F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.col("n_buckets") / F.lit(float(1 << 32))))
    )
    totals = placed.groupBy("src", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("src", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("src", "bucket").orderBy("digest", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        placed.withColumn("within", F.sum("size").over(inside) - F.col("size"))
        .join(offsets.hint("merge"), ["src", "bucket"])
        .withColumn("start", F.col("offset") + F.col("within"))
        .drop("bucket", "n_buckets", "offset", "within", "digest")
    )


def schedule(targets: DataFrame, k: int) -> DataFrame:
    """Rows (slot, src, block): every slot of the mix and the block it draws.

    A source owns the points between its cumulative shares, i.e. whole
    numbers over 2**k; reversing the bits of a point gives its slot.  A source
    too small for any point gets one closing slot.
    """
    n = 1 << k
    shares = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("target").over(Window.partitionBy())
    owned = (
        targets.where("target > 0")
        .withColumn("hi", F.round(F.sum("target").over(shares) / total * F.lit(float(n))).cast("long"))
        .withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("src")), F.lit(0).cast("long")))
    )
    rows = owned.where("hi > lo").select("src", F.explode(
        F.sequence("lo", F.col("hi") - 1, F.lit(SLOTS_PER_ROW).cast("long"))).alias("first"), "hi")
    points = rows.repartition("src", "first").select("src", F.explode(F.sequence(
        "first", F.least(F.col("hi"), F.col("first") + SLOTS_PER_ROW) - 1)).alias("point"))
    bits = F.conv(F.reverse(F.lpad(F.bin("point"), k, "0")), 2, 10).cast("long") if k else F.lit(0).cast("long")
    slots = points.select("src", bits.alias("slot")).withColumn(
        "chunk", F.shiftright("slot", (k + 1) // 2))
    counts = slots.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("src", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot"))
    ranked = slots.withColumn("rank", rank).join(offsets.hint("merge"), ["src", "chunk"]).select(
        "slot", "src", (F.col("offset") + F.col("rank") - 1).alias("block"))
    closing = owned.where("hi = lo").select(
        (F.lit(n) + F.col("src")).cast("long").alias("slot"), "src", F.lit(0).cast("long").alias("block"))
    return ranked.unionByName(closing)


def mix(rows: DataFrame, weights=WEIGHTS, volume: float = VOLUME, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """(documents with their place, draws).

    ``rows`` has doc_id, source, size.  The first frame keeps every row with
    src, source_size, target, start; the second has one row per part of a
    document in a block that a slot drew: slot, src, start (the document's),
    pass (0, 1, ... as the stream repeats), first and last (words of the
    document, end exclusive).
    """
    targets = cut(source_targets(rows, weights, volume, cap))
    scalars = targets.agg(F.sum("target"), F.count(F.lit(1))).first()
    total, n_sources = scalars[0] or 0.0, scalars[1]
    k = max(0, int(max(total / BLOCK_WORDS, SLOTS_PER_SOURCE * n_sources, 1) - 1).bit_length())
    block_words = max(1, -(-int(total) // (1 << k)))
    placed = stream_positions(rows, targets, F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))

    slots = schedule(targets, k)
    last = slots.groupBy("src").agg(F.max("block").alias("last_block"))
    n_passes = F.ceil(F.floor("target") / F.col("source_size"))
    copies = (
        placed.where("size > 0").join(last, "src")
        .select("src", "start", "size", "target", "last_block", "source_size",
                F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(n_passes - 1, F.lit(0)).cast("long"))).alias("pass"))
        .withColumn("from", F.col("pass") * F.col("source_size") + F.col("start"))
        .withColumn("to", F.least(F.col("from") + F.col("size"), F.floor("target")))
        .where(F.col("from") < F.col("to"))
    )
    block_of = lambda at: F.least(F.floor(at / block_words), F.col("last_block"))
    parts = (
        copies.withColumn("block", F.explode(F.sequence(block_of(F.col("from")), block_of(F.col("to") - 1))))
        .withColumn("lower", F.greatest(F.col("from"), F.col("block") * block_words))
        .withColumn("upper", F.when(F.col("block") == F.col("last_block"), F.col("to"))
                    .otherwise(F.least(F.col("to"), (F.col("block") + 1) * block_words)))
    )
    # The planner takes the slots for as few as the sources they grow from and would broadcast them.
    draws = parts.join(slots.hint("merge"), ["src", "block"]).select(
        "slot", "src", "start", "pass", (F.col("lower") - F.col("from")).alias("first"),
        (F.col("upper") - F.col("from")).alias("last"))
    return placed, draws


def taken_words(rows: DataFrame, **params) -> DataFrame:
    """``rows`` (doc_id, source, size, ...) with source_size, target and taken."""
    placed, draws = mix(rows, **params)
    taken = draws.groupBy("src", "start").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    # Starts are unique among documents with words; the others share one and take nothing.
    return (
        placed.withColumn("key", F.when(F.col("size") > 0, F.col("start")))
        .join(taken.withColumnRenamed("start", "key"), ["src", "key"], "left")
        .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
        .drop("key")
    )


def op1_mix(docs: DataFrame) -> DataFrame:
    """The contract's columns for all documents."""
    rows = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return taken_words(rows).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it, rounded to whole documents.

    The mix cuts a document only where a source's target ends, so rounding
    changes at most one document per source; texts stay whole.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.struct(*docs.columns).alias("row"))
    copies = F.floor((F.col("taken") + F.floor(F.col("size") / 2)) / F.col("size")).cast("int")
    return (
        taken_words(rows).where("taken > 0").withColumn("copies", copies).where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("row.*")
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), t AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), n AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS src FROM t
), w AS (
  SELECT *, CASE (src - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS cap FROM n
), f AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER (ORDER BY cap / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         sum(source_size) OVER () * 1.5::DOUBLE AS total FROM w
), l AS (SELECT *, max((total - spent) / rest) OVER () AS level FROM f
), g AS (SELECT source, source_size, least(cap, level * weight) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (greatest(least(start + size, floor(target)) - start, 0)
        + greatest(least(source_size + start + size, floor(target)) - (source_size + start), 0))::BIGINT AS taken
FROM p
"""
