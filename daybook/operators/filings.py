"""Shares outstanding chosen from company filings (T5).

Per company document:

1. **Concept choice.**  Of an ordered list of share-count concepts, take the
   first whose entries include any ``10-Q``; if none does, the first whose
   entries include any ``10-K``; else the company yields nothing.  The test
   runs over all entries of the concept, whatever their dates or values.
2. **Row filters** on the chosen concept: form ``10-Q`` or ``10-K``; ``end``
   present and parsable; ``filed`` missing/empty → 0, unparsable → dropped;
   ``val`` present.  Periods after ``end`` are dropped.
3. **Latest filing per period** in ``[start, end]``: the largest filing key,
   ties to the first entry in document order.
4. **Pre-start anchor**: of the periods before ``start`` keep exactly one,
   the largest (period, filing key), ties to the first entry; it keeps its own
   early ``date_key`` so the as-of join has a value from day one.

Plan: one partial (map-side) aggregate over ``(cik, concept, period-or-0)``
computes, for every concept, the best row of each period by a ``min`` on a
struct ordered as the rule wants, plus whether the group holds a 10-Q or a
10-K; a company with a huge history is reduced before the shuffle, and the
facts are read once.  The concept choice is a window per CIK over that
small result.  The ticker→CIK list is joined last, which keeps the list's
multiplicity and serves two tickers of one CIK from one computation.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import filed_key, iso_key, truncate_to_long

# The us-gaap share-count concepts, in order of preference.
SHARE_CONCEPTS = [
    "CommonStockSharesOutstanding",
    "CommonStockSharesIssued",
    "SharesOutstanding",
    "WeightedAverageNumberOfSharesOutstandingBasic",
]

# The periodic report forms whose figures are used.
QUARTERLY_FORM = "10-Q"
ANNUAL_FORM = "10-K"


def _key(d: date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def filing_periods(
    facts: DataFrame,
    start: date,
    end: date,
    concepts: list[str] = SHARE_CONCEPTS,
) -> DataFrame:
    """One pass over the facts: ``cik, prio, g, b, q, k`` per period group.

    ``prio`` is the 1-based concept index; ``g`` the period (0 for all
    pre-start periods, NULL for rows that fail a row filter); ``b`` the best
    valid row of the group as ``struct(neg_dk, neg_fk, pos, shares)``, whose
    minimum is what the rule wants (largest period, then filing key, first in
    document order; ``pos`` is any orderable type, a struct included); ``q`` /
    ``k`` whether the group holds any 10-Q / 10-K.  Only 10-Q and 10-K rows
    can affect either the concept choice or the selection, so the rest are
    dropped at the scan.  A partial (map-side) aggregate.
    """
    start_key, end_key = _key(start), _key(end)
    prio = F.array_position(F.array(*[F.lit(c) for c in concepts]), F.col("concept"))
    rows = facts.where(F.col("form").isin(QUARTERLY_FORM, ANNUAL_FORM)).select(
        "cik",
        "form",
        prio.alias("prio"),
        iso_key("end").alias("dk"),
        filed_key("filed").alias("fk"),
        "pos",
        truncate_to_long("val").alias("shares"),
    ).where(F.col("prio") > 0)
    valid = (
        F.col("dk").isNotNull()
        & F.col("fk").isNotNull()
        & F.col("shares").isNotNull()
        & (F.col("dk") <= end_key)
    )
    # Periods up to ``end`` fit an int; only comparing them takes the wide key.
    day = F.col("dk").try_cast("int")
    group = F.when(valid, F.when(F.col("dk") < start_key, F.lit(0)).otherwise(day))
    return rows.groupBy("cik", "prio", group.alias("g")).agg(
        F.min(F.when(valid, F.struct(
            (-day).alias("neg_dk"), (-F.col("fk")).alias("neg_fk"), "pos", "shares"))).alias("b"),
        F.bool_or(F.col("form") == QUARTERLY_FORM).alias("q"),
        F.bool_or(F.col("form") == ANNUAL_FORM).alias("k"),
    )


def select_filings(
    facts: DataFrame,
    start: date,
    end: date,
    concepts: list[str] = SHARE_CONCEPTS,
) -> DataFrame:
    """``cik, date_key, shares_outstanding`` from flat company facts.

    ``facts`` has ``cik, concept, pos, form, end, filed, val``.  The facts
    are aggregated once (``filing_periods``); the concept choice is a window
    per CIK over those aggregated groups (one row per concept and period, so
    bounded by concepts × periods, never by the number of filings).
    """
    # What told the best row from the others stays behind: the window moves a few numbers a period.
    periods = filing_periods(facts, start, end, concepts).select(
        "cik", "prio", "q", "k", (-F.col("b.neg_dk")).alias("date_key"), F.col("b.shares").alias("shares_outstanding")
    )
    per_cik = Window.partitionBy("cik")
    chosen = F.coalesce(
        F.min(F.when(F.col("q"), F.col("prio"))).over(per_cik),
        F.min(F.when(F.col("k"), F.col("prio"))).over(per_cik),
    )
    picked = periods.withColumn("chosen", chosen).where(
        (F.col("prio") == F.col("chosen")) & F.col("date_key").isNotNull()
    )
    return picked.select("cik", "date_key", "shares_outstanding")


def shares_outstanding(
    facts: DataFrame,
    tickers: DataFrame,
    ciks: DataFrame,
    start: date,
    end: date,
    concepts: list[str] = SHARE_CONCEPTS,
) -> DataFrame:
    """T5 ``ticker, cik, date_key, shares_outstanding``.

    ``tickers``: the ticker list (``ticker``, duplicates kept);
    ``ciks``: ``ticker, cik``, one row per ticker (see ``dims.cik_map``).
    Unknown tickers are skipped; matching is case-sensitive.
    """
    listed = tickers.select("ticker").join(ciks.select("ticker", "cik"), "ticker")
    selected = select_filings(facts, start, end, concepts)
    return listed.join(selected, "cik").select(
        "ticker", "cik", "date_key", "shares_outstanding"
    )
