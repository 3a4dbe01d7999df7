"""Adapters: the driver's TPC-H-like tables → the warehouse's landed inputs.

Each adapter is a Spark job over the whole table (no sampling, no caps), so
the work grows with the scale factor.

* tickers: ``part.p_name`` (few distinct names → repeated tickers), or
  ``part.p_partkey`` as text (one ticker per part).
* price history: ``lineitem`` per (part, ship day): high/low = max/min
  extended price, open/close = first/last by a total order, volume = summed
  quantity.
* filings: ``lineitem ⋈ orders`` as company facts: CIK = part, concept =
  return flag ‖ line status, form from the order priority, period end =
  order date, filed = ship date, value = quantity × 10⁶, document order by a
  total order within (CIK, concept).
* company→CIK entries: ``part`` (some CIKs are 11 digits), also as JSON
  objects of bounded size.
* currency pairs / FX history: ``events`` per (event type, user bucket).
* daily-shaped rows with repeated (ticker, day) keys and share-shaped rows:
  ``events`` per (user, day) and ``orders`` per (customer, order day).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import date_key, zero_pad_cik
from daybook.operators.filings import SHARE_CONCEPTS

# Date windows used with the testdata (history end is exclusive,
# filing window inclusive).
PRICE_START, PRICE_END = date(1995, 1, 1), date(2001, 12, 31)
FILING_START, FILING_END = date(1998, 1, 1), date(1999, 12, 31)
FX_START, FX_END = date(2024, 1, 1), date(2024, 12, 31)

# Concepts of the testdata filings, in order of preference, and
# the form each order priority stands for.
TESTDATA_CONCEPTS = ["AF", "AO", "NF", "NO", "RF", "RO"]
FORM_BY_PRIORITY = {"1": "10-K", "2": "10-Q", "3": "8-K", "4": "10-Q/A", "5": "S-1"}

# The same six as they are landed: the published concept names, then the two that are left.
LANDED_CONCEPTS = SHARE_CONCEPTS + TESTDATA_CONCEPTS[len(SHARE_CONCEPTS):]

# A listed pair that has no FX history.
PAIR_WITHOUT_HISTORY = ("XAU", "XAG")

# CIKs of parts divisible by this get an 11th digit.
LONG_CIK_EVERY = 7
LONG_CIK_OFFSET = 10_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One testdata table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tickers_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("ticker"))


def tickers_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("ticker"))


def _quoted(name: str) -> Column:
    return F.concat(F.lit('"'), F.replace(_text(name), F.lit('"'), F.lit('""')), F.lit('"'))


def _as_list(rows: DataFrame, file: str, header: str, line: Column) -> DataFrame:
    """``rows`` (``value``) as the lines of one CSV file with a header: ``file, line, value``."""
    spark = rows.sparkSession
    body = rows.select(F.lit(file).alias("file"), line.cast("long").alias("line"), "value")
    return body.unionByName(spark.range(1, numPartitions=1).select(
        F.lit(file).alias("file"), F.lit(0).cast("long").alias("line"), F.lit(header).alias("value")))


def ticker_list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of the parts as lines of a ticker list with another column in front."""
    part = table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").alias("n"), F.concat_ws(",", _text("p_partkey"), _quoted("p_name")).alias("value"))
    return _as_list(rows, "tickers.csv", "no,ticker", F.col("n") + 1)


def pair_list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The currency pairs as lines of a pair list whose two columns are swapped."""
    rows = currency_pairs_frame(spark, sf_dir).select(
        F.concat_ws(",", _quoted("transaction_currency"), _quoted("currency")).alias("value"))
    return _as_list(rows, "currency_pairs.csv", "transaction_currency,currency", F.lit(1))


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ticker, day, open, high, low, close, volume`` from ``lineitem``.

    Grouped on the numeric part key (cheaper to sort and shuffle than its
    text form); the ticker text is made after the aggregate.  Few lines share a
    (part, ship day): they are dealt by it as they are, which saves sorting them
    for partial aggregates that are hardly fewer and twice as wide.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    order = F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return (
        li.repartition("l_partkey", "day").groupBy("l_partkey", "day")
        .agg(
            F.min_by("l_extendedprice", order).alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max_by("l_extendedprice", order).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
        .select(
            F.col("l_partkey").cast("string").alias("ticker"),
            "day", "open", "high", "low", "close", "volume",
        )
    )


def _form(priority):
    expr = F.lit(None).cast("string")
    for digit, form in FORM_BY_PRIORITY.items():
        expr = F.when(F.substring(priority, 1, 1) == digit, F.lit(form)).otherwise(expr)
    return expr


# Columns that order the entries of one (CIK, concept), i.e. its document order.
DOCUMENT_ORDER = ["o_orderdate", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


def _concept() -> Column:
    return F.concat("l_returnflag", "l_linestatus").alias("concept")


def _filing_rows(spark: SparkSession, sf_dir: str, *kind: str | Column) -> DataFrame:
    """``lineitem ⋈ orders``; ``kind`` is what of the flag and status goes through the join."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", *kind, "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return li.join(orders, li["l_orderkey"] == orders["o_orderkey"])


def _as_facts(rows: DataFrame, concept: str | Column, pos: Column) -> DataFrame:
    return rows.select(
        zero_pad_cik(F.col("l_partkey")).alias("cik"),
        concept,
        pos.alias("pos"),
        _form(F.col("o_orderpriority")).alias("form"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("end"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("filed"),
        (F.col("l_quantity") * F.lit(1e6)).cast("string").alias("val"),
    )


def filing_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat company facts ``cik, concept, pos, form, end, filed, val``.

    ``pos`` (document order) is the struct of the ordering columns: the
    selection only compares positions, so no sort has to number the rows.
    The concept is made ahead of the join, which then moves one text less a line.
    """
    return _as_facts(_filing_rows(spark, sf_dir, _concept()), "concept", F.struct(*DOCUMENT_ORDER))


def numbered_filing_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filing_facts`` with ``pos`` as a number, for writing documents.

    A global sort on (part, flag, status, order columns) followed by
    ``monotonically_increasing_id``: it range-partitions on all those
    columns, so one company with a huge history is still spread over many
    tasks (a window per (CIK, concept) would put it in one).
    """
    ordered = _filing_rows(spark, sf_dir, "l_returnflag", "l_linestatus").orderBy("l_partkey", "l_returnflag", "l_linestatus", *DOCUMENT_ORDER)
    return _as_facts(ordered, _concept(), F.monotonically_increasing_id())


# Most entries one written company-facts document may hold.
DOC_CHUNK = 1000


def facts_documents(flat: DataFrame, chunk: int = DOC_CHUNK) -> DataFrame:
    """Regroup flat facts into company-facts JSON documents (one text column).

    Shape: ``{"cik": n, "offset": k, "facts": {"us-gaap": {concept:
    {"units": {"shares": [...]}}}}}``.  A document holds one concept and at
    most ``chunk`` entries in ``pos`` order; ``offset`` orders the documents
    of one (CIK, concept), so no company history is gathered into one row.
    Used to exercise the JSON reading path.
    """
    bucket = F.floor(F.col("pos") / F.lit(chunk))
    per_chunk = flat.groupBy("cik", "concept", bucket.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "form", "end", "filed", "val"))).alias("es")
    )
    entries = F.transform("es", lambda e: e.dropFields("pos"))
    concept_map = F.create_map(
        F.col("concept"), F.struct(F.create_map(F.lit("shares"), entries).alias("units"))
    )
    doc = F.struct(
        F.col("cik").cast("long").alias("cik"),
        (F.col("chunk") * F.lit(chunk)).cast("long").alias("offset"),
        F.create_map(F.lit("us-gaap"), concept_map).alias("facts"),
    )
    return per_chunk.select(F.to_json(doc).alias("value"))


def cik_entries_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company→CIK entries ``pos, ticker, cik_str``: names repeat, last wins."""
    part = table(spark, sf_dir, "part")
    long_cik = F.when(F.col("p_partkey") % LONG_CIK_EVERY == 0, F.lit(LONG_CIK_OFFSET)).otherwise(F.lit(0))
    return part.select(
        F.col("p_partkey").alias("pos"),
        F.col("p_name").alias("ticker"),
        (F.col("p_partkey") + long_cik).alias("cik_str"),
    )


def cik_documents(entries: DataFrame, chunk: int = DOC_CHUNK) -> DataFrame:
    """Company→CIK entries as JSON objects of at most ``chunk`` entries each.

    Columns ``value`` (the object text) and ``part`` (zero-padded chunk
    number): written with ``partitionBy("part")`` every object lands in its
    own file, and path order is document order.
    """
    part = F.lpad(F.floor(F.col("pos") / F.lit(chunk)).cast("string"), 12, "0")
    grouped = entries.groupBy(part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "ticker", "cik_str"))).alias("es")
    )
    obj = F.map_from_entries(F.transform("es", lambda e: F.struct(
        e["pos"].cast("string"),
        F.struct(e["cik_str"].alias("cik_str"), e["ticker"].alias("ticker"), F.lit("").alias("title")),
    )))
    return grouped.select(F.to_json(obj).alias("value"), "part")


def cik_entries_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company→CIK entries for part-key tickers (CIK = part key)."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("pos"),
        F.col("p_partkey").cast("string").alias("ticker"),
        F.col("p_partkey").alias("cik_str"),
    )


def _fx_keys(ev: DataFrame):
    bucket = F.concat(F.lit("U"), (F.col("user_id") % 5).cast("string"))
    return F.col("event_type"), bucket


def currency_pairs_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (event type, user bucket) pairs plus one pair without history."""
    ev = table(spark, sf_dir, "events")
    cur, txn = _fx_keys(ev)
    pairs = ev.select(cur.alias("currency"), txn.alias("transaction_currency")).distinct()
    extra = spark.range(1).select(
        F.lit(PAIR_WITHOUT_HISTORY[0]).alias("currency"),
        F.lit(PAIR_WITHOUT_HISTORY[1]).alias("transaction_currency"),
    )
    return pairs.unionByName(extra)


def event_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lo, hi``: first and last day of the calendar years that ``events`` covers."""
    return table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(
        F.make_date(F.year("a"), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.year("b"), F.lit(12), F.lit(31)).alias("hi"),
    )


def tickers_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ticker list in which every part of an even size is listed twice."""
    part = table(spark, sf_dir, "part")
    times = F.when(F.col("p_size") % 2 == 0, F.lit(2)).otherwise(F.lit(1))
    return part.select(F.col("p_partkey").cast("string").alias("ticker"), F.explode(F.sequence(F.lit(1), times)).alias("n")).select("ticker")


def fx_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``symbol, day, close``: the last event value per symbol and day."""
    ev = table(spark, sf_dir, "events")
    cur, txn = _fx_keys(ev)
    return ev.groupBy(
        F.concat(cur, txn, F.lit("=X")).alias("symbol"),
        F.to_date("ts").alias("day"),
    ).agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


# The column orders of the testdata's price files, by part key modulo three.
PRICE_FILE_HEADERS = [
    "Date,Open,High,Low,Close,Volume",
    "Volume,Close,Low,High,Open,Date",
    '"Adj ""Close""",Close,Date,"Open",Volume,High,Low',
]


def price_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``price_history`` as the lines of one CSV file per part, in three column orders: ``file, line, value``."""
    history = price_history(spark, sf_dir)
    day = F.date_format("day", "yyyy-MM-dd")
    o, h, low, c, v = (_text(n) for n in ("open", "high", "low", "close", "volume"))
    orders = [F.concat_ws(",", day, o, h, low, c, v), F.concat_ws(",", v, c, low, h, o, day),
              F.concat_ws(",", F.lit('"a,""b"""'), c, F.concat(F.lit('"'), day, F.lit(' 00:00:00-05:00"')), o, v, h, low)]

    def by_part(key: Column, choices: list) -> Column:
        kind = key.cast("long") % 3
        return F.when(kind == 0, choices[0]).when(kind == 1, choices[1]).otherwise(choices[2])

    rows = history.select(F.concat("ticker", F.lit(".csv")).alias("file"), date_key("day").cast("long").alias("line"),
                          by_part(F.col("ticker"), orders).alias("value"))
    key = F.col("p_partkey")
    headers = table(spark, sf_dir, "part").select(F.concat(key.cast("string"), F.lit(".csv")).alias("file"), F.lit(0).cast("long").alias("line"),
                                                  by_part(key, [F.lit(x) for x in PRICE_FILE_HEADERS]).alias("value"))
    return rows.unionByName(headers)


# Days of the month whose FX lines are damaged, and the line each gets.
DAMAGED_FX_LINES = {13: "2024-01-13,n/a", 17: "soon,1.5", 21: "2024-01-21"}
# Files of this user bucket have no usable header, and what their lines say.
HEADERLESS_BUCKET, HEADERLESS_LINE = "U4", "2024-01-02,7"


def fx_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_history`` as the lines of one CSV file per symbol, some damaged: ``file, line, value``.

    Symbols whose event type has an even length list the rate first; files of bucket
    U4 have a header without ``Close``.
    """
    history = fx_history(spark, sf_dir)
    turned = F.length("symbol") % 2 == 0
    lost = F.contains("symbol", F.lit(f"{HEADERLESS_BUCKET}=X"))
    file = F.concat("symbol", F.lit(".csv"))
    day = F.date_format("day", "yyyy-MM-dd")
    value = F.when(turned, F.concat_ws(",", _text("close"), day)).otherwise(F.concat_ws(",", day, _text("close")))
    for number, line in DAMAGED_FX_LINES.items():
        first, _, rest = line.partition(",")
        swapped = f"{rest},{first}" if rest else line
        value = F.when(F.dayofmonth("day") == number, F.when(turned, F.lit(swapped)).otherwise(F.lit(line))).otherwise(value)
    rows = history.select(file.alias("file"), date_key("day").cast("long").alias("line"), F.when(lost, F.lit(HEADERLESS_LINE)).otherwise(value).alias("value"))
    header = F.when(lost, F.lit("Date,Last")).when(turned, F.lit("Close,Date")).otherwise(F.lit("Date,Close"))
    headers = history.select("symbol").distinct().select(file.alias("file"), F.lit(0).cast("long").alias("line"), header.alias("value"))
    return rows.unionByName(headers)


def event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily-table-shaped quotes from ``events``: many rows per (user, day).

    ticker = ``U<user_id>``, source = event type, every price = value,
    volume = event id.  Used to exercise the one-row-per-ticker-day rule.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        F.col("event_type").alias("source"),
        date_key("ts").alias("date_key"),
        F.col("value").alias("stock_open"),
        F.col("value").alias("stock_high"),
        F.col("value").alias("stock_low"),
        F.col("value").alias("stock_close"),
        F.col("event_id").alias("volume"),
    )


def event_signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares-table-shaped rows from ``signup`` events: one per (user, day)."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    return ev.groupBy(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        zero_pad_cik(F.col("user_id")).alias("cik"),
        date_key("ts").alias("date_key"),
    ).agg(F.count(F.lit(1)).alias("shares_outstanding"))


# The ticker of the events that share one, and how many kinds of user do.
SHARED_TICKER, SHARED_OF = "EVERY", 2


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ticker, ts, event_id, event_type, value``: events as ticks, half of the users' under one ticker."""
    ev = table(spark, sf_dir, "events")
    ticker = F.when(F.col("user_id") % SHARED_OF == 0, F.lit(SHARED_TICKER)).otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string")))
    return ev.select(ticker.alias("ticker"), "ts", "event_id", "event_type", "value")


def order_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily-table-shaped rows from ``orders``: ticker = ``C<custkey>``, one row
    per order (a customer can order twice a day), price = total price."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
        F.col("o_orderpriority").alias("source"),
        date_key("o_orderdate").alias("date_key"),
        F.col("o_totalprice").alias("stock_open"),
        F.col("o_totalprice").alias("stock_high"),
        F.col("o_totalprice").alias("stock_low"),
        F.col("o_totalprice").alias("stock_close"),
        F.col("o_orderkey").alias("volume"),
    )


def finished_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares-table-shaped rows: finished orders per (customer, day)."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return o.groupBy(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
        zero_pad_cik(F.col("o_custkey")).alias("cik"),
        date_key("o_orderdate").alias("date_key"),
    ).agg(F.count(F.lit(1)).alias("shares_outstanding"))


def land_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Land the testdata in ``root`` in the landing layout read by ``build_all``.

    Ticker and pair CSVs, company→CIK JSON objects, company facts as JSON
    Lines (all six testdata concepts, under the names of ``LANDED_CONCEPTS``:
    build with those), and Parquet price / FX histories.
    """
    mapping = F.create_map(*[x for pair in zip(TESTDATA_CONCEPTS, LANDED_CONCEPTS) for x in (F.lit(pair[0]), F.lit(pair[1]))])
    facts = numbered_filing_facts(spark, sf_dir).withColumn("concept", mapping[F.col("concept")])
    tickers_by_part(spark, sf_dir).coalesce(1).write.option("header", True).csv(
        f"{root}/tickers.csv")
    currency_pairs_frame(spark, sf_dir).coalesce(1).write.option("header", True).csv(
        f"{root}/currency_pairs.csv")
    cik_documents(cik_entries_by_part(spark, sf_dir)).write.partitionBy("part").text(
        f"{root}/company_tickers.json")
    facts_documents(facts).write.text(f"{root}/companyfacts")
    price_history(spark, sf_dir).write.parquet(f"{root}/prices")
    fx_history(spark, sf_dir).write.parquet(f"{root}/fx")
