"""Readers for landed files (the inputs the extract side drops off).

The upstream sites are not called from Spark: a price/FX/filing extract lands
files, and these readers turn them into typed DataFrames.  Everything is read
by ``spark.read`` so the scan is split across tasks, filters and column
selection reach the file scan, and nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import zero_pad_cik
from daybook.operators.filings import SHARE_CONCEPTS
from daybook.schemas import (
    CIK_DOCUMENT_DDL,
    CIK_ENTRY_DDL,
    COMPANY_FACTS,
    CURRENCY_PAIRS_TABLE,
    FX_HISTORY,
    PRICE_HISTORY,
    company_facts_schema,
)
from daybook.sources.csv_files import accepted_fx, csv_lines, fx_lines, price_history_of_lines

# The taxonomy and unit whose share counts are read.
FACTS_TAXONOMY = "us-gaap"
SHARES_UNIT = "shares"


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Ticker list CSV with a ``ticker`` header; other columns are ignored.

    The column is selected by name (all text, no schema), so ``007`` or ``NA``
    stay tickers and a file with extra columns still reads.  Duplicates are
    kept: a ticker listed twice yields its rows twice downstream.
    """
    return spark.read.csv(path, header=True).select("ticker")


def read_currency_pairs(spark: SparkSession, path: str, strict_header: bool = True) -> DataFrame:
    """Currency-pair CSV: ``currency, transaction_currency`` (header).

    Columns bind by position.  With ``strict_header`` the header names must
    match the schema, so a swapped header fails instead of silently swapping
    the two columns.
    """
    return spark.read.csv(
        path, header=True, schema=CURRENCY_PAIRS_TABLE, enforceSchema=not strict_header
    )


# A company→CIK entry up to its closing brace: what opens or separates entries, the key, the body.
_ENTRY = r'^[\s\uFEFF]*[{,]\s*"(?:[^"\\]|\\.)*"\s*:\s*(\{[\s\S]*)$'
_UNESCAPED_QUOTE = r'(?<!\\)(?:\\\\)*"'


def read_cik_document(spark: SparkSession, path: str) -> DataFrame:
    """Company→CIK document(s): JSON objects ``{"0": {cik_str, ticker, title}, ...}``.

    Returns ``doc, pos, ticker, cik_str, title``: ``doc`` is the file path and
    ``pos`` the place in that file's object, so (``doc``, ``pos``) is the
    document order and a ticker listed twice resolves "last one wins".

    One object is a single JSON value, but its entries are flat: the file is read as
    text that ends at each closing brace, so Spark cuts a large mapping into
    byte ranges and many tasks parse it; an entry's place is the range it starts in
    and its row there.  A first pass over the pieces finds documents that are not
    closed (refused, rather than read as far as they go) and braces inside texts,
    for which every document is parsed whole, by one task a file.  A damaged
    entry fails the read.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("doc"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")).alias("pos"), "value")
    marked = pieces.select("doc", F.col("value").rlike(r"^[\s\uFEFF{]*$").alias("closing"),
                           (F.regexp_count("value", F.lit(_UNESCAPED_QUOTE)) % 2).alias("odd"))
    state = marked.groupBy("doc").agg(F.bool_or("closing").alias("closed"), F.sum("odd").alias("cut")).agg(
        F.min(F.when(~F.col("closed") & (F.col("cut") == 0), F.col("doc"))).alias("open"), F.coalesce(F.sum("cut"), F.lit(0)).alias("cut")).first()
    if state["open"] is not None:
        raise ValueError(f"malformed company→CIK document (not closed): {state['open']}")
    if state["cut"]:
        return flatten_cik_documents(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc"), "value"))
    body = F.regexp_extract("value", _ENTRY, 1)
    text = F.when(body != "", F.concat(body, F.lit("}"))).otherwise(
        F.raise_error(F.concat(F.lit("malformed company→CIK entry in "), "doc", F.lit(": "), F.substring("value", 1, 200))))
    entries = pieces.where(~F.col("value").rlike(r"^[\s\uFEFF{]*$")).select(
        "doc", "pos", F.from_json(text, CIK_ENTRY_DDL, {"mode": "FAILFAST"}).alias("e"))
    return entries.select("doc", "pos", "e.ticker", "e.cik_str", "e.title")


def flatten_cik_documents(docs: DataFrame) -> DataFrame:
    """Company→CIK documents as text (``doc, value``) → one row per entry (see ``read_cik_document``; ``pos`` is a number)."""
    entries = docs.select(
        "doc", F.posexplode(F.map_values(F.from_json("value", CIK_DOCUMENT_DDL, {"mode": "FAILFAST"})))
    )
    return entries.select(
        "doc",
        F.col("pos").cast("long").alias("pos"),
        F.col("col.ticker").alias("ticker"),
        F.col("col.cik_str").alias("cik_str"),
        F.col("col.title").alias("title"),
    )


def flatten_company_facts(docs: DataFrame, concepts: list[str] | None = None) -> DataFrame:
    """Company-facts documents → one row per share-count entry.

    Output: ``cik`` (10-digit text), ``concept``, ``pos`` (index within the
    concept's entry list, i.e. document order, plus the document's
    ``offset`` when one company's entries span several documents),
    ``form, end, filed, val``.  A missing taxonomy, concept or unit yields
    no rows.  ``docs`` is read either with ``COMPANY_FACTS`` (concepts as a
    map; ``concepts`` None) or with ``company_facts_schema(concepts)``.
    """
    offset = F.coalesce(F.col("offset"), F.lit(0)) if "offset" in docs.columns else F.lit(0)
    taxonomy = F.col("facts").getField(FACTS_TAXONOMY)
    if concepts is None:
        concept_rows = docs.select(
            F.col("cik"), offset.cast("long").alias("offset"),
            F.explode(taxonomy).alias("concept", "body"),
        ).select("cik", "offset", "concept", F.col("body.units")[SHARES_UNIT].alias("entries"))
    else:
        listed = F.array(*[
            F.struct(F.lit(c).alias("concept"),
                     taxonomy.getField(c).getField("units").getField(SHARES_UNIT).alias("entries"))
            for c in concepts
        ])
        concept_rows = docs.select(
            F.col("cik"), offset.cast("long").alias("offset"), F.explode(listed).alias("c")
        ).select("cik", "offset", "c.concept", "c.entries")
    entries = concept_rows.select(
        "cik", "offset", "concept", F.posexplode("entries").alias("pos", "e"),
    )
    return entries.select(
        zero_pad_cik(F.col("cik")).alias("cik"),
        "concept",
        (F.col("offset") + F.col("pos")).alias("pos"),
        F.col("e.form").alias("form"),
        F.col("e.end").alias("end"),
        F.col("e.filed").alias("filed"),
        F.col("e.val").alias("val"),
    )


def parse_company_facts(docs: DataFrame, concepts: list[str] = SHARE_CONCEPTS) -> DataFrame:
    """Company-facts documents as JSON text (``value``) → one row per share-count entry."""
    schema = company_facts_schema(concepts, FACTS_TAXONOMY, SHARES_UNIT)
    return flatten_company_facts(docs.select(F.from_json("value", schema).alias("d")).select("d.*"), concepts)


def read_company_facts(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    concepts: list[str] | None = SHARE_CONCEPTS,
) -> DataFrame:
    """Read company-facts JSON (one document per file, or JSON Lines).

    Only the share counts of ``concepts`` are parsed (``None`` reads every
    concept of the taxonomy as a map).  The CIK comes from the document's
    ``cik`` field, or failing that from a ``CIK##########`` file name.  For
    very many small files, convert once to JSON Lines or Parquet of the
    flattened rows.
    """
    if concepts is None:
        schema = COMPANY_FACTS
    else:
        schema = company_facts_schema(concepts, FACTS_TAXONOMY, SHARES_UNIT)
    docs = spark.read.schema(schema).json(path, multiLine=multi_line)
    from_name = F.regexp_extract(F.col("_metadata.file_path"), r"CIK(\d+)", 1)
    docs = docs.withColumn(
        "cik",
        F.coalesce(F.col("cik").cast("string"), F.when(from_name != "", from_name)),
    )
    return flatten_company_facts(docs, concepts)


def read_price_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed price history: ``ticker, day, open, high, low, close, volume``."""
    reader = spark.read.format(fmt)
    if fmt != "parquet":
        reader = reader.schema(PRICE_HISTORY).option("header", True)
    return reader.load(path).select(*[f.name for f in PRICE_HISTORY.fields])


def read_fx_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed FX history: ``symbol, day, close``."""
    reader = spark.read.format(fmt)
    if fmt != "parquet":
        reader = reader.schema(FX_HISTORY).option("header", True)
    return reader.load(path).select(*[f.name for f in FX_HISTORY.fields])


def read_price_history_csv_per_ticker(spark: SparkSession, path: str) -> DataFrame:
    """Price history landed as one CSV per ticker (file ``<TICKER>.csv``).

    Header ``Date,Open,High,Low,Close,Volume[,...]`` in any order, each file
    its own; extra columns are ignored.  Returns the ``PRICE_HISTORY`` shape
    (see ``csv_files.price_history_of_lines``).
    """
    return price_history_of_lines(csv_lines(spark, path))


def read_fx_history_csv_per_symbol(spark: SparkSession, path: str) -> DataFrame:
    """FX history landed as one CSV per symbol (file ``<SYMBOL>.csv``, e.g.
    ``USDJPY=X.csv``) with ``Date`` and ``Close``, each file by its own
    header.  Returns ``FX_HISTORY``.

    Lines whose day or rate is missing or unreadable are left out, so that one
    bad line or pair does not fail the others; ``csv_files.fx_lines`` has them
    with the reason.
    """
    return accepted_fx(fx_lines(csv_lines(spark, path)))
