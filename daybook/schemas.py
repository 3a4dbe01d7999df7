"""Table contracts (T1–T7) and the schemas of landed inputs.

Column order is part of each contract.  Non-null flags are a contract to
check (``check_contract``); Spark does not enforce them on files, and they
are lost on a Parquet round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

DATE_TABLE = StructType([
    StructField("date_key", IntegerType(), False),
    StructField("day_of_week", StringType(), False),
    StructField("nasdaq_open", BooleanType(), False),
])

ASSET_TABLE = StructType([
    StructField("asset_id", LongType(), False),
    StructField("ticker", StringType(), True),
    StructField("asset_class", StringType(), False),
])

CURRENCY_PAIRS_TABLE = StructType([
    StructField("currency", StringType(), False),
    StructField("transaction_currency", StringType(), False),
])

DAILY_TABLE = StructType([
    StructField("ticker", StringType(), False),
    StructField("source", StringType(), False),
    StructField("date_key", IntegerType(), False),
    StructField("stock_open", DoubleType(), False),
    StructField("stock_high", DoubleType(), False),
    StructField("stock_low", DoubleType(), False),
    StructField("stock_close", DoubleType(), False),
    StructField("volume", LongType(), False),
])

SHARES_TABLE = StructType([
    StructField("ticker", StringType(), False),
    StructField("cik", StringType(), False),
    StructField("date_key", IntegerType(), False),
    StructField("shares_outstanding", LongType(), False),
])

DAILY_CURRENCY_TABLE = StructType([
    StructField("currency", StringType(), False),
    StructField("transaction_currency", StringType(), False),
    StructField("date_key", IntegerType(), False),
    StructField("currency_unit", DoubleType(), False),
    StructField("transaction_currency_rate", DoubleType(), False),
])

EQUITY_EXTENDED_TABLE = StructType(
    list(DAILY_TABLE.fields)
    + [
        StructField("edgar_shares_outstanding", LongType(), True),
        StructField("market_cap", DoubleType(), True),
        StructField("edgar_10q_date_key", IntegerType(), True),
        StructField("edgar_cik", StringType(), True),
    ]
)

# Lines of FX files that could not be used, and why.
FX_REJECTS = StructType([
    StructField("file", StringType(), False),
    StructField("value", StringType(), False),
    StructField("reason", StringType(), False),
])

# ---- landed inputs -------------------------------------------------------

# Price history as landed by an extract job: one row per ticker and day.
PRICE_HISTORY = StructType([
    StructField("ticker", StringType(), True),
    StructField("day", DateType(), True),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("volume", DoubleType(), True),
])

# FX history: one closing rate per symbol (e.g. ``USDJPY=X``) and day.
FX_HISTORY = StructType([
    StructField("symbol", StringType(), True),
    StructField("day", DateType(), True),
    StructField("close", DoubleType(), True),
])

# One company→CIK document: an object keyed "0", "1", ... in document order.
# ``cik_str`` is read as text, so a number and a quoted number both work.
CIK_ENTRY_DDL = "struct<cik_str:string,ticker:string,title:string>"
CIK_DOCUMENT_DDL = f"map<string,{CIK_ENTRY_DDL}>"

# One company-facts document.  ``val`` is read as text so that fractional
# values truncate instead of turning NULL (see ``truncate_to_long``).
FACT_ENTRY = StructType([
    StructField("form", StringType(), True),
    StructField("end", StringType(), True),
    StructField("filed", StringType(), True),
    StructField("val", StringType(), True),
])
COMPANY_FACTS = StructType([
    StructField("cik", LongType(), True),
    StructField("entityName", StringType(), True),
    # Position of this document's first entry when a company's entries are
    # split over several documents (absent in single-document sources → 0).
    StructField("offset", LongType(), True),
    StructField(
        "facts",
        MapType(
            StringType(),
            MapType(
                StringType(),
                StructType([
                    StructField("units", MapType(StringType(), ArrayType(FACT_ENTRY)), True),
                ]),
            ),
        ),
        True,
    ),
])

def company_facts_schema(concepts: list[str], taxonomy: str = "us-gaap", unit: str = "shares") -> StructType:
    """Read schema holding only ``facts.<taxonomy>.<concept>.units.<unit>`` for
    the given concepts: the JSON parser skips every other concept and unit
    (most of a real document) instead of materializing them."""
    entries = ArrayType(FACT_ENTRY)
    concept = StructType([StructField("units", StructType([StructField(unit, entries, True)]), True)])
    return StructType([
        StructField("cik", LongType(), True),
        StructField("entityName", StringType(), True),
        StructField("offset", LongType(), True),
        StructField("facts", StructType([
            StructField(taxonomy, StructType([StructField(c, concept, True) for c in concepts]), True),
        ]), True),
    ])


# The flat form of company facts every selection operator works on.
FACT_ROWS = StructType([
    StructField("cik", StringType(), True),
    StructField("concept", StringType(), True),
    StructField("pos", LongType(), True),
    StructField("form", StringType(), True),
    StructField("end", StringType(), True),
    StructField("filed", StringType(), True),
    StructField("val", StringType(), True),
])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema``'s column order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def check_contract(df: DataFrame, schema: StructType) -> list[str]:
    """Static check of names and types (no Spark job).  Returns problems."""
    problems = []
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if [n for n, _ in got] != [n for n, _ in want]:
        problems.append(f"columns {[n for n, _ in got]} != {[n for n, _ in want]}")
    for (n, t), (_, wt) in zip(got, want):
        if t != wt:
            problems.append(f"{n}: {t.simpleString()} != {wt.simpleString()}")
    return problems


def contract_null_rows(schema: StructType):
    """Column: a row holds a NULL in a column the contract declares non-null
    (None when the contract has no such column)."""
    required = [F.col(f.name).isNull() for f in schema.fields if not f.nullable]
    if not required:
        return None
    any_null = required[0]
    for c in required[1:]:
        any_null = any_null | c
    return any_null


def null_violations(df: DataFrame, schema: StructType) -> DataFrame:
    """One-row frame counting NULLs in columns the contract declares non-null."""
    required = [f.name for f in schema.fields if not f.nullable]
    return df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in required])
