import os
import random
import tempfile
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daybook.operators import asset_dimension, daily_fx, daily_prices, dense_index
from daybook.schemas import FX_HISTORY, PRICE_HISTORY
from daybook.sources import read_currency_pairs, read_tickers


def _csv(text):
    d = tempfile.mkdtemp(prefix="csv-")
    with open(os.path.join(d, "f.csv"), "w") as fh:
        fh.write(text)
    return d


def test_asset_table(spark):
    df = asset_dimension(read_tickers(spark, _csv("ticker\nAAPL\nNVDA\nGME\n")))
    assert df.columns == ["asset_id", "ticker", "asset_class"]
    rows = sorted(df.collect())
    assert [(r.asset_id, r.ticker, r.asset_class) for r in rows] == [
        (0, "AAPL", "equity"), (1, "GME", "equity"), (2, "NVDA", "equity")]


def test_tickers_by_name_with_extra_columns(spark):
    df = read_tickers(spark, _csv("name,ticker\nApple,AAPL\nX,007\n"))
    assert sorted(r.ticker for r in df.collect()) == ["007", "AAPL"]


def test_dense_index_matches_row_number_under_skew(spark):
    rng = random.Random(3)
    values = ["HOT"] * 3000 + [f"T{rng.randint(0, 500):04d}" for _ in range(6000)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "ticker string").repartition(7)
    got = dense_index(df, ["ticker"], "asset_id", partitions=8)
    ids = [r.asset_id for r in got.collect()]
    assert sorted(ids) == list(range(len(values)))
    expected = df.select("ticker", (F.row_number().over(Window.orderBy(F.col("ticker").asc_nulls_first())) - 1)
                         .alias("asset_id"))
    assert sorted((r.ticker or "", r.asset_id) for r in got.collect()) == \
        sorted((r.ticker or "", r.asset_id) for r in expected.collect())


def test_currency_pairs_csv(spark):
    df = read_currency_pairs(spark, _csv("currency,transaction_currency\nUSD,JPY\nEUR,USD\nGBP,EUR\n"))
    assert df.columns == ["currency", "transaction_currency"]
    assert sorted(tuple(r) for r in df.collect()) == [("EUR", "USD"), ("GBP", "EUR"), ("USD", "JPY")]


def test_currency_pairs_swapped_header_fails(spark):
    df = read_currency_pairs(spark, _csv("transaction_currency,currency\nJPY,USD\n"))
    with pytest.raises(Exception):
        df.collect()


def _history(spark, rows):
    return spark.createDataFrame(rows, PRICE_HISTORY)


def test_daily_prices(spark):
    hist = _history(spark, [("KELP", date(2024, 6, 3), 21.5, 23.0, 20.75, 22.25, 640.9),
                            ("KELP", date(2024, 12, 31), 1.0, 1.0, 1.0, 1.0, 1.0),   # end is exclusive
                            ("MSFT", date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1.0)])   # not listed
    tickers = spark.createDataFrame([("KELP",), ("KELP",), ("FERN",)], "ticker string")
    out = [tuple(r) for r in daily_prices(hist, tickers, date(2024, 1, 1), date(2024, 12, 31)).collect()]
    assert out == [("KELP", "yahoo_finance", 20240603, 21.5, 23.0, 20.75, 22.25, 640)] * 2


def test_daily_prices_empty_history(spark):
    tickers = spark.createDataFrame([("AAPL",)], "ticker string")
    assert daily_prices(_history(spark, []), tickers, date(2024, 1, 1), date(2024, 12, 31)).count() == 0


def test_daily_fx(spark):
    hist = spark.createDataFrame([("NOKSEK=X", date(2024, 6, 3), 0.97), ("NOKSEK=X", date(2024, 6, 4), 0.99),
                                  ("CHFPLN=X", date(2024, 6, 3), 4.4)], FX_HISTORY)
    pairs = spark.createDataFrame([("NOK", "SEK"), ("GBP", "EUR")], "currency string, transaction_currency string")
    out = sorted(tuple(r) for r in daily_fx(hist, pairs, date(2024, 1, 1), date(2024, 12, 31)).collect())
    assert out == [("NOK", "SEK", 20240603, 1.0, 0.97), ("NOK", "SEK", 20240604, 1.0, 0.99)]


def test_exchange_day_of_utc_instant(spark):
    from datetime import datetime
    from daybook.functions import date_key, exchange_day
    df = spark.createDataFrame([(datetime(2024, 1, 3, 2, 30),)], "ts timestamp_ntz")
    r = df.select(date_key(exchange_day(F.col("ts"))).alias("k")).collect()[0]
    assert r.k == 20240102   # 02:30 UTC is still the previous day in New York


def test_asset_table_empty_list(spark):
    df = asset_dimension(read_tickers(spark, _csv("ticker\n")))
    assert df.columns == ["asset_id", "ticker", "asset_class"]
    assert df.count() == 0


def test_asset_table_keeps_duplicates(spark):
    df = asset_dimension(read_tickers(spark, _csv("ticker\nNVDA\nAAPL\nNVDA\n")))
    assert sorted((r.asset_id, r.ticker) for r in df.collect()) == [(0, "AAPL"), (1, "NVDA"), (2, "NVDA")]


def test_per_ticker_csv_history(spark):
    from daybook.sources import read_fx_history_csv_per_symbol, read_price_history_csv_per_ticker
    d = tempfile.mkdtemp(prefix="hist-")
    with open(os.path.join(d, "AAPL.csv"), "w") as fh:
        fh.write("Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n"
                 "2024-01-02 00:00:00-05:00,70,75.5,69.25,72,4100,0.0,0.0\n")
    with open(os.path.join(d, "NVDA.csv"), "w") as fh:
        fh.write("Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n")   # empty history
    tickers = spark.createDataFrame([("AAPL",), ("NVDA",)], "ticker string")
    out = [tuple(r) for r in daily_prices(read_price_history_csv_per_ticker(spark, d), tickers,
                                          date(2024, 1, 1), date(2024, 12, 31)).collect()]
    assert out == [("AAPL", "yahoo_finance", 20240102, 70.0, 75.5, 69.25, 72.0, 4100)]
    f = tempfile.mkdtemp(prefix="fxhist-")
    with open(os.path.join(f, "USDJPY=X.csv"), "w") as fh:
        fh.write("Date,Open,High,Low,Close,Volume\n2024-01-02 00:00:00+00:00,1,1,1,9.25,0\n"
                 "2024-01-03 00:00:00+00:00,1,1,1,9.5,0\n")
    pairs = spark.createDataFrame([("USD", "JPY")], "currency string, transaction_currency string")
    fx = sorted(tuple(r) for r in daily_fx(read_fx_history_csv_per_symbol(spark, f), pairs,
                                             date(2024, 1, 1), date(2024, 12, 31)).collect())
    assert fx == [("USD", "JPY", 20240102, 1.0, 9.25), ("USD", "JPY", 20240103, 1.0, 9.5)]


def test_cluster_conf_sizes_shuffles():
    from daybook.session import cluster_conf
    conf = cluster_conf(100 * (1 << 40), cores=8000)           # 100 TB on 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600  # 100 TB / 256 MB
    assert int(cluster_conf(1 << 20, cores=64)["spark.sql.shuffle.partitions"]) == 128


def test_conform_orders_and_casts_to_the_contract(spark):
    from daybook.schemas import SHARES_TABLE, check_contract, conform
    df = spark.createDataFrame([(7, "20240331", "0000000001", "AAPL")],
                               "shares_outstanding int, date_key string, cik string, ticker string")
    out = conform(df, SHARES_TABLE)
    assert check_contract(out, SHARES_TABLE) == []
    assert tuple(out.first()) == ("AAPL", "0000000001", 20240331, 7)


def test_no_join_hint_and_no_job_while_building(spark):
    from daybook.operators import daily_prices
    history = spark.range(3).selectExpr(
        "'A' AS ticker", "date'2024-01-02' AS day", "1D AS open", "1D AS high", "1D AS low", "1D AS close", "1L AS volume")
    tickers = spark.range(2).selectExpr("'A' AS ticker", "raise_error('ran') AS x")
    plan = daily_prices(history, tickers, date(2024, 1, 1), date(2024, 2, 1))._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plan


def test_one_bad_fx_file_leaves_the_others(spark):
    import os
    import tempfile
    from daybook.sources import read_fx_history_csv_per_symbol
    root = tempfile.mkdtemp(prefix="fx-")
    for name, lines in {"NOKSEK=X": ["2024-06-03,0.97", "2024-06-04,n/a", "2024-06-05,"],
                        "CHFPLN=X": ["not a day,4.4", "2024-06-03 00:00:00+01:00,4.5"]}.items():
        with open(os.path.join(root, f"{name}.csv"), "w") as out:
            out.write("\n".join(["Date,Close", *lines]) + "\n")
    got = sorted(tuple(r) for r in read_fx_history_csv_per_symbol(spark, root).collect())
    assert got == [("CHFPLN=X", date(2024, 6, 3), 4.5), ("NOKSEK=X", date(2024, 6, 3), 0.97)]


def test_extended_of_few_rows_a_day_moves_once_by_ticker(spark):
    from daybook.operators import equity_extended
    daily = spark.createDataFrame(
        [(t, s, 20240100 + d, 1.0, 2.0, 0.5, 1.0 + d, 5) for t in ("A", "B", None) for d in (3, 5, 40) for s in ("y", "x")],
        "ticker string, source string, date_key int, stock_open double, stock_high double, stock_low double, stock_close double, volume long")
    filings = spark.createDataFrame([("A", "1", 20240104, 10), ("A", "1", 20240105, 20), ("B", "2", 20230101, 7), (None, "3", 20240101, 1)],
                                    "ticker string, cik string, date_key int, shares_outstanding long")
    usual, few = equity_extended(daily, filings), equity_extended(daily, filings, few_a_day=True)
    monthly = equity_extended(daily, filings, bucket=lambda k: (k / 100).cast("int"))
    planned = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (few, usual)]
    assert planned == [1, 2]
    got = [sorted(map(str, df.collect())) for df in (usual, few, monthly)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 9 and usual.columns == monthly.columns


def test_bucketed_extended_moves_its_rows_once(spark):
    from daybook.operators import equity_extended
    daily = spark.createDataFrame(
        [(t, s, 20240000 + 100 * m + d, 1.0, 2.0, 0.5, 1.0 + d, 5) for t in ("A", "B", None) for m in (1, 2, 5) for d in (3, 5) for s in ("y", "x")],
        "ticker string, source string, date_key int, stock_open double, stock_high double, stock_low double, stock_close double, volume long")
    filings = spark.createDataFrame([("A", "1", 20240104, 10), ("A", "1", 20240105, 20), ("A", "1", 20240401, 30), ("B", "2", 20230101, 7), (None, "3", 20240101, 1)],
                                    "ticker string, cik string, date_key int, shares_outstanding long")
    usual = sorted(map(str, equity_extended(daily, filings).collect()))
    for few in (True, False):
        monthly = equity_extended(daily, filings, bucket=lambda k: (k / 100).cast("int"), few_a_day=few)
        planned = monthly._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert sorted(map(str, monthly.collect())) == usual and len(usual) == 18
        plan = monthly._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # Rows go by (ticker, bucket), without few_a_day by key before; both levels read them there. One row a bucket
        # then goes by ticker, and what it is filled with back.
        assert planned == (4 if few else 6)
        assert plan.count("ReusedExchange") == 1 and plan.count("Scan ExistingRDD") == 2


def test_monthly_query_reads_the_history_once(spark):
    from daybook.plans.queries import q_asof_market_cap_monthly
    df = q_asof_market_cap_monthly(spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The price history, and the filings.
    assert sum("FileScan" in line and "lineitem" in line for line in plan.splitlines()) == 2
