"""End-to-end build from landed files, and incremental ingestion."""

import json
import os
import tempfile
from datetime import date

from daybook.plans.build import build_all
from daybook.schemas import (
    ASSET_TABLE,
    CURRENCY_PAIRS_TABLE,
    DAILY_CURRENCY_TABLE,
    DAILY_TABLE,
    DATE_TABLE,
    EQUITY_EXTENDED_TABLE,
    FX_HISTORY,
    PRICE_HISTORY,
    SHARES_TABLE,
)

CSO = "CommonStockSharesOutstanding"


def _land(spark, root):
    with open(os.path.join(root, "tickers.csv"), "w") as fh:
        fh.write("ticker\nAAPL\nNVDA\nGME\n")
    with open(os.path.join(root, "currency_pairs.csv"), "w") as fh:
        fh.write("currency,transaction_currency\nUSD,JPY\nEUR,USD\n")
    with open(os.path.join(root, "company_tickers.json"), "w") as fh:
        json.dump({"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple"},
                   "1": {"cik_str": 1045810, "ticker": "NVDA", "title": "NVIDIA"}}, fh)
    os.makedirs(os.path.join(root, "companyfacts"))
    for cik, entries in [(320193, [("10-Q", "2023-12-30", "2024-02-01", 81000),
                                   ("10-Q", "2024-03-30", "2024-05-01", 82500)]),
                         (1045810, [("10-K", "2024-01-28", "2024-02-21", 2500000000)])]:
        doc = {"cik": cik, "facts": {"us-gaap": {CSO: {"units": {"shares": [
            {"form": f, "end": e, "filed": fd, "val": v} for f, e, fd, v in entries]}}}}}
        with open(os.path.join(root, "companyfacts", f"CIK{cik:010d}.json"), "w") as fh:
            json.dump(doc, fh)
    prices = [(t, date(2024, 1, d), 1.0 * d, 2.0 * d, 0.5 * d, 1.5 * d, 100.0 * d)
              for t in ("AAPL", "NVDA", "GME", "MSFT") for d in (2, 3)]
    prices.append(("AAPL", date(2024, 4, 1), 1.0, 1.0, 1.0, 190.0, 1.0))
    spark.createDataFrame(prices, PRICE_HISTORY).write.parquet(os.path.join(root, "prices"))
    fx = [("USDJPY=X", date(2024, 1, 2), 141.0), ("USDJPY=X", date(2024, 1, 3), 142.0)]
    spark.createDataFrame(fx, FX_HISTORY).write.parquet(os.path.join(root, "fx"))


def test_build_all(spark):
    root = tempfile.mkdtemp(prefix="landing-")
    out = tempfile.mkdtemp(prefix="warehouse-")
    _land(spark, root)
    report = build_all(spark, root, out, date(2024, 1, 1), date(2024, 12, 31))
    assert report["date_table"] == {"rows": 366, "open_days": 252, "null_violations": 0}
    assert report["asset_table"]["rows"] == 3
    assert report["daily_table"]["rows"] == 7
    assert report["edgar_10q_table"]["rows"] == 3
    assert report["equity_table_extended"] == {  # NVDA x2, GME x2 without a filing
        "rows": 7, "missing_filing": 4, "null_violations": 0}
    assert report["currency_pairs_table"]["rows"] == 2
    assert report["daily_currency_table"]["rows"] == 2
    assert all(r["null_violations"] == 0 for r in report.values())
    contracts = {"date_table": DATE_TABLE, "asset_table": ASSET_TABLE,
                 "currency_pairs_table": CURRENCY_PAIRS_TABLE, "daily_table": DAILY_TABLE,
                 "edgar_10q_table": SHARES_TABLE, "daily_currency_table": DAILY_CURRENCY_TABLE,
                 "equity_table_extended": EQUITY_EXTENDED_TABLE}
    for name, schema in contracts.items():
        df = spark.read.parquet(os.path.join(out, name))
        assert [(f.name, f.dataType) for f in df.schema.fields] == \
            [(f.name, f.dataType) for f in schema.fields], name
    ext = {(r.ticker, r.date_key): r for r in spark.read.parquet(os.path.join(out, "equity_table_extended")).collect()}
    assert ext[("AAPL", 20240102)].edgar_10q_date_key == 20231230
    assert ext[("AAPL", 20240401)].edgar_shares_outstanding == 82500
    assert ext[("AAPL", 20240401)].market_cap == 190.0 * 82500
    assert ext[("NVDA", 20240102)].edgar_shares_outstanding is None      # 10-K period ends 01-28
    assert ext[("GME", 20240102)].edgar_cik is None


def test_build_all_partitioned_by_year(spark):
    root = tempfile.mkdtemp(prefix="landing-")
    out = tempfile.mkdtemp(prefix="warehouse-")
    _land(spark, root)
    build_all(spark, root, out, date(2024, 1, 1), date(2024, 12, 31), partition_by_year=True)
    assert os.path.isdir(os.path.join(out, "equity_table_extended", "year=2024"))
    df = spark.read.parquet(os.path.join(out, "equity_table_extended")).where("year = 2024")
    assert df.count() == 7
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan   # pruned, not scanned


def test_build_order_and_subsets(spark):
    from daybook.plans.build import DATE_TABLES, EQUITY_TABLES, build_order
    assert build_order(["equity_table_extended"]) == EQUITY_TABLES
    assert build_order(["daily_currency_table"]) == ["currency_pairs_table", "daily_currency_table"]
    assert build_order(DATE_TABLES) == ["date_table"]
    assert build_order(["equity_table_extended"], with_dependencies=False) == ["equity_table_extended"]
    root = tempfile.mkdtemp(prefix="landing-")
    out = tempfile.mkdtemp(prefix="warehouse-")
    _land(spark, root)
    report = build_all(spark, root, out, date(2024, 1, 1), date(2024, 12, 31), tables=EQUITY_TABLES)
    assert list(report) == EQUITY_TABLES
    assert report["equity_table_extended"]["rows"] == 7


def test_command_line(spark):
    import json as _json
    import subprocess
    import sys
    root = tempfile.mkdtemp(prefix="landing-")
    out = tempfile.mkdtemp(prefix="warehouse-")
    _land(spark, root)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run(
        [sys.executable, "-m", "daybook", "--landing", root, "--out", out, "--tables", "equity",
         "--master", "local[2]", "--input-gb", "0.5"],
        cwd=repo, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    lines = [_json.loads(x) for x in run.stdout.splitlines() if x.startswith("{")]
    assert [x["table"] for x in lines] == ["asset_table", "daily_table", "edgar_10q_table",
                                           "equity_table_extended"]
    assert lines[-1]["missing_filing"] == 4


def test_build_all_from_per_ticker_csv_history(spark):
    root = tempfile.mkdtemp(prefix="landing-csv-")
    out = tempfile.mkdtemp(prefix="warehouse-")
    _land(spark, root)
    os.makedirs(os.path.join(root, "prices_csv"))
    for t in ("AAPL", "NVDA"):
        with open(os.path.join(root, "prices_csv", f"{t}.csv"), "w") as fh:
            fh.write("Date,Open,High,Low,Close,Volume,Dividends,Stock Splits\n"
                     "2024-01-02 00:00:00-05:00,1,2,0.5,1.5,100,0,0\n"
                     "2024-04-01 00:00:00-04:00,1,2,0.5,190,100,0,0\n")
    os.makedirs(os.path.join(root, "fx_csv"))
    with open(os.path.join(root, "fx_csv", "USDJPY=X.csv"), "w") as fh:
        fh.write("Date,Open,High,Low,Close,Volume\n2024-01-02 00:00:00+00:00,1,1,1,141.0,0\n")
    csv_root = tempfile.mkdtemp(prefix="landing-csv2-")
    for name in ("tickers.csv", "currency_pairs.csv", "company_tickers.json", "companyfacts"):
        os.symlink(os.path.join(root, name), os.path.join(csv_root, name))
    os.symlink(os.path.join(root, "prices_csv"), os.path.join(csv_root, "prices"))
    os.symlink(os.path.join(root, "fx_csv"), os.path.join(csv_root, "fx"))
    report = build_all(spark, csv_root, out, date(2024, 1, 1), date(2024, 12, 31), history_format="csv")
    assert report["daily_table"]["rows"] == 4
    assert report["daily_currency_table"]["rows"] == 1
    ext = {(r.ticker, r.date_key): r for r in spark.read.parquet(os.path.join(out, "equity_table_extended")).collect()}
    assert ext[("AAPL", 20240401)].market_cap == 190.0 * 82500


def test_build_twice_in_one_session(spark):
    root = tempfile.mkdtemp(prefix="landing-")
    out = tempfile.mkdtemp(prefix="warehouse-")
    _land(spark, root)
    first = build_all(spark, root, out, date(2024, 1, 1), date(2024, 12, 31), tables=["date_table"])
    second = build_all(spark, root, out, date(2024, 1, 1), date(2024, 12, 31), tables=["date_table"])
    assert first == second == {"date_table": {"rows": 366, "open_days": 252, "null_violations": 0}}


def test_build_from_landed_testdata(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    from daybook.session import scratch_path
    from daybook.sources import testdata as td
    root, out = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    td.land_files(spark, sf, root)
    report = build_all(spark, root, out, td.FILING_START, td.FX_END, facts_json_lines=True)
    assert all(r["null_violations"] == 0 for r in report.values())
    assert report["equity_table_extended"]["rows"] == report["daily_table"]["rows"] > 0
    assert report["edgar_10q_table"]["rows"] > 0 and report["daily_currency_table"]["rows"] > 0
    assert report["asset_table"]["rows"] == spark.read.parquet(f"{sf}/part.parquet").count()


def test_null_contract_violations_refuse_the_write(spark):
    import pytest
    from daybook.plans.sinks import write_table
    from daybook.schemas import SHARES_TABLE, null_violations
    ddl = "ticker string, cik string, date_key int, shares_outstanding long"
    good = spark.createDataFrame([("KELP", "0000000077", 20240101, 1)], ddl)
    bad = spark.createDataFrame([("KELP", None, 20240101, 1), (None, "0000000001", 20240101, 2)], ddl)
    folder = tempfile.mkdtemp(prefix="nulls-")
    path = os.path.join(folder, "t")
    assert write_table(good, path, contract=SHARES_TABLE) == {"rows": 1, "null_violations": 0}
    with pytest.raises(ValueError, match="2 rows"):
        write_table(bad, path, contract=SHARES_TABLE)
    assert os.listdir(folder) == ["t"]
    assert [r.ticker for r in spark.read.parquet(path).collect()] == ["KELP"]
    assert tuple(null_violations(bad, SHARES_TABLE).first()) == (1, 1, 0, 0)


def test_damaged_cik_document_fails(spark):
    import pytest
    from daybook.sources import read_cik_document
    path = os.path.join(tempfile.mkdtemp(prefix="cik-"), "company_tickers.json")
    with open(path, "w") as fh:
        fh.write('{"0": {"cik_str": 320193, "ticker": "AAPL", "title"')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_cik_document(spark, path).collect()


def test_year_folders_get_few_files(spark):
    from pyspark.sql import functions as F
    from daybook.plans.sinks import with_year, write_table
    df = with_year(spark.range(0, 4000, 1, 8).select(
        ((2020 + F.col("id") % 4) * 10000 + 101 + F.col("id") % 28).cast("int").alias("date_key"), "id"))
    path = os.path.join(tempfile.mkdtemp(prefix="years-"), "t")
    assert write_table(df, path, partition_by=["year"], sort_within=["id"]) == {"rows": 4000}
    for year in range(2020, 2024):
        files = [f for f in os.listdir(os.path.join(path, f"year={year}")) if f.endswith(".parquet")]
        assert len(files) == 1
        rows = [r.id for r in spark.read.parquet(os.path.join(path, f"year={year}", files[0])).collect()]
        assert rows == sorted(rows) and len(rows) == 1000
