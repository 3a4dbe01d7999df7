"""CSV files bound by their own headers; rejected lines."""

import csv
import io
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from daybook.sources import (
    accepted_fx,
    bind_by_header,
    csv_lines,
    fx_lines,
    read_fx_history_csv_per_symbol,
    read_price_history_csv_per_ticker,
    rejected_fx,
)
from daybook.sources.csv_files import fields


def land(folder, files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_files_with_swapped_columns(spark, tmp_path):
    path = land(tmp_path / "p", {
        "A.csv": "Date,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1.5,100\n",
        "B.csv": "Volume,Close,Low,High,Open,Date,Dividends\n200,2.5,1.5,3,2,2024-01-02 00:00:00-05:00,0\r\n\n300,3.5,2.5,4,3,2024-01-03,0\n",
        "C.csv": '﻿"Date", Open ,High,Low,"Close",Volume\n"2024-01-04",1,2,"0.5",1.5,1e3\n',
        "D.csv": "Date,Open,High,Low,Close,Volume\n", "E.csv": "",
    })
    rows = sorted(tuple(r) for r in read_price_history_csv_per_ticker(spark, path).collect())
    assert rows == [("A", date(2024, 1, 2), 1, 2, 0.5, 1.5, 100), ("B", date(2024, 1, 2), 2, 3, 1.5, 2.5, 200),
                    ("B", date(2024, 1, 3), 3, 4, 2.5, 3.5, 300), ("C", date(2024, 1, 4), 1, 2, 0.5, 1.5, 1000)]


def test_a_price_file_without_header_fails(spark, tmp_path):
    path = land(tmp_path / "p", {"A.csv": "Date,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1.5,100\n",
                                 "B.csv": "Date,Open,High,Low,Close\n2024-01-02,1,2,0.5,1.5\n"})
    with pytest.raises(Exception, match="no header with"):
        read_price_history_csv_per_ticker(spark, path).count()
    bad = land(tmp_path / "q", {"A.csv": "Date,Open,High,Low,Close,Volume\n2024-01-02,one,2,0.5,1.5,100\n"})
    with pytest.raises(Exception, match="(?i)cast|number"):
        read_price_history_csv_per_ticker(spark, bad).collect()


def test_rejected_lines_have_a_reason(spark, tmp_path):
    path = land(tmp_path / "fx", {
        "USDJPY=X.csv": "Date,Open,Close\n2024-01-02,1,141.0\n2024-01-03,1,\n2024-01-04,1\nnever,1,2\n2024-01-05,1,NaN\n",
        "EURUSD=X.csv": "Close,Date\n1.1,2024-01-02\n", "X.csv": "Day,Close\n2024-01-02,3\n"})
    parsed = fx_lines(csv_lines(spark, path))
    rejected = sorted((r["file"].rsplit("/", 1)[1], r["value"], r["reason"]) for r in rejected_fx(parsed).collect())
    assert rejected == [
        ("USDJPY=X.csv", "2024-01-03,1,", "unreadable rate"), ("USDJPY=X.csv", "2024-01-04,1", "too few fields"),
        ("USDJPY=X.csv", "never,1,2", "unreadable day"), ("X.csv", "2024-01-02,3", "no header with Date, Close"),
        ("X.csv", "Day,Close", "no header with Date, Close")]
    good = sorted((r["symbol"], str(r["day"]), r["close"]) for r in accepted_fx(parsed).collect())
    assert good[:2] == [("EURUSD=X", "2024-01-02", 1.1), ("USDJPY=X", "2024-01-02", 141.0)] and good[2][1] == "2024-01-05"
    assert read_fx_history_csv_per_symbol(spark, path).count() == 3


def test_fields_against_the_csv_module(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(300):
        row = ["".join(rng.choice('ab", ') for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 6))]
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(row)
        texts.append((out.getvalue(), row if row != [""] else [""]))
    got = spark.createDataFrame([(t,) for t, _ in texts], "t string").select("t", fields(F.col("t")).alias("f")).collect()
    want = dict(texts)
    for r in got:
        assert r["f"] == want[r["t"]] or r["t"] == '""', r["t"]


def test_headers_too_large_to_broadcast(spark, tmp_path):
    path = land(tmp_path / "p", {f"{k}.csv": ("a,b" if k % 2 else "b,a") + f"\n{k},{-k}\n" for k in range(1, 9)})
    lines = csv_lines(spark, path)
    both = [sorted(tuple(r) for r in bind_by_header(lines, ["a", "b"], limit).collect()) for limit in (0, 1 << 20)]
    assert both[0] == both[1] and len(both[0]) == 8
    assert {(r[3], r[4]) for r in both[0]} == {(str(k), str(-k)) if k % 2 else (str(-k), str(k)) for k in range(1, 9)}
    plan = bind_by_header(lines, ["a", "b"], 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


def test_a_file_read_in_many_splits(spark, tmp_path):
    path = land(tmp_path / "p", {"A.csv": "k,v\n" + "".join(f"{i},{i * 2}\n" for i in range(3000)),
                                 "B.csv": "v,k\n" + "".join(f"{i * 2},{i}\n" for i in range(3000))})
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = csv_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 4
        rows = bind_by_header(lines, ["k", "v"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(rows) == 6000 and all(int(r["v"]) == 2 * int(r["k"]) for r in rows)


def test_lists_by_their_headers(spark, tmp_path):
    from daybook.sources import currency_pairs_of_lines, tickers_of_lines
    path = land(tmp_path / "t", {"a.csv": 'name,ticker\n"x, y",007\n\nz,NA\n', "b.csv": "ticker\nKELP\nKELP\n"})
    assert sorted(r["ticker"] for r in tickers_of_lines(csv_lines(spark, path)).collect()) == ["007", "KELP", "KELP", "NA"]
    pairs = land(tmp_path / "c", {"a.csv": "transaction_currency,currency\nJPY,USD\n", "b.csv": "currency,transaction_currency\nEUR,USD\n"})
    assert sorted(tuple(r) for r in currency_pairs_of_lines(csv_lines(spark, pairs)).collect()) == [("EUR", "USD"), ("USD", "JPY")]
    bad = land(tmp_path / "d", {"a.csv": "symbol\nKELP\n"})
    with pytest.raises(Exception, match="no header with ticker"):
        tickers_of_lines(csv_lines(spark, bad)).collect()


def test_a_line_is_parsed_once_whatever_its_caller_filters(spark):
    from daybook.sources.csv_files import price_history_of_lines
    rows = [("a.csv", 0, "Date,Open,High,Low,Close,Volume"), ("a.csv", 1, "2024-01-02,1,2,0.5,1.5,10"), ("a.csv", 2, "  \r"),
            ("b.csv", 0, '"Volume",Close,Low,High,Open,Date'), ("b.csv", 1, '20,"2.5",1,3,2,"2024-01-03 00:00:00-05:00"')]
    lines = spark.createDataFrame(rows, "file string, line long, value string")
    history = price_history_of_lines(lines).where((F.col("day") > "2024-01-01") & (F.col("day") < "2024-02-01") & (F.col("close") > 0))
    assert sorted((r["ticker"], str(r["day"]), r["close"], r["volume"]) for r in history.collect()) == [
        ("a", "2024-01-02", 1.5, 10.0), ("b", "2024-01-03", 2.5, 20.0)]
    plan = history._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
