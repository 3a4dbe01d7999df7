"""Company→CIK documents: cut at entry boundaries, braces in texts, damage."""

import json

import pytest

from daybook.operators import cik_map
from daybook.sources import read_cik_document


def mapping(spark, path):
    return {r["ticker"]: r["cik"] for r in cik_map(read_cik_document(spark, str(path))).collect()}


def document(n, title="Company \"{k}\" \\ Ltd", repeat=97):
    return {str(k): {"cik_str": k, "ticker": f"T{k % repeat}", "title": title.replace("{k}", str(k))} for k in range(n)}


def last(doc):
    out = {}
    for entry in doc.values():
        out[entry["ticker"]] = str(entry["cik_str"]).zfill(10)
    return out


@pytest.mark.parametrize("indent", [None, 2])
def test_one_large_object_is_parsed_by_many_tasks(spark, tmp_path, indent):
    doc = document(3000)
    (tmp_path / "company_tickers.json").write_text(json.dumps(doc, indent=indent) + "\n", encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        entries = read_cik_document(spark, str(tmp_path))
        assert entries.rdd.getNumPartitions() > 4
        assert entries.count() == 3000
        assert mapping(spark, tmp_path) == last(doc)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_braces_inside_texts(spark, tmp_path):
    doc = document(20, title='A } B {{k}} "}", "9": {')
    (tmp_path / "a.json").write_text(json.dumps(doc))
    (tmp_path / "b.json").write_text(json.dumps({"0": {"cik_str": 5, "ticker": "T1", "title": "x"}}))
    assert mapping(spark, tmp_path) == {**last(doc), "T1": "0000000005"}


@pytest.mark.parametrize("text", [
    '{"0": {"cik_str": 1, "ticker": "A", "title": "x"}', '{"0": {"cik_str": 1, "ticker": "A"}, "1": {"cik_str": 2',
    '{"0": {"cik_str": 1, "ticker"}}', '{"0": {"cik_str": 1, "ticker": "A"} "1": {"cik_str": 2, "ticker": "B"}}', '[{"cik_str": 1}]'])
def test_damaged_documents_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_cik_document(spark, str(tmp_path)).collect()


def test_empty_and_spaced_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    assert mapping(spark, tmp_path) == {}
    (tmp_path / "b.json").write_text('\n { "0" : { "ticker" : "A" , "cik_str" : "12345678901" } \n , "k\\"}" : {"cik_str": 7, "ticker": "B", "more": 1} } \n')
    assert mapping(spark, tmp_path) == {"A": "12345678901", "B": "0000000007"}
