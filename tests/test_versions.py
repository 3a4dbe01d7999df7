"""Published versions: atomic replace, reading, expiry, killed and concurrent writers."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from daybook.plans import versions
from daybook.plans.sinks import write_table
from daybook.plans.versions import current, expire, publish, read_table
from daybook.schemas import SHARES_TABLE

DDL = "ticker string, cik string, date_key int, shares_outstanding long"


def ids(df):
    return sorted(r["id"] for r in df.collect())


def numbers(spark, first, last):
    return spark.range(first, last).select("id", (F.col("id") % 3).alias("part"))


def test_each_publish_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish(numbers(spark, 0, 5), path, {"small": F.col("id") < 2}) == {"rows": 5, "small": 2}
    assert ids(read_table(spark, path)) == [0, 1, 2, 3, 4]
    held = read_table(spark, path)                       # a reader at version 1
    publish(read_table(spark, path).where("id > 2"), path)    # reads what it replaces
    assert ids(read_table(spark, path)) == [3, 4]
    assert ids(held) == [0, 1, 2, 3, 4]
    assert ids(read_table(spark, path, version=1)) == [0, 1, 2, 3, 4]
    rows = versions.versions(spark, path).orderBy("version").collect()
    assert [(r["version"], r["counts"]["rows"]) for r in rows] == [(1, 5), (2, 2)]
    with pytest.raises(ValueError, match="version 9"):
        read_table(spark, path, version=9)
    with pytest.raises(Exception, match="(?i)schema|path"):
        spark.read.parquet(path).collect()               # no mixture of versions by accident


@pytest.mark.parametrize("step", ["files", "manifest"])
def test_a_kill_between_steps_leaves_the_table_readable(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    publish(numbers(spark, 0, 3), path)

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    if step == "files":          # while files are written
        broken = numbers(spark, 0, 9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("killed"))).alias("id"))
        with pytest.raises(Exception, match="killed"):
            publish(broken, path)
    else:                        # after them, before the manifest
        monkeypatch.setattr(versions, "current", killed)
        with pytest.raises(KeyboardInterrupt):
            publish(numbers(spark, 0, 9), path)
        monkeypatch.undo()
    assert ids(read_table(spark, path)) == [0, 1, 2]
    publish(numbers(spark, 5, 7), path)
    assert ids(read_table(spark, path)) == [5, 6]
    expire(spark, path, keep=1, grace_hours=0)
    assert len([n for n in os.listdir(path) if n.startswith("_v-")]) == 1
    assert ids(read_table(spark, path)) == [5, 6]


def test_an_unfinished_manifest_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(numbers(spark, 0, 3), path)
    folder = tmp_path / "t" / "_published" / f"{2:020d}-x" / "_temporary" / "0"
    folder.mkdir(parents=True)
    (folder / "part-00000.json").write_text('{"version":2,"id":"x","folder":"_v-x","counts":{}}\n')
    assert current(spark, path)["version"] == 1
    assert ids(read_table(spark, path)) == [0, 1, 2]


def test_expire_keeps_what_is_published_and_running(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        publish(numbers(spark, k, k + 2), path)
    (tmp_path / "t" / "_v-running").mkdir()
    assert len(expire(spark, path)) == 2
    assert ids(read_table(spark, path)) == [3, 4] and ids(read_table(spark, path, 3)) == [2, 3]
    assert (tmp_path / "t" / "_v-running").exists()
    assert expire(spark, path, keep=1, grace_hours=0) and not (tmp_path / "t" / "_v-running").exists()
    with pytest.raises(ValueError):
        expire(spark, path, keep=0)
    assert expire(spark, str(tmp_path / "none")) == []
    publish(numbers(spark, 8, 9), path, keep=1)
    assert len([n for n in os.listdir(path) if n.startswith("_v-")]) == 1


def test_contract_partitions_and_plain_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([("KELP", "0000000077", 20240101, 1)], DDL)
    bad = spark.createDataFrame([("KELP", None, 20240101, 1)], DDL)
    publish(good, path, contract=SHARES_TABLE)
    with pytest.raises(ValueError, match="1 rows"):
        publish(bad, path, contract=SHARES_TABLE)
    assert [r["ticker"] for r in read_table(spark, path).collect()] == ["KELP"]
    years = str(tmp_path / "y")
    publish(numbers(spark, 0, 6), years, partition_by=["part"], sort_within=["id"])
    assert ids(read_table(spark, years).where("part = 1")) == [1, 4]
    plain = str(tmp_path / "p")
    write_table(numbers(spark, 0, 2), plain)
    assert ids(read_table(spark, plain)) == [0, 1]
    publish(numbers(spark, 7, 8), plain)
    assert ids(read_table(spark, plain)) == [7]
    expire(spark, plain, grace_hours=0)
    assert not [n for n in os.listdir(plain) if n.endswith(".parquet")] and ids(read_table(spark, plain)) == [7]


def test_concurrent_writers_agree(spark, tmp_path):
    path = str(tmp_path / "t")
    frames = [numbers(spark, 10 * k, 10 * k + 3) for k in range(4)]
    threads = [threading.Thread(target=publish, args=(f, path)) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert versions.versions(spark, path).count() == 4
    assert ids(read_table(spark, path)) in [[10 * k, 10 * k + 1, 10 * k + 2] for k in range(4)]


def test_replacing_a_plain_table_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(numbers(spark, 0, 3), path)
    write_table(numbers(spark, 3, 5), path)
    assert ids(spark.read.parquet(path)) == [3, 4] and os.listdir(tmp_path) == ["t"]


def _bucketed(spark, folder, seed):
    import random
    from daybook.schemas import DAILY_TABLE
    rng = random.Random(seed)
    days = [20240100 + d for d in range(1, 29)]
    daily = spark.createDataFrame([(rng.choice(["KELP", "FERN", "MOSS", "REED"]), rng.choice(["a", "b"]), rng.choice(days), 1.0, 2.0, 0.5, rng.random(), k)
                                   for k in range(400)], DAILY_TABLE)
    filings = spark.createDataFrame([(rng.choice(["KELP", "FERN", "MOSS"]), "0000000001", rng.choice(days), k) for k in range(30)], SHARES_TABLE)
    paths = str(folder / "d"), str(folder / "f")
    for frame, path in zip((daily, filings), paths):
        publish(frame, path, sort_within=["ticker", "date_key"], buckets=(4, ["ticker"]), contract=None)
    return daily, filings, paths


def test_bucketed_tables_need_no_shuffle(spark, tmp_path):
    from daybook.operators import equity_extended
    daily, filings, paths = _bucketed(spark, tmp_path, 1)
    read = [read_table(spark, p) for p in paths]
    assert read[0].schema.names == daily.schema.names and read[0].count() == 400
    plain = equity_extended(daily, filings)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        looked_up = equity_extended(*read, by_ticker=True)
        plan = looked_up._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan and "SortMergeJoin" in plan
        assert sorted(map(tuple, looked_up.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    with pytest.raises(ValueError):
        equity_extended(*read, by_ticker=True, bucket=lambda k: k)


def test_files_of_a_bucketed_table_are_sorted(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    _, _, paths = _bucketed(spark, tmp_path, 2)
    files = [f for p in paths for f in glob.glob(f"{p}/_v-*/*.parquet")]
    tickers = {}
    for file in files:
        table = pq.read_table(file).to_pydict()
        keys = list(zip(table["ticker"], table["date_key"]))
        assert keys == sorted(keys)
        footer = pq.ParquetFile(file).metadata
        place = footer.schema.names.index("date_key")
        assert footer.row_group(0).column(place).statistics.min == min(table["date_key"])
        for t in set(table["ticker"]):       # one file per table and ticker
            assert tickers.setdefault((file.split("/_v-")[0], t), file) == file
    with pytest.raises(ValueError, match="sort_within"):
        publish(numbers(spark, 0, 3), str(tmp_path / "x"), buckets=(2, ["id"]))


def test_bucketed_versions_replace_each_other(spark, tmp_path):
    path = os.path.relpath(tmp_path / "it's a table")
    for k in range(3):
        publish(numbers(spark, 0, 5 + k), path, sort_within=["id"], buckets=(2, ["part"]))
    publish(read_table(spark, path).where("id < 2"), path)
    assert ids(read_table(spark, path)) == [0, 1] and ids(read_table(spark, path, 3)) == list(range(7))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("daybook_write")]
