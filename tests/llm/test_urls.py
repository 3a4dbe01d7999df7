"""URL features and suffix statistics against plain restatements; repeated URLs."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import urls

SCHEMA = "page_id long, url string, html string"
NAMES = ["http://a-b.x1.example.org/p/q?x=1&y=2#f", "no scheme", "", None, "://", "HTTP://UP.Net:80//d//?", "ftp://long" + "z" * 3000 + ".de/0123456789",
         "http://ünï.fr/é?&&", "http://x.org?q=://y"]


def plain(url):
    """The lexical features of a URL, written out."""
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    query = (re.search(r"\?([^#]*)", url) or [None, ""])[1]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    shares = [n / len(url) for n in Counter(url).values()]
    return {"url_chars": len(url), "host_chars": len(host), "labels": len(re.findall(r"[^.]+", host)), "depth": len(re.findall("[^/]+", path)),
            "digit_ratio": len(re.findall("[0-9]", url)) / max(len(url), 1), "entropy": -sum(p * math.log2(p) for p in shares),
            "params": len(re.findall("[^&]+", query)), "query_chars": len(query), "hyphens": host.count("-"),
            "host_digits": len(re.findall("[0-9]", host)), "longest_label": max(map(len, host.split("."))), "has_fragment": float("#" in url),
            "tld_chars": len(host.rsplit(".", 1)[-1]), "suffix": host.rsplit(".", 1)[-1]}


def test_features_restated(spark):
    rows = urls.lexical(urls.parts(spark.createDataFrame([(i, u, "") for i, u in enumerate(NAMES)], SCHEMA))).collect()
    for r in rows:
        for name, want in plain(NAMES[r["page_id"]]).items():
            assert r[name] == (pytest.approx(want) if isinstance(want, float) else want), (NAMES[r["page_id"]], name)


def random_pages(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        host = f"{rng.choice('abcdef')}.{rng.choice(['good', 'bad'])}.{rng.choice(['com', 'net', 'org'])}"
        rows.append((i, f"http://{host}/{rng.choice(['about', 'news', '0123456789'])}/{rng.randrange(40)}", ""))
    hot = next(u for _, u, _ in rows if "bad.com" in u)
    return rows + [(n + k, hot, "") for k in range(n)]          # one URL with half of all rows


RULES = [("block", "bad.com/"), ("allow", "good.com/"), ("block", "bad.net/")]


def test_suffix_statistics_leave_the_own_fold_out(spark):
    labelled = urls.sample(urls.ruled(spark.createDataFrame(random_pages(300), SCHEMA), RULES)).cache()
    data = [r.asDict() for r in labelled.collect()]
    assert len({r["url"] for r in data}) == len(data) and max(r["weight"] for r in data) >= 300
    for own in (True, False):
        for r in urls.with_suffix_statistics(labelled, labelled, own).collect():
            others = [o for o in data if not own or o["fold"] != r["fold"]]
            total, blocked = sum(o["weight"] for o in others), sum(o["weight"] * o["label"] for o in others)
            mine = [o for o in others if o["suffix"] == r["suffix"]]
            n, bad = sum(o["weight"] for o in mine), sum(o["weight"] * o["label"] for o in mine)
            assert r["suffix_rate"] == pytest.approx((bad + urls.PRIOR * blocked / max(total, 1)) / (n + urls.PRIOR))
            assert r["suffix_share"] == pytest.approx(n / max(total, 1))


def test_verdicts_come_from_the_features(spark):
    """The label follows the digits of the path (hosts are alike in length and suffix): unseen hosts are judged by it."""
    rng = random.Random(1)
    rows = []
    for i in range(800):
        digits = i % 2
        tail = "".join(rng.choices("0123456789" if digits else "abcdefghij", k=12))
        ruled = ("bad.com" if digits else "gut.com") if i < 500 else f"other{rng.randrange(50)}.{rng.choice(['com', 'info'])}"
        rows.append((i, f"http://{ruled}/{tail}", ""))
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("suffix", F.lit("y"))
    got = {r["page_id"]: r for r in urls.judge(frame, [("block", "bad.com/"), ("allow", "gut.com/")]).collect()}
    assert sum((got[i]["verdict"] == "block") == bool(i % 2) for i in range(500, 800)) >= 280
    assert all(got[i]["score"] is None for i in range(500)) and all(0 <= got[i]["score"] <= 1 for i in range(500, 800))


def test_repeated_urls_agree_and_odd_ones_have_a_verdict(spark):
    rows = random_pages(200) + [(1000 + i, u, "") for i, u in enumerate(NAMES * 2)]
    got = urls.judge(spark.createDataFrame(rows, SCHEMA), RULES).collect()
    by_url = {}
    names = {i: u for i, u, _ in rows}
    for r in got:
        assert by_url.setdefault(names[r["page_id"]], r["verdict"]) == r["verdict"] and r["verdict"] in ("allow", "block")
    assert len(got) == len(rows)
