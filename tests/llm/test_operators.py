"""The dealt operators against brute force, and their defined odd cases."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import jaccard, licenses, mixing, outliers, pieces, pii, quality, repeats, topk, urls

WHITE = re.compile(r"[\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def words_of(text):
    return [w for w in WHITE.split(text or "") if w]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


# 1 mixing -----------------------------------------------------------------

def test_mix_targets_and_bounds(spark, documents):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 60), "en", rng.choice(["a", "b", "c", None])) for i in range(400)]
    got = mixing.op1_mix(documents(rows, extra=("size", "target"))).collect()
    sizes, sources = {i: len(words_of(t)) for i, t, _, _ in rows}, {r[0]: r[3] for r in rows}
    total = collections.Counter()
    for i, n in sizes.items():
        total[sources[i]] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(total.values()), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * total[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        open_ -= over
    taken = collections.Counter()
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == total[sources[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[sources[r["doc_id"]]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[sources[r["doc_id"]]] += r["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= 1
    again = mixing.op1_mix(documents(rows).repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mix_schedule_keeps_shares_in_every_stretch(spark, documents):
    rows = [(i, "w " * 50, "en", "ab"[i % 2]) for i in range(200)]
    sized = documents(rows).select("doc_id", "source", F.lit(50).cast("long").alias("size"))
    _, draws = mixing.mix(sized)
    slots = sorted({(r["slot"], r["src"]) for r in draws.select("slot", "src").distinct().collect()})
    assert len({s for s, _ in slots}) == len(slots)
    share = sum(src == 1 for _, src in slots) / len(slots)
    for k in range(0, len(slots) - 64, 64):
        part = sum(src == 1 for _, src in slots[k:k + 64]) / 64
        assert abs(part - share) < 0.1


def test_mix_odd(odd, documents):
    got = mixing.op1_mix(odd).collect()
    assert len(got) == odd.count()
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.op1_mix(documents([])).collect() == []
    assert mixing.mix_documents(odd).columns == odd.columns


# 2 PII --------------------------------------------------------------------

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


TRICKY = [
    "a@b.c_d@e.f x@y@z.com 'q.w+e%r-t_@h-o.st.' no@host", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5500005555555559 1234567890123", "+1 (555) 010-9999 +12 +49.30.1234567-8 ++1 2 3 4 5 6 7 8 9 0",
    "é4111111111111111\U0001F600a@b.cc +44 20 7946 0958.", "1 " * 3000, "9" * 20000, "a" * 20000 + "@b.c", "+1" + " " * 5000, "a@" * 2000,
]


def test_pii_base_spans(spark, documents):
    rng = random.Random(5)
    noise = ["".join(rng.choice("ab1 2.3@-+(_%") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    rows = list(enumerate([*TRICKY, *noise, None, ""]))
    got = by_id(pii.op2_pii(documents(rows, extra=("base", "spans"))))
    for i, text in rows:
        want = base_spans(text)
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in want)
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), (text or "")[:80]
        assert set(filter(None, listed.split(","))) <= set(got[i]["spans"].split(",")) | {""}
        for k, (kind, _) in enumerate(PATTERNS):
            assert got[i][f"n_{kind}"] == sum(x[1] == k for x in want)


def test_pii_trees_add_lookalikes(documents):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, f"Please phone +1 {number} today." if i % 2 else f"The range 12-14-16 and {rng.randint(10, 99)} 44 12 of it."))
    rows.append((1000, "Please phone 1 (386) 555-3733 today."))
    got = by_id(pii.op2_pii(documents(rows)))
    assert got[1000]["n_phone"] == 0 and "phone:13:29" in got[1000]["spans"]


def test_pii_adds_common_other_spellings(documents):
    rng = random.Random(10)
    rows, hidden = [], {}
    for i in range(1200):
        area, line, who = rng.randint(200, 999), rng.randint(1000, 9999), f"{rng.choice('abcdefg')}{rng.randint(10, 99)}"
        secret = [f"+1 ({area}) 555-{line}", f"{who}@host.com", f"({area}) 555-{line}", f"{who} at host dot com"][i % 4]
        rows.append((i, [f"Please phone {secret} today.", f"Contact {secret} today."][i % 2]))
        if i % 4 > 1:
            hidden[i] = (secret, ["phone", "email"][i % 2])
    for i in range(1200, 1800):
        rows.append((i, f"The range 12-14-{rng.randint(10, 99)} was seen at 10.{rng.randint(10, 59)} of it, in 44 12 {rng.randint(10, 99)} rows."))
    for i in range(1800, 2400):
        number = "".join(str(rng.randint(0, 9)) for _ in range(15))
        check = next(d for d in range(10) if luhn(number + str(d)))
        number += str(check if i % 2 else (check + rng.randint(1, 9)) % 10)
        rows.append((i, f"Seen {number} here."))
    rows.append((3000, "Seen 4111.1111.1111.1111 here."))
    df = documents(rows)
    texts = dict(rows)
    got = by_id(pii.op2_pii(df))
    assert got[3000]["n_card"] == 0 and got[3000]["spans"] == "card:5:24"
    assert all((got[i]["spans"] == "card:5:21") == bool(i % 2) for i in range(1800, 2400))
    clean = by_id(pii.redact(df))
    for i, (secret, kind) in hidden.items():
        at = texts[i].index(secret)
        assert got[i]["n_phone"] == got[i]["n_email"] == 0 and got[i]["spans"] == f"{kind}:{at}:{at + len(secret)}"
        assert clean[i]["text"] == texts[i].replace(secret, f"[{kind.upper()}]")
    assert all(got[i]["spans"] == "" for i in range(1200, 1800))


def test_pii_model_reads_every_labelled_candidate(documents, monkeypatch):
    rng = random.Random(12)
    rows = [(i, f"Please phone +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} today." if i % 2
             else f"The range 12-14-16 and {rng.randint(10, 99)} 44 12 of it.") for i in range(400)]
    rows.append((1000, "Please phone 1 (386) 555-3733 today."))
    df = documents(rows)
    monkeypatch.setattr(pii, "SAMPLE_ROWS", 4, raising=False)  # No bound on candidates has a say.
    assert "phone:13:29" in by_id(pii.op2_pii(df))[1000]["spans"]
    cands = pii.candidates(pii.find(df)).where("label IS NOT NULL")
    kinds = {(r["label"], r["k"]): r["n"] for r in cands.groupBy("label", "k").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = pii.weighted(cands).groupBy("label", "k").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    assert {(r["label"], r["k"]): r["n"] for r in counted} == kinds and sum(r["rows"] for r in counted) < sum(kinds.values())


def test_pii_trees_and_thresholds_leave_out_no_labelled_candidate(documents, monkeypatch):
    rng = random.Random(13)
    rows = [(i, f"Please phone +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} today." if i % 2
             else f"The range 12-14-16 and {rng.randint(10, 99)} 44 12 of it.") for i in range(200)]
    rows.append((1000, "Please phone 1 (386) 555-3733 today."))
    found = pii.find(documents(rows))
    sizes = {r["fold"]: r["n"] for r in pii.weighted(pii.candidates(found)).groupBy("fold").agg(F.sum("weight").alias("n")).collect()}
    learnt, judged = [], []
    fit, thresholds = pii.GBTClassifier.fit, pii.thresholds
    monkeypatch.setattr(pii.GBTClassifier, "fit", lambda self, df: learnt.append(df.agg(F.sum("weight")).first()[0]) or fit(self, df))
    monkeypatch.setattr(pii, "thresholds", lambda scored: judged.append(scored.agg(F.sum("weight")).first()[0]) or thresholds(scored))
    assert [r["start"] for r in pii.added_spans(found).where("doc_id = 1000").collect()] == [13]
    total = sum(sizes.values())
    assert len(sizes) == pii.FOLDS and judged == [total] and learnt[-1] == total
    assert sorted(learnt[:-1]) == sorted(total - n for n in sizes.values())


@pytest.mark.parametrize("texts", [
    ["Please phone +1 (386) 555-3733 or 1 (386) 555-3733, range 12-14-16 and 15 44 12."],
    ["Please phone +1 (386) 555-3733 today.", "The range 12-14-16 and 15 44 12 of it, or 1 (386) 555-3733."]])
def test_pii_folds_without_a_class(documents, texts):
    got = by_id(pii.op2_pii(documents(list(enumerate(texts)))))
    assert len(got) == len(texts) and got[0]["n_phone"] == 1 and got[0]["spans"].startswith("phone:13:")


def test_pii_redaction_and_odd(odd, documents):
    df = pii.redact(documents([(1, "mail a@b.cc or +1 (555) 010-9999 now"), (2, None), (2, None), (3, "clean")], extra=("spans", "row")))
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in df.collect() if r["text"]) == [
        (1, "mail [EMAIL] or [PHONE] now", 27), (3, "clean", 5)]
    assert df.count() == 4 and "row" in df.columns
    assert pii.redact(odd).columns == odd.columns and pii.redact(odd).count() == odd.count()
    assert pii.op2_pii(documents([])).collect() == []


# 3 URLs -------------------------------------------------------------------

def test_url_parts_and_rules(spark):
    cases = [("http://A.Example.NET/en/1?x=/fr/", "a.example.net", "/en/1", "example.net/en/", "allow"),
             ("https://example.net/de/", "example.net", "/de/", "net/", "block"), ("http://example.net", "example.net", "", None, None),
             ("http://x.example.com/de/9#t", "x.example.com", "/de/9", "example.com/de/", "block"),
             ("http://notexample.com/de/9", "notexample.com", "/de/9", None, None),
             ("ftp://w.org/fr/?q", "w.org", "/fr/", "org/fr/", "allow"), ("nothing", "", "", None, None), (None, "", "", None, None),
             ("://ÄB.org?x", "Äb.org", "", None, None), ("", "", "", None, None)]
    pages = spark.createDataFrame([(i, c[0], "h", "v") for i, c in enumerate(cases * 20)], "page_id long, url string, html string, verdict string")
    got = {r["page_id"]: r for r in urls.op3_urls(pages).collect()}
    assert len(got) == len(cases) * 20
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert urls.op3_urls(pages.limit(0)).collect() == []
    assert {r["verdict"] for r in urls.op3_urls(pages.where("url = 'nothing'")).collect()} == {"allow"}


def test_url_trees_learn_a_lexical_rule(spark):
    rng = random.Random(1)
    rules = [("block", "bad.com/"), ("allow", "good.com/")]
    rows = []
    for i in range(600):
        bad = i % 2
        tail = "".join(rng.choice("0123456789") for _ in range(14)) if bad else rng.choice(["about", "contact", "news"])
        host = ("bad.com" if bad else "good.com") if i < 400 else "other.com"
        rows.append((i, f"http://{host}/{tail}", ""))
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules).collect()}
    right = sum((got[i]["verdict"] == "block") == bool(i % 2) for i in range(400, 600))
    assert right >= 190


# 4 SentencePiece ----------------------------------------------------------

def best_sum(model, text):
    """Best total score of any segmentation, by trying every piece at every position."""
    scores = {p: s for p, _, s in model["pieces"]}
    longest = max(map(len, scores))
    best = [0.0]
    for end in range(1, len(text) + 1):
        tries = [best[start] + scores[text[start:end]] for start in range(max(0, end - longest), end) if text[start:end] in scores]
        if text[end - 1] not in scores:
            tries.append(best[end - 1] + model["unknown"])
        best.append(max(tries))
    return best[-1]


def test_pieces_are_the_best_segmentation(small):
    model = pieces.read_model()
    codec, score = pieces.Codec(model), {i: s for _, i, s in model["pieces"]}
    lines = sorted({line for r in small.collect() for line in (r["text"] or "").split("\n") if line})[:400]
    assert len(lines) > 300
    for line in lines:
        if all(c in codec.single or c == " " for c in line):
            marked = "▁" + line.replace(" ", "▁")
            ids = codec.encode(line)
            assert "".join(codec.text[i] for i in ids) == " " + line
            assert sum(score[i] for i in ids) == best_sum(model, marked), line


def test_pieces_cache_and_cuts_change_nothing():
    codec = pieces.Codec(pieces.read_model())
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab .,\n\té▁the\U0001F600") for _ in range(rng.randint(0, 60)))
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        if "▁" not in text and text:
            assert tuple(ids) == codec.segment("▁" + text.replace(" ", "▁")) or _score(codec, ids) == _score(
                codec, codec.segment("▁" + text.replace(" ", "▁")))


def test_pieces_of_long_texts_are_those_of_the_whole(monkeypatch):
    codec = pieces.Codec(pieces.read_model())
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("ab  .,\n▁the") for _ in range(rng.randint(0, 80)))
        monkeypatch.setattr(pieces, "LONG", 1 << 20)
        whole = codec.encode(text)
        monkeypatch.setattr(pieces, "LONG", 6)
        assert codec.encode(text) == whole


def _score(codec, ids):
    score = {i: s for _, i, s in pieces.read_model()["pieces"]}
    return sum(score.get(i, 0) for i in ids)


def test_pieces_round_trip(odd, small, documents):
    for df in (odd, small):
        assert df.count() == pieces.op4_sentencepiece(df).where("round_trip").count()
    assert pieces.op4_sentencepiece(documents([])).collect() == []
    model = pieces.read_model()
    ids = documents([(1, "a b ▁\n"), (2, None)]).select("doc_id", pieces.encoded(F.col("text"), model).alias("ids"))
    assert sorted(r["text"] for r in ids.select(pieces.decoded(F.col("ids"), model).alias("text")).collect()) == ["", "a b ▁\n"]
    assert {r["n_tokens"] for r in pieces.op4_sentencepiece(odd).where("doc_id = 2").collect()} == {0}


# 5 top-k ------------------------------------------------------------------

def test_topk_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.choice([0.1, 1, 5])]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)] + [(2000 + i, [0.0] * 8) for i in range(0, 60, 10)]
    bad = [(3000, None), (3050, [1.0, None] * 4), (3100, [float("nan")] * 8), (3150, [float("inf")] * 8), (None, [1.0] * 8), (3200, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = collections.defaultdict(list)
    for r in topk.op5_topk(df).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    v = {i: [int(np.floor(256 * float(np.float32(x)))) for x in e] for i, e in rows}
    for q in (i for i in v if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q)[:5]
        assert sorted(got[q]) == [(k + 1, c, -s) for k, (s, c) in enumerate(scores)]
    assert set(got) == {i for i in v if i % 50 == 0}
    assert topk.op5_topk(df.limit(0)).collect() == []


def test_topk_oracle(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(topk.ORACLE).fetchall())
    assert sorted(tuple(r) for r in topk.op5_topk(df).collect()) == want


# 6 licences ---------------------------------------------------------------

def test_licenses(documents, odd):
    body = next(v for k, v in licenses.KNOWN if k == "MIT" and len(v) > 100)
    variant = "Copyright (c) 2020 Someone\n\n" + body.upper().replace(",", " ,").replace("\n", "\n\n  ")
    got = by_id(licenses.op6_licenses(documents([
        (1, body), (2, variant), (3, body + " more"), (4, "Some text.\nReleased under the MIT Licence!\nRELEASED UNDER THE MIT LICENSE\nLicensed under CC BY-NC 4.0"),
        (5, "Released under the MIT License. And more"), (6, None), (7, "")], extra=("license", "digest"))))
    assert [got[i]["license"] for i in range(1, 8)] == ["MIT", "MIT", None, None, None, None, None]
    assert got[4]["notices"] == "CC-BY-NC-4.0,MIT" and got[5]["notices"] == "" and got[6]["digest"] is None
    assert licenses.op6_licenses(odd).count() == odd.count()
    assert licenses.op6_licenses(documents([])).collect() == []


def test_licenses_whole_texts_and_every_line(documents, spark):
    listed = [(r["license"], r["body"]) for r in licenses.known_texts(spark).collect()]
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "MPL-2.0", "Unlicense"} <= {
        i for i, body in listed if len(body) > 1000}
    rows = [(k, "Copyright 2021 Someone\n" + body) for k, (_, body) in enumerate(listed)]
    one_line = [" ".join(next(v for k, v in listed if k == x and len(v) > 400).split()) for x in ("ISC", "MIT")]
    assert "licen" not in one_line[0].lower()
    rows += [(1000, f"Before.\n{one_line[0]}\n{one_line[1]}\nAfter."), (1000, "other"), (1000, f"x\n{one_line[1]}"), (None, one_line[0] + "\nx")]
    got = licenses.op6_licenses(documents(rows)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["license"] for r in got if r["doc_id"] is not None and r["doc_id"] < 1000} == {
        k: i for k, (i, _) in enumerate(listed)}
    assert sorted(r["notices"] for r in got if r["doc_id"] == 1000) == ["", "ISC,MIT", "MIT"]
    assert [r["notices"] for r in got if r["doc_id"] is None] == ["ISC"]
    rewrapped = one_line[1].replace("THE AUTHORS OR COPYRIGHT", "THE\nAUTHORS OR COPYRIGHT")
    assert by_id(licenses.op6_licenses(documents([(1, rewrapped)])))[1]["license"] == "MIT"
    own = spark.createDataFrame([("Mine", "Do as you like.")], "license string, body string")
    assert [(r["license"], r["notices"]) for r in licenses.scan(documents([(1, "do as you like")]), own).collect()] == [("Mine", "Mine")]


# 7 quality ----------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.op7_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_quality_odd(spark, odd, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.op7_quality(odd, none).collect()} == {0.5}
    one = spark.createDataFrame([(4, 1, 0), (6, 1, 0), (None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in quality.op7_quality(odd, one).collect()} <= {0, 1}
    two = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (5, 0, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.op7_quality(odd, two).count() == odd.count()
    assert quality.op7_quality(documents([]), two).collect() == []


# 8 Jaccard join -----------------------------------------------------------

def brute_links(rows):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        k = min(5, len(w))
        sets[i] = frozenset(tuple(w[a:a + k]) for a in range(len(w) - k + 1)) if w else frozenset()
    ids = sorted(sets)
    links, parent = collections.Counter(), {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (root(i), links[i]) for i in ids}


def test_jaccard_brute_force(documents, monkeypatch):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 9999)}"
            rows.append((len(rows), (" " if g % 2 else "\n\t ").join(copy)))
    rows += [(len(rows), None), (len(rows) + 1, "  ")]
    got = by_id(jaccard.op8_jaccard(documents(rows, extra=("n", "rep", "bands"))))
    assert {i: (r["class_id"], r["n_links"]) for i, r in got.items()} == brute_links(rows)
    kept = {r["doc_id"] for r in jaccard.keep_one(documents(rows, extra=("row",))).collect()}
    assert kept == {r["class_id"] for r in got.values()}


def test_jaccard_tiles(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 8)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        copy = list(base)
        copy[rng.randrange(80)] = f"y{i}"
        rows.append((i, " ".join(copy)))
    got = by_id(jaccard.op8_jaccard(documents(rows)))
    assert {i: (r["class_id"], r["n_links"]) for i, r in got.items()} == brute_links(rows)


def test_jaccard_odd(odd, documents):
    got = jaccard.op8_jaccard(odd).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 3, 4, 5, 6] and all(r["n_links"] == 0 for r in got)
    assert jaccard.op8_jaccard(documents([])).collect() == []
    assert jaccard.keep_one(odd).columns == odd.columns and jaccard.keep_one(odd).count() == 7


def test_pruning_bounds_are_safe():
    least = jaccard.least_matches()
    assert len(least) == jaccard.BANDS * jaccard.ROWS // jaccard.CHUNK and all(a <= b for a, b in zip(least, least[1:], strict=False))
    assert 0 < least[-1] < 0.8 * 128


# 9 repeated strings -------------------------------------------------------

def brute_repeats(rows, keep_first=False):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.defaultdict(list)
    for k, (_, b) in enumerate(raw):
        for p in range(len(b) - 399):
            seen[b[p:p + 400]].append((k, p))
    out = {}
    for k, (i, b) in enumerate(raw):
        mark = bytearray(len(b))
        for p in range(len(b) - 399):
            where = seen[b[p:p + 400]]
            if len(where) > 1 and not (keep_first and where[0] == (k, p)):
                mark[p:p + 400] = b"\1" * 400
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        runs = sum(1 for p in range(len(mark)) if mark[p] and (p == 0 or not mark[p - 1]))
        out[i] = (len(b), sum(mark), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeat_rows():
    rng = random.Random(12)
    passage = ["".join(rng.choice("abcdé fgh") for _ in range(n)) for n in (380, 420, 700, 1500)]
    rows = []
    for i in range(40):
        parts = ["".join(rng.choice("xyzuv ") for _ in range(rng.randint(0, 500))) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passage)
            a = rng.randint(0, 60)
            parts.insert(rng.randint(0, 3), p[a:len(p) - rng.randint(0, 60)])
        rows.append((i, "".join(parts)))
    rows += [(40, "q" * 1300), (41, "spam " * 300), (42, None), (43, ""), (44, rows[3][1]), (45, rows[3][1]), (46, "q" * 401)]
    return rows


@pytest.mark.parametrize("hot", [20_000, 1])
@pytest.mark.parametrize("keep_first", [False, True])
def test_repeats_brute_force(documents, monkeypatch, hot, keep_first):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = repeat_rows()
    got = by_id(repeats.deduplicate(documents(rows, extra=("k1", "t", "spans")).repartition(5), keep_first))
    want = brute_repeats(rows, keep_first)
    assert {i: tuple(r)[1:5] for i, r in got.items()} == want


def test_repeats_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = sum(repeats.stretches(raw)[3])
    monkeypatch.setattr(repeats, "PIECE", 700)
    a, _, first, n, _ = repeats.stretches(raw)
    assert n.sum() == whole == 5000 - 399 and sorted(x for f, k in zip(first, n, strict=True) for x in range(f, f + k)) == list(range(4601))


def brute_shared(rows):
    """Rows of which some 50 words, or some 16, stand in another row too."""
    def strings(text, n):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        return {tuple(words[p:p + n]) for p in range(len(words) - n + 1)}
    out = {}
    for n in (50, 16):
        each = [strings(t, n) for _, t in rows]
        seen = collections.Counter(s for one in each for s in one)
        out[n] = [any(seen[s] > 1 for s in one) for one in each]
    return out


def test_repeats_shorter_than_400_bytes(documents):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(3, 6)))
    fill = lambda n: [word() for _ in range(n)]
    passages = [fill(n) for n in (50, 51, 55, 59, 15, 15)]
    rows = []
    for i in range(36):
        blank = rng.choice([" ", "\n", " \t"])
        rows.append((i, blank.join([*fill(rng.randint(0, 200)), *passages[i % 6], *fill(rng.randint(0, 200))])))
    rows += [(36, " ".join(fill(300))), (37, " ".join(fill(60))), (38, "la " * 90), (39, None), (40, rows[36 - 30][1]), (40, rows[36 - 30][1])]
    got = repeats.deduplicate(documents(rows, extra=("key", "string", "n_shared")).repartition(5)).drop("kept").collect()
    shared = {r["doc_id"]: r["n_shared"] for r in got}
    want = brute_shared(rows)
    assert len(got) == len(rows) and sum(want[50]) == 26
    assert all(shared[i] > 0 for (i, _), is_so in zip(rows, want[50], strict=True) if is_so)
    assert all(shared[i] == 0 for (i, _), is_so in zip(rows, want[16], strict=True) if not is_so)
    whole = repeats.chosen_strings(np.frombuffer(rows[6][1].encode(), np.uint8))
    assert shared[40] == shared[6] == len(whole)


def test_repeats_strings_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    raw = rng.choice(np.frombuffer(b"abc \n", np.uint8), 4000)
    raw[1000:1300] = 97
    whole, words = repeats.chosen_strings(raw), repeats._words(raw)
    monkeypatch.setattr(repeats, "PIECE", 200)
    pieces = repeats._words(raw)
    assert len(pieces) == len(words) == len(raw.tobytes().split()) and (pieces != words).sum() == 1
    monkeypatch.setattr(repeats, "PIECE", 350)
    assert (repeats.chosen_strings(raw) == whole).all()


def test_repeats_odd(odd, documents):
    got = repeats.op9_repeats(odd)
    assert got.count() == odd.count()
    assert repeats.op9_repeats(documents([])).collect() == []


# 10 outliers --------------------------------------------------------------

def base_counts(text):
    text = text or ""
    w = words_of(text)
    grams = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words_of(x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_outlier_base_counts(documents, small):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("ab \n\t#|é") for _ in range(rng.randint(0, 300)))) for i in range(200)]
    rows += [(r["doc_id"] + 1000, r["text"]) for r in small.collect()]
    got = by_id(outliers.judge(documents(rows, extra=("w", "lines", "m0"))))
    for i, text in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base_counts(text)


def brute_mcd(x):
    """The operator's estimate in numpy: two starts, concentration steps on whole bins, smaller determinant."""
    d, ridge = x.shape[1], np.diag(outliers.RIDGE)

    def bins(m, c):
        z = np.linalg.solve(c, (x - m).T)
        return np.floor(np.log(np.maximum((z ** 2).sum(0), 1e-6)) * outliers.BINS_PER_E)

    def half(b):
        return b <= np.sort(b)[(len(x) + d + 1) // 2 - 1]
    med = np.percentile(x, 50, axis=0, method="inverted_cdf")
    mad = np.percentile(np.abs(x - med), 50, axis=0, method="inverted_cdf")
    starts = [(x.mean(0), np.linalg.cholesky(np.cov(x.T, bias=True) + ridge)),
              (med, np.diag(np.sqrt((mad * 1.4826) ** 2 + np.array(outliers.RIDGE))))]
    ends = []
    for m, c in starts:
        for _ in range(outliers.STEPS):
            near = x[half(bins(m, c))]
            m, c = near.mean(0), np.linalg.cholesky(np.cov(near.T, bias=True) + ridge)
        ends.append((2 * np.log(np.diag(c)).sum(), m, c))
    _, m, c = min(ends, key=lambda e: e[0])
    b = bins(m, c)
    scale = np.exp((np.sort(b)[(len(x) + d + 1) // 2 - 1] + 1) / outliers.BINS_PER_E)
    z = np.linalg.solve(c, (x - m).T)
    return (z ** 2).sum(0) / max(scale, outliers.CHI2_MEDIAN / 4) * outliers.CHI2_MEDIAN


def test_outlier_distances_equal_numpy(documents):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        n = rng.randint(60, 300)
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(n)]
        if i % 10 == 0:
            w = [x + "#%" for x in w]
        rows.append((i, " ".join(w), "en", "s" if i < 80 else None))
    df = documents(rows)
    got = by_id(outliers.judge(df))
    vectors = by_id(outliers.vector(outliers.statistics(df)))
    for ids in (range(80), range(80, 120)):
        want = brute_mcd(np.array([[vectors[i][f"x{k}"] for k in range(4)] for i in ids]))
        assert np.allclose([got[i]["distance"] for i in ids], want, rtol=1e-6)
    assert all(got[i]["kept"] == (i % 10 != 0) for i in range(120))


@pytest.mark.parametrize("spread", [False, True])
def test_outlier_in_one_statistic_alone(documents, spread):
    rng = random.Random(8)
    rows, fresh = [], iter(range(10 ** 6))

    def distinct(n, longest, symbols=0.0):
        return [f"{next(fresh):06d}"[:6] + "x" * rng.randint(0, longest) + ("#" if rng.random() < symbols else "") for _ in range(n)]

    def lines(w, per):
        return "\n".join(" ".join(w[k:k + per]) for k in range(0, len(w), per))
    for i in range(200):
        rows.append((i, lines(distinct(200, rng.randint(0, 12) if spread else 4, rng.random() * 0.5 if spread else 0.0), 10)))
    a = "same line"
    rows.append((500, "\n".join(a + "\n" + " ".join(distinct(5, 4, 0.25 * spread)) for _ in range(30))))
    phrase = distinct(44, 4, 0.25 * spread)
    rows.append((501, lines(phrase + distinct(110, 4, 0.25 * spread) + phrase, 13)))
    got = by_id(outliers.judge(documents(rows)))
    assert got[500]["n_dup_lines"] == 29 and got[500]["n_repeat_words"] == 0
    assert got[501]["n_dup_lines"] == 0 and got[501]["n_repeat_words"] == 88
    assert not got[500]["base_failed"] and not got[501]["base_failed"]
    assert not got[500]["kept"] and not got[501]["kept"]
    assert sum(got[i]["kept"] for i in range(200)) >= 190


def test_outlier_odd(odd, documents):
    got = outliers.judge(odd).collect()
    assert len(got) == odd.count() and not any(r["kept"] for r in got)
    assert outliers.judge(documents([])).collect() == []
    few = outliers.judge(documents([(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(3)])).collect()
    assert all(r["kept"] and r["distance"] is None for r in few)
