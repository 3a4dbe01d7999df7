"""Toxicity scores: held-out accuracy, a plain restatement of the score, defined cases."""

import math
import os
import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from daybook.llm import toxicity
from daybook.llm.common import read_table

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(documents, spark):
    """600 short texts, a third toxic: a few marked words among invented ones."""
    rng = random.Random(11)
    syllables = ["ba", "ter", "lo", "min", "qua", "es", "ti", "on", "re", "va"]
    marked = ["grobnax", "zwilk", "frumpt"]
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(rng.randint(20, 80))]
        if i % 3 == 0:
            for _ in range(5):
                words[rng.randrange(len(words))] = rng.choice(marked)
        rows.append((i, " ".join(words)))
        labels.append((i, None, int(i % 3 == 0)))
    return documents(rows), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    rows = toxicity.op12_toxicity(docs, labels).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(600)}
    held = [r for r in rows if r["held_out"]]
    right = [r["predicted"] == (r["doc_id"] % 3 == 0) for r in held]
    assert sum(right) / len(right) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_score_restated(corpus, spark, documents):
    """Windows, both compressions, weights and curve written out for one text after the other."""
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    texts = ["", " \n ", "grobnax zwilk terlo", "x" * 500, "ünï \U0001F600 " * 40] + [r["text"] for r in docs.limit(20).collect()]
    scored = documents(list(enumerate(texts))).withColumn("s", toxicity.score(F.col("text"), model))
    got = {r["doc_id"]: r["s"] for r in scored.collect()}
    found = model["dictionaries"]
    held = [zstandard.ZstdCompressionDict(found.base + own, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for own in (found.ordinary, found.toxic)]
    search = zstandard.ZstdCompressionParameters(window_log=20, chain_log=20, hash_log=20, search_log=5, min_match=6, target_length=32,
                                                 strategy=6, write_content_size=False, write_dict_id=False)
    for d in held:
        d.precompute_compress(compression_params=search)
    pack = [zstandard.ZstdCompressor(dict_data=d, compression_params=search) for d in held]
    for i, text in enumerate(texts):
        data, at, total = text.encode(), 0, 0.0
        while True:
            while at < len(data) and data[at:at + 1] in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"):
                at += 1
            if at == len(data):
                break
            end = at + toxicity.WINDOW
            if end >= len(data):
                end = len(data)
            while end < len(data) and end < at + toxicity.WINDOW + toxicity.LONGEST and data[end:end + 1].strip():
                end += 1
            sizes = [len(p.compress(data[at:end])) for p in pack]
            d = min(max(sizes[0] - sizes[1], toxicity.LEAST), toxicity.MOST)
            total += model["weights"][d - toxicity.LEAST]
            at = end
        want = 1 / (1 + math.exp(-(model["slope"] * total + model["intercept"])))
        assert got[i] == pytest.approx(want, abs=1e-9), text[:40]


def test_windows_cover_every_word():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("ab \n.") for _ in range(rng.randint(0, 300))).encode()
        parts = toxicity.windows(text)
        assert b"".join(b"".join(parts).split()) == b"".join(text.split())
        assert all(len(w) <= toxicity.WINDOW + toxicity.LONGEST for w in parts)
    assert toxicity.windows(b"") == []


def test_defined_cases(spark, documents, odd, corpus):
    none = spark.createDataFrame([], LABELS)
    assert toxicity.op12_toxicity(documents([]), none).collect() == []
    rows = toxicity.op12_toxicity(odd, none).collect()
    assert len(rows) == odd.count() and {r["score"] for r in rows} == {0.5}
    one = spark.createDataFrame([(4, 1, 1), (4, 1, 1), (6, 1, 1)], LABELS)
    assert {r["score"] for r in toxicity.op12_toxicity(odd, one).collect()} == {1.0}
    both = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (6, 1, None), (None, 1, 1)], LABELS)
    assert {r["score"] for r in toxicity.op12_toxicity(odd, both).collect()} == {0.5}
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    again = toxicity.fit(docs.union(docs).repartition(7), labels)
    assert (again["weights"] == model["weights"]).all() and again["slope"] == model["slope"]
    few = spark.createDataFrame([(4, 1, 1), (6, 1, 0)], LABELS)
    assert len(toxicity.op12_toxicity(odd, few).collect()) == odd.count()


def test_labels_of_held_out_rows_are_not_used(corpus, spark):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", labels["toxic"].bitwiseXOR(toxicity.held_out(labels["doc_id"]).cast("int")))
    first, second = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert (first["weights"] == second["weights"]).all()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no testdata")
def test_testdata_held_out(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    marks = labels.where("toxic IS NOT NULL").select("doc_id", "toxic")
    rows = toxicity.op12_toxicity(docs.join(marks, "doc_id"), labels).join(marks, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) / len(toxic) > 0.6 and sum(clean) / len(clean) < 0.15
