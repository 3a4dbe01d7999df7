"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained from labelled texts (a bounded hash sample per
class).  A text is compressed in pieces once with each; the difference of the
two total sizes over the text's bytes says which dictionary explains it better, and a
logistic curve, fitted on the labelled sample, turns that number into a score.
Pieces keep a long text from compressing by its own history alone; every piece
of the whole text counts.

Scale: the sample is bounded by SAMPLE_DOCS documents of at most
SAMPLE_BYTES bytes per class; scoring is one Arrow pass without shuffle.
Defined cases: null and empty texts have difference 0 and the curve's value
there (the sample's average); documents labelled both ways and labels that are null are not learned
from; with one class only, every score is that class's; with none, 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import hash_sample, sample_fraction

#: Bounds of the sample a class is learned from.
SAMPLE_DOCS, SAMPLE_BYTES = 2000, 16_384
DICTIONARY_BYTES = 256 * 1024
PIECE_BYTES = 1024
#: Bytes of average text that a text's difference is smoothed with: a few bytes say little.
SMOOTH_BYTES = 64
LEVEL = 3
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learnable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and quality of the labelled documents that may be learned from."""
    marks = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    rows = docs.select("doc_id", "text").where(
        ~held_out(F.col("doc_id")) & (F.octet_length("text") > 0) & (F.octet_length("text") <= SAMPLE_BYTES))
    return rows.join(marks, "doc_id")


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained dictionary; with too little text for training, the text itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s[i:i + PIECE_BYTES] for s in samples
                                                             for i in range(0, len(s), PIECE_BYTES)])
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def differences(texts: list[bytes], good: bytes, bad: bytes, average: float = 0.0) -> np.ndarray:
    """(bad size - good size) / bytes of every text, smoothed by SMOOTH_BYTES of ``average``."""
    pack = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_dict_id=False,
                                     write_content_size=False).compress for d in (good, bad)]
    empty = [len(p(b"")) for p in pack]
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        g = b = 0
        for at in range(0, len(text), PIECE_BYTES):
            piece = text[at:at + PIECE_BYTES]
            g += len(pack[0](piece)) - empty[0]
            b += len(pack[1](piece)) - empty[1]
        out[i] = (b - g + SMOOTH_BYTES * average) / (len(text) + SMOOTH_BYTES)
    return out


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve by Newton steps with a small ridge; ``weight`` restores the classes' proportion."""
    w = weight / weight.sum()
    scale = max(float(np.abs(x).max()), 1e-9)
    a, b = 0.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x / scale + b, -30, 30)))
        g = np.array([(w * (p - y) * x / scale).sum() + 1e-4 * a, (w * (p - y)).sum() + 1e-4 * b])
        v = w * p * (1 - p)
        h = np.array([[(v * (x / scale) ** 2).sum() + 1e-4, (v * x / scale).sum()], [(v * x / scale).sum(), v.sum() + 1e-4]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    return a / scale, b


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model: {'good', 'bad': dictionary bytes, 'slope', 'intercept'} or {'constant': score}."""
    rows = learnable(docs, labels)
    counts = {r["quality"]: r["count"] for r in rows.select("quality").groupBy("quality").count().collect()}
    if len(counts) < 2:
        return {"constant": float(next(iter(counts), 0.5))}
    texts, fraction = {}, {}
    for quality in (0, 1):
        fraction[quality] = sample_fraction(counts[quality], SAMPLE_DOCS)
        part = hash_sample(rows.where(F.col("quality") == quality), F.col("doc_id"), fraction[quality])
        texts[quality] = sorted(r["text"].encode() for r in part.select("text").collect())
        if not texts[quality]:
            return {"constant": float(1 - quality)}
    # One half of each class makes the dictionaries, the other half fits the curve.
    halves = {q: (t[::2], t[1::2] or t[::2]) for q, t in texts.items()}
    good, bad = (dictionary(halves[q][0]).as_bytes() for q in (1, 0))
    fitted = halves[1][1] + halves[0][1]
    x = differences(fitted, good, bad)
    y = np.array([1] * len(halves[1][1]) + [0] * len(halves[0][1]))
    weight = np.where(y == 1, 1 / fraction[1], 1 / fraction[0])
    average = float((x * weight).sum() / weight.sum())
    x = x + SMOOTH_BYTES * average / (np.array([len(t) for t in fitted]) + SMOOTH_BYTES)
    slope, intercept = calibrate(x, y, weight)
    return {"good": good, "bad": bad, "average": average, "slope": float(slope),
            "intercept": float(intercept)}


def score(text: Column, model: dict) -> Column:
    """Score in 0..1 of a text column."""
    if "constant" in model:
        return F.lit(model["constant"])

    @F.pandas_udf("double")
    def difference(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(differences([(t or "").encode("utf-8", "replace") for t in texts], model["good"], model["bad"], model["average"]))

    raw = F.lit(model["slope"]) * difference(text) + F.lit(model["intercept"])
    return 1 / (1 + F.exp(-raw))


def op7_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: documents that the classifier accepts."""
    model = fit(docs, labels)
    row = docs.select(F.struct(*docs.columns).alias("row"))
    return row.where(score(F.col("row.text"), model) >= THRESHOLD).select("row.*")
