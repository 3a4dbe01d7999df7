"""Toxicity by compression distance: a toxic and an ordinary zstandard dictionary, compared window by window.

A text is cut at word ends into windows of about WINDOW bytes.  Each window is
compressed once with the dictionary of ordinary and once with that of toxic text;
the difference of the two lengths says which one explains it better.

Both dictionaries begin with the same ordinary text, so that what they differ in is
the few kilobytes after it, trained from windows of labelled texts.  A toxic text
has mostly ordinary windows, so the windows to train from are mined: of every text
of a fold the MINED ones that the dictionaries of the other fold (at first: the
ordinary text alone) set apart most, for both classes alike.  Labels of texts thus
never decide over their own windows.  Of three parts of the labelled texts each is
mined, and measured, with dictionaries made from the other two; the final ones are
trained from all that was mined.

Thresholds are calibrated on those measures: the log ratio of how often a difference
occurs in toxic and in ordinary texts (each difference is a threshold with a weight
of its own), summed over a text's windows, and a logistic curve that makes the sum a score.  The curve takes both classes as equally common
(TOXIC_SHARE): calibrated for a tenth of toxic texts, a score of 0.5 would miss a
third of them, as a few toxic words in a long text prove little.

Scale: the sample is bounded by SAMPLE_DOCS distinct documents of at most
SAMPLE_BYTES bytes per class, and is all that reaches the driver; the model is
about BASE_BYTES.  Scoring is one Arrow pass without shuffle over every window of
every whole text.
Defined cases: null and empty texts have no windows and get the curve's value at 0;
a word beyond WINDOW + LONGEST bytes is cut; repeated rows are learned from once;
documents labelled both ways and labels that are null are not learned from; with
one class only, every score is that class's; with none, 0.5; an empty table gives no
rows; columns besides doc_id and text (doc_id and toxic of the labels) are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import hash_sample, sample_fraction
from daybook.llm.quality import calibrate

#: Bounds of the sample a class is learned from.
SAMPLE_DOCS, SAMPLE_BYTES = 2000, 16_384
#: Bytes of a window, and how far a word may run past it.
WINDOW, LONGEST = 24, 40
BASE_BYTES, OWN_BYTES = 512 * 1024, 4 * 1024
#: zstandard's search, the same whatever the dictionary's size: a binary tree, 2**5 tries, matches of six bytes at least (shorter ones are
#: chance in either dictionary).
SEARCH = {"window_log": 20, "chain_log": 20, "hash_log": 20, "search_log": 5, "min_match": 6, "target_length": 32,
          "strategy": zstandard.STRATEGY_BTLAZY2}
MINED, ROUNDS = 6, 2
#: Segment and hashed-substring length of the dictionary trainer.
SEGMENT, SUBSTRING = 24, 6
#: Differences beyond these count as these.
LEAST, MOST = -8, 16
THRESHOLD = 0.5
#: Share of toxic texts the score is calibrated for.
TOXIC_SHARE = 0.5

_WINDOW = re.compile(rb"\S(?:.{%d}\S{0,%d}|.*)" % (WINDOW - 1, LONGEST), re.S)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def windows(text: bytes) -> list[bytes]:
    return _WINDOW.findall(text)


def packer(dictionary: bytes) -> Callable[[bytes], bytes]:
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    search = zstandard.ZstdCompressionParameters(write_content_size=False, write_dict_id=False, write_checksum=False, **SEARCH)
    held.precompute_compress(compression_params=search)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=search).compress


class Dictionaries:
    """The ordinary text both share, and what either class adds to it."""

    def __init__(self, base: bytes, ordinary: bytes = b"", toxic: bytes = b""):
        self.base, self.ordinary, self.toxic = base, ordinary, toxic
        self._packed = None

    def __getstate__(self):
        return self.base, self.ordinary, self.toxic

    def __setstate__(self, state):
        self.__init__(*state)

    def differences(self, parts: list[bytes]) -> list[int]:
        """Ordinary minus toxic compressed length of every window."""
        if self._packed is None:
            self._packed = packer(self.base + self.ordinary), packer(self.base + self.toxic)
        ordinary, toxic = self._packed
        return [len(ordinary(w)) - len(toxic(w)) for w in parts]


def trained(parts: list[bytes]) -> bytes:
    """At most OWN_BYTES of what recurs in windows; with too few for training, the windows themselves."""
    try:
        return zstandard.train_dictionary(OWN_BYTES, [w + b" " for w in parts], k=SEGMENT, d=SUBSTRING).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(parts)[-OWN_BYTES:]


def most(texts: list[bytes], measure: Callable[[list[bytes]], list[float]]) -> list[bytes]:
    """The MINED windows of every text with the largest measure, the largest of all first."""
    found = []
    for text in texts:
        parts = list(dict.fromkeys(windows(text)))
        found += sorted(zip(measure(parts), parts), reverse=True)[:MINED]
    return [w for _, w in sorted(found, reverse=True)]


def base_of(ordinary: list[list[bytes]]) -> bytes:
    return b"".join(t for fold in zip(*ordinary) for t in fold)[:BASE_BYTES]


def dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> Dictionaries:
    """Dictionaries from two folds of texts of either class."""
    base = base_of(ordinary)
    plain = packer(base)

    def bare(parts: list[bytes]) -> list[float]:
        return [len(plain(w)) / (len(w) + 8) for w in parts]

    measures = [bare, bare]
    for k in range(ROUNDS):
        mined = [(most(ordinary[f], measures[f]), most(toxic[f], measures[f])) for f in (0, 1)]
        if k < ROUNDS - 1:
            # What one fold taught picks the windows of the other.
            measures = [Dictionaries(base, trained(o), trained(t)).differences for o, t in reversed(mined)]
    return Dictionaries(base, trained(mined[0][0] + mined[1][0]), trained(mined[0][1] + mined[1][1]))


def cross_fitted(parts: dict[int, list[list[bytes]]]) -> tuple[Dictionaries, dict[int, list[np.ndarray]]]:
    """Dictionaries from all three parts, and every text's window levels by those of the parts it is not in."""
    levels, mined = {0: [], 1: []}, {0: [], 1: []}
    for k in range(3):
        others = [j for j in range(3) if j != k]
        found = dictionaries([parts[1][j] for j in others], [parts[0][j] for j in others])
        for q in (0, 1):
            levels[q] += [level(found.differences(windows(t))) for t in parts[q][k]]
            mined[q] += most(parts[q][k], found.differences)
    return Dictionaries(base_of(parts[0]), trained(mined[0]), trained(mined[1])), levels


def level(differences: list[int]) -> np.ndarray:
    return np.clip(np.array(differences, dtype=np.int64), LEAST, MOST) - LEAST


def learnable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, content (a hash of the text) and toxic of the labelled documents that may be learned from."""
    marks = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").drop("other")
    rows = docs.where(
        ~held_out(F.col("doc_id")) & (F.octet_length("text") > 0) & (F.octet_length("text") <= SAMPLE_BYTES)).select(
            "doc_id", F.xxhash64("text").alias("content"))
    return rows.join(marks, "doc_id")


def sample(docs: DataFrame, labels: DataFrame) -> dict[int, list[bytes]]:
    """About SAMPLE_DOCS distinct texts of either class; texts move only once they are chosen."""
    rows = learnable(docs, labels).groupBy("toxic", "content").agg(F.min("doc_id").alias("doc_id"))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    chosen = [hash_sample(rows.where(F.col("toxic") == q), F.col("content"), sample_fraction(n, SAMPLE_DOCS)) for q, n in sorted(counts.items())]
    if not chosen:
        return {}
    picked = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    # About twice SAMPLE_DOCS rows of three numbers, whatever the tables' size.
    texts = docs.select("doc_id", F.xxhash64("text").alias("content"), "text").join(F.broadcast(picked), ["doc_id", "content"])
    found = texts.select("toxic", "content", "text").distinct().orderBy("content", "text").collect()
    return {q: part for q in (0, 1) if (part := [r["text"].encode() for r in found if r["toxic"] == q])}


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model: {'dictionaries', 'weights', 'slope', 'intercept'} or {'constant': score}."""
    texts = sample(docs, labels)
    if len(texts) < 2:
        return {"constant": float(next(iter(texts), 0.5))}
    parts = {q: [texts[q][k::3] or texts[q] for k in range(3)] for q in (0, 1)}
    found, levels = cross_fitted(parts)
    seen = {q: np.bincount(np.concatenate(levels[q]), minlength=MOST - LEAST + 1) for q in (0, 1)}
    # Every difference counts as seen once more, in the proportion of the classes' windows.
    odds = {q: seen[q] + seen[q].sum() / max(seen[0].sum(), seen[1].sum(), 1) for q in (0, 1)}
    weights = np.log(odds[1] / odds[1].sum()) - np.log(odds[0] / odds[0].sum()) if all(s.sum() for s in seen.values()) else np.zeros(MOST - LEAST + 1)
    x = np.array([weights[at].sum() for q in (0, 1) for at in levels[q]])
    y = np.array([q for q in (0, 1) for _ in levels[q]])
    slope, intercept = calibrate(x, y, np.where(y == 1, TOXIC_SHARE / len(levels[1]), (1 - TOXIC_SHARE) / len(levels[0])))
    return {"dictionaries": found, "weights": weights, "slope": float(slope), "intercept": float(intercept)}


def score(text: Column, model: dict) -> Column:
    """Score in 0..1 of a text column."""
    if "constant" in model:
        return F.lit(model["constant"])
    found, weights = model["dictionaries"], model["weights"]

    @F.pandas_udf("double")
    def sums(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([float(weights[level(found.differences(windows(t or b"")))].sum()) for t in texts], dtype="float64")

    raw = F.lit(model["slope"]) * sums(text.cast("binary")) + F.lit(model["intercept"])
    return 1 / (1 + F.exp(-raw))


def op12_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's query."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
