"""Exact removal of repeated byte strings by longest-previous-factor tests in suffix order.

A position's longest previous (next) factor reaches MIN_BYTES exactly if, in
suffix order with equal MIN_BYTES-prefixes tied by position, the entry before
(after) it has the same prefix: that neighbour is the previous (next) smaller
position's match.  So only suffixes that share their first MIN_BYTES bytes
have to meet, and the suffix order is built piecewise:

1. Every MIN_BYTES window is filed under its leftmost smallest SEED_BYTES-gram
   hash (its anchor).  Equal windows have equal anchors at equal offsets.
   Consecutive windows with one anchor form a stretch; one row per stretch.
2. Stretches are counted by (anchor, content).  An anchor with one stretch
   repeats nothing; a content that occurs twice repeats all its windows.
3. Under anchors with several contents, the windows of one stretch per content
   are put in suffix order and compared with their neighbours.  Anchors with
   more than HOT contents are counted window by window with partial
   aggregates instead, so no group is gathered whole.
4. Every occurrence of a stretch gets its repeated windows; their bytes are
   removed (all copies; with ``keep_first`` the first copy, by doc_id and
   offset, stays, i.e. only longest previous factors count).

Contents are compared by two independent 64-bit hashes of anchor and window,
never over the whole corpus by one.

Passages shorter than MIN_BYTES stay; ``n_shared`` tells of them.  Of every
SHARED_WINDOW neighbouring strings of SHARED_WORDS words the one of least hash
is chosen, and ``n_shared`` counts a text's different chosen strings that
another row has chosen as well.  Equal passages choose alike, so any 50 words
(SHARED_WORDS + SHARED_WINDOW - 1) that another row holds too count, whatever
white space parts them, and no string below SHARED_WORDS words does.  These
strings are compared by one 64-bit hash.

Scale: step 1 leaves about one row per 170 bytes, of four numbers: anchor,
content, the text's number in the written table, and the stretch's place in it
packed into one number.  A text's number is exchanged for its identity (doc_id
and two digests) only for the few lists per text that go back to it; texts are
shuffled for step 3 and for the removal by the same keys (one exchange, reused).  Defined cases:
null text is empty and keeps the digest of no bytes; texts shorter than
MIN_BYTES lose nothing; repeated rows are copies of each other; null doc_ids
come first; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import scratch_path

MIN_BYTES, SEED_BYTES = 400, 64
SHARED_WORDS, SHARED_WINDOW = 16, 35
#: Contents of one anchor that a task compares in memory; more are counted by Spark.
HOT = 20_000
#: Bytes of a text handled at once (longer texts in overlapping pieces).
PIECE = 1 << 22
#: Windows compared at once, which bounds a worker's memory (whole anchors are compared, so the last one may add up to HOT contents).
WINDOWS = 1 << 19

U64 = np.uint64
BASES = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
POSITION_BITS = U64(28)
#: A place is (first window, windows, anchor's offset); the last two have this many bits each, and MIN_BYTES is below 2**PLACE_BITS.
PLACE_BITS = 10


@lru_cache(maxsize=4)
def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    base = BASES[which]
    up, down = np.full(n, base, U64), np.full(n, U64(pow(int(base), -1, 1 << 64)), U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Sums:
    """Prefix sums that give the hash of any slice of a byte string."""

    def __init__(self, raw: np.ndarray, which: int):
        self.up, self.down = _powers(which, 1 << max(16, int(len(raw)).bit_length()))
        self.sums = np.zeros(len(raw) + 1, U64)
        np.cumsum((raw.astype(U64) + U64(1)) * self.up[:len(raw)], out=self.sums[1:])

    def of(self, start, stop):
        return (self.sums[stop] - self.sums[start]) * self.down[start]


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    m = len(v) - w + 1
    x = np.concatenate([v, np.full((-len(v)) % w, np.iinfo(U64).max, U64)]).reshape(-1, w)
    before = np.minimum.accumulate(x, axis=1).ravel()
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:m], before[w - 1:w - 1 + m])


def stretches(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, content hash, first window, windows, anchor's offset in the first window) of a text."""
    parts = []
    for at in range(0, max(1, len(raw) - MIN_BYTES + 1), PIECE):
        piece = raw[at:at + PIECE + MIN_BYTES - 1]
        if len(piece) < MIN_BYTES:
            continue
        one = Sums(piece, 0)
        grams = np.arange(len(piece) - SEED_BYTES + 1)
        h = _mix((one.sums[SEED_BYTES:] - one.sums[:-SEED_BYTES]) * one.down[:len(grams)])
        least = _sliding_min(((h >> POSITION_BITS) << POSITION_BITS) | grams.astype(U64), MIN_BYTES - SEED_BYTES + 1)
        where = (least & ((U64(1) << POSITION_BITS) - U64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        count = np.diff(np.concatenate([first, [len(where)]]))
        anchor = where[first]
        content = _mix(Sums(piece, 1).of(first, first + count + MIN_BYTES - 1)
                       + _mix((anchor - first).astype(U64) * U64(1 << 32) + count.astype(U64)))
        parts.append((h[anchor], content, first + at, count, anchor - first))
    if not parts:
        return tuple(np.empty(0, t) for t in (U64, U64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


ANCHORS = "uid long, doc_id long, k1 long, k2 long, anchor long, content long, place long"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            some = batch.slice(at, 256)
            found = [stretches(np.frombuffer(t.as_buffer(), np.uint8)) for t in some["t"]]
            text = pa.array(np.repeat(np.arange(len(some)), [len(x[0]) for x in found]))
            a, c, first, n, offset = (np.concatenate(x) for x in zip(*found, strict=True))
            own = ["uid", "doc_id", "k1", "k2"]
            yield pa.RecordBatch.from_arrays(
                [*(some[k].take(text) for k in own), pa.array(a.view(np.int64)), pa.array(c.view(np.int64)),
                 pa.array((first << 2 * PLACE_BITS) + (n << PLACE_BITS) + offset)], [*own, "anchor", "content", "place"])


CONTENTS = "anchor long, content long, n long, at_id long, at_uid long, at_first long, windows int, offset int, hot boolean, raw binary"
CONTENTS_ARROW = pa.schema([
    *((name, pa.int64()) for name in ("anchor", "content", "n", "at_id", "at_uid", "at_first")),
    ("windows", pa.int32()), ("offset", pa.int32()), ("hot", pa.bool_()), ("raw", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted stretches of each text."""
    for batch in batches:
        out = []
        for k in range(len(batch)):
            raw = batch["t"][k].as_py()
            for w in batch["wanted"][k].as_py():
                first, windows = w["place"] >> 2 * PLACE_BITS, (w["place"] >> PLACE_BITS) % (1 << PLACE_BITS)
                out.append((w["anchor"], w["content"], w["n"], w["at_id"], w["at_uid"], first, windows, w["place"] % (1 << PLACE_BITS),
                            w["hot"], raw[first:first + windows + MIN_BYTES - 1]))
            if len(out) >= 4096:
                yield _batch(out, CONTENTS_ARROW)
                out = []
        if out:
            yield _batch(out, CONTENTS_ARROW)


def _window_hashes(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, window in the row, hash of anchor, offset and content) of all windows of the rows."""
    # Few rows at a time: the tables of powers are as long as the bytes hashed together, and a worker keeps them.
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U64))]
    for begin in range(0, len(rows), 256):
        some = rows.iloc[begin:begin + 256]
        sizes = some["raw"].map(len).to_numpy(np.int64)
        counts = some["windows"].to_numpy(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        sums = Sums(np.frombuffer(b"".join(some["raw"]), np.uint8), 1)
        row = np.repeat(np.arange(len(some)), counts)
        window = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = starts[row] + window
        offset = some["offset"].to_numpy(np.int64)[row] - window
        anchor = some["anchor"].to_numpy(np.int64)[row].view(U64)
        parts.append((row + begin, window, _mix(sums.of(at, at + MIN_BYTES) + _mix(anchor + _mix(offset.astype(U64))))))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs(row: np.ndarray, window: np.ndarray, n_rows: int) -> list[list[int]]:
    """Per row the repeated windows as a flat list of first, last (inclusive), ..."""
    out: list[list[int]] = [[] for _ in range(n_rows)]
    if len(row):
        cut_at = np.flatnonzero((np.diff(row) != 0) | (np.diff(window) != 1)) + 1
        for a, b in zip(np.concatenate([[0], cut_at]), np.concatenate([cut_at, [len(row)]]), strict=True):
            out[row[a]] += [int(window[a]), int(window[b - 1])]
    return out


def in_suffix_order(rows: pd.DataFrame, keep_first: bool) -> pd.DataFrame:
    """anchor, content, runs: the repeated windows of the stretches of whole anchors."""
    rows = rows.drop_duplicates(["anchor", "content"]).sort_values(
        ["at_id", "at_uid", "at_first"], na_position="first", kind="stable").reset_index(drop=True)
    row, window, h = _window_hashes(rows)
    # Rows are in order of position, so a stable sort ties equal prefixes by position.
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    previous, following = np.zeros(len(h), bool), np.zeros(len(h), bool)
    previous[order[1:]] = same
    following[order[:-1]] = same
    repeated = previous if keep_first else previous | following | (rows["n"].to_numpy()[row] > 1)
    hit = np.flatnonzero(repeated)
    out = rows[["anchor", "content"]].assign(runs=_runs(row[hit], window[hit], len(rows)))
    return out[out["runs"].map(len) > 0]


RUNS = "anchor long, content long, runs array<int>"


def _compare(keep_first: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Partitions are sorted by anchor; the last anchor of a batch waits for the next."""
        held: list[pd.DataFrame] = []
        waiting = 0
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512]
                held.append(part)
                waiting += int(part["windows"].sum())
                if waiting < WINDOWS:
                    continue
                rows = pd.concat(held)
                ready = rows["anchor"] != rows["anchor"].iloc[-1]
                held = [rows[~ready]]
                waiting = int(held[0]["windows"].sum())
                if ready.any():
                    yield in_suffix_order(rows[ready], keep_first)
        if held:
            rows = pd.concat(held)
            if len(rows):
                yield in_suffix_order(rows, keep_first)
    return run


def _hot_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 1024):
            rows = batch.iloc[at:at + 1024].reset_index(drop=True)
            row, window, h = _window_hashes(rows)
            yield pd.DataFrame({"anchor": rows["anchor"].to_numpy()[row], "content": rows["content"].to_numpy()[row],
                                "at_id": rows["at_id"].array[row], "at_uid": rows["at_uid"].to_numpy()[row], "at_place": rows["at_first"].to_numpy()[row] + window,
                                "n": rows["n"].to_numpy()[row], "window": window.astype(np.int32), "h": h.view(np.int64)})


def _hot_runs(hot: DataFrame, keep_first: bool) -> DataFrame:
    """The same for anchors with many contents, by partial aggregates of window hashes."""
    windows = hot.mapInPandas(_hot_windows, "anchor long, content long, at_id long, at_uid long, at_place long, n long, window int, h long")
    classes = windows.groupBy("anchor", "h").agg(
        F.sum("n").alias("occurrences"), F.min(F.struct("at_id", "at_uid", "at_place")).alias("head"))
    repeated = windows.join(classes, ["anchor", "h"])
    if keep_first:
        repeated = repeated.where(~F.struct("at_id", "at_uid", "at_place").eqNullSafe(F.col("head")))
    else:
        repeated = repeated.where("occurrences > 1")
    return repeated.groupBy("anchor", "content").agg(
        F.flatten(F.transform(F.sort_array(F.collect_set("window")), lambda w: F.array(w, w))).alias("runs"))


def _words(raw: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text, parted by ASCII white space."""
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    out = np.empty(len(start), U64)
    cuts = [*np.searchsorted(start, np.arange(0, len(raw), PIECE)), len(start)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b and stop[b - 1] - start[b - 1] > PIECE:  # a long word is hashed alone
            b -= 1
            out[b] = int.from_bytes(hashlib.blake2b(raw[start[b]:stop[b]], digest_size=8).digest(), "little")
        if a < b:
            out[a:b] = Sums(raw[start[a]:stop[b - 1]], 0).of(start[a:b] - start[a], stop[a:b] - start[a])
    return _mix(out + _mix((stop - start).astype(U64)))


def chosen_strings(raw: np.ndarray) -> np.ndarray:
    """Different hashes of the chosen strings of words of a text, sorted."""
    words = _words(raw)
    parts = []
    for at in range(0, len(words) - SHARED_WORDS - SHARED_WINDOW + 2, PIECE):
        some = words[at:at + PIECE + SHARED_WORDS + SHARED_WINDOW - 2]
        first = np.arange(len(some) - SHARED_WORDS + 1)
        parts.append(np.unique(_sliding_min(_mix(Sums(some, 1).of(first, first + SHARED_WORDS)), SHARED_WINDOW)))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, U64)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            some = batch.slice(at, 256)
            found = [chosen_strings(np.frombuffer(t.as_buffer(), np.uint8)) for t in some["t"]]
            keys = np.repeat(some["key"].to_numpy(), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate(found).view(np.int64))], ["key", "string"])


def _shared(texts: DataFrame) -> DataFrame:
    """n_shared of the texts (id, k1, k2) that have any."""
    identity = ["id", "k1", "k2"]
    key = F.xxhash64(*identity).alias("key")
    # Words of one byte and the white space between them are the shortest.
    least = 2 * (SHARED_WORDS + SHARED_WINDOW - 1) - 1
    strings = texts.where(F.octet_length("t") >= least).select(key, F.col("t").cast("binary").alias("t")).mapInArrow(_strings, "key long, string long")
    repeated = strings.groupBy("string").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("string")
    # Equal rows have one key: each brings its strings.
    rows = texts.groupBy(*identity).agg(F.count(F.lit(1)).alias("rows"))
    counts = strings.join(repeated, "string").groupBy("key").agg(F.count(F.lit(1)).alias("strings"))
    return rows.select(*identity, "rows", key).join(counts, "key").select(*identity, F.expr("strings div rows").alias("n_shared"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long, kept binary"
RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()), ("n_shared", pa.int64()), ("kept", pa.binary())])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, len(batch), 256):
            out = []
            for x in batch.slice(begin, 256).to_pylist():
                raw = x["t"]
                removed, n_spans, at, kept = 0, 0, 0, []
                merged: list[list[int]] = []
                for s in sorted(divmod(y, 1 << 31) for y in x["spans"] or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                for start, stop in merged:
                    kept.append(raw[at:start])
                    removed, n_spans, at = removed + stop - start, n_spans + 1, stop
                kept = b"".join([*kept, raw[at:]])
                out.append((x["doc_id"], len(raw), removed, n_spans, hashlib.sha256(kept).hexdigest(), x["n_shared"], kept))
            yield _batch(out, RESULT_ARROW)


def deduplicate(docs: DataFrame, keep_first: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared and kept (the remaining bytes) of every document."""
    spark = docs.sparkSession
    texts = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("id"), F.coalesce("text", F.lit("")).alias("t")).select(
        "id", F.xxhash64("t").alias("k1"), F.xxhash64(F.lit(1), "t").alias("k2"), "t")
    identity = ["id", "k1", "k2"]
    folder = scratch_path(spark, "stretches")
    texts.where(F.octet_length("t") >= MIN_BYTES).select(
        F.monotonically_increasing_id().alias("uid"), "id.doc_id", "k1", "k2", F.col("t").cast("binary").alias("t")).mapInArrow(_anchors, ANCHORS).write.parquet(folder)
    stored = spark.read.schema(ANCHORS).parquet(folder)
    # One row per text: its first stretch starts at 0.
    named = stored.where(F.col("place") < 1 << 2 * PLACE_BITS).select("uid", F.struct("doc_id").alias("id"), "k1", "k2")
    # The order of copies only matters where the first one stays; rows of equal doc_id and text are one place.
    where = ["doc_id", "k1", "k2", "place", "uid"] if keep_first else ["uid", "place"]
    rows = stored.select("anchor", "content", *where)

    contents = rows.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*where)).alias("at"))
    anchors = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"), F.sum("n").alias("total")).where("total > 1")
    known = contents.join(anchors, "anchor")
    wanted = known.where("contents > 1").select(F.col("at.uid").alias("uid"), F.struct(
        "anchor", "content", "n", (F.col("at.doc_id") if keep_first else F.lit(None).cast("long")).alias("at_id"), F.col("at.uid").alias("at_uid"),
        F.col("at.place").alias("place"), (F.col("contents") > HOT).alias("hot")).alias("one"))
    wanted = wanted.join(named, "uid")

    def fetched(some: DataFrame) -> DataFrame:
        lists = some.groupBy(*identity).agg(F.collect_list("one").alias("wanted"))
        return texts.join(lists, identity).select(F.col("t").cast("binary").alias("t"), "wanted").mapInArrow(_contents, CONTENTS)

    cool = fetched(wanted.where("NOT one.hot")).repartition("anchor").sortWithinPartitions("anchor").mapInPandas(_compare(keep_first), RUNS)
    hot = _hot_runs(fetched(wanted.where("one.hot")).dropDuplicates(["anchor", "content"]), keep_first)
    compared = cool.unionByName(hot)

    # Repeated windows of each content: compared ones, and all of those that occur more than once.
    verdicts = known.join(compared, ["anchor", "content"], "left").where("runs IS NOT NULL OR n > 1")
    verdicts = verdicts.select("anchor", "content", "at", "runs", "n") if keep_first else verdicts.select(
        "anchor", "content", F.when(F.col("n") == 1, F.col("runs")).alias("runs"))
    # Joined by one column, not by the two that the verdicts are dealt by: both sides are then plain exchanges, whose hot contents Spark splits.
    piece = F.struct("anchor", "content").alias("piece")
    found = rows.select(piece, *where).join(verdicts.select(piece, *[c for c in verdicts.columns if c not in ("anchor", "content")]), "piece")
    windows = F.shiftright("place", PLACE_BITS) % (1 << PLACE_BITS)
    everything = F.array(F.lit(0), (windows - 1).cast("int"))
    if keep_first:
        is_head = F.struct("doc_id", "k1", "k2", "place").eqNullSafe(F.struct("at.doc_id", "at.k1", "at.k2", "at.place"))
        found = found.withColumn("runs", F.when(~is_head, everything).otherwise(F.col("runs")))
        found = found.where("runs IS NOT NULL")
    else:
        found = found.withColumn("runs", F.coalesce("runs", everything))
    # A span is start * 2**31 + stop.
    span = F.expr(f"transform(sequence(0, size(runs) - 2, 2), i -> (first + runs[i]) * {1 << 31} + first + runs[i + 1] + {MIN_BYTES})")
    spans = (
        found.withColumn("first", F.shiftright("place", 2 * PLACE_BITS)).select("uid", F.explode(span).alias("span"))
        .groupBy("uid").agg(F.collect_list("span").alias("spans"))
        .join(named, "uid").groupBy(*identity).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )
    return texts.join(spans, identity, "left").join(_shared(texts), identity, "left").select(
        "id.doc_id", F.col("t").cast("binary").alias("t"), "spans", F.coalesce("n_shared", F.lit(0)).alias("n_shared")).mapInArrow(_strip, RESULT)


def op9_repeats(docs: DataFrame) -> DataFrame:
    return deduplicate(docs).drop("kept")
