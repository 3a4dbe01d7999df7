"""SentencePiece encoding and decoding by Aho-Corasick and a single-pass Viterbi.

An Aho-Corasick automaton over the vocabulary's pieces reads a text once; at
each position the matches that end there (the state's own and those along its
output links) relax the best score of the position: score at the match's start
plus the piece's score.  The back pointers give the best segmentation.  A
character that no single-character piece covers may be skipped at a penalty
and is written as its UTF-8 bytes' pieces.  Decoding inverts this exactly.

Spaces become U+2581 and one is put in front, as the model's normaliser says;
a U+2581 of the text itself is written as bytes, so every text survives the
round trip.  No piece of the vocabulary joins other characters to a following
U+2581 (checked when the model is read), so texts are cut there, and beside
punctuation that no piece joins to its neighbour, without changing the best
segmentation; a bounded cache keeps the segmentations of recent words.  The path of the model file is a parameter; the scores in it are
summed as in the unigram model (a file with byte-pair scores yields the best
sum of those, not the merge order's segmentation).

Scale: one Arrow pass, no shuffle; memory per task is the automaton, the
cache, one incoming batch and SLICE_ROWS results.  Texts beyond LONG
characters are read in slices.  Defined cases: null and empty texts have no ids and decode to
the empty string; repeated rows are each encoded; ties keep the match found
first, i.e. the one that starts earliest.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Distinct words a task keeps, and the longest that it keeps.
CACHE_WORDS, CACHE_CHARS = 120_000, 32
#: Rows encoded before their results leave the worker, and characters of a text read at once.
SLICE_ROWS, LONG = 256, 1 << 20
UNKNOWN_PENALTY = 10.0
SPACE = "▁"
#: A lone space, where any text can be cut.
LONE_SPACE = re.compile(f"(?<=[^ {SPACE}]) (?=[^ {SPACE}])")
#: Where a text is looked at for a cut; it is made only between characters that no piece joins.
UNITS = re.compile(f"{SPACE}*[^{SPACE}.,!?;:\\n]+|{SPACE}+|[.,!?;:]|\\n+")


def read_model(path: str = MODEL_PATH) -> dict:
    """pieces [(text, id, score)], bytes (id of each byte's piece), unknown (score of a skipped character)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, in_bytes = [], {}
    for i in range(sp.get_piece_size()):
        text = sp.id_to_piece(i)
        if sp.is_byte(i):
            in_bytes[int(text[3:5], 16)] = i
        elif not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)):
            if re.search(f"[^{SPACE}]{SPACE}", text):
                raise ValueError(f"piece {text!r} joins words; texts can't be cut at {SPACE}")
            pieces.append((text, i, sp.get_score(i)))
    if len(in_bytes) != 256:
        raise ValueError("the model has no pieces for all bytes; a round trip would lose characters")
    key = hashlib.md5(repr(pieces).encode()).hexdigest()
    return {"key": key, "pieces": pieces, "bytes": [in_bytes[b] for b in range(256)],
            "unknown": min(score for _, _, score in pieces) - UNKNOWN_PENALTY}


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, model: dict):
        self.automaton = ahocorasick.Automaton()
        for text, i, score in model["pieces"]:
            self.automaton.add_word(text, (i, len(text), score))
        self.automaton.make_automaton()
        self.single = {text for text, _, _ in model["pieces"] if len(text) == 1}
        #: Neighbouring characters that some piece holds; a text may be cut between any others.
        self.joined = {text[k:k + 2] for text, _, _ in model["pieces"] for k in range(len(text) - 1)}
        self.bytes, self.unknown = model["bytes"], model["unknown"]
        self.text = {i: text.replace(SPACE, " ") for text, i, _ in model["pieces"]}
        self.byte = {i: b for b, i in enumerate(model["bytes"])}
        self.in_bytes = set(model["bytes"])
        self.cache: dict[str, tuple] = {}

    def segment(self, s: str) -> tuple:
        """Ids of the best segmentation of ``s``."""
        n = len(s)
        low = float("-inf")
        best, start_of, id_of = [low] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        covered = self.single.issuperset(s)
        done = 0  # positions before it have had their skip tried
        for last, (i, length, score) in self.automaton.iter(s):
            end = last + 1
            if not covered and done < end:
                self._skips(s, done, end, best, start_of, id_of)
                done = end
            start = end - length
            total = best[start] + score
            if total > best[end]:
                best[end], start_of[end], id_of[end] = total, start, i
        if not covered:
            self._skips(s, done, n, best, start_of, id_of)
        out, at = [], n
        while at:
            start, i = start_of[at], id_of[at]
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.bytes[b] for b in reversed(s[start:at].encode("utf-8", "surrogatepass")))
            at = start
        return tuple(reversed(out))

    def _skips(self, s: str, first: int, until: int, best: list, start_of: list, id_of: list) -> None:
        """Relaxes the positions after the characters first..until-1 that no single-character piece covers."""
        for at in range(first, until):
            if s[at] not in self.single and best[at] + self.unknown > best[at + 1]:
                best[at + 1], start_of[at + 1], id_of[at + 1] = best[at] + self.unknown, at, -1

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for part in _slices(text) if text else ():
            self._encode(part, out)
        return out

    def _encode(self, text: str, out: list[int]) -> None:
        """Adds the ids of one slice."""
        cache, joined = self.cache, self.joined
        for k, part in enumerate(text.split(SPACE)):
            if k:
                out.extend(self.bytes[b] for b in SPACE.encode())
            marked = part.replace(" ", SPACE)
            held = ""
            for word in UNITS.findall(marked if k else SPACE + marked):
                if held:
                    if held[-1] + word[0] in joined:
                        held += word
                        continue
                    ids = cache.get(held)
                    out.extend(self._segment(held) if ids is None else ids)
                held = word
            if held:
                ids = cache.get(held)
                out.extend(self._segment(held) if ids is None else ids)

    def _segment(self, word: str) -> tuple:
        ids = self.segment(word)
        if len(word) <= CACHE_CHARS:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def decode(self, ids) -> str:
        if self.in_bytes.isdisjoint(ids):
            return "".join([self.text[i] for i in ids])[1:]
        out, run = [], bytearray()
        for i in ids:
            b = self.byte.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.text[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)[1:]


def _slices(text: str) -> Iterator[str]:
    """The text cut at lone spaces (which go, as each slice is encoded with one in front) after every LONG characters."""
    at = 0
    while len(text) - at > LONG and (cut := LONE_SPACE.search(text, at + LONG)):
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:] if at else text


#: The codec a Python worker used last, kept with its cache from task to task.
_LAST: dict[str, Codec] = {}


def codec_of(model: dict) -> Codec:
    if model["key"] not in _LAST:
        _LAST.clear()
        _LAST[model["key"]] = Codec(model)
    return _LAST[model["key"]]


def encoded(text: Column, model: dict) -> Column:
    """array<int> of piece ids."""
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(model)
        for texts in batches:
            # Packed integers: a batch of ids as Python lists would be many times its texts.
            yield pd.Series([np.array(codec.encode(t), np.int32) for t in texts])
    return run(text)


def decoded(ids: Column, model: dict) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(model)
        for lists in batches:
            yield pd.Series([codec.decode(x.tolist() if x is not None else []) for x in lists])
    return run(ids)


def checked(model: dict):
    """For mapInArrow over (doc_id, text): doc_id, ids, n_tokens and whether decoding the ids gives the text, in one pass of one worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                ids, ends, same = array("i"), [0], []
                for value in rows.column(1):
                    text = value.as_py() or ""
                    got = codec.encode(text)
                    same.append(codec.decode(got) == text)
                    ids.extend(got)
                    ends.append(len(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.asarray(ids, np.int32), pa.int32()))
                counts = pa.array(np.diff(ends), pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column(0), lists, counts, pa.array(same, pa.bool_())],
                                                 names=["doc_id", "ids", "n_tokens", "round_trip"])
    return run


def op4_sentencepiece(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, ids, n_tokens, round_trip (decoding the ids gives the text)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(checked(read_model(model_path)), f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean")
