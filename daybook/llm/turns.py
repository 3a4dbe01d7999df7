"""Conversation structure repair: cheapest edits that make turns read ``(s?(ua)+)?``.

Rows of a conversation stand in the order of turn (nulls first), then role, then
SHA-256 of the text.  A row's first fault counts: blank (no word), duplicate
(role and text seen earlier), truncated (doesn't end in ``.``, ``!`` or ``?``).
Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only choice for blank
and duplicate rows), Insert an empty user or assistant row 2; a truncated row that
stays adds 1.  Of the cheapest edit strings the ASCII-least is the audit.

Method, a run-length DP.  A row is a symbol: initial of its role, capital if
truncated, ``x`` if it must go.  Equal rows of a conversation collapse to one row
with a count before any shuffle, equal consecutive symbols to runs.  A symbol
acts on the four states (nothing yet, after s, u, a) by a min-plus matrix; a run
of length n is applied through the cached powers for the binary digits of n.
Going back over the runs gives the cost that remains at every run's end; with it
the choices are unrolled, halving a power until it is a single row.

Scale: the symbol rows (no texts) are range-partitioned over conversation and
order, so a conversation of any size spreads over many tasks.  Each partition
cuts its rows into fragments of at most FRAGMENT rows; one small row a fragment
carries its matrix.  Going back over a conversation's matrices, unrolling
fragments from every possible start state, and going forward to choose among
them touch fragments only.  Texts move once, to be hashed in order: a digest of
joined rows is sequential by definition, so a conversation's texts pass through
one task, as a stream in bounded memory.

Defined cases: null conversation, turn, role and text count as one space where
text is made of them; a null conv_id is a conversation of its own; a role that
starts with none of s, u, a (or is empty) can't be kept; repeated rows are
duplicates (or blank); conversations without rows keep zeros, an empty audit and
the digest of the empty string; an empty table gives no rows; columns besides
conv_id, turn, role, text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import WHITE_SPACE, cut

# The costs of the edits, and what a truncated row that stays adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# States: 0 nothing yet, 1 after s, 2 after u, 3 after a.  What an inserted or reroled row leads to.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
# Remaining cost after the last row, insertions counted: an empty result and one after a are complete.
END = (0, 2 * INSERT, INSERT, 0)
#: Rows a fragment covers at most.
FRAGMENT = 65_536
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
ORDER = ["turn", "role", "digest"]


# ---- the DP over symbols ---------------------------------------------------

def kept(symbol: str, state: int) -> int | None:
    """State after keeping the row, None where it can't be kept."""
    initial = symbol.lower()
    if initial == "s":
        return 1 if state == 0 else None
    if initial in "ua" and NEXT[state] == "ua".index(initial) + 2:
        return NEXT[state]
    return None


def row_costs(symbol: str, state: int, after: tuple) -> list[tuple[str, int, int]]:
    """(edit, cost that remains, next state) of a row's own edits."""
    stays = TRUNCATED if symbol.isupper() else 0
    out = [("D", DELETE + after[state], state)]
    if symbol != "x":
        if (to := kept(symbol, state)) is not None:
            out.append(("K", KEEP + stays + after[to], to))
        out.append(("R", REROLE + stays + after[NEXT[state]], NEXT[state]))
    return out


def before_row(symbol: str, after: tuple) -> tuple:
    """Remaining costs before a row, insertions in front of it counted."""
    own = [min(c for _, c, _ in row_costs(symbol, s, after)) for s in range(4)]
    return tuple(min(own[s], INSERT + own[NEXT[s]], 2 * INSERT + own[NEXT[NEXT[s]]]) for s in range(4))


def times(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two 4 x 4 matrices (tuples of rows)."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def apply(m: tuple, v: tuple) -> tuple:
    return tuple(min(m[i][k] + v[k] for k in range(4)) for i in range(4))


FAR = 1 << 60  # no way between two states
UNIT = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)  # at most 9 symbols x 63 binary digits
def power(symbol: str, k: int) -> tuple:
    """Transition of 2**k rows of a symbol."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    columns = [before_row(symbol, UNIT[j]) for j in range(4)]
    return tuple(tuple(min(columns[j][i], FAR) for j in range(4)) for i in range(4))


def digits(n: int) -> list[int]:
    """Powers of two that make n, largest first."""
    return [k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def run_back(symbol: str, n: int, after: tuple) -> tuple:
    """Remaining costs before a run of n rows."""
    for k in digits(n):
        after = apply(power(symbol, k), after)
    return after


def run_matrix(symbol: str, n: int, after: tuple) -> tuple:
    for k in digits(n):
        after = times(power(symbol, k), after)
    return tuple(tuple(min(c, FAR) for c in row) for row in after)


def unroll_row(symbol: str, state: int, after: tuple, out: list) -> int:
    """Appends the ASCII-least cheapest edits up to and with a row; returns the next state."""
    left = before_row(symbol, after)
    while True:
        edits = {e: (c, to) for e, c, to in row_costs(symbol, state, after)}
        if edits["D"][0] == left[state]:
            out.append("D")
            return state
        if INSERT + left[NEXT[state]] == left[state]:
            out.append("I")
            state = NEXT[state]
            continue
        for e in "KR":
            if e in edits and edits[e][0] == left[state]:
                out.append(e)
                return edits[e][1]


def unroll_power(symbol: str, k: int, state: int, after: tuple, out: list) -> int:
    if k == 0:
        return unroll_row(symbol, state, after, out)
    state = unroll_power(symbol, k - 1, state, apply(power(symbol, k - 1), after), out)
    return unroll_power(symbol, k - 1, state, after, out)


def unroll(symbols: str, lengths: list[int], state: int, after: tuple, last: bool) -> tuple[str, int]:
    """Edits of a fragment's runs from a start state, and the state they end in."""
    blocks = [(s, k) for s, n in zip(symbols, lengths) for k in digits(n)]
    ends = [after]
    for s, k in reversed(blocks):
        ends.append(apply(power(s, k), ends[-1]))
    ends.pop()
    out: list[str] = []
    for (s, k), end in zip(blocks, reversed(ends)):
        state = unroll_power(s, k, state, end, out)
    while last and END[state]:
        out.append("I")
        state = NEXT[state]
    return "".join(out), state


def audit(symbols: str) -> tuple[int, str]:
    """Cost and audit of a whole sequence of symbols, one a row."""
    after = END
    for s in reversed(symbols):
        after = before_row(s, after)
    return after[0], unroll(symbols, [1] * len(symbols), 0, END, True)[0]


# ---- rows ------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times: rows damaged by crc32 of ``conv_id:turn`` modulo 20."""
    def written(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % 20
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(written("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(written("text"), ".!?", "")).otherwise(written("text")).alias("text"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("times"), kind.alias("kind"),
    ).where(F.col("kind") != 0).drop("kind")


def ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def symbols(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, digest): n equal rows, whether blank, seen earlier, truncated."""
    last = F.right(F.rtrim("text", F.lit(WHITE_SPACE)), F.lit(1))
    found = rows.select("conv_id", "turn", "role", "times", F.unhex(F.sha2("text", 256)).alias("digest"),
                        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"))
    equal = found.groupBy("conv_id", *ORDER, "blank", "open").agg(F.sum("times").alias("n"))
    earlier = Window.partitionBy("conv_id", "role", "digest").orderBy(*ascending("turn"))
    return equal.withColumn("seen", F.row_number().over(earlier) > 1)


def counts(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated of ``symbols``."""
    again = F.when(F.col("seen"), F.col("n")).otherwise(F.col("n") - 1)
    return rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(again)).alias("duplicate"),
        F.count_if(F.col("open") & ~F.col("blank") & ~F.col("seen")).alias("truncated"))


def fragments(rows: DataFrame) -> DataFrame:
    """Runs and matrix of every stretch of a conversation within a partition of the fixed layout."""
    initial = F.substring("role", 1, 1)
    own = F.when(F.col("blank") | F.col("seen"), F.lit("x")).otherwise(
        F.when(F.col("open"), F.upper(F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))))
        .otherwise(F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))))
    ranged = rows.select("conv_id", *ORDER, "n", initial.alias("initial"), own.alias("symbol")).repartitionByRange(
        *ascending("conv_id", *ORDER)).sortWithinPartitions(*ascending("conv_id", *ORDER))
    return cut(ranged).mapInArrow(_fragments, "conv_id long, part long, turn long, role string, digest binary, first string, last string, "
                                              "illegal long, symbols string, lengths array<long>, matrix array<long>, sure boolean")


LEGAL = {"su", "ua", "au"}


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() << 32
    now, size, held = None, 0, []

    def close():
        matrix = UNIT
        for s, n in zip(reversed(now["symbols"]), reversed(now["lengths"])):
            matrix = run_matrix(s, n, matrix)
        now["symbols"], now["matrix"] = "".join(now["symbols"]), [c for row in matrix for c in row]
        held.append(now)

    for batch in batches:
        for conv, turn, role, digest, n, initial, symbol in zip(*(c.to_pylist() for c in batch.columns)):
            for s, m in ((symbol, n),) if symbol == "x" else ((symbol, 1), ("x", n - 1)):
                while m:
                    same = now is not None and now["conv_id"] == conv
                    if not same or size == FRAGMENT:
                        if now is not None:
                            close()
                        # Only what opens a partition may continue a conversation of the partition before.
                        sure = now is not None and not same
                        now, size = {"conv_id": conv, "part": part, "turn": turn, "role": role, "digest": digest, "first": initial,
                                     "last": initial, "illegal": 0, "symbols": [], "lengths": [], "sure": sure}, 0
                        part += 1
                        pairs = 0
                    else:
                        now["illegal"] += now["last"] + initial not in LEGAL
                        pairs = 1
                    take = min(m, FRAGMENT - size)
                    now["illegal"] += take - 1 if initial + initial not in LEGAL else 0
                    now["last"] = initial
                    if pairs and now["symbols"][-1] == s:
                        now["lengths"][-1] += take
                    else:
                        now["symbols"].append(s)
                        now["lengths"].append(take)
                    m, size = m - take, size + take
        if held:
            yield pa.RecordBatch.from_pylist(held, FRAGMENT_ROWS)
            held.clear()
    if now is not None:
        close()
        yield pa.RecordBatch.from_pylist(held, FRAGMENT_ROWS)


_KEY = [("conv_id", pa.int64()), ("part", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary())]
FRAGMENT_ROWS = pa.schema(_KEY + [("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()), ("symbols", pa.string()),
                                  ("lengths", pa.list_(pa.int64())), ("matrix", pa.list_(pa.int64())), ("sure", pa.bool_())])
_SCHEMA = "conv_id long, part long, turn long, role string, digest binary, first string, last string, illegal long"


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        yield batch.to_pylist()


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Later fragments first: the costs that remain after each, from the matrices of those behind it."""
    schema = pa.schema([f for f in FRAGMENT_ROWS if f.name != "matrix"] + [
        pa.field("after", pa.list_(pa.int64())), pa.field("final", pa.bool_()), pa.field("cost", pa.int64())])
    conv, after = (), END
    for rows in _dicts(batches):
        for row in rows:
            row["final"] = conv != (row["conv_id"],)
            if row["final"]:
                conv, after = (row["conv_id"],), END
            flat = row.pop("matrix")
            row["after"] = list(after)
            after = apply([flat[i:i + 4] for i in range(0, 16, 4)], after)
            row["cost"] = after[0]
        yield pa.RecordBatch.from_pylist(rows, schema)


def _unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and end state of each fragment from every state it may start in."""
    names = [n for n, _ in _KEY] + ["first", "last", "illegal", "cost"]
    types = {f.name: f.type for f in FRAGMENT_ROWS} | {"cost": pa.int64()}
    schema = pa.schema([(n, types[n]) for n in names] + [("edits", pa.list_(pa.string())), ("ends", pa.list_(pa.int64()))])
    for rows in _dicts(batches):
        for row in rows:
            tried = [unroll(row["symbols"], row["lengths"], s, tuple(row["after"]), row["final"])
                     for s in range(1 if row["sure"] else 4)]
            row["edits"], row["ends"] = [e for e, _ in tried], [s for _, s in tried]
        yield pa.RecordBatch.from_pylist([{n: row[n] for n in schema.names} for row in rows], schema)


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Earlier fragments first: the edits for the state each starts in; illegal pairs between fragments."""
    schema = pa.schema(_KEY + [("illegal", pa.int64()), ("cost", pa.int64()), ("edits", pa.string())])
    conv, state, last = (), 0, ""
    for rows in _dicts(batches):
        for row in rows:
            if conv != (row["conv_id"],):
                conv, state = (row["conv_id"],), 0
            else:
                row["illegal"] += last + row["first"] not in LEGAL
                row["cost"] = 0
            row["edits"], state, last = row["edits"][state], row["ends"][state], row["last"]
        yield pa.RecordBatch.from_pylist([{n: row[n] for n in schema.names} for row in rows], schema)


def audited(parts: DataFrame) -> DataFrame:
    """Fragments (conv_id, part, first row's key) with their edits, illegal pairs and the conversation's cost on its first one."""
    back = parts.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("part").desc()).mapInArrow(
        _back, f"{_SCHEMA}, symbols string, lengths array<long>, sure boolean, after array<long>, final boolean, cost long")
    tried = back.repartition("conv_id", "part").mapInArrow(_unroll, f"{_SCHEMA}, cost long, edits array<string>, ends array<long>")
    return tried.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        _forward, "conv_id long, part long, turn long, role string, digest binary, illegal long, cost long, edits string")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: SHA-256 of the repaired ``role:text`` rows, joined by newlines."""
    nothing = F.lit(None)
    stream = rows.select(
        "conv_id", *[F.col(c) for c in ("turn", "role")], F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(1).alias("kind"),
        F.lit(0).cast("long").alias("part"), nothing.cast("string").alias("edits"), "times", F.col("text").cast("binary").alias("text"),
    ).unionByName(edits.select(
        "conv_id", *ORDER, F.lit(0).alias("kind"), "part", "edits", F.lit(0).alias("times"), nothing.cast("binary").alias("text")))
    ordered = stream.repartition("conv_id").sortWithinPartitions(*ascending("conv_id", *ORDER, "kind", "part"))
    return ordered.select("conv_id", "role", "kind", "edits", "times", "text").mapInArrow(
        _hash, "conv_id long, repaired_sha256 string")


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's edits come with, or before, the rows they are for; both are taken off as they meet."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    conv, digest, first, state, waiting, done = (), None, True, 0, [], []

    def put(role: bytes, text: bytes):
        nonlocal first
        if not first:
            digest.update(b"\n")
        first = False
        digest.update(role + b":")
        digest.update(text)

    def insertions():
        nonlocal state
        while waiting and waiting[0][0] < len(waiting[0][1]) and waiting[0][1][waiting[0][0]] == "I":
            waiting[0][0] += 1
            state = NEXT[state]
            put(ROLE[state].encode(), b"")

    def settle():
        """Insertions that are due; edits used up are let go."""
        insertions()
        while waiting and waiting[0][0] == len(waiting[0][1]):
            waiting.pop(0)
            insertions()

    for batch in batches:
        for conv_id, role, kind, edits, n, text in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != (conv_id,):
                if digest is not None:
                    settle()
                    done.append({"conv_id": conv[0], "repaired_sha256": digest.hexdigest()})
                conv, digest, first, state, waiting = (conv_id,), hashlib.sha256(), True, 0, []
            if kind == 0:
                waiting.append([0, edits])
                continue
            for _ in range(n):
                settle()
                edit = waiting[0][1][waiting[0][0]]
                waiting[0][0] += 1
                if edit == "K":
                    state = 1 if role[:1] == "s" else NEXT[state]
                    put(role.encode(), text)
                elif edit == "R":
                    state = NEXT[state]
                    put(ROLE[state].encode(), text)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done.clear()
    if digest is not None:
        settle()
        yield pa.RecordBatch.from_pylist([{"conv_id": conv[0], "repaired_sha256": digest.hexdigest()}], schema)


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every ``conv_id`` of ``conversations``, from ``rows`` (conv_id, turn, role, text, times)."""
    found = cut(symbols(rows))
    edits = cut(audited(fragments(found)))
    # Everything per conversation meets in one aggregate; a piece of an audit comes from each of its fragments.
    whole = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [
        conversations.select("conv_id").distinct(),
        counts(found),
        edits.groupBy("conv_id").agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "edits"))), lambda p: p["edits"]), "").alias("audit")),
        repaired(rows, edits),
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.groupBy("conv_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in whole],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(EMPTY_SHA256)).alias("repaired_sha256"))


def op11_turns(conversations: DataFrame) -> DataFrame:
    """The contract's query: damages the rows, then repairs every conversation."""
    return repair(damage(conversations), conversations)
