"""PII: high-recall generators, boosted trees over format and context, calibrated thresholds.

Base patterns (email, ip, card, phone) with their validity rules always yield
spans.  Looser generators propose overlapping further spans (spelled-out
addresses, national phone formats, cards and addresses with other separators).
Those that hold a base span of their kind are positives; those that break the
kind's validity rule, or lie on a base span of another kind only, are negatives;
valid ones that overlap no base span are unlabelled: what is looked for is among
them.  Gradient-boosted trees (Spark ML) learn from all labelled ones, by
context and by the format of a form in which all spellings of a kind look alike
(``form``) and without what the validity rules read (numbers of digits, Luhn,
octets).  For the thresholds, texts are dealt into FOLDS folds and each labelled
candidate is scored by trees learnt from the other folds; per kind, the
threshold is the lowest such score at which all labelled candidates reach
PRECISION; those that Luhn or octets refuse do not count there, as they are
refused at any score.  Unlabelled candidates above it are added.

Native: expressions and Spark ML on the JVM only.  Each pattern is run by
``regexp_extract_all`` and ``split``; the lengths of matches and of the gaps
between them give positions, so the cost is linear in the text.  Patterns use
possessive quantifiers and look-behind so that long runs neither overflow the
matcher's stack nor are rescanned from each of their characters.

Scale: one pass over the texts leaves a checkpoint of spans and candidate
features; no text is shuffled by the search.  Labelled candidates with equal
features are one row, weighted by their number (partial aggregates), so the
trees read all of them from far fewer rows.  Defined cases: null text is
empty; empty text has no spans; repeated rows get equal results; with no
candidate of one of the two classes, or with all candidates in one fold, there
is no model and base spans stand alone; a kind without labelled candidates, or
whose precision stays below PRECISION, adds nothing, and one without negatives
is judged by its positives' lowest score; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written without backtracking.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind's patterns to be tried at all.
NEEDS = {"email": "@|\\b(?:at|AT|At)\\b", "ip": "[0-9][.,\\[ ]", "card": "[0-9][0-9 ./_-]*[0-9]", "phone": "[0-9][0-9 ()./-]*[0-9]"}
# Generators of further candidates.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?(?:@|\(at\)|\[at\]|\{at\}) ?| at )[A-Za-z0-9-]++"
             r"(?:(?:\.| ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot )[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:(?:\.|,|\[\.\]| \. )[0-9]{1,3}){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ ./_-]{0,2}[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,5}(?![0-9A-Za-z])",
}
# Words that announce a kind.
CUES = {
    "email": r"(?i)e-?mail|contact|write|correo|courriel|schreib",
    "ip": r"(?i)\bip\b|host|server|address|addr",
    "card": r"(?i)card|visa|credit|tarjeta|carte|karte",
    "phone": r"(?i)phone|tel\b|call|fax|mobile|llam|appel|anruf",
}
CONTEXT = 32
#: The shape of the trees, and the bins of a feature at least.
TREES, DEPTH, SEED, BINS = 12, 3, 11, 32
PRECISION, FOLDS = 0.95, 4
#: Rows of labelled candidates that a task of the trees reads.
TASK_ROWS = 1000

FEATURES = ["is_email", "is_ip", "is_card", "is_phone", "letters", "spaces", "dots", "dashes", "brackets", "groups",
            "group_chars", "cue", "word_before", "word_after", "digits_near"]


def _luhn(digits: str) -> str:
    """SQL: the digit string passes Luhn's check."""
    return f"""(aggregate(sequence(1, length({digits})), 0, (a, i) -> a +
      CASE WHEN i % 2 = 1 THEN cast(substr({digits}, length({digits}) - i + 1, 1) AS int)
           ELSE cast(substr({digits}, length({digits}) - i + 1, 1) AS int) * 2
                - CASE WHEN substr({digits}, length({digits}) - i + 1, 1) > '4' THEN 9 ELSE 0 END END) % 10 = 0)"""


#: A decimal number of at most 255, leading zeros allowed.
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


VALID = {
    "email": "true",
    "ip": f"x.hit rlike '^{OCTET}([.]{OCTET}){{3}}$'",
    "card": f"length({_digits('x.hit')}) BETWEEN 14 AND 19 AND {_luhn(_digits('x.hit'))}",
    "phone": f"length({_digits('x.hit')}) BETWEEN 10 AND 15",
}
#: What a proposal's form must satisfy to be added.
FORM_VALID = {
    "email": r"form rlike '[.][A-Za-z]{2,24}$'",
    "ip": f"form rlike '^{OCTET}([.]{OCTET}){{3}}$'",
    "card": f"length({_digits('form')}) BETWEEN 14 AND 19 AND {_luhn(_digits('form'))}",
    "phone": f"length({_digits('form')}) BETWEEN 10 AND 15",
}


def form(hit: Column, k: Column) -> Column:
    """A proposal in the spelling that all spellings of its kind share."""
    email = F.regexp_replace(F.regexp_replace(hit, r" ?(?:\(at\)|\[at\]|\{at\}|@) ?| at ", "@"),
                             r" ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot ", ".")
    ip = F.regexp_replace(hit, "[^0-9]+", ".")
    card = F.regexp_replace(hit, "[^0-9]+", "-")
    phone = F.regexp_replace(F.regexp_replace(hit, r"^(?:\+|00)", ""), r"[ ./-]+", "-")
    return F.when(k == 0, email).when(k == 1, ip).when(k == 2, card).otherwise(phone)


def spans_of(text: str, pattern: str, needs: str) -> Column:
    """Matches of ``pattern`` with positions in code points and their context."""
    p, n = pattern.replace("\\", "\\\\").replace("'", "\\'"), needs.replace("\\", "\\\\")
    return F.expr(f"""
      CASE WHEN {text} rlike '{n}' THEN
        transform(array(struct(regexp_extract_all({text}, '{p}', 0) AS m, split({text}, '{p}', -1) AS g)),
          f -> aggregate(f.m, struct(0 AS i, 0 AS at,
              cast(array() AS array<struct<start:int,stop:int,hit:string,before:string,after:string>>) AS found),
            (a, hit) -> struct(
              a.i + 1 AS i, a.at + length(f.g[a.i]) + length(hit) AS at,
              concat(a.found, array(struct(
                a.at + length(f.g[a.i]) AS start, a.at + length(f.g[a.i]) + length(hit) AS stop, hit AS hit,
                right(f.g[a.i], {CONTEXT}) AS before, left(f.g[a.i + 1], {CONTEXT}) AS after))) AS found),
            a -> a.found))[0]
      ELSE cast(array() AS array<struct<start:int,stop:int,hit:string,before:string,after:string>>) END""")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, base (spans that always stand) and proposals, per row."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    for kind in KINDS:
        df = df.withColumn(f"b_{kind}", spans_of("t", BASE[kind], NEEDS[kind]))
        df = df.withColumn(f"l_{kind}", spans_of("t", LOOSE[kind], NEEDS[kind]))
    base = ", ".join(
        f"transform(filter(b_{k}, x -> {VALID[k]}), x -> struct(x.start AS start, {i} AS k, x.stop AS stop))"
        for i, k in enumerate(KINDS))
    loose = ", ".join(
        f"transform(l_{k}, x -> struct(x.start AS start, {i} AS k, x.stop AS stop, x.hit AS hit, x.before AS before, x.after AS after))"
        for i, k in enumerate(KINDS))
    return df.select("doc_id", F.md5("t").alias("row_key"), F.expr(f"sort_array(concat({base}))").alias("base"),
                     F.expr(f"concat({loose})").alias("proposed"))


def candidates(found: DataFrame) -> DataFrame:
    """One row per proposal with its features, label (null: unlabelled) and free (valid and on no base span).

    A positive phone number with a country code has a second row, as it looks without.
    """
    c = found.where(F.size("proposed") > 0).select("doc_id", "row_key", "base", F.explode("proposed").alias("c"))
    k = F.col("c.k")
    cue = F.coalesce(*[F.when(k == i, F.col("c.before").rlike(CUES[x])) for i, x in enumerate(KINDS)])
    c = c.select(
        "doc_id", "row_key", "c", form(F.col("c.hit"), k).alias("form"),
        F.expr("exists(base, b -> b.k = c.k AND b.start >= c.start AND b.stop <= c.stop)").alias("holds"),
        F.expr("exists(base, b -> b.start < c.stop AND c.start < b.stop)").alias("meets"),
        F.expr("exists(base, b -> b.k = c.k AND b.start < c.stop AND c.start < b.stop)").alias("meets_own"))
    valid = F.coalesce(*[F.when(k == i, F.expr(FORM_VALID[x])) for i, x in enumerate(KINDS)])
    national = F.regexp_replace("form", "^[0-9]{1,3}-+", "")
    c = c.withColumn("valid", valid).withColumn("form", F.explode(F.when(
        F.col("holds") & (k == KINDS.index("phone")) & F.col("c.hit").startswith("+"),
        F.array_distinct(F.array(F.col("form"), national))).otherwise(F.array("form"))))
    count = lambda pattern: F.regexp_count("form", F.lit(pattern)).cast("double")
    label = F.when(F.col("holds"), 1.0).when(~F.col("meets_own") & (F.col("meets") | ~F.col("valid")), 0.0)
    out = c.select(
        "doc_id", "row_key", F.col("c.start").alias("start"), k.alias("k"), F.col("c.stop").alias("stop"),
        label.alias("label"), (~F.col("meets") & F.col("valid")).alias("free"),
        (~F.col("holds") & ~F.col("valid") & k.isin(KINDS.index("ip"), KINDS.index("card"))).alias("refused"),
        *[(k == i).cast("double").alias(f"is_{x}") for i, x in enumerate(KINDS)],
        count("[A-Za-z]").alias("letters"), count(" ").alias("spaces"), count("[.]").alias("dots"), count("-").alias("dashes"),
        count(r"[()\[\]{}]").alias("brackets"), count("[0-9]+").alias("groups"),
        (count("[0-9]") / F.greatest(count("[0-9]+"), F.lit(1.0))).alias("group_chars"),
        cue.cast("double").alias("cue"),
        F.col("c.before").rlike("[A-Za-z0-9]$").cast("double").alias("word_before"),
        F.col("c.after").rlike("^[A-Za-z0-9]").cast("double").alias("word_after"),
        (F.regexp_count("c.before", F.lit("[0-9]")) + F.regexp_count("c.after", F.lit("[0-9]"))).cast("double").alias("digits_near"),
    )
    return out.fillna(0.0, FEATURES)


def weighted(cands: DataFrame) -> DataFrame:
    """FEATURES, label, k, fold (of the text), refused and weight: how many labelled candidates are alike."""
    fold = F.pmod(F.xxhash64("row_key", F.lit("fold")), F.lit(FOLDS))
    return cands.where(F.col("label").isNotNull()).groupBy(*FEATURES, "label", "k", fold.alias("fold"), "refused").agg(
        F.count(F.lit(1)).cast("double").alias("weight"))


def thresholds(scored: DataFrame) -> DataFrame:
    """k and its threshold, from the score, label and weight of labelled candidates."""
    by_score = scored.groupBy("k", "score").agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n"))
    down = "OVER (PARTITION BY k ORDER BY score DESC)"
    return by_score.selectExpr("k", "score", f"sum(good) {down} / sum(n) {down} AS precision").where(
        F.col("precision") >= PRECISION).groupBy("k").agg(F.min("score").alias("threshold"))


def added_spans(found: DataFrame) -> DataFrame:
    """doc_id, row_key, start, k, stop of the proposals that the trees add; empty without a model."""
    cands = cut(candidates(found))
    schema = cands.select("doc_id", "row_key", "start", "k", "stop")
    wide = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # In one order on every run: the trees add floating-point numbers.
    labelled = cut(wide.transform(weighted(cands).sortWithinPartitions(*FEATURES, "label", "k", "fold", "refused")).select(
        "features", "label", "k", "fold", "refused", "weight"))
    low, high, rows, folds = labelled.agg(
        F.min("label"), F.max("label"), F.count(F.lit(1)), F.sort_array(F.collect_set("fold"))).first()
    if low == high or len(folds) < 2 or cands.where("free").isEmpty():
        return schema.where(F.lit(False))
    # Each level of each tree is a shuffle of all tasks with all: so as many tasks as the rows need, not as many as the table has.
    labelled = labelled.coalesce(math.ceil(rows / TASK_ROWS))
    # Spark ML looks for a feature's bins in as many rows as the square of their number: so in all of them.
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
                          stepSize=0.3, maxBins=max(BINS, math.isqrt(rows) + 1))
    score = F.round(vector_to_array("probability")[1], 3).alias("score")
    out_of_fold = [
        trees.fit(labelled.where(F.col("fold") != fold)).transform(labelled.where((F.col("fold") == fold) & ~F.col("refused")))
        .select("k", "label", "weight", score) for fold in folds]
    least = thresholds(functools.reduce(DataFrame.unionByName, out_of_fold))
    scored = trees.fit(labelled).transform(wide.transform(cands.where("free"))).withColumn("score", score)
    return scored.join(least, "k").where("score >= threshold").select("doc_id", "row_key", "start", "k", "stop")


def all_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, base and spans (both sorted arrays of start, k, stop), one row per document."""
    found = cut(find(docs))
    added = added_spans(found).groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("start", "k", "stop")).alias("added"))
    a = added.select(F.col("doc_id").alias("a_id"), F.col("row_key").alias("a_key"), "added")
    return found.join(a, (F.col("row_key") == F.col("a_key")) & F.col("doc_id").eqNullSafe(F.col("a_id")), "left").select(
        "doc_id", "row_key", "base",
        F.expr("sort_array(concat(base, coalesce(added, cast(array() AS array<struct<start:int,k:int,stop:int>>))))").alias("spans"))


def _listed(column: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({column}, x -> concat({names}[x.k], ':', x.start, ':', x.stop)), ',')"


def op2_pii(docs: DataFrame) -> DataFrame:
    """The contract's columns for all documents; n_ counts are of base spans."""
    spans = all_spans(docs)
    return spans.select(
        "doc_id", *[F.expr(f"cast(size(filter(base, x -> x.k = {i})) AS long)").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(F.expr(_listed("base")), 256).alias("base_sha256"), F.expr(_listed("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """Pipeline stage: spans replaced by [EMAIL], [IP], [CARD] or [PHONE]; n_chars follows the text.

    Overlapping spans become one, named after the first.
    """
    spans = all_spans(docs).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("s_id"), F.col("row_key").alias("s_key"), "spans").dropDuplicates(["s_id", "s_key"])
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    text = f"""aggregate(spans, struct('' AS out, 0 AS at),
      (a, x) -> CASE WHEN x.start < a.at THEN struct(a.out AS out, greatest(a.at, x.stop) AS at)
        ELSE struct(concat(a.out, substr(row.text, a.at + 1, x.start - a.at), {names}[x.k]) AS out, x.stop AS at) END,
      a -> concat(a.out, substr(row.text, a.at + 1)))"""
    # The text the spans cover to its end may be swallowed by a span that starts inside another: ``at`` moves on.
    joined = docs.select(F.struct(*docs.columns).alias("row"), F.md5(F.coalesce("text", F.lit(""))).alias("key")).join(
        spans, (F.col("key") == F.col("s_key")) & F.col("row.doc_id").eqNullSafe(F.col("s_id")), "left")
    clean = joined.withColumn("clean", F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.expr(text)))
    columns = [F.col("clean").alias("text") if c == "text"
               else F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length("clean")).cast("long").alias(c)
               if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return clean.select(*columns)
