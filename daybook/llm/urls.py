"""URL filters: block and allow rules, and boosted trees on lexical features for the rest.

Host rules decide the URLs they fit.  Those URLs are the labelled ones:
gradient-boosted trees (Spark ML) learn from a bounded hash sample of them, by
lexical features only (length, depth, digit ratio, character entropy,
parameter counts, statistics of the host's suffix), and judge every other URL.
The suffix statistics (how common it is, its block rate) of a labelled URL come from
the other folds of the sample, so that no URL's own label is among its features.

Scale: only the URL column is read; equal URLs are counted before the sample is
taken and weigh by their number, so one URL with a third of all rows is one row;
per-suffix statistics are partial aggregates over the sample; the fit's input is
bounded by SAMPLE_ROWS distinct URLs.
Defined cases: null URLs and those without ``://`` have empty host and path;
with fewer than two labels among the ruled URLs the method allows everything
but what would be blocked alike; repeated URLs get the same verdict; very long ones are
read whole; of a tie at 0.5 the verdict is block; columns besides page_id and url are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut, hash_sample, sample_fraction

# The rules, verdict and host/path prefix.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 15, 4, 7
#: Weight of the overall rate in a suffix's smoothed block rate.
PRIOR = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_chars", "host_chars", "labels", "depth", "digit_ratio", "entropy", "params", "query_chars",
            "hyphens", "host_digits", "longest_label", "has_fragment", "tld_chars", "suffix_rate", "suffix_share"]
#: Parts of the sample that suffix statistics leave out in turn.
FOLDS = 5


def parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path."""
    rest = F.when(F.locate("://", "url") > 0, F.expr("substr(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", "url", host.alias("host"), path.alias("path"))


def _fits(rule: str) -> Column:
    host, path = rule.split("/", 1)
    return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule and by_rule (its verdict): the longest rule that fits, else null."""
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        rule = F.when(_fits(text), F.lit(text)).otherwise(rule)
        verdict = F.when(_fits(text), F.lit(said)).otherwise(verdict)
    return parts(pages).withColumn("rule", rule).withColumn("by_rule", verdict)


def lexical(df: DataFrame) -> DataFrame:
    """Adds the features that need no statistics, and suffix."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    return (
        df.withColumn("u", url).withColumn("chars", F.filter(F.split("u", ""), lambda x: x != ""))
        .withColumn("url_chars", F.length("u").cast("double"))
        .withColumn("host_chars", F.length("host").cast("double"))
        .withColumn("labels", count("host", r"[^.]+"))
        .withColumn("depth", count("path", r"[^/]+"))
        .withColumn("digit_ratio", count("u", "[0-9]") / F.greatest(F.length("u"), F.lit(1)))
        .withColumn("entropy", F.expr(
            "aggregate(transform(array_distinct(chars), c -> size(filter(chars, x -> x = c)) / size(chars)), 0D, "
            "(a, p) -> a - p * log2(p))"))
        .withColumn("params", count(query, "[^&]+")).withColumn("query_chars", F.length(query).cast("double"))
        .withColumn("hyphens", count("host", "-")).withColumn("host_digits", count("host", "[0-9]"))
        .withColumn("longest_label", F.coalesce(F.array_max(F.transform(F.split("host", "[.]"), F.length)), F.lit(0)).cast("double"))
        .withColumn("has_fragment", F.contains(F.col("u"), F.lit("#")).cast("double"))
        .withColumn("tld_chars", F.length(F.regexp_extract("host", r"[^.]*$", 0)).cast("double"))
        .withColumn("suffix", F.regexp_extract("host", r"[^.]*$", 0))
        .drop("u", "chars")
    )


def with_suffix_statistics(df: DataFrame, labelled: DataFrame, own: bool) -> DataFrame:
    """Adds suffix_rate (smoothed block rate) and suffix_share (its share of the URLs) by the labelled sample.

    With ``own`` ``df`` is (part of) the sample, and a URL's fold is left out of its statistics.
    ``labelled`` has suffix, fold, label and weight.
    """
    sums = [F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("blocked")]
    whole = labelled.groupBy("suffix").agg(*sums)
    folds = labelled.groupBy("fold").agg(F.sum("weight").alias("fold_all"), F.sum(F.col("weight") * F.col("label")).alias("fold_blocked"))
    total, blocked = labelled.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("label"))).first()
    wide = df.join(whole, "suffix", "left")
    if own:
        part = labelled.groupBy("suffix", "fold").agg(F.sum("weight").alias("own_n"), F.sum(F.col("weight") * F.col("label")).alias("own_blocked"))
        wide = wide.join(part, ["suffix", "fold"], "left").join(folds, "fold", "left")
    else:
        wide = wide.withColumns({c: F.lit(0.0) for c in ("own_n", "own_blocked", "fold_all", "fold_blocked")})
    n = F.coalesce("n", F.lit(0.0)) - F.coalesce("own_n", F.lit(0.0))
    bad = F.coalesce("blocked", F.lit(0.0)) - F.coalesce("own_blocked", F.lit(0.0))
    rest = F.greatest(F.lit(total) - F.coalesce("fold_all", F.lit(0.0)), F.lit(1.0))
    overall = (F.lit(blocked) - F.coalesce("fold_blocked", F.lit(0.0))) / rest
    return wide.withColumn("suffix_rate", (bad + PRIOR * overall) / (n + PRIOR)).withColumn("suffix_share", n / rest).drop(
        "n", "blocked", "own_n", "own_blocked", "fold_all", "fold_blocked")


def assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def sample(urls: DataFrame) -> DataFrame:
    """The labelled sample: distinct ruled URLs (lexical features, label, weight, fold), at most about SAMPLE_ROWS."""
    distinct = urls.where("by_rule IS NOT NULL").groupBy("url", "host", "path", "by_rule").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    n = distinct.count()
    picked = hash_sample(distinct, F.coalesce("url", F.lit("")), sample_fraction(n, SAMPLE_ROWS))
    fold = F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS)).cast("int")
    return lexical(picked).withColumn("label", (F.col("by_rule") == "block").cast("double")).withColumn("fold", fold)


def fit(labelled: DataFrame):
    """Boosted trees on the labelled sample, its suffix statistics taken out of fold."""
    train = assembled(with_suffix_statistics(labelled, labelled, True)).select("features", "label", "weight", "url")
    spread = train.repartition(8, F.xxhash64("url", F.lit("sample"))).sortWithinPartitions("url")
    return GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
                         stepSize=0.3).fit(cut(spread))


def scored(df: DataFrame, labelled: DataFrame, model) -> DataFrame:
    """Adds score, the likelihood of block, to URLs with lexical features."""
    return model.transform(assembled(with_suffix_statistics(df, labelled, False))).withColumn(
        "score", vector_to_array("probability")[1])


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, score (block likelihood; null for ruled URLs), verdict."""
    urls = cut(ruled(pages, rules))
    labels = {r["by_rule"] for r in urls.where("by_rule IS NOT NULL").select("by_rule").distinct().collect()}
    columns = ["page_id", "host", "path", "rule", "score", "verdict"]
    if len(labels) < 2:
        other = next(iter(labels), "allow")
        return urls.withColumn("score", F.lit(None).cast("double")).withColumn("verdict", F.coalesce("by_rule", F.lit(other))).select(*columns)
    labelled = cut(sample(urls))
    model = fit(labelled)
    by_model = scored(lexical(urls.where("by_rule IS NULL")), labelled, model).withColumn(
        "verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).select(*columns)
    by_rule = urls.where("by_rule IS NOT NULL").withColumn("score", F.lit(None).cast("double")).withColumn(
        "verdict", F.col("by_rule")).select(*columns)
    return by_rule.unionByName(by_model)


def op3_urls(pages: DataFrame) -> DataFrame:
    return judge(pages)
