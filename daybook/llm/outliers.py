"""Quality rules: robust multivariate outliers per language and source.

Base rules look at one document's own counts.  The method then estimates, for
every (lang, source), centre and covariance of the documents' transformed
statistics by the minimum covariance determinant: from two deterministic
starts (coordinate-wise median and MAD; plain mean and covariance)
concentration steps re-estimate from the half of the documents that is nearest
by Mahalanobis distance, and the start whose final determinant is smaller
wins.  Documents too far from the robust centre are rejected.  The same is estimated for
every language and for the corpus: a source with fewer than MIN_GROUP documents
that pass the base rules is judged by its language, a language with fewer by
the corpus (column ``level`` says by which).

Scale: one row of five numbers per document is checkpointed; a step is one
join with the group estimates and one aggregate by (group, distance bin) with
partial sums, so no group is gathered; the join is salted, so that neither the corpus
nor a source with a third of all rows is one task.  The half is taken in whole bins of the
distance (a factor of exp(1/BINS_PER_E)), i.e. rounded up.

Defined cases: null text counts as empty (fails the base rules); null lang and
source form their own groups; with fewer than MIN_GROUP documents in the whole
corpus there is no estimate and what passes the base rules is kept; repeated rows count as
often as they occur; very long texts count whole; columns besides doc_id, text, lang
and source are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import WHITE_SPACE, cut, words

#: Statistics of the vector; their transforms are in ``vector``.
DIMS = 4
MIN_GROUP = 20
#: Variance added to each statistic, so that chance in a short document is no outlier: the sampling variance of x0 at 50
#: words (letters a word vary by 3) and of x1 at 200 words, of x2 and x3 at 20 lines and 20 separate repeats.  Small enough
#: that each statistic alone can pass the cutoff.
RIDGE = (0.07, 0.02, 0.05, 0.05)
STEPS = 3
BINS_PER_E = 16
# Chi-square with 4 degrees of freedom, median.
CHI2_MEDIAN = 3.356694
#: Squared distance, scaled so that its median is the chi-square median, above which a document is rejected: the
#: 0.999 quantile of chi-square with 4 degrees of freedom.
CUTOFF = 18.466827

GROUP = ["lang_key", "source_key"]
#: Estimates from the most specific on, and the key that stands for all languages or sources.
LEVELS, ALL = ("source", "language", "corpus"), "*"
#: Parts that the rows of a group are dealt to when they meet its estimate.
SALTS = 64


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    repeated = F.expr("""
      CASE WHEN size(w) < 4 THEN 0L ELSE
        transform(array(sort_array(transform(sequence(0, size(w) - 3),
                                             i -> struct(concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS s, i AS p)))),
          z -> transform(array(sort_array(filter(
                 transform(z, (x, i) -> CASE WHEN x.s = get(z, i - 1).s OR x.s = get(z, i + 1).s THEN x.p END),
                 p -> p IS NOT NULL))),
            q -> aggregate(transform(q, (p, i) -> least(3, coalesce(get(q, i + 1) - p, 3))), 0L, (a, b) -> a + b))[0])[0]
      END""")
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(WHITE_SPACE)) != "")
    return (
        docs.select("doc_id", "lang", "source", text.alias("t"), words(F.col("text")).alias("w"))
        .withColumn("lines", lines)
        .select(
            "doc_id", "lang", "source",
            F.size("w").cast("long").alias("n_words"),
            F.length(F.translate("t", WHITE_SPACE, "")).cast("long").alias("word_chars"),
            (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.size("lines").cast("long").alias("n_lines"),
            repeated.cast("long").alias("n_repeat_words"),
        )
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    )


def vector(stats: DataFrame) -> DataFrame:
    """Adds x0..x3: the transformed statistics of a document with words."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return (
        stats
        .withColumn("x0", F.log(F.col("word_chars") / n + 1) * 4)
        .withColumn("x1", F.sqrt(F.col("n_symbols") / n) * 4)
        .withColumn("x2", F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))) * 2)
        .withColumn("x3", F.sqrt(F.col("n_repeat_words") / n) * 2)
        .withColumn("lang_key", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")))
        .withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    )


def _level_keys() -> list:
    """(level, lang_key, source_key) structs of a document's three groups."""
    keys = [(F.col("lang_key"), F.col("source_key")), (F.col("lang_key"), F.lit(ALL)), (F.lit(ALL), F.lit(ALL))]
    return [F.struct(F.lit(i).alias("level"), a.alias("lang_key"), b.alias("source_key")) for i, (a, b) in enumerate(keys)]


def _in_levels(rows: DataFrame) -> DataFrame:
    """The vectors once for each group they belong to."""
    xs = [f"x{i}" for i in range(DIMS)]
    return rows.select(*xs, F.explode(F.array(*_level_keys())).alias("g")).select(*xs, "g.lang_key", "g.source_key")


def _beside(rows: DataFrame, small: DataFrame) -> DataFrame:
    """Rows with their group's row of ``small``; a group's rows are dealt to SALTS parts."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    copies = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*GROUP, "salt"]).drop("salt")


def _sums() -> list:
    out = [F.count(F.lit(1)).cast("double").alias("n")]
    out += [F.sum(f"x{i}").alias(f"s{i}") for i in range(DIMS)]
    out += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(DIMS) for j in range(i + 1)]
    return out


def _total() -> list:
    names = ["n"] + [f"s{i}" for i in range(DIMS)] + [f"s{i}{j}" for i in range(DIMS) for j in range(i + 1)]
    return [F.sum(x).alias(x) for x in names]


def _estimate(sums: DataFrame, keep: list[str]) -> DataFrame:
    """Centre m0.., Cholesky factor c00.. and log-determinant from sums per group."""
    est = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(DIMS)})
    for i in range(DIMS):
        for j in range(i + 1):
            cov = F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
            inner = sum((F.col(f"c{i}{t}") * F.col(f"c{j}{t}") for t in range(j)), F.lit(0.0))
            if i == j:
                value = F.sqrt(F.greatest(cov + F.lit(RIDGE[i]) - inner, F.lit(RIDGE[i] / 100)))
            else:
                value = (cov - inner) / F.col(f"c{j}{j}")
            est = est.withColumn(f"c{i}{j}", value)
    logdet = sum((2 * F.log(F.col(f"c{i}{i}")) for i in range(DIMS)), F.lit(0.0))
    return est.withColumn("logdet", logdet).select(
        *keep, "logdet", *[f"m{i}" for i in range(DIMS)], *[f"c{i}{j}" for i in range(DIMS) for j in range(i + 1)])


def _distance(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    for i in range(DIMS):
        inner = sum((F.col(f"c{i}{t}") * F.col(f"z{t}") for t in range(i)), F.lit(0.0))
        df = df.withColumn(f"z{i}", (F.col(f"x{i}") - F.col(f"m{i}") - inner) / F.col(f"c{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(DIMS)), F.lit(0.0)))


def _bins(rows: DataFrame, estimates: DataFrame, keys: list[str]) -> DataFrame:
    """Sums per group and bin of the squared distance."""
    lowest = 1e-6
    near = _distance(_beside(rows, estimates))
    return (
        near.withColumn("bin", F.floor(F.log(F.greatest(F.col("d2"), F.lit(lowest))) * BINS_PER_E).cast("int"))
        .groupBy(*keys, "bin").agg(*_sums())
    )


def _half(bins: DataFrame, keys: list[str]) -> DataFrame:
    """The bins that hold the nearest half of each group."""
    so_far = F.sum("n").over(Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("n").over(Window.partitionBy(*keys))
    h = F.floor((whole + DIMS + 1) / 2)
    return bins.withColumn("before", F.coalesce(so_far, F.lit(0.0))).withColumn("h", h).where("before < h")


def mcd(rows: DataFrame) -> DataFrame:
    """Per group: the estimate with the smaller determinant and med, its distances' median."""
    keys = [*GROUP, "start"]
    plain = _estimate(rows.groupBy(*GROUP).agg(*_sums()).where(F.col("n") >= MIN_GROUP), GROUP)
    medians = rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("rows"), *[F.percentile_approx(f"x{i}", 0.5, 10000).alias(f"m{i}") for i in range(DIMS)])
    medians = medians.where(F.col("rows") >= MIN_GROUP).drop("rows")
    mads = _beside(rows, medians).groupBy(*GROUP).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(DIMS)],
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 10000).alias(f"a{i}") for i in range(DIMS)])
    robust = mads.select(
        *GROUP, F.lit(0.0).alias("logdet"), *[F.col(f"m{i}") for i in range(DIMS)],
        *[(F.sqrt(F.pow(F.col(f"a{i}") * 1.4826, 2) + RIDGE[i]) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
          for i in range(DIMS) for j in range(i + 1)])
    est = cut(plain.withColumn("start", F.lit("mean")).unionByName(robust.withColumn("start", F.lit("median"))))
    for _ in range(STEPS):
        halves = _half(_bins(rows, est, keys), keys)
        est = cut(_estimate(halves.groupBy(*keys).agg(*_total()), keys))
    best = est.withColumn("place", F.row_number().over(
        Window.partitionBy(*GROUP).orderBy("logdet", "start"))).where("place = 1").drop("place", "start", "logdet")
    best = cut(best)
    middle = _half(_bins(rows, best, GROUP), GROUP).groupBy(*GROUP).agg(
        F.exp((F.max("bin") + 1) / BINS_PER_E).alias("med"))
    return best.join(middle, GROUP)


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Every document with its counts, base_failed, distance (null without estimate), level of its estimate and kept."""
    rows = cut(vector(statistics(docs)))
    estimates = cut(mcd(_in_levels(rows.where(~F.col("base_failed")))))
    # One row per (lang, source): the most specific of its three groups that has an estimate.
    own = rows.select(*GROUP).distinct().select(*[F.col(c).alias(f"own_{c}") for c in GROUP], F.explode(F.array(*_level_keys())).alias("g"))
    first = Window.partitionBy(*[f"own_{c}" for c in GROUP]).orderBy("level")
    chosen = own.select(*[f"own_{c}" for c in GROUP], "g.*").join(estimates, GROUP).withColumn("place", F.row_number().over(first)).where(
        "place = 1").drop("place", *GROUP).withColumnsRenamed({f"own_{c}": c for c in GROUP})
    chosen = chosen.withColumn("level", F.element_at(F.array(*[F.lit(x) for x in LEVELS]), F.col("level") + 1))
    scaled = F.col("d2") / F.greatest(F.col("med"), F.lit(CHI2_MEDIAN / 4)) * CHI2_MEDIAN
    return _distance(rows.join(chosen, GROUP, "left")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        scaled.alias("distance"), F.when(~F.col("base_failed"), F.col("level")).alias("level"),
        (~F.col("base_failed") & F.coalesce(scaled <= cutoff, F.lit(True))).alias("kept"))
