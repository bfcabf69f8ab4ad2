"""Quality rules: base rules, then robust multivariate outliers per language and source.

Every text becomes a vector of ``SIZE`` transformed statistics (log mean word length,
square roots of the shares of symbols, repeated lines and repeated words; shares and mean
are drawn to a prior by some pseudo-words, as those of short texts vary more). From the
documents that pass the base rules, the minimum-covariance-determinant estimate is found
for each language and source, for each language, and for all. Each starts three times
(medians with ``FLOORS`` as scales, medians with interquartile ranges, and mean with
covariance), takes ``STEPS`` concentration steps (mean and covariance of the ``SHARE`` of
vectors that lie nearest by Mahalanobis distance), and goes on with the start whose
covariance has the least determinant, which is made consistent and reweighted once.
``FLOORS``, added to the covariances' diagonals, keep statistics that hardly vary (most
texts have no symbol at all) from making them singular.

A group's estimate is drawn to that of the group around it (a source's to its language's,
a language's to that of all) by ``PSEUDO`` pseudo-documents, so that every document is
judged, and no size switches the judgement. A document is rejected whose squared distance
exceeds the chi-square quantile at ``CUT``.

The share that lies nearest is counted by bins of the distance (``BINS`` to each doubling;
the bin that reaches the share belongs to it), so that a step is one pass of sums, which
are combined before they are shuffled. Everything is a DataFrame function: a Cholesky
factor is columns of one row a group, and groups' estimates come by joins with that table,
each copied to ``SALTS`` parts of its group, so that no large group meets in one task.

Defined results: null text has no words. Null languages and sources are groups like any
other. Rows with equal or null ``doc_id`` are kept. ``d2`` is null only if no document at
all passes the base rules. Other columns are dropped. No documents, no rows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, staged

WINDOW = 5
SIZE = 4
SHARE = 0.75
STEPS = 3
CUT = 1 - 1e-7
FLOORS = (0.03, 0.05, 0.10, 0.05)
BINS = 8
PSEUDO = 50
SALTS = 32
PRIOR_WORDS, PRIOR_LENGTH = 40, 6.0
ALL = "all"
BLANK = r"[ \t-\r]+"
SYMBOLS = "[#*$%&|<>]"


def chi_square(x: float, half_degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for k in range(1, half_degrees):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, half_degrees: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, half_degrees) < p else (low, middle)
    return high


def repeated_words(df: DataFrame, words: str, result: str) -> DataFrame:
    """Add the number of words in windows of WINDOW words that the text holds twice or
    more. Only texts that hold one sort their windows. Each word is hashed once, each
    window from its words' hashes; ``get`` gives null outside of an array."""
    hashed = df.withColumn("_x", F.transform(words, lambda w: F.xxhash64(w)))
    windows = F.transform("_x", lambda x, i: F.xxhash64(x, *[F.get("_x", i + k) for k in range(1, WINDOW)]))
    within = F.slice(windows, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    twice = hashed.withColumn("_h", within).withColumn("_twice", F.size(F.array_distinct("_h")) < F.size("_h"))
    ordered = twice.withColumn("_s", F.when(F.col("_twice"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda s, k: F.coalesce(s["h"] == F.get("_s", k)["h"], F.lit(False))
    marked = ordered.withColumn("_p", F.when(F.col("_twice"), F.sort_array(F.transform(F.filter("_s", lambda s, k: same(s, k - 1) | same(s, k + 1)), lambda s: s["i"]))))
    step = lambda i, k: F.coalesce(F.least(F.lit(WINDOW), F.get("_p", k + 1) - i), F.lit(WINDOW))
    covered = F.aggregate(F.transform("_p", step), F.lit(0), lambda a, x: a + x)
    return marked.withColumn(result, F.coalesce(covered, F.lit(0)).cast("long")).drop("_x", "_h", "_twice", "_s", "_p")


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines) of every row; the number of lines counts those with a word."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(F.col("doc_id"), F.col("lang").cast("string"), F.col("source").cast("string"), text.alias("_t"))
    split = read.select(
        "doc_id", "lang", "source",
        F.filter(F.split("_t", BLANK), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("_l"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    counts = {"n_words": F.size("_w").cast("long"), "word_chars": F.length(F.array_join("_w", "")).cast("long"), "n_lines": F.size("_l").cast("long"), "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long")}
    return repeated_words(split.withColumns(counts).drop("_l"), "_w", "n_repeat_words").select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def vectors() -> list[Column]:
    words, chars = F.col("n_words") + PRIOR_WORDS, F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH
    return [
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5)),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def distances(rows: DataFrame) -> DataFrame:
    """``rows`` (x0 ..., m0 ..., l00 ...) with d2; each step of the substitution is a column."""
    for i in range(SIZE):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"z{j}")
        rows = rows.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, SIZE)), F.col("z0") * F.col("z0"))).drop(*[f"z{i}" for i in range(SIZE)])


PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]


def factored(rows: DataFrame) -> DataFrame:
    """``rows`` (c00 ...: covariances) with their Cholesky factor l00 ... in place of them."""
    for i, j in PAIRS:
        value = F.col(f"c{i}{j}")
        for k in range(j):
            value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        rows = rows.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(1e-9))) if i == j else value / F.col(f"l{j}{j}"))
    return rows.drop(*[f"c{i}{j}" for i, j in PAIRS])


def moments() -> list[Column]:
    """Sums that are combined before a shuffle: n, s0 ..., q00 ... (of products)."""
    return [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(SIZE)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS]]


def from_moments(sums: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """(keys, n, m0 ..., c00 ...): mean, and scale x covariance + floors."""
    mean = [F.col(f"s{i}") / F.col("n") for i in range(SIZE)]
    spread = [(scale * (F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]) + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    return sums.select(*keys, "n", *[m.alias(f"m{i}") for i, m in enumerate(mean)], *spread)


def starts(rows: DataFrame) -> DataFrame:
    """(g, start, m0 ..., l00 ...): three starts of each group of rows (g, x0 ...)."""
    quartiles = [F.percentile_approx(f"x{i}", F.array(*map(F.lit, (0.25, 0.5, 0.75))), 1000).alias(f"p{i}") for i in range(SIZE)]
    found = rows.groupBy("g").agg(*moments(), *quartiles)
    middle = [F.col(f"p{i}")[1].alias(f"m{i}") for i in range(SIZE)]
    scales = (lambda i: F.lit(FLOORS[i] ** 2), lambda i: F.pow((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, F.lit(2.0)) + FLOORS[i] ** 2)
    parts = [found.select("g", F.lit(k).alias("start"), *middle, *[(f(i) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS]) for k, f in enumerate(scales)]
    parts.append(from_moments(found.withColumn("start", F.lit(len(scales))), ["g", "start"], 1.0).drop("n"))
    return factored(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def salted(found: DataFrame) -> DataFrame:
    """A row of each group for each part of it."""
    return found.withColumn("salt", F.explode(F.array(*[F.lit(k).cast("long") for k in range(SALTS)])))


def concentrated(rows: DataFrame, found: DataFrame, scale: float) -> DataFrame:
    """A concentration step of each group and start: the sums of each bin of the distance,
    and of those bins that together hold the share."""
    placed = distances(rows.join(salted(found), ["g", "salt"]))
    level = F.floor(BINS * F.log2(F.col("d2") + 1e-6)).cast("int")
    sums = placed.groupBy("g", "start", level.alias("level")).agg(*moments())
    every = Window.partitionBy("g", "start")  # a row a bin
    before = F.sum("n").over(every.orderBy("level")) - F.col("n")
    nearest = sums.withColumns({"_before": before, "_all": F.sum("n").over(every)}).where(F.col("_before") < SHARE * F.col("_all"))
    whole = nearest.groupBy("g", "start").agg(*[F.sum(c).alias(c) for c in ("n", *[f"s{i}" for i in range(SIZE)], *[f"q{i}{j}" for i, j in PAIRS])])
    return factored(from_moments(whole, ["g", "start"], scale).drop("n"))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """(g, n, m0 ..., c00 ...): the reweighted minimum-covariance-determinant estimate of each
    group of rows (g, x0 ...), and from how many rows."""
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    found = staged(starts(rows), "starts")
    inner = chi_square_quantile(SHARE, SIZE // 2)
    consistent = SHARE / chi_square(inner, SIZE // 2 + 1)
    for step in range(STEPS):
        found = staged(concentrated(rows, found, consistent if step == STEPS - 1 else 1.0), "estimates")
    volume = reduce(mul, [F.col(f"l{i}{i}") for i in range(SIZE)])
    values = [f"m{i}" for i in range(SIZE)] + [f"l{i}{j}" for i, j in PAIRS]
    least = found.groupBy("g").agg(F.min(F.struct(volume.alias("volume"), "start", *values)).alias("_e")).select("g", *[F.col(f"_e.{v}").alias(v) for v in values])
    within = chi_square_quantile(0.975, SIZE // 2)
    near = distances(rows.join(salted(least), ["g", "salt"])).where(F.col("d2") <= within)
    return from_moments(near.groupBy("g").agg(*moments()), ["g"], 0.975 / chi_square(within, SIZE // 2 + 1))


def drawn_to(own: dict[str, Column], around: dict[str, Column]) -> dict[str, Column]:
    """An estimate with ``PSEUDO`` documents of the one around it; that one if there is none."""
    n = F.coalesce(own["n"], F.lit(0))
    share = {k: F.when(n > 0, (n * own[k] + PSEUDO * around[k]) / (n + PSEUDO)).otherwise(around[k]) for k in own if k != "n"}
    return {"n": n} | share


def group_estimates(rows: DataFrame) -> DataFrame:
    """(_both, m0 ..., l00 ...) of each language and source of rows (_lang, _both, valid, x0 ...)."""
    values = ["n", *[f"m{i}" for i in range(SIZE)], *[f"c{i}{j}" for i, j in PAIRS]]
    xs = [f"x{i}" for i in range(SIZE)]
    nested = rows.where("valid").select(F.explode(F.array(F.lit(ALL), "_lang", "_both")).alias("g"), *xs)
    found = staged(robust_estimates(nested), "groups")

    def of(level: str) -> DataFrame:
        return found.select(F.col("g").alias(f"{level}_g"), *[F.col(v).alias(f"{level}_{v}") for v in values])

    groups = rows.groupBy("_both", "_lang").agg(F.count("*").alias("rows")).withColumn("_all", F.lit(ALL))
    for level, key in (("own", "_both"), ("lang", "_lang"), ("all", "_all")):
        groups = groups.join(of(level), F.col(key) == F.col(f"{level}_g"), "left")
    column = lambda level: {v: F.col(f"{level}_{v}") for v in values}
    blended = drawn_to(column("own"), drawn_to(column("lang"), column("all")))
    return factored(groups.select("_both", *[blended[v].alias(v) for v in values if v != "n"]))


def quality_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, the statistics, base_failed, d2, kept) of documents (doc_id, text, lang, source)."""
    stats = staged(statistics(docs), "statistics").withColumn("base_failed", base_failed())
    lang, source = (F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("lang", "source"))
    keys = {"_lang": F.concat(F.lit("lang"), lang), "_both": F.concat(F.lit("both"), lang, F.lit("\x00"), source), "valid": ~F.col("base_failed")}
    rows = stats.select("*", *[v.alias(f"x{i}") for i, v in enumerate(vectors())]).withColumns(keys)
    judged = distances(rows.join(staged(group_estimates(rows), "estimates"), "_both"))
    far = F.coalesce(F.col("d2") > chi_square_quantile(CUT, SIZE // 2), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2", "kept")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))
