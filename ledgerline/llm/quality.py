"""Quality rules: base rules, then robust multivariate outliers per language and source.

Base statistics are expressions over one row. Documents that pass the base
rules give a vector of transformed statistics (``FEATURES``); for each language
and source the minimum-covariance-determinant estimate of centre and scatter is
found by concentration steps: from medians and median deviations, the share
``SUPPORT`` of the documents nearest to the centre (Mahalanobis distance) gives
the next centre and covariance, until the steps end. A document whose squared
distance is above ``CUTOFF`` is rejected.

Only DataFrame functions run. Means, covariances and approximate quantiles are
added up map-side, so a group of any size sends a few numbers per partition;
distances use a Cholesky factor written as expressions. A language's documents
are fitted in the same way, and each group's shape is drawn towards its
language's, by the weight of ``PRIOR_ROWS`` documents: a group of n documents
(more than the p statistics) keeps the weight (n - p) / (n - p + PRIOR_ROWS),
one of p or fewer has its language's shape. Languages are never mixed: in a
language of p documents or fewer there is no verdict and they stay. Each statistic has a
least deviation (``FLOOR``), so that a statistic on which a group's documents
all agree doesn't turn a harmless difference into an outlier.

Defined results: NULL and empty texts have 0 words and fail the base rules;
NULL languages and sources are groups of their own; repeated rows count each;
an empty table gives an empty result; ties need no order; extra columns pass
through in ``filter_quality``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD_GAP, let, window_hashes, word_array
from ledgerline.sources.tables import materialize

WINDOW_WORDS = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
SUPPORT = 0.75
STEPS = 4
PRIOR_ROWS = 40
SMALL_FILES = 8
CUTOFF = 60.0
FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
FLOOR = {"word_length": 0.06, "symbols": 0.25, "dup_lines": 0.25, "repeats": 0.12}
LEAST_ROWS = len(FEATURES) + 1
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- statistics of one text -------------------------------------------------

def n_repeat_words(words: Column, size: int = WINDOW_WORDS) -> Column:
    """Words that lie in a window of ``size`` words found twice or more in the text."""
    none = F.lit(0).cast("long")
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) <= size, none).otherwise(
        let(window_hashes(h, size), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(_covered(w, size)))))


def _covered(windows: Column, size: int) -> Column:
    """Words under repeated windows: windows sorted by hash, equal neighbours' starts, spans joined."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(p: Column) -> Column:
        return F.sort_array(F.array_compact(F.transform(p, lambda x, k: F.when(
            F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)), x["i"]))))

    def total(at: Column) -> Column:
        spans = F.transform(at, lambda a, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - a, F.lit(size))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda held, x: held + x)

    return let(let(placed, again), total)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the counts and base_failed; one pass over each text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: F.regexp_like(s, F.lit(WORD_GAP.replace("[", "[^"))))
    rows = docs.withColumn("_words", word_array(text)).withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": n_repeat_words(F.col("_words"))})
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.drop("_words").withColumn("base_failed", failed)


def feature_columns() -> dict[str, Column]:
    """The transformed statistics: logarithms and roots of rates, near normal for prose."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "word_length": F.log(chars / words),
        "symbols": F.log1p(100 * F.col("n_symbols") / chars),
        "dup_lines": F.log1p(F.col("n_dup_lines").cast("double")),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
    }


# --- minimum covariance determinant ------------------------------------------

def consistency(p: int, support: float) -> float:
    """Factor that makes the covariance of the nearest ``support`` of p normal statistics (p even) unbiased."""
    def chi2(x: float, even: int) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(even // 2))

    low, high = 0.0, 100.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2(mid, p) < support else (low, mid)
    return support / chi2(low, p + 2)


@dataclass(frozen=True)
class Shape:
    """Names of a group's centre and lower Cholesky factor."""

    names: tuple[str, ...]

    def centre(self, i: int) -> str:
        return f"_m{i}"

    def factor(self, i: int, j: int) -> str:
        return f"_l{i}{j}"

    def cholesky(self, groups: DataFrame) -> DataFrame:
        """Replace covariances _c{i}{j} by the factor, column after column."""
        p = len(self.names)
        for j in range(p):
            above = {}
            for i in range(j, p):
                rest = F.col(f"_c{i}{j}")
                for k in range(j):
                    rest = rest - F.col(self.factor(i, k)) * F.col(self.factor(j, k))
                above[i] = rest
            groups = groups.withColumn(self.factor(j, j), F.sqrt(above[j]))
            groups = groups.withColumns({self.factor(i, j): above[i] / F.col(self.factor(j, j)) for i in range(j + 1, p)}) if j + 1 < p else groups
        return groups.drop(*[f"_c{i}{j}" for j in range(p) for i in range(j, p)])

    def covariance(self, i: int, j: int) -> Column:
        """Element of the covariance that the factor stands for, i >= j."""
        return sum((F.col(self.factor(i, k)) * F.col(self.factor(j, k)) for k in range(1, j + 1)), F.col(self.factor(i, 0)) * F.col(self.factor(j, 0)))

    def distance(self) -> Column:
        """Squared Mahalanobis distance of a row joined with its group's shape."""
        solved: list[Column] = []
        for i, name in enumerate(self.names):
            rest = F.col(name) - F.col(self.centre(i))
            for k, z in enumerate(solved):
                rest = rest - F.col(self.factor(i, k)) * z
            solved.append(rest / F.col(self.factor(i, i)))
        return sum((z * z for z in solved[1:]), solved[0] * solved[0])


def _small(groups: DataFrame, name: str) -> DataFrame:
    """Write a row per group in a few files, so that its size on disk is that of its rows.

    A file per shuffle partition makes it look too large to broadcast, and the rows of a large group would be dealt by their pool.
    """
    return materialize(groups.repartition(SMALL_FILES), name)


def with_pool(rows: DataFrame) -> DataFrame:
    """Add pool (the language and source) and lang_pool (the language)."""
    return rows.withColumns({"pool": F.concat(F.lit("source "), F.to_json(F.struct("lang", "source"))),
                             "lang_pool": F.concat(F.lit("lang "), F.to_json(F.struct("lang")))})


def fit(rows: DataFrame, names: tuple[str, ...] = FEATURES, floor: dict[str, float] = FLOOR, support: float = SUPPORT,
        steps: int = STEPS, least: int = LEAST_ROWS) -> DataFrame:
    """Shape per pool of rows (pool and feature columns): one row per pool that is large enough."""
    shape, p = Shape(names), len(names)
    factor = consistency(p + p % 2, support)

    def floored(groups: DataFrame) -> DataFrame:
        return shape.cholesky(groups.withColumns({f"_c{i}{i}": F.col(f"_c{i}{i}") + floor[n] ** 2 for i, n in enumerate(names)}))

    middle = rows.groupBy("pool").agg(
        F.count("*").alias("_n"), *[F.percentile_approx(n, 0.5, 1000).alias(shape.centre(i)) for i, n in enumerate(names)])
    middle = _small(middle.where(F.col("_n") >= least).drop("_n"), "middle")
    spread = rows.join(middle, "pool").groupBy("pool").agg(
        *[F.first(shape.centre(i)).alias(shape.centre(i)) for i in range(p)],
        *[F.pow(1.4826 * F.percentile_approx(F.abs(F.col(n) - F.col(shape.centre(i))), 0.5, 1000), 2).alias(f"_c{i}{i}") for i, n in enumerate(names)],
        *[F.lit(0.0).alias(f"_c{i}{j}") for j in range(p) for i in range(j + 1, p)])
    shapes = _small(floored(spread), "shapes")
    for _ in range(steps):
        far = rows.join(shapes, "pool").withColumn("_d", shape.distance())
        nearest = _small(far.groupBy("pool").agg(F.percentile_approx("_d", support, 1000).alias("_h")), "nearest")
        kept = far.join(nearest, "pool").where(F.col("_d") <= F.col("_h"))
        moments = kept.groupBy("pool").agg(
            *[F.avg(n).alias(shape.centre(i)) for i, n in enumerate(names)],
            *[(factor * F.covar_pop(names[i], names[j])).alias(f"_c{i}{j}") for j in range(p) for i in range(j, p)])
        shapes = _small(floored(moments), "shapes")
    return shapes


def group_shapes(rows: DataFrame, prior: int = PRIOR_ROWS) -> DataFrame:
    """Shape per pool of rows, drawn towards its language's shape: one row per pool of a language that is large enough."""
    shape, p = Shape(FEATURES), len(FEATURES)
    good = rows.where(~F.col("base_failed"))
    fitted = fit(good.select(F.explode(F.array("pool", "lang_pool")).alias("pool"), *FEATURES))
    pairs = [(i, j) for j in range(p) for i in range(j, p)]
    flat = fitted.select("pool", *[shape.centre(i) for i in range(p)], *[shape.covariance(i, j).alias(f"_c{i}{j}") for i, j in pairs])
    names = flat.columns[1:]
    groups = rows.groupBy("pool", "lang_pool").agg(F.count_if(~F.col("base_failed")).alias("_n"))
    both = (groups.join(flat.withColumnsRenamed({"pool": "lang_pool", **{c: f"_lang{c}" for c in names}}), "lang_pool")
            .join(flat, "pool", "left").withColumns({c: F.coalesce(c, f"_lang{c}") for c in names}))
    extra = F.greatest(F.col("_n") - p, F.lit(0))
    both = both.withColumn("_w", extra / (extra + prior))

    def drawn(c: str) -> Column:
        return F.col("_w") * F.col(c) + (1 - F.col("_w")) * F.col(f"_lang{c}")

    def apart(i: int) -> Column:
        return F.col(shape.centre(i)) - F.col(f"_lang{shape.centre(i)}")

    # the spread between the two centres belongs to the mixture's covariance
    mixed = both.select("pool", *[drawn(shape.centre(i)).alias(shape.centre(i)) for i in range(p)],
                        *[(drawn(f"_c{i}{j}") + F.col("_w") * (1 - F.col("_w")) * apart(i) * apart(j)).alias(f"_c{i}{j}") for i, j in pairs])
    return _small(shape.cholesky(mixed), "shapes")


def judge(docs: DataFrame, cutoff: float = CUTOFF, text_col: str = "text") -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, distance (NULL without a verdict) and kept, per row of ``docs``."""
    counted = statistics(docs.select("doc_id", "lang", "source", F.col(text_col).alias("text"))).drop("text").withColumns(feature_columns())
    rows = materialize(with_pool(counted), "statistics")  # read by every step
    return (rows.join(group_shapes(rows), "pool", "left").withColumn("distance", Shape(FEATURES).distance())
            .withColumn("kept", ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= cutoff)))
            .select("doc_id", "lang", "source", *COUNTS, "base_failed", "distance", "kept"))


def filter_quality(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Documents that the rules keep, with their columns as they were."""
    kept = judge(docs.select(F.struct(F.col("doc_id"), F.xxhash64("text").alias("h")).alias("doc_id"), "lang", "source", "text"), cutoff)
    names = kept.where("kept").select("doc_id.*", F.col("lang").alias("_lang"), F.col("source").alias("_source"))
    names = names.withColumnsRenamed({"doc_id": "_id", "h": "_h"}).distinct()
    same = (docs["doc_id"].eqNullSafe(names["_id"]) & (F.xxhash64(docs["text"]) == names["_h"])
            & docs["lang"].eqNullSafe(names["_lang"]) & docs["source"].eqNullSafe(names["_source"]))
    return docs.join(names, same, "left_semi")
