"""Quality rules with a robust multivariate outlier test.

Five statistics of a text, transformed so that most texts of a group lie in an ellipsoid, are judged by their
Mahalanobis distance from a minimum-covariance-determinant estimate of their language and source. The estimate is found
by concentration steps from two starts (medians with median deviations, and spatial signs): the rows nearest to the
present estimate, a fixed share of each group, give the next mean and covariance. Every step is an aggregate over all
rows of all groups at once, so a group may be of any size. Quantiles are taken over a grid fine enough not to matter,
which keeps them exact for any order of rows. Of the two results the one with the smaller determinant counts.

A source with too few rows in a language joins the language's other small sources, a language with too few rows there
the small rest of all languages. A rest that is too small is judged by the estimate of its whole language, large sources
included, and where that has fewer than LEAST rows by the estimate of all rows. The length of a text and of its words
depends on the language, so the estimate of all rows judges by the other three statistics. Only a table with fewer than LEAST
rows that pass the base rules has no estimate; there the base rules alone decide. A null language or source is a value of
its own. Null and empty texts have no words and fail the base rules; such rows don't enter the estimates. Repeated rows count
as often as they come. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.llm.words import WITHIN, Packed, mixed, slices
from innledger.session import new_folder

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rows of a group that an estimate is made from, and the fewest it needs.
SHARE, FEWEST = 0.75, 200
STEPS = 3
#: Levels of groups: source, small sources of a language, small rest, whole language, all rows.
SOURCE, SOURCES, REST, LANGUAGE, ALL = range(5)
#: Chi-squared with five degrees of freedom: the median, and the point that one in a million exceeds.
CHI_MEDIAN, CHI_CUT = 4.3515, 35.888
#: The same with three degrees of freedom, and the statistics that depend on the language.
FREE_MEDIAN, FREE_CUT = 2.366, 30.665
BOUND = ("x0", "x1")
#: Least standard deviation of each transformed statistic; without it a statistic that is zero in most texts would make
#: any other value an outlier.
FLOORS = (0.25, 0.05, 0.10, 0.10, 0.10)
DIMS = len(FLOORS)
#: Fewest rows that judge a rest too small for an estimate of its own.
LEAST = DIMS * DIMS
X = [f"x{i}" for i in range(DIMS)]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

STATS = (
    "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, " + ", ".join(f"{x} double" for x in X)
)


def repeats(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How often each hash comes within its owner."""
    _, inverse, counts = np.unique(
        mixed(owner.astype(np.uint64) + np.uint64(1)) ^ hashes, return_inverse=True, return_counts=True
    )
    return counts[inverse]


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    p = Packed(texts)
    n = p.counts.astype(np.int64)
    chars = p.per_text(~p.space & ~WITHIN[p.data])
    symbols = p.per_text(_SYMBOL[p.data])

    line_end = np.flatnonzero(p.data == 10)
    line_begin = np.concatenate(([0], line_end[:-1] + 1)).astype(np.int64)
    has_word = np.searchsorted(p.begin, line_end) > np.searchsorted(p.begin, line_begin)
    line_begin, line_end = line_begin[has_word], line_end[has_word]
    text_of_line = np.searchsorted(p.bounds, line_begin, "right") - 1
    lines = np.bincount(text_of_line, minlength=p.n)
    key = mixed(text_of_line.astype(np.uint64) + np.uint64(1)) ^ p.spans(line_begin, line_end)
    _, at = np.unique(key, return_index=True)
    dup_lines = lines - np.bincount(text_of_line[at], minlength=p.n)

    windows, begin = p.windows(p.words(), 3)
    covered = np.zeros(len(p.begin) + 3, bool)
    again = begin[repeats(p.text_of[begin], windows) > 1]
    for j in range(3):
        covered[again + j] = True
    repeated = np.bincount(p.text_of[covered[: len(p.begin)]], minlength=p.n)

    some = np.maximum(n, 1)
    x = (
        np.log1p(n),
        np.log(np.maximum(chars, 1) / some),
        np.sqrt(symbols / some),
        dup_lines / np.maximum(lines, 1),
        repeated / some,
    )
    return {
        "n_words": n,
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": dup_lines.astype(np.int64),
        "n_repeat_words": repeated.astype(np.int64),
    } | dict(zip(X, x, strict=True))


def text_statistics(documents: DataFrame) -> DataFrame:
    """The counts of every whole text, and the transformed vector x0 to x4: words, length of a word, symbols a word,
    share of repeated lines, share of repeated words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = {c: batch[c] for c in ("doc_id", "lang", "source")}
            yield pa.RecordBatch.from_pydict(keys | statistics(batch["text"]))

    return documents.select("doc_id", "lang", "source", "text").mapInArrow(rows, STATS)


def with_groups(rows: DataFrame, folder: str) -> DataFrame:
    """Each row with the group (`level`, `g_lang`, `g_source`) whose estimate judges it, and whether it enters the estimates
    of its language and of all rows (`in_lang`, `in_all`)."""
    fits = F.count_if(~F.col("base_failed")).alias("n")
    sized = rows.groupBy(F.col("lang").alias("k_lang"), F.col("source").alias("k_source")).agg(fits)
    few = F.col("n") < FEWEST
    by_lang = sized.groupBy(F.col("k_lang").alias("r_lang")).agg(
        F.coalesce(F.sum(F.when(few, F.col("n"))), F.lit(0)).alias("n_rest"), F.sum("n").alias("n_lang"),
        F.count_if(few).alias("few_sources"),
    )
    sized = sized.join(by_lang, F.col("k_lang").eqNullSafe(F.col("r_lang"))).drop("r_lang")
    sized = sized.withColumn("rest", few & (F.col("n_rest") < FEWEST))
    sized.write.parquet(f"{folder}/groups")
    sized = rows.sparkSession.read.schema(sized.schema).parquet(f"{folder}/groups")
    own = F.col("n_lang") >= LEAST
    rest = sized.where("rest").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(~own).alias("strange")).first()
    together = rest["n"] >= FEWEST
    fallback = F.lit(REST) if together else F.when(own, LANGUAGE).otherwise(ALL)
    level = F.when(~few, SOURCE).when(F.col("n_rest") >= FEWEST, SOURCES).otherwise(fallback)
    named = level.isin(SOURCE, SOURCES, LANGUAGE)
    groups = sized.select(
        "k_lang",
        "k_source",
        level.alias("level"),
        F.when(named, F.coalesce("k_lang", F.lit("\0"))).otherwise(F.lit("")).alias("g_lang"),
        F.when(level == SOURCE, F.coalesce("k_source", F.lit("\0"))).otherwise(F.lit("")).alias("g_source"),
        # Some sources of the language are a rest without an estimate of its own.
        (F.lit(not together) & own & (F.col("n_rest") < FEWEST) & (F.col("few_sources") > 0)).alias("in_lang"),
        F.lit(not together and rest["strange"] > 0).alias("in_all"),
    )
    same = F.col("lang").eqNullSafe(F.col("k_lang")) & F.col("source").eqNullSafe(F.col("k_source"))
    return rows.join(groups, same).drop("k_lang", "k_source")


def comparable(rows: DataFrame) -> DataFrame:
    """The statistics that an estimate of the row's level compares; the others are zero."""
    return rows.withColumns({x: F.when(F.col("level") == ALL, F.lit(0.0)).otherwise(F.col(x)) for x in BOUND})


def contributions(rows: DataFrame) -> DataFrame:
    """KEYS and statistics of the rows of every estimate; a row may enter several."""
    own = F.when(F.col("level") < LANGUAGE, F.struct("level", "g_lang", "g_source"))
    key = lambda level, lang: F.struct(F.lit(level).alias("level"), lang.alias("g_lang"), F.lit("").alias("g_source"))
    language = F.when(F.col("in_lang"), key(LANGUAGE, F.coalesce("lang", F.lit("\0"))))
    everything = F.when(F.col("in_all"), key(ALL, F.lit("")))
    keys = F.explode(F.array_compact(F.array(own, language, everything))).alias("key")
    return comparable(rows.select(keys, *X).select("key.*", *X))


KEYS = ["level", "g_lang", "g_source"]
PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
#: Starts, and bins a unit of a statistic and of the logarithm of a distance.
STARTS, X_BINS, D_BINS = 2, 1000, 512


def distance() -> Column:
    """Squared Mahalanobis distance under the joined estimate (`m`, `w`)."""
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        product = F.col("w")[k] * (F.col(X[i]) - F.col("m")[i]) * (F.col(X[j]) - F.col("m")[j])
        total = total + (product if i == j else product * 2)
    return F.greatest(total, F.lit(0.0))


def _bin(d: Column) -> Column:
    return F.floor(F.log1p(d) * D_BINS)


def _moments(weight: Column, shifts: list[Column]) -> list[Column]:
    """Weighted count, sums and sums of products."""
    xs = [weight * s for s in shifts]
    return [
        F.sum(weight).alias("n"),
        F.array(*[F.sum(x) for x in xs]).alias("s"),
        F.array(*[F.sum(xs[i] * shifts[j]) for i, j in PAIRS]).alias("ss"),
    ]


ESTIMATE = "level int, g_lang string, g_source string, start int, m array<double>, w array<double>, logdet double"


def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Means, inverse covariances (upper halves, row by row) and log determinants from sums about `c`."""
    floor = np.diag(np.square(FLOORS))
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            n, s = max(row.n, 1.0), np.array(row.s, float)
            shift = s / n
            cov = np.zeros((DIMS, DIMS))
            for value, (i, j) in zip(row.ss, PAIRS, strict=True):
                cov[i, j] = cov[j, i] = value / n - shift[i] * shift[j]
            cov += floor
            inverse = np.linalg.inv(cov)
            mean = np.array(row.c, float) + shift
            out.append((row.level, row.g_lang, row.g_source, row.start, mean.tolist(),
                        [inverse[i, j] for i, j in PAIRS], float(np.linalg.slogdet(cov)[1])))
        yield pd.DataFrame(out, columns=[*KEYS, "start", "m", "w", "logdet"])


def mcd(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """The estimate of every group with enough rows: KEYS, mean `m`, inverse covariance `w`, scaled so that the median
    squared distance of the group is that of chi-squared."""

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    centres = kept(
        rows.groupBy(*KEYS)
        .agg(
            F.count("*").alias("rows"),
            F.array(*[F.percentile(F.floor(F.col(x) * X_BINS), 0.5) / X_BINS for x in X]).alias("c"),
        )
        .where(F.col("rows") >= F.when(F.col("level") < LANGUAGE, FEWEST).otherwise(LEAST))
        .drop("rows"),
        "centres",
    )
    about = rows.join(centres, KEYS)
    shifts = [F.col(x) - F.col("c")[i] for i, x in enumerate(X)]
    deviations = kept(
        about.groupBy(*KEYS, "c").agg(
            F.array(*[F.percentile(F.floor(F.abs(s) * X_BINS), 0.5) / X_BINS * 1.4826 for s in shifts]).alias("d")
        ),
        "deviations",
    )
    # Start 0: independent statistics with these deviations. Start 1: covariance of the directions from the centre.
    zeros = F.array(*[F.lit(0.0)] * DIMS)
    diagonal = F.array(*[(F.col("d")[i] * F.col("d")[i]) if i == j else F.lit(0.0) for i, j in PAIRS])
    first = deviations.select(
        *KEYS, "c", F.lit(0).alias("start"), F.lit(1.0).alias("n"), zeros.alias("s"), diagonal.alias("ss")
    )
    scaled = [(F.col(x) - F.col("c")[i]) / F.greatest(F.col("d")[i], F.lit(f)) for i, (x, f) in enumerate(zip(X, FLOORS, strict=True))]
    length = F.sqrt(sum((s * s for s in scaled), F.lit(0.0)))
    unit = [F.when(length > 0, s / length).otherwise(F.lit(0.0)) for s in scaled]
    spread = [F.greatest(F.col("d")[i], F.lit(f)) for i, f in enumerate(FLOORS)]
    signs = (
        rows.join(deviations, KEYS)
        .groupBy(*KEYS, "c", "d")
        .agg(F.count("*").cast("double").alias("n"), F.array(*[F.sum(unit[i] * unit[j]) * DIMS for i, j in PAIRS]).alias("u"))
    )
    second = signs.select(
        *KEYS, "c", F.lit(1).alias("start"), "n", zeros.alias("s"),
        F.array(*[F.col("u")[k] * spread[i] * spread[j] for k, (i, j) in enumerate(PAIRS)]).alias("ss"),
    )
    columns = [*KEYS, "start", "c", "n", "s", "ss"]
    estimate = kept(first.select(*columns).unionByName(second.select(*columns)).mapInPandas(solve, ESTIMATE), "start")

    for step in range(STEPS):
        judged = rows.join(estimate, KEYS).select(*KEYS, "start", "m", "w", *X, _bin(distance()).alias("bin"))
        limits = kept(judged.groupBy(*KEYS, "start").agg(F.percentile("bin", SHARE).alias("limit")), f"limit{step}")
        near = judged.join(limits.withColumnRenamed("start", "l_start"), KEYS).where("start = l_start and bin <= limit")
        about = [F.col(x) - F.col("m")[i] for i, x in enumerate(X)]
        sums = near.groupBy(*KEYS, "start", F.col("m").alias("c")).agg(*_moments(F.lit(1.0), about))
        estimate = kept(sums.select(*columns).mapInPandas(solve, ESTIMATE), f"step{step}")

    best = estimate.groupBy(*KEYS).agg(F.min_by(F.struct("m", "w"), F.struct("logdet", "start")).alias("e"))
    best = best.select(*KEYS, "e.m", "e.w")
    medians = rows.join(best, KEYS).groupBy(*KEYS, "m", "w").agg(F.percentile(_bin(distance()), 0.5).alias("bin"))
    median = F.when(F.col("level") == ALL, FREE_MEDIAN).otherwise(CHI_MEDIAN)
    scale = median / F.greatest(F.expm1((F.col("bin") + 0.5) / D_BINS), median)
    # A group tighter than the floors is not stretched: its distances are used as they are.
    return kept(medians.select(*KEYS, "m", F.transform("w", lambda v: v * scale).alias("w")), "estimate")


def quality_rules(documents: DataFrame, cut: float = CHI_CUT, free_cut: float = FREE_CUT) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the squared distance (null without an estimate)."""
    spark = documents.sparkSession
    folder = new_folder(spark, "quality")
    text_statistics(documents).write.parquet(f"{folder}/stats")
    stats = spark.read.schema(STATS).parquet(f"{folder}/stats")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    grouped = with_groups(stats.withColumn("base_failed", failed), folder)
    estimate = mcd(contributions(grouped.where("not base_failed")), spark, folder)
    d = F.when(F.col("m").isNotNull(), distance())
    judged = comparable(grouped).join(estimate, KEYS, "left").withColumn("distance", d)
    bar = F.when(F.col("level") == ALL, free_cut).otherwise(cut)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= bar, F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "distance",
    )
