"""Deletion of repeated line runs by a suffix array over line ids, built by prefix doubling.

The suffixes are the lines with a word, in the order of documents and lines; a suffix ends with its document. Rank 0 of a
suffix orders it by its first line, rank j by its first 2**j lines: the rank of the pair (rank j-1 here, rank j-1 that
many lines on), pairs being numbered in sorted order. Suffixes whose first 2**j lines come once only get no rank j, as
nothing longer can repeat there; so each round has fewer rows. Since a run counts as repeated from MIN_WORDS words on
and a line with a word has one at least, six ranks suffice.

An interval of the suffix array whose common prefix has MIN_WORDS words is the set of equal windows of that many words:
the shortest that begin, or end, at a line. Equal windows have equal pairs of overlapping ranks. A maximal repeated run is
the union of such windows, and in each interval all but the first in document order are later copies, whose lines are
deleted. A run that repeats within its own document, even overlapping itself, keeps its first lines.

Everything is joins, windows within a document and grouped counts; no group of equal lines is gathered. All tables of a
round lie in the shared folder.

Null and empty texts stay as they are, and so do lines without a word. Rows that repeat id and text are one document with
one result each; other texts under the same id are documents of their own, ordered by a hash. Null ids come first. An
empty table gives no rows. Further columns are kept unless they bear the names of results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innledger.session import new_folder

MIN_WORDS = 50
WORD = "[^ \\x09-\\x0D]+"
DOC = ["doc_id", "_text"]
PLACE = [*DOC, "seq"]


def _same(left: str, right: str, columns: list[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def removed_lines(documents: DataFrame, folder: str, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, _text (a hash of the text) and `removed`: the numbers of the lines to delete, from 0, ascending."""
    spark = documents.sparkSession

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    numbered = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("line_no"), line.alias("line")))
    visible = F.filter(numbered, lambda x: x["line"].rlike("[^ \\x09-\\x0D]"))
    rows = documents.where("text is not null").select("doc_id", F.xxhash64("text").alias("_text"), F.posexplode(visible).alias("seq", "l"))
    lines = kept(
        rows.select(
            *PLACE,
            "l.line_no",
            F.xxhash64("l.line").alias("h1"),
            F.xxhash64(F.lit(1), "l.line").alias("h2"),
            F.regexp_count("l.line", F.lit(WORD)).alias("words"),
        ),
        "lines",
    )

    def ranks(frame: DataFrame, keys: list[str], name: str) -> DataFrame:
        """Sorted numbers of the keys that come more than once."""
        # Repeated rows of one document are no repetition: the same place counts once.
        places = F.struct(*PLACE)
        repeated = frame.groupBy(*keys).agg(F.min(places).alias("low"), F.max(places).alias("high")).where("low <> high")
        ordered = repeated.select(*keys).orderBy(*keys).withColumn("rank", F.monotonically_increasing_id())
        return kept(ordered, name)

    first = ranks(lines, ["h1", "h2"], "rank0")
    level = lines.join(first, ["h1", "h2"]).select(*PLACE, "line_no", "words", F.col("rank").alias("r0"))
    level = kept(level.dropDuplicates(PLACE), "level0")
    rounds = max(min_words - 1, 1).bit_length() - 1
    ordered = Window.partitionBy(*DOC).orderBy("seq")
    for j in range(1, rounds + 1):
        step, before, now = 1 << (j - 1), f"r{j - 1}", f"r{j}"
        following = F.when(F.lead("seq", step).over(ordered) == F.col("seq") + step, F.lead(before, step).over(ordered))
        paired = kept(level.withColumn("_next", following), f"paired{j}")
        both = paired.where(F.col(before).isNotNull() & F.col("_next").isNotNull())
        numbers = ranks(both, [before, "_next"], f"rank{j}")
        level = kept(paired.join(numbers, [before, "_next"], "left").drop("_next").withColumnRenamed("rank", now), f"level{j}")

    # Stretches of lines that each repeat somewhere; only within them can a run repeat.
    stretch = F.col("seq") - F.row_number().over(ordered)
    in_stretch = level.withColumn("_stretch", stretch)
    by_stretch = Window.partitionBy(*DOC, "_stretch").orderBy("seq")
    ahead = F.collect_list("words").over(by_stretch.rowsBetween(0, min_words - 1))
    behind = F.reverse(F.collect_list("words").over(by_stretch.rowsBetween(1 - min_words, 0)))
    total = F.sum("words").over(Window.partitionBy(*DOC, "_stretch"))
    long_enough = in_stretch.withColumn("_total", total).where(F.col("_total") >= min_words)

    def shortest(words: Column) -> Column:
        """How many of the words' lines it takes to reach the minimum; null if all are too few."""
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
        reached = F.aggregate(
            words,
            start,
            lambda a, w: F.when(a["sum"] >= min_words, a).otherwise(
                F.struct((a["sum"] + w).alias("sum"), (a["n"] + 1).alias("n"))
            ),
        )
        return F.when(reached["sum"] >= min_words, reached["n"])

    sized = long_enough.select(*PLACE, shortest(ahead).alias("n_ahead"), shortest(behind).alias("n_behind"))
    begins = sized.where("n_ahead is not null").select(*PLACE, F.col("n_ahead").alias("n"))
    ends = sized.where("n_behind is not null").select(*DOC, (F.col("seq") - F.col("n_behind") + 1).alias("seq"), F.col("n_behind").alias("n"))
    windows = kept(begins.unionByName(ends).distinct(), "windows")

    power = F.floor(F.log2("n") + 1e-9).cast("int")
    all_ranks = F.array(*[f"r{j}" for j in range(rounds + 1)])

    def rank_at(frame: DataFrame, offset: Column, name: str) -> DataFrame:
        here = level.select(*DOC, F.col("seq").alias("_at"), all_ranks.alias("_ranks")).alias("here")
        there = frame.withColumn("_at", F.col("seq") + offset).alias("there")
        joined = there.join(here, _same("there", "here", [*DOC, "_at"]))
        return joined.select("there.*", F.element_at("_ranks", F.col("k") + 1).alias(name)).drop("_at")

    named = rank_at(windows.withColumn("k", power), F.lit(0), "left")
    named = rank_at(named, F.col("n") - F.pow(F.lit(2), F.col("k")).cast("int"), "right")
    named = kept(named.where("left is not null and right is not null").select(*PLACE, "n", "left", "right"), "named")
    intervals = kept(named.groupBy("n", "left", "right").agg(F.min(F.struct(*PLACE)).alias("first")), "intervals")
    later = named.join(intervals, ["n", "left", "right"]).where(F.struct(*PLACE) != F.col("first"))
    gone = later.select(*DOC, F.explode(F.sequence("seq", F.col("seq") + F.col("n") - 1)).alias("seq")).distinct()
    places = gone.alias("gone").join(level.alias("at"), _same("gone", "at", PLACE)).select("gone.doc_id", "gone._text", "at.line_no")
    return kept(places.groupBy(*DOC).agg(F.sort_array(F.collect_list("line_no")).alias("removed")), "removed")


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later copies of repeated runs deleted from `text`, and `removed`: which lines went."""
    removed = removed_lines(documents.select("doc_id", "text"), new_folder(documents.sparkSession, "lines"), min_words)
    own = documents.drop("removed", "_text").withColumn("_text", F.xxhash64("text")).alias("own")
    # Merged and never broadcast: the same plan at any size.
    joined = own.join(removed.alias("gone").hint("merge"), _same("own", "gone", DOC), "left").select("own.*", "removed")
    lines = F.split("text", "\n")
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n")
    )
    return joined.withColumn("text", text).drop("_text").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
