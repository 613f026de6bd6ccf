"""Phrase collocations per language: contiguous phrases of 2 to 4 words that occur more often than their parts suggest.

Texts are cut into pieces at punctuation and line ends, pieces into words at spaces and tabs; A-Z count as a-z. Every n-gram
within a piece has a Rabin-Karp fingerprint, read off prefix polynomials in numpy: over the bytes for words, over the words'
numbers for n-grams. What is shuffled is a fingerprint, its number of occurrences in a chunk of texts, and the least and
greatest of their marks. A mark is a second fingerprint of 32 bits and a pointer of 32 bits (text and word number).

An n-gram can't be frequent unless its words, and beyond two words its pairs, are; so words are counted first, then pairs
of frequent words, then longer ones of frequent pairs. Which fingerprints are frequent is told to tasks by a bit
table of at most 2**MOST_BITS bits; what it lets through wrongly is counted and falls short. One further scan takes
the text of every frequent fingerprint from the occurrences with its least and its greatest mark. If the two differ, different
phrases share the fingerprint: these are counted by their text instead, in a scan of their own that is rarely needed.

Null languages count as `und`, null and empty texts as having no words. Repeated rows count as often as they occur. An
empty table gives no phrases. Further columns are not read, and texts are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innledger.llm.words import BASE, CHUNK_BYTES, byte_codes, mixed, powers, slices

LEAST, LONGEST, TOP, SCALE = 30, 4, 2000, 2_000_000
#: A phrase goes if a longer one that holds it has this percentage of its occurrences.
COVERED = 80
UNKNOWN = "und"
#: N-grams a task gathers before it folds them.
RUN_GRAMS = 2_000_000
#: Bits of a table for each of its keys, and the size of a table: 16 MiB at most, however many keys there are.
KEY_BITS, LEAST_BITS, MOST_BITS = 32, 16, 27
_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t")] = True
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LOW32 = np.uint64(0xFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _number(text: str) -> np.uint64:
    """A 64-bit number of a short text."""
    value = np.uint64(len(text.encode()))
    with np.errstate(over="ignore"):
        for byte in text.encode():
            value = value * BASE + np.uint64(byte + 1)
    return mixed(np.array([value]))[0]


class Grams:
    """Words of a run of texts, with two numbers for each."""

    def __init__(self, texts: list[bytes], langs: list[str], mask: int = -1):
        joined = b"\n".join(texts) + b"\n"
        self.joined, self.langs, self.mask = joined, langs, np.uint64(mask & (2**64 - 1))
        data = np.frombuffer(joined, np.uint8)
        edges = _EDGE[data]
        word = ~(edges | _BLANK[data])
        turn = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0)))
        self.begin, self.end = turn[::2], turn[1::2]
        breaks = np.flatnonzero(edges)
        self.piece = np.searchsorted(breaks, self.begin)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.text_of = np.searchsorted(bounds, self.begin, "right")
        first = np.searchsorted(self.text_of, np.arange(len(texts) + 1))
        self.per_text = np.diff(first)
        codes = byte_codes(lower=True)
        self.numbers = [self._words(data, codes), self._words(data, mixed(codes) | np.uint64(1))]
        up, down = powers(len(self.begin) + 1)
        self.down = down
        self.sums = []
        for numbers in self.numbers:
            sums = np.zeros(len(numbers) + 1, np.uint64)
            np.cumsum(numbers * up[: len(numbers)], dtype=np.uint64, out=sums[1:])
            self.sums.append(sums)
        known = {lang: _number(lang) for lang in set(langs)}
        lang = np.array([known[x] for x in langs], np.uint64)
        self.lang = lang[self.text_of]
        whole = mixed((self.sums[0][first[1:]] - self.sums[0][first[:-1]]) * down[first[:-1]] + lang)
        place = (np.arange(len(self.begin)) - first[self.text_of]).astype(np.uint64)
        self.pointer = mixed(whole[self.text_of] + place * _ODD) & _LOW32

    def _words(self, data: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """A number for each word's bytes, from prefix sums over a stretch of words at a time."""
        out = np.zeros(len(self.begin), np.uint64)
        at = 0
        while at < len(out):
            base = self.begin[at]
            stop = max(at + 1, int(np.searchsorted(self.end, base + CHUNK_BYTES, "right")))
            size = self.end[stop - 1] - base
            up, down = powers(size + 1)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(codes[data[base : base + size]] * up[:size], dtype=np.uint64, out=sums[1:])
            begin, end = self.begin[at:stop] - base, self.end[at:stop] - base
            out[at:stop] = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
            at = stop
        return out

    def of(self, n: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, fingerprint and mark of every n-gram, or of those that start at the words `among`."""
        if among is None:
            among = np.arange(max(len(self.begin) - n + 1, 0))
        else:
            among = among[among + n <= len(self.begin)]
        among = among[self.piece[among] == self.piece[among + n - 1]]
        seed = self.lang[among] + np.uint64(n)
        found = [mixed((sums[among + n] - sums[among]) * self.down[among] + seed) for sums in self.sums]
        prints = (found[0] & self.mask).view(np.int64)
        return among, prints, ((found[1] << np.uint64(32)) | self.pointer[among]).view(np.int64)

    def phrase(self, first: int, n: int) -> str:
        words = [self.joined[self.begin[i] : self.end[i]] for i in range(first, first + n)]
        return b" ".join(words).translate(_LOWER).decode()


class Bits:
    """A table of bits that has two set for every key."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64)
        out = np.ones(len(keys), bool)
        for place in (keys >> np.uint64(64 - self.bits), keys & np.uint64((1 << self.bits) - 1)):
            out &= ((self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
        return out


def bit_table(keys: DataFrame) -> Bits:
    """The bits of all values of the only column; at most 2**MOST_BITS / 64 rows reach the driver."""
    key = F.col(keys.columns[0])
    count = keys.count()
    bits = min(max(int(KEY_BITS * count).bit_length(), LEAST_BITS), MOST_BITS)
    places = F.array(F.shiftrightunsigned(key, 64 - bits), key.bitwiseAND(F.lit((1 << bits) - 1)))
    rows = keys.select(F.explode(places).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    filled = rows.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("value")).toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[filled["word"].to_numpy()] = filled["value"].to_numpy()
    return Bits(words.view(np.uint64), bits)


def _pointed(prints: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Key of an occurrence, in which fingerprint and pointer are in both halves."""
    return prints ^ marks ^ (marks << 32)


def _runs(batches: Iterator[pa.RecordBatch], mask: int) -> Iterator[Grams]:
    for batch in slices(batches):
        texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
        yield Grams(texts, batch["lang"].to_pylist(), mask)


def _starts(grams: Grams, n: int, frequent: Bits | None) -> np.ndarray | None:
    """First words of the n-grams that may be frequent: those whose words (n = 2) or pairs are."""
    if n == 1 or frequent is None:
        return None
    part = min(n - 1, 2)
    among, prints, _ = grams.of(part)
    good = np.zeros(len(grams.begin) + n, bool)
    good[among[frequent.has(prints)]] = True
    starts = np.flatnonzero(good)
    for step in range(1, n - part + 1):
        starts = starts[good[starts + step]]
    return starts


def _folded(prints: list[np.ndarray], marks: list[np.ndarray]) -> pa.RecordBatch:
    keys, marks = np.concatenate(prints), np.concatenate(marks)
    order = np.argsort(keys)
    keys, marks = keys[order], marks[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return pa.RecordBatch.from_pydict(
        {
            "print": keys[new],
            "n": np.diff(new, append=len(keys)),
            "least": np.minimum.reduceat(marks, new),
            "most": np.maximum.reduceat(marks, new),
        }
    )


def _frequent(texts: DataFrame, sizes: tuple[int, ...], below: Bits | None, least: int, mask: int) -> DataFrame:
    """print, n, least and most mark of the n-grams of these sizes that occur `least` times or more."""
    table = texts.sparkSession.sparkContext.broadcast(below)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints: list[np.ndarray] = []
        marks: list[np.ndarray] = []
        size = 0
        for grams in _runs(batches, mask):
            for n in sizes:
                _, found, found_marks = grams.of(n, _starts(grams, n, table.value))
                prints.append(found)
                marks.append(found_marks)
                size += len(found)
            if size > RUN_GRAMS:
                yield _folded(prints, marks)
                prints, marks, size = [], [], 0
        if size:
            yield _folded(prints, marks)

    rows = texts.mapInArrow(count, "print long, n long, least long, most long")
    folded = rows.groupBy("print").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    return folded.where(F.col("n") >= least)


def _occurrences(
    texts: DataFrame, sizes: range, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray], mask: int, by_mark: bool
) -> DataFrame:
    """print, mark, lang, phrase and number of the wanted n-grams of each run of texts.

    With `by_mark` each mark is told apart and there are rows without a phrase that hold the words of a language;
    else phrases are counted by their text, and the mark is 0.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _runs(batches, mask):
            found: Counter[tuple] = Counter()
            if by_mark:
                for lang, n_words in zip(grams.langs, grams.per_text.tolist(), strict=True):
                    found[0, 0, lang, None] += n_words
            for n in sizes:
                among, prints, marks = grams.of(n)
                hit = np.flatnonzero(wanted(prints, marks))
                columns = (among[hit].tolist(), prints[hit].tolist(), marks[hit].tolist())
                for first, key, mark in zip(*columns, strict=True):
                    lang = grams.langs[grams.text_of[first]]
                    found[key, mark if by_mark else 0, lang, grams.phrase(first, n)] += 1
            if found:
                keys = list(zip(*found, strict=True))
                names = ("print", "mark", "lang", "phrase")
                types = (pa.int64(), pa.int64(), pa.string(), pa.string())
                arrays = {a: pa.array(k, t) for a, k, t in zip(names, keys, types, strict=True)}
                yield pa.RecordBatch.from_pydict(arrays | {"n": pa.array(list(found.values()), pa.int64())})

    return texts.mapInArrow(rows, "print long, mark long, lang string, phrase string, n long")


def frequent_phrases(
    documents: DataFrame, folder: str, least: int = LEAST, longest: int = LONGEST, mask: int = -1
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to `longest` words with f >= least, and (lang, n) with the number of words.

    `mask` is what is kept of a fingerprint; fewer bits let more phrases share one, which changes no result.
    """
    spark = documents.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = documents.select(lang, "text")

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    words = kept(_frequent(texts, (1,), None, least, mask), "words")
    pairs = kept(_frequent(texts, (2,), bit_table(words.select("print")), least, mask), "pairs")
    sizes = tuple(range(3, longest + 1))
    longer = kept(_frequent(texts, sizes, bit_table(pairs.select("print")), least, mask), "longer")
    prints = words.unionByName(pairs).unionByName(longer)
    if mask != -1:  # phrases of different sizes may share a short fingerprint
        prints = prints.groupBy("print").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))

    ends = prints.select("print", F.col("n").alias("total"), F.explode(F.array_distinct(F.array("least", "most"))).alias("mark"))
    key = F.col("print").bitwiseXOR(F.col("mark")).bitwiseXOR(F.shiftleft("mark", 32))
    pointed = spark.sparkContext.broadcast(bit_table(ends.select(key.alias("key"))))

    def is_pointed(prints: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return pointed.value.has(_pointed(prints, marks))

    found = kept(_occurrences(texts, range(1, longest + 1), is_pointed, mask, by_mark=True), "found")
    totals = found.where("phrase is null").groupBy("lang").agg(F.sum("n").alias("n"))
    shown = found.where("phrase is not null").join(ends, ["print", "mark"])
    text = F.struct("lang", "phrase")
    named = kept(
        shown.groupBy("print", "total").agg(F.min(text).alias("text"), (F.min(text) != F.max(text)).alias("shared")), "named"
    )
    phrases = named.where("not shared").select("text.lang", "text.phrase", F.col("total").alias("f"))
    shared = named.where("shared").select("print")
    if not shared.isEmpty():
        bits = spark.sparkContext.broadcast(bit_table(shared))
        told = _occurrences(texts, range(1, longest + 1), lambda prints, _: bits.value.has(prints), mask, by_mark=False)
        recount = told.join(shared, "print", "left_semi").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        phrases = phrases.unionByName(kept(recount.where(F.col("f") >= least), "recounted"))
    return kept(phrases, "phrases"), totals


def _part(words: str, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(documents: DataFrame, folder: str, top: int = TOP, least: int = LEAST, mask: int = -1) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    `a` is how often the phrase occurs, `l` and `r` its two parts at the cut with the lowest score, the first such cut;
    the score is floor(2000000 * a / (l + r)). Best by score, then a, then the phrase's bytes.
    """
    phrases, totals = frequent_phrases(documents, folder, least, mask=mask)
    words = F.split("phrase", " ")
    long = phrases.select("lang", "phrase", F.col("f").alias("a"), words.alias("words")).where(F.size("words") > 1)

    size, cut = F.size("words"), F.col("cut")
    cuts = long.withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "cut", _part("words", F.lit(1), cut).alias("_left"),
        _part("words", cut + 1, size - cut).alias("_right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    score = F.expr(f"cast({SCALE} * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + r) as long)")
    scored = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))

    spot = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), k -> transform(sequence(1, size(words) - k + 1),"
        " i -> array_join(slice(words, i, k), ' '))))"
    )
    held = long.where(F.size("words") > 2).select("lang", F.explode(spot).alias("phrase"), F.col("a").alias("_longer"))
    held = held.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    kept = lowest.join(held, ["lang", "phrase"], "left").where(
        F.expr(f"_longer is null or 100 * cast(_longer as decimal(20, 0)) < {COVERED} * cast(a as decimal(20, 0))")
    )
    best = Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "low.l", "low.r", "n", "low.score")
