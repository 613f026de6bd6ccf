"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits; in scripts without spaces each character is one. Every run of SEED words of a benchmark item is a seed; all texts are
passed once with a running Karp-Rabin hash, and what a bit table of all seeds lets through is joined with the
seeds on the hash. Each side brings a seed once with all its places, so a document and an item meet in as much data as they
have seeds, however often a word repeats. They are then tiled: the longest match whose words are all free is marked
again and again until none of SEED words is left, the first in the item and then in the document among equals. So a passage is
found whatever the order of its parts, and no word counts twice. An item leaks into a document if tiles cover `share` of its
words.

The bit table is sized from the number of seeds, up to 32 MiB: of windows that are no seed it lets one in 256 through, up to
a million seeds. A larger benchmark only lets more through to the join. Hashes are 64 bits of whole word runs.

Null and empty texts match nothing. An item with fewer than SEED words is one seed as a whole; its first place in a text
counts. Rows that repeat a document count once. Every text of a document id and of an item id is searched, and the pair that
is covered best, the longest among equals, gives the row of both ids; a null id is one such id. Empty tables give no rows.
Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.llm.words import Packed, mixed, powers, slices

SEED = 5
SHARE = 0.5
#: Size of the bit table: bits a seed, and the least and the most leading bits of a hash (2 MiB and 32 MiB).
BITS_A_SEED, LEAST_BITS, MOST_BITS = 256, 24, 28
#: Characters of scripts without spaces between words; in UTF-8 all of them begin with a byte from 0xE0 on.
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"


def packed(texts: pa.Array) -> Packed:
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    texts = pc.replace_substring_regex(texts, r"[^\pL\pN]+", " ")
    data = texts.buffers()[2]
    if data is not None and np.frombuffer(data, np.uint8).max(initial=0) >= 0xE0:
        texts = pc.replace_substring_regex(texts, UNSPACED, r" \1 ")
    return Packed(texts)


def seeds(p: Packed, words: np.ndarray, k: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of every run of k words."""
    hashes, first = p.windows(words, k)
    owner = p.text_of[first]
    return (hashes + np.uint64(k)).view(np.int64), owner, first - p.first[:-1][owner]


def _bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes.view(np.uint64) >> np.uint64(64 - bits)


def table_bits(n_seeds: int) -> int:
    """Leading bits of a hash that number the table: at least BITS_A_SEED bits a seed, up to MOST_BITS."""
    return min(MOST_BITS, max(LEAST_BITS, (n_seeds * BITS_A_SEED - 1).bit_length()))


def benchmark_seeds(benchmark: DataFrame, k: int = SEED) -> DataFrame:
    """item_id, item_key (of its text), n_words, at, hash."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = packed(batch["text"])
            words, counts = p.words(), p.counts
            found = [seeds(p, words, k)]
            for n in range(1, k):
                whole = seeds(p, words, n)
                short = counts[whole[1]] == n
                found.append(tuple(x[short] for x in whole))
            hashes, owner, pos = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_pydict(
                {
                    "item_id": batch["item_id"].take(pa.array(owner)),
                    "item_key": batch["item_key"].take(pa.array(owner)),
                    "n_words": pa.array(counts[owner], pa.int32()),
                    "at": pa.array(pos, pa.int32()),
                    "hash": hashes,
                }
            )

    schema = "item_id long, item_key long, n_words int, at int, hash long"
    texts = benchmark.where("text is not null").select("item_id", "text").distinct()
    return texts.select("item_id", F.xxhash64("text").alias("item_key"), "text").mapInArrow(rows, schema)


def seed_table(benchmark_rows: DataFrame, bits: int) -> np.ndarray:
    """A bit per possible value of the leading hash bits, in 64-bit words."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.unique(_bits(batch["hash"].to_numpy(zero_copy_only=False), bits))
            places, first = np.unique(numbers >> np.uint64(6), return_index=True)
            words = np.uint64(1) << (numbers & np.uint64(63))
            words = np.bitwise_or.reduceat(words, first) if len(first) else words
            yield pa.RecordBatch.from_pydict({"place": places.astype(np.int64), "word": words.view(np.int64)})

    merged = benchmark_rows.select("hash").mapInArrow(fold, "place long, word long").groupBy("place").agg(
        F.bit_or("word").alias("word")
    )
    table = np.zeros((1 << bits) // 64, np.uint64)
    found = merged.toArrow()  # at most a row per word of the table
    table[found["place"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return table


def _runs(at: np.ndarray) -> np.ndarray:
    """How many seeds follow one another from each one on, itself included; `at` ascends."""
    last = np.flatnonzero(np.append(np.diff(at) != 1, True))
    return last[np.searchsorted(last, np.arange(len(at)))] - np.arange(len(at)) + 1


def _sums(seeds_: np.ndarray) -> np.ndarray:
    up, _ = powers(len(seeds_) + 1)
    found = np.zeros(len(seeds_) + 1, np.uint64)
    np.cumsum(mixed(seeds_.view(np.uint64)) * up[: len(seeds_)], dtype=np.uint64, out=found[1:])
    return found


def _free(at: np.ndarray, taken: list[int], width: int, k: int) -> np.ndarray:
    """Which seeds share no word with tiles of `width` words that begin at `taken`."""
    begins = np.append(-1 - width, np.sort(np.array(taken, np.int64)))
    return begins[np.searchsorted(begins, at + k) - 1] + width <= at


def tile(pos: np.ndarray, pos_seed: np.ndarray, at: np.ndarray, at_seed: np.ndarray, k: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (first word in the document, first word in the item, words) from the seeds of both sides by ascending place.

    Running Karp-Rabin: a window of words is a run of seeds, hashed by prefix polynomials over them. Common windows of
    some width have common parts of any smaller one, so the longest width is found by halving. Of that width, the item's
    windows in their order take the first free window of the document each. Then seeds with a word in a tile go, and the
    longest width of the rest is looked for. Nothing is kept by pairs of places, so a repeated word costs its places once
    a width; the tiles of different widths fit into the item, so there are few widths.
    """
    tiles: list[tuple[int, int, int]] = []
    while len(pos) and len(at):
        sides = [(_runs(x), _sums(h)) for x, h in ((pos, pos_seed), (at, at_seed))]

        def common(n: int, sides=sides) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            """Windows of n seeds that are on both sides: where they begin there, and their hashes."""
            found = []
            for run, total in sides:
                begin = np.flatnonzero(run >= n)
                _, down = powers(len(total))
                found.append((begin, mixed((total[begin + n] - total[begin]) * down[begin])))
            (i, left), (j, right) = found
            own, other = np.isin(left, right), np.isin(right, left)
            return i[own], left[own], j[other], right[other]

        low, high = 0, int(min(run.max() for run, _ in sides))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)[0]) else (low, middle - 1)
        if not low:
            break
        i, left, j, right = common(low)
        width = low + k - 1
        order = np.argsort(left, kind="stable")
        left, places = left[order], pos[i[order]]
        next_at, until = np.searchsorted(left, right), np.searchsorted(left, right, "right")
        reached: dict[int, int] = {}
        used: set[int] = set()
        begins: list[int] = []
        owns: list[int] = []
        for a, first, end in zip(at[j].tolist(), next_at.tolist(), until.tolist(), strict=True):
            if owns and a < owns[-1] + width:
                continue
            here = reached.get(first, first)
            # Tiles of this round are equally wide, so one that overlaps a window holds its first or its last word.
            while here < end and (int(places[here]) in used or int(places[here]) + width - 1 in used):
                here += 1
            reached[first] = here
            if here < end:
                p = int(places[here])
                used.update(range(p, p + width))
                begins.append(p)
                owns.append(a)
        tiles += [(p, a, width) for p, a in zip(begins, owns, strict=True)]
        rest = _free(pos, begins, width, k)
        pos, pos_seed = pos[rest], pos_seed[rest]
        rest = _free(at, owns, width, k)
        at, at_seed = at[rest], at_seed[rest]
    return tiles


def _side(seeds_: list, place: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of all seeds, ascending, and the seed at each."""
    sizes = [len(s[place]) for s in seeds_]
    at = np.concatenate([np.asarray(s[place], np.int64) for s in seeds_])
    order = np.argsort(at)
    return at[order], np.repeat(np.array([s["hash"] for s in seeds_], np.int64), sizes)[order]


TILED = (
    "doc_id long, doc_key long, item_id long, item_key long, n_words int, covered int, "
    "tiles array<struct<doc_word:int,item_word:int,words:int>>"
)


def leaks(documents: DataFrame, benchmark: DataFrame, share: float = SHARE, k: int = SEED) -> DataFrame:
    """doc_id, item_id, n_words (of the item), covered (words in tiles) and the tiles, where covered >= share * n_words."""
    spark: SparkSession = documents.sparkSession
    items = benchmark_seeds(benchmark, k)
    short_words = F.collect_set(F.when(F.col("n_words") < k, F.col("n_words"))).alias("short")
    size = items.agg(F.count("*").alias("n"), short_words).first()
    short, bits = sorted(size["short"]), table_bits(size["n"])
    table = spark.sparkContext.broadcast(seed_table(items, bits))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        for batch in slices(batches):
            p = packed(batch["text"])
            words = p.words()
            found = []
            for n in (k, *short):
                hashes, owner, pos = seeds(p, words, n)
                number = _bits(hashes, bits)
                hit = np.flatnonzero(known[number >> np.uint64(6)] >> (number & np.uint64(63)) & np.uint64(1))
                order = hit[np.lexsort((pos[hit], hashes[hit], owner[hit]))]
                hashes, owner, pos = hashes[order], owner[order], pos[order]
                begin = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(hashes) != 0))[: len(pos)])
                if n < k:  # one place is all of such an item
                    pos, width = pos[begin], np.ones(len(begin), np.int64)
                else:
                    width = np.diff(np.append(begin, len(pos)))
                found.append((hashes[begin], owner[begin], width, pos))
            hashes, owner, width, pos = (np.concatenate(x) for x in zip(*found, strict=True))
            offsets = pa.array(np.append(0, np.cumsum(width)), pa.int32())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"].take(pa.array(owner)),
                    "doc_key": batch["doc_key"].take(pa.array(owner)),
                    "hash": hashes,
                    "pos": pa.ListArray.from_arrays(offsets, pa.array(pos, pa.int32())),
                }
            )

    texts = documents.select("doc_id", F.xxhash64("text").alias("doc_key"), "text")
    hits = texts.mapInArrow(scan, "doc_id long, doc_key long, hash long, pos array<int>").distinct()
    places = items.groupBy("item_id", "item_key", "n_words", "hash").agg(F.collect_list("at").alias("at"))
    matches = hits.join(places, "hash")
    # A seed covers k words at most, so a pair with too few places in the item cannot reach the share.
    enough = F.sum(F.size("at")) * k >= F.col("n_words") * share
    pairs = matches.groupBy("doc_id", "doc_key", "item_id", "item_key", "n_words").agg(
        enough.alias("enough"), F.collect_list(F.struct("hash", "pos", "at")).alias("seeds")
    )

    def tiled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [
                tile(*_side(row.seeds, "pos"), *_side(row.seeds, "at"), min(k, row.n_words))
                for row in frame.itertuples(index=False)
            ]
            frame["covered"] = np.array([sum(n for _, _, n in tiles) for tiles in found], np.int32)
            frame["tiles"] = [[{"doc_word": p, "item_word": a, "words": n} for p, a, n in tiles] for tiles in found]
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            frame["item_id"] = frame["item_id"].astype("Int64")
            yield frame[["doc_id", "doc_key", "item_id", "item_key", "n_words", "covered", "tiles"]]

    found = pairs.where("enough").drop("enough").mapInPandas(tiled, TILED).where(F.col("covered") >= F.col("n_words") * share)
    best = F.struct(F.col("covered") / F.col("n_words"), "n_words", "item_key", "doc_key")
    folded = found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_words", "covered", "tiles"), best).alias("t"))
    return folded.select("doc_id", "item_id", "t.*")
