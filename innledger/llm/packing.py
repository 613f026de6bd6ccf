"""Best-two-fit packing of documents into token sequences of a fixed size.

A document is its tokens and the end id. One that is longer than a sequence is cut into full pieces, of which the first may
be shorter. Pieces are packed by length alone: a bin takes the longest piece that still fits until none does; then
its smallest piece gives way to two unpacked ones whenever these fill the gap so enlarged more tightly.

Only the number of pieces of each length matters for that, so the plan is made from a histogram with one entry per length:
a bin's pattern is used for as many bins as it would come out again, at which point some length has run short. Therefore
the plan's size depends on the size of a sequence and not on the rows (`Plan`). It places the pieces of a length by rank;
ranks come from the place within the task that encoded a piece and the number of pieces of that length in earlier tasks,
so no length is gathered anywhere, however many pieces have it.

Null and empty texts have the end id alone. Null ids stay null, repeated rows are packed as often as they occur, and an
empty table gives no pieces. Further columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innledger.llm.bpe import piece_cache
from innledger.llm.token_file import with_ends
from innledger.llm.words import slices

SIZE, END_ID = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, place long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_RANK_BITS = 44


def two_fit(lengths: list[int], left: dict[int, int], size: int) -> tuple[Counter, Counter]:
    """The next bin: its lengths, and the most of each length that was taken on the way.

    `lengths` are those with pieces left, ascending; `left` is how many.
    """
    taken: Counter[int] = Counter()
    gap, below = size, len(lengths)
    while below := bisect_right(lengths, gap, 0, below):
        length = lengths[below - 1]
        n = min(gap // length, left[length] - taken[length])
        taken[length] += n
        gap -= n * length
        if taken[length] == left[length]:
            below -= 1
    peak = Counter(taken)
    if not gap or len(lengths) == 1:
        return taken, peak
    smallest = min(taken)
    room = gap + smallest
    best, pair = smallest, None
    low, high = 0, bisect_right(lengths, room) - 1
    while low <= high:
        x, y = lengths[high], lengths[low]
        free = left[x] - taken[x] >= (2 if low == high else 1) and left[y] - taken[y] >= 1
        if x + y > room or left[x] == taken[x]:
            high -= 1
        elif not free:
            low += 1
        else:
            if x + y > best:
                best, pair = x + y, (x, y)
            low += 1
    if pair:
        taken[smallest] -= 1
        taken.update(pair)
        peak = peak | taken
    return +taken, peak


@dataclass
class Plan:
    """Where the pieces of each length go, by rank.

    Run i covers the pieces of `length[i]` from rank `rank[i]` on, `each[i]` to a bin, the first in bin `bin[i]` at
    `offset[i]`. Runs are in order of length and rank. A pattern ends when a length has fewer pieces left than
    one bin takes, so there are at most as many patterns as lengths and left-over pieces of these, which is some eight
    thousand for sequences of 1024.
    """

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of each piece."""
        starts = (self.length << _RANK_BITS) + self.rank
        run = np.searchsorted(starts, (lengths << _RANK_BITS) + ranks, "right") - 1
        within = ranks - self.rank[run]
        each = self.each[run]
        return self.bin[run] + within // each, self.offset[run] + within % each * lengths


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """Packs pieces given by how many have each length."""
    left = {length: n for length, n in histogram.items() if n}
    lengths = sorted(left)
    used: Counter[int] = Counter()
    runs: list[tuple[int, int, int, int, int]] = []
    bins = 0
    while lengths:
        pattern, peak = two_fit(lengths, left, size)
        times = min((left[length] - peak[length]) // n + 1 for length, n in pattern.items())
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            runs.append((length, used[length], n, bins, offset))
            used[length] += n * times
            left[length] -= n * times
            offset += n * length
        bins += times
        lengths = [length for length in lengths if left[length]]
    columns = np.array(sorted(runs), np.int64).reshape(-1, 5).T
    return Plan(*columns, bins)


def cut_pieces(documents: DataFrame, path: str, folder: str, size: int = SIZE, end_id: int = END_ID) -> None:
    """Writes every piece with its ids, the task that encoded it and its place there among those of its length."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        cache = piece_cache(path)
        seen = np.zeros(size + 1, np.int64)
        for batch in slices(batches):
            ids, counts = cache.encode(batch["text"])
            ids = np.ascontiguousarray(with_ends(ids, counts, end_id), "<u4")
            counts = counts + 1
            pieces = -(-counts // size)
            doc = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = counts - (pieces - 1) * size
            length = np.where(piece == 0, first[doc], size)
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * size)
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            new = np.flatnonzero(np.diff(ranked, prepend=-1))
            place = np.empty(len(length), np.int64)
            place[order] = np.arange(len(length)) - np.repeat(new, np.diff(new, append=len(length))) + seen[ranked]
            seen += np.bincount(length, minlength=size + 1)
            ends = np.concatenate(([0], np.cumsum(length))) * 4
            offsets = pa.py_buffer(ends.astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"].take(pa.array(doc)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids": pa.Array.from_buffers(pa.binary(), len(doc), [None, offsets, pa.py_buffer(ids)]),
                    "part": pa.array(np.full(len(doc), part), pa.int32()),
                    "place": place,
                }
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(encode, PIECES).write.option("compression", "zstd").parquet(folder)


def pack(documents: DataFrame, path: str, folder: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id from 0, offset in the sequence.

    The pieces with their ids lie in the folder, see `sequences`.
    """
    spark = documents.sparkSession
    cut_pieces(documents, path, folder, size, end_id)
    pieces = spark.read.schema(PIECES).parquet(folder)
    # One row per task and length.
    counted = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    by_length = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    chosen = spark.sparkContext.broadcast(plan({row.length: row.n for row in by_length}, size))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, offsets = chosen.value.place(batch["length"].to_numpy(), batch["rank"].to_numpy())
            columns = {name: batch[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": bins, "offset": offsets})

    ranked = (
        pieces.withColumn("ids_crc32", F.crc32("ids"))
        .drop("ids")
        .join(starts, ["part", "length"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))
    )
    return ranked.mapInArrow(place, PLACED)


def sequences(spark, folder: str, packed: DataFrame) -> DataFrame:
    """sequence_id and its ids one after another, from the pieces in the folder and where `pack` put them.

    A sequence holds at most its size in tokens, which is what one group gathers.
    """
    pieces = spark.read.schema(PIECES).parquet(folder)
    key = ["doc_id", "piece", "length", "ids_crc32"]

    def numbered(frame: DataFrame, *columns: str) -> DataFrame:
        # Repeated rows have the same ids, so it does not matter which of them goes where.
        copy = F.row_number().over(Window.partitionBy(*key).orderBy(*columns))
        return frame.select(*[F.col(c) for c in (*key, *columns)], copy.alias("copy"))

    held = numbered(pieces.withColumn("ids_crc32", F.crc32("ids")), "part", "place", "ids")
    put = numbered(packed, "sequence_id", "offset")
    same = [held[c].eqNullSafe(put[c]) for c in (*key, "copy")]
    rows = held.join(put, same).select("sequence_id", F.struct(put["offset"], held["ids"]).alias("row"))
    ids = F.aggregate(F.sort_array(F.collect_list("row")), F.lit(b""), lambda all_ids, row: F.concat(all_ids, row["ids"]))
    return rows.groupBy("sequence_id").agg(ids.alias("ids"))
