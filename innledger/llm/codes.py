"""Short codes of vectors by one codebook per part, refined in rounds under adaptive bounds.

A vector's components become integers and its parts are coded by the nearest entry of the part's codebook. Each round
assigns all parts and moves the entries to the means of their parts. Between rounds a part keeps, in the table that the round
writes, its entry with an upper bound of the distance to it, its next closest entries with a lower bound each, in
ascending order, and one outer bound that holds for all other entries. When entries move, the bounds give way by the distance moved.
A part whose upper bound stays below all lower bounds keeps its entry unseen. Otherwise exact distances in integers are taken to
as many of the kept entries as the upper bound reaches, or to all where it reaches the outer bound, so no result
rests on a bound alone. How many entries the next round keeps is set for each part position by how far the last round had to look.

Bounds are whole numbers: lower bounds are rounded down and upper bounds up, so they hold in spite of rounding. Only the codebooks, a
fixed number of entries, are sent to the tasks; each task adds up its own parts for each entry. Every round
is a written table; a lost executor repeats its own tasks, and the table before is removed.

Rows without a vector, or with a component that is null, infinite or no number, are left out. A vector shorter than the longest
counts as filled up with zeros, also to a multiple of the number of parts. Rows without an id come last when the first
entries are chosen, rows with equal ids in order of their vectors; repeated rows are coded alike. With fewer rows than entries
each row is one. Null labels are one label. An empty table has no codes. Components so large that squared distances pass 2**53
are refused (8192 for parts of 16 components). Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.session import new_folder, remove_folder

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries a part keeps bounds for: at first, at least and at most. The share of doubtful parts the kept ones are to settle.
FIRST_KEPT, LEAST_KEPT, MOST_KEPT, SETTLED = 16, 2, 32, 0.95
#: Rows worked on at a time.
RUN_ROWS = 2048
_FAR = np.int32(2**31 - 1)
_ROW = "x binary, near binary, bounds binary, what string, part int, entry int, n long, total array<long>"


@dataclass
class Books:
    """The codebooks, (part, entry, component), and how far each entry has just moved, rounded up."""

    entries: np.ndarray
    moved: np.ndarray
    kept: list[int]

    def __post_init__(self):
        self.floats = self.entries.astype(np.float64)
        self.squares = (self.floats**2).sum(2)


def _floor_root(squares: np.ndarray) -> np.ndarray:
    roots = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    roots -= roots * roots > squares
    return roots + ((roots + 1) * (roots + 1) <= squares)


def _ceil_root(squares: np.ndarray) -> np.ndarray:
    roots = _floor_root(squares)
    return roots + (roots * roots < squares)


def _all_distances(x: np.ndarray, books: Books, part: int) -> np.ndarray:
    """Squared distances to all entries. They stay below 2**53 (see `code_vectors`), so floating point is exact."""
    x = x.astype(np.float64)
    return ((x * x).sum(1)[:, None] + books.squares[part] - 2 * (x @ books.floats[part].T)).astype(np.int64)


def _distances(x: np.ndarray, books: Books, part: int, entry: np.ndarray) -> np.ndarray:
    return ((x - books.entries[part][entry]) ** 2).sum(1)


def search(x: np.ndarray, books: Books, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of each part from the nearest on, one more than are kept, and bounds: upper, lower ones, outer."""
    kept = books.kept[part]
    n = books.entries.shape[1]
    ranked = _all_distances(x, books, part) * n + np.arange(n)  # equal distances by index
    most = min(kept + 2, n)
    ranked = np.sort(np.partition(ranked, most - 1, 1)[:, :most] if most < n else ranked, 1)
    entries = np.zeros((len(x), kept + 1), np.int64)
    bounds = np.full((len(x), kept + 2), _FAR, np.int64)
    entries[:, :most] = (ranked % n)[:, : kept + 1]
    bounds[:, :most] = _floor_root(ranked // n)
    bounds[:, 0] = _ceil_root(ranked[:, 0] // n)
    return entries, bounds


def refine(
    x: np.ndarray, books: Books, part: int, entries: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries and bounds after the codebook has moved, and how many kept entries each doubtful part had to look at.

    A part that had to look at all entries counts as one more than are kept.
    """
    n = books.entries.shape[1]
    moved = books.moved[part]
    before = bounds.shape[1] - 2
    kept = books.kept[part]
    bounds = bounds.copy()
    bounds[:, 0] += moved[entries[:, 0]]
    bounds[:, 1:-1] -= moved[entries[:, 1:]] * (bounds[:, 1:-1] < _FAR)
    bounds[:, -1] -= moved.max(initial=0) * (bounds[:, -1] < _FAR)
    # A lower bound speaks for itself and all that follow.
    bounds[:, 1:] = np.minimum.accumulate(bounds[:, :0:-1], 1)[:, ::-1]
    doubtful = np.flatnonzero(bounds[:, 0] >= bounds[:, 1])
    exact = _distances(x[doubtful], books, part, entries[doubtful, 0])
    bounds[doubtful, 0] = _ceil_root(exact)
    still = bounds[doubtful, 0] >= bounds[doubtful, 1]
    doubtful, exact = doubtful[still], exact[still]
    looked = (bounds[doubtful, 0][:, None] >= bounds[doubtful, 1:]).sum(1)
    if len(doubtful):
        far = looked > before
        rows = doubtful[~far]
        if len(rows):
            ranked = np.full((len(rows), before + 1), np.iinfo(np.int64).max)
            ranked[:, 0] = exact[~far] * n + entries[rows, 0]
            for place in range(1, int(looked[~far].max(initial=0)) + 1):
                near = np.flatnonzero(looked[~far] >= place)
                entry = entries[rows[near], place]
                ranked[near, place] = _distances(x[rows[near]], books, part, entry) * n + entry
            order = np.argsort(ranked, 1, kind="stable")
            ranked = np.take_along_axis(ranked, order, 1)
            seen = ranked < np.iinfo(np.int64).max
            entries[rows] = np.take_along_axis(entries[rows], order, 1)
            squares = np.where(seen, ranked // n, 0)
            bounds[rows, :-1] = np.where(seen, _floor_root(squares), bounds[rows, :-1])
            bounds[rows, 0] = _ceil_root(squares[:, 0])
        rows = doubtful[far]
    if kept < before:  # what is no longer kept counts as outer
        bounds = np.concatenate((bounds[:, : kept + 1], bounds[:, kept + 1 :].min(1)[:, None]), 1)
        entries = entries[:, : kept + 1]
    elif kept > before:
        gap = np.repeat(bounds[:, -1:], kept - before, 1)
        bounds = np.concatenate((bounds[:, :-1], gap, bounds[:, -1:]), 1)
        entries = np.concatenate((entries, np.repeat(entries[:, -1:], kept - before, 1)), 1)
        # Places without an entry repeat the last one; what they are a bound for is all the rest.
    if len(doubtful) and len(rows):
        entries[rows], bounds[rows] = search(x[rows], books, part)
    return entries, bounds, looked


def _integers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * component), filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).astype(np.int64)
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """Binary values of one size as the rows of a matrix."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(dtype).reshape(len(column), -1)


def _binary(matrix: np.ndarray, dtype: str) -> pa.Array:
    data = np.ascontiguousarray(matrix, dtype)
    ends = np.arange(len(data) + 1, dtype=np.int32) * data[:1].nbytes
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _widths(kept: list[int], extra: int) -> list[int]:
    return np.cumsum([k + extra for k in kept])[:-1].tolist()


class _Sums:
    """What a task adds up: members and components of every entry, and how far doubtful parts had to look."""

    def __init__(self, books: Books):
        parts, entries, size = books.entries.shape
        self.n = np.zeros((parts, entries), np.int64)
        self.total = np.zeros((parts, entries, size), np.int64)
        self.depth = np.zeros((parts, MOST_KEPT + 2), np.int64)

    def add(self, part: int, x: np.ndarray, entry: np.ndarray, looked: np.ndarray) -> None:
        size = self.n.shape[1]
        self.n[part] += np.bincount(entry, minlength=size)
        for component in range(x.shape[1]):
            sums = np.bincount(entry, x[:, component], size)  # whole numbers below 2**53
            self.total[part, :, component] += sums.astype(np.int64)
        self.depth[part] += np.bincount(looked, minlength=MOST_KEPT + 2)

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        used, depths = np.argwhere(self.n), np.argwhere(self.depth)
        columns = {
            "what": ["sum"] * len(used) + ["depth"] * len(depths),
            "part": np.concatenate((used[:, 0], depths[:, 0])),
            "entry": np.concatenate((used[:, 1], depths[:, 1])),
            "n": np.concatenate((self.n[self.n > 0], self.depth[self.depth > 0])),
            "total": [*self.total[self.n > 0].tolist(), *([None] * len(depths))],
        }
        n = len(used) + len(depths)
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _usable(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").where(
        F.col("embedding").isNotNull() & finite
    )


def _next_books(table: DataFrame, books: Books) -> Books:
    """The entries moved to the means of their parts; at most one row an entry and depth reaches the driver."""
    size = books.entries.shape[2]
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(size)]
    rows = table.where("what <> 'row'").groupBy("what", "part", "entry").agg(F.sum("n").alias("n"), *sums).collect()
    entries = books.entries.copy()
    depth = np.zeros((len(entries), MOST_KEPT + 2), np.int64)
    for row in rows:
        if row.what == "sum":
            entries[row.part, row.entry] = [row[f"s{i}"] // row.n for i in range(size)]
        else:
            depth[row.part, row.entry] = row.n
    kept = [_adapted(now, counts) for now, counts in zip(books.kept, depth, strict=True)]
    return Books(entries, _ceil_root(((entries - books.entries) ** 2).sum(2)), kept)


def _adapted(kept: int, depth: np.ndarray) -> int:
    """How many entries to keep: as many as would have settled most doubtful parts; twice as many if too few were kept."""
    if not depth.sum():
        return kept
    settled = np.cumsum(depth) >= SETTLED * depth.sum()
    wanted = int(np.argmax(settled))
    return min(max(2 * kept if wanted > kept else wanted, LEAST_KEPT), MOST_KEPT)


@dataclass
class Coded:
    """vec_id, label, code and error of each row, and the final codebooks."""

    rows: DataFrame
    books: Books

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.entries.ravel().tolist())).encode()).hexdigest()


def code_vectors(
    vectors: DataFrame, folder: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Coded:
    """Trains the codebooks in some rounds and codes every usable row of vec_id, embedding, label; tables go to the folder."""
    spark = vectors.sparkSession
    usable = _usable(vectors)
    # An empty vector has no greatest component.
    great = F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x).cast("double"))))
    longest, greatest = usable.agg(F.max(F.size("embedding")), great).first()
    size = max(-(-(longest or 0) // parts), 1)
    if SCALE * (greatest or 0) + 1 > np.sqrt(2**53 / (4 * size)):
        raise ValueError(f"components of {greatest} are too large for exact squared distances")
    seeds = usable.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    first = _integers(pa.array([s.embedding for s in seeds], pa.list_(pa.float64())), parts * size)
    start = first.reshape(-1, parts, size).transpose(1, 0, 2)
    books = Books(np.ascontiguousarray(start), np.zeros(start.shape[:2], np.int64), [FIRST_KEPT] * parts)
    label = usable.schema["label"].dataType.simpleString()
    layout = f"vec_id long, label {label}, {_ROW}"
    byte = "<u1" if entries <= 256 else "<u4"

    def state(batch: pa.RecordBatch, books: Books, kept: list[int] | None, sums: _Sums | None):
        """Integers, entries and bounds of every part of the rows."""
        if kept is None:
            x = _integers(batch["embedding"], parts * size)
        else:
            x = _matrix(batch["x"], "<i4").astype(np.int64)
            near = np.split(_matrix(batch["near"], byte).astype(np.int64), _widths(kept, 1), 1)
            bounds = np.split(_matrix(batch["bounds"], "<i4").astype(np.int64), _widths(kept, 2), 1)
        found = []
        for part in range(parts):
            own = x[:, part * size : (part + 1) * size]
            if kept is None:
                entry, bound = search(own, books, part)
                looked = np.zeros(0, np.int64)
            else:
                entry, bound, looked = refine(own, books, part, near[part], bounds[part])
            if sums:
                sums.add(part, own, entry[:, 0], looked)
            found.append((own, entry, bound))
        return x, found

    def assigned(rows: DataFrame, books: Books, kept: list[int] | None) -> DataFrame:
        sent = spark.sparkContext.broadcast(books)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books, schema = sent.value, None
            sums = _Sums(books)
            for batch in batches:
                schema = schema or _arrow_layout(batch.schema.field("label").type)
                for at in range(0, batch.num_rows, RUN_ROWS):
                    run = batch.slice(at, RUN_ROWS)
                    x, found = state(run, books, kept, sums)
                    columns = {
                        "vec_id": run["vec_id"],
                        "label": run["label"],
                        "x": _binary(x, "<i4"),
                        "near": _binary(np.concatenate([f[1] for f in found], 1), byte),
                        "bounds": _binary(np.concatenate([f[2] for f in found], 1), "<i4"),
                        "what": pa.array(["row"] * len(x)),
                    }
                    arrays = [columns.get(f.name, pa.nulls(len(x), f.type)) for f in schema]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            if schema:
                yield sums.rows(schema)

        return rows.mapInArrow(work, layout)

    def finished(rows: DataFrame, books: Books, kept: list[int] | None) -> DataFrame:
        sent = spark.sparkContext.broadcast(books)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = sent.value
            for batch in batches:
                for at in range(0, batch.num_rows, RUN_ROWS):
                    run = batch.slice(at, RUN_ROWS)
                    _, found = state(run, books, kept, None)
                    error = sum(_distances(x, books, part, f[:, 0]) for part, (x, f, _) in enumerate(found))
                    codes = np.stack([f[:, 0] for _, f, _ in found], 1)
                    width = 2 if entries <= 256 else 8
                    text = ["".join(f"{c:0{width}x}" for c in row) for row in codes.tolist()]
                    yield pa.RecordBatch.from_pydict(
                        {"vec_id": run["vec_id"], "label": run["label"], "code": pa.array(text, pa.string()), "error": error}
                    )

        return rows.mapInArrow(work, f"vec_id long, label {label}, code string, error long")

    rows, kept = usable, None
    for step in range(rounds):
        table = f"{folder}/round{step}"
        assigned(rows, books, kept).write.option("compression", "zstd").parquet(table)
        if step:
            remove_folder(spark, f"{folder}/round{step - 1}")
        stored = spark.read.schema(layout).parquet(table)
        kept, books = books.kept, _next_books(stored, books)
        rows = stored.where("what = 'row'").select("vec_id", "label", "x", "near", "bounds")
    done = finished(rows, books, kept)
    done.write.option("compression", "zstd").parquet(f"{folder}/coded")
    if rounds:
        remove_folder(spark, f"{folder}/round{rounds - 1}")
    return Coded(spark.read.schema(done.schema).parquet(f"{folder}/coded"), books)


def _arrow_layout(label: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("vec_id", pa.int64()),
            ("label", label),
            ("x", pa.binary()),
            ("near", pa.binary()),
            ("bounds", pa.binary()),
            ("what", pa.string()),
            ("part", pa.int32()),
            ("entry", pa.int32()),
            ("n", pa.int64()),
            ("total", pa.list_(pa.int64())),
        ]
    )


def label_errors(coded: Coded, folder: str) -> DataFrame:
    """vec_id, code, error, label_error (sum over the label's rows) and codebooks_sha256.

    The sums are written before the join, so that both its sides are shuffled anew and a label with many rows can be split.
    """
    spark = coded.rows.sparkSession
    sums = coded.rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums.write.parquet(f"{folder}/labels")
    sums = spark.read.schema(sums.schema).parquet(f"{folder}/labels").withColumnRenamed("label", "_label")
    joined = coded.rows.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))


def vector_codes(vectors: DataFrame, folder: str | None = None) -> DataFrame:
    """`label_errors` of `code_vectors` with the settings of this module."""
    folder = folder or new_folder(vectors.sparkSession, "codes")
    return label_errors(code_vectors(vectors, folder), folder)
