"""Token ids in files: frequency-ranked, byte-aligned, with control bytes apart from data bytes.

Texts are encoded where they lie. The ids of all documents are counted, in each task first, and ranked once for the whole
corpus, most frequent first and the smaller first among equals; the table of ranks, at most as long as the vocabulary, is
written beside the files. Then the encoded documents, not the texts, are ordered by id. A file row is a block of documents in
ascending order, whose ids are replaced by their ranks, so that most take one byte and codes mean the same in all blocks.
Four values share a control byte, two bits each for a length of one to four bytes; the data bytes follow one another, low byte
first. Reading looks the four lengths of a control byte up in a table and needs no step per value.

Blocks lie in Parquet files, whose rows Spark writes and commits wherever the folder is, one file per range of ids. Each
block knows its range and how many ids come before it there, so reading needs only one total per range.

Null and empty texts have the end id alone. Null ids come first. Rows with equal ids follow one another by a hash of the text
and, where that is equal too, by the place at which they were read, so ranges may end between them and an id that many rows
have is spread over tasks. An empty table gives files without blocks and an empty table of ranks. Further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innledger.llm.bpe import piece_cache
from innledger.llm.words import slices
from innledger.session import new_folder, remove_folder

END_ID = 0
#: Bytes of text that are encoded at a time: pieces that a run has often are looked up once.
RUN_BYTES = 1 << 21
BLOCK = (
    "part int, before long, n_ids long, doc_id array<long>, n_tokens array<int>, "
    "control binary, data binary"
)
ENCODED = "doc_id long, text_key long, task int, place long, ids binary"
ORDER = ["doc_id", "text_key", "task", "place"]
RANKS = "rank int, id long"
ROWS = "part int, before long, doc_id long, n_tokens long, ids_crc32 long"
#: Of every control byte: the lengths of its four values.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    lens = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    ends = np.cumsum(lens)
    begins = ends - lens
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for byte in range(4):
        has = np.flatnonzero(lens > byte) if byte else slice(None)
        if byte and not len(has):
            break
        data[begins[has] + byte] = (values[has] >> np.uint32(8 * byte)) & np.uint32(0xFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lens - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | (codes[:, 1] << 2) | (codes[:, 2] << 4) | (codes[:, 3] << 6)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values."""
    lens = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    source = np.frombuffer(data, np.uint8)
    begins = np.cumsum(lens) - lens
    values = source[begins].astype(np.uint32)
    for byte in range(1, 4):
        has = np.flatnonzero(lens > byte)
        if not len(has):
            break
        values[has] |= source[begins[has] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


def with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids with the end id after each document."""
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = ids
    return out


def flat(column: pa.Array, width: int) -> np.ndarray:
    """The ids of all rows one after another, of `width` bytes each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    begin, end = np.frombuffer(offsets, np.int64)[[column.offset, column.offset + len(column)]].tolist()
    return np.frombuffer(data, f"<u{width}", (end - begin) // width, begin) if end > begin else np.zeros(0, f"<u{width}")


def encode_documents(documents: DataFrame, path: str, width: int, end_id: int) -> DataFrame:
    """Each document's ids, the end id last, in `width` bytes each, with what orders the documents."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        cache = piece_cache(path)
        place = 0
        for batch in slices(batches, size=RUN_BYTES):
            n = batch.num_rows
            ids, counts = cache.encode(batch["text"])
            ids = with_ends(ids, counts, end_id).astype(f"<u{width}")
            offsets = np.concatenate(([0], np.cumsum((counts + 1) * width))).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "text_key": batch["text_key"],
                    "task": pa.array(np.full(n, task), pa.int32()),
                    "place": np.arange(place, place + n),
                    "ids": pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                }
            )
            place += n

    return documents.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(encode, ENCODED)


def rank_ids(encoded: DataFrame, width: int) -> DataFrame:
    """rank, id of every id used."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(flat(batch["ids"], width), minlength=len(uses))
            found[: len(uses)] += uses
            uses = found
        some = np.flatnonzero(uses)
        yield pa.RecordBatch.from_pydict({"id": some, "n": uses[some]})

    uses = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # At most one row per id of the vocabulary, so a single task may order them.
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1
    return uses.select(rank.alias("rank"), "id")


def id_table(spark: SparkSession, folder: str) -> np.ndarray:
    """The id of every rank; at most as many as the vocabulary has."""
    rows = spark.read.schema(RANKS).parquet(f"{folder}/ranks").toPandas()
    table = np.zeros(len(rows), np.uint32)
    table[rows["rank"].to_numpy()] = rows["id"].to_numpy()
    return table


def write_tokens(documents: DataFrame, path: str, folder: str, end_id: int = END_ID) -> None:
    """Encodes every text with the tokenizer at `path` and writes the ranks and the blocks to the folder."""
    spark = documents.sparkSession
    # Ids below 2**16 take two bytes until they are ranked.
    width = 2 if max(len(piece_cache(path).bytes_of), end_id + 1) <= 1 << 16 else 4
    held = new_folder(spark, "encoded")
    encode_documents(documents, path, width, end_id).write.parquet(held)
    encoded = spark.read.schema(ENCODED).parquet(held)
    rank_ids(encoded, width).write.parquet(f"{folder}/ranks")
    by_rank = id_table(spark, folder)
    ranks = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before = 0
        for batch in slices(batches, "ids"):
            ids = flat(batch["ids"], width)
            counts = pc.binary_length(batch["ids"]).to_numpy() // width
            control, data = pack(ranks[ids])
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "before": [before],
                    "n_ids": [len(ids)],
                    "doc_id": pa.array([batch["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    "n_tokens": pa.array([counts.tolist()], pa.list_(pa.int32())),
                    "control": pa.array([control], pa.binary()),
                    "data": pa.array([data], pa.binary()),
                }
            )
            before += len(ids)

    rows = encoded.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("doc_id", "ids")
    rows.mapInArrow(block, BLOCK).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    remove_folder(spark, held)


def decoded(blocks: Iterator[pa.RecordBatch], by_rank: np.ndarray) -> Iterator[tuple[dict, np.ndarray]]:
    """Each block with its ids."""
    for batch in blocks:
        for i in range(batch.num_rows):
            block = {name: batch[name][i].as_py() for name in batch.schema.names}
            yield block, by_rank[unpack(block["control"], block["data"], block["n_ids"])]


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens with the end id, ids_crc32."""
    by_rank = id_table(spark, folder)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids in decoded(batches, by_rank):
            counts = np.array(block["n_tokens"], np.int64)
            ends = np.cumsum(counts)
            raw = ids.astype("<u4", copy=False)
            sums = [zlib.crc32(raw[e - n : e].data) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(counts), block["part"]), pa.int32()),
                    "before": block["before"] + ends - counts,
                    "doc_id": pa.array(block["doc_id"], pa.int64()),
                    "n_tokens": counts,
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )

    blocks = spark.read.schema(BLOCK).parquet(f"{folder}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per range of ids, so a single task may add them up.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    found = blocks.mapInArrow(rows, ROWS).join(offsets, "part")
    return found.select("doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and its ids, the end id last."""
    by_rank = id_table(spark, folder)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids in decoded(batches, by_rank):
            counts = np.array(block["n_tokens"], np.int64)
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(block["doc_id"], pa.int64()), "ids": lists})

    return spark.read.schema(BLOCK).parquet(f"{folder}/blocks").mapInArrow(rows, "doc_id long, ids array<long>")
