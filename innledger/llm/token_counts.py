"""Token counts by a two-tier lookup on the map side.

A pre-token here is a piece between two cuts that are sure (see `bpe`). The lengths of frequent pieces, found on a
bounded number of documents, are broadcast as one small hash table; every other piece goes through the worker's own
cache and is encoded there once. Pieces are never shuffled. Which tier knows a piece changes the time, never a count.

Null and empty texts have no tokens. Repeated rows give repeated rows, an empty table none; a null id stays null, and
further columns are not read. A text of any length is counted whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.llm.bpe import cut, piece_cache, sums
from innledger.llm.words import slices

#: About how many documents the table of frequent pieces is made from; pieces a task may name; pieces in the table.
TABLE_DOCS, TASK_PIECES, TABLE_PIECES = 1000, 1000, 16_384
LIMIT = 512
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def frequent_lengths(documents: DataFrame, path: str) -> dict[str, int]:
    """Tokens of the most frequent pieces that have a space before them.

    At most TABLE_DOCS x TASK_PIECES short rows reach the driver, however large the input is.
    """
    total = documents.select(F.count("*")).first()[0]
    every = max(1, total // TABLE_DOCS)
    some = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text")

    specials = list(piece_cache(path).specials)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: Counter[str] = Counter()
        for batch in slices(batches):
            for text in batch["text"].to_pylist():
                # A special string is cut out before pieces are; such texts tell nothing about pieces.
                if text and not any(s in text for s in specials):
                    uses.update(cut(text)[1:])
        top = uses.most_common(TASK_PIECES)
        if top:
            pieces, n = map(list, zip(*top, strict=True))
            yield pa.RecordBatch.from_pydict({"piece": pieces, "uses": pa.array(n, pa.int64())})

    uses: Counter[str] = Counter()
    for row in some.mapInArrow(tops, "piece string, uses long").toLocalIterator():
        uses[row.piece] += row.uses
    pieces = [p for p, _ in sorted(uses.items(), key=lambda x: (-x[1], x[0]))[:TABLE_PIECES]]
    cache = piece_cache(path)
    at = [cache.rest[p] for p in pieces]
    cache.learn()
    return dict(zip(pieces, cache.pieces.lens[at].tolist(), strict=True))


def token_counts(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, and whether that is over the limit, a row for each row.

    Tokens as the tokenizers library gives them for the file at `path`, without added special tokens.
    """
    documents = documents.select("doc_id", "text")
    table = documents.sparkSession.sparkContext.broadcast(frequent_lengths(documents, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = table.value.get
        cache = piece_cache(path)
        for batch in slices(batches):
            texts = batch["text"].to_pylist()
            known = np.zeros(len(texts), np.int64)
            others = np.zeros(len(texts), np.int64)
            found: list[int] = []
            cache.make_room()
            for i, text in enumerate(texts):
                if not text:
                    continue
                before = len(found)
                if any(s in text for s in cache.specials):
                    found += cache.text(text)
                else:
                    pieces = cut(text)
                    found.append(cache.first[pieces[0]])
                    del pieces[0]
                    lengths = list(map(frequent, pieces))
                    known[i] = sum(filter(None, lengths))
                    found += [cache.rest[p] for p, n in zip(pieces, lengths, strict=True) if n is None]
                others[i] = len(found) - before
            cache.learn()
            tokens = known + sums(cache.pieces.lens[np.array(found, np.int64)], others)
            sizes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_bytes": pa.array(sizes, pa.int64()),
                    "n_tokens": tokens,
                    "over_limit": pa.array(tokens > limit),
                }
            )

    return documents.mapInArrow(count, SCHEMA)
