"""Reproducible sampled segmentations into SentencePiece pieces, and lossless decoding.

The lattice of a text has an arc for every piece of the vocabulary that fits; a piece at place r of the vocabulary's order
weighs (r + 1) ** -power. Forward filtering sums the weights of all ways to each place; backward sampling starts at the end
and draws the last piece in proportion to what its beginning can be reached with, then the piece before it, and so on: each
segmentation comes with probability proportional to the product of its weights.

No piece goes on over a line end or from a visible character to a space, so the lattice falls apart there and each stretch
is drawn by itself. A worker builds the filtered lattice of a stretch once; all stretches of a run of texts are then drawn side
by side, one piece of each at a time. The random number for a draw is a hash of the seed, the document's id, the stretch's
place in the text and the number of the draw, so a segmentation depends on nothing but seed, id and text.

As the model's own encoder does, a space is put before the text. Characters that no piece covers, and U+2581, which the
vocabulary uses for spaces, are spelt in bytes; so decoding gives back every text exactly.

Null and empty texts have the space's piece alone and decode to the empty text. Repeated rows have the same segmentation;
rows that share an id with other texts share its random numbers. A null id counts as a seed of its own. An empty table gives no
rows. Further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from innledger.llm.bpe import Codes, _Places, room, sums
from innledger.llm.words import mixed, powers, slices

POWER, SEED = 1.0, 0
#: Nodes of filtered lattices that a worker keeps, also between tasks: about 100 bytes each with their arcs and text.
CACHE_NODES = 500_000
#: Stretches filtered at a time, so few that their arcs stay in the processor's cache; a factor for each character that keeps
#: weights of long stretches near one; the most characters a piece has.
STRETCHES, SCALE, MOST = 4000, 10.0, 32
#: Bytes of text drawn at a time.
RUN_BYTES = 1 << 19
_STRETCH = re.compile(r"\n| *[^ \n]+| +")


class Vocabulary:
    """Pieces with their weights, spaces written as spaces."""

    def __init__(self, path: str, power: float = POWER):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.weights: dict[str, tuple[float, int]] = {}
        self.byte_ids: dict[int, int] = {}
        spelt: list[bytes] = []
        plain = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        order = sorted((i for i in plain if not model.is_byte(i)), key=lambda i: (-model.get_score(i), i))
        place = {i: r for r, i in enumerate(order)}
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if i in place:
                text = piece.replace("▁", " ")
                self.weights[text] = ((place[i] + 1) ** -power, i)
                spelt.append(text.encode())
            elif i in set(plain):
                self.byte_ids[int(piece[3:5], 16)] = i
                spelt.append(bytes([int(piece[3:5], 16)]))
            else:
                spelt.append(b"")
        self.byte_weight = (len(order) + 1) ** -power
        #: Whatever a piece can begin with, by hash: its weight and id, or no id where it is no piece itself.
        prefixes = sorted({p[:n] for p in self.weights for n in range(1, len(p) + 1)})
        lengths = np.array([len(p) for p in prefixes], np.int64)
        hashes = _spans(_prefix_sums(np.frombuffer("".join(prefixes).encode("utf-32-le"), np.uint32)), np.cumsum(lengths) - lengths, lengths)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.found_id = np.array([self.weights.get(p, (0.0, -1))[1] for p in prefixes])[order]
        self.found_weight = np.array([self.weights.get(p, (0.0, -1))[0] for p in prefixes])[order]
        #: The table by the first bits of the hashes, so that most of what is not in it is met by an empty bucket.
        bits = max(len(self.hashes).bit_length() + 1, 1)
        self.shift = np.uint64(64 - bits)
        firsts = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.bucket_first = np.append(np.searchsorted(self.hashes, firsts), len(self.hashes)).astype(np.int32)
        sizes = np.array([len(b) for b in spelt], np.int64)
        self.spelt = Codes([])
        self.spelt.add(np.frombuffer(b"".join(spelt), np.uint8), sizes)


    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the table, -1 where there is none."""
        bucket = (hashes >> self.shift).view(np.int64)
        at = self.bucket_first[bucket]
        found = np.full(len(hashes), -1, np.int64)
        left = np.flatnonzero(at < self.bucket_first[bucket + 1])
        at, end = at[left], self.bucket_first[bucket[left] + 1]
        while len(left):
            same = self.hashes[at] == hashes[left]
            found[left[same]] = at[same]
            going = np.flatnonzero(~same & (at + 1 < end))
            left, at, end = left[going], at[going] + 1, end[going]
        return found


@cache
def vocabulary(path: str, power: float = POWER) -> Vocabulary:
    return Vocabulary(path, power)


class Lattices:
    """Filtered lattices of stretches: a node for each place, with the arcs that end there, the likeliest first.

    `node_arc` is a node's first arc; an arc has the node it comes from, what it stands for, and the share of the draws
    that fall on it or an arc before it. A stretch's first node has no arcs. `ends` is the last node of each stretch.
    """

    def __init__(self, words: Vocabulary):
        self.words = words
        self.clear()

    def clear(self) -> None:
        self.pending: list[str] = []
        self.place = _Places("", self.pending, [0])
        self.nodes = self.arcs = self.stretches = 0
        self.ends, self.node_arc = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.arc_from, self.arc_piece, self.arc_share = np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(1)
        self.spelling: dict[int, int] = {}
        #: What an arc stands for: a piece, or the bytes of a character.
        self.ids = Codes(list(range(self.words.size)))

    def _spell(self, code: int) -> int:
        found = self.spelling.get(code)
        if found is None:
            found = self.spelling[code] = self.ids.n
            ids = np.array([self.words.byte_ids[b] for b in chr(code).encode()], np.int64)
            self.ids.add(ids, np.array([len(ids)]))
        return found

    def learn(self) -> None:
        """Filters the lattices of the stretches that are new, side by side."""
        for start in range(0, len(self.pending), STRETCHES):
            self._learn(self.pending[start : start + STRETCHES])
        self.pending.clear()

    def _learn(self, new: list[str]) -> None:
        words = self.words
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        codes = np.frombuffer("".join(new).encode("utf-32-le"), np.uint32)
        offset = np.cumsum(sizes) - sizes
        first_node = self.nodes + offset + np.arange(len(new))
        owner = np.repeat(np.arange(len(new)), sizes)
        node = first_node[owner] + np.arange(len(codes)) - offset[owner]  # before each character
        left = (offset + sizes)[owner] - np.arange(len(codes))
        hashes = _prefix_sums(codes)
        begin: list[np.ndarray] = []
        end: list[np.ndarray] = []
        piece: list[np.ndarray] = []
        weight: list[np.ndarray] = []
        active, n = np.arange(len(codes)), 0
        while len(active):
            n += 1
            at = words.find(_spans(hashes, active, n))
            whole = (at >= 0) & (words.found_id[at] >= 0)
            if n == 1:
                alone = active[~whole]
                sort, inverse = np.unique(codes[alone], return_inverse=True)
                begin.append(node[alone])
                end.append(node[alone] + 1)
                piece.append(np.array([self._spell(int(c)) for c in sort], np.int64)[inverse])
                length = np.array([len(chr(int(c)).encode()) for c in sort], np.int64)[inverse]
                weight.append(words.byte_weight**length * SCALE)
            begin.append(node[active[whole]])
            end.append(node[active[whole]] + n)
            piece.append(words.found_id[at[whole]])
            weight.append(words.found_weight[at[whole]] * SCALE**n)
            active = active[at >= 0]
            active = active[left[active] > n]
        begin, end, piece, weight = map(np.concatenate, (begin, end, piece, weight))

        # Forward filtering, place by place in all stretches at once.
        total = int(sizes.sum()) + len(new)
        reach = np.zeros(total)
        reach[first_node - self.nodes] = 1.0
        start_of = np.repeat(first_node, sizes + 1)
        place = end - start_of[end - self.nodes]
        order = np.argsort(_narrow(place), kind="stable")
        begin, end, piece, weight, place = (x[order] for x in (begin, end, piece, weight, place))
        way = np.zeros(len(begin))
        bounds = np.searchsorted(place, np.arange(1, int(sizes.max()) + 2))
        for p in range(len(bounds) - 1):
            own = slice(bounds[p], bounds[p + 1])
            way[own] = reach[begin[own] - self.nodes] * weight[own]
            np.add.at(reach, end[own] - self.nodes, way[own])
            if p % 8 == 7:
                # Only shares count, so what a stretch's later places build on may be scaled as one.
                going = np.flatnonzero(sizes > p + 1)
                at = (first_node - self.nodes)[going] + p + 1
                scale = 1 / reach[at]
                for back in range(min(MOST, p + 1) + 1):
                    reach[at - back] *= scale

        order = np.lexsort((-way, _narrow(end - self.nodes)))
        begin, end, piece, way = (x[order] for x in (begin, end, piece, way))
        first_arc = np.searchsorted(end, self.nodes + np.arange(total + 1))
        some = first_arc[:-1][first_arc[1:] > first_arc[:-1]]
        way /= np.repeat(np.add.reduceat(way, some), np.diff(np.append(some, len(way))))
        until = np.cumsum(way)
        share = until - np.repeat(np.append(0.0, until)[some], np.diff(np.append(some, len(way))))
        share[first_arc[1:][first_arc[1:] > first_arc[:-1]] - 1] = 2.0  # whatever rounding leaves
        self.ends = _put(self.ends, self.stretches, first_node + sizes)
        self.node_arc = _put(self.node_arc, self.nodes, self.arcs + first_arc)
        self.arc_from = _put(self.arc_from, self.arcs, begin)
        self.arc_piece = _put(self.arc_piece, self.arcs, piece)
        self.arc_share = _put(self.arc_share, self.arcs, share)
        self.stretches += len(new)
        self.nodes += total
        self.arcs += len(begin)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in 16 bits where these do, which numpy sorts without comparing."""
    return x.astype(np.uint16) if x.max(initial=0) < 1 << 16 else x


def _put(column: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    column = room(column, at + len(values))
    column[at : at + len(values)] = values
    return column


def _prefix_sums(codes: np.ndarray) -> np.ndarray:
    up, _ = powers(len(codes) + 1)
    found = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], dtype=np.uint64, out=found[1:])
    return found


def _spans(sums_: np.ndarray, begin: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    _, down = powers(len(sums_))
    return mixed((sums_[begin + n] - sums_[begin]) * down[begin])


def stretches(text: str) -> list[str]:
    """A text, with a space before it, cut where no piece goes on."""
    whole = " " + text
    if "  " in whole or whole.endswith(" ") or " \n" in whole:
        return _STRETCH.findall(whole)
    found: list[str] = []
    for i, line in enumerate(whole.split("\n")):
        if i:
            found.append("\n")
        if line:
            first, *rest = line.split(" ")
            if first:
                found.append(first)
            found += [" " + w for w in rest]
    return found


def doc_keys(ids: list[int | None], seed: int) -> np.ndarray:
    return mixed(np.array([zlib.crc32(b"null") << 33 if i is None else i & (1 << 64) - 1 for i in ids], np.uint64) + mixed(np.array([seed], np.uint64)))


class Sampler:
    """A worker's lattices."""

    def __init__(self, path: str, power: float = POWER):
        self.words = vocabulary(path, power)
        self.lattices = Lattices(self.words)

    def sample(self, ids: list[int | None], texts: list[str | None], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts one after another, and how many each text has."""
        lattices = self.lattices
        if lattices.nodes > CACHE_NODES:
            lattices.clear()
        found: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            cut = stretches(text or "")
            counts[i] = len(cut)
            found += map(lattices.place.__getitem__, cut)
        lattices.learn()
        ends = lattices.ends[np.array(found, np.int64)]
        node_arc, arc_from, arc_piece, arc_share = lattices.node_arc, lattices.arc_from, lattices.arc_piece, lattices.arc_share
        place = np.arange(len(ends)) - np.repeat(np.cumsum(counts) - counts, counts)
        key = mixed(np.repeat(doc_keys(ids, seed), counts) + mixed(place.astype(np.uint64)))
        node = ends
        active = np.arange(len(node))
        steps = np.zeros(len(node), np.int64)
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        while len(active):
            draw = mixed(key[active] + np.uint64(len(drawn) + 1)) >> np.uint64(11)
            u = draw.astype(np.float64) * 2.0**-53
            arc = node_arc[node]
            beyond = np.flatnonzero(u >= arc_share[arc])
            while len(beyond):
                arc[beyond] += 1
                beyond = beyond[u[beyond] >= arc_share[arc[beyond]]]
            drawn.append((active, arc_piece[arc]))
            steps[active] += 1
            node = arc_from[arc]
            # A node without arcs of its own begins the stretch.
            going = np.flatnonzero(node_arc[node + 1] > node_arc[node])
            active, node = active[going], node[going]
        last = np.cumsum(steps) - 1
        pieces = np.zeros(int(steps.sum()), np.int64)
        for step, (which, piece) in enumerate(drawn):
            pieces[last[which] - step] = piece
        found = lattices.ids.take(pieces)
        by_stretch = sums(lattices.ids.lens[pieces], steps)
        return found, sums(by_stretch, counts)

    def decode(self, pieces: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each run of pieces, without the space put before it."""
        data = self.words.spelt.take(pieces.astype(np.int64)).astype(np.uint8).tobytes()
        sizes = sums(self.words.spelt.lens[pieces.astype(np.int64)], counts)
        ends = np.cumsum(sizes).tolist()
        return [data[e - n + 1 : e] for e, n in zip(ends, sizes.tolist(), strict=True)]


@cache
def sampler(path: str, power: float = POWER) -> Sampler:
    """The worker's own, kept between tasks."""
    return Sampler(path, power)


def encode_pieces(documents: DataFrame, path: str, seed: int = SEED, power: float = POWER) -> DataFrame:
    """doc_id and `pieces`, the sampled piece ids of the whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(path, power)
        for batch in slices(batches, size=RUN_BYTES):
            ids, counts = own.sample(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), seed)
            offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "pieces": lists})

    return documents.select("doc_id", "text").mapInArrow(rows, "doc_id long, pieces array<int>")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of its pieces."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(path)
        for batch in batches:
            lists = batch["pieces"]
            counts = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
            pieces = lists.flatten().to_numpy(zero_copy_only=False)
            texts = [b.decode() for b in own.decode(pieces, counts)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "text": texts})

    return encoded.select("doc_id", "pieces").mapInArrow(rows, "doc_id long, text string")


def sampled_round_trip(documents: DataFrame, path: str, seed: int = SEED, power: float = POWER) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit integers) and lossless: whether decoding the ids
    gave back the text, byte by byte."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(path, power)
        for batch in slices(batches, size=RUN_BYTES):
            texts = batch["text"].to_pylist()
            ids, counts = own.sample(batch["doc_id"].to_pylist(), texts, seed)
            raw = ids.astype("<u4", copy=False)
            ends = np.cumsum(counts).tolist()
            checks = [zlib.crc32(raw[e - n : e].data) for e, n in zip(ends, counts.tolist(), strict=True)]
            back = own.decode(ids, counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_pieces": counts,
                    "ids_crc32": pa.array(checks, pa.int64()),
                    "lossless": [b == (t or "").encode() for b, t in zip(back, texts, strict=True)],
                }
            )

    schema = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean"
    return documents.select("doc_id", "text").mapInArrow(rows, schema)
