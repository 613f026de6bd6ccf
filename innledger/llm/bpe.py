"""Byte-level BPE of whole texts through a worker's cache.

A text is cut before every space that is followed by a visible character. The tokenizer's own splitting rule always
cuts there, so the tokens of a text are the tokens of its pieces one after another; the library encodes each new
piece once per worker. A special string in a text is one token, as by the library's default, and is cut out first.

Whole runs of texts are cut further, as arrays of bytes: wherever the rule cuts for sure between letters, digits, marks and white
space. What a character is, the tokenizer itself tells. No cut is made between an apostrophe and a letter (a contraction
may begin there) nor beside a visible character beyond TOLD; the library splits such pieces itself. Each distinct piece of a run is
looked up once.
"""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from innledger.llm.words import WITHIN

#: Pieces a worker keeps; beyond, it starts anew between two runs of rows.
CACHE_PIECES = 800_000
#: Characters that count as white space in Python, at least all that do so for the tokenizer.
_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace()]
#: Pieces encoded as one text.
RUN_PIECES = 4096
_CUT = re.compile(r"(?= \S)")
#: Characters below are told apart; all white space is among them.
TOLD = 0x3001
BLANK, SPACE, LETTER, DIGIT, MARK, APOSTROPHE, OTHER = range(7)
#: By the kinds of two neighbours: whether a piece begins at the first one, and at the second one.
_AT_FIRST, _AT_SECOND = np.zeros((2, 8, 8), bool)
_AT_FIRST[:LETTER, LETTER:] = True  # the last blank of several
_AT_SECOND[LETTER:, :LETTER] = True
_AT_SECOND[BLANK, LETTER:] = True
_AT_SECOND[LETTER:OTHER, LETTER:OTHER] = ~np.eye(4, dtype=bool)
_AT_SECOND[[MARK, APOSTROPHE, APOSTROPHE], [APOSTROPHE, MARK, LETTER]] = False


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Places(dict):
    """Piece to its place; a new piece takes the next one."""

    def __init__(self, lead: str, pending: list[str], size: list[int]):
        self.lead, self.pending, self.size = lead, pending, size

    def __missing__(self, piece: str) -> int:
        place = self[piece] = self.size[0]
        self.size[0] += 1
        self.pending.append(self.lead + piece)
        return place


def cut(text: str) -> list[str]:
    """The pieces; all but the first stand for themselves with a space before."""
    if not text.endswith(" ") and not any(c in text and " " + c in text for c in _BLANKS):
        return text.split(" ")
    first, *rest = _CUT.split(text)
    if first.startswith(" ") and len(first) > 1 and not first[1].isspace():
        return ["", first[1:], *(p[1:] for p in rest)]
    return [first, *(p[1:] for p in rest)]


@cache
def kinds(path: str) -> np.ndarray:
    """The kind of each character below TOLD by what the tokenizer leaves in one piece with a letter, a digit or a mark; OTHER last."""
    found = np.full(TOLD + 1, BLANK, np.uint8)
    for before, kind in (("a", LETTER), ("1", DIGIT), ("!", MARK)):
        text = "".join(f"{before}{chr(c)}\n" for c in range(TOLD))
        spans = np.array([span for _, span in tokenizer(path).pre_tokenizer.pre_tokenize_str(text)])
        own = spans[(spans[:, 0] % 3 == 0) & (spans[:, 1] - spans[:, 0] == 2), 0] // 3
        found[own] = kind
    found[[ord(" "), ord("'"), TOLD]] = SPACE, APOSTROPHE, OTHER
    return found


def begins(data: np.ndarray, starts: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of UTF-8 texts begin that lie end to end, each text at one of `starts`, and the kind of each byte's character."""
    here = kind[:256].copy()
    here[128:] = OTHER
    here = here[data]
    lead = np.flatnonzero(data >= 0xC0)
    wide = False
    if len(lead):
        at = [data[np.minimum(lead + i, len(data) - 1)].astype(np.int32) for i in range(3)]
        point = np.where(at[0] < 0xE0, (at[0] & 31) << 6 | at[1] & 63, (at[0] & 15) << 12 | (at[1] & 63) << 6 | at[2] & 63)
        own = kind[np.where(at[0] < 0xF0, np.minimum(point, TOLD), TOLD)]
        wide = bool((own == BLANK).any())
        here[lead] = own
        for i, least in ((1, 0), (2, 0xE0), (3, 0xF0)):
            some = (at[0] >= least) & (lead + i < len(data))
            here[lead[some] + i] = own[some]
    pair = here[:-1] << 3 | here[1:]
    begin = np.zeros(len(data) + 1, bool)
    begin[: len(pair)] = _AT_FIRST.ravel()[pair]
    begin[starts - 1] = False  # blanks that end a text; the first start marks the spare place at the end
    if wide:
        inner = np.flatnonzero(begin[:-1] & WITHIN[data])
        begin[inner] = False
        while len(inner):
            inner = inner - 1
            begin[inner[~WITHIN[data[inner]]]] = True
            inner = inner[WITHIN[data[inner]]]
    begin[1 : len(data)] |= _AT_SECOND.ravel()[pair]
    begin[starts] = True
    return np.flatnonzero(begin[:-1]), here


def room(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate((array, np.zeros(max(size, len(array)), array.dtype)))


class Codes:
    """Token ids of many pieces, one after another, in arrays that grow by doubling."""

    def __init__(self, ids: list[int]):
        self.n, self.total = len(ids), len(ids)
        self._ids = np.array([*ids, 0], np.uint32)
        self._starts = np.arange(len(ids) + 1, dtype=np.int64)
        self._lens = np.ones(len(ids) + 1, np.int32)

    @property
    def lens(self) -> np.ndarray:
        return self._lens

    def add(self, ids: np.ndarray, lens: np.ndarray) -> None:
        n, total = self.n + len(lens), self.total + len(ids)
        self._ids = room(self._ids, total)
        self._starts, self._lens = room(self._starts, n), room(self._lens, n)
        self._ids[self.total : total] = ids
        self._lens[self.n : n] = lens
        self._starts[self.n : n] = self.total + np.cumsum(lens) - lens
        self.n, self.total = n, total

    def take(self, places: np.ndarray) -> np.ndarray:
        lens = self._lens[places]
        ends = np.cumsum(lens, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        return self._ids[np.arange(total) + np.repeat(self._starts[places] - ends + lens, lens)]


class PieceCache:
    """Token ids of pieces, gathered per run of texts without a Python step per token."""

    def __init__(self, path: str, limit: int = CACHE_PIECES):
        self.tokenizer = tokenizer(path)
        self.encode_batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.limit = limit
        self.specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        pattern = "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))
        self.special = re.compile(f"({pattern})")
        # Byte-level tokens are written with one character for each byte.
        sizes = {i: len(t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.bytes_of = np.zeros(max([*sizes, *self.specials.values()]) + 1, np.int64)
        self.bytes_of[list(sizes)] = list(sizes.values())
        self.kind = kinds(path)
        self.special_place = {s: i for i, s in enumerate(self.specials)}
        self.clear()

    def clear(self) -> None:
        self.pending: list[str] = []
        size = self.size = [len(self.specials)]
        self.rest, self.first = _Places(" ", self.pending, size), _Places("", self.pending, size)
        self.known: dict[str, int] = dict(self.special_place)
        self.pieces = Codes(list(self.specials.values()))

    def make_room(self) -> None:
        if self.size[0] > self.limit:
            self.clear()

    def text(self, text: str) -> list[int]:
        """Places of the pieces of one text, known or still to be learnt."""
        if not any(s in text for s in self.specials):
            pieces = cut(text)
            return [self.first[pieces[0]], *map(self.rest.__getitem__, pieces[1:])]
        places = []
        for part in self.special.split(text):
            if part in self.special_place:
                places.append(self.special_place[part])
            elif part:
                pieces = cut(part)
                places.append(self.first[pieces[0]])
                places.extend(map(self.rest.__getitem__, pieces[1:]))
        return places

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pieces of all texts, and how many each text has."""
        self.make_room()
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if bounds[0] == bounds[-1]:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        data = data.slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
        bounds = bounds - bounds[0]
        starts = bounds[:-1][bounds[:-1] < bounds[1:]]
        special = self.special_spans(texts, bounds, data)
        starts = np.unique(np.concatenate((starts, special.ravel())))
        at, kind = begins(np.frombuffer(data, np.uint8), starts[starts < bounds[-1]], self.kind)
        if len(special):
            of = np.searchsorted(special[:, 0], at) - 1
            at = at[(of < 0) | (at >= special[of, 1])]
        offsets = pa.py_buffer(np.append(at, bounds[-1]))
        pieces = pa.LargeStringArray.from_buffers(len(at), offsets, data).dictionary_encode()
        indices = pieces.indices.to_numpy()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False)
        own = np.array([*map(self.known.get, distinct, repeat(-1))], np.int64)
        new = np.flatnonzero(own < 0)
        if len(new):
            own[new] = np.arange(self.size[0], self.size[0] + len(new))
            self.known.update(zip(distinct[new], own[new].tolist(), strict=True))
            self.size[0] += len(new)
            # Distinct pieces are numbered as they come first.
            first = at[np.flatnonzero(np.diff(np.maximum.accumulate(indices), prepend=-1))[new]]
            several = pc.binary_length(pieces.dictionary).to_numpy()[new] > 1
            spaced = (kind[first] == SPACE) & several & (kind[np.minimum(first + 1, len(kind) - 1)] > SPACE)
            self.learn_cut(pieces.dictionary.take(new), spaced, kind[first] > SPACE)
        return own[indices], np.diff(np.searchsorted(at, bounds))

    def special_spans(self, texts: pa.Array, bounds: np.ndarray, data: pa.Buffer) -> np.ndarray:
        """Begin and end of each special string; none goes from one text to the next."""
        spans: list[tuple[int, int]] = []
        raw = data.to_pybytes() if self.specials else b""
        if any(s.encode() in raw for s in self.specials):
            for before, text in zip(bounds[:-1].tolist(), texts.to_pylist(), strict=True):
                parts = self.special.split(text)
                ends = before + np.cumsum([len(p.encode()) for p in parts])
                spans += zip(ends[:-1:2].tolist(), ends[1::2].tolist(), strict=True)
        return np.array(spans, np.int64).reshape(-1, 2)

    def learn(self) -> None:
        """Encodes the pieces that are new."""
        if not self.pending:
            return
        for start in range(0, len(self.pending), RUN_PIECES):
            run = self.pending[start : start + RUN_PIECES]
            mark = np.array([p[0:1] == " " and p[1:2] != "" and not p[1].isspace() for p in run])
            # Pieces that begin with a space and a visible character may stand one after another in one text; the bytes
            # of its tokens tell whose they are.
            joined = run if mark.all() else [run[i] for i in np.flatnonzero(mark)]
            alone = [run[i] for i in np.flatnonzero(~mark)]
            whole, *single = self.encode_batch(["".join(joined), *alone], add_special_tokens=False)
            found = np.array(whole.ids, np.int64)
            ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in joined])
            owner = np.searchsorted(ends, np.cumsum(self.bytes_of[found]))
            lens = np.zeros(len(run), np.int64)
            lens[mark] = np.bincount(owner, minlength=len(joined))
            if not alone:
                self.pieces.add(found, lens)
                continue
            lens[~mark] = [len(e.ids) for e in single]
            ids = np.zeros(int(lens.sum()), np.int64)
            of_joined = np.repeat(mark, lens)
            ids[of_joined] = found
            ids[~of_joined] = [i for e in single for i in e.ids]
            self.pieces.add(ids, lens)
        self.pending.clear()

    def learn_cut(self, pieces: pa.LargeStringArray, spaced: np.ndarray, seen: np.ndarray) -> None:
        """Encodes new pieces. `spaced` begin with a space and a visible character, `seen` with a visible character."""
        for start in range(0, len(pieces), RUN_PIECES):
            run = slice(start, start + RUN_PIECES)
            self._learn_run(pieces[run], spaced[run], seen[run])

    def _learn_run(self, pieces: pa.LargeStringArray, spaced: np.ndarray, seen: np.ndarray) -> None:
        # The first may stand one after another in one text, and after them the others, each behind a line break, which is
        # one token; the bytes of the tokens tell whose they are.
        order = np.concatenate((np.flatnonzero(spaced), np.flatnonzero(seen)))
        alone = np.flatnonzero(~spaced & ~seen)
        lead = np.where(seen[order], "\n", "").astype(object)
        joined = pc.binary_join_element_wise(pa.array(lead, pa.large_string()), pieces.take(order), pa.scalar("", pa.large_string()))
        text = "".join(joined.to_numpy(zero_copy_only=False))
        whole, *single = self.encode_batch([text, *pieces.take(alone).to_pylist()], add_special_tokens=False)
        found = np.array(whole.ids, np.int64)
        owner = np.searchsorted(np.cumsum(pc.binary_length(joined).to_numpy()), np.cumsum(self.bytes_of[found]))
        keep = (np.diff(owner, prepend=-1) == 0) | ~seen[order][owner]
        found, owner = found[keep], order[owner[keep]]
        if len(alone):
            found = np.concatenate((found, np.array([i for e in single for i in e.ids], np.int64)))
            owner = np.concatenate((owner, np.repeat(alone, [len(e.ids) for e in single])))
        self.pieces.add(found[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(pieces)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        places, pieces = self.places(texts)
        return self.pieces.take(places), sums(self.pieces.lens[places], pieces)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of values; runs may be empty."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


@cache
def piece_cache(path: str) -> PieceCache:
    """The worker's own, kept between tasks."""
    return PieceCache(path)
