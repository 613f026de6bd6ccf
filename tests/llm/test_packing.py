"""Packing against a plain best-two-fit, one bin at a time over a list."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from innledger.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_bins(items, size):
    """Bins as sorted lists of lengths."""
    left, bins = sorted(items), []
    while left:
        taken, gap = [], size
        while fits := [x for x in left if x <= gap]:
            taken.append(fits[-1])
            left.remove(fits[-1])
            gap -= fits[-1]
        smallest = min(taken)
        room = gap + smallest
        pairs = [(x + y, x, y) for i, x in enumerate(left) for y in left[:i] if smallest < x + y <= room]
        if gap and pairs:
            _, x, y = max(pairs)
            taken.remove(smallest)
            left += [smallest]
            left.remove(x)
            left.remove(y)
            left.sort()
            taken += [x, y]
        bins.append(sorted(taken))
    return sorted(bins)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_two_fit(seed):
    rng = random.Random(seed)
    size = rng.choice([5, 10, 20, 64])
    items = [rng.randint(1, size) for _ in range(rng.randint(0, 120))]
    plan = packing.plan(Counter(items), size)
    bins, seen = defaultdict(list), Counter()
    for length in items:
        at, offset = plan.place(np.array([length]), np.array([seen[length]]))
        seen[length] += 1
        bins[int(at[0])].append((int(offset[0]), length))
    for placed in bins.values():
        placed.sort()
        assert [o for o, _ in placed] == list(np.cumsum([0, *(n for _, n in placed[:-1])]))
    assert sorted(bins) == list(range(plan.bins))
    assert sorted(sorted(n for _, n in b) for b in bins.values()) == plain_bins(items, size)


def test_plan_does_not_grow_with_the_rows():
    few = packing.plan({n: 1000 + n for n in range(1, 1025)})
    many = packing.plan({n: (1000 + n) * 10**6 for n in range(1, 1025)})
    assert len(many.rank) < 2 * len(few.rank) < 10_000
    tokens = sum(n * (1000 + n) for n in range(1, 1025)) * 10**6
    over_half = sum(1000 + n for n in range(513, 1025)) * 10**6  # no two of these share a bin
    assert many.bins < 1.01 * max(tokens / 1024, over_half)


def check(spark, tmp_path, rows, size):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sequence_id string")
    folder = str(tmp_path / "pieces")
    packed = packing.pack(docs, PATH, folder, size)
    out = [r.asDict() for r in packed.collect()]
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) - (-(-len(ids) // size) - 1) * size
        cuts = [0, *range(first, len(ids) + 1, size)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[c] for c in key) for r in out) == want
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"], r["ids_crc32"]))
    whole = {r.sequence_id: r.ids for r in packing.sequences(spark, folder, packed).collect()}
    assert set(whole) == set(bins)
    for at, placed in bins.items():
        end = 0
        for offset, length, crc in sorted(placed):
            assert offset == end
            end += length
            assert zlib.crc32(whole[at][offset * 4 : end * 4]) == crc
        assert end <= size and end * 4 == len(whole[at])
    assert len(bins) == len(plain_bins([r["length"] for r in out], size))
    return out


def test_odd_rows(spark, tmp_path):
    rng = random.Random(3)
    words = ["alpha", "beta", " ", "\n", "<|endoftext|>", "émile", "漢字", "x" * 30]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 90)))) for i in range(150)]
    rows += [(None, None), (None, "no id"), (7, ""), (8, "same"), (8, "same"), (8, "other"), (9, "long " * 5000)]
    check(spark, tmp_path, rows, 64)


def test_empty_table(spark, tmp_path):
    assert check(spark, tmp_path, [], 1024) == []
