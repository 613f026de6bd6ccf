"""Vector codes against plain rounds that compare every part with every entry."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import sample_dir

from innledger.llm import codes
from innledger.llm.queries import op13_vector_codes


def plain(rows, parts=4, entries=256, rounds=4):
    """rows: (vec_id, embedding, label); codes, errors and label errors as a Counter, and the digest."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    size = max(-(-max((len(r[1]) for r in good), default=0) // parts), 1)
    x = np.zeros((len(good), parts * size), np.int64)
    for i, r in enumerate(good):
        x[i, : len(r[1])] = [math.floor(1024 * c) for c in r[1]]
    x = x.reshape(-1, parts, size)
    books = x[:entries].copy()

    def nearest():
        return [[int(((books[:, p] - row[p]) ** 2).sum(1).argmin()) for p in range(parts)] for row in x]

    for _ in range(rounds):
        found = np.array(nearest()).reshape(-1, parts)
        for p in range(parts):
            for e in set(found[:, p].tolist()):
                members = x[found[:, p] == e, p]
                books[e, p] = [int(c) // len(members) for c in members.sum(0)]
    found = nearest()
    errors = [sum(int(((books[e, p] - row[p]) ** 2).sum()) for p, e in enumerate(f)) for row, f in zip(x, found)]
    labels = Counter()
    for r, e in zip(good, errors):
        labels[r[2]] += e
    out = Counter((r[0], "".join(f"{e:02x}" for e in f), e, labels[r[2]]) for r, f, e in zip(good, found, errors))
    values = books.transpose(1, 0, 2).ravel().tolist()
    return out, hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()


def check(found, want, digest):
    rows = found.collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in rows) == want
    assert {r.codebooks_sha256 for r in rows} <= {digest}


def odd(n, size, seed):
    """Vectors in clumps, with ties, repeated rows and rows to leave out."""
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.5]) + rng.gauss(0, 0.01) for _ in range(size)], i % 3) for i in range(n)]
    rows += [(n + i, [float(rng.randint(0, 1)) for _ in range(size)], None) for i in range(n)]
    rows += [rows[5], rows[5], (None, [0.1] * size, 1), (7, [9.0] * size, 2), (-3, [-0.001] * size, 0)]
    rows += [(9000, None, 1), (9001, [float("nan")] * size, 1), (9002, [float("inf")] + [0.0] * (size - 1), 1)]
    rows += [(9003, [None] + [0.0] * (size - 1), 1), (9004, [1.0, 2.0], 5), (9005, [], None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "first_kept", "run"), [(8, 16, 2048), (10, 2, 7), (1, 1, 50)])
def test_odd_rows(spark, tmp_path, monkeypatch, size, first_kept, run):
    monkeypatch.setattr(codes, "FIRST_KEPT", first_kept)
    monkeypatch.setattr(codes, "RUN_ROWS", run)
    rows = odd(400, size, size)
    table = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<float>, label int, code string")
    rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    check(codes.vector_codes(table.repartition(3), str(tmp_path)), *plain(rows))


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 1.0, 2.0, 3.0], None)], [(1, None, 1)]])
def test_few_rows(spark, tmp_path, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    want, digest = plain(rows)
    check(codes.vector_codes(table, str(tmp_path)), want, digest)


def test_refuses_what_is_not_exact(spark, tmp_path):
    table = spark.createDataFrame([(1, [1e9] * 8, 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="too large"):
        codes.vector_codes(table, str(tmp_path))


def test_bounds_save_work_and_adapt():
    rng = np.random.default_rng(3)
    centres = rng.integers(-900, 900, (64, 16))
    x = centres[rng.integers(0, 64, 4000)] + rng.integers(-30, 30, (4000, 16))
    start = x[:64].copy()[None]
    books = codes.Books(start, np.zeros((1, 64), np.int64), [8])
    near, bounds = codes.search(x, books, 0)
    looked_at = []
    for _ in range(4):
        moved = np.array([x[near[:, 0] == e].sum(0) // max((near[:, 0] == e).sum(), 1) for e in range(64)])[None]
        moved[:, np.bincount(near[:, 0], minlength=64) == 0] = books.entries[:, np.bincount(near[:, 0], minlength=64) == 0]
        step = codes._ceil_root(((moved - books.entries) ** 2).sum(2))
        books = codes.Books(moved, step, books.kept)
        near, bounds, looked = codes.refine(x, books, 0, near, bounds)
        exact = ((x[:, None] - books.entries[0]) ** 2).sum(2)
        assert (near[:, 0] == exact.argmin(1)).all()
        roots = np.sqrt(exact)
        own = np.take_along_axis(roots, near, 1)
        assert (bounds[:, 0] >= own[:, 0] - 1e-6).all()
        others = np.minimum.accumulate(bounds[:, :0:-1], 1)[:, ::-1]
        assert (others[:, :-1] <= own[:, 1:] + 1e-6).all()
        looked_at.append(len(looked))
        depth = np.bincount(looked, minlength=codes.MOST_KEPT + 2)
        assert codes.LEAST_KEPT <= codes._adapted(8, depth) <= codes.MOST_KEPT
    assert looked_at[-1] < len(x) / 4


def test_kept_entries_follow_the_depths():
    depth = np.zeros(codes.MOST_KEPT + 2, np.int64)
    assert codes._adapted(8, depth) == 8
    depth[1:4] = 100
    assert codes._adapted(8, depth) == 3
    depth[9] = 1000
    assert codes._adapted(8, depth) == 16


def test_sample_table(spark):
    table = spark.read.parquet(f"{sample_dir('0.001')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    check(op13_vector_codes(spark, sample_dir("0.001")), *plain(rows))
