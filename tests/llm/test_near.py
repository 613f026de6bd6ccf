"""Near duplicates: spanning forests, rows without ids, the recursion over large nodes, and how much each pass makes."""

import random
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from innledger.llm import near_dup

WORDS = [f"w{i}" for i in range(4000)]


def groups_of(rows):
    """(n_shingles, component, kept) by row number; rows without an id are documents of their own."""
    named = {i if i is not None else ("none", n): t for n, (i, t) in enumerate(rows)}
    keys = [i if i is not None else ("none", n) for n, (i, _) in enumerate(rows)]
    order = sorted(named, key=lambda k: (isinstance(k, tuple), k))
    found = brute.near_groups([(n, named[k]) for n, k in enumerate(order)])
    at = {k: n for n, k in enumerate(order)}
    out = []
    for k in keys:
        size, low = found[at[k]]
        lowest = order[low]
        out.append((None if isinstance(k, tuple) else k, size, None if isinstance(lowest, tuple) else lowest, lowest == k))
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in near_dup.near_duplicates(frame).collect()), key=str)


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def test_rows_without_ids(spark):
    rng = random.Random(2)
    a = " ".join(rng.choices(WORDS, k=120))
    chain = [a, edited(rng, a, 2)]
    chain += [edited(rng, chain[-1], 2)]
    chain += [edited(rng, chain[-1], 2)]
    b = " ".join(rng.choices(WORDS, k=60))
    rows = list(zip([1, None, None, 2], chain, strict=True))
    rows += [(None, b), (None, b), (None, edited(rng, b, 1)), (None, None), (None, ""), (5, ""), (6, "just three words")]
    assert found(spark, rows) == groups_of(rows)


def test_only_rows_without_ids(spark):
    got = found(spark, [(None, "a b c d e f")] * 3 + [(None, "other words than these are here")])
    assert got == [(None, 2, None, False)] * 2 + [(None, 2, None, True), (None, 2, None, True)]


@pytest.mark.parametrize("middle", [16, 4096])
def test_recursion_over_large_nodes(spark, monkeypatch, middle):
    """Small limits force splits at several depths, or blocks; nothing that is linked may be lost."""
    monkeypatch.setattr(near_dup, "SMALL", 8)
    monkeypatch.setattr(near_dup, "MIDDLE", middle)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    monkeypatch.setattr(near_dup, "DEPTH", 2)
    rng = random.Random(4)
    centre = " ".join(rng.choices(WORDS, k=100))
    # A core of near copies, and a fringe that is near to many of them but linked with few.
    rows = [(i, edited(rng, centre, rng.choice([1, 2, 3, 4, 7, 9]))) for i in range(120)]
    rows += [(1000 + i, edited(rng, rows[i][1], 2)) for i in range(0, 60, 3)]
    rows += [(2000 + i, " ".join(rng.choices(WORDS, k=80))) for i in range(20)]
    assert found(spark, rows) == groups_of(rows)


def test_forest_joins_all_that_pairs_join():
    rng = np.random.default_rng(6)
    for _ in range(60):
        n, m = int(rng.integers(2, 60)), int(rng.integers(1, 200))
        left, right = rng.integers(0, n, m), rng.integers(0, n, m)
        apart = left != right
        left, right = left[apart], right[apart]
        weight = rng.integers(0, 5, len(left))
        taken = near_dup.forest(np.arange(n), left, right, weight)

        def parts(edges, left=left, right=right, n=n):
            root = list(range(n))

            def top(x):
                while root[x] != x:
                    x = root[x]
                return x

            joins = 0
            for e in edges:
                a, b = top(left[e]), top(right[e])
                joins += a != b
                root[max(a, b)] = min(a, b)
            return [top(x) for x in range(n)], joins

        whole, joins = parts(range(len(left)))
        assert parts(taken.tolist()) == (whole, len(taken)) and joins == len(taken)
        lightest = parts(np.argsort(weight, kind="stable").tolist())  # Kruskal's order takes the same total weight
        assert lightest[1] == len(taken)


def test_common_shingles_are_counted_in_stretches(monkeypatch):
    monkeypatch.setattr(near_dup, "STRETCH", 64)
    monkeypatch.setattr(near_dup, "RUN_PAIRS", 3)
    rng = random.Random(8)
    sets = [set(rng.sample(range(400), rng.randint(0, 200))) for _ in range(12)]
    hashes = np.array([h for s in sets for h in s], np.uint64)
    owner = np.repeat(np.arange(12), [len(s) for s in sets])
    left, right = np.triu_indices(12, 1)
    want = [len(sets[a] & sets[b]) for a, b in zip(left, right, strict=True)]
    assert near_dup.common_shingles(hashes, owner, left, right).tolist() == want


def test_pairs_of_a_pass_are_fewer_than_members():
    rng = np.random.default_rng(1)
    n = 600
    sketch = rng.integers(-(2**63), 2**63 - 1, 4)[None].repeat(n, 0)
    sketch ^= np.int64(1) << rng.integers(0, 63, (n, 4))
    columns = {"path": np.sort(rng.integers(0, 9, n)), "rep": np.arange(n), "size": np.full(n, 50), "component": np.arange(n)}
    columns |= {f"s{i}": sketch[:, i] for i in range(4)}
    whole = pa.RecordBatch.from_pydict(columns)
    batches = [whole.slice(i, 70) for i in range(0, n, 70)]
    pairs = [b for b in near_dup.sparse_pairs(iter(batches))]
    found = pa.Table.from_batches(pairs).to_pylist()
    assert len(found) == n - 9  # a spanning tree of each node
    by_path = defaultdict(set)
    for row in found:
        assert columns["path"][row["a"]] == columns["path"][row["b"]]
        by_path[columns["path"][row["a"]]] |= {row["a"], row["b"]}
    assert sum(map(len, by_path.values())) == n
    assert sum(b.num_rows for b in near_dup.open_members(iter(batches))) == n


def test_thin_nodes_name_their_pairs():
    """Node 1 has two open members, node 2 five copies of one document and node 3 the pair of node 1 again."""
    path = np.array([1, 1, 1, 2, 2, 2, 2, 2, 3, 3])
    rep = np.array([10, 11, 12, 20, 21, 22, 23, 24, 11, 10])
    far = np.where(rep == 12, -1, 0)  # shares no bit with the others
    columns = {"path": path, "rep": rep, "size": np.full(10, 100), "component": rep}
    batch = pa.RecordBatch.from_pydict(columns | {c: far for c in near_dup.SKETCH})
    rows = [r for b in near_dup.open_members(iter([batch])) for r in b.to_pylist()]
    assert [(r["a"], r["b"]) for r in rows if r["path"] is None] == [(10, 11), (10, 11)]
    assert sorted(r["rep"] for r in rows if r["path"] is not None) == [20, 21, 22, 23, 24]
    assert all(r["a"] is None and r["b"] is None for r in rows if r["path"] is not None)


def test_later_levels_read_the_texts_of_open_nodes_alone(spark, monkeypatch):
    """Near pairs that the first level settles are in no later table of texts, so passes over texts shrink with what is open."""
    monkeypatch.setattr(near_dup, "SMALL", 8)
    monkeypatch.setattr(near_dup, "MIDDLE", 16)
    monkeypatch.setattr(near_dup, "DEPTH", 2)
    tables = {}
    kept = near_dup.Search.kept

    def noted(self, frame, name):
        out = kept(self, frame, name)
        if name.startswith(("texts", "open")):
            tables[name] = {r.rep for r in out.select("rep").collect()}
        return out

    monkeypatch.setattr(near_dup.Search, "kept", noted)
    rng = random.Random(4)
    centre = " ".join(rng.choices(WORDS, k=100))
    rows = [(i, edited(rng, centre, rng.choice([1, 2, 3, 4, 7, 9]))) for i in range(120)]
    pairs = [(1000 + 2 * i, " ".join(rng.choices(WORDS, k=100))) for i in range(10)]
    rows += pairs + [(i + 1, edited(rng, t, 1)) for i, t in pairs]
    assert found(spark, rows) == groups_of(rows)
    assert any(i >= 1000 for i in tables["texts"])
    assert tables["open0"] and tables["texts1"] == tables["open0"]
