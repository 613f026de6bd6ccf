"""Near-duplicate documents by chosen-path set similarity joins.

A document is its set of word shingles; documents with equal sets are one node of the search, represented by the smallest
id. Each of ROOTS trees sends a document to the child named by its minimum under the tree's own hash function. A child
with at most SMALL documents is compared exhaustively. A larger one is split again: a document goes on
to one or, in one case of three, two children, by hash functions that the path itself chooses, so on average to 4/3 of a
child: two documents at the threshold of 3/4 then meet in one child of each split on average, and the trees make up for
the splits in which they don't. Nodes of middling size are compared exhaustively too, as wholes; what is still large after
DEPTH splits is compared block by block.

What matters is who is connected, not each link, so every level has two passes over the same rows. In the first a task compares
256-bit sketches and names, for each node, a spanning forest of its candidate pairs, most similar first, which is fewer pairs
than members; the members of middling and large nodes take part in a block each and with one guide member. These pairs are
confirmed on full sets, and the components are brought up to date. In the second pass the nodes up to middling size come whole:
where the candidate pairs of different components are no more than their members, they are named, so that a pair that meets in
many trees is confirmed once; else these members meet with their texts in one task, which confirms on full sets
and names the links of a spanning forest again. No member is copied for either pass, so the rows that they make are in
proportion to the members, even in a group of thousands of near copies. A node whose members are all connected is done.

Sizes and sketches only choose pairs: a pair is linked if its full shingle sets say so. The size test is exact. The sketch
is the same in all trees, so a pair that it rejects is lost; its bound lies five standard deviations below what a pair at
the threshold shares. Such a pair meets in at least one of the trees' first children with probability 1 - 4**-24.

Null texts and texts without words have an empty set and are linked with nothing. A text with fewer words than a shingle is
one shingle. Repeated rows give repeated rows with the same result; rows that share an id share its group. A row with a null
id is a document of its own: its row gets the smallest id of its group, or null where no member has one; of such a group one
row is kept. Ids are below 2**62. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.llm.components import components
from innledger.llm.words import CHUNK_BYTES, Packed, mixed, slices
from innledger.session import new_folder, remove_folder

SHINGLE = 5
PERCENT = 75
ROOTS, SMALL, DEPTH = 24, 128, 14
#: Nodes up to this size are compared whole instead of being split; members of a block of what is left after DEPTH splits.
MIDDLE, BLOCK = 4096, 1024
#: Minwise values kept for choosing children; sketch bits; bits that a candidate pair shares at least: five standard
#: deviations (of 5.3 bits) below the 224 that a pair at the threshold shares on average.
VALUES, BITS, NEAR_BITS = 48, 256, 197

PROFILE = "doc_id long, text string, n_shingles long, set_lo long, set_hi long, s0 long, s1 long, s2 long, s3 long, minima array<int>"
SKETCH = ["s0", "s1", "s2", "s3"]
_SEEDS = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 32, (BITS, 2), dtype=np.uint64).astype(np.uint32)
_SEEDS[:, 0] |= np.uint32(1)


def shingles(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct shingle hashes, text by text, and the text of each."""
    p = Packed(texts, lower=True)
    words = p.words()
    hashes, first = p.windows(words, k)
    owner = p.text_of[first]
    for n in range(1, k):
        if (p.counts == n).any():
            whole, first = p.windows(words, n)
            short = p.counts[p.text_of[first]] == n
            hashes = np.concatenate((hashes, whole[short] + np.uint64(n)))
            owner = np.concatenate((owner, p.text_of[first[short]]))
    _, at = np.unique(mixed(owner.astype(np.uint64) + np.uint64(1)) ^ hashes, return_index=True)
    at = at[np.argsort(owner[at], kind="stable")]
    return hashes[at], owner[at], p.n


def _where_null(ids: pa.Array, texts: pa.Array) -> pa.Array:
    if not ids.null_count:
        return pa.nulls(len(ids), texts.type)
    lost = ids.is_null().to_pylist()
    return pa.array([t.as_py() if here else None for t, here in zip(texts, lost, strict=True)], texts.type)


def profiles(documents: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Size, 128-bit name, sketch and minwise values of each document's shingle set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, owner, n = shingles(batch["text"], k)
            counts = np.bincount(owner, minlength=n)
            some = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[some]
            names = np.zeros((2, n), np.uint64)
            sketch = np.zeros((BITS // 64, n), np.uint64)
            minima = np.zeros((n, VALUES), np.int32)
            if len(some):
                for i in range(2):
                    names[i, some] = np.add.reduceat(mixed(hashes + np.uint64(i + 1)), starts)
                small = (hashes >> np.uint64(32)).astype(np.uint32)
                for j, (a, b) in enumerate(_SEEDS):
                    hashed = small * a + b
                    least = np.minimum.reduceat(hashed ^ (hashed >> np.uint32(15)), starts)
                    bit = mixed(least.astype(np.uint64) + np.uint64(j)) & np.uint64(1)
                    sketch[j // 64, some] |= bit << np.uint64(j % 64)
                    if j < VALUES:
                        minima[some, j] = least.view(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    # Only a row without an id has to keep its text to be found again.
                    "text": _where_null(batch["doc_id"], batch["text"]),
                    "n_shingles": counts.astype(np.int64),
                    "set_lo": names[0].view(np.int64),
                    "set_hi": names[1].view(np.int64),
                    **{name: bits.view(np.int64) for name, bits in zip(SKETCH, sketch, strict=True)},
                    "minima": pa.ListArray.from_arrays(
                        pa.array(np.arange(0, (n + 1) * VALUES, VALUES), pa.int32()), pa.array(minima.reshape(-1))
                    ),
                }
            )

    return documents.select("doc_id", "text").mapInArrow(rows, PROFILE)


PAIR = "a long, b long"
MEMBER = ["path", "rep", "size", *SKETCH]
OPEN = "path long, rep long, size long, s0 long, s1 long, s2 long, s3 long, component long"
STILL = f"{OPEN}, {PAIR}"


class Nodes:
    """Whole nodes, one after another, by size within, and their near pairs of different components."""

    def __init__(self, columns: dict[str, np.ndarray]):
        self.columns = columns
        self.path, self.rep, self.component = columns["path"], columns["rep"], columns["component"]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Left and right member and the number of sketch bits that differ, by how far the members lie apart."""
        path, size, component = self.path, self.columns["size"], self.component
        first = np.flatnonzero(np.diff(path, prepend=path[0] - 1))
        several = np.minimum.reduceat(component, first) != np.maximum.reduceat(component, first)
        left = np.flatnonzero(np.repeat(several, np.diff(np.append(first, len(path)))))
        d = 0
        while len(left):
            d += 1
            left = left[left < len(path) - d]
            # Sizes ascend within a node: a member that is too small for this one is too small for all that follow.
            left = left[(path[left] == path[left + d]) & (100 * size[left] >= PERCENT * size[left + d])]
            open_ = left[component[left] != component[left + d]]
            apart = np.zeros(len(open_), np.int64)
            for name in SKETCH:
                bits = self.columns[name]
                apart += np.bitwise_count((bits[open_] ^ bits[open_ + d]).view(np.uint64))
            near = apart <= BITS - NEAR_BITS
            if near.any():
                yield open_[near], open_[near] + d, apart[near]

    def trees(self) -> np.ndarray:
        """A number per member that those of one node and component share: its first member."""
        order = np.lexsort((self.component, self.path))
        path, component = self.path[order], self.component[order]
        new = np.append(True, (path[1:] != path[:-1]) | (component[1:] != component[:-1]))
        out = np.empty(len(order), np.int64)
        out[order] = order[new][np.cumsum(new) - 1]
        return out


def joined(trees: np.ndarray, left: np.ndarray, right: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs join the trees to as few as possible, the least weight first, and the trees that they make: all trees take
    their best pair at once."""
    order = np.argsort(weight, kind="stable")
    chosen: list[np.ndarray] = []
    trees = trees.copy()
    while len(order):
        a, b = trees[left[order]], trees[right[order]]
        order, a, b = order[a != b], a[a != b], b[a != b]
        if not len(order):
            break
        ends, best = np.unique(np.stack((a, b), 1).ravel(), return_index=True)
        best //= 2
        chosen.append(np.unique(order[best]))
        parent = np.arange(int(trees.max()) + 1)
        parent[ends] = np.where(a[best] == ends, b[best], a[best])
        mutual = parent[parent[ends]] == ends  # two trees that chose each other: the smaller one leads
        parent[ends[mutual]] = np.minimum(ends[mutual], parent[ends[mutual]])
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
        trees = parent[trees]
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64), trees


def forest(trees: np.ndarray, left: np.ndarray, right: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The pairs of `joined` alone."""
    return joined(trees, left, right, weight)[0]


def whole_nodes(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Rows in runs that end where a node ends. Nodes come one after another and are bounded in size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        batch = batch.select(columns)
        if not batch.num_rows:
            continue
        path = batch["path"].to_numpy()
        last = int(np.searchsorted(path, path[-1])) if path[0] != path[-1] else 0
        if last or (held and held[-1]["path"][0].as_py() != path[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _nodes(table: pa.Table) -> Nodes:
    return Nodes({c: table[c].to_numpy() for c in (*MEMBER, "component")})


def sparse_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the near pairs of each node."""
    for table in whole_nodes(batches, [*MEMBER, "component"]):
        nodes = _nodes(table)
        found = list(nodes.pairs())
        if found:
            left, right, apart = (np.concatenate(x) for x in zip(*found, strict=True))
            taken = forest(nodes.trees(), left, right, apart)
            a, b = nodes.rep[left[taken]], nodes.rep[right[taken]]
            yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is near in a node and of different components: its pairs, where they are no more than the members that they have,
    else these members. Pairs that meet in several nodes can be told to be the same ones."""
    for table in whole_nodes(batches, [*MEMBER, "component"]):
        nodes = _nodes(table)
        mark = np.zeros(len(nodes.path), bool)
        node = np.cumsum(np.diff(nodes.path, prepend=nodes.path[0]) != 0)
        size = np.bincount(node)
        n_pairs = np.zeros(len(size), np.int64)
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for left, right, _ in nodes.pairs():
            mark[left] = mark[right] = True
            n_pairs += np.bincount(node[left], minlength=len(size))
            few = n_pairs[node[left]] <= size[node[left]]
            held.append((left[few], right[few]))
        few = n_pairs <= np.bincount(node[mark], minlength=len(size))
        left, right = (np.concatenate(x) for x in zip(*held, strict=True))
        own = few[node[left]]
        mark &= ~few[node]
        if own.any():
            a, b = nodes.rep[left[own]], nodes.rep[right[own]]
            empty = {c: pa.nulls(len(a), pa.int64()) for c in nodes.columns}
            yield pa.RecordBatch.from_pydict({**empty, "a": np.minimum(a, b), "b": np.maximum(a, b)})
        if mark.any():
            none = pa.nulls(int(mark.sum()), pa.int64())
            yield pa.RecordBatch.from_pydict({**{c: x[mark] for c, x in nodes.columns.items()}, "a": none, "b": none})


#: Shingles that are compared at a time, as bits, and pairs; candidate pairs that are held at a time.
STRETCH, RUN_PAIRS, HELD_PAIRS = 1 << 14, 4096, 1 << 18


def common_shingles(hashes: np.ndarray, owner: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles the members of each pair have in common. Shingles of one member alone are left out."""
    n = max(int(owner.max(initial=-1)), int(left.max(initial=-1)), int(right.max(initial=-1))) + 1
    _, own, uses = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = uses[own] > 1
    place = (np.cumsum(uses > 1) - 1)[own[shared]]
    owner = owner[shared]
    common = np.zeros(len(left), np.int64)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, STRETCH):
        at = slice(*np.searchsorted(place, (start, start + STRETCH)))
        width = min(STRETCH, int(place[-1]) + 1 - start)
        marks = np.zeros((n, -(-width // 64) * 64), bool)
        marks[owner[at], place[at] - start] = True
        bits = np.packbits(marks, axis=1).view(np.uint64)
        for begin in range(0, len(left), RUN_PAIRS):
            run = slice(begin, begin + RUN_PAIRS)
            common[run] += np.bitwise_count(bits[left[run]] & bits[right[run]]).sum(1, dtype=np.int64)
    return common


def _node_runs(table: pa.Table) -> Iterator[pa.Table]:
    """The nodes in runs of at most CHUNK_BYTES of text, or one node."""
    path = table["path"].to_numpy()
    sizes = pc.binary_length(table["text"]).to_numpy().astype(np.int64)
    ends = np.append(np.flatnonzero(np.diff(path)) + 1, len(path))
    until = np.cumsum(sizes)[ends - 1]
    start = before = 0
    while start < len(path):
        stop = max(int(np.searchsorted(until, before + CHUNK_BYTES, "right")), int(np.searchsorted(ends, start, "right")) + 1)
        yield table.slice(start, ends[stop - 1] - start)
        start, before = ends[stop - 1], until[stop - 1]


def _runs_of_pairs(nodes: Nodes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The near pairs in runs of some HELD_PAIRS, by left member."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for left, right, _ in nodes.pairs():
        held.append((left, right))
        n += len(left)
        if n >= HELD_PAIRS:
            yield _by_left(held)
            held, n = [], 0
    if held:
        yield _by_left(held)


def _by_left(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    left, right = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


def _shingles_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, row by row, and the row of each."""
    hashes, owners, before = [], [], 0
    for batch in slices(table.select(["text"]).to_batches()):
        found, owner, n = shingles(batch["text"])
        hashes.append(found)
        owners.append(owner + before)
        before += n
    return np.concatenate(hashes), np.concatenate(owners)


def linked_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links of each node, confirmed on full sets."""
    for table in whole_nodes(batches, [*MEMBER, "component", "text"]):
        for run in _node_runs(table):
            nodes = _nodes(run)
            trees = nodes.trees()
            hashes = owner = None
            n = len(nodes.path)
            first = np.append(np.flatnonzero(np.diff(nodes.path, prepend=nodes.path[0] - 1)), n)
            for left, right in _runs_of_pairs(nodes):
                if hashes is None:
                    hashes, owner = _shingles_of(run)
                    counts = np.bincount(owner, minlength=n)
                    shingle_at = np.searchsorted(owner, first)
                # What an earlier run of pairs has connected needs no further link.
                apart = trees[left] != trees[right]
                left, right = left[apart], right[apart]
                pair_at = np.searchsorted(left, first)
                common = np.zeros(len(left), np.int64)
                for i, member in enumerate(first[:-1].tolist()):
                    pairs = slice(pair_at[i], pair_at[i + 1])
                    if pairs.start < pairs.stop:
                        own = slice(shingle_at[i], shingle_at[i + 1])
                        common[pairs] = common_shingles(hashes[own], owner[own] - member, left[pairs] - member, right[pairs] - member)
                union = counts[left] + counts[right] - common
                good = np.flatnonzero(100 * common >= PERCENT * union)
                taken, trees = joined(trees, left[good], right[good], union[good] - common[good])
                taken = good[taken]
                if len(taken):
                    a, b = nodes.rep[left[taken]], nodes.rep[right[taken]]
                    yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _near(left: str = "", right: str = "g."):
    apart = [F.bit_count(F.col(left + c).bitwiseXOR(F.col(right + c))) for c in SKETCH]
    less, more = F.least(left + "size", right + "size"), F.greatest(left + "size", right + "size")
    return (less * 100 >= more * PERCENT) & (sum(apart[1:], apart[0]) <= BITS - NEAR_BITS)


class Search:
    """The state of one search: tables in `folder` and the components found so far.

    `texts` gives the text of every representative as rep, text.
    """

    def __init__(self, reps: DataFrame, texts: DataFrame, folder: str):
        self.spark = reps.sparkSession
        self.reps, self.all_texts, self.folder = reps, texts, folder
        self.texts: DataFrame | None = None
        self.steps = 0
        self.labels = self.spark.createDataFrame([], "node long, component long")

    def kept(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{name}")

    def dropped(self, *names: str) -> None:
        for name in names:
            remove_folder(self.spark, f"{self.folder}/{name}")

    def labelled(self, frame: DataFrame, column: str, label: str) -> DataFrame:
        known = self.labels.select(F.col("node").alias(column), F.col("component").alias("_c"))
        return frame.join(known, column, "left").withColumn(label, F.coalesce("_c", column)).drop("_c")

    def run(self) -> DataFrame:
        """`node`, `component` of every representative that is linked with another."""
        roots = F.posexplode(F.slice("minima", 1, ROOTS)).alias("tree", "value")
        level = self.reps.select("rep", "size", *SKETCH, roots).select(F.xxhash64("tree", "value").alias("path"), *MEMBER[1:])
        minima = None
        for depth in range(DEPTH + 1):
            nodes = self.kept(
                level.groupBy("path").agg(F.count("*").alias("count")).where(F.col("count") > SMALL), f"nodes{depth}"
            )
            counted = self.kept(level.join(nodes, "path", "left"), f"counted{depth}")
            members = counted.where("count is not null")
            first = self.labelled(_homes(counted), "rep", "component")
            pairs = self.kept(
                _by_node(first, sparse_pairs, PAIR).unionByName(self.guided(members, depth)).distinct(), f"pairs{depth}"
            )
            if self.texts is None:
                # All that later passes can bring together is in a larger node now; a near member of a small one is in a pair.
                involved = members.select("rep").unionByName(_ends(pairs)).distinct()
                # Merged and never broadcast: the same plan at any size.
                self.texts = self.kept(self.all_texts.join(involved.hint("merge"), "rep", "left_semi"), "texts")
                minima = self.kept(
                    self.reps.select("rep", "minima").join(members.select("rep").distinct(), "rep", "left_semi"), "minima"
                )
            if self.steps:
                pairs = self.labelled(self.labelled(pairs, "a", "_a"), "b", "_b").where("_a <> _b").select("a", "b")
            self.connect(confirm(pairs, self.texts))
            size = F.coalesce("count", F.lit(0))
            self.settle(counted.where(size <= MIDDLE))
            # A larger node whose members are all connected has nothing left to find.
            larger = members.where(F.col("count") > MIDDLE)
            sizes = self.labelled(larger, "rep", "component").groupBy("path", "component").agg(F.count("*").alias("c"))
            top = F.max(F.struct("c", "component")).alias("top")
            mixed_nodes = sizes.groupBy("path").agg(top, F.sum("c").alias("n")).where("top.c < n")
            mixed_nodes = mixed_nodes.select("path", F.col("top.component").alias("main"), (F.col("n") - F.col("top.c")).alias("others"))
            rest = self.kept(larger.join(mixed_nodes, "path"), f"open{depth}")
            self.dropped(*(f"{name}{depth}" for name in ("nodes", "counted", "pairs", "guides", "level")))
            if rest.isEmpty():
                break
            # Later levels look at these members alone, so each pass over the texts is as long as what is still open.
            still = rest.select("rep").distinct()
            self.texts = self.kept(self.texts.join(still, "rep", "left_semi"), f"texts{depth + 1}")
            self.dropped("texts" if not depth else f"texts{depth}")
            if depth == DEPTH:
                self.settle(_blocks(self.labelled(rest, "rep", "component")))
                break
            level = self.kept(_children(rest, minima), f"level{depth + 1}")
            if level.isEmpty():
                break
        return self.labels

    def guided(self, members: DataFrame, depth: int) -> DataFrame:
        """One member of each node, another one in each node that it is in, with all that are near to it."""
        order = F.struct(F.xxhash64("path", "rep").alias("h"), *MEMBER[1:])
        guides = self.kept(members.groupBy("path").agg(F.min(order).alias("g")), f"guides{depth}")
        near = members.join(guides, "path").where(_near() & (F.col("rep") != F.col("g.rep")))
        return near.select(F.least("rep", "g.rep").alias("a"), F.greatest("rep", "g.rep").alias("b"))

    def settle(self, rows: DataFrame) -> None:
        """Compares the members of bounded nodes that may be linked with another component on their full sets."""
        rows = self.labelled(rows.select(*MEMBER), "rep", "component")
        name = f"still{self.steps}"
        still = self.kept(_by_node(rows, open_members, STILL), name)
        if not still.isEmpty():
            pairs = still.where("path is null").select("a", "b").distinct()
            whole = still.where("path is not null").drop("a", "b").join(self.texts, "rep")
            self.connect(confirm(pairs, self.texts).unionByName(_by_node(whole, linked_members, PAIR)))
        self.dropped(name)

    def connect(self, links: DataFrame) -> None:
        """Adds links and brings the components up to date: only the new links are followed, between components."""
        step = self.steps = self.steps + 1
        links = self.kept(links.distinct(), f"links{step}")
        between = self.labelled(self.labelled(links, "a", "_a"), "b", "_b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        moved = components(self.spark, between, f"{self.folder}/components{step}")
        moved = moved.select(F.col("node").alias("component"), F.col("component").alias("_up"))
        fresh = _ends(links).select(F.col("rep").alias("node")).distinct().join(self.labels, "node", "left_anti")
        known = self.labels.unionByName(fresh.withColumn("component", F.col("node")))
        now = known.join(moved, "component", "left").select("node", F.coalesce("_up", "component").alias("component"))
        self.labels = self.kept(now, f"labels{step}")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))


def _by_node(rows: DataFrame, work: Callable, layout: str) -> DataFrame:
    """Rows of bounded nodes, the members of a node one after another in one task."""
    return rows.repartition("path").sortWithinPartitions("path", "size", "rep").mapInArrow(work, layout)


def _homes(rows: DataFrame) -> DataFrame:
    """The members of larger nodes in blocks of some SMALL / 2, each in one; small nodes as they are."""
    block = F.pmod(F.xxhash64(F.lit("home"), "path", "rep"), F.ceil(F.col("count") * 2 / SMALL))
    home = F.when(F.col("count").isNull(), F.col("path")).otherwise(F.xxhash64("path", block))
    return rows.withColumn("path", home).select(*MEMBER)


def _children(rows: DataFrame, minima: DataFrame) -> DataFrame:
    """Members of split nodes with the paths of the children that they go on to."""
    choice = F.xxhash64(F.lit("child"), "path")
    first = F.pmod(choice, F.lit(VALUES))
    second = F.pmod(first + 1 + F.pmod(F.shiftright(choice, 20), F.lit(VALUES - 1)), F.lit(VALUES))
    both = F.pmod(F.shiftright(choice, 40), F.lit(3)) == 0
    child = F.explode(F.when(both, F.array(first, second)).otherwise(F.array(first)))
    split = rows.select(*MEMBER, child.alias("child")).join(minima, "rep")
    value = F.element_at("minima", (F.col("child") + 1).cast("int"))
    return split.select(F.xxhash64("path", "child", value).alias("path"), *MEMBER[1:])


def _blocks(rows: DataFrame) -> DataFrame:
    """Large nodes as smaller ones in which any two members of different components meet.

    Members of the node's main component stay in one block each. The other members join each of these blocks, and meet one
    another in pairs of blocks.
    """
    aside = F.col("component") != F.col("main")
    main_blocks = F.ceil((F.col("count") - F.col("others")) / BLOCK)
    side_blocks = F.ceil(F.col("others") * 2 / BLOCK)
    spread = F.xxhash64(F.lit("block"), "rep")
    own = F.pmod(spread, side_blocks)
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    with_main = F.transform(upto(main_blocks), lambda j: F.struct(F.lit("m").alias("k"), j.alias("i"), F.lit(0).cast("long").alias("j")))
    with_side = F.transform(
        upto(side_blocks), lambda j: F.struct(F.lit("s").alias("k"), F.least(own, j).alias("i"), F.greatest(own, j).alias("j"))
    )
    one = F.array(F.struct(F.lit("m").alias("k"), F.pmod(spread, main_blocks).alias("i"), F.lit(0).cast("long").alias("j")))
    whole = F.array(F.struct(F.lit("w").alias("k"), F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))
    places = F.when(F.col("count") <= BLOCK, whole).when(aside, F.concat(with_main, with_side)).otherwise(one)
    placed = rows.withColumn("block", F.explode(places))
    return placed.withColumn("path", F.xxhash64("path", "block"))


def confirm(pairs: DataFrame, texts: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs whose full shingle sets have at least `percent` of their union in common."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            size = pc.add(pc.binary_length(whole["text_a"]), pc.binary_length(whole["text_b"])).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size.astype(np.int64))
            start = 0
            while start < whole.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
                batch = whole.slice(start, stop - start)
                start = stop
                keys, counts = [], []
                for side in ("text_a", "text_b"):
                    hashes, owner, n = shingles(batch[side], k)
                    keys.append(mixed(owner.astype(np.uint64) + np.uint64(1)) ^ hashes)
                    counts.append(np.bincount(owner, minlength=n))
                    if side == "text_a":
                        own = owner
                _, at, _ = np.intersect1d(*keys, assume_unique=True, return_indices=True)
                common = np.bincount(own[at], minlength=batch.num_rows)
                linked = 100 * common >= percent * (counts[0] + counts[1] - common)
                yield batch.select(["a", "b"]).filter(pa.array(linked & (common > 0)))

    left = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
    return left.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b").select(
        "a", "b", "text_a", "text_b"
    ).mapInArrow(check, PAIR)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable over links) and kept (that is the document itself)."""
    spark = documents.sparkSession
    folder = new_folder(spark, "near-dup")
    rows = profiles(documents.withColumn("doc_id", F.col("doc_id").cast("long")))
    rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/profiles")
    known = spark.read.parquet(f"{folder}/profiles")
    # Rows without an id get one above all others.
    top = known.agg(F.max("doc_id")).first()[0] or 0
    known = known.withColumn("key", F.coalesce("doc_id", F.col("row") + F.lit(max(top, 0) + 1)))
    name = ["n_shingles", "set_lo", "set_hi"]
    # Rows with equal sets have equal sketches and minima.
    classes = known.where("n_shingles > 0").groupBy(*name).agg(
        F.min("key").alias("rep"), *[F.any_value(c).alias(c) for c in (*SKETCH, "minima")]
    )
    classes.write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")
    own = documents.select(F.col("doc_id").cast("long").alias("rep"), "text").where("rep is not null")
    lost = known.where("doc_id is null").select(F.col("key").alias("rep"), "text")
    reps = classes.select("rep", F.col("n_shingles").alias("size"), *SKETCH, "minima")
    found = Search(reps, own.unionByName(lost), folder).run()

    group = classes.select(*name, "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    group = group.select(*name, F.coalesce("component", "rep").alias("component"))
    group.write.parquet(f"{folder}/groups")
    joined = known.select("doc_id", "key", *name).join(spark.read.parquet(f"{folder}/groups"), name, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("key"))
    shown = F.when(component <= max(top, 0), component).alias("component_id")
    return joined.select("doc_id", "n_shingles", shown, (F.col("key") == component).alias("kept"))
