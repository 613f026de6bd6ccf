"""Identifiers that only their context gives away, against a plain bootstrap over the same graph."""

import math
from collections import defaultdict

import pytest

from innledger.llm import pii


def context_spans(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.personal_data(frame).collect()
    found = {}
    for r in rows:
        spans = [s for s in r.spans.split(",") if s.startswith("context_")]
        assert r.n_context == len(spans)
        if spans:
            kind, start, end = spans[0].split(":")
            found[r.doc_id] = (kind, texts[r.doc_id][int(start) : int(end)])
    return found


@pytest.mark.parametrize(("seeds", "unseen"), [(5, 3), (30, 10), (30, 30), (30, 90)])
def test_a_pattern_finds_more_than_it_has_seeds(spark, seeds, unseen):
    texts = [f"please contact mail: user{i}x@mail.test for more" for i in range(seeds)]
    texts += [f"please contact mail: user{i}[at]mail.test for more" for i in range(unseen)]
    texts += [f"the part number AB-{i}42 is in stock" for i in range(40)]
    found = context_spans(spark, texts)
    assert found == {seeds + i: ("context_email", f"user{i}[at]mail.test") for i in range(unseen)}


def two_rounds():
    """A pattern with seeds names eight instances; these admit a pattern without seeds, which names one more."""
    texts = [f"call me at +43 555 0{i}12 3456 now" for i in range(6)]
    texts += [f"call me at 0043-555-77{i}1 now" for i in range(8)]
    texts += [f"ring the office under 0043-555-77{i}1 today" for i in range(8)]
    texts += ["ring the office under 0043-555-9999 today"]
    return texts


def test_known_instances_admit_new_patterns(spark):
    found = context_spans(spark, two_rounds())
    assert found[22] == ("context_phone", "0043-555-9999")
    assert len(found) == 17


def test_contradicting_kinds_are_not_trusted(spark):
    texts = [f"send it to user{i}@mail.test now" for i in range(8)] + [f"send it to 10.0.0.{i} now" for i in range(8)]
    texts += [f"send it to node-{i}77 now" for i in range(4)]
    texts += [f"see also item {i}000x here" for i in range(60)] + [f"see also item me{i}@mail.test here" for i in range(2)]
    found = context_spans(spark, texts)
    # Two kinds with equal weight: the pattern belongs to one by less than it needs, or to none.
    assert not any(v[1].endswith("000x") for v in found.values())


def test_context_goes_past_a_neighbouring_token(spark):
    texts = [f"line {i} contact: user{i}x@mail.test end" for i in range(9)]
    texts += [f"line {i} contact: user{i}[at]mail.test end" for i in range(5)]
    assert len(context_spans(spark, texts)) == 5


def plain_bootstrap(graph):
    """known instances after all rounds, from (pattern, kind, instance) -> count."""
    by_pattern = defaultdict(list)
    for (pattern, kind, instance), count in graph.items():
        by_pattern[pattern].append((kind, instance, math.log1p(count)))
    by_pattern = {p: rows for p, rows in by_pattern.items() if len({i for _, i, _ in rows}) >= pii.FEWEST_SEEDS}
    known = {}
    for _ in range(pii.ROUNDS):
        beliefs = defaultdict(lambda: 1.0)
        for rows in by_pattern.values():
            support, n, total = defaultdict(float), defaultdict(int), 0.0
            for kind, instance, weight in rows:
                label, trust = (kind, 1.0) if kind != "token" else known.get(instance, (None, pii.UNDECIDED))
                total += weight * trust
                if label:
                    support[label] += weight * trust
                    n[label] += 1
            if support:
                own = max(support, key=lambda k: (support[k], k))
                p = support[own] / total
                if n[own] >= pii.FEWEST_SEEDS and p >= pii.PATTERN_SCORE:
                    for kind, instance, _ in rows:
                        if kind == "token":
                            beliefs[instance, own] *= max(1 - p, 1e-6)
        known = {}
        for (instance, kind), doubt in beliefs.items():
            if 1 - doubt >= pii.INSTANCE_SCORE:
                known[instance] = max(known.get(instance, ("", 0.0)), (kind, 1 - doubt), key=lambda b: (b[1], b[0]))
    return known


def test_plain_bootstrap_agrees(spark, tmp_path):
    frame = spark.createDataFrame(list(enumerate(two_rounds())), "doc_id long, text string")
    pii_folder = []
    original = pii.new_folder
    try:
        pii.new_folder = lambda *a: pii_folder.append(str(tmp_path / "pii")) or pii_folder[-1]
        pii.personal_data(frame).count()
    finally:
        pii.new_folder = original
    graph = {(r.pattern, r.kind, r.instance): r["count"] for r in spark.read.parquet(f"{pii_folder[0]}/graph").collect()}
    want = plain_bootstrap(graph)
    got = {
        r.instance: (r.as_kind, r.score) for r in spark.read.parquet(f"{pii_folder[0]}/known{pii.ROUNDS - 1}").collect()
    }
    assert got.keys() == want.keys() and len(got) == 9
    for instance, (kind, score) in got.items():
        assert kind == want[instance][0] and math.isclose(score, want[instance][1], rel_tol=1e-9)
