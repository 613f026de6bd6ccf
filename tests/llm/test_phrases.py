"""Phrase collocations against plain counting, with fingerprints of full and of few bits."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from helpers import duck_table, sample_dir, spark_table

from innledger.llm import phrases
from innledger.llm.queries import ORACLES, op12_phrase_collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top, least):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= least}
        longer = Counter()
        for p, a in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        found = []
        for p, a in frequent.items():
            if len(p) > 1 and 100 * longer[p] < 80 * a:
                cuts = [(counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made_up(n):
    rng = random.Random(5)
    words = ["the", "The", "of", "new", "york", "city", "hall", "é", "漢字", "a.b", "x" * 40, "tab\tbed", "  ", "-", " "]
    ends = [" ", " ", " ", " ", "\t", ", ", ". ", "\n", "\r\n", "\x0b", "! ", "  "]
    rows = []
    for _ in range(n):
        pick = [(rng.choices(words, weights=range(15, 0, -1))[0], rng.choice(ends)) for _ in range(rng.randint(0, 80))]
        text = "".join(w + e for w, e in pick) + rng.choice(["", "new york city hall"])
        rows.append((rng.choice(["en", "fr", "und", None]), text))
    return rows + [("en", None), (None, ""), ("en", "in the city " * 3000)] + [("fr", "same row again. same row")] * 40


@pytest.mark.parametrize(("mask", "top"), [(-1, 2000), (0xFF, 2000), (-1, 7)])
def test_plain_counting(spark, tmp_path, mask, top):
    rows = made_up(300)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string")
    docs = docs.repartition(5)
    found = phrases.collocations(docs, str(tmp_path), top=top, least=8, mask=mask)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, top, 8)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs, str(tmp_path)).count() == 0


def test_runs_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(phrases, "RUN_GRAMS", 50)
    docs = spark.createDataFrame([("en", "one two three")] * 90, "lang string, text string").coalesce(1)
    rows = phrases.frequent_phrases(docs, str(tmp_path))[0].collect()
    assert {(r.phrase, r.f) for r in rows} == {
        (p, 90) for p in ("one", "two", "three", "one two", "two three", "one two three")
    }


def test_scores_pass_64_bits(spark):
    a = 9 * 10**15
    row = spark.createDataFrame([(a, a + 1, a + 2)], "a long, l long, r long").selectExpr(
        f"cast({phrases.SCALE} * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + r) as long) as score"
    )
    assert row.first().score == phrases.SCALE * a // (2 * a + 3)


def test_bits_let_every_key_through(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    table = phrases.bit_table(spark.createDataFrame([(int(k),) for k in keys], "k long"))
    assert table.has(keys).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 100_000)
    assert table.has(others).mean() < 0.02


def test_sample_table(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as from '{sample_dir('0.001')}/documents.parquet'")
    want = duck_table(con, ORACLES["op12_phrase_collocations"])
    assert spark_table(op12_phrase_collocations(spark, sample_dir("0.001"))) == want
