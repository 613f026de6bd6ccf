"""Greedy tiling against a plain one, and its growth with a repeated word."""

import random
import time

import brute
import pytest
from innledger.llm import decontaminate


def by_words(df):
    return {(r.doc_id, r.item_id): (r.n_words, r.covered, [tuple(t) for t in r.tiles]) for r in df.collect()}


@pytest.mark.parametrize("k", [3, 5])
def test_equals_a_plain_tiling(spark, k):
    rnd = random.Random(31)
    docs, items = [], []
    for i in range(60):
        letters = "ab" if i % 3 == 0 else "abcd" if i % 3 == 1 else "abcdefghijkl"
        items.append((i, " ".join(rnd.choice(letters) for _ in range(rnd.randint(k, 40)))))
        parts = items[-1][1].split(" ")
        cut = rnd.randint(0, len(parts))
        noise = [rnd.choice(letters) for _ in range(rnd.randint(0, 30))]
        docs.append((i, " ".join(noise + parts[cut:] + noise[:3] + parts[:cut])))
    docs += [(100, None), (101, ""), (102, "a " * 70), docs[3]]
    items += [(100, "a " * 30), (101, None)]
    found = by_words(decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=k,
    ))
    want = {}
    for d, text in set(docs):
        for i, item in items:
            words = (item or "").split()
            tiles = brute.greedy_tiles((text or "").split(), words, k) if words else []
            covered = sum(n for _, _, n in tiles)
            if words and covered * 2 >= len(words):
                want[d, i] = (len(words), covered, tiles)
    assert found == want and len(want) > 100


def test_a_repeated_word_costs_its_places(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, "word " * n + "end")], "doc_id long, text string")
        items = spark.createDataFrame([(1, "word " * (n // 4))], "item_id long, text string")
        start = time.monotonic()
        assert by_words(decontaminate.leaks(docs, items)) == {(1, 1): (n // 4, n // 4, [(0, 0, n // 4)])}
        return time.monotonic() - start

    seconds(1000)
    assert seconds(256_000) < 8 * seconds(32_000) + 2


def test_texts_that_share_an_id_and_names_that_clash(spark):
    item = "one two three four five six seven eight"
    docs = [(1, "nothing at all in here", 1, 2, 3), (1, f"{item} and more", 1, 2, 3), (None, item, 0, 0, 0), (None, "other", 0, 0, 0)]
    schema = "doc_id long, text string, pos int, hash int, at int"
    got = by_words(decontaminate.leaks(spark.createDataFrame(docs, schema), spark.createDataFrame([(7, item, 5)], "item_id long, text string, hash int")))
    assert got == {(1, 7): (8, 8, [(0, 0, 8)]), (None, 7): (8, 8, [(0, 0, 8)])}


def test_table_grows_with_the_seeds():
    assert decontaminate.table_bits(0) == 24 and decontaminate.table_bits(1 << 18) == 26 and decontaminate.table_bits(1 << 40) == 28
