"""Token files: one table of ranks for all blocks, rows that share an id or have none, the empty table."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from innledger.llm import token_file

BPE = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(BPE)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, token_file.END_ID]


def test_ranks_and_places_over_all_rows(spark, tmp_path):
    texts = ["one two two", "", None, "gr\u00fcn \u4e2d\u6587 <|endoftext|> x", "two " * 700]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, "same")] * 40 + [(7, f"other {i}") for i in range(20)] + [(None, "lost"), (None, None)]
    docs = spark.createDataFrame([(i, t, b"x", 1) for i, t in rows], "doc_id long, text string, ids binary, task int").repartition(5)
    token_file.write_tokens(docs, BPE, str(tmp_path / "f"))
    uses = Counter(x for _, t in rows for x in ids_of(t))
    assert token_file.id_table(spark, str(tmp_path / "f")).tolist() == sorted(uses, key=lambda x: (-uses[x], x))
    got = token_file.read_tokens(spark, str(tmp_path / "f")).orderBy("start").collect()
    want = Counter((i, len(ids_of(t)), zlib.crc32(np.array(ids_of(t), "<u4").tobytes())) for i, t in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for row in got:
        assert row.start == at
        at += row.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    read = token_file.read_ids(spark, str(tmp_path / "f")).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in read) == Counter((i, tuple(ids_of(t))) for i, t in rows)


def test_one_id_is_dealt_over_ranges(spark, tmp_path):
    docs = spark.range(0, 4000, 1, 4).selectExpr("cast(5 as long) doc_id", "if(id < 2000, 'same text', concat('text ', id)) text")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        token_file.write_tokens(docs, BPE, str(tmp_path / "f"))
    finally:
        spark.conf.set(merge, before)
    blocks = spark.read.schema(token_file.BLOCK).parquet(str(tmp_path / "f/blocks"))
    assert blocks.select("part").distinct().count() > 1
    got = token_file.read_tokens(spark, str(tmp_path / "f"))
    assert got.count() == 4000 and got.select("start").distinct().count() == 4000


def test_empty_table(spark, tmp_path):
    token_file.write_tokens(spark.createDataFrame([], "doc_id long, text string"), BPE, str(tmp_path / "f"))
    assert token_file.read_tokens(spark, str(tmp_path / "f")).collect() == []
    assert token_file.read_ids(spark, str(tmp_path / "f")).collect() == []
