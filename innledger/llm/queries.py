"""Queries of the training-data operators by name, each over its whole table, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.llm.codes import vector_codes
from innledger.llm.decontaminate import leaks
from innledger.llm.langid import predict, train
from innledger.llm.line_dedup import dedup_lines
from innledger.llm.near_dup import near_duplicates
from innledger.llm.packing import pack
from innledger.llm.phrases import collocations
from innledger.llm.piece_sampling import sampled_round_trip
from innledger.llm.pii import personal_data
from innledger.llm.quality import quality_rules
from innledger.llm.token_counts import token_counts
from innledger.llm.token_file import read_tokens, write_tokens
from innledger.llm.warc import read_archive, write_archive
from innledger.session import new_folder

BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents"))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archive")
    write_archive(_table(spark, sf_dir, "pages"), folder)
    return read_archive(spark, folder)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "covered", F.size("tiles").alias("n_tiles"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return predict(documents, train(documents)).drop("spans")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), folder)
    return read_tokens(spark, folder)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).drop("distance")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "removed")


def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_FILE))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "sequences")
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), folder)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), new_folder(spark, "phrases"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_personal_data,
        op2_warc_archive,
        op3_benchmark_decontamination,
        op4_language_id,
        op5_token_counts,
        op6_token_file,
        op7_quality_rules,
        op8_line_dedup,
        op9_piece_sampling,
        op10_minhash_near_dedup,
        op11_best_fit_packing,
        op12_phrase_collocations,
        op13_vector_codes,
    )
}
ORACLES: dict[str, str] = {
    "op2_warc_archive": """
        with p as (select page_id, encode(coalesce(html, '')) as body from pages),
        d as (select page_id, octet_length(body) as n, sha256(body) as h from p),
        f as (select *, min(page_id) over (partition by h) as first_id from d)
        select page_id, n as payload_bytes, h as payload_digest,
          case when n >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
          case when n >= 100 and page_id <> first_id then first_id end as refers_to
        from f""",
    "op12_phrase_collocations": r"""
        with s as (select coalesce(lang, 'und') as lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
        p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\f\r]')) as piece from s),
        w as (select lang, regexp_extract_all(piece, '[^ \t]+') as ws from p),
        n as (select lang, sum(len(ws))::bigint as n from w group by lang),
        g as (select lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
            lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase from w, range(1, 5) r(k)),
        f as (select lang, k, phrase, string_split(phrase, ' ') as ws, count(*) as a from g group by all having count(*) >= 30),
        c as (select lang, k, phrase, a, cut, array_to_string(ws[:cut], ' ') as x, array_to_string(ws[cut + 1:], ' ') as y
            from f, range(1, 4) q(cut) where cut < k),
        j as (select c.lang, c.phrase, c.a, c.cut, l.a as l, r.a as r, (2000000::hugeint * c.a) // (l.a + r.a) as score
            from c join f l on l.lang = c.lang and l.phrase = c.x join f r on r.lang = c.lang and r.phrase = c.y),
        m as (select * from j qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
        h as (select lang, array_to_string(ws[i:i + b - 1], ' ') as phrase, max(a) as longer
            from f, range(1, 4) u(i), range(2, 4) v(b) where b < k and i + b - 1 <= k group by all),
        o as (select m.* from m left join h using (lang, phrase)
            where longer is null or 100::hugeint * longer < 80::hugeint * a)
        select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank,
          phrase, a, l, r, n, score::bigint as score
        from o join n using (lang) qualify rank <= 2000""",
}
