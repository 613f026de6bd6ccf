"""The archive read back from rebuilt records, on odd tables."""

import hashlib
from collections import Counter

import pytest

from innledger.llm import warc


def want(rows):
    firsts = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if body not in firsts or page is not None and (firsts[body] is None or page < firsts[body]):
            firsts[body] = page
    out = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        revisit = len(body) >= 100 and page != firsts[body]
        kind = "revisit" if revisit else "response"
        out[page, len(body), hashlib.sha256(body).hexdigest(), kind, firsts[body] if revisit else None] += 1
    return out


def check(spark, folder, rows):
    layout = "page_id long, url string, html string, digest string, header string, record string"
    pages = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], layout)
    warc.write_archive(pages, folder)
    found = warc.read_archive(spark, folder).collect()
    assert Counter(tuple(r) for r in found) == want(rows)


def test_odd_pages(spark, tmp_path):
    long, other = "<p>é漢字</p>" * 40, "\r\n\r\nWARC-Type: revisit\r\n\r\n" * 9
    rows = [(3, "http://a/ü", long), (1, "http://a", long), (2, None, long), (4, "u", None), (5, "u", ""), (6, "u", "tiny")]
    rows += [(7, "u", "tiny"), (8, "u", other), (9, "u", other), (9, "u", other), (10, "u", "x" * 2_000_000), (-5, "u", "y" * 100)]
    check(spark, str(tmp_path), rows)


def test_empty_table(spark, tmp_path):
    check(spark, str(tmp_path), [])


def test_changed_payload_is_refused(spark, tmp_path):
    folder = str(tmp_path / "a")
    warc.write_archive(spark.createDataFrame([(1, "u", "z" * 200)], "page_id long, url string, html string"), folder)
    stored = spark.read.parquet(f"{folder}/payloads")
    changed = stored.selectExpr("digest", "cast('other' as binary) as payload").collect()
    spark.createDataFrame(changed, stored.schema).write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, folder).collect()
