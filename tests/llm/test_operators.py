"""Each operator against a plain definition, on odd rows: nulls, empty and long texts, ties, repeated rows, empty tables."""

import hashlib
import random
import zlib

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry_points
from innledger.llm import decontaminate, langid, line_dedup, near_dup, pii, piece_sampling, quality, token_counts, token_file, warc
from innledger.llm.queries import ORACLES, QUERIES

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, removed string, path long, hash string"


def texts():
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "The", "of", "and", "étude", "日本", "x1"]

    def prose(n):
        return " ".join(rnd.choice(words) + str(rnd.randint(0, 99)) * (rnd.random() < 0.2) for _ in range(n))

    base = prose(120)
    near = base.replace("gamma", "omega", 2)
    passage = prose(60)
    odd = [
        None, "", " ", "\n\n", "\t \n", "a", "one two three", "A  b c \x1c d", "<|endoftext|> x <|endoftext|>", "▁ ▁▁ 😀\r\n",
        "mail a@b.co, ip 1.2.3.4 or 1.2.3.400, x@y.z@w.v.u call +49 (30) 1234567 card 4111 1111 1111 1111 4111-1111-1111-1112",
        "9" * 3000, "a" * 20000 + "@", "1.2.3.4.5.6.7.8 +1234567 +12345678 ++1 2", "same line\nsame line\n\nsame line",
        base, base, near, prose(700), f"{prose(9)}\n{passage}\n{prose(5)}", f"{prose(7)}\n{passage}", "short " * 60, "# $ % " * 40,
        "\n".join(["tick tock"] * 80),
    ]
    return list(enumerate(odd))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "de", "s", 0, "r", 1, "h") for i, t in texts()]
    return spark.createDataFrame([*rows, rows[10]], SCHEMA)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


def test_personal_data(docs):
    found = pii.personal_data(docs)
    assert found.count() == docs.count()
    got = by_id(found, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for i, t in texts():
        spans = brute.base_spans(t)
        counts = tuple(sum(s.startswith(k + ":") for s in spans) for k in brute.KINDS)
        joined = ",".join(spans)
        assert got[i][:5] == (*counts, hashlib.sha256(joined.encode()).hexdigest()), (i, got[i], spans)
        assert got[i][5].startswith(joined)


def test_contexts_discover_identifiers(spark):
    seeds = [(i, f"word{i} text staff contact: user{i}@mail{i}.org thanks a lot") for i in range(30)]
    hidden = [(100 + i, f"other{i} text staff contact: user{i}[at]mail-{i} thanks a lot") for i in range(5)]
    clean = [(200 + i, f"version 2.{i}.10-beta{i} of the tool w{i}") for i in range(5)]
    got = by_id(pii.personal_data(spark.createDataFrame([*seeds, *hidden, *clean], "doc_id long, text string")), "spans")
    text = dict(hidden)[103]
    at = text.index("user3")
    assert got[103] == (f"context_email:{at}:{text.index(' thanks')}",)
    assert all(got[200 + i] == ("",) for i in range(5))


def test_archive(spark, tmp_path):
    page = "x" * 120
    rows = [(3, "u", page), (1, "u\r\nv", page), (7, None, page), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (None, "u", page), (9, "u", "a\r\n\r\nb" * 40)]
    folder = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    got = {r.page_id: r for r in warc.read_archive(spark, folder).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("response", None), 3: ("revisit", 1), 7: ("revisit", 1), None: ("revisit", 1),
        4: ("response", None), 5: ("response", None), 6: ("response", None), 9: ("response", None),
    }
    for i, _, html in rows:
        body = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
    records = {r.page_id: bytes(r.record) for r in warc.read_records(spark, folder).collect()}
    head, body = records[9].split(b"\r\n\r\n", 1)
    assert body == ("a\r\n\r\nb" * 40).encode() + b"\r\n\r\n" and b"Content-Length: 240" in head
    assert records[3].endswith(b"Content-Length: 0\r\n\r\n\r\n\r\n") and records[1].count(b"\r\n") + 2 == records[3].count(b"\r\n")
    warc.export_warc(spark, folder, str(tmp_path / "files"))
    assert spark.read.option("wholetext", True).text(str(tmp_path / "files")).where("value like '%WARC/1.1%'").count() > 0


def test_passages(spark):
    rnd = random.Random(5)
    item = [f"w{rnd.randint(0, 999)}" for _ in range(30)]
    other = [f"v{rnd.randint(0, 999)}" for _ in range(40)]
    shuffled = item[15:] + ["and"] + item[:15]
    rows = [(1, " ".join(other + item + other)), (2, " ".join(other + shuffled)), (3, " ".join(item[:9] + other)), (4, None), (5, ""), (6, " ".join(item).upper())]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too few words"), (4, "")], "item_id long, text string")
    documents = spark.createDataFrame(rows + rows[:1], "doc_id long, text string")
    found = {r.doc_id: r for r in decontaminate.leaks(documents, benchmark).collect()}
    assert sorted(found) == [1, 2, 6]
    assert (found[2].covered, len(found[2].tiles)) == (30, 2) and found[1].tiles[0].words == 30
    assert decontaminate.leaks(documents.limit(0), benchmark).count() == 0
    assert decontaminate.leaks(documents, benchmark.limit(0)).count() == 0
    # The longest match goes first, and no word is used twice.
    assert decontaminate.tile(np.array([0, 1, 2, 50]), np.array([10, 11, 12, 13]), np.array([0, 1, 2, 3]), np.array([10, 11, 12, 13])) == [(0, 0, 7)]


def test_every_benchmark_text_is_searched(spark):
    rnd = random.Random(15)
    text = lambda n: " ".join(f"w{rnd.randint(0, 99999)}" for _ in range(n))
    a, b, c, d, filler = text(20), text(30), text(20), text(25), text(40)
    chinese = "".join(chr(0x4E00 + rnd.randint(0, 5000)) for _ in range(30))
    items = [(1, a), (1, b), (1, b), (None, c), (None, d), (2, "Three short words"), (3, chinese), (4, chinese[:3]), (5, "")]
    rows = [(10, f"{filler} {a}"), (11, f"{b} {filler}"), (12, c), (13, d), (14, f"{filler} three SHORT words, three short words"),
            (15, f"{filler}{chinese[2:]}"), (16, filler), (17, "three other short words"), (18, f"{a} {b}"), (19, chinese[:3])]
    found = decontaminate.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = {(r.doc_id, r.item_id): (r.n_words, r.covered) for r in found}
    assert len(found) == len(got)
    assert got == {
        (10, 1): (20, 20), (11, 1): (30, 30), (12, None): (20, 20), (13, None): (25, 25), (14, 2): (3, 3),
        (15, 3): (30, 28), (18, 1): (30, 30), (19, 4): (3, 3),
    }


def test_language(spark):
    rnd = random.Random(2)
    en, de = ["the", "house", "with", "thing", "this", "which"], ["das", "haus", "mit", "nicht", "dieses", "schön"]
    make = lambda ws, n: " ".join(rnd.choice(ws) for _ in range(n))
    rows = [(i, make(en if i % 2 else de, 30), "en" if i % 2 else "de") for i in range(300)]
    odd = [(1000, None, "en"), (1001, "", None), (1002, "12 ½ %%", "de"), (None, make(en, 20), "en"), (1003, make(de, 30) + " " + make(en, 30), None)]
    documents = spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string")
    got = by_id(langid.predict(documents, langid.train(documents)), "lang_pred", "score", "held_out", "spans")
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i][2] == (i in held) for i, _, _ in rows)
    assert sum(got[i][0] == lang for i, _, lang in rows) == 300
    assert [got[i][:2] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3 and got[None][:1] == ("en",)
    assert [s.lang for s in got[1003][3]] == ["de", "en"] and abs(got[1003][3][0].words - 30) <= 2
    nothing = langid.predict(documents, langid.train(documents.limit(0)))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_what_reaches_the_driver_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    rows = [(i, f"{w} {w} house {i % 7}", w) for i in range(60) for w in ("en", "de")]
    junk = [(1000 + i, f"junk {i}", f"label{i}") for i in range(40)]
    copies = [(7001, "one row many times", "en")] * 3000
    seen = []
    fit = langid.fit
    monkeypatch.setattr(langid, "fit", lambda samples: (seen.append(samples), fit(samples))[1])
    model = langid.train(spark.createDataFrame(rows + junk + copies, "doc_id long, text string, lang string"))
    assert sorted(model.languages) == ["de", "en"] and len(seen[0]) <= 2 * langid.SAMPLE_DOCS
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.predict(empty, model).count() == 0


def test_every_letter_of_a_long_run_is_read(spark):
    rnd = random.Random(6)
    en, de = ["the", "house", "with", "thing", "this", "which"], ["das", "haus", "mit", "nicht", "dieses", "schön"]
    make = lambda ws, n: "".join(rnd.choice(ws) for _ in range(n))
    rows = [(i, make(en if i % 2 else de, 300), "en" if i % 2 else "de") for i in range(300)]
    head = make(en, 20)[:40]
    odd = [(1000, head + make(en, 300), None), (1001, head + make(de, 300), None), (1002, make(de, 400) + make(en, 400), None)]
    documents = spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string")
    got = by_id(langid.predict(documents, langid.train(documents)), "lang_pred", "spans")
    assert [got[i][0] for i in (1000, 1001)] == ["en", "de"]
    assert [s.lang for s in got[1002][1]] == ["de", "en"]
    assert sum(s.words for s in got[1002][1]) == -(-len(odd[2][1]) // 40)
    assert langid.words_of("x" * 95 + " y") == ["x" * 40, "x" * 40, "x" * 15, "y"]


def test_chain_equals_plain_recursion():
    rng = np.random.default_rng(1)
    e, step, first = rng.random((700, 3)) + 0.01, rng.random((3, 3)), rng.random(3)
    restart = rng.random(700) < 0.01
    got = langid.chain(e, restart, step, first)
    now = first
    for t in range(700):
        now = (first if restart[t] else now @ step) * e[t]
        now = now / now.sum()
        assert np.allclose(now, got[t])


def test_tokens(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(BPE).encode
    want = {i: encode(t or "", add_special_tokens=False).ids for i, t in texts()}
    counts = by_id(token_counts.token_counts(docs, BPE), "n_bytes", "n_tokens", "over_limit")
    assert counts == {i: (len((t or "").encode()), len(want[i]), len(want[i]) > 512) for i, t in texts()}
    folder = str(tmp_path / "tokens")
    token_file.write_tokens(docs.dropDuplicates(["doc_id"]), BPE, folder)
    at = 0
    got = by_id(token_file.read_tokens(spark, folder), "start", "n_tokens", "ids_crc32")
    for i, _ in texts():
        ids = [*want[i], 0]
        assert got[i] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert by_id(token_file.read_ids(spark, folder), "ids") == {i: ([*want[i], 0],) for i, _ in texts()}
    values = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], np.uint32)
    assert token_file.unpack(*token_file.pack(values), 7).tolist() == values.tolist()


def test_quality(docs):
    got = by_id(quality.quality_rules(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for i, t in texts():
        want = brute.quality(t)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i] == (*want, failed, not failed), i


def test_outliers_of_a_large_group_go(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    good = [(i, " ".join(word() for _ in range(rnd.randint(60, 200))), "en", None) for i in range(600)]
    junk = [(1000 + i, " ".join(word() + "#$%" * 2 for _ in range(100)), "en", None) for i in range(150)]
    few = [(2000, " ".join(word() * 5 for _ in range(100)), None, "rare")]
    got = by_id(quality.quality_rules(spark.createDataFrame([*good, *junk, *few], "doc_id long, text string, lang string, source string")), "kept")
    assert sum(got[i][0] for i in range(600)) >= 597 and not any(got[1000 + i][0] for i in range(150)) and got[2000][0]


def test_rare_groups_are_judged(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    prose = lambda: " ".join(word() for _ in range(rnd.randint(60, 200)))
    symbols = lambda: " ".join(word() + "#$%" * 2 for _ in range(100))
    lines = lambda: prose() + "\n" + "\n".join(["tick tock"] * 30)
    long = lambda: " ".join(word() * 5 for _ in range(100))
    big = [(i, prose(), "en" if i % 2 else "de", "big") for i in range(600)]
    clean = [(1000, prose(), "xx", "big"), (1001, prose(), None, None), (1002, prose(), "en", "small"), (1003, long(), "xx", "other")]
    junk = [(2000, symbols(), "xx", "big"), (2001, lines(), None, None), (2002, symbols(), "en", "small"), (2003, long(), "en", "small")]
    schema = "doc_id long, text string, lang string, source string"
    got = by_id(quality.quality_rules(spark.createDataFrame([*big, *clean, *junk], schema)), "kept")
    assert sum(got[i][0] for i in range(600)) >= 597
    assert all(got[i][0] for i, *_ in clean) and not any(got[i][0] for i, *_ in junk)
    few = [(i, prose(), "en", f"s{i % 9}") for i in range(60)]
    got = by_id(quality.quality_rules(spark.createDataFrame([*few, (100, symbols(), "en", "s1"), (101, lines(), None, "s2")], schema)), "kept")
    assert sum(got[i][0] for i in range(60)) >= 59 and not got[100][0] and not got[101][0]


def test_line_runs(docs):
    got = by_id(line_dedup.dedup_lines(docs.drop("removed")), "text", "removed")
    gone = brute.removed(texts())
    for i, t in texts():
        assert set(got[i][1]) == gone.get(i, set()), i
        kept = t if i not in gone else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])
        assert got[i][0] == kept
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_sampled_pieces(docs):
    got = by_id(piece_sampling.sampled_round_trip(docs, PIECES), "n_pieces", "ids_crc32", "lossless")
    assert all(r[2] for r in got.values())
    assert by_id(piece_sampling.sampled_round_trip(docs.repartition(5), PIECES), "n_pieces", "ids_crc32", "lossless") == got
    again = by_id(piece_sampling.sampled_round_trip(docs, PIECES, seed=1), "ids_crc32")
    assert again[18] != got[18][1:2]
    back = by_id(piece_sampling.decode_pieces(piece_sampling.encode_pieces(docs, PIECES), PIECES), "text")
    assert back == {i: (t or "",) for i, t in texts()}


def test_pieces_are_found_in_short_buckets():
    words = piece_sampling.vocabulary(PIECES)
    n = len(words.hashes)
    assert (words.find(words.hashes) == np.arange(n)).all()
    absent = np.setdiff1d(words.hashes + np.uint64(1), words.hashes)
    assert (words.find(absent) == -1).all() and len(words.find(absent[:0])) == 0
    assert np.diff(words.bucket_first).max() < 16 and words.bucket_first[-1] == n


def test_segmentations_come_in_proportion():
    own = piece_sampling.Sampler(PIECES)
    weights = own.words.weights

    def ways(text):
        if not text:
            yield (), 1.0
        for n in range(1, len(text) + 1):
            if text[:n] in weights:
                for rest, w in ways(text[n:]):
                    yield (weights[text[:n]][1], *rest), w * weights[text[:n]][0]

    want = dict(ways(" there"))
    ids, counts = own.sample(list(range(50_000)), ["there"] * 50_000)
    ends = np.cumsum(counts)
    drawn = [tuple(ids[e - n : e].tolist()) for e, n in zip(ends, counts, strict=True)]
    for way, w in want.items():
        assert abs(drawn.count(way) / 50_000 - w / sum(want.values())) < 0.01


def test_near_groups(docs, spark):
    got = by_id(near_dup.near_duplicates(docs), "n_shingles", "component_id", "kept")
    assert got == {i: (n, c, i == c) for i, (n, c) in brute.near_groups(texts()).items()}
    rnd = random.Random(9)
    base = [f"t{rnd.randint(0, 5000)}" for _ in range(300)]
    rows = []
    for i in range(400):  # one large group of near copies
        words = list(base)
        for _ in range(rnd.randint(0, 14)):
            words[rnd.randrange(300)] = f"n{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(40))) for i in range(30)]
    got = by_id(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "n_shingles", "component_id")
    want = brute.near_groups(rows)
    assert sum(got[i] == want[i] for i in want) >= len(want) - 2
    nobody = spark.createDataFrame([(None, "a b c d e f g"), (None, None)], "doc_id long, text string")
    assert near_dup.near_duplicates(nobody).count() == 2 and near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_no_pair_at_the_threshold_is_lost(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(0, 2400, 2):  # 60 of 80 shingles in common
        words = [f"w{rnd.randint(0, 10**9)}" for _ in range(84)]
        rows += [(i, " ".join(words[:74])), (i + 1, " ".join(words[:64] + words[74:]))]
    got = by_id(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "n_shingles", "component_id")
    assert got == {i: (70, i // 2 * 2) for i, _ in rows}


def test_a_large_near_group_is_found_in_full(spark):
    rnd = random.Random(9)
    base = [f"t{rnd.randint(0, 5000)}" for _ in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rnd.randint(0, 14)):
            words[rnd.randrange(300)] = f"n{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(40))) for i in range(30)]
    got = by_id(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "n_shingles", "component_id")
    assert got == brute.near_groups(rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "documents"):
        con.execute(f"create view {table} as from '/root/testdata/sf0.001/{table}.parquet'")
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, result.fetchall()))


def test_pipeline(spark):
    import corpus_pipeline

    rows = entry_points.queries()["pipeline"](spark, "/root/testdata/sf0.001")
    pieces = by_id(rows, "pieces")
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert 0 < len(pieces) < documents.count() and [n for n, _ in corpus_pipeline.STAGES][2] == "near_copies"
    leaked = decontaminate.leaks(documents, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))
    back = by_id(piece_sampling.decode_pieces(rows, PIECES), "text")
    assert not {r.doc_id for r in leaked.collect()} & set(back)
