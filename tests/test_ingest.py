import datetime as dt

from helpers import rows
from innledger.operators.dedup import dedup_latest
from innledger.sources.csv_ingest import (
    append_raw,
    cast_lenient,
    cast_strict,
    judge,
    read_csv_raw,
    source_manifest,
    store_strict,
)
from innledger.values import STAGE_NULL_TOKENS

NOW = dt.datetime(2024, 1, 1)
LAYOUT = "id string, day date, at timestamp_ntz, n int, price decimal(18,2), flag boolean"


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(("id,day,at,n,price,flag", *lines)) + "\n")
    return str(folder)


def test_null_tokens_quotes_and_column_counts(spark, tmp_path):
    path = write(
        tmp_path / "in",
        "x_inc_1.csv",
        '"a, ""b""",NULL,null,N/A,NA,',
        "short,2024-01-01",
        "long,2024-01-01,2024-01-01 10:00:00,1,2.50,true,extra,more",
    )
    plain = read_csv_raw(spark, path, LAYOUT, NOW)
    assert [tuple(r)[:6] for r in plain.orderBy("id").collect()] == [
        ('a, "b"', None, None, None, "NA", None),
        ("long", "2024-01-01", "2024-01-01 10:00:00", "1", "2.50", "true"),
        ("short", "2024-01-01", None, None, None, None),
    ]
    assert {r._file_name for r in plain.collect()} == {"x_inc_1.csv"}
    assert {r._loaded_at for r in plain.collect()} == {NOW}
    staged = read_csv_raw(spark, path, LAYOUT, NOW, STAGE_NULL_TOKENS, trim=True)
    assert staged.where("price is null").count() == 2


def test_lenient_cast_keeps_the_row(spark, tmp_path):
    path = write(
        tmp_path / "in",
        "x.csv",
        "iso,2024-01-31,2024-01-31 10:11:12,7,1.25,yes",
        "other,31-Jan-2024,01/31/2024 10:11:12,12.7,1,0",
        "bad,soon,2024-13-45,many,dear,maybe",
    )
    typed = cast_lenient(read_csv_raw(spark, path, LAYOUT, NOW), LAYOUT)
    at = dt.datetime(2024, 1, 31, 10, 11, 12)
    assert rows(typed, "id", "day", "at", "n", "flag") == [
        ("bad", None, None, None, None),
        ("iso", at.date(), at, 7, True),
        ("other", at.date(), at, 13, False),
    ]


def test_strict_cast_sets_rows_aside(spark, tmp_path):
    path = write(
        tmp_path / "in",
        "x.csv",
        "good,2024-01-31,2024-01-31 10:11:12,7,1.25,yes",
        "empty,,,,,",
        "bad,soon,2024-01-31 10:11:12,many,1,yes",
    )
    good, rejected = cast_strict(read_csv_raw(spark, path, LAYOUT, NOW), LAYOUT)
    assert rows(good, "id") == [("empty",), ("good",)]
    assert good.count() == len(good.collect()) == 2
    assert rows(rejected, "id", "day", "rejected_columns") == [("bad", "soon", "day,n")]
    only_day, _ = cast_strict(read_csv_raw(spark, path, LAYOUT, NOW), LAYOUT, strict=["n"])
    assert only_day.count() == 2


def test_strict_load_scans_once(spark, tmp_path):
    lines = [f"{i},{'soon' if i % 10 == 3 else '2024-01-31'},,{i},1.25,yes" for i in range(200)]
    path = write(tmp_path / "in", "x.csv", *lines)
    raw = read_csv_raw(spark, path, LAYOUT, NOW)
    plan = judge(raw, LAYOUT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    good, rejected = store_strict(raw, LAYOUT, str(tmp_path / "out"))
    want_good, want_rejected = cast_strict(raw, LAYOUT)
    (tmp_path / "in" / "x.csv").unlink()  # both sides are read from what was written
    assert (good.columns, rejected.columns) == (want_good.columns, want_rejected.columns)
    assert (good.count(), rejected.count()) == (180, 20)
    assert rows(rejected, "day", "rejected_columns")[0] == ("soon", "day")
    for side, name in ((good, "good"), (rejected, "rejected")):
        scan = side._jdf.queryExecution().executedPlan().toString()
        assert f"outcome#" in scan and f"= {name})" in scan and "PartitionFilters: [isnotnull(outcome" in scan


def test_strict_load_without_rejects_or_rows(spark, tmp_path):
    for name, lines in (("all-good", ["1,,,,,"]), ("none", [])):
        path = write(tmp_path / name, "x.csv", *lines)
        good, rejected = store_strict(read_csv_raw(spark, path, LAYOUT, NOW), LAYOUT, str(tmp_path / f"{name}-out"))
        assert (good.count(), rejected.count()) == (len(lines), 0)


def test_reload_appends_and_dedup_removes(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.sql("select id, timestamp_ntz'2024-01-01 00:00:00' _loaded_at from range(10)")
    append_raw(df, path)
    append_raw(df, path)
    assert spark.read.parquet(path).count() == 20
    assert dedup_latest(spark.read.parquet(path), ["id"]).count() == 10


def test_manifest_counts_files_per_entity(spark, tmp_path):
    for entity, files in (("guests", 2), ("rooms", 1)):
        for i in range(files):
            write(tmp_path / "stage" / entity, f"{i}.csv", "a")
    found = source_manifest(spark, str(tmp_path / "stage"), "*.csv")
    assert rows(found, "entity", "files") == [("guests", 2), ("rooms", 1)]
