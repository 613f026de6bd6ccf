"""Audits taken while writing, and the log rebuilt by partitions."""

import shutil
from pathlib import Path

import pytest
from helpers import rows, sample_dir
from innledger.operators import dq
from innledger.plans import audits
from innledger.plans.registry import QUERIES
from innledger.plans.warehouse import warehouse
from innledger.sources.sample_views import SOURCE_TABLES

LOG = "source_table string, record_id string, error_type string, error_message string, raw_value string"


@pytest.mark.parametrize(
    "measured,scanned",
    [("audit_row_counts", "silver_row_counts"), ("audit_merges", "scd2_merge_summary"), ("audit_gold_loads", "gold_load_audit")],
)
def test_audits_equal_the_scans_and_read_no_layer(spark, measured, scanned):
    w = warehouse(spark, sample_dir("0.001"))
    found, want = QUERIES[measured](w), QUERIES[scanned](w)
    assert rows(found, *want.columns) == rows(want, *want.columns)
    assert all("/audit/" in file for file in found.inputFiles())


def test_a_table_without_rows_is_measured(spark, tmp_path):
    empty = spark.createDataFrame([], "is_flagged boolean, billing_mismatch boolean, total_amount decimal(12,2)")
    audits.write_measured(empty, "fact_billing", str(tmp_path / "t"), str(tmp_path / "a"))
    found = {r.measure: r.value for r in spark.read.parquet(str(tmp_path / "a")).collect()}
    assert found == {"total_rows": 0, "flagged_bills": 0, "mismatch_bills": 0, "total_revenue": None}


def test_only_value_partitions_are_rewritten(spark, tmp_path):
    entry = lambda kind, i: ("RAW_ROOMS", str(i), kind, f"m{i}", None)
    log = spark.createDataFrame([entry("VALUE", 1), entry("TEMPORAL", 2), entry("REFERENTIAL", 3)], LOG)
    table = str(tmp_path / "log")
    dq.write_log(log, table)
    files = lambda: {f.name for f in (tmp_path / "log").rglob("*.parquet") if "VALUE" not in str(f)}
    before = files()
    checks = spark.createDataFrame([entry("VALUE", 7), entry("VALUE", 8)], LOG)
    for _ in range(2):
        dq.replace_value_entries(checks, table)
        found = spark.read.schema(log.schema).parquet(table)
        assert rows(found, *log.columns) == rows(dq.rebuild_log(log, checks), *log.columns)
        assert files() == before
    dq.replace_value_entries(checks.limit(0), table)
    found = spark.read.schema(log.schema).parquet(table)
    assert rows(found, "record_id") == [("2",), ("3",)] and files() == before


def test_a_raw_table_is_stored_when_asked_for_again(spark, tmp_path):
    for table in {t for tables in SOURCE_TABLES.values() for t in tables}:
        shutil.copy(f"{sample_dir('0.001')}/{table}.parquet", tmp_path)
    w = warehouse(spark, str(tmp_path))
    kept = Path(w.path("bronze/raw_rooms"))
    first = w.raw("raw_rooms")
    assert not kept.exists()
    again = w.raw("raw_rooms")
    assert kept.exists() and again.dtypes == first.dtypes
    assert rows(again, *first.columns) == rows(first, *first.columns)


def test_layers_are_written_in_small_files(spark):
    w = warehouse(spark, sample_dir("0.001"))
    for name in ("silver_rooms", "silver_billing"):
        assert all(".zstd." in file for file in w.table(name).inputFiles())
