"""The queries whose choice of rows depends on ties, missing values or repeated keys, on the harsher sample."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from helpers import TABLES, duck_table, sample_dir, spark_table
from harsh_sample import write_harsh_sample

NAMES = """
    dedup_latest_bill silver_guests silver_rooms silver_reservations silver_housekeeping silver_billing
    scd2_guests_merge scd2_rooms_merge scd2_merge_summary scd2_guest_history dq_log_full dq_unexplained_drops
    dq_key_uniqueness ri_checks temporal_checks surrogate_keys gold_reservation_wide gold_housekeeping_wide
    gold_billing_wide kpi1_occupancy_nightly kpi4_revpar dash_header_kpis dash_revenue_by_channel
    dash_duration_histogram synthetic_guests
""".split()


@pytest.fixture(scope="module")
def harsh(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("harsh"))
    write_harsh_sample(sample_dir("0.001"), folder, TABLES)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as from '{folder}/{table}.parquet'")
    return folder, con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, harsh, name):
    folder, con = harsh
    got = spark_table(entry_points.queries()[name](spark, folder))
    assert got == duck_table(con, entry_points.oracle_sql()[name])
