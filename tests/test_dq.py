from helpers import rows, sample_dir
from innledger.operators import dq
from innledger.plans.warehouse import warehouse


def test_null_values_break_no_rule(spark):
    df = spark.createDataFrame(
        [("r1", None, None, None), ("r2", 0, None, " Available "), (None, 0, -1, "Closed")],
        "room_id string, capacity int, base_price int, status string",
    )
    log = dq.run_rules(df, dq.room_rules())
    assert rows(log, "record_id", "error_message", "raw_value") == [
        ("r2", "Invalid room — capacity <= 0 or base_price < 0", None),
        ("r2", "room_capacity must be > 0", "room_id=r2 | capacity=0"),
    ]


def test_one_row_can_break_several_rules(spark):
    df = spark.createDataFrame([("r1", 0, -5, "Closed")], "room_id string, capacity int, base_price int, status string")
    assert dq.run_rules(df, dq.room_rules()).count() == 4


def test_rules_of_a_table_share_a_scan(spark):
    w = warehouse(spark, sample_dir("0.001"))
    log = dq.run_rules(w.raw("raw_billing"), dq.billing_rules())
    assert log._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_missing_guest_is_named(spark):
    df = spark.createDataFrame([(None, "e"), ("g", None), ("h", "e")], "guest_id string, email string")
    log = dq.run_rules(df, dq.guest_rules())
    assert rows(log, "record_id", "raw_value") == [
        ("NULL", "guest_id=NULL | email=e"),
        ("g", "guest_id=g | email=NULL"),
    ]


def test_rebuilt_log_replaces_value_entries(spark):
    w = warehouse(spark, sample_dir("0.001"))
    first = w.table("dq_log")
    rebuilt = dq.rebuild_log(first, dq.value_checks(w.raws()))
    kept = first.where("error_type <> 'VALUE'").count()
    assert rebuilt.count() == kept + dq.value_checks(w.raws()).count()
    assert rebuilt.where("error_message like 'Missing%' or error_message like 'Invalid%'").count() == 0


def test_broken_references_count_rows_with_no_key(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert dq.broken_references(child, parent, "k", "x").first().broken_refs == 3
    assert dq.broken_references(child.where("k = 'a'"), parent, "k", "x").first().broken_refs == 0
