"""One key with a third of all rows: joins are split, groups are folded, results stay whole."""

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from innledger.operators import anomaly, dq, gold, scd

ROWS = 30_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(value, other):
    return F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(other)


@pytest.fixture(scope="module")
def stays(spark):
    start = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 500).cast("int"))
    return spark.range(0, ROWS, 1, 12).select(
        F.col("id").alias("reservation_sk"),
        F.col("id").cast("string").alias("reservation_id"),
        hot("g0", F.concat(F.lit("g"), F.col("id"))).alias("guest_id"),
        hot("r0", F.concat(F.lit("r"), F.col("id"))).alias("room_id"),
        hot(0, F.col("id")).alias("guest_sk"),
        hot(0, F.col("id")).alias("room_sk"),
        hot(F.lit("2020-01-01").cast("date"), start).alias("check_in_date"),
        F.lit(2).alias("length_of_stay"),
        F.lit("cancelled").alias("status"),
        F.lit("web").alias("booking_channel"),
        F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz").alias("booking_time"),
        F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz").alias("cancellation_time"),
        F.lit(False).alias("is_double_booked"),
        F.lit(False).alias("is_suspicious_cancel"),
    ).withColumn("check_out_date", F.date_add("check_in_date", F.col("length_of_stay")))


@pytest.fixture(scope="module")
def dims(spark):
    guests = spark.range(0, ROWS, 1, 4).select(
        F.concat(F.lit("g"), F.col("id")).alias("guest_id"), F.col("id").alias("guest_sk"), F.lit(True).alias("is_current")
    )
    rooms = spark.range(0, ROWS, 1, 4).select(
        F.concat(F.lit("r"), F.col("id")).alias("room_id"),
        F.col("id").alias("room_sk"),
        F.lit("H001").alias("hotel_id"),
        F.lit(1).cast("bigint").alias("hotel_sk"),
        F.lit(100).cast("decimal(18,2)").alias("base_price"),
        F.lit(True).alias("is_current"),
    )
    return guests, rooms


def test_dimension_lookup_splits_the_hot_key(spark, stays, dims):
    with settings(spark, SMALL):
        fact = gold.load_reservations(stays.drop("guest_sk", "room_sk"), *dims)
        assert final_plan(fact).count("skew=true") >= 2
        assert fact.count() == ROWS
        assert fact.where("guest_sk = 0 and room_sk = 0").count() == ROWS // 3


def test_orphans_split_the_hot_key(spark, stays, dims):
    with settings(spark, SMALL):
        lost = stays.withColumn("guest_id", F.when(F.col("guest_id") == "g0", "nobody").otherwise(F.col("guest_id")))
        log = dq.run_orphans(lost, dims[0], "reservation_id", "guest_id", "RAW_RESERVATIONS", "VAL_GUESTS")
        assert "skew=true" in final_plan(log)
        assert log.count() == ROWS // 3


def test_double_bookings_of_one_room_and_day(spark, stays):
    with settings(spark, SMALL):
        flagged = anomaly.flag_double_bookings(stays.withColumn("status", F.lit("confirmed")))
        plan = final_plan(flagged)
        assert "skew=true" in plan
        assert flagged.where("is_double_booked").count() == ROWS // 3
        assert flagged.count() == ROWS


def test_cancels_of_one_guest_are_salted(spark, stays):
    with settings(spark, SMALL):
        flagged = anomaly.flag_suspicious_cancels(stays, dt.datetime(2020, 1, 1, 12))
        assert "_row_salt" in final_plan(flagged)
        assert flagged.where("is_suspicious_cancel").count() == ROWS // 3
        assert flagged.count() == ROWS


def test_history_of_one_key_takes_one_shuffle(spark, stays):
    """A key has few versions in practice, so it is not split; one with many still comes out whole."""
    with settings(spark, SMALL):
        versions = stays.select("guest_id", F.col("reservation_sk").alias("scd_version"))
        history = scd.changed_history(versions, "guest_id")
        assert history.count() == ROWS // 3
        plan = history._jdf.queryExecution().sparkPlan().toString()
        prepared = history._jdf.queryExecution().executedPlan().toString()
        initial = prepared[prepared.index("Initial Plan") :] if "Initial Plan" in prepared else prepared
        assert plan.count("Window [") == 1
        assert initial.count("Exchange hashpartitioning") == 1


def test_reference_counts_are_folded_before_the_join(spark, stays, dims):
    with settings(spark, SMALL):
        lost = stays.withColumn("guest_id", F.when(F.col("guest_id") == "g0", "nobody").otherwise(F.col("guest_id")))
        counted = dq.broken_references(lost, dims[0], "guest_id", "x")
        assert counted.first().broken_refs == ROWS // 3
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.index("LeftAnti") < plan.index("keys=[guest_id")  # the count lies below the join
