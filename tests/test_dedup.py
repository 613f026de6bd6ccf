import datetime as dt
import random

from innledger.operators import dedup, silver
from innledger.operators.dedup import dedup_latest, latest_if
from pyspark.sql import functions as F

OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
SCHEMA = "k string, v int, w string, _loaded_at timestamp_ntz"


def test_latest_load_wins_and_ties_do_not_depend_on_order(spark):
    data = [("a", 1, "x", NEW), ("a", 9, "x", OLD), ("b", 1, None, NEW), ("b", 1, "z", NEW), ("b", 1, "y", NEW)]
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, SCHEMA).repartition(3)
        assert sorted(map(tuple, dedup_latest(df, ["k"]).collect())) == [("a", 1, "x", NEW), ("b", 1, "z", NEW)]
        picked = df.groupBy("k").agg(latest_if(F.lit(True), df, "k", ["v", "w"]).alias("p")).select("k", "p.*")
        assert sorted(map(tuple, picked.collect())) == [("a", 1, "x"), ("b", 1, "z")]


def test_latest_valid_row_wins(spark):
    data = [("7", 2, "Available", 10, OLD), ("7", 0, "Available", 99, NEW)]
    schema = "room_id string, capacity int, status string, base_price int, _loaded_at timestamp_ntz"
    raw = spark.createDataFrame(data, schema).withColumn("_file_name", F.lit("f"))
    kept = silver.silver_rooms(raw, OLD).collect()
    assert [(r.capacity, r.base_price, r.scd_version, r.is_current) for r in kept] == [(2, 10, 1, True)]


def test_copies_of_a_key_are_dropped_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x", NEW)], SCHEMA)
    plan = dedup_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_only_crowded_keys_are_sorted_before_the_shuffle(spark):
    """No other rows pass a sort of whole map tasks, which spills once these are large."""
    df = spark.range(0, 40_000, 1, 4).selectExpr(
        "if(id % 4 = 0, 'hot', if(id % 4 = 1, null, concat('k', id % 7000))) k", "cast(id * 7919 % 1009 as int) v",
        "cast(id % 3 as string) w", "timestamp_ntz'2024-01-01' as _loaded_at",
    )
    want = {}
    for row in df.collect():
        want[row.k] = max(want.get(row.k, (-1, "")), (row.v, row.w))
    assert dedup.crowded_buckets(df, ["k"], 1000).count() == 2  # that of the hot key and that of no key
    for least in (1000, 100_000):
        kept = dedup_latest(df, ["k"], least=least)
        got = kept.collect()
        assert len(got) == len(want) and {r.k: (r.v, r.w) for r in got} == want
        odd = dedup_latest(df, ["k"], valid=F.col("v") % 2 == 1, least=least).collect()
        assert len(odd) == df.where("v % 2 = 1").select("k").distinct().count() and all(r.v % 2 for r in odd)
    ranked = dedup_latest(df, ["k"])._jdf.queryExecution().sparkPlan().toString()
    assert ranked.count("BroadcastHashJoin") == 2
    before_shuffle = [line for line in ranked.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert len(before_shuffle) == 1  # the crowded keys' branch alone
    anti = ranked[: ranked.index("LeftAnti")].splitlines()
    assert "WindowGroupLimit" not in "".join(anti[[i for i, line in enumerate(anti) if "lag(" in line][0] :])


def test_reservation_filter_edges(spark):
    day = dt.date(2024, 5, 2)
    base = ("g", "r", day, day, "web", NEW)
    data = [
        ("same-day", *base, None, "Confirmed"),
        ("cancel-on-day", *base, dt.datetime(2024, 5, 2, 23, 59), "CANCELLED"),
        ("cancel-after", *base, dt.datetime(2024, 5, 3), "Cancelled"),
        ("padded", *base, None, " confirmed"),
        ("none", *base, None, None),
    ]
    schema = (
        "reservation_id string, guest_id string, room_id string, check_in_date date, check_out_date date, "
        "booking_channel string, booking_time timestamp_ntz, cancellation_time timestamp_ntz, status string"
    )
    raw = spark.createDataFrame(data, schema).withColumns(
        {"_loaded_at": F.lit(NEW).cast("timestamp_ntz"), "_file_name": F.lit("f")}
    )
    kept = silver.silver_reservations(raw, NEW).orderBy("reservation_id").collect()
    assert [(r.reservation_id, r.status, r.length_of_stay) for r in kept] == [
        ("cancel-on-day", "cancelled", 0),
        ("same-day", "confirmed", 0),
    ]
