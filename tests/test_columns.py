from pyspark.sql import functions as F

from innledger.functions import columns as c
from innledger.sources.csv_ingest import increment_rows, increment_rows_exact


def one(spark, expression, **values):
    schema = ", ".join(f"{n} {t}" for n, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return df.select(expression.alias("x")).first().x


def test_truthy(spark):
    df = spark.createDataFrame([(t,) for t in ["TRUE", " yes ", "1", "y", "T", "no", "0", "on", None]], "t string")
    assert [r.b for r in df.select(c.truthy(F.col("t")).alias("b")).collect()] == [True] * 5 + [False] * 4


def test_truthy_of_boolean(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "t boolean")
    assert [r.b for r in df.select(c.truthy(F.col("t")).alias("b")).collect()] == [True, False, False]


def minutes(spark, start, end):
    df = spark.sql(f"select timestamp_ntz'{start}' s, timestamp_ntz'{end}' e")
    return df.select(c.minutes_between("s", "e").alias("m")).first().m


def test_minutes_count_boundaries(spark):
    assert minutes(spark, "2024-01-01 10:00:59", "2024-01-01 10:01:01") == 1
    assert minutes(spark, "2024-01-01 10:00:00", "2024-01-01 10:00:59") == 0
    assert minutes(spark, "2024-01-01 10:01:01", "2024-01-01 10:00:59") == -1
    assert minutes(spark, "1960-05-05 23:59:59.5", "1960-05-06 00:00:00") == 1


def test_minutes_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert minutes(spark, "2024-03-10 01:30:00", "2024-03-10 03:30:00") == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ratios_of_nothing(spark):
    df = spark.range(1)
    row = df.select(
        c.safe_ratio(F.lit(1), F.lit(0)).alias("a"), c.pct(F.lit(1), F.lit(8), 1).alias("b"),
    ).first()
    assert row.a is None and row.b == 12.5


def test_sla(spark):
    df = spark.createDataFrame(
        [("cleaning", 45), ("cleaning", 46), ("maintenance", 120), ("maintenance", 121), ("cleaning", None), ("x", 999)],
        "t string, m int",
    )
    assert [r.b for r in df.select(c.sla_breached(F.col("t"), F.col("m")).alias("b")).collect()] == [
        False, True, False, True, False, False,
    ]


def test_histogram_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.99,), (1.0,), (10.0,), (20.0,)], "x double")
    bins = df.select(c.histogram_bin(F.col("x"), F.lit(0.0), F.lit(20.0), 20).alias("b")).collect()
    assert [r.b for r in bins] == [0, 0, 1, 10, 19]
    same = df.select(c.histogram_bin(F.col("x"), F.lit(3.0), F.lit(3.0), 20).alias("b")).collect()
    assert {r.b for r in same} == {0}


def test_increment_pattern_wildcard(spark):
    names = ["guests_inc_1.csv", "province.csv", "inc.csv", "guests_base.csv"]
    df = spark.createDataFrame([(n,) for n in names], "_file_name string")
    assert [r[0] for r in increment_rows(df).collect()] == ["guests_inc_1.csv", "province.csv"]
    assert [r[0] for r in increment_rows_exact(df).collect()] == ["guests_inc_1.csv"]
