from pyspark.sql import functions as F

from innledger.operators.keys import assign_keys, with_positions


def test_keys_in_order(spark, tmp_path):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("k")).repartition(7)
    with_positions(df, ["k"]).write.parquet(str(tmp_path / "t"))
    keyed = assign_keys(spark.read.parquet(str(tmp_path / "t")), "sk")
    assert keyed.columns == ["sk", "k"]
    got = [r.k for r in keyed.orderBy("sk").collect()]
    assert got == sorted(got) and len(got) == 5000
    assert keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()[:] == (1, 5000, 5000)


def test_keys_in_place_need_no_shuffle(spark, tmp_path):
    df = spark.range(0, 1000, 1, 9).where("id % 3 = 0")
    placed = with_positions(df)
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    placed.write.parquet(str(tmp_path / "t"))
    keyed = assign_keys(spark.read.parquet(str(tmp_path / "t")), "sk")
    assert sorted(r.sk for r in keyed.collect()) == list(range(1, 335))


def test_no_rows(spark, tmp_path):
    with_positions(spark.range(0), ["id"]).write.parquet(str(tmp_path / "t"))
    assert assign_keys(spark.read.parquet(str(tmp_path / "t")), "sk").count() == 0
