import shutil

from helpers import sample_dir
from innledger import session
from innledger.plans.registry import QUERIES
from innledger.plans.warehouse import SOURCE_TABLES, warehouse


def test_opening_a_warehouse_leaves_the_settings_alone(spark):
    before = {r.key: r.value for r in spark.sql("set").collect()}
    warehouse(spark, sample_dir("0.001"))
    assert {r.key: r.value for r in spark.sql("set").collect()} == before


def test_layers_lie_in_the_shared_folder(spark):
    shared = session.shared_folder(spark)
    assert shared == (spark.conf.get("spark.checkpoint.dir", None) or shared).rstrip("/")
    assert warehouse(spark, sample_dir("0.001")).root.startswith(shared)


def test_replaced_files_give_a_new_warehouse(spark, tmp_path):
    for table in {t for tables in SOURCE_TABLES.values() for t in tables}:
        shutil.copyfile(f"{sample_dir('0.001')}/{table}.parquet", tmp_path / f"{table}.parquet")
    first = warehouse(spark, str(tmp_path))
    assert warehouse(spark, str(tmp_path)) is first
    before = QUERIES["kpi2_conversion"](first).first().total_reservations
    shutil.copyfile(f"{sample_dir('0.01')}/orders.parquet", tmp_path / "orders.parquet")
    second = warehouse(spark, str(tmp_path))
    assert second is not first
    after = QUERIES["kpi2_conversion"](second).first().total_reservations
    assert (before, after) == (1444, 14472)
