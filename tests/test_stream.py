import datetime as dt

from helpers import rows, sample_dir
from innledger.operators import scd
from innledger.plans.warehouse import SAMPLE_CLOCK, warehouse
from innledger.streaming.incremental import merge_increments


def merge(old, new):
    return scd.merge_rooms(old, new, SAMPLE_CLOCK.merged)


def test_files_in_several_batches_equal_one_merge(spark, tmp_path):
    w = warehouse(spark, sample_dir("0.001"))
    increment = w.raw("raw_rooms_inc")
    base = w.table("silver_rooms")
    incoming, initial = str(tmp_path / "incoming"), str(tmp_path / "initial")
    base.write.parquet(initial)

    def run():
        return merge_increments(
            spark, incoming, increment.schema, initial, str(tmp_path / "snapshots"), str(tmp_path / "checkpoint"),
            merge, files_per_batch=1,
        )

    even = increment.where("cast(room_id as bigint) % 2 = 0").coalesce(1)
    odd = increment.where("cast(room_id as bigint) % 2 = 1").coalesce(1)
    even.write.parquet(incoming)
    first = run()
    assert rows(first, "*") == rows(merge(base, even).drop("action"), "*")

    odd.write.mode("append").parquet(incoming)
    expected = rows(merge(base, increment).drop("action"), "*")
    assert rows(run(), "*") == expected
    assert rows(run(), "*") == expected  # nothing new arrived


def test_rows_of_other_files_are_ignored(spark, tmp_path):
    w = warehouse(spark, sample_dir("0.001"))
    base = w.table("silver_rooms")
    base.write.parquet(str(tmp_path / "initial"))
    raw = w.raw("raw_rooms")
    raw.write.parquet(str(tmp_path / "incoming"))
    merged = merge_increments(
        spark, str(tmp_path / "incoming"), raw.schema, str(tmp_path / "initial"), str(tmp_path / "s"),
        str(tmp_path / "c"), merge,
    )
    assert rows(merged, "*") == rows(base, "*")
    assert dt.date(9999, 12, 31) in {r.scd_end_date for r in merged.collect()}
