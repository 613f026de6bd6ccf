"""From CSV extracts to indicators."""

import datetime as dt

from helpers import rows
from innledger.plans.pipeline import run
from innledger.plans.registry import QUERIES, REPORTS
from innledger.plans.warehouse import Clock

FILES = {
    "guests/guests_1.csv": [
        "guest_id,name,dob,gender,email,phone,address,city,country,loyalty_tier,registration_date",
        "1001,Ann,1979-02-03,F,ann@mail.test,1,Road 1,Graz,Austria,Gold,2019-11-08",
        "1002,Bob,bad date,M,NULL,2,Road 2,Graz,Austria,Bronze,2022-04-19",
        "1003,Cid,1993-09-30,M,c@mail.test,3,Road 3,Graz,Austria,Diamond,2022-04-19",
    ],
    "guests/guests_inc_1.csv": [
        "guest_id,name,dob,gender,email,phone,address,city,country,loyalty_tier,registration_date",
        "1001,Ann,1979-02-03,F,ann@new.test,1,Road 1,Graz,Austria,Platinum,2019-11-08",
    ],
    "rooms/rooms_1.csv": [
        "room_id,hotel_id,room_type,floor,capacity,amenities,status,base_price",
        "301,H001,Deluxe,3,2,WiFi;TV,Available,135",
        "302,H001,Suite,5,4,WiFi,Occupied,265",
        "303,H002,Suite,5,0,WiFi,Occupied,265",
    ],
    "rooms/rooms_inc_1.csv": [
        "room_id,hotel_id,room_type,floor,capacity,amenities,status,base_price",
        "301,H001,Deluxe,3,2,WiFi;TV,Occupied,160",
    ],
    "reservations/reservations_1.csv": [
        "reservation_id,guest_id,room_id,check_in_date,check_out_date,booking_channel,booking_time,cancellation_time,status",
        "R1,1001,301,2024-01-10,2024-01-12,OTA,2024-01-01 10:00:00,,Completed",
        "R2,1002,301,2024-01-11,2024-01-13,Website,2024-01-01 11:00:00,,Confirmed",
        "R3,1001,302,2024-01-11,2024-01-13,Website,2024-01-01 11:00:00,2024-01-05 09:00:00,Cancelled",
        "R4,1001,302,2024-01-20,2024-01-18,Website,2024-01-01 11:00:00,,Confirmed",
        "R5,9999,302,2024-01-20,2024-01-21,Website,2024-01-01 11:00:00,,Confirmed",
    ],
    "housekeeping/housekeeping_1.csv": [
        "task_id,room_id,task_type,assigned_staff,scheduled_time,start_time,end_time,issue_detected_flag,status",
        "T1,301, Cleaning,Ravi,2024-01-10 08:00:00,2024-01-10 08:00:00,2024-01-10 08:46:00,yes,Completed",
        "T2,302,maintenance,Ravi,2024-01-10 08:00:00,2024-01-10 08:00:00,2024-01-10 10:00:00,false,Completed",
        "T3,302,maintenance,Ravi,2024-01-10 08:00:00,later,,false,Completed",
    ],
    "billing/billing_1.csv": [
        "bill_id,reservation_id,guest_id,total_amount,taxes,discounts,payment_mode,payment_time,is_flagged",
        "B1,R1,1001,300,30,10,Cash,2024-01-12 10:00:00,false",
        "B2,R2,1002,900,90,0,UPI,2024-01-13 10:00:00,true",
        "B3,R3,1001,-5,0,0,UPI,2024-01-13 10:00:00,false",
        "B4,R5,1001,20,2,0,UPI,2023-12-13 10:00:00,perhaps",
    ],
}


def test_pipeline(spark, tmp_path):
    for name, lines in FILES.items():
        path = tmp_path / "stage" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
    clock = Clock(
        loaded=dt.datetime(2024, 1, 1), merged=dt.datetime(2024, 2, 1), cancels_as_of=dt.datetime(2024, 1, 5, 12),
        cancels_threshold=0,
    )
    root = str(tmp_path / "out")
    w = run(spark, str(tmp_path / "stage"), root, clock)

    current = w.table("dim_guest").where("is_current")
    assert rows(current, "guest_id", "loyalty_tier", "email", "scd_version") == [
        ("1001", "Platinum", "ann@new.test", 2),
        ("1002", "Bronze", None, 1),
    ]
    prices = w.table("dim_room").selectExpr("room_id", "int(base_price)", "scd_version", "hotel_sk", "status")
    assert rows(prices, "*") == [
        ("301", 135, 1, 1, "Available"),
        ("301", 160, 2, 1, "Occupied"),
        ("302", 265, 1, 1, "Occupied"),
    ]
    stays = w.table("fact_reservation")
    assert rows(stays, "reservation_id", "guest_id", "is_double_booked", "is_suspicious_cancel") == [
        ("R1", "1001", True, False),
        ("R2", "1002", True, False),
        ("R3", "1001", False, True),
        ("R5", None, False, False),
    ]
    tasks = w.table("fact_housekeeping")
    assert rows(tasks, "task_id", "duration_minutes", "sla_breached", "issue_detected_flag") == [
        ("T1", 46, True, True),
        ("T2", 120, False, False),
    ]
    bills = w.table("fact_billing").selectExpr("bill_id", "int(net_amount)", "is_flagged", "billing_mismatch")
    assert rows(bills, "*") == [("B1", 320, False, False), ("B2", 990, True, True)]

    rejected = spark.read.option("recursiveFileLookup", True).parquet(
        f"{root}/bronze/housekeeping_rejects", f"{root}/bronze/billing_rejects"
    )
    assert rows(rejected, "rejected_columns") == [("is_flagged",), ("start_time",)]
    reasons = [r.error_message for r in w.table("dq_log").collect()]
    assert sorted(reasons) == [
        "Invalid room — capacity <= 0 or base_price < 0",
        "Missing required field — guest_id or email is NULL",
        "Negative amount — total/taxes/discounts must be >= 0",
        "check_out_date is before check_in_date",
        "guest_id not found in VAL_GUESTS",
    ]
    for report in REPORTS:
        assert "as_of" in spark.read.parquet(f"{root}/reports/{report}").columns
    final = spark.read.parquet(f"{root}/layers/dq_log_final")
    assert "total_amount must be >= 0" in {r.error_message for r in final.collect()}
    conversion = spark.read.parquet(f"{root}/reports/kpi2_conversion").first()
    assert (conversion.total_reservations, conversion.conversion_pct) == (4, 25.0)
    assert QUERIES["dash_kpi_summary"](w).count() == 6

    # A later increment is merged into the versions of the first run.
    later = tmp_path / "stage2"
    for name, lines in FILES.items():
        path = later / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines).replace("Platinum", "Silver") + "\n")
    march = Clock(loaded=clock.loaded, merged=dt.datetime(2024, 3, 1), cancels_as_of=clock.cancels_as_of)
    second = run(spark, str(later), str(tmp_path / "out2"), march, previous=root, reports=())
    versions = second.table("dim_guest").where("guest_id = '1001'")
    assert rows(versions, "scd_version", "loyalty_tier", "is_current") == [
        (1, "Gold", False),
        (2, "Platinum", False),
        (3, "Silver", True),
    ]


def write_stage(stage, files):
    for name, lines in files.items():
        path = stage / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
    return str(stage)


def test_carried_run(spark, tmp_path):
    """The second stage holds increments and unseen base rows only: nobody is lost, and only real orphans are logged."""
    clock = Clock(loaded=dt.datetime(2024, 1, 1), merged=dt.datetime(2024, 2, 1), cancels_as_of=dt.datetime(2024, 1, 5, 12))
    root = str(tmp_path / "first")
    run(spark, write_stage(tmp_path / "stage1", FILES), root, clock, reports=())
    head, room_head = FILES["guests/guests_1.csv"][0], FILES["rooms/rooms_1.csv"][0]
    later = FILES | {
        "guests/guests_1.csv": [head, "1004,Dee,1999-05-05,F,dee@mail.test,4,Road 4,Graz,Austria,Gold,2024-02-20"],
        "rooms/rooms_1.csv": [room_head, "304,H002,Suite,5,2,WiFi,Available,300"],
    }
    march = Clock(loaded=dt.datetime(2024, 2, 20), merged=dt.datetime(2024, 3, 1), cancels_as_of=clock.cancels_as_of)
    again = None
    for _ in range(2):  # a repeated run changes nothing
        w = run(spark, write_stage(tmp_path / "stage2", later), str(tmp_path / "second"), march, previous=root, reports=())
        found = (
            rows(w.table("dim_guest").where("guest_id = '1004'"), "scd_version", "is_current"),
            rows(w.table("dim_room").where("room_id = '304'"), "scd_version", "is_current"),
            rows(w.table("dq_log").where("error_type = 'REFERENTIAL'"), "record_id", "error_message"),
            w.table("dim_guest").count(),
        )
        assert again in (None, found)
        again = found
    assert again[:3] == ([(1, True)], [(1, True)], [("R5", "guest_id not found in VAL_GUESTS")])


def test_tolerance_reaches_the_fact(spark, tmp_path):
    clock = Clock(
        loaded=dt.datetime(2024, 1, 1), merged=dt.datetime(2024, 2, 1), cancels_as_of=dt.datetime(2024, 1, 5), tolerance=10
    )
    w = run(spark, write_stage(tmp_path / "stage", FILES), str(tmp_path / "out"), clock, reports=())
    assert rows(w.table("fact_billing").where("billing_mismatch"), "bill_id") == [("B1",), ("B2",)]


def test_later_file_of_a_load_wins(spark):
    from innledger.operators.dedup import dedup_latest

    both = spark.createDataFrame(
        [("1", "Zed", "g_inc_1.csv"), ("1", "Ann", "g_inc_2.csv")], "guest_id string, name string, _file_name string"
    )
    assert rows(dedup_latest(both.selectExpr("*", "current_date() _loaded_at"), ["guest_id"]), "name") == [("Ann",)]
