"""Rooms in use per night as a sweep over the boundaries of stays."""

import datetime as dt
import random
from collections import defaultdict

from innledger.plans import kpi
from innledger.plans.kpi import kpi1_occupancy_nightly

LAYOUT = "room_sk long, check_in_date date, check_out_date date, status string"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frames(spark, stays, total=50):
    return spark.createDataFrame(stays, LAYOUT), spark.range(total).selectExpr("id room_sk", "true is_current")


def test_sweep_equals_single_nights(spark):
    rng = random.Random(7)
    stays = []
    for _ in range(600):
        begin = rng.randint(0, 90)
        end = begin + rng.choice([0, 1, 1, 2, 3, 9, 40, -2])
        stays.append((rng.choice([None, *range(12)]), day(begin), day(end), rng.choice(["confirmed", "cancelled", "completed"])))
    stays += [(3, day(0), None, "confirmed"), (3, None, day(9), "confirmed"), (4, day(200), day(201), "confirmed")] * 2
    nights = defaultdict(set)
    for room, begin, end, status in stays:
        if room is not None and begin and end and status != "cancelled":
            for n in range((end - begin).days):
                nights[begin + dt.timedelta(days=n)].add(room)
    found = kpi1_occupancy_nightly(*frames(spark, stays)).collect()
    assert [(r.date, r.occupied_rooms) for r in found] == sorted((d, len(rooms)) for d, rooms in nights.items())
    assert {r.occupancy_rate_pct for r in found if r.occupied_rooms == 1} == {2.0}


def test_stay_without_end_costs_two_boundaries(spark):
    end = dt.date(9999, 12, 31)
    stays = [(1, day(0), end, "confirmed"), (1, day(5), day(7), "confirmed"), (2, day(5), day(7), "confirmed")]
    found = kpi1_occupancy_nightly(*frames(spark, stays))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join Inner" not in plan
    assert found.count() == (end - day(0)).days
    busy = found.where("occupied_rooms = 2").collect()
    assert [r.date for r in busy] == [day(5), day(6)]


def test_no_stays(spark):
    assert kpi1_occupancy_nightly(*frames(spark, [])).collect() == []
    assert kpi.calendar(spark).count() == 3_652_059
