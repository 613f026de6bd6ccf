"""Checking SQL for DuckDB: the same results, stated independently of the Spark plans.

Building blocks are named subqueries; the text of a query holds only the ones it needs. Set-based forms
are used where the Spark side has a rewritten one, for example pairwise overlap for double bookings.
"""

from __future__ import annotations

import re

from innledger.sources.sample_views import VIEWS, view_sql
from innledger.values import (
    GUEST_OVERWRITE,
    GUEST_TRACKED,
    HOTELS,
    ROOM_OVERWRITE,
    ROOM_TRACKED,
)


def _pct(part: str, whole: str, digits: int) -> str:
    return f"round(100::DOUBLE * ({part})::DOUBLE / nullif(({whole})::DOUBLE, 0), {digits})"


def _mean(value: str, digits: int) -> str:
    return f"round(sum({value})::DOUBLE / nullif(count({value}), 0)::DOUBLE, {digits})"


def _money(value: str) -> str:
    return f"sum({value})::DECIMAL(38,2)"


def _n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_LOADED = "TIMESTAMP '2024-01-01 06:00:00' AS _loaded_at, _file_name AS _source_file"
_FIRST = (
    "DATE '2024-01-01' AS scd_start_date, DATE '9999-12-31' AS scd_end_date, "
    f"true AS is_current, 1 AS scd_version, {_LOADED}"
)
_GUEST = "name, dob, gender, email, phone, address, city, country, loyalty_tier, registration_date"
_ROOM = "hotel_id, room_type, floor, capacity, amenities, status, base_price"
_TIER_OK = "loyalty_tier IN ('Bronze', 'Silver', 'Gold', 'Platinum')"
_BILL = "total_amount, taxes, discounts, reservation_id, guest_id, payment_mode, payment_time, is_flagged"
_RESERVATION = (
    "guest_id, room_id, check_in_date, check_out_date, booking_channel, booking_time, cancellation_time, status"
)
_TASK = (
    "room_id, task_type, assigned_staff, scheduled_time, start_time, end_time, issue_detected_flag, status"
)


def _latest(table: str, key: str, columns: str) -> str:
    """The latest row per key; rows of one load are told apart by all their columns, greatest first."""
    order = ", ".join(f"{table}.{c} DESC NULLS LAST" for c in f"_loaded_at, _file_name, {columns}".split(", "))
    return f"QUALIFY row_number() OVER (PARTITION BY {table}.{key} ORDER BY {order}) = 1"


_TRUE = "coalesce(regexp_full_match(lower(trim({0})), 'true|1|yes|y|t'), false)"


def _versions(entity: str, key: str, columns: str, tracked: tuple, overwrite: tuple, ok: str, over_ok: str) -> dict:
    """Old snapshot and increment to new snapshot, one branch per kind of row."""
    names = columns.split(", ")
    opened = ", ".join(f"o.{c}" if c in overwrite else f"p.{c}" for c in names)
    kept = ", ".join(f"CASE WHEN o.{key} IS NULL THEN s.{c} ELSE o.{c} END AS {c}" for c in overwrite)
    differs = " OR ".join(f"p.{c} <> s.{c}" for c in tracked)
    rewritten = " OR ".join(f"o.{c} IS DISTINCT FROM s.{c}" for c in overwrite)
    stamp = (
        "DATE '2024-02-01' AS scd_start_date, DATE '9999-12-31' AS scd_end_date, true AS is_current, "
        "TIMESTAMP '2024-02-01 06:00:00' AS _loaded_at, p._file_name AS _source_file"
    )
    latest = _latest(f"raw_{entity}s_inc", key, columns)
    return {
        f"{entity}_pick": f"SELECT * FROM raw_{entity}s_inc WHERE {key} IS NOT NULL AND {ok} {latest}",
        f"{entity}_over": f"SELECT * FROM raw_{entity}s_inc WHERE {key} IS NOT NULL AND {over_ok} {latest}",
        f"{entity}_change": f"SELECT {key} FROM silver_{entity}s s JOIN {entity}_pick p USING ({key}) WHERE {differs}",
        f"{entity}_versions": f"""
SELECT s.* REPLACE (DATE '2024-01-31' AS scd_end_date, false AS is_current), 'expired' AS action
FROM silver_{entity}s s SEMI JOIN {entity}_change USING ({key})
UNION ALL BY NAME
SELECT p.{key}, {opened}, {stamp}, s.scd_version + 1 AS scd_version, 'new_version' AS action
FROM {entity}_pick p JOIN silver_{entity}s s USING ({key}) JOIN {entity}_over o USING ({key})
WHERE p.{key} IN (FROM {entity}_change)
UNION ALL BY NAME
SELECT p.{key}, {opened}, {stamp}, 1 AS scd_version, 'inserted' AS action
FROM {entity}_pick p JOIN {entity}_over o USING ({key}) ANTI JOIN silver_{entity}s USING ({key})
UNION ALL BY NAME
SELECT s.* REPLACE ({kept}),
  CASE WHEN o.{key} IS NOT NULL AND ({rewritten}) THEN 'overwritten' ELSE 'unchanged' END AS action
FROM silver_{entity}s s LEFT JOIN {entity}_over o USING ({key})
WHERE s.{key} NOT IN (FROM {entity}_change)""",
    }


_HOTEL_ROWS = ", ".join(
    f"({sk}, '{h[0]}', '{h[1]}', '{h[2]}', '{h[3]}', {h[4]}, {h[5]})" for sk, h in enumerate(HOTELS, start=1)
)


def _rule(table: str, key: str, kind: str, message: str, broken: str, raw_value: str) -> str:
    return (
        f"SELECT '{table.upper()}' AS source_table, coalesce({key}, 'NULL') AS record_id, '{kind}' AS error_type, "
        f"'{message}' AS error_message, {raw_value} AS raw_value FROM {table} WHERE {broken}"
    )


def _orphan(table: str, key: str, ref: str, parent: str, parent_name: str) -> str:
    return _rule(
        table,
        key,
        "REFERENTIAL",
        f"{ref} not found in {parent_name}",
        f"{key} IS NOT NULL AND {ref} IS NOT NULL AND {ref} NOT IN (SELECT {ref} FROM {parent})",
        f"'{ref}=' || {ref}",
    )


_AT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_BAD_ROOM = "trim(status) NOT IN ('Available', 'Occupied', 'Maintenance') AND room_id IS NOT NULL"
_BAD_RES = "lower(trim(status)) NOT IN ('confirmed', 'cancelled', 'completed') AND reservation_id IS NOT NULL"

# Rules of the first and the second round, by query name.
_FIRST_RULES = {
    "dq_guest_missing": _rule(
        "raw_guests", "guest_id", "VALUE", "Missing required field — guest_id or email is NULL",
        "guest_id IS NULL OR email IS NULL",
        "concat('guest_id=', coalesce(guest_id, 'NULL'), ' | email=', coalesce(email, 'NULL'))",
    ),
    "dq_room_values": _rule(
        "raw_rooms", "room_id", "VALUE", "Invalid room — capacity <= 0 or base_price < 0",
        "(capacity <= 0 OR base_price < 0) AND room_id IS NOT NULL",
        "'capacity=' || capacity || ' | base_price=' || base_price",
    ),
    "dq_room_status": _rule(
        "raw_rooms", "room_id", "VALUE", "Invalid status — must be Available/Occupied/Maintenance",
        _BAD_ROOM, "'status=' || status",
    ),
    "dq_res_dates": _rule(
        "raw_reservations", "reservation_id", "TEMPORAL", "check_out_date is before check_in_date",
        "check_out_date < check_in_date AND reservation_id IS NOT NULL",
        "'check_in=' || check_in_date || ' | check_out=' || check_out_date",
    ),
    "dq_res_cancel_late": _rule(
        "raw_reservations", "reservation_id", "TEMPORAL", "cancellation_time is after check_in_date",
        "cancellation_time >= check_in_date + INTERVAL 1 DAY AND reservation_id IS NOT NULL",
        f"'cancellation=' || {_AT.format('cancellation_time')} || ' | check_in=' || check_in_date",
    ),
    "dq_res_orphan_guest": _orphan(
        "raw_reservations", "reservation_id", "guest_id", "guest_versions WHERE is_current", "VAL_GUESTS"
    ),
    "dq_res_orphan_room": _orphan(
        "raw_reservations", "reservation_id", "room_id", "room_versions WHERE is_current", "VAL_ROOMS"
    ),
    "dq_res_status": _rule(
        "raw_reservations", "reservation_id", "VALUE", "Invalid status — must be Confirmed/Cancelled/Completed",
        _BAD_RES, "'status=' || status",
    ),
    "dq_hk_times": _rule(
        "raw_housekeeping", "task_id", "TEMPORAL", "end_time is before start_time",
        "end_time < start_time AND task_id IS NOT NULL",
        f"'start=' || {_AT.format('start_time')} || ' | end=' || {_AT.format('end_time')}",
    ),
    "dq_hk_orphan_room": _orphan(
        "raw_housekeeping", "task_id", "room_id", "room_versions WHERE is_current", "VAL_ROOMS"
    ),
    "dq_hk_task_type": _rule(
        "raw_housekeeping", "task_id", "VALUE", "Invalid task_type — must be cleaning or maintenance",
        "lower(trim(task_type)) NOT IN ('cleaning', 'maintenance') AND task_id IS NOT NULL",
        "'task_type=' || task_type",
    ),
    "dq_billing_negative": _rule(
        "raw_billing", "bill_id", "VALUE", "Negative amount — total/taxes/discounts must be >= 0",
        "least(total_amount, taxes, discounts) < 0 AND bill_id IS NOT NULL",
        "'total=' || total_amount || ' | taxes=' || taxes || ' | discounts=' || discounts",
    ),
    "dq_billing_orphan_res": _orphan(
        "raw_billing", "bill_id", "reservation_id", "silver_reservations", "VAL_RESERVATIONS"
    ),
    "dq_billing_payment_before_booking": _rule(
        "raw_billing", "bill_id", "TEMPORAL", "payment_time is before booking_time",
        "bill_id IS NOT NULL AND payment_time < booking_time",
        f"'payment=' || {_AT.format('payment_time')} || ' | booking=' || {_AT.format('booking_time')}",
    ).replace(
        "FROM raw_billing",
        "FROM raw_billing JOIN (SELECT reservation_id, booking_time FROM silver_reservations) USING (reservation_id)",
    ),
}


def _amount_rule(column: str) -> str:
    return _rule(
        "raw_billing", "bill_id", "VALUE", f"{column} must be >= 0", f"{column} < 0 AND bill_id IS NOT NULL",
        f"'bill_id=' || bill_id || ' | {column}=' || {column}",
    )


_SECOND_RULES = {
    "vc_total_amount": _amount_rule("total_amount"),
    "vc_taxes": _amount_rule("taxes"),
    "vc_discounts": _amount_rule("discounts"),
    "vc_capacity": _rule(
        "raw_rooms", "room_id", "VALUE", "room_capacity must be > 0", "capacity <= 0 AND room_id IS NOT NULL",
        "'room_id=' || room_id || ' | capacity=' || capacity",
    ),
    "vc_res_status": _rule(
        "raw_reservations", "reservation_id", "VALUE", "status must be Confirmed/Cancelled/Completed",
        _BAD_RES, "'reservation_id=' || reservation_id || ' | status=' || status",
    ),
    "vc_room_status": _rule(
        "raw_rooms", "room_id", "VALUE", "status must be Available/Occupied/Maintenance",
        _BAD_ROOM, "'room_id=' || room_id || ' | status=' || status",
    ),
    "vc_hk_status": _rule(
        "raw_housekeeping", "task_id", "VALUE", "status must be Completed/Pending/In Progress/Pending Review",
        "lower(trim(status)) NOT IN ('completed', 'pending', 'in progress', 'pending review') AND task_id IS NOT NULL",
        "'task_id=' || task_id || ' | status=' || status",
    ),
}
_LIMIT = "CASE task_type WHEN 'cleaning' THEN 45 WHEN 'maintenance' THEN 120 END"

BLOCKS: dict[str, str] = {
    **{name: view_sql(name) for name in VIEWS},
    "silver_guests": f"""
SELECT guest_id, {_GUEST}, {_FIRST} FROM raw_guests WHERE guest_id IS NOT NULL AND {_TIER_OK}
{_latest('raw_guests', 'guest_id', _GUEST)}""",
    "silver_rooms": f"""
SELECT room_id, {_ROOM}, {_FIRST} FROM raw_rooms
WHERE room_id IS NOT NULL AND capacity > 0 AND base_price >= 0
  AND status IN ('Available', 'Occupied', 'Maintenance')
{_latest('raw_rooms', 'room_id', _ROOM)}""",
    "silver_reservations": f"""
SELECT reservation_id, guest_id, room_id, check_in_date, check_out_date,
  date_diff('day', check_in_date, check_out_date)::INTEGER AS length_of_stay, booking_channel, booking_time,
  cancellation_time, lower(status) AS status, {_LOADED}
FROM raw_reservations
WHERE reservation_id IS NOT NULL
  AND guest_id IS NOT NULL AND room_id IS NOT NULL AND check_in_date <= check_out_date
  AND coalesce(cancellation_time < check_in_date + INTERVAL 1 DAY, true)
  AND lower(status) IN ('confirmed', 'cancelled', 'completed')
{_latest('raw_reservations', 'reservation_id', _RESERVATION)}""",
    "silver_housekeeping": f"""
SELECT task_id, room_id, lower(trim(task_type)) AS task_type, assigned_staff, scheduled_time, start_time, end_time,
  date_diff('minute', start_time, end_time) AS duration_minutes,
  {_TRUE.format('issue_detected_flag')} AS issue_detected_flag, trim(status) AS status, {_LOADED}
FROM raw_housekeeping
WHERE task_id IS NOT NULL AND room_id IS NOT NULL AND (end_time IS NULL OR start_time <= end_time)
  AND lower(trim(task_type)) IN ('cleaning', 'maintenance')
{_latest('raw_housekeeping', 'task_id', _TASK)}""",
    "latest_bill": f"""
SELECT * FROM raw_billing
WHERE bill_id IS NOT NULL AND total_amount >= 0 AND taxes >= 0 AND discounts >= 0
{_latest('raw_billing', 'bill_id', _BILL)}""",
    "silver_billing": f"""
SELECT bill_id, reservation_id, guest_id, total_amount, taxes, discounts, payment_mode, payment_time,
  {_TRUE.format('is_flagged')} AS is_flagged, {_LOADED}
FROM latest_bill""",
    **_versions("guest", "guest_id", _GUEST, GUEST_TRACKED, GUEST_OVERWRITE, _TIER_OK, "true"),
    **_versions(
        "room", "room_id", _ROOM, ROOM_TRACKED, ROOM_OVERWRITE, "capacity > 0 AND base_price >= 0", "capacity > 0"
    ),
    "dq_log": "\nUNION ALL\n".join(_FIRST_RULES.values()),
    "value_checks": "\nUNION ALL\n".join(_SECOND_RULES.values()),
    "dim_hotel": (
        "SELECT * FROM (VALUES " + _HOTEL_ROWS + ") "
        "h(hotel_sk, hotel_id, hotel_name, city, country, star_rating, total_rooms)"
    ),
    "dim_guest": f"""
SELECT row_number() OVER (ORDER BY guest_id, scd_version) AS guest_sk, guest_id, {_GUEST},
  scd_start_date, scd_end_date, is_current, scd_version
FROM guest_versions""",
    "dim_room": f"""
SELECT row_number() OVER (ORDER BY room_id, scd_version) AS room_sk, hotel_sk::BIGINT AS hotel_sk, room_id, {_ROOM},
  scd_start_date, scd_end_date, is_current, scd_version
FROM room_versions LEFT JOIN (SELECT hotel_id, hotel_sk FROM dim_hotel) USING (hotel_id)""",
    "guest_now": "SELECT guest_id AS gid, guest_sk FROM dim_guest WHERE is_current",
    "room_now": """
SELECT room_id AS rid, room_sk, hotel_sk, CASE WHEN hotel_sk IS NOT NULL THEN hotel_id END AS hotel_id, base_price
FROM dim_room WHERE is_current""",
    "stay": """
SELECT r.reservation_id, guest_sk, room_sk, hotel_sk, gid AS guest_id, rid AS room_id, hotel_id, check_in_date,
  check_out_date, length_of_stay, booking_channel, booking_time, cancellation_time, status,
  (base_price * length_of_stay)::DECIMAL(18,2) AS agreed_amount
FROM silver_reservations r LEFT JOIN guest_now ON gid = r.guest_id LEFT JOIN room_now ON rid = r.room_id""",
    "frequent_canceller": """
SELECT guest_sk FROM stay
WHERE status = 'cancelled' AND cancellation_time >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 8760 HOUR
GROUP BY ALL HAVING count(*) > 1""",
    "fact_reservation": """
SELECT a.*,
  a.status <> 'cancelled' AND EXISTS (
    FROM stay b WHERE b.room_sk = a.room_sk AND b.status <> 'cancelled' AND b.reservation_id <> a.reservation_id
      AND b.check_in_date < a.check_out_date AND a.check_in_date < b.check_out_date) AS is_double_booked,
  a.status = 'cancelled' AND EXISTS (FROM frequent_canceller f WHERE f.guest_sk = a.guest_sk) AS is_suspicious_cancel
FROM stay a""",
    "fact_housekeeping": f"""
SELECT h.task_id, room_sk, hotel_sk, rid AS room_id, hotel_id, task_type, assigned_staff, scheduled_time, start_time,
  end_time, duration_minutes, issue_detected_flag, coalesce(duration_minutes > {_LIMIT}, false) AS sla_breached,
  h.status
FROM silver_housekeeping h LEFT JOIN room_now ON rid = h.room_id""",
    "fact_billing": """
SELECT b.bill_id, s.rsv AS reservation_id, gid AS guest_id, guest_now.guest_sk, total_amount, taxes, discounts,
  (total_amount - discounts + taxes)::DECIMAL(18,2) AS net_amount, payment_mode, payment_time, is_flagged,
  coalesce(abs(total_amount - agreed_amount) > 500, false) AS billing_mismatch
FROM silver_billing b
LEFT JOIN (SELECT reservation_id AS rsv, agreed_amount FROM stay) s ON rsv = b.reservation_id
LEFT JOIN guest_now ON gid = b.guest_id""",
    "rooms_total": "SELECT count(*) AS total_rooms FROM dim_room WHERE is_current",
    "header": f"""
SELECT total_reservations, cancellations, completed_stays, total_revenue, total_bills, flagged_bills,
  {_pct('kept', 'greatest(total_rooms, 1)', 1)} AS occupancy_pct,
  round(total_revenue::DOUBLE / greatest(total_rooms, 1)::DOUBLE, 2) AS revpar, sla_pct,
  round(1 - flagged_bills::DOUBLE / greatest(total_bills, 1)::DOUBLE, 4) AS billing_accuracy,
  {_pct('completed_stays', 'greatest(total_reservations, 1)', 2)} AS conversion_pct,
  {_pct('cancellations', 'greatest(total_reservations, 1)', 1)} AS cancel_rate_pct,
  cancellations > 5 AS cancel_warning, sla_cleaning, sla_maintenance
FROM (SELECT count(*) AS total_reservations, {_n("status = 'cancelled'")} AS cancellations,
    {_n("status = 'completed'")} AS completed_stays, {_n("status <> 'cancelled'")} AS kept FROM fact_reservation),
  (SELECT coalesce({_money('total_amount')}, 0)::DECIMAL(38,2) AS total_revenue, count(*) AS total_bills,
    {_n('is_flagged')} AS flagged_bills FROM fact_billing),
  (SELECT round(100 * (1 - avg(sla_breached::INTEGER)), 1) AS sla_pct,
    coalesce(round(100 * (1 - avg(sla_breached::INTEGER) FILTER (WHERE task_type = 'cleaning')), 1), 0)
      AS sla_cleaning,
    coalesce(round(100 * (1 - avg(sla_breached::INTEGER) FILTER (WHERE task_type = 'maintenance')), 1), 0)
      AS sla_maintenance FROM fact_housekeeping),
  rooms_total""",
}


def _share(source: str, column: str, count: str) -> str:
    return (
        f"SELECT {column}, count(*) AS {count}, {_pct('count(*)', f'(SELECT count(*) FROM {source})', 1)} AS pct "
        f"FROM {source} GROUP BY ALL"
    )


def _counts(source: str, label: str, value: str, names: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS {label}, count(*) AS {value} FROM {source} WHERE {cond}" for name, cond in names.items()
    )


def _broken(child: str, ref: str, parent: str, label: str) -> str:
    return (
        f"SELECT '{label}' AS ri_check, count(*) AS broken_refs FROM {child} "
        f"ANTI JOIN (SELECT {ref} FROM {parent}) USING ({ref})"
    )


def _keys(table: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{key}' AS key_column, sum(n)::BIGINT AS total_rows, "
        f"{_n('n > 1')} AS repeated_keys, (sum(n) - count(*))::BIGINT AS surplus_rows "
        f"FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY ALL)"
    )


def _dense(table: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, count(*) AS total_rows, 1::BIGINT AS lowest, count(*) AS highest, "
        f"count(DISTINCT {key}) AS distinct_keys FROM {table}"
    )


def _histogram(source: str, column: str, groups: str, count: str, extra: str = "") -> str:
    x = f"{column}::DOUBLE"
    return f"""
SELECT {groups} bin, round(low + bin * ((high - low) / 20), 4) AS bin_start,
  round(low + (bin + 1) * ((high - low) / 20), 4) AS bin_end, count(*) AS {count} {extra}
FROM (SELECT {groups} low, high,
    least(floor(coalesce(({x} - low) / nullif(high - low, 0), 0) * 20), 19)::INTEGER AS bin
  FROM {source}, (SELECT min({x}) AS low, max({x}) AS high FROM {source}) WHERE {column} IS NOT NULL)
GROUP BY ALL"""


def _value_count(source: str, dimension: str, column: str) -> str:
    return (
        f"SELECT '{dimension}' AS dimension, {column} AS value, count(*) AS count FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY ALL"
    )


def _audit(table: str, name: str, measures: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, '{m}' AS measure, ({value})::DECIMAL(38,2) AS value FROM {table}"
        for m, value in {"total_rows": "count(*)", **measures}.items()
    )


def _unit(key: str, label: str) -> str:
    return f"(('0x' || left(md5('42:{label}:' || coalesce({key}, '')), 8))::BIGINT::DOUBLE / 4294967296)"


def _int(draw: str, low: int, high: int) -> str:
    return f"(floor({draw} * {high - low}) + {low})::INTEGER"


def _pick(draw: str, choices: list[tuple[str, float]]) -> str:
    whens = " ".join(f"WHEN {draw} < {edge} THEN {value}" for value, edge in choices[:-1])
    return f"CASE {whens} ELSE {choices[-1][0]} END"


def _normal(first: str, second: str, mean: int, deviation: int, low: int, high: int) -> str:
    raw = f"{mean} + {deviation} * sqrt(-2 * ln(1 - {first})) * cos(2 * pi() * {second})"
    return f"greatest({low}, least({high}, trunc({raw})))::INTEGER"


def _synthetic() -> dict[str, str]:
    g, m, r, t = "guest_id", "room_id", "reservation_id", "task_id"

    def hotel(key: str) -> str:
        return f"'H00' || ({_int(_unit(key, 'hotel'), 0, 5)} + 1)"

    def one_of(key: str, label: str, choices: str) -> str:
        return f"list_extract([{choices}], {_int(_unit(key, label), 0, choices.count(',') + 1)} + 1)"

    def day(label: str) -> str:
        return f"DATE '2024-01-01' + {_int(_unit(r, label), 0, 365)}"

    def room(key: str) -> str:
        return f"{_int(_unit(key, 'room'), 300, 350)}::VARCHAR"

    stay = _int(_unit(r, "stay"), 1, 10)
    task = _pick(_unit(t, "task"), [("'cleaning'", 0.7), ("'maintenance'", 1)])
    cleaning = _normal(_unit(t, "d1"), _unit(t, "d2"), 40, 15, 10, 90)
    repair = _normal(_unit(t, "d1"), _unit(t, "d2"), 100, 40, 20, 200)
    channel = _pick(
        _unit(r, "channel"),
        [("'Website'", 0.3), ("'Mobile App'", 0.55), ("'OTA'", 0.8), ("'Corporate'", 0.95), ("'Walk-in'", 1)],
    )
    status = _pick(_unit(r, "status"), [("'confirmed'", 0.35), ("'cancelled'", 0.5), ("'completed'", 1)])
    tier = _pick(_unit(g, "tier"), [("'Bronze'", 0.35), ("'Silver'", 0.65), ("'Gold'", 0.9), ("'Platinum'", 1)])
    kind = _pick(_unit(m, "type"), [("'Standard'", 0.45), ("'Deluxe'", 0.85), ("'Suite'", 1)])
    room_state = _pick(_unit(m, "state"), [("'Available'", 0.5), ("'Occupied'", 0.9), ("'Maintenance'", 1)])
    task_state = _pick(_unit(t, "state"), [("'Completed'", 0.8), ("'Pending'", 0.9), ("'In Progress'", 1)])
    mode = _pick(
        _unit(r, "mode"),
        [("'Credit Card'", 0.4), ("'UPI'", 0.7), ("'Cash'", 0.8), ("'Net Banking'", 0.9), ("'Debit Card'", 1)],
    )
    discount = _pick(_unit(r, "discount"), [("0", 0.6), ("20", 0.8), ("50", 0.95), ("100", 1)])
    countries = "'India', 'USA', 'UK', 'Australia', 'UAE'"
    cities = "'Mumbai', 'Delhi', 'Bangalore', 'Hyderabad', 'Chennai'"
    return {
        "synthetic_guests": f"""
SELECT 'G' || {g} AS guest_id, {tier} AS loyalty_tier, {one_of(g, 'country', countries)} AS country,
  {one_of(g, 'city', cities)} AS city
FROM raw_guests""",
        "synthetic_rooms": f"""
SELECT room_id, {hotel(m)} AS hotel_id, {kind} AS room_type, {one_of(m, 'capacity', '2, 2, 4')} AS capacity,
  {one_of(m, 'price', '80, 100, 120, 150, 200, 250, 300')}::DECIMAL(18,2) AS base_price, {room_state} AS status
FROM raw_rooms""",
        "synthetic_reservations": f"""
SELECT *, check_in_date + length_of_stay AS check_out_date FROM (
  SELECT 'R' || {r} AS reservation_id, 'G' || {r} AS guest_id, {room(r)} AS room_id, {hotel(r)} AS hotel_id,
    {day('day')} AS check_in_date, {stay} AS length_of_stay, {channel} AS booking_channel, {status} AS status,
    {_unit(r, 'double')} < 0.05 AS is_double_booked, {_unit(r, 'cancel')} < 0.04 AS is_suspicious_cancel
  FROM raw_reservations)""",
        "synthetic_housekeeping": f"""
SELECT *, duration_minutes > {_LIMIT} AS sla_breached FROM (
  SELECT 'T' || {t} AS task_id, {room(t)} AS room_id, {hotel(t)} AS hotel_id, {task} AS task_type,
    'Staff ' || {_int(_unit(t, 'staff'), 1, 6)} AS assigned_staff, {task_state} AS status,
    {_unit(t, 'issue')} < 0.20 AS issue_detected_flag,
    CASE WHEN {task} = 'cleaning' THEN {cleaning} ELSE {repair} END AS duration_minutes
  FROM raw_housekeeping)""",
        "synthetic_billing": f"""
SELECT *, (total_amount - discounts + taxes)::DECIMAL(18,2) AS net_amount FROM (
  SELECT *, round(total_amount * 0.10::DECIMAL(3,2), 2)::DECIMAL(18,2) AS taxes FROM (
    SELECT 'B' || {r} AS bill_id, 'R' || {r} AS reservation_id, 'G' || {r} AS guest_id,
      round(200 + {_unit(r, 'amount')} * 1300, 2)::DECIMAL(18,2) AS total_amount,
      ({discount})::DECIMAL(18,2) AS discounts, {mode} AS payment_mode, {day('paid')} AS payment_time,
      {_unit(r, 'flag')} < 0.08 AS is_flagged, {_unit(r, 'mismatch')} < 0.05 AS billing_mismatch
    FROM raw_reservations))""",
    }


_CURRENT_GUESTS = "(FROM guest_versions WHERE is_current)"
_CURRENT_ROOMS = "(FROM room_versions WHERE is_current)"
_SUMMARY = (
    ("KPI 1 — Room Occupancy Rate", "Occupied rooms / Total rooms × 100", "occupancy_pct", 60, (75, 50, 75), 1),
    (
        "KPI 2 — Booking Conversion Efficiency", "(Completed stays / Total reservations) × 100", "conversion_pct", 70,
        None, 1,
    ),
    ("KPI 3 — Housekeeping SLA (Cleaning)", "% cleaning tasks completed ≤ 45 min", "sla_cleaning", 85, None, 1),
    (
        "KPI 3 — Housekeeping SLA (Maintenance)", "% maintenance tasks completed ≤ 120 min", "sla_maintenance", 85,
        None, 1,
    ),
    ("KPI 4 — RevPAR", "Total revenue / Total available rooms", "revpar", 500, None, 1),
    (
        "KPI 5 — Billing Accuracy Index", "1 − (billing anomalies / total bills)", "billing_accuracy", 0.9,
        (95, 90, 95), 100,
    ),
)


def _summary_line(label: str, formula: str, value: str, limit: float, gauge: tuple | None, scale: int) -> str:
    target = delta = "NULL::DOUBLE"
    band = "NULL::VARCHAR"
    if gauge:
        goal, low, middle = gauge
        shown = f"round({value} * {scale}, 2)"
        target, delta = f"{goal}::DOUBLE", f"round({shown} - {goal}, 2)"
        band = f"CASE WHEN {shown} < {low} THEN 'low' WHEN {shown} < {middle} THEN 'middle' ELSE 'high' END"
    return (
        f"SELECT '{label}' AS kpi, '{formula}' AS formula, {value}::DOUBLE AS value, "
        f"if({value} > {limit}, 'PASS', 'LOW') AS status, {target} AS target, {delta} AS delta, {band} AS band "
        "FROM header"
    )


_OCCUPANCY = f"""
SELECT date, occupied_rooms, total_rooms, {_pct('occupied_rooms', 'total_rooms', 2)} AS occupancy_rate_pct
FROM (SELECT check_in_date AS date, count(DISTINCT room_sk) AS occupied_rooms
  FROM fact_reservation WHERE status <> 'cancelled' GROUP BY ALL), rooms_total"""

ORACLES: dict[str, str] = {
    **_FIRST_RULES,
    **_SECOND_RULES,
    **_synthetic(),
    "ingest_csv_nulls": """
SELECT * EXCLUDE (_file_name) REPLACE (
    CASE guest_id::BIGINT % 5 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE email END AS email,
    CASE guest_id::BIGINT % 7 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE phone END AS phone,
    CASE WHEN guest_id::BIGINT % 11 BETWEEN 1 AND 3 THEN NULL ELSE city END AS city,
    TIMESTAMP '2024-01-01 06:00:00' AS _loaded_at)
FROM raw_guests""",
    "ingest_try_cast": """
SELECT * EXCLUDE (_file_name) REPLACE (
    CASE WHEN reservation_id::BIGINT % 17 IS DISTINCT FROM 0 THEN check_in_date END AS check_in_date,
    CASE WHEN reservation_id::BIGINT % 19 IS DISTINCT FROM 0 THEN booking_time END AS booking_time,
    TIMESTAMP '2024-01-01 06:00:00' AS _loaded_at)
FROM raw_reservations""",
    "ingest_reject_rows": f"""
SELECT * EXCLUDE (_file_name) REPLACE (
    CASE WHEN issue_detected_flag IS NOT NULL THEN {_TRUE.format('issue_detected_flag')} END AS issue_detected_flag,
    TIMESTAMP '2024-01-01 06:00:00' AS _loaded_at)
FROM raw_housekeeping WHERE task_id::BIGINT % 31 IS DISTINCT FROM 0 AND task_id::BIGINT % 37 IS DISTINCT FROM 0""",
    "ingest_reject_log": """
SELECT task_id,
  if(task_id::BIGINT % 31 = 0, 'later', CASE WHEN nanosecond(start_time) > 0
    THEN rtrim(strftime(start_time, '%Y-%m-%d %H:%M:%S.%f'), '0') ELSE strftime(start_time, '%Y-%m-%d %H:%M:%S') END)
    AS start_time,
  if(task_id::BIGINT % 37 = 0, 'maybe', issue_detected_flag) AS issue_detected_flag,
  concat_ws(',', if(task_id::BIGINT % 31 = 0, 'start_time', NULL),
    if(task_id::BIGINT % 37 = 0, 'issue_detected_flag', NULL)) AS rejected_columns
FROM raw_housekeeping WHERE task_id::BIGINT % 31 = 0 OR task_id::BIGINT % 37 = 0""",
    "bronze_append_reload": "FROM silver_reservations",
    "bronze_stream_reload": "SELECT * EXCLUDE (_source_file) FROM silver_reservations",
    "bronze_stream_loads": """
SELECT 'regular-000000000' || (reservation_id::BIGINT % 2) AS load, count(*) AS loaded_rows
FROM raw_reservations GROUP BY ALL
UNION ALL SELECT 'again-0000000000', count(*) FROM raw_reservations""",
    "inc_file_filter": "FROM raw_guests_inc",
    "dedup_latest_bill": f"""
SELECT * FROM raw_billing {_latest('raw_billing', 'bill_id', _BILL)}""",
    "silver_guests": "FROM silver_guests",
    "silver_rooms": "FROM silver_rooms",
    "silver_reservations": "FROM silver_reservations",
    "silver_housekeeping": "FROM silver_housekeeping",
    "silver_billing": "FROM silver_billing",
    "billing_net_amount": """
SELECT *, (total_amount + taxes - discounts)::DECIMAL(18,2) AS net_amount FROM silver_billing""",
    "scd2_guests_merge": "FROM guest_versions",
    "scd2_rooms_merge": "FROM room_versions",
    "scd2_stream_merge": "SELECT * EXCLUDE (action) FROM room_versions",
    "scd2_rooms_merge_in_place": "SELECT * EXCLUDE (action) FROM room_versions",
    "scd2_guests_merge_in_place": "FROM guest_versions",
    "scd2_merge_summary": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS scd2_table, "
        + ", ".join(
            _n(f"action = '{a}'") + f" AS {a}_rows"
            for a in ("expired", "new_version", "inserted", "overwritten", "unchanged")
        )
        + f" FROM {table}"
        for name, table in (("VAL_GUESTS", "guest_versions"), ("VAL_ROOMS", "room_versions"))
    ),
    "scd2_guest_history": """
SELECT * EXCLUDE (action) FROM guest_versions QUALIFY count(*) OVER (PARTITION BY guest_id) > 1""",
    "scd2_room_history": """
SELECT * EXCLUDE (action) FROM room_versions QUALIFY count(*) OVER (PARTITION BY room_id) > 1""",
    "scd2_audit": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS scd2_table, max(scd_version) AS max_version, {_n('is_current')} AS current_records, "
        f"{_n('NOT is_current')} AS historical_records, count(*) AS total_records FROM {table}"
        for name, table in (("VAL_GUESTS", "guest_versions"), ("VAL_ROOMS", "room_versions"))
    ),
    "current_guests": "SELECT * EXCLUDE (action) FROM guest_versions WHERE is_current",
    "current_rooms": "SELECT * EXCLUDE (action) FROM room_versions WHERE is_current",
    "guest_versions": """
SELECT guest_id, name, loyalty_tier, scd_start_date, scd_end_date, is_current, scd_version, _source_file
FROM guest_versions""",
    "dq_guest_tier_profile": f"""
SELECT loyalty_tier, count(*) AS guest_count, NOT coalesce({_TIER_OK}, false) AS is_invalid
FROM raw_guests GROUP BY ALL""",
    "dq_log_full": "FROM dq_log UNION ALL FROM value_checks",
    "dq_log_rebuild": "SELECT * FROM dq_log WHERE error_type IN ('REFERENTIAL', 'TEMPORAL') UNION ALL FROM value_checks",
    "dq_log_summary": """
SELECT source_table, error_type, error_message, count(*) AS violations
FROM (FROM dq_log UNION ALL FROM value_checks) GROUP BY ALL""",
    "dq_log_by_table": "SELECT source_table, count(*) AS total_violations FROM dq_log GROUP BY ALL",
    "dq_unexplained_drops": "\nUNION ALL\n".join(
        f"SELECT '{raw}' AS source_table, {key} AS record_id FROM {raw} "
        f"WHERE NOT coalesce({valid}, false) AND NOT coalesce({reported}, false)"
        for raw, key, valid, reported in (
            ("raw_guests", "guest_id", f"guest_id IS NOT NULL AND {_TIER_OK}", "guest_id IS NULL OR email IS NULL"),
            (
                "raw_rooms",
                "room_id",
                "room_id IS NOT NULL AND capacity > 0 AND base_price >= 0 "
                "AND status IN ('Available', 'Occupied', 'Maintenance')",
                f"(capacity <= 0 OR base_price < 0 OR trim(status) NOT IN ('Available', 'Occupied', 'Maintenance')) "
                "AND room_id IS NOT NULL",
            ),
            (
                "raw_reservations",
                "reservation_id",
                "reservation_id IS NOT NULL AND guest_id IS NOT NULL AND room_id IS NOT NULL "
                "AND check_in_date <= check_out_date "
                "AND coalesce(cancellation_time < check_in_date + INTERVAL 1 DAY, true) "
                "AND lower(status) IN ('confirmed', 'cancelled', 'completed')",
                "reservation_id IS NOT NULL AND (check_out_date < check_in_date "
                "OR cancellation_time >= check_in_date + INTERVAL 1 DAY "
                "OR lower(trim(status)) NOT IN ('confirmed', 'cancelled', 'completed'))",
            ),
            (
                "raw_housekeeping",
                "task_id",
                "task_id IS NOT NULL AND room_id IS NOT NULL AND (end_time IS NULL OR start_time <= end_time) "
                "AND lower(trim(task_type)) IN ('cleaning', 'maintenance')",
                "task_id IS NOT NULL AND (end_time < start_time "
                "OR lower(trim(task_type)) NOT IN ('cleaning', 'maintenance') "
                "OR lower(trim(status)) NOT IN ('completed', 'pending', 'in progress', 'pending review'))",
            ),
            (
                "raw_billing",
                "bill_id",
                "bill_id IS NOT NULL AND total_amount >= 0 AND taxes >= 0 AND discounts >= 0",
                "bill_id IS NOT NULL AND (total_amount < 0 OR taxes < 0 OR discounts < 0)",
            ),
        )
    ),
    "dq_key_uniqueness": "\nUNION ALL\n".join(
        _keys(table, key)
        for table, key in (
            ("raw_guests", "guest_id"),
            ("raw_rooms", "room_id"),
            ("raw_reservations", "reservation_id"),
            ("raw_housekeeping", "task_id"),
            ("raw_billing", "bill_id"),
            ("dim_guest", "guest_sk"),
            ("dim_room", "room_sk"),
            ("fact_reservation", "reservation_id"),
            ("fact_housekeeping", "task_id"),
            ("fact_billing", "bill_id"),
        )
    ),
    "ri_checks": "\nUNION ALL\n".join(
        (
            _broken("silver_reservations", "guest_id", _CURRENT_GUESTS, "reservations.guest_id → guests"),
            _broken("silver_reservations", "room_id", _CURRENT_ROOMS, "reservations.room_id → rooms"),
            _broken("silver_housekeeping", "room_id", _CURRENT_ROOMS, "housekeeping.room_id → rooms"),
            _broken(
                "silver_billing", "reservation_id", "silver_reservations", "billing.reservation_id → reservations"
            ),
        )
    ),
    "temporal_checks": "\nUNION ALL\n".join(
        (
            _counts(
                "silver_reservations",
                "temporal_check",
                "violations",
                {
                    "RES: check_out < check_in": "check_out_date < check_in_date",
                    "RES: cancellation > check_in": "cancellation_time >= check_in_date + INTERVAL 1 DAY",
                },
            ),
            _counts(
                "silver_housekeeping",
                "temporal_check",
                "violations",
                {"HK: end_time < start_time": "end_time < start_time"},
            ),
            _counts(
                "silver_billing JOIN silver_reservations USING (reservation_id)",
                "temporal_check",
                "violations",
                {"BILLING: payment < booking_time": "payment_time < booking_time"},
            ),
        )
    ),
    "silver_row_counts": "\nUNION ALL\n".join(
        [
            _counts(
                table,
                "table_name",
                "total_rows",
                {
                    f"{name} (all versions)": "true",
                    f"{name} (current)": "is_current",
                    f"{name} (SCD2 history)": "NOT is_current",
                },
            )
            for name, table in (("VAL_GUESTS", "guest_versions"), ("VAL_ROOMS", "room_versions"))
        ]
        + [
            _counts(table, "table_name", "total_rows", {name: "true"})
            for name, table in (
                ("VAL_RESERVATIONS", "silver_reservations"),
                ("VAL_HOUSEKEEPING", "silver_housekeeping"),
                ("VAL_BILLING", "silver_billing"),
                ("DQ_EXCEPTION_LOG", "dq_log"),
            )
        ]
    ),
    "surrogate_keys": "\nUNION ALL\n".join(
        _dense(table, key)
        for table, key in (
            ("dim_guest", "guest_sk"),
            ("dim_room", "room_sk"),
            ("fact_reservation", "reservation_id"),
            ("fact_housekeeping", "task_id"),
            ("fact_billing", "bill_id"),
        )
    ),
    "dim_guest_load": "FROM dim_guest",
    "dim_room_load": "FROM dim_room",
    "fact_reservation_load": """
SELECT * EXCLUDE (guest_id, room_id, hotel_id, agreed_amount), false AS is_double_booked,
  false AS is_suspicious_cancel
FROM stay""",
    "fact_housekeeping_load": "SELECT * EXCLUDE (room_id, hotel_id) FROM fact_housekeeping",
    "fact_billing_load": """
SELECT * EXCLUDE (reservation_id, guest_id), reservation_id IS NOT NULL AS has_reservation FROM fact_billing""",
    "gold_reservation_wide": "FROM fact_reservation",
    "gold_housekeeping_wide": "FROM fact_housekeeping",
    "gold_billing_wide": """
SELECT f.*, agreed_amount FROM fact_billing f
LEFT JOIN (SELECT reservation_id, agreed_amount FROM stay) USING (reservation_id)""",
    "gold_load_audit": "\nUNION ALL\n".join(
        (
            _audit(
                "dim_guest",
                "DIM_GUEST",
                {"current_rows": _n("is_current"), "historical_rows": _n("NOT is_current")},
            ),
            _audit(
                "dim_room", "DIM_ROOM", {"current_rows": _n("is_current"), "historical_rows": _n("NOT is_current")}
            ),
            _audit(
                "stay",
                "FACT_RESERVATION",
                {s: _n(f"status = '{s}'") for s in ("confirmed", "cancelled", "completed")},
            ),
            _audit(
                "fact_housekeeping",
                "FACT_HOUSEKEEPING",
                {"sla_breaches": _n("sla_breached"), "issues_found": _n("issue_detected_flag")},
            ),
            _audit(
                "fact_billing",
                "FACT_BILLING",
                {
                    "flagged_bills": _n("is_flagged"),
                    "mismatch_bills": _n("billing_mismatch"),
                    "total_revenue": "sum(total_amount)",
                },
            ),
        )
    ),
    "anomaly_double_booking": "SELECT reservation_id, is_double_booked FROM fact_reservation",
    "anomaly_suspicious_cancel": "SELECT reservation_id, is_suspicious_cancel FROM fact_reservation",
    "anomaly_sla_refresh": "SELECT task_id, sla_breached FROM fact_housekeeping",
    "anomaly_billing_mismatch": "SELECT bill_id, billing_mismatch FROM fact_billing",
    "anomaly_summary": f"""
SELECT * FROM
  (SELECT {_n('is_double_booked')} AS double_bookings, {_n('is_suspicious_cancel')} AS suspicious_cancels
    FROM fact_reservation),
  (SELECT {_n('sla_breached')} AS sla_breaches, {_n('issue_detected_flag')} AS issues_found FROM fact_housekeeping),
  (SELECT {_n('is_flagged')} AS flagged_bills, {_n('billing_mismatch')} AS billing_mismatches FROM fact_billing)""",
    "kpi1_occupancy": _OCCUPANCY,
    "kpi1_occupancy_nightly": f"""
SELECT date, occupied_rooms, total_rooms, {_pct('occupied_rooms', 'total_rooms', 2)} AS occupancy_rate_pct
FROM (SELECT date, count(DISTINCT room_sk) AS occupied_rooms
  FROM (SELECT room_sk, check_in_date + unnest(range(length_of_stay))::INTEGER AS date FROM fact_reservation
    WHERE status <> 'cancelled' AND room_sk IS NOT NULL)
  GROUP BY ALL), rooms_total""",
    "kpi1_first_days": f"SELECT 'KPI 1 — Occupancy Rate' AS kpi, * FROM ({_OCCUPANCY}) ORDER BY date LIMIT 5",
    "kpi2_conversion": f"""
SELECT total_reservations, completed_stays, cancellations,
  {_pct('completed_stays', 'total_reservations', 2)} AS conversion_pct
FROM (SELECT count(*) AS total_reservations, {_n("status = 'completed'")} AS completed_stays,
  {_n("status = 'cancelled'")} AS cancellations FROM fact_reservation)""",
    "kpi3_sla": f"""
SELECT task_type, count(*) AS total_tasks, {_n('NOT sla_breached')} AS on_time_tasks,
  {_n('sla_breached')} AS breached_tasks, {_pct(_n('NOT sla_breached'), 'count(*)', 2)} AS sla_compliance_pct,
  {_mean('duration_minutes', 1)} AS avg_duration_min, {_LIMIT} AS sla_threshold_min
FROM fact_housekeeping WHERE duration_minutes IS NOT NULL GROUP BY task_type""",
    "kpi4_revpar": f"""
SELECT total_revenue, total_rooms, round(total_revenue::DOUBLE / nullif(total_rooms, 0)::DOUBLE, 2) AS revpar
FROM (SELECT {_money('total_amount')} AS total_revenue
  FROM fact_billing SEMI JOIN (FROM fact_reservation WHERE status <> 'cancelled') USING (reservation_id)), rooms_total
""",
    "kpi5_billing_accuracy": f"""
SELECT count(*) AS total_bills, {_n('is_flagged')} AS flagged_bills, {_n('billing_mismatch')} AS mismatch_bills,
  {_n('is_flagged OR billing_mismatch')} AS total_anomalies,
  round(1 - {_n('is_flagged OR billing_mismatch')}::DOUBLE / nullif(count(*), 0)::DOUBLE, 4)
    AS billing_accuracy_index
FROM fact_billing""",
    "guest_tier_distribution": _share(_CURRENT_GUESTS, "loyalty_tier", "guest_count"),
    "guests_by_country": f"SELECT country, count(*) AS guest_count FROM {_CURRENT_GUESTS} GROUP BY ALL",
    "room_status_stats": f"""
SELECT status, count(*) AS room_count, {_mean('base_price', 2)} AS avg_price, min(base_price) AS min_price,
  max(base_price) AS max_price
FROM {_CURRENT_ROOMS} GROUP BY ALL""",
    "rooms_by_hotel": f"""
SELECT hotel_id, count(*) AS total_rooms, {_n("status = 'Available'")} AS available,
  {_n("status = 'Occupied'")} AS occupied, {_n("status = 'Maintenance'")} AS maintenance,
  {_mean('base_price', 2)} AS avg_price
FROM {_CURRENT_ROOMS} GROUP BY ALL""",
    "reservation_status_stats": f"""
SELECT status, count(*) AS total, {_mean('length_of_stay', 1)} AS avg_stay_days,
  min(check_in_date) AS earliest_checkin, max(check_out_date) AS latest_checkout
FROM silver_reservations GROUP BY ALL""",
    "bookings_by_channel": _share("silver_reservations", "booking_channel", "bookings"),
    "cancelled_detail": """
SELECT reservation_id, guest_id, room_id, check_in_date, cancellation_time,
  date_diff('day', cancellation_time::DATE, check_in_date)::INTEGER AS days_before_checkin
FROM silver_reservations WHERE status = 'cancelled'""",
    "sla_by_task_type": f"""
SELECT task_type, count(*) AS total_tasks, {_mean('duration_minutes', 1)} AS avg_duration_min,
  min(duration_minutes) AS min_duration, max(duration_minutes) AS max_duration,
  {_n(f'duration_minutes > {_LIMIT}')} AS sla_breaches,
  {_pct(_n(f'duration_minutes <= {_LIMIT}'), 'count(*)', 1)} AS sla_compliance_pct
FROM silver_housekeeping WHERE duration_minutes IS NOT NULL GROUP BY task_type""",
    "issues_by_room": f"""
SELECT room_id, count(*) AS total_tasks, {_n('issue_detected_flag')} AS issues_found,
  {_mean('duration_minutes', 1)} AS avg_duration_min
FROM silver_housekeeping GROUP BY ALL""",
    "staff_performance": f"""
SELECT assigned_staff, count(*) AS tasks_done, {_mean('duration_minutes', 1)} AS avg_duration_min,
  {_n('issue_detected_flag')} AS issues_reported
FROM silver_housekeeping GROUP BY ALL""",
    "housekeeping_listing": "FROM silver_housekeeping",
    "revenue_by_payment_mode": f"""
SELECT payment_mode, count(*) AS transactions, {_money('total_amount')} AS total_revenue,
  {_mean('total_amount', 2)} AS avg_bill, {_money('taxes')} AS total_taxes, {_money('discounts')} AS total_discounts
FROM silver_billing GROUP BY ALL""",
    "flagged_bills": """
SELECT bill_id, reservation_id, guest_id, total_amount, payment_mode, payment_time, is_flagged
FROM silver_billing WHERE is_flagged""",
    "billing_stats": f"""
SELECT count(*) AS total_bills, {_money('total_amount')} AS total_revenue,
  {_mean('total_amount', 2)} AS avg_bill_amount, {_money('taxes')} AS total_taxes,
  {_money('discounts')} AS total_discounts, {_n('is_flagged')} AS flagged_count,
  {_pct(_n('is_flagged'), 'count(*)', 2)} AS fraud_pct,
  round(1 - {_n('is_flagged')}::DOUBLE / nullif(count(*), 0)::DOUBLE, 4) AS billing_accuracy_index
FROM silver_billing""",
    "dash_slicers": """
SELECT 'reservation' AS entity, reservation_id AS record_id, booking_channel AS slice_value FROM fact_reservation
WHERE hotel_id = 'H002' AND booking_channel IN ('1-URGENT', '2-HIGH')
UNION ALL
SELECT 'guest', guest_id, loyalty_tier FROM dim_guest WHERE is_current AND loyalty_tier IN ('Gold', 'Platinum')""",
    "dash_header_kpis": "SELECT * EXCLUDE (sla_cleaning, sla_maintenance) FROM header",
    "dash_monthly_bookings": """
SELECT strftime(check_in_date, '%Y-%m') AS month, count(*) AS bookings FROM fact_reservation GROUP BY ALL""",
    "dash_value_counts": "\nUNION ALL\n".join(
        (
            _value_count("(FROM dim_guest WHERE is_current)", "tier", "loyalty_tier"),
            _value_count("(FROM dim_room WHERE is_current)", "room_type", "room_type"),
            _value_count("(FROM dim_room WHERE is_current)", "room_status", "status"),
            _value_count("fact_reservation", "channel", "booking_channel"),
            _value_count("fact_reservation", "reservation_status", "status"),
        )
    ),
    "dash_los_distribution": """
SELECT length_of_stay AS nights, count(*) AS count FROM fact_reservation GROUP BY ALL""",
    "dash_revenue_by_channel": f"""
SELECT booking_channel, coalesce({_money('total_amount')}, 0)::DECIMAL(38,2) AS revenue,
  count(r.reservation_id) AS bookings
FROM fact_reservation r LEFT JOIN (SELECT reservation_id, total_amount FROM fact_billing) USING (reservation_id)
WHERE booking_channel IS NOT NULL GROUP BY ALL""",
    "dash_reservation_listing": """
SELECT reservation_id, guest_id, room_id, hotel_id, check_in_date, check_out_date, length_of_stay, booking_channel,
  status
FROM fact_reservation""",
    "dash_sla_split": f"""
SELECT task_type, count(task_id) AS total, {_n('sla_breached')} AS breached, {_n('NOT sla_breached')} AS passed
FROM fact_housekeeping GROUP BY ALL""",
    "dash_duration_histogram": _histogram(
        "fact_housekeeping", "duration_minutes", "task_type,", "tasks", f", {_LIMIT} AS sla_minutes"
    ),
    "dash_staff": f"""
SELECT assigned_staff, count(task_id) AS tasks, {_mean('duration_minutes', 1)} AS avg_dur,
  {_n('issue_detected_flag')} AS issues, {_n('sla_breached')} AS breaches
FROM fact_housekeeping WHERE assigned_staff IS NOT NULL GROUP BY ALL""",
    "dash_issue_pct_by_hotel": f"""
SELECT hotel_id, {_n('issue_detected_flag')} AS issues, count(task_id) AS total,
  {_pct(_n('issue_detected_flag'), 'count(task_id)', 1)} AS issue_pct
FROM fact_housekeeping WHERE hotel_id IS NOT NULL GROUP BY ALL""",
    "dash_revenue_by_mode": f"""
SELECT payment_mode, coalesce({_money('total_amount')}, 0)::DECIMAL(38,2) AS revenue FROM fact_billing
WHERE payment_mode IS NOT NULL GROUP BY ALL""",
    "dash_amount_histogram": _histogram("fact_billing", "total_amount", "", "bills"),
    "dash_flagged": """
SELECT bill_id, reservation_id, guest_id, total_amount, payment_mode, is_flagged FROM fact_billing WHERE is_flagged""",
    "dash_billing_listing": """
SELECT bill_id, reservation_id, total_amount, taxes, discounts, net_amount, payment_mode, is_flagged
FROM fact_billing""",
    "dash_anomaly_counts": f"""
SELECT * FROM
  (SELECT {_n('is_double_booked')} AS double_bookings, {_n('is_suspicious_cancel')} AS suspicious_cancels
    FROM fact_reservation),
  (SELECT {_n('sla_breached')} AS sla_breaches FROM fact_housekeeping),
  (SELECT {_n('billing_mismatch')} AS billing_mismatches FROM fact_billing)""",
    "dash_double_booked": """
SELECT reservation_id, guest_id, room_id, check_in_date, check_out_date, status FROM fact_reservation
WHERE is_double_booked""",
    "dash_suspicious": """
SELECT reservation_id, guest_id, check_in_date, status FROM fact_reservation WHERE is_suspicious_cancel""",
    "dash_sla_breaches": """
SELECT task_id, room_id, hotel_id, task_type, assigned_staff, duration_minutes, status FROM fact_housekeeping
WHERE sla_breached""",
    "dash_kpi_summary": "\nUNION ALL\n".join(_summary_line(*line) for line in _SUMMARY),
}

# Tables rebuilt in place and audits taken while writing have the results of those that are recomputed.
for same, recomputed in {
    "dq_log_rebuild_in_place": "dq_log_rebuild",
    "audit_row_counts": "silver_row_counts",
    "audit_merges": "scd2_merge_summary",
    "audit_gold_loads": "gold_load_audit",
}.items():
    ORACLES[same] = ORACLES[recomputed]


def _needed(text: str, found: dict[str, None]) -> None:
    for name in BLOCKS:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(BLOCKS[name], found)
            found[name] = None


def oracle_text(name: str) -> str:
    """The SQL of one query with the building blocks it refers to in front."""
    blocks: dict[str, None] = {}
    _needed(ORACLES[name], blocks)
    with_list = ",\n".join(f"{b} AS (\n{BLOCKS[b].strip()}\n)" for b in blocks)
    return f"WITH {with_list}\n{ORACLES[name].strip()}"
