"""Raw hotel tables as views over the star-schema sample tables.

The sample folder holds no hotel data, so every raw entity is a projection of one of its tables over
all rows. Faults are planted by key so that each data-quality rule has something to find. The increments
are full extracts in which every tenth key has new values. The text runs unchanged in Spark and in the
SQL engine used for checking.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = {
    "raw_guests": ("customer", "nation"),
    "raw_guests_inc": ("customer", "nation"),
    "raw_rooms": ("part",),
    "raw_rooms_inc": ("part",),
    "raw_reservations": ("orders",),
    "raw_housekeeping": ("events",),
    "raw_billing": ("lineitem",),
}

VIEWS = {
    "raw_guests": """
SELECT CAST(c_custkey AS STRING) AS guest_id, c_name AS name,
  DATE '1950-01-01' + CAST(c_custkey % 15000 AS INT) AS dob,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE c_name || '@mail.test' END AS email,
  'P' || CAST(c_custkey AS STRING) AS phone, 'A' || CAST(c_custkey AS STRING) AS address,
  'City ' || CAST(c_nationkey AS STRING) AS city, n_name AS country,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Bronze' WHEN 'FURNITURE' THEN 'Silver' WHEN 'HOUSEHOLD' THEN 'Gold'
    WHEN 'AUTOMOBILE' THEN 'Platinum' ELSE CASE WHEN c_custkey % 17 = 0 THEN 'Diamond' ELSE 'Bronze' END
    END AS loyalty_tier,
  DATE '2015-01-01' + CAST(c_custkey % 3000 AS INT) AS registration_date,
  {ntz}'2024-01-01 00:00:00' AS _loaded_at, 'guests_base.csv' AS _file_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_guests_inc": """
SELECT CAST(c_custkey AS STRING) AS guest_id, c_name AS name,
  DATE '1950-01-01' + CAST(c_custkey % 15000 AS INT) AS dob,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN c_custkey % 10 = 3 THEN c_name || '@new.test' WHEN c_custkey % 53 = 0 THEN NULL
    ELSE c_name || '@mail.test' END AS email,
  'P' || CAST(c_custkey AS STRING) AS phone, 'A' || CAST(c_custkey AS STRING) AS address,
  'City ' || CAST(c_nationkey AS STRING) AS city, n_name AS country,
  CASE WHEN c_custkey % 10 = 3 THEN
    CASE WHEN c_acctbal > 9000 THEN 'Platinum' WHEN c_acctbal < 0 THEN 'Diamond' ELSE 'Silver' END
    ELSE CASE c_mktsegment WHEN 'BUILDING' THEN 'Bronze' WHEN 'FURNITURE' THEN 'Silver' WHEN 'HOUSEHOLD' THEN 'Gold'
    WHEN 'AUTOMOBILE' THEN 'Platinum' ELSE CASE WHEN c_custkey % 17 = 0 THEN 'Diamond' ELSE 'Bronze' END END
    END AS loyalty_tier,
  DATE '2015-01-01' + CAST(c_custkey % 3000 AS INT) AS registration_date,
  {ntz}'2024-02-01 00:00:00' AS _loaded_at, 'guests_inc_1.csv' AS _file_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_rooms": """
SELECT CAST(p_partkey AS STRING) AS room_id, 'H00' || CAST(p_partkey % 6 + 1 AS STRING) AS hotel_id,
  p_type AS room_type, p_size % 12 AS floor,
  CASE WHEN p_partkey % 41 = 0 THEN 0 ELSE p_size % 4 + 1 END AS capacity, p_brand AS amenities,
  CASE WHEN p_partkey % 43 = 0 THEN 'Closed' WHEN p_partkey % 10 < 5 THEN 'Available'
    WHEN p_partkey % 10 < 9 THEN 'Occupied' ELSE 'Maintenance' END AS status,
  CAST(CASE WHEN p_partkey % 47 = 0 THEN -p_retailprice ELSE p_retailprice END AS DECIMAL(18,2)) AS base_price,
  {ntz}'2024-01-01 00:00:00' AS _loaded_at, 'rooms_base.csv' AS _file_name
FROM part""",
    "raw_rooms_inc": """
SELECT CAST(p_partkey AS STRING) AS room_id, 'H00' || CAST(p_partkey % 6 + 1 AS STRING) AS hotel_id,
  p_type AS room_type, p_size % 12 AS floor,
  CASE WHEN p_partkey % 10 <> 7 AND p_partkey % 41 = 0 THEN 0 ELSE p_size % 4 + 1 END AS capacity,
  CASE WHEN p_partkey % 20 = 7 THEN p_brand || ';Balcony' ELSE p_brand END AS amenities,
  CASE WHEN p_partkey % 10 = 7 THEN 'Available' WHEN p_partkey % 43 = 0 THEN 'Closed'
    WHEN p_partkey % 10 < 5 THEN 'Available' WHEN p_partkey % 10 < 9 THEN 'Occupied' ELSE 'Maintenance' END AS status,
  CAST(CASE WHEN p_partkey % 30 = 7 THEN p_retailprice + 50
    WHEN p_partkey % 10 <> 7 AND p_partkey % 47 = 0 THEN -p_retailprice ELSE p_retailprice END
    AS DECIMAL(18,2)) AS base_price,
  {ntz}'2024-02-01 00:00:00' AS _loaded_at, 'rooms_inc_1.csv' AS _file_name
FROM part""",
    "raw_reservations": """
SELECT CAST(o_orderkey AS STRING) AS reservation_id,
  CASE WHEN o_orderkey % 211 = 0 THEN 'G?' ELSE CAST(o_custkey AS STRING) END AS guest_id,
  CAST(CAST(FLOOR(o_orderkey / 10.0) AS BIGINT) AS STRING) AS room_id,
  CAST(o_orderdate AS DATE) AS check_in_date,
  CAST(o_orderdate AS DATE)
    + CAST(CASE WHEN o_orderkey % 197 = 0 THEN -2 ELSE o_orderkey % 10 END AS INT) AS check_out_date,
  o_orderpriority AS booking_channel,
  o_orderdate - INTERVAL '1' DAY * CAST(o_orderkey % 30 AS INT) AS booking_time,
  CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL '1' HOUR *
    CAST(CASE WHEN o_orderkey % 13 = 0 THEN 60 ELSE -(o_orderkey % 72) END AS INT) END AS cancellation_time,
  CASE WHEN o_orderkey % 199 = 0 THEN 'No-Show' WHEN o_orderstatus = 'F' THEN 'Completed'
    WHEN o_orderstatus = 'O' THEN 'Confirmed' ELSE 'Cancelled' END AS status,
  {ntz}'2024-01-01 00:00:00' AS _loaded_at, 'reservations_base.csv' AS _file_name
FROM orders""",
    "raw_housekeeping": """
SELECT CAST(event_id AS STRING) AS task_id, CAST(user_id AS STRING) AS room_id,
  CASE WHEN event_type IN ('click', 'view') THEN ' Cleaning'
    WHEN event_type IN ('purchase', 'signup') THEN 'maintenance' ELSE 'inspection' END AS task_type,
  'S' || CAST(event_id % 7 AS STRING) AS assigned_staff, ts AS scheduled_time, ts AS start_time,
  CASE WHEN event_id % 83 = 0 THEN NULL ELSE ts + INTERVAL '1' SECOND *
    CAST(CASE WHEN event_id % 89 = 0 THEN -600 ELSE FLOOR(value * 60) END AS INT) END AS end_time,
  CASE event_id % 5 WHEN 0 THEN 'Y' WHEN 1 THEN ' true ' WHEN 2 THEN 'no' WHEN 3 THEN '0' END AS issue_detected_flag,
  CASE WHEN event_id % 97 = 0 THEN 'Skipped' WHEN event_id % 9 = 0 THEN 'In Progress' ELSE ' Completed' END AS status,
  {ntz}'2024-01-01 00:00:00' AS _loaded_at, 'housekeeping_base.csv' AS _file_name
FROM events""",
    "raw_billing": """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS bill_id,
  CASE WHEN l_partkey % 401 = 0 THEN 'R?' ELSE CAST(l_orderkey AS STRING) END AS reservation_id,
  CAST(l_suppkey AS STRING) AS guest_id,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_partkey % 103 = 0 THEN -1 ELSE 1 END
    AS DECIMAL(18,2)) AS total_amount,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))
    * CASE WHEN l_partkey % 107 = 0 THEN -1 ELSE 1 END AS DECIMAL(18,2)) AS taxes,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))
    * CASE WHEN l_partkey % 109 = 0 THEN -1 ELSE 1 END AS DECIMAL(18,2)) AS discounts,
  l_returnflag || l_linestatus AS payment_mode, l_shipdate AS payment_time,
  CASE WHEN l_quantity > 45 THEN 'yes' ELSE 'N' END AS is_flagged,
  l_shipdate AS _loaded_at, 'billing_base.csv' AS _file_name
FROM lineitem""",
}


def view_sql(name: str, clock: str = "TIMESTAMP") -> str:
    """Text of one view; `clock` is the literal prefix of a timestamp without zone."""
    return VIEWS[name].replace("{ntz}", clock + " ").strip()


def raw_view(spark: SparkSession, name: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """One raw entity; `read` opens a sample table."""
    text = view_sql(name, "TIMESTAMP_NTZ")
    tables = {t: read(t) for t in SOURCE_TABLES[name]}
    for table in tables:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}").replace(f"JOIN {table}", f"JOIN {{{table}}}")
    return spark.sql(text, **tables)
