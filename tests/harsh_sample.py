"""A harsher copy of the smallest sample: repeated keys with other content, hot keys, missing values."""

import duckdb

COPIES = {
    "customer": """
        FROM customer
        UNION ALL SELECT c_custkey % 40, c_name, (c_nationkey + 1) % 25, -c_acctbal, c_mktsegment FROM customer
        UNION ALL SELECT if(c_custkey % 3 = 0, NULL, 7), NULL, c_nationkey, c_acctbal,
            if(c_custkey % 2 = 0, c_mktsegment, NULL) FROM customer""",
    "part": """
        FROM part
        UNION ALL SELECT p_partkey % 30, p_name, if(p_partkey % 4 = 0, NULL, p_brand), p_type, p_size + 1,
            p_retailprice + 10 FROM part""",
    "orders": """
        SELECT if(o_orderkey % 3 = 0, 42, o_orderkey % 500) AS o_orderkey,
            CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 7 ELSE o_custkey END AS o_custkey,
            o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
        UNION ALL SELECT if(o_orderkey % 50 = 0, NULL, 2000 + o_orderkey), o_custkey,
            if(o_orderkey % 5 = 0, NULL, o_orderstatus), o_totalprice, date_trunc('month', o_orderdate),
            o_orderpriority FROM orders""",
    "events": """
        SELECT event_id % 700 AS event_id, ts,
            CASE WHEN event_id % 3 = 0 THEN 5 WHEN event_id % 20 = 1 THEN NULL ELSE user_id END AS user_id,
            if(event_id % 11 = 0, NULL, event_type) AS event_type, value, props FROM events""",
    "lineitem": """
        SELECT * REPLACE (
            CASE WHEN l_orderkey % 3 = 0 THEN 42 WHEN l_orderkey % 31 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey,
            if(l_orderkey % 3 = 0, 1, l_linenumber) AS l_linenumber,
            if(l_partkey % 37 = 0, NULL, l_extendedprice) AS l_extendedprice,
            if(l_partkey % 2 = 0, date_trunc('year', l_shipdate), l_shipdate) AS l_shipdate) FROM lineitem""",
}


def write_harsh_sample(source, target, tables):
    con = duckdb.connect()
    for table in tables:
        con.execute(f"CREATE VIEW {table} AS FROM '{source}/{table}.parquet'")
    for table in tables:
        con.execute(f"COPY ({COPIES.get(table, 'FROM ' + table)}) TO '{target}/{table}.parquet'")
