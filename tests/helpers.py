"""Helpers the tests import by name; fixtures are in conftest.py."""

import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def sample_dir(sf):
    return f"/root/testdata/sf{sf}"


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return str(value) if isinstance(value, decimal.Decimal) else repr(value)


def table_of(columns, rows):
    """Columns by name and rows in any order, ready to compare."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=str)


def spark_table(df):
    return table_of(df.columns, df.collect())


def duck_table(con, sql):
    result = con.execute(sql)
    return table_of([d[0] for d in result.description], result.fetchall())


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
