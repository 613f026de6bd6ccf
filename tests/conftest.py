import duckdb
import pytest
from helpers import TABLES, sample_dir

from innledger.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """DuckDB connections with the sample tables as views, by scale."""
    open_connections = {}

    def connect(sf):
        if sf not in open_connections:
            con = duckdb.connect()
            for table in TABLES:
                con.execute(f"create view {table} as from '{sample_dir(sf)}/{table}.parquet'")
            open_connections[sf] = con
        return open_connections[sf]

    return connect
