from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillwork.session import local_session  # noqa: E402
from tillwork.sources.contracts import schema_of  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
USED_TABLES = ["nation", "customer", "supplier", "orders", "lineitem", "events"]


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, memory="4g", app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def table(spark):
    """Build a small relation from dicts; columns not named are NULL."""

    def build(relation: str, *rows: dict):
        schema = schema_of(relation)
        data = [tuple(row.get(name) for name in schema.names) for row in rows]
        return spark.createDataFrame(data, schema)

    return build


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in USED_TABLES:
        con.execute(f"create view {name} as select * from '{directory}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def skewed_dir(tmp_path_factory):
    """The smallest tables with a third of the rows moved to one key each.

    One order holds a third of the lines, one supplier another third, one
    customer a third of the orders.
    """
    target = tmp_path_factory.mktemp("skewed")
    con = duck("/root/testdata/sf0.001")
    changed = {
        "orders": """select * replace (if(o_orderkey % 3 = 0, 7, o_custkey) as o_custkey)
                     from orders""",
        "lineitem": """select * replace (
                           if(rid % 3 = 0, (select min(o_orderkey) from orders), l_orderkey)
                               as l_orderkey,
                           if(rid % 3 <> 2, 8, l_suppkey) as l_suppkey)
                       from (select *, row_number() over () as rid from lineitem)""",
    }
    for name in USED_TABLES:
        body = changed.get(name, f"select * from {name}")
        drop = "select * exclude (rid) from" if name == "lineitem" else "select * from"
        con.execute(f"copy ({drop} ({body})) to '{target}/{name}.parquet' (format parquet)")
    return str(target)
