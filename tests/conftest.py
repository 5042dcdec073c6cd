import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from workgrid.session import local_session

    s = local_session(4, app="workgrid-tests", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def params():
    from workgrid.config import fixture_params

    return fixture_params()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from workgrid.sources.driver import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con
