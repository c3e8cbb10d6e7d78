import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ouzel.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="ouzel-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("orders", "embeddings", "events"):
        for sf, tag in ((SF_SMALL, "s"), (SF_CHECK, "c")):
            con.execute(f"CREATE VIEW {t}_{tag} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con
