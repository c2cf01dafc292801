import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    shared = tempfile.mkdtemp(prefix="hexdrift-test-")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def _plain(v):
    import math
    from decimal import Decimal

    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v


def same_rows(frame, relation):
    """Compare a DataFrame with a DuckDB relation, whatever the order of rows and columns."""
    cols = sorted(frame.columns)
    assert cols == sorted(relation.columns)
    mine = sorted((tuple(_plain(r[c]) for c in cols) for r in frame.collect()), key=repr)
    at = [relation.columns.index(c) for c in cols]
    theirs = sorted((tuple(_plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs, strict=True):
        assert all(x == y or isinstance(x, (int, float)) and isinstance(y, (int, float)) and abs(x - y) < 2e-5 for x, y in zip(a, b, strict=True)), (a, b)
