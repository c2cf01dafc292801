"""Counties from number 1,000 on, of which several have one code, against SQL."""

import pytest
from conftest import same_rows

from hexdrift.plans import catalog


@pytest.fixture(scope="module")
def far(tmp_path_factory):
    """Ten counties of one code, some of those before, and masts among them."""
    import duckdb

    d, con = tmp_path_factory.mktemp("far"), duckdb.connect()
    con.sql(f"COPY (SELECT k AS p_partkey FROM range(101000) t(k) WHERE k >= 99500 OR k < 700) TO '{d}/part.parquet'")
    con.sql(f"COPY (SELECT k AS c_custkey, (k * 37 % 20000 - 10000) / 3e0 AS c_acctbal FROM range(3000) t(k)) TO '{d}/customer.parquet'")
    con.sql(f"COPY (SELECT k AS o_orderkey, k AS o_custkey, DATE '1995-01-01' AS o_orderdate FROM range(10) t(k)) TO '{d}/orders.parquet'")
    for t in ("part", "customer", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return str(d), con


def _check(spark, far, name):
    d, con = far
    frame = catalog.QUERIES[name](spark, d)
    assert frame.count() > 0
    same_rows(frame, con.sql(catalog.ORACLES[name]))


def test_area_of_codes_with_several_counties(spark, far):
    _check(spark, far, "g4_county_area_shoelace")


def test_masts_in_codes_with_several_counties(spark, far):
    _check(spark, far, "j8_point_in_polygon")


def test_edge_distance_in_codes_with_several_counties(spark, far):
    _check(spark, far, "a10_edge_distance")
