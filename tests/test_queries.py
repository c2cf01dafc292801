"""Every registered query of the coverage model against its SQL."""

import pytest
from conftest import same_rows

from hexdrift.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, data, name):
    frame = catalog.QUERIES[name](spark, data)
    if name in catalog.ORACLES:
        same_rows(frame, duck.sql(catalog.ORACLES[name]))
    else:
        assert frame.count() >= 0


def test_flag_math_rounds_as_sql(spark, duck, monkeypatch):
    """Halves that a double misses by its last bit: SQL rounds 0.0585 less one bit to 0.059."""
    from hexdrift.operators import score
    from hexdrift.plans import coverage

    names, odd = list(score.contributions()), [0.058499999999999996, 0.0585, 0.0005, 1.0005, 0.00235, 0.0, 1.0, 2 / 3]
    fields = ", ".join(f"{n} double, score_contribution_{n} double" for n in names)
    rows = spark.createDataFrame([(1, "5G", str(i), *[x] * (2 * len(names))) for i, x in enumerate(odd)], f"provider_id int, technology string, county_geoid string, {fields}")
    monkeypatch.setattr(coverage, "scored", lambda spark, d: rows)
    got = {(r.county_geoid, r.feature): (r.value, r.points) for r in catalog.QUERIES["c4_flag_math"](spark, "").collect()}
    want = [duck.execute("SELECT round(?::DOUBLE, 3), round(?::DOUBLE, 4)", [x, x]).fetchone() for x in odd]
    assert got == {(str(i), n): w for i, w in enumerate(want) for n in names}
