"""Small cases of the model's rules."""

import pytest
from pyspark.sql import functions as F

from hexdrift.operators import change, layers, score, spatial


def test_status_gates(spark):
    rows = [(0, "A", 1, None, -80.0), (0, "A", 2, -80.0, None), (0, "A", 3, -90.0, -85.0), (0, "A", 4, -85.0, -90.0), (0, "A", 5, -85.0, -89.9)]
    obs = spark.createDataFrame(rows, "provider_id int, technology string, cell long, p double, c double")
    prior = obs.where("p IS NOT NULL").select("provider_id", "technology", "cell", F.col("p").alias("signal_dbm"))
    current = obs.where("c IS NOT NULL").select("provider_id", "technology", "cell", F.col("c").alias("signal_dbm"))
    got = {r.cell: r.status for r in change.layer_change(prior, current, ["provider_id", "technology", "cell"]).collect()}
    assert got == {1: "new", 2: "lost", 3: "upgraded", 4: "downgraded", 5: "unchanged"}


def test_weights_are_bounded():
    with pytest.raises(ValueError):
        score.contributions({"added_frac_of_county": 0.3})


def test_nearest_matches_brute_force(spark):
    import random

    rnd = random.Random(1)
    a = [(i, rnd.uniform(0, 9000), rnd.uniform(0, 9000)) for i in range(150)]
    b = [(i, rnd.uniform(0, 9000), rnd.uniform(0, 9000)) for i in range(40)]
    left, right = (spark.createDataFrame(x, f"{n} long, x_m double, y_m double") for x, n in ((a, "a"), (b, "b")))
    got = {r.a: r.b for r in spatial.nearest(left, right, 1000.0, [], ["a"], "b").collect()}
    want = {}
    for i, x, y in a:
        d, j = min((round(((x - u) ** 2 + (y - v) ** 2) ** 0.5, 3), j) for j, u, v in b)
        if d <= 1000:
            want[i] = j
    assert got == want


def test_signal_coercion(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",), ("-91.5",), ("x",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in df.select(layers.signal(F.col("v"))).collect()] == [-105.0, -95.0, -85.0, -91.5, None, None, None]


def test_empty_layers(spark):
    none = spark.createDataFrame([], "provider_id int, technology string, cell long, signal_dbm double")
    assert change.layer_change(none, none, ["provider_id", "technology", "cell"]).count() == 0
