"""Pairs of close points."""

import numpy as np

from hexdrift.operators import spatial


def test_close_pairs_meet_once(spark):
    rnd = np.random.default_rng(6)
    at = [(int(i), float(x), float(y)) for i, (x, y) in zip(rnd.permutation(400), rnd.uniform(-9000, 9000, (400, 2)))] + [(400, 20_000.0, 0.0), (401, 21_999.9997, 0.0), (402, 22_000.0, 0.0)]
    got = spatial.close_pairs(spark.createDataFrame(at, "id long, x_m double, y_m double"), 2000.0).collect()
    want = {(a[0], b[0]) for a in at for b in at if a[0] < b[0] and np.hypot(a[1] - b[1], a[2] - b[2]) < 2000}
    assert (400, 401) in want and (400, 402) not in want
    assert len(got) == len(want) and {tuple(r) for r in got} == want
