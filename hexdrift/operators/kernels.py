"""Operators that are sequential by nature, as one kernel a unit, and resampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layers import UNIT


def assign(cost: np.ndarray) -> np.ndarray:
    """Column of each row in the cheapest one-to-one assignment (rows <= columns), by shortest augmenting paths."""
    n, m = cost.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    match = np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        low, way, done = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            done[j0] = True
            i0 = match[j0]
            free = ~done[1:]
            reduced = cost[i0 - 1] - u[i0] - v[1:]
            better = free & (reduced < low[1:])
            low[1:][better] = reduced[better]
            way[1:][better] = j0
            j1 = 1 + int(np.where(free, low[1:], np.inf).argmin())
            delta = low[j1]
            u[match[done]] += delta
            v[done] -= delta
            low[~done] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            j1 = way[j0]
            match[j0] = match[j1]
            j0 = j1
    out = np.full(n, -1)
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Part of each pair (a, b): pairs that share an ``a`` or a ``b``, directly or by others, are one part."""
    part = a.copy()
    while True:
        left, right = np.full(a.max() + 1, len(a)), np.full(b.max() + 1, len(a))
        np.minimum.at(right, b, part)
        np.minimum.at(left, a, right[b])
        low = left[a]
        if (low == part).all():
            return part
        part = low


def match_sites(current: DataFrame, prior: DataFrame, radius: float) -> DataFrame:
    """One-to-one matches (provider_id, site_id, prior_id, dist_m) within ``radius``.

    Candidates are the eight nearest prior sites of each current one, found by
    the bucketed join; what is out of reach costs ten radii.
    A task holds the candidate pairs of one provider, at most eight a site. They are
    solved apart wherever no candidate joins them, so a cost matrix has the sites of one such part.
    """
    from pyspark.sql import Window as W

    from .spatial import near

    pairs = near(current.select("provider_id", "site_id", "x_m", "y_m"), prior.select("provider_id", F.col("site_id").alias("prior_id"), "x_m", "y_m"), radius, ["provider_id"])
    n = F.row_number().over(W.partitionBy("provider_id", "site_id").orderBy("dist_m", "prior_id"))
    pairs = pairs.withColumn("n", n).where("n <= 8").select("provider_id", "site_id", "prior_id", "dist_m")

    def kernel(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["site_id", "prior_id"])
        part = linked(*(np.unique(c, return_inverse=True)[1] for c in (df.site_id, df.prior_id)))
        found = []
        for _, one in df.groupby(part, sort=True):
            rows, cols = np.unique(one.site_id), np.unique(one.prior_id)
            cost = np.full((len(rows), len(rows) + len(cols)), 10 * radius)
            cost[np.searchsorted(rows, one.site_id), np.searchsorted(cols, one.prior_id)] = one.dist_m
            pick = assign(cost)
            found += [(one.provider_id.iloc[0], int(rows[i]), int(cols[j]), float(cost[i, j])) for i, j in enumerate(pick) if j < len(cols) and cost[i, j] <= radius]
        return pd.DataFrame(found, columns=["provider_id", "site_id", "prior_id", "dist_m"])

    return pairs.groupBy("provider_id").applyInPandas(kernel, "provider_id int, site_id long, prior_id long, dist_m double")


def bootstrap(rows: DataFrame, draws: int = 200, seed: int = 42) -> DataFrame:
    """95 % interval of precision and recall of (label, flag) rows over ``draws`` resamples.

    Resampling n rows only changes the four cells of the confusion table, so each
    draw is one multinomial over four counts, whatever the number of rows.
    """
    counts = rows.groupBy("flag", "label").agg(F.count(F.lit(1)).alias("n"))

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(batches))  # four rows at most
        if not len(every):
            return
        n = {(bool(f), int(x)): int(c) for f, x, c in zip(every.flag, every.label, every.n, strict=True)}
        cells = np.array([n.get(k, 0) for k in ((True, 1), (True, 0), (False, 1), (False, 0))])
        t = np.random.default_rng(seed).multinomial(cells.sum(), cells / cells.sum(), draws).astype(float)
        for name, top, whole in (("precision", t[:, 0], t[:, 0] + t[:, 1]), ("recall", t[:, 0], t[:, 0] + t[:, 2])):
            x = np.divide(top, whole, out=np.zeros_like(top), where=whole > 0)
            yield pd.DataFrame({"metric": [name], "low": [float(np.quantile(x, 0.025))], "high": [float(np.quantile(x, 0.975))]})

    return counts.coalesce(1).mapInPandas(kernel, "metric string, low double, high double")
