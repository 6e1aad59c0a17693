"""Exact, skew-safe median against numpy, with a hot group and many ties."""

import numpy as np
from pyspark.sql import functions as F

from sievekit.operators.stats import exact_median, group_stats


def test_exact_median_matches_numpy(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(20000):                      # hot group: 20k rows, continuous values
        rows.append(("hot", float(rng.normal())))
    for i in range(3001):                       # ties: few distinct values, odd count
        rows.append(("ties", float(rng.integers(0, 4))))
    for i in range(10):                         # small even group
        rows.append(("small", float(i)))
    rows.append(("one", 5.0))
    rows.append(("nulls", None))
    rows.append(("nulls", 2.0))
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r.g: r.x_median for r in exact_median(df, ["g"], "x", accuracy=100).collect()}
    for g in ("hot", "ties", "small", "one"):
        xs = np.array([x for k, x in rows if k == g])
        assert abs(got[g] - float(np.median(xs))) < 1e-12, g
    assert got["nulls"] == 2.0


def test_group_stats_columns(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 5), ("b", 4.0, 1)], "g string, s double, n long")
    r = {x.g: x for x in group_stats(df, ["g"], ["s", "n"]).collect()}
    assert (r["a"].s_mean, r["a"].s_median, r["a"].s_min, r["a"].s_max) == (1.5, 1.5, 1.0, 2.0)
    assert (r["a"].n_median, r["b"].n_max) == (4.0, 1)
    assert group_stats(df, ["g"], ["s"]).columns == ["g", "s_mean", "s_median", "s_min", "s_max"]
