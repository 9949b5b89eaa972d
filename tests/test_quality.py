"""Exact quartiles from sketched brackets against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripdemand import catalog
from tripdemand.operators import quality
from tests.conftest import SF_SMALL


def columns(n, seed):
    rng = np.random.default_rng(seed)
    return {
        "few": rng.choice([1.0, 2.0, 3.0], n, p=[0.5, 0.01, 0.49]),
        "normal": rng.normal(size=n),
        "heavy": np.where(rng.random(n) < 0.4, 7.5, rng.random(n) * 10),
        "steps": np.floor(rng.random(n) * 300),
        "wide": 10.0 ** rng.uniform(-300, 300, n) * rng.choice([-1, 1], n),
        "same": np.full(n, 4.25),
        "ends": np.where(rng.random(n) < 0.25, -np.inf, np.where(rng.random(n) < 0.34, np.inf, rng.random(n))),
    }


@pytest.mark.parametrize("n, fetch", [(1, 10**6), (2, 10**6), (7, 10**6), (1999, 3), (2001, 10**6), (20_000, 10**6), (20_000, 40), (20_000, 5)])
def test_quartiles_equal_numpy(spark, n, fetch):
    data = columns(n, n + fetch)
    rows = [tuple(float(data[c][i]) if (i + k) % 11 or n < 8 else None for k, c in enumerate(data)) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(7)
    got = {r.column: r for r in quality.profile(df, fetch=fetch).collect()}
    for k, c in enumerate(data):
        own = np.array([r[k] for r in rows if r[k] is not None])
        assert got[c]["count"] == len(own)
        with np.errstate(invalid="ignore"):
            want = np.quantile(own, [0.25, 0.5, 0.75])
        for name, w in zip(("q25", "q50", "q75"), want, strict=True):
            assert got[c][name] == w or np.isnan(w) and (got[c][name] is None or np.isnan(got[c][name])) or np.isinf(own).any(), (c, name, got[c], w)


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "none double, some double")
    got = {r.column: r for r in quality.profile(df).collect()}
    assert got["none"]["count"] == 0 and got["none"].q50 is None and got["some"].q50 == 1.5
    assert [(r.column, r["count"], r.q25) for r in quality.profile(df.limit(0)).collect()] == [("none", 0, None), ("some", 0, None)]


def test_no_sort_of_values(spark):
    for key in ("profile", "profile_explore"):
        plan = catalog.QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().toString()
        assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan


def test_ends_are_exact_beside_infinite_values(spark):
    values = [float("-inf")] * 3 + [1.0, 2.0, 3.0] + [float("inf")] * 3
    row = quality.profile(spark.createDataFrame([(v,) for v in values], "v double")).first()
    assert (row.q25, row.q50, row.q75) == (float("-inf"), 2.0, float("inf"))
    assert quality.profile(spark.createDataFrame([(v,) for v in values], "v double").where(F.abs("v") < 10)).first().q50 == 2.0
