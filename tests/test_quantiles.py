from __future__ import annotations

import numpy as np
import pytest

from lakewright.operators.quantiles import exact_quantiles

FRACTIONS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def check(spark, data: dict[str, list[float]]):
    rows = [(k, float(v), 1) for k, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double, n long")
    got = {(r["k"], r["fraction"]): r["quantile"]
           for r in exact_quantiles(df, "k", "v", "n", FRACTIONS).collect()}
    for k, vs in data.items():
        for f in FRACTIONS:
            assert got[k, f] == pytest.approx(np.quantile(vs, f), rel=1e-12, abs=1e-300)


def test_against_numpy(spark):
    rng = np.random.default_rng(7)
    check(spark, {
        "uniform": list(rng.uniform(-5, 5, 3000)),
        "heavy": list(rng.standard_cauchy(3000) ** 3),
        "hot": [1.0] * 2000 + list(rng.normal(1, 1e-9, 1000)),
        "few": [3.0, -0.0, 0.0],
        "one": [42.0],
        "tiny": [1e-300, 2e-300, 1e-305, 5e-324],
        "huge": [1e300, -1e300, 1e308, 3.0],
    })


def test_weights(spark):
    df = spark.createDataFrame([(1, 1.0, 3), (1, 2.0, 1), (1, 10.0, 2)], "k int, v double, n long")
    got = {r["fraction"]: r["quantile"]
           for r in exact_quantiles(df, "k", "v", "n", [0.25, 0.5, 0.75]).collect()}
    want = np.quantile([1, 1, 1, 2, 10, 10], [0.25, 0.5, 0.75])
    assert [got[q] for q in (0.25, 0.5, 0.75)] == pytest.approx(list(want))
