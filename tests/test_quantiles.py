"""Exact quantiles whose cuts come out otherwise at every evaluation, as sketches merged in another order may."""

import random

import numpy as np
from pyspark.sql import functions as F

from voltway.operators import quantiles


def test_quantiles_do_not_depend_on_the_cuts(spark, monkeypatch):
    unsteady = F.udf(lambda a, b: sorted(random.SystemRandom().uniform(a, b) for _ in range(5)), "array<double>").asNondeterministic()
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda v, *_: unsteady(F.min(v), F.max(v)))
    values = [float(i * i % 1009) for i in range(3000)]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double").repartition(7)
    wanted = [0.1, 0.5, 0.9, 0.99]
    for _ in range(3):
        found = {r["q"]: r["value"] for r in quantiles.exact(df, ["k"], "v", wanted, ranges=6).collect()}
        assert np.allclose([found.get(q, np.nan) for q in wanted], np.quantile(values, wanted))
