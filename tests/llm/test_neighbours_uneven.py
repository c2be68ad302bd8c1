"""Neighbours among rows that lie dense in some places and scattered in others."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchlode.llm.neighbours import nearest


def uneven(n, d, rng):
    """Half of the rows in tight clusters of about 60, the others anywhere."""
    centres = rng.standard_normal((n // 100, d))
    x = centres[rng.integers(0, len(centres), n)] + 0.05 * rng.standard_normal((n, d))
    loose = rng.random(n) < 0.5
    x[loose] = rng.standard_normal((loose.sum(), d))
    return x.astype(np.float32).astype(float)


@pytest.mark.parametrize("sample", [4096, 400])
def test_dense_and_scattered_rows(spark, sample):
    x = uneven(3000, 32, np.random.default_rng(5))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = {}
    for r in nearest(frame, F.col("vec_id") % 20 == 0, sample=sample).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    shares = []
    for i in range(0, len(x), 20):
        scores = x @ x[i]
        scores[i] = -np.inf
        shares.append(len(found[i] & set(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(shares) >= 0.95
    assert np.quantile(shares, 0.05) >= 0.8
