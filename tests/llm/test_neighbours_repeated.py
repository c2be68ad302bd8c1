"""Neighbours in tables with whole rows, or ids, many times."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_neighbours import brute

from patchlode.llm.neighbours import nearest


def found(spark, rows, **more):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for r in nearest(frame, F.col("vec_id") % 20 == 0, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return got


@pytest.mark.parametrize("times, n", [(2, 60), (30, 60), (30, 400)])
def test_each_row_many_times(spark, times, n):
    rng = np.random.default_rng(n)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(n)]
    got, expected = found(spark, rows * times), brute(rows, 20)
    assert {q: len(e) for q, e in got.items()} == {q: len(e) for q, e in expected.items()}
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in e}) / len(e) for q, e in expected.items()])
    assert recall >= 0.9
    assert got == found(spark, rows)


def test_one_id_with_many_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(60)]
    near = np.array(rows[20][1])
    rows += [(7, (near * 3 + 0.01 * rng.standard_normal(8)).astype(np.float32).tolist()) for _ in range(200)]
    got, expected = found(spark, rows), brute(rows, 20)
    assert {q: len(e) for q, e in got.items()} == {q: 20 for q in expected}
    assert [i for i, _ in got[20]][0] == 7 and len({i for i, _ in got[20]}) == 20
