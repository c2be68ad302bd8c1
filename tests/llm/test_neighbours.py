import numpy as np
import pytest
from pyspark.sql import functions as F

from patchlode.llm.neighbours import nearest


def brute(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8]
    found = {}
    for i, v in good:
        if i % 20 == 0:
            score = {}
            for j, w in good:
                if j != i:
                    s = 0.0
                    for a, b in zip(v, w):
                        s += a * b
                    score[j] = max(s, score.get(j, -np.inf))
            found[i] = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k]
    return found


@pytest.mark.parametrize("n, scale", [(3, 1), (1500, 1), (600, 30)])
def test_recall_and_order(spark, n, scale):
    rng = np.random.default_rng(n)
    rows = [(i, (rng.standard_normal(8) * (1 + scale * rng.random())).astype(np.float32).tolist()) for i in range(n)]
    rows += [(20 * i, rows[0][1]) for i in range(n, n + 3)] + [(7_000_001 + i, rows[0][1]) for i in range(40)]
    rows += [(20_000, None), (20_020, []), (20_040, [0.0] * 8), (20_060, [float("nan")] + [1.0] * 7), (20_080, [None] + [1.0] * 7), (20_100, [1.0] * 5), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, id int, cell int")
    found = {}
    for r in nearest(frame, F.col("vec_id") % 20 == 0, block=100).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    expected = brute(rows, 20)
    assert set(found) == set(expected)
    assert all(len(found[q]) == len(e) for q, e in expected.items())
    recall = np.mean([len({i for i, _ in found[q]} & {i for i, _ in e}) / len(e) for q, e in expected.items()])
    assert recall >= 0.9
    for q, e in found.items():
        assert e == sorted(e, key=lambda x: (-x[1], x[0]))
        truth = dict(brute([r for r in rows if r[0] == q or r[0] in dict(e)], 999)[q])
        assert all(truth[i] == s for i, s in e)


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert nearest(frame, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert nearest(one, F.col("vec_id") % 20 == 0).count() == 0
