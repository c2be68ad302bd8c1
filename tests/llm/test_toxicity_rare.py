"""Toxicity with few toxic labels: the counted model stays."""

import pytest
from test_models import texts

from patchlode.llm.frames import table
from patchlode.llm.toxicity import fit_toxicity, score_toxicity


def test_smallest_tables(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.001", n) for n in ("documents", "labels"))
    model = fit_toxicity(docs, labels)
    assert model.delta.any() and model.slope > 0
    found = score_toxicity(docs, model).join(labels.where("toxic is not null"), "doc_id").where("not held_out").collect()
    toxic = [r["predicted"] for r in found if r["toxic"]]
    assert toxic and sum(toxic) >= 0.8 * len(toxic)
    assert sum(r["predicted"] for r in found) < 0.5 * len(found)


@pytest.mark.parametrize("most", [20_000, 40])
def test_few_toxic_rows(spark, most):
    rows = texts(900, 5)
    few = [r for r in rows if r[3]][:3]
    rows = [r for r in rows if not r[3]] + few
    docs = spark.createDataFrame([(4 * i, t) for i, t, _, _ in rows], "doc_id bigint, text string").where("crc32(string(doc_id)) % 4 != 2")
    labels = spark.createDataFrame([(4 * i, y) for i, _, _, y in rows], "doc_id bigint, toxic int")
    model = fit_toxicity(docs, labels, most_fitted=most)
    scores = {r["doc_id"]: r["score"] for r in score_toxicity(docs, model).collect()}
    toxic = [scores[4 * i] for i, *_ in few if 4 * i in scores]
    assert model.slope > 0 and toxic
    assert min(toxic) > sorted(s for d, s in scores.items() if d not in {4 * i for i, *_ in few})[-10]
