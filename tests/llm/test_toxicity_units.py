"""Toxicity in texts without ASCII spaces: the whole text is read."""

import random

import pyarrow as pa
import pytest

from patchlode.llm.toxicity import fit_toxicity, score_toxicity, stems

ALPHABETS = {
    "ideographs": ([chr(0x4E00 + i) for i in range(400)], "龘龙龚"),
    "thai": ([chr(0x0E01 + i) for i in range(40)], "สัตว์เลว"),
    "latin": (list("abcdefghijklmnop"), "zyxwvuq"),
}


def test_units():
    cells, bounds = stems(pa.array(["one two、three—four", None, "", "one two three four", "inflected inflecting", "co­operate cooperate"]))
    own = [cells[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert own[0] == own[3] and len(own[0]) == 4 and own[1] == own[2] == []
    assert len(own[4]) == len(own[5]) == 2 and own[4][0] == own[4][1] and own[5][0] == own[5][1]
    cells, bounds = stems(pa.array(["一" * 500, "ก" * 500, "x" * 500, "一", "x一丁"]))
    assert (bounds[1:] - bounds[:-1]).tolist() == [499, 497, 497, 1, 2]
    cells, bounds = stems(pa.array(["skip", "ab", "cd"])[1:])
    assert bounds.tolist() == [0, 1, 2] and cells[0] == stems(pa.array(["ab"]))[0][0]


@pytest.mark.parametrize("script", ALPHABETS)
def test_expression_at_the_end(spark, script):
    letters, bad = ALPHABETS[script]
    rng = random.Random(3)
    plain = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(i, plain(rng.randrange(20, 60)) + (bad if i % 4 == 0 else "") + plain(20), int(i % 4 == 0)) for i in range(600)]
    tests = [(10_001, (text := plain(500))), (10_002, text[: -len(bad)] + bad)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + tests, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    scored = {r["doc_id"]: r for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()}
    assert scored[10_002]["score"] > scored[10_001]["score"] and scored[10_002]["evidence"] > scored[10_001]["evidence"]
    held = [(scored[i]["predicted"], y) for i, _, y in rows if scored[i]["held_out"]]
    assert sum(p == y for p, y in held) > 0.9 * len(held)
