"""Toxicity by whole words: few expressions in long texts, words that begin alike, unseen forms by their stems."""

import random

import numpy as np
import pyarrow as pa

from patchlode.llm.frames import table
from patchlode.llm.toxicity import CELLS, fit_toxicity, score_toxicity, units


def test_cells_of_whole_words():
    words, stem, bounds = units(pa.array(["worth worthless worth", "w" * 16, None]))
    assert bounds.tolist() == [0, 3, 4, 4] and words[0] == words[2] != words[1] and stem[0] == stem[1] == stem[2]
    assert max(words.max(), stem.max()) < 1 << CELLS
    alone, _, _ = units(pa.array(["worth", "worthless"]))
    assert alone.tolist() == words[:2].tolist()


def test_one_expression_in_a_long_text(spark):
    rng = random.Random(11)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows = []
    for i in range(900):
        words = rng.choices([*plain, "worth", "grimace"], k=rng.randrange(150, 400))
        if i % 6 == 0:
            words[rng.randrange(len(words))] = "worthless"
            words[rng.randrange(len(words))] = "grimscum"
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    more = [(5000, " ".join(rng.choices(plain, k=20)) + " grimscum worthless"), (5001, "worth grimace " + " ".join(rng.choices(plain, k=20)))]
    docs = spark.createDataFrame([r[:2] for r in rows] + more, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    found = {r["doc_id"]: r for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()}
    held = [(found[i]["predicted"], y) for i, _, y in rows if found[i]["held_out"]]
    assert sum(p and y for p, y in held) >= 0.95 * sum(y for _, y in held) and sum(p and not y for p, y in held) <= 0.02 * len(held)
    assert found[5000]["predicted"] == 1 and found[5001]["predicted"] == 0


def test_unseen_form_is_read_by_its_stem(spark):
    rng = random.Random(4)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(plain, k=20)) + (rng.choice([" grimscum", " grimly", " grimfool"]) if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(600)]
    text = " ".join(rng.choices(plain, k=20))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(5000, f"{text} grimwit"), (5001, f"{text} zzyxwit")], "doc_id bigint, text string")
    found = {r["doc_id"]: r["score"] for r in score_toxicity(docs, fit_toxicity(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int"))).collect()}
    assert found[5000] > 0.5 > found[5001]


def test_held_out_rows_of_the_given_tables(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    rows = score_toxicity(docs, fit_toxicity(docs, labels)).join(labels.where("toxic is not null"), "doc_id").where("held_out").toPandas()
    toxic, score = rows["toxic"].to_numpy() == 1, rows["score"].to_numpy()
    wins = np.mean((score[toxic][:, None] > score[~toxic]) + 0.5 * (score[toxic][:, None] == score[~toxic]))
    assert wins >= 0.88
