import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from patchlode.llm.superkmers import remove_repeats


def brute(texts, k=35):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = Counter(tuple(w[i : i + k]) for w in split for i in range(len(w) - k + 1))
    found = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if counts[tuple(w[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        found.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return found


def corpus():
    rng = random.Random(3)
    new = lambda n: [f"{rng.choice('abcdé')}{rng.randrange(3000)}" for _ in range(n)]
    passage, short = new(60), new(34)
    texts = [None, "", " \n", "one", " ".join(new(34)), " ".join(new(500))]
    texts += ["  ".join(new(rng.randrange(0, 50)) + passage[rng.randrange(0, 10) :] + new(rng.randrange(0, 50))) for _ in range(30)]
    texts += ["\t".join(new(20) + short + new(20)) for _ in range(5)]
    texts += [" ".join(["same"] * 80), " ".join(["a", "b"] * 40), " ".join(["x"] * 35), " ".join(["y"] * 36)]
    copy = " ".join(new(90))
    texts += [copy, copy, copy + " and more", " ".join(new(35))]
    texts += ["A" + copy, copy.upper()]
    return texts


@pytest.mark.parametrize("hot", [4096, 5])
def test_windows_match_brute_force(spark, hot):
    texts = corpus()
    rows = [(i // 2, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, texts[5], None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, k1 int, `a.b` int")
    found = remove_repeats(docs, hot=hot).select(F.col("rest.doc_id"), "n_words", "n_removed", "kept_text").collect()
    expected = [(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows]))]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert remove_repeats(docs).count() == 0


def test_long_text(spark):
    rng = random.Random(9)
    long = [f"q{rng.randrange(10**6)}" for _ in range(400_000)]
    texts = [" ".join(long + long[1000:1050]), "other"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["rest"]["doc_id"]: (r["n_words"], r["n_removed"]) for r in remove_repeats(docs).collect()}
    assert found == {0: (400_050, 100), 1: (1, 0)}
