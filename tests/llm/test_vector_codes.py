import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from patchlode.llm import vector_codes
from patchlode.llm.vector_codes import compress_vectors, label_errors

SCHEMA = "vec_id bigint, embedding array<float>, label int, `code` string, `error` int, `id` string"


def brute(rows, parts, entries, rounds, scale):
    """Plain integers, all distances one by one."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[max(-(1 << 28), min(1 << 28, math.floor(scale * x))) for x in r[1]] for r in kept]
    d = len(whole[0]) if whole else 0
    cuts = [p * d // parts for p in range(parts + 1)]
    cut = [[w[a:b] for a, b in zip(cuts, cuts[1:])] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        found = []
        for c in cut:
            best = [min((sum((x - y) ** 2 for x, y in zip(c[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)]
            found.append(best)
        return found

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == i]
                if mine:
                    books[p][i] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    codes = [("".join(f"{i:02x}" for _, i in f), sum(s for s, _ in f)) for f in assign()]
    return sorted((r[0] is None, r[0] or 0, r[2] is None, r[2] or 0, *c) for r, c in zip(kept, codes)), digest


def plain(rows):
    return sorted((r["id"] is None, r["id"] or 0, r["label"] is None, r["label"] or 0, r["code"], r["error"]) for r in rows)


def made(n, d, seed, dirty=True):
    rng = random.Random(seed)
    rows = [(i * 3 % 101 - 20, [float(np.float32(rng.gauss(0, 0.4))) for _ in range(d)], rng.choice([None, 1, 1, 2]), "x", 1, "y") for i in range(n)]
    if dirty:
        rows += [(None, rows[0][1], 1, "", 0, ""), rows[1], rows[1], (5, [1000.0] * d, None, "", 0, ""), (6, [3e38] * d, 4, "", 0, ""),
                 (7, None, 1, "", 0, ""), (8, [None] + [0.0] * (d - 1), 1, "", 0, ""), (9, [math.nan] * d, 1, "", 0, ""), (9, [-math.inf] * d, 1, "", 0, "")]
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = made(220, 10, 1)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = compress_vectors(vectors, parts=4, entries=16, rounds=3)
    expected, digest = brute(rows, 4, 16, 3, 1024)
    assert plain(found.rows.collect()) == expected and found.digest() == digest
    again = compress_vectors(vectors.repartition(2), parts=4, entries=16, rounds=3)
    assert again.digest() == digest


def test_small_blocks_and_labels(spark, monkeypatch):
    rows = made(150, 8, 2)
    found = compress_vectors(spark.createDataFrame(rows, SCHEMA), entries=32, rounds=2)
    for bound in (100, 0):
        summed = label_errors(found.rows, bound=bound, salts=5).collect()
        for label in (None, 1, 2, 4):
            same = [r for r in summed if r["label"] == label]
            assert {r["label_error"] for r in same} == {sum(r["error"] for r in same)}
        assert plain(summed) == brute(rows, 4, 32, 2, 1024)[0]
    block = vector_codes.BLOCK
    vector_codes.BLOCK = 7  # tables of other blocks, the same result
    try:
        assert compress_vectors(spark.createDataFrame(rows, SCHEMA), entries=32, rounds=2).digest() == found.digest()
    finally:
        vector_codes.BLOCK = block


def test_other_lengths_few_rows_and_none(spark):
    rows = [(1, [0.5, 0.25, 0.0, 1.0], 1), (2, [0.5, 0.25, 0.0, -1.0], None), (3, [1.0], 1), (4, [], 2), (2, [0.5, 0.25, 0.0, -1.0], None)]
    schema = "vec_id bigint, embedding array<double>, label int"
    found = {(r["id"], r["code"], r["error"]) for r in compress_vectors(spark.createDataFrame(rows, schema)).rows.collect()}
    assert found == {(1, "00000000", 0), (2, "00000001", 0), (3, None, None), (4, None, None)}
    empty = compress_vectors(spark.createDataFrame([], schema))
    assert empty.rows.count() == 0 and empty.codebooks == [] and label_errors(empty.rows).count() == 0
    only_bad = compress_vectors(spark.createDataFrame([(1, None, 1)], schema))
    assert only_bad.rows.count() == 0


def test_distances_come_from_dictionaries(spark):
    """A gather from the tables is the distance itself, and a repeated value has one place in its dictionary."""
    vectors = spark.range(0, 50, 1, 1).select(
        F.col("id").alias("vec_id"), F.array(*[(F.col("id") % m / 8).cast("float") for m in (2, 3, 5, 7)]).alias("embedding"), F.lit(1).alias("label"))
    rows = vectors.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector")).toArrow().to_batches()
    block_rows = list(vector_codes._encoded(4, 1024.0)(iter(rows)))
    block = vector_codes._Block(block_rows[0], 0)
    assert [len(x) for x in block.dictionaries] == [2, 3, 5, 7]
    whole = np.stack([d[c] for d, c in zip(block.dictionaries, block.codes)], 1)
    book = np.array([[0, 128], [64, 64], [0, 128]])
    best, distance = block.nearest(book, 2)
    direct = ((whole[:, None, 2:] - book[None]) ** 2).sum(2)
    assert (best == direct.argmin(1)).all() and (distance == direct.min(1)).all()
