import random
import re

import pytest

from patchlode.llm.minhash import near_duplicates


def shingles(text: str | None) -> set:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows: list[tuple]) -> dict:
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and sets[i] and sets[j]:
                root[max(find(i), find(j))] = min(find(i), find(j))
    found = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [r[0] for j, r in enumerate(rows) if find(j) == find(i) and r[0] is not None]
        found[i] = (doc_id, len(sets[i]), min(ids) if ids else None)
    return found


def corpus() -> list[tuple]:
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows: list[tuple] = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 20, 80, 200]))]
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + 5, " ".join(copy)))
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (900, "ONE\ttwo"), (None, "one two"), (None, "nothing like it at all here"), (901, "É é"), (902, "é é")]
    rows += [rows[0], rows[0], (903, "word " * 3000), (904, "word " * 40)]
    return rows


def test_components_match_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame(
        [(t, i, 1, "x") for i, t in rows], "text string, doc_id bigint, n bigint, bands string"
    )
    found = sorted(
        near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect(), key=str
    )
    expected = sorted(
        ((i, n, c, i is not None and i == c) for i, n, c in brute(rows).values()), key=str
    )
    assert [tuple(r) for r in found] == [tuple(e) for e in expected]


def test_chains_through_large_buckets(spark):
    """Texts that drift: neighbours are linked, distant ones not; one component all the same."""
    words = [f"v{i}" for i in range(460)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert found == {i: brute(rows)[i][2] for i in range(90)}
    assert set(found.values()) == {0}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(docs).count() == 0


@pytest.mark.parametrize("edges, expected", [
    ([(1, 2), (2, 3), (9, 8), (7, 7), (3, 1)], {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([], {}),
])
def test_components(spark, edges, expected):
    from patchlode.llm.components import components

    found = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r["node"]: r["root"] for r in found} == expected
    assert len(found) == len(expected)
