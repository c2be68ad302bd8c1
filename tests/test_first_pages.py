"""Pages of searches: only the first names of the first files become hits."""

import random

import pytest
from pyspark.sql import functions as F

from patchlode.operators import postings as P
from patchlode.operators import search as Q

CORPUS = "repository string, path string, lang string, content string"
TERMS = "github_query string, source_kw array<string>, sink_kw array<string>, not_kw array<string>"
KEYWORDS = ["k0", "k1", "k2"]


def first(value):
    """Nulls first, as they are sorted."""
    return [(x is not None, x or "") for x in value]


@pytest.fixture(scope="module")
def corpus():
    """Texts with many copies, texts of their own, rows that come twice, one path with two texts, and unknown names."""
    rng = random.Random(5)
    texts = [" ".join(["alpha", *KEYWORDS[:n], f"t{n}"]) for n in range(4)] + ["beta k0 k1", "alpha beta"]
    rows = [(f"r{rng.randrange(9)}", f"p{rng.randrange(40):02d}", "Java", rng.choice(texts)) for _ in range(300)]
    rows += [(f"r{n % 9}", f"own{n}", "Java", f"alpha k0 w{n}") for n in range(40)]
    rows += rows[:20] + [(None, "p", "Java", texts[3]), ("r1", None, "Java", texts[2]), (None, None, "Java", texts[1]), ("r1", "n", "Java", None)]
    return rows


@pytest.mark.parametrize("most", [1, 3, 25, 1000])
def test_pages_are_the_first_of_all_hits(spark, corpus, most, monkeypatch):
    monkeypatch.setattr(Q, "SALTS", 4)
    index = P.build_index(spark.createDataFrame(corpus, CORPUS))
    texts = {r["content"]: r["file"] for r in index.files.collect()}
    asked = {(1, 0): lambda t: "alpha" in t, (1, 2): lambda t: "k1" in t, (2, 0): lambda t: True}
    rows = [(q, f, level) for (q, level), holds in asked.items() for t, f in texts.items() if holds(t)]
    pages = Q.first_pages(index, spark.createDataFrame(rows, "query bigint, file bigint, level int"), most).collect()
    for (query, level), holds in asked.items():
        got = sorted((r["rank"], r["repository"], r["path"]) for r in pages if (r["query"], r["level"]) == (query, level))
        hits = sorted(((r, p) for r, p, _, t in corpus if holds(t or "")), key=first)
        assert [tuple(x[1:]) for x in got] == hits[:most] and [x[0] for x in got] == list(range(1, len(got) + 1))


def test_hits_behind_the_pages_are_not_made(spark, monkeypatch):
    written = {}
    plain = Q.stage

    def counted(df, name):
        made = plain(df, name)
        written[name] = max(written.get(name, 0), made.count())
        return made

    monkeypatch.setattr(Q, "stage", counted)
    rows = [(f"r{n % 50}", f"p{n}", "java", f"alpha t{n % 4}") for n in range(2000)] + [(f"r{n % 50}", f"o{n}", "java", f"alpha u{n}") for n in range(300)]
    queries = spark.createDataFrame([("alpha", ["alpha"], [], []), ("one", ["t1"], [], [])], TERMS)
    found = Q.adaptive_search(spark.createDataFrame(rows, CORPUS), queries, [], page_size=5, max_pages=1)
    got = {q: [(r["repository"], r["path"]) for r in found.filter(F.col("github_query") == q).orderBy("hit_ord").collect()] for q in ("alpha", "one")}
    assert got["alpha"] == sorted((r, p) for r, p, _, _ in rows)[:5]
    assert got["one"] == sorted((r, p) for r, p, _, t in rows if t == "alpha t1")[:5]
    # of two searches with a page of five
    assert written["page_files"] <= 2 * 5 and written["page_names"] <= 2 * 5 * 5
