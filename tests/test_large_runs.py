"""Hits in tasks of bounded size, and rows behind full pages."""

from pyspark.sql import functions as F

from patchlode.operators import postings as P
from patchlode.operators import search as Q


def test_hits_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(P, "HITS_OF_TASK", 10)
    lists = spark.createDataFrame([(q, b, list(range(40))) for q in range(3) for b in range(2)], "query bigint, block bigint, places array<int>")
    rows = P.spelled_out(lists)
    assert rows.rdd.getNumPartitions() == 24
    assert rows.distinct().count() == 240
    assert rows.agg(F.max("file")).first()[0] == P.BLOCK + 39
    assert P.spelled_out(lists.limit(0)).count() == 0


def test_search_through_tasks_of_few_hits(spark, monkeypatch):
    monkeypatch.setattr(P, "HITS_OF_TASK", 3)
    files = [("r%d" % (n % 3), "f%d" % n, "java", "alpha beta" if n % 2 else "alpha gamma") for n in range(20)] + [("r0", "f0", "java", "alpha beta")]
    corpus = spark.createDataFrame(files, "repository string, path string, lang string, content string")
    queries = spark.createDataFrame(
        [("a", ["alpha"], [], []), ("b", ["beta"], [], ["delta"]), ("n", [], [], ["beta"]), ("x", ["none"], [], [])],
        "github_query string, source_kw array<string>, sink_kw array<string>, not_kw array<string>")
    found = Q.search_corpus(corpus, queries)
    got = sorted(tuple(r) for r in found.select("github_query", "repository", "path").collect())
    hits = {"a": lambda t: True, "b": lambda t: "beta" in t, "n": lambda t: "beta" not in t}
    assert got == sorted((q, r, p) for q, test in hits.items() for r, p, _, t in files if test(t))


def test_rows_behind_a_full_page_are_left_out(spark):
    rows = [("q", 0, r, str(n)) for r in (None, "a", "b", "c") for n in range(3)] + [("q", 1, "c", "0"), ("p", 0, "z", "0")]
    frame = spark.createDataFrame(rows, "github_query string, level int, repository string, path string")

    def kept(most):
        return sorted(map(str, map(tuple, Q.early_rows(frame, ("github_query", "level"), "repository", most).collect())))

    others = rows[12:]
    assert kept(3) == sorted(map(str, rows[:3] + others))
    assert kept(4) == sorted(map(str, rows[:6] + others))
    assert kept(100) == sorted(map(str, rows))
