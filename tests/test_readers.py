"""Hits given to the readers of their query are joined once."""

from collections import Counter

from test_derived_tables import plan_of

from patchlode.operators import search as Q

QUERY = "github_query string, source_kw array<string>, sink_kw array<string>, not_kw array<string>"


def test_each_reader_gets_the_hits_of_its_query(spark):
    corpus = spark.createDataFrame(
        [("r", f"p{n}", "java", text) for n, text in enumerate(["a b", "a b", "a c", "d", None])] + [("r", "p0", "java", "a b")],
        "repository string, path string, lang string, content string")
    queries = spark.createDataFrame([("one", ["a"], ["b"], []), ("two", ["a"], [], ["b"]), ("three", ["d"], [], [])], QUERY)
    readers = spark.createDataFrame(
        [("k1", "one"), ("k2", "one"), ("k2", "one"), (None, "two"), ("k4", "none"), ("k5", None), ("k6", "")], "pattern_key string, github_query string")
    names = ("github_query", "repository", "path")
    hits = Q.search_corpus(corpus, queries)
    got = Q.search_corpus(corpus, queries, readers=readers)
    want = hits.join(readers, "github_query")
    assert Counter(map(tuple, got.select("pattern_key", *names).collect())) == Counter(map(tuple, want.select("pattern_key", *names).collect()))
    assert got.count() == 10
    assert plan_of(got).count("Join") == plan_of(hits).count("Join") == 2
