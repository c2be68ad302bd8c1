import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from patchlode.operators import postings
from patchlode.operators import search as Q
from patchlode.operators.corpus import tfidf_terms, top_terms
from patchlode.plans.search_run import run_search
from patchlode.streaming.incremental import tried_after, untried

TERMS = "github_query string, source_kw array<string>, sink_kw array<string>, not_kw array<string>"
CORPUS = "repository string, path string, lang string, content string"


def corpus_rows(n=120, seed=3):
    rng = random.Random(seed)
    vocabulary = ["alpha", "beta", "gamma", "delta", "k0", "k1", "k2", "k3", "k4", "omega"]
    rows = []
    for i in range(n):
        words = [w for w in vocabulary if rng.random() < 0.7]
        # a third of all files sit in one repository
        repo = "hot" if i % 3 == 0 else f"r{rng.randrange(15)}"
        rows.append((repo, f"p{i:03d}", "Java" if i % 10 else "Go", " ".join(words)))
    return rows


QUERIES = [
    ("alpha", ["alpha"], [], []),
    ("alpha AND beta OR gamma", ["alpha"], ["beta", "gamma"], []),
    ("delta NOT omega", [], ["delta"], ["omega"]),
    (" NOT omega", [], [], ["omega"]),
    ("k1 alpha", ["alpha"], [], []),
    ("  ", ["alpha"], [], []),
]


def matches(query, text):
    _, src, snk, neg = query
    return (
        (not src or any(w in text for w in src))
        and (not snk or any(w in text for w in snk))
        and not any(w in text for w in neg)
    )


def test_search_equals_brute_force_also_with_repeated_keys(spark, monkeypatch):
    rows = corpus_rows()
    rows += rows[:20]
    corpus = spark.createDataFrame(rows, CORPUS)
    queries = spark.createDataFrame(QUERIES + QUERIES[:2], TERMS)
    want = Counter(
        (q[0], r[0], r[1]) for q in QUERIES if q[0].strip() for r in rows
        if r[2] == "Java" and matches(q, r[3])
    )
    for block in (1 << 16, 2):
        monkeypatch.setattr(postings, "BLOCK", block)
        hits = Q.search_corpus(corpus, queries).select("github_query", "repository", "path")
        assert Counter(map(tuple, hits.collect())) == want


def test_long_lists_of_queries(spark, tmp_path):
    corpus_rows_ = [(f"r{i}", f"p{i}", "Java", f"w{i} w{i + 1} x{i % 7}") for i in range(300)]
    spark.createDataFrame(corpus_rows_, CORPUS).write.parquet(str(tmp_path / "corpus"))
    corpus = spark.read.parquet(str(tmp_path / "corpus"))
    queries = [(f"w{i} AND x{i % 7}", [f"w{i}", f"y{i}", f"z{i}", f"u{i}"], [f"x{i % 7}"], []) for i in range(5000)]
    hits = Q.search_corpus(corpus, spark.createDataFrame(queries, TERMS))
    want = {
        (q[0], r[0]) for r in corpus_rows_ for q in (queries[n] for w in r[3].split()[:2] for n in [*range(int(w[1:]), int(w[1:]) + 1)])
        if q[2][0] in r[3].split()
    }
    # a word also counts inside another: w1 is found in w10
    found = {(r.github_query, r.repository) for r in hits.collect()}
    assert want <= found and all(any(w in c[3] for w in q.split(" AND ")[:1]) for q, repo in list(found)[:50] for c in corpus_rows_ if c[0] == repo)
    assert hits.count() == sum(
        1 for q in queries for r in corpus_rows_ if any(w in r[3] for w in q[1]) and q[2][0] in r[3])


def test_cap_with_a_hot_query_beyond_the_limit_of_the_optimiser(spark):
    hits = spark.range(30_000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("q"), F.col("id") % 70)).otherwise("hot").alias("github_query"),
        F.format_string("r%05d", "id").alias("repository"), F.lit("p").alias("path"),
    )
    capped = Q.cap_per_query(hits, 5000).filter("github_query = 'hot'").orderBy("hit_ord").collect()
    assert [r.hit_ord for r in capped] == list(range(1, 5001))
    assert [r.repository for r in capped] == [f"r{i:05d}" for i in range(30_000) if i % 10][:5000]


def plain_adaptive(rows, query, keywords, limit, most):
    """One search after the other, as a person would do it."""

    def go(base, words, n):
        text, used = base, list(words)
        if n < len(keywords):
            used.append(keywords[n])
            text = f"{base} {keywords[n]}"
        page = [r for r in rows if matches(query, r[3]) and all(w in r[3] for w in used)]
        page = sorted(page)[:limit][:most]
        if len(page) >= limit and n + 1 < len(keywords) and keywords[n + 1] not in text:
            more = go(f"{text} {keywords[n + 1]}", [*used, keywords[n + 1]], n + 2)
            known = {r[0] for r in page}
            for r in more:
                if r[0] not in known:
                    page.append(r)
                    if len(page) >= most:
                        break
        return page

    return [(r[0], r[1]) for r in go(query[0], [], 0)]


def test_adaptive_search_equals_step_by_step(spark):
    rows = [r for r in corpus_rows(300) if r[2] == "Java"]
    corpus = spark.createDataFrame(rows, CORPUS)
    queries = spark.createDataFrame(QUERIES[:5], TERMS)
    for keywords, limit, most in (
        (["k0", "k1", "k2", "k3", "k4"], 12, 40),
        (["k0", "k1", "k2", "k3"], 8, 9),
        (["k0", "alpha", "k2"], 10, 30),
        ([], 10, 30),
        (["k0"], 10, 5),
    ):
        found = Q.adaptive_search(
            corpus, queries, keywords, page_size=limit, max_pages=1, max_results=most
        )
        got = defaultdict(list)
        for r in sorted(found.collect(), key=lambda r: r.hit_ord):
            got[r.github_query].append((r.repository, r.path))
        for query in QUERIES[:5]:
            want = plain_adaptive(rows, query, keywords, limit, most)
            assert got[query[0]] == want, (query[0], keywords)


def test_tried_queries_are_not_sent_again(spark):
    corpus = spark.createDataFrame(corpus_rows(30), CORPUS)
    queries = spark.createDataFrame(QUERIES[:2], TERMS)
    tried = spark.createDataFrame([("alpha k0",)], "tried_query string")
    found = Q.adaptive_search(corpus, queries, ["k0"], tried=tried)
    assert {r.github_query for r in found.collect()} == {"alpha AND beta OR gamma"}


def test_state_suppresses_exactly_the_texts_of_the_run_before(spark):
    rows = [(r[0], r[1], r[2], r[3].upper()) if i % 2 else r for i, r in enumerate(corpus_rows(200))]
    corpus = spark.createDataFrame(rows, CORPUS)
    queries = spark.createDataFrame(QUERIES[:5], TERMS)
    words = ["K0", "k1", "k2"]
    options = {"page_size": 5, "max_pages": 1}
    hits, sent = Q.adaptive_run(corpus, queries, words, **options)
    texts = {tuple(r) for r in sent.collect()}
    assert hits.count() > 0 and ("alpha", "alpha K0") in texts and ("alpha", "alpha K0 k1 k2") in texts
    # its first text holds the next keyword already
    assert ("k1 alpha", "k1 alpha K0") in texts and ("k1 alpha", "k1 alpha K0 k1 k2") not in texts
    state = tried_after(sent)
    again, none = Q.adaptive_run(corpus, queries, words, tried=state, **options)
    assert again.count() == 0 and none.count() == 0
    assert untried(queries, state, words).filter("trim(github_query) <> ''").count() == 0
    # a known narrower text keeps the wider search
    narrow = state.filter("tried_query = 'alpha K0 k1 k2'")
    wide, sent = Q.adaptive_run(corpus, queries.filter("github_query = 'alpha'"), words, tried=narrow, **options)
    assert wide.count() == 5 and [r.tried_query for r in sent.collect()] == ["alpha K0"]


def test_two_runs_of_the_whole_job(spark):
    corpus = spark.createDataFrame([r for r in corpus_rows(200) if r[2] == "Java"], CORPUS)
    queries = spark.createDataFrame(
        [(q[0], *q[1:], f"key {i}", "CWE-1", "name") for i, q in enumerate(QUERIES[:4])],
        TERMS + ", pattern_key string, cwe_id string, cwe_name string",
    )
    repos = spark.createDataFrame([(f"r{i}", 50 + 20 * i) for i in range(15)] + [("hot", 5000)], "repo_url string, stars_count bigint")
    first = run_search(corpus, queries, repos, n_words=3, page_size=10, max_pages=1)
    rows = first.new.collect()
    assert rows and len({r.repository for r in rows}) == len(rows) and min(r.stars for r in rows) >= 100
    assert all(r.code_snippet for r in rows) and first.tried.count() >= 4
    again = run_search(corpus, queries, repos, n_words=3, page_size=10, max_pages=1, old=first.results, tried=first.tried)
    assert again.new.count() == 0 and again.results.count() == len(rows)
    # without the state of texts the repositories alone keep results apart
    other = run_search(corpus, queries, repos, n_words=3, page_size=10, max_pages=1, old=first.results)
    assert not {r.repository for r in other.new.collect()} & {r.repository for r in rows}


def test_first_per_repository_and_stars(spark):
    hits = spark.createDataFrame(
        [(0, 1, "a", "p1"), (0, 2, "b", "p2"), (1, 1, "a", "p3"), (1, 2, "c", "p4"), (2, 1, "b", "p5")],
        "query_ord int, hit_ord int, repository string, path string",
    )
    repos = spark.createDataFrame([("a", 100), ("b", 99)], "repo_url string, stars_count bigint")
    starred = Q.with_stars(hits, repos)
    assert {r.repository: r.stars for r in starred.collect()} == {"a": 100, "b": 99, "c": 0}
    first = Q.first_per_repository(Q.popular(starred, 99))
    assert sorted((r.repository, r.path) for r in first.collect()) == [("a", "p1"), ("b", "p2")]


def test_append_keeps_new_rows_and_fills_new_columns(spark):
    old = spark.createDataFrame([("a", "p", 1), ("b", "p", 2)], "repository string, path string, n int")
    new = spark.createDataFrame(
        [("a", "p", 7, "x"), ("c", "p", 3, "y")], "repository string, path string, n int, s string"
    )
    got = {(r.repository, r.n, r.s) for r in Q.append_results(old, new).collect()}
    assert got == {("a", 7, "x"), ("b", 2, None), ("c", 3, "y")}


def test_tfidf_by_hand(spark):
    docs = [("1", "Foo bar bar"), ("2", "foo größe x9"), ("3", "!!!"), ("4", "zz yy")]
    df = spark.createDataFrame(docs, "path string, content string")
    got = {r.term: round(r.score, 6) for r in tfidf_terms(df, base_query="BAR other").collect()}
    from math import log, sqrt

    once, twice = log(5 / 2) + 1, log(5 / 3) + 1
    n1, n2 = sqrt(twice**2 + once**2), sqrt(twice**2 + 2 * once**2)
    want = {"foo": twice / n1 + twice / n2, "größe": once / n2}
    assert got == {k: round(v, 6) for k, v in want.items()}
    best = top_terms(tfidf_terms(df), 2).collect()
    assert [r.term for r in best] == ["foo", "bar"]


def test_json_results(spark):
    queries = spark.createDataFrame([("q1",), ("q2",), ("",)], "github_query string")
    hits = spark.createDataFrame(
        [("q1", "b", "p", 2), ("q1", "a", "p", 1)],
        "github_query string, repository string, path string, hit_ord int",
    )
    rows = {r.github_query: r for r in Q.results_as_json(queries, hits).collect()}
    assert rows["q1"].github_search_results == (
        '[{"repository":"a","path":"p"},{"repository":"b","path":"p"}]'
    )
    assert [rows[q].github_result_count for q in ("q1", "q2", "")] == [2, 0, 0]
    assert rows["q2"].github_search_results == "[]"


def test_keep_last_with_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("repository"),
        F.lit("p").alias("path"),
        F.col("id").alias("run"),
    )
    got = {r.repository: r.run for r in Q.keep_last(rows).collect()}
    assert got["hot"] == 2997 and len(got) == 51
    assert Counter(got.values()).most_common(1)[0][1] == 1
