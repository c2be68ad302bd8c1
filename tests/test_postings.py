import random
from collections import Counter

from pyspark.sql import functions as F

from patchlode.operators import lookup as L
from patchlode.operators import postings as P
from patchlode.operators import search as Q
from patchlode.operators.corpus import tfidf_terms, with_idf
from patchlode.session import stage

TERMS = "github_query string, source_kw array<string>, sink_kw array<string>, not_kw array<string>"
CORPUS = "repository string, path string, content string"
WORDS = ["foo", "fooBar", "barfoo", "x1", "İz", "größe", "a_b", "日本", "O", "foo.bar", "call(foo", "==", "\t", "\n", "=", " ", "foo  x1"]
KEYWORDS = ["foo", "oo", "Bar", "foo.", ".bar", "foo.bar", "oo x1", "=", "==", "= =", " ", "", "(", "call(f", "zzz", "zz.z", "ö", "本", "x1\n", "o", "İ"]


def rows_of(seed, n=150):
    rng = random.Random(seed)
    rows = [(f"r{i % 7}", f"p{i % 90}", rng.choice(["", " ", "."]).join(rng.choice(WORDS) for _ in range(rng.randrange(9)))) for i in range(n)]
    return rows + [("r", "null", None), ("r", "empty", ""), rows[0], rows[0]]


def queries_of(seed, n=60):
    rng = random.Random(seed)

    def group(most):
        return [rng.choice(KEYWORDS) for _ in range(rng.randrange(most))]

    return [(f"q{i}", group(3), group(3), group(2)) for i in range(n)] + [("all", [], [], []), ("none", [], [], [""]), ("same", ["foo", "foo"], ["foo"], [])]


def brute(rows, queries):
    def met(q, text):
        _, src, snk, neg = q
        return (not src or any(w in text for w in src)) and (not snk or any(w in text for w in snk)) and not any(w in text for w in neg)

    return Counter((q[0], r[0], r[1]) for q in queries for r in rows if met(q, r[2] or ""))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows, queries = rows_of(seed), queries_of(seed)
        index = P.build_index(spark.createDataFrame(rows, CORPUS).repartition(5))
        hits = P.search_index(index, spark.createDataFrame(queries, TERMS)).select("github_query", "repository", "path")
        assert Counter(map(tuple, hits.collect())) == brute(rows, queries)


def test_small_blocks_and_the_way_for_many_files(spark, monkeypatch):
    rows, queries = rows_of(3), queries_of(3)
    monkeypatch.setattr(P, "BLOCK", 8)
    monkeypatch.setattr(P, "MOST_BROADCAST", 0)
    index = P.build_index(spark.createDataFrame(rows, CORPUS).repartition(3))
    assert index.postings.agg(F.max(F.size("places"))).first()[0] <= 8
    hits = P.search_index(index, spark.createDataFrame(queries, TERMS)).select("github_query", "repository", "path")
    assert Counter(map(tuple, hits.collect())) == brute(rows, queries)


def test_written_and_opened_again(spark, tmp_path):
    rows = rows_of(4)
    P.write_index(spark.createDataFrame(rows, CORPUS), str(tmp_path / "index"))
    queries = queries_of(4)
    hits = P.search_index(P.open_index(spark, str(tmp_path / "index")), spark.createDataFrame(queries, TERMS))
    assert Counter(map(tuple, hits.select("github_query", "repository", "path").collect())) == brute(rows, queries)


def test_empty_corpus_and_no_queries(spark):
    empty = P.build_index(spark.createDataFrame([], CORPUS))
    assert P.search_index(empty, spark.createDataFrame(queries_of(5, 5), TERMS)).count() == 0
    index = P.build_index(spark.createDataFrame(rows_of(5, 5), CORPUS))
    assert P.search_index(index, spark.createDataFrame([], TERMS)).count() == 0


def test_no_join_without_condition_and_no_text_in_the_plan_of_hits(spark):
    index = P.build_index(spark.createDataFrame(rows_of(6), CORPUS))
    hits = P.search_index(index, spark.createDataFrame([("q", ["foo"], ["foo.bar"], ["x1"])], TERMS))
    text = hits._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # texts were read for the files in question before; the hits need keys only
    assert "content" not in text


def test_pieces(spark):
    words = spark.createDataFrame([("foo",), ("foo(",), (" new File(",), ("==",), ("",)], "word string")
    got = {(r.word, r.piece, r.how, r.n, r.verify) for r in P.keyword_pieces(words).collect()}
    assert got == {
        ("foo", "foo", "inside", 1, False), ("foo(", "foo", "end", 1, True), (" new File(", "new", "whole", 2, True),
        (" new File(", "File", "whole", 2, True), ("==", "=", "whole", 2, True),
    }


def test_cost_follows_hits_not_queries_times_files(spark):
    """Each query meets the blocks of its own word: the rows that enter the last step are those of the hits."""
    corpus = spark.range(4000).select(
        F.format_string("r%d", F.col("id")).alias("repository"), F.lit("p").alias("path"),
        F.format_string("common w%05d tail", F.col("id")).alias("content"))
    index = P.build_index(corpus)
    for n in (100, 2000):
        queries = spark.range(n).select(
            F.format_string("q%d", "id").alias("github_query"), F.array(F.lit("common")).alias("source_kw"),
            F.array(F.format_string("w%05d", F.col("id"))).alias("sink_kw"), F.array().cast("array<string>").alias("not_kw"))
        named = queries.select("github_query", *(P._group_key(g).alias(k) for k, g in zip(("source", "sink", "excluded"), P.GROUPS)))
        groups = P.group_files(index, named)
        led = stage(P.leading(named, groups), "led")
        assert led.filter(F.contains("lead", F.lit("common"))).count() == 0
        assert led.join(groups.withColumnRenamed("key", "lead"), "lead").count() == n
        assert P.search_index(index, queries).count() == n


def test_widening_words_and_marks_from_postings(spark):
    rows = rows_of(7)
    corpus = spark.createDataFrame([r for r in rows if r[2] is not None], CORPUS).distinct()
    index = P.build_index(corpus)
    direct = {r.term: round(r.score, 9) for r in tfidf_terms(corpus, ("repository", "path", "content")).collect()}
    assert {r.term: round(r.score, 9) for r in P.index_scores(index).collect()} == direct
    marks = {r.file: r.held for r in P.keyword_marks(index, ["FOO", "x1", "o"]).collect()}
    import re

    for r in index.files.collect():
        own = re.findall(r"\w+", (r.content or "").lower())
        want = 0
        for w in ("foo", "x1", "o"):
            if w not in own:
                break
            want += 1
        assert (marks.get(r.file) or 0) == want


def test_term_of_nearly_all_files_is_no_hot_key(spark):
    """One term in nine of ten files: it is joined by broadcast, and no key of the shuffled join holds more than its share."""
    pairs = spark.range(20_000).select(F.col("id").alias("file")).select(
        "file", F.explode(F.array(
            F.when(F.col("file") % 10 > 0, "hot"), F.format_string("t%d", F.col("file") % 500), F.format_string("u%d", F.col("file") % 700))).alias("term"))
    pairs = stage(pairs.filter("term is not null"), "pairs")
    weighted = with_idf(pairs, 20_000, heavy_share=1 / 100)
    want = dict(map(tuple, pairs.groupBy("term").agg((F.ln(F.lit(20_001) / (F.count("*") + 1)) + 1).alias("idf")).collect()))
    got = weighted.groupBy("term").agg(F.count("*").alias("n"), F.min("idf").alias("a"), F.max("idf").alias("b")).collect()
    assert {r.term: round(r.a, 9) for r in got} == {k: round(v, 9) for k, v in want.items()} and all(r.a == r.b for r in got)
    assert sum(r.n for r in got) == pairs.count()
    light = pairs.filter("term <> 'hot'")
    each = [r["count"] for r in light.repartition(8, "term").groupBy(F.spark_partition_id()).count().collect()]
    assert max(each) <= 2 * sorted(each)[len(each) // 2]
    assert "broadcast" in plan_of(weighted)


def test_late_lookup_shuffles_no_text(spark):
    large = spark.range(3000).select(F.format_string("r%d", F.col("id") % 1500).alias("k"), (F.col("id") % 2).alias("n"), F.format_string("text %d", "id").alias("content"))
    large = stage(large, "large")
    small = stage(spark.range(0, 1500, 50).select(F.format_string("r%d", "id").alias("k"), F.lit(1).cast("bigint").alias("n"), F.lit(7).alias("own")), "small")
    want = {(f"r{i}", 1, 7, f"text {j}") for i in range(0, 1500, 50) for j in (i, i + 1500) if j % 2 == 1}
    for most in (100, 0):
        found = L.late_lookup(small, large, ("k", "n"), ("content",), most_broadcast=most)
        assert set(map(tuple, found.collect())) == want
    few = L.late_lookup(small, large, ("k", "n"), ("content",))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in few
    passed = L.may_hold(large, small, ["k", "n"], small.count())
    assert passed.count() < 60 and "hashpartitioning(k" not in passed._jdf.queryExecution().executedPlan().toString()
    none = L.late_lookup(small.limit(0), large, ("k", "n"), ("content",), most_broadcast=0)
    assert none.count() == 0


def test_result_table_reads_texts_of_chosen_files(spark):
    corpus = stage(spark.createDataFrame([(f"r{i % 9}", f"p{i}", "Java", f"alpha {i}") for i in range(90)], "repository string, path string, lang string, content string"), "corpus")
    queries = spark.createDataFrame([("alpha", ["alpha"], [], [], "key", "CWE-1", "n")], TERMS + ", pattern_key string, cwe_id string, cwe_name string")
    repos = spark.createDataFrame([(f"r{i}", 100 * i) for i in range(9)], "repo_url string, stars_count bigint")
    hits = Q.search_corpus(corpus, queries)
    both = [{tuple(r) for r in Q.assemble_results(hits, queries, corpus, repos, most_broadcast=most).collect()} for most in (1000, 0)]
    assert both[0] == both[1] and len(both[0]) == 8
