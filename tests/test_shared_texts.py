"""Files that share a text: it is indexed, cut and analysed once, and each file keeps its results."""

from collections import Counter

from patchlode.operators import compile as C
from patchlode.operators import mining as M
from patchlode.operators import postings as P
from patchlode.operators import search as Q

TERMS = "github_query string, source_kw array<string>, sink_kw array<string>, not_kw array<string>"
BEFORE = 'class A {\nvoid f(HttpServletRequest request) {\n  String a = request.getParameter("q");\n  out.println(a);\n}\n}\n'
AFTER = BEFORE.replace("println(a)", "println(StringEscapeUtils.escapeHtml(a))")


def test_a_text_is_indexed_once_and_each_of_its_files_found(spark):
    rows = [(f"r{i % 5}", f"p{i:03}", ("alpha beta", "alpha", "gamma")[i % 3]) for i in range(300)] + [(None, "n", "alpha")] * 2
    index = P.build_index(spark.createDataFrame(rows, "repository string, path string, content string").repartition(4))
    assert index.files.count() == 3 and index.names.count() == 302
    queries = spark.createDataFrame([("a", ["alpha"], [], []), ("b", ["beta", "gamma"], [], ["alp"])], TERMS)
    hits = P.search_index(index, queries)
    want = Counter([("a", *r[:2]) for r in rows if "alpha" in r[2]] + [("b", *r[:2]) for r in rows if r[2] == "gamma"])
    assert Counter(map(tuple, hits.collect())) == want
    capped = {(r.github_query, r.repository, r.path, r.hit_ord) for r in Q.cap_per_query(hits, 3).collect()}
    assert {c for c in capped if c[0] == "b"} == {("b", "r0", f"p{p:03}", n) for n, p in enumerate((5, 20, 35), 1)}
    assert {c for c in capped if c[0] == "a"} == {("a", None, "n", 1), ("a", None, "n", 2), ("a", "r0", "p000", 3)}


def test_a_pattern_is_made_once_for_files_with_the_same_texts(spark):
    n = 40
    targets = spark.createDataFrame([(f"f{i}", "CWE-79", "xss", 1) for i in range(n)], "file_change_id string, cwe_id string, cwe_name string, copies bigint")
    files = spark.createDataFrame(
        [(f"f{i}", f"h{i}", "Java", BEFORE, (AFTER, BEFORE)[i % 2], f"d{i}") for i in range(n)],
        "file_change_id string, hash string, programming_language string, code_before string, code_after string, diff string")
    methods = spark.createDataFrame(
        [(f"m{i}", f"f{i}", "f", "f()", "2", "5", "True") for i in range(n)],
        "method_change_id string, file_change_id string, name string, signature string, start_line string, end_line string, before_change string")
    found, patterns = M.placed_patterns(targets, files, methods)
    assert patterns.count() == 2 and found.count() == n
    rows = M.method_patterns(targets, files, methods).collect()
    assert {(r.file_change_id, r.method_change_id, r.diff, r.copies) for r in rows} == {(f"f{i}", f"m{i}", f"d{i}", 1) for i in range(n)}
    assert all(("escapeHtml" in r.method_code_after) == bool(r.pattern.missing_sanitizers) == (int(r.hash[1:]) % 2 == 0) for r in rows)


def test_representative_is_found_among_rows_with_the_least_leading_number(spark):
    rows = [("k", f"same prefix {i:02}", "f", "m", "v", None if i < 3 else f"name {i}", f"c{i}") for i in range(9, -1, -1)]
    rows += [("l", None, "f", "m", "v", "n", None), ("l", "", "f", "m", "v", "o", "c"), (None, "h", "f", "m", "v", None, None)]
    df = spark.createDataFrame(rows, "pattern_key string, hash string, file_change_id string, method_change_id string, cve_id string, cwe_name string, cwe_id string")
    got = {tuple(r) for r in C.representatives(df, ("cwe_id", "cwe_name")).collect()}
    assert got == {("k", "c0", "name 3"), ("l", "c", "n"), (None, None, None)}
