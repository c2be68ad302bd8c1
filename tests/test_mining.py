from collections import Counter

import pytest
from pyspark.sql import functions as F

from patchlode.operators import compile as C
from patchlode.operators import extract as X
from patchlode.operators import mining as M
from patchlode.operators.methods import method_changes
from patchlode.operators.report import query_report
from patchlode.plans.fixtures import TEMPLATES

OLD = {t: "class A {\n" + old.replace("~", "\n") + "\n}\n" for t, _, old, _ in TEMPLATES}
NEW = {t: "class A {\n" + new.replace("~", "\n") + "\n}\n" for t, _, _, new in TEMPLATES}


@pytest.fixture(scope="module")
def db(spark):
    """Two CVEs share commit h1; h1 is fixed in two repositories for v1; v2 has two weaknesses."""
    fixes = [
        ("v1", "h1", "https://github.com/o/a.git", 70),
        ("v1", "h1", "https://github.com/o/b", 80),
        ("v2", "h1", "https://github.com/o/a.git", 90),
        ("v3", "h1", None, 10),  # below the threshold, no repository
        ("v3", "h2", "https://x/c", 65),
        ("v3", "h3", "https://x/c", 64),
    ]
    commits = [
        ("h1", "https://github.com/o/a.git", None),
        ("h1", "https://github.com/o/b", False),
        ("h2", "https://x/c", False),
        ("h3", "https://x/c", False),
    ]
    files = [
        ("f1", "h1", "A.java", "Java", OLD[0], NEW[0], "d1"),
        ("f2", "h1", "B.java", "java", OLD[1], NEW[1], "d2"),
        ("f3", "h2", "MyTESTs.java", "Java", OLD[0], NEW[0], "d3"),
        ("f4", "h2", "C.java", "Go", OLD[0], NEW[0], "d4"),
        ("f5", "h2", "D.java", "Java", "None", NEW[0], "d5"),
        ("f6", "h2", "E.java", "Java", OLD[0], NEW[0], ""),
        ("f7", "h2", None, "Java", OLD[0], NEW[0], "d7"),
        ("f8", "h3", "F.java", "Java", OLD[0], NEW[0], "d8"),
    ]
    methods = [
        ("m1", "f1", "2", "5", "True"),
        ("m2", "f1", "2", "5", "False"),
        ("m3", "f1", "2.0", "5", "True"),
        ("m4", "f1", "", "5", "True"),
        ("m5", "f1", None, "5", "True"),
        ("m6", "f2", "2", "6", "true"),
    ]
    cwe = [("CWE-79", "xss"), ("CWE-22", "path"), ("CWE-1", None), ("CWE-2", "rare")]
    classes = [
        ("v1", "CWE-79"), ("v2", "CWE-79"), ("v2", "CWE-79"), ("v2", "CWE-22"),
        ("v1", "CWE-22"), ("v1", "CWE-1"), ("v2", "CWE-1"), ("v1", "CWE-2"), ("v3", "CWE-79"),
    ]
    make = spark.createDataFrame
    return {
        "fixes": make(fixes, "cve_id string, hash string, repo_url string, score bigint"),
        "commits": make(commits, "hash string, repo_url string, merge boolean").withColumns(
            {"author_date": F.lit(None).cast("timestamp"), "msg": F.lit("m")}
        ),
        "file_change": make(
            files,
            "file_change_id string, hash string, filename string, programming_language string, "
            "code_before string, code_after string, diff string",
        ),
        "method_change": make(
            methods,
            "method_change_id string, file_change_id string, start_line string, "
            "end_line string, before_change string",
        ).withColumns({"name": F.lit("f"), "signature": F.lit("f()"), "code": F.lit("x")}),
        "classification": make(classes, "cve_id string, cwe_id string"),
        "cwe": make(cwe, "cwe_id string, cwe_name string"),
    }


def records(db, **options):
    return X.extract_records(db["fixes"], db["commits"], db["file_change"], **options)


def mine(db, **options):
    tables = ("fixes", "file_change", "method_change", "classification", "cwe")
    return M.mine_patterns(records(db), *[db[t] for t in tables], **options)


def test_extract_filters_and_multiplicity(db):
    got = Counter((r.cve_id, r.file_change_id) for r in records(db).collect())
    assert got == {("v1", "f1"): 2, ("v1", "f2"): 2, ("v2", "f1"): 1, ("v2", "f2"): 1}
    loose = records(db, require_diff=False, min_score=0, languages=["GO", "java"])
    assert {r.file_change_id for r in loose.collect()} == {"f1", "f2", "f4", "f6", "f8"}
    single = records(db, single_file_only=True, min_score=0)
    assert {r.file_change_id for r in single.collect()} == {"f8"}


def test_top_cwes_and_fallback(spark, db):
    classified = X.classification_of(records(db), db["classification"], db["cwe"])
    top = [tuple(r) for r in X.top_cwes(classified, None).collect()]
    assert top == [("CWE-79", "xss", 3), ("CWE-22", "path", 2)]  # rows count; NULL names vanish
    one = X.keep_top_cwes(records(db), classified, 1)
    assert {r.cve_id for r in one.collect()} == {"v1", "v2"}
    none = classified.filter("cwe_id = 'CWE-2'")
    assert X.keep_top_cwes(records(db), none, 1).count() == records(db).count()
    assert X.keep_top_cwes(records(db), classified, 0).count() == 6


def test_methods_include_fixes_below_the_threshold(db):
    got = method_changes(db["file_change"], db["fixes"], db["method_change"])
    rows = Counter((r.cve_id, r.method_change_id) for r in got.collect())
    assert rows[("v3", "m1")] == 1 and rows[("v1", "m1")] == 2
    assert {m for _, m in rows} == {"m1", "m3", "m4", "m6"}


def test_multiplicity(db):
    # f1 is asked for by 3 records with CWE-79 and 3 with CWE-22. Methods come with every fix of
    # the hash: v1 twice, v2, v3. A fix without repository takes that of each record: same total.
    got = Counter((r.cwe_id, r.method_change_id, r.cve_id, r.repo_url) for r in mine(db).collect())
    a, b = "https://github.com/o/a.git", "https://github.com/o/b"
    for cwe, method in (("CWE-79", "m1"), ("CWE-79", "m6"), ("CWE-22", "m6")):
        assert got[(cwe, method, "v1", a)] == 3 and got[(cwe, method, "v1", b)] == 3
        assert got[(cwe, method, "v2", a)] == 3
        assert got[(cwe, method, "v3", a)] == 2 and got[(cwe, method, "v3", b)] == 1
    # The measure that file f1 lacks is missing for CWE-22 as well.
    assert got[("CWE-22", "m1", "v2", a)] == 3
    assert sum(got.values()) == 4 * 12
    assert {r.copies for r in mine(db, multiplicity="counted").collect()} == {1, 2, 3}


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1024), ("c", 1025), ("d", 5000)], "k string, n bigint")
    counts = {r.k: r["count"] for r in M.repeat_rows(df, "n").groupBy("k").count().collect()}
    assert counts == {"a": 1, "b": 1024, "c": 1025, "d": 5000}


def test_invariants_and_keys(db):
    for r in mine(db, multiplicity="counted").collect():
        s = r.pattern.summary
        assert s.has_sink == s.has_taint_flow and s.has_source
        assert r.pattern.missing_sanitizers == r.pattern.added_security_measures
        assert r.pattern_key == f"{r.cwe_id}|{r.sink_types}|{r.source_types}"
        expected = f"https://github.com/o/{'a' if r.repo_url.endswith('.git') else 'b'}/commit/h1"
        assert r.commit_link == expected


def test_representative_is_first_value_per_column(spark):
    rows = [
        ("k", "h2", "f", "m", "v", "late", "x"),
        ("k", "h1", "f", "m", "v", None, "y"),
        ("k", "h1", "f", "n", "v", "next", "z"),
    ]
    df = spark.createDataFrame(
        rows,
        "pattern_key string, hash string, file_change_id string, method_change_id string, "
        "cve_id string, cwe_name string, cwe_id string",
    )
    got = C.representatives(df, ("cwe_id", "cwe_name")).collect()
    assert [tuple(r) for r in got] == [("k", "y", "next")]


def test_report_weights_equal_repeated_rows(spark, db):
    counted = mine(db, multiplicity="counted")
    patterns = C.compile_queries(C.representatives(counted))
    weighted = query_report(C.attach_queries(counted, patterns), 3)
    repeated = query_report(C.attach_queries(mine(db), patterns), 3)
    assert sorted(map(tuple, weighted.collect())) == sorted(map(tuple, repeated.collect()))


def test_label_is_cut_but_groups_are_not_mixed(spark):
    long = "s" * 50
    rows = [("q1", "CWE-1", long + "a", "t", "k1")] * 2 + [("q2", "CWE-1", long + "b", "t", "k2")]
    rows += [("  ", "CWE-1", "x", "t", "k3"), (None, "CWE-1", "x", "t", "k3")]
    df = spark.createDataFrame(
        rows,
        "github_query string, cwe_id string, sink_types string, source_types string, "
        "pattern_key string",
    )
    got = query_report(df, kinds=("sinks",)).collect()
    assert sorted((r.category, r["rank"], r.github_query, r.instance_count) for r in got) == [
        (f"Sink-{long}", 1, "q1", 2),
        (f"Sink-{long}", 1, "q2", 1),
    ]


def test_methods_of_the_fixtures_meet_every_rule(spark):
    """Each source, sink and measure of the catalogue is found in a method, so rows and their SQL compare them all."""
    from patchlode.functions import rules as R
    from patchlode.functions.measures import added_measures, measures_in
    from patchlode.functions.taint import ALL_CATEGORIES, analyze_taint, find_sink_hits, find_sources
    from patchlode.functions.text import by_name, fold
    from patchlode.plans.fixtures import RULE_TEMPLATES, TEMPLATES

    rows = [(n, old.replace("~", "\n"), new.replace("~", "\n"), ALL_CATEGORIES) for n, _, old, new in TEMPLATES + RULE_TEMPLATES]
    df = spark.createDataFrame(rows, "n int, old string, new string, cls string")
    code = F.col("old")
    sources = {r[0] for r in df.select(F.explode(find_sources(code, fold(code), F.col("cls"))).alias("s")).select("s.rule_id").collect()}
    sinks = {r[0] for r in df.select(F.explode(find_sink_hits(code, fold(code))).alias("s")).select("s.rule_id").collect()}
    assert sources == {r.rule_id for r in R.SOURCE_RULES} and len(sources) == 33
    assert sinks == {r.rule_id for r in R.SINK_RULES} and len(sinks) == 34
    shapes = [(name, shape) for name, own in R.SECURITY_MEASURES.items() for shape in own]
    met = {shape for _, shape in shapes if df.filter(F.size(measures_in(F.col("new"), {"m": [shape]})) > 0).limit(1).count()}
    assert len(met) == len({shape for _, shape in shapes}) and len(shapes) == 48
    added = {r[0] for r in df.select(F.explode(by_name(added_measures)("old", "new"))).collect()}
    assert added == set(R.SECURITY_MEASURES)
    flows = df.select(by_name(analyze_taint)("old", "cls").alias("a")).filter("size(a.taint_flows) > 0").count()
    assert flows >= 40
