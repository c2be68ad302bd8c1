"""Methods with their fixes: odd hashes and ids, long lists of fixes, and how often code is shuffled."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from patchlode.operators import methods as M

HASHES = ["", "0", "0a", "0A", "abc", "zz", "no hex", "é1", "01", "d41d8cd98f00b204e9800998ecf8427e", None]


@pytest.fixture(scope="module")
def tables(spark):
    fixes = [(f"v{k}", h, f"r{k % 2}") for n, h in enumerate(HASHES) for k in range(n)] + [(None, "0a", "r"), ("v", "0a", None), (None, "0a", None)]
    files = [(f"f{n}", h, "Java", f"before {n}" * n, f"after {n}" if n % 2 else None) for n, h in enumerate(HASHES)]
    # an id with two hashes, a row that comes twice, an unknown id, another language
    files += [("f2", "zz", "JAVA", "x", "y"), files[4], (None, "0a", "Java", "x", "y"), ("f9", "zz", "Go", "x", "y")]
    methods = [(f"m{n}{k}", f"f{n}", "f", "f()", f"code {n} {k}", "1", "2", "True") for n in range(len(HASHES)) for k in range(2)]
    methods += [methods[8], ("n", None, "f", "f()", "c", "1", "2", "True"), ("l", "f3", "f", "f()", "c", None, "2", "True")]
    return (
        spark.createDataFrame(files, "file_change_id string, hash string, programming_language string, code_before string, code_after string"),
        spark.createDataFrame(fixes * 2, "cve_id string, hash string, repo_url string"),
        spark.createDataFrame(
            methods,
            "method_change_id string, file_change_id string, name string, signature string, code string, start_line string, end_line string, before_change string"),
    )


def expected(tables, unique_ids=True):
    files, fixes, methods = ([tuple(r) for r in t.collect()] for t in tables)
    if not unique_ids:
        files, methods = set(files), set(methods)
    return Counter(
        (c, h, r, f, m, name, sig, code, s, e, b, before, after)
        for f, h, lang, before, after in files
        for c, fh, r in set(fixes)
        for m, mf, name, sig, code, s, e, b in methods
        if f is not None and f == mf and h is not None and h == fh and lang.lower() == "java" and before and s and e
    )


@pytest.mark.parametrize("most", [1, 3, 1024])
def test_rows_are_those_of_the_joins(tables, monkeypatch, most):
    monkeypatch.setattr(M, "FIXES_OF_ROW", most)
    for unique in (True, False):
        wanted = expected(tables, unique)
        assert wanted and Counter(map(tuple, M.method_changes(*tables, unique_ids=unique).collect())) == wanted
        sizes = {"before": F.length("file_code_before"), "after": F.length("file_code_after")}
        short = Counter()
        for row, n in wanted.items():
            short[row[:11] + tuple(None if x is None else len(x) for x in row[11:])] += n
        assert Counter(map(tuple, M.method_changes(*tables, unique_ids=unique, of_file=sizes).collect())) == short


def test_asked_files_alone(spark, tables):
    asked = spark.createDataFrame([("f2",), ("f4",), ("f4",), (None,)], "file_change_id string")
    for of_file in (None, {"n": F.length("file_code_before")}):
        got = M.method_changes(*tables, file_change_ids=asked, of_file=of_file)
        wanted = Counter(row[4] for row in expected(tables).elements() if row[3] in ("f2", "f4"))
        assert Counter(r["method_change_id"] for r in got.collect()) == wanted


def test_a_list_of_fixes_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(M, "FIXES_OF_ROW", 4)
    fixes = spark.createDataFrame([(f"v{n % 10}", "ab", "r") for n in range(40)], "cve_id string, hash string, repo_url string")
    lists = [r["cve_ids"] for r in M.fix_lists(fixes).collect()]
    assert sorted(map(len, lists)) == [2, 4, 4] and sorted(sum(lists, [])) == [f"v{n}" for n in range(10)]


def shuffles_with(df, column):
    """How many exchanges of the plan move the column."""
    spark = df.sparkSession
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    return sum(re.search(rf"\b{column}#", found) is not None for found in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (\[.*\])", plan))


def test_code_is_shuffled_once_or_not_at_all(tables):
    whole = M.method_changes(*tables)
    assert shuffles_with(whole, "file_code_before") == 1 and shuffles_with(whole, "code_after") == 1
    sizes = M.method_changes(*tables, of_file={"n": F.length("file_code_before")}).select("cve_id", "method_change_id", "n")
    assert shuffles_with(sizes, "file_code_before") == 0 and shuffles_with(sizes, "n") == 2
