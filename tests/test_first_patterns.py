"""First patterns are chosen among methods: no instance is made for them, and a method counts only if its commit has a fix."""

import pytest
from test_derived_tables import plan_of, rows, tables

from patchlode.operators import compile as C
from patchlode.plans import fixtures as X
from patchlode.plans import inputs as I

FOUND = "hash string, file_change_id string, method_change_id string, cwe_id string, cwe_name string, _pattern bigint"


def test_searches_need_no_instances(spark, tmp_path):
    t = tables(spark, tmp_path)
    assert I.patterns(t).count() > 0
    assert "mined" not in {name for _, folder, _, name in X._STAGED if folder == str(tmp_path)}
    assert all("/fx_" in path for path in t.fixes.inputFiles())
    want = C.compile_queries(C.representatives(I.instances(t)), keep_terms=True)
    names = [c for c in I.patterns(t).columns if c != "_pattern"]
    assert rows(I.patterns(t).select(names).drop("source_kw", "sink_kw", "not_kw")) == rows(want.select(names).drop("source_kw", "sink_kw", "not_kw"))


@pytest.mark.parametrize("missing", [(), ("0a",), ("0a", "0b", "1a"), ("2c",), ("0a", "0b", "1a", "2c", "3d")])
def test_first_of_methods_is_the_first_with_a_fix(spark, missing):
    found = spark.createDataFrame(
        [("0a", "f1", "m1", "CWE-1", None, 1), ("0b", "f2", "m2", "CWE-1", "one", 1), ("1a", "f3", "m3", "CWE-1", "two", 2), ("3d", "f1", "m4", "CWE-1", "three", 2),
         ("0a", "f1", "m0", "CWE-2", "x", 3), ("2c", "f4", "m6", "CWE-2", "y", 4), ("2c", "f4", "m6", "CWE-2", "y", 4), ("3d", None, None, "CWE-2", "z", 3),
         (None, "f9", "m9", "CWE-1", "none", 1)], FOUND)
    patterns = spark.createDataFrame([(1, "k1"), (2, "k1"), (3, "k2"), (4, "k2"), (5, "k3")], "_pattern bigint, pattern_key string")
    fixes = spark.createDataFrame([(h, c) for h in ("0a", "0b", "1a", "2c", "3d", "zz") if h not in missing for c in ("c1", "c2")] + [(None, "c3")], "hash string, cve_id string")
    records = fixes.filter("hash >= '1'")
    columns = ("cwe_id", "cwe_name", "_pattern")
    want = C.representatives(found.join(patterns, "_pattern").join(fixes.distinct(), "hash"), columns)
    assert rows(C.first_of_methods(found, patterns, records, fixes, columns)) == rows(want)


def test_lines_with_numbers_of_one_digit_do_not_meet_themselves(spark, tmp_path):
    lines = [(ok, ln, ok * 7 + ln, (ok + ln) % 3, 5.0) for ok in range(-3, 30) for ln in (0, 1, 9)] + [(None, 1, 3, 1, 5.0), (3, None, 4, 2, 5.0), (4, 1, None, 2, 5.0)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(0, 200.0), (1, 200.0), (1, 100.0), (None, 3.0)], "s_suppkey bigint, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(1).write.parquet(f"{tmp_path}/part.parquet")
    t = X.Tables(spark, str(tmp_path))
    assert plan_of(t._derive("corpus_code")).count("Join Inner") == 2
    for name in ("fx_line", "fx_repo", "file_change"):
        getattr(t, name).createOrReplaceTempView(name)
    want = rows(spark.sql(X.FIXTURE_SQL["corpus_code"]))
    assert rows(t.corpus_code) == want and want
