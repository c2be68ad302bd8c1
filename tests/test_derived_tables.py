"""Tables derived from the lines: made from the columns that are read, with no code on the way, and the same rows as their SQL."""

import datetime
from collections import Counter

from patchlode.operators import compile as C
from patchlode.plans import fixtures as X
from patchlode.plans import inputs as I

LINE = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double"
ORDER = "o_orderkey bigint, o_orderdate date, o_orderpriority string"


def tables(spark, folder):
    """Few lines, some with a number above nine, so that different lines have the same file; rows that come twice and nulls."""
    lines = [(ok, ln, ok * 7 + ln, (ok + ln) % 5, 50.0) for ok in range(40) for ln in (1, 2, 3, 11, 12)]
    lines += lines[:9] + [(None, 1, 3, 1, 50.0), (3, None, 4, 2, 50.0), (3, 4, None, 2, 50.0), (3, 5, 6, None, 50.0)]
    spark.createDataFrame(lines, LINE).write.parquet(f"{folder}/lineitem.parquet")
    suppliers = [(k, 200.0) for k in (0, 1, 2, 2, 3, None)]
    spark.createDataFrame(suppliers, "s_suppkey bigint, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    orders = [(ok, datetime.date(2020, 1, 1), "2-HIGH") for ok in range(40)]
    spark.createDataFrame(orders, ORDER).write.parquet(f"{folder}/orders.parquet")
    spark.range(1).write.parquet(f"{folder}/part.parquet")  # its name is a word of a description
    return X.Tables(spark, str(folder))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_code_is_made_after_the_lines_have_met(spark, tmp_path):
    t = tables(spark, tmp_path)
    plan = plan_of(t._derive("corpus_code"))
    joins = [line for line in plan.split("\n") if "Join Inner" in line]
    assert len(joins) == 3 and "(file#" in joins[-1]  # the deepest; templates are met in the first
    for name in ("fx_line", "fx_repo", "file_change"):
        getattr(t, name).createOrReplaceTempView(name)
    want = rows(spark.sql(X.FIXTURE_SQL["corpus_code"]))
    assert rows(t.corpus_code) == want and want and max(want.values()) > 1


def test_files_and_methods_are_made_from_the_lines(spark, tmp_path):
    t = tables(spark, tmp_path)
    for name in X.VIEWS:
        plan = getattr(t, name).select("file_change_id")._jdf.queryExecution().executedPlan().toString()
        assert "m_before" not in plan and "m_after" not in plan and "Join" in plan
        for other in ("fx_line", "fx_tmpl"):
            getattr(t, other).createOrReplaceTempView(other)
        assert rows(getattr(t, name)) == rows(spark.sql(X.FIXTURE_SQL[name]))


def test_instances_are_written_without_patterns_and_code(spark, tmp_path):
    t = tables(spark, tmp_path)
    whole, narrow = I.instances(t), I.instance_rows(t)
    assert set(whole.columns) - set(narrow.columns) == {"pattern", "method_code", "method_code_after"}
    assert whole.count() == narrow.count() > 0
    assert rows(whole.select("pattern_key", "method_change_id", "copies")) == rows(narrow.select("pattern_key", "method_change_id", "copies"))
    assert rows(C.compile_queries(I.first_patterns(t)).select("pattern_key", "cwe_id", "cwe_name", "github_query")) == rows(
        C.compile_queries(C.representatives(whole)).select("pattern_key", "cwe_id", "cwe_name", "github_query"))
