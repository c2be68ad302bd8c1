import os

import pytest
from pyspark.sql import functions as F

from patchlode.sources import sinks, tables
from patchlode.sources.schemas import FIX_TABLES
from patchlode.sources.versioned import Conflict, ResultTable
from patchlode.streaming import incremental as I

SETTINGS = {
    "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p", "DB_HOST": "h", "POSTGRES_PORT": "1",
    "POSTGRES_DB": "d",
}


def test_database_options():
    options = tables.database_options(SETTINGS)
    assert options["url"] == "jdbc:postgresql://h:1/d" and options["user"] == "u"
    with pytest.raises(ValueError, match="DB_HOST"):
        tables.database_options({**SETTINGS, "DB_HOST": ""})
    parts = tables.split_predicates("fixes", 3)
    assert len(parts) == 3 and all("hash" in p for p in parts) and parts[2].endswith("= 2")
    assert set(tables.SPLIT_COLUMNS) == set(FIX_TABLES)
    ranges = tables.split_predicates("file_change", 4)
    assert ranges[0] == "(file_change_id < '40000000' OR file_change_id IS NULL)" and len(ranges) == 4
    assert ranges[1] == "file_change_id >= '40000000' AND file_change_id < '80000000'"
    assert tables.split_predicates("cwe", 9, ["a'b", "c"])[1] == "cwe_id >= 'a''b' AND cwe_id < 'c'"
    assert tables.split_predicates("file_change", 1) == ["1 = 1"]


def test_declared_schemas_parse(spark):
    for ddl in FIX_TABLES.values():
        assert spark.createDataFrame([], ddl).columns


def test_csv_round_trip(spark, tmp_path):
    rows = [("a", 'say "hi", \\ ok', None), ("b", "two\nlines\r\nmore", ""), ("c", "ü,;", "x")]
    df = spark.createDataFrame(rows, "k string, github_query string, n string")
    sinks.write_csv(df, f"{tmp_path}/t.csv")
    schema = "k string, github_query string, n string"
    back = tables.read_queries(spark, f"{tmp_path}/t.csv", schema).orderBy("k").collect()
    assert [tuple(r) for r in back] == rows
    sinks.write_csv(df.drop("github_query"), f"{tmp_path}/u.csv")
    with pytest.raises(ValueError, match="github_query"):
        tables.read_queries(spark, f"{tmp_path}/u.csv", "k string, n string")


def test_instances_are_compressed_and_read_back(spark, tmp_path):
    code = 'if (a) {\n  x("\\n");\r\n}'
    rows = [(f"key {n % 3}", "CWE-79", None, "", f"v{n}", code * 20, "a AND b") for n in range(500)]
    columns = "pattern_key string, cwe_id string, cwe_name string, sink_types string, cve_id string, code_diff string, github_query string"
    df = spark.createDataFrame(rows, columns)
    sizes = {}
    for name, options in (("usual", {}), ("plain", {"compression": "none"})):
        sinks.write_instances(df, f"{tmp_path}/{name}", **options)
        folder = tmp_path / name / "pattern_instances.csv"
        back = tables.read_csv(spark, str(folder), ", ".join(f"{c} string" for c in sinks.instance_table(df).columns))
        assert sorted(map(str, back.select(df.columns).collect())) == sorted(map(str, df.collect()))
        sizes[name] = sum(f.stat().st_size for f in folder.glob("part-*"))
    assert sizes["usual"] < sizes["plain"] / 3


def test_nested_columns_become_json(spark, tmp_path):
    df = spark.range(1).select(F.array(F.lit("a")).alias("x"))
    sinks.write_csv(df, f"{tmp_path}/n.csv")
    assert tables.read_csv(spark, f"{tmp_path}/n.csv", "x string").first().x == '["a"]'


def test_code_tree_drops_bad_bytes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "A.java").write_bytes(b"class A {} // \xff\xfe ok \xc3\xbc")
    (tmp_path / "B.py").write_text("no")
    rows = tables.read_code_tree(spark, str(tmp_path), "java").collect()
    assert [r.content for r in rows] == ["class A {} //  ok ü"]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS layout LOCATION '{tmp_path}/layout'")
    ids = spark.range(100).select(F.col("id").cast("string").alias("file_change_id"))
    two = {
        "file_change": ids.withColumn("code", F.lit("x")),
        "method_change": ids.withColumn("m", F.lit("y")),
    }
    sinks.write_clustered(two, 4, "layout.")
    both = spark.table("layout.file_change").hint("merge").join(
        spark.table("layout.method_change"), "file_change_id"
    )
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and both.count() == 100


SCHEMA = "query_ord int, hit_ord bigint, repository string, path string"


def write_part(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_first_hits_over_several_runs(spark, tmp_path):
    data, state, progress = (f"{tmp_path}/{n}" for n in ("data", "state", "progress"))
    write_part(spark, [(0, 2, "a", "p2"), (0, 1, "a", "p1"), (0, 3, "b", "p3")], data)
    for _ in range(2):  # the second run has nothing to do
        I.first_hits(I.read_new_files(spark, data, SCHEMA), state, progress)
    write_part(spark, [(0, 0, "a", "p0"), (0, 5, "c", "p5")], data)
    I.first_hits(I.read_new_files(spark, data, SCHEMA), state, progress)
    got = spark.read.schema(f"{SCHEMA}, batch int").parquet(state).collect()
    assert {(r.repository, r.path, r.batch) for r in got} == {
        ("a", "p1", 0), ("b", "p3", 0), ("c", "p5", 1),
    }


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    data, state, progress = (f"{tmp_path}/{n}" for n in ("data", "state", "progress"))
    write_part(spark, [(0, 1, "a", "p1"), (0, 2, "b", "p2")], data)
    I.first_hits(I.read_new_files(spark, data, SCHEMA), state, progress)
    for name in ("0", ".0.crc"):  # the state was written, but the batch not yet marked as done
        os.remove(f"{progress}/commits/{name}")
    I.first_hits(I.read_new_files(spark, data, SCHEMA), state, progress)
    assert spark.read.parquet(state).count() == 2


def test_state_of_another_checkpoint_is_refused(spark, tmp_path):
    data, state = f"{tmp_path}/data", f"{tmp_path}/state"
    write_part(spark, [(0, 1, "a", "p1")], data)
    I.first_hits(I.read_new_files(spark, data, SCHEMA), state, f"{tmp_path}/one")
    with pytest.raises(ValueError, match="not the checkpoint"):
        I.first_hits(I.read_new_files(spark, data, SCHEMA), state, f"{tmp_path}/two")
    with pytest.raises(ValueError, match="not the checkpoint"):
        I.latest_results(I.read_new_files(spark, data, SCHEMA), state, f"{tmp_path}/two")


def test_keyed_state_over_many_batches(spark, tmp_path):
    data, state, progress = (f"{tmp_path}/{n}" for n in ("data", "state", "progress"))
    latest, own = f"{tmp_path}/latest", f"{tmp_path}/own"
    for n in range(5):
        write_part(spark, [(0, n, "a", "p"), (0, n, f"r{n // 2}", "p"), (0, n, None, "p")], data)
        I.first_hits(I.read_new_files(spark, data, SCHEMA), state, progress)
        I.latest_results(I.read_new_files(spark, data, SCHEMA), latest, own, fan=2)
    got = spark.read.schema(f"{SCHEMA}, batch int").parquet(state).collect()
    assert {(r.repository, r.hit_ord, r.batch) for r in got} == {("a", 0, 0), ("r0", 0, 0), ("r1", 2, 2), ("r2", 4, 4), (None, 0, 0)}
    assert len(got) == 5
    rows = I.read_latest(spark, latest, SCHEMA).collect()
    assert {(r.repository, r.hit_ord) for r in rows} == {("a", 4), ("r0", 1), ("r1", 3), ("r2", 4), (None, 4)}
    # five batches are two runs: four merged by twos, and the last
    assert [run.level for run in ResultTable(spark, latest, SCHEMA).version().runs] == [2, 0]
    # the state is keyed: a batch that holds one key updates one row of it
    write_part(spark, [(0, 9, "a", "p")], data)
    query = I.first_hits(I.read_new_files(spark, data, SCHEMA), state, progress)
    updated = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert [s["numRowsUpdated"] for s in updated] == [1] and updated[0]["numRowsTotal"] == 5
    assert spark.conf.get(I.PROVIDER, None) in (None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")


def test_blanks_around_values_survive_a_file(spark, tmp_path):
    rows = [(" NOT escape", "a, b "), ("\ttab", ' "q" '), ("", "x")]
    path = str(tmp_path / "f.csv")
    sinks.write_csv(spark.createDataFrame(rows, "github_query string, note string"), path)
    got = tables.read_csv(spark, path, "github_query string, note string").collect()
    assert {(r.github_query or "", r.note) for r in got} == set(rows)


RESULTS = "repository string, path string, n int"


def results(spark, rows):
    return spark.createDataFrame(rows, RESULTS)


def plain(df):
    return {(r.repository, r.path, r.n) for r in df.collect()}


def test_commits_are_whole_or_not_at_all(spark, tmp_path):
    table = ResultTable(spark, str(tmp_path / "t"), RESULTS, order_by=("n",))
    assert plain(table.read()) == set() and table.version().number == 0
    table.commit(results(spark, [("a", "p", 1), ("a", "p", 2), ("b", "p", 1), (None, "p", 1)]), "run-1")
    before = table.read()
    table.write_data(results(spark, [("a", "p", 99)]), "run-2")  # a writer is lost here
    assert plain(table.read()) == {("a", "p", 2), ("b", "p", 1), (None, "p", 1)}
    table.commit(results(spark, [("a", "p", 0), ("c", "p", 5)]), "run-2")
    after = {("a", "p", 0), ("b", "p", 1), (None, "p", 1), ("c", "p", 5)}
    number = table.version().number
    table.commit(results(spark, [("zz", "p", 1)]), "run-2")
    assert plain(table.read()) == after and table.version().number == number
    # a reader that started before keeps its rows, and an old version can be read
    assert plain(before) == plain(table.read(1)) == {("a", "p", 2), ("b", "p", 1), (None, "p", 1)}


def test_two_writers_and_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = ResultTable(spark, path, RESULTS), ResultTable(spark, path, RESULTS)
    stale = two.version()
    one.commit(results(spark, [("a", "p", 1)]), "one")
    with pytest.raises(Conflict):
        two._publish(stale, [], [])
    two.version, calls = (lambda real: lambda number=None: stale if not calls.append(1) and len(calls) == 1 else real(number))(two.version), []
    two.commit(spark.createDataFrame([("p", "b", "more")], "path string, repository string, other string"), "two")
    assert plain(one.read()) == {("a", "p", 1), ("b", "p", None)}


def test_compaction_by_levels_and_vacuum(spark, tmp_path):
    table = ResultTable(spark, str(tmp_path / "t"), RESULTS, order_by=("n",), fan=2)
    want = {}
    for n in range(7):
        rows = [("hot", "p", n), (f"r{n % 3}", "p", n)]
        want.update({r[0]: r for r in rows})
        table.commit(results(spark, rows), f"run-{n}")
        assert plain(table.read()) == set(want.values())
    assert [r.level for r in table.version().runs] == [2, 1, 0]
    gone = table.vacuum()
    assert len(gone) >= 7 and plain(table.read()) == set(want.values()) and len(table.versions()) == 1
    table.commit(results(spark, [("hot", "p", 50)]), "run-7")
    assert ("hot", "p", 50) in plain(table.read()) and [r.level for r in table.version().runs] == [3]
    assert table.vacuum() and plain(table.read()) == {*set(want.values()) - {want["hot"]}, ("hot", "p", 50)}


def test_append_result_table_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_result_table(results(spark, [("a", "p", 1)]), path, "run-1")
    table = sinks.append_result_table(spark.createDataFrame([("a", "q", "x")], "repository string, path string, s string"), path, "run-2")
    assert table.read().columns == ["repository", "path", "n"] and plain(table.read()) == {("a", "p", 1), ("a", "q", None)}


def test_latest_results(spark, tmp_path):
    data, state, progress = (f"{tmp_path}/{n}" for n in ("data", "state", "progress"))
    for rows in ([(0, 9, "a", "p"), (0, 8, "a", "p"), (0, 1, "b", "p")], [(0, 2, "a", "p")]):
        write_part(spark, rows, data)
        I.latest_results(I.read_new_files(spark, data, SCHEMA), state, progress)
    got = I.read_latest(spark, state, SCHEMA).collect()
    assert {(r.repository, r.hit_ord) for r in got} == {("a", 2), ("b", 1)}


def test_untried(spark):
    queries = spark.createDataFrame([("q1",), ("q2",)], "github_query string")
    tried = I.tried_after(queries.filter("github_query = 'q1'"))
    assert [r.github_query for r in I.untried(queries, tried).collect()] == ["q2"]
