"""Queries: code analysis, pattern instances and compiled search texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as FP
from ..functions.measures import added_measures
from ..functions.rules import SOURCE_RULES
from ..functions.taint import analyze_taint, find_sink_hits, find_sources, source_class
from ..functions.text import by_name, commit_link, fold, let, line_neighbours
from ..operators import compile as C
from ..operators.extract import run_statistics
from ..operators.methods import methods_of_files
from ..operators.mining import instance_table, method_patterns, top_pattern_keys, weakness_targets
from ..session import stage_path
from ..sources import schemas
from ..sources import sinks as S
from ..sources.tables import read_csv, read_queries
from .fixtures import Tables
from .inputs import first_patterns, instance_rows, instances, mined, patterns, queried, records
from .mine import run_mining
from .oracle import CLASS_SQL
from .registry import joined, query

INSTANCE_SQL = """pattern_key, cwe_id, cwe_name, sink_types, source_types, missing_sanitizers,
    cve_id, hash, repo_url, commit_link, method_name, signature, code_diff"""


def analysed(t: Tables) -> DataFrame:
    """Every method with each set of source categories that its file's weaknesses ask for."""
    targets = weakness_targets(records(t), t.cwe_classification, t.cwe)
    wanted = targets.groupBy("file_change_id").agg(F.collect_set(source_class(F.col("cwe_id"))).alias("classes"))
    # Only the files asked for are read on; a file's classes (four at most) travel with it.
    cut = methods_of_files(t.file_change.join(wanted, "file_change_id"), t.method_change).filter("method_code <> ''")
    return cut.select(
        "file_change_id",
        "method_change_id",
        "method_code",
        F.col("code_before").alias("file_code_before"),
        F.col("code_after").alias("file_code_after"),
        F.explode("classes").alias("cls"),
    )


ANALYSED_SQL = f"""
    SELECT DISTINCT c.method_change_id, c.method_code AS code,
           {CLASS_SQL.format(cwe="w.cwe_id")} AS cls
    FROM cut_rows c JOIN wanted_rows w ON w.file_change_id = c.file_change_id
    WHERE c.method_code <> ''"""


def per_method(t: Tables, result: Column) -> DataFrame:
    """``result`` for every analysed method, computed once per row."""
    rows = analysed(t).select("method_change_id", "cls", F.explode(F.array(result)).alias("r"))
    return rows


@query(
    "tnt2_source_categories",
    f"SELECT DISTINCT cwe_id, {CLASS_SQL.format(cwe='cwe_id')} AS cls FROM cwe_classification",
)
def _(t: Tables) -> DataFrame:
    found = t.cwe_classification.select("cwe_id").distinct()
    return found.select("cwe_id", source_class(F.col("cwe_id")).alias("cls"))


@query(
    "tnt3_sources",
    f"""SELECT a.method_change_id, a.cls, s.type, s.var AS variable, count(*) AS n
        FROM ({ANALYSED_SQL}) a JOIN an_sources s ON s.code = a.code AND s.cls = a.cls
        GROUP BY a.method_change_id, a.cls, s.type, s.var""",
)
def _(t: Tables) -> DataFrame:
    code = F.col("method_code")
    sources = let(fold(code), lambda folded: find_sources(code, folded, F.col("cls")))
    rows = per_method(t, sources).select("method_change_id", "cls", F.inline("r"))
    return rows.groupBy("method_change_id", "cls", "type", "variable").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "tnt4_annotation_sources",
    f"""SELECT DISTINCT a.method_change_id, s.type, s.var AS variable
        FROM ({ANALYSED_SQL}) a JOIN an_sources s ON s.code = a.code AND s.cls = a.cls
        JOIN source_rules r ON r.rid = s.rid WHERE r.kind = 'annotation'""",
)
def _(t: Tables) -> DataFrame:
    annotations = [r for r in SOURCE_RULES if r.kind == "annotation"]
    code = F.col("method_code")
    sources = let(fold(code), lambda f: find_sources(code, f, F.col("cls"), annotations))
    rows = per_method(t, sources).select("method_change_id", F.inline("r"))
    return rows.select("method_change_id", "type", "variable").distinct()


@query(
    "tnt5_tainted_variables",
    f"""SELECT a.method_change_id, a.cls, r.vars AS tainted
        FROM ({ANALYSED_SQL}) a JOIN an_result r ON r.code = a.code AND r.cls = a.cls""",
)
def _(t: Tables) -> DataFrame:
    rows = per_method(t, by_name(analyze_taint)("method_code", "cls"))
    return rows.select(
        "method_change_id", "cls", joined("r.tainted_variables").alias("tainted")
    ).filter("tainted <> ''")


@query(
    "tnt6_sink_positions",
    f"""SELECT a.method_change_id, h.sink_name, h.pos FROM
        (SELECT DISTINCT method_change_id, code FROM ({ANALYSED_SQL})) a
        JOIN an_hits h ON h.code = a.code""",
)
def _(t: Tables) -> DataFrame:
    code = F.col("method_code")
    hits = let(fold(code), lambda folded: find_sink_hits(code, folded))
    rows = analysed(t).select("method_change_id", "method_code").distinct()
    rows = rows.select("method_change_id", F.inline(hits))
    return rows.select("method_change_id", "sink_name", F.col("at").cast("bigint").alias("pos"))


@query(
    "tnt7_taint_flows",
    f"""SELECT a.method_change_id, a.cls, r.flows
        FROM ({ANALYSED_SQL}) a JOIN an_result r ON r.code = a.code AND r.cls = a.cls
        WHERE r.flows IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    rows = per_method(t, by_name(analyze_taint)("method_code", "cls"))
    flow = F.transform("r.taint_flows", lambda f: F.concat_ws(">", f["source"], f["sink"], f["line"]))
    return rows.select("method_change_id", "cls", F.array_join(flow, "; ").alias("flows")).filter(
        "flows <> ''"
    )


@query(
    "tnt8_empty_patterns",
    """SELECT fc.file_change_id, FALSE AS has_source, FALSE AS has_sink FROM file_change fc
       WHERE fc.code_before IS NULL OR lower(fc.programming_language) <> 'java'""",
)
def _(t: Tables) -> DataFrame:
    rows = t.file_change.filter("code_before IS NULL OR lower(programming_language) <> 'java'")
    pattern = FP.extract_pattern(
        F.col("code_before"),
        F.col("code_before"),
        F.col("code_after"),
        F.col("programming_language"),
        F.lit(None).cast("string"),
    )
    made = rows.select("file_change_id", F.explode(F.array(pattern)).alias("p"))
    return made.select("file_change_id", "p.summary.has_source", "p.summary.has_sink")


PATTERN_SQL = f"""
    SELECT a.method_change_id, a.cls, coalesce(r.n_sources, 0) > 0 AS has_source,
           coalesce(r.n_sinks, 0) > 0 AS has_sink, coalesce(r.n_sinks, 0) > 0 AS has_taint_flow,
           m.missing IS NOT NULL AS missing_security
    FROM ({ANALYSED_SQL}) a
    LEFT JOIN an_result r ON r.code = a.code AND r.cls = a.cls
    JOIN cut_rows c ON c.method_change_id = a.method_change_id
    LEFT JOIN an_measures m ON m.code_before = c.code_before
      AND m.code_after IS NOT DISTINCT FROM c.code_after"""


@query("tnt9_pattern_struct", PATTERN_SQL)
def _(t: Tables) -> DataFrame:
    missing = by_name(added_measures)("file_code_before", "file_code_after")
    pattern = FP.make_pattern(by_name(analyze_taint)("method_code", "cls"), missing)
    return per_method(t, pattern).select("method_change_id", "cls", "r.summary.*")


@query(
    "sec1_added_measures",
    """SELECT fc.file_change_id, coalesce(m.missing, '') AS missing
       FROM file_change fc JOIN cut_rows c ON c.file_change_id = fc.file_change_id
       LEFT JOIN an_measures m ON m.code_before = fc.code_before
         AND m.code_after IS NOT DISTINCT FROM fc.code_after
       WHERE c.method_code <> ''""",
)
def _(t: Tables) -> DataFrame:
    # Files of a fix with a method that can be cut, by id; the code is attached once.
    fixed = t.file_change.join(t.fixes.select("hash").distinct(), "hash", "left_semi")
    ids = methods_of_files(fixed, t.method_change).filter("method_code <> ''").select("file_change_id").distinct()
    files = t.file_change.join(ids, "file_change_id", "left_semi").select(
        "file_change_id",
        F.col("code_before").alias("file_code_before"),
        F.col("code_after").alias("file_code_after"),
    )
    names = by_name(added_measures)("file_code_before", "file_code_after")
    return files.select("file_change_id", FP.sorted_names(names).alias("missing"))


@query(
    "sec2_before_code_fallback",
    """SELECT mc.method_change_id, coalesce(nullif(fc.code_before, ''), mc.code) AS compared
       FROM method_change mc JOIN file_change fc ON fc.file_change_id = mc.file_change_id""",
)
def _(t: Tables) -> DataFrame:
    both = t.method_change.join(t.file_change, "file_change_id")
    text = FP.first_filled(F.col("code_before"), F.col("code"))
    return both.select("method_change_id", text.alias("compared"))


@query("sec3_summary_flags", PATTERN_SQL.replace("a.method_change_id, a.cls,", "a.cls,", 1))
def _(t: Tables) -> DataFrame:
    missing = by_name(added_measures)("file_code_before", "file_code_after")
    pattern = FP.make_pattern(by_name(analyze_taint)("method_code", "cls"), missing)
    return per_method(t, pattern).select("cls", "r.summary.*")


@query(
    "flt10_keep_rule",
    "SELECT cwe_id, file_change_id, method_change_id FROM found_rows",
)
def _(t: Tables) -> DataFrame:
    targets = weakness_targets(records(t), t.cwe_classification, t.cwe)
    found = method_patterns(targets, t.file_change, t.method_change)
    return found.select("cwe_id", "file_change_id", "method_change_id")


@query(
    "sec4_kept_per_cwe",
    "SELECT cwe_id, count(*) AS kept, count(DISTINCT file_change_id) AS files FROM found_rows "
    "GROUP BY cwe_id",
)
def _(t: Tables) -> DataFrame:
    targets = weakness_targets(records(t), t.cwe_classification, t.cwe)
    found = method_patterns(targets, t.file_change, t.method_change)
    return found.groupBy("cwe_id").agg(
        F.count(F.lit(1)).alias("kept"), F.countDistinct("file_change_id").alias("files")
    )


@query("key1_pattern_key", "SELECT pattern_key, method_change_id, cve_id FROM counted_rows")
def _(t: Tables) -> DataFrame:
    key = FP.pattern_key(F.col("pattern"), F.col("cwe_id"))
    return instances(t).select(key.alias("pattern_key"), "method_change_id", "cve_id")


@query(
    "key2_key_parts",
    """SELECT DISTINCT pattern_key, split_part(pattern_key, '|', 2) AS sink_types,
              split_part(pattern_key, '|', 3) AS source_types FROM counted_rows""",
)
def _(t: Tables) -> DataFrame:
    key = F.col("pattern_key")
    return instance_rows(t).select(
        key, FP.key_part(key, 1).alias("sink_types"), FP.key_part(key, 2).alias("source_types")
    ).distinct()


@query(
    "key3_missing_sanitizers",
    "SELECT method_change_id, cwe_id, cve_id, missing_sanitizers FROM counted_rows",
)
def _(t: Tables) -> DataFrame:
    names = FP.sorted_names(F.col("pattern.missing_sanitizers"))
    return instances(t).select(
        "method_change_id", "cwe_id", "cve_id", names.alias("missing_sanitizers")
    )


@query(
    "key4_commit_link",
    """SELECT hash, repo_url,
              CASE WHEN contains(repo_url, 'github.com')
                   THEN regexp_replace(repo_url, '\\.git$', '') || '/commit/' || hash
                   ELSE '' END AS commit_link FROM fixes""".replace("\\\\", "\\"),
)
def _(t: Tables) -> DataFrame:
    link = commit_link(F.col("repo_url"), F.col("hash"))
    return t.fixes.select("hash", "repo_url", link.alias("commit_link"))


@query(
    "api1_api_names",
    r"""SELECT file_change_id, array_to_string(names[1:5], ',') AS api_names
        FROM (SELECT file_change_id, list_sort(list_distinct(regexp_extract_all(code_before,
                '\b(Files|Paths|Path|Runtime|ProcessBuilder|URL|URI|File|FileInputStream'
                || '|FileOutputStream|BufferedReader|PrintWriter|StringBuilder|StringBuffer'
                || '|HttpServletRequest|HttpServletResponse|ServletRequest|ServletResponse'
                || '|HttpSession|Cookie|RequestParam|PathVariable|RequestHeader|RequestBody'
                || '|PreparedStatement|Statement|Connection|ResultSet|StringEscapeUtils|ESAPI'
                || '|ObjectInputFilter)\b', 1))) AS names
              FROM file_change
              WHERE code_before IS NOT NULL AND lower(programming_language) = 'java')""",
)
def _(t: Tables) -> DataFrame:
    rows = t.file_change.filter("code_before IS NOT NULL AND lower(programming_language) = 'java'")
    names = FP.api_names(F.col("code_before"), F.col("programming_language"))
    return rows.select("file_change_id", F.array_join(names, ",").alias("api_names"))


@query(
    "win7_sink_neighbours",
    """SELECT file_change_id, CAST(n AS INTEGER) AS line_no, lag_line AS line_before, line,
              lead_line AS line_after
       FROM (SELECT file_change_id, n, line,
                    lag(line) OVER (PARTITION BY file_change_id ORDER BY n) AS lag_line,
                    lead(line) OVER (PARTITION BY file_change_id ORDER BY n) AS lead_line
             FROM (SELECT file_change_id, unnest(string_split(code_before, chr(10))) AS line,
                          generate_subscripts(string_split(code_before, chr(10)), 1) AS n
                   FROM file_change WHERE code_before IS NOT NULL))
       WHERE contains(line, 'out.print')""",
)
def _(t: Tables) -> DataFrame:
    return t.file_change.select(
        "file_change_id", F.inline(line_neighbours(F.col("code_before"), "out.print"))
    )


@query("join6_instance_pairs", "SELECT cwe_id, cve_id, method_change_id FROM instance_rows")
def _(t: Tables) -> DataFrame:
    return mined(t).select("cwe_id", "cve_id", "method_change_id")


@query(
    "prj3_instance_record",
    """SELECT cwe_id, cwe_name, cve_id, hash, repo_url, file_change_id, method_change_id,
              method_name, signature, method_code, method_code_after, missing_sanitizers,
              vars AS tainted, flows FROM instance_rows""",
)
def _(t: Tables) -> DataFrame:
    flow = F.transform(
        "pattern.taint_flows", lambda f: F.concat_ws(">", f["source"], f["sink"], f["line"])
    )
    return mined(t).select(
        "cwe_id", "cwe_name", "cve_id", "hash", "repo_url", "file_change_id",
        "method_change_id", "method_name", "signature", "method_code", "method_code_after",
        "missing_sanitizers", joined("pattern.tainted_variables").alias("tainted"),
        F.array_join(flow, "; ").alias("flows"),
    )


@query("pip3_pattern_instances", f"SELECT {INSTANCE_SQL} FROM instance_rows")
def _(t: Tables) -> DataFrame:
    return instance_table(mined(t))


@query("pip3_distinct_instances", f"SELECT {INSTANCE_SQL} FROM counted_rows")
def _(t: Tables) -> DataFrame:
    return instance_table(mined(t, multiplicity="distinct"))


@query(
    "pip4_full_run",
    f"""SELECT {INSTANCE_SQL}, github_query
        FROM (SELECT *, unnest(range(copies)) AS n FROM queried_rows)""",
)
def _(t: Tables) -> DataFrame:
    names = ("fixes", "commits", "file_change", "method_change", "cwe_classification", "cwe")
    return run_mining({n: getattr(t, n) for n in names}, top_n=None).instance_file


TOP_SQL = "SELECT cwe_id FROM cwe_counts ORDER BY fix_count DESC, cwe_id, cwe_name LIMIT 3"


@query(
    "pip4_top_run",
    f"""SELECT * FROM (
        WITH kept AS (
          SELECT e.* FROM extract_rows e WHERE e.cve_id IN (SELECT cve_id FROM class_rows WHERE cwe_id IN ({TOP_SQL}))),
        kept_classes AS (SELECT * FROM class_rows WHERE cve_id IN (SELECT cve_id FROM kept)),
        wanted AS (
          SELECT k.file_change_id, c.cwe_id, count(*) AS copies FROM kept k
          JOIN (SELECT DISTINCT cve_id, cwe_id FROM kept_classes WHERE cwe_id IN (
                  SELECT cwe_id FROM kept_classes WHERE cwe_name IS NOT NULL GROUP BY cwe_id HAVING count(*) > 1)) c ON c.cve_id = k.cve_id
          GROUP BY k.file_change_id, c.cwe_id),
        runs AS (
          SELECT r.* EXCLUDE (copies), w.copies FROM counted_rows r
          JOIN wanted w ON w.file_change_id = r.file_change_id AND w.cwe_id = r.cwe_id)
        SELECT pattern_key, cve_id, method_change_id, count(*) AS n
        FROM (SELECT *, unnest(range(copies)) AS i FROM runs) GROUP BY ALL)""",
)
def _(t: Tables) -> DataFrame:
    """The run as it is by default, for the three most frequent weaknesses."""
    names = ("fixes", "commits", "file_change", "method_change", "cwe_classification", "cwe")
    run = run_mining({n: getattr(t, n) for n in names})
    return run.instances.groupBy("pattern_key", "cve_id", "method_change_id").agg(F.count(F.lit(1)).alias("n"))


OWN_RULES = (
    ("Opened", "source", r"(\w+)\s*=\s*open\s*\(", "stream", "open"),
    ("read", "sink", r"\.readObject\s*\(", "Own", None),
    ("filtered", "measure", r"\.set\w*Filter\s*\(", None, "filter"),
)


@query(
    "rul1_own_rules",
    f"""SELECT DISTINCT w.cwe_id || '|read|Opened' AS pattern_key, c.method_change_id,
               CASE WHEN regexp_matches(coalesce(c.code_after, ''), '\\.set\\w*Filter\\s*\\(')
                     AND NOT regexp_matches(c.code_before, '\\.set\\w*Filter\\s*\\(') THEN 'filtered' ELSE '' END AS missing
        FROM cut_rows c JOIN wanted_rows w ON w.file_change_id = c.file_change_id
        JOIN fixes f ON f.hash = c.hash
        WHERE contains(c.method_code, 'in = open(request)') AND {CLASS_SQL.format(cwe="w.cwe_id")} = 'http+file+deserialization+env'
          AND w.cwe_id = 'NVD-CWE-noinfo'""",
)
def _(t: Tables) -> DataFrame:
    """A run with rules from a table alone: a source of an own category, a sink and a measure."""
    rules = t.spark.createDataFrame(list(OWN_RULES), "name string, kind string, regex string, category string, anchor string")
    names = ("fixes", "commits", "file_change", "method_change", "cwe_classification", "cwe")
    run = run_mining(
        {n: getattr(t, n) for n in names}, top_n=None, multiplicity="distinct", rules=rules, usual_rules=False)
    found = run.instances.filter("cwe_id = 'NVD-CWE-noinfo'")
    return found.select("pattern_key", "method_change_id", F.col("missing_sanitizers").alias("missing")).distinct()


@query(
    "src3_instance_csv",
    f"SELECT {INSTANCE_SQL}, github_query FROM queried_rows",
)
def _(t: Tables) -> DataFrame:
    folder = stage_path(t.spark, "instance_csv")
    S.write_instances(queried(t), folder)
    return read_csv(t.spark, f"{folder}/pattern_instances.csv", schemas.INSTANCE_FILE)


@query("snk3_instance_table", f"SELECT {INSTANCE_SQL}, github_query FROM queried_rows")
def _(t: Tables) -> DataFrame:
    return instance_table(queried(t))


@query(
    "agg2_run_statistics",
    """SELECT (SELECT count(*) FROM extract_rows) AS total_records,
              (SELECT count(DISTINCT cve_id) FROM extract_rows) AS unique_cves,
              (SELECT count(DISTINCT hash) FROM extract_rows) AS unique_commits,
              (SELECT count(DISTINCT repo_url) FROM extract_rows) AS unique_repositories,
              (SELECT count(DISTINCT filename) FROM extract_rows) AS unique_files,
              CAST((SELECT sum(copies) FROM counted_rows) AS BIGINT) AS pattern_instances,
              (SELECT count(DISTINCT pattern_key) FROM counted_rows) AS unique_pattern_keys,
              (SELECT count(DISTINCT pattern_key) FROM counted_rows) AS queries""",
)
def _(t: Tables) -> DataFrame:
    return run_statistics(records(t), instance_rows(t))


@query(
    "agg3_top_pattern_keys",
    """SELECT pattern_key, count(*) AS instance_count FROM instance_rows GROUP BY pattern_key
       ORDER BY instance_count DESC, pattern_key LIMIT 10""",
)
def _(t: Tables) -> DataFrame:
    return top_pattern_keys(instance_rows(t))


@query(
    "agg4_representatives",
    """SELECT pattern_key, cwe_id, cwe_name,
              array_to_string(list_sort(missing_list), ',') AS missing, first_sink
       FROM first_rows""",
)
def _(t: Tables) -> DataFrame:
    found = first_patterns(t)
    return found.select(
        "pattern_key", "cwe_id", "cwe_name",
        FP.sorted_names(F.col("pattern.missing_sanitizers")).alias("missing"),
        F.get("pattern.sinks", F.lit(0))["sink_name"].alias("first_sink"),
    )


TOP_PATTERN_SQL = """
    SELECT cwe_id, pattern_key, commit_count FROM (
      SELECT cwe_id, pattern_key, count(DISTINCT hash) AS commit_count FROM counted_rows
      GROUP BY cwe_id, pattern_key)
    QUALIFY row_number() OVER (PARTITION BY cwe_id ORDER BY commit_count DESC, pattern_key) = 1"""


@query("agg5_top_pattern_per_cwe", TOP_PATTERN_SQL)
def _(t: Tables) -> DataFrame:
    counted = C.with_commit_count(patterns(t), instance_rows(t))
    return C.top_pattern_per_cwe(counted).select("cwe_id", "pattern_key", "commit_count")


@query(
    "win2_first_after_sort",
    f"""SELECT q.cwe_id, q.pattern_key, q.github_query FROM query_rows q
        JOIN ({TOP_PATTERN_SQL}) p ON p.pattern_key = q.pattern_key""",
)
def _(t: Tables) -> DataFrame:
    counted = C.with_commit_count(first_patterns(t), instance_rows(t))
    return C.compile_queries(counted, top_n=1).select("cwe_id", "pattern_key", "github_query")


@query(
    "agg6_cwe_distribution",
    "SELECT cwe_id, count(*) AS pattern_count FROM query_rows GROUP BY cwe_id",
)
def _(t: Tables) -> DataFrame:
    return C.cwe_distribution(patterns(t))


@query("qry1_compiled", "SELECT pattern_key, cwe_id, cwe_name, github_query FROM query_rows")
def _(t: Tables) -> DataFrame:
    compiled = C.compile_queries(first_patterns(t))
    return compiled.select("pattern_key", "cwe_id", "cwe_name", "github_query")


@query(
    "qry2_source_keywords",
    "SELECT pattern_key, array_to_string(source_kw, ',') AS source_kw FROM query_rows",
)
def _(t: Tables) -> DataFrame:
    return patterns(t).select("pattern_key", joined("source_kw").alias("source_kw"))


@query(
    "qry3_sink_keywords",
    "SELECT pattern_key, array_to_string(sink_kw, ',') AS sink_kw FROM query_rows",
)
def _(t: Tables) -> DataFrame:
    return patterns(t).select("pattern_key", joined("sink_kw").alias("sink_kw"))


@query(
    "qry4_excluded_keywords",
    "SELECT pattern_key, array_to_string(not_kw, ',') AS not_kw FROM query_rows",
)
def _(t: Tables) -> DataFrame:
    return patterns(t).select("pattern_key", joined("not_kw").alias("not_kw"))


@query("qry5_query_text", "SELECT DISTINCT github_query FROM query_rows")
def _(t: Tables) -> DataFrame:
    terms = F.struct("source_kw", "sink_kw", "not_kw")
    return patterns(t).select(FP.query_text(terms).alias("github_query")).distinct()


@query(
    "qry6_fallback",
    """SELECT pattern_key, github_query FROM query_rows q
       JOIN word_rows w USING (pattern_key) WHERE len(w.src) + len(w.snk) + len(w.neg) = 0""",
)
def _(t: Tables) -> DataFrame:
    p = F.col("pattern")
    empty = (
        F.size(FP.source_keywords(F.transform(p["sources"], lambda s: s["type"]))) == 0
    ) & (F.size(FP.not_keywords(p["missing_sanitizers"], F.col("cwe_id"))) == 0)
    sinks = FP.sink_keywords(F.transform(p["sinks"], lambda s: s["sink_name"]), F.col("cwe_id"))
    found = first_patterns(t).filter(empty & (F.size(sinks) == 0))
    return C.compile_queries(found).select("pattern_key", "github_query")


@query(
    "qry7_language_qualifier",
    """SELECT DISTINCT github_query || ' language:java' AS behind,
              'language:java ' || github_query AS before FROM query_rows""",
)
def _(t: Tables) -> DataFrame:
    q = F.col("github_query")
    return patterns(t).select(
        FP.with_language(q, "java").alias("behind"),
        FP.with_language(q, "java", "prefix").alias("before"),
    ).distinct()


@query(
    "qry8_snippet_terms",
    r"""SELECT DISTINCT github_query,
              array_to_string(list_filter(string_split_regex(
                replace(replace(github_query, 'NOT', ' '), 'language:', ' '), '\s+'),
                lambda w: length(w) > 2), ',') AS terms FROM query_rows""",
)
def _(t: Tables) -> DataFrame:
    terms = F.array_join(FP.snippet_terms(F.col("github_query")), ",")
    return patterns(t).select("github_query", terms.alias("terms")).distinct()


@query(
    "join8_query_per_instance",
    "SELECT pattern_key, cve_id, method_change_id, cwe_id, github_query FROM queried_rows",
)
def _(t: Tables) -> DataFrame:
    return queried(t).select(
        "pattern_key", "cve_id", "method_change_id", "cwe_id", "github_query"
    )


@query("prj5_without_pattern", "SELECT pattern_key, cwe_id, cwe_name FROM query_rows")
def _(t: Tables) -> DataFrame:
    return first_patterns(t).drop("pattern")


@query(
    "snk4_pattern_file",
    "SELECT pattern_key, cwe_id, cwe_name, github_query FROM query_rows",
)
def _(t: Tables) -> DataFrame:
    folder = stage_path(t.spark, "patterns_csv")
    table = patterns(t).drop("source_kw", "sink_kw", "not_kw")
    S.write_patterns(table.withColumn("all_repo_urls", F.lit("dropped")), folder, 3)
    path = f"{folder}/{S.pattern_file_name(3)}"
    return read_csv(
        t.spark, path, "pattern_key string, cwe_id string, cwe_name string, github_query string"
    )


@query(
    "snk8_query_list", "SELECT DISTINCT cwe_id, cwe_name, github_query FROM query_rows"
)
def _(t: Tables) -> DataFrame:
    return C.query_list(patterns(t))


@query("src4_query_csv", "SELECT DISTINCT cwe_id, cwe_name, github_query FROM query_rows")
def _(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "query_csv")
    S.write_query_list(patterns(t), path)
    return read_queries(t.spark, path, "cwe_id string, cwe_name string, github_query string")


@query(
    "set4_distinct_keys", "SELECT DISTINCT pattern_key FROM counted_rows"
)
def _(t: Tables) -> DataFrame:
    return instance_rows(t).select("pattern_key").distinct()


@query(
    "set5_measure_difference",
    """SELECT a.file_change_id, a.measure FROM
         (SELECT DISTINCT fc.file_change_id, m.measure FROM file_change fc JOIN measure_rules m
          ON regexp_matches(fc.code_after, m.rx)) a
       ANTI JOIN
         (SELECT DISTINCT fc.file_change_id, m.measure FROM file_change fc JOIN measure_rules m
          ON regexp_matches(fc.code_before, m.rx)) b
       ON a.file_change_id = b.file_change_id AND a.measure = b.measure""",
)
def _(t: Tables) -> DataFrame:
    names = by_name(added_measures)("code_before", "code_after")
    return t.file_change.select("file_change_id", F.explode(names).alias("measure"))


@query(
    "srt5_sorted_names",
    """SELECT method_change_id, cwe_id, cve_id, sink_types, source_types FROM counted_rows""",
)
def _(t: Tables) -> DataFrame:
    sinks = FP.sorted_names(F.transform("pattern.sinks", lambda s: s["sink_name"]))
    sources = FP.sorted_names(F.transform("pattern.sources", lambda s: s["type"]))
    return instances(t).select(
        "method_change_id", "cwe_id", "cve_id",
        sinks.alias("sink_types"), sources.alias("source_types"),
    )
