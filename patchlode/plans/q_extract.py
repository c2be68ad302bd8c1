"""Queries: scans, filters, projections, joins and counts of the fix tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_filled, raw_url, safe_name
from ..operators import extract as X
from ..operators import profile as P
from ..operators.corpus import files_of_language
from ..operators.methods import method_changes, usable_methods, with_method_code
from ..sources import sinks as S
from ..sources.tables import flatten_hits, read_csv, run_query
from ..session import stage, stage_path
from .fixtures import Tables
from .inputs import classified, full_records, records
from .registry import query

RECORD_IDS = ["cve_id", "repo_url", "hash", "score", "file_change_id", "filename"]
RECORD_ID_SQL = "cve_id, repo_url, hash, score, file_change_id, filename"


@query(
    "src1_table_scan",
    "SELECT cve_id, hash, repo_url, rel_type, score, extraction_status FROM fixes",
)
def _(t: Tables) -> DataFrame:
    return t.fixes.select("cve_id", "hash", "repo_url", "rel_type", "score", "extraction_status")


@query(
    "src2_parameterised",
    "SELECT cve_id, hash, score FROM fixes WHERE score >= 80 AND rel_type = 'CPE_DIRECT_COMMIT'",
)
def _(t: Tables) -> DataFrame:
    text = "SELECT cve_id, hash, score FROM {fix} WHERE score >= :low AND rel_type = :kind"
    return run_query(t.spark, text, {"low": 80, "kind": "CPE_DIRECT_COMMIT"}, fix=t.fixes)


@query(
    "src5_language_files",
    "SELECT repository, path, content FROM corpus_code WHERE suffix(path, '.java')",
)
def _(t: Tables) -> DataFrame:
    return files_of_language(t.corpus_code, "Java").select("repository", "path", "content")


@query(
    "src6_flatten_hits",
    """
    SELECT event_id,
           CASE WHEN user_id % 3 = 0 THEN '' ELSE 'o/r' || CAST(user_id AS STRING) END
             AS repository,
           CASE WHEN user_id % 3 = 0 THEN '' ELSE 'https://h/' || CAST(user_id AS STRING) END
             AS repository_url,
           event_type || CAST(n AS STRING) AS path, '' AS url,
           CASE WHEN n = 2 THEN '' ELSE 'https://h/' || event_type END AS html_url, '' AS sha
    FROM events CROSS JOIN (VALUES (1), (2)) AS k(n)""",
)
def _(t: Tables) -> DataFrame:
    user = F.col("user_id").cast("string")
    repository = F.when(
        F.col("user_id") % 3 != 0,
        F.struct(
            F.concat(F.lit("o/r"), user).alias("full_name"),
            F.concat(F.lit("https://h/"), user).alias("html_url"),
        ),
    )
    page = F.concat(F.lit("https://h/"), F.col("event_type"))

    def item(n: int):
        return F.struct(
            repository.alias("repository"),
            F.concat("event_type", F.lit(str(n))).alias("path"),
            (page if n == 1 else F.lit(None).cast("string")).alias("html_url"),
        )

    response = F.to_json(F.struct(F.array(item(1), item(2)).alias("items")))
    return flatten_hits(t.events.select("event_id", response.alias("response")))


@query(
    "snk1_extract_output",
    """SELECT cve_id, repo_url, hash, score, author_date, msg, file_change_id, filename,
              programming_language, diff FROM extract_rows""",
)
def _(t: Tables) -> DataFrame:
    return S.extract_output(full_records(t))


@query("snk2_top_cwe_output", "SELECT cwe_id, cwe_name, fix_count AS fixes_cve_count FROM cwe_counts")
def _(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "top_cwe_csv")
    S.write_csv(S.top_cwe_output(X.top_cwes(classified(t), None)), path)
    return read_csv(t.spark, path, "cwe_id string, cwe_name string, fixes_cve_count bigint")


@query("flt1_good_fixes", "SELECT cve_id, hash, repo_url, score FROM fixes WHERE score >= 65")
def _(t: Tables) -> DataFrame:
    return X.good_fixes(t.fixes)


@query(
    "flt2_non_empty_diff",
    "SELECT file_change_id, diff FROM file_change WHERE coalesce(diff, '') <> ''",
)
def _(t: Tables) -> DataFrame:
    return t.file_change.filter(X.has_diff()).select("file_change_id", "diff")


@query(
    "flt3_no_merges",
    "SELECT hash, repo_url FROM commits WHERE coalesce(merge, FALSE) = FALSE",
)
def _(t: Tables) -> DataFrame:
    return t.commits.filter(X.not_merge()).select("hash", "repo_url")


@query(
    "flt4_code_before",
    """SELECT file_change_id, length(code_before) AS n_chars FROM file_change
       WHERE code_before IS NOT NULL AND code_before <> 'None'""",
)
def _(t: Tables) -> DataFrame:
    size = F.length("code_before").cast("bigint").alias("n_chars")
    return t.file_change.filter(X.has_code()).select("file_change_id", size)


@query(
    "flt5_no_test_files",
    "SELECT file_change_id, filename FROM file_change WHERE filename NOT ILIKE '%Test%'",
)
def _(t: Tables) -> DataFrame:
    return t.file_change.filter(X.not_test_file()).select("file_change_id", "filename")


@query(
    "flt6_languages",
    """SELECT file_change_id, programming_language FROM file_change
       WHERE lower(programming_language) IN ('java', 'go')""",
)
def _(t: Tables) -> DataFrame:
    chosen = t.file_change.filter(X.in_languages(["JAVA", "Go"]))
    return chosen.select("file_change_id", "programming_language")


@query(
    "flt7_methods_of_files",
    """SELECT cve_id, hash, repo_url, file_change_id, method_change_id FROM method_rows
       WHERE file_change_id IN (SELECT file_change_id FROM extract_rows)""",
)
def _(t: Tables) -> DataFrame:
    found = method_changes(
        t.file_change, t.fixes, t.method_change, file_change_ids=records(t)
    )
    return found.select("cve_id", "hash", "repo_url", "file_change_id", "method_change_id")


@query(
    "flt8_usable_methods",
    """SELECT method_change_id, start_line, end_line FROM method_change
       WHERE start_line IS NOT NULL AND end_line IS NOT NULL AND lower(before_change) = 'true'""",
)
def _(t: Tables) -> DataFrame:
    return usable_methods(t.method_change).select("method_change_id", "start_line", "end_line")


@query("flt9_minimum_group", "SELECT cwe_id, cwe_name, fix_count FROM cwe_counts")
def _(t: Tables) -> DataFrame:
    return X.frequent_cwes(classified(t))


@query(
    "flt14_records_of_cwe",
    f"""SELECT {RECORD_ID_SQL} FROM extract_rows
        WHERE cve_id IN (SELECT cve_id FROM cwe_classification WHERE cwe_id = 'CWE-79')""",
)
def _(t: Tables) -> DataFrame:
    return X.records_of_cwe(records(t), "CWE-79", classified(t)).select(*RECORD_IDS)


@query(
    "flt15_cwes_of_cve",
    """SELECT cc.cve_id, cc.cwe_id, c.cwe_name, c.description AS cwe_description
       FROM cwe_classification cc JOIN cwe c ON cc.cwe_id = c.cwe_id
       WHERE cc.cve_id = 'CVE-2018-18'""",
)
def _(t: Tables) -> DataFrame:
    return P.cwes_of_cve(t.cwe_classification, t.cwe, "CVE-2018-18")


@query(
    "flt16_direct_commits",
    "SELECT cve_id, hash, rel_type FROM fixes WHERE rel_type LIKE '%DIRECT_COMMIT'",
)
def _(t: Tables) -> DataFrame:
    return P.direct_commits(t.fixes).select("cve_id", "hash", "rel_type")


@query(
    "prj1_extract_columns",
    """SELECT cve_id, repo_url, hash, score, author_date, msg, file_change_id, filename,
              programming_language, code_before, code_after, diff FROM extract_rows""",
)
def _(t: Tables) -> DataFrame:
    return full_records(t)


@query(
    "prj2_method_columns",
    """SELECT cve_id, hash, repo_url, file_change_id, method_change_id, method_name, signature,
              code_after, start_line, end_line, before_change, file_code_before, file_code_after
       FROM method_rows""",
)
def _(t: Tables) -> DataFrame:
    return method_changes(t.file_change, t.fixes, t.method_change)


@query(
    "prj4_first_filled",
    """SELECT file_change_id, coalesce(nullif(diff, ''), filename) AS label FROM file_change""",
)
def _(t: Tables) -> DataFrame:
    label = first_filled(F.col("diff"), F.col("filename"))
    return t.file_change.select("file_change_id", label.alias("label"))


@query(
    "join1_fixes_commits",
    """SELECT f.cve_id, f.hash, f.repo_url, c.author_date FROM fixes f
       JOIN commits c ON c.hash = f.hash AND c.repo_url = f.repo_url""",
)
def _(t: Tables) -> DataFrame:
    both = t.fixes.join(t.commits, ["hash", "repo_url"])
    return both.select("cve_id", "hash", "repo_url", "author_date")


@query(
    "join2_fixes_files",
    """SELECT f.cve_id, f.repo_url, f.hash, fc.file_change_id FROM fixes f
       JOIN commits c ON c.hash = f.hash AND c.repo_url = f.repo_url
       JOIN file_change fc ON fc.hash = f.hash""",
)
def _(t: Tables) -> DataFrame:
    both = t.fixes.join(t.commits.select("hash", "repo_url"), ["hash", "repo_url"])
    both = both.join(t.file_change.select("hash", "file_change_id"), "hash")
    return both.select("cve_id", "repo_url", "hash", "file_change_id")


@query(
    "join3_methods_of_all_fixes",
    "SELECT cve_id, hash, file_change_id, method_change_id FROM method_rows",
)
def _(t: Tables) -> DataFrame:
    found = method_changes(t.file_change, t.fixes, t.method_change)
    return found.select("cve_id", "hash", "file_change_id", "method_change_id")


@query("join4_classification", "SELECT cve_id, cwe_id, cwe_name FROM class_rows")
def _(t: Tables) -> DataFrame:
    return classified(t)


@query(
    "join5_membership",
    """SELECT cve_id, severity FROM cve WHERE cve_id IN (SELECT cve_id FROM extract_rows)""",
)
def _(t: Tables) -> DataFrame:
    wanted = records(t).select("cve_id").distinct()
    return t.cve.join(wanted, "cve_id", "left_semi").select("cve_id", "severity")


@query(
    "join7_last_diff",
    """SELECT fc.file_change_id, coalesce(d.diff, '') AS code_diff FROM file_change fc
       LEFT JOIN (SELECT file_change_id, arg_max(diff, cve_id || repo_url) AS diff
                  FROM extract_rows GROUP BY file_change_id) d
         ON d.file_change_id = fc.file_change_id""",
)
def _(t: Tables) -> DataFrame:
    files = t.file_change.select("file_change_id")
    return X.with_diff(files, records(t), ["cve_id", "repo_url"])


@query(
    "join9_records_with_methods",
    """SELECT f.cve_id, f.hash AS commit_hash, f.repo_url, fc.file_change_id, fc.filename,
              fc.programming_language, fc.code_before AS vulnerable_code,
              fc.code_after AS fixed_code, mc.signature, mc.code AS method_code
       FROM fixes f JOIN commits c ON f.hash = c.hash JOIN file_change fc ON c.hash = fc.hash
       LEFT JOIN method_change mc ON fc.file_change_id = mc.file_change_id
       WHERE fc.programming_language IN ('Java', 'Go') AND fc.code_before IS NOT NULL
         AND f.score >= 65""",
)
def _(t: Tables) -> DataFrame:
    return P.records_with_methods(t.fixes, t.commits, t.file_change, t.method_change)


@query(
    "join12_product_route",
    """SELECT c.cve_id, c.severity, m.cpe_name, p.repo_url, p.rel_type, r.owner, r.stars_count
       FROM cve c JOIN cve_cpe_mapper m ON m.cve_id = c.cve_id
       JOIN cpe_project p ON p.cpe_name = m.cpe_name
       JOIN repository r ON r.repo_url = p.repo_url""",
)
def _(t: Tables) -> DataFrame:
    return P.repositories_by_product(t.cve, t.cve_cpe_mapper, t.cpe_project, t.repository)


@query(
    "join13_project_route",
    """SELECT c.cve_id, c.severity, p.project_url AS repo_url, p.rel_type, r.owner, r.stars_count
       FROM cve c JOIN cve_project p ON p.cve = c.cve_id
       JOIN repository r ON r.repo_url = p.project_url""",
)
def _(t: Tables) -> DataFrame:
    found = P.repositories_by_project(t.cve, t.cve_project, t.repository)
    return found.select("cve_id", "severity", "repo_url", "rel_type", "owner", "stars_count")


@query(
    "agg1_top_cwes",
    """SELECT cwe_id, cwe_name, fix_count FROM cwe_counts
       ORDER BY fix_count DESC, cwe_id, cwe_name LIMIT 3""",
)
def _(t: Tables) -> DataFrame:
    return X.top_cwes(classified(t), 3)


@query(
    "agg2_record_statistics",
    """SELECT count(*) AS total_records, count(DISTINCT cve_id) AS unique_cves,
              count(DISTINCT hash) AS unique_commits,
              count(DISTINCT repo_url) AS unique_repositories,
              count(DISTINCT filename) AS unique_files FROM extract_rows""",
)
def _(t: Tables) -> DataFrame:
    return X.run_statistics(records(t))


@query(
    "agg2_merged_statistics",
    """SELECT count(*) AS total_records, count(DISTINCT cve_id) AS unique_cves,
              count(DISTINCT hash) AS unique_commits, count(DISTINCT repo_url) AS unique_repositories,
              count(DISTINCT filename) AS unique_files, TRUE AS cves_near, TRUE AS commits_near,
              TRUE AS repositories_near, TRUE AS files_near FROM extract_rows""",
)
def _(t: Tables) -> DataFrame:
    """Five runs keep a sketch row each, which are merged; estimates stand within four standard errors of the exact counts."""
    runs = records(t).withColumn("run", F.pmod(F.xxhash64("hash"), F.lit(5)))
    kept = stage(X.statistics_sketches(runs, "run"), "statistics")
    merged, exact = X.merged_statistics(kept), X.run_statistics(records(t))
    error = 4 * 1.04 / 2 ** (X.LOG_REGISTERS / 2)
    both = exact.join(F.broadcast(merged.select(*[F.col(c).alias(f"about_{c}") for c in merged.columns])))  # one row each
    near = [
        (F.abs(F.col(f"about_{c}") - F.col(c)) <= F.greatest(F.lit(1), error * F.col(c))).alias(f"{c.removeprefix('unique_')}_near")
        for c in X.COUNTED.values()]
    return both.select(F.col("about_total_records").alias("total_records"), *X.COUNTED.values(), *near)


@query(
    "agg16_relation_types",
    """SELECT 'fixes' AS table_name, coalesce(rel_type, 'Total') AS rel_type,
              count(*) AS record_count FROM fixes GROUP BY ROLLUP (rel_type)
       UNION ALL
       SELECT 'cve_project', coalesce(rel_type, 'Total'), count(*) FROM cve_project
       GROUP BY ROLLUP (rel_type)
       UNION ALL
       SELECT 'cpe_project', coalesce(rel_type, 'Total'), count(*) FROM cpe_project
       GROUP BY ROLLUP (rel_type)""",
)
def _(t: Tables) -> DataFrame:
    return P.rel_type_distribution(
        {"fixes": t.fixes, "cve_project": t.cve_project, "cpe_project": t.cpe_project}
    )


FORM_SQL = r"""CASE WHEN complexity IS NULL THEN 'null' WHEN complexity IN ('nan', 'None')
    THEN complexity WHEN regexp_matches(complexity, '^-?[0-9]+\.[0-9]+$') THEN 'decimal'
    WHEN regexp_matches(complexity, '^-?[0-9]+$') THEN 'integer' ELSE 'other' END"""


@query(
    "agg17_number_forms",
    f"""SELECT form, record_count, max_value,
               round(record_count * 100.0 / sum(record_count) OVER (), 2)::DOUBLE AS percent
        FROM (SELECT {FORM_SQL} AS form, count(*) AS record_count,
                     max(CASE WHEN {FORM_SQL} IN ('decimal', 'integer')
                         THEN TRY_CAST(complexity AS DOUBLE) END) AS max_value
              FROM file_change GROUP BY 1)""",
)
def _(t: Tables) -> DataFrame:
    return P.text_number_profile(t.file_change)


@query(
    "agg17_common_values",
    """SELECT complexity AS value, count(*) AS record_count,
              round(count(*) * 100.0 / (SELECT count(*) FROM file_change), 2)::DOUBLE AS percent
       FROM file_change WHERE complexity IS NOT NULL GROUP BY 1
       ORDER BY record_count DESC, value LIMIT 5""",
)
def _(t: Tables) -> DataFrame:
    return P.common_values(t.file_change, top_n=5)


COUNTED_TABLES = (
    "fixes", "cve", "cwe_classification", "cve_cpe_mapper", "method_change", "file_change",
    "cve_project", "commits", "repository", "cpe_project", "cwe",
)


@query(
    "agg18_row_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS record_count FROM {name}"
        for name in COUNTED_TABLES
    ),
)
def _(t: Tables) -> DataFrame:
    return P.row_counts({name: getattr(t, name) for name in COUNTED_TABLES})


@query(
    "agg18_key_check",
    """SELECT count(*) AS record_count, count(DISTINCT file_change_id) AS distinct_keys,
              count(*) = count(DISTINCT file_change_id) AS is_unique FROM file_change""",
)
def _(t: Tables) -> DataFrame:
    return P.key_check(t.file_change, "file_change_id")


@query(
    "srt1_method_order",
    """SELECT file_change_id, start_line, method_change_id,
              CAST(row_number() OVER (PARTITION BY file_change_id
                ORDER BY start_line, method_change_id) AS INTEGER) AS pos
       FROM (SELECT DISTINCT file_change_id, start_line, method_change_id FROM method_rows)""",
)
def _(t: Tables) -> DataFrame:
    found = method_changes(t.file_change, t.fixes, t.method_change)
    found = found.select("file_change_id", "start_line", "method_change_id").distinct()
    w = Window.partitionBy("file_change_id").orderBy("start_line", "method_change_id")
    return found.withColumn("pos", F.row_number().over(w))


@query(
    "srt3_top_repositories",
    """SELECT repo_url, stars_count FROM repository
       ORDER BY stars_count DESC, repo_url LIMIT 10""",
)
def _(t: Tables) -> DataFrame:
    ranked = t.repository.orderBy(F.desc("stars_count"), "repo_url")
    return ranked.select("repo_url", "stars_count").limit(10)


@query(
    "pip1_extract_top_cwes",
    """SELECT cve_id, repo_url, hash, score, file_change_id, filename FROM extract_rows
       WHERE cve_id IN (
         SELECT cve_id FROM class_rows WHERE cwe_id IN (
           SELECT cwe_id FROM cwe_counts ORDER BY fix_count DESC, cwe_id, cwe_name LIMIT 2))""",
)
def _(t: Tables) -> DataFrame:
    found = full_records(t, top_n=2, classification=t.cwe_classification, cwe=t.cwe)
    return found.select(*RECORD_IDS)


@query(
    "pip1_extract_options",
    """SELECT f.cve_id, f.repo_url, f.hash, f.score, fc.file_change_id, fc.filename
       FROM fixes f JOIN commits c ON c.hash = f.hash AND c.repo_url = f.repo_url
       JOIN file_change fc ON fc.hash = f.hash
       WHERE f.score >= 40 AND fc.code_before IS NOT NULL AND fc.code_before <> 'None'
         AND fc.filename NOT ILIKE '%Test%' AND lower(fc.programming_language) IN ('java', 'go')
         AND fc.hash IN (SELECT hash FROM file_change GROUP BY hash HAVING count(*) = 1)""",
)
def _(t: Tables) -> DataFrame:
    found = full_records(
        t,
        min_score=40,
        exclude_merge=False,
        languages=["go", "JAVA"],
        require_diff=False,
        single_file_only=True,
    )
    return found.select(*RECORD_IDS)


@query(
    "pip2_methods",
    """SELECT cve_id, hash, repo_url, file_change_id, method_change_id, method_name, signature,
              start_line, end_line, length(file_code_before) AS n_before,
              length(file_code_after) AS n_after FROM method_rows""",
)
def _(t: Tables) -> DataFrame:
    sizes = {f"n_{side}": F.length(f"file_code_{side}").cast("bigint") for side in ("before", "after")}
    found = method_changes(t.file_change, t.fixes, t.method_change, of_file=sizes)
    return found.select(
        "cve_id", "hash", "repo_url", "file_change_id", "method_change_id", "method_name",
        "signature", "start_line", "end_line", "n_before", "n_after",
    )


@query(
    "tnt1_method_slice",
    """SELECT method_change_id, method_code, method_code_after FROM cut_rows
       WHERE method_code <> ''""",
)
def _(t: Tables) -> DataFrame:
    found = with_method_code(method_changes(t.file_change, t.fixes, t.method_change))
    return (
        found.filter("method_code <> ''")
        .select("method_change_id", "method_code", "method_code_after")
        .distinct()
    )


@query(
    "url1_raw_url",
    r"""SELECT page_id,
          replace(regexp_replace('https://github.com/o/r/blob/' || md5(url) || '/' || page_id,
            'blob/[a-fA-F0-9]+', 'HEAD'), 'github.com', 'raw.githubusercontent.com') AS raw_url,
          replace(regexp_replace(url, 'blob/[a-fA-F0-9]+', 'HEAD', 'g'), 'github.com',
            'raw.githubusercontent.com') AS page_raw_url
        FROM pages""",
)
def _(t: Tables) -> DataFrame:
    blob = F.concat(
        F.lit("https://github.com/o/r/blob/"), F.md5("url"), F.lit("/"), F.col("page_id")
    )
    return t.pages.select(
        "page_id", raw_url(blob).alias("raw_url"), raw_url(F.col("url")).alias("page_raw_url")
    )


@query(
    "url2_safe_name",
    r"""SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_.\-]', '_', 'g') AS safe_name
        FROM pages""",
)
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", safe_name(F.col("url")).alias("safe_name"))
