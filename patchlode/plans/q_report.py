"""Queries: rankings of the compiled search texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.report import query_report, with_query_text
from ..session import stage_path
from ..sources import sinks as S
from ..sources.tables import read_csv
from .fixtures import Tables
from .inputs import queried
from .registry import query

REPORT_SQL = """category, rank, github_query, instance_count, unique_pattern_keys, cwe_ids,
    sample_pattern_keys"""
REPORT_SCHEMA = (
    "category string, rank int, github_query string, instance_count bigint, "
    "unique_pattern_keys bigint, cwe_ids string, sample_pattern_keys string"
)


@query(
    "flt11_query_text_present",
    "SELECT pattern_key, github_query FROM queried_rows WHERE trim(github_query) <> ''",
)
def _(t: Tables) -> DataFrame:
    return with_query_text(queried(t)).select("pattern_key", "github_query")


@query(
    "agg7_queries_overall", f"SELECT {REPORT_SQL} FROM report_rows WHERE category = 'Overall'"
)
def _(t: Tables) -> DataFrame:
    return query_report(queried(t), kinds=("overall",))


@query("agg8_queries_by_cwe", f"SELECT {REPORT_SQL} FROM report_rows WHERE category LIKE 'CWE-%'")
def _(t: Tables) -> DataFrame:
    return query_report(queried(t), kinds=("cwe",))


@query(
    "agg9_queries_by_sinks", f"SELECT {REPORT_SQL} FROM report_rows WHERE category LIKE 'Sink-%'"
)
def _(t: Tables) -> DataFrame:
    return query_report(queried(t), kinds=("sinks",))


@query(
    "agg10_queries_by_sources",
    f"SELECT {REPORT_SQL} FROM report_rows WHERE category LIKE 'Source-%'",
)
def _(t: Tables) -> DataFrame:
    return query_report(queried(t), kinds=("sources",))


@query(
    "agg11_query_details",
    """SELECT github_query, unique_pattern_keys, cwe_ids, sample_pattern_keys
       FROM report_rows WHERE category = 'Overall'""",
)
def _(t: Tables) -> DataFrame:
    report = query_report(queried(t), kinds=("overall",))
    return report.select("github_query", "unique_pattern_keys", "cwe_ids", "sample_pattern_keys")


@query("agg12_query_report", f"SELECT {REPORT_SQL} FROM report_rows")
def _(t: Tables) -> DataFrame:
    return query_report(queried(t))


@query(
    "win1_rank_in_category",
    "SELECT category, rank, github_query FROM report_rows WHERE rank <= 3",
)
def _(t: Tables) -> DataFrame:
    return query_report(queried(t)).filter("rank <= 3").select("category", "rank", "github_query")


@query(
    "srt2_queries_by_count",
    """SELECT github_query, CAST(sum(copies) AS BIGINT) AS instance_count FROM queried_rows
       GROUP BY github_query""",
)
def _(t: Tables) -> DataFrame:
    counts = queried(t).groupBy("github_query").agg(F.sum("copies").alias("instance_count"))
    return counts.orderBy(F.desc("instance_count"), "github_query")


@query("snk6_statistics_file", f"SELECT {REPORT_SQL} FROM report_rows")
def _(t: Tables) -> DataFrame:
    folder = stage_path(t.spark, "statistics_csv")
    S.write_statistics(query_report(queried(t)), folder)
    return read_csv(t.spark, f"{folder}/top_github_queries_statistics.csv", REPORT_SCHEMA)
