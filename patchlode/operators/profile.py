"""Documented analyses of the fix tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .extract import good_fixes


def cwes_of_cve(classification: DataFrame, cwe: DataFrame, cve_id: str) -> DataFrame:
    return (
        classification.filter(F.col("cve_id") == cve_id)
        .join(cwe, "cwe_id")
        .select("cve_id", "cwe_id", "cwe_name", F.col("description").alias("cwe_description"))
    )


def direct_commits(table: DataFrame) -> DataFrame:
    """Rows whose relation names the fixing commit itself."""
    return table.filter(F.col("rel_type").like("%DIRECT_COMMIT"))


def records_with_methods(
    fixes: DataFrame,
    commits: DataFrame,
    file_change: DataFrame,
    method_change: DataFrame,
    *,
    languages: Sequence[str] = ("Java", "Go"),
    min_score: int = 65,
) -> DataFrame:
    """Fixes with commit (matched on hash only), files, and methods where there are any."""
    files = file_change.filter(
        F.col("programming_language").isin(list(languages)) & F.col("code_before").isNotNull()
    )
    methods = method_change.select(
        "file_change_id", "signature", F.col("code").alias("method_code")
    )
    return (
        good_fixes(fixes, min_score)
        .join(commits.select("hash"), "hash")
        .join(files, "hash")
        .join(methods, "file_change_id", "left")
        .select(
            "cve_id",
            F.col("hash").alias("commit_hash"),
            "repo_url",
            "file_change_id",
            "filename",
            "programming_language",
            F.col("code_before").alias("vulnerable_code"),
            F.col("code_after").alias("fixed_code"),
            "signature",
            "method_code",
        )
    )


def repositories_by_product(
    cve: DataFrame, mapper: DataFrame, cpe_project: DataFrame, repository: DataFrame
) -> DataFrame:
    """CVE to repository by way of the affected product."""
    return (
        cve.select("cve_id", "severity")
        .join(mapper.select("cve_id", "cpe_name"), "cve_id")
        .join(cpe_project.select("cpe_name", "repo_url", "rel_type"), "cpe_name")
        .join(repository.select("repo_url", "owner", "stars_count"), "repo_url")
        .select("cve_id", "severity", "cpe_name", "repo_url", "rel_type", "owner", "stars_count")
    )


def repositories_by_project(
    cve: DataFrame, cve_project: DataFrame, repository: DataFrame
) -> DataFrame:
    """CVE to repository by way of the project table."""
    links = cve_project.select(
        F.col("cve").alias("cve_id"), F.col("project_url").alias("repo_url"), "rel_type"
    )
    return (
        cve.select("cve_id", "severity")
        .join(links, "cve_id")
        .join(repository.select("repo_url", "owner", "stars_count"), "repo_url")
    )


def rel_type_distribution(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per relation type and table, with a total row per table."""
    result = None
    for name, table in tables.items():
        part = (
            table.select(F.coalesce("rel_type", F.lit("(none)")).alias("rel_type"))
            .rollup("rel_type")
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select(
                F.lit(name).alias("table_name"),
                F.coalesce("rel_type", F.lit("Total")).alias("rel_type"),
                "record_count",
            )
        )
        result = part if result is None else result.unionByName(part)
    return result


def number_form(column: str):
    """How a number stored as text is written."""
    text = F.col(column)
    return (
        F.when(text.isNull(), "null")
        .when(text == "nan", "nan")
        .when(text == "None", "None")
        .when(text.rlike(r"^-?[0-9]+\.[0-9]+$"), "decimal")
        .when(text.rlike(r"^-?[0-9]+$"), "integer")
        .otherwise("other")
    )


def _with_share(counts: DataFrame) -> DataFrame:
    everything = Window.partitionBy()  # over the few rows that are left after counting
    share = F.round(F.col("record_count") * 100.0 / F.sum("record_count").over(everything), 2)
    return counts.withColumn("percent", share)


def text_number_profile(table: DataFrame, column: str = "complexity") -> DataFrame:
    """Count, share and largest value per way of writing."""
    return _with_share(
        table.groupBy(number_form(column).alias("form")).agg(
            F.count(F.lit(1)).alias("record_count"),
            F.max(
                F.when(number_form(column).isin("decimal", "integer"), F.col(column)).try_cast(
                    "double"
                )
            ).alias("max_value"),
        )
    )


def common_values(table: DataFrame, column: str = "complexity", top_n: int = 10) -> DataFrame:
    """Most common values with their share of all rows."""
    total = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = table.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("record_count"))
    top = counts.filter("value IS NOT NULL").orderBy(F.desc("record_count"), "value").limit(top_n)
    return top.withColumn("percent", F.round(F.col("record_count") * 100.0 / total, 2))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    result = None
    for name, table in tables.items():
        part = table.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        result = part if result is None else result.unionByName(part)
    return result


def key_check(table: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, and whether the key is unique."""
    counts = table.agg(
        F.count(F.lit(1)).alias("record_count"), F.countDistinct(key).alias("distinct_keys")
    )
    return counts.withColumn("is_unique", F.col("record_count") == F.col("distinct_keys"))
