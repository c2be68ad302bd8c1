"""Selection of fix records, and the weaknesses they belong to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

CODE_COLUMNS = ("code_before", "code_after")


def good_fixes(fixes: DataFrame, min_score: int = 65) -> DataFrame:
    return fixes.filter(F.col("score") >= min_score).select("cve_id", "hash", "repo_url", "score")


def has_diff() -> Column:
    return F.coalesce(F.col("diff"), F.lit("")) != ""


def not_merge() -> Column:
    """A commit whose merge flag is unknown counts as no merge."""
    return ~F.coalesce(F.col("merge"), F.lit(False))


def has_code() -> Column:
    return F.col("code_before").isNotNull() & (F.col("code_before") != "None")


def not_test_file() -> Column:
    """No "test" anywhere in the name; an unknown name is dropped too."""
    return ~F.col("filename").ilike("%Test%")


def in_languages(languages: Sequence[str]) -> Column:
    return F.lower(F.col("programming_language")).isin([name.lower() for name in languages])


def single_file_commits(file_change: DataFrame) -> DataFrame:
    """Hashes of commits that change one file only."""
    counts = file_change.groupBy("hash").agg(F.count(F.lit(1)).alias("files"))
    return counts.filter("files = 1").select("hash")


def classification_of(
    records: DataFrame, classification: DataFrame, cwe: DataFrame
) -> DataFrame:
    """Weaknesses (with names) of the CVEs in ``records``; repeated rows are kept."""
    named = classification.select("cve_id", "cwe_id").join(
        cwe.select("cwe_id", "cwe_name"), "cwe_id"
    )
    cves = records.select("cve_id").distinct()
    return named.join(cves, "cve_id", "left_semi").select("cve_id", "cwe_id", "cwe_name")


def frequent_cwes(classified: DataFrame) -> DataFrame:
    """Number of classification rows per weakness; those with one row or no name are left out."""
    return (
        classified.filter(F.col("cwe_id").isNotNull() & F.col("cwe_name").isNotNull())
        .groupBy("cwe_id", "cwe_name")
        .agg(F.count(F.lit(1)).alias("fix_count"))
        .filter("fix_count > 1")
    )


def top_cwes(classified: DataFrame, top_n: int | None = 3) -> DataFrame:
    """The most frequent weaknesses, most rows first, ties by id and name."""
    ranked = frequent_cwes(classified).orderBy(F.desc("fix_count"), "cwe_id", "cwe_name")
    return ranked if top_n is None else ranked.limit(top_n)


def records_of_cwe(records: DataFrame, cwe_id: str, classified: DataFrame) -> DataFrame:
    """Records whose CVE has the given weakness."""
    cves = classified.filter(F.col("cwe_id") == cwe_id).select("cve_id").distinct()
    return records.join(cves, "cve_id", "left_semi")


def keep_top_cwes(records: DataFrame, classified: DataFrame, top_n: int | None) -> DataFrame:
    """Records of CVEs that have a top weakness; every record when there is no top weakness."""
    if top_n is None or top_n <= 0:
        return records
    top = top_cwes(classified, top_n).select("cwe_id")
    wanted = (
        classified.join(F.broadcast(top), "cwe_id", "left_semi")  # at most top_n rows
        .select("cve_id")
        .distinct()
        .withColumn("wanted", F.lit(True))
    )
    none_found = top.agg(F.count(F.lit(1)).alias("n")).scalar() == 0
    return (
        records.join(wanted, "cve_id", "left")
        .filter(F.col("wanted").isNotNull() | none_found)
        .drop("wanted")
    )


def extract_records(
    fixes: DataFrame,
    commits: DataFrame,
    file_change: DataFrame,
    *,
    min_score: int = 65,
    exclude_merge: bool = True,
    languages: Sequence[str] = ("Java",),
    require_diff: bool = True,
    single_file_only: bool = False,
    top_n: int | None = None,
    classification: DataFrame | None = None,
    cwe: DataFrame | None = None,
) -> DataFrame:
    """Good fixes with their commit and changed files.

    Commits are matched on hash and repository, files on the hash alone, so a hash that occurs
    in several repositories or CVEs gives several records. Filters sit on the scans; the code
    columns are read only if the caller uses them. With ``top_n`` only records of CVEs that have one of the most
    frequent weaknesses are kept (all if there is none); ids that this needs are staged.
    """
    c = commits.select("hash", "repo_url", "author_date", "msg", "merge")
    if exclude_merge:
        c = c.filter(not_merge())
    files = file_change.filter(has_code() & not_test_file() & in_languages(languages))
    if require_diff:
        files = files.filter(has_diff())
    if single_file_only:
        files = files.join(single_file_commits(file_change), "hash", "left_semi")
    files = files.select(
        "hash",
        "file_change_id",
        "filename",
        "programming_language",
        "code_before",
        "code_after",
        "diff",
    )

    def built(of: DataFrame) -> DataFrame:
        return (
            good_fixes(of, min_score)
            .join(c.drop("merge"), ["hash", "repo_url"])
            .join(files, "hash")
            .select(
                "cve_id",
                "repo_url",
                "hash",
                "score",
                "author_date",
                "msg",
                "file_change_id",
                "filename",
                "programming_language",
                "code_before",
                "code_after",
                "diff",
            )
        )

    if top_n is None or top_n <= 0:
        return built(fixes)
    if classification is None or cwe is None:
        raise ValueError("top_n needs the classification and cwe tables")
    # The CVEs of the records are found once; the wanted ones then cut the fixes down before any
    # file is read again.
    cves = stage(built(fixes).select("cve_id").distinct(), "record_cves")
    classified = classification_of(cves, classification, cwe)
    top = stage(top_cwes(classified, top_n).select("cwe_id"), "top_cwes")
    if top.isEmpty():
        return built(fixes)
    wanted = classified.join(F.broadcast(top), "cwe_id", "left_semi").select("cve_id").distinct()  # at most top_n rows
    return built(fixes.join(stage(wanted, "wanted_cves"), "cve_id", "left_semi"))


def run_statistics(records: DataFrame, instances: DataFrame | None = None) -> DataFrame:
    """One row of counters over the records and, if given, the pattern instances."""
    stats = records.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("cve_id").alias("unique_cves"),
        F.countDistinct("hash").alias("unique_commits"),
        F.countDistinct("repo_url").alias("unique_repositories"),
        F.countDistinct("filename").alias("unique_files"),
    )
    if instances is None:
        return stats
    copies = F.col("copies") if "copies" in instances.columns else F.lit(1)
    keys = instances.groupBy("pattern_key").agg(F.sum(copies).alias("n"))
    counts = keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pattern_instances"),
        F.count(F.lit(1)).alias("unique_pattern_keys"),
    )
    instances_, keys_ = (
        counts.select("pattern_instances").scalar(),
        counts.select("unique_pattern_keys").scalar(),
    )
    return stats.select(
        "*",
        instances_.alias("pattern_instances"),
        keys_.alias("unique_pattern_keys"),
        keys_.alias("queries"),
    )


#: Columns whose distinct values a run counts, and the counter's name.
COUNTED = {"cve_id": "unique_cves", "hash": "unique_commits", "repo_url": "unique_repositories", "filename": "unique_files"}
#: Logarithm of a sketch's registers. The relative standard error of an estimate is 1.04 / sqrt(2^LOG_REGISTERS), 1.6 %.
LOG_REGISTERS = 12


def statistics_sketches(records: DataFrame, *by: str) -> DataFrame:
    """Counters that can be merged: rows, and a HyperLogLog sketch per counted column (a few KB), for all records or for each ``by``.

    A run keeps this row; the counters of any number of runs follow from their rows without the records.
    """
    sketches = [F.hll_sketch_agg(c, F.lit(LOG_REGISTERS)).alias(c) for c in COUNTED]
    return records.groupBy(*by).agg(F.count(F.lit(1)).alias("total_records"), *sketches)


def merged_statistics(sketches: DataFrame, *by: str) -> DataFrame:
    """The counters of ``run_statistics`` from kept sketches: rows exactly, distinct values within the stated error."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(name) for c, name in COUNTED.items()]
    return sketches.groupBy(*by).agg(F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"), *merged)


def last_diff(records: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One diff per file change: that of the last record in the given order."""
    w = Window.partitionBy("file_change_id").orderBy(*[F.desc(c) for c in order_by])
    ranked = records.select("file_change_id", "diff", F.row_number().over(w).alias("rn"))
    return ranked.filter("rn = 1").select("file_change_id", "diff")


def with_diff(instances: DataFrame, records: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Add ``code_diff``: the file change's diff, '' where there is none."""
    diffs = last_diff(records, order_by)
    joined = instances.join(diffs, "file_change_id", "left")
    return joined.withColumn("code_diff", F.coalesce("diff", F.lit(""))).drop("diff")
