"""From pattern instances to search queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import query_text, search_terms
from ..functions.text import by_name, leading_number
from ..session import stage
from .lookup import may_hold
from .mining import ROW_ORDER

EXCLUDED_COLUMNS = (
    "representative_method_code",
    "representative_method_code_after",
    "all_repo_urls",
    "all_commit_hashes",
    "all_commit_links",
)


def _lead() -> Column:
    return F.coalesce(leading_number(F.col(ROW_ORDER[0])), F.lit(-1))


def _least_rows(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The few rows per pattern key that may be the first with a value of some column: those with the least leading number."""
    lead = _lead()
    least = [F.min(F.when(F.col(c).isNotNull(), lead)).alias(f"_least_{c}") for c in columns]
    bounds = rows.groupBy(F.col("pattern_key").alias("_key")).agg(F.min(lead).alias("_least"), *least)
    wanted = lead == F.col("_least")
    for c in columns:
        wanted = wanted | (lead == F.col(f"_least_{c}"))
    same_key = F.col("pattern_key").eqNullSafe(F.col("_key"))
    return rows.join(stage(bounds, "first_rows"), same_key).filter(wanted)


def _first_values(rows: DataFrame, columns: tuple[str, ...], order: Sequence[str]) -> DataFrame:
    place = F.struct(*order)

    def first(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), place)).alias(name)

    return rows.groupBy("pattern_key").agg(*[first(c) for c in columns])


def representatives(
    instances: DataFrame,
    columns: tuple[str, ...] = ("cwe_id", "cwe_name", "pattern"),
) -> DataFrame:
    """Per pattern key and column the first value that is not NULL, in row order.

    Written as aggregates, so each partition sends one row per key, however often it occurs. The least leading number of a
    key's rows is found first, which needs no sort; the few rows that have it are compared in full. Instances are read twice.
    """
    return _first_values(_least_rows(instances, columns), columns, ROW_ORDER)


def first_of_methods(
    found: DataFrame,
    patterns: DataFrame,
    records: DataFrame,
    fixes: DataFrame,
    columns: tuple[str, ...] = ("cwe_id", "cwe_name", "_pattern"),
) -> DataFrame:
    """``representatives`` of the instances of ``placed_patterns``, before any instance is made.

    Instances of a method differ by the CVE only, which no column is taken from, so all that counts of the fixes is whether the commit has one.
    The first methods are chosen without asking, then looked up in the records, each of which has a fix, and if need be in the
    fixes. Only if one has none there, all methods meet the fixes.
    """
    order = [c for c in ROW_ORDER if c != "cve_id"]
    rows = found.filter("hash IS NOT NULL").join(patterns.select("_pattern", "pattern_key"), "_pattern").select("pattern_key", *order, *columns)
    few = stage(_least_rows(rows, columns).select(rows.columns), "first_methods")
    number = few.count()
    asked = [F.min(F.when(F.col(c).isNotNull(), _lead())).alias(f"_asked_{c}") for c in columns]
    held = [F.min(F.when(F.col(c).isNotNull() & F.col("_fixed"), _lead())).alias(f"_held_{c}") for c in columns]
    unlike = [~F.col(f"_asked_{c}").eqNullSafe(F.col(f"_held_{c}")) for c in columns]
    for known in (records, fixes):
        fixed = may_hold(known.select("hash"), few, ["hash"], number).distinct().withColumn("_fixed", F.lit(True))
        told = stage(few.join(fixed, "hash", "left"), "first_fixed")
        # The records alone do not tell of a commit without fix, so there every one of the first methods must be found.
        doubt = told.filter("_fixed IS NULL") if known is records else told.groupBy("pattern_key").agg(*asked, *held).filter(reduce(or_, unlike))
        if doubt.isEmpty():
            return _first_values(told.filter("_fixed"), columns, order)
    rows = rows.join(fixes.select("hash").distinct(), "hash", "left_semi")
    return _first_values(_least_rows(rows, columns), columns, order)


def with_commit_count(patterns: DataFrame, instances: DataFrame) -> DataFrame:
    """Add the number of distinct commits per pattern key."""
    counts = instances.groupBy("pattern_key").agg(F.countDistinct("hash").alias("commit_count"))
    return patterns.join(counts, "pattern_key")


def top_pattern_per_cwe(patterns: DataFrame) -> DataFrame:
    """Per weakness the pattern seen in most commits, ties by key."""
    w = Window.partitionBy("cwe_id").orderBy(F.desc("commit_count"), "pattern_key")
    ranked = patterns.withColumn("rn", F.row_number().over(w))
    return ranked.filter("rn = 1").drop("rn")


def cwe_distribution(patterns: DataFrame) -> DataFrame:
    return patterns.groupBy("cwe_id").agg(F.count(F.lit(1)).alias("pattern_count"))


def compile_queries(
    patterns: DataFrame, top_n: int | None = None, keep_terms: bool = False
) -> DataFrame:
    """Add ``github_query`` and drop the pattern struct.

    A positive ``top_n`` only switches on the choice of one pattern per weakness, and only if
    there is a commit count to choose by. ``keep_terms`` keeps the keyword arrays for searching.
    """
    if top_n is not None and top_n > 0 and "commit_count" in patterns.columns:
        patterns = top_pattern_per_cwe(patterns)
    usable = F.coalesce("cwe_id", F.lit("")) != ""
    compiled = patterns.withColumn(
        "_terms", by_name(search_terms)("pattern", "cwe_id")
    ).withColumn("github_query", F.when(usable, query_text(F.col("_terms"))).otherwise(""))
    if keep_terms:
        compiled = compiled.select("*", "_terms.*")
    return compiled.drop("_terms", "pattern")


def attach_queries(instances: DataFrame, queries: DataFrame) -> DataFrame:
    """Give every instance the query of its pattern key."""
    return instances.join(queries.select("pattern_key", "github_query"), "pattern_key", "left")


def query_list(patterns: DataFrame) -> DataFrame:
    """Distinct queries with their weakness, by weakness."""
    return patterns.select("cwe_id", "cwe_name", "github_query").distinct().orderBy("cwe_id")


def output_columns(patterns: DataFrame) -> DataFrame:
    return patterns.drop(*EXCLUDED_COLUMNS)
