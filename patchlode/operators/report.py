"""Ranking of queries overall, by weakness, by sinks and by sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank
from ..session import stage

LABEL_LENGTH = 50
SAMPLE_KEYS = 3
KINDS = ("overall", "cwe", "sinks", "sources")
#: Of each kind of category: the column it is named by, and what stands before its name.
CATEGORIES = {"overall": (None, "Overall"), "cwe": ("cwe_id", "CWE-"), "sinks": ("sink_types", "Sink-"), "sources": ("source_types", "Source-")}
#: Kinds of which only the most frequent categories are reported, by a shortened name.
LIMITED = ("sinks", "sources")


def with_query_text(instances: DataFrame) -> DataFrame:
    return instances.filter(~blank(F.col("github_query")))


def _counts(instances: DataFrame) -> DataFrame:
    """One row per combination that the report can tell apart."""
    copies = F.col("copies") if "copies" in instances.columns else F.lit(1)
    return (
        with_query_text(instances)
        .groupBy("github_query", "cwe_id", "sink_types", "source_types", "pattern_key")
        .agg(F.sum(copies).cast("bigint").alias("n"))
    )


def _grouped(counts: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts and weaknesses per kind, category, query and pattern key: one pass over the combinations, by grouping sets."""
    own = {kind: CATEGORIES[kind][0] for kind in KINDS if kind in kinds}
    # the weakness is a grouping column and also counted, so it is grouped by a copy
    rows = counts.withColumn("_cwe", F.col("cwe_id"))
    sets = [["github_query", "pattern_key", *([column] if column else [])] for column in own.values()]
    columns = ["github_query", "pattern_key", *filter(None, own.values())]
    grouped = rows.groupingSets(sets, *columns).agg(
        F.grouping_id().alias("gid"), F.sum("n").alias("n"), F.collect_set("_cwe").alias("cwes"))
    # a bit of the grouping id is set for each column that a set leaves out
    named = columns[2:]
    ids = {kind: sum(1 << (len(named) - 1 - i) for i, column in enumerate(named) if column != own[kind]) for kind in own}
    kind = F.coalesce(*[F.when(F.col("gid") == gid, F.lit(name)) for name, gid in ids.items()])
    name = F.coalesce(*[F.when(F.col("gid") == ids[k], F.col(c) if c else F.lit("")) for k, c in own.items()])
    return grouped.select(kind.alias("kind"), name.alias("name"), "github_query", "pattern_key", "n", "cwes").filter("name is not null")


def _categories(grouped: DataFrame, top_n: int) -> DataFrame:
    """Of the limited kinds the ``top_n`` most frequent categories, of the others all; with their names in the report."""
    limited = F.col("kind").isin(*LIMITED)
    totals = grouped.filter(limited & (F.col("name") != "")).groupBy("kind", "name").agg(F.sum("n").alias("total"))
    best = Window.partitionBy("kind").orderBy(F.desc("total"), "name")
    few = totals.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top_n).select("kind", "name")
    # at most top_n rows of each limited kind
    kept = grouped.filter(~limited).unionByName(grouped.join(F.broadcast(few), ["kind", "name"], "left_semi"))
    prefix = F.coalesce(*[F.when(F.col("kind") == k, F.lit(p)) for k, (_, p) in CATEGORIES.items()])
    label = F.when(limited, F.substring("name", 1, LABEL_LENGTH)).otherwise(F.col("name"))
    return kept.withColumns({"category_key": F.concat(prefix, F.col("name")), "category": F.concat(prefix, label)})


def _ranked(per_key: DataFrame, top_n: int) -> DataFrame:
    """Details per (category, query), and the ``top_n`` queries of each category."""
    order = Window.partitionBy("category_key", "github_query").orderBy("pattern_key")
    numbered = per_key.withColumn("pos", F.row_number().over(order))
    sample = F.when(F.col("pos") <= SAMPLE_KEYS, F.struct("pos", "pattern_key"))
    # cwes: bounded by the weakness catalogue; sample: at most three entries.
    detail = numbered.groupBy("category_key", "category", "github_query").agg(
        F.sum("n").alias("instance_count"),
        F.count("pattern_key").alias("unique_pattern_keys"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("cwes")))).alias("cwes"),
        F.array_sort(F.collect_list(sample)).alias("sample"),
    )
    best = Window.partitionBy("category_key").orderBy(F.desc("instance_count"), "github_query")
    return (
        detail.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top_n)
        .select(
            "category",
            "rank",
            "github_query",
            "instance_count",
            "unique_pattern_keys",
            F.array_join("cwes", ", ").alias("cwe_ids"),
            F.array_join(F.transform("sample", lambda s: s["pattern_key"]), ", ").alias(
                "sample_pattern_keys"
            ),
        )
    )


def query_report(
    instances: DataFrame, top_n: int = 10, kinds: tuple[str, ...] = KINDS
) -> DataFrame:
    """The most frequent queries, overall, by weakness, by sinks and by sources, in one table.

    The instances are reduced to combination counts and grouped by all four at once, with grouping sets, in one pass. The
    groups are staged, since frequent categories are chosen from them and one window ranks the queries of all.
    """
    return _ranked(_categories(stage(_grouped(_counts(instances), kinds), "query_groups"), top_n), top_n)
