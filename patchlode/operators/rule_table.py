"""Rules as data: a table of own sources, sinks and measures instead of lists in the code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.measures import MEASURE_RULE_TYPE, measure_catalogue
from ..functions.taint import SINK_RULE_TYPE, SOURCE_RULE_TYPE, sink_catalogue, source_catalogue
from ..functions.text import FLAGS

#: Rows of a rule table; it is broadcast as one row of three arrays.
MOST_RULES = 10_000
KINDS = ("source", "annotation", "sink", "measure")
SOURCES, SINKS, MEASURES = "_source_rules", "_sink_rules", "_measure_rules"


def rule_catalogue(rules: DataFrame, defaults: bool = True, annotation_mode: str = "compat") -> DataFrame:
    """One row with three arrays of rules, the usual ones first if ``defaults``.

    ``rules`` has name, kind (source, annotation, sink or measure), regex and category. Letter case is ignored. The first group of a
    source's expression is its variable; an annotation's expression ends before its value. ``category`` is the source category or the kind of
    vulnerability; a source category that no weakness names applies where all do. An optional ``anchor`` is text without which the expression
    cannot match; texts without it are not searched. Rules of a kind stand in the order of name, then expression; rows that repeat a rule count once.
    Rows without name or expression, of other kinds, or more rows than ``MOST_RULES`` are an error.
    """
    if "anchor" not in rules.columns:
        rules = rules.withColumn("anchor", F.lit(None).cast("string"))
    rules = rules.select("name", "kind", "regex", "category", "anchor").distinct()
    usable = F.col("name").isNotNull() & F.col("regex").isNotNull() & F.col("kind").isin(*KINDS)
    n, good = rules.agg(F.count("*"), F.count_if(usable)).first()
    if n > MOST_RULES:
        raise ValueError(f"{n} rules; a rule table holds at most {MOST_RULES}")
    if good < n:
        raise ValueError(f"{n - good} rules lack a name or an expression, or are not of kind {', '.join(KINDS)}")
    regex, anchor = F.concat(F.lit(FLAGS), "regex"), F.lower(F.coalesce("anchor", F.lit("")))
    rule_id, category = F.concat(F.lit("own:"), "name"), F.coalesce("category", F.lit(""))
    annotation = F.col("kind") == "annotation"
    # what follows an annotation, as far as the next one is looked for
    reach = annotation & F.lit(annotation_mode == "compat")
    source_regex = F.when(reach, F.concat(regex, F.lit(rf"(?=((?s:.{{0,{R.ANNOTATION_REACH}}})))"))).otherwise(regex)
    source = F.struct(
        source_regex.alias("regex"), rule_id.alias("rule_id"), category.alias("category"), F.col("name").alias("type"),
        anchor.alias("anchor"), reach.alias("reach"))
    sink = F.struct(regex.alias("regex"), rule_id.alias("rule_id"), category.alias("vuln_type"), F.col("name").alias("name"), anchor.alias("anchor"))
    measure = F.struct(regex.alias("regex"), F.col("name").alias("name"), anchor.alias("anchor"))

    def listed(rule: Column, ddl: str, usual: Column, *kinds: str) -> Column:
        own = F.collect_list(F.when(F.col("kind").isin(*kinds), F.struct("name", "regex", rule.alias("rule"))))
        ordered = F.transform(F.array_sort(own), lambda r: r["rule"]).cast(ddl)
        return F.concat(usual, ordered) if defaults else ordered

    return rules.agg(
        listed(source, SOURCE_RULE_TYPE, source_catalogue(annotation_mode=annotation_mode), "source", "annotation").alias(SOURCES),
        listed(sink, SINK_RULE_TYPE, sink_catalogue(), "sink").alias(SINKS),
        listed(measure, MEASURE_RULE_TYPE, measure_catalogue(), "measure").alias(MEASURES),
    )
