"""Pattern instances: which changed methods show which weakness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.measures import added_measures
from ..functions.patterns import keeps, key_part, make_pattern, pattern_key, sorted_names
from ..functions.taint import analyze_taint, source_class
from ..functions.text import by_name, commit_link, first_filled, line_slices
from ..session import stage
from .extract import classification_of, frequent_cwes, in_languages
from .lookup import late_lookup, may_hold
from .methods import files_with_code, method_lines
from .rule_table import MEASURES, SINKS, SOURCES, rule_catalogue

ROW_ORDER = ("hash", "file_change_id", "method_change_id", "cve_id")
EXPANSION_STEP = 1024
#: What belongs to the pattern of an instance and is wide: met by number where it is read.
PATTERN_COLUMNS = ("pattern", "method_code", "method_code_after")

INSTANCE_COLUMNS = (
    "pattern_key",
    "cwe_id",
    "cwe_name",
    "sink_types",
    "source_types",
    "missing_sanitizers",
    "cve_id",
    "hash",
    "repo_url",
    "commit_link",
    "method_name",
    "signature",
    "code_diff",
    "github_query",
)


def weakness_targets(
    records: DataFrame, classification: DataFrame, cwe: DataFrame, by_repository: bool = False
) -> DataFrame:
    """Per file change and weakness: how many records ask for it (``copies``).

    Uses ids only. Records are counted before the join, so a CVE or file that holds a large
    part of all records is one row per partition by then. ``by_repository`` keeps the records'
    repositories apart.
    """
    repo = ["repo_url"] if by_repository else []
    frequent = frequent_cwes(classification_of(records, classification, cwe))
    pairs = (
        classification.select("cve_id", "cwe_id")
        .distinct()
        .join(frequent.select("cwe_id", "cwe_name"), "cwe_id")
    )
    counted = (
        records.filter(F.coalesce("file_change_id", F.lit("")) != "")
        .groupBy("cve_id", "file_change_id", *repo)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return (
        counted.join(pairs, "cve_id")
        .groupBy("file_change_id", "cwe_id", "cwe_name", *repo)
        .agg(F.sum("copies").alias("copies"))
    )


def text_analyses(cut: DataFrame, rules: DataFrame | None = None, **options) -> DataFrame:
    """method_code, cls, analysis: the taint of each distinct method text under each set of source categories asked of it, staged.

    The analysis depends on a weakness only through its source categories (there are four sets), so a text is analysed once per set,
    however many weaknesses, files and copies ask for it. Texts without source and sink are evidence for nothing and are left out.
    """
    classes = F.array_distinct(F.transform("weaknesses", lambda w: source_class(w["cwe_id"])))
    asked = cut.select("method_code", F.explode(classes).alias("cls")).distinct()
    if rules is not None:
        asked = asked.join(F.broadcast(rules))
    # The generator computes the analysis exactly once.
    made = asked.select("method_code", "cls", F.explode(F.array(by_name(analyze_taint)("method_code", "cls", **options))).alias("analysis"))
    return stage(made.filter("size(analysis.sources) > 0 AND size(analysis.sinks) > 0"), "analyses")


def _texts_digest() -> Column:
    """Names both versions of a file's code; an unknown version differs from an empty one."""
    return F.unhex(F.sha2(F.concat(F.sha2("code_before", 256), F.coalesce(F.sha2("code_after", 256), F.lit(""))), 256))


def placed_patterns(
    targets: DataFrame,
    file_change: DataFrame,
    method_change: DataFrame,
    *,
    languages: Sequence[str] = ("Java",),
    measures: Mapping[str, Sequence[str]] = R.SECURITY_MEASURES,
    rules: DataFrame | None = None,
    usual_rules: bool = True,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Methods with a weakness and the number of a kept pattern (``_pattern``), and the patterns by number; the latter staged.

    Files share texts, so code is read for distinct texts only: measures are compared once per pair of file versions, a method is cut once
    per pair and lines, and a pattern is made once per cut method and weakness. Methods of files are ids, lines and the digest of the
    texts until then. See ``method_patterns`` for the parameters.
    """
    weakness = F.struct("cwe_id", "cwe_name", "copies")
    wanted = stage(targets.groupBy("file_change_id").agg(F.collect_list(weakness).alias("weaknesses")), "wanted_files")
    rows, by_file = wanted.count(), ["file_change_id"]
    # Only Java code can show a pattern. Most files and methods that no weakness asks for leave before texts are digested and rows are shuffled.
    code = files_with_code(file_change, [name for name in languages if name.lower() == "java"])
    placed = may_hold(code, wanted, by_file, rows).select("file_change_id", "hash", "diff", _texts_digest().alias("_text"))
    methods = may_hold(method_lines(method_change), wanted, by_file, rows)
    # Both the distinct texts and their places are read from it.
    placed = stage(placed.join(wanted, "file_change_id").join(methods, "file_change_id"), "placed_methods")

    lines = ("_text", "start_line", "end_line")
    asked = placed.select(*lines, F.explode("weaknesses.cwe_id").alias("cwe_id")).distinct()
    asked = asked.groupBy(*lines).agg(F.collect_list(F.struct("cwe_id")).alias("weaknesses"))
    ranges = asked.groupBy("_text").agg(F.collect_list(F.struct(*lines[1:], "weaknesses")).alias("_ranges"))
    # A text is read from one of its files; ids may repeat, so the file is told by its texts as well.
    one = stage(placed.groupBy("_text").agg(F.min("file_change_id").alias("file_change_id")), "text_files")
    texts = late_lookup(one, code, by_file, ("code_before", "code_after")).filter(_texts_digest() == F.col("_text"))
    texts = texts.drop("file_change_id").dropDuplicates(["_text"]).join(ranges, "_text")
    if rules is not None:
        catalogue = stage(rule_catalogue(rules, usual_rules, options.get("annotation_mode", "compat")), "rules")
        # one row; the rules do not travel with the files
        texts = texts.join(F.broadcast(catalogue.select(MEASURES)))
        measures = MEASURES
        options = {**options, "source_rules": SOURCES, "sink_rules": SINKS}
    texts = texts.withColumn("missing", by_name(added_measures)("code_before", "code_after", measures=measures))
    before, after = (line_slices(F.col(c), F.col("_ranges")) for c in ("code_before", "code_after"))
    zipped = F.arrays_zip(F.col("_ranges").alias("r"), before.alias("method_code"), after.alias("method_code_after"))
    cut = texts.select("_text", "missing", F.inline(zipped)).select("_text", "missing", "r.*", "method_code", "method_code_after")
    cut = stage(cut, "cut_methods")

    analyses = text_analyses(cut, None if rules is None else catalogue.select(SOURCES, SINKS), **options)
    each = cut.select("*", F.explode("weaknesses.cwe_id").alias("cwe_id")).withColumn("cls", source_class(F.col("cwe_id")))
    pattern = by_name(make_pattern)("analysis", "missing")
    kept = each.join(analyses, ["method_code", "cls"]).withColumn("pattern", pattern).filter(keeps(F.col("cwe_id"), F.col("pattern.summary")))
    number = F.monotonically_increasing_id().alias("_pattern")
    columns = (*lines, "cwe_id", "method_code", "method_code_after", "pattern")
    patterns = stage(kept.select(number, *columns, pattern_key(F.col("pattern"), F.col("cwe_id")).alias("pattern_key")), "text_patterns")

    found = placed.select("*", F.explode("weaknesses").alias("w")).select(
        "file_change_id", "hash", "method_change_id", "method_name", "signature", "diff", *lines, "w.*"
    )
    found = found.join(patterns.select("_pattern", *lines, "cwe_id"), [*lines, "cwe_id"]).drop(*lines)
    return found, patterns.drop(*lines, "cwe_id")


def method_patterns(targets: DataFrame, file_change: DataFrame, method_change: DataFrame, **options) -> DataFrame:
    """Kept patterns per method and weakness, before fixes are attached.

    ``rules`` is a table of own rules, see ``rule_table``, beside the usual ones or, without ``usual_rules``, instead of them. It is one
    row of arrays that every task has, and no part of the plan's expressions. ``languages`` and ``measures`` replace the usual ones,
    further options go to ``analyze_taint``.

    The list of weaknesses of a file is bounded by the weakness catalogue (about 1,400 entries).
    """
    found, patterns = placed_patterns(targets, file_change, method_change, **options)
    return found.join(patterns, "_pattern").select(
        "file_change_id",
        "hash",
        "method_change_id",
        "method_name",
        "signature",
        "diff",
        "method_code",
        "method_code_after",
        "cwe_id",
        "cwe_name",
        "copies",
        "pattern",
    )


def no_repo() -> Column:
    return F.coalesce("repo_url", F.lit("")) == ""


def fill_repositories(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """A fix without repository takes the one of each record that asked for the method."""
    by_repo = targets.select(
        F.col("file_change_id").alias("t_file"),
        F.col("cwe_id").alias("t_cwe"),
        F.col("cwe_name").alias("t_name"),
        F.col("repo_url").alias("t_repo"),
        F.col("copies").alias("t_copies"),
    )
    # Rows that have a repository find no partner; a key of their own keeps them spread out.
    has_one = F.concat(F.lit("has a repository: "), F.col("method_change_id"))
    joined = rows.join(
        by_repo,
        (F.when(no_repo(), F.col("file_change_id")).otherwise(has_one) == F.col("t_file"))
        & (F.col("cwe_id") == F.col("t_cwe"))
        & (F.col("cwe_name") == F.col("t_name")),
        "left",
    )
    return joined.withColumns(
        {
            "repo_url": first_filled(F.col("repo_url"), F.col("t_repo")),
            "copies": F.coalesce("t_copies", "copies"),
        }
    ).drop("t_file", "t_cwe", "t_name", "t_repo", "t_copies")


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times, in two steps so that no array outgrows memory."""
    step = EXPANSION_STEP
    blocks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"({copies} - 1) div {step}"))
    split = df.select("*", F.explode(blocks).alias("_block"))
    size = F.least(F.lit(step).cast("bigint"), F.col(copies) - F.col("_block") * step)
    rows = split.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_copy"))
    return rows.drop(copies, "_block", "_copy")


def mined_rows(
    records: DataFrame,
    fixes: DataFrame,
    file_change: DataFrame,
    method_change: DataFrame,
    classification: DataFrame,
    cwe: DataFrame,
    *,
    languages: Sequence[str] = ("Java",),
    fill_repo: bool | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Pattern instances with ``copies`` and the number of their pattern (``_pattern``) in place of it and of the code; and both by number, staged.

    See ``mine_patterns`` for the parameters, ``with_patterns`` for what is left out.
    """
    targets = weakness_targets(records, classification, cwe)
    found, patterns = placed_patterns(targets, file_change, method_change, languages=languages, **options)
    return placed_rows(found, patterns, records, fixes, classification, cwe, fill_repo=fill_repo)


def placed_rows(
    found: DataFrame,
    patterns: DataFrame,
    records: DataFrame,
    fixes: DataFrame,
    classification: DataFrame,
    cwe: DataFrame,
    *,
    fill_repo: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``mined_rows`` of what ``placed_patterns`` found for the weaknesses of these records."""
    # Fixes lie by hash for the DISTINCT and for the join, so they are shuffled once.
    fixed = fixes.filter("hash IS NOT NULL").select("cve_id", "hash", "repo_url").repartition("hash").distinct()
    rows = found.join(fixed, "hash")

    if fill_repo is None:
        fill_repo = bool(fixes.filter(no_repo()).take(1))
    if fill_repo:
        by_repo = weakness_targets(records, classification, cwe, by_repository=True)
        rows = fill_repositories(rows, by_repo)
    # What follows from a pattern is made once for it and met last, so texts are not shuffled with the rows.
    patterns = patterns.withColumns(
        {
            "missing_sanitizers": sorted_names(F.col("pattern.missing_sanitizers")),
            "sink_types": key_part(F.col("pattern_key"), 1),
            "source_types": key_part(F.col("pattern_key"), 2),
        }
    )
    patterns = stage(patterns, "patterns")
    rows = rows.join(patterns.drop(*PATTERN_COLUMNS), "_pattern").select(
        "_pattern",
        "cwe_id",
        "cwe_name",
        "cve_id",
        "hash",
        "repo_url",
        "file_change_id",
        "method_change_id",
        "method_name",
        "signature",
        F.coalesce("diff", F.lit("")).alias("code_diff"),
        "pattern_key",
        "copies",
        "missing_sanitizers",
        "sink_types",
        "source_types",
    )
    return rows, patterns.select("_pattern", *PATTERN_COLUMNS)


def with_links(rows: DataFrame) -> DataFrame:
    """Instances with the link of their commit."""
    return rows.withColumn("commit_link", commit_link(F.col("repo_url"), F.col("hash")))


def with_patterns(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """The rows of ``mined_rows``, or what was chosen of them, with their patterns and code."""
    return rows.join(patterns, "_pattern").drop("_pattern")


def mine_patterns(
    records: DataFrame,
    fixes: DataFrame,
    file_change: DataFrame,
    method_change: DataFrame,
    classification: DataFrame,
    cwe: DataFrame,
    *,
    multiplicity: str = "compat",
    **options,
) -> DataFrame:
    """Pattern instances of the records.

    A method counts once per record of its file whose CVE has the weakness, and for every CVE
    that shares the commit hash. ``multiplicity``: ``compat`` repeats the rows, ``counted``
    gives each row once with a ``copies`` column (reports take it as a weight, so nothing need
    be repeated), ``distinct`` gives each row once. ``fill_repo``: whether fixes without a
    repository occur and take that of the record; None looks it up in ``fixes``.
    """
    rows, patterns = mined_rows(records, fixes, file_change, method_change, classification, cwe, **options)
    rows = with_links(with_patterns(rows, patterns))
    if multiplicity == "counted":
        return rows
    return rows.drop("copies") if multiplicity == "distinct" else repeat_rows(rows, "copies")


def top_pattern_keys(instances: DataFrame, top_n: int = 10) -> DataFrame:
    """Pattern keys with the most instances."""
    copies = F.col("copies") if "copies" in instances.columns else F.lit(1)
    return (
        instances.groupBy("pattern_key")
        .agg(F.sum(copies).cast("bigint").alias("instance_count"))
        .orderBy(F.desc("instance_count"), "pattern_key")
        .limit(top_n)
    )


def instance_table(instances: DataFrame) -> DataFrame:
    """The output columns, those that exist, in their fixed order."""
    return instances.select([c for c in INSTANCE_COLUMNS if c in instances.columns])
