"""Tables that several queries start from, staged once per session."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.compile import attach_queries, compile_queries, first_of_methods
from ..operators.extract import classification_of, extract_records
from ..operators.mining import mine_patterns, placed_patterns, placed_rows, weakness_targets, with_links, with_patterns
from ..session import stage
from .fixtures import Tables


def full_records(t: Tables, **options) -> DataFrame:
    return extract_records(t.fixes, t.commits, t.file_change, **options)


def records(t: Tables) -> DataFrame:
    """Extracted records without the code columns."""
    return t.staged(
        "extracted", lambda: full_records(t).drop("code_before", "code_after", "msg")
    )


def classified(t: Tables) -> DataFrame:
    return classification_of(records(t), t.cwe_classification, t.cwe)


def _database(t: Tables) -> tuple[DataFrame, ...]:
    return records(t), t.fixes, t.file_change, t.method_change, t.cwe_classification, t.cwe


def mined(t: Tables, **options) -> DataFrame:
    return mine_patterns(*_database(t), **options)


def _placed(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Methods with the numbers of their patterns, from written tables, and the patterns."""

    def build() -> tuple[DataFrame, DataFrame]:
        targets = weakness_targets(records(t), t.cwe_classification, t.cwe)
        return placed_patterns(targets, t.file_change, t.method_change)

    return t.kept("placed", build)


def _mined_rows(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Instances with the numbers of their patterns, written without what is wide; and the patterns."""

    def build() -> tuple[DataFrame, DataFrame]:
        rows, made = placed_rows(*_placed(t), records(t), t.fixes, t.cwe_classification, t.cwe)
        return stage(rows, "mined"), made

    return t.kept("mined", build)


def instance_rows(t: Tables) -> DataFrame:
    """Pattern instances, one row each with the number of copies, without pattern and code."""
    return with_links(_mined_rows(t)[0]).drop("_pattern")


def instances(t: Tables) -> DataFrame:
    """The same with pattern and code."""
    return with_links(with_patterns(*_mined_rows(t)))


def first_patterns(t: Tables) -> DataFrame:
    """``representatives(instances(t))``: the first pattern of a key is chosen by number, among methods, and met afterwards."""
    found, made = _placed(t)
    first = first_of_methods(found, made, records(t), t.fixes)
    return first.join(made.select("_pattern", "pattern"), "_pattern", "left").drop("_pattern")


def patterns(t: Tables) -> DataFrame:
    """One row per pattern key with its search text and keyword arrays."""
    return t.staged("patterns", lambda: compile_queries(first_patterns(t), keep_terms=True))


def queried(t: Tables) -> DataFrame:
    return attach_queries(instance_rows(t), patterns(t))
