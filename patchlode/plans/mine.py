"""The whole run: records, patterns, queries, instances and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.compile import attach_queries, compile_queries, representatives
from ..operators.extract import extract_records, run_statistics
from ..operators.mining import instance_table, mine_patterns
from ..session import stage


@dataclass(frozen=True)
class MiningRun:
    records: DataFrame
    instances: DataFrame
    patterns: DataFrame
    statistics: DataFrame

    @property
    def instance_file(self) -> DataFrame:
        return instance_table(self.instances)


def run_mining(
    tables: Mapping[str, DataFrame],
    *,
    top_n: int | None = 3,
    min_score: int = 65,
    exclude_merge: bool = True,
    languages: Sequence[str] = ("Java",),
    require_diff: bool = True,
    multiplicity: str = "compat",
    staged: bool = True,
    **options,
) -> MiningRun:
    """Mine a fix database.

    ``staged`` writes the record ids and the instances to the session's shared folder, since
    several results are built from each; without it everything stays one lazy plan.
    """
    t = tables
    records = extract_records(
        t["fixes"],
        t["commits"],
        t["file_change"],
        min_score=min_score,
        exclude_merge=exclude_merge,
        languages=languages,
        require_diff=require_diff,
        top_n=top_n,
        classification=t["cwe_classification"],
        cwe=t["cwe"],
    )
    ids = records.drop("code_before", "code_after", "diff", "msg")
    if staged:
        ids = stage(ids, "records")
    instances = mine_patterns(
        ids,
        t["fixes"],
        t["file_change"],
        t["method_change"],
        t["cwe_classification"],
        t["cwe"],
        languages=languages,
        multiplicity=multiplicity,
        **options,
    )
    if staged:
        instances = stage(instances, "instances")
    patterns = compile_queries(representatives(instances), top_n=top_n, keep_terms=True)
    with_queries = attach_queries(instances, patterns)
    return MiningRun(records, with_queries, patterns, run_statistics(ids, with_queries))
