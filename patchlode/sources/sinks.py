"""Sinks. Every write goes to a path of its own; nothing is overwritten while it is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.compile import output_columns, query_list
from ..operators.extract import CODE_COLUMNS
from ..operators.mining import instance_table
from .versioned import ResultTable


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with header; arrays and structs become JSON at this edge only. Blanks around a value stay. Compressed files are read as they are, see ``read_csv``."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct")]
    flat = df.withColumns({name: F.to_json(name) for name in nested}) if nested else df
    flat.write.csv(path, compression=compression, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def extract_output(records: DataFrame) -> DataFrame:
    return records.drop(*CODE_COLUMNS)


def top_cwe_output(top: DataFrame) -> DataFrame:
    return top.select("cwe_id", "cwe_name", "fix_count").withColumnRenamed(
        "fix_count", "fixes_cve_count"
    )


def write_extract(records: DataFrame, folder: str) -> None:
    write_csv(extract_output(records), f"{folder}/extract_java_vulnerable_code.csv")


def write_top_cwes(top: DataFrame, folder: str, top_n: int) -> None:
    write_csv(top_cwe_output(top), f"{folder}/top_cwe_top{top_n}.csv")


def write_instances(instances: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Each row repeats its link, diff and query as text, so the files are far larger than what they are made from: they are compressed unless asked otherwise."""
    write_csv(instance_table(instances), f"{folder}/pattern_instances.csv", compression)


def pattern_file_name(top_n: int | None) -> str:
    return "cwe_based_patterns.csv" if top_n is None else f"cwe_based_patterns_top{top_n}.csv"


def write_patterns(patterns: DataFrame, folder: str, top_n: int | None = None) -> None:
    write_csv(output_columns(patterns), f"{folder}/{pattern_file_name(top_n)}")


def write_query_list(patterns: DataFrame, path: str) -> None:
    write_csv(query_list(patterns), path)


def write_statistics(report: DataFrame, folder: str) -> None:
    write_csv(report, f"{folder}/top_github_queries_statistics.csv")


def append_result_table(new: DataFrame, path: str, run: str, keys: Sequence[str] = ("repository", "path")) -> ResultTable:
    """Add the results of a run to the versioned table at ``path``; the same run again changes nothing.

    The table's columns are those of the first run; ``ResultTable.read`` gives the rows.
    """
    table = ResultTable.open(new.sparkSession, path, new.schema, keys)
    table.commit(new, run)
    return table


def write_clustered(tables: dict[str, DataFrame], buckets: int, prefix: str = "") -> None:
    """Store the wide tables bucketed on the key they are joined on.

    ``file_change`` and ``method_change`` in equal buckets of ``file_change_id`` make the join
    of file code and methods free of shuffles.
    """
    for name in ("file_change", "method_change"):
        tables[name].write.bucketBy(buckets, "file_change_id").sortBy(
            "file_change_id"
        ).saveAsTable(f"{prefix}{name}")
