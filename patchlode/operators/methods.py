"""Changed methods and their code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import line_slice, line_slices
from .extract import in_languages

#: Fixes of a commit in one list; bounds its rows.
FIXES_OF_ROW = 1 << 10


def usable_methods(method_change: DataFrame) -> DataFrame:
    """Methods as they were before the change, with both line numbers known."""
    return method_change.filter(
        F.col("start_line").isNotNull()
        & F.col("end_line").isNotNull()
        & (F.lower(F.col("before_change")) == "true")
    )


def line_number(text: Column) -> Column:
    """Line numbers are text; anything that is no whole number is unknown."""
    return F.trim(text).try_cast("int")


def packed(hash_: Column) -> Column:
    """A commit hash as bytes, half as long where it is hexadecimal: random digits are not compressed on their way. ``unpacked`` gives it back."""
    digits = F.unhex(hash_)
    kept = F.concat(F.lit(b"\0"), hash_.cast("binary"))
    return F.when(F.lower(F.hex(digits)) == hash_, F.concat(F.lit(b"\1"), digits)).otherwise(kept)


def unpacked(bytes_: Column) -> Column:
    rest = F.substring(bytes_, F.lit(2), F.length(bytes_))
    return F.when(F.substring(bytes_, 1, 1) == F.lit(b"\1"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def fix_lists(fixes: DataFrame) -> DataFrame:
    """hash (packed), cve_ids, repo_urls: the distinct pairs of each commit, at most ``FIXES_OF_ROW`` to a row. Fixes are shuffled once."""
    rows = fixes.filter("hash IS NOT NULL").select(packed(F.col("hash")).alias("hash"), "cve_id", "repo_url").repartition("hash")
    of_hash = Window.partitionBy("hash").orderBy("cve_id", "repo_url")
    # equal pairs have the same place, so they meet in one row
    row = F.floor((F.dense_rank().over(of_hash) - 1) / FIXES_OF_ROW)
    lists = rows.withColumn("_row", row).groupBy("hash", "_row").agg(F.collect_set(F.struct("cve_id", "repo_url")).alias("_fixes"))
    return lists.select("hash", F.col("_fixes.cve_id").alias("cve_ids"), F.col("_fixes.repo_url").alias("repo_urls"))


def method_changes(
    file_change: DataFrame,
    fixes: DataFrame,
    method_change: DataFrame,
    *,
    file_change_ids: DataFrame | None = None,
    languages: Sequence[str] = ("Java",),
    ordered: bool = False,
    unique_ids: bool = True,
    of_file: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Methods of the given file changes with every CVE that shares the commit hash.

    The score of a fix and its repository play no part here. Duplicates are removed from the
    narrow inputs before any code is attached, which equals a DISTINCT over the result because
    every join column is part of it. With ``unique_ids=False`` the two tables that carry code
    are freed of repeated rows as well. ``of_file`` names what is wanted of a file, as expressions over
    ``file_code_before`` and ``file_code_after``, in place of these two: it is made before files are shuffled.
    """
    files = file_change.filter(
        in_languages(languages) & F.col("code_before").isNotNull() & (F.col("code_before") != "")
    ).select(
        "file_change_id",
        packed(F.col("hash")).alias("_hash"),
        F.col("code_before").alias("file_code_before"),
        F.col("code_after").alias("file_code_after"),
    )
    methods = usable_methods(method_change).select(
        "file_change_id",
        "method_change_id",
        F.col("name").alias("method_name"),
        "signature",
        F.col("code").alias("code_after"),
        "start_line",
        "end_line",
        "before_change",
    )
    if not unique_ids:
        files, methods = files.distinct(), methods.distinct()
    wanted = None if file_change_ids is None else file_change_ids.select("file_change_id").distinct()
    # No row is repeated for its fixes before a shuffle.
    if of_file is not None:
        # Without code, methods meet their files and then the fixes.
        files = files.select("file_change_id", "_hash", *[c.alias(name) for name, c in of_file.items()])
        if wanted is not None:
            files = files.join(wanted, "file_change_id", "left_semi")
        pairs = fixes.select("cve_id", packed(F.col("hash")).alias("_hash"), "repo_url").repartition("_hash").distinct()
        met = files.join(methods, "file_change_id").join(pairs, "_hash")
    else:
        # Ids meet the fixes on the hash before any code is attached, so code is shuffled once, by file. The hashes are compared
        # last, as a second key of a join would ask for a shuffle of its own.
        ids = files.select("file_change_id", F.col("_hash").alias("hash")).repartition("hash").distinct()
        if wanted is not None:
            ids = ids.join(wanted, "file_change_id", "left_semi")
        fixed = ids.join(fix_lists(fixes), "hash")
        met = fixed.join(files, "file_change_id").join(methods, "file_change_id")
        pairs = F.arrays_zip(F.col("cve_ids").alias("cve_id"), F.col("repo_urls").alias("repo_url"))
        met = met.select("*", F.inline(F.when(F.col("hash") == F.col("_hash"), pairs)))
    found = met.select(
        "cve_id",
        unpacked(F.col("_hash")).alias("hash"),
        "repo_url",
        "file_change_id",
        "method_change_id",
        "method_name",
        "signature",
        "code_after",
        "start_line",
        "end_line",
        "before_change",
        *[c for c in files.columns if c not in ("file_change_id", "_hash")],
    )
    return found.orderBy("file_change_id", "start_line") if ordered else found


def with_method_code(methods: DataFrame) -> DataFrame:
    """Cut the method out of both file versions, both times at its lines before the change."""
    start, end = line_number(F.col("start_line")), line_number(F.col("end_line"))
    return methods.select(
        "*",
        line_slice(F.col("file_code_before"), start, end).alias("method_code"),
        line_slice(F.col("file_code_after"), start, end).alias("method_code_after"),
    )


def files_with_code(file_change: DataFrame, languages: Sequence[str]) -> DataFrame:
    return file_change.filter(in_languages(languages) & F.col("code_before").isNotNull() & (F.col("code_before") != ""))


def method_lines(method_change: DataFrame) -> DataFrame:
    """Every usable method with its lines as numbers: file_change_id, method_change_id, method_name, signature, start_line, end_line."""
    lines = [line_number(F.col(c)).alias(c) for c in ("start_line", "end_line")]
    names = ("file_change_id", "method_change_id", F.col("name").alias("method_name"), "signature")
    return usable_methods(method_change).select(*names, *lines).filter("start_line IS NOT NULL AND end_line IS NOT NULL")


def methods_of_files(
    file_change: DataFrame, method_change: DataFrame, *, languages: Sequence[str] = ("Java",)
) -> DataFrame:
    """Code of every usable method of every file, cut from both file versions; each file is split once.

    One row per method with known lines: file_change_id, method_change_id, method_name, signature, the
    columns of the file, and method_code, method_code_after. The methods of a file are collected as ids and lines.
    """
    files = files_with_code(file_change, languages)
    method = F.struct("method_change_id", "method_name", "signature", "start_line", "end_line")
    listed = method_lines(method_change).groupBy("file_change_id").agg(F.collect_list(method).alias("_methods"))
    before = line_slices(F.col("code_before"), F.col("_methods")).alias("b")
    after = line_slices(F.col("code_after"), F.col("_methods")).alias("a")
    cut = F.transform(
        F.arrays_zip(F.col("_methods").alias("m"), before, after),
        lambda x: F.struct(
            *[x["m"][c].alias(c) for c in ("method_change_id", "method_name", "signature")],
            x["b"].alias("method_code"),
            x["a"].alias("method_code_after"),
        ),
    )
    return files.join(listed, "file_change_id").select(*file_change.columns, F.inline(cut))
