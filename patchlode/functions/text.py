"""Text helpers, all plain Column expressions (no Python UDF)."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \w and \s know ASCII only; these classes also hold the other Unicode letters, digits
# and blanks. "d" makes the line feed the only line end, so a dot runs over a carriage return.
WORD = r"[\w\p{L}\p{N}]"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
FLAGS = "(?iud)"

# A word followed by "=", as a search for it would find it: it begins where a word begins, or
# where the match before it ended. Nothing here needs backtracking, so none is allowed.
ASSIGN = rf"(?:\G|(?<!{WORD}))({WORD}++){SPACE}*+={SPACE}*+"

STRING_ARRAY = "array<string>"


_BUILT: dict[tuple, Column] = {}


def hashable(value):
    """Lists and mappings as tuples, however deep."""
    if isinstance(value, Mapping):
        return tuple((k, hashable(v)) for k, v in value.items())
    if isinstance(value, (list, tuple)) and not hasattr(value, "_fields"):
        return tuple(hashable(v) for v in value)
    return value


def by_name(build):
    """The same expression, for columns given by name, built once per process.

    The large expressions take thousands of calls into the JVM to put together; they hold names
    only, so one object serves every plan.
    """

    @wraps(build)
    def remembered(*names: str, **options) -> Column:
        jvm = id(SparkContext._gateway)
        key = (jvm, build.__module__, build.__qualname__, names, hashable(sorted(options.items())))
        if key not in _BUILT:
            _BUILT[key] = build(*[F.col(name) for name in names], **options)
        return _BUILT[key]

    return remembered


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def empty_array(ddl_type: str) -> Column:
    return F.array().cast(ddl_type)


def constant(value, ddl_type: str) -> Column:
    """A nested constant; one small node in the plan however long the list is."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), ddl_type)


def fold(text: Column) -> Column:
    """Lower case, with the three letters that only match i and s when case is ignored."""
    plain = F.replace(F.replace(text, F.lit("İ"), F.lit("i")), F.lit("ı"), F.lit("i"))
    return F.lower(F.replace(plain, F.lit("ſ"), F.lit("s")))


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of every kind (``trim`` removes blanks only)."""
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD}+)"), F.lit(1))


def leading_number(text: Column) -> Column:
    """The first seven bytes of a text as a number; of two texts the smaller one never has the larger number."""
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")


def first_filled(first: Column, second: Column) -> Column:
    """The first value unless it is NULL or empty, else the second."""
    return F.coalesce(F.nullif(first, F.lit("")), second)


def _cut(lines: Column, start: Column, end: Column) -> Column:
    """Lines ``start``..``end`` (from 1, both included) of an array, stripped; '' if there are none."""
    first = F.greatest(start, F.lit(1))
    count = F.least(end, F.size(lines)) - first + 1
    known = start.isNotNull() & end.isNotNull() & (count > 0)
    return F.when(known, strip(F.array_join(F.slice(lines, first, F.when(known, count).otherwise(0)), "\n"))).otherwise(F.lit(""))


def line_slice(text: Column, start: Column, end: Column) -> Column:
    """Lines ``start``..``end`` (from 1, both included), stripped; '' when the range is invalid."""

    def cut(lines: Column) -> Column:
        return _cut(lines, start, end)

    valid = text.isNotNull() & (text != "") & start.isNotNull() & end.isNotNull()
    return F.when(valid, let(F.split(text, "\n", -1), cut)).otherwise(F.lit(""))


def line_slices(text: Column, ranges: Column) -> Column:
    """``line_slice`` for every range (structs with start_line and end_line); the text is split once."""
    lines = F.when(text.isNotNull() & (text != ""), F.split(text, "\n", -1)).otherwise(F.array().cast(STRING_ARRAY))
    return let(lines, lambda own: F.transform(ranges, lambda r: _cut(own, r["start_line"], r["end_line"])))


def commit_link(repo_url: Column, commit: Column) -> Column:
    """Web address of a commit on github.com; '' for any other host or an empty hash."""
    known = F.contains(repo_url, F.lit("github.com")) & (commit != "")
    link = F.concat(F.regexp_replace(repo_url, r"\.git\z", ""), F.lit("/commit/"), commit)
    return F.coalesce(F.when(known, link), F.lit(""))


def raw_url(url: Column) -> Column:
    """Blob address to raw-content address; the branch is replaced by HEAD."""
    head = F.regexp_replace(url, "blob/[a-fA-F0-9]+", "HEAD")
    return F.replace(head, F.lit("github.com"), F.lit("raw.githubusercontent.com"))


def safe_name(text: Column) -> Column:
    return F.regexp_replace(text, r"[^a-zA-Z0-9_.\-]", "_")


def snippet(content: Column, terms: Column, context_lines: int = 3) -> Column:
    """Lines holding any term (case ignored) with ``context_lines`` lines around each.

    Kept lines stay in order; ``...`` goes before a line that lies more than
    ``2 * context_lines + 1`` lines after the kept line before it. No match gives ''.
    The text never leaves its row, so nothing is shuffled.
    """
    k = context_lines
    low_terms = F.transform(terms, F.lower)

    def build(lines: Column) -> Column:
        return let(
            F.transform(
                lines,
                lambda line: let(
                    F.lower(line), lambda low: F.exists(low_terms, lambda t: F.contains(low, t))
                ),
            ),
            lambda hits: let(
                F.filter(
                    F.sequence(F.lit(1), F.size(lines)),
                    lambda i: F.exists(
                        F.slice(hits, F.greatest(i - k, F.lit(1)), F.least(i, F.lit(k + 1)) + k),
                        lambda h: h,
                    ),
                ),
                lambda kept: F.array_join(
                    F.transform(
                        kept,
                        lambda i, n: F.concat(
                            F.when(
                                (n > 0) & (i - F.get(kept, n - 1) > 2 * k + 1), F.lit("...\n")
                            ).otherwise(F.lit("")),
                            F.get(lines, i - 1),
                        ),
                    ),
                    "\n",
                ),
            ),
        )

    return F.when(content.isNull() | (content == ""), F.lit("")).otherwise(
        let(F.split(content, "\n", -1), build)
    )


def shape_regex(shape: str) -> str:
    """Regular expression of a call shape.

    In a shape a blank stands for optional white space, ``~`` for required white space,
    ``*`` for optional word characters and ``…`` for anything on the same line. All other
    characters stand for themselves, in any letter case.
    """
    parts = {" ": SPACE + "*", "~": SPACE + "+", "*": WORD + "*", "…": ".*"}
    return "".join(parts.get(c) or (c if c.isalnum() else "\\" + c) for c in shape)


def shape_anchor(shape: str) -> str:
    """Longest literal stretch of a shape: a text without it cannot match."""
    return max(re.split("[ ~*…]+", shape), key=len).lower()


def is_literal(shape: str) -> bool:
    return not re.search("[ ~*…]", shape)


def line_neighbours(content: Column, needle: str) -> Column:
    """Lines that hold ``needle``, each with its number and the lines before and after it."""

    def context(lines: Column) -> Column:
        rows = F.transform(
            lines,
            lambda line, n: F.struct(
                (n + 1).alias("line_no"),
                F.when(n > 0, F.get(lines, n - 1)).alias("line_before"),
                line.alias("line"),
                F.get(lines, n + 1).alias("line_after"),
            ),
        )
        return F.filter(rows, lambda r: F.contains(r["line"], F.lit(needle)))

    return let(F.split(content, "\n", -1), context)
