"""Security measures that a fix added: present after, absent before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .text import (
    FLAGS,
    STRING_ARRAY,
    constant,
    empty_array,
    fold,
    is_literal,
    let,
    shape_anchor,
    shape_regex,
)


MEASURE_RULE_TYPE = "array<struct<regex:string,name:string,anchor:string>>"


def measure_catalogue(measures: Mapping[str, Sequence[str]] = R.SECURITY_MEASURES) -> Column:
    pairs = [(name, shape) for name, shapes in measures.items() for shape in shapes]
    return constant(
        [
            {
                "regex": None if is_literal(shape) else FLAGS + shape_regex(shape),
                "name": name,
                "anchor": shape_anchor(shape),
            }
            for name, shape in pairs
        ],
        MEASURE_RULE_TYPE,
    )


def measures_in(text: Column, measures: Mapping[str, Sequence[str]] | str) -> Column:
    """Names of the measures whose call shapes occur, in catalogue order.

    A regular expression runs only where its literal part occurs; a shape that is a plain
    literal needs none. ``measures`` may be the name of a column that holds the rules.
    """
    catalogue = F.col(measures) if isinstance(measures, str) else measure_catalogue(measures)

    def search(folded: Column) -> Column:
        hits = F.filter(
            catalogue,
            lambda r: F.contains(folded, r["anchor"])
            & (r["regex"].isNull() | F.rlike(text, r["regex"])),
        )
        return F.array_distinct(F.transform(hits, lambda r: r["name"]))

    return let(fold(text), search)


def added_measures(
    before: Column,
    after: Column,
    measures: Mapping[str, Sequence[str]] | str = R.SECURITY_MEASURES,
) -> Column:
    """Names of the measures found in ``after`` but not in ``before``, in catalogue order."""
    nothing = empty_array(STRING_ARRAY)
    old = F.coalesce(before, F.lit(""))
    added = let(
        measures_in(after, measures),
        lambda now: F.when(F.size(now) == 0, nothing).otherwise(
            F.array_except(now, measures_in(old, measures))
        ),
    )
    return F.when(F.coalesce(after, F.lit("")) == "", nothing).otherwise(added)
