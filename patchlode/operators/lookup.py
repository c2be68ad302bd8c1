"""Late lookups: wide columns of a large table for the few rows of a small one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of keys that are broadcast; more of them go the other way.
MOST_BROADCAST = 200_000
#: Bits of the filter, at most (as 64-bit words: 2^20 rows).
MOST_BITS = 26


def _slot(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << bits))


def key_filter(small: DataFrame, keys: Sequence[str], rows: int) -> tuple[DataFrame, int]:
    """One bit per hashed key, as rows of 64 bits: at most 2^20 rows, however many keys there are; and the number of bits."""
    bits = min(MOST_BITS, max(12, (16 * max(1, rows)).bit_length()))
    slots = small.select(_slot(keys, bits).alias("_slot"))
    one = F.expr("shiftleft(1L, cast(_slot & 63 as int))")
    return slots.groupBy(F.shiftright("_slot", 6).alias("_word")).agg(F.bit_or(one).alias("_bits")), bits


def may_hold(large: DataFrame, small: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Rows of ``large`` whose keys may be in ``small``; of other rows few pass. Nothing is shuffled."""
    words, bits = key_filter(small, keys, rows)
    met = large.withColumn("_slot", _slot(keys, bits)).withColumn("_word", F.shiftright("_slot", 6))
    hit = F.expr("getbit(_bits, cast(_slot & 63 as int)) = 1")
    return met.join(F.broadcast(words), "_word").filter(hit).drop("_slot", "_word", "_bits")


def late_lookup(
    small: DataFrame, large: DataFrame, keys: Sequence[str], columns: Sequence[str], most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """``small`` with some columns of ``large``, joined on ``keys``, without a shuffle of the whole of ``large``.

    ``small`` is read twice, so it should be staged. Up to ``most_broadcast`` rows its keys and columns are broadcast and the wide columns stay
    where they are. Beyond that a filter of bounded size drops the rows that cannot match before they are shuffled.
    """
    rows = small.count()
    wide = large.select(*keys, *columns)
    if rows <= most_broadcast:
        return wide.join(F.broadcast(small), list(keys)).select(*small.columns, *columns)
    return small.join(may_hold(wide, small, keys, rows), list(keys)).select(*small.columns, *columns)
