"""Benchmark decontamination by template windows.

Texts become templates: tokens that hold a digit are numbers, a unit word after a number is a unit, a
capitalised word inside a sentence is a name; these are slots and only their type counts. Other tokens are
literals: lower-cased, without ASCII punctuation. Windows of ``window`` template tokens (the whole item, if shorter) are hashed and
joined: each match aligns an item with a document. A window with at least half literals is named by its template. One with more slots says
too little without them (arithmetic, tables), so it is named by its words as they are and finds copies only. A capital at the
beginning of an item may stand inside a sentence of a document, or behind a colon or quote, where it reads as a name: the item's first window is looked for
both ways. Matches of one alignment
are put together; the document is contaminated if they cover ``least_cover`` of the item and the slots are
consistent: one value of the item always stands for one value in the document. So a question with other
numbers or names is found, and a text that only resembles the template is not.

Windows of documents are checked first against a bitmap of fixed size made from the benchmark, so only likely
matches are shuffled, whatever the size of either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import bitmap, drop_staged, has, row_key, stage
from .words import U, as_long, buffers, chunks, hashed_words, rolled, runs

_BITS = 24
# fixed values: unit words
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "mg", "g", "kg",
    "gram", "grams", "kilogram", "kilograms", "ton", "tons", "pound", "pounds", "ounce", "ounces", "ml", "l", "liter",
    "liters", "litre", "litres", "gallon", "gallons", "second", "seconds", "minute", "minutes", "hour", "hours", "day",
    "days", "week", "weeks", "month", "months", "year", "years", "percent", "degree", "degrees", "dollar", "dollars",
    "cent", "cents", "euro", "euros", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre",
    "kilometres", "mph", "kmh", "hz", "khz", "w", "kw", "v", "j", "n",
)
_UNITS = frozenset(UNITS)
_DIGIT, _UPPER, _ENDER = (np.zeros(256, bool) for _ in range(3))
_DIGIT[48:58] = _UPPER[65:91] = True
_ENDER[[10, 33, 46, 63]] = True
_KEEP = np.ones(256, bool)
_KEEP[:128] = False
_KEEP[[0x20, *range(9, 14), *range(48, 58), *range(65, 91), *range(97, 123)]] = True
LITERAL, NUMBER, NAME, UNIT = range(4)
_SLOT = np.array([0, 0x1F3D5B79A1C3E5F7, 0x2B4D6F8193A5C7E9, 0x3C5E708294B6D8FA], U)


def templates(texts: pa.Array):
    """Hash, kind and template hash of each token, whether it could be a name, where it lies in the kept bytes, and the bounds of the texts."""
    data, offsets = buffers(texts)
    raw = data[offsets[0] : offsets[-1]]
    keep = _KEEP[raw]
    where = np.flatnonzero(keep)
    kept = raw[keep]
    bounds_in = np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]]
    hashes, starts, ends, bounds = hashed_words(kept, bounds_in, lower=True)
    kind = np.full(len(hashes), LITERAL)
    if not len(hashes):
        return hashes, kind, hashes, np.zeros(0, bool), kept, starts, ends, bounds
    digits = np.concatenate([[0], np.cumsum(_DIGIT[kept])])
    number = digits[ends] > digits[starts]
    second = kept[np.minimum(starts + 1, len(kept) - 1)]
    upper = _UPPER[kept[starts]] | ((kept[starts] == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    shouted = (ends - starts > 1) & _UPPER[second]
    enders = np.concatenate([[0], np.cumsum(_ENDER[raw])])
    opening = np.ones(len(hashes), bool)
    opening[1:] = enders[where[starts[1:]]] > enders[where[ends[:-1] - 1]]
    opening[bounds[:-1][np.diff(bounds) > 0]] = True
    kind[upper & ~shouted & ~opening] = NAME
    kind[number] = NUMBER
    first = np.zeros(len(hashes), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    follows = np.flatnonzero(np.append(False, number[:-1]) & ~number & ~first)
    for i in follows:
        if kept[starts[i] : ends[i]].tobytes().lower().decode("utf-8", "replace") in _UNITS:
            kind[i] = UNIT
    return hashes, kind, _template(hashes, kind), upper & ~shouted & ~number, kept, starts, ends, bounds


def _template(hashes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return np.where(kind == LITERAL, hashes, _SLOT[kind])


#: Tokens of a window that is named by its words, at least: a number or two are no copy.
LEAST_WORDS = 3


def _windows(lengths: list[int], wanted):
    """(h, k1, k2, place, slots) of all windows, and if a bitmap is given, of those in it; without one, of items: both readings of their
    first word. Windows named by their words have no slots to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                hashes, kind, plain, capital, kept, starts, ends, bounds = templates(part.column("text"))
                readings = [(kind, plain, None)]
                if wanted is None:
                    first = bounds[:-1][np.diff(bounds) > 0]
                    first = first[capital[first] & (kind[first] == LITERAL)]
                    other = kind.copy()
                    other[first] = NAME
                    readings.append((other, _template(hashes, other), first))
                for kinds, template, begins in readings:
                    literal = np.concatenate([[0], np.cumsum(kinds == LITERAL)])
                    for n in lengths:
                        at, _ = runs(bounds, n)
                        if begins is not None:
                            at = at[np.isin(at, begins)]
                        rich = 2 * (literal[at + n] - literal[at]) < n
                        h = np.where(rich, rolled(hashes, n, 1077 + n)[at], rolled(template, n, 77 + n)[at])
                        keep = ~rich | (n >= LEAST_WORDS)
                        if wanted is not None:
                            keep &= has(wanted.value, h & U((1 << _BITS) - 1))
                        at, h, rich = at[keep], h[keep], rich[keep]
                        doc = np.searchsorted(bounds, at, "right") - 1
                        slots = [
                            [] if words else
                            [f"{kinds[j]}{kept[starts[j] : ends[j]].tobytes().lower().decode('utf-8', 'replace')}" for j in range(i, i + n) if kinds[j] != LITERAL]
                            for i, words in zip(at.tolist(), rich.tolist(), strict=True)
                        ]
                        names = [c for c in part.schema.names if c != "text"]
                        rows = pa.array(doc, pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(as_long(h)), *(part.column(c).take(rows) for c in names), pa.array(at - bounds[doc], pa.int64()),
                             pa.array(slots, pa.list_(pa.string())), pa.array(np.full(len(at), n), pa.int64())],
                            ["h", *names, "place", "slots", "n"],
                        )

    return run


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.diff(templates(batch.column("text"))[-1])
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("text"), pa.array(n, pa.int64())], ["item_id", "text", "tokens"])


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 8, least_cover: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, cover, windows, reparameterised, k1, k2.

    cover is the share of the item's tokens under matched windows of the best alignment; reparameterised says
    that some slot has another value than in the item. (k1, k2) is ``row_key(id, text)`` of the
    document; repeated rows give one row. Null or empty texts match nothing, nor do items of one or two slots alone. Very long texts are read
    whole. Of equally good alignments the one nearest the document's beginning counts. Rows with a null id are found like others. Other columns are not read. Empty tables give an empty result.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
    items = stage(items.mapInArrow(_sizes, "item_id bigint, text string, tokens bigint").where("tokens > 0"), "items")
    # items shorter than a window are windows of their own length: at most window lengths
    lengths = sorted(r["n"] for r in items.select(F.least("tokens", F.lit(window)).alias("n")).distinct().collect())
    schema = "h bigint, {}, place bigint, slots array<string>, n bigint"
    ours = items.mapInArrow(
        lambda batches: _windows(lengths, None)(batches), schema.format("item_id bigint, tokens bigint")
    ).where(F.col("n") == F.least("tokens", F.lit(window)))
    ours = stage(ours.select("h", "item_id", "tokens", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), "n").distinct(), "windows")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(ours, F.col("h").bitwiseAND((1 << _BITS) - 1), _BITS))
    rows = docs.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    theirs = rows.mapInArrow(_windows(lengths, wanted), schema.format("doc_id bigint, k1 bigint, k2 bigint"))
    match = theirs.drop("n").join(ours, "h").withColumn("shift", F.col("place") - F.col("item_place"))
    one = ["doc_id", "k1", "k2", "item_id", "tokens", "n", "shift"]
    pairs = F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    match = stage(match.select(*one, "item_place", pairs.alias("pairs")), "matches")
    aligned = match.groupBy(*one).agg(F.count_distinct("item_place").alias("windows"), F.min("item_place").alias("x"), F.max("item_place").alias("y"))
    # covered: tokens under the windows, no more than the stretch they span, nor than they hold together
    covered = F.least(F.col("y") - F.col("x") + F.col("n"), F.col("windows") * F.col("n"), F.col("tokens")) / F.col("tokens")
    aligned = aligned.withColumn("cover", covered)
    values = (
        match.select(*one, F.explode("pairs").alias("p")).groupBy(*one, "p.a")
        .agg(F.min("p.b").alias("least"), F.max("p.b").alias("most"))
        .groupBy(*one).agg(F.max(F.col("least") != F.col("most")).alias("torn"), F.max((F.col("a") != F.col("least")) | (F.col("a") != F.col("most"))).alias("changed"))
    )
    null_safe = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("doc_id", "k1", "k2", "item_id", "shift")]
    good = (
        aligned.alias("l").join(values.alias("r"), null_safe, "left").where(~F.coalesce(F.col("r.torn"), F.lit(False)))
        .select(*(F.col(f"l.{c}").alias(c) for c in (*one, "windows", "cover")), F.coalesce(F.col("r.changed"), F.lit(False)).alias("reparameterised"))
        .where(F.col("cover") >= least_cover)
    )
    best = F.max_by(F.struct("windows", "reparameterised"), F.struct("cover", "windows", -F.col("shift")))
    found = good.groupBy("doc_id", "k1", "k2", "item_id").agg(F.max("cover").alias("cover"), best.alias("b"))
    return found.select("doc_id", "item_id", "cover", "b.windows", "b.reparameterised", "k1", "k2")
