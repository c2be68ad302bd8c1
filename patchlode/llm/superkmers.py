"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``k`` consecutive words of one text. Its minimiser is the run of ``m`` words inside it
with the smallest hash, the leftmost of equals. Neighbouring windows that share a minimiser form a
super-k-mer of at most k - m + 1 windows. Equal windows have equal minimisers, and two windows of one super-k-mer are never
equal, so a window can only repeat if its minimiser is that of two super-k-mers.

1. A first pass counts super-k-mers per minimiser. Minimisers met twice set a bit in a bitmap of
   fixed size (8 MB), which tasks get as a broadcast. Unrelated minimisers may share a bit; that
   costs traffic, never a wrong result.
2. A second pass sends each super-k-mer whose bit is set as one packed string of words to the bucket
   of its minimiser. There the windows are sorted and equal neighbours marked.
3. A minimiser with more than ``hot`` super-k-mers, such as that of a passage in a third of all
   texts, is not sent to one bucket. Neighbouring hot super-k-mers of a text are one string; equal strings are made one by
   an aggregate that combines before the shuffle, and all windows of a string met twice repeat. Windows of the
   others are hashed (128 bits) and counted alike.
4. Marked windows become word intervals per text; a word in any of them is removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import bitmap, drop_staged, has, row_key, stage
from .words import U, as_long, buffers, chunks, hashed_words, joined_words, rolled, runs, strings

BITS = 26


def _least(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and value of the leftmost smallest of each ``width`` neighbours."""
    at, value, have = np.arange(len(x)), x, 1
    while have < width:
        step = min(have, width - have)
        later = value[step:] < value[: len(value) - step]
        at = np.where(later, at[step:], at[: len(at) - step])
        value = np.where(later, value[step:], value[: len(value) - step])
        have += step
    return at, value


def _super_kmers(hashes: np.ndarray, bounds: np.ndarray, k: int, m: int):
    """First window (as word place), number of windows and minimiser of each super-k-mer."""
    windows, own = runs(bounds, k)
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    at, value = _least(rolled(hashes, m, 35), k - m + 1)
    at, value = at[windows], value[windows]
    new = np.ones(len(windows), bool)
    new[1:] = at[1:] != at[:-1]
    new[own[:-1][np.diff(own) > 0]] = True
    first = np.flatnonzero(new)
    return windows[first], np.diff(np.append(first, len(windows))), value[first]


def _count(k: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                hashes, _, _, bounds = hashed_words(*buffers(part.column("text")))
                yield pa.RecordBatch.from_arrays([pa.array(as_long(_super_kmers(hashes, bounds, k, m)[2]))], ["minimiser"])

    return run


def _has(found: np.ndarray, values: np.ndarray) -> np.ndarray:
    return has(found, values & U((1 << BITS) - 1))


def _packed(k: int, m: int, seen, hot, want_hot: bool):
    """Super-k-mers that may hold repeated windows, as packed strings: the hot ones or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                data, offsets = buffers(part.column("text"))
                hashes, starts, ends, bounds = hashed_words(data, offsets)
                first, n, value = _super_kmers(hashes, bounds, k, m)
                sent = _has(seen.value, value) & (_has(hot.value, value) == want_hot)
                first, n, value = first[sent], n[sent], value[sent]
                doc = np.searchsorted(bounds, first, "right") - 1
                if want_hot and len(first):
                    # neighbours become one, so that copies of a text send one string
                    new = np.append(True, (first[1:] != first[:-1] + n[:-1]) | (doc[1:] != doc[:-1]))
                    first, doc, value, n = first[new], doc[new], value[new], np.add.reduceat(n, np.flatnonzero(new))
                out, places = joined_words(data, starts, ends)
                raw = out.tobytes()
                spans = zip(places[first].tolist(), (places[first + n + k - 1] - 1).tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(as_long(value)), part.column("k1").take(pa.array(doc)), part.column("k2").take(pa.array(doc)),
                     pa.array(first - bounds[doc]), strings([raw[a:b] for a, b in spans])],
                    ["minimiser", "k1", "k2", "start", "packed"],
                )

    return run


def _windows(k: int):
    """The windows of packed strings, each by its 128-bit hash and its place in the string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "packed"):
                rows, places, names = [], [], []
                for i, s in enumerate(part.column("packed").cast(pa.binary()).to_pylist()):
                    words = _word_places(s)
                    rows += [i] * (len(words) - k)
                    places += range(len(words) - k)
                    names += [xxhash.xxh3_128_digest(s[words[j] + 1 : words[j + k]]) for j in range(len(words) - k)]
                hashed = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("g1").take(at), part.column("g2").take(at), pa.array(places, pa.int64()), pa.array(hashed[:, 0]), pa.array(hashed[:, 1])],
                    ["g1", "g2", "place", "w1", "w2"],
                )

    return run


def _word_places(s: bytes) -> list[int]:
    """The spaces of a packed string, with its two ends."""
    return [-1, *np.flatnonzero(np.frombuffer(s, np.uint8) == 32).tolist(), len(s)]


def _repeats(strings_: list[bytes], k: int) -> list[list[int]]:
    """For each packed string of one bucket, the places of its windows that are met again."""
    counts: dict[bytes, int] = {}
    for s in strings_:
        counts[s] = counts.get(s, 0) + 1
    windows = []
    for s in counts:
        words = _word_places(s)
        windows += [(s[words[j] + 1 : words[j + k]], j, s) for j in range(len(words) - k)]
    windows.sort()
    marked: dict[bytes, list[int]] = {s: [] for s in counts}
    for _, equal in groupby(windows, key=lambda w: w[0]):
        equal = list(equal)
        if len(equal) > 1 or counts[equal[0][2]] > 1:
            for _, j, s in equal:
                marked[s].append(j)
    return [sorted(marked[s]) for s in strings_]


def _sorted_buckets(k: int):
    """Word intervals of repeated windows, from rows sorted by minimiser."""

    def close(rows: list[tuple]) -> list[tuple]:
        found = []
        for (k1, k2, start, _), places in zip(rows, _repeats([r[3] for r in rows], k), strict=True):
            at = 0
            while at < len(places):
                end = at
                while end + 1 < len(places) and places[end + 1] == places[end] + 1:
                    end += 1
                found.append((k1, k2, start + places[at], start + places[end] + k))
                at = end + 1
        return found

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(4)], ["k1", "k2", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[tuple] = []
        current = None
        for batch in batches:
            found: list[tuple] = []
            minimisers = batch.column("minimiser").to_pylist()
            rows = zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "start")), batch.column("packed").cast(pa.binary()).to_pylist(), strict=True)
            for minimiser, row in zip(minimisers, rows, strict=True):
                if minimiser != current:
                    if len(open_rows) > 1:
                        found += close(open_rows)
                    open_rows, current = [], minimiser
                open_rows.append(row)
            if found:
                yield batch_of(found)
        if len(open_rows) > 1:
            yield batch_of(close(open_rows))

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            data, offsets = buffers(part.column("text"))
            _, starts, ends, bounds = hashed_words(data, offsets)
            spans = part.column("spans")
            doc = np.repeat(np.arange(len(spans)), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
            flat = spans.flatten()
            depth = np.zeros(len(starts) + 1, np.int64)
            np.add.at(depth, bounds[doc] + flat.field("a").to_numpy(zero_copy_only=False), 1)
            np.add.at(depth, bounds[doc] + flat.field("b").to_numpy(zero_copy_only=False), -1)
            keep = np.cumsum(depth)[:-1] == 0
            out, places = joined_words(data, starts, ends)
            byte = np.repeat(keep, np.diff(places))
            kept = np.flatnonzero(keep)
            per_doc = np.diff(np.searchsorted(kept, bounds))
            last = kept[np.cumsum(per_doc)[per_doc > 0] - 1]
            byte[places[last + 1] - 1] = False
            ends_of = np.concatenate([[0], np.cumsum(byte)])[places[bounds]]
            text = pa.StringArray.from_buffers(len(spans), pa.py_buffer(ends_of.astype(np.int32)), pa.py_buffer(out[byte].tobytes()))
            n = np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [part.column("rest"), part.column("text"), pa.array(n), pa.array(n - per_doc), text],
                ["rest", "text", "n_words", "n_removed", "kept_text"],
            )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 35, m: int = 12, hot: int = 4096
) -> DataFrame:
    """Every row of ``docs`` as (rest, text, n_words, n_removed, kept_text).

    ``rest`` is a struct of the other columns, so their names cannot clash. kept_text joins the kept
    words by one space. A word goes if any window over it has the same words as a window that starts
    anywhere else, in the same text too. Null or empty texts and texts of fewer than k words lose
    nothing; rows that repeat a text of k words or more lose all of it. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    rows = docs.select(F.col(text_col).alias("text"), rest.alias("rest"), *row_key(id_col, text_col))
    keyed = rows.select("k1", "k2", "text")
    counts = keyed.select("text").mapInArrow(_count(k, m), "minimiser bigint").groupBy("minimiser").count()
    counts = stage(counts.where("count > 1"), "minimisers")
    slot = F.col("minimiser").bitwiseAND((1 << BITS) - 1)
    seen, hot_bits = bitmap(counts, slot, BITS), bitmap(counts.where(F.col("count") > hot), slot, BITS)
    drop_staged(counts)
    any_hot = bool(hot_bits.any())
    seen, hot_bits = spark.sparkContext.broadcast(seen), spark.sparkContext.broadcast(hot_bits)

    schema = "minimiser bigint, k1 bigint, k2 bigint, start bigint, packed string"
    packed = keyed.mapInArrow(_packed(k, m, seen, hot_bits, False), schema)
    spans = packed.repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(
        _sorted_buckets(k), "k1 bigint, k2 bigint, a bigint, b bigint")
    staged = []
    if any_hot:
        names = [c.alias(f"g{i}") for i, c in enumerate(row_key("packed"), 1)]
        all_hot = stage(keyed.mapInArrow(_packed(k, m, seen, hot_bits, True), schema).select("k1", "k2", "start", "packed", *names), "hot")
        # equal strings are one; all windows of a string met twice repeat
        strings_ = stage(all_hot.groupBy("g1", "g2").agg(F.count("*").alias("met"), F.first("packed").alias("packed")), "strings")
        windows = stage(strings_.select("g1", "g2", "packed").mapInArrow(_windows(k), "g1 bigint, g2 bigint, place bigint, w1 bigint, w2 bigint"), "windows")
        again = windows.groupBy("w1", "w2").count().where("count > 1").drop("count")
        single = strings_.where("met = 1").select("g1", "g2")
        marked = windows.join(single, ["g1", "g2"], "left_semi").join(again, ["w1", "w2"], "left_semi").groupBy("g1", "g2").agg(
            F.array_sort(F.collect_set("place")).alias("p"))
        # neighbouring windows become one interval of places
        first = F.filter("p", lambda p, i: (i == 0) | (F.get("p", i - 1) != p - 1))
        last = F.filter("p", lambda p, i: (i == F.size("p") - 1) | (F.get("p", i + 1) != p + 1))
        marked = marked.select("g1", "g2", F.inline(F.arrays_zip(first.alias("x"), last.alias("y"))).alias("x", "y"))
        end = F.size(F.split("packed", " ")).cast("bigint") - k
        marked = marked.union(strings_.where("met > 1").select("g1", "g2", F.lit(0).cast("bigint"), end))
        found = all_hot.select("k1", "k2", "start", "g1", "g2").join(marked, ["g1", "g2"])
        spans = spans.union(found.select("k1", "k2", F.col("start") + F.col("x"), F.col("start") + F.col("y") + k))
        staged = [all_hot, strings_, windows]
    cover = stage(spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "spans")
    for table in staged:
        drop_staged(table)
    schema = T.StructType([rows.schema["rest"], *T.StructType.fromDDL("text string, n_words bigint, n_removed bigint, kept_text string").fields])
    return rows.join(cover, ["k1", "k2"], "left").select("rest", "text", "spans").mapInArrow(_removed, schema)
