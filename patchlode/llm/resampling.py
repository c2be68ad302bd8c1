"""Importance resampling towards a target distribution, over hashed word n-grams.

The hash of an n-gram is the CRC-32 of its bytes, and no n-gram is read for it. Each text is reduced to lower-case words
with one space before each. One scan stores the running CRC before every byte: zlib gives the value at the
start of each of many lanes, and numpy advances all lanes at once, a byte at a time. CRC-32 is linear over GF(2), so the CRC of
the bytes a to b follows from two of these values: the one at a, shifted by b - a zero bytes, cancels all that lies before a in
the one at b. Shifts are table lookups: one for lengths below 64, one more for each higher bit.

Counts of both corpora are bucket histograms of fixed size, added up per task and then by Spark; the gains of the
buckets go to a second scan, which gives each document its weight. Both scans cover all documents.
Draws are the highest scores of weight plus seeded Gumbel noise. Ranks come from ranges of the scores, so no task sorts all.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import drop_staged, ranked, row_key, stage
from .words import PIECE, buffers, chunks

LANES = 4096
SHORT = 64

_POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(_POLYNOMIAL), x >> 1).astype(np.uint32)
    return x


def _shifted(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values on the four single bytes."""
    found = tables[0][x & np.uint32(255)]
    for j in range(1, 4):
        found = found ^ tables[j][(x >> np.uint32(8 * j)) & np.uint32(255)]
    return found


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """Maps of the shift by 0 to SHORT - 1 zero bytes, and by SHORT * 2^k."""
    bytes_ = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    one = CRC[bytes_ & np.uint32(255)] ^ (bytes_ >> np.uint32(8))
    short = [bytes_]
    for _ in range(SHORT):
        short.append(_shifted(one, short[-1]))
    high = [short.pop()]
    for _ in range(25):
        high.append(_shifted(high[-1], high[-1]))
    return np.stack(short), np.stack(high)


CRC = _byte_table()
_SHORT, _HIGH = _shift_tables()

_WORD = np.zeros(256, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _WORD[_first : _last + 1] = np.arange(_first, _last + 1)
_WORD[0x41:0x5B] = np.arange(0x61, 0x7B)


def running_crcs(data: np.ndarray) -> np.ndarray:
    """CRC-32 of all bytes before each place, n + 1 values."""
    n = len(data)
    width = max(1, -(-n // LANES))
    lanes = -(-n // width) if n else 0
    begin, at = np.zeros(lanes, np.uint32), 0
    for lane in range(lanes):
        begin[lane] = at
        at = zlib.crc32(data[lane * width : (lane + 1) * width], at)
    padded = np.zeros(lanes * width, np.uint8)
    padded[:n] = data
    columns = np.ascontiguousarray(padded.reshape(lanes, width).T)
    state = ~begin
    found = np.empty((width, lanes), np.uint32)
    for i in range(width):
        found[i] = state
        state = CRC[(state ^ columns[i]) & np.uint32(255)] ^ (state >> np.uint32(8))
    out = np.empty(n + 1, np.uint32)
    out[:n] = ~found.T.ravel()[:n]
    out[n] = at
    return out


def shift_zeros(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The part of a CRC that an earlier CRC leaves after so many further bytes."""
    low = lengths & (SHORT - 1)
    found = _SHORT[low, 0, crc & np.uint32(255)]
    for j in range(1, 4):
        found = found ^ _SHORT[low, j, (crc >> np.uint32(8 * j)) & np.uint32(255)]
    rest = lengths >> 6
    for k in range(int(rest.max(initial=0)).bit_length()):
        here = np.flatnonzero(rest >> k & 1)
        found[here] = _shifted(_HIGH[k], found[here])
    return found


def _normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts with one space before each; first byte and byte after each word, and the text of each word."""
    raw = _WORD[data[offsets[0] : offsets[-1]]]
    inside = raw != 0
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets - offsets[0]] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    begins = np.flatnonzero(first)
    word_of = np.cumsum(first)
    text_of = np.searchsorted(offsets - offsets[0], begins, "right") - 1
    place = np.cumsum(inside) - 1 + word_of
    out = np.full(int(inside.sum()) + len(begins), 32, np.uint8)
    out[place[inside]] = raw[inside]
    starts = place[begins]
    ends = np.append(starts[1:] - 1, len(out))[: len(starts)]
    return out, starts, ends, text_of


def _one_piece(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each run length: text of each run, number of its last word, and its CRC."""
    out, starts, ends, text_of = _normalised(data, offsets)
    crcs = running_crcs(out)
    for size in range(1, n + 1):
        if len(starts) < size:
            break
        last = np.arange(size - 1, len(starts))
        head = last - (size - 1)
        same = text_of[head] == text_of[last]
        head, last = head[same], last[same]
        a, b = starts[head], ends[last]
        yield text_of[last], last, crcs[b] ^ shift_zeros(crcs[a], b - a)


def ngram_crcs(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(run length, text of each run, CRC-32 of each run of that many words joined by one space), in pieces.

    A text beyond two pieces is cut between words; its next piece begins with the last n - 1 words of the one before, and runs that
    lie in these alone are left out.
    """
    data, offsets = buffers(texts)
    if len(texts) != 1 or offsets[-1] - offsets[0] <= 2 * PIECE:
        for size, found in enumerate(_one_piece(data, offsets, n), 1):
            yield size, found[0], found[2]
        return
    at, end, carry = int(offsets[0]), int(offsets[-1]), np.zeros(0, np.uint8)
    while at < end:
        to, cut = min(at + PIECE, end), False
        while to < end and not cut:
            gaps = np.flatnonzero(_WORD[data[to : to + PIECE]] == 0)
            to, cut = (to + int(gaps[0]), True) if len(gaps) else (min(to + PIECE, end), False)
        piece = np.concatenate([carry, data[at:to]])
        bounds = np.array([0, len(piece)], np.int64)
        known = len(_normalised(carry, np.array([0, len(carry)], np.int64))[1]) if len(carry) else 0
        for size, (text, last, crc) in enumerate(_one_piece(piece, bounds, n), 1):
            new = last >= known
            yield size, text[new], crc[new]
        words, starts, _, _ = _normalised(piece, bounds)
        keep = min(n - 1, len(starts))
        carry = np.append(words[starts[-keep] :], np.uint8(32)) if keep else np.zeros(0, np.uint8)
        at = to


def _counted(n: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for here in chunks(batch, "text"):
                for _, _, crc in ngram_crcs(here.column("text"), n):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """Runs of 1 to n words in all texts by bucket; ``texts`` has one column, text."""
    partial = texts.mapInArrow(_counted(n, buckets), "bucket int, n bigint")
    found = partial.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, np.int64)
    total[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of the smoothed ratio of target to raw share of each bucket, floored."""
    buckets, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (float(all_raw) + buckets) / ((float(s) + 1) * (float(all_target) + buckets))))
        for s, t in zip(raw.tolist(), target.tolist(), strict=True)
    ], np.int64)


def _weighed(worth: np.ndarray, n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for here in chunks(batch, "text"):
                words, count, total = (np.zeros(here.num_rows, np.int64) for _ in range(3))
                for size, text, crc in ngram_crcs(here.column("text"), n):
                    found = np.bincount(text, minlength=here.num_rows)
                    count += found
                    words += found if size == 1 else 0
                    gained = np.bincount(text, worth[crc % np.uint32(len(worth))], here.num_rows)
                    total += gained.astype(np.int64)  # exact: sums stay far below 2 ** 53
                weight = np.where(count > 0, total // np.maximum(count, 1), 0)
                own = [here.column(c) for c in ("doc_id", "k1", "k2")]
                made = [pa.array(x) for x in (words, count, weight)]
                yield pa.RecordBatch.from_arrays([*own, *made], ["doc_id", "k1", "k2", "n_words", "n_features", "weight"])

    return run


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the id and the seed."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, n: int = 2, buckets: int = 10_000, least_words: int = 20, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, k1, k2, n_words, n_features, weight, score, rank.

    (k1, k2) names the row's id and text, see ``drawn``. Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII.
    The weight is the floored mean gain of the text's n-grams, 0 without any. Of the rows with at least ``least_words`` words,
    floor(percent / 100 of them) with the highest scores are drawn and ranked from 1; others have a null rank.
    Ties go to the smaller id, null ids (whose noise is that of the text "null") last, then by the row's hash; rows equal in all of it are alike.
    Null and empty texts have no features. Very long texts are read whole, in pieces. An empty target gives every bucket its own
    share's inverse; an empty table gives no rows. Other columns are not read.
    """
    text = F.col(text_col).alias("text")
    raw = bucket_counts(docs.select(text), n, buckets)
    worth = gains(raw, bucket_counts(target.select(F.col(target_col).alias("text")), n, buckets))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text, *row_key(id_col, text_col))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    weighed = keyed.mapInArrow(
        _weighed(worth, n), f"doc_id {kind}, k1 bigint, k2 bigint, n_words bigint, n_features bigint, weight bigint")
    scored = stage(weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)), "weights")
    long_enough = F.col("n_words") >= least_words
    eligible = scored.where(long_enough).count()
    order = [F.when(long_enough, 0).otherwise(1).asc(), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("k1"), F.asc("k2")]
    ranges = scored.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    # ranges are fixed by writing them
    parted = stage(ranges.withColumn("all", F.lit(0)), "score_ranges")
    drop_staged(scored)
    placed = ranked(parted, ["all"], "part", order, "place")
    drawn_here = F.col("place") < percent * eligible // 100
    rank = F.when(drawn_here, F.col("place") + 1)
    return placed.select("doc_id", "k1", "k2", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn(docs: DataFrame, ranked_rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn rows of ``docs`` with all their columns, as one struct ``row``, and their ranks.

    Rows that share id and text are alike here: one of them is given for each of their ranks.
    """
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *row_key(id_col, text_col))
    ranks = ranked_rows.where("rank is not null").select("k1", "k2", "rank")
    return row.dropDuplicates(["k1", "k2"]).join(ranks, ["k1", "k2"]).select("row", "rank")
