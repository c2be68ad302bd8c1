"""Packing of documents into token sequences by linear grouping and best fit.

Only the number of pieces of each length matters for a plan, so the plan is made on the driver from a
histogram of at most ``capacity`` entries, whatever the number of documents:

1. Lengths over a quarter of a sequence are large. In descending order they are cut into groups of equal
   cardinality and rounded up to the largest of their group.
2. A linear program over configurations (at most three large lengths fit a sequence) covers the groups with fewest
   sequences: column generation with the revised simplex method.
3. Actual lengths take the places of the rounded ones, in runs of equal sequences: the first places take the longest
   length left in their group or below, the last place the longest length left that fits. A longer
   length there leaves a shorter one for later, so no configuration gets worse. Then configurations get one sequence more by falling
   fractions, up to the program's own total.
4. What is left, large or small, is placed by best fit in descending order into the smallest gap that holds it, in
   counts of equal gaps and lengths.

The plan says, for each length, which ranks go to which sequences and offsets. Spark ranks the
pieces of each length and looks their places up; the plan is bounded, so it is broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import MOST_RANGES, ranked, row_key, stage
from .words import chunks

END = 2
_LONG_RUN = re.compile(r"\S{2000}")


def _groups(hist: dict[int, int], sizes: list[int], groups: int) -> list[list[list[int]]]:
    """Runs [length, count] of each group, longest first; groups of one rounded length are joined."""
    total = sum(hist[s] for s in sizes)
    each = max(1, -(-total // groups))
    found: list[list[list[int]]] = [[]]
    room = each
    for s in sizes:
        n = hist[s]
        while n:
            take = min(n, room)
            found[-1].append([s, take])
            n, room = n - take, room - take
            if not room:
                found.append([])
                room = each
    joined: list[list[list[int]]] = []
    for g in filter(None, found):
        if joined and joined[-1][0][0] == g[0][0]:
            joined[-1] += g
        else:
            joined.append(g)
    return joined


def _cover(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], float]]:
    """Configurations (group numbers, longest first) and counts: the linear program's basis."""
    k = len(sizes)
    # two group numbers, k for an empty place; the third is the dearest one that fits the room they leave and is no longer
    two = np.array([(i, j) for i in range(k) for j in range(i, k + 1) if j == k or sizes[i] + sizes[j] <= capacity], np.int64)
    room = capacity - np.append(sizes, 0)[two].sum(1)
    room = np.minimum(room, np.append(sizes, 0)[two[:, 1]])
    # groups run from long to short: those that fit a room start here
    fits = np.searchsorted(-sizes, -room)
    most = np.minimum(3, capacity // sizes).astype(int)
    basis = [(i,) * most[i] for i in range(k)]
    inverse = np.diag(1 / most)
    x = demand / most
    for _ in range(20 * k + 100):
        dual = np.append(inverse.sum(0), 0.0)
        third = np.maximum.accumulate(dual[::-1])[::-1]
        price = dual[two].sum(1) + third[fits]
        best = int(price.argmax())
        if price[best] <= 1 + 1e-7:
            break
        start = fits[best]
        chosen = [*two[best], start + int(dual[start:].argmax())]
        column = np.bincount(chosen, minlength=k + 1)[:k]
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, x / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x -= step * direction
        x[out] = step
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
        basis[out] = tuple(int(i) for i in chosen if i < k)
    return [(config, float(v)) for config, v in zip(basis, x, strict=True) if v > 1e-6]


def configured(hist: dict[int, int], capacity: int, groups: int = 512) -> tuple[list[list], dict[int, int]]:
    """Sequences made by configurations of large lengths, as [how many, [(length, times), ...]], and what they leave."""
    left = dict(hist)
    large = [s for s in sorted(hist, reverse=True) if capacity // 4 < s < capacity and hist[s]]
    if not large:
        return [], left
    queues = _groups(hist, large, groups)
    sizes, demand = np.array([g[0][0] for g in queues]), np.array([sum(n for _, n in g) for g in queues], float)
    covered = _cover(sizes, demand, capacity)

    def longest(s: int) -> int:
        return next((x for x in range(min(s, capacity - 1), capacity // 4, -1) if left.get(x)), 0)

    bins: list[list] = []

    def place(config: tuple[int, ...], count: int) -> bool:
        while count:
            items: dict[int, int] = {}
            room = capacity
            for i, g in enumerate(config):
                s = longest(room if i == len(config) - 1 else min(room, int(sizes[g])))
                while s and left[s] <= items.get(s, 0):
                    s = longest(s - 1)
                if not s:
                    break
                items[s] = items.get(s, 0) + 1
                room -= s
            if sum(items.values()) < len(config):
                return False
            run = min(count, *(left[s] // t for s, t in items.items()))
            for s, t in items.items():
                left[s] -= run * t
            bins.append([run, list(items.items())])
            count -= run
        return True

    for config, v in sorted(covered, key=lambda c: -int(sizes[c[0][0]])):
        place(config, int(v + 1e-6))
    more = round(sum(v - int(v + 1e-6) for _, v in covered))
    for config, _ in sorted(covered, key=lambda c: int(c[1] + 1e-6) - c[1]):
        if more > 0:
            more -= place(config, 1)
    return bins, left


def plan(hist: dict[int, int], capacity: int, groups: int = 512) -> list[tuple[int, list[tuple[int, int]]]]:
    """Kinds of sequence: (how many, [(length, times), ...]); together they hold the histogram exactly."""
    bins: list[list] = []
    gaps: dict[int, list[int]] = {}

    def add(count: int, items: list[tuple[int, int]]) -> None:
        gap = capacity - sum(s * n for s, n in items)
        bins.append([count, items])
        if gap:
            gaps.setdefault(gap, []).append(len(bins) - 1)

    made, left = configured(hist, capacity, groups)
    for count, items in made:
        add(count, items)

    for s in sorted(left, reverse=True):
        n = left[s]
        for gap in range(s, capacity):
            while n and gaps.get(gap):
                at = gaps[gap].pop()
                count, items = bins[at]
                fit = min(gap // s, n)
                whole = min(count, n // fit)
                if whole < count:  # the other sequences of this kind keep their gap
                    bins[at][0] = count - whole
                    gaps[gap].append(at)
                    add(whole, [*items, (s, fit)])
                else:
                    bins[at][1] = [*items, (s, fit)]
                    if gap - s * fit:
                        gaps.setdefault(gap - s * fit, []).append(at)
                n -= whole * fit
            if not n:
                break
        fit = capacity // s
        if n // fit:
            add(n // fit, [(s, fit)])
        if n % fit:
            add(1, [(s, n % fit)])
    return [(count, items) for count, items in bins if count]


def _places(bins: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each run of ranks of a length: length, first rank, end, first sequence, times, offset."""
    rank: dict[int, int] = {}
    found, sequence = [], 0
    for count, items in bins:
        offset = 0
        for s, times in items:
            first = rank.get(s, 0)
            rank[s] = first + count * times
            found.append((s, first, rank[s], sequence, times, offset))
            offset += s * times
        sequence += count
    return found


@lru_cache(maxsize=4)
def _encoder(json_path: str, ranks_path: str):
    """Ids of a text. The rank file holds the same vocabulary for a faster encoder; texts with
    a special token's string or very long runs go to the first one."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path)
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
    fast = tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(s in text for s in special) or _LONG_RUN.search(text):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def _pieces(json_path: str, ranks_path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(json_path, ranks_path)
        for batch in batches:
            for part in chunks(batch, "text"):
                at, number, start, length, crc, kept = [], [], [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = np.array([*encode(text or ""), END], "<u4")
                    cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                    for j, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        at.append(i)
                        number.append(j)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                        if with_ids:
                            kept.append(ids[a:b].astype(np.int32))
                at = pa.array(at, pa.int64())
                arrays = [*(part.column(c).take(at) for c in ("doc_id", "k1", "k2")), pa.array(number, pa.int32()),
                          *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "k1", "k2", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def pack(
    docs: DataFrame, json_path: str, ranks_path: str, capacity: int = 1024, per_range: int = 2000,
    with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its token ids and the end id. Documents over ``capacity`` are cut so that only the first
    piece may be shorter. Null texts count as empty: the end id alone. Rows that repeat an id are packed
    each. Other columns are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    schema = "doc_id bigint, k1 bigint, k2 bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    pieces = stage(rows.mapInArrow(_pieces(json_path, ranks_path, capacity, with_ids), schema), "pieces")
    hist = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    places = docs.sparkSession.createDataFrame(
        _places(plan(hist, capacity)), "length bigint, rank_from bigint, rank_to bigint, first bigint, times bigint, begin bigint")
    ranges = max(1, min(MOST_RANGES, sum(hist.values()) // per_range))
    parts = pieces.withColumn("part", F.pmod("k1", F.lit(ranges)))
    placed = ranked(parts, ["length"], "part", [F.col("k1"), F.col("k2"), F.col("piece")], "rank").drop("part")
    found = placed.join(F.broadcast(places), "length").where((F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("first + (rank - rank_from) div times").alias("sequence_id"),
        F.expr("begin + (rank - rank_from) % times * length").alias("offset"), *(["ids"] if with_ids else []),
    )
