"""Short codes of vectors: product quantisation in whole numbers, with value dictionaries per dimension.

A component x becomes floor(scale * x). Rows travel in blocks. A block holds, for each dimension, the
sorted distinct integers of its rows (the dictionary) and for each row its place in them. A round
tabulates, once per dimension and block, the squared difference of every dictionary value to that component of all
codebook entries; the distance of a part to all entries is then a gather from each table and a sum.
Blocks are encoded and staged once, and every round reads the codes, not the vectors.

What reaches the driver is a codebook's size: the first ``entries`` rows, and sums per entry and
dimension that tasks add up for their rows and Spark for all tasks. No group is ever collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import drop_staged, stage

#: Rows of a block; bounds its dictionaries and tables.
BLOCK = 4096
#: Integers are held within +-LIMIT, so that sums of squares fit 64 bits.
LIMIT = 1 << 28


@dataclass(frozen=True)
class VectorCodes:
    """Rows of id, label, code and error; and the entries of each part, one array (entries, width) a part."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 over all components in order of part, entry and place, joined by commas."""
        values = (str(int(x)) for book in self.codebooks for x in book.ravel())
        return hashlib.sha256(",".join(values).encode()).hexdigest()


def _whole(vectors: pa.Array, dimension: int, scale: float) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat * scale), -LIMIT, LIMIT).astype(np.int64).reshape(len(vectors), dimension)


def _encoded(dimension: int, scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of rows: ids, labels, sizes of the dictionaries, their values, and codes by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                here = batch.slice(at, BLOCK)
                columns = _whole(here.column("vector"), dimension, scale).T
                pairs = [np.unique(column, return_inverse=True) for column in columns]
                bounds = pa.array([0, here.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, here.column(c)) for c in ("id", "label")]
                blobs = (
                    np.array([len(v) for v, _ in pairs], np.int32),
                    np.concatenate([v for v, _ in pairs]) if pairs else np.zeros(0, np.int64),
                    np.concatenate([c for _, c in pairs]).astype(np.uint16) if pairs else np.zeros(0, np.uint16),
                )
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in blobs]
                yield pa.RecordBatch.from_arrays([*lists, *blobs], ["id", "label", "sizes", "values", "codes"])

    return run


class _Block:
    """A block read back: (dictionary, codes) of each dimension."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        def of(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(batch.column(name)[row].as_py(), kind)

        sizes = of("sizes", np.int32)
        self.n = len(batch.column("id")[row])
        self.dictionaries = np.split(of("values", np.int64), np.cumsum(sizes)[:-1]) if len(sizes) else []
        self.codes = of("codes", np.uint16).reshape(len(sizes), self.n)

    def nearest(self, book: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry for the part that begins at dimension ``first``."""
        width = book.shape[1]
        most = max([int(np.abs(x).max(initial=0)) for x in (*self.dictionaries[first : first + width], book)])
        kind = np.int32 if 4 * most * most * max(1, width) < 1 << 31 else np.int64
        total = np.zeros((self.n, len(book)), kind)
        gathered = np.empty_like(total)
        for j in range(width):
            differences = self.dictionaries[first + j][:, None] - book[None, :, j]
            np.take((differences * differences).astype(kind), self.codes[first + j], axis=0, out=gathered)
            total += gathered
        best = total.argmin(1)
        return best, total[np.arange(self.n), best].astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, pa.RecordBatch, int]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield _Block(batch, row), batch, row


def _sums(books: list[np.ndarray], cuts: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For all blocks of a task: part, entry, and [count, sum of each component] of the parts assigned to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((1 + book.shape[1], len(book)), np.int64) for book in books]
        for block, _, _ in _blocks(batches):
            for book, first, found in zip(books, cuts, sums, strict=False):
                best, _ = block.nearest(book, first)
                found[0] += np.bincount(best, minlength=len(book))
                for j in range(book.shape[1]):
                    values = block.dictionaries[first + j][block.codes[first + j]]
                    # exact: at most BLOCK * LIMIT = 2 ** 40
                    found[1 + j] += np.bincount(best, values, len(book)).astype(np.int64)
        rows = [(p, int(e), found[:, e].tolist()) for p, found in enumerate(sums) for e in np.flatnonzero(found[0])]
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()))
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "entry", "sums"])

    return run


def _assigned(books: list[np.ndarray], cuts: list[int], digits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, batch, row in _blocks(batches):
            found = [block.nearest(book, first) for book, first in zip(books, cuts, strict=False)]
            text = np.stack([best for best, _ in found], 1).astype(f">u{digits // 2}").tobytes().hex()
            size = digits * len(books)
            codes = [text[i : i + size] for i in range(0, len(text), size)]
            error = sum(distance for _, distance in found)
            own = [batch.column(c)[row].values for c in ("id", "label")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(codes), pa.array(error, pa.int64())], ["id", "label", "code", "error"])

    return run


def compress_vectors(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> VectorCodes:
    """Codes of all vectors: for each of ``parts`` consecutive parts the number of its nearest entry, in hex.

    Rows with a null vector or one that holds null or non-finite components are left out. Codebooks start as the parts of the
    ``entries`` smallest ids (ties by the vector, null ids last) and follow ``rounds`` rounds of assignment and floored means;
    ties go to the lower entry, unused entries stay. ``error`` sums the squared distances of the last assignment.
    Fewer rows than ``entries`` give as many entries; rows that repeat an id, or all of a row, count each. A length that the parts do
    not divide is cut at floor(part * length / parts). Vectors of another length than most rows (the shorter, in a tie) take no part and
    come back with null code and error. Integers beyond +-2^28 count as that. Labels may be null and are only carried.
    Other columns are not read. An empty table gives no rows and no codebooks.
    """
    if not 1 <= entries <= 1 << 16:
        raise ValueError("entries must lie between 1 and 65536")
    vector = F.col("vector")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    kept = named.where(vector.isNotNull()).where(~bad)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    out = f"id {kinds['id']}, label {kinds['label']}, code string, error bigint"
    lengths = kept.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "d").first()
    if most is None:
        return VectorCodes(vectors.sparkSession.createDataFrame([], out), [])
    d = most["d"]
    usable = kept.where(F.size("vector") == d)
    first = usable.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").toArrow()["vector"]
    start = _whole(first.combine_chunks(), d, scale)
    cuts = [p * d // parts for p in range(parts + 1)]
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    schema = f"id array<{kinds['id']}>, label array<{kinds['label']}>, sizes binary, values binary, codes binary"
    blocks = stage(usable.mapInArrow(_encoded(d, scale), schema), "vector_blocks")
    for _ in range(rounds):
        partial = blocks.mapInArrow(_sums(books, cuts), "part int, entry int, sums array<bigint>")
        spread = partial.select("part", "entry", F.posexplode("sums").alias("pos", "value"))
        # at most entries * (dimension + parts) rows
        sums = spread.groupBy("part", "entry", "pos").agg(F.sum("value").alias("value")).toArrow()
        part, entry, pos, value = (sums[c].to_numpy() for c in ("part", "entry", "pos", "value"))
        books = [book.copy() for book in books]
        for p, book in enumerate(books):
            counts = np.zeros(len(book), np.int64)
            here = (part == p) & (pos == 0)
            counts[entry[here]] = value[here]
            here = (part == p) & (pos > 0)
            book[entry[here], pos[here] - 1] = value[here] // counts[entry[here]]
    coded = blocks.mapInArrow(_assigned(books, cuts, 2 if entries <= 256 else 4), out)
    rows = stage(coded, "vector_codes")
    drop_staged(blocks)
    odd = kept.where(F.size("vector") != d)
    return VectorCodes(rows.unionByName(odd.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))), books)


def label_errors(rows: DataFrame, bound: int = 100_000, salts: int = 64) -> DataFrame:
    """Adds ``label_error``: the error summed over equal labels, nulls together.

    The sums are broadcast only up to ``bound`` labels; more of them meet the rows on (label, salt), so that
    a label with many rows is spread over ``salts`` tasks.
    """
    sums = stage(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    sums = sums.select(F.col("label").alias("own_label"), "label_error")
    same: Column = F.col("label").eqNullSafe(F.col("own_label"))
    if sums.count() <= bound:
        return rows.join(F.broadcast(sums), same).drop("own_label")
    salted = sums.withColumn("own_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = rows.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(salts)).cast("int"))
    return spread.join(salted, same & (F.col("salt") == F.col("own_salt"))).drop("own_label", "salt", "own_salt")
