"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product becomes smallest distance first: vectors are divided by the largest norm and get one
more coordinate that makes them unit vectors, queries are scaled to length one. Each of ``tables`` tables cuts ``functions``
Gaussian projections into slots of a width; a row's bucket is its slots in a table.

A query visits perturbed buckets in the order of their estimated success: the probability that a neighbour at the
radius lies there, from the query's place in its own slots. It stops once the visited buckets of
all tables together hold such a neighbour with probability ``target``; the success of the last one is its
cut-off, and a bucket is visited if its success reaches that. Each query has a radius of its own, since rows may lie
dense in one place and scattered in another: the distance of the drawn row that is hardly ever nearer than its k-th neighbour.

Rows are grouped by table and coarse cell (the first ``coarse`` slots) and queries sent to the
cells that hold a bucket above their cut-off. Large cells are split on both sides into blocks of ``block`` rows, so no task
holds an unbounded group. Each block gives its best k per query, exactly scored; tables are merged.
Queries that found fewer than k rows are compared with all rows, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import drop_staged, stage

CLIP = 4
LEAST_RADIUS = 0.05
_erf = np.vectorize(math.erf, otypes=[float])


@dataclass
class Index:
    """Projections (tables, functions, dimension + 1), shifts, slot width, largest norm, cut share of a table; drawn rows by id,
    where each id starts, and which of the ids, by distance, gives a query its radius."""

    a: np.ndarray
    b: np.ndarray
    width: float
    norm: float
    share: float
    coarse: int
    points: np.ndarray
    starts: np.ndarray
    place: int


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    x = x / norm
    return np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))])


def _aimed(q: np.ndarray) -> np.ndarray:
    return np.column_stack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(len(q))])


def _slots(index: Index, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot numbers (rows, tables, functions), and the place inside the slot, from 0 to 1."""
    spot = (np.einsum("nd,tfd->ntf", points, index.a) + index.b) / index.width
    slot = np.clip(np.floor(spot), -CLIP, CLIP)
    return slot.astype(np.int8), spot - slot


def _distances(points: np.ndarray, starts: np.ndarray, aims: np.ndarray) -> np.ndarray:
    """Distance of each query to each drawn id, the least over the rows of the id."""
    far = np.sqrt(np.maximum(0, 2 - 2 * aims @ points.T))
    return np.minimum.reduceat(far, starts, axis=1)


def _radii(index: Index, aims: np.ndarray) -> np.ndarray:
    far = _distances(index.points, index.starts, aims)
    return np.maximum(np.partition(far, index.place - 1, axis=1)[:, index.place - 1], LEAST_RADIUS)


def _place(k: int, drawn: int, ids: int) -> int:
    """Of the k + 1 nearest ids, the query's own among them, this many are drawn at most, beyond two standard deviations."""
    mean = (k + 1) * drawn / ids
    return min(drawn, max(1, math.ceil(mean + 2 * math.sqrt(mean * (1 - drawn / ids)))))


def _success(index: Index, inside: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Log success of the slot below, the own one and the one above, for each function."""
    s = (radius / index.width * math.sqrt(2))[:, None, None]
    edges = np.stack([-1 - inside, -inside, 1 - inside, 2 - inside], -1)
    cumulative = 0.5 * (1 + _erf(edges / s))
    return np.log(np.maximum(np.diff(cumulative, axis=-1), 1e-300))


def _cut_offs(index: Index, log_success: np.ndarray) -> np.ndarray:
    """Success of the last visited bucket of each query in one table."""
    total = np.zeros((len(log_success), 1))
    for f in range(log_success.shape[1]):
        total = (total[:, :, None] + log_success[:, f, None, :]).reshape(len(log_success), -1)
    total = -np.sort(-total, axis=1)
    held = np.cumsum(np.exp(total), axis=1)
    last = np.argmax(held >= index.share, axis=1)
    last[held[:, -1] < index.share] = total.shape[1] - 1
    return total[np.arange(len(total)), last]


def _cell(slots: np.ndarray) -> np.ndarray:
    cell = np.zeros(slots.shape[:-1], np.int64)
    for j in range(slots.shape[-1]):
        cell = cell * (2 * CLIP + 1) + slots[..., j] + CLIP
    return cell


def _rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            slots, _ = _slots(index, _lifted(_matrix(batch.column("vector")), index.norm))
            for t in range(slots.shape[1] if len(slots) else 0):
                codes = [x.tobytes() for x in np.ascontiguousarray(slots[:, t])]
                cell = _cell(slots[:, t, : index.coarse])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cell), t, np.int32)), pa.array(cell), batch.column("id"), batch.column("vector"), pa.array(codes, pa.binary())],
                    ["t", "cell", "id", "vector", "code"])

    return run


def _probes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        steps = np.array(np.meshgrid(*[[-1, 0, 1]] * index.coarse, indexing="ij")).reshape(index.coarse, -1).T
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                aims = _aimed(_matrix(batch.column("vector")))
                slots, inside = _slots(index, aims)
                radius = _radii(index, aims)
                for t in range(slots.shape[1]):
                    success = _success(index, inside[:, t], radius)
                    cut = _cut_offs(index, success)
                    rest = success[:, index.coarse :].max(-1).sum(1)
                    best = rest[:, None] + sum(success[:, f, steps[:, f] + 1] for f in range(index.coarse))
                    query, step = np.nonzero(best >= cut[:, None] - 1e-9)
                    there = slots[query, t, : index.coarse] + steps[step]
                    real = (np.abs(there) <= CLIP).all(1)
                    query, there = query[real], there[real]
                    rows = pa.array(query)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(query), t, np.int32)), pa.array(_cell(there)), batch.column("id").take(rows), batch.column("vector").take(rows), pa.array(radius[query]), pa.array(cut[query])],
                        ["t", "cell", "id", "vector", "radius", "cut"])

    return run


def _block(shared, k: int, everything: bool) -> Callable:
    """The best k rows of a block for each of its queries, exactly scored."""

    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        index = shared.value
        rows, queries = rows.sort_by("id").combine_chunks(), queries.combine_chunks()
        ids, x = rows["id"].to_numpy(), _matrix(rows["vector"].combine_chunks())
        query_ids, q = queries["id"].to_numpy(), _matrix(queries["vector"].combine_chunks())
        # equal vectors are scored once; their ids stay in order
        raw = np.ascontiguousarray(x).view(np.dtype((np.void, 8 * x.shape[1]))).ravel()
        _, first, group = np.unique(raw, return_index=True, return_inverse=True)
        distinct = x[first]
        scores = q @ distinct.T
        if not everything:
            t = int(queries["t"][0].as_py())
            code = np.frombuffer(b"".join(rows["code"].to_pylist()), np.int8).reshape(len(ids), -1)[first]
            kinds, kind = np.unique(code, axis=0, return_inverse=True)
            slots, inside = _slots(index, _aimed(q))
            slots, success = slots[:, t], _success(index, inside[:, t], queries["radius"].to_numpy())
            total = np.zeros((len(q), len(kinds)))
            for f in range(kinds.shape[1]):
                step = kinds[None, :, f].astype(np.int16) - slots[:, f, None]
                total += np.where(np.abs(step) <= 1, np.take_along_axis(success[:, f], np.clip(step + 1, 0, 2).astype(np.int64), 1), -np.inf)
            visited = total >= queries["cut"].to_numpy()[:, None] - 1e-9
            scores = np.where(visited[:, kind.ravel()], scores, -np.inf)
        keep = min(len(distinct), k + 8)
        top = np.argpartition(-scores, keep - 1, axis=1)[:, :keep] if keep < len(distinct) else np.tile(np.arange(keep), (len(q), 1))
        exact = np.zeros(top.shape)
        for d in range(x.shape[1]):
            exact += q[:, d, None] * distinct[top, d]
        exact[np.isneginf(np.take_along_axis(scores, top, 1))] = -np.inf
        members = [np.unique(ids[g]) for g in np.split(np.argsort(group.ravel(), kind="stable"), np.cumsum(np.bincount(group.ravel()))[:-1])]
        found: tuple[list, list, list] = ([], [], [])

        def ranked(i: int, near: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The first k ids, each with its best score."""
            parts = [members[u][: k + 1] for u in near]
            own = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            score = np.repeat(value, [len(p) for p in parts])
            other = own != query_ids[i]
            own, score = own[other], score[other]
            order = np.lexsort((own, -score))
            _, best_of_id = np.unique(own[order], return_index=True)
            order = order[np.sort(best_of_id)][:k]
            return own[order], score[order]

        for i in range(len(q)):
            near = top[i][~np.isneginf(exact[i])]
            own, score = ranked(i, near, exact[i][~np.isneginf(exact[i])])
            if len(own) < k and len(near) == keep < len(distinct):
                # vectors of few ids took all the places: all visited vectors are read
                near = np.flatnonzero(~np.isneginf(scores[i]))
                value = np.zeros(len(near))
                for d in range(x.shape[1]):
                    value += q[i, d] * distinct[near, d]
                own, score = ranked(i, near, value)
            found[0].append(np.full(len(own), query_ids[i]))
            found[1].append(own)
            found[2].append(score)
        return pa.table([np.concatenate(f) for f in found], schema=schema)

    return best


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("vector")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad & some)


def build_index(rows: DataFrame, queries: DataFrame, dimension: int, norm: float, ids: int, k: int, tables: int, functions: int, coarse: int,
                target: float, sample: int, seed: int) -> Index:
    """Fit the width on at most ``sample`` rows and 256 queries; the drawn rows stay in the index for the radius of each query."""
    def drawn(df: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
        # ids are drawn, each with its rows
        found = df.select("id", "vector").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(most).toArrow().sort_by("id").combine_chunks()
        return found["id"].to_numpy(), _matrix(found["vector"].combine_chunks())

    (own, points), (_, aims) = drawn(rows, sample), drawn(queries, 256)
    starts = np.unique(own, return_index=True)[1]
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((tables, functions, dimension + 1))
    points = _lifted(points, norm)
    spread = float(np.einsum("nd,tfd->ntf", points, a).std()) or 1.0
    distances = _distances(points, starts, _aimed(aims)) if len(aims) else np.ones(1)
    radius = max(float(np.quantile(distances, min(1.0, (k + 1) / ids))), LEAST_RADIUS)
    width = max(2.4 * spread, 2.2 * radius)
    b = rng.uniform(0, width, (tables, functions))
    share = 1 - (1 - target) ** (1 / tables)
    return Index(a, b, width, norm, share, coarse, points, starts, _place(k, len(starts), max(ids, len(starts))))


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, tables: int = 3, functions: int = 8, coarse: int = 3, target: float = 0.96,
    block: int = 4096, sample: int = 4096, seed: int = 6, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest inner product found for each query.

    ``queries`` is a condition on id_col. Ties go to the smaller id; with fewer than k other rows all are given.
    Rows without id, null or zero vectors, vectors with null or non-finite components, and vectors of another length than most
    take no part. Rows that share an id act as one candidate with the best of their scores, and never match a query of
    that id. Other columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    asked = vectors.where(queries).select(F.col(id_col).alias("id")).distinct()
    # rows repeated as a whole are one row
    usable = stage(_usable(vectors, id_col, vector_col).distinct(), "vectors")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    kinds = usable.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.max(length).alias("norm"))
    most = kinds.orderBy(F.desc("n"), "d").first()
    if most is None:
        drop_staged(usable)
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = usable.where(F.size("vector") == most["d"])
    sought = usable.join(asked, "id", "left_semi").where(F.size("vector") == most["d"])
    index = build_index(rows, sought, most["d"], most["norm"], most["ids"], k, tables, functions, coarse, target, sample, seed)
    shared = spark.sparkContext.broadcast(index)

    vector = rows.schema["vector"].dataType.simpleString()
    placed = stage(rows.mapInArrow(_rows(shared), f"t int, cell bigint, id bigint, vector {vector}, code binary"), "hashed")
    probes = stage(sought.mapInArrow(_probes(shared), f"t int, cell bigint, id bigint, vector {vector}, radius double, cut double"), "probes")

    def blocks(rows: DataFrame, queries: DataFrame, everything: bool) -> DataFrame:
        # at most tables * (2 * CLIP + 1) ** coarse cells
        here = rows.groupBy("t", "cell").agg(F.ceil(F.count("*") / block).alias("parts"))
        there = queries.groupBy("t", "cell").agg(F.ceil(F.count("*") / block).alias("query_parts"))
        cells = F.broadcast(here.join(there, ["t", "cell"]))
        key = ["t", "cell", "part", "query_part"]

        def dealt(df: DataFrame, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
            spread = df.join(cells, ["t", "cell"]).withColumn(own, F.pmod(F.xxhash64("id"), F.col(own_parts)))
            return spread.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_parts) - 1))).drop("parts", "query_parts")

        left = dealt(queries, "query_part", "query_parts", "part", "parts").groupBy(*key)
        right = dealt(rows, "part", "parts", "query_part", "query_parts").groupBy(*key)
        return left.cogroup(right).applyInArrow(_block(shared, k, everything), "query_id bigint, vec_id bigint, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def merged(found: DataFrame) -> DataFrame:
        # an id is one candidate, however often it is found
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    found = stage(merged(blocks(placed, probes, False)), "neighbours")
    full = min(k, most["ids"] - 1)
    enough = found.groupBy("query_id").count().where(F.col("count") >= full).select(F.col("query_id").alias("id"))
    short = stage(sought.join(enough, "id", "left_anti"), "short") if full else None
    result = found
    if short is not None and not short.isEmpty():
        one = [F.lit(0).alias("t"), F.lit(0).cast("bigint").alias("cell"), "id", "vector"]
        every = merged(blocks(rows.select(*one, F.lit(b"").alias("code")), short.select(*one, F.lit(0.0).alias("cut")), True))
        result = found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(stage(every, "neighbours"))
    for table in (placed, probes, usable):
        drop_staged(table)
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
