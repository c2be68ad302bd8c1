"""Near duplicates by word shingles: MinHash, banding, verification, connected components.

A text's set holds its distinct runs of ``words`` words (A-Z lower-cased, words split at ASCII white
space), or its whole word sequence if it has fewer; without words the set is empty and links to
nothing. Two texts are linked if 100 * |intersection| >= 75 * |union|.

1. One pass hashes each text: ``bands * rows`` minima of multiply-add-shift hashes (a universal
   family), one key per band, and a signature of eight bits per minimum.
2. Texts with the same set form one node; copies are counted by a partial aggregate and never paired.
3. In each band bucket every node is paired with the bucket's smallest node. Pairs whose signatures
   agree well enough are confirmed on their full sets and joined to components.
4. Buckets that still hold several components are searched further: ``rounds`` times every node outside
   the bucket's largest component meets a random node of it, which grows with the bucket, not its
   square. Then the comparisons still missing are made inside tasks, block by block and on full sets: nodes outside the
   largest component against the bucket's nodes of other components; only links leave a task. So every
   pair that shares a bucket is either inside one component or was compared.

With 32 bands of 4 rows a pair at similarity 0.75 shares no bucket with probability 5e-6; its
signatures differ too much with probability under 1e-6 (five standard deviations).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from .components import components
from .frames import drop_staged, row_key, stage
from .words import U, as_long, buffers, chunks, hashed_words, mix, rolled, runs, seeds

_SHINGLE_SEED = 501


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts (repeats included) and the bounds of the texts in them."""
    data, offsets = buffers(texts)
    hashes, _, _, bounds = hashed_words(data, offsets, lower=True)
    counts = np.diff(bounds)
    at, own = runs(bounds, words)
    long = rolled(hashes, words, _SHINGLE_SEED)[at]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if not len(short):
        return long, own
    whole = np.array(
        [rolled(hashes[bounds[i] : bounds[i + 1]], int(counts[i]), _SHINGLE_SEED)[0] for i in short]
    )
    return np.insert(long, own[short], whole), own + np.concatenate(
        [[0], np.cumsum((counts > 0) & (counts < words))]
    )


def _fingerprints(words: int, bands: int, rows: int):
    n = bands * rows
    a, b = seeds(n, 7) | U(1), seeds(n, 8)
    lanes = seeds(rows, 9) | U(1)

    def one(texts: pa.Array) -> list[pa.Array]:
        shingles, bounds = shingle_sets(texts, words)
        sizes, keys = [], []
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            own = np.unique(shingles[i:j])
            sizes.append(len(own))
            keys.append([int(x) for x in as_long(np.array([mix(own).sum(dtype=U), mix(own ^ U(0xA5A5)).sum(dtype=U)]))])
        filled = np.flatnonzero(np.diff(bounds))
        minima = np.zeros((n, len(texts)), U)
        if len(filled):
            for k in range(n):
                minima[k, filled] = np.minimum.reduceat((shingles * a[k] + b[k]) >> U(32), bounds[filled])
        band = np.zeros((bands, len(texts)), U)
        for r in range(rows):
            band += minima[r::rows] * lanes[r]
        band = mix(band + seeds(bands, 10)[:, None])
        lanes_of = (mix(minima) & U(255)).reshape(-1, 8, len(texts))
        sketch = (lanes_of << (U(8) * np.arange(8, dtype=U))[None, :, None]).sum(1, dtype=U)
        filled = np.diff(bounds) > 0

        def lists(x: np.ndarray) -> pa.Array:
            ends = np.concatenate([[0], np.cumsum(np.where(filled, len(x), 0))]).astype(np.int32)
            return pa.ListArray.from_arrays(ends, as_long(np.ascontiguousarray(x.T[filled])).ravel())

        keys = np.array(keys, np.int64).reshape(-1, 2)
        return [pa.array(sizes, pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), lists(band), lists(sketch)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "k1", "k2", "n", "s1", "s2", "bands", "sketch"]
        for batch in batches:
            for part in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:3]), *one(part.column("text"))], names)

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                shingles, bounds = shingle_sets(part.column("text"), words)
                own = [np.unique(shingles[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
                flat = as_long(np.concatenate(own)) if own else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(ends, flat)], ["node", "shingles"])

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    return (
        pairs.join(left, "u")
        .join(right, "v")
        .withColumn("both", both)
        .where(F.col("both") * 100 >= (F.size("su") + F.size("sv") - F.col("both")) * percent)
        .select("u", "v")
    )


def _cross_links(percent: int):
    """Links between the sets of two blocks, one per left node and component on the right."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        right = right.combine_chunks()
        lists = right["right_shingles"].combine_chunks()
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        known, ids = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        nodes, roots = right["right_node"].to_numpy(), right["right_root"].to_numpy()
        found: list[tuple[int, int]] = []
        for node, root, shingles in zip(left["left_node"].to_pylist(), left["left_root"].to_pylist(), left["left_shingles"], strict=True):
            own = shingles.values.to_numpy()
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            marked = np.zeros(len(known), np.int64)
            marked[at[known[at] == own]] = 1
            both = np.add.reduceat(marked[ids], starts)
            near = np.flatnonzero((both * 100 >= (len(own) + sizes - both) * percent) & (roots != root))
            _, first = np.unique(roots[near], return_index=True)
            found += [(node, int(v)) for v in nodes[near[first]]]
        return pa.table([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], schema=schema)

    return run


def _missing_links(open_: DataFrame, sets: DataFrame, percent: int, left_block: int = 256, right_block: int = 512) -> DataFrame:
    """Links of nodes outside the largest components to nodes of other components that they meet in a bucket.

    Buckets with the same largest component are searched together, so a pair that shares many of them is compared once.
    Both sides come in blocks; no pairs are written but the links.
    """
    met = open_.groupBy("largest", "node", "root").agg(F.max(F.col("root") != F.col("largest")).alias("out"))
    sizes = met.groupBy("largest").agg(
        F.greatest(F.lit(1), F.ceil(F.count_if("out") / left_block)).alias("lefts"), F.ceil(F.count("*") / right_block).alias("rights"))
    dealt = met.join(sizes, "largest").join(sets, "node")
    key = ["largest", "l", "r"]

    def blocks(side: str, df: DataFrame, own: str, own_n: str, other: str, other_n: str) -> GroupedData:
        salted = df.withColumn(own, F.pmod(F.xxhash64("node"), F.col(own_n)))
        names = [*key, "node", "root", "shingles"]
        salted = salted.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_n) - 1))).select(*names)
        return salted.toDF(*(f"{side}_{c}" for c in names)).groupBy(*(f"{side}_{c}" for c in key))

    left = blocks("left", dealt.where("out"), "l", "lefts", "r", "rights")
    right = blocks("right", dealt, "r", "rights", "l", "lefts")
    return left.cogroup(right).applyInArrow(_cross_links(percent), "u bigint, v bigint").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 75,
    bands: int = 32,
    rows: int = 4,
    rounds: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, and (k1, k2, s1, s2, group).

    component_id is the smallest id reachable over links; kept says that the row has that id.
    (k1, k2) is ``row_key(id, text)`` of the row, group names the component also without ids.
    Null text counts as empty. Rows with a null id link like others but never name a component;
    without any id it stays null and kept is false. Rows that repeat an id keep one row each; links go by text. Other columns
    are not read, so their names cannot clash. An empty table gives an empty result.
    """
    if (bands * rows) % 64:
        raise ValueError("bands * rows must be a multiple of 64")
    rows_in = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    schema = "id bigint, k1 bigint, k2 bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>, sketch array<bigint>"
    prints = stage(rows_in.mapInArrow(_fingerprints(words, bands, rows), schema), "minhash")

    # one node per set; nodes are numbered once and the numbers written, so that they never change
    nodes = stage(
        prints.groupBy("s1", "s2")
        .agg(
            F.min("id").alias("id"), F.min(F.struct("k1", "k2")).alias("key"), F.count("*").alias("copies"),
            F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    members = nodes.where("n > 0").select(F.explode("bands").alias("bucket"), "node")
    hubs = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("m")).where("m > 1")
    shared = stage(members.join(hubs.drop("m"), "bucket"), "buckets")

    lanes = range(bands * rows // 8)
    alike_share = percent / 100 + (1 - percent / 100) / 256
    most_differ = bands * rows * (1 - alike_share) + 5 * (bands * rows * alike_share * (1 - alike_share)) ** 0.5
    sketches = nodes.select("node", *(F.get("sketch", F.lit(i)).alias(f"w{i}") for i in lanes))

    def differing_bytes(x: Column) -> Column:
        for n in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, n))
        return F.bit_count(x.bitwiseAND(0x0101010101010101))

    def alike(a: str, b: str) -> Column:
        return sum(differing_bytes(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in lanes) <= most_differ

    def sketched(node: str, prefix: str) -> DataFrame:
        return sketches.select(F.col("node").alias(node), *(F.col(f"w{i}").alias(f"{prefix}{i}") for i in lanes))

    def compared(pairs: DataFrame) -> DataFrame:
        likely = pairs.distinct().join(sketched("u", "a"), "u").join(sketched("v", "b"), "v").where(alike("a", "b"))
        return stage(_confirmed(likely.select("u", "v"), sets, percent), "links")

    def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
        return stage(components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(links)), "roots")

    def unsettled(roots: DataFrame) -> DataFrame:
        """Nodes of the buckets that hold several components, with their own and the largest one."""
        placed = shared.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
        largest = (
            placed.groupBy("bucket", "root").agg(F.count("*").alias("m"))
            .groupBy("bucket").agg(F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("parts"))
            .where("parts > 1").select("bucket", F.col("top.root").alias("largest"))
        )
        return stage(placed.join(largest, "bucket"), "open")

    involved = shared.select("node").distinct()
    wanted = nodes.join(involved, "node").select("node", "key.k1", "key.k2")
    with_text = rows_in.join(wanted, ["k1", "k2"]).select("node", "text").dropDuplicates(["node"])
    sets = stage(with_text.mapInArrow(_sets(words), "node bigint, shingles array<bigint>"), "sets")

    links = compared(shared.where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")))
    roots = stage(components(links), "roots")
    for turn in range(rounds):
        open_ = unsettled(roots)
        pick = F.min_by("node", F.xxhash64(F.lit(turn), "bucket", "node"))
        hub = open_.where("root = largest").groupBy("bucket").agg(pick.alias("v"))
        more = compared(open_.where("root <> largest").join(hub, "bucket").select(F.col("node").alias("u"), "v"))
        drop_staged(open_)
        grown = not more.isEmpty()
        if grown:
            roots = merged(roots, more)
        drop_staged(more)
        if not grown:
            break

    open_ = unsettled(roots)
    more = stage(_missing_links(open_, sets, percent), "links")
    if not more.isEmpty():
        roots = merged(roots, more)
    for table in (shared, sets, open_, links, more):
        drop_staged(table)

    linked = nodes.where("copies > 1").select("node").union(roots.select("node")).distinct()
    placed = nodes.select("node", "s1", "s2", "id").join(linked, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("id").alias("least"))
    decided = placed.join(least, "root").select("s1", "s2", "least", "root")
    found = prints.select("id", "k1", "k2", "n", "s1", "s2").join(decided, ["s1", "s2"], "left")
    # sets of one row are their own component; empty ones never join another
    component = F.when((F.col("n") == 0) | F.col("root").isNull(), F.col("id")).otherwise(F.col("least"))
    group = F.when(F.col("n") == 0, F.concat_ws(":", F.lit("empty"), "k1", "k2")).otherwise(
        F.coalesce(F.col("root").cast("string"), F.concat_ws(":", "s1", "s2")))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"), "k1", "k2", group.alias("component_group"),
    )
