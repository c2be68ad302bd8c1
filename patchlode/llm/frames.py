"""Small DataFrame helpers of the operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage, stage_path

__all__ = ["bitmap", "drop_staged", "has", "held_out", "ranked", "row_key", "stage", "stage_path", "table", "training"]

#: Most ranges that a ranking uses; bounds its tables of counts.
MOST_RANGES = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str | Column) -> list[Column]:
    """Two 64-bit hashes that together name the content of the columns (128 bits), as k1 and k2."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return [
        F.xxhash64(F.lit(11), *parts).alias("k1"),
        F.xxhash64(*reversed(parts), F.lit("second")).alias("k2"),
    ]


def remainder(doc_id: str | Column, n: int = 4) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % n


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether labels of this row must not be learned from; false for a null id."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def training(doc_id: str | Column = "doc_id") -> Column:
    return remainder(doc_id) != 2


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that no later plan reads."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def bitmap(rows: DataFrame, slot: Column, bits: int) -> np.ndarray:
    """A bitmap of 2^bits with the slots of all rows set; its size does not depend on the rows."""
    one = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = (
        rows.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(one).alias("set"))
        .toArrow()
    )
    found = np.zeros(1 << (bits - 6), np.int64)
    found[words["word"].to_numpy()] = words["set"].to_numpy()
    return found.view(np.uint64)


def has(found: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slots = slots.astype(np.uint64)
    return (found[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) != 0


def ranked(rows: DataFrame, group: list[str], part: str, order: list[Column], name: str) -> DataFrame:
    """Adds the place (from 0) of each row in its group by (part, order), a part at a time."""
    counts = rows.groupBy(*group, part).agg(F.count("*").alias("rows_here"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, part, F.coalesce(F.sum("rows_here").over(before), F.lit(0)).alias("before"))
    here = F.row_number().over(Window.partitionBy(*group, part).orderBy(*order))
    # dealt by part, or a join before this would leave all rows of a group in one task
    placed = rows.repartition(*group, part).withColumn("here", here)
    return placed.join(offsets, [*group, part]).withColumn(name, F.col("before") + F.col("here") - 1).drop("before", "here")
