"""Proportional stratified interleaving: shards of equal counts that all match the source mixture.

Rows of a source are shuffled by a seeded digest and ranked; row r of n gets the fractional rank
(r + 0.5) / n. All rows are then ordered by that fraction, so any contiguous cut holds every source
in proportion, and shard i takes the positions from i * N / shards on.

No rank needs a whole source in one task. Digests and fractions both spread evenly, so ranges of
them hold about ``per_range`` rows each; a rank is the count of the ranges before, from a small
table of counts, plus the row's place in its own range. Texts are reduced to a size and a checksum first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import MOST_RANGES, ranked

def interleaved_shards(
    docs: DataFrame, shards: int = 24, seed: int = 42, per_range: int = 2000,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, source.

    The law is ``rows``: shard counts differ by one at most; slots count from 0 in each shard. size
    is the text's UTF-8 bytes plus 8, null text counting as empty. A null source is a source of its
    own. Rows that repeat an id are ordered by size and checksum; rows equal in these too are alike in
    the result, whichever comes first. Other columns are not read. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("bigint") + 8).alias("size"), F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias("source"), digest.alias("digest"),
    )
    # the mixture: rows of each source
    mixture = rows.groupBy("source").agg(F.count("*").alias("n"))
    total = mixture.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    ranges = F.greatest(F.lit(1), F.least(F.lit(MOST_RANGES), F.ceil(F.col("total") / per_range))).cast("bigint")
    sized = mixture.join(F.broadcast(total.withColumn("ranges", ranges)))  # one row
    spread = F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint")
    parts = rows.join(sized, "source").withColumn("part", F.floor(spread * F.col("ranges") / F.lit(1 << 32)))
    first = ranked(parts, ["source"], "part", [F.col("digest"), F.col("doc_id"), F.col("size"), F.col("text_crc32")], "r")

    fraction = (2 * F.col("r") + 1) / (2 * F.col("n"))
    second = first.withColumn("fraction", fraction).withColumn("cut", F.floor(F.col("fraction") * F.col("ranges"))).withColumn("all", F.lit(0))
    tied = [F.col("fraction"), F.md5(F.col("source").cast("binary")), F.col("source")]
    placed = ranked(second.drop("part", "digest"), ["all"], "cut", tied, "place")
    shard = F.expr(f"cast(place * {shards} div total as int)")
    begin = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.col("place") - begin)
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), F.when(F.col("source") != "", F.expr("substring(source, 2)")).alias("source"),
        )
    )
