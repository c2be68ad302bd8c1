"""Incremental search results: each run takes the files that are new and goes on from there.

What was seen is keyed state in Spark's state store, kept by RocksDB: a batch reads and writes the keys that it holds and no
others, so its cost does not follow the size of the state. The latest results are a versioned table, see ``sources.versioned``. A batch that
is run again after a failure writes its part over, or finds its commit done.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.search import search_texts
from ..sources.versioned import FAN, ResultTable

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB: on disk, by key, beyond the executors' memory."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def read_new_files(
    spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", files_per_batch: int | None = None
):
    """Stream of the Parquet files that appear in a folder."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.parquet(folder)


def _part(folder: str, batch: int) -> str:
    return f"{folder}/batch={batch:09d}"


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []


def run_available(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, state: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Run all data that is there now through ``on_batch``, then stop.

    State without the checkpoint that made it would be overwritten from batch 0 on, so that is refused.
    """
    spark = stream.sparkSession
    if state and _listed(spark, state) and "metadata" not in _listed(spark, checkpoint):
        raise ValueError(f"{state} holds state, but {checkpoint} is not the checkpoint of its stream")
    with keyed_state(spark):
        query = (
            stream.writeStream.foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint)
            .outputMode(mode)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return query


def new_keys(stream: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Rows of keys that no batch before has had, the first of each by ``order_by``; for update mode.

    The state of a key is its least row and the times of its first and last batch. A batch updates the keys that it holds; one of
    them is new if both times are the same. Rows are reduced before they are shuffled, so a hot key sends one row per task.
    """
    first = F.struct(*order_by, *[c for c in stream.columns if c not in order_by])
    seen = stream.withColumn("_at", F.current_timestamp()).groupBy(F.col(key).alias("_key")).agg(
        F.min(first).alias("_first"), F.min("_at").alias("_from"), F.max("_at").alias("_to"))
    return seen.filter("_from = _to").select(*[F.col("_first").getField(c).alias(c) for c in stream.columns])


def first_hits(
    stream: DataFrame, state: str, checkpoint: str, order_by: Sequence[str] = ("query_ord", "hit_ord")
) -> StreamingQuery:
    """The first hit per repository over all batches, in arrival order of the batches; one part of ``state`` per batch."""

    def on_batch(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(_part(state, batch))

    return run_available(new_keys(stream, "repository", order_by), on_batch, checkpoint, state, "update")


def any_hit_per_repository(stream: DataFrame) -> DataFrame:
    """One hit per repository, whichever comes first; the state store holds the keys."""
    return stream.dropDuplicates(["repository"])


def untried(queries: DataFrame, tried: DataFrame, keywords: Sequence[str] = ()) -> DataFrame:
    """Queries whose first search text, with these keywords, no earlier run has sent."""
    first = search_texts(queries, keywords).filter("level = 0").select("github_query", "tried_query")
    new = first.join(tried.select("tried_query").distinct(), "tried_query", "left_anti")
    return queries.join(new.select("github_query").distinct(), "github_query", "left_semi").select(*queries.columns)


def tried_after(sent: DataFrame) -> DataFrame:
    """State for the next run: the texts that an adaptive run has sent, or plain query texts."""
    text = "tried_query" if "tried_query" in sent.columns else "github_query"
    return sent.select(F.col(text).alias("tried_query")).distinct()


def latest_results(
    stream: DataFrame,
    state: str,
    checkpoint: str,
    keys: Sequence[str] = ("repository", "path"),
    order_by: Sequence[str] = ("hit_ord",),
    fan: int = FAN,
) -> StreamingQuery:
    """The last result per key: each batch is a commit to a versioned table, whose runs are merged by levels."""
    table = ResultTable(stream.sparkSession, state, stream.schema, keys, order_by, fan)
    return run_available(stream, lambda df, batch: table.commit(df, f"batch-{batch:09d}"), checkpoint, state)


def read_latest(
    spark: SparkSession, state: str, schema: str, keys: Sequence[str] = ("repository", "path"), order_by: Sequence[str] = ("hit_ord",)
) -> DataFrame:
    """Current version of ``latest_results``: rows of later batches win."""
    return ResultTable(spark, state, schema, keys, order_by).read()
