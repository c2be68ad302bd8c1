"""Queries: the same tables taken in as streams, with state that outlives a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_path
from ..streaming import incremental as I
from .fixtures import Tables
from .inputs import patterns
from .q_search import HIT_COLUMNS
from .registry import query

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


BATCHES, FAN = 4, 2


def add_batch(t: Tables, folder: str, number: int) -> None:
    """A range of the event ids as new files, written in parallel; events without an id come first."""
    low, high = t.events.agg(F.min("event_id"), F.max("event_id")).first()
    if low is None:
        low = high = 0
    step = (high - low) // BATCHES + 1
    own = F.col("event_id").between(low + number * step, low + (number + 1) * step - 1)
    t.events.filter(own | F.col("event_id").isNull() if number == 0 else own).write.mode("append").parquet(folder)


def hit_stream(t: Tables, folder: str) -> DataFrame:
    events = I.read_new_files(t.spark, folder, t.events.schema)
    return events.select(
        F.lit(0).alias("query_ord"),
        F.col("event_id").alias("hit_ord"),
        F.concat(F.lit("repo"), F.col("user_id").cast("string")).alias("repository"),
        F.col("event_type").alias("path"),
        "value",
    )


HIT_SCHEMA = "query_ord int, hit_ord bigint, repository string, path string, value double"


def _first_hits(t: Tables, batches: list[list[int]]) -> DataFrame:
    """Runs one after the other, each on what is new since the one before; a run takes its files as one batch."""
    state, checkpoint, files = (stage_path(t.spark, n) for n in ("first_hits", "progress", "event_files"))
    for numbers in batches:
        for number in numbers:
            add_batch(t, files, number)
        I.first_hits(hit_stream(t, files), state, checkpoint)
    found = t.spark.read.schema(f"{HIT_SCHEMA}, batch int").parquet(state)
    return found.drop("batch")


FIRST_HIT_SQL = f"""SELECT {HIT_COLUMNS} FROM hits
    QUALIFY row_number() OVER (PARTITION BY repository ORDER BY query_ord, hit_ord) = 1"""


@query("inc1_resumed_run", FIRST_HIT_SQL)
def _(t: Tables) -> DataFrame:
    return _first_hits(t, [[0], [1, 2], [], [3]])


@query("inc2_first_hits", FIRST_HIT_SQL)
def _(t: Tables) -> DataFrame:
    return _first_hits(t, [[0, 1], [2, 3]])


@query("inc2_streamed_repositories", "SELECT DISTINCT repository FROM hits")
def _(t: Tables) -> DataFrame:
    out, checkpoint, files = (stage_path(t.spark, n) for n in ("repositories", "progress", "event_files"))
    for number in range(BATCHES):
        add_batch(t, files, number)
    stream = I.any_hit_per_repository(hit_stream(t, files)).select("repository")
    with I.keyed_state(t.spark):
        run = (
            stream.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    return t.spark.read.schema("repository string").parquet(out)


@query(
    "inc3_untried_queries",
    """SELECT DISTINCT github_query FROM query_rows WHERE github_query NOT IN
       (SELECT github_query FROM query_rows WHERE cwe_id = 'CWE-79')""",
)
def _(t: Tables) -> DataFrame:
    tried = I.tried_after(patterns(t).filter("cwe_id = 'CWE-79'"))
    return I.untried(patterns(t).select("github_query").distinct(), tried)


@query(
    "inc4_latest_results",
    f"""SELECT {HIT_COLUMNS} FROM hits
        QUALIFY row_number() OVER (PARTITION BY repository, path ORDER BY hit_ord DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    state, checkpoint, files = (stage_path(t.spark, n) for n in ("latest", "progress", "event_files"))
    for number in range(BATCHES):
        add_batch(t, files, number)
        I.latest_results(hit_stream(t, files), state, checkpoint, fan=FAN)
    return I.read_latest(t.spark, state, HIT_SCHEMA)
