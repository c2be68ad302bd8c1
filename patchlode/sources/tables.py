"""Scans: database tables, Parquet tables, CSV files, code trees, search responses."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import FIX_TABLES, SEARCH_RESPONSE

DATABASE_SETTINGS = (
    "POSTGRES_USER",
    "POSTGRES_PASSWORD",
    "DB_HOST",
    "POSTGRES_PORT",
    "POSTGRES_DB",
)
# Column whose hash spreads a table over parallel reads.
SPLIT_COLUMNS = {
    "fixes": "hash",
    "commits": "hash",
    "file_change": "file_change_id",
    "method_change": "file_change_id",
    "cve": "cve_id",
    "cwe_classification": "cve_id",
    "cve_cpe_mapper": "cve_id",
    "cve_project": "cve",
    "cpe_project": "cpe_name",
    "repository": "repo_url",
    "cwe": "cwe_id",
}


def database_options(settings: Mapping[str, str] | None = None) -> dict[str, str]:
    """JDBC options from the five connection settings (environment by default)."""
    settings = os.environ if settings is None else settings
    missing = [name for name in DATABASE_SETTINGS if not settings.get(name)]
    if missing:
        raise ValueError(f"missing database settings: {', '.join(missing)}")
    user, password, host, port, name = (settings[key] for key in DATABASE_SETTINGS)
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{name}",
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
        "fetchsize": "10000",
    }


# Split columns that hold hexadecimal digests, so that ranges of them are even.
DIGEST_TABLES = ("file_change", "method_change", "commits")


def split_predicates(table: str, parts: int, bounds: Sequence[str] | None = None) -> list[str]:
    """Predicates that cut a table into disjoint reads; together they cover it all.

    The large tables are cut into ranges of their digest column, which an index serves: no reader scans the whole
    table. ``bounds`` (ascending, ``parts`` is then ignored) gives ranges for any table; without it the
    others, which are small, are cut by a hash of the column. NULL goes to part 0.
    """
    column = SPLIT_COLUMNS[table]
    if bounds is None and table in DIGEST_TABLES:
        bounds = [f"{(part << 32) // parts:08x}" for part in range(1, parts)]
    if bounds is None:
        hashed = f"MOD(ABS(HASHTEXT(COALESCE({column}, ''))::BIGINT), {parts})"
        return [f"{hashed} = {part}" for part in range(parts)]
    quoted = ["'" + b.replace("'", "''") + "'" for b in bounds]
    if not quoted:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:])]
    return [f"({column} < {quoted[0]} OR {column} IS NULL)", *between, f"{column} >= {quoted[-1]}"]


def read_database_table(
    spark: SparkSession,
    table: str,
    settings: Mapping[str, str] | None = None,
    parts: int = 64,
    bounds: Sequence[str] | None = None,
) -> DataFrame:
    """A fix table over JDBC, read in parallel."""
    options = database_options(settings)
    url = options.pop("url")
    return spark.read.jdbc(url, table, predicates=split_predicates(table, parts, bounds), properties=options)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A fix table stored as Parquet, with its declared schema."""
    return spark.read.schema(FIX_TABLES[table]).parquet(f"{folder}/{table}")


def run_query(
    spark: SparkSession, text: str, args: Mapping[str, object] | None = None, **views: DataFrame
) -> DataFrame:
    """SQL with named parameters (``:name``) over the given tables, which the text names ``{table}``.

    Views of the session are neither used nor replaced.
    """
    return spark.sql(text, args=dict(args or {}), **views)


def read_csv(
    spark: SparkSession, path: str, schema: str, required: Sequence[str] = ()
) -> DataFrame:
    """CSV with header, quoted line breaks and doubled quotes.

    An empty field is NULL, a quoted empty field is ''.
    """
    df = spark.read.schema(schema).csv(
        path, header=True, multiLine=True, escape='"', enforceSchema=False, nullValue="\\N"
    )
    absent = [name for name in required if name not in df.columns]
    if absent:
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}")
    return df


def read_queries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV of queries; it must have the column ``github_query``."""
    header = spark.read.csv(path, header=True, multiLine=True, escape='"').columns
    if "github_query" not in header:
        raise ValueError(f"{path} lacks the column github_query")
    return read_csv(spark, path, schema, ["github_query"])


def read_code_tree(spark: SparkSession, path: str, extension: str) -> DataFrame:
    """Files ``*.<extension>`` below a folder, one row each; bytes that are no UTF-8 are dropped."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{extension}")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    text = F.replace(
        F.make_valid_utf8(F.col("content").cast("string")), F.lit("\ufffd"), F.lit("")
    )
    return files.select("path", text.alias("content"))


def flatten_hits(responses: DataFrame, column: str = "response") -> DataFrame:
    """One row per item of a search response; missing fields are ''."""
    parsed = responses.select(
        *[c for c in responses.columns if c != column],
        F.explode(F.from_json(column, SEARCH_RESPONSE)["items"]).alias("item"),
    )

    def text(field: str) -> Column:
        return F.coalesce(F.col(f"item.{field}"), F.lit(""))

    return parsed.select(
        *[c for c in responses.columns if c != column],
        text("repository.full_name").alias("repository"),
        text("repository.html_url").alias("repository_url"),
        text("path").alias("path"),
        text("url").alias("url"),
        text("html_url").alias("html_url"),
        text("sha").alias("sha"),
    )
