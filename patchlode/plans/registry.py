"""Registered queries: one per operator, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import Tables, with_sql
from .oracle import ORACLE_SQL

Build = Callable[[Tables], DataFrame]
_QUERIES: dict[str, Build] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return add


def _load() -> None:
    from . import q_extract, q_incremental, q_mining, q_report, q_search  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(build: Build):
        return lambda spark, sf_dir: build(Tables(spark, sf_dir))

    return {name: bind(build) for name, build in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: with_sql(sql, ORACLE_SQL) for name, sql in _SQL.items()}


def joined(array: str, separator: str = ",") -> Column:
    return F.array_join(array, separator)
