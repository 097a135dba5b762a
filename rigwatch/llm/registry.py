"""Queries of this subpackage: name -> (spark, table folder) -> DataFrame, with SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query, with the SQL that gives the same rows where there is one."""
    def register(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, whole."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
