"""Registering queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablewright.sources.readers import extract

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str) -> Callable[[Run], Run]:
    """Register a function under ``name`` with the SQL that gives the same rows."""

    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return extract(spark, table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"
