"""Registered queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL when there is one."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shape(df: DataFrame, **kinds: str) -> DataFrame:
    """Select and cast the output columns.

    A kind is a Spark type, ``rN`` for a double rounded to N places, ``day`` or
    ``second`` for a date or time as text.
    """
    columns = []
    for name, kind in kinds.items():
        column = F.col(name)
        if kind == "day":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind == "second":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("r") and kind[1:].isdigit():
            column = F.round(column.cast("double"), int(kind[1:]))
        else:
            column = column.cast(kind)
        columns.append(column.alias(name))
    return df.select(*columns)
