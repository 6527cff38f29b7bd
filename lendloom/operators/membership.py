"""Filters that ask whether a key exists elsewhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.operators.skew import broadcast_if_small


def between_dates(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    day = F.col(column).cast("date")
    return df.where(day.between(start, end))


def above_or_listed(df: DataFrame, key: str, threshold: int, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows with a key above the threshold, or in the list. The list is only probed, never multiplied."""
    marks = listed.where(F.col(listed_key).isNotNull()).select(F.col(listed_key).alias(key)).distinct().withColumn("_listed", F.lit(True))
    return df.join(marks, key, "left").where((F.col(key) > threshold) | F.col("_listed").isNotNull()).drop("_listed")


def in_list(df: DataFrame, key: str, ids: Sequence) -> DataFrame:
    """Rows whose key is in a literal id list."""
    return df.where(F.col(key).isin(list(ids)))


def in_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is in a list kept as a table of any length; repeated and NULL ids change nothing."""
    listed = ids.select(F.col(ids.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(broadcast_if_small(listed), key, "left_semi")


def exists(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_semi")


def not_exists(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_anti")


def quality_probe(df: DataFrame, column: str, markers: Sequence[str]) -> DataFrame:
    """Counts of texts that do not end an array, and that miss each marker."""
    probes = [F.count_if(~F.endswith(column, F.lit("]"))).alias("unterminated")]
    probes += [F.count_if(~F.contains(column, F.lit(marker))).alias(f"without_{marker}") for marker in markers]
    return df.where(F.col(column).isNotNull()).agg(*probes)
