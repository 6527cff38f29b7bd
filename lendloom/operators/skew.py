"""Joins and broadcasts that hold when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.session import checkpointed

ROWS_PER_TASK = 2_000_000
NULL_SALTS = 1 << 16
BROADCAST_BYTES = 64 << 20


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, bound: DataFrame | None = None) -> DataFrame | None:
    """(key, _salts): keys with more rows than one task should get, and over how many tasks to deal them. None if there are none.

    There are at most rows / rows_per_task of them. ``bound`` is a frame that is cheap to
    count and has at least as many rows as any key of ``df``.
    """
    if (df if bound is None else bound).count() <= rows_per_task:
        return None
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > rows_per_task)
    hot = checkpointed(counts.select(key, F.ceil(F.col("count") / rows_per_task).cast("int").alias("_salts")))
    return None if hot.isEmpty() else hot


UNKNOWN = "unknown"


def _salts(df: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Add ``_salts``: over how many tasks the rows of the key are dealt."""
    if hot is None:
        return df.withColumn("_salts", F.lit(1))
    # bounded: one row per hot key; it may have been counted on a table that names the key otherwise
    return df.join(F.broadcast(hot.toDF(key, "_salts")), key, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))


def salt_columns(df: DataFrame, key: str, most: int = 2) -> list[str]:
    """Columns whose hash tells the rows of a key apart at little cost: ids and other whole numbers before times, and those before the rest.

    Only these are read and hashed for the salt, so columns that nothing else needs stay out of the scan.
    """
    def rank(kind: str) -> int:
        return 0 if kind in ("bigint", "int") else 1 if kind.startswith(("timestamp", "date", "decimal", "double", "float")) else 2 if kind == "string" else 3

    others = [(rank(kind), place, name) for place, (name, kind) in enumerate(df.dtypes) if name != key]
    usable = sorted(o for o in others if o[0] < 3)
    return [name for order, _, name in usable if order == usable[0][0]][:most]


def dealt(df: DataFrame, key: str, hot: DataFrame | None, name: str) -> DataFrame:
    """Number the rows of a hot key by a hash, and so those without a key, which match nothing but must not pile up.

    Rows of other keys are 0 and nothing is hashed for them.
    """
    number = F.xxhash64(*salt_columns(df, key), F.spark_partition_id())
    salts = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.col("_salts"))
    spread_ = F.when(F.col(key).isNull() | (F.col("_salts") > 1), F.pmod(number, salts).cast("int")).otherwise(F.lit(0))
    return _salts(df, key, hot).withColumn(name, spread_).drop("_salts")


def repeated(df: DataFrame, key: str, hot: DataFrame | None, name: str) -> DataFrame:
    """Repeat the rows of a hot key for every number its partners may have.

    A literal 0 would be folded into the join condition, the number of the facts would no longer be a join key, and rows without a
    key would meet in one task; so it is 0 by an expression that is not folded.
    """
    if hot is None:
        return df.withColumn(name, F.least(F.spark_partition_id(), F.lit(0)))
    return _salts(df, key, hot).withColumn(name, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")


def enrich(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    *,
    hot: DataFrame | str | None = UNKNOWN,
    lookup_hot: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join facts with a lookup, spreading hot keys of the facts and facts without a key.

    Rows of a hot key are dealt over as many tasks as its size asks for, and only the
    lookup rows of hot keys are repeated. Finding hot keys reads the facts once more: give
    ``hot`` when the facts are the result of much work and the keys can be counted on the
    table they come from. ``lookup_hot`` does the same for a lookup with many rows per key.
    """
    if isinstance(hot, str):
        hot = hot_keys(facts, key, rows_per_task)
    if hot is None and lookup_hot is None and how != "left":
        return facts.join(lookup, key, how)
    left, right = dealt(facts, key, hot, "_salt"), repeated(lookup, key, hot, "_salt")
    if lookup_hot is None:
        return left.join(right, [key, "_salt"], how).drop("_salt")
    left, right = repeated(left, key, lookup_hot, "_other"), dealt(right, key, lookup_hot, "_other")
    if how != "inner":
        raise ValueError("a lookup with hot keys takes an inner join")
    return left.join(right, [key, "_salt", "_other"], how).drop("_salt", "_other")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows to all cores before expensive parsing when the input is read in fewer partitions than there are cores.

    A large input has partitions enough, and then nothing is added to the plan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sized(df: DataFrame, key: str, rows: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal rows by a join key over as many tasks as ``rows`` asks for, when one task should not get them all; keys repeat seldom.

    The number of shuffle partitions is fixed, so without this the rows that a task sorts grow with the table.
    """
    needed = -(-rows // rows_per_task)
    return df if needed <= 1 else df.repartition(max(needed, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), key)


def _bytes(df: DataFrame) -> Column:
    """Size of a row: 8 for a fixed-width value, the text's own bytes, the JSON form's for anything nested."""
    fixed, parts = 0, []
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)))
        elif kind.startswith(("array", "struct", "map")):
            parts.append(F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))))
        else:
            fixed += 16 if kind.startswith("decimal") else 8
    return sum((p.cast("long") for p in parts), F.lit(8 + fixed).cast("long"))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only after measuring the rows' bytes; a larger side is left to the optimizer's own join choice."""
    return F.broadcast(df) if (df.agg(F.sum(_bytes(df))).first()[0] or 0) <= max_bytes else df
