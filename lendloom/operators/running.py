"""Running values per key that do not depend on the size of a key.

Rows are dealt once, in ranges of (keys, order), and that exchange is kept. Ranges smaller
than a task are cut inside it, so their number does not add tasks. A range is summarised per key, the summaries are accumulated along the ranges of a key, and a window
inside (key, range) adds what the key carries in. A large key simply covers many ranges,
whatever values it holds, so every size takes the same plan. The order column must be
free of NULLs and unique per key: aggregate ties first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendloom.session import checkpointed

ROWS_PER_TASK = 2_000_000

# kind -> value over the frame; "previous" and "count" are handled on their own.
FRAME_FUNCTIONS = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def ranges(df: DataFrame, keys: Sequence[str], order: str, bound: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt into ranges of about ``rows_per_task`` rows, numbered in ``_range``; kept, since ranges are drawn by sampling.

    There are as many tasks as shuffle partitions, and more only when those would get over ``ROWS_PER_TASK`` rows: a task sends its
    sample and its statistics to the driver. Smaller ranges are runs of exactly ``rows_per_task`` sorted rows inside a task.
    """
    at_least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = None if bound is None else bound.count()
    needed = at_least if rows is None else -(-rows // rows_per_task)
    tasks = needed if rows is None else min(needed, max(at_least, -(-rows // ROWS_PER_TASK)))
    dealt = df.repartitionByRange(max(tasks, 1), *keys, order)
    if tasks == needed:
        return checkpointed(dealt.withColumn("_range", F.spark_partition_id().cast("long")))
    # the number of a row is its task's, then its place there
    number = F.monotonically_increasing_id()
    place = number.bitwiseAND(F.lit((1 << 33) - 1))
    return checkpointed(dealt.sortWithinPartitions(*keys, order).withColumn("_range", number - place % rows_per_task))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    specs: Mapping[str, tuple[str, str | None]],
    *,
    bound: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add one column per spec: ``name -> (kind, column)``.

    Kinds ``count``, ``sum``, ``min`` and ``max`` include the current row;
    ``previous`` is the value of the row before (NULL for the first row of a key).
    ``bound`` is a frame that is cheap to count and has at least as many rows as ``df``,
    such as the table that ``df`` was aggregated from; without it there are as many
    ranges as shuffle partitions.
    """
    keys = list(keys)
    rows = ranges(df, keys, order, bound, rows_per_task)
    summaries = []
    for name, (kind, column) in specs.items():
        value = F.col(column) if column else F.lit(1)
        summary = F.max_by(value, F.col(order)) if kind == "previous" else FRAME_FUNCTIONS[kind](value)
        summaries.append(summary.alias(f"_{name}"))
    per_range = rows.groupBy(*keys, "_range").agg(*summaries)

    # one row per range that a key covers
    by_key = W.partitionBy(*keys).orderBy("_range")
    before = by_key.rowsBetween(W.unboundedPreceding, -1)
    carried = []
    for name, (kind, _) in specs.items():
        carry = F.col(f"_{name}")
        if kind == "previous":
            carried.append(F.lag(carry).over(by_key).alias(f"_{name}"))
        else:
            merge = F.sum if kind == "count" else FRAME_FUNCTIONS[kind]
            carried.append(merge(carry).over(before).alias(f"_{name}"))
    carry = per_range.select(*keys, "_range", *carried)

    inside = W.partitionBy(*keys, "_range").orderBy(order)
    columns = []
    for name, (kind, column) in specs.items():
        local, carry_in = _local(kind, column, inside), F.col(f"_{name}")
        if kind == "previous":
            value = F.when(F.row_number().over(inside) == 1, carry_in).otherwise(local)
        elif kind == "count":
            value = local + F.coalesce(carry_in, F.lit(0))
        elif kind == "sum":
            value = F.coalesce(local + carry_in, local, carry_in)
        else:
            value = (F.least if kind == "min" else F.greatest)(local, carry_in)
        columns.append(value.alias(name))
    return rows.join(carry, [*keys, "_range"], "left").select(*df.columns, *columns)


def _local(kind: str, column: str | None, window) -> Column:
    if kind == "previous":
        return F.lag(column).over(window)
    frame = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    return FRAME_FUNCTIONS[kind](F.col(column) if column else F.lit(1)).over(frame)
