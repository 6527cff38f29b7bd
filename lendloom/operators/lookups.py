"""One row per key out of many: first, last, conditional, and before-another lookups.

All of them are aggregates (``min_by`` / ``max_by``) with a map-side part, so a key
that owns many rows is reduced before the shuffle. Where the source takes "any" row,
the smallest id is taken. A lookup with no match gives no row: join it with ``left``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.operators.skew import enrich


def pick(values: Mapping[str, Column], order: Column, last: bool = False, where: Column | None = None) -> Column:
    """Struct of values from the row with the lowest (or highest) order among those that qualify.

    An order value is never NULL for a qualifying row. Filter conditions that are not
    true turn the order to NULL, which the aggregate leaves out.
    """
    packed = F.struct(*[value.alias(name) for name, value in values.items()])
    key = order if where is None else F.when(where, order)
    return (F.max_by if last else F.min_by)(packed, key)


def lookups(df: DataFrame, key: str, picks: Mapping[str, Column], counts: Mapping[str, Column] | None = None) -> DataFrame:
    """All lookups of one table in one aggregation; each pick becomes a struct column."""
    aggregates = [column.alias(name) for name, column in {**picks, **(counts or {})}.items()]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggregates)


def first_by(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Row with the lowest order value per key."""
    return _one(df, key, order, columns, last=False)


def last_by(df: DataFrame, key: str, order: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Row with the highest order value per key. Several order columns give a total order."""
    return _one(df, key, order, columns, last=True)


def _one(df: DataFrame, key: str, order, columns: Sequence[str], last: bool) -> DataFrame:
    order_column = F.col(order) if isinstance(order, str) else F.struct(*order)
    row = pick({name: F.col(name) for name in columns}, order_column, last)
    return lookups(df, key, {"row": row}).select(key, "row.*")


def keep_last(df: DataFrame, key: str, order: str, tie: str) -> DataFrame:
    """Whole rows: the last one per key by ``order`` (NULLs count as last), ties by ``tie``."""
    rank = F.struct(F.col(order).isNull(), F.col(order), F.col(tie))
    rest = [name for name in df.columns if name != key]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("row"))
    return picked.select(*[F.col(key) if name == key else F.col(f"row.{name}") for name in df.columns])


def last_before_first(
    df: DataFrame, key: str, order: str, first_where: Column, last_where: Column, columns: Sequence[str], **skew
) -> DataFrame:
    """First qualifying row per key, and the last row of another kind before it.

    Gives ``first`` and ``before`` structs of ``columns``; ``before`` is NULL when nothing precedes.
    """
    values = {name: F.col(name) for name in (order, *columns)}
    firsts = lookups(df, key, {"first": pick(values, F.col(order), where=first_where)}).where("first IS NOT NULL")
    limit = firsts.select(key, F.col(f"first.{order}").alias("_limit"))
    candidates = enrich(df.where(last_where & F.col(key).isNotNull()).select(key, order, *columns), limit, key, "inner", **skew)
    before = lookups(
        candidates.where(F.col(order) < F.col("_limit")), key, {"before": pick(values, F.col(order), last=True)}
    )
    return firsts.join(before, key, "left")
