"""Exact ranks by selection: a sketch brackets each wanted rank, then only values inside the brackets are kept and counted.

One aggregate over the frame gives, for every column, its size, extremes, moments and a mergeable quantile sketch whose rank
error is bounded. A wanted rank lies between the sketch's values a few errors below and above it: its bracket. A second pass
maps a value to its bracket, or to the gap below one, where only the number of rows matters; that is an aggregate with a
map-side part that keeps a few ten-thousandths of the values. If that is still too much for one task, the kept values are
split at two hundred of their own, rows between the splits are counted, and only the intervals that hold a wanted rank stay.
The ranks are exact, no value outside a bracket is ever shuffled, and nothing sorts all values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendloom.session import checkpointed

ACCURACY = 10_000
#: A bracket reaches so many rank errors to either side: one for the wanted rank, one for the bracket's own value.
MARGIN = 2.5
KEPT_ROWS = 1_000_000
SPLITS = 200
COLUMNS_AT_ONCE = 40


@dataclass
class Extent:
    """What one aggregate tells about a column."""

    n: int
    low: float | None
    high: float | None
    mean: float | None
    std: float | None
    brackets: list[tuple[float, float]] = field(default_factory=list)


def number(name: str) -> Column:
    """The column as a double; NaN is no value."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def measure(df: DataFrame, columns: Sequence[str], shares: Sequence[float], margin: float = MARGIN) -> dict[str, Extent]:
    """Size, extremes, moments and brackets of all columns; one row reaches the driver per ``COLUMNS_AT_ONCE`` columns."""
    reach = margin / ACCURACY
    inner = [s for s in shares if 0 < s < 1]
    asked = sorted({min(1.0, max(0.0, s + d)) for s in inner for d in (-reach, reach)})
    out = {}
    for at in range(0, len(columns), COLUMNS_AT_ONCE):
        some, parts = columns[at:at + COLUMNS_AT_ONCE], []
        for i, name in enumerate(some):
            v = number(name)
            parts += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"low{i}"), F.max(v).alias(f"high{i}"), F.avg(v).alias(f"mean{i}"), F.stddev(v).alias(f"std{i}")]
            if asked:
                parts.append(F.percentile_approx(v, asked, ACCURACY).alias(f"q{i}"))
        row = df.agg(*parts).first()
        for i, name in enumerate(some):
            extent = Extent(*(row[f"{k}{i}"] for k in ("n", "low", "high", "mean", "std")))
            if extent.n:
                extent.brackets = _merged([_bracket(s, extent, reach, dict(zip(asked, row[f"q{i}"])) if asked else {}) for s in shares])
            out[name] = extent
    return out


def _bracket(share: float, extent: Extent, reach: float, sketch: Mapping[float, float]) -> tuple[float, float]:
    if share <= 0 or share >= 1:
        edge = extent.low if share <= 0 else extent.high
        return edge, edge
    if extent.n <= 2 * ACCURACY:  # then two ranks next to each other may be further apart than the reach
        return extent.low, extent.high
    low, high = sketch[min(1.0, max(0.0, share - reach))], sketch[min(1.0, max(0.0, share + reach))]
    return extent.low if share <= reach else low, extent.high if share >= 1 - reach else high


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _kept(df: DataFrame, extents: Mapping[str, Extent]) -> DataFrame:
    """(feature, place, value, n): place 2k + 1 is bracket k with its values, 2k the gap below it without."""
    entries = []
    for name, extent in extents.items():
        value, place = number(name), F.lit(None).cast("int")
        for k in reversed(range(len(extent.brackets))):
            low, high = (F.lit(float(x)) for x in extent.brackets[k])
            place = F.when(value < low, F.lit(2 * k)).when(value <= high, F.lit(2 * k + 1)).otherwise(place)
        entries.append(F.struct(F.lit(name).alias("feature"), place.alias("place"), value.alias("value")))
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("place IS NOT NULL")
    inside = F.when(F.col("place") % 2 == 1, F.col("value"))
    return long.groupBy("feature", "place", inside.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _narrowed(kept: DataFrame, extents: Mapping[str, Extent], shares: Sequence[float], kept_rows: int) -> DataFrame:
    """Kept values of columns that have more than ``kept_rows`` of them, cut down to the intervals with a wanted rank."""
    while True:
        kept = checkpointed(kept)
        counted = kept.groupBy("feature").agg(F.count("value").alias("rows")).collect()  # one row per column
        large = [r["feature"] for r in counted if r["rows"] > kept_rows + 2 * len(shares)]
        if not large:
            return kept
        few = SPLITS
        wide = kept.where(F.col("feature").isin(large))
        splits = {
            r["feature"]: sorted(set(r["s"]))
            for r in wide.groupBy("feature").agg(F.percentile_approx("value", [k / few for k in range(few + 1)], ACCURACY).alias("s")).collect()
        }
        # Places of an interval: the number of splits at or below its values and, twice, of those strictly below.
        cuts = F.lit(None).cast("array<double>")
        for name, values in splits.items():
            cuts = F.when(F.col("feature") == name, F.array(*map(F.lit, values))).otherwise(cuts)
        spot = F.size(F.filter(F.col("_cuts"), lambda x: x < F.col("value"))) + F.size(F.filter(F.col("_cuts"), lambda x: x <= F.col("value")))
        placed = wide.withColumn("_cuts", cuts).withColumn("_spot", F.when(F.col("value").isNotNull(), spot)).drop("_cuts")
        sums = placed.groupBy("feature", "place", "_spot").agg(F.sum("n").alias("n")).collect()  # at most 2 * SPLITS + 1 per bracket
        wanted: dict[str, list[tuple[int, int | None]]] = {}
        for name in large:
            last, before = extents[name].n - 1, 0
            goals = {r for s in shares for r in (math.floor(s * last), math.ceil(s * last))}
            for r in sorted((r for r in sums if r["feature"] == name), key=lambda r: (r["place"], r["_spot"] or 0)):
                if r["_spot"] is not None and any(before <= g < before + r["n"] for g in goals):
                    wanted.setdefault(name, []).append((r["place"], r["_spot"]))
                before += r["n"]
        # Intervals with a wanted rank become the brackets, everything between two of them one gap; what lies above is done with.
        at, spot = F.col("place"), F.coalesce("_spot", F.lit(-1))
        finer = F.lit(None).cast("int")
        for name, own in wanted.items():
            chain = F.lit(None).cast("int")
            for k in reversed(range(len(own))):
                p, q = own[k]
                chain = F.when((at < p) | ((at == p) & (spot < q)), F.lit(2 * k)).when((at == p) & (spot == q), F.lit(2 * k + 1)).otherwise(chain)
            finer = F.when(F.col("feature") == name, chain).otherwise(finer)
        tight = placed.withColumn("place", finer).where(F.col("place").isNotNull())
        shrunk = tight.groupBy("feature", "place", F.when(F.col("place") % 2 == 1, F.col("value")).alias("value")).agg(F.sum("n").alias("n"))
        kept = kept.where(~F.col("feature").isin(large)).unionByName(shrunk)


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Mapping[str, float], *, rows_per_task: int = KEPT_ROWS) -> DataFrame:
    """(feature, n, one column per named share): exact quantiles with linear interpolation; columns without a value give no row."""
    return quantiles_of(df, columns, shares, rows_per_task=rows_per_task)[0]


def quantiles_of(df: DataFrame, columns: Sequence[str], shares: Mapping[str, float], *, rows_per_task: int = KEPT_ROWS, margin: float = MARGIN) -> tuple[DataFrame, dict[str, Extent]]:
    """The quantiles, and what was measured of each column on the way."""
    wanted = list(shares.values())
    extents = {name: e for name, e in measure(df, columns, wanted, margin).items() if e.n}
    spark = df.sparkSession
    fields = "feature string, n long" + "".join(f", {name} double" for name in shares)
    if not extents:
        return spark.createDataFrame([], fields), extents
    kept = _narrowed(_kept(df, extents), extents, wanted, rows_per_task)
    # At most ``rows_per_task`` rows a column.
    upto = F.sum("n").over(W.partitionBy("feature").orderBy("place", "value"))
    placed = kept.withColumn("upto", upto)

    def at(name: str, rank: int) -> Column:
        return F.max(F.when((F.col("feature") == name) & (F.col("upto") - F.col("n") <= rank) & (F.col("upto") > rank), F.col("value")))

    picks = {(name, rank): None for name, e in extents.items() for s in wanted for rank in (math.floor(s * (e.n - 1)), math.ceil(s * (e.n - 1)))}
    names = list(picks)
    found = placed.agg(*(at(name, rank).alias(f"p{k}") for k, (name, rank) in enumerate(names))).first()
    values = {key: found[f"p{k}"] for k, key in enumerate(names)}
    if any(v is None for v in values.values()):  # the sketch was further off than it says
        return quantiles_of(df, columns, shares, rows_per_task=rows_per_task, margin=4 * margin)
    rows = []
    for name, e in extents.items():
        out = []
        for share in wanted:
            spot = share * (e.n - 1)
            low, high = values[name, math.floor(spot)], values[name, math.ceil(spot)]
            out.append(low + (high - low) * (spot - math.floor(spot)))
        rows.append((name, e.n, *out))
    return spark.createDataFrame(rows, fields), extents
