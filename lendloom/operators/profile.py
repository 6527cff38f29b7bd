"""Column profiles, exact quantiles, contingency tables and tests, column selection.

Every profile looks at all columns in one pass: the frame is unpivoted to
(feature, label) and counted, so work grows with the rows and not with passes.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.operators.selection import quantiles_of

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def null_ratios(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, null_ratio), one aggregation over all columns. NaN counts as missing."""
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ratios = [F.avg(_missing(F.col(c), kinds[c]).cast("int")).alias(c) for c in columns]
    return df.agg(*ratios).unpivot([], columns, "feature", "null_ratio")


def _missing(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def label_counts(df: DataFrame, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """(feature, label, n[, bad]) for all columns in one pass; NULL is a label of its own here."""
    kept = [target] if target else []
    values = df.select(*kept, *[F.col(c).cast("string").alias(c) for c in columns if c != target])
    long = values.unpivot(kept, [c for c in columns if c != target], "feature", "label")
    bad = [F.sum(F.col(target).cast("bigint")).alias("bad")] if target else []
    return long.groupBy("feature", "label").agg(F.count("*").alias("n"), *bad)


def value_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, distinct_labels, top_label, max_share, has_null): largest share over all rows, smallest label on a tie."""
    counts = label_counts(df, columns)
    best = F.min_by(F.col("label"), F.when(F.col("label").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("label"))))
    top = F.max(F.when(F.col("label").isNotNull(), F.col("n")))
    return counts.groupBy("feature").agg(
        F.count("label").alias("distinct_labels"),
        best.alias("top_label"),
        (top / F.sum("n")).alias("max_share"),
        F.max(F.col("label").isNull().cast("int")).alias("has_null"),
        F.sum("n").alias("row_count"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str], **limits) -> DataFrame:
    """count, mean, std, min, quartiles, max per column: moments and sketch from one aggregate, quartiles by selection."""
    quartiles, extents = quantiles_of(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, **limits)
    moments = df.sparkSession.createDataFrame(
        [(name, e.mean, e.std, e.low, e.high) for name, e in extents.items()], "feature string, mean double, std double, min double, max double")
    return quartiles.join(F.broadcast(moments), "feature").select("feature", "n", "mean", "std", "min", "q25", "q50", "q75", "max")  # one row per column


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top, freq per text column."""
    shares = value_shares(df, columns)
    null_rows = label_counts(df, columns).where("label IS NULL").select("feature", F.col("n").alias("missing"))
    joined = shares.join(F.broadcast(null_rows), "feature", "left")  # at most one row per column
    return joined.select(
        "feature",
        (F.col("row_count") - F.coalesce("missing", F.lit(0))).alias("n"),
        F.col("distinct_labels").alias("unique_labels"),
        F.col("top_label").alias("top"),
        F.round(F.col("max_share") * F.col("row_count")).cast("bigint").alias("freq"),
    )


def labels_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, label) of every distinct value."""
    return label_counts(df, columns).select("feature", "label")


def label_rates(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, label, n, share, bad_rate): share over all rows."""
    total = df.agg(F.count("*").alias("total")).scalar()
    counts = label_counts(df, columns, target).where(F.col("label").isNotNull())
    return counts.select("feature", "label", "n", (F.col("n") / total).alias("share"), (F.col("bad") / F.col("n")).alias("bad_rate"))


def mode_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return value_shares(df, columns).select("feature", F.col("top_label").alias("mode"))


def contingency(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, label, good, bad, total) with an 'All' row per feature."""
    counts = label_counts(df, columns, target).where(F.col("label").isNotNull())
    good = (F.sum("n") - F.sum("bad")).alias("good")
    grouped = counts.rollup("feature", "label").agg(good, F.sum("bad").alias("bad"), F.sum("n").alias("total"), F.grouping("label").alias("_all"))
    return grouped.where(F.col("feature").isNotNull()).select(
        "feature", F.when(F.col("_all") == 1, "All").otherwise(F.col("label")).alias("label"), "good", "bad", "total"
    )


def chi_square(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, statistic, dof, possibly_useful) from one pass of counts.

    At one degree of freedom the difference is reduced by up to one half.
    ``possibly_useful``: the second label has more bads than goods.
    """
    counts = label_counts(df, columns, target).where(F.col("label").isNotNull()).withColumn("good", F.col("n") - F.col("bad"))
    totals = counts.groupBy("feature").agg(
        F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"), F.count("*").alias("labels"), F.min("label").alias("first_label")
    )
    cells = counts.join(F.broadcast(totals), "feature")  # one row per column of the frame
    dof = F.when((F.col("all_bad") > 0) & (F.col("all_bad") < F.col("all_n")), F.col("labels") - 1).otherwise(F.lit(0))
    expected_bad = F.col("n") * F.col("all_bad") / F.col("all_n")
    expected_good = F.col("n") - expected_bad

    def part(observed: Column, expected: Column) -> Column:
        gap = F.abs(observed - expected)
        gap = F.when(dof == 1, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
        return F.try_divide(gap * gap, expected)

    second = F.struct("label", (F.col("bad") > F.col("good")).alias("more_bad"))
    return (
        cells.groupBy("feature")
        .agg(
            F.sum(part(F.col("bad"), expected_bad) + part(F.col("good"), expected_good)).alias("statistic"),
            F.max(dof).alias("dof"),
            F.min(F.when(F.col("label") > F.col("first_label"), second)).alias("_second"),
        )
        .select("feature", F.coalesce("statistic", F.lit(0.0)).alias("statistic"), "dof", F.coalesce(F.col("_second.more_bad"), F.lit(False)).cast("int").alias("possibly_useful"))
    )


GAMMA_TERMS = 2000


def log_gamma_half(dof: Column) -> Column:
    """ln of the gamma function at dof / 2: the sum of the logarithms down to 1 or one half."""
    rest = F.aggregate(F.sequence(F.lit(1), F.greatest(F.ceil(dof / 2) - 1, F.lit(1)).cast("int")), F.lit(0.0), lambda total, k: total + F.when(k < dof / 2, F.ln(F.greatest(dof / 2 - k, F.lit(0.5)))).otherwise(0.0))
    return F.when(dof % 2 == 1, rest + math.log(math.sqrt(math.pi))).otherwise(rest)


def chi_square_tail(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution: the regularised upper incomplete gamma function at (dof / 2, statistic / 2).

    Below dof + 2 the power series of the lower function, above it the continued fraction of the upper one from its end, as the
    respective one converges. 1 without a degree of freedom or at 0.
    """
    a, x = dof.cast("double") / 2, statistic.cast("double") / 2
    front = F.exp(a * F.ln(F.greatest(x, F.lit(1e-300))) - x - log_gamma_half(dof))
    # Terms needed for double precision grow with the square root of what the functions are taken at.
    terms = F.least(F.lit(GAMMA_TERMS), (40 + 12 * F.sqrt(F.greatest(a, F.lit(1.0)))).cast("int"))
    step = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def grow(state: Column, k: Column) -> Column:
        term = state["t"] * x / (a + k)
        return F.struct(term.alias("t"), (state["s"] + term).alias("s"))

    low = front / F.greatest(a, F.lit(0.5)) * F.aggregate(F.sequence(F.lit(1), terms * 2), step, grow)["s"]
    down = F.aggregate(F.sequence(terms * 2, F.lit(1), F.lit(-1)), F.lit(0.0), lambda tail, k: k * (a - k) / (x + 2 * k + 1 - a + tail))
    high = front / (x + 1 - a + down)
    tail = F.when(x < a + 1, 1 - low).otherwise(high)
    return F.when((dof < 1) | (statistic <= 0), F.lit(1.0)).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))


def chi_square_selection(df: DataFrame, columns: Sequence[str], target: str, level: float = 0.05) -> DataFrame:
    """(feature, statistic, dof, p_value, possibly_useful, selected): selected at a p-value up to ``level``."""
    found = chi_square(df, columns, target).withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("dof")))
    return found.select("feature", "statistic", "dof", "p_value", "possibly_useful", (F.col("p_value") <= level).alias("selected"))


def significant_features(df: DataFrame, columns: Sequence[str], target: str, level: float = 0.05) -> list[str]:
    """Features whose test is significant; one result row per column reaches the driver."""
    return sorted(r["feature"] for r in chi_square_selection(df, columns, target, level).where("selected").collect())


HEAVY_COLUMNS_AT_ONCE = 20


def heavy_labels(df: DataFrame, columns: Sequence[str], min_share: float, target: str | None = None) -> DataFrame:
    """(feature, label, n[, bad], rows): every label with at least ``min_share`` of all rows, counted exactly; NULL is no label.

    A frequent-items sketch per column names the candidates: with 20 / share counters its error is below a fifth of the share, so
    no label that qualifies is missed. A second aggregate counts the candidates. Other values, ids and long texts among them,
    become one group in the map-side part and are never shuffled.
    """
    columns = [c for c in columns if c != target]
    counters, most = 1 << math.ceil(math.log2(20 / min_share)), math.ceil(2 / min_share) + 1  # one more for NULL
    candidates: dict[str, list[str]] = {}
    for at in range(0, len(columns), HEAVY_COLUMNS_AT_ONCE):
        some = columns[at:at + HEAVY_COLUMNS_AT_ONCE]
        text = [F.col(c).cast("string") for c in some]
        top = [F.call_function("approx_top_k", t, F.lit(most), F.lit(counters)).alias(f"c{i}") for i, t in enumerate(text)]
        row = df.agg(*top).first()  # at most 2 / share labels a column
        candidates |= {c: [item["item"] for item in row[f"c{i}"] or [] if item["item"] is not None] for i, c in enumerate(some)}
    kept = [target] if target else []
    chosen = [F.when(F.col(c).cast("string").isin(candidates[c]), F.col(c).cast("string")).alias(c) if candidates[c] else F.lit(None).cast("string").alias(c) for c in columns]
    long = df.select(*kept, *chosen).unpivot(kept, columns, "feature", "label")
    bad = [F.sum(F.col(target).cast("bigint")).alias("bad")] if target else []
    counts = long.groupBy("feature", "label").agg(F.count(F.lit(1)).alias("n"), *bad)
    sizes = [F.sum("n").alias("rows"), *([F.sum("bad").alias("all_bad")] if target else [])]
    totals = counts.groupBy("feature").agg(*sizes)  # one row per column
    return counts.where("label IS NOT NULL").join(F.broadcast(totals), "feature").where(F.col("n") >= min_share * F.col("rows"))


def minority_bad_rate(df: DataFrame, columns: Sequence[str], target: str, min_share: float = 0.9) -> DataFrame:
    """For near-constant columns: log of bad rate outside the top label over bad rate of the top label.

    0 when nothing outside the top label is bad. NULL values count as outside.
    """
    heavy = heavy_labels(df, columns, min_share, target)
    first = F.row_number().over(W.partitionBy("feature").orderBy(F.desc("n"), "label"))  # at most 1 / share rows a column
    top = heavy.withColumn("_rank", first).where("_rank = 1")
    rest_n, rest_bad = F.col("rows") - F.col("n"), F.col("all_bad") - F.col("bad")
    quotient = F.try_divide(F.try_divide(rest_bad, rest_n), F.try_divide(F.col("bad"), F.col("n")))
    return top.select("feature", (F.col("n") / F.col("rows")).alias("max_share"), F.when(rest_bad == 0, F.lit(0.0)).when(rest_n > 0, F.ln(quotient)).alias("log_ratio"))


# --- column selection: results are lists of names, one row per column reaches the driver


def _extent(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Per column: rows, values that are not NULL, whether they are all one, and about how many there are.

    One aggregate with a map-side part; no value is shuffled, so ids and long texts cost no more than a scan.
    """
    parts = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(columns):
        c = F.col(name)
        parts += [F.count(c).alias(f"n{i}"), F.min(c).eqNullSafe(F.max(c)).alias(f"one{i}"), F.approx_count_distinct(c).alias(f"d{i}")]
    row = df.agg(*parts).first()
    return {name: {"rows": row["_rows"], "n": row[f"n{i}"], "one": row[f"one{i}"], "about": row[f"d{i}"]} for i, name in enumerate(columns)}


def droppable_columns(df: DataFrame, max_null: float = 0.4) -> list[str]:
    """Columns with one value (NULL is a value) or too many NULLs."""
    extent = _extent(df, df.columns)
    constant = {c for c, e in extent.items() if e["one"] and e["n"] in (0, e["rows"])}
    return [c for c in df.columns if c in constant or extent[c]["rows"] - extent[c]["n"] > max_null * extent[c]["rows"]]


def drop_sparse(df: DataFrame, max_null: float = 0.4) -> DataFrame:
    return df.drop(*droppable_columns(df, max_null))


def split_columns(df: DataFrame, target: str, min_distinct: int = 10) -> tuple[list[str], list[str], list[str]]:
    """(categorical, numerical, constant). A constant has one value and no NULL; numerical needs ten distinct values."""
    extent = _extent(df, [c for c in df.columns if c != target])
    numbers = set(numeric_columns(df))
    # Only numbers with few values are counted exactly; the estimate is off by far less than half.
    near = [c for c in extent if c in numbers and extent[c]["about"] < 2 * min_distinct]
    exact = {r["feature"]: r["distinct_labels"] for r in value_shares(df, near).collect()} if near else {}
    categorical, numerical, constant = [], [], []
    for name, found in extent.items():
        if found["n"] == 0 or (found["one"] and found["n"] == found["rows"]):
            constant.append(name)
        elif name in numbers and exact.get(name, min_distinct) >= min_distinct:
            numerical.append(name)
        else:
            categorical.append(name)
    return categorical, numerical, constant


def near_constant_columns(df: DataFrame, columns: Sequence[str], min_share: float = 0.9) -> list[str]:
    rows = heavy_labels(df, columns, min_share).groupBy("feature").agg(F.max(F.col("n") / F.col("rows")).alias("max_share")).collect()
    return [r["feature"] for r in sorted(rows, key=lambda r: (-r["max_share"], r["feature"]))]


def common_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames reduced to the columns they share, in the order of the left."""
    shared = [c for c in left.columns if c in right.columns]
    return left.select(*shared), right.select(*shared)


def training_columns(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in excluded]
