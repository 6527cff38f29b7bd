"""Split, fills, rare labels and target rates: fitted on train rows, kept as state tables.

A state table has one row per (feature, label) and is bounded by construction: fills
have one row per column, a frequent label needs more than 1 % of the rows (at most 99
per column), and target rates are fitted after rare labels are merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.functions.text import label_text, lookup_literal
from lendloom.operators.profile import label_counts, label_rates, value_shares
from lendloom.operators.selection import exact_quantiles
from lendloom.operators.skew import broadcast_if_small
from lendloom.session import checkpointed, written

def held(state: DataFrame) -> DataFrame:
    """A fitted state, kept in the shared folder, so that using it does not fit it again."""
    return checkpointed(state)


def as_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as label text, one form for numbers of any type."""
    return df.withColumns({c: label_text(F.col(c)) for c in columns}) if columns else df


def bucket_of(*keys: Column | str) -> Column:
    """0-9 from the key text: stable under any partitioning, and the same in other engines."""
    texts = [F.col(k).cast("string") if isinstance(k, str) else k for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 6), 16, 10).cast("bigint") % 10


def split(df: DataFrame, key: str, test_tenths: int = 3) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key."""
    bucket = bucket_of(key)
    return df.where(bucket >= test_tenths), df.where(bucket < test_tenths)


def split_written(df: DataFrame, key: str, name: str, test_tenths: int = 3) -> tuple[DataFrame, DataFrame]:
    """``split`` of rows that are worked out and hashed once: a fit reads them many times, and they may be more than a cache holds."""
    rows = written(df.withColumn("_test", (bucket_of(key) < test_tenths).cast("int")), name, "_test")
    return rows.where("_test = 0").drop("_test"), rows.where("_test = 1").drop("_test")


# --- missing values ---------------------------------------------------------------


def count_table(train: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, label, n, bad) of every column, kept: fills, rare labels and rates are all moves between its rows.

    Labels of numbers have one text form and NaN is NULL, as where the states are applied.
    """
    doubles = {f for f, kind in train.dtypes if kind in ("double", "float")}
    clean = train.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in columns if c in doubles}) if doubles & set(columns) else train
    return held(label_counts(as_labels(clean, columns), columns, target))


def moved(counts: DataFrame, label: Column) -> DataFrame:
    """The counts with every label replaced, rows of the same label added up."""
    return counts.withColumn("label", label).groupBy("feature", "label").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def text_fills(counts: DataFrame, max_null: float = 0.05, numbers: Sequence[str] = ()) -> DataFrame:
    """(feature, kind, value): 'Missing' where more than ``max_null`` of the rows have no label, else the mode."""
    best = F.min_by(F.col("label"), F.when(F.col("label").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("label"))))
    null_share = F.sum(F.when(F.col("label").isNull(), F.col("n")).otherwise(0)) / F.sum("n")
    found = counts.groupBy("feature").agg(F.when(null_share > max_null, "Missing").otherwise(best).alias("value"), null_share.alias("_share"))
    number = F.col("feature").isin(list(numbers)) & (F.col("_share") <= max_null)
    return found.select("feature", F.when(number, "number").otherwise("text").alias("kind"), "value")


def fill_counts(counts: DataFrame, fills: DataFrame) -> DataFrame:
    """What the counts are after the fills: the rows without a label join those of the fill."""
    joined = counts.join(F.broadcast(fills.select("feature", "value")), "feature", "left")  # one row per column
    return moved(joined, F.coalesce("label", "value"))


def fit_missing(train: DataFrame, text: Sequence[str], numeric: Sequence[str], max_null: float = 0.05, **limits) -> DataFrame:
    """(feature, kind, value): 'Missing' or the mode for text, the median for numbers."""
    parts = []
    if text:
        parts.append(text_fills(label_counts(train, text), max_null))
    if numeric:
        medians = exact_quantiles(train, numeric, {"median": 0.5}, **limits)
        parts.append(medians.select("feature", F.lit("number").alias("kind"), F.col("median").cast("string").alias("value")))
    state = parts[0]
    return state.unionByName(parts[1]) if len(parts) > 1 else state


def constant_fills(spark, fills: Mapping[str, object]) -> DataFrame:
    """State rows for values that are fixed rather than fitted."""
    rows = [(name, "text" if isinstance(value, str) else "number", str(value)) for name, value in fills.items()]
    return spark.createDataFrame(rows, "feature string, kind string, value string")


def apply_missing(df: DataFrame, state: DataFrame) -> DataFrame:
    """Fill NULL and NaN; one state row per column reaches the driver."""
    fills: dict[str, object] = {}
    for row in state.collect():
        if row["feature"] in df.columns and row["value"] is not None:
            fills[row["feature"]] = row["value"] if row["kind"] == "text" else float(row["value"])
    doubles = {name for name, kind in df.dtypes if kind in ("double", "float")}
    changed = {}
    for name, value in fills.items():
        column = F.col(name)
        if name in doubles:
            column = F.nanvl(column, F.lit(None).cast("double"))
        elif isinstance(value, float):
            column = column.cast("double")
        changed[name] = F.coalesce(column, F.lit(value))
    return df.withColumns(changed) if changed else df


# --- rare labels ------------------------------------------------------------------


def fit_rare(train: DataFrame, columns: Sequence[str], min_share: float = 0.01) -> DataFrame:
    """(feature, label, replacement): one row per frequent label.

    Columns with three to five values send the others to their mode, the rest to 'rare'.
    'rare' becomes a frequent label itself when the merged rows exceed the share, as a
    second fitting round would find.
    """
    return rare_labels(label_counts(as_labels(train, columns), columns), min_share)


def rare_labels(counts: DataFrame, min_share: float = 0.01) -> DataFrame:
    """``fit_rare`` from a table of counts."""
    per_feature = counts.groupBy("feature").agg(
        F.sum("n").alias("size"),
        F.count("*").alias("values"),
        F.min_by(F.col("label"), F.when(F.col("label").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("label")))).alias("mode"),
    )
    kind = F.when(F.col("values").between(3, 5), F.col("mode")).otherwise("rare")
    placed = counts.join(F.broadcast(per_feature), "feature").withColumn("replacement", kind)  # one row per column
    often = F.col("label").isNotNull() & (F.col("n") / F.col("size") > min_share)
    frequent = placed.where(often).select("feature", "label", "replacement")
    merged = (
        placed.where(~often & ~F.col("values").between(3, 5))
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.max("size").alias("size"))
        .where(F.col("n") / F.col("size") > min_share)
        .select("feature", F.lit("rare").alias("label"), F.lit("rare").alias("replacement"))
    )
    # distinct labels only: 'rare' may be a label of the data as well
    found = frequent.unionByName(merged).dropDuplicates(["feature", "label"])
    bare = placed.groupBy("feature").agg(F.first("replacement").alias("replacement"))
    return bare.select("feature", F.lit(None).cast("string").alias("label"), "replacement").unionByName(found)


def merge_counts(counts: DataFrame, rare: DataFrame) -> DataFrame:
    """What the counts are after rare labels are merged."""
    bare = rare.where("label IS NULL").select("feature", "replacement")  # one row per column
    often = rare.where("label IS NOT NULL").select("feature", "label", F.lit(True).alias("_often"))  # at most 100 rows a column
    joined = counts.join(F.broadcast(bare), "feature", "left").join(F.broadcast(often), ["feature", "label"], "left")
    return moved(joined, F.when(F.col("_often"), F.col("label")).otherwise(F.coalesce("replacement", "label")))


def apply_rare(df: DataFrame, state: DataFrame) -> DataFrame:
    """Keep frequent labels, replace the others and NULL. Labels are compared as text."""
    frequent: dict[str, list[str]] = {}
    replacement: dict[str, str] = {}
    for row in state.collect():  # at most 100 labels per column
        labels = frequent.setdefault(row["feature"], [])
        replacement[row["feature"]] = row["replacement"]
        if row["label"] is not None:
            labels.append(row["label"])
    changed = {}
    for name, labels in frequent.items():
        if name in df.columns:
            text = label_text(F.col(name))
            changed[name] = F.when(text.isin(labels), text).otherwise(F.lit(replacement[name]))
    return df.withColumns(changed) if changed else df


def scarce_binary(df: DataFrame, columns: Sequence[str], max_share: float = 0.2) -> list[str]:
    """Columns with at most two labels of which one is scarce."""
    return scarce_in(label_counts(df, columns), max_share)


def scarce_in(counts: DataFrame, max_share: float = 0.2, rare: DataFrame | None = None) -> list[str]:
    """``scarce_binary`` from a table of counts; with rare labels, only of the columns whose others become 'rare'.

    One row per column reaches the driver.
    """
    if rare is not None:
        tested = rare.where("label IS NULL AND replacement = 'rare'").select("feature")  # one row per column
        counts = counts.join(F.broadcast(tested), "feature", "left_semi")
    rows = counts.groupBy("feature").agg(F.count("*").alias("labels"), F.min("n").alias("least"), F.sum("n").alias("all")).where("labels <= 2").collect()
    return sorted(r["feature"] for r in rows if r["least"] / r["all"] < max_share)


# --- target rates -----------------------------------------------------------------


def fit_target(train: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(feature, label, rate): mean target per label, no smoothing."""
    return label_rates(as_labels(train, columns), columns, target).select("feature", "label", F.col("bad_rate").alias("rate"))


LITERAL_LABELS = 400


def apply_target(df: DataFrame, state: DataFrame, default: float | None = None) -> DataFrame:
    """Replace labels by their rate; unseen labels give ``default``.

    A state of merged labels has at most 100 rows a column: such columns are encoded by literal maps in one projection. A
    column with more than ``LITERAL_LABELS`` labels meets its rates by the skew-safe join, since the mode owns most rows.
    """
    sizes = {r["feature"]: r["n"] for r in state.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect() if r["feature"] in df.columns}  # one row per column
    small = [f for f, n in sizes.items() if n <= LITERAL_LABELS]
    rates: dict[str, dict] = {f: {} for f in small}
    for row in state.where(F.col("feature").isin(small)).collect() if small else []:
        if row["label"] is not None:
            rates[row["feature"]][row["label"]] = row["rate"]
    missing = F.lit(default).cast("double")
    if small:
        df = df.withColumns({f: F.coalesce(lookup_literal(label_text(F.col(f)), own).cast("double"), missing) for f, own in rates.items()})
    for name in [f for f in sizes if f not in rates]:
        part = state.where(F.col("feature") == name).select(F.col("label").alias("_label"), F.col("rate").alias("_rate"))
        labelled = df.withColumn("_label", label_text(F.col(name)))
        joined = labelled.join(broadcast_if_small(part), "_label", "left")
        df = joined.withColumn(name, F.coalesce("_rate", missing)).select(*df.columns)
    return df


def encode_binary(df: DataFrame, columns: Sequence[str], labels: Mapping[str, int]) -> DataFrame:
    """Fixed label -> number map on the two-valued columns only; other values are read as numbers."""
    changed = {}
    for name in columns:
        text = F.col(name).cast("string")
        changed[name] = F.coalesce(lookup_literal(text, dict(labels)).cast("double"), text.try_cast("double"))
    return df.withColumns(changed) if changed else df


def more_than_two(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(columns with more than two values, columns with exactly two)."""
    rows = {r["feature"]: r["distinct_labels"] + r["has_null"] for r in value_shares(df, columns).collect()}
    return [c for c in columns if rows[c] > 2], [c for c in columns if rows[c] == 2]
