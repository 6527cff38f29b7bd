"""Evaluation of scores against 0/1 labels: exact, and without gathering the scores.

Rows are first reduced to distinct scores with counts. Curves are running sums over
those, so their cost and memory per task do not depend on how many scores there are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.operators.running import running
from lendloom.operators.selection import exact_quantiles


def confusion(df: DataFrame, score: str, label: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp, precision, recall, accuracy; predicted is score > threshold."""
    predicted, actual = F.col(score) > threshold, F.col(label) == 1
    cells = df.groupBy(*by).agg(
        F.count_if(~predicted & ~actual).alias("tn"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(predicted & actual).alias("tp"),
    )
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cells.withColumns(
        {
            "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
            "accuracy": F.try_divide(F.col("tp") + F.col("tn"), total),
        }
    )


def _rated(df: DataFrame, score: str, label: str) -> DataFrame:
    """Rows with a label and a score; NaN is no score."""
    return df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, score, pos, neg): one row per distinct score."""
    rows = _rated(df, score, label)
    return rows.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.sum(1 - F.col(label).cast("bigint")).alias("neg")
    )


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = (), **limits) -> DataFrame:
    """(by, pos, neg, auc): ties count one half. NULL when one class is missing."""
    counts = score_counts(df, score, label, by)
    ranked = running(counts, by, "score", {"neg_upto": ("sum", "neg")}, bound=df, **limits)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    wins = F.sum((F.col("pos").cast("decimal(18,0)") * (2 * F.col("neg_upto") - F.col("neg")).cast("decimal(19,0)")).cast("decimal(38,0)"))
    sums = ranked.groupBy(*by).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), wins.alias("_wins"))
    pairs = 2.0 * F.col("pos").cast("double") * F.col("neg").cast("double")
    return sums.select(*by, "pos", "neg", F.try_divide(wide("_wins").cast("double"), pairs).alias("auc"))


def _curve(df: DataFrame, score: str, label: str, by: Sequence[str], limits: Mapping) -> DataFrame:
    """One row per distinct score with its own counts, the counts from the top, and the totals."""
    counts = score_counts(df, score, label, by).withColumn("_falling", -F.col("score"))
    points = running(counts, by, "_falling", {"tp": ("sum", "pos"), "fp": ("sum", "neg")}, bound=df, **limits)
    rows = _rated(df, score, label)
    actual = F.col(label).cast("bigint")
    sums = [F.sum(actual).alias("all_pos"), F.sum(1 - actual).alias("all_neg")]
    if by:
        return points.join(rows.groupBy(*by).agg(*sums), list(by))
    totals = rows.agg(*sums).select(F.struct("all_pos", "all_neg")).scalar()
    return points.withColumn("_totals", totals).select("*", "_totals.*").drop("_totals")


def roc_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = (), **limits) -> DataFrame:
    """(by, threshold, tp, fp, tpr, fpr): one point per distinct score, counting scores at or above it."""
    return _curve(df, score, label, by, limits).select(
        *by,
        F.col("score").alias("threshold"),
        "tp",
        "fp",
        F.try_divide(F.col("tp"), F.col("all_pos")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("all_neg")).alias("fpr"),
    )


def no_skill(df: DataFrame, label: str) -> DataFrame:
    """AUC of a constant score."""
    return roc_auc(df.withColumn("_constant", F.lit(0.0)), "_constant", label)


def threshold_accuracy(df: DataFrame, score: str, label: str, **limits) -> DataFrame:
    """(threshold, accuracy) for every distinct score, predicted meaning score > threshold; best first."""
    right = (F.col("tp") - F.col("pos")) + (F.col("all_neg") - (F.col("fp") - F.col("neg")))
    accuracy = F.try_divide(right, F.col("all_pos") + F.col("all_neg"))
    points = _curve(df, score, label, (), limits).select(F.col("score").alias("threshold"), accuracy.alias("accuracy"))
    return points.orderBy(F.desc("accuracy"), "threshold")


def model_average(scored: Mapping[str, DataFrame], key: str, score: str) -> DataFrame:
    """(key, score): mean of the scores of several models, matched by key."""
    frames = [df.select(key, F.col(score).alias(name)) for name, df in scored.items()]
    joined = reduce(lambda left, right: left.join(right, key), frames)
    total = reduce(lambda a, b: a + b, [F.col(name) for name in scored])
    return joined.select(key, (total / len(frames)).alias(score))


# --- bins -------------------------------------------------------------------------


def quantile_edges(df: DataFrame, score: str, bins: int = 10, **limits) -> list[float]:
    """Distinct interpolated quantiles; ``bins + 1`` values at most reach the driver."""
    shares = {f"e{i}": i / bins for i in range(bins + 1)}
    row = exact_quantiles(df, [score], shares, **limits).first()
    return sorted({row[name] for name in shares}) if row else []


def bin_number(value: Column, edges: Sequence[float]) -> Column:
    """1-based number of the right-closed bin; the lowest edge belongs to bin 1. NULL outside."""
    chain = F.when(value < edges[0], F.lit(None).cast("int"))
    for number, edge in enumerate(edges[1:], start=1):
        chain = chain.when(value <= edge, F.lit(number))
    return chain


def quantile_bins(df: DataFrame, score: str, bins: int = 10, name: str = "bin", **limits) -> DataFrame:
    """Add the quantile bin of a score; equal edges merge."""
    return df.withColumn(name, bin_number(F.col(score), quantile_edges(df, score, bins, **limits)))


def rate_per_bin(df: DataFrame, bin_name: str, target: str) -> DataFrame:
    """(bin, volume, rate)."""
    return df.where(F.col(bin_name).isNotNull()).groupBy(bin_name).agg(
        F.count(target).alias("volume"), (F.sum(F.col(target).cast("bigint")) / F.count(target)).alias("rate")
    )


def width_bins(df: DataFrame, score: str, target: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, volume, rate) for equal-width bins; empty bins are listed with volume 0.

    The step is the rounded range over the number of bins (half to even), at least 1.
    Edges start at the floor of the minimum. Right-closed, the lowest edge is in bin 1.
    """
    row = df.agg(F.min(score).cast("double").alias("low"), F.max(score).cast("double").alias("high")).first()
    if row is None or row["low"] is None:
        raise ValueError(f"{score} holds no value")
    low, high = math.floor(row["low"]), math.ceil(row["high"])
    step = max(round((row["high"] - row["low"]) / bins), 1)
    count = -(-(high - low) // step) or 1
    number = F.greatest(F.ceil((F.col(score) - low) / step), F.lit(1)).cast("bigint")
    filled = (
        df.where(F.col(score).isNotNull())
        .groupBy(number.alias("bin"))
        .agg(F.count(target).alias("volume"), F.sum(F.col(target).cast("bigint")).alias("_bad"))
    )
    spine = df.sparkSession.range(1, count + 1).withColumnRenamed("id", "bin")
    return spine.join(filled, "bin", "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * step).cast("double").alias("low"),
        (F.lit(low) + F.col("bin") * step).cast("double").alias("high"),
        F.coalesce("volume", F.lit(0)).alias("volume"),
        F.try_divide(F.col("_bad"), F.col("volume")).alias("rate"),
    )


def above_cutoff(df: DataFrame, score: str, cutoff: float) -> DataFrame:
    return df.where(F.col(score) >= cutoff)


def feature_auc(df: DataFrame, features: Sequence[str], label: str, **limits) -> DataFrame:
    """(feature, auc) for all features in one pass, missing values as 0; best first."""
    values = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in features]
    long = df.select(label, *values).unpivot([label], list(features), "feature", "value")
    return roc_auc(long, "value", label, by=["feature"], **limits).select("feature", "auc").orderBy(F.desc("auc"), "feature")


def _long(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, value, label) with missing values as 0."""
    values = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in features]
    return df.where(F.col(label).isNotNull()).select(F.col(label).cast("bigint").alias("label"), *values).unpivot(["label"], list(features), "feature", "value")


def tree_chances(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, **limits) -> DataFrame:
    """(feature, chance, pos, neg): how many test rows the fully grown tree of one feature gives each chance.

    A tree of one feature that is split until nothing is left to split parts every two neighbouring train values whose
    labels differ, at the middle between them. So the chance of a test value is the bad rate of the train rows at the nearest train
    value, the lower one at the middle. All features are grown together: train and test values meet as counts per distinct value, and two
    running passes over ranges carry the train value below and above to every test value. A feature with many values covers many ranges.
    """
    counted = lambda df, side: _long(df, features, label).groupBy("feature", "value").agg(
        F.sum("label").alias(f"{side}_pos"), F.sum(1 - F.col("label")).alias(f"{side}_neg"))
    learnt, held = counted(train, "a"), counted(test, "b")
    both = learnt.join(held, ["feature", "value"], "full").withColumns({"_down": -F.col("value"), "at": F.when(F.col("a_pos").isNotNull(), F.struct("value", (F.col("a_pos") / (F.col("a_pos") + F.col("a_neg"))).alias("rate")))})
    upward = running(both, ["feature"], "value", {"below": ("max", "at")}, **limits)
    placed = running(upward, ["feature"], "_down", {"above": ("min", "at")}, **limits).where("b_pos IS NOT NULL")
    value, below, above = F.col("value"), F.col("below"), F.col("above")
    nearer = F.when(below.isNull(), above["rate"]).when(above.isNull(), below["rate"]).when(value <= (below["value"] + above["value"]) / 2, below["rate"]).otherwise(above["rate"])
    return placed.groupBy("feature", nearer.alias("chance")).agg(F.sum("b_pos").alias("pos"), F.sum("b_neg").alias("neg"))


def feature_tree_auc(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, at_least: float = 0.5, **limits) -> DataFrame:
    """(feature, auc, kept), best first: the AUC on test rows of the tree grown from each feature on train rows.

    Unlike a rank AUC it does not depend on the direction: a feature that falls with the label is kept as one that rises.
    Features without a train value or with one class of test rows have no AUC and are not kept.
    """
    counts = tree_chances(train, test, features, label, **limits).where("chance IS NOT NULL")
    ranked = running(counts, ["feature"], "chance", {"neg_upto": ("sum", "neg")}, **limits)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    wins = F.sum((F.col("pos").cast("decimal(18,0)") * (2 * F.col("neg_upto") - F.col("neg")).cast("decimal(19,0)")).cast("decimal(38,0)"))
    sums = ranked.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), wins.alias("_wins"))
    auc = F.try_divide(wide("_wins").cast("double"), 2.0 * F.col("pos").cast("double") * F.col("neg").cast("double"))
    return sums.select("feature", auc.alias("auc")).withColumn("kept", F.coalesce(F.col("auc") > at_least, F.lit(False))).orderBy(F.desc("auc"), "feature")
