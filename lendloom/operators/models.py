"""Learners on Spark ML, and the tables behind feature selection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.operators import boosting
from lendloom.operators.evaluate import roc_auc
from lendloom.operators.selection import quantiles_of
from lendloom.session import checkpointed, set_checkpoint_folder, written


def assembler(features: Sequence[str]) -> VectorAssembler:
    """Model input in a fixed order. A missing value is an error: fill first."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def _fit(learner, train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    set_checkpoint_folder(train.sparkSession)  # boosting cuts its lineage there
    data = train.select(*features, F.col(label).cast("double").alias(label))
    return Pipeline(stages=[assembler(features), learner]).fit(data)


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 3, seed: int = 0) -> PipelineModel:
    """Boosted trees with the defaults of the shipped model: 100 rounds, depth 3, rate 0.1."""
    learner = GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=seed, checkpointInterval=10)
    return _fit(learner, train, features, label)


def fit_tuned_boosting(train: DataFrame, features: Sequence[str], label: str, rounds: int = 3000, seed: int = 10) -> PipelineModel:
    """Gradient boosting with the tuned settings. The minimum split size has no counterpart in Spark ML.

    Spark ML fits one round, which also checks the rows and labels; the trees of all rounds are grown by ``boosting``.
    """
    data = written(train.select(*(F.col(c).cast("double").alias(c) for c in (*features, label))), "train")
    settings = boosting.Settings(width=len(features), rounds=rounds, depth=4, least=7, share=0.8, step=0.1, seed=seed)
    learner = GBTClassifier(
        labelCol=label, maxIter=1, maxDepth=settings.depth, stepSize=settings.step, subsamplingRate=settings.share, featureSubsetStrategy="sqrt",
        minInstancesPerNode=settings.least, seed=seed, checkpointInterval=10,
    )
    first_round = _fit(learner, data, features, label)
    edges = split_candidates(data, features, boosting.BINS)
    trees = boosting.boosted_trees(data, edges, settings)
    return boosting.with_trees(first_round, data.sparkSession, trees, edges, settings)


def split_candidates(train: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """The midpoints between the values of a feature with at most ``bins`` of them, else its exact quantiles at equal shares."""
    sizes = train.agg(*(F.approx_count_distinct(f).alias(f"n{i}") for i, f in enumerate(features))).first()
    few = [f for f, size in zip(features, sizes) if size <= 2 * bins]
    values = dict(zip(few, train.agg(*(F.sort_array(F.collect_set(f)).alias(f) for f in few)).first())) if few else {}
    edges = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in values.items() if len(v) <= bins}
    many = [f for f in features if f not in edges]
    edges |= bin_edges(train, many, bins) if many else {}
    return [edges[f] for f in features]


def fit_forest(train: DataFrame, features: Sequence[str], label: str, trees: int = 1000, depth: int = 4, seed: int = 39) -> PipelineModel:
    learner = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return _fit(learner, train, features, label)


def fit_logistic(train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """L2 penalty of weight 1 over the whole sample, features not scaled."""
    learner = LogisticRegression(labelCol=label, elasticNetParam=0.0, regParam=1.0 / max(train.count(), 1), standardization=False)
    return _fit(learner, train, features, label)


# --- adaptive boosting ------------------------------------------------------------


@dataclass
class AdaptiveBoosting:
    """Weighted vote of depth-1 trees."""

    features: list[str]
    trees: list[DecisionTreeClassificationModel]
    weights: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` and ``prediction`` like the other models."""
        scored = assembler(self.features).transform(df)
        vote = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            scored = tree.setPredictionCol("_vote").transform(scored)
            scored = scored.withColumn("_sum", vote + weight * (2 * F.col("_vote") - 1)).drop("_vote", "rawPrediction", "probability")
            vote = F.col("_sum")
        decision = F.col("_sum") / sum(self.weights)
        chance = 1 / (1 + F.exp(-decision))
        return (
            scored.withColumn("probability", array_to_vector(F.array(1 - chance, chance)))
            .withColumn("prediction", (decision > 0).cast("double"))
            .drop("_sum", "features")
        )


def fit_adaptive(
    train: DataFrame, features: Sequence[str], label: str, rounds: int = 50, seed: int = 0, cut_every: int = 10
) -> AdaptiveBoosting:
    """SAMME with stumps. Weights depend on all rounds before, so lineage is cut every ``cut_every`` rounds."""
    rows = assembler(features).transform(train.select(*features, F.col(label).cast("double").alias(label)))
    rows = rows.select("features", label, F.lit(1.0).alias("weight")).persist()
    model = AdaptiveBoosting(list(features), [], [])
    for number in range(rounds):
        stump = DecisionTreeClassifier(labelCol=label, weightCol="weight", maxDepth=1, seed=seed + number, predictionCol="_vote")
        tree = stump.fit(rows)
        voted = tree.transform(rows)
        sums = voted.agg(F.sum("weight").alias("all"), F.sum(F.when(F.col("_vote") != F.col(label), F.col("weight")).otherwise(0.0)).alias("wrong")).first()
        error = sums["wrong"] / sums["all"]
        if error >= 0.5:
            break
        weight = math.log((1 - error) / max(error, 1e-12))
        model.trees.append(tree)
        model.weights.append(weight)
        if error == 0:
            break
        grown = F.col("weight") * F.when(F.col("_vote") != F.col(label), math.exp(weight)).otherwise(1.0) / float(sums["all"])
        earlier, rows = rows, voted.select("features", label, grown.alias("weight"))
        rows = checkpointed(rows) if (number + 1) % cut_every == 0 else rows.persist()
        rows.count()  # fill the cache before the one it is built from goes
        earlier.unpersist()
    rows.unpersist()
    if not model.trees:
        raise ValueError("no stump is better than chance")
    return model


# --- real-valued adaptive boosting --------------------------------------------------

CHANCE_FLOOR = 1e-7


@dataclass(frozen=True)
class Stump:
    """One split: the log odds of the weighted rows at or below the threshold, and of those above it."""

    feature: str
    threshold: float
    below: float
    above: float


@dataclass
class RealAdaptiveBoosting:
    """Mean log odds of all stumps; scoring is one projection."""

    features: list[str]
    stumps: list[Stump]

    def decision(self) -> Column:
        votes = [F.when(F.col(s.feature).cast("double") <= s.threshold, s.below).otherwise(s.above) for s in self.stumps]
        # Added up in pairs, so that the expression is no deeper than the logarithm of the rounds.
        while len(votes) > 1:
            votes = [votes[i] + votes[i + 1] if i + 1 < len(votes) else votes[i] for i in range(0, len(votes), 2)]
        return votes[0] / len(self.stumps)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` and ``prediction`` like the other models."""
        chance = 1 / (1 + F.exp(-self.decision()))
        scored = df.withColumn("_chance", chance)
        probability = array_to_vector(F.array(1 - F.col("_chance"), F.col("_chance")))
        return scored.withColumn("probability", probability).withColumn("prediction", (F.col("_chance") > 0.5).cast("double")).drop("_chance")


def bin_edges(train: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Split candidates per feature: its distinct exact quantiles at equal shares below the largest value; the same however rows are dealt."""
    found, extents = quantiles_of(train, list(features), {f"q{k}": k / bins for k in range(1, bins)})
    rows = {r["feature"]: sorted(set(r[2:])) for r in found.collect()}
    return {f: [v for v in rows.get(f, []) if v < extents[f].high] for f in features}


def fit_real_adaptive(train: DataFrame, features: Sequence[str], label: str, rounds: int = 50, bins: int = 64, cut_every: int | None = None) -> RealAdaptiveBoosting:
    """Adaptive boosting whose stumps vote with half the log odds of their weighted rows, at full weight each.

    A stump sees a row only through the bins of its features, so rows with the same bins and label are one row with a number from
    the start. A round is one aggregate of weights by (feature, bin); the driver gets at most features * bins rows of it and picks
    the split with the least Gini impurity, the first feature and lowest threshold in a tie. A margin is one number per feature
    and bin, added up: whatever the round, it is a lookup per feature, and the kept rows are only read, so there is no lineage to
    cut and ``cut_every`` changes nothing. It ends early when no split is left that tells the labels apart.
    """
    features, edges = list(features), bin_edges(train, features, bins)
    usable = [f for f in features if edges[f]]
    if not usable:
        raise ValueError("no feature has two values")

    def spot_of(name: str) -> Column:
        """How many edges lie below the value: at most k if and only if the value is at most edge k."""
        return F.size(F.filter(F.array(*map(F.lit, edges[name])), lambda edge: edge < F.col(name).cast("double")))

    spots = [spot_of(f).alias(f"b{i}") for i, f in enumerate(usable)]
    binned = train.where(F.col(label).isNotNull()).select(*spots, F.col(label).cast("int").alias("y"))
    rows = written(binned.groupBy(*(f"b{i}" for i in range(len(usable))), "y").agg(F.count(F.lit(1)).alias("n")), "binned")
    margins = [np.zeros(len(edges[f]) + 1) for f in usable]
    stumps: list[Stump] = []
    for _ in range(rounds):
        margin = sum((F.lit(table.tolist())[F.col(f"b{i}")] for i, table in enumerate(margins)), F.lit(0.0))
        weight = F.col("n") * F.exp(-0.5 * (2 * F.col("y") - 1) * margin)
        long = rows.select("y", weight.alias("w"), F.posexplode(F.array(*(F.col(f"b{i}") for i in range(len(usable)))))).toDF("y", "w", "feature", "bin")
        sums = long.groupBy("feature", "bin").agg(F.sum(F.when(F.col("y") == 1, F.col("w")).otherwise(0.0)).alias("bad"), F.sum(F.when(F.col("y") == 1, 0.0).otherwise(F.col("w"))).alias("good"))
        best = _best_split(sums.collect(), [len(edges[f]) + 1 for f in usable])
        if best is None:
            break
        place, spot, below, above = best
        stumps.append(Stump(usable[place], edges[usable[place]][spot], below, above))
        margins[place] += np.where(np.arange(len(margins[place])) <= spot, below, above)
    if not stumps:
        raise ValueError("no split tells the labels apart")
    return RealAdaptiveBoosting(features, stumps)


def _best_split(sums: Sequence, sizes: Sequence[int]) -> tuple[int, int, float, float] | None:
    """(feature, bin, log odds below, log odds above) with the least weighted impurity; None if none is below that of all rows."""
    best = None
    for place, size in enumerate(sizes):
        table = np.zeros((size, 2))
        for r in sums:
            if r["feature"] == place:
                table[r["bin"]] = r["good"], r["bad"]
        upto = np.cumsum(table, 0)
        whole = upto[-1]
        left, right = upto[:-1], whole - upto[:-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            impurity = np.where((left.sum(1) > 0) & (right.sum(1) > 0), 2 * left.prod(1) / left.sum(1) + 2 * right.prod(1) / right.sum(1), np.inf)
        spot = int(impurity.argmin()) if len(impurity) else 0
        if len(impurity) and np.isfinite(impurity[spot]) and impurity[spot] < 2 * whole.prod() / whole.sum() * (1 - 1e-9) and (best is None or impurity[spot] < best[0] * (1 - 1e-12)):
            odds = [float(np.log(p / (1 - p))) for p in np.clip([x[1] / x.sum() for x in (left[spot], np.maximum(right[spot], 0))], CHANCE_FLOOR, 1 - CHANCE_FLOOR)]
            best = (impurity[spot], place, spot, *odds)
    return None if best is None else best[1:]


# --- output -----------------------------------------------------------------------


def add_scores(model, df: DataFrame) -> DataFrame:
    """All input columns with predicted, prob_0, prob_1 and score = 1000 * prob_0 (high is good)."""
    scored = model.transform(df)
    chances = vector_to_array("probability")
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("predicted"),
        chances[0].alias("prob_0"),
        chances[1].alias("prob_1"),
        (chances[0] * 1000).alias("score"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def auc_of(model, df: DataFrame, label: str) -> float:
    return roc_auc(add_scores(model, df), "prob_1", label).first()["auc"]


# --- coefficients, p-values, importances: one row per feature -----------------------


def logit_table(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, coefficient, p_value, odds_ratio) of a logit without constant."""
    data = assembler(features).transform(train.select(*features, F.col(label).cast("double").alias(label)))
    data = data.select("features", label).persist()  # read once per iteration
    model = GeneralizedLinearRegression(family="binomial", link="logit", fitIntercept=False, labelCol=label).fit(data)
    rows = [
        (name, float(weight), float(p), float(math.exp(weight)))
        for name, weight, p in zip(features, model.coefficients, model.summary.pValues)
    ]
    data.unpersist()
    return train.sparkSession.createDataFrame(rows, "feature string, coefficient double, p_value double, odds_ratio double")


def t_tail(t: float, dof: int) -> float:
    """Two-sided tail of Student's t, by the continued fraction of the incomplete beta function."""
    x = dof / (dof + t * t)
    a, b = dof / 2, 0.5
    front = math.exp(a * math.log(x) + b * math.log1p(-x) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))) if 0 < x < 1 else 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - front * _fraction(1 - x, b, a) / b
    return front * _fraction(x, a, b) / a


def _fraction(x: float, a: float, b: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1 + term * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + term / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return value


def backward_elimination(train: DataFrame, features: Sequence[str], label: str, level: float = 0.05) -> list[tuple[str, float]]:
    """Features left, with p-values, after dropping the largest p of a linear fit again and again.

    The data is read once, for the correlation matrix; a linear fit of any subset, its
    t values included, follows from that matrix alone, which has one row per feature.
    """
    names = list(features)
    data = assembler([*names, label]).transform(train.select(*names, F.col(label).cast("double").alias(label)))
    size = train.count()
    matrix = np.asarray(Correlation.corr(data, "features").first()[0].toArray())
    kept = [i for i in range(len(names)) if not np.isnan(matrix[i, -1])]
    while kept:
        inverse = np.linalg.pinv(matrix[np.ix_(kept, kept)])
        link = matrix[kept, -1]
        weights = inverse @ link
        dof = size - len(kept) - 1
        if dof < 1:
            raise ValueError("more features than rows")
        spread = np.sqrt(np.maximum(1 - link @ weights, 1e-15) / dof * np.diag(inverse))
        tails = [t_tail(float(t), dof) for t in np.abs(weights / spread)]
        worst = int(np.argmax(tails))
        if tails[worst] <= level:
            return [(names[i], p) for i, p in zip(kept, tails)]
        kept.pop(worst)
    return []


def importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance), highest first; absolute coefficients for a logistic model."""
    stage = model.stages[-1]
    values = np.abs(stage.coefficients.toArray()) if hasattr(stage, "coefficients") else stage.featureImportances.toArray()
    return sorted(zip(features, (float(v) for v in values)), key=lambda pair: (-pair[1], pair[0]))


def important_features(model: PipelineModel, features: Sequence[str], at_least: float | None = None, top: int | None = None) -> list[str]:
    ranked = importances(model, features)
    if at_least is not None:
        ranked = [pair for pair in ranked if pair[1] >= at_least]
    return [name for name, _ in (ranked[:top] if top else ranked)]


def importance_table(spark, models: Mapping[str, PipelineModel], features: Sequence[str]) -> DataFrame:
    rows = [(name, feature, value) for name, model in models.items() for feature, value in importances(model, features)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")
