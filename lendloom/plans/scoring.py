"""Scoring of applications: one plan for batches and streams of requests."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.functions import dates, text
from lendloom.operators import encode
from lendloom.operators.jsontab import add_monthly_income, employment_rollup
from lendloom.operators.models import add_scores, load_model, save_model
from lendloom.params import (
    BANK_RULES_SCORING, CONSTANT_FILLS, DATE_COLUMNS, DATE_DIFF_FILLS, FEATURE_ORDER, LABEL_COLUMNS, PERCENT_COLUMNS, STATE_NAMES,
)
from lendloom.plans.training import fit_states, join_renamed
from lendloom.session import written
from lendloom.sources.files import load_state, save_state


@dataclass
class Scorer:
    """Fitted states, model, and the columns they work on."""

    missing: DataFrame
    rare: DataFrame
    target: DataFrame
    model: PipelineModel
    features: Sequence[str] = FEATURE_ORDER
    labels: Sequence[str] = LABEL_COLUMNS
    percent: Sequence[str] = PERCENT_COLUMNS
    dates: Sequence[str] = DATE_COLUMNS
    bank: str | None = "Bank"
    default_rate: float = 0.0

    def save(self, folder: str) -> None:
        """States, model, column lists and the rate of unseen labels."""
        settings = {"features": list(self.features), "labels": list(self.labels), "percent": list(self.percent), "dates": list(self.dates), "bank": self.bank, "default_rate": self.default_rate}
        spark = self.missing.sparkSession
        save_state(spark.createDataFrame([(json.dumps(settings),)], "settings string"), f"{folder}/settings")
        for name in ("missing", "rare", "target"):
            save_state(getattr(self, name), f"{folder}/{name}")
        save_model(self.model, f"{folder}/model")

    @classmethod
    def load(cls, spark: SparkSession, folder: str, **columns) -> Scorer:
        states = {name: load_state(spark, f"{folder}/{name}") for name in ("missing", "rare", "target")}
        saved = json.loads(load_state(spark, f"{folder}/settings").first()["settings"])
        return cls(model=load_model(f"{folder}/model"), **states, **(saved | columns))


def source_columns(features: Sequence[str]) -> list[str]:
    """Input columns behind the features: a date difference comes from its date."""
    return [name.removesuffix("diff") for name in features]


def clean_inputs(
    df: DataFrame, as_of: Column, percent: Sequence[str] = PERCENT_COLUMNS, date_columns: Sequence[str] = DATE_COLUMNS, bank: str | None = "Bank"
) -> DataFrame:
    """Percentages, bank names, date differences, and the fills that are fixed."""
    changed: dict[str, Column] = {name: text.percent_to_fraction(F.col(name)) for name in percent}
    if bank:
        changed[bank] = text.canonical_name(F.col(bank), BANK_RULES_SCORING)
    for name in date_columns:
        changed[f"{name}diff"] = dates.days_between(dates.parse_text_date(F.col(name).cast("string")), as_of.cast("timestamp"))
    cleaned = df.withColumns(changed)
    fixed = {k: v for k, v in (CONSTANT_FILLS | DATE_DIFF_FILLS).items() if k in cleaned.columns}
    return cleaned.fillna(fixed) if fixed else cleaned


def prepare(df: DataFrame, scorer: Scorer, as_of: Column) -> DataFrame:
    """Model input: clean, fill, merge rare labels, encode, in the order of the features."""
    cleaned = clean_inputs(df, as_of, scorer.percent, scorer.dates, scorer.bank)
    merged = encode.apply_rare(encode.apply_missing(cleaned, scorer.missing), scorer.rare)
    encoded = encode.apply_target(merged, scorer.target, scorer.default_rate)
    return encoded.withColumns({name: F.col(name).cast("double") for name in scorer.features})


def fit_input_states(train: DataFrame, target: str, as_of: Column, **columns) -> Scorer:
    """A scorer without a model: fills, rare labels and target rates of the train rows.

    Unseen labels get the mean target of the train rows.
    """
    scorer = Scorer(missing=None, rare=None, target=None, model=None, **columns)
    numeric = [name for name in scorer.features if name not in scorer.labels]
    # Dates, percentages and names are read from text once, however many passes the states take.
    cleaned = written(clean_inputs(train, as_of, scorer.percent, scorer.dates, scorer.bank).select(*numeric, *scorer.labels, target), "cleaned")
    fitted = fit_states(cleaned, scorer.labels, numeric, target)
    scorer.missing, scorer.rare, scorer.target = fitted.missing, fitted.rare, fitted.all_rates
    scorer.default_rate = fitted.mean
    return scorer


def fit_scorer(
    train: DataFrame, target: str, as_of: Column, learn: Callable[[DataFrame, Sequence[str], str], PipelineModel], **columns
) -> Scorer:
    """States and model from train rows, through the same transform that scoring uses."""
    scorer = fit_input_states(train, target, as_of, **columns)
    ready = written(prepare(train, scorer, as_of).select(*scorer.features, target), "model-input")  # a learner reads it again and again
    scorer.model = learn(ready, list(scorer.features), target)
    return scorer


def score(df: DataFrame, scorer: Scorer, key: str, as_of: Column) -> DataFrame:
    """Key, the inputs as they came in, score, predicted class and both probabilities.

    Inputs travel through the plan beside the prepared columns, so nothing is joined back.
    """
    inputs = [c for c in dict.fromkeys(source_columns(scorer.features)) if c in df.columns]
    carried = df.withColumns({f"_in_{c}": F.col(c) for c in inputs})
    scored = add_scores(scorer.model, prepare(carried, scorer, as_of))
    return scored.select(key, *[F.col(f"_in_{c}").alias(c) for c in inputs], "predicted", "prob_0", "prob_1", "score")


def assemble_applicants(bureau: DataFrame, customers: DataFrame) -> DataFrame:
    """Bureau and customer rows joined, with state name, employment counts and monthly income."""
    answered = customers.where(F.col("employment_response").isNotNull())
    joined = join_renamed(bureau, answered, "application_id", "applicant_id")
    named = joined.withColumn("state_name", text.lookup_literal(F.col("state"), STATE_NAMES))
    return add_monthly_income(employment_rollup(named, "employment_response"), rounded=True)
