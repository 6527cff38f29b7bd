"""From bureau and customer files to fitted state and a model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.functions import dates, money, text
from lendloom.operators import encode, profile
from lendloom.params import BANK_RULES_TRAINING, BINARY_LABELS


def join_renamed(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join on differently named keys; names on both sides get ``_x`` and ``_y``."""
    both = set(left.columns) & set(right.columns)
    left = left.select(*[F.col(c).alias(f"{c}_x" if c in both else c) for c in left.columns])
    right = right.select(*[F.col(c).alias(f"{c}_y" if c in both else c) for c in right.columns])
    name = lambda key, mark: f"{key}_{mark}" if key in both else key
    return left.join(right, F.col(name(left_key, "x")) == F.col(name(right_key, "y")))


def customer_features(customers: DataFrame, merged_sub_ids: Sequence[str] = (), merged_into: str = "") -> DataFrame:
    """Merged sub-ids, paid over lent, and a status for first-time customers."""
    columns = {
        "static_pool": money.ratio(F.col("total_paid"), F.col("total_lent")),
        "pre_status": F.coalesce("pre_status", F.lit("BrandNew")),
    }
    if merged_sub_ids:
        columns["sub_id"] = text.replace_in_set(F.col("sub_id"), merged_sub_ids, merged_into)
    return customers.withColumns(columns)


@dataclass(frozen=True)
class CleanRules:
    """Which columns get which treatment."""

    bank: Sequence[str] = ()
    upper: Sequence[str] = ()
    prefix: Sequence[str] = ()
    percent: Sequence[str] = ()
    number: Mapping[str, float] = None  # column -> divisor
    dates: Sequence[str] = ()
    transaction: str = ""
    drop: Sequence[str] = ()


def clean(df: DataFrame, rules: CleanRules, bank_rules=BANK_RULES_TRAINING) -> DataFrame:
    """All text, number and date treatments in one projection."""
    changed = {name: text.canonical_name(F.col(name), bank_rules) for name in rules.bank}
    changed |= {name: F.upper(name) for name in rules.upper}
    changed |= {name: text.prefix_before_bracket(F.col(name)) for name in rules.prefix}
    changed |= {name: text.percent_to_fraction(F.col(name)) for name in rules.percent}
    for name, divisor in (rules.number or {}).items():
        changed[name] = text.to_number(changed.get(name, F.col(name)), divisor)
    end = dates.parse_text_date(F.col(rules.transaction).cast("string")) if rules.transaction else None
    changed |= {f"{name}diff": dates.days_between(dates.parse_text_date(F.col(name).cast("string")), end) for name in rules.dates}
    return df.withColumns(changed).drop(*rules.dates, *rules.drop)


@dataclass
class Fitted:
    """What scoring needs from training: three state tables and a model."""

    missing: DataFrame
    rare: DataFrame
    target: DataFrame
    dropped: list[str]
    model: PipelineModel | None = None
    #: Rates of the dropped columns too, and the mean target of the train rows.
    all_rates: DataFrame | None = None
    mean: float | None = None


def fit_states(train: DataFrame, text_columns: Sequence[str], numeric: Sequence[str], target: str) -> Fitted:
    """Fills, rare labels and target rates from train rows only, each fitted on the result of the one before.

    The rows are read once for all labels: a table of counts is filled, merged and rated in place of the rows.
    """
    counts = encode.count_table(train, text_columns, target)
    fills = encode.text_fills(counts, numbers=[c for c in profile.numeric_columns(train) if c in text_columns])
    medians = encode.fit_missing(train, [], numeric) if numeric else None
    missing = encode.held(fills if medians is None else fills.unionByName(medians))
    filled = encode.fill_counts(counts, missing)
    rare = encode.held(encode.rare_labels(filled))
    merged = encode.held(encode.merge_counts(filled, rare))
    dropped = encode.scarce_in(merged, rare=rare)
    rates = encode.held(merged.where("label IS NOT NULL").select("feature", "label", (F.col("bad") / F.col("n")).alias("rate")))
    sums = counts.where(F.col("feature") == text_columns[0]).agg(F.sum("bad"), F.sum("n")).first() if text_columns else train.agg(F.sum(target), F.count(target)).first()
    mean = None if not sums[1] else float(sums[0] or 0) / sums[1]
    return Fitted(missing, rare, rates.where(~F.col("feature").isin(dropped)) if dropped else rates, dropped, None, rates, mean)


def transform(df: DataFrame, state: Fitted, default_rate: float | None = None) -> DataFrame:
    """Apply fitted states. The same for train rows, test rows and new rows."""
    merged = encode.apply_rare(encode.apply_missing(df, state.missing), state.rare)
    return encode.apply_target(merged.drop(*state.dropped), state.target, default_rate)


def select_columns(df: DataFrame, target: str, always: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(categorical, numerical) without sparse, constant and near-constant columns."""
    unwanted = set(profile.droppable_columns(df.drop(target, *always)))
    rest = df.drop(*unwanted, *always)
    categorical, numerical, constant = profile.split_columns(rest, target)
    flat = set(profile.near_constant_columns(rest, [c for c in rest.columns if c != target])) | set(constant)
    return [c for c in categorical if c not in flat], [c for c in numerical if c not in flat]


def encode_two_valued(df: DataFrame, columns: Sequence[str], extra: Mapping[str, int] | None = None) -> DataFrame:
    return encode.encode_binary(df, columns, BINARY_LABELS | dict(extra or {}))


def training_frame(
    df: DataFrame, key: str, target: str, excluded: Sequence[str] = (), default_rate: float | None = None
) -> tuple[DataFrame, DataFrame, Fitted, list[str]]:
    """(train, test, states, features): the whole preparation between the joined customers and the learners.

    Sparse, constant and near-constant columns go, the rest is split by a hash of the key, states are fitted on train rows and
    applied to both parts; columns of the exclusion list are no features. Unseen labels get the mean target of the train rows.
    """
    categorical, numerical = select_columns(df.drop(*excluded), target, always=(key,))
    kept = df.select(key, target, *categorical, *numerical)
    train, test = encode.split(kept, key)
    states = fit_states(train, categorical, numerical, target)
    rate = states.mean if default_rate is None else default_rate
    features = profile.training_columns(df.select(*categorical, *numerical), [*excluded, *states.dropped])
    return transform(train, states, rate), transform(test, states, rate), states, features
