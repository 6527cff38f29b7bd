"""Models: fitted on default labels of applications."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendloom.operators import models
from lendloom.operators.encode import split, split_written
from lendloom.operators.evaluate import confusion
from lendloom.params import CONSTANT_FILLS, DATE_DIFF_FILLS, FEATURE_ORDER, LABEL_COLUMNS, PERCENT_COLUMNS
from lendloom.plans.scoring import Scorer, fit_input_states, fit_scorer, prepare, score
from lendloom.session import scratch_dir
from lendloom.sources.files import request_json
from lendloom.streaming.requests import deliver, delivered, read_requests, score_stream, write_scores
from lendloom.workload.ledger import FIRST_SQL, first_payment_labels
from lendloom.workload.registry import query, shape, table
from lendloom.workload.star import with_star

NUMBERS = ["price", "balance", "lines", "quantity", "month"]
ROUNDS = 10


def applications(spark, folder):
    """Cycled applications with features and the first-payment-default label."""
    labels = first_payment_labels(spark, folder).where("cycled = 1").select(F.col("id").alias("o_orderkey"), F.col("first_payment_default").cast("int").alias("bad"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("price"),
        F.month("o_orderdate").cast("double").alias("month"), F.col("o_orderpriority").alias("priority"),
        F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a").alias("seen"),
    )
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").cast("double").alias("lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")
    )
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    joined = labels.join(orders, "o_orderkey").join(lines, "o_orderkey", "left").join(customers, "c_custkey", "left")
    return joined.select(
        F.col("o_orderkey").alias("id"), "bad", "price", "month", "balance", F.coalesce("lines", F.lit(0.0)).alias("lines"),
        F.coalesce("quantity", F.lit(0.0)).alias("quantity"), "priority", "segment", "seen",
    )


def parts(spark, folder):
    return split_written(applications(spark, folder), "id", "applications")


def checked(scored, *more):
    """Scores depend on the learner, so what is compared are the identities that every score must satisfy, row by row."""
    near = lambda left, right: (F.abs(left - right) < 1e-6).cast("int")
    return scored.select(
        "id", *more,
        near(F.col("prob_0") + F.col("prob_1"), F.lit(1.0)).alias("sums_to_one"),
        near(F.col("score"), F.col("prob_0") * 1000).alias("is_scaled"),
        (F.col("prob_1").between(0, 1) & ((F.col("prob_1") > 0.5) == (F.col("predicted") == 1))).cast("int").alias("is_decided"),
    )


def _fitted(fit, spark, folder):
    train, test = parts(spark, folder)
    return models.add_scores(fit(train, NUMBERS, "bad"), test)


def _scores(fit, spark, folder):
    return checked(_fitted(fit, spark, folder), "bad")


LABEL_SQL = with_star(
    f"""
SELECT id, CASE WHEN first_payment_id IS NULL THEN 1 WHEN first_payment_date - date_due > 7 THEN 1 ELSE 0 END AS bad
FROM (SELECT a.id, a.date_due, f.* FROM applicant a JOIN account c ON c.id = a.id LEFT JOIN ({FIRST_SQL}) f ON f.ss = c.social)
WHERE DATE '2001-06-30' - date_due > 7
""",
    "applicant", "account", "ledger",
)
TRAIN = "CAST('0x' || substr(md5(CAST(l.id AS VARCHAR)), 1, 6) AS BIGINT) % 10 >= 3"
CHECKS = "1 AS sums_to_one, 1 AS is_scaled, 1 AS is_decided"
SCORES_SQL = f"SELECT l.id, l.bad, {CHECKS} FROM ({LABEL_SQL}) l WHERE NOT {TRAIN}"


@query("boosted_scores", SCORES_SQL)
def boosted_scores(spark, folder):
    """``ROUNDS`` rounds, a parameter of this query; ``fit_boosted`` itself takes 100."""
    return _scores(lambda *a: models.fit_boosted(*a, rounds=ROUNDS), spark, folder)


@query("tuned_boosting_scores", SCORES_SQL)
def tuned_boosting_scores(spark, folder):
    """All 3,000 rounds. A row costs as many trees, some milliseconds, so the rows to score are dealt over all cores."""
    train, test = parts(spark, folder)
    model, cores = models.fit_tuned_boosting(train, NUMBERS, "bad"), spark.sparkContext.defaultParallelism
    dealt = test.repartition(cores) if test.rdd.getNumPartitions() < cores else test
    return checked(models.add_scores(model, dealt), "bad")


@query("forest_scores", SCORES_SQL)
def forest_scores(spark, folder):
    """20 trees, a parameter of this query; ``fit_forest`` itself takes 1,000."""
    return _scores(lambda *a: models.fit_forest(*a, trees=20), spark, folder)


@query("adaptive_scores", SCORES_SQL)
def adaptive_scores(spark, folder):
    """5 rounds, a parameter of this query; ``fit_adaptive`` itself takes 50."""
    return _scores(lambda *a: models.fit_adaptive(*a, rounds=5), spark, folder)


@query("real_adaptive_auc", f"SELECT CAST(count(*) AS BIGINT) AS test_rows, 1 AS above_no_skill, 1 AS above_discrete_on_train FROM ({LABEL_SQL}) l WHERE NOT {TRAIN}")
def real_adaptive_auc(spark, folder):
    """All 50 real-valued rounds: a held-out AUC above no skill, and on the train rows one not below 5 rounds of the discrete form."""
    train, test = parts(spark, folder)
    real, discrete = models.fit_real_adaptive(train, NUMBERS, "bad"), models.fit_adaptive(train, NUMBERS, "bad", rounds=5)
    flags = {
        "above_no_skill": models.auc_of(real, test, "bad") > 0.5,
        "above_discrete_on_train": models.auc_of(real, train, "bad") >= models.auc_of(discrete, train, "bad") - 1e-9,
    }
    return test.agg(F.count(F.lit(1)).alias("test_rows")).select("test_rows", *(F.lit(int(ok)).alias(name) for name, ok in flags.items()))


@query("logistic_scores", SCORES_SQL)
def logistic_scores(spark, folder):
    return _scores(models.fit_logistic, spark, folder)


@query("logistic_confusion", f"SELECT CAST(count(*) FILTER (bad = 1) AS BIGINT) AS bad_rows, CAST(count(*) FILTER (bad = 0) AS BIGINT) AS good_rows, 1 AS fits FROM ({SCORES_SQL})")
def logistic_confusion(spark, folder):
    """The cells add up to the labels, and accuracy follows from them."""
    cells = confusion(_fitted(models.fit_logistic, spark, folder), "prob_1", "bad")
    right = (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
    return cells.select((F.col("tp") + F.col("fn")).alias("bad_rows"), (F.col("tn") + F.col("fp")).alias("good_rows"), (F.abs(right - F.col("accuracy")) < 1e-9).cast("int").alias("fits"))


FEATURES_SQL = "SELECT unnest(['price', 'balance', 'lines', 'quantity', 'month']) AS feature"


@query("logit_table", f"SELECT feature, 1 AS is_solved, 1 AS odds_fit FROM ({FEATURES_SQL})")
def logit_table(spark, folder):
    """The coefficients solve the score equations: for every feature, the residuals weighted by it sum to nothing."""
    train, _ = parts(spark, folder)
    table_rows = models.logit_table(train, NUMBERS, "bad").collect()  # one row per feature
    linear = sum((F.col(r["feature"]) * r["coefficient"] for r in table_rows), F.lit(0.0))
    residual = F.col("bad") - 1 / (1 + F.exp(-linear))
    sums = train.agg(*[(F.abs(F.sum(F.col(c) * residual)) / F.sum(F.abs(F.col(c)))).alias(c) for c in NUMBERS]).first()
    rows = [(r["feature"], int(sums[r["feature"]] < 1e-4), int(abs(math.exp(r["coefficient"]) - r["odds_ratio"]) < 1e-9)) for r in table_rows]
    return spark.createDataFrame(rows, "feature string, is_solved int, odds_fit int")


@query("backward_elimination", f"SELECT CAST(count(*) AS BIGINT) AS train_rows, 1 AS all_significant, 1 AS refit_agrees FROM ({LABEL_SQL}) l WHERE {TRAIN}")
def backward_elimination(spark, folder):
    """Some features are left, all are significant, and an ordinary least-squares fit on them gives the same p-values."""
    train, _ = parts(spark, folder)
    kept = models.backward_elimination(train, NUMBERS, "bad")
    agrees = False
    if kept:
        data = models.assembler([n for n, _ in kept]).transform(train.select(*[n for n, _ in kept], F.col("bad").cast("double").alias("bad")))
        refit = LinearRegression(labelCol="bad", solver="normal").fit(data).summary.pValues
        agrees = all(abs(p - q) < 1e-6 for (_, p), q in zip(kept, refit))
    significant = bool(kept) and all(p <= 0.05 for _, p in kept)
    return train.agg(F.count("*").alias("train_rows")).select("train_rows", F.lit(int(significant)).alias("all_significant"), F.lit(int(agrees)).alias("refit_agrees"))


@query("importances", f"SELECT model, feature, 1 AS in_range, 1 AS sums_to_one FROM ({FEATURES_SQL}) CROSS JOIN (SELECT unnest(['forest', 'boosted', 'logistic']) AS model)")
def importances(spark, folder):
    """Importances of trees lie in [0, 1] and sum to one per model; those of the logistic model are absolute coefficients."""
    train, _ = parts(spark, folder)
    fitted = {
        "forest": models.fit_forest(train, NUMBERS, "bad", trees=20),
        "boosted": models.fit_boosted(train, NUMBERS, "bad", rounds=ROUNDS),
        "logistic": models.fit_logistic(train, NUMBERS, "bad"),
    }
    rows = models.importance_table(spark, fitted, NUMBERS)
    total = F.sum("importance").over(W.partitionBy("model"))  # one row per feature and model
    tree = F.col("model") != "logistic"
    return rows.select(
        "model", "feature", ((F.col("importance") >= 0) & (~tree | (F.col("importance") <= 1 + 1e-9))).cast("int").alias("in_range"),
        (~tree | (F.abs(total - 1) < 1e-6)).cast("int").alias("sums_to_one"),
    )


CUTS_SQL = f"""
SELECT model, rule, 1 AS is_cut, 1 AS is_ranked FROM (SELECT unnest(['forest', 'boosted', 'logistic']) AS model, unnest(['at_least 0.01', 'at_least 0.01', 'top 3']) AS rule)
"""


def cut_flags(values, kept, cut) -> tuple[int, int]:
    """Whether ``kept`` is what the cut asks for, and the first in order. An empty selection, as of trees without a split, is 0 and 0."""
    if not kept:
        return 0, 0
    inside, out = [values[f] for f in kept], [values[f] for f in values if f not in kept]
    is_cut = len(kept) == cut["top"] if "top" in cut else min(inside) >= cut["at_least"] and max(out, default=0.0) < cut["at_least"]
    return int(is_cut), int(inside == sorted(inside, reverse=True) and min(inside) >= max(out, default=0.0))


@query("importance_cuts", CUTS_SQL)
def importance_cuts(spark, folder):
    """The features that pass the cut of a model: exactly those at or above the threshold, or the first ones in order."""
    train, _ = parts(spark, folder)
    fitted = {
        "forest": (models.fit_forest(train, NUMBERS, "bad", trees=20), {"at_least": 0.01}),
        "boosted": (models.fit_boosted(train, NUMBERS, "bad", rounds=ROUNDS), {"at_least": 0.01}),
        "logistic": (models.fit_logistic(train, NUMBERS, "bad"), {"top": 3}),
    }
    rows = []
    for name, (model, cut) in fitted.items():
        is_cut, ranked = cut_flags(dict(models.importances(model, NUMBERS)), models.important_features(model, NUMBERS, **cut), cut)
        rows.append((name, " ".join(str(x) for x in next(iter(cut.items()))), is_cut, ranked))
    return spark.createDataFrame(rows, "model string, rule string, is_cut int, is_ranked int")


# --- scoring of requests ------------------------------------------------------------

REQUEST_COLUMNS = {
    "id": "bigint", "price": "double", "balance": "double", "match": "string", "seen": "string", "Bank": "string", "segment": "string",
}
SCORER_COLUMNS = {
    "features": ("price", "balance", "match", "seendiff", "Bank", "segment"),
    "labels": ("Bank", "segment"),
    "percent": ("match",),
    "dates": ("seen",),
    "bank": "Bank",
}


def requests(spark, folder):
    """Applications as they would arrive for scoring: percentages, dates and bank names as text, some missing."""
    missing = F.col("id") % 20 == 0
    return applications(spark, folder).select(
        "id", "bad", F.when(~missing, F.col("price")).alias("price"), "balance",
        F.concat((F.col("id") % 101).cast("string"), F.lit("%")).alias("match"),
        F.when(~missing, F.col("seen")).alias("seen"), F.concat(F.lit("bank "), F.col("priority")).alias("Bank"), "segment",
    )


def as_of():
    return F.lit(dt.date(2001, 6, 30))


def request_parts(spark, folder):
    return split_written(requests(spark, folder), "id", "requests")


def fitted_scorer(spark, folder) -> tuple[Scorer, object]:
    train, test = request_parts(spark, folder)
    learn = lambda df, features, target: models.fit_boosted(df, features, target, rounds=5)
    scorer = fit_scorer(train, "bad", as_of(), learn, **SCORER_COLUMNS)
    return scorer, test.drop("bad")


PREPARED_SQL = f"""
WITH r AS (SELECT l.id, l.bad, CASE WHEN l.id % 20 <> 0 THEN o_totalprice END AS price, c_acctbal AS balance, (l.id % 101) / 100 AS match,
    CASE WHEN l.id % 20 <> 0 THEN CAST(date_diff('day', o_orderdate, TIMESTAMP '2001-06-30') AS DOUBLE) END AS seendiff,
    'BANK ' || o_orderpriority AS bank, c_mktsegment AS segment, CAST('0x' || substr(md5(CAST(l.id AS VARCHAR)), 1, 6) AS BIGINT) % 10 >= 3 AS train
  FROM ({LABEL_SQL}) l JOIN orders ON o_orderkey = l.id JOIN customer ON c_custkey = o_custkey),
  t AS (SELECT * FROM r WHERE train), b AS (SELECT bank, avg(bad) AS rate FROM t GROUP BY 1), s AS (SELECT segment, avg(bad) AS rate FROM t GROUP BY 1)
SELECT id, round(coalesce(price, (SELECT median(price) FROM t)), 4) AS price, round(balance, 4) AS balance, round(match, 4) AS match,
  coalesce(seendiff, (SELECT median(seendiff) FROM t)) AS seendiff, round(b.rate, 8) AS "Bank", round(s.rate, 8) AS segment
FROM r JOIN b USING (bank) JOIN s USING (segment) WHERE NOT train
"""


@query("prepared_requests", PREPARED_SQL)
def prepared_requests(spark, folder):
    """Model input of the test rows, from states fitted on the train rows."""
    train, test = request_parts(spark, folder)
    states = fit_input_states(train, "bad", as_of(), **SCORER_COLUMNS)
    kinds = {"price": "r4", "balance": "r4", "match": "r4", "seendiff": "double", "Bank": "r8", "segment": "r8"}
    return shape(prepare(test, states, as_of()), id="bigint", **kinds)


INPUTS_SQL = f"""
SELECT l.id, CASE WHEN l.id % 20 <> 0 THEN o_totalprice END AS price, c_acctbal AS balance, CAST(l.id % 101 AS VARCHAR) || '%' AS match,
  CASE WHEN l.id % 20 <> 0 THEN strftime(o_orderdate, '%-m/%-d/%Y %-I:%M:%S %p') END AS seen, 'bank ' || o_orderpriority AS "Bank", c_mktsegment AS segment, {CHECKS}
FROM ({LABEL_SQL}) l JOIN orders ON o_orderkey = l.id JOIN customer ON c_custkey = o_custkey WHERE NOT {TRAIN}
"""
SAME_SQL = f"SELECT id, {CHECKS}, 1 AS is_same FROM ({INPUTS_SQL})"
INPUTS = ("price", "balance", "match", "seen", "Bank", "segment")


def same_scores(scored, reference):
    """Identities of the scores, and whether each equals the score that another way of scoring gives."""
    other = reference.select("id", F.col("score").alias("_score"), F.col("predicted").alias("_predicted"))
    both = scored.join(other, "id", "full")
    same = (F.abs(F.col("score") - F.col("_score")) < 1e-9) & (F.col("predicted") == F.col("_predicted"))
    return checked(both, F.coalesce(same, F.lit(False)).cast("int").alias("is_same"))


@query("batch_score", INPUTS_SQL)
def batch_score(spark, folder):
    """Scored requests come back with the inputs as they arrived. The model has 5 rounds, a parameter of these queries."""
    scorer, test = fitted_scorer(spark, folder)
    return checked(score(test, scorer, "id", as_of()), *INPUTS)


@query("saved_model_score", SAME_SQL)
def saved_model_score(spark, folder):
    """A scorer that was saved and loaded without arguments gives the scores of the one that was not."""
    scorer, test = fitted_scorer(spark, folder)
    path = scratch_dir(spark, "scorer")
    scorer.save(path)
    return same_scores(score(test, Scorer.load(spark, path), "id", as_of()), score(test, scorer, "id", as_of()))


@query("stream_score", SAME_SQL)
def stream_score(spark, folder):
    """Requests written as text files and scored by a stream get the scores of the batch."""
    scorer, test = fitted_scorer(spark, folder)
    path = scratch_dir(spark, "stream")
    request_json(test, list(REQUEST_COLUMNS)).select("json").write.text(f"{path}/requests")
    stream = read_requests(spark, f"{path}/requests", REQUEST_COLUMNS)
    write_scores(score_stream(stream, scorer, "id", as_of()), f"{path}/scores", f"{path}/progress").awaitTermination()
    return same_scores(spark.read.parquet(f"{path}/scores"), score(test, scorer, "id", as_of()))


DELIVERED_SQL = f"""
WITH t AS (SELECT l.id FROM ({LABEL_SQL}) l JOIN orders ON o_orderkey = l.id JOIN customer ON c_custkey = o_custkey WHERE NOT {TRAIN})
SELECT 'scores' AS sink, CAST(NULL AS VARCHAR) AS reason, count(*) AS n, CAST(sum(id) AS BIGINT) AS keys, CAST(1 AS INT) AS is_same FROM t
UNION ALL SELECT 'rejects', 'malformed', count(*), CAST(sum(id) AS BIGINT), 1 FROM t WHERE id % 10 = 0 HAVING count(*) > 0
UNION ALL SELECT 'rejects', 'empty', count(*), CAST(sum(id) AS BIGINT), 1 FROM t WHERE id % 10 = 5 HAVING count(*) > 0
"""


@query("stream_delivery", DELIVERED_SQL)
def stream_delivery(spark, folder):
    """Good lines among cut and empty ones: both sinks of one stream, and whether every score equals the batch score."""
    scorer, test = fitted_scorer(spark, folder)
    path = scratch_dir(spark, "delivery")
    broken = F.when(F.col("id") % 10 == 0, F.concat(F.lit('{"id":['), F.col("id"))).when(F.col("id") % 10 == 5, F.concat(F.lit('{"id":[],"other":['), F.col("id"), F.lit("]}")))
    lines = request_json(test, list(REQUEST_COLUMNS)).select("json").unionByName(test.select(broken.alias("json")).where("json IS NOT NULL"))
    lines.write.text(f"{path}/requests")
    places = (f"{path}/scores", f"{path}/rejects", f"{path}/progress")
    deliver(spark, f"{path}/requests", REQUEST_COLUMNS, scorer, "id", as_of(), *places, files_per_trigger=3).awaitTermination()
    same = same_scores(delivered(spark, places[0]), score(test, scorer, "id", as_of()))
    scores = same.agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("keys"), F.min("is_same").alias("is_same"))
    key = F.regexp_extract("text", "([0-9]+)", 1).cast("bigint")
    rejects = delivered(spark, places[1]).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("keys"), F.lit(1).alias("is_same"))
    return scores.select(F.lit("scores").alias("sink"), F.lit(None).cast("string").alias("reason"), "n", "keys", "is_same").unionByName(rejects.select(F.lit("rejects").alias("sink"), "reason", "n", "keys", "is_same"))


# --- the shipped scorer with its own column lists ------------------------------------


def _shipped_column(place: int, name: str) -> str:
    """A value for every feature of the shipped scorer, by rule from the order; some are missing."""
    key = f"(o_orderkey * {2 * place + 7})"
    if name in LABEL_COLUMNS:
        missing = 6 if name in CONSTANT_FILLS else 1_000_003
        return f"CASE WHEN o_orderkey % {missing} = 0 THEN NULL ELSE 'L' || CAST({key} % 5 AS STRING) END AS `{name}`"
    if name.endswith("diff"):
        source = name.removesuffix("diff")
        return f"CASE WHEN o_orderkey % {place % 7 + 3} = 0 THEN NULL ELSE date_format(o_orderdate - INTERVAL '{place}' DAY, 'M/d/yyyy h:mm:ss a') END AS `{source}`"
    if name in PERCENT_COLUMNS:
        return f"CAST({key} % 101 AS STRING) || '%' AS `{name}`"
    return f"CASE WHEN o_orderkey % {place + 20} = 0 THEN NULL ELSE CAST({key} % 997 AS DOUBLE) END AS `{name}`"


def shipped_requests(spark, folder):
    columns = ", ".join(_shipped_column(k, name) for k, name in enumerate(FEATURE_ORDER))
    return spark.sql(f"SELECT o_orderkey AS id, CAST(o_orderkey * 7919 % 10 < 3 AS INT) AS bad, {columns} FROM {{orders}}", orders=table(spark, folder, "orders"))


def _shipped_sql() -> str:
    place = {name: k for k, name in enumerate(FEATURE_ORDER)}
    diffs = ", ".join(
        f"coalesce(CASE WHEN o_orderkey % {place[n] % 7 + 3} <> 0 THEN CAST(date_diff('day', o_orderdate - INTERVAL '{place[n]}' DAY, TIMESTAMP '2001-06-30') AS DOUBLE) END, {fill}) AS \"{n}\""
        for n, fill in DATE_DIFF_FILLS.items())
    percents = ", ".join(f"round((o_orderkey * {2 * place[n] + 7}) % 101 / 100, 4) AS \"{n}\"" for n in PERCENT_COLUMNS)
    label = {n: f"coalesce(CASE WHEN o_orderkey % 6 <> 0 THEN 'L' || (o_orderkey * {2 * place[n] + 7}) % 5 END, '{fill}')" for n, fill in CONSTANT_FILLS.items()}
    rates = ", ".join(f"round((SELECT avg(bad) FROM t WHERE {label[n].replace('o_orderkey', 't.o_orderkey')} = {label[n].replace('o_orderkey', 'x.o_orderkey')}), 6) AS \"{n}\"" for n in CONSTANT_FILLS)
    number = f"CASE WHEN o_orderkey % {place['Salary'] + 20} <> 0 THEN CAST((o_orderkey * {2 * place['Salary'] + 7}) % 997 AS DOUBLE) END"
    return f"""
WITH o AS (SELECT *, CAST(o_orderkey * 7919 % 10 < 3 AS INT) AS bad, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 6) AS BIGINT) % 10 >= 3 AS train FROM orders), t AS (SELECT * FROM o WHERE train)
SELECT o_orderkey AS id, {diffs}, {percents}, {rates}, coalesce({number}, (SELECT median({number}) FROM t)) AS "Salary",
  md5('{",".join(FEATURE_ORDER)}') AS feature_order, CAST({len(FEATURE_ORDER)} AS BIGINT) AS filled FROM o x WHERE NOT train
"""


@query("shipped_inputs", _shipped_sql())
def shipped_inputs(spark, folder):
    """Model input of the scorer with its 55 columns, its own label, percentage and date lists, and its fixed fills; every value is there."""
    train, test = split(shipped_requests(spark, folder), "id")
    scorer = fit_input_states(train, "bad", as_of())
    ready = prepare(test, scorer, as_of())
    ordered = F.md5(F.lit(",".join(models.assembler(scorer.features).getInputCols())))
    filled = sum((F.col(name).isNotNull().cast("bigint") for name in scorer.features), F.lit(0).cast("bigint"))
    kinds = {name: "double" for name in DATE_DIFF_FILLS} | {name: "r4" for name in PERCENT_COLUMNS} | {name: "r6" for name in CONSTANT_FILLS} | {"Salary": "double"}
    return shape(ready.withColumn("feature_order", ordered).withColumn("filled", filled), id="bigint", **kinds, feature_order="string", filled="bigint")
