"""Evaluation of score columns that need no model."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendloom.operators import evaluate
from lendloom.operators.encode import split
from lendloom.params import SCORE_CUTOFFS
from lendloom.workload.registry import query, shape, table

SCORED_SQL = """
SELECT o_orderkey AS id, o_custkey AS person, CAST(floor(o_totalprice / 500) AS DOUBLE) AS score, o_totalprice / 500000 AS chance,
  CAST(CASE WHEN (o_totalprice + o_custkey * 300) % 50000 < o_totalprice / 12 THEN 1 ELSE 0 END AS INT) AS bad, o_orderdate
FROM {orders}
"""
SCORED = SCORED_SQL.replace("{orders}", "orders")


def scored(spark, folder):
    return spark.sql(SCORED_SQL, orders=table(spark, folder, "orders"))


def judged(spark, folder):
    """Labelled documents with their length as the score."""
    documents = table(spark, folder, "documents").select("doc_id", "n_chars", "source")
    return table(spark, folder, "labels").join(documents, "doc_id")


JUDGED = "SELECT l.*, d.n_chars, d.source FROM labels l JOIN documents d USING (doc_id)"


@query(
    "confusion",
    f"""
SELECT *, round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy
FROM (SELECT count(*) FILTER (c <= 0.5 AND bad = 0) AS tn, count(*) FILTER (c > 0.5 AND bad = 0) AS fp, count(*) FILTER (c <= 0.5 AND bad = 1) AS fn,
  count(*) FILTER (c > 0.5 AND bad = 1) AS tp FROM (SELECT chance AS c, bad FROM ({SCORED})))
""",
)
def confusion(spark, folder):
    rows = evaluate.confusion(scored(spark, folder), "chance", "bad")
    return shape(rows, tn="bigint", fp="bigint", fn="bigint", tp="bigint", precision="r6", recall="r6", accuracy="r6")


AUC_SQL = f"""
SELECT CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg, round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 8) AS auc
FROM (SELECT score, pos, neg, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS below
  FROM (SELECT score, CAST(sum(bad) AS DOUBLE) AS pos, CAST(sum(1 - bad) AS DOUBLE) AS neg FROM ({SCORED}) GROUP BY 1))
"""


@query("roc_auc", AUC_SQL)
def roc_auc(spark, folder):
    return shape(evaluate.roc_auc(scored(spark, folder), "score", "bad"), pos="bigint", neg="bigint", auc="r8")


@query("roc_auc_chunked", AUC_SQL)
def roc_auc_chunked(spark, folder):
    """The same through the path for more distinct scores than one task should sort."""
    rows = evaluate.roc_auc(scored(spark, folder), "score", "bad", rows_per_task=20)
    return shape(rows, pos="bigint", neg="bigint", auc="r8")


@query(
    "roc_auc_by_source",
    f"""
WITH c AS (SELECT source, n_chars, CAST(sum(quality) AS DOUBLE) AS pos, CAST(sum(1 - quality) AS DOUBLE) AS neg FROM ({JUDGED}) GROUP BY 1, 2)
SELECT source, round(sum(pos * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0), 8) AS auc
FROM (SELECT *, sum(neg) OVER (PARTITION BY source ORDER BY n_chars ROWS UNBOUNDED PRECEDING) - neg AS below FROM c) GROUP BY 1
""",
)
def roc_auc_by_source(spark, folder):
    return shape(evaluate.roc_auc(judged(spark, folder), "n_chars", "quality", by=["source"]), source="string", auc="r8")


@query(
    "roc_curve",
    f"""
WITH c AS (SELECT CAST(n_chars AS DOUBLE) AS threshold, sum(toxic) AS pos, sum(1 - toxic) AS neg FROM ({JUDGED}) GROUP BY 1)
SELECT threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
  round(sum(pos) OVER w / (SELECT sum(pos) FROM c), 6) AS tpr, round(sum(neg) OVER w / (SELECT sum(neg) FROM c), 6) AS fpr
FROM c WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)
""",
)
def roc_curve(spark, folder):
    return shape(evaluate.roc_curve(judged(spark, folder), "n_chars", "toxic"), threshold="double", tp="bigint", fp="bigint", tpr="r6", fpr="r6")


@query("no_skill", "SELECT CAST(sum(quality) AS BIGINT) AS pos, CAST(sum(1 - quality) AS BIGINT) AS neg, CAST(0.5 AS DOUBLE) AS auc FROM labels")
def no_skill(spark, folder):
    return shape(evaluate.no_skill(table(spark, folder, "labels"), "quality"), pos="bigint", neg="bigint", auc="r8")


@query(
    "threshold_accuracy",
    f"""
WITH c AS (SELECT CAST(n_chars AS DOUBLE) AS threshold, sum(quality) AS pos, sum(1 - quality) AS neg FROM ({JUDGED}) GROUP BY 1)
SELECT threshold, round((coalesce(sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  + sum(neg) OVER (ORDER BY threshold ROWS UNBOUNDED PRECEDING)) / (SELECT sum(pos + neg) FROM c), 6) AS accuracy
FROM c
""",
)
def threshold_accuracy(spark, folder):
    return shape(evaluate.threshold_accuracy(judged(spark, folder), "n_chars", "quality"), threshold="double", accuracy="r6")


@query(
    "top_thresholds",
    f"""
WITH c AS (SELECT CAST(n_chars AS DOUBLE) AS threshold, sum(quality) AS pos, sum(1 - quality) AS neg FROM ({JUDGED}) GROUP BY 1)
SELECT threshold, round((coalesce(sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  + sum(neg) OVER (ORDER BY threshold ROWS UNBOUNDED PRECEDING)) / (SELECT sum(pos + neg) FROM c), 6) AS accuracy
FROM c ORDER BY accuracy DESC, threshold LIMIT 5
""",
)
def top_thresholds(spark, folder):
    return shape(evaluate.threshold_accuracy(judged(spark, folder), "n_chars", "quality").limit(5), threshold="double", accuracy="r6")


@query(
    "model_average",
    """
SELECT l.doc_id, round((d.n_chars / 20000 + l.toxic + CASE WHEN d.lang = 'en' THEN 1 ELSE 0 END) / 3, 8) AS score
FROM labels l JOIN documents d USING (doc_id)
""",
)
def model_average(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scores = {
        "length": documents.select("doc_id", (F.col("n_chars") / 20000).alias("score")),
        "toxic": labels.select("doc_id", F.col("toxic").cast("double").alias("score")),
        "english": documents.select("doc_id", (F.col("lang") == "en").cast("double").alias("score")),
    }
    return shape(evaluate.model_average(scores, "doc_id", "score"), doc_id="bigint", score="r8")


EDGES = ", ".join(f"quantile_cont(score, {i / 10})" for i in range(11))


@query(
    "quantile_bins",
    f"""
WITH s AS ({SCORED}), q AS (SELECT unnest([{EDGES}]) AS edge FROM s), e AS (SELECT DISTINCT edge FROM q)
SELECT CAST(bin AS BIGINT) AS bin, count(*) AS volume, round(avg(bad), 6) AS rate
FROM (SELECT greatest((SELECT count(*) FROM e WHERE edge < score), 1) AS bin, bad FROM s) GROUP BY 1
""",
)
def quantile_bins(spark, folder):
    rows = evaluate.quantile_bins(scored(spark, folder), "score", 10)
    return shape(evaluate.rate_per_bin(rows, "bin", "bad"), bin="bigint", volume="bigint", rate="r6")


@query(
    "width_bins",
    """
WITH v AS (SELECT value, CAST(event_type = 'error' AS INT) AS bad FROM events),
  b AS (SELECT floor(min(value)) AS low, ceil(max(value)) AS high, greatest(round_even((max(value) - min(value)) / 10, 0), 1) AS step FROM v),
  n AS (SELECT CAST(greatest(ceil((value - low) / step), 1) AS BIGINT) AS bin, bad FROM v, b)
SELECT i AS bin, CAST(low + (i - 1) * step AS DOUBLE) AS low, CAST(low + i * step AS DOUBLE) AS high, count(n.bin) AS volume, round(avg(n.bad), 6) AS rate
FROM (SELECT unnest(range(1, CAST(ceil((high - low) / step) AS BIGINT) + 1)) AS i, low, step FROM b) LEFT JOIN n ON n.bin = i GROUP BY i, low, step
""",
)
def width_bins(spark, folder):
    events = table(spark, folder, "events").select("value", (F.col("event_type") == "error").cast("int").alias("bad"))
    return shape(evaluate.width_bins(events, "value", "bad", 10), bin="bigint", low="double", high="double", volume="bigint", rate="r6")


@query(
    "score_cutoffs",
    f"""
SELECT CAST(cutoff AS BIGINT) AS cutoff, count(*) AS n, round(avg(bad), 6) AS rate
FROM ({SCORED}), (VALUES (636), (643)) AS c(cutoff)
WHERE score >= cutoff AND (cutoff = 636 OR o_orderdate >= TIMESTAMP '1999-03-01') GROUP BY 1
""",
)
def score_cutoffs(spark, folder):
    rows = scored(spark, folder)
    parts = []
    for cutoff in SCORE_CUTOFFS:
        kept = evaluate.above_cutoff(rows, "score", cutoff)
        if cutoff == SCORE_CUTOFFS[1]:
            kept = kept.where(F.col("o_orderdate") >= F.lit("1999-03-01").cast("timestamp_ntz"))
        parts.append(kept.agg(F.count("*").alias("n"), F.round(F.avg("bad"), 6).alias("rate")).withColumn("cutoff", F.lit(cutoff).cast("bigint")))
    return parts[0].unionByName(parts[1]).select("cutoff", "n", "rate")


@query(
    "union_of_scored",
    f"""
SELECT part, count(*) AS n, count(extra) AS with_extra, CAST(sum(bad) AS BIGINT) AS bad FROM (
  SELECT 'late' AS part, bad, score AS extra FROM ({SCORED}) WHERE o_orderdate >= TIMESTAMP '1999-01-01'
  UNION ALL SELECT 'early', bad, NULL FROM ({SCORED}) WHERE o_orderdate < TIMESTAMP '1999-01-01') GROUP BY 1
""",
)
def union_of_scored(spark, folder):
    rows = scored(spark, folder)
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    late = rows.where(F.col("o_orderdate") >= cut).select(F.lit("late").alias("part"), "bad", F.col("score").alias("extra"))
    early = rows.where(F.col("o_orderdate") < cut).select(F.lit("early").alias("part"), "bad")
    both = late.unionByName(early, allowMissingColumns=True)
    return both.groupBy("part").agg(F.count("*").alias("n"), F.count("extra").alias("with_extra"), F.sum("bad").alias("bad"))


FEATURES = {"price": "score", "person": "CAST(person AS DOUBLE)", "sparse": "CASE WHEN id % 3 = 0 THEN score END"}


@query(
    "feature_auc",
    f"WITH s AS ({SCORED}), l AS ("
    + " UNION ALL ".join(f"SELECT '{name}' AS feature, coalesce({body}, 0) AS value, bad FROM s" for name, body in FEATURES.items())
    + """), c AS (SELECT feature, value, CAST(sum(bad) AS DOUBLE) AS pos, CAST(sum(1 - bad) AS DOUBLE) AS neg FROM l GROUP BY 1, 2)
SELECT feature, round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 8) AS auc
FROM (SELECT *, sum(neg) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) - neg AS below FROM c) GROUP BY 1
""",
)
def feature_auc(spark, folder):
    rows = scored(spark, folder).select("bad", *[F.expr(body).alias(name) for name, body in FEATURES.items()])
    return shape(evaluate.feature_auc(rows, list(FEATURES), "bad"), feature="string", auc="r8")


# A feature that falls with the label, one that rises and falls, and noise: a tree sees all but the last.
TREE_SQL = """
SELECT o_orderkey AS id, CAST(CASE WHEN (o_totalprice + o_custkey * 300) % 50000 < o_totalprice / 12 THEN 1 ELSE 0 END AS INT) AS bad,
  floor(o_totalprice / 500) AS price, CASE WHEN (o_totalprice + o_custkey * 300) % 50000 < o_totalprice / 12 THEN 0 ELSE 40 END + o_orderkey * 7919 % 50 AS falling,
  CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice / 500) END AS sparse, o_orderkey * 104729 % 1009 AS noise, o_custkey AS person, 1 AS same
FROM {orders}
"""
TREE_FEATURES = ["price", "falling", "sparse", "noise", "person", "same"]


@query(
    "feature_tree_auc",
    f"""
WITH s AS ({TREE_SQL.replace("{orders}", "orders")}), p AS (SELECT *, CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 6) AS BIGINT) % 10 >= 3 AS train FROM s),
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(coalesce({c}, 0) AS DOUBLE) AS value, bad, train FROM p" for c in TREE_FEATURES)}),
u AS (SELECT feature, value, avg(bad) FILTER (train) AS rate, CASE WHEN count(*) FILTER (train) > 0 THEN value END AS spot,
  count(*) FILTER (NOT train AND bad = 1) AS pos, count(*) FILTER (NOT train AND bad = 0) AS neg FROM l GROUP BY 1, 2),
w AS (SELECT *, last_value(spot IGNORE NULLS) OVER below AS low, last_value(rate IGNORE NULLS) OVER below AS low_rate,
  first_value(spot IGNORE NULLS) OVER above AS high, first_value(rate IGNORE NULLS) OVER above AS high_rate FROM u
  WINDOW below AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING), above AS (PARTITION BY feature ORDER BY value ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
c AS (SELECT feature, CASE WHEN low IS NULL THEN high_rate WHEN high IS NULL THEN low_rate WHEN value <= (low + high) / 2 THEN low_rate ELSE high_rate END AS chance,
  CAST(sum(pos) AS DOUBLE) AS pos, CAST(sum(neg) AS DOUBLE) AS neg FROM w GROUP BY 1, 2),
a AS (SELECT feature, sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (PARTITION BY feature ORDER BY chance ROWS UNBOUNDED PRECEDING) AS upto FROM c) GROUP BY 1)
SELECT feature, round(auc, 8) AS auc, auc > 0.5 AS kept FROM a
""",
)
def feature_tree_auc(spark, folder):
    rows = spark.sql(TREE_SQL, orders=table(spark, folder, "orders"))
    train, test = split(rows, "id")
    return shape(evaluate.feature_tree_auc(train, test, TREE_FEATURES, "bad"), feature="string", auc="r8", kept="boolean")
