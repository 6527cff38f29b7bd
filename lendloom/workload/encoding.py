"""Split, fills, rare labels, target rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendloom.operators import encode
from lendloom.plans.training import fit_states, transform
from lendloom.plans.training import training_frame as prepare_training
from lendloom.workload.profiling import FRAME, frame
from lendloom.workload.registry import query, shape, table

BUCKET = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 6) AS BIGINT) % 10"
TRAIN = f"SELECT * FROM ({FRAME}) WHERE {BUCKET} >= 3"


@query(
    "split_counts",
    f"SELECT CASE WHEN {BUCKET} < 3 THEN 'test' ELSE 'train' END AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1",
)
def split_counts(spark, folder):
    train, test = encode.split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    named = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return named.groupBy("part").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


MISSING_SQL = f"""
WITH t AS ({TRAIN})
SELECT 'priority' AS feature, CASE WHEN count(*) FILTER (priority IS NULL) / count(*) > 0.05 THEN 'Missing' ELSE mode(priority) END AS text_fill,
  CAST(NULL AS DOUBLE) AS number_fill FROM t
UNION ALL SELECT 'few_text', (SELECT few_text FROM (SELECT CAST(few AS VARCHAR) AS few_text FROM t WHERE few IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, few_text LIMIT 1)), NULL
UNION ALL SELECT 'half_price', NULL, round(median(half_price), 6) FROM t
UNION ALL SELECT 'few', NULL, round(median(few), 6) FROM t
"""


def fill_frame(spark, folder):
    return frame(spark, folder).withColumn("few_text", F.col("few").cast("string"))


@query("missing_fit", MISSING_SQL)
def missing_fit(spark, folder):
    train, _ = encode.split(fill_frame(spark, folder), "o_orderkey")
    state = encode.fit_missing(train, ["priority", "few_text"], ["half_price", "few"])
    number = F.when(F.col("kind") == "number", F.round(F.col("value").try_cast("double"), 6))
    return state.select("feature", F.when(F.col("kind") == "text", F.col("value")).alias("text_fill"), number.alias("number_fill"))


@query(
    "missing_apply",
    f"""
WITH f AS ({FRAME}), t AS ({TRAIN}), s AS ({MISSING_SQL.replace("WITH t AS (" + TRAIN + ")", "")})
SELECT o_orderkey, coalesce(priority, (SELECT text_fill FROM s WHERE feature = 'priority')) AS priority,
  round(coalesce(half_price, (SELECT number_fill FROM s WHERE feature = 'half_price')), 4) AS half_price,
  coalesce(CAST(few AS DOUBLE), (SELECT number_fill FROM s WHERE feature = 'few')) AS few
FROM f
""",
)
def missing_apply(spark, folder):
    rows = fill_frame(spark, folder)
    train, _ = encode.split(rows, "o_orderkey")
    state = encode.fit_missing(train, ["priority", "few_text"], ["half_price", "few"])
    return shape(encode.apply_missing(rows, state), o_orderkey="bigint", priority="string", half_price="r4", few="double")


# Part brands have about 25 labels; the quantity mix below has labels under one percent.
LABELS_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_quantity < 40 THEN 'Q' || CAST(CAST(l_quantity AS INT) % 4 AS STRING) WHEN l_partkey % 20 = 0 THEN 'R' || CAST(l_partkey % 7 AS STRING)
    WHEN l_partkey % 9 = 0 THEN NULL ELSE 'big' || CAST(l_partkey % 90 AS STRING) END AS size_label,
  CASE WHEN l_partkey % 200 = 0 THEN 'X' ELSE l_returnflag END AS flag,
  CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS open_flag,
  CASE WHEN l_suppkey % 20 = 0 THEN 'D' ELSE 'A' END AS lopsided,
  CAST(CASE WHEN l_shipdate > DATE '1999-06-01' THEN 1 ELSE 0 END AS INT) AS late
FROM {lineitem}
"""
LABELS = LABELS_SQL.replace("{lineitem}", "lineitem")
LABEL_COLUMNS = ["size_label", "flag", "open_flag", "lopsided"]


def label_frame(spark, folder):
    return spark.sql(LABELS_SQL, lineitem=table(spark, folder, "lineitem"))


def _frequent(column: str, replacement: str) -> str:
    return (
        f"SELECT '{column}' AS feature, {column} AS label, '{replacement}' AS replacement FROM t WHERE {column} IS NOT NULL GROUP BY 2 "
        f"HAVING count(*) / (SELECT count(*) FROM t) > 0.01"
    )


RARE_BODY = f"""
{_frequent("size_label", "rare")}
UNION ALL SELECT 'size_label', 'rare', 'rare' FROM (SELECT count(*) AS n FROM t WHERE size_label IS NULL OR size_label NOT IN
  (SELECT size_label FROM t WHERE size_label IS NOT NULL GROUP BY 1 HAVING count(*) / (SELECT count(*) FROM t) > 0.01)) WHERE n / (SELECT count(*) FROM t) > 0.01
UNION ALL SELECT feature, label, (SELECT flag FROM t GROUP BY 1 ORDER BY count(*) DESC, flag LIMIT 1) FROM ({_frequent("flag", "")})
UNION ALL {_frequent("open_flag", "rare")}
UNION ALL {_frequent("lopsided", "rare")}
"""
RARE_STATE = f"WITH t AS ({LABELS}) {RARE_BODY}"
# the same after filling: a mode below five percent of missing values, else 'Missing'
FILLED = f"""
SELECT * REPLACE (coalesce(size_label, (SELECT CASE WHEN avg(CASE WHEN size_label IS NULL THEN 1 ELSE 0 END) > 0.05 THEN 'Missing' ELSE
  (SELECT size_label FROM ({LABELS}) WHERE size_label IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, size_label LIMIT 1) END FROM ({LABELS}))) AS size_label)
FROM ({LABELS})
"""


@query("rare_fit", RARE_STATE)
def rare_fit(spark, folder):
    return encode.fit_rare(label_frame(spark, folder), LABEL_COLUMNS).where("label IS NOT NULL").select("feature", "label", "replacement")


MERGED = f"""
SELECT CASE WHEN size_label IN (SELECT label FROM s WHERE feature = 'size_label') THEN size_label ELSE 'rare' END AS size_label,
  CASE WHEN flag IN (SELECT label FROM s WHERE feature = 'flag') THEN flag ELSE (SELECT max(replacement) FROM s WHERE feature = 'flag') END AS flag,
  open_flag, lopsided, late FROM l
"""


@query(
    "rare_apply",
    f"""
WITH l AS ({LABELS}), s AS ({RARE_STATE})
SELECT size_label, flag, count(*) AS n, CAST(sum(late) AS BIGINT) AS late FROM ({MERGED}) GROUP BY 1, 2
""",
)
def rare_apply(spark, folder):
    rows = label_frame(spark, folder)
    merged = encode.apply_rare(rows, encode.fit_rare(rows, LABEL_COLUMNS))
    return merged.groupBy("size_label", "flag").agg(F.count("*").alias("n"), F.sum("late").alias("late"))


@query(
    "scarce_binary",
    f"""
WITH l AS ({LABELS})
SELECT feature FROM (SELECT 'open_flag' AS feature, min(n) / sum(n) AS least FROM (SELECT count(*) AS n FROM l GROUP BY open_flag)
  UNION ALL SELECT 'lopsided', min(n) / sum(n) FROM (SELECT count(*) AS n FROM l GROUP BY lopsided)) WHERE least < 0.2
""",
)
def scarce_binary(spark, folder):
    found = encode.scarce_binary(label_frame(spark, folder), ["size_label", "open_flag", "lopsided"])
    return spark.createDataFrame([(name,) for name in found], "feature string")


@query(
    "target_rates",
    f"""
WITH l AS ({FILLED}), s AS (WITH t AS ({FILLED}) {RARE_BODY}), m AS ({MERGED})
SELECT 'size_label' AS feature, size_label AS label, round(avg(late), 6) AS rate FROM m GROUP BY 2
UNION ALL SELECT 'flag', flag, round(avg(late), 6) FROM m GROUP BY 2
UNION ALL SELECT 'open_flag', open_flag, round(avg(late), 6) FROM m GROUP BY 2
""",
)
def target_rates(spark, folder):
    state = fit_states(label_frame(spark, folder), LABEL_COLUMNS, [], "late")
    assert state.dropped == ["lopsided"]
    return shape(state.target, feature="string", label="string", rate="r6")


@query(
    "target_encode",
    f"""
WITH l AS ({FILLED}), s AS (WITH t AS ({FILLED}) {RARE_BODY}), m AS ({MERGED}),
  a AS (SELECT size_label, avg(late) AS rate FROM m GROUP BY 1), b AS (SELECT flag, avg(late) AS rate FROM m GROUP BY 1)
SELECT round(a.rate, 6) AS size_rate, round(b.rate, 6) AS flag_rate, count(*) AS n FROM m JOIN a USING (size_label) JOIN b USING (flag) GROUP BY 1, 2
""",
)
def target_encode(spark, folder):
    rows = label_frame(spark, folder)
    encoded = transform(rows, fit_states(rows, LABEL_COLUMNS, [], "late"))
    rounded = encoded.select(F.round("size_label", 6).alias("size_rate"), F.round("flag", 6).alias("flag_rate"))
    return rounded.groupBy("size_rate", "flag_rate").agg(F.count("*").alias("n"))


@query(
    "target_encode_unseen",
    """
WITH r AS (SELECT p_type, p_brand, CAST(p_size > 25 AS INT) AS big FROM part),
  s AS (SELECT p_brand, avg(big) AS rate FROM r WHERE p_type <> 'PROMO' GROUP BY 1), u AS (SELECT DISTINCT p_type, p_brand FROM r)
SELECT u.p_type, u.p_brand, round(s.rate, 6) AS rate FROM u LEFT JOIN s USING (p_brand)
""",
)
def target_encode_unseen(spark, folder):
    parts = table(spark, folder, "part").select("p_type", "p_brand", (F.col("p_size") > 25).cast("int").alias("big"))
    state = encode.fit_target(parts.where("p_type <> 'PROMO'"), ["p_brand"], "big")
    seen = parts.select("p_type", "p_brand", F.col("p_brand").alias("rate")).distinct()
    return shape(encode.apply_target(seen, state.withColumn("feature", F.lit("rate"))), p_type="string", p_brand="string", rate="r6")


RATES = "(SELECT {expr} AS label, avg(bad) AS rate FROM t GROUP BY 1)"


@query(
    "training_frame",
    f"""
WITH f AS ({FRAME}), t0 AS ({TRAIN}), mode AS (SELECT few FROM t0 WHERE few IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, CAST(CAST(few AS DOUBLE) AS VARCHAR) LIMIT 1),
  t AS (SELECT * REPLACE (coalesce(priority, 'Missing') AS priority, coalesce(few, (SELECT few FROM mode)) AS few) FROM t0),
  x AS (SELECT * REPLACE (coalesce(priority, 'Missing') AS priority, coalesce(few, (SELECT few FROM mode)) AS few) FROM f WHERE {BUCKET} < 3)
SELECT o_orderkey, bad, round(a.rate, 6) AS priority, round(b.rate, 6) AS status, round(c.rate, 6) AS few, round(price, 4) AS price, CAST(visits AS DOUBLE) AS visits,
  'few,price,priority,status,visits' AS features
FROM x JOIN {RATES.format(expr="priority")} a ON a.label = x.priority JOIN {RATES.format(expr="status")} b ON b.label = x.status JOIN {RATES.format(expr="few")} c ON c.label = x.few
""",
)
def training_frame(spark, folder):
    """Test rows after column selection, split, fills, merging and encoding; and the features that are left."""
    _, test, _, features = prepare_training(frame(spark, folder), "o_orderkey", "bad", excluded=["unused"])
    rows = test.withColumn("features", F.lit(",".join(sorted(features))))
    kinds = {"priority": "r6", "status": "r6", "few": "r6", "price": "r4", "visits": "double"}
    return shape(rows, o_orderkey="bigint", bad="int", **kinds, features="string")
