"""Column profiles, tests and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendloom.operators import profile
from lendloom.workload.registry import query, shape, table

# Orders with missing values, a constant, and a near-constant column.
FRAME_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 3 THEN NULL ELSE o_orderpriority END AS priority, o_orderstatus AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice END AS half_price, 'same' AS constant,
  CASE WHEN o_orderkey % 25 = 0 THEN 'odd' ELSE 'usual' END AS mostly, o_totalprice AS price, o_custkey % 40 AS visits,
  CASE WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_custkey % 7 END AS few,
  CAST(CASE WHEN (o_orderkey * 31 + o_custkey) % 11 < 4 THEN 1 ELSE 0 END AS INT) AS bad
FROM {orders}
"""
COLUMNS = ["priority", "status", "half_price", "constant", "mostly", "price", "visits", "few"]
TEXTS = ["priority", "status", "mostly"]
NUMBERS = ["half_price", "price", "visits", "few"]
FRAME = FRAME_SQL.replace("{orders}", "orders")


def frame(spark, folder):
    return spark.sql(FRAME_SQL, orders=table(spark, folder, "orders"))


def _each(columns, body: str) -> str:
    """``body`` once per column, {c} standing for the name."""
    return f"WITH f AS ({FRAME}) " + " UNION ALL ".join(body.replace("{c}", c) for c in columns)


@query("null_ratios", _each(COLUMNS, "SELECT '{c}' AS feature, round(count(*) FILTER ({c} IS NULL) / count(*), 6) AS null_ratio FROM f"))
def null_ratios(spark, folder):
    return shape(profile.null_ratios(frame(spark, folder), COLUMNS), feature="string", null_ratio="r6")


@query(
    "value_shares",
    _each(
        TEXTS + ["constant", "visits", "few"],
        "SELECT '{c}' AS feature, (SELECT count(DISTINCT {c}) FROM f) AS distinct_labels, v AS top_label, round(n / (SELECT count(*) FROM f), 6) AS max_share, "
        "CAST((SELECT max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM f) AS BIGINT) AS has_null "
        "FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM f WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)",
    ),
)
def value_shares(spark, folder):
    rows = profile.value_shares(frame(spark, folder), TEXTS + ["constant", "visits", "few"])
    return shape(rows, feature="string", distinct_labels="bigint", top_label="string", max_share="r6", has_null="bigint")


SUMMARY_SQL = _each(
    NUMBERS,
    "SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    "round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
    "CAST(max({c}) AS DOUBLE) AS max FROM f",
)


def _summary(spark, folder, **limits):
    rows = profile.numeric_summary(frame(spark, folder), NUMBERS, **limits)
    return shape(rows, feature="string", n="bigint", mean="r4", std="r4", min="double", q25="r6", q50="r6", q75="r6", max="double")


@query("numeric_summary", SUMMARY_SQL)
def numeric_summary(spark, folder):
    return _summary(spark, folder)


@query("numeric_summary_chunked", SUMMARY_SQL)
def numeric_summary_chunked(spark, folder):
    """The same through the path for columns with too many values for one task."""
    return _summary(spark, folder, rows_per_task=500)


@query(
    "text_summary",
    _each(
        TEXTS,
        "SELECT '{c}' AS feature, (SELECT count({c}) FROM f) AS n, (SELECT count(DISTINCT {c}) FROM f) AS unique_labels, v AS top, n AS freq "
        "FROM (SELECT {c} AS v, count(*) AS n FROM f WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)",
    ),
)
def text_summary(spark, folder):
    return shape(profile.text_summary(frame(spark, folder), TEXTS), feature="string", n="bigint", unique_labels="bigint", top="string", freq="bigint")


@query("distinct_labels", _each(TEXTS + ["few"], "SELECT DISTINCT '{c}' AS feature, CAST({c} AS VARCHAR) AS label FROM f"))
def distinct_labels(spark, folder):
    return profile.labels_of(frame(spark, folder), TEXTS + ["few"])


@query(
    "label_rates",
    _each(
        TEXTS,
        "SELECT '{c}' AS feature, {c} AS label, count(*) AS n, round(count(*) / (SELECT count(*) FROM f), 6) AS share, round(avg(bad), 6) AS bad_rate "
        "FROM f WHERE {c} IS NOT NULL GROUP BY {c}",
    ),
)
def label_rates(spark, folder):
    return shape(profile.label_rates(frame(spark, folder), TEXTS, "bad"), feature="string", label="string", n="bigint", share="r6", bad_rate="r6")


@query(
    "contingency",
    _each(
        TEXTS,
        "SELECT '{c}' AS feature, coalesce({c}, 'All') AS label, CAST(sum(1 - bad) AS BIGINT) AS good, CAST(sum(bad) AS BIGINT) AS bad, count(*) AS total "
        "FROM f WHERE {c} IS NOT NULL GROUP BY ROLLUP ({c})",
    ),
)
def contingency(spark, folder):
    rows = profile.contingency(frame(spark, folder), TEXTS, "bad")
    return shape(rows, feature="string", label="string", good="bigint", bad="bigint", total="bigint")


CHI_SQL = _each(
    TEXTS + ["few", "constant"],
    """
SELECT '{c}' AS feature, round(coalesce(sum(CASE WHEN k - 1 = 1 THEN power(greatest(abs(bad - eb) - 0.5, 0), 2) / eb + power(greatest(abs(good - eg) - 0.5, 0), 2) / eg
    ELSE power(bad - eb, 2) / eb + power(good - eg, 2) / eg END), 0), 6) AS statistic, CAST(max(k - 1) AS BIGINT) AS dof,
  CAST(max(CASE WHEN rn = 2 AND bad > good THEN 1 ELSE 0 END) AS BIGINT) AS possibly_useful
FROM (SELECT *, (bad + good) * sum(bad) OVER () / sum(bad + good) OVER () AS eb, (bad + good) * sum(good) OVER () / sum(bad + good) OVER () AS eg,
    count(*) OVER () AS k, row_number() OVER (ORDER BY label) AS rn
  FROM (SELECT CAST({c} AS VARCHAR) AS label, CAST(sum(bad) AS DOUBLE) AS bad, CAST(sum(1 - bad) AS DOUBLE) AS good FROM f WHERE {c} IS NOT NULL GROUP BY 1))
""",
)


@query("chi_square", CHI_SQL)
def chi_square(spark, folder):
    rows = profile.chi_square(frame(spark, folder), TEXTS + ["few", "constant"], "bad")
    return shape(rows, feature="string", statistic="r6", dof="bigint", possibly_useful="bigint")


# Half-integer gamma functions and the power series of the lower incomplete one, term by term.
TAIL_SQL = """
CASE WHEN dof < 1 OR statistic <= 0 THEN 1 ELSE greatest(0, 1 - list_sum(list_transform(range(0, 400),
  lambda n: exp((dof / 2 + n) * ln(statistic / 2) - statistic / 2 - lgamma(dof / 2 + n + 1))))) END
"""


@query(
    "chi_square_selection",
    f"SELECT feature, statistic, dof, round(p, 6) AS p_value, possibly_useful, p <= 0.05 AS selected FROM (SELECT *, {TAIL_SQL} AS p FROM ({CHI_SQL}))",
)
def chi_square_selection(spark, folder):
    rows = profile.chi_square_selection(frame(spark, folder), TEXTS + ["few", "constant"], "bad")
    return shape(rows, feature="string", statistic="r6", dof="bigint", p_value="r6", possibly_useful="bigint", selected="boolean")


@query(
    "heavy_labels",
    _each(
        [*COLUMNS, "o_orderkey"],
        "SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS label, count(*) AS n, CAST(sum(bad) AS BIGINT) AS bad, (SELECT count(*) FROM f) AS rows FROM f "
        "WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) >= 0.05 * (SELECT count(*) FROM f)",
    ),
)
def heavy_labels(spark, folder):
    """Labels with a twentieth of the rows or more, of columns that hold ids and prices too."""
    return profile.heavy_labels(frame(spark, folder), [*COLUMNS, "o_orderkey"], 0.05, "bad").select("feature", "label", "n", "bad", "rows")


@query(
    "minority_bad_rate",
    f"""
WITH f AS ({FRAME})
SELECT feature, round(max_share, 6) AS max_share, round(ln(rest / top), 6) AS log_ratio FROM (
  SELECT 'mostly' AS feature, count(*) FILTER (mostly = 'usual') / count(*) AS max_share, avg(bad) FILTER (mostly <> 'usual') AS rest,
    avg(bad) FILTER (mostly = 'usual') AS top FROM f)
""",
)
def minority_bad_rate(spark, folder):
    rows = profile.minority_bad_rate(frame(spark, folder), TEXTS + ["few"], "bad")
    return shape(rows, feature="string", max_share="r6", log_ratio="r6")


@query("mode_labels", _each(TEXTS, "SELECT '{c}' AS feature, v AS mode FROM (SELECT {c} AS v FROM f WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)"))
def mode_labels(spark, folder):
    return profile.mode_labels(frame(spark, folder), TEXTS)


NUMERIC_KINDS = ("half_price", "price", "visits", "few")
SELECTION_SQL = _each(
    COLUMNS,
    "SELECT '{c}' AS feature, CASE WHEN n = 0 OR (d = 1 AND n = rows) OR rows - n > 0.4 * rows THEN 'dropped' WHEN top >= 0.9 * rows THEN 'near_constant' "
    "WHEN d >= 10 AND '{c}' IN " + str(NUMERIC_KINDS) + " THEN 'numerical' ELSE 'categorical' END AS role "
    "FROM (SELECT (SELECT count(*) FROM f) AS rows, count({c}) AS n, count(DISTINCT {c}) AS d, "
    "(SELECT max(k) FROM (SELECT count(*) AS k FROM f WHERE {c} IS NOT NULL GROUP BY {c})) AS top FROM f)",
)


@query("column_selection", SELECTION_SQL)
def column_selection(spark, folder):
    rows = frame(spark, folder).drop("o_orderkey")
    dropped = profile.droppable_columns(rows)
    rest = rows.drop(*dropped)
    categorical, numerical, constant = profile.split_columns(rest, "bad")
    flat = profile.near_constant_columns(rest, [c for c in rest.columns if c != "bad"])
    roles = {name: "categorical" for name in categorical} | {name: "numerical" for name in numerical}
    roles |= {name: "near_constant" for name in flat} | {name: "dropped" for name in [*dropped, *constant]}
    return spark.createDataFrame([(k, v) for k, v in roles.items() if k != "bad"], "feature string, role string")


@query(
    "common_columns",
    "SELECT o_orderkey, o_orderstatus, CAST(1 AS BIGINT) AS side FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, 2 FROM orders WHERE o_orderstatus = 'F'",
)
def common_columns(spark, folder):
    orders = table(spark, folder, "orders")
    left, right = profile.common_columns(
        orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), orders.where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey", "o_custkey")
    )
    return left.withColumn("side", F.lit(1).cast("bigint")).unionByName(right.withColumn("side", F.lit(2).cast("bigint")))
