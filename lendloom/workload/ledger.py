"""Ledger sums, payments that stood, default labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendloom.functions.labels import default_flags
from lendloom.operators import ledger as ops
from lendloom.plans.leads import account_facts, card_counts
from lendloom.workload.registry import query, shape, table
from lendloom.workload.star import PARAMS, star, with_star

ROLLUP_SQL = """
SELECT ss, CAST(sum(CASE WHEN strpos(lower(type), 'pay') > 0 THEN 1 ELSE 0 END) AS BIGINT) AS payment_count,
  CAST(sum(CASE WHEN lower(type) = 'renewal' THEN 1 ELSE 0 END) AS BIGINT) AS renewal_count,
  CAST(sum(CASE WHEN lower(type) = 'active -> written off' THEN 1 ELSE 0 END) AS BIGINT) AS write_off_count,
  CAST(sum(CASE WHEN lower(type) = 'active -> written off' THEN net ELSE 0 END) AS DOUBLE) AS written_off,
  CAST(sum(CASE WHEN lower(type) IN ('new loan', 'loan increase', 'renewal') THEN net ELSE 0 END) AS DOUBLE) AS total_lent,
  CAST(sum(CASE WHEN lower(type) = 'new loan' THEN net ELSE 0 END) AS DOUBLE) AS new_loan_amount,
  CAST(sum(CASE WHEN strpos(lower(type), 'pay') > 0 OR lower(type) = 'return' THEN paidprin ELSE 0 END) AS DOUBLE) AS principal_paid,
  CAST(sum(CASE WHEN strpos(lower(type), 'pay') > 0 OR lower(type) = 'return' THEN paidint ELSE 0 END) AS DOUBLE) AS interest_paid,
  CAST(sum(CASE WHEN strpos(lower(type), 'pay') > 0 OR lower(type) = 'return' THEN payment ELSE 0 END) AS DOUBLE) AS total_paid
FROM ledger GROUP BY ss
"""
AMOUNTS = ("written_off", "total_lent", "new_loan_amount", "principal_paid", "interest_paid", "total_paid")
COUNTS = ("payment_count", "renewal_count", "write_off_count")

FIRST_SQL = """
SELECT ss, id AS first_payment_id, dte AS first_payment_date FROM (
  SELECT p.ss, p.id, p.dte, row_number() OVER (PARTITION BY p.ss ORDER BY p.id) AS rn FROM ledger p
  WHERE strpos(lower(p.type), 'payment') > 0 AND strpos(lower(p.type), 'reverted pay') = 0
    AND NOT EXISTS (SELECT 1 FROM ledger r WHERE r.reference_id = p.id))
WHERE rn = 1
"""

DEBIT_SQL = """
SELECT account_id, CASE WHEN lower(status) = 'return' THEN 'Y' ELSE 'N' END AS returned, return_code FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY id) AS rn FROM ach_status WHERE lower(type) = 'd') WHERE rn = 1
"""


@query("ledger_rollup", with_star(ROLLUP_SQL, "ledger"))
def ledger_rollup(spark, folder):
    rolled = ops.ledger_rollup(star(spark, folder, "ledger")["ledger"])
    return shape(rolled, ss="string", **{c: "bigint" for c in COUNTS}, **{c: "double" for c in AMOUNTS})


@query(
    "first_unreverted_payment",
    with_star(f"SELECT ss, first_payment_id, strftime(first_payment_date, '%Y-%m-%d') AS first_payment_date FROM ({FIRST_SQL})", "ledger"),
)
def first_unreverted_payment(spark, folder):
    found = ops.first_payment(star(spark, folder, "ledger")["ledger"])
    renamed = found.select("ss", F.col("id").alias("first_payment_id"), F.col("dte").alias("first_payment_date"))
    return shape(renamed, ss="string", first_payment_id="bigint", first_payment_date="day")


@query(
    "unreverted_entries",
    with_star(
        """
SELECT type, count(*) AS n, CAST(sum(payment) AS DOUBLE) AS paid FROM ledger p
WHERE NOT EXISTS (SELECT 1 FROM ledger r WHERE r.reference_id = p.id) GROUP BY type
""",
        "ledger",
    ),
)
def unreverted_entries(spark, folder):
    rows = ops.unreverted(star(spark, folder, "ledger")["ledger"].select("id", "type", "payment", "reference_id"))
    return rows.groupBy("type").agg(F.count("*").alias("n"), F.sum("payment").cast("double").alias("paid"))


@query("first_debit", with_star(DEBIT_SQL, "ach_status"))
def first_debit(spark, folder):
    return ops.first_debit(star(spark, folder, "ach_status")["ach_status"])


@query("last_entry_type", with_star("SELECT ss, arg_max(type, id) AS last_entry_type FROM ledger GROUP BY ss", "ledger"))
def last_entry_type(spark, folder):
    return ops.last_entry_type(star(spark, folder, "ledger")["ledger"])


@query(
    "card_counts",
    with_star(
        "SELECT m.account_id, count(*) AS card_count FROM applicant_mapping m JOIN credit_card c ON c.mapping_id = m.mapping_id GROUP BY 1",
        "applicant_mapping", "credit_card",
    ),
)
def cards(spark, folder):
    return shape(card_counts(star(spark, folder, "applicant_mapping", "credit_card")), account_id="bigint", card_count="bigint")


DEFAULT_SQL = f"""
SELECT a.id, CAST(CASE WHEN DATE '2001-06-30' - a.date_due > 7 THEN 1 ELSE 0 END AS BIGINT) AS cycled,
  CAST(CASE WHEN r.total_paid = 0 AND DATE '2001-06-30' - a.date_due > 7 THEN 1 ELSE 0 END AS BIGINT) AS defaulted,
  CAST(CASE WHEN d.returned = 'Y' AND d.return_code NOT IN ('R01', 'R09', 'R99') THEN 1 ELSE 0 END AS BIGINT) AS failed_first_payment,
  CAST(CASE WHEN f.first_payment_id IS NULL AND DATE '2001-06-30' - a.date_due > 7 THEN 1
    WHEN f.first_payment_id IS NOT NULL AND f.first_payment_date - a.date_due > 7 THEN 1 ELSE 0 END AS BIGINT) AS first_payment_default,
  CAST(CASE WHEN r.payment_count = 1 AND r.renewal_count = 0 AND r.new_loan_amount - r.principal_paid > 0
    AND DATE '2001-06-30' - c.date_due > 7 THEN 1 ELSE 0 END AS BIGINT) AS one_payment_default
FROM applicant a JOIN account c ON c.id = a.id LEFT JOIN ({ROLLUP_SQL}) r ON r.ss = c.social
  LEFT JOIN ({FIRST_SQL}) f ON f.ss = c.social LEFT JOIN ({DEBIT_SQL}) d ON d.account_id = c.id
"""
DEFAULT_TABLES = ("applicant", "account", "ledger", "ach_status", "applicant_mapping", "credit_card")


def labelled(spark, folder):
    """Applications with their default labels."""
    c = F.col
    t = star(spark, folder, *DEFAULT_TABLES)
    people = t["applicant"].select("id", "date_due")
    joined = people.join(account_facts(t).withColumnRenamed("account_id", "id"), "id")
    rollup = {k: c(k) for k in ("total_paid", "payment_count", "renewal_count", "new_loan_amount", "principal_paid")}
    flags = default_flags(
        c("date_due"), c("account_due"), c("first_payment_date"), c("first_payment_id"), rollup, c("returned"), c("return_code"), F.lit(PARAMS.as_of)
    )
    return joined.select("id", *[column.cast("bigint").alias(name) for name, column in flags.items()])


def first_payment_labels(spark, folder):
    """The two labels that need nothing but the first payment."""
    c = F.col
    t = star(spark, folder, "applicant", "account", "ledger")
    paid = ops.first_payment(t["ledger"]).select(c("ss").alias("social"), c("id").alias("payment_id"), c("dte").alias("payment_date"))
    accounts = t["account"].select("id", "social").join(paid, "social", "left")
    rows = t["applicant"].select("id", "date_due").join(accounts, "id")
    unused = {k: F.lit(None) for k in ("total_paid", "payment_count", "renewal_count", "new_loan_amount", "principal_paid")}
    flags = default_flags(c("date_due"), F.lit(None), c("payment_date"), c("payment_id"), unused, F.lit(None), F.lit(None), F.lit(PARAMS.as_of))
    return rows.select("id", *[flags[name].cast("bigint").alias(name) for name in ("cycled", "first_payment_default")])


@query("default_labels", with_star(DEFAULT_SQL, *DEFAULT_TABLES))
def default_labels(spark, folder):
    return labelled(spark, folder)


@query(
    "default_rate_by_segment",
    with_star(
        f"""
SELECT c_mktsegment AS segment, count(*) AS applications, CAST(sum(first_payment_default) AS BIGINT) AS defaults,
  round(sum(first_payment_default) / count(*), 6) AS default_rate
FROM ({DEFAULT_SQL}) JOIN orders ON o_orderkey = id JOIN customer ON c_custkey = o_custkey WHERE cycled = 1 GROUP BY 1
""",
        *DEFAULT_TABLES,
    ),
)
def default_rate_by_segment(spark, folder):
    cycled = first_payment_labels(spark, folder).where("cycled = 1").select(F.col("id").alias("o_orderkey"), "first_payment_default")
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    per_customer = cycled.join(orders, "o_orderkey").groupBy("c_custkey").agg(
        F.count("*").alias("n"), F.sum("first_payment_default").alias("bad")
    )
    segments = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    grouped = per_customer.join(segments, "c_custkey").groupBy("segment").agg(F.sum("n").alias("applications"), F.sum("bad").alias("defaults"))
    return grouped.withColumn("default_rate", F.round(F.col("defaults") / F.col("applications"), 6))
