"""Running history of a person."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendloom.operators import history as ops
from lendloom.operators.skew import enrich
from lendloom.workload.registry import query, shape
from lendloom.workload.star import star, with_star

HISTORY_SQL = """
SELECT a.id, CASE WHEN a.social IS NULL THEN 0 ELSE count(*) OVER w END AS times_applied,
  CASE WHEN a.social IS NULL THEN NULL ELSE CAST(min(CAST(replace(a.salary, '$', '') AS DECIMAL(22,8))) OVER w AS DOUBLE) END AS min_salary,
  CASE WHEN a.social IS NULL THEN NULL ELSE lag(a.type) OVER (PARTITION BY a.social ORDER BY a.id) END AS previous_type
FROM applicant a WINDOW w AS (PARTITION BY a.social ORDER BY a.id ROWS UNBOUNDED PRECEDING)
"""


@query("running_applications", with_star(HISTORY_SQL, "applicant"))
def running_applications(spark, folder):
    people = star(spark, folder, "applicant")["applicant"].select("id", "social", "salary", "type")
    return shape(ops.application_history(people), id="bigint", times_applied="bigint", min_salary="double", previous_type="string")


@query("running_applications_chunked", with_star(HISTORY_SQL, "applicant"))
def running_applications_chunked(spark, folder):
    """The same through the path for persons too large for one task."""
    people = star(spark, folder, "applicant")["applicant"].select("id", "social", "salary", "type")
    rows = ops.application_history(people, rows_per_task=500)
    return shape(rows, id="bigint", times_applied="bigint", min_salary="double", previous_type="string")


@query(
    "prior_applicants",
    with_star(
        """
SELECT l.lead_id, CAST(coalesce(p.n, 0) AS BIGINT) AS prior_count, coalesce(p.last_type, '') AS prior_type
FROM lead_log l JOIN applicant own ON own.id = l.applicant_id
  LEFT JOIN LATERAL (SELECT count(*) AS n, arg_max(a.type, a.id) AS last_type FROM applicant a
    WHERE a.social = own.social AND a.dte < CAST(l.lead_ts AS DATE)) p ON true
""",
        "lead_log", "applicant",
    ),
)
def prior_applicants(spark, folder):
    t = star(spark, folder, "lead_log", "applicant")
    owners = t["applicant"].select(F.col("id").alias("applicant_id"), "social")
    leads = enrich(t["lead_log"].select("lead_id", "applicant_id", "lead_ts"), owners, "applicant_id", "inner")
    return shape(ops.prior_applications(leads, t["applicant"]), lead_id="bigint", prior_count="bigint", prior_type="string")


@query(
    "own_prior_application",
    with_star(
        """
SELECT l.lead_id, CAST(CASE WHEN p.n = 0 THEN 1 ELSE p.n END AS BIGINT) AS total_applicants, coalesce(s.type, '') AS last_applicant_status
FROM lead_log l LEFT JOIN auto_failure_x_applicant b ON b.applicant_id = l.applicant_id,
  LATERAL (SELECT count(*) AS n FROM applicant a WHERE a.id = b.applicant_id AND a.social = a.social AND a.dte < CAST(l.lead_ts AS DATE)) p
  LEFT JOIN LATERAL (SELECT a.type FROM applicant a WHERE a.id = b.applicant_id AND a.social = a.social AND a.dte < CAST(l.lead_ts AS DATE)
    ORDER BY a.id DESC LIMIT 1) s ON true
""",
        "lead_log", "applicant", "auto_failure_x_applicant",
    ),
)
def own_prior_application(spark, folder):
    t = star(spark, folder, "lead_log", "applicant", "auto_failure_x_applicant")
    failures = t["auto_failure_x_applicant"].select("applicant_id", F.col("applicant_id").alias("failure_applicant_id"))
    leads = enrich(t["lead_log"].select("lead_id", "lead_ts", "applicant_id"), failures, "applicant_id", "left", hot=None)
    found = ops.own_prior_application(leads, t["applicant"])
    return shape(found, lead_id="bigint", total_applicants="bigint", last_applicant_status="string")
