"""Lookups in vendor logs, notes and inquiries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendloom.operators import intervals
from lendloom.operators.lookups import first_by, keep_last, last_by
from lendloom.plans import leads as lead_plan
from lendloom.workload.registry import query, shape, table
from lendloom.workload.star import PARAMS, star, with_star


@query(
    "latest_identity_check",
    with_star(
        """
SELECT applicant_id, status AS identity_status, CAST(fraud_score AS BIGINT) AS fraud_score FROM (
  SELECT *, row_number() OVER (PARTITION BY applicant_id ORDER BY response_ts DESC, status DESC, fraud_score DESC) AS rn FROM identity_log)
WHERE rn = 1
""",
        "identity_log",
    ),
)
def latest_identity_check(spark, folder):
    log = star(spark, folder, "identity_log")["identity_log"]
    found = last_by(log, "applicant_id", ["response_ts", "status", "fraud_score"], ["status", "fraud_score"])
    return shape(found.withColumnRenamed("status", "identity_status"), applicant_id="bigint", identity_status="string", fraud_score="bigint")


@query(
    "keep_last_per_person",
    """
SELECT event_id, user_id, event_type, round(value, 4) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
  FROM (SELECT event_id, user_id, event_type, value, CASE WHEN event_type = 'error' AND value > 300 THEN NULL ELSE ts END AS ts FROM events))
WHERE rn = 1
""",
)
def keep_last_per_person(spark, folder):
    failed = (F.col("event_type") == "error") & (F.col("value") > 300)
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", F.when(~failed, F.col("ts")).alias("ts"))
    return shape(keep_last(events, "user_id", "ts", "event_id"), event_id="bigint", user_id="bigint", event_type="string", value="r4")


@query("open_transactions", with_star("SELECT applicant_id, min(id) AS id FROM open_transact_log GROUP BY 1", "open_transact_log"))
def open_transactions(spark, folder):
    return first_by(star(spark, folder, "open_transact_log")["open_transact_log"], "applicant_id", "id", ["id"])


@query(
    "bureau_lookups",
    with_star(
        """
SELECT p.applicant_id, b.id AS bureau_response_id, b.store_id AS bureau_store_id, CAST(b.risk_score AS DOUBLE) AS risk_score,
  m.store_id AS military_store_id, CAST(c.risk_score AS DOUBLE) AS credit_risk_score
FROM (SELECT DISTINCT applicant_id FROM bureau_response) p
  LEFT JOIN LATERAL (SELECT * FROM bureau_response r WHERE r.applicant_id = p.applicant_id AND r.store_id <> '0020' ORDER BY id LIMIT 1) b ON true
  LEFT JOIN LATERAL (SELECT * FROM bureau_response r WHERE r.applicant_id = p.applicant_id AND r.store_id = '0020' ORDER BY id LIMIT 1) m ON true
  LEFT JOIN LATERAL (SELECT * FROM bureau_response r WHERE r.applicant_id = p.applicant_id AND r.store_id = '0030' ORDER BY id LIMIT 1) c ON true
""",
        "bureau_response",
    ),
)
def bureau_lookups(spark, folder):
    found = lead_plan.bureau_lookups(star(spark, folder, "bureau_response"), PARAMS)
    return shape(
        found, applicant_id="bigint", bureau_response_id="bigint", bureau_store_id="string", risk_score="double",
        military_store_id="string", credit_risk_score="double",
    )


@query(
    "first_store_record",
    with_star(
        "SELECT applicant_id, CAST(arg_min(store_id, id) AS BIGINT) AS store_id, CAST(arg_min(score, id) AS BIGINT) AS score, "
        "CAST(arg_min(paid_off, id) AS BIGINT) AS paid_off FROM store_two GROUP BY 1",
        "store_two",
    ),
)
def first_store_record(spark, folder):
    found = first_by(star(spark, folder, "store_two")["store_two"], "applicant_id", "id", ["store_id", "score", "paid_off"])
    return shape(found, applicant_id="bigint", store_id="bigint", score="bigint", paid_off="bigint")


@query(
    "model_lookups",
    with_star(
        """
SELECT p.applicant_id, a.model AS tracked_model, CAST(a.store_id AS DOUBLE) AS tracked_store_id,
  b.decision AS first_model_decision, m.decision AS last_model_decision
FROM (SELECT DISTINCT applicant_id FROM model_tracking) p
  LEFT JOIN LATERAL (SELECT * FROM model_tracking r WHERE r.applicant_id = p.applicant_id ORDER BY id LIMIT 1) a ON true
  LEFT JOIN LATERAL (SELECT * FROM model_tracking r WHERE r.applicant_id = p.applicant_id AND model = 'bureau' ORDER BY id LIMIT 1) b ON true
  LEFT JOIN LATERAL (SELECT * FROM model_tracking r WHERE r.applicant_id = p.applicant_id AND model = 'Military' ORDER BY id DESC LIMIT 1) m ON true
""",
        "model_tracking",
    ),
)
def model_lookups(spark, folder):
    found = lead_plan.model_lookups(star(spark, folder, "model_tracking"), PARAMS)
    return shape(
        found, applicant_id="bigint", tracked_model="string", tracked_store_id="double", first_model_decision="string", last_model_decision="string"
    )


NOTES_SQL = """
SELECT h.cust_id AS applicant_id, h.note_ts AS human_note_ts, b.note_ts AS bot_note_ts,
  date_diff('minute', date_trunc('minute', b.note_ts), date_trunc('minute', h.note_ts)) AS response_minutes,
  date_diff('second', date_trunc('second', b.note_ts), date_trunc('second', h.note_ts)) AS response_seconds
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cust_id ORDER BY id) AS rn FROM app_notes WHERE submitted_by <> 'bot') WHERE rn = 1) h
  LEFT JOIN LATERAL (SELECT note_ts FROM app_notes n WHERE n.cust_id = h.cust_id AND submitted_by = 'bot' AND n.id < h.id ORDER BY n.id DESC LIMIT 1) b ON true
"""


@query(
    "bot_to_human_response",
    with_star(
        f"""
SELECT applicant_id, strftime(human_note_ts, '%Y-%m-%d %H:%M:%S') AS human_note_ts, strftime(bot_note_ts, '%Y-%m-%d %H:%M:%S') AS bot_note_ts,
  CAST(response_minutes AS DOUBLE) AS response_minutes, CAST(response_seconds AS DOUBLE) AS response_seconds FROM ({NOTES_SQL})
""",
        "app_notes",
    ),
)
def bot_to_human_response(spark, folder):
    found = lead_plan.note_lookups(star(spark, folder, "app_notes"), PARAMS)
    return shape(
        found, applicant_id="bigint", human_note_ts="second", bot_note_ts="second", response_minutes="double", response_seconds="double"
    )


@query(
    "cnr_notes",
    with_star(
        "SELECT cust_id AS applicant_id, strftime(arg_min(note_ts, id), '%Y-%m-%d %H:%M:%S') AS cnr_ts FROM app_notes WHERE lower(note) = 'cnr' GROUP BY 1",
        "app_notes",
    ),
)
def cnr_notes(spark, folder):
    return shape(lead_plan.cnr_notes(star(spark, folder, "app_notes")), applicant_id="bigint", cnr_ts="second")


@query(
    "carrier_fanout",
    with_star(
        """
SELECT DISTINCT i.applicant_id, h.status AS carrier_home_status, c.status AS carrier_cell_status,
  substr(regexp_extract(n.response, '<carrier_name>([^<]*)', 1), 1, 20) AS carrier_name
FROM (SELECT DISTINCT applicant_id FROM identity_log) i
  LEFT JOIN carrier_log h ON h.applicant_id = i.applicant_id AND lower(h.phone_type) = 'homephone'
  LEFT JOIN carrier_log c ON c.applicant_id = i.applicant_id AND lower(c.phone_type) = 'cellphone'
  LEFT JOIN carrier_log n ON n.applicant_id = i.applicant_id
""",
        "identity_log", "carrier_log",
    ),
)
def carrier_fanout(spark, folder):
    t = star(spark, folder, "identity_log", "carrier_log")
    rows = t["identity_log"].select("applicant_id").distinct()
    for part in lead_plan.carrier_lookups(t).values():
        rows = rows.join(part, "applicant_id", "left")
    return rows


@query(
    "employment_responses",
    with_star(
        """
SELECT DISTINCT m.applicant_id, r.response FROM employment_request r JOIN applicant_mapping m ON m.mapping_id = r.mapping_id
WHERE lower(r.source) = 'leads' AND m.applicant_id IN (SELECT id FROM applicant)
""",
        "employment_request", "applicant_mapping", "applicant",
    ),
)
def employment_responses(spark, folder):
    t = star(spark, folder, "employment_request", "applicant_mapping", "applicant")
    leads = t["employment_request"].where(F.lower("source") == "leads").select("mapping_id", "response").distinct()
    mapped = leads.join(t["applicant_mapping"].select("mapping_id", "applicant_id"), "mapping_id")
    known = t["applicant"].select(F.col("id").alias("applicant_id"))
    return mapped.join(known, "applicant_id", "left_semi").select("applicant_id", "response").distinct()


@query(
    "nearest_verification",
    with_star(
        """
SELECT l.lead_id, v.code AS verification_code FROM lead_log l JOIN applicant_mapping m ON m.applicant_id = l.applicant_id
  LEFT JOIN LATERAL (
    SELECT g.code FROM bank_account b JOIN bank_verify_log g ON g.bank_account_id = b.bank_account_id
    WHERE b.mapping_id = m.mapping_id AND CAST(l.lead_ts AS DATE) - CAST(g.inquiry_ts AS DATE) <= 1 AND g.location IN ('2', '5')
    ORDER BY g.inquiry_ts DESC, g.code DESC LIMIT 1) v ON true
""",
        "lead_log", "applicant_mapping", "bank_account", "bank_verify_log",
    ),
)
def nearest_verification(spark, folder):
    t = star(spark, folder, "lead_log", "applicant_mapping", "bank_account", "bank_verify_log")
    leads = t["lead_log"].select("lead_id", "applicant_id", "lead_ts").join(t["applicant_mapping"].select("applicant_id", "mapping_id"), "applicant_id")
    accounts = t["bank_account"].select("mapping_id", "bank_account_id")
    checked = leads.join(accounts, "mapping_id", "left")
    found = intervals.latest_verification(checked, t["bank_verify_log"], "bank_account_id", PARAMS)
    return shape(found, lead_id="bigint", verification_code="string")


@query(
    "interval_inquiries",
    with_star(
        """
SELECT a.id, n.n AS lead_inquiries, CAST(n.cost AS DOUBLE) AS lead_cost, o.n AS other_inquiries, CAST(o.cost AS DOUBLE) AS other_cost
FROM applicant a,
  LATERAL (SELECT count(*) AS n, coalesce(sum(CASE WHEN request_ts < DATE '2018-12-01' THEN 6.00 ELSE 3.80 END), 0) AS cost FROM employment_request r
    WHERE r.social = a.social AND strpos(r.response, '"EmployerName":""') = 0 AND lower(r.source) = 'leads'
      AND abs(date_diff('second', date_trunc('second', a.app_ts + INTERVAL '3' HOUR), date_trunc('second', r.request_ts))) <= 300) n,
  LATERAL (SELECT count(*) AS n, coalesce(sum(CASE WHEN request_ts < DATE '2018-12-01' THEN 6.00 ELSE 3.80 END), 0) AS cost FROM employment_request r
    WHERE r.social = a.social AND strpos(r.response, '"EmployerName":""') = 0 AND lower(r.source) <> 'leads') o
""",
        "applicant", "employment_request",
    ),
)
def interval_inquiries(spark, folder):
    t = star(spark, folder, "applicant", "employment_request")
    added = intervals.add_inquiries(t["applicant"].select("id", "social", "app_ts"), t["employment_request"], PARAMS)
    return shape(added, id="bigint", lead_inquiries="bigint", lead_cost="double", other_inquiries="bigint", other_cost="double")
