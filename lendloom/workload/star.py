"""Operational tables derived from the sales tables, as SQL that Spark and DuckDB both run.

Orders play lead and application (customer = person, order date = application date),
line items the ledger, events the vendor logs and notes, supplier the partners.
"""

from __future__ import annotations

import datetime as dt
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from lendloom.params import LeadParams

BASE = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

# The values a lead document carries, before they are put into text.
LEAD_VALUES = """
SELECT o_orderkey AS lead_id,
  CASE WHEN o_orderkey % 17 = 3 THEN NULL ELSE o_orderkey END AS applicant_id,
  o_orderdate + (o_orderkey * 7919 % 172800) * INTERVAL '1' SECOND AS lead_ts,
  CASE o_orderkey % 5 WHEN 0 THEN 'Rejected' WHEN 1 THEN 'ACCEPTED' WHEN 2 THEN 'Pending' ELSE 'Accepted' END AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN 'U' ELSE 'u' END || CAST(o_custkey % 120 AS STRING) AS username,
  o_orderdate + INTERVAL '3' HOUR AS view_ts,
  CASE WHEN o_orderkey % 29 = 0 THEN 0 WHEN o_orderkey % 23 = 0 THEN 1 ELSE 2 END AS form,
  '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS income_monthly,
  'Bank ' || o_orderpriority AS bank_name,
  'NATION_' || CAST(o_custkey % 30 AS STRING) AS home_state,
  CASE WHEN o_orderkey % 9 = 0 THEN 'none' ELSE 'p' || CAST(o_custkey AS STRING) || '@mail' || CAST(o_orderkey % 7 AS STRING) || '.example' END AS email_primary,
  CAST(1 + o_custkey % 12 AS STRING) AS dob_m,
  CAST(1 + o_custkey % 28 AS STRING) AS dob_d,
  CAST(1940 + o_custkey % 60 AS STRING) AS dob_y,
  CAST(o_custkey % 90 AS STRING) AS bank_months,
  CAST(o_custkey % 70 AS STRING) AS residence_months,
  CASE WHEN o_custkey % 2 = 0 THEN 'Rent' ELSE 'Own' END AS residence_type,
  CAST(o_custkey % 50 AS STRING) AS employer_months,
  CAST(100 + o_orderkey % 10 * 50 AS STRING) AS loan_desired,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'a' || CAST(o_orderkey % 6 AS STRING) END AS sub_id
FROM {orders}
"""

TABLES = {
    "lead_values": LEAD_VALUES,
    "lead_log": """
SELECT lead_id, applicant_id, lead_ts, status, username, view_ts,
  CAST(NULL AS TIMESTAMP_NTZ) AS signature_ts,
  CASE form WHEN 0 THEN NULL WHEN 1 THEN '<loan_request><data name' ELSE
    '<?xml version="1.0"?><loan_request><data name="income_monthly">' || income_monthly
    || '</data><data name="bank_name">&' || bank_name || '</data><data name="home_state">' || home_state
    || '</data><data name="email_primary">' || email_primary || '</data><data name="date_dob_m">' || dob_m
    || '</data><data name="date_dob_d">' || dob_d || '</data><data name="date_dob_y">' || dob_y
    || '</data><data name="bank_length_months">' || bank_months || '</data><data name="bank_length_months">999</data>'
    || '<data name="residence_length_months">' || residence_months || '</data><data name="residence_type">' || residence_type
    || '</data><data name="employer_length_months">' || employer_months || '</data><data name="loan_amount_desired">' || loan_desired
    || '</data>' || CASE WHEN sub_id IS NULL THEN '' ELSE '<data name="sub_id">' || sub_id || '</data>' END || '</loan_request>' END AS xml_in
FROM {lead_values}
""",
    "applicant": """
SELECT o_orderkey AS id,
  CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 'S' || CAST(o_custkey AS STRING) END AS social,
  CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Withdrawn' ELSE 'Rejected' END AS type,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '18' ELSE '7' END AS stage_id,
  CAST(o_orderdate AS DATE) AS dte,
  CAST(DATE '2024-01-01' AS TIMESTAMP_NTZ) + (o_orderkey * 7919 % 2592000) * INTERVAL '1' SECOND - INTERVAL '3' HOUR AS app_ts,
  CAST(o_orderdate AS DATE) + 30 AS date_due,
  '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS salary,
  CASE WHEN o_orderkey % 31 = 0 THEN '5oo' ELSE CAST(100 + o_orderkey % 10 * 50 AS STRING) END AS loan_amount,
  CASE WHEN o_orderkey % 9 = 0 THEN 'none' ELSE 'p' || CAST(o_custkey AS STRING) || '@mail' || CAST(o_orderkey % 7 AS STRING) || '.example ' END AS email,
  'NATION_' || CAST(o_custkey % 30 AS STRING) AS state,
  CAST(o_custkey * 1000 AS STRING) AS routing,
  CASE WHEN o_orderkey % 3 = 0 THEN '02Y03M' WHEN o_orderkey % 3 = 1 THEN '2y3m' ELSE '11Y' END AS job_length,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS direct_deposit,
  CAST(o_orderkey % 2 AS INT) AS verified,
  CASE o_custkey % 7 WHEN 0 THEN 'own' WHEN 1 THEN 'ab-cd_1' WHEN 2 THEN 'ef_gh-2' WHEN 3 THEN 'ij_k' WHEN 4 THEN NULL ELSE 'plain' END AS aff_id,
  CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE NULL END AS auto_ok,
  CAST(o_orderkey % 2 AS INT) AS auto_approved
FROM {orders}
""",
    "applicant_mapping": """
SELECT o_orderkey + 1000000 AS mapping_id, o_orderkey AS applicant_id, o_orderkey AS account_id
FROM {orders} WHERE o_orderpriority <> '4-NOT SPECIFIED'
""",
    "renewal_lead": """
SELECT o_orderkey AS lead_id, o_orderkey + 5 AS log_id, CAST(o_totalprice AS DECIMAL(10,2)) AS loan_amount
FROM {orders} WHERE o_orderstatus <> 'P'
""",
    "renewal_log": "SELECT o_orderkey + 5 AS log_id, o_orderkey AS cust_id FROM {orders}",
    "account": """
SELECT o_orderkey AS id, 'A' || CAST(o_orderkey AS STRING) AS social, o_orderstatus AS type,
  CASE WHEN o_custkey % 13 = 0 THEN 'OWN' ELSE 'z' END AS aff_id, CAST(o_orderdate AS DATE) + 45 AS date_due
FROM {orders}
""",
    "ledger": """
SELECT 2 * ((l_orderkey * 10 + l_linenumber) * 100000000 + CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS id, 'A' || CAST(l_orderkey AS STRING) AS ss,
  CASE WHEN l_quantity >= 46 THEN 'Return' WHEN l_quantity <= 3 THEN 'Loan Increase'
    WHEN l_returnflag = 'R' THEN 'Payment' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'New Loan'
    WHEN l_returnflag = 'A' THEN 'renewal' WHEN l_linestatus = 'F' THEN 'Active -> Written Off' ELSE 'PAY off' END AS type,
  CAST(l_extendedprice AS DECIMAL(18,4)) AS net, CAST(l_extendedprice AS DECIMAL(18,2)) AS paidprin,
  CAST(l_quantity AS DECIMAL(18,2)) AS paidint, CAST(l_extendedprice AS DECIMAL(18,2)) AS payment,
  CAST(l_shipdate AS DATE) AS dte, CAST(NULL AS BIGINT) AS reference_id
FROM {lineitem}
UNION ALL
SELECT 2 * ((l_orderkey * 10 + l_linenumber) * 100000000 + CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) + 1 AS id, 'A' || CAST(l_orderkey AS STRING) AS ss,
  'Reverted Payment' AS type, CAST(0 AS DECIMAL(18,4)) AS net, CAST(0 AS DECIMAL(18,2)) AS paidprin,
  CAST(0 AS DECIMAL(18,2)) AS paidint, CAST(0 AS DECIMAL(18,2)) AS payment, CAST(l_shipdate AS DATE) AS dte,
  2 * ((l_orderkey * 10 + l_linenumber) * 100000000 + CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS reference_id
FROM {lineitem} WHERE l_returnflag = 'R' AND l_linestatus = 'F'
""",
    "partner": """
SELECT 'U' || CAST(s_suppkey AS STRING) AS username, 'Partner ' || CAST(s_suppkey % 20 AS STRING) AS name,
  CASE s_nationkey % 4 WHEN 0 THEN 'organic' WHEN 1 THEN NULL ELSE 'Paid' END AS traffic_source,
  CASE WHEN s_nationkey = 7 THEN NULL ELSE CAST(s_acctbal AS DECIMAL(10,2)) END AS lead_price
FROM {supplier}
""",
    "states": "SELECT n_name AS name, 'N' || CAST(n_nationkey AS STRING) AS abbr FROM {nation}",
    "upsell_log": """
SELECT o_orderkey + 1000000 AS mapping_id, CAST(100 + o_orderkey % 7 * 70 AS DECIMAL(10,2)) AS original,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(300 AS DECIMAL(10,2)) END AS selected, CAST(900 AS DECIMAL(10,2)) AS max_amount
FROM {orders} WHERE o_orderstatus = 'F'
""",
    "auto_failure_x_applicant": "SELECT o_orderkey AS applicant_id, o_custkey % 6 AS reason_id FROM {orders} WHERE o_orderpriority = '2-HIGH'",
    "auto_failure_reason": "SELECT CAST(r_regionkey AS BIGINT) AS reason_id, 'Failure ' || r_name AS reason FROM {region}",
    "contract_tracker": "SELECT o_orderkey AS lead_id, o_orderdate + INTERVAL '1' HOUR AS link_open_ts FROM {orders} WHERE o_orderstatus = 'O'",
    "carrier_log": """
SELECT event_id AS id, user_id AS applicant_id,
  CASE event_type WHEN 'click' THEN 'Homephone' WHEN 'view' THEN 'CELLPHONE' ELSE 'Workphone' END AS phone_type,
  CASE WHEN value < 30 THEN 'ok' ELSE 'bad' END AS status,
  '<response><results><result><carrier_name>Carrier number ' || event_type || '</carrier_name></result></results></response>' AS response
FROM {events} WHERE event_type IN ('click', 'view', 'error')
""",
    "identity_log": """
SELECT user_id AS applicant_id, CASE WHEN value < 40 THEN 'pass' ELSE 'fail' END AS status,
  CAST(floor(value) AS INT) AS fraud_score, ts AS response_ts
FROM {events} WHERE event_type IN ('signup', 'error')
""",
    "bank_account": "SELECT o_orderkey + 1000000 AS mapping_id, o_custkey AS bank_account_id FROM {orders}",
    "bank_verify_log": """
SELECT user_id AS bank_account_id, 'V' || CAST(event_id % 8 AS STRING) AS code,
  ts - (user_id * 97 % 11000) * INTERVAL '1' DAY AS inquiry_ts,
  CASE event_type WHEN 'view' THEN '2' WHEN 'error' THEN '5' ELSE '1' END AS location
FROM {events}
""",
    "open_transact_log": "SELECT event_id AS id, user_id * 2 AS applicant_id, event_type AS result FROM {events} WHERE event_type = 'purchase'",
    "bureau_response": """
SELECT event_id AS id, user_id AS applicant_id,
  CASE event_type WHEN 'click' THEN '0020' WHEN 'view' THEN '0030' WHEN 'purchase' THEN '0014' WHEN 'error' THEN '0008' ELSE NULL END AS store_id,
  CAST(floor(value) AS INT) AS risk_score,
  CASE WHEN value > 150 THEN NULL ELSE
    '<?xml version="1.0" encoding="utf-8" ?><ApplicationResponse><ApplicationInfo>'
    || CASE WHEN event_id % 2 = 0 THEN '<LoanPerformance><NumberofLoansPaidOff>' || CAST(event_id % 9 AS STRING) || '</NumberofLoansPaidOff></LoanPerformance>' ELSE '' END
    || '</ApplicationInfo>' || CASE WHEN event_id % 3 = 0 THEN '<IDV><Score>1</Score>' || CASE WHEN event_id % 6 = 0 THEN '<AddressisCurrent>Y</AddressisCurrent>' ELSE '' END || '</IDV>' ELSE '' END
    || CASE WHEN event_id % 4 = 0 THEN '<ChexAdvisor><Score>2</Score></ChexAdvisor>' ELSE '' END
    || CASE WHEN event_id % 5 = 0 THEN '<Service Name="TraditionalCreditAttributes"><Score>3</Score></Service>' ELSE '' END
    || '<LoanPerformance><NumberofLoansPaidOff>' || CAST(event_id % 7 AS STRING) || '</NumberofLoansPaidOff></LoanPerformance></ApplicationResponse>' END AS response
FROM {events}
""",
    "store_two": """
SELECT event_id AS id, user_id * 2 AS applicant_id, CAST(5 + event_id % 8 AS INT) AS store_id,
  CAST(floor(value) AS INT) AS score, CAST(event_id % 4 AS INT) AS paid_off
FROM {events} WHERE event_type = 'view'
""",
    "employment_request": """
SELECT event_id AS id, 'S' || CAST(user_id AS STRING) AS social, user_id + 1000000 AS mapping_id,
  CASE event_type WHEN 'signup' THEN 'Leads' WHEN 'purchase' THEN 'LEADS' WHEN 'click' THEN 'Profile' WHEN 'error' THEN 'Customer' ELSE NULL END AS source,
  CASE WHEN event_type IN ('error', 'purchase') THEN ts - INTERVAL '2000' DAY ELSE ts END AS request_ts,
  CASE WHEN value > 120 THEN NULL WHEN value > 60 THEN '[{{"EmployerName":"","Case":' || CAST(event_id AS STRING) || '}}]'
    ELSE '[{{"EmployerName":"E' || CAST(event_id AS STRING) || '"}}]' END AS response
FROM {events}
""",
    "model_tracking": """
SELECT event_id AS id, user_id * 3 AS applicant_id,
  CASE event_type WHEN 'signup' THEN 'bureau' WHEN 'purchase' THEN 'Military' WHEN 'view' THEN 'RandomForest' ELSE 'other' END AS model,
  CASE WHEN value < 25 THEN 'Approve' ELSE 'Decline' END AS decision,
  CASE event_id % 6 WHEN 0 THEN 8 WHEN 1 THEN 13 WHEN 2 THEN 14 WHEN 3 THEN 30 WHEN 4 THEN 6 ELSE NULL END AS store_id
FROM {events}
""",
    "app_notes": """
SELECT event_id AS id, user_id AS cust_id, ts AS note_ts,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN 'bot' ELSE 'agent' END AS submitted_by,
  CASE WHEN event_type = 'error' THEN 'cnr' ELSE 'call' END AS note
FROM {events}
""",
    "ach_status": """
SELECT o_orderkey AS id, o_orderkey - o_orderkey % 2 AS account_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'C' ELSE 'd' END AS type,
  CASE WHEN o_orderstatus = 'F' THEN 'return' ELSE 'Settled' END AS status,
  CASE o_orderkey % 8 WHEN 0 THEN 'R01' WHEN 2 THEN 'R02' WHEN 4 THEN NULL ELSE 'R10' END AS return_code
FROM {orders}
""",
    "credit_card": "SELECT o_orderkey + 1000000 AS mapping_id FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "lead_reject_x": "SELECT o_orderkey AS lead_id, o_custkey % 6 AS reason_id FROM {orders} WHERE o_orderstatus IN ('F', 'O')",
    "lead_reject_reason": "SELECT CAST(r_regionkey AS BIGINT) AS reason_id, 'Auto ' || r_name AS reason FROM {region}",
    "manual_reject_x": "SELECT o_orderkey AS applicant_id, o_custkey % 27 AS note_id FROM {orders} WHERE o_orderstatus = 'P'",
    "reject_note": "SELECT CAST(n_nationkey AS BIGINT) AS note_id, 'Note ' || n_name AS note FROM {nation}",
    "reserved_applicants": "SELECT o_orderkey AS applicant_id FROM {orders} WHERE o_orderpriority = '3-MEDIUM'",
    "cost_per_service": """
SELECT CAST(0.30 AS DECIMAL(10,2)) AS chex, CAST(0.12 AS DECIMAL(10,2)) AS idv, CAST(0.55 AS DECIMAL(10,2)) AS risk
FROM {region} WHERE r_regionkey = 0
""",
}

PARAMS = LeadParams(
    as_of=dt.date(2001, 6, 30),
    start=dt.date(1996, 1, 1),
    id_threshold=60,
    partner_groups={"Partner 1": "Group A", "Partner 2": "Group A", "Partner 3": "Group B", "Partner 4": "Group C"},
    organic_ids=("own",),
    organic_account_ids=("own",),
    sub_id_partner="Partner 5",
    share_partners=("Partner 6", "Partner 7"),
    flat_partner="Partner 8",
    late_partner="Partner 9",
)


def star(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The named operational tables (all, when none is named)."""
    base = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in BASE}

    @cache
    def build(name: str) -> DataFrame:
        text = TABLES[name]
        used = {k: base[k] for k in base if f"{{{k}}}" in text}
        used |= {k: build(k) for k in TABLES if f"{{{k}}}" in text}
        return spark.sql(text, **used)

    return {name: build(name) for name in (names or TABLES)}


def with_star(body: str, *names: str) -> str:
    """SQL for DuckDB: the named tables as common table expressions in front of ``body``."""
    needed: list[str] = []
    for name in names or TABLES:
        for dependency in [k for k in TABLES if f"{{{k}}}" in TABLES[name]] + [name]:
            if dependency not in needed:
                needed.append(dependency)

    def plain(text: str) -> str:
        for name in (*BASE, *TABLES):
            text = text.replace(f"{{{name}}}", name)
        return text.replace("TIMESTAMP_NTZ", "TIMESTAMP").replace("{{", "{").replace("}}", "}")

    tables = ", ".join(f"{name} AS ({plain(TABLES[name])})" for name in needed)
    return f"WITH {tables} SELECT * FROM ({body}) AS answer"
