"""The whole lead extraction against one SQL statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendloom.plans.leads import DEFAULT_LABELS, PROJECTION, counted_leads, wide_leads
from lendloom.workload.history import HISTORY_SQL
from lendloom.workload.ledger import DEBIT_SQL, FIRST_SQL, ROLLUP_SQL
from lendloom.workload.registry import query, shape
from lendloom.workload.star import PARAMS, star, with_star

KINDS = {
    "lead_id": "bigint", "applicant_id": "bigint", "received_month": "bigint", "received_date": "day", "bank": "string",
    "routing": "string", "bank_months": "string", "residence_months": "string", "residence_type": "string", "months_on_job": "string",
    "salary": "string", "dob": "string", "age": "double", "email_domain": "string", "payment_ratio": "r4", "direct_deposit": "string",
    "state": "string", "state_abbr": "string", "pre_status": "string", "times_applied": "bigint", "identity_status": "string",
    "risk_score": "double", "credit_risk_score": "double", "first_model_decision": "string", "last_model_decision": "string",
    "military": "bigint", "paid_off_loans_credit": "string", "paid_off_loans": "string", "card_provided": "string",
    "loan_performance": "bigint", "id_logic": "bigint", "account_check": "bigint", "store": "string",
    "applicant_type": "string", "if_accepted": "bigint", "if_funded": "bigint", "lead_status": "string", "loan_amount": "string",
    "original_amount": "double", "selected_amount": "double", "sell_type": "string", "affiliate": "string", "affiliate_group": "string",
    "sub_id": "string", "lead_price": "double", "fraud_score": "double", "carrier_name": "string", "auto_ok": "double",
    "auto_approved": "double", "failure_reason": "string", "approval_path": "string", "employment_response": "string",
    "is_cnr": "bigint", "verified": "bigint", "view_ts": "second", "signature_ts": "second", "link_open_ts": "second",
    "rejection_reason": "string", "carrier_cell_cost": "double", "carrier_home_cost": "double", "open_transaction_cost": "double",
    "identity_cost": "double", "bureau_cost": "double", "employment_cost": "double", "employment_inquiries": "bigint",
    "loan_performance_cost": "double", "id_logic_cost": "double", "account_check_cost": "double", "credit_attributes_cost": "double",
    "military_cost": "double", "data_cost": "double", "new_lead_cost": "double", "cycled": "bigint", "defaulted": "bigint",
    "failed_first_payment": "bigint", "first_payment_default": "bigint", "one_payment_default": "bigint", "total_paid": "double",
    "total_lent": "double",
}
assert list(KINDS) == [*PROJECTION, *DEFAULT_LABELS]


def _first(table: str, columns: str, where: str, order: str) -> str:
    return f"(SELECT {columns} FROM {table} x WHERE {where} ORDER BY {order} LIMIT 1)"


def _inquiries(source: str) -> str:
    return (
        "(SELECT count(*) AS n, coalesce(sum(CASE WHEN x.request_ts < DATE '2018-12-01' THEN 6.00 ELSE 3.80 END), 0) AS cost "
        f"FROM employment_request x WHERE x.social = a.social AND strpos(x.response, '\"EmployerName\":\"\"') = 0 AND {source})"
    )


NEAR = "lower(x.source) = 'leads' AND abs(date_diff('second', date_trunc('second', a.app_ts + INTERVAL '3' HOUR), date_trunc('second', x.request_ts))) <= 300"

WIDE_SQL = f"""
WITH hist AS MATERIALIZED ({HISTORY_SQL}), roll AS MATERIALIZED ({ROLLUP_SQL}), pay AS MATERIALIZED ({FIRST_SQL}), debit AS MATERIALIZED ({DEBIT_SQL}),
ask AS MATERIALIZED (SELECT a.id, n.n + o.n AS n, n.cost + o.cost AS cost FROM applicant a, LATERAL {_inquiries(NEAR)} n, LATERAL {_inquiries("lower(x.source) <> 'leads'")} o),
cards AS (SELECT m.account_id, count(*) AS n FROM applicant_mapping m JOIN credit_card c ON c.mapping_id = m.mapping_id GROUP BY 1),
wide AS (SELECT DISTINCT
  l.lead_id, a.id AS applicant_id, l.lead_ts, l.status, l.view_ts, a.type, a.stage_id, a.routing, a.direct_deposit, a.verified, a.auto_ok, a.auto_approved,
  a.loan_amount AS asked, a.social, a.dte, a.date_due, v.form, v.income_monthly, v.bank_name, v.home_state, v.email_primary, v.dob_m, v.dob_d, v.dob_y,
  v.bank_months, v.residence_months, v.residence_type, v.employer_months, v.loan_desired, v.sub_id, s.abbr, hist.previous_type,
  i.status AS identity_status, i.fraud_score, b.id AS b_id, b.store_id AS b_store, b.risk_score, b.response AS b_response, m.store_id AS m_store,
  k.risk_score AS k_score, k.id AS k_id, k.response AS k_response, ft.store_id AS ft_store, t1.model AS t_model, t1.store_id AS t_store,
  t2.decision AS decision_1, t3.decision AS decision_2, ot.id AS ot_id, u.original, u.selected, p.name AS partner_name, p.traffic_source, p.lead_price,
  fr.reason AS failure_reason, rn.note AS reject_note, rr.reason AS auto_reason, ct.link_open_ts, h.status AS home_status, c.status AS cell_status,
  cn.carrier_name, e.response AS employment_response, ask.n AS inquiries, ask.cost AS inquiry_cost, ac.date_due AS account_due,
  roll.total_paid, roll.total_lent, roll.payment_count, roll.renewal_count, roll.new_loan_amount, roll.principal_paid,
  pay.first_payment_id, pay.first_payment_date, debit.returned, debit.return_code, coalesce(cards.n, 0) AS card_count
FROM lead_log l JOIN applicant a ON a.id = l.applicant_id JOIN lead_values v ON v.lead_id = l.lead_id JOIN hist ON hist.id = a.id JOIN ask ON ask.id = a.id
  LEFT JOIN applicant_mapping g ON g.applicant_id = l.applicant_id LEFT JOIN upsell_log u ON u.mapping_id = g.mapping_id
  LEFT JOIN states s ON s.name = a.state LEFT JOIN partner p ON lower(p.username) = lower(l.username)
  LEFT JOIN auto_failure_x_applicant fx ON fx.applicant_id = l.applicant_id LEFT JOIN auto_failure_reason fr ON fr.reason_id = fx.reason_id
  LEFT JOIN contract_tracker ct ON ct.lead_id = l.lead_id
  LEFT JOIN renewal_lead rl ON rl.lead_id = l.lead_id LEFT JOIN renewal_log rg ON rg.log_id = rl.log_id LEFT JOIN account ac ON ac.id = rg.cust_id
  LEFT JOIN roll ON roll.ss = ac.social LEFT JOIN pay ON pay.ss = ac.social LEFT JOIN debit ON debit.account_id = ac.id LEFT JOIN cards ON cards.account_id = ac.id
  LEFT JOIN carrier_log h ON h.applicant_id = a.id AND lower(h.phone_type) = 'homephone'
  LEFT JOIN carrier_log c ON c.applicant_id = a.id AND lower(c.phone_type) = 'cellphone'
  LEFT JOIN (SELECT DISTINCT applicant_id, substr(regexp_extract(response, '<carrier_name>([^<]*)', 1), 1, 20) AS carrier_name FROM carrier_log) cn ON cn.applicant_id = a.id
  JOIN (SELECT DISTINCT q.response, y.applicant_id FROM employment_request q JOIN applicant_mapping y ON y.mapping_id = q.mapping_id
        WHERE lower(q.source) = 'leads') e ON e.applicant_id = a.id
  LEFT JOIN LATERAL {_first("identity_log", "*", "x.applicant_id = a.id", "x.response_ts DESC")} i ON true
  LEFT JOIN LATERAL {_first("open_transact_log", "*", "x.applicant_id = a.id", "x.id")} ot ON true
  LEFT JOIN LATERAL {_first("bureau_response", "*", "x.applicant_id = a.id AND x.store_id <> '0020'", "x.id")} b ON true
  LEFT JOIN LATERAL {_first("bureau_response", "*", "x.applicant_id = a.id AND x.store_id = '0020'", "x.id")} m ON true
  LEFT JOIN LATERAL {_first("bureau_response", "*", "x.applicant_id = a.id AND x.store_id = '0030'", "x.id")} k ON true
  LEFT JOIN LATERAL {_first("store_two", "*", "x.applicant_id = a.id", "x.id")} ft ON true
  LEFT JOIN LATERAL {_first("model_tracking", "*", "x.applicant_id = a.id", "x.id")} t1 ON true
  LEFT JOIN LATERAL {_first("model_tracking", "*", "x.applicant_id = a.id AND x.model = 'bureau'", "x.id")} t2 ON true
  LEFT JOIN LATERAL {_first("model_tracking", "*", "x.applicant_id = a.id AND x.model = 'Military'", "x.id DESC")} t3 ON true
  LEFT JOIN lead_reject_x lx ON lx.lead_id = l.lead_id LEFT JOIN lead_reject_reason rr ON rr.reason_id = lx.reason_id
  LEFT JOIN manual_reject_x mx ON mx.applicant_id = a.id LEFT JOIN reject_note rn ON rn.note_id = mx.note_id
WHERE a.dte BETWEEN DATE '1996-01-01' AND DATE '2001-06-30' AND (a.id > 60 OR a.id IN (SELECT applicant_id FROM reserved_applicants))),
costed AS (SELECT *, form = 2 AS readable, DATE '2001-06-30' - date_due > 7 AS overdue,
  CASE WHEN strpos(b_response, '<LoanPerformance>') > 0 THEN 0.55 ELSE 0 END AS loan_performance_cost,
  CASE WHEN strpos(b_response, '<IDV>') > 0 THEN 0.12 ELSE 0 END AS id_logic_cost,
  CASE WHEN strpos(b_response, '<ChexAdvisor>') > 0 THEN 0.30 ELSE 0 END AS account_check_cost,
  CASE WHEN strpos(b_response, '<Service Name="TraditionalCreditAttributes">') > 0 THEN 0.70 ELSE 0 END AS credit_attributes_cost,
  CASE WHEN m_store IS NOT NULL THEN 0.06 ELSE 0 END AS military_cost, CASE WHEN ot_id IS NOT NULL THEN 0.10 ELSE 0 END AS open_transaction_cost,
  CASE WHEN identity_status IS NOT NULL THEN 0.07 ELSE 0 END AS identity_cost,
  make_date(CAST(dob_y AS INT), CAST(dob_m AS INT), CAST(dob_d AS INT)) AS dob_day FROM wide)
SELECT lead_id, applicant_id, CAST(month(lead_ts) AS BIGINT) AS received_month, strftime(lead_ts, '%Y-%m-%d') AS received_date,
  CASE WHEN readable THEN bank_name END AS bank, routing, CASE WHEN readable THEN bank_months END AS bank_months,
  CASE WHEN readable THEN residence_months END AS residence_months, CASE WHEN readable THEN residence_type END AS residence_type,
  CASE WHEN readable THEN employer_months END AS months_on_job, CASE WHEN readable THEN income_monthly END AS salary,
  CASE WHEN readable THEN dob_m || '/' || dob_d || '/' || dob_y END AS dob,
  CASE WHEN readable THEN CAST((CAST(lead_ts AS DATE) - dob_day) // 365 AS DOUBLE) END AS age,
  CASE WHEN readable THEN CASE WHEN strpos(email_primary, '@') > 0 THEN substr(email_primary, strpos(email_primary, '@') + 1) ELSE email_primary END END AS email_domain,
  CASE WHEN readable THEN round(CAST(loan_desired AS DOUBLE) * 0.6 / CAST(replace(income_monthly, '$', '') AS DOUBLE), 4) END AS payment_ratio,
  direct_deposit, CASE WHEN readable THEN home_state END AS state, abbr AS state_abbr, previous_type AS pre_status, CAST(1 AS BIGINT) AS times_applied,
  identity_status, CAST(risk_score AS DOUBLE) AS risk_score, CAST(k_score AS DOUBLE) AS credit_risk_score, decision_1 AS first_model_decision,
  decision_2 AS last_model_decision, CAST(CASE WHEN m_store IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS military,
  CASE WHEN k_response IS NOT NULL THEN CAST(k_id % 7 AS VARCHAR) END AS paid_off_loans_credit,
  CASE WHEN b_response IS NOT NULL AND b_id % 2 = 0 THEN CAST(b_id % 9 AS VARCHAR) END AS paid_off_loans,
  CASE WHEN card_count > 0 THEN 'Y' ELSE 'N' END AS card_provided,
  CAST(CASE WHEN strpos(b_response, 'LoanPerformance') > 0 THEN 1 ELSE 0 END AS BIGINT) AS loan_performance,
  CAST(CASE WHEN strpos(b_response, 'AddressisCurrent') > 0 THEN 1 ELSE 0 END AS BIGINT) AS id_logic,
  CAST(CASE WHEN strpos(b_response, 'ChexAdvisor') > 0 THEN 1 ELSE 0 END AS BIGINT) AS account_check,
  CASE WHEN t_model = 'RandomForest' THEN 'Store 12-RF' WHEN ft_store IS NULL AND t_store = 8 THEN 'Store 08' WHEN ft_store IS NULL AND t_store = 13 THEN 'Store 13'
    WHEN ft_store IS NULL AND t_store IS NULL AND CAST(b_store AS INT) = 14 THEN 'Store 14' WHEN ft_store IS NULL AND t_store IS NULL AND CAST(b_store AS INT) = 30 THEN 'Store 30'
    WHEN ft_store IS NULL AND t_store = 30 THEN 'Store 30' WHEN ft_store BETWEEN 6 AND 11 THEN 'Store ' || lpad(CAST(ft_store AS VARCHAR), 2, '0')
    WHEN ft_store IS NULL AND t_store = 14 THEN 'Store 14' ELSE 'Other' END AS store,
  type AS applicant_type, CAST(CASE WHEN lower(status) = 'accepted' THEN 1 ELSE 0 END AS BIGINT) AS if_accepted,
  CAST(CASE WHEN type = 'Approved' THEN 1 ELSE 0 END AS BIGINT) AS if_funded, status AS lead_status, CASE WHEN readable THEN loan_desired END AS loan_amount,
  CAST(original AS DOUBLE) AS original_amount, CAST(selected AS DOUBLE) AS selected_amount,
  CASE WHEN original IS NULL OR selected IS NULL THEN 'NOT Offer' WHEN original >= CAST(replace(asked, 'o', '0') AS DECIMAL(18,2)) THEN 'NOT UPSELL' ELSE 'UPSELL' END AS sell_type,
  CASE WHEN lower(traffic_source) = 'organic' THEN 'Organic' ELSE partner_name END AS affiliate,
  CASE WHEN lower(traffic_source) = 'organic' THEN 'Organic' WHEN partner_name IN ('Partner 1', 'Partner 2') THEN 'Group A' WHEN partner_name = 'Partner 3' THEN 'Group B'
    WHEN partner_name = 'Partner 4' THEN 'Group C' ELSE 'Other' END AS affiliate_group,
  CASE WHEN readable THEN sub_id END AS sub_id, CAST(coalesce(lead_price, 0) AS DOUBLE) AS lead_price, CAST(fraud_score AS DOUBLE) AS fraud_score, carrier_name,
  CAST(auto_ok AS DOUBLE) AS auto_ok, CAST(auto_approved AS DOUBLE) AS auto_approved, failure_reason,
  CASE WHEN auto_ok = 0 AND type = 'Approved' THEN 'Manual-Approved' WHEN auto_ok = 1 AND auto_approved = 0 AND type = 'Approved' THEN 'Semi-Auto-Approved'
    WHEN auto_ok = 1 AND auto_approved = 1 AND type = 'Approved' THEN 'Auto-Approved' ELSE type END AS approval_path,
  employment_response, CAST(CASE WHEN stage_id = '18' THEN 1 ELSE 0 END AS BIGINT) AS is_cnr, CAST(verified AS BIGINT) AS verified,
  strftime(view_ts, '%Y-%m-%d %H:%M:%S') AS view_ts, CAST(NULL AS VARCHAR) AS signature_ts, strftime(link_open_ts, '%Y-%m-%d %H:%M:%S') AS link_open_ts,
  CASE WHEN lower(status) = 'accepted' AND type = 'Rejected' THEN 'Manual: ' || reject_note WHEN lower(status) = 'accepted' THEN ''
    WHEN status = 'Rejected' THEN auto_reason ELSE 'UNKNOWN CASE' END AS rejection_reason,
  CAST(CASE WHEN cell_status IS NOT NULL THEN 0.005 ELSE 0 END AS DOUBLE) AS carrier_cell_cost, CAST(CASE WHEN home_status IS NOT NULL THEN 0.005 ELSE 0 END AS DOUBLE) AS carrier_home_cost,
  CAST(open_transaction_cost AS DOUBLE) AS open_transaction_cost, CAST(identity_cost AS DOUBLE) AS identity_cost,
  CAST(loan_performance_cost + id_logic_cost + account_check_cost + credit_attributes_cost + military_cost AS DOUBLE) AS bureau_cost,
  CAST(inquiry_cost AS DOUBLE) AS employment_cost, inquiries AS employment_inquiries, CAST(loan_performance_cost AS DOUBLE) AS loan_performance_cost,
  CAST(id_logic_cost AS DOUBLE) AS id_logic_cost, CAST(account_check_cost AS DOUBLE) AS account_check_cost, CAST(credit_attributes_cost AS DOUBLE) AS credit_attributes_cost,
  CAST(military_cost AS DOUBLE) AS military_cost,
  CAST(identity_cost + open_transaction_cost + loan_performance_cost + id_logic_cost + account_check_cost + credit_attributes_cost + military_cost + inquiry_cost AS DOUBLE) AS data_cost,
  CAST(CASE WHEN lower(traffic_source) <> 'organic' AND partner_name NOT IN ('Partner 6', 'Partner 7', 'Partner 8') AND lower(status) = 'accepted' THEN lead_price
    WHEN partner_name IN ('Partner 6', 'Partner 7') AND lower(status) = 'accepted' AND type = 'Approved' THEN 0.25 * coalesce(TRY_CAST(asked AS DECIMAL(10,2)), 0)
    WHEN partner_name = 'Partner 8' AND lower(status) = 'accepted' AND type = 'Approved' THEN 75 WHEN partner_name = 'Partner 9' AND type = 'Accepted' THEN 11 ELSE 0 END AS DOUBLE) AS new_lead_cost,
  CAST(CASE WHEN overdue THEN 1 ELSE 0 END AS BIGINT) AS cycled, CAST(CASE WHEN total_paid = 0 AND overdue THEN 1 ELSE 0 END AS BIGINT) AS defaulted,
  CAST(CASE WHEN returned = 'Y' AND return_code NOT IN ('R01', 'R09', 'R99') THEN 1 ELSE 0 END AS BIGINT) AS failed_first_payment,
  CAST(CASE WHEN first_payment_id IS NULL AND overdue THEN 1 WHEN first_payment_id IS NOT NULL AND first_payment_date - date_due > 7 THEN 1 ELSE 0 END AS BIGINT) AS first_payment_default,
  CAST(CASE WHEN payment_count = 1 AND renewal_count = 0 AND new_loan_amount - principal_paid > 0 AND DATE '2001-06-30' - account_due > 7 THEN 1 ELSE 0 END AS BIGINT) AS one_payment_default,
  CAST(total_paid AS DOUBLE) AS total_paid, CAST(total_lent AS DOUBLE) AS total_lent
FROM costed
"""


@query("lead_wide", with_star(WIDE_SQL))
def lead_wide(spark, folder):
    return shape(wide_leads(star(spark, folder), PARAMS, with_defaults=True), **KINDS)


@query(
    "lead_cost_report",
    with_star(
        f"""
SELECT affiliate_group, count(DISTINCT lead_id) AS leads, count(*) AS answers, round(sum(CAST(data_cost AS DECIMAL(18,4))), 4)::DOUBLE AS data_cost,
  round(sum(CAST(new_lead_cost AS DECIMAL(18,4))), 4)::DOUBLE AS lead_cost FROM ({WIDE_SQL}) GROUP BY 1
"""
    ),
)
def lead_cost_report(spark, folder):
    # costs are those of a lead: its rows are counted, not made
    rows = counted_leads(star(spark, folder), PARAMS)
    times = lambda name: F.sum(F.col(name).cast("decimal(18,4)") * F.col("n_rows").cast("decimal(18,0)"))
    per_lead = rows.groupBy("affiliate_group", "lead_id").agg(F.sum("n_rows").alias("n"), times("data_cost").alias("data"), times("new_lead_cost").alias("lead"))
    return per_lead.groupBy("affiliate_group").agg(
        F.count("*").alias("leads"), F.sum("n").alias("answers"),
        F.sum("data").cast("decimal(18,4)").cast("double").alias("data_cost"), F.sum("lead").cast("double").alias("lead_cost"),
    )
