"""Filters, projections and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lendloom.functions import dates, labels, money, text
from lendloom.operators import membership
from lendloom.operators.skew import broadcast_if_small, enrich
from lendloom.params import BANK_RULES_SCORING, BANK_RULES_TRAINING, BINARY_LABELS, STATE_NAMES
from lendloom.plans import leads as lead_plan
from lendloom.plans.training import join_renamed
from lendloom.operators.encode import encode_binary
from lendloom.workload.registry import query, shape, table
from lendloom.workload.star import PARAMS, star, with_star

CHECK_DAY = dt.date(2021, 6, 30)


@query(
    "calendar_parts",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS received_date, CAST(month(ts) AS BIGINT) AS received_month,
  CAST(year(ts) AS BIGINT) AS received_year,
  CAST(floor((dayofyear(ts) - 1 + isodow(date_trunc('year', ts)) - 1) / 7) + 1 AS BIGINT) AS week_number,
  CAST(hour(ts) AS BIGINT) AS received_hour, dayname(ts) AS day_name,
  CASE WHEN isodow(ts) <= 5 AND hour(ts) BETWEEN 9 AND 23 THEN 'Hour'
       WHEN isodow(ts) >= 6 AND hour(ts) BETWEEN 9 AND 18 THEN 'Hour' ELSE 'Off-Hour' END AS working_hour
FROM events
""",
)
def calendar_parts(spark, folder):
    events = table(spark, folder, "events")
    parts = events.select("event_id", *[c.alias(n) for n, c in dates.calendar_parts(F.col("ts")).items()])
    return shape(
        parts, event_id="bigint", received_date="day", received_month="bigint", received_year="bigint", week_number="bigint",
        received_hour="bigint", day_name="string", working_hour="string",
    )


@query(
    "working_hours",
    """
SELECT event_type, CASE WHEN hour(ts) >= 9 AND (isodow(ts) <= 5 OR hour(ts) <= 18) THEN 'Hour' ELSE 'Off-Hour' END AS working_hour,
  count(*) AS n FROM events GROUP BY 1, 2
""",
)
def working_hours(spark, folder):
    events = table(spark, folder, "events").select("event_type", dates.working_hour(F.col("ts")).alias("working_hour"))
    return events.groupBy("event_type", "working_hour").agg(F.count("*").alias("n"))


@query(
    "partner_groups",
    with_star(
        """
SELECT affiliate_group, channel, count(*) AS n, CAST(sum(accepted) AS BIGINT) AS accepted, count(DISTINCT affiliate) AS affiliates FROM (
  SELECT CASE WHEN lower(p.traffic_source) = 'organic' THEN 'Organic'
              WHEN p.name IN ('Partner 1', 'Partner 2') THEN 'Group A' WHEN p.name = 'Partner 3' THEN 'Group B'
              WHEN p.name = 'Partner 4' THEN 'Group C' ELSE 'Other' END AS affiliate_group,
    CASE WHEN lower(p.traffic_source) = 'organic' THEN 'Organic' ELSE p.name END AS affiliate,
    CASE WHEN a.aff_id = 'own' OR lower(c.aff_id) = 'own' THEN 'Organic' ELSE 'Leads' END AS channel,
    CASE WHEN lower(l.status) = 'accepted' THEN 1 ELSE 0 END AS accepted
  FROM lead_log l JOIN applicant a ON a.id = l.applicant_id JOIN account c ON c.id = a.id
    LEFT JOIN partner p ON lower(p.username) = lower(l.username))
GROUP BY 1, 2
""",
        "lead_log", "applicant", "account", "partner",
    ),
)
def partner_groups(spark, folder):
    t = star(spark, folder, "lead_log", "applicant", "account", "partner")
    partners = t["partner"].select(F.lower("username").alias("partner"), "name", "traffic_source")
    leads = t["lead_log"].select("applicant_id", "status", F.lower("username").alias("partner"))
    people = t["applicant"].select(F.col("id").alias("applicant_id"), "aff_id").join(
        t["account"].select(F.col("id").alias("applicant_id"), F.col("aff_id").alias("account_aff_id")), "applicant_id"
    )
    joined = enrich(leads, people, "applicant_id", "inner").join(broadcast_if_small(partners), "partner", "left")
    c = F.col
    rows = joined.select(
        labels.partner_group(c("traffic_source"), c("name"), PARAMS).alias("affiliate_group"),
        labels.partner_label(c("traffic_source"), c("name")).alias("affiliate"),
        labels.channel(c("aff_id"), c("account_aff_id"), PARAMS).alias("channel"),
        text.flag(text.same_text(c("status"), "Accepted")).alias("accepted"),
    )
    # two steps: a plain count(distinct) would expand every row
    per_partner = rows.groupBy("affiliate_group", "channel", "affiliate").agg(F.count("*").alias("n"), F.sum("accepted").alias("accepted"))
    return per_partner.groupBy("affiliate_group", "channel").agg(
        F.sum("n").alias("n"), F.sum("accepted").alias("accepted"), F.count("affiliate").alias("affiliates")
    )


@query(
    "sub_id_email_job",
    with_star(
        """
SELECT id, CASE WHEN id % 20 = 5 AND strpos(aff_id, '-') > 0 THEN split_part(aff_id, '-', 1)
    WHEN id % 20 = 5 AND strpos(aff_id, '_') > 0 THEN split_part(aff_id, '_', 1) ELSE aff_id END AS sub_id,
  CASE WHEN strpos(email, '@') > 0 THEN rtrim(substr(email, strpos(email, '@') + 1)) ELSE email END AS email_domain,
  CAST((strpos(upper(job_length), 'Y') - 3) * 12 + strpos(upper(job_length), 'M') - 3 AS BIGINT) AS months_on_job,
  CAST(CASE id % 3 WHEN 2 THEN 132 ELSE 27 END AS BIGINT) AS months_read
FROM applicant
""",
        "applicant",
    ),
)
def sub_id_email_job(spark, folder):
    c = F.col
    people = star(spark, folder, "applicant")["applicant"]
    partner = F.concat(F.lit("Partner "), (c("id") % 20).cast("string"))
    rows = people.select(
        "id",
        text.sub_id_root(partner, c("aff_id"), PARAMS.sub_id_partner).alias("sub_id"),
        text.email_domain(c("email")).alias("email_domain"),
        text.months_on_job(c("job_length")).alias("months_on_job"),
        text.months_on_job_from_digits(c("job_length")).alias("months_read"),
    )
    return shape(rows, id="bigint", sub_id="string", email_domain="string", months_on_job="bigint", months_read="bigint")


@query(
    "age_years",
    """
SELECT c_custkey, CAST(CASE WHEN y > 1000 THEN y - 1000 ELSE y END AS BIGINT) AS age FROM (
  SELECT c_custkey, (DATE '2021-06-30' - make_date(CASE WHEN c_custkey % 40 = 0 THEN 960 ELSE 1940 END + CAST(c_custkey % 60 AS INT),
    CAST(1 + c_custkey % 12 AS INT), CAST(1 + c_custkey % 28 AS INT))) // 365 AS y FROM customer)
""",
)
def age_years(spark, folder):
    key = F.col("c_custkey")
    year = F.when(key % 40 == 0, 960).otherwise(1940) + key % 60
    dob = F.make_date(year.cast("int"), (1 + key % 12).cast("int"), (1 + key % 28).cast("int"))
    rows = table(spark, folder, "customer").select("c_custkey", dates.age_years(dob, F.lit(CHECK_DAY)).alias("age"))
    return shape(rows, c_custkey="bigint", age="bigint")


@query(
    "payment_ratio",
    with_star(
        """
SELECT id, CAST(round(CAST(TRY_CAST(loan_amount AS DECIMAL(10,2)) * 0.6 AS DOUBLE) / CAST(replace(salary, '$', '') AS DOUBLE), 4) AS DOUBLE) AS payment_ratio
FROM applicant
""",
        "applicant",
    ),
)
def payment_ratio(spark, folder):
    people = star(spark, folder, "applicant")["applicant"]
    return people.select("id", money.payment_ratio(F.col("loan_amount"), F.col("salary")).cast("double").alias("payment_ratio"))


LABEL_SQL = """
SELECT a.id, CASE WHEN lower(m.model) = 'randomforest' THEN 'Store 12-RF'
    WHEN s.store_id IS NULL AND m.store_id = 8 THEN 'Store 08' WHEN s.store_id IS NULL AND m.store_id = 13 THEN 'Store 13'
    WHEN s.store_id IS NULL AND m.store_id IS NULL AND CAST(b.store_id AS INT) = 14 THEN 'Store 14'
    WHEN s.store_id IS NULL AND m.store_id IS NULL AND CAST(b.store_id AS INT) = 30 THEN 'Store 30'
    WHEN s.store_id IS NULL AND m.store_id = 30 THEN 'Store 30'
    WHEN s.store_id BETWEEN 6 AND 11 THEN 'Store ' || lpad(CAST(s.store_id AS VARCHAR), 2, '0')
    WHEN s.store_id IS NULL AND m.store_id = 14 THEN 'Store 14' ELSE 'Other' END AS store_label,
  CASE WHEN u.original IS NULL OR u.selected IS NULL THEN 'NOT Offer'
    WHEN u.original >= CAST(replace(a.loan_amount, 'o', '0') AS DECIMAL(18,2)) THEN 'NOT UPSELL' ELSE 'UPSELL' END AS sell_type,
  CASE WHEN a.auto_ok = 0 AND a.type = 'Approved' THEN 'Manual-Approved'
    WHEN a.auto_ok = 1 AND a.auto_approved = 0 AND a.type = 'Approved' THEN 'Semi-Auto-Approved'
    WHEN a.auto_ok = 1 AND a.auto_approved = 1 AND a.type = 'Approved' THEN 'Auto-Approved' ELSE a.type END AS approval_path,
  CASE WHEN lower(l.status) = 'accepted' AND a.type = 'Rejected' THEN 'Manual: ' || n.note
    WHEN lower(l.status) = 'accepted' THEN '' WHEN l.status = 'Rejected' THEN r.reason ELSE 'UNKNOWN CASE' END AS rejection_reason,
  CAST(coalesce(TRY_CAST(a.loan_amount AS DECIMAL(10,2)), 0) AS DOUBLE) AS amount
FROM lead_log l JOIN applicant a ON a.id = l.applicant_id
  LEFT JOIN (SELECT applicant_id, arg_min(model, id) AS model, arg_min(coalesce(store_id, -1), id) AS raw_store,
      CASE WHEN arg_min(coalesce(store_id, -1), id) = -1 THEN NULL ELSE arg_min(coalesce(store_id, -1), id) END AS store_id
    FROM model_tracking GROUP BY 1) m ON m.applicant_id = a.id
  LEFT JOIN (SELECT applicant_id, arg_min(store_id, id) AS store_id FROM store_two GROUP BY 1) s ON s.applicant_id = a.id
  LEFT JOIN (SELECT applicant_id, arg_min(store_id, id) AS store_id FROM bureau_response WHERE store_id <> '0020' GROUP BY 1) b ON b.applicant_id = a.id
  LEFT JOIN applicant_mapping g ON g.applicant_id = a.id LEFT JOIN upsell_log u ON u.mapping_id = g.mapping_id
  LEFT JOIN manual_reject_x x ON x.applicant_id = a.id LEFT JOIN reject_note n ON n.note_id = x.note_id
  LEFT JOIN lead_reject_x y ON y.lead_id = l.lead_id LEFT JOIN lead_reject_reason r ON r.reason_id = y.reason_id
"""
LABEL_TABLES = (
    "lead_log", "applicant", "model_tracking", "store_two", "bureau_response", "applicant_mapping", "upsell_log",
    "manual_reject_x", "reject_note", "lead_reject_x", "lead_reject_reason",
)


@query("store_and_sell_labels", with_star(LABEL_SQL, *LABEL_TABLES))
def store_and_sell_labels(spark, folder):
    c = F.col
    t = star(spark, folder, *LABEL_TABLES)
    stores = t["store_two"].groupBy("applicant_id").agg(F.min_by("store_id", "id").alias("first_store_id"))
    upsell = t["applicant_mapping"].join(t["upsell_log"], "mapping_id").select("applicant_id", "original", "selected")
    notes = t["manual_reject_x"].join(broadcast_if_small(t["reject_note"]), "note_id", "left").select("applicant_id", "note")
    reasons = t["lead_reject_x"].join(broadcast_if_small(t["lead_reject_reason"]), "reason_id", "left").select("lead_id", "reason")
    people = t["applicant"].select(c("id").alias("applicant_id"), "type", "loan_amount", "auto_ok", "auto_approved")
    for part in (lead_plan.model_lookups(t, PARAMS), lead_plan.bureau_lookups(t, PARAMS), stores, upsell, notes):
        people = people.join(part, "applicant_id", "left")
    leads = t["lead_log"].select("lead_id", "applicant_id", "status").join(reasons, "lead_id", "left")
    rows = enrich(leads, people, "applicant_id", "inner")
    return rows.select(
        c("applicant_id").alias("id"),
        labels.store_label(c("first_store_id"), c("tracked_model"), c("tracked_store_id"), c("bureau_store_id"), PARAMS).alias("store_label"),
        money.sell_type(c("original"), c("selected"), c("loan_amount")).alias("sell_type"),
        labels.approval_path(c("auto_ok"), c("auto_approved"), c("type")).alias("approval_path"),
        labels.rejection_reason(c("status"), c("type"), c("note"), c("reason")).alias("rejection_reason"),
        money.loan_amount(c("loan_amount")).cast("double").alias("amount"),
    )


@query(
    "service_costs",
    with_star(
        """
SELECT coalesce(store_id, 'none') AS store, count(*) AS n,
  CAST(sum(CASE WHEN strpos(response, '<LoanPerformance>') > 0 THEN risk ELSE 0 END) AS DOUBLE) AS loan_performance_cost,
  CAST(sum(CASE WHEN strpos(response, '<IDV>') > 0 THEN idv ELSE 0 END) AS DOUBLE) AS id_logic_cost,
  CAST(sum(CASE WHEN strpos(response, '<ChexAdvisor>') > 0 THEN chex ELSE 0 END) AS DOUBLE) AS account_check_cost,
  CAST(sum(CASE WHEN strpos(response, '<Service Name="TraditionalCreditAttributes">') > 0 THEN 0.70 ELSE 0 END) AS DOUBLE) AS credit_attributes_cost,
  CAST(sum(CASE WHEN store_id = '0020' THEN 0.06 ELSE 0 END) AS DOUBLE) AS military_cost,
  CAST(sum(CASE WHEN risk_score < 30 THEN 0.005 ELSE 0 END) AS DOUBLE) AS carrier_cost
FROM bureau_response, cost_per_service GROUP BY 1
""",
        "bureau_response", "cost_per_service",
    ),
)
def service_costs(spark, folder):
    t = star(spark, folder, "bureau_response", "cost_per_service")
    c, p, m = F.col, PARAMS.prices, PARAMS.markers
    unit = lambda name: t["cost_per_service"].select(name).scalar()
    parts = {
        "loan_performance_cost": money.marker_cost(c("response"), m.loan_performance, unit("risk")),
        "id_logic_cost": money.marker_cost(c("response"), m.identity, unit("idv")),
        "account_check_cost": money.marker_cost(c("response"), m.account, unit("chex")),
        "credit_attributes_cost": money.marker_cost(c("response"), m.credit_attributes, p.credit_attributes),
        "military_cost": money.unit_cost(c("store_id") == PARAMS.military_store, p.military),
        "carrier_cost": money.unit_cost(c("risk_score") < 30, p.carrier),
    }
    sums = [F.sum(column).cast("double").alias(name) for name, column in parts.items()]
    return t["bureau_response"].groupBy(F.coalesce("store_id", F.lit("none")).alias("store")).agg(F.count("*").alias("n"), *sums)


@query(
    "lead_costs",
    with_star(
        """
SELECT l.lead_id, CAST(CASE
    WHEN lower(p.traffic_source) <> 'organic' AND p.name NOT IN ('Partner 6', 'Partner 7', 'Partner 8') AND lower(l.status) = 'accepted' THEN p.lead_price
    WHEN p.name IN ('Partner 6', 'Partner 7') AND lower(l.status) = 'accepted' AND a.type = 'Approved' THEN 0.25 * coalesce(TRY_CAST(a.loan_amount AS DECIMAL(10,2)), 0)
    WHEN p.name = 'Partner 8' AND lower(l.status) = 'accepted' AND a.type = 'Approved' THEN 75
    WHEN p.name = 'Partner 9' AND a.type = 'Accepted' THEN 11 ELSE 0 END AS DOUBLE) AS new_lead_cost,
  CAST(CASE WHEN lower(p.traffic_source) <> 'organic' AND lower(l.status) = 'accepted' AND a.id IS NULL THEN p.lead_price ELSE 0 END AS DOUBLE) AS renewal_lead_cost,
  CAST(CASE WHEN a.id IS NULL AND lower(l.status) = 'accepted' THEN 1 ELSE 0 END AS BIGINT) AS existing_customer,
  CAST(coalesce(p.lead_price, 0) AS DOUBLE) AS lead_price
FROM lead_log l LEFT JOIN applicant a ON a.id = l.applicant_id LEFT JOIN partner p ON lower(p.username) = lower(l.username)
""",
        "lead_log", "applicant", "partner",
    ),
)
def lead_costs(spark, folder):
    c = F.col
    t = star(spark, folder, "lead_log", "applicant", "partner")
    people = t["applicant"].select(c("id").alias("applicant_id"), c("id").alias("found_id"), "type", "loan_amount")
    partners = t["partner"].select(F.lower("username").alias("partner"), "name", "traffic_source", "lead_price")
    leads = t["lead_log"].select("lead_id", "applicant_id", "status", F.lower("username").alias("partner"))
    rows = enrich(leads, people, "applicant_id").join(broadcast_if_small(partners), "partner", "left")
    cost = money.new_lead_cost(
        c("traffic_source"), c("name"), c("status"), c("type"), c("found_id"), c("lead_price"), money.loan_amount(c("loan_amount")), PARAMS
    )
    return rows.select(
        "lead_id",
        cost.cast("double").alias("new_lead_cost"),
        money.renewal_lead_cost(c("traffic_source"), c("status"), c("found_id"), c("lead_price")).cast("double").alias("renewal_lead_cost"),
        money.existing_customer(c("status"), c("found_id")).cast("bigint").alias("existing_customer"),
        F.coalesce("lead_price", F.lit(0)).cast("double").alias("lead_price"),
    )


@query(
    "set_replacement",
    """
SELECT CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'GOODS' ELSE c_mktsegment END AS segment,
  coalesce(CASE WHEN c_nationkey < 5 THEN NULL ELSE 'N' || c_nationkey END, 'BrandNew') AS status, count(*) AS n,
  round(sum(CAST(c_acctbal AS DECIMAL(18,2))) / count(*), 4) AS per_row
FROM customer GROUP BY 1, 2
""",
)
def set_replacement(spark, folder):
    customers = table(spark, folder, "customer").select(
        text.replace_in_set(F.col("c_mktsegment"), ["MACHINERY", "FURNITURE"], "GOODS").alias("segment"),
        F.when(F.col("c_nationkey") >= 5, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("status"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
    )
    grouped = customers.fillna("BrandNew", ["status"]).groupBy("segment", "status").agg(F.count("*").alias("n"), F.sum("balance").alias("total"))
    return grouped.select("segment", "status", "n", F.round(money.ratio(F.col("total"), F.col("n")), 4).alias("per_row"))


BANK_TEXT_SQL = """
  CASE CAST(s_suppkey % 10 AS INT) WHEN 0 THEN 'jp chase' WHEN 1 THEN 'BankOf America' WHEN 2 THEN 'bankofamerica na'
    WHEN 3 THEN 'Wells Fargo Bank' WHEN 4 THEN 'pnc' WHEN 5 THEN 'Citibank' WHEN 6 THEN 'citizens' WHEN 7 THEN 'Wachovia corp'
    WHEN 8 THEN NULL ELSE 'woodforest nb' END
"""


@query(
    "bank_names",
    f"""
SELECT s_suppkey, CASE WHEN b LIKE '%CHAS%' THEN 'CHASE' WHEN b LIKE '%BANKOFAMERICA%' OR b LIKE '%BANKOF AMERICA%' THEN 'BANK OF AMERICA'
    WHEN b LIKE '%WELLS FARGO%' THEN 'WELLS FARGO' WHEN b LIKE '%PNC%' THEN 'PNC' WHEN b LIKE '%CITIBANK%' THEN 'CITI' ELSE b END AS trained,
  CASE WHEN b LIKE '%CHAS%' THEN 'CHASE' WHEN b LIKE '%BANKOFAMERICA%' OR b LIKE '%BANKOF AMERICA%' THEN 'BANK OF AMERICA'
    WHEN b LIKE '%WELLS FARGO%' THEN 'WELLS FARGO' WHEN b LIKE '%PNC%' THEN 'PNC' WHEN b LIKE '%WACHOVIA%' THEN 'WACHOVIA'
    WHEN b LIKE '%WOODFOREST%' THEN 'WOODFOREST NATIONAL BANK' WHEN b LIKE '%CITI%' THEN 'CITI' ELSE b END AS scored
FROM (SELECT s_suppkey, upper({BANK_TEXT_SQL}) AS b FROM supplier)
""",
)
def bank_names(spark, folder):
    rows = table(spark, folder, "supplier").select("s_suppkey", F.expr(BANK_TEXT_SQL).alias("bank"))
    return rows.select(
        "s_suppkey",
        text.canonical_name(F.col("bank"), BANK_RULES_TRAINING).alias("trained"),
        text.canonical_name(F.col("bank"), BANK_RULES_SCORING).alias("scored"),
    )


VENDOR_TEXT_SQL = """
  CASE event_type WHEN 'click' THEN CAST(CAST(value AS DECIMAL(10,2)) AS STRING) || '%[1/1/2020]' WHEN 'view' THEN NULL
    WHEN 'error' THEN '' ELSE event_type || '.example.com.some-very-long-domain[7/7/2017]' END
"""
PERCENT_TEXT_SQL = """
  CASE event_type WHEN 'click' THEN CAST(CAST(value AS DECIMAL(10,2)) AS STRING) || '%' WHEN 'view' THEN '%' WHEN 'error' THEN 'n/a'
    WHEN 'signup' THEN NULL ELSE CAST(CAST(value AS DECIMAL(10,2)) AS STRING) END
"""


@query(
    "prefix_percent_number",
    f"""
SELECT event_id, regexp_extract(substr(v, 1, 30), '^[^\\[%]*') AS prefix,
  round(TRY_CAST(trim(p, '%') AS DOUBLE) / 100, 6) AS fraction,
  round(TRY_CAST(regexp_extract(substr(v, 1, 30), '^[^\\[%]*') AS DOUBLE) / 100, 6) AS number
FROM (SELECT event_id, {VENDOR_TEXT_SQL} AS v, {PERCENT_TEXT_SQL} AS p FROM events)
""",
)
def prefix_percent_number(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.expr(VENDOR_TEXT_SQL).alias("v"), F.expr(PERCENT_TEXT_SQL).alias("p"))
    prefix = text.prefix_before_bracket(F.col("v"))
    return rows.select(
        "event_id",
        prefix.alias("prefix"),
        F.round(text.percent_to_fraction(F.col("p")), 6).alias("fraction"),
        F.round(text.to_number(prefix, 100), 6).alias("number"),
    )


@query(
    "date_differences",
    """
SELECT o_orderpriority AS priority, count(*) AS n, CAST(min(d) AS DOUBLE) AS least, CAST(max(d) AS DOUBLE) AS most,
  round(CAST(sum(CAST(d AS DECIMAL(18,0))) AS DOUBLE) / count(*), 6) AS mean
FROM (SELECT o_orderpriority, date_diff('day', o_orderdate, l_shipdate) AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      WHERE o_orderdate >= TIMESTAMP '1996-03-01')
GROUP BY 1
""",
)
def date_differences(spark, folder):
    written = F.date_format("o_orderdate", "M/d/yyyy")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", written.alias("written"))
    recent = orders.where(dates.parse_text_date(F.col("written")) >= F.lit("1996-03-01").cast("timestamp"))
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    gap = dates.days_between(dates.parse_text_date(F.col("written")), F.col("l_shipdate").cast("timestamp"))
    rows = enrich(lines, recent, "o_orderkey", "inner").select(F.col("o_orderpriority").alias("priority"), gap.alias("days"))
    return rows.groupBy("priority").agg(
        F.count("*").alias("n"), F.min("days").alias("least"), F.max("days").alias("most"),
        F.round(F.sum(F.col("days").cast("decimal(18,6)")).cast("double") / F.count("*"), 6).alias("mean"),
    )


PERIOD_SQL = """
  CASE event_id % 9 WHEN 0 THEN 'Hourly' WHEN 1 THEN 'Daily' WHEN 2 THEN 'Weekly' WHEN 3 THEN 'Bi-weekly' WHEN 4 THEN 'Semi-monthly'
    WHEN 5 THEN 'Monthly' WHEN 6 THEN 'Annual' WHEN 7 THEN 'N/A' ELSE NULL END
"""


@query(
    "monthly_income",
    f"""
SELECT event_id, round(m, 6) AS monthly, round_even(m, 0) AS rounded FROM (
  SELECT event_id, CASE p WHEN 'Hourly' THEN value * 2080 / 12 WHEN 'Daily' THEN value * 260 / 12 WHEN 'Weekly' THEN value * 52 / 12
    WHEN 'Bi-weekly' THEN value * 26 / 12 WHEN 'Semi-monthly' THEN value * 2 WHEN 'Monthly' THEN value WHEN 'Annual' THEN value / 12
    ELSE 0 END AS m FROM (SELECT event_id, value, {PERIOD_SQL} AS p FROM events))
""",
)
def monthly_income(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "value", F.expr(PERIOD_SQL).alias("period"))
    return rows.select(
        "event_id",
        F.round(money.monthly_income(F.col("period"), F.col("value")), 6).alias("monthly"),
        money.monthly_income(F.col("period"), F.col("value"), rounded=True).alias("rounded"),
    )


@query(
    "state_names",
    """
SELECT c_custkey, n_name AS name_y, code, CASE code WHEN 'CA' THEN 'California' WHEN 'TX' THEN 'Texas' WHEN 'NY' THEN 'New York'
    WHEN 'PR' THEN 'Puerto Rico' END AS state_name
FROM (SELECT c_custkey, c_nationkey, CASE c_nationkey % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'NY' WHEN 3 THEN 'PR' ELSE 'ZZ' END AS code FROM customer)
JOIN nation ON n_nationkey = c_nationkey
""",
)
def state_names(spark, folder):
    code = F.element_at(F.array(*[F.lit(c) for c in ("CA", "TX", "NY", "PR", "ZZ")]), F.col("c_nationkey") % 5 + 1)
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("nation_id"), F.col("c_name").alias("name"), code.alias("code"))
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    joined = join_renamed(customers, nations, "nation_id", "key")
    return joined.select("c_custkey", "name_y", "code", text.lookup_literal(F.col("code"), STATE_NAMES).alias("state_name"))


@query(
    "binary_labels",
    """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'P' THEN 0 END AS DOUBLE) AS status_code,
  CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS residence_code, CAST(o_orderkey % 3 AS DOUBLE) AS number_code
FROM orders
""",
)
def binary_labels(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status_code"),
        F.when(F.col("o_orderkey") % 2 == 0, "Rent").otherwise("Own").alias("residence_code"),
        (F.col("o_orderkey") % 3).cast("string").alias("number_code"),
    )
    return encode_binary(orders, ["status_code", "residence_code", "number_code"], BINARY_LABELS)


# --- filters ----------------------------------------------------------------------


@query(
    "date_range_filter",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2001-06-30'
""",
)
def date_range_filter(spark, folder):
    rows = membership.between_dates(table(spark, folder, "orders"), "o_orderdate", F.lit(PARAMS.start), F.lit(PARAMS.as_of))
    return shape(rows.withColumn("day", F.col("o_orderdate")), o_orderkey="bigint", day="day")


@query(
    "id_or_reserved",
    with_star("SELECT id, type FROM applicant WHERE id > 9000 OR id IN (SELECT applicant_id FROM reserved_applicants)", "applicant", "reserved_applicants"),
)
def id_or_reserved(spark, folder):
    t = star(spark, folder, "applicant", "reserved_applicants")
    return membership.above_or_listed(t["applicant"].select("id", "type"), "id", 9000, t["reserved_applicants"], "applicant_id")


@query("id_list", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (3, 5, 8, 13, 21, 34, 55, 89, 144)")
def id_list(spark, folder):
    return membership.in_list(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", [3, 5, 8, 13, 21, 34, 55, 89, 144])


@query(
    "exists_and_not",
    """
SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'with' ELSE 'without' END AS orders
FROM customer
""",
)
def exists_and_not(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey")
    owners = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    found = membership.exists(customers, owners, "c_custkey").withColumn("orders", F.lit("with"))
    return found.unionByName(membership.not_exists(customers, owners, "c_custkey").withColumn("orders", F.lit("without")))


@query(
    "marker_flags",
    """
SELECT doc_id, CAST(CASE WHEN strpos(lower(text), 'the ') > 0 THEN 1 ELSE 0 END AS BIGINT) AS has_word,
  CAST(CASE WHEN strpos(lower(text), 'license') = 0 THEN 1 ELSE 0 END AS BIGINT) AS no_license
FROM documents
""",
)
def marker_flags(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select(
        "doc_id",
        text.flag(text.contains_text(F.col("text"), "the ")).cast("bigint").alias("has_word"),
        text.flag(~text.contains_text(F.col("text"), "LICENSE")).cast("bigint").alias("no_license"),
    )


@query(
    "quality_probe",
    """
SELECT count(*) FILTER (text NOT LIKE '%]') AS unterminated, count(*) FILTER (strpos(text, 'on') = 0) AS "without_on",
  count(*) FILTER (strpos(text, 'zz') = 0) AS "without_zz" FROM documents
""",
)
def quality_probe(spark, folder):
    documents = table(spark, folder, "documents").select("text")
    return membership.quality_probe(documents, "text", ["on", "zz"])
