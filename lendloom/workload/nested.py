"""Columns from XML and JSON text."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendloom.operators import jsontab, xmltab
from lendloom.operators.skew import spread
from lendloom.plans.leads import bureau_documents
from lendloom.plans.scoring import assemble_applicants
from lendloom.workload.registry import query, shape, table
from lendloom.workload.star import PARAMS, star, with_star


@query(
    "xml_named_values",
    with_star(
        """
SELECT lead_id, CASE WHEN form = 2 THEN income_monthly END AS income_monthly, CASE WHEN form = 2 THEN bank_name END AS bank_name,
  CASE WHEN form = 2 THEN dob_m || '/' || dob_d || '/' || dob_y END AS dob, CASE WHEN form = 2 THEN bank_months END AS bank_length_months,
  CASE WHEN form = 2 THEN loan_desired END AS loan_amount_desired, CASE WHEN form = 2 THEN sub_id END AS sub_id
FROM lead_values
""",
        "lead_values",
    ),
)
def xml_named_values(spark, folder):
    parsed = xmltab.named_values(spread(star(spark, folder, "lead_log")["lead_log"].select("lead_id", "xml_in")), "xml_in")
    c = F.col
    return parsed.select(
        "lead_id", "income_monthly", "bank_name",
        F.concat(c("date_dob_m"), F.lit("/"), c("date_dob_d"), F.lit("/"), c("date_dob_y")).alias("dob"),
        "bank_length_months", "loan_amount_desired", "sub_id",
    )


@query(
    "xml_paths",
    with_star(
        """
SELECT id, CASE WHEN response IS NOT NULL AND id % 2 = 0 THEN CAST(id % 9 AS VARCHAR) END AS inner_paid_off,
  CASE WHEN response IS NOT NULL THEN CAST(id % 7 AS VARCHAR) END AS outer_paid_off
FROM bureau_response
""",
        "bureau_response",
    ),
)
def xml_paths(spark, folder):
    loans = "LoanPerformance struct<NumberofLoansPaidOff:string>"
    schema = f"ApplicationInfo struct<LoanPerformance:struct<NumberofLoansPaidOff:string>>, {loans}"
    rows = spread(star(spark, folder, "bureau_response")["bureau_response"]).select("id", xmltab.parse_xml(F.col("response"), schema).alias("doc"))
    return rows.select(
        "id",
        F.col("doc.ApplicationInfo.LoanPerformance.NumberofLoansPaidOff").alias("inner_paid_off"),
        F.col("doc.LoanPerformance.NumberofLoansPaidOff").alias("outer_paid_off"),
    )


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v if isinstance(v, T.DataType) else T.StringType()) for k, v in fields.items()])


FLAT_SCHEMA = _struct(
    Status=None,
    ApplicationInfo=_struct(LoanPerformance=_struct(NumberofLoansPaidOff=None)),
    IDV=_struct(Score=None),
    ChexAdvisor=_struct(Score=None),
    LoanPerformance=_struct(NumberofLoansPaidOff=None),
)


@query(
    "xml_flatten",
    with_star(
        """
SELECT id, CASE WHEN response IS NOT NULL THEN CAST(id % 7 AS VARCHAR) END AS "NumberofLoansPaidOff",
  CASE WHEN response IS NULL THEN NULL WHEN id % 4 = 0 THEN '2' WHEN id % 3 = 0 THEN '1' END AS "Score"
FROM bureau_response
""",
        "bureau_response",
    ),
)
def xml_flatten(spark, folder):
    return xmltab.flatten_xml(spread(star(spark, folder, "bureau_response")["bureau_response"]), "response", FLAT_SCHEMA, keep=["id"])


# Replies without a declared schema: a tag of the last document alone, repeated and missing tags, every fiftieth cut off.
REPLIES_SQL = """
SELECT o_orderkey, '<reply><made>' || CAST(o_custkey AS STRING) || '</made><scores at="x"><main>' || CAST(o_custkey AS STRING) || '</main>'
    || CASE WHEN o_orderkey % 3 = 0 THEN '<main>00' || CAST(o_orderkey % 50 AS STRING) || '</main>' ELSE '' END || '</scores>'
    || CASE WHEN o_orderkey % 4 = 0 THEN '<person><address><zip>0' || CAST(o_custkey % 100 AS STRING) || '</zip><kind>' || o_orderstatus || '</kind></address></person>' ELSE '' END
    || CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM {orders}) THEN '<tail><note>last &amp; least</note></tail>' ELSE '' END
    || CASE WHEN o_orderkey % 50 = 7 THEN '' ELSE '</reply>' END AS reply
FROM {orders}
"""


@query(
    "xml_flatten_open",
    """
SELECT o_orderkey, CASE WHEN cut THEN NULL WHEN o_orderkey % 3 = 0 THEN '00' || (o_orderkey % 50) ELSE CAST(o_custkey AS VARCHAR) END AS main,
  CASE WHEN NOT cut AND o_orderkey % 4 = 0 THEN '0' || (o_custkey % 100) END AS zip, CASE WHEN NOT cut AND o_orderkey % 4 = 0 THEN o_orderstatus END AS kind,
  CASE WHEN NOT cut AND o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'last & least' END AS note
FROM (SELECT *, o_orderkey % 50 = 7 AS cut FROM orders)
""",
)
def xml_flatten_open(spark, folder):
    replies = spark.sql(REPLIES_SQL, orders=spread(table(spark, folder, "orders")))
    return xmltab.flatten_open(replies, "reply", keep=["o_orderkey"])


@query(
    "bureau_documents",
    with_star(
        """
SELECT a.id AS applicant_id, md5(b.response) AS digest FROM applicant a
  JOIN (SELECT applicant_id, response FROM (SELECT *, row_number() OVER (PARTITION BY applicant_id ORDER BY id) AS rn
        FROM bureau_response WHERE store_id <> '0020') WHERE rn = 1) b ON b.applicant_id = a.id
WHERE b.response IS NOT NULL AND (a.id > 60 OR a.id IN (SELECT applicant_id FROM reserved_applicants))
""",
        "applicant", "bureau_response", "reserved_applicants",
    ),
)
def bureau_texts(spark, folder):
    t = star(spark, folder, "applicant", "bureau_response", "reserved_applicants")
    rows = bureau_documents(t, PARAMS)
    return rows.select("applicant_id", F.md5("response").alias("digest"))


# A list of jobs per event: number of jobs, truncation and quoting follow from the id.
JOBS_SQL = """
SELECT event_id,
  CASE WHEN event_type = 'signup' THEN 'no list'
    WHEN event_type = 'error' THEN '[' || first_job || ', ' || second_job || ', ' || third_job || ', {{"Summ'
    WHEN event_type = 'purchase' THEN replace('[' || first_job || ',' || third_job || ',{{"Summary":1},{{"Sent":None}}]', '"', '~')
    WHEN event_type = 'view' THEN '[{{"Summary":1}},{{"Sent":True}}]'
    ELSE '[' || first_job || ', ' || second_job || ', {{"Summary": 1}}, {{"Sent": None}}]' END AS response
FROM (SELECT event_id, event_type,
    '{{"EmploymentStatus":"' || CASE WHEN event_id % 3 = 0 THEN 'Active' ELSE 'Inactive' END || '","CurrDateAsOf":"' || CAST(1 + event_id % 12 AS STRING)
      || '/1/2020","PaymentFrequency":"Weekly","PeriodPaymentInfo":"Weekly","PeriodIncome":"' || CAST(CAST(value AS DECIMAL(10,2)) AS STRING) || '"}}' AS first_job,
    '{{"EmploymentStatus":"' || CASE WHEN event_id % 2 = 0 THEN 'Active' ELSE 'Inactive' END || '","CurrDateAsOf":"' || CAST(1 + event_id % 7 AS STRING)
      || '/1/2020","PaymentFrequency":"Monthly","PeriodPaymentInfo":"Monthly","PeriodIncome":"' || CAST(event_id % 5000 AS STRING) || '"}}' AS second_job,
    '{{"EmploymentStatus":"Inactive","CurrDateAsOf":"9/9/2020"}}' AS third_job
  FROM {events})
""".replace('1},{{"Sent":None}}]\'', '1}},{{"Sent":None}}]\'')


def jobs(spark, folder):
    rows = spark.sql(JOBS_SQL, events=spread(table(spark, folder, "events")))
    return rows.withColumn("response", F.translate("response", "~", "'"))


# What the lists hold, from the columns they are built of. After a cut the last two real jobs are lost.
JOB_FACTS_SQL = """
SELECT event_id, event_type,
  CASE event_type WHEN 'click' THEN 2 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END AS employers,
  event_id % 3 = 0 AND event_type IN ('click', 'error', 'purchase') AS first_active,
  event_id % 2 = 0 AND event_type = 'click' AS second_active,
  (1 + event_id % 12) || '/1/2020' AS first_date, (1 + event_id % 7) || '/1/2020' AS second_date,
  CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS first_income, CAST(event_id % 5000 AS VARCHAR) AS second_income
FROM events WHERE event_type <> 'signup'
"""


@query(
    "employment_rollup",
    f"""
SELECT event_id, CAST(employers AS BIGINT) AS employer_count, CAST(CAST(first_active AS INT) + CAST(second_active AS INT) AS BIGINT) AS active_count,
  CASE pick WHEN 1 THEN 'Weekly' WHEN 2 THEN 'Monthly' ELSE 'N/A' END AS period_payment_info,
  CASE pick WHEN 1 THEN first_income WHEN 2 THEN second_income ELSE '0' END AS period_income,
  round_even(CASE pick WHEN 1 THEN CAST(first_income AS DOUBLE) * 52 / 12 WHEN 2 THEN CAST(second_income AS DOUBLE) ELSE 0 END, 0) AS monthly_income
FROM (SELECT *, CASE WHEN first_active AND (NOT second_active OR first_date >= second_date) THEN 1 WHEN second_active THEN 2 ELSE 0 END AS pick
  FROM ({JOB_FACTS_SQL}))
""",
)
def employment_rollup(spark, folder):
    rolled = jsontab.add_monthly_income(jsontab.employment_rollup(jobs(spark, folder), "response"))
    return shape(
        rolled, event_id="bigint", employer_count="bigint", active_count="bigint", period_payment_info="string", period_income="string",
        monthly_income="double",
    )


@query(
    "assembled_applicants",
    f"""
SELECT event_id, user_id AS application_id, round(c_acctbal, 2) AS balance, CASE user_id % 4 WHEN 0 THEN 'California' WHEN 1 THEN 'Texas' WHEN 2 THEN 'Guam' END AS state_name,
  CAST(employers AS BIGINT) AS employer_count,
  round_even(CASE WHEN first_active AND (NOT second_active OR first_date >= second_date) THEN CAST(first_income AS DOUBLE) * 52 / 12
    WHEN second_active THEN CAST(second_income AS DOUBLE) ELSE 0 END, 0) AS monthly_income
FROM ({JOB_FACTS_SQL}) JOIN events USING (event_id) JOIN customer ON c_custkey = user_id
""",
)
def assembled_applicants(spark, folder):
    """Bureau rows and customer rows joined and completed, as before scoring."""
    bureau = table(spark, folder, "customer").select(F.col("c_custkey").alias("application_id"), F.col("c_acctbal").alias("balance"))
    code = F.element_at(F.array(*[F.lit(s) for s in ("CA", "TX", "GU", "??")]), (F.col("user_id") % 4 + 1).cast("int"))
    owners = table(spark, folder, "events").select("event_id", F.col("user_id").alias("applicant_id"), code.alias("state"))
    customers = jobs(spark, folder).withColumnRenamed("response", "employment_response").join(owners, "event_id")
    rows = assemble_applicants(bureau, customers)
    return shape(
        rows, event_id="bigint", application_id="bigint", balance="r2", state_name="string", employer_count="bigint", monthly_income="double"
    )


@query(
    "list_repair",
    """
SELECT event_id, CAST(CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 2 WHEN 'error' THEN 3 ELSE 4 END AS BIGINT) AS elements
FROM events WHERE event_type <> 'signup'
""",
)
def list_repair(spark, folder):
    lists = jobs(spark, folder).where(F.startswith("response", F.lit("[")))
    closed = lists.withColumn("closed", jsontab.close_truncated(F.col("response")))
    size = F.length(F.regexp_replace("closed", "[^{]", ""))
    return closed.select("event_id", size.cast("bigint").alias("elements"))
