"""Operational tables: declared schemas and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "lead_log": "lead_id bigint, applicant_id bigint, lead_ts timestamp, status string, username string, view_ts timestamp, signature_ts timestamp, xml_in string",
    "applicant": "id bigint, social string, type string, stage_id string, dte date, app_ts timestamp, date_due date, dob date, salary string, loan_amount string, email string, state string, bank string, routing string, job_length string, direct_deposit string, verified int, aff_id string, auto_ok int, auto_approved int",
    "applicant_mapping": "mapping_id bigint, applicant_id bigint, account_id bigint",
    "renewal_lead": "lead_id bigint, log_id bigint, loan_amount decimal(10,2)",
    "renewal_log": "log_id bigint, cust_id bigint",
    "account": "id bigint, social string, type string, aff_id string, date_due date",
    "ledger": "id bigint, ss string, type string, net decimal(18,4), paidprin decimal(18,2), paidint decimal(18,2), payment decimal(18,2), dte date, reference_id bigint",
    "partner": "username string, name string, traffic_source string, lead_price decimal(10,2)",
    "states": "name string, abbr string",
    "upsell_log": "mapping_id bigint, original decimal(10,2), selected decimal(10,2), max_amount decimal(10,2)",
    "auto_failure_x_applicant": "applicant_id bigint, reason_id bigint",
    "auto_failure_reason": "reason_id bigint, reason string",
    "contract_tracker": "lead_id bigint, link_open_ts timestamp",
    "carrier_log": "id bigint, applicant_id bigint, phone_type string, status string, response string",
    "identity_log": "applicant_id bigint, status string, fraud_score int, response_ts timestamp",
    "bank_account": "mapping_id bigint, bank_account_id bigint",
    "bank_verify_log": "bank_account_id bigint, code string, inquiry_ts timestamp, location string",
    "open_transact_log": "id bigint, applicant_id bigint, result string",
    "bureau_response": "id bigint, applicant_id bigint, store_id string, risk_score int, response string",
    "store_two": "id bigint, applicant_id bigint, store_id int, score int, paid_off int",
    "employment_request": "id bigint, social string, mapping_id bigint, source string, request_ts timestamp, response string",
    "model_tracking": "id bigint, applicant_id bigint, model string, decision string, store_id int",
    "app_notes": "id bigint, cust_id bigint, note_ts timestamp, submitted_by string, note string",
    "ach_status": "id bigint, account_id bigint, type string, status string, return_code string",
    "credit_card": "mapping_id bigint",
    "lead_reject_x": "lead_id bigint, reason_id bigint",
    "lead_reject_reason": "reason_id bigint, reason string",
    "manual_reject_x": "applicant_id bigint, note_id bigint",
    "reject_note": "note_id bigint, note string",
    "reserved_applicants": "applicant_id bigint",
    "cost_per_service": "chex decimal(10,2), idv decimal(10,2), risk decimal(10,2)",
}


def read_tables(spark: SparkSession, folder: str, names=None) -> dict[str, DataFrame]:
    """Parquet tables of a folder with the declared schemas."""
    return {name: spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}") for name in (names or SCHEMAS)}


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """One table over JDBC, read in ``parts`` ranges of its numeric key."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, fetchsize=10_000, **options
    )
    return reader.load()


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
