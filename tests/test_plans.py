"""The lead plan on declared schemas, on small operational tables, and with hot keys."""

import datetime as dt

import oracle
import pytest
from pyspark.sql import functions as F

from lendloom.params import LeadParams
from lendloom.plans import leads
from lendloom.sources.tables import SCHEMAS, empty_tables, read_tables
from lendloom.workload.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
P = LeadParams(as_of=dt.date(2021, 6, 30), start=dt.date(2021, 1, 1), id_threshold=100, sub_id_partner="cutter", bot_user="bot")


def moment(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def tables(spark):
    """Two applications of one person (the second with a lead and an answer), one person without a social, one reserved id."""
    day = dt.date(2021, 3, 1)
    xml = '<?xml version="1.0"?><loan_request><data name="loan_amount_desired">500</data><data name="income_monthly">$6000</data>' \
        '<data name="date_dob_m">3</data><data name="date_dob_d">1</data><data name="date_dob_y">1981</data><data name="email_primary">a@b.c</data></loan_request>'
    applicant = lambda i, social, kind: (i, social, kind, "18", day, moment("2021-03-01 06:00:00"), dt.date(2021, 3, 31), None, "$1", "500", None, "Texas", None, None, None, None, 1, "x-y", 1, 0)
    data = {
        "lead_log": [(1, 102, moment("2021-03-02 10:00:00"), "ACCEPTED", "USER", None, None, xml), (2, None, moment("2021-03-02 10:00:00"), "Accepted", "user", None, None, xml),
                     (3, 103, moment("2021-03-02 10:00:00"), "Rejected", None, None, None, "<broken"), (4, 50, moment("2021-03-02 10:00:00"), "Other", None, None, None, None),
                     (5, 60, moment("2021-03-02 10:00:00"), "Other", None, None, None, None)],
        "applicant": [applicant(101, "S", "Rejected"), applicant(102, "S", "Approved"), applicant(103, None, "Approved"), applicant(50, "T", "Approved"), applicant(60, "U", "Approved")],
        "applicant_mapping": [(1102, 102, 9), (1103, 103, None), (1050, 50, None), (1060, 60, None)],
        "account": [(9, "AS", "t", "z", dt.date(2021, 3, 31))],
        "renewal_lead": [(1, 7, None)],
        "renewal_log": [(7, 9)],
        "ledger": [(1, "AS", "Payment", 10, 10, 1, 11, dt.date(2021, 4, 1), None), (2, "AS", "Reverted Payment", 0, 0, 0, 0, dt.date(2021, 4, 2), 1),
                   (3, "AS", "payment", 20, 20, 2, 22, dt.date(2021, 4, 20), None)],
        "partner": [("user", "cutter", None, None)],
        "states": [("Texas", "TX")],
        "employment_request": [(1, "S", 1102, "LEADS", moment("2021-03-01 09:05:00"), "first"), (2, "s2", 1102, "Leads", moment("2021-03-01 09:05:01"), "first"),
                               (3, "S", 1102, "Leads", moment("2021-03-01 09:05:01"), "second"), (4, "S", None, "File", moment("2018-11-30 00:00:00"), "x"),
                               (5, "S", None, "File", moment("2021-01-01 00:00:00"), '"EmployerName":""'), (6, None, 1103, "Leads", moment("2021-01-01 00:00:00"), None),
                               (7, "T", 1050, "Leads", moment("2021-01-01 00:00:00"), "t"), (8, "U", 1060, "Leads", moment("2021-01-01 00:00:00"), "u")],
        "app_notes": [(1, 102, moment("2021-03-01 00:00:59"), "bot", "x"), (2, 102, moment("2021-03-01 00:01:00"), "eve", "x"), (3, 102, moment("2021-03-01 00:02:00"), "bot", "x")],
        "ach_status": [(1, 9, "D", "Return", None)],
        "carrier_log": [(1, 102, "Homephone", "ok", None), (2, 102, "homephone", "ok", None), (3, 102, "Cellphone", "a", None), (4, 102, "Cellphone", "b", None)],
        "reserved_applicants": [(50,)],
        "cost_per_service": [(1, 2, 3)],
    }
    from decimal import Decimal

    def frame(name):
        rows = data.get(name, [])
        decimal = [" decimal" in part for part in SCHEMAS[name].split(", ")]
        fixed = [tuple(Decimal(v) if d and v is not None else v for v, d in zip(row, decimal)) for row in rows]
        return spark.createDataFrame(fixed, SCHEMAS[name])

    return {name: frame(name) for name in SCHEMAS}


def test_empty_tables_give_no_rows(spark):
    wide = leads.wide_leads(empty_tables(spark), P, with_defaults=True)
    assert wide.count() == 0 and len(set(wide.columns)) == len(wide.columns)


def test_small_tables(tables):
    rows = leads.wide_leads(tables, P, with_defaults=True).collect()
    # lead 2 has no application, lead 5 is below the threshold and not reserved
    assert sorted({r["lead_id"] for r in rows}) == [1, 3, 4]
    first = [r for r in rows if r["lead_id"] == 1]
    # two distinct answers times two cell states; the doubled home state does not multiply
    assert len(first) == 4 and {r["employment_response"] for r in first} == {"first", "second"}
    row = first[0]
    assert (row["pre_status"], row["state_abbr"], row["age"], row["email_domain"], str(row["payment_ratio"])) == ("Rejected", "TX", 40, "b.c", "0.0500")
    assert (row["affiliate"], row["affiliate_group"], row["lead_price"]) == ("cutter", "Other", 0)
    # a lead inquiry 300 seconds off counts, one 301 seconds off does not; the file inquiry has the early price
    assert (row["employment_inquiries"], float(row["employment_cost"])) == (2, 9.8)
    # the first payment was reverted, the next one came 20 days late; a NULL return code is no failure
    assert (row["cycled"], row["first_payment_default"], row["failed_first_payment"], row["total_paid"]) == (1, 1, 0, 33)
    other = [r for r in rows if r["lead_id"] == 3]
    assert len(other) == 1 and other[0]["salary"] is None and other[0]["total_paid"] is None and other[0]["defaulted"] == 0
    assert (other[0]["employment_response"], other[0]["pre_status"], other[0]["employment_inquiries"]) == (None, None, 0)


def test_rows_of_a_lead_are_counted_as_they_multiply(tables):
    wide, counted = leads.wide_leads(tables, P), leads.counted_leads(tables, P)
    made = {r["lead_id"]: r["count"] for r in wide.groupBy("lead_id").count().collect()}
    assert {r["lead_id"]: r["n_rows"] for r in counted.collect()} == made and max(made.values()) == 4
    # documents and what multiplies rows do not go through the joins that multiply them
    assert not {"bureau_response", "employment_response", "carrier_name"} & set(counted.columns)


def test_notes(tables):
    found = leads.note_lookups(tables, P).collect()
    assert [(r["applicant_id"], r["response_minutes"], r["response_seconds"]) for r in found] == [(102, 1, 1)]


def test_tables_are_read_with_declared_schemas(spark, tables, tmp_path):
    for name in ("lead_log", "ledger"):
        tables[name].write.parquet(f"{tmp_path}/{name}")
    back = read_tables(spark, str(tmp_path), ["lead_log", "ledger"])
    assert back["ledger"].schema == tables["ledger"].schema and back["lead_log"].count() == 5


def test_hot_keys_do_not_change_the_leads(spark, monkeypatch):
    """Every join that can be salted is, for the most frequent keys of its base table."""

    def most_frequent(df, key, *_, **__):
        top = df.where(F.col(key).isNotNull()).groupBy(key).count().orderBy(F.desc("count"), key).limit(5)
        return spark.createDataFrame(top.select(key).collect(), top.select(key).schema).withColumn("_salts", F.lit(3))

    monkeypatch.setattr(leads, "hot_keys", most_frequent)
    assert oracle.compare(QUERIES["lead_wide"](spark, FOLDER), oracle.connect(FOLDER), ORACLES["lead_wide"]) == ""
