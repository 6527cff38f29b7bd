"""Scalar rules on small frames with the cases the sales tables cannot show."""

import datetime as dt

from pyspark.sql import functions as F

from lendloom.functions import dates, labels, money, text
from lendloom.params import BANK_RULES_SCORING, BANK_RULES_TRAINING, STATE_NAMES, LeadParams

P = LeadParams(as_of=dt.date(2021, 6, 30), start=dt.date(2021, 1, 1), id_threshold=100)
c = F.col


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_week_number_and_hours(spark):
    rows = spark.createDataFrame(
        [("2021-01-03 18:59:00",), ("2021-01-04 23:59:00",), ("2021-01-01 08:00:00",), ("2021-01-02 19:00:00",), ("2021-01-05 09:00:00",)], "t string"
    ).select(c("t").cast("timestamp").alias("t"))
    assert values(rows, dates.week_number(c("t"))) == [1, 2, 1, 1, 2]
    assert values(rows, dates.working_hour(c("t"))) == ["Hour", "Hour", "Off-Hour", "Off-Hour", "Hour"]


def test_boundaries_are_counted_not_elapsed_time(spark):
    rows = spark.createDataFrame([("2021-01-01 00:00:59.9", "2021-01-01 00:01:00.1")], "a string, b string")
    a, b = c("a").cast("timestamp"), c("b").cast("timestamp")
    assert rows.select(dates.minutes_crossed(a, b), dates.seconds_crossed(a, b), dates.days_crossed(a, b)).first() == (1, 1, 0)


def test_age(spark):
    rows = spark.createDataFrame([("0960-01-01",), ("1980-06-30",), ("2021-07-15",), (None,)], "d string").select(c("d").cast("date").alias("d"))
    assert values(rows, dates.age_years(c("d"), F.lit(P.as_of))) == [62, 41, 0, None]


def test_text_dates(spark):
    rows = spark.createDataFrame([("11/20/2018 12:00:00 AM",), ("7/7/2017 1:01:02 PM",), ("2/5/2015",), ("2015-02-05",), ("soon",), (None,)], "t string")
    found = values(rows, dates.parse_text_date(c("t")).cast("string"))
    assert found == ["2018-11-20 00:00:00", "2017-07-07 13:01:02", "2015-02-05 00:00:00", "2015-02-05 00:00:00", None, None]


def test_sub_id_only_for_one_partner(spark):
    rows = spark.createDataFrame([("cut", "a_b-c"), ("CUT", "a_b"), ("cut", "ab"), ("keep", "a-b"), (None, "a-b")], "p string, s string")
    assert values(rows, text.sub_id_root(c("p"), c("s"), "cut")) == ["a_b", "a", "ab", "a-b", "a-b"]


def test_months_and_domains(spark):
    rows = spark.createDataFrame([("02Y03M", "x@y.z "), ("11Y", "none"), (None, None)], "j string, e string")
    assert values(rows, text.months_on_job(c("j"))) == [3, -3, None]
    assert values(rows, text.months_on_job_from_digits(c("j"))) == [27, 132, None]
    assert values(rows, text.email_domain(c("e"))) == ["y.z", "none", None]


def test_bank_rules_differ_between_training_and_scoring(spark):
    rows = spark.createDataFrame([("my chase",), ("citizens",), ("Wachovia x",), ("other",), (None,)], "b string")
    assert values(rows, text.canonical_name(c("b"), BANK_RULES_TRAINING)) == ["CHASE", "CITIZENS", "WACHOVIA X", "OTHER", None]
    assert values(rows, text.canonical_name(c("b"), BANK_RULES_SCORING)) == ["CHASE", "CITI", "WACHOVIA", "OTHER", None]


def test_percent_prefix_number(spark):
    rows = spark.createDataFrame([("93%",), ("0.5",), ("%",), ("",), (None,)], "p string")
    assert values(rows, text.percent_to_fraction(c("p"))) == [0.93, 0.005, None, None, None]
    cut = spark.createDataFrame([("rr.com[7/7/2017]",), ("12%x",), ("a" * 40,), (None,)], "p string")
    assert values(cut, text.prefix_before_bracket(c("p"))) == ["rr.com", "12", "a" * 30, None]


def test_literal_words(spark):
    rows = spark.createDataFrame([("[None, True,{'a': False}]",), ("['None of it']",)], "t string")
    assert values(rows, text.read_quoted(c("t"))) == ["[null, true,{'a': false}]", "['None of it']"]


def test_payment_ratio_and_zero_income(spark):
    rows = spark.createDataFrame([("500", "$6000"), ("500", "0"), ("5oo", "10"), (None, "10")], "l string, s string")
    assert [str(v) if v is not None else None for v in values(rows, money.payment_ratio(c("l"), c("s")))] == ["0.0500", None, None, None]


def test_sell_type_reads_o_as_zero(spark):
    rows = spark.createDataFrame([(500, 300, "5oo"), (500, 300, "600"), (None, 300, "1"), (500, None, "1"), (500, 300, None)], "o int, s int, a string")
    assert values(rows, money.sell_type(c("o"), c("s"), c("a"))) == ["NOT UPSELL", "UPSELL", "NOT Offer", "NOT Offer", "NOT UPSELL"]


def test_one_null_part_zeroes_the_sum(spark):
    rows = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    assert values(rows, money.sum_or_zero(c("a"), c("b"))) == [3, 0]


def test_monthly_income(spark):
    periods = ["Hourly", "Daily", "Weekly", "Bi-weekly", "Semi-monthly", "Monthly", "Annual", "Yearly", None]
    rows = spark.createDataFrame([(p, 12.0) for p in periods], "p string, i double")
    assert values(rows, money.monthly_income(c("p"), c("i"))) == [2080.0, 260.0, 52.0, 26.0, 24.0, 12.0, 1.0, 0.0, 0.0]
    half = spark.createDataFrame([("Monthly", 2.5), ("Monthly", 3.5)], "p string, i double")
    assert values(half, money.monthly_income(c("p"), c("i"), rounded=True)) == [2.0, 4.0]


def test_rejection_reason(spark):
    rows = spark.createDataFrame(
        [("Accepted", "Rejected", "n", "r"), ("accepted", "Rejected", None, "r"), ("Accepted", "Approved", "n", "r"), ("Rejected", "x", "n", "r"),
         ("Accepted", None, "n", "r"), (None, "x", "n", "r")],
        "s string, t string, n string, r string",
    )
    assert values(rows, labels.rejection_reason(c("s"), c("t"), c("n"), c("r"))) == ["Manual: n", None, "", "r", "UNKNOWN CASE", "UNKNOWN CASE"]


def test_default_flags_without_ledger_rows(spark):
    schema = "due date, acc date, paid date, pid int, total int, n int, renewals int, lent int, prin int, returned string, code string"
    old, new = dt.date(2021, 6, 1), dt.date(2021, 6, 25)
    rows = spark.createDataFrame(
        [
            (old, old, None, None, None, None, None, None, None, None, None),
            (new, new, None, None, 0, 0, 0, 0, 0, "Y", None),
            (old, old, dt.date(2021, 6, 8), 1, 50, 1, 0, 100, 50, "Y", "R02"),
            (old, old, dt.date(2021, 6, 9), 1, 0, 2, 0, 100, 50, "Y", "R01"),
        ],
        schema,
    )
    rollup = {"total_paid": c("total"), "payment_count": c("n"), "renewal_count": c("renewals"), "new_loan_amount": c("lent"), "principal_paid": c("prin")}
    flags = labels.default_flags(c("due"), c("acc"), c("paid"), c("pid"), rollup, c("returned"), c("code"), F.lit(P.as_of))
    found = [tuple(row) for row in rows.select(*[flags[k] for k in ("cycled", "defaulted", "failed_first_payment", "first_payment_default", "one_payment_default")]).collect()]
    assert found == [(1, 0, 0, 1, 0), (0, 0, 0, 0, 0), (1, 0, 1, 0, 1), (1, 1, 0, 1, 0)]


def test_states():
    assert len(STATE_NAMES) == 57 and STATE_NAMES["VI"] == "U.S. Virgin Islands"


def test_percent_of_numbers_and_text(spark):
    from lendloom.functions.text import label_text, percent_to_fraction

    df = spark.createDataFrame([("93%", 0.93, 7), ("x", None, None), ("%5", 1.5, 0)], "t string, d double, i int")
    got = df.select(*[percent_to_fraction(F.col(c)).alias(c) for c in df.columns]).collect()
    assert [tuple(r) for r in got] == [(0.93, 0.93, 7.0), (None, None, None), (0.05, 1.5, 0.0)]
    assert [tuple(r) for r in df.select(*[label_text(F.col(c)) for c in df.columns]).limit(1).collect()] == [("93%", "0.93", "7.0")]
