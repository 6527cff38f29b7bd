"""Employment history held as a literal list: repair, parse, roll up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.functions.money import monthly_income
from lendloom.functions.text import read_quoted, to_number

EMPLOYER = (
    "array<struct<EmploymentStatus:string,CurrDateAsOf:string,PaymentFrequency:string,"
    "PeriodPaymentInfo:string,PeriodIncome:string>>"
)
TRAILING_ELEMENTS = 2


def close_truncated(text: Column) -> Column:
    """Close a list that was cut off: drop the last, partial element and one character before it.

    A comma left at the end is dropped too. Text without any element gives NULL.
    """
    from_end = F.instr(F.reverse(text), "{")
    kept = F.regexp_replace(F.substring(text, F.lit(1), F.length(text) - from_end - 1), r",\s*$", "")
    repaired = F.when(from_end > 0, F.concat(kept, F.lit("]")))
    return F.when(F.endswith(text, F.lit("]")), text).otherwise(repaired)


def list_elements(text: Column) -> Column:
    """Array of all elements of a literal list."""
    return F.from_json(read_quoted(close_truncated(text)), EMPLOYER, {"allowSingleQuotes": "true"})


def employers(elements: Column) -> Column:
    """All elements but the last two, which describe something else.

    After a repair this drops two real employers as well, as the source system does.
    """
    return F.slice(elements, F.lit(1), F.greatest(F.size(elements) - TRAILING_ELEMENTS, F.lit(0)))


def employment_rollup(df: DataFrame, column: str) -> DataFrame:
    """Add employer counts and the pay facts of the latest active job.

    "Latest" follows the text order of the date; among equal dates the first element
    counts. Without an active job, or without the key, the facts are N/A, N/A and 0.
    """
    parsed = df.where(F.startswith(column, F.lit("["))).withColumn("_list", list_elements(F.col(column)))
    parsed = parsed.withColumn("_jobs", employers(F.col("_list"))).drop("_list")
    parsed = parsed.withColumn("_active", F.filter("_jobs", lambda job: job["EmploymentStatus"] == "Active"))
    newest = F.array_max(F.transform("_active", lambda job: job["CurrDateAsOf"]))
    parsed = parsed.withColumn("_newest", newest)
    latest = F.get(F.filter("_active", lambda job: job["CurrDateAsOf"] == F.col("_newest")), F.lit(0))
    parsed = parsed.withColumn("_job", latest)
    return parsed.withColumns(
        {
            "employer_count": F.size("_jobs"),
            "active_count": F.size("_active"),
            "pay_frequency": F.coalesce("_job.PaymentFrequency", F.lit("N/A")),
            "period_payment_info": F.coalesce("_job.PeriodPaymentInfo", F.lit("N/A")),
            "period_income": F.coalesce("_job.PeriodIncome", F.lit("0")),
        }
    ).drop("_jobs", "_active", "_newest", "_job")


def add_monthly_income(df: DataFrame, rounded: bool = True) -> DataFrame:
    return df.withColumn("monthly_income", monthly_income(F.col("period_payment_info"), to_number(F.col("period_income")), rounded))
