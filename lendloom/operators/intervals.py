"""Employment inquiries near an application, and the latest bank verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.functions.dates import epoch_second
from lendloom.functions.money import employment_price
from lendloom.functions.text import contains_text, same_text
from lendloom.operators.lookups import lookups, pick
from lendloom.operators.skew import enrich
from lendloom.params import LeadParams


def _billable(requests: DataFrame, source: Column, p: LeadParams) -> DataFrame:
    """Requests that named an employer; a NULL response does not count."""
    named = ~contains_text(F.col("response"), p.markers.no_employer)
    return requests.where(F.col("social").isNotNull() & named & source).withColumn("social", F.lower("social")).withColumn("price", employment_price(F.col("request_ts"), p))


def other_inquiries(requests: DataFrame, p: LeadParams) -> DataFrame:
    """Inquiries that did not come from a lead: count and cost per person."""
    billable = _billable(requests, ~same_text(F.col("source"), "Leads"), p)
    return billable.groupBy("social").agg(F.count("*").alias("inquiries"), F.sum("price").alias("inquiry_cost"))


def lead_inquiries(
    applications: DataFrame, requests: DataFrame, p: LeadParams, shift_hours: int = 3, within: int = 300
) -> DataFrame:
    """Lead inquiries within ``within`` seconds of the shifted application time, per (social, application second).

    Requests are reduced to one row per person and second, applications to distinct
    person and second. Both fall into time slots as wide as the interval and meet in the
    own and the two neighbouring slots, so one application second meets at most
    ``3 * within`` rows, however many requests a person has.
    """
    slot = lambda second: F.floor(second / within)
    billable = _billable(requests, same_text(F.col("source"), "Leads"), p)
    asked = (
        billable.groupBy("social", epoch_second(F.col("request_ts")).alias("asked_at"))
        .agg(F.count("*").alias("n"), F.sum("price").alias("cost"))
        .withColumn("slot", slot(F.col("asked_at")))
    )
    applied = (
        applications.where(F.col("social").isNotNull() & F.col("app_ts").isNotNull())
        .select(F.lower("social").alias("social"), epoch_second(F.col("app_ts")).alias("app_second"))
        .distinct()
        .withColumn("at", F.col("app_second") + shift_hours * 3600)
        .withColumn("slot", F.explode(F.array(*[slot(F.col("at")) + step for step in (-1, 0, 1)])))
    )
    near = applied.join(asked, ["social", "slot"]).where(F.abs(F.col("at") - F.col("asked_at")) <= within)
    return near.groupBy("social", "app_second").agg(F.sum("n").alias("inquiries"), F.sum("cost").alias("inquiry_cost"))


def add_inquiries(applications: DataFrame, requests: DataFrame, p: LeadParams, **skew) -> DataFrame:
    """Add lead_inquiries/lead_cost and other_inquiries/other_cost to each application; none gives 0."""
    near = lead_inquiries(applications, requests, p).select(
        "social", "app_second", F.col("inquiries").alias("lead_inquiries"), F.col("inquiry_cost").alias("lead_cost")
    )
    other = other_inquiries(requests, p).select(
        "social", F.col("inquiries").alias("other_inquiries"), F.col("inquiry_cost").alias("other_cost")
    )
    # a person is one whatever the case of the social; the column itself is kept as it came
    person = applications.withColumns({"_person": F.lower("social"), "app_second": epoch_second(F.col("app_ts"))})
    timed = person.join(near.withColumnRenamed("social", "_person"), ["_person", "app_second"], "left")
    joined = enrich(timed.drop("app_second"), other.withColumnRenamed("social", "_person"), "_person", "left", **skew).drop("_person")
    zero = F.lit(0).cast("decimal(20,2)")
    return joined.withColumns(
        {name: F.coalesce(name, F.lit(0)) for name in ("lead_inquiries", "other_inquiries")}
        | {name: F.coalesce(F.col(name).cast("decimal(20,2)"), zero) for name in ("lead_cost", "other_cost")}
    )


def latest_verification(leads: DataFrame, verifications: DataFrame, key: str, p: LeadParams, **skew) -> DataFrame:
    """Code of the latest verification made no earlier than the day before the lead.

    Later ones pass the date test as well, so the latest of all decides: if it is too
    old, every other one is. No range join is needed.
    """
    latest = lookups(
        verifications.where(F.col("location").isin(list(p.verify_locations))),
        key,
        {"row": pick({"code": F.col("code"), "inquiry_ts": F.col("inquiry_ts")}, F.struct("inquiry_ts", "code"), last=True)},
    ).select(key, F.col("row.code").alias("_code"), F.col("row.inquiry_ts").alias("_inquiry_ts"))
    fresh = F.datediff(F.col("lead_ts").cast("date"), F.col("_inquiry_ts").cast("date")) <= 1
    joined = enrich(leads, latest, key, "left", **skew)
    return joined.withColumn("verification_code", F.when(fresh, F.col("_code"))).drop("_code", "_inquiry_ts")
