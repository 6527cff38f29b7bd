"""What a person did before: running counts and the state at an earlier moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendloom.functions.text import money
from lendloom.operators.running import running
from lendloom.operators.skew import enrich


def application_history(applicants: DataFrame, **limits) -> DataFrame:
    """Per application: applications so far (own included), lowest salary so far, previous type.

    Works on the whole table, before any filter. Rows without a social match nobody:
    count 0, no salary, no previous type. Each such row is a group of its own here, so
    they do not pile up in one task.
    """
    known = F.col("social").isNotNull()
    keyed = applicants.withColumns(
        {
            "_person": F.coalesce(F.concat(F.lit("s"), F.lower("social")), F.concat(F.lit("i"), F.col("id").cast("string"))),
            "_salary": money(F.col("salary"), 22, 8),
        }
    )
    specs = {
        "times_applied": ("count", None),
        "min_salary": ("min", "_salary"),
        "previous_type": ("previous", "type"),
    }
    return (
        running(keyed, ["_person"], "id", specs, bound=applicants, **limits)
        .withColumns(
            {
                "times_applied": F.when(known, F.col("times_applied")).otherwise(F.lit(0)),
                "min_salary": F.when(known, F.col("min_salary")),
            }
        )
        .drop("_person", "_salary")
    )


def prior_applications(leads: DataFrame, applicants: DataFrame) -> DataFrame:
    """Per lead: applications of the same person on earlier days, and the type of the last of them.

    ``leads`` needs lead_id, social, lead_ts. Applications are first reduced to one row
    per person and day, lead days are merged in, and the running values read off.
    """
    day = F.datediff(F.col("dte").cast("date"), F.lit("1970-01-01").cast("date"))
    lead_day = F.datediff(F.col("lead_ts").cast("date"), F.lit("1970-01-01").cast("date"))
    applied = (
        applicants.where(F.col("social").isNotNull() & F.col("dte").isNotNull())
        .groupBy(F.lower("social").alias("social"), (day + 1).alias("day"))
        .agg(F.count("*").alias("n"), F.max(F.struct("id", "type")).alias("last"))
    )
    asked = leads.where(F.col("social").isNotNull()).select(F.lower("social").alias("social"), lead_day.alias("day")).distinct()
    asked = asked.select("social", "day", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast(applied.schema["last"].dataType).alias("last"))
    days = applied.unionByName(asked).groupBy("social", "day").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    # one row per person and calendar day: a person has some ten thousand at most, however many applications
    upto_day = W.partitionBy("social").orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    known = days.select("social", "day", F.sum("n").over(upto_day).alias("prior_count"), F.max("last").over(upto_day).alias("prior_last"))
    known = known.select("social", "day", "prior_count", F.col("prior_last.type").alias("prior_type"))
    return (
        leads.withColumns({"day": lead_day, "_person": F.lower("social")})
        .join(known.withColumnRenamed("social", "_person"), ["_person", "day"], "left")
        .withColumns({"prior_count": F.coalesce("prior_count", F.lit(0)), "prior_type": F.coalesce("prior_type", F.lit(""))})
        .drop("day", "_person")
    )


def own_prior_application(leads: DataFrame, applicants: DataFrame) -> DataFrame:
    """The source system's form: only the lead's own application is looked at.

    Its social is compared with itself, so the count is 0 or 1 and is then raised to 1,
    and the status is that of the own application when it is older than the lead.
    ``leads`` needs lead_id, failure_applicant_id, lead_ts. Most leads have no such application: they are dealt over
    all tasks, as a NULL key would send them to one.
    """
    own = applicants.where(F.col("social").isNotNull()).select(
        F.col("id").alias("failure_applicant_id"), F.col("type").alias("_type"), F.col("dte").cast("date").alias("_day")
    )
    older = F.coalesce(F.col("_day") < F.col("lead_ts").cast("date"), F.lit(False))
    return (
        enrich(leads, own, "failure_applicant_id", "left", hot=None)
        .withColumns(
            {
                "total_applicants": F.lit(1).cast("bigint"),
                "last_applicant_status": F.when(older, F.coalesce("_type", F.lit(""))).otherwise(""),
            }
        )
        .drop("_type", "_day")
    )
