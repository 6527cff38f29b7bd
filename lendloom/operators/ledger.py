"""Ledger roll-up, first payment that stood, first debit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.functions.text import contains_text, same_text
from lendloom.operators.lookups import first_by, lookups, pick
from lendloom.operators.skew import sized

ROLLUP_COLUMNS = (
    "payment_count", "renewal_count", "write_off_count", "written_off", "total_lent",
    "new_loan_amount", "principal_paid", "interest_paid", "total_paid",
)


def ledger_rollup(ledger: DataFrame, key: str = "ss") -> DataFrame:
    """Nine conditional sums per key, one pass."""
    entry = F.col("_entry")
    payment = F.contains(entry, F.lit("pay"))
    settled = payment | (entry == "return")
    renewal, write_off, new_loan = (entry == t for t in ("renewal", "active -> written off", "new loan"))
    lent = new_loan | renewal | (entry == "loan increase")

    def amount(condition: Column, column: str, scale: int = 2) -> Column:
        decimal = f"decimal(18,{scale})"
        return F.sum(F.when(condition, F.col(column).cast(decimal)).otherwise(F.lit(0).cast(decimal)))

    return (
        ledger.where(F.col(key).isNotNull())
        .withColumn("_entry", F.rtrim(F.lower("type")))  # compared many times, computed once
        .groupBy(key)
        .agg(
            F.sum(F.when(payment, 1).otherwise(0)).alias("payment_count"),
            F.sum(F.when(renewal, 1).otherwise(0)).alias("renewal_count"),
            F.sum(F.when(write_off, 1).otherwise(0)).alias("write_off_count"),
            amount(write_off, "net", 4).alias("written_off"),
            amount(lent, "net").alias("total_lent"),
            amount(new_loan, "net").alias("new_loan_amount"),
            amount(settled, "paidprin").alias("principal_paid"),
            amount(settled, "paidint").alias("interest_paid"),
            amount(settled, "payment").alias("total_paid"),
        )
    )


def unreverted(ledger: DataFrame, **limits) -> DataFrame:
    """Entries that no other entry refers back to.

    An anti join would be pushed below the dealing of the rows, and a task would sort what the shuffle partitions leave it. Both sides
    are dealt alike, or the join would take the number of the other one.
    """
    rows = ledger.count()
    reverts = sized(ledger.where(F.col("reference_id").isNotNull()).select(F.col("reference_id").alias("id")), "id", rows, **limits).distinct()
    marked = sized(ledger, "id", rows, **limits).join(reverts.withColumn("_reverted", F.lit(True)), "id", "left")
    return marked.where(F.col("_reverted").isNull()).select(*ledger.columns)


def first_payment(ledger: DataFrame, key: str = "ss", only: DataFrame | None = None) -> DataFrame:
    """First payment per key that is not itself a revert and was not reverted; ``only`` holds the keys to keep."""
    entry = F.col("type")
    wanted = contains_text(entry, "payment") & ~contains_text(entry, "Reverted Pay") & F.col(key).isNotNull()
    reverts = ledger.where(F.col("reference_id").isNotNull()).select(F.col("reference_id").alias("id")).distinct()
    payments = ledger.where(wanted).select(key, "id", "dte", "payment")
    if only is not None:
        payments = payments.join(only, key, "left_semi")
    payments = payments.join(reverts, "id", "left_anti")
    return first_by(payments, key, "id", ["id", "dte", "payment"])


def first_debit(ach_status: DataFrame, key: str = "account_id") -> DataFrame:
    """First debit per account: returned or not, and the return code."""
    row = pick(
        {"returned": F.when(same_text(F.col("status"), "Return"), "Y").otherwise("N"), "return_code": F.col("return_code")},
        F.col("id"),
        where=same_text(F.col("type"), "D"),
    )
    return lookups(ach_status, key, {"row": row}).where("row IS NOT NULL").select(key, "row.*")


def last_entry_type(ledger: DataFrame, key: str = "ss") -> DataFrame:
    return lookups(ledger, key, {"last_entry_type": F.max_by("type", "id")})
