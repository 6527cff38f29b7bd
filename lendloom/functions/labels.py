"""Labels of a lead: partner, store, approval path, rejection, default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendloom.functions.dates import cycled, days_crossed
from lendloom.functions.text import flag, lookup_literal, one_of, same_text
from lendloom.params import EXEMPT_RETURN_CODES, FIRST_STORE_LABELS, LeadParams


def partner_label(traffic: Column, name: Column) -> Column:
    return F.when(same_text(traffic, "Organic"), "Organic").otherwise(name)


def partner_group(traffic: Column, name: Column, p: LeadParams) -> Column:
    """Organic first, then the mapping of partner names, then the default group."""
    lowered = {key.lower(): group for key, group in p.partner_groups.items()}
    return F.when(same_text(traffic, "Organic"), "Organic").otherwise(
        F.coalesce(lookup_literal(F.lower(name), lowered), F.lit(p.default_group))
    )


def channel(sub_id: Column, account_sub_id: Column, p: LeadParams) -> Column:
    own = one_of(sub_id, p.organic_ids) | one_of(account_sub_id, p.organic_account_ids)
    return F.when(own, "Organic").otherwise("Leads")


def store_label(first_store: Column, model: Column, model_store: Column, bureau_store: Column, p: LeadParams) -> Column:
    """Store from three lookups, first matching rule wins. Ids are compared as numbers."""
    first, tracked, bureau = (c.try_cast("int") for c in (first_store, model_store, bureau_store))
    no_first, untracked = first.isNull(), tracked.isNull()
    chain = (
        F.when(same_text(model, p.forest_model), "Store 12-RF")
        .when(no_first & (tracked == 8), "Store 08")
        .when(no_first & (tracked == 13), "Store 13")
        .when(no_first & untracked & (bureau == 14), "Store 14")
        .when(no_first & untracked & (bureau == 30), "Store 30")
        .when(no_first & (tracked == 30), "Store 30")
    )
    for store, label in FIRST_STORE_LABELS.items():
        chain = chain.when(first == store, label)
    return chain.when(no_first & (tracked == 14), "Store 14").otherwise("Other")


def approval_path(automatic: Column, auto_approved: Column, app_type: Column) -> Column:
    approved = same_text(app_type, "Approved")
    return (
        F.when((automatic == 0) & approved, "Manual-Approved")
        .when((automatic == 1) & (auto_approved == 0) & approved, "Semi-Auto-Approved")
        .when((automatic == 1) & (auto_approved == 1) & approved, "Auto-Approved")
        .otherwise(app_type)
    )


def rejection_reason(status: Column, app_type: Column, note: Column, auto_reason: Column) -> Column:
    """A manual rejection without a note stays NULL."""
    accepted = same_text(status, "Accepted")
    return (
        F.when(accepted & same_text(app_type, "Rejected"), F.concat(F.lit("Manual: "), note))
        .when(accepted & ~same_text(app_type, "Rejected"), "")
        .when(same_text(status, "Rejected"), auto_reason)
        .otherwise("UNKNOWN CASE")
    )


def default_flags(
    date_due: Column,
    account_due: Column,
    first_payment_date: Column,
    first_payment_id: Column,
    rollup: dict[str, Column],
    returned: Column,
    return_code: Column,
    as_of: Column,
) -> dict[str, Column]:
    """Payment-default labels of one application.

    ``rollup`` holds total_paid, payment_count, renewal_count, new_loan_amount and
    principal_paid. They are NULL without ledger rows, and then no amount rule holds.
    """
    overdue = cycled(date_due, as_of) == 1
    late = days_crossed(date_due, first_payment_date) > 7
    no_payment = first_payment_id.isNull()
    open_principal = rollup["new_loan_amount"] - rollup["principal_paid"] > 0
    one_payment = (rollup["payment_count"] == 1) & (rollup["renewal_count"] == 0)
    return {
        "cycled": cycled(date_due, as_of),
        "defaulted": flag((rollup["total_paid"] == 0) & overdue),
        "failed_first_payment": flag((returned == "Y") & ~return_code.isin(list(EXEMPT_RETURN_CODES))),
        "first_payment_default": flag((no_payment & overdue) | (~no_payment & late)),
        "one_payment_default": flag(one_payment & open_principal & (days_crossed(account_due, as_of) > 7)),
    }
