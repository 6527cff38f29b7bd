"""Amounts, ratios and service costs. Money is DECIMAL throughout."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendloom.functions.text import contains_text, flag, money, one_of, same_text
from lendloom.params import PAY_PERIODS, LeadParams


def payment_ratio(loan_amount: Column, income: Column) -> Column:
    """Two payments of 30 % over the income, DECIMAL(10,4); NULL for a zero or unreadable income."""
    loan = money(loan_amount, 10, 2)
    return F.try_divide(loan * F.lit(Decimal("0.3")) * F.lit(2), money(income)).cast("decimal(10,4)")


def loan_amount(text: Column) -> Column:
    """Amount as DECIMAL(10,2), 0 when missing."""
    return F.coalesce(money(text, 10, 2), F.lit(Decimal("0.00")))


def sell_type(original: Column, selected: Column, amount_text: Column) -> Column:
    """Upsell outcome; a letter 'o' typed in the amount reads as a zero."""
    asked = F.coalesce(F.regexp_replace(amount_text, "[oO]", "0").try_cast("decimal(18,2)"), F.lit(Decimal(0)))
    return (
        F.when(original.isNull() | selected.isNull(), "NOT Offer")
        .when(original >= asked, "NOT UPSELL")
        .otherwise("UPSELL")
    )


def sum_or_zero(*parts: Column) -> Column:
    """Sum of the parts; one NULL part makes the whole sum 0."""
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.coalesce(total, F.lit(0))


def unit_cost(used: Column, price: Decimal | Column) -> Column:
    price = price if isinstance(price, Column) else F.lit(price)
    return F.when(used, price.cast("decimal(10,3)")).otherwise(F.lit(Decimal("0.000")))


def marker_cost(response: Column, marker: str, price: Decimal | Column) -> Column:
    return unit_cost(contains_text(response, marker), price)


def employment_price(request_ts: Column, p: LeadParams) -> Column:
    return F.when(request_ts.cast("date") < F.lit(p.prices.employment_change), F.lit(p.prices.employment_early)).otherwise(
        F.lit(p.prices.employment_late)
    ).cast("decimal(10,2)")


def new_lead_cost(
    traffic: Column, partner: Column, status: Column, app_type: Column, app_id: Column, price: Column, amount: Column, p: LeadParams
) -> Column:
    """Price of a new lead. The last branch compares the type with 'Accepted', which hardly occurs; kept as it is."""
    accepted, approved = same_text(status, "Accepted"), same_text(app_type, "Approved")
    known = app_id.isNotNull()
    flat, late = [n for n in (p.flat_partner,) if n], [n for n in (p.late_partner,) if n]
    listed = one_of(partner, [*p.share_partners, *flat])
    ordinary = ~same_text(traffic, "Organic") & partner.isNotNull() & ~listed & accepted
    zero = F.lit(Decimal("0.0000"))
    return (
        F.when(ordinary, price.cast("decimal(18,4)"))
        .when(one_of(partner, p.share_partners) & accepted & approved & known, (F.lit(p.share_rate) * amount).cast("decimal(18,4)"))
        .when(one_of(partner, flat) & accepted & approved & known, F.lit(p.flat_cost).cast("decimal(18,4)"))
        .when(one_of(partner, late) & same_text(app_type, "Accepted") & known, F.lit(p.late_cost).cast("decimal(18,4)"))
        .otherwise(zero)
    )


def renewal_lead_cost(traffic: Column, status: Column, app_id: Column, price: Column) -> Column:
    renewal = ~same_text(traffic, "Organic") & same_text(status, "Accepted") & app_id.isNull()
    return F.when(renewal, price.cast("decimal(18,4)")).otherwise(F.lit(Decimal("0.0000")))


def existing_customer(status: Column, app_id: Column) -> Column:
    return flag(app_id.isNull() & same_text(status, "Accepted"))


def monthly_income(period: Column, income: Column, rounded: bool = False) -> Column:
    """Income per month; 0 for an unknown period. ``rounded`` uses half-to-even."""
    chain = None
    for name, (times, divisor) in PAY_PERIODS.items():
        value = income * float(times) / float(divisor)
        chain = F.when(period == name, value) if chain is None else chain.when(period == name, value)
    chain = chain.otherwise(F.lit(0.0))
    return F.bround(chain, 0) if rounded else chain


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))
