"""The wide lead table: one row per lead and vendor response, from the operational tables.

Order of work. The running history of a person needs the full application table, so it
comes first. Then applications are filtered, also to those with an employment response,
since others give no row. Everything known per application is collected in one frame
with one row per application; likewise per account. Leads join those two frames once
each, through ``enrich``, which spreads hot keys. Documents are parsed once per lead or
application, before rows multiply. Tables that multiply rows are reduced to distinct
values first, which stands for the DISTINCT over the whole row that the source system
runs at the end.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.functions import dates, labels, money, text
from lendloom.functions.text import flag, same_text
from lendloom.operators.history import application_history
from lendloom.operators.intervals import add_inquiries
from lendloom.operators.ledger import first_debit, first_payment, last_entry_type, ledger_rollup
from lendloom.operators.lookups import first_by, last_before_first, last_by, lookups, pick
from lendloom.operators.membership import above_or_listed, between_dates
from lendloom.operators.skew import broadcast_if_small, enrich, hot_keys
from lendloom.operators.xmltab import LEAD_KEYS, named_values, parse_xml
from lendloom.params import LeadParams
from lendloom.session import checkpointed

Tables = Mapping[str, DataFrame]

_CARRIER = "results struct<result:struct<carrier_name:string>>"
_BUREAU = "ApplicationInfo struct<LoanPerformance:struct<NumberofLoansPaidOff:string>>"
_BUREAU_CREDIT = "LoanPerformance struct<NumberofLoansPaidOff:string>"


# --- per application --------------------------------------------------------------


def carrier_lookups(t: Tables) -> dict[str, DataFrame]:
    """Distinct home status, cell status and carrier name per application."""
    log = t["carrier_log"].where(F.col("applicant_id").isNotNull())

    def status(phone: str, name: str) -> DataFrame:
        rows = log.where(same_text(F.col("phone_type"), phone))
        return rows.select("applicant_id", F.col("status").alias(name)).distinct()

    carrier = parse_xml(F.col("response"), _CARRIER)["results"]["result"]["carrier_name"]
    return {
        "home": status("Homephone", "carrier_home_status"),
        "cell": status("Cellphone", "carrier_cell_status"),
        "name": log.select("applicant_id", F.substring(carrier, 1, 20).alias("carrier_name")).distinct(),
    }


def bureau_lookups(t: Tables, p: LeadParams) -> DataFrame:
    """Three lookups on one table: any store but military, military, credit.

    Only ids are aggregated; the documents of the chosen rows are read back by (applicant, id)
    and parsed there, once each.
    """
    store = F.col("store_id")
    first = lambda where: F.min(F.when(where, F.col("id")))
    log = t["bureau_response"].where(F.col("applicant_id").isNotNull())
    ids = log.groupBy("applicant_id").agg(
        first(store != p.military_store).alias("bureau_response_id"), first(store == p.military_store).alias("_military"), first(store == p.credit_store).alias("_credit")
    )
    chosen = ids.select("applicant_id", F.explode(F.array("bureau_response_id", "_credit")).alias("id")).where("id IS NOT NULL").distinct()
    rows = log.select("applicant_id", "id", "store_id", "risk_score", "response").join(chosen, ["applicant_id", "id"], "left_semi")
    paid_off = lambda schema, *path: F.substring(reduce(lambda c, name: c[name], path, parse_xml(F.col("response"), schema)), 1, 10)
    bureau = rows.select(
        "applicant_id", F.col("id").alias("bureau_response_id"), F.col("store_id").alias("bureau_store_id"), "risk_score", F.col("response").alias("bureau_response"),
        paid_off(_BUREAU, "ApplicationInfo", "LoanPerformance", "NumberofLoansPaidOff").alias("paid_off_loans"),
    )
    credit = rows.select(
        "applicant_id", F.col("id").alias("_credit"), F.col("risk_score").alias("credit_risk_score"),
        paid_off(_BUREAU_CREDIT, "LoanPerformance", "NumberofLoansPaidOff").alias("paid_off_loans_credit"), F.col("response").alias("credit_response"),
    )
    found = ids.join(bureau, ["applicant_id", "bureau_response_id"], "left").join(credit, ["applicant_id", "_credit"], "left")
    return found.withColumn("military_store_id", F.when(F.col("_military").isNotNull(), F.lit(p.military_store))).drop("_military", "_credit")


def model_lookups(t: Tables, p: LeadParams) -> DataFrame:
    """First tracked model, first decision of one model, last decision of another."""
    model = F.col("model")
    row = {name: F.col(name) for name in ("model", "store_id")}
    decision = {"decision": F.col("decision")}
    found = lookups(
        t["model_tracking"],
        "applicant_id",
        {
            "any": pick(row, F.col("id")),
            "first": pick(decision, F.col("id"), where=same_text(model, p.first_model)),
            "last": pick(decision, F.col("id"), last=True, where=same_text(model, p.last_model)),
        },
    )
    return found.select(
        "applicant_id",
        F.col("any.model").alias("tracked_model"),
        F.col("any.store_id").alias("tracked_store_id"),
        F.col("first.decision").alias("first_model_decision"),
        F.col("last.decision").alias("last_model_decision"),
    )


def note_lookups(t: Tables, p: LeadParams, **skew) -> DataFrame:
    """First human note, the last bot note before it, and the time between them."""
    by_bot = same_text(F.col("submitted_by"), p.bot_user)
    found = last_before_first(t["app_notes"], "cust_id", "id", ~by_bot, by_bot, ["note_ts"], **skew)
    human, bot = F.col("first.note_ts"), F.col("before.note_ts")
    return found.select(
        F.col("cust_id").alias("applicant_id"),
        human.alias("human_note_ts"),
        bot.alias("bot_note_ts"),
        dates.minutes_crossed(bot, human).alias("response_minutes"),
        dates.seconds_crossed(bot, human).alias("response_seconds"),
    )


def cnr_notes(t: Tables) -> DataFrame:
    """Date of a call-not-reached note; the smallest id stands for any."""
    found = lookups(t["app_notes"], "cust_id", {"row": pick({"ts": F.col("note_ts")}, F.col("id"), where=same_text(F.col("note"), "CNR"))})
    return found.select(F.col("cust_id").alias("applicant_id"), F.col("row.ts").alias("cnr_ts")).where("cnr_ts IS NOT NULL")


def mapping_facts(t: Tables, p: LeadParams) -> DataFrame:
    """Per application: mapping, upsell amounts, latest bank verification."""
    located = t["bank_verify_log"].where(F.col("location").isin(list(p.verify_locations)))
    # latest per bank account first, so that a busy account meets its mappings as one row
    per_account = last_by(located, "bank_account_id", ["inquiry_ts", "code"], ["code", "inquiry_ts"])
    checks = t["bank_account"].join(per_account, "bank_account_id")
    latest = last_by(checks, "mapping_id", ["inquiry_ts", "code"], ["code", "inquiry_ts"]).select(
        "mapping_id", F.col("code").alias("verify_code"), F.col("inquiry_ts").alias("verify_ts")
    )
    return (
        t["applicant_mapping"]
        .where(F.col("applicant_id").isNotNull())
        .select("applicant_id", "mapping_id")
        .distinct()
        .join(t["upsell_log"].select("mapping_id", "original", "selected", "max_amount").distinct(), "mapping_id", "left")
        .join(latest, "mapping_id", "left")
    )


def answered_applications(t: Tables, hot: DataFrame | None = None) -> DataFrame:
    """(applicant_id, employment_response): distinct answers to requests made for leads."""
    asked = t["employment_request"].where(same_text(F.col("source"), "Leads")).select("mapping_id", "response")
    owners = t["applicant_mapping"].select("mapping_id", "applicant_id").distinct()
    mapped = enrich(asked, owners, "mapping_id", "inner", hot=hot).select("applicant_id", F.col("response").alias("employment_response"))
    # Equal texts have equal digests: the aggregate's keys are short, and the text is any of theirs.
    return mapped.groupBy("applicant_id", F.md5("employment_response").alias("_digest")).agg(F.any_value("employment_response").alias("employment_response")).drop("_digest")


_PER_APPLICATION = {
    "bureau_response": "applicant_id", "identity_log": "applicant_id", "model_tracking": "applicant_id", "app_notes": "cust_id",
    "open_transact_log": "applicant_id", "store_two": "applicant_id",
}


def _of_applications(t: Tables, wanted: DataFrame) -> Tables:
    """The vendor logs with the rows of the wanted applications only, before anything is aggregated."""
    ids = broadcast_if_small(checkpointed(wanted.select("id").distinct()))
    own = {name: t[name].join(ids.select(F.col("id").alias(key)), key, "left_semi") for name, key in _PER_APPLICATION.items()}
    return {**t, **own}


def application_facts(t: Tables, p: LeadParams, only: DataFrame | None = None) -> DataFrame:
    """Filtered applications with everything that is known per application; ``only`` holds the ids to keep."""
    history = application_history(t["applicant"])
    recent = between_dates(history, "dte", F.lit(p.start), F.lit(p.as_of))
    wanted = above_or_listed(recent, "id", p.id_threshold, t["reserved_applicants"], "applicant_id")
    if only is not None:
        wanted = wanted.join(only.select(F.col("applicant_id").alias("id")), "id", "left_semi")
    t = _of_applications(t, wanted)
    priced = add_inquiries(wanted, t["employment_request"], p, hot=hot_keys(t["applicant"].select(F.lower("social").alias("_person")), "_person"))
    facts = priced.withColumnRenamed("id", "applicant_id")
    reasons = t["auto_failure_x_applicant"].join(broadcast_if_small(t["auto_failure_reason"]), "reason_id", "left")
    notes = t["manual_reject_x"].join(broadcast_if_small(t["reject_note"]), "note_id", "left")
    open_transactions = first_by(t["open_transact_log"], "applicant_id", "id", ["id"]).withColumnRenamed("id", "open_transaction_id")
    first_stores = first_by(t["store_two"], "applicant_id", "id", ["store_id", "score", "paid_off"]).select(
        "applicant_id", F.col("store_id").alias("first_store_id"), F.col("score").alias("first_store_score"), "paid_off"
    )
    identity = last_by(t["identity_log"], "applicant_id", ["response_ts", "status", "fraud_score"], ["status", "fraud_score"])
    per_application = [
        mapping_facts(t, p),
        reasons.select("applicant_id", F.col("reason").alias("failure_reason"), F.lit(True).alias("has_failure")).distinct(),
        notes.select("applicant_id", F.col("note").alias("reject_note")).distinct(),
        identity.withColumnRenamed("status", "identity_status"),
        open_transactions,
        bureau_lookups(t, p),
        first_stores,
        model_lookups(t, p),
        note_lookups(t, p),
        cnr_notes(t),
    ]
    for part in per_application:
        facts = facts.join(part, "applicant_id", "left")
    facts = facts.drop("credit_response")
    states = t["states"].select(F.lower("name").alias("_state"), F.col("name").alias("state_name"), F.col("abbr").alias("state_abbr"))
    return facts.join(broadcast_if_small(states), F.lower("state") == F.col("_state"), "left").drop("_state")


# --- per account ------------------------------------------------------------------


def card_counts(t: Tables) -> DataFrame:
    """Cards per account, counted through the mapping."""
    cards = t["credit_card"].groupBy("mapping_id").agg(F.count("*").alias("n"))
    owned = t["applicant_mapping"].select("mapping_id", "account_id").join(cards, "mapping_id")
    return owned.groupBy("account_id").agg(F.sum("n").alias("card_count"))


def account_facts(t: Tables, only: DataFrame | None = None) -> DataFrame:
    """Accounts with ledger sums, first payment, first debit and card count; ``only`` holds the ids to keep.

    Ledger, debits and cards are cut to these accounts before anything is aggregated. A revert may stand under another person, so
    all of them count.
    """
    accounts = t["account"].select(
        F.col("id").alias("account_id"),
        F.lower("social").alias("account_social"),
        F.col("type").alias("account_type"),
        F.col("aff_id").alias("account_aff_id"),
        F.col("date_due").alias("account_due"),
    )
    whole, debits, mapping, people = t["ledger"].withColumn("ss", F.lower("ss")), t["ach_status"], t["applicant_mapping"], None  # one person whatever the case
    ledger = whole
    if only is not None:
        accounts = checkpointed(accounts.join(only, "account_id", "left_semi"))
        people = broadcast_if_small(accounts.select(F.col("account_social").alias("ss")).where("ss IS NOT NULL").distinct())
        ids = broadcast_if_small(accounts.select("account_id").distinct())
        ledger = whole.join(people, "ss", "left_semi")
        debits, mapping = debits.join(ids, "account_id", "left_semi"), mapping.join(ids, "account_id", "left_semi")
    paid = first_payment(whole, only=people).select("ss", F.col("id").alias("first_payment_id"), F.col("dte").alias("first_payment_date"))
    sums = ledger_rollup(ledger).join(paid, "ss", "left").join(last_entry_type(ledger), "ss", "left")
    by_social = sums.withColumnRenamed("ss", "account_social")
    return (
        accounts.join(by_social, "account_social", "left")
        .join(first_debit(debits), "account_id", "left")
        .join(card_counts({**t, "applicant_mapping": mapping}), "account_id", "left")
        .withColumn("card_count", F.coalesce("card_count", F.lit(0)))
    )


def renewal_facts(t: Tables) -> DataFrame:
    """Per lead: account and loan amount of its renewal."""
    renewals = t["renewal_lead"].join(t["renewal_log"], "log_id", "left")
    return renewals.select("lead_id", F.col("cust_id").alias("account_id"), F.col("loan_amount").alias("renewal_amount")).distinct()


# --- leads ------------------------------------------------------------------------


def lead_facts(t: Tables, p: LeadParams, answered: DataFrame, hot_leads: DataFrame | None, xml_root: str = "loan_request") -> DataFrame:
    """Leads of answered applications with all looked-up facts but carrier values and employment responses, which multiply rows."""
    log = enrich(t["lead_log"].withColumnRenamed("status", "lead_status"), answered.select("applicant_id"), "applicant_id", "left_semi", hot=hot_leads)
    rejects = t["lead_reject_x"].join(broadcast_if_small(t["lead_reject_reason"]), "reason_id", "left")
    rejects = rejects.select("lead_id", F.col("reason").alias("auto_reject_reason")).distinct()
    partners = t["partner"].select(
        F.lower("username").alias("_partner"), F.col("name").alias("partner_name"), "traffic_source", "lead_price"
    )
    leads = log.join(renewal_facts(t), "lead_id", "left")
    leads = leads.join(t["contract_tracker"].select("lead_id", "link_open_ts").distinct(), "lead_id", "left")
    leads = leads.join(rejects, "lead_id", "left")
    leads = leads.withColumn("_partner", F.lower("username"))
    leads = leads.join(broadcast_if_small(partners), "_partner", "left").drop("_partner")
    asked = t["lead_log"].select("lead_id", "applicant_id").join(answered.select("applicant_id"), "applicant_id", "left_semi").select("lead_id")
    accounts = renewal_facts(t).join(asked, "lead_id", "left_semi").select("account_id")
    leads = enrich(leads, account_facts(t, accounts), "account_id", hot=hot_keys(t["renewal_log"], "cust_id"))
    leads = named_values(leads, "xml_in", LEAD_KEYS, xml_root, "_bal").drop("xml_in")
    facts = application_facts(t, p, answered)
    return enrich(leads, facts, "applicant_id", "inner", hot=hot_leads)


def carrier_values(t: Tables, answered: DataFrame, p: LeadParams) -> DataFrame:
    """Per answered application: every combination of its carrier values, with what they cost. All logged calls have a name."""
    log = t["carrier_log"].join(broadcast_if_small(answered.select("applicant_id").distinct()), "applicant_id", "left_semi")
    part = carrier_lookups({**t, "carrier_log": log})
    found = part["name"].join(part["home"], "applicant_id", "left").join(part["cell"], "applicant_id", "left")
    cost = lambda name: money.unit_cost(F.col(name).isNotNull(), p.prices.carrier)
    return found.select("applicant_id", "carrier_name", cost("carrier_home_status").alias("carrier_home_cost"), cost("carrier_cell_status").alias("carrier_cell_cost"))


def derived_columns(t: Tables, p: LeadParams) -> dict[str, Column]:
    """Flags, labels, costs and default rules over the columns of ``lead_facts``."""
    c, price, marker = F.col, p.prices, p.markers
    prices = t["cost_per_service"]  # a one-row table, read as scalars; a second row is an error
    unit = lambda name: prices.select(name).scalar()
    dob = dates.dob_from_parts(c("date_dob_m_bal"), c("date_dob_d_bal"), c("date_dob_y_bal"))
    amount = money.loan_amount(c("loan_amount"))
    rollup = {k: c(k) for k in ("total_paid", "payment_count", "renewal_count", "new_loan_amount", "principal_paid")}
    fresh = dates.days_crossed(c("verify_ts"), c("lead_ts")) <= 1
    older = c("has_failure") & c("social").isNotNull() & (c("dte") < c("lead_ts").cast("date"))
    columns = dates.calendar_parts(c("lead_ts")) | {
        "if_accepted": flag(same_text(c("lead_status"), "Accepted")),
        "if_funded": flag(same_text(c("type"), "Approved")),
        "affiliate": labels.partner_label(c("traffic_source"), c("partner_name")),
        "affiliate_group": labels.partner_group(c("traffic_source"), c("partner_name"), p),
        "channel": labels.channel(c("aff_id"), c("account_aff_id"), p),
        "sub_id": text.sub_id_root(c("partner_name"), c("aff_id"), p.sub_id_partner),
        "is_cnr": flag(c("stage_id") == "18"),
        "months_on_job": text.months_on_job(c("job_length")),
        "dob_bal": dob,
        "age": dates.age_years(dates.parse_text_date(dob), c("lead_ts")),
        "email_domain": text.email_domain(c("email_primary_bal")),
        "payment_ratio": money.payment_ratio(c("loan_amount_desired_bal"), c("income_monthly_bal")),
        "store_label": labels.store_label(c("first_store_id"), c("tracked_model"), c("tracked_store_id"), c("bureau_store_id"), p),
        "card_provided": F.when(c("card_count") > 0, "Y").otherwise("N"),
        "military": flag(c("military_store_id").isNotNull()),
        "loan_performance": flag(text.contains_text(c("bureau_response"), marker.loan_performance.strip("<>"))),
        "id_logic": flag(text.contains_text(c("bureau_response"), marker.address)),
        "account_check": flag(text.contains_text(c("bureau_response"), marker.account.strip("<>"))),
        "amount": amount,
        "sell_type": money.sell_type(c("original"), c("selected"), c("loan_amount")),
        "approval_path": labels.approval_path(c("auto_ok"), c("auto_approved"), c("type")),
        "rejection_reason": labels.rejection_reason(c("lead_status"), c("type"), c("reject_note"), c("auto_reject_reason")),
        "total_applicants": F.lit(1),
        "last_applicant_status": F.when(older, F.coalesce(c("type"), F.lit(""))).otherwise(""),
        "verification_code": F.when(fresh, c("verify_code")),
        "verification_cost": money.unit_cost(fresh & c("verify_code").isNotNull(), price.bank_verification),
        "identity_cost": money.unit_cost(c("identity_status").isNotNull(), price.identity),
        "open_transaction_cost": money.unit_cost(c("open_transaction_id").isNotNull(), price.open_transaction),
        "loan_performance_cost": money.marker_cost(c("bureau_response"), marker.loan_performance, unit("risk")),
        "id_logic_cost": money.marker_cost(c("bureau_response"), marker.identity, unit("idv")),
        "account_check_cost": money.marker_cost(c("bureau_response"), marker.account, unit("chex")),
        "credit_attributes_cost": money.marker_cost(c("bureau_response"), marker.credit_attributes, price.credit_attributes),
        "military_cost": money.unit_cost(c("military_store_id").isNotNull(), price.military),
        "employment_cost": money.sum_or_zero(c("lead_cost"), c("other_cost")),
        "employment_inquiries": money.sum_or_zero(c("lead_inquiries"), c("other_inquiries")),
        "lead_price": F.coalesce(c("lead_price"), F.lit(0).cast("decimal(10,2)")),
        "new_lead_cost": money.new_lead_cost(
            c("traffic_source"), c("partner_name"), c("lead_status"), c("type"), c("applicant_id"), c("lead_price"), amount, p
        ),
        "renewal_lead_cost": money.renewal_lead_cost(c("traffic_source"), c("lead_status"), c("applicant_id"), c("lead_price")),
        "existing_customer": money.existing_customer(c("lead_status"), c("applicant_id")),
    }
    return columns | labels.default_flags(
        c("date_due"), c("account_due"), c("first_payment_date"), c("first_payment_id"), rollup, c("returned"), c("return_code"), F.lit(p.as_of)
    )


COST_PARTS = ("loan_performance_cost", "id_logic_cost", "account_check_cost", "credit_attributes_cost", "military_cost")


def add_derived(facts: DataFrame, t: Tables, p: LeadParams) -> DataFrame:
    derived = derived_columns(t, p)
    wide = facts.select(*[F.col(c) for c in facts.columns if c not in derived], *[column.alias(name) for name, column in derived.items()])
    bureau = sum((F.col(c) for c in COST_PARTS[1:]), F.col(COST_PARTS[0]))
    return wide.withColumn("bureau_cost", bureau).withColumn(
        "data_cost", F.col("identity_cost") + F.col("open_transaction_cost") + F.col("bureau_cost") + F.col("employment_cost")
    )


# Output name -> column, each once.
PROJECTION = {
    "lead_id": "lead_id", "applicant_id": "applicant_id", "received_month": "received_month", "received_date": "received_date",
    "bank": "bank_name_bal", "routing": "routing", "bank_months": "bank_length_months_bal",
    "residence_months": "residence_length_months_bal", "residence_type": "residence_type_bal",
    "months_on_job": "employer_length_months_bal", "salary": "income_monthly_bal", "dob": "dob_bal", "age": "age",
    "email_domain": "email_domain", "payment_ratio": "payment_ratio", "direct_deposit": "direct_deposit", "state": "home_state_bal",
    "state_abbr": "state_abbr", "pre_status": "previous_type", "times_applied": "total_applicants",
    "identity_status": "identity_status", "risk_score": "risk_score", "credit_risk_score": "credit_risk_score",
    "first_model_decision": "first_model_decision", "last_model_decision": "last_model_decision", "military": "military",
    "paid_off_loans_credit": "paid_off_loans_credit", "paid_off_loans": "paid_off_loans", "card_provided": "card_provided",
    "loan_performance": "loan_performance", "id_logic": "id_logic", "account_check": "account_check", "store": "store_label", "applicant_type": "type", "if_accepted": "if_accepted", "if_funded": "if_funded",
    "lead_status": "lead_status", "loan_amount": "loan_amount_desired_bal", "original_amount": "original",
    "selected_amount": "selected", "sell_type": "sell_type", "affiliate": "affiliate", "affiliate_group": "affiliate_group",
    "sub_id": "sub_id_bal", "lead_price": "lead_price", "fraud_score": "fraud_score", "carrier_name": "carrier_name",
    "auto_ok": "auto_ok", "auto_approved": "auto_approved", "failure_reason": "failure_reason", "approval_path": "approval_path",
    "employment_response": "employment_response", "is_cnr": "is_cnr", "verified": "verified", "view_ts": "view_ts",
    "signature_ts": "signature_ts", "link_open_ts": "link_open_ts", "rejection_reason": "rejection_reason",
    "carrier_cell_cost": "carrier_cell_cost", "carrier_home_cost": "carrier_home_cost",
    "open_transaction_cost": "open_transaction_cost", "identity_cost": "identity_cost", "bureau_cost": "bureau_cost",
    "employment_cost": "employment_cost", "employment_inquiries": "employment_inquiries",
    "loan_performance_cost": "loan_performance_cost", "id_logic_cost": "id_logic_cost", "account_check_cost": "account_check_cost",
    "credit_attributes_cost": "credit_attributes_cost", "military_cost": "military_cost", "data_cost": "data_cost",
    "new_lead_cost": "new_lead_cost",
}
DEFAULT_LABELS = ("cycled", "defaulted", "failed_first_payment", "first_payment_default", "one_payment_default", "total_paid", "total_lent")


#: Columns that come with the joins that multiply rows.
MULTIPLYING = ("carrier_name", "carrier_home_cost", "carrier_cell_cost", "employment_response")


def _narrow_leads(t: Tables, p: LeadParams, xml_root: str, extra: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """(leads, answered, carriers, hot_leads): everything of a lead is derived and projected here, once, before its rows multiply."""
    # Used by the leads, the applications and the fan-out: worked out once.
    answered = checkpointed(answered_applications(t, hot_keys(t["employment_request"], "mapping_id")))
    hot_leads = hot_keys(t["lead_log"], "applicant_id")
    wide = add_derived(lead_facts(t, p, answered, hot_leads, xml_root), t, p)
    narrow = wide.select(*[F.col(source).alias(name) for name, source in PROJECTION.items() if source not in MULTIPLYING], *extra)
    return narrow, answered, carrier_values(t, answered, p), hot_leads


def wide_leads(t: Tables, p: LeadParams, xml_root: str = "loan_request", with_defaults: bool = False) -> DataFrame:
    """The projected lead table; ``with_defaults`` adds the labels and sums that training needs."""
    extra = DEFAULT_LABELS if with_defaults else ()
    leads, answered, carriers, hot_leads = _narrow_leads(t, p, xml_root, extra)
    leads = enrich(leads, carriers, "applicant_id", "left", hot=hot_leads).fillna(0, ["carrier_home_cost", "carrier_cell_cost"])
    hot_answers = hot_keys(answered, "applicant_id", bound=t["employment_request"])
    return enrich(answered, leads, "applicant_id", "inner", hot=hot_answers, lookup_hot=hot_leads).select(*PROJECTION, *extra)


def counted_leads(t: Tables, p: LeadParams, xml_root: str = "loan_request") -> DataFrame:
    """The leads before rows multiply; ``n_rows`` is how many rows of ``wide_leads`` each stands for."""
    leads, answered, carriers, hot_leads = _narrow_leads(t, p, xml_root)
    answers = answered.groupBy("applicant_id").agg(F.count("*").alias("_answers"))
    counted = answers.join(carriers.groupBy("applicant_id").agg(F.count("*").alias("_carriers")), "applicant_id", "left")
    rows = counted.select("applicant_id", (F.col("_answers") * F.coalesce("_carriers", F.lit(1))).alias("n_rows"))
    return enrich(leads, rows, "applicant_id", "inner", hot=hot_leads)


def bureau_documents(t: Tables, p: LeadParams) -> DataFrame:
    """The other extraction: application id and the bureau response alone, for flattening."""
    wanted = above_or_listed(t["applicant"].select("id"), "id", p.id_threshold, t["reserved_applicants"], "applicant_id")
    log = t["bureau_response"].where(F.col("applicant_id").isNotNull() & (F.col("store_id") != p.military_store))
    first = log.groupBy("applicant_id").agg(F.min("id").alias("id"))
    found = log.select("applicant_id", "id", "response").join(first, ["applicant_id", "id"], "left_semi").drop("id")
    return wanted.select(F.col("id").alias("applicant_id")).join(found, "applicant_id").where(F.col("response").isNotNull())
