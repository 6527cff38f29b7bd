"""Parameters of the pipelines, and the values that are fixed by the data they describe."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

# --- fixed values -----------------------------------------------------------------

# US state and territory codes.
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire",
    "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina",
    "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania",
    "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee",
    "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington",
    "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming", "DC": "District of Columbia",
    "AS": "American Samoa", "GU": "Guam", "MP": "Northern Mariana Islands", "PR": "Puerto Rico",
    "UM": "United States Minor Outlying Islands", "VI": "U.S. Virgin Islands",
}

# Bank names: (fragments, canonical name), first match wins.
BANK_RULES_TRAINING = (
    (("CHAS",), "CHASE"),
    (("BANK OF AMERICA", "BANKOFAMERICA", "BANKOF AMERICA"), "BANK OF AMERICA"),
    (("WELLS FARGO",), "WELLS FARGO"),
    (("PNC",), "PNC"),
    (("CITIBANK",), "CITI"),
)
BANK_RULES_SCORING = (
    (("CHAS",), "CHASE"),
    (("BANK OF AMERICA", "BANKOFAMERICA", "BANKOF AMERICA"), "BANK OF AMERICA"),
    (("WELLS FARGO",), "WELLS FARGO"),
    (("PNC",), "PNC"),
    (("WACHOVIA",), "WACHOVIA"),
    (("WOODFOREST",), "WOODFOREST NATIONAL BANK"),
    (("CITI",), "CITI"),
)

# Pay periods: income per period -> income per month, as (times, divided by).
PAY_PERIODS = {
    "Hourly": (8 * 5 * 52, 12),
    "Daily": (5 * 52, 12),
    "Weekly": (52, 12),
    "Bi-weekly": (26, 12),
    "Semi-monthly": (2, 1),
    "Monthly": (1, 1),
    "Annual": (1, 12),
}

# Two-valued columns: label -> number. Sub-id labels are added by the caller.
BINARY_LABELS = {
    "N": 1, "Y": 0, "rare": 0, "Missing": 0, "Rent": 1, "Own": 0, "EB": 1, "P": 0, "D": 1, "A": 0,
}

# Store ids that the first store-two record maps to a label of its own.
FIRST_STORE_LABELS = {6: "Store 06", 7: "Store 07", 8: "Store 08", 9: "Store 09", 10: "Store 10", 11: "Store 11"}

# Return codes that do not count as a failed first payment.
EXEMPT_RETURN_CODES = ("R01", "R09", "R99")

# Model input, in the order the model expects.
FEATURE_ORDER = (
    "RiskScore_y", "Payment_ratio", "PayDateMatchProjecteddiff", "SFNumberofOpenLoans", "FPDForABA",
    "EmployerNumbers", "Bankaccountlengthmonths", "SFNumberofLoansPastDue", "NumberofLoansPaidOff",
    "PayDateMatchPercentage", "CustomerDDACount", "TotalNumberofLoansDelinquent", "Pre_Status",
    "Bank", "State_y", "MonthsOnJob", "CustomerDDACount1Year", "Age", "Affiliate",
    "TotalNumberofLoansOriginated", "Loanamount", "SFNumberofMerchants", "CustomerAddressCount",
    "TotalNumberofLoansOriginatedLastYear", "ActiveAccount", "NumberofCustomersonBankAccount",
    "LastPaymentDatediff", "MonthlyIncome", "SFNumberofNewLoansOriginatedLastYear",
    "FraudRiskScore", "SFNumberofNewLoansOriginated", "ProjectedPayDatediff",
    "NumberofApplications", "TotalNumberofLoansDelinquentLastYear", "PayFrequencyMatchPercentage",
    "PayDateMatchCount", "NumberofApplicationsAllTime", "TotalOSBalance",
    "LastDateApplicationReceiveddiff", "NumberofMerchantsAllTime", "CustomerDDACount6Months",
    "NumberofLoansPastDue", "SFTotalOSBalance", "SFNumberofLoansPaidOffLastYear",
    "TotalAmountDelinquentLastYear", "NumberofApplications30", "TotalAmountDelinquent",
    "NumberofApplications90", "Monthsatresidence", "IPAddressOriginDomains", "LastPaymentAmount",
    "SFLastDateApplicationReceiveddiff", "FPDForABACount", "Salary", "NumberofMerchants30",
)

# Columns of a scoring request that hold text, percentages and dates.
PERCENT_COLUMNS = ("PayDateMatchPercentage", "PayFrequencyMatchPercentage")
DATE_COLUMNS = (
    "PayDateMatchProjected", "ProjectedPayDate", "SFLastDateApplicationReceived",
    "LastDateApplicationReceived", "LastPaymentDate",
)
LABEL_COLUMNS = (
    "NumberofMerchants30", "Pre_Status", "State_y", "SFNumberofMerchants", "Bank", "Loanamount",
    "Affiliate", "CustomerDDACount1Year", "ActiveAccount", "NumberofCustomersonBankAccount",
    "CustomerDDACount6Months", "IPAddressOriginDomains",
)

# Fills for the date differences, in days.
DATE_DIFF_FILLS = {
    "PayDateMatchProjecteddiff": -2.0,
    "LastPaymentDatediff": 48.0,
    "ProjectedPayDatediff": -13.0,
    "LastDateApplicationReceiveddiff": 20.0,
    "SFLastDateApplicationReceiveddiff": 145.0,
}
CONSTANT_FILLS = {"Pre_Status": "BrandNew", "IPAddressOriginDomains": "Missing"}

# Score cut-offs on the 0-1000 scale.
SCORE_CUTOFFS = (636, 643)


# --- parameters -------------------------------------------------------------------


@dataclass(frozen=True)
class Prices:
    identity: Decimal = Decimal("0.07")
    open_transaction: Decimal = Decimal("0.10")
    bank_verification: Decimal = Decimal("0.25")
    carrier: Decimal = Decimal("0.005")
    credit_attributes: Decimal = Decimal("0.70")
    military: Decimal = Decimal("0.06")
    employment_early: Decimal = Decimal("6.00")
    employment_late: Decimal = Decimal("3.80")
    employment_change: dt.date = dt.date(2018, 12, 1)


@dataclass(frozen=True)
class Markers:
    loan_performance: str = "<LoanPerformance>"
    identity: str = "<IDV>"
    address: str = "AddressisCurrent"
    account: str = "<ChexAdvisor>"
    credit_attributes: str = '<Service Name="TraditionalCreditAttributes">'
    no_employer: str = '"EmployerName":""'


@dataclass(frozen=True)
class LeadParams:
    """Everything the lead extraction takes from outside: dates, ids, mappings, prices."""

    as_of: dt.date
    start: dt.date
    id_threshold: int
    partner_groups: dict[str, str] = field(default_factory=dict)
    default_group: str = "Other"
    organic_ids: tuple[str, ...] = ()
    organic_account_ids: tuple[str, ...] = ()
    sub_id_partner: str = ""
    share_partners: tuple[str, ...] = ()
    flat_partner: str = ""
    late_partner: str = ""
    share_rate: Decimal = Decimal("0.25")
    flat_cost: Decimal = Decimal("75")
    late_cost: Decimal = Decimal("11")
    bot_user: str = "bot"
    military_store: str = "0020"
    credit_store: str = "0030"
    first_model: str = "bureau"
    last_model: str = "military"
    forest_model: str = "RandomForest"
    verify_locations: tuple[str, ...] = ("2", "5")
    prices: Prices = Prices()
    markers: Markers = Markers()
