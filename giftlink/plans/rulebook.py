"""Business constants the results depend on. Fixed values that must equal
the reference's, stated plainly and in natural order."""

# Card gateway campaign by (subscription set?, currency).
CARD_CAMPAIGN = {
    (False, "AUD"): "AUSG-DGAQ-HR",
    (False, "NZD"): "NZSG-DGAQ-HR",
    (False, "GBP"): "UKSG-DGAQ-HR",
    (True, "AUD"): "AURG-DGAQ-HR",
    (True, "NZD"): "NZRG-DGAQ-HR",
    (True, "GBP"): "UKRG-DGAQ-HR",
}
# Seasonal campaign override: marker in Campaign Id -> prefix, suffix
# around the two-digit year taken from its last two characters.
SEASONAL = (
    ("tax", "AUSG-DMRN-HR-", "02-D1"),
    ("xmas", "AUSG-DMRN-HR-", "04-W2"),
)
# Card gateway reference text: (currency, campaign) -> middle part.
CARD_REFERENCE = (
    ("AUD", "AUSG-DGAQ-HR", "Braintree AU Online OO"),
    ("NZD", "NZSG-DGAQ-HR", "Braintree NZ Online OO"),
    ("GBP", "UKSG-DGAQ-HR", "Braintree UK Online OO"),
    ("AUD", "AURG-DGAQ-HR", "Braintree AU Online RG"),
    ("NZD", "NZRG-DGAQ-HR", "Braintree NZ Online RG"),
    ("GBP", "UKRG-DGAQ-HR", "Braintree UK Online RG"),
)
# Reference text of the seasonal campaigns (AUD only), in SEASONAL's order.
SEASONAL_REFERENCE_CURRENCY = "AUD"
SEASONAL_REFERENCE = ("Braintree AU Online OO Tax Appeal", "Braintree AU Online OO Xmas Appeal")
REFUND_SUFFIX = " Refund"
CARD_FEED_MARKER = "Braintree"
RECURRING_MARKER = "RG"

# Per-feed constants.
CARD = {"Payment Type": "External Credit/Debit", "Data Entry Source": "Online", "Package": "Online",
        "identifier": "Braintree - "}
EMPLOYER = {
    "One Time": ("AUSG-DGAQ-CM", "FA-SGCF-1001", "SG DIGI"),
    "Recurring": ("AUMG-COAQ-HR-WP", "FA-PHWG-1001", "PHIL CORP"),
    "Payment Type": "Other", "Package": "Benevity", "Data Entry Source": "Direct Deposit",
    "reference": "AUSOGF", "identifier": "Benevity - ", "matched": " Matched Gift",
}
WORKPLACE = {
    "Currency": "AUD", "Originating Campaign": "AUMG-COAQ-HR-WP", "Primary Designation": "FA-PHWG-1001",
    "Appeal": "PHIL CORP", "Payment Type": "Other", "Data Entry Source": "Direct Deposit",
    "reference": "Good2Give", "identifier": "Good2Give - ", "ref": "Good2Give Donor ID ",
    "giving": "Workplace Giving", "matched_types": ("Employer Matched", "Match"),
    "matched": " - Employer Matched", "fee_factor": 0.95,
}
KARMA = {
    "matched_types": ("Payroll Giving", "Matched Giving"),
    "matched": ("AUMG-COAQ-HR-WP", "FA-PHWG-1001", "PHIL CORP"),
    "other": ("AUSG-DGAQ-CM", "FA-SGCF-1001", "SG DIGI"),
    "Payment Type": "Other", "Package": "KarmaCurrency/Karma Currency", "Data Entry Source": "Direct Deposit",
    "Currency": "AUD", "reference": "KarmaCurrency Fd", "identifier": "KarmaCurrency - ",
}
UK_TRUST = {
    "Currency": "GBP", "Originating Campaign": "UKMG-COAQ-HR-WP", "Primary Designation": "FG-PHWG-1001",
    "Appeal": "PHIL CORP", "Package": "Charities Trust UK", "Payment Type": "Other",
    "Data Entry Source": "Direct Deposit", "reference": "Charities Trust UK", "identifier": "Charities Trust UK - ",
    "ref": "Charities Trust UK ", "donation_type": "Recurring",
}
INSIGHT = {
    "Data Entry Source": "TM", "Originating Campaign": "AUSG-TMAQ-IN-DONATE", "Primary Designation": "FA-SGLR-1001",
    "Appeal": "SG LOTT/RAFF", "Package": "DONATIONS", "Payment Type": "Other", "Ref": "Receipted by Insight",
    "Country/Region": "Australia", "Currency": "AUD", "reference": "Westpac_Insight OO ", "identifier": "Insight - ",
}

# Canonical cleaning.
STATUS = ("Active", "Completed", "Refund")
COUNTRY = {"AUD": "Australia", "NZD": "New Zealand", "GBP": "United Kingdom"}
CURRENCY_NAME = {"AUD": "Australian Dollar", "NZD": "New Zealand Dollar", "GBP": "UK Pound", "CAD": "Canadian Dollar"}
# Anonymous defaults per currency: designation, campaign, appeal, donor.
ANONYMOUS = {
    "AUD": ("FA-SGDM-1990", "AUSG-DMAQ-UN", "SG GENERAL", "Anonymous Anonymous"),
    "NZD": ("FN-SGDM-1990", "NZSG-DMAQ-UN", "SG GENERAL", "Anonymous NZ"),
    "GBP": ("FG-SGDM-1990", "UKSG-DMAQ-UN", "SG GENERAL", "Anonymous UK"),
}
# Constituent numbers of the generic anonymous donors.
ANONYMOUS_ID = {"Anonymous Anonymous": "151334", "Anonymous NZ": "150888", "Anonymous UK": "143900"}
ORGANISATION_MARKERS = ("Matched", "Anonymous")

# Payment schedules: status excluded from the CRM scan, marker of
# card-gateway schedules, key pattern and display text.
SCHEDULE_EXCLUDED_STATUS = "844060001"
SCHEDULE_NAME_MARKER = "Braintree"
SCHEDULE_KEY_MARKER = "DIGI"
SCHEDULE_KEY_PATTERN = r"SubID: *([^ )]+)"
SCHEDULE_TEXT = ("DIGI AU Braintree (SubID: ", " )")
SCHEDULE_COUNTRY = {"NZD": "NZ", "GBP": "UK"}

# Action flags (first match wins), default all_good.
FLAGS = ("check_conID", "new_conID_new_payschedID", "check_conID_new_payschedID", "new_payschedID", "new_conID")
DEFAULT_FLAG = "all_good"
