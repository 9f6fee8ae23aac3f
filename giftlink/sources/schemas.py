"""Declared schemas of the six raw feeds (FIXTURES §1).

Fixed values: the column names are the export platforms' own and must match
their headers. Files are read by header name, so their order here is free."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType


def _s(*names, types=None) -> StructType:
    types = types or {}
    return StructType([StructField(n, types.get(n, StringType()), True) for n in names])


CARD = _s("Settlement Date", "Transaction ID", "Subscription ID", "Amount Submitted For Settlement",
          "Currency ISO Code", "Campaign Id", "Customer First Name", "Customer Last Name", "Customer Email",
          "Customer Phone", "Card Type", "Last Four of Credit Card",
          types={"Amount Submitted For Settlement": DoubleType()})
EMPLOYER = _s("Company", "Donor First Name", "Donor Last Name", "Email", "Address", "City", "State/Province",
              "Postal Code", "Transaction ID", "Donation Frequency", "Currency",
              "Total Donation to be Acknowledged", "Match Amount", types={"Match Amount": DoubleType()})
WORKPLACE = _s("Good2Give Donor Id", "Donor Firstname", "Donor Lastname", "Donation Amount", "Employer Name",
               "Donor Email", "Donation Type", "Donation Confirmation Number",
               types={"Good2Give Donor Id": DoubleType()})
KARMA = _s("Date", "Amount", "Site", "Type", "Recurrence", "First Name", "Last Name", "Email", "State",
           "Postal Address", "Suburb", "Post Code", "Transaction Reference", types={"Amount": DoubleType()})
UK_TRUST = _s("PGA Donor Ref Number", "Employer Name", "First Name", "Last Name", "Donor Email", "Donor Tel No",
              "Address 1", "Address 2", "Address 3", "Postcode", "Donor Preference Post", "Donor Preference Email",
              "Donor Preference Phone", "Donor Preference SMS", "Total Donation to Charity",
              types={"Total Donation to Charity": DoubleType()})
INSIGHT = _s("Week Ending", "Bank Date", "Insight WP Number", "Customer Id", "First name", "SurName", "Address1",
             "Suburb", "State", "Post Code", "Telephone", "Email Address", "Donation Value $", "Sale Type",
             types={"Week Ending": DateType(), "Bank Date": DateType(), "Donation Value $": DoubleType()})
CODE_BOOK = _s("CampaignID", "DesignationID (Finance GL Codes)", "AppealID")

# Preamble / trailer lines of the report-style exports.
REPORT_LINES = {"employer": (11, 4), "workplace": (2, 2)}
