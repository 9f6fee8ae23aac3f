"""q30, q32: the whole job (P7) on TESTDATA: donations as a card-gateway export,
customers as the CRM, schedules from customers; output is the flagged
transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pipeline, views
from .queries_ingest import AS_OF, _schedules

c = F.col
R6 = 6

# Raw card-gateway export derived from the donations view.
CARD_FEED_EXPRS = [
    "cast(book_date as varchar(10)) as settlement_date",
    "txn_id", "sub_id", "amount", "currency", "campaign_id",
    "split_part(donor, '#', 1) as first_name",
    "split_part(donor, '#', 2) as last_name",
    "case when cast(txn_id as bigint) % 4 = 0 then null"
    " else 'Customer.' || split_part(donor, '#', 2) || '@Example.org' end as email",
    "cast(null as varchar(20)) as phone",
    "'Visa' as card_type",
    "right(txn_id, 4) as last_four",
]
CARD_FEED_RENAME = {
    "settlement_date": "Settlement Date", "txn_id": "Transaction ID", "sub_id": "Subscription ID",
    "amount": "Amount Submitted For Settlement", "currency": "Currency ISO Code", "campaign_id": "Campaign Id",
    "first_name": "Customer First Name", "last_name": "Customer Last Name", "email": "Customer Email", "phone": "Customer Phone",
    "card_type": "Card Type", "last_four": "Last Four of Credit Card",
}
# The same export with transaction ids that are null or repeat; the job must
# return one linked row per row all the same.
REPEATING_FEED_EXPRS = [
    "case when cast(txn_id as bigint) % 5 = 0 then null"
    " when cast(txn_id as bigint) % 5 = 1 then 'T' || cast(cast(txn_id as bigint) % 50 as varchar(9))"
    " else txn_id end as txn_id" if e == "txn_id" else e for e in CARD_FEED_EXPRS]
# CRM transactions (one per customer) derived from the customer table.
CRM_EXPRS = [
    "c_custkey as msnfp_transactionid",
    "'Customer ' || substring(c_name, 10) as msnfp_customeridname",
    "case when c_custkey % 3 = 0 then null else 'customer.' || substring(c_name, 10) || '@example.org' end"
    " as emailaddress1",
    "case c_nationkey % 4 when 0 then 'AUSG-DGAQ-HR' when 1 then 'NZSG-DGAQ-HR' when 2 then 'UKSG-DGAQ-HR' end"
    " as msnfp_originatingcampaignidname",
    "case when c_custkey % 2 = 0 then 'FA-AFRICA-0' else 'FA-SGCF-1001' end as msnfp_designationidname",
    "case when c_custkey % 5 = 0 then null else 'SG NATION_0' end as msnfp_appealidname",
    "'External Credit/Debit' as msnfp_paymenttypecodename",
    "'Visa - ' || lpad(cast(c_custkey % 10000 as varchar(9)), 4, '0') as msnfp_transaction_paymentmethodidname",
    "date '2024-01-01' + cast(c_custkey % 365 as int) as msnfp_bookdate",
    "cast(c_custkey as varchar(20)) as msnfp_constituentnumber",
]


def card_feed(spark, sf_dir, exprs: list | None = None) -> DataFrame:
    return views.donations(spark, sf_dir).selectExpr(*(exprs or CARD_FEED_EXPRS)).withColumnsRenamed(CARD_FEED_RENAME)


def crm_transactions(spark, sf_dir) -> DataFrame:
    return views.read_table(spark, sf_dir, "customer").selectExpr(*CRM_EXPRS)


def accounts(spark, sf_dir) -> DataFrame:
    from .queries_ingest import ACCOUNT_EXPRS
    return views.read_table(spark, sf_dir, "supplier").selectExpr(*ACCOUNT_EXPRS)


def codes(spark, sf_dir) -> DataFrame:
    return views.codes(spark, sf_dir).withColumnsRenamed(
        {"campaign_code": "CampaignID", "designation_code": "DesignationID (Finance GL Codes)",
         "appeal_code": "AppealID"})


def schedules(spark, sf_dir) -> DataFrame:
    """Customer names written as the feed's donors are, so that the name
    rule (J5) finds schedules."""
    return _schedules(spark, sf_dir).withColumn(
        "msnfp_customeridname", F.replace("msnfp_customeridname", F.lit("#"), F.lit(" ")))


def run_job(spark, sf_dir, exprs: list | None = None) -> DataFrame:
    return pipeline.run({"card": card_feed(spark, sf_dir, exprs)}, codes(spark, sf_dir), schedules(spark, sf_dir),
                        crm_transactions(spark, sf_dir), accounts(spark, sf_dir), AS_OF)


def _flagged(out: DataFrame) -> DataFrame:
    return out.select("Identifier", "Book Date", "Currency", "Payment Schedule", "join_on_payschedID",
                      "msnfp_constituentnumber", F.round("match_prob", R6).alias("match_prob"),
                      "donor_flagger", "flag_reason")


def q30_action_flags(spark, sf_dir):
    return _flagged(run_job(spark, sf_dir))


def q32_repeated_identifiers(spark, sf_dir):
    return _flagged(run_job(spark, sf_dir, REPEATING_FEED_EXPRS))


QUERIES = {f.__name__: f for f in (q30_action_flags, q32_repeated_identifiers)}
