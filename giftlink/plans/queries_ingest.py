"""Acceptance queries q01–q18 and q29 (Spark side): feed rules, scalar
functions, unions and lookups over views of the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import lookup, project, rules
from . import feeds, pipeline, views
from . import rulebook as RB

AS_OF = dt.date(2024, 3, 15)
AS_OF_SWAP = dt.date(2000, 6, 30)
STAMP = dates.period_stamp(AS_OF)
c = F.col
R6 = 6


def _card(spark, sf_dir) -> DataFrame:
    """Donations as card-gateway rows: campaign and batch reference."""
    d = views.donations(spark, sf_dir)
    d = d.withColumn("Originating Campaign", feeds.card_campaign(c("sub_id"), c("currency"), c("campaign_id")))
    return d.withColumn("Data Entry Reference", feeds.card_reference(
        c("currency"), c("Originating Campaign"), c("campaign_id"), c("amount"), STAMP))


def _schedules(spark, sf_dir) -> DataFrame:
    return views.schedules(spark, sf_dir).withColumnsRenamed(
        {"customer": "msnfp_customeridname", "name": "msnfp_name", "status": "statuscode"})


def q01_canonical_projection(spark, sf_dir):
    d = views.donations(spark, sf_dir)
    return project.project(
        d, columns=["txn_id", "donor", "currency", "sub_id", "amount", "campaign_id", "book_date"],
        rename={"txn_id": "Transaction ID", "donor": "Donor", "currency": "Currency", "sub_id": "Subscription ID",
                "amount": "Amount", "book_date": "Book Date", "campaign_id": "donation_type"},
        constants={k: RB.CARD[k] for k in ("Payment Type", "Data Entry Source", "Package")},
        drop=["donation_type"])


def q02_campaign_rules(spark, sf_dir):
    d = _card(spark, sf_dir).withColumnsRenamed({"amount": "Amount", "donor": "Donor", "currency": "Currency"})
    d = d.withColumn("Country/Region", F.lit(None).cast("string")).withColumns(
        {k: F.lit(None).cast("string") for k in ("Phone", "ZIP/Postal Code", "Email")})
    d = pipeline.clean(d)
    return d.select(c("txn_id"), c("Originating Campaign"), c("Data Entry Reference"), c("Status Reason"),
                    c("Status"), c("Anonymous"))


LINEITEM_TEXT_SPARK = [
    "case when l_linenumber = 7 then null else cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end as conf",
    "case l_linenumber % 4"
    " when 0 then '$' || cast(cast(floor(l_extendedprice) as bigint) as string) || '.' || lpad(cast(l_orderkey % 100 as string), 2, '0')"
    " when 1 then (case when cast(floor(l_extendedprice) as bigint) div 1000 > 0"
    " then cast(cast(floor(l_extendedprice) as bigint) div 1000 as string) || ',' || lpad(cast(cast(floor(l_extendedprice) as bigint) % 1000 as string), 3, '0')"
    " else cast(cast(floor(l_extendedprice) as bigint) as string) end) || '.50'"
    " when 2 then 'abc' else cast(cast(floor(l_extendedprice) as bigint) as string) end as amount_text",
    "l_tax",
]


def q03_money_parse(spark, sf_dir):
    li = views.read_table(spark, sf_dir, "lineitem").selectExpr(*LINEITEM_TEXT_SPARK)
    li = project.drop_null_keys(li, ["conf"])
    parsed = text.money(c("amount_text"))
    return li.select("conf", "amount_text", F.round(parsed, R6).alias("parsed"),
                     F.round(parsed + c("l_tax") * 100, R6).alias("total"),
                     F.round(F.lit(RB.WORKPLACE["fee_factor"]) * parsed, R6).alias("net"),
                     parsed.isNull().alias("rejected"))


DOCS_EXPRS = [
    "doc_id", "source", "text",
    "case when doc_id % 10 = 0 then 'Not shared by donor' else text end as first_name",
]


def q04_redaction(spark, sf_dir):
    d = views.read_table(spark, sf_dir, "documents").selectExpr(*DOCS_EXPRS)
    return d.select("doc_id", text.anonymous_employee(c("first_name"), c("source")).alias("Donor"),
                    text.redact(c("first_name")).alias("First Name"),
                    text.contains_literal(c("text"), "license").alias("has_license"))


def q05_currency_country(spark, sf_dir):
    d = views.donations(spark, sf_dir).withColumn(
        "Country/Region", F.when(c("sub_id").isNotNull(), F.lit("Elsewhere")))
    return d.select("txn_id", rules.translate(c("currency"), RB.CURRENCY_NAME).alias("Currency"),
                    rules.translate(c("currency"), RB.COUNTRY, default=c("Country/Region")).alias("Country/Region"))


PEOPLE_NAME_EXPRS = [
    "record_id", "name",
    "split_part(name, ' ', 1) as first_name",
    "case when position(' ' in name) > 0 then substring(name, position(' ' in name) + 1) end as last_name",
]


def q06_title_case(spark, sf_dir):
    p = views.people(spark, sf_dir).selectExpr(*PEOPLE_NAME_EXPRS)
    return p.select("record_id", text.full_name(c("first_name"), c("last_name")).alias("Donor"),
                    text.title_case(c("name")).alias("title"), F.upper("name").alias("upper"),
                    F.lower("name").alias("lower"))


def q07_identifiers(spark, sf_dir):
    d = views.donations(spark, sf_dir)
    return d.select("txn_id", F.concat(F.lit(RB.CARD["identifier"]), c("txn_id")).alias("Identifier"),
                    text.last_chars(c("campaign_id"), 2).alias("yy"),
                    F.concat(F.lit(RB.EMPLOYER["reference"] + " - "), c("donor"), F.lit(" "), c("currency"),
                             F.lit(" "), text.number_text(c("amount")), F.lit(RB.EMPLOYER["matched"])).alias("Ref"))


def q08_tokens(spark, sf_dir):
    p = views.read_table(spark, sf_dir, "part").withColumn("label", F.concat_ws(" ", "p_name", "p_type"))
    return p.select("p_partkey", text.strip_chars(F.upper("p_name"), " ", "AU").alias("stripped"),
                    text.nth_token(c("label"), 0).alias("first_token"),
                    text.first_tokens(c("label"), 2).alias("first_two"),
                    text.last_token(c("label")).alias("last_token"),
                    text.first_tokens(c("p_brand"), 2).alias("brand_two"))


SUPPLIER_EXPRS = [
    "s_suppkey",
    "case s_nationkey % 4 when 2 then 'GBP' else 'AUD' end as currency",
    "case s_suppkey % 5 when 0 then cast(s_suppkey % 1000 as varchar(9)) when 1 then 'SW1A 1AA' when 2 then null"
    " when 3 then cast(s_suppkey % 10 as varchar(9)) || '.0' else cast(2000 + s_suppkey % 100 as varchar(9)) end as post_raw",
    "case s_suppkey % 3 when 0 then '0412 ' || lpad(cast(s_suppkey % 1000000 as varchar(9)), 6, '0')"
    " when 1 then 'n/a' else null end as phone_raw",
]


def q09_postcode_phone(spark, sf_dir):
    s = views.read_table(spark, sf_dir, "supplier").selectExpr(*SUPPLIER_EXPRS)
    return s.select("s_suppkey", "currency", text.postcode(c("post_raw"), c("currency")).alias("postcode"),
                    text.phone(c("phone_raw")).alias("phone"))


def q10_dates(spark, sf_dir):
    o = views.read_table(spark, sf_dir, "orders").select("o_orderkey", c("o_orderdate").cast("date").alias("d"))
    o = o.withColumn("date_text", F.when(c("o_orderkey") % 3 == 0, F.date_format("d", "yyyy-MM-dd"))
                                   .when(c("o_orderkey") % 3 == 1, F.date_format("d", "MM/dd/yyyy"))
                                   .otherwise(F.date_format("d", "dd/MM/yyyy")))
    o = o.withColumn("parsed", dates.parse_date(c("date_text")))
    return o.select("o_orderkey", "date_text", "parsed",
                    dates.fix_future_date(c("parsed"), AS_OF_SWAP).alias("fixed"),
                    dates.day_stamp(c("parsed")).alias("week_stamp"),
                    dates.month_start(c("parsed")).alias("month_start"),
                    dates.month_end(c("parsed")).alias("month_end"),
                    F.lit(STAMP).alias("period"))


def q11_union_feeds(spark, sf_dir):
    o = views.read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O-"), c("o_orderkey").cast("string")).alias("Transaction ID"),
        c("o_totalprice").alias("Amount"), c("o_orderdate").cast("date").alias("Book Date"),
        F.lit("AUD").alias("Currency"), F.lit("orders").alias("feed"))
    li = views.read_table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("L-"), c("l_orderkey").cast("string"), F.lit("-"), c("l_linenumber").cast("string"))
        .alias("Transaction ID"),
        c("l_extendedprice").alias("Amount"), c("l_returnflag").alias("Ref"), F.lit("lineitem").alias("feed"))
    ev = views.read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("E-"), c("event_id").cast("string")).alias("Transaction ID"),
        c("value").alias("Amount"), c("ts").cast("date").alias("Book Date"),
        c("event_type").alias("donation_type"), F.lit("events").alias("feed"))
    return project.union_feeds(o, li, ev)


def q12_code_lookup(spark, sf_dir):
    d = views.donations(spark, sf_dir).select(
        "txn_id", feeds.card_campaign(c("sub_id"), c("currency"), c("campaign_id")).alias("Originating Campaign"))
    book = feeds.code_book(views.codes(spark, sf_dir).withColumnsRenamed(
        {"campaign_code": "CampaignID", "designation_code": "DesignationID (Finance GL Codes)",
         "appeal_code": "AppealID"}))
    out = feeds.with_codes(d, book)
    return out.select("txn_id", "Originating Campaign", "Primary Designation", "Appeal",
                      c("_code_found").alias("code_found"))


def q13_schedule_scan(spark, sf_dir):
    o = views.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    s = pipeline.eligible_schedules(_schedules(spark, sf_dir))
    return o.join(s, c("o_custkey") == c("c_custkey")).select(
        "o_orderkey", "c_custkey", c("msnfp_name").alias("name"), c("statuscode").alias("status"))


def _keyed(spark, sf_dir) -> DataFrame:
    d = _card(spark, sf_dir).withColumnsRenamed(
        {"sub_id": "Subscription ID", "donor": "Donor", "currency": "Currency"})
    return d.withColumn("join_on_payschedID",
                        pipeline.subscription_join_key(c("Data Entry Reference"), c("Subscription ID")))


def q14_subscription_join(spark, sf_dir):
    d = _keyed(spark, sf_dir)
    keys = pipeline.schedule_keys(pipeline.eligible_schedules(_schedules(spark, sf_dir)))
    out = lookup.lookup(d, keys.withColumnRenamed("_key", "key"), "join_on_payschedID", "key", ["_by_key"])
    return out.select("txn_id", "join_on_payschedID", c("_by_key").alias("payment_schedule"))


def q15_semi_anti(spark, sf_dir):
    d = views.donations(spark, sf_dir).select("txn_id", "donor")
    s = pipeline.eligible_schedules(_schedules(spark, sf_dir))
    semi = lookup.exists_in(d, s, "donor", "msnfp_customeridname", ignore_case=True).withColumn("match", F.lit("semi"))
    anti = lookup.exists_in(d, s, "donor", "msnfp_customeridname", negate=True, ignore_case=True).withColumn(
        "match", F.lit("anti"))
    return semi.unionByName(anti)


def q16_name_fallback(spark, sf_dir):
    d = _keyed(spark, sf_dir).drop("join_on_payschedID")
    s = pipeline.eligible_schedules(_schedules(spark, sf_dir))
    out = pipeline.match_schedules(d, s)
    return out.select("txn_id", c("_earlier").alias("payment_schedule"))


def q17_key_exists(spark, sf_dir):
    d = _keyed(spark, sf_dir)
    s = pipeline.eligible_schedules(_schedules(spark, sf_dir))
    hit = lookup.exists_in(d.where(pipeline.is_card()), pipeline.existing_keys(s), "join_on_payschedID", "_ekey")
    return hit.select("txn_id", "Currency",
                      pipeline.schedule_text(c("join_on_payschedID"), c("Currency")).alias("payment_schedule"))


SUPPLIER_GIFT_EXPRS = [
    "cast(s_suppkey as varchar(20)) as txn_id",
    "case when s_suppkey % 3 = 0 then 'Anonymous Anonymous' else s_name end as donor",
    "case when s_acctbal > 5000 then 'AUSOGF - Employer AUD 50.0 Matched Gift' else 'AUSOGF' end as ref",
    "'Employer ' || cast(s_nationkey + (s_suppkey % 2) * 25 as varchar(9)) as org",
    "case when s_suppkey % 3 = 0 then '151334' end as constituent",
]
ACCOUNT_EXPRS = [
    "'ACC' || cast(s_nationkey as varchar(9)) as msnfp_constituentnumber",
    "'Employer ' || cast(s_nationkey as varchar(9)) as name",
]


def q18_organisation_ids(spark, sf_dir):
    s = views.read_table(spark, sf_dir, "supplier")
    gifts = s.selectExpr(*SUPPLIER_GIFT_EXPRS).withColumnsRenamed(
        {"donor": "Donor", "ref": "Ref", "org": "Organization Name", "constituent": "msnfp_constituentnumber"})
    out = pipeline.assign_organisation(gifts, s.selectExpr(*ACCOUNT_EXPRS))
    return out.select("txn_id", "msnfp_constituentnumber")


ANON_EXPRS = [
    "txn_id", "currency",
    "case when cast(txn_id as bigint) % 5 = 0 then null else donor end as donor",
    "case when cast(txn_id as bigint) % 2 = 0 then null else 'AUSG-DGAQ-HR' end as campaign",
    "case when cast(txn_id as bigint) % 3 = 0 then null else 'FA-SGCF-1001' end as designation",
    "case when cast(txn_id as bigint) % 2 = 0 then null else 'SG DIGI' end as appeal",
]


def q29_anonymous_defaults(spark, sf_dir):
    d = views.donations(spark, sf_dir).selectExpr(*ANON_EXPRS).withColumnsRenamed(
        {"currency": "Currency", "donor": "Donor", "campaign": "Originating Campaign",
         "designation": "Primary Designation", "appeal": "Appeal"})
    d = d.withColumn("Anonymous", F.when(c("Donor").isNull(), F.lit("Yes")).otherwise(F.lit("No")))
    d = pipeline.default_anonymous(d)
    fixed = rules.apply_rules([(c("Donor") == k, v) for k, v in RB.ANONYMOUS_ID.items()])
    return d.select("txn_id", "Donor", "Primary Designation", "Originating Campaign", "Appeal", "Anonymous",
                    fixed.alias("msnfp_constituentnumber"))


QUERIES = {f.__name__: f for f in (
    q01_canonical_projection, q02_campaign_rules, q03_money_parse, q04_redaction, q05_currency_country,
    q06_title_case, q07_identifiers, q08_tokens, q09_postcode_phone, q10_dates, q11_union_feeds,
    q12_code_lookup, q13_schedule_scan, q14_subscription_join, q15_semi_anti, q16_name_fallback,
    q17_key_exists, q18_organisation_ids, q29_anonymous_defaults)}
