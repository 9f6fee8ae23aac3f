"""DuckDB SQL for q01–q18 and q29, written directly from the rules (not
generated from the Spark plans)."""

from __future__ import annotations

from ..functions.dates import period_stamp
from . import rulebook as RB
from .queries_ingest import (ACCOUNT_EXPRS, ANON_EXPRS, AS_OF, AS_OF_SWAP, DOCS_EXPRS, PEOPLE_NAME_EXPRS,
                             SUPPLIER_EXPRS, SUPPLIER_GIFT_EXPRS)
from .views import sql as select_sql
from .views import with_views

STAMP = period_stamp(AS_OF)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def card_campaign_sql(sub="sub_id", cur="currency", cid="campaign_id") -> str:
    base = " ".join(f"when {sub} is {'not ' if has else ''}null and {cur} = {_q(k)} then {_q(v)}"
                    for (has, k), v in RB.CARD_CAMPAIGN.items())
    seas = " ".join(f"when contains({cid}, {_q(m)}) then {_q(p)} || right({cid}, 2) || {_q(s)}"
                    for m, p, s in RB.SEASONAL)
    return f"case {seas} else (case {base} end) end"


def card_reference_sql(cur="currency", camp="campaign", cid="campaign_id", amount="amount") -> str:
    parts = [f"when {cur} = {_q(k)} and {camp} = {_q(v)} then {_q(label + ' ' + STAMP)}"
             for k, v, label in RB.CARD_REFERENCE]
    parts += [f"when {cur} = 'AUD' and {camp} = {_q(p)} || right({cid}, 2) || {_q(s)} "
              f"then {_q(label + ' ' + STAMP)}" for (_, p, s), label in zip(RB.SEASONAL, RB.SEASONAL_REFERENCE)]
    base = "case " + " ".join(parts) + " end"
    return f"case when {amount} < 0 then ({base}) || ' Refund' else ({base}) end"


CARD_CTE = f"""card as (
  select *, {card_reference_sql()} as der from (
    select *, {card_campaign_sql()} as campaign from donations))"""

SCHED_CTE = """sch as (select * from schedules where name like '%Braintree%' and status <> '844060001'),
skey as (select *, case when regexp_extract(name, 'SubID: *([^ )]+)', 1) <> ''
                        then regexp_extract(name, 'SubID: *([^ )]+)', 1) else split_part(name, ' ', -1) end as key
         from sch),
bykey as (select key, min(name) as by_key from skey where contains(name, 'DIGI') group by key),
keyed as (select *, case when contains(der, 'Braintree') and contains(der, 'RG') then sub_id end as join_on from card)"""

TITLE = ("array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)'), "
         "lambda t: upper(left(t, 1)) || substr(t, 2)), '')")


def title_sql(x: str) -> str:
    return TITLE.format(x=x)


def cap_sql(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


def tokens_sql(x: str) -> str:
    return f"string_split_regex(trim({x}), '\\s+')"


def oracle_queries() -> dict:
    q = {}
    q["q01_canonical_projection"] = with_views("""
select txn_id as "Transaction ID", donor as "Donor", currency as "Currency", sub_id as "Subscription ID",
       amount as "Amount", book_date as "Book Date", 'External Credit/Debit' as "Payment Type",
       'Online' as "Data Entry Source", 'Online' as "Package"
from donations""", "donations")
    q["q02_campaign_rules"] = with_views(f"""
with {CARD_CTE}
select txn_id, campaign as "Originating Campaign", der as "Data Entry Reference",
       case when amount < 0 then 'Refund' else 'Completed' end as "Status Reason", 'Active' as "Status",
       case when donor is null then 'Yes' else 'No' end as "Anonymous"
from card""", "donations")
    li = """
with li as (
  select case when l_linenumber = 7 then null else cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) end as conf,
         case l_linenumber % 4
           when 0 then '$' || cast(cast(floor(l_extendedprice) as bigint) as varchar) || '.' || lpad(cast(l_orderkey % 100 as varchar), 2, '0')
           when 1 then (case when cast(floor(l_extendedprice) as bigint) // 1000 > 0
                        then cast(cast(floor(l_extendedprice) as bigint) // 1000 as varchar) || ',' || lpad(cast(cast(floor(l_extendedprice) as bigint) % 1000 as varchar), 3, '0')
                        else cast(cast(floor(l_extendedprice) as bigint) as varchar) end) || '.50'
           when 2 then 'abc' else cast(cast(floor(l_extendedprice) as bigint) as varchar) end as amount_text,
         l_tax
  from lineitem),
p as (select *, try_cast(replace(replace(amount_text, ',', ''), '$', '') as double) as parsed from li where conf is not null)
select conf, amount_text, round(parsed, 6) as parsed, round(parsed + l_tax * 100, 6) as total,
       round(cast(0.95 as double) * parsed, 6) as net, parsed is null as rejected
from p"""
    q["q03_money_parse"] = li
    q["q04_redaction"] = f"""
with d as ({select_sql(DOCS_EXPRS, 'documents')})
select doc_id,
       case when coalesce(contains(lower(first_name), 'not shared'), false) then source || ' (Anonymous Employee)'
            else first_name end as "Donor",
       case when coalesce(contains(lower(first_name), 'not shared'), false) then '' else first_name end as "First Name",
       coalesce(contains(text, 'license'), false) as has_license
from d"""
    cname = " ".join(f"when currency = {_q(k)} then {_q(v)}" for k, v in RB.CURRENCY_NAME.items())
    country = " ".join(f"when currency = {_q(k)} then {_q(v)}" for k, v in RB.COUNTRY.items())
    q["q05_currency_country"] = with_views(f"""
select txn_id, case {cname} end as "Currency",
       case {country} else (case when sub_id is not null then 'Elsewhere' end) end as "Country/Region"
from donations""", "donations")
    q["q06_title_case"] = with_views(f"""
with p as ({select_sql(PEOPLE_NAME_EXPRS, 'people')})
select record_id, {title_sql(cap_sql('first_name') + " || ' ' || " + cap_sql('last_name'))} as "Donor",
       {title_sql('name')} as title, upper(name) as upper, lower(name) as lower
from p""", "people")
    q["q07_identifiers"] = with_views("""
select txn_id, 'Braintree - ' || txn_id as "Identifier", right(campaign_id, 2) as yy,
       'AUSOGF - ' || donor || ' ' || currency || ' ' ||
       (case when abs(amount) < 1e7 then cast(amount as varchar)
             else regexp_replace(cast(cast(amount as decimal(20, 2)) as varchar), '0$', '') end)
       || ' Matched Gift' as "Ref"
from donations""", "donations")
    q["q08_tokens"] = f"""
with p as (select *, p_name || ' ' || p_type as label from part)
select p_partkey, replace(replace(upper(p_name), ' ', ''), 'AU', '') as stripped,
       {tokens_sql('label')}[1] as first_token,
       case when len({tokens_sql('label')}) >= 2 then {tokens_sql('label')}[1] || ' ' || {tokens_sql('label')}[2] end as first_two,
       split_part(label, ' ', -1) as last_token,
       case when len({tokens_sql('p_brand')}) >= 2 then {tokens_sql('p_brand')}[1] || ' ' || {tokens_sql('p_brand')}[2] end as brand_two
from p"""
    q["q09_postcode_phone"] = f"""
with s as ({select_sql(SUPPLIER_EXPRS, 'supplier')}),
t as (select *, try_cast(post_raw as double) as d from s)
select s_suppkey, currency,
       case when currency = 'GBP' then post_raw
            when d = floor(d) then (case when length(cast(cast(d as bigint) as varchar)) < 4
                                         then '0' || cast(cast(d as bigint) as varchar)
                                         else cast(cast(d as bigint) as varchar) end) end as postcode,
       '0' || cast(try_cast(replace(phone_raw, ' ', '') as bigint) as varchar) as phone
from t"""
    q["q10_dates"] = f"""
with o as (select o_orderkey, cast(o_orderdate as date) as d from orders),
t as (select o_orderkey, case o_orderkey % 3 when 0 then strftime(d, '%Y-%m-%d') when 1 then strftime(d, '%m/%d/%Y')
                         else strftime(d, '%d/%m/%Y') end as date_text from o),
p as (select *, coalesce(cast(try_strptime(date_text, '%Y-%m-%d') as date), cast(try_strptime(date_text, '%m/%d/%Y') as date),
                         cast(try_strptime(date_text, '%d/%m/%Y') as date)) as parsed from t)
select o_orderkey, date_text, parsed,
       case when parsed > date '{AS_OF_SWAP}' and day(parsed) <= 12 then make_date(year(parsed), day(parsed), month(parsed))
            else parsed end as fixed,
       strftime(parsed, '%Y%m%d') as week_stamp, cast(date_trunc('month', parsed) as date) as month_start,
       last_day(parsed) as month_end, '{STAMP}' as period
from p"""
    q["q11_union_feeds"] = """
select 'O-' || cast(o_orderkey as varchar) as "Transaction ID", o_totalprice as "Amount",
       cast(o_orderdate as date) as "Book Date", 'AUD' as "Currency", 'orders' as feed from orders
union all by name
select 'L-' || cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as "Transaction ID",
       l_extendedprice as "Amount", l_returnflag as "Ref", 'lineitem' as feed from lineitem
union all by name
select 'E-' || cast(event_id as varchar) as "Transaction ID", value as "Amount", cast(ts as date) as "Book Date",
       event_type as donation_type, 'events' as feed from events"""
    q["q12_code_lookup"] = with_views(f"""
with cb as (select campaign_code, arg_min(designation_code, ordinal) as des, arg_min(appeal_code, ordinal) as app
            from codes group by campaign_code),
d as (select txn_id, {card_campaign_sql()} as campaign from donations)
select txn_id, campaign as "Originating Campaign", {tokens_sql('des')}[1] as "Primary Designation",
       case when len({tokens_sql('app')}) >= 2 then {tokens_sql('app')}[1] || ' ' || {tokens_sql('app')}[2] end as "Appeal",
       cb.campaign_code is not null as code_found
from d left join cb on d.campaign = cb.campaign_code""", "donations", "codes")
    q["q13_schedule_scan"] = with_views("""
select o_orderkey, c_custkey, name, status
from orders join schedules on o_custkey = c_custkey
where name like '%Braintree%' and status <> '844060001'""", "schedules")
    q["q14_subscription_join"] = with_views(f"""
with {CARD_CTE},
{SCHED_CTE}
select txn_id, join_on as join_on_payschedID, by_key as payment_schedule
from keyed left join bykey on keyed.join_on = bykey.key""", "donations", "schedules")
    q["q15_semi_anti"] = with_views("""
with sch as (select * from schedules where name like '%Braintree%' and status <> '844060001')
select txn_id, donor,
       case when exists (select 1 from sch where lower(sch.customer) = lower(d.donor)) then 'semi' else 'anti' end as match
from donations d""", "donations", "schedules")
    q["q16_name_fallback"] = with_views(f"""
with {CARD_CTE},
{SCHED_CTE},
byname as (select lower(customer) as cust, min(name) as by_name from sch group by lower(customer)),
j as (select keyed.txn_id, keyed.donor, bykey.by_key from keyed left join bykey on keyed.join_on = bykey.key)
select txn_id, coalesce(by_key, by_name) as payment_schedule
from j left join byname on lower(j.donor) = byname.cust and j.by_key is null""", "donations", "schedules")
    text_ = "'DIGI AU Braintree (SubID: ' || join_on || ' )'"
    cc = " ".join(f"when currency = {_q(k)} then 'DIGI {v}' || substr({text_}, 8)" for k, v in RB.SCHEDULE_COUNTRY.items())
    q["q17_key_exists"] = with_views(f"""
with {CARD_CTE},
{SCHED_CTE}
select txn_id, currency as "Currency", case {cc} else {text_} end as payment_schedule
from keyed
where contains(der, 'Braintree') and exists (select 1 from skey where skey.key = keyed.join_on)""",
                                     "donations", "schedules")
    q["q18_organisation_ids"] = f"""
with g as ({select_sql(SUPPLIER_GIFT_EXPRS, 'supplier')}),
acc as (select name, min(msnfp_constituentnumber) as acc
        from (select distinct * from ({select_sql(ACCOUNT_EXPRS, 'supplier')})) group by name)
select txn_id,
       case when coalesce(contains(ref, 'Matched'), false) and coalesce(contains(donor, 'Anonymous'), false)
            then coalesce(acc.acc, g.constituent) else g.constituent end as msnfp_constituentnumber
from g left join acc on g.org = acc.name"""
    dflt = {col: " ".join(f"when all_null and \"Currency\" = {_q(cur)} then {_q(vals[i])}"
                          for cur, vals in RB.ANONYMOUS.items())
            for i, col in enumerate(("Primary Designation", "Originating Campaign", "Appeal", "Donor"))}
    donor_only = " ".join(f"when anon = 'Yes' and \"Donor\" is null and \"Currency\" = {_q(cur)} then {_q(vals[3])}"
                          for cur, vals in RB.ANONYMOUS.items())
    ids = " ".join(f"when d2 = {_q(k)} then {_q(v)}" for k, v in RB.ANONYMOUS_ID.items())
    q["q29_anonymous_defaults"] = with_views(f"""
with a as (select txn_id, currency as "Currency", donor as "Donor", campaign as "Originating Campaign",
                  designation as "Primary Designation", appeal as "Appeal"
           from ({select_sql(ANON_EXPRS, 'donations')})),
b as (select *, case when "Donor" is null then 'Yes' else 'No' end as anon from a),
c as (select *, anon = 'Yes' and "Donor" is null and "Primary Designation" is null and "Originating Campaign" is null
                and "Appeal" is null as all_null from b),
d as (select txn_id, anon,
             case {dflt['Primary Designation']} else "Primary Designation" end as des,
             case {dflt['Originating Campaign']} else "Originating Campaign" end as camp,
             case {dflt['Appeal']} else "Appeal" end as app,
             case {dflt['Donor']} {donor_only} else "Donor" end as d2
      from c)
select txn_id, d2 as "Donor", des as "Primary Designation", camp as "Originating Campaign", app as "Appeal",
       anon as "Anonymous", case {ids} end as msnfp_constituentnumber
from d""", "donations")
    return q
