"""DuckDB SQL for q30 and q32: card rules, code book, schedules, brute-force
linkage and the flag table, composed as one statement."""

from __future__ import annotations

from ..config import LINK_COLUMNS
from . import rulebook as RB
from .oracle_ingest import _q, card_campaign_sql, card_reference_sql, cap_sql, title_sql, tokens_sql
from .oracle_linkage import BEST, linkage_ctes
from .queries_job import CARD_FEED_EXPRS, CRM_EXPRS, REPEATING_FEED_EXPRS
from .views import VIEW_SQL
from .views import sql as select_sql


def job_sql(feed_exprs: list) -> str:
    recs = ("recs as (select record_id, side, "
            + ", ".join(f"nullif({c}, '') as {c}" for c in LINK_COLUMNS)
            + ", book_date, constituent from recs0)")
    flags = RB.FLAGS
    cname = " ".join(f"when currency = {_q(k)} then {_q(v)}" for k, v in RB.CURRENCY_NAME.items())
    text_ = "'DIGI AU Braintree (SubID: ' || join_on || ' )'"
    cc = " ".join(f"when currency = {_q(k)} then 'DIGI {v}' || substr(ps0, 8)" for k, v in RB.SCHEDULE_COUNTRY.items())
    return f"""
with donations as ({VIEW_SQL['donations']}),
codes as ({VIEW_SQL['codes']}),
schedules as ({VIEW_SQL['schedules']}),
raw as ({select_sql(feed_exprs, 'donations')}),
cb as (select campaign_code, arg_min(designation_code, ordinal) as des, arg_min(appeal_code, ordinal) as app
       from codes group by campaign_code),
t0 as (select *, {card_campaign_sql('sub_id', 'currency', 'campaign_id')} as campaign,
              {title_sql(cap_sql('first_name') + " || ' ' || " + cap_sql('last_name'))} as donor_name
       from raw),
t1 as (select t0.*, row_number() over () as rk, {card_reference_sql('currency', 'campaign', 'campaign_id', 'amount')} as der,
              {tokens_sql('cb.des')}[1] as designation,
              case when len({tokens_sql('cb.app')}) >= 2 then {tokens_sql('cb.app')}[1] || ' ' || {tokens_sql('cb.app')}[2] end as appeal,
              'Braintree - ' || txn_id as ident, lower(email) as lemail,
              cast(settlement_date as date) as book_date
       from t0 left join cb on t0.campaign = cb.campaign_code),
crm as ({select_sql(CRM_EXPRS, 'customer')}),
recs0 as (
  select 'txn:' || cast(rk as varchar) as record_id, 'new' as side, donor_name as name, lemail as email, campaign, designation, appeal,
         'External Credit/Debit' as pay_type, 'Visa - ' || last_four as pay_method, book_date,
         cast(null as varchar) as constituent
  from t1
  union all
  select 'crm:' || cast(msnfp_transactionid as varchar), 'crm', msnfp_customeridname, emailaddress1,
         msnfp_originatingcampaignidname, msnfp_designationidname, msnfp_appealidname, msnfp_paymenttypecodename,
         msnfp_transaction_paymentmethodidname, msnfp_bookdate, msnfp_constituentnumber
  from crm),
{linkage_ctes(("pairs", "lam", "u", "tf", "scored"), recs)},
{BEST},
sch as (select * from schedules where name like '%Braintree%' and status <> '844060001'),
skey as (select *, case when regexp_extract(name, 'SubID: *([^ )]+)', 1) <> ''
                        then regexp_extract(name, 'SubID: *([^ )]+)', 1) else split_part(name, ' ', -1) end as key
         from sch),
bykey as (select key, min(name) as by_key from skey where contains(name, 'DIGI') group by key),
byname as (select lower(replace(customer, '#', ' ')) as cust, min(name) as by_name from sch group by all),
t2 as (select t1.*, case when contains(der, 'Braintree') and contains(der, 'RG') then sub_id end as join_on from t1),
t3 as (select t2.*, bykey.by_key from t2 left join bykey on t2.join_on = bykey.key),
t4 as (select t3.*, byname.by_name,
              exists (select 1 from skey where skey.key = t3.join_on) as key_exists
       from t3 left join byname on lower(t3.donor_name) = byname.cust and t3.by_key is null),
t5 as (select t4.*,
              case when coalesce(contains(der, 'Braintree'), false) and key_exists then {text_}
                   else coalesce(by_key, by_name) end as ps0,
              b.constituent_r as cons, b.match_probability as p
       from t4 left join best b on b.record_id_l = 'txn:' || cast(t4.rk as varchar) and b.rn = 1),
t6 as (select *, coalesce(contains(der, 'Braintree'), false) as card, not coalesce(contains(der, 'Braintree'), false) as not_card,
              case when coalesce(contains(der, 'Braintree'), false) and starts_with(ps0, 'DIGI AU') then (case {cc} else ps0 end)
                   else ps0 end as ps from t5)
select ident as "Identifier", book_date as "Book Date", case {cname} end as "Currency", ps as "Payment Schedule",
       join_on as "join_on_payschedID", cons as msnfp_constituentnumber, round(p, 6) as match_prob,
       case
         when card and ps is not null and join_on is not null and cons is not null and p < 0.7 then '{flags[0]}'
         when card and ps is null and join_on is null and cons is not null and p < 0.7 then '{flags[0]}'
         when card and ps is null and join_on is not null and cons is null and p is null then '{flags[1]}'
         when card and ps is null and join_on is not null and cons is not null and p < 0.7 then '{flags[2]}'
         when card and ps is null and join_on is not null and cons is not null and p >= 0.7 then '{flags[3]}'
         when card and ps is not null and cons is null and p is null then '{flags[4]}'
         when not_card and cons is not null and p < 0.7 then '{flags[0]}'
         when not_card and cons is null and p is null then '{flags[4]}'
         else '{RB.DEFAULT_FLAG}' end as donor_flagger,
       case when not (
              (card and ps is not null and join_on is not null and cons is not null and p < 0.7) or
              (card and ps is null and join_on is null and cons is not null and p < 0.7) or
              (card and ps is null and join_on is not null and cons is null and p is null) or
              (card and ps is null and join_on is not null and cons is not null and p < 0.7) or
              (card and ps is null and join_on is not null and cons is not null and p >= 0.7) or
              (card and ps is not null and cons is null and p is null) or
              (not_card and cons is not null and p < 0.7) or
              (not_card and cons is null and p is null))
            then (case when cons is not null and p is null then 'id_without_probability'
                       when cons is null and p >= 0.7 then 'probability_without_id'
                       when card and ps is null and join_on is null and cons is null and p is null then 'unmatched_one_off'
                  end) end as flag_reason
from t6"""


def oracle_queries() -> dict:
    return {"q30_action_flags": job_sql(CARD_FEED_EXPRS), "q32_repeated_identifiers": job_sql(REPEATING_FEED_EXPRS)}
