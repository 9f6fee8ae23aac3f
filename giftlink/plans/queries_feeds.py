"""q33: the five feeds beside the card gateway (N2–N6), as exports derived
from the donations view, through the normalisers, the union, cleaning and the
anonymous defaults. ``FEED_SQL`` is the DuckDB side, written from the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import schemas
from . import pipeline, views
from . import rulebook as RB
from .queries_ingest import AS_OF, STAMP

K = "cast(txn_id as bigint)"
FIRST, LAST = "split_part(donor, '#', 1)", "split_part(donor, '#', 2)"
# Raw exports: one expression per declared column, in the schema's order.
EXPORTS = {
    "employer": (schemas.EMPLOYER, [
        f"'Employer ' || cast({K} % 7 as varchar(9))",
        f"case when {K} % 3 = 0 then 'Not shared by donor' else {FIRST} end",
        f"case when {K} % 3 = 0 then 'Not shared by donor' else {LAST} end",
        "'Gift.' || txn_id || '@Example.org'", f"case when {K} % 3 = 0 then 'Not Shared By Donor' else '1 Main St' end",
        "'Town'", "'NSW'", f"case when {K} % 2 = 0 then '800' else '2000.0' end", "txn_id",
        f"case {K} % 3 when 0 then 'One Time' when 1 then 'Recurring' else 'Other' end", "currency",
        f"case {K} % 4 when 0 then 'n/a' when 1 then '$1,' || lpad(cast({K} % 1000 as varchar(9)), 3, '0') || '.50'"
        f" else cast({K} % 1000 as varchar(9)) end",
        f"cast(case when {K} % 2 = 0 then 0 else 50 end as double)"]),
    "workplace": (schemas.WORKPLACE, [
        f"cast({K} % 900 as double)", FIRST, LAST, f"'$' || cast({K} % 500 as varchar(9)) || '.25'", "'Acme'", "null",
        f"case {K} % 4 when 0 then 'Workplace Giving' when 1 then 'Employer Matched' when 2 then 'Match' else 'Gift' end",
        f"case when {K} % 11 = 0 then null else txn_id end"]),
    "karma": (schemas.KARMA, [
        "cast(book_date as varchar(10))", "amount", "'Site'",
        f"case {K} % 3 when 0 then 'Payroll Giving' when 1 then 'Matched Giving' else 'Other' end", "'Monthly'",
        FIRST, LAST, "'K@x.org'", "'vic'", "'2 High St'", "'Suburb'", "'3000'", "txn_id"]),
    "uk_trust": (schemas.UK_TRUST, [
        "txn_id", "'Firm'", FIRST, LAST, "'u@x.org'", "'0412 345 678'", "'A1'", "'A2'", "'A3'", "'SW1A 1AA'",
        f"case when {K} % 2 = 0 then 'Yes' else 'No' end", "'No'", "'No'", "null", "amount"]),
    "insight": (schemas.INSIGHT, [
        "book_date", "book_date", "'W' || txn_id", f"cast({K} % 40 as varchar(9))", FIRST, LAST, "'3 Low Rd'", "'Sub'",
        "'QLD'", f"cast({K} % 9000 as varchar(9))", "'0412345678'", "'I@X.org'", "amount", "'Card'"]),
}
COLUMNS = ["Identifier", "Transaction ID", "Donor", "Organization Name", "Amount", "Currency", "Email",
           "Originating Campaign", "Primary Designation", "Appeal", "Package", "Payment Type", "Data Entry Source",
           "Data Entry Reference", "Ref", "State/Province", "ZIP/Postal Code", "Phone", "Country/Region",
           "Status Reason", "Book Date", "Donor Preference Post"]


def exports(spark, sf_dir) -> dict:
    d = views.donations(spark, sf_dir)
    return {name: d.select(*[F.expr(e).cast(f.dataType).alias(f.name) for f, e in zip(schema.fields, exprs)])
            for name, (schema, exprs) in EXPORTS.items()}


def q33_other_feeds(spark, sf_dir):
    out = pipeline.transactions(exports(spark, sf_dir), None, AS_OF)
    return out.select(*[F.round(F.col(f"`{k}`"), 6).alias(k) if k == "Amount" else F.col(f"`{k}`") for k in COLUMNS])


QUERIES = {"q33_other_feeds": q33_other_feeds}


def _q(s) -> str:
    return "null" if s is None else "'" + str(s).replace("'", "''") + "'"


def feed_sql() -> str:
    """One select per feed with the columns of ``COLUMNS``, then P1 and P2."""
    from .oracle_ingest import cap_sql, title_sql

    def raw(name):
        schema, exprs = EXPORTS[name]
        return "(select " + ", ".join(f'{e} as "{f.name}"' for f, e in zip(schema.fields, exprs)) + " from donations)"

    def name_of(a, b):
        return title_sql(cap_sql(f'"{a}"') + " || ' ' || " + cap_sql(f'"{b}"'))

    def hidden(x):
        return f"coalesce(contains(lower({x}), 'not shared'), false)"

    def money(x):
        return f"try_cast(replace(replace({x}, ',', ''), '$', '') as double)"

    E, W, KC, U, I = RB.EMPLOYER, RB.WORKPLACE, RB.KARMA, RB.UK_TRUST, RB.INSIGHT

    def by_freq(i):
        return "case " + " ".join(f""""Donation Frequency" = '{k}' then {_q(E[k][i])}""".join(("when ", ""))
                                  for k in ("One Time", "Recurring")) + " end"

    def matched(i):
        kinds = ", ".join(map(_q, KC["matched_types"]))
        return f'case when "Type" in ({kinds}) then {_q(KC["matched"][i])} else {_q(KC["other"][i])} end'

    full = name_of("Donor First Name", "Donor Last Name")
    giver = 'cast(cast("Good2Give Donor Id" as bigint) as varchar)'
    feeds = {
        "employer": {
            "Identifier": f"""{_q(E['identifier'])} || "Transaction ID\"""", "Transaction ID": '"Transaction ID"',
            "Donor": f"""case when {hidden(full)} then "Company" || ' (Anonymous Employee)' else {full} end""",
            "Organization Name": '"Company"', "Currency": '"Currency"', "Email": '"Email"',
            "Amount": money('"Total Donation to be Acknowledged"') + ' + "Match Amount"',
            "Originating Campaign": by_freq(0), "Primary Designation": by_freq(1), "Appeal": by_freq(2),
            "Package": _q(E["Package"]), "Payment Type": _q(E["Payment Type"]),
            "Data Entry Source": _q(E["Data Entry Source"]), "Data Entry Reference": _q(f"{E['reference']} {STAMP}"),
            "Ref": f"""case when "Match Amount" = 0 then {_q(E['reference'])} else {_q(E['reference'] + ' - ')} || "Company"
                       || ' ' || "Currency" || ' ' || cast("Match Amount" as varchar) || {_q(E['matched'])} end""",
            "State/Province": '"State/Province"', "ZIP/Postal Code": '"Postal Code"'},
        "workplace": {
            "Identifier": f"""{_q(W['identifier'])} || "Donation Confirmation Number\"""",
            "Transaction ID": '"Donation Confirmation Number"', "Donor": name_of("Donor Firstname", "Donor Lastname"),
            "Organization Name": '"Employer Name"', "Email": '"Donor Email"',
            "Amount": "cast(0.95 as double) * " + money('"Donation Amount"'),
            **{k: _q(W[k]) for k in ("Currency", "Originating Campaign", "Primary Designation", "Appeal", "Payment Type",
                                     "Data Entry Source")},
            "Data Entry Reference": _q(f"{W['reference']} {STAMP}"),
            "Ref": f"""case when "Donation Type" = {_q(W['giving'])} then {_q(W['ref'])} || {giver}
                       when "Donation Type" in ({', '.join(map(_q, W['matched_types']))})
                       then {_q(W['ref'])} || {giver} || {_q(W['matched'])} end"""},
        "karma": {
            "Identifier": f"""{_q(KC['identifier'])} || "Transaction Reference\"""", "Transaction ID": '"Transaction Reference"',
            "Donor": name_of("First Name", "Last Name"), "Organization Name": '"Site"', "Amount": '"Amount"',
            "Email": '"Email"', "Originating Campaign": matched(0), "Primary Designation": matched(1), "Appeal": matched(2),
            **{k: _q(KC[k]) for k in ("Payment Type", "Package", "Data Entry Source", "Currency")},
            "Data Entry Reference": _q(f"{KC['reference']} {STAMP}"), "Ref": '"Transaction Reference"',
            "State/Province": 'upper("State")', "ZIP/Postal Code": '"Post Code"', "Book Date": 'cast("Date" as date)'},
        "uk_trust": {
            "Identifier": f"""{_q(U['identifier'])} || "PGA Donor Ref Number\"""", "Transaction ID": '"PGA Donor Ref Number"',
            "Donor": name_of("First Name", "Last Name"), "Organization Name": '"Employer Name"',
            "Amount": '"Total Donation to Charity"', "Email": '"Donor Email"', "Phone": '"Donor Tel No"',
            **{k: _q(U[k]) for k in ("Currency", "Originating Campaign", "Primary Designation", "Appeal", "Package",
                                     "Payment Type", "Data Entry Source")},
            "Data Entry Reference": _q(f"{U['reference']} {STAMP}"), "Ref": f"""{_q(U['ref'])} || "PGA Donor Ref Number\"""",
            "ZIP/Postal Code": '"Postcode"', "Donor Preference Post": '"Donor Preference Post"'},
        "insight": {
            "Identifier": f"""{_q(I['identifier'])} || "Customer Id\"""", "Donor": name_of("First name", "SurName"),
            "Amount": '"Donation Value $"', "Email": '"Email Address"', "Phone": '"Telephone"',
            **{k: _q(I[k]) for k in ("Currency", "Originating Campaign", "Primary Designation", "Appeal", "Package",
                                     "Payment Type", "Data Entry Source", "Ref", "Country/Region")},
            "Data Entry Reference": f"""{_q(I['reference'])} || strftime("Week Ending", '%Y%m%d')""",
            "State/Province": '"State"', "Book Date": '"Bank Date"',
            "ZIP/Postal Code": """case when length("Post Code") < 4 then '0' || "Post Code" else "Post Code" end"""},
    }
    types = {"Amount": "double", "Book Date": "date"}
    parts = []
    for name, cols in feeds.items():
        body = ", ".join(f'cast({cols.get(k, "null")} as {types.get(k, "varchar")}) as "{k}"' for k in COLUMNS
                         if k != "Status Reason")
        where = ' where "Donation Confirmation Number" is not null' if name == "workplace" else ""
        parts.append(f"select {body} from {raw(name)}{where}")
    every = "\nunion all\n".join(parts)
    country = " ".join(f'when "Currency" = {_q(k)} then {_q(v)}' for k, v in RB.COUNTRY.items())
    all_null = ('"Donor" is null and "Primary Designation" is null and "Originating Campaign" is null'
                ' and "Appeal" is null')
    fill = {k: " ".join(f'when {all_null} and "Currency" = {_q(cur)} then {_q(v[i])}' for cur, v in RB.ANONYMOUS.items())
            for i, k in enumerate(("Primary Designation", "Originating Campaign", "Appeal"))}
    fill["Donor"] = " ".join(f'when "Donor" is null and "Currency" = {_q(cur)} then {_q(v[3])}'
                             for cur, v in RB.ANONYMOUS.items())
    digits = 'try_cast("ZIP/Postal Code" as double)'
    special = {
        "Amount": 'round("Amount", 6)', "Email": 'lower("Email")',
        "Phone": """'0' || cast(try_cast(replace("Phone", ' ', '') as bigint) as varchar)""",
        "Country/Region": f'case {country} else "Country/Region" end',
        "Status Reason": """case when "Amount" < 0 then 'Refund' else 'Completed' end""",
        "ZIP/Postal Code": f"""case when "Currency" = 'GBP' then "ZIP/Postal Code" when {digits} = floor({digits})
            then (case when length(cast(cast({digits} as bigint) as varchar)) < 4 then '0' else '' end)
                 || cast(cast({digits} as bigint) as varchar) end""",
        **{k: f'case {v} else "{k}" end' for k, v in fill.items()}}
    return f"with donations as ({views.DONATIONS_SQL}), feed as (\n{every})\nselect " + ", ".join(
        f'{special.get(k, chr(34) + k + chr(34))} as "{k}"' for k in COLUMNS) + " from feed"


def oracle_queries() -> dict:
    return {"q33_other_feeds": feed_sql()}
