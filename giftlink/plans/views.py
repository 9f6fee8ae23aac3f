"""Views over TESTDATA that stand in for the feeds and the CRM.

The reference's own exports are not available, so the acceptance queries
run on views derived from the given tables. Each view is one list of SQL
expressions: Spark evaluates it with ``selectExpr`` and the DuckDB oracle
gets the same text as a CTE, so both engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

PEOPLE_EXPRS = [
    "p_partkey as record_id",
    "case when p_partkey % 60 = 0 then upper(substring(p_name, position(' ' in p_name)+1))"
    " when p_partkey % 100 = 20 then replace(p_name, 'e', 'ei') || 's' else p_name end as name",
    "case when p_partkey % 11 = 0 then null"
    " else replace(p_name,' ','.') || cast(p_partkey % 5 as varchar(9)) || '@example.org' end as email",
    "p_brand as campaign",
    "p_type || '-' || cast(p_size % 7 as varchar(9)) as designation",
    "'A' || cast(p_size % 5 as varchar(9)) as appeal",
    "p_type as pay_type",
    "'card' || cast(p_partkey % 13 as varchar(9)) as pay_method",
    "date '2024-01-01' + cast(p_partkey % 365 as int) as book_date",
    "case when p_partkey % 20 = 0 then 'new' else 'crm' end as side",
    "case when p_partkey % 20 = 0 then null else cast(p_partkey as varchar(9)) end as constituent",
]

DONATIONS_EXPRS = [
    "cast(o_orderkey as varchar(20)) as txn_id",
    "c_name as donor",
    "case c_nationkey % 4 when 0 then 'AUD' when 1 then 'NZD' when 2 then 'GBP' else 'CAD' end as currency",
    "case when o_orderkey % 3 = 0 then 'S' || cast(o_custkey as varchar(20)) end as sub_id",
    "case when o_orderkey % 7 = 0 then -o_totalprice else o_totalprice end as amount",
    "case o_orderpriority when '1-URGENT' then 'tax23' when '2-HIGH' then 'xmas23' end as campaign_id",
    "cast(o_orderdate as date) as book_date",
]

SCHEDULES_EXPRS = [
    "c_custkey",
    "c_name as customer",
    "'DIGI AU Braintree (SubID: S' || cast(c_custkey as varchar(20)) || ' )' as name",
    "case when c_nationkey = 3 then '844060001' when c_nationkey = 4 then null else '1' end as status",
]
# donors of these segments give regularly
SCHEDULES_WHERE = "c_mktsegment in ('BUILDING', 'MACHINERY')"

# Code book: one row per nation in file (key) order. Campaign ids repeat
# (first row wins), one of the eight card campaigns is absent, and some
# appeals have a single token.
CODES_EXPRS = [
    "n_nationkey as ordinal",
    "case n_nationkey % 9 when 0 then 'AUSG-DGAQ-HR' when 1 then 'NZSG-DGAQ-HR' when 2 then 'UKSG-DGAQ-HR'"
    " when 3 then 'AURG-DGAQ-HR' when 4 then 'NZRG-DGAQ-HR' when 5 then 'UKRG-DGAQ-HR'"
    " when 6 then 'AUSG-DMRN-HR-2302-D1' when 7 then 'NOT-A-CARD-CAMPAIGN' else 'AUSG-DMRN-HR-2304-W2' end"
    " as campaign_code",
    "'FA-' || upper(r_name) || '-' || cast(n_nationkey as varchar(9)) || ' (GL ' || n_name || ')' as designation_code",
    "case when n_nationkey % 5 = 0 then r_name else 'SG ' || n_name || ' ' || r_name end as appeal_code",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(*PEOPLE_EXPRS)


def donations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(*DONATIONS_EXPRS)


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").where(SCHEDULES_WHERE).selectExpr(*SCHEDULES_EXPRS)


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).selectExpr(*CODES_EXPRS)


def sql(exprs: list, frm: str, where: str | None = None) -> str:
    text = "select " + ",\n  ".join(exprs) + f"\nfrom {frm}"
    return text + (f"\nwhere {where}" if where else "")


PEOPLE_SQL = sql(PEOPLE_EXPRS, "part")
DONATIONS_SQL = sql(DONATIONS_EXPRS, "orders join customer on o_custkey = c_custkey")
SCHEDULES_SQL = sql(SCHEDULES_EXPRS, "customer", SCHEDULES_WHERE)
CODES_SQL = sql(CODES_EXPRS, "nation join region on n_regionkey = r_regionkey")

VIEW_SQL = {"people": PEOPLE_SQL, "donations": DONATIONS_SQL, "schedules": SCHEDULES_SQL,
            "codes": CODES_SQL}


def with_views(body: str, *names: str) -> str:
    """Prefix an oracle query with the view CTEs it uses."""
    ctes = ",\n".join(f"{n} as (\n{VIEW_SQL[n]}\n)" for n in names)
    if not names:
        return body
    b = body.lstrip()
    if b[:5].lower() == "with ":
        return f"with {ctes},\n{b[5:]}"
    return f"with {ctes}\n{b}"
