import random

import duckdb
from pyspark.sql import functions as F

from conftest import SF0001
from giftlink.plans import queries_job, rulebook, views
from giftlink.plans.linkage import Linkage
from giftlink.plans.oracle_linkage import BEST, RECS, linkage_ctes


def test_one_row_per_transaction_and_flags_exhaustive(spark):
    out = queries_job.q30_action_flags(spark, SF0001)
    n_in = views.donations(spark, SF0001).count()
    rows = out.collect()
    assert len(rows) == n_in
    assert len({r["Identifier"] for r in rows}) == n_in
    allowed = set(rulebook.FLAGS) | {rulebook.DEFAULT_FLAG}
    assert {r["donor_flagger"] for r in rows} <= allowed
    assert all(r["flag_reason"] is None or r["donor_flagger"] == rulebook.DEFAULT_FLAG for r in rows)


def _skewed_people(n=1500, seed=1):
    """A third of all records contain one short name ('ann'); the rest are
    spread over many names."""
    random.seed(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            name = random.choice(["ann", "anna lee", "joanne", "ann smith", "dianne"])
        else:
            name = f"person {i % 97} {random.choice(['x', 'y'])}"
        side = "new" if i % 25 == 0 else "crm"
        rows.append((i, name, None if i % 4 == 0 else f"{name.replace(' ', '.')}{i % 3}@ex.org",
                     f"C{i % 5}", f"D{i % 7}", f"A{i % 3}", f"T{i % 2}", f"M{i % 11}",
                     None, side, None if side == "new" else str(i)))
    return rows


SCHEMA = ("record_id long, name string, email string, campaign string, designation string, appeal string, "
          "pay_type string, pay_method string, book_date date, side string, constituent string")


def test_hot_pool_matches_brute_force(spark):
    rows = _skewed_people()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["record_id"]: (None if r["match_probability"] is None else round(r["match_probability"], 6),
                            r["constituent"])
           for r in Linkage.build(df).best().collect()}
    con = duckdb.connect()
    con.execute(f"create table people ({SCHEMA.replace(' long', ' bigint')})")
    con.executemany("insert into people values (" + ",".join("?" * 11) + ")", rows)
    sql = ("with " + linkage_ctes(("pairs", "lam", "u", "tf", "scored"), RECS) + ",\n" + BEST +
           "\nselect n.record_id, round(b.match_probability, 6), b.constituent_r from recs n "
           "left join best b on b.record_id_l = n.record_id and b.rn = 1 where n.side = 'new'")
    want = {r[0]: (r[1], r[2]) for r in con.sql(sql).fetchall()}
    assert got == want
    # the hot pool really is a third of the data
    pools = {r["pool_id"]: r["n"] for r in Linkage.build(df).members.groupBy("pool_id")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert pools["ann"] >= len(rows) // 3


def test_run_with_crm_indexes_equals_without(spark, tmp_path):
    from giftlink.plans import pipeline
    from giftlink.plans.queries_ingest import AS_OF, _schedules
    d = SF0001
    crm = queries_job.crm_transactions(spark, d)
    idx = pipeline.build_crm_indexes(crm, str(tmp_path / "crm-index"))

    def go(indexes):
        out = pipeline.run({"card": queries_job.card_feed(spark, d)}, queries_job.codes(spark, d),
                           _schedules(spark, d), crm, queries_job.accounts(spark, d), AS_OF, indexes=indexes)
        return sorted(tuple(r) for r in out.select("Identifier", "msnfp_constituentnumber", "match_prob",
                                                    "donor_flagger").collect())

    assert go(idx) == go(None)


def test_three_months_in_one_run_equal_three_runs(spark, tmpdir_path):
    import datetime as dt
    import os

    from giftlink.operators import project
    from giftlink.plans import pipeline
    from giftlink.sources import readers, schemas
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    karma = ",".join(f.name for f in schemas.KARMA.fields)
    trust = ",".join(f.name for f in schemas.UK_TRUST.fields)
    for i, m in enumerate([*months, dt.date(2024, 4, 1)]):
        for feed, head, rows in (
                ("karma", karma, [f"{m:%Y-%m}-0{k + 1},{10 + k}.5,Site,{'Payroll Giving' if k % 2 else 'Other'},Monthly,Customer,"
                                  f"{k + 1:09d},Customer.{k + 1:09d}@Example.org,nsw,1 St,Town,800,K{i}-{k}" for k in range(5)]
                 + [f"2024-{m.month + 1:02d}-0{m.month},1.0,S,Other,M,A,B,e@x,nsw,1 St,Town,800,K{i}-f"]),
                ("uk_trust", trust, [",".join("5" if f.name.startswith("Total") else f"{f.name[:3]}{i}" for f in schemas.UK_TRUST.fields)])):
            path = os.path.join(tmpdir_path, feed, readers.period_folder(m), "x.csv")
            os.makedirs(os.path.dirname(path))
            with open(path, "w") as f:
                f.write("\n".join([head, *rows]) + "\n")
    schema = {"karma": schemas.KARMA, "uk_trust": schemas.UK_TRUST}
    rest = (queries_job.codes(spark, SF0001), queries_job.schedules(spark, SF0001), queries_job.crm_transactions(spark, SF0001),
            queries_job.accounts(spark, SF0001))
    scan = {k: readers.read_months(spark, tmpdir_path, k, months, v) for k, v in schema.items()}
    assert {r[0] for r in scan["karma"].select("_period").distinct().collect()} == set(months)
    assert not any("April" in f for f in scan["karma"].inputFiles())
    once = pipeline.run_months(scan, *rest, months)
    each = None
    for m in months:
        one = pipeline.run({k: readers.read_period(spark, tmpdir_path, k, m, v) for k, v in schema.items()}, *rest,
                           (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1))
        one = one.withColumn("period", F.lit(m))
        each = one if each is None else project.union_feeds(each, one)
    cols = sorted(each.columns)
    assert sorted(once.columns) == cols
    got, want = (sorted(map(tuple, df.select(*[f"`{c}`" for c in cols]).collect()), key=str) for df in (once, each))
    assert got == want and len(got) == 21
    assert {r["Data Entry Reference"][-17:] for r in once.collect()} == {"20240101_20240131", "20240201_20240229",
                                                                         "20240301_20240331"}
