"""Brute-force SQL for the linkage queries (q19–q28), run by DuckDB.

Written independently of the Spark plans: pools by nested-loop
``contains``, λ and u from every pair of every pool, blocking as one OR
join, Jaro / Jaro–Winkler / Levenshtein from DuckDB's own functions.
"""

from __future__ import annotations

from ..config import LINK_COLUMNS, LinkageSettings

S = LinkageSettings()


def _d(x: float) -> str:
    return f"cast('{x!r}' as double)"


def level_sql(comp, l: str, r: str, eps: float = S.eps) -> str:
    top = comp.n_levels - 1
    parts = [f"when {l} is null or {r} is null then -1", f"when {l} = {r} then {top}"]
    for i, t in enumerate(comp.thresholds):
        if comp.metric == "levenshtein":
            parts.append(f"when levenshtein({l}, {r}) <= {int(t)} then {top - 1 - i}")
        else:
            fn = "jaro_similarity" if comp.metric == "jaro" else "jaro_winkler_similarity"
            parts.append(f"when {fn}({l}, {r}) >= {_d(t - eps)} then {top - 1 - i}")
    return "case " + " ".join(parts) + " else 0 end"


RECS = ("recs as (select record_id, side, "
        + ", ".join(f"nullif({c}, '') as {c}" for c in LINK_COLUMNS)
        + ", book_date, constituent from people)")

POOLS = """namepool as (
  select q.pool_id, r.record_id
  from (select distinct lower(name) as pool_id from recs where side = 'new' and name is not null) q
  join recs r on contains(lower(r.name), q.pool_id)),
sz as (select pool_id, count(*) as n from namepool group by pool_id),
single as (
  select distinct lower(a.name) as pool_id, lower(a.email) as em
  from recs a join sz on lower(a.name) = sz.pool_id
  where a.side = 'new' and sz.n = 1 and a.email is not null),
pools as (
  select pool_id, record_id, 'name' as via from namepool
  where pool_id not in (select pool_id from single)
  union all
  select s.pool_id, r.record_id, 'email' as via from single s join recs r on contains(lower(r.email), s.em)),
pm as (select p.pool_id, p.via, r.* from pools p join recs r on p.record_id = r.record_id)"""

ANY_RULE = " or ".join(f"a.{c} = m.{c}" for c in S.blocking_rules)
FIRST_RULE = "case " + " ".join(f"when a.{c} = m.{c} then {i}" for i, c in enumerate(S.blocking_rules)) + " end"


def _cols(prefix: str, suffix: str) -> str:
    return ", ".join(f"{prefix}.{c} as {c}_{suffix}" for c in LINK_COLUMNS)


SELF_ANCHORS = """anchors as (
  select r.*, lower(r.name) as pool_id from recs r where r.side = 'new' and r.name is not null)"""
LATEST_ANCHORS = """anchors as (
  select r.*, p.pool_id
  from (select pool_id, arg_max(record_id, (book_date is not null, book_date, -record_id)) as latest_id
        from pm group by pool_id) p join recs r on r.record_id = p.latest_id)"""
PAIRS = f"""pairs as (
  select a.pool_id, a.record_id as record_id_l, m.record_id as record_id_r, {_cols('a', 'l')}, {_cols('m', 'r')},
         m.constituent as constituent_r, {FIRST_RULE} as match_key
  from anchors a join pm m on m.pool_id = a.pool_id and m.side = 'crm' and m.record_id <> a.record_id
  where {ANY_RULE}),
gam as (
  select *, {", ".join(level_sql(c, c.column + "_l", c.column + "_r") + " as gamma_" + c.column for c in S.comparisons)}
  from pairs)"""


def _lam_cte(recall: float = S.recall) -> str:
    det = " or ".join(f"l.{c} = r.{c}" for c in S.deterministic_rules)
    return f"""lam as (
  select pool_id, n, pairs, hit_pairs,
         case when pairs > 0 then greatest(cast(1 as double) / (pairs + 1),
              least(hit_pairs / pairs / {_d(recall)}, pairs / (pairs + 1))) end as lam
  from (select s.pool_id, s.n, s.n * (s.n - 1) // 2 as pairs, coalesce(h.hit, 0) as hit_pairs
        from (select pool_id, count(*) as n from pm group by pool_id) s
        left join (select l.pool_id, count(*) as hit from pm l join pm r
                   on l.pool_id = r.pool_id and l.record_id < r.record_id
                   where {det} group by l.pool_id) h on s.pool_id = h.pool_id))"""


def _u_ctes() -> str:
    cols = ", ".join(f"l.{c.column} as {c.column}_l, r.{c.column} as {c.column}_r" for c in S.comparisons)
    lv = "\n  union all ".join(
        f"select pool_id, '{c.column}' as \"column\", {level_sql(c, c.column + '_l', c.column + '_r')} as level from allpairs"
        for c in S.comparisons)
    grid = ", ".join(f"('{c.column}', {i}, {c.n_levels - 1}, {_d(S.u_defaults(c)[-1] if i == c.n_levels - 1 else S.u_defaults(c)[0])})"
                     for c in S.comparisons for i in range(c.n_levels))
    return f"""allpairs as (select l.pool_id, {cols} from pm l join pm r on l.pool_id = r.pool_id and l.record_id < r.record_id),
lv as ({lv}),
cnt as (select pool_id, "column", level, count(*) as n from lv where level >= 0 group by all),
tot as (select pool_id, "column", sum(n) as total from cnt group by all),
grid(gcol, glevel, gtop, gdefault) as (values {grid}),
ulong as (
  select p.pool_id, g.gcol as "column", g.glevel as level, cast(coalesce(c.n, 0) as bigint) as pairs,
         cast(coalesce(t.total, 0) as bigint) as total,
         case when coalesce(c.n, 0) > 0 then c.n / t.total else g.gdefault end as u
  from (select distinct pool_id from pm) p cross join grid g
  left join tot t on t.pool_id = p.pool_id and t."column" = g.gcol
  left join cnt c on c.pool_id = p.pool_id and c."column" = g.gcol and c.level = g.glevel)"""


def _tf_cte() -> str:
    tcols = [c.column for c in S.comparisons if c.term_frequency]
    melt = "\n  union all ".join(f"select pool_id, '{c}' as \"column\", {c} as v from pm where {c} is not null" for c in tcols)
    return f"""tfm as ({melt}),
tf as (select pool_id, "column", v, count(*) as n,
              sum(count(*)) over (partition by pool_id, "column") as total,
              count(*) / sum(count(*)) over (partition by pool_id, "column") as tf
       from tfm group by pool_id, "column", v)"""


def _weight_sql() -> str:
    terms = ["log2(lam / (1 - lam))"]
    for c in S.comparisons:
        g = f"gamma_{c.column}"
        m = S.m_values(c)
        mcase = "case " + " ".join(f"when {g} = {i} then {_d(m[i])}" for i in range(c.n_levels)) + " end"
        ucase = "case " + " ".join(f"when {g} = {i} then u_{c.column}_{i}" for i in range(c.n_levels)) + " end"
        terms.append(f"(case when {g} < 0 then 0 else log2(({mcase}) / ({ucase})) end)")
        if c.term_frequency:
            top = c.n_levels - 1
            terms.append(f"(case when {g} = {top} then log2(u_{c.column}_{top} / tf_{c.column}) else 0 end)")
    return " + ".join(terms)


def _scored_ctes() -> str:
    uw = ", ".join(f"max(case when \"column\" = '{c.column}' and level = {i} then u end) as u_{c.column}_{i}"
                   for c in S.comparisons for i in range(c.n_levels))
    tcols = [c.column for c in S.comparisons if c.term_frequency]
    tfj = "\n  ".join(f"left join tf tf_{c} on tf_{c}.pool_id = g.pool_id and tf_{c}.\"column\" = '{c}' and tf_{c}.v = g.{c}_l"
                      for c in tcols)
    tfs = ", ".join(f"tf_{c}.tf as tf_{c}" for c in tcols)
    sq = "lower(replace({}, ' ', ''))"
    return f"""uwide as (select pool_id, {uw} from ulong group by pool_id),
withp as (
  select g.*, l.lam, uw.* exclude (pool_id), {tfs}
  from gam g join lam l on l.pool_id = g.pool_id join uwide uw on uw.pool_id = g.pool_id
  {tfj}),
scored as (
  select *, {_weight_sql()} as match_weight,
         coalesce({sq.format('name_l')} = {sq.format('name_r')}, false) as name_ok,
         coalesce({sq.format('email_l')} = {sq.format('email_r')}, false) as email_ok
  from withp),
scored2 as (select *, 1 / (1 + pow(2, -match_weight)) as match_probability from scored)"""


def linkage_ctes(parts: tuple, recs: str = RECS, anchors: str = SELF_ANCHORS) -> str:
    """The CTE chain (without WITH) from linkage records to scored pairs."""
    ctes = [recs, POOLS]
    if "pairs" in parts:
        ctes += [anchors, PAIRS]
    if "lam" in parts:
        ctes.append(_lam_cte())
    if "u" in parts:
        ctes.append(_u_ctes())
    if "tf" in parts:
        ctes.append(_tf_cte())
    if "scored" in parts:
        ctes.append(_scored_ctes())
    return ",\n".join(ctes)


BEST = """best as (
  select pool_id, record_id_l, match_probability, match_weight, constituent_r, record_id_r,
         row_number() over (partition by pool_id, record_id_l
                            order by name_ok desc, round(match_weight, 9) desc, record_id_r) as rn
  from scored2 where name_ok or email_ok)"""


def with_linkage(body: str, parts: tuple, anchors: str = SELF_ANCHORS) -> str:
    from .views import with_views
    return with_views("with " + linkage_ctes(parts, anchors=anchors) + "\n" + body, "people")


R6 = 6


def oracle_queries() -> dict:
    q = {}
    q["q19_candidates"] = with_linkage(f"""
select a.record_id as anchor_id, r.record_id,
       coalesce(contains(lower(r.name), lower(a.name)), false) as by_name,
       coalesce(lower(r.email) = lower(a.email), false) as by_email
from recs a join recs r on a.side = 'new' and r.side = 'crm'
 and (contains(lower(r.name), lower(a.name)) or lower(r.email) = lower(a.email))""", ())
    q["q20_containment_pools"] = with_linkage("""
select n.pool_id, n.record_id, r.side from namepool n join recs r on n.record_id = r.record_id""", ())
    q["q21_pool_sizes"] = with_linkage("""
select pool_id, via, count(*) as n from pools group by pool_id, via""", ())
    q["q22_comparison_vectors"] = with_linkage(f"""
select record_id_l, record_id_r, match_key, {", ".join("gamma_" + c.column for c in S.comparisons)} from gam""", ("pairs",))
    rules = ", ".join(f"({i}, '{c}')" for i, c in enumerate(S.blocking_rules))
    q["q23_global_blocking"] = with_linkage(f"""
select k.match_key, k.rule, cast(count(*) as bigint) as pairs
from (select case {" ".join(f"when a.{c} = m.{c} then {i}" for i, c in enumerate(S.blocking_rules))} end as match_key
      from recs a join recs m on a.record_id < m.record_id where {ANY_RULE}) p
join (values {rules}) k(match_key, rule) on k.match_key = p.match_key
group by k.match_key, k.rule""", ())
    q["q24_pool_anchor"] = with_linkage("""
select pool_id, count(*) as n,
       arg_max(record_id, (book_date is not null, book_date, -record_id)) as latest_id,
       arg_max(side, (book_date is not null, book_date, -record_id)) as latest_side
from pm group by pool_id""", ())
    q["q25_lambda"] = with_linkage(f"""
select pool_id, n, pairs, hit_pairs, round(lam, 9) as lam from lam""", ("lam",))
    q["q26_u_tf"] = with_linkage(f"""
select pool_id, 'u' as kind, "column", cast(level as varchar) as item, pairs as n, total, round(u, 9) as share from ulong
union all
select pool_id, 'tf' as kind, "column", v as item, cast(n as bigint) as n, cast(total as bigint) as total, round(tf, 9) as share from tf""",
                                 ("u", "tf"))
    q["q27_scores"] = with_linkage(f"""
select record_id_l, record_id_r, match_key, round(match_weight, {R6}) as match_weight,
       round(match_probability, {R6}) as match_probability, name_ok, email_ok from scored2""",
                                   ("pairs", "lam", "u", "tf", "scored"))
    q["q28_best_match"] = with_linkage(f"""
, {BEST}
select n.record_id, round(b.match_probability, {R6}) as match_probability, round(b.match_weight, {R6}) as match_weight,
       b.constituent_r as constituent, b.record_id_r as matched_record_id
from recs n left join best b on b.record_id_l = n.record_id and b.rn = 1
where n.side = 'new'""", ("pairs", "lam", "u", "tf", "scored"))
    q["q31_latest_anchor"] = with_linkage(f"""
, {BEST}
select n.record_id, round(b.match_probability, {R6}) as match_probability, round(b.match_weight, {R6}) as match_weight,
       b.constituent_r as constituent, b.record_id_r as matched_record_id
from recs n left join best b on b.pool_id = lower(n.name) and b.rn = 1
where n.side = 'new'""", ("pairs", "lam", "u", "tf", "scored"), LATEST_ANCHORS)
    q["q34_pool_order"] = with_linkage("""
select pool_id, record_id,
       row_number() over (partition by pool_id order by book_date desc nulls last, record_id) - 1 as row_no from pm""", ())
    return q
