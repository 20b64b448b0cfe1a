"""Independent SQL for every query, in the plain range-join and window form.

Each statement is put together from named subqueries; only those it reaches are
included.
"""

from __future__ import annotations

import re
from itertools import combinations

from offerloom.operators.features import CANDIDATES, FEATURES
from offerloom.plans.settings import (
    AUDIT_ACTION,
    AUDIT_USER,
    CATALOG_CUT,
    DRIFT_COLUMNS,
    DRIFT_RUNS,
    EARLIER,
    OFFER_VALUES,
    RUN_TS,
    SCENARIO_OVERRIDE,
    SCENARIO_SHIFT,
    SNAPSHOT_RUNS,
    SPEND_LIMIT,
    UNKNOWN_SHIFT,
)
from offerloom.sources.controls import BUDGET_ROWS, CATALOG_ROWS
from offerloom.sources.fixtures import AS_OF

NOW = f"timestamp '{AS_OF}'"


def _values(rows, names):
    body = ", ".join("(" + ", ".join(repr(v) if not isinstance(v, bool) else str(v).lower() for v in r) + ")" for r in rows)
    return f"select * from (values {body}) v({names})"


def _uniform(text):
    return f"(('0x' || substr(md5({text}), 1, 8))::bigint / 4294967296.0::double)"


def _z(kind, level, recency, expiring, missions):
    return f"""(-1.2::double + 0.45::double * {level}
      + case {kind} when 'cashback' then 0.5::double when 'bonus' then 0.2::double
          when 'discount' then 0.05::double when 'mission' then -0.2::double else 0::double end
      + (-0.004::double) * least({recency}, 365)
      + 0.0026::double * least({expiring}, 500) * case {kind} when 'mission' then 0.3::double else 1.6::double end
      + 0.15::double * {missions})"""


def _p(kind, level, recency, expiring, missions, customer="customer_id"):
    own = f"0.8::double * {_uniform(f'{customer}::varchar || chr(58) || {kind}')}"
    return f"round(1.0::double / (1.0::double + exp(-({_z(kind, level, recency, expiring, missions)} + {own}))), 6)"


def _half_up(num, den, digits):
    """round(num / den, digits) by integer arithmetic, halves up."""
    k = 10**digits
    return f"((2 * {k} * {num} + {den}) // (2 * {den}))::double / {k}"


def _age(anchor, last):
    return f"date_diff('day', {last}::date, {anchor}::date)::int"


def _grid_scores(source):
    """Scored grid over a relation with features per customer."""
    p = _p("k.offer_type", "l.level", "b.days_since_redemption", "b.points_expiring_30d", "b.missions_30d", "b.customer_id")
    return f"""select b.*, k.offer_type, k.active, l.level, (k.base_cost * l.level)::int as cost, {p} as p_accept
      from {source} b cross join catalog k cross join levels l"""


def _features_at(at):
    """Features of every customer at one instant, straight from the logs."""
    return f"""select c.customer_id,
      (select count(*) from redemptions e where e.customer_id = c.customer_id and e.ts <= {at}) as redemptions_total,
      (select count(*) from redemptions e where e.customer_id = c.customer_id and e.ts <= {at}
         and e.ts > {at} - interval 60 day) as redemptions_60d,
      (select count(*) from redemptions e where e.customer_id = c.customer_id and e.ts <= {at}
         and e.ts > {at} - interval 90 day) as redemptions_90d,
      coalesce((select sum(points) from credits e where e.customer_id = c.customer_id and e.credit_ts <= {at}), 0)::bigint
         as points_accumulated,
      coalesce((select sum(points) from credits e where e.customer_id = c.customer_id and e.credit_ts <= {at}
         and e.expiry_ts > {at} and e.expiry_ts <= {at} + interval 30 day), 0)::bigint as points_expiring_30d,
      (select count(*) from missions e where e.customer_id = c.customer_id and e.ts <= {at}
         and e.ts > {at} - interval 30 day) as missions_30d,
      coalesce((select {_age(at, 'max(ts)')} from redemptions e where e.customer_id = c.customer_id and e.ts <= {at}), 999)::int
         as days_since_redemption
      from customers c"""


def _pit(spine, ts, columns):
    """Last feature row at or before each spine row."""
    cols = ", ".join(f"f.{c}" for c in columns)
    return f"""select s.*, f.ts as feature_ts, {cols}
      from {spine} s asof left join features f on s.customer_id = f.customer_id and s.{ts} >= f.ts"""


def _known(prefix):
    """Looked-up features with their defaults."""
    return ", ".join(f"coalesce({prefix}.{c}, {999 if c.startswith('days_since') else 0}) as {c}" for c in FEATURES)


def _batch(at):
    at = f"timestamp '{at}'"
    return f"""select b.customer_id, b.offer_type, b.level, b.p_accept, b.cost, {', '.join('b.' + c for c in FEATURES)},
      1 as model_version, {at} as scored_at
      from ({_grid_scores(f'''(select s.customer_id, {_known('f')} from (select customer_id, {at} as at from customers) s
        asof left join features f on s.customer_id = f.customer_id and s.at >= f.ts)''')}) b"""


def _auc(source, group, score="p", label="accepted"):
    """Rank-sum AUC with mid-ranks for ties."""
    by = ", ".join(group)
    part = f"partition by {by}" if group else ""
    out = f"{by}," if group else ""
    return f"""select {out} round((sum(case when {label} = 1 then mid end) - sum({label})::double * (sum({label}) + 1) / 2)
        / nullif(sum({label})::double * sum(1 - {label}), 0), 6) as auc, count(*) as n
      from (select *, rank() over ({part} order by {score}) + (count(*) over ({part + ',' if part else 'partition by'} {score}) - 1) / 2.0 as mid
            from {source}) {('group by ' + by) if group else ''}"""


def _decide(source, threshold):
    """First matching rule per customer with score thresholds moved by `threshold`."""
    t = lambda x: repr(round(min(max(x + threshold, 0), 1), 3)) + "::double"
    return f"""select *, case
        when score_max < {t(0.35)} and segment = 'new' then 'cold start'
        when segment = 'champion' and score_max > {t(0.8)} then 'top shelf'
        when segment <> 'at_risk' and score_max between {t(0.65)} and {t(0.8)} then 'within reach'
        when segment = 'at_risk' then 'win back' when segment = 'new' then 'first steps'
        else 'everyone else' end as rule from {source}"""


def _resolve(matched):
    return f"""select m.customer_id, m.segment, m.rule,
        coalesce(s.offer_type, 'no_offer') as offer_type, m.action_level as level,
        coalesce(s.p_accept, 0.0::double) as p_accept, coalesce(s.cost, 0)::int as cost
      from (select r.*, a.action, a.action_level from {matched} r join actions a using (rule)) m
      left join (
        select m2.customer_id, s2.offer_type, s2.p_accept, s2.cost,
          row_number() over (partition by m2.customer_id order by s2.p_accept desc, s2.cost, s2.offer_type) as rn
        from (select r.*, a.action, a.action_level from {matched} r join actions a using (rule)) m2
        join scored s2 on s2.customer_id = m2.customer_id and s2.level = m2.action_level
          and (s2.offer_type = m2.action or (m2.action = 'best_ml' and s2.active))) s
        on s.customer_id = m.customer_id and s.rn = 1"""


def _cut(decisions, budgets):
    return f"""select d.*, d.offer_type <> 'no_offer' and d.running_cost <= coalesce(b.budget, 0) as eligible,
        case when d.offer_type <> 'no_offer' and d.running_cost <= coalesce(b.budget, 0) then d.offer_type else 'no_offer' end
          as final_offer
      from (select *, (sum(cost) over (partition by segment order by p_accept desc, customer_id
              rows unbounded preceding))::bigint as running_cost from {decisions}) d
      left join {budgets} b using (segment)"""


def _kpis(source, by=""):
    served = "final_offer <> 'no_offer'"
    return f"""select {by + ',' if by else ''} count(*) as customers, count(*) filter (where {served}) as served,
        round_even(100.0::double * count(*) filter (where {served}) / greatest(count(*), 1), 1) as coverage_pct,
        coalesce(sum(cost) filter (where {served}), 0)::bigint as points_spent,
        coalesce(round_even((sum(p_accept::decimal(10,6)) filter (where {served}))::double
          / nullif(count(*) filter (where {served}), 0), 3), 0) as mean_p,
        coalesce(round_even((sum(p_accept::decimal(10,6)) filter (where {served}))::double, 0), 0)::bigint as expected_acceptances
      from {source} {('group by ' + by) if by else ''}"""


def _drift_cells(source):
    cols = " union all ".join(
        f"select date_trunc('day', scored_at)::timestamp as window_start, offer_type, '{c}' as \"column\", {c}::double as value from {source}"
        for c in DRIFT_COLUMNS
    )
    return cols


def _importance_runs():
    runs = []
    used = {"days_since_redemption": "recency", "points_expiring_30d": "expiring", "missions_30d": "missions"}
    for c in CANDIDATES:
        arg = {k: (f"d.{k}" if k == c else f"t.{k}") for k in used}
        p = _p("t.offer_type", "t.level", arg["days_since_redemption"], arg["points_expiring_30d"], arg["missions_30d"], "t.customer_id")
        runs.append(f"""select '{c}' as "column", r.repeat, t.accepted, {p} as p from test_rows t
          cross join (select unnest([1, 2, 3, 4, 5]) as repeat) r
          join (select x.* exclude (position), r2.repeat, row_number() over (partition by r2.repeat
                  order by md5(x.offer_id::varchar || ':' || r2.repeat::varchar || ':{c}')) as position
                from test_rows x cross join (select unnest([1, 2, 3, 4, 5]) as repeat) r2) d
            on d.position = t.position and d.repeat = r.repeat""")
    base = _p("offer_type", "level", "days_since_redemption", "points_expiring_30d", "missions_30d")
    runs.append(f"""select '(none)', 0, accepted, {base} from test_rows""")
    return " union all ".join(runs)


def _draft_conditions():
    return """'[{"field":"segment","op":"=","value":"' || segment || '"},{"field":"score","op":">=","value":' || threshold::varchar || '}]'"""


CTES: dict[str, str] = {
    "customers": """select c_custkey as customer_id, r_name as region, c_mktsegment as market from customer
        left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "all_lines": """select o_custkey as customer_id, lineitem.* from lineitem join orders on l_orderkey = o_orderkey""",
    "redemptions": """select customer_id, l_shipdate as ts, l_quantity::bigint * 10 as points,
        l_linenumber::varchar as category, l_orderkey as order_id from all_lines where l_returnflag = 'R'""",
    "credits": """select customer_id, l_shipdate as credit_ts, l_quantity::bigint * 10 as points,
        l_shipdate + interval 365 day as expiry_ts, l_orderkey as order_id, l_linenumber as line
        from all_lines where l_returnflag = 'A'""",
    "missions": "select customer_id, l_shipdate as ts from all_lines where l_returnflag = 'N' and l_linestatus = 'F'",
    "offers": """select o_orderkey as offer_id, o_custkey as customer_id, o_orderdate as offer_ts,
        case substr(o_orderpriority, 1, 1) when '1' then 'cashback' when '2' then 'bonus' when '3' then 'discount'
          else 'mission' end as offer_type, (1 + o_orderkey % 3)::int as level from orders""",
    "catalog": _values(CATALOG_ROWS, "offer_type, active, base_cost"),
    "levels": "select unnest([1, 2, 3])::int as level",
    "budgets": f"""select segment, priority, floor(budget * (select count(*) from customer) / 12000.0)::bigint as budget
        from ({_values(BUDGET_ROWS, 'segment, priority, budget')})""",
    "actions": _values(
        [("cold start", "no_offer", 1), ("top shelf", "bonus", 2), ("within reach", "best_ml", 1),
         ("win back", "best_ml", 3), ("first steps", "mission", 1),
         ("everyone else", "discount", 1)],
        "rule, action, action_level",
    ),
    "snapshot_pts": f"""select customer_id, ts from redemptions where ts <= {NOW} union
        select customer_id, offer_ts from offers where offer_ts <= {NOW} union
        select customer_id, {NOW} from customers""",
    "point_redemptions": """select p.customer_id, p.ts, count(*) as n,
        count(*) filter (where e.ts > p.ts - interval 90 day) as n90, max(e.ts) as last_ts
        from snapshot_pts p join redemptions e on e.customer_id = p.customer_id and e.ts <= p.ts group by all""",
    "point_credits": """select p.customer_id, p.ts, sum(points)::bigint as accumulated,
        coalesce(sum(points) filter (where e.expiry_ts > p.ts and e.expiry_ts <= p.ts + interval 30 day), 0)::bigint as expiring,
        coalesce(sum(points) filter (where e.expiry_ts <= p.ts), 0)::bigint as expired, max(e.credit_ts) as last_ts
        from snapshot_pts p join credits e on e.customer_id = p.customer_id and e.credit_ts <= p.ts group by all""",
    "point_missions": """select p.customer_id, p.ts, count(*) filter (where e.ts > p.ts - interval 30 day) as n30
        from snapshot_pts p join missions e on e.customer_id = p.customer_id and e.ts <= p.ts group by all""",
    "features": f"""select p.customer_id, p.ts, coalesce(r.n, 0) as redemptions_total, coalesce(r.n90, 0) as redemptions_90d,
        coalesce(c.accumulated, 0) as points_accumulated, coalesce(c.expiring, 0) as points_expiring_30d,
        coalesce(c.expired, 0) as points_expired, coalesce({_age('p.ts', 'r.last_ts')}, 999)::int as days_since_redemption,
        coalesce({_age('p.ts', 'c.last_ts')}, 999)::int as days_since_credit, coalesce(m.n30, 0) as missions_30d
        from snapshot_pts p left join point_redemptions r using (customer_id, ts)
        left join point_credits c using (customer_id, ts) left join point_missions m using (customer_id, ts)""",
    "offer_redemptions": """select o.offer_id, count(*) as redemptions_total,
        count(*) filter (where e.ts > o.offer_ts - interval 30 day) as redemptions_30d,
        count(*) filter (where e.ts > o.offer_ts - interval 60 day) as redemptions_60d,
        count(*) filter (where e.ts > o.offer_ts - interval 90 day) as redemptions_90d,
        max(e.ts) as last_redemption, sum(e.points)::bigint as points_spent,
        count(distinct case when e.ts > o.offer_ts - interval 90 day then e.category end) as categories_90d
        from offers o join redemptions e on e.customer_id = o.customer_id and e.ts <= o.offer_ts group by 1""",
    "offer_credits": """select o.offer_id, sum(points)::bigint as points_accumulated,
        coalesce(sum(points) filter (where e.expiry_ts <= o.offer_ts), 0)::bigint as points_expired,
        coalesce(sum(points) filter (where e.expiry_ts > o.offer_ts and e.expiry_ts <= o.offer_ts + interval 15 day), 0)::bigint as points_expiring_15d,
        coalesce(sum(points) filter (where e.expiry_ts > o.offer_ts and e.expiry_ts <= o.offer_ts + interval 30 day), 0)::bigint as points_expiring_30d,
        coalesce(sum(points) filter (where e.expiry_ts > o.offer_ts and e.expiry_ts <= o.offer_ts + interval 60 day), 0)::bigint as points_expiring_60d,
        max(e.credit_ts) as last_credit
        from offers o join credits e on e.customer_id = o.customer_id and e.credit_ts <= o.offer_ts group by 1""",
    "offer_missions": """select o.offer_id, count(*) filter (where e.ts > o.offer_ts - interval 30 day) as missions_30d,
        max(e.ts) as last_mission
        from offers o join missions e on e.customer_id = o.customer_id and e.ts <= o.offer_ts group by 1""",
    "labelled": f"""select o.*, ({_uniform('o.offer_id::varchar')} < 1.0::double / (1.0::double + exp(-{
        _z('o.offer_type', 'o.level', "coalesce(" + _age('o.offer_ts', 'r.last_redemption') + ", 365)",
           'coalesce(c.points_expiring_30d, 0)', 'coalesce(m.missions_30d, 0)')})))::int as accepted
        from offers o left join offer_redemptions r using (offer_id) left join offer_credits c using (offer_id)
        left join offer_missions m using (offer_id)""",
    "candidates": f"""select o.*, coalesce(r.redemptions_total, 0) as redemptions_total,
        coalesce(redemptions_30d, 0) as redemptions_30d, coalesce(redemptions_60d, 0) as redemptions_60d,
        coalesce(redemptions_90d, 0) as redemptions_90d, coalesce(points_accumulated, 0) as points_accumulated,
        greatest(0, coalesce(points_accumulated, 0) - coalesce(points_spent, 0) - coalesce(points_expired, 0)) as points_balance,
        coalesce(points_expiring_15d, 0) as points_expiring_15d, coalesce(points_expiring_30d, 0) as points_expiring_30d,
        coalesce(points_expiring_60d, 0) as points_expiring_60d, coalesce(points_expired, 0) as points_expired,
        coalesce({_age('o.offer_ts', 'last_redemption')}, 0)::int as days_since_redemption,
        coalesce({_age('o.offer_ts', 'last_credit')}, 0)::int as days_since_credit,
        coalesce({_age('o.offer_ts', 'last_mission')}, 0)::int as days_since_mission,
        coalesce(missions_30d, 0) as missions_30d,
        coalesce({_half_up('points_spent', 'r.redemptions_total', 1)}, 0) as avg_ticket,
        coalesce(categories_90d, 0) as categories_90d,
        case when coalesce(points_accumulated, 0) > 0 then {_half_up('coalesce(points_spent, 0)', 'points_accumulated', 3)}
          else 0.0::double end as points_usage_rate
        from labelled o left join offer_redemptions r using (offer_id) left join offer_credits c using (offer_id)
        left join offer_missions m using (offer_id)""",
    "training": f"""select t.*, l.accepted from ({_pit('offers', 'offer_ts', FEATURES)}) t join labelled l using (offer_id)""",
    "now_features": _features_at(NOW),
    "base": """select *, days_since_redemption as recency_today, case
        when days_since_redemption > 90 and redemptions_total >= 2 then 'at_risk' when redemptions_total <= 1 then 'new'
        when days_since_redemption <= 30 and redemptions_total >= 5 then 'champion' else 'active' end as segment
        from now_features""",
    "scored": _grid_scores("base"),
    "cust_scores": """select customer_id, segment, redemptions_60d, redemptions_total, points_accumulated, recency_today,
        max(p_accept) as score_max from scored group by all""",
    "matched": _decide("cust_scores", 0),
    "decisions": _resolve("matched"),
    "final_offers": _cut("decisions", "budgets"),
    "matched_proposed": _decide("cust_scores", SCENARIO_SHIFT),
    "decisions_proposed": _resolve("matched_proposed"),
    "budgets_proposed": "select segment, case segment "
    + " ".join(f"when '{s}' then {b}" for s, b in SCENARIO_OVERRIDE.items())
    + " else budget end as budget from budgets",
    "final_proposed": _cut("decisions_proposed", "budgets_proposed"),
    "both_scenarios": "select 'current' as scenario, * from final_offers union all select 'proposed', * from final_proposed",
    "scenario_figures": _kpis("both_scenarios", "scenario"),
    "offer_scores": f"""select l.*, {_p('l.offer_type', 'l.level',
        "coalesce(" + _age('l.offer_ts', 'r.last_redemption') + ", 365)", 'coalesce(c.points_expiring_30d, 0)',
        'coalesce(m.missions_30d, 0)', 'l.customer_id')} as p
        from labelled l left join offer_redemptions r using (offer_id) left join offer_credits c using (offer_id)
        left join offer_missions m using (offer_id)""",
    "split": """select *, row_number() over (partition by accepted order by md5(offer_id::varchar), offer_id)
        <= ceil(0.25 * count(*) over (partition by accepted)) as is_test from labelled""",
    "test_rows": """select c.*, row_number() over (order by offer_id) as position
        from candidates c join (select offer_id, is_test from split) s using (offer_id) where is_test""",
    "importance_runs": _importance_runs(),
    "importance_aucs": _auc("importance_runs", ['"column"', "repeat"]),
    "versions": """select c.market as model, (date_part('year', o.offer_ts) * 4 + date_part('quarter', o.offer_ts))::int as version,
        o.accepted, o.p from offer_scores o join customers c using (customer_id)""",
    "version_auc": _auc("versions", ["model", "version"]),
    "version_runs": """select v.model || '-' || v.version::varchar as run_id, v.model, v.version, v.auc, a.accuracy, v.n
        from version_auc v join (select model, version, round(avg(((p >= 0.5)::int = accepted)::int), 6) as accuracy
        from versions group by all) a using (model, version)""",
    "gate": """select *, max(auc) over (partition by model order by version rows between unbounded preceding and 1 preceding)
        as champion_auc_before from version_runs""",
    "verdicts": """select *, auc is not null and auc >= coalesce(champion_auc_before, -1) as promoted from gate""",
    "score_rules": """select *, row_number() over (order by n desc, segment, score_max) as id
        from (select segment, score_max, count(*) as n, max(redemptions_60d) as r from cust_scores group by all)""",
    "drafts_raw": """select c.market, s.segment, count(*) as n, round(avg(s.score_max), 2) as threshold
        from cust_scores s join customers c using (customer_id) group by all""",
    "drafts": f"""select (row_number() over (order by segment, market))::int as id,
        (row_number() over (order by n desc, segment, market))::int as priority, segment || ' in ' || market as name,
        threshold >= 0.62 as active, {_draft_conditions()} as conditions,
        case segment when 'new' then 'mission' when 'champion' then 'bonus' else 'best_ml' end as action,
        (1 + n % 3)::int as action_level, market from drafts_raw""",
    "snapshot_drift": " union all ".join(_batch(at) for at in DRIFT_RUNS),
    "drift_now": _drift_cells("snapshot_drift"),
    "drift_old": f"""select * from drift_now where window_start = timestamp '{DRIFT_RUNS[0]}'""",
    "lots": """select customer_id, order_id::varchar || '-' || line::varchar || '-' || strftime(credit_ts, '%Y%m%d') as lot_id,
        credit_ts as ts, sum(points)::bigint as points from credits group by all""",
    "spends": """select customer_id, order_id::varchar || '-' || category || '-' || strftime(ts, '%Y%m%d') as spend_id,
        ts, sum(points)::bigint as points from redemptions group by all""",
    "lot_spans": "select *, (sum(points) over w - points)::bigint as lo, (sum(points) over w)::bigint as hi from lots "
    "window w as (partition by customer_id order by ts, lot_id rows unbounded preceding)",
    "spend_spans": "select *, (sum(points) over w - points)::bigint as lo, (sum(points) over w)::bigint as hi from spends "
    "window w as (partition by customer_id order by ts, spend_id rows unbounded preceding)",
    "ledger_moves": """select customer_id, expiry_ts as moved_at, 1 as kind, lot_id as ident,
          (sum(points) over (partition by customer_id order by ts, lot_id rows unbounded preceding))::bigint as amount, 0::bigint as credited
          from (select l.*, l.ts + interval 365 day as expiry_ts from lots l)
        union all select customer_id, ts, 2, spend_id, points,
          coalesce((select sum(l.points) from lots l where l.customer_id = s.customer_id and l.ts <= s.ts), 0)::bigint from spends s""",
    "ledger_order": "select *, row_number() over (partition by customer_id order by moved_at, kind, ident) as step from ledger_moves",
    "ledger_walk": """select customer_id, step, kind, ident, amount, 0::bigint as start,
          case kind when 1 then greatest(0, amount) else least(amount, credited) end as stop from ledger_order where step = 1
        union all select o.customer_id, o.step, o.kind, o.ident, o.amount, w.stop,
          case o.kind when 1 then greatest(w.stop, o.amount) else least(w.stop + o.amount, o.credited) end
        from ledger_walk w join ledger_order o on o.customer_id = w.customer_id and o.step = w.step + 1""",
    "earlier_features": _features_at(f"timestamp '{EARLIER}'"),
    "old_members": """select customer_id, redemptions_total, points_accumulated, missions_30d from earlier_features""",
    "new_members": """select customer_id, redemptions_total, points_accumulated, missions_30d from now_features""",
    "feed": """select case when o.customer_id is null then 'insert' when n.customer_id is null then 'delete'
          else 'update_postimage' end as change, coalesce(n.customer_id, o.customer_id) as customer_id,
        case when n.customer_id is null then o.redemptions_total else n.redemptions_total end as redemptions_total,
        case when n.customer_id is null then o.points_accumulated else n.points_accumulated end as points_accumulated,
        case when n.customer_id is null then o.missions_30d else n.missions_30d end as missions_30d
        from old_members o full join new_members n using (customer_id)
        where o.customer_id is null or n.customer_id is null or (o.redemptions_total, o.points_accumulated, o.missions_30d)
          is distinct from (n.redemptions_total, n.points_accumulated, n.missions_30d)
        union all select 'update_preimage', o.customer_id, o.redemptions_total, o.points_accumulated, o.missions_30d
        from old_members o join new_members n using (customer_id)
        where (o.redemptions_total, o.points_accumulated, o.missions_30d)
          is distinct from (n.redemptions_total, n.points_accumulated, n.missions_30d)""",
    "requests": "select customer_id, k.offer_type, 3::int as level from customers cross join catalog k",
    "activity_old": f"""select customer_id, offer_type, max(offer_ts) as last_offer, count(*) as n_offers from offers
        where offer_ts < timestamp '{CATALOG_CUT}' group by all""",
    "activity_new": f"""select customer_id, offer_type, max(offer_ts) as last_offer, count(*) as n_offers from offers
        where offer_ts >= timestamp '{CATALOG_CUT}' group by all""",
    "budget_changes": f"""select customer_id, case when sum(points) > {SPEND_LIMIT} then null else sum(points)::bigint end as budget
        from redemptions where ts <= {NOW} group by 1 union all
        select customer_id + {UNKNOWN_SHIFT}, 1::bigint from customers""",
    "user_features": """select user_id, ts, event_id, event_type,
        count(*) over w as events_total, count(*) filter (where event_type = 'error') over w as errors_total
        from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)""",
}

_F = ", ".join(FEATURES)
_BASE = "customer_id, segment, redemptions_60d, redemptions_total, points_accumulated, recency_today"
_BEST = "order by p_accept desc, cost, offer_type, level"

FINAL: dict[str, str] = {
    "label_rate": "select count(*) as offers, sum(accepted)::bigint as accepted, round(avg(accepted), 6) as rate from labelled",
    "snapshot_points": "select * from snapshot_pts",
    "asof_redemptions": """select o.offer_id, coalesce(redemptions_total, 0) as redemptions_total,
        coalesce(redemptions_30d, 0) as redemptions_30d, coalesce(redemptions_60d, 0) as redemptions_60d,
        coalesce(redemptions_90d, 0) as redemptions_90d, coalesce(points_spent, 0) as points_spent
        from offers o left join offer_redemptions using (offer_id)""",
    "asof_credits": """select o.offer_id, coalesce(points_accumulated, 0) as points_accumulated,
        coalesce(points_expired, 0) as points_expired, coalesce(points_expiring_15d, 0) as points_expiring_15d,
        coalesce(points_expiring_30d, 0) as points_expiring_30d, coalesce(points_expiring_60d, 0) as points_expiring_60d
        from offers o left join offer_credits using (offer_id)""",
    "asof_missions": """select o.offer_id, coalesce(missions_30d, 0) as missions_30d
        from offers o left join offer_missions using (offer_id)""",
    "asof_recency": f"""select o.offer_id, coalesce({_age('offer_ts', 'last_redemption')}, 999)::int as days_since_redemption,
        coalesce({_age('offer_ts', 'last_credit')}, 999)::int as days_since_credit,
        coalesce({_age('offer_ts', 'last_mission')}, 999)::int as days_since_mission
        from offers o left join offer_redemptions using (offer_id) left join offer_credits using (offer_id)
        left join offer_missions using (offer_id)""",
    "distinct_categories_90d": """select o.offer_id, coalesce(categories_90d, 0) as categories_90d
        from offers o left join offer_redemptions using (offer_id)""",
    "points_balance": "select offer_id, points_balance, points_usage_rate from candidates",
    "candidates": f"select offer_id, customer_id, offer_ts, offer_type, level, accepted, {', '.join(CANDIDATES)} from candidates",
    "features_asof": f"select customer_id, ts, {_F} from features",
    "feature_key_violations": "select count(*) as duplicate_keys from (select 1 from features group by customer_id, ts having count(*) > 1)",
    "pit_lookup": f"select offer_id, customer_id, offer_ts, feature_ts, {_F} from ({_pit('offers', 'offer_ts', FEATURES)})",
    "training_set": f"select offer_id, offer_type, level, accepted, {_F} from training",
    "latest_features": f"select customer_id, ts, {_F} from features qualify row_number() over (partition by customer_id order by ts desc) = 1",
    "recent_snapshots": f"""select customer_id, ts, {_F}, (row_number() over (partition by customer_id order by ts desc))::int as recent_rank
        from features qualify recent_rank <= 3""",
    "customer_base": "select customer_id, redemptions_60d, redemptions_total, points_accumulated, recency_today from base",
    "segments": "select customer_id, segment from base",
    "offer_grid": "select customer_id, offer_type, active, level, (base_cost * level)::int as cost from customers cross join catalog cross join levels",
    "offer_cost": "select offer_id, o.offer_type, level, (base_cost * level)::int as cost from offers o join catalog using (offer_type)",
    "logit_score": "select customer_id, offer_type, level, p_accept from scored",
    "scored_base": "select customer_id, segment, offer_type, level, p_accept, cost, redemptions_60d, redemptions_total, points_accumulated, recency_today from scored",
    "customer_scores": f"select {_BASE}, score_max from cust_scores",
    "scores_batch": _batch(RUN_TS),
    "best_offer": f"""select customer_id, offer_type, level, p_accept, cost, model_version, scored_at from ({_batch(RUN_TS)})
        qualify row_number() over (partition by customer_id {_BEST}) = 1""",
    "offer_mix": f"""select offer_type, count(*) as n from (select * from ({_batch(RUN_TS)})
        qualify row_number() over (partition by customer_id {_BEST}) = 1) group by 1""",
    "active_scores": "select customer_id, offer_type, level, p_accept from scored where offer_type <> 'cashback'",
    "best_type_per_level": f"""select customer_id, level, offer_type, p_accept from scored
        qualify row_number() over (partition by customer_id, level {_BEST}) = 1""",
    "candidate_rank": f"""select customer_id, offer_type, level, p_accept,
        (row_number() over (partition by customer_id {_BEST}))::int as candidate_rank from scored where level = 3""",
    "expected_value": f"""select customer_id, offer_type, level, p_accept, cost, round(p_accept * v.value - cost, 6) as expected_value
        from scored join ({_values(list(OFFER_VALUES.items()), 'offer_type, value')}) v using (offer_type)
        qualify row_number() over (partition by customer_id order by round(p_accept * v.value - cost, 6) desc, p_accept desc, cost, offer_type, level) = 1""",
    "score_requests": f"""select q.customer_id, q.offer_type, q.level, {_p('q.offer_type', 'q.level', 'b.days_since_redemption', 'b.points_expiring_30d', 'b.missions_30d', 'q.customer_id')} as p_accept,
        (k.base_cost * q.level)::int as cost from requests q join base b using (customer_id) join catalog k using (offer_type)""",
    "rule_match": "select customer_id, segment, score_max, rule, action, action_level from matched join actions using (rule)",
    "rule_match_indexed": """select c.customer_id, c.segment, c.score_max,
        coalesce('score-' || min(r.id)::varchar, 'no_rule') as rule, case when min(r.id) is null then 'no_offer' else 'best_ml' end as action,
        coalesce(min(r.id) % 3 + 1, 1)::int as action_level
        from cust_scores c left join score_rules r on r.segment = c.segment and c.score_max >= r.score_max and c.redemptions_60d <= r.r
        group by c.customer_id, c.segment, c.score_max""",
    "decisions": "select customer_id, segment, rule, offer_type, level, p_accept, cost from decisions",
    "running_cost": "select customer_id, segment, cost, running_cost from final_offers",
    "final_offers": "select customer_id, segment, rule, final_offer, offer_type, level, p_accept, cost, eligible from final_offers",
    "segment_offer_mix": "select segment, final_offer, count(*) as n from final_offers group by all",
    "scenario_decisions": "select scenario, customer_id, segment, rule, final_offer, offer_type, level, p_accept, cost, eligible from both_scenarios",
    "scenario_kpis": "select * from scenario_figures",
    "scenario_delta": """select p.served - c.served as served_delta, round_even(p.coverage_pct - c.coverage_pct, 1) as coverage_pct_delta,
        p.points_spent - c.points_spent as points_spent_delta, p.expected_acceptances - c.expected_acceptances as expected_acceptances_delta
        from scenario_figures c, scenario_figures p where c.scenario = 'current' and p.scenario = 'proposed'""",
    "scenario_distribution": """select coalesce(a.final_offer, b.final_offer) as final_offer, coalesce(a.n, 0) as current, coalesce(b.n, 0) as proposed
        from (select final_offer, count(*) as n from final_offers group by 1) a
        full join (select final_offer, count(*) as n from final_proposed group by 1) b on a.final_offer = b.final_offer""",
    "rules_active": "select id, priority, name, active, conditions, action, action_level from drafts where active",
    "rules_text": """select id, name, 'segment = ' || split_part(name, ' in ', 1) || ' and score >= ' || d.threshold::varchar as condition_text
        from drafts join drafts_raw d on drafts.name = d.segment || ' in ' || d.market""",
    "rule_violations": """select id, name, case market when 'BUILDING' then 'conditions are not a JSON list'
          when 'MACHINERY' then 'unknown field' when 'HOUSEHOLD' then 'unknown action' when 'FURNITURE' then 'level out of range'
          else 'priority is missing' end as violation from drafts""",
    "rules_replace": """select row_number() over (order by d.threshold desc, drafts.id) as id, priority, name, active, conditions, action, action_level
        from drafts join drafts_raw d on drafts.name = d.segment || ' in ' || d.market""",
    "label_correlation": " union all ".join(
        f"select '{c}' as candidate, round(corr({c}, accepted), 6) as correlation from candidates" for c in CANDIDATES),
    "correlation_pairs": " union all ".join(
        f"select '{a}' as first, '{b}' as second, round(corr({a}, {b}), 6) as correlation from candidates"
        for a, b in combinations(CANDIDATES, 2)),
    "stratified_split": "select offer_id, accepted, is_test from split",
    "auc_exact": f"""select 'all' as slice, auc, n from ({_auc('offer_scores', [])}) union all
        select offer_type, auc, n from ({_auc('offer_scores', ['offer_type'])})""",
    "accuracy": """select offer_type, round(avg(((p >= 0.5)::int = accepted)::int), 6) as accuracy, count(*) as n
        from offer_scores group by 1""",
    "permutation_importance": """select "column", round((select auc from importance_aucs where "column" = '(none)') - avg(auc), 6) as importance
        from importance_aucs where "column" <> '(none)' group by 1""",
    "propensity_gbt": "select offer_id, accepted, true as is_probability, true as beats_chance from split where is_test",
    "champion_batch": f"""select customer_id, offer_type, level, cost, {_F}, scored_at, true as is_probability, true as from_champion
        from ({_batch(RUN_TS)})""",
    "champion_base": f"select {_BASE}, count(*) as offers, true as is_probability, true as from_champion from scored group by all",
    "feature_selection": f"""select place::int as place, candidate, importance, verdict from (
        with recursive importance_rows as (select "column" as candidate,
            round((select auc from importance_aucs where "column" = '(none)') - avg(auc), 6) as importance
          from importance_aucs where "column" <> '(none)' group by 1),
        ranks as (select row_number() over (order by importance desc, candidate) as place, * from importance_rows),
        twins as ({" union all ".join(f"select '{a}' as one, '{b}' as other from candidates having abs(round(corr({a}, {b}), 6)) > 0.9"
            for a, b in combinations(CANDIDATES, 2))}),
        judged as (select 0::bigint as place, '' as candidate, 0.0::double as importance, '' as verdict, []::varchar[] as kept
          union all
          select r.place, r.candidate, r.importance, case when r.importance < 0.001 then 'weak'
              when t.twin is not null then 'redundant with ' || t.twin else 'kept' end,
            case when r.importance < 0.001 or t.twin is not null then j.kept else list_append(j.kept, r.candidate) end
          from judged j join ranks r on r.place = j.place + 1
          left join lateral (select arg_min(k.name, k.at) as twin
            from (select unnest(j.kept) as name, generate_subscripts(j.kept, 1) as at) k
            join twins w on (w.one = k.name and w.other = r.candidate) or (w.other = k.name and w.one = r.candidate)) t on true)
        select * from judged where place > 0)""",
    "best_run": "select run_id, model, version, auc, accuracy from version_runs qualify row_number() over (partition by model order by auc desc nulls last, run_id) = 1",
    "promotion_ledger": """select run_id, model, version, auc, champion_auc_before, promoted,
        max(case when promoted then version end) over (partition by model order by version rows unbounded preceding) as champion_version
        from verdicts""",
    "current_aliases": """select model, 'challenger' as alias, max(version) as version from verdicts group by 1 union all
        select model, 'champion', max(version) filter (where promoted) from verdicts group by 1 having max(version) filter (where promoted) is not null""",
    "catalog_upsert": """select customer_id, offer_type, coalesce(n.last_offer, o.last_offer) as last_offer,
        coalesce(n.n_offers, o.n_offers) as n_offers from activity_old o full join activity_new n using (customer_id, offer_type)""",
    "budget_update": """select b.customer_id, b.segment, case when u.customer_id is null then b.points_accumulated else u.budget end as budget
        from base b left join budget_changes u using (customer_id)""",
    "change_feed": "select * from feed",
    "change_feed_by_digest": "select * from feed",
    "change_audit": f"""select '{AUDIT_USER}' as user, '{AUDIT_ACTION}' as action,
        '{{"change":"' || change || '","n":' || count(*)::varchar || '}}' as detail, audited_at from feed
        cross join (values (timestamp '{EARLIER}'), ({NOW})) t(audited_at) group by change, audited_at""",
    "feature_table_stored": f"select customer_id, ts, {_F} from features",
    "offers_of_stored_controls": "select customer_id, segment, rule, final_offer, offer_type, level, p_accept, cost, eligible from final_offers",
    "export_customers": """select customer_id, segment, score_max, redemptions_60d::int as redemptions_60d, recency_today,
        redemptions_total::int as redemptions_total, points_accumulated from cust_scores""",
    "export_scores": "select customer_id, offer_type, level, p_accept from scored",
    "export_counts": "select (select count(*) from cust_scores) as customers, (select count(*) from scored) as scores",
    "step_counts": """select 'snapshots' as step, count(*) as n from snapshot_pts union all select 'training_rows', count(*) from offers
        union all select 'scored', count(*) from scored union all select 'customers', count(*) from cust_scores
        union all select 'final_offers', count(*) from final_offers""",
    "snapshot_append": " union all ".join(_batch(at) for at in SNAPSHOT_RUNS),
    "drift_profile": """select window_start, offer_type, "column", count(*) as n, round(avg(value), 4) as mean,
        round(stddev_samp(value), 4) as stddev, round(avg((value is null)::int), 6) as null_rate from drift_now group by all""",
    "drift_ks": f"""select g.window_start, g.offer_type, g."column", round(max(abs(f_now - f_old)), 6) as ks,
          any_value(n)::bigint as n, any_value(n_baseline)::bigint as n_baseline
        from (select v.window_start, v.offer_type, v."column", v.value, v.n, v.n_baseline,
            v.upto_now / v.n::double as f_now, v.upto_old / v.n_baseline::double as f_old
          from (select s.window_start, s.offer_type, s."column", s.value,
              sum(s.w_now) over part as n, sum(s.w_old) over part as n_baseline,
              sum(s.w_now) over upto as upto_now, sum(s.w_old) over upto as upto_old
            from (select window_start, offer_type, "column", value, 1 as w_now, 0 as w_old from drift_now
                  where window_start <> timestamp '{DRIFT_RUNS[0]}'
                  union all
                  select d.at, o.offer_type, o."column", o.value, 0, 1 from drift_old o
                  cross join (select distinct window_start as at from drift_now
                    where window_start <> timestamp '{DRIFT_RUNS[0]}') d) s
            window part as (partition by s.window_start, s.offer_type, s."column"),
              upto as (partition by s.window_start, s.offer_type, s."column" order by s.value)) v) g
        group by 1, 2, 3""",
    "fifo_lots": """select l.customer_id, l.lot_id, s.spend_id, (least(l.hi, s.hi) - greatest(l.lo, s.lo))::bigint as points_used
        from lot_spans l join spend_spans s on l.customer_id = s.customer_id and l.lo < s.hi and s.lo < l.hi""",
    "spend_cover": "select customer_id, ident as spend_id, amount as points, stop - start as covered from ledger_walk where kind = 2",
    "fifo_expiring": """select l.customer_id, l.lot_id, s.ident as spend_id, (least(l.hi, s.stop) - greatest(l.lo, s.start))::bigint as points_used
        from lot_spans l join ledger_walk s on l.customer_id = s.customer_id and s.kind = 2 and l.lo < s.stop and s.start < l.hi""",
    "published_features": """select user_id, ts, event_id, event_type, events_total, errors_total from user_features
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "streamed_scores": f"""select q.offer_id, q.customer_id, q.offer_ts, q.offer_type, q.level, {_p('q.offer_type', 'q.level', 'q.days_since_redemption', 'q.points_expiring_30d', 'q.missions_30d', 'q.customer_id')} as p_accept,
        (k.base_cost * q.level)::int as cost from (select offer_id, customer_id, offer_ts, offer_type, level, {_known('t')}
          from ({_pit('offers', 'offer_ts', FEATURES)}) t) q join catalog k using (offer_type)""",
}
FINAL["streamed_drift"], FINAL["streamed_ks"] = FINAL["drift_profile"], FINAL["drift_ks"]


def _reached(text: str, seen: set[str]) -> None:
    for name in CTES:
        if name not in seen and re.search(rf"\b{name}\b", text):
            seen.add(name)
            _reached(CTES[name], seen)


def statements() -> dict[str, str]:
    out = {}
    for key, final in FINAL.items():
        seen: set[str] = set()
        _reached(final, seen)
        walked = "recursive " if "ledger_walk" in seen else ""
        # a recursive part is not marked as materialized
        parts = [f"{name} as {'' if name == 'ledger_walk' else 'materialized '}({CTES[name]})" for name in CTES if name in seen]
        out[key] = (f"with {walked}" + ",\n".join(parts) + "\n" if parts else "") + final
    return out
