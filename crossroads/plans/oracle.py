"""For each registered query the SQL that must give the same rows on the same tables.

The statements are composed from shared common table expressions and written from the
meaning of each operator, not from its Spark plan: pairs are self-joins, sequences are
plain windows, tests are computed over all rows.
"""

from __future__ import annotations

from .. import constants as C
from .. import schema
from ..operators import training_sets

ORACLE: dict[str, str] = {}
ORACLE_BODY: dict[str, str] = {}


def define(name: str, body: str, *ctes: str, instead: dict[str, str] | None = None) -> None:
    """Register ``body`` behind the named common table expressions it needs, in order; ``instead`` names stand-ins for some."""
    chosen, seen, instead = [], set(), instead or {}

    def need(key):
        if key in seen:
            return
        seen.add(key)
        for dep in CTE_DEPS.get(instead.get(key, key), []):
            need(dep)
        chosen.append(f"{key} as ({CTES[instead.get(key, key)]})")

    for key in ctes:
        need(key)
    ORACLE_BODY[name] = body
    ORACLE[name] = ("with " + ",\n".join(chosen) + "\n" if chosen else "") + body


def hash32(text: str) -> str:
    return f"cast(('0x' || substr(md5({text}), 1, 8)) as ubigint)"


def hash32_at(text: str, group: int) -> str:
    return f"cast(('0x' || substr(md5({text}), {8 * group + 1}, 8)) as ubigint)"


def cross(d1: str, m1: str, d2: str, m2: str) -> str:
    return (
        f"({m1} <> 'unknown' and {m2} <> 'unknown' and {d1} <> {d2} and "
        f"case when ({d1} + 2) % 4 = {d2} then ({m1} = 'left') <> ({m2} = 'left') "
        f"else not ({m1} = 'right' and {m2} = 'right') end)"
    )


def close(t1: str, t2: str) -> str:
    return f"coalesce(abs({t1} - {t2}) <= 4.0, false)"


CTES: dict[str, str] = {}
CTE_DEPS: dict[str, list[str]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = sql
    CTE_DEPS[name] = list(deps)


cte("lines", """select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
  l_extendedprice, l_quantity, l_discount, l_tax) as rn, count(*) over (partition by l_orderkey) as n from lineitem""")
LANES = "{" + ", ".join(f"{n}: {names}" for lanes in C.LAYOUT_EIGHT_LANE.values() for n, names in lanes.items()) + "}"
cte("raw_rows", f"""select l_orderkey as scenario_id, cast(rn as int) as seq, n, concat('V', cast(1000 + rn as varchar)) as vehicle_id,
  cast(2 * (l_partkey % 4) + 1 + (l_suppkey % 2) as int) as lane,
  case when l_discount = 0 and l_tax = 0 then 0::double
       else 10::double + (cast(round(l_extendedprice * 100) as bigint) % 8001) / 100::double end as speed,
  10::double + (l_quantity - 1) * 10 as distance_to_intersection,
  cast(l_partkey % 4 as int) as d,
  case l_partkey % 4 when 0 then 'north' when 1 then 'east' when 2 then 'south' else 'west' end as direction,
  coalesce((map {LANES})[2 * (l_partkey % 4) + 1 + (l_suppkey % 2)][case when l_linenumber = 7 then 3 else 1 + l_linenumber % 2 end], 'X')
    as destination
  from lines""", "lines")
cte("m", """select *, case when destination = 'X' then 'unknown' when lane % 2 = 0 then 'left'
    when instr(case lane when 1 then 'FH' when 3 then 'HB' when 5 then 'BD' else 'DF' end, destination) = 1 then 'right'
    else 'straight' end as m,
  case when speed > 0 then distance_to_intersection / (speed * 1000 / 3600) end as t,
  case when speed > 0 then distance_to_intersection / (speed / 3.6::double) end as tn
  from raw_rows""", "raw_rows")
cte("sc", "select scenario_id, cast(count(*) as int) as n from m group by scenario_id", "m")
cte("lp", f"""select a.scenario_id, a.seq as seq1, b.seq as seq2, a.vehicle_id as vehicle1_id, b.vehicle_id as vehicle2_id,
  a.m as movement1, b.m as movement2, a.t as t1, b.t as t2, a.d as d1, b.d as d2
  from m a join m b on a.scenario_id = b.scenario_id and a.seq < b.seq
  where {cross('a.d', 'a.m', 'b.d', 'b.m')} and {close('a.t', 'b.t')}""", "m")
cte("lg", """select *, case when abs(t1 - t2) > 1.0 then t1 <= t2
    when (movement1 = 'straight') <> (movement2 = 'straight') then movement1 = 'straight'
    when movement1 = 'right' and movement2 = 'left' then true
    when movement1 = 'left' and movement2 = 'right' then false
    else (d2 - d1 + 4) % 4 <> 1 end as goes,
  case when abs(t1 - t2) > 1.0 then 'arrival time'
    when (movement1 = 'straight') <> (movement2 = 'straight') then 'straight priority'
    when movement1 <> movement2 then 'right-turn priority' else 'right-hand rule' end as rule_used
  from lp""", "lp")
cte("lr", """select scenario_id, seq1, seq2, vehicle1_id, vehicle2_id, movement1, movement2,
  case when goes then seq1 else seq2 end as winner_seq,
  case when goes then vehicle1_id else vehicle2_id end as winner_id,
  case when goes then vehicle2_id else vehicle1_id end as loser_id,
  cast(ceil(greatest(0::double, case when goes then t1 + 2 - t2 else t2 + 2 - t1 end)) as int) as wait, rule_used
  from lg""", "lg")
cte("sides", """select scenario_id, seq1 * 100 + seq2 as pos, seq1 as seq, vehicle1_id as vehicle_id,
    case when winner_seq = seq1 then 1 else 2 end as rank, case when winner_seq = seq1 then 0 else wait end as wait from lr
  union all
  select scenario_id, seq1 * 100 + seq2, seq2, vehicle2_id,
    case when winner_seq = seq2 then 1 else 2 end, case when winner_seq = seq2 then 0 else wait end from lr""", "lr")
cte("pw", """select scenario_id, seq, vehicle_id, cast(min_by(rank, pos) as int) as rank, cast(max(wait) as int) as wait
  from sides group by scenario_id, seq, vehicle_id""", "sides")
cte("labels", """select sc.scenario_id, sc.n, case when p.scenario_id is null then 'no' else 'yes' end as is_conflict
  from sc left join (select distinct scenario_id from lp) p using (scenario_id)""", "sc", "lp")
cte("given", "select o_orderkey as scenario_id, case when o_orderstatus = 'F' then 'yes' else 'no' end as given_label from orders")


def near_pairs_sql(op: str) -> str:
    return f"""select a.scenario_id, a.seq as seq1, b.seq as seq2, a.vehicle_id as vehicle1_id, b.vehicle_id as vehicle2_id,
  case when a.speed >= b.speed then a.seq else b.seq end as winner_seq,
  case when a.speed >= b.speed then b.seq else a.seq end as loser_seq,
  case when a.speed >= b.speed then a.vehicle_id else b.vehicle_id end as winner_id,
  case when a.speed >= b.speed then b.vehicle_id else a.vehicle_id end as loser_id,
  cast(case when (case when a.speed >= b.speed then a.tn else b.tn end) is not null
    then greatest(2, ceil(case when a.speed >= b.speed then a.tn else b.tn end) + 1) end as int) as wait
  from m a join m b on a.scenario_id = b.scenario_id and a.seq < b.seq and a.direction <> b.direction
  where a.distance_to_intersection {op} 80 and b.distance_to_intersection {op} 80"""


def near_rank_sql(pairs: str) -> str:
    return f"""select m.scenario_id, m.seq, m.vehicle_id,
  case when w.pos is not null then 0 when l.pos is null then 1 else 2 end as grp,
  case when l.pos is null then 0 else l.wait end as wait, l.pos as loss_at, l.winner_id,
  cast(row_number() over (partition by m.scenario_id order by
    case when w.pos is not null then 0 when l.pos is null then 1 else 2 end, coalesce(w.pos, m.seq * 100), m.seq) as int) as rank
  from m
  left join (select scenario_id, winner_seq as seq, min(seq1 * 100 + seq2) as pos from {pairs} group by 1, 2) w
    using (scenario_id, seq)
  left join (select scenario_id, loser_seq as seq, min(seq1 * 100 + seq2) as pos, min_by(wait, seq1 * 100 + seq2) as wait,
      min_by(winner_id, seq1 * 100 + seq2) as winner_id from
      (select *, coalesce(wait, -1) as w0 from {pairs}) group by 1, 2) l using (scenario_id, seq)"""


cte("np", near_pairs_sql("<="), "m")
cte("gp", near_pairs_sql("<"), "m")
# a NULL wait must survive min_by: carry it as -1
for key in ("np", "gp"):
    name = "nr" if key == "np" else "gr"
    cte(name, near_rank_sql(key).replace("min_by(wait, seq1 * 100 + seq2) as wait", "nullif(min_by(w0, seq1 * 100 + seq2), -1) as wait"), key)
cte("gl", f"""select scenario_id, seq, vehicle_id, case when grp <> 2 then rank end as rank, loss_at, winner_id,
  cast(case when loss_at is not null then 2 + {hash32("'42|' || scenario_id || '|' || seq")} % 5 else 0 end as int) as wait
  from gr""", "gr")
cte("nlabels", """select sc.scenario_id, case when p.scenario_id is null then 'no' else 'yes' end as is_conflict
  from sc left join (select distinct scenario_id from np) p using (scenario_id)""", "sc", "np")
cte("predictions", """select s.scenario_id, k.variant, s.n as num_vehicles, o.o_orderdate as ts, s.is_conflict as true_label,
  case when (s.is_conflict = 'yes') <> (s.scenario_id % k.m = 0) then 'yes' else 'no' end as predicted_label,
  r.is_conflict as rule_label,
  cast(cast(round(o.o_totalprice * 100) as bigint) % 5000 + k.base as double) as latency_ms, s.scenario_id % 53 <> 0 as json_valid
  from labels s join nlabels r using (scenario_id) join orders o on o.o_orderkey = s.scenario_id
  cross join (values ('A', 11, 1500), ('B', 29, 300)) k(variant, m, base)""", "labels", "nlabels")
cte("pe", """select event_id, ts, user_id, cast(regexp_extract(props, '(\\d+)', 1) as int) as k,
  case when event_id % 97 = 0 then null when cast(regexp_extract(props, '(\\d+)', 1) as int) >= 50 then 'yes' else 'no' end as ground_truth,
  case when (cast(regexp_extract(props, '(\\d+)', 1) as int) >= 50) <> (event_id % 17 = 0) then 'yes' else 'no' end as predicted,
  not (event_type = 'error' and event_id % 10 = 0) as json_valid, value * 10 as latency_ms from events""")

# --- rules ---------------------------------------------------------------------

define("vehicles", "select scenario_id, seq, vehicle_id, lane, speed, distance_to_intersection, direction, destination from m", "m")
define("lane_pairs", "select * from lr", "lr")
define("lane_pairs_any_size", "select * from lr", "lr")
define("lane_priority_waits", "select * from pw", "pw")
define("lane_last_pair_view", """select scenario_id, seq, vehicle_id, cast(max_by(rank, pos) as int) as rank,
  cast(max_by(wait, pos) as int) as wait from sides group by scenario_id, seq, vehicle_id""", "sides")
cte("unknown", "select scenario_id, bool_or(m = 'unknown') as any_unknown from m group by scenario_id", "m")
cte("lc", """select scenario_id, count(*) as c, string_agg(vehicle1_id || '-' || vehicle2_id, ',' order by seq1, seq2) as pairs, string_agg('Potential conflict: Vehicle ' || loser_id || ' must yield to Vehicle ' || winner_id,
  '; ' order by seq1, seq2) as decisions from lr group by scenario_id""", "lr")
cte("whole", """select l.scenario_id, l.is_conflict, cast(coalesce(c.c, 0) as int) as number_of_conflicts, u.any_unknown,
  case when c.c > 0 then 'intersection' else '' end as places_of_conflicts, coalesce(c.pairs, '') as conflict_vehicles,
  coalesce(c.decisions, '') as decisions, coalesce(p.priority_order, '') as priority_order, coalesce(p.waiting_times, '') as waiting_times
  from labels l join unknown u using (scenario_id) left join lc c using (scenario_id)
  left join (select scenario_id, string_agg(vehicle_id || ':' || rank, ',' order by vehicle_id) as priority_order,
    string_agg(vehicle_id || ':' || wait, ',' order by vehicle_id) as waiting_times from pw group by scenario_id) p using (scenario_id)""",
    "labels", "unknown", "lc", "pw")
define("lane_decisions", "select * from whole", "whole")
define("lane_override", """select w.* replace (case when any_unknown then given_label else is_conflict end as is_conflict)
  from whole w join given using (scenario_id)""", "whole", "given")


def fallback_sql(first: str, second: str) -> str:
    """The fallback's columns for a scenario of ``n`` vehicles with label ``given_label``."""
    pair = "given_label = 'yes' and n > 1"
    return f"""given_label as is_conflict, case when given_label = 'yes' then 1 else 0 end as number_of_conflicts,
  case when {pair} then {first} || '-' || {second} else '' end as conflict_vehicles,
  case when {pair} then 'Potential conflict: Vehicle ' || {second} || ' must yield to Vehicle ' || {first} else '' end as decisions,
  '' as priority_order, '' as waiting_times"""


FALLBACK = fallback_sql("'V1001'", "'V1002'")
define("lane_fallback", f"select scenario_id, {FALLBACK} from sc join given using (scenario_id)", "sc", "given")
# vehicles under ids that repeat: pairs keep their places, names change
cte("renamed", "select * replace (direction || destination as vehicle_id) from m", "m")
cte("rr", """select lr.* replace (a.vehicle_id as vehicle1_id, b.vehicle_id as vehicle2_id,
    case when winner_seq = seq1 then a.vehicle_id else b.vehicle_id end as winner_id,
    case when winner_seq = seq1 then b.vehicle_id else a.vehicle_id end as loser_id)
  from lr join renamed a on a.scenario_id = lr.scenario_id and a.seq = seq1 join renamed b on b.scenario_id = lr.scenario_id and b.seq = seq2""",
    "lr", "renamed")
cte("rw", """select scenario_id, id, min_by(case when goes then 1 else 2 end, pos) as rank, max(case when goes then 0 else wait end) as wait
  from (select distinct scenario_id, unnest([vehicle1_id, vehicle2_id]) as id, seq1 * 100 + seq2 as pos, wait, winner_id, loser_id from rr)
    cross join lateral (select winner_id = id and loser_id <> id as goes) group by 1, 2""", "rr")
define("decisions_with_repeated_ids", """select sc.scenario_id, coalesce(l.o, '') as lane_order, coalesce(l.w, '') as lane_waits, n.o as near_order, n.w as near_waits
  from sc left join (select scenario_id, string_agg(id || ':' || rank, ',' order by id) as o, string_agg(id || ':' || wait, ',' order by id) as w
    from rw group by 1) l using (scenario_id)
  join (select scenario_id, string_agg(vehicle_id || ':' || rank, ',' order by vehicle_id) as o,
      string_agg(vehicle_id || ':' || coalesce(cast(wait as varchar), 'None'), ',' order by vehicle_id) as w
    from (select scenario_id, r.vehicle_id, arg_max(rank, seq) as rank, arg_max(struct_pack(w := nr.wait), seq).w as wait
      from nr join renamed r using (scenario_id, seq) group by 1, 2) group by 1) n using (scenario_id)""", "sc", "rw", "nr", "renamed")
cte("flawed", """select *, case when scenario_id % 10 = 0 and seq = 1 then 'invalid direction' end as why from renamed""", "renamed")
cte("status", """select scenario_id, coalesce(min(why), case when max(k) > 1 then 'duplicate vehicle_id' when sum(k) < 2 then 'too few vehicles'
    when sum(k) > 20 then 'too many vehicles' end) as error
  from (select scenario_id, vehicle_id, count(*) as k, min(why) as why from flawed group by 1, 2) group by 1""", "flawed")
cte("fine", """select w.* replace (coalesce(c.pairs, '') as conflict_vehicles, coalesce(c.told, '') as decisions, coalesce(o.o, '') as priority_order,
    coalesce(o.w, '') as waiting_times)
  from whole w left join (select scenario_id, string_agg(vehicle1_id || '-' || vehicle2_id, ',' order by seq1, seq2) as pairs,
    string_agg('Potential conflict: Vehicle ' || loser_id || ' must yield to Vehicle ' || winner_id, '; ' order by seq1, seq2) as told from rr group by 1) c
    using (scenario_id)
  left join (select scenario_id, string_agg(id || ':' || rank, ',' order by id) as o, string_agg(id || ':' || wait, ',' order by id) as w
    from rw group by 1) o using (scenario_id)""", "whole", "rr", "rw")
cte("spare", f"""select scenario_id, {fallback_sql("first_id", "second_id")} from (select scenario_id, count(*) as n,
    max(case when seq = 1 then vehicle_id end) as first_id, max(case when seq = 2 then vehicle_id end) as second_id from flawed group by 1)
  join given using (scenario_id)""", "flawed", "given")
define("lane_batch_score", "select s.scenario_id, s.error, " + ", ".join(
    f"case when s.error is null then f.{c} else g.{c} end as {c}"
    for c in ("is_conflict", "number_of_conflicts", "conflict_vehicles", "decisions", "priority_order", "waiting_times")
) + """, case when s.error is null then f.any_unknown end as any_unknown, case when s.error is null then f.places_of_conflicts end as places_of_conflicts
  from status s join fine f using (scenario_id) left join spare g using (scenario_id)""", "status", "fine", "spare")
define("lane_rule_distribution", "select rule_used, count(*) as n from lr group by rule_used", "lr")
define("rule_explanations", """select scenario_id, seq1, seq2, rule_used as priority_rule, winner_id as priority_vehicle, loser_id as yield_vehicle, wait,
  'Vehicle ' || winner_id || ' goes before Vehicle ' || loser_id || ': it ' || case rule_used
    when 'arrival time' then 'arrives more than a second earlier'
    when 'straight priority' then 'goes straight while the other turns'
    when 'right-turn priority' then 'turns right while the other turns left' else 'comes from the right' end as conflict_reason from lr""", "lr")
define("near_pairs", "select * from np", "np")
for name in ("near_priorities", "near_priorities_any_size"):
    define(name, "select scenario_id, seq, vehicle_id, rank, wait, grp = 2 as only_loses from nr", "nr")
define("near_decisions", """select l.scenario_id, l.is_conflict, cast(coalesce(c.c, 0) as int) as number_of_conflicts,
  case when c.c > 0 then 'intersection' else '' end as places_of_conflicts,
  coalesce(t.decisions, '') as decisions, coalesce(c.pairs, '') as conflict_vehicles, t.priority_order, t.waiting_times
  from nlabels l left join (select scenario_id, count(*) as c, string_agg(vehicle1_id || '-' || vehicle2_id, ',' order by seq1, seq2) as pairs
    from np group by 1) c using (scenario_id)
  join (select scenario_id, string_agg('Potential conflict: Vehicle ' || vehicle_id || ' must yield to Vehicle ' || winner_id, '; '
      order by loss_at) filter (where loss_at is not null) as decisions,
    string_agg(vehicle_id || ':' || coalesce(cast(wait as varchar), 'None'), ',' order by vehicle_id) as waiting_times,
    string_agg(vehicle_id || ':' || rank, ',' order by vehicle_id) as priority_order from nr group by scenario_id) t using (scenario_id)""",
       "nlabels", "np", "nr")
define("generator_labels", "select scenario_id, seq, vehicle_id, rank, wait from gl", "gl")
cte("cascade", """select m.scenario_id, m.seq, m.vehicle_id, m.t, q.seq is not null as involved,
  row_number() over (partition by m.scenario_id, q.seq is not null order by m.t, m.seq) as rank
  from m left join (select scenario_id, seq1 as seq from lp union select scenario_id, seq2 from lp) q using (scenario_id, seq)""", "m", "lp")
for name in ("cascade_waits", "cascade_waits_any_size"):
    define(name, """select scenario_id, seq, vehicle_id, cast(case when involved then rank end as int) as rank,
      cast(case when involved then ceil(round(2 * (rank - 1) + lead_t - t, 9)) else 0 end as int) as wait
      from (select *, max(t - 2 * (rank - 1)) over (partition by scenario_id, involved order by t, seq) as lead_t from cascade)""", "cascade")

# --- raw table and validation ---------------------------------------------------

cte("gc", "select scenario_id, count(*) as c, string_agg('{''vehicle1_id'': ''' || vehicle1_id || ''', ''vehicle2_id'': ''' || vehicle2_id || '''}', ', ' order by seq1, seq2) as cv from gp group by 1", "gp")
cte("raw_set", """select m.vehicle_id, m.lane, m.speed, m.distance_to_intersection, m.direction, m.destination,
  case when gc.c > 0 then 'yes' else 'no' end as is_conflict, cast(coalesce(gc.c, 0) as int) as number_of_conflicts,
  case when gc.c > 0 then '[''intersection'']' else '[]' end as places_of_conflicts,
  '[' || coalesce(gc.cv, '') || ']' as conflict_vehicles, x.decisions, x.priority_order, x.waiting_times, m.scenario_id, m.seq, m.d
  from m left join gc using (scenario_id)
  join (select scenario_id,
    '[' || coalesce(string_agg('''Potential conflict: Vehicle ' || vehicle_id || ' must yield to Vehicle ' || winner_id || '''', ', ' order by loss_at)
      filter (where loss_at is not null), '') || ']' as decisions,
    '{' || string_agg('''' || vehicle_id || ''': ' || coalesce(cast(rank as varchar), 'None'), ', ' order by seq) || '}' as priority_order,
    '{' || string_agg('''' || vehicle_id || ''': ' || wait, ', ' order by seq) || '}' as waiting_times
    from gl group by scenario_id) x using (scenario_id)""", "m", "gc", "gl")
define("raw_dataset", "select * exclude (seq, d) from raw_set", "raw_set")
cte("observed", """select case when l_tax > 0 then 'V' || l_linenumber end as vehicle_id, cast(l_linenumber * 2 - 1 as int) as lane,
  l_extendedprice / 400 - 5 as speed, case when l_discount > 0 then l_quantity * 45 end as distance_to_intersection,
  case when l_returnflag = 'A' then 'north' when l_returnflag = 'N' then ' East ' when l_linestatus = 'O' then 'diagonal' end as direction,
  'A' as destination, case when l_returnflag = 'R' then 'maybe' else 'yes' end as is_conflict,
  cast(l_linenumber - 2 as int) as number_of_conflicts, '[]' as places_of_conflicts, '[]' as conflict_vehicles, '[]' as decisions,
  '[]' as priority_order, '[]' as waiting_times, l_orderkey as scenario_id from lineitem""")


def check_sql(checks, row_count: bool) -> str:
    def bad(col, kind, arg):
        if kind == "no_nulls":
            return f"{col} is null"
        if kind == "allowed":
            return f"{col} is null or {col} not in ({', '.join(repr(a) for a in arg)})"
        if kind == "min":
            return f"{col} < {arg}"
        if kind == "max":
            return f"{col} > {arg}"
        return f"{col} < {arg[0]} or {col} > {arg[1]}"

    parts = [f"select '{k}' as check_name, '{c}' as column_name, count(*) filter (where {bad(c, k, a)}) as n_bad from observed" for c, k, a in checks]
    parts.append("select 'required_columns', '*', cast(0 as bigint)")
    if row_count:
        parts.append("select 'row_count', '*', cast(count(*) = 0 as bigint) from observed")
    return "select check_name, column_name, n_bad, n_bad = 0 as passed from (" + "\nunion all ".join(parts) + ")"


define("validation_report", check_sql(schema.CONTRACT, True), "observed")
define("expectation_report", check_sql(schema.EXPECTATIONS, False), "observed")
define("unexpected_values", """select column_name, value, n from (select *, row_number() over (partition by column_name order by value nulls first) as place from (
  select 'direction' as column_name, direction as value, count(*) as n from observed where direction is null or direction not in ('north','south','east','west') group by 2
  union all select 'is_conflict', is_conflict, count(*) from observed where is_conflict not in ('yes','no') group by 2)) where place <= 5""", "observed")
cte("judged", """select *, case when coalesce(vehicle_id, '') = '' then 'empty vehicle_id'
  when speed is null or speed < 0 then 'negative or missing speed'
  when distance_to_intersection is null or distance_to_intersection < 0 then 'negative or missing distance'
  when direction is null or lower(trim(direction)) not in ('north','east','south','west') then 'invalid direction'
  when speed > 200 then 'speed above range' when distance_to_intersection > 2000 then 'distance above range'
  when lane is null or lane < 1 or lane > 10 then 'lane out of range' end as why from observed""", "observed")
define("request_contract", """select scenario_id, cast(sum(n) as bigint) as n_vehicles, cast(sum(bad) as bigint) as n_bad,
  cast(sum(case when n > 1 then 1 else 0 end) as bigint) as n_duplicate_ids,
  case when min(why) is not null then min(why) when sum(case when n > 1 then 1 else 0 end) > 0 then 'duplicate vehicle_id'
    when sum(n) < 2 then 'too few vehicles' when sum(n) > 20 then 'too many vehicles' end as reason
  from (select scenario_id, vehicle_id, count(*) as n, count(why) as bad, min(why) as why from judged group by 1, 2) group by scenario_id""", "judged")
define("duplicate_ids", "select scenario_id, vehicle_id, count(*) as n from observed where vehicle_id is not null group by 1, 2 having count(*) > 1", "observed")
define("vehicle_quarantine", "select coalesce(why, 'fine') as reason, count(*) as n from judged group by 1", "judged")

# --- features -------------------------------------------------------------------

define("scenario_features", """select scenario_id, round(avg(speed), 6) as avg_speed_in_scenario, round(max(speed), 6) as max_speed_in_scenario,
  count(*) as num_vehicles_in_scenario, round(avg(distance_to_intersection), 6) as avg_distance_in_scenario from raw_rows group by scenario_id""", "raw_rows")
cte("enc", """select r.*, r.d as direction_enc, case when r.is_conflict = 'yes' then 1 else 0 end as conflict_label,
  gl.wait as vehicle_waiting_time, coalesce(gl.rank, 99) as vehicle_priority from raw_set r join gl using (scenario_id, seq)""", "raw_set", "gl")
define("encoded_features", "select scenario_id, vehicle_id, direction_enc, conflict_label, vehicle_waiting_time, vehicle_priority from enc", "enc")
define("feature_table", """select e.lane, round(e.speed, 6) as speed, round(e.distance_to_intersection, 6) as distance_to_intersection, e.direction,
  e.number_of_conflicts, e.direction_enc, e.conflict_label, e.vehicle_waiting_time, e.vehicle_priority,
  round(avg(speed) over w, 6) as avg_speed_in_scenario, round(max(speed) over w, 6) as max_speed_in_scenario,
  count(*) over w as num_vehicles_in_scenario, round(avg(distance_to_intersection) over w, 6) as avg_distance_in_scenario
  from enc e window w as (partition by scenario_id)""", "enc")
define("scaler_parameters", " union all ".join(
    f"select '{c}' as \"column\", round(avg({e}), 4) as mean, round(case when stddev_pop({e}) = 0 then 1 else stddev_pop({e}) end, 4) as scale from m"
    for c, e in [("lane", "lane"), ("speed", "speed"), ("distance_to_intersection", "distance_to_intersection"), ("direction_enc", "d")]), "m")
define("scaled_features", """select scenario_id, seq, round((lane - a1) / s1, 4) as lane, round((speed - a2) / s2, 4) as speed,
  round((distance_to_intersection - a3) / s3, 4) as distance_to_intersection from m,
  (select avg(lane) a1, stddev_pop(lane) s1, avg(speed) a2, stddev_pop(speed) s2, avg(distance_to_intersection) a3,
   stddev_pop(distance_to_intersection) s3 from m)""", "m")
define("python_literal_maps", "select scenario_id, vehicle_id, rank, wait from gl", "gl")
define("asof_features", """select l.event_id, l.user_id, cast(case when f.ts >= l.ts - interval 2 days then f.ts end as varchar) as feature_ts,
  case when f.ts >= l.ts - interval 2 days then f.value end as feature_value
  from (select * from events where event_type = 'purchase') l
  asof left join (select * from events where event_type <> 'purchase') f on l.user_id = f.user_id and l.ts >= f.ts""")
define("latest_features", """select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id
  order by ts desc, event_id desc) as rn from events) where rn = 1""")
define("materialised_features", """select user_id, event_id, value from (select *, row_number() over (partition by user_id
  order by ts desc, event_id desc) as rn from events where ts <= timestamp '2024-01-20') where rn = 1""")

# --- samples ----------------------------------------------------------------------

define("class_balance", """select count(*) filter (where is_conflict = 'yes') as n_yes, count(*) filter (where is_conflict = 'no') as n_no, count(*) as n,
  round(least(count(*) filter (where is_conflict = 'yes'), count(*) filter (where is_conflict = 'no')) / count(*)::double, 4) as minority_ratio,
  least(count(*) filter (where is_conflict = 'yes'), count(*) filter (where is_conflict = 'no')) / count(*)::double >= 0.4::double as balanced from labels""", "labels")
for name in ("balanced_sample", "equal_class_sample"):
    define(name, """select scenario_id, is_conflict from (select *, row_number() over (partition by is_conflict
      order by md5('42|' || scenario_id), scenario_id) as rn from labels) where rn <= 25""", "labels")
define("sample_overall", "select scenario_id, is_conflict from labels order by md5('42|' || scenario_id), scenario_id limit 50", "labels")
define("sample_per_group", """select scenario_id, n as n_vehicles from (select *, row_number() over (partition by n
  order by md5('42|' || scenario_id), scenario_id) as rn from sc) where rn <= 20""", "sc")
define("undersample", """select scenario_id, is_conflict from (select *, row_number() over (partition by is_conflict
  order by md5('42|' || scenario_id), scenario_id) as rn from nlabels)
  where is_conflict = 'yes' or rn <= (select count(*) from nlabels where is_conflict = 'yes')""", "nlabels")
define("hash_split", f"""select scenario_id, is_conflict, case when u < 0.70::double then 'train' when u < 0.85::double then 'val' else 'test' end as split
  from (select *, {hash32("'42|' || scenario_id")} / 4294967296::double as u from labels)""", "labels")
define("stratified_split", """select scenario_id, is_conflict, case when idx < floor(c * 0.70::double) then 'train' when idx < floor(c * 0.85::double) then 'val' else 'test' end as split
  from (select *, row_number() over (partition by is_conflict order by md5('42|' || scenario_id), scenario_id) - 1 as idx,
    count(*) over (partition by is_conflict) as c from labels)""", "labels")
cte("keys", """select scenario_id, o_orderstatus as s, string_agg(lane || ',' || destination, ';' order by seq) as key
  from m join orders on o_orderkey = scenario_id group by 1, 2""", "m")
define("leakage_anti_join", "select scenario_id from keys where s = 'P' and key not in (select key from keys where s <> 'P')", "keys")
define("leakage_overlap", "select count(*) as n_leaked from keys where s = 'P' and key in (select key from keys where s <> 'P')", "keys")
define("semi_join_vehicles", """select scenario_id, seq, vehicle_id from raw_rows where scenario_id in
  (select scenario_id from labels where is_conflict = 'yes')""", "labels")
cte("content", """select scenario_id, string_agg(concat_ws(',', vehicle_id, lane, speed, distance_to_intersection, direction, destination), ';' order by seq) as key
  from m group by 1""", "m")
define("first_scenarios", "select scenario_id, is_conflict from labels order by scenario_id limit 50", "labels")
define("data_gates", f"""select 'balance' as gate, minority_ratio as measure, balanced as passed from ({ORACLE_BODY['class_balance']})
  union all select 'leakage', n_leaked::double, n_leaked = 0 from ({ORACLE_BODY['leakage_overlap']})
  union all select 'validation', (count(*) filter (where not passed))::double, count(*) filter (where not passed) = 0
  from ({ORACLE_BODY['validation_report']})""", "labels", "keys", "observed")
define("balanced_supplement", """, allc as (select * from labels join content using (scenario_id)),
  eight as (select * from allc where n = 8),
  used as (select * from allc order by md5('7|' || scenario_id), scenario_id limit 50),
  extra as (select *, row_number() over (order by md5('999|' || scenario_id), scenario_id) as rn from allc
    where key not in (select key from eight) and key not in (select key from used))
  select scenario_id, is_conflict from eight union all
  select scenario_id, is_conflict from extra where rn <= 400 - (select count(*) from eight)""", "labels", "content")


def slot(text: str) -> str:
    """The 128-bit md5 of ``text`` modulo 100, from its four 32-bit groups."""
    return "(" + " + ".join(f"{hash32_at(text, g)} * {w}" for g, w in enumerate([36, 16, 96, 1])) + ") % 100"


AB_ORDER, AB_SCENARIO = "'ab_scenario_' || o_orderkey", "'ab_scenario_' || scenario_id"
define("ab_route", f"""select o_orderkey as scenario_id, cast({slot(AB_ORDER)} as int) as slot,
  case when {slot(AB_ORDER)} < 15 then 'A' else 'B' end as routed_to from orders""")
define("ab_outcome_summary", f""", sent as (select *, case when {slot(AB_SCENARIO)} < 15 then 'A' else 'B' end as routed_to from predictions)
  select variant, count(*) as n, round(avg(case when true_label = predicted_label then 1 else 0 end), 6) as accuracy
  from sent where variant = routed_to group by variant""", "predictions")

# --- texts -----------------------------------------------------------------------

SENTENCE = """'Vehicle ' || vehicle_id || ' is in lane ' || lane || ', moving ' || direction || ' at a speed of ' || printf('%.2f', speed) ||
  ' km/h, and is ' || printf('%.2f', distance_to_intersection) || ' meters away from the intersection, heading towards ' || destination || '.'"""
cte("texts", f"select scenario_id, string_agg({SENTENCE}, ' ' order by seq) as text from m group by scenario_id", "m")
define("scenario_text", "select * from texts", "texts")
define("report_text", """select scenario_id, string_agg('Vehicle ' || vehicle_id || ' is in lane ' || lane || ', approaching from the ' || direction ||
  ', traveling at ' || printf('%.2f', speed) || ' km/h, and is ' || printf('%.2f', distance_to_intersection) ||
  ' meters away from the intersection, heading towards ' || destination || '.', chr(10) order by seq) as text from m group by scenario_id""", "m")
define("arrival_text", """select scenario_id, string_agg('Vehicle ' || vehicle_id || ': lane=' || lane || ', dir=' || direction || ', dest=' || destination ||
  ', speed=' || printf('%.1f', speed) || 'km/h, dist=' || printf('%.1f', distance_to_intersection) || 'm, ETA=' ||
  printf('%.2f', distance_to_intersection / greatest(speed * 1000 / 3600, 0.1::double)) || 's', chr(10) order by seq) as text from m group by scenario_id""", "m")
define("analysis_text", """select l.scenario_id, case when l.is_conflict = 'no' then 'No conflict detected.' else
  'Conflict detected.' || chr(10) || 'Number of conflicts: ' || c.c || chr(10) || 'Involved vehicles: ' || c.inv || '.' || chr(10) ||
  'Actions & Decisions:' || chr(10) || c.dec || chr(10) || 'Priority Order:' || chr(10) || p.ranks || chr(10) || 'Waiting Times:' || chr(10) || p.waits end as text
  from labels l left join (select scenario_id, count(*) as c,
    string_agg('Vehicle ' || vehicle1_id || ' and Vehicle ' || vehicle2_id, ', ' order by seq1, seq2) as inv,
    string_agg('Potential conflict: Vehicle ' || loser_id || ' must yield to Vehicle ' || winner_id, chr(10) order by seq1, seq2) as dec
    from lr group by scenario_id) c using (scenario_id)
  left join (select scenario_id, string_agg('Vehicle ' || vehicle_id || ': Priority ' || rank, chr(10) order by seq) as ranks,
    string_agg('Vehicle ' || vehicle_id || ': ' || wait || ' second(s)', chr(10) order by seq) as waits from pw group by scenario_id) p using (scenario_id)""",
       "labels", "lr", "pw")
QUESTION = C.CHAT_QUESTION.replace("'", "''")
SYSTEM = training_sets.layout_prompt().replace("'", "''")
ASKED = f"'system: {SYSTEM}' || chr(10) || 'user: {QUESTION}' || t.text"
cte("jv", """select scenario_id, '[' || string_agg('{"vehicle_id":"' || vehicle_id || '","lane":' || lane || ',"speed":' || speed || ',"distance_to_intersection":' ||
  distance_to_intersection || ',"direction":"' || direction || '","destination":"' || destination || '"}', ',' order by seq) || ']' as vehicles from m group by scenario_id""", "m")
cte("vt", """select scenario_id, string_agg(concat_ws(' ', vehicle_id, lane, speed, distance_to_intersection, direction, destination), ';' order by seq) as vehicles
  from m group by scenario_id""", "m")
define("chat_records", f"select l.scenario_id, {ASKED} || chr(10) || 'assistant: ' || l.is_conflict as messages from labels l join texts t using (scenario_id)", "labels", "texts")
define("chat_lines", f"select {ASKED} || chr(10) || 'assistant: ' || l.is_conflict as messages from labels l join texts t using (scenario_id)", "labels", "texts")
define("zero_shot_prompts", f"select scenario_id, 'zero-shot' as mode, {ASKED} as messages from texts t", "texts")
define("decision_chat_records", """select l.scenario_id, 'system: Resolve the scenario.' || chr(10) || 'user: {"vehicles":' || jv.vehicles || '}' || chr(10) ||
  'assistant: {"is_conflict":"' || l.is_conflict || '","number_of_conflicts":' || coalesce(c.c, 0) || ',"conflict_vehicles":[' || coalesce(c.pairs, '') ||
  '],"decisions":[' || coalesce(c.told, '') || '],"priority_order":{' || coalesce(p.ranks, '') || '},"waiting_times":{' || coalesce(p.waits, '') || '}}' as messages
  from labels l join jv using (scenario_id)
  left join (select scenario_id, count(*) as c,
    string_agg('{"vehicle1_id":"' || vehicle1_id || '","vehicle2_id":"' || vehicle2_id || '"}', ',' order by seq1, seq2) as pairs,
    string_agg('"Potential conflict: Vehicle ' || loser_id || ' must yield to Vehicle ' || winner_id || '"', ',' order by seq1, seq2) as told
    from lr group by scenario_id) c using (scenario_id)
  left join (select scenario_id, string_agg('"' || vehicle_id || '":' || rank, ',' order by seq) as ranks,
    string_agg('"' || vehicle_id || '":' || wait, ',' order by seq) as waits from pw group by scenario_id) p using (scenario_id)""", "labels", "jv", "lr", "pw")
LITERAL_AS_JSON = "replace(replace(replace(replace({0}, '''', '\"'), '\": ', '\":'), ', ', ','), 'None', 'null')"
define("raw_row_chat_records", f"""select r.scenario_id, 'system: Resolve the scenario.' || chr(10) || 'user: {{"vehicles":[{{"vehicle_id":"' || vehicle_id || '","lane":' || lane ||
  ',"speed":' || speed || ',"distance_to_intersection":' || distance_to_intersection || ',"direction":"' || direction || '","destination":"' || destination ||
  '"}}]}}' || chr(10) || 'assistant: {{"is_conflict":"' || is_conflict || '","number_of_conflicts":' || number_of_conflicts || ',"conflict_vehicles":' ||
  {LITERAL_AS_JSON.format("conflict_vehicles")} || ',"decisions":' || {LITERAL_AS_JSON.format("decisions")} || ',"priority_order":' ||
  {LITERAL_AS_JSON.format("priority_order")} || ',"waiting_times":' || {LITERAL_AS_JSON.format("waiting_times")} || '}}' as messages from raw_set r""", "raw_set")
define("few_shot_prompts", f"""select scenario_id, 'few-shot' as mode, 'system: {SYSTEM}' || chr(10) || 'user: Vehicle V1 alone.' || chr(10) || 'assistant: no' ||
  chr(10) || 'user: Vehicles V1 and V2 meet.' || chr(10) || 'assistant: yes' || chr(10) || 'user: {QUESTION}' || t.text as messages from texts t""", "texts")
# --- metrics -------------------------------------------------------------------------

CONF = """count(*) filter (where true_label = 'yes' and predicted_label = 'yes') as tp,
  count(*) filter (where true_label = 'yes' and predicted_label <> 'yes') as fn,
  count(*) filter (where true_label <> 'yes' and predicted_label = 'yes') as fp,
  count(*) filter (where true_label <> 'yes' and predicted_label <> 'yes') as tn"""
ACC = "case when tp + tn + fp + fn > 0 then (tp + tn) / (tp + tn + fp + fn)::double else 0 end"
PREC = "case when tp + fp > 0 then tp / (tp + fp)::double else 0 end"
REC = "case when tp + fn > 0 then tp / (tp + fn)::double else 0 end"
F1 = "case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double else 0 end"
FNR0, FNR1 = "fn / (fn + tp + 1e-9)", f"1 - ({REC})"


def scores(fnr: str) -> str:
    named = {"accuracy": ACC, "precision": PREC, "recall": REC, "f1": F1, "fnr": fnr}
    return ", ".join(f"round({e}, 4) as \"{n}\"" for n, e in named.items())


define("predictions", "select * replace (cast(ts as varchar) as ts) from predictions", "predictions")
define("confusion_by_variant", f"select variant, {CONF} from predictions group by variant", "predictions")
define("variant_metrics", f"""select variant, n, {scores(FNR0)}, json_validity_rate, fallback_rate, rule_disagree_rate, conflict_rate_true, conflict_rate_pred
  from (select variant, count(*) as n, {CONF}, round(avg(case when json_valid then 1 else 0 end), 4) as json_validity_rate,
    round(avg(case when json_valid then 0 else 1 end), 4) as fallback_rate,
    round(avg(case when predicted_label <> rule_label then 1 else 0 end), 4) as rule_disagree_rate,
    round(avg(case when true_label = 'yes' then 1 else 0 end), 4) as conflict_rate_true,
    round(avg(case when predicted_label = 'yes' then 1 else 0 end), 4) as conflict_rate_pred from predictions group by variant)""", "predictions")
define("fnr_two_ways", f"""select variant, num_vehicles, tp + fn as n_positive, round({FNR1}, 4) as fnr_offline, round({FNR0}, 4) as fnr_online
  from (select variant, num_vehicles, {CONF} from predictions group by 1, 2)""", "predictions")
define("latency_percentiles", """select variant, round(quantile_cont(latency_ms, 0.5), 1) as p50, round(quantile_cont(latency_ms, 0.95), 1) as p95
  from predictions group by variant""", "predictions")
define("recall_by_size", f"""select v.variant, b.band, round(coalesce({REC}, 0), 4) as recall
  from (select distinct variant from predictions) v cross join (values ('small (2-4)'), ('large (5-8)')) b(band)
  left join (select variant, case when num_vehicles <= 4 then 'small (2-4)' else 'large (5-8)' end as band, {CONF} from predictions group by 1, 2) c
  on c.variant = v.variant and c.band = b.band""", "predictions")
cte("typed", """select *, 'mixed' as scenario_type from predictions union all select *, '4-vehicle' from predictions where num_vehicles = 4
  union all select *, '8-vehicle' from predictions where num_vehicles = 8""", "predictions")
define("variant_type_grid", f"select variant, scenario_type, tp, fn, fp, tn, {scores(FNR1)} from (select variant, scenario_type, {CONF} from typed group by 1, 2)", "typed")
define("variant_averages", f"""select variant, round(avg({ACC}), 4) as avg_accuracy, round(avg({F1}), 4) as avg_f1, round(avg({FNR1}), 4) as avg_fnr
  from (select variant, scenario_type, {CONF} from typed group by 1, 2) group by variant""", "typed")
define("normalised_confusion", f"""select variant, round(tp / greatest(1, tp + fn)::double, 4) as tp_share, round(fn / greatest(1, tp + fn)::double, 4) as fn_share,
  round(fp / greatest(1, fp + tn)::double, 4) as fp_share, round(tn / greatest(1, fp + tn)::double, 4) as tn_share
  from (select variant, {CONF} from predictions group by variant)""", "predictions")
define("rule_agreement", """select variant, count(rule_label) as n, round(avg(case when predicted_label = rule_label then 1 else 0 end), 4) as rule_agreement_rate
  from predictions group by variant""", "predictions")
define("two_predictor_agreement", """select count(*) as n, count(*) filter (where a.predicted_label = a.true_label) as first_pass,
  count(*) filter (where b.predicted_label = a.true_label) as second_pass, cast(0 as bigint) as not_comparable,
  count(*) filter (where a.predicted_label = b.predicted_label) as agree
  from predictions a join predictions b on a.scenario_id = b.scenario_id and a.variant = 'A' and b.variant = 'B'""", "predictions")
define("ab_winner", """select round(a, 4) as accuracy_a, round(b, 4) as accuracy_b, case when b > a then 'B' else 'A' end as winner from (
  select avg(case when variant = 'A' then case when true_label = predicted_label then 1 else 0 end end) as a,
    avg(case when variant = 'B' then case when true_label = predicted_label then 1 else 0 end end) as b from predictions)""", "predictions")
define("score_summary", f"""select variant, {scores(FNR1)}, avg_latency_ms, error_rate from (select variant, {CONF},
  round(avg(latency_ms) filter (where predicted_label is not null), 2) as avg_latency_ms,
  round(avg(case when predicted_label is null then 1 else 0 end), 4) as error_rate
  from (select * replace (case when json_valid then predicted_label end as predicted_label) from predictions) group by variant)""", "predictions")
define("wait_mae", """select sc.scenario_id, round(coalesce(avg(abs(nr.wait - pw.wait)) filter (where pw.seq is not null), 0), 6) as wt_mae
  from sc left join pw using (scenario_id) left join (select scenario_id, seq, coalesce(wait, 0) as wait from nr) nr
  on nr.scenario_id = pw.scenario_id and nr.seq = pw.seq group by sc.scenario_id""", "sc", "pw", "nr")
cte("mw", "select scenario_id, avg(wait) as mean_wait from pw group by scenario_id", "pw")
define("mean_wait_per_scenario", "select scenario_id, round(mean_wait, 6) as mean_wait from mw", "mw")
define("wait_histogram", """select cast(least(11, floor((mean_wait - lo) / ((hi - lo) / 12))) as int) as bin, count(*) as n, round(any_value(mean), 4) as mean
  from mw, (select min(mean_wait) as lo, max(mean_wait) as hi, avg(mean_wait) as mean from mw) group by 1""", "mw")
define("scenario_sizes", "select scenario_id, seq, count(*) over (partition by scenario_id) as n_vehicles from raw_rows", "raw_rows")

# --- windows -------------------------------------------------------------------------

define("rolling_accuracy", """select variant, scenario_id, cast(row_number() over w - 1 as bigint) as idx,
  round(avg(case when true_label = predicted_label then 1 else 0 end) over (w rows between 9 preceding and current row), 4) as rolling_accuracy
  from predictions window w as (partition by variant order by ts, scenario_id)""", "predictions")
define("rolling_fnr", """select variant, scenario_id, cast(row_number() over w - 1 as bigint) as idx,
  round(sum(case when true_label = 'yes' and predicted_label <> 'yes' then 1 else 0 end) over (w rows between 9 preceding and current row)
    / (sum(case when true_label = 'yes' then 1 else 0 end) over (w rows between 9 preceding and current row) + 1e-9), 4) as rolling_fnr
  from predictions window w as (partition by variant order by ts, scenario_id)""", "predictions")
define("running_metrics", f"""select variant, scenario_id, step, {scores(FNR1)} from (select variant, scenario_id, row_number() over w as step,
  sum(case when true_label = 'yes' and predicted_label = 'yes' then 1 else 0 end) over w as tp,
  sum(case when true_label = 'yes' and predicted_label <> 'yes' then 1 else 0 end) over w as fn,
  sum(case when true_label <> 'yes' and predicted_label = 'yes' then 1 else 0 end) over w as fp,
  sum(case when true_label <> 'yes' and predicted_label <> 'yes' then 1 else 0 end) over w as tn
  from predictions window w as (partition by variant order by ts, scenario_id))""", "predictions")
define("last_n_window", "select event_id, user_id from pe order by ts desc, event_id desc limit 100", "pe")
define("last_n_per_user", """select user_id, event_id from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from pe)
  where rn <= 5""", "pe")

# --- audit ------------------------------------------------------------------------------

cte("audit", """select l.scenario_id, l.is_conflict as true_label,
  case when (l.is_conflict = 'yes') <> (l.scenario_id % 11 = 0) then 'yes' else 'no' end as predicted_label,
  case when (l.is_conflict = 'yes') <> (l.scenario_id % 11 = 0) then 0 else coalesce(mw.mean_wait, 0) end as wait_error,
  f.direction, case when f.lane % 2 = 0 then 'left-turn' else 'straight' end as parity,
  case when l.n <= 4 then 'small (2-4)' else 'large (5-8)' end as size,
  case when f.speed > 0 and f.speed <= 40 then 'slow (<40)' when f.speed > 40 and f.speed <= 70 then 'medium (40-70)' when f.speed > 70 then 'fast (>70)' end as speed,
  case when f.distance_to_intersection <= 50 then 'near (<50m)' when f.distance_to_intersection <= 150 then 'mid (50-150m)' else 'far (>150m)' end as distance,
  case when coalesce(gc.c, 0) = 0 then 'no conflict' when gc.c = 1 then 'single' else 'multi (2+)' end as density
  from labels l join m f on f.scenario_id = l.scenario_id and f.seq = 1 left join mw on mw.scenario_id = l.scenario_id
  left join gc on gc.scenario_id = l.scenario_id""", "labels", "m", "mw", "gc")
cte("tall", " union all ".join(
    f"select '{n}' as dimension, {c} as grp, true_label, predicted_label, wait_error from audit" for n, c in [
        ("direction", "direction"), ("lane_parity", "parity"), ("vehicle_count", "size"), ("movement_type", "parity"),
        ("speed_range", "speed"), ("distance_range", "distance"), ("conflict_density", "density")]), "audit")
cte("groups", f"""select dimension, grp, n, {scores(FNR0)}, wt_mae_s, conflict_rate_true, conflict_rate_pred from (select dimension, grp, count(*) as n, {CONF},
  round(avg(wait_error), 4) as wt_mae_s, round(avg(case when true_label = 'yes' then 1 else 0 end), 4) as conflict_rate_true,
  round(avg(case when predicted_label = 'yes' then 1 else 0 end), 4) as conflict_rate_pred from tall where grp is not null group by 1, 2)""", "tall")
define("subgroup_metrics", "select * from groups", "groups")
define("subgroup_disparity", """select *, f1_disparity > 0.15::double as bias_detected, fnr_disparity > 0.15::double as safety_bias_detected from (
  select dimension, count(*) as n_groups, round(max(f1) - min(f1), 4) as f1_disparity, round(max(fnr) - min(fnr), 4) as fnr_disparity,
  round(max(accuracy) - min(accuracy), 4) as accuracy_disparity, round(avg(wt_mae_s), 4) as mean_wt_mae_s from groups group by dimension)""", "groups")

# --- what-if --------------------------------------------------------------------------------


def shift_sql(feature: str, new_t: str, deltas: list[int]) -> str:
    values = ", ".join(f"({x})" for x in deltas)
    return f"""select l.scenario_id, '{feature}' as feature, cast(k.delta as varchar) as delta, l.is_conflict as base_pred,
  case when h.scenario_id is null then 'no' else 'yes' end as perturbed_pred,
  (l.is_conflict = 'yes') <> (h.scenario_id is not null) as changed, l.n as n_vehicles
  from labels l cross join (values {values}) k(delta) left join (
    select distinct a.scenario_id, a.delta from (select m.*, delta, {new_t} as t2 from m, (values {values}) x(delta)) a
    join (select m.*, delta, {new_t} as t2 from m, (values {values}) x(delta)) b
      on a.scenario_id = b.scenario_id and a.delta = b.delta and a.seq < b.seq
    where {cross('a.d', 'a.m', 'b.d', 'b.m')} and {close('a.t2', 'b.t2')}) h
  on h.scenario_id = l.scenario_id and h.delta = k.delta"""


NEW_SPEED_T = "distance_to_intersection / (greatest(5.0::double, speed + delta) * 1000 / 3600)"
NEW_DIST_T = "case when speed > 0 then greatest(5.0::double, distance_to_intersection + delta) / (speed * 1000 / 3600) end"
cte("ps", shift_sql("speed", NEW_SPEED_T, C.SPEED_DELTAS), "labels", "m")
cte("pd", shift_sql("distance", NEW_DIST_T, C.DISTANCE_DELTAS), "labels", "m")
cte("reach", """select * from (values (1,'F','right'),(1,'H','straight'),(2,'E','left'),(2,'D','left'),(2,'C','left'),(3,'H','right'),(3,'B','straight'),
  (4,'G','left'),(4,'E','left'),(4,'F','left'),(5,'B','right'),(5,'D','straight'),(6,'A','left'),(6,'G','left'),(6,'H','left'),
  (7,'D','right'),(7,'F','straight'),(8,'B','left'),(8,'C','left'),(8,'A','left')) r(lane, destination, m)""")
cte("dests", """select d, unnest(string_split(l, '')) as dest, generate_subscripts(string_split(l, ''), 1) as place
  from (values (0, 'FHEDC'), (1, 'HBGEF'), (2, 'BDAGH'), (3, 'DFBCA')) x(d, l)""")
# one changed vehicle at a time: its key, the new movement and arrival
cte("alt_lane", """select m.*, 'lane' as feature, cast(seq - 1 as varchar) as delta, coalesce(r.m, 'unknown') as m2, t as t2
  from m left join reach r on r.lane = case when m.lane % 2 = 1 then m.lane + 1 else m.lane - 1 end and r.destination = m.destination""", "m", "reach")
cte("alt_dest", """select m.*, 'destination' as feature, cast(k.rn - 1 as varchar) as delta, coalesce(r.m, 'unknown') as m2, t as t2
  from m join (select m.scenario_id, m.seq, dests.dest, row_number() over (partition by m.scenario_id, m.seq order by dests.place) as rn
    from m join dests on dests.d = m.d and dests.dest <> m.destination) k on k.scenario_id = m.scenario_id and k.seq = m.seq and k.rn <= 3
  left join reach r on r.lane = m.lane and r.destination = k.dest""", "m", "dests", "reach")


def single_sql(alts: str) -> str:
    return f"""select a.scenario_id, a.seq, a.feature, a.delta, l.is_conflict as base_pred, l.n as n_vehicles,
  case when coalesce(c.c, 0) - coalesce(o.c, 0) > 0 or coalesce(bool_or({cross('a.d', 'a.m2', 'b.d', 'b.m')} and {close('a.t2', 'b.t')}), false)
    then 'yes' else 'no' end as perturbed_pred
  from ({alts}) a join labels l using (scenario_id) left join m b on b.scenario_id = a.scenario_id and b.seq <> a.seq
  left join (select scenario_id, count(*) as c from lp group by 1) c on c.scenario_id = a.scenario_id
  left join (select scenario_id, seq, count(*) as c from (select scenario_id, seq1 as seq from lp union all select scenario_id, seq2 from lp) group by 1, 2) o
    on o.scenario_id = a.scenario_id and o.seq = a.seq
  group by a.scenario_id, a.seq, a.feature, a.delta, l.is_conflict, l.n, c.c, o.c"""


cte("pl", single_sql("select * from alt_lane"), "alt_lane", "labels", "lp", "m")
cte("pdest", single_sql("select * from alt_dest"), "alt_dest", "labels", "lp", "m")


def order_sql(shuffles: int, always_reverse: bool) -> str:
    names = ", ".join(f"('shuffle{k}')" for k in range(1, shuffles + 1))
    return f"""select l.scenario_id, 'vehicle_order' as feature, 'reverse' as delta, l.is_conflict as base_pred, l.is_conflict as perturbed_pred,
  false as changed, l.n as n_vehicles from labels l{'' if always_reverse else ' where l.n > 1'}
  union all
  select l.scenario_id, 'vehicle_order', x.delta, l.is_conflict, l.is_conflict, false, l.n from labels l join (
    select scenario_id, delta from (select scenario_id, delta, seq, row_number() over (partition by scenario_id, delta
      order by md5('7|' || delta || '|' || scenario_id || '|' || seq), seq) as place from m, (values {names}) k(delta))
    group by 1, 2 having bool_or(place <> seq)) x using (scenario_id)"""


cte("po", order_sql(3, False), "labels", "m")
define("perturb_speed", "select * from ps", "ps")
define("perturb_distance", "select * from pd", "pd")
SINGLE = "select scenario_id, feature, delta, base_pred, perturbed_pred, base_pred <> perturbed_pred as changed, n_vehicles from "
define("perturb_lane", SINGLE + "pl", "pl")
define("perturb_destination", SINGLE + "pdest", "pdest")
define("perturb_order", "select * from po", "po")
define("perturb_order_any_predictor", "select * from po", "po")
define("perturb_distance_any_predictor", f"""select l.scenario_id, 'distance' as feature, cast(k.delta as varchar) as delta, l.is_conflict as base_pred,
  case when coalesce(h.c, 0) >= 2 then 'yes' else 'no' end as perturbed_pred, (l.is_conflict = 'yes') <> (coalesce(h.c, 0) >= 2) as changed, sc.n as n_vehicles
  from nlabels l join sc using (scenario_id) cross join (values {', '.join(f'({x})' for x in C.DISTANCE_DELTAS)}) k(delta)
  left join (select scenario_id, delta, count(distinct direction) as c from m, (values {', '.join(f'({x})' for x in C.DISTANCE_DELTAS)}) x(delta)
    where greatest(5.0::double, distance_to_intersection + delta) <= 80 group by 1, 2) h on h.scenario_id = l.scenario_id and h.delta = k.delta""",
       "nlabels", "sc")
cte("recs", "select * from ps union all select * from pd union all " + SINGLE + "pl union all " + SINGLE + "pdest union all select * from po",
    "ps", "pd", "pl", "pdest", "po")
cte("rates", """select feature, delta, cast(count(*) as bigint) as tests, count(*) filter (where changed) as flips,
  round(count(*) filter (where changed) / count(*)::double, 4) as flip_rate from recs group by grouping sets ((feature), (feature, delta))""", "recs")
define("flip_rates", "select * from rates", "rates")
define("flip_rate_by_magnitude", """select feature, abs(cast(delta as int)) as magnitude, count(*) as tests,
  round(avg(case when changed then 1 else 0 end), 4) as flip_rate from ps group by 1, 2""", "ps")
define("stability", "select count(*) as n_features, round(avg(1 - flip_rate), 4) as overall_stability from rates where delta is null", "rates")
define("feature_ranking", """select feature, flip_rate, cast(row_number() over (order by flip_rate desc,
  list_position(['speed','distance','lane','destination','vehicle_order'], feature)) as int) as place from rates where delta is null""", "rates")
define("speed_flip_table", """select 'speed' as feature, '+' || delta || ' km/h' as delta, round(avg(case when changed then 1 else 0 end), 4) as flip_rate,
  '40 km/h → ' || (40 + cast(delta as int)) || ' km/h' as example,
  case when round(avg(case when changed then 1 else 0 end), 4) > 0.5 then 'Yes (flipped)' else 'No (stable)' end as decision_changed
  from ps where delta in ('2','5','10','20','40') group by delta""", "ps")
define("heat_table", """select cast(s.delta as int) as speed_delta, cast(d.delta as int) as distance_delta, round(s.r * d.r, 6) as product
  from (select delta, avg(case when changed then 1 else 0 end) as r from ps group by delta) s
  cross join (select delta, avg(case when changed then 1 else 0 end) as r from pd group by delta) d""", "ps", "pd")
cte("alt_all", f"""select m.*, 'speed' as feature, cast(delta as varchar) as delta, m as m2, {NEW_SPEED_T} as t2 from m, (values {', '.join(f'({x})' for x in C.SPEED_DELTAS)}) k(delta)
  union all select m.*, 'distance', cast(delta as varchar), m, {NEW_DIST_T} from m, (values {', '.join(f'({x})' for x in C.DISTANCE_DELTAS)}) k(delta)
  union all select * from alt_dest
  union all select m.*, 'lane', cast(k.lane as varchar), coalesce(r.m, 'unknown'), t from m
    join (select scenario_id, d as d0 from m where seq = 1) f using (scenario_id)
    join (values (1), (2), (3), (4), (5), (6), (7), (8)) k(lane) on (k.lane - 1) // 2 = f.d0 and k.lane <> m.lane
    left join reach r on r.lane = k.lane and r.destination = m.destination and (r.lane - 1) // 2 = m.d""", "m", "alt_dest", "reach")
cte("psens", single_sql("select * exclude (d0) from (select *, 0 as d0 from alt_all)"), "alt_all", "labels", "lp", "m")
cte("score", f"""select feature, sum(s) / (select count(*) from sc) as v from (
    select scenario_id, feature, avg(case when base_pred <> perturbed_pred then 1 else 0 end) as s from psens group by 1, 2
    union all select scenario_id, 'vehicle_order', 0 from sc) group by feature""", "psens", "sc")
define("sensitivity", """select feature, round(v, 4) as importance, round(round(v, 4) / (select case when max(round(v, 4)) = 0 then 1 else max(round(v, 4)) end from score), 4) as normalised
  from score""", "score")

# --- statistics ------------------------------------------------------------------------------

# erfc(z) by Simpson's rule over 2000 steps of exp(-u^2) on [0, z]; beyond 8 it is 0 for our digits
ERFC = """select 1 - 2 / sqrt(pi()) * sum(case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end * exp(-pow(least(z, 8) * i / 2000.0::double, 2)))
  * least(z, 8) / 6000 as p from z, range(0, 2001) r(i) group by z"""
define("chi_square", f""", c as (select count(*) filter (where variant = 'A' and ok)::double as a, count(*) filter (where variant = 'A' and not ok)::double as b,
    count(*) filter (where variant = 'B' and ok)::double as c, count(*) filter (where variant = 'B' and not ok)::double as d
    from (select variant, true_label = predicted_label as ok from predictions)),
  x as (select (a + b + c + d) * pow(greatest(0, abs(a * d - b * c) - (a + b + c + d) / 2), 2) / ((a + b) * (c + d) * (a + c) * (b + d)) as chi2 from c),
  z as (select sqrt(chi2 / 2) as z from x), p as ({ERFC})
  select round(chi2, 4) as chi2, round(p, 4) as p_value, p < 0.05 as significant from x, p""", "predictions")
define("mann_whitney_u", f""", v as (select variant, latency_ms as x from predictions),
  r as (select variant, rank() over (order by x) + (count(*) over (partition by x) - 1) / 2.0::double as rk from v),
  n as (select count(*) filter (where variant = 'A')::double as n1, count(*) filter (where variant = 'B')::double as n2,
    sum(rk) filter (where variant = 'A') as r1 from r),
  t as (select sum(c * c * c - c) as ties from (select count(*)::double as c from v group by x)),
  u as (select n1, n2, r1 - n1 * (n1 + 1) / 2 as u1, sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) as sd from n, t),
  zz as (select *, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5::double) / sd as zv from u),
  z as (select zv / sqrt(2) as z from zz), p as ({ERFC})
  select cast(n1 as bigint) as n1, cast(n2 as bigint) as n2, u1 as u, round(zv, 4) as z, round(least(1, p), 4) as p_value from zz, p""", "predictions")
cte("two", """select r.lane, case when o_orderstatus = 'P' then r.speed * 1.05::double else r.speed end as speed, r.distance_to_intersection, o_orderstatus <> 'P' as ref
  from raw_rows r join orders on o_orderkey = r.scenario_id""", "raw_rows")
cte("cells", "select 'lane' as col, lane::double as v, ref from two union all select 'speed', speed, ref from two union all select 'distance_to_intersection', distance_to_intersection, ref from two", "two")
cte("ks", """select col, n1 as n_ref, n2 as n_prod, max(abs(c1 / n1::double - c2 / n2::double)) as d from (
    select col, v, sum(r) over (partition by col order by v) as c1, sum(p) over (partition by col order by v) as c2,
      sum(r) over (partition by col) as n1, sum(p) over (partition by col) as n2 from (
      select col, v, count(*) filter (where ref) as r, count(*) filter (where not ref) as p from cells group by 1, 2)) group by 1, 2, 3""", "cells")
cte("ksp", """select *, case when x < 0.2 then 1 else least(1, greatest(0, (select 2 * sum(case when k % 2 = 1 then 1 else -1 end * exp(-2.0::double * k * k * x * x)) from range(1, 101) r(k)))) end as p
  from (select *, sqrt(n_ref::double * n_prod / (n_ref + n_prod)) * d as x from ks)""", "ks")
define("ks_statistic", """select col as "column", cast(n_ref as bigint) as n_ref, cast(n_prod as bigint) as n_prod, round(d, 6) as statistic,
  round(p, 4) as p_value, p < 0.05 as drifted from ksp""", "ksp")
define("drift_flags", """, f as (select count(*) as n_tested, count(*) filter (where p < 0.05) as n_drifted,
  count(*) filter (where p < 0.05) / count(*)::double as part from ksp)
  select n_tested, n_drifted, round(part, 4) as drift_share, n_drifted > 0 as drift_detected, 'any' as rule from f
  union all select n_tested, n_drifted, round(part, 4), part > 0.2::double, 'share' from f""", "ksp")

# --- monitoring ---------------------------------------------------------------------------------


def trigger_sql(source: str, by: str, drift: str = "false") -> str:
    key = f"{by}, " if by else ""
    group = f" group by {by}" if by else ""
    return f"""select {key}reasons <> '' as should_retrain, case when reasons = '' then 'All metrics within thresholds' else reasons end as reason, reasons as triggers,
  n_window, n_labeled, round(recall, 4) as recall, round(fnr, 4) as fnr, round(jf, 4) as json_failure_rate, round(agree, 4) as rule_agreement_rate,
  round(cr, 4) as conflict_rate from (select *, concat_ws('; ',
    case when fnr > 0.08::double then 'FNR=' || printf('%.3f', fnr) || ' > threshold 0.08 (safety-critical)' end,
    case when recall < 0.92::double then 'Recall=' || printf('%.3f', recall) || ' < threshold 0.92' end,
    case when jf > 0.02::double then 'JSON failure rate=' || printf('%.3f', jf) || ' > threshold 0.02' end,
    case when agree < 0.75::double then 'Rule agreement=' || printf('%.3f', agree) || ' < threshold 0.75' end,
    case when {drift} then '{C.TRIGGER_TEXT["drift"]}' end) as reasons
  from (select {key}count(*) as n_window, count(ground_truth) as n_labeled,
    case when count(ground_truth) > 0 then count(*) filter (where ground_truth = 'yes' and predicted = 'yes') / (count(*) filter (where ground_truth = 'yes') + 1e-9) end as recall,
    case when count(ground_truth) > 0 then count(*) filter (where ground_truth = 'yes' and predicted <> 'yes') / (count(*) filter (where ground_truth = 'yes') + 1e-9) end as fnr,
    count(*) filter (where not json_valid) / count(*)::double as jf,
    avg(case when ground_truth is not null then case when predicted = ground_truth then 1 else 0 end end) as agree,
    count(*) filter (where predicted = 'yes') / count(*)::double as cr from {source}{group}))"""


define("trigger_window", trigger_sql("(select * from pe order by ts desc, event_id desc limit 100)", ""), "pe")
PER_USER = "(select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from pe) where rn <= 100)"
for name in ("trigger_per_user", "stream_trigger"):
    define(name, trigger_sql(PER_USER, "user_id"), "pe")
define("trigger_with_drift", trigger_sql(PER_USER, "user_id", "(select count(*) filter (where p < 0.05) > 0 from ksp)"), "pe", "ksp")
define("retrain_decision", f"""select variant, reasons <> '' as should_retrain, reasons from (select variant, concat_ws(',',
    case when round({FNR0}, 4) > 0.08::double then 'fnr' end, case when round({REC}, 4) < 0.92::double then 'recall' end,
    case when 1 - disagree < 0.75::double then 'rule_agreement' end) as reasons
  from (select variant, {CONF}, round(avg(case when predicted_label <> rule_label then 1 else 0 end), 4) as disagree from predictions group by variant))""", "predictions")
BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
define("metric_counters", "select case when predicted = 'yes' then 'conflict' else 'no_conflict' end as conflict_result, case "
       + " ".join(f"when latency_ms / 1000 <= {b}::double then '{b}'" for b in BOUNDS)
       + " else '+Inf' end as le, count(*) as n, round(sum(latency_ms), 2) as sum_ms from pe group by 1, 2", "pe")
define("report_tables", f"""select report, dimension, metric, value::double as value from (
  unpivot (select 'ab' as report, variant as dimension, {CONF} from predictions group by variant
    union all select 'offline', variant || '/' || scenario_type, {CONF} from typed group by variant, scenario_type) on tp, fn, fp, tn into name metric value value)""",
       "predictions", "typed")
define("stream_hourly_metrics", """select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as hour, case when predicted = 'yes' then 'conflict' else 'no_conflict' end as conflict_result,
  count(*) as n, count(*) filter (where not json_valid) as bad_json, round(sum(latency_ms), 2) as sum_ms, round(max(latency_ms), 2) as max_ms from pe group by 1, 2""", "pe")
define("stream_dedup", "select event_id, user_id, predicted from pe", "pe")
define("stream_routed", f"select case when {slot('cast(event_id as varchar)')} < 28 then 'A' else 'B' end as routed_to, predicted, count(*) as n from pe group by 1, 2", "pe")

# --- generators and files --------------------------------------------------------------------------


def u(purpose: str, group: int = 0, parts: str = "scenario_id || '|' || seq") -> str:
    return f"({hash32_at(f'{chr(39)}42|{purpose}|{chr(39)} || {parts}', group)} / 4294967296::double)"


def pick(options: str, x: str, n: int) -> str:
    return f"list_extract({options}, cast(floor({x} * {n}) as int) + 1)"


cte("two_lane", f"""select scenario_id, cast(seq as int) as seq, 'V' || lpad(cast(cast(floor({u('b', 2)} * 10000) as int) as varchar), 4, '0') as vehicle_id,
  cast(1 + floor({u('a', 1)} * 2) as int) as lane, round(10 + 80::double * {u('b')}, 2) as speed, round(10 + 490::double * {u('b', 1)}, 2) as distance_to_intersection, direction,
  {pick("case direction when 'north' then ['A','B'] when 'south' then ['C','D'] when 'east' then ['E','F'] else ['G','H'] end", u('a', 2), 2)} as destination
  from (select scenario_id, seq, {pick("['north','south','east','west']", u('a'), 4)} as direction from (
    select o_orderkey as scenario_id, unnest(range(1, 3 + cast(floor({u('size', 0, 'o_orderkey')} * 7) as int))) as seq from orders))""")
define("generated_scenarios", "select * from two_lane", "two_lane")
define("generated_rows_cut", "select * from two_lane order by scenario_id, seq limit 1000", "two_lane")
def eight_sql(size: str) -> str:
    return f"""select scenario_id, cast(seq as int) as seq, 'V' || cast(1000 + (seq - 1) * 450 + floor({u('b', 2)} * 450) as bigint) as vehicle_id, lane,
  20 + 60 * {u('b')} as speed, 50 + 450 * {u('b', 1)} as distance_to_intersection, direction, d,
  case lane {' '.join(f"when {n} then {pick('[' + ','.join(repr(x) for x in reach) + ']', u('a', 2), len(reach))}" for lanes in C.LAYOUT_EIGHT_LANE.values() for n, reach in lanes.items())} end as destination
  from (select *, cast(2 * d + 1 + floor({u('a', 1)} * 2) as int) as lane, ['north','east','south','west'][d + 1] as direction
    from (select scenario_id, seq, cast(floor({u('a')} * 4) as int) as d from (select o_orderkey as scenario_id, unnest(range(1, {size})) as seq from orders)))"""


cte("eight", eight_sql(f"3 + cast(floor({u('size', 0, 'o_orderkey')} * 5) as int)"))
define("generated_eight_lane", """select scenario_id, seq, vehicle_id, lane, round(speed, 6) as speed, round(distance_to_intersection, 6) as distance_to_intersection,
  direction, destination from eight""", "eight")
cte("five", eight_sql("6"))
define("balanced_scenarios", f""", fm as (select f.*, r.m, distance_to_intersection / (speed * 1000 / 3600) as t from five f join reach r using (lane, destination)),
  hit as (select distinct a.scenario_id from fm a join fm b on a.scenario_id = b.scenario_id and a.seq < b.seq
    where {cross('a.d', 'a.m', 'b.d', 'b.m')} and {close('a.t', 'b.t')}),
  lab as (select o_orderkey as scenario_id, case when h.scenario_id is null then 'no' else 'yes' end as is_conflict from orders left join hit h on h.scenario_id = o_orderkey)
  select scenario_id, is_conflict from (select *, row_number() over (partition by is_conflict order by scenario_id) as rn from lab)
  where rn <= 501 order by scenario_id limit 1001""", "five", "reach")
define("scenario_csv_scan", """select scenario_id, l.is_conflict, case when problem is null then vehicles end as vehicles, problem from (select *,
    case when scenario_id % 5 = 0 then 'invalid JSON' when scenario_id % 7 = 0 then 'no vehicles key' when scenario_id % 11 = 0 then 'vehicles is not a list' end as problem
    from labels) l join vt using (scenario_id)""", "labels", "vt")
define("vehicle_csv_scan", "select * exclude (seq, d) replace (cast(scenario_id as varchar) as scenario_id) from raw_set", "raw_set")
define("prediction_log_scan", """select l.scenario_id, vt.vehicles, g.given_label as predicted, w.lanes as waiting_times, w.lanes as priority_order,
  l.is_conflict as ground_truth, g.given_label = l.is_conflict as rule_agreement, round(l.scenario_id % 1000 / 7.0::double, 1) as latency_ms,
  'm1' as model_version, 'p1' as prompt_version, true as json_valid, false as fallback_used
  from labels l join given g using (scenario_id) join vt using (scenario_id)
  join (select scenario_id, string_agg(vehicle_id || ':' || lane, ',' order by vehicle_id) as lanes from m group by scenario_id) w using (scenario_id)""", "labels", "given", "vt", "m")
define("reply_validity", "select scenario_id, scenario_id % 7 <> 0 and scenario_id % 11 <> 0 as json_valid from sc", "sc")
define("answer_labels", """select scenario_id, is_conflict as contained, case when scenario_id % 3 = 1 then 'no' else is_conflict end as exact from labels""", "labels")
define("scenario_type_filter", "select scenario_id, n as n_vehicles from sc where n = 4", "sc")
define("feature_parquet_scan", "select user_id, event_id, value from events where cast(ts as date) between date '2024-01-08' and date '2024-01-14'")
define("stream_rule_labels", """select l.scenario_id, l.is_conflict as ground_truth, l.is_conflict = g.given_label as rule_agreement
  from labels l join given g using (scenario_id)""", "labels", "given")
define("lane_pairs_all_sizes", "select * from lr", "lr")
define("exploded_layout_movements", "select scenario_id, seq, m as movement from m", "m")

# --- scenarios of any size ---------------------------------------------------------------

cte("supplier_lines", """select *, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey,
  l_extendedprice, l_quantity, l_discount, l_tax) as rn, count(*) over (partition by l_suppkey) as n from lineitem""")
cte("supplier_rows", CTES["raw_rows"].replace("l_orderkey as scenario_id", "l_suppkey as scenario_id").replace("from lines", "from supplier_lines"), "supplier_lines")
cte("supplier_m", CTES["m"].replace("from raw_rows", "from supplier_rows"), "supplier_rows")
cte("supplier_hits", f"""select a.scenario_id, a.seq from supplier_m a where exists (select 1 from supplier_m b
  where a.scenario_id = b.scenario_id and {cross('a.d', 'a.m', 'b.d', 'b.m')} and {close('a.t', 'b.t')})""", "supplier_m")
define("lane_decisions_by_supplier", f"""select scenario_id, count(*) as n_vehicles, count(h.seq) as n_involved,
  case when count(h.seq) > 0 then 'yes' else 'no' end as is_conflict,
  case when count(*) <= {C.MAX_VEHICLES} then 0 end as number_of_conflicts,
  case when count(*) > {C.MAX_VEHICLES} then 'too many vehicles to list' end as reason
  from supplier_m left join supplier_hits h using (scenario_id, seq) group by scenario_id""", "supplier_m", "supplier_hits")
_LISTED = ["number_of_conflicts", "any_unknown", "places_of_conflicts", "conflict_vehicles", "decisions", "priority_order", "waiting_times"]
define("lane_decisions_any_size", f"""select w.scenario_id, sc.n as n_vehicles, is_conflict,
  {", ".join(f"case when sc.n <= 8 then {c} end as {c}" for c in _LISTED)}, case when sc.n > 8 then 'too many vehicles to list' end as reason
  from whole w join sc using (scenario_id)""", "whole", "sc")

# --- whole reports, labels of generated rows, sketches, histogram of the stream -------------------


def tall_sql(report: str, name: str, labels: list[str], numbers: list[str]) -> str:
    """The rows of a report query as (report, dimension, metric, value)."""
    told = f"concat_ws('/', {', '.join(labels)})" if labels else "'all'"
    cells = ", ".join(f"{c}::double as {c}" for c in numbers)
    return f"""select '{report}' as report, dimension, metric, round(value, 4) as value
  from (select {told} as dimension, {cells} from ({ORACLE[name]})) unpivot include nulls (value for metric in ({", ".join(numbers)}))"""


_SCORES = ["accuracy", "precision", "recall", "f1", "fnr"]
define("evaluation_reports", "\nunion all ".join([
    tall_sql("bias", "subgroup_metrics", ["dimension", "grp"], ["n", *_SCORES, "wt_mae_s", "conflict_rate_true", "conflict_rate_pred"]),
    tall_sql("robustness", "flip_rates", ["feature", "delta"], ["tests", "flips", "flip_rate"]),
    tall_sql("stability", "stability", [], ["n_features", "overall_stability"]),
    tall_sql("explain", "sensitivity", ["feature"], ["normalised"]),
    tall_sql("agreement", "rule_agreement", ["variant"], ["n", "rule_agreement_rate"]),
    tall_sql("combined", "variant_metrics", ["variant"], [
        "n", *_SCORES, "json_validity_rate", "fallback_rate", "rule_disagree_rate", "conflict_rate_true", "conflict_rate_pred"]),
]))
define("variant_wait_mae", f"""select variant, count(*) as n, round(avg(case when predicted_label = true_label then 0 else wt_mae end), 4) as waiting_time_mae
  from predictions join ({ORACLE['wait_mae']}) w using (scenario_id) group by variant""", "predictions")
define("latency_sketch", """select variant, share, count(latency_ms) as n, true as close
  from predictions, (values ('p50'), ('p95'), ('p99')) s(share) group by variant, share""", "predictions")
define("stream_latency_histogram", ORACLE_BODY["metric_counters"].replace("select case", "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as hour, case", 1)
       .replace("group by 1, 2", "group by 1, 2, 3"), "pe")
cte("gen_m", "select *, case when speed > 0 then distance_to_intersection / (speed / 3.6::double) end as tn from two_lane", "two_lane")
cte("gen_p", near_pairs_sql("<").replace("from m a join m b", "from gen_m a join gen_m b"), "gen_m")
cte("gen_r", near_rank_sql("gen_p").replace("from m\n", "from gen_m m\n").replace(
    "min_by(wait, seq1 * 100 + seq2) as wait", "nullif(min_by(w0, seq1 * 100 + seq2), -1) as wait"), "gen_m", "gen_p")
define("generated_labelled", f"""select r.scenario_id, r.seq, r.vehicle_id, case when grp <> 2 then rank end as rank,
  cast(case when loss_at is not null then 2 + {hash32("'42|' || r.scenario_id || '|' || r.seq")} % 5 else 0 end as int) as wait,
  case when coalesce(c, 0) > 0 then 'yes' else 'no' end as is_conflict, cast(coalesce(c, 0) as int) as number_of_conflicts
  from gen_r r left join (select scenario_id, count(*) as c from gen_p group by scenario_id) p using (scenario_id)""", "gen_r", "gen_p")

# --- the second layout, from a file ---------------------------------------------------------

TURNS = [(n, to, "left" if n % 2 == 0 else ["right", "straight", "left"][i])
         for lanes in C.LAYOUT_SECOND.values() for n, reach in lanes.items() for i, to in enumerate(reach)]
cte("reach_2", f"select * from (values {', '.join(map(str, TURNS))}) r(lane, destination, m)")
cte("dests_2", "select d, unnest(string_split(l, '')) as dest, generate_subscripts(string_split(l, ''), 1) as place from (values "
    + ", ".join(f"({d}, '{''.join(to for reach in lanes.values() for to in reach)}')" for d, lanes in enumerate(C.LAYOUT_SECOND.values()))
    + ") x(d, l)")
cte("m_2", """select raw_rows.*, coalesce(r.m, 'unknown') as m,
  case when speed > 0 then distance_to_intersection / (speed * 1000 / 3600) end as t
  from raw_rows left join reach r on r.lane = raw_rows.lane and r.destination = raw_rows.destination""", "raw_rows", "reach")
cte("m_2_supplier", CTES["m_2"].replace("raw_rows", "supplier_rows"), "supplier_rows", "reach")
SECOND = {"m": "m_2", "reach": "reach_2", "dests": "dests_2"}
for name, body, needs in [
    ("layout_file_movements", "select scenario_id, seq, m as movement from m", ["m"]),
    ("layout_file_pairs", ORACLE_BODY["lane_pairs"], ["lr"]),
    ("layout_file_one_vehicle", SINGLE + "pl union all " + SINGLE + "pdest", ["pl", "pdest"]),
    ("layout_file_rerouted_any_predictor", SINGLE + "pdest", ["pdest"]),
    ("layout_file_sensitivity", ORACLE_BODY["sensitivity"], ["score"]),
]:
    define(name, body, *needs, instead=SECOND)
define("layout_file_labels_any_size", """select m.scenario_id, count(*) as n_vehicles,
  count(*) filter (where i.seq is not null) as n_involved, case when count(i.seq) > 0 then 'yes' else 'no' end as is_conflict,
  bool_or(m.m = 'unknown') as any_unknown
  from m left join (select scenario_id, seq1 as seq from lp union select scenario_id, seq2 from lp) i
    on i.scenario_id = m.scenario_id and i.seq = m.seq group by m.scenario_id""", "m", "lp",
       instead={**SECOND, "m": "m_2_supplier"})
