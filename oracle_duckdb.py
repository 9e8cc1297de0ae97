"""Independent DuckDB SQL for every query with an oracle.

Only the plain tables are registered on the oracle side, so the fixture views
of FIXTURES.md are inlined as CTEs.  Money is DECIMAL(18,2); doubles are
rounded to 6 places; every denominator is wrapped in NULLIF.
"""

from __future__ import annotations

K = "cast(json_extract_string(props,'$.k') as int)"
D = "datediff('day', date '1970-01-01', cast(ts as date))"

VIEWS = {
    "tx_e": f"""select user_id as cl_id, event_id as tx_id, ts, event_type as category, {K} as mcc,
  case {K} % 5 when 0 then 810 when 1 then 840 when 2 then 978 when 3 then 784 else 704 end as currency,
  case when {K} % 10 = 9 then null else concat('type', cast({K} % 6 as varchar)) end as channel_type,
  cast(value as decimal(18,2)) as amount
from events""",
    "tx_o": """select o_custkey as cl_id, o_orderkey as tx_id, o_orderdate as ts, o_orderpriority as category,
  o_orderstatus as channel, cast(o_totalprice as decimal(18,2)) as amount
from orders""",
    "tx_l": """select o_custkey as cl_id, l_orderkey*10+l_linenumber as tx_id, l_shipdate as ts, l_returnflag as category,
  l_partkey as mcc, cast(l_extendedprice as decimal(18,2)) as amount
from lineitem join orders on l_orderkey = o_orderkey""",
    "mcc_dim": "select p_partkey as mcc, p_brand as mcc_category from part where p_partkey % 50 <> 0",
    "fx": f"""select 840 as code, {D} as day, max(cast(value as decimal(18,2))) as rate from events where {D} % 7 not in (2,3) group by {D}
union all
select 978 as code, {D} as day, min(cast(value as decimal(18,2))) as rate from events where {D} % 7 not in (2,3) group by {D}""",
    "cust_lbl": """select cl_id, case when sum(case when category='purchase' then amount else 0 end) > 700 then 1 else 0 end as target_flag,
  sum(case when category='purchase' then amount else 0 end) as target_sum
from tx_e where cl_id % 5 <> 0 group by cl_id""",
}

# views each view depends on (so the CTE list is complete and ordered)
DEPS = {"cust_lbl": ["tx_e"]}


def q(views: list[str], body: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Compose ``with <views>, <ctes> <body>``."""
    order: list[str] = []

    def add(v):
        for d in DEPS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    parts = [f"{v} as ({VIEWS[v]})" for v in order] + [f"{n} as ({s})" for n, s in (ctes or [])]
    return ("with " + ",\n".join(parts) + "\n" + body) if parts else body


SQL: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    SQL[name] = sql


# --------------------------------------------------------------------------- E17 / F2
register("client_gap_stats", q(["tx_e"], """
select cl_id, round(min(g),6) gap_min, round(max(g),6) gap_max, round(avg(g),6) gap_mean,
  round(stddev_pop(g),6) gap_std, round(median(g),6) gap_median
from (select cl_id, case when p is null then null
        else cast(((epoch_us(ts) - epoch_us(p)) // 1000000) % 86400 as double) / 60 end g
      from (select cl_id, ts, lag(ts) over (partition by cl_id order by ts, tx_id) p from tx_e))
group by cl_id"""))

# --------------------------------------------------------------------------- calendar, parsing, tenure
TRX_TEXT = """case when category = 'error' then concat('bad', cast(tx_id as varchar))
  when tx_id % 3 = 0 then upper(strftime(ts, '%d%b%y:%H:%M:%S'))
  when tx_id % 3 = 1 then lower(strftime(ts, '%d%b%y:%H:%M:%S'))
  else strftime(ts, '%d%b%y:%H:%M:%S') end"""

register("parse_trx_time", q(["tx_e"], f"""
select cl_id, tx_id, trx_time from (
  select cl_id, tx_id, try_strptime({TRX_TEXT}, '%d%b%y:%H:%M:%S') trx_time from tx_e)
where trx_time is not null"""))

register("iso_weekday", q(["tx_e"], f"""
select cl_id, tx_id, coalesce(isodow(try_strptime({TRX_TEXT}, '%d%b%y:%H:%M:%S')), 0) iso_weekday from tx_e"""))

register("parse_period", q(["tx_o"], """
select cl_id, tx_id, p as period, year(p)*12 + month(p) as period_month from (
  select cl_id, tx_id, cast(try_strptime(case when channel = 'P' then '31/02/1999'
      else strftime(date_trunc('month', ts), '%d/%m/%Y') end, '%d/%m/%Y') as date) p from tx_o)"""))

register("calendar_fields", q(["tx_e"], """
select cl_id, tx_id, hour(ts) tr_hour,
  case when hour(ts) between 0 and 8 then 1 when hour(ts) between 9 and 18 then 2 else 0 end day_part,
  isodow(ts) - 1 week_day, datediff('day', date '1970-01-01', cast(ts as date)) global_day_number,
  floor(datediff('day', date '1970-01-01', cast(ts as date)) / 7) week_global_number,
  quarter(ts) - 1 quartel, month(ts) + (year(ts) - 2016) * 12 as month, day(ts) as day, year(ts) as year,
  datediff('day', date '2015-01-01', cast(ts as date)) days_since,
  year(ts) * 12 + month(ts) period_month
from tx_e"""))

register("holiday_flag", q(["tx_e"], """
select cl_id, tx_id, case when cast(ts as date) in (date '2024-01-01', date '2024-01-06', date '2024-01-07',
  date '2024-01-13', date '2024-01-14') then 1 else 0 end is_holiday from tx_e"""))

register("channel_code", q(["tx_e"], """
select cl_id, tx_id, coalesce(try_cast(right(coalesce(channel_type, '0'), 1) as int), 0) channel_code from tx_e"""))

register("category_code", q(["tx_e"], """
select t.cl_id, t.tx_id, coalesce(d.code, -1) cat_index from tx_e t left join
  (select category, dense_rank() over (order by category) - 1 code from (select distinct category from tx_e
   where category is not null)) d on t.category = d.category"""))

TENURE = """select *, period_month - max(period_month) over (partition by cl_id) months_before_last,
  wk - min(wk) over (partition by cl_id) week_number,
  gd - min(gd) over (partition by cl_id) day_number,
  cast(floor((epoch_us(ts) - min(epoch_us(ts)) over (partition by cl_id)) / 86400000000.0) as int) transaction_day,
  period_month - min(period_month) over (partition by cl_id) period_number
from (select *, year(ts)*12 + month(ts) period_month,
        floor(datediff('day', date '1970-01-01', cast(ts as date)) / 7) wk,
        datediff('day', date '1970-01-01', cast(ts as date)) gd from {src})"""

register("period_part_buckets", q(["tx_e"], """
select cl_id, tx_id, day_number, floor((day_number+1)/2) period_part_2, floor((day_number+1)/4) period_part_4,
  floor((day_number+1)/8) period_part_8, floor((day_number+1)/16) period_part_16, floor((day_number+1)/32) period_part_32,
  floor((day_number+1)/64) period_part_64, floor((day_number+1)/128) period_part_128 from ten""",
    [("ten", TENURE.format(src="tx_e"))]))

register("tenure_fields", q(["tx_o"], """
select cl_id, tx_id, period_month, months_before_last, week_number, day_number, transaction_day, period_number,
  cast(floor(transaction_day / 7) as int) transaction_week from ten""", [("ten", TENURE.format(src="tx_o"))]))

register("day_diff", q(["tx_e"], """
select cl_id, tx_id, day_number, coalesce(greatest(day_number - lag(day_number) over
  (partition by cl_id order by day_number, ts, tx_id), 0), 0) day_diff from ten""", [("ten", TENURE.format(src="tx_e"))]))

register("tenure_cut", q(["tx_o"], """
select cl_id, tx_id, transaction_day from ten where transaction_day <= 93""", [("ten", TENURE.format(src="tx_o"))]))

register("last_action_backjoin", q(["tx_e"], """
select cl_id, tx_id, last_action,
  case when ts >= last_action - to_days(7) then 1 else 0 end in_last_7,
  case when ts >= last_action - to_days(14) then 1 else 0 end in_last_14,
  case when ts >= last_action - to_days(30) then 1 else 0 end in_last_30,
  case when ts >= last_action - to_days(60) then 1 else 0 end in_last_60
from (select *, max(ts) over (partition by cl_id) last_action from tx_e)"""))

register("round_amount_flags", q(["tx_e"], """
select cl_id, tx_id, coalesce(cast(amount % 1 = 0 as int), 0) ostatok_1, coalesce(cast(amount % 10 = 0 as int), 0) ostatok_10,
  coalesce(cast(amount % 100 = 0 as int), 0) ostatok_100, coalesce(cast(amount % 1000 = 0 as int), 0) ostatok_1000 from tx_e"""))

register("signed_amount", q(["tx_e"], """
select cl_id, tx_id, cast(case when category in ('signup') then abs(amount) else -amount end as double) signed_amount from tx_e"""))

# --------------------------------------------------------------------------- client statistics
MONTH_O = "month(ts) + (year(ts) - 1995) * 12"


def stat_sql(x: str, s: str, filt: str = "") -> str:
    """One statistic of column x in DuckDB, matching cardlens.functions.stats."""
    f = f" filter (where {filt})" if filt else ""
    d = f"cast({x} as double)"
    return {
        "sum": f"cast(sum({x}){f} as double)",
        "mean": f"round(avg({d}){f}, 6)",
        "std": f"round(stddev_samp({d}){f}, 6)",
        "std_pop": f"round(stddev_pop({d}){f}, 6)",
        "median": f"round(median({d}){f}, 6)",
        "max": f"cast(max({x}){f} as double)",
        "min": f"cast(min({x}){f} as double)",
        "mode": f"cast(mode({x} order by {x}){f} as double)",
        "mean_div_std": f"round(avg({d}){f} / (stddev_pop({d}){f} + 1), 6)",
        "count": f"count({x}){f}",
    }[s]


def client_stats_sql(src: str, x: str, stats, prefix: str, key: str = "cl_id") -> tuple[str, list[str]]:
    cols = [f"{stat_sql(x, s)} as {prefix}{s}" for s in stats if s != "mode_count"]
    body = f"select {key}, {', '.join(cols)} from {src} group by {key}"
    if "mode_count" in stats:
        body = (f"select a.*, m.{prefix}mode_count from ({body}) a join (select {key}, max(n) {prefix}mode_count from "
                f"(select {key}, {x}, count(*) n from {src} where {x} is not null group by {key}, {x}) group by {key}) m "
                f"using ({key})")
    return body, [f"{prefix}{s}" for s in stats]


AMOUNT_STATS = ("sum", "mean", "std", "median", "max", "min", "mode_count", "mode", "mean_div_std")

register("client_num_deals", q(["tx_e"], "select cl_id, count(amount) num_deals from tx_e group by cl_id"))
register("client_sum_deals", q(["tx_e"], "select cl_id, cast(sum(amount) as double) sum_deals from tx_e group by cl_id"))


def lifespan_sql(src: str, base: int) -> str:
    mx = f"month(max(ts)) + (year(max(ts)) - {base}) * 12"
    mn = f"month(min(ts)) + (year(min(ts)) - {base}) * 12"
    return (f"select cl_id, cast((epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000 as int) num_days_in_use, "
            f"{mx} max_month, {mn} min_month, ({mx}) - ({mn}) delta_month from {src} group by cl_id")


register("client_lifespan", q(["tx_o"], lifespan_sql("tx_o", 1995)))
register("client_amount_stats", q(["tx_e"], client_stats_sql("tx_e", "amount", AMOUNT_STATS, "amount_")[0]))
register("client_month_stats", q(["tx_o"], client_stats_sql("txm", "month", ("median", "max", "min", "mode_count", "mode"),
                                                            "month_")[0],
                                 [("txm", f"select *, {MONTH_O} as month from tx_o")]))

_round_parts = []
for _d in (1, 10, 100, 1000):
    for _s in ("mean", "std", "median", "max", "min", "mean_div_std"):
        _round_parts.append(f"{stat_sql(f'f{_d}', _s)} as ostatok_{_d}_{_s}")
register("client_round_stats", q(["tx_e"], f"select cl_id, {', '.join(_round_parts)} from fl group by cl_id", [(
    "fl", "select cl_id, " + ", ".join(f"coalesce(cast(amount % {d} = 0 as int), 0) f{d}" for d in (1, 10, 100, 1000))
    + " from tx_e")]))

register("client_channel_mode", q(["tx_e"], """
select cl_id, cast(mode(c order by c) as double) channel_code_mode from
 (select cl_id, coalesce(try_cast(right(coalesce(channel_type, '0'), 1) as int), 0) c from tx_e) group by cl_id"""))

register("client_mode_count", q(["tx_e"], """
select cl_id, max(n) mcc_mode_count from (select cl_id, mcc, count(*) n from tx_e where mcc is not null group by cl_id, mcc)
group by cl_id"""))

register("client_mean_div_std", q(["tx_e"], client_stats_sql("tx_e", "amount", ("mean_div_std",), "amount_")[0]))


def active_days_sql(src: str) -> str:
    return (f"select cl_id, count(distinct ds) len_days, round(count(distinct ds) / nullif(cast(max(ds) - min(ds) + 1 "
            f"as double), 0), 6) len_div_set_days from (select cl_id, datediff('day', date '2015-01-01', cast(ts as date)) "
            f"ds from {src}) group by cl_id")


register("client_active_days", q(["tx_o"], active_days_sql("tx_o")))

COHORT_O = f"""select month, count(cl_id) num_deals_month, count(distinct cl_id) uniq_len_num_cards,
  round(count(cl_id) / nullif(cast(count(distinct cl_id) as double), 0), 6) avg_act
from (select *, {MONTH_O} as month from tx_o) group by month"""
register("month_cohort", q(["tx_o"], COHORT_O))

register("month_amount_stats", q(["tx_o"], "select month, " + ", ".join(
    f"{stat_sql('amount', s)} as ag_month_{s}" for s in ("sum", "mean", "std", "median", "mean_div_std"))
    + f" from (select *, {MONTH_O} as month from tx_o) group by month"))

register("month_cohort_join", q(["tx_o"], """
select c.cl_id, c.max_month, c.min_month,
  a.num_deals_month max_num_deals_month, a.uniq_len_num_cards max_uniq_len_num_cards, a.avg_act max_avg_act,
  b.num_deals_month min_num_deals_month, b.uniq_len_num_cards min_uniq_len_num_cards, b.avg_act min_avg_act
from (select cl_id, max_month, min_month from ls) c
left join coh a on c.max_month = a.month left join coh b on c.min_month = b.month""",
    [("ls", lifespan_sql("tx_o", 1995)), ("coh", COHORT_O)]))

register("client_first_value", q(["tx_o"], "select cl_id, first(channel order by ts, tx_id) first_channel from tx_o group by cl_id"))

register("client_target", q(["cust_lbl"], """
select t.cl_id, max(l.target_flag) target_flag, cast(max(l.target_sum) as double) target_sum
from tx_e t left join cust_lbl l on t.cl_id = l.cl_id group by t.cl_id"""))

GAP_E = """select cl_id, round(min(g),6) gap_min, round(max(g),6) gap_max, round(avg(g),6) gap_mean,
  round(stddev_pop(g),6) gap_std, round(median(g),6) gap_median
from (select cl_id, case when p is null then null
        else cast(((epoch_us(ts) - epoch_us(p)) // 1000000) % 86400 as double) / 60 end g
      from (select cl_id, ts, lag(ts) over (partition by cl_id order by ts, tx_id) p from tx_e))
group by cl_id"""

register("client_features_left_join", q(["tx_e"], """
select * from (select cl_id, count(amount) num_deals, cast(sum(amount) as double) sum_deals from tx_e group by cl_id)
left join gap using (cl_id) left join ls using (cl_id) left join ad using (cl_id)""",
    [("gap", GAP_E), ("ls", lifespan_sql("tx_e", 2024)), ("ad", active_days_sql("tx_e"))]))

register("wide_join_suffix", q(["tx_e"], """
select l.cl_id, l.amount_sum amount_sum_l, l.amount_max amount_max_l, l.amount_count amount_count_l, 1 channel_type_l,
  r.amount_sum amount_sum_r, r.amount_max amount_max_r, r.amount_count amount_count_r, r.channel_type_r
from (select cl_id, cast(sum(amount) as double) amount_sum, cast(max(amount) as double) amount_max, count(amount) amount_count
      from tx_e group by cl_id) l
left join (select cl_id, cast(sum(amount) as double) amount_sum, cast(max(amount) as double) amount_max,
      count(amount) amount_count, 2 channel_type_r from tx_e where category = 'purchase' group by cl_id) r on l.cl_id = r.cl_id"""))

register("drop_columns", q(["tx_e"], client_stats_sql("tx_e", "amount", ("sum", "mean", "std", "median", "max", "min"),
                                                      "amount_")[0]))

CATS_E = ["click", "error", "purchase", "signup", "view"]
CAT_STATS = ("sum", "mean", "std", "median", "max", "min", "mode_count", "mode", "mean_div_std", "count")
_cs_body, _ = client_stats_sql("tx_e", "amount", CAT_STATS, "s_", key="cl_id, category")
_cat_cols = []
for _v in CATS_E:
    for _s in CAT_STATS:
        _cat_cols.append(f"max(case when category = '{_v}' and s_count > 0 then coalesce(s_{_s}, 0) end) "
                         f"as trx_category{_v}_amount_{_s}")
register("category_stats_pivot", q(["tx_e"], f"select cl_id, {', '.join(_cat_cols)} from cs group by cl_id",
                                   [("cs", _cs_body)]))

REC_DAYS = (7, 14, 30, 60)


def recency_sql(stats) -> tuple[str, list]:
    cols = []
    for n in REC_DAYS:
        w = f"ts >= la - to_days({n})"
        for s in stats:
            if s != "mode_count":
                cols.append(f"{stat_sql('amount', s, w)} as last_action_minus_{n}_days_{s}")
    body = f"select cl_id, {', '.join(cols)} from b group by cl_id"
    if "mode_count" in stats:
        mc = ", ".join(f"max(case when n{n} > 0 then n{n} end) last_action_minus_{n}_days_mode_count" for n in REC_DAYS)
        cnt = ", ".join(f"count(*) filter (where ts >= la - to_days({n})) n{n}" for n in REC_DAYS)
        body = (f"select * from ({body}) join (select cl_id, {mc} from (select cl_id, amount, {cnt} from b "
                f"group by cl_id, amount) group by cl_id) using (cl_id)")
    return body, [("b", "select *, max(ts) over (partition by cl_id) la from tx_e")]


_rb, _rc = recency_sql(("sum", "mean", "std", "median", "max", "min", "mode_count", "mode", "mean_div_std", "count"))
register("recency_aggs", q(["tx_e"], _rb, _rc))

_ratio_stats = ("sum", "mean", "std", "median", "max", "min", "count")
_whole_body, _ = client_stats_sql("tx_e", "amount", _ratio_stats, "amount_")
_rec_body, _rec_ctes = recency_sql(_ratio_stats)
_ratio_cols = []
for _s in _ratio_stats:
    _names = [f"last_action_minus_{n}_days_{_s}" for n in REC_DAYS]
    for _a in _names:
        _ratio_cols.append(f"round(cast({_a} as double) / nullif(cast(amount_{_s} as double), 0), 6) {_a}_div_mean")
    for _i in range(len(_names)):
        for _j in range(_i + 1, len(_names)):
            ai, aj = f"cast({_names[_i]} as double)", f"cast({_names[_j]} as double)"
            _ratio_cols.append(f"round({ai} / nullif({aj}, 0), 6) {_names[_i]}_div_{_names[_j]}")
            _ratio_cols.append(f"round(({aj} - {ai}) / nullif({aj}, 0), 6) {_names[_i]}_prc_{_names[_j]}")
register("recency_ratios", q(["tx_e"], f"select cl_id, {', '.join(_ratio_cols)} from w join r using (cl_id)",
                             _rec_ctes + [("w", _whole_body), ("r", _rec_body)]))

TENURE_O = TENURE.format(src="tx_o")
_rms = []
_flows = []
for _m in (0, -1, -2, -3, -4):
    _s = f"sum(amount) filter (where months_before_last = {_m} and category = '1-URGENT')"
    _rms.append(f"coalesce(cast({_s} as double), 0) \"month_{_m}\"")
    _rms.append(f"coalesce(cast({_s} >= 19000 as int), 0) \"month_state_{_m}\"")
    _in = f"coalesce(cast(sum(amount) filter (where months_before_last = {_m} and category in ('5-LOW')) as double), 0)"
    _tot = f"coalesce(cast(sum(amount) filter (where months_before_last = {_m}) as double), 1)"
    _out = (f"coalesce(cast(sum(amount) filter (where months_before_last = {_m} and category not in ('5-LOW') "
            f"and category = '1-URGENT') as double), 0)")
    _flows.append(f"coalesce(round({_in} / nullif({_tot}, 0), 6), 0) \"portion_in{_m}\"")
    _flows.append(f"{_out} \"portion_out{_m}\"")
register("relative_month_state", q(["tx_o"], f"select cl_id, {', '.join(_rms)} from ten group by cl_id",
                                   [("ten", TENURE_O)]))
register("inout_flows", q(["tx_o"], f"select cl_id, {', '.join(_flows)} from ten group by cl_id", [("ten", TENURE_O)]))

# --------------------------------------------------------------------------- pivots
POS_E = "category = 'purchase'"
GOOD_E = "not coalesce(mcc % 7 = 0, false)"
PG_E = f"{POS_E} and {GOOD_E}"
HOL_E = ("cast(ts as date) in (date '2024-01-01', date '2024-01-06', date '2024-01-07', date '2024-01-13', "
         "date '2024-01-14')")
ENR_E = ("select *, hour(ts) tr_hour, case when hour(ts) between 0 and 8 then 1 when hour(ts) between 9 and 18 then 2 "
         "else 0 end day_part, isodow(ts) - 1 week_day, coalesce(greatest(day_number - lag(day_number) over "
         "(partition by cl_id order by day_number, ts, tx_id), 0), 0) day_diff, "
         f"case when {HOL_E} then 1 else 0 end is_holiday from ({TENURE.format(src='tx_e')})")

_scalar = {
    "sum_POS": f"coalesce(cast(sum(amount) filter (where {POS_E}) as double), 0)",
    "good_mcc_portion": (f"coalesce(round(cast(sum(amount) filter (where {GOOD_E}) as double) / "
                         f"nullif(cast(sum(amount) filter (where {POS_E}) as double), 0), 6), 0)"),
    "days_hole_mean": f"coalesce(round(avg(cast(day_diff as double)) filter (where {PG_E}) / 100.0, 6), 0)",
    "head_hole_size": f"coalesce(round(min(day_number) filter (where {PG_E}) / 100.0, 6), 0)",
    "tail_hole_size": f"coalesce(round((100.0 - max(day_number) filter (where {PG_E})) / 100.0, 6), 0)",
    "holydays_amount_part": "coalesce(cast(sum(amount) filter (where is_holiday = 1) as double), 0)",
}


def scalar_sql(cols):
    return q(["tx_e"], f"select cl_id, {', '.join(f'{_scalar[c]} as {c}' for c in cols)} from enr group by cl_id",
             [("enr", ENR_E)])


register("sum_by_category_filter", scalar_sql(["sum_POS"]))
register("good_mcc_portion", scalar_sql(["good_mcc_portion"]))
register("tenure_holes", scalar_sql(["days_hole_mean", "head_hole_size", "tail_hole_size"]))
register("holiday_amount", scalar_sql(["holydays_amount_part"]))
register("good_mcc_rows", q(["tx_e"], f"select cl_id, tx_id, mcc from tx_e where {GOOD_E}"))
register("mcc_feature_list", q(["tx_e"], "select distinct mcc from tx_e where not (mcc % 7 = 0 or mcc % 11 = 0)"))


def static_pivot(src, prefix, dim, values, cond=None, share=False):
    cols = []
    for v in values:
        w = f"{dim} = {v}" + (f" and {cond}" if cond else "")
        s = f"cast(sum(amount) filter (where {w}) as double)"
        if share:
            s = f"round({s} / nullif(cast(sum(amount) as double), 0), 6)"
        cols.append(f"coalesce({s}, 0) \"{prefix}{v}\"")
    return f"select cl_id, {', '.join(cols)} from {src} group by cl_id"


def dynamic_pivot(long_sql, labels):
    """long_sql yields (cl_id, l, v) including a '__total__' label per client; one
    column per label of the list (those of the data at sf0.01)."""
    return "select cl_id, " + ", ".join(
        f"coalesce(max(v) filter (where l = '{x}'), 0) \"{x}\"" for x in labels) + f" from ({long_sql}) group by cl_id"


TXO_CAL = f"select *, year(ts) as year, {MONTH_O} as month, day(ts) as day, quarter(ts) - 1 quartel from tx_o"
POS_O = "category = '1-URGENT'"
register("pivot_year", q(["tx_o"], dynamic_pivot(
    f"select cl_id, 'year_' || cast(year as varchar) l, cast(sum(amount) filter (where {POS_O}) as double) v "
    f"from o group by cl_id, year union all select distinct cl_id, '__total__', 0 from o",
    [f"year_{y}" for y in range(1995, 2002)]), [("o", TXO_CAL)]))
register("pivot_month", q(["tx_o"], static_pivot("o", "year_month_", "month", range(1, 13), POS_O), [("o", TXO_CAL)]))
register("pivot_month_day", q(["tx_o"], static_pivot("o", "month_day_", "day", range(1, 32), POS_O), [("o", TXO_CAL)]))
register("pivot_quarter", q(["tx_o"], static_pivot("o", "quartel_", "quartel", range(4)), [("o", TXO_CAL)]))
register("pivot_day_part_share", q(["tx_e"], static_pivot("enr", "day_part_", "day_part", range(3), PG_E, True),
                                   [("enr", ENR_E)]))
register("pivot_hour_share", q(["tx_e"], static_pivot("enr", "hour_", "tr_hour", range(24), PG_E, True),
                               [("enr", ENR_E)]))
register("pivot_currency", q(["tx_e"], static_pivot("enr", "cur_", "currency", (810, 978, 840, 784)),
                             [("enr", ENR_E)]))
register("pivot_weekday", q(["tx_e"], static_pivot("enr", "week_day_", "week_day", range(6)), [("enr", ENR_E)]))
register("pivot_tenure_day", q(["tx_e"], static_pivot("enr", "day_", "day_number", range(100), POS_E),
                               [("enr", ENR_E)]))
register("pivot_tenure_week", q(["tx_e"], static_pivot("enr", "week_", "week_number", range(14), PG_E),
                                [("enr", ENR_E)]))
register("pivot_category_share", q(["tx_e"], dynamic_pivot(
    "select e.cl_id, 'cat_' || cast(c.code as varchar) l, round(cast(sum(e.amount) as double) / nullif(cast(max(t.tot) "
    "as double), 0), 6) v from tx_e e join (select category, dense_rank() over (order by category) - 1 code from "
    "(select distinct category from tx_e where category is not null)) c using (category) join (select cl_id, sum(amount) "
    "tot from tx_e group by cl_id) t using (cl_id) group by e.cl_id, c.code "
    "union all select distinct cl_id, '__total__', 0 from tx_e", [f"cat_{i}" for i in range(5)])))
register("period_part_coverage", q(["tx_e"], "select cl_id, " + ", ".join(
    f"round(count(distinct floor((day_number + 1) / {n})) / ({128 / n}), 6) period_part{n}"
    for n in (2, 4, 8, 16, 32, 64, 128)) + " from ten group by cl_id", [("ten", TENURE.format(src="tx_e"))]))
register("pivot_mcc_share", q(["tx_e"], dynamic_pivot(
    "select e.cl_id, 'sum_' || cast(e.mcc as varchar) l, round(cast(sum(e.amount) as double) / nullif(cast(max(g.good) "
    f"as double), 0), 6) v from tx_e e join (select cl_id, sum(amount) filter (where {GOOD_E}) good from tx_e group by "
    "cl_id) g using (cl_id) where not (e.mcc % 7 = 0 or e.mcc % 11 = 0) group by e.cl_id, e.mcc "
    "union all select distinct cl_id, '__total__', 0 from tx_e",
    [f"sum_{m}" for m in range(1, 98) if m % 7 and m % 11])))


register("mcc_share_long", q(["tx_e"], f"""select e.cl_id, e.mcc, coalesce(round(cast(sum(e.amount) as double) /
  nullif(cast(max(g.good) as double), 0), 6), 0) share from tx_e e join (select cl_id, sum(amount) filter (where {GOOD_E}) good
  from tx_e group by cl_id) g using (cl_id) where not (e.mcc % 7 = 0 or e.mcc % 11 = 0) group by e.cl_id, e.mcc"""))


def onehot_long(src, prefix, col, share):
    idx = (f"(select v, row_number() over (order by n desc, cast(v as varchar)) - 1 i, count(*) over () k from "
           f"(select {col} v, count(*) n from {src} where {col} is not null group by {col}))")
    val = "cast(sum(s.amount) as double)"
    if share:
        val = f"round({val} / nullif(cast(max(t.tot) as double), 0), 6)"
    return (f"select s.cl_id, '{prefix}' || cast(x.i as varchar) l, {val} v from {src} s join {idx} x on s.{col} = x.v "
            f"join (select cl_id, sum(amount) tot from {src} group by cl_id) t on s.cl_id = t.cl_id "
            f"where x.i < x.k - 1 group by s.cl_id, x.i")


_ten_cut = f"select * from ({TENURE.format(src='tx_o')}) where transaction_day <= 93"
register("onehot_weighted_sum", q(["tx_o"], dynamic_pivot(
    onehot_long("tc", "tw_", "cast(floor(transaction_day / 7) as int)", False).replace(
        "s.cast(floor(transaction_day / 7) as int)", "cast(floor(s.transaction_day / 7) as int)")
    + " union all " + onehot_long("tc", "pn_", "period_number", False)
    + " union all select distinct cl_id, '__total__', 0 from tc",
    [f"tw_{i}" for i in range(13)] + [f"pn_{i}" for i in range(3)]), [("tc", _ten_cut)]))
register("onehot_weighted_share", q(["tx_e"], dynamic_pivot(
    onehot_long("we", "wd_", "iso_weekday", True) + " union all " + onehot_long("we", "cur_", "currency", True)
    + " union all " + onehot_long("we", "cat_", "category", True)
    + " union all select distinct cl_id, '__total__', 0 from we",
    [f"wd_{i}" for i in range(6)] + [f"cur_{i}" for i in range(4)] + [f"cat_{i}" for i in range(4)]),
    [("we", "select *, coalesce(isodow(ts), 0) iso_weekday from tx_e")]))
_card_rows = (f"select t.*, m.mcc_category, coalesce(isodow(ts), 0) iso_weekday, coalesce(channel_type, 'none') channel "
              f"from (select * from ({TENURE.format(src='tx_e')}) where transaction_day <= 93) t left join mcc_dim m on t.mcc = m.mcc")
register("card_vector", q(["tx_e", "mcc_dim"], "select p.*, c.* exclude (cl_id), o.total_amount from (" + dynamic_pivot(
    onehot_long("cr", "tw_", "cast(floor(transaction_day / 7) as int)", False).replace(
        "s.cast(floor(transaction_day / 7) as int)", "cast(floor(s.transaction_day / 7) as int)")
    + "".join(" union all " + onehot_long("cr", a, b, True) for a, b in (
        ("wd_", "iso_weekday"), ("cur_", "currency"), ("mc_", "mcc_category"), ("cat_", "category"))),
    [f"tw_{i}" for i in range(4)] + [f"wd_{i}" for i in range(6)] + [f"cur_{i}" for i in range(4)]
    + [f"mc_{i}" for i in range(23)] + [f"cat_{i}" for i in range(4)])
    + ") p join (select cl_id, " + ", ".join(f"case when i = {k} then 1.0 else 0.0 end ch_{k}" for k in range(6))
    + """ from (select cl_id, arg_min(channel, (ts, tx_id)) ch from cr group by cl_id) f
  join (select channel, row_number() over (order by count(*) desc, channel) - 1 i from cr group by channel) x on f.ch = x.channel) c on p.cl_id = c.cl_id
  join (select cl_id, cast(sum(amount) as double) total_amount from cr group by cl_id) o on p.cl_id = o.cl_id""", [("cr", _card_rows)]))
register("card_vector_sparse", q(["tx_e", "mcc_dim"], " union all ".join(
    f"select s.cl_id, '{p}' || cast(x.i as varchar) feature, cast(x.v as varchar) as label, "
    + ("round(cast(sum(s.amount) as double) / nullif(cast(max(t.tot) as double), 0), 6)" if share else "cast(sum(s.amount) as double)")
    + f" x from (select *, {e} as v_{p} from cr) s join (select v, row_number() over (order by n desc, cast(v as varchar)) - 1 i, "
    f"count(*) over () k from (select {e} v, count(*) n from cr where {e} is not null group by {e})) x on s.v_{p} = x.v "
    "join (select cl_id, sum(amount) tot from cr group by cl_id) t on s.cl_id = t.cl_id "
    "where x.i < x.k - 1 group by s.cl_id, x.i, x.v having x <> 0"
    for p, e, share in (("tw_", "cast(floor(transaction_day / 7) as int)", False), ("pn_", "period_number", False), ("wd_", "iso_weekday", True),
                        ("cur_", "currency", True), ("mc_", "mcc_category", True), ("cat_", "category", True))), [("cr", _card_rows)]))
_ENCODED = {"transaction_week": "cast(floor(transaction_day / 7) as int)", "period_number": "period_number", "mcc_category": "mcc_category",
            "iso_weekday": "iso_weekday", "channel": "channel", "currency": "currency", "category": "category"}


def encoded(part=""):
    """One-hot vectors of the card rows: labels by falling frequency (ties by text), the last without a place.
    Encoders are fitted one after another, on the rows that those before have kept (rows without a label go)."""
    names = list(_ENCODED)
    ctes = [("cr", _card_rows), ("er", "select cl_id, tx_id, " + ", ".join(f"{e} {c}" for c, e in _ENCODED.items()) + " from cr")]
    ctes += [(f"x_{c}", f"select v, row_number() over (order by n desc, cast(v as varchar)) - 1 i, count(*) over () k from "
                        f"(select {c} v, count(*) n from er where " + " and ".join(f"{x} is not null" for x in names[:names.index(c) + 1]) + f" group by {c})") for c in _ENCODED]
    vecs = ", ".join(f"[case when j = x_{c}.i then 1.0::double else 0.0::double end for j in range(x_{c}.k - 1)] {c}_vec" for c in _ENCODED)
    joins = " ".join(f"join x_{c} on er.{c} = x_{c}.v" for c in _ENCODED)
    return f"select er.cl_id, er.tx_id, {part}{vecs} from er {joins}", ctes


_body, _ctes = encoded()
register("one_hot", q(["tx_e", "mcc_dim"], _body, _ctes))
_body, _ctes = encoded("case when er.cl_id in (select cl_id from cust_lbl) then 'train' else 'test' end part, ")
register("encode_pipeline", q(["tx_e", "mcc_dim", "cust_lbl"], _body, _ctes))
register("elementwise_vector_sum", """
select label, list(s order by pos) vec_sum from (
  select label, pos, round(sum(cast(x as double)), 4) s from (
    select label, unnest(embedding) x, generate_subscripts(embedding, 1) - 1 pos from embeddings)
  group by label, pos) group by label""")

_quotes = "select currency code, ts, max(cast(amount as double)) rate from tx_e where category = 'purchase' and currency in (840, 978) group by all"
register("fx_asof_seconds", q(["tx_e"], f"""select t.cl_id, t.tx_id, r.rate, r.ts rate_ts from tx_e t
  asof left join ({_quotes}) r on t.currency = r.code and t.ts >= r.ts"""))
register("fx_asof_seconds_tolerance", q(["tx_e"], f"""select t.cl_id, t.tx_id, case when t.ts - r.ts <= interval 2 hour then r.rate end rate from tx_e t
  asof left join ({_quotes}) r on t.currency = r.code and t.ts >= r.ts"""))

# --------------------------------------------------------------------------- money
register("fx_rates", q(["fx"], "select code, day, case when code = 978 and day % 5 = 0 then null "
                               "else cast(rate as double) end rate from fx"))
register("fx_rates_fallback", q(["fx"], "select code, day, cast(case when day % 5 = 0 then rate + 1 else rate end "
                                        "as double) rate from fx where code = 978"))
FLAT_AMT = ("case when currency = 704 then cast(amount as double) * 0.000045 when currency = 360 then "
            "cast(amount as double) * 0.000074 when currency = 410 then cast(amount as double) * 0.000892 "
            "when currency = 170 then cast(amount as double) * 0.00035 when currency = 933 then "
            "cast(amount as double) * 0.5 else cast(amount as double) end")
FLAT_CUR = "case when currency in (704, 360, 410, 170, 933) then 840 else currency end"
register("fx_flat", q(["tx_e"], f"select cl_id, tx_id, {FLAT_AMT} amount_flat, {FLAT_CUR} currency_flat from tx_e"))
register("fx_asof_tolerance", q(["tx_e", "fx"], """
select t.cl_id, t.tx_id, t.currency, case when t.code in (840, 978) then (case when t.d - f.day <= 9
  then t.amt * cast(f.rate as double) end) else t.amt end amount_rub
from t asof left join fx f on t.code = f.code and t.d >= f.day""", [(
    "t", f"select *, {FLAT_AMT} amt, {FLAT_CUR} code, datediff('day', date '1970-01-01', cast(ts as date)) d from tx_e")]))
register("fx_asof_unbounded", q(["tx_e", "fx"], """
select t.cl_id, t.tx_id, t.currency, case when t.currency in (840, 978) then cast(t.amount as double) *
  cast(f.rate as double) else cast(t.amount as double) end amount_rub
from t asof left join fx f on t.currency = f.code and t.d >= f.day""", [(
    "t", "select *, datediff('day', date '1970-01-01', cast(ts as date)) d from tx_e")]))
register("mcc_dim", "select p_partkey as mcc, p_brand as mcc_category from part")
register("mcc_lookup", q(["tx_l", "mcc_dim"], "select t.cl_id, t.tx_id, t.mcc, m.mcc_category from tx_l t "
                                              "left join mcc_dim m on t.mcc = m.mcc"))
register("mcc_unmatched", q(["tx_l", "mcc_dim"], "select cl_id, tx_id, mcc from tx_l t where not exists "
                                                 "(select 1 from mcc_dim m where m.mcc = t.mcc)"))

# --------------------------------------------------------------------------- scans, sinks, sets, metrics
register("scan_csv_roundtrip", q(["tx_e"], """
select cl_id, mcc, channel_type, currency, date_trunc('second', ts) trx_time, cast(amount as double) amount, category,
  cast(date_trunc('month', ts) as date) period from tx_e"""))
register("scan_text_split", q(["tx_e", "cust_lbl"], """
select t.cl_id, t.mcc, cast(t.amount as double) amount, t.category,
  case when l.cl_id is not null then 10 else 8 end n_fields
from tx_e t left join cust_lbl l on t.cl_id = l.cl_id where t.category <> 'error'"""))
_damaged = """select case when category = 'error' then 'short' when channel_type is null then 'time' when category = 'signup' then 'amount' end reason, amount,
  strftime(date_trunc('month', ts), '%d/%m/%Y') || ',' || cl_id || case when category = 'error' then '' else ',' || mcc || ',' || coalesce(channel_type, '')
  || ',' || currency || ',' || case when channel_type is null then 'bad' || tx_id else upper(strftime(ts, '%d%b%y:%H:%M:%S')) end || ','
  || case when category = 'signup' then 'n/a' else cast(amount as varchar) end || ',' || category end as line from tx_e"""
_header = "PERIOD,cl_id,MCC,channel_type,currency,TRDATETIME,amount,trx_category"
register("rejected_lines", q(["tx_e"], f"select line, reason from ({_damaged}) where reason is not null union all select '{_header}', 'header'"))
register("sorted_lines", q(["tx_e"], f"""select coalesce(reason, 'accepted') reason, count(*) n,
  case when reason is null then round(cast(sum(amount) as double), 2) end amount from ({_damaged}) group by reason
  union all select 'header', 1, null"""))
register("optional_targets", q(["tx_e", "cust_lbl"], """
select t.cl_id, cast(t.amount as double) amount, coalesce(cast(l.target_flag as double), 0) target_flag,
  coalesce(cast(l.target_sum as double), 0) target_sum
from tx_e t left join cust_lbl l on t.cl_id = l.cl_id"""))
register("sink_predictions_roundtrip", q(["cust_lbl"], "select cl_id as \"_ID_\", round(ln(cast(target_sum as double) "
                                                      "+ 1), 6) as \"_VAL_\" from cust_lbl"))
register("input_counts", q(["tx_e", "cust_lbl"], """
select case when l.target_flag is not null then 'train' else 'test' end source, count(*) n
from tx_e t left join cust_lbl l on t.cl_id = l.cl_id group by 1"""))
register("preview_top10", q(["tx_e"], "select cl_id, tx_id, ts, category, cast(amount as double) amount from tx_e "
                                      "order by cl_id, ts, tx_id limit 10"))
register("union_train_test", q(["tx_e"], "select cl_id, tx_id, cast(amount as double) amount from tx_e"))
register("split_labelled", q(["tx_e", "cust_lbl"], """
select c.cl_id, case when l.target_flag is not null then 'train' else 'test' end part
from (select distinct cl_id from tx_e) c left join cust_lbl l on c.cl_id = l.cl_id"""))
register("target_log", q(["cust_lbl"], "select cl_id, round(ln(cast(target_sum as double) + 1), 6) y_log from cust_lbl"))
register("target_unlog_clip", q(["cust_lbl"], "select cl_id, round(greatest(exp(round(ln(cast(target_sum as double) "
                                              "+ 1), 6) - 3.0) - 1, 0), 6) pred from cust_lbl"))
register("minmax_scale", q(["cust_lbl"], """
select cl_id, round((s - mn) / nullif(mx - mn, 0), 6) score_scaled from
 (select cl_id, cast(target_sum as double) s, min(cast(target_sum as double)) over () mn,
   max(cast(target_sum as double)) over () mx from cust_lbl)"""))
register("hash_split", q(["tx_e"], """
select cl_id, cast(h % 10 as int) fold, case when h % 10 < 8 then 1 else 0 end is_train
from (select cl_id, cast('0x' || substr(md5(cast(cl_id as varchar) || ':42'), 1, 8) as bigint) h
      from (select distinct cl_id from tx_e))"""))
register("string_index", q(["tx_e"], """
select t.cl_id, t.tx_id, cast(d.i as int) category_index from tx_e t join
 (select category, row_number() over (order by n desc, category) - 1 i from
   (select category, count(*) n from tx_e where category is not null group by category)) d on t.category = d.category"""))
register("roc_auc", """
with s as (select cast(quality as double) label, cast(toxic as double) * 0.5 + cast(doc_id % 7 as double) / 10.0 score
           from labels),
 g as (select score, sum(case when label = 1 then 1 else 0 end) pos, sum(case when label = 1 then 0 else 1 end) neg
       from s group by score),
 c as (select *, coalesce(sum(neg) over (order by score rows between unbounded preceding and 1 preceding), 0) below
       from g)
select round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) auc from c""")
register("rmsle", q(["tx_e", "cust_lbl"], """
select round(sqrt(avg(pow(p - y, 2))), 6) rmse from (
  select round(ln(cast(t.total / 5 as double) + 1), 6) p, round(ln(cast(l.target_sum as double) + 1), 6) y
  from (select cl_id, sum(amount) total from tx_e group by cl_id) t join cust_lbl l on t.cl_id = l.cl_id)"""))
_HIST = """select cast(least(floor((pred - mn) / nullif(mx - mn, 0) * 50) + 1, 50) as int) bin from
 (select pred, min(pred) over () mn, max(pred) over () mx from ({src}))"""
register("prediction_histogram", q(["cust_lbl"], f"""
select bin, count(*) n, 'linear' scale from ({_HIST.format(src="select cast(target_sum as double) pred from cust_lbl")})
group by bin
union all
select bin, count(*) n, 'log' scale from ({_HIST.format(src="select ln(cast(target_sum as double) + 1) pred from cust_lbl")})
group by bin"""))
