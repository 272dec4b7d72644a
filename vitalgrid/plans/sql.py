"""Common table expressions shared by the check SQL."""

SAMPLES = """samples as (
  select user_id, case event_type when 'view' then 'heart_rate' when 'click' then 'steps'
         when 'purchase' then 'sleep' else event_type end as metric, ts, value, event_id from events)"""

POOLED = SAMPLES + """, pooled as (select -2::bigint as user_id, metric, ts, value, event_id from samples)"""

DAILY = SAMPLES + """, per_user as (
  select user_id, metric, cast(ts as date) as ds, sum(value) as s, count(value) as c
  from samples where value is not null group by all),
everyone as (select -2::bigint as user_id, metric, ds, sum(s) as s, sum(c) as c from per_user group by metric, ds),
daily as (
  select user_id, metric, ds, case when metric = 'heart_rate' then s / c else s end as y
  from (select * from per_user union all select * from everyone)
  union all
  select -1::bigint, o_orderpriority, cast(o_orderdate as date), sum(o_totalprice) from orders group by 2, 3)"""

_LINES = """
  union all
  select l_suppkey, l_returnflag, cast(l_shipdate as date), sum(l_quantity) from lineitem group by 1, 2, 3)"""

WINDOW_DAILY = DAILY + ", window_daily as (select * from daily" + _LINES

#: ``daily`` with the series of suppliers, for whatever needs users with windows.
DAILY_LINES = DAILY.replace("\ndaily as (", "\ndevice_daily as (") + ", daily as (select * from device_daily" + _LINES

USERS = SAMPLES + """, pooled as (select user_id, metric, ts, value, event_id from samples)"""

_MINUTES = """, minutes as (
  select user_id, metric, date_trunc('minute', ts) as ts,
         case when metric = 'heart_rate' then avg(value) else coalesce(sum(value), 0) end as value
  from pooled group by user_id, metric, 3)"""

#: Minutes with data, of every user; dense grids are built for all users together.
MINUTES = USERS + _MINUTES

GRID = POOLED + _MINUTES + """, spans as (select user_id, metric, min(ts) as lo, max(ts) as hi from minutes group by all),
grid as (select s.user_id, s.metric, g.ts, m.value
  from (select user_id, metric, unnest(generate_series(lo, hi, interval 1 minute)) as ts from spans) g
  join spans s using (user_id, metric) left join minutes m using (user_id, metric, ts))"""

#: The same grids for every user apart.
USER_GRID = GRID.replace(POOLED, USERS)

INTERVALS = SAMPLES + """, intervals as (
  select user_id, ts as start_ts, make_timestamp(epoch_us(ts) + cast(round(value * 60000000) as bigint)) as end_ts
  from samples where metric = 'sleep'),
asleep as (
  select user_id, unnest(generate_series(date_trunc('minute', start_ts),
    greatest(date_trunc('minute', start_ts), end_ts - interval 1 microsecond), interval 1 minute)) as ts,
    1.0 / 60.0 as value from intervals)"""


def interpolated(source: str, limit: int, part: str, value: str = "value") -> str:
    """Gap filling over ``source`` with the other columns kept, as a select."""
    w = f"partition by {part} order by ts"
    return f"""select * exclude ({value}, grp, pos, t0, v0, t1, v1),
      case when {value} is not null then {value}
           when grp = 0 or pos > {limit} then null
           when t1 is null then v0
           else v0 + (v1 - v0) * (epoch_us(ts) - epoch_us(t0)) / (epoch_us(t1) - epoch_us(t0)) end as {value}
    from (select *, row_number() over (partition by {part}, grp order by ts) - 1 as pos,
            first_value(ts) over (partition by {part}, grp order by ts) as t0,
            first_value({value}) over (partition by {part}, grp order by ts) as v0
          from (select *, count({value}) over ({w}) as grp,
                  first_value(case when {value} is not null then ts end ignore nulls)
                    over ({w} rows between 1 following and unbounded following) as t1,
                  first_value({value} ignore nulls)
                    over ({w} rows between 1 following and unbounded following) as v1
                from {source}))"""


STATS = """select user_id, metric, count(y) as n, avg(y) as mean, quantile_cont(y, 0.5) as median,
  stddev_samp(y) as std, min(y) as min, max(y) as max, max(y) - min(y) as range from daily group by all"""

RANKED = """select *, row_number() over (partition by user_id, metric order by ds desc) as back,
  row_number() over (partition by user_id, metric order by ds) as fwd,
  count(*) over (partition by user_id, metric) as n from daily"""
