"""Independent SQL statements of every registered query, for DuckDB over the driver's tables.

Each statement starts with the FIXTURES.md §2 views it needs as CTEs. They are written separately from the
DataFrame code on purpose: they are the correctness oracle, not the implementation.
"""

from __future__ import annotations

import re

from roadflow.plans.params import (
    RANGE_HI,
    RANGE_LO,
    RUN_DATE,
    SLICE_RUN_DATE,
    STREAM_LOCAL_PREFIX,
    TOP_N,
    WINDOW_SIZE_H,
    WINDOW_SLIDE_H,
)

VIEWS = {
    "flow": """
select l_orderkey as order_key, l_linenumber as line_no,
  cast(l_shipdate as date) as create_date,
  lpad(cast(l_suppkey % 9 as string), 4, '0') as block_id,
  lpad(cast(l_suppkey as string), 5, '0') as monitor_id,
  concat(case when o_custkey % 50 = 13 then '粤' else substr('黑黑黑京沪琼黑辽吉闽', cast(o_custkey % 10 as int) + 1, 1) end,
         chr(cast(65 + o_custkey % 26 as int)), lpad(cast(o_custkey as string), 5, '0')) as plate,
  l_shipdate + ((l_orderkey * 7 + l_linenumber * 3571) % 86400) * interval '1' second as action_time,
  cast(l_quantity as int) * 3 - 3 as speed,
  cast(l_partkey as string) as road_id,
  lpad(cast(l_partkey % 25 as string), 2, '0') as area_id
from lineitem join orders on l_orderkey = o_orderkey""",
    "registry": """
select lpad(cast(s_suppkey % 9 as string), 4, '0') as block_id,
  lpad(cast(s_suppkey as string), 5, '0') as monitor_id
from supplier where s_suppkey % 10 <> 7
union all
select lpad(cast(s_suppkey % 9 as string), 4, '0'), concat('N', lpad(cast(s_suppkey as string), 5, '0'))
from supplier where s_suppkey % 10 = 3
union all
select '0009', concat('N', lpad(cast(s_suppkey as string), 5, '0'))
from supplier where s_suppkey % 10 = 4""",
    "district": "select n_nationkey as district_id, n_name as district_name from nation where n_nationkey % 8 <> 5",
    "road": "select p_partkey as road_id, p_name as road_name from part where p_partkey % 25 <> 0",
    "requests": """
select concat(case when c_custkey % 50 = 13 then '粤' else substr('黑黑黑京沪琼黑辽吉闽', cast(c_custkey % 10 as int) + 1, 1) end,
         chr(cast(65 + c_custkey % 26 as int)), lpad(cast(c_custkey as string), 5, '0')) as plate
from customer where c_custkey % 50 in (3, 13)""",
    "flow_events": """
select event_id, ts as action_time, cast(ts as date) as create_date,
  lpad(cast(user_id % 9 as string), 4, '0') as block_id,
  lpad(cast(event_id % 100 as string), 5, '0') as monitor_id,
  concat(case when user_id % 50 = 13 then '粤' else substr('黑黑黑京沪琼黑辽吉闽', cast(user_id % 10 as int) + 1, 1) end,
         chr(cast(65 + user_id % 26 as int)), lpad(cast(user_id as string), 5, '0')) as plate,
  cast(floor(value * 10) as int) % 140 as speed,
  cast(cast(regexp_extract(props, '[0-9]+', 0) as int) % 50 + 1 as string) as road_id,
  lpad(cast(cast(regexp_extract(props, '[0-9]+', 0) as int) % 8 as string), 2, '0') as area_id
from events""",
    # Province dimension (fixed values, display order).
    "province": """
select * from (values ('黑', '黑龙江', 1), ('京', '北京', 2), ('沪', '上海', 3), ('琼', '海南', 4),
  ('辽', '辽宁', 5), ('吉', '吉林', 6), ('闽', '福建', 7)) as t(prefix, province, ord)""",
}

TIE = "block_id, monitor_id, road_id, area_id, speed"
FTIE = "f.action_time, f.block_id, f.monitor_id, f.road_id, f.area_id, f.speed"


def with_views(body: str) -> str:
    """Prefix ``body`` with the views it mentions (word match), as CTEs, in dependency order."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    if not used:
        return body.strip()
    ctes = ",\n".join(f"{v} as ({VIEWS[v].strip()})" for v in used)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


BODIES: dict[str, str] = {}

BODIES["device_status"] = f"""
select date '{RUN_DATE}' as create_date, r.block_id as blockid,
  count(*) as monitor_standard_count,
  count(s.monitor_id) as normal_monitor_count,
  count(*) - count(s.monitor_id) as abnormal_monitor_count,
  coalesce(string_agg(case when s.monitor_id is null then r.monitor_id end, ',' order by r.monitor_id), '')
    as abnormal_monitor_camera_infos
from (select distinct block_id, monitor_id from registry) r
left join (select distinct block_id, monitor_id from flow) s
  on r.block_id = s.block_id and r.monitor_id = s.monitor_id
group by r.block_id
"""

BODIES["device_status_daily"] = """
select d.create_date, d.block_id as blockid,
  count(c.monitor_id) as monitor_standard_count,
  count(c.monitor_id) filter (where c.online) as normal_monitor_count,
  count(c.monitor_id) filter (where not c.online) as abnormal_monitor_count
from (select distinct create_date, block_id from flow) d
left join (
  select dd.create_date, r.block_id, r.monitor_id, s.monitor_id is not null as online
  from (select distinct create_date, block_id from flow) dd
  join (select distinct block_id, monitor_id from registry) r on r.block_id = dd.block_id
  left join (select distinct create_date, block_id, monitor_id from flow) s
    on s.create_date = dd.create_date and s.block_id = dd.block_id and s.monitor_id = r.monitor_id
) c on c.create_date = d.create_date and c.block_id = d.block_id
group by d.create_date, d.block_id
"""

BODIES["offline_cameras"] = """
select r.block_id as blockid, r.monitor_id
from (select distinct block_id, monitor_id from registry) r
where not exists (select 1 from flow f where f.block_id = r.block_id and f.monitor_id = r.monitor_id)
"""

BODIES["offline_cameras_daily"] = """
with days as (
  select create_date, block_id, row_number() over (partition by block_id order by create_date) as n
  from (select distinct create_date, block_id from flow)),
silent as (
  select dd.create_date, r.block_id, r.monitor_id,
    dd.n - row_number() over (partition by r.block_id, r.monitor_id order by dd.n) as stretch
  from days dd
  join (select distinct block_id, monitor_id from registry) r on r.block_id = dd.block_id
  where not exists (select 1 from flow f where f.create_date = dd.create_date and f.block_id = r.block_id
                    and f.monitor_id = r.monitor_id))
select block_id as blockid, monitor_id, min(create_date) as silent_from, max(create_date) as silent_to,
  count(*) as silent_days
from silent group by block_id, monitor_id, stretch
"""

BODIES["unregistered_cameras"] = """
select f.block_id as blockid, f.monitor_id, count(*) as sightings,
  min(action_time) as first_seen, max(action_time) as last_seen
from flow f
where not exists (select 1 from registry r where r.block_id = f.block_id and r.monitor_id = f.monitor_id)
group by f.block_id, f.monitor_id
"""

BODIES["block_vehicle_counts"] = """
select block_id as blockid, count(distinct plate) as auto_count from flow group by block_id
"""

BODIES["block_vehicle_topn"] = f"""
select date '{RUN_DATE}' as create_date, blockid, auto_count from (
  select block_id as blockid, count(distinct plate) as auto_count from flow group by block_id
) order by auto_count desc, blockid limit {TOP_N}
"""

BODIES["block_vehicle_topn_packed"] = f"""
select date '{RUN_DATE}' as create_date,
  string_agg(blockid, '|' order by auto_count desc, blockid) as blockid,
  string_agg(cast(auto_count as varchar), '|' order by auto_count desc, blockid) as auto_count
from (
  select block_id as blockid, count(distinct plate) as auto_count from flow group by block_id
  order by auto_count desc, blockid limit {TOP_N}
)
"""

BODIES["block_speed_bands"] = f"""
select date '{RUN_DATE}' as create_date, block_id as blockid,
  count(*) filter (where speed > 0 and speed < 60) as min_Speed,
  count(*) filter (where speed >= 60 and speed < 90) as normal_Speed,
  count(*) filter (where speed >= 90 and speed < 120) as med_Speed,
  count(*) filter (where speed >= 120) as high_Speed,
  round(avg(speed), 3) as avg_Speed
from flow group by block_id
"""

BODIES["block_speed_web"] = f"""
select date '{RUN_DATE}' as create_date,
  string_agg('(' || blockid || ',' || printf('%.3f', avg_Speed) || ')', '>' order by avg_Speed desc, blockid) as avg_speed
from (select block_id as blockid, round(avg(speed), 3) as avg_Speed from flow group by block_id)
"""

BODIES["inbound_sightings"] = """
select action_time as inbound_date, plate, block_id as first_inbound_position, road_id as roadid,
  area_id as areaid, monitor_id, speed
from flow where not starts_with(plate, '黑')
"""

BODIES["inbound_first_seen"] = f"""
select plate, action_time as first_time, block_id as first_inbound_position, road_id as roadid,
  area_id as areaid, sightings
from (
  select *, row_number() over (partition by plate order by action_time, {TIE}) as rn,
    count(*) over (partition by plate) as sightings
  from flow where not starts_with(plate, '黑')
) where rn = 1
"""

BODIES["inbound_summary"] = """
with nl as (select * from flow where not starts_with(plate, '黑')),
firsts as (select plate, cast(min(action_time) as date) as d from nl group by plate)
select n.create_date, count(*) as inbound_sightings, count(distinct n.plate) as inbound_vehicles,
  coalesce((select count(*) from firsts f where f.d = n.create_date), 0) as new_vehicles
from nl n group by n.create_date
"""

BODIES["vehicle_track"] = f"""
select date '{RUN_DATE}' as create_date, plate,
  string_agg(block_id, '>' order by action_time, {TIE}) as blockid,
  string_agg(road_id, '>' order by action_time, {TIE}) as roadid,
  string_agg(area_id, '>' order by action_time, {TIE}) as districtid
from flow where plate in (select plate from requests where length(plate) > 0)
group by plate
"""

BODIES["vehicle_track_named"] = f"""
select date '{RUN_DATE}' as create_date, plate,
  string_agg(f.block_id, '>' order by {FTIE}) as blockid,
  string_agg(coalesce(rd.road_name, f.road_id), '>' order by {FTIE}) as roadid,
  string_agg(coalesce(d.district_name, f.area_id), '>' order by {FTIE}) as districtid
from (select * from flow where plate in (select plate from requests where length(plate) > 0)) f
left join district d on d.district_id = try_cast(f.area_id as bigint)
left join road rd on rd.road_id = try_cast(f.road_id as bigint)
group by plate
"""

BODIES["vehicle_track_steps"] = f"""
select plate, row_number() over (partition by plate order by action_time, {TIE}) as step, action_time,
  block_id as blockid, road_id as roadid, area_id as districtid
from flow where plate in (select plate from requests where length(plate) > 0)
"""

BODIES["province_counts"] = """
with counts as (select substr(plate, 1, 1) as prefix, count(*) as n from flow group by 1)
select p.province, p.ord, coalesce(c.n, 0) as sightings
from province p left join counts c on c.prefix = p.prefix
union all
select 'other', 8, cast(coalesce((select sum(n) from counts where prefix not in (select prefix from province)), 0) as bigint)
"""

BODIES["province_snapshot"] = """
with counts as (select substr(plate, 1, 1) as prefix, count(*) as n from flow group by 1),
folded as (
  select p.province, p.ord, coalesce(c.n, 0) as sightings
  from province p left join counts c on c.prefix = p.prefix
  union all
  select 'other', 8, cast(coalesce((select sum(n) from counts where prefix not in (select prefix from province)), 0) as bigint))
select string_agg(province, '|' order by ord) as provinceList,
  string_agg(cast(sightings as varchar), '|' order by ord) as provinceCount
from folded
"""

BODIES["flow_by_hour"] = """
select strftime(action_time, '%Y-%m-%d_%H') as date_hour, block_id as blockid,
  count(*) as sightings, count(distinct plate) as vehicles
from flow group by 1, 2
"""

BODIES["flow_by_5min"] = """
select ws as window_start,
  strftime(ws, '%Y-%m-%d %H:%M') || '~' ||
    case when minute(ws) = 55 then strftime(ws, '%Y-%m-%d ') || lpad(cast(hour(ws) + 1 as varchar), 2, '0') || ':00'
         else strftime(ws + interval 5 minute, '%Y-%m-%d %H:%M') end as time_range,
  blockid, sightings, vehicles, avg_speed
from (
  select time_bucket(interval '5 minutes', action_time) as ws, block_id as blockid,
    count(*) as sightings, count(distinct plate) as vehicles, round(avg(speed), 3) as avg_speed
  from flow group by 1, 2)
"""

BODIES["sighting_gap"] = f"""
select plate, action_time, block_id as blockid,
  lag(action_time) over w as prev_time, lag(block_id) over w as prev_blockid,
  date_diff('second', lag(action_time) over w, action_time) as gap_seconds
from flow
window w as (partition by plate order by action_time, {TIE})
"""

FLOW_COLS = "create_date, block_id, monitor_id, plate, action_time, speed, road_id, area_id"

BODIES["flow_between"] = f"""
select {FLOW_COLS} from flow
where action_time > timestamp '{RANGE_LO}' and action_time < timestamp '{RANGE_HI}'
"""

BODIES["date_keys"] = """
select plate, block_id as blockid, monitor_id, action_time,
  strftime(action_time, '%Y%m%d') as date_key, strftime(action_time, '%Y-%m-%d') as date_text,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') as time_text, strftime(action_time, '%Y%m%d%H%M') as minute_key,
  cast(strptime(strftime(action_time, '%Y%m%d'), '%Y%m%d') as date) as date_key_parsed
from flow
"""

BODIES["flow_day_slice"] = f"""
select {FLOW_COLS} from flow where create_date = cast(date '{SLICE_RUN_DATE}' - interval 1 day as date)
"""

BODIES["typed_ingest"] = """
select case when speed = 0 then 'bad_speed' when starts_with(plate, '粤') then 'empty_key' else 'accepted' end as status,
  count(*) as rows
from flow group by 1
"""

BODIES["fixed_width_ids"] = """
select distinct cast(order_key as varchar) as order_key,
  case when length(cast(order_key as varchar)) < 4 then lpad(cast(order_key as varchar), 4, '0')
       else cast(order_key as varchar) end as order_key_4,
  road_id, case when length(road_id) = 1 then '0' || road_id else road_id end as road_id_2
from flow
"""

BODIES["kv_expand"] = """
select order_key, line_no, cast(speed as varchar) as speed_first, cast(speed + 1 as varchar) as speed_last,
  road_id as road, area_id as lane, cast(3 as bigint) as n_keys
from flow
"""

BODIES["kv_update"] = """
select order_key, line_no,
  'speed=' || case when speed > 0 and speed < 60 then 'min' when speed >= 60 and speed < 90 then 'normal'
                   when speed >= 90 and speed < 120 then 'med' when speed >= 120 then 'high' else 'none' end
  || '|road=' || road_id || '|x=1=2|bad=|lane=' || area_id || '=|speed=' || cast(speed + 1 as varchar) as attrs
from flow
"""

BODIES["comma_clean"] = """
select order_key, line_no,
  case when speed = 0 then ',' else ',' || block_id || ',' || monitor_id || ',' end as raw,
  case when speed = 0 then '' else block_id || ',' || monitor_id end as cleaned
from flow
"""

BODIES["stream_window_speed"] = f"""
select ws as window_start, ws + interval {WINDOW_SIZE_H} hour as window_end, block_id as blockid,
  cast(sum(speed) // count(speed) as bigint) as avg_speed, count(*) as sightings
from (
  select time_bucket(interval {WINDOW_SLIDE_H} hour, action_time) as ws, block_id, speed from flow_events
  union all
  select time_bucket(interval {WINDOW_SLIDE_H} hour, action_time) - interval {WINDOW_SLIDE_H} hour as ws, block_id, speed
  from flow_events)
group by ws, block_id
"""

BODIES["stream_totals"] = f"""
select count(*) as current_auto_count,
  count(*) filter (where not starts_with(plate, '{STREAM_LOCAL_PREFIX}')) as current_inbound_auto
from flow_events
"""

BODIES["stream_provinces"] = BODIES["province_counts"].replace("from flow group by", "from flow_events group by")

BODIES["stream_event_window"] = BODIES["stream_window_speed"]
BODIES["stream_live_windows"] = BODIES["stream_window_speed"]

BODIES["stream_alerts"] = """
select create_date as create_time, plate, block_id as blockid, action_time as time, road_id as roadid,
  area_id as areaid, strftime(action_time, '%H:%M') as alert_time
from flow_events where plate in (select plate from requests where length(plate) > 0)
"""

BODIES["stream_track_requests"] = BODIES["vehicle_track"]
BODIES["stream_track_json"] = BODIES["vehicle_track_named"]
BODIES["topn_snapshot"] = BODIES["block_vehicle_topn_packed"]
BODIES["speed_bands_view"] = BODIES["block_speed_bands"]

BODIES["registry_tsv"] = """
select block_id as blockid, monitor_id, 'accepted' as status from registry
union all
select distinct block_id, cast(null as varchar), 'short_line' from registry
"""

DEVICE_STATUS_CTE = BODIES["device_status"]

BODIES["device_chart_snapshot"] = f"""
with st as ({DEVICE_STATUS_CTE})
select string_agg(blockid, '|' order by blockid) as blockid,
  string_agg(cast(abnormal_monitor_count as varchar), '|' order by blockid) as brokenCount,
  string_agg(cast(monitor_standard_count as varchar), '|' order by blockid) as monitorSum
from st
"""

BODIES["device_web_snapshot"] = f"""
with st as ({DEVICE_STATUS_CTE})
select create_date,
  string_agg('(' || blockid || ',' || cast(abnormal_monitor_count as varchar) || '|' || abnormal_monitor_camera_infos || ')',
             '>' order by blockid) as blockMonitor
from st group by create_date
"""

BODIES["table_append"] = f"""
select * from ({BODIES["block_speed_bands"]}) union all select * from ({BODIES["block_speed_bands"]})
"""

WINDOW_SPEEDS = BODIES["stream_window_speed"]

BODIES["stream_speed_rank"] = f"""
select window_start, window_end,
  string_agg(blockid, '|' order by avg_speed desc, blockid) as blockRank,
  string_agg(cast(avg_speed as varchar), '|' order by avg_speed desc, blockid) as speedRank
from ({WINDOW_SPEEDS}) group by window_start, window_end
"""

BODIES["stream_live_snapshot"] = f"""
with t as ({BODIES["stream_totals"]}),
r as (
  select window_start,
    string_agg(blockid, '|' order by avg_speed desc, blockid) as blockRank,
    string_agg(cast(avg_speed as varchar), '|' order by avg_speed desc, blockid) as speedRank
  from ({WINDOW_SPEEDS}) group by window_start)
select date '{RUN_DATE}' as create_date, t.current_auto_count as currentAutoCount,
  t.current_inbound_auto as currentInboundAuto, r.window_start, r.blockRank, r.speedRank
from t, r where r.window_start = (select max(window_start) from r)
"""

LATEST_RANK = f"""
  select string_agg(blockid, '|' order by avg_speed desc, blockid) as blocks,
    string_agg(cast(avg_speed as varchar), '|' order by avg_speed desc, blockid) as speeds,
    string_agg('(' || blockid || ',' || cast(avg_speed as varchar) || ')', '>' order by avg_speed desc, blockid) as pairs
  from w where window_start = (select max(window_start) from w)"""

BODIES["stream_live_web"] = f"""
with t as ({BODIES["stream_totals"]}), w as ({WINDOW_SPEEDS}), r as ({LATEST_RANK})
select date '{RUN_DATE}' as create_date, current_auto_count as currentAutoCount, current_inbound_auto as currentInboundAuto,
  pairs as speedRank
from t, r
"""

BODIES["stream_live_chart"] = f"""
with t as ({BODIES["stream_totals"]}), w as ({WINDOW_SPEEDS}), r as ({LATEST_RANK})
select date '{RUN_DATE}' as create_date, current_auto_count as currenAutoCount, current_inbound_auto as currentInboundAuto,
  blocks as blockRank, speeds as speedRank
from t, r
"""

BODIES["stream_province_snapshot"] = BODIES["province_snapshot"].replace("from flow group by", "from flow_events group by")

BODIES["tsv_ingest"] = """
select status, create_date, count(*) as rows from (
  select case when speed = 0 then 'bad_speed' when starts_with(plate, '粤') then 'empty_key' else 'accepted' end as status,
    case when speed = 0 or starts_with(plate, '粤') then null else create_date end as create_date
  from flow)
group by status, create_date
"""


BODIES["table_append_once"] = f"""
select r.run_id, b.* from ({BODIES["block_speed_bands"]}) b cross join (values ('a'), ('b')) as r(run_id)
"""

BODIES["block_vehicle_sketch_bound"] = f"""
select block_id as blockid, count(distinct plate) as autocount, count(*) as sightings, true as within_bound
from flow where create_date between date '{RANGE_LO[:10]}' and date '{RANGE_HI[:10]}' group by block_id
"""

BODIES["vehicle_track_store"] = BODIES["vehicle_track"]
BODIES["stream_track_store"] = BODIES["vehicle_track"]

BODIES["listed_sightings"] = """
select plate, block_id as blockid, action_time as time, speed from flow
where plate in (select plate from requests where length(plate) > 0)
"""

BODIES["stream_watch_join"] = """
select f.plate, w.action_time as asked_at, f.action_time as time, f.block_id as blockid, f.road_id as roadid, f.area_id as areaid
from flow_events f join flow_events w on f.plate = w.plate and w.event_id % 50 = 7
  and f.action_time between w.action_time and w.action_time + interval 12 hour
"""

BODIES["stream_first_seen"] = f"""
select plate, action_time as first_time, block_id as first_inbound_position, road_id as roadid, area_id as areaid
from (
  select *, row_number() over (partition by plate order by action_time, {TIE}) as rn
  from flow_events where not starts_with(plate, '黑'))
where rn = 1
"""

BODIES["stream_totals_state"] = BODIES["stream_totals"]
BODIES["stream_provinces_state"] = BODIES["stream_provinces"]


def oracle_sql() -> dict[str, str]:
    return {name: with_views(body) for name, body in BODIES.items()}
