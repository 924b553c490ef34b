"""Reference SQL for the registered queries, runnable by DuckDB.

The statements are written independently of the Spark plans: as-of joins
instead of windows over a union, correlated joins instead of running sums,
window expansion instead of panes.
"""

from __future__ import annotations

_READINGS = """
readings as (
  select event_id as reading_id, 's' || cast(user_id as varchar) as sensorid, ts as timestamp, value as rawValue
  from events where event_type in ('click', 'view', 'error')
)"""

_UPDATES = """
updates as (
  select event_id as update_id, 's' || cast(user_id as varchar) as sensorid, ts as timestamp,
    case event_id % 5 when 0 then 'geolocation' when 1 then 'cell' when 2 then 'type'
      when 3 then 'unit' else 'conversion' end as parameter,
    case event_id % 5
      when 0 then case when event_id % 35 = 0 then 'nowhere'
        else '52.' || lpad(cast(event_id % 1000 as varchar), 3, '0') || ',13.'
          || lpad(cast(event_id % 700 as varchar), 3, '0') end
      when 1 then cast(event_id % 7 as varchar)
      when 2 then 'T' || cast(event_id % 3 as varchar)
      when 3 then case event_id % 2 when 0 then 'mm' else 'l/s' end
      else case when event_id % 45 = 4 then '[(0,0)]'
        else '[(0, 0),(50.5,' || cast(event_id % 90 + 1 as varchar) || '),(300,'
          || cast(event_id % 90 + 200 as varchar) || ')]' end
    end as value
  from events where event_type in ('signup', 'purchase')
)"""

# Queries of readings alone or of updates alone take all events.
_ALL_READINGS = _READINGS.replace(" where event_type in ('click', 'view', 'error')", "")
_ALL_UPDATES = _UPDATES.replace(" where event_type in ('signup', 'purchase')", "")

# Curve points of every conversion update, as rows and with a flag for usable curves.
_CURVES = r"""
curve_texts as (
  select update_id, value from updates where parameter = 'conversion'
), curve_points as (
  select update_id, pos, cast(list_extract(xs, pos) as double) as x, cast(list_extract(ys, pos) as double) as y
  from (
    select update_id, xs, ys, unnest(generate_series(1, len(xs))) as pos
    from (
      select update_id,
        regexp_extract_all(value, '(-?\d+\.*\d*),\s*(-?\d+\.*\d*)', 1) as xs,
        regexp_extract_all(value, '(-?\d+\.*\d*),\s*(-?\d+\.*\d*)', 2) as ys
      from curve_texts
    )
  )
), good_curves as (
  select update_id from (
    select update_id, x > lag(x) over (partition by update_id order by pos) as rises from curve_points
  ) group by update_id having count(*) >= 2 and bool_and(coalesce(rises, true))
), segments as (
  select update_id, x as x0, y as y0,
    lead(x) over (partition by update_id order by pos) as x1,
    lead(y) over (partition by update_id order by pos) as y1,
    row_number() over (partition by update_id order by pos desc) as from_end
  from curve_points where update_id in (select update_id from good_curves)
)"""


def _hex_cell(lat: str, lon: str) -> str:
    """Scalar subquery for the hexagon of a point."""
    return f"""(
    select (case when dq > dr and dq > ds then -rr - rs else rq end + 1073741824) * 2147483648
      + (case when not (dq > dr and dq > ds) and dr > ds then -rq - rs else rr end + 1073741824)
    from (
      select rq, rr, rs, abs(rq - q) as dq, abs(rr - r) as dr, abs(rs - s) as ds
      from (
        select q, r, s, cast(floor(q + 0.5) as bigint) as rq, cast(floor(r + 0.5) as bigint) as rr,
          cast(floor(s + 0.5) as bigint) as rs
        from (
          select q, r, -q - r as s
          from (
            select (sqrt(3.0) / 3.0 * x - y / 3.0) / 200.0 as q, (2.0 / 3.0 * y) / 200.0 as r
            from (
              select 6371008.8 * radians({lon}) * cos(radians(52.5)) as x, 6371008.8 * radians({lat}) as y
            )
          )
        )
      )
    )
  )"""


def _asof(name: str, parameter: str) -> str:
    return f"""
{name} as (
  select r.reading_id, u.update_id, u.value
  from readings r asof left join (select * from updates where parameter = '{parameter}') u
    on r.sensorid = u.sensorid and r.timestamp > u.timestamp
)"""


_CELLS = f"""
cells as (
  select update_id, value,
    {_hex_cell("lat", "lon")} as cell
  from (
    select update_id, value, try_cast(split_part(value, ',', 1) as double) as lat,
      try_cast(split_part(value, ',', 2) as double) as lon
    from updates where parameter = 'geolocation'
  )
)"""

_ENRICH = f"""
with {_READINGS}, {_UPDATES}, {_CURVES}, {_CELLS},
{_asof("a_geo", "geolocation")}, {_asof("a_cell", "cell")}, {_asof("a_type", "type")},
{_asof("a_unit", "unit")}, {_asof("a_conv", "conversion")},
converted as (
  select r.reading_id,
    max(case when s.x1 is null then s.y0
      else s.y0 + (r.rawValue - s.x0) * (s.y1 - s.y0) / (s.x1 - s.x0) end) as v
  from readings r join a_conv using (reading_id) join segments s on s.update_id = a_conv.update_id
  where (r.rawValue >= s.x0 and r.rawValue < s.x1) or (s.from_end = 1 and r.rawValue = s.x0)
  group by r.reading_id
)
select r.reading_id, r.sensorid, r.timestamp, round(r.rawValue, 4) as rawValue,
  coalesce(a_geo.value, 'UNKNOWN') as location,
  coalesce(a_type.value, case when exists (select 1 from updates u where u.sensorid = r.sensorid
    and u.parameter = 'type') then 'NOPARAM' else 'UNKNOWN' end) as type,
  coalesce(a_unit.value, case when exists (select 1 from updates u where u.sensorid = r.sensorid
    and u.parameter = 'unit') then 'NOPARAM' else 'UNKNOWN' end) as unit,
  round(coalesce(converted.v, -99.0), 4) as conValue,
  cast(coalesce(cells.cell, try_cast(a_cell.value as bigint), 999) as bigint) as gridCell
from readings r
join a_geo using (reading_id) join a_cell using (reading_id) join a_type using (reading_id)
join a_unit using (reading_id)
left join converted using (reading_id)
left join cells on cells.update_id = a_geo.update_id
"""

_PACKETS = """
raw_packets as (
  select event_id,
    case event_id % 5
      when 0 then '{"n":"S' || cast(user_id as varchar) || '","t":'
        || cast(1704067200 + event_id * 60 as varchar) || ',"v":' || cast(value as varchar) || '}'
      when 1 then '{"externalDeviceId":"DEV' || cast(user_id as varchar) || '","timestamp":"2024-01-'
        || lpad(cast(event_id % 28 + 1 as varchar), 2, '0') || 'T'
        || lpad(cast(event_id % 24 as varchar), 2, '0') || ':00:00.250Z","decoded":{"level":'
        || cast(value as varchar) || ',"temp":' || cast(event_id % 30 as varchar)
        || ',"Interrupt_status":1}}'
      when 2 then '{"hardware_serial":"TTN' || cast(user_id as varchar) || '","timestamp":"2024-01-'
        || lpad(cast(event_id % 28 + 1 as varchar), 2, '0') || 'T'
        || lpad(cast(event_id % 24 as varchar), 2, '0') || ':30:00.000Z","payload_fields":{"flow":'
        || cast(value as varchar) || '}}'
      when 3 then '{"other":"' || event_type || '"}'
      else '{"n":"S' || cast(user_id as varchar) || '","t":' end as value
  from events
), packets as (
  select event_id, value, case when json_valid(value) then value else '{}' end as j, json_valid(value) as ok
  from raw_packets
)"""

_SENML = """
select event_id, lower(j ->> '$.n') as sensorid,
  make_timestamp(cast(j ->> '$.t' as bigint) * 1000000) as timestamp, cast(j ->> '$.v' as double) as rawValue
from packets where json_exists(j, '$.n')
"""


def _device_packets(device: str, payload: str, where: str) -> str:
    return f"""
select event_id, lower(j ->> '$.{device}') || '-' || k as sensorid,
  strptime(j ->> '$.timestamp', '%Y-%m-%dT%H:%M:%S.%gZ') as timestamp,
  cast(json_extract_string(j, '$.{payload}.' || k) as double) as rawValue
from (
  select event_id, j, unnest(json_keys(j, '$.{payload}')) as k
  from packets where json_exists(j, '$.{device}') and not json_exists(j, '$.n')
) where {where}
"""


_ATLAS = _device_packets("externalDeviceId", "decoded", "k <> 'Interrupt_status'")
_TTN = _device_packets("hardware_serial", "payload_fields", "true")


def _packets(body: str) -> str:
    return f"""
with {_PACKETS}
select event_id, sensorid, timestamp, round(rawValue, 4) as rawValue from ({body})
"""


_MS = "make_timestamp(epoch_us(ts) // 1000 * 1000)"

_CELL_READINGS = """
cell_readings as (
  select event_id as reading_id, 's' || cast(user_id as varchar) as sensorid, {cell} as gridCell,
    ts as timestamp, value as conValue
  from events
)"""


def _neighbor_mean(cell: str) -> str:
    """Latest reading of every sensor before each probe, by a correlated join.

    A reading is its sensor's latest one from its own time until the next.
    """
    return f"""
with {_CELL_READINGS.format(cell=cell)}, spans as (
  select *, lead(timestamp) over (partition by sensorid order by timestamp, reading_id) as until
  from cell_readings
), means as (
  select r.reading_id, r.sensorid, r.gridCell, r.timestamp, r.conValue,
    cast(sum(cast(o.conValue as decimal(28, 6))) as double) / count(*) as cellMean
  from cell_readings r join spans o on o.gridCell = r.gridCell
    and o.timestamp <= r.timestamp and (o.until is null or o.until > r.timestamp)
  group by all
)"""


_CELL = "user_id % 7"
_MEANS = _neighbor_mean(_CELL)


def _neighbor_alerts(threshold: int) -> str:
    return _MEANS + f"""
select reading_id, sensorid, timestamp, round(conValue, 8) as value,
  round(cellMean - {threshold}, 8) as lower, round(cellMean + {threshold}, 8) as upper
from means where abs(cellMean - conValue) > {threshold}
"""


def _expanded(sensor: str, size_s: int, slide_s: int) -> str:
    """Every reading once for each window that holds it."""
    return f"""
expanded as (
  select event_id as reading_id, {sensor} as sensorid, ts as timestamp, value as v,
    unnest(generate_series(
      (epoch_us(ts) // {slide_s}000000) * {slide_s} - {size_s} + {slide_s},
      (epoch_us(ts) // {slide_s}000000) * {slide_s}, {slide_s})) as start_s
  from events
)"""


def _window_times(size_s: int) -> str:
    return (
        "make_timestamp(start_s * 1000000) as window_start, "
        f"make_timestamp((start_s + {size_s}) * 1000000) as window_end"
    )


def _sliding_counts(sensor: str) -> str:
    return f"""
with {_expanded(sensor, 7200, 300)}
select sensorid, {_window_times(7200)}, count(*) as n from expanded group by sensorid, start_s
"""


def _forecasts(size_s: int, slide_s: int) -> str:
    """Row-wise estimator: lags inside each window, then sums per window."""
    return f"""
with {_expanded("event_type", size_s, slide_s)}, sized as materialized (
  select *, row_number() over w as pos, count(*) over p as n, v - lag(v) over w as d,
    lead(v) over w as next_v, lead(timestamp) over w as next_timestamp
  from expanded
  window w as (partition by sensorid, start_s order by timestamp, reading_id), p as (partition by sensorid, start_s)
), centred as materialized (
  -- differences of the history only; the last reading is the one to forecast
  select sensorid, start_s, pos - 1 as t, n - 2 as m, v, next_v, next_timestamp,
    d - avg(d) over (partition by sensorid, start_s) as c,
    avg(d) over (partition by sensorid, start_s) as mu
  from sized where pos > 1 and pos < n and n > 6
), lagged as materialized (
  select *, lag(c) over (partition by sensorid, start_s order by t) as c1 from centred
), stage1 as (
  select sensorid, start_s, sum(c * c1) / nullif(sum(c1 * c1), 0) as ar from lagged group by all
), regress as materialized (
  select l.*, lag(case when l.t = 1 then 0 else l.c - s.ar * l.c1 end)
    over (partition by l.sensorid, l.start_s order by l.t) as e1
  from lagged l join stage1 s using (sensorid, start_s)
), moments as (
  select sensorid, start_s, sum(c1 * c1) as xx, sum(c1 * e1) as xe, sum(e1 * e1) as ee,
    sum(c * c1) as xy, sum(c * e1) as ey
  from regress where t >= 3 group by all
), coefficients as materialized (
  select sensorid, start_s,
    greatest(-0.99, least(0.99, (xy * ee - ey * xe) / (xx * ee - xe * xe))) as phi,
    greatest(-0.99, least(0.99, (ey * xx - xy * xe) / (xx * ee - xe * xe))) as theta
  from moments where xx * ee - xe * xe > 0 and xx * ee - xe * xe > 1e-6 * xx * ee
), errors as (
  select r.*, k.phi, k.theta, r.c - k.phi * r.c1 - k.theta * r.e1 as err
  from regress r join coefficients k using (sensorid, start_s) where r.t >= 3
), fitted as (
  select sensorid, start_s, any_value(m) as m, sqrt(sum(err * err) / (any_value(m) - 4)) as sigma,
    max(case when t = m then v + mu + phi * c + theta * err end) as forecast,
    max(case when t = m then next_v end) as last, max(case when t = m then next_timestamp end) as timestamp
  from errors group by sensorid, start_s
), forecasts as (
  select sensorid, {_window_times(size_s)}, timestamp, m + 2 as n, last,
    forecast, forecast - 1.96 * sigma as lower, forecast + 1.96 * sigma as upper
  from fitted
)"""


def _forecast_rows(size_s: int, slide_s: int) -> str:
    return _forecasts(size_s, slide_s) + """
select sensorid, window_start, window_end, timestamp, n, round(last, 4) as last,
  round(forecast, 4) as forecast, round(lower, 4) as lower, round(upper, 4) as upper
from forecasts
"""


_SEVERITY = """
case when hi = lo then null when value < lo then (lo - value) / (hi - lo) else (value - hi) / (hi - lo) end"""
_BOUNDS = "cast(event_id % 40 as double) as lo, cast(event_id % 40 + event_id % 11 as double) as hi"

ORACLES: dict[str, str] = {
    "decode_raw_valid": f"with {_PACKETS} select event_id, value from packets where ok",
    "parse_senml": _packets(_SENML),
    "parse_atlas": _packets(_ATLAS),
    "parse_ttn": _packets(_TTN),
    "parse_packets": _packets(f"({_SENML}) union all ({_ATLAS}) union all ({_TTN})"),
    "parse_rejects": f"""
with {_PACKETS}
select event_id, value, case when ok then 'unknown_format' else 'not_json' end as reason
from packets
where not json_exists(j, '$.n') and not json_exists(j, '$.externalDeviceId')
  and not json_exists(j, '$.hardware_serial')
""",
    "decode_reading": f"""
select event_id, 's' || cast(user_id as varchar) as sensorid, {_MS} as timestamp,
  round(value, 4) as rawValue,
  case event_id % 4 when 0 then '52.5,13.4' else 'UNKNOWN' end as location,
  case event_id % 4 when 0 then 'level' else 'UNKNOWN' end as type,
  case event_id % 4 when 0 then 'mm' when 2 then 'l/s' else 'UNKNOWN' end as unit,
  case event_id % 4 when 0 then round(value, 4) else -99.0 end as conValue,
  cast(case event_id % 4 when 0 then event_id % 50 else 999 end as bigint) as gridCell
from events where event_id % 4 <> 3
""",
    "decode_update": f"""
select event_id, 's' || cast(user_id as varchar) as sensorid, {_MS} as timestamp,
  case event_id % 4 when 0 then 'unit' when 1 then 'conversion' else 'cell' end as parameter,
  case event_id % 4 when 0 then 'mm' when 1 then '[(0, 0),(10,' || cast(event_id % 90 as varchar) || ')]'
    else cast(event_id % 7 as varchar) end as value
from events where event_id % 4 <> 3
""",
    "decode_alert": f"""
select event_id, 's' || cast(user_id as varchar) as sensorid, {_MS} as timestamp,
  round(value, 4) as value, lo as lower, hi as upper
from (select *, {_BOUNDS} from events) where event_id % 3 <> 2
""",
    "encode_reading": f"""
with {_ALL_READINGS}
select reading_id, sensorid as key, sensorid, make_timestamp(epoch_us(timestamp) // 1000 * 1000) as timestamp,
  round(rawValue, 4) as rawValue, 'HERE' as location, 'WGS_DEV' as type, 'UNKNOWN' as unit,
  round(rawValue, 4) as conValue, cast(999 as bigint) as gridCell
from readings
""",
    "encode_update": f"""
with {_ALL_UPDATES}
select update_id, sensorid as key, sensorid, make_timestamp(epoch_us(timestamp) // 1000 * 1000) as timestamp,
  parameter, value
from updates
""",
    "encode_alert": f"""
select event_id, 's' || cast(user_id as varchar) as key, 's' || cast(user_id as varchar) as sensorid,
  {_MS} as timestamp, round(value, 4) as value, lo as lower, hi as upper
from (select *, {_BOUNDS} from events)
""",
    "fake_enrich": f"""
with {_ALL_READINGS}
select reading_id, sensorid, timestamp, round(rawValue, 4) as rawValue, 'HERE' as location,
  'WGS_DEV' as type, round(rawValue, 4) as conValue, 'UNKNOWN' as unit, cast(999 as bigint) as gridCell
from readings
""",
    "parse_curve": f"""
with {_ALL_UPDATES}, {_CURVES.replace(" where parameter = 'conversion'", "")}
select update_id, pos, round(x, 4) as x, round(y, 4) as y
from curve_points where update_id in (select update_id from good_curves)
""",
    "convert_values": """
select event_id, round(case
  when value < 1 or value > 300 then -99.0
  when value < 50.5 then (value - 1) * (event_id % 90 + 1) / 49.5
  else event_id % 90 + 1 + (value - 50.5) * 199 / 249.5 end, 4) as conValue
from events
""",
    "assign_cell": f"""
with {_ALL_UPDATES}, {_CELLS.replace(" where parameter = 'geolocation'", "")}
select update_id, value, cast(coalesce(cell, 999) as bigint) as gridCell from cells
""",
    "alert_severity": f"""
select event_id, round({_SEVERITY}, 6) as severity from (select *, {_BOUNDS} from events)
""",
    "alert_messages": f"""
select event_id, 's' || cast(user_id as varchar) as sensorid, ts as timestamp,
  'Value ' || cast(round(value, 6) as varchar) || ' outside of confidence interval by '
    || coalesce(cast(round({_SEVERITY}, 6) as varchar), 'NaN') as message
from (select *, {_BOUNDS} from events)
""",
    "enrich_asof": _ENRICH,
    "enrich_asof_split": _ENRICH,
    "lookup_asof": f"""
with {_READINGS}, {_UPDATES}, probes as (
  select *, unnest(['type', 'unit']) as parameter from readings
)
select p.reading_id, p.sensorid, p.timestamp, p.parameter, u.value
from probes p asof left join updates u
  on p.sensorid = u.sensorid and p.parameter = u.parameter and p.timestamp > u.timestamp
""",
    "latest_parameters": f"""
with {_ALL_UPDATES}
select sensorid, parameter, arg_max(value, timestamp) as value, max(timestamp) as timestamp
from updates group by sensorid, parameter
""",
    "latest_parameters_maintained": f"""
with {_ALL_UPDATES}
select sensorid, parameter, arg_max(value, timestamp) as value, max(timestamp) as timestamp
from updates group by sensorid, parameter
""",
    "enrich_archive_pruned": _ENRICH,
    "enrich_stream_bounded": f"select * exclude (reading_id) from ({_ENRICH})",
    "param_versions": f"""
with {_ALL_UPDATES}, ranked as (
  select *, row_number() over (partition by sensorid, parameter order by timestamp desc) as k from updates
)
select sensorid, parameter,
  max(timestamp) filter (k = 1) as current_ts, max(value) filter (k = 1) as current_value,
  max(timestamp) filter (k = 2) as previous_ts, max(value) filter (k = 2) as previous_value
from ranked group by sensorid, parameter
""",
    "pivot_attributes": f"""
with {_ALL_UPDATES}
select sensorid, {", ".join(
        f"arg_max(value, timestamp) filter (parameter = '{p}') as {p}"
        for p in ("geolocation", "cell", "type", "unit", "conversion")
    )}
from updates group by sensorid
""",
    "cell_latest": f"""
with {_CELL_READINGS.format(cell=_CELL)}
select sensorid, gridCell, timestamp, round(conValue, 4) as conValue from (
  select *, row_number() over (partition by sensorid order by timestamp desc) as k from cell_readings
) where k = 1
""",
    "neighbor_mean": _MEANS + """
select reading_id, sensorid, gridCell, timestamp, round(conValue, 8) as conValue,
  round(cellMean, 8) as cellMean from means
""",
    "neighbor_mean_split": _MEANS + """
select reading_id, sensorid, gridCell, timestamp, round(conValue, 8) as conValue,
  round(cellMean, 8) as cellMean from means
""",
    "neighbor_mean_moving": _neighbor_mean("(user_id % 7 + event_id // 50) % 7") + """
select reading_id, sensorid, gridCell, timestamp, round(conValue, 8) as conValue,
  round(cellMean, 8) as cellMean from means
""",
    "neighbor_mean_streamed": _MEANS + """
select sensorid, gridCell, timestamp, round(conValue, 8) as conValue, round(cellMean, 8) as cellMean from means
""",
    "neighbor_alerts": _neighbor_alerts(60),
    "neighbor_alerts_default": _neighbor_alerts(10),
    "neighbor_snapshot": f"""
with {_CELL_READINGS.format(cell=_CELL)}, latest as (
  select * from (
    select *, row_number() over (partition by sensorid order by timestamp desc) as k from cell_readings
  ) where k = 1
), compared as (
  select l.sensorid, l.gridCell, l.timestamp, l.conValue,
    (select cast(sum(cast(o.conValue as decimal(28, 6))) as double) / count(*) from latest o
     where o.gridCell = l.gridCell and o.sensorid <> l.sensorid) as cellMean
  from latest l
)
select sensorid, gridCell, timestamp, round(conValue, 8) as conValue, round(cellMean, 8) as cellMean,
  round(conValue - cellMean, 8) as deviation
from compared
""",
    "sliding_counts": _sliding_counts("event_type"),
    "sliding_counts_by_sensor": _sliding_counts("'s' || cast(user_id as varchar)"),
    "window_history_last": f"""
with {_expanded("event_type", 7200, 300)}, ranked as (
  select *, row_number() over (partition by sensorid, start_s order by timestamp, reading_id) as position,
    count(*) over (partition by sensorid, start_s) as n
  from expanded
)
select sensorid, {_window_times(7200)}, reading_id, timestamp, round(v, 4) as value, position, n,
  position = n as is_last
from ranked where n > 1
""",
    "arima_forecast": _forecast_rows(7200, 300),
    "arima_forecast_half_day": _forecast_rows(43200, 3600),
    "arima_forecast_streamed": _forecast_rows(7200, 300),
    "arima_alerts": _forecasts(7200, 300) + """
select window_start, sensorid, timestamp, round(last, 4) as value, round(lower, 4) as lower,
  round(upper, 4) as upper
from forecasts where last < lower or last > upper
""",
    "store_measurements_first_wins": f"""
with {_ALL_READINGS}, arrivals as (
  select *, 0 as arrival, 'STORED' as type from readings where reading_id % 3 = 0
  union all select *, 1, 'WGS_DEV' from readings
  union all select *, 2, 'LATE' from readings
)
select reading_id, sensorid, timestamp, type, 'UNKNOWN' as unit, 'HERE' as location,
  round(rawValue, 4) as rawValue, round(rawValue, 4) as conValue
from (select *, row_number() over (partition by sensorid, timestamp order by arrival) as k from arrivals)
where k = 1
""",
    "store_parameters_first_wins": f"""
with {_ALL_UPDATES}, arrivals as (
  select *, 1 as arrival from updates
  union all select update_id, sensorid, timestamp, parameter, 'late', 2 from updates
)
select sensorid, timestamp, parameter, value from (
  select *, row_number() over (partition by sensorid, parameter, timestamp order by arrival) as k from arrivals
) where k = 1
""",
    "store_parameters_last_wins": f"""
with {_ALL_UPDATES}, arrivals as (
  select *, 1 as arrival from updates
  union all select update_id, sensorid, timestamp, parameter, 'new ' || value, 2 from updates
)
select sensorid, timestamp, parameter, value from (
  select *, row_number() over (partition by sensorid, parameter, timestamp order by arrival desc) as k
  from arrivals
) where k = 1
""",
    "store_alarms_first_wins": f"""
with arrivals as (
  select ts, user_id, value, {_BOUNDS}, 1 as arrival from events
  union all select ts, user_id, value + 1000, {_BOUNDS}, 2 from events
)
select 's' || cast(user_id as varchar) as sensorid, ts as timestamp,
  'Value ' || cast(round(value, 6) as varchar) || ' outside of confidence interval by '
    || coalesce(cast(round({_SEVERITY}, 6) as varchar), 'NaN') as message
from (select *, row_number() over (partition by user_id, ts order by arrival) as k from arrivals)
where k = 1
""",
}
