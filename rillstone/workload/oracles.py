"""The registered queries in plain SQL (DuckDB dialect) over the driver's tables.

Written from the data contract, not from the Spark plans: the feed is never encoded as JSON here, rejected
records are found by the fault that was put into them, and copies of an event are one row by construction.
"""

from __future__ import annotations

AS_OF = "timestamp '2024-01-31 00:00:00'"
WHOLE, DAY = "interval 30 day", "interval 24 hour"

# mixed: every record of the feed, with the faults it carries. `copy` numbers the repeats of an event.
MIXED = """
with base as (
  select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
    case when event_type in ('click', 'view', 'purchase') then 'clickstream'
         when event_type = 'signup' then 'sensor' else 'app_log' end as kind
  from events),
typed as (
  select event_id as n, ts as src_ts, event_id % 101 = 0 as no_text, event_id % 101 = 0 or event_id % 103 = 0 as not_json,
    kind = 'clickstream' and event_id % 73 = 0 as mistyped, event_id % 89 = 0 as no_time,
    case when event_id % 79 <> 0 then cast(event_id as varchar) end as event_id, user_id as user_number, k,
    case when event_id % 97 = 0 then null when event_id % 83 = 0 then 'heartbeat' else kind end as event_type,
    case when event_id % 89 = 0 then 'no time'
         else concat(replace(cast(ts as varchar), ' ', 'T'), '+00:00') end as "timestamp",
    case when kind = 'clickstream' and event_id % 71 = 0 then ''
      when kind = 'clickstream' then concat('user_', lpad(cast(user_id as varchar), 4, '0')) end as user_id,
    kind = 'clickstream' as is_click, kind = 'app_log' as is_log,
    case when kind = 'clickstream' then case event_type when 'view' then 'page_view' else event_type end end as action,
    case when kind = 'clickstream'
      then ['/start', '/catalog', '/basket', '/pay', '/account', '/find'][event_id % 6 + 1] end as page,
    case when kind = 'clickstream' then ['phone', 'laptop', 'tv'][k % 3 + 1] end as device,
    case when kind = 'clickstream' then ['Heron', 'Lynx', 'Otter', 'Wren'][k % 4 + 1] end as browser,
    case when kind = 'clickstream'
      then ['NO', 'PT', 'KE', 'PE', 'NZ', 'FI', 'VN', 'UY'][user_id % 8 + 1] end as country,
    case when kind = 'clickstream' and event_id % 73 <> 0 then cast(50 + (event_id * 37) % 1951 as int) end
      as response_time_ms,
    case when kind = 'clickstream' and event_type = 'purchase' then value end as revenue,
    case when kind = 'sensor' then concat('sensor_', lpad(cast(user_id % 30 + 1 as varchar), 3, '0')) end as sensor_id,
    case when kind = 'sensor' and k % 20 <> 0 then value - 60 end as temperature,
    case when kind = 'sensor' then cast(k as double) end as humidity,
    case when kind = 'sensor' then cast(900 + 2 * k as double) end as pressure,
    case when kind = 'sensor' then value / 50 end as vibration,
    case when kind = 'sensor' then value > 150 end as is_anomaly,
    case when kind = 'sensor' then concat('zone_', k % 5 + 1) end as location,
    case when kind = 'app_log' then ['DEBUG', 'INFO', 'WARN', 'ERROR'][k % 4 + 1] end as level,
    case when kind = 'app_log'
      then ['ledger', 'mailer', 'planner', 'router'][event_id % 4 + 1] end as service,
    case when kind = 'app_log' then concat('step ', 10 + k, ' done') end as message,
    case when kind = 'app_log' then [200, 202, 204, 301, 403, 422, 503][k % 7 + 1] end as status_code
  from base),
copies as (
  select *, unnest(case when n % 50 = 0 then [0, 1] else [0] end) as copy from typed),
mixed as (
  select *, cast(n % 3 as int) as "partition", n * 2 + copy as "offset",
    coalesce(nullif(user_id, ''), sensor_id, event_id) as kafka_key,
    case when is_click then substr(md5(concat(user_number, '-', k % 5, '-', copy)), 1, 8) end as session_id,
    case when is_log then substr(md5(concat(n, '-', copy)), 1, 12) end as trace_id,
    case when no_text then 'not json' when not_json then substr(concat(
      '{"event_id":', coalesce('"' || event_id || '"', 'null'), ',"event_type":',
      coalesce('"' || event_type || '"', 'null'), ',"timestamp":"', "timestamp", '"'), 1, 40) end as bad_text,
    least(cast(floor(n * 4 / ((select max(event_id) from events) + 1)) as bigint)
      + case when n % 37 = 0 or copy = 1 and n % 100 = 0 then 1 else 0 end, 3) as batch_id
  from copies),
kept as (
  select * replace (
      coalesce(revenue, 0.0::double) as revenue,
      case when event_type = 'sensor' then greatest(-50.0::double, least(150.0::double, temperature))
           else temperature end as temperature),
    case when not no_time then src_ts end as event_ts,
    coalesce(event_type = 'clickstream' and response_time_ms > 1500, false) as is_slow_request
  from mixed where not not_json and event_type is not null and event_id is not null),
events_cleaned as (select * from kept where copy = 0)
"""

RECORD = (
    "event_id, event_type, \"timestamp\", user_id, session_id, action, page, device, browser, country, "
    "response_time_ms, revenue, sensor_id, temperature, humidity, pressure, vibration, is_anomaly, location, "
    "level, service, message, trace_id, status_code"
)
SERVED = (
    "event_id, event_type, event_ts, user_id, sensor_id, action, page, device, country, revenue, temperature, "
    "humidity, vibration, is_anomaly, location, level, service, status_code, response_time_ms, is_slow_request"
)


def _round(expr: str, places: int) -> str:
    return f"cast(round(cast({expr} as decimal(28,10)), {places}) as double)"


METRICS = ("clickstream_metrics", "sensor_metrics", "log_metrics")


def _window_sql(table: str, unit: str, by: str = "") -> str:
    """The metric query of one table with windows of one `unit`, and of each value of `by`."""
    measures = {
        "clickstream_metrics": (
            "clickstream",
            "page, device, country",
            f"""count(*) as event_count, {_round("avg(response_time_ms)", 6)} as avg_response_ms,
            {_round("sum(revenue)", 6)} as total_revenue, count(distinct user_id) as unique_users""",
        ),
        "sensor_metrics": (
            "sensor",
            "location",
            f"""{_round("avg(temperature)", 6)} as avg_temperature, {_round("max(temperature)", 6)} as max_temperature,
            {_round("avg(humidity)", 6)} as avg_humidity, {_round("avg(vibration)", 6)} as avg_vibration,
            cast(sum(cast(is_anomaly as int)) as bigint) as anomaly_count, count(*) as reading_count""",
        ),
        "log_metrics": (
            "app_log",
            "service, level",
            f"""count(*) as log_count, {_round("avg(cast(status_code as double))", 6)} as avg_status_code""",
        ),
    }
    kind, dims, aggs = measures[table]
    start = f"date_trunc('{unit}', event_ts)"
    also = f", {by}" if by else ""
    return f"""select {dims}, {aggs}, {start} as window_start, {start} + interval 1 {unit} as window_end{also}
        from events_cleaned where event_type = '{kind}' and event_ts is not null
        group by {dims}, {start}{also}"""


#: Every event with the time up to which windows had been closed before its batch.
LATE_SQL = """, newest as (select batch_id, max(event_ts) as newest from events_cleaned group by 1),
    marks as (select b.batch_id, max(a.newest) - interval 2 day as closed_at
      from newest b left join newest a on a.batch_id < b.batch_id group by 1),
    timed as (select events_cleaned.*, closed_at,
      coalesce(date_trunc('day', event_ts) + interval 1 day <= closed_at, false) as late
      from events_cleaned join marks using (batch_id))"""


def _recent(span: str, ts: str = "event_ts") -> str:
    return f"{ts} > {AS_OF} - {span} and {ts} <= {AS_OF}"


def _panels(span: str) -> dict[str, str]:
    recent = _recent(span)
    clicks = f"event_type = 'clickstream' and {recent}"
    total = f"select {AS_OF} as \"time\", count(*) as value from events_cleaned where"
    minute = "date_trunc('minute', event_ts)"
    return {
        "total_events": f"{total} {recent}",
        "anomaly_stat": f"""select *, case when value >= 10 then 'red' when value >= 5 then 'yellow' else 'green' end
            as severity from ({total} event_type = 'sensor' and is_anomaly and {recent})""",
        "slow_requests": f"{total} is_slow_request and {recent}",
        "response_by_page": f"""select page, {_round("avg(response_time_ms)", 0)} as avg_ms
            from events_cleaned where {clicks} group by page""",
        "revenue_per_minute": f"""select {minute} as "time", {_round("sum(revenue)", 6)} as value
            from events_cleaned where {clicks} group by 1""",
        "active_users": f"""select {minute} as "time", count(distinct user_id) as value
            from events_cleaned where {clicks} group by 1""",
        "event_rate_recent": f"""select {minute} as "minute", event_type, count(*) as event_count
            from events_cleaned where {recent} group by 1, 2""",
        "revenue_by_page": f"""select page, {_round("sum(revenue)", 2)} as revenue
            from events_cleaned where {clicks} group by 1""",
        "temperature_by_zone": f"""select window_start as "time", location as metric,
            {_round("avg_temperature", 2)} as value
            from ({_window_sql("sensor_metrics", "minute")}) where {_recent(span, "window_start")}""",
        "errors_by_service": f"""select window_start as "time", service as metric, log_count as value
            from ({_window_sql("log_metrics", "minute")})
            where level = 'ERROR' and {_recent(span, "window_start")}""",
    }


def oracle_sql() -> dict[str, str]:
    view_rate = "select date_trunc('minute', event_ts) as \"minute\", event_type, count(*) as event_count " \
        "from events_cleaned group by 1, 2"
    view_pages = f"""select page, count(*) as visits, {_round("avg(response_time_ms)", 0)} as avg_ms,
        sum(revenue) as revenue from events_cleaned where event_type = 'clickstream' group by page"""
    view_anomalies = """select event_id, event_ts, sensor_id, location, temperature, humidity, vibration
        from events_cleaned where event_type = 'sensor' and is_anomaly"""
    reason = """case when not_json then 'malformed_json' when event_id is null then 'missing_event_id'
        else 'missing_event_type' end"""
    rejected = "(not_json or event_id is null or event_type is null)"
    text = ", ".join(
        ["bad_text", *[f'case when not not_json then "{c}" end as "{c}"' for c in ("timestamp", "page", "sensor_id", "service")]]
    )
    id_of_reject = "case when not not_json then event_id end"
    fields = RECORD.replace('"timestamp"', "timestamp").split(", ")
    parsed = ", ".join(f'case when not not_json then "{f}" end as "{f}"' for f in fields)

    def kind_rows(kind: str, names: str) -> str:
        return f"""select "offset", event_id, event_type, "timestamp", {names} from mixed
            where not not_json and event_type = '{kind}'"""

    rows = {
        "record_envelope": """select kafka_key, "partition", "offset", src_ts as kafka_timestamp,
            not no_text as is_object from mixed""",
        "raw_parse": f'select kafka_key, src_ts as kafka_timestamp, "offset", {parsed} from mixed',
        "parse_clickstream": kind_rows(
            "clickstream", "user_id, session_id, action, page, device, browser, country, response_time_ms, revenue"
        ),
        "parse_sensor": kind_rows(
            "sensor", "sensor_id, temperature, humidity, pressure, vibration, is_anomaly, location"
        ),
        "parse_app_log": kind_rows("app_log", "level, service, message, trace_id, status_code"),
        "dead_letters": f"""select kafka_key, "partition", "offset", {id_of_reject} as event_id,
            {reason} as reject_reason, {text} from mixed where {rejected}""",
        "record_quality": """
            select 'records' as check_name, count(*) as row_count from mixed
            union all select 'accepted', count(*) from kept
            union all select 'malformed_json', count(*) from mixed where not_json
            union all select 'missing_event_id', count(*) from mixed where not not_json and event_id is null
            union all select 'missing_event_type', count(*) from mixed
              where not not_json and event_id is not null and event_type is null
            union all select 'field_fault', count(*) from kept where mistyped
            union all select 'unreadable_timestamp', count(*) from kept where no_time
            union all select 'unknown_kind', count(*) from kept where event_type = 'heartbeat'
            union all select 'sensor_without_temperature', count(*) from mixed
              where not not_json and event_id is not null and event_type = 'sensor' and temperature is null""",
        "cleaned_records": f"""select kafka_key, src_ts as kafka_timestamp, "offset", {RECORD}, event_ts,
            '1.0.0' as pipeline_version, is_slow_request from kept""",
        "events_cleaned": f"select {SERVED} from events_cleaned",
        "dedup_events": """select event_id, event_type, event_ts, "partition", "offset" from events_cleaned""",
        "repeated_events": "select event_id, count(*) as copies from kept group by 1 having count(*) > 1",
        "keyed_events": """select kafka_key as "key", event_id, event_type,
            case when event_type in ('clickstream', 'heartbeat') then user_id end as user_id,
            case when event_type in ('app_log', 'heartbeat') then level end as level from events_cleaned""",
        "temperature_rule": """select event_id, sensor_id, temperature, is_anomaly, temperature > 55.0 as is_hot
            from events_cleaned where event_type = 'sensor'""",
        "newest_reading": """select sensor_id, event_id, temperature, "offset" from events_cleaned
            where event_type = 'sensor'
            qualify row_number() over (partition by sensor_id order by src_ts desc, "partition" desc, "offset" desc) = 1""",
        "kind_to_table": """select event_type, count(*) as row_count, case event_type
            when 'clickstream' then 'clickstream_metrics' when 'sensor' then 'sensor_metrics'
            when 'app_log' then 'log_metrics' end as metric_table from events_cleaned group by event_type""",
        "clickstream_metrics": _window_sql("clickstream_metrics", "minute"),
        "clickstream_metrics_day": _window_sql("clickstream_metrics", "day"),
        "sensor_metrics": _window_sql("sensor_metrics", "minute"),
        "sensor_metrics_hour": _window_sql("sensor_metrics", "hour"),
        "sensor_metrics_day": _window_sql("sensor_metrics", "day"),
        "log_metrics": _window_sql("log_metrics", "minute"),
        "log_metrics_day": _window_sql("log_metrics", "day"),
        "partials_merge_clickstream": _window_sql("clickstream_metrics", "day"),
        "partials_merge_sensor": _window_sql("sensor_metrics", "day"),
        "partials_merge_log": _window_sql("log_metrics", "day"),
        "active_users_sketch": """select date_trunc('day', event_ts) as window_start, page, device, country,
            count(distinct user_id) as unique_users, true as estimate_is_close from events_cleaned
            where event_type = 'clickstream' and event_ts is not null group by 1, 2, 3, 4""",
        "store_scan": f"""select {RECORD.replace('"timestamp", ', '')}, event_ts, is_slow_request,
            case when event_type = 'heartbeat' then 'other' else event_type end as event_kind,
            cast(event_ts as date) as event_date from events_cleaned""",
        "view_event_rate": view_rate,
        "view_top_pages": f"""select page, visits, avg_ms, {_round("revenue", 6)} as revenue from ({view_pages})""",
        "view_sensor_anomalies": view_anomalies,
        "event_rate_per_minute": f"""select "minute" as "time", event_type as metric, event_count as value
            from ({view_rate})""",
        "top_pages": f"""select page, visits, avg_ms, {_round("revenue", 2)} as revenue from ({view_pages})
            order by visits desc, page limit 10""",
        "sensor_anomalies": f"{view_anomalies} order by event_ts desc nulls last, event_id limit 20",
        "sql_views": """
            select 'rate' as source, event_type as metric, count(*) as value from events_cleaned group by 1, 2
            union all select 'pages', page, count(*) from events_cleaned where event_type = 'clickstream' group by 1, 2
            union all select 'anomalies', location, count(*) from events_cleaned
              where event_type = 'sensor' and is_anomaly group by 1, 2
            union all select 'logs', service, count(*) from events_cleaned
              where event_type = 'app_log' and event_ts is not null group by 1, 2""",
        "retained_events": f"select event_id, event_type, event_ts from events_cleaned where {_recent(DAY, 'src_ts')}",
        "retained_metrics": f"""select * from ({_window_sql("sensor_metrics", "minute")})
            where {_recent("interval 48 hour", "window_start")}""",
        "stream_dedup": "select event_id, event_type, event_ts from events_cleaned",
        "stream_dedup_combined": "select event_id, event_type, event_ts from events_cleaned",
        "lines_parse": f'''select cast(null as varchar) as kafka_key, cast(null as int) as "partition",
            cast(null as bigint) as "offset", {parsed} from mixed''',
        "stream_store_scan": f"""select location, count(*) as readings, {_round("avg(humidity)", 6)} as avg_humidity
            from events_cleaned where event_type = 'sensor' and {_recent(DAY)} group by 1""",
        "stream_clickstream_windows": f"""select *, true as estimate_is_close
            from ({_window_sql("clickstream_metrics", "minute")})""",
        "stream_sensor_windows": _window_sql("sensor_metrics", "minute"),
        "stream_log_windows": _window_sql("log_metrics", "minute"),
        "fanout_events": f"select {SERVED} from events_cleaned",
        "stream_dedup_ledger": "select event_id, batch_id from events_cleaned",
        "fanout_rejects": f"""select kafka_key, "partition", "offset", {id_of_reject} as event_id,
            {reason} as reject_reason, {text} from mixed where {rejected}""",
        "fanout_clickstream_metrics": _window_sql("clickstream_metrics", "day"),
        "fanout_sensor_metrics": _window_sql("sensor_metrics", "day"),
        "fanout_log_metrics": _window_sql("log_metrics", "day"),
        "fanout_metrics_last_day": f"""select * from ({_window_sql("sensor_metrics", "day")})
            where {_recent(DAY, "window_start")}""",
        "batch_metrics": _window_sql("sensor_metrics", "day", by="batch_id"),
        "row_counts": f"""select batch_id, 'records' as table_name, count(*) as row_count from (
              select batch_id from events_cleaned union all select batch_id from mixed where {rejected}) group by 1
            union all select batch_id, 'clickstream_members', count(*) from (
              select distinct batch_id, cast(event_ts as date) as d, page, device, country, user_id from events_cleaned
              where event_type = 'clickstream' and event_ts is not null) group by 1
            union all select batch_id, 'clickstream_metrics', count(*) from (
              {_window_sql("clickstream_metrics", "day", by="batch_id")}) group by 1
            union all select batch_id, 'sensor_metrics', count(*) from (
              {_window_sql("sensor_metrics", "day", by="batch_id")}) group by 1
            union all select batch_id, 'log_metrics', count(*) from (
              {_window_sql("log_metrics", "day", by="batch_id")}) group by 1""",
        "archived_days": f"""select {SERVED}, case when event_type = 'heartbeat' then 'other' else event_type end
            as event_kind, cast(event_ts as date) as event_date from events_cleaned""",
        "topic_cleaned": """select kafka_key as "key", event_id, event_type, case when event_type = 'clickstream'
            or event_type = 'heartbeat' then user_id end as user_id,
            case when event_type = 'sensor' or event_type = 'heartbeat' then sensor_id end as sensor_id
            from events_cleaned""",
        **{f"topic_curated_{name}": _window_sql(name, "day") for name in METRICS},
        "topic_dead": f"""select kafka_key as "key", {reason} as reject_reason, "partition", "offset", {text}
            from mixed where {rejected}""",
        "lag_of_replay": "select cast(null as varchar) as topic, cast(3 as bigint) as committed",
        "lag_by_partition": """select "partition", max("offset") as newest,
            max("offset") filter (batch_id <= 1) as processed,
            max("offset") - max("offset") filter (batch_id <= 1) as lag from mixed group by 1""",
        "late_rows": f"""{LATE_SQL} select event_id, event_type, event_ts, closed_at, 'window_closed' as reason, batch_id
            from timed where late""",
        "closed_sensor_windows": f"""{LATE_SQL}, on_time as (select * from timed where not late) """
        + _window_sql("sensor_metrics", "day").replace("from events_cleaned", "from on_time"),
        "dedup_state": "select event_id, true as lives_a_day from events_cleaned",
        "unknown_fields": """
            select 'build' as field, 'BIGINT' as type, count(*) as records from mixed where n % 61 = 0 and not not_json
            union all select 'tags', 'ARRAY<STRING>', count(*) from mixed where n % 61 = 0 and not not_json
            union all select 'note', 'STRING', count(*) from mixed where n % 122 = 0 and not not_json
            union all select 'note', 'BOOLEAN', count(*) from mixed where n % 122 = 61 and not not_json""",
        "fanout_clickstream_bitmaps": _window_sql("clickstream_metrics", "day"),
        "covered_totals": f"""select event_type, count(*) as events,
            case when event_type = 'clickstream' then {_round("sum(revenue)", 6)} end as revenue from events_cleaned
            where event_type in ('clickstream', 'sensor', 'app_log') and event_ts >= timestamp '2024-01-05 13:47:00'
            and event_ts < timestamp '2024-01-22 06:11:00' group by event_type""",
        "recovered_events": "select event_id, event_type, batch_id from events_cleaned",
        "independent_queries": """select "query", attempts,
            case when event_type = 'heartbeat' then 'other' else event_type end as event_kind, count(*) as events
            from events_cleaned, (values ('store', 1), ('serving', 2)) as q("query", attempts) group by all""",
        "triggered_store": """select event_id, case when event_type = 'heartbeat' then 'other' else event_type end
            as event_kind, cast(event_ts as date) as event_date from events_cleaned""",
        "processing_stamps": """select batch_id, cast(1 as bigint) as stamps, count(*) as events, true as is_later
            from events_cleaned group by batch_id""",
        "intake_progress": """
            select 'intake.records' as name, count(*) as value from mixed
            union all select 'intake.rejected', count(*) from mixed where (not_json or event_id is null or event_type is null)
            union all select 'intake.field_faults', count(*) from kept where mistyped
            union all select 'kept.rows', (select count(*) from events_cleaned)
              + (select count(*) from mixed where (not_json or event_id is null or event_type is null))
            union all select 'kept.events', count(*) from events_cleaned""",
    }
    for suffix, span in (("", WHOLE), ("_last_day", DAY)):
        rows.update({name + suffix: sql for name, sql in _panels(span).items()})
    made = {name: MIXED + sql for name, sql in rows.items()}
    made["order_lines"] = """
        with orders_on_wire as (
          select concat(l_orderkey, '-', l_linenumber) as order_id, concat('user_', l_suppkey) as "user",
            ['Lamp', 'Rope', 'Chair', 'Kettle', 'Spade', 'Drum', 'Globe'][l_partkey % 7 + 1] as item,
            cast(l_quantity as int) % 15 + 1 as quantity
          from lineitem)
        select *, concat('Received order: ', quantity, ' x ', item, ' from ', "user") as message
        from orders_on_wire"""
    return made
