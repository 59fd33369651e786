"""The message queries again as plain SQL over the same tables, for comparison.

Nothing here uses the DataFrame code: messages, routes, fields and topics are
worked out anew from the tables.
"""

from __future__ import annotations

_TIME = "%Y-%m-%dT%H:%M:%S.%fZ"


def _float(first: int) -> str:
    bits = f"try_cast('0x' || substr(raw, {first}, 8) as bigint)"
    return (
        f"(case when {bits} >> 31 = 1 then -1.0::double else 1.0::double end)"
        f" * (({bits} & 8388607) + 8388608) * pow(2.0::double, (({bits} >> 23) & 255) - 150)"
    )


def _wire(column: str) -> str:
    """Time as RFC 3339 text without trailing zeros."""
    return f"regexp_replace(strftime({column}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z'"


MESSAGES = """
h as (select *, md5(event_id::varchar) x, 'DEV-'||lpad(user_id::varchar,6,'0') dev from events),
p as (select *, '4456'||hex(right(lpad(event_id::varchar,2,'0'),2))||'42'||substr(x,1,6)||'40'||substr(x,7,6)||'41'||substr(x,13,6)||'43'||substr(x,19,6)||'43'||substr(x,25,6) good from h),
q as (select *, case when event_id%89=0 then '' else dev end device_eui, 'devices/'||dev||'/up' topic, event_id::varchar message_id,
 case when event_id%73=0 then '' when event_id%79=0 then 'zz'||substr(good,3) when event_id%83=0 then substr(good,1,46) else good end raw_payload,
 ts + to_milliseconds(event_id%5000) publish_time from p),
j as (select *, '{"device_info":{"device_eui":"'||device_eui||'"},"lorawan_data":{"rssi":-70,"snr":7.5,"received_at":"'||strftime(ts - interval 1 second,'%Y-%m-%dT%H:%M:%S.%fZ')||'"},"raw_payload":"'||raw_payload||'","message_timestamp":"'||strftime(ts,'%Y-%m-%dT%H:%M:%S.%fZ')||'"}' js from q),
messages as (select event_id, message_id, topic, publish_time, case when event_id%97=0 then substr(js,1,20) else js end payload from j),
registry as (select 'DEV-'||lpad(c_custkey::varchar,6,'0') device_eui, 'CLIENT-'||lpad(c_custkey::varchar,6,'0') client_id, 'LOC-'||lpad(c_nationkey::varchar,3,'0') location_id, case when c_custkey%11=0 then '' else c_mktsegment end device_category from customer where c_custkey%7<>0)"""

PARSED = MESSAGES + f""",
parsed as (select *, json_valid(payload) ok,
 case when json_valid(payload) then payload->>'$.device_info.device_eui' end eui,
 case when json_valid(payload) then payload->>'$.raw_payload' end raw,
 case when json_valid(payload) then strptime(payload->>'$.message_timestamp', '{_TIME}') end sent,
 case when json_valid(payload) then strptime(payload->>'$.lorawan_data.received_at', '{_TIME}') end received
 from messages)"""

ROUTED = PARSED + """,
routed as (select p.*, r.client_id, r.location_id, r.device_category,
 case when not ok then 'parse_error' when eui = '' then 'invalid_message'
  when r.device_eui is null then 'unidentified'
  when r.device_category = '' then 'incomplete_metadata' else 'enriched' end route
 from parsed p left join registry r on r.device_eui = p.eui)"""

DECODED = ROUTED + """,
decoded as (select *, case when route = 'unidentified' then 'upstream_error'
  when raw = '' then 'empty_payload'
  when not regexp_full_match(raw, '([0-9A-Fa-f][0-9A-Fa-f])*') then 'failed to decode hex payload'
  when length(raw) <> 48 then 'invalid payload length: expected 24 bytes, got ' || (length(raw) // 2)::varchar || ' bytes'
  end detail from routed where route in ('enriched', 'unidentified'))"""

READINGS = DECODED + f""",
meter as (select event_id, message_id, decode(unhex(substr(raw, 1, 8))) uid,
 {_float(9)} reading, {_float(17)} average_current, {_float(25)} max_current,
 {_float(33)} max_voltage, {_float(41)} average_voltage,
 eui device_eui, client_id, location_id, device_category, sent original_mqtt_time,
 publish_time upstream_ingestion_timestamp, publish_time processed_timestamp, 'XDevice' device_type
 from decoded where detail is null)"""

_ZERO = "'0001-01-01T00:00:00Z'"


def _known(sent: str) -> str:
    return (
        "'{\"raw_payload\":\"' || raw || '\",\"device_eui\":\"' || eui"
        f" || '\",\"original_mqtt_time\":\"' || {sent}"
        f" || '\",\"lorawan_received_at\":\"' || {_wire('received')}"
        " || '\",\"client_id\":\"' || client_id || '\",\"location_id\":\"' || location_id"
        " || '\",\"device_category\":\"' || device_category"
        f" || '\",\"ingestion_timestamp\":\"' || {_wire('publish_time')}"
        f" || '\",\"original_client_timestamp\":\"' || {sent} || '\",\"client_message_id\":\"\"}}'"
    )


def _unknown(sent: str) -> str:
    return (
        "'{\"device_eui\":\"' || eui || '\",\"raw_payload\":\"' || raw"
        f" || '\",\"original_mqtt_time\":\"' || {sent}"
        f" || '\",\"lorawan_received_at\":\"' || {_wire('received')}"
        f" || '\",\"ingestion_timestamp\":\"' || {_wire('publish_time')}"
        " || '\",\"processing_error\":\"device metadata not found\"}'"
    )


_SENT = _wire("sent")
TOPICS = ROUTED + f""",
topics as (select *, route topic_source,
 case when event_id%101=0 then substr(case when route = 'enriched' then {_known(_SENT)} else {_unknown(_SENT)} end, 1, 30)
  when event_id%103=0 then case when route = 'enriched' then {_known(_ZERO)} else {_unknown(_ZERO)} end
  else case when route = 'enriched' then {_known(_SENT)} else {_unknown(_SENT)} end end record
 from routed where route in ('enriched', 'unidentified'))"""

ARCHIVED = TOPICS + f""",
archived as (select *, case when route = 'enriched' then location_id else 'deadletter' end place,
 strftime(publish_time, '%Y/%m/%d/') || case when route = 'enriched' then location_id else 'deadletter' end batch_key,
 '{{"device_eui":"' || eui || '","original_pubsub_payload":' || record || ',"archived_at":"' || {_wire('publish_time')} || '"}}' line
 from topics where json_valid(record))"""

VERIFIED = TOPICS + """,
verified as (select '' client_message_id, eui device_eui, topic_source,
 case when event_id%103<>0 then sent end original_client_timestamp,
 publish_time + interval 50 millisecond verifier_receive_time, publish_time pubsub_publish_time,
 case when event_id%103<>0 then (epoch_us(publish_time + interval 50 millisecond) - epoch_us(sent)) // 1000 end::bigint latency_ms,
 case when event_id%103<>0 then (epoch_us(publish_time) - epoch_us(sent)) // 1000 end::bigint processing_latency_ms
 from topics where json_valid(record)),
plan as (select 'DEV-'||lpad(c_custkey::varchar,6,'0') device_eui, c_custkey%5<>0 known from customer),
by_device as (select device_eui, count(*) filter (topic_source = 'enriched') enriched,
 count(*) filter (topic_source = 'unidentified') unidentified from verified group by 1)"""

_ENRICHED_COLUMNS = """raw raw_payload, eui device_eui, sent original_mqtt_time, received lorawan_received_at,
 client_id, location_id, device_category, publish_time ingestion_timestamp,
 sent original_client_timestamp, null::varchar client_message_id"""
_METER_COLUMNS = """uid, reading, average_current, max_current, max_voltage, average_voltage, device_eui,
 client_id, location_id, device_category, original_mqtt_time, upstream_ingestion_timestamp,
 processed_timestamp, device_type"""

_SELECTS: dict[str, tuple[str, str]] = {
    "raw_scan": (MESSAGES, "select message_id, topic, payload, publish_time from messages"),
    "registry_scan": (MESSAGES, "select * from registry"),
    "parse_messages": (
        PARSED,
        """select message_id, topic, eui device_eui, -70::bigint rssi, 7.5::double snr, received received_at,
         raw raw_payload, sent message_timestamp from parsed where ok""",
    ),
    "stamp_transport": (
        PARSED,
        "select message_id, topic, eui device_eui from parsed where ok",
    ),
    "raw_publish": (
        PARSED,
        f"""select message_id, '{{"device_info":{{"device_eui":"' || eui || '"}},"lorawan_data":{{"rssi":-70,"snr":7.5,"received_at":"'
         || {_wire('received')} || '"}},"raw_payload":"' || raw || '","message_id":"' || message_id || '","topic":"' || topic
         || '","message_timestamp":"' || {_wire('sent')} || '"}}' payload, 'mqtt' attr_message_type, eui attr_device_eui from parsed where ok""",
    ),
    "quarantine_parse": (
        ROUTED,
        """select message_id, topic, 'parse_error' reason, payload, substr(payload, 1, 100) snippet
         from routed where route = 'parse_error'""",
    ),
    "quarantine_invalid": (
        ROUTED,
        "select message_id, topic, route reason, payload from routed where route = 'invalid_message'",
    ),
    "quarantine_incomplete": (
        ROUTED,
        """select message_id, eui device_eui, route reason, payload
         from routed where route = 'incomplete_metadata'""",
    ),
    "enrich_known": (
        ROUTED,
        f"select message_id, {_ENRICHED_COLUMNS} from routed where route = 'enriched'",
    ),
    "route_unidentified": (
        ROUTED,
        """select message_id, eui device_eui, raw raw_payload, sent original_mqtt_time,
         received lorawan_received_at, publish_time ingestion_timestamp,
         'device metadata not found' processing_error from routed where route = 'unidentified'""",
    ),
    "route_exits": (
        ROUTED,
        """select message_id, case when route in ('enriched', 'unidentified') then route else 'quarantine' end "exit",
         case route when 'enriched' then null when 'unidentified' then 'device metadata not found' else route end reason from routed""",
    ),
    "enriched_attributes": (
        ROUTED,
        f"""select message_id, {_known(_SENT)} payload, 'enriched' attr_message_type, eui attr_device_eui,
         client_id attr_client_id, device_category attr_category from routed where route = 'enriched'""",
    ),
    "unidentified_attributes": (
        ROUTED,
        f"""select message_id, {_unknown(_SENT)} payload, 'unidentified' attr_message_type, eui attr_device_eui,
         'device metadata not found' attr_error_reason from routed where route = 'unidentified'""",
    ),
    "decode_skips": (
        DECODED,
        """select message_id, eui device_eui, detail from decoded
         where detail in ('upstream_error', 'empty_payload')""",
    ),
    "decode_errors": (
        DECODED,
        """select message_id, eui device_eui, raw raw_payload, detail from decoded
         where detail not in ('upstream_error', 'empty_payload')""",
    ),
    "decode_payload": (
        READINGS,
        """select message_id, uid, reading, average_current, max_current, max_voltage, average_voltage
         from meter""",
    ),
    "meter_readings": (READINGS, f"select {_METER_COLUMNS} from meter"),
    "readings_by_day": (
        READINGS,
        """select original_mqtt_time::date reading_day, count(*) n_readings, sum(reading) sum_reading,
         min(original_mqtt_time) first_time, max(original_mqtt_time) last_time from meter group by 1""",
    ),
    "layout_partitions": (
        READINGS,
        """select unit, strftime(date_trunc(unit, original_mqtt_time), '%Y-%m-%d-%H') partition_time, count(*) n_readings
         from meter, (values ('HOUR'), ('DAY'), ('MONTH'), ('YEAR')) u(unit) group by 1, 2""",
    ),
    "reading_lookup": (
        READINGS,
        """select uid, reading, device_eui, client_id, location_id, device_category, device_type, original_mqtt_time
         from meter where device_eui = 'DEV-000008' order by original_mqtt_time desc, reading desc, uid limit 1""",
    ),
    "archive_union": (
        ROUTED,
        f"""select {_ENRICHED_COLUMNS}, null::varchar processing_error from routed where route = 'enriched'
         union all by name
         select raw raw_payload, eui device_eui, sent original_mqtt_time, received lorawan_received_at,
         publish_time ingestion_timestamp, 'device metadata not found' processing_error
         from routed where route = 'unidentified'""",
    ),
    "archive_route": (ARCHIVED, "select message_id, place as location, batch_key from archived"),
    "archive_rejects": (
        TOPICS,
        """select message_id, 'archive_unparseable' reason, record payload, substr(record, 1, 100) snippet,
         publish_time from topics where not json_valid(record)""",
    ),
    "archive_records": (ARCHIVED, "select message_id, batch_key, line from archived"),
    "archive_batches": (
        ARCHIVED,
        """select batch_key, ((n - 1) // 100)::bigint batch_no, count(*) message_count,
         arg_min(eui, n) first_message_eui, arg_min(publish_time, n) first_archived_at,
         arg_max(publish_time, n) last_archived_at
         from (select *, row_number() over (partition by batch_key order by publish_time, message_id) n from archived)
         group by 1, 2""",
    ),
    "archive_read_range": (
        ARCHIVED,
        f"""select eui device_eui, record original_pubsub_payload, {_wire('publish_time')} archived_at,
         strftime(publish_time, '%Y') "year", strftime(publish_time, '%m') "month", strftime(publish_time, '%d') "day",
         place as location from archived
         where place = 'LOC-003' and publish_time::date between date '2024-01-05' and date '2024-01-12'""",
    ),
    "retention_candidates": (
        ARCHIVED,
        """select strftime(d, '%Y') "year", strftime(d, '%m') "month", strftime(d, '%d') "day",
         place as location, count(*) message_count, (date '2024-01-31' - d)::int age_days
         from (select publish_time::date d, place from archived)
         where date '2024-01-31' - d >= 14 group by d, place""",
    ),
    "retention_folders": (
        ARCHIVED,
        """select distinct strftime(publish_time, '%Y') "year", strftime(publish_time, '%m') "month", strftime(publish_time, '%d') "day",
         place as location, (date '2024-01-31' - publish_time::date)::int age_days
         from archived where date '2024-01-31' - publish_time::date >= 14""",
    ),
    "verify_records": (VERIFIED, "select * from verified"),
    "verify_summary": (
        VERIFIED,
        """select min(verifier_receive_time) start_time, max(verifier_receive_time) end_time,
         count(*) total_messages_verified, count(*) filter (topic_source = 'enriched') enriched_messages,
         count(*) filter (topic_source = 'unidentified') unidentified_messages,
         ((epoch_us(max(verifier_receive_time)) - epoch_us(min(verifier_receive_time))) // 1000)::bigint actual_duration_ms,
         'run-1' test_run_id, 'tables' environment_name from verified""",
    ),
    "verify_by_device": (VERIFIED, "select * from by_device"),
    "verify_completeness": (
        VERIFIED,
        """select device_eui, known, trunc(2592000.0::double * 0.000025::double)::bigint expected, observed,
         observed >= trunc(2592000.0::double * 0.000025::double)::bigint * 0.8::double complete_shared,
         observed >= greatest(trunc(2592000.0::double * 0.000025::double)::bigint - 2, 1) complete_local
         from (select p.device_eui, known, coalesce(case when known then enriched else unidentified end, 0)::bigint observed
          from plan p left join by_device using (device_eui))""",
    ),
    "verify_violations": (
        VERIFIED,
        """select device_eui, known, (case when known then unidentified else enriched end)::bigint wrong_messages
         from plan join by_device using (device_eui) where case when known then unidentified else enriched end > 0""",
    ),
    "latency_stats": (
        VERIFIED,
        """select topic_source, count(latency_ms) measured, round(avg(latency_ms), 6) mean, min(latency_ms) least,
         max(latency_ms) greatest, round(quantile_cont(latency_ms, 0.5), 6) p50, round(quantile_cont(latency_ms, 0.9), 6) p90,
         round(quantile_cont(latency_ms, 0.99), 6) p99 from verified group by 1""",
    ),
    "error_counts": (
        TOPICS,
        """select *, round((unparseable + missing_timestamp) / total, 9) error_rate,
         (unparseable + missing_timestamp) / total < 0.0001 within_limit from (
         select topic_source, count(*) total, count(*) filter (not json_valid(record)) unparseable,
         count(*) filter (json_valid(record) and event_id%103=0) missing_timestamp from topics group by 1)""",
    ),
}

ORACLE = {name: f"with {base}\n{select}" for name, (base, select) in _SELECTS.items()}
