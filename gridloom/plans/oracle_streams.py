"""What the streaming jobs must have written, as plain SQL."""

from __future__ import annotations

from gridloom.plans.oracle_energy import ALERTS, ORACLE as ENERGY_ORACLE
from gridloom.plans.oracle_messages import ARCHIVED, ORACLE as MESSAGE_ORACLE, PARSED, ROUTED, _wire

ORACLE = {
    "stream_enrich": f"""with {ROUTED}
        select message_id, case when route in ('enriched', 'unidentified') then route else 'quarantine' end "exit",
        case route when 'enriched' then null when 'unidentified' then 'device metadata not found' else route end reason,
        case when route = 'enriched' then location_id end location_id, sent original_mqtt_time from routed""",
    "stream_readings": MESSAGE_ORACLE["meter_readings"],
    "stream_archive": f"""with {ARCHIVED}
        select place as location, eui device_eui, {_wire('publish_time')} archived_at, record payload from archived""",
    "stream_dedup": f"""with {PARSED}
        select message_id, eui device_eui, sent message_timestamp, raw raw_payload from parsed where ok""",
    "stream_demand": ENERGY_ORACLE["current_demand"],
    # Intervals that end after the watermark (an hour before the last reading) stay open.
    "stream_peak_alerts": f"""with {ALERTS}
        select * from alerts where interval_start + interval 15 minute
        <= (select date_trunc('milliseconds', max(at_time)) - interval 1 hour from energy)""",
    "stream_alerts_reconciled": f"""with {ALERTS}
        select * from alerts where interval_start + interval 15 minute
        <= (select max(at_time) - interval 1 hour from energy)""",
    "stream_retry": f"""with {ROUTED},
        tried as (select *, case when route in ('invalid_message', 'incomplete_metadata') then
          case when route = 'incomplete_metadata' and substr(eui, 5)::bigint % 22 = 0 then 2
          when route = 'incomplete_metadata' and substr(eui, 5)::bigint % 33 = 0 then 3 else 9 end else 1 end tries from routed)
        select message_id,
        case when tries = 9 then 'dead_letter' when tries > 1 then 'enriched'
          when route in ('enriched', 'unidentified') then route else 'quarantine' end "exit",
        case when tries in (2, 3) or route = 'enriched' then null
          when route = 'unidentified' then 'device metadata not found' else route end reason,
        case when tries in (2, 3) then 'LATE' when route = 'enriched' then device_category end device_category,
        least(tries, 3)::int tries from tried""",
}
