"""What the queries with history must give, as plain SQL."""

from __future__ import annotations

from gridloom.plans.oracle_energy import ANOMALIES, ENERGY

DEVICES = ENERGY + """,
copies as (select * from (values (0, timestamp '2024-01-01'), (1, timestamp '2024-01-11'), (2, timestamp '2024-01-21 12:00:00')) t(k, taken_at)),
snaps as (select taken_at, lead(taken_at) over (partition by c_custkey order by k) seen_next, lag(taken_at) over (partition by c_custkey order by k) seen_before,
  k, 'DEV-'||lpad(c_custkey::varchar,6,'0') device_eui,
  case when k >= 1 and c_custkey%6 = 0 then 'MOVED-' else '' end || 'CLIENT-'||lpad(c_custkey::varchar,6,'0') client_id,
  'LOC-'||lpad((case when k >= 2 and c_custkey%10 = 0 then (c_nationkey + 1) % 25 else c_nationkey end)::varchar,3,'0') location_id,
  case when c_custkey%11=0 then '' else c_mktsegment end device_category
 from customer, copies where c_custkey%7 <> 0 and not (k = 1 and c_custkey%13 = 0)),
begun as (select s.*, (select max(taken_at) from copies c where c.k = s.k - 1) before_all, (select min(taken_at) from copies c where c.k = s.k + 1) next_all,
  lag((client_id, location_id, device_category)) over (partition by device_eui order by k) last_values from snaps s),
islands as (select *, sum(case when seen_before is not distinct from before_all and seen_before is not null
   and last_values = (client_id, location_id, device_category) then 0 else 1 end) over (partition by device_eui order by k) island from begun),
devices as (select device_eui, client_id, location_id, device_category, min(taken_at) valid_from,
  case when bool_or(next_all is null) then null else max(next_all) end valid_to from islands group by device_eui, island, client_id, location_id, device_category),
keyed as (select md5(device_eui || '|' || epoch_us(valid_from)::varchar) device_key, * from devices)"""

ENTRIES = ENERGY + """,
entries as (
 select 'E'||event_id entry_id, dev device_eui, ts::date "day", ts + interval 1 day recorded_at, -1.0::double kwh, 'meter test' justification, null reverses
 from h where event_id%500 = 0
 union all select 'E'||event_id||'-r', dev, ts::date, ts + interval 3 day, 1.0::double, 'wrong amount', 'E'||event_id from h where event_id%1000 = 0
 union all select 'E'||event_id||'-2', dev, ts::date, ts + interval 3 day, -0.5::double, 'meter test', null from h where event_id%1000 = 0),
times as (select * from (values (timestamp '2024-01-15'), (timestamp '2024-01-31 12:00:00')) t(known_at))"""


def _framed(*fields: str) -> str:
    return " || ".join(f"coalesce(length({f})::varchar || ':' || ({f}), '-')" for f in fields)


_ENTRY = _framed("entry_id", "device_eui", "strftime(\"day\", '%Y-%m-%d')", "epoch_us(recorded_at)::varchar", "kwh::varchar", "justification", "reverses")

_SELECTS: dict[str, tuple[str, str]] = {
    "star_devices": (DEVICES, "select * from keyed"),
    "star_facts": (
        DEVICES,
        """select e.device_eui, device_key, at_time::date "day", sum(kwh) kwh, count(*) n_readings, max(demand_kw) max_demand_kw,
         k.client_id, k.location_id, k.device_category, year(at_time::date)::int "year", month(at_time::date)::int "month",
         isodow(at_time::date)::int iso_weekday, isodow(at_time::date) >= 6 is_weekend
         from energy e left join keyed k on e.device_eui = k.device_eui and at_time >= valid_from and (valid_to is null or at_time < valid_to)
         group by all""",
    ),
    "usage_as_known": (
        ENTRIES,
        """select known_at, device_eui, "day", sum(metered) metered_kwh, sum(adj) adjustment_kwh, sum(n)::bigint n_entries, sum(metered) + sum(adj) net_kwh from (
         select known_at, device_eui, at_time::date "day", kwh metered, 0.0::double adj, 0 n from energy, times
         union all select known_at, device_eui, "day", 0.0::double, kwh, 1 from entries, times where recorded_at <= known_at) group by 1, 2, 3""",
    ),
    "ledger_seals": (
        ENTRIES,
        f"""select device_eui, "month", n_entries, digest, list_reduce(list_prepend('', list(digest) over (partition by device_eui order by "month")),
          lambda a, x: sha256(a || x)) seal from (
         select device_eui, strftime(recorded_at, '%Y-%m') "month", count(*) n_entries, sha256(string_agg(d, '' order by recorded_at, entry_id)) digest
         from (select *, sha256({_ENTRY}) d from entries) group by 1, 2)""",
    ),
    "gaps_to_date": (
        ENERGY,
        """select device_eui, interval_start + interval 15 minute gap_start, following gap_end,
         (epoch_us(following) - epoch_us(interval_start)) // 900000000 - 1 missing_intervals, is_open "open"
         from (select device_eui, interval_start, coalesce(lead(interval_start) over w, timestamp '2024-01-31') following, lead(interval_start) over w is null is_open
          from (select distinct device_eui, interval_start from device_slots
           union all select device_eui, timestamp '2023-12-31 23:45:00' from registry where device_eui not in (select device_eui from device_slots))
          window w as (partition by device_eui order by interval_start))
         where interval_start < timestamp '2024-01-31' and following > interval_start + interval 15 minute""",
    ),
    "usage_filled": (
        ENERGY,
        """, instants as (select device_eui, epoch_us(at_time) at_us, sum(kwh) kwh from energy group by all),
         steps as (select *, lag(at_us) over (partition by device_eui order by at_us) before from instants),
         cut as (select *, at_us // 900000000 * 900000000 b, before // 900000000 * 900000000 a from steps),
         runs as (
          select device_eui, b run, 1::bigint n, kwh, false filled from cut where before is null or a = b
          union all select device_eui, a, 1, kwh * ((a + 900000000 - before)::double / (at_us - before)::double), false from cut where a < b
          union all select device_eui, a + 900000000, (b - a) // 900000000 - 1, kwh * (900000000::double / (at_us - before)::double), true from cut where b > a + 900000000
          union all select device_eui, b, 1, kwh * ((at_us - b)::double / (at_us - before)::double), false from cut where a < b)
         select device_eui, make_timestamp(run) run_start, n n_intervals, round(sum(kwh), 9) kwh_each, filled from runs group by device_eui, run, n, filled""",
    ),
    "range_usage": (
        ENERGY,
        """, asked as (select 'LOC-'||lpad(n_nationkey::varchar,3,'0') location_id, timestamp '2023-12-30' + to_hours(n_nationkey * 7) range_start,
          timestamp '2024-02-02' - to_hours(n_nationkey * 5) range_end from nation)
         select location_id, range_start, range_end, coalesce(sum(kwh), 0) kwh, max(kwh) * 4 max_kw
         from asked left join place_slots using (location_id)
         where interval_start is null or (interval_start >= range_start and interval_start < range_end) group by 1, 2, 3""",
    ),
    "conditional_reports": (
        ANOMALIES,
        """, items as (
          select kind, device_eui, location_id, interval_start item_time, kwh "value" from findings
          union all select 'interval', null, location_id, interval_start, kwh from place_slots
          union all select 'fault:' || substr(detail, 1, 7), eui, case when route = 'enriched' then location_id end, sent, null
           from decoded where detail not in ('upstream_error', 'empty_payload')),
         held as (
          select *, 'ops' report_group, concat_ws(',', case when kind = 'interval' and "value" >= 60 then 'overuse' end, case when kind in ('spike', 'drop') then 'sudden' end) rules from items
          union all select *, 'service', case when kind like 'fault%' then 'fault' else '' end from items
          union all select *, 'exec', concat_ws(',', case when "value" > 100 then 'large' end, case when kind in ('offhours', 'baseline') then 'unusual' end) from items)
         select * from held where rules <> ''""",
    ),
}

ORACLE = {
    name: f"with {base}{select}" if select.startswith(",") else f"with {base}\n{select}" for name, (base, select) in _SELECTS.items()
}
