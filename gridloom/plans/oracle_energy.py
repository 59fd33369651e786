"""The energy queries again as plain SQL over the same tables, for comparison."""

from __future__ import annotations

from gridloom.plans.oracle_messages import READINGS

ENERGY = READINGS + """,
energy as (select device_eui, location_id, device_category, client_id, original_mqtt_time at_time, reading kwh,
 average_current * average_voltage / 1000 demand_kw, time_bucket(interval 15 minute, original_mqtt_time) slot from meter),
device_slots as (select device_eui, location_id, device_category, slot interval_start, sum(kwh) kwh, count(*) n_readings from energy group by all),
place_slots as (select location_id, slot interval_start, sum(kwh) kwh, count(*) n_readings from energy group by all),
daily as (select location_id, at_time::date "day", sum(kwh) kwh from energy group by all)"""

# The same with the readings as those of a running meter that restarts from zero.
_STEPS = """energy as (select * exclude (before) replace (
  case when before is null then 0 when kwh >= before then kwh - before else kwh end as kwh)
 from (select *, lag(kwh) over (partition by device_eui order by at_time) before from registers)),
device_slots"""

# The shared tariff as a rule of weekday and hour.
_PEAK = "isodow(T) <= 5 and hour(T) >= 16 and hour(T) < 20"
_SHOULDER = "isodow(T) <= 5 and ((hour(T) >= 7 and hour(T) < 16) or (hour(T) >= 20 and hour(T) < 22))"


def _period(t: str) -> str:
    return (
        f"case when {_PEAK.replace('T', t)} then 'peak'"
        f" when {_SHOULDER.replace('T', t)} then 'shoulder' else 'off-peak' end"
    )


def _rate(t: str) -> str:
    return (
        f"case when {_PEAK.replace('T', t)} then 0.5::double"
        f" when {_SHOULDER.replace('T', t)} then 0.25::double else 0.125::double end"
    )


PRICED = ENERGY + f""",
priced as (select *, {_period('interval_start')} period, {_rate('interval_start')} rate from place_slots)"""

ALERTS = PRICED + """,
alerts as (select location_id, interval_start, kwh, 64.0::double threshold_kwh,
 case when kwh >= 64 then 'breach' else 'warning' end "level" from place_slots where kwh >= 51.2::double)"""

ANOMALIES = ALERTS + """,
marked as (select *,
 isodow(interval_start) >= 6 or hour(interval_start) < 6 or hour(interval_start) >= 22 quiet from device_slots),
scored as (select *,
 round(avg(case when quiet then kwh end) over d + stddev_samp(case when quiet then kwh end) over d, 6) off_limit,
 avg(kwh) over b base, count(kwh) over b base_n, lag(kwh) over o before
 from marked window d as (partition by device_eui), o as (partition by device_eui order by interval_start),
 b as (partition by device_eui order by interval_start rows between 8 preceding and 1 preceding)),
findings as (
 select device_eui, location_id, interval_start, 'offhours' kind, kwh, off_limit compared_with from scored where quiet and kwh > off_limit
 union all select device_eui, location_id, interval_start, 'baseline', kwh, base from scored where base_n = 8 and kwh > 1.5::double * base
 union all select device_eui, location_id, interval_start, 'spike', kwh, before from scored where before > 0 and kwh >= 2 * before
 union all select device_eui, location_id, interval_start, 'drop', kwh, before from scored where before > 0 and kwh * 2 <= before)"""

EMISSIONS = ENERGY + """,
places as (select 'LOC-'||lpad(n_nationkey::varchar,3,'0') location_id, n_regionkey region from nation),
factors as (select r_regionkey region, start_time + to_days(case when r_regionkey = 0 then 2 else 0 end) valid_from, factor
 from region, (values (timestamp '2024-01-01', 0.25::double), (timestamp '2024-01-11', 0.375::double),
  (timestamp '2024-01-21', 0.125::double)) f(start_time, factor)),
placed as (select e.*, p.region from energy e left join places p using (location_id)),
factored as (select p.*, f.factor from placed p asof left join factors f on p.region = f.region and p.at_time >= f.valid_from),
emitted as (select location_id, device_category, at_time::date "day", factor, sum(kwh) kwh, sum(kwh * factor) co2e_kg
 from factored group by all)"""


def _trend(source: str, value: str) -> str:
    return f"""select unit, location_id, period_start, {value}, previous_{value}, {value} - previous_{value} "change",
     round({value} / nullif(previous_{value}, 0) - 1, 6) change_ratio from (
     select *, lag({value}) over (partition by unit, location_id order by period_start) previous_{value} from (
     select unit, location_id, date_trunc(unit, "day")::date period_start, sum({value}) {value}
     from {source}, (values ('day'), ('week'), ('month'), ('year')) u(unit) group by 1, 2, 3))"""


_COSTS = """costs as (
 select location_id, date_trunc('month', interval_start)::date "month", 'energy:' || period component,
  sum(kwh) quantity, sum(kwh * rate) "cost" from priced group by all
 union all select location_id, date_trunc('month', interval_start)::date, 'demand', max(kwh) * 4, max(kwh) * 4 * 8 from priced group by 1, 2
 union all select location_id, date_trunc('month', interval_start)::date, 'fixed', 1.0::double, 16.0::double from priced group by 1, 2)"""

_SELECTS: dict[str, tuple[str, str]] = {
    "usage_intervals": (ENERGY, "select *, 0::bigint n_excluded from device_slots"),
    "reading_gaps": (
        ENERGY,
        """select device_eui, interval_start + interval 15 minute gap_start, following gap_end,
         (epoch_us(following) - epoch_us(interval_start)) // 900000000 - 1 missing_intervals
         from (select device_eui, interval_start, lead(interval_start) over (partition by device_eui order by interval_start) following
          from (select distinct device_eui, interval_start from device_slots))
         where following > interval_start + interval 15 minute""",
    ),
    "usage_rollup": (
        ENERGY,
        """select location_id, device_category, grouping(location_id, device_category)::int "level", sum(kwh) kwh, count(*) n_readings
         from energy group by rollup(location_id, device_category)""",
    ),
    "current_demand": (
        ENERGY,
        """select device_eui, location_id, at_time measured_at, demand_kw from (
         select *, row_number() over (partition by device_eui order by at_time desc) n from energy) where n = 1""",
    ),
    "energy_to_date": (
        ENERGY,
        """select location_id, coalesce(sum(kwh) filter (at_time >= timestamp '2024-01-30 23:00:00'), 0) last_hour_kwh,
         coalesce(sum(kwh) filter (at_time >= timestamp '2024-01-31'), 0) today_kwh,
         coalesce(sum(kwh) filter (at_time >= timestamp '2024-01-29'), 0) week_kwh, sum(kwh) month_kwh
         from energy where at_time >= timestamp '2024-01-01' and at_time < timestamp '2024-01-31' group by 1""",
    ),
    "energy_running": (
        ENERGY,
        """select device_eui, interval_start, kwh, sum(kwh) over (partition by device_eui order by interval_start) running_kwh
         from (select device_eui, interval_start, sum(kwh) kwh from device_slots group by all)""",
    ),
    "energy_cumulative": (
        ENERGY,
        """select device_eui, at_time::date "day", sum(case when before is null then 0 when kwh >= before then kwh - before else kwh end) kwh
         from (select *, lag(kwh) over (partition by device_eui order by at_time) before from energy) group by all""",
    ),
    "usage_trend": (ENERGY, _trend("daily", "kwh")),
    "usage_vs_target": (
        ENERGY,
        """select location_id, date '2024-01-01' "month", coalesce(kwh, 0) kwh, 8192.0::double target,
         coalesce(kwh, 0) - 8192 delta, coalesce(kwh, 0) / 8192 ratio
         from (select 'LOC-'||lpad(n_nationkey::varchar,3,'0') location_id from nation)
         left join (select location_id, sum(kwh) kwh from energy where date_trunc('month', at_time) = timestamp '2024-01-01' group by 1)
         using (location_id)""",
    ),
    "peak_alerts": (ALERTS, "select * from alerts"),
    "alert_episodes": (
        PRICED,
        """select location_id, min(interval_start) "begin", max(interval_start) + interval 15 minute "end", count(*) n_intervals, sum(kwh) kwh,
         max(kwh) peak_kwh, arg_min(interval_start, (-kwh, interval_start)) peak_start, max(kwh) >= 64 breach from (
         select *, sum(case when interval_start - before <= interval 15 minute then 0 else 1 end) over (partition by location_id order by interval_start) n from (
         select *, lag(interval_start) over (partition by location_id order by interval_start) before from place_slots where kwh >= 64.0::double * 0.6::double))
         group by location_id, n having max(kwh) >= 51.2::double""",
    ),
    "demand_peaks": (
        PRICED,
        """select location_id, period, interval_start, kwh peak_kwh, kwh * 4 peak_kw from (
         select *, row_number() over (partition by location_id, period order by kwh desc, interval_start) n from priced) where n = 1""",
    ),
    "tariff_match": (PRICED, "select location_id, interval_start, kwh, period, rate from priced"),
    "tariff_overlaps": (
        """offers as (select 'T-'||lpad(s_suppkey::varchar,6,'0') tariff_id, 'LOC-'||lpad(s_nationkey::varchar,3,'0') location_id,
          date '2024-01-01' + (s_suppkey%60)::int valid_from, date '2024-01-01' + (s_suppkey%60)::int + (10 + s_suppkey%50)::int valid_to,
          1 + s_suppkey%3 first_day, 3 + s_suppkey%5 last_day, s_suppkey%24 h0, s_suppkey*7%24 h1 from supplier),
         cells as (select distinct tariff_id, location_id, valid_from, valid_to, (d - 1 + h // 24) % 7 wd, h % 24 hr
          from offers, range(1, 8) a(d), range(0, 48) b(h)
          where d between least(first_day, last_day) and greatest(first_day, last_day)
           and h >= h0 and h < case when h1 > h0 then h1 else h1 + 24 end)""",
        """select tariff_id, location_id, count(*) overlapping_hours, max(until) in_force_until from (
         select a.tariff_id, a.location_id, a.wd, a.hr, max(b.valid_to) until from cells a join cells b
         on a.location_id = b.location_id and a.wd = b.wd and a.hr = b.hr
          and (b.valid_from, b.tariff_id) < (a.valid_from, a.tariff_id) and b.valid_to > a.valid_from
         group by all) group by 1, 2""",
    ),
    "cost_report": (PRICED + ",\n" + _COSTS, "select * from costs"),
    "load_shift": (
        ENERGY,
        f"""select *, row_number() over (partition by location_id order by peak_share desc, device_category)::int place from (
         select *, round(peak_kwh / total_kwh, 6) peak_share from (
         select location_id, device_category, coalesce(sum(kwh) filter ({_period('interval_start')} = 'peak'), 0) peak_kwh,
         sum(kwh) total_kwh from device_slots group by 1, 2))""",
    ),
    "anomaly_offhours": (ANOMALIES, "select * from findings where kind = 'offhours'"),
    "anomaly_baseline": (ANOMALIES, "select * from findings where kind = 'baseline'"),
    "anomaly_spikes": (ANOMALIES, "select * from findings where kind in ('spike', 'drop')"),
    "anomaly_report": (ANOMALIES, "select * from findings"),
    "co2e": (
        EMISSIONS,
        """select location_id, device_category, "day", sum(kwh) kwh, sum(co2e_kg) co2e_kg,
         coalesce(sum(kwh) filter (factor is null), 0) unfactored_kwh from emitted group by 1, 2, 3""",
    ),
    "co2e_trend": (EMISSIONS, _trend("emitted", "co2e_kg")),
    "compliance_report": (
        EMISSIONS,
        """select location_id, device_category, grouping(location_id, device_category)::int "level", sum(kwh) kwh, sum(co2e_kg) co2e_kg,
         coalesce(string_agg(distinct factor::varchar, ',' order by factor::varchar), '') factors_used
         from emitted where "day" between date '2024-01-01' and date '2024-01-31' group by rollup(location_id, device_category)""",
    ),
    "factors_used": (
        EMISSIONS,
        """select p.region::varchar region, location_id, factor, min("day") first_day, max("day") last_day, sum(kwh) kwh, sum(co2e_kg) co2e_kg
         from emitted left join places p using (location_id) where "day" between date '2024-01-01' and date '2024-01-31' group by 1, 2, 3""",
    ),
    "adjusted_usage": (
        ENERGY,
        """select device_eui, "day", sum(metered) metered_kwh, sum(adj) adjustment_kwh, sum(n)::bigint n_adjustments,
         case when sum(n) > 0 then 'meter test' else '' end justifications, sum(metered) + sum(adj) net_kwh from (
         select device_eui, at_time::date "day", kwh metered, 0.0::double adj, 0 n from energy
         union all select dev, ts::date, 0.0::double, -1.0::double, 1 from h where event_id % 500 = 0) group by 1, 2""",
    ),
    "target_progress": (
        EMISSIONS,
        """select location_id, "month", "day", co2e_kg, co2e_to_date, 2048.0::double target, round(co2e_to_date / 2048, 6) share_of_target
         from (select *, date_trunc('month', "day")::date "month", sum(co2e_kg) over (partition by location_id order by "day") co2e_to_date
          from (select location_id, "day", coalesce(sum(co2e_kg), 0) co2e_kg from emitted group by 1, 2))
         where "month" = date '2024-01-01'""",
    ),
    "cost_co2e_corr": (
        EMISSIONS,
        f"""select location_id, "month", grouping(location_id, "month")::int "level", count(*) n_days, sum("cost") "cost", sum(co2e_kg) co2e_kg,
         round(case when count(*) >= 3 then corr("cost", co2e_kg) end, 6) correlation from (
         select location_id, date_trunc('month', at_time)::date "month", at_time::date "day",
         sum(kwh * {_rate('at_time')}) "cost", sum(kwh * factor) co2e_kg from factored group by 1, 2, 3)
         group by cube(location_id, "month")""",
    ),
    "export_csv": (
        ENERGY,
        'select location_id, device_category, at_time::date "day", sum(kwh) kwh from energy group by 1, 2, 3',
    ),
    "bi_daily": (
        ENERGY,
        """select device_eui, location_id, device_category, client_id, at_time::date "day", sum(kwh) kwh, count(*) n_readings,
         max(demand_kw) max_demand_kw, year(at_time::date)::int "year", month(at_time::date)::int "month",
         isodow(at_time::date)::int iso_weekday, isodow(at_time::date) >= 6 is_weekend from energy group by all""",
    ),
    "group_reports": (
        ANOMALIES + ",\n" + _COSTS,
        """select 'ops' report_group, 'anomalies' report, location_id, interval_start item_time, kind || ':' || device_eui kind, kwh "value" from findings
         union all select 'finance', 'cost', location_id, "month"::timestamp, component, "cost" from costs
         union all select 'exec', 'usage', location_id, "day"::timestamp, 'kwh', kwh from daily
          where location_id in (select location_id from alerts)""",
    ),
    "quality_report": (
        READINGS,
        """select *, round(n_rows / n_total, 9) "share" from (
         select 'unknown_device' "rule", count(*) filter (route = 'unidentified') n_rows, count(*) n_total from decoded
         union all select 'empty_payload', count(*) filter (detail = 'empty_payload'), count(*) from decoded
         union all select 'undecodable', count(*) filter (detail not in ('upstream_error', 'empty_payload')), count(*) from decoded
         union all select 'missing_time', 0, count(*) from decoded
         union all select 'future_time', 0, count(*) from decoded
         union all select 'uid_not_text', 0, count(*) from decoded
         union all select 'not_finite', 0, count(*) from decoded
         union all select 'out_of_range', (select count(*) from meter where reading > 120), count(*) from decoded
         union all select 'max_current_below_average', (select count(*) from meter where max_current < average_current), count(*) from decoded
         union all select 'max_voltage_below_average', (select count(*) from meter where max_voltage < average_voltage), count(*) from decoded)""",
    ),
}

for _name in ("usage_rollup", "cost_report", "co2e", "bi_daily"):
    _base, _select = _SELECTS[_name]
    _metered = _base.replace("energy as (", "registers as (", 1).replace("device_slots", _STEPS, 1)
    _SELECTS[f"{_name}_metered"] = (_metered, _select)

ORACLE = {name: f"with {base}\n{select}" for name, (base, select) in _SELECTS.items()}
