"""DuckDB oracle SQL for every registered query.

Each statement starts from the driver's views (``supplier customer lineitem
orders``) and re-derives the operational sources with the same fixed mapping
as ``hangar.sources.driver_views``, then states the query in plain SQL.
Where cheap, the oracle uses a *different formulation* from the Spark code
(full outer joins instead of a union, correlated lookups instead of
windows' stitching) so that the two are independent checks of each other.
"""

from __future__ import annotations

# ---- the operational sources, as CTEs ---------------------------------
SOURCES = """
with
aircraft_lookup as (
  select 'XY-'||printf('%03d', s_suppkey) aircraft_reg_code,
         'MSN'||printf('%06d', s_suppkey) manufacturer_serial_number,
         'M'||printf('%02d', s_nationkey) aircraft_model,
         case when s_nationkey%2=0 then 'Airbus' else 'Boeing' end aircraft_manufacturer
  from supplier where s_suppkey%7<>3),
personnel_lookup as (
  select c_custkey reporteurid, 'N'||printf('%02d', c_nationkey) airport
  from customer where c_custkey%13<>0),
fl_base as (
  select 'XY-'||printf('%03d', l_suppkey) reg, l_orderkey ok,
         (l_returnflag='R' and l_linestatus='O') cancelled,
         l_shipdate+to_minutes(cast((l_partkey*37)%1440 as int)) sd,
         cast(60+l_quantity*12 as int) dur,
         cast((l_orderkey*13+l_linenumber*101)%480 as int)-60 dly,
         (l_linenumber=7 and l_orderkey%5=0) swp
  from lineitem),
fl_times as (
  select *, sd+to_minutes(dur) sa, sd+to_minutes(dly) d0, sd+to_minutes(dur+dly) a0
  from fl_base),
flights as (
  select case when ok%983=3 then null else reg end aircraftregistration, cancelled,
         case when cancelled then null when swp then a0 else d0 end actualdeparture,
         case when cancelled or ok%991=2 then null when swp then d0 else a0 end actualarrival,
         case when ok%997=1 then null else sd end scheduleddeparture,
         sa scheduledarrival
  from fl_times),
maintenance as (
  select 'XY-'||printf('%03d', o_custkey%(select count(*) from supplier))
           aircraftregistration,
         o_orderdate+to_minutes(cast((o_orderkey%24)*60
           +case when o_orderkey%50=1 then 5256000 else 0 end as int)) scheduleddeparture,
         case when o_orderkey%499=4 then null else
           o_orderdate+to_minutes(cast((o_orderkey%24+1+o_orderkey%60)*60
           +case when o_orderkey%50=1 then 5256000 else 0 end as int)) end scheduledarrival,
         o_orderstatus='F' programmed
  from orders),
reports as (
  select 'XY-'||printf('%03d', (o_orderkey*7)%(select count(*) from supplier))
           aircraftregistration,
         cast(o_orderdate+to_minutes(cast(case when o_orderkey%50=0 then 5256000 else 0 end as int))
           as date) reportingdate,
         case when o_orderpriority in ('1-URGENT','2-HIGH') then 'PIREP'
              when o_orderpriority='5-LOW' then 'OTHER' else 'MAREP' end reporteurclass,
         case when o_orderkey%487=5 then null else o_custkey end reporteurid
  from orders)
"""

ORACLES: dict[str, str] = {}


def register(name: str, body: str, ctes: str = "") -> None:
    """``body`` is the final SELECT; ``ctes`` extra CTEs (leading comma)."""
    ORACLES[name] = SOURCES.rstrip() + ctes.rstrip() + "\n" + body.strip() + "\n"


register(
    "scan_flights",
    "select aircraftregistration, cancelled, actualdeparture, actualarrival, "
    "scheduleddeparture, scheduledarrival from flights",
)
register(
    "scan_maintenance",
    "select aircraftregistration, scheduleddeparture, scheduledarrival, programmed "
    "from maintenance",
)
register(
    "scan_reports",
    "select aircraftregistration, reportingdate, reporteurclass, reporteurid from reports",
)

# ---- the warehouse path, as CTEs ----------------------------------------
# Rules and facts restated directly: an unbucketed per-aircraft window for the
# overlap rule, EXISTS for the reference check, full outer joins for the fact.
WAREHOUSE = """,
swapped as (
  select aircraftregistration, cancelled,
         case when not cancelled and actualarrival <= actualdeparture
              then actualarrival else actualdeparture end actualdeparture,
         case when not cancelled and actualarrival <= actualdeparture
              then actualdeparture else actualarrival end actualarrival,
         scheduleddeparture, scheduledarrival
  from flights),
flown as (
  select *, lead(actualdeparture) over (
           partition by aircraftregistration
           order by actualdeparture, actualarrival nulls last,
                    scheduleddeparture nulls last, scheduledarrival nulls last) nxt
  from swapped
  where not cancelled and aircraftregistration is not null and actualdeparture is not null),
overlap_rejects as (
  select aircraftregistration, cancelled, actualdeparture, actualarrival,
         scheduleddeparture, scheduledarrival
  from flown where actualarrival > nxt),
flights_clean as (
  select aircraftregistration, cancelled, actualdeparture, actualarrival,
         scheduleddeparture, scheduledarrival
  from flown where actualarrival is null or nxt is null or actualarrival <= nxt
  union all
  select * from swapped
  where cancelled or aircraftregistration is null or actualdeparture is null),
aircrafts as (
  select cast(row_number() over (order by aircraftregistration) as int) aircraftid,
         aircraftregistration, model, manufacturer
  from (select aircraft_reg_code aircraftregistration, aircraft_model model,
               aircraft_manufacturer manufacturer,
               row_number() over (partition by aircraft_reg_code
                                  order by aircraft_model, aircraft_manufacturer) rn
        from aircraft_lookup where aircraft_reg_code is not null) x
  where rn = 1),
airports as (
  select cast(row_number() over (order by airportcode) as int) airportid, airportcode
  from (select distinct airport airportcode from personnel_lookup where airport is not null) x),
reports_known as (
  select * from reports r
  where exists (select 1 from aircrafts a where a.aircraftregistration = r.aircraftregistration)),
reports_rejects as (
  select * from reports r
  where not exists (select 1 from aircrafts a where a.aircraftregistration = r.aircraftregistration)),
flights_dated as (
  select *, cast(scheduleddeparture as date) date from flights_clean
  where scheduleddeparture is not null),
flight_years as (select distinct year(date) y from flights_dated),
maintenance_valid as (
  select * from maintenance
  where year(cast(scheduleddeparture as date)) in (select y from flight_years)),
reports_valid as (
  select * from reports_known where year(reportingdate) in (select y from flight_years)),
fm0 as (
  select date, aircraftregistration, cancelled,
         epoch_us(actualarrival) - epoch_us(actualdeparture) flown,
         epoch_us(actualarrival) - epoch_us(scheduledarrival) late
  from flights_dated),
fm as (
  select date, aircraftregistration,
         case when cancelled then 0 else coalesce(flown, 0) end flight_us,
         case when cancelled then 0 else 1 end takeoffs,
         case when not cancelled and late > 900000000 and late < 21600000000
              then late else 0 end delay_us,
         case when not cancelled and late > 900000000 and late < 21600000000
              then 1 else 0 end delays,
         case when cancelled then 1 else 0 end cancellations
  from fm0),
mm0 as (
  select cast(scheduleddeparture as date) date, aircraftregistration, programmed,
         coalesce(epoch_us(scheduledarrival) - epoch_us(scheduleddeparture), 0) us
  from maintenance_valid),
mm as (
  select date, aircraftregistration,
         case when programmed then us else 0 end scheduled_us,
         case when programmed then 0 else us end unscheduled_us
  from mm0),
rm as (
  select reportingdate date, aircraftregistration,
         case when reporteurclass = 'PIREP' then 1 else 0 end pilotreports,
         case when reporteurclass = 'MAREP' then 1 else 0 end maintenancereports
  from reports_valid),
dates as (
  select cast(row_number() over (order by date) as int) dateid, date,
         cast(year(date) * 100 + month(date) as int) as "month", cast(year(date) as int) as "year"
  from (select date from fm union select date from mm union select date from rm) x
  where date is not null),
agg_f as (
  select date, aircraftregistration, sum(flight_us) flight_us, sum(takeoffs) takeoffs,
         sum(delays) delays, sum(cancellations) cancellations, sum(delay_us) delay_us
  from fm where aircraftregistration is not null group by date, aircraftregistration),
agg_m as (
  select date, aircraftregistration, sum(scheduled_us) s_us, sum(unscheduled_us) u_us
  from mm where aircraftregistration is not null group by date, aircraftregistration),
agg_r as (
  select date, aircraftregistration, sum(pilotreports) p, sum(maintenancereports) r
  from rm where aircraftregistration is not null group by date, aircraftregistration),
daily as (
  select date, aircraftregistration,
         cast(coalesce(takeoffs, 0) as int) takeoffs,
         cast(cast(coalesce(flight_us, 0) as double) / 3600000000.0 as real) flighthours,
         cast(cast(coalesce(s_us, 0) as double) / 86400000000.0 as real) ADOSS,
         cast(cast(coalesce(u_us, 0) as double) / 86400000000.0 as real) ADOSU,
         cast(coalesce(delays, 0) as int) delays,
         cast(coalesce(cancellations, 0) as int) cancellations,
         cast(cast(coalesce(delay_us, 0) as double) / 60000000.0 as real) delayduration,
         cast(coalesce(p, 0) as int) pilotreports,
         cast(coalesce(r, 0) as int) maintenancereports
  from agg_f full join agg_r using (date, aircraftregistration)
             full join agg_m using (date, aircraftregistration)),
fact_daily as (
  select d.dateid, a.aircraftid, x.takeoffs, x.flighthours, x.ADOSS, x.ADOSU, x.delays,
         x.cancellations, x.delayduration, x.pilotreports, x.maintenancereports
  from daily x join aircrafts a on a.aircraftregistration = x.aircraftregistration
               join dates d on d.date = x.date),
ac_totals as (
  select aircraftregistration, sum(takeoffs) takeoffs, sum(flight_us) flight_us
  from fm where aircraftregistration is not null group by aircraftregistration),
marep as (
  select reporteurid, aircraftregistration, count(*) as "count"
  from reports_valid where reporteurclass = 'MAREP' and reporteurid is not null
  group by reporteurid, aircraftregistration),
per_airport as (
  select m.aircraftregistration, p.airport, sum(m.count) reports
  from marep m join personnel_lookup p on p.reporteurid = m.reporteurid
  where p.airport is not null group by m.aircraftregistration, p.airport),
fact_total as (
  select ap.airportid, a.aircraftid,
         cast(coalesce(t.takeoffs, 0) as int) takeoffs,
         cast(cast(coalesce(t.flight_us, 0) as double) / 3600000000.0 as real) flighthours,
         cast(x.reports as int) reports
  from per_airport x left join ac_totals t on t.aircraftregistration = x.aircraftregistration
       join aircrafts a on a.aircraftregistration = x.aircraftregistration
       join airports ap on ap.airportcode = x.airport),
star as (
  select f.*, a.aircraftregistration, a.manufacturer, d.year
  from fact_daily f join aircrafts a on a.aircraftid = f.aircraftid
                    join dates d on d.dateid = f.dateid)
"""


def _wh(name: str, body: str) -> None:
    register(name, body, WAREHOUSE)


_FLIGHT_COLS = ("aircraftregistration, cancelled, actualdeparture, actualarrival, "
                "scheduleddeparture, scheduledarrival")
_wh("dim_aircraft", "select aircraftid, aircraftregistration, model, manufacturer from aircrafts")
_wh("dim_airport", "select airportid, airportcode from airports")
_wh("dim_date", "select dateid, date, month, year from dates")
_wh("swap_times", f"select {_FLIGHT_COLS} from swapped")
_wh("overlap_clean", f"select {_FLIGHT_COLS} from flights_clean")
_wh("overlap_rejects", f"select {_FLIGHT_COLS} from overlap_rejects")
_REPORT_COLS = "aircraftregistration, reportingdate, reporteurclass, reporteurid"
_wh("reports_valid", f"select {_REPORT_COLS} from reports_known")
_wh("reports_rejects", f"select {_REPORT_COLS} from reports_rejects")
_wh("valid_years_reports", f"select {_REPORT_COLS} from reports_valid")
_wh("valid_years_maintenance",
    "select aircraftregistration, scheduleddeparture, scheduledarrival, programmed "
    "from maintenance_valid")
_wh("flight_measures",
    "select date, aircraftregistration, flight_us, takeoffs, delay_us, delays, cancellations "
    "from fm")
_wh("daily_flights", """
select date, aircraftregistration,
       cast(cast(flight_us as double) / 3600000000.0 as real) flighthours,
       cast(takeoffs as int) takeoffs, cast(delays as int) delays,
       cast(cancellations as int) cancellations,
       cast(cast(delay_us as double) / 60000000.0 as real) delayduration
from agg_f""")
_wh("daily_maintenance", """
select date, aircraftregistration,
       cast(cast(s_us as double) / 86400000000.0 as real) ADOSS,
       cast(cast(u_us as double) / 86400000000.0 as real) ADOSU
from agg_m""")
_wh("daily_reports", """
select date, aircraftregistration, cast(p as int) pilotreports,
       cast(r as int) maintenancereports
from agg_r""")
_FACT_COLS = ("dateid, aircraftid, takeoffs, flighthours, ADOSS, ADOSU, delays, cancellations, "
              "delayduration, pilotreports, maintenancereports")
_wh("fact_daily", f"select {_FACT_COLS} from fact_daily")
_wh("fact_daily_join_form", f"select {_FACT_COLS} from fact_daily")
_wh("aircraft_totals", """
select aircraftregistration, cast(takeoffs as bigint) takeoffs,
       cast(cast(flight_us as double) / 3600000000.0 as real) flighthours
from ac_totals""")
_wh("marep_counts", "select reporteurid, aircraftregistration, count from marep")
_wh("fact_total_maintenance",
    "select airportid, aircraftid, takeoffs, flighthours, reports from fact_total")

# ---- warehouse KPI queries (Q1-Q3) ---------------------------------------
# Sums and the number of aircraft of each group once; the KPIs from their names.
def _sums_of(where: str) -> str:
    return f""",
g as (
  select manufacturer, year, count(distinct aircraftregistration) n,
         sum(flighthours) flying, sum(takeoffs) cycles, sum(ADOSS) planned, sum(ADOSU) unplanned,
         nullif(sum(delays), 0) late, sum(cancellations) lost, sum(delayduration) waited,
         sum(pilotreports) pireps, sum(maintenancereports) mareps
  from star where {where} group by manufacturer, year)"""


def _utilization(where: str) -> str:
    return _sums_of(where) + """, h as (
  select *, round(flying / n, 2) fh, floor(cycles / n) flown, nullif(cycles, 0) base,
         round((planned + unplanned) / n, 2) away, coalesce(late, 0) delayed from g),
k as (select *, 365 - away present from h)
select manufacturer, year,
       fh::decimal(10,2) FH, flown::decimal(10,2) TakeOff,
       round(planned / n, 2)::decimal(10,2) ADOSS, round(unplanned / n, 2)::decimal(10,2) ADOSU,
       away::decimal(10,2) ADOS, present::decimal(10,2) ADIS,
       round(fh / nullif(present * 24, 0), 2)::decimal(10,2) DU,
       round(flown / nullif(present, 0), 2)::decimal(10,2) DC,
       (100 * round(delayed / base, 4))::decimal(10,2) DYR,
       (100 * round(lost / base, 4))::decimal(10,2) CNR,
       (100 - floor(100 * (delayed + lost) / base))::decimal(10,2) TDR,
       (100 * round(waited / late, 2))::decimal(10,2) ADD
from k"""


_wh("kpi_utilization", _utilization("true"))
_wh("kpi_utilization_years", _utilization("year in (1994, 1995, 1996)"))
_wh("kpi_reporting", _sums_of("true") + """
select manufacturer, year,
       (1000 * round((pireps + mareps) / nullif(flying, 0), 3))::decimal(10,3) RRh,
       (100 * round((pireps + mareps) / nullif(cycles, 0), 2))::decimal(10,2) RRc
from g""")
_wh("kpi_reporting_by_role", _sums_of("true") + """,
r as (select *, unnest(['PIREP', 'MAREP']) as "role", unnest([pireps, mareps]) reports from g)
select manufacturer, year, "role",
       (1000 * round(reports / nullif(flying, 0), 3))::decimal(10,3) RRh,
       (100 * round(reports / nullif(cycles, 0), 2))::decimal(10,2) RRc
from r""")

_wh("kpi_utilization_span", """, s as (
  select manufacturer, count(distinct aircraftregistration) planes, sum(flighthours) flying,
         sum(takeoffs) cycles, sum(ADOSS) planned, sum(ADOSU) unplanned, sum(delays) late,
         sum(cancellations) lost
  from star where year >= 1994 and year <= 1996 group by manufacturer)
select manufacturer, 1994 first_year, 1996 last_year, planes aircraft,
       round(flying / planes, 2)::decimal(10,2) FH, floor(cycles / planes)::decimal(10,2) TakeOff,
       round(planned / planes, 2)::decimal(10,2) ADOSS,
       round(unplanned / planes, 2)::decimal(10,2) ADOSU,
       (100 * round(late / nullif(cycles, 0), 4))::decimal(10,2) DYR,
       (100 * round(lost / nullif(cycles, 0), 4))::decimal(10,2) CNR
from s""")

# ---- lookup files with malformed lines --------------------------------------
register("csv_lookup_rejects", """
select case when c_custkey % 10 = 1 then c_custkey || ',N' || printf('%02d', c_nationkey) || ',extra'
            else c_custkey::varchar end line
from customer where c_custkey % 10 in (1, 2)""")
register("csv_lookup_rows", """
select case when c_custkey % 10 <> 4 then c_custkey::bigint end reporteurid,
       'N' || printf('%02d', c_nationkey) || case when c_custkey % 10 = 5 then ',T2' else '' end airport
from customer where c_custkey % 10 not in (1, 2)""")

# ---- what is kept from refresh to refresh -----------------------------------
_wh("overlap_rejects_log",
    f"select {_FLIGHT_COLS}, unnest(['first', 'second']) run from overlap_rejects")
_wh("reports_rejects_log",
    f"select {_REPORT_COLS}, unnest(['first', 'second']) run from reports_rejects")
_wh("dim_aircraft_kept_ids", """
select cast(case when manufacturer = 'Boeing' then 0
                 else (select count(*) from aircrafts where manufacturer = 'Boeing') end
            + rank() over (partition by manufacturer = 'Boeing' order by aircraftregistration)
            as int) aircraftid,
       aircraftregistration, model, manufacturer
from aircrafts""")
_wh("dim_airport_kept_ids", """
select cast(case when airportcode > 'N12' then 0
                 else (select count(*) from airports where airportcode > 'N12') end
            + rank() over (partition by airportcode > 'N12' order by airportcode) as int) airportid,
       airportcode
from airports""")

# ---- source-level queries (Q4-Q6) ----------------------------------------
# Manufacturer by IN-lists against the lookup (the Spark code joins instead).
SOURCE_LEVEL = """,
airbus as (select aircraft_reg_code r from aircraft_lookup where aircraft_manufacturer = 'Airbus'),
boeing as (select aircraft_reg_code r from aircraft_lookup where aircraft_manufacturer = 'Boeing'),
atomic0 as (
  select aircraftregistration, cast(year(scheduleddeparture) as varchar) as "year",
         case when cancelled then 0
              else epoch_us(actualarrival) - epoch_us(actualdeparture) end flight_us,
         case when cancelled then 0 else 1 end cycles,
         case when cancelled then 1 else 0 end cancellations,
         case when cancelled then 0
              when epoch_us(actualarrival) - epoch_us(scheduledarrival) > 900000000 then 1
              else 0 end delays,
         case when cancelled then 0
              when epoch_us(actualarrival) - epoch_us(scheduledarrival) > 900000000
              then epoch_us(actualarrival) - epoch_us(scheduledarrival)
              else 0 end delay_us,
         cast(0 as bigint) scheduled_us, cast(0 as bigint) unscheduled_us
  from flights
  union all
  select aircraftregistration, cast(year(scheduleddeparture) as varchar),
         0, 0, 0, 0, 0,
         case when programmed
              then epoch_us(scheduledarrival) - epoch_us(scheduleddeparture) else 0 end,
         case when programmed then 0
              else epoch_us(scheduledarrival) - epoch_us(scheduleddeparture) end
  from maintenance),
atomic as (
  select *, case when aircraftregistration in (select r from airbus) then 'Airbus'
                 when aircraftregistration in (select r from boeing) then 'Boeing'
                 else aircraftregistration end manufacturer
  from atomic0),
src_g as (
  select manufacturer, "year",
         cast(sum(cast(flight_us as decimal(38,0))) as double) / 3600000000.0 H,
         sum(cycles) T,
         cast(sum(cast(scheduled_us as decimal(38,0))) as double) / 86400000000.0 S,
         cast(sum(cast(unscheduled_us as decimal(38,0))) as double) / 86400000000.0 U,
         sum(delays) D, sum(cancellations) C,
         cast(sum(cast(delay_us as decimal(38,0))) as double) / 60000000.0 M,
         count(distinct aircraftregistration) n
  from atomic group by manufacturer, "year"),
util_src as (
  select case when aircraftregistration in (select r from airbus) then 'Airbus'
              when aircraftregistration in (select r from boeing) then 'Boeing'
              else aircraftregistration end manufacturer,
         cast(year(scheduleddeparture) as varchar) as "year",
         cast(sum(cast(case when cancelled then 0
                  else epoch_us(actualarrival) - epoch_us(actualdeparture) end
                  as decimal(38,0))) as double) / 3600000000.0 H,
         sum(case when cancelled then 0 else 1 end) T
  from flights group by 1, 2),
rep_src as (
  select case when aircraftregistration in (select r from airbus) then 'Airbus'
              when aircraftregistration in (select r from boeing) then 'Boeing'
              else aircraftregistration end manufacturer,
         cast(year(reportingdate) as varchar) as "year", reporteurclass as "role"
  from reports)
"""


def _src(name: str, body: str) -> None:
    register(name, body, SOURCE_LEVEL)


_src("registrations_per_manufacturer", """
select r aircraftregistration, 'Airbus' manufacturer from airbus
union
select r, 'Boeing' from boeing where r not in (select r from airbus)""")
_src("source_manufacturer", """
select aircraftregistration,
       case when aircraftregistration in (select r from airbus) then 'Airbus'
            when aircraftregistration in (select r from boeing) then 'Boeing'
            else aircraftregistration end manufacturer
from (select aircraftregistration from flights union select aircraftregistration from maintenance
      union select aircraftregistration from reports) x""")
_src("source_atomic", """
select aircraftregistration, "year", flight_us, cycles, cancellations, delays, delay_us,
       scheduled_us, unscheduled_us, manufacturer
from atomic""")
_src("source_utilization", """
select manufacturer, "year",
  cast(round(H / nullif(n, 0), 2) as decimal(10,2)) FH,
  cast(round((T // nullif(n, 0))::double, 2) as decimal(10,2)) TakeOff,
  cast(round(S / nullif(n, 0), 2) as decimal(10,2)) ADOSS,
  cast(round(U / nullif(n, 0), 2) as decimal(10,2)) ADOSU,
  cast(round((S + U) / nullif(n, 0), 2) as decimal(10,2)) ADOS,
  cast(365 - round((S + U) / nullif(n, 0), 2) as decimal(10,2)) ADIS,
  cast(round(round(H / nullif(n, 0), 2)
       / nullif((365 - round((S + U) / nullif(n, 0), 2)) * 24, 0), 2) as decimal(10,2)) DU,
  cast(round(round((T // nullif(n, 0))::double, 2)
       / nullif(365 - round((S + U) / nullif(n, 0), 2), 0), 2) as decimal(10,2)) DC,
  cast(100 * round(D / nullif(T, 0), 4) as decimal(10,2)) DYR,
  cast(100 * round(C / nullif(T, 0), 4) as decimal(10,2)) CNR,
  cast(100 - round((100 * (D + C) // nullif(T, 0))::double, 2) as decimal(10,2)) TDR,
  cast(100 * round(M / nullif(D, 0), 2) as decimal(10,2)) ADD
from src_g""")
_src("source_reporting", """
select r.manufacturer, r."year",
  cast(1000 * round(r.counter / nullif(u.H, 0), 3) as decimal(10,3)) RRh,
  cast(100 * round(r.counter / nullif(u.T, 0), 2) as decimal(10,2)) RRc
from (select manufacturer, "year", count(*) counter from rep_src group by 1, 2) r
join util_src u on u.manufacturer = r.manufacturer and u."year" = r."year" """)
_src("source_reporting_by_role", """
select r.manufacturer, r."year", r."role",
  cast(1000 * round(r.counter / nullif(u.H, 0), 3) as decimal(10,3)) RRh,
  cast(100 * round(r.counter / nullif(u.T, 0), 2) as decimal(10,2)) RRc
from (select manufacturer, "year", "role", count(*) counter from rep_src group by 1, 2, 3) r
join util_src u on u.manufacturer = r.manufacturer and u."year" = r."year" """)

# ---- integrity checks (C1-C3) and text coercion ----------------------------


def _check_sql() -> tuple[str, str, str]:
    from hangar.schemas import FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS, WAREHOUSE_SCHEMAS

    cte = {"aircrafts": "aircrafts", "dates": "dates", "airports": "airports",
           "daily_aircraft_stats": "fact_daily", "total_maintenance_reports": "fact_total"}
    nulls, keys, refs = [], [], []
    for name, schema in WAREHOUSE_SCHEMAS.items():
        for f in schema:
            if not f.nullable:
                nulls.append(f"select 'not_null:{name}.{f.name}' rule, "
                             f"cast(count(*) filter (where {f.name} is null) as bigint) violations "
                             f"from {cte[name]}")
    for kind, table_keys in (("primary_key", PRIMARY_KEYS), ("unique", UNIQUE_KEYS)):
        for name, cols in table_keys.items():
            c = ", ".join(cols)
            keys.append(f"select '{kind}:{name}({','.join(cols)})' rule, count(*) violations "
                        f"from (select {c} from {cte[name]} group by {c} having count(*) > 1) d")
    for name, fks in FOREIGN_KEYS.items():
        for col, parent in fks:
            refs.append(f"select 'foreign_key:{name}.{col}->{parent}' rule, count(*) violations "
                        f"from {cte[name]} x where not exists "
                        f"(select 1 from {cte[parent]} p where p.{col} = x.{col})")
    return tuple("\nunion all\n".join(parts) for parts in (nulls, keys, refs))


_nulls_sql, _keys_sql, _refs_sql = _check_sql()
_wh("check_nulls", _nulls_sql)
_wh("check_keys", _keys_sql)
_wh("check_refs", _refs_sql)

ORACLES["csv_text_dates"] = """
with t as (
  select o_orderkey,
         case o_orderkey % 4
           when 0 then strftime(o_orderdate, '%Y-%m-%d')
           when 1 then cast(year(o_orderdate) as varchar) || '-' || cast(month(o_orderdate) as varchar)
                       || '-' || cast(day(o_orderdate) as varchar)
           when 2 then strftime(o_orderdate, '%Y-%m-%d %H:%M')
           else 'x' || cast(o_orderkey as varchar) end as "text"
  from orders)
select o_orderkey, "text", cast(try_strptime("text", '%Y-%m-%d') as date) parsed from t
"""
ORACLES["csv_text_ids"] = """
with t as (
  select o_orderkey,
         case o_orderkey % 8
           when 0 then cast(o_custkey as varchar)
           when 1 then cast(o_custkey as varchar) || '.0'
           when 2 then ' ' || cast(o_custkey as varchar) || ' '
           when 4 then cast(o_custkey as varchar) || '.7'
           when 5 then cast(o_custkey + 9007199254740993 as varchar)
           when 6 then 'NaN'
           when 7 then '1e300'
           else 'id' || cast(o_custkey as varchar) end as "text"
  from orders)
select o_orderkey, "text",
       case when regexp_full_match(trim("text"), '[0-9]+([.]0*)?')
            then cast(split_part(trim("text"), '.', 1) as bigint) end reporteurid
from t
"""
