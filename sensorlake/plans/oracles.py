"""The registered queries stated in SQL, for an engine that knows none of the library.

Each statement starts from the driver tables. Only the sensor expressions of the test data
are shared text; rules, statistics and views are written out here.
"""

from __future__ import annotations

from sensorlake.plans import fixture

_SENSED = ",\n    ".join(f"{sql} AS {name}" for name, sql in fixture._READING_SQL.items())


def _r(x: str, digits: int = 1) -> str:
    return f"round(coalesce({x}, 0) + sign(coalesce({x}, 0)) * 1e-9, {digits})"


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _cause(m: str = "methane_ppm", t: str = "temperature_c", s: str = "smoke_level") -> str:
    return (
        f"CASE WHEN coalesce({m}, 0) >= 50 THEN 'GAS_LEAK' WHEN coalesce({t}, 0) >= 42 THEN 'HIGH_TEMP' "
        f"WHEN coalesce({s}, 0) >= 20 THEN 'SMOKE_SPIKE' ELSE 'ELEVATED_RISK' END"
    )


_SEVERE_FIRST = "CASE WHEN alert_status = 'CRITICAL' THEN 0 ELSE 1 END, risk_score DESC, event_id"
_NEWEST_ALERTS = "batch_id = (SELECT max(batch_id) FROM alerts)"
_NEWEST_GOV = "batch_id = (SELECT max(batch_id) FROM gov)"

_CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    _CTE[name] = (sql, needs)


_cte("j", """
  SELECT e.event_id AS eid, e.ts AS event_time, e.event_type, e.value,
    CAST(json_extract_string(e.props, '$.k') AS INT) AS k, c.c_custkey AS h, c.c_mktsegment AS zone,
    n.n_name AS governorate, CAST(date_diff('day', DATE '2024-01-01', CAST(e.ts AS DATE)) AS INT) AS batch_id
  FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey""")
_cte("s", f"SELECT {_SENSED} FROM j", "j")
_cte("r", """
  SELECT s.*,
    CASE WHEN methane_ppm >= 150 OR lpg_ppm >= 200 OR co2_ppm >= 2000 OR smoke_level >= 45 OR aqi >= 150
              OR co_ppm >= 35 OR temperature_c >= 55 THEN 'CRITICAL'
         WHEN methane_ppm >= 50 OR lpg_ppm >= 80 OR co2_ppm >= 1000 OR smoke_level >= 20 OR aqi >= 100
              OR co_ppm >= 9 OR temperature_c >= 42 THEN 'WARNING'
         ELSE 'NORMAL' END AS alert_status,
    round(least((least(coalesce(methane_ppm, 0) / 1.5e2, 1e0) * 35 + least(coalesce(lpg_ppm, 0) / 2e2, 1e0) * 20
               + least(coalesce(smoke_level, 0) / 4.5e1, 1e0) * 20 + least(coalesce(co_ppm, 0) / 3.5e1, 1e0) * 10
               + least(coalesce(aqi, 0) / 1.5e2, 1e0) * 10 + least(coalesce(co2_ppm, 0) / 2e3, 1e0) * 3
               + least(coalesce(temperature_c, 0) / 5.5e1, 1e0) * 2)
        * CASE risk_profile WHEN 'low' THEN 8.5e-1 WHEN 'medium' THEN 1e0 WHEN 'high' THEN 1.15e0 ELSE 1e0 END,
        1e2), 2) AS risk_score
  FROM s""", "s")
_cte("d", "SELECT * REPLACE (" + ", ".join(f"{sql} AS {name}" for name, sql in fixture._DAMAGE_SQL.items()) + ") FROM r", "r")


def _cleaned(source: str) -> str:
    return f"""
  SELECT * REPLACE (
    CASE WHEN temperature_c BETWEEN -10 AND 65 THEN temperature_c ELSE 25e0 END AS temperature_c,
    CASE WHEN humidity_pct BETWEEN 0 AND 100 THEN humidity_pct ELSE 50e0 END AS humidity_pct,
    CASE WHEN methane_ppm >= 0 THEN methane_ppm ELSE 0e0 END AS methane_ppm,
    CASE WHEN aqi BETWEEN 0 AND 500 THEN aqi ELSE 50 END AS aqi,
    coalesce(lpg_ppm, 0e0) AS lpg_ppm, coalesce(co_ppm, 0e0) AS co_ppm, coalesce(smoke_level, 0e0) AS smoke_level,
    coalesce(co2_ppm, 400) AS co2_ppm, coalesce(pm25_ugm3, 1e1) AS pm25_ugm3, coalesce(pm10_ugm3, 2e1) AS pm10_ugm3)
  FROM {source} WHERE house_id IS NOT NULL AND event_time IS NOT NULL"""


_cte("cl", _cleaned("d"), "d")

# A message as it arrives: which micro-batch, and what of it can be parsed.
_cte("rounds", """
  SELECT n, dense_rank() OVER (ORDER BY n) - 1 AS ingest_batch FROM (
    SELECT DISTINCT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 1e1) AS INT) AS n FROM events)""")
_PARSED_FIELDS = [c for c in (*fixture._READING_SQL, "alert_status", "risk_score") if c not in ("eid", "event_time")]
_cte("m", "SELECT eid, x.ingest_batch, CASE WHEN eid % 101 = 0 THEN 'not json' END AS raw_value,\n"
     "    CASE WHEN eid % 101 <> 0 AND eid % 107 <> 0 AND eid % 103 <> 0 THEN date_trunc('second', event_time) END AS event_time,\n    "
     + ",\n    ".join(f"CASE WHEN eid % 101 <> 0 AND eid % 107 <> 0 THEN r.{c} END AS {c}" for c in _PARSED_FIELDS)
     + "\n  FROM r JOIN rounds x ON x.n = CAST(floor(r.batch_id / 1e1) AS INT)", "r", "rounds")
# Parsed readings whose snapshot is the micro-batch.
_cte("mb", "SELECT * REPLACE (ingest_batch AS batch_id) FROM m", "m")
_cte("mcl", _cleaned("m"), "m")
# Messages as the paced run sends them: a sixth with every tick.
_cte("pm", "SELECT * REPLACE (CAST(eid // (SELECT (count(*) + 5) // 6 FROM events) AS BIGINT) AS ingest_batch) FROM m", "m")
_cte("pmb", "SELECT * REPLACE (ingest_batch AS batch_id) FROM pm", "pm")
_cte("pmcl", _cleaned("pm"), "pm")

_ZONE_COLUMNS = """
    avg(methane_ppm) AS avg_methane_ppm, max(methane_ppm) AS max_methane_ppm, avg(temperature_c) AS avg_temperature_c,
    avg(smoke_level) AS avg_smoke_level, avg(co_ppm) AS avg_co_ppm, avg(aqi) AS avg_aqi, max(aqi) AS max_aqi,
    avg(risk_score) AS avg_risk_score, max(risk_score) AS max_risk_score, count(*) AS total_readings,
    count(*) FILTER (alert_status = 'CRITICAL') AS critical_count,
    count(*) FILTER (alert_status = 'WARNING') AS warning_count, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count"""
_GOV_COLUMNS = """
    avg(risk_score) AS avg_risk_score, max(risk_score) AS max_risk_score, avg(methane_ppm) AS avg_methane_ppm,
    avg(aqi) AS avg_aqi, avg(temperature_c) AS avg_temperature_c, count(*) AS total_houses,
    count(*) FILTER (alert_status = 'CRITICAL') AS critical_count,
    count(*) FILTER (alert_status = 'WARNING') AS warning_count, CAST(sum(is_anomaly) AS BIGINT) AS total_anomalies"""


def _statistics(suffix: str, source: str) -> None:
    """Time, zone, governorate and alert CTEs over one source of readings."""
    _cte(f"times{suffix}", f"SELECT batch_id AS b, max(event_time) AS snapshot_time FROM {source} GROUP BY 1", source)
    _cte(f"zones{suffix}", f"""
  SELECT g.*, t.snapshot_time,
    CASE WHEN critical_count > 0 THEN 'CRITICAL' WHEN warning_count > 0 THEN 'WARNING'
         WHEN avg_risk_score >= 15 THEN 'MEDIUM' ELSE 'LOW' END AS zone_risk_level
  FROM (SELECT batch_id, governorate, zone, {_ZONE_COLUMNS} FROM {source} GROUP BY ALL) g
  JOIN times{suffix} t ON t.b = g.batch_id""", source, f"times{suffix}")
    _cte(f"gov{suffix}", f"""
  SELECT g.*, t.snapshot_time,
    CASE WHEN critical_count >= 2 THEN 'CRITICAL' WHEN warning_count >= 3 OR critical_count = 1 THEN 'WARNING'
         WHEN avg_risk_score >= 12 THEN 'MEDIUM' ELSE 'LOW' END AS gov_risk_level
  FROM (SELECT batch_id, governorate, {_GOV_COLUMNS} FROM {source} GROUP BY ALL) g
  JOIN times{suffix} t ON t.b = g.batch_id""", source, f"times{suffix}")
    _cte(f"alerts{suffix}", f"""
  SELECT CAST(batch_id AS BIGINT) AS batch_id, event_id, house_id, governorate, zone, latitude, longitude, building_type,
    alert_status, risk_score, methane_ppm, smoke_level, co_ppm, temperature_c, aqi, is_anomaly, event_time AS alert_time
  FROM {source} WHERE alert_status IN ('WARNING', 'CRITICAL')""", source)


_statistics("", "r")
_statistics("_dirty", "d")
_statistics("_clean", "cl")
_statistics("_stream", "mb")
_statistics("_paced", "pmb")

_cte("fleet", "SELECT DISTINCT house_id, governorate, zone, has_gas_connection, risk_profile FROM r", "r")
_cte("now_alerts", f"""
  SELECT *, {_cause()} AS primary_trigger FROM alerts WHERE {_NEWEST_ALERTS}
  QUALIFY row_number() OVER (PARTITION BY house_id ORDER BY {_SEVERE_FIRST}) = 1""", "alerts")
_cte("kpi", f"""
  SELECT (SELECT max(batch_id) FROM alerts) AS batch_id,
    (SELECT count(*) FROM now_alerts WHERE alert_status = 'CRITICAL') AS critical,
    (SELECT count(*) FROM now_alerts WHERE alert_status = 'WARNING') AS warning,
    (SELECT {_r('avg(avg_risk_score)')} FROM gov WHERE {_NEWEST_GOV}) AS avg_risk,
    (SELECT count(*) FROM fleet) AS total_houses""", "alerts", "now_alerts", "gov", "fleet")
_cte("ranked", f"""
  SELECT governorate, avg_risk_score, {_r('avg_risk_score')} AS avg_risk, {_r('max_risk_score')} AS max_risk,
    critical_count, warning_count, gov_risk_level AS risk_level
  FROM gov WHERE {_NEWEST_GOV}""", "gov")
_cte("top_gov", "SELECT governorate, avg_risk, risk_level FROM ranked ORDER BY avg_risk_score DESC, governorate LIMIT 1", "ranked")
_cte("feed", f"""
  SELECT house_id, governorate, zone, alert_status, primary_trigger, latitude, longitude, event_id,
    {_r('risk_score')} AS risk_score, {_r('methane_ppm')} AS methane, {_r('temperature_c')} AS temp,
    {_r('smoke_level')} AS smoke, {_r('co_ppm')} AS co, risk_score AS exact_risk FROM now_alerts""", "now_alerts")
_cte("markers", f"""
  SELECT longitude, latitude, alert_status, governorate, zone, house_id, {_r('risk_score')} AS risk_score, risk_score AS exact_risk,
    {_cause()} AS primary_trigger, {_r('methane_ppm')} AS methane, {_r('temperature_c')} AS temp,
    {_r('smoke_level')} AS smoke, {_r('co_ppm')} AS co
  FROM alerts WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND {_NEWEST_ALERTS}
  QUALIFY row_number() OVER (PARTITION BY house_id ORDER BY {_SEVERE_FIRST}) = 1""", "alerts")


def _points(name: str, days: int, limit: int) -> None:
    _cte(name, f"""
  SELECT snapshot_time, {_r('avg(avg_methane_ppm)', 2)} AS value FROM zones
  WHERE snapshot_time >= (SELECT max(snapshot_time) FROM zones) - INTERVAL {days} DAY
  GROUP BY 1 ORDER BY 1 DESC LIMIT {limit}""", "zones")


_points("trend", 7, 50)
_points("trend_short", 3, 5)


def _with(body: str, *needs: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in order of definition."""
    wanted: set[str] = set()
    open_names = list(needs)
    while open_names:
        name = open_names.pop()
        if name not in wanted:
            wanted.add(name)
            open_names.extend(_CTE[name][1])
    ctes = ",\n".join(f"{name} AS ({sql})" for name, (sql, _) in _CTE.items() if name in wanted)
    return f"WITH {ctes}\n{body}"


_SENSORS = "temperature_c, humidity_pct, methane_ppm, lpg_ppm, co_ppm, smoke_level, aqi, co2_ppm, pm25_ugm3, pm10_ugm3"
_RISK_LEVEL = (
    "CASE WHEN risk_score >= 70 THEN 'CRITICAL' WHEN risk_score >= 40 THEN 'HIGH' "
    "WHEN risk_score >= 20 THEN 'MEDIUM' ELSE 'LOW' END"
)
_PARTS = "year(event_time) AS year, month(event_time) AS month, day(event_time) AS day, hour(event_time) AS hour"


def _zone_rows(source: str, where: str = "true") -> str:
    means = ", ".join(f"{_r(c, 4)} AS {c}" for c in (
        "avg_methane_ppm", "avg_temperature_c", "avg_smoke_level", "avg_co_ppm", "avg_aqi", "avg_risk_score"))
    return _with(f"SELECT * REPLACE ({means}, {_ts('snapshot_time')} AS snapshot_time, CAST(batch_id AS BIGINT) AS batch_id) "
                 f"FROM {source} WHERE {where}", source)


def _gov_rows(source: str, where: str = "true") -> str:
    means = ", ".join(f"{_r(c, 4)} AS {c}" for c in ("avg_risk_score", "avg_methane_ppm", "avg_aqi", "avg_temperature_c"))
    return _with(f"SELECT * REPLACE ({means}, {_ts('snapshot_time')} AS snapshot_time, CAST(batch_id AS BIGINT) AS batch_id) "
                 f"FROM {source} WHERE {where}", source)


def _alert_rows(source: str) -> str:
    return _with(f"SELECT * REPLACE ({_ts('alert_time')} AS alert_time) FROM {source}", source)


def _top(status: str, where: str = _NEWEST_ALERTS) -> str:
    return f"""
  SELECT house_id, governorate, zone, alert_status, risk_score, methane_ppm, temperature_c, smoke_level, co_ppm, event_id,
    {_cause()} AS cause
  FROM (SELECT * FROM alerts WHERE alert_status = '{status}' AND {where}
        QUALIFY row_number() OVER (PARTITION BY house_id ORDER BY risk_score DESC, event_id) = 1)
  ORDER BY risk_score DESC, event_id LIMIT 5"""


def _decimal(x: str, precision: int, digits: int) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN CAST(CAST({_r(x, digits)} AS DECIMAL({precision},{digits})) AS DOUBLE) END"


def _report(batch: int | None) -> str:
    """Report lines section by section; the trend always shows the newest snapshots."""
    of_alerts = _NEWEST_ALERTS if batch is None else f"batch_id = {batch}"
    of_gov = _NEWEST_GOV if batch is None else f"batch_id = {batch}"
    houses = "(SELECT count(*) FROM fleet)"
    incident = (
        "'  [' || alert_status || '] ' || house_id || ' | ' || governorate || '/' || zone || ' | Risk=' || "
        f"printf('%.1f', {_r('risk_score')}) || ' | CH4=' || printf('%.1f', {_r('methane_ppm')}) || 'ppm | Temp=' || "
        f"printf('%.1f', {_r('temperature_c')}) || 'C | Smoke=' || printf('%.1f', {_r('smoke_level')}) || ' | CO=' || "
        f"printf('%.1f', {_r('co_ppm')}) || 'ppm | Cause=' || cause"
    )
    sections = []
    for number, status in ((2, "CRITICAL"), (3, "WARNING")):
        sections.append(f"""
  SELECT {number}, CAST(row_number() OVER (ORDER BY risk_score DESC, event_id) AS INT), {incident} FROM top_{status.lower()}
  UNION ALL SELECT {number}, 0, '--- TOP {status} INCIDENTS ---' WHERE EXISTS (FROM top_{status.lower()})""")
    body = f"""
, top_critical AS ({_top('CRITICAL', of_alerts)}), top_warning AS ({_top('WARNING', of_alerts)}),
worst AS (
  SELECT house_id, min(CASE WHEN alert_status = 'CRITICAL' THEN 0 ELSE 1 END) AS rank
  FROM alerts WHERE {of_alerts} GROUP BY 1),
numbers AS (
  SELECT {houses} AS houses, (SELECT count(*) FROM worst WHERE rank = 0) AS critical,
    (SELECT count(*) FROM worst WHERE rank = 1) AS warning,
    (SELECT {_r('avg(avg_risk_score)')} FROM gov WHERE {of_gov}) AS risk),
ends AS (SELECT arg_max(value, snapshot_time) AS newest, arg_min(value, snapshot_time) AS oldest FROM trend_short),
lines(section_no, line_no, line) AS (
  SELECT 1, 0, '=== LIVE SYSTEM SNAPSHOT ==='
  UNION ALL SELECT 1, 1, 'Total monitored houses : ' || houses FROM numbers
  UNION ALL SELECT 1, 2, 'Critical threats       : ' || critical FROM numbers
  UNION ALL SELECT 1, 3, 'Warning signals        : ' || warning FROM numbers
  UNION ALL SELECT 1, 4, 'Average risk score     : ' || printf('%.1f', risk) || ' / 100' FROM numbers
  UNION ALL SELECT 1, 5, 'Normal houses          : ' || (houses - critical - warning) FROM numbers
  UNION ALL {sections[0]}
  UNION ALL {sections[1]}
  UNION ALL SELECT 4, 0, '--- GOVERNORATE RISK RANKING (all, ordered by avg_risk_score DESC) ---'
  UNION ALL SELECT 4, CAST(row_number() OVER (ORDER BY avg_risk_score DESC, governorate) AS INT),
    '  ' || governorate || ': avg_risk=' || printf('%.1f', {_r('avg_risk_score')}) || ' | critical=' || critical_count
    || ' | warning=' || warning_count || ' | level=' || gov_risk_level FROM gov WHERE {of_gov}
  UNION ALL SELECT 5, 0, '--- METHANE TREND (last 3 min, newest first) ---'
  UNION ALL SELECT 5, 1, '  Values: [' ||
    (SELECT string_agg(CAST(value AS VARCHAR), ', ' ORDER BY snapshot_time DESC) FROM trend_short) || ']  |  Direction: ' ||
    CASE WHEN newest > oldest THEN 'RISING' WHEN newest < oldest THEN 'FALLING' ELSE 'STABLE' END FROM ends)
SELECT section_no, line_no, line FROM lines"""
    return _with(body, "alerts", "gov", "fleet", "trend_short")


def _counts(raw: str, cleaned: str, statistics: str) -> str:
    """Rows of every layer per micro-batch."""
    tables = (f"zones{statistics}", f"gov{statistics}", f"alerts{statistics}")
    return _with(f"""SELECT 'bronze' AS layer, ingest_batch AS batch_id, count(*) AS row_count FROM {raw} GROUP BY ALL
            UNION ALL SELECT 'silver', ingest_batch, count(*) FROM {cleaned} GROUP BY ALL
            UNION ALL SELECT 'zone_stats', batch_id, count(*) FROM {tables[0]} GROUP BY ALL
            UNION ALL SELECT 'gov_stats', batch_id, count(*) FROM {tables[1]} GROUP BY ALL
            UNION ALL SELECT 'active_alerts', batch_id, count(*) FROM {tables[2]} GROUP BY ALL""", raw, cleaned, *tables)


_CLOCK = "strftime(snapshot_time, '%H:%M:%S') AS clock"
_FEED = "house_id, governorate, zone, alert_status, primary_trigger, latitude, longitude, risk_score, methane, temp, smoke, co"
_STRUCT = "to_json({'methane': methane, 'temp': temp, 'smoke': smoke, 'co': co})"


def oracle_sql() -> dict[str, str]:
    silver = _with(f"""SELECT event_id, house_id, {_ts('event_time')} AS event_time, {_SENSORS},
            2026 - year_built AS building_age, methane_ppm > 350 OR lpg_ppm > 300 AS gas_leak_flag, {_RISK_LEVEL} AS risk_level,
            ingest_batch FROM mcl""", "mcl")
    payload = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c == "has_gas_connection" else c for c in _PARSED_FIELDS)
    sql = {
        "score_alert_status": _with("SELECT event_id, batch_id, alert_status FROM r", "r"),
        "score_risk": _with("SELECT event_id, risk_profile, risk_score FROM r", "r"),
        "root_cause": _with(f"SELECT event_id, {_cause()} AS cause FROM r WHERE alert_status <> 'NORMAL'", "r"),
        "active_alerts": _alert_rows("alerts"),
        "silver_clean": _with(f"SELECT event_id, house_id, {_ts('event_time')} AS event_time, {_SENSORS} FROM cl", "cl"),
        "silver_features": _with(f"""SELECT event_id, 2026 - year_built AS building_age,
            methane_ppm > 350 OR lpg_ppm > 300 AS gas_leak_flag, temperature_c > 50 AND smoke_level > 50 AS fire_risk_flag,
            aqi > 150 AS pollution_flag, {_RISK_LEVEL} AS risk_level, {_PARTS} FROM cl""", "cl"),
        "zone_stats": _zone_rows("zones"),
        "zone_stats_raw": _zone_rows("zones_dirty"),
        "zone_stats_silver": _zone_rows("zones_clean"),
        "gov_stats": _gov_rows("gov"),
        "gov_stats_raw": _gov_rows("gov_dirty"),
        "latest_snapshot": _gov_rows("gov", _NEWEST_GOV),
        "gold_sql_scan": _with("""SELECT governorate, zone, total_readings, critical_count, zone_risk_level
            FROM zones WHERE batch_id = (SELECT max(batch_id) FROM zones)""", "zones"),
        "dedup_alerts": _with(f"""SELECT batch_id, house_id, event_id, alert_status, risk_score FROM alerts
            QUALIFY row_number() OVER (PARTITION BY batch_id, house_id ORDER BY {_SEVERE_FIRST}) = 1""", "alerts"),
        "kpis": _with("SELECT * FROM kpi", "kpi"),
        "count_critical": _with("SELECT count(*) AS value FROM now_alerts WHERE alert_status = 'CRITICAL'", "now_alerts"),
        "count_warning": _with("SELECT count(*) AS value FROM now_alerts WHERE alert_status = 'WARNING'", "now_alerts"),
        "avg_risk_decimal": _with(f"SELECT {_decimal('avg(avg_risk_score)', 5, 1)} AS value FROM gov WHERE {_NEWEST_GOV}", "gov"),
        "risk_by_gov": _with("SELECT * EXCLUDE (avg_risk_score) FROM ranked", "ranked"),
        "gov_ranking": _with("SELECT * EXCLUDE (avg_risk_score, max_risk) FROM ranked", "ranked"),
        "gov_ranking_dedup": _with("""SELECT k.governorate, k.avg_risk, k.risk_level,
              (SELECT count(*) FROM now_alerts a WHERE a.governorate = k.governorate AND alert_status = 'CRITICAL') AS critical_count,
              (SELECT count(*) FROM now_alerts a WHERE a.governorate = k.governorate AND alert_status = 'WARNING') AS warning_count
            FROM ranked k""", "ranked", "now_alerts"),
        "gov_risk_band": _with("""SELECT governorate, avg_risk,
            CASE WHEN avg_risk >= 12 THEN 'RED' WHEN avg_risk >= 8 THEN 'ORANGE' ELSE 'GREEN' END AS band FROM ranked""", "ranked"),
        "top_governorate": _with("SELECT * FROM top_gov", "top_gov"),
        "map_markers": _with("SELECT * EXCLUDE (exact_risk) FROM markers", "markers"),
        "map_markers_nested": _with(f"""SELECT CAST(to_json([longitude, latitude]) AS VARCHAR) AS coordinates, risk_score, alert_status,
            governorate, zone, house_id, primary_trigger, CAST({_STRUCT} AS VARCHAR) AS sensors FROM markers""", "markers"),
        "map_severity": _with("""SELECT latitude, longitude, exact_risk AS risk_score, alert_status, governorate, zone,
            CASE alert_status WHEN 'CRITICAL' THEN 100 WHEN 'WARNING' THEN 50 ELSE 0 END AS severity_level FROM markers""", "markers"),
        "alert_feed": _with(f"SELECT {_FEED} FROM feed", "feed"),
        "alert_feed_nested": _with(f"""SELECT house_id, governorate, zone, alert_status, risk_score, primary_trigger, latitude,
            longitude, CAST({_STRUCT} AS VARCHAR) AS sensors FROM feed""", "feed"),
        "alerts_by_selected_gov": _with(f"""SELECT {_FEED}, count(*) OVER () AS events FROM feed WHERE governorate =
            (SELECT governorate FROM now_alerts ORDER BY {_SEVERE_FIRST} LIMIT 1)""", "feed", "now_alerts"),
        "alerts_table_top20": _with(f"""SELECT house_id, governorate, zone, alert_status, {_decimal('risk_score', 5, 1)} AS risk_score,
            {_decimal('methane_ppm', 7, 1)} AS methane_ppm, {_decimal('temperature_c', 5, 1)} AS temperature_c
            FROM (SELECT * FROM now_alerts ORDER BY {_SEVERE_FIRST} LIMIT 20)""", "now_alerts"),
        "top5_critical": _with(_top("CRITICAL"), "alerts"),
        "top5_warning": _with(_top("WARNING"), "alerts"),
        "trigger_sensor": _with("""SELECT house_id, primary_trigger,
            CASE primary_trigger WHEN 'GAS_LEAK' THEN 'methane' WHEN 'HIGH_TEMP' THEN 'temperature' WHEN 'SMOKE_SPIKE' THEN 'smoke' END
              AS trigger_sensor,
            CASE primary_trigger WHEN 'GAS_LEAK' THEN methane WHEN 'HIGH_TEMP' THEN temp WHEN 'SMOKE_SPIKE' THEN smoke END AS trigger_value,
            CASE WHEN primary_trigger <> 'ELEVATED_RISK' THEN alert_status END AS highlight FROM feed""", "feed"),
        "methane_trend": _with(f"SELECT {_ts('snapshot_time')} AS snapshot_time, {_CLOCK}, value FROM trend", "trend"),
        "methane_trend_short": _with(f"SELECT {_ts('snapshot_time')} AS snapshot_time, {_CLOCK}, value FROM trend_short", "trend_short"),
        "methane_trend_clean": _with(f"""SELECT {_ts('snapshot_time')} AS snapshot_time, {_CLOCK},
            CASE WHEN value > 0 AND value < 2000 THEN value ELSE 0e0 END AS value FROM trend""", "trend"),
        "methane_direction": _with("""SELECT latest, before, CASE WHEN latest > before THEN '↑' WHEN latest < before THEN '↓' ELSE '→' END AS arrow,
              CASE WHEN latest >= 150 THEN 'CRITICAL' WHEN latest >= 50 THEN 'WARNING' ELSE 'NORMAL' END AS band, newest, oldest,
              CASE WHEN newest > oldest THEN 'RISING' WHEN newest < oldest THEN 'FALLING' ELSE 'STABLE' END AS direction
            FROM (SELECT value AS latest, coalesce(lead(value) OVER (ORDER BY snapshot_time DESC), 0) AS before
                  FROM trend ORDER BY snapshot_time DESC LIMIT 1),
                 (SELECT arg_max(value, snapshot_time) AS newest, arg_min(value, snapshot_time) AS oldest FROM trend_short)""",
            "trend", "trend_short"),
        "kpi_delta": _with(f"""SELECT batch_id, critical, warning, critical - lag(critical) OVER o AS critical_delta,
              warning - lag(warning) OVER o AS warning_delta
            FROM (SELECT CAST(b.batch_id AS BIGINT) AS batch_id, count(*) FILTER (alert_status = 'CRITICAL') AS critical,
                    count(*) FILTER (alert_status = 'WARNING') AS warning
                  FROM (SELECT DISTINCT batch_id FROM gov) b LEFT JOIN (
                    SELECT batch_id, alert_status FROM alerts
                    QUALIFY row_number() OVER (PARTITION BY batch_id, house_id ORDER BY {_SEVERE_FIRST}) = 1) a
                    ON a.batch_id = b.batch_id GROUP BY 1)
            WINDOW o AS (ORDER BY batch_id)""", "alerts", "gov"),
        "threat_distribution": _with(f"""SELECT state, houses, {_r('houses * 1e2 / total_houses')} AS share_pct, at_risk_pct FROM (
              SELECT unnest(['Normal', 'Warning', 'Critical']) AS state, total_houses,
                unnest([greatest(total_houses - critical - warning, 0), warning, critical]) AS houses,
                {_r('(critical + warning) * 1e2 / total_houses')} AS at_risk_pct FROM kpi)""", "kpi"),
        "insight_banner": _with("""SELECT CASE WHEN critical > 0 THEN 'CRITICAL' WHEN warning > 5 THEN 'WARNING' ELSE 'STABLE' END AS state,
              CASE WHEN critical > 0 THEN 'CRITICAL: ' || critical || ' nodes at risk. Highest cluster: ' || governorate
                     || ' (avg risk ' || regexp_replace(CAST(t.avg_risk AS VARCHAR), '\\.0$', '') || '). Immediate response required.'
                   WHEN warning > 5 THEN 'WARNING: ' || warning || ' nodes elevated. ' || elevated || ' governorate'
                     || CASE WHEN elevated = 1 THEN '' ELSE 's' END || ' above threshold. Highest: ' || governorate
                     || ' (avg risk ' || regexp_replace(CAST(t.avg_risk AS VARCHAR), '\\.0$', '') || ').'
                   ELSE 'STABLE: All 27 governorates within normal parameters. Avg risk ' || regexp_replace(CAST(k.avg_risk AS VARCHAR), '\\.0$', '')
                     || '/100. Highest: ' || governorate || ' (' || regexp_replace(CAST(t.avg_risk AS VARCHAR), '\\.0$', '') || ').' END AS line, elevated
            FROM kpi k, top_gov t, (SELECT count(*) FILTER (avg_risk >= 8) AS elevated FROM ranked)""", "kpi", "top_gov", "ranked"),
        "live_snapshot": _report(None),
        "snapshot_at_batch": _report(12),
        "batch_summary": _with(f"""SELECT *, {_r('critical * 1e2 / sent')} AS critical_pct, {_r('warning * 1e2 / sent')} AS warning_pct,
              {_r('normal * 1e2 / sent')} AS normal_pct FROM (
                SELECT batch_id, count(*) AS sent, count(*) FILTER (alert_status = 'CRITICAL') AS critical,
                  count(*) FILTER (alert_status = 'WARNING') AS warning, count(*) FILTER (alert_status = 'NORMAL') AS normal,
                  CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM r GROUP BY 1)""", "r"),
        "fleet_profile": _with(f"""SELECT *, {_r('with_gas * 1e2 / houses', 0)} AS with_gas_pct, {_r('high_risk * 1e2 / houses', 0)} AS high_risk_pct
            FROM (SELECT count(*) AS houses, count(DISTINCT governorate) AS governorates, count(DISTINCT zone) AS zones,
                    count(*) FILTER (has_gas_connection) AS with_gas, count(*) FILTER (risk_profile = 'high') AS high_risk FROM fleet)""", "fleet"),
        "active_anomalies_top5": _with("""SELECT batch_id, governorate, zone, house_id, event_id, methane_ppm,
              CAST(row_number() OVER o AS INT) AS place FROM r WHERE is_anomaly = 1
            WINDOW o AS (PARTITION BY batch_id ORDER BY house_id, event_id) QUALIFY row_number() OVER o <= 5""", "r"),
        "geo_clamp": _with("""SELECT event_id, round(greatest(lat_min, least(lat, lat_min + 4e0)), 6) AS clamped_lat,
              round(greatest(lon_min, least(lon, lon_min + 4e0)), 6) AS clamped_lon,
              lat < lat_min OR lat > lat_min + 4e0 OR lon < lon_min OR lon > lon_min + 4e0 AS outside_bounds
            FROM (SELECT r.event_id, lat_min, lon_min,
                    CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN latitude WHEN zone <> 'MACHINERY' THEN length(zone) * 1e-1 + 22e0 ELSE lat_min + 2e0 END AS lat,
                    CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN longitude WHEN zone <> 'MACHINERY' THEN length(zone) * 1e-1 + 25e0 ELSE lon_min + 2e0 END AS lon
                  FROM r JOIN (SELECT n_name, 22e0 + n_nationkey * 2e-1 AS lat_min, 25e0 + n_nationkey * 2e-1 AS lon_min
                               FROM nation) b ON b.n_name = r.governorate)""", "r"),
        "zone_tier": _with("""SELECT event_id, zone, CASE zone WHEN 'MACHINERY' THEN 'high' WHEN 'HOUSEHOLD' THEN 'medium' ELSE 'low' END AS tier
            FROM r""", "r"),
        "parse_readings": _with(f"""SELECT {payload}, {_ts('event_time')} AS event_time, raw_value,
            CAST(eid % 3 AS INT) AS kafka_partition, eid AS kafka_offset FROM m""", "m"),
        "publish_roundtrip": _with(f"SELECT {payload}, {_ts('event_time')} AS event_time, raw_value FROM m", "m"),
        "bronze_partitions": _with(f"SELECT {_PARTS}, count(*) AS row_count FROM d GROUP BY ALL", "d"),
        "partition_pruned_scan": _with(f"""SELECT event_id, house_id, {_ts('event_time')} AS event_time, methane_ppm, hour(event_time) AS hour
            FROM d WHERE event_time >= TIMESTAMP '2024-01-08 06:00:00' AND event_time < TIMESTAMP '2024-01-12 18:30:00'""", "d"),
        "stream_bronze": _with(f"""SELECT event_id, house_id, {_ts('event_time')} AS event_time, methane_ppm, raw_value,
            ingest_batch, {_PARTS} FROM m""", "m"),
        "stream_silver": silver,
        "stream_silver_chained": silver,
        "stream_gold_zone": _zone_rows("zones_stream"),
        "stream_gold_gov": _gov_rows("gov_stream"),
        "stream_gold_alerts": _alert_rows("alerts_stream"),
        "stream_restart": _with("""SELECT ingest_batch, count(event_id) AS readings, count(DISTINCT event_id) AS distinct_readings,
            count(*) AS row_count FROM m GROUP BY 1""", "m"),
        "stream_stamps": _with("""SELECT ingest_batch, 'bronze' AS layer, count(*) AS row_count, count(*) AS stamped, 1 AS stamps FROM m GROUP BY 1
            UNION ALL SELECT ingest_batch, 'silver', count(*), count(*), 1 FROM mcl GROUP BY 1""", "m", "mcl"),
        "layer_counts": _counts("m", "mcl", "_stream"),
        "stream_paced": _counts("pm", "pmcl", "_paced"),
        "house_alerts": _with(f"""SELECT batch_id, house_id, event_id, alert_status, {_cause()} AS primary_trigger, first_of_house, first_of_status,
              first_placed, first_on_latitude
            FROM (SELECT *,
              row_number() OVER (PARTITION BY batch_id, house_id ORDER BY {_SEVERE_FIRST}) = 1 AS first_of_house,
              row_number() OVER (PARTITION BY batch_id, house_id, alert_status ORDER BY {_SEVERE_FIRST}) = 1 AS first_of_status,
              placed AND row_number() OVER (PARTITION BY batch_id, house_id, placed ORDER BY {_SEVERE_FIRST}) = 1 AS first_placed,
              latitude IS NOT NULL AND row_number() OVER (PARTITION BY batch_id, house_id, latitude IS NULL ORDER BY {_SEVERE_FIRST}) = 1 AS first_on_latitude
              FROM (SELECT *, latitude IS NOT NULL AND longitude IS NOT NULL AS placed FROM alerts))
            WHERE first_of_house OR first_of_status OR first_placed OR first_on_latitude""", "alerts"),
        "rejected_rows": _with(f"""SELECT 'silver' AS table_name, event_id, house_id, {_ts('event_time')} AS event_time, reasons,
              house_id IS NULL OR event_time IS NULL AS dropped, CAST(0 AS BIGINT) AS batch_id
            FROM (SELECT *, concat_ws('; ', CASE WHEN house_id IS NULL THEN 'house_id: missing' END,
              CASE WHEN event_time IS NULL THEN 'event_time: missing' END,
              CASE WHEN temperature_c < -10 OR temperature_c > 65 THEN 'temperature_c: not in -10 to 65' END,
              CASE WHEN humidity_pct < 0 OR humidity_pct > 100 THEN 'humidity_pct: not in 0 to 100' END,
              CASE WHEN aqi < 0 OR aqi > 500 THEN 'aqi: not in 0 to 500' END,
              CASE WHEN methane_ppm < 0 THEN 'methane_ppm: below 0' END) AS reasons FROM d)
            WHERE reasons <> ''""", "d"),
    }
    return sql
