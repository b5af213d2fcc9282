"""DuckDB SQL for every registered query, over the same tables.

The SQL states each result anew (windows by row expansion, joins instead of lookups). Only fixture
expressions and the fixed rule tables are shared with the Spark side.
"""

from __future__ import annotations

from acceptance import testbed as T
from wardlens.functions import rules as R


def _exprs(expressions: dict[str, str]) -> str:
    return ",\n  ".join(f"{text} AS {name}" for name, text in expressions.items())


def _round(value: str, digits: int) -> str:
    """Half-up rounding of a double as it prints, which is how Spark rounds doubles.

    DuckDB's own ``round`` scales the double first, so 30.049999999999997 becomes 30.1, not 30.0.
    """
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


def _labels(column: str, rules: list[tuple[str, str]], default: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{v}'" for p, v in rules)
    return f"CASE {cases} ELSE '{default}' END"


def _codes(column: str, codes: dict[str, str], default: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items())
    return f"CASE {column} {cases} ELSE '{default}' END"


def _steps(column: str, bounds: list[float], labels: list[str], op: str) -> str:
    cases = " ".join(f"WHEN {column} {op} {b} THEN '{v}'" for b, v in zip(bounds, labels))
    return f"CASE {cases} ELSE '{labels[-1]}' END"


INCIDENTS = f"""orders_at AS (
  SELECT o_orderkey, n_nationkey, n_name, {T.DATE} AS occurred
  FROM (SELECT o_orderkey, {T.AREA} AS area_key, {T.BASE_DATE} AS base_date
        FROM orders JOIN customer ON o_custkey = c_custkey)
  JOIN nation ON area_key = n_nationkey),
rows_at AS (
  SELECT {_exprs(T.INCIDENT)}
  FROM lineitem JOIN orders_at ON l_orderkey = o_orderkey),
incidents AS (
  SELECT *, CAST(year(date_occured) AS INT) AS occurrence_year,
    CAST(year(date_reported) AS INT) AS report_year,
    CASE WHEN regexp_matches(status, '{R.CLOSED_STATUS_PATTERN}') THEN 'Closed'
      WHEN status = 'IC' THEN 'Ongoing' ELSE 'Unknown' END AS status_resolution,
    CAST(date_reported - date_occured AS INT) AS reporting_lag_days
  FROM rows_at)"""

SPEED = """CASE WHEN reporting_lag_days = 0 THEN 'Same Day' WHEN reporting_lag_days <= 1 THEN 'Next Day'
 WHEN reporting_lag_days <= 7 THEN 'Within Week' WHEN reporting_lag_days <= 30 THEN 'Within Month'
 WHEN reporting_lag_days > 30 THEN 'Delayed' ELSE 'Unknown' END"""

SCORE = """(crime_density_percentile / 100 * CAST(0.4 AS DOUBLE)
 + (100 - resolution_rate) / 100 * CAST(0.3 AS DOUBLE)
 + CAST(CASE crime_trend WHEN 'Increasing' THEN 0.3 WHEN 'Decreasing' THEN 0.1 ELSE 0.2 END AS DOUBLE)
 ) * 100"""

METRICS = INCIDENTS + f""",
areas AS (
  SELECT *, {_steps("crime_density_percentile", R.CRIME_DENSITY_BOUNDS, R.CRIME_DENSITY_LABELS, "<")}
    AS crime_density_category
  FROM (SELECT area_id, min(area_name) AS area_name, count(*) AS total_cases,
          count(*) FILTER (status_resolution = 'Closed') AS resolved_cases,
          {_round("count(*) FILTER (status_resolution = 'Closed') / count(*) * 100", 2)} AS resolution_rate,
          percent_rank() OVER (ORDER BY count(*)) * 100 AS crime_density_percentile
        FROM incidents GROUP BY area_id)),
tiers AS (
  SELECT *, {_steps("resolution_rate", R.TIER_BOUNDS, R.TIER_LABELS, "<")} AS area_performance_tier
  FROM areas),
years AS (
  SELECT *, {_round("(yearly_crime_count - prev_year_count) / prev_year_count * 100", 2)}
    AS yoy_crime_change_pct
  FROM (SELECT area_id, min(area_name) AS area_name, occurrence_year, count(*) AS yearly_crime_count,
          lag(count(*)) OVER (PARTITION BY area_id ORDER BY occurrence_year) AS prev_year_count
        FROM incidents GROUP BY area_id, occurrence_year)),
trends AS (
  SELECT *, CASE WHEN yoy_crime_change_pct > 10 THEN 'Increasing'
      WHEN yoy_crime_change_pct < -10 THEN 'Decreasing'
      WHEN yoy_crime_change_pct IS NOT NULL THEN 'Stable' ELSE 'Unknown' END AS crime_trend
  FROM years),
scores AS (
  SELECT trends.*, resolution_rate, area_performance_tier, crime_density_percentile,
    crime_density_category,
    {_round(SCORE, 1)} AS area_risk_score
  FROM trends JOIN tiers USING (area_id)),
risks AS (
  SELECT *, {_steps("area_risk_score", R.RISK_BOUNDS, R.RISK_LABELS, "<")} AS area_risk_level
  FROM scores),
lookup AS (
  SELECT upper(t.area_name) AS area_key, area_performance_tier, crime_density_category,
    resolution_rate, crime_density_percentile, latest.area_risk_level,
    5 + crime_density_percentile / 100 * 10 AS historical_avg_minutes
  FROM tiers t JOIN (SELECT area_id, arg_max(area_risk_level, occurrence_year) AS area_risk_level
                     FROM risks GROUP BY area_id) latest USING (area_id))"""

CALLS = f"""calls AS (
  SELECT {_exprs(T.CALL | T.DUCKDB_CALL)} FROM events)"""

CATEGORY = _labels("crime_description", R.CATEGORY_RULES, R.CATEGORY_DEFAULT)
CATEGORIZED = INCIDENTS + f""",
categorized AS (SELECT *, {CATEGORY} AS crime_category FROM incidents)"""

QUALITY = INCIDENTS + f""",
ages AS (SELECT *, CASE WHEN victim_age BETWEEN 0 AND 120 THEN victim_age END AS victim_age_clean
         FROM incidents),
flags AS (
  SELECT *,
    victim_age_clean IS NOT NULL AND victim_sex IS NOT NULL AND victim_descent IS NOT NULL
      AS has_victim_info,
    lat IS NOT NULL AND lon IS NOT NULL AND street_address IS NOT NULL AS has_location_info,
    weapon_description IS NOT NULL AS has_weapon_info,
    premise_description IS NOT NULL AS has_premise_info
  FROM ages),
quality AS (
  SELECT *, (has_victim_info::INT + has_location_info::INT + has_weapon_info::INT
             + has_premise_info::INT) / 4 AS data_completeness_score
  FROM flags)"""

KM = """sqrt(pow((lat - CAST(34.0522 AS DOUBLE)) * 111, 2)
 + pow((lon - CAST(-118.2437 AS DOUBLE)) * 111 * CAST(0.8 AS DOUBLE), 2))"""

LOCATED = INCIDENTS + f""",
valid AS (
  SELECT *, coalesce(lat <> 0 AND lon <> 0 AND lat BETWEEN CAST(33.7 AS DOUBLE) AND CAST(34.4 AS DOUBLE)
    AND lon BETWEEN CAST(-118.9 AS DOUBLE) AND CAST(-117.6 AS DOUBLE), false) AS has_valid_coordinates
  FROM incidents),
located AS (
  SELECT *, CASE WHEN has_valid_coordinates THEN {_round(KM, 2)} END AS distance_from_center_km
  FROM valid),
zoned AS (
  SELECT *, CASE WHEN distance_from_center_km <= 8 THEN 'Downtown Core'
      WHEN distance_from_center_km <= 24 THEN 'Inner City'
      WHEN distance_from_center_km <= 48 THEN 'Greater LA'
      WHEN distance_from_center_km > 48 THEN 'Outer Areas' ELSE 'Unknown' END AS geographic_zone
  FROM located)"""


def _address(ave: bool) -> str:
    text = r"regexp_replace(trim(regexp_replace(street_address, '\s+', ' ', 'g')), '\bST\b', 'STREET', 'g')"
    if ave:
        text = rf"regexp_replace({text}, '\bAVE\b', 'AVENUE', 'g')"
    return f"upper({text})"


def _floor(minutes: int) -> str:
    """Start (epoch ms) of the tumbling window that holds ``ts``."""
    return f"epoch_ms(time_bucket(INTERVAL '{minutes} minutes', ts))"


def _hops(size: int, slide: int, where: str) -> str:
    """Calls, once per hopping window that holds them."""
    return f"""(SELECT *, CAST({_floor(slide)} - {slide * 60000} * k AS BIGINT) AS window_start
  FROM calls, range({size // slide}) r(k) WHERE area_name IS NOT NULL AND {where})"""


RESPONSES = f"""SELECT area_name, window_start, avg(response_time_minutes) AS live_avg_minutes
  FROM {_hops(30, 5, "is_dispatched AND response_time_minutes > 0")}
  GROUP BY area_name, window_start"""

DISPATCHES = f"""SELECT area_name, window_start,
    count(*) FILTER (NOT coalesce(is_dispatched, false)) AS failure_count, count(*) AS total_calls,
    count(*) FILTER (NOT coalesce(is_dispatched, false)) / count(*) AS failure_rate
  FROM {_hops(15, 5, "true")} GROUP BY area_name, window_start"""

UNITS = f"""SELECT area_name, CAST({_floor(15)} AS BIGINT) AS window_start,
    count(*) FILTER (starts_with(upper(unit), 'LAPD')) AS lapd_units,
    count(*) FILTER (starts_with(upper(unit), 'LAFD')) AS lafd_units,
    count(*) FILTER (starts_with(upper(unit), 'EMS')) AS ems_units
  FROM (SELECT area_name, ts, unnest(units_dispatched) AS unit FROM calls
        WHERE is_dispatched AND area_name IS NOT NULL)
  WHERE unit IS NOT NULL GROUP BY ALL"""

SPIKES = f"""SELECT area_name, window_start, window_start + 300000 AS window_end, call_count,
    background_count / 12 AS baseline, call_count / (background_count / 12) AS spike_ratio
  FROM (SELECT area_name, slot AS window_start, n AS call_count,
          CAST(sum(n) OVER (PARTITION BY area_name ORDER BY slot
            RANGE BETWEEN 3300000 PRECEDING AND CURRENT ROW) AS BIGINT) AS background_count
        FROM (SELECT area_name, CAST({_floor(5)} AS BIGINT) AS slot, count(*) AS n
              FROM calls WHERE area_name IS NOT NULL GROUP BY ALL))
  WHERE call_count > 2 * (background_count / 12)
    AND window_start >= epoch_ms(TIMESTAMP '2024-01-01 01:00:00')"""

DEGRADED = f"""SELECT area_name, window_start, live_avg_minutes,
    coalesce(historical_avg_minutes, 8.5) AS historical_avg_minutes,
    live_avg_minutes / coalesce(historical_avg_minutes, 8.5) AS degradation_ratio
  FROM ({RESPONSES}) LEFT JOIN lookup ON upper(area_name) = area_key
  WHERE live_avg_minutes > CAST(1.5 AS DOUBLE) * coalesce(historical_avg_minutes, 8.5)"""

FAILED = f"""SELECT area_name, window_start, failure_count, total_calls, failure_rate, area_risk_level
  FROM ({DISPATCHES}) JOIN lookup ON upper(area_name) = area_key
  WHERE failure_rate > CAST(0.3 AS DOUBLE) AND area_risk_level IN ('High Risk', 'Medium Risk')"""

ENRICHED = "calls LEFT JOIN lookup ON upper(area_name) = area_key"

ESCALATED = f"""SELECT call_id, priority AS original_priority,
    CAST(priority - 1 AS INT) AS escalated_priority, incident_type, area_name, area_risk_level,
    'High risk area + violent incident type' AS escalation_reason
  FROM {ENRICHED}
  WHERE priority >= 3 AND area_risk_level = 'High Risk'
    AND upper(incident_type) IN ('ASSAULT', 'ROBBERY', 'WEAPON VIOLATION')"""

PARSED = """SELECT call_id, call_type, incident_type, priority, address, area_name,
    latitude, longitude, phone_number, is_anonymous,
    is_dispatched, response_time_minutes, status,
    epoch_us(ts) AS ts_micros, array_to_string(units_dispatched, ',') AS units FROM calls"""

# Event time that closes windows: Spark keeps watermarks in whole milliseconds.
CLOSED = "(SELECT epoch_ms(max(ts)) FROM calls)"


def _windowed(body: str) -> str:
    return f"SELECT area_name || '_' || window_start AS result_key, * FROM ({body})"


UNIT_TABLE = f"""SELECT *, (lapd_units + lafd_units + ems_units) / 50 * 100 AS utilization_pct
  FROM ({UNITS})"""


def _counts(source: str, *keys: str) -> str:
    return f"SELECT {', '.join(keys)}, count(*) AS n FROM {source} GROUP BY ALL"


def _shares(column: str, default: str) -> str:
    return f"""SELECT *, {_round("count / sum(count) OVER () * 100", 1)} AS pct
  FROM (SELECT coalesce({column}, {default}) AS {column}, count(*) AS count FROM calls GROUP BY 1)"""


# Faults of call documents; a document that is cut off has no other.
REJECTED = f"""SELECT event_id, 'document is not JSON' AS reason FROM events WHERE {T.FAULTS["cut_off"]}
  UNION ALL SELECT event_id, reason FROM (
    SELECT event_id, unnest([
      CASE WHEN {T.FAULTS["unknown_type"]} THEN 'call_type has an unknown value' END,
      CASE WHEN incident_type IS NULL THEN 'incident_type is missing' END,
      CASE WHEN {T.FAULTS["quoted_priority"]} THEN 'priority is no integer'
        WHEN {T.FAULTS["bad_priority"]} THEN 'priority is out of range' END,
      CASE WHEN {T.FAULTS["no_area_point"]} THEN 'location.latitude is missing' END]) AS reason
    FROM (SELECT CAST(call_id AS BIGINT) AS event_id, incident_type FROM calls)
    WHERE NOT ({T.FAULTS["cut_off"]}))
  WHERE reason IS NOT NULL"""

# Calls out of order, with the micro-batch that brings them and their area's clock before it.
OUT_OF_ORDER = f"""sliced AS (
  SELECT event_id, user_id, {T.PART.format(div="//")} AS arrived_in
  FROM (SELECT event_id, user_id, epoch_us(ts) AS micros, min(epoch_us(ts)) OVER () AS low, max(epoch_us(ts)) OVER () AS high
        FROM events)),
moved AS (
  SELECT call_id, area_name, CAST(arrived_in AS INT) AS arrived_in,
    ts + CASE WHEN {T.AHEAD} THEN INTERVAL 3 HOURS ELSE INTERVAL 0 HOURS END
       - CASE WHEN {T.BEHIND} THEN INTERVAL 2 HOURS ELSE INTERVAL 0 HOURS END AS ts
  FROM calls JOIN sliced ON call_id = CAST(event_id AS VARCHAR)),
clocks AS (SELECT area_name, arrived_in, max(ts) AS clock FROM moved GROUP BY ALL),
timed AS (
  SELECT moved.*, coalesce(time_bucket(INTERVAL '5 minutes', ts) + INTERVAL 5 MINUTES <= (
      SELECT max(clock) FROM clocks WHERE clocks.area_name = moved.area_name AND clocks.arrived_in < moved.arrived_in),
    false) AS is_late
  FROM moved)"""

_TYPES = _shares("incident_type", "'UNKNOWN'")

_SQL = {
    "incidents_by_year": (INCIDENTS, """SELECT occurrence_year AS year, count(*) AS count
        FROM incidents GROUP BY 1 ORDER BY 1"""),
    "resolution_by_area": (METRICS, """SELECT area_id, area_name, total_cases, resolved_cases,
        resolution_rate, area_performance_tier FROM tiers"""),
    "density_percentile": (METRICS, """SELECT area_id, total_cases,
        crime_density_percentile, crime_density_category
        FROM areas"""),
    "yoy_trends": (METRICS, """SELECT area_id, area_name, occurrence_year, yearly_crime_count,
        prev_year_count, yoy_crime_change_pct, crime_trend FROM trends"""),
    "area_risk": (METRICS, """SELECT area_id, area_name, occurrence_year, yearly_crime_count,
        yoy_crime_change_pct, crime_trend, area_risk_score, area_risk_level FROM risks"""),
    "area_summary": (METRICS, """SELECT area_id, area_name, resolution_rate, area_performance_tier,
        crime_density_percentile, crime_density_category
        FROM tiers"""),
    "enriched_incidents": (METRICS, f"""SELECT id, area_id, incidents.area_name, occurrence_year,
        resolution_rate, area_performance_tier,
        crime_density_percentile, crime_density_category,
        reporting_lag_days, {SPEED} AS reporting_speed, yearly_crime_count, yoy_crime_change_pct,
        crime_trend, area_risk_score, area_risk_level
        FROM incidents LEFT JOIN risks USING (area_id, occurrence_year)"""),
    "reporting_lag": (INCIDENTS, f"""SELECT area_name,
        {_round("avg(reporting_lag_days)", 1)} AS avg_lag_days,
        {_round("count(*) FILTER (reporting_lag_days > 30) / count(*) * 100", 1)} AS pct_delayed,
        count(*) AS total_records
        FROM incidents WHERE reporting_lag_days BETWEEN 0 AND 365 GROUP BY area_name"""),
    "reporting_speed_share": (INCIDENTS, f"""SELECT *, {_round("count / sum(count) OVER () * 100", 1)} AS pct
        FROM (SELECT {SPEED} AS reporting_speed, count(*) AS count FROM incidents GROUP BY 1)"""),
    "status_resolution": (INCIDENTS, _counts("incidents", "status", "status_resolution")),
    "raw_csv_cleaned": (INCIDENTS, """SELECT id, area_id, area_name,
        CAST(date_reported AS VARCHAR) AS date_reported, CAST(date_occured AS VARCHAR) AS date_occured,
        time_occured, crime_description, victim_age, victim_sex, street_address, lat, lon,
        occurrence_year, report_year, status_resolution FROM incidents"""),
    "batch_gold": (METRICS, " UNION ALL ".join(
        [f"SELECT '{name}' AS collection, count(*) AS n, CAST(sum(id) AS BIGINT) AS total FROM incidents" for name in (
            "gold_business_metrics", "gold_crime_categorization", "gold_categorical_standardization", "gold_data_quality",
            "gold_geographic_enrichment", "gold_time_dimensions")]
        + ["SELECT 'gold_bm_area_summary', count(*), CAST(sum(area_id) AS BIGINT) FROM tiers",
           "SELECT 'gold_bm_yoy_crime_trends', count(*), CAST(sum(yearly_crime_count) AS BIGINT) FROM risks",
           "SELECT 'gold_bm_reporting_lag', count(DISTINCT area_name), count(*) FROM incidents WHERE reporting_lag_days BETWEEN 0 AND 365",
           f"SELECT 'gold_bm_reporting_speed', count(DISTINCT speed), count(*) FROM (SELECT {SPEED} AS speed FROM incidents)",
           "SELECT 'gold_crime_count_by_year', count(DISTINCT occurrence_year), count(*) FROM incidents"])),
    "published_trends": (METRICS, """SELECT area_id, area_name, occurrence_year, yearly_crime_count,
        yoy_crime_change_pct, crime_trend, area_risk_score, area_risk_level, true AS indexed_at FROM risks"""),
    "raw_csv_headers": (INCIDENTS, " UNION ALL ".join(
        f"""SELECT '{','.join(names)}' AS header, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids,
        {"count(status)" if "Status" in names else "0::BIGINT"} AS statuses
        FROM incidents WHERE id % {len(T.RAW_LAYOUTS)} = {k}""" for k, names in enumerate(T.RAW_LAYOUTS))),
    "crime_category_counts": (CATEGORIZED, _counts("categorized", "crime_description",
                                                   "crime_category")),
    "crime_severity_counts": (CATEGORIZED, _counts(
        "categorized", "crime_category",
        _labels("crime_category", R.SEVERITY_RULES, R.SEVERITY_DEFAULT) + " AS crime_severity")),
    "crime_flags": (CATEGORIZED, _counts(
        "categorized", "crime_description", "premise_description",
        f"""coalesce(regexp_matches(crime_description, '{R.DOMESTIC_PATTERN}')
          OR regexp_matches(premise_description, '{R.DWELLING_PATTERN}'), false)
          AS is_domestic_violence""",
        f"regexp_matches(crime_category, '{R.VIOLENT_PATTERN}') AS is_violent_crime",
        f"regexp_matches(crime_category, '{R.PROPERTY_PATTERN}') AS is_property_crime")),
    "victim_sex_counts": (INCIDENTS, _counts(
        "incidents", "victim_sex",
        _codes("upper(trim(victim_sex))", R.SEX_CODES, R.UNKNOWN) + " AS victim_sex_clean")),
    "victim_descent_counts": (INCIDENTS, _counts(
        "incidents", "victim_descent",
        _codes("victim_descent", R.DESCENT_CODES, R.UNKNOWN) + " AS victim_descent_clean")),
    "weapon_category_counts": (INCIDENTS, _counts(
        "incidents", "weapon_description",
        f"""CASE WHEN weapon_description IS NULL THEN 'Unknown'
          ELSE {_labels("weapon_description", R.WEAPON_RULES, "Other")} END AS weapon_category""")),
    "age_groups": (QUALITY, _counts(
        "ages", "victim_age", "victim_age_clean",
        f"""CASE WHEN victim_age_clean IS NULL THEN 'Unknown'
          ELSE {_steps("victim_age_clean", R.AGE_BOUNDS, R.AGE_LABELS, "<")} END AS victim_age_group""")),
    "address_standardized": (INCIDENTS, f"""SELECT id, {_address(True)} AS street_address_standardized,
        {_address(False)} AS street_address_clean FROM incidents"""),
    "quality_scores": (QUALITY, _counts(
        "quality", "has_victim_info", "has_location_info", "has_weapon_info", "has_premise_info",
        "data_completeness_score",
        _steps("data_completeness_score", R.QUALITY_BOUNDS, R.QUALITY_LABELS, "<")
        + " AS data_quality_flag")),
    "data_issues": (INCIDENTS, _counts(
        "incidents", "area_id", """coalesce(date_occured > date_reported OR victim_age < 0
          OR victim_age > 120 OR (lat = 0 AND lon = 0), false) AS has_data_issues""")),
    "valid_coordinates": (LOCATED, _counts("valid", "area_id", "has_valid_coordinates")),
    "geo_zones": (LOCATED, "SELECT id, distance_from_center_km, geographic_zone FROM zoned"),
    "geo_points": (LOCATED, """SELECT id, CASE WHEN has_valid_coordinates THEN lat END AS location_lat,
        CASE WHEN has_valid_coordinates THEN lon END AS location_lon FROM valid"""),
    "area_density": (LOCATED, f"""SELECT id, area_id,
        {_steps("crime_count", R.DENSITY_BOUNDS, R.DENSITY_LABELS, "<")} AS area_density_category,
        geographic_zone
        FROM zoned JOIN (SELECT area_id, count(*) AS crime_count FROM incidents GROUP BY 1)
          USING (area_id)"""),
    "time_dimensions": (INCIDENTS, """SELECT id,
        CASE WHEN hour < 24 THEN strftime(date_occured, '%Y-%m-%d') || ' '
          || lpad(CAST(hour AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute AS VARCHAR), 2, '0')
          || ':00' END AS datetime_occurred,
        occurrence_year, CAST(month(date_occured) AS INT) AS occurrence_month,
        CAST(day(date_occured) AS INT) AS occurrence_day,
        CASE WHEN hour < 24 THEN hour END AS occurrence_hour,
        CASE WHEN hour BETWEEN 6 AND 11 THEN 'Morning' WHEN hour BETWEEN 12 AND 17 THEN 'Afternoon'
          WHEN hour BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Night' END AS time_of_day,
        dayname(date_occured) AS day_of_week,
        CAST(dayofweek(date_occured) + 1 AS INT) AS day_of_week_num,
        dayofweek(date_occured) IN (0, 6) AS is_weekend,
        CASE WHEN month(date_occured) IN (12, 1, 2) THEN 'Winter'
          WHEN month(date_occured) IN (3, 4, 5) THEN 'Spring'
          WHEN month(date_occured) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
        FROM (SELECT *, CAST(time_occured // 100 AS INT) AS hour,
                CAST(time_occured % 100 AS INT) AS minute FROM incidents)"""),
    "area_stats": (METRICS, """SELECT area_key, area_performance_tier, crime_density_category,
        resolution_rate, crime_density_percentile,
        area_risk_level, historical_avg_minutes FROM lookup"""),
    "calls_parsed": (CALLS, PARSED),
    "calls_rejected": (CALLS, REJECTED),
    "calls_accepted": (CALLS, f"""SELECT * FROM ({PARSED}) WHERE CAST(call_id AS BIGINT) NOT IN
        (SELECT event_id FROM ({REJECTED}))"""),
    "props_parsed": (None, """SELECT event_type, count(*) AS n,
        CAST(sum(CAST(json_extract(props, '$.k') AS INT)) AS BIGINT) AS k_sum,
        count(*) FILTER (NOT json_valid(props)) AS corrupt
        FROM events GROUP BY 1"""),
    "calls_enriched": (f"{METRICS},\n{CALLS}", f"""SELECT call_id, area_name, area_risk_level,
        area_performance_tier, crime_density_category, resolution_rate FROM {ENRICHED}"""),
    "escalated_calls": (f"{METRICS},\n{CALLS}", ESCALATED),
    "spike_detection": (CALLS, SPIKES),
    "response_degradation": (f"{METRICS},\n{CALLS}", DEGRADED),
    "unit_utilization": (CALLS, _windowed(UNIT_TABLE)),
    "dispatch_failures": (f"{METRICS},\n{CALLS}", FAILED),
    "call_priority_stats": (CALLS, _shares("priority", "5")),
    "incident_type_stats": (CALLS, _TYPES),
    "top_incident_types": (CALLS, f"{_TYPES} ORDER BY count DESC, incident_type LIMIT 5"),
    "calls_flat": (CALLS, """SELECT call_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
        call_type, incident_type, priority, address, area_name, latitude,
        longitude, status, is_dispatched,
        CAST(len(units_dispatched) AS INT) AS units_count,
        response_time_minutes AS response_time FROM calls"""),
    "high_priority_calls": (CALLS, """SELECT call_id, incident_type, area_name, priority FROM calls
        WHERE priority <= 2"""),
    "daily_call_csv": (CALLS, """SELECT strftime(ts, '%Y%m%d') AS call_date, status, count(*) AS n,
        CAST(sum(len(units_dispatched)) AS BIGINT) AS units FROM calls GROUP BY 1, 2"""),
    "stream_calls": (CALLS, PARSED),
    "stream_calls_enriched": (f"{METRICS},\n{CALLS}", f"""SELECT call_id, area_name, area_risk_level,
        resolution_rate FROM {ENRICHED}"""),
    "stream_escalated_calls": (f"{METRICS},\n{CALLS}", ESCALATED),
    "stream_area_spikes": (CALLS, _windowed(
        f"SELECT * FROM ({SPIKES}) WHERE window_end <= {CLOSED}")),
    "stream_spikes_updated": (CALLS, _windowed(SPIKES)),
    "stream_response_windows": (CALLS, _windowed(RESPONSES)),
    "stream_response_degradation": (f"{METRICS},\n{CALLS}", _windowed(DEGRADED)),
    "stream_unit_utilization": (CALLS, _windowed(UNIT_TABLE)),
    "stream_dispatch_windows": (CALLS, _windowed(DISPATCHES)),
    "stream_dispatch_failures": (f"{METRICS},\n{CALLS}", _windowed(
        f"SELECT * FROM ({FAILED}) WHERE window_start + 900000 <= {CLOSED}")),
    "stream_call_counts": (CALLS, """SELECT coalesce(priority, 5) AS priority, count(*) AS count
        FROM calls GROUP BY 1"""),
    "stream_incident_type_stats": (CALLS, _TYPES),
    "stream_daily_csv": (CALLS, """SELECT strftime(ts, '%Y%m%d') AS call_date, status, count(*) AS n,
        CAST(sum(len(units_dispatched)) AS BIGINT) AS units FROM calls GROUP BY 1, 2"""),
    "stream_compacted": (CALLS, _windowed(DISPATCHES)),
    "stream_late_calls": (f"{CALLS},\n{OUT_OF_ORDER}", """SELECT call_id, area_name, epoch_us(ts) AS ts_micros, arrived_in
        FROM timed WHERE is_late"""),
    "stream_late_counts": (f"{CALLS},\n{OUT_OF_ORDER}", """SELECT arrived_in AS batch_id, area_name,
        count(*) FILTER (is_late) AS late_calls, count(*) FILTER (NOT is_late) AS timely_calls FROM timed GROUP BY ALL"""),
    "stream_slot_monitors": (f"{METRICS},\n{CALLS}", f"""
        SELECT 'stream_area_spikes' AS output, area_name || '_' || window_start AS key, CAST(call_count AS DOUBLE) AS first,
          spike_ratio AS second FROM ({SPIKES})
        UNION ALL SELECT 'stream_response_degradation', area_name || '_' || window_start, live_avg_minutes, degradation_ratio
          FROM ({DEGRADED})
        UNION ALL SELECT 'stream_unit_utilization', area_name || '_' || window_start, CAST(lapd_units AS DOUBLE), utilization_pct
          FROM ({UNIT_TABLE})
        UNION ALL SELECT 'stream_dispatch_failures', area_name || '_' || window_start, CAST(failure_count AS DOUBLE), failure_rate
          FROM ({FAILED})
        UNION ALL SELECT 'stream_calls_enriched', call_id, CAST(priority AS DOUBLE), resolution_rate FROM {ENRICHED}
        UNION ALL SELECT 'stream_escalated_calls', call_id, CAST(original_priority AS DOUBLE), CAST(escalated_priority AS DOUBLE)
          FROM ({ESCALATED})"""),
    "stream_topology": (f"{METRICS},\n{CALLS}", f"""
        SELECT 'stream_calls' AS output, count(*) AS n FROM calls
        UNION ALL SELECT 'stream_calls_enriched', count(*) FROM {ENRICHED}
        UNION ALL SELECT 'stream_escalated_calls', count(*) FROM ({ESCALATED})
        UNION ALL SELECT 'stream_area_spikes', count(*) FROM ({SPIKES})
        UNION ALL SELECT 'stream_response_degradation', count(*) FROM ({DEGRADED})
        UNION ALL SELECT 'stream_unit_utilization', count(*) FROM ({UNITS})
        UNION ALL SELECT 'stream_dispatch_failures', count(*) FROM ({FAILED})"""),
}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {tables}\n{body}" if tables else body
            for name, (tables, body) in _SQL.items()}
