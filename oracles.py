"""The queries as DuckDB SQL on the shared test tables."""

from __future__ import annotations

RAW = """
pair(k, parameter, unit) AS (VALUES
  (0,'co','ppm'),(1,'co','ppb'),(2,'no2','ppm'),(3,'no2','ppb'),
  (4,'so2','ppm'),(5,'so2','ppb'),(6,'o3','ppb'),(7,'o3','ppm'),
  (8,'pm25','µg/m³'),(9,'pm10','µg/m³'),(10,'pm4','particles/cm³'),(11,'pm1','µg/m³'),
  (12,'no','ppm'),(13,'no','ppb'),(14,'ch4','ppm'),(15,'ch4','ppb'),
  (16,'bc','ng/m³'),(17,'pressure','hpa'),(18,'pressure','mb'),(19,'pressure','pa'),
  (20,'temperature','f'),(21,'temperature','k'),(22,'temperature','c'),
  (23,'relativehumidity','%'),(24,'CO','µg/m³'),(25,'PM25','µg/m³'),
  (26,'Pressure','hPa'),(27,'um010','particles/cm³')),
flat AS (
  SELECT e.event_id // 1000 AS block, e.user_id,
    'doc' || lpad(CAST(e.event_id // 1000 AS VARCHAR), 12, '0')
          || lpad(CAST(e.user_id AS VARCHAR), 12, '0') AS doc_id,
    'station-' || CAST(e.user_id AS VARCHAR) AS location,
    n.n_name AS city, r.r_name AS country,
    CAST((e.user_id // 2) % 75 AS DOUBLE) * 0.5 - 18.5 AS latitude,
    CAST((e.user_id // 2) % 75 + 4 * ((e.user_id // 2) // 75) AS DOUBLE) - 37.0 AS longitude,
    p.parameter, p.unit,
    CASE WHEN lower(p.parameter) = 'pressure' AND p.unit <> 'pa' THEN 850 + e.value
         WHEN p.unit = 'pa' THEN e.value * 1000 ELSE e.value END AS value,
    strftime(e.ts + to_days(CAST(e.event_id % 366 AS INT)), '%Y-%m-%dT%H:%M:%S')
      || '+00:00' AS last_updated
  FROM events e JOIN pair p ON p.k = e.event_id % 28
  JOIN nation n ON n.n_nationkey = e.user_id % 25
  JOIN region r ON r.r_regionkey = n.n_regionkey)"""

UNITS = """
factor(name, label, factor) AS (VALUES
  ('co','ppm',1145.94::DOUBLE),('co','ppb',1.14594),('no2','ppm',1912.87),('no2','ppb',1.91287),
  ('so2','ppm',2620.8),('so2','ppb',2.6208),('o3','ppb',2.0),('no','ppm',1230.0),
  ('no','ppb',1.23),('ch4','ppm',655.66),('pressure','hpa',100.0),('pressure','mb',100.0)),
relabel(name, label, target) AS (
  SELECT g.name, u.label, 'µg/m³'
  FROM (VALUES ('co'),('no2'),('so2'),('o3'),('no'),('ch4')) g(name), (VALUES ('ppm'),('ppb')) u(label)
  UNION ALL VALUES ('pressure','hpa','Pa'),('pressure','mb','Pa'),
    ('temperature','f','°C'),('temperature','k','°C'),('temperature','c','°C')),
keyed AS (
  SELECT doc_id || '_' || parameter AS measurement_id, lower(parameter) AS name, flat.* FROM flat),
harmonised AS (
  SELECT k.measurement_id, k.doc_id, k.parameter, k.city, k.country, k.location AS location_name,
    k.latitude, k.longitude, k.last_updated,
    CASE k.name WHEN 'relativehumidity' THEN 'humidity' ELSE k.name END AS parameter_name,
    CASE WHEN f.factor IS NOT NULL THEN k.value * f.factor
         WHEN k.name = 'temperature' AND k.unit = 'f' THEN (k.value - 32) * 5 / 9
         WHEN k.name = 'temperature' AND k.unit = 'k' THEN k.value - 273.15::DOUBLE
         ELSE k.value END AS value,
    CASE WHEN k.name IN ('pm25','pm4','pm10','bc') THEN 'µg/m³'
         ELSE coalesce(l.target, k.unit) END AS unit,
    CASE WHEN f.factor IS NOT NULL OR k.name = 'temperature' THEN coalesce(l.target, k.unit)
         ELSE k.unit END AS strict_unit
  FROM keyed k LEFT JOIN factor f ON f.name = k.name AND f.label = k.unit
  LEFT JOIN relabel l ON l.name = k.name AND l.label = k.unit)"""

CLEAN = """
clean AS (
  SELECT measurement_id, city, country, location_name, latitude, longitude, parameter_name,
    CASE WHEN parameter_name = 'pressure' AND value < 87000 THEN 87000::DOUBLE
         WHEN parameter_name = 'pressure' AND value > 108400 THEN 108400::DOUBLE
         ELSE value END AS value,
    unit,
    timezone('Europe/Paris', CAST(last_updated AS TIMESTAMPTZ)) AS "timestamp",
    timezone('UTC', CAST(last_updated AS TIMESTAMPTZ)) AS observed_utc
  FROM harmonised)"""

DIMENSIONS = """
survivor AS (
  SELECT location_name, city, country, latitude, longitude FROM clean
  QUALIFY row_number() OVER (PARTITION BY latitude, longitude
                             ORDER BY location_name, city, country) = 1),
location AS (
  SELECT CAST(row_number() OVER (ORDER BY latitude, longitude) AS BIGINT) AS location_id,
    survivor.*, ((latitude + 18.5) * 2) % 2 = 0 AS known FROM survivor),
parameter AS (
  SELECT CAST(row_number() OVER (ORDER BY parameter_name) AS BIGINT) AS parameter_id,
    parameter_name, parameter_name IN ('co','no2','pm25','pressure') AS known
  FROM (SELECT DISTINCT parameter_name FROM clean)),
clock AS (
  SELECT CAST(row_number() OVER (ORDER BY "timestamp") AS BIGINT) AS time_id, "timestamp",
    CAST(year("timestamp") AS INTEGER) AS "year", CAST(month("timestamp") AS INTEGER) AS "month",
    CAST(day("timestamp") AS INTEGER) AS "day", CAST(hour("timestamp") AS INTEGER) AS "hour",
    CAST(minute("timestamp") AS INTEGER) AS "minute",
    CAST(second("timestamp") AS INTEGER) AS "second", hour("timestamp") < 12 AS known
  FROM (SELECT DISTINCT "timestamp" FROM clean)),
location2 AS (
  SELECT CAST(row_number() OVER (ORDER BY known DESC, latitude, longitude) AS BIGINT) AS location_id,
    location.* EXCLUDE (location_id) FROM location),
parameter2 AS (
  SELECT CAST(row_number() OVER (ORDER BY known DESC, parameter_name) AS BIGINT) AS parameter_id,
    parameter.* EXCLUDE (parameter_id) FROM parameter),
clock2 AS (
  SELECT CAST(row_number() OVER (ORDER BY known DESC, "timestamp") AS BIGINT) AS time_id,
    clock.* EXCLUDE (time_id) FROM clock)"""

FACTS = """
latest AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY measurement_id
                             ORDER BY observed_utc DESC, value DESC, unit DESC) = 1),
facts AS (
  SELECT m.measurement_id, l.location_id, p.parameter_id, t.time_id, m.value, m.unit
  FROM latest m LEFT JOIN location l ON l.latitude = m.latitude AND l.longitude = m.longitude
  LEFT JOIN parameter p ON p.parameter_name = m.parameter_name
  LEFT JOIN clock t ON t."timestamp" = m."timestamp")"""

DOCUMENTS = """
docs AS (
  SELECT doc_id, location, country, count(*) AS n, max(last_updated) AS newest
  FROM flat GROUP BY doc_id, location, country)"""


# Sums of doubles that do not depend on their order: whole numbers in bins of eight exponents.
TREND = """, binned AS (
  SELECT f.*, CASE WHEN isfinite(f.value) AND f.value <> 0
      THEN greatest(CAST(floor((log2(abs(f.value)) + 1e-9) / 8) AS INTEGER), -121) END AS k
  FROM facts f),
hours AS (
  SELECT p.parameter_name, b.unit, t."year", t."month", t."day", t."hour", b.value, b.k,
    CAST(CAST(b.value * pow(2.0::DOUBLE, 53 - 8 * b.k) AS BIGINT) AS HUGEINT) AS whole
  FROM binned b JOIN parameter p ON p.parameter_id = b.parameter_id
  JOIN clock t ON t.time_id = b.time_id),
parts AS (
  SELECT parameter_name, unit, "year", "month", "day", "hour", k, sum(whole) AS s,
    ((sum(whole) % 1073741824) + 1073741824) % 1073741824 AS low
  FROM hours WHERE k IS NOT NULL GROUP BY ALL),
totals AS (
  SELECT parameter_name, unit, "year", "month", "day", "hour",
    sum((CAST(CAST((s - low) // 1073741824 AS BIGINT) AS DOUBLE) * 1073741824::DOUBLE + CAST(low AS DOUBLE))
        * pow(2.0::DOUBLE, 8 * k - 53) ORDER BY k DESC) AS total
  FROM parts GROUP BY ALL),
counted AS (
  SELECT parameter_name, unit, "year", "month", "day", "hour", count(*) AS readings,
    count(*) FILTER (isfinite(value)) AS finite, min(value) AS min_value, max(value) AS max_value
  FROM hours GROUP BY ALL)
SELECT c.parameter_name, c.unit, c."year", c."month", c."day", c."hour", c.readings,
  CASE WHEN c.finite > 0 THEN coalesce(x.total, 0) / c.finite END AS avg_value, c.min_value, c.max_value
FROM counted c LEFT JOIN totals x ON x.parameter_name = c.parameter_name AND x.unit IS NOT DISTINCT FROM c.unit
  AND x."year" = c."year" AND x."month" = c."month" AND x."day" = c."day" AND x."hour" = c."hour"
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_RAW = _with(RAW)
_DOCS = _with(RAW, DOCUMENTS)
_UNITS = _with(RAW, UNITS)
_CLEAN = _with(RAW, UNITS, CLEAN)
_DIMS = _with(RAW, UNITS, CLEAN, DIMENSIONS)
_STAR = _with(RAW, UNITS, CLEAN, DIMENSIONS, FACTS)

_PLAIN = "location, city, country, latitude, longitude, parameter, value, unit, last_updated"


def all_queries() -> dict[str, str]:
    sql = {
        "raw_unnest": _RAW + f"SELECT doc_id, {_PLAIN} FROM flat",
        "message_round_trip": _RAW + f"SELECT {_PLAIN} FROM flat",
        "message_rejects": _DOCS
        + """, told AS (
            SELECT CASE WHEN country = 'ASIA' THEN 'malformed json' WHEN country = 'EUROPE' THEN 'missing location'
              WHEN country = 'AFRICA' AND n = 1 THEN 'badly typed readings' ELSE 'accepted' END AS reject_reason,
              CASE WHEN country = 'AFRICA' THEN n - 1 ELSE n END AS kept
            FROM docs
            UNION ALL SELECT 'badly typed reading', NULL FROM docs WHERE country = 'AFRICA' AND n > 1)
          SELECT reject_reason, count(*) AS messages,
            CAST(coalesce(sum(kept) FILTER (reject_reason = 'accepted'), 0) AS BIGINT) AS readings
          FROM told GROUP BY reject_reason""",
        "stored_documents": _RAW + f"SELECT doc_id, {_PLAIN} FROM flat",
        "latest_page": _DOCS
        + """SELECT doc_id, location, CAST(n AS INTEGER) AS readings FROM docs
          ORDER BY newest DESC, doc_id LIMIT 100 OFFSET 100""",
        "page_by_cursor": _DOCS
        + """, pages AS (SELECT *, row_number() OVER (ORDER BY newest DESC, doc_id) - 1 AS place FROM docs)
          SELECT doc_id, location, CAST(n AS INTEGER) AS readings FROM pages
          WHERE place >= 300 AND place < 400""",
        "unprocessed_filter": _DOCS
        + """, flagged AS (SELECT country, CASE country WHEN 'AFRICA' THEN TRUE WHEN 'ASIA' THEN NULL
          ELSE FALSE END AS done FROM docs)
          SELECT 'unprocessed' AS view_name, country, count(*) AS documents FROM flagged
          WHERE NOT done GROUP BY country
          UNION ALL SELECT 'processed', country, count(*) FROM flagged WHERE done GROUP BY country
          UNION ALL SELECT 'not marked', country, count(*) FROM flagged
          WHERE done IS DISTINCT FROM TRUE GROUP BY country
          UNION ALL SELECT 'unprocessed after backfill', country, count(*) FROM flagged
          WHERE NOT coalesce(done, FALSE) GROUP BY country""",
        "mark_processed": _DOCS
        + """SELECT 'processed' AS view_name, country, count(*) AS documents FROM docs
          WHERE country <> 'ASIA' GROUP BY country""",
        "measurement_key": _UNITS
        + "SELECT measurement_id, name AS parameter_name, last_updated FROM keyed",
        "unit_conversion": _UNITS
        + "SELECT measurement_id, last_updated, parameter_name, value, unit FROM harmonised",
        "unit_conversion_strict": _UNITS
        + """SELECT measurement_id, last_updated, parameter_name, value, strict_unit AS unit
          FROM harmonised""",
        "paris_time": _UNITS
        + """SELECT measurement_id, last_updated,
          timezone('Europe/Paris', CAST(last_updated AS TIMESTAMPTZ)) AS local_time,
          strftime(timezone('Europe/Paris', CAST(last_updated AS TIMESTAMPTZ)),
                   '%Y-%m-%d %H:%M:%S') AS local_text FROM harmonised""",
        "zoned_time": _UNITS
        + """, told AS (SELECT measurement_id, last_updated,
            timezone('Europe/Paris', CAST(last_updated AS TIMESTAMPTZ)) AS local,
            timezone('UTC', CAST(last_updated AS TIMESTAMPTZ)) AS utc FROM harmonised)
          SELECT measurement_id, last_updated,
            strftime(local, '%Y-%m-%dT%H:%M:%S') || CASE date_diff('hour', utc, local)
              WHEN 2 THEN '+02:00' ELSE '+01:00' END AS with_offset,
            strftime(local, '%Y-%m-%dT%H:%M:%S') || 'Z' AS as_utc FROM told""",
        "pressure_clamp": _UNITS
        + """SELECT measurement_id, last_updated, parameter_name,
          CASE WHEN parameter_name = 'pressure'
               THEN least(greatest(value, 87000::DOUBLE), 108400::DOUBLE) ELSE value END AS value
          FROM harmonised""",
        "pressure_left_join": _UNITS
        + """, one AS (SELECT * FROM harmonised QUALIFY row_number() OVER (
            PARTITION BY measurement_id ORDER BY last_updated DESC, value DESC, unit DESC) = 1),
          corrected AS (SELECT measurement_id, least(greatest(value, 87000::DOUBLE),
            108400::DOUBLE) AS v FROM one WHERE parameter_name = 'pressure')
          SELECT o.measurement_id, o.parameter_name, coalesce(c.v, o.value) AS value, o.unit
          FROM one o LEFT JOIN corrected c ON c.measurement_id = o.measurement_id""",
        "pressure_max": _UNITS
        + "SELECT max(value) AS max_value FROM keyed WHERE name = 'pressure'",
        "clean_measurements": _CLEAN + "SELECT * FROM clean",
        "fact_star_join": _DIMS
        + """SELECT m.measurement_id, l.location_id, p.parameter_id, t.time_id, m.value, m.unit
          FROM clean m LEFT JOIN location2 l ON l.latitude = m.latitude AND l.longitude = m.longitude
          LEFT JOIN parameter2 p ON p.parameter_name = m.parameter_name
          LEFT JOIN clock2 t ON t."timestamp" = m."timestamp\"""",
        "first_per_reading": _CLEAN
        + """SELECT measurement_id, parameter_name, "timestamp", value, unit FROM clean
          QUALIFY row_number() OVER (PARTITION BY measurement_id, parameter_name, "timestamp"
                                     ORDER BY value, unit) = 1""",
        "fact_upsert": _STAR
        + """, source AS (SELECT f.* REPLACE (value + 1 AS value) FROM facts f
            WHERE lower(split_part(measurement_id, '_', 2)) IN ('relativehumidity', 'pressure'))
          SELECT f.* FROM facts f WHERE lower(split_part(measurement_id, '_', 2)) <> 'relativehumidity'
            AND NOT EXISTS (SELECT 1 FROM source s WHERE s.measurement_id = f.measurement_id)
          UNION ALL SELECT * FROM source""",
        "integrity_violations": _STAR
        + """, loc AS (SELECT * FROM location UNION ALL SELECT * FROM location WHERE country = 'ASIA'),
          tim AS (SELECT * FROM clock WHERE "hour" <> 0)
          SELECT 'dimension_location' AS table_name, 'natural key unique' AS rule,
            count(*) AS violations
            FROM (SELECT 1 FROM loc GROUP BY latitude, longitude HAVING count(*) > 1)
          UNION ALL SELECT 'dimension_parameter', 'natural key unique', count(*)
            FROM (SELECT 1 FROM parameter GROUP BY parameter_name HAVING count(*) > 1)
          UNION ALL SELECT 'dimension_time', 'natural key unique', count(*)
            FROM (SELECT 1 FROM tim GROUP BY "timestamp" HAVING count(*) > 1)
          UNION ALL SELECT 'dimension_location', 'primary key unique', count(*)
            FROM (SELECT 1 FROM loc GROUP BY location_id HAVING count(*) > 1)
          UNION ALL SELECT 'dimension_parameter', 'primary key unique', count(*)
            FROM (SELECT 1 FROM parameter GROUP BY parameter_id HAVING count(*) > 1)
          UNION ALL SELECT 'dimension_time', 'primary key unique', count(*)
            FROM (SELECT 1 FROM tim GROUP BY time_id HAVING count(*) > 1)
          UNION ALL SELECT 'air_quality_measurements', 'primary key unique', count(*)
            FROM (SELECT 1 FROM facts GROUP BY measurement_id HAVING count(*) > 1)
          UNION ALL SELECT 'air_quality_measurements', 'location_id resolves', count(*) FROM facts
            WHERE location_id IS NOT NULL AND location_id NOT IN (SELECT location_id FROM loc)
          UNION ALL SELECT 'air_quality_measurements', 'parameter_id resolves', count(*) FROM facts
            WHERE parameter_id IS NOT NULL AND parameter_id NOT IN (SELECT parameter_id FROM parameter)
          UNION ALL SELECT 'air_quality_measurements', 'time_id resolves', count(*) FROM facts
            WHERE time_id IS NOT NULL AND time_id NOT IN (SELECT time_id FROM tim)""",
        "trend_by_hour": _STAR + TREND,
        "trend_maintained": _STAR + TREND,
        "containment_new_docs": _RAW
        + """, variant(suffix) AS (VALUES ('-v0'), ('-v1'), ('-v2')),
          heads AS (SELECT DISTINCT doc_id || suffix AS doc_id, user_id FROM flat, variant),
          readings AS (
            SELECT doc_id || suffix AS doc_id, user_id, parameter, unit, last_updated,
              CASE suffix WHEN '-v2' THEN value + 1 ELSE value END AS value
            FROM flat, variant WHERE suffix <> '-v1' OR parameter < 'p'),
          wanted AS (SELECT doc_id, user_id, count(*) AS n FROM readings GROUP BY doc_id, user_id),
          held AS (
            SELECT r.doc_id, s.doc_id AS holder, count(*) AS n FROM readings r
            JOIN flat s ON s.user_id = r.user_id AND s.parameter = r.parameter AND s.unit = r.unit
              AND s.value = r.value AND s.last_updated = r.last_updated
            WHERE (s.block + s.user_id) % 2 = 0 GROUP BY r.doc_id, s.doc_id)
          SELECT h.doc_id, CAST(coalesce(w.n, 0) AS INTEGER) AS readings
          FROM heads h LEFT JOIN wanted w ON w.doc_id = h.doc_id
          WHERE NOT EXISTS (SELECT 1 FROM held x WHERE x.doc_id = w.doc_id AND x.n = w.n)""",
        "batch_repeats": _DOCS + "SELECT doc_id, CAST(n AS INTEGER) AS readings FROM docs",
        "normalised_documents": _RAW
        + """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id
            ORDER BY parameter, value, unit, last_updated) - 1 AS INTEGER) AS position,
            parameter, value, unit FROM flat""",
        "stream_increment": _STAR
        + """SELECT latitude, longitude, parameter_name, "timestamp", value, unit FROM latest""",
        "bounded_stream": _DOCS
        + """SELECT location, country, CAST(n AS INTEGER) AS readings, newest AS last_updated FROM docs""",
        "step_counts": _CLEAN
        + """, delivered AS (
            SELECT c.*, CASE WHEN country IN ('AFRICA', 'AMERICA', 'ASIA') THEN 1 ELSE 2 END AS d,
              split_part(measurement_id, '_', 1) AS doc_id FROM clean c),
          raw_pressure AS (SELECT k.value, CASE WHEN country IN ('AFRICA', 'AMERICA', 'ASIA') THEN 1 ELSE 2 END AS d
            FROM keyed k WHERE k.name = 'pressure'),
          docs AS (SELECT d, count(DISTINCT doc_id) AS n FROM delivered GROUP BY d),
          places AS (SELECT latitude, longitude, min(d) AS first, max(d) AS last FROM delivered GROUP BY ALL),
          names AS (SELECT parameter_name, min(d) AS first, max(d) AS last FROM delivered GROUP BY ALL),
          times AS (SELECT "timestamp", min(d) AS first, max(d) AS last FROM delivered GROUP BY ALL),
          dims AS (SELECT 'dimension_location' AS t, first, last FROM places
            UNION ALL SELECT 'dimension_parameter', first, last FROM names
            UNION ALL SELECT 'dimension_time', first, last FROM times),
          step(d, land, load) AS (VALUES (1, 'land-d1', 'load-land-d1-land-d1'), (2, 'land-d2', 'load-land-d2-land-d2')),
          counts AS (
            SELECT land AS step, 'messages' AS name, sum(n) AS value FROM step JOIN docs ON docs.d <= step.d GROUP BY land
            UNION ALL SELECT land, 'new', n FROM step JOIN docs USING (d)
            UNION ALL SELECT land, 'rejects', 0 FROM step
            UNION ALL SELECT 'land-d3', x, 0 FROM (VALUES ('messages'), ('new'), ('rejects')) v(x)
            UNION ALL SELECT load, 'readings', count(*) FROM step JOIN delivered USING (d) GROUP BY load
            UNION ALL SELECT load, 'unusable', 0 FROM step
            UNION ALL SELECT load, 'max_pressure', max(value) FROM step JOIN raw_pressure USING (d) GROUP BY load
            UNION ALL SELECT load, t || '_rows', count(*) FROM step JOIN dims ON step.d IN (first, last) GROUP BY load, t
            UNION ALL SELECT load, t || '_new', count(*) FILTER (step.d = first)
              FROM step JOIN dims ON step.d IN (first, last) GROUP BY load, t)
          SELECT step, name, CAST(value AS DOUBLE) AS value FROM counts""",
        "load_gate": _STAR
        + """, early AS (SELECT * FROM latest WHERE country IN ('AFRICA', 'AMERICA')),
          told AS (SELECT latitude, longitude, min((location_name, city, country)) AS s FROM clean
            WHERE country IN ('AFRICA', 'AMERICA') GROUP BY latitude, longitude)
          SELECT 'repeated natural key in dimension_location' AS name, count(*) AS n FROM told WHERE s[3] = 'AFRICA'
          UNION ALL SELECT 'facts', count(*) FROM early
          UNION ALL SELECT 'pending landings', 1""",
    }
    for table, name, columns in (
        ("location", "location", "location_id, location_name, city, country, latitude, longitude"),
        ("parameter", "parameter", "parameter_id, parameter_name"),
        (
            "clock",
            "time",
            'time_id, "timestamp", "year", "month", "day", "hour", "minute", "second"',
        ),
    ):
        sql[f"dim_{name}"] = _DIMS + f"SELECT {columns} FROM {table}"
        sql[f"dim_resolve_{name}_ids"] = _DIMS + f"SELECT {columns} FROM {table}2"
        sql[f"dim_new_{name}s"] = _DIMS + f"SELECT {columns} FROM {table}2 WHERE NOT known"
    return sql
