"""ANSI SQL with the results the registered queries must give.

``RELATIONS`` restates, step by step, what the queries compute; a query's SQL is
a final SELECT over them.
"""

from __future__ import annotations

import re


def half_up(value: str, places: int) -> str:
    """Round half up on the number's decimal text."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 16)), {places}) AS DOUBLE)"


def half_even(value: str, places: int) -> str:
    return f"round_even({value}, {places})"


def number(text: str) -> str:
    pattern = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
    return f"(CASE WHEN regexp_matches({text}, '{pattern}') THEN TRY_CAST({text} AS DOUBLE) END)"


def field(packed: str, position: int) -> str:
    """Field (from 1) of a packed text, unscaled; null if it is not there."""
    return f"({number(f'string_split({packed}, chr(44))[{position}]')} / 10.0::DOUBLE)"


def celsius(missing: str) -> str:
    return f"CASE WHEN NOT ({missing}) THEN {field('TMP', 1)} END"


K = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"
EXACT_MISSING = "TMP = '+9999,9'"
ANY_MISSING = "string_split(TMP, ',')[1] IN ('+9999', '-9999', '9999')"
MILLIMETRES = f"CASE WHEN {field('AA1', 2)} < 999 THEN {field('AA1', 2)} ELSE 0.0::DOUBLE END"
WIND_SPEED = f"CASE WHEN {field('WND', 4)} < 999 THEN {field('WND', 4)} END"

VALID_TRIP = """pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND dropoff_datetime > pickup_datetime
    AND trip_distance BETWEEN 0 AND 500 AND fare_amount BETWEEN -10 AND 10000
    AND total_amount BETWEEN -10 AND 10000 AND passenger_count BETWEEN 0 AND 9
    AND pickup_location_id BETWEEN 1 AND 263 AND dropoff_location_id BETWEEN 1 AND 263"""
BROKEN = ", ".join(
    f"CASE WHEN ({condition}) IS NOT TRUE THEN '{name}' END"
    for name, condition in {
        "pickup_datetime_present": "pickup_datetime IS NOT NULL",
        "dropoff_datetime_present": "dropoff_datetime IS NOT NULL",
        "dropoff_datetime_after_pickup_datetime": "dropoff_datetime > pickup_datetime",
        "trip_distance_range": "trip_distance BETWEEN 0 AND 500",
        "fare_amount_range": "fare_amount BETWEEN -10 AND 10000",
        "total_amount_range": "total_amount BETWEEN -10 AND 10000",
        "passenger_count_range": "passenger_count BETWEEN 0 AND 9",
        "pickup_location_id_range": "pickup_location_id BETWEEN 1 AND 263",
        "dropoff_location_id_range": "dropoff_location_id BETWEEN 1 AND 263",
    }.items()
)
TRIP_KEYS = """vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id,
    dropoff_location_id, fare_amount, trip_distance"""
IN_JANUARY = (
    "pickup_datetime >= TIMESTAMP '2024-01-01' AND pickup_datetime < TIMESTAMP '2024-02-01'"
)
VALID_WEATHER = """date IS NOT NULL
    AND (temp_avg_celsius IS NULL OR temp_avg_celsius BETWEEN -40 AND 50)
    AND (precip_total_mm IS NULL OR precip_total_mm >= 0)
    AND (wind_avg_ms IS NULL OR wind_avg_ms BETWEEN 0 AND 50)"""


def fahrenheit(c: str) -> str:
    return half_up(f"({c} * 9.0::DOUBLE / 5.0::DOUBLE + 32)", 1)


DERIVED_WEATHER = f"""*,
    {fahrenheit('temp_avg_celsius')} AS temp_avg_fahrenheit,
    {fahrenheit('temp_min_celsius')} AS temp_min_fahrenheit,
    {fahrenheit('temp_max_celsius')} AS temp_max_fahrenheit,
    coalesce(precip_total_mm > 0.5, false) AS is_rainy,
    coalesce(precip_total_mm > 0.5 AND temp_avg_celsius <= 1.0, false) AS is_snowy,
    CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month"""


def day_of_week(day: str) -> str:
    return f"CAST(dayofweek({day}) + 1 AS INTEGER)"


def weekend(day: str) -> str:
    return f"(dayofweek({day}) IN (0, 6))"


def hour_label(hour: str) -> str:
    return f"""CASE WHEN {hour} BETWEEN 6 AND 9 THEN 'morning_rush'
    WHEN {hour} BETWEEN 10 AND 15 THEN 'midday'
    WHEN {hour} BETWEEN 16 AND 19 THEN 'evening_rush'
    WHEN {hour} BETWEEN 20 AND 21 THEN 'evening' ELSE 'late_night' END"""


DAILY_DOUBLES = (
    "avg_trip_distance avg_trip_duration_min avg_fare avg_tip total_revenue "
    "avg_total_amount avg_tip_percentage temp_avg_celsius temp_avg_fahrenheit "
    "temp_min_celsius temp_max_celsius precip_total_mm wind_avg_ms"
).split()

RELATIONS = {
    "rides": f"""
SELECT event_id, user_id, event_type, {K} AS k,
    CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL 22 YEAR ELSE ts END AS pickup,
    CASE WHEN event_id % 53 = 0 THEN 0.0 WHEN event_id % 59 = 0 THEN -20.0
         WHEN event_id % 61 = 0 THEN 12000.0
         ELSE floor(value * 4) / 4.0::DOUBLE END::DOUBLE AS fare
FROM events
UNION ALL
SELECT event_id, user_id, event_type, {K},
    CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL 22 YEAR ELSE ts END,
    CASE WHEN event_id % 53 = 0 THEN 0.0 WHEN event_id % 59 = 0 THEN -20.0
         WHEN event_id % 61 = 0 THEN 12000.0
         ELSE floor(value * 4) / 4.0::DOUBLE END::DOUBLE
FROM events WHERE event_id % 50 = 0""",
    "conformed": """
SELECT CAST(event_id % 2 + 1 AS INTEGER) AS vendor_id,
    pickup AS pickup_datetime,
    pickup + to_minutes(k - 3) + to_seconds((event_id % 4) * 15) AS dropoff_datetime,
    CASE WHEN event_id % 83 <> 0 THEN CAST(event_id % 11 AS INTEGER) END AS passenger_count,
    CAST(k * 6 AS DOUBLE) AS trip_distance,
    CASE WHEN event_id % 41 <> 0 THEN CAST(event_id % 6 + 1 AS INTEGER) END AS rate_code_id,
    CASE WHEN event_id % 10 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST((user_id * 17 + event_id) % 270 AS INTEGER) AS pickup_location_id,
    CAST((user_id * 7 + event_id) % 270 AS INTEGER) AS dropoff_location_id,
    CAST(CASE WHEN event_type IN ('purchase', 'click') THEN 1 WHEN event_type = 'view' THEN 2
         WHEN event_type = 'signup' THEN 3 ELSE 4 END AS INTEGER) AS payment_type,
    fare AS fare_amount,
    CAST((event_id % 3) * 0.5 AS DOUBLE) AS extra,
    0.5::DOUBLE AS mta_tax,
    greatest(fare, 0) * (event_id % 5)::DOUBLE * 0.25::DOUBLE AS tip_amount,
    CAST(CASE WHEN event_id % 7 = 0 THEN 6.5 ELSE 0 END AS DOUBLE) AS tolls_amount,
    1.0::DOUBLE AS improvement_surcharge,
    fare + greatest(fare, 0) * (event_id % 5)::DOUBLE * 0.25::DOUBLE AS total_amount,
    2.5::DOUBLE AS congestion_surcharge,
    0.0::DOUBLE AS airport_fee
FROM rides""",
    "valid": f"SELECT * FROM conformed WHERE {VALID_TRIP}",
    "silver": f"""
SELECT *, CAST(pickup_datetime AS DATE) AS pickup_date,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    {day_of_week('pickup_datetime')} AS pickup_day_of_week,
    {half_up("(epoch(date_trunc('second', dropoff_datetime)) - epoch(date_trunc('second', pickup_datetime)))::DOUBLE / 60.0::DOUBLE", 2)}
        AS trip_duration_minutes,
    'yellow' AS taxi_type,
    CAST(year(pickup_datetime) AS INTEGER) AS year,
    CAST(month(pickup_datetime) AS INTEGER) AS month
FROM (SELECT * FROM valid WHERE {IN_JANUARY}
      QUALIFY row_number() OVER (PARTITION BY {TRIP_KEYS} ORDER BY vendor_id) = 1)""",
    "observations": f"""
SELECT event_id,
    CASE WHEN event_id % 101 <> 0 THEN ts END AS observed_at,
    CASE WHEN d = 20 THEN '+9999,1' WHEN d % 9 = 0 THEN '+9999,9'
         WHEN event_id % 40 = 0 THEN '+9999,9' WHEN event_id % 71 = 0 THEN '12d,1'
         ELSE (CASE WHEN tenths < 0 THEN '-' ELSE '+' END)
              || lpad(CAST(abs(tenths) AS VARCHAR), 4, '0') || ',1' END AS TMP,
    CASE WHEN event_id % 61 = 0 THEN '090,1' WHEN event_id % 67 = 0 THEN '090,1,N,9999,9'
         ELSE '090,1,N,' || lpad(CAST((k % 40) * 5 AS VARCHAR), 4, '0') || ',1' END AS WND,
    CASE WHEN event_id % 6 = 0 THEN '01' WHEN event_id % 3 = 0
         THEN '01,' || lpad(CAST(CASE WHEN d % 4 = 0 THEN 0 ELSE k * 5 END AS VARCHAR), 4, '0')
              || ',1,1' END AS AA1
FROM (SELECT event_id, ts, day(ts) AS d, {K} AS k,
             ((event_id * 7) % 140 - (day(ts) % 6) * 20) * 5 AS tenths FROM events)""",
    "hourly": f"""
SELECT CAST(observed_at AS DATE) AS date, {celsius(EXACT_MISSING)} AS t,
    {MILLIMETRES} AS p, {WIND_SPEED} AS w
FROM observations WHERE observed_at IS NOT NULL""",
    "daily_obs": f"""
SELECT date, {half_even('avg(t)', 1)} AS temp_avg_celsius,
    {half_even('min(t)', 1)} AS temp_min_celsius, {half_even('max(t)', 1)} AS temp_max_celsius,
    {half_even('sum(p)', 1)} AS precip_total_mm, {half_even('avg(w)', 1)} AS wind_avg_ms,
    CAST(count(*) AS BIGINT) AS observation_count
FROM hourly GROUP BY date""",
    "filled_weather": f"""
SELECT * REPLACE (CASE WHEN temp_avg_celsius IS NULL
        THEN (lag(temp_avg_celsius) OVER (ORDER BY date)
              + lead(temp_avg_celsius) OVER (ORDER BY date)) / 2.0::DOUBLE
        ELSE temp_avg_celsius END AS temp_avg_celsius)
FROM daily_obs WHERE {VALID_WEATHER}""",
    "silver_weather": f"SELECT {DERIVED_WEATHER} FROM filled_weather WHERE year(date) = 2024",
    "metrics": """
SELECT pickup_date, CAST(count(*) AS BIGINT) AS total_trips,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    avg(trip_distance) AS avg_trip_distance, avg(trip_duration_minutes) AS avg_trip_duration_min,
    avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip, sum(total_amount) AS total_revenue,
    avg(total_amount) AS avg_total_amount,
    avg(CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 END) AS avg_tip_percentage,
    CAST(count(*) FILTER (payment_type = 1) AS BIGINT) AS credit_card_trips,
    CAST(count(*) FILTER (payment_type = 2) AS BIGINT) AS cash_trips,
    CAST(count(*) FILTER (pickup_hour BETWEEN 6 AND 9) AS BIGINT) AS morning_rush_trips,
    CAST(count(*) FILTER (pickup_hour BETWEEN 16 AND 19) AS BIGINT) AS evening_rush_trips,
    CAST(count(*) FILTER (pickup_hour >= 22 OR pickup_hour <= 5) AS BIGINT) AS late_night_trips
FROM silver GROUP BY pickup_date""",
    "gold": f"""
SELECT * REPLACE ({', '.join(f'{half_up(c, 2)} AS {c}' for c in DAILY_DOUBLES)})
FROM (SELECT m.*, {day_of_week('pickup_date')} AS day_of_week,
        {weekend('pickup_date')} AS is_weekend, w.temp_avg_celsius, w.temp_avg_fahrenheit,
        w.temp_min_celsius, w.temp_max_celsius, w.precip_total_mm, w.wind_avg_ms, w.is_rainy,
        w.is_snowy, CAST(year(pickup_date) AS INTEGER) AS year,
        CAST(month(pickup_date) AS INTEGER) AS month
      FROM metrics m LEFT JOIN silver_weather w ON w.date = m.pickup_date)""",
    "order_months": """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""",
    "shelved_orders": """
SELECT *, o_orderdate + CASE WHEN o_orderkey % 97 = 0 THEN INTERVAL 40 DAY ELSE INTERVAL 0 DAY END
    AS shelved FROM orders""",
    "prices": """
SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS day,
    CASE WHEN day(CAST(o_orderdate AS DATE)) NOT IN (1, 7, 8, 15, 31) THEN max(o_totalprice) END
        AS price
FROM orders GROUP BY o_orderstatus, CAST(o_orderdate AS DATE)""",
    "loaded": """
SELECT year, month FROM order_months GROUP BY year, month HAVING max(o_totalprice) >= 495000""",
    "file_months": """
SELECT w.y, w.m, count(o.o_orderkey) AS n, sum(o.o_orderkey % 1000)::BIGINT AS bytes,
    max(o.o_orderdate) AS newest
FROM (VALUES (1998, 6), (2010, 1)) AS w(y, m)
LEFT JOIN order_months o ON o.year = w.y AND o.month = w.m GROUP BY w.y, w.m""",
    "trend_runs": """
SELECT * FROM (VALUES (2000, 6), (2001, 8), (1995, 2)) AS v(y, m)""",
    "trend_counts": """
SELECT y, m, sum(CASE WHEN back = 0 THEN n ELSE 0 END) AS now,
    sum(CASE WHEN back > 0 THEN n ELSE 0 END) / 3.0::DOUBLE AS mean,
    count(*) FILTER (back > 0 AND n > 0) AS filled
FROM (SELECT r.y, r.m, b.back, count(o.o_orderkey) AS n
      FROM trend_runs r CROSS JOIN (VALUES (0), (1), (2), (3)) AS b(back)
      LEFT JOIN order_months o ON o.year * 12 + o.month = r.y * 12 + r.m - b.back
      GROUP BY ALL) GROUP BY y, m""",
    "suite_trips": """
SELECT 'silver' AS layer, 'yellow_taxi_trips' AS table_name, 2024 AS year, 1 AS month,
    check_name, passed, metric_value, threshold, severity
FROM (SELECT count(*) AS n, avg((pickup_datetime IS NULL)::INT) AS a,
        avg((pickup_location_id IS NULL)::INT) AS b, avg((fare_amount IS NULL)::INT) AS c,
        avg((fare_amount <= 0 OR fare_amount > 1000)::INT) AS f,
        avg((trip_distance <= 0 OR trip_distance > 200)::INT) AS d,
        avg((passenger_count < 1 OR passenger_count > 8)::INT) AS p,
        avg((pickup_location_id < 1 OR pickup_location_id > 265)::INT) AS z,
        count(*) FILTER (year(pickup_date) <> 2024 OR month(pickup_date) <> 1) AS stray
      FROM silver) CROSS JOIN LATERAL (VALUES
        ('row_count_floor', n >= 100, n::DOUBLE, 100::DOUBLE, 'error'),
        ('row_count_trend', true, NULL, NULL, 'warn'),
        ('null_rates', a <= 0.01 AND b <= 0.01 AND c <= 0.01, NULL, NULL, 'error'),
        ('value_ranges', f <= 0.005 AND d <= 0.005 AND p <= 0.005 AND z <= 0.005,
            NULL, NULL, 'error'),
        ('dates_in_partition', stray = 0, stray::DOUBLE, 0::DOUBLE, 'error')
    ) AS v(check_name, passed, metric_value, threshold, severity)""",
    "suite_weather": """
SELECT 'silver' AS layer, 'nyc_weather_daily' AS table_name, 2024 AS year, 1 AS month,
    'calendar_completeness' AS check_name, count(DISTINCT date) = 31 AS passed,
    count(DISTINCT date)::DOUBLE AS metric_value, 31::DOUBLE AS threshold, 'error' AS severity
FROM silver_weather WHERE year = 2024 AND month = 1""",
}


def _with(select: str) -> str:
    """The SELECT behind the relations it needs."""
    needed: set[str] = set()
    queue = [select]
    while queue:
        for word in set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", queue.pop())):
            if word in RELATIONS and word not in needed:
                needed.add(word)
                queue.append(RELATIONS[word])
    ctes = ", ".join(f"{name} AS ({RELATIONS[name]})" for name in RELATIONS if name in needed)
    return f"WITH {ctes} {select}" if ctes else select


def check(
    table: str,
    source: str,
    rows: list[tuple[str, str, str, str, str]],
    layer: str = "silver",
    year: int = 2024,
    month: int = 1,
) -> str:
    """Check rows (name, passed, metric, threshold, severity) over one aggregated row."""
    values = ", ".join(
        f"('{name}', {passed}, CAST({metric} AS DOUBLE), CAST({limit} AS DOUBLE), '{severity}')"
        for name, passed, metric, limit, severity in rows
    )
    return f"""SELECT '{layer}' AS layer, '{table}' AS table_name, {year} AS year,
    {month} AS month, v.* FROM ({source}) CROSS JOIN LATERAL (VALUES {values})
    AS v(check_name, passed, metric_value, threshold, severity)"""


CHECKED = "'bronze' AS layer, 'orders' AS table_name, y AS year, m AS month"


def bronze(table: str, month: str, when: str) -> str:
    """Rows of a bronze suite: wide limits, tight ones, and a period without files."""
    return f"""SELECT 'bronze' AS layer, '{table}' AS table_name, y AS year, {month} AS month, v.*
FROM (SELECT r.y, r.small, r.most, r.each_, count(o.o_orderkey) AS n,
          sum(o.o_orderkey % 1000)::BIGINT AS bytes
      FROM (VALUES (1998, 1, 1000000, 8388608), (1998, 1000000000000, 1, 1000000000),
          (2010, 1, 1000000, 8388608)) AS r(y, small, most, each_)
      LEFT JOIN (SELECT * FROM order_months WHERE {when}) o ON o.year = r.y GROUP BY ALL)
CROSS JOIN LATERAL (VALUES
    ('s3_object_exists', n > 0, NULL::DOUBLE, NULL::DOUBLE, 'error'),
    ('s3_file_size', coalesce(bytes >= small, false), bytes::DOUBLE,
        CASE WHEN bytes IS NOT NULL THEN small::DOUBLE END, 'error'),
    ('s3_file_count', n BETWEEN 1 AND greatest(most, ceil(coalesce(bytes, 0) / each_::DOUBLE)),
        n::DOUBLE, NULL::DOUBLE, 'error')
    ) AS v(check_name, passed, metric_value, threshold, severity)"""


SELECTS = {
    "scan_partition": """SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-07-01'""",
    "scan_year": """SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""",
    "scan_catalog": "SELECT * FROM order_months WHERE year = 1998 AND month = 6",
    "missing_periods": """SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
        date_trunc('month', max(o_orderdate) + INTERVAL 6 MONTH), INTERVAL 1 MONTH)) AS m
      FROM orders)
WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.year = year(m) AND l.month = month(m))""",
    "backfill_periods": """SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2002-04-01',
        INTERVAL 1 MONTH)) AS m)
WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.year = year(m) AND l.month = month(m))""",
    "lagged_period": """SELECT as_of, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
FROM (SELECT CAST(max(o_orderdate) AS DATE) AS as_of,
        CAST(max(o_orderdate) AS DATE) - INTERVAL 2 MONTH AS d
      FROM order_months GROUP BY year, month)""",
    "trailing_months": """SELECT year, month,
    CAST(year(b) AS INTEGER) AS back_year, CAST(month(b) AS INTEGER) AS back_month
FROM (SELECT year, month, make_date(year, month, 1) - to_months(k) AS b
      FROM (SELECT DISTINCT year, month FROM order_months)
      CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(k))""",
    "calendar_days": """SELECT year, month, CAST(unnest(generate_series(make_date(year, month, 1),
    last_day(make_date(year, month, 1)), INTERVAL 1 DAY)) AS DATE) AS day
FROM (SELECT DISTINCT year, month FROM order_months)""",
    "period_counts": """SELECT year, month, count(*) AS n FROM order_months
WHERE (year, month) IN ((1999, 11), (1999, 12), (2000, 1), (2000, 2)) GROUP BY year, month""",
    "conform_trips": "SELECT * FROM conformed",
    "conform_weather": """SELECT * REPLACE (CAST(observation_count AS VARCHAR) AS observation_count)
FROM daily_obs""",
    "trip_calendar": f"""SELECT event_id, CAST(ts AS DATE) AS pickup_date,
    CAST(hour(ts) AS INTEGER) AS pickup_hour, {day_of_week('ts')} AS pickup_day_of_week,
    CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month FROM events""",
    "trip_duration": f"""SELECT event_id,
    {half_up("(epoch(date_trunc('second', until)) - epoch(date_trunc('second', ts)))::DOUBLE / 60.0::DOUBLE", 2)}
        AS minutes
FROM (SELECT event_id, ts, ts + to_milliseconds((event_id % 7919) * 1000 + 750) AS until
      FROM events)""",
    "weather_derived": f"SELECT {DERIVED_WEATHER} FROM daily_obs",
    "weekend_flags": f"""SELECT o_orderkey, o_orderdate, {day_of_week('o_orderdate')} AS day_of_week,
    {weekend('o_orderdate')} AS is_weekend FROM orders""",
    "time_of_day": f"SELECT event_id, {hour_label('hour(ts)')} AS time_of_day FROM events",
    "parse_temperature": f"""SELECT event_id, {celsius(EXACT_MISSING)} AS celsius,
    {celsius(ANY_MISSING)} AS celsius_strict FROM observations""",
    "parse_precipitation": f"SELECT event_id, {MILLIMETRES} AS millimetres FROM observations",
    "parse_wind": f"SELECT event_id, {WIND_SPEED} AS metres_per_second FROM observations",
    "daily_weather": "SELECT * FROM daily_obs",
    "missing_fields": """SELECT date, NULL::DOUBLE AS temp_avg_celsius, NULL::DOUBLE AS temp_min_celsius,
    NULL::DOUBLE AS temp_max_celsius, 0.0::DOUBLE AS precip_total_mm, NULL::DOUBLE AS wind_avg_ms,
    observation_count FROM daily_obs""",
    "valid_trips": "SELECT * FROM valid",
    "rejected_trips": f"""SELECT pickup_datetime, pickup_location_id,
    concat_ws(',', {BROKEN}) AS failed_rules
FROM conformed WHERE ({VALID_TRIP}) IS NOT TRUE""",
    "period_trips": f"SELECT * FROM conformed WHERE {IN_JANUARY}",
    "valid_weather": f"SELECT * FROM daily_obs WHERE {VALID_WEATHER} AND year(date) = 2024",
    "cleaning_report": f"""SELECT rows_in, invalid, out_of_period,
    rows_in - invalid - out_of_period - rows_out AS duplicates, rows_out,
    {half_up('(invalid::DOUBLE / rows_in::DOUBLE * 100)', 1)} AS invalid_pct
FROM (SELECT count(*) AS rows_in, count(*) FILTER (({VALID_TRIP}) IS NOT TRUE) AS invalid,
        count(*) FILTER (({VALID_TRIP}) IS TRUE AND ({IN_JANUARY}) IS NOT TRUE) AS out_of_period,
        (SELECT count(*) FROM silver) AS rows_out
      FROM conformed)""",
    "dedup_trips": f"""SELECT * FROM conformed
QUALIFY row_number() OVER (PARTITION BY {TRIP_KEYS} ORDER BY vendor_id) = 1""",
    "dedup_first_trip": """SELECT * FROM conformed
QUALIFY row_number() OVER (PARTITION BY vendor_id, passenger_count, pickup_location_id
    ORDER BY pickup_datetime, dropoff_datetime, fare_amount) = 1""",
    "fill_gaps": """SELECT o_orderstatus, day, coalesce(price,
    (lag(price) OVER w + lead(price) OVER w) / 2.0::DOUBLE) AS price
FROM prices WINDOW w AS (PARTITION BY o_orderstatus ORDER BY day)""",
    "clean_trips": "SELECT * FROM silver",
    "clean_weather": "SELECT * FROM silver_weather",
    "daily_trip_metrics": "SELECT * FROM metrics",
    "trip_weather_daily": "SELECT * FROM gold",
    "location_hourly_features": f"""SELECT pickup_date, pickup_hour, pickup_location_id,
    count(*) AS trip_count, avg(trip_distance) AS avg_distance,
    avg(trip_duration_minutes) AS avg_duration_min, avg(fare_amount) AS avg_fare,
    avg(tip_amount) AS avg_tip, sum(total_amount) AS total_revenue,
    count(DISTINCT dropoff_location_id) AS unique_destinations,
    {day_of_week('pickup_date')} AS day_of_week, {weekend('pickup_date')} AS is_weekend,
    {hour_label('pickup_hour')} AS time_of_day,
    CAST(year(pickup_date) AS INTEGER) AS year, CAST(month(pickup_date) AS INTEGER) AS month
FROM silver GROUP BY pickup_date, pickup_hour, pickup_location_id""",
    "feature_query": """SELECT pickup_date, total_trips, avg_tip_percentage, temp_avg_fahrenheit, is_rainy
FROM gold WHERE year = 2024 AND month = 1 AND is_rainy ORDER BY pickup_date""",
    "row_count_floor": check(
        "orders",
        "SELECT count(*) AS n FROM order_months WHERE year = 1998 AND month = 6",
        [
            ("row_count_floor", "n >= 50", "n", "50", "error"),
            ("row_count_floor", "n >= 1000000", "n", "1000000", "error"),
        ],
        year=1998,
        month=6,
    ),
    "row_count_trend": """SELECT 'silver' AS layer, 'orders' AS table_name, y AS year, m AS month,
    'row_count_trend' AS check_name,
    filled < 3 OR now BETWEEN mean * 0.5::DOUBLE AND mean * 1.5::DOUBLE AS passed,
    CASE WHEN filled = 3 THEN now::DOUBLE END AS metric_value,
    CASE WHEN filled = 3 THEN mean END AS threshold, 'warn' AS severity
FROM trend_counts""",
    "null_rates": check(
        "trips",
        f"""SELECT avg((pickup_datetime IS NULL)::INT) AS a,
    avg((pickup_location_id IS NULL)::INT) AS b, avg((fare_amount IS NULL)::INT) AS c,
    avg((passenger_count IS NULL)::INT) AS d, avg((rate_code_id IS NULL)::INT) AS e
FROM conformed WHERE {IN_JANUARY}""",
        [
            ("null_rates", "a <= 0.01 AND b <= 0.01 AND c <= 0.01", "NULL", "NULL", "error"),
            (
                "null_rates",
                "a <= 0.02 AND b <= 0.02 AND c <= 0.02 AND d <= 0.02 AND e <= 0.02",
                "NULL",
                "NULL",
                "error",
            ),
        ],
    ),
    "value_ranges": check(
        "lineitem",
        """SELECT avg((l_quantity < 1 OR l_quantity > 50)::INT) AS a,
    avg((l_discount < 0 OR l_discount > 0.1)::INT) AS b,
    avg((l_extendedprice <= 0 OR l_extendedprice >= 1000000)::INT) AS c,
    avg((l_quantity <= 1 OR l_quantity > 50)::INT) AS d,
    avg((l_tax < 0 OR l_tax > 0.08)::INT) AS e,
    avg((l_quantity < 10 OR l_quantity > 40)::INT) AS f,
    avg((l_quantity < 0 OR l_quantity > 100)::INT) AS g FROM lineitem""",
        [
            ("value_ranges", "a <= 0.005 AND b <= 0.005 AND c <= 0.005", "NULL", "NULL", "error"),
            ("value_ranges", "d <= 0.005 AND e <= 0.005", "NULL", "NULL", "error"),
            ("value_ranges", "f <= 0.005 AND g <= 0.005", "NULL", "NULL", "error"),
        ],
        year=1998,
    ),
    "stat_bounds": check(
        "lineitem",
        "SELECT avg(l_quantity) AS q, max(l_discount) AS d FROM lineitem",
        [
            ("stat_bounds", "q BETWEEN 20 AND 30", "q", "30", "warn"),
            ("stat_bounds", "d BETWEEN 0.2 AND 0.5", "d", "0.5", "warn"),
        ],
        year=1998,
    ),
    "calendar_completeness": check(
        "events",
        "SELECT count(DISTINCT CAST(ts AS DATE)) AS n FROM events",
        [("calendar_completeness", "n = 31", "n", "31", "error")],
    ),
    "dates_in_partition": check(
        "orders",
        """SELECT count(*) FILTER (year(o_orderdate) <> 1998 OR month(o_orderdate) <> 6) AS n
FROM shelved_orders WHERE year(shelved) = 1998 AND month(shelved) = 6""",
        [("dates_in_partition", "n = 0", "n", "0", "error")],
        year=1998,
        month=6,
    ),
    "unexpected_partitions": check(
        "trips",
        """SELECT count(*) FILTER (year(pickup) <> 2024) AS a,
    count(*) FILTER (year(pickup) NOT IN (2002, 2024)) AS b FROM rides""",
        [
            ("no_unexpected_partitions", "a = 0", "NULL", "NULL", "error"),
            ("no_unexpected_partitions", "b = 0", "NULL", "NULL", "error"),
        ],
        layer="bronze",
    ),
    "cross_layer_counts": check(
        "trips",
        """SELECT s.n AS s, r.n AS r FROM (SELECT count(*) AS n FROM silver) s
CROSS JOIN (SELECT count(*) AS n FROM rides) r""",
        [
            (
                "cross_layer_counts",
                "s <= r AND s::DOUBLE / r::DOUBLE >= 0.5",
                "s::DOUBLE / r::DOUBLE",
                "0.5",
                "error",
            ),
            (
                "cross_layer_counts",
                "s <= r AND s::DOUBLE / r::DOUBLE >= 0.99",
                "s::DOUBLE / r::DOUBLE",
                "0.99",
                "error",
            ),
            (
                "cross_layer_counts",
                "r <= s AND r::DOUBLE / s::DOUBLE >= 0.5",
                "r::DOUBLE / s::DOUBLE",
                "0.5",
                "error",
            ),
        ],
    ),
    "gold_reconciliation": check(
        "daily",
        """SELECT g.n AS g, s.n AS s, s.one AS one FROM (SELECT sum(total_trips) AS n FROM metrics) g
CROSS JOIN (SELECT count(*) AS n, count(*) FILTER (vendor_id = 1) AS one FROM silver) s""",
        [
            ("gold_reconciliation", "g = s", "g", "s", "error"),
            ("gold_reconciliation", "one = s", "one", "s", "error"),
        ],
        layer="gold",
    ),
    "files_exist": f"""SELECT {CHECKED}, 's3_object_exists' AS check_name, n > 0 AS passed,
    NULL::DOUBLE AS metric_value, NULL::DOUBLE AS threshold, 'error' AS severity
FROM file_months""",
    "total_bytes": f"""SELECT {CHECKED}, 's3_file_size' AS check_name, coalesce(bytes >= least_, false) AS passed,
    bytes::DOUBLE AS metric_value, CASE WHEN bytes IS NOT NULL THEN least_::DOUBLE END AS threshold,
    'error' AS severity
FROM file_months JOIN (VALUES (1998, 1), (1998, 1000000000000), (2010, 1)) AS v(y, least_) USING (y)""",
    "file_count": f"""SELECT {CHECKED}, 's3_file_count' AS check_name,
    n BETWEEN 1 AND greatest(most, ceil(coalesce(bytes, 0) / each_::DOUBLE)) AS passed,
    n::DOUBLE AS metric_value, NULL::DOUBLE AS threshold, 'error' AS severity
FROM file_months JOIN (VALUES (1998, 1000000, 1e18), (1998, 1, 1e18), (1998, 1, 10), (1998, 1, 1e9),
    (2010, 5, 1e18)) AS v(y, most, each_) USING (y)""",
    "freshness": f"""SELECT {CHECKED}, 's3_freshness' AS check_name, coalesce(hours <= most, false) AS passed,
    hours AS metric_value, CASE WHEN hours IS NOT NULL THEN most::DOUBLE END AS threshold, 'error' AS severity
FROM (SELECT *, (epoch_us(TIMESTAMP '1998-07-02 06:00:00') - epoch_us(newest)) / 3.6e9::DOUBLE AS hours
      FROM file_months) JOIN (VALUES (1998, 744), (1998, 1), (2010, 48)) AS v(y, most) USING (y)""",
    "suite_bronze_trips": bronze("yellow_taxi_trips", "6", "month = 6"),
    "suite_bronze_weather": bronze("nyc_weather_daily", "CAST(NULL AS INTEGER)", "true"),
    "gate": f"""SELECT {CHECKED}, v.* FROM file_months CROSS JOIN LATERAL (VALUES
    ('s3_object_exists', n > 0, NULL::DOUBLE, NULL::DOUBLE, 'error'),
    ('s3_file_size', coalesce(bytes >= 1, false), bytes::DOUBLE,
        CASE WHEN bytes IS NOT NULL THEN 1::DOUBLE END, 'error')
    ) AS v(check_name, passed, metric_value, threshold, severity)
UNION ALL SELECT 'silver', 'orders', y, m, 'row_count_floor', n >= 50, n::DOUBLE, 50::DOUBLE, 'error'
FROM file_months WHERE n > 0""",
    "suite_silver_trips": "SELECT * FROM suite_trips",
    "suite_silver_weather": "SELECT * FROM suite_weather",
    "suite_gold": check(
        "trip_weather_daily",
        """SELECT g.*, s.n AS s FROM (SELECT sum(total_trips) AS n,
    count(DISTINCT pickup_date) AS d, avg(avg_fare) AS f FROM gold) g
CROSS JOIN (SELECT count(*) AS n FROM silver) s""",
        [
            ("gold_reconciliation", "n = s", "n", "s", "error"),
            ("calendar_completeness", "d = 31", "d", "31", "error"),
            ("stat_bounds", "f BETWEEN 5 AND 50", "round(f, 9)", "50", "warn"),
        ],
        layer="gold",
    ),
    "evaluate_checks": """SELECT bool_and(passed OR severity = 'warn') AS passed, count(*) AS checks,
    count(*) FILTER (NOT passed AND severity <> 'warn') AS failed_errors,
    count(*) FILTER (NOT passed AND severity = 'warn') AS failed_warnings
FROM (SELECT * FROM suite_trips UNION ALL SELECT * FROM suite_weather)""",
}

ORACLE = {name: _with(select) for name, select in SELECTS.items()}
