"""SQL with the same results as the registered queries, over the same tables.

It is built from a few shared WITH clauses. `half_up` rounds the shortest decimal text of a
double, as Spark does, so exact ties agree.
"""

from __future__ import annotations


def half_up(expression: str, digits: int) -> str:
    return (
        f"CAST(round(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"
    )


def steady(expression: str, digits: int) -> str:
    """Nine decimals first, so that the order of summation cannot decide a tie."""
    return half_up(half_up(expression, 9), digits)


def six(expression: str) -> str:
    return steady(expression, 6)


def _longitude(shift: int) -> str:
    return f"(-74050 + 10 * ((user_id + {shift}) % 10) + (k + {shift}) % 4) / CAST(1000 AS DOUBLE)"


def _latitude(shift: int) -> str:
    return f"(40700 + 10 * ((k + {shift}) % 8) + (user_id + {shift}) % 4) / CAST(1000 AS DOUBLE)"


SOURCE = """
src AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""

TRIPS = SOURCE + f""",
trips AS (
  SELECT event_id AS trip_id,
    CAST(ts AS TIMESTAMP) AS pickup_dt,
    CAST(ts AS TIMESTAMP) + to_seconds(
      CASE WHEN event_id % 97 = 0 THEN 12000 ELSE 20 + (event_id * 37) % 6000 END) AS dropoff_dt,
    CASE WHEN event_id % 89 = 0 THEN CAST(150 AS DOUBLE) ELSE k / CAST(5 AS DOUBLE) END
      AS trip_distance,
    CASE WHEN event_id % 53 = 0 THEN -value ELSE value END AS fare_amount,
    CAST(user_id % 7 AS INTEGER) AS passenger_count,
    CASE WHEN event_id % 61 <> 0 THEN {_longitude(0)} END AS pickup_longitude,
    CASE WHEN event_id % 67 <> 0 THEN {_latitude(0)} END AS pickup_latitude,
    CASE WHEN event_id % 71 <> 0 THEN {_longitude(3)} END AS dropoff_longitude,
    CASE WHEN event_id % 71 <> 0 THEN {_latitude(3)} END AS dropoff_latitude
  FROM src)"""

LABELLED = TRIPS + f""",
timed AS (
  SELECT *,
    CAST(hour(pickup_dt) AS INTEGER) AS hour,
    CAST(dayofweek(pickup_dt) + 1 AS INTEGER) AS day_of_week,
    CAST(isodow(pickup_dt) - 1 AS INTEGER) AS dow_monday,
    CAST(month(pickup_dt) AS INTEGER) AS month,
    CASE WHEN isodow(pickup_dt) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    {half_up("(floor(epoch(dropoff_dt)) - floor(epoch(pickup_dt))) / 60", 2)} AS trip_duration_min
  FROM trips),
paced AS (
  SELECT *, CASE WHEN trip_duration_min > 0
    THEN {half_up("trip_distance / (trip_duration_min / 60)", 2)} ELSE 0 END AS avg_speed_mph
  FROM timed),
labelled AS (
  SELECT *, CAST(CASE
      WHEN hour BETWEEN 7 AND 9 AND is_weekend = 0 THEN 2.5
      WHEN hour BETWEEN 17 AND 19 AND is_weekend = 0 THEN 2.8
      WHEN hour BETWEEN 22 AND 23 AND is_weekend = 1 THEN 3.2
      WHEN hour BETWEEN 0 AND 2 AND is_weekend = 1 THEN 3.0
      WHEN avg_speed_mph < 5 THEN 2.0
      WHEN avg_speed_mph < 10 THEN 1.6
      WHEN passenger_count > 4 THEN 1.4
      ELSE 1.0 END AS DOUBLE) AS surge_multiplier,
    coalesce(trip_distance BETWEEN 0.1 AND 100, false) AS ok_distance,
    coalesce(fare_amount > 0, false) AS ok_fare,
    coalesce(passenger_count > 0, false) AS ok_passengers,
    pickup_longitude IS NOT NULL AS ok_longitude,
    pickup_latitude IS NOT NULL AS ok_latitude,
    coalesce(trip_duration_min BETWEEN 1 AND 180, false) AS ok_duration,
    coalesce(avg_speed_mph < 120, false) AS ok_speed,
    md5('42:' || trip_id) AS place
  FROM paced),
placed AS (
  SELECT *,
    ok_distance AND ok_fare AND ok_passengers AND ok_longitude AND ok_latitude
      AND ok_duration AND ok_speed AS ok,
    CAST('0x' || substr(place, 1, 8) AS BIGINT) % 100 < 80 AS in_train
  FROM labelled),
clean AS (
  SELECT *,
    CASE dow_monday WHEN 0 THEN 'Mon' WHEN 1 THEN 'Tue' WHEN 2 THEN 'Wed' WHEN 3 THEN 'Thu'
      WHEN 4 THEN 'Fri' WHEN 5 THEN 'Sat' ELSE 'Sun' END AS day_name,
    CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type
  FROM placed WHERE ok)"""

VIEW = """
dow_monday IN (0, 2, 5) AND hour BETWEEN 6 AND 20
AND surge_multiplier IN (1.0, 1.6, 2.5, 2.8) AND is_weekend = 0"""

FEATURES = """
trip_id, hour, day_of_week, month, is_weekend, trip_distance, passenger_count,
trip_duration_min, avg_speed_mph, pickup_longitude, pickup_latitude,
dropoff_longitude, dropoff_latitude, fare_amount, surge_multiplier"""

PREDICTIONS = LABELLED + """,
predictions AS (
  SELECT trip_id, place, surge_multiplier AS label,
    surge_multiplier + ((trip_id * 31) % 21 - 10) / CAST(100 AS DOUBLE) AS prediction,
    hour, day_of_week, is_weekend
  FROM clean WHERE NOT in_train)"""

REQUESTS = SOURCE + """,
requests AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
    CASE event_type WHEN 'click' THEN 'Downtown' WHEN 'view' THEN 'Uptown'
      WHEN 'purchase' THEN 'Suburbs' WHEN 'signup' THEN 'Industrial' END AS zone,
    2 * k AS ride_requests,
    CAST(5 + user_id % 76 AS INTEGER) AS available_drivers,
    CAST(hour(ts) AS INTEGER) AS hour,
    isodow(ts) >= 6 AS is_weekend,
    CAST(event_id % 4 AS INTEGER) AS weather_code,
    CASE WHEN event_id % 5 <> 0 THEN k % 10 = 0 END AS special_event,
    CAST(NULL AS VARCHAR) AS weather,
    CAST(event_id AS VARCHAR) AS event_id,
    CAST(ts AS TIMESTAMP) AS event_time
  FROM src)"""


def _with(clauses: str, body: str) -> str:
    return f"WITH {clauses.strip()}\n{body.strip()}"


def _from_clean(body: str) -> str:
    return _with(LABELLED, body)


def _boxes() -> str:
    quartile = {
        name: six(f"quantile_cont(surge_multiplier, {fraction})")
        for name, fraction in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    }
    return _from_clean(f"""
, boxes AS (
  SELECT dow_monday, day_name, {", ".join(f"{sql} AS {name}" for name, sql in quartile.items())},
    count(*) AS trips
  FROM clean GROUP BY dow_monday, day_name),
fences AS (
  SELECT *, round(q1 - 1.5 * (q3 - q1), 9) AS low_fence, round(q3 + 1.5 * (q3 - q1), 9) AS high_fence
  FROM boxes)
SELECT f.dow_monday, f.day_name, f.q1, f.median, f.q3,
  {six("least(f.q1, min(c.surge_multiplier) FILTER (c.surge_multiplier >= low_fence))")}
    AS whisker_low,
  {six("greatest(f.q3, max(c.surge_multiplier) FILTER (c.surge_multiplier <= high_fence))")}
    AS whisker_high,
  f.trips,
  CAST(count(*) FILTER (c.surge_multiplier NOT BETWEEN low_fence AND high_fence) AS BIGINT)
    AS outliers
FROM fences f JOIN clean c ON c.dow_monday = f.dow_monday
GROUP BY f.dow_monday, f.day_name, f.q1, f.median, f.q3, f.trips""")


def _audit() -> str:
    rules = ("distance", "fare", "passengers", "longitude", "latitude", "duration", "speed")
    rejected = ",\n  ".join(f"count(*) FILTER (NOT ok_{rule}) AS rejected_{rule}" for rule in rules)
    return _from_clean(f"""
SELECT count(*) AS raw_rows, count(*) FILTER (ok) AS clean_rows,
  {rejected},
  count(*) FILTER (ok AND in_train) AS train_rows,
  count(*) FILTER (ok AND NOT in_train) AS test_rows
FROM placed""")


def _kpis(where: str) -> str:
    return _from_clean(f"""
SELECT {six("avg(surge_multiplier)")} AS avg_surge, max(surge_multiplier) AS max_surge,
  count(*) AS total_trips, {six("avg(fare_amount)")} AS avg_fare,
  {six("avg(trip_distance)")} AS avg_distance
FROM clean WHERE {where}""")


def _pivot() -> str:
    cells = ",\n  ".join(
        six(f"avg(c.surge_multiplier) FILTER (c.hour = {hour})") + f" AS h{hour:02d}"
        for hour in range(24)
    )
    return _from_clean(f"""
SELECT d.dow_monday,
  {cells},
  ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][d.dow_monday + 1] AS day_name
FROM (SELECT CAST(range AS INTEGER) AS dow_monday FROM range(7)) d
LEFT JOIN clean c ON c.dow_monday = d.dow_monday GROUP BY d.dow_monday""")


BAND = """CASE WHEN avg_surge >= 2.5 THEN 'high' WHEN avg_surge >= 1.5 THEN 'mid' ELSE 'low' END"""

PLOT_RANGE = "fare_amount < 60 AND trip_distance < 20"

FARE_POINTS = """
, sampled AS (SELECT * FROM clean ORDER BY place LIMIT 5000),
points AS (SELECT * FROM sampled WHERE fare_amount < 60 AND trip_distance < 20)"""

TREND = f"""
SELECT {six("regr_slope(fare_amount, trip_distance)")} AS slope,
  {six("regr_intercept(fare_amount, trip_distance)")} AS intercept,
  CAST(count(*) AS BIGINT) AS points"""

BLOCKS = """
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trip_id // 500 ORDER BY place, trip_id) AS block_rank
  FROM placed)"""

def _windowed(requests: str) -> str:
    return _with(requests, f"""
, windows AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, zone,
    CAST(sum(ride_requests) AS BIGINT) AS total_requests,
    avg(available_drivers) AS drivers,
    first(weather_code ORDER BY event_time, weather_code NULLS FIRST, is_weekend NULLS FIRST) AS weather_code,
    first(is_weekend ORDER BY event_time, weather_code NULLS FIRST, is_weekend NULLS FIRST) AS is_weekend
  FROM requests GROUP BY 1, 2),
priced AS (
  SELECT *, {half_up("total_requests / drivers", 2)} AS demand_supply_ratio FROM windows)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, zone, total_requests,
  {six("drivers")} AS avg_drivers, weather_code, is_weekend, demand_supply_ratio,
  CAST(CASE WHEN demand_supply_ratio >= 3.5 THEN 3.5 WHEN demand_supply_ratio >= 2.5 THEN 2.8
    WHEN demand_supply_ratio >= 1.8 THEN 2.2 WHEN demand_supply_ratio >= 1.3 THEN 1.8
    WHEN demand_supply_ratio >= 1.0 THEN 1.4 ELSE 1.0 END AS DOUBLE) AS surge_multiplier
FROM priced""")


WINDOWED = _windowed(REQUESTS)
WINDOWED_TIES = _windowed(REQUESTS.replace(
    "CAST(ts AS TIMESTAMP) AS event_time",
    "CASE WHEN src.event_id % 997 = 0 THEN TIMESTAMP '9999-06-01 12:00:00' ELSE date_trunc('minute', CAST(ts AS TIMESTAMP)) END AS event_time",
))

EVENT_FIELDS = """
coalesce(zone, 'Unknown') AS zone, surge_multiplier, ride_requests, available_drivers,
coalesce(weather, 'clear') AS weather, coalesce(special_event, false) AS special_event,
CAST(2.5 AS DOUBLE) AS base_fare_usd,
CAST(round(CAST(surge_multiplier AS DECIMAL(18,4)) * 2.5, 2) AS DOUBLE) AS effective_fare_usd,
event_id AS source_event_id"""

PRICED = REQUESTS + """,
rated AS (
  SELECT *, ride_requests / CAST(greatest(available_drivers, 1) AS DOUBLE) AS ratio FROM requests),
priced AS (
  SELECT *, CAST(least(5.0,
      CASE WHEN ratio >= 5.0 THEN 3.5 WHEN ratio >= 3.5 THEN 2.8 WHEN ratio >= 2.5 THEN 2.2
        WHEN ratio >= 1.8 THEN 1.8 WHEN ratio >= 1.3 THEN 1.4 WHEN ratio >= 1.0 THEN 1.2
        ELSE 1.0 END
      + CASE WHEN weather_code >= 3 THEN 0.5 WHEN weather_code >= 2 THEN 0.3 ELSE 0.0 END
      + CASE WHEN special_event THEN 0.5 ELSE 0.0 END
      + CASE WHEN is_weekend THEN 0.3 ELSE 0.0 END) AS DOUBLE) AS surge_multiplier
  FROM rated)"""


# The newest event time less the allowed lateness: what the feed's last watermark is.
MARK = "(SELECT max(event_time) - INTERVAL 2 MINUTE FROM requests)"
BUCKET = "time_bucket(INTERVAL 5 MINUTE, event_time)"

# Every fiftieth request comes again; what lies in a window behind the mark by then is late.
LATE_ROWS = _with(REQUESTS, f"""
, mark AS (SELECT {MARK} AS mark_at),
arrived AS (
  SELECT event_time, zone, ride_requests, FALSE AS late FROM requests
  UNION ALL
  SELECT event_time, zone, ride_requests, {BUCKET} + INTERVAL 5 MINUTE <= (SELECT mark_at FROM mark) FROM requests WHERE CAST(event_id AS BIGINT) % 50 = 0)
SELECT {BUCKET} AS window_start, zone,
  CAST(sum(ride_requests) FILTER (NOT late) AS BIGINT) AS total_requests,
  CAST(count(*) FILTER (late) AS BIGINT) AS late_rows,
  CAST(coalesce(sum(ride_requests) FILTER (late), 0) AS BIGINT) AS late_requests
FROM arrived GROUP BY 1, 2""")

FEED_COUNTS = _with(REQUESTS, f"""
, mark AS (SELECT {MARK} AS mark_at)
SELECT (SELECT count(*) + count(*) FILTER (CAST(event_id AS BIGINT) % 50 = 0) FROM requests) AS rows_read,
  (SELECT count(*) FROM requests WHERE CAST(event_id AS BIGINT) % 50 = 0 AND {BUCKET} + INTERVAL 5 MINUTE <= mark_at) AS rows_late,
  (SELECT count(*) FROM (SELECT DISTINCT {BUCKET} AS start, zone FROM requests) WHERE start + INTERVAL 5 MINUTE <= mark_at) AS windows_closed
FROM mark""")

CLOSED_WINDOWS = f"SELECT * FROM ({WINDOWED}) WHERE window_end <= (SELECT CAST(max(ts) AS TIMESTAMP) - INTERVAL 2 MINUTE FROM events)"

EVENTS_WITH_WINDOWS = f"""
SELECT {EVENT_FIELDS}, p.event_time AS requested_at, w.total_requests, w.window_ratio, w.window_surge, w.window_start, w.window_end
FROM (SELECT * FROM ({_with(PRICED, "SELECT * FROM priced")})) p
JOIN (SELECT window_start, window_end, zone AS window_zone, total_requests, demand_supply_ratio AS window_ratio, surge_multiplier AS window_surge FROM ({WINDOWED})) w
  ON p.zone IS NOT DISTINCT FROM w.window_zone AND p.event_time >= w.window_start AND p.event_time < w.window_end"""

# A session begins where the pause before a request is longer than the gap.
SESSIONS = _with(REQUESTS, """
, asked AS (
  SELECT src.user_id, r.event_time, r.zone, r.ride_requests,
    r.event_time - lag(r.event_time) OVER (PARTITION BY src.user_id ORDER BY r.event_time) <= INTERVAL 12 HOUR AS goes_on
  FROM requests r JOIN src ON CAST(src.event_id AS VARCHAR) = r.event_id),
numbered AS (
  SELECT *, count(*) FILTER (goes_on IS NOT TRUE) OVER (PARTITION BY user_id ORDER BY event_time) AS session FROM asked)
SELECT user_id, min(event_time) AS session_start, max(event_time) + INTERVAL 12 HOUR AS session_end, count(*) AS requests,
  CAST(sum(ride_requests) AS BIGINT) AS total_requests, first(zone ORDER BY event_time, zone NULLS FIRST) AS first_zone,
  first(zone ORDER BY event_time DESC, zone DESC NULLS LAST) AS last_zone
FROM numbered GROUP BY user_id, session""")

ZONED_TRIPS = """
SELECT event_id AS trip_id, CASE WHEN event_id % 29 <> 0 THEN CASE event_type WHEN 'click' THEN 'Downtown' WHEN 'view' THEN 'Uptown'
  WHEN 'purchase' THEN 'Suburbs' WHEN 'signup' THEN 'Industrial' END END AS zone, CAST(ts AS TIMESTAMP) + INTERVAL 30 SECOND AS pickup_dt
FROM events"""


def _quantiles() -> str:
    columns = {"fare": "fare_amount", "distance": "trip_distance", "duration": "trip_duration_min", "speed": "avg_speed_mph"}
    fractions = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
    return _from_clean(" UNION ALL ".join(
        f"SELECT '{name}' AS measure, " + ", ".join(f"CAST(quantile_disc({column}, {at}) AS DOUBLE) AS {label}" for label, at in fractions.items()) + " FROM clean"
        for name, column in columns.items()
    ))


def _sketched() -> str:
    return _from_clean("""
SELECT v.view, m.measure, l.label, CAST(count(*) AS BIGINT) AS rows, TRUE AS within_bound
FROM clean, (VALUES ('all'), ('weekend')) v(view), (VALUES ('fare'), ('distance'), ('duration'), ('speed')) m(measure),
  (VALUES ('p25'), ('median'), ('p75'), ('p90'), ('p99')) l(label)
WHERE v.view = 'all' OR is_weekend = 1 GROUP BY v.view, m.measure, l.label""")


def _report_means(*columns: tuple[str, int, str]) -> str:
    return ", ".join(f"{steady(f'avg({column})', digits)} AS {name}" for column, digits, name in columns)


# A forest's predictions have no SQL; which rows it scores, and within which limits, has.
FOREST_ROWS = _from_clean("""
SELECT trip_id, surge_multiplier AS label, TRUE AS in_label_range FROM clean WHERE NOT in_train AND dropoff_longitude IS NOT NULL""")

ORACLE: dict[str, str] = {
    "src_csv_roundtrip": _with(TRIPS, """
SELECT trip_id, pickup_dt, dropoff_dt, trip_distance, fare_amount, pickup_longitude,
  pickup_latitude, dropoff_longitude, dropoff_latitude, passenger_count
FROM trips"""),
    "features_roundtrip": _from_clean(f"SELECT {FEATURES} FROM clean"),
    "predictions_roundtrip": _with(PREDICTIONS, f"""
SELECT label, {six("prediction")} AS prediction, hour, day_of_week, is_weekend
FROM predictions ORDER BY place LIMIT 500"""),
    "cached_sample": _from_clean(
        BLOCKS + f"SELECT {FEATURES} FROM ranked WHERE block_rank <= 10 AND ok"
    ),
    "trip_features": _from_clean(f"SELECT {FEATURES} FROM clean"),
    "trip_surge": _from_clean("""
SELECT trip_id, hour, is_weekend, avg_speed_mph, passenger_count, surge_multiplier FROM labelled"""),
    "clean_trips": _from_clean("""
SELECT trip_id, pickup_dt, dropoff_dt, trip_distance, fare_amount, passenger_count,
  trip_duration_min, avg_speed_mph, pickup_longitude, pickup_latitude
FROM clean"""),
    "clean_audit": _audit(),
    "peak_flags": _from_clean("""
SELECT trip_id, hour,
  CASE WHEN hour BETWEEN 7 AND 9 THEN 1 ELSE 0 END AS is_morning_peak,
  CASE WHEN hour BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS is_evening_peak,
  CASE WHEN hour >= 22 OR hour <= 2 THEN 1 ELSE 0 END AS is_late_night
FROM clean"""),
    "day_name_features": _from_clean(
        "SELECT trip_id, day_of_week, dow_monday, day_name, day_type FROM clean"
    ),
    "surge_by_hour": _from_clean(f"""
SELECT hour, {_report_means(("surge_multiplier", 3, "avg_surge"), ("fare_amount", 2, "avg_fare"),
                            ("trip_distance", 2, "avg_distance"))}, count(*) AS trip_count
FROM clean GROUP BY hour ORDER BY avg_surge DESC, hour LIMIT 10"""),
    "top_pickup_areas": _from_clean(f"""
SELECT {half_up("pickup_longitude", 2)} AS area_lon, {half_up("pickup_latitude", 2)} AS area_lat,
  count(*) AS total_trips,
  {_report_means(("surge_multiplier", 3, "avg_surge"), ("fare_amount", 2, "avg_fare"))}
FROM clean GROUP BY 1, 2 ORDER BY total_trips DESC, area_lon, area_lat LIMIT 15"""),
    "weekend_vs_weekday": _from_clean(f"""
SELECT day_type, {_report_means(("surge_multiplier", 3, "avg_surge"), ("fare_amount", 2, "avg_fare"),
                                ("trip_distance", 2, "avg_distance"),
                                ("trip_duration_min", 1, "avg_duration_min"))},
  count(*) AS total_trips
FROM clean GROUP BY day_type"""),
    "surge_percentiles": _from_clean(f"""
SELECT quantile_disc(surge_multiplier, 0.25) AS p25, quantile_disc(surge_multiplier, 0.5) AS median,
  quantile_disc(surge_multiplier, 0.75) AS p75, quantile_disc(surge_multiplier, 0.9) AS p90,
  quantile_disc(surge_multiplier, 0.99) AS p99,
  {steady("avg(surge_multiplier)", 3)} AS mean,
  {steady("stddev_samp(surge_multiplier)", 3)} AS std_dev, max(surge_multiplier) AS max_surge
FROM clean"""),
    "peak_hour_windows": _from_clean(f"""
SELECT hour, day_of_week, count(*) AS trip_count, {_report_means(("surge_multiplier", 2, "avg_surge"))},
  {half_up("max(surge_multiplier)", 2)} AS max_surge,
  {steady("avg(avg_speed_mph)", 1)} AS avg_speed_mph
FROM clean WHERE hour IN (7, 8, 9, 17, 18, 19, 22, 23, 0, 1)
GROUP BY hour, day_of_week ORDER BY avg_surge DESC, hour, day_of_week LIMIT 20"""),
    "dashboard_filter": _from_clean(f"""
SELECT trip_id, day_name, hour, is_weekend, surge_multiplier, fare_amount FROM clean WHERE {VIEW}"""),
    "dashboard_kpis": _kpis("true"),
    "dashboard_kpis_filtered": _kpis(VIEW),
    "surge_by_hour_banded": _from_clean(f"""
SELECT hour, avg_surge, {BAND} AS band FROM (
  SELECT hour, {six("avg(surge_multiplier)")} AS avg_surge FROM clean GROUP BY hour)"""),
    "hourly_dense": _from_clean(f"""
, means AS (SELECT hour, {six("avg(surge_multiplier)")} AS avg_surge
            FROM clean WHERE {VIEW} GROUP BY hour)
SELECT h.hour, avg_surge, {BAND} AS band
FROM (SELECT CAST(range AS INTEGER) AS hour FROM range(24)) h LEFT JOIN means m ON m.hour = h.hour"""),
    "surge_box_by_day": _boxes(),
    "surge_share": _from_clean(f"""
SELECT surge_multiplier, count(*) AS trips,
  {six("count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM clean)")} AS share_pct
FROM clean GROUP BY surge_multiplier"""),
    "surge_levels": _from_clean("SELECT DISTINCT surge_multiplier FROM clean"),
    "surge_heatmap": _from_clean(f"""
SELECT dow_monday, hour, {six("avg(surge_multiplier)")} AS avg_surge, day_name
FROM clean GROUP BY dow_monday, hour, day_name"""),
    "surge_heatmap_pivot": _pivot(),
    "weekday_weekend_hourly": _from_clean(f"""
SELECT is_weekend, hour, {six("avg(surge_multiplier)")} AS avg_surge, day_type
FROM clean GROUP BY is_weekend, hour, day_type"""),
    "trip_preview": _from_clean("""
SELECT trip_id, hour, day_name, is_weekend, trip_distance, fare_amount, passenger_count,
  avg_speed_mph, trip_duration_min, surge_multiplier
FROM clean ORDER BY place LIMIT 500"""),
    "fare_scatter": _from_clean(
        FARE_POINTS + "SELECT trip_id, trip_distance, fare_amount, surge_multiplier FROM points"
    ),
    "fare_trend": _from_clean(f"{TREND} FROM clean WHERE {PLOT_RANGE}"),
    "fare_trend_sampled": _from_clean(f"{FARE_POINTS} {TREND} FROM points"),
    "fare_trend_line": _from_clean(f"""
, trend AS (SELECT regr_slope(fare_amount, trip_distance) AS slope,
    regr_intercept(fare_amount, trip_distance) AS intercept FROM clean WHERE {PLOT_RANGE}),
line AS (SELECT CAST(range AS INTEGER) AS step, range * CAST(20 AS DOUBLE) / 99 AS x FROM range(100))
SELECT step, {six("x")} AS trip_distance,
  {six("(SELECT slope FROM trend) * x + (SELECT intercept FROM trend)")} AS fare_amount
FROM line"""),
    "seeded_sample": _from_clean(
        "SELECT trip_id, fare_amount, surge_multiplier FROM clean ORDER BY place LIMIT 500"
    ),
    "block_sample": _from_clean(
        BLOCKS + "SELECT trip_id, trip_distance, fare_amount FROM ranked WHERE block_rank <= 10"
    ),
    "train_test_split": _from_clean("SELECT trip_id, CAST(in_train AS INTEGER) AS in_train FROM clean"),
    "prediction_error": _with(PREDICTIONS, f"""
SELECT {six("sqrt(avg((label - prediction) * (label - prediction)))")} AS rmse,
  {six("avg(abs(label - prediction))")} AS mae,
  {six("1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*))")} AS r2,
  count(*) AS "rows"
FROM predictions"""),
    "prediction_limits": _with(PREDICTIONS, f"""
SELECT {six("least(min(label), min(prediction)) - CAST(0.1 AS DOUBLE)")} AS low,
  {six("greatest(max(label), max(prediction)) + CAST(0.1 AS DOUBLE)")} AS high
FROM predictions"""),
    "prediction_preview": _with(PREDICTIONS, f"""
SELECT trip_id, label, {six("prediction")} AS prediction, hour, day_of_week, is_weekend
FROM predictions ORDER BY place LIMIT 100"""),
    "prediction_residuals": _with(PREDICTIONS, f"""
SELECT trip_id, label, {six("prediction")} AS prediction, {six("label - prediction")} AS residual
FROM predictions"""),
    "ride_requests_parsed": _with(REQUESTS, "SELECT * FROM requests"),
    "bad_request_records": (
        "SELECT 'bad ' || event_id AS value FROM events WHERE event_id % 83 = 0"
    ),
    "window_surge": WINDOWED,
    "stream_window_surge": WINDOWED,
    "event_surge": _with(PRICED, f"SELECT {EVENT_FIELDS} FROM priced"),
    "stream_event_surge": _with(
        PRICED, f"SELECT coalesce(zone, 'Unknown') AS message_key, {EVENT_FIELDS} FROM priced"
    ),
    "window_surge_ties": WINDOWED_TIES,
    "event_surge_mixed": _with(PRICED, f"SELECT {EVENT_FIELDS} FROM priced WHERE CAST(event_id AS BIGINT) % 83 <> 0"),
    "stream_event_surge_mixed": _with(PRICED, f"SELECT {EVENT_FIELDS} FROM priced WHERE CAST(event_id AS BIGINT) % 83 <> 0"),
    "unparsed_request_records": "SELECT 'bad ' || event_id AS value FROM events WHERE event_id % 83 = 0",
    "stored_sample_csv": _with(LABELLED, f"""
, numbered AS (SELECT *, row_number() OVER (ORDER BY trip_id) - 1 AS position FROM placed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY position // 500 ORDER BY md5('42:' || position), position) AS block_rank
  FROM numbered)
SELECT {FEATURES.replace("trip_id,", "")} FROM ranked WHERE ok AND block_rank <= 10"""),
    "feature_schema": """
SELECT CAST(position AS INTEGER) AS position, name, type FROM (VALUES
  (0, 'trip_id', 'bigint'), (1, 'hour', 'int'), (2, 'day_of_week', 'int'), (3, 'month', 'int'), (4, 'is_weekend', 'int'),
  (5, 'trip_distance', 'double'), (6, 'passenger_count', 'int'), (7, 'trip_duration_min', 'double'),
  (8, 'avg_speed_mph', 'double'), (9, 'pickup_longitude', 'double'), (10, 'pickup_latitude', 'double'),
  (11, 'dropoff_longitude', 'double'), (12, 'dropoff_latitude', 'double'), (13, 'fare_amount', 'double'),
  (14, 'surge_multiplier', 'double')) AS fields(position, name, type)""",
    "feature_counts": _from_clean(" UNION ALL ".join(
        f"SELECT CAST({position} AS INTEGER) AS position, '{name}' AS name, '{kind}' AS type, count(*) AS rows,"
        f" count(*) FILTER ({name} IS NULL) AS nulls FROM clean"
        for position, (name, kind) in enumerate(zip(
            FEATURES.replace(",", " ").split(), "bigint int int int int double int".split() + ["double"] * 8
        ))
    )),
    "views_with_rows": _from_clean(f"""
SELECT 'asked' AS view, count(*) > 0 AS has_rows FROM clean WHERE {VIEW}
UNION ALL SELECT 'none', count(*) > 0 FROM clean WHERE dow_monday = 0 AND hour = 3 AND surge_multiplier = 3.2"""),
    "surge_box_edges": _boxes().replace(
        ", boxes AS (",
        ", edged AS (SELECT * REPLACE (CAST(CASE WHEN trip_id % 10 = 0 THEN 1.0 WHEN trip_id % 10 < 5 THEN 1.6 ELSE 2.0 END AS DOUBLE)"
        " AS surge_multiplier) FROM clean),\nboxes AS (",
    ).replace("FROM clean GROUP", "FROM edged GROUP").replace("JOIN clean c", "JOIN edged c"),
    "prediction_points": _with(PREDICTIONS, f"""
, kept AS (SELECT *, place AS row_key FROM predictions ORDER BY place, trip_id LIMIT 1000),
points AS (SELECT * FROM kept ORDER BY md5('42:' || row_key) LIMIT 300)
SELECT label, {six("round(prediction, 1)")} AS prediction, CAST(7 AS INTEGER) AS hour, CAST(2 AS INTEGER) AS day_of_week, is_weekend, row_key
FROM points"""),
    "rf_scored_rows": FOREST_ROWS,
    "rf_reloaded_rows": FOREST_ROWS,
    "rf_quality": _from_clean("""
SELECT count(*) AS scored_rows, TRUE AS rmse_is_low, TRUE AS r2_is_high FROM clean WHERE NOT in_train AND dropoff_longitude IS NOT NULL"""),
    "rf_skipped_rows": _from_clean("""
SELECT count(*) AS rows, count(*) FILTER (dropoff_longitude IS NULL) AS skipped FROM clean"""),
    "rf_importance_bands": """
SELECT unnest(['hour', 'day_of_week', 'month', 'is_weekend', 'trip_distance', 'passenger_count', 'trip_duration_min', 'avg_speed_mph',
  'pickup_longitude', 'pickup_latitude', 'dropoff_longitude', 'dropoff_latitude', 'is_morning_peak', 'is_evening_peak', 'is_late_night'])
  AS feature, TRUE AS band_fits, CAST(1 AS DOUBLE) AS total""",
    "stream_late_rows": LATE_ROWS,
    "stream_closed_windows": CLOSED_WINDOWS,
    "stream_feed_counts": FEED_COUNTS,
    "stream_event_surge_replayed": _with(PRICED, f"SELECT {EVENT_FIELDS} FROM priced"),
    "event_window_join": EVENTS_WITH_WINDOWS,
    "stream_event_window_join": f"{EVENTS_WITH_WINDOWS} WHERE w.window_end <= (SELECT CAST(max(ts) AS TIMESTAMP) - INTERVAL 2 MINUTE FROM events)",
    "ride_sessions": SESSIONS,
    "stream_ride_sessions": f"SELECT * FROM ({SESSIONS}) WHERE session_end <= (SELECT CAST(max(ts) AS TIMESTAMP) - INTERVAL 2 MINUTE FROM events)",
    "trip_asof_surge": f"""
SELECT t.trip_id, t.zone, t.pickup_dt, w.window_end, w.demand_supply_ratio, w.surge_multiplier
FROM ({ZONED_TRIPS}) t ASOF LEFT JOIN ({WINDOWED}) w ON t.zone = w.zone AND t.pickup_dt >= w.window_end""",
    "demand_moving_30min": _with(REQUESTS, f"""
SELECT event_id, count(*) OVER recent AS recent_requests, CAST(sum(ride_requests) OVER recent AS BIGINT) AS recent_demand,
  {six("avg(available_drivers) OVER recent")} AS recent_drivers
FROM requests WINDOW recent AS (PARTITION BY zone ORDER BY event_time RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW)"""),
    "fare_quantiles": _quantiles(),
    "fare_quantiles_sketched": _sketched(),
    "top_pickup_areas_fine": _from_clean(f"""
SELECT {half_up("pickup_longitude", 4)} AS area_lon, {half_up("pickup_latitude", 4)} AS area_lat, count(*) AS total_trips,
  {_report_means(("surge_multiplier", 3, "avg_surge"), ("fare_amount", 2, "avg_fare"))}
FROM clean GROUP BY 1, 2 ORDER BY total_trips DESC, area_lon, area_lat LIMIT 15"""),
}
