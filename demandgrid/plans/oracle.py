"""The same results in plain SQL, for checking against another engine."""

from __future__ import annotations

from demandgrid.operators.diagnostics import quantile_points
from demandgrid.schema import FEATURE_COLUMNS

# --- rides -----------------------------------------------------------------------------


def _rides(station: str, source: str = "events") -> str:
    return f"""
base AS (
  SELECT event_id, ts AS started_at, event_type AS city, {station} AS s,
         date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', ts) AS eh,
         ascii(event_type) AS a, day(ts) AS dom, isodow(ts) - 1 AS wd
  FROM {source}),
rides AS (
  SELECT event_id, started_at, city,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN s = 7 THEN 'station_7'
         WHEN event_id % 3 = 1 THEN concat(CAST(s AS VARCHAR), '.0')
         WHEN event_id % 3 = 2 THEN concat(' ', CAST(s AS VARCHAR), ' ')
         ELSE CAST(s AS VARCHAR) END AS start_station_id,
    CAST(s * 250 AS DOUBLE) AS bike_lane_length_500m,
    CAST(s * 1000 AS DOUBLE) AS park_area_500m,
    s % 3 AS university_count_1000m,
    s % 5 AS office_poi_count_1000m,
    s % 7 AS retail_poi_count_1000m,
    s % 11 AS restaurant_cafe_count_500m,
    s % 4 AS transit_stop_count_500m,
    CAST(s * 100 + 50 AS DOUBLE) AS distance_to_nearest_rail_station,
    CAST(s * 200 + 50 AS DOUBLE) AS distance_to_city_center,
    CAST((eh * 13 + a) % 101 AS DOUBLE) AS relative_humidity_2m,
    CASE WHEN event_id % 11 = 0 THEN NULL
         ELSE CAST((eh * 7 + a) % 400 AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(5 AS DOUBLE)
    END AS apparent_temperature,
    CASE WHEN (eh + a) % 5 = 0 THEN CAST((eh * 17) % 30 AS DOUBLE) / CAST(10 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS rain,
    CASE WHEN (eh + a) % 23 = 0 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS snowfall,
    CAST((eh * 11) % 101 AS DOUBLE) AS cloud_cover,
    CAST((eh * 3 + a) % 40 AS DOUBLE) AS wind_speed_10m,
    CAST(dom IN (1, 15) AS INT) AS holiday,
    CASE WHEN dom = 1 THEN 'first' WHEN dom = 15 THEN 'middle' END AS holiday_name,
    CASE WHEN wd < 5 THEN 1 - CAST(dom IN (1, 15) AS INT) ELSE 0 END AS working_day
  FROM base)"""


_TRIMMED = r"regexp_replace(start_station_id, '^\s+|\s+$', '', 'g')"
_KEYED = rf"""
trimmed AS (SELECT *, {_TRIMMED} AS t FROM rides),
keyed AS (
  SELECT * EXCLUDE (t), coalesce(city, '__missing_city__') AS city_key,
    coalesce(
      CASE WHEN regexp_matches(t, '^[+-]?[0-9]+$') THEN CAST(TRY_CAST(t AS BIGINT) AS VARCHAR) END,
      CASE WHEN regexp_matches(t, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')
            AND abs(TRY_CAST(t AS DOUBLE)) < 9.2e18
            AND TRY_CAST(t AS DOUBLE) = floor(TRY_CAST(t AS DOUBLE))
           THEN CAST(CAST(TRY_CAST(t AS DOUBLE) AS BIGINT) AS VARCHAR) END,
      t, '__missing_station__') AS station_key,
    date_trunc('hour', started_at) AS target_hour_start
  FROM trimmed)"""
_CELLS = """
cells AS (
  SELECT city_key, station_key, target_hour_start, count(*) AS demand
  FROM keyed GROUP BY 1, 2, 3),
bounds AS (
  SELECT city_key, min(target_hour_start) AS lo, max(target_hour_start) AS hi
  FROM keyed GROUP BY 1)"""

_DENSE = _rides("user_id % 8") + "," + _KEYED + "," + _CELLS
_SPARSE = _rides("user_id * 10 + (day(ts) - 1) // 7") + "," + _KEYED + "," + _CELLS
_WIDE = _rides("user_id") + "," + _KEYED + "," + _CELLS
_MOD8 = _rides("user_id % 8")
_BUSY = _rides("CASE WHEN user_id % 3 = 0 THEN 1 ELSE 2 + user_id // 8 END")


# --- grids -----------------------------------------------------------------------------

_FULL_GRID = """
grid AS (
  SELECT city_key, station_key, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS target_hour_start
  FROM (SELECT DISTINCT city_key, station_key FROM cells) JOIN bounds USING (city_key))"""


def _active(before: int, after: int, minimum: int) -> str:
    return f"""
activity AS (
  SELECT city_key, station_key,
    min(target_hour_start) - to_hours({before}) AS s0,
    max(target_hour_start) + to_hours({after}) AS e0
  FROM keyed GROUP BY 1, 2),
padded AS (
  SELECT *, greatest({minimum} - (date_diff('hour', s0, e0) + 1), 0) AS missing FROM activity),
windows AS (
  SELECT city_key, station_key,
    greatest(s0 - to_hours(CAST(missing // 2 AS INT)), lo) AS ws,
    least(e0 + to_hours(CAST(missing - missing // 2 AS INT)), hi) AS we
  FROM padded JOIN bounds USING (city_key)),
grid AS (
  SELECT city_key, station_key, unnest(generate_series(ws, we, INTERVAL 1 HOUR)) AS target_hour_start
  FROM windows WHERE ws <= we)"""


_FILLED = """
filled AS (
  SELECT g.city_key, g.station_key, g.target_hour_start,
         CAST(coalesce(c.demand, 0) AS BIGINT) AS demand
  FROM {grid} g LEFT JOIN cells c USING (city_key, station_key, target_hour_start))"""


def _filled(grid: str = "grid") -> str:
    return _FILLED.format(grid=grid)


_KEPT = "kept AS (SELECT * FROM grid WHERE hour(target_hour_start) BETWEEN 6 AND 22)"


def _capped(source: str, caps: dict[str, int], seed: int) -> str:
    cap = " ".join(f"WHEN '{c}' THEN {n}" for c, n in caps.items())
    names = ", ".join(f"'{c}'" for c in caps)
    return f"""
ordered AS (
  SELECT city_key, target_hour_start, row_number() OVER (
    PARTITION BY city_key
    ORDER BY md5(concat_ws('|', city_key, strftime(target_hour_start, '%Y-%m-%d %H:%M:%S'), '{seed}')),
             target_hour_start) AS place
  FROM (SELECT DISTINCT city_key, target_hour_start FROM {source})),
capped AS (
  SELECT k.* FROM {source} k JOIN ordered o USING (city_key, target_hour_start)
  WHERE k.city_key NOT IN ({names}) OR o.place <= CASE k.city_key {cap} END)"""


# --- dimensions and the full panel -----------------------------------------------------

_STATION_ATTRS = [
    "bike_lane_length_500m",
    "park_area_500m",
    "university_count_1000m",
    "office_poi_count_1000m",
    "retail_poi_count_1000m",
    "restaurant_cafe_count_500m",
    "transit_stop_count_500m",
    "distance_to_nearest_rail_station",
    "distance_to_city_center",
]
_WEATHER = [
    "relative_humidity_2m",
    "apparent_temperature",
    "rain",
    "snowfall",
    "cloud_cover",
    "wind_speed_10m",
]
_CITY_HOUR = [*_WEATHER, "holiday", "holiday_name", "working_day"]


def _firsts(columns: list[str], order: str = "event_id") -> str:
    return ", ".join(
        f"arg_min({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in columns
    )


_DIMS = f"""
station_dim AS (
  SELECT city_key, station_key, {_firsts(["city", "start_station_id", *_STATION_ATTRS])}
  FROM keyed GROUP BY 1, 2),
city_hour_dim AS (
  SELECT city_key, target_hour_start, {_firsts(_CITY_HOUR)}
  FROM keyed GROUP BY 1, 2)"""


def _panel(rows: str) -> str:
    return f"""
panel AS (
  SELECT row_number() OVER (ORDER BY f.city_key, f.station_key, f.target_hour_start) - 1 AS id,
    f.*, d.* EXCLUDE (city_key, station_key), h.* EXCLUDE (city_key, target_hour_start),
    f.target_hour_start AS hour_ts, CAST(hour(f.target_hour_start) AS INT) AS hour,
    CAST(isodow(f.target_hour_start) - 1 AS INT) AS weekday,
    strftime(f.target_hour_start, '%Y-%m-%d') AS date,
    CAST(isodow(f.target_hour_start) >= 6 AS INT) AS weekend
  FROM {rows} f
  LEFT JOIN station_dim d ON f.city_key = d.city_key AND f.station_key = d.station_key
  LEFT JOIN city_hour_dim h
    ON f.city_key = h.city_key AND f.target_hour_start = h.target_hour_start)"""


def panel_sql(select: str, caps: dict[str, int], seed: int) -> str:
    return f"""WITH {_SPARSE},{_active(0, 0, 72)}, {_KEPT},{_capped("kept", caps, seed)},
{_filled("capped")},{_DIMS},{_panel("filled")} {select}"""


# --- training --------------------------------------------------------------------------


def _training(min_rides: int, rides: str = _MOD8) -> str:
    meta = ", ".join(
        f"arg_min({c}, hour_ts) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _STATION_ATTRS
    )
    hours = [*_WEATHER, "holiday", "working_day"]
    by_station = ", ".join(f"first({c} ORDER BY start_station_id) AS {c}" for c in hours)
    return f"""{rides},{_KEYED},
major AS (SELECT city FROM keyed GROUP BY city HAVING count(*) >= {min_rides}),
trides AS (
  SELECT * EXCLUDE (start_station_id, city_key, station_key, target_hour_start),
    station_key AS start_station_id, target_hour_start AS hour_ts
  FROM keyed WHERE city IN (SELECT city FROM major)),
tcells AS (
  SELECT city, start_station_id, hour_ts, count(*) AS demand,
    {_firsts([*_STATION_ATTRS, *hours])}
  FROM trides GROUP BY 1, 2, 3),
tbounds AS (SELECT city, min(hour_ts) AS lo, max(hour_ts) AS hi FROM tcells GROUP BY 1),
tmeta AS (SELECT city, start_station_id, {meta} FROM tcells GROUP BY 1, 2),
thours AS (SELECT city, hour_ts, {by_station} FROM tcells GROUP BY 1, 2),
tgrid AS (
  SELECT city, start_station_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts
  FROM (SELECT DISTINCT city, start_station_id FROM tcells) JOIN tbounds USING (city)),
tpanel AS (
  SELECT g.city, g.start_station_id, g.hour_ts, CAST(coalesce(c.demand, 0) AS BIGINT) AS demand,
    CAST(hour(g.hour_ts) AS INT) AS hour, CAST(isodow(g.hour_ts) - 1 AS INT) AS weekday,
    CAST(isodow(g.hour_ts) >= 6 AS INT) AS weekend,
    m.* EXCLUDE (city, start_station_id), w.* EXCLUDE (city, hour_ts, holiday, working_day),
    CAST(coalesce(w.holiday, 0) AS INT) AS holiday,
    CAST(coalesce(w.working_day, 1) AS INT) AS working_day
  FROM tgrid g
  LEFT JOIN tcells c USING (city, start_station_id, hour_ts)
  LEFT JOIN tmeta m ON g.city = m.city AND g.start_station_id = m.start_station_id
  LEFT JOIN thours w ON g.city = w.city AND g.hour_ts = w.hour_ts)"""


def _r(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


def _stat(prefix: str, std: bool = False) -> str:
    parts = [
        _r("avg(demand)", f"{prefix}_mean_demand"),
        _r("median(demand)", f"{prefix}_median_demand"),
        f"max(demand) AS {prefix}_max_demand",
    ]
    if std:
        parts.append(_r("coalesce(stddev_samp(demand), 0)", f"{prefix}_std_demand"))
    return ", ".join(parts)


def _stats(suffix: str = "", source: str = "tpanel") -> str:
    """Unrounded statistic tables of the training panel."""

    def full(prefix: str) -> str:
        return (
            f"avg(demand) AS {prefix}_mean_demand, median(demand) AS {prefix}_median_demand, "
            f"max(demand) AS {prefix}_max_demand"
        )

    return f"""
st_station AS (SELECT city, start_station_id, {full("station")} FROM {source} GROUP BY 1, 2),
st_city_hour AS (SELECT city, hour, {full("city_hour")} FROM {source} GROUP BY 1, 2),
st_city_weekday AS (
  SELECT city, weekday, avg(demand) AS city_weekday_mean_demand FROM {source} GROUP BY 1, 2),
st_city AS (SELECT city, avg(demand) AS city_mean_demand FROM {source} GROUP BY 1),
st_ts AS (
  SELECT city, start_station_id, hour_ts, {full("station_hour")},
    coalesce(stddev_samp(demand), 0) AS station_hour_std_demand
  FROM {source} GROUP BY 1, 2, 3)"""


_LAGS = """
lagged AS (
  SELECT p.*, h1.demand AS l1, h7.demand AS l7, h14.demand AS l14, h21.demand AS l21
  FROM {source} p
  LEFT JOIN {history} h1 ON p.city = h1.city AND p.start_station_id = h1.start_station_id
    AND h1.hour_ts = p.hour_ts - INTERVAL 1 DAY
  LEFT JOIN {history} h7 ON p.city = h7.city AND p.start_station_id = h7.start_station_id
    AND h7.hour_ts = p.hour_ts - INTERVAL 7 DAY
  LEFT JOIN {history} h14 ON p.city = h14.city AND p.start_station_id = h14.start_station_id
    AND h14.hour_ts = p.hour_ts - INTERVAL 14 DAY
  LEFT JOIN {history} h21 ON p.city = h21.city AND p.start_station_id = h21.start_station_id
    AND h21.hour_ts = p.hour_ts - INTERVAL 21 DAY)"""

_LAG_COLUMNS = """CAST(coalesce(l1, 0) AS DOUBLE) AS lag_1d_demand,
  CAST(coalesce(l7, 0) AS DOUBLE) AS lag_7d_demand,
  CAST(coalesce(l14, 0) AS DOUBLE) AS lag_14d_demand,
  CAST(coalesce(l21, 0) AS DOUBLE) AS lag_21d_demand,
  {mean} AS lag_rolling_mean"""
_LAG_MEAN = """coalesce(
    (coalesce(l7, 0) + coalesce(l14, 0) + coalesce(l21, 0))
    / nullif(CAST(l7 IS NOT NULL AS INT) + CAST(l14 IS NOT NULL AS INT)
             + CAST(l21 IS NOT NULL AS INT), 0)::DOUBLE, 0.0)"""


def _lags(source: str, history: str = "tcells") -> str:
    return _LAGS.format(source=source, history=history)


def _unit(x: str) -> str:
    return f"CASE WHEN {x} < 0 THEN 0.0 WHEN {x} > 1 THEN 1.0 ELSE {x} END"


def _positive(x: str) -> str:
    return f"CASE WHEN {x} < 0 THEN 0.0 ELSE {x} END"


_HUMID = _unit("1.0 - abs(relative_humidity_2m - 50.0) / 50.0")
_CLOUD = _unit("cloud_cover / 100.0")
_COMFORT = f"""(0.5 * exp(-((apparent_temperature - 18.0) * (apparent_temperature - 18.0)) / 288.0)
  + 0.3 * ({_HUMID}) + 0.2 * (1.0 - ({_CLOUD})))"""
_OUTDOOR = f"""(exp(-({_positive("rain")}) / 2.0) * exp(-({_positive("snowfall")}) * 5.0)
  * exp(-({_positive("wind_speed_10m")}) / 25.0))"""
_PARKS = "(park_area_500m / 100000.0 + bike_lane_length_500m / 10000.0)"


def _features(min_rides: int) -> str:
    """The training features, unrounded, one CTE named ``features``."""
    return f"""WITH {_training(min_rides)},{_stats()},{_lags("tpanel")},
encoding AS (
  SELECT city, row_number() OVER (ORDER BY city) - 1 AS city_index
  FROM (SELECT DISTINCT city FROM tpanel)),
joined AS (
  SELECT l.*, {_LAG_COLUMNS.format(mean=_LAG_MEAN)}, e.city_index,
    s.* EXCLUDE (city, start_station_id), ch.* EXCLUDE (city, hour),
    cw.city_weekday_mean_demand, ci.city_mean_demand,
    t.* EXCLUDE (city, start_station_id, hour_ts),
    {_COMFORT} AS comfort_score, {_OUTDOOR} AS outdoor_pleasantness,
    {_PARKS} AS recreational_accessibility,
    CAST(l.hour BETWEEN 7 AND 9 AS INT) AS is_morning_rush,
    CAST(l.hour BETWEEN 17 AND 19 AS INT) AS is_evening_rush
  FROM lagged l
  LEFT JOIN st_station s ON l.city = s.city AND l.start_station_id = s.start_station_id
  LEFT JOIN st_city_hour ch ON l.city = ch.city AND l.hour = ch.hour
  LEFT JOIN st_city_weekday cw ON l.city = cw.city AND l.weekday = cw.weekday
  LEFT JOIN st_city ci ON l.city = ci.city
  LEFT JOIN st_ts t ON l.city = t.city AND l.start_station_id = t.start_station_id
    AND l.hour_ts = t.hour_ts
  LEFT JOIN encoding e ON l.city = e.city),
features AS (
  SELECT *, CASE WHEN is_morning_rush + is_evening_rush = 0 THEN 0.0
                 WHEN station_hour_mean_demand > 3 THEN 3.0
                 ELSE station_hour_mean_demand END AS rush_x_station_hour_mean
  FROM joined)"""


_HELD_OUT = """
early AS (
  SELECT * FROM tpanel WHERE hour_ts < (SELECT max(hour_ts) FROM tcells) - INTERVAL 7 DAY
    AND city || start_station_id IN (
      SELECT city || start_station_id FROM tcells
      WHERE hour_ts < (SELECT max(hour_ts) FROM tcells) - INTERVAL 7 DAY))"""


def _zeroed(prefix: str, std: bool = False) -> str:
    kinds = ["mean", "median", "max", *(["std"] if std else [])]
    names = [f"{prefix}_{k}_demand" for k in kinds]
    return ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)


def _future(hours: int) -> str:
    """Features of the hours after the last ride, unrounded, in a CTE named ``features``."""
    return f"""WITH {_training(1, _BUSY)},{_HELD_OUT},{_stats(source="early")},
st_hod AS (
  SELECT city, start_station_id, hour, avg(demand) AS station_hour_mean_demand,
    median(demand) AS station_hour_median_demand, max(demand) AS station_hour_max_demand,
    coalesce(stddev_samp(demand), 0) AS station_hour_std_demand
  FROM early GROUP BY 1, 2, 3),
ahead AS (
  SELECT m.*, unnest(generate_series(hi + INTERVAL 1 HOUR, hi + to_hours({hours}), INTERVAL 1 HOUR)) AS hour_ts
  FROM tmeta m JOIN tbounds b ON m.city = b.city),
fpanel AS (
  SELECT a.*, CAST(hour(a.hour_ts) AS INT) AS hour, CAST(isodow(a.hour_ts) - 1 AS INT) AS weekday,
    CAST(isodow(a.hour_ts) >= 6 AS INT) AS weekend, 0 AS holiday,
    CAST(isodow(a.hour_ts) < 6 AS INT) AS working_day,
    w.* EXCLUDE (city, hour_ts, holiday, working_day)
  FROM ahead a LEFT JOIN thours w ON a.city = w.city AND a.hour_ts = w.hour_ts + INTERVAL 7 DAY),
{_lags("fpanel").strip()},
encoding AS (
  SELECT city, row_number() OVER (ORDER BY city) - 1 AS city_index
  FROM (SELECT DISTINCT city FROM tpanel)),
joined AS (
  SELECT l.*, {_LAG_COLUMNS.format(mean=_LAG_MEAN)}, e.city_index,
    {_zeroed("station")}, {_zeroed("city_hour")}, {_zeroed("station_hour", True)},
    coalesce(cw.city_weekday_mean_demand, 0) AS city_weekday_mean_demand,
    coalesce(ci.city_mean_demand, 0) AS city_mean_demand,
    {_COMFORT} AS comfort_score, {_OUTDOOR} AS outdoor_pleasantness,
    {_PARKS} AS recreational_accessibility,
    CAST(l.hour BETWEEN 7 AND 9 AS INT) AS is_morning_rush,
    CAST(l.hour BETWEEN 17 AND 19 AS INT) AS is_evening_rush
  FROM lagged l
  LEFT JOIN st_station s ON l.city = s.city AND l.start_station_id = s.start_station_id
  LEFT JOIN st_city_hour ch ON l.city = ch.city AND l.hour = ch.hour
  LEFT JOIN st_city_weekday cw ON l.city = cw.city AND l.weekday = cw.weekday
  LEFT JOIN st_city ci ON l.city = ci.city
  LEFT JOIN st_hod t ON l.city = t.city AND l.start_station_id = t.start_station_id
    AND l.hour = t.hour
  LEFT JOIN encoding e ON l.city = e.city),
features AS (
  SELECT *, CASE WHEN is_morning_rush + is_evening_rush = 0 THEN 0.0
                 WHEN station_hour_mean_demand > 3 THEN 3.0
                 ELSE station_hour_mean_demand END AS rush_x_station_hour_mean
  FROM joined)"""


# FE6: attributes that are null become zero; the weather scores stay null.
_ZERO_IF_NULL = {
    "working_day",
    "office_poi_count_1000m",
    "retail_poi_count_1000m",
    "restaurant_cafe_count_500m",
    "transit_stop_count_500m",
    "distance_to_nearest_rail_station",
    "distance_to_city_center",
}


def _matrix_columns() -> str:
    out = []
    for c in FEATURE_COLUMNS:
        expr = "city_index" if c == "city" else c
        if c in _ZERO_IF_NULL:
            expr = f"coalesce({c}, 0)"
        out.append(_r(expr, c))
    return ", ".join(out)


# --- scoring ---------------------------------------------------------------------------


def _scoring() -> str:
    """Labels and four prediction sets over the full panel of all cities."""
    return f"""WITH {_training(1, _BUSY)},{_stats()},{_lags("tpanel")},
labels AS (
  SELECT row_number() OVER (ORDER BY city, start_station_id, hour_ts) - 1 AS id,
    city, start_station_id, hour_ts AS target_hour_start, hour, weekday, demand, l7
  FROM lagged),
predictions AS (
  SELECT 'const100' AS model, id, 100.0::DOUBLE AS prediction FROM labels
  UNION ALL
  SELECT 'city_hour_mean', id, city_hour_mean_demand FROM labels
    JOIN st_city_hour USING (city, hour)
  UNION ALL
  SELECT 'lag7', id, CAST(coalesce(l7, 0) AS DOUBLE) FROM labels
  UNION ALL
  SELECT 'signed', id, CAST(0.5 AS DOUBLE) * city_hour_mean_demand
    + CAST(0.6 AS DOUBLE) * CAST(coalesce(l7, 0) AS DOUBLE)
    + CAST(id % 5 AS DOUBLE) - CAST(2.25 AS DOUBLE) FROM labels
    JOIN st_city_hour USING (city, hour)),
clipped AS (
  SELECT p.model, l.*, p.prediction,
    CASE WHEN p.prediction < 0 THEN 0.0 ELSE p.prediction END AS prediction_clipped
  FROM labels l JOIN predictions p USING (id)),
scored AS (
  SELECT *, demand - prediction_clipped AS signed_error,
    abs(demand - prediction_clipped) AS abs_error,
    (demand - prediction_clipped) * (demand - prediction_clipped) AS squared_error
  FROM clipped)"""


def _diag(model: str = "signed") -> str:
    return _scoring() + f",\nd AS (SELECT * FROM scored WHERE model = '{model}')"


_BUCKETS = """CASE WHEN demand <= 0 THEN 0 WHEN demand <= 1 THEN 1 WHEN demand <= 2 THEN 2
  WHEN demand <= 3 THEN 3 WHEN demand <= 5 THEN 4 WHEN demand <= 10 THEN 5
  WHEN demand <= 20 THEN 6 WHEN demand <= 200 THEN 7 END"""
_BUCKET_NAMES = "['0', '1', '2', '3', '4-5', '6-10', '11-20', '>20']"


def _histogram(name: str, bins: int, low: float, high: float) -> str:
    width = (high - low) / bins
    return f"""
SELECT '{name}' AS histogram, CAST(b.bin AS INT) AS bin,
  CAST({low} + b.bin * {width} AS DOUBLE) AS bin_start,
  CAST({low} + (b.bin + 1) * {width} AS DOUBLE) AS bin_end, count(x) AS count
FROM (SELECT unnest(range({bins})) AS bin) b
LEFT JOIN (SELECT CAST({name} AS DOUBLE) AS x FROM d) v
  ON (x >= {low} + b.bin * {width} AND x < {low} + (b.bin + 1) * {width})
  OR (b.bin = {bins - 1} AND x = {high})
GROUP BY b.bin"""


def oracle_queries(p: dict) -> dict[str, str]:
    """SQL per query key; ``p`` holds the parameters shared with the Spark side."""
    min_rides, caps, seed = p["min_rides"], p["caps"], p["seed"]
    diag = _diag()
    train = f"WITH {_training(min_rides)}"
    scoring = _scoring()
    probs = ", ".join(repr(q) for q in quantile_points())
    q: dict[str, str] = {}

    # Keys, demand and grids
    q["station_id_normalize"] = f"""WITH {_DENSE}
SELECT start_station_id AS raw, station_key, count(*) AS n FROM keyed GROUP BY 1, 2"""
    q["station_hour_demand"] = f"""WITH {_WIDE} SELECT * FROM cells"""
    q["station_activity"] = f"""WITH {_WIDE}
SELECT city_key, station_key, min(target_hour_start) AS first_active_hour,
  max(target_hour_start) AS last_active_hour, count(*) AS observed_ride_rows,
  count(DISTINCT target_hour_start) AS observed_active_hours
FROM keyed GROUP BY 1, 2"""
    q["grid_full"] = f"WITH {_WIDE},{_FULL_GRID},{_filled()} SELECT * FROM filled"
    q["grid_active_window"] = f"WITH {_SPARSE},{_active(0, 0, 72)} SELECT * FROM grid"
    q["grid_active_window_buffered"] = (
        f"WITH {_SPARSE},{_active(24, 24, 72)},{_filled()} SELECT * FROM filled"
    )
    q["grid_observed"] = f"""WITH {_WIDE}
SELECT DISTINCT city_key, station_key, target_hour_start FROM keyed"""
    q["panel_keep_hours"] = (
        f"WITH {_SPARSE},{_active(0, 0, 72)}, {_KEPT},{_filled('kept')} SELECT * FROM filled"
    )
    q["panel_cap_hours"] = f"""WITH {_SPARSE},{_active(0, 0, 72)}, {_KEPT},
{_capped("kept", caps, seed)} SELECT * FROM capped"""
    q["station_dim"] = f"WITH {_WIDE},{_DIMS} SELECT * FROM station_dim"
    q["city_hour_dim"] = f"WITH {_WIDE},{_DIMS} SELECT * FROM city_hour_dim"
    q["panel_targets"] = panel_sql(
        "SELECT * EXCLUDE (demand, city_key, station_key) FROM panel", caps, seed
    )
    q["panel_labels"] = panel_sql(
        "SELECT id, city, start_station_id, target_hour_start, demand FROM panel", caps, seed
    )
    q["incremental_panel"] = q["panel_labels"]
    q["unreadable_rides"] = f"""WITH {_WIDE},
good AS (SELECT * FROM keyed WHERE event_id % 89 <> 0)
SELECT (SELECT count(*) FROM keyed) AS rides,
  (SELECT count(*) FROM keyed WHERE event_id % 89 = 0) AS bad,
  count(*) AS demand, count(DISTINCT (city_key, station_key, target_hour_start)) AS n_rows FROM good"""
    q["hidden_test_sample"] = f"""WITH {_rides("user_id")},
cells AS (
  SELECT city, start_station_id, date_trunc('hour', started_at) AS target_hour_start,
    {_firsts([*_STATION_ATTRS, *_CITY_HOUR])}
  FROM rides GROUP BY 1, 2, 3),
firsts AS (
  SELECT row_number() OVER (ORDER BY city NULLS LAST, start_station_id NULLS LAST,
    target_hour_start) - 1 AS id, * FROM cells)
SELECT *, target_hour_start AS hour_ts, CAST(hour(target_hour_start) AS INT) AS hour,
  CAST(isodow(target_hour_start) - 1 AS INT) AS weekday,
  strftime(target_hour_start, '%Y-%m-%d') AS date,
  CAST(isodow(target_hour_start) >= 6 AS INT) AS weekend
FROM firsts WHERE id < 128"""

    # Training
    q["major_cities"] = f"""SELECT event_type AS city, count(*) AS n_rides
FROM events GROUP BY 1 HAVING count(*) >= {min_rides}"""
    q["train_panel"] = f"{train} SELECT * FROM tpanel"
    q["stats_station"] = (
        f"{train} SELECT city, start_station_id, {_stat('station')} FROM tpanel GROUP BY 1, 2"
    )
    q["stats_city_hour"] = (
        f"{train} SELECT city, hour, {_stat('city_hour')} FROM tpanel GROUP BY 1, 2"
    )
    q["stats_city_weekday"] = f"""{train} SELECT city, weekday,
{_r("avg(demand)", "city_weekday_mean_demand")} FROM tpanel GROUP BY 1, 2"""
    q["stats_city"] = f"""{train}
SELECT city, {_r("avg(demand)", "city_mean_demand")} FROM tpanel GROUP BY 1"""
    q["stats_station_ts"] = f"""{train} SELECT city, start_station_id, hour_ts,
{_stat("station_hour", std=True)} FROM tpanel GROUP BY 1, 2, 3"""
    q["stats_station_hod"] = f"""{train} SELECT city, start_station_id, hour,
{_stat("station_hour", std=True)} FROM tpanel GROUP BY 1, 2, 3"""
    q["stats_held_out"] = f"""{train},{_HELD_OUT}
SELECT city, start_station_id, {_stat("station")} FROM early GROUP BY 1, 2"""
    q["demand_history"] = (
        f"{train} SELECT city, start_station_id, hour_ts, demand FROM tcells"
    )
    mean = f"round({_LAG_MEAN}, 6)"
    lag_select = _LAG_COLUMNS.format(mean=mean)
    q["lag_features"] = f"""{train},{_lags("tgrid")}
SELECT city, start_station_id, hour_ts, {lag_select} FROM lagged"""
    q["lag_features_dense"] = f"""{train},{_lags("tpanel")}
SELECT city, start_station_id, hour_ts, demand, {lag_select} FROM lagged"""
    q["stat_features"] = f"""{_features(min_rides)}
SELECT city, start_station_id, hour_ts, {
        ", ".join(
            _r(c, c)
            for c in FEATURE_COLUMNS
            if c.endswith("_demand") and not c.startswith("lag_")
        )
    } FROM features"""
    q["weather_features"] = f"""{train} SELECT city, start_station_id, hour_ts,
{_r(_COMFORT, "comfort_score")}, {_r(_OUTDOOR, "outdoor_pleasantness")},
{_r(_PARKS, "recreational_accessibility")} FROM tpanel"""
    q["rush_features"] = f"""{_features(min_rides)}
SELECT city, start_station_id, hour_ts, is_morning_rush, is_evening_rush,
  {_r("rush_x_station_hour_mean", "rush_x_station_hour_mean")} FROM features"""
    q["cyclic_features"] = f"""{train} SELECT city, start_station_id, hour_ts,
  CAST(month(hour_ts) AS INT) AS month, CAST(day(hour_ts) AS INT) AS day,
  CAST(dayofyear(hour_ts) AS INT) AS day_of_year,
  {_r("sin(2 * pi() * hour / 24)", "hour_sin")}, {_r("cos(2 * pi() * hour / 24)", "hour_cos")},
  {_r("sin(2 * pi() * weekday / 7)", "weekday_sin")},
  {_r("cos(2 * pi() * weekday / 7)", "weekday_cos")},
  CAST(hour * weekend AS INT) AS hour_x_weekend, CAST(hour * weekday AS INT) AS hour_x_weekday,
  CAST(weekday * holiday AS INT) AS weekday_x_holiday FROM tpanel"""
    q["city_encoding"] = f"""{train}
SELECT city, row_number() OVER (ORDER BY city) - 1 AS city_index
FROM (SELECT DISTINCT city FROM tcells)"""
    q["feature_matrix"] = f"""{_features(min_rides)}
SELECT start_station_id, hour_ts, demand, {_matrix_columns()} FROM features"""
    q["target_features"] = f"""{_features(min_rides)}
SELECT start_station_id, hour_ts, {_matrix_columns()} FROM features"""
    q["time_split_profile"] = f"""{train},
split AS (
  SELECT *, hour_ts >= (SELECT max(hour_ts) FROM tpanel) - INTERVAL 7 DAY AS validation FROM tpanel)
SELECT validation, count(*) AS n_rows, {_r("avg(demand)", "mean_demand")},
  {_r("median(demand)", "median_demand")}, max(demand) AS max_demand,
  {_r("avg(CAST(demand = 0 AS INT))", "zero_share")}
FROM split GROUP BY 1"""
    q["train_profile"] = f"""{train}
SELECT count(*) AS n_rows, {_r("avg(demand)", "mean_demand")},
  {_r("median(demand)", "median_demand")}, max(demand) AS max_demand,
  {_r("avg(CAST(demand = 0 AS INT))", "zero_share")} FROM tpanel"""
    q["holdout_mae"] = f"""{scoring}
SELECT model, {_r("avg(abs(prediction - demand))", "validation_mae")}, count(*) AS n_rows
FROM scored
WHERE target_hour_start >= (SELECT max(target_hour_start) FROM labels) - INTERVAL 7 DAY
GROUP BY 1"""

    def deviance(mean: str) -> str:
        mean = f"greatest(CAST({mean} AS DOUBLE), 0.01)"
        return (
            f"avg(2 * (pow(demand, 0.7) / (-0.3 * 0.7) - demand * pow({mean}, -0.3) / -0.3 "
            f"+ pow({mean}, 0.7) / 0.7))"
        )

    q["model_baselines"] = f"""WITH {_training(1, _BUSY)},{_lags("tpanel")},{_HELD_OUT},
{_stats(source="early").strip()}
SELECT count(*) AS n_rows, {_r("avg(demand)", "zero_mae")},
  {_r("avg(abs(demand - coalesce(l7, 0)))", "lag7_mae")},
  {_r("avg(abs(demand - city_hour_mean_demand))", "city_hour_mae")},
  {_r(deviance("coalesce(l7, 0)"), "lag7_deviance")},
  {_r(deviance("city_hour_mean_demand"), "city_hour_deviance")}
FROM lagged l JOIN st_city_hour ch ON l.city = ch.city AND l.hour = ch.hour
WHERE hour_ts >= (SELECT max(hour_ts) FROM tpanel) - INTERVAL 7 DAY"""
    q["future_features"] = f"""{_future(48)}
SELECT start_station_id, hour_ts, {_matrix_columns()} FROM features"""

    # Scoring
    rounded = ", ".join(
        _r(c, c)
        for c in ["prediction", "prediction_clipped", "signed_error", "abs_error", "squared_error"]
    )
    q["score_rows"] = f"{scoring} SELECT model, id, city, demand, {rounded} FROM scored"
    metrics = ", ".join(
        [
            "count(*) AS n_rows",
            _r("avg(abs_error)", "mae"),
            _r("sqrt(avg(squared_error))", "rmse"),
            _r("avg(demand)", "mean_true_demand"),
            _r("avg(prediction_clipped)", "mean_prediction"),
        ]
    )
    negative = "CAST(sum(CAST(prediction < 0 AS INT)) AS BIGINT)"
    board = f"""
SELECT model, city, {metrics}, CAST(NULL AS BIGINT) AS negative_predictions_before_clipping
FROM scored GROUP BY 1, 2
UNION ALL
SELECT model, 'OVERALL', {metrics}, {negative} FROM scored GROUP BY 1"""
    q["score_by_city"] = f"{scoring} {board}"
    q["leaderboard"] = q["score_by_city"]
    q["id_contracts"] = f"""{scoring}, targets AS (SELECT id FROM labels WHERE id > 0
  UNION ALL SELECT 1),
both_ids AS (
  SELECT coalesce(t.id, l.id) AS id, coalesce(nt, 0) AS nt, coalesce(nl, 0) AS nl
  FROM (SELECT id, count(*) AS nt FROM targets GROUP BY 1) t
  FULL JOIN (SELECT id, count(*) AS nl FROM labels GROUP BY 1) l ON t.id = l.id),
c AS (
  SELECT unnest(['target_ids_unique', 'label_ids_unique', 'label_ids_in_targets',
    'target_ids_in_labels']) AS "check",
    unnest([count(*) FILTER (WHERE nt > 1), count(*) FILTER (WHERE nl > 1),
      count(*) FILTER (WHERE nt = 0), count(*) FILTER (WHERE nl = 0)]) AS bad_rows
  FROM both_ids)
SELECT "check", CAST(NULL AS VARCHAR) AS model, bad_rows = 0 AS ok, bad_rows FROM c"""
    contract = f"""{scoring},
raw AS (
  SELECT 'ok' AS model, id, CAST(prediction AS VARCHAR) AS p FROM predictions WHERE model = 'lag7'
  UNION ALL SELECT 'missing_ids', id, '1.0' FROM labels WHERE id % 10 <> 0
  UNION ALL SELECT 'duplicate_ids', id, '1.0' FROM labels
  UNION ALL SELECT 'duplicate_ids', id, '2.0' FROM labels WHERE id % 3 = 0
  UNION ALL SELECT 'extra_ids', id, '1.0' FROM labels
  UNION ALL SELECT 'extra_ids', id + 1000000000, '1.0' FROM labels WHERE id % 7 = 0
  UNION ALL SELECT 'nan', id, CASE WHEN id % 5 = 0 THEN 'NaN' ELSE '1.0' END FROM labels
  UNION ALL SELECT 'non_numeric', id, CASE WHEN id % 4 = 0 THEN 'many' ELSE '1.0' END FROM labels
  UNION ALL SELECT 'plus_inf', id, CASE WHEN id % 6 = 0 THEN 'Infinity' ELSE '1.0' END FROM labels
  UNION ALL SELECT 'negative', id, CASE WHEN id % 8 = 0 THEN '-1.0' ELSE '1.0' END FROM labels),
numbers AS (
  SELECT model, id, CASE WHEN isnan(TRY_CAST(p AS DOUBLE)) THEN NULL
    ELSE TRY_CAST(p AS DOUBLE) END AS x FROM raw),
m AS (
  SELECT n.model, count(*) AS n_rows, count(*) FILTER (WHERE x IS NULL) AS bad,
    count(*) FILTER (WHERE isinf(x)) AS infinite, count(*) FILTER (WHERE x < 0) AS negative,
    count(DISTINCT n.id) FILTER (WHERE l.id IS NULL) AS extra, count(DISTINCT l.id) AS covered
  FROM numbers n LEFT JOIN labels l ON n.id = l.id GROUP BY 1),
dup AS (
  SELECT model, count(*) FILTER (WHERE k > 1) AS dups
  FROM (SELECT model, id, count(*) AS k FROM numbers GROUP BY 1, 2) GROUP BY 1),
total AS (SELECT count(*) AS n FROM labels),
c AS (
  SELECT m.model,
    unnest(['row_count', 'numeric', 'prediction_ids_unique', 'no_extra_ids', 'no_missing_ids',
      'finite', 'non_negative']) AS "check",
    unnest([abs(n_rows - n), bad, dups, extra, n - covered, infinite, negative]) AS bad_rows,
    unnest([1, 2, 3, 4, 5, 6, 7]) AS pos
  FROM m JOIN dup USING (model), total)"""
    q["contract_report"] = f"""{contract}
SELECT "check", model, bad_rows = 0 AS ok, CAST(bad_rows AS BIGINT) AS bad_rows FROM c
UNION ALL
SELECT unnest(['target_columns', 'label_columns', 'no_leaking_columns', 'station_identifier',
  'target_time', 'target_ids_unique', 'label_ids_unique', 'label_ids_in_targets',
  'target_ids_in_labels']), NULL, TRUE, 0"""
    q["prediction_repro"] = f"""{scoring},
second AS (
  SELECT model, id, CASE WHEN model = 'signed' AND id % 9 = 0 THEN prediction + 0.01
    ELSE prediction * (1 + 1e-7) END AS b
  FROM predictions WHERE NOT (model = 'lag7' AND id % 11 = 0)),
c AS (
  SELECT model, count(*) FILTER (
    WHERE NOT coalesce(abs(prediction - b) <= 1e-8 + 1e-5 * abs(b), FALSE)) AS bad_rows
  FROM predictions LEFT JOIN second USING (model, id) GROUP BY 1)
SELECT 'repeatable' AS "check", model, bad_rows = 0 AS ok, bad_rows FROM c"""
    q["changed_predictions"] = f"""{scoring},
f AS (SELECT id FROM predictions WHERE model = 'signed')
SELECT id, 'only_first' AS status FROM f WHERE id % 4001 = 7
UNION ALL SELECT id, 'changed' FROM f WHERE id % 4001 <> 7 AND id % 3001 = 5
UNION ALL SELECT -id - 1, 'only_second' FROM f WHERE id % 5003 = 9"""
    q["model_failures"] = f"""{contract}
SELECT model, string_agg("check", ',' ORDER BY pos) AS error
FROM c WHERE bad_rows > 0 AND pos <= 5 GROUP BY 1"""

    # Diagnostics
    base = [
        _r("avg(abs_error)", "mae"),
        _r("sqrt(avg(squared_error))", "rmse"),
        _r("avg(demand)", "mean_true"),
        _r("avg(prediction_clipped)", "mean_pred"),
    ]
    mae, rmse, mean_true, mean_pred = base
    summary = ", ".join(
        [
            *base,
            _r("avg(prediction_clipped) - avg(demand)", "bias"),
            _r("median(abs_error)", "median_abs_error"),
            "count(*) AS n",
        ]
    )
    q["diag_summary"] = f"""{diag}
SELECT city, {summary} FROM d GROUP BY 1 UNION ALL SELECT 'OVERALL', {summary} FROM d"""
    q["diag_by_hour"] = (
        f"{diag} SELECT hour, {', '.join(base)}, count(*) AS n FROM d GROUP BY 1"
    )
    q["diag_by_city"] = f"""{diag} SELECT city, {mae}, {_r("avg(signed_error)", "bias")},
{mean_true}, {mean_pred} FROM d GROUP BY 1"""
    q["diag_by_weekday"] = f"""{diag}
SELECT weekday, dayname(target_hour_start) AS weekday_name, {mae}, {mean_true}, {mean_pred},
  count(*) AS n FROM d GROUP BY 1, 2"""
    q["calib_by_pred"] = f"""{diag}, b AS (
  SELECT *, CASE WHEN prediction_clipped = 0 THEN 0
    WHEN prediction_clipped <= 25 THEN CAST(ceil(prediction_clipped) AS INT) - 1 END AS pred_bin
  FROM d)
SELECT pred_bin, {mean_pred}, {mean_true}, count(*) AS count
FROM b WHERE pred_bin IS NOT NULL GROUP BY 1 HAVING count(*) > 50"""
    q["calib_by_true"] = f"""{diag}
SELECT CAST(demand AS INT) AS true_bin, {mean_pred},
  {_r("stddev_samp(prediction_clipped)", "std_pred")}, count(*) AS count
FROM d WHERE demand BETWEEN 0 AND 30 GROUP BY 1 HAVING count(*) > 20"""
    q["error_by_bucket"] = f"""{diag}, b AS (SELECT *, {_BUCKETS} AS bucket FROM d)
SELECT bucket, ({_BUCKET_NAMES})[bucket + 1] AS label, count(*) AS n, {mae}, {mean_true}, {mean_pred}
FROM b WHERE bucket IS NOT NULL GROUP BY 1"""
    q["hist_errors"] = (
        diag
        + " UNION ALL ".join(
            _histogram(*spec)
            for spec in [
                ("abs_error", 80, 0.0, 20.0),
                ("signed_error", 80, -10.0, 10.0),
                ("demand", 60, 0.0, 30.0),
                ("prediction_clipped", 60, 0.0, 30.0),
            ]
        )
    )
    q["qq_points"] = f"""{diag}, probs AS (SELECT [{probs}] AS qs),
a AS (
  SELECT quantile_cont(CAST(demand AS DOUBLE), [{probs}]) AS t,
         quantile_cont(prediction_clipped, [{probs}]) AS p FROM d)
SELECT round(CAST(unnest(qs) AS DOUBLE), 9) AS q, round(unnest(t), 6) AS true_quantile,
  round(unnest(p), 6) AS pred_quantile FROM a, probs"""
    q["sketched_quantiles"] = f"""{diag},
c AS (SELECT city, count(*) AS n FROM d GROUP BY 1 UNION ALL SELECT 'OVERALL', count(*) FROM d)
SELECT city, CAST(unnest([0.01, 0.25, 0.5, 0.75, 0.9, 0.99]) AS DOUBLE) AS q, n, TRUE AS within_bound FROM c"""
    q["zero_segments"] = f"""{diag} SELECT
  {_r("avg(CAST(demand = 0 AS INT))", "zero_share_true")},
  {_r("avg(CAST(prediction_clipped = 0 AS INT))", "zero_share_pred")},
  {_r("avg(abs_error) FILTER (WHERE demand = 0)", "mae_zero")},
  {_r("avg(prediction_clipped) FILTER (WHERE demand = 0)", "mean_pred_zero")},
  {_r("avg(CAST(prediction_clipped = 0 AS INT)) FILTER (WHERE demand = 0)", "zero_correct_share")},
  {_r("avg(abs_error) FILTER (WHERE demand <> 0)", "mae_nonzero")},
  {_r("avg(prediction_clipped) FILTER (WHERE demand <> 0)", "mean_pred_nonzero")}
FROM d"""
    q["day_night_mae"] = f"""{diag} SELECT
  {_r("avg(abs_error) FILTER (WHERE hour <= 4 OR hour >= 22)", "mae_night")},
  {_r("avg(abs_error) FILTER (WHERE hour BETWEEN 6 AND 21)", "mae_day")} FROM d"""
    ps = ", ".join(
        [
            "count(*) AS n",
            _r("min(prediction)", "min_prediction"),
            _r("max(prediction)", "max_prediction"),
            _r("avg(prediction)", "mean_prediction"),
            _r("avg(demand)", "mean_true"),
            _r("avg(abs(prediction - demand))", "mae"),
            _r("avg(CAST(prediction = 0 AS INT))", "zero_share"),
        ]
    )
    q["prediction_summary"] = f"""{diag}
SELECT city, {ps} FROM d GROUP BY 1 UNION ALL SELECT 'OVERALL', {ps} FROM d"""
    q["best_worst_hours"] = f"""{diag},
h AS (SELECT hour, avg(abs_error) AS m, count(*) AS n FROM d GROUP BY 1),
r AS (
  SELECT *, row_number() OVER (ORDER BY m, hour) AS best,
    row_number() OVER (ORDER BY m DESC, hour DESC) AS worst FROM h)
SELECT 'best' AS side, CAST(best AS INT) AS place, hour, round(m, 6) AS mae, n FROM r WHERE best <= 3
UNION ALL
SELECT 'worst', CAST(worst AS INT), hour, round(m, 6), n FROM r WHERE worst <= 3"""
    q["low_demand_sample"] = f"""{diag}, s AS (
  SELECT * FROM d ORDER BY md5(concat_ws('|', CAST(id AS VARCHAR), '42')), id LIMIT 10000)
SELECT id, demand, {_r("prediction_clipped", "prediction_clipped")} FROM s WHERE demand <= 10"""
    city_hours = f"""WITH {_DENSE},
n AS (SELECT city_key, target_hour_start, count(*) AS n FROM keyed GROUP BY 1, 2)"""
    q["ride_pattern"] = f"""{city_hours}
SELECT city_key, CAST(hour(target_hour_start) AS INT) AS hour, {_r("avg(n)", "mean_rides")}
FROM n GROUP BY 1, 2"""
    q["city_avg"] = f"{city_hours} SELECT city_key, {_r('avg(n)', 'mean_rides')} FROM n GROUP BY 1"
    q["dataset_profile"] = f"""WITH {_WIDE}
SELECT city_key, count(*) AS rides, count(DISTINCT station_key) AS stations,
  min(target_hour_start) AS first_hour, max(target_hour_start) AS last_hour,
  {_r("count(*) / (SELECT count(*) FROM keyed)", "share")}
FROM keyed GROUP BY 1"""

    # Predictors
    q["isolated_predictors"] = f"""{scoring},
made AS (
  SELECT 'rush' AS model, demand, CASE WHEN hour BETWEEN 7 AND 19 THEN 1.0 ELSE 0.25 END AS p FROM labels
  UNION ALL SELECT 'const', demand, 1.0 FROM labels)
SELECT model, count(*) AS n_rows, {_r("avg(abs(demand - p))", "mae")}, CAST(NULL AS VARCHAR) AS raised
FROM made GROUP BY 1
UNION ALL SELECT 'noon', NULL, NULL, 'RuntimeError'
UNION ALL SELECT 'lost', NULL, NULL, 'AnalysisException'"""
    q["predict_constant"] = f"{scoring} SELECT id, 100.0::DOUBLE AS prediction FROM labels"
    q["predict_pandas"] = f"""{scoring}
SELECT id, CASE WHEN hour BETWEEN 7 AND 19 THEN 1.0 ELSE 0.25 END::DOUBLE AS prediction FROM labels"""
    return q
