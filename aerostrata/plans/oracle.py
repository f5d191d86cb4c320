"""The registered queries as plain SQL, for comparison with another engine."""

from __future__ import annotations

from aerostrata.schema import (
    AUDIT_RULES, BREAKPOINTS, CATEGORIES, CATEGORY_ICONS, CATEGORY_UPPER, CLEANING_RULES,
    CLUSTER_MEASURES, COUNT_STEPS, COVERAGE_STEPS, DAILY_MEASURES, INDEX_BREAKS, INDEX_STEPS,
    LABEL_MIDPOINTS, LAGS, PAYLOAD_RULES, POLLUTANTS, ROLLINGS, STREAM_MEASURES, WORST_STEPS,
)

AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
AS_OF_DAY = "DATE '2024-01-30'"
AVERAGED = ["pm25", "pm10", "co", "no2", "so2", "o3", "ispu",
            "temperature", "humidity", "wind_speed", "cloud_cover"]


def _f(x: float) -> str:
    """A number as a double literal."""
    return f"{float(x)!r}e0" if "e" not in repr(float(x)) else repr(float(x))


def _round(expr: str, digits: int) -> str:
    scale = _f(10 ** digits)
    return f"floor(({expr})*{scale}+0.5)/{scale}"


def _sum(col: str, digits: int = 4) -> str:
    return f"CAST(sum(CAST({col} AS DECIMAL(18,{digits}))) AS DOUBLE)"


def _mean(col: str) -> str:
    return f"({_sum(col)}/count({col}))"


def _sub(col: str) -> str:
    pts = BREAKPOINTS[col]
    arms = [f"WHEN {col} IS NULL THEN NULL", f"WHEN {col} <= 0 THEN 0e0"]
    for lo, hi, base, top in zip(pts, pts[1:], INDEX_BREAKS, INDEX_BREAKS[1:]):
        arms.append(f"WHEN {col} <= {_f(hi)} THEN {_f(base)} + {_f(top - base)} * (({col} - {_f(lo)}) / {_f(hi - lo)})")
    return f"CASE {' '.join(arms)} ELSE 500e0 END"


def _category(v: str) -> str:
    arms = [f"WHEN {v} IS NULL THEN NULL"]
    arms += [f"WHEN {v} <= {u} THEN '{c}'" for u, c in zip(CATEGORY_UPPER, CATEGORIES)]
    return f"CASE {' '.join(arms)} ELSE '{CATEGORIES[-1]}' END"


def _case(v: str, pairs: dict, default: str) -> str:
    arms = [f"WHEN {v} = '{k}' THEN {x}" for k, x in pairs.items()]
    return f"CASE {' '.join(arms)} ELSE {default} END"


def _decode(v: str) -> str:
    arms = [f"WHEN CAST(TRY_CAST({v} AS DOUBLE) AS INT) = {i} THEN '{c}'" for i, c in enumerate(sorted(CATEGORIES))]
    return f"CASE {' '.join(arms)} ELSE {v} END"


def _steps(v: str, steps) -> str:
    arms = [f"WHEN {v} >= {b} THEN '{n}'" for b, n in reversed(steps[1:])]
    return f"CASE {' '.join(arms)} ELSE '{steps[0][1]}' END"


READINGS = """
  SELECT event_id, user_id, event_type AS station_id, ts, CAST(ts AS DATE) AS date, k,
    CASE WHEN event_id % 13 = 0 THEN NULL
         ELSE CAST(CAST(value AS DECIMAL(18,2)) * (CASE day(ts) % 4 WHEN 0 THEN 0.25
              WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 5 END) AS DOUBLE) END AS pm25,
    CAST(user_id % 150 AS DOUBLE) AS pm10,
    CAST(CAST(value AS DECIMAL(18,2)) * 20 AS DOUBLE) AS co,
    CAST(CASE WHEN event_id % 41 = 0 THEN 2500 ELSE k END AS DOUBLE) AS no2,
    CAST(k AS DOUBLE) / CAST(2 AS DOUBLE) AS so2,
    CAST(CASE WHEN event_id % 37 = 0 THEN 1100 ELSE event_id % 120 END AS DOUBLE) AS o3,
    CAST(20 + k % 15 AS DOUBLE) AS temperature,
    CAST(CASE WHEN event_id % 23 = 0 THEN k + 100 ELSE k END AS DOUBLE) AS humidity,
    CAST(user_id % 40 AS DOUBLE) AS wind_speed,
    CASE WHEN event_id % 31 <> 0 THEN CAST(event_id % 7 AS DOUBLE) / CAST(2 AS DOUBLE) END AS precipitation,
    CAST(k AS DOUBLE) AS cloud_cover
  FROM (SELECT *, CAST(props->>'k' AS INT) AS k FROM events) e"""


def _indexed(src: str) -> str:
    subs = ", ".join(_sub(c) for c in POLLUTANTS)
    return (f"SELECT *, {_round('raw_index', 1)} AS ispu, {_category('raw_index')} AS ispu_category "
            f"FROM (SELECT *, greatest({subs}) AS raw_index FROM {src})")


_CLEAN = " AND ".join(f"{r.column} BETWEEN {r.low} AND {r.high}" for r in CLEANING_RULES)
_HAVE = {*AVERAGED, "precipitation"}
_RULES = [r for r in PAYLOAD_RULES if r.column in _HAVE]
_VALID = " AND ".join(f"({r.column} IS NULL OR {r.column} BETWEEN {r.low} AND {r.high})" for r in _RULES)


def _measures(index_name: str) -> str:
    out = [f"{_round(_mean(c), 2)} AS {index_name if c == 'ispu' else c + '_avg'}" for c in AVERAGED]
    out.append(f"{_round(_sum('precipitation'), 2)} AS precipitation_sum")
    out.append("count(*) AS record_count")
    return ", ".join(out)


def _daily(src: str) -> str:
    return (f"SELECT *, {_category('ispu')} AS aqi_category FROM "
            f"(SELECT station_id, date, {_measures('ispu')} FROM {src} GROUP BY station_id, date)")


def _windows(src: str) -> str:
    return (f"SELECT station_id, ws AS window_start, ws + INTERVAL 10 MINUTE AS window_end, {_measures('ispu_avg')} "
            f"FROM (SELECT *, unnest([time_bucket(INTERVAL 5 MINUTE, ts), "
            f"time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS ws FROM {src}) GROUP BY station_id, ws")


VOLUME = """
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS station_id, l_shipdate AS ts, CAST(l_shipdate AS DATE) AS date,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 4 END AS pm25,
    CAST(l_partkey % 500 AS DOUBLE) AS pm10, l_extendedprice / 2 AS co,
    CAST(l_orderkey % 900 AS DOUBLE) AS no2, CAST(l_orderkey % 700 AS DOUBLE) AS so2,
    CAST(l_partkey % 1000 AS DOUBLE) AS o3, l_quantity - 10 AS temperature, l_quantity * 2 AS humidity,
    l_tax * 1000 AS wind_speed, l_discount * 100 AS precipitation, l_discount * 1000 AS cloud_cover
  FROM lineitem"""

SERIES = """
  SELECT station_id, date,
    CASE WHEN c % 11 = 0 THEN NULL ELSE CAST(p % 6000 AS DOUBLE) / 10 END AS pm25_avg,
    CASE WHEN c % 7 = 0 THEN NULL ELSE CAST(c % 600 AS DOUBLE) END AS pm10_avg,
    CAST(p % 40000 AS DOUBLE) AS co_avg, CAST(o % 1500 AS DOUBLE) AS no2_avg,
    CAST(c % 900 AS DOUBLE) AS so2_avg, CAST(o % 700 AS DOUBLE) AS o3_avg,
    CAST(p % 4500 AS DOUBLE) / 10 AS ispu, CAST(c % 40 AS DOUBLE) AS temperature_avg,
    CASE WHEN o % 9 = 0 THEN NULL ELSE CAST(o % 100 AS DOUBLE) END AS humidity_avg,
    CAST(c % 30 AS DOUBLE) AS wind_speed_avg, CAST(o % 50 AS DOUBLE) / 2 AS precipitation_sum,
    CAST(c % 100 AS DOUBLE) AS cloud_cover_avg, record_count
  FROM (SELECT o_orderpriority AS station_id, CAST(o_orderdate AS DATE) AS date,
          CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS p,
          CAST(sum(o_custkey) AS BIGINT) AS c, CAST(sum(o_orderkey) AS BIGINT) AS o,
          count(*) AS record_count
        FROM orders GROUP BY 1, 2)"""

PREDICTIONS = """
  SELECT event_id, event_type AS station_id, CAST(ts AS DATE) AS window_start,
    CAST(k % 5 AS VARCHAR) AS predicted_label, CAST(k AS DOUBLE) / 100 AS confidence,
    'v' || CAST(user_id % 3 AS VARCHAR) AS model_version, ts AS created_at
  FROM (SELECT *, CAST(props->>'k' AS INT) AS k FROM events) e"""

LOGS = """
  SELECT 'run_' || user_id AS file, event_id AS pos,
    CASE k % 8
      WHEN 0 THEN stamp || ' [INFO] etl - Batch ETL mulai'
      WHEN 1 THEN stamp || ' [INFO] etl - Insert ' || event_id || ' baris'
      WHEN 2 THEN stamp || ' [INFO] etl - Batch ETL selesai'
      WHEN 3 THEN stamp || ' [INFO] ml - RF accuracy: 0.' || k || ', f1: 0.' || user_id
      WHEN 4 THEN stamp || ' [WARNING] etl - range'
      WHEN 5 THEN '__METRICS__:{"rows":' || event_id || ',"ok":true}'
      WHEN 6 THEN '__METRICS__:{broken'
      ELSE 'noise ' || event_id END AS text
  FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM readings)"""

AUDIT = """
  SELECT o_orderpriority AS dag_id, CAST(o_orderkey AS VARCHAR) AS run_id, 'RUNNING' AS status,
    CAST(0 AS BIGINT) AS records_in, o_orderdate AS event_time FROM orders
  UNION ALL
  SELECT o_orderpriority, CAST(o_orderkey AS VARCHAR),
    CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END, o_custkey,
    o_orderdate + to_minutes(CAST(o_custkey % 240 AS INTEGER))
  FROM orders WHERE o_orderstatus <> 'P'"""

# Named relations in dependency order; a query is given the ones it mentions.
RELATIONS = {
    "readings": READINGS,
    "indexed": _indexed("readings"),
    "ranged": f"SELECT * FROM indexed WHERE {_CLEAN}",
    "clean": f"SELECT * FROM indexed WHERE {_CLEAN} AND event_id % 47 <> 0 AND precipitation IS NOT NULL",
    "valid": f"SELECT * FROM indexed WHERE {_VALID}",
    "daily": _daily("clean"),
    "windows": _windows("valid"),
    "series": SERIES,
    "labelled_series": f"SELECT *, {_category('ispu')} AS aqi_category FROM series",
    "predictions": PREDICTIONS,
    "logs": LOGS,
    "audit": AUDIT,
    "runs": """SELECT * FROM audit QUALIFY row_number() OVER (PARTITION BY dag_id, run_id
        ORDER BY CASE WHEN status = 'RUNNING' THEN 0 ELSE 1 END DESC, event_time DESC) = 1""",
    "durations": """SELECT dag_id, run_id, started_at, finished_at,
        date_diff('second', started_at, finished_at) AS seconds, coalesce(final, 'RUNNING') AS status
        FROM (SELECT dag_id, run_id, min(event_time) AS started_at,
          max(CASE WHEN status <> 'RUNNING' THEN event_time END) AS finished_at,
          max(CASE WHEN status <> 'RUNNING' THEN status END) AS final
          FROM audit GROUP BY dag_id, run_id)""",
    "recent": f"SELECT * FROM windows WHERE window_start BETWEEN {AS_OF} - INTERVAL 24 HOUR AND {AS_OF}",
    "week": f"SELECT * FROM daily WHERE date BETWEEN {AS_OF_DAY} - INTERVAL 7 DAY AND {AS_OF_DAY}",
    "suite": None,
    "imputed": None,
    "features": None,
    "labelled": f"""SELECT ispu_category AS actual, {_decode("CAST(k % 5 AS VARCHAR)")} AS guess FROM indexed""",
    "confusion": "SELECT actual, guess, count(*) AS n FROM labelled GROUP BY 1, 2",
    "report": """SELECT label, support, predicted_n, hits,
        CASE WHEN predicted_n > 0 THEN CAST(hits AS DOUBLE)/predicted_n ELSE 0 END AS p,
        CASE WHEN support > 0 THEN CAST(hits AS DOUBLE)/support ELSE 0 END AS r
        FROM (SELECT label, CAST(sum(s) AS BIGINT) AS support, CAST(sum(q) AS BIGINT) AS predicted_n,
                CAST(sum(h) AS BIGINT) AS hits FROM
          (SELECT actual AS label, n AS s, 0 AS q, 0 AS h FROM confusion
           UNION ALL SELECT guess, 0, n, CASE WHEN actual = guess THEN n ELSE 0 END FROM confusion)
          GROUP BY label)""",
}


def _expectation(name: str, missing: str, bad: str) -> str:
    return (f"SELECT '{name}' AS expectation, count(*) AS element_count, {missing} AS missing_count, "
            f"{bad} AS unexpected_count FROM readings")


RELATIONS["suite"] = (
    "SELECT *, unexpected_count = 0 AS success, "
    "CASE WHEN element_count - missing_count > 0 THEN unexpected_count * 100e0 / (element_count - missing_count) END AS p1, "
    "CASE WHEN element_count > 0 THEN unexpected_count * 100e0 / element_count END AS p2 FROM ("
    + " UNION ALL ".join([
        _expectation("not_null:pm25", "CAST(0 AS BIGINT)", "count(*) FILTER (pm25 IS NULL)"),
        _expectation("not_null:co", "CAST(0 AS BIGINT)", "count(*) FILTER (co IS NULL)"),
        _expectation("between:pm25", "count(*) FILTER (pm25 IS NULL)", "count(*) FILTER (pm25 < 0 OR pm25 > 300)"),
        _expectation("between:o3", "count(*) FILTER (o3 IS NULL)", "count(*) FILTER (o3 < 0 OR o3 > 1000)"),
        _expectation("numeric:k_text", "CAST(0 AS BIGINT)", "count(*) FILTER (k % 50 = 0)"),
        _expectation("type:pm25", "CAST(0 AS BIGINT)", "CAST(0 AS BIGINT)"),
        _expectation("type:date", "CAST(0 AS BIGINT)", "count(*)"),
    ]) + ")")


def _roll(col: str, rows: int) -> str:
    frame = f"OVER (PARTITION BY station_id ORDER BY t ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CAST(sum(CAST({col} AS DECIMAL(20,6))) {frame} AS DOUBLE) / nullif(count({col}) {frame}, 0)"


def _impute(col: str) -> str:
    return f"coalesce({col}, {_roll(col, 7)}, median({col}) OVER (PARTITION BY station_id))"


def _lags() -> str:
    w = "OVER (PARTITION BY station_id ORDER BY t)"
    return ", ".join(f"lag({c}, {k}) {w} AS {c}_lag_{k}" for c, ks in LAGS.items() for k in ks)


def _rolls() -> str:
    return ", ".join(f"{_roll(c, n)} AS {c}_roll_{n}" for c, n in ROLLINGS)


def _calendar(t: str, hour: bool) -> str:
    first = f"CAST(hour({t}) AS INTEGER) AS hour_of_day" if hour else f"CAST(month({t}) AS INTEGER) AS month"
    return (f"{first}, CAST(isodow({t}) - 1 AS INTEGER) AS day_of_week, "
            f"CAST(isodow({t}) >= 6 AS INTEGER) AS is_weekend, CAST(day({t}) AS INTEGER) AS day_of_month")


RELATIONS["imputed"] = (
    "SELECT station_id, date, t, record_count, " + ", ".join(f"{_impute(c)} AS {c}" for c in DAILY_MEASURES)
    + " FROM (SELECT *, date AS t FROM series)")


def _features(src: str, fill: bool) -> str:
    lag_names = [f"{c}_lag_{k}" for c, ks in LAGS.items() for k in ks]
    roll_names = [f"{c}_roll_{n}" for c, n in ROLLINGS]
    cols = [*DAILY_MEASURES, *lag_names, *roll_names]
    picked = ", ".join(f"coalesce({c}, 0) AS {c}" if fill else c for c in cols)
    return (f"SELECT station_id, date, record_count, {picked}, {_calendar('date', False)}, "
            f"CAST(dense_rank() OVER (ORDER BY station_id) - 1 AS INTEGER) AS station_encoded "
            f"FROM (SELECT *, {_lags()}, {_rolls()} FROM {src})")


RELATIONS["features"] = _features("imputed", False)

_nested_air = {"pm25": ("co", 20), "pm10": ("pm10", 24), "co": ("co", 24), "no2": ("no2", 24),
               "so2": ("so2", 24), "o3": ("o3", 24)}
_nested_wx = {"temperature": ("temperature", 10), "humidity": ("humidity", 24),
              "wind_speed": ("wind_speed", 24), "precipitation": ("precipitation", 24),
              "cloud_cover": ("cloud_cover", 24)}


def _nested_columns() -> str:
    out = []
    for name, (base, length) in (_nested_air | _nested_wx).items():
        cut = f"i < k % {length}" if length < 24 else "TRUE"
        if name == "co":
            cut = "k % 5 <> 0"
        out.append(f"CASE WHEN {cut} THEN {base} + i END AS {name}")
    return ", ".join(out)


def _icons(v: str) -> str:
    return _case(v, {k: f"'{i}'" for k, i in CATEGORY_ICONS.items()}, "''")


_REGION = "CASE station_id WHEN 'view' THEN 'North' WHEN 'click' THEN 'South' WHEN 'purchase' THEN 'East' WHEN 'signup' THEN 'West' ELSE station_id END"


def _spells(name: str, col: str, limit: str, need: int, severity: str) -> str:
    return f"""
    SELECT station_id, '{name}' AS rule, '{severity}' AS severity, min(window_start) AS started_at,
      max(window_start) AS ended_at, max({col}) AS peak, count(*) AS samples,
      date_diff('second', min(window_start), max(window_start)) / 60e0 AS minutes
    FROM (SELECT *, sum(brk) OVER (PARTITION BY station_id ORDER BY window_start) AS island FROM (
      SELECT *, CASE WHEN coalesce(lag({col} > {limit}) OVER w, FALSE)
                      AND window_start - lag(window_start) OVER w <= INTERVAL 15 MINUTE THEN 0 ELSE 1 END AS brk
      FROM windows WINDOW w AS (PARTITION BY station_id ORDER BY window_start)))
    WHERE {col} > {limit}
    GROUP BY station_id, island
    HAVING date_diff('second', min(window_start), max(window_start)) / 60e0 >= {need}"""


def _fired(name: str, col: str, limit: str, need: int, severity: str) -> str:
    """First sample of each long enough spell, over the windows the watermark has closed."""
    return f"""
    SELECT station_id, '{name}' AS rule, '{severity}' AS severity, started_at, window_start AS fired_at, {col} AS value
    FROM (SELECT *, min(window_start) OVER (PARTITION BY station_id, island) AS started_at FROM (
      SELECT *, sum(brk) OVER (PARTITION BY station_id ORDER BY window_start) AS island FROM (
        SELECT *, CASE WHEN coalesce(lag({col} > {limit}) OVER w, FALSE)
                      AND window_start - lag(window_start) OVER w <= INTERVAL 15 MINUTE THEN 0 ELSE 1 END AS brk
        FROM windows WHERE window_end <= (SELECT max(ts) FROM valid) - INTERVAL 10 MINUTE
        WINDOW w AS (PARTITION BY station_id ORDER BY window_start))) WHERE {col} > {limit})
    WHERE window_start - started_at >= INTERVAL {need} MINUTE
    QUALIFY row_number() OVER (PARTITION BY station_id, island ORDER BY window_start) = 1"""


_removed = []
_steps_so_far = "TRUE"
_all_steps = [("any_present", f"coalesce({', '.join(POLLUTANTS)}) IS NOT NULL")] + [
    (r.column, f"coalesce({r.column} BETWEEN {r.low} AND {r.high}, FALSE)") for r in CLEANING_RULES]
for _i, (_name, _keep) in enumerate(_all_steps, start=1):
    _removed.append(f"SELECT {_i} AS step, '{_name}' AS \"check\", count(*) FILTER ({_steps_so_far}) AS rows_in, "
                    f"count(*) FILTER ({_steps_so_far} AND NOT {_keep}) AS rows_removed FROM readings")
    _steps_so_far = f"{_steps_so_far} AND {_keep}"
_cleaning = " UNION ALL ".join(_removed)

_audited = " UNION ALL ".join(
    f"SELECT '{r.column}' AS \"column\", '{r.column}' AS rule, "
    f"count(*) FILTER ({r.column} < {r.low} OR {r.column} > {r.high}) AS out_of_range FROM indexed"
    for r in AUDIT_RULES)

_reasons = ", ".join(f"CASE WHEN {r.column} < {r.low} OR {r.column} > {r.high} THEN '{r.column}' END" for r in _RULES)

_dominant = " UNION ALL ".join(f"SELECT event_id, '{c}' AS name, {_sub(c)} AS v FROM readings" for c in POLLUTANTS)

_MSG = """SELECT *, CASE WHEN k % 19 = 0 THEN '{broken ' || event_id
      WHEN k % 17 = 0 THEN '{"event":' || event_id || '}' END AS bad FROM readings"""

_corr = " UNION ALL ".join(
    f"SELECT station_id, '{m}' AS measure, {_round(f'corr(pm25, {m})', 4)} AS corr FROM clean GROUP BY station_id"
    for m in ("temperature", "humidity", "wind_speed", "precipitation"))

ORACLES: dict[str, str] = {
    "sub_index": "SELECT event_id, " + ", ".join(f"{_sub(c)} AS {c}_index" for c in POLLUTANTS) + " FROM readings",
    "composite_index": "SELECT event_id, ispu, ispu_category FROM indexed",
    "category": f"""SELECT event_id, label, {_case('label', {c: i for i, c in enumerate(CATEGORIES)}, 'NULL')} AS severity
        FROM (SELECT event_id, {_category('co')} AS label FROM readings)""",
    "dominant_pollutant": f"""SELECT event_id, name AS dominant FROM ({_dominant})
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY v DESC NULLS LAST, name DESC) = 1""",
    "calendar_features": f"""SELECT event_id, ts, CAST(month(ts) AS INTEGER) AS month, {_calendar('ts', True)} FROM readings""",
    "decode_label": f"""SELECT event_id, {_decode('raw')} AS label FROM (SELECT event_id,
        CASE WHEN k % 7 = 0 THEN 'c' || k WHEN k % 7 = 1 THEN 'Sedang'
             WHEN k % 7 = 2 THEN (k % 5) || '.0' ELSE CAST(k % 8 AS VARCHAR) END AS raw FROM readings)""",
    "threshold_step": f"""SELECT event_id, {_steps('ispu', INDEX_STEPS)} AS index_step,
        {_steps('ispu', WORST_STEPS)} AS worst_step, {_steps('precipitation', COUNT_STEPS)} AS count_step,
        {_steps('cloud_cover', COVERAGE_STEPS)} AS coverage_step FROM indexed""",
    "parse_text": f"""SELECT event_id,
        CASE WHEN k % 10 <> 0 THEN date END AS day,
        CASE WHEN k % 10 <> 0 THEN date_trunc('minute', ts) END AS parsed,
        CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_day, {_REGION} AS region,
        CAST(CAST(floor(k / 200e0 * 100 + 0.5) AS INTEGER) AS VARCHAR) || '%' AS share,
        'max_depth: ' || k || ' | trees: 100' AS params FROM readings""",

    "any_present": "SELECT event_id, station_id FROM readings WHERE pm25 IS NOT NULL",
    "clean_ranges": "SELECT event_id, station_id, date, pm25, ispu FROM ranged",
    "cleaning_report": f"""SELECT step, "check", rows_in, rows_removed,
        rows_removed > rows_in * 0.5 AS over_half FROM ({_cleaning})""",
    "drop_incomplete": "SELECT event_id, pm25 FROM indexed WHERE pm25 IS NOT NULL AND ispu IS NOT NULL AND cloud_cover IS NOT NULL AND precipitation IS NOT NULL",
    "payload_valid": "SELECT event_id, pm25, ispu FROM valid",
    "payload_rejects": f"""SELECT event_id, concat_ws(',', {_reasons}) AS reasons FROM indexed WHERE NOT ({_VALID})""",
    "expectations": f"""SELECT expectation, element_count, missing_count, unexpected_count, success,
        {_round('p1', 4)} AS unexpected_percent, {_round('p2', 4)} AS unexpected_percent_total FROM suite""",
    "expectation_summary": f"""SELECT count(*) AS evaluated, count(*) FILTER (success) AS successful,
        count(*) FILTER (NOT success) AS unsuccessful,
        {_round('count(*) FILTER (success) * 100e0 / count(*)', 4)} AS success_percent FROM suite""",
    "expectation_sample": """SELECT pm25 AS value, count(*) AS n FROM readings WHERE pm25 < 0 OR pm25 > 60
        GROUP BY pm25 ORDER BY n DESC, value LIMIT 20""",
    "profile_table": """SELECT count(*) AS row_count, count(*) FILTER (date IS NULL) AS null_dates,
        count(DISTINCT station_id) AS distinct_stations, 16 AS column_count,
        'station_id,date,pm25_avg,pm10_avg,co_avg,no2_avg,so2_avg,o3_avg,ispu,temperature_avg,humidity_avg,wind_speed_avg,cloud_cover_avg,precipitation_sum,record_count,aqi_category' AS columns
        FROM daily""",
    "audit_ranges": f"""SELECT "column", rule, out_of_range, out_of_range = 0 AS passed FROM ({_audited})""",
    "freshness": """SELECT latest, CAST(DATE '2024-02-03' - latest AS INTEGER) AS days_old,
        DATE '2024-02-03' - latest > 2 AS stale FROM (SELECT max(CAST(ts AS DATE)) AS latest FROM readings)""",
    "dedup_readings": """SELECT event_id, station_id, user_id, date, ts, co FROM readings
        QUALIFY row_number() OVER (PARTITION BY station_id, user_id, date ORDER BY ts, event_id) = 1""",
    "retention": """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 90 DAY""",

    "daily_agg": "SELECT * FROM daily",
    "daily_agg_volume": None,
    "sliding_agg": "SELECT * FROM windows",
    "tumbling_agg": f"""SELECT station_id, ws AS window_start, ws + INTERVAL 10 MINUTE AS window_end, {_measures('ispu_avg')}
        FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, ts) AS ws FROM valid) GROUP BY station_id, ws""",
    "mean_index_24h": f"SELECT {_round(_mean('ispu_avg'), 1)} AS value FROM recent",
    "worst_station": f"""SELECT station_id, {_round('ispu_avg', 1)} AS value FROM recent
        ORDER BY ispu_avg DESC NULLS LAST, station_id, window_start LIMIT 1""",
    "unhealthy_station_count": "SELECT count(DISTINCT station_id) AS value FROM recent WHERE ispu_avg > 100",
    "coverage_pct": f"""SELECT station_id, {_round("count(DISTINCT date_trunc('hour', window_start)) / 24e0 * 100", 0)} AS value
        FROM recent WHERE window_start < {AS_OF} GROUP BY station_id""",
    "category_distribution": "SELECT date, aqi_category, count(*) AS n FROM week GROUP BY 1, 2",
    "category_share": f"""SELECT aqi_category, n, {_round('n * 100e0 / sum(n) OVER ()', 2)} AS share
        FROM (SELECT aqi_category, count(*) AS n FROM daily GROUP BY 1)""",
    "station_list": "SELECT DISTINCT station_id FROM windows",
    "index_series": f"""SELECT window_start AS time, station_id, ispu_avg FROM windows
        WHERE window_start BETWEEN {AS_OF} - INTERVAL 7 DAY AND {AS_OF}""",
    "daily_pm25": "SELECT date, station_id, pm25_avg FROM week",
    "lookback": "SELECT station_id, date, ispu FROM week",
    "long_series": """SELECT window_start AS time, station_id || ' PM2.5' AS metric, pm25_avg AS value FROM recent
        UNION ALL SELECT window_start, station_id || ' PM10', pm10_avg FROM recent""",
    "weather_series": """SELECT date AS time, station_id || ' Suhu' AS metric, temperature_avg AS value FROM week
        UNION ALL SELECT date, station_id || ' RH', humidity_avg FROM week""",
    "series_reducers": f"""SELECT station_id, {_round(_mean('pm25_avg'), 4)} AS mean, max(pm25_avg) AS max,
        min(pm25_avg) AS min,
        max(CASE WHEN last_any = 1 THEN pm25_avg END) AS last,
        max(CASE WHEN last_some = 1 THEN pm25_avg END) AS last_not_null
        FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY window_start DESC) AS last_any,
                row_number() OVER (PARTITION BY station_id ORDER BY pm25_avg IS NULL, window_start DESC) AS last_some
              FROM windows) GROUP BY station_id""",
    "heatmap_hour_day": f"""SELECT CAST(window_start AS DATE) AS day, CAST(hour(window_start) AS INTEGER) AS hour,
        {_round(_mean('ispu_avg'), 2)} AS mean_value, count(*) AS n FROM windows GROUP BY 1, 2""",
    "heatmap_histogram": """SELECT date_trunc('hour', window_start) AS hour, floor(ispu_avg / 10e0) * 10e0 AS bucket,
        count(*) AS n FROM windows WHERE ispu_avg IS NOT NULL GROUP BY 1, 2""",
    "latest_predictions": f"""SELECT station_id, window_start, predicted_label, {_round('confidence', 2)} AS confidence,
        model_version FROM predictions ORDER BY window_start DESC, event_id DESC LIMIT 20""",
    "latest_per_station": """SELECT * FROM predictions
        QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY created_at DESC, event_id DESC) = 1""",
    "latest_per_station_ties": """SELECT o_orderpriority AS station_id, o_orderdate AS window_start, o_orderkey,
        CASE WHEN o_custkey % 3 <> 0 THEN o_totalprice ELSE 0 END AS price FROM orders
        WHERE (o_orderpriority, o_orderdate) IN
          (SELECT (o_orderpriority, max(o_orderdate)) FROM orders GROUP BY o_orderpriority)""",
    "latest_gauges": """SELECT station_id, window_start, coalesce(ispu_avg, 0) AS ispu_avg,
        coalesce(pm25_avg, 0) AS pm25_avg, coalesce(pm10_avg, 0) AS pm10_avg FROM windows
        QUALIFY rank() OVER (PARTITION BY station_id ORDER BY window_start DESC) = 1""",
    "table_summary": "SELECT min(ts) AS first, max(ts) AS last, count(*) AS n FROM readings",
    "predicted_vs_actual": f"""SELECT date AS time, station_id || ' Aktual' AS metric, ispu AS value FROM week
        UNION ALL SELECT window_start, station_id || ' Prediksi',
          CAST({_case('label', LABEL_MIDPOINTS, '0')} AS DOUBLE)
        FROM (SELECT *, {_decode('predicted_label')} AS label FROM predictions
          WHERE window_start BETWEEN {AS_OF_DAY} - INTERVAL 7 DAY AND {AS_OF_DAY})""",

    "latest_map": f"""SELECT latitude, longitude, {_round('ispu', 1)} AS ispu, station_id, aqi_category
        FROM daily JOIN (SELECT station_id, min(event_id) / 1000e0 AS latitude,
            CAST(max(user_id) AS DOUBLE) AS longitude FROM readings GROUP BY station_id) USING (station_id)
        WHERE date = (SELECT max(date) FROM daily)""",
    "merge_feeds": """WITH air AS (SELECT user_id, date, pm25, pm10, co FROM readings WHERE event_id % 3 <> 0
          QUALIFY row_number() OVER (PARTITION BY user_id, date ORDER BY ts DESC, event_id DESC) = 1),
        wx AS (SELECT user_id, date, temperature, humidity FROM readings WHERE event_id % 3 = 0
          QUALIFY row_number() OVER (PARTITION BY user_id, date ORDER BY ts DESC, event_id DESC) = 1)
        SELECT user_id, date, pm25, pm10, co, temperature, humidity FROM air FULL OUTER JOIN wx USING (user_id, date)""",
    "insert_if_absent": """SELECT station_id, date,
        CASE WHEN date < DATE '2024-01-16' THEN ispu ELSE ispu + 1 END AS ispu,
        CASE WHEN date < DATE '2024-01-16' THEN 'stored' ELSE 'added' END AS origin FROM daily""",
    "stored_daily": """SELECT station_id, date, CASE WHEN date < DATE '2024-01-20' THEN ispu ELSE ispu + 1 END AS ispu,
        record_count FROM daily WHERE date >= DATE '2024-01-15'""",
    "csv_roundtrip": "SELECT event_id, station_id, date, pm25, co, ispu, ispu_category, precipitation FROM indexed",
    "payload_json": """SELECT station_id AS key, '{"station_id":"' || station_id || '","event_id":' || event_id
        || ',"cloud_cover":' || k || ',"flag":' || (k % 3 = 0) || ',"gap":'
        || CASE WHEN k % 3 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'null' END || '}' AS value FROM readings""",
    "hourly_explode": f"""SELECT event_id, CAST(date AS VARCHAR) || 'T' || lpad(CAST(i AS VARCHAR), 2, '0') || ':00' AS tanggal,
        {_nested_columns()}
        FROM (SELECT *, unnest(range(0, k % 24 + 1)) AS i FROM readings WHERE station_id <> 'error')""",
    "log_metrics": """WITH hits AS (SELECT file, pos,
          nullif(regexp_extract(text, 'Insert (\\d+) baris', 1), '') AS ins,
          nullif(regexp_extract(text, 'RF accuracy: ([\\d.]+), f1: ([\\d.]+)', 1), '') AS acc,
          nullif(regexp_extract(text, 'RF accuracy: ([\\d.]+), f1: ([\\d.]+)', 2), '') AS f,
          CASE WHEN text LIKE '%Batch ETL mulai%' THEN text[1:19] END AS s,
          CASE WHEN text LIKE '%Batch ETL selesai%' THEN text[1:19] END AS e,
          text LIKE '%WARNING%' AS w FROM logs),
        m AS (SELECT file, CAST(arg_max(ins, pos) FILTER (ins IS NOT NULL) AS BIGINT) AS inserted,
          CAST(arg_max(acc, pos) FILTER (acc IS NOT NULL) AS DOUBLE) AS accuracy,
          CAST(arg_max(f, pos) FILTER (f IS NOT NULL) AS DOUBLE) AS f1,
          count(*) FILTER (w) AS warnings,
          CAST(arg_max(s, pos) FILTER (s IS NOT NULL) AS TIMESTAMP) AS started_at,
          CAST(arg_max(e, pos) FILTER (e IS NOT NULL) AS TIMESTAMP) AS ended_at,
          bool_or(e IS NOT NULL) AS ok FROM hits GROUP BY file)
        SELECT *, date_diff('second', started_at, ended_at) AS seconds FROM m""",
    "metric_lines_first": """SELECT file, min(CAST(regexp_extract(text, '"rows":(\\d+)', 1) AS BIGINT)) AS rows, TRUE AS ok
        FROM logs WHERE text LIKE '\\_\\_METRICS\\_\\_:{"rows"%' ESCAPE '\\' GROUP BY file""",
    "metric_lines_last": """SELECT file, max(CAST(regexp_extract(text, '"rows":(\\d+)', 1) AS BIGINT)) AS rows, TRUE AS ok
        FROM logs WHERE text LIKE '\\_\\_METRICS\\_\\_:{"rows"%' ESCAPE '\\' GROUP BY file""",

    "lag_features": f"SELECT station_id, date, {', '.join(LAGS)}, {_lags()} FROM (SELECT *, date AS t FROM series)",
    "lag_calendar": """SELECT s.station_id, s.date, s.pm25_avg, a.pm25_avg AS pm25_avg_lag_1, b.pm25_avg AS pm25_avg_lag_7
        FROM series s LEFT JOIN series a ON a.station_id = s.station_id AND a.date = s.date - INTERVAL 1 DAY
        LEFT JOIN series b ON b.station_id = s.station_id AND b.date = s.date - INTERVAL 7 DAY""",
    "lag_readings": """SELECT station_id, ts, event_id, co, lag(co, 1) OVER w AS co_lag_1, lag(co, 3) OVER w AS co_lag_3
        FROM readings WINDOW w AS (PARTITION BY station_id ORDER BY ts, event_id)""",
    "rolling_features": f"SELECT station_id, date, pm25_avg, pm10_avg, ispu, {_rolls()} FROM (SELECT *, date AS t FROM series)",
    "impute_rolling_median": "SELECT station_id, date, pm25_avg, pm10_avg, humidity_avg FROM imputed",
    "group_medians": "SELECT station_id, median(pm25) AS pm25, median(co) AS co FROM readings GROUP BY station_id",
    "ordinal_encode": "SELECT event_id, station_id, CAST(dense_rank() OVER (ORDER BY station_id) - 1 AS INTEGER) AS station_encoded FROM readings",
    "batch_features": "SELECT * FROM features",
    "batch_features_scoring": _features("(SELECT *, date AS t FROM series)", True),
    "stream_features": "SELECT * EXCLUDE (t), " + _calendar("window_start", True) + " FROM (SELECT station_id, window_start, window_end, t, record_count, "
        + ", ".join(f"{_impute(c)} AS {c}" for c in STREAM_MEASURES) + " FROM (SELECT *, window_start AS t FROM windows))",
    "temporal_split": """SELECT station_id, date, aqi_category,
        CASE WHEN date <= (SELECT max(date) FROM labelled_series) - INTERVAL 7 DAY THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY date) AS rn FROM labelled_series) WHERE rn > 7""",
    "horizon_labels": """SELECT a.station_id, a.date, a.ispu, b.aqi_category FROM labelled_series a
        JOIN labelled_series b ON a.station_id = b.station_id AND b.date = a.date + INTERVAL 1 DAY""",
    "class_weights": """SELECT ispu_category, n, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) AS weight
        FROM (SELECT ispu_category, count(*) AS n FROM indexed GROUP BY 1)""",
    "station_means": "SELECT station_id, " + ", ".join(f"{_round(_mean(c), 4)} AS {c}" for c in CLUSTER_MEASURES)
        + " FROM series GROUP BY station_id",
    "confusion_matrix": "SELECT actual, guess AS predicted, n FROM confusion",
    "classification_metrics": f"""WITH f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM report)
        SELECT label, support, CAST(NULL AS DOUBLE) AS accuracy, {_round('p', 6)} AS precision, {_round('r', 6)} AS recall,
          {_round('f1', 6)} AS f1 FROM f
        UNION ALL SELECT 'weighted avg', CAST(sum(support) AS BIGINT), {_round('CAST(sum(hits) AS DOUBLE) / sum(support)', 6)},
          {_round('sum(p * support) / sum(support)', 6)}, {_round('sum(r * support) / sum(support)', 6)},
          {_round('sum(f1 * support) / sum(support)', 6)} FROM f""",

    "json_decode": f"""SELECT event_id, station_id, ts AS event_time, pm25, co, CAST(k AS DOUBLE) AS weather_code
        FROM ({_MSG}) WHERE bad IS NULL""",
    "json_quarantine": f"SELECT bad AS value FROM ({_MSG}) WHERE bad IS NOT NULL",
    "late_events": """SELECT o_orderkey, o_orderdate, seen - INTERVAL 365 DAY AS watermark,
        coalesce(o_orderdate < seen - INTERVAL 365 DAY, FALSE) AS is_late FROM (SELECT o_orderkey, o_orderdate,
          max(o_orderdate) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM orders)""",
    "latest_window_version": f"""WITH v AS (SELECT *, CAST(0 AS BIGINT) AS batch_id FROM windows
          UNION ALL SELECT *, 1 FROM ({_windows('clean')}))
        SELECT station_id, window_start, pm25_avg, record_count, batch_id FROM v
        QUALIFY row_number() OVER (PARTITION BY station_id, window_start ORDER BY batch_id DESC) = 1""",
    "sustained_alerts": " UNION ALL ".join([
        _spells("ISPUCritical", "ispu_avg", "200", 30, "critical"),
        _spells("ISPUWarning", "ispu_avg", "100", 60, "warning"),
        _spells("HighPM25", "pm25_avg", "55.4", 60, "warning")]),
    "station_report": f"""WITH newest AS (SELECT station_id, {_decode('predicted_label')} AS predicted, confidence
          FROM predictions QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY created_at DESC, event_id DESC) = 1),
        today AS (SELECT station_id, ispu, aqi_category AS category FROM daily WHERE date = {AS_OF_DAY}),
        rows AS (SELECT station_id, {_REGION} AS region, category, ispu, predicted, confidence
          FROM today LEFT JOIN newest USING (station_id))
        SELECT *, concat_ws(chr(10), region,
          concat_ws(' ', 'Sekarang:', {_icons('category')}, category, '(ISPU ' || CAST(floor(ispu + 0.5) AS INTEGER) || ')'),
          CASE WHEN predicted IS NOT NULL THEN concat_ws(' ', 'Besok:', {_icons('predicted')}, predicted,
            '(keyakinan ' || CAST(floor(confidence * 100 + 0.5) AS INTEGER) || '%)') END) AS text FROM rows
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'Tidak ada data ISPU untuk hari ini.'
        WHERE NOT EXISTS (SELECT 1 FROM today)""",
    "audit_latest": "SELECT * FROM runs",
    "audit_duration": "SELECT * FROM durations",
    "audit_listing": "SELECT dag_id, status, records_in FROM runs WHERE dag_id LIKE '1-%'",
    "run_summary": "SELECT dag_id, run_id, concat_ws(' | ', dag_id || '/' || run_id, status, seconds || 's') AS summary FROM durations",
    "run_counters": """SELECT (SELECT count(*) FROM indexed) AS csv_rows, (SELECT count(*) FROM clean) AS after_clean,
        (SELECT count(*) FROM daily) AS daily_rows, (SELECT max(ispu) FROM clean) AS max_ispu""",

    "raw_stream": f"""SELECT event_id, station_id, ts AS timestamp, pm25, co, 22 AS columns FROM ({_MSG}) WHERE bad IS NULL""",
    "stream_sliding_agg": "SELECT * FROM windows",
    "stream_alerts": " UNION ALL ".join([
        _fired("ISPUCritical", "ispu_avg", "200", 30, "critical"),
        _fired("ISPUWarning", "ispu_avg", "100", 60, "warning"),
        _fired("HighPM25", "pm25_avg", "55.4", 60, "warning")]),

    "weekend_ttest": f"""WITH s AS (SELECT station_id,
          count(ispu) FILTER (isodow(date) >= 6) AS weekend_n, count(ispu) FILTER (isodow(date) < 6) AS weekday_n,
          avg(ispu) FILTER (isodow(date) >= 6) AS m1, avg(ispu) FILTER (isodow(date) < 6) AS m2,
          var_samp(ispu) FILTER (isodow(date) >= 6) / count(ispu) FILTER (isodow(date) >= 6) AS a,
          var_samp(ispu) FILTER (isodow(date) < 6) / count(ispu) FILTER (isodow(date) < 6) AS b
          FROM series GROUP BY station_id)
        SELECT station_id, weekend_n, weekday_n, {_round('m1', 4)} AS weekend_mean, {_round('m2', 4)} AS weekday_mean,
          {_round('(m1 - m2) / sqrt(a + b)', 4)} AS t,
          {_round('(a + b) * (a + b) / (a * a / (weekend_n - 1) + b * b / (weekday_n - 1))', 2)} AS dof FROM s""",
    "station_ranking": """SELECT date, station_id, ispu,
        CAST(rank() OVER (PARTITION BY date ORDER BY ispu DESC NULLS LAST) AS INTEGER) AS rank FROM daily""",
    "pollutant_weather_corr": _corr,
    "idw_grid": f"""WITH p AS (SELECT user_id % 12 * 1.0 + 0.25e0 AS x, floor(user_id / 12e0) + 0.25e0 AS y,
          {_round(_mean('pm25'), 2)} AS v FROM clean GROUP BY user_id),
        c AS (SELECT x, y, v, floor(x) + dx AS cx, floor(y) + dy AS cy FROM p,
          unnest(range(-2, 3)) t1(dx), unnest(range(-2, 3)) t2(dy)),
        w AS (SELECT *, 1e0 / greatest((cx + 0.5e0 - x) * (cx + 0.5e0 - x) + (cy + 0.5e0 - y) * (cy + 0.5e0 - y), 1e-9) AS wt FROM c)
        SELECT CAST(cx AS BIGINT) AS cell_x, CAST(cy AS BIGINT) AS cell_y,
          {_round('sum(round(wt * v * 1e9)) / sum(round(wt * 1e9))', 2)} AS value, count(*) AS stations FROM w GROUP BY cx, cy""",
}
_HISTORY = """SELECT 'E' || event_id AS station_id, CAST(date AS VARCHAR) || 'T' || lpad(CAST(i AS VARCHAR), 2, '0') || ':00' AS tanggal,
        co + i AS pm25, pm10 + i AS pm10, co + i AS co, no2 + i AS no2, so2 + i AS so2, o3 + i AS o3, temperature + i AS temperature
        FROM (SELECT *, unnest(range(0, k % 24 + 1)) AS i FROM readings WHERE station_id <> 'error')"""
ORACLES["history_readings"] = f"""WITH history AS ({_HISTORY}), hi AS ({_indexed('history')})
    SELECT station_id, 'Station ' || station_id AS station_name, 1.5 AS latitude, tanggal, pm25, co, ispu, ispu_category, temperature FROM hi"""
ORACLES["station_dimension"] = """SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS station_name, CAST(s_nationkey AS VARCHAR) AS region,
    s_acctbal AS latitude, 1e0 AS longitude FROM supplier"""
ORACLES["stored_predictions"] = """SELECT event_id, station_id, window_start, predicted_label, confidence,
    'v' || (event_id % 2) AS model_version FROM predictions"""
ORACLES["uv_index_mean"] = f"""SELECT station_id, date, {_round("sum(CASE WHEN k % 3 <> 0 THEN k END) / 10e0 / nullif(count(CASE WHEN k % 3 <> 0 THEN 1 END), 0)", 2)}
    AS uv_index_avg, count(*) AS record_count FROM (SELECT * FROM clean WHERE k IS NOT NULL AND k % 3 <> 0) GROUP BY station_id, date"""
ORACLES["metric_summary"] = """SELECT o_orderpriority AS dag_id, CAST(o_orderkey AS VARCHAR) AS run_id,
    concat_ws(' | ', o_orderpriority || '/' || o_orderkey, o_orderstatus, 'in=' || o_custkey,
      CASE WHEN o_orderstatus <> 'P' THEN 'out=' || (o_custkey % 100) END) AS summary FROM orders"""


def _quality(name: str, table: str, day: str, columns: int) -> str:
    rules = " + ".join(f"count(*) FILTER ({c} < {r.low} OR {c} > {r.high})" for r in AUDIT_RULES
                       for c in [next((x for x in _NAMES[name] if x == r.column or x.startswith(r.column + "_")), None)] if c)
    return (f"SELECT '{name}' AS \"table\", count(*) AS row_count, count(*) FILTER ({day} IS NULL) AS null_dates, "
            f"count(DISTINCT station_id) AS distinct_stations, {columns} AS column_count, CAST({rules} AS BIGINT) AS out_of_range, "
            f"max(CAST({day} AS DATE)) AS latest, DATE '2024-02-03' - max(CAST({day} AS DATE)) > 2 AS stale FROM {table}")


_AVGS = [f"{c}_avg" for c in AVERAGED if c != "ispu"] + ["precipitation_sum"]
_NAMES = {"daily": ["ispu", *_AVGS], "windows": ["ispu_avg", *_AVGS]}
ORACLES["quality_run"] = _quality("daily", "daily", "date", 16) + " UNION ALL " + _quality("windows", "windows", "window_start", 16)
_SPLIT = """split AS (SELECT CASE WHEN date <= (SELECT max(date) FROM labelled_series) - INTERVAL 7 DAY THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY date) AS rn FROM labelled_series) WHERE rn > 7)"""
_STATIONS = (f"WITH volume AS ({VOLUME}), vi AS ({_indexed('volume')}), vc AS (SELECT * FROM vi WHERE {_CLEAN}), "
             "stations AS (SELECT DISTINCT station_id FROM vc)")
ORACLES["train_classifier"] = f"""WITH {_SPLIT} SELECT count(*) FILTER (split = 'test') AS test_samples,
    {len(DAILY_MEASURES) + sum(map(len, LAGS.values())) + len(ROLLINGS) + 4 + 1 + 1} AS features, 12 AS grid_points, TRUE AS labels_known,
    TRUE AS confidence_in_range, TRUE AS f1_high, TRUE AS search_recorded FROM split"""
ORACLES["training_summary"] = f"""{_STATIONS}, {_SPLIT} SELECT count(*) FILTER (split = 'train') AS train_samples,
    count(*) FILTER (split = 'test') AS test_samples, (SELECT count(*) FROM stations) AS clustered, 3 AS clusters,
    TRUE AS accuracy_high, TRUE AS precision_high, TRUE AS recall_high, TRUE AS f1_score_high FROM split"""
ORACLES["batch_scores"] = """SELECT station_id, date, pm25_avg, pm10_avg, TRUE AS label_right, TRUE AS confidence_in_range,
    '1' AS model_version FROM imputed QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY date DESC) = 1"""
ORACLES["station_clusters"] = f"""{_STATIONS} SELECT count(*) AS stations, 3 AS clusters, 0 AS nearer_to_another,
    TRUE AS ranked_by_index FROM stations"""
ORACLES["cluster_pca"] = f"""{_STATIONS} SELECT count(*) AS stations, TRUE AS uncorrelated, TRUE AS ordered, TRUE AS within_total FROM stations"""
ORACLES["stream_scores"] = """SELECT count(*) AS windows, 0 AS differing, TRUE AS labels_known, '1' AS model_version FROM windows"""
# Twice the integral of the density beyond |t| by Simpson's rule, over u with x = |t| + u / (1 - u).
ORACLES["weekend_p_value"] = f"""WITH tests AS (SELECT * FROM ({ORACLES['weekend_ttest']})),
    nodes AS (SELECT station_id, t, dof, i, i / 40000.0::DOUBLE AS u FROM tests, range(40000) AS r(i)),
    heights AS (SELECT *, exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5 * ln(dof * pi())
        - (dof + 1) / 2 * ln(1 + (abs(t) + u / (1 - u)) ** 2 / dof)) / ((1 - u) * (1 - u)) AS y FROM nodes)
    SELECT station_id, t, dof, floor(2 * sum(y * CASE WHEN i = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) / 120000 * 1e6 + 0.5) / 1e6 AS p_value
    FROM heights GROUP BY station_id, t, dof"""
ORACLES["recorded_minutes"] = " UNION ALL ".join(f"""SELECT station_id, {n} AS days, count(DISTINCT date_trunc('minute', ts)) AS minutes FROM indexed
    WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - {n} AND CAST(ts AS DATE) <= DATE '2024-01-30' GROUP BY station_id""" for n in (1, 7, 30))
ORACLES["training_guard"] = """SELECT (SELECT count(*) FROM daily) AS "rows", minimum, (SELECT count(*) FROM daily) >= minimum AS starts
    FROM (VALUES (1), (50), (100), (1000), (1000000000)) AS g(minimum)"""
ORACLES["empty_batches"] = "SELECT count(*) AS rows_in, 0 AS stored FROM indexed"
ORACLES["stream_progress"] = f"SELECT count(*) AS rows_in, count(*) FILTER (NOT ({_VALID})) AS quarantined, 0 AS late, TRUE AS timed FROM indexed"
ORACLES["oversampled_categories"] = """WITH k AS (SELECT ispu_category, count(*) AS given, max(count(*)) OVER () - count(*) AS need,
    count(DISTINCT CASE WHEN isfinite(pm25) AND isfinite(pm10) THEN (pm25, pm10) END) AS vectors
    FROM indexed WHERE ispu_category IS NOT NULL GROUP BY ispu_category), m AS (SELECT *, CASE WHEN vectors > 0 THEN need ELSE 0 END AS made FROM k)
    SELECT ispu_category, given, made, made AS "between", least(vectors, made) AS origins FROM m"""
ORACLES["daily_agg_volume"] = (
    f"WITH volume AS ({VOLUME}), vi AS ({_indexed('volume')}), vc AS (SELECT * FROM vi WHERE {_CLEAN}) {_daily('vc')}")


def _with(sql: str) -> str:
    """Prefix a query with the named relations it needs, directly or indirectly."""
    import re

    needed: set[str] = set()
    queue = [sql]
    while queue:
        text = queue.pop()
        for name, body in RELATIONS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                queue.append(body)
    ctes = [f"{n} AS ({RELATIONS[n]})" for n in RELATIONS if n in needed]
    if not ctes:
        return sql
    if sql.lstrip().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {sql.lstrip()[5:]}"
    return f"WITH {', '.join(ctes)} {sql}"


def all_oracles() -> dict[str, str]:
    return {name: _with(sql) for name, sql in ORACLES.items()}
