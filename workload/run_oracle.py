"""SQL of the queries in ``workload.runs``, written for DuckDB."""

from __future__ import annotations

from airmart import schemas as S
from workload.oracle import CUTOFF, HOUR, MANY, PHI, _common, _inference, _matched, _training
from workload.runs import BANDS, DELIVERIES

R = "round({} + 1e-9, 6)"
REACH = "CASE WHEN sigma = 0 THEN 1e-9 * (abs(Y) + 1) ELSE 1.959963984540054 * sigma END"


def _scores(rows: str, extra: str = "") -> str:
    """Detector columns of CTE rows (station, TS, Y, f, sigma)."""
    return f"""
      gaps AS (
        SELECT *, CASE WHEN sigma > 0 THEN (Y - f) / sigma WHEN abs(Y - f) <= {REACH} THEN 0.0 END AS z FROM {rows}),
      t AS (SELECT *, abs(z) / sqrt(2) AS x, 1 / (1 + 0.3275911 * abs(z) / sqrt(2)) AS k FROM gaps),
      scored AS (SELECT *, 1 - (0.254829592 * k - 0.284496736 * k ** 2 + 1.421413741 * k ** 3
                 - 1.453152027 * k ** 4 + 1.061405429 * k ** 5) * exp(-x * x) AS e FROM t),
      shown AS (
        SELECT station, TS, Y, {R.format("f")} AS FORECAST, {R.format(f"f - {REACH}")} AS LOWER_BOUND,
          {R.format(f"f + {REACH}")} AS UPPER_BOUND, abs(Y - f) > {REACH} AS IS_ANOMALY,
          {R.format("z")} AS DISTANCE, {R.format(PHI.format(z="z"))} AS PERCENTILE{extra}
        FROM scored)"""


def _one_driver(by: str = "") -> str:
    """A line through PM2.5 over wind speed, of all rows or of each station."""
    group = f"GROUP BY {by}" if by else ""
    on = f"l.{by} = d.{by}" if by else "TRUE"
    key = f"{by}, " if by else ""
    return f"""
    WITH d AS ({_common("", "h")}),
      lines AS (
        SELECT {key}avg(WIND_SPEED) AS m, avg(PM2_5) AS my, var_pop(PM2_5) AS vy, covar_pop(PM2_5, WIND_SPEED) AS c,
          var_pop(WIND_SPEED) AS v FROM d WHERE WIND_SPEED IS NOT NULL {group}),
      l AS (SELECT *, CASE WHEN v > 0 THEN c / v ELSE 0 END AS slope FROM lines),
      rows_ AS (
        SELECT d.station, d.TS, d.PM2_5 AS Y, l.my + l.slope * (d.WIND_SPEED - l.m) AS f, l.slope * (d.WIND_SPEED - l.m) AS part,
          sqrt(CASE WHEN vy - slope * c > 1e-12 * vy THEN vy - slope * c ELSE 0 END) AS sigma
        FROM d JOIN l ON {on} WHERE d.WIND_SPEED IS NOT NULL),
      {_scores("rows_", f", {R.format('part')} AS WIND_PART")}"""


def _smoothed(level: float = 0.2, season: float = 0.1) -> str:
    """The recursion as it is written, reading by reading."""
    return f"""
    WITH RECURSIVE d AS ({_common("", "h")}),
      n AS (SELECT station, TS, PM2_5 AS y, hour(TS) AS h, row_number() OVER (PARTITION BY station ORDER BY TS) AS n FROM d),
      s AS (
        SELECT station, n, TS, y, CAST(NULL AS DOUBLE) AS f, y AS level, list_transform(range(24), lambda i: 0.0::DOUBLE) AS season
        FROM n WHERE n = 1
        UNION ALL
        SELECT station, n, TS, y, f, level, list_transform(range(24), lambda i:
          CASE WHEN i = h THEN {season} * (y - level) + {1 - season} * old[h + 1] ELSE old[i + 1] END)
        FROM (
          SELECT n.station, n.n, n.TS, n.y, n.h, s.season AS old, s.level + s.season[n.h + 1] AS f,
            {level} * (n.y - s.season[n.h + 1]) + {1 - level} * s.level AS level
          FROM s JOIN n ON n.station = s.station AND n.n = s.n + 1)),
      spread AS (SELECT station, stddev_pop(y - f) AS sigma FROM s WHERE f IS NOT NULL GROUP BY station),
      rows_ AS (SELECT s.station, s.TS, s.y AS Y, s.f, spread.sigma FROM s JOIN spread USING (station) WHERE f IS NOT NULL),
      {_scores("rows_")}
    SELECT * FROM shown"""


def _exact(rows: str, tag: str = "") -> str:
    """What a forest must answer that knows the class."""
    low, high = BANDS
    return f"""
    SELECT station, OBSERVATION_TIME, CASE WHEN PM2_5 <= {low} THEN 'Good' WHEN PM2_5 <= {high} THEN 'Moderate' ELSE 'Poor' END AS PREDICTED_CLASS,
      CASE WHEN PM2_5 <= {low} THEN 1.0 ELSE 0.0 END::DOUBLE AS PROB_GOOD,
      CASE WHEN PM2_5 > {low} AND PM2_5 <= {high} THEN 1.0 ELSE 0.0 END::DOUBLE AS PROB_MODERATE,
      CASE WHEN PM2_5 > {high} THEN 1.0 ELSE 0.0 END::DOUBLE AS PROB_POOR{tag}
    FROM ({rows}) WHERE PM2_5 IS NOT NULL"""


def _by_clock() -> str:
    columns = "station, OBSERVATION_TIME, TEMPERATURE, HUMIDITY, WIND_SPEED, PRESSURE, PM2_5, US_AQI"
    return f"""
    WITH {MANY}, base AS (SELECT * FROM ({_matched(MANY, True, "h")}) WHERE PM2_5 IS NOT NULL),
      means AS (
        SELECT a.station, a.OBSERVATION_TIME, avg(b.PM2_5) AS m FROM base a JOIN base b ON a.station = b.station
          AND b.OBSERVATION_TIME BETWEEN a.OBSERVATION_TIME - INTERVAL 24 HOUR AND a.OBSERVATION_TIME GROUP BY 1, 2)
    SELECT {", ".join(f"t.{c}" for c in columns.split(", "))}, one.PM2_5 AS PM25_LAG1, two.PM2_5 AS PM25_LAG2,
      {R.format("m")} AS PM25_ROLL24,
      CASE WHEN later.US_AQI <= 50 THEN 'Good' WHEN later.US_AQI <= 100 THEN 'Moderate' ELSE 'Poor' END AS NEXT_HOUR_CLASS
    FROM base t JOIN means USING (station, OBSERVATION_TIME)
      JOIN base two ON two.station = t.station AND two.OBSERVATION_TIME = t.OBSERVATION_TIME - INTERVAL 2 HOUR
      LEFT JOIN base one ON one.station = t.station AND one.OBSERVATION_TIME = t.OBSERVATION_TIME - INTERVAL 1 HOUR
      LEFT JOIN base later ON later.station = t.station AND later.OBSERVATION_TIME = t.OBSERVATION_TIME + INTERVAL 1 HOUR"""


def _views() -> str:
    names = {
        "raw.raw_weather_history": ("wxh", "TEMPERATURE"), "raw.raw_airquality_history": ("aqh", "PM2_5"),
        "raw.raw_weather_realtime": ("wxn", "TEMPERATURE"), "raw.raw_airquality_realtime": ("aqn", "PM2_5"),
        "staging.stg_weather": ("wx", "TEMPERATURE"), "staging.stg_airquality": ("aq", "PM2_5"),
        "analytics.fact_hourly": ("wx", "TEMPERATURE"),
        "analytics.classifier_training": (f"({_training(MANY, True)})", "TEMPERATURE"),
        "analytics.classifier_inference": (f"({_inference(MANY, True)})", "TEMPERATURE"),
        "analytics.anomaly_training": (f"({_common('', 'h')})", "TEMPERATURE"),
        "analytics.anomaly_inference": (f"({_common('', 'n')})", "TEMPERATURE"),
    }
    parts = [
        f"SELECT '{name}' AS NAME, count(*) AS N_ROWS, {R.format(f'sum({c})')} AS TOTAL FROM {table}"
        for name, (table, c) in names.items()
    ]
    return f"WITH {MANY} " + " UNION ALL ".join(parts)


def _gate() -> str:
    hours = "(SELECT count(*) FROM wx)"
    twice = "(SELECT count(*) FROM wxh WHERE hour(OBSERVATION_TIME) = 0)"
    return f"""
    WITH {MANY}
    SELECT 'clean' AS STEP, TRUE AS RELEASED, {hours} AS N_ROWS, 0::BIGINT AS FAILURES
    UNION ALL SELECT 'refused', {twice} = 0, {hours}, {twice}
    UNION ALL SELECT 'mended', TRUE, {hours}, 0"""


def _writers() -> str:
    return f"""
    WITH {MANY}
    SELECT 'first' AS NAME, 'committed' AS OUTCOME, -1::BIGINT AS N_ROWS
    UNION ALL SELECT 'second', 'refused', -1 UNION ALL SELECT 'third', 'committed', -1
    UNION ALL SELECT 'raw_weather_history', 'readable', count(*) FROM wxh
    UNION ALL SELECT 'raw_airquality_history', 'readable', count(*) FROM aqh
    UNION ALL SELECT 'other', 'readable', count(*) FROM aqn"""


def _absent() -> str:
    parts = [
        f"SELECT station, max(OBSERVATION_TIME) AS LAST_HOUR, '{kind}' AS FEED FROM {table} "
        f"GROUP BY station HAVING max(OBSERVATION_TIME) < {CUTOFF}"
        for kind, table in (("weather", "wx"), ("airquality", "aq"))
    ]
    return f"WITH {MANY} " + " UNION ALL ".join(parts)


def _null_keys() -> str:
    rows = f"""SELECT CASE WHEN event_id % 97 <> 0 THEN {HOUR} END AS t,
      CASE WHEN event_id % 89 <> 0 THEN user_id END AS u FROM events"""
    parts = []
    for kind in S.FIELDS:
        parts += [
            f"SELECT 'stg_{kind}' AS model, 'unique' AS check, count(*) AS failures FROM (SELECT t, u FROM k "
            "WHERE t IS NOT NULL AND u IS NOT NULL GROUP BY t, u HAVING count(*) > 1)",
            f"SELECT 'stg_{kind}', 'not_null', count(*) FROM k WHERE t IS NULL OR u IS NULL",
            f"SELECT 'stg_{kind}', 'time', count(*) FROM k WHERE t IS NULL",
        ]
    return f"WITH k AS ({rows}) " + " UNION ALL ".join(parts)


def _fates() -> str:
    """Deliveries by the same rule; a row is late if its hour is two days behind all that came before its delivery."""
    return f"""
    WITH {MANY},
      days AS (SELECT CAST(min(OBSERVATION_TIME) AS DATE) AS d0, CAST(max(OBSERVATION_TIME) AS DATE) - CAST(min(OBSERVATION_TIME) AS DATE) + 1 AS n FROM wx),
      hours AS (
        SELECT 'weather' AS FEED, station, OBSERVATION_TIME AS t FROM wx UNION ALL SELECT 'airquality', station, OBSERVATION_TIME FROM aq),
      placed AS (
        SELECT hours.*, CAST(floor((CAST(t AS DATE) - d0) * {DELIVERIES} / n) AS INTEGER) AS place, CAST(station AS BIGINT) AS s FROM hours, days),
      sent AS (
        SELECT FEED, station, t, CASE WHEN s % 5 = 0 AND place = 0 THEN 2 ELSE place END AS b FROM placed
        UNION ALL SELECT FEED, station, t, 2 FROM placed WHERE s % 3 = 1 AND place = 1),
      marks AS (
        SELECT b, (SELECT max(t) FROM sent e WHERE e.b < m.b) - INTERVAL 2 DAY AS mark FROM (SELECT DISTINCT b FROM sent) m),
      judged AS (
        SELECT sent.*, mark IS NOT NULL AND t < mark AS late,
          row_number() OVER (PARTITION BY FEED, station, t, mark IS NOT NULL AND t < mark ORDER BY sent.b) AS k
        FROM sent JOIN marks USING (b)),
      fates AS (
        SELECT *, CASE WHEN late THEN 'late' WHEN k > 1 THEN 'repeated' ELSE 'accepted' END AS fate FROM judged),
      pairs AS (SELECT station, t FROM fates WHERE fate = 'accepted' GROUP BY 1, 2 HAVING count(DISTINCT FEED) = 2)
    SELECT FEED, count(*) AS DELIVERED, count(*) FILTER (fate = 'accepted') AS ACCEPTED, count(*) FILTER (fate = 'repeated') AS REPEATED,
      count(*) FILTER (fate = 'late') AS LATE, (SELECT count(*) FROM pairs) AS JOINED
    FROM fates GROUP BY FEED"""


def all_oracles() -> dict[str, str]:
    training, current = _training(MANY, True), _inference(MANY, True)
    current_tag, past_tag = ", 'current' AS SOURCE", ", 'historical' AS SOURCE"
    detect = _one_driver()
    return {
        "store_incremental_days": training,
        "catalog_views": _views(),
        "dq_gate": _gate(),
        "store_two_writers": _writers(),
        "store_failed_refresh": f"WITH {MANY} SELECT * FROM aqh",
        "current_hour_absent": _absent(),
        "dq_not_null_keys": _null_keys(),
        "clf_training_time_frames": _by_clock(),
        "clf_predict_exact": _exact(current),
        "clf_backcast_exact": _exact(training),
        "ds_predictions_exact": f"{_exact(current, current_tag)} UNION ALL {_exact(training, past_tag)}",
        "clf_predict_stored": _exact(current, ", TRUE AS OTHERS_REFUSED"),
        "anomaly_detect_one_driver": f"{detect} SELECT * FROM shown",
        "ds_alerts_one_driver": f"{detect} SELECT * FROM shown WHERE IS_ANOMALY",
        "anomaly_detect_stored": f"{detect} SELECT *, TRUE AS OTHERS_REFUSED FROM shown",
        "anomaly_detect_by_station": f"{_one_driver('station')} SELECT * FROM shown",
        "anomaly_smoothed": _smoothed(),
        "stream_late_rows": _fates(),
    }
