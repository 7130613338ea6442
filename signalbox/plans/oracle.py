"""Reference SQL (DuckDB dialect) for every catalog query.

The shared CTEs restate the feed derivation of ``signalbox.sources.testdata``
directly over the provided tables, so the SQL is an independent statement of
each result. Arithmetic is in doubles, ties sort nulls first, sums are cast to
BIGINT, and means/deviations/scores are rounded to 4 places.
"""

from __future__ import annotations

_FEED = """
SELECT
  msg_type,
  CAST(pms AS VARCHAR) AS msg_queue_timestamp,
  'SRC' || CAST(user_id % 3 AS VARCHAR) AS source_system_id,
  'T' || CAST(user_id AS VARCHAR) AS train_id,
  'S' || CAST(event_id % 7 AS VARCHAR) AS train_service_code,
  CAST(user_id % 4 AS VARCHAR) AS toc_id,
  lpad(CAST(user_id % 30 AS VARCHAR), 5, '0') AS loc_stanox,
  CASE WHEN msg_type = '0002' THEN CAST(pms AS VARCHAR) END AS canx_timestamp,
  CASE WHEN msg_type = '0002' THEN json_extract_string(props, '$.k') END AS canx_reason_code,
  CASE WHEN msg_type = '0002' THEN CASE event_id % 3 WHEN 0 THEN 'AT ORIGIN' WHEN 1 THEN 'EN ROUTE' ELSE 'AT CALL' END END AS canx_type,
  CASE WHEN msg_type = '0003' THEN CAST(pms + CAST(round((value - 40.0::DOUBLE) * 60000.0::DOUBLE) AS BIGINT) AS VARCHAR) END AS actual_timestamp,
  CASE WHEN msg_type = '0003' THEN CAST(pms AS VARCHAR) END AS planned_timestamp,
  CASE WHEN msg_type = '0003' THEN CAST(CAST(abs(shift) AS INTEGER) AS VARCHAR) END AS timetable_variation,
  CASE WHEN msg_type = '0003' THEN CASE WHEN shift > 0 THEN 'LATE' WHEN shift < 0 THEN 'EARLY' ELSE 'ON TIME' END END AS variation_status,
  CASE WHEN msg_type = '0003' THEN CASE WHEN event_type = 'click' THEN 'ARRIVAL' ELSE 'DEPARTURE' END END AS event_type
FROM (
  SELECT *, epoch_us(ts) // 1000 AS pms, round(value - 40.0::DOUBLE) AS shift,
         CASE WHEN event_type = 'error' THEN '0002' WHEN event_type = 'signup' THEN '0001' ELSE '0003' END AS msg_type
  FROM {src}
)
"""

_MV = """
SELECT d.*, l.stanox, l.tiploc, l.alpha3, l.local_name, l.local_name_short FROM (
  SELECT train_id, loc_stanox, event_type,
         TRY_CAST(planned_timestamp AS BIGINT) AS planned_timestamp,
         TRY_CAST(actual_timestamp AS BIGINT) AS actual_timestamp,
         TRY_CAST(timetable_variation AS INTEGER) AS timetable_variation,
         variation_status,
         CAST(TRY_CAST(actual_timestamp AS BIGINT) - TRY_CAST(planned_timestamp AS BIGINT) AS DOUBLE) / 1000.0::DOUBLE AS delay_seconds
  FROM {feed} WHERE msg_type = '0003'
) d LEFT JOIN loc_dim l ON d.loc_stanox = l.stanox
"""

_CX = """
SELECT c.*, l.stanox, l.tiploc, l.alpha3, l.local_name, l.local_name_short FROM (
  SELECT train_id, train_service_code, toc_id, loc_stanox,
         TRY_CAST(canx_timestamp AS BIGINT) AS canx_timestamp, canx_reason_code, canx_type
  FROM {feed} WHERE msg_type = '0002'
) c LEFT JOIN loc_dim l ON c.loc_stanox = l.stanox
"""

MV_COLS = ("train_id, loc_stanox, tiploc, alpha3, local_name, event_type, planned_timestamp, "
           "actual_timestamp, variation_status, delay_seconds")
CX_COLS = ("train_id, train_service_code, toc_id, loc_stanox, tiploc, alpha3, local_name, "
           "canx_timestamp, canx_reason_code, canx_type")
AB_COLS = ("event_source, train_id, alpha3, loc_stanox, local_name, event_type, event_timestamp, "
           "delay_seconds, anomaly_type, anomaly_score, explanation")


def r4(expr: str) -> str:
    """Round to 4 places, nudged 1e-9 away from zero (see ``catalog._r4``)."""
    return f"round(({expr}) + sign({expr}) * 1e-9::DOUBLE, 4)"


def _nf(cols: str) -> str:
    return ", ".join(f"{c.strip()} NULLS FIRST" for c in cols.split(","))


_CTES = f"""
WITH
ev2 AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0),
feed AS ({_FEED.format(src="events")}),
feed2 AS ({_FEED.format(src="ev2")}),
loc_records AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS STANOX,
         'TPL' || CAST(n_nationkey AS VARCHAR) AS TIPLOC,
         CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'A' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS "3ALPHA",
         n_name AS NLCDESC, substring(n_name, 1, 16) AS NLCDESC16
  FROM nation
  UNION ALL
  SELECT CASE WHEN s_acctbal < 0 THEN '   ' ELSE ' ' || lpad(CAST(s_nationkey AS VARCHAR), 5, '0') || ' ' END,
         'TPL' || CAST(s_nationkey AS VARCHAR) || 'S' || CAST(s_suppkey AS VARCHAR),
         CAST(NULL AS VARCHAR), s_name, substring(s_name, 1, 16)
  FROM supplier
),
loc_dim AS (
  SELECT stanox, tiploc, alpha3, local_name, local_name_short FROM (
    SELECT trim(STANOX) AS stanox, trim(TIPLOC) AS tiploc, trim("3ALPHA") AS alpha3,
           trim(NLCDESC) AS local_name, trim(NLCDESC16) AS local_name_short
    FROM loc_records
  ) WHERE stanox IS NOT NULL AND stanox <> ''
  QUALIFY row_number() OVER (
    PARTITION BY stanox
    ORDER BY CASE WHEN alpha3 IS NOT NULL AND alpha3 <> '' THEN 0 ELSE 1 END,
             tiploc NULLS FIRST, alpha3 NULLS FIRST, local_name NULLS FIRST, local_name_short NULLS FIRST) = 1
),
coord_records AS (
  SELECT CASE WHEN n_nationkey % 12 = 0 THEN 'Z' ELSE 'A' END || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS alpha3,
         CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE n_name END AS station_name,
         CAST(50.0::DOUBLE + CAST(n_nationkey AS DOUBLE) * 0.3::DOUBLE AS VARCHAR) AS latitude,
         CAST(-5.0::DOUBLE + CAST(n_nationkey AS DOUBLE) * 0.25::DOUBLE AS VARCHAR) AS longitude,
         CAST(n_nationkey AS BIGINT) AS record_no
  FROM nation
  UNION ALL
  SELECT CASE WHEN s_nationkey % 12 = 0 THEN 'Z' ELSE 'A' END || lpad(CAST(s_nationkey AS VARCHAR), 2, '0'), s_name,
         CASE WHEN s_acctbal < 0 THEN 'n/a' ELSE CAST(49.0::DOUBLE + CAST(s_nationkey AS DOUBLE) * 0.3::DOUBLE AS VARCHAR) END,
         CAST(-6.0::DOUBLE + CAST(s_nationkey AS DOUBLE) * 0.25::DOUBLE AS VARCHAR),
         CAST(1000 + s_suppkey AS BIGINT)
  FROM supplier
),
coord AS (
  SELECT alpha3, station_name, latitude, longitude FROM (
    SELECT alpha3, station_name, TRY_CAST(latitude AS DOUBLE) AS latitude,
           TRY_CAST(longitude AS DOUBLE) AS longitude, record_no
    FROM coord_records
  ) WHERE alpha3 IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY alpha3 ORDER BY record_no NULLS FIRST, station_name NULLS FIRST,
                                                        latitude, longitude) = 1
),
mv AS ({_MV.format(feed="feed")}),
cx AS ({_CX.format(feed="feed")}),
mv_rows2 AS (SELECT {MV_COLS} FROM ({_MV.format(feed="feed2")})),
cx_rows2 AS (SELECT {CX_COLS} FROM ({_CX.format(feed="feed2")})),
mvd_raw AS (
  SELECT * FROM mv_rows2
  QUALIFY row_number() OVER (
    PARTITION BY train_id, loc_stanox, event_type, planned_timestamp, actual_timestamp, variation_status, delay_seconds
    ORDER BY tiploc NULLS FIRST, alpha3 NULLS FIRST, local_name NULLS FIRST) = 1
),
cxd_raw AS (
  SELECT * FROM cx_rows2
  QUALIFY row_number() OVER (
    PARTITION BY train_id, loc_stanox, tiploc, canx_timestamp, canx_reason_code, canx_type
    ORDER BY train_service_code NULLS FIRST, toc_id NULLS FIRST, alpha3 NULLS FIRST, local_name NULLS FIRST) = 1
),
mvd AS (
  SELECT train_id, loc_stanox, tiploc, alpha3, local_name, event_type, planned_timestamp,
         epoch_ms(actual_timestamp) AS actual_timestamp, variation_status, delay_seconds,
         delay_seconds / 60.0::DOUBLE AS delay_minutes
  FROM mvd_raw
),
cxd AS (
  SELECT train_id, train_service_code, toc_id, loc_stanox, tiploc, alpha3, local_name,
         epoch_ms(canx_timestamp) AS canx_timestamp, canx_reason_code, canx_type
  FROM cxd_raw
),
station_mvd AS (SELECT * FROM mvd WHERE alpha3 IS NOT NULL AND alpha3 <> ''),
large AS (
  SELECT 'movement' AS event_source, train_id, alpha3, loc_stanox, local_name, event_type,
         epoch_ms(actual_timestamp) AS event_timestamp, delay_seconds, 'large_delay' AS anomaly_type,
         delay_seconds AS anomaly_score, 'Train delay is at least 30 minutes.' AS explanation
  FROM mvd_raw WHERE delay_seconds >= 1800
),
st AS (
  SELECT local_name, avg(delay_seconds) AS mean, stddev_samp(delay_seconds) AS std, count(delay_seconds) AS n
  FROM mvd_raw WHERE delay_seconds IS NOT NULL AND local_name IS NOT NULL GROUP BY local_name
),
outl AS (
  SELECT 'movement' AS event_source, m.train_id, m.alpha3, m.loc_stanox, m.local_name, m.event_type,
         epoch_ms(m.actual_timestamp) AS event_timestamp, m.delay_seconds, 'station_delay_outlier' AS anomaly_type,
         (m.delay_seconds - s.mean) / s.std AS anomaly_score,
         'Delay is unusually high compared with other delays at the same station.' AS explanation
  FROM mvd_raw m JOIN st s ON m.local_name = s.local_name
  WHERE m.delay_seconds IS NOT NULL AND s.std > 0 AND s.n >= 5 AND (m.delay_seconds - s.mean) / s.std >= 3.0
),
spikes AS ({{spikes_1h}}),
ab AS (SELECT * FROM large UNION ALL SELECT * FROM outl UNION ALL SELECT * FROM spikes),
wev AS (
  SELECT epoch_ms(actual_timestamp) AS event_time, local_name AS station,
         delay_seconds / 60.0::DOUBLE AS delay_minutes, 0 AS is_cancelled FROM mvd_raw
  UNION ALL
  SELECT epoch_ms(canx_timestamp), local_name, CAST(NULL AS DOUBLE), 1 FROM cxd_raw
),
wstats AS (
  SELECT time_bucket(INTERVAL 10 minute, event_time) AS window_start,
         time_bucket(INTERVAL 10 minute, event_time) + INTERVAL 10 minute AS window_end,
         station, count(*) AS event_count, avg(delay_minutes) AS avg_delay,
         CAST(sum(is_cancelled) AS BIGINT) AS cancellation_count
  FROM wev WHERE event_time IS NOT NULL GROUP BY ALL
),
smap_stats AS (
  SELECT alpha3, count(*) AS event_count, avg(delay_minutes) AS avg_delay,
         count(*) FILTER (WHERE delay_minutes >= 30) AS large_delay_count
  FROM station_mvd WHERE alpha3 IS NOT NULL GROUP BY alpha3
),
ab_counts AS (
  SELECT alpha3, count(*) AS abnormal_count FROM ab WHERE alpha3 IS NOT NULL AND alpha3 <> '' GROUP BY alpha3
),
smap AS (
  SELECT s.alpha3, s.event_count, coalesce(s.avg_delay, 0.0::DOUBLE) AS avg_delay, s.large_delay_count,
         c.station_name, c.latitude, c.longitude, CAST(coalesce(a.abnormal_count, 0) AS INTEGER) AS abnormal_count
  FROM smap_stats s JOIN coord c ON s.alpha3 = c.alpha3 LEFT JOIN ab_counts a ON s.alpha3 = a.alpha3
)
"""

_SPIKES = """
SELECT 'cancellation' AS event_source, CAST(NULL AS VARCHAR) AS train_id, CAST(NULL AS VARCHAR) AS alpha3,
       CAST(NULL AS VARCHAR) AS loc_stanox, local_name, 'CANCELLATION_SPIKE' AS event_type,
       time_bucket(INTERVAL {width}, epoch_ms(canx_timestamp)) AS event_timestamp,
       CAST(NULL AS DOUBLE) AS delay_seconds, 'cancellation_spike' AS anomaly_type,
       CAST(count(*) AS DOUBLE) AS anomaly_score,
       'Unusually many cancellations occurred at the same station within one hour.' AS explanation
FROM cxd_raw WHERE local_name IS NOT NULL AND canx_timestamp IS NOT NULL
GROUP BY local_name, time_bucket(INTERVAL {width}, epoch_ms(canx_timestamp))
HAVING count(*) >= {least}
"""

CTES = _CTES.replace("{spikes_1h}", _SPIKES.format(width="1 hour", least=5))


def _q(body: str) -> str:
    return CTES + body


def _map_select(where: str = "") -> str:
    return f"""
SELECT alpha3, event_count, {r4("avg_delay")} AS avg_delay, large_delay_count, station_name, latitude, longitude,
       abnormal_count,
       {r4("sqrt(least(greatest(CAST(event_count AS DOUBLE), 1.0::DOUBLE), 100.0::DOUBLE)) * 1000.0::DOUBLE")} AS marker_size,
       {r4("sqrt(least(greatest(CAST(abnormal_count AS DOUBLE), 1.0::DOUBLE), 20.0::DOUBLE)) * 900.0::DOUBLE")} AS abnormal_marker_size,
       80 + CAST(floor(least(greatest(avg_delay, 0.0::DOUBLE), 60.0::DOUBLE) / 60.0::DOUBLE * 175.0::DOUBLE) AS INTEGER) AS delay_color_r,
       180 - CAST(floor(least(greatest(avg_delay, 0.0::DOUBLE), 60.0::DOUBLE) / 60.0::DOUBLE * 140.0::DOUBLE) AS INTEGER) AS delay_color_g,
       80 AS delay_color_b, 80 AS delay_color_a,
       CASE WHEN abnormal_count > 0 THEN 255 ELSE 0 END AS abnormal_color_r,
       CASE WHEN abnormal_count > 0 THEN 220 ELSE 0 END AS abnormal_color_g,
       CASE WHEN abnormal_count > 0 THEN 0 ELSE 0 END AS abnormal_color_b,
       CASE WHEN abnormal_count > 0 THEN 230 ELSE 0 END AS abnormal_color_a,
       coalesce(station_name, alpha3) || chr(10) || 'Alpha3: ' || alpha3
         || chr(10) || 'Events: ' || CAST(event_count AS VARCHAR)
         || chr(10) || 'Average: ' || CAST(round_even(avg_delay, 2) AS VARCHAR) || ' min'
         || chr(10) || 'Large delays: ' || CAST(large_delay_count AS VARCHAR)
         || chr(10) || 'Abnormal events: ' || CAST(abnormal_count AS VARCHAR) AS tooltip
FROM smap {where}
"""


def _value_counts(src: str, col: str, limit: str = "", where: str = "", label: str | None = None) -> str:
    key = label or f"coalesce({col}, 'unknown')"
    return (f"SELECT {key} AS {col}, count(*) AS count FROM {src} {where} "
            f"GROUP BY 1 ORDER BY count DESC, {col} ASC {limit}")


_LATE_CI = "lower(variation_status) = 'late'"
_ANOMALY_LABEL = ("CASE coalesce(anomaly_type, 'unknown') WHEN 'large_delay' THEN 'Large Delay' "
                  "WHEN 'station_delay_outlier' THEN 'Station Delay Outlier' "
                  "WHEN 'cancellation_spike' THEN 'Cancellation Spike' ELSE coalesce(anomaly_type, 'unknown') END")
_AB_R4 = AB_COLS.replace("anomaly_score", f"{r4('anomaly_score')} AS anomaly_score")


def _filled(src: str, tcol: str, ccol: str, where: str) -> str:
    return f"""
, c AS (SELECT time_bucket(INTERVAL 1 hour, {tcol}) AS b, count(*) AS n FROM {src}
        WHERE {tcol} IS NOT NULL {where} GROUP BY 1),
  s AS (SELECT unnest(generate_series((SELECT min(b) FROM c), (SELECT max(b) FROM c), INTERVAL 1 hour)) AS b)
SELECT s.b AS {tcol}, CAST(coalesce(c.n, 0) AS BIGINT) AS {ccol} FROM s LEFT JOIN c ON s.b = c.b
"""


def _over_time(src: str, tcol: str, ccol: str, width: str, where: str = "") -> str:
    return (f"SELECT time_bucket(INTERVAL {width}, {tcol}) AS {tcol}, count(*) AS {ccol} FROM {src} "
            f"WHERE {tcol} IS NOT NULL {where} GROUP BY 1")


ORACLE_SQL: dict[str, str] = {
    "feed_parse": _q("SELECT * FROM feed"),
    "feed_quarantine": _q(
        """, landing AS (
             SELECT CAST(to_json(struct_pack(
                      header := struct_pack(msg_type := msg_type, msg_queue_timestamp := msg_queue_timestamp,
                                            source_system_id := source_system_id),
                      body := struct_pack(train_id := train_id, loc_stanox := loc_stanox))) AS VARCHAR) AS v,
                    msg_type
             FROM feed),
           frames AS (
             SELECT v FROM landing
             UNION ALL SELECT substring(v, 1, length(v) - 1) FROM landing WHERE msg_type = '0001')
           SELECT CASE WHEN json_valid(v) THEN 'ok' ELSE 'corrupt' END AS status, count(*) AS count
           FROM frames GROUP BY 1"""
    ),
    "feed_header_preview": _q(
        "SELECT msg_type, msg_queue_timestamp AS queue_timestamp, source_system_id FROM feed "
        "ORDER BY msg_type, queue_timestamp, source_system_id LIMIT 20"
    ),
    "count_by_msg_type": _q("SELECT msg_type, count(*) AS count FROM feed GROUP BY msg_type"),
    "extract_movements": _q(
        "SELECT train_id, loc_stanox, actual_timestamp, planned_timestamp, timetable_variation, "
        "variation_status, event_type FROM feed WHERE msg_type = '0003'"
    ),
    "extract_cancellations": _q(
        "SELECT train_id, train_service_code, toc_id, loc_stanox, TRY_CAST(canx_timestamp AS BIGINT) AS canx_timestamp, "
        "canx_reason_code, canx_type FROM feed WHERE msg_type = '0002'"
    ),
    "calculate_delay": _q(
        "SELECT train_id, loc_stanox, event_type, planned_timestamp, actual_timestamp, timetable_variation, "
        "variation_status, delay_seconds FROM mv"
    ),
    "delay_info": _q(
        "SELECT train_id, local_name, event_type, delay_seconds, timetable_variation, variation_status FROM mv"
    ),
    "location_dim": _q("SELECT * FROM loc_dim"),
    "station_coordinates": _q("SELECT * FROM coord"),
    "enrich_movements": _q("SELECT * FROM mv"),
    "enrich_cancellations": _q("SELECT * FROM cx"),
    "movement_output": _q(
        f"""SELECT * FROM mv_rows2 QUALIFY row_number() OVER (
              PARTITION BY train_id, loc_stanox, event_type, planned_timestamp, actual_timestamp
              ORDER BY {_nf('tiploc, alpha3, local_name, variation_status, delay_seconds')}) = 1"""
    ),
    "cancellation_output": _q(
        f"""SELECT * FROM cx_rows2 QUALIFY row_number() OVER (
              PARTITION BY train_id, loc_stanox, canx_timestamp, canx_type
              ORDER BY {_nf('train_service_code, toc_id, tiploc, alpha3, local_name, canx_reason_code')}) = 1"""
    ),
    "dedup_movements": _q("SELECT * FROM mvd_raw"),
    "dedup_cancellations": _q("SELECT * FROM cxd_raw"),
    "prepare_movements": _q("SELECT * FROM mvd"),
    "prepare_cancellations": _q("SELECT * FROM cxd"),
    "prepare_abnormal_events": _q(
        f"""SELECT {_AB_R4} FROM (SELECT * FROM ab UNION ALL SELECT * FROM ab
              UNION ALL SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS event_timestamp) FROM large)
            QUALIFY row_number() OVER (
              PARTITION BY event_source, train_id, loc_stanox, local_name, event_type, event_timestamp, anomaly_type
              ORDER BY {_nf('alpha3, delay_seconds, anomaly_score, explanation')}) = 1"""
    ),
    "canx_by_reason": _q("SELECT canx_reason_code, count(*) AS count FROM cx GROUP BY 1"),
    "canx_by_location": _q("SELECT local_name, count(*) AS count FROM cx GROUP BY 1"),
    "canx_by_stanox": _q("SELECT loc_stanox, count(*) AS count FROM cx GROUP BY 1"),
    "movements_by_status": _q("SELECT variation_status, count(*) AS count FROM mv GROUP BY 1"),
    "delays_by_event_type": _q("SELECT event_type, count(*) AS count FROM mv GROUP BY 1"),
    "location_status_counts": _q(
        "SELECT local_name, variation_status, count(*) AS count FROM mv GROUP BY 1, 2"
    ),
    "late_by_location": _q(
        "SELECT local_name, count(*) AS count FROM mv WHERE variation_status = 'LATE' GROUP BY 1 "
        "ORDER BY count DESC, local_name ASC NULLS FIRST LIMIT 20"
    ),
    "late_delay_by_location": _q(
        f"SELECT local_name, late_count, {r4('avg_delay_seconds')} AS avg_delay_seconds FROM ("
        " SELECT local_name, count(*) AS late_count, avg(delay_seconds) AS avg_delay_seconds FROM mv"
        " WHERE variation_status = 'LATE' GROUP BY 1"
        " ORDER BY avg_delay_seconds DESC NULLS LAST, local_name ASC NULLS FIRST LIMIT 20)"
    ),
    "status_distribution": _q(_value_counts("mvd", "variation_status")),
    "top_delayed_locations": _q(_value_counts("mvd", "local_name", "LIMIT 10", f"WHERE {_LATE_CI}")),
    "top_delayed_stations": _q(_value_counts("station_mvd", "local_name", "LIMIT 10", f"WHERE {_LATE_CI}")),
    "top_avg_delay_locations": _q(
        f"SELECT local_name, {r4('a')} AS avg_delay_minutes FROM ("
        " SELECT local_name, avg(delay_minutes) AS a FROM mvd"
        " WHERE delay_minutes IS NOT NULL AND local_name IS NOT NULL GROUP BY 1"
        " ORDER BY a DESC, local_name ASC LIMIT 10)"
    ),
    "top_avg_delay_stations": _q(
        f"SELECT local_name, {r4('a')} AS avg_delay_minutes FROM ("
        " SELECT local_name, avg(delay_minutes) AS a FROM station_mvd"
        " WHERE delay_minutes IS NOT NULL AND local_name IS NOT NULL GROUP BY 1"
        " ORDER BY a DESC, local_name ASC LIMIT 10)"
    ),
    "top_cancelled_locations": _q(_value_counts("cxd", "local_name", "LIMIT 10")),
    "canx_reason_distribution": _q(_value_counts("cxd", "canx_reason_code")),
    "anomaly_type_distribution": _q(_value_counts("ab", "anomaly_type", label=_ANOMALY_LABEL)),
    "top_abnormal_stations": _q(
        _value_counts("ab", "local_name", "LIMIT 10", "WHERE alpha3 IS NOT NULL AND alpha3 <> ''")
    ),
    "smoke_avg_by_key": _q(
        f"SELECT local_name, {r4('avg(delay_minutes)')} AS avg_delay_minutes FROM mvd GROUP BY 1"
    ),
    "dashboard_kpis": _q(
        f"""SELECT (SELECT count(*) FROM mvd) AS movement_events,
                   (SELECT count(*) FROM station_mvd WHERE {_LATE_CI}) AS station_delayed_events,
                   (SELECT count(*) FROM cxd) AS cancellation_events,
                   (SELECT count(*) FROM ab WHERE alpha3 IS NOT NULL AND alpha3 <> '') AS station_abnormal_events,
                   (SELECT {r4("avg(delay_minutes)")} FROM station_mvd) AS avg_station_delay"""
    ),
    "station_movements": _q("SELECT * FROM station_mvd"),
    "station_abnormal_events": _q(f"SELECT {_AB_R4} FROM ab WHERE alpha3 IS NOT NULL AND alpha3 <> ''"),
    "preview_station_movements": _q(
        "SELECT * FROM station_mvd ORDER BY actual_timestamp NULLS FIRST, train_id NULLS FIRST, "
        "loc_stanox NULLS FIRST, event_type NULLS FIRST, planned_timestamp NULLS FIRST LIMIT 100"
    ),
    "preview_cancellations": _q(
        f"SELECT * FROM cxd ORDER BY {_nf('canx_timestamp, train_id, loc_stanox, train_service_code, toc_id, canx_type')} LIMIT 100"
    ),
    "preview_station_abnormal_events": _q(
        f"SELECT {_AB_R4} FROM (SELECT * FROM ab WHERE alpha3 IS NOT NULL AND alpha3 <> '' ORDER BY "
        f"{_nf('event_timestamp, local_name, train_id, anomaly_type, event_source, alpha3, loc_stanox, event_type, delay_seconds')} LIMIT 100)"
    ),
    "preview_station_map": _q(_map_select() + " ORDER BY alpha3 LIMIT 100"),
    "statistics_canx_preview": _q(
        f"SELECT * FROM cx ORDER BY {_nf('canx_timestamp, train_id, loc_stanox, train_service_code, toc_id, canx_type')} LIMIT 20"
    ),
    "statistics_movement_preview": _q(
        f"SELECT * FROM mv ORDER BY {_nf('actual_timestamp, train_id, loc_stanox, event_type, planned_timestamp')} LIMIT 20"
    ),
    "statistics_delay_preview": _q(
        "SELECT train_id, local_name, event_type, delay_seconds, timetable_variation, variation_status FROM mv "
        f"ORDER BY {_nf('train_id, local_name, event_type, delay_seconds, timetable_variation, variation_status')} LIMIT 20"
    ),
    "station_delay_stats": _q(f"SELECT local_name, {r4('mean')} AS mean, {r4('std')} AS std, n FROM st"),
    "large_delays": _q(f"SELECT {_AB_R4} FROM large"),
    "station_delay_outliers": _q(f"SELECT {_AB_R4} FROM outl"),
    "cancellation_spikes": _q("SELECT * FROM spikes"),
    "cancellation_spikes_daily": _q(_SPIKES.format(width="1 day", least=5)),
    "cancellation_spikes_pairs": _q(_SPIKES.format(width="1 hour", least=2)),
    "abnormal_events": _q(f"SELECT {_AB_R4} FROM ab"),
    "station_window_stats": _q(
        f"SELECT window_start, window_end, station, event_count, {r4('avg_delay')} AS avg_delay, "
        "cancellation_count FROM wstats"
    ),
    "window_station_delay": _q(
        f"SELECT station, {r4('avg(avg_delay)')} AS avg_delay FROM wstats WHERE station IS NOT NULL GROUP BY 1"
    ),
    "window_station_cancels": _q(
        "SELECT station, CAST(sum(cancellation_count) AS BIGINT) AS cancellation_count FROM wstats "
        "WHERE station IS NOT NULL GROUP BY 1"
    ),
    "window_event_totals": _q(
        "SELECT window_start, CAST(sum(event_count) AS BIGINT) AS event_count FROM wstats GROUP BY 1"
    ),
    "late_hourly_filled": _q(_filled("mvd", "actual_timestamp", "delay_count", f"AND {_LATE_CI}")),
    "canx_hourly_filled": _q(_filled("cxd", "canx_timestamp", "cancel_count", "")),
    "delays_over_time_10min": _q(_over_time("mvd", "actual_timestamp", "delay_count", "10 minute", f"AND {_LATE_CI}")),
    "delays_over_time_1h": _q(_over_time("mvd", "actual_timestamp", "delay_count", "1 hour", f"AND {_LATE_CI}")),
    "delays_over_time_1d": _q(_over_time("mvd", "actual_timestamp", "delay_count", "1 day", f"AND {_LATE_CI}")),
    "canx_over_time_1h": _q(_over_time("cxd", "canx_timestamp", "cancel_count", "1 hour")),
    "abnormal_over_time_1h": _q(_over_time("ab", "event_timestamp", "abnormal_count", "1 hour")),
    "rollup_partials": _q(
        f"""SELECT time_bucket(INTERVAL 10 minute, t) AS bucket, station, CAST(sum(m) AS BIGINT) AS movements,
              CAST(sum(l) AS BIGINT) AS late, CAST(sum(1 - m) AS BIGINT) AS cancellations,
              CAST(count(us) AS BIGINT) AS delays, CAST(sum(us) AS BIGINT) AS delay_us
            FROM (SELECT epoch_ms(actual_timestamp) AS t, local_name AS station, 1 AS m,
                         CASE WHEN {_LATE_CI} THEN 1 ELSE 0 END AS l, (actual_timestamp - planned_timestamp) * 1000 AS us
                  FROM mvd_raw
                  UNION ALL SELECT epoch_ms(canx_timestamp), local_name, 0, 0, NULL FROM cxd_raw)
            WHERE t IS NOT NULL GROUP BY ALL"""
    ),
    "rollup_station_window_stats": _q(
        f"SELECT window_start, window_end, station, event_count, {r4('avg_delay')} AS avg_delay, "
        "cancellation_count FROM wstats"
    ),
    "rollup_delays_over_time_1h": _q(_over_time("mvd", "actual_timestamp", "delay_count", "1 hour", f"AND {_LATE_CI}")),
    "rollup_delays_over_time_1d": _q(_over_time("mvd", "actual_timestamp", "delay_count", "1 day", f"AND {_LATE_CI}")),
    "rollup_canx_hourly_filled": _q(_filled("cxd", "canx_timestamp", "cancel_count", "")),
    "rollup_spike_counts_daily": _q(
        """SELECT local_name AS station, time_bucket(INTERVAL 1 day, canx_timestamp) AS bucket, count(*) AS cancel_count
           FROM cxd WHERE local_name IS NOT NULL AND canx_timestamp IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5"""
    ),
    "station_stats": _q(
        f"SELECT alpha3, event_count, {r4('avg_delay')} AS avg_delay, large_delay_count FROM smap_stats"
    ),
    "station_abnormal_counts": _q("SELECT * FROM ab_counts"),
    "station_map": _q(_map_select()),
    "abnormal_map": _q(_map_select("WHERE abnormal_count >= 3")),
    "abnormal_map_above_mean": _q(_map_select("WHERE abnormal_count >= (SELECT ceil(avg(abnormal_count)) FROM smap)")),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
