"""The same results in DuckDB SQL over the given tables.

Means are rounded on both sides; alerts are joined into one text.
"""

from __future__ import annotations


def near(value: str, digits: int = 6) -> str:
    """Rounded after a small odd shift, like `queries.rounded`."""
    return f"round(({value}) + 0.1234567e-{digits}::double, {digits})"


def each(value: str, name: str, digits: int = 6) -> str:
    """One such column per measure; `{m}` stands for the measure."""
    return ", ".join(
        f"{near(value.format(m=m), digits)} AS {name.format(m=m)}"
        for m in ("iops", "latency", "capacity_used")
    )


def even(value: str, digits: int) -> str:
    """Rounded on the shortest decimal text of a double, ties to even."""
    scaled = f"(cast(cast({value} AS varchar) AS decimal(28,18)) * {10**digits})"
    over = f"{scaled} - floor({scaled})"
    up = f"CASE WHEN {over} > 0.5 OR ({over} = 0.5 AND floor({scaled}) % 2 <> 0) THEN 1 ELSE 0 END"
    return f"cast(floor({scaled}) + {up} AS double) / {10**digits}"


METRICS = """
metrics AS (
  SELECT cast(event_id AS varchar) AS _id,
         'dev' || lpad(cast(user_id % 12 + 1 AS varchar), 2, '0') AS device_id,
         epoch(ts) AS "timestamp",
         100 + 100 * cast(json_extract_string(props, '$.k') AS int) AS iops,
         1 + least(value, 140.0::double) / 10 AS latency,
         round(100 + (event_id * 7919 % 80001) / 100.0::double, 2) AS capacity_used,
         ts AS event_time
  FROM events
)"""

LATENCY_ALERT = "High average latency detected: > 10.0ms"
IOPS_ALERT = "Low average IOPS detected: < 500"
CAPACITY_ALERT = "High capacity usage detected: > 800.0GB"

START_US, END_US = 1704067200000000, 1706659200000000
ODD_START_US, ODD_END_US = 1704068434500000, 1706400000250000

SUMMARY = """
         avg(iops) AS avg_iops, avg(latency) AS avg_latency, avg(capacity_used) AS avg_capacity_used,
         cast(max(iops) AS double) AS max_iops, max(latency) AS max_latency,
         max(capacity_used) AS max_capacity_used,
         cast(min(iops) AS double) AS min_iops, min(latency) AS min_latency,
         min(capacity_used) AS min_capacity_used, count(*) AS metrics_count"""


def insights(first: int, last: int, minutes: int, rows: str = "metrics") -> str:
    """CTE `insights`: periods of `minutes` from `first`, the last one clipped to `last`."""
    width = minutes * 60_000_000
    return f"""
insights AS (
  SELECT device_id, make_timestamp(slot) AS period_start,
         make_timestamp(least(slot + {width}, {last})) AS period_end, * EXCLUDE (device_id, slot)
  FROM (
    SELECT device_id,
           {first} + ((epoch_us(event_time) - {first}) // {width}) * {width} AS slot,{SUMMARY}
    FROM {rows}
    WHERE epoch_us(event_time) >= {first} AND epoch_us(event_time) < {last}
    GROUP BY ALL
  )
)"""


HOURLY = f"WITH {METRICS}, {insights(START_US, END_US, 60)}"

def flat_columns(latency: float = 10.0, iops: int = 500, capacity: float = 800.0) -> str:
    return f"""
       device_id, period_start, period_end,
       {each("avg_{m}", "avg_{m}")},
       max_iops, max_latency, max_capacity_used, min_iops, min_latency, min_capacity_used,
       metrics_count,
       concat_ws('|',
         CASE WHEN avg_latency > {latency} THEN 'High average latency detected: > {latency}ms' END,
         CASE WHEN avg_iops < {iops} THEN 'Low average IOPS detected: < {iops}' END,
         CASE WHEN avg_capacity_used > {capacity} THEN 'High capacity usage detected: > {capacity}GB' END) AS alerts"""


FLAT_COLUMNS = flat_columns()

ALERTS = f"""
alerts AS (
  SELECT period_end AS "timestamp", '{LATENCY_ALERT}' AS alert, device_id
  FROM insights WHERE avg_latency > 10.0
  UNION ALL
  SELECT period_end, '{IOPS_ALERT}', device_id FROM insights WHERE avg_iops < 500
  UNION ALL
  SELECT period_end, '{CAPACITY_ALERT}', device_id FROM insights WHERE avg_capacity_used > 800.0
)"""

LOOSE = """
loose AS (
  SELECT _id,
         CASE WHEN cast(_id AS bigint) % 17 = 3 THEN NULL ELSE device_id END AS device_id,
         CASE WHEN cast(_id AS bigint) % 23 = 5 THEN NULL ELSE "timestamp" END AS "timestamp",
         CASE WHEN cast(_id AS bigint) % 19 = 7 THEN NULL ELSE iops END AS iops,
         CASE WHEN cast(_id AS bigint) % 29 = 11 THEN NULL ELSE latency END AS latency,
         capacity_used,
         CASE WHEN cast(_id AS bigint) % 23 = 5 THEN NULL ELSE event_time END AS event_time,
         CASE WHEN cast(_id AS bigint) % 17 = 3 THEN 'device_id'
              WHEN cast(_id AS bigint) % 23 = 5 THEN 'timestamp'
              WHEN cast(_id AS bigint) % 29 = 11 THEN 'latency' END AS reason
  FROM metrics
),
good AS (SELECT * EXCLUDE (reason) FROM loose WHERE reason IS NULL)"""

GAPPY = f"WITH {METRICS}, {LOOSE}, {insights(START_US, END_US, 60, 'good')}"

FLAT = f"{HOURLY} SELECT {FLAT_COLUMNS} FROM insights"
ALL_METRICS = f"WITH {METRICS} SELECT * FROM metrics"
RECENT = f'{ALL_METRICS} ORDER BY "timestamp" DESC, _id DESC LIMIT 50'


def one_period(first: int, last: int) -> str:
    return f"""WITH {METRICS}, insights AS (
  SELECT device_id, make_timestamp({first}) AS period_start, make_timestamp({last}) AS period_end,{SUMMARY}
  FROM metrics WHERE epoch_us(event_time) >= {first} AND epoch_us(event_time) < {last}
  GROUP BY device_id
) SELECT {FLAT_COLUMNS} FROM insights"""


def _trend(measure: str, above: str, below: str) -> str:
    return f"""CASE WHEN earlier = 0 THEN 'new'
            WHEN (avg_{measure} - hist_{measure}) / hist_{measure} > 0.05 THEN '{above}'
            WHEN (avg_{measure} - hist_{measure}) / hist_{measure} < -0.05 THEN '{below}'
            ELSE 'stable' END AS {measure}_trend"""


TRENDS = f"""{HOURLY}, past AS (
  SELECT *, avg(avg_iops) OVER earlier_rows AS hist_iops,
         avg(avg_latency) OVER earlier_rows AS hist_latency,
         avg(avg_capacity_used) OVER earlier_rows AS hist_capacity_used,
         count(*) OVER earlier_rows AS earlier
  FROM insights
  WINDOW earlier_rows AS (PARTITION BY device_id ORDER BY period_start, period_end
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT device_id, period_start, period_end,
       {each("avg_{m}", "avg_{m}", 4)},
       max_iops, max_latency, max_capacity_used, min_iops, min_latency, min_capacity_used,
       metrics_count,
       {each("hist_{m}", "hist_{m}", 4)},
       {each("avg_{m} - hist_{m}", "delta_{m}", 4)},
       {each("(avg_{m} - hist_{m}) / hist_{m}", "pct_{m}", 4)},
       {_trend("iops", "improving", "degrading")},
       {_trend("latency", "degrading", "improving")},
       {_trend("capacity_used", "growing", "shrinking")}
FROM past"""

ORACLES: dict[str, str] = {
    "window_insights": FLAT,
    "device_summary": one_period(START_US, END_US),
    "clipped_windows": f"""WITH {METRICS}, {insights(ODD_START_US, ODD_END_US, 95)}
SELECT {FLAT_COLUMNS} FROM insights""",
    "range_scan": f"""{ALL_METRICS}
WHERE epoch_us(event_time) >= {ODD_START_US} AND epoch_us(event_time) < {ODD_END_US}""",
    "lookback_scan": f"{ALL_METRICS} WHERE event_time >= TIMESTAMP '2024-01-30 00:00:00'",
    "recent_metrics": RECENT,
    "recent_from_table": RECENT,
    "recent_display": f"""WITH {METRICS} SELECT device_id, event_time, iops, latency, capacity_used
FROM metrics ORDER BY "timestamp" DESC, _id DESC LIMIT 10""",
    "live_series": f"""WITH {METRICS} SELECT device_id, event_time, iops, latency, capacity_used
FROM metrics ORDER BY "timestamp" DESC, _id DESC LIMIT 50""",
    "hourly_trends": f"""WITH {METRICS}
SELECT device_id, date_trunc('hour', event_time) AS hour, {each("avg({m})", "{m}")}
FROM metrics GROUP BY ALL""",
    "device_statistics": f"""WITH {METRICS}
SELECT device_id,
       {each("avg({m})", "avg_{m}")},
       cast(min(iops) AS double) AS min_iops, cast(max(iops) AS double) AS max_iops,
       min(latency) AS min_latency, max(latency) AS max_latency,
       min(capacity_used) AS min_capacity_used, max(capacity_used) AS max_capacity_used
FROM metrics GROUP BY device_id""",
    "stream_insights_closed": FLAT,
    "strict_limits": f"{HOURLY} SELECT {flat_columns(5.0, 4000, 500.0)} FROM insights",
    "empty_range": f"{FLAT} WHERE period_end <= TIMESTAMP '2024-01-01 00:00:00'",
    "all_rejected_insights": f"""WITH {METRICS},
unmeasured AS (SELECT * REPLACE (cast(NULL AS double) AS latency) FROM metrics),
{insights(START_US, END_US, 60, "unmeasured")}
SELECT {FLAT_COLUMNS}, 'avg_latency' AS reason FROM insights""",
    "insights_repaired": f"""WITH {METRICS},
left_over AS (SELECT * FROM metrics WHERE cast(_id AS bigint) % 7 <> 3),
{insights(START_US, END_US, 60, "left_over")} SELECT {FLAT_COLUMNS} FROM insights""",
    "device_kpis_display": f"""{HOURLY}, ends AS (
  SELECT device_id, count(*) AS periods,
         arg_max(avg_latency, period_end) AS l1, arg_min(avg_latency, period_end) AS l0,
         arg_max(avg_iops, period_end) AS i1, arg_min(avg_iops, period_end) AS i0,
         arg_max(avg_capacity_used, period_end) AS c1, arg_min(avg_capacity_used, period_end) AS c0
  FROM insights GROUP BY device_id
)
SELECT device_id, {even("l1", 2)} AS latest_latency,
       CASE WHEN periods > 1 THEN {even("l1 - l0", 2)} END AS delta_latency,
       {even("i1", 0)} AS latest_iops, CASE WHEN periods > 1 THEN {even("i1 - i0", 0)} END AS delta_iops,
       {even("c1", 2)} AS latest_capacity,
       CASE WHEN periods > 1 THEN {even("c1 - c0", 2)} END AS delta_capacity
FROM ends""",
    "device_kpis": f"""{HOURLY}, ends AS (
  SELECT device_id, count(*) AS periods,
         arg_max(avg_latency, period_end) AS l1, arg_min(avg_latency, period_end) AS l0,
         arg_max(avg_iops, period_end) AS i1, arg_min(avg_iops, period_end) AS i0,
         arg_max(avg_capacity_used, period_end) AS c1, arg_min(avg_capacity_used, period_end) AS c0
  FROM insights GROUP BY device_id
)
SELECT device_id,
       {near("l1")} AS latest_latency, CASE WHEN periods > 1 THEN {near("l1 - l0")} END AS delta_latency,
       {near("i1")} AS latest_iops, CASE WHEN periods > 1 THEN {near("i1 - i0")} END AS delta_iops,
       {near("c1")} AS latest_capacity, CASE WHEN periods > 1 THEN {near("c1 - c0")} END AS delta_capacity
FROM ends""",
    "device_list": f"""{HOURLY} SELECT device_id FROM insights GROUP BY device_id
ORDER BY max(period_end) DESC, device_id""",
    "device_insights": f"{FLAT} WHERE device_id = 'dev01'",
    "insight_series": f"""{HOURLY}
SELECT period_end, {each("avg_{m}", "avg_{m}")}
FROM insights WHERE device_id = 'dev01' ORDER BY period_end""",
    "insights_lookback": f"{FLAT} WHERE period_end >= TIMESTAMP '2024-01-30 00:00:00'",
    "insights_text_bounds": f"{FLAT} WHERE period_end >= TIMESTAMP '2024-01-30 00:00:00'",
    "insights_rerun": FLAT,
    "insights_table": FLAT,
    "stored_rows": f"""{HOURLY}
SELECT device_id, strftime(period_end, '%Y-%m-%d') AS period_date,
       cast(epoch_us(period_start) AS varchar) || '-' || cast(epoch_us(period_end) AS varchar) AS period_key,
       metrics_count
FROM insights""",
    "jdbc_boundary": f"""{HOURLY}, flat AS (SELECT {FLAT_COLUMNS} FROM insights)
SELECT * REPLACE (CASE WHEN alerts = '' THEN '[]'
                       ELSE '["' || replace(alerts, '|', '","') || '"]' END AS alerts)
FROM flat""",
    "alerts_flat": f"{HOURLY}, {ALERTS} SELECT * FROM alerts",
    "alerts_from_json": f"{HOURLY}, {ALERTS} SELECT * FROM alerts",
    "alert_counts": f"{HOURLY}, {ALERTS} SELECT alert, count(*) AS occurrences FROM alerts GROUP BY alert",
    "alert_text_values": f"""{HOURLY}
SELECT period_end AS "timestamp", device_id, 'High average latency detected: ' AS label,
       {near("avg_latency")} AS shown, 'ms' AS unit, '(threshold: 10.0ms)' AS "limit"
FROM insights WHERE avg_latency > 10.0
UNION ALL
SELECT period_end, device_id, 'Low average IOPS detected: ', {near("avg_iops")}, '', '(threshold: 500)'
FROM insights WHERE avg_iops < 500
UNION ALL
SELECT period_end, device_id, 'High capacity usage detected: ', {near("avg_capacity_used")}, 'GB',
       '(threshold: 800.0GB)'
FROM insights WHERE avg_capacity_used > 800.0""",
    "metrics_total": "SELECT count(*) AS metrics_total FROM events",
    "coerced_metrics": f"""WITH {METRICS}, {LOOSE}
SELECT * EXCLUDE (reason) REPLACE (cast(iops AS double) AS iops) FROM loose""",
    "valid_metrics": f"""WITH {METRICS}, {LOOSE}
SELECT * REPLACE (cast(iops AS double) AS iops) FROM good""",
    "quarantined_metrics": f"""WITH {METRICS}, {LOOSE}
SELECT _id, device_id, reason FROM loose WHERE reason IS NOT NULL""",
    "valid_insights": f"{GAPPY} SELECT {FLAT_COLUMNS} FROM insights WHERE avg_iops IS NOT NULL",
    "quarantined_insights": f"""{GAPPY} SELECT {FLAT_COLUMNS}, 'avg_iops' AS reason
FROM insights WHERE avg_iops IS NULL""",
    "event_time_from_millis": f"""WITH {METRICS}
SELECT _id, date_trunc('millisecond', event_time) AS event_time FROM metrics""",
    "trend_vs_history": TRENDS,
    "enriched_insights": f"""{HOURLY}, devices AS (
  SELECT 'dev' || lpad(cast(n_nationkey + 3 AS varchar), 2, '0') AS device_id, r_name AS site,
         n_name AS model, 1000.0::double + n_nationkey * 10 AS capacity_total
  FROM nation JOIN region ON n_regionkey = r_regionkey
), flat AS (
  SELECT {FLAT_COLUMNS},
         CASE WHEN avg_latency > 10.0 OR avg_iops < 500 THEN 'bronze'
              WHEN avg_latency <= 5.0 AND avg_iops >= 5000 THEN 'gold' ELSE 'silver' END AS tier
  FROM insights
)
SELECT * FROM flat LEFT JOIN devices USING (device_id)""",
    "capacity_forecast": f"""{HOURLY}, lines AS (
  SELECT device_id, regr_slope(avg_capacity_used, epoch(period_start) / 3600) AS slope,
         arg_max(avg_capacity_used, period_end) AS latest, count(*) AS periods
  FROM insights GROUP BY device_id
)
SELECT device_id, {near("slope")} AS slope_per_hour, {near("latest")} AS latest_capacity,
       CASE WHEN latest >= 800.0 THEN {near("0.0", 2)}
            WHEN slope > 0 THEN {near("(800.0 - latest) / slope", 2)} END AS hours_to_threshold
FROM lines WHERE periods >= 2""",
    "stream_ingest": ALL_METRICS,
    "stream_compacted": ALL_METRICS,
    "stream_quarantine": """SELECT 'device_id' AS reason, props AS raw, count(*) AS messages
FROM events GROUP BY props""",
    "stream_insights": f"""{FLAT}
WHERE period_end <= (SELECT max(event_time) FROM metrics) - INTERVAL 10 MINUTE""",
    "live_tail": f"""WITH {METRICS} SELECT *, event_time AS received_at FROM metrics
ORDER BY "timestamp" DESC, _id DESC LIMIT 100""",
    "live_lines": f"""WITH {METRICS}
SELECT '**' || strftime(event_time, '%H:%M:%S') || '** - Device: ' || device_id || ', IOPS: ' || iops || ', ' AS head,
       {near("latency")} AS latency, {near("capacity_used")} AS capacity
FROM metrics ORDER BY "timestamp" DESC, _id DESC LIMIT 10""",
    "batch_lookback": FLAT,
    "batch_range": one_period(ODD_START_US, ODD_END_US),
}
