"""SQL that gives the results of the registered queries on the same tables."""

from __future__ import annotations


def _bucket(width: str, ts: str) -> str:
    return f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01')"


def _events(width: str = "1 day") -> str:
    return f"""
      SELECT event_id, ts, user_id, event_type, value, props,
             CAST(event_type = 'error' AS INTEGER) AS label,
             {_bucket(width, 'ts')} AS window_start,
             {_bucket(width, 'ts')} + INTERVAL '{width}' AS window_end
      FROM events"""


def _lineitem() -> str:
    return f"""
      SELECT l_orderkey, l_linenumber, l_extendedprice, l_extendedprice AS value,
             CAST(l_returnflag = 'R' AS INTEGER) AS label,
             {_bucket('30 days', 'l_shipdate')} AS window_start,
             {_bucket('30 days', 'l_shipdate')} + INTERVAL '30 days' AS window_end
      FROM lineitem"""


CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"


def _stats(source: str, keys: str = "", where: str = "true") -> str:
    return f"""
    SELECT window_start, window_end, {keys}
           round(avg(value), 6) AS avg_amount,
           round(stddev_samp(value), 6) AS stddev_amount,
           round(min(value), 6) AS min_amount,
           round(max(value), 6) AS max_amount,
           round(avg(label), 6) AS avg_fraud_rate
    FROM ({source}) WHERE {where}
    GROUP BY {keys} window_start, window_end"""


def _zscore(
    source: str,
    columns: str,
    group: str = "window_start",
    threshold: float = 3.0,
    where: str = "true",
) -> str:
    return f"""
    WITH rows AS ({source}),
    measured AS (
      SELECT *, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS sd
      FROM rows WINDOW w AS (PARTITION BY {group})
    ),
    judged AS (
      SELECT *, CASE WHEN sd > 0 THEN abs((value - mean) / sd) ELSE 0 END AS z FROM measured
    )
    SELECT {columns}, window_start,
           round(mean, 6) AS avg_amount, round(sd, 6) AS stddev_amount,
           round(z, 6) AS z_score, z > {threshold} AS is_anomaly
    FROM judged WHERE {where}"""


def _bounds(source: str, multiplier: float) -> str:
    return f"""
      SELECT window_start, window_end, avg(value) AS mean,
             quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3,
             q1 - {multiplier} * (q3 - q1) AS lower_bound,
             q3 + {multiplier} * (q3 - q1) AS upper_bound
      FROM ({source}) GROUP BY window_start, window_end"""


def _outside(
    source: str, columns: str, multiplier: float, flag: str = "", where: str = "true"
) -> str:
    return f"""
    WITH rows AS ({source}), bounds AS ({_bounds(source, multiplier)})
    SELECT {columns}, rows.window_start,
           round(q1, 6) AS q1, round(q3, 6) AS q3,
           round(lower_bound, 6) AS lower_bound,
           round(upper_bound, 6) AS upper_bound {flag}
    FROM rows JOIN bounds USING (window_start)
    WHERE (value < lower_bound OR value > upper_bound)
      AND {where}"""


def _data(source: str) -> str:
    return f"""
    SELECT window_start, window_end, count(*) AS transaction_count,
           round(avg(value), 6) AS avg_amount,
           round(stddev_samp(value), 6) AS stddev_amount,
           round(min(value), 6) AS min_amount,
           round(max(value), 6) AS max_amount,
           round(quantile_disc(value, 0.5), 6) AS median_amount,
           round(quantile_disc(value, 0.95), 6) AS p95_amount,
           round(quantile_disc(value, 0.99), 6) AS p99_amount
    FROM ({source}) GROUP BY window_start, window_end"""


def _label(source: str) -> str:
    return f"""
    SELECT window_start, window_end, count(*) AS total_transactions,
           CAST(sum(label) AS BIGINT) AS fraud_count,
           round(avg(label) * 100, 6) AS fraud_rate_percent
    FROM ({source}) GROUP BY window_start, window_end"""


def _linear(source: str) -> str:
    return f"""
      SELECT *, 1 / (1 + exp(-(-2 + 0.01 * value
               + 0.01 * CAST(regexp_extract(props, '"k": *([-0-9.]+)', 1) AS DOUBLE)))) AS p,
             CAST(p > 0.5 AS DOUBLE) AS is_fraud
      FROM ({source})"""


def _prediction(source: str) -> str:
    return f"""
    SELECT window_start, window_end, count(*) AS predictions_count,
           round(avg(p), 6) AS avg_fraud_prob,
           round(stddev_samp(p), 6) AS stddev_fraud_prob,
           round(quantile_disc(p, 0.5), 6) AS median_fraud_prob,
           round(quantile_disc(p, 0.95), 6) AS p95_fraud_prob
    FROM ({source}) GROUP BY window_start, window_end"""


def _value_above_100(width: str = "1 day") -> str:
    return f"SELECT *, CAST(value > 100 AS DOUBLE) AS is_fraud FROM ({_events(width)})"


def _cells(source: str) -> str:
    return f"""
    SELECT window_start, window_end,
           count(*) FILTER (is_fraud = 1 AND label = 1) AS tp,
           count(*) FILTER (is_fraud = 1 AND label = 0) AS fp,
           count(*) FILTER (is_fraud = 0 AND label = 1) AS fn,
           count(*) FILTER (is_fraud = 0 AND label = 0) AS tn
    FROM ({source}) GROUP BY window_start, window_end"""


def _performance(source: str) -> str:
    return f"""
    WITH cells AS ({_cells(source)}),
    ratios AS (
      SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS r,
             (tp + tn) / nullif(tp + tn + fp + fn, 0) AS a
      FROM cells
    )
    SELECT window_start, window_end, tp, fp, fn, tn, round(a, 6) AS accuracy,
           round(p, 6) AS precision, round(r, 6) AS recall,
           round(2 * p * r / nullif(p + r, 0), 6) AS f1_score
    FROM ratios"""


def _monitor() -> str:
    rows = _linear(_events())
    return f"""
    SELECT * FROM ({_data(rows)})
    JOIN ({_label(rows)}) USING (window_start, window_end)
    JOIN ({_prediction(rows)}) USING (window_start, window_end)
    JOIN ({_performance(rows)}) USING (window_start, window_end)"""


_DAMAGED = """
      SELECT window_start, window_end, event_type, label,
             CASE WHEN event_type <> 'signup' THEN value END AS value
      FROM ({events}) WHERE event_type NOT IN ('error', 'view')"""

_EVENT_COLUMNS = "event_id, ts, value"

_CUTS = ("median_amount", "p95_amount", "p99_amount", "median_fraud_prob", "p95_fraud_prob")


def _monitor_by_ranks() -> str:
    """The report without its percentiles; these lie within their error."""
    within = ", ".join(f"true AS {name}_within" for name in _CUTS)
    return f"SELECT * EXCLUDE ({', '.join(_CUTS)}), {within} FROM ({_monitor()})"


# Messages by the batch that brings them; a batch knows the latest readable time of those before it.
_ROUTED = """
      WITH sent AS (
        SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 5) AS BIGINT)
                  + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS batch_id,
               event_type IN ('error', 'view') AS dead
        FROM events
      ),
      latest AS (SELECT batch_id, max(ts) FILTER (NOT dead) AS latest FROM sent GROUP BY batch_id),
      closed AS (
        SELECT batch_id, max(latest) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                         - INTERVAL '10 minutes' AS closed
        FROM latest
      ),
      routed AS (
        SELECT event_id, batch_id,
               CASE WHEN dead THEN 'dead'
                    WHEN date_trunc('day', ts) + INTERVAL '1 day' <= closed THEN 'late' ELSE 'events' END AS route,
               CASE event_type WHEN 'error' THEN 'unreadable' WHEN 'view' THEN 'no time' END AS reason
        FROM sent JOIN closed USING (batch_id)
      )"""

ORACLES: dict[str, str] = {
    "parse_events": """
      SELECT event_id, ts, user_id, event_type, round(value, 9) AS value, props,
             CAST(event_type = 'error' AS INTEGER) AS label
      FROM events""",
    "message_validity": """
      SELECT event_type NOT IN ('error', 'view') AS is_valid, count(*) AS messages
      FROM events GROUP BY 1""",
    "valid_window_stats": f"""
      SELECT * FROM ({_stats(_DAMAGED.format(events=_events()))})
      JOIN (
        SELECT window_start, window_end, count(*) FILTER (event_type = 'signup') AS invalid_count
        FROM ({_events()}) WHERE event_type NOT IN ('error', 'view')
        GROUP BY window_start, window_end
      ) USING (window_start, window_end)""",
    "stamped_events": """
      SELECT event_type, count(*) AS events, count(*) AS with_time FROM events GROUP BY 1""",
    "csv_scan": """
      SELECT event_id, ts, user_id, event_type, round(value, 9) AS value, props FROM events""",
    "first_events": """
      SELECT event_id, ts, user_id, event_type, round(value, 9) AS value, props
      FROM events ORDER BY ts, event_id LIMIT 500""",
    "window_stats": _stats(_events()),
    "window_stats_short": _stats(_events("5 minutes")),
    "window_stats_by_key": _stats(_events(), keys="event_type,"),
    "window_stats_large": _stats(_lineitem()),
    "zscore_scored": _zscore(_events(), _EVENT_COLUMNS),
    "zscore_anomalies": _zscore(_events(), _EVENT_COLUMNS, where="z > 3.0"),
    "zscore_short": _zscore(_events("5 minutes"), _EVENT_COLUMNS),
    "zscore_by_key": _zscore(
        _events(), "event_id, user_id, value", group="window_start, user_id"
    ),
    "zscore_split_join": _zscore(
        _events(), "event_id, user_id, value", group="window_start, user_id"
    ),
    "zscore_large": _zscore(
        _lineitem(),
        "l_orderkey, l_linenumber, round(l_extendedprice, 6) AS l_extendedprice",
        threshold=1.5,
        where="z > 1.5",
    ),
    "iqr_bounds": f"""
      SELECT window_start, window_end, round(mean, 6) AS avg_amount,
             round(q1, 6) AS q1, round(q3, 6) AS q3,
             round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound
      FROM ({_bounds(_events(), 1.5)})""",
    "iqr_anomalies": _outside(
        _events(), _EVENT_COLUMNS, 1.5, flag=", true AS is_anomaly"
    ),
    "iqr_large": _outside(
        _lineitem(),
        "l_orderkey, l_linenumber, round(l_extendedprice, 6) AS l_extendedprice",
        0.4,
    ),
    "iqr_by_key": f"""
      WITH rows AS ({_events()}),
      bounds AS (
        SELECT window_start, event_type, quantile_disc(value, 0.25) AS q1,
               quantile_disc(value, 0.75) AS q3, q1 - 1.5 * (q3 - q1) AS lower_bound,
               q3 + 1.5 * (q3 - q1) AS upper_bound
        FROM rows GROUP BY window_start, event_type
      )
      SELECT event_id, window_start, round(q1, 6) AS q1, round(q3, 6) AS q3,
             round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound,
             value < lower_bound OR value > upper_bound AS is_anomaly
      FROM rows JOIN bounds USING (window_start, event_type)""",
    "zscore_and_iqr": f"""
      WITH rows AS ({_events()}), bounds AS ({_bounds(_events(), 1.5)}),
      measured AS (
        SELECT *, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd
        FROM rows WINDOW w AS (PARTITION BY window_start)
      ),
      judged AS (
        SELECT *, CASE WHEN sd > 0 THEN abs((value - m) / sd) ELSE 0 END AS z FROM measured
      )
      SELECT event_id, judged.window_start, round(z, 6) AS z_score, z > 3.0 AS is_far,
             round(q1, 6) AS q1, round(q3, 6) AS q3,
             round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound,
             value < lower_bound OR value > upper_bound AS is_anomaly
      FROM judged JOIN bounds USING (window_start)""",
    "isolation_scores": """
      SELECT count(*) AS scored_rows, true AS within_share, CAST(20 AS BIGINT) AS largest_flagged
      FROM events""",
    "isolation_fixed_scores": """
      WITH paths AS (
        SELECT event_id, value,
               CASE WHEN value <= 50 THEN 3.0 WHEN user_id <= 90 THEN 2.5 ELSE 2.0 END
               + CASE WHEN user_id <= 20 THEN 1.0 ELSE 4.0 END AS path
        FROM events
      )
      SELECT event_id, round(value, 6) AS value,
             round(score, 6) AS anomaly_score, score > 0.55 AS is_anomaly
      FROM (
        SELECT *, pow(2, -path / (2 * (2 * (ln(7) + 0.5772156649015329) - 14 / 8.0))) AS score
        FROM paths
      )""",
    "forest_scores": """
      SELECT event_id, ts, CAST(k > 49 AS INTEGER) AS target, CAST(k > 49 AS DOUBLE) AS is_fraud,
             CAST(k > 49 AS DOUBLE) AS fraud_probability
      FROM (SELECT *, CAST(regexp_extract(props, '"k": *([-0-9.]+)', 1) AS DOUBLE) AS k FROM events)""",
    "job_scores": """
      WITH fields AS (
        SELECT *, CAST(event_type = 'error' AS INTEGER) AS label,
               CAST(regexp_extract(props, '"k": *([-0-9.]+)', 1) AS DOUBLE) AS k
        FROM events
      ),
      scores AS (
        SELECT *, 1 / (1 + exp(-(-3 + 0.01 * value + 0.001 * user_id
                 + 0.002 * (40.6 * value + 28 * k)))) AS p
        FROM fields
      )
      SELECT event_id, round(value, 6) AS value, label, CAST(p > 0.5 AS DOUBLE) AS is_fraud,
             round(p, 6) AS fraud_probability
      FROM scores""",
    "linear_scores": f"""
      SELECT event_id, ts, value, label, is_fraud, round(p, 6) AS fraud_probability
      FROM ({_linear(_events())})""",
    "data_drift": _data(_events()),
    "data_drift_large": _data(_lineitem()),
    "label_drift": _label(_events()),
    "data_drift_alerts": f"""
      SELECT window_start, window_end, round(stddev_samp(value), 6) AS stddev_amount,
             stddev_samp(value) > 50 AS has_data_drift
      FROM ({_events()}) GROUP BY window_start, window_end""",
    "label_drift_alerts": f"""
      SELECT window_start, window_end, round(avg(label) * 100, 6) AS fraud_rate_percent,
             abs(avg(label) * 100 - 20) > 2 AS has_label_drift
      FROM ({_events()}) GROUP BY window_start, window_end""",
    "baseline_drift_alerts": f"""
      WITH base AS (SELECT avg(value) AS b FROM events WHERE ts < TIMESTAMP '2024-01-08'),
      means AS (
        SELECT window_start, window_end, avg(value) AS m
        FROM ({_events()}) GROUP BY window_start, window_end
      )
      SELECT window_start, window_end, round(m, 6) AS avg_amount,
             round(b, 6) AS baseline_avg, round(abs(m - b) / b, 6) AS relative_change,
             abs(m - b) / b > 0.05 AS has_data_drift
      FROM means, base""",
    "baseline_drift_by_key": f"""
      WITH base AS (
        SELECT event_type, avg(value) AS b FROM events
        WHERE ts < TIMESTAMP '2024-01-08' GROUP BY event_type
      ),
      means AS (
        SELECT window_start, window_end, event_type, avg(value) AS m
        FROM ({_events()}) GROUP BY window_start, window_end, event_type
      )
      SELECT window_start, window_end, event_type,
             round(abs(m - b) / b, 6) AS relative_change, abs(m - b) / b > 0.1 AS has_data_drift
      FROM means LEFT JOIN base USING (event_type)""",
    "prediction_drift": _prediction(_linear(_events())),
    "confusion_by_window": _cells(_value_above_100()),
    "performance_by_window": _performance(_value_above_100()),
    "performance_short": _performance(_value_above_100("10 minutes")),
    "monitor_all": _monitor(),
    "stream_window_stats": _stats(_events(), where=CLOSED),
    "stream_zscore": _zscore(_events(), _EVENT_COLUMNS, where=CLOSED),
    "stream_iqr": _outside(
        _events(), _EVENT_COLUMNS, 1.5, flag=", true AS is_anomaly", where=f"rows.{CLOSED}"
    ),
    "stream_scores": f"""
      SELECT event_id, ts, value, label, is_fraud, round(p, 6) AS fraud_probability
      FROM ({_linear(_events())})""",
    "stream_monitor": _monitor(),
    "stream_zscore_batches": _zscore(_events(), _EVENT_COLUMNS, where=CLOSED),
    "stream_monitor_batches": _monitor_by_ranks(),
    "stream_previous_window": f"""
      WITH days AS (
        SELECT window_start, avg(value) AS m, stddev_samp(value) AS sd FROM ({_events()}) GROUP BY window_start
      ),
      judged AS (
        SELECT event_id, value, m, sd,
               CASE WHEN m IS NULL THEN NULL WHEN sd > 0 THEN abs((value - m) / sd) ELSE 0 END AS z
        FROM ({_events()}) AS e LEFT JOIN days ON e.window_start = days.window_start + INTERVAL '1 day'
      )
      SELECT event_id, round(value, 6) AS value, round(m, 6) AS previous_avg,
             round(sd, 6) AS previous_stddev, round(z, 6) AS z_score, z > 3.0 AS is_anomaly
      FROM judged""",
    "ingest_routes": f"""
      {_ROUTED}
      SELECT event_id, route, reason, batch_id FROM routed""",
    "ingest_batch_counts": f"""
      {_ROUTED}
      SELECT batch_id, count(*) AS messages, count(*) FILTER (route = 'events') AS events,
             count(*) FILTER (route = 'late') AS late, count(*) FILTER (route = 'dead') AS dead
      FROM routed GROUP BY batch_id""",
    "job_scores_or_dead_letters": """
      SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 'dead letter' ELSE 'score' END AS outcome,
             CASE WHEN event_type NOT IN ('error', 'view')
                  THEN round(1 / (1 + exp(-(-2 + 0.01 * value))), 6) END AS fraud_probability
      FROM events""",
    "csv_inferred": """
      SELECT event_id, ts, user_id, event_type, round(value, 9) AS value, props,
             'event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string' AS types,
             (SELECT count(*) FROM events WHERE event_id % 50 IN (1, 2)) AS damaged
      FROM events WHERE event_id % 50 NOT IN (1, 2)""",
    "job_anomalies": _zscore(_events(), "event_id, ts, value", where=f"z > 3.0 AND {CLOSED}"),
    "job_drift": f"""
      SELECT window_start, window_end, count(*) AS transaction_count,
             round(avg(value), 6) AS avg_amount, round(stddev_samp(value), 6) AS stddev_amount,
             stddev_samp(value) > 50 AS has_data_drift,
             CAST(sum(label) AS BIGINT) AS fraud_count,
             round(avg(label) * 100, 6) AS fraud_rate_percent,
             abs(avg(label) * 100 - 20) > 2 AS has_label_drift
      FROM ({_events()}) GROUP BY window_start, window_end""",
}
