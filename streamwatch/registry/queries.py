"""The operators as named queries over the test tables.

Roles on ``events``: key ``event_id``, time ``ts``, amount ``value``, label
``event_type = 'error'``. On ``lineitem``: time ``l_shipdate``, amount
``l_extendedprice``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamwatch.functions.messages import (
    TIME_FORMAT,
    decode_events,
    encode_events,
    first_events,
    split_events,
    stamp_missing_time,
    with_validity,
)
from streamwatch.functions.sketches import ACCURACY
from streamwatch.functions.values import event_time, utc_clock
from streamwatch.operators.anomaly import (
    flagged_only,
    iqr_anomalies,
    iqr_bounds,
    zscore_anomalies,
)
from streamwatch.operators.drift import (
    baseline_drift_alerts,
    data_drift,
    data_drift_alerts,
    label_drift,
    label_drift_alerts,
    monitoring_report,
    performance,
    prediction_drift,
)
from streamwatch.operators.isolation_forest import IsolationForestModel, fit_isolation_forest
from streamwatch.operators.scoring import load_model, save_model, score_events, train_classifier
from streamwatch.operators.window_stats import amount_statistics
from streamwatch.schema import FEATURE_COLUMNS
from streamwatch.session import fresh_folder
from streamwatch.sources.files import SLICE, publish_slices, read_csv, read_csv_inferred, sliced_by_time, stream_files
from streamwatch.streaming.ingest import ROUTES, ingest_counts, ingest_job, read_route, stream_route
from streamwatch.streaming.jobs import anomaly_job, drift_job, scoring_job
from streamwatch.streaming.previous_window import previous_window_job, read_judged
from streamwatch.streaming.sinks import await_queries, read_report, to_files, to_reports
from streamwatch.streaming.whole_windows import closed_windows_job, window_reports_job

EVENT = {"ts_col": "ts", "value_col": "value"}
LINE = {"ts_col": "l_shipdate", "value_col": "l_extendedprice"}
DAY = "1 day"
MONTH = "30 days"
DELAY = "10 minutes"
# percentiles of tables and whole windows are exact; a stream's state has the usual accuracy
EXACT = None

EVENT_WIRE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
        T.StructField("label", T.IntegerType()),
    ]
)


# --- inputs -------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # stored times have no zone; the operators read them as UTC
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(table(spark, sf_dir, "events"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = (F.col("l_returnflag") == "R").cast("int")
    return table(spark, sf_dir, "lineitem").withColumn("label", label)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one batch, since the files of a table are in no order of time; :func:`in_two_runs` has many batches."""
    schema = table(spark, sf_dir, "events").schema
    # as a pattern, the path may be a single file or a folder of files
    return _labelled(stream_files(spark, f"{sf_dir}/events.parque[t]", schema))


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("label", (F.col("event_type") == "error").cast("int"))


def linear_model() -> PipelineModel:
    """A pipeline with fixed coefficients, whose scores SQL can repeat."""
    logit = "SELECT *, -2 + 0.01 * value + 0.01 * k AS logit FROM __THIS__"
    probability = "SELECT *, 1 / (1 + exp(-logit)) AS probability FROM __THIS__"
    prediction = "SELECT *, CAST(probability > 0.5 AS DOUBLE) AS prediction FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=s) for s in (logit, probability, prediction)])


def scored(df: DataFrame) -> DataFrame:
    with_k = df.withColumn("k", F.from_json("props", "k double").getField("k"))
    return score_events(with_k, linear_model(), ["value", "k"]).drop("logit")


# --- shape of the results -----------------------------------------------------


def shown(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Chosen columns; doubles rounded, times without a zone as stored."""

    def plain(name: str):
        kind = df.schema[name].dataType
        if isinstance(kind, T.DoubleType):
            return F.round(name, digits).alias(name)
        if isinstance(kind, T.TimestampType):
            return utc_clock(F.col(name)).alias(name)
        return F.col(name)

    return df.select(*map(plain, columns or df.columns))


STATS = ("avg_amount", "stddev_amount", "min_amount", "max_amount", "avg_fraud_rate")
WINDOW = ("window_start", "window_end")
ZSCORE = ("avg_amount", "stddev_amount", "z_score", "is_anomaly")
BOUNDS = ("q1", "q3", "lower_bound", "upper_bound")


# --- events and messages ------------------------------------------------------


def parse_events(spark, sf_dir):
    raw = encode_events(events(spark, sf_dir))
    decoded = decode_events(raw, EVENT_WIRE, label_col="label")
    return shown(decoded.withColumn("ts", event_time(decoded, "ts")), digits=9)


def _damaged_messages(spark, sf_dir):
    """Errors lose the end of their text, sign-ups carry NaN, views lose their time."""
    source = events(spark, sf_dir)
    is_type = F.col("event_type")
    source = source.withColumns(
        {
            "ts": F.when(is_type != "view", F.col("ts")),
            "value": F.when(is_type == "signup", F.lit(float("nan"))).otherwise(F.col("value")),
        }
    )
    raw = encode_events(source)
    cut = F.left("value", F.length("value") - 1)
    is_error = F.col("value").contains('"event_type":"error"')
    # a sender may write NaN bare, which is not strict JSON
    bare = F.replace("value", F.lit('"NaN"'), F.lit("NaN"))
    return raw.select(F.when(is_error, cut).otherwise(bare).alias("value"))


def _decoded_damaged(spark, sf_dir):
    return decode_events(
        _damaged_messages(spark, sf_dir), EVENT_WIRE, label_col="label", keep_corrupt=True
    )


def message_validity(spark, sf_dir):
    marked = with_validity(_decoded_damaged(spark, sf_dir), "ts")
    return marked.groupBy("is_valid").agg(F.count("*").alias("messages"))


def valid_window_stats(spark, sf_dir):
    valid, _ = split_events(_decoded_damaged(spark, sf_dir), "ts")
    stats = amount_statistics(valid, **EVENT, label_col="label", window=DAY)
    return shown(stats, *WINDOW, *STATS, "invalid_count")


def stamped_events(spark, sf_dir):
    """Sign-ups lose their time; each gets the current one, which is never null."""
    source = events(spark, sf_dir)
    lost = source.withColumn("ts", F.when(F.col("event_type") != "signup", F.col("ts")))
    stamped = stamp_missing_time(lost, "ts")
    return stamped.groupBy("event_type").agg(
        F.count("*").alias("events"), F.count("ts").alias("with_time")
    )


def csv_scan(spark, sf_dir):
    """The events written as CSV text and read back with a declared schema."""
    source = events(spark, sf_dir).drop("label")
    path = fresh_folder(spark, "csv")
    source.write.option("timestampNTZFormat", TIME_FORMAT).csv(path, header=True)
    return shown(read_csv(spark, path, source.schema), digits=9)


def first_events_query(spark, sf_dir):
    return shown(first_events(events(spark, sf_dir).drop("label"), 500, ["ts", "event_id"]), digits=9)


# --- windows ------------------------------------------------------------------


def window_stats(spark, sf_dir):
    stats = amount_statistics(events(spark, sf_dir), **EVENT, label_col="label", window=DAY)
    return shown(stats, *WINDOW, *STATS)


def window_stats_short(spark, sf_dir):
    """The default width, where most windows hold one event."""
    stats = amount_statistics(events(spark, sf_dir), **EVENT, label_col="label")
    return shown(stats, *WINDOW, *STATS)


def window_stats_by_key(spark, sf_dir):
    stats = amount_statistics(
        events(spark, sf_dir), **EVENT, label_col="label", window=DAY, keys=["event_type"]
    )
    return shown(stats, *WINDOW, "event_type", *STATS)


def window_stats_large(spark, sf_dir):
    stats = amount_statistics(lineitem(spark, sf_dir), **LINE, label_col="label", window=MONTH)
    return shown(stats, *WINDOW, *STATS)


# --- anomalies ----------------------------------------------------------------


def _zscores(spark, sf_dir, **options):
    judged = zscore_anomalies(events(spark, sf_dir), **EVENT, window=DAY, **options)
    return shown(judged, "event_id", "ts", "value", "window_start", *ZSCORE)


def zscore_scored(spark, sf_dir):
    return _zscores(spark, sf_dir)


def zscore_anomalies_query(spark, sf_dir):
    return flagged_only(_zscores(spark, sf_dir))


def zscore_short(spark, sf_dir):
    """The default width: single events score 0."""
    judged = zscore_anomalies(events(spark, sf_dir), **EVENT)
    return shown(judged, "event_id", "ts", "value", "window_start", *ZSCORE)


def zscore_by_key(spark, sf_dir):
    judged = zscore_anomalies(events(spark, sf_dir), **EVENT, window=DAY, keys=["user_id"])
    return shown(judged, "event_id", "user_id", "value", "window_start", *ZSCORE)


def zscore_split_join(spark, sf_dir):
    """As ``zscore_by_key``, joined as if the statistics were too large to broadcast."""
    judged = zscore_anomalies(
        events(spark, sf_dir), **EVENT, window=DAY, keys=["user_id"], broadcast_bytes=0
    )
    return shown(judged, "event_id", "user_id", "value", "window_start", *ZSCORE)


def zscore_large(spark, sf_dir):
    judged = zscore_anomalies(lineitem(spark, sf_dir), **LINE, window=MONTH, threshold=1.5)
    columns = ("l_orderkey", "l_linenumber", "l_extendedprice", "window_start", *ZSCORE)
    return shown(flagged_only(judged), *columns)


def iqr_bounds_query(spark, sf_dir):
    bounds = iqr_bounds(events(spark, sf_dir), **EVENT, window=DAY, accuracy=EXACT)
    return shown(bounds, *WINDOW, "avg_amount", *BOUNDS)


def iqr_anomalies_query(spark, sf_dir):
    judged = iqr_anomalies(events(spark, sf_dir), **EVENT, window=DAY, accuracy=EXACT)
    columns = ("event_id", "ts", "value", "window_start", *BOUNDS, "is_anomaly")
    return shown(flagged_only(judged), *columns)


def iqr_large(spark, sf_dir):
    judged = iqr_anomalies(
        lineitem(spark, sf_dir), **LINE, window=MONTH, multiplier=0.4, accuracy=EXACT
    )
    columns = ("l_orderkey", "l_linenumber", "l_extendedprice", "window_start", *BOUNDS)
    return shown(flagged_only(judged), *columns)


def isolation_scores(spark, sf_dir):
    """A fitted forest by what holds for any: all rows have a score, no more than the asked share is flagged,
    and the 20 largest amounts are."""
    source = events(spark, sf_dir)
    judged = fit_isolation_forest(source, ["value"], draw_by=["event_id"]).transform(source)
    largest = judged.orderBy(F.desc("value"), "event_id").limit(20)
    return judged.agg(
        F.count("anomaly_score").alias("scored_rows"),
        (F.count_if("is_anomaly") <= 0.05 * F.count("*")).alias("within_share"),
    ).withColumn("largest_flagged", largest.agg(F.count_if("is_anomaly").alias("n")).scalar())


def fixed_forest() -> IsolationForestModel:
    """Two trees with known nodes, so that SQL can walk them."""
    nodes = [
        (0, 0, 0, 50.0, 1, 0.0, 8), (0, 1, -1, 0.0, -1, 3.0, 8), (0, 2, 1, 90.0, 3, 0.0, 8), (0, 3, -1, 0.0, -1, 2.5, 8), (0, 4, -1, 0.0, -1, 2.0, 8),
        (1, 0, 1, 20.0, 1, 0.0, 8), (1, 1, -1, 0.0, -1, 1.0, 8), (1, 2, -1, 0.0, -1, 4.0, 8),
    ]
    columns = ["tree", "node", "feature", "split", "child", "path", "sample"]
    return IsolationForestModel(("value", "user_id"), pd.DataFrame(nodes, columns=columns), 0.55)


def isolation_fixed_scores(spark, sf_dir):
    judged = fixed_forest().transform(events(spark, sf_dir))
    return shown(judged, "event_id", "value", "anomaly_score", "is_anomaly")


def zscore_and_iqr(spark, sf_dir):
    """One method after the other on the same rows."""
    scores = zscore_anomalies(events(spark, sf_dir), **EVENT, window=DAY).withColumnRenamed("is_anomaly", "is_far")
    judged = iqr_anomalies(scores, **EVENT, window=DAY, accuracy=EXACT)
    return shown(judged, "event_id", "window_start", "z_score", "is_far", *BOUNDS, "is_anomaly")


def iqr_by_key(spark, sf_dir):
    judged = iqr_anomalies(events(spark, sf_dir), **EVENT, window=DAY, keys=["event_type"], accuracy=EXACT)
    return shown(judged, "event_id", "window_start", *BOUNDS, "is_anomaly")


# --- models -------------------------------------------------------------------


def linear_scores(spark, sf_dir):
    result = scored(events(spark, sf_dir))
    return shown(result, "event_id", "ts", "value", "label", "is_fraud", "fraud_probability")


def forest_scores(spark, sf_dir):
    """A forest trained, saved and loaded again. The class follows from a field of few values, so a right forest has no
    doubt about any event."""
    source = events(spark, sf_dir).withColumn("k", F.from_json("props", "k double").getField("k"))
    source = source.withColumn("target", (F.col("k") > 49).cast("int"))
    features = ["value", "k", "user_id"]
    settings = {"maxBins": 128, "featureSubsetStrategy": "all"}
    path = fresh_folder(spark, "model")
    save_model(train_classifier(source, features, "target", trees=10, depth=4, spread_by=["event_id"], **settings), path)
    result = score_events(source, load_model(path), features)
    return shown(result, "event_id", "ts", "target", "is_fraud", "fraud_probability")


# --- drift --------------------------------------------------------------------


def data_drift_query(spark, sf_dir):
    report = data_drift(events(spark, sf_dir), **EVENT, window=DAY, accuracy=EXACT)
    return shown(report.drop("invalid_count"))


def data_drift_large(spark, sf_dir):
    report = data_drift(lineitem(spark, sf_dir), **LINE, window=MONTH, accuracy=EXACT)
    return shown(report.drop("invalid_count"))


def label_drift_query(spark, sf_dir):
    return shown(label_drift(events(spark, sf_dir), ts_col="ts", label_col="label", window=DAY))


def data_drift_alerts_query(spark, sf_dir):
    report = data_drift(events(spark, sf_dir), **EVENT, window=DAY)
    alerts = data_drift_alerts(report, threshold=50)
    return shown(alerts, *WINDOW, "stddev_amount", "has_data_drift")


def label_drift_alerts_query(spark, sf_dir):
    report = label_drift(events(spark, sf_dir), ts_col="ts", label_col="label", window=DAY)
    alerts = label_drift_alerts(report, threshold=0.02, baseline_rate_percent=20)
    return shown(alerts, *WINDOW, "fraud_rate_percent", "has_label_drift")


BASELINE_END = "2024-01-08"


def baseline_drift_alerts_query(spark, sf_dir):
    source = events(spark, sf_dir)
    before = source.filter(F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz"))
    baseline = before.agg(F.avg("value").alias("baseline_avg"))
    report = data_drift(source, **EVENT, window=DAY)
    alerts = baseline_drift_alerts(report, baseline, threshold=0.05)
    return shown(
        alerts, *WINDOW, "avg_amount", "baseline_avg", "relative_change", "has_data_drift"
    )


def baseline_drift_by_key(spark, sf_dir):
    source = events(spark, sf_dir)
    before = source.filter(F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz"))
    baseline = before.groupBy("event_type").agg(F.avg("value").alias("baseline_avg"))
    report = data_drift(source, **EVENT, window=DAY, keys=["event_type"])
    alerts = baseline_drift_alerts(report, baseline, keys=["event_type"])
    return shown(alerts, *WINDOW, "event_type", "relative_change", "has_data_drift")


def prediction_drift_query(spark, sf_dir):
    report = prediction_drift(
        scored(events(spark, sf_dir)), ts_col="ts", window=DAY, accuracy=EXACT
    )
    return shown(report)


def _judged(df: DataFrame) -> DataFrame:
    return df.withColumn("is_fraud", (F.col("value") > 100).cast("double"))


def confusion_by_window(spark, sf_dir):
    report = performance(_judged(events(spark, sf_dir)), ts_col="ts", label_col="label", window=DAY)
    return shown(report, *WINDOW, "tp", "fp", "fn", "tn")


def performance_by_window(spark, sf_dir):
    report = performance(_judged(events(spark, sf_dir)), ts_col="ts", label_col="label", window=DAY)
    return shown(report)


def performance_short(spark, sf_dir):
    """The default width, where most ratios are over zero."""
    report = performance(_judged(events(spark, sf_dir)), ts_col="ts", label_col="label")
    return shown(report)


REPORT = {
    **EVENT,
    "label_col": "label",
    "probability_col": "fraud_probability",
    "prediction_col": "is_fraud",
    "window": DAY,
    "accuracy": EXACT,
}


def monitor_all(spark, sf_dir):
    report = monitoring_report(scored(events(spark, sf_dir)), **REPORT)
    return shown(report.drop("invalid_count"))


# --- streams ------------------------------------------------------------------


def _drained(spark: SparkSession, stream: DataFrame, purpose: str) -> DataFrame:
    """Run an append stream over what is there and read its file sink."""
    folder = fresh_folder(spark, purpose)
    query = to_files(stream, f"{folder}/out", f"{folder}/state", drain=True)
    await_queries([query])
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def stream_window_stats(spark, sf_dir):
    stats = amount_statistics(
        event_stream(spark, sf_dir), **EVENT, label_col="label", window=DAY, delay=DELAY
    )
    return shown(_drained(spark, stats, "window-stats"), *WINDOW, *STATS)


def stream_zscore(spark, sf_dir):
    judged = zscore_anomalies(event_stream(spark, sf_dir), **EVENT, window=DAY, delay=DELAY)
    return shown(
        _drained(spark, judged, "zscore"), "event_id", "ts", "value", "window_start", *ZSCORE
    )


def stream_iqr(spark, sf_dir):
    """The anomalies of closed windows, by exact quartiles of all events of their window."""
    folder = fresh_folder(spark, "iqr")

    def judge(rows: DataFrame) -> DataFrame:
        return flagged_only(iqr_anomalies(rows, **EVENT, window=DAY, accuracy=EXACT))

    where = {"ts_col": "ts", "window": DAY, "delay": DELAY, "drain": True}
    await_queries([closed_windows_job(event_stream(spark, sf_dir), judge, f"{folder}/out", f"{folder}/state", **where)])
    columns = ("event_id", "ts", "value", "window_start", *BOUNDS, "is_anomaly")
    return shown(read_judged(spark, f"{folder}/out"), *columns)


def _near_rank(value, found, q: float):
    """Whether a percentile lies within its error among all values, as an aggregate."""
    error = 1.5 / ACCURACY
    return (F.avg((value < found).cast("int")) <= q + error) & (F.avg((value <= found).cast("int")) >= q - error)


def stream_scores(spark, sf_dir):
    result = scored(event_stream(spark, sf_dir)).drop("props")
    return shown(
        _drained(spark, result, "scores"),
        "event_id", "ts", "value", "label", "is_fraud", "fraud_probability",
    )


def _reported(spark, folder):
    """The newest state of all windows, the parts side by side."""
    parts = [read_report(spark, f"{folder}/out", name) for name in ("data", "label", "prediction", "performance")]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.join(part, list(WINDOW))
    return joined.drop("invalid_count")


def _monitored(spark, sf_dir, folder):
    """The newest state of all windows, percentiles by their ranks among the events of the table."""
    joined = _reported(spark, folder)
    cuts = {"median_amount": ("value", 0.5), "p95_amount": ("value", 0.95), "p99_amount": ("value", 0.99), "median_fraud_prob": ("fraud_probability", 0.5), "p95_fraud_prob": ("fraud_probability", 0.95)}
    source = scored(events(spark, sf_dir))
    source = source.select(F.window(event_time(source, "ts"), DAY)["start"].alias("window_start"), "value", "fraud_probability")
    ranked = source.join(joined.select("window_start", *cuts), "window_start").groupBy("window_start")
    ranked = ranked.agg(*(_near_rank(F.col(column), F.col(name), q).alias(f"{name}_within") for name, (column, q) in cuts.items()))
    return shown(joined.drop(*cuts).join(ranked, "window_start"))


def stream_monitor(spark, sf_dir):
    """The update-mode report: the newest state of every window, open ones too, with exact percentiles."""
    folder = fresh_folder(spark, "monitor")

    def report(rows: DataFrame) -> DataFrame:
        return monitoring_report(rows, **REPORT)

    where = {"ts_col": "ts", "window": DAY, "delay": DELAY, "drain": True}
    await_queries([window_reports_job(scored(event_stream(spark, sf_dir)), report, f"{folder}/out", f"{folder}/state", **where)])
    return shown(_reported(spark, folder))


SLICES = 6


def in_two_runs(spark: SparkSession, source: DataFrame, start: Callable[[DataFrame], object], numbers: range = range(SLICES)) -> None:
    """Feed a table's slices to a stream, a slice a batch: half of them, then the query is stopped and started again with another number of
    shuffle partitions for the other half. ``start`` takes the stream and starts the query on it."""
    folder, kind = fresh_folder(spark, "slices"), "spark.sql.shuffle.partitions"
    source.write.parquet(f"{folder}/staged")
    staged = spark.read.parquet(f"{folder}/staged")
    before = spark.conf.get(kind)
    half = len(numbers) // 2
    try:
        for run, own in enumerate((numbers[:half], numbers[half:])):
            publish_slices(staged, f"{folder}/in", own)
            spark.conf.set(kind, str(int(before) + 3 * run))
            stream = stream_files(spark, f"{folder}/in", staged.drop(SLICE).schema, max_files=1)
            await_queries([start(stream)])
    finally:
        spark.conf.set(kind, before)


def stream_zscore_batches(spark, sf_dir):
    """As ``stream_zscore``, over six batches in the order of time, with a restart on other partitions."""
    folder = fresh_folder(spark, "zscore-batches")

    def start(stream: DataFrame):
        judged = zscore_anomalies(_labelled(stream), **EVENT, window=DAY, delay=DELAY)
        return to_files(judged, f"{folder}/out", f"{folder}/state", drain=True)

    in_two_runs(spark, sliced_by_time(table(spark, sf_dir, "events"), "ts", SLICES), start)
    return shown(spark.read.parquet(f"{folder}/out"), "event_id", "ts", "value", "window_start", *ZSCORE)


def stream_monitor_batches(spark, sf_dir):
    """As ``stream_monitor`` from one state, over six batches in the order of time, with a restart on other partitions and a merge of the report's folders."""
    folder = fresh_folder(spark, "monitor-batches")

    def start(stream: DataFrame):
        report = monitoring_report(scored(_labelled(stream)), **(REPORT | {"accuracy": ACCURACY}), delay=DELAY)
        return to_reports(report, f"{folder}/out", f"{folder}/state", compact_every=4, drain=True)

    in_two_runs(spark, sliced_by_time(table(spark, sf_dir, "events"), "ts", SLICES), start)
    return _monitored(spark, sf_dir, folder)


def stream_previous_window(spark, sf_dir):
    """Every event against the day before its own, in the batch that brings it."""
    folder = fresh_folder(spark, "previous-window")

    def start(stream: DataFrame):
        return previous_window_job(stream, f"{folder}/out", f"{folder}/state", **EVENT, window=DAY, merge_every=4, drain=True)

    in_two_runs(spark, sliced_by_time(table(spark, sf_dir, "events"), "ts", SLICES), start)
    judged = read_judged(spark, f"{folder}/out")
    return shown(judged, "event_id", "value", "previous_avg", "previous_stddev", "z_score", "is_anomaly")


# --- whole jobs ---------------------------------------------------------------


def _whole_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of the transaction schema, the features derived from each event; the key is ``event_id``."""
    source = events(spark, sf_dir).withColumn("k", F.from_json("props", "k double").getField("k"))
    fields = [(F.col("value") * 0.1 * i + F.col("k")).alias(f"V{i}") for i in range(1, 29)]
    source = source.select(
        "event_id",
        F.col("user_id").cast("double").alias("Time"),
        *fields,
        F.col("value").alias("Amount"),
        F.col("label").cast("double").alias("Class"),
        F.col("ts").alias("timestamp"),
    )
    folder = fresh_folder(spark, "messages")
    encode_events(source, key_col="event_id").write.json(folder)
    return stream_files(spark, folder, KEYED_WIRE, fmt="json")


KEYED_WIRE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def job_scores(spark, sf_dir):
    """Messages with every field, decoded and scored on 30 features, into files."""
    logit = "SELECT *, -3 + 0.01 * Amount + 0.001 * Time + 0.002 * (" + " + ".join(f"V{i}" for i in range(1, 29)) + ") AS logit FROM __THIS__"
    probability = "SELECT *, 1 / (1 + exp(-logit)) AS probability FROM __THIS__"
    prediction = "SELECT *, CAST(probability > 0.5 AS DOUBLE) AS prediction FROM __THIS__"
    model = PipelineModel([SQLTransformer(statement=s) for s in (logit, probability, prediction)])
    folder = fresh_folder(spark, "job-scores")
    where = {"path": f"{folder}/out", "checkpoint": f"{folder}/state", "drain": True}
    await_queries([scoring_job(_whole_messages(spark, sf_dir), model, keep=["key"], **where)])
    found = spark.read.parquet(f"{folder}/out")
    found = found.select(F.col("key").cast("long").alias("event_id"), "Amount", "Class", "is_fraud", "fraud_probability")
    return shown(found.withColumnsRenamed({"Amount": "value", "Class": "label"}))


def job_anomalies(spark, sf_dir):
    folder = fresh_folder(spark, "job-anomalies")
    messages = _whole_messages(spark, sf_dir)
    where = {"path": f"{folder}/out", "checkpoint": f"{folder}/state", "drain": True}
    await_queries([anomaly_job(messages, window=DAY, keep=["key"], **where)])
    found = spark.read.parquet(f"{folder}/out")
    found = found.withColumns({"ts": event_time(found, "timestamp"), "event_id": F.col("key").cast("long")})
    return shown(found.withColumnRenamed("Amount", "value"), "event_id", "ts", "value", "window_start", *ZSCORE)


def job_drift(spark, sf_dir):
    folder = fresh_folder(spark, "job-drift")
    messages = _whole_messages(spark, sf_dir)
    where = {"path": f"{folder}/out", "checkpoint": f"{folder}/state", "drain": True}
    await_queries(
        [drift_job(messages, window=DAY, data_threshold=50, baseline_rate_percent=20, **where)]
    )
    data, label = (read_report(spark, f"{folder}/out", name) for name in ("data", "label"))
    return shown(
        data.join(label, list(WINDOW)),
        *WINDOW, "transaction_count", "avg_amount", "stddev_amount", "has_data_drift",
        "fraud_count", "fraud_rate_percent", "has_label_drift",
    )


def _sent_again(spark, sf_dir):
    """The events as keyed messages, in slices: an event a slice of five days, every seventh of them two slices later than its time. Errors lose the end
    of their text and views their time, as in ``_damaged_messages``."""
    source = events(spark, sf_dir)
    lag = F.when(F.col("event_id") % 7 == 0, 2).otherwise(0)
    day = F.floor(F.unix_micros(event_time(source, "ts")) / 86_400_000_000) - F.lit(19_723)  # days since 2024-01-01
    slices = (F.floor(day / 5) + lag).cast("int")
    fields = F.struct(F.when(F.col("event_type") != "view", F.col("ts")).alias("timestamp"), F.col("value").alias("Amount"), F.col("label").cast("double").alias("Class"))
    text = F.to_json(fields, {"timestampNTZFormat": TIME_FORMAT})
    value = F.when(F.col("event_type") == "error", F.left(text, F.length(text) - 1)).otherwise(text)
    return source.select(slices.alias(SLICE), F.col("event_id").cast("string").alias("key"), value.alias("value"))


def _ingested(spark, sf_dir) -> str:
    folder = fresh_folder(spark, "ingest")

    def start(stream: DataFrame):
        return ingest_job(stream, f"{folder}/out", f"{folder}/state", window=DAY, delay=DELAY, keep=["key"], drain=True)

    source = _sent_again(spark, sf_dir)
    in_two_runs(spark, source, start, range(8))
    return folder


def ingest_routes(spark, sf_dir):
    """Every message on its route: events in time, late ones, and dead letters with the reason."""
    folder = _ingested(spark, sf_dir)
    parts = []
    for route in ROUTES:
        rows = read_route(spark, f"{folder}/out", route)
        reason = F.col("reason") if route == "dead" else F.lit(None).cast("string")
        parts.append(rows.select(F.col("key").cast("long").alias("event_id"), F.lit(route).alias("route"), reason.alias("reason"), "batch_id"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ingest_batch_counts(spark, sf_dir):
    """What each batch reported of itself, in the pass that wrote it."""
    return ingest_counts(spark, f"{_ingested(spark, sf_dir)}/out")


def job_scores_or_dead_letters(spark, sf_dir):
    """The scoring job behind the ingest job: a score or a dead letter for every message."""
    folder = _ingested(spark, sf_dir)
    logit = "SELECT *, -2 + 0.01 * Amount AS logit FROM __THIS__"
    probability = "SELECT *, 1 / (1 + exp(-logit)) AS probability FROM __THIS__"
    prediction = "SELECT *, CAST(probability > 0.5 AS DOUBLE) AS prediction FROM __THIS__"
    model = PipelineModel([SQLTransformer(statement=s) for s in (logit, probability, prediction)])
    none = F.lit(0.0)
    for route in ("events", "late"):
        stream = stream_route(spark, f"{folder}/out", route)
        # the messages hold three of the fields
        stream = stream.withColumns({name: F.coalesce(name, none) for name in FEATURE_COLUMNS if name != "Amount"})
        where = {"path": f"{folder}/scores-{route}", "checkpoint": f"{folder}/scoring-{route}", "drain": True}
        await_queries([scoring_job(stream, model, keep=["key"], **where)])
    scores = spark.read.parquet(f"{folder}/scores-events", f"{folder}/scores-late").select("key", F.lit("score").alias("outcome"), "fraud_probability")
    dead = read_route(spark, f"{folder}/out", "dead").select("key", F.lit("dead letter").alias("outcome"), F.lit(None).cast("double").alias("fraud_probability"))
    return shown(scores.unionByName(dead).select(F.col("key").cast("long").alias("event_id"), "outcome", "fraud_probability"))


def csv_inferred(spark, sf_dir):
    """The events as CSV text, among them lines that are cut or too wide: types found from the values, damaged lines put aside."""
    source = events(spark, sf_dir).drop("label")
    path, number = fresh_folder(spark, "csv"), F.col("event_id") % 50
    source.filter(~number.isin(1, 2)).write.option("timestampNTZFormat", TIME_FORMAT).csv(path, header=True)
    lines = source.filter(number.isin(1, 2)).select(F.when(number == 1, F.concat("event_id", F.lit(",cut"))).otherwise(F.concat_ws(",", "event_id", F.lit(",,,,,more"))).alias("value"))
    # a file of lines, the header first
    spark.createDataFrame([(",".join(source.columns),)], lines.schema).union(lines).coalesce(1).write.mode("append").text(path)
    rows, damaged = read_csv_inferred(spark, path)
    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema)
    return shown(rows.withColumns({"types": F.lit(kinds), "damaged": F.lit(damaged.count()).cast("long")}), digits=9)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_events": parse_events,
    "message_validity": message_validity,
    "valid_window_stats": valid_window_stats,
    "stamped_events": stamped_events,
    "csv_scan": csv_scan,
    "first_events": first_events_query,
    "window_stats": window_stats,
    "window_stats_short": window_stats_short,
    "window_stats_by_key": window_stats_by_key,
    "window_stats_large": window_stats_large,
    "zscore_scored": zscore_scored,
    "zscore_anomalies": zscore_anomalies_query,
    "zscore_short": zscore_short,
    "zscore_by_key": zscore_by_key,
    "zscore_split_join": zscore_split_join,
    "zscore_large": zscore_large,
    "iqr_bounds": iqr_bounds_query,
    "iqr_anomalies": iqr_anomalies_query,
    "iqr_large": iqr_large,
    "iqr_by_key": iqr_by_key,
    "zscore_and_iqr": zscore_and_iqr,
    "isolation_scores": isolation_scores,
    "isolation_fixed_scores": isolation_fixed_scores,
    "linear_scores": linear_scores,
    "forest_scores": forest_scores,
    "data_drift": data_drift_query,
    "data_drift_large": data_drift_large,
    "label_drift": label_drift_query,
    "data_drift_alerts": data_drift_alerts_query,
    "label_drift_alerts": label_drift_alerts_query,
    "baseline_drift_alerts": baseline_drift_alerts_query,
    "baseline_drift_by_key": baseline_drift_by_key,
    "prediction_drift": prediction_drift_query,
    "confusion_by_window": confusion_by_window,
    "performance_by_window": performance_by_window,
    "performance_short": performance_short,
    "monitor_all": monitor_all,
    "stream_window_stats": stream_window_stats,
    "stream_zscore": stream_zscore,
    "stream_iqr": stream_iqr,
    "stream_scores": stream_scores,
    "stream_monitor": stream_monitor,
    "stream_zscore_batches": stream_zscore_batches,
    "stream_monitor_batches": stream_monitor_batches,
    "stream_previous_window": stream_previous_window,
    "ingest_routes": ingest_routes,
    "ingest_batch_counts": ingest_batch_counts,
    "csv_inferred": csv_inferred,
    "job_scores_or_dead_letters": job_scores_or_dead_letters,
    "job_scores": job_scores,
    "job_anomalies": job_anomalies,
    "job_drift": job_drift,
}
