"""Kafka topics as source and sink, through Spark's own connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streamwatch.functions.messages import encode_events, stamp_missing_time

# The defaults of the pipelines.
SERVERS = "localhost:9092"
TOPIC = "credit-transactions"


def source_options(
    servers: str = SERVERS,
    topic: str = TOPIC,
    *,
    starting: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the stream source.

    ``min_partitions`` splits a busy topic partition over several tasks, and
    ``max_offsets`` bounds a micro-batch after a long stop.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(servers: str = SERVERS, topic: str = TOPIC) -> dict[str, str]:
    """Options of the sink: full acknowledgement and three retries."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def read_topic(spark: SparkSession, servers: str = SERVERS, topic: str = TOPIC, **options) -> DataFrame:
    """The raw messages of a topic as a stream."""
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **options)).load()


def outgoing(df: DataFrame, key_col: str | None = None, ts_col: str = "timestamp") -> DataFrame:
    """The messages of ``publish``: each row as JSON, stamped now if it has no time."""
    return encode_events(stamp_missing_time(df, ts_col), key_col)


def publish(
    df: DataFrame,
    servers: str = SERVERS,
    topic: str = TOPIC,
    *,
    key_col: str | None = None,
    ts_col: str = "timestamp",
    checkpoint: str | None = None,
) -> StreamingQuery | None:
    """Send each row as a JSON message; a stream needs a ``checkpoint`` folder.

    Without ``key_col`` messages spread evenly over the partitions of the topic.
    """
    messages = outgoing(df, key_col, ts_col)
    options = sink_options(servers, topic)
    if not df.isStreaming:
        messages.write.format("kafka").options(**options).save()
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    return (
        messages.writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )
