import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from streamwatch.functions.messages import (
    decode_events,
    encode_events,
    first_events,
    split_events,
    stamp_missing_time,
)
from streamwatch.schema import EVENT_SCHEMA, FEATURE_COLUMNS


def decoded(spark, *values, **options):
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    return decode_events(raw, **options)


def test_schema_has_the_declared_fields():
    assert len(EVENT_SCHEMA) == 32
    assert EVENT_SCHEMA.names == ["Time", *(f"V{i}" for i in range(1, 29)), "Amount", "Class", "timestamp"]
    assert FEATURE_COLUMNS[-2:] == ("Time", "Amount") and len(FEATURE_COLUMNS) == 30


def test_label_written_as_a_double_survives(spark):
    """An integer field would read 1.0 as null."""
    rows = decoded(spark, '{"Class": 1.0}', '{"Class": 0.0}', '{"Class": 1}').select("Class").collect()
    assert [r.Class for r in rows] == [1, 0, 1]


def test_label_out_of_range_is_null(spark):
    assert decoded(spark, '{"Class": 1e300}').first().Class is None


def test_unknown_fields_are_dropped_and_missing_ones_null(spark):
    row = decoded(spark, '{"Amount": 2.5, "other": 1}').first()
    assert row.Amount == 2.5 and row.V1 is None and len(row) == 32


def test_binary_values_are_read(spark):
    raw = spark.createDataFrame([(bytearray(b'{"Amount": 1.5}'),)], "value binary")
    assert decode_events(raw).first().Amount == 1.5


def test_columns_narrow_the_parse(spark):
    frame = decoded(spark, '{"Amount": 1, "V1": 2}', columns=["timestamp", "Amount"])
    assert frame.columns == ["Amount", "timestamp"]
    with pytest.raises(ValueError, match="nothing"):
        decoded(spark, "{}", columns=["nothing"])


def test_invalid_messages_are_split_off_with_their_text(spark):
    time = '"timestamp": "2024-01-01T00:00:00"'
    good = f'{{"Amount": 1, {time}}}'
    bad = ["garbage", None, f'{{"Amount": "x", {time}}}', '{"Amount": 1, "timestamp": "soon"}', '{"Amount": 1}']
    frame = decoded(spark, good, *bad, keep_corrupt=True)
    valid, invalid = split_events(frame)
    assert valid.count() == 1 and valid.columns == EVENT_SCHEMA.names
    assert invalid.count() == len(bad)
    assert {r._corrupt_record for r in invalid.collect()} == {None, "garbage", bad[2]}


def test_message_columns_are_kept_beside_the_event(spark):
    raw = spark.sql("""SELECT '{"Amount": 1}' AS value, 3 AS partition, 9L AS offset, now() AS timestamp""")
    row = decode_events(raw, columns=["Amount"], keep=["partition", "offset"]).first()
    assert row.asDict() == {"partition": 3, "offset": 9, "Amount": 1.0}
    with pytest.raises(ValueError, match="timestamp"):
        decode_events(raw, keep=["timestamp"])


def test_round_trip_keeps_every_field(spark):
    row = {name: float(i) for i, name in enumerate(FEATURE_COLUMNS)}
    row |= {"Class": 1, "timestamp": "2024-01-01T00:00:00.123456"}
    source = spark.createDataFrame([tuple(row[n] for n in EVENT_SCHEMA.names)], EVENT_SCHEMA)
    assert decode_events(encode_events(source)).collect() == source.collect()


def test_times_are_written_to_the_microsecond(spark):
    source = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.123456' AS a, TIMESTAMP'2024-01-01 00:00:00.000001' AS b")
    text = encode_events(source).first().value
    assert text == '{"a":"2024-01-01T00:00:00.123456","b":"2024-01-01T00:00:00.000001"}'


def test_message_key(spark):
    frame = encode_events(spark.sql("SELECT 7 AS id, 1.5D AS x"), "id")
    assert frame.first().asDict() == {"key": "7", "value": '{"id":7,"x":1.5}'}


def test_missing_time_is_stamped(spark, transactions):
    rows = transactions([("2024-01-01T00:00:00", 1.0, 0), (None, 2.0, 0)])
    stamped = {r.Amount: r.timestamp for r in stamp_missing_time(rows).collect()}
    assert stamped[1.0] == "2024-01-01T00:00:00"
    assert stamped[2.0] > "2025" and "T" in stamped[2.0]
    absent = stamp_missing_time(rows.drop("timestamp"))
    assert absent.filter(F.col("timestamp").try_cast("timestamp").isNull()).count() == 0


def test_first_events(transactions):
    rows = transactions([(f"2024-01-01T00:00:0{i}", float(i), 0) for i in (3, 1, 2)])
    assert [r.Amount for r in first_events(rows, 2, ["timestamp"]).collect()] == [1.0, 2.0]
    assert first_events(rows, 0, ["timestamp"]).count() == 3
    assert first_events(rows, None, ["timestamp"]).count() == 3


def test_random_events_survive_the_wire(spark):
    rng = random.Random(11)

    def number():
        kind = rng.random()
        if kind < 0.1:
            return None
        if kind < 0.2:
            return rng.choice([0.0, -0.0, 1e-300, 1.7976931348623157e308, -5e-324, 2.0**53])
        return rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12)

    rows = []
    for _ in range(300):
        moment = dt.datetime(1971, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**16))
        numbers = [number() for _ in FEATURE_COLUMNS]
        rows.append((*numbers, rng.choice([0, 1, None]), moment.isoformat(timespec="microseconds")))
    source = spark.createDataFrame(rows, EVENT_SCHEMA)
    assert decode_events(encode_events(source)).collect() == source.collect()
