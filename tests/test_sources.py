import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from streamwatch.schema import TABLE_SCHEMA
from streamwatch.session import checkpoint_root, fresh_folder, remove_scratch, scratch_mark
from streamwatch.sources.files import read_csv, read_csv_inferred, split_csv, stream_files
from streamwatch.functions.messages import decode_events
from streamwatch.sources.kafka import outgoing, publish, sink_options, source_options


def test_csv_with_header(spark, tmp_path):
    header = ",".join(TABLE_SCHEMA.names)
    line = ",".join(["1.5"] * 30 + ["1"])
    (tmp_path / "rows.csv").write_text(f"{header}\n{line}\n")
    row = read_csv(spark, str(tmp_path / "rows.csv")).first()
    assert row.Time == 1.5 and row.Amount == 1.5 and row.Class == 1


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "rows.csv")).collect()


def test_missing_csv_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "none.csv"))


def test_kafka_source_options():
    assert source_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "credit-transactions",
        "startingOffsets": "latest",
    }
    tuned = source_options("a:1", "t", starting="earliest", max_offsets=5, min_partitions=6)
    assert tuned["maxOffsetsPerTrigger"] == "5" and tuned["minPartitions"] == "6"


def test_kafka_sink_options():
    assert sink_options("a:1", "t") == {
        "kafka.bootstrap.servers": "a:1", "topic": "t", "kafka.acks": "all", "kafka.retries": "3",
    }


def test_outgoing_messages_are_stamped_and_readable(spark):
    row = ",".join(["1.5D AS " + name for name in TABLE_SCHEMA.names if name != "Class"])
    table = spark.sql(f"SELECT {row}, 1.0D AS Class, 'c7' AS card")
    message = outgoing(table, key_col="card").first()
    assert message.key == "c7" and '"Class":1.0' in message.value
    event = decode_events(outgoing(table)).first()
    assert event.Class == 1 and event.V28 == 1.5 and event.timestamp > "2025"


def test_publishing_a_stream_needs_a_checkpoint(spark, tmp_path):
    stream = stream_files(spark, str(tmp_path), TABLE_SCHEMA, fmt="csv")
    with pytest.raises(ValueError, match="checkpoint"):
        publish(stream)


def test_scratch_folders_lie_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root
    first, second = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert first != second and first.startswith(f"{root}/")


def _csv(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_types_found_from_the_values(spark, tmp_path):
    path = _csv(
        tmp_path / "t",
        a="i,d,b,t,s,e,m\n1,1,true,2024-01-01,x,,1\n-2,2.5e3,FALSE,2024-01-01T10:00:00,1,,2\n",
        b="i,d,b,t,s,e,m\n3,NaN,true,2024-02-30T00:00:00,,,x\n" + "4,1.5,false,2024-01-02,y,,3\n",
    )
    rows, damaged = read_csv_inferred(spark, path)
    # a day that does not exist is no time, so that column is text
    assert [kind for _, kind in rows.dtypes] == ["bigint", "double", "boolean", "string", "string", "string", "string"]
    assert rows.count() == 4 and damaged.count() == 0


def test_damaged_rows_are_put_aside_and_do_not_decide_types(spark, tmp_path):
    path = _csv(tmp_path / "t", a="i,t\n1,2024-01-01 00:00:00\nx\n2,2024-01-02 00:00:00,more\n3,2024-01-03 00:00:00\n", b="i,t\n4,2024-01-04 00:00:00\n")
    rows, damaged = read_csv_inferred(spark, path)
    assert rows.dtypes == [("i", "bigint"), ("t", "timestamp_ntz")]
    assert sorted(r.i for r in rows.collect()) == [1, 3, 4] and sorted(r.i for r in rows.select("i").collect()) == [1, 3, 4]
    assert sorted(r.record for r in damaged.collect()) == ["2,2024-01-02 00:00:00,more", "x"] and damaged.count() == 2


def test_values_that_a_declared_type_cannot_hold(spark, tmp_path):
    path = _csv(tmp_path / "t", a="i,d\n1,2.5\nx,1\n3,\n")
    rows, damaged = split_csv(spark, path, T.StructType([T.StructField("i", T.LongType()), T.StructField("d", T.DoubleType())]))
    assert sorted((r.i, r.d) for r in rows.fillna(0.0).collect()) == [(1, 2.5), (3, 0.0)] and [r.record for r in damaged.collect()] == ["x,1"]


def test_missing_and_empty_files(spark, tmp_path):
    assert read_csv_inferred(spark, str(tmp_path / "none"), missing_ok=True) is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv_inferred(spark, str(tmp_path / "none"))
    rows, damaged = read_csv_inferred(spark, _csv(tmp_path / "t", a="i,t\n"))
    assert rows.dtypes == [("i", "string"), ("t", "string")] and rows.count() == damaged.count() == 0


def test_scratch_folders_go_when_asked(spark):
    old = fresh_folder(spark, "old")
    mark = scratch_mark()
    gone, kept = fresh_folder(spark, "gone"), fresh_folder(spark, "kept")
    for path in (old, gone, kept):
        spark.range(3).write.parquet(path)
    remove_scratch(spark, mark, [kept])
    assert spark.read.parquet(old).count() == spark.read.parquet(kept).count() == 3
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone)
