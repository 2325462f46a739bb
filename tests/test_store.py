import json

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from sensorloom.operators import ontology, routing
from sensorloom.operators.sequence import number_rows
from sensorloom.plans import export, reports, store as stores
from sensorloom.plans.publish import Interrupted, Publication, Router, publish
from sensorloom.plans.store import NO_CHANNEL, SequenceStore
from sensorloom.sources.messages import folder_name, read_messages, write_messages
from sensorloom.streaming.publish_stream import StreamPublisher, message_stream

CHANNELS = "recording string, channel_id int, topic string, encoding string, schema_name string"


@pytest.fixture()
def store(spark, tmp_path):
    return SequenceStore(spark, str(tmp_path / "store"))


@pytest.fixture(scope="module")
def channels(spark):
    return spark.createDataFrame(
        [("a", 1, "/value", "json", "std_msgs/Float64"), ("a", 2, "/odd one:1", "json", "std_msgs/msg/String"), ("a", 3, "/unknown", "json", "acme/X"),
         ("a", 4, "/wire", "cdr", "std_msgs/Bool"), ("a", 5, "/silent", "json", "std_msgs/Int8"),
         ("b", 1, "/value", "json", "std_msgs/msg/Int32")], CHANNELS
    )


@pytest.fixture(scope="module")
def traffic(spark, messages):
    """Two recordings whose topic /value has another type in each."""
    return (
        messages(*[f'{{"data":{i}.5}}' for i in range(9)], "not json{", topic="/value", recording="a", channel_id=1)
        .unionByName(messages('{"data":"x"}', '{"data":5}', topic="/odd one:1", recording="a", channel_id=2))
        .unionByName(messages("{}", topic="/unknown", recording="a", channel_id=3))
        .unionByName(messages("{}", topic="/wire", recording="a", channel_id=4))
        .unionByName(messages('{"data":7}', '{"data":99999999999}', topic="/value", recording="b", channel_id=1))
    )


def statuses(df):
    return {r.status: r.topics for r in df.collect()}


def test_publish_and_read(store, traffic, channels):
    key, counts = publish(store, traffic, channels)
    assert statuses(counts) == {"uploaded": 4, "skipped": 1, "failed": 1}
    listed = {(r.sequence, r.topic): r for r in store.list_topics().collect()}
    assert {k: (r.rows, r.ontology_tag) for k, r in listed.items()} == {
        ("a", "/value"): (9, "floating64"), ("a", "/odd one:1"): (2, "string"), ("a", "/silent"): (0, "integer8"), ("b", "/value"): (1, "integer32"),
    }
    assert all((r.bytes > 0) == (r.rows > 0) for r in listed.values())
    assert [r.data for r in store.pull_topic("a", "/value").orderBy("timestamp_ns").collect()] == [i + 0.5 for i in range(9)]
    assert [r.data for r in store.pull_topic("b", "/value").collect()] == [7]
    assert [r.data for r in store.pull_topic("a", "/odd one:1").orderBy("timestamp_ns").collect()] == ["x", ""]
    silent = store.pull_topic("a", "/silent")
    assert silent.count() == 0 and dict(silent.dtypes)["data"] == "tinyint"
    seen = Observation("pulled")
    assert len(store.pull_topic("a", "/value", observation=seen).collect()) == seen.get["rows"] == 9
    bounded = store.pull_topic("a", "/value", 2 * 10**9, 4 * 10**9)
    assert [r.timestamp_ns for r in bounded.orderBy("timestamp_ns").collect()] == [2 * 10**9, 3 * 10**9, 4 * 10**9]
    assert "PushedFilters: [IsNotNull(sequence), IsNotNull(timestamp_ns)" in bounded._jdf.queryExecution().toString()
    bad = {(r.topic, r.reason): bytes(r.payload) for tag in ("floating64", "integer32") for r in store.rejects(key, tag).collect()}
    assert bad == {("/value", "parse_error"): b"not json{", ("/value", "out_of_range"): b'{"data":99999999999}'}
    report = {(r.sequence, r.topic): (r.topics, r.fields, r.duration) for r in reports.sequence_report(store.list_topics()).collect()}
    assert report["a", "/value"] == (3, "4", "8s") and report["a", "/silent"] == (3, "4", "—")
    sizes = {r.name: (r.min_ts_ns, r.max_ts_ns, r.total_size_bytes > 0) for r in store.list_sequences().collect()}
    assert sizes == {"a": (10**9, 9 * 10**9, True), "b": (10**9, 10**9, True)}
    with pytest.raises(LookupError):
        store.pull_topic("a", "/unknown")
    with pytest.raises(ValueError):
        publish(store, traffic, channels)


def test_messages_without_a_channel_are_rejects(store, traffic, channels):
    key, counts = publish(store, traffic, channels.where("topic <> '/value' or recording <> 'a'"))
    stray = store.rejects(key, NO_CHANNEL).collect()
    assert {(r.recording, r.topic, r.reason) for r in stray} == {("a", "/value", "no_channel")}
    assert len(stray) == traffic.where("recording = 'a' and topic = '/value'").count()
    assert statuses(counts)["uploaded"] == 3 and store.pull_topic("b", "/value").count() == 1


def test_a_table_laid_out_by_topic_is_written_without_shuffle(store, traffic, channels, spark, tmp_path):
    write_messages(traffic, str(tmp_path / "m"))
    _, counts = publish(store, read_messages(spark, str(tmp_path / "m")), channels, by_topic=True)
    assert statuses(counts)["uploaded"] == 4
    assert {(r.sequence, r.topic): r.rows for r in store.list_topics().collect()} == {
        ("a", "/value"): 9, ("a", "/odd one:1"): 2, ("a", "/silent"): 0, ("b", "/value"): 1,
    }


def test_router_ways(spark, channels):
    routes = routing.route(channels, routing.tag_map(spark), ontology.default_registry().tags(), ["json"])
    assert ("string", "json") in Router(routes).ways() and ("integer8", "json") in Router(routes).ways()


def test_a_failing_tag_does_not_stop_the_others(store, traffic, channels):
    registry = ontology.default_registry().add("string", lambda f: {"data": F.raise_error(F.lit("broken"))})
    _, counts = publish(store, traffic, channels, registry)
    assert statuses(counts) == {"uploaded": 3, "skipped": 1, "failed": 2}
    with pytest.raises(LookupError):
        store.pull_topic("a", "/odd one:1")


def test_lifecycle(store, spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(10)], "timestamp_ns bigint, x double")
    upload = store.begin_upload(["one"])
    with pytest.raises(RuntimeError):
        upload.put_batch(rows)
    upload.create_topic("one", "/t", "custom")
    upload.put_batch(rows)
    assert store.sequence_names().count() == 0
    with pytest.raises(ValueError):
        store.begin_upload(["one"])
    upload.finalize()
    with pytest.raises(RuntimeError):
        upload.finalize()
    upload.cleanup()
    assert [r.name for r in store.sequence_names().collect()] == ["one"] and store.pull_topic("one", "/t").count() == 10
    with pytest.raises(ValueError):
        store.delete_sequence("one")
    with store.begin_upload(["two"]) as dropped:
        dropped.create_topic("two", "/t", "custom")
        dropped.put_batch(rows)
    dropped.cleanup()
    store.begin_upload(["three"])
    store.delete_sequence("three")
    assert {r.name: r.state for r in store.states().collect()} == {"one": "finalized", "two": "deleted", "three": "deleted"}
    with pytest.raises(LookupError):
        store.delete_sequence("three")
    assert store.pull_topic("one", "/t").schema["timestamp_ns"].metadata == {"ontology_tag": "custom"}
    store.begin_upload(["two"]).finalize()


def test_export(store, traffic, channels, spark, tmp_path):
    publish(store, traffic, channels)
    written = export.export_sequence(store, "a", str(tmp_path / "out"))
    assert [w.rsplit("/", 1)[1] for w in written] == ["odd one:1", "value"] and spark.read.parquet(written[1]).count() == 9
    with pytest.raises(ValueError):
        export.export_sequence(store, "a", str(tmp_path / "other"), "csv")
    store.begin_upload(["empty"]).finalize()
    with pytest.raises(LookupError):
        export.export_sequence(store, "empty", str(tmp_path / "none"))


def test_json_sink(spark, tmp_path):
    table = spark.createDataFrame(
        [(10**9 * i, float(i), None if i == 2 else i + 3, [1.0, float(i)], float("nan"), bytearray(b"x")) for i in (1, 2, 3)],
        "timestamp_ns bigint, x double, y int, v array<double>, n double, b binary",
    )
    out = export.to_messages(table, "r", "/t").orderBy("sequence").collect()
    assert [(r.sequence, r.log_time_ns, r.publish_time_ns) for r in out] == [(i, (i + 1) * 10**9, (i + 1) * 10**9) for i in range(3)]
    assert json.loads(bytes(out[1].payload)) == {"x": 2.0, "y": None, "v": [1.0, 2.0], "n": None, "b": None}
    no_time = export.to_messages(table.drop("timestamp_ns"), "r", "/t").collect()
    assert {r.log_time_ns for r in no_time} == {0} and sorted(r.sequence for r in no_time) == [0, 1, 2]
    path = str(tmp_path / "rec")
    export.write_recording(path, "rec", {"/t": table, "/u": table.select("timestamp_ns")})
    back = read_messages(spark, path + "/messages").groupBy("topic").count().collect()
    assert {r.topic: r["count"] for r in back} == {"/t": 3, "/u": 3}
    schema = {r.topic: json.loads(r.schema_data) for r in spark.read.parquet(path + "/channels").collect()}
    assert schema["/u"] == {"properties": {}, "type": "object"} and schema["/t"]["properties"]["x"] == {"type": "number"}


def test_numbering_of_a_hot_group(spark):
    """Two thirds of the rows in one group, with equal times: both ways give the same numbers."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"),
        (F.col("id") % 7).alias("t"), F.col("id").alias("tie"),
    ).repartition(7)
    window = df.withColumn("sequence", F.row_number().over(Window.partitionBy("g").orderBy("t", "tie")).cast("bigint") - 1)
    ranged = number_rows(df, ["g"], ["t", "tie"], tasks=9)
    assert ranged.columns == window.columns and sorted(window.collect()) == sorted(ranged.collect())


def test_message_table_prunes_by_topic(spark, traffic, tmp_path):
    path = str(tmp_path / "m")
    write_messages(traffic, path)
    scan = read_messages(spark, path).where("topic = '/value'")
    assert scan.count() == 12 and "PartitionFilters: [isnotnull(topic" in scan._jdf.queryExecution().toString()
    assert (tmp_path / "m" / f"topic={folder_name('/odd one:1')}").exists()


def test_stream_equals_batch(spark, tmp_path, traffic, channels):
    source = str(tmp_path / "source")
    traffic.repartition(5).write.parquet(source)
    streamed, batch = SequenceStore(spark, str(tmp_path / "s")), SequenceStore(spark, str(tmp_path / "b"))
    publisher = StreamPublisher(streamed, channels)
    publisher.start(message_stream(spark, source, files_per_batch=2), str(tmp_path / "c"))
    assert statuses(publisher.finish()) == {"uploaded": 4, "skipped": 1, "failed": 1}
    assert publisher.progress()[0] == traffic.count()
    publish(batch, traffic, channels)
    for sequence, topic in (("a", "/value"), ("a", "/odd one:1"), ("b", "/value")):
        rows = lambda s: sorted(map(str, s.pull_topic(sequence, topic).collect()))
        assert rows(streamed) == rows(batch)
    again = SequenceStore(spark, str(tmp_path / "i"))
    stopped = StreamPublisher(again, channels)
    stopped.start(message_stream(spark, source), str(tmp_path / "c2"), processingTime="1 hour")
    stopped.interrupt()
    assert again.sequence_names().count() == 0


def test_topics_that_look_like_numbers(store, spark, messages, tmp_path):
    traffic = messages('{"data":1}', topic="007", recording="n", channel_id=1)
    channels = spark.createDataFrame([("n", 1, "007", "json", "std_msgs/Int8")], CHANNELS)
    write_messages(traffic, str(tmp_path / "m"))
    stored = read_messages(spark, str(tmp_path / "m"))
    assert stored.first().topic == "007"
    key, _ = publish(store, stored, channels)
    assert store.pull_topic("n", "007").first().data == 1 and store.read_tag(key, "integer8").first().topic == "007"


def test_a_repeated_batch_replaces_itself(store, spark):
    rows = spark.createDataFrame([("s", "/t", 1, 1.0)], "sequence string, topic string, timestamp_ns bigint, x double")
    with store.begin_upload(["s"]) as upload:
        for _ in range(2):
            upload.write(rows, "custom", batch=7)
        upload.record(spark.createDataFrame([("s", "/t", "custom")], "sequence string, topic string, tag string"))
        upload.finalize()
    assert store.pull_topic("s", "/t").count() == 1
