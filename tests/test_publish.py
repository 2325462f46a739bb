"""Publications: one scan, interrupts, progress, raw topics, pruned pulls, reclaimed data."""

import glob
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import ontology, raw
from sensorloom.operators.routing import tag_map
from sensorloom.plans import export
from sensorloom.plans.publish import Interrupted, Progress, Publication, publish
from sensorloom.plans.store import NO_CHANNEL, SequenceStore
from sensorloom.sources.messages import read_messages, write_messages
from sensorloom.streaming.publish_stream import StreamPublisher, message_stream

CHANNELS = "recording string, channel_id int, topic string, encoding string, schema_name string"


@pytest.fixture()
def store(spark, tmp_path):
    return SequenceStore(spark, str(tmp_path / "store"))


@pytest.fixture(scope="module")
def channels(spark):
    return spark.createDataFrame(
        [("a", 1, "/f", "json", "std_msgs/Float64"), ("a", 2, "/s", "json", "std_msgs/String"), ("a", 3, "/i", "json", "std_msgs/Int8"),
         ("a", 4, "/skip", "json", "acme/X"), ("b", 1, "/f", "json", "std_msgs/Float64")], CHANNELS
    )


@pytest.fixture(scope="module")
def traffic(messages):
    return (
        messages(*[f'{{"data":{i}.5}}' for i in range(20)], "no", topic="/f", recording="a", channel_id=1)
        .unionByName(messages('{"data":"x"}', topic="/s", recording="a", channel_id=2))
        .unionByName(messages('{"data":1}', '{"data":1000}', topic="/i", recording="a", channel_id=3))
        .unionByName(messages("{}", "{}", topic="/skip", recording="a", channel_id=4))
        .unionByName(messages('{"data":2.0}', topic="/f", recording="b", channel_id=1))
        .unionByName(messages("{}", topic="/stray", recording="a", channel_id=9))
    )


def counted(spark, messages):
    """The messages, and a counter of the rows that any job reads of them."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return messages.mapInArrow(run, messages.schema), read


def test_messages_are_scanned_once(spark, store, traffic, channels):
    seen, read = counted(spark, traffic)
    key, counts = publish(store, seen, channels)
    assert read.value == traffic.count()
    assert {r.status: r.topics for r in counts.collect()} == {"uploaded": 4, "skipped": 1}
    assert {(r.sequence, r.topic): r.rows for r in store.list_topics().collect()} == {("a", "/f"): 20, ("a", "/s"): 1, ("a", "/i"): 1, ("b", "/f"): 1}
    assert [(r.topic, r.reason) for r in store.rejects(key, NO_CHANNEL).collect()] == [("/stray", "no_channel")]
    assert not glob.glob(f"{store.root}/staging/*")


def test_a_channel_of_two_tags_is_published_in_both(store, traffic, channels, spark):
    tags = tag_map(spark).unionByName(spark.createDataFrame([("std_msgs/Int8", "integer16")], "schema_name string, tag string"))
    key, _ = publish(store, traffic, channels, tags=tags)
    assert store.read_tag(key, "integer8").count() == 1 and store.read_tag(key, "integer16").count() == 2


def test_progress_comes_from_the_writes(store, traffic, channels):
    told = []
    run = Publication(store, traffic, channels, on_progress=lambda p: told.append((p.rows, p.bytes, len(p.written))))
    assert run.progress == Progress()
    run.run()
    size = traffic.agg(F.sum(F.octet_length("payload"))).first()[0]
    # once the messages are read, before any tag is written, and at the end
    assert told == [(traffic.count(), size, 0), (traffic.count(), size, 4)]
    assert run.progress.written[("floating64", "json")] == (21, 1) and run.progress.written[("integer8", "json")] == (1, 1)
    assert run.progress.good() == 23 and run.progress.rejected() == 3


def slow_registry(seconds):
    """A projection that takes its time in the executors."""

    @F.pandas_udf("string")
    def late(x):
        time.sleep(seconds)
        return x

    return ontology.default_registry().add("string", lambda f: {"data": late(f.text("data"))})


def test_a_running_publication_is_interrupted(spark, store, traffic, channels):
    started = threading.Event()
    run = Publication(store, traffic, channels, slow_registry(120), parallel_tags=1, on_progress=lambda _: started.set())
    run.start()
    assert started.wait(60)
    until = time.time() + 30
    while ("integer8", "json") not in run.progress.written and time.time() < until:
        time.sleep(0.1)
    time.sleep(1)
    begun = time.time()
    run.interrupt()
    with pytest.raises(Interrupted):
        run.result(60)
    assert time.time() - begun < 30  # the slow job did not run to its end
    assert spark.sparkContext.statusTracker().getActiveJobsIds() == []
    assert {r.state for r in store.states().collect()} == {"deleted"}
    assert store.sequence_names().count() == 0 and store.list_topics().count() == 0
    publish(store, traffic, channels)  # the names are free again
    assert store.pull_topic("a", "/s").first().data == "x"


def test_an_interrupt_before_the_start(store, traffic, channels):
    run = Publication(store, traffic, channels)
    run.interrupt()
    with pytest.raises(Interrupted):
        run.run()
    assert store.sequence_names().count() == 0


def test_background_publication_returns_its_result(store, traffic, channels):
    key, counts = Publication(store, traffic, channels).start().result(300)
    assert key and counts.count() == 2 and store.pull_topic("b", "/f").count() == 1


def test_stream_tells_progress_before_a_batch_ends(spark, tmp_path, store, traffic, channels):
    source = str(tmp_path / "source")
    traffic.coalesce(1).write.parquet(source)
    told = []
    written = lambda: glob.glob(f"{store.root}/data/*/*")
    publisher = StreamPublisher(store, channels, on_progress=lambda rows, size: told.append((rows, size > 0, len(written()))))
    publisher.start(message_stream(spark, source), str(tmp_path / "c"))
    publisher.finish()
    assert told == [(traffic.count(), True, 0)] and publisher.progress()[0] == traffic.count()


# ---------------------------------------------------------------- raw topics


RAW = {
    "/one": ['{"b":1,"a":{"x":1.5}}', '{"b":2,"c":"t","a":{"x":2}}', "[1]", "bad", '{"b":[1,"x"]}', '{"timestamp_ns":5,"_log_time_ns":6}'],
    "/two": ['{"v":[1,2]}', '{"v":[]}', '{"v":[1,null]}', '{"w":[true]}', '{"big":18446744073709551615}'],
    "/none": ["{}", '{"x":null}'],
}


@pytest.fixture()
def raw_store(spark, store, messages):
    traffic, rows = None, []
    for i, (topic, payloads) in enumerate(RAW.items()):
        part = messages(*payloads, topic=topic, recording="r", channel_id=i)
        traffic = part if traffic is None else traffic.unionByName(part)
        rows.append(("r", i, topic, "json", "acme/Any"))
    channels = spark.createDataFrame([*rows, ("r", 9, "/silent", "json", "acme/Any")], CHANNELS)
    key, counts = publish(store, traffic, channels, tags=tag_map(spark, {"acme/Any": "raw"}))
    assert {r.status: r.topics for r in counts.collect()} == {"uploaded": 4}
    return store, key


def test_raw_topics_have_their_own_columns(raw_store):
    store, key = raw_store
    one = store.pull_topic("r", "/one")
    assert one.columns == ["timestamp_ns", "_log_time_ns", "_log_time_ns_", "a.x", "b", "c", "timestamp_ns_"]
    got = sorted((r["_log_time_ns"], r["a.x"], r["b"], r["c"], r["timestamp_ns_"], r["_log_time_ns_"]) for r in one.collect())
    # the row in which b is a mixed array is rejected for it
    assert got == [(10**9, 1.5, 1, None, None, None), (2 * 10**9, 2.0, 2, "t", None, None), (6 * 10**9, None, None, None, 5, 6)]
    two = store.pull_topic("r", "/two")
    assert two.columns == ["timestamp_ns", "_log_time_ns", "v", "w"]
    got = sorted((r.timestamp_ns // 10**9, r.v, r.w) for r in two.collect())
    assert got == [(1, [1.0, 2.0], None), (2, [], None), (4, None, "[true]")]
    assert store.pull_topic("r", "/none").columns == ["timestamp_ns", "_log_time_ns"] and store.pull_topic("r", "/none").count() == 2
    assert store.pull_topic("r", "/silent").count() == 0
    assert store.pull_topic("r", "/two", 2 * 10**9, 3 * 10**9).count() == 1
    bad = sorted((r.topic, r.log_time_ns // 10**9, r.reason, bytes(r.payload).decode()) for r in store.rejects(key, "raw").collect())
    assert bad == [
        ("/one", 3, "not_object", "[1]"), ("/one", 4, "parse_error", "bad"), ("/one", 5, "mixed_array", '{"b":[1,"x"]}'),
        ("/two", 3, "mixed_array", '{"v":[1,null]}'), ("/two", 5, "int_overflow", '{"big":18446744073709551615}'),
    ]
    listed = {r.topic: (r.ontology_tag, r.rows) for r in store.list_topics("r").collect()}
    assert listed == {"/one": ("raw", 3), "/two": ("raw", 3), "/none": ("raw", 2), "/silent": ("raw", 0)}


def test_a_stream_of_raw_topics_goes_on_after_a_restart(spark, tmp_path, store, messages):
    source, tags = str(tmp_path / "source"), tag_map(spark, {"acme/Any": "raw"})
    channels = spark.createDataFrame([("r", 1, "/t", "json", "acme/Any")], CHANNELS)
    messages('{"a":1}', topic="/t", recording="r").write.parquet(source)
    first = StreamPublisher(store, channels, tags=tags)
    first.start(message_stream(spark, source), str(tmp_path / "c")).awaitTermination()
    messages('{"b":"x"}', topic="/t", recording="r").write.mode("append").parquet(source)
    again = StreamPublisher.resume(store, first.upload.key, channels, tags=tags)
    again.start(message_stream(spark, source), str(tmp_path / "c"))
    again.finish()
    assert sorted((r.a or 0, r.b or "") for r in store.pull_topic("r", "/t").collect()) == [(0, "x"), (1, "")]


def test_raw_names():
    fields = [{"path": ["a.b"], "kind": "integer"}, {"path": ["a", "b"], "kind": "num"}, {"path": [], "kind": "map:num"}]
    names = dict(raw.field_columns(fields))
    assert list(names) == ["a.b", "fields"] and "'double'" in names["a.b"]


# ---------------------------------------------------------------- pruned pulls


@pytest.fixture()
def many_files(spark, store):
    """Ten batches of ten seconds each, of two sequences in the same files."""
    with store.begin_upload(["s", "t"]) as upload:
        for batch in range(10):
            rows = spark.range(100).select(
                F.when(F.col("id") % 2 == 0, "s").otherwise("t").alias("sequence"), F.lit("/a+b %2F'").alias("topic"),
                (F.col("id") + batch * 100).alias("timestamp_ns"), F.lit(1.5).alias("x"),
            )
            upload.write(rows.coalesce(1), "custom", batch)
        upload.record(spark.createDataFrame([(s, "/a+b %2F'", "custom") for s in "st"], "sequence string, topic string, tag string"))
        upload.finalize()
    return store


def files_read(df):
    return sum(1 for _ in df.inputFiles())


def test_a_narrow_range_reads_the_files_that_meet_it(many_files):
    whole = many_files.pull_topic("s", "/a+b %2F'")
    assert files_read(whole) == 10 and whole.count() == 500
    some = many_files.pull_topic("s", "/a+b %2F'", 150, 249)
    assert files_read(some) == 2 and some.count() == 50
    assert files_read(many_files.pull_topic("t", "/a+b %2F'", 901)) == 1
    beyond = many_files.pull_topic("s", "/a+b %2F'", 5000)
    assert beyond.count() == 0 and beyond.columns == whole.columns


def test_first_rows_read_the_files_that_can_hold_them(many_files, monkeypatch):
    pulled, pull = [], many_files.pull_topic
    monkeypatch.setattr(many_files, "pull_topic", lambda *a: pulled.append(pull(*a)) or pulled[-1])
    assert [r.timestamp_ns for r in many_files.first_rows("s", "/a+b %2F'", 60).collect()] == list(range(0, 120, 2))
    assert files_read(pulled[-1]) == 2
    assert many_files.first_rows("t", "/a+b %2F'", 10**6).count() == 500
    with pytest.raises(LookupError):
        many_files.first_rows("s", "/unknown", 1)


# ---------------------------------------------------------------- reclaimed data


def test_data_of_dropped_uploads_is_removed_after_the_retention(spark, store):
    rows = spark.range(10).select(F.col("id").alias("timestamp_ns"))

    def upload(name):
        one = store.begin_upload([name])
        one.create_topic(name, "/t", "custom")
        one.put_batch(rows)
        one.close_topic()
        return one

    kept, dropped, open_ = upload("kept"), upload("dropped"), upload("open")
    kept.finalize()
    dropped.cleanup()
    assert store.vacuum() == [] and glob.glob(f"{store.root}/data/{dropped.key}/*")
    assert store.vacuum(retain_seconds=0) == [dropped.key]
    assert not glob.glob(f"{store.root}/data/{dropped.key}*") and store.pull_topic("kept", "/t").count() == 10
    assert glob.glob(f"{store.root}/data/{open_.key}/*")
    assert store.vacuum(retain_seconds=0) == []
    store.vacuum(abandon_seconds=0)
    assert store.vacuum(retain_seconds=0) == [open_.key]
    assert {r.name: r.state for r in store.states().collect()} == {"kept": "finalized", "dropped": "deleted", "open": "deleted"}


def test_a_laid_out_table_without_strays_is_not_read_for_them(spark, store, traffic, channels, tmp_path):
    write_messages(traffic.where("topic <> '/stray'"), str(tmp_path / "m"))
    key, _ = publish(store, read_messages(spark, str(tmp_path / "m")), channels, by_topic=True)
    assert store.rejects(key, NO_CHANNEL).count() == 0
    write_messages(traffic, str(tmp_path / "n"))
    again = SequenceStore(spark, str(tmp_path / "other"))
    key, _ = publish(again, read_messages(spark, str(tmp_path / "n")), channels, by_topic=True)
    assert [r.topic for r in again.rejects(key, NO_CHANNEL).collect()] == ["/stray"]


def test_logged_fields_are_json(raw_store):
    store, _ = raw_store
    tables = {r.topic: r.table_schema for r in store.list_topics("r").collect()}
    assert json.loads(tables["/two"]) == [{"path": ["v"], "kind": "nums"}, {"path": ["w"], "kind": "anytext"}]


# ---------------------------------------------------------------- export


def test_two_hundred_topics_are_exported_in_a_few_jobs(spark, store, tmp_path):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, "s").otherwise("t").alias("sequence"), F.format_string("/to pic:%d", F.col("id") % 200).alias("topic"),
        F.col("id").alias("timestamp_ns"), (F.col("id") * 1.5).alias("x"),
    )
    with store.begin_upload(["s", "t"]) as upload:
        upload.write(rows, "custom")
        upload.record(rows.select("sequence", "topic", F.lit("custom").alias("tag")).distinct())
        upload.finalize()
    out = str(tmp_path / "out")
    spark.sparkContext.setJobGroup("export", "export")
    try:
        manifest = export.export_by_tag(store, ["s"], out)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("export")) < 20
    assert manifest.count() == 100 and {r.rows for r in manifest.collect()} == {10}
    got = export.read_exported(spark, out, "s", "/to pic:4")
    assert got.columns == ["timestamp_ns", "x"] and sorted(r.x for r in got.collect()) == [1.5 * (4 + 200 * k) for k in range(10)]
    for sequence, topic in (("t", "/to pic:5"), ("s", "/none")):
        with pytest.raises(LookupError):
            export.read_exported(spark, out, sequence, topic)
    with pytest.raises(LookupError):
        export.read_exported(spark, str(tmp_path), "s", "/to pic:4")
    with pytest.raises(LookupError):
        export.export_by_tag(store, ["none"], str(tmp_path / "nothing"))



def test_export_files_do_not_grow_with_sequences(spark, store, tmp_path):
    """Many sequences of one tag go to one table of a few files, not to a folder each; every row is read back."""
    names = [f"q{i}" for i in range(300)]
    rows = spark.range(3000).select(
        F.concat(F.lit("q"), (F.col("id") % 300).cast("string")).alias("sequence"), F.lit("/a").alias("topic"),
        F.col("id").alias("timestamp_ns"), F.col("id").cast("double").alias("x"),
    )
    with store.begin_upload(names) as upload:
        upload.write(rows, "custom")
        upload.record(rows.select("sequence", "topic", F.lit("custom").alias("tag")).distinct())
        upload.finalize()
    out = tmp_path / "out"
    manifest = export.export_by_tag(store, names, str(out))
    folder = manifest.select("folder").distinct().first()["folder"]
    files = [p for p in (out / folder).rglob("*.parquet")]
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions")) and not list((out / folder).glob("of_sequence=*"))
    assert manifest.count() == 300 and spark.read.parquet(str(out / folder)).count() == 3000
    assert sorted(r.x for r in export.read_exported(spark, str(out), "q7", "/a").collect()) == [7.0 + 300 * k for k in range(10)]

# ---------------------------------------------------------------- the log


def test_snapshots_of_the_log_replace_its_files(spark, store):
    rows = spark.range(3).select(F.col("id").alias("timestamp_ns"))

    def upload(name):
        with store.begin_upload([name]) as one:
            one.create_topic(name, "/t", "custom")
            one.put_batch(rows)
            one.finalize()

    for i in range(4):
        upload(f"s{i}")
    dropped = store.begin_upload(["gone"])
    dropped.cleanup()
    seen = lambda: (
        sorted(map(str, store.list_sequences().collect())), sorted(map(str, store.list_topics().collect())), store.pull_topic("s1", "/t", 1).count(),
        sorted((r.name, r.state) for r in store.states().collect()), [r.timestamp_ns for r in store.first_rows("s2", "/t", 2).collect()],
    )
    files = lambda log: len(glob.glob(f"{store.root}/log/{log}/*.parquet"))
    before, n = seen(), files("sequences")
    assert n >= 10 and store.compact_log(files=100) == {}
    assert store.compact_log(files=3) == {"sequences": n, "topics": 4, "files": 4}
    assert seen() == before and files("sequences") > n  # what was replaced is there until the retention is over
    assert store.compact_log(files=3) == {} and files("sequences") > n
    store.compact_log(retain_seconds=0, files=3)
    assert files("sequences") < 5 and files("topics") < 4 and seen() == before
    upload("s9")  # a tail behind the snapshot
    assert len(seen()[0]) == 5 and store.pull_topic("s9", "/t").count() == 3
