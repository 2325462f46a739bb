"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from registered.sources import event_store, stored_lines, talk_store  # noqa: E402
from sensorloom.operators import decode, index, infer  # noqa: E402
from sensorloom.operators.ontology import project_json  # noqa: E402
from sensorloom.operators.sequence import number_rows  # noqa: E402
from sensorloom.plans import export, reports  # noqa: E402
from sensorloom.plans.publish import publish
from sensorloom.plans.store import SequenceStore  # noqa: E402
from sensorloom.session import STATIC_CONF, configure, scratch_dir  # noqa: E402
from sensorloom.sources.bridges import event_channels, event_messages  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    builder = SparkSession.builder
    for key, value in STATIC_CONF.items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{CPUS}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    lines = stored_lines(spark, SF_DIR)
    folder = scratch_dir(spark, "bench")
    events_path, channels_path = f"{folder}/events", f"{folder}/channels"
    event_messages(spark, SF_DIR).repartition(int(CPUS)).write.parquet(events_path)
    event_channels(spark, SF_DIR).write.parquet(channels_path)
    events, channels = spark.read.parquet(events_path), spark.read.parquet(channels_path)
    line_channels = lines.select("recording", "channel_id", "topic").distinct().withColumns(
        {"encoding": F.lit("json"), "schema_name": F.lit("geometry_msgs/Twist")}
    ).persist()
    store, *_ = event_store(spark, SF_DIR)
    talks, _ = talk_store(spark, SF_DIR)
    line_store = SequenceStore(spark, f"{folder}/lines")
    line_key, _ = publish(line_store, lines, line_channels)
    published_lines = line_store.read_tag(line_key, "velocity").drop("_reason", "_payload")
    fresh = lambda: SequenceStore(spark, scratch_dir(spark, "bench"))

    cases = {
        "index": lambda: drain(
            reports.recording_report(index.channel_index(line_channels, lines), index.recording_summary_with_size(lines))
        ),
        "decode_variant": lambda: drain(decode.decode_json(lines).select("body", "reject_reason")),
        "decode_velocity": lambda: drain(project_json(lines, "velocity")),
        "decode_velocity_good": lambda: drain(project_json(lines, "velocity").where("reject_reason is null")),
        "topic_velocity": lambda: drain(project_json(index.topic_scan(lines, "/line/3"), "velocity")),
        "infer_and_project": lambda: drain(infer.channel_table(index.topic_scan(events, "/signup"))),
        "imu": lambda: drain(project_json(index.topic_scan(events, "/click"), "imu")),
        "frame_transform": lambda: drain(project_json(index.topic_scan(events, "/purchase"), "frame_transform")),
        "publish_lines": lambda: publish(fresh(), lines, line_channels, by_topic=True),
        "publish_events": lambda: publish(fresh(), events, channels),
        "time_range_pull": lambda: drain(store.pull_topic("events", "/view", 1704412800 * 10**9, 1705708800 * 10**9)),
        "json_sink": lambda: drain(
            export.to_messages(published_lines, F.col("sequence"), F.col("topic"), leave_out=["sequence", "topic"])
        ),
        "range_numbers": lambda: drain(
            number_rows(lines.select("topic", "log_time_ns", "sequence"), ["topic"], ["log_time_ns", "sequence"], "n")
        ),
        "export": lambda: export.export_sequence(store, "events", scratch_dir(spark, "bench")),
        "catalog": lambda: (drain(talks.list_sequences()), drain(reports.sequence_report(talks.list_topics()))),
    }
    only = sys.argv[1:]
    seconds = {}
    for name, run in cases.items():
        if only and name not in only:
            continue
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    # how long plans take to be made, and how fast this machine counts: a figure to compare machines by
    planning = {}
    for name, make in {
        "decode_velocity": lambda: project_json(lines, "velocity"),
        "imu": lambda: project_json(index.topic_scan(events, "/click"), "imu"),
        "frame_transform": lambda: project_json(index.topic_scan(events, "/purchase"), "frame_transform"),
    }.items():
        start = time.perf_counter()
        make()
        planning[name] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    sum(range(20_000_000))
    probe = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": SF_DIR,
                "planning": planning, "probe_sec": probe,
            }
        )
    )


if __name__ == "__main__":
    main()
