import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sensorloom.session import STATIC_CONF, configure  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]")
    for key, value in STATIC_CONF.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return configure(session)


@pytest.fixture(scope="session")
def messages(spark):
    """Messages of one topic from payloads (text or bytes); the log time counts seconds from 1."""

    def make(*payloads, topic="/t", recording="r", channel_id=1):
        rows = [
            (recording, channel_id, topic, (i + 1) * 10**9, (i + 1) * 10**9, i, p.encode() if isinstance(p, str) else p)
            for i, p in enumerate(payloads)
        ]
        return spark.createDataFrame(
            rows,
            "recording string, channel_id int, topic string, log_time_ns bigint, publish_time_ns bigint, sequence bigint, payload binary",
        ).orderBy("sequence")

    return make


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate column expressions without a table."""

    def evaluate(*columns):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return evaluate


@pytest.fixture(scope="session")
def lit():
    return F.lit
