from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import geometry as G
from sensorloom.functions import metadata as M
from sensorloom.functions import text as X
from sensorloom.operators.index import percent_done


@pytest.mark.parametrize(
    "seconds, text", [(8072, "2h 14m 32s"), (300, "5m 0s"), (45, "45s"), (0, "0s"), (3600, "1h 0m 0s"), (45.999, "45s")]
)
def test_duration(value, seconds, text):
    assert value(X.format_duration(F.lit(int(seconds * 10**9)))) == text


@pytest.mark.parametrize(
    "size, text",
    [(0, "0 B"), (999, "999 B"), (1000, "1.0 KB"), (1500, "1.5 KB"), (10**6, "1.0 MB"), (148_300_000, "148.3 MB"),
     (2_500_000_000, "2.5 GB"), (999_999, "1000.0 KB")],
)
def test_file_size(value, size, text):
    assert value(X.format_file_size(F.lit(size))) == text


def test_file_size_rounds_like_the_double(spark):
    sizes = [*range(1000, 4000), *range(1_000_000, 3_000_000, 50_000), *range(10**9, 3 * 10**9, 50_000_000), 12_345_650, 987_650_000_000]
    rows = spark.createDataFrame([(s,) for s in sizes], "s bigint").select("s", X.format_file_size(F.col("s")).alias("t")).collect()
    for row in rows:
        unit = 1e9 if row.s >= 10**9 else 1e6 if row.s >= 10**6 else 1e3
        assert row.t.split()[0] == f"{row.s / unit:.1f}", Fraction(row.s / unit)


def test_timestamp_utc(value):
    assert value(X.format_timestamp_utc(F.lit(1_710_000_000 * 10**9))) == "2024-03-09T16:00:00Z"


@pytest.mark.parametrize("topic, name", [("/a/b", "a_b"), ("a/b", "a_b"), ("//a", "_a"), ("", ""), ("/", "")])
def test_sanitize(value, topic, name):
    assert value(X.sanitize_name(F.lit(topic))) == name


@pytest.mark.parametrize(
    "resource, topic", [("s/imu", "/imu"), ("s/a/b", "/a/b"), ("sXimu", "/imu"), ("other/imu", "other/imu"), ("s", "s")]
)
def test_topic_of_resource(value, resource, topic):
    assert value(X.topic_of_resource(F.lit(resource), F.lit("s"))) == topic


def test_pack(value):
    assert value(X.pack_resource(F.lit("//s"), F.lit("/a/b"))) == "s/a/b"


@pytest.mark.parametrize(
    "text, base, size",
    [("float64", "float64", 0), ("float64[9]", "float64", 9), ("uint8[]", "uint8", -1), ("float64[3", "float64[3", 0), ("a/B[2]x", "a/B", 2)],
)
def test_parse_type(value, text, base, size):
    assert value(X.array_base(F.lit(text)), X.array_size(F.lit(text))) == (base, size)


@pytest.mark.parametrize(
    "values, valid",
    [([0.0] * 9, False), ([-1.0] + [0.0] * 8, False), ([0.01, 0, 0, 0, 0.01, 0, 0, 0, 0.01], True), ([], False), (None, False), ([0.0, -5.0], True)],
)
def test_covariance(value, values, valid):
    column = F.lit(None).cast("array<double>") if values is None else F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")
    assert value(G.valid_covariance(column)) is valid


class Given:
    """Fields with fixed values."""

    def __init__(self, log_time=None, **values):
        self.log_time = F.lit(log_time).cast("bigint")
        self.values = {k.replace("__", "."): v for k, v in values.items()}
        self.checks = []

    def has(self, path):
        return F.lit(path in self.values)

    def integer(self, path, kind):
        return F.lit(self.values.get(path)).cast("bigint")

    def text(self, path):
        return F.lit(self.values.get(path)).cast("string")


LOG = 1_710_000_000 * 10**9


@pytest.mark.parametrize(
    "fields, event, ingest",
    [
        (dict(log_time=LOG, header__stamp__sec=1_710_000_000, header__stamp__nanosec=500_000_000), LOG + 500_000_000, LOG),
        (dict(log_time=LOG), LOG, LOG),
        (dict(log_time=LOG, header__stamp__sec=5), LOG, LOG),
        (dict(), 0, 0),
    ],
)
def test_times(value, fields, event, ingest):
    given = Given(**fields)
    assert value(G.event_time(given), G.ingest_time(given)) == (event, ingest)


def test_header_cases(value):
    full = value(G.header(Given(log_time=LOG, header__seq=3, header__stamp__sec=7, header__frame_id="m")))
    assert (full.seq, full.stamp.sec, full.stamp.nanosec, full.frame_id) == (3, 7, None, "m")
    only_frame = value(G.header(Given(log_time=LOG, header__frame_id="m")))
    assert only_frame.stamp is None and only_frame.frame_id == "m"
    logged = value(G.header(Given(log_time=LOG + 5)))
    assert (logged.seq, logged.stamp.sec, logged.stamp.nanosec, logged.frame_id) == (None, 1_710_000_000, 5, None)
    assert value(G.header(Given())) is None


def test_metadata(value):
    assert value(M.ontology_tag(F.lit('{"ontology_tag":"imu"}'))) == "imu"
    for text in ('{"other":1}', '{"ontology_tag":5}', "not json", None):
        assert value(M.ontology_tag(F.lit(text).cast("string"))) is None
    assert value(M.user_metadata(F.lit('{"vehicle":"nissan","location":"zala","ros:x":"y","n":null,"o":{"a":1}}'))) == {
        "vehicle": "nissan", "location": "zala", "n": "null", "o": '{"a":1}',
    }
    for text in ("[1,2]", '{"a":1, bad', None):
        assert value(M.user_metadata(F.lit(text).cast("string"))) == {}
    assert tuple(value(M.endpoint_range(F.lit('{"timestamp":{"min":1,"max":2}}')))) == (1, 2)
    for text in ('{"timestamp":{"min":1}}', "{}", "", "x"):
        assert value(M.endpoint_range(F.lit(text))) is None


def test_percent(value):
    done = lambda a, b: value(percent_done(F.lit(float(a)), F.lit(float(b))))
    assert [done(0, 10), done(5, 10), done(20, 10), done(1, 0), done(1, 3)] == [0, 50, 100, 0, 33]
