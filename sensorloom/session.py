"""Session settings and scratch locations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.caseSensitive": "true",
    # generated methods above this size are not compiled by the JVM; smaller pieces are
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Worth setting when the session is built. Plans here have thousands of expressions, and
# looking up the Python call site of each costs seconds.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators depend on (UTC, exact JSON keys of which the last duplicate wins, AQE)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    A cluster names its shared folder in ``spark.checkpoint.dir``; where that is unset, the warehouse is
    taken, unless it is a folder of the driver's machine that executors on others cannot reach.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        alone = spark.conf.get("spark.master", "").split("[")[0] == "local"
        if not alone and shared.startswith("file:"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{shared.rstrip('/')}/sensorloom-scratch/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds, wherever Spark can reach it. False if there is none."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows read back from a table in the scratch folder: the plan behind them is done once."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
