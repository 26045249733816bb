"""Session settings the engine is meant to run with, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# A 30-hour station-day of the 16-second model has 6,750 slots; the default window buffer spills at 4,096.
# A reading shuffles to tens of bytes but takes tens of microseconds of window work, so reduce tasks are sized far below the
# defaults: 4 MB are some 150,000 slots. Far smaller ones cost more to start, with some 20 operators to generate and to give pages
# to, than they take to run. ``spark.sql.shuffle.partitions`` stays the cluster's choice and the upper bound of their number.
#
# The widest projections and the wide bin aggregate make methods the JVM refuses to compile beyond 8,000 bytes of bytecode;
# Spark is told to notice and use its split, compilable form instead.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.codegen.aggregate.splitAggregateFunc.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.windowExec.buffer.in.memory.threshold": "16384",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the user has not set."""
    already = spark.conf.getAll
    for key, value in SETTINGS.items():
        if key not in already:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share; of its own only on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="stationqc-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
