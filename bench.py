"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
LARGE = int(os.environ.get("BENCH_SLOTS", "2000000"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("stationqc-bench")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from stationqc import score_fleet
    from stationqc.catalog.queries import QUERIES
    from stationqc.catalog.view import SLOTS, readings
    from stationqc.session import configure

    spark = configure(session())
    headline = {
        "quality_scores_ws2000": lambda: score_fleet(readings(spark, SF_DIR, "WS2000"), models=["WS2000"]),
        "quality_scores_ws1000": lambda: score_fleet(readings(spark, SF_DIR, "WS1000"), models=["WS1000"]),
    } | {
        name: (lambda q=QUERIES[name]: q(spark, SF_DIR))
        for name in ("fill_gaps", "obc_precip", "constancy", "invalid_repeat", "bin_jumps", "hourly_json", "resample_grid")
    }
    # Warm-up: JVM and file metadata, on a query that is not timed.
    QUERIES["consec_filling"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, build in headline.items():
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    slots = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    # Runs in which data, not planning, takes the time: the view again and again, under new station names.
    copies = max(1, -(-LARGE // slots))
    again = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    large = {}
    for model in SLOTS:
        rows = readings(spark, SF_DIR, model).withColumn("_copy", again).withColumn("device_id", F.concat("device_id", F.lit("-"), "_copy")).drop("_copy")
        start = time.perf_counter()
        score_fleet(rows, models=[model]).write.format("noop").mode("overwrite").save()
        sec = time.perf_counter() - start
        times[f"quality_scores_{model.lower()}_large"] = round(sec, 3)
        large[model] = {"slots": slots * copies, "slots_per_sec_per_core": round(slots * copies / sec / int(CPUS))}
    rates = {}
    for model in SLOTS:
        sec = times[f"quality_scores_{model.lower()}"]
        rates[model] = {
            "slots_per_sec": round(slots / sec),
            "station_days_per_sec": round(slots / SLOTS[model] / sec, 2),
        }
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries, plan building included",
                "value": round(sum(times[name] for name in headline), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "large": large,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
