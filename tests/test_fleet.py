"""Whole-chain properties."""

import datetime as dt
import shutil
import time

import pytest
from pyspark.sql import functions as F

from stationqc import score_fleet
from stationqc.catalog.view import readings
from stationqc.params import MODELS, VARIABLES
from stationqc.schema import input_schema, output_schema, to_input_schema
from stationqc.sources.telemetry import (
    conflicting_rows,
    one_row_per_second,
    read_table,
    read_telemetry,
    rejected_rows,
    with_qod_date,
    write_scores,
    write_telemetry,
)

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def telemetry(spark):
    """Three stations of the 180-second model, one of them partial."""
    wanted = ["WS2000-1", "WS2000-3", "WS2000-16"]
    return readings(spark, SF, "WS2000").filter(F.col("device_id").isin(wanted)).cache()


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def scored(telemetry):
    return score_fleet(telemetry, models=["WS2000"]).cache()


def test_shape_and_ranges(scored):
    assert [f.name for f in scored.schema] == [f.name for f in output_schema()]
    counts = {r["device_id"]: r["count"] for r in scored.groupBy("device_id").count().collect()}
    assert counts == {"WS2000-1": 24, "WS2000-3": 24, "WS2000-16": 14}
    worst = scored.selectExpr(
        "min(hourly_score) AS lo", "max(hourly_score) AS hi", "min(qod_score) AS qlo", "max(qod_score) AS qhi"
    ).collect()[0]
    assert 0 <= worst["lo"] <= worst["hi"] <= 100 and 0 <= worst["qlo"] <= worst["qhi"] <= 1


def test_a_fleet_scores_like_its_stations_alone(telemetry, scored):
    alone = score_fleet(telemetry.filter("device_id = 'WS2000-3'"), models=["WS2000"])
    assert as_set(alone) == as_set(scored.filter("device_id = 'WS2000-3'"))


def test_order_copies_and_date_filter_change_nothing(telemetry, scored):
    shuffled = telemetry.unionByName(telemetry).unionByName(telemetry).orderBy(F.rand(7))
    assert as_set(score_fleet(shuffled, dates=[dt.date(2024, 1, 1)], models=["WS2000"])) == as_set(scored)


def test_files_round_trip(spark, telemetry, scored, tmp_path):
    stored = telemetry.withColumn("utc_datetime", F.col("utc_datetime").cast("string"))
    stored.write.parquet(str(tmp_path / "in"))
    back = read_telemetry(spark, str(tmp_path / "in"), device_ids=["WS2000-1", "WS2000-16"])
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in input_schema()]
    write_scores(score_fleet(back, models=["WS2000"]), str(tmp_path / "out"))
    stored_scores = spark.read.parquet(str(tmp_path / "out")).select(*scored.columns)
    assert as_set(stored_scores) == as_set(scored.filter("device_id <> 'WS2000-3'"))


def test_station_and_time_filters_reach_the_scan(spark, telemetry, tmp_path):
    telemetry.write.parquet(str(tmp_path / "in"))
    df = read_telemetry(spark, str(tmp_path / "in"), device_ids=["WS2000-1"], dates=[dt.date(2024, 1, 1)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "device_id" in pushed and "utc_datetime" in pushed


def test_late_start_loses_its_first_hour(telemetry):
    """The context is counted from the first bin there is."""
    late = telemetry.filter("device_id = 'WS2000-1' AND utc_datetime >= TIMESTAMP_NTZ '2023-12-31 19:00:00'")
    hours = [r["hour"] for r in score_fleet(late, models=["WS2000"]).orderBy("hour").select("hour").collect()]
    assert hours == list(range(1, 24))


def test_two_exchanges_and_no_python(spark):
    uncached = readings(spark, "/root/testdata/sf0.1", "WS2000")
    plan = score_fleet(uncached, models=["WS2000"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan and "Python" not in plan and "SinglePartition" not in plan


def test_a_station_that_was_offline_is_not_perfect(telemetry):
    """No rows from 03:00 to 21:00: all 24 hours are scored, the missing ones as missing."""
    station = telemetry.filter("device_id = 'WS2000-1'")
    clock = F.hour("utc_datetime") + F.when(F.to_date("utc_datetime") < F.lit("2024-01-01").cast("date"), -24).otherwise(0)
    holes = station.filter(~clock.between(3, 20))
    got = score_fleet(holes, models=["WS2000"]).select("hour", "hourly_score", "qod_score").collect()
    whole = {r["hour"]: r["hourly_score"] for r in score_fleet(station, models=["WS2000"]).collect()}
    assert sorted(r["hour"] for r in got) == list(range(24))
    assert all(r["hourly_score"] == 0 for r in got if 4 <= r["hour"] <= 20)
    assert all(r["hourly_score"] <= whole[r["hour"]] for r in got) and {r["qod_score"] < 0.3 for r in got} == {True}


def test_rows_that_are_left_out_score_like_empty_ones(telemetry, scored):
    sent = telemetry.na.drop(subset=["temperature", "humidity"])
    assert sent.count() < telemetry.count()
    assert as_set(score_fleet(sent, models=["WS2000"])) == as_set(scored)


def test_no_reading_is_lost_to_an_empty_row_or_a_fraction(telemetry, scored):
    """Beside each row one with less in it, and one later in its second; in any order."""
    torn = telemetry.withColumn("humidity", F.lit(None).cast("double"))
    later = telemetry.withColumn("utc_datetime", F.col("utc_datetime") + F.expr("INTERVAL '0.9' SECOND")).withColumn("pressure", F.lit(1.0))
    rows = telemetry.unionByName(torn).unionByName(later).orderBy(F.rand(3))
    complete = telemetry.na.drop(subset=["temperature", "humidity"]).select("device_id", "utc_datetime")
    rows = rows.withColumn("_second", F.date_trunc("second", F.col("utc_datetime").cast("timestamp_ntz")).cast("timestamp_ntz"))
    rows = rows.join(complete.withColumnRenamed("utc_datetime", "_second"), ["device_id", "_second"], "left_semi").select(*telemetry.columns)
    assert as_set(score_fleet(rows, models=["WS2000"])) == as_set(scored)


def test_settings_of_the_user_stay(spark):
    from stationqc.session import configure

    was = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "77m")
        assert configure(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "77m"
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", was)


def test_day_files_of_different_types_and_text_times(spark, telemetry, tmp_path):
    midnight = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"
    text = telemetry.filter(f"utc_datetime < {midnight}").withColumn("utc_datetime", F.col("utc_datetime").cast("string"))
    text.withColumn("temperature", F.col("temperature").cast("string")).write.parquet(str(tmp_path / "a"))
    telemetry.filter(f"utc_datetime >= {midnight}").write.parquet(str(tmp_path / "b"))
    df = read_telemetry(spark, [str(tmp_path / "a"), str(tmp_path / "b")], dates=[dt.date(2024, 1, 1)])
    assert as_set(df) == as_set(telemetry.select(*df.columns))
    plan = read_telemetry(spark, str(tmp_path / "a"), dates=[dt.date(2024, 1, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "utc_datetime,2023-12-31" in plan.split("PushedFilters:")[1].split("ReadSchema")[0]


def test_a_day_that_is_only_context_is_not_made(telemetry):
    late = telemetry.filter("device_id = 'WS2000-1'")
    assert late.agg(F.max(F.hour("utc_datetime"))).first()[0] == 23
    days = {str(r["qod_date"]) for r in score_fleet(late, models=["WS2000"], regrid=True).select("qod_date").distinct().collect()}
    assert days == {"2023-12-31", "2024-01-01"}


def test_files_of_a_day_follow_its_size(scored, tmp_path):
    days = scored.withColumn("qod_date", F.explode(F.sequence(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 5))))).repartition(8)
    write_scores(days, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("qod_date=*/*.parquet"))) == 5


def test_evening_rows_serve_two_days_and_fractions_after_midnight_none(spark):
    times = ["2024-01-01 17:59:59", "2024-01-01 18:00:00", "2024-01-01 23:59:59", "2024-01-01 23:59:59.5"]
    df = spark.createDataFrame([(t,) for t in times], "t string").selectExpr("CAST(t AS TIMESTAMP_NTZ) AS utc_datetime")
    got = sorted((str(r["utc_datetime"]), r["qod_date"].day) for r in with_qod_date(df).collect())
    assert got == [
        ("2024-01-01 17:59:59", 1),
        ("2024-01-01 18:00:00", 1),
        ("2024-01-01 18:00:00", 2),
        ("2024-01-01 23:59:59", 1),
        ("2024-01-01 23:59:59", 2),
        ("2024-01-01 23:59:59.500000", 2),
    ]


def test_rejects_and_conflicts_are_reported(telemetry):
    first = telemetry.limit(1)
    other = first.withColumn("temperature", F.lit(1.0))
    unknown = first.withColumn("model", F.lit("WS9"))
    rows = telemetry.unionByName(first).unionByName(other).unionByName(unknown)
    assert rejected_rows(rows).count() == 1
    assert [r["variants"] for r in conflicting_rows(rows.filter(F.col("model").isin(*MODELS))).collect()] == [2]
    known = with_qod_date(rows.filter(F.col("model").isin(*MODELS)))
    assert one_row_per_second(known).count() == with_qod_date(telemetry).count()


def test_many_rows_of_one_second_combine_before_they_are_moved(spark):
    """A million different rows in one second, among others: each map task hands on one, and the fullest and smallest stays."""
    values = [f"CAST(id % 1000 AS DOUBLE) + {k} AS {p}" for k, p in enumerate(p for p in VARIABLES if p != "temperature")]
    same = "TIMESTAMP_NTZ '2024-01-01 12:00:00'"
    crowd = spark.range(1_000_000).selectExpr("'d' AS device_id", "if(id = 77, CAST(id AS DOUBLE), NULL) AS temperature", *values, "'WS2000' AS model", f"{same} AS utc_datetime")
    other = spark.range(5).selectExpr("'d' AS device_id", "1D AS temperature", *values, "'WS2000' AS model", f"{same} + make_interval(0, 0, 0, 0, 0, 3 * (CAST(id AS INT) + 1)) AS utc_datetime")
    chosen = one_row_per_second(with_qod_date(crowd.unionByName(other)))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("functions=[min(") < plan.index("Exchange") < plan.index("partial_min(") and "Window" not in plan
    rows = chosen.orderBy("utc_datetime").collect()
    assert len(rows) == 6 and rows[0]["temperature"] == 77
    scored = score_fleet(crowd.unionByName(other), models=["WS2000"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.rindex("Window") < plan.rindex("Exchange hashpartitioning")


def test_years_of_day_files_are_a_scan_for_each_set_of_types(spark, telemetry, tmp_path):
    text = telemetry.withColumn("utc_datetime", F.col("utc_datetime").cast("string"))
    (text.coalesce(1).write.parquet(str(tmp_path / "text")), telemetry.coalesce(1).write.parquet(str(tmp_path / "time")))
    paths = []
    for k in range(40):
        paths.append(str(tmp_path / f"day{k}"))
        shutil.copytree(tmp_path / ("text" if k % 2 else "time"), paths[-1])
    df = read_telemetry(spark, paths)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert df.count() == 40 * telemetry.count() and df.distinct().count() == telemetry.count()
    alike = read_telemetry(spark, paths[::2])
    assert alike._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert alike.count() == 20 * telemetry.count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_telemetry(spark, [*paths, str(tmp_path / "nowhere")])


def test_many_stations_are_a_table_and_still_prune_the_scan(spark, telemetry, tmp_path):
    telemetry.write.parquet(str(tmp_path / "in"))
    names = ["WS2000-1", "WS2000-16", *[f"WS2000-1/{k}" for k in range(100_000)]]
    began = time.perf_counter()
    df = read_telemetry(spark, str(tmp_path / "in"), device_ids=names)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - began < 20 and len(plan) < 20_000
    assert "device_id" in plan.split("PushedFilters:")[1].split("ReadSchema")[0] and "LeftSemi" in plan
    few = as_set(telemetry.filter("device_id in ('WS2000-1', 'WS2000-16')").select(*df.columns))
    assert as_set(df) == few
    table = spark.createDataFrame([("WS2000-1",), ("WS2000-16",), ("WS2000-16",), ("none",)], "device_id string")
    assert as_set(read_telemetry(spark, str(tmp_path / "in"), device_ids=table)) == few


def test_a_bucketed_table_is_scored_without_an_exchange(spark, telemetry, scored, tmp_path):
    other = telemetry.withColumn("model", F.lit("WS1000")).limit(50)
    write_telemetry(telemetry.unionByName(other), "telemetry_in_buckets", 4, str(tmp_path / "table"))
    try:
        table = read_table(spark, "telemetry_in_buckets")
        assert as_set(table) == as_set(telemetry.unionByName(other).select(*table.columns))
        both = score_fleet(table)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in both and both.count("FileScan parquet") == 2 and both.count("Bucketed: true") == 2
        assert {p.split("]")[0].count("model") > 0 for p in both.split("PartitionFilters: [")[1:]} == {True}
        assert as_set(score_fleet(table, models=["WS2000"])) == as_set(scored)
        one = score_fleet(read_table(spark, "telemetry_in_buckets", ["WS2000-3"], [dt.date(2024, 1, 1)]), models=["WS2000"])
        assert as_set(one) == as_set(scored.filter("device_id = 'WS2000-3'"))
    finally:
        spark.sql("DROP TABLE telemetry_in_buckets")


def test_buckets_grow_with_the_readings(spark, telemetry, scored, monkeypatch, tmp_path):
    from stationqc.sources import telemetry as source

    monkeypatch.setattr(source, "BUCKET_ROWS", 50)
    rows = telemetry.count()
    write_telemetry(telemetry, "telemetry_by_size", path=str(tmp_path / "table"))
    try:
        described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE FORMATTED telemetry_by_size").collect()}
        assert int(described["Num Buckets"]) == -(-rows // 50) > source.LEAST_BUCKETS
        assert as_set(score_fleet(read_table(spark, "telemetry_by_size"), models=["WS2000"])) == as_set(scored)
    finally:
        spark.sql("DROP TABLE telemetry_by_size")


def test_not_a_number_is_missing(spark):
    df = spark.range(1).selectExpr(
        "'d' AS device_id", "'WS2000' AS model", "'2024-01-01 00:00:00' AS utc_datetime",
        "CAST('NaN' AS DOUBLE) AS temperature", *[f"'1.5' AS {p}" for p in (
            "humidity", "wind_speed", "wind_direction", "pressure", "illuminance", "precipitation_accumulated")],
    )
    row = to_input_schema(df).collect()[0]
    assert row["temperature"] is None and row["humidity"] == 1.5


def test_a_cluster_is_not_given_a_local_folder(spark, monkeypatch):
    from stationqc import session

    assert session.shared_folder(spark)
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(spark)
