"""One query per operator, over telemetry derived from the whole ``events`` table, both station models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc import score_fleet
from stationqc.catalog.view import readings, telemetry
from stationqc.functions.columns import extend, json_pairs, timestamp_of, wind_u, wind_v
from stationqc.functions.windows import Timeline
from stationqc.operators import annotate, bins, bounds, constancy, fill, grid, hours, jumps, reports, scores
from stationqc.params import JUMPING, MODELS, RAIN, STICKING, STUCK_WINDOWS, VARIABLES, WIND, ModelParams, params_df
from stationqc.plans.hours import aggregated_bins, scored_hours, scoring_means
from stationqc.plans.slots import bounded_slots, checked_slots, filled_slots
from stationqc.schema import to_input_schema, to_output_schema
from stationqc.session import shared_folder
from stationqc.sources.telemetry import (
    dedup_rows,
    read_table,
    read_telemetry,
    union_days,
    with_qod_date,
    write_scores,
    write_telemetry,
)

Query = Callable[[SparkSession, str], DataFrame]
SLOT = ("device_id", "sec")
BIN = ("device_id", "parameter", "bin")
HOUR = ("device_id", "parameter", "hour_sec")
SCALARS = tuple(p for p in VARIABLES if p not in (*WIND, RAIN))


def both_models(build: Callable[[DataFrame, ModelParams], DataFrame], models: Sequence[str] = tuple(MODELS)) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        first, *rest = [build(telemetry(spark, sf_dir, m), MODELS[m]) for m in models]
        for df in rest:
            first = first.unionByName(df)
        return first

    return query


def two_level(build: Callable[[DataFrame, ModelParams], DataFrame]) -> Query:
    return both_models(build, ["WS1000"])


def all_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_days(*[readings(spark, sf_dir, m) for m in MODELS])


def rounded(columns: Sequence[str], digits: int = 6) -> list[str]:
    return [f"round({c}, {digits}) AS {c}" for c in columns]


def suffixed(columns: Sequence[str], *suffixes: str) -> list[str]:
    return [f"{p}__{s}" for p in columns for s in suffixes]


# ---- sources -----------------------------------------------------------------------------------


def scan_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    stored = all_readings(spark, sf_dir).withColumn("utc_datetime", F.col("utc_datetime").cast("string"))
    stored.write.parquet(path)
    return read_telemetry(spark, path)


def union_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = all_readings(spark, sf_dir)
    midnight = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    return union_days(df.filter(F.col("utc_datetime") < midnight), df.filter(F.col("utc_datetime") >= midnight))


def cast_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = all_readings(spark, sf_dir)
    return to_input_schema(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = all_readings(spark, sf_dir)
    return dedup_rows(union_days(df, df, df))


def qod_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_qod_date(all_readings(spark, sf_dir)).select("device_id", "qod_date", "utc_datetime")


def model_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = all_readings(spark, sf_dir).groupBy("device_id", "model").agg(F.count(F.lit(1)).alias("slots"))
    return stations.join(F.broadcast(params_df(spark)), "model")


def written_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_scores(score_fleet(all_readings(spark, sf_dir)), path)
    return final_rows(spark.read.parquet(path))


def bucketed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from a bucketed table of both models' readings."""
    path = shared_folder(spark)
    table = f"telemetry_{path.rsplit('/', 1)[1]}"
    write_telemetry(all_readings(spark, sf_dir), table, path=path)
    return final_rows(score_fleet(read_table(spark, table)))


def unsent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores where stations leave out a row instead of sending an incomplete one, with two readings of other rows beside each in its second."""
    sent = all_readings(spark, sf_dir).na.drop(subset=list(VARIABLES))
    torn = [F.lit(None).cast("double").alias(p) if p == "humidity" else F.col(p) for p in VARIABLES]
    later = (F.col("utc_datetime") + F.expr("INTERVAL '0.25' SECOND")).alias("utc_datetime")
    others = [sent.select("device_id", *torn, "model", "utc_datetime"), sent.select("device_id", *VARIABLES, "model", later)]
    return final_rows(score_fleet(union_days(sent, *others)))


def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type as a sensor with irregular readings, onto the 180-second grid."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sensors = events.selectExpr("event_type AS device_id", "'WS2000' AS model", "ts AS utc_datetime", "value")
    full = grid.resample_grid(sensors, MODELS["WS2000"], ["value"])
    return full.select("device_id", "qod_date", "utc_datetime", "value")


# ---- slots -------------------------------------------------------------------------------------


def n1(df: DataFrame, params: ModelParams) -> DataFrame:
    return fill.null_incomplete_rows(df).select(*SLOT, *VARIABLES)


def gaps(df: DataFrame, params: ModelParams) -> DataFrame:
    return filled_slots(df, params).select(*SLOT, *suffixed(VARIABLES, "filled"))


def filling(df: DataFrame, params: ModelParams) -> DataFrame:
    return fill.consec_filling(filled_slots(df, params)).select(*SLOT, "fill_count")


def obc(df: DataFrame, params: ModelParams) -> DataFrame:
    return bounds.obc_bounds(fill.null_incomplete_rows(df), params).select(*SLOT, *suffixed(STICKING, "obc"))


def rain_diff(df: DataFrame, params: ModelParams) -> DataFrame:
    return bounds.precip_diff(filled_slots(df, params)).selectExpr(*SLOT, *rounded(["precip_diff"]))


def rain_obc(df: DataFrame, params: ModelParams) -> DataFrame:
    return bounded_slots(df, params).select(*SLOT, f"{RAIN}__obc")


def window_rows(df: DataFrame, params: ModelParams) -> DataFrame:
    rows = constancy.const_window_rows(filled_slots(df, params))
    return rows.select("device_id", *[f"rows_{m}" for m in STUCK_WINDOWS]).distinct()


def non_null(df: DataFrame, params: ModelParams) -> DataFrame:
    return constancy.rolling_non_null(filled_slots(df, params)).select(*SLOT, *[f"count_{m}" for m in STUCK_WINDOWS])


def constant(df: DataFrame, params: ModelParams) -> DataFrame:
    columns = suffixed(STICKING, "constant") + suffixed(constancy.LONG_CHECKED, "constant_day")
    return constancy.rolling_is_constant(filled_slots(df, params), params).select(*SLOT, *columns)


def medians(df: DataFrame, params: ModelParams) -> DataFrame:
    names = [f"{x.name}__median" for x in constancy.MEDIAN_TESTS]
    rows = constancy.median_conditions(constancy.rolling_median(filled_slots(df, params)))
    return rows.selectExpr(*SLOT, *rounded(names), *[x.name for x in constancy.MEDIAN_TESTS])


def guards(df: DataFrame, params: ModelParams) -> DataFrame:
    return filled_slots(df, params).selectExpr(*SLOT, *[f"{constancy.guard(m)} AS guard_{m}" for m in STUCK_WINDOWS])


HIT = "pressure__filled = 1025"
RESULT = "CASE WHEN temperature__filled = 75 THEN 5 WHEN pressure__filled = 1025 THEN 0 WHEN wind_speed__filled = 60 THEN 6 END"


def backprop_any(df: DataFrame, params: ModelParams) -> DataFrame:
    marked = {"marked": constancy.any_hit(HIT, 7200, Timeline())}
    return extend(filled_slots(df, params), marked).select(*SLOT, "marked")


def backprop_latest(df: DataFrame, params: ModelParams) -> DataFrame:
    df = extend(filled_slots(df, params), {"_latest": constancy.latest_result(RESULT, 7200, Timeline())})
    return extend(df, {"marked": constancy.if_ahead("_latest")}).select(*SLOT, "marked")


def stuck(*columns: str) -> Query:
    """Flags of single checks, before the wind coupling."""

    def build(df: DataFrame, params: ModelParams) -> DataFrame:
        df = constancy.stuck_verdicts(filled_slots(df, params), params)
        return constancy.mark_windows(df, params).select(*SLOT, *columns)

    return both_models(build)


def coupling(df: DataFrame, params: ModelParams) -> DataFrame:
    df = constancy.mark_windows(constancy.stuck_verdicts(filled_slots(df, params), params), params)
    return constancy.wind_coupling(df).select(*SLOT, *suffixed(WIND, *constancy.KINDS))


def all_constancy(df: DataFrame, params: ModelParams) -> DataFrame:
    columns = suffixed(STICKING, *constancy.KINDS)
    return constancy.constancy(filled_slots(df, params), params).select(*SLOT, *columns)


def rain_constancy(df: DataFrame, params: ModelParams) -> DataFrame:
    return constancy.precip_no_constancy(filled_slots(df, params)).select(*SLOT, *suffixed([RAIN], *constancy.KINDS))


def raw(*suffixes: str, columns: Sequence[str] = JUMPING, real: bool = False) -> Query:
    def build(df: DataFrame, params: ModelParams) -> DataFrame:
        names = suffixed(columns, *suffixes)
        return jumps.raw_jumps(filled_slots(df, params), params).selectExpr(*SLOT, *(rounded(names) if real else names))

    return both_models(build)


def first_blame(df: DataFrame, params: ModelParams) -> DataFrame:
    """Blame before repeats are looked at."""
    rules = jumps.raw_rules(params)
    df = jumps.search_steps(filled_slots(df, params), rules, params.median_minutes * 60, Timeline())
    return df.selectExpr(*SLOT, *[f"if({jumps.blamed(r)}, 4, 0) AS {r.name}__blamed" for r in rules])


def no_jumps(df: DataFrame, params: ModelParams) -> DataFrame:
    names = suffixed(["wind_direction", RAIN], "median", "diff", "median_diff", "couple", "invalid", "unidentified")
    return jumps.jump_not_applicable(df).select(*SLOT, *names)


def missing(df: DataFrame, params: ModelParams) -> DataFrame:
    return jumps.no_datum(fill.null_incomplete_rows(df)).select(*SLOT, *suffixed(VARIABLES, "no_datum"))


def slot_columns(*suffixes: str) -> Query:
    return both_models(lambda df, params: checked_slots(df, params).select(*SLOT, *suffixed(VARIABLES, *suffixes)))


def packages(df: DataFrame, params: ModelParams) -> DataFrame:
    return reports.packages_per_hour(filled_slots(df, params), params).select("device_id", "hour", "packages")


def minutes(df: DataFrame, params: ModelParams) -> DataFrame:
    means = [p for p in VARIABLES if p != RAIN] + ["irradiance"]
    return reports.minute_report(filled_slots(df, params), params).selectExpr("device_id", "minute", *rounded(means))


def audit(df: DataFrame, params: ModelParams) -> DataFrame:
    rows = reports.select_raw_columns(checked_slots(df, params, audit=True)).drop("qod_date")
    reals = ("rolling_median", "consec_obs_diff_abs", "median_diff_abs")
    return rows.selectExpr(*[c for c in rows.columns if c not in reals], *rounded(reals))


# ---- bins --------------------------------------------------------------------------------------


def binned(df: DataFrame, params: ModelParams, texts: bool = False) -> DataFrame:
    return bins.bin_readings(checked_slots(df, params), params, texts=texts)


def time_bins(df: DataFrame, params: ModelParams) -> DataFrame:
    """The bin of every slot, for the scalar and the wind period."""
    names = {p: f"sec - sec % {params.of(p).bin_minutes * 60} AS {p}_bin" for p in VARIABLES}
    return df.selectExpr(*SLOT, *names.values())


def counts(df: DataFrame, params: ModelParams) -> DataFrame:
    rows = binned(df, params).withColumn("num_nan_values", F.expr("num_total_slots - num_time_slots"))
    rows = rows.withColumn("faulty_rewards", F.col("num_faulty"))
    return rows.select(*BIN, "num_time_slots", "num_nan_values", "num_total_slots", "num_faulty", "faulty_rewards")


def means(columns: Sequence[str], parameters: Sequence[str]) -> Query:
    def build(df: DataFrame, params: ModelParams) -> DataFrame:
        rows = bins.bin_means(binned(df, params), params)
        return rows.filter(F.col("parameter").isin(*parameters)).selectExpr(*BIN, *columns)

    return both_models(build)


def uv(df: DataFrame, params: ModelParams) -> DataFrame:
    df = extend(fill.null_incomplete_rows(df), {"u": wind_u(*WIND), "v": wind_v(*WIND)})
    return df.selectExpr(*SLOT, *rounded(["u", "v"]))


def bin_texts(df: DataFrame, params: ModelParams) -> DataFrame:
    return binned(df, params, texts=True).select(*BIN, "annotation")


def jumps_of_bins(df: DataFrame, params: ModelParams) -> DataFrame:
    names = [f"jump__{c}" for c in ("median", "diff", "median_diff", "couple", "invalid", "unidentified")]
    return bins.bin_jumps(bins.bin_means(binned(df, params), params), params).select(*BIN, *names)


def full_bins(*columns: str, texts: bool = False, trim: bool = False) -> Query:
    def build(df: DataFrame, params: ModelParams) -> DataFrame:
        rows = aggregated_bins(checked_slots(df, params), params, texts=texts, means=scoring_means(params))
        return (bins.warmup_trim(rows, params) if trim else rows).select(*BIN, *columns)

    return both_models(build)


# ---- hours and days ----------------------------------------------------------------------------


def hour_columns(*columns: str, parameters: Sequence[str] = VARIABLES, texts: bool = False) -> Query:
    def build(df: DataFrame, params: ModelParams) -> DataFrame:
        rows = scored_hours(checked_slots(df, params), params, texts=texts)
        return rows.filter(F.col("parameter").isin(*parameters)).selectExpr(*HOUR, *columns)

    return two_level(build)


def hour_path(df: DataFrame, params: ModelParams) -> DataFrame:
    return scored_hours(checked_slots(df, params), params).selectExpr(
        *HOUR, "round(avg, 6) AS avg", "valid_percentage", "valid_percentage_rewards"
    )


def code_rows(codes: Callable[[], str]) -> Query:
    def build(df: DataFrame, params: ModelParams) -> DataFrame:
        counted = hours.hour_counts(aggregated_bins(checked_slots(df, params), params, means=scoring_means(params)), params)
        return counted.filter(hours.in_last_day()).selectExpr(*HOUR, f"inline({codes()})")

    return both_models(build)


def spine(df: DataFrame, params: ModelParams) -> DataFrame:
    return hours.hourly_spine(hours.hour_counts(aggregated_bins(checked_slots(df, params), params, means=scoring_means(params)), params))


def spine_sizes(df: DataFrame, params: ModelParams) -> DataFrame:
    return spine(df, params).selectExpr(
        *HOUR, "size(codes) AS codes", "array_join(transform(codes, x -> x.code), ',') AS names"
    )


def spine_json(df: DataFrame, params: ModelParams) -> DataFrame:
    return spine(df, params).selectExpr(*HOUR, f"{json_pairs('codes')} AS annotation")


def pivoted(df: DataFrame, params: ModelParams) -> DataFrame:
    return scores.hour_pivot(scored_hours(checked_slots(df, params), params, means=scoring_means(params)))


def pivot(df: DataFrame, params: ModelParams) -> DataFrame:
    texts = [f"{json_pairs(f'{p}_codes')} AS {p}_annotation" for p in VARIABLES]
    return pivoted(df, params).selectExpr("device_id", "hour_sec", *[f"{p}_score" for p in VARIABLES], *texts)


def hourly(df: DataFrame, params: ModelParams) -> DataFrame:
    return pivoted(df, params).selectExpr("device_id", "hour_sec", f"round({scores.hourly_score()}, 6) AS hourly_score")


def day_scores(df: DataFrame, params: ModelParams) -> DataFrame:
    days = scores.gather_hours(pivoted(df, params))
    return days.selectExpr("device_id", f"round({scores.qod_score('hours')}, 6) AS qod_score")


def daily_texts(*columns: str) -> Query:
    def build(df: DataFrame, params: ModelParams) -> DataFrame:
        days = extend(scores.gather_hours(pivoted(df, params)), {"hours": scores.first_24("hours")})
        return scores.daily_annotations(days).select("device_id", *columns)

    return both_models(build)


def calendar(df: DataFrame, params: ModelParams) -> DataFrame:
    rows = extend(df, scores.calendar_fields("sec"))
    return rows.select(*SLOT, "year", "month", "day", "hour")


def first_hours(df: DataFrame, params: ModelParams) -> DataFrame:
    """The first 24 of all 30 hours the slots of a series span."""
    wide = df.selectExpr("device_id", "qod_date", "sec - sec % 3600 AS hour_sec").distinct()
    days = wide.groupBy("device_id", "qod_date").agg(F.array_sort(F.collect_list("hour_sec")).alias("hours"))
    return days.selectExpr("device_id", f"explode({scores.first_24('hours')}) AS hour_sec")


def final_rows(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("qod_score", "hourly_score")})


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain, from readings to scored days."""
    return final_rows(score_fleet(all_readings(spark, sf_dir)))


def output_rows(df: DataFrame, params: ModelParams) -> DataFrame:
    return final_rows(to_output_schema(scores.final_shape(scores.daily_rows(pivoted(df, params)))))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_telemetry": scan_telemetry,
    "union_days": union_two_days,
    "cast_input": cast_input,
    "dedup_rows": dedup,
    "qod_window": qod_window,
    "model_params": model_params,
    "write_scores": written_scores,
    "unsent_rows": unsent_rows,
    "bucketed_scores": bucketed_scores,
    "output_schema": both_models(output_rows),
    "select_raw_columns": both_models(audit),
    # normalisation and gap filling
    "null_incomplete_rows": both_models(n1),
    "resample_grid": resample,
    "fill_gaps": both_models(gaps),
    "consec_filling": both_models(filling),
    # out of bounds
    "obc_bounds": both_models(obc),
    "precip_diff": both_models(rain_diff),
    "obc_precip": both_models(rain_obc),
    # stuck sensors
    "const_window_rows": both_models(window_rows),
    "rolling_non_null": both_models(non_null),
    "rolling_is_constant": both_models(constant),
    "rolling_median": both_models(medians),
    "const_guard": both_models(guards),
    "backprop_any": both_models(backprop_any),
    "backprop_latest": both_models(backprop_latest),
    "const_humidity_temperature": stuck("humidity__const", "temperature__const"),
    "const_wind_direction": stuck("wind_direction__const", "wind_direction__frozen"),
    "const_wind_speed": stuck("wind_speed__const", "wind_speed__frozen"),
    "const_illuminance": stuck("illuminance__const"),
    "const_pressure": stuck("pressure__const"),
    "long_const_temperature": stuck("temperature__long"),
    "long_const_wind": stuck("wind_direction__long", "wind_speed__long"),
    "constancy": both_models(all_constancy),
    "wind_coupling": both_models(coupling),
    "precip_no_constancy": both_models(rain_constancy),
    # jumps and availability of raw readings
    "raw_median": raw("median", real=True),
    "raw_diff": raw("diff", real=True),
    "raw_median_diff": raw("median_diff", real=True),
    "jump_couples": raw("couple"),
    "invalid_datum": both_models(first_blame),
    "invalid_repeat": raw("invalid"),
    "unidentified_spike": raw("unidentified"),
    "jump_not_applicable": both_models(no_jumps),
    "no_datum": both_models(missing),
    "raw_total": slot_columns("faulty"),
    "packages_per_hour": both_models(packages),
    "minute_report": both_models(minutes),
    # bins
    "time_bins": both_models(time_bins),
    "bin_counts": both_models(counts),
    "scalar_bin_mean": means(["avg"], SCALARS),
    "corrected_mean": means(["avg_corrected"], SCALARS),
    "wind_uv": both_models(uv),
    "wind_vector_mean": means(["u", "v", "speed_avg", "direction_avg"], WIND),
    "wind_corrected_mean": means(["speed_avg_corrected", "direction_avg_corrected"], WIND),
    "precip_bin_sum": means(["round(avg, 6) AS avg", "round(avg_corrected, 6) AS avg_corrected"], [RAIN]),
    "bin_annotation_text": both_models(bin_texts),
    "bin_jumps": both_models(jumps_of_bins),
    "bin_availability": full_bins("ann_all_from_raw", "valid_percentage"),
    "bin_availability_rewards": full_bins("ann_all_from_raw_rewards", "valid_percentage_rewards"),
    "bin_annotation_update": full_bins("annotation", texts=True),
    "bin_total": full_bins("ann_total", "ann_total_rewards"),
    "warmup_trim": full_bins("ann_total", trim=True),
    # hours
    "hour_scalar": hour_columns(
        "avg", "num_time_slots", "num_hourly_faulty", "num_hourly_faulty_rewards", parameters=SCALARS
    ),
    "hour_corrected": hour_columns("avg_corrected", parameters=SCALARS),
    "hour_wind": hour_columns("avg", parameters=WIND),
    "hour_wind_corrected": hour_columns("avg_corrected", parameters=WIND),
    "hour_precip": hour_columns("round(avg, 6) AS avg", parameters=[RAIN]),
    "hour_annotation_tokens": hour_columns("annotation", texts=True),
    "hour_valid_pct": hour_columns("valid_percentage", "valid_percentage_rewards"),
    "hour_flag": hour_columns("ann_total_hour", "ann_total_hour_rewards"),
    # annotations
    "text_annotation": slot_columns("text"),
    "hourly_raw_codes": code_rows(hours.hourly_raw_codes),
    "hourly_bin_codes": code_rows(hours.hourly_bin_codes),
    "hourly_codes": both_models(spine_sizes),
    "hourly_json": both_models(spine_json),
    "daily_param_codes": daily_texts(*[f"daily_{p}_annotation" for p in VARIABLES]),
    "daily_codes": daily_texts("daily_annotation"),
    # scores
    "hour_path": both_models(hour_path),
    "hour_pivot": both_models(pivot),
    "hourly_score": both_models(hourly),
    "qod_score": both_models(day_scores),
    "calendar_fields": both_models(calendar),
    "first_24": both_models(first_hours),
    "quality_scores": quality_scores,
}

#: Queries of the 16-second model alone, whose stations need a day of slots before an hour counts.
TWO_LEVEL = frozenset(
    ["hour_scalar", "hour_corrected", "hour_wind", "hour_wind_corrected", "hour_precip", "hour_annotation_tokens", "hour_valid_pct", "hour_flag"]
)
