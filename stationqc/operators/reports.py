"""Tables behind the daily station report, and the audit table of raw flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.functions.columns import extend, floor_to, named, timestamp_of
from stationqc.functions.windows import KEYS, Timeline
from stationqc.operators.hours import DAY_SECONDS
from stationqc.params import VARIABLES, ModelParams

LUX_PER_WATT = 122  # fixed value: illuminance to irradiance


def last_day_rows(df: DataFrame, params: ModelParams) -> DataFrame:
    """Rows whose time, shifted by one step, is on the day of the series' last timestamp. Needs ``last_sec``."""
    shifted = f"(sec + {params.step})"
    same_day = f"{floor_to(shifted, DAY_SECONDS)} = {floor_to('last_sec', DAY_SECONDS)}"
    return df.filter(same_day)


def packages_per_hour(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """Complete readings received per clock hour of the last day, all 24 hours of it.

    One aggregate per series with a counter for each hour, laid out as rows afterwards: quiet hours appear without a
    join. The hour is the reading's own, not the shifted one.
    """
    hour = f"(sec % {DAY_SECONDS} div 3600)"
    counters = {f"h{h}": f"count(if({hour} = {h} AND pressure IS NOT NULL, 1, NULL))" for h in range(24)}
    counted = last_day_rows(df, params).groupBy(*keys).agg(*named(counters))
    return counted.selectExpr(
        *keys, f"posexplode(array({', '.join(counters)})) AS (hour, packages)"
    )


def minute_report(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """Minute means of the last day on the shifted time axis, with irradiance in W/m2; a row for each minute from the first to the last one.

    Each minute with rows brings the empty ones before it: one window over a series' minutes (1,440 at most), and no join.
    """
    minute = floor_to(f"(sec + {params.step})", 60)
    columns = [p for p in VARIABLES if p != "precipitation_accumulated"]
    rows = last_day_rows(df, params)
    report = rows.groupBy(*keys, F.expr(minute).alias("_at")).agg(*named({p: f"avg({p})" for p in columns}))
    report = extend(report, {"_before": Timeline(keys, "_at").lag("_at")})
    spread = report.selectExpr("*", "explode(sequence(coalesce(_before + 60, _at), _at, 60L)) AS _minute")
    means = {p: f"if(_minute = _at, {p}, NULL)" for p in columns}
    report = spread.selectExpr(*keys, f"{timestamp_of('_minute')} AS minute", *[f"{sql} AS {p}" for p, sql in means.items()])
    return report.withColumn("irradiance", F.col("illuminance") / LUX_PER_WATT)


def select_raw_columns(slots: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The audit table: one row per slot and variable with its reading, medians, distances and flags."""
    kept = {
        "rolling_median": "median",
        "consec_obs_diff_abs": "diff",
        "median_diff_abs": "median_diff",
        "ann_obc": "obc",
        "ann_jump_couples": "couple",
        "ann_invalid_datum": "invalid",
        "ann_unidentified_spike": "unidentified",
        "ann_no_datum": "no_datum",
        "ann_constant": "const",
        "ann_constant_long": "long",
        "ann_constant_frozen": "frozen",
        "total_raw_annotation": "faulty",
        "reward_annotation": "faulty",
        "annotation": "text",
    }
    readings = ", ".join(
        f"struct('{p}' AS parameter, {p} AS value, {', '.join(f'{p}__{c} AS {name}' for name, c in kept.items())})"
        for p in VARIABLES
    )
    return slots.selectExpr(*keys, "utc_datetime", f"inline(array({readings}))")
