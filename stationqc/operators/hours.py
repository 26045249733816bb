"""Second aggregation level: bins into hours, one row per (series, parameter, hour)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.functions.columns import (
    extend,
    flag,
    floor_to,
    named,
    rint2,
    vector_direction,
    vector_speed,
    wind_u,
    wind_v,
)
from stationqc.functions.windows import KEYS
from stationqc.operators.annotate import BIN_CODES, NO_CODES, RAW_CODES, codes_of
from stationqc.operators.bins import by_parameter, per_kind, warmup
from stationqc.operators.jumps import RAW_FLAGS
from stationqc.params import HOUR_SECONDS, ModelParams

DAY_SECONDS = 86400


def hour_of_bins(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS, texts: bool = False) -> DataFrame:
    """Everything an hour needs from its bins in one aggregate.

    Means and bin faults leave the warm-up bins out; raw flag counts take all readings of the hour. Hours made of
    warm-up bins only are dropped.
    """
    df = extend(df, {"_used": f"NOT {warmup(params)}"})
    clean = "_used AND ann_total = 0"
    u, v = wind_u("speed_avg", "direction_avg"), wind_v("speed_avg", "direction_avg")
    aggregates = {
        "num_time_slots": "count(if(_used, 1, NULL))",
        "num_hourly_faulty": "coalesce(sum(if(_used, ann_total, NULL)), 0L)",
        "num_hourly_faulty_rewards": "coalesce(sum(if(_used, ann_total_rewards, NULL)), 0L)",
        "mean": "avg(if(_used, avg, NULL))",
        "mean_clean": f"avg(if({clean}, avg_corrected, NULL))",
        "rain": "sum(if(_used, avg, NULL))",
        "u": f"avg(if(_used, {u}, NULL))",
        "v": f"avg(if(_used, {v}, NULL))",
        "u_clean": f"avg(if({clean}, {u}, NULL))",
        "v_clean": f"avg(if({clean}, {v}, NULL))",
        "num_total_slots": "sum(num_total_slots)",
        "last_sec": "max(last_sec)",
    }
    aggregates |= {f"n_{f}": f"sum(n_{f})" for f in RAW_FLAGS}
    aggregates |= {f"bins_{f}": f"count(if(_used AND jump__{f} > 0, 1, NULL))" for f in BIN_CODES}
    if texts:
        # One entry per bin of the hour: 60 at most.
        ordered = "array_sort(collect_list(if(_used, struct(bin, annotation), NULL)))"
        tokens = f"flatten(transform({ordered}, x -> split(x.annotation, ',')))"
        aggregates["annotation"] = f"array_join(filter({tokens}, x -> x <> ''), ',')"
    hour = F.expr(floor_to("bin", HOUR_SECONDS)).alias("hour_sec")
    hours = df.groupBy(*keys, "model", "parameter", hour).agg(*named(aggregates))
    return hours.filter("num_time_slots > 0")


def hour_means(df: DataFrame, params: ModelParams) -> DataFrame:
    """``avg`` and ``avg_corrected`` per hour; rain is summed and has no corrected value."""
    required = by_parameter(params, lambda v: v.hour_availability)
    enough = f"(num_time_slots - num_hourly_faulty) / num_time_slots > {required}"
    corrected = per_kind(
        vector_speed("u_clean", "v_clean"),
        vector_direction("u_clean", "v_clean"),
        "CAST(NULL AS DOUBLE)",
        rint2("mean_clean"),
    )
    return extend(
        df,
        {
            "avg": per_kind(vector_speed("u", "v"), vector_direction("u", "v"), "rain", rint2("mean")),
            "avg_corrected": f"if({enough}, {corrected}, NULL)",
        },
    )


VALID = "double(num_time_slots - num_hourly_faulty)"


def hour_valid_pct(df: DataFrame) -> DataFrame:
    """Share of usable bins, two decimals. The reward share is taken from the same count of faults."""
    pct = rint2(f"try_divide({VALID} * 100, double(num_time_slots))")
    return extend(df, {"valid_percentage": pct, "valid_percentage_rewards": pct})


def hour_flag(df: DataFrame, params: ModelParams) -> DataFrame:
    """``ann_total_hour`` and its reward twin: too few usable bins."""
    required = by_parameter(params, lambda v: v.hour_availability)
    short = flag(f"try_divide({VALID}, double(num_time_slots)) < {required}")
    return extend(df, {"ann_total_hour": short, "ann_total_hour_rewards": short})


def bins_as_hours(df: DataFrame, params: ModelParams) -> DataFrame:
    """A one-level model's 60-minute bins are its hours already."""
    df = df.filter(f"NOT {warmup(params)}")
    columns = {"hour_sec": "bin", "num_time_slots": "1L"}
    return extend(df, columns | {f"bins_{f}": f"{flag(f'jump__{f} > 0')} * 1L" for f in BIN_CODES})


def hourly_raw_codes() -> str:
    """Share of the hour's readings with each raw flag."""
    return codes_of({code: f"n_{f}" for f, code in RAW_CODES.items()}, "num_total_slots")


def hourly_bin_codes() -> str:
    """Share of the hour's bins with each bin flag."""
    return codes_of({code: f"bins_{f}" for f, code in BIN_CODES.items()}, "num_time_slots")


def in_last_day() -> str:
    return f"{floor_to('hour_sec', DAY_SECONDS)} = {floor_to('last_sec', DAY_SECONDS)}"


def hourly_codes(df: DataFrame) -> DataFrame:
    """``codes``: raw shares, then bin shares; empty for hours outside the day of the series' last timestamp."""
    both = f"concat({hourly_raw_codes()}, {hourly_bin_codes()})"
    return extend(df, {"codes": f"if({in_last_day()}, {both}, {NO_CODES})"})


def hour_counts(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """Flag counts per hour from bins of either model, warm-up hours included (with no bins counted)."""
    used = f"NOT {warmup(params)}"
    aggregates = {
        "num_total_slots": "sum(num_total_slots)",
        "num_time_slots": f"count(if({used}, 1, NULL))",
        "last_sec": "max(last_sec)",
    }
    aggregates |= {f"n_{f}": f"sum(n_{f})" for f in RAW_FLAGS}
    aggregates |= {f"bins_{f}": f"count(if({used} AND jump__{f} > 0, 1, NULL))" for f in BIN_CODES}
    hour = F.expr(floor_to("bin", HOUR_SECONDS)).alias("hour_sec")
    return df.groupBy(*keys, "model", "parameter", hour).agg(*named(aggregates))


def hourly_spine(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All 24 hours of the last day of each series with their ``codes``, empty for hours without any.

    Needs :func:`hour_counts`. A series has about 30 hours, so they are looked up in a map instead of joined.
    """
    df = hourly_codes(df)
    series = df.groupBy(*keys, "model", "parameter").agg(
        *named(
            {
                "_codes": "map_from_entries(collect_list(struct(hour_sec, codes)))",
                "_day": f"max({floor_to('last_sec', DAY_SECONDS)})",
            }
        )
    )
    hours = f"explode(sequence(_day, _day + {23 * HOUR_SECONDS}, {HOUR_SECONDS}L)) AS hour_sec"
    series = series.selectExpr(*keys, "model", "parameter", "_codes", hours)
    return extend(series, {"codes": f"coalesce(try_element_at(_codes, hour_sec), {NO_CODES})"}).drop("_codes")
