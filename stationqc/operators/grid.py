"""Irregular readings onto a model's fixed grid. For input that is not on a grid already."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stationqc.functions.columns import extend, named, timestamp_of
from stationqc.functions.windows import KEYS, Timeline
from stationqc.params import VARIABLES, ModelParams
from stationqc.sources.telemetry import CONTEXT_HOURS, with_qod_date


def snap_to_grid(
    df: DataFrame, step: int, tolerance: int, values: Sequence[str], by: Sequence[str] = ("device_id",)
) -> DataFrame:
    """Move each reading to the grid time it is within ``tolerance`` after or before; one of a slot stays.

    It is the one with the fewest missing values, then the nearest, the earlier, the smaller: no reading is lost to an empty row, and
    the result does not depend on row order. One aggregate with
    map-side combining: many readings of one slot never meet in one place.
    """
    micros = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', utc_datetime)"
    slot = f"(({micros} + {tolerance * 1_000_000}L) div {step * 1_000_000}L) * {step}L"
    df = extend(df, {"_micros": micros, "_slot": slot})
    missing = " + ".join(f"if({v} IS NULL, 1, 0)" for v in values)
    nearest = f"min(struct({missing} AS missing, abs(_micros - _slot * 1000000L) AS away, _micros, {', '.join(values)}))"
    snapped = df.groupBy(*by, "_slot").agg(*named({"_row": nearest}))
    return snapped.selectExpr(*by, f"{timestamp_of('_slot')} AS utc_datetime", *[f"_row.{v}" for v in values])


def complete_grid(
    df: DataFrame, step: int, values: Sequence[str], carried: Sequence[str] = (), keys: Sequence[str] = KEYS
) -> DataFrame:
    """Add the missing slots of each station-day, from six hours before it to its end, with null values.

    Each slot brings the empty ones before it, the last one also those after it: one window on the keys the checks need
    anyway, and no join. ``carried`` columns are the same on all rows of a day.
    """
    t = Timeline(keys)
    midnight = "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(qod_date AS TIMESTAMP_NTZ))"
    first, last = f"{midnight} - {CONTEXT_HOURS * 3600}", f"{midnight} + {86400 - step}"
    df = extend(df, {"_from": f"coalesce({t.lag('sec')} + {step}, {first})", "_following": t.lead("sec")})
    slots = f"explode(sequence(_from, if(_following IS NULL, {last}, sec), {step}L)) AS _sec"
    spread = df.selectExpr(*keys, *carried, "sec", *values, slots)
    return spread.selectExpr(
        *keys,
        *carried,
        "_sec AS sec",
        f"{timestamp_of('_sec')} AS utc_datetime",
        *[f"if(_sec = sec, {v}, NULL) AS {v}" for v in values],
    )


def days_with_readings(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Only the station-days that have a row of their own, not just the evening before as context."""
    own = f"max(to_date(utc_datetime) = qod_date) OVER (PARTITION BY {', '.join(keys)})"
    return extend(df, {"_own": own}).filter("_own").drop("_own")


def fill_missing_slots(df: DataFrame, step: int, values: Sequence[str], carried: Sequence[str] = (), keys: Sequence[str] = KEYS) -> DataFrame:
    """Add, with null values, the slots that are missing between a series' first and last row.

    Where the time since the row before has room for more readings, each row brings these empty ones; rows keep their own times, on the
    grid or not. One window on the keys and order that the checks need anyway.
    """
    t = Timeline(keys)
    df = extend(df, {"_before": t.lag("sec")})
    room = f"CAST(round((sec - _before) / {step}D) AS INT) - 1"
    empty = f"if({room} > 0, transform(sequence(1, greatest({room}, 1)), i -> _before + i * {step}L), CAST(array() AS array<bigint>))"
    spread = df.selectExpr("*", f"explode(concat(coalesce({empty}, CAST(array() AS array<bigint>)), array(sec))) AS _sec")
    return spread.selectExpr(
        *keys,
        *carried,
        "_sec AS sec",
        f"if(_sec = sec, utc_datetime, {timestamp_of('_sec')}) AS utc_datetime",
        *[f"if(_sec = sec, {v}, NULL) AS {v}" for v in values],
    )


def resample_grid(telemetry: DataFrame, params: ModelParams, values: Sequence[str] = VARIABLES) -> DataFrame:
    """Telemetry of one model in the input schema to complete station-days on its grid."""
    snapped = snap_to_grid(telemetry, params.step, params.tolerance, values, ("device_id", "model"))
    return complete_grid(days_with_readings(with_qod_date(snapped)), params.step, values, ("model",))
