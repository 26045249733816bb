"""Readings outside what the sensor can report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stationqc.functions.columns import extend, flag, number
from stationqc.functions.windows import KEYS, Timeline
from stationqc.params import RAIN, STICKING, ModelParams


def bounds_columns(params: ModelParams, columns: Sequence[str] = STICKING) -> dict[str, str]:
    limits = {p: params.of(p) for p in columns}
    return {
        f"{p}__obc": flag(f"{p} < {number(v.lower)} OR {p} > {number(v.upper)}") for p, v in limits.items()
    }


def obc_bounds(df: DataFrame, params: ModelParams, columns: Sequence[str] = STICKING) -> DataFrame:
    """``{p}__obc``: 1 for an original reading outside the limits, limits themselves allowed."""
    return extend(df, bounds_columns(params, columns))


def precip_diff_column(t: Timeline) -> dict[str, str]:
    total = f"{RAIN}__filled"
    return {"precip_diff": f"{total} - {t.lag(total)}"}


def precip_diff(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``precip_diff``: rain since the previous slot, from the gap-filled accumulation."""
    return extend(df, precip_diff_column(Timeline(keys)))


def obc_precip_column(params: ModelParams) -> dict[str, str]:
    v = params.of(RAIN)
    too_fast = f"precip_diff > {number(v.upper)} * (fill_count + 1)"
    return {f"{RAIN}__obc": flag(f"{too_fast} OR precip_diff < {number(v.lower)}")}


def obc_precip(df: DataFrame, params: ModelParams) -> DataFrame:
    """Rain faster than the gauge allows (the limit widens along a filled gap), or running backwards."""
    return extend(df, obc_precip_column(params))
