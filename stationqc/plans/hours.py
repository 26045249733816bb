"""From checked slots to scored hours and days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stationqc.functions.windows import KEYS
from stationqc.operators import bins, hours
from stationqc.params import ModelParams


def scoring_means(params: ModelParams) -> str:
    """The means that scores and codes take: scores are counts; averages matter where they are searched for jumps."""
    return "plain" if bins.has_bin_jumps(params) else "none"


def aggregated_bins(
    slots: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS, texts: bool = False, means: str = "all"
) -> DataFrame:
    """All bin columns; a model without jump thresholds for bins skips that search."""
    df = bins.bin_means(bins.bin_readings(slots, params, keys, texts, means), params)
    df = bins.bin_jumps(df, params, keys) if bins.has_bin_jumps(params) else bins.no_bin_jumps(df)
    df = bins.bin_availability_rewards(bins.bin_availability(df, params), params)
    df = bins.bin_total(df)
    return bins.bin_annotation_update(df) if texts else df


def scored_hours(
    slots: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS, texts: bool = False, means: str = "all"
) -> DataFrame:
    """``hour_path``: bins are averaged into hours for the two-level model, and are the hours for the other."""
    df = aggregated_bins(slots, params, keys, texts, means)
    if params.two_level:
        df = hours.hour_of_bins(df, params, keys, texts)
        df = hours.hour_flag(hours.hour_valid_pct(hours.hour_means(df, params)), params)
    else:
        df = hours.bins_as_hours(df, params)
    return hours.hourly_codes(df)
