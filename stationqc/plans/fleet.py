"""Scoring a fleet: any number of stations and days of any known model in one job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.functions.windows import KEYS
from stationqc.operators.grid import fill_missing_slots, resample_grid
from stationqc.operators.scores import daily_rows, final_shape, hour_pivot
from stationqc.params import MODELS, VARIABLES, ModelParams
from stationqc.plans.hours import scored_hours, scoring_means
from stationqc.plans.slots import checked_slots
from stationqc.schema import to_output_schema
from stationqc.sources.telemetry import one_row_per_second, select_rows, with_qod_date


def score_series(slots: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """Score series of one model that already carry ``sec`` and their keys: one row per series and hour."""
    hours = scored_hours(checked_slots(slots, params, keys), params, keys, means=scoring_means(params))
    return final_shape(daily_rows(hour_pivot(hours, keys), keys))


def score_fleet(
    telemetry: DataFrame,
    dates: Sequence[date] | None = None,
    models: Sequence[str] | None = None,
    deduplicated: bool = False,
    regrid: bool = False,
) -> DataFrame:
    """Telemetry in the input schema to 24 scored rows per station-day.

    Two exchanges: one that leaves one row of each second (skipped when ``deduplicated`` says that they are unique), and one on
    ``(device_id, qod_date)`` that everything after it builds on. Slots missing between a series' first and last row count as
    missing readings. ``dates`` limits the days scored and reaches the scan;
    ``models`` limits the station models. ``regrid`` moves irregular readings onto the model's grid first (the first
    exchange then does that as well). Rows of unknown models are left to
    :func:`stationqc.sources.telemetry.rejected_rows`.
    """
    if dates:
        telemetry = select_rows(telemetry, dates=dates)
    scored: DataFrame | None = None
    for name in models or MODELS:
        rows = telemetry.filter(F.col("model") == name)
        if regrid:
            rows = resample_grid(rows, MODELS[name])
        else:
            rows = with_qod_date(rows)
            rows = rows if deduplicated else one_row_per_second(rows)
            rows = fill_missing_slots(rows, MODELS[name].step, VARIABLES, ("model",))
        if dates:
            rows = rows.filter(F.col("qod_date").isin(*dates))
        part = to_output_schema(score_series(rows, MODELS[name]))
        scored = part if scored is None else scored.unionByName(part)
    return scored
