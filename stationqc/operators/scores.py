"""Hourly and daily scores in the final shape: one row per station-day and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stationqc.functions.columns import extend, json_pairs, named, timestamp_of
from stationqc.functions.windows import KEYS
from stationqc.operators.annotate import NO_CODES, daily_codes_json, daily_param_codes
from stationqc.params import QOD_VERSION, VARIABLES


def hour_pivot(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per hour: ``{p}_score`` and ``{p}_codes`` for all variables, null / empty where one has no such hour.

    A pivot with its values known beforehand, i.e. one more aggregate on the keys the rows are partitioned by.
    """
    aggregates: dict[str, str] = {}
    for p in VARIABLES:
        own = f"parameter = '{p}'"
        aggregates[f"{p}_score"] = f"max(if({own}, valid_percentage_rewards, NULL))"
        aggregates[f"{p}_codes"] = f"coalesce(max(if({own}, codes, NULL)), {NO_CODES})"
        aggregates[f"{p}_rows"] = f"count(if({own}, 1, NULL))"
    return df.groupBy(*keys, "model", "hour_sec").agg(*named(aggregates))


def hourly_score() -> str:
    """Mean of the variables' scores, those without one left out."""
    known = f"filter(array({', '.join(f'{p}_score' for p in VARIABLES)}), x -> x IS NOT NULL)"
    return f"try_divide(aggregate({known}, 0D, (total, x) -> total + x), double(size({known})))"


def qod_score(hours: str) -> str:
    """Mean over variables of the mean over hours of score / 100. ``hours``: array of hour structs, in order.

    An hour without a score leaves the whole day without one.
    """

    def of(p: str) -> str:
        own = f"filter({hours}, h -> h.{p}_rows > 0)"
        return f"try_divide(aggregate({own}, 0D, (total, h) -> total + h.{p}_score / 100), double(size({own})))"

    return f"({' + '.join(of(p) for p in VARIABLES)}) / {len(VARIABLES)}"


def first_24(hours: str) -> str:
    return f"slice({hours}, 1, 24)"


def calendar_fields(sec: str) -> dict[str, str]:
    ts = timestamp_of(sec)
    return {part: f"int({part}({ts}))" for part in ("year", "month", "day", "hour")}


def gather_hours(wide: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per station-day with ``hours``, its hours (about 24) as an array in time order."""
    fields = ", ".join(["hour_sec"] + [f"{p}_{x}" for p in VARIABLES for x in ("score", "codes", "rows")])
    hours = f"array_sort(collect_list(struct({fields})), (a, b) -> int(sign(a.hour_sec - b.hour_sec)))"
    return wide.groupBy(*keys, "model").agg(*named({"hours": hours}))


def daily_annotations(days: DataFrame) -> DataFrame:
    """``daily_{p}_annotation`` and ``daily_annotation`` texts of each day, from its ``hours``."""
    days = extend(days, {f"_{p}_daily": daily_param_codes(f"hours.{p}_codes") for p in VARIABLES})
    texts = {f"daily_{p}_annotation": json_pairs(f"_{p}_daily") for p in VARIABLES}
    texts["daily_annotation"] = daily_codes_json({p: f"_{p}_daily" for p in VARIABLES})
    return extend(days, texts).drop(*[f"_{p}_daily" for p in VARIABLES])


def daily_rows(wide: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Scores and annotations of a day onto its first 24 hourly rows.

    The day's values are computed once from the array of its hours, which is then laid out as rows again.
    """
    days = extend(gather_hours(wide, keys), {"qod_score": qod_score("hours"), "hours": first_24("hours")})
    days = daily_annotations(days)
    return days.selectExpr(*[c for c in days.columns if c != "hours"], "inline(hours)")


def final_shape(rows: DataFrame) -> DataFrame:
    """Hourly texts, score, version and calendar fields."""
    columns = {f"{p}_annotation": json_pairs(f"{p}_codes") for p in VARIABLES}
    columns |= {"hourly_score": hourly_score(), "qod_version": f"'{QOD_VERSION}'"} | calendar_fields("hour_sec")
    return extend(rows, columns)
