"""Stuck sensors.

A window ``[t - w, t)`` is *constant* when its non-null readings are all equal and *full* when it holds as many
non-null readings as the last window of the series has rows. Both follow from counts kept from the start of the
series: ``seen_before`` readings before ``t``, ``seen_before_{m}`` before ``t - w``, and the number of the reading at
which the current run of equal readings began. A hit at ``t`` then marks the readings of the window before it.

Median conditions only compare a median with a limit, so counting readings on the low side decides them, save when
exactly half are; only series where that happens get real medians (:func:`settled`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.api.indexers import BaseIndexer
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stationqc.functions.columns import any_of, extend, flag, number, yes
from stationqc.functions.windows import (
    EARLIER,
    EVERYTHING,
    KEYS,
    SO_FAR,
    Timeline,
    older_than,
    past_seconds,
    until,
)
from stationqc.params import (
    CODE_CONSTANT,
    CODE_FROZEN,
    FREEZING,
    HUMIDITY_CEILING,
    RAIN,
    STICKING,
    STUCK_WINDOWS,
    WIND,
    WIND_HUMIDITY_CEILING,
    ModelParams,
)

KINDS = ("const", "long", "frozen")


# ---- building blocks ---------------------------------------------------------------------------


def window_rows(t: Timeline, minutes: Sequence[int] = STUCK_WINDOWS) -> dict[str, str]:
    """``rows_{m}``: rows in the window before the series' last timestamp, i.e. what a full window holds."""
    return {
        f"rows_{m}": t.over(f"count(if(sec >= last_sec - {m * 60} AND sec < last_sec, 1, NULL))", EVERYTHING)
        for m in minutes
    }


def readings_seen(t: Timeline, minutes: Sequence[int] = STUCK_WINDOWS, present: str = "present") -> dict[str, str]:
    """Readings so far, before now, and older than each window."""
    count = f"count(if({present}, 1, NULL))"
    return {
        "seen": t.over(count, SO_FAR),
        "seen_before": t.over(count, older_than(0)),
    } | {f"seen_before_{m}": t.over(count, older_than(m * 60)) for m in minutes}


def in_window(minutes: int) -> str:
    return f"(seen_before - seen_before_{minutes})"


def last_reading(t: Timeline, columns: Sequence[str] = STICKING) -> dict[str, str]:
    """``_previous``: the latest non-null readings above this row."""
    readings = f"struct({', '.join(f'{p}__filled AS {p}' for p in columns)})"
    return {"_previous": t.over(f"last(if(present, {readings}, NULL), true)", EARLIER)}


def changed(p: str) -> str:
    return f"(_previous IS NULL OR {p}__filled <> _previous.{p})"


def run_starts(t: Timeline, columns: Sequence[str] = STICKING, changed: Callable[[str], str] = changed) -> dict[str, str]:
    """``{p}__run``: number of the reading that opened the run of equal readings before ``t``."""
    return {f"{p}__run": t.over(f"max(if(present AND {changed(p)}, seen, NULL))", older_than(0)) for p in columns}


def is_constant(p: str, minutes: int) -> str:
    """All readings of the window are equal; false for a window without any."""
    return f"(seen_before > seen_before_{minutes} AND {p}__run <= seen_before_{minutes} + 1)"


def is_full(minutes: int) -> str:
    return f"({in_window(minutes)} = rows_{minutes})"


def guard(minutes: int) -> str:
    """The window reaches no further back than the series does."""
    return f"(sec >= first_sec + {minutes * 60})"


def any_hit(hit: str, seconds: int, t: Timeline) -> str:
    """1 for rows with a hit in the ``seconds`` after them; a hit does not mark its own row."""
    return flag(f"{t.over(f'max(if({hit}, sec, NULL))', until(seconds))} > sec")


def latest_result(result: str, seconds: int, t: Timeline) -> str:
    """The latest row's result, as (at, value), up to ``seconds`` after this row; see :func:`if_ahead`."""
    return t.over(f"last(if({result} IS NULL, NULL, struct(sec AS at, {result} AS value)), true)", until(seconds))


def if_ahead(latest: str) -> str:
    """That result if it lies after this row, else 0."""
    return f"if({latest}.at > sec, {latest}.value, 0)"


# ---- median conditions -------------------------------------------------------------------------


@dataclass(frozen=True)
class MedianTest:
    """Is the median of ``column`` over the past ``minutes`` below (or at) ``limit``?"""

    name: str
    column: str
    minutes: int
    limit: float
    comparison: str

    def holds(self, value: str) -> str:
        return f"({value} {self.comparison} {number(self.limit)})"


DRY_4H = MedianTest("dry_4h", "humidity__filled", 240, HUMIDITY_CEILING, "<")
DRY_6H = MedianTest("dry_6h", "humidity__filled", 360, WIND_HUMIDITY_CEILING, "<")
COLD_6H = MedianTest("cold_6h", "temperature__filled", 360, FREEZING, "<=")
COLD_24H = MedianTest("cold_24h", "temperature__filled", 1440, FREEZING, "<=")
MEDIAN_TESTS = (DRY_4H, DRY_6H, COLD_6H, COLD_24H)


def low_counts(t: Timeline, tests: Sequence[MedianTest] = MEDIAN_TESTS) -> dict[str, str]:
    """``_{test}_low``: how many readings of the window are on the low side of the limit."""

    def low(test: MedianTest, seconds: int) -> str:
        return t.over(f"count(if({test.holds(test.column)}, 1, NULL))", older_than(seconds))

    return {f"_{x.name}_low": f"{low(x, 0)} - {low(x, x.minutes * 60)}" for x in tests}


def is_tied(x: MedianTest) -> str:
    return f"_{x.name}_low * 2 = count_{x.minutes}"


def tied_series(t: Timeline, candidates: Mapping[MedianTest, str], tied: Callable[[MedianTest], str] = is_tied) -> dict[str, str]:
    """``_tied``: some candidate row of the series has exactly half of its readings on the low side."""
    ties = any_of(yes(f"{c} AND {tied(x)}") for x, c in candidates.items())
    return {"_tied": t.over(f"max({ties})", EVERYTHING)}


def readings_of_tied(t: Timeline, tests: Sequence[MedianTest] | Mapping[MedianTest, str] = MEDIAN_TESTS) -> dict[str, str]:
    """``_readings``: a tied series' readings in time order (a station-day's); an empty list for any other series."""
    columns = ", ".join(dict.fromkeys(x.column for x in tests))
    return {"_readings": t.over(f"collect_list(if(_tied AND present, struct(sec, {columns}), NULL))", EVERYTHING)}


def middles_of_tied(candidates: Mapping[MedianTest, str]) -> dict[str, str]:
    """As :func:`middles`, from ``_readings``, on the candidate rows that are tied; null on all others."""

    def middle(x: MedianTest, candidate: str) -> str:
        def side(extreme: str, low: bool) -> str:
            value = f"r.{x.column}"
            on_side = x.holds(value) if low else f"NOT {x.holds(value)}"
            window = f"filter(_readings, r -> r.sec >= sec - {x.minutes * 60} AND r.sec < sec AND {on_side})"
            return f"{extreme}({window}.{x.column})"

        return f"if({candidate} AND {packed_tie(x)}, ({side('array_max', True)} + {side('array_min', False)}) / 2, NULL)"

    return {f"_{x.name}": middle(x, c) for x, c in candidates.items()}


def middles(tests: Sequence[MedianTest], t: Timeline) -> dict[str, str]:
    """``_{test}``: the median where exactly half of the readings are on the low side, halfway between the two sides."""

    def middle(x: MedianTest) -> str:
        frame = past_seconds(x.minutes * 60)
        low = t.over(f"max(if({x.holds(x.column)}, {x.column}, NULL))", frame)
        high = t.over(f"min(if({x.holds(x.column)}, NULL, {x.column}))", frame)
        return f"({low} + {high}) / 2"

    return {f"_{x.name}": middle(x) for x in tests}


def settled(tests: Sequence[MedianTest]) -> dict[str, str]:
    """One boolean per test, exact where ``_{test}`` holds the median on ties; null for a window without readings.

    More than half of the readings on one side of the limit decide a test. With exactly half, the median lies between
    the two middle readings and is compared itself.
    """

    def test(x: MedianTest) -> str:
        n, low = f"count_{x.minutes}", f"_{x.name}_low * 2"
        return f"CASE WHEN {n} = 0 THEN NULL WHEN {low} = {n} THEN {x.holds(f'_{x.name}')} ELSE {low} > {n} END"

    return {x.name: test(x) for x in tests}


def settle_medians(df: DataFrame, tests: Sequence[MedianTest], keys: Sequence[str] = KEYS) -> DataFrame:
    """Median tests with medians computed in tied series only: their rows stay in one window partition, all
    other rows become partitions of their own, for which a moving frame costs nothing. Row order and data partitioning
    stay what they are, so this needs no shuffle."""
    df = extend(df, {"_part": "if(_tied, -1L, sec)"})
    df = extend(extend(df, middles(tests, Timeline((*keys, "_part")))), settled(tests))
    return df.drop("_part", "_tied", *[f"_{x.name}" for x in tests], *[f"_{x.name}_low" for x in tests])


# ---- the checks --------------------------------------------------------------------------------


LONG_CHECKED = ("temperature", *WIND)


def stuck_columns(params: ModelParams) -> dict[str, str]:
    """``_stuck_{p}``: the variable's window is full and constant; ``_day_{p}``: its long window is constant.

    Wind may have gaps in the long window, temperature may not.
    """
    columns = {}
    for p in STICKING:
        m = params.of(p).stuck_minutes
        columns[f"_stuck_{p}"] = f"{guard(m)} AND {is_full(m)} AND {is_constant(p, m)}"
    for p in LONG_CHECKED:
        m = params.of(p).stuck_long_minutes
        whole = "" if p in WIND else f" AND {is_full(m)}"
        columns[f"_day_{p}"] = f"{guard(m)} AND {is_constant(p, m)}{whole}"
    return columns


def window_counts(minutes: Sequence[int] = STUCK_WINDOWS) -> dict[str, str]:
    return {f"count_{m}": in_window(m) for m in minutes}


def as_named(column: str) -> str:
    return column


def median_candidates(stuck: Callable[[str], str] = as_named) -> dict[MedianTest, str]:
    """Rows whose verdict depends on each test."""
    still = any_of(stuck(f"_stuck_{p}") for p in WIND)
    return {
        DRY_4H: stuck("_stuck_temperature"),
        DRY_6H: still,
        COLD_6H: still,
        COLD_24H: any_of(stuck(f"_day_{p}") for p in WIND),
    }


# What the latest reading above a row has to be for some verdicts.
BEFORE = {
    "humidity": f"_previous.humidity < {number(HUMIDITY_CEILING)}",
    "illuminance": "_previous.illuminance <> 0",
    "wind_speed": "_previous.wind_speed <> 0",
}


def verdicts(stuck: Callable[[str], str] = as_named, before: Callable[[str], str] = BEFORE.__getitem__) -> dict[str, str]:
    """What each constant window means.

    Boolean ``{p}__hit`` / ``{p}__long_hit`` where any hit marks the window before it, and ``{p}__verdict`` (flag code
    or null) for wind, where the latest verdict counts.
    """
    by_weather = f"WHEN cold_6h THEN {CODE_FROZEN} WHEN NOT cold_6h AND dry_6h THEN {CODE_CONSTANT}"
    moving = f"WHEN {before('wind_speed')} THEN {CODE_CONSTANT}"
    return {
        "humidity__hit": f"{stuck('_stuck_humidity')} AND {before('humidity')}",
        "temperature__hit": f"{stuck('_stuck_temperature')} AND dry_4h",
        "temperature__long_hit": stuck("_day_temperature"),
        "illuminance__hit": f"{stuck('_stuck_illuminance')} AND {before('illuminance')}",
        "pressure__hit": stuck("_stuck_pressure"),
        "wind_direction__long_hit": f"{stuck('_day_wind_direction')} AND NOT cold_24h",
        "wind_speed__long_hit": f"{stuck('_day_wind_speed')} AND NOT cold_24h",
        "wind_direction__verdict": f"if({stuck('_stuck_wind_direction')}, CASE {by_weather} END, NULL)",
        "wind_speed__verdict": f"if({stuck('_stuck_wind_speed')}, CASE {moving} {by_weather} END, NULL)",
    }


# ---- the same columns as bits of numbers: rows of the slot stage stay narrow ---------------------

STUCK = (*[f"_stuck_{p}" for p in STICKING], *[f"_day_{p}" for p in LONG_CHECKED])
UNKNOWN, HOLDS, TIED = 3, 2, 1


def _bits(conditions: Sequence[str]) -> str:
    return " | ".join(f"if({c}, {1 << i}, 0)" for i, c in enumerate(conditions))


def packed_previous() -> dict[str, str]:
    """``_changes``: which readings differ from the latest ones above, and what those are for :func:`verdicts`."""
    return {"_changes": _bits([*map(changed, STICKING), *BEFORE.values()])}


def packed_changed(p: str) -> str:
    return f"((_changes & {1 << STICKING.index(p)}) <> 0)"


def packed_before(p: str) -> str:
    return f"((_changes & {1 << len(STICKING) + list(BEFORE).index(p)}) <> 0)"


def packed_stuck(params: ModelParams) -> dict[str, str]:
    """``_constant``: :func:`stuck_columns`."""
    columns = stuck_columns(params)
    return {"_constant": _bits([columns[c] for c in STUCK])}


def is_stuck(column: str) -> str:
    return f"((_constant & {1 << STUCK.index(column)}) <> 0)"


def packed_tests() -> dict[str, str]:
    """``_tests``: for each test what the counts say of it, in two bits."""

    def state(x: MedianTest) -> str:
        n, low = in_window(x.minutes), f"_{x.name}_low * 2"
        return f"CASE WHEN {n} = 0 THEN {UNKNOWN} WHEN {low} = {n} THEN {TIED} WHEN {low} > {n} THEN {HOLDS} ELSE 0 END"

    return {"_tests": " | ".join(f"shiftleft({state(x)}, {2 * i})" for i, x in enumerate(MEDIAN_TESTS))}


def _state(x: MedianTest) -> str:
    return f"(shiftright(_tests, {2 * MEDIAN_TESTS.index(x)}) & 3)"


def packed_tie(x: MedianTest) -> str:
    return f"{_state(x)} = {TIED}"


def packed_settled() -> dict[str, str]:
    """:func:`settled` from ``_tests`` and the medians of ties."""
    return {
        x.name: f"CASE {_state(x)} WHEN {UNKNOWN} THEN NULL WHEN {TIED} THEN {x.holds(f'_{x.name}')} ELSE {_state(x)} = {HOLDS} END"
        for x in MEDIAN_TESTS
    }


ANY_HIT = tuple(p for p in STICKING if p not in WIND)


def spread(params: ModelParams, t: Timeline) -> dict[str, str]:
    """Verdicts onto the windows before them."""
    marks = {
        f"{p}__const": any_hit(f"{p}__hit", params.of(p).stuck_minutes * 60, t) for p in ANY_HIT
    }
    marks |= {
        f"_{p}_latest": latest_result(f"{p}__verdict", params.of(p).stuck_minutes * 60, t) for p in WIND
    }
    marks |= {
        f"{p}__long": any_hit(f"{p}__long_hit", params.of(p).stuck_long_minutes * 60, t) for p in LONG_CHECKED
    }
    return marks


def constancy_flags() -> dict[str, str]:
    """The flags that need no window: wind codes from the latest verdict, 0 where a check does not exist."""
    flags = {f"{p}__{k}": "0" for p in (*STICKING, RAIN) for k in KINDS}
    for done in (*[f"{p}__const" for p in ANY_HIT], *[f"{p}__long" for p in LONG_CHECKED]):
        del flags[done]
    for p in WIND:
        for kind, code in (("const", CODE_CONSTANT), ("frozen", CODE_FROZEN)):
            flags[f"{p}__{kind}"] = f"if({if_ahead(f'_{p}_latest')} = {code}, {code}, 0)"
    return flags


def coupled_wind() -> dict[str, str]:
    return {f"wind_speed__{k}": f"if(wind_direction__{k} = 0, 0, wind_speed__{k})" for k in KINDS}


# ---- as DataFrame operators --------------------------------------------------------------------


def const_window_rows(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return extend(df, window_rows(Timeline(keys)))


def rolling_non_null(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``count_{m}``: readings in each window."""
    return extend(extend(df, readings_seen(Timeline(keys))), window_counts())


def rolling_is_constant(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """``{p}__constant`` over the variable's own window and ``{p}__constant_day`` over the long one."""
    t = Timeline(keys)
    df = extend(extend(df, readings_seen(t) | last_reading(t)), run_starts(t))
    columns = {f"{p}__constant": yes(is_constant(p, params.of(p).stuck_minutes)) for p in STICKING}
    columns |= {
        f"{p}__constant_day": yes(is_constant(p, params.of(p).stuck_long_minutes)) for p in LONG_CHECKED
    }
    return extend(df, columns)


def rolling_median(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The medians themselves, ``{test}__median``; the checks only ever need to place them against a limit.

    A window function would sort up to 5,400 readings anew for every row. pandas slides over a series with an ordered structure
    that takes one reading in and lets one go, so the cost of a row grows with the logarithm of the window. A task holds one series.
    """
    tests = {f"{x.name}__median": x for x in MEDIAN_TESTS}

    def add(series: pa.Table) -> pa.Table:
        sec = series.column("sec").to_numpy()
        order = np.argsort(sec, kind="stable")
        for name, x in tests.items():
            values = pd.Series(series.column(x.column).to_pandas().to_numpy(np.float64)[order])
            medians = np.empty(len(sec))
            medians[order] = values.rolling(_Past(sec[order], x.minutes * 60), min_periods=1).median()
            series = series.append_column(name, pa.array(medians, pa.float64(), from_pandas=True))
        return series

    schema = T.StructType([*df.schema.fields, *[T.StructField(name, T.DoubleType()) for name in tests]])
    return df.groupBy(*keys).applyInArrow(add, schema)


class _Past(BaseIndexer):
    """Windows ``[now - seconds, now)`` of sorted times, as :func:`stationqc.functions.windows.past_seconds`."""

    def __init__(self, sec: np.ndarray, seconds: int) -> None:
        super().__init__()
        self.bounds = (np.searchsorted(sec, sec - seconds).astype(np.int64), np.searchsorted(sec, sec).astype(np.int64))

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        return self.bounds


def median_conditions(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every median test on every row."""
    t = Timeline(keys)
    df = extend(extend(df, readings_seen(t) | low_counts(t)), window_counts())
    df = extend(df, tied_series(t, {x: "true" for x in MEDIAN_TESTS}))
    return settle_medians(df, MEDIAN_TESTS, keys)


def stuck_verdicts(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """Needs :func:`stationqc.operators.fill.fill_gaps`; adds the columns of :func:`verdicts`."""
    t = Timeline(keys)
    df = extend(df, window_rows(t) | readings_seen(t) | low_counts(t) | last_reading(t))
    df = extend(extend(df, run_starts(t)), stuck_columns(params) | window_counts())
    df = extend(df, tied_series(t, median_candidates()))
    return extend(settle_medians(df, MEDIAN_TESTS, keys), verdicts())


def mark_windows(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """``{p}__const``, ``{p}__long`` and ``{p}__frozen`` of all variables, before the wind coupling."""
    df = extend(df, spread(params, Timeline(keys)))
    return extend(df, constancy_flags()).drop(*[f"_{p}_latest" for p in WIND])


def wind_coupling(df: DataFrame) -> DataFrame:
    """A still anemometer under a moving vane is calm weather, not a fault: the vane's clear flags clear its own."""
    return extend(df, coupled_wind())


def precip_no_constancy(df: DataFrame) -> DataFrame:
    """Rain is legitimately constant: its three flags are always 0."""
    return extend(df, {f"{RAIN}__{k}": "0" for k in KINDS})


def constancy(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """All stuck-sensor flags; the wind coupling applies to the one-level model only."""
    df = mark_windows(stuck_verdicts(df, params, keys), params, keys)
    return df if params.two_level else wind_coupling(df)
