"""Missing readings: the incomplete-row rule and the short-gap fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stationqc.functions.columns import any_of, extend, yes
from stationqc.functions.windows import EVERYTHING, KEYS, SO_FAR, Timeline, last_rows
from stationqc.params import VARIABLES, ModelParams


def incomplete(columns: Sequence[str] = VARIABLES) -> str:
    return any_of(f"{c} IS NULL" for c in columns)


def null_incomplete_rows(df: DataFrame, columns: Sequence[str] = VARIABLES) -> DataFrame:
    """A row lacking any variable counts as lacking all of them."""
    return extend(df, {c: f"if({incomplete(columns)}, NULL, {c})" for c in columns})


def fill_gaps(
    df: DataFrame, params: ModelParams, columns: Sequence[str] = VARIABLES, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Carry the last reading into a gap, for at most ``fill_rows + 1`` slots.

    Adds ``{p}__filled`` per variable, ``present`` (a reading or a carried one), ``is_fill`` (a carried one) and the
    series' ``first_sec`` / ``last_sec``. Gaps are common to all variables (:func:`null_incomplete_rows`), so one carried
    struct serves them all.
    """
    t = Timeline(keys)
    reading = f"if({incomplete(columns)}, NULL, struct({', '.join(columns)}))"
    df = extend(
        df,
        {
            "_filled": t.over(f"last({reading}, true)", last_rows(params.fill_rows + 1)),
            "first_sec": t.over("min(sec)", EVERYTHING),
            "last_sec": t.over("max(sec)", EVERYTHING),
        },
    )
    return extend(
        df,
        {f"{c}__filled": f"_filled.{c}" for c in columns}
        | {"present": "_filled IS NOT NULL", "is_fill": f"_filled IS NOT NULL AND {incomplete(columns)}"},
    ).drop("_filled")


def fill_neighbour(t: Timeline) -> dict[str, str]:
    """First level of :func:`consec_filling`."""
    return {"_slot": t.over("row_number()"), "_after_fill": yes(t.lag("is_fill"))}


def fill_counter(t: Timeline) -> dict[str, str]:
    """Second level of :func:`consec_filling`: slots since the last one that was neither filled nor right after."""
    inside = "(is_fill OR _after_fill)"
    outside = t.over(f"max(if({inside}, NULL, _slot))", SO_FAR)
    return {"fill_count": f"if({inside}, _slot - coalesce({outside}, 0), 0)"}


def consec_filling(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Count along filled slots and the one slot after each; gaps one valid slot apart keep counting.

    Needs :func:`fill_gaps`; adds ``fill_count``.
    """
    t = Timeline(keys)
    return extend(extend(df, fill_neighbour(t)), fill_counter(t)).drop("_slot", "_after_fill")
