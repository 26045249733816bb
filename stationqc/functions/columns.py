"""Spark SQL expression snippets used by more than one operator.

Operators state their columns as SQL expressions and add them a level at a time (:func:`extend`): a level is one
projection or one Window node however many columns it has, which keeps plans of this width short.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def extend(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add columns, or replace those that exist, in one projection."""
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    return df.selectExpr(*kept, *[f"{sql} AS `{name}`" for name, sql in columns.items()])


def named(expressions: Mapping[str, str]) -> list[Column]:
    """The same as Columns, for ``agg``."""
    return [F.expr(sql).alias(name) for name, sql in expressions.items()]


def epoch_seconds(timestamp: str) -> str:
    """Whole seconds since 1970 of a timestamp without time zone."""
    return f"timestampdiff(SECOND, {EPOCH}, {timestamp})"


def timestamp_of(seconds: str) -> str:
    """Inverse of :func:`epoch_seconds`."""
    return f"timestampadd(SECOND, {seconds}, {EPOCH})"


def floor_to(sec: str, seconds: int | str) -> str:
    return f"({sec} - {sec} % {seconds})"


def number(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"{float(value)!r}D"


def any_of(conditions: Iterable[str]) -> str:
    return "(" + " OR ".join(conditions) + ")"


def yes(condition: str) -> str:
    """A condition that is false when unknown."""
    return f"coalesce({condition}, false)"


def flag(condition: str, code: int = 1) -> str:
    """``code`` where the condition holds, 0 where it does not or is unknown."""
    return f"if({condition}, {code}, 0)"


def rint2(value: str) -> str:
    """Round half-even to two decimals.

    Averages of short decimals land on exact halves; summation noise far below the ninth decimal is removed first, so
    the side a half falls to does not depend on the order rows were added up in.
    """
    return f"(rint(round({value}, 9) * 100) / 100)"


def wind_u(speed: str, direction: str) -> str:
    return f"(-{speed} * sin({direction} * {math.pi!r}D / 180D))"


def wind_v(speed: str, direction: str) -> str:
    return f"(-{speed} * cos({direction} * {math.pi!r}D / 180D))"


def vector_speed(u: str, v: str) -> str:
    return rint2(f"sqrt({u} * {u} + {v} * {v})")


def vector_direction(u: str, v: str) -> str:
    """Bearing the wind comes from; a mean of exactly 180 stays as it is."""
    bearing = f"degrees(atan2({u}, {v}))"
    return rint2(f"({bearing} + CASE WHEN {bearing} < 180 THEN 180D WHEN {bearing} > 180 THEN -180D ELSE 0D END)")


def json_pairs(pairs: str) -> str:
    """``[["CODE", 5.0], ...]`` text of an array of (code, pct) structs."""
    return (
        f"concat('[', array_join(transform({pairs}, x -> concat('[\"', x.code, '\", ', string(x.pct), ']')), ', '), ']')"
    )
