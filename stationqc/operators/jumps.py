"""Implausible steps between neighbouring values, for raw readings and for bin averages alike."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stationqc.functions.columns import any_of, extend, flag, number, rint2, yes
from stationqc.functions.windows import KEYS, SO_FAR, Timeline, last_seconds, older_than
from stationqc.params import (
    CODE_INVALID,
    CODE_NO_DATUM,
    CODE_UNIDENTIFIED,
    JUMPING,
    RAIN,
    VARIABLES,
    ModelParams,
)

RAW_FLAGS = ("obc", "invalid", "unidentified", "no_datum", "const", "long", "frozen")


@dataclass(frozen=True)
class JumpRule:
    """One series to search. ``threshold``, ``availability`` and ``possible`` are SQL: literals or columns.

    A null threshold never fires. ``decimals`` rounds the median and the distances, as is done for bin averages.
    """

    name: str
    value: str
    threshold: str
    availability: str
    possible: str  # values a full median window holds
    decimals: bool = False
    shared_count: str | None = None  # values in the median window, where series have their gaps in common

    @property
    def counted(self) -> str:
        return self.shared_count or f"_{self.name}_count"

    # Where the columns of the levels below are: what a verdict reads of this value and of those around it.

    @property
    def came(self) -> str:
        return f"_{self.name}_came"

    @property
    def left(self) -> str:
        return f"_{self.name}_left"

    @property
    def same(self) -> str:
        return f"_{self.name}_same"

    @property
    def couple(self) -> str:
        return f"{self.name}__couple = 1"

    @property
    def away(self) -> str:
        return f"{self.name}__median_diff"

    @property
    def no_median(self) -> str:
        return f"{self.name}__median IS NULL"

    @property
    def prev_away(self) -> str:
        return f"_{self.name}_prev_md"

    @property
    def next_away(self) -> str:
        return f"_{self.name}_next_md"

    @property
    def prev2_away(self) -> str:
        return f"_{self.name}_prev2_md"

    @property
    def prev_came(self) -> str:
        return f"_{self.name}_prev_came"

    def rounded(self, sql: str) -> str:
        return rint2(sql) if self.decimals else sql

    def jumped(self, a: str, b: str) -> str:
        return yes(f"abs({a} - {b}) > {self.threshold}")


@dataclass(frozen=True)
class PackedRule(JumpRule):
    """A rule of the slot stage, whose rows stay narrow: the steps of all rules are bits of ``_steps`` (:func:`step_bits`), their
    distances from the medians a struct that only rows beside a jump have (:func:`packed_distances`). A verdict reads no others."""

    place: int = 0

    def bit(self, n: int) -> int:
        return 1 << (3 * self.place + n)

    def has(self, bits: int, steps: str = "_steps") -> str:
        return f"(({steps} & {bits}) <> 0)"

    @property
    def came(self) -> str:
        return self.has(self.bit(0))

    @property
    def left(self) -> str:
        return self.has(self.bit(1))

    @property
    def same(self) -> str:
        return self.has(self.bit(2))

    @property
    def couple(self) -> str:
        return self.has(self.bit(0) | self.bit(1))

    @property
    def away(self) -> str:
        return f"_away.{self.name}"

    @property
    def no_median(self) -> str:
        # A value beside a jump is not null, so its distance is null only for want of a median.
        return f"_away.{self.name} IS NULL"

    @property
    def prev_away(self) -> str:
        return f"_before.{self.name}"

    @property
    def next_away(self) -> str:
        return f"_after.{self.name}"

    @property
    def prev2_away(self) -> str:
        return f"_before_that.{self.name}"

    @property
    def prev_came(self) -> str:
        return self.has(self.bit(0), "_before.steps")


# ---- levels: each set of columns depends on the one before it -----------------------------------


def neighbours(rules: Sequence[JumpRule], t: Timeline) -> dict[str, str]:
    """The values on either side."""
    return {f"_{r.name}_prev": t.lag(r.value) for r in rules} | {f"_{r.name}_next": t.lead(r.value) for r in rules}


def middles(rules: Sequence[JumpRule], seconds: int, t: Timeline) -> dict[str, str]:
    """Median of the last ``seconds``, however few values there are."""
    return {f"_{r.name}_mid": t.over(f"percentile({r.value}, 0.5D)", last_seconds(seconds)) for r in rules}


def recent_values(rules: Sequence[JumpRule], seconds: int, t: Timeline, wanted: str = "true") -> dict[str, str]:
    """All series' values of the last ``seconds`` in one list, for series that have their gaps in common; only of ``wanted`` rows."""
    values = ", ".join(f"{r.value} AS {r.name}" for r in rules)
    wanted = f"present AND {wanted}"
    return {"_recent_values": t.over(f"collect_list(if({wanted}, struct({values}), NULL))", last_seconds(seconds))}


def sorted_values(rules: Sequence[JumpRule], everywhere: bool) -> dict[str, str]:
    """Each series' recent values in order, on all rows or on the two sides of its jumps only."""
    return {
        f"_{r.name}_sorted": f"if({'true' if everywhere else r.couple}, sort_array(_recent_values.{r.name}), NULL)"
        for r in rules
    }


def middles_of_sorted(rules: Sequence[JumpRule]) -> dict[str, str]:
    """Median from the sorted values."""
    columns = {}
    for r in rules:
        s = f"_{r.name}_sorted"
        low, high = f"try_element_at({s}, int((size({s}) + 1) div 2))", f"try_element_at({s}, int(size({s}) div 2 + 1))"
        columns[f"_{r.name}_mid"] = f"if(size({s}) > 0, ({low} + {high}) / 2, NULL)"
    return columns


def recent_counts(rules: Sequence[JumpRule], seconds: int, t: Timeline) -> dict[str, str]:
    """Values in the last ``seconds``: the ones so far less the ones before that."""
    return {
        f"_{r.name}_count": f"{t.over(f'count({r.value})', SO_FAR)} - {t.over(f'count({r.value})', older_than(seconds - 1))}"
        for r in rules
    }


def steps(rules: Sequence[JumpRule]) -> dict[str, str]:
    """Steps over the threshold to and from each value, ``{name}__couple`` for either, and ``{name}__diff``."""
    columns: dict[str, str] = {}
    for r in rules:
        came, left = r.jumped(r.value, f"_{r.name}_prev"), r.jumped(f"_{r.name}_next", r.value)
        columns[f"_{r.name}_came"] = came
        columns[f"_{r.name}_left"] = left
        columns[f"_{r.name}_same"] = yes(f"{r.value} = _{r.name}_prev")
        columns[f"{r.name}__couple"] = flag(f"{came} OR {left}")
        columns[f"{r.name}__diff"] = r.rounded(f"abs({r.value} - _{r.name}_prev)")
    return columns


def step_bits(rules: Sequence[PackedRule]) -> dict[str, str]:
    """:func:`steps` of all rules in one number, ``_steps``; and ``{name}__diff``."""
    bits = []
    columns: dict[str, str] = {}
    for r in rules:
        prev = f"_{r.name}_prev"
        told = (r.jumped(r.value, prev), r.jumped(f"_{r.name}_next", r.value), yes(f"{r.value} = {prev}"))
        bits += [f"if({condition}, {r.bit(n)}, 0)" for n, condition in enumerate(told)]
        columns[f"{r.name}__diff"] = r.rounded(f"abs({r.value} - {prev})")
    return {"_steps": " | ".join(bits)} | columns


def packed_couples(rules: Sequence[PackedRule]) -> dict[str, str]:
    return {f"{r.name}__couple": flag(r.couple) for r in rules}


def packed_distances(rules: Sequence[PackedRule]) -> dict[str, str]:
    """``_away``: the steps of a row beside a jump and its distances from the medians; null on all other rows."""
    away = ", ".join(f"{r.name}__median_diff AS {r.name}" for r in rules)
    return {"_away": f"if({any_of(r.couple for r in rules)}, struct(_steps AS steps, {away}), NULL)"}


def packed_distances_around(t: Timeline) -> dict[str, str]:
    return {"_before": t.lag("_away"), "_after": t.lead("_away"), "_before_that": t.over("lag(_away, 2)")}


def medians(rules: Sequence[JumpRule]) -> dict[str, str]:
    """``{name}__median``: null where too few values are there."""
    return {
        f"{r.name}__median": f"if({r.counted} / {r.possible} < {r.availability}, NULL, {r.rounded(f'_{r.name}_mid')})"
        for r in rules
    }


def distances(rules: Sequence[JumpRule]) -> dict[str, str]:
    return {f"{r.name}__median_diff": r.rounded(f"abs({r.value} - {r.name}__median)") for r in rules}


def distances_around(rules: Sequence[JumpRule], t: Timeline) -> dict[str, str]:
    """Distances of the values around, as far as blaming this one and the one before it takes."""
    columns: dict[str, str] = {}
    for r in rules:
        md = f"{r.name}__median_diff"
        columns[f"_{r.name}_prev_md"] = t.lag(md)
        columns[f"_{r.name}_next_md"] = t.lead(md)
        columns[f"_{r.name}_prev2_md"] = t.over(f"lag({md}, 2)")
        columns[f"_{r.name}_prev_came"] = t.lag(f"_{r.name}_came")
    return columns


def blamed(r: JumpRule) -> str:
    """On either side of a jump, the value farther from its own median. A tie blames neither."""
    return yes(f"({r.came} AND {r.away} > {r.prev_away})") + " OR " + yes(f"({r.left} AND {r.away} > {r.next_away})")


def previous_blamed(r: JumpRule) -> str:
    """The same, for the value before this one."""
    return yes(f"({r.prev_came} AND {r.prev_away} > {r.prev2_away})") + " OR " + yes(
        f"({r.came} AND {r.prev_away} > {r.away})"
    )


def flags(rules: Sequence[JumpRule]) -> dict[str, str]:
    """``{name}__invalid``: blamed, or equal to a blamed value just before it (one step only).

    ``{name}__unidentified``: part of a jump without a median to judge by.
    """
    columns: dict[str, str] = {}
    for r in rules:
        repeat = f"{r.same} AND ({previous_blamed(r)})"
        columns[f"{r.name}__invalid"] = flag(f"{blamed(r)} OR ({repeat})", CODE_INVALID)
        columns[f"{r.name}__unidentified"] = flag(f"{r.no_median} AND {r.couple}", CODE_UNIDENTIFIED)
    return columns


HELPERS = (
    "count",
    "mid",
    "prev",
    "next",
    "came",
    "left",
    "same",
    "prev_md",
    "next_md",
    "prev2_md",
    "prev_came",
)


def helper_columns(rules: Sequence[JumpRule]) -> list[str]:
    return [f"_{r.name}_{h}" for r in rules for h in HELPERS]


def search_steps(df: DataFrame, rules: Sequence[JumpRule], seconds: int, t: Timeline) -> DataFrame:
    """All columns a verdict depends on: two Window nodes."""
    df = extend(df, neighbours(rules, t) | middles(rules, seconds, t) | recent_counts(rules, seconds, t))
    df = extend(extend(df, steps(rules) | medians(rules)), distances(rules))
    return extend(df, distances_around(rules, t))


def search_jumps(df: DataFrame, rules: Sequence[JumpRule], seconds: int, t: Timeline) -> DataFrame:
    """Medians on every row, and all flags."""
    return extend(search_steps(df, rules, seconds, t), flags(rules)).drop(*helper_columns(rules))


# ---- raw readings ------------------------------------------------------------------------------


def raw_rules(params: ModelParams, columns: Sequence[str] = JUMPING) -> list[JumpRule]:
    return [JumpRule(*_raw_rule(params, p)) for p in columns]


def packed_rules(params: ModelParams, shared_count: str, columns: Sequence[str] = JUMPING) -> list[PackedRule]:
    return [PackedRule(*_raw_rule(params, p), shared_count=shared_count, place=i) for i, p in enumerate(columns)]


def _raw_rule(params: ModelParams, p: str) -> tuple[str, str, str, str, str]:
    v = params.of(p)
    possible = number(params.median_minutes * 60 / params.step)
    return p, f"{p}__filled", number(v.raw_jump), number(v.median_availability), possible


def raw_median(
    df: DataFrame, params: ModelParams, columns: Sequence[str] = JUMPING, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Median of the filled readings over the last 10 or 60 minutes, this reading included."""
    rules, seconds, t = raw_rules(params, columns), params.median_minutes * 60, Timeline(keys)
    df = extend(df, middles(rules, seconds, t) | recent_counts(rules, seconds, t))
    return extend(df, medians(rules)).drop(*helper_columns(rules))


def raw_jumps(
    df: DataFrame, params: ModelParams, columns: Sequence[str] = JUMPING, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Medians, distances and jump flags of the raw readings."""
    return search_jumps(df, raw_rules(params, columns), params.median_minutes * 60, Timeline(keys))


def not_applicable() -> dict[str, str]:
    doubles, ints = ("median", "diff", "median_diff"), ("couple", "invalid", "unidentified")
    columns = {f"{p}__{c}": "CAST(NULL AS DOUBLE)" for p in ("wind_direction", RAIN) for c in doubles}
    return columns | {f"{p}__{c}": "CAST(NULL AS INT)" for p in ("wind_direction", RAIN) for c in ints}


def jump_not_applicable(df: DataFrame) -> DataFrame:
    """Wind direction wraps around and rain accumulates: no jump columns for them."""
    return extend(df, not_applicable())


def no_datum_columns(columns: Sequence[str] = VARIABLES) -> dict[str, str]:
    return {f"{p}__no_datum": flag(f"{p} IS NULL", CODE_NO_DATUM) for p in columns}


def no_datum(df: DataFrame, columns: Sequence[str] = VARIABLES) -> DataFrame:
    """An original reading is missing; filled or not makes no difference."""
    return extend(df, no_datum_columns(columns))


def raw_total(df: DataFrame, columns: Sequence[str] = VARIABLES) -> DataFrame:
    """``{p}__faulty``: any flag set. The reward flag is the same by definition."""
    return extend(df, {f"{p}__faulty": flag(any_of(yes(f"{p}__{f} > 0") for f in RAW_FLAGS)) for p in columns})
