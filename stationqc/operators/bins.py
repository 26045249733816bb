"""First aggregation level: readings into bins of 1, 2 or 60 minutes, one row per (series, parameter, bin).

From here on the seven variables are rows, not columns. Bins are labelled by their left edge.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.functions.columns import (
    any_of,
    extend,
    flag,
    floor_to,
    named,
    number,
    rint2,
    vector_direction,
    vector_speed,
    wind_u,
    wind_v,
    yes,
)
from stationqc.functions.windows import KEYS, Timeline
from stationqc.operators.annotate import BIN_TEXTS, append_text
from stationqc.operators.constancy import LONG_CHECKED
from stationqc.operators.jumps import RAW_FLAGS, JumpRule, search_jumps
from stationqc.params import (
    GAUGE_MM,
    JUMPING,
    RAIN,
    STICKING,
    VARIABLES,
    WARMUP_MINUTES,
    WIND,
    ModelParams,
    VariableParams,
)

SEARCHED = "parameter IN (" + ", ".join(f"'{p}'" for p in JUMPING) + ")"


def by_parameter(params: ModelParams, value: Callable[[VariableParams], float | None]) -> str:
    """A parameter-table value for the row's ``parameter``."""
    cases = " ".join(f"WHEN '{v.parameter}' THEN {number(value(v))}" for v in params.variables)
    return f"(CASE parameter {cases} END)"


def per_kind(speed: str, direction: str, rain: str, scalar: str) -> str:
    return (
        f"CASE parameter WHEN 'wind_speed' THEN {speed} WHEN 'wind_direction' THEN {direction} "
        f"WHEN '{RAIN}' THEN {rain} ELSE {scalar} END"
    )


SCALARS = tuple(p for p in VARIABLES if p not in (*WIND, RAIN))

# Flags a variable can have at all.
APPLICABLE = {
    p: {"obc", "no_datum"}
    | ({"invalid", "unidentified"} if p in JUMPING else set())
    | ({"const"} if p in STICKING else set())
    | ({"long"} if p in LONG_CHECKED else set())
    | ({"frozen"} if p in WIND else set())
    for p in VARIABLES
}
NULL_DOUBLE = "CAST(NULL AS DOUBLE)"


def _partials(p: str, params: ModelParams, texts: bool, means: str) -> dict[str, str]:
    """Sums and counts of one variable that add up over time; the same names for every variable."""
    u, v = (f(*WIND) if p in WIND else None for f in (wind_u, wind_v))

    def total(value: str | None) -> str:
        return f"sum({value})" if value and means != "none" else NULL_DOUBLE

    def clean(value: str | None) -> str:
        return f"sum(if({p}__faulty = 0, {value}, NULL))" if value and means == "all" else NULL_DOUBLE

    scalar = p if p in SCALARS else None
    limit = number(params.of(p).bin_minutes * 60 * GAUGE_MM)
    columns = {
        "total": total(scalar),
        "total_clean": clean(scalar),
        "u": total(u),
        "v": total(v),
        "u_clean": clean(u),
        "v_clean": clean(v),
        "rain": total(f"if(precip_diff > 0 AND precip_diff <= {limit}, precip_diff, NULL)" if p == RAIN else None),
    }
    columns |= {f"_sum{i}": packed_sum(p, some) for i, some in enumerate(_packs(p))}
    if texts:
        columns["texts"] = f"collect_list(struct(sec, {p}__text AS text))"
    return columns


#: Bits of a count among those that are added up in one number, counts in a number, and the most rows of a bin that fit.
COUNT_BITS, PACKED = 21, 3
MOST_ROWS = (1 << COUNT_BITS) - 1


def _packs(p: str) -> list[list[str]]:
    """The flags of a variable, and its faulty readings, in threes that are counted in one sum."""
    names = ["faulty", *[f for f in RAW_FLAGS if f in APPLICABLE[p]]]
    return [names[i : i + PACKED] for i in range(0, len(names), PACKED)]


def packed_sum(p: str, names: Sequence[str]) -> str:
    """Rows with each flag, in one number: an aggregate's cost is that of its functions, and flags of variables are some fifty."""
    return f"sum({' + '.join(f'if({p}__{f} > 0, {1 << COUNT_BITS * n}L, 0L)' for n, f in enumerate(names))})"


def _counts(p: str, means: str) -> dict[str, str]:
    """The counts out of :func:`packed_sum`. A reading that is there lacks the flag of a missing one; a clean one is not faulty."""
    fits = f"if(num_total_slots > {MOST_ROWS}, CAST(raise_error('more rows in a bin than counts hold') AS BIGINT), {{}})"
    counts = {
        f: fits.format(f"shiftright({p}___sum{i}, {COUNT_BITS * n}) & {MOST_ROWS}L") if n < len(some) - 1 else fits.format(f"shiftright({p}___sum{i}, {COUNT_BITS * n})")
        for i, some in enumerate(_packs(p))
        for n, f in enumerate(some)
    }
    return {
        "num_time_slots": f"num_total_slots - {counts['no_datum']}",
        "num_faulty": counts["faulty"],
        "clean_slots": f"num_total_slots - {counts['faulty']}" if means == "all" else "0L",
    } | {f"n_{f}": counts.get(f, "0L") for f in RAW_FLAGS}


def bin_readings(
    slots: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS, texts: bool = False, means: str = "all"
) -> DataFrame:
    """Counts, plain and clean means, rain sums and flag counts per (series, parameter, bin). Needs the raw flags.

    The slots of the shortest bin are added up with all variables side by side first, and laid out as one row per
    variable only then: 4 or 20 times fewer rows than the slots themselves would make. Variables with longer bins are
    added up once more. Every aggregate is on a superset of the keys the rows are partitioned by: no shuffle.

    Columns inside the layout are out of the optimizer's sight, so callers say what they need: ``means`` is ``all``,
    ``plain`` (no clean means) or ``none``; what is left out is null.
    """
    shortest = min(v.bin_minutes for v in params.variables)
    partials = {p: _partials(p, params, texts, means) for p in VARIABLES}
    summed = [n for n in partials[RAIN] if not n.startswith("_sum")]
    names = [*_counts(RAIN, means), *summed]
    shared = {"num_total_slots": "count(1)", "first_sec": "max(first_sec)", "last_sec": "max(last_sec)"}
    side_by_side = {f"{p}__{n}": sql for p in VARIABLES for n, sql in partials[p].items()}
    start = F.expr(floor_to("sec", shortest * 60)).alias("bin")
    wide = slots.groupBy(*keys, "model", start).agg(*named(shared | side_by_side))
    laid_out = {p: _counts(p, means) | {n: f"{p}__{n}" for n in summed} for p in VARIABLES}
    readings = ", ".join(
        f"struct('{p}' AS parameter, {', '.join(f'{laid_out[p][n]} AS {n}' for n in names)})" for p in VARIABLES
    )
    # Not an unpivot: Spark forgets the partitioning across that, and would shuffle again for every aggregate after it.
    df = wide.selectExpr(*keys, "model", "bin", *shared, f"inline(array({readings}))")
    if any(v.bin_minutes != shortest for v in params.variables):
        cases = " ".join(f"WHEN '{v.parameter}' THEN {v.bin_minutes * 60}L" for v in params.variables)
        bin_start = F.expr(floor_to("bin", f"(CASE parameter {cases} END)")).alias("bin")
        sums = {"num_total_slots": "sum(num_total_slots)", "first_sec": "max(first_sec)", "last_sec": "max(last_sec)"}
        sums |= {n: f"sum({n})" if n != "texts" else "flatten(collect_list(texts))" for n in names}
        df = df.groupBy(*keys, "model", "parameter", bin_start).agg(*named(sums))
    columns = {
        "mean": "try_divide(total, double(num_time_slots))",
        "mean_clean": "try_divide(total_clean, double(clean_slots))",
    }
    columns |= {c: f"try_divide({c}, double(num_time_slots))" for c in ("u", "v")}
    columns |= {c: f"try_divide({c}, double(clean_slots))" for c in ("u_clean", "v_clean")}
    if texts:
        # One text per slot of the bin: 20 at most.
        columns["annotation"] = "ltrim(',', array_join(transform(array_sort(texts), x -> x.text), ','))"
    return extend(df, columns).drop("total", "total_clean", "clean_slots", "texts")


def bin_means(df: DataFrame, params: ModelParams) -> DataFrame:
    """``avg`` and ``avg_corrected`` of each bin, two decimals (rain: the sum, unrounded).

    Scalars are averaged, wind by its vector. The corrected value uses clean readings only and is null unless more than
    the required share is clean. Wind rows carry both ``speed_avg`` and ``direction_avg``.
    """
    required = by_parameter(params, lambda v: v.bin_availability)
    enough = f"(num_total_slots - num_faulty) / num_total_slots > {required}"
    df = extend(
        df,
        {
            "speed_avg": vector_speed("u", "v"),
            "direction_avg": vector_direction("u", "v"),
            "speed_avg_corrected": f"if({enough}, {vector_speed('u_clean', 'v_clean')}, NULL)",
            "direction_avg_corrected": f"if({enough}, {vector_direction('u_clean', 'v_clean')}, NULL)",
            "mean": rint2("mean"),
            "mean_clean": f"if({enough}, {rint2('mean_clean')}, NULL)",
            "rain": "coalesce(rain, 0D)",
        },
    )
    return extend(
        df,
        {
            "avg": per_kind("speed_avg", "direction_avg", "rain", "mean"),
            "avg_corrected": per_kind("speed_avg_corrected", "direction_avg_corrected", "rain", "mean_clean"),
            "u": rint2("u"),
            "v": rint2("v"),
        },
    )


def bin_jumps(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """Jump search over the bin averages, all parameters at once.

    Adds ``jump__*`` columns as :func:`stationqc.operators.jumps.search_jumps` does; null for wind direction and rain.
    """
    df = extend(
        df,
        {
            "_value": f"if({SEARCHED}, avg, NULL)",
            "_threshold": by_parameter(params, lambda v: v.bin_jump),
            "_required": by_parameter(params, lambda v: v.median_availability),
            "_possible": by_parameter(params, lambda v: params.median_minutes / v.bin_minutes),
        },
    )
    rule = JumpRule("jump", "_value", "_threshold", "_required", "_possible", decimals=True)
    df = search_jumps(df, [rule], params.median_minutes * 60, Timeline((*keys, "parameter"), "bin"))
    flags = ("couple", "invalid", "unidentified")
    df = extend(df, {f"jump__{c}": f"if({SEARCHED}, jump__{c}, NULL)" for c in flags})
    return df.drop("_value", "_threshold", "_required", "_possible")


def no_bin_jumps(df: DataFrame) -> DataFrame:
    """For a model without bin thresholds: nothing can be flagged."""
    return extend(df, {"jump__invalid": "0", "jump__unidentified": "0"})


def has_bin_jumps(params: ModelParams) -> bool:
    return any(v.bin_jump is not None for v in params.variables)


VALID = "double(num_total_slots - num_faulty)"
SHARE = f"try_divide({VALID}, double(num_total_slots))"
PERCENT = rint2(f"try_divide({VALID} * 100, double(num_total_slots))")


def bin_availability(df: DataFrame, params: ModelParams) -> DataFrame:
    """``ann_all_from_raw``: too few clean readings; ``valid_percentage`` to two decimals."""
    required = by_parameter(params, lambda v: v.bin_availability)
    return extend(df, {"ann_all_from_raw": flag(f"{SHARE} < {required}"), "valid_percentage": PERCENT})


def bin_availability_rewards(df: DataFrame, params: ModelParams) -> DataFrame:
    """The reward twin: a bin over the required share counts in full."""
    required = by_parameter(params, lambda v: v.bin_availability)
    return extend(
        df,
        {
            "ann_all_from_raw_rewards": flag(f"{SHARE} < {required}"),
            "valid_percentage_rewards": f"if({SHARE} > {required}, 100D, {PERCENT})",
        },
    )


def bin_total(df: DataFrame) -> DataFrame:
    """``ann_total`` / ``ann_total_rewards``: the bin is unusable for any reason."""
    jumped = any_of(yes(f"jump__{c} > 0") for c in ("invalid", "unidentified"))
    return extend(
        df,
        {
            "ann_total": flag(f"ann_all_from_raw > 0 OR {jumped}"),
            "ann_total_rewards": flag(f"ann_all_from_raw_rewards > 0 OR {jumped}"),
        },
    )


def bin_annotation_update(df: DataFrame) -> DataFrame:
    """Append the bin-level codes to the bin's text, in a fixed order."""
    for column, code in BIN_TEXTS.items():
        df = extend(df, {"annotation": append_text("annotation", f"{column} > 0", code)})
    return df


def warmup(params: ModelParams) -> str:
    """True for bins of the context at the start of a series, which serve the windows only and are not scored.

    The context is counted from the first bin there is.
    """
    cases = " ".join(f"WHEN '{v.parameter}' THEN {v.bin_minutes * 60}L" for v in params.variables)
    first_bin = floor_to("first_sec", f"(CASE parameter {cases} END)")
    return f"(bin <= {first_bin} + {(WARMUP_MINUTES - 1) * 60})"


def warmup_trim(df: DataFrame, params: ModelParams) -> DataFrame:
    return df.filter(f"NOT {warmup(params)}")
