"""The slot stage: every check on raw readings, on one wide row per slot.

Input: ``device_id, qod_date, model, sec`` and the seven variables, one row per slot. All windows share one partitioning
and one order, so the whole stage is one exchange. The operators' levels are interleaved: independent columns of
different checks share a Window node, and rows are narrowed between nodes: what a check knows of a row is a bit of a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stationqc.functions.columns import any_of, extend
from stationqc.functions.windows import KEYS, SO_FAR, Timeline, older_than, until
from stationqc.operators import bounds, constancy, fill, jumps
from stationqc.operators.annotate import text_annotation
from stationqc.params import VARIABLES, ModelParams


def filled_slots(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    return fill.fill_gaps(fill.null_incomplete_rows(df), params, keys=keys)


def bounded_slots(df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS) -> DataFrame:
    df = fill.consec_filling(filled_slots(df, params, keys), keys)
    return bounds.obc_precip(bounds.precip_diff(bounds.obc_bounds(df, params), keys), params)


def medians_where_needed(
    df: DataFrame, rules: Sequence[jumps.PackedRule], seconds: int, everywhere: bool, keys: Sequence[str]
) -> DataFrame:
    """All medians, computed where a flag depends on them.

    A jump needs the medians of its two sides, i.e. the readings of the ``seconds`` up to each: only rows that a jump ahead reaches
    back to are gathered. A tied row needs those of its long windows, so only series with such a row gather their readings. All
    windows keep the partitions and the order of the others: neither a shuffle nor a sort. ``everywhere`` gathers all rows for the
    jumps and computes every median.
    """
    t = Timeline(keys)
    # Jump rows ahead within reach put this row into their neighbourhood.
    near = "true" if everywhere else "_jump_ahead IS NOT NULL AND _jump_ahead >= sec"
    candidates = constancy.median_candidates(constancy.is_stuck)
    ties = constancy.tied_series(t, candidates, constancy.packed_tie)
    df = extend(df, ties | jumps.recent_values(rules, seconds, t, near))
    df = extend(df, jumps.sorted_values(rules, everywhere)).drop("_recent_values", "_jump_ahead")
    df = extend(df, jumps.middles_of_sorted(rules)).drop(*[f"_{r.name}_sorted" for r in rules])
    df = extend(df, constancy.readings_of_tied(t, candidates))
    return extend(df, constancy.middles_of_tied(candidates)).drop("_tied", "_readings")


def checked_slots(
    df: DataFrame, params: ModelParams, keys: Sequence[str] = KEYS, audit: bool = False
) -> DataFrame:
    """All raw flags of all variables; ``{p}__faulty`` and ``{p}__text`` sum them up.

    ``audit`` computes the moving medians of all rows, not only of those a flag depends on.
    """
    t = Timeline(keys)
    seconds = params.median_minutes * 60
    rules = jumps.packed_rules(params, shared_count="_recent")
    # A reading is what was filled in without being carried, so the originals need not travel along.
    df = filled_slots(df, params, keys).drop(*VARIABLES)
    # counts so far, neighbours
    count = "count(if(present, 1, NULL))"
    df = extend(
        df,
        fill.fill_neighbour(t)
        | bounds.precip_diff_column(t)
        | constancy.window_rows(t)
        | constancy.readings_seen(t)
        | constancy.low_counts(t)
        | constancy.last_reading(t)
        | jumps.neighbours(rules, t)
        | {"_recent": f"{t.over(count, SO_FAR)} - {t.over(count, older_than(seconds - 1))}"},
    )
    df = extend(df, jumps.step_bits(rules) | constancy.packed_previous() | constancy.packed_tests())
    # runs of equal readings, jumps ahead
    jump = any_of(r.couple for r in rules)
    df = extend(
        df,
        fill.fill_counter(t)
        | constancy.run_starts(t, changed=constancy.packed_changed)
        | {"_jump_ahead": t.over(f"max(if({jump}, sec, NULL))", until(seconds - 1))},
    )
    df = extend(df, constancy.packed_stuck(params))
    df = medians_where_needed(df, rules, seconds, audit, keys)
    df = extend(df, jumps.medians(rules) | constancy.packed_settled())
    df = extend(df, jumps.distances(rules) | constancy.verdicts(constancy.is_stuck, constancy.packed_before))
    df = extend(df, jumps.packed_distances(rules))
    # hits onto the windows before them, sides of a jump against each other
    df = extend(df, constancy.spread(params, t) | jumps.packed_distances_around(t))
    df = extend(df, {p: f"if(is_fill, NULL, {p}__filled)" for p in VARIABLES})
    df = extend(
        df,
        constancy.constancy_flags()
        | jumps.flags(rules)
        | jumps.packed_couples(rules)
        | jumps.not_applicable()
        | jumps.no_datum_columns()
        | bounds.bounds_columns(params)
        | bounds.obc_precip_column(params),
    )
    if not params.two_level:
        df = constancy.wind_coupling(df)
    df = df.drop(*[c for c in df.columns if c.startswith("_")])
    return text_annotation(jumps.raw_total(df))
