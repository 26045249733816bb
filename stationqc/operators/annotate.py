"""Flag texts and the hourly and daily shares of each fault."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from stationqc.functions.columns import extend, json_pairs
from stationqc.params import VARIABLES

# Fault codes as users see them, in output order.
RAW_CODES = {
    "obc": "OBC",
    "invalid": "SPIKE_INST",
    "unidentified": "UNIDENTIFIED_SPIKE",
    "no_datum": "NO_DATA",
    "const": "SHORT_CONST",
    "long": "LONG_CONST",
    "frozen": "FROZEN_SENSOR",
}
BIN_CODES = {"invalid": "ANOMALOUS_INCREASE", "unidentified": "UNIDENTIFIED_ANOMALOUS_CHANGE"}
BIN_TEXTS = {
    "jump__invalid": "ANOMALOUS_INCREASE",
    "ann_all_from_raw": "NO_DATA_MIN",
    "jump__unidentified": "UNIDENTIFIED_ANOMALOUS_INCREASE",
}
HOURS_PER_DAY = 24

NO_CODES = "CAST(array() AS array<struct<code:string,pct:double>>)"


def text_annotation(df: DataFrame, columns: Sequence[str] = VARIABLES) -> DataFrame:
    """``{p}__text``: codes of the flags that are set, joined by commas; empty for a clean reading."""

    def text(p: str) -> str:
        return ", ".join(f"if({p}__{f} > 0, '{code}', NULL)" for f, code in RAW_CODES.items())

    return extend(df, {f"{p}__text": f"concat_ws(',', {text(p)})" for p in columns})


def append_text(text: str, condition: str, code: str) -> str:
    """Add a code to a comma-joined text unless the text already contains it."""
    return (
        f"CASE WHEN NOT coalesce({condition}, false) OR contains({text}, '{code}') THEN {text} "
        f"WHEN {text} = '' THEN '{code}' ELSE concat({text}, ',{code}') END"
    )


def codes_of(counts: Mapping[str, str], total: str) -> str:
    """Array of (code, pct) for the codes with a count, however small; pct of the total, half-even to one decimal."""
    shares = ", ".join(
        f"struct('{code}' AS code, try_divide(double({n}), double({total})) * 100 AS pct)" for code, n in counts.items()
    )
    with_count = f"filter(array({shares}), x -> x.pct > 0)"
    return f"coalesce(transform({with_count}, x -> struct(x.code AS code, bround(x.pct, 1) AS pct)), {NO_CODES})"


def daily_param_codes(hourly: str) -> str:
    """(code, pct) over a day from its hours' lists (an array of arrays in hour order).

    Always a 24th per hour, however many hours there are; codes in the order they first appear. The sum runs hour by
    hour, so its digits do not depend on how the data were partitioned.
    """
    flat = f"flatten({hourly})"
    share = (
        f"aggregate(filter({flat}, x -> x.code = c), 0D, (total, x) -> total + x.pct / {HOURS_PER_DAY})"
    )
    return f"transform(array_distinct(transform({flat}, x -> x.code)), c -> struct(c AS code, {share} AS pct))"


def daily_codes_json(daily: Mapping[str, str]) -> str:
    """``{"CODE": [["variable", pct], ...], ...}`` over all variables; codes sorted, variables in the order given."""
    codes = ", ".join(f"transform({pairs}, x -> x.code)" for pairs in daily.values())
    holders = ", ".join(
        f"transform(filter({pairs}, x -> x.code = c), x -> struct('{p}' AS code, x.pct AS pct))"
        for p, pairs in daily.items()
    )
    members = (
        f"transform(array_sort(array_distinct(flatten(array({codes})))), "
        f"c -> concat('\"', c, '\": ', {json_pairs(f'flatten(array({holders}))')}))"
    )
    return f"concat('{{', array_join({members}, ', '), '}}')"
