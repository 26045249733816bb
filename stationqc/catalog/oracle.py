"""Independent SQL for every query, for DuckDB.

Written from the definitions, with plain moving frames, distinct counts and medians in frames, and per-row set logic,
so that it shares no technique with the Spark operators. ``chain`` holds one named step per intermediate table of one
model; a query's SQL is the steps it needs and a SELECT, for both models.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from stationqc.catalog.view import SLOTS, START, VIEW_SQL

V = (
    "temperature",
    "humidity",
    "wind_speed",
    "wind_direction",
    "pressure",
    "illuminance",
    "precipitation_accumulated",
)
RAIN = "precipitation_accumulated"
SIX = V[:6]
FIVE = ("temperature", "humidity", "wind_speed", "pressure", "illuminance")
SCALARS = ("temperature", "humidity", "pressure", "illuminance")
WIND = ("wind_speed", "wind_direction")

# Fixed values, stated a second time on purpose: a wrong number in one place must not be right in both.
STEP = {"WS1000": 16, "WS2000": 180}
FILL_ROWS = {"WS1000": 4, "WS2000": 1}
FILL_SECONDS = {"WS1000": 60, "WS2000": 180}
MEDIAN_MINUTES = {"WS1000": 10, "WS2000": 60}
BIN = {
    "WS1000": dict(zip(V, (1, 1, 2, 2, 1, 1, 1))),
    "WS2000": dict(zip(V, (60,) * 7)),
}
BIN_AVAILABILITY = {"WS1000": 0.25, "WS2000": 0.9}
MEDIAN_AVAILABILITY = dict(zip(V, (0.67, 0.67, 0.75, 0.75, 0.67, 0.67, None)))
HOUR_AVAILABILITY = dict(zip(V, (0.67, 0.67, 0.75, 0.75, 0.67, 0.67, 0.85)))
RAW_JUMP = {
    "WS1000": dict(zip(V, (2.0, 5.0, 20.0, None, 0.8, 97600.0, None))),
    "WS2000": dict(zip(V, (9.0, 30.0, 15.0, None, 2.4000000000000004, 146400.0, None))),
}
BIN_JUMP = {
    "WS1000": dict(zip(V, (3.0, 10.0, 10.0, None, 0.5, 97600.0, None))),
    "WS2000": dict(zip(V, (None,) * 7)),
}
STUCK = dict(zip(V, (240, 360, 360, 360, 120, 120, None)))
STUCK_LONG = dict(zip(V, (1440, None, 1440, 1440, None, None, None)))
LOWER = {
    "WS1000": dict(zip(V, (-40, 10, 0, 0, 300, 0, 0))),
    "WS2000": dict(zip(V, (-40, 1, 0, 0, 540, 0, 0))),
}
UPPER = {
    "WS1000": dict(zip(V, (60, 99, 50, 359, 1100, 400000, 0.254 * 16))),
    "WS2000": dict(zip(V, (80, 99, 50, 359, 1100, 200000, 0.254 * 180))),
}
RAW_CODES = {
    "obc": "OBC",
    "invalid": "SPIKE_INST",
    "unid": "UNIDENTIFIED_SPIKE",
    "nodat": "NO_DATA",
    "const": "SHORT_CONST",
    "long": "LONG_CONST",
    "frozen": "FROZEN_SENSOR",
}
# Flags as the Spark side calls them.
SPARK_NAME = {"unid": "unidentified", "nodat": "no_datum"}

DAY0 = "CAST(epoch(TIMESTAMP '2024-01-01 00:00:00') AS BIGINT)"


def lit(x: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if x is None else f"CAST({float(x)!r} AS DOUBLE)"


def rint2(x: str) -> str:
    return f"(round_even(round({x}, 9) * 1e2, 0) / 1e2)"


def r6(columns: Sequence[str]) -> list[str]:
    return [f"round({c}, 6) AS {c}" for c in columns]


def case(values: dict[str, float | None]) -> str:
    return "(CASE parameter " + " ".join(f"WHEN '{p}' THEN {lit(x)}" for p, x in values.items()) + " END)"


def speed(u: str, v: str) -> str:
    return rint2(f"sqrt({u} * {u} + {v} * {v})")


def direction(u: str, v: str) -> str:
    d = f"degrees(atan2({u}, {v}))"
    return rint2(f"(CASE WHEN {d} < 180 THEN {d} + 180 WHEN {d} > 180 THEN {d} - 180 ELSE {d} END)")


def uv(s: str, d: str) -> tuple[str, str]:
    return f"(-1 * {s} * sin({d} * pi() / 18e1))", f"(-1 * {s} * cos({d} * pi() / 18e1))"


def json_agg(order: str) -> str:
    return f"""'[' || coalesce(string_agg('["' || code || '", ' || CAST(pct AS VARCHAR) || ']', ', ' ORDER BY {order}), '') || ']'"""


def chain(m: str) -> dict[str, str]:
    """Every step for one model."""
    W = "PARTITION BY device_id ORDER BY sec"
    steps: dict[str, str] = {}
    view = VIEW_SQL.format(N=SLOTS[m], step=STEP[m], model=m, T0=f"TIMESTAMP '{START}'", events="events")
    steps["view"] = view
    steps["tel"] = "SELECT *, CAST(epoch(utc_datetime) AS BIGINT) AS sec FROM view"
    whole = " AND ".join(f"{p} IS NOT NULL" for p in V)
    steps["n1"] = (
        "SELECT device_id, model, utc_datetime, sec, "
        + ", ".join(f"CASE WHEN {whole} THEN {p} END AS {p}" for p in V)
        + " FROM tel"
    )
    # gaps: a valid reading and the nulls after it form a group
    steps["g0"] = f"SELECT *, count(pressure) OVER ({W}) AS grp FROM n1"
    steps["g1"] = "SELECT *, row_number() OVER (PARTITION BY device_id, grp ORDER BY sec) - 1 AS since FROM g0"
    in_reach = f"grp > 0 AND since <= {FILL_ROWS[m] + 1}"
    steps["fill"] = (
        "SELECT *, "
        + ", ".join(
            f"CASE WHEN {in_reach} THEN first_value({p}) OVER (PARTITION BY device_id, grp ORDER BY sec) END AS {p}_f"
            for p in V
        )
        + f", (pressure IS NULL AND {in_reach}) AS is_fill, "
        + "min(sec) OVER (PARTITION BY device_id) AS first_sec, max(sec) OVER (PARTITION BY device_id) AS last_sec FROM g1"
    )
    steps["k0"] = f"SELECT *, is_fill OR coalesce(lag(is_fill) OVER ({W}), false) AS inside FROM fill"
    steps["k1"] = f"SELECT *, count(*) FILTER (NOT inside) OVER ({W}) AS island FROM k0"
    steps["consec"] = (
        "SELECT *, CASE WHEN inside THEN CAST(count(*) FILTER (inside) OVER (PARTITION BY device_id, island ORDER BY sec)"
        " AS INTEGER) ELSE 0 END AS fill_count FROM k1"
    )
    steps["obc0"] = (
        "SELECT *, "
        + ", ".join(
            f"CASE WHEN {p} < {lit(LOWER[m][p])} OR {p} > {lit(UPPER[m][p])} THEN 1 ELSE 0 END AS {p}_obc" for p in SIX
        )
        + f", {RAIN}_f - lag({RAIN}_f) OVER ({W}) AS precip_diff FROM consec"
    )
    steps["obc"] = (
        f"SELECT *, CASE WHEN precip_diff > {lit(UPPER[m][RAIN])} * (fill_count + 1) OR precip_diff < 0 THEN 1 ELSE 0 END"
        f" AS {RAIN}_obc FROM obc0"
    )

    # ---- stuck sensors: moving frames [t - w, t) and (t, t + w] ----
    def past(minutes: int) -> str:
        return f"({W} RANGE BETWEEN {minutes * 60} PRECEDING AND 1 PRECEDING)"

    def ahead(minutes: int) -> str:
        return f"({W} RANGE BETWEEN 1 FOLLOWING AND {minutes * 60} FOLLOWING)"

    steps["c0"] = (
        "SELECT *, "
        + ", ".join(
            f"count(*) FILTER (sec >= last_sec - {w * 60} AND sec < last_sec) OVER (PARTITION BY device_id) AS rows_{w}"
            for w in (120, 240, 360, 1440)
        )
        + " FROM fill"
    )
    columns = [f"count({p}_f) OVER {past(STUCK[p])} AS {p}_n" for p in SIX]
    columns += [f"count(DISTINCT {p}_f) OVER {past(STUCK[p])} AS {p}_d" for p in SIX]
    columns += [f"count({p}_f) OVER {past(1440)} AS {p}_ln" for p in ("temperature", *WIND)]
    columns += [f"count(DISTINCT {p}_f) OVER {past(1440)} AS {p}_ld" for p in ("temperature", *WIND)]
    columns += [f"count(pressure_f) OVER {past(w)} AS count_{w}" for w in (120, 240, 360, 1440)]
    columns += [
        f"median(humidity_f) OVER {past(240)} AS rh_4h",
        f"median(humidity_f) OVER {past(360)} AS rh_6h",
        f"median(temperature_f) OVER {past(360)} AS t_6h",
        f"median(temperature_f) OVER {past(1440)} AS t_24h",
        f"count(*) FILTER (wind_speed_f = 0) OVER {past(360)} AS calm_n",
        f"count(*) FILTER (illuminance_f <> 0) OVER {past(120)} AS lit_n",
    ]
    steps["c1"] = "SELECT *, " + ", ".join(columns) + " FROM c0"

    def full(p: str) -> str:
        w = STUCK[p]
        return f"(sec >= first_sec + {w * 60} AND {p}_n = rows_{w} AND {p}_d = 1)"

    def day(p: str) -> str:
        return f"(sec >= first_sec + 86400 AND {p}_ld = 1)"

    calm = "calm_n = rows_360"
    steps["c2"] = f"""SELECT *,
      {full('humidity')} AND rh_6h < 95 AS humidity_hit,
      {full('temperature')} AND rh_4h < 95 AS temperature_hit,
      {full('illuminance')} AND lit_n = rows_120 AS illuminance_hit,
      {full('pressure')} AS pressure_hit,
      {day('temperature')} AND temperature_ln = rows_1440 AS temperature_lhit,
      {day('wind_direction')} AND t_24h > 0 AS wind_direction_lhit,
      {day('wind_speed')} AND t_24h > 0 AS wind_speed_lhit,
      CASE WHEN {full('wind_direction')} AND t_6h <= 0 THEN 6
           WHEN {full('wind_direction')} AND t_6h > 0 AND rh_6h < 85 THEN 5 END AS wind_direction_v,
      CASE WHEN {full('wind_speed')} AND {calm} AND t_6h <= 0 THEN 6
           WHEN {full('wind_speed')} AND {calm} AND t_6h > 0 AND rh_6h < 85 THEN 5
           WHEN {full('wind_speed')} AND calm_n = 0 THEN 5 END AS wind_speed_v
      FROM c1"""
    marks = [
        f"coalesce(max(CASE WHEN {p}_hit THEN 1 ELSE 0 END) OVER {ahead(STUCK[p])}, 0) AS {p}_const"
        for p in ("temperature", "humidity", "pressure", "illuminance")
    ]
    marks += [
        f"coalesce(max(CASE WHEN {p}_lhit THEN 1 ELSE 0 END) OVER {ahead(1440)}, 0) AS {p}_long"
        for p in ("temperature", *WIND)
    ]
    marks += [f"last_value({p}_v IGNORE NULLS) OVER {ahead(360)} AS {p}_r" for p in WIND]
    steps["c3"] = "SELECT *, " + ", ".join(marks) + " FROM c2"
    verdict = [f"CASE WHEN {p}_r = 5 THEN 5 ELSE 0 END AS {p}_const" for p in WIND]
    verdict += [f"CASE WHEN {p}_r = 6 THEN 6 ELSE 0 END AS {p}_frozen" for p in WIND]
    verdict += [f"0 AS {p}_long" for p in ("humidity", "pressure", "illuminance")]
    verdict += [f"0 AS {p}_frozen" for p in ("temperature", "humidity", "pressure", "illuminance")]
    verdict += [f"0 AS {RAIN}_{k}" for k in ("const", "long", "frozen")]
    steps["c4"] = "SELECT *, " + ", ".join(verdict) + " FROM c3"
    coupled = ", ".join(
        f"CASE WHEN wind_direction_{k} = 0 THEN 0 ELSE wind_speed_{k} END AS wind_speed_{k}"
        for k in ("const", "long", "frozen")
    )
    steps["coupled"] = f"SELECT * REPLACE ({coupled}) FROM c4"
    steps["const"] = "SELECT * FROM " + ("coupled" if m == "WS2000" else "c4")

    # ---- jumps ----
    seconds = MEDIAN_MINUTES[m] * 60
    near = f"({W} RANGE BETWEEN {seconds - 1} PRECEDING AND CURRENT ROW)"
    possible = lit(seconds / STEP[m])
    steps["j0"] = (
        "SELECT *, "
        + ", ".join(
            f"CASE WHEN count({p}_f) OVER {near} / {possible} >= {lit(MEDIAN_AVAILABILITY[p])}"
            f" THEN median({p}_f) OVER {near} END AS {p}_median, abs({p}_f - lag({p}_f) OVER ({W})) AS {p}_diff"
            for p in FIVE
        )
        + " FROM fill"
    )
    steps["j1"] = "SELECT *, " + ", ".join(f"abs({p}_f - {p}_median) AS {p}_md" for p in FIVE) + " FROM j0"
    steps["j2"] = (
        "SELECT *, "
        + ", ".join(
            f"coalesce({p}_diff > {lit(RAW_JUMP[m][p])}, false) AS {p}_jump, lag({p}_md) OVER ({W}) AS {p}_pmd"
            for p in FIVE
        )
        + " FROM j1"
    )
    steps["j3"] = (
        "SELECT *, "
        + ", ".join(
            f"""CASE WHEN {p}_jump OR coalesce(lead({p}_jump) OVER ({W}), false) THEN 1 ELSE 0 END AS {p}_couple,
            coalesce({p}_jump AND {p}_md > {p}_pmd, false)
            OR coalesce(lead({p}_jump AND {p}_pmd > {p}_md) OVER ({W}), false) AS {p}_bad"""
            for p in FIVE
        )
        + " FROM j2"
    )
    steps["jump"] = (
        "SELECT *, "
        + ", ".join(
            f"""CASE WHEN {p}_bad OR coalesce({p}_f = lag({p}_f) OVER ({W}) AND lag({p}_bad) OVER ({W}), false)
            THEN 4 ELSE 0 END AS {p}_invalid,
            CASE WHEN {p}_median IS NULL AND {p}_couple = 1 THEN 2 ELSE 0 END AS {p}_unid"""
            for p in FIVE
        )
        + " FROM j3"
    )

    # ---- all flags of a slot, as rows per parameter ----
    def flags(p: str) -> str:
        jumping = p in FIVE
        fields = {
            "parameter": f"'{p}'",
            "value": f"o.{p}",
            "median": f"j.{p}_median" if jumping else "CAST(NULL AS DOUBLE)",
            "diff": f"j.{p}_diff" if jumping else "CAST(NULL AS DOUBLE)",
            "md": f"j.{p}_md" if jumping else "CAST(NULL AS DOUBLE)",
            "obc": f"o.{p}_obc",
            "couple": f"j.{p}_couple" if jumping else "CAST(NULL AS INTEGER)",
            "invalid": f"j.{p}_invalid" if jumping else "CAST(NULL AS INTEGER)",
            "unid": f"j.{p}_unid" if jumping else "CAST(NULL AS INTEGER)",
            "nodat": f"CASE WHEN o.{p} IS NULL THEN 3 ELSE 0 END",
            "const": f"c.{p}_const",
            "long": f"c.{p}_long",
            "frozen": f"c.{p}_frozen",
            "u": uv("o.wind_speed", "o.wind_direction")[0] if p in WIND else "CAST(NULL AS DOUBLE)",
            "v": uv("o.wind_speed", "o.wind_direction")[1] if p in WIND else "CAST(NULL AS DOUBLE)",
            "rain": "o.precip_diff" if p == RAIN else "CAST(NULL AS DOUBLE)",
            "bin": f"o.sec - o.sec % {BIN[m][p] * 60}",
            "period": str(BIN[m][p] * 60),
        }
        return (
            "SELECT o.device_id, o.utc_datetime, o.sec, o.first_sec, o.last_sec, "
            + ", ".join(f'{sql} AS "{n}"' for n, sql in fields.items())
            + " FROM obc o JOIN const c USING (device_id, sec) JOIN jump j USING (device_id, sec)"
        )

    steps["long0"] = " UNION ALL ".join(flags(p) for p in V)
    positive = " OR ".join(f'coalesce("{f}", 0) > 0' for f in RAW_CODES)
    texts = ", ".join(f"""CASE WHEN "{f}" > 0 THEN '{code}' END""" for f, code in RAW_CODES.items())
    steps["long"] = (
        f"SELECT *, CASE WHEN {positive} THEN 1 ELSE 0 END AS faulty, concat_ws(',', {texts}) AS text FROM long0"
    )

    # ---- bins ----
    n_flags = ", ".join(f'count(*) FILTER ("{f}" > 0) AS n_{f}' for f in RAW_CODES)
    steps["b0"] = f"""SELECT device_id, parameter, bin, any_value(period) AS period,
        count(value) AS slots, count(*) AS total, CAST(sum(faulty) AS BIGINT) AS faulty,
        avg(value) AS mean, avg(value) FILTER (faulty = 0) AS cmean,
        avg(u) AS u, avg(v) AS v, avg(u) FILTER (faulty = 0) AS cu, avg(v) FILTER (faulty = 0) AS cv,
        coalesce(sum(rain) FILTER (rain > 0 AND rain <= period * 254e-3), 0) AS rain,
        ltrim(string_agg(text, ',' ORDER BY sec), ',') AS annotation,
        any_value(first_sec) AS first_sec, any_value(last_sec) AS last_sec, {n_flags}
        FROM long GROUP BY device_id, parameter, bin"""
    enough = f"(total - faulty) / CAST(total AS DOUBLE) > {lit(BIN_AVAILABILITY[m])}"
    steps["b1"] = f"""SELECT * REPLACE ({rint2('u')} AS u, {rint2('v')} AS v),
        CASE WHEN parameter IN ('wind_speed', 'wind_direction') THEN {speed('u', 'v')} END AS spd,
        CASE WHEN parameter IN ('wind_speed', 'wind_direction') THEN {direction('u', 'v')} END AS dir,
        CASE WHEN {enough} THEN {speed('cu', 'cv')} END AS cspd,
        CASE WHEN {enough} THEN {direction('cu', 'cv')} END AS cdir,
        CASE WHEN {enough} THEN {rint2('cmean')} END AS cscalar,
        {rint2('mean')} AS scalar FROM b0"""
    steps["b2"] = f"""SELECT *,
        CASE parameter WHEN 'wind_speed' THEN spd WHEN 'wind_direction' THEN dir WHEN '{RAIN}' THEN rain ELSE scalar END
          AS avg,
        CASE parameter WHEN 'wind_speed' THEN cspd WHEN 'wind_direction' THEN cdir WHEN '{RAIN}' THEN rain ELSE cscalar
          END AS avg_corrected FROM b1"""
    BW = "PARTITION BY device_id, parameter ORDER BY bin"
    bnear = f"({BW} RANGE BETWEEN {seconds - 1} PRECEDING AND CURRENT ROW)"
    searched = "parameter NOT IN ('wind_direction', 'precipitation_accumulated')"
    steps["bj0"] = f"""SELECT *, CASE WHEN {searched} AND
          count(avg) OVER {bnear} / ({MEDIAN_MINUTES[m]} * 6e1 / period) >= {case(MEDIAN_AVAILABILITY)}
          THEN {rint2(f'median(avg) OVER {bnear}')} END AS jmedian,
        CASE WHEN {searched} THEN abs(avg - lag(avg) OVER ({BW})) END AS jraw, lag(avg) OVER ({BW}) AS pavg FROM b2"""
    steps["bj1"] = f"SELECT *, {rint2('abs(avg - jmedian)')} AS jmd, {rint2('jraw')} AS jdiff FROM bj0"
    steps["bj2"] = (
        f"SELECT *, coalesce(jraw > {case(BIN_JUMP[m])}, false) AS jump, lag(jmd) OVER ({BW}) AS pjmd FROM bj1"
    )
    steps["bj3"] = f"""SELECT *, jump OR coalesce(lead(jump) OVER ({BW}), false) AS couple,
        coalesce(jump AND jmd > pjmd, false) OR coalesce(lead(jump AND pjmd > jmd) OVER ({BW}), false) AS bad FROM bj2"""
    steps["bj"] = f"""SELECT *,
        CASE WHEN {searched} THEN CASE WHEN couple THEN 1 ELSE 0 END END AS jcouple,
        CASE WHEN {searched} THEN CASE WHEN bad OR coalesce(avg = pavg AND lag(bad) OVER ({BW}), false) THEN 4 ELSE 0 END
          END AS jinvalid,
        CASE WHEN {searched} THEN CASE WHEN jmedian IS NULL AND couple THEN 2 ELSE 0 END END AS junid FROM bj3"""
    share = "((total - faulty) / CAST(total AS DOUBLE))"
    pct = "round_even((total - faulty) * 1e2 / total * 1e2, 0) / 1e2"
    a = lit(BIN_AVAILABILITY[m])
    steps["b3"] = f"""SELECT *, CASE WHEN {share} < {a} THEN 1 ELSE 0 END AS short, {pct} AS vp,
        CASE WHEN {share} > {a} THEN 1e2 ELSE {pct} END AS vpr,
        bin > first_sec - first_sec % period + 359 * 60 AS kept FROM bj"""
    add = annotation = "annotation"
    for condition, code in (
        ("coalesce(jinvalid, 0) > 0", "ANOMALOUS_INCREASE"),
        ("short > 0", "NO_DATA_MIN"),
        ("coalesce(junid, 0) > 0", "UNIDENTIFIED_ANOMALOUS_INCREASE"),
    ):
        add = (
            f"(CASE WHEN {condition} AND position('{code}' IN {add}) = 0 THEN "
            f"CASE WHEN length({add}) > 0 THEN {add} || ',{code}' ELSE '{code}' END ELSE {add} END)"
        )
    steps["bins"] = f"""SELECT * REPLACE ({add} AS {annotation}),
        CASE WHEN short > 0 OR coalesce(jinvalid, 0) > 0 OR coalesce(junid, 0) > 0 THEN 1 ELSE 0 END AS ann_total
        FROM b3"""

    # ---- hours ----
    n_sums = ", ".join(f"CAST(sum(n_{f}) AS BIGINT) AS n_{f}" for f in RAW_CODES)
    steps["counts"] = f"""SELECT device_id, parameter, bin - bin % 3600 AS hour_sec, {n_sums},
        CAST(sum(total) AS BIGINT) AS readings, count(*) FILTER (kept) AS bins_used,
        count(*) FILTER (kept AND jinvalid > 0) AS bins_invalid, count(*) FILTER (kept AND junid > 0) AS bins_unid,
        any_value(last_sec) AS last_sec FROM bins GROUP BY device_id, parameter, bin - bin % 3600"""
    hu, hv = uv("spd", "dir")
    ok = "kept AND ann_total = 0"
    steps["h0"] = f"""SELECT device_id, parameter, bin - bin % 3600 AS hour_sec,
        count(*) FILTER (kept) AS slots, CAST(sum(ann_total) FILTER (kept) AS BIGINT) AS faulty,
        avg(avg) FILTER (kept) AS mean, avg(avg_corrected) FILTER ({ok}) AS cmean, sum(avg) FILTER (kept) AS rain,
        avg({hu}) FILTER (kept) AS u, avg({hv}) FILTER (kept) AS v,
        avg({hu}) FILTER ({ok}) AS cu, avg({hv}) FILTER ({ok}) AS cv,
        coalesce(string_agg(annotation, ',' ORDER BY bin) FILTER (kept), '') AS texts
        FROM bins GROUP BY device_id, parameter, bin - bin % 3600 HAVING count(*) FILTER (kept) > 0"""
    henough = f"(slots - faulty) / CAST(slots AS DOUBLE) > {case(HOUR_AVAILABILITY)}"
    hpct = "round_even((slots - faulty) * 1e2 / slots * 1e2, 0) / 1e2"
    tokens = "list_filter(string_split(texts, ','), lambda x: x <> '')"
    steps["h1"] = f"""SELECT device_id, parameter, hour_sec, slots, faulty,
        CASE parameter WHEN 'wind_speed' THEN {speed('u', 'v')} WHEN 'wind_direction' THEN {direction('u', 'v')}
          WHEN '{RAIN}' THEN rain ELSE {rint2('mean')} END AS avg,
        CASE WHEN {henough} THEN CASE parameter WHEN 'wind_speed' THEN {speed('cu', 'cv')}
          WHEN 'wind_direction' THEN {direction('cu', 'cv')} WHEN '{RAIN}' THEN NULL ELSE {rint2('cmean')} END END
          AS avg_corrected,
        {hpct} AS vp, {hpct} AS vpr,
        CASE WHEN (slots - faulty) / CAST(slots AS DOUBLE) < {case(HOUR_AVAILABILITY)} THEN 1 ELSE 0 END AS short,
        array_to_string({tokens}, ',') AS annotation FROM h0"""
    steps["hours"] = (
        "SELECT device_id, parameter, hour_sec, avg, vp, vpr FROM h1"
        if m == "WS1000"
        else "SELECT device_id, parameter, bin AS hour_sec, avg, vp, vpr FROM bins WHERE kept"
    )

    # ---- shares of faults ----
    today = "hour_sec >= last_sec - last_sec % 86400 AND hour_sec < last_sec - last_sec % 86400 + 86400"

    def share_of(pos: int, code: str, n: str, total: str) -> str:
        p = f"CAST(printf('%.1f', {n} / CAST({total} AS DOUBLE) * 1e2) AS DOUBLE)"
        return (
            f"SELECT device_id, parameter, hour_sec, {pos} AS pos, '{code}' AS code, {p} AS pct FROM counts "
            f"WHERE {today} AND {total} > 0 AND {n} > 0"
        )

    raw = [share_of(i, code, f"n_{f}", "readings") for i, (f, code) in enumerate(RAW_CODES.items())]
    binned = [
        share_of(7, "ANOMALOUS_INCREASE", "bins_invalid", "bins_used"),
        share_of(8, "UNIDENTIFIED_ANOMALOUS_CHANGE", "bins_unid", "bins_used"),
    ]
    steps["rawcodes"] = " UNION ALL ".join(raw)
    steps["bincodes"] = " UNION ALL ".join(binned)
    steps["codes"] = "SELECT * FROM rawcodes UNION ALL SELECT * FROM bincodes"
    steps["htext"] = (
        f"SELECT device_id, parameter, hour_sec, {json_agg('pos')} AS annotation FROM codes "
        "GROUP BY device_id, parameter, hour_sec"
    )
    steps["spine"] = """SELECT device_id, parameter, last_sec - last_sec % 86400 + h.range * 3600 AS hour_sec
        FROM (SELECT DISTINCT device_id, parameter, last_sec FROM counts) CROSS JOIN range(24) h"""
    steps["scored"] = """SELECT h.*, coalesce(t.annotation, '[]') AS annotation,
        dense_rank() OVER (PARTITION BY h.device_id ORDER BY h.hour_sec) AS nth
        FROM hours h LEFT JOIN htext t USING (device_id, parameter, hour_sec)"""
    steps["d0"] = """SELECT c.device_id, c.parameter, c.code,
        list_reduce(list(c.pct / 24 ORDER BY c.hour_sec, c.pos), lambda a, x: a + x) AS pct,
        min(c.hour_sec * 10 + c.pos) AS seen
        FROM codes c JOIN scored s USING (device_id, parameter, hour_sec) WHERE s.nth <= 24
        GROUP BY c.device_id, c.parameter, c.code"""
    steps["dparam"] = (
        f"SELECT device_id, parameter, {json_agg('seen')} AS annotation FROM d0 GROUP BY device_id, parameter"
    )
    rank = "CASE parameter " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(V)) + " END"
    steps["d1"] = f"""SELECT device_id, code, '"' || code || '": [' ||
        string_agg('["' || parameter || '", ' || CAST(pct AS VARCHAR) || ']', ', ' ORDER BY {rank}) || ']' AS member
        FROM d0 GROUP BY device_id, code"""
    steps["dall"] = "SELECT device_id, '{' || string_agg(member, ', ' ORDER BY code) || '}' AS annotation FROM d1 GROUP BY 1"
    pivot = ", ".join(
        f"max(vpr) FILTER (parameter = '{p}') AS {p}_score, "
        f"coalesce(max(annotation) FILTER (parameter = '{p}'), '[]') AS {p}_annotation"
        for p in V
    )
    steps["wide"] = (
        f"SELECT device_id, hour_sec, nth, {pivot}, avg(vpr) AS hourly_score FROM scored GROUP BY device_id, hour_sec, nth"
    )
    steps["qp"] = """SELECT device_id, parameter, CASE WHEN count(*) = count(vpr) THEN avg(vpr / 1e2) END AS s
        FROM hours GROUP BY device_id, parameter"""
    steps["qod"] = (
        "SELECT device_id, CASE WHEN count(s) = 7 THEN sum(s) / 7 END AS qod_score FROM qp GROUP BY device_id"
    )
    daily = ", ".join(
        f"coalesce(max(annotation) FILTER (parameter = '{p}'), '[]') AS daily_{p}_annotation" for p in V
    )
    steps["dwide"] = f"SELECT device_id, {daily} FROM dparam GROUP BY device_id"
    steps["stations"] = "SELECT DISTINCT device_id FROM hours"
    steps["days"] = (
        "SELECT s.device_id, "
        + ", ".join(f"coalesce(w.daily_{p}_annotation, '[]') AS daily_{p}_annotation" for p in V)
        + ", coalesce(a.annotation, '{}') AS daily_annotation FROM stations s "
        "LEFT JOIN dwide w USING (device_id) LEFT JOIN dall a USING (device_id)"
    )
    ts = "make_timestamp(hour_sec * 1000000)"
    steps["final"] = f"""SELECT w.device_id, DATE '2024-01-01' AS qod_date,
        {", ".join(f"w.{p}_score, w.{p}_annotation" for p in V)},
        {", ".join(f"d.daily_{p}_annotation" for p in V)}, d.daily_annotation,
        '{m}' AS model, round(q.qod_score, 6) AS qod_score, round(w.hourly_score, 6) AS hourly_score,
        '1.0.6' AS qod_version, CAST(year({ts}) AS INTEGER) AS year, CAST(month({ts}) AS INTEGER) AS month,
        CAST(day({ts}) AS INTEGER) AS day, CAST(hour({ts}) AS INTEGER) AS hour
        FROM wide w JOIN days d USING (device_id) JOIN qod q USING (device_id) WHERE w.nth <= 24"""
    # ---- report tables ----
    shifted = f"(sec + {STEP[m]})"
    steps["lastday"] = f"SELECT *, {shifted} AS shifted FROM fill WHERE {shifted} // 86400 = last_sec // 86400"
    return steps


def needed(steps: dict[str, str], sql: str) -> list[str]:
    """Names of the steps a statement refers to, directly or not, in order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        for word in re.findall(r"(?:FROM|JOIN)\s+(\w+)", todo.pop()):
            if word in steps and word not in found:
                found.add(word)
                todo.append(steps[word])
    return [s for s in steps if s in found]


def for_model(m: str, sql: str) -> str:
    steps = chain(m)
    names = needed(steps, sql)
    # Materialised: a step used by several others is computed once.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({steps[n]})" for n in names) + "\n" + sql


def both(sql: str | dict[str, str]) -> str:
    parts = sql if isinstance(sql, dict) else {m: sql for m in STEP}
    return " UNION ALL ".join(f"SELECT * FROM ({for_model(m, s)})" for m, s in parts.items())


def ws1000(sql: str) -> str:
    return f"SELECT * FROM ({for_model('WS1000', sql)})"


def pick(columns: Sequence[str], source: str, keys: str = "device_id, sec") -> str:
    return f"SELECT {keys}, {', '.join(columns)} FROM {source}"


def flagged(parameters: Sequence[str], *names: str) -> list[str]:
    return [f"{p}_{n} AS {p}__{SPARK_NAME.get(n, n)}" for p in parameters for n in names]


def by_parameter(column: str, kind: str, alias: str) -> str:
    picked = ", ".join(f"max(\"{column}\") FILTER (parameter = '{p}') AS {p}__{alias}" for p in V)
    return f"SELECT device_id, sec, {picked} FROM long GROUP BY device_id, sec"


READINGS = f"SELECT device_id, {', '.join(V)}, model, utc_datetime FROM tel"
BIN_KEYS = "device_id, parameter, bin"
HOUR_KEYS = "device_id, parameter, hour_sec"


def in_(parameters: Sequence[str]) -> str:
    return "parameter IN (" + ", ".join(f"'{p}'" for p in parameters) + ")"


def params_sql() -> str:
    rows = []
    for m in STEP:
        for p in V:
            values = [f"'{m}'", str(STEP[m]), str(FILL_SECONDS[m]), str(FILL_ROWS[m]), str(MEDIAN_MINUTES[m]), f"'{p}'"]
            values += [str(BIN[m][p]), lit(MEDIAN_AVAILABILITY[p]), lit(BIN_AVAILABILITY[m]), lit(HOUR_AVAILABILITY[p])]
            values += [lit(RAW_JUMP[m][p]), lit(BIN_JUMP[m][p])]
            values += [f"CAST({x} AS INTEGER)" if x else "CAST(NULL AS INTEGER)" for x in (STUCK[p], STUCK_LONG[p])]
            values += [lit(LOWER[m][p]), lit(UPPER[m][p])]
            rows.append(f"({', '.join(values)})")
    names = (
        "model, step_seconds, fill_seconds, fill_rows, median_minutes, parameter, bin_minutes, median_availability, "
        "bin_availability, hour_availability, raw_jump, bin_jump, stuck_minutes, stuck_long_minutes, lower, upper"
    )
    stations = both("SELECT device_id, model, count(*) AS slots FROM tel GROUP BY device_id, model")
    return f"SELECT * FROM ({stations}) s JOIN (VALUES {', '.join(rows)}) p({names}) USING (model)"


RESAMPLE = """
WITH near AS (
  SELECT event_type AS device_id, value, epoch_us(ts) AS us,
    (epoch_us(ts) + 90000000) // 180000000 * 180 AS slot FROM events),
best AS (
  SELECT device_id, slot, first(value ORDER BY abs(us - slot * 1000000), us, value) AS value FROM near
  GROUP BY device_id, slot),
days AS (SELECT DISTINCT device_id, slot // 86400 AS d FROM best),
spine AS (
  SELECT device_id, d, d * 86400 - 21600 + g.range * 180 AS slot FROM days CROSS JOIN range(600) g)
SELECT device_id, CAST(make_timestamp(d * 86400000000) AS DATE) AS qod_date,
  make_timestamp(slot * 1000000) AS utc_datetime, value
FROM spine LEFT JOIN best USING (device_id, slot)
"""

BACK_RESULT = (
    "CASE WHEN temperature_f = 75 THEN 5 WHEN pressure_f = 1025 THEN 0 WHEN wind_speed_f = 60 THEN 6 END"
)
AHEAD_2H = "(PARTITION BY device_id ORDER BY sec RANGE BETWEEN 1 FOLLOWING AND 7200 FOLLOWING)"


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    readings = both(READINGS)
    q["scan_telemetry"] = q["union_days"] = q["cast_input"] = readings
    q["dedup_rows"] = f"SELECT DISTINCT * FROM (({readings}) UNION ALL ({readings}) UNION ALL ({readings}))"
    q["qod_window"] = f"""WITH r AS ({readings})
        SELECT device_id, CAST(utc_datetime AS DATE) AS qod_date, utc_datetime FROM r
        UNION ALL SELECT device_id, CAST(CAST(utc_datetime AS DATE) + INTERVAL 1 DAY AS DATE), utc_datetime FROM r
        WHERE utc_datetime >= CAST(utc_datetime AS DATE) + INTERVAL 18 HOUR"""
    q["model_params"] = params_sql()
    q["output_schema"] = q["quality_scores"] = q["write_scores"] = q["unsent_rows"] = q["bucketed_scores"] = both("SELECT * FROM final")
    q["select_raw_columns"] = both(
        "SELECT device_id, utc_datetime, parameter, value, round(median, 6) AS rolling_median,"
        " round(diff, 6) AS consec_obs_diff_abs, round(md, 6) AS median_diff_abs, obc AS ann_obc,"
        " couple AS ann_jump_couples, invalid AS ann_invalid_datum, unid AS ann_unidentified_spike,"
        " nodat AS ann_no_datum, const AS ann_constant, long AS ann_constant_long, frozen AS ann_constant_frozen,"
        " faulty AS total_raw_annotation, faulty AS reward_annotation, text AS annotation FROM long"
    )
    q["null_incomplete_rows"] = both(pick(V, "n1"))
    q["resample_grid"] = RESAMPLE
    q["fill_gaps"] = both(pick([f"{p}_f AS {p}__filled" for p in V], "fill"))
    q["consec_filling"] = both(pick(["fill_count"], "consec"))
    q["obc_bounds"] = both(pick(flagged(SIX, "obc"), "obc0"))
    q["precip_diff"] = both(pick(r6(["precip_diff"]), "obc0"))
    q["obc_precip"] = both(pick(flagged([RAIN], "obc"), "obc"))

    windows = (120, 240, 360, 1440)
    q["const_window_rows"] = both(
        f"SELECT DISTINCT device_id, {', '.join(f'rows_{w}' for w in windows)} FROM c0"
    )
    q["rolling_non_null"] = both(pick([f"count_{w}" for w in windows], "c1"))
    q["rolling_is_constant"] = both(
        pick(
            [f"{p}_d = 1 AS {p}__constant" for p in SIX]
            + [f"{p}_ld = 1 AS {p}__constant_day" for p in ("temperature", *WIND)],
            "c1",
        )
    )
    q["rolling_median"] = both(
        pick(
            [
                "round(rh_4h, 6) AS dry_4h__median",
                "round(rh_6h, 6) AS dry_6h__median",
                "round(t_6h, 6) AS cold_6h__median",
                "round(t_24h, 6) AS cold_24h__median",
                "rh_4h < 95 AS dry_4h",
                "rh_6h < 85 AS dry_6h",
                "t_6h <= 0 AS cold_6h",
                "t_24h <= 0 AS cold_24h",
            ],
            "c1",
        )
    )
    q["const_guard"] = both(pick([f"sec >= first_sec + {w * 60} AS guard_{w}" for w in windows], "fill"))
    q["backprop_any"] = both(
        pick([f"coalesce(max(CASE WHEN pressure_f = 1025 THEN 1 ELSE 0 END) OVER {AHEAD_2H}, 0) AS marked"], "fill")
    )
    q["backprop_latest"] = both(
        f"SELECT device_id, sec, coalesce(last_value(r IGNORE NULLS) OVER {AHEAD_2H}, 0) AS marked "
        f"FROM (SELECT *, {BACK_RESULT} AS r FROM fill)"
    )
    q["const_humidity_temperature"] = both(pick(flagged(["humidity", "temperature"], "const"), "c4"))
    q["const_wind_direction"] = both(pick(flagged(["wind_direction"], "const", "frozen"), "c4"))
    q["const_wind_speed"] = both(pick(flagged(["wind_speed"], "const", "frozen"), "c4"))
    q["const_illuminance"] = both(pick(flagged(["illuminance"], "const"), "c4"))
    q["const_pressure"] = both(pick(flagged(["pressure"], "const"), "c4"))
    q["long_const_temperature"] = both(pick(flagged(["temperature"], "long"), "c4"))
    q["long_const_wind"] = both(pick(flagged(WIND, "long"), "c4"))
    q["constancy"] = both(pick(flagged(SIX, "const", "long", "frozen"), "const"))
    q["wind_coupling"] = both(pick(flagged(WIND, "const", "long", "frozen"), "coupled"))
    q["precip_no_constancy"] = both(pick(flagged([RAIN], "const", "long", "frozen"), "c4"))

    q["raw_median"] = both(pick([f"round({p}_median, 6) AS {p}__median" for p in FIVE], "j0"))
    q["raw_diff"] = both(pick([f"round({p}_diff, 6) AS {p}__diff" for p in FIVE], "j0"))
    q["raw_median_diff"] = both(pick([f"round({p}_md, 6) AS {p}__median_diff" for p in FIVE], "j1"))
    q["jump_couples"] = both(pick(flagged(FIVE, "couple"), "j3"))
    q["invalid_datum"] = both(pick([f"CASE WHEN {p}_bad THEN 4 ELSE 0 END AS {p}__blamed" for p in FIVE], "j3"))
    q["invalid_repeat"] = both(pick(flagged(FIVE, "invalid"), "jump"))
    q["unidentified_spike"] = both(pick(flagged(FIVE, "unid"), "jump"))
    nulls = [
        f"CAST(NULL AS {kind}) AS {p}__{c}"
        for p in ("wind_direction", RAIN)
        for kind, names in (("DOUBLE", ("median", "diff", "median_diff")), ("INTEGER", ("couple", "invalid", "unidentified")))
        for c in names
    ]
    q["jump_not_applicable"] = both(pick(nulls, "tel"))
    q["no_datum"] = both(pick([f"CASE WHEN {p} IS NULL THEN 3 ELSE 0 END AS {p}__no_datum" for p in V], "n1"))
    q["raw_total"] = both(by_parameter("faulty", "INTEGER", "faulty"))
    q["packages_per_hour"] = both(
        "SELECT s.device_id, CAST(h.range AS INTEGER) AS hour, count(l.pressure) AS packages "
        "FROM (SELECT DISTINCT device_id FROM lastday) s CROSS JOIN range(24) h "
        "LEFT JOIN lastday l ON l.device_id = s.device_id AND l.sec % 86400 // 3600 = h.range GROUP BY 1, 2"
    )
    six_means = ", ".join(f"round(avg({p}), 6) AS {p}" for p in SIX)
    minutes = f"SELECT device_id, shifted - shifted % 60 AS m0, {six_means}, round(avg(illuminance) / 122, 6) AS irradiance FROM lastday GROUP BY 1, 2"
    q["minute_report"] = both(
        f"SELECT s.device_id, make_timestamp(s.m0 * 1000000) AS minute, {', '.join(SIX)}, irradiance FROM "
        f"(SELECT device_id, unnest(generate_series(min(m0), max(m0), 60)) AS m0 FROM ({minutes}) GROUP BY 1) s "
        f"LEFT JOIN ({minutes}) m ON m.device_id = s.device_id AND m.m0 = s.m0"
    )

    q["time_bins"] = both(
        {m: pick([f"sec - sec % {BIN[m][p] * 60} AS {p}_bin" for p in V], "tel") for m in STEP}
    )
    q["bin_counts"] = both(
        f"SELECT {BIN_KEYS}, slots AS num_time_slots, total - slots AS num_nan_values, total AS num_total_slots,"
        " faulty AS num_faulty, faulty AS faulty_rewards FROM b0"
    )
    q["scalar_bin_mean"] = both(f"SELECT {BIN_KEYS}, avg FROM b2 WHERE {in_(SCALARS)}")
    q["corrected_mean"] = both(f"SELECT {BIN_KEYS}, avg_corrected FROM b2 WHERE {in_(SCALARS)}")
    u, v = uv(*WIND)
    q["wind_uv"] = both(pick([f"round({u}, 6) AS u", f"round({v}, 6) AS v"], "n1"))
    q["wind_vector_mean"] = both(
        f"SELECT {BIN_KEYS}, u, v, spd AS speed_avg, dir AS direction_avg FROM b1 WHERE {in_(WIND)}"
    )
    q["wind_corrected_mean"] = both(
        f"SELECT {BIN_KEYS}, cspd AS speed_avg_corrected, cdir AS direction_avg_corrected FROM b1 WHERE {in_(WIND)}"
    )
    q["precip_bin_sum"] = both(
        f"SELECT {BIN_KEYS}, round(avg, 6) AS avg, round(avg_corrected, 6) AS avg_corrected FROM b2 WHERE {in_([RAIN])}"
    )
    q["bin_annotation_text"] = both(f"SELECT {BIN_KEYS}, annotation FROM b0")
    q["bin_jumps"] = both(
        f"SELECT {BIN_KEYS}, jmedian AS jump__median, jdiff AS jump__diff, jmd AS jump__median_diff,"
        " jcouple AS jump__couple, jinvalid AS jump__invalid, junid AS jump__unidentified FROM bj"
    )
    q["bin_availability"] = both(f"SELECT {BIN_KEYS}, short AS ann_all_from_raw, vp AS valid_percentage FROM b3")
    q["bin_availability_rewards"] = both(
        f"SELECT {BIN_KEYS}, short AS ann_all_from_raw_rewards, vpr AS valid_percentage_rewards FROM b3"
    )
    q["bin_annotation_update"] = both(f"SELECT {BIN_KEYS}, annotation FROM bins")
    q["bin_total"] = both(f"SELECT {BIN_KEYS}, ann_total, ann_total AS ann_total_rewards FROM bins")
    q["warmup_trim"] = both(f"SELECT {BIN_KEYS}, ann_total FROM bins WHERE kept")

    q["hour_scalar"] = ws1000(
        f"SELECT {HOUR_KEYS}, avg, slots AS num_time_slots, faulty AS num_hourly_faulty,"
        f" faulty AS num_hourly_faulty_rewards FROM h1 WHERE {in_(SCALARS)}"
    )
    q["hour_corrected"] = ws1000(f"SELECT {HOUR_KEYS}, avg_corrected FROM h1 WHERE {in_(SCALARS)}")
    q["hour_wind"] = ws1000(f"SELECT {HOUR_KEYS}, avg FROM h1 WHERE {in_(WIND)}")
    q["hour_wind_corrected"] = ws1000(f"SELECT {HOUR_KEYS}, avg_corrected FROM h1 WHERE {in_(WIND)}")
    q["hour_precip"] = ws1000(f"SELECT {HOUR_KEYS}, round(avg, 6) AS avg FROM h1 WHERE {in_([RAIN])}")
    q["hour_annotation_tokens"] = ws1000(f"SELECT {HOUR_KEYS}, annotation FROM h1")
    q["hour_valid_pct"] = ws1000(
        f"SELECT {HOUR_KEYS}, vp AS valid_percentage, vpr AS valid_percentage_rewards FROM h1"
    )
    q["hour_flag"] = ws1000(f"SELECT {HOUR_KEYS}, short AS ann_total_hour, short AS ann_total_hour_rewards FROM h1")

    q["text_annotation"] = both(by_parameter("text", "VARCHAR", "text"))
    q["hourly_raw_codes"] = both(f"SELECT {HOUR_KEYS}, code, pct FROM rawcodes")
    q["hourly_bin_codes"] = both(f"SELECT {HOUR_KEYS}, code, pct FROM bincodes")
    q["hourly_codes"] = both(
        f"SELECT {HOUR_KEYS}, CAST(count(c.code) AS INTEGER) AS codes,"
        " coalesce(string_agg(c.code, ',' ORDER BY c.pos), '') AS names"
        f" FROM spine LEFT JOIN codes c USING ({HOUR_KEYS}) GROUP BY {HOUR_KEYS}"
    )
    q["hourly_json"] = both(
        f"SELECT {HOUR_KEYS}, coalesce(t.annotation, '[]') AS annotation"
        f" FROM spine LEFT JOIN htext t USING ({HOUR_KEYS})"
    )
    q["daily_param_codes"] = both(f"SELECT device_id, {', '.join(f'daily_{p}_annotation' for p in V)} FROM days")
    q["daily_codes"] = both("SELECT device_id, daily_annotation FROM days")

    q["hour_path"] = both(
        f"SELECT {HOUR_KEYS}, round(avg, 6) AS avg, vp AS valid_percentage, vpr AS valid_percentage_rewards FROM hours"
    )
    q["hour_pivot"] = both(
        f"SELECT device_id, hour_sec, {', '.join(f'{p}_score, {p}_annotation' for p in V)} FROM wide"
    )
    q["hourly_score"] = both("SELECT device_id, hour_sec, round(hourly_score, 6) AS hourly_score FROM wide")
    q["qod_score"] = both("SELECT device_id, round(qod_score, 6) AS qod_score FROM qod")
    parts = ", ".join(f"CAST({x}(utc_datetime) AS INTEGER) AS {x}" for x in ("year", "month", "day", "hour"))
    q["calendar_fields"] = both(f"SELECT device_id, sec, {parts} FROM tel")
    q["first_24"] = both(
        "SELECT device_id, hour_sec FROM (SELECT device_id, hour_sec, row_number() OVER (PARTITION BY device_id "
        "ORDER BY hour_sec) AS nth FROM (SELECT DISTINCT device_id, sec - sec % 3600 AS hour_sec FROM tel)) WHERE nth <= 24"
    )
    return q
