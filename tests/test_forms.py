"""The one-pass forms against plain brute force, on random series with gaps and irregular times."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from series import START, frame, rows

from stationqc.operators import constancy, grid, reports
from stationqc.params import MODELS, RAIN, STICKING
from stationqc.plans.slots import checked_slots, filled_slots
from stationqc.operators import jumps


def random_series(seed: int, irregular: bool) -> dict:
    rng = random.Random(seed)
    count = 620
    secs = [i * 180 for i in range(count)]
    if irregular:
        secs = sorted(rng.sample(range(0, count * 180, 30), count))
    temperature, humidity, direction = [], [], []
    for i in range(count):
        calm = (i // 150 + seed) % 2 == 0
        # Values around the limits, so that medians fall on both sides of them and in between.
        temperature.append(rng.choice([-0.2, -0.1, 0.0, 0.1, 0.3]) if seed % 2 else (0.1 if calm else rng.uniform(-1, 1)))
        humidity.append(rng.choice([84.0, 84.9, 85.0, 85.2, 94.9, 95.0, 96.0]))
        direction.append(180.0 if calm or seed % 3 == 0 else float(rng.randrange(3)))
    for _ in range(12):
        i = rng.randrange(count)
        for j in range(i, min(count, i + rng.choice([1, 1, 2, 5]))):
            temperature[j] = None
    return {
        "secs": secs,
        "temperature": temperature,
        "humidity": humidity,
        "wind_direction": direction,
        "wind_speed": [0.0 if d == 180.0 else d for d in direction],
        RAIN: [float(i) for i in range(count)],
    }


def data(seeds):
    out = []
    for seed in seeds:
        s = random_series(seed, irregular=seed % 4 == 3)
        out += rows(180, "WS2000", len(s["secs"]), device=f"d{seed}", **s)
    return out


def test_windows_and_medians_match_brute_force(spark):
    seeds = range(6)
    df = filled_slots(frame(spark, data(seeds)), MODELS["WS2000"])
    params = MODELS["WS2000"]
    got = constancy.const_window_rows(constancy.rolling_is_constant(constancy.median_conditions(df), params))
    pdf = got.toPandas().sort_values(["device_id", "sec"])
    ties = 0
    for _, g in pdf.groupby("device_id"):
        sec = g["sec"].to_numpy()
        filled = {p: g[f"{p}__filled"].to_numpy(dtype=float) for p in STICKING}
        for i, t in enumerate(sec):
            row = g.iloc[i]
            for m in (120, 240, 360, 1440):
                window = (sec >= t - m * 60) & (sec < t)
                assert row[f"count_{m}"] == np.sum(~np.isnan(filled["pressure"][window]))
            for p in STICKING:
                window = (sec >= t - params.of(p).stuck_minutes * 60) & (sec < t)
                assert row[f"{p}__constant"] == (pd.Series(filled[p][window]).nunique() == 1), (p, i)
            for x in constancy.MEDIAN_TESTS:
                values = filled[x.column.removesuffix("__filled")][(sec >= t - x.minutes * 60) & (sec < t)]
                values = values[~np.isnan(values)]
                if len(values) == 0:
                    assert row[x.name] is None or pd.isna(row[x.name])
                    continue
                low = values <= x.limit if x.comparison == "<=" else values < x.limit
                ties += 2 * low.sum() == len(values)
                median = np.median(values)
                assert row[x.name] == (median <= x.limit if x.comparison == "<=" else median < x.limit)
    assert ties > 50


def test_fused_stage_equals_separate_operators(spark):
    params = MODELS["WS2000"]
    raw = frame(spark, data(range(4)))
    fused = checked_slots(raw, params)
    audit = checked_slots(raw, params, audit=True)
    filled = filled_slots(raw, params)
    stuck, jumped = constancy.constancy(filled, params), jumps.raw_jumps(filled, params)
    marks = [f"{p}__{k}" for p in STICKING for k in constancy.KINDS]
    flags = [f"{p}__{k}" for p in jumps.JUMPING for k in ("couple", "invalid", "unidentified")]
    reals = [f"{p}__{k}" for p in jumps.JUMPING for k in ("median", "median_diff")]

    def table(df, columns):
        return df.select("device_id", "sec", *columns).toPandas().sort_values(["device_id", "sec"]).reset_index(drop=True)

    pd.testing.assert_frame_equal(table(fused, marks), table(stuck, marks))
    pd.testing.assert_frame_equal(table(fused, flags), table(jumped, flags))
    pd.testing.assert_frame_equal(table(audit, flags + reals), table(jumped, flags + reals))


def test_resample_keeps_the_nearest_reading_and_completes_the_day(spark):
    rng = random.Random(5)
    secs = sorted(rng.sample(range(6 * 3600 + 7, 20 * 3600), 300))
    values = [float(i) for i in range(300)]
    df = frame(spark, rows(180, "WS2000", 300, secs=secs, temperature=values)).drop("qod_date", "sec")
    out = grid.resample_grid(df, MODELS["WS2000"], ["temperature"]).filter("qod_date = '2024-01-01'").toPandas()
    assert len(out) == 600 and out["sec"].nunique() == 600
    best: dict[int, tuple] = {}
    for s, v in zip(secs, values):
        slot = (s + 90) // 180
        best[slot] = min(best.get(slot, (10**9,)), (abs(s - slot * 180), s, v))
    got = {(r.sec - START) // 180: r.temperature for r in out.itertuples() if not np.isnan(r.temperature)}
    assert got == {k: v[2] for k, v in best.items()}


def test_regrid_prefers_a_full_reading_to_a_nearer_empty_one(spark):
    secs, values = [0, 170, 200, 365], [1.0, None, 2.0, 3.0]
    df = frame(spark, rows(180, "WS2000", 4, secs=secs, temperature=values, start=START + 7 * 3600)).drop("qod_date", "sec")
    out = grid.resample_grid(df, MODELS["WS2000"], ["temperature"]).filter("temperature IS NOT NULL")
    assert [(r["sec"] - START - 7 * 3600, r["temperature"]) for r in out.orderBy("sec").collect() if r["qod_date"].day == 1] == [(0, 1.0), (180, 2.0), (360, 3.0)]


def test_sliding_medians_equal_medians_of_each_window(spark):
    rng = np.random.default_rng(11)
    secs = np.sort(rng.choice(np.arange(0, 100_000, 7), 1_500)).tolist()  # times may repeat
    values = [None if rng.random() < 0.3 else float(rng.choice([-5.5, 0.0, 3.25, 17.0, 94.9, 95.1])) for _ in secs]
    df = frame(spark, rows(16, "WS1000", len(secs), secs=secs, temperature=values, humidity=values[::-1]))
    df = df.withColumnsRenamed({p: f"{p}__filled" for p in ("temperature", "humidity")}).withColumn("mark", F.monotonically_increasing_id())
    got = constancy.rolling_median(df).toPandas()
    assert len(got) == len(secs) and got["mark"].nunique() == len(secs)
    for x in constancy.MEDIAN_TESTS:
        for sec, found in zip(got["sec"], got[f"{x.name}__median"], strict=True):
            window = got[(got["sec"] >= sec - x.minutes * 60) & (got["sec"] < sec)][x.column].dropna()
            assert (np.isnan(found) and not len(window)) or found == np.median(window)


def test_empty_minutes_are_in_the_report(spark):
    secs = [0, 16, 32, 200, 216, 700]
    df = frame(spark, rows(16, "WS1000", 6, secs=secs, temperature=[1.0, 2.0, 3.0, 4.0, 5.0, 6.0], start=START + 10 * 3600))
    df = df.withColumn("last_sec", F.lit(START + 10 * 3600 + 700).cast("long"))
    got = reports.minute_report(df, MODELS["WS1000"]).orderBy("minute").collect()
    means = [r["temperature"] for r in got]
    assert means == [2.0 if k == 0 else 4.5 if k == 3 else 6.0 if k == 11 else None for k in range(12)]
    assert [(b["minute"] - a["minute"]).seconds for a, b in zip(got, got[1:])] == [60] * 11
