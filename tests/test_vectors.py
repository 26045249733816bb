"""Hand-computed vectors, one per operator rule."""

import pytest
from series import column, frame, rows

from stationqc.functions.columns import extend
from stationqc.functions.windows import Timeline
from stationqc.operators import bins, bounds, constancy, fill, hours, jumps
from stationqc.params import GAUGE_MM, MODELS, RAIN
from stationqc.plans.hours import aggregated_bins
from stationqc.plans.slots import checked_slots, filled_slots

N = None
GAPS = [1, N, 2, N, N, N, N, N, N, N, 3, 4]


def as_floats(values):
    return [N if v is N else float(v) for v in values]


@pytest.mark.parametrize(
    ("model", "filled", "counter"),
    [
        ("WS1000", [1, 1, 2, 2, 2, 2, 2, 2, N, N, 3, 4], [0, 1, 2, 3, 4, 5, 6, 7, 8, 0, 0, 0]),
        ("WS2000", [1, 1, 2, 2, 2, N, N, N, N, N, 3, 4], [0, 1, 2, 3, 4, 5, 0, 0, 0, 0, 0, 0]),
    ],
)
def test_fill_carries_one_slot_more_than_the_period(spark, model, filled, counter):
    params = MODELS[model]
    df = frame(spark, rows(params.step, model, 12, temperature=as_floats(GAPS)))
    out = fill.consec_filling(filled_slots(df, params))
    assert column(out, "temperature__filled") == as_floats(filled)
    assert column(out, "fill_count") == counter


def test_leading_gap_stays_empty_and_gaps_are_common(spark):
    df = frame(spark, rows(16, "WS1000", 4, temperature=[N, N, 1.0, 1.0], humidity=[60.0, 60.0, 60.0, N]))
    out = filled_slots(df, MODELS["WS1000"])
    assert column(out, "humidity__filled") == [N, N, 60.0, 60.0]
    assert column(out, "is_fill") == [False, False, False, True]


PREFIX = [10.0] * 40
SPIKES = as_floats([10, 10, 10.1, 50, 10.1, 50, 50, 50, 10.2, 10.2, N, 10.2])


def raw_flags(spark, values):
    df = frame(spark, rows(16, "WS1000", len(values), temperature=values))
    return checked_slots(df, MODELS["WS1000"]), jumps.raw_jumps(filled_slots(df, MODELS["WS1000"]), MODELS["WS1000"])


def test_jumps_blame_the_value_far_from_its_median(spark):
    fused, alone = raw_flags(spark, PREFIX + SPIKES)
    for out in (fused, alone):
        assert column(out, "temperature__couple")[40:] == [0, 0, 1, 1, 1, 1, 0, 1, 1, 0, 0, 0]
        assert column(out, "temperature__invalid")[40:] == [0, 0, 0, 4, 0, 4, 4, 4, 0, 0, 0, 0]


def test_repeat_of_a_blamed_value_reaches_one_step_only(spark):
    fused, alone = raw_flags(spark, PREFIX + as_floats([50, 50, 50, 50, 50, 10]))
    for out in (fused, alone):
        assert column(out, "temperature__invalid")[40:] == [4, 4, 0, 0, 4, 0]


def test_spike_without_history_is_unidentified(spark):
    fused, alone = raw_flags(spark, SPIKES)
    for out in (fused, alone):
        assert column(out, "temperature__unidentified") == [0, 0, 2, 2, 2, 2, 0, 2, 2, 0, 0, 0]
        assert set(column(out, "temperature__invalid")) == {0}


def test_tie_blames_neither(spark):
    # Both sides are 2.5 from their own medians.
    rule = jumps.JumpRule("x", "v", "2D", "0D", "1D")
    data = [("d", 1, 0.0, 2.5), ("d", 2, 5.0, 2.5)]
    df = spark.createDataFrame(data, "device_id string, sec bigint, v double, x__median double")
    t = Timeline(("device_id",))
    df = extend(extend(df, jumps.neighbours([rule], t)), jumps.steps([rule]) | jumps.distances([rule]))
    out = extend(extend(df, jumps.distances_around([rule], t)), jumps.flags([rule]))
    assert column(out, "x__couple") == [1, 1]
    assert column(out, "x__invalid") == [0, 0]


def test_hits_mark_the_window_before_them(spark):
    t = Timeline()
    df = extend(frame(spark, rows(60, "m", 8)), {"n": "row_number() OVER (PARTITION BY device_id ORDER BY sec)"})
    assert column(extend(df, {"m": constancy.any_hit("n = 5", 180, t)}), "m") == [0, 1, 1, 1, 0, 0, 0, 0]
    result = "CASE n WHEN 3 THEN 5 WHEN 5 THEN 0 WHEN 7 THEN 6 END"
    df = extend(df, {"_latest": constancy.latest_result(result, 180, t)})
    assert column(extend(df, {"m": constancy.if_ahead("_latest")}), "m") == [5, 0, 0, 6, 6, 6, 0, 0]


def test_bounds_are_inclusive_and_null_is_in_bounds(spark):
    df = frame(spark, rows(180, "WS2000", 5, humidity=[0.9, 1.0, 99.0, 99.1, N]))
    assert column(bounds.obc_bounds(df, MODELS["WS2000"]), "humidity__obc") == [1, 0, 0, 1, 0]


def test_rain_limit_widens_by_one_more_slot_along_a_gap(spark):
    params, limit = MODELS["WS1000"], GAUGE_MM * 16
    # One filled slot (counter 1), then a reading (counter 2): three times the limit is still allowed.
    values = [0.0, N, limit * 2.9, limit * 2.9 + limit * 1.1, 0.0]
    df = frame(spark, rows(16, "WS1000", 5, **{RAIN: values}))
    out = bounds.obc_precip(bounds.precip_diff(fill.consec_filling(filled_slots(df, params))), params)
    assert column(out, f"{RAIN}__obc") == [0, 0, 0, 1, 1]


def wind_bins(spark, speed, direction):
    df = frame(spark, rows(180, "WS2000", 600, wind_speed=[speed] * 600, wind_direction=[direction] * 600))
    out = bins.bin_means(bins.bin_readings(checked_slots(df, MODELS["WS2000"]), MODELS["WS2000"]), MODELS["WS2000"])
    return out.filter("parameter = 'wind_direction'").select("avg", "speed_avg").distinct().collect()


@pytest.mark.parametrize(("speed", "given", "mean"), [(2.0, 0.0, 180.0), (2.0, 270.0, 270.0), (0.0, 45.0, 180.0)])
def test_vector_mean_of_constant_wind(spark, speed, given, mean):
    assert [(r["avg"], r["speed_avg"]) for r in wind_bins(spark, speed, given)] == [(mean, speed)]


def test_reward_share_snaps_to_full_only_above_the_threshold(spark):
    data = [("temperature", 20, f) for f in (1, 2, 3)]
    df = spark.createDataFrame(data, "parameter string, num_total_slots bigint, num_faulty bigint")
    out = bins.bin_availability_rewards(df, MODELS["WS2000"]).orderBy("num_faulty").collect()
    assert [r["valid_percentage_rewards"] for r in out] == [100.0, 90.0, 85.0]
    assert [r["ann_all_from_raw_rewards"] for r in out] == [0, 0, 1]


def test_shares_round_half_to_even(spark):
    sql = hours.codes_of({"OBC": "n"}, "total")
    counts = [(1, 16), (3, 16), (0, 16), (0, 0), (1, 3600)]
    df = spark.createDataFrame(counts, "n bigint, total bigint").selectExpr(f"{sql} AS c")
    assert [[(x["code"], x["pct"]) for x in r["c"]] for r in df.collect()] == [
        [("OBC", 6.2)],
        [("OBC", 18.8)],
        [],
        [],
        [("OBC", 0.0)],
    ]


def test_bin_texts_keep_inner_empties_and_append_codes_once(spark):
    values = [15.0] * 600
    for i in range(120, 130):
        values[i] = N
    df = frame(spark, rows(180, "WS2000", 600, temperature=values))
    out = aggregated_bins(checked_slots(df, MODELS["WS2000"]), MODELS["WS2000"], texts=True)
    text = out.filter(f"parameter = '{RAIN}' AND ann_all_from_raw = 1").select("annotation").collect()[0][0]
    assert text == ",".join(["NO_DATA"] * 10 + [""] * 10) + ",NO_DATA_MIN"


def stuck(spark, **series):
    """Flags of a WS2000 series of 10 h whose given variables are stuck from hour 1 on."""
    count = 200
    moving = {p: [v + (i % 7) for i in range(count)] for p, v in (("humidity", 50.0), ("pressure", 1000.0))}
    moving |= {"temperature": [10.0 + (i % 7) for i in range(count)], "wind_speed": [1.0 + i % 3 for i in range(count)]}
    moving |= {"wind_direction": [float(i % 300) for i in range(count)], "illuminance": [float(i) for i in range(count)]}
    for p, v in series.items():
        moving[p] = moving[p][:20] + [v] * 160 + moving[p][180:] if not isinstance(v, list) else v
    df = frame(spark, rows(180, "WS2000", count, **moving))
    params = MODELS["WS2000"]
    return constancy.mark_windows(constancy.stuck_verdicts(filled_slots(df, params), params), params)


def test_frozen_wind_speed_needs_calm(spark):
    cold = [-5.0 + (i % 7) / 10 for i in range(200)]
    calm = stuck(spark, wind_speed=0.0, temperature=cold)
    blowing = stuck(spark, wind_speed=3.0, temperature=cold)
    assert set(column(calm, "wind_speed__frozen")) == {0, 6} and set(column(calm, "wind_speed__const")) == {0}
    assert set(column(blowing, "wind_speed__frozen")) == {0} and set(column(blowing, "wind_speed__const")) == {0, 5}


def test_stuck_window_is_marked_up_to_the_row_before_the_hit(spark):
    flags = column(stuck(spark, pressure=1013.0), "pressure__const")
    assert flags == [0] * 20 + [1] * 160 + [0] * 20


def test_fog_and_darkness_are_not_stuck(spark):
    assert set(column(stuck(spark, humidity=95.0), "humidity__const")) == {0}
    assert 1 in column(stuck(spark, humidity=94.9), "humidity__const")
    assert set(column(stuck(spark, illuminance=0.0), "illuminance__const")) == {0}
