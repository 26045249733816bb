"""The slot stage sorts its rows once, and its medians are those of whole series."""

import pytest
from pyspark.sql import functions as F

from stationqc.catalog import queries
from stationqc.catalog.view import telemetry
from stationqc.operators import bins, constancy, jumps
from stationqc.params import JUMPING, MODELS, VARIABLES
from stationqc.plans.slots import checked_slots, filled_slots
from test_forms import data, frame


@pytest.mark.parametrize("model", list(MODELS))
@pytest.mark.parametrize("audit", [False, True])
def test_slots_are_sorted_once(spark, model, audit):
    checked = checked_slots(telemetry(spark, "/root/testdata/sf0.1", model), MODELS[model], audit=audit)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[-1]
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1


def test_medians_of_tied_rows_and_of_jumps(spark):
    params = MODELS["WS2000"]
    df = frame(spark, data(range(6)))
    checked = checked_slots(df, params, audit=True)
    medians = jumps.raw_median(filled_slots(df, params), params).select("device_id", "sec", *[F.col(f"{p}__median").alias(f"{p}_theirs") for p in JUMPING])
    both = checked.join(medians, ["device_id", "sec"])
    same = [F.col(f"{p}__median").eqNullSafe(F.col(f"{p}_theirs")) for p in JUMPING]
    assert both.count() > 3000 and all(both.filter(~s).count() == 0 for s in same)
    # The flags of stuck sensors, whose verdicts rest on the medians of ties.
    flags = [f"{p}__{k}" for p in ("temperature", "wind_direction", "wind_speed") for k in constancy.KINDS]
    theirs = constancy.constancy(filled_slots(df, params), params).select("device_id", "sec", *flags)
    assert checked.select("device_id", "sec", *flags).exceptAll(theirs).count() == 0


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


@pytest.mark.parametrize("model", list(MODELS))
def test_rows_of_the_slot_stage_stay_narrow(spark, model):
    """What a row's cost grows with: the columns that windows carry, and the functions of the aggregate over all variables."""
    hours = queries.hourly(telemetry(spark, "/root/testdata/sf0.001", model), MODELS[model])
    plan = [(n.nodeName(), n.output().size()) for n in nodes(hours._jdf.queryExecution().executedPlan().initialPlan())]
    after_slots = [name for name, _ in plan].index("Generate")
    windows = [size for name, size in plan[after_slots:] if name == "Window"]
    assert len(windows) == 6 and max(windows) <= 56 and sum(windows[:3]) <= 110
    assert max(size for name, size in plan if name == "HashAggregate") <= 40


@pytest.mark.parametrize("model", list(MODELS))
@pytest.mark.parametrize("means", ["all", "none"])
def test_counts_of_bins_are_those_of_their_slots(spark, model, means):
    params = MODELS[model]
    slots = checked_slots(frame(spark, data(range(6))), params)
    slots = slots.select("*", *[F.col(f"{p}__faulty").alias(f"{p}__again") for p in VARIABLES])
    got = bins.bin_readings(slots, params, means=means)
    for p in VARIABLES:
        seconds = params.of(p).bin_minutes * 60
        start = F.expr(f"sec - sec % {seconds}").alias("bin")
        plain = {"num_total_slots": "count(1)", "num_time_slots": f"count({p})", "num_faulty": f"sum({p}__again)"}
        plain |= {f"n_{f}": f"count_if({p}__{f} > 0)" if f in bins.APPLICABLE[p] else "0L" for f in jumps.RAW_FLAGS}
        if means == "all":
            mean = f"avg(if({p}__faulty = 0, {p}, NULL))" if p in bins.SCALARS else "CAST(NULL AS DOUBLE)"
            plain["mean_clean"] = mean
        theirs = slots.groupBy("device_id", start).agg(*[F.expr(sql).cast("double").alias(n) for n, sql in plain.items()])
        ours = got.filter(F.col("parameter") == p).select("device_id", "bin", *[F.col(n).cast("double") for n in plain])
        rounded = [F.round(n, 6).alias(n) for n in plain]
        ours, theirs = (df.select("device_id", "bin", *rounded) for df in (ours, theirs))
        assert ours.count() == theirs.count() > 0 and ours.exceptAll(theirs).count() == 0


def test_a_bin_of_more_rows_than_counts_hold_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(bins, "MOST_ROWS", 15)
    slots = checked_slots(frame(spark, data(range(1))), MODELS["WS2000"])
    with pytest.raises(Exception, match="more rows in a bin"):
        bins.bin_readings(slots, MODELS["WS2000"]).agg(F.sum("num_faulty")).collect()
