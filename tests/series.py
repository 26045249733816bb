"""Small hand-made series for the operator tests."""

from __future__ import annotations

from collections.abc import Sequence

from stationqc.params import VARIABLES

SCHEMA = (
    "device_id string, qod_date date, model string, sec bigint, utc_datetime timestamp_ntz, "
    + ", ".join(f"{p} double" for p in VARIABLES)
)
DEFAULTS = dict(zip(VARIABLES, (15.0, 60.0, 2.0, 90.0, 1010.0, 100.0, 0.0)))
START = 1704045600  # 2023-12-31 18:00:00


def rows(
    step: int,
    model: str,
    count: int,
    device: str = "d",
    start: int = START,
    secs: Sequence[int] | None = None,
    **series: Sequence[float | None],
):
    import datetime as dt

    secs = secs or [i * step for i in range(count)]
    out = []
    for i, s in enumerate(secs):
        values = [series[p][i] if p in series else DEFAULTS[p] for p in VARIABLES]
        at = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=start + s)
        out.append((device, dt.date(2024, 1, 1), model, start + s, at, *values))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def column(df, name: str) -> list:
    return [r[0] for r in df.orderBy("sec").select(name).collect()]
