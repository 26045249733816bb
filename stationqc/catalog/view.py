"""Telemetry derived from the ``events`` table: one slot per event, stations numbered by ``event_id``.

The rules plant gaps, out-of-bounds readings, spikes and stuck sensors at known slots of known stations; ``value``
supplies the ordinary variation. Day scored: 2024-01-01, with six hours of context before it. The last station of a
table is usually a partial one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.functions.columns import epoch_seconds
from stationqc.params import MODELS

QOD_DATE = "2024-01-01"
START = "2023-12-31 18:00:00"
SLOTS = {"WS1000": 6750, "WS2000": 600}  # of a full station: 30 hours

VIEW_SQL = """
WITH b AS (
  SELECT CAST(floor(event_id / CAST({N} AS DOUBLE)) AS BIGINT) AS st, event_id % {N} AS s,
         (event_id % {N}) * {step} AS rel, CAST(floor(value) AS BIGINT) % 10 AS h
  FROM {events}),
g AS (SELECT *, rel >= 32400 AND rel < 64800 AS seg FROM b)
SELECT '{model}-' || CAST(st AS VARCHAR(20)) AS device_id, '{model}' AS model,
  {T0} + rel * INTERVAL '1' SECOND AS utc_datetime,
  CASE WHEN st % 8 <> 5 AND (s IN (100,130,131,132) OR (s >= 480 AND s < 500)) THEN NULL
       WHEN st % 8 = 5 THEN 12e0
       WHEN s = 422 THEN -45e0
       WHEN st % 4 = 3 THEN -5e0 - (h % 3) * 5e-1
       WHEN seg AND st % 4 = 1 THEN 12e0
       WHEN s % 97 IN (50, 51) THEN 75e0
       ELSE 15e0 + (h % 3) * 5e-1 END AS temperature,
  CASE WHEN s = 60 THEN NULL WHEN s = 300 THEN 1e2
       WHEN seg AND st % 4 = 1 THEN 55e0 WHEN seg AND st % 4 = 2 THEN 97e0
       ELSE 60e0 + (h % 5) END AS humidity,
  CASE WHEN s = 420 THEN 6e1 WHEN seg AND st % 4 <> 2 THEN 0e0 ELSE (h % 4) * 1e0 END AS wind_speed,
  CASE WHEN s = 424 AND st % 8 <> 5 THEN 4e2 WHEN st % 8 = 5 OR (seg AND st % 2 = 1) THEN 18e1
       ELSE ((s * 7 + h) % 360) * 1e0 END AS wind_direction,
  CASE WHEN s = 423 THEN 2e2 WHEN seg AND st % 4 = 1 THEN 1013e0 WHEN s % 211 = 205 THEN 1025e0
       ELSE 1010e0 + (h % 3) * 1e-1 END AS pressure,
  CASE WHEN s = 421 THEN 45e4 WHEN seg AND st % 4 = 1 THEN 5e3 WHEN rel < 21600 THEN 0e0
       ELSE (s * 50 + h) * 1e0 END AS illuminance,
  (s - s % 20) * 127e-4 + CASE WHEN s = 400 THEN 2e3 ELSE 0e0 END AS precipitation_accumulated
FROM g
"""


def readings(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """Telemetry in the input schema, without any scored day assigned."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    params = MODELS[model]
    sql = VIEW_SQL.format(
        N=SLOTS[model], step=params.step, model=model, T0=f"TIMESTAMP_NTZ '{START}'", events="{events}"
    )
    return spark.sql(sql, events=events)


def telemetry(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """Telemetry of the scored day and its context, one row per slot, as the operators take it."""
    return readings(spark, sf_dir, model).withColumns(
        {"qod_date": F.lit(QOD_DATE).cast("date"), "sec": F.expr(epoch_seconds("utc_datetime"))}
    )
