"""Parameters of the two station models.

The numbers below are fixed values: results are only right with exactly these.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values -------------------------------------------------------------------------------

# Variables in the order of the input and output schemas.
VARIABLES = (
    "temperature",
    "humidity",
    "wind_speed",
    "wind_direction",
    "pressure",
    "illuminance",
    "precipitation_accumulated",
)
RAIN = "precipitation_accumulated"
WIND = ("wind_speed", "wind_direction")

# Flag codes.
CODE_UNIDENTIFIED = 2
CODE_NO_DATUM = 3
CODE_INVALID = 4
CODE_CONSTANT = 5
CODE_FROZEN = 6
CODE_LONG = 7

HUMIDITY_CEILING = 95.0  # a constant humidity is plausible from here on (fog)
WIND_HUMIDITY_CEILING = 85.0  # same, for a still wind vane or anemometer
FREEZING = 0.0
GAUGE_MM = 0.254  # rain gauge resolution
WARMUP_MINUTES = 360  # context before the scored day
HOUR_SECONDS = 3600
QOD_VERSION = "1.0.6"


@dataclass(frozen=True)
class VariableParams:
    """What one variable of one model is checked against. None = the check does not apply."""

    parameter: str
    bin_minutes: int
    median_availability: float | None
    bin_availability: float
    hour_availability: float
    raw_jump: float | None
    bin_jump: float | None
    stuck_minutes: int | None
    stuck_long_minutes: int | None
    lower: float
    upper: float


@dataclass(frozen=True)
class ModelParams:
    """Sampling step, windows and per-variable parameters of one station model."""

    model: str
    step: int  # seconds between slots
    fill_period: int  # seconds
    median_minutes: int
    two_level: bool  # bins are averaged again into hours
    variables: tuple[VariableParams, ...]

    @property
    def fill_rows(self) -> int:
        return round(self.fill_period / self.step)

    @property
    def tolerance(self) -> int:
        return self.step // 2

    def of(self, parameter: str) -> VariableParams:
        return next(v for v in self.variables if v.parameter == parameter)


def _scaled_jump(raw: float, ceiling: float, per_minutes: int, step: int) -> float:
    """A per-minute jump limit widened to the sampling step, up to a ceiling."""
    return float(min(ceiling, raw * (step / 60) / per_minutes))


WS1000 = ModelParams(
    model="WS1000",
    step=16,
    fill_period=60,
    median_minutes=10,
    two_level=True,
    variables=(
        VariableParams("temperature", 1, 0.67, 0.25, 0.67, 2.0, 3.0, 240, 1440, -40.0, 60.0),
        VariableParams("humidity", 1, 0.67, 0.25, 0.67, 5.0, 10.0, 360, None, 10.0, 99.0),
        VariableParams("wind_speed", 2, 0.75, 0.25, 0.75, 20.0, 10.0, 360, 1440, 0.0, 50.0),
        VariableParams("wind_direction", 2, 0.75, 0.25, 0.75, None, None, 360, 1440, 0.0, 359.0),
        VariableParams("pressure", 1, 0.67, 0.25, 0.67, 0.8, 0.5, 120, None, 300.0, 1100.0),
        VariableParams("illuminance", 1, 0.67, 0.25, 0.67, 97600.0, 97600.0, 120, None, 0.0, 400000.0),
        VariableParams(RAIN, 1, None, 0.25, 0.85, None, None, None, None, 0.0, GAUGE_MM * 16),
    ),
)

WS2000 = ModelParams(
    model="WS2000",
    step=180,
    fill_period=180,
    median_minutes=60,
    two_level=False,
    variables=(
        VariableParams("temperature", 60, 0.67, 0.9, 0.67, _scaled_jump(3, 15, 1, 180), None, 240, 1440, -40.0, 80.0),
        VariableParams("humidity", 60, 0.67, 0.9, 0.67, _scaled_jump(10, 80, 1, 180), None, 360, None, 1.0, 99.0),
        VariableParams("wind_speed", 60, 0.75, 0.9, 0.75, _scaled_jump(10, 15, 2, 180), None, 360, 1440, 0.0, 50.0),
        VariableParams("wind_direction", 60, 0.75, 0.9, 0.75, None, None, 360, 1440, 0.0, 359.0),
        VariableParams("pressure", 60, 0.67, 0.9, 0.67, _scaled_jump(0.8, 15, 1, 180), None, 120, None, 540.0, 1100.0),
        VariableParams(
            "illuminance", 60, 0.67, 0.9, 0.67, _scaled_jump(97600, 146400, 1, 180), None, 120, None, 0.0, 200000.0
        ),
        VariableParams(RAIN, 60, None, 0.9, 0.85, None, None, None, None, 0.0, GAUGE_MM * 180),
    ),
)

# ---- end of fixed values ------------------------------------------------------------------------

MODELS: dict[str, ModelParams] = {m.model: m for m in (WS1000, WS2000)}

# Variables whose raw readings and bins are searched for jumps / for stuck sensors.
JUMPING = tuple(p for p in VARIABLES if p not in ("wind_direction", RAIN))
STICKING = tuple(p for p in VARIABLES if p != RAIN)

# Window lengths in use (minutes), same for both models.
STUCK_WINDOWS = (120, 240, 360, 1440)


def params_df(spark: SparkSession) -> DataFrame:
    """The parameters as a small dimension table, one row per (model, parameter).

    Its size is fixed (models x variables), so it is always safe to broadcast.
    """
    rows = [
        (m.model, m.step, m.fill_period, m.fill_rows, m.median_minutes)
        + tuple(getattr(v, f.name) for f in fields(VariableParams))
        for m in MODELS.values()
        for v in m.variables
    ]
    schema = (
        "model string, step_seconds int, fill_seconds int, fill_rows int, median_minutes int, parameter string, "
        "bin_minutes int, median_availability double, bin_availability double, hour_availability double, "
        "raw_jump double, bin_jump double, stuck_minutes int, stuck_long_minutes int, lower double, upper double"
    )
    return spark.createDataFrame(rows, schema)
