"""Input and output schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationqc.params import VARIABLES

INPUT_TYPES: dict[str, T.DataType] = (
    {"device_id": T.StringType()}
    | {p: T.DoubleType() for p in VARIABLES}
    | {"model": T.StringType(), "utc_datetime": T.TimestampNTZType()}
)

OUTPUT_TYPES: dict[str, T.DataType] = (
    {"device_id": T.StringType(), "qod_date": T.DateType()}
    | {f"{p}_score": T.DoubleType() for p in VARIABLES}
    | {f"{p}_annotation": T.StringType() for p in VARIABLES}
    | {f"daily_{p}_annotation": T.StringType() for p in VARIABLES}
    | {
        "daily_annotation": T.StringType(),
        "model": T.StringType(),
        "qod_score": T.DoubleType(),
        "hourly_score": T.DoubleType(),
        "qod_version": T.StringType(),
        "year": T.IntegerType(),
        "month": T.IntegerType(),
        "day": T.IntegerType(),
        "hour": T.IntegerType(),
    }
)


def input_schema() -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in INPUT_TYPES.items()])


def output_schema() -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in OUTPUT_TYPES.items()])


def to_input_schema(df: DataFrame) -> DataFrame:
    """Cast to the input types; NaN readings count as missing. A value that cannot be cast fails the job (ANSI)."""

    def cast(name: str, kind: T.DataType):
        c = F.col(name).cast(kind)
        return F.nanvl(c, F.lit(None).cast("double")) if kind == T.DoubleType() else c

    return df.select(*[cast(n, t).alias(n) for n, t in INPUT_TYPES.items()])


def to_output_schema(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in OUTPUT_TYPES.items()])
