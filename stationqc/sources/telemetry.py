"""Reading telemetry, assigning rows to scored days, writing scores."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationqc.functions.columns import epoch_seconds, extend
from stationqc.functions.windows import KEYS
from stationqc.params import MODELS, VARIABLES
from stationqc.schema import INPUT_TYPES, to_input_schema

CONTEXT_HOURS = 6
EVENING = 24 - CONTEXT_HOURS
#: Stations that become literals of a plan, and paths whose footers are asked for at a time.
LISTED, FOOTERS_AT_A_TIME = 1_000, 16
#: Readings that a bucket holds on average, and the least number of buckets, where the caller names none.
BUCKET_ROWS, LEAST_BUCKETS = 200_000, 16


def read_telemetry(
    spark: SparkSession,
    paths: str | Sequence[str],
    device_ids: Sequence[str] | DataFrame | None = None,
    dates: Sequence[date] | None = None,
) -> DataFrame:
    """Parquet telemetry of any number of stations and days, in the input schema.

    Paths whose files have the same column types (``utc_datetime`` may be text) are one scan together, so years of day files plan like
    a few. Station and time filters reach the scan; ``device_ids`` may be a table with that column.
    """
    every = [
        spark.read.schema(schema).parquet(*some)
        for schema, some in by_types(spark, [paths] if isinstance(paths, str) else list(paths))
    ]
    days = [to_input_schema(_text_days(raw, dates)) for raw in every]
    return select_rows(union_days(*days), device_ids, dates)


def write_telemetry(df: DataFrame, table: str, buckets: int | None = None, path: str | None = None) -> None:
    """Telemetry as a table that needs no exchange of readings to be scored: a folder per model, its rows dealt into buckets by station.

    All rows of a station and model are in one bucket, in the order of their times. A task scores one bucket and needs memory for it, so
    their number follows the rows (a count of its own) unless ``buckets`` names one. A ``path`` keeps the files outside the warehouse. Rows
    of other models are written too, in folders of their own.
    """
    buckets = buckets or _buckets_of(df)
    dealt = to_input_schema(df).repartition(buckets, "device_id")
    writer = dealt.write.mode("overwrite").partitionBy("model").bucketBy(buckets, "device_id").sortBy("device_id", "utc_datetime")
    (writer.option("path", path) if path else writer).format("parquet").saveAsTable(table)


def _buckets_of(df: DataFrame) -> int:
    most = int(df.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(LEAST_BUCKETS, -(-df.count() // BUCKET_ROWS)))


def read_table(
    spark: SparkSession,
    table: str,
    device_ids: Sequence[str] | DataFrame | None = None,
    dates: Sequence[date] | None = None,
) -> DataFrame:
    """Telemetry of a table, such as :func:`write_telemetry` makes, in the input schema; filters as in :func:`read_telemetry`."""
    return select_rows(to_input_schema(spark.table(table)), device_ids, dates)


def by_types(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The paths, grouped by the types of the input columns in their files.

    One job looks at all footers and is the end of it where they agree. Where they don't, each path is asked, some at a time.
    """
    try:
        merged = spark.read.option("mergeSchema", True).parquet(*paths).schema
        return [(_input_columns(merged), list(paths))]
    except Exception:
        if len(paths) == 1:
            raise
    with ThreadPoolExecutor(FOOTERS_AT_A_TIME) as pool:
        schemas = list(pool.map(lambda path: _input_columns(spark.read.parquet(path).schema), paths))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, path in zip(schemas, paths, strict=True):
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return list(groups.values())


def _input_columns(schema: T.StructType) -> T.StructType:
    """Only the input's columns, in its order: files that differ in others, or in their order, are read alike."""
    there = {f.name: f for f in schema}
    missing = [c for c in INPUT_TYPES if c not in there]
    if missing:
        raise ValueError(f"telemetry without the columns {missing}")
    return T.StructType([T.StructField(c, there[c].dataType) for c in INPUT_TYPES])


def _text_days(raw: DataFrame, dates: Sequence[date] | None) -> DataFrame:
    """Of times that are text, those from the day before the first named day to the last one: texts of this form sort like times, and
    such a filter prunes the scan, as one on the cast could not."""
    if not dates or dict(raw.dtypes)["utc_datetime"] != "string":
        return raw
    first, last = min(dates) - timedelta(days=1), max(dates) + timedelta(days=1)
    return raw.filter((F.col("utc_datetime") >= first.isoformat()) & (F.col("utc_datetime") < last.isoformat()))


def select_rows(
    df: DataFrame, device_ids: Sequence[str] | DataFrame | None = None, dates: Sequence[date] | None = None
) -> DataFrame:
    """Keep the named stations, and the time range the named days need.

    Up to ``LISTED`` stations are literals of the plan. More, or a table of them, are a semi join, broadcast while Spark measures the
    table as small enough; the least and the greatest name of a list still prune the scan.
    """
    if isinstance(device_ids, DataFrame):
        df = df.join(device_ids.select("device_id").distinct(), "device_id", "left_semi")
    elif device_ids is not None and len(device_ids) > LISTED:
        named = sorted(set(device_ids))
        df = df.filter(F.col("device_id").between(named[0], named[-1]))
        table = df.sparkSession.createDataFrame(pa.table({"device_id": pa.array(named, pa.string())}))
        df = df.join(table, "device_id", "left_semi")
    elif device_ids is not None:
        df = df.filter(F.col("device_id").isin(*device_ids))
    if dates:
        first = F.lit(min(dates)).cast("timestamp_ntz") - F.expr(f"INTERVAL '{CONTEXT_HOURS}' HOUR")
        last = F.lit(max(dates)).cast("timestamp_ntz") + F.expr("INTERVAL '86399' SECOND")
        df = df.filter((F.col("utc_datetime") >= first) & (F.col("utc_datetime") <= last))
    return df


def union_days(*days: DataFrame) -> DataFrame:
    first, *rest = days
    for d in rest:
        first = first.unionByName(d)
    return first


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop exact copies. Copies meet on the map side first, so a row repeated many times is shuffled few times."""
    return df.dropDuplicates()


def one_row_per_second(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Of the rows of one second of a series, the one with the fewest missing values, then the earliest, then the smallest.

    One aggregate that combines on the map side, as copies do: however many rows a station sends in a second, different or
    not, each map task hands on one. So a station-day has at most one row per second wherever its rows meet.
    """
    missing = " + ".join(f"if({p} IS NULL, 1, 0)" for p in VARIABLES)
    carried = [c for c in df.columns if c not in ("utc_datetime", *VARIABLES)]
    by = list(dict.fromkeys([*keys, "sec", *carried]))
    values = [c for c in ("utc_datetime", *VARIABLES) if c in df.columns]
    chosen = df.groupBy(*by).agg(F.expr(f"min(struct({missing} AS missing, {', '.join(values)}))").alias("_row"))
    return chosen.select(*[F.col(f"_row.{c}") if c in values else F.col(c) for c in df.columns])


def conflicting_rows(df: DataFrame) -> DataFrame:
    """Times for which a station sent different rows, with how many; what :func:`one_row_per_second` has to choose from."""
    return (
        dedup_rows(df)
        .groupBy("device_id", "utc_datetime")
        .agg(F.count(F.lit(1)).alias("variants"))
        .filter("variants > 1")
    )


def with_qod_date(df: DataFrame) -> DataFrame:
    """Give each row the day(s) it is needed for: its own, and from 18:00 the next day's context as well.

    Adds ``qod_date`` and ``sec``. Whole seconds only: a fraction past 23:59:59 is outside its own day's window.
    """
    day = F.to_date("utc_datetime")
    evening = F.hour("utc_datetime") >= EVENING
    in_day = F.col("utc_datetime") <= day.cast("timestamp_ntz") + F.expr("INTERVAL '86399' SECOND")
    days = F.array_compact(F.array(F.when(in_day, day), F.when(evening, F.date_add(day, 1))))
    return df.withColumns({"sec": F.expr(epoch_seconds("utc_datetime")), "qod_date": F.explode(days)})


def rejected_rows(df: DataFrame) -> DataFrame:
    """Rows of a station model nobody knows; they cannot be scored."""
    return df.filter(F.col("model").isNull() | ~F.col("model").isin(*MODELS))


def write_scores(df: DataFrame, path: str) -> None:
    """Parquet, one folder per scored day; a rerun replaces only the days it produced.

    Rows are dealt by day first, large days over several tasks and small ones together, so that files follow the data's size.
    """
    dealt = df.sparkSession.sql("SELECT /*+ REBALANCE(qod_date) */ * FROM {scores}", scores=df)
    (
        dealt.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("qod_date")
        .parquet(path)
    )


