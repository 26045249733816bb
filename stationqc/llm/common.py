"""Helpers that the operators share: reading tables, intermediate tables in the shared folder, words in SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as all contracts define it; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table `name` of `sf_dir`, only the named columns."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Where it is unset, only a local master gets a folder of its own."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="stationqc-llm-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder: cuts the lineage, survives lost executors, and is computed once."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Only the columns that an operator works on, whatever else the table carries."""
    return df.select(*[df[c] for c in columns])


def words(text: Column) -> Column:
    """The words of a text, in order; none of a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    """The number of words, without building them: the length of what is left when each becomes one mark."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.translate(marked, SPACE_CHARS, "")).cast("long")


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once for the row, however often body uses it."""
    return F.transform(F.array(value), body)[0]
