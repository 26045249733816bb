"""A training corpus from `documents`: toxic texts out, one document of each group of near copies, secrets masked, sources mixed, packed.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again as the next stage's docs. All but the last give
the columns of `documents`; stages look at nothing but what the stage before has kept (and the labels, for toxicity).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationqc.llm import jaccard_join, mixing, packing, secrets, toxicity
from stationqc.llm.common import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic. It learns from the labelled rows among docs that aren't held out."""
    return toxicity.clean(docs, toxicity.fitted(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id. Rows that share a doc_id are judged each: those of one group by their texts' order.

    Documents without words link with nothing and stay. Rows without a doc_id stay, since no group can be named after them.
    """
    found = jaccard_join.labelled(docs).filter("component_id = doc_id").select("doc_id", "text_hash", "component").distinct()
    # A row's own columns travel in one, whatever their names.
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).join(found, ["doc_id", "text_hash"])
    # A group has only one doc_id here: rows that share it are ranked.
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id", "component").orderBy("row.text")))
    return rows.filter("rank = 1 or component is null").select("row.*").unionByName(docs.filter("doc_id is null"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; spans of secrets give way to a mask."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target asks, as rows."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in sequences: a row per piece, with its ids."""
    pieces = packing.packed(docs)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("secret_scan", mask_secrets),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

#: The first, second, third and last stage can't be put in SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
