"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document's ids, its end id included, are cut into pieces of SEQUENCE ids while they last and of the powers of two of the rest's
binary form, longest first. A piece is a sequence of its own; `bucket` is its length's exponent, so equal lengths train together
(write with partitionBy("bucket")). There is no shuffle: a text is encoded where it is read.

Null and empty texts are an end id alone. Repeated rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.llm import tokens
from stationqc.llm.common import read

SEQUENCE = 2048
END_ID = 1

_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int"


def lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """The pieces of n ids: as many of `longest` (a power of two) as fit, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def packed(docs: DataFrame, end_id: int = END_ID, longest: int = SEQUENCE, tokenizer: str | None = None) -> DataFrame:
    """Of docs (doc_id, text): a row per piece with its little-endian unsigned 32-bit ids.

    sequence_id is unique and rises within each input split.
    """
    if longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("bucket", pa.int32())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.uint32(end_id).astype("<u4").tobytes()
        with tokens.task_encoder(tokenizer) as encoder:
            for batch in batches:
                for part in tokens.slices(batch, "text"):
                    columns: list[list] = [[] for _ in schema]
                    for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                        ids = encoder.encode(text or "") + end
                        n, start = len(ids) // 4, 0
                        for length in lengths(n, longest):
                            for column, value in zip(columns, (doc_id, start, length, ids[4 * start : 4 * (start + length)], n, length.bit_length() - 1), strict=True):
                                column.append(value)
                            start += length
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, _PIECES)
    return rows.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(packed(read(spark, sf_dir, "documents", "doc_id", "text")))
