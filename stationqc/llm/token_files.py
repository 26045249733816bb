"""Token ids in compressed blocks, written in ascending doc_id order and read back.

Writing deals the texts by ranges of doc_id, one range a part. A part's ids, an end id after every document, go into blocks, which the range coder compresses
one by one; a block is self-contained: it starts from a blank model, and carries a checksum and the index of its documents. A block has whole documents, or
(`cut`) a piece of one that is longer than a block. Blocks are the rows of a Parquet table, so that any file system works and a lost task leaves nothing behind.

Reading decodes blocks wherever they lie; only the pieces of longer documents are brought together, by part and number.

Null and empty texts are an end id alone. Rows that repeat are written each, in the order of their texts. A null doc_id comes first. Ids must be below
65,536. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationqc.llm import range_coder, tokens
from stationqc.llm.common import read, shared_folder

END_ID = 0

_BLOCKS = "part int, block int, n long, cut boolean, data binary"
_PIECES = "part int, number long, doc_id long, start long, n_tokens long, at long, ids binary"
#: Columns of a block's index: the documents in it, by their number in the part, and how many of their ids the block has.
_INDEX = ("number", "doc_id", "is_null", "start", "n_tokens", "at", "count")


def _index(rows: list[tuple[int, ...]]) -> bytes:
    table = np.array(rows, "<i8").reshape(-1, len(_INDEX)).T
    return struct.pack("<I", table.shape[1]) + zlib.compress(np.diff(table, axis=1, prepend=0).tobytes())


def _rows(index: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<I", index)
    return np.frombuffer(zlib.decompress(index[4:]), "<i8").reshape(len(_INDEX), n).cumsum(axis=1).T


class _Stream:
    """Ids of documents in a row, given out as coded blocks."""

    def __init__(self) -> None:
        self.docs: list[tuple[tuple[int, ...], np.ndarray]] = []  # (number, doc_id, is_null, start), ids
        self.waiting = self.end = self.numbers = self.blocks = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(((self.numbers, doc_id or 0, int(doc_id is None), self.end), ids))
        self.numbers, self.end, self.waiting = self.numbers + 1, self.end + len(ids), self.waiting + len(ids)

    def full(self) -> bool:
        return self.waiting * 5 >= range_coder.BLOCK * 4

    def coded(self) -> Iterator[tuple[int, int, bool, bytes]]:
        """(block, ids, cut, data) of all that waits."""
        length = range_coder.BLOCK
        blocks: list[tuple[list[np.ndarray], list[tuple[int, ...]], bool]] = []
        room = 0
        for about, ids in self.docs:
            if len(ids) > length:
                blocks += [([ids[at : at + length]], [(*about, len(ids), at, min(length, len(ids) - at))], True) for at in range(0, len(ids), length)]
                room = 0
            else:
                if len(ids) > room:
                    blocks.append(([], [], False))
                    room = length
                blocks[-1][0].append(ids), blocks[-1][1].append((*about, len(ids), 0, len(ids)))
                room -= len(ids)
        self.docs, self.waiting = [], 0
        for parts, rows, cut in blocks:
            ids = np.concatenate(parts)
            yield self.blocks, len(ids), cut, range_coder.encode([ids], [_index(rows)])[0]
            self.blocks += 1


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID, parts: int | None = None, tokenizer: str | None = None) -> None:
    """Writes the blocks of docs (doc_id, text) to a new table at path."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, part = _Stream(), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)

        def out() -> Iterator[pa.RecordBatch]:
            for block, n, cut, data in stream.coded():
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([n], pa.int64()), pa.array([cut]), pa.array([data], pa.binary())], names=["part", "block", "n", "cut", "data"])

        with tokens.task_encoder(tokenizer) as encoder:
            for batch in batches:
                for some in tokens.slices(batch, "text"):
                    for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True):
                        stream.add(doc_id, np.concatenate([np.frombuffer(encoder.encode(text or ""), "<u4"), end]))
                        if stream.full():
                            yield from out()
            yield from out()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ordered.mapInArrow(encode, _BLOCKS).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) of the blocks at path."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in zip(batch.column("part").to_pylist(), batch.column("data"), strict=True):
                ((ids, index),) = range_coder.decode([block.as_py()])
                rows = _rows(index)
                ends = rows[:, 6].cumsum()
                data = ids.astype("<u4").tobytes()
                pieces = [data[4 * int(e - c) : 4 * int(e)] for e, c in zip(ends, rows[:, 6], strict=True)]
                columns = [pa.array(np.full(len(rows), part), pa.int32()), pa.array(rows[:, 0]), pa.array(rows[:, 1], mask=rows[:, 2].astype(bool)), pa.array(rows[:, 3]), pa.array(rows[:, 4]), pa.array(rows[:, 5]), pa.array(pieces, pa.binary())]
                yield pa.record_batch(columns, names=["part", "number", "doc_id", "start", "n_tokens", "at", "ids"])

    # A row per part, not per document.
    sizes = blocks.groupBy("part").agg(F.sum("n").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("base"))
    columns = ["part", "doc_id", "start", "n_tokens", "ids"]
    whole = blocks.filter("not cut").select("part", "data").mapInArrow(decode, _PIECES).select(*columns)
    cut = blocks.filter("cut").select("part", "data").mapInArrow(decode, _PIECES)
    cut = cut.groupBy("part", "number", "doc_id", "start", "n_tokens").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("pieces"))
    cut = cut.withColumn("ids", F.aggregate("pieces.ids", F.lit(b""), lambda a, x: F.concat(a, x))).select(*columns)
    return whole.unionByName(cut).join(F.broadcast(bases), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_tokens(read(spark, sf_dir, "documents", "doc_id", "text"), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
