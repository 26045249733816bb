"""Alignment of two tokenizers' ids over a corpus: which ids cover the same bytes, and how many documents link them.

A text is encoded by A (byte-level BPE) and B (pieces with byte fallback). Byte offsets where tokens of both end cut them into groups; ids within a group are
linked. Most groups are one A id and the one B id with the same bytes, which an array over A's vocabulary tells (`Aligner.same`): they
are counted in vectors as long as that vocabulary, one a task. All other pairs are summed in the task first, and only these sums are shuffled.

The aligned documents are a table in the shared folder: per document its numbers and, once for each id and pair, how many links it has. Counts are given
back from it: the vector always, the irregular pairs as a sorted array while there are at most PAIRS of them, and by a join beyond.

Neither tokenizer merges across a single space between two other characters, so what lies between such spaces is aligned on its own and remembered in a
bounded table that ends with the task. Null and empty texts, and texts that one of the two changes (U+2581 is a space to B), have no tokens: zeros. Strings
of special tokens are plain text. Repeated rows are documents each; null doc_ids are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.llm.common import read, written
from stationqc.llm.tokens import slices

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Stretches of text that a task remembers (some 500 bytes each) and irregular pairs that it holds before it hands on their sums.
REMEMBERED, HELD = 150_000, 1_000_000
#: Stretches that are encoded in one go, and pairs of a group up to which they are written out one by one before they are summed.
TOGETHER, LARGE = 10_000, 10_000
#: Irregular pairs, of 17 bytes each, up to which every task is given their counts.
PAIRS = 2_000_000

_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same binary, same_links binary, pairs binary, pair_links binary"
_SPLIT = re.compile(r"(?<=\S)(?= \S)")
_OTHER_SPACE = re.compile(r" \s|\s ")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones are themselves, the others follow from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, their ids' bytes, and the stretches met so far. Numbers of stretches are indices into flat arrays."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_level()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE.fullmatch(piece)
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        # Of several B ids with the same bytes the last, which is the piece and not the byte.
        ids = {piece: i for i, piece in enumerate(self.b_bytes)}
        self.same = np.array([ids.get(token, -1) for token in self.a_bytes], np.int64)
        self.a_sizes, self.b_sizes = (np.array([len(token) for token in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.ids = max(len(self.a_bytes), len(self.b_bytes))
        self.written = [f"{i}{end}" for end in ",|;" for i in range(self.ids)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.numbers = array("q")  # per stretch: n_a, n_b, n_groups, n_links; n_a is -1 where a tokenizer changes the text
        self.strings: list[str] = []
        self.same_ends, self.same_ids, self.same_links = array("q", [0]), array("I"), array("q")
        self.pair_ends, self.pair_keys, self.pair_links = array("q", [0]), array("Q"), array("q")

    def _align(self, texts: list[str], a_ids: list[int], b_ids: list[int]) -> bool:
        """Remembers the stretches, whose ids follow one another; False if the ids' bytes are not those of the stretches."""
        encoded = [t.encode() for t in texts]
        whole = b"".join(encoded)
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != whole or b"".join(map(self.b_bytes.__getitem__, b_ids)) != whole:
            return False
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_ends, b_ends, ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]), np.cumsum([len(t) for t in encoded])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not np.isin(ends, cuts).all():
            return False
        a_group, b_group, stretch = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends), np.searchsorted(ends, cuts)
        a_size, b_size = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        a_first, b_first = np.cumsum(a_size) - a_size, np.cumsum(b_size) - b_size
        n = len(texts)
        per_stretch = lambda values: np.bincount(stretch, values, n).astype(np.int64)
        n_a, n_b = per_stretch(a_size), per_stretch(b_size)
        self.numbers.frombytes(np.stack([n_a, n_b, per_stretch(np.ones(len(cuts))), per_stretch(a_size * b_size)], axis=1).tobytes())

        # Groups as text: the A ids of a group, its B ids, the next group.
        parts = np.empty(len(a) + len(b), np.int64)
        place = np.arange(len(a))
        parts[place + b_first[a_group]] = a + self.ids * (place + 1 == (a_first + a_size)[a_group])
        place = np.arange(len(b))
        parts[place + (a_first + a_size)[b_group]] = b + 2 * self.ids * (place + 1 == (b_first + b_size)[b_group])
        written = list(map(self.written.__getitem__, parts.tolist()))
        bounds = np.cumsum(n_a + n_b).tolist()
        self.strings += ["".join(written[start:stop]) for start, stop in zip([0, *bounds], bounds)]

        # One A id and the B id with the same bytes: most groups. All others give each pair of their different ids.
        plain = (a_size == 1) & (b_size == 1)
        plain[plain] = self.same[a[a_first[plain]]] == b[b_first[plain]]
        large = np.flatnonzero(~plain & (a_size * b_size > LARGE))
        small = np.flatnonzero(~plain & (a_size * b_size <= LARGE))
        sizes = (a_size * b_size)[small]
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        width = np.repeat(b_size[small], sizes)
        found = [(np.repeat(stretch[small], sizes), a[np.repeat(a_first[small], sizes) + at // width], b[np.repeat(b_first[small], sizes) + at % width], np.ones(len(at), np.int64))]
        for g in large:
            x, m = np.unique(a[a_first[g] : a_first[g] + a_size[g]], return_counts=True)
            y, k = np.unique(b[b_first[g] : b_first[g] + b_size[g]], return_counts=True)
            found.append((np.full(len(x) * len(y), stretch[g]), np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(m, k).ravel()))
        of, x, y, links = map(np.concatenate, zip(*found))
        is_same = self.same[x] == y
        self._keep(self.same_ends, self.same_ids, self.same_links, n, np.r_[stretch[plain], of[is_same]], np.r_[a[a_first[plain]], x[is_same]].astype(np.uint32), np.r_[np.ones(plain.sum(), np.int64), links[is_same]])
        other = ~is_same
        self._keep(self.pair_ends, self.pair_keys, self.pair_links, n, of[other], (x[other] << 32 | y[other]).astype(np.uint64), links[other])
        return True

    @staticmethod
    def _keep(ends: array, keys: array, links: array, n: int, stretch: np.ndarray, new_keys: np.ndarray, new_links: np.ndarray) -> None:
        order = np.argsort(stretch, kind="stable")
        ends.frombytes((ends[-1] + np.cumsum(np.bincount(stretch, minlength=n))).astype(np.int64).tobytes())
        keys.frombytes(new_keys[order].tobytes()), links.frombytes(new_links[order].astype(np.int64).tobytes())

    def _learn(self, new: list[str]) -> None:
        alone = []
        # Stretches that begin and end with other than space are encoded in a row: their ids are those of each.
        rows = [s for s in new if s[1:] and not s[1].isspace() and not s[-1].isspace() and "\u2581" not in s]
        for start in range(0, len(rows), TOGETHER):
            some = rows[start : start + TOGETHER]
            text = "".join(some)
            before = len(self.strings)
            if self._align(some, self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])):
                self.known.update(zip(some, range(before, before + len(some)), strict=True))
            else:
                alone += some
        for s in [*alone, *set(new).difference(rows)]:
            self.known[s] = len(self.strings)
            if not self._align([s], self.a.encode_batch_fast([s], add_special_tokens=False)[0].ids, self.b.encode(s[1:])):
                self.numbers.extend((-1, 0, 0, 0))
                self.strings.append("")
                self.same_ends.append(self.same_ends[-1]), self.pair_ends.append(self.pair_ends[-1])

    def stretches(self, texts: list[list[str]]) -> list[list[int]]:
        """Numbers of the stretches of each text; new ones are aligned together."""
        new = set().union(*texts).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.forget()
            new = set().union(*texts)
        self._learn(list(new))
        return [list(map(self.known.__getitem__, text)) for text in texts]


def split(text: str) -> list[str]:
    """The stretches of a text, each led by its space: the one that both tokenizers are given before the text is the first one's."""
    if _OTHER_SPACE.search(text) or text[0].isspace() or text[-1].isspace():
        return _SPLIT.split(" " + text)
    return [" " + s for s in text.split(" ")]


def _summed(keys: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, and the sum of links of each."""
    if not len(keys):
        return keys, links
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], links[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(links, starts)


def _gathered(ends: np.ndarray, keys: np.ndarray, links: np.ndarray, rows: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    starts, sizes = ends[rows], ends[rows + 1] - ends[rows]
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    found, n = _summed(keys[at], links[at] * np.repeat(times, sizes))
    return found.tobytes(), n.tobytes()


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, groups: bool = False) -> DataFrame:
    """Per row of docs (doc_id, text) its numbers, the digest of its groups, and its links by A id (same bytes) and by pair of ids (a << 32 | b).

    `groups` adds the groups themselves, as text.
    """
    fields = [f.split() for f in (_ALIGNED + ", groups string" * groups).split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(name, types[t]) for name, t in fields])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        both = Aligner(a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE))
        for batch in batches:
            for some in slices(batch, "text"):
                texts = some.column("text").to_pylist()
                found = both.stretches([split(t) if t else [] for t in texts])
                numbers = np.array(both.numbers, np.int64).reshape(-1, 4)
                same = [np.array(x) for x in (both.same_ends, both.same_ids, both.same_links)]
                pairs = [np.array(x) for x in (both.pair_ends, both.pair_keys, both.pair_links)]
                columns: list[list] = [[] for _ in fields]
                for doc_id, rows in zip(some.column("doc_id").to_pylist(), found, strict=True):
                    at, times = np.unique(np.array(rows, np.int64), return_counts=True)
                    if not rows or numbers[at, 0].min() < 0:
                        row = (doc_id, 0, 0, 0, 0, "", b"", b"", b"", b"", "")
                    else:
                        text = "".join(map(both.strings.__getitem__, rows))[:-1]
                        row = (doc_id, *(times @ numbers[at]).tolist(), hashlib.sha256(text.encode()).hexdigest(), *_gathered(*same, at, times), *_gathered(*pairs, at, times), text)
                    for column, value in zip(columns, row):
                        column.append(value)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(align, ", ".join(map(" ".join, fields)))


def _flat(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def document_counts(table: DataFrame, same: np.ndarray) -> DataFrame:
    """(a, b, n): the documents of an aligned table that link each pair of ids."""

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array((keys >> 32).astype(np.int64)), pa.array((keys & 0xFFFFFFFF).astype(np.int64)), pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(same), np.int64)
        waiting, size = [], 0
        for batch in batches:
            vector += np.bincount(_flat(batch.column("same"), np.uint32), minlength=len(same))
            keys, n = np.unique(_flat(batch.column("pairs"), np.uint64), return_counts=True)
            waiting.append((keys, n))
            size += len(keys)
            if size > HELD:
                keys, n = _summed(*map(np.concatenate, zip(*waiting)))
                waiting, size = [(keys, n)], len(keys)
                if size * 2 > HELD:
                    yield rows(keys, n)
                    waiting, size = [], 0
        if waiting:
            yield rows(*_summed(*map(np.concatenate, zip(*waiting))))
        a = np.flatnonzero(vector)
        yield rows(a.astype(np.uint64) << np.uint64(32) | same[a].astype(np.uint64), vector[a])

    return table.select("same", "pairs").mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def with_counts(table: DataFrame, same: np.ndarray, pairs: int = PAIRS) -> DataFrame:
    """The aligned table's doc_id, numbers and digest, plus n_best (links whose count is the highest of their A id) and count_sum (over links)."""
    spark = table.sparkSession
    counts = document_counts(table, same)
    best = counts.groupBy("a").agg(F.max("n").alias("best"))
    counts = written(counts.join(best, "a").select("a", "b", "n", (F.col("n") == F.col("best")).alias("is_best")))
    vocabulary = spark.createDataFrame([(a, int(b)) for a, b in enumerate(same) if b >= 0], "a long, b long")
    # At most a row for each id of A's vocabulary.
    of_same = counts.join(F.broadcast(vocabulary), ["a", "b"], "left_semi").toArrow()
    vector, vector_best = np.zeros(len(same), np.int64), np.zeros(len(same), bool)
    a = of_same.column("a").to_numpy()
    vector[a], vector_best[a] = of_same.column("n").to_numpy(), of_same.column("is_best").to_numpy()
    irregular = counts.join(F.broadcast(vocabulary), ["a", "b"], "left_anti").select(F.expr("shiftleft(a, 32) | b").alias("pair"), "n", "is_best")
    small = irregular.limit(pairs + 1).count() <= pairs
    if small:
        given = irregular.orderBy("pair").toArrow()
        given = spark.sparkContext.broadcast([given.column(c).to_numpy() for c in ("pair", "n", "is_best")])
    numbers = ["doc_id", *_NUMBERS, "groups_sha256"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]

            def add(key: str, links: str, kind: type, find) -> None:
                sizes = np.array([len(x) // np.dtype(kind).itemsize for x in batch.column(key).to_pylist()], np.int64)
                if sizes.sum():
                    n, is_best = find(_flat(batch.column(key), kind))
                    links = _flat(batch.column(links), np.int64)
                    for total, values in zip(sums, (links * is_best, links * n), strict=True):
                        running = np.concatenate([[0], np.cumsum(values)])
                        ends = np.cumsum(sizes)
                        total += running[ends] - running[ends - sizes]

            def pair(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                stored, n, is_best = given.value
                at = np.searchsorted(stored, keys.view(np.int64))
                return n[at], is_best[at]

            add("same", "same_links", np.uint32, lambda ids: (vector[ids], vector_best[ids]))
            if small:
                add("pairs", "pair_links", np.uint64, pair)
            keep = [batch.column(c) for c in batch.schema.names if c in numbers or not small and c in ("pairs", "pair_links")]
            yield pa.record_batch([*keep, *map(pa.array, sums)], names=[*[c for c in batch.schema.names if c in numbers or not small and c in ("pairs", "pair_links")], "n_best", "count_sum"])

    left = "" if small else ", pairs binary, pair_links binary"
    found = table.select(*numbers, "same", "same_links", "pairs", "pair_links").mapInArrow(look_up, f"doc_id long, {', '.join(f'{c} long' for c in _NUMBERS)}, groups_sha256 string{left}, n_best long, count_sum long")
    return found if small else _joined(found, irregular)


def _joined(found: DataFrame, irregular: DataFrame) -> DataFrame:
    """The same by a join of the documents' irregular pairs with their counts."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(x) // 8 for x in batch.column("pairs").to_pylist()]
            columns = [np.repeat(batch.column("row").to_numpy(), sizes), _flat(batch.column("pairs"), np.int64), _flat(batch.column("pair_links"), np.int64)]
            yield pa.record_batch(list(map(pa.array, columns)), names=["row", "pair", "links"])

    found = written(found.withColumn("row", F.monotonically_increasing_id()))
    links = found.select("row", "pairs", "pair_links").mapInArrow(pairs, "row long, pair long, links long").join(irregular, "pair")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("links"))).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_count"))
    rows = found.join(sums, "row", "left")
    add = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return rows.select("doc_id", *_NUMBERS, "groups_sha256", add("n_best", "more_best"), add("count_sum", "more_count"))


def same_ids(a_path: str | None = None, b_path: str | None = None) -> np.ndarray:
    """For each A id the B id with the same bytes, -1 where there is none."""
    import public_tokenizers

    return Aligner(a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)).same


def op13_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = written(aligned(read(spark, sf_dir, "documents", "doc_id", "text")))
    return with_counts(table, same_ids()).select("doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256")
