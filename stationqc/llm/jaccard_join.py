"""Exact Jaccard join of shingle sets by group counts in R-trees.

A document's set holds its distinct SHINGLE-word shingles (A-Z in lower case). Two documents link when 100 * intersection >= LEAST * union.

1. Equal sets are one class, known by 96 bits of a digest; only classes are joined, copies follow their class.
2. The shingles of a class are hashed into groups, more groups than the symmetric difference of two linked sets can hold shingles (for its
   band of set sizes). So linked sets agree in all shingles of some group, and meet under that group's digest. This brings together what may
   link without any pair in sight; digests that only one class has go at once. There are so many groups that linked sets agree in several:
   a class that meets others under fewer digests than that has no link. As sets agree in all but a known number of groups, a prefix of each set's
   digests is enough. No digest stands for an empty group, so unrelated sets, short ones too, have no place in common.
3. A class is first compared with the class of the highest degree among those it meets, if their count vectors (4.) allow a link. This joins large groups of near copies to one
   another with one comparison each.
4. Where still different components meet, the classes' count vectors (shingles in COUNTS groups) are the points of an R-tree. An overlap is at
   most the sum of coordinate minima, of two points as of a point and a box; what can't reach the threshold, or is in the same
   component as a whole box, is not followed. Pairs that are left are compared exactly.
5. Components of all links found.

All links between components are found, so components are exact (up to collisions of 64-bit shingle hashes). A meeting place with more than
CHUNK classes is split, and each pair of parts is a task's share. Null texts and texts without words link with nothing. Repeated rows are
copies. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationqc.llm import tokens
from stationqc.llm.common import read, written
from stationqc.llm.graph import components

SHINGLE = 4
#: Percent of the union that linked sets share.
LEAST = 85
#: Coordinates of a count vector.
COUNTS = 256
#: Times that classes with too few common digests are taken out.
ROUNDS = 2
#: Bounds that are computed at a time.
AT_A_TIME = 8192
#: Classes of one meeting place in one task, and points or boxes in an R-tree's box.
CHUNK = 2000
FANOUT = 16
#: Ratio of the band edges of set sizes; above 100 / LEAST, so that a set meets larger ones in its own band or the next.
BAND = 1.6
#: Bits of the filter of candidate documents: FILTER_SHARE for each class that meets others, between these bounds (1 and 16 MB).
FILTER_SHARE = 16
FILTER_BITS = (1 << 23, 1 << 27)
#: Words and class digests that a worker remembers.
REMEMBERED = 250_000

_U = np.uint64
_ODD = tuple(_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Words(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = Words()


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a UTF-8 text; of all words as one shingle where they are fewer."""
    split = (text or b"").lower().split()
    if not split:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, split), np.uint64, len(split))
    n = max(1, len(h) - size + 1)
    x = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(size, len(h))):
        x = _mix(x + h[k : k + n] * _ODD[k % len(_ODD)])
    return np.unique(x)


def digest(s: np.ndarray) -> tuple[int, int]:
    found = xxhash.xxh3_128_intdigest(s.tobytes())
    return _signed(found >> 64), found & (1 << 32) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def band_edges(ratio: float = BAND) -> list[int]:
    """First set size of each band."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * ratio)))
    return edges


_EDGES = band_edges()


def group_digests(s: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Where the set meets others: of each band that it can have a larger or equal partner in, digests of filled groups.

    In a band whose sets have at most `top` shingles, two linked sets differ in `most` shingles at most, and this set differs from any linked one in `apart`
    at most. So of the groups that it fills, all but `apart` are the same in a linked set. Both give only the first of their digests by value: `apart` and
    `common` more. Among these are the first `common` of those that both have (all, if they are fewer).

    A set that fills no more than `apart` groups may share none of them. Such sets, few as they are, also give the first of their shingles by value: those
    that are left when as many as a linked set has to share, less one, are taken away. Two linked sets of this kind have one of these in common.

    Beside each digest: the band, times 65,536, and how many digests of the band a linked set has in common with this one at least.
    """
    n, found, needs = len(s), [], []
    apart = n * (100 - least) // least
    if not apart:  # only equal sets link
        return np.empty(0, np.int64), np.empty(0, np.int64)
    b = int(np.searchsorted(_EDGES, n, "right")) - 1
    while _EDGES[b] * least <= n * 100 or _EDGES[b] <= n:
        most = 2 * (_EDGES[b + 1] - 1) * (100 - least) // (100 + least)
        common = 1 + max(3, most // 8)
        groups = most + common
        group = ((s >> _U(32)) * _U(groups)) >> _U(32)
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        own, differ = group[starts], min(most, apart)
        given = np.sort(_mix(np.add.reduceat(_mix(s), starts) ^ _mix(own * _ODD[0] + _U(b))))[: differ + common]
        if len(own) <= differ:
            shingles = np.sort(_mix(s ^ _ODD[2]))[: n + 1 - -(-n * least // 100)]
            given = np.concatenate([given, _mix(shingles + (_ODD[3] + _U(b)))])
        found.append(given)
        needs.append(np.full(len(given), (b << 16) + min(max(1, min(common, len(own) - differ)), (1 << 16) - 1)))
        b += 1
    return np.concatenate(found).view(np.int64), np.concatenate(needs)


def counts(s: np.ndarray) -> bytes:
    """The count vector, shingles by the leading bits of a second hash: a byte per count if all fit, else four."""
    found = np.bincount((_mix(s ^ _ODD[1]) >> _U(64 - COUNTS.bit_length() + 1)).astype(np.int64), minlength=COUNTS)
    return found.astype("u1" if found.max() < 256 else "<u4").tobytes()


def points(vectors: list[bytes]) -> np.ndarray:
    """Count vectors as rows."""
    if all(len(v) == COUNTS for v in vectors):
        return np.frombuffer(b"".join(vectors), "u1").reshape(-1, COUNTS)
    return np.stack([np.frombuffer(v, "u1" if len(v) == COUNTS else "<u4").astype(np.uint32) for v in vectors])


_MEETINGS = pa.schema([("meet", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("need", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("counts", pa.binary()), ("text_hash", pa.int64())])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document (with doc_id, n and, for the first of its class in the task, counts), then a row per group of a new class."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for part in tokens.slices(batch, "text"):
            ids, sizes, c1, c2, vectors, meet, needs, m1, m2 = [], [], [], [], [], [], [], [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
                s = shingle_set(text)
                key = digest(s) if len(s) else (None, None)
                ids.append(doc_id), sizes.append(len(s)), c1.append(key[0]), c2.append(key[1])
                new = len(s) > 0 and key not in seen
                vectors.append(counts(s) if new else None)
                if new:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    digests, need = group_digests(s)
                    meet.append(digests), needs.append(need)
                    m1.append(np.full(len(meet[-1]), key[0])), m2.append(np.full(len(meet[-1]), key[1]))
            # A document's row is dealt by its id, so that copies don't meet in one place.
            rows = [pa.array(ids, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.nulls(len(ids), pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(vectors, pa.binary()), part.column("text_hash")]
            yield pa.record_batch(rows, schema=_MEETINGS)
            if meet:
                flat = [pa.array(np.concatenate(x), pa.int64()) for x in (meet, m1, m2, needs)]
                none = pa.nulls(len(flat[0]), pa.int64())
                yield pa.record_batch([*flat, none, none, pa.nulls(len(flat[0]), pa.binary()), none], schema=_MEETINGS)


def _sets(bitmap: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class and set of the documents that the filter lets through."""
    bits = np.frombuffer(bitmap, np.uint8)
    for batch in batches:
        ids = batch.column("slot").to_numpy(zero_copy_only=False)
        batch = batch.filter(pa.array((bits[ids >> 3] >> (ids & 7) & 1).astype(bool)))
        for part in tokens.slices(batch, "text") if batch.num_rows else ():
            found = [shingle_set(text) for text in part.column("text").cast(pa.large_binary()).to_pylist()]
            found = [s for s in found if len(s)]
            keys = [digest(s) for s in found]
            yield pa.record_batch(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                names=["c1", "c2", "items"],
            )


class RTree:
    """Points (count vectors with set sizes and components) in boxes of FANOUT, level by level; a box knows its largest counts and least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, parts: np.ndarray):
        # Alike sets have alike sizes and alike counts: neighbours in this order share a box.
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        one, other = parts[self.order], parts[self.order]
        self.levels = [(top, low, high, one, other)]
        while len(top) > FANOUT:
            starts = np.arange(0, len(top), FANOUT)
            top = np.maximum.reduceat(top, starts)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            one, other = np.minimum.reduceat(one, starts), np.maximum.reduceat(other, starts)
            self.levels.append((top, low, high, one, other))

    def near(self, points: np.ndarray, sizes: np.ndarray, parts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query, point) of different parts whose bound on the overlap reaches the threshold, and the bound's share of both sizes."""
        found: list[tuple[np.ndarray, ...]] = []
        width = len(self.levels[-1][0])
        per = max(1, 65_536 // (FANOUT * width))
        for at in range(0, len(points), per):
            q = np.repeat(np.arange(at, min(at + per, len(points))), width)
            node = np.tile(np.arange(width), len(q) // width)
            for depth in reversed(range(len(self.levels))):
                top, low, high, one, other = self.levels[depth]
                # The least size that a linked point in the box can have.
                size = np.maximum(low[node], -(-sizes[q] * least // 100))
                live = (size <= high[node]) & (size * least <= sizes[q] * 100) & ~((one[node] == other[node]) & (one[node] == parts[q]))
                q, node, size = q[live], node[live], size[live]
                bound = np.empty(len(q), np.int64)
                for k in range(0, len(q), AT_A_TIME):
                    bound[k : k + AT_A_TIME] = np.minimum(points[q[k : k + AT_A_TIME]], top[node[k : k + AT_A_TIME]]).sum(axis=1, dtype=np.int64)
                live = bound * (100 + least) >= least * (sizes[q] + size)
                q, node, score = q[live], node[live], bound[live] / (sizes[q] + size)[live]
                if depth:
                    below = len(self.levels[depth - 1][0])
                    q, node = np.repeat(q, FANOUT), (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    q, node = q[node < below], node[node < below]
            found.append((q, self.order[node], score))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _near_in_place(rows: tuple[np.ndarray, ...], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes that may link in one meeting place (or pair of parts of it), and their scores: its left rows against all its rows."""
    node, size, part, vector, left = rows
    q = np.flatnonzero(left)
    if len(node) < 2 or not len(q) or part.min() == part.max():
        return np.empty((0, 2), np.int64), np.empty(0)
    a, b, score = RTree(vector, size, part).near(vector[q], size[q], part[q], least)
    pairs = np.stack([node[q][a], node[b]], axis=1)
    pairs.sort(axis=1)
    return pairs, score


def _near(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by meeting place: a place at a time."""
    kept: list[pa.RecordBatch] = []

    def places(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        key = np.stack([rows.column(c).to_numpy() for c in ("meet", "i", "j")], axis=1)
        columns = [rows.column(c).to_numpy() for c in ("node", "n", "part")]
        vectors = rows.column("counts").to_pylist()
        left = rows.column("left").to_numpy(zero_copy_only=False).astype(bool)
        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
        for a, b in zip(starts, [*starts[1:], len(key)], strict=True):
            yield _near_in_place((columns[0][a:b], columns[1][a:b], columns[2][a:b], points(vectors[a:b]), left[a:b]), least)

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        every = [(np.empty((0, 2), np.int64), np.empty(0)), *places(rows)]
        found, first = np.unique(np.concatenate([x for x, _ in every]), axis=0, return_index=True)
        score = np.concatenate([x for _, x in every])[first]
        return pa.record_batch([pa.array(found[:, 0], pa.int64()), pa.array(found[:, 1], pa.int64()), pa.array(score)], names=["a", "b", "score"])

    for batch in batches:
        if not batch.num_rows:
            continue
        # The last place of a batch may go on in the next one.
        key = np.stack([batch.column(c).to_numpy() for c in ("meet", "i", "j")], axis=1)
        last = int(np.flatnonzero((key != key[-1]).any(axis=1)).max(initial=-1)) + 1
        if last or kept and _key(kept[-1]) != tuple(key[0]):
            yield pairs(pa.Table.from_batches([*kept, batch.slice(0, last)]))
            kept = []
        kept.append(batch.slice(last))
    if kept:
        yield pairs(pa.Table.from_batches(kept))


def _reachable(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of given pairs those whose count vectors let them reach the threshold."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_A_TIME):
            some = batch.slice(at, AT_A_TIME)
            one, other = (points(some.column(c).to_pylist()) for c in ("one", "other"))
            sizes = some.column("sizes").to_numpy(zero_copy_only=False)
            bound = np.minimum(one, other).sum(axis=1, dtype=np.int64)
            yield some.select(["a", "b"]).filter(pa.array(bound * (100 + least) >= least * sizes))


def _key(batch: pa.RecordBatch) -> tuple[int, ...]:
    return tuple(batch.column(c)[0].as_py() for c in ("meet", "i", "j"))


def _linked(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets link."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("one")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("other")), "b")
    shared = F.size(F.array_intersect("one", "other"))
    return both.filter(shared * (100 + least) >= least * (F.size("one") + F.size("other"))).select("a", "b")


def filter_bits(classes: int) -> int:
    """A power of two."""
    return min(max(1 << (FILTER_SHARE * classes).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])


def clustered(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id of docs (doc_id, text)."""
    return labelled(docs, least).select("doc_id", "n_shingles", "component_id")


def labelled(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, text_hash (xxhash64), n_shingles, component_id and component of docs (doc_id, text).

    A component_id is a document's, so rows that share a doc_id may give it to several components; component tells these apart. It is null without words.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    rows = docs.mapInArrow(_describe, "meet long, c1 long, c2 long, need long, doc_id long, n long, counts binary, text_hash long")
    place = Window.partitionBy("meet")
    # Documents' rows stay; of the others those where two classes meet. The one large shuffle.
    met = [(F.min(F.when(F.col("n").isNull(), F.col(c))).over(place) != F.max(F.when(F.col("n").isNull(), F.col(c))).over(place)) for c in ("c1", "c2")]
    rows = rows.withColumn("_met", F.coalesce(met[0] | met[1], F.lit(False))).filter("n is not null or _met").drop("_met")
    rows = written(rows)
    members = rows.filter("n is not null").select("doc_id", "n", "c1", "c2", "counts", "text_hash")
    classes = members.filter("c1 is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("first_doc"), F.max("n").alias("n"))
    meetings = rows.filter("n is null").select("meet", "c1", "c2", "need").distinct()
    for _ in range(ROUNDS):  # a class that goes may leave others with too few
        strong = meetings.groupBy("c1", "c2", "need").agg(F.count("*").alias("has")).filter("has >= need % 65536").drop("has")
        meetings = meetings.join(strong, ["c1", "c2", "need"], "left_semi").withColumn("_here", F.count("*").over(place))
        meetings = written(meetings.filter("_here > 1").select("meet", "c1", "c2", "need"))
    meetings = meetings.select("meet", "c1", "c2").distinct()

    # Candidate classes get small numbers of their own, stable as they are written.
    degrees = meetings.groupBy("c1", "c2").agg(F.count("*").alias("degree"))
    nodes = written(degrees.join(classes, ["c1", "c2"]).withColumn("node", F.monotonically_increasing_id()))
    at = written(meetings.join(nodes.select("c1", "c2", "node", "degree"), ["c1", "c2"]).select("meet", "node", "degree"))

    bits = filter_bits(nodes.count())
    slots = nodes.select((F.xxhash64("first_doc").bitwiseAND(F.lit(bits - 1))).alias("slot"))
    words = slots.groupBy(F.expr("cast(slot div 32 as int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 as int)))").alias("bits"))
    found = words.toArrow()  # bits / 32 rows at most
    bitmap = np.zeros(bits // 32, "<u4")
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    slotted = docs.withColumn("slot", F.xxhash64("doc_id").bitwiseAND(F.lit(bits - 1)))
    sets = slotted.mapInArrow(partial(_sets, bitmap.tobytes()), "c1 long, c2 long, items array<long>")
    sets = written(sets.join(nodes.select("c1", "c2", "node"), ["c1", "c2"]).select("node", "items"))

    # Each class against the best-connected one that it meets.
    best = F.max(F.struct("degree", -F.col("node")))
    leaders = at.groupBy("meet").agg(best.alias("best"))
    leaders = at.join(leaders, "meet").groupBy(F.col("node").alias("a")).agg(F.max("best").alias("best")).select("a", (-F.col("best.col2")).alias("b")).filter("a <> b")
    vectors = members.filter("counts is not null").join(nodes.select("c1", "c2", "node"), ["c1", "c2"]).groupBy("node").agg(F.first("counts").alias("counts"), F.first("n").alias("n"))
    vectors = written(vectors)
    both = leaders.join(vectors.select(F.col("node").alias("a"), F.col("counts").alias("one"), F.col("n").alias("n1")), "a")
    both = both.join(vectors.select(F.col("node").alias("b"), F.col("counts").alias("other"), F.col("n").alias("n2")), "b")
    reachable = both.select("a", "b", "one", "other", (F.col("n1") + F.col("n2")).alias("sizes")).mapInArrow(partial(_reachable, least), "a long, b long")
    links = written(_linked(written(reachable), sets, least))

    # Between components that still meet.
    parts = components(links)
    parted = at.join(parts, "node", "left").select("meet", "node", F.coalesce("component", "node").alias("part"))
    among = Window.partitionBy("meet")
    ranked = parted.withColumns({"_low": F.min("part").over(among), "_high": F.max("part").over(among), "_all": F.count("*").over(among), "_rank": F.row_number().over(among.orderBy("node"))})
    mixed = ranked.filter("_low <> _high").withColumns({"chunk": F.expr(f"cast((_rank - 1) div {CHUNK} as int)"), "chunks": F.expr(f"cast((_all - 1) div {CHUNK} as int)")})
    mixed = mixed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks"))))
    mixed = mixed.select("meet", "node", "part", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), F.expr("chunk <= other").alias("left"))
    placed = mixed.join(vectors, "node").repartition("meet", "i", "j").sortWithinPartitions("meet", "i", "j")
    near = placed.select("meet", "i", "j", "node", "n", "part", "counts", "left").mapInArrow(partial(_near, least), "a long, b long, score double")
    near = written(near.groupBy("a", "b").agg(F.max("score").alias("score")))

    # The best pair of each component first: it mostly joins two, and then the other pairs between them need no comparison.
    ends = _between(near, parts)
    best = F.max(F.struct("score", "a", "b")).alias("best")
    first = written(ends.select(F.explode(F.array("part_a", "part_b")).alias("part"), "score", "a", "b").groupBy("part").agg(best).select("best.a", "best.b").distinct())
    links = written(links.union(_linked(first, sets, least)))
    parts = components(links)
    rest = _between(near, parts).select("a", "b").join(first, ["a", "b"], "left_anti")
    more = written(_linked(rest, sets, least))
    parts = components(links.union(more)) if not more.isEmpty() else parts
    whole = _labelled(nodes, parts)
    final = classes.join(whole, ["c1", "c2"], "left").select("c1", "c2", F.coalesce("component_id", "first_doc").alias("component_id"), F.coalesce("class", F.struct("c1", "c2")).alias("component"))
    out = members.join(final, ["c1", "c2"], "left")
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "component")


def _between(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b, score) of different components, with these as part_a and part_b."""
    of = lambda side: parts.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    both = both.select("a", "b", "score", F.coalesce("_a", "a").alias("part_a"), F.coalesce("_b", "b").alias("part_b"))
    return both.filter("part_a <> part_b")


def _labelled(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """(c1, c2, component_id, class) of the classes that have links: the least document and the least class of their component."""
    own = nodes.join(parts, "node")
    least = own.groupBy("component").agg(F.min("first_doc").alias("component_id"), F.min(F.struct("c1", "c2")).alias("class"))
    return own.join(least, "component").select("c1", "c2", "component_id", "class")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(read(spark, sf_dir, "documents", "doc_id", "text"))
