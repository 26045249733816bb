"""Document fingerprints by one-permutation MinHash with optimal densification and packed low-order bits.

The shingles of a text (SHINGLE words; a shorter text is one shingle) are hashed once. The top bits of a hash choose its bin, and each
bin keeps its least hash. An empty bin j borrows from the first filled bin of its own random walk a_j + t * b_j (b_j odd, so a
walk meets every bin once); equal walks in all documents make borrowed values comparable. The first filled bin of a walk has the least rank
(p - a_j) / b_j mod BINS: PROBES steps are walked, and for what is still empty the ranks are compared. Of every bin the lowest BITS bits are kept; two bins then agree by chance with
probability 2 ** -BITS, which `likeness` corrects for.

Everything is built-in expressions on arrays within the row; memory is bounded by the longest text. Null texts count as empty. A text
without words has an empty fingerprint, which is like another empty one (1.0) and unlike all others (0.0).
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationqc.llm.common import let, read, words

SHINGLE = 5
#: Bins and kept bits: powers of two; a bin index takes BIN_BITS bits.
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
PROBES = 8
SEED = 11
#: Documents in a range of ids, on average: the next document is found within ranges, and between ranges by their first rows.
RANGE = 512
RANGES_IN_BLOCK = 1024
#: A stretch of ids is cut into SPLIT where one of its ranges has more than HEAVY times RANGE rows, until there are STRETCHES: they are kept by the driver.
HEAVY = 8
SPLIT = 16
STRETCHES = 2048

_FREE = 64 - BIN_BITS
_EMPTY = (1 << _FREE) - 1
_random = random.Random(SEED)
_START = [_random.randrange(BINS) for _ in range(BINS)]
_STEP = [_random.randrange(BINS) | 1 for _ in range(BINS)]
#: rank of bin p on the walk of bin j: (p * inverse step - offset) mod BINS.
_INVERSE = [pow(step, -1, BINS) for step in _STEP]
_OFFSET = [start * inverse % BINS for start, inverse in zip(_START, _INVERSE, strict=True)]
_WALK = [[(start + t * step) % BINS for start, step in zip(_START, _STEP, strict=True)] for t in range(PROBES)]


def _constants(values: list[int]) -> Column:
    return F.array(*map(F.lit, values))


def shingle_hashes(w: Column, size: int = SHINGLE) -> Column:
    """64-bit hashes of the shingles of an array of words; one of all words where they are fewer; none of no words."""
    n = F.size(w)
    shifted = [F.slice(w, F.lit(k + 1), F.greatest(n - k, F.lit(0))) for k in range(size)]
    windows = F.transform(F.slice(F.arrays_zip(*shifted), F.lit(1), F.greatest(n - size + 1, F.lit(0))), lambda x: F.xxhash64(x))
    return F.when(n >= size, windows).when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))


def signature(hashes: Column) -> Column:
    """The kept bits of each bin less 128, as an array of BINS bytes; empty where there are no hashes."""
    top = lambda x: F.shiftright(x, _FREE)
    # One marker per bin, above all its hashes: after sorting, the first value of each bin is its minimum or the marker.
    markers = _constants([(b << _FREE) + _EMPTY for b in range(-BINS // 2, BINS // 2)])
    ordered = F.sort_array(F.concat(hashes, markers))
    minima = let(ordered, lambda s: F.filter(s, lambda x, i: (i == 0) | (top(x) != F.coalesce(top(F.get(s, i - 1)), F.lit(0)))))
    empty = lambda x: x.bitwiseAND(F.lit(_EMPTY)) == F.lit(_EMPTY)
    low = lambda x: x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def values(m: Column) -> Column:
        """Of every bin its kept bits, null where it is empty."""
        return F.transform(m, lambda x: F.when(~empty(x), low(x)))

    def filled(v: Column) -> Column:
        """Of every filled bin: its index and value in one number."""
        return F.filter(F.transform(v, lambda x, p: p * (1 << BITS) + x), lambda x: x.isNotNull())

    def densified(v: Column, f: Column) -> Column:
        def borrowed(j: Column) -> Column:
            walk = F.struct(F.get(_constants(_INVERSE), j).alias("inverse"), F.get(_constants(_OFFSET), j).alias("offset"))
            rank = lambda e, k: (F.shiftright(e, BITS) * k["inverse"] - k["offset"]).bitwiseAND(F.lit(BINS - 1))
            least = let(walk, lambda k: F.array_min(F.transform(f, lambda e: rank(e, k) * (1 << BITS) + e.bitwiseAND(F.lit((1 << BITS) - 1)))))
            return least.bitwiseAND(F.lit((1 << BITS) - 1))

        probed = lambda j: [F.get(v, F.get(_constants(steps), j)) for steps in _WALK]
        return F.transform(v, lambda x, j: (F.coalesce(x, *probed(j), borrowed(j)) - 128).cast("tinyint"))

    dense = let(let(minima, values), lambda v: let(filled(v), lambda f: densified(v, f)))
    return F.when(F.size(hashes) > 0, dense).otherwise(F.array().cast("array<tinyint>"))


def text_signature(text: Column) -> Column:
    return let(words(text), lambda w: let(shingle_hashes(w), signature))


def packed(sig: Column) -> Column:
    """A signature as text: two hexadecimal digits per bin."""
    digits = F.transform(sig, lambda v: F.substring(F.hex(v.cast("int") + (128 + 256)), 2, 2))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two signatures, freed of chance agreement, 0 to 1."""
    agree = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(BINS))
    chance = 2.0**-BITS
    some = F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(some)


def _placed(stretches: list[tuple[int, int, int]]) -> tuple[Column, Column]:
    """Number of the stretch (least id, greatest id, rows) that an id is in, and of its range: ranges of one stretch are equally wide. Null ids have range -1."""
    doc = F.col("doc_id")
    table, base = [], 0
    for low, high, rows in stretches:
        ranges = max(1, rows // RANGE)
        table.append(F.struct(F.lit(low).cast("long").alias("low"), F.lit((high - low + 1) / ranges).alias("width"), F.lit(ranges - 1).cast("long").alias("last"), F.lit(base).cast("long").alias("base")))
        base += ranges
    lows = F.array(*[F.lit(low).cast("long") for low, _, _ in stretches])
    stretch = F.lit(0) if len(stretches) == 1 else F.greatest(F.size(F.filter(lows, lambda low: low <= doc)) - 1, F.lit(0))

    def within(x: Column) -> Column:
        # The exact difference, but for stretches of more than half of all ids.
        ahead = F.coalesce(F.try_subtract(doc, x["low"]).cast("double"), doc.cast("double") - x["low"].cast("double"))
        return x["base"] + F.least(F.greatest(F.floor(ahead / x["width"]), F.lit(0)), x["last"])

    return stretch, F.coalesce(F.when(doc.isNotNull(), let(F.get(F.array(*table), stretch), within)), F.lit(-1)).cast("long")


def _stretches(docs: DataFrame) -> list[tuple[int, int, int]]:
    """Stretches of ids whose equally wide ranges have a bounded number of rows each, in order: a histogram that is refined where ids are dense."""
    ids = docs.select(F.col("doc_id").cast("long")).filter("doc_id is not null")
    low, high, rows = ids.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    stretches = [(low or 0, high or 0, rows)]
    while True:
        stretch, place = _placed(stretches)
        ranges = ids.groupBy(stretch.alias("stretch"), place.alias("range")).agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        # Rows of one id can't be parted.
        heavy = {r[0] for r in ranges.filter((F.col("n") > HEAVY * RANGE) & (F.col("low") < F.col("high"))).select("stretch").distinct().collect()}
        if not heavy or len(stretches) + len(heavy) * SPLIT > STRETCHES:
            return stretches
        cut = []
        for k, (low, high, _) in enumerate(stretches):
            lows = {low + (high - low + 1) * i // SPLIT for i in range(SPLIT)} if k in heavy else {low}
            cut += [(x, x, 0) for x in sorted(lows)]
        stretch, _ = _placed(cut)
        found = ids.groupBy(stretch.alias("stretch")).agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).sort("stretch")
        stretches = [tuple(r)[1:] for r in found.collect()]  # STRETCHES rows at most


def with_next(docs: DataFrame) -> DataFrame:
    """Adds next_text and next_sig, those of the following row by (doc_id, text), the first for the last, to (doc_id, text, sig).

    Rows are dealt by ranges of ids, so that the texts are moved once; ranges are narrow where ids are dense. The first row of each range is also put at the end of the
    range before it.
    """
    _, bucket = _placed(_stretches(docs))
    rows = docs.withColumn("_bucket", bucket)
    firsts = rows.groupBy("_bucket").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    block = F.floor(F.col("_bucket") / RANGES_IN_BLOCK)
    firsts = firsts.withColumn("_block", block)
    within = firsts.withColumn("_to", F.lag("_bucket").over(Window.partitionBy("_block").orderBy("_bucket")))
    # A row per block, that is per RANGE * RANGES_IN_BLOCK documents.
    blocks = firsts.groupBy("_block").agg(F.max("_bucket").alias("_last"))
    around = Window.orderBy("_block")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("_block", F.coalesce(F.lag("_last").over(around), F.last("_last").over(whole)).alias("_before"))
    ghosts = within.join(blocks, "_block").select(F.coalesce("_to", "_before").alias("_bucket"), "first.*")
    ghosts = ghosts.select("doc_id", "text", text_signature(F.col("text")).alias("sig"), "_bucket", F.lit(True).alias("_ghost"))
    both = rows.select("doc_id", "text", "sig", "_bucket", F.lit(False).alias("_ghost")).unionByName(ghosts)
    order = Window.partitionBy("_bucket").orderBy("_ghost", "doc_id", "text")
    both = both.withColumns({"next_text": F.lead("text").over(order), "next_sig": F.lead("sig").over(order)})
    return both.filter("not _ghost").drop("_ghost", "_bucket")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    rows = with_next(docs.withColumn("sig", text_signature(F.col("text"))))
    kept = F.expr("substring(text, 1, length(text) - length(text) div 4)")
    edited = F.concat(kept, F.expr("substring(next_text, 1, cast(length(text) div 4 as int))"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sig", "next_sig", edited.alias("edited"))
    rows = rows.withColumn("edited_sig", text_signature(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("sig")).alias("fingerprint"),
        packed(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
