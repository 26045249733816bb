"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget in proportion to its weight, at most `max_epochs` times its size; what lies above a cap is
shared again by weight among the others until no target is above its cap. With the sources sorted by cap / weight, those at
their cap are a prefix, so the water level follows from running sums and needs no loop.

A target of e epochs takes every document floor(e) times, and once more the documents that come first in a seeded order, until
the target is met; the one document at the mark is taken in part, so that a source's words equal its rounded target.
The order is split into BUCKETS ranges of a hash: whole ranges below or above the mark are decided by their sums, and only the
one range at the mark is sorted. A hot source is thus never sorted or moved as a whole.

Null texts have size 0 and are taken 0 words. A null source is a source of its own, the last. Rows that repeat are rows of
their own; between equal rows it does not matter which one the mark cuts. An empty table gives an empty result. The table of
sources has a row per source: it is sorted in one task, documents are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationqc.llm.common import let, read, words, written

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = 17
#: Hash ranges of the seeded order, per source: three hexadecimal digits.
BUCKET_DIGITS = 3


def seeded_key(doc_id: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source of `sizes` (source, source_size): weight, target (double) and target_words (long)."""
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    capped = ranked.select(
        "source",
        "source_size",
        weight.alias("weight"),
        (F.col("source_size") * max_epochs).alias("_cap"),
        (F.col("source_size") * max_epochs / weight).alias("_ratio"),
        "_rank",
    )
    order = Window.orderBy("_ratio", "_rank")
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = capped.withColumn("_level", (total * budget - before) / open_weight)
    # The first source that the level does not lift above its cap has the final level.
    fits = F.when(F.col("_ratio") >= F.col("_level"), F.struct(F.col("_ratio"), F.col("_rank"), F.col("_level")))
    final = F.min(fits).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))["_level"]
    cap = F.col("_cap").cast("double")
    target = F.when(final.isNull(), cap).otherwise(F.least(cap, final * F.col("weight")))
    return level.select("source", "source_size", "weight", target.alias("target"), F.floor(target + 0.5).cast("long").alias("target_words"))


def with_taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Adds source_size, target, taken, whole (full repetitions) and extra (words of a further one) to docs (doc_id, source, size, ...)."""
    keyed = docs.withColumn("_key", seeded_key(F.col("doc_id"), seed)).withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy("source", "_bucket").agg(F.sum("size").cast("long").alias("_in_bucket"))
    sums = written(sums)  # at most 16 ** BUCKET_DIGITS rows a source; used twice
    targets = source_targets(sums.groupBy("source").agg(F.sum("_in_bucket").alias("source_size")), weights, budget, max_epochs)
    targets = targets.withColumns(
        {
            "_whole": F.when(F.col("source_size") > 0, F.expr("target_words div source_size")).otherwise(F.lit(0)),
            "_rest": F.when(F.col("source_size") > 0, F.expr("target_words % source_size")).otherwise(F.lit(0)),
        }
    )
    running = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_in_bucket").over(running), F.lit(0)))
    marks = starts.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
    # One row per source: the bucket that holds the mark, and the words to take from it.
    at = (F.col("_start") <= F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_in_bucket"))
    marks = marks.groupBy(F.col("t.source").alias("_source"), "t.source_size", "target", "_whole").agg(
        F.max(F.when(at, F.col("_bucket"))).alias("_mark"), F.max(F.when(at, F.col("_rest") - F.col("_start"))).alias("_left")
    )
    rows = keyed.join(written(marks), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    clear = rows.filter(F.coalesce(F.col("_bucket") != F.col("_mark"), F.lit(True)))
    clear = clear.withColumn("extra", F.when(F.col("_bucket") < F.col("_mark"), F.col("size")).otherwise(F.lit(0)).cast("long"))
    order = Window.partitionBy("source").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    cut = rows.filter(F.col("_bucket") == F.col("_mark"))
    cut = cut.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left") - before)).cast("long"))
    both = clear.unionByName(cut)
    taken = (F.col("_whole") * F.col("size") + F.col("extra")).cast("long")
    return both.withColumns({"taken": taken, "whole": F.col("_whole").cast("int")}).drop("_key", "_bucket", "_mark", "_left", "_whole")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each document `whole` times, and once more in full or, at the mark, its first `extra` words joined by one space.

    Same columns as docs; n_chars follows the text where the table has it.
    """
    given = docs.columns
    size = F.size(words(F.col("text"))).cast("long").alias("size")
    # The rows' own columns travel in one, whatever their names.
    taken = with_taken(docs.select("doc_id", "source", size, F.struct(*given).alias("_doc")), **settings).filter("taken > 0")
    copies = F.col("whole") + (F.col("extra") > 0).cast("int")
    each = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    partial = (F.col("_copy") > F.col("whole")) & (F.col("extra") < F.col("size"))
    cut = let(F.struct(words(F.col("_doc.text")).alias("w"), F.col("extra").cast("int").alias("n")), lambda x: F.array_join(F.slice(x["w"], F.lit(1), x["n"]), " "))
    out = each.select("_doc", partial.alias("_partial"), F.when(partial, cut).otherwise(F.col("_doc.text")).alias("_text"))
    changed = {"text": F.col("_text")}
    if "n_chars" in given:
        counted = F.length("_text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("_partial"), counted).otherwise(F.col("_doc.n_chars"))
    return out.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in given])


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = written(docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size")))
    return with_taken(sized).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM ranked),
leveled AS (
  SELECT *, 2 * source_size AS cap, 2 * source_size / w AS ratio,
    ((SELECT sum(source_size) FROM weighted) * 1.5::DOUBLE
      - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 2 * source_size / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
final AS (SELECT arg_min(level, ratio * 1e6 + r) AS level FROM leveled WHERE ratio >= level),
targets AS (
  SELECT l.source, l.source_size, least(CAST(cap AS DOUBLE), coalesce(f.level * w, cap)) AS target FROM leveled l, final f),
running AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS words,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0
    ELSE (words // source_size) * size + greatest(0, least(size, words % source_size - before)) END AS BIGINT) AS taken
FROM running
"""
