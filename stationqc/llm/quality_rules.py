"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

A sketch is a log-linear histogram: a value's bucket keeps its leading BITS bits, so a quantile read from it is off by
less than 1 part in 2 ** (BITS - 1). Sketches are rows (group, metric, bucket, count): they are built with map-side combine, merge by
adding counts, and are the same however the input was split. A group with fewer than MIN_GROUP documents uses the merged
sketch of its language, a small language the sketch of all documents.

A metric's fences lie `reach` interquartile ranges outside the quartiles, but at least `slack` away from them, so that a metric
that is nearly constant in a group does not reject what hardly differs. All values are fixed-point integers.

Only documents that pass the base rules feed the sketches. Null texts have no words and fail the base; null languages and
sources are groups of their own; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationqc.llm.common import WORD, let, read, words, written

BITS = 6
MIN_GROUP = 200
WINDOW = 5
#: Per metric: its value in parts of a million, interquartile ranges to the fences, least distance of a fence from its quartile.
METRICS = {
    "word_length": ("word_chars * 1000000 div n_words", 6, 2_000_000),
    "symbols_per_word": ("n_symbols * 1000000 div n_words", 3, 100_000),
    "dup_line_share": ("n_dup_lines * 1000000 div n_lines", 3, 340_000),
    "repeat_share": ("n_repeat_words * 1000000 div n_words", 3, 200_000),
}


def _repeated_words(w: Column) -> Column:
    """Words that lie in a WINDOW-word window found twice or more.

    Distinct window hashes settle the common case: as many as windows means no repeat. Otherwise windows are sorted by
    their own text, so a hash collision costs time and not the count.
    """
    n = F.size(w) - WINDOW + 1
    at = [lambda i, k=k: w[i + k] for k in range(WINDOW)]
    hashes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[f(i) for f in at]))
    ordered = F.sort_array(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.concat_ws(" ", *[f(i) for f in at]).alias("s"), i.alias("i"))))

    def hits(o: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(o, a)["s"] == F.get(o, b)["s"], F.lit(False))
        found = F.filter(F.transform(o, lambda x, j: F.when(same(j, j - 1) | same(j, j + 1), x["i"])), lambda x: x.isNotNull())
        return F.sort_array(found)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    exact = let(ordered, lambda o: let(hits(o), covered))
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n < 2, F.lit(0).cast("long")).otherwise(F.when(repeats, exact).otherwise(F.lit(0).cast("long")))


def base_features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of the base rules for docs (doc_id, lang, source, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    counts = let(
        words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated_words(w).alias("n_repeat_words"),
        ),
    )
    per_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))
    out = docs.select("doc_id", "lang", "source", counts.alias("c"), per_line.alias("l"), symbols.cast("long").alias("n_symbols"))
    out = out.select("doc_id", "lang", "source", "c.*", "n_symbols", "l.*")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return out.withColumn("base_failed", failed)


def sketches(features: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, width, n): each metric's histogram of the documents that pass the base."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.expr(value).alias("v")) for m, (value, _, _) in METRICS.items()])
    each = features.filter("not base_failed").select("lang", "source", F.inline(pairs))
    shift = f"greatest(length(bin(v)) - {BITS}, 0)"
    return each.groupBy("lang", "source", "metric", F.expr(f"shiftleft(shiftright(v, {shift}), {shift})").alias("bucket"), F.expr(f"shiftleft(1L, {shift})").alias("width")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, low_<metric>, high_<metric>) from sketches that are merged until a group is large enough."""
    levels = []
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        merged = sketch.groupBy(*keys, "metric", "bucket", "width").agg(F.sum("n").alias("n"))
        # At most 64 * 2 ** BITS buckets in a group and metric.
        group = Window.partitionBy(*keys, "metric")
        running = F.sum("n").over(group.orderBy("bucket"))
        total = F.sum("n").over(group)
        merged = merged.withColumns({"below": running, "total": total})
        quartiles = merged.groupBy(*keys, "metric", "total").agg(
            F.min(F.when(F.col("below") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
            F.min(F.when(F.col("below") * 4 >= F.col("total") * 3, F.col("bucket") + F.col("width") - 1)).alias("q3"),
        )
        levels.append((level, keys, quartiles))
    metric_rows = levels[0][2].select("lang", "source", "metric", F.col("total").alias("t0"), F.col("q1").alias("q1_0"), F.col("q3").alias("q3_0"))
    by_lang = levels[1][2].select(F.col("lang").alias("_lang"), F.col("metric").alias("_m1"), F.col("total").alias("t1"), F.col("q1").alias("q1_1"), F.col("q3").alias("q3_1"))
    overall = levels[2][2].select(F.col("metric").alias("_m2"), F.col("q1").alias("q1_2"), F.col("q3").alias("q3_2"))
    rows = metric_rows.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("metric") == F.col("_m1"))).join(overall, F.col("metric") == F.col("_m2"))
    pick = lambda q: F.when(F.col("t0") >= MIN_GROUP, F.col(f"{q}_0")).when(F.col("t1") >= MIN_GROUP, F.col(f"{q}_1")).otherwise(F.col(f"{q}_2"))
    rows = rows.select("lang", "source", "metric", pick("q1").alias("q1"), pick("q3").alias("q3"))
    reach = F.create_map(*[F.lit(x) for m, (_, k, _) in METRICS.items() for x in (m, k)])[F.col("metric")]
    slack = F.create_map(*[F.lit(x) for m, (_, _, s) in METRICS.items() for x in (m, s)])[F.col("metric")]
    away = F.greatest((F.col("q3") - F.col("q1")) * reach, slack)
    rows = rows.select("lang", "source", "metric", (F.col("q1") - away).alias("low"), (F.col("q3") + away).alias("high"))
    per = [F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{side}_{m}") for m in METRICS for side in ("low", "high")]
    return rows.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(*per)


def judged(features: DataFrame) -> DataFrame:
    """Features plus `kept`: passes the base and lies inside every fence of its group."""
    limits = fences(sketches(features))
    rows = features.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    inside = F.lit(True)
    for m, (value, _, _) in METRICS.items():
        inside = inside & F.expr(value).between(F.col(f"low_{m}"), F.col(f"high_{m}"))
    return rows.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(inside, F.lit(False))))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    features = written(base_features(docs))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged(features).select(*columns)


def _oracle() -> str:
    values = ", ".join(f"('{m}', {k}, {s})" for m, (_, k, s) in METRICS.items())
    unpivot = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS metric, CAST(({v.replace(' div ', ' // ')}) AS BIGINT) AS v FROM ok" for m, (v, _, _) in METRICS.items())
    return rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, row_number() OVER () AS rid FROM documents),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
win AS (
  SELECT rid, i, w[i:i+4] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cover AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.n_lines, 0) AS n_lines, CAST(coalesce(l.n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN lines l USING (rid) LEFT JOIN cover c USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
ok AS (SELECT * FROM b WHERE NOT base_failed),
vals AS ({unpivot.replace("doc_id, lang", "rid, lang")}),
bucketed AS (
  SELECT *, greatest(length(bin(v)) - {BITS}, 0) AS s FROM vals),
hist AS (SELECT lang, source, metric, (v >> s) << s AS lo, ((v >> s) << s) + (1::BIGINT << s) - 1 AS hi, count(*) AS n FROM bucketed GROUP BY ALL),
levels AS (
  SELECT 0 AS level, lang, source, metric, lo, hi, n FROM hist
  UNION ALL SELECT 1, lang, NULL, metric, lo, hi, sum(n) FROM hist GROUP BY lang, metric, lo, hi
  UNION ALL SELECT 2, NULL, NULL, metric, lo, hi, sum(n) FROM hist GROUP BY metric, lo, hi),
q AS (
  SELECT level, lang, source, metric, total, min(lo) FILTER (below * 4 >= total) AS q1, min(hi) FILTER (below * 4 >= total * 3) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, metric ORDER BY lo) AS below, sum(n) OVER (PARTITION BY level, lang, source, metric) AS total FROM levels)
  GROUP BY ALL),
chosen AS (
  SELECT a.lang, a.source, a.metric,
    CASE WHEN a.total >= {MIN_GROUP} THEN a.q1 WHEN l.total >= {MIN_GROUP} THEN l.q1 ELSE g.q1 END AS q1,
    CASE WHEN a.total >= {MIN_GROUP} THEN a.q3 WHEN l.total >= {MIN_GROUP} THEN l.q3 ELSE g.q3 END AS q3
  FROM (SELECT * FROM q WHERE level = 0) a
  JOIN (SELECT * FROM q WHERE level = 1) l ON a.lang IS NOT DISTINCT FROM l.lang AND a.metric = l.metric
  JOIN (SELECT * FROM q WHERE level = 2) g ON a.metric = g.metric),
fence AS (
  SELECT lang, source, metric, q1 - greatest((q3 - q1) * reach, slack) AS low, q3 + greatest((q3 - q1) * reach, slack) AS high
  FROM chosen JOIN (VALUES {values}) p(metric, reach, slack) USING (metric)),
verdict AS (
  SELECT rid, bool_and(v BETWEEN low AND high) AS inside
  FROM vals v JOIN fence x ON v.lang IS NOT DISTINCT FROM x.lang AND v.source IS NOT DISTINCT FROM x.source AND v.metric = x.metric GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(inside, FALSE) AS kept
FROM b LEFT JOIN verdict USING (rid)
"""


ORACLE_SQL = _oracle()
