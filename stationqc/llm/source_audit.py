"""How sources of a language differ in their words: divergences between all sources, and the terms that set each source apart.

Identical texts of a language are collapsed first: a text moves once, by its digest, with the number of documents that each source has of it, and is
cut into terms once. Its terms' counts and document frequencies are weighted by those numbers and added up inside the task, so what is moved
are sums. A pair's divergence takes the terms that both sources have from a pairing within each term's sources, already grouped by their two counts; terms that
only one source has come from the histogram of its counts, and terms that neither has are counted: no pair meets the whole vocabulary.

Null text, lang and source are ''. A source without terms is a group like others. Repeated rows are documents each. An empty table gives an
empty result. Values above the largest long are given as that. A term's row holds at most one entry for each source of its language.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationqc.llm.common import read, written
from stationqc.llm.tokens import slices

LEAST_DOCUMENTS = 3
TERM_RANKS = 200
#: Sums that a task holds before it hands them on.
HELD = 600_000

#: Bytes of UTF-8: A-Z lower-cased, all that separates terms a space. Bytes of other characters than ASCII are parts of terms.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_SUMS = "lang string, source string, term string, n long, df long"
_LARGEST = 2**63 - 1


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, copies): each different text of a language once, with the documents that each source has of it."""
    rows = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    copies = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in sorted(counts.items()):
            if n:
                columns = [pa.array([lang], pa.string()).take(pa.array([0] * len(n))), pa.array([source], pa.string()).take(pa.array([0] * len(n)))]
                columns += [pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([df[t] for t in n], pa.int64())]
                yield pa.record_batch(columns, names=["lang", "source", "term", "n", "df"])
        counts.clear()

    for batch in batches:
        for some in slices(batch, "text"):
            for lang, text, copies in zip(some.column("lang").to_pylist(), some.column("text").to_pylist(), some.column("copies").to_pylist(), strict=True):
                found = terms(text)
                for copy in copies:
                    n, df = counts[lang, copy["source"]]
                    if copy["n"] == 1:
                        n.update(found)
                        df.update(set(found))
                    else:
                        for term, k in Counter(found).items():
                            n[term] += k * copy["n"]
                            df[term] += copy["n"]
            if sum(len(n) for n, _ in counts.values()) > HELD:
                yield from out()
    yield from out()


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, entries): the terms of at least `least` documents of their language, with their count in each source that has them."""
    sums = collapsed(docs).mapInArrow(_added_up, _SUMS).repartition("lang", "term")
    each = sums.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    rows = each.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("entries"), F.sum("df").alias("df"))
    return rows.filter(F.col("df") >= least).select("lang", "term", "entries")


def _p(n: str, total: str) -> str:
    return f"1 + (cast({n} as decimal(20,0)) + 1) * 1000000000 div ({total})"


def _long(value):
    return F.least(value, F.lit(_LARGEST).cast("decimal(38,0)")).cast("long")


def audited(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    kept = written(kept_terms(docs, least))
    each = kept.select("lang", "term", F.inline("entries"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum(F.expr("aggregate(entries, 0L, (a, x) -> a + x.n)")).alias("total"))
    sums = each.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    # A row per source of each language, those without terms too. total + v is what counts are divided by; it is 0 only where no term is asked for.
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    languages = vocabulary.select("lang", "v", F.expr("total + v").alias("lang_base"))
    groups = groups.join(sums, ["lang", "source"], "left").join(languages, "lang", "left").na.fill(0, ["total", "present", "v"])
    groups = written(groups.select("lang", "source", "present", "v", "lang_base", F.expr("greatest(total + v, 1L)").alias("base")).withColumn("absent", F.expr(_p("0", "base"))))

    pairs = _pairs(kept, each, groups)
    entries = kept.select("lang", "term", F.expr("aggregate(entries, 0L, (a, x) -> a + x.n)").alias("lang_n"), F.inline("entries"))
    entries = entries.join(groups.select("lang", "source", "base", "lang_base"), ["lang", "source"])
    entries = entries.select("lang", "source", "term", F.expr(_p("n", "base")).alias("p"), F.expr(_p("lang_n", "lang_base")).alias("q")).filter("p > q")
    apart = entries.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    apart = apart.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(apart)


def _pairs(kept: DataFrame, each: DataFrame, groups: DataFrame) -> DataFrame:
    """The divergence of every group from each other source of its language."""
    own = groups.select("lang", "source", "present", "v", "base", F.col("absent").alias("p0"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("present").alias("other_present"), F.col("base").alias("other_base"), F.col("absent").alias("q0"))
    couples = own.join(other, "lang").filter("source <> item")
    f = lambda p, q: f"cast(({p} - {q}) * ({p} - {q}) div {q} as decimal(38,0))"
    # Terms that only one of the two has, and those of both as if the other had none: by count, not by term.
    by_count = each.groupBy("lang", "source", "n").agg(F.count("*").alias("terms"))
    mine = by_count.join(couples, ["lang", "source"]).withColumn("p", F.expr(_p("n", "base")))
    mine = mine.select("lang", "source", "item", F.expr(f"terms * {f('p', 'q0')}").alias("value"))
    theirs = by_count.withColumnRenamed("source", "item").join(couples, ["lang", "item"]).withColumn("q", F.expr(_p("n", "other_base")))
    theirs = theirs.select("lang", "source", "item", F.expr(f"terms * {f('p0', 'q')}").alias("value"))
    # Terms of both: within the sources of a term, by the two counts.
    both = kept.select("lang", "entries", F.inline("entries")).select("lang", "source", "n", F.explode("entries").alias("e")).filter("source < e.source")
    both = both.groupBy("lang", "source", F.col("e.source").alias("item"), "n", F.col("e.n").alias("other_n")).agg(F.count("*").alias("terms"))
    both = written(both)
    turned = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("other_n").alias("n"), F.col("n").alias("other_n"), "terms")
    both = both.unionByName(turned)
    both = both.join(couples, ["lang", "source", "item"]).withColumns({"p": F.expr(_p("n", "base")), "q": F.expr(_p("other_n", "other_base"))})
    shared = both.select("lang", "source", "item", F.expr(f"terms * ({f('p', 'q')} - {f('p', 'q0')} - {f('p0', 'q')})").alias("value"), "terms")
    in_both = shared.groupBy("lang", "source", "item").agg(F.sum("value").alias("shared"), F.sum("terms").alias("common"))
    single = mine.unionByName(theirs).groupBy("lang", "source", "item").agg(F.sum("value").alias("single"))
    keys = ["lang", "source", "item"]
    rows = couples.join(single, keys, "left").join(in_both, keys, "left").na.fill(0, ["common"])
    zero = F.lit(0).cast("decimal(38,0)")
    neither = F.expr(f"(v - present - other_present + common) * {f('p0', 'q0')}")
    value = F.when(F.col("v") == 0, zero).otherwise(F.coalesce("single", zero) + F.coalesce("shared", zero) + neither)
    return rows.select("lang", "source", F.lit("pair").alias("part"), "item", _long(value).alias("value"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(read(spark, sf_dir, "documents", "lang", "source", "text"))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= {LEAST_DOCUMENTS}),
vocabulary AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + v.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_n + 1)) // (v.total + v.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN vocabulary v ON g.lang = v.lang JOIN totals s ON g.lang = s.lang AND g.source = s.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
apart AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM apart))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}
"""
