"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationqc.llm import fingerprints, html_templates, jaccard_join, licenses, mixing, packing, quality_rules, secrets, token_files, toxicity
from stationqc.llm.common import shared_folder, words

LABELS = "doc_id long, toxic int"


def _toxicity(docs):
    return toxicity.scored(docs, toxicity.fitted(docs, docs.sparkSession.createDataFrame([(5, 1), (8, 0), (8, None)], LABELS)))


def _tokens(docs):
    path = shared_folder(docs.sparkSession)
    token_files.write_tokens(docs, path, parts=3)
    return token_files.read_tokens(docs.sparkSession, path)


def _fingerprints(docs):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return fingerprints.with_next(rows.withColumn("sig", fingerprints.text_signature(F.col("text"))))


def _mixing(docs):
    return mixing.with_taken(docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size")))


def _licenses(docs):
    return licenses.inherited(licenses.own_licenses(docs.select("doc_id", F.concat_ws("/", F.lit(""), "source", F.col("doc_id").cast("string")).alias("path"), "text")))


OPERATORS = {
    "toxicity": _toxicity,
    "licenses": _licenses,
    "quality": lambda docs: quality_rules.judged(quality_rules.base_features(docs)),
    "tokens": _tokens,
    "secrets": secrets.scanned,
    "masked": secrets.masked,
    "fingerprints": _fingerprints,
    "mixing": _mixing,
    "jaccard": jaccard_join.clustered,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_odd_row(odd, name):
    assert OPERATORS[name](odd).count() == odd.count()


@pytest.mark.parametrize("name", OPERATORS)
def test_nothing_from_nothing(none, name):
    assert OPERATORS[name](none).count() == 0


def test_mixed_and_packed_rows(odd, none):
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mixed(none).count() == 0
    assert packing.packed(none).count() == 0
    assert packing.packed(odd).filter("start = 0").count() == odd.count()


def test_toxicity_without_labels(odd):
    model = toxicity.fitted(odd, odd.sparkSession.createDataFrame([], LABELS))
    assert {r.score for r in toxicity.scored(odd, model).collect()} == {toxicity.Model({}, -40.0).score(set())}


def test_held_out_is_never_null(odd, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    odd.sparkSession.createDataFrame([(5, 1), (8, 0), (None, 1)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    found = toxicity.op2_toxicity(odd.sparkSession, str(tmp_path)).collect()
    assert {r.held_out for r in found} <= {True, False} and {r.held_out for r in found if r.doc_id is None} == {False}


def test_pages(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("url", "html", "host", "text")]])
    rows = [
        (1, None, None, "x", "x"),
        (2, "http://a.example/", "", "x", "x"),
        (3, "http://a.example/", "<p>A &amp; B<p>C\n  <b>d", "x", "x"),
        (3, "http://a.example/", "<p>A &amp; B<p>C\n  <b>d", "x", "x"),
        (4, "no url", "<article>" + "<div>" * 3000 + "deep", "x", "x"),
        (None, "http://a.example/", "<nav>Menu</nav>only <i>text</i><script>if (a</b) {}</script><!-- no", "x", "x"),
    ]
    found = [(r.page_id, r.text, r.n_chars) for r in html_templates.extracted(spark.createDataFrame(rows, schema)).collect()]
    texts = [(1, ""), (2, ""), (3, "A & B\nC d"), (3, "A & B\nC d"), (4, "deep"), (None, "only text")]
    assert sorted(found, key=str) == sorted([(i, t, len(t)) for i, t in texts], key=str)
    assert html_templates.extracted(spark.createDataFrame([], schema)).count() == 0
