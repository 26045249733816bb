"""The pipeline's result against its stages by brute force, each on its own input."""

import zlib

import numpy as np

import corpus_pipeline
from stationqc.llm import mixing, packing, secrets, tokens, toxicity
from stationqc.llm.common import read, written
from tests.llm.test_brute import _components


def test_stages(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toArrow().to_pylist()
        docs = written(stage(spark, docs, sf_dir))
        after = docs.toArrow().to_pylist()
        seen.append(name)
        if name != "packing":
            assert docs.columns == columns
        {"toxicity": _toxic, "ngram_jaccard_join": _copies, "secret_scan": _secrets, "mix_sources": _mix, "packing": _pack}[name](spark, sf_dir, before, after)
    assert len(seen) == 5
    assert docs.count() == corpus_pipeline.run(spark, sf_dir).count()


def test_rows_that_share_an_id_are_judged_each(spark):
    x, y, z = (" ".join(f"{w}{k}" for k in range(40)) for w in "xyz")
    rows = [(3, x, "a"), (7, x, "b"), (7, y, "b"), (7, y, "b"), (7, z, "c"), (7, z + " more", "c"), (8, z, "c"), (9, "", "d"), (9, None, "d"), (None, x, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [tuple(r) for r in corpus_pipeline.one_of_near_copies(spark, docs, "").collect()]
    expected = [(3, x, "a"), (7, y, "b"), (7, z, "c"), (9, "", "d"), (9, None, "d"), (None, x, "e")]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_columns_of_the_table_may_have_any_name(spark):
    x, y = (" ".join(f"{w}{k}" for k in range(40)) for w in "xy")
    names = ["_text_hash", "_component", "_rank_in_group", "component", "text_hash", "row", "rank", "a.b"]
    rows = [(k, t, f"t{k}", *[f"{n} of {k}" for n in names]) for k, t in enumerate([x, x + " more", y, None])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    found = corpus_pipeline.one_of_near_copies(spark, docs, "")
    assert found.columns == docs.columns
    assert sorted(map(tuple, found.collect())) == [rows[0], *rows[2:]]


def _toxic(spark, sf_dir, before, after):
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in before], "doc_id long, text string")
    model = toxicity.fitted(docs, read(spark, sf_dir, "labels"))
    known = toxicity.Features(model.weights)
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if model.score(known.of(r["text"])) < 0.5)


def _copies(spark, sf_dir, before, after):
    found = _components([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted({c for _, c in found.values()})


def _secrets(spark, sf_dir, before, after):
    texts = {r["doc_id"]: r for r in after}
    assert len(texts) == len(before)
    for r in before:
        import re

        spans = [m.span() for rule in secrets.RULES for m in re.finditer(rule.pattern, r["text"] or "", rule.flags) if len(m[rule.group]) >= rule.least]
        text = secrets._mask(r["text"], spans, secrets.MASK) if spans else r["text"]
        assert texts[r["doc_id"]]["text"] == text and texts[r["doc_id"]]["n_chars"] == (len(text) if spans else r["n_chars"])


def _mix(spark, sf_dir, before, after):
    size = lambda t: len((t or "").split())
    sources, taken = {}, {}
    for r in before:
        sources[r["source"]] = sources.get(r["source"], 0) + size(r["text"])
    for r in after:
        taken[r["source"]] = taken.get(r["source"], 0) + size(r["text"])
    weights = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sorted(sources))}
    targets, left, free = {}, mixing.BUDGET * sum(sources.values()), set(sources)
    while free:  # clamp and share again until none is above its cap
        level = left / sum(weights[s] for s in free)
        above = {s for s in free if level * weights[s] > 2 * sources[s]}
        for s in above or free:
            targets[s] = 2 * sources[s] if above else level * weights[s]
        left -= sum(targets[s] for s in above)
        free = free - above if above else set()
    assert all(abs(taken.get(s, 0) - targets[s]) <= 1 for s in sources)


def _pack(spark, sf_dir, before, after):
    encoder = tokens.encoder()
    pieces = {}
    for r in before:
        ids = encoder.encode(r["text"] or "") + np.uint32(packing.END_ID).tobytes()
        at = 0
        for n in packing.lengths(len(ids) // 4):
            key = (r["doc_id"], at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]))
            pieces[key] = pieces.get(key, 0) + 1
            at += n
    for r in after:
        key = (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
        pieces[key] -= 1
    assert not any(pieces.values())
