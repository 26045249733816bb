"""Operators that SQL can't express, against brute force, exact round trips or held-out accuracy; those that it can, against SQL."""

import hashlib
import html
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationqc.llm import catalog, fingerprints, jaccard_join, licenses, packing, range_coder, secrets, token_files, tokens, toxicity
from stationqc.llm.common import shared_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _tables(con, sf_dir):
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


@pytest.mark.parametrize("name", catalog.ORACLE_SQL)
def test_equals_sql(spark, sf_dir, name):
    ours = catalog.QUERIES[name](spark, sf_dir).toArrow()
    theirs = _tables(duckdb.connect(), sf_dir).execute(catalog.ORACLE_SQL[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names) and ours.num_rows > 0
    rows = [Counter(zip(*[t[c].to_pylist() for c in columns], strict=True)) for t in (ours, theirs)]
    assert rows[0] == rows[1]


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").toArrow().to_pylist()
    found = {r.page_id: r.text for r in catalog.QUERIES["op1_extract_html"](spark, sf_dir).collect()}
    for page in pages:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page["html"], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:h1|p|b|br)>", article)]
        assert found[page["page_id"]] == "\n".join(b for b in blocks if b)


def test_template_texts_go(spark):
    from stationqc.llm.html_templates import extracted

    page = "<html><body><div class='top'>Site</div><div id=m><p>Words of page {0} and {1}.</p><p>All rights reserved</p></div></body></html>"
    rows = [(k, f"http://h.example/{k}", page.format(k, k * 7)) for k in range(12)] + [(99, "http://other.example/", page.format(1, 7))]
    found = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[3] == "Words of page 3 and 21."
    assert found[99] == "Site\nWords of page 1 and 7.\nAll rights reserved"  # too few pages for a template


def test_pages_without_a_body_have_a_template(spark):
    from stationqc.llm.html_templates import extracted

    page = "<div class='top'>Site</div><div id=m><p>Words of page {0} and {1}.</p><p>All rights reserved</p></div>"
    rows = [(k, f"http://h.example/{k}", page.format(k, k * 7)) for k in range(12)]
    found = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {k: f"Words of page {k} and {k * 7}." for k in range(12)}


def test_copies_of_a_page_are_no_template(spark):
    from stationqc.llm.html_templates import extracted

    page = "<html><head><title>{0}</title></head><body><div class='top'>Site</div><article id='post-{0}'><p>Words of page {0}.</p><p>And {1} more.</p></article><!-- {2} --></body></html>"
    rows = [(k, page.format(k, k * 7, k)) for k in range(8)] + [(100 + k, page.format(17, 119, 0)) for k in range(30)]
    rows += [(200 + k, page.format(18, 126, k) + f"<p class='n{k}'></p>") for k in range(60)]  # copies but for what is around the main part
    rows = [(k, f"http://h.example/{k}", html) for k, html in rows]
    found = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    for k in range(8):
        assert found[k] == f"Words of page {k}.\nAnd {k * 7} more."
    assert {found[100 + k] for k in range(30)} == {"Words of page 17.\nAnd 119 more."}
    assert {found[200 + k] for k in range(60)} == {"Words of page 18.\nAnd 126 more."}


def test_what_is_not_main_text_goes():
    from stationqc.llm.html_templates import blocks

    page = """<header><h1>Site</h1></header><div class="cookie-notice">We bake</div><main><header class="post-header"><h1>Title &lt;1&gt;</h1></header>
    <p>First&nbsp;line<br>goes on</p><form>Mail <input></form><aside>See also</aside><ul><li>One<li>Two</ul><div id="comments"><p>Nice!</p></div>
    <table><tr><td>a<td>b</table><blockquote>Q</blockquote>tail</main><div class="sidebar">Side</div><footer>End</footer>"""
    assert blocks(page) == ["Title <1>", "First line goes on", "One", "Two", "a", "b", "Q", "tail"]


def test_whole_licences_are_inherited(spark, documents):
    folder = "/usr/share/common-licenses"
    if not os.path.isdir(folder):
        pytest.skip("no licence texts")
    whole = {"Apache-2.0": "Apache-2.0", "GPL-3.0": "GPL-3", "LGPL-3.0": "LGPL-3", "BSD-3-Clause": "BSD"}
    texts = {name: open(f"{folder}/{file}", encoding="utf-8").read() for name, file in whole.items()}
    rows = [(k, f"/docs/{k}", d["text"]) for k, d in enumerate(documents)]
    for name, text in texts.items():
        rows += [(len(rows), f"/{name}/LICENSE", f"Copyright 2020 Some One\n\n{text}"), (len(rows) + 1, f"/{name}/src/deep/file", "no words of that kind")]
    rows.append((len(rows), "/words/common", "the of to and or a license " * 200))  # as common as in licences, but no licence
    rows.append((len(rows), "/words/other", "nothing"))
    found = {r.path: r for r in licenses.inherited(licenses.own_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string"))).collect()}
    for name in texts:
        assert found[f"/{name}/LICENSE"].license == name
        below = found[f"/{name}/src/deep/file"]
        assert (below.license, below.given_by, below.directory) == (name, "directory", f"/{name}")
    assert found["/words/common"].license is None and found["/words/other"].license is None


def test_whole_licences_equal_sql(spark, tmp_path, documents):
    """Texts from the terms of whole licences: all, half and one less of the distinct ones, among other words, without those that name a licence."""
    rng = np.random.default_rng(6)
    rows = [(d["doc_id"], d["source"], d["lang"], d["text"]) for d in documents]
    plain = len(rows)
    for name, counted in licenses._WHOLE:
        every = [t for t in counted if t not in ("license", "licence", "licenses", "copyright")]
        heavy = sorted(every, key=lambda t: (-counted[t], t))
        half = licenses._least(counted)
        for k, (some, others) in enumerate([(list(counted), 0), (heavy[:half], 0), (heavy[: half - 1], 0), (heavy[:half], 30), (every, 400)]):
            found = [t for t in some for _ in range(counted[t])] + [f"other{x}" for x in range(others)]
            rows.append((10**9 + len(rows), f"{name}{k}", "en", " ".join(rng.permutation(found))))
        shortest = sorted(counted, key=len)[:half]
        assert len(" ".join(shortest)) == licenses._shortest(counted)
    pq.write_table(pa.table(dict(zip(("doc_id", "source", "lang", "text"), zip(*rows, strict=True), strict=True))), tmp_path / "documents.parquet")
    found = {r.doc_id: r.asDict() for r in licenses.op3_license_scan(spark, str(tmp_path)).collect()}
    con = _tables(duckdb.connect(), str(tmp_path)).execute(licenses.ORACLE_SQL)
    names = [c[0] for c in con.description]
    assert found == {r[names.index("doc_id")]: dict(zip(names, r, strict=True)) for r in con.fetchall()}
    given = [found[r[0]]["license"] for r in rows[plain:]]
    assert given[::5] == [name for name, _ in licenses._WHOLE]  # whole ones
    assert sum(x is not None for x in given[1::5]) > 5  # half of the terms
    # Which texts are weighed at all. Those with a term less than half may still be near a notice, or have half of another licence.
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    weighed = {r.doc_id for r in table.filter(licenses._has_half(F.col("text"))).collect()}
    has = {i: set(re.findall("[a-z0-9]+", (t or "").lower())) for i, _, _, t in rows}
    assert weighed == {i for i, some in has.items() if any(2 * len(some & set(counted)) >= len(counted) for _, counted in licenses._WHOLE)}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in catalog.QUERIES["op2_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in toxic]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    hits = Counter((toxic[r.doc_id], r.predicted) for r in rows)
    assert hits[1, 1] / (hits[1, 0] + hits[1, 1]) > 0.85
    assert hits[1, 1] / (hits[0, 1] + hits[1, 1]) > 0.85


def test_nonnegative_risk_finds_the_sign():
    rng = np.random.default_rng(1)
    clean = [np.unique(rng.integers(100, 5000, 40)) for _ in range(400)]
    toxic = [np.append(np.unique(rng.integers(100, 5000, 40)), 7) for _ in range(100)]
    model = toxicity.train(toxic[:60], clean + toxic[60:], 40 / 440)
    assert model.score({7}) > 0.5 > model.score(set())


@pytest.fixture(scope="session")
def encoded(documents):
    library = Tokenizer.from_file(tokens.default_path())
    rows = sorted(documents, key=lambda r: r["doc_id"])
    found = library.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)
    return [(r["doc_id"], e.ids) for r, e in zip(rows, found, strict=True)]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, sf_dir, encoded):
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in catalog.QUERIES["op5_token_files"](spark, sf_dir).collect()}
    at = 0
    for doc_id, ids in encoded:
        assert found[doc_id] == (at, len(ids) + 1, _crc([*ids, 0]))
        at += len(ids) + 1


def test_packing(spark, sf_dir, encoded):
    pieces = catalog.QUERIES["op9_pack_sequences"](spark, sf_dir).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces) and {p.offset for p in pieces} == {0}
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for doc_id, ids in encoded:
        ids, at = [*ids, 1], 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length & (p.length - 1) == 0 and p.length <= 2048
            assert p.ids_crc32 == _crc(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)
    assert packing.lengths(2048 * 2 + 5) == [2048, 2048, 4, 1] and packing.lengths(0) == []


@pytest.mark.parametrize(
    "text",
    ["", "a", " a", "a ", "a  b", "a\n\nb", " \n a", "x  y　z", "a\x00b \x00c", "I'm don't  we'll\t 12 3\r\n", "<|endoftext|> hi", "Don't,, stop!! we've ok...", "été, naïve; éa, x", "a1b2, c3.", "日本語 テスト, 中文。 了", "a  b"],
)
def test_pieces_give_the_library_ids(text):
    encoder = tokens.encoder()
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_range_coder():
    rng = np.random.default_rng(2)
    blocks = [rng.integers(0, 60_000, 700), np.zeros(900, np.int64), rng.integers(0, 5, 900), np.array([65_535])]
    coded = range_coder.encode(blocks, [b"", b"a", b"bc", b""])
    for block, (ids, index), expected in zip(blocks, range_coder.decode(coded), [b"", b"a", b"bc", b""], strict=True):
        assert ids.tolist() == block.tolist() and index == expected
    assert len(coded[1]) < 200 and len(coded[2]) < 900 * 2.5 / 8 + 200
    assert range_coder.decode([coded[2]])[0][0].tolist() == blocks[2].tolist()  # a block needs no other
    broken = bytearray(coded[0])
    broken[60] ^= 255
    with pytest.raises(ValueError):
        range_coder.decode([bytes(broken)])
    with pytest.raises(ValueError):
        range_coder.encode([np.array([1 << 16])], [b""])


def test_secrets(spark, sf_dir, documents):
    found = {r.doc_id: r for r in catalog.QUERIES["op6_secret_scan"](spark, sf_dir).collect()}
    for d in documents:
        spans = [(m.start(), k, f"{r.kind}:{m.start()}:{m.end()}") for k, r in enumerate(secrets.BASE) for m in re.finditer(r.pattern, d["text"] or "", r.flags) if len(m[r.group]) >= r.least]
        written = ",".join(s for _, _, s in sorted(spans))
        r, counts = found[d["doc_id"]], Counter(k for _, k, _ in spans)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert {f"n_{rule.kind}": r[f"n_{rule.kind}"] for rule in secrets.BASE} == {f"n_{rule.kind}": counts[k] for k, rule in enumerate(secrets.BASE)}
        # Base spans stay among all spans, which are in order and lie in the text.
        every = [s.rsplit(":", 2) for s in r.spans.split(",") if s]
        assert Counter(s for _, _, s in spans) <= Counter(":".join(s) for s in every)
        starts = [int(at) for _, at, _ in every]
        assert starts == sorted(starts) and all(0 <= int(a) < int(b) <= len(d["text"] or "") for _, a, b in every)


def test_trigram_queries():
    q = secrets.trigram_query
    assert q("abcd") == {frozenset({"abc", "bcd"})}
    assert q("ab(cd|ef)+") == {frozenset({"abc", "bcd"}), frozenset({"abe", "bef"})} or q("ab(cd|ef)+") == secrets.ALL
    assert q("[0-9a-f]+") == secrets.ALL and q("(abc)?") == secrets.ALL
    assert q("xab?cd") == {frozenset({"xab", "abc", "bcd"}), frozenset({"xac", "acd"})}
    scanner = secrets.Scanner()
    texts = pa.array(["PassWord: 'hunter22x'", None, "", "tok", "en=abcdefgh", "é" * 50 + " secret=abcdef", "https://u:pw@h"])
    assert [[k for k, _, _ in s] for s in scanner.spans(texts)] == [["assign"], [], [], [], [], ["assign"], ["url_login"]]
    assert scanner.spans(texts)[5] == [("assign", 51, 64)]
    assert secrets._mask("ab cd ef", [(0, 2), (1, 4), (6, 8)], "#") == "#d #"


def _shingles(text, size):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def test_fingerprints(spark, sf_dir, documents):
    found = {r.doc_id: r for r in catalog.QUERIES["op7_fingerprints"](spark, sf_dir).collect()}
    rows = sorted(documents, key=lambda r: r["doc_id"])
    errors, by_text = [], {}
    for d, after in zip(rows, [*rows[1:], rows[0]], strict=True):
        text, r = d["text"] or "", found[d["doc_id"]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + (after["text"] or "")[:quarter]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        for near, other in ((r.near_edited, edited), (r.near_next, after["text"])):
            a, b = _shingles(text, fingerprints.SHINGLE), _shingles(other, fingerprints.SHINGLE)
            errors.append(near - (len(a & b) / len(a | b) if a | b else 1.0))
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.04


@pytest.mark.parametrize(
    "ids",
    [
        [*range(1, 20_001), 1 << 62],
        [-(1 << 63), *range(5000), *range(1 << 40, (1 << 40) + 9000), (1 << 63) - 1],
        [7] * 9000 + list(range(9000)),
        [None] * 50 + list(range(0, 3_000_000, 500)),
        [],
    ],
)
def test_ids_are_dealt_evenly_wherever_they_lie(spark, ids):
    docs = spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(4)
    stretches = fingerprints._stretches(docs)
    placed = docs.select("doc_id", fingerprints._placed(stretches)[1].alias("range")).collect()
    by_range = defaultdict(list)
    for r in placed:
        by_range[r.range].append(r.doc_id)
    assert len(placed) == len(ids) and set(by_range.pop(-1, [None])) == {None}
    for found in by_range.values():
        assert len(found) <= fingerprints.HEAVY * fingerprints.RANGE or len(set(found)) == 1 or Counter(found).most_common(1)[0][1] > 4000
    bounds = [(min(v), max(v)) for _, v in sorted(by_range.items())]
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))


def test_next_rows_of_distant_ids(spark):
    ids = [*range(1, 6001), 1 << 62, (1 << 62) + 3]
    docs = spark.createDataFrame([(i, f"text {i}", b"") for i in ids], "doc_id long, text string, sig binary").repartition(5)
    docs = docs.withColumn("sig", fingerprints.text_signature(F.col("text")))
    found = {r.doc_id: r.next_text for r in fingerprints.with_next(docs).select("doc_id", "next_text").collect()}
    assert found == {i: f"text {after}" for i, after in zip(ids, [*ids[1:], ids[0]], strict=True)}


def test_files_of_many_directories(spark, monkeypatch):
    rows = [(k, f"/{'abc'[k % 3]}/d{k % 7}/{k}", {"cosine": 0.9, "license": "MIT"} if k == 6 else None) for k in range(60)]
    own = "struct<cosine: double, license: string>"
    files = spark.createDataFrame([(i, p, None, f) for i, p, f in rows], f"doc_id long, path string, own {own}, file {own}")
    given = licenses.inherited(files).collect()
    monkeypatch.setattr(licenses, "SMALL", 0)
    assert sorted(given) == sorted(licenses.inherited(files).collect())
    assert {r.doc_id for r in given if r.license} == {k for k in range(60) if k % 3 == 0 and k % 7 == 6}


def _components(rows, least=85):
    """doc_id to component, by trying all pairs that share a shingle."""
    folded = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {i: _shingles((t or "").translate(folded), 4) for i, t in rows}
    inverted, parent = defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        shared = Counter(j for x in s for j in inverted[x])
        for x in s:
            inverted[x].append(i)
        for j, n in shared.items():
            if 100 * n >= least * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_join(spark, sf_dir, documents):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in catalog.QUERIES["op10_ngram_jaccard"](spark, sf_dir).collect()}
    assert found == _components([(d["doc_id"], d["text"]) for d in documents])


def test_jaccard_join_on_chains_and_short_sets(spark, monkeypatch):
    """Near copies around the threshold in chains and crowds, small sets, copies; meeting places in parts."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 7)
    rng = np.random.default_rng(3)
    rows = []
    for length in (3, 4, 5, 8, 12, 20, 40, 100, 300):
        for _ in range(4):
            words = [f"v{x}" for x in rng.integers(0, 10_000, length)]
            for k in range(8):
                rows.append((len(rows), " ".join(words)))
                if k % 3:
                    for at in rng.integers(0, length, max(1, length // 40)):
                        words[at] = f"v{rng.integers(0, 10_000)}"
    rows += [(len(rows) + k, f"{t} X") for k, (_, t) in enumerate(rows[::5])]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.clustered(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == _components(rows)


@pytest.mark.parametrize("bits", [63, 60])
def test_linked_sets_share_the_digests_they_need(bits):
    """Random pairs of sets that differ by few shingles; with 60 bits all shingles of a set are in few groups."""
    rng = np.random.default_rng(bits)
    linked = 0
    for _ in range(30_000):
        n, extra, gone = int(rng.integers(6, 60)), int(rng.integers(1, 8)), int(rng.integers(0, 4))
        if 100 * (n - gone) < 85 * (n + extra):
            continue
        every = rng.permutation(np.unique(rng.integers(0, 1 << bits, n + extra, dtype=np.uint64) * np.uint64(2)))
        if len(every) < n + extra:
            continue
        linked += 1
        a, b = np.sort(every[gone:]), np.sort(every[:n])
        (one, need_one), (other, need_other) = jaccard_join.group_digests(a), jaccard_join.group_digests(b)
        enough = False
        for band in set(need_one >> 16) & set(need_other >> 16):
            in_band = [(d[need >> 16 == band], need[need >> 16 == band][0] & 65_535) for d, need in ((one, need_one), (other, need_other))]
            shared = len(np.intersect1d(in_band[0][0], in_band[1][0]))
            enough |= shared >= in_band[0][1] and shared >= in_band[1][1]
        assert enough, (a, b)
    assert linked > 5_000


@pytest.mark.parametrize("size", [6, 8, 12, 20, 45])
def test_unrelated_sets_have_no_place_in_common(size):
    rng = np.random.default_rng(size)
    sets = np.sort(rng.integers(0, 1 << 63, (20_000, size), dtype=np.uint64) * np.uint64(2), axis=1)
    places = Counter(x for s in sets for x in set(jaccard_join.group_digests(s)[0].tolist()))
    assert max(places.values()) == 1
    assert all(len(jaccard_join.group_digests(s[:5])[0]) == 0 for s in sets[:100])  # only equal sets link


def test_filter_grows_with_the_classes():
    assert [jaccard_join.filter_bits(n) for n in (0, 500_000, 1_000_000, 1 << 40)] == [1 << 23, 1 << 23, 1 << 24, 1 << 27]


def test_r_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(4)
    base = rng.poisson(4, (60, jaccard_join.COUNTS))
    points = np.concatenate([base, base + (rng.random(base.shape) < 0.1), base])[rng.permutation(180)].astype("u1")
    sizes, parts = points.sum(axis=1).astype(np.int64), rng.integers(0, 50, 180)
    q, p, _ = jaccard_join.RTree(points, sizes, parts).near(points, sizes, parts)
    bound = np.minimum(points[:, None], points[None]).sum(axis=2, dtype=np.int64)
    reach = (bound * 185 >= 85 * (sizes[:, None] + sizes[None])) & (parts[:, None] != parts[None])
    reach &= (np.minimum.outer(sizes, sizes) * 100 >= np.maximum.outer(sizes, sizes) * 85)
    # A query is met by points that are not larger; each pair is a query from one side at least.
    found = {tuple(sorted(x)) for x in zip(q.tolist(), p.tolist(), strict=True)}
    assert {tuple(sorted(x)) for x in np.argwhere(reach).tolist()} <= found
