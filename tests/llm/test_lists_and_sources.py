"""The url filter, the source audit and the alignment of tokenizers against brute force, on odd rows and on both of their ways."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from stationqc.llm import cross_tokens, source_audit, url_lists
from stationqc.llm.common import written

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://Example.ORG/es/1?x=/fr/",
    "http://example.org/en/12",
    "http://sub.example.org/en/2",
    "http://org",
    "http://notexample.org/es/",
    "https://a.com/fr/x#y",
    "https://a.com/de/x",
    "https://m.casino-win.net/x",
    "https://casino-win.net?x",
    "https://casinos.net/",
    "http://a.b.spam.farm.io/page",
    "http://farm.io/page",
    "http://u@spam.io:80/",
    "http://spam.io:80",
    "http://two\nlines.xxx/a",
    "http://Ä.ads.De/é?://b.com/de/",
    "http://" + "a." * 5000 + "casino.biz/p",
    "http://x.casino.biz/p",
    "http://casino.biz/" + "p/" * 5000,
]


def _brute_verdict(url, listed):
    scheme, found, rest = (url or "").partition("://")
    if not found:
        return "", "", None, "allow"
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    rest = rest[n:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in url_lists.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    parts = host.split(".")
    hit = any(".".join(parts[i:]) + "/" in listed for i in range(len(parts))) or host and host + path in listed
    return host, path, None, "block" if hit else "allow"


def _pages(spark, urls):
    return spark.createDataFrame([(k, u, "x", "x", "x") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string, key string")


@pytest.mark.parametrize("shard", [url_lists.SHARD, 3])
@pytest.mark.parametrize("mapped", [True, False])
def test_urls_against_brute_force(spark, monkeypatch, shard, mapped):
    if not mapped:
        monkeypatch.setattr(url_lists, "_mapped", lambda folder: None)
    listed = ["casino-win.net/", "spam.farm.io/", "farm.io/other", "io/page", "spam.io:80/", "casino.biz/", "farm.io/page", "a.com/de/x", "org/", *[f"h{k}.net/" for k in range(40)]]
    urls = URLS + [f"http://w.h{k}.net/q" for k in range(0, 80, 3)]
    keys = spark.createDataFrame([(k,) for k in [*listed, *listed[:5], None]], "key string")
    found = url_lists.judged(_pages(spark, urls), url_lists.write_list(keys, shard)).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found) == [(k, *_brute_verdict(u, set(listed))) for k, u in enumerate(urls)]


def test_digests_that_collide_are_told_apart_by_their_strings(monkeypatch, spark):
    monkeypatch.setattr(url_lists.F, "xxhash64", lambda c: F.lit(7).cast("long"))
    found = url_lists.write_list(spark.createDataFrame([("a/",), ("b/",), ("dd/",)], "key string"))
    assert found.listed([b"a/", b"c/", b"dd/", b"b/", b""], np.array([7, 7, 7, 7, 8])).tolist() == [True, False, True, True, False]


def test_shards_that_can_not_be_mapped_are_sorted_and_searched_too(spark, monkeypatch):
    monkeypatch.setattr(url_lists, "_mapped", lambda folder: None)
    names = [f"h{k}.net/" for k in range(40)]
    found = url_lists.write_list(spark.createDataFrame([(k,) for k in names], "key string"), 3)
    shards = [(r.shard, url_lists._opened(np.frombuffer(r.data, np.uint8))) for r in found.table.collect()]
    assert len(shards) > 5 and all((np.diff(stored) >= 0).all() for _, (stored, _, _) in shards)
    assert sorted(s[a:b].tobytes().decode() for _, (_, ends, s) in shards for a, b in zip([0, *ends[:-1]], ends)) == sorted(names)
    assert {n for n, _ in shards} == {int(n) for _, (stored, _, _) in shards for n in url_lists._shard_number(stored, found.bits)}
    # Colliding digests are told apart by the stored strings here as well.
    monkeypatch.setattr(url_lists.F, "xxhash64", lambda c: F.lit(7).cast("long"))
    listed = url_lists.write_list(spark.createDataFrame([("a.b/",), ("c.d/",)], "key string"))
    judged = url_lists.judged(_pages(spark, ["http://x.c.d/", "http://d/", "http://a.b", "http://b"]), listed).collect()
    assert [r.verdict for r in sorted(judged)] == ["block", "allow", "block", "allow"]


def test_no_pages_and_no_list(spark):
    nothing = _pages(spark, URLS).filter("false")
    assert url_lists.judged(nothing, url_lists.write_list(url_lists.named_hosts(nothing))).count() == 0
    empty = url_lists.write_list(url_lists.named_hosts(nothing))
    assert {r.verdict for r in url_lists.judged(_pages(spark, ["http://a.casino.net/", None]), empty).collect()} == {"allow"}


def test_named_hosts_are_the_entries_from_their_named_label_on(spark):
    found = {r.key for r in url_lists.named_hosts(_pages(spark, URLS)).collect()}
    assert found == {"casino-win.net/", "spam.farm.io/", "spam.io:80/", "xxx/", "ads.de/", "casino.biz/"}


@pytest.mark.parametrize("module, query", [(url_lists, "op11_url_filter"), (source_audit, "op12_source_audit")])
def test_query_equals_sql(spark, sf_dir, module, query):
    ours = getattr(module, query)(spark, sf_dir).toArrow()
    assert differences(ours, connect(sf_dir).sql(module.ORACLE_SQL).to_arrow_table()) == []


def _brute_audit(rows, least, ranks):
    docs = [(lang or "", source or "", [t.decode() for t in source_audit.terms(text or "")]) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        kept = {t for t, n in Counter(t for d in own for t in set(d[2])).items() if n >= least}
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        counts[None] = sum(counts.values(), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept)) for t in kept} for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts.keys() - {None}:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts.keys() - {None, s}]
            term = [(f(p[s][t], p[None][t]), t) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found) if part == "pair" or k < ranks]
    return sorted(out)


def test_audit_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = ["a", "B", "b", "Äh", "äh", "x1y", "\U00010400", "￿", "Zz", "rare"]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s", "t", "u", None]), " ".join(rng.choices(words, k=rng.randint(0, 9)))) for _ in range(150)]
    rows += [("en", "t", "many copies of B")] * 40 + [("fr", "s", "unlike"), ("fr", "v", None), ("it", "only", ""), ("en", "void", "!"), (None, None, None)]
    monkeypatch.setattr(source_audit, "HELD", 5)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int")
    found = sorted(tuple(r) for r in source_audit.audited(docs, 3, 4).select("lang", "source", "part", "item", "value", "rank").collect())
    assert found == _brute_audit(rows, 3, 4)


def test_audit_of_odd_rows(odd, none):
    assert source_audit.audited(none).count() == 0
    pairs = source_audit.audited(odd).filter("part = 'pair'").collect()
    assert sorted((r.lang, r.source, r.item) for r in pairs) == [("en", "", "a"), ("en", "a", ""), ("es", "c", "d"), ("es", "d", "c")]


class _Whole:
    """Both tokenizers on whole texts, links pair by pair."""

    def __init__(self):
        self.both = cross_tokens.Aligner(public_tokenizers.path(cross_tokens.A_FILE), public_tokenizers.path(cross_tokens.B_FILE))

    def groups(self, text):
        if not text:
            return []
        whole = (" " + text).encode()
        sides = []
        for ids, table in ((self.both.a.encode(" " + text, add_special_tokens=False).ids, self.both.a_bytes), (self.both.b.encode(text), self.both.b_bytes)):
            if b"".join(table[i] for i in ids) != whole:
                return []
            sides.append(list(zip(ids, np.cumsum([len(table[i]) for i in ids]).tolist())))
        cuts = sorted({e for _, e in sides[0]} & {e for _, e in sides[1]})
        return [tuple([i for i, e in side if before < e <= cut] for side in sides) for before, cut in zip([0, *cuts], cuts)]


def _brute_links(texts):
    whole = _Whole()
    groups = [whole.groups(t) for t in texts]
    links = [[(a, b) for x, y in g for a in x for b in y] for g in groups]
    counts = Counter(pair for found in links for pair in set(found))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for g, found in zip(groups, links):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        digest = hashlib.sha256(text.encode()).hexdigest() if g else ""
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(found), sum(counts[p] == best[p[0]] for p in found), sum(counts[p] for p in found), digest))
    return out


ODD_TEXTS = ["", None, " ", "  two  spaces  ", "\n", "a\n b \nc\td", "a▁b", "<|endoftext|> and <s> </s> <unk>", "café \U0001f600\U0001f600 中文中", "a b　 c", "\x00\x1c \x85x", "don't  it's 12345 x" * 3, "=" * 500, "é ﬁ", "<0x41> A\r\n\r\nB", "the same text", "the same text"]


@pytest.mark.parametrize("pairs", [cross_tokens.PAIRS, 5])
def test_alignment_against_brute_force(spark, documents, monkeypatch, pairs):
    monkeypatch.setattr(cross_tokens, "REMEMBERED", 300)
    monkeypatch.setattr(cross_tokens, "HELD", 50)
    rng = random.Random(5)
    texts = [*ODD_TEXTS, *[d["text"][:3000] for d in documents[:40] if d["text"]]]
    texts += ["".join(rng.choices(["a", "B", " ", "  ", "\n", "é", "中", "th", "'s", "1", ".", " ", "\t"], k=rng.randint(1, 60))) for _ in range(150)]
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(texts)], "doc_id long, text string, n_a int, same string").repartition(5)
    table = written(cross_tokens.aligned(docs))
    found = cross_tokens.with_counts(table, cross_tokens.same_ids(), pairs).orderBy("doc_id").collect()
    assert [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found] == _brute_links(texts)


def test_alignment_of_odd_rows(odd, none):
    for docs in (odd, none):
        table = written(cross_tokens.aligned(docs, groups=True))
        assert table.filter("groups_sha256 <> '' and sha2(groups, 256) <> groups_sha256").count() == 0
        assert cross_tokens.with_counts(table, cross_tokens.same_ids()).count() == docs.count()


def test_same_ids_have_the_same_bytes():
    both = _Whole().both
    assert all(both.b_bytes[b] == both.a_bytes[a] for a, b in enumerate(both.same) if b >= 0)
    assert (both.same >= 0).sum() > 10_000
