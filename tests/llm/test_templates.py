"""Templates of hosts: against occurrence vectors written out page by page, marks of single pages, types of pages, doubtful words, deep pages."""

import html
import random
import time
from collections import Counter, defaultdict

import pytest

from stationqc.llm.html_templates import LEAST_PAGES, LEAST_SHARE, MAIN_SHARE, MARK_SHARE, blocks, events, extracted, templates

SCHEMA = "page_id long, url string, html string"


def texts(spark, pages):
    rows = [(k, f"http://h.example/{k}", page) for k, page in enumerate(pages)]
    found = extracted(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


@pytest.mark.parametrize(
    "page",
    [
        "<html><body class='single postid-{0}'><div class='top'>Site</div><div><p>Words of page {0} and {1}.</p></div><p>All rights reserved</p></body></html>",
        "<html><body><div class='top'>Site</div><div id='post-{0}'><p>Words of page {0} and {1}.</p><p>All rights reserved</p></div></body></html>",
        "<html><body class='type-{2}'><div class='top'>Site</div><div class='t{2}'><p>Words of page {0} and {1}.</p></div><p>All rights reserved</p></body></html>",
    ],
)
def test_repeated_lines_go_whatever_marks_a_page_has(spark, page):
    pages = [page.format(k, k * 7, k % 3) for k in range(30)]
    assert texts(spark, pages) == [f"Words of page {k} and {k * 7}." for k in range(30)]


FRAGMENTS = ["<div class='share-price'>It rose by two.</div>", "<section class='search'>They looked for it.</section>", "<p id='notice'>It was put up.</p>", "<p class='related work'>Others did so.</p>"]


def test_words_that_name_a_subject_stay_in_an_article():
    for fragment, text in zip(FRAGMENTS, ["It rose by two.", "They looked for it.", "It was put up.", "Others did so."], strict=True):
        assert blocks(f"<body><nav>Menu</nav><article><h1>Title</h1>{fragment}<p>End.</p></article></body>") == ["Title", text, "End."]
    links = "<div class='related'>See <a href=1>this one</a> <a href=2>and that one</a></div><div class='search'>Find <form><input></form></div><div class='share'><div class='social'><a>x</a></div></div>"
    assert blocks(f"<article><p>Text.</p>{links}</article>") == ["Text."]


def test_words_count_where_the_template_has_the_element(spark):
    page = "<body><article><h1>Page {0}</h1><p>Words {1}.</p><div class='notice n{0}'>Told {2} today.</div></article></body>"
    pages = [page.format(k, k * 7, k * 3) for k in range(12)]
    assert texts(spark, pages) == [f"Page {k}\nWords {k * 7}." for k in range(12)]
    pages[1:] = [p.replace("notice", "remark") for p in pages[1:]]  # one page's own word
    assert texts(spark, pages)[0] == "Page 0\nWords 0.\nTold 0 today."


@pytest.mark.parametrize("tag", ["<div>", "<blockquote>", "<li>", "<span><p>", "<table><tr><td>", "<div class='notice'>", "</p><b>"])
def test_deep_pages_take_linear_time(tag):
    began = time.process_time()
    assert blocks("<article>" + tag * 50_000 + "deep") in (["deep"], [])
    assert time.process_time() - began < 10  # the square of it takes minutes


def brute(pages):
    """The template of one host's pages: marks, tags, texts and doubtful tags, from whole vectors."""
    by_main = defaultdict(list)
    for page in pages:
        by_main["\n".join(blocks(page))].append(page)
    n = len(by_main)
    if n < LEAST_PAGES:
        return None
    on = Counter(m for copies in by_main.values() for m in {m for k, e, _ in events(copies[0]) if k == "tag" for m in e.marks})
    marks = {m for m, k in on.items() if k >= max(LEAST_PAGES, n * MARK_SHARE)}
    vectors, about = defaultdict(lambda: [0] * n), {}
    for column, copies in enumerate(by_main.values()):
        for page in copies:
            count = Counter()
            for kind, e, value in events(page, frozenset(marks)):
                if kind == "tag":
                    token = (e.path, None)
                elif kind == "text" and e and html.unescape(value).split():
                    token = (e.path, " ".join(html.unescape(value).split()))
                else:
                    continue
                count[token] += 1
                about[token] = e
            for token, k in count.items():
                vectors[token][column] = max(vectors[token][column], k)
    classes = defaultdict(list)
    for token, vector in vectors.items():
        share = MAIN_SHARE if token[1] is not None and about[token].main else LEAST_SHARE
        if sum(map(bool, vector)) >= max(LEAST_PAGES, n * share):
            classes[tuple(vector)].append(token)
    good, valid, grew = set(), [], True
    while grew:  # until no class is added, in any order
        grew = False
        for vector, c in classes.items():
            own = {p for p, text in c if text is None}
            if own and vector not in valid and {about[p, None].parent for p in own} - {0} <= good | own:
                good |= own
                valid.append(vector)
                grew = True
    every = [token for v in valid for token in classes[v]]
    found = {(p, text) for p, text in every if text is not None and p in good}
    return marks, good, len(found), {p for p, text in every if text is None and about[p, None].doubt is about[p, None]}


def a_page(r, k):
    kind = r.choice("abc")
    body = [f"<p class='{r.choice(['x', 'y', f'own{k}'])}'>Words {r.randrange(40)} of {k}.</p>" for _ in range(r.randint(0, 3))]
    body += [r.choice(["<p>Repeated line</p>", "<div class='notice'>Told you</div>", "<h2>Part</h2>", f"<blockquote>Said {k % 4}</blockquote>", ""]) for _ in range(2)]
    r.shuffle(body)
    main = ("<article id='post-{0}'>{1}</article>" if kind != "c" else "<div class='post post-{0}'>{1}</div>").format(k, "".join(body))
    return f"<html><body class='type-{kind} id-{k}'><div class='top'>Site<b>{kind}</b></div>{main}<p>All rights reserved</p>" + "<i>x</i>" * r.randint(0, 2) + "</body></html>"


def test_templates_equal_whole_vectors(spark):
    r = random.Random(5)
    hosts = {}
    for h in range(12):
        pages = [a_page(r, k) for k in range(r.choice([3, 8, 20, 40]))]
        hosts[f"h{h}"] = pages + r.choices(pages, k=len(pages) // 2)
    rows = [(h, page) for h, pages in hosts.items() for page in pages]
    found = {t.host: t for t in templates(spark.createDataFrame(rows, "host string, html string").repartition(7)).collect()}
    for h, pages in hosts.items():
        expected = brute(pages)
        assert (h in found) == bool(expected and expected[1])
        if h in found:
            t = found[h]
            assert (set(t.marks), set(t.tags), len(t.texts), set(t.asides)) == expected
