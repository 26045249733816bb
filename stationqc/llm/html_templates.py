"""Main text of pages by deducing each host's template from equivalence classes of tokens.

Tokens are tags with their path of open tags, and texts between tags with theirs. A path has the names of its tags and those of their ids, classes and
roles (marks) that MARK_SHARE of the host's pages have, so that a page's own mark (`postid-7`) does not make tokens of its own. A token's occurrence vector over
the pages of a host is known by sums over the pages of page hash times count: such sums combine before they are moved, so no page list of a host is ever in
one place. Pages of a host with the same main part count as one page, however many copies there are: a token of theirs counts as often as on the copy that
has most of it. Tokens with the same vector are an equivalence class; it is valid if it has a tag, is frequent in its host, and is nested, that
is, all tags around it are in valid classes too. The valid classes of a host, outermost first, are its template. A host may have several types of pages:
a class is frequent from LEAST_SHARE of the host's pages on, and its vector says of which; texts in the main part ask for MAIN_SHARE.

What a page has beside the template is in its slots. A slot's text is taken if it lies in the page's main part (an article or main element, or
else the body), outside of elements that stand for menus, headers, footers, sidebars, notices, adverts, forms or comments, and is not itself a text of
the template. Words of class and id that may as well name a subject (DOUBTFUL: `share`, `search`, `notice`) only count inside an article if the element is one of
the template, or if it holds a form or mostly links. A class is on at least LEAST_PAGES different pages, so hosts with fewer have no template: there the elements
alone decide.

Null html is empty, a null url is a host without template. Pages that repeat are extracted each; unclosed tags and pages that break off are read as far
as they go. Extra columns are ignored; an empty table gives an empty result. Time and memory are linear in the longest page, however deep, and memory in a
host's template.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.llm import tokens
from stationqc.llm.common import read, written

#: Pages with different main parts that a class must be on, and their share of all such pages of the host; the share for texts in main parts, and for marks.
LEAST_PAGES = 5
LEAST_SHARE = 0.1
MAIN_SHARE = 0.5
MARK_SHARE = 0.2
#: Template texts, in bytes, up to which all templates are given to every task; beyond, pages and templates are joined by host.
SMALL = 16 << 20
#: Bits of the filter of main parts that several pages may have, whatever their number.
FILTER_BITS = 1 << 23

# Fixed values of HTML: elements without content, with raw content, that stand in blocks of their own, and that end an open one of the same kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li"
    " main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements whose start ends an open paragraph.
ENDS_PARAGRAPH = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "option"}

#: Elements, and words in class, id or role, that are not part of the main text.
ASIDE = frozenset("head title nav footer aside form button select input label menu dialog".split())
ASIDE_WORDS = re.compile(
    r"(?<![^\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comment\w*|consent|cookies?|disclaimer|footer|header|login|masthead|menu|modal|nav\w*|newsletter|notices?|notification"
    r"|pagination|popup|promo\w*|related|replies|reply|respond|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?![^\s_-])",
    re.IGNORECASE,
)
#: Those of them that inside an article may name its subject.
DOUBTFUL = frozenset("banner consent disclaimer login menu notice notices notification promo related search share sharing social subscribe widget".split())
#: Elements that make a doubtful one a form.
CONTROLS = frozenset("form input select button textarea".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
_MARK = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) >> 1


@lru_cache(1 << 12)
def _aside_words(label: str) -> tuple[str, ...]:
    return tuple(w.lower() for w in ASIDE_WORDS.findall(label))


class Element:
    """An open tag: its name, path, and whether text in it can be main text.

    `doubt` is the nearest element, itself or around it, whose words are doubtful; such an element sums up what it holds.
    """

    __slots__ = ("name", "path", "parent", "depth", "marks", "main", "aside", "doubt", "outer", "link", "chars", "linked", "controls", "gone")

    def __init__(self, name: str, id: str, classes: str, role: str, parent: Element | None, shared: frozenset[int]):
        self.name = name
        self.marks = [_hash(kind, w) for kind, words in (("#", [id] if id else ()), (".", classes.split()), ("@", role.split())) for w in words]
        role = role.lower()
        # A header inside the main part holds the article's own title; elsewhere it is the site's.
        inside = bool(parent and parent.main)
        main = name in ("article", "main") or role == "main"
        self.main = inside or main
        label = " ".join(x for x in (id, classes, role) if x)
        words = _aside_words(label) if label and name not in ("html", "body", "article", "main") and role != "main" else ()
        header = name == "header" or bool(words) and words[0] == "header"
        doubtful = inside and not header and bool(words) and name not in ASIDE and DOUBTFUL.issuperset(words)
        self.aside = bool(parent and parent.aside) or (not inside if header else name in ASIDE or bool(words) and not doubtful)
        self.outer = parent.doubt if parent else None
        self.doubt = self if doubtful else self.outer
        self.link = name == "a" or bool(parent and parent.link)
        self.chars = self.linked = 0
        self.controls = self.gone = False
        # Whether it is main or doubtful is part of the path, also where the mark that says so is not shared.
        known = [f"{m}" for m in self.marks if m in shared] + (["main"] if main else []) + ([f"doubtful {w}" for w in words] if doubtful else [])
        self.parent, self.depth = (parent.path, parent.depth + 1) if parent else (0, 0)
        self.path = _hash(f"{self.parent}", name, *known)


class _Stack:
    """The open elements, where those of each name stand, and where scopes begin that an implied end does not leave."""

    SCOPES = frozenset("ul ol dl table select div section article main body".split())

    def __init__(self) -> None:
        self.open: list[Element] = []
        self.named: defaultdict[str, list[int]] = defaultdict(list)
        self.scopes: list[int] = []

    def top(self) -> Element | None:
        return self.open[-1] if self.open else None

    def push(self, element: Element) -> None:
        self.named[element.name].append(len(self.open))
        if element.name in self.SCOPES:
            self.scopes.append(len(self.open))
        self.open.append(element)

    def pop(self, index: int) -> bool:
        """Ends the elements from the index on; whether one of them is a block."""
        broke = False
        while len(self.open) > index:
            element = self.open.pop()
            self.named[element.name].pop()
            if element.name in self.SCOPES:
                self.scopes.pop()
            broke = broke or element.name in BLOCK
        return broke

    def innermost(self, name: str) -> int | None:
        at = self.named.get(name)
        return at[-1] if at else None

    def implied(self, names: Iterable[str]) -> int | None:
        """The outermost element of such a name within the nearest scope."""
        scope = self.scopes[-1] if self.scopes else -1
        first = [at[k] for name in names if (at := self.named.get(name)) and (k := bisect_right(at, scope)) < len(at)]
        return min(first, default=None)


def events(page: str, shared: frozenset[int] = frozenset()) -> Iterator[tuple[str, Element | None, str]]:
    """("tag", element, name) where an element begins, ("text", element, text) and ("break", None, "") at the bounds of blocks, in page order."""
    stack = _Stack()
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        upto = m.start() if m else len(page)
        if upto > at:
            yield "text", stack.top(), page[at:upto]
        if not m:
            return
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            index = stack.innermost(name)
            if index is not None and stack.pop(index):
                yield "break", None, ""
            continue
        index = stack.implied(CLOSES.get(name, ("p",) if name in ENDS_PARAGRAPH else ()))
        if index is not None:
            stack.pop(index)
        if name in BLOCK:
            yield "break", None, ""
        found = {k.lower(): (a or b or c).strip() for k, a, b, c in _MARK.findall(m[3])} if m[3] else {}
        element = Element(name, found.get("id", ""), found.get("class", ""), found.get("role", ""), stack.top(), shared)
        yield "tag", element, name
        if name in RAW and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif name == "br":
            yield "text", stack.top(), " "
        elif name not in VOID and not m[3].endswith("/"):
            stack.push(element)


def blocks(page: str, template: frozenset[int] = frozenset(), shared: frozenset[int] = frozenset()) -> list[str]:
    """The texts of the slots of the main part, by block; the template has hashes of its texts and of the paths of its doubtful elements."""
    return _blocks(list(events(page, shared)), template)


def _judge(found: list[tuple[str, Element | None, str]], template: frozenset[int]) -> None:
    """Sets `gone` of the doubtful elements that are no main text."""
    doubtful = [e for kind, e, _ in found if kind == "tag" and e.doubt is e]
    if not doubtful:
        return
    for kind, element, value in found:
        inner = element.doubt if element else None
        if inner is None:
            continue
        if kind == "text":
            n = len(value) - value.count(" ")
            inner.chars += n
            inner.linked += n * element.link
        elif element.name in CONTROLS:
            inner.controls = True
    for e in reversed(doubtful):  # inner ones first: what they hold is held by those around them too
        if e.outer:
            e.outer.chars += e.chars
            e.outer.linked += e.linked
            e.outer.controls |= e.controls
    for e in doubtful:
        e.gone = bool(e.outer and e.outer.gone) or e.controls or 2 * e.linked > e.chars or e.path in template


def _blocks(found: list[tuple[str, Element | None, str]], template: frozenset[int] = frozenset()) -> list[str]:
    _judge(found, template)
    every: list[tuple[bool, str]] = []
    parts: list[str] = []
    main = False

    def end() -> None:
        nonlocal main
        block = " ".join("".join(parts).split())
        if block:
            every.append((main, block))
        parts.clear()
        main = False

    for kind, element, value in found:
        if kind == "break":
            end()
        elif kind == "text" and not (element and (element.aside or element.doubt and element.doubt.gone)):
            decoded = html.unescape(value)
            if decoded.strip() and element and template and _hash(f"{element.path}", " ".join(decoded.split())) in template:
                continue
            main = main or bool(element and element.main and decoded.strip())
            parts.append(decoded)
    end()
    inside = [block for is_main, block in every if is_main]
    return inside or [block for _, block in every]


def _page_tokens(found: Iterable[tuple[str, Element | None, str]]) -> tuple[Counter, dict[int, tuple]]:
    """Counts of a page's tokens; of each token the tag it stands in (itself, of a tag), that tag's parent and depth, whether it is in the main part and is doubtful, and its
    first position."""
    seen: Counter = Counter()
    about: dict[int, tuple] = {}
    for position, (kind, element, value) in enumerate(found):
        if kind == "tag":
            token = element.path
        elif kind == "text" and element and (content := " ".join(html.unescape(value).split())):
            token = _hash(f"{element.path}", content)
        else:
            continue
        seen[token] += 1
        if token not in about:
            about[token] = (element.path, element.parent, element.depth, element.main, element.doubt is element, position)
    return seen, about


def _main_part(found: list[tuple[str, Element | None, str]]) -> int:
    return _hash(*_blocks(found))


_MAINS = pa.schema([("host", pa.string()), ("main", pa.int64()), ("marks", pa.list_(pa.int64()))])
_ABOUT = [("tag", pa.int64()), ("parent", pa.int64()), ("depth", pa.int64()), ("inside", pa.bool_()), ("doubtful", pa.bool_())]
_SUMS = ["n", "v1", "v2", "pages", "position"]
_TOKENS = pa.schema([("host", pa.string()), ("token", pa.int64()), ("main", pa.int64()), *_ABOUT, *[(c, pa.int64()) for c in _SUMS]])
_TOKENS_SQL = "host string, token long, main long, tag long, parent long, depth long, inside boolean, doubtful boolean, n long, v1 long, v2 long, pages long, position long"


def _mains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The host, main part and different marks of each page."""
    for batch in batches:
        for part in tokens.slices(batch, "html"):
            mains, marks = [], []
            for page in part.column("html").to_pylist():
                found = list(events(page or ""))
                mains.append(_main_part(found))
                marks.append(sorted({m for kind, e, _ in found if kind == "tag" for m in e.marks}))
            yield pa.record_batch([part.column("host"), pa.array(mains, pa.int64()), pa.array(marks, pa.list_(pa.int64()))], schema=_MAINS)


def _occurrences(bitmap: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part of a split, host and token: counts, both sums of the occurrence vector, pages and summed first positions.

    Rows of main parts that other pages may have too are by main part: of such pages the largest count and the first position.
    """
    bits = np.frombuffer(bitmap, np.uint8)
    for batch in batches:
        for part in tokens.slices(batch, "html"):
            sums: dict[tuple[str, int, int | None], tuple[tuple, list]] = {}
            for host, page, marks in zip(*(part.column(c).to_pylist() for c in ("host", "html", "marks")), strict=True):
                found = list(events(page or "", frozenset(marks)))
                seen, about = _page_tokens(found)
                main = _main_part(found)
                slot = main & (FILTER_BITS - 1)
                shared = main if bits[slot >> 3] >> (slot & 7) & 1 else None
                of_page = xxhash.xxh3_64_intdigest(f"{main}")
                for token, n in seen.items():
                    *tag, position = about[token]
                    # Two sums of 31-bit hashes: exact in 64 bits for two billion occurrences.
                    values = [n, (of_page & 0x7FFFFFFF) * n, (of_page >> 33) * n, 1, position]
                    row = sums.get((host, token, shared))
                    if row is None:
                        sums[host, token, shared] = (tag, values)
                    elif shared is None:
                        row[1][:] = [a + b for a, b in zip(row[1], values, strict=True)]
                    else:
                        row[1][:] = [*map(max, row[1][:4], values[:4]), min(row[1][4], position)]
            rows = [(*key, *tag, *values) for key, (tag, values) in sums.items()]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _TOKENS, strict=True)] if rows else [pa.array([], f.type) for f in _TOKENS], schema=_TOKENS)


def _nested(host: pd.DataFrame) -> pd.DataFrame:
    """The valid classes of a host: with a tag, and all tags around its own valid, from the outermost inwards."""
    is_tag = host["token"] == host["tag"]
    host = host.assign(is_tag=is_tag, depth=host["depth"].where(is_tag, 1 << 60))
    valid_tags: set[int] = set()
    valid = []
    classes = [(c["depth"].min(), c["position"].min(), c) for _, c in host.groupby(["v1", "v2", "n"], sort=True)]
    for _, _, c in sorted(classes, key=lambda x: x[:2]):
        tags = c[c["is_tag"]]  # a tag stands for two tokens, where it begins and where it ends
        own = set(tags["token"])
        around = set(tags["parent"]) - own - {0}
        if own and around <= valid_tags:
            valid_tags |= own
            valid.append(c)
    if not valid:
        return pd.DataFrame({"host": [], "tags": [], "texts": [], "asides": []}, dtype=object)
    every = pd.concat(valid)
    # A text is the template's if its vector is that of tags and it stands within the template.
    texts = every.loc[~every["is_tag"] & every["tag"].isin(valid_tags), "token"]
    asides = every.loc[every["is_tag"] & every["doubtful"], "token"]
    return pd.DataFrame({"host": [host["host"].iloc[0]], "tags": [sorted(valid_tags)], "texts": [sorted(texts)], "asides": [sorted(asides)]})


def _given(pages: DataFrame, by_host: DataFrame, size: Column, how: str) -> DataFrame:
    """Pages with the columns of their host: given to all tasks up to SMALL bytes, else joined."""
    total = by_host.agg(F.sum(F.length("host") + size)).first()[0] or 0
    return pages.join(F.broadcast(by_host) if total <= SMALL else by_host, "host", how)


def templates(pages: DataFrame) -> DataFrame:
    """(host, marks, tags, texts, asides) of pages (host, html): hashes of the marks that paths have, of the paths of the template's tags, of its texts, and of the paths of
    those of its tags that are doubtful. Hosts without a template have no row."""
    pages = pages.filter("host <> ''")
    mains = pages.mapInArrow(_mains, "host string, main long, marks array<long>").groupBy("host", "main")
    mains = written(mains.agg(F.count("*").alias("copies"), F.first("marks").alias("marks")))
    sizes = mains.groupBy("host").agg(F.count("*").alias("host_pages")).filter(F.col("host_pages") >= LEAST_PAGES)
    marks = mains.select("host", F.explode("marks").alias("mark")).groupBy("host", "mark").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_PAGES)
    # Each page has few marks, so few can be on a share of the pages, whatever the size of the host.
    marks = marks.join(sizes, "host").filter(F.col("n") >= F.col("host_pages") * MARK_SHARE).groupBy("host").agg(F.sort_array(F.collect_list("mark")).alias("marks"))
    hosts = written(sizes.join(marks, "host", "left").select("host", "host_pages", F.coalesce("marks", F.array().cast("array<long>")).alias("marks")))
    slots = mains.filter("copies > 1").select(F.col("main").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("slot"))
    words = slots.groupBy(F.expr("cast(slot div 32 as int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 as int)))").alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 32, "<u4")
    for word, bits in words.collect():  # FILTER_BITS / 32 rows at most
        bitmap[word] = bits

    pages = _given(pages, hosts.select("host", "marks"), F.size("marks") * 8, "inner")
    occurrences = pages.select("host", "html", "marks").mapInArrow(partial(_occurrences, bitmap.tobytes()), _TOKENS_SQL)
    about = [F.first(c).alias(c) for c, _ in _ABOUT]
    # Of rows without a main part each stands for other pages, of those with one all stand for one page.
    once = [F.when(F.col("main").isNull(), F.sum(c)).otherwise((F.min if c == "position" else F.max)(c)).alias(c) for c in _SUMS]
    found = occurrences.groupBy("host", "token", "main").agg(*about, *once)
    found = found.groupBy("host", "token").agg(*about, *[F.sum(c).alias(c) for c in _SUMS])
    # No token on fewer pages can be in a template; most content goes here.
    found = found.filter(F.col("pages") >= LEAST_PAGES)
    share = F.when(F.col("inside") & (F.col("token") != F.col("tag")), MAIN_SHARE).otherwise(LEAST_SHARE)
    common = found.join(hosts.select("host", "host_pages"), "host").filter(F.col("pages") >= F.col("host_pages") * share)
    common = common.withColumn("position", F.col("position") / F.col("pages")).drop("pages", "host_pages", "inside")
    nested = common.groupBy("host").applyInPandas(_nested, "host string, tags array<long>, texts array<long>, asides array<long>")
    return nested.join(hosts.select("host", "marks"), "host").select("host", "marks", "tags", "texts", "asides")


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(found)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of pages (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("host"))
    found = written(templates(pages.select("host", "html"))).select("host", "marks", F.concat("texts", "asides").alias("template")).filter("size(template) > 0")
    joined = _given(pages, found, (F.size("template") + F.size("marks")) * 8, "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[frozenset[int], frozenset[int]]] = {}
        for batch in batches:
            for part in tokens.slices(batch, "html"):
                found = []
                for name, page, template, marks in zip(*(part.column(c).to_pylist() for c in ("host", "html", "template", "marks")), strict=True):
                    if len(known) > 1000:
                        known.clear()
                    of_host = known.setdefault(name, (frozenset(template or ()), frozenset(marks or ())))
                    found.append("\n".join(blocks(page, *of_host)))
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "host", "html", "template", "marks").mapInArrow(extract, "page_id long, url string, text string, n_chars long")


def op1_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read(spark, sf_dir, "pages", "page_id", "url", "html"))
