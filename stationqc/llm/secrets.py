"""Secret scans with a trigram inverted index.

Each rule's regex yields a Boolean trigram query: alternatives, each a set of trigrams that every match of it contains. Every segment (a
run of rows of an input split) gets an inverted index of the trigrams that some rule asks for; a rule's postings are intersected within an
alternative and united over alternatives, and only the rows left are matched against the regex. A rule without mandatory trigrams is
matched against every row. Index and rows stay in the task that read them: nothing is shuffled, and a lost task is simply run again.

The index folds ASCII letters and works on UTF-8 bytes; spans count code points. Null and empty texts have no spans; repeated rows are
scanned each; an empty table gives an empty result. Memory is bounded by the segment and the longest text.
"""

from __future__ import annotations

import re
import re._constants as op
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.llm import tokens
from stationqc.llm.common import read


@dataclass(frozen=True)
class Rule:
    """A match is kept if the named group has at least `least` characters; its span is the whole match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    ignore_case: bool = False

    @property
    def flags(self) -> int:
        return re.ASCII | (re.IGNORECASE if self.ignore_case else 0)


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further kinds of secrets, with spans of their own.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]+@"),
)
RULES = BASE + MORE
MASK = "[SECRET]"

#: A trigram query in disjunctive form; an alternative without trigrams matches everything.
Query = frozenset[frozenset[str]]
ALL: Query = frozenset({frozenset()})
#: Alternatives and strings that are followed up; more are given up as "anything", which is always right.
MOST = 64


def _query(strings: set[str]) -> Query:
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _least(alternatives: set[frozenset[str]]) -> Query:
    if len(alternatives) > MOST or frozenset() in alternatives:
        return ALL
    return frozenset(a for a in alternatives if not any(b < a for b in alternatives))


def _both(a: Query, b: Query) -> Query:
    return _least({x | y for x in a for y in b})


def _class(items: list) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 8:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _node(kind, value) -> tuple[set[str] | None, Query]:
    """The strings that the node matches if they are few, else a query that holds for each of its matches."""
    if kind is op.LITERAL:
        return {chr(value).lower()}, ALL
    if kind is op.IN:
        return _class(value), ALL
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.AT:
        return {""}, ALL
    if kind is op.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        if all(strings is not None for strings, _ in parts):
            return set().union(*(strings for strings, _ in parts)), ALL
        return None, _least({a for strings, query in parts for a in (_query(strings) if strings is not None else query)})
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, item = value
        strings, query = _sequence(item)
        if strings is not None and high == 1:
            return strings | ({""} if low == 0 else set()), ALL
        if low == 0:
            return None, ALL
        return None, _query(strings) if strings is not None else query
    return None, ALL


def _sequence(items) -> tuple[set[str] | None, Query]:
    run, query, whole = {""}, ALL, True
    for kind, value in items:
        strings, inner = _node(kind, value)
        if strings is not None and len(run) * len(strings) <= MOST:
            run = {a + b for a in run for b in strings}
            continue
        query, run, whole = _both(query, _query(run)), {""}, False
        query = _both(query, inner if strings is None else _query(strings))
    return (run, ALL) if whole else (None, _both(query, _query(run)))


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """Alternatives of which every match of the pattern contains all trigrams of one, letters folded."""
    strings, query = _sequence(parser.parse(pattern, flags))
    query = query if strings is None else _query(strings)
    # Trigrams beyond ASCII would need Unicode folding: rows are not ruled out by them.
    return _least({frozenset(t for t in a if t.isascii()) for a in query})


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.matchers = [re.compile(r.pattern, r.flags) for r in rules]
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        self.vocabulary = sorted({t for q in self.queries for a in q for t in a})
        self.rank = {t: k for k, t in enumerate(self.vocabulary)}
        if len(self.vocabulary) >= 1 << 16:
            raise ValueError("too many trigrams for one index; split the rules")
        self.code = np.zeros(1 << 24, np.uint16)
        for t, k in self.rank.items():
            a, b, c = t.encode()
            self.code[a << 16 | b << 8 | c] = k + 1

    def postings(self, column: pa.Array) -> np.ndarray:
        """The inverted index of a segment as bitmaps: a row per trigram of the vocabulary, a column per text."""
        found = np.zeros((len(self.vocabulary), len(column)), bool)
        column = column.fill_null("").cast(pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        if data is None or ends[-1] - ends[0] < 3:
            return found
        low = np.frombuffer(bytes(data[int(ends[0]) : int(ends[-1])]).lower(), np.uint8).astype(np.uint32)
        hit = self.code[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        at = np.flatnonzero(hit)
        row = np.searchsorted(ends - ends[0], at, "right") - 1
        inside = at + 2 < (ends - ends[0])[row + 1]
        found[hit[at][inside] - 1, row[inside]] = True
        return found

    def candidates(self, query: Query, postings: np.ndarray) -> np.ndarray:
        rows = np.zeros(postings.shape[1], bool)
        for alternative in query:
            rows |= postings[[self.rank[t] for t in alternative]].all(axis=0) if alternative else True
        return np.flatnonzero(rows)

    def spans(self, column: pa.Array) -> list[list[tuple[str, int, int]]]:
        """Per text (kind, start, end) by start, then by the rules' order."""
        postings = self.postings(column)
        texts = column.to_pylist()
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, matcher, query) in enumerate(zip(self.rules, self.matchers, self.queries, strict=True)):
            for row in self.candidates(query, postings):
                for m in matcher.finditer(texts[row] or ""):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[row].append((m.start(), k, m.end()))
        return [[(self.rules[k].kind, start, end) for start, k, end in sorted(spans)] for spans in found]


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (array of kind, start, end) of docs (doc_id, text)."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in scanner.spans(part.column("text"))]
                yield pa.record_batch([part.column("doc_id"), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def masked(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = MASK) -> DataFrame:
    """The same rows and columns; in `text` every span, with those that overlap it, gives way to the mask, and n_chars follows if there is one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                texts = part.column("text").to_pylist()
                changed = {}
                for row, spans in enumerate(scanner.spans(part.column("text"))):
                    if spans:
                        changed[row] = _mask(texts[row], [(a, b) for _, a, b in spans], mask)
                columns = {name: part.column(name) for name in part.schema.names}
                columns["text"] = pa.array([changed.get(k, t) for k, t in enumerate(texts)], pa.string())
                if "n_chars" in columns and changed:
                    counts = columns["n_chars"].to_pylist()
                    columns["n_chars"] = pa.array([len(changed[k]) if k in changed else n for k, n in enumerate(counts)], columns["n_chars"].type)
                yield pa.record_batch(list(columns.values()), names=list(columns))

    return docs.mapInArrow(scan, docs.schema)


def _mask(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    parts, done = [], 0
    for start, end in sorted(spans):
        if start >= done:
            parts += [text[done:start], mask]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scanned(read(spark, sf_dir, "documents", "doc_id", "text"))
    kinds = [r.kind for r in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(F.filter(F.col("spans.kind"), F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in kinds]
    return rows.select("doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
