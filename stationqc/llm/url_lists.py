"""Pages judged by their url: rules first, then a block list held as sorted digest arrays.

A list's entries are `host/` (that host and all its subdomains) or `host/path` (that page of that host). Written, a list is a folder of shards by leading bits
of the entries' 64-bit xxhash; a shard has its digests in ascending order, the ends of the entries' strings and the strings themselves. Tasks map the shards
into memory from the shared folder, so a list may be of any size and the machine's page cache holds what is asked for; a batch's keys are probed together
by binary search, and the stored string decides, so digests that collide do no harm. Where the shared folder is in a store that can't be mapped, the same
shards are rows of a table there; keys and shards meet by the shard's number, and a task holds one shard at a time and searches it in the same way.

Null urls and urls without "://" have an empty host and path, which neither a rule nor an entry fits. Repeated rows are judged each; null page_ids are
kept; other columns are left aside. Of a host longer than HOST_LIMIT, more than a name can have, no entry is made. Empty tables give empty results.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.llm.common import read, shared_folder, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules (host, path, verdict); the longest that fits decides. Fixed values.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Words of a host's name that put the host on the query's list. Fixed values.
BLOCK_WORDS = ["ads", "adult", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx"]
HOST_LIMIT = 253
#: Entries of a shard; a task holds one shard while it writes.
SHARD = 250_000
#: Tasks among which the keys of one shard are dealt where shards are rows.
SPLIT = 8
#: The seed of the xxhash64 of Spark.
SEED = 42

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_NAMED = rf"(?s)^(?:.*\.)?((?:[^.]*-)?(?:{'|'.join(BLOCK_WORDS)})(?:-[^.]*)?(?:\..*)?)\z"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


Shard = tuple[np.ndarray, np.ndarray, np.ndarray]


def _opened(data: np.ndarray) -> Shard:
    """A shard's digests in ascending order, the ends of its strings, and the strings."""
    n = int(data[:8].view(np.int64)[0]) if len(data) else 0
    return data[8 : 8 + 8 * n].view(np.int64), data[8 + 8 * n : 8 + 16 * n].view(np.int64), data[8 + 16 * n :]


def _in_shard(shard: Shard, keys: list[bytes], digests: np.ndarray) -> np.ndarray:
    """Which keys the shard has: binary search of their digests, then the stored strings."""
    stored, ends, strings = shard
    found = np.zeros(len(keys), bool)
    at = np.searchsorted(stored, digests)
    hits = np.flatnonzero((at < len(stored)) & (stored[np.minimum(at, len(stored) - 1)] == digests)) if len(stored) else []
    for i in hits:
        k = int(at[i])
        while k < len(stored) and stored[k] == digests[i]:
            if strings[ends[k - 1] if k else 0 : ends[k]].tobytes() == keys[i]:
                found[i] = True
                break
            k += 1
    return found


class UrlList:
    """A written list: its folder and the number of leading bits that tell shards apart."""

    def __init__(self, folder: str, bits: int):
        self.folder, self.bits, self.shards = folder, bits, {}

    def __reduce__(self):
        return UrlList, (self.folder, self.bits)

    def _shard(self, number: int) -> Shard:
        if number not in self.shards:
            path = _file(self.folder, number)
            self.shards[number] = _opened(np.memmap(path, np.uint8, "r") if os.path.exists(path) else np.empty(0, np.uint8))
        return self.shards[number]

    def listed(self, keys: list[bytes], digests: np.ndarray) -> np.ndarray:
        """Which keys the list has."""
        found = np.zeros(len(keys), bool)
        order = np.argsort(digests, kind="stable")
        numbers = _shard_number(digests[order], self.bits)
        bounds = np.flatnonzero(np.diff(numbers, prepend=-1, append=-1)) if len(keys) else np.empty(0, int)
        for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
            asked = order[start:stop]
            found[asked] = _in_shard(self._shard(int(numbers[start])), [keys[i] for i in asked], digests[asked])
        return found


class StoredList:
    """A written list in a store that tasks can't map: a table of its shards (shard, data), a row each."""

    def __init__(self, table: DataFrame, bits: int):
        self.table, self.bits = table, bits


def _file(folder: str, number: int) -> str:
    return f"{folder}/{number:08d}.digests"


def _shard_number(digests: np.ndarray, bits: int) -> np.ndarray:
    return (digests >> (64 - bits)) + (1 << (bits - 1)) if bits else np.zeros(len(digests), np.int64)


def _mapped(folder: str) -> str | None:
    """The folder as tasks open it; None if it is in a store that is not mounted."""
    place = urlparse(folder)
    return place.path if place.scheme in ("", "file") else None


def write_list(entries: DataFrame, shard: int = SHARD) -> UrlList | StoredList:
    """The entries (key: string) as a list of sorted shards in the shared folder: files that tasks map, or a table's rows where they can't."""
    spark = entries.sparkSession
    keyed = written(entries.filter("key is not null").select("key").distinct().withColumn("digest", F.xxhash64("key")))
    folder = _mapped(shared_folder(spark))
    bits = max(0, (keyed.count() - 1) // shard).bit_length()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                if waiting and start < stop and waiting[-1].column("shard")[-1].as_py() != numbers[start]:
                    yield _write_shard(folder, waiting)
                    waiting = []
                if start < stop:
                    waiting.append(batch.slice(start, stop - start))
        if waiting:
            yield _write_shard(folder, waiting)

    shards = keyed.withColumn("shard", _number("digest", bits)).repartition(1 << bits, "shard").sortWithinPartitions("shard", "digest", "key")
    if folder is None:
        return StoredList(written(shards.mapInArrow(write, "shard long, data binary")), bits)
    # The sum asks for every task's answer; shards that a repeated task writes anew have the same bytes.
    shards.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return UrlList(folder, bits)


def _number(digest: str, bits: int) -> Column:
    """As :func:`_shard_number`."""
    return F.shiftright(digest, 64 - bits) + (1 << (bits - 1)) if bits else F.lit(0).cast("long")


def _write_shard(folder: str | None, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The shard into its file, or without a folder as a row (shard, data)."""
    rows = pa.Table.from_batches(batches)
    keys = [k.encode() for k in rows.column("key").to_pylist()]
    number = rows.column("shard")[0].as_py()
    parts = [np.int64(len(keys)).tobytes(), rows.column("digest").to_numpy().tobytes(), np.cumsum([len(k) for k in keys], dtype=np.int64).tobytes(), *keys]
    if folder is None:
        return pa.record_batch([pa.array([number], pa.int64()), pa.array([b"".join(parts)], pa.binary())], names=["shard", "data"])
    path = _file(folder, number)
    os.makedirs(folder, exist_ok=True)
    attempt = f"{path}.{TaskContext.get().taskAttemptId()}"
    with open(attempt, "wb") as out:
        out.writelines(parts)
    os.replace(attempt, path)
    return pa.record_batch([pa.array([len(keys)], pa.int64())], names=["n"])


def named_hosts(pages: DataFrame) -> DataFrame:
    """Entries (key) for hosts of pages (url) that have one of BLOCK_WORDS in their name, from the label with that word on."""
    host = host_of(F.col("url"))
    entry = F.when(F.length(host) <= HOST_LIMIT, F.regexp_extract(host, _NAMED, 1))
    return pages.select(entry.alias("entry")).filter("entry <> ''").distinct().select(F.concat("entry", F.lit("/")).alias("key"))


def _keys(host: str, path: str) -> list[str]:
    """What a list may have of a page: its host, each parent of the host, and the page itself. No entry of a host is longer than HOST_LIMIT."""
    if not host:
        return []
    parts = host.split(".")
    parents, size = [], -1
    for i in reversed(range(len(parts))):
        size += len(parts[i]) + 1
        if size > HOST_LIMIT:
            break
        parents.append(".".join(parts[i:]) + "/")
    return parents + [host + path] * (path not in ("", "/"))


def with_listed(rows: DataFrame, blocked: UrlList | StoredList) -> DataFrame:
    """rows (page_id, host, path, rule) plus `listed`: the list has the page, its host or a parent of it."""
    if isinstance(blocked, StoredList):
        return _searched(rows, blocked)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            places: dict[str, int] = {}
            asked, ends = [], []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                asked += [places.setdefault(key, len(places)) for key in _keys(host, path)]
                ends.append(len(asked))
            keys = [key.encode() for key in places]
            digests = np.fromiter((xxhash.xxh64_intdigest(k, SEED) for k in keys), np.uint64, len(keys)).view(np.int64)
            hits = np.concatenate([[0], np.cumsum(blocked.listed(keys, digests)[np.array(asked, int)], dtype=int)])
            ends = np.array(ends, int)
            listed = np.diff(hits[ends], prepend=0) > 0
            yield pa.record_batch([*batch.columns, pa.array(listed)], names=[*batch.schema.names, "listed"])

    return rows.mapInArrow(probe, "page_id long, host string, path string, rule struct<rule:string,verdict:string>, listed boolean")


def _searched(rows: DataFrame, blocked: StoredList) -> DataFrame:
    """The same where shards come as rows: each key is asked once, of its shard; a shard goes to SPLIT tasks, among which its keys are dealt."""
    numbered = written(rows.withColumn("keys", F.udf(_keys, "array<string>", useArrow=True)("host", "path")).withColumn("row", F.monotonically_increasing_id()))
    asked = numbered.select(F.explode("keys").alias("key")).distinct().withColumn("digest", F.xxhash64("key"))
    part = F.pmod("digest", F.lit(SPLIT)).alias("part")
    asked = asked.select(_number("digest", blocked.bits).alias("shard"), part, "key", "digest", F.lit(None).cast("binary").alias("data"))
    none = [F.lit(None).cast("string").alias("key"), F.lit(None).cast("long").alias("digest")]
    shards = blocked.table.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPLIT - 1).cast("long"))).alias("part"), *none, "data")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, _opened(np.empty(0, np.uint8))
        for batch in batches:
            numbers, data, digests = batch.column("shard").to_numpy(), batch.column("data"), batch.column("digest").fill_null(0).to_numpy()
            cuts = np.unique([0, *(np.flatnonzero(np.diff(numbers)) + 1), *np.flatnonzero(data.is_valid()), *(np.flatnonzero(data.is_valid()) + 1), batch.num_rows])
            for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if data[start].is_valid:
                    held, shard = numbers[start], _opened(np.frombuffer(data[start].as_py(), np.uint8))
                elif held == numbers[start]:
                    keys = batch.column("key").slice(start, stop - start)
                    found = _in_shard(shard, [k.encode() for k in keys.to_pylist()], digests[start:stop])
                    yield pa.record_batch([keys.filter(pa.array(found))], names=["key"])

    # A shard comes before the keys that are looked up in it.
    met = shards.unionByName(asked).repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("data").isNull())
    found = met.mapInArrow(search, "key string")
    hit = numbered.select("row", F.explode("keys").alias("key")).join(found, "key", "left_semi").select("row").distinct()
    return numbered.join(hit.withColumn("hit", F.lit(True)), "row", "left").select("page_id", "host", "path", "rule", F.coalesce("hit", F.lit(False)).alias("listed"))


def judged(pages: DataFrame, blocked: UrlList | StoredList, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict (allow or block) of pages (page_id, url)."""
    rows = pages.select(F.col("page_id").cast("long"), host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path"))
    rows = rows.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("rule"))
    verdict = F.coalesce("rule.verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return with_listed(rows, blocked).select("page_id", "host", "path", verdict.alias("verdict"), F.col("rule.rule").alias("rule"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    return judged(pages, write_list(named_hosts(pages))).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    cases = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in cases]
    rule = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)
    verdict = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    return rf"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(coalesce(url, ''), '{_URL}', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '{_URL}', 2) AS path FROM pages),
entries AS (
  SELECT DISTINCT entry FROM (SELECT regexp_extract(host, '{_NAMED}', 1) AS entry FROM u WHERE length(host) <= {HOST_LIMIT}) WHERE entry <> ''),
parents AS (
  SELECT rid, array_to_string(parts[i:], '.') AS parent
  FROM (SELECT rid, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT rid, string_split(host, '.') AS parts FROM u))),
hit AS (SELECT DISTINCT rid FROM parents JOIN entries ON parent = entry)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN hit.rid IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM u LEFT JOIN hit USING (rid)
"""


ORACLE_SQL = _oracle()
