"""URL filtering by a Bloom filter cascade.

A rule is a key ``host/path``.  It fits a url whose host is the rule's host or one of its
subdomains and whose path starts with the rule's path.  The keys a url could match are its host
suffixes combined with its path prefixes; the set of all such keys over the corpus is the
cascade's *universe*.

Level 1 is a Bloom filter of the listed keys.  Level 2 is a Bloom filter of the universe's keys
that level 1 admits by mistake, level 3 one of the listed keys that level 2 admits by mistake,
and so on until no mistake is left.  A key's membership is decided by the first level that
refuses it, and that is exact for every key of the universe.  No table of keys is joined.

Size.  Level 1's error rate is chosen from the counts so that about as many universe keys
slip through as there are listed keys; the whole cascade takes O(L log(U/L)) bits for L listed
and U universe keys.  What is broadcast is bounded by the list, not by the corpus, and the
keys that slip through are never collected: only the set bit positions of their filter are,
at most as many as the filter has bits.

Defined results
    null urls and urls without ``://`` have an empty host and path, match no key and are
    allowed; a url without a path has the empty path; of two rules of equal length that fit one
    url, the one of the longer host wins; very long urls are read whole; a null page_id is handed
    on; other columns, whatever their names, are not read; an empty table gives an empty result;
    repeated rows are judged alike.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, through_table

#: (host, path) -> verdict; the longest fitting rule wins.
RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}
#: Host labels that mark unwanted sites; with each of SUFFIXES they make the list of blocked hosts.
BAD_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
SUFFIXES = ("example.com", "example.net", "example.org")
BLOCKED_HOSTS = tuple(f"{label}.{suffix}" for label in BAD_LABELS for suffix in SUFFIXES)

_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path, as the contract defines them."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[stop:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return rest[:stop].translate(_UPPER), path[:end]


def candidate_keys(host: str, path: str, host_lengths: frozenset[int], path_lengths: frozenset[int]) -> Iterator[str]:
    """The keys that a url could match, longest first, of equal ones the longer host.

    Only suffixes and prefixes of a length that some listed key has can be listed; the others
    need no test.
    """
    if not host:
        return
    starts = [0]
    while (dot := host.find(".", starts[-1])) >= 0:
        starts.append(dot + 1)
    hosts = [host[s:] for s in starts if len(host) - s in host_lengths]
    paths = [path[:k] for k in path_lengths if k <= len(path)]
    yield from sorted({h + "\x00" + p for h in hosts for p in paths}, key=lambda k: (-len(k), -k.index("\x00")))


@dataclass
class Bloom:
    bits: int
    hashes: int
    level: int
    data: bytearray = field(repr=False, default_factory=bytearray)

    @classmethod
    def sized(cls, n: int, rate: float, level: int) -> Bloom:
        bits = max(64, math.ceil(-max(n, 1) * math.log(rate) / math.log(2) ** 2))
        hashes = max(1, round(-math.log2(rate)))
        return cls(bits, hashes, level, bytearray((bits + 7) // 8))

    def places(self, key: str) -> list[int]:
        digest = hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16, salt=self.level.to_bytes(4, "little")).digest()
        a, b = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little") | 1
        return [(a + i * b) % self.bits for i in range(self.hashes)]

    def set(self, places: Iterable[int]) -> None:
        for p in places:
            self.data[p >> 3] |= 1 << (p & 7)

    def __contains__(self, key: str) -> bool:
        return all(self.data[p >> 3] & (1 << (p & 7)) for p in self.places(key))


@dataclass
class Cascade:
    levels: list[Bloom]

    def __contains__(self, key: str) -> bool:
        """Decided by the first level that refuses the key: odd levels speak for the list."""
        for depth, level in enumerate(self.levels):
            if key not in level:
                return depth % 2 == 1
        return len(self.levels) % 2 == 1


def build_cascade(listed: Iterable[str], universe: DataFrame, n_universe: int, name: str) -> Cascade:
    """``universe`` has a column key: every key that will ever be tested (repeats allowed).

    Keys that level 1 admits by mistake are written once and serve all deeper levels.
    """
    inside = sorted(set(listed))
    rate = min(0.5, max(1e-9, len(inside) / max(1.0, n_universe) / math.sqrt(2)))
    first = Bloom.sized(len(inside), rate, 1)
    for key in inside:
        first.set(first.places(key))
    levels = [first]

    def passing(frame: DataFrame, level: Bloom, extra: frozenset[str]) -> DataFrame:
        def run(batches):
            for batch in batches:
                keys = [k for k in dict.fromkeys(batch.column(0).to_pylist()) if k in level and k not in extra]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["key"])

        return frame.select("key").mapInArrow(run, "key string")

    known = frozenset(inside)
    wrong = through_table(passing(universe, first, known).distinct(), f"{name}-wrong")
    while True:
        n_wrong = wrong.count()
        if not n_wrong:
            return Cascade(levels)
        level = Bloom.sized(n_wrong, 0.5 / math.sqrt(2), len(levels) + 1)

        def places(batches, level=level):
            for batch in batches:
                at = sorted({p for k in batch.column(0).to_pylist() for p in level.places(k)})
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], names=["at"])

        level.set(r.at for r in wrong.mapInArrow(places, "at long").distinct().collect())
        levels.append(level)
        inside = [k for k in inside if k in level]
        if not inside:
            return Cascade(levels)
        level = Bloom.sized(len(inside), 0.5, len(levels) + 1)
        for key in inside:
            level.set(level.places(key))
        levels.append(level)
        wrong = passing(wrong, level, frozenset())


def filter_urls(pages: DataFrame, rules: dict[tuple[str, str], str] | None = None, blocked_hosts: Iterable[str] = BLOCKED_HOSTS) -> DataFrame:
    """``pages`` columns page_id and url with host, path, rule, verdict and listed.

    One cascade holds the block rules, one the allow rules, one the blocked hosts.  ``listed``
    says whether the host is on the blocked list; where no rule fits it decides the verdict.
    """
    rules = RULES if rules is None else rules
    spark = pages.sparkSession
    bounded_batches(spark)
    lists = {verdict: [h + "\x00" + p for (h, p), v in rules.items() if v == verdict] for verdict in ("block", "allow")}
    lists["listed"] = [h + "\x00" for h in blocked_hosts]
    host_lengths = frozenset(len(k.split("\x00")[0]) for keys in lists.values() for k in keys)
    path_lengths = frozenset(len(k.split("\x00")[1]) for keys in lists.values() for k in keys)

    def keys_of(batches):
        for batch in batches:
            found = {k for url in batch.column(0).to_pylist() for k in candidate_keys(*split_url(url), host_lengths, path_lengths)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["key"])

    universe = through_table(pages.select("url").mapInArrow(keys_of, "key string").distinct(), "url-keys")
    n = universe.count()
    cascades = {name: build_cascade(keys, universe, n, name) for name, keys in lists.items()}

    def judge(batches):
        for batch in batches:
            out = {"host": [], "path": [], "rule": [], "verdict": [], "listed": []}
            for url in batch.column(batch.schema.get_field_index("url")).to_pylist():
                host, path = split_url(url)
                keys = list(candidate_keys(host, path, host_lengths, path_lengths))
                listed = any(k in cascades["listed"] for k in keys if k.endswith("\x00"))
                rule, verdict = None, "block" if listed else "allow"
                for key in keys:  # longest first
                    which = next((v for v in ("block", "allow") if key in cascades[v]), None)
                    if which:
                        rule, verdict = key.replace("\x00", ""), which
                        break
                for name, value in zip(out, (host, path, rule, verdict, listed), strict=True):
                    out[name].append(value)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")]
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_())
            columns += [pa.array(v, kind) for v, kind in zip(out.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", *out])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url").mapInArrow(judge, f"page_id {kind}, url string, host string, path string, rule string, verdict string, listed boolean")


def filter_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for (h, p), v in RULES.items())
    hosts = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)
    return rf"""
WITH rules(rhost, rpath, verdict) AS (VALUES {rules}), bad(bhost) AS (VALUES {hosts}),
cut AS (SELECT page_id, url, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, url, regexp_extract(rest, '^[^/?#]*') AS h, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
hosts AS (SELECT page_id, url, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts),
best AS (SELECT *, (SELECT max_by(struct_pack(rule := rhost || rpath, verdict := verdict), length(rhost || rpath)) FROM rules
           WHERE (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)) AS r,
           EXISTS (SELECT 1 FROM bad WHERE host = bhost OR host LIKE '%.' || bhost) AS listed FROM hosts)
SELECT page_id, url, host, path, r.rule AS rule, coalesce(r.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM best"""
