"""Verdicts on urls from host and path rules held in a sorted digest array.

A rule is a host and a path prefix. It fits its host and every subdomain when the
url's path starts with its path; the longest fitting rule wins, block before allow
among equals. Rules are stored as sorted 64-bit xxhash digests with their strings
beside them. Tasks map the array into memory, look all candidate keys of a batch up
by one vectorised binary search and compare the stored string of each hit, so that
colliding digests change nothing.

Nulls, urls without ``://`` and urls without host or path get empty parts, which no
rule fits, and the default verdict. Rules with a null part are left out. Repeated
urls are judged alike; an empty table gives an empty result; other columns pass
through, except that ``host``, ``path``, ``rule`` and ``verdict`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doselake.llm.common import Mapped, shielded

SEED = 42
#: Rules of one array; longer lists are probed as several arrays, one after the other.
ARRAY_RULES = 500_000
#: Between the host and the path of a stored key, and around its verdict.
CUT = "\x00"


@dataclass
class DigestArray:
    """Sorted digests, then offsets, then the keys as text; mapped where it is used."""

    blob: bytes
    n: int
    n_hosts: int
    lengths: tuple[int, ...]
    _mapped: Mapped | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_mapped": None}

    @classmethod
    def build(cls, rules: list[tuple[str, str, str]]) -> DigestArray:
        keys = sorted(
            (digest(host + CUT + path), f"{host}{CUT}{path}{CUT}{verdict}".encode())
            for host, path, verdict in rules
        )
        hosts = sorted({digest(host) for host, _, _ in rules})
        offsets = np.zeros(len(keys) + 1, np.int64)
        np.cumsum([len(k) for _, k in keys], out=offsets[1:])
        blob = b"".join(
            [
                np.array([d for d, _ in keys], np.uint64).tobytes(),
                np.array(hosts, np.uint64).tobytes(),
                offsets.tobytes(),
                *(k for _, k in keys),
            ]
        )
        return cls(blob, len(keys), len(hosts), tuple(sorted({len(p) for _, p, _ in rules})))

    def open(self) -> DigestArray:
        if self._mapped is None:
            self._mapped = Mapped(self.blob)
            view, at = self._mapped.view, 0
            self.digests = np.frombuffer(view, np.uint64, self.n, at)
            self.hosts = np.frombuffer(view, np.uint64, self.n_hosts, at := at + 8 * self.n)
            self.offsets = np.frombuffer(view, np.int64, self.n + 1, at := at + 8 * self.n_hosts)
            self.keys = view[at + 8 * (self.n + 1) :]
        return self

    def key(self, i: int) -> tuple[str, str, str]:
        raw = bytes(self.keys[self.offsets[i] : self.offsets[i + 1]])
        host, path, verdict = raw.decode().split(CUT)
        return host, path, verdict

    def longest(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str, str] | None]:
        """The longest fitting rule of each host and path, or None."""
        spots, tails = [], []
        for row, host in enumerate(hosts):
            while host:
                spots.append(row)
                tails.append(host)
                host = host.partition(".")[2]
        near = among(self.hosts, np.fromiter(map(digest, tails), np.uint64, len(tails)))
        rows, keys = [], []
        for i in np.flatnonzero(near):
            row, path = spots[i], paths[spots[i]]
            for length in self.lengths:
                if length <= len(path):
                    rows.append(row)
                    keys.append(tails[i] + CUT + path[:length])
        wanted = np.fromiter(map(digest, keys), np.uint64, len(keys))
        first = np.searchsorted(self.digests, wanted, "left")
        last = np.searchsorted(self.digests, wanted, "right")
        best: list[tuple[str, str, str] | None] = [None] * len(hosts)
        for i in np.flatnonzero(last > first):
            for at in range(first[i], last[i]):
                found = self.key(at)
                if found[0] + CUT + found[1] == keys[i]:
                    best[rows[i]] = stronger(best[rows[i]], found)
        return best


def digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "replace"), SEED)


def among(sorted_digests: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_digests, wanted)
    return (at < len(sorted_digests)) & (
        sorted_digests[np.minimum(at, max(0, len(sorted_digests) - 1))] == wanted
        if len(sorted_digests)
        else False
    )


def rank(rule: tuple[str, str, str]) -> tuple:
    """Longer first; among equals the longer host, then block before allow."""
    host, path, verdict = rule
    return len(host) + len(path), len(host), verdict == "block"


def stronger(a, b):
    return a if b is None or a is not None and rank(a) >= rank(b) else b


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host and path columns: after the first ``://`` up to ``/ ? #``, then up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def digest_arrays(rules: DataFrame, most: int = ARRAY_RULES) -> Iterator[DigestArray]:
    """Arrays of at most ``most`` rules each, read off the rules table one after the other."""
    part: list[tuple[str, str, str]] = []
    for r in rules.select("host", "path", "verdict").dropna().distinct().toLocalIterator():
        part.append((r[0], r[1], r[2]))
        if len(part) == most:
            yield DigestArray.build(part)
            part = []
    if part:
        yield DigestArray.build(part)


@shielded("url", made=("host", "path", "rule", "verdict"))
def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``."""
    host, path = url_parts(url)
    out = pages.withColumns({"host": host, "path": path})
    out = out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    out = out.withColumn("_cut", F.lit(0))
    for array in digest_arrays(rules):
        out = probed(out, array)
    return out.drop("_cut")


def probed(judged: DataFrame, array: DigestArray) -> DataFrame:
    """``judged`` after the rules of one more array; a stronger earlier rule stays.

    ``_cut`` is the length of the host in ``rule``.
    """
    shared = judged.sparkSession.sparkContext.broadcast(array)
    schema = judged.schema

    def judge(batches):
        store = shared.value.open()
        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            hosts, paths, rules, verdicts, cuts = (
                cols[n].to_pylist() for n in ("host", "path", "rule", "verdict", "_cut")
            )
            for i, found in enumerate(store.longest(hosts, paths)):
                if found is None:
                    continue
                cut = cuts[i]
                old = (rules[i][:cut], rules[i][cut:], verdicts[i]) if rules[i] else None
                host, path, verdicts[i] = stronger(old, found)
                rules[i], cuts[i] = host + path, len(host)
            cols["_cut"] = pa.array(cuts, pa.int32())
            cols["rule"] = pa.array(rules, pa.string())
            cols["verdict"] = pa.array(verdicts, pa.string())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return judged.mapInArrow(judge, schema)
