"""URL rules in a memory-mapped sorted digest array.

A rule is a host and the start of a path. It fits the host and its subdomains
where the url's path starts with the rule's. The index holds the 64-bit
xxhash digests of all rules in ascending order, and beside them the full
strings. A url gives one candidate for each suffix of its host (cut at dots)
and each path length that some rule has; the candidates of a batch are looked
up with one vectorised binary search, and a digest that is found is confirmed
against the stored string. The longest confirmed rule wins.

Rules are indexed in groups of at most GROUP_BYTES, which bounds what is
broadcast and mapped; urls pass all groups one after the other.

A null url, or one without ``://``, has an empty host and path and fits no
rule. Rules with null parts are left out; of equal rules with different
verdicts, block wins. Rows are independent.
"""

from __future__ import annotations

import functools
import os
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, blocks

GROUP_BYTES = 64 << 20
RULE_OVERHEAD = 32  # bytes of a rule beside its string: digest, offset, lengths, verdict
ALLOW, BLOCK = "allow", "block"
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host, A-Z in lower case, and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path_end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return rest[:end].translate(LOWER), rest[end:path_end]


def host_suffixes(host: str, longest: int) -> Iterator[str]:
    """The host and its parent domains, of those only the ones of up to ``longest`` characters."""
    first = len(host) - longest
    if first > 0:
        border = host.find(".", first - 1)
        host = host[border + 1 :] if border >= 0 else ""
    while host:
        yield host
        _, _, host = host.partition(".")


@dataclass
class DigestArray:
    """Sorted digests with their full strings and verdicts, as one file."""

    digests: np.ndarray
    offsets: np.ndarray
    host_length: np.ndarray
    block: np.ndarray
    strings: np.ndarray
    path_lengths: tuple[int, ...]

    @staticmethod
    def pack(rules: Sequence[tuple[str, str, str]]) -> bytes:
        """The file's content: number of rules and of path lengths, then the arrays one after the other."""
        own: dict[tuple[str, str], bool] = {}
        for host, path, verdict in rules:
            own[host, path] = own.get((host, path), False) or verdict == BLOCK
        # The path length keeps host and path apart: no other split of the same characters is the same entry.
        entries = sorted((xxhash.xxh64_intdigest(_entry(h, p)), _entry(h, p), len(h.encode()), b) for (h, p), b in own.items())
        strings = [e[1] for e in entries]
        lengths = sorted({len(p) for _, p in own})
        parts = [
            np.array([len(entries), len(lengths)], np.int64),
            np.array(lengths, np.int64),
            np.array([e[0] for e in entries], np.uint64),
            np.cumsum([0] + [len(s) for s in strings]).astype(np.int64),
            np.array([e[2] for e in entries], np.int64),
            np.array([e[3] for e in entries], np.uint8),
        ]
        return b"".join(p.tobytes() for p in parts) + b"".join(strings)

    @classmethod
    def mapped(cls, path: str) -> DigestArray:
        raw = np.memmap(path, np.uint8, "r")
        n, k = (int(v) for v in raw[:16].view(np.int64))
        at = 16

        def take(count: int, kind: type) -> np.ndarray:
            nonlocal at
            start, at = at, at + count * np.dtype(kind).itemsize
            return raw[start:at].view(kind)

        lengths = tuple(take(k, np.int64).tolist())
        return cls(take(n, np.uint64), take(n + 1, np.int64), take(n, np.int64), take(n, np.uint8), raw[at:], lengths)

    def find(self, candidates: list[bytes]) -> np.ndarray:
        """The index of each candidate's rule, -1 for none."""
        found = np.full(len(candidates), -1, np.int64)
        if not len(self.digests) or not candidates:
            return found
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, candidates), np.uint64, len(candidates))
        first = np.searchsorted(self.digests, wanted)
        for c in np.flatnonzero(self.digests[np.minimum(first, len(self.digests) - 1)] == wanted):
            at = int(first[c])
            while at < len(self.digests) and self.digests[at] == wanted[c]:  # a collision leaves several
                if self.strings[self.offsets[at] : self.offsets[at + 1]].tobytes() == candidates[c]:
                    found[c] = at
                    break
                at += 1
        return found

    def rule(self, at: int) -> str:
        entry = self.strings[self.offsets[at] : self.offsets[at + 1]].tobytes()
        host = int(self.host_length[at])
        return (entry[:host] + entry[host + 1 :]).decode()


def _entry(host: str, path: str) -> bytes:
    return f"{host}\n{path}".encode()


@functools.lru_cache(maxsize=64)
def _mapped(content: bytes) -> DigestArray:
    """Write the index once per worker process and map it; the open map keeps the file's content."""
    with tempfile.NamedTemporaryFile(prefix="rules-") as f:
        f.write(content)
        f.flush()
        return DigestArray.mapped(os.path.realpath(f.name))


def longest_rules(index: DigestArray, urls: Sequence[tuple[str, str]]) -> list[tuple[str, str] | None]:
    """Rule and verdict of each (host, path)."""
    candidates: list[bytes] = []
    owner: list[int] = []
    # A rule's host has no more characters than bytes; longer suffixes fit none, however many dots a url has.
    longest = int(index.host_length.max()) if len(index.host_length) else 0
    for i, (host, path) in enumerate(urls):
        starts = [path[:n] for n in index.path_lengths if n <= len(path)]
        for suffix in host_suffixes(host, longest):
            candidates += [_entry(suffix, start) for start in starts]
            owner += [i] * len(starts)
    best: list[tuple[str, str] | None] = [None] * len(urls)
    found = index.find(candidates)
    for c in np.flatnonzero(found >= 0):
        at = int(found[c])
        rule = (index.rule(at), BLOCK if index.block[at] else ALLOW)
        best[owner[c]] = longer(best[owner[c]], rule)
    return best


def longer(a: tuple[str, str] | None, b: tuple[str, str] | None) -> tuple[str, str] | None:
    """The longer rule; of equal length the one of the longer host stands, which is the first to be found."""
    if a is None or b is None:
        return a or b
    return b if len(b[0]) > len(a[0]) else a


def rule_groups(rules: DataFrame, group_bytes: int) -> Iterator[list[tuple[str, str, str]]]:
    """Rules (host, path, verdict) in groups whose index takes about ``group_bytes``."""
    lower = F.translate("host", "".join(map(chr, LOWER)), "".join(map(chr, LOWER.values())))
    own = rules.select(lower.alias("host"), "path", "verdict").dropna()
    size = F.octet_length("host") + F.octet_length("path") + RULE_OVERHEAD
    groups = int((own.agg(F.sum(size)).first()[0] or 0) // group_bytes) + 1
    for g in range(groups):
        part = own if groups == 1 else own.where(F.pmod(F.xxhash64("host", "path"), F.lit(groups)) == g)
        yield [tuple(r) for r in part.collect()]


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Add host, path, rule and verdict to ``pages``, replacing columns of these names.

    ``rules`` has the columns host, path and verdict. A url that fits no rule gets ``default``.
    """
    names = ["host", "path", "rule", "verdict"]
    kept = [f for f in pages.schema.fields if f.name not in names]
    result = pages.select(*[F.col(f"`{f.name}`") for f in kept])
    schema = T.StructType(kept + [T.StructField(n, T.StringType()) for n in names])
    for g, group in enumerate(rule_groups(rules, group_bytes)):
        content = pages.sparkSession.sparkContext.broadcast(DigestArray.pack(group))
        result = result.mapInArrow(_judge(content, schema, url, default, g == 0), schema)
    return result


def _judge(content, schema: T.StructType, url: str, default: str, first: bool):
    arrow = to_arrow_schema(schema)
    n = len(schema) - 4

    def judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _mapped(content.value)
        for b in (own for whole in batches for own in blocks(whole, whole.schema.get_field_index(url))):
            split = [split_url(u) for u in b.column(url).to_pylist()]
            best = longest_rules(index, split)
            if not first:  # the longest rule of the groups before
                before = zip(b.column(n + 2).to_pylist(), b.column(n + 3).to_pylist())
                best = [longer((r, v) if r is not None else None, x) for (r, v), x in zip(before, best)]
            columns = [b.column(i) for i in range(n)]
            columns += [[h for h, _ in split], [p for _, p in split]]
            columns += [[x and x[0] for x in best], [x[1] if x else default for x in best]]
            yield batch(arrow, columns)

    return judge_batches
