"""URL filters by a sort-merge range join.

A host's labels are reversed, so a rule's host is a prefix of the keys of all hosts under it, and its keys form an
interval. Intervals of rules nest. Rules and urls are swept in key order with a stack of the rules that are open; a
rule on the stack whose path the url's path starts with fits, and the longest rule wins.

Up to `max_local_rules` rules every task sorts its own urls against the whole sorted list, which moves no url. Beyond
it, rules and urls are both dealt out by ranges of the key, each rule to every range that it reaches, and each range is
swept as it streams. Ranges of a host with many urls are split by a hash of the row. Both ways give the same rows.

Defined results. Null url, or no "://": host and path empty, no rule. Repeated rows: equal results. Of one rule given
twice with both actions, block wins. Very long urls: as others. Empty table or no rules: every url gets the default.
Extra columns are dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import MAX_PARTS, map_batches

Rule = tuple[str, str, str]  # action, host, path

#: Rules that a task may hold, about 100 bytes each.
MAX_LOCAL_RULES = 200_000
LAST = "\U0010ffff"
_LOWER = {i: i + 32 for i in range(65, 91)}
_AFTER_HOST, _AFTER_PATH = re.compile("[/?#]"), re.compile("[?#]")
OUT = "page_id long, host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = m.start() if (m := _AFTER_HOST.search(rest)) else len(rest)
    path = rest[end:]
    return rest[:end].translate(_LOWER), path[: m.start()] if (m := _AFTER_PATH.search(path)) else path


def host_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class Paths:
    """The rules of one host, added by path order; each knows the nearest shorter rule that is its prefix."""

    def __init__(self, key: str, host: str):
        self.key, self.host = key, host
        self.paths: list[str] = []
        self.actions: list[str] = []
        self.above: list[int] = []
        self.open: list[int] = []

    def add(self, path: str, action: str) -> None:
        if self.paths and self.paths[-1] == path:
            if action == "block":
                self.actions[-1] = action
            return
        while self.open and not path.startswith(self.paths[self.open[-1]]):
            self.open.pop()
        self.above.append(self.open[-1] if self.open else -1)
        self.open.append(len(self.paths))
        self.paths.append(path)
        self.actions.append(action)

    def longest(self, path: str) -> int:
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.above[i]
        return i


class Sweep:
    """Keys must come in order; of one key the rules come before the urls."""

    def __init__(self) -> None:
        self.stack: list[Paths] = []

    def _reach(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def rule(self, key: str, action: str, host: str, path: str) -> None:
        self._reach(key)
        if not self.stack or self.stack[-1].key != key:
            self.stack.append(Paths(key, host))
        self.stack[-1].add(path, action)

    def url(self, key: str, path: str) -> tuple[str | None, str | None]:
        self._reach(key)
        best: tuple[str | None, str | None] = (None, None)
        for open_ in reversed(self.stack):  # of equal lengths the deeper host wins
            if (i := open_.longest(path)) >= 0 and len(text := open_.host + open_.paths[i]) > len(best[0] or ""):
                best = text, open_.actions[i]
        return best


def _sorted_rules(rules: Iterable[Rule]) -> list[tuple[str, str, str, str]]:
    return sorted((host_key(h := host.translate(_LOWER)), path, h, action) for action, host, path in rules if host)


def _local(rules: list[Rule], default: str):
    ordered = _sorted_rules(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            keys = [host_key(h) for h, _ in parts]
            sweep, at = Sweep(), 0
            found: list[tuple[str | None, str | None]] = [(None, None)] * len(parts)
            for i in sorted(range(len(parts)), key=keys.__getitem__):
                while at < len(ordered) and ordered[at][0] <= keys[i]:
                    key, path, host, action = ordered[at]
                    sweep.rule(key, action, host, path)
                    at += 1
                found[i] = sweep.url(keys[i], parts[i][1])
            columns = [[h for h, _ in parts], [p for _, p in parts], [r for r, _ in found], [v or default for _, v in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in columns]], names=["page_id", "host", "path", "rule", "verdict"])

    return run


_EVENT = "bucket int, key string, kind int, page_id long, host string, path string, action string"


def _events(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string())
    columns = list(zip(*rows, strict=True)) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _EVENT.split(", ")])


def _spread(pages: DataFrame, rules: DataFrame, default: str, parts: int | None) -> DataFrame:
    """Rules and urls by ranges of the key, a range for about a million urls. The cut points come from a bounded sample; they
    decide no result."""
    n = pages.count()
    parts = parts or min(MAX_PARTS, max(256, n // 1_000_000))
    share = min(1.0, 64 * parts / max(1, n))
    some = pages.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 20)) < int(share * (1 << 20))).select("url").limit(256 * parts).collect()
    keys = sorted(host_key(split_url(r["url"])[0]) for r in some)
    cuts = [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []

    def of_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, (page, url) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                host, path = split_url(url)
                key = host_key(host)
                low, high = bisect_left(cuts, key), bisect_right(cuts, key)
                rows.append((low + 1 + at % (high - low) if high > low else high, key, 1, page, host, path, None))
            yield _events(rows)

    def of_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rules_ = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            rows = [
                (b, key, 0, None, host, path, action)
                for key, path, host, action in _sorted_rules(r for r in rules_ if None not in r)
                for b in range(bisect_left(cuts, key), bisect_right(cuts, key + LAST) + 1)
            ]
            yield _events(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, bucket = Sweep(), None
        for batch in batches:
            out = []
            for b, key, kind, page, host, path, action in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    sweep, bucket = Sweep(), b
                if kind:
                    rule, verdict = sweep.url(key, path)
                    out.append((page, host, path, rule, verdict or default))
                else:
                    sweep.rule(key, action, host, path)
            if out:
                kinds = (pa.int64(), *[pa.string()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in OUT.split(", ")])

    both = map_batches(pages.select("page_id", "url"), of_urls, _EVENT).union(map_batches(rules.select("action", "host", "path"), of_rules, _EVENT))
    return map_batches(both.repartition(parts, "bucket").sortWithinPartitions("bucket", "key", "kind", "path"), run, OUT)


def filter_urls(pages: DataFrame, rules: list[Rule] | DataFrame, default: str = "allow", max_local_rules: int = MAX_LOCAL_RULES, parts: int | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of pages. rules: (action, host, path) rows."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    if isinstance(rules, DataFrame):
        some = rules.select("action", "host", "path").limit(max_local_rules + 1).collect()
        if len(some) > max_local_rules:
            return _spread(pages, rules, default, parts)
        rules = [tuple(r) for r in some if None not in tuple(r)]
    elif len(rules) > max_local_rules:
        return _spread(pages, pages.sparkSession.createDataFrame(rules, "action string, host string, path string"), default, parts)
    return map_batches(pages, _local(rules, default), OUT)
