"""Allow and block rules for URLs, matched by a trie.

The trie runs over host labels from the right, then over whole path segments; what
follows a rule's last slash is a prefix of the next segment. The longest rule that
fits decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: A-Z only: other letters of a host stay as they are.
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` in lower case, and path; both empty without one."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substr(url, begin + 3)).otherwise("")
    address = F.regexp_extract(rest, "^[^?#]*", 0)
    slash = F.instr(address, "/")
    host = F.when(slash > 0, F.substr(address, F.lit(1), slash - 1)).otherwise(address)
    path = F.when(slash > 0, F.substr(address, slash)).otherwise("")
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


class _Node:
    __slots__ = ("hosts", "segments", "tails", "lengths")

    def __init__(self):
        self.hosts: dict[str, _Node] = {}
        self.segments: dict[str, _Node] = {}
        #: Prefixes of the next segment that end a rule here, and their lengths, the
        #: longest first.
        self.tails: dict[str, tuple[int, str, str]] = {}
        self.lengths: list[int] = []


class RuleTrie:
    """Longest-match lookup. Equal lengths: the longer host, then block, wins."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        for rule in rules:
            if rule.verdict not in (ALLOW, BLOCK):
                raise ValueError(f"verdict must be allow or block: {rule}")
            host = rule.host.translate(_LOWER)
            node = self.root
            for label in reversed(host.split(".")):
                node = node.hosts.setdefault(label, _Node())
            *segments, tail = rule.path.split("/")
            for segment in segments:
                node = node.segments.setdefault(segment, _Node())
            text = host + rule.path
            if node.tails.get(tail, ("",) * 3)[2] != BLOCK:
                node.tails[tail] = (len(text), text, rule.verdict)
            if len(tail) not in node.lengths:
                node.lengths.append(len(tail))
                node.lengths.sort(reverse=True)

    def match(self, host: str, path: str) -> tuple[int, int, bool, str, str] | None:
        """Length, last host label, whether it blocks, text and verdict of the winner."""
        best: tuple[int, int, bool, str, str] | None = None
        segments = path.split("/")
        at = self.root
        for depth, label in enumerate(reversed(host.split("."))):
            at = at.hosts.get(label)
            if at is None:
                break
            node = at
            for segment in segments:
                for length in node.lengths:
                    # A longer prefix of one segment is a longer rule.
                    tail = node.tails.get(segment[:length]) if length <= len(segment) else None
                    if tail:
                        size, text, verdict = tail
                        found = (size, depth, verdict == BLOCK, text, verdict)
                        if best is None or found[:3] > best[:3]:
                            best = found
                        break
                node = node.segments.get(segment)
                if node is None:
                    break
        return best


class RuleList:
    """Rules as tasks receive them; the trie is built once in each worker process."""

    def __init__(self, rules: list[Rule]):
        self.rules = [tuple(rule) for rule in rules]

    def __getstate__(self) -> dict:
        return {"rules": self.rules}

    @cached_property
    def trie(self) -> RuleTrie:
        return RuleTrie(Rule(*rule) for rule in self.rules)


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule],
    url_col: str = "url",
    default: str = ALLOW,
    max_rule_bytes: int = 64 << 20,
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    A rule fits its host and all subdomains, where the path starts with the rule's.
    URLs that no rule fits get ``default``; so do null URLs and those without ``://``,
    whose host and path are empty. Columns of these four names are replaced, all
    others and all rows are kept as they are.

    The trie goes to every executor, so the rules' bytes are checked first; a larger
    list is worked in blocks that each fit, and the longest match of all blocks wins.
    """
    blocks: list[list[Rule]] = [[]]
    held = 0
    for rule in rules:
        size = len(rule.text.encode()) + 200
        if held + size > max_rule_bytes and blocks[-1]:
            blocks.append([])
            held = 0
        blocks[-1].append(rule)
        held += size
    context = pages.sparkSession.sparkContext
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    host, path = host_and_path(url)
    best = None
    for block in blocks:
        shared = context.broadcast(RuleList(block))
        found = _matcher(shared)(host, path)
        best = found if best is None else F.greatest(best, found)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    judged = pages.select(
        *[F.col(f"`{c}`") for c in kept],
        host.alias("host"),
        path.alias("path"),
        best.alias("_match"),
    )
    return judged.select(
        *[F.col(f"`{c}`") for c in kept],
        "host",
        "path",
        F.col("_match.rule").alias("rule"),
        F.coalesce(F.col("_match.verdict"), F.lit(default)).alias("verdict"),
    )


def _matcher(shared):
    # The fields stand in the order in which a longer match beats a shorter one.
    @F.pandas_udf("size int, labels int, blocks boolean, rule string, verdict string")
    def matched(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = shared.value.trie
        none = (None,) * 5
        names = ["size", "labels", "blocks", "rule", "verdict"]
        for hosts, paths in batches:
            rows = [trie.match(h, p) or none for h, p in zip(hosts, paths)]
            yield pd.DataFrame(rows, columns=names)

    return matched
