"""URL verdicts by a bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL (host, then path). All globs lie
side by side in multiword Shift-And masks: one bit per prefix of a glob. A
character moves every state of every glob at once with a shift, an AND with
the character's mask and an OR with the states that loop on a wildcard. A
batch of URLs runs through the automaton together, one numpy step per
character position.

A null URL, or one without ``://``, has an empty host and path; no rule fits
it and the globs of the default policy judge the empty text. Repeated rows
stay repeated. URLs of any length are followed to their end.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerflow.llm.batches import map_values
from playerflow.llm.registry import query, table


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        """The host itself and any subdomain; ``*`` stays within the host, ``**`` does not."""
        return f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"


#: Host and path rules; the longest that fits decides.
RULES = (
    Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"),
)
#: Globs that block a URL which no rule decides.
BLOCKED = ("*spam*", "*spam*/**", "*cheap-*", "*cheap-*/**", "**/login/**", "**.exe")
_WORD = 64
_OTHER = 128


class GlobAutomaton:
    """All globs at once: ``literal[c]`` has the states entered by character c, ``loops[c]`` those that stay on it."""

    def __init__(self, globs: tuple[str, ...]):
        parsed = [self._parse(g) for g in globs]
        size = sum(len(literals) + 1 for literals, _ in parsed)
        self.words = max(1, -(-size // _WORD))
        literal, loops = [0] * (_OTHER + 1), [0] * (_OTHER + 1)
        self.starts, self.ends, at = 0, [], 0
        for literals, wild in parsed:
            self.starts |= 1 << at
            for i, c in enumerate(literals, 1):
                if ord(c) >= _OTHER:
                    raise ValueError(f"a glob has ASCII characters only: {c!r}")
                literal[ord(c)] |= 1 << at + i
            for i, kind in wild.items():
                for code in range(_OTHER + 1):
                    if kind == "**" or code != ord("/"):
                        loops[code] |= 1 << at + i
            self.ends.append(at + len(literals))
            at += len(literals) + 1
        self.literal, self.loops = self._pack(literal), self._pack(loops)
        self.start = self._pack([self.starts])[0]

    @staticmethod
    def _parse(glob: str) -> tuple[str, dict[int, str]]:
        """Literal characters, and the wildcard that follows so many of them."""
        literals, wild, i = [], {}, 0
        while i < len(glob):
            if glob[i] == "*":
                run = len(glob[i:]) - len(glob[i:].lstrip("*"))
                wild[len(literals)] = "**" if run > 1 else "*"
                i += run
            else:
                literals.append(glob[i])
                i += 1
        return "".join(literals), wild

    def _pack(self, masks: list[int]) -> np.ndarray:
        low = (1 << _WORD) - 1
        return np.array([[m >> _WORD * w & low for w in range(self.words)] for m in masks], dtype=np.uint64)

    def matches(self, texts: list[str]) -> np.ndarray:
        """For each text and glob: whether the glob covers the whole text."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        sorted_lengths = lengths[order]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        codes = np.minimum(codes, _OTHER).astype(np.int64)
        begins = (np.cumsum(lengths) - lengths)[order]
        states = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(_WORD - 1)
        active = len(texts)
        for step in range(int(sorted_lengths[0]) if len(texts) else 0):
            while active and sorted_lengths[active - 1] <= step:
                active -= 1
            now, c = states[:active], codes[begins[:active] + step]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            states[:active] = (moved & self.literal[c]) | (now & self.loops[c])
        found = np.empty((len(texts), len(self.ends)), dtype=bool)
        for k, end in enumerate(self.ends):
            found[order, k] = (states[:, end // _WORD] >> np.uint64(end % _WORD)) & one == one
        return found


class UrlPolicy:
    def __init__(self, rules: tuple[Rule, ...], blocked: tuple[str, ...]):
        self.rules = sorted(rules, key=lambda r: len(r.name), reverse=True)
        globs = [g for r in self.rules for g in r.globs()]
        self.automaton = GlobAutomaton((*globs, *blocked))

    def judge(self, urls: list[str]) -> tuple[list[str | None], list[str]]:
        found = self.automaton.matches(urls)
        names: list[str | None] = []
        verdicts = []
        decided = found[:, : 2 * len(self.rules)].reshape(len(urls), len(self.rules), 2).any(axis=2)
        blocked = found[:, 2 * len(self.rules) :].any(axis=1)
        for i in range(len(urls)):
            rule = self.rules[int(decided[i].argmax())] if decided[i].any() else None
            names.append(rule and rule.name)
            verdicts.append(rule.verdict if rule else "block" if blocked[i] else "allow")
        return names, verdicts


@lru_cache(maxsize=8)
def _policy(rules: tuple[Rule, ...], blocked: tuple[str, ...]) -> UrlPolicy:
    return UrlPolicy(rules, blocked)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def judge_urls(df: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, blocked: tuple[str, ...] = BLOCKED, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with host, path, rule and verdict; names that clash are replaced."""
    value = F.coalesce(df[url].cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(value, _PARTS, 1), _UPPER, _LOWER)
    kept = keep if keep is not None else [c for c in df.columns if c != url]
    kept = [c for c in kept if c.lower() not in ("host", "path", "rule", "verdict")]
    split = df.select(*[df[c] for c in kept], host.alias("host"), F.regexp_extract(value, _PARTS, 2).alias("path"))
    split = split.withColumn("__url", F.concat("host", "path"))
    added = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def make():
        policy = _policy(tuple(rules), tuple(blocked))
        return lambda urls: list(policy.judge(urls))

    return map_values(split, "__url", added, make, [*kept, "host", "path"])


_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), judged AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
  END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN contains(host, 'spam') OR contains(host, 'cheap-') OR contains(host || path, '/login/') OR ends_with(host || path, '.exe') THEN 'block'
  ELSE 'allow' END AS verdict
FROM judged
"""


@query("op8_url_filter", _SQL)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), keep=["page_id"])
