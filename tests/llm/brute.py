"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re
import struct

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def secrets(text: str | None):
    """(start, kind, end) of the fixed kinds."""
    text, found = text or "", []
    assign = re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def spelled(spans) -> str:
    return ",".join(f"{('assign', 'access', 'hex', 'markov')[k]}:{a}:{b}" for a, k, b in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ids_sha(ids) -> str:
    return hashlib.sha256(b"".join(struct.pack("<I", i) for i in ids)).hexdigest()


def shingles(text: str | None, words: int = 4) -> frozenset:
    w = BLANK_WORD.findall(lower_ascii(text or ""))
    if len(w) < words:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))


def jaccard_components(rows, words: int = 4, percent: int = 85) -> dict[int, tuple[int, int]]:
    """Position of each (id, text) row: set size and smallest id reachable."""
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = (len(sets[i]), (min(ids) if ids else None) if sets[i] else rows[i][0])
    return out


def bench_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def contamination(text: str | None, items):
    """(words, words hit, item ids) of a text against (item_id, text) rows."""
    w = bench_words(text)
    hit, found = set(), set()
    for item, other in items:
        b = bench_words(other)
        n = min(10, len(b))
        if not n:
            continue
        windows = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item)
    return len(w), len(hit), found
