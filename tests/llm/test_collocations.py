import random
import re
from collections import Counter

import numpy as np
import pytest

from playerflow.llm import collocations as C


def brute(rows, least, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    cand = {p for p, c in f.items() if len(p) > 2 and c >= least}
    inside = set()
    for lang, *w in cand:
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if f[(lang, *w)] >= f[(lang, *w[i : i + m])]:
                    inside.add((lang, *w[i : i + m]))
    out = {}
    for lang, *w in cand - inside:
        cuts = []
        for k in range(1, len(w)):
            l, r = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((1000 * f[(lang, *w)] * n[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((" ".join(w), f[(lang, *w)], l, r, n[lang], score))
    found = []
    for lang, phrases in out.items():
        phrases.sort(key=lambda p: (-p[5], -p[1], p[0].encode()))
        found += [(lang, i, *p) for i, p in enumerate(phrases[:top], 1)]
    return sorted(found)


def texts(n=300, seed=2):
    draw = random.Random(seed)
    words = ["the", "of", "The", "É", "x\x1cy", "state", "new", "york", "city", "rare", "a", "b", "漢字"] + [f"w{i}" for i in range(40)]
    fixed = ["new york city hall park", "the state of the art", "a b a b a b a b", "THE THE the the the the"]
    def piece():
        return draw.choice(fixed) if draw.random() < 0.4 else " ".join(draw.choices(words, k=draw.randrange(0, 9)))
    def text():
        return "".join(piece() + draw.choice([". ", ", ", "\n", "!? ", " ", "\t", ";", "\x0b"]) for _ in range(draw.randrange(0, 12)))
    return [(draw.choice([None, "", text(), text(), text()]), draw.choice(["en", "en", "en", "de", None, "und", "é"])) for _ in range(n)]


def found(spark, rows, parts=4, **options):
    frame = spark.createDataFrame([(t, lang, 1, "y") for t, lang in rows], "text string, lang string, words int, n string").repartition(parts)
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in C.collocations(frame, **options).collect())


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 200}, {"bucket_words": 100, "chunk_bytes": 3000}, {"bucket_words": 20, "cells": 4, "chunk_bytes": 500}, {"bucket_words": 3, "cells": 16}])
def test_phrases_equal_brute_force(spark, options):
    """One bucket, many buckets, and leading words that are hot up to all lengths."""
    rows = texts()
    expected = brute(rows, 7)
    assert len(expected) > 40 and {lang for lang, *_ in expected} >= {"en", "und"}
    assert found(spark, rows, least=7, **options) == expected


def test_top_and_repeated_rows(spark):
    rows = texts(80) * 3 + [("hot pair " * 500, "de")] * 4
    assert found(spark, rows, least=6, top=9, bucket_words=400) == brute(rows, 6, top=9)


def test_long_texts_are_cut_between_pieces(spark):
    rows = [("one two three four five six. " * 400 + "seven eight " * 300, "en")]
    assert found(spark, rows, least=50, chunk_bytes=100) == brute(rows, 50)


def test_scores_pass_64_bits(spark):
    big = 4 * 10**12
    phrases = spark.createDataFrame([("en", ["a", "b"], big - 1), ("en", ["a"], big), ("en", ["b"], big + 7)], C._PHRASES)
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    assert [r["score"] for r in C.scored(phrases, totals).collect()] == [1000 * (big - 1) * 10**14 // (big * (big + 7))]


def test_sort_finds_all_prefixes():
    rng = np.random.default_rng(4)
    columns = rng.integers(0, 6, (5, 5000))
    for k in range(1, 5):
        columns[k][columns[k - 1] == 0] = 0
    weights = rng.integers(1, 4, 5000)
    counts = Counter()
    for row, w in zip(columns.T.tolist(), weights.tolist()):
        for k in range(2, 6):
            if all(row[:k]):
                counts[tuple(row[:k])] += w
    got = {}
    for depth, pointers, n in C.sorted_counts(columns, weights, np.full(5000, 2), 30):
        for p, c in zip(pointers.tolist(), n.tolist()):
            assert got.setdefault(tuple(columns[:depth, p].tolist()), c) == c
    assert got == {p: c for p, c in counts.items() if c >= 30}


def test_distinct_rows_of_large_numbers():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 50, 3000) * 30_000_000 for _ in range(5)]
    columns[3][:] = columns[4][:] = 7
    rows, counts = C._distinct(columns, 1 << 31)
    assert Counter(zip(*(c.tolist() for c in columns))) == dict(zip(zip(*(c.tolist() for c in rows)), counts.tolist()))


def test_odd_rows(odd_docs, no_docs):
    assert C.collocations(no_docs).count() == 0
    rows = odd_docs.select("text", "lang").collect()
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    got = sorted(tuple(r[c] for c in columns) for r in C.collocations(odd_docs, least=3).collect())
    assert got == brute([(r["text"], r["lang"]) for r in rows], 3) and got
