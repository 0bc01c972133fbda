import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from playerflow.llm import best_fit_packing as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPACES = [" ", "  ", "   ", "\n", "\n\n", " \n", "\n ", "\t ", " \t \n ", " ", "   ", "\x1c ", "\x85", "\r\n"]
WORDS = ["a", "don't", "it's'", "Zoë", "漢字", "12", "3.5", "😀", "é", "x" * 60, "!!", "<|endoftext|>", "<", "\x00", "'ll", "ſ", "²", "İ"]


def library(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def odd_texts(n=400):
    draw = random.Random(3)
    return [None, "", " ", "  ", "\n", "a ", "a  ", " a", "x" * 5000, "ab " * 3000] + ["".join(draw.choice(SPACES if draw.random() < 0.5 else WORDS) for _ in range(draw.randrange(1, 14))) for _ in range(n)]


def test_ids_equal_the_library():
    encoder, tokenizer = B.byte_encoder(PATH), Tokenizer.from_file(PATH)
    for text in odd_texts():
        assert encoder.encode(text) == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def best_fit(lengths, capacity):
    """Best fit decreasing, one piece after the other."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def laid_out(counts, capacity):
    bins = {}
    for s in B.plan(counts, capacity):
        for k in range(s.pieces):
            bins.setdefault(s.bin + k // s.each, []).append((s.offset + k % s.each * s.length, s.length))
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120))
def test_plan_equals_best_fit(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    bins = laid_out(counts, 30)
    assert len(bins) == best_fit(lengths, 30) and sorted(bins) == list(range(len(bins)))
    assert sorted(n for b in bins.values() for _, n in b) == sorted(lengths)
    for parts in bins.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= 30
    ranks = {}
    for s in B.plan(counts, 30):
        assert s.rank == ranks.get(s.length, 0)
        ranks[s.length] = s.rank + s.pieces
    assert ranks == counts


def test_plan_does_not_grow_with_the_counts():
    draw = random.Random(1)
    sizes = [len(B.plan({n: draw.randrange(1, most) for n in range(1, 1025)})) for most in (10, 10**4, 10**12)]
    assert max(sizes) < 40 * 1024 and sizes[2] < 3 * sizes[1]


@pytest.mark.parametrize("n, expected", [(1, [(0, 1)]), (4, [(0, 4)]), (5, [(0, 1), (1, 4)]), (8, [(0, 4), (4, 4)]), (11, [(0, 3), (3, 4), (7, 4)])])
def test_pieces(n, expected):
    assert B._pieces(n, 4) == expected


def check(rows, texts, capacity, ids):
    """Every document's ids are there once, in order; sequences have no gap and no overlap."""
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(documents) == set(texts)
    for doc, parts in documents.items():
        whole = np.array([*ids[texts[doc]], B.END_ID], "<u4")
        parts.sort(key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in parts] == B._pieces(len(whole), capacity) and [r["piece"] for r in parts] == list(range(len(parts)))
        assert all(r["ids_crc32"] == zlib.crc32(whole[r["start"] : r["start"] + r["length"]].tobytes()) for r in parts)
    for parts in sequences.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= capacity
    assert len(sequences) == best_fit([r["length"] for r in rows], capacity)


def test_query_against_the_library(spark, sf_dir):
    rows = B.op13_best_fit_packing(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(PATH)
    check(rows, texts, 1024, {t: tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.values()})


def test_many_tasks_and_the_ids_of_sequences(spark):
    texts = dict(enumerate(odd_texts(120)))
    docs = spark.createDataFrame([(i, t, "own", 5) for i, t in texts.items()], "doc_id long, text string, host string, piece int").repartition(9)
    packed = B.pack(docs, capacity=16)
    assert packed.columns == ["doc_id", "host", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    rows = packed.collect()
    check(rows, texts, 16, {t: library(t) for t in set(texts.values())})
    made = {r["sequence_id"]: r["ids"] for r in B.sequences(packed).collect()}
    assert all(made[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"] for r in rows)


def test_odd_rows(odd_docs, no_docs):
    rows = B.pack(odd_docs, with_ids=False).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert sum(r["piece"] == 0 for r in rows) == odd_docs.count()
    assert B.pack(no_docs).count() == 0
