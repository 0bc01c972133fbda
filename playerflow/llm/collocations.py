"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Texts are cut into pieces at punctuation and line ends, pieces into words. A
suffix is the words from a place in a piece on, ``LONGEST`` at most. Suffixes
are routed across the cluster by their leading words into buckets; in a bucket
their pointers are sorted by three-way partitioning on a word at a time (all
open partitions of a round side by side in numpy). The equal part of a
partition holds every suffix that begins with the phrase read so far, so its
size is the phrase's count. Parts below the least count are abandoned.

*Leading words.* Words are counted first, then pairs of words that are frequent
enough for a phrase, by a 32-bit key in their bucket. A suffix ends before a
word or pair that is too rare. Tasks know the others by two bit filters of fixed
size, so some rare ones may pass, which costs work and changes nothing.

*Hot leading words.* The same pass counts the leading two, three and four words
by hash in ``CELLS`` cells each. Where a cell is too large for a bucket, the
suffix is routed by one more word, and the number of its hot leading words is
sent as a weighted row of its own. Equal suffixes of a chunk of text travel as
one weighted row, so no phrase, however frequent, fills a task.

*Scores.* A phrase's cut after its first k words is scored by
``floor(1000 * a * n / (l * r))`` in decimals of 38 digits; the cut with the
lowest score counts, the smallest k among equals. Phrases inside a longer one
that is as frequent are dropped. The first ``top`` of each language are taken
in two steps, so that a language with many phrases is not one task's work.

A null or empty text has no words. A null language is ``und``. Repeated rows
count each. An empty table has no phrases. A long text is cut between pieces,
so a task holds a chunk of text or one piece. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playerflow.llm.registry import query, table
from playerflow.session import written

LEAST = 100
LONGEST = 5
TOP = 2000
#: Bytes of text from which on a task's chunk is full.
CHUNK_BYTES = 8 << 20
#: Words of the corpus for each bucket.
BUCKET_WORDS = 6_000_000
#: Cells in which the leading words of each length are counted, and bits of the filters of frequent words and pairs.
CELLS = 1 << 16
FILTER_BITS = 1 << 24
#: Parts in which the first phrases of a language are chosen before they meet.
TOP_PARTS = 64

_SEPARATORS = re.compile(r"[.,;:!?\x0A-\x0D]")
_END, _SPACE = 10, 32


def _byte_classes() -> np.ndarray:
    """Lower case for A-Z, one byte for all separators and one for both blanks."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[[*b".,;:!?\x0a\x0b\x0c\x0d"]] = _END
    table[ord("\t")] = _SPACE
    return table


_CLASSES = _byte_classes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tokens(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the code of each word in order, and whether the next one stands in the same piece."""
    data = _CLASSES[np.frombuffer("\n".join(texts).encode(), np.uint8)]
    ends = data == _END
    word = ~(ends | (data == _SPACE))
    edges = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    starts, lengths = edges[::2], np.diff(edges)[::2]
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[word]))]).dictionary_encode()
    piece = np.cumsum(ends, dtype=np.int32)[starts]
    return words.dictionary, words.indices.to_numpy(), np.append(piece[1:] == piece[:-1], False)[: len(starts)]


def _hashes(lang: str, words: pa.Array) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words.to_pylist()], np.uint64)


def _longer(prefix: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The hash of leading words and one more."""
    return _mix(prefix * np.uint64(0x9E3779B97F4A7C15) + following)


def _cell(prefix: np.ndarray, cells: int) -> np.ndarray:
    return ((prefix >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)


def _shifted(values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    out[:-1] = values[1:]
    return out


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language, about ``size`` characters at a time; longer ones are cut between pieces."""
    held: dict[str, list[str]] = defaultdict(list)
    total = 0
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            start = 0
            while start < len(text):
                end = len(text)
                if end - start > size and (cut := _SEPARATORS.search(text, start + size)):
                    end = cut.end()
                held[lang].append(text[start:end])
                total, start = total + end - start, end
                if total >= size:
                    yield from held.items()
                    held.clear()
                    total = 0
    yield from held.items()


def _count_words(size: int, cells: int):
    """Counts of words, and of the leading two, three and four words by cell, of each chunk."""
    names = ["lang", "word", "k", "cell", "n"]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64()]

    def rows(lang: str, n: np.ndarray, word=None, k=None, cell=None) -> pa.RecordBatch:
        none = [None] * len(n)
        values = [[lang] * len(n), word if word is not None else none, [k] * len(n), cell if cell is not None else none, n]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _chunks(batches, size):
            words, codes, same = _tokens(texts)
            if not len(codes):
                continue
            yield rows(lang, np.bincount(codes, minlength=len(words)), word=words.cast(pa.string()))
            own = _hashes(lang, words)[codes]
            prefix, inside = own, np.ones(len(own), bool)
            for k in range(2, LONGEST):
                inside = inside[: len(own) - k + 1] & same[k - 2 : len(own) - 1]
                prefix = _longer(prefix[: len(inside)], own[k - 1 :])
                counts = np.bincount(_cell(prefix[inside], cells), minlength=cells)
                held = np.flatnonzero(counts)
                yield rows("", counts[held], k=k, cell=held)

    return run


def _distinct(columns: list[np.ndarray], base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers below ``base``, sorted, and how often each is there."""
    key, limit, packed = columns[0].astype(np.int64), base, []
    for column in columns[1:]:
        ranks = None
        if limit * base >= 1 << 62:
            ranks, key = np.unique(key, return_inverse=True)
            limit = len(ranks)
        packed.append(ranks)
        key, limit = key * base + column, limit * base
    key, counts = np.unique(key, return_counts=True)
    out = []
    for ranks in reversed(packed):
        key, last = np.divmod(key, base)
        out.append(last)
        key = key if ranks is None else ranks[key]
    return [key, *reversed(out)], counts


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in as many bytes as the largest needs, after a byte that tells how many."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _whole(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def _has(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _frequent_words(lang: str, texts: list[str], bits: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The frequent words, their hashes from 1 on, the number of each word in order (0: rare), and whether it and the next one make a pair."""
    words, codes, same = _tokens(texts)
    own = _hashes(lang, words)
    kept = np.flatnonzero(_has(bits, _cell(own, FILTER_BITS)))
    number = np.zeros(len(words) + 1, np.int64)
    number[kept] = np.arange(1, len(kept) + 1)
    first = number[codes]
    return words.take(pa.array(kept)), np.append(np.uint64(0), own[kept]), first, same & (first > 0) & (_shifted(first) > 0)


def _pair_keys(own: np.ndarray, first: np.ndarray, paired: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(paired)
    return _longer(own[first[at]], own[first[at + 1]])


def _pair_place(bucket: np.ndarray, low: np.ndarray) -> np.ndarray:
    return _cell(_mix((bucket.astype(np.uint64) << np.uint64(32)) + low), FILTER_BITS)


_LOW = np.uint64(0xFFFFFFFF)


def _pairs(size: int, bits: np.ndarray, buckets: int):
    """Pairs of frequent words of each chunk by bucket of their hash: the low half of the hashes, and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _chunks(batches, size):
            keys, counts = np.unique(_pair_keys(*_frequent_words(lang, texts, bits)[1:]), return_counts=True)
            held, starts = np.unique(_cell(keys, buckets), return_index=True)
            for bucket, low, n in zip(held.tolist(), np.split(keys & _LOW, starts[1:]), np.split(counts, starts[1:])):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([low.astype("<u4").tobytes()], pa.binary()), pa.array([_small(n)], pa.binary())], names=["bucket", "low", "n"])

    return run


def _pair_bits(least: int):
    """The filter bits of the pairs of a bucket that are frequent."""

    def run(rows: pa.Table) -> pa.Table:
        low = np.concatenate([np.frombuffer(x, "<u4") for x in rows.column("low").to_pylist()])
        n = np.concatenate([_whole(x) for x in rows.column("n").to_pylist()])
        low, at = np.unique(low, return_inverse=True)
        low = low[np.bincount(at, n) >= least].astype(np.uint64)
        places = _pair_place(np.full(len(low), rows.column("bucket")[0].as_py()), low)
        words, at = np.unique(places >> 6, return_inverse=True)
        found = np.zeros(len(words), np.uint64)
        np.bitwise_or.at(found, at, np.uint64(1) << (places & 63).astype(np.uint64))
        return pa.table({"place": pa.array(words, pa.int64()), "bits": pa.array(found.view(np.int64), pa.int64())})

    return run


def _collected(bits: DataFrame) -> np.ndarray:
    """The filter that rows of place and bits make up; at most a row for every 64 of its bits."""
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    for r in bits.groupBy("place").agg(F.bit_or("bits").alias("bits")).collect():
        out[r["place"]] = r["bits"] & (1 << 64) - 1
    return out


_PAYLOAD = "lang string, bucket long, words binary, suffixes array<binary>, weights binary, froms binary"


def _route(size: int, cells: int, hot: np.ndarray, bits: np.ndarray, pair_bits: np.ndarray, pair_buckets: int, buckets: dict[str, int]):
    """Suffixes of each chunk by bucket: distinct ones with their weight and the length from which on they count."""
    names = [c.split()[0] for c in _PAYLOAD.split(", ")]
    types = [pa.string(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.binary()]

    def payload(lang: str, bucket: int, words: pa.Array, columns: list[np.ndarray], weights: np.ndarray, froms: np.ndarray) -> pa.RecordBatch:
        used = np.zeros(len(words) + 1, np.int64)
        for c in columns:
            used[c] = 1
        used[0] = 0
        place = np.cumsum(used) * used
        values = [[lang], [bucket], [b" ".join(words.take(pa.array(np.flatnonzero(used) - 1)).to_pylist())], [[_small(place[c]) for c in columns]], [_small(weights)], [_small(froms)]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _chunks(batches, size):
            words, own, first, paired = _frequent_words(lang, texts, bits)
            keys = _pair_keys(own, first, paired)
            paired[paired] = _has(pair_bits, _pair_place(_cell(keys, pair_buckets), keys & _LOW))
            columns = [first, np.where(paired, _shifted(first), 0)]
            while len(columns) < LONGEST:
                columns.append(np.where(columns[-1] > 0, _shifted(columns[-1]), 0))
            columns = [c[paired] for c in columns]
            if not len(columns[0]):
                continue
            columns, weights = _distinct(columns, len(own))
            prefixes = [own[columns[0]]]
            for c in columns[1:]:
                prefixes.append(_longer(prefixes[-1], own[c]))
            # length of the suffix, and the first length at which its leading words are not hot
            length = sum((c > 0).astype(np.int64) for c in columns)
            start = np.full(len(length), 2)
            parts = []
            for k in range(2, LONGEST):
                warm = (start == k) & (length >= k) & hot[k - 2][_cell(prefixes[k - 1], cells)]
                start[warm] = k + 1
                if warm.any():  # hot leading words are counted by rows of their own
                    at = np.flatnonzero(warm)  # sorted by their words, so equal heads stand together
                    runs = np.flatnonzero(np.append(True, np.any([np.diff(c[at]) != 0 for c in columns[:k]], axis=0)))
                    heads = [c[at[runs]] if i < k else np.zeros(len(runs), np.int64) for i, c in enumerate(columns)]
                    parts.append((heads, np.add.reduceat(weights[at], runs), np.full(len(runs), k), prefixes[k - 1][at[runs]]))
            going = length >= start
            route = np.choose(start[going] - 2, [p[going] for p in prefixes[1:]])
            parts.append(([c[going] for c in columns], weights[going], start[going], route))
            columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts))]
            weights, froms, route = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
            bucket = _cell(_mix(route), buckets.get(lang, 1))
            order = np.argsort(bucket, kind="stable")
            held, starts = np.unique(bucket[order], return_index=True)
            for b, part in zip(held.tolist(), np.split(order, starts[1:])):
                yield payload(lang, b, words, [c[part] for c in columns], weights[part], froms[part])

    return run


def sorted_counts(columns: np.ndarray, weights: np.ndarray, froms: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, pointers of a suffix each, and counts of the phrases of two words and more that are there ``least`` times.

    ``columns`` has the suffixes' words, a row for each place, 0 after their
    end; a suffix counts for phrases from its length in ``froms`` on. Each
    round splits every open partition by its pivot into less, equal and more;
    the equal part goes on with the next word.
    """
    longest, n = columns.shape
    flat = columns.ravel()
    pointers, sizes, depths = np.arange(n), np.array([n] if n else [], np.int64), np.zeros(1 if n else 0, np.int64)
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        word = flat[np.repeat(depths * n, sizes) + pointers]
        pivots = word[starts + sizes // 2]
        pivot = np.repeat(pivots, sizes)
        sides = (word < pivot, word == pivot, word > pivot)
        part_sizes = np.stack([np.add.reduceat(s, starts, dtype=np.int64) for s in sides], axis=1)
        part_starts = (np.cumsum(part_sizes) - part_sizes.ravel()).reshape(-1, 3)
        moved = np.empty_like(pointers)
        for i, side in enumerate(sides):
            count = part_sizes[:, i]
            target = np.repeat(part_starts[:, i] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            moved[target] = pointers[side]
        # of each part: weight of all its suffixes, and of those that count
        is_equal = np.tile([False, True, False], len(sizes))
        sizes, depths, pivots = part_sizes.ravel(), np.repeat(depths, 3) + is_equal, np.repeat(pivots, 3)
        filled = sizes > 0
        sizes, depths, pivots, is_equal = sizes[filled], depths[filled], pivots[filled], is_equal[filled]
        starts = np.cumsum(sizes) - sizes
        weight = weights[moved]
        total = np.add.reduceat(weight, starts)
        counted = np.add.reduceat(np.where(froms[moved] <= np.repeat(depths, sizes), weight, 0), starts)
        found = is_equal & (pivots > 0)
        told = found & (depths > 1) & (counted >= least)
        for depth in np.unique(depths[told]).tolist():
            which = told & (depths == depth)
            yield depth, moved[starts[which]], counted[which]
        going = (total >= least) & (~is_equal | (found & (depths < longest)))
        pointers = moved[np.repeat(going, sizes)]
        sizes, depths = sizes[going], depths[going]


_PHRASES = "lang string, words array<string>, n long"


def _bucket_phrases(least: int):
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("n", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        lists = [x.split(b" ") for x in rows.column("words").to_pylist()]
        words = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
        codes, ends = words.indices.to_numpy().astype(np.int32) + 1, np.cumsum([0, *map(len, lists)])
        del lists
        parts = []
        for i, suffixes in enumerate(rows.column("suffixes").to_pylist()):
            own = np.append(np.int32(0), codes[ends[i] : ends[i + 1]])
            parts.append(np.stack([own[_whole(c)] for c in suffixes]))
        weights, froms = (np.concatenate([_whole(x) for x in rows.column(name).to_pylist()]) for name in ("weights", "froms"))
        columns = np.concatenate(parts, axis=1)
        del parts
        names, lang = words.dictionary.cast(pa.string()), rows.column("lang")[0].as_py()
        tables = [schema.empty_table()]
        for depth, pointers, counts in sorted_counts(columns, weights, froms, least):
            told = names.take(pa.array(columns[:depth, pointers].T.ravel() - 1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * depth, pa.int32()), told)
            tables.append(pa.Table.from_arrays([pa.array([lang] * len(counts), pa.string()), lists, pa.array(counts, pa.int64())], schema=schema))
        return pa.concat_tables(tables)

    return run


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, chunk_bytes: int = CHUNK_BYTES, bucket_words: int = BUCKET_WORDS, cells: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """Two written tables: (lang, words, n) of all phrases of 1 to ``LONGEST`` words that are there ``least`` times, and (lang, n) with all words."""
    source = df.select(F.coalesce(df[lang].cast("string"), F.lit("und")).alias("lang"), df[text].alias("text")).where("text <> ''")
    parts = source.mapInArrow(_count_words(chunk_bytes, cells), "lang string, word string, k int, cell int, n long")
    counts = written(parts.groupBy("lang", "word", "k", "cell").agg(F.sum("n").alias("n")), "phrases-words")
    words = counts.where("word is not null")
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    single = words.where(F.col("n") >= least).select("lang", F.array("word").alias("words"), "n")

    hot = np.zeros((LONGEST - 2, cells), bool)
    for r in counts.where(F.col("word").isNull() & (F.col("n") > bucket_words // 2)).select("k", "cell").collect():
        hot[r["k"] - 2, r["cell"]] = True
    bits = _collected(single.select("lang", F.element_at("words", 1).alias("word")).mapInArrow(_filter_bits, "place long, bits long"))
    pair_buckets = max(1, -(-(totals.agg(F.sum("n").alias("n")).first()["n"] or 0) // bucket_words))
    pairs = source.mapInArrow(_pairs(chunk_bytes, bits, pair_buckets), "bucket long, low binary, n binary")
    pair_bits = _collected(pairs.groupBy("bucket").applyInArrow(_pair_bits(least), "place long, bits long"))
    # languages of one bucket need no entry
    buckets = {r["lang"]: -(-r["n"] // bucket_words) for r in totals.where(F.col("n") > bucket_words).collect()}

    routed = source.mapInArrow(_route(chunk_bytes, cells, hot, bits, pair_bits, pair_buckets, buckets), _PAYLOAD)
    longer = routed.groupBy("lang", "bucket").applyInArrow(_bucket_phrases(least), _PHRASES)
    return written(single.unionByName(longer), "phrases"), totals


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[int, int] = defaultdict(int)
        by_lang: dict[str, list[bytes]] = defaultdict(list)
        for lang, word in zip(*(c.to_pylist() for c in batch.columns)):
            by_lang[lang].append(word.encode())
        for lang, words in by_lang.items():
            for at in _cell(_hashes(lang, pa.array(words, pa.binary())), FILTER_BITS).tolist():
                found[at >> 6] |= 1 << (at & 63)
        bits = np.array(list(found.values()), np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(bits)], names=["place", "bits"])


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n and score (that of the worst cut) of the phrases of two words and more."""
    counts = phrases.select("lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("f"))
    cuts = phrases.where(F.size("words") > 1).select("lang", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = cuts.select("lang", F.array_join("words", " ").alias("phrase"), F.size("words").alias("size"), "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("words")).alias("right"))
    sides = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    sides = sides.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
    exact = {c: f"cast({c} as decimal(17,0))" for c in "anlr"}
    score = F.expr(f"(cast(1000 as decimal(4,0)) * {exact['a']} * {exact['n']}) div ({exact['l']} * {exact['r']})")
    worst = sides.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("size").alias("size"), F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return worst.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def without_parts(candidates: DataFrame, percent: int = 100) -> DataFrame:
    """The phrases that stand in no longer one with at least ``percent`` of their count."""
    words = F.split("phrase", " ")
    longer = candidates.where("size > 2").select("lang", words.alias("w"), F.col("a").alias("f"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = longer.select("lang", "f", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1), lambda i: F.array_join(F.slice("w", i, F.col("m")), " "))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    inside = most.join(candidates.select("lang", "phrase", "a"), ["lang", "phrase"]).where(F.col("f") * 100 >= F.col("a") * percent)
    return candidates.join(inside.select("lang", "phrase"), ["lang", "phrase"], "left_anti")


def first_of_each(candidates: DataFrame, top: int = TOP) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = candidates.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)))
    parts = parts.withColumn("__nth", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("__nth") <= top)
    return parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("__part", "__nth")


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, size, a (its count), l and r (those of its parts at the worst cut), n (words of the language) and score."""
    phrases, totals = frequent_phrases(df, text, lang, least, **options)
    candidates = written(scored(phrases, totals), "phrases-scored")
    return first_of_each(without_parts(candidates), top)


_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) t(k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL
), n AS (
  SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= 100
), cuts AS (
  SELECT lang, size, phrase, a, words, unnest(range(1, size)) AS k FROM c
), sides AS (
  SELECT cuts.*, l.f AS l, r.f AS r, n.n, 1000::HUGEINT * a * n.n // (l.f::HUGEINT * r.f) AS score FROM cuts JOIN n USING (lang)
    JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(words[1 : cuts.k], ' ') JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(words[cuts.k + 1 :], ' ')
), worst AS (
  SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), subs AS (
  SELECT lang, a, words, m, unnest(range(1, size - m + 2)) AS i FROM (SELECT lang, a, words, size, unnest(range(2, size)) AS m FROM c)
), inner_most AS (
  SELECT lang, array_to_string(words[i : i + m - 1], ' ') AS phrase, max(a) AS f FROM subs GROUP BY ALL
), kept AS (
  SELECT * FROM worst WHERE NOT EXISTS (SELECT 1 FROM inner_most s WHERE s.lang = worst.lang AND s.phrase = worst.phrase AND 100 * s.f >= 100 * worst.a)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""


@query("op12_collocations", _SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
