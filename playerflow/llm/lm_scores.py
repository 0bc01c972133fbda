"""Stupid-backoff scores of documents, by joining n-gram count tables.

The counts come from all documents; a document is scored by what the others
hold, so its own n-grams are taken off before it is scored. A word's score is
its n-gram's count over the count of the words before it, or ``BACKOFF``
times the score of the next shorter n-gram where that is zero. A word that no
other document has counts as ``BACKOFF`` over all words.

Documents are dealt into blocks of a bounded number of words. A block sends
each of its distinct n-grams once, with its count, into a table partitioned by
ranges of the n-gram's hash (segments of a bounded number of n-grams), where
the counts of all blocks are summed; what the other blocks hold is joined back
to the block, and the words' scores are summed per document. So neither a
frequent n-gram nor a large source makes a hot task: an n-gram has one entry
per block at most. The entries of one block in one segment travel as one
packed row of sorted hashes, which takes half the room of single rows. There are never more rows than
n-grams in blocks, so the table grows with the corpus. Inside a task a block's
n-grams are sorted a range of segments at a time, which keeps the task small.

Null and empty texts have no words and the score 0. Equal rows are scored
alike and count for each other. Columns of the same names are replaced. Words
and n-grams are 64-bit keys.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playerflow.llm.native import blank_words, lower_ascii
from playerflow.llm.registry import query, table
from playerflow.session import written

ORDER = 3
BACKOFF = 0.4
#: Words from which on a block is full; a document stays whole.
BLOCK_WORDS = 6_000_000
#: Ranges in which a task goes through the n-grams of a block.
RANGES = 16
#: Words of a block that are scored at a time.
PIECE_WORDS = 500_000
#: Words of the corpus for each segment of the count table.
SEGMENT_WORDS = 500_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of their places: sorted differences and small numbers come out short."""
    values = values.astype("<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : packed[0]] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed), dtype=np.uint64)


def _grams(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of n words, by their first place, and which of them lie inside a document."""
    size = max(len(words) - n + 1, 0)
    keys = _mix(words[:size] + np.uint64(n))
    for k in range(1, n):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + words[k : size + k])
    return keys, doc[n - 1 :] == doc[:size]


def _ranges(words: np.ndarray, doc: np.ndarray, order: int, segments: int) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """Ranges of segments, in turn: the segments, the block's n-grams in them, and a slot for each.

    The slot is the place of the last word, plus all places for each word more than one.
    """
    grams = [_grams(words, doc, n) for n in range(1, order + 1)]
    step = -(-segments // RANGES)
    for start in range(0, segments, step):
        among = range(start, min(start + step, segments))
        low, high = (np.uint64(min(-(-(s << 32) // segments) << 32, 2**64 - 1)) for s in (among.start, among.stop))
        last = among.stop == segments
        at = [np.flatnonzero(inside & (keys >= low) & (last | (keys < high))) for keys, inside in grams]
        yield among, np.concatenate([keys[i] for (keys, _), i in zip(grams, at)]), np.concatenate([i + n * (len(words) + 1) for n, i in enumerate(at)])


def _segment(grams: np.ndarray, segments: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _blocks(block_words: int, id_type: pa.DataType):
    names = ["block", "ids", "lengths", "words", "vocabulary", "total"]

    def full(number: int, ids: list, lengths: list, words: list) -> pa.RecordBatch:
        vocabulary, local, counts = np.unique(np.concatenate(words).view(np.uint64), return_inverse=True, return_counts=True)
        by_use = np.argsort(-counts, kind="stable")  # frequent words get small numbers; equally frequent ones stay sorted
        rank = np.empty(len(vocabulary), np.int64)
        rank[by_use] = np.arange(len(vocabulary))
        columns = [
            pa.array([number], pa.int64()), pa.array([[i for part in ids for i in part]], pa.list_(id_type)), pa.array([_pack(np.concatenate(lengths))], pa.binary()),
            pa.array([_pack(rank[local])], pa.binary()), pa.array([_pack_sorted(vocabulary[by_use])], pa.binary()), pa.array([len(local)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, lengths, words, held = TaskContext.get().partitionId() << 24, [], [], [], 0
        for batch in batches:
            lists = batch.column(1)
            ends, values, start = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False), 0
            while start < len(batch):  # a batch may hold several blocks
                stop = min(max(int(np.searchsorted(ends, ends[start] + block_words - held)), start + 1), len(batch))
                ids.append(batch.column(0).slice(start, stop - start).to_pylist())
                lengths.append(np.diff(ends[start : stop + 1]))
                words.append(values[ends[start] : ends[stop]])
                held += len(words[-1])
                if held >= block_words:
                    yield full(number, ids, lengths, words)
                    number, ids, lengths, words, held = number + 1, [], [], [], 0
                start = stop
        if ids:
            yield full(number, ids, lengths, words)

    return run


def _open(lengths: bytes, words: bytes, vocabulary: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word keys, the document's place in the block for each word, and words per document."""
    sizes = _unpack(lengths).astype(np.int64)
    return _unpack_sorted(vocabulary)[_unpack(words).astype(np.int64)], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), sizes


def _count(order: int, segments: int):
    """Each block's distinct n-grams and their counts, a row for each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, lengths, words, vocabulary in zip(*(c.to_pylist() for c in batch.columns)):
                keys, doc, _ = _open(lengths, words, vocabulary)
                for _, grams, _ in _ranges(keys, doc, order, segments):
                    grams, counts = np.unique(grams, return_counts=True)
                    held, starts = np.unique(_segment(grams, segments), return_index=True)
                    for segment, start, end in zip(held, starts, [*starts[1:], len(grams)]):
                        columns = [pa.array([segment], pa.int64()), pa.array([number], pa.int64()), pa.array([_pack_sorted(grams[start:end])], pa.binary()), pa.array([_pack(counts[start:end])], pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names=["segment", "block", "grams", "counts"])

    return run


def _sum(rows: pa.Table) -> pa.Table:
    """For each block of a segment and each of its n-grams: how often the other blocks hold it."""
    grams = [_unpack_sorted(x) for x in rows.column("grams").to_pylist()]
    counts = [_unpack(x) for x in rows.column("counts").to_pylist()]
    every, own = np.concatenate(grams), np.concatenate(counts).astype(np.int64)
    order = np.argsort(every, kind="stable")
    first = np.append(True, every[order][1:] != every[order][:-1])
    which = np.cumsum(first) - 1
    others = np.empty(len(every), np.int64)
    others[order] = np.add.reduceat(own[order], np.flatnonzero(first))[which]
    others -= own
    ends = np.cumsum([len(x) for x in grams])
    packed = [_pack(others[end - len(x) : end]) for x, end in zip(grams, ends)]
    return pa.table({"block": rows.column("block"), "segment": rows.column("segment"), "others": pa.array(packed, pa.binary())})


def _run_sizes(starts: np.ndarray) -> np.ndarray:
    return np.diff(np.append(np.flatnonzero(starts), len(starts)))


def _score(order: int, segments: int, backoff: float, corpus_words: int, piece_words: int, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        row = left.to_pylist()[0]
        keys, doc, sizes = _open(row["lengths"], row["words"], row["vocabulary"])
        packed = dict(zip(right.column("segment").to_pylist(), right.column("others").to_pylist()))
        # For each n: in how many places of other documents the n-gram that ends here stands.
        found = np.zeros(order * len(keys), np.int64)
        for among, grams, slots in _ranges(keys, doc, order, segments):
            if not len(grams):
                continue
            elsewhere = np.concatenate([_unpack(packed[s]) for s in among if s in packed]).astype(np.int64)
            # equal n-grams side by side, and among them those of one document
            sort = np.argsort(grams, kind="stable")
            grams, slots = grams[sort], slots[sort]
            of = doc[slots % len(keys)]
            first = np.append(True, grams[1:] != grams[:-1])
            own_first = first | np.append(True, of[1:] != of[:-1])
            found[slots] = (_run_sizes(first) + elsewhere)[np.cumsum(first) - 1] - _run_sizes(own_first)[np.cumsum(own_first) - 1]
        others = found.reshape(order, len(keys))
        starts = np.cumsum(sizes) - sizes
        total, by_length = np.zeros(len(sizes)), np.zeros((order + 1, len(sizes)), np.int64)
        for low in range(0, len(keys), piece_words):
            index = doc[low : low + piece_words].astype(np.int64)
            here = slice(low, low + len(index))
            base, place = index[0], np.arange(low, here.stop) - starts[index]
            score = np.log(np.maximum(others[0, here], backoff) / np.maximum(corpus_words - sizes[index], 1))
            used = np.where(others[0, here] > 0, 1, 0)
            for n in range(2, order + 1):
                # the words before this one, as an n-gram that ended there
                before = others[n - 2, low - 1 : here.stop - 1] if low else np.append(0, others[n - 2, : here.stop - 1])
                seen = (others[n - 1, here] > 0) & (before > 0)
                ratio = np.log(np.where(seen, others[n - 1, here], 1) / np.where(seen, before, 1))
                score = np.where(seen, ratio, np.where(place >= n - 1, np.log(backoff) + score, score))
                used = np.where(seen, n, used)
            docs = slice(base, index[-1] + 1)
            total[docs] += np.bincount(index - base, score)
            for n in range(order + 1):
                by_length[n, docs] += np.bincount(index[used == n] - base, minlength=docs.stop - base)
        columns = [pa.array(row["ids"], schema.field(0).type), pa.array(sizes), pa.array(total), *map(pa.array, by_length)]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def score_documents(df: DataFrame, text: str = "text", key: str = "doc_id", order: int = ORDER, backoff: float = BACKOFF, block_words: int = BLOCK_WORDS, segment_words: int = SEGMENT_WORDS, piece_words: int = PIECE_WORDS) -> DataFrame:
    """key, n_words, log_score (the sum over the words) and used_0 to used_<order>: words scored by an n-gram of that length (0: unseen)."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    id_field = df.schema[key]
    words = F.transform(blank_words(lower_ascii(F.coalesce(df[text], F.lit("")))), lambda w: F.xxhash64(w))
    id_type = to_arrow_schema(T.StructType([id_field])).field(0).type
    blocks = df.select(df[key].alias("id"), words.alias("words")).mapInArrow(
        _blocks(block_words, id_type), f"block long, ids array<{id_field.dataType.simpleString()}>, lengths binary, words binary, vocabulary binary, total long")
    blocks = written(blocks, "lm-blocks")
    corpus_words = blocks.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()["n"]
    segments = max(1, -(-corpus_words // segment_words))
    counts = blocks.select("block", "lengths", "words", "vocabulary").mapInArrow(_count(order, segments), "segment long, block long, grams binary, counts binary")
    totals = counts.groupBy("segment").applyInArrow(_sum, "block long, segment long, others binary")
    result = T.StructType([T.StructField(key, id_field.dataType), T.StructField("n_words", T.LongType()), T.StructField("log_score", T.DoubleType()), *[T.StructField(f"used_{n}", T.LongType()) for n in range(order + 1)]])
    run = _score(order, segments, backoff, corpus_words, piece_words, to_arrow_schema(result))
    return blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(run, result)


_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), placed AS (
  SELECT doc_id, len(w) AS n, unnest(range(1, len(w) + 1)) AS i, w FROM docs
), g AS (
  SELECT doc_id, n, i, w[i] AS g1, CASE WHEN i > 1 THEN w[i - 1 : i] END AS g2, CASE WHEN i > 2 THEN w[i - 2 : i] END AS g3 FROM placed
), counted AS (
  SELECT doc_id, n, i, (SELECT count(*) FROM g) - n AS rest,
    count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY doc_id, g1) AS c1,
    CASE WHEN g2 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY doc_id, g2) END AS c2,
    CASE WHEN g3 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY doc_id, g3) END AS c3
  FROM g
), looked AS (
  SELECT *, coalesce(lag(c1) OVER d, 0) AS b1, coalesce(lag(c2) OVER d, 0) AS b2 FROM counted WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), scored AS (
  SELECT doc_id,
    CASE WHEN c3 > 0 AND b2 > 0 THEN 3 WHEN c2 > 0 AND b1 > 0 THEN 2 WHEN c1 > 0 THEN 1 ELSE 0 END AS used,
    CASE WHEN c3 > 0 AND b2 > 0 THEN ln(c3 / b2)
      ELSE CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END + CASE WHEN c2 > 0 AND b1 > 0 THEN ln(c2 / b1)
        ELSE CASE WHEN i > 1 THEN ln(0.4) ELSE 0 END + ln(greatest(c1, 0.4) / greatest(rest, 1)) END END AS score
  FROM looked
), summed AS (
  SELECT doc_id, round(sum(score), 3) AS log_score, count(*) FILTER (used = 0) AS used_0, count(*) FILTER (used = 1) AS used_1,
    count(*) FILTER (used = 2) AS used_2, count(*) FILTER (used = 3) AS used_3
  FROM scored GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(log_score, 0)::DOUBLE AS log_score, coalesce(used_0, 0)::BIGINT AS used_0, coalesce(used_1, 0)::BIGINT AS used_1,
  coalesce(used_2, 0)::BIGINT AS used_2, coalesce(used_3, 0)::BIGINT AS used_3
FROM docs LEFT JOIN summed USING (doc_id)
"""


@query("op2_lm_scores", _SQL)
def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents")).withColumn("log_score", F.round("log_score", 3))
