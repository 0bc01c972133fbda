"""Best-fit packing of token ids into sequences, planned on the histogram of lengths.

Texts are encoded, an end id follows each, and documents longer than a
sequence are cut into whole sequences, of which the first piece may be shorter.
Only the number of pieces of each length goes to the driver: best fit with
decreasing lengths is played over those counts, with ranges of bins that have
the same room left in place of single bins. The plan is a list of segments: so
many pieces of a length, from such a rank on, lie in such a range of bins, from
such an offset on. A range that takes pieces keeps less than half of its room,
and each length splits two ranges at most, so the plan has a size that the
capacity alone bounds (about 40 segments for each length), however many
documents there are.

A piece finds its slot by its rank within its length: its number among the
pieces of that length in its own task, plus those of the tasks before. No
length is gathered in one task.

Null and empty texts are the end id alone. Repeated rows are packed each on its
own. Rows without an id are packed as well. An empty table gives no pieces.
Columns that have the name of a result are replaced. A text of any length is
encoded whole; what one document needs in memory is its own ids.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from playerflow.llm.registry import query, table
from playerflow.session import written

CAPACITY = 1024
END_ID = 2
#: The pattern of the byte-level files, with possessive repeats.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def _signs_to_bytes() -> dict[str, int]:
    """The printable signs of byte-level vocabularies, and the bytes they stand for."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class ByteEncoder:
    """Ids of texts for a byte-level BPE file whose ids follow the order of the merges."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if model["type"] != "BPE" or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or spec["normalizer"] or merged != sorted(merged):
            raise ValueError("not a plain byte-level file with ids in the order of its merges")
        signs = _signs_to_bytes()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        ranks = {bytes(signs[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special}
        self.plain = tiktoken.Encoding("pieces", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        ids, start = [], 0
        for match in self.special_pattern.finditer(text) if "<" in text else ():
            ids += [*self.plain(text[start : match.start()]), self.special[match.group()]]
            start = match.end()
        return ids + self.plain(text[start:]) if start else self.plain(text)


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


class Segment(NamedTuple):
    """``pieces`` pieces of ``length`` from rank ``rank`` on: ``each`` to a bin, bins from ``bin`` on, the first at ``offset``."""

    length: int
    rank: int
    pieces: int
    each: int
    bin: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Segment]:
    """Best fit, longest pieces first, over counts of lengths from 1 to ``capacity``."""
    open_bins: dict[int, list[tuple[int, int]]] = {}  # room left: ranges (first bin, bins)
    rooms: list[int] = []  # those of open_bins, sorted
    made: list[Segment] = []
    bins = 0

    def add(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            else:
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            each = room // length
            full = min(n, left // each)
            last = left - full * each if full < n else 0  # pieces of the one bin that the rest goes to
            for start, size, take in ((first, full, each), (first + full, 1 if last else 0, last)):
                if size:
                    made.append(Segment(length, rank, size * take, take, start, capacity - room))
                    add(room - take * length, start, size)
                    rank, left = rank + size * take, left - size * take
            done = full + (1 if last else 0)
            add(room, first + done, n - done)
    return made


def _pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """start and length of the pieces of ``n`` ids; the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    short = n % capacity
    return [*([(0, short)] if short else []), *((i, capacity) for i in range(short, n, capacity))]


def _little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = ids[:]
        ids.byteswap()
    return ids.tobytes()


_PIECE = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
_IDS = [("ids", T.ArrayType(T.LongType()))]
_PLACE = [("__task", T.LongType()), ("__nth", T.LongType())]
_SLOT = [("sequence_id", T.LongType()), ("offset", T.LongType())]


def cut_pieces(df: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, keep: list[str] | None = None) -> DataFrame:
    """One row per piece: ``keep`` columns, piece, start, length, ids_crc32, ids if asked for, and the place among the pieces of its length in its task."""
    file = path or public_tokenizers.path("byte_bpe_50k.json")
    own = [*_PIECE, *(_IDS if with_ids else []), *_PLACE]
    taken = {n.lower() for n, _ in [*own, *_IDS, *_SLOT]}
    kept = [c for c in (keep if keep is not None else df.columns) if c.lower() not in taken and (keep is not None or c != text)]
    source = df.select(*[df[c] for c in kept], df[text].alias("__value"))
    schema = T.StructType([source.schema[c] for c in kept] + [T.StructField(n, t) for n, t in own])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = byte_encoder(file), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            row, numbers, starts, lengths, sums, ids, nth = [], [], [], [], [], [], []
            for i, value in enumerate(batch.column(len(kept)).to_pylist()):
                found = array("I", encoder.encode(value))
                found.append(end_id)
                for number, (start, length) in enumerate(_pieces(len(found), capacity)):
                    part = found[start : start + length]
                    row.append(i)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(_little_endian(part)))
                    if with_ids:
                        ids.append(part.tolist())
                    nth.append(seen[length])
                    seen[length] += 1
            values = [numbers, starts, lengths, sums, *([ids] if with_ids else []), [task] * len(row), nth]
            columns = [batch.column(c).take(pa.array(row, pa.int64())) for c in range(len(kept))]
            columns += [pa.array(v, arrow.field(len(kept) + c).type) for c, v in enumerate(values)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def _take_slots(segments: list[Segment], schema: T.StructType):
    """Rows with length and ``__rank``: the segment that holds the rank gives bin and offset."""
    arrow = to_arrow_schema(schema)
    plan_of = np.array(sorted(segments), np.int64).reshape(-1, len(Segment._fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the plan in order of length and rank; a length begins with rank 0
        lengths, ranks, _, each, bins, offsets = plan_of.T
        heads, where = np.unique(lengths, return_index=True)
        ends = np.append(where[1:], len(lengths))
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "__rank"))
            at = np.empty(len(rank), np.int64)
            for h in np.unique(length):
                i = np.searchsorted(heads, h)
                rows = np.flatnonzero(length == h)
                at[rows] = where[i] + np.searchsorted(ranks[where[i] : ends[i]], rank[rows], "right") - 1
            inside = rank - ranks[at]
            slots = [bins[at] + inside // each[at], offsets[at] + inside % each[at] * length]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in schema.fields[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(s, pa.int64()) for s in slots]], names=arrow.names)

    return run


def pack(df: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, keep: list[str] | None = None) -> DataFrame:
    """One row per piece: ``keep`` columns (all but the text by default), piece, start, length, ids_crc32, ids, sequence_id and offset."""
    pieces = written(cut_pieces(df, text, path, capacity, end_id, with_ids, keep), "packing-pieces")
    held = written(pieces.groupBy("length", "__task").agg(F.count("*").alias("n")), "packing-counts")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__task")) - F.col("n")
    ranked = pieces.join(held.select("length", "__task", before.alias("__before")), ["length", "__task"])
    ranked = ranked.select(*[c for c in pieces.columns if c not in ("__task", "__nth")], (F.col("__before") + F.col("__nth")).alias("__rank"))
    schema = T.StructType([f for f in ranked.schema.fields if f.name != "__rank"] + [T.StructField(n, t) for n, t in _SLOT])
    return ranked.mapInArrow(_take_slots(plan(counts, capacity), schema), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, its ids and the number of its pieces, from the rows of ``pack`` with ids; a group has one sequence's ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"), F.count("*").alias("pieces"))


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), with_ids=False, keep=["doc_id"])
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
