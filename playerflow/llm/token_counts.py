"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A text's count is its initial symbols minus its merges. Symbols are the
characters after the model's own white-space escape; a character outside the
vocabulary counts as its UTF-8 bytes. Merging is done per fragment: a fragment
ends where no piece of the vocabulary has the two neighbouring kinds of
characters side by side, which is checked against the vocabulary when it is
loaded. Fragments repeat, so each task remembers their counts in a cache of
bounded size.

Null and empty texts have 0 tokens and 0 bytes. Repeated rows stay repeated.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerflow.llm.batches import map_values
from playerflow.llm.caches import Generations
from playerflow.llm.registry import query, table

SPACE = "▁"
#: Fragments in one generation of a task's cache.
CACHE_ENTRIES = 300_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: From fine to coarse; the first whose cuts no piece crosses is used.
_FRAGMENTS = (
    rf"{SPACE}*[{_LETTERS}]+|{SPACE}*[^{_LETTERS}{SPACE}\n]+|\n|{SPACE}+",
    rf"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+",
    rf"{SPACE}*[^{SPACE}]+|{SPACE}+",
)


class PieceCounter:
    """Counts of one vocabulary: ``ranks`` has the rank of each piece, lower merges first."""

    def __init__(self, ranks: dict[str, int], cache_entries: int = CACHE_ENTRIES):
        self.ranks = ranks
        self.counts = Generations(cache_entries, self.count_fragment)
        self.fragments = next((p for p in map(re.compile, _FRAGMENTS) if self._safe(p)), None)
        if self.fragments is None:
            raise ValueError("the vocabulary has pieces that go on after a white-space mark")
        if not all(c in ranks for piece in ranks for c in piece):
            raise ValueError("the vocabulary has pieces with characters that are no pieces")

    def _safe(self, pattern: re.Pattern) -> bool:
        """No piece of more than one character holds a cut of the pattern."""
        return all(len(pattern.findall(p)) == 1 for p in self.ranks if len(p) > 1)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.counts.__getitem__, self.fragments.findall(SPACE + text.replace(" ", SPACE))))

    def count_fragment(self, fragment: str) -> int:
        """Initial symbols minus merges.

        A symbol is its start in the fragment; ``after`` links it to the next
        one and ``before`` to the previous. A heap entry packs rank, start and
        end of a pair, so that the lowest rank comes first, the leftmost among
        equals; it is stale when the pair no longer has that start and end.
        """
        rank_of, size = self.ranks.get, len(fragment)
        width = size.bit_length()
        mask = (1 << width) - 1
        heap = [((r << width | i) << width) | i + 2 for i in range(size - 1) if (r := rank_of(fragment[i : i + 2])) is not None]
        heapq.heapify(heap)
        after, before = list(range(1, size + 2)), list(range(-1, size))
        merges = 0
        while heap:
            entry = heapq.heappop(heap)
            end, start = entry & mask, entry >> width & mask
            middle = after[start]
            if not 0 < middle < size or after[middle] != end:
                continue
            merges += 1
            after[start], after[middle], before[end] = end, 0, start
            left = before[start]
            if left >= 0 and (r := rank_of(fragment[left:end])) is not None:
                heapq.heappush(heap, ((r << width | left) << width) | end)
            if end < size and (r := rank_of(fragment[start : (right := after[end])])) is not None:
                heapq.heappush(heap, ((r << width | start) << width) | right)
        symbols = size if all(c in self.ranks for c in fragment) else sum(1 if c in self.ranks else len(c.encode()) for c in fragment)
        return symbols - merges


@lru_cache(maxsize=2)
def piece_counter(model: str, cache_entries: int = CACHE_ENTRIES) -> PieceCounter:
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_file=model)
    odd = [i for i in range(loaded.vocab_size()) if loaded.is_unknown(i) or loaded.is_control(i) or loaded.is_byte(i) or loaded.is_unused(i)]
    normal = set(range(loaded.vocab_size())) - set(odd)
    scores = {loaded.id_to_piece(i): loaded.get_score(i) for i in normal}
    order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
    return PieceCounter({piece: order[score] for piece, score in scores.items()}, cache_entries)


def count_tokens(df: DataFrame, text: str = "text", model: str | None = None, limit: int = 4096, keep: list[str] | None = None, cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """``keep`` columns with n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    added = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def make():
        counter = piece_counter(path, cache_entries)

        def apply(texts: list) -> list[list]:
            return [[len(t.encode()) if t else 0 for t in texts], [counter.count(t) for t in texts]]

        return apply

    return map_values(df, text, added, make, keep).withColumn("over_limit", F.col("n_tokens") > limit)


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), keep=["doc_id"])
