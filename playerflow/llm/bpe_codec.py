"""BPE encoding by forced boundaries, and decoding.

Two neighbouring symbols that stand side by side inside no token of the
vocabulary can never end up in one token, so the place between them is a
certain cut. Words are cut there, the fragments are merged each on its own,
and their ids are concatenated. Fragments repeat far more often than words or
texts; each task remembers those of its rows in caches of bounded size.

Null and empty texts have no ids and decode to the empty text. Special tokens
spelled in a text become their ids, as in the library of the file. Repeated
rows stay repeated.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from playerflow.llm.batches import map_values
from playerflow.llm.caches import Generations
from playerflow.llm.registry import query, table

#: Words in one generation of a task's cache.
CACHE_ENTRIES = 200_000
#: Symbols from which on merging uses a heap.
LONG_FRAGMENT = 48
#: Words that composition leaves alone and that the pre-tokenizer cuts in two at most: letters, then marks.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&*$#]*)")


def _byte_signs() -> list[str]:
    """The printable sign that byte-level vocabularies write for each byte: itself, or the next free one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


_BYTE_SIGNS = _byte_signs()


class BoundaryCodec:
    """Encoder and decoder of one tokenizer file with byte-level BPE and word ends."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.inside = {pair for token in self.vocab for pair in self._pairs(self.symbols_of(token))}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.special.values()], default=-1))
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.words = Generations(cache_entries, self._encode_word)
        self.fragments = Generations(cache_entries, self._encode_fragment)

    @staticmethod
    def _pairs(symbols: list[str]):
        return zip(symbols, symbols[1:])

    def symbols_of(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            stem = token.removesuffix(self.end)
            return [*stem[:-1], stem[-1] + self.end]
        return list(token)

    def encode(self, text: str | None) -> array:
        """Ids of a text.

        Words between blanks and line ends are looked up as they are spelled:
        neither of the two characters composes with a neighbour, so a word is
        normalised alone as it is in its text.
        """
        ids = array("I")
        if not text:
            return ids
        start = 0
        for match in self.special_pattern.finditer(text) if "<" in text else ():
            self._encode_plain(text[start : match.start()], ids)
            ids.append(self.special[match.group()])
            start = match.end()
        self._encode_plain(text[start:] if start else text, ids)
        return ids

    def _encode_plain(self, text: str, ids: array) -> None:
        if text.isascii():
            text = text.lower()
        ids.frombytes(b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" "))))

    def _encode_word(self, word: str) -> bytes:
        """The ids of a word, in this machine's byte order."""
        plain = _PLAIN.fullmatch(word)
        if plain:
            stem = plain[1].lower()
            parts = [stem if stem.isascii() else "".join(map(_BYTE_SIGNS.__getitem__, stem.encode()))]
            parts += [plain[2]] if plain[2] else []
        else:
            parts = [p for p, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(word))] if word else []
        return b"".join(self._encode_part(p) for p in parts)

    def _encode_part(self, part: str) -> bytes:
        symbols = [*part[:-1], part[-1] + self.end]
        inside = self.inside
        cuts = [i for i, pair in enumerate(self._pairs(symbols), 1) if pair not in inside]
        if not cuts:
            return self._encode_fragment(tuple(symbols))
        return b"".join(self.fragments[tuple(symbols[a:b])] for a, b in zip([0, *cuts], [*cuts, len(symbols)]))

    def _encode_fragment(self, symbols: tuple[str, ...]) -> bytes:
        return array("I", [self.vocab[s] for s in self.merge(list(symbols))]).tobytes()

    def merge(self, parts: list[str]) -> list[str]:
        """Lowest rank first, leftmost first among equals."""
        if len(parts) > LONG_FRAGMENT:
            return self._merge_long(parts)
        ranks, none = self.ranks.get, len(self.ranks)
        found = [ranks(pair, none) for pair in self._pairs(parts)]
        while found and (low := min(found)) < none:
            i = found.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = ranks((parts[i - 1], parts[i]), none)
            if i < len(found):
                found[i] = ranks((parts[i], parts[i + 1]), none)
        return parts

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap, for the rare fragments that are long."""
        size = len(symbols)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        heap = [(r, i, p) for i, p in enumerate(self._pairs(symbols)) if (r := self.ranks.get(p)) is not None]
        heapq.heapify(heap)
        parts: list[str | None] = list(symbols)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= size or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = pair[0] + pair[1], None
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < size:
                    new = (parts[left], parts[right])
                    if (rank := self.ranks.get(new)) is not None:
                        heapq.heappush(heap, (rank, left, new))
        return [p for p in parts if p is not None]

    def decode(self, ids) -> str:
        """The tokens side by side with a blank between, which is what a file without a decoder means."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def boundary_codec(path: str, cache_entries: int = CACHE_ENTRIES) -> BoundaryCodec:
    return BoundaryCodec(path, cache_entries)


def _little_endian(ids: array) -> bytes:
    import sys

    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


_OUTPUTS = {
    "n_tokens": T.LongType(), "ids": T.ArrayType(T.LongType()), "decoded": T.StringType(),
    "ids_sha256": T.StringType(), "decoded_sha256": T.StringType(),
}


def encode_decode(df: DataFrame, text: str = "text", path: str | None = None, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), keep: list[str] | None = None, cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """``keep`` columns with ``outputs``: any of n_tokens, ids, decoded, ids_sha256, decoded_sha256."""
    file = path or public_tokenizers.path("word_bpe_49k.json")
    added = T.StructType([T.StructField(name, _OUTPUTS[name]) for name in outputs])

    def make():
        codec = boundary_codec(file, cache_entries)

        def apply(texts: list) -> list[list]:
            found: dict[str, list] = {name: [] for name in outputs}
            for text in texts:
                ids = codec.encode(text)
                decoded = codec.decode(ids) if "decoded" in found or "decoded_sha256" in found else ""
                for name, values in found.items():
                    if name == "n_tokens":
                        values.append(len(ids))
                    elif name == "ids":
                        values.append(ids.tolist())
                    elif name == "decoded":
                        values.append(decoded)
                    elif name == "ids_sha256":
                        values.append(hashlib.sha256(_little_endian(ids)).hexdigest())
                    else:
                        values.append(hashlib.sha256(decoded.encode()).hexdigest())
            return list(found.values())

        return apply

    return map_values(df, text, added, make, keep)


@query("op3_bpe_codec")
def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"), keep=["doc_id"])
