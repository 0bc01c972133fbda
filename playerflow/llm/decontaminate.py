"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Windows of ``WINDOW`` words of the benchmark items (a shorter item is one
window) are hashed and broadcast; every window of every document is looked up
by its hash, and a hit counts only if the words are the same. The broadcast holds
hashes and words and is bounded: a benchmark with more windows or bytes than one
pass may hold is dealt by hash over several. The items of a window are joined to the hits at the end, so an
item list of any length is never broadcast.

Null and empty texts have no words and no hits; an item without words has no
window, an item without id hits but is not listed. Rows are told apart by
their id and the hash of their text: equal rows get equal results, and every
row keeps its own. An empty benchmark hits nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerflow.llm.native import let, lower_ascii
from playerflow.llm.quality_rules import window_keys
from playerflow.llm.registry import query, table
from playerflow.session import written


def _word(*ranges: str) -> str:
    """A run of characters outside these ranges of two hexadecimal codes, which are told one by one.

    The engine looks single characters up in one table, but tries each range of a class in turn.
    """
    codes = [code for span in ranges for code in range(int(span[:2], 16), int(span[3:], 16) + 1)]
    return "[^" + "".join(f"\\x{code:02X}" for code in codes) + "]+"


#: What lies outside 00-2F, 3A-60 and 7B-7F, in a text in lower case.
WORD = _word("00-2F", "3A-60", "7B-7F")
#: The same in a text that is not in lower case yet.
_EITHER_CASE = _word("00-2F", "3A-40", "5B-60", "7B-7F")
WINDOW = 10
#: Most windows, and bytes of their words, in one broadcast.
BROADCAST_WINDOWS = 200_000
BROADCAST_BYTES = 32 * 1024**2


def normal_words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, text: str = "text", item: str = "item_id", width: int = WINDOW) -> DataFrame:
    """key, n, grams (the words) and item of each window of each item, once."""
    rows = benchmark.select(benchmark[item].alias("item"), normal_words(benchmark[text]).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(width))
    grams = rows.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))).alias("grams"))
    return grams.distinct().select(_key(F.col("grams"), width).alias("key"), F.size("grams").alias("n"), "grams", "item")


def _key(grams: Column, width: int) -> Column:
    """The key that ``window_keys`` gives a window of as many words."""
    return reduce(lambda rest, n: F.when(F.size(grams) == n, F.get(window_keys(grams, n), F.lit(0))).otherwise(rest), range(1, width + 1), F.lit(None).cast("long"))


def _hits(df: DataFrame, benchmark: DataFrame, text: str, key: str, width: int, broadcast_windows: int) -> tuple[DataFrame, DataFrame]:
    """The windows of the benchmark, and the hits: ``__key``, ``__hash`` (of the text), at, n, key and grams; written tables."""
    windows = written(benchmark_windows(benchmark, width=width), "benchmark-windows")
    distinct = windows.select("key", "n", "grams").distinct()
    sizes = distinct.groupBy("n").agg(F.count("*").alias("windows"), F.sum(F.octet_length(F.array_join("grams", " "))).alias("bytes")).collect()
    total, size = sum(r["windows"] for r in sizes), sum(r["bytes"] for r in sizes)
    passes = max(1, -(-total // broadcast_windows), -(-size // BROADCAST_BYTES))
    lengths = sorted(r["n"] for r in sizes) or [width]
    value = F.coalesce(df[text], F.lit(""))
    words = df.select(df[key].alias("__key"), F.xxhash64(value).alias("__hash"), normal_words(value).alias("w"))

    def placed(n: int) -> Column:
        return F.transform(window_keys(F.col("w"), n), lambda k, i: F.struct(k.alias("key"), i.alias("at"), F.lit(n).alias("n"), F.slice("w", i + 1, n).alias("grams")))

    # a row has its own window's words only, so a text's work grows with its length
    looked = words.select("__key", "__hash", F.explode(F.concat(*map(placed, lengths))).alias("x")).select("__key", "__hash", "x.*")
    found = []
    for i in range(passes):
        part = distinct.where(F.pmod("key", F.lit(passes)) == i) if passes > 1 else distinct
        part = F.broadcast(part.select(F.col("key").alias("bkey"), F.col("grams").alias("bgrams")))
        # as two inequalities, the words are no join key and only looked at where the hash is there
        same = (F.col("key") == F.col("bkey")) & (F.col("grams") >= F.col("bgrams")) & (F.col("grams") <= F.col("bgrams"))
        found.append(looked.join(part, same).select(*looked.columns))
    return windows, written(reduce(DataFrame.unionAll, found).distinct(), "benchmark-hits")


def find_hits(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", width: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document with hits: ``__key``, ``__hash`` (of the text), places (spans of words) and items."""
    windows, hits = _hits(df, benchmark, text, key, width, broadcast_windows)
    doc = ["__key", "__hash"]
    places = hits.groupBy(*doc).agg(F.collect_set(F.struct("at", "n")).alias("places"))
    items = hits.select(*doc, "key", "grams").distinct().join(windows.select("key", "grams", "item"), ["key", "grams"])
    items = items.groupBy(*doc).agg(F.collect_set("item").alias("items")).withColumnsRenamed({"__key": "k", "__hash": "h"})
    return places.join(items, F.col("__key").eqNullSafe(F.col("k")) & (F.col("__hash") == F.col("h"))).select(*doc, "places", "items")


def words_hit(places: Column) -> Column:
    """Words inside one place at least."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.sort_array(places), start,
        lambda a, p: F.struct((a["n"] + F.greatest(F.lit(0), p["at"] + p["n"] - F.greatest(p["at"], a["end"]))).alias("n"), F.greatest(a["end"], p["at"] + p["n"]).alias("end")),
        lambda a: a["n"],
    ).cast("long")


def report(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", keep: list[str] | None = None, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``keep`` columns with n_words, n_hit, n_items, items (ids as sorted text), places and contaminated."""
    kept = [c for c in (keep if keep is not None else [c for c in df.columns if c != text]) if c.lower() not in ("n_words", "n_hit", "n_items", "items", "places", "contaminated")]
    hits = find_hits(df, benchmark, text, key, broadcast_windows=broadcast_windows)
    value = F.coalesce(df[text], F.lit(""))
    rows = df.select(*[df[c] for c in kept], df[key].alias("__d"), F.xxhash64(value).alias("__h"), F.regexp_count(value, F.lit(_EITHER_CASE)).cast("long").alias("n_words"))
    joined = rows.join(hits, rows["__d"].eqNullSafe(hits["__key"]) & (rows["__h"] == hits["__hash"]), "left")
    items = F.coalesce(F.array_sort(F.transform("items", lambda i: i.cast("string"))), F.array().cast("array<string>"))
    return joined.select(
        *[rows[c] for c in kept], "n_words", F.when(F.col("places").isNull(), 0).otherwise(words_hit(F.col("places"))).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), items.alias("items"), "places", F.col("places").isNotNull().alias("contaminated"),
    )


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows without a hit, unchanged."""
    hits = _hits(df, benchmark, text, key, WINDOW, BROADCAST_WINDOWS)[1].select("__key", "__hash").distinct()
    same = df[key].eqNullSafe(hits["__key"]) & (F.xxhash64(F.coalesce(df[text], F.lit(""))) == hits["__hash"])
    return df.join(hits, same, "left_anti")


def cut_spans(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows; in those with hits the words hit are taken out of the text, what stands between words stays."""
    hits = find_hits(df, benchmark, text, key).select("__key", "__hash", "places")
    same = df[key].eqNullSafe(hits["__key"]) & (F.xxhash64(F.coalesce(df[text], F.lit(""))) == hits["__hash"])
    own, gaps = F.regexp_extract_all(df[text], F.lit(_EITHER_CASE), F.lit(0)), F.split(df[text], _EITHER_CASE, -1)
    gone = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["at"], p["at"] + p["n"] - 1))))
    cut = let(F.struct(own.alias("w"), F.array_sort(gone).alias("gone")), lambda s: F.array_join(
        F.transform(gaps, lambda g, i: F.concat(g, F.when(F.array_contains(s["gone"], i), "").otherwise(F.coalesce(F.get(s["w"], i), F.lit(""))))), ""))
    return df.join(hits, same, "left").select(*[F.when(F.col("places").isNull(), df[c]).otherwise(cut).alias(c) if c == text else df[c] for c in df.columns])


_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wide AS (
  SELECT item_id, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, n, w[i : i + n - 1] AS g FROM wide
), places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n
), hits AS (
  SELECT p.doc_id, p.i, p.n, v.item_id FROM (SELECT doc_id, n, i, w[i : i + n - 1] AS g FROM places) p JOIN win v ON p.n = v.n AND p.g = v.g
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op9_decontaminate", _SQL)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
