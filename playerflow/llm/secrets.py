"""Secrets: fixed patterns, and random strings told from identifiers by two character Markov models.

The two models are first-order: how likely each character follows the one
before it, in random strings and in ordinary identifiers. Both are counted on
labelled strings of a sample of documents of bounded size: values that the
fixed patterns found and digests of ids are labelled random; all distinct words
of a sampled text, alone and joined as identifiers, are labelled ordinary. A
candidate, a run of 16 or more characters with a letter, is a secret if the
log-likelihood ratio of its characters is above a margin, it has eight different
characters (a line of one sign is rare in texts, but not random) and no fixed
pattern has found it already.

Null texts count as empty and have no spans. Repeated rows keep their own
results. Texts of any length are read whole. Columns of the same names are
replaced. Positions are code points, the end is exclusive.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerflow.llm.native import let, match_spans
from playerflow.llm.registry import query, table
from playerflow.llm.sampling import sample_rows

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
_RUN = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{_RUN}])(?=[0-9+/_=-]*[A-Za-z])[{_RUN}]{{16,}}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_STATES = len(ALPHABET) + 1
#: Documents, about, whose strings train the models.
SAMPLE_DOCUMENTS = 4_000
#: Log-likelihood ratio, in nats, from which on a candidate is random.
MARGIN = 7.0
#: Different characters that a random string has at least.
DIFFERENT = 8
#: Weights of single characters, and of any character, beside those of pairs.
FALL_BACK = (0.15, 0.05)


def _assigned(text: Column) -> Column:
    """Assignments whose value has six characters or more; a shorter value still uses up its text."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    spans = match_spans(text, ASSIGN)
    long = let(values, lambda v: let(spans, lambda s: F.filter(s, lambda x, i: F.length(F.get(v, i)) >= 6)))
    return F.when(text.rlike("(?i:password|passwd|secret|token|api_?key)"), long).otherwise(match_spans(F.lit(""), "x"))


def base_spans(text: Column) -> list[Column]:
    """Spans of each fixed kind, in the order of KINDS."""
    return [_assigned(text), match_spans(text, ACCESS), match_spans(text, HEX)]


def _pair_indexes(value: Column) -> Column:
    signs = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return let(signs, lambda s: F.transform(F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0))), lambda c, i: F.get(s, i) * _STATES + c))


def train(df: DataFrame, text: str = "text", key: str = "doc_id", sample_documents: int = SAMPLE_DOCUMENTS) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each pair of characters."""
    sample = df.select(df[key].cast("string").alias("k"), F.coalesce(df[text], F.lit("")).alias("t"))
    sample = sample_rows(sample, sample_documents, "k", "t")
    digest = F.sha2(F.coalesce("k", F.lit("")), 256)
    random = F.concat(
        F.flatten(F.array(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("t", F.lit(HEX), F.lit(0)))),
        F.array(digest, F.upper(digest), F.base64(F.unhex(digest)), F.base64(F.unhex(F.sha2(F.coalesce("k", F.lit("")), 512))), F.translate(F.base64(F.unhex(F.md5("k"))), "+/", "-_")),
    )
    words = F.array_distinct(F.regexp_extract_all("t", F.lit("[A-Za-z]{2,}"), F.lit(0)))
    ordinary = let(words, lambda w: F.concat(w, F.transform(w, lambda x, i: F.concat(x, F.element_at(F.array(*map(F.lit, "_-/.")), (i % 4 + 1).cast("int")), F.coalesce(F.get(w, i + 1), F.lit("")), F.lit("_"), i.cast("string")))))
    strings = sample.select(F.explode(F.array(F.struct(F.lit(1).alias("label"), random.alias("s")), F.struct(F.lit(0).alias("label"), ordinary.alias("s")))).alias("x"))
    pairs = strings.select("x.label", F.explode("x.s").alias("s")).select("label", F.explode(_pair_indexes(F.col("s"))).alias("pair"))
    counts = {(r["label"], r["pair"]): r["count"] for r in pairs.groupBy("label", "pair").count().collect()}
    states = range(_STATES)
    before = {(label, a): sum(counts.get((label, a * _STATES + b), 0) for b in states) for label in (0, 1) for a in states}
    alone = {(label, b): sum(counts.get((label, a * _STATES + b), 0) for a in states) for label in (0, 1) for b in states}

    total = {label: max(sum(alone[label, b] for b in states), 1) for label in (0, 1)}

    def chance(label: int, a: int, b: int) -> float:
        """Of b after a; a pair that the sample lacks falls back on how frequent b is, then on one of all signs."""
        pair = counts.get((label, a * _STATES + b), 0) / max(before[label, a], 1)
        single = alone[label, b] / total[label]
        return (1 - sum(FALL_BACK)) * pair + FALL_BACK[0] * single + FALL_BACK[1] / _STATES

    return [round(math.log(chance(1, a, b) / chance(0, a, b)), 6) for a in states for b in states]


def log_ratio(value: Column, ratios: list[float]) -> Column:
    """Sum over the characters of a string."""
    known = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    return F.aggregate(_pair_indexes(value), F.lit(0.0), lambda total, pair: total + F.get(known, pair))


def find_secrets(df: DataFrame, ratios: list[float], text: str = "text", keep: list[str] | None = None, margin: float = MARGIN) -> DataFrame:
    """``keep`` columns with ``secrets``: array<struct<start, kind, end, value>> by start, then kind.

    ``kind`` counts the kinds of KINDS from 0.
    """
    kept = [c for c in (keep if keep is not None else [c for c in df.columns if c != text]) if c.lower() != "secrets"]
    rows = df.select(*[df[c] for c in kept], F.coalesce(df[text], F.lit("")).alias("__text"))
    t = F.col("__text")
    rows = rows.select(*kept, _tagged(base_spans(t)).alias("__base"), match_spans(t, CANDIDATE).alias("__run"))
    free = F.filter("__run", lambda c: ~F.exists("__base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    random = F.filter(free, lambda c: (log_ratio(c["value"], ratios) > margin) & (F.size(F.array_distinct(F.split(c["value"], ""))) >= DIFFERENT))
    found = F.when(F.size("__run") > 0, F.concat("__base", _tagged([random], 3))).otherwise(F.col("__base"))
    return rows.select(*kept, F.sort_array(found).alias("secrets"))


def _tagged(spans: list[Column], first: int = 0) -> Column:
    def tag(kind: int):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["value"].alias("value"))

    return F.flatten(F.array(*[F.transform(s, tag(first + k)) for k, s in enumerate(spans)]))


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = find_secrets(documents, train(documents), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spelled(F.filter("secrets", lambda x: x["kind"] < 3)), 256).alias("base_sha256"), spelled(F.col("secrets")).alias("spans"),
        count(3).alias("n_markov"),
    )
