"""Document quality by Bradley-Terry pairwise ranking.

A document's score is a weighted sum of figures of its text. The weights are
learned from preference pairs, a document labelled 1 over one labelled 0, by
logistic loss on the differences of their figures. The threshold is the score
quantile at the share of label 0 among the training rows.

Null and empty texts have the figures of a text without words and get a score
like any other. Texts of any length are read whole. Rows without a label are
scored but never trained on. Repeated rows get the same score. Without both
labels among the training rows every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerflow.llm.native import BLANK, blank_words, let
from playerflow.llm.quality_rules import n_repeat_words
from playerflow.llm.registry import query, table
from playerflow.llm.sampling import sample_rows

#: Labelled rows, about, that train the weights.
TRAINING_ROWS = 20_000
#: Pairs drawn from them.
TRAINING_PAIRS = 60_000
PENALTY = 1e-3


def features(text: Column, words: Column) -> list[Column]:
    """Figures of a text that do not depend on its language."""
    n = F.greatest(F.size(words), F.lit(1))
    share = lambda pattern: F.least(F.regexp_count(text, F.lit(pattern)) / n, F.lit(3.0))
    distinct = F.size(F.array_distinct(words)) / n
    same_as_next = let(words, lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i + 1))) / n)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{BLANK}]"))
    again = let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))) / F.greatest(F.size(a), F.lit(1)))
    capitals = F.regexp_count(text, F.lit(r"\p{Lu}")) / F.greatest(F.regexp_count(text, F.lit(r"\p{L}")), F.lit(1))
    return [
        share("[#*$%&]{2,}"), share(rf"(?<![^{BLANK}])\|(?![^{BLANK}])"), share("!{2,}"), share(r"[#*$%&|<>~^{}\[\]\\]"), share("[.?!](?=\\s|$)"), share(","), share("[0-9]+"),
        capitals, same_as_next, 1 - distinct, let(words, lambda w: n_repeat_words(w)) / n, again,
        F.length(text) / (n * 10), F.log1p(F.size(words)) / 10, F.when(F.size(words) < 10, 1.0).otherwise(0.0), F.when(F.size(words) < 30, 1.0).otherwise(0.0),
    ]


def with_features(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``__x``, the figures as an array of doubles."""
    value = F.coalesce(df[text], F.lit(""))
    rows = df.select(*[df[c] for c in keep], value.alias("__t"), blank_words(value).alias("__w"))
    return rows.select(*keep, F.array(*[x.cast("double") for x in features(F.col("__t"), F.col("__w"))]).alias("__x"))


@dataclass(frozen=True)
class Ranking:
    weights: tuple[float, ...]
    threshold: float

    def score(self, x: Column) -> Column:
        """0 to 1; 0.5 at the threshold."""
        terms = F.lit(-self.threshold)
        for i, w in enumerate(self.weights):
            terms = terms + F.lit(w) * F.get(x, F.lit(i))
        return 1 / (1 + F.exp(-F.least(F.greatest(terms, F.lit(-500.0)), F.lit(500.0))))


def fit(x: np.ndarray, label: np.ndarray, pairs: int = TRAINING_PAIRS, penalty: float = PENALTY, steps: int = 30) -> Ranking:
    """Newton steps on the logistic loss of the differences of drawn pairs."""
    better, worse = x[label == 1], x[label == 0]
    if not len(better) or not len(worse):
        return Ranking((0.0,) * x.shape[1], 0.0)
    draw = np.random.default_rng(0)
    d = better[draw.integers(len(better), size=pairs)] - worse[draw.integers(len(worse), size=pairs)]
    spread = np.sqrt((d**2).mean(axis=0)) + 1e-9
    d = d / spread
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))  # how far each pair is from being ranked
        gradient = d.T @ p / len(d) - penalty * w
        curvature = (d * (p * (1 - p))[:, None]).T @ d / len(d) + penalty * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    w = w / spread
    scores = np.sort(x @ w)
    at = min(max(len(worse), 1), len(scores) - 1)
    return Ranking(tuple(float(v) for v in w), float((scores[at - 1] + scores[at]) / 2))


def train(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", training_rows: int = TRAINING_ROWS) -> Ranking:
    """Weights and threshold from a bounded sample of the labelled rows; 20 000 rows of 16 figures reach the driver."""
    known = labels.where(labels[key].isNotNull() & labels[label].isin(0, 1))
    known = known.select(labels[key].alias("__key"), labels[label].cast("int").alias("__label")).distinct()
    known = sample_rows(known, training_rows, "__key")
    rows = df.select(df[key].alias("__key"), df[text].alias("__text")).join(F.broadcast(known), "__key")
    rows = rows.groupBy("__key", "__label").agg(F.min("__text").alias("__text"))
    found = with_features(rows, "__text", ["__key", "__label"]).orderBy("__key", "__label").toPandas()
    if found.empty:
        return Ranking((0.0,) * len(features(F.lit(""), F.array().cast("array<string>"))), 0.0)
    return fit(np.array(found["__x"].tolist()), found["__label"].to_numpy())


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def score_documents(df: DataFrame, ranking: Ranking, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with score and predicted (1 from the threshold on)."""
    kept = [c for c in (keep if keep is not None else df.columns) if c.lower() not in ("score", "predicted")]
    scored = with_features(df, text, kept).withColumn("score", ranking.score(F.col("__x"))).drop("__x")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ranking = train(documents, labels.where(~held_out(F.col("doc_id"))))
    scored = score_documents(documents, ranking, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
