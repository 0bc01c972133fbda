"""The pipeline's near-duplicate stage: shingles of five words, four fifths alike."""

import corpus_pipeline
from playerflow.llm.jaccard_join import label_components
from tests.llm.brute import shingles


def test_copies_just_above_four_fifths_go(spark, sf_dir):
    words = [f"word{i}" for i in range(1000)]
    other = [f"new{i}" if i % 45 == 20 and i < 945 else w for i, w in enumerate(words)]
    a, b = " ".join(words), " ".join(other)
    alike = lambda n: len(shingles(a, n) & shingles(b, n)) / len(shingles(a, n) | shingles(b, n))
    assert sum(x != y for x, y in zip(words, other)) == 21 and alike(5) > 0.8 and alike(4) < 0.85
    docs = spark.createDataFrame([(1, a), (2, b), (3, "another text that stays here as it is")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()) == [1, 3]
    assert label_components(docs).where("component_size > 1").count() == 0
