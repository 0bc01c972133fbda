import pytest

from playerflow.llm import lm_scores as L
from tests.compare import difference, duck_rows, spark_rows


def test_blocks_do_not_change_scores(spark, sf_dir, duck):
    """Many small blocks, as in a large corpus, against SQL over the whole tables."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = spark_rows(L.score_documents(docs, block_words=2_000, segment_words=9_000, piece_words=300).withColumn("log_score", F.round("log_score", 3)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert difference(found, duck_rows(duck, L._SQL)) is None


def test_blocks_are_full_but_not_larger(spark):
    """One batch of many documents is cut into blocks; a long document is a block of its own."""
    import numpy as np
    import pyarrow as pa

    lengths = [3] * 10 + [50] + [0, 4, 4]
    lists = pa.array([np.arange(n) for n in lengths], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(lengths)), pa.int64()), lists], names=["id", "words"])
    from unittest import mock

    with mock.patch.object(L.TaskContext, "get", return_value=mock.Mock(partitionId=lambda: 0)):
        blocks = [b.to_pylist()[0] for b in L._blocks(10, pa.int64())(iter([batch.slice(0, 5), batch.slice(5)]))]
    assert [b["total"] for b in blocks] == [12, 12, 56, 8]
    assert [i for b in blocks for i in b["ids"]] == list(range(len(lengths)))


def test_ranges_cover_all_ngrams_once():
    import numpy as np

    words = L._mix(np.arange(400, dtype=np.uint64) % np.uint64(37))
    doc = np.repeat(np.arange(8, dtype=np.uint64), 50)
    for segments in (1, 5, 16, 100):
        slots = []
        for among, grams, at in L._ranges(words, doc, 3, segments):
            assert all(s in among for s in L._segment(grams, segments))
            slots += at.tolist()
        assert sorted(slots) == [n * 400 + d * 50 + i for n in range(3) for d in range(8) for i in range(n, 50)]


def test_own_ngrams_do_not_count(spark):
    rows = L.score_documents(spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, "q q q q"), (4, "a b c")], "doc_id int, text string")).collect()
    by = {r["doc_id"]: r for r in rows}
    assert (by[3]["used_0"], by[3]["used_1"], by[1]["used_3"], by[2]["used_0"]) == (4, 0, 1, 1)
    import math

    assert by[1]["log_score"] == pytest.approx(math.log(2 / 10) + math.log(2 / 2) + math.log(1 / 2))
    assert by[1]["log_score"] == by[4]["log_score"]


def test_odd_rows(odd_docs, no_docs):
    rows = L.score_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r["log_score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0.0}
    assert L.score_documents(no_docs).count() == 0
