import corpus_pipeline
from playerflow.llm import pseudonyms, quality_rules
from playerflow.llm.bpe_codec import boundary_codec
from tests.llm.brute import contamination, ids_sha, jaccard_components, sha


def test_stages_one_after_the_other(spark, sf_dir):
    """The whole pipeline against plain Python, stage by stage."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in quality_rules.judge(docs).where("kept").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept]
    rows = [rows[i] for i, (_, c) in jaccard_components(rows, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.ALIKE_PERCENT).items() if c == rows[i][0]]
    clean = sorted(i for i, t in rows if not contamination(t, items)[1])
    codec = boundary_codec(public_tokenizers.path("word_bpe_49k.json"))
    expected = {}
    for r in pseudonyms.pseudonymise(docs.where(docs["doc_id"].isin(clean))).collect():
        ids = codec.encode(r["text"])
        expected[r["doc_id"]] = (len(ids), ids_sha(ids), sha(codec.decode(ids)))
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found == expected and 0 < len(found) < docs.count()


def test_stages_keep_the_columns(spark, sf_dir, odd_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for frame in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, sf_dir).dtypes == docs.dtypes, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs.withColumn("n_chars", odd_docs["n_tokens"]), sf_dir).count() >= 0, name


def test_texts_are_encoded_in_small_batches(spark, sf_dir, monkeypatch):
    seen, encode = [], corpus_pipeline.encode_decode

    def watched(docs, **kept):
        seen.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return encode(docs, **kept)

    monkeypatch.setattr(corpus_pipeline, "encode_decode", watched)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    assert corpus_pipeline.encode_texts(spark, docs, sf_dir).count() == 20 and seen == ["500"]
