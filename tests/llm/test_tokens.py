import hashlib

import public_tokenizers
import pytest

from playerflow.llm import bpe_codec, token_counts
from playerflow.llm.caches import Generations
from tests.llm.brute import ids_sha, sha

ODD = [
    None, "", " ", "a  b   c", "\n\n a\n b ", "▁▁x▁y", "<s>hi</s><unk>", "<|endoftext|>a<|startoftext|> B", "É漢字𝒳 ﬁ １２３ ½ don't I'll 'steak", "a​b\x00c\x1cd\x85e f　g",
    "İıſß ΣΑΣ", "é ́x é", "x" * 3000, "ab " * 2000, "!?!?!?::://()));;{}[]", "   " * 30, "\t\r\n" * 7 + "z", "1234567890" * 20, "😀👍🏽 a😀", "thethethe" * 40,
]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return ODD + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()]


def test_counts_equal_the_library(spark, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    rows = token_counts.count_tokens(frame, limit=100, cache_entries=50).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 100), text[:40]


def test_codec_equals_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    for r in bpe_codec.encode_decode(frame, outputs=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"), cache_entries=50).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r["ids"], r["decoded"], r["n_tokens"]) == (ids, decoded, len(ids))
        assert (r["ids_sha256"], r["decoded_sha256"]) == (ids_sha(ids), sha(decoded))


def test_cuts_change_nothing():
    """Merging a whole word gives what its fragments give, and words without cuts are rare in odd scripts."""
    codec = bpe_codec.boundary_codec(public_tokenizers.path("word_bpe_49k.json"))
    cut = 0
    for word in ("zqxjkvwq", "thing", "xzxzqqjj", "wvwvkqz", "internationalisation"):
        symbols = codec.symbols_of(word + codec.end)
        cut += any(pair not in codec.inside for pair in codec._pairs(symbols))
        whole = [codec.vocab[s] for s in codec._merge_long(list(symbols))]
        assert codec.encode(word).tolist() == whole
    assert cut >= 2


def test_long_and_short_merging_agree():
    codec = bpe_codec.boundary_codec(public_tokenizers.path("word_bpe_49k.json"))
    for word in ("internationalisation", "aaaaaaaaaaa", "thththththtion", "zqxj"):
        symbols = codec.symbols_of(word + codec.end)
        assert codec._merge_long(list(symbols)) == codec.merge(list(symbols))


def test_odd_rows(odd_docs, no_docs):
    counted = token_counts.count_tokens(odd_docs).collect()
    assert len(counted) == odd_docs.count() and {(r["n_tokens"], r["n_bytes"]) for r in counted if r["doc_id"] in (1, 2)} == {(0, 0)}
    assert "score" in counted[0].asDict() and [c for c in counted[0].asDict()].count("n_tokens") == 1
    coded = bpe_codec.encode_decode(odd_docs).collect()
    assert len(coded) == odd_docs.count() and all(r["ids"] == [] and r["decoded"] == "" for r in coded if r["doc_id"] in (1, 2, 3))
    assert token_counts.count_tokens(no_docs).count() == 0 and bpe_codec.encode_decode(no_docs).count() == 0


def test_empty_digests(spark):
    row = bpe_codec.encode_decode(spark.createDataFrame([(1, None)], "doc_id int, text string"), outputs=("ids_sha256", "decoded_sha256")).first()
    assert row["ids_sha256"] == row["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


def test_generations_forget_the_old():
    made = []
    memory = Generations(2, lambda k: made.append(k) or k)
    for k in (1, 2, 3, 3, 1, 4, 5, 2):
        assert memory[k] == k
    assert len(memory) + len(memory.old) <= 4 and made == [1, 2, 3, 4, 5, 2]
