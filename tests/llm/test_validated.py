"""Only valid numbers and dates are personal data, and all of them are turned back."""

import corpus_pipeline
from playerflow.llm import pseudonyms as P


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def listed(row):
    return [p["kind"] for p in row["pii"]]


def test_wrong_check_digits_and_ranges_stay(spark):
    texts = [
        "card 4111111111111111 not 4111111111111112", "card 4111-1111-1111-1111 not 9807915762804490", "9807915762804490", "378282246310005 378282246310006",
        "ssn 123-45-6789 not 000-12-3456 666-12-3456 900-12-3456 123-00-4567 123-45-0000", "899-99-9999 667-01-0001 665-01-0001 001-01-0001",
    ]
    done = P.pseudonymise(frame(spark, texts))
    rows = [r for r in done.sort("doc_id").collect()]
    assert [listed(r) for r in rows] == [["card"], ["card"], [], ["card"], ["ssn"], ["ssn"] * 4]
    assert rows[0]["text"].endswith(" not 4111111111111112") and "4111111111111111" not in rows[0]["text"]
    assert rows[1]["text"].endswith(" not 9807915762804490") and rows[2]["text"] == texts[2] and rows[3]["text"].endswith(" 378282246310006")
    assert rows[4]["text"].endswith(" not 000-12-3456 666-12-3456 900-12-3456 123-00-4567 123-45-0000") and "123-45-6789" not in rows[4]["text"]
    assert [r["text"] for r in P.pseudonymise(done, back=True).sort("doc_id").collect()] == texts


def test_a_wrong_number_hides_nothing(spark):
    texts = ["1234 4111 1111 1111 1111", "1234 5678 9012 345 678 9012", "1234 5678 9012 10.20.30.40", "1234 5678 9012 3456@a.org"]
    rows = [r for r in P.pseudonymise(frame(spark, texts)).sort("doc_id").collect()]
    assert [listed(r) for r in rows] == [["card"], ["phone"], ["ip"], ["email"]]
    assert "4111 1111 1111 1111" not in rows[0]["text"] and rows[0]["text"].startswith("1234 ")


def test_ssn_is_one_to_one(spark):
    numbers = spark.range(898).selectExpr("lpad(id + if(id >= 665, 2, 1), 3, '0') || '010001' AS d")
    moved = {r["x"] for r in numbers.select(P.permute_ssn(numbers["d"], "k").alias("x")).collect()}
    assert len(moved) == 898 and all(len(x) == 9 and x[:3] not in ("000", "666") and x[0] != "9" and x[3:5] != "00" and x[5:] != "0000" for x in moved)


def test_query_and_stage_validate(spark, tmp_path):
    docs = spark.createDataFrame([(1, "9807915762804490 and 4111111111111111", "en", "x", 37)], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    (row,) = P.op6_pseudonyms(spark, str(tmp_path)).collect()
    assert row["n_card"] == 1 and row["text"].startswith("9807915762804490 and ") and not row["text"].endswith("4111111111111111")
    assert corpus_pipeline.pseudonyms(spark, docs, str(tmp_path)).collect()[0]["text"] == row["text"]
