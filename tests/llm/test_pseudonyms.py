import re

from pyspark.sql import functions as F

from playerflow.llm import pseudonyms as P

TEXTS = [
    "call +1 (017) 555-7713 or 617.555.1234 now", "mail die.55@mail4.example.com, X.12@MAIL7.EXAMPLE.COM!! and ..a@b.org.", "ip 97.51.17.173 not 1.2.3.4.5 or 300.1.1.1", "card 4111111111111111$$$ 4111-1111-1111-1111 not 9807915762804490",
    "ssn 123-45-6789 born 1999-02-28 or 31.12.2001 or 03/04/1999 not 2023-02-30", "", None, "nothing 12 here v. 4.0", "1700-01-01 2099-12-31 1900-01-01", "é漢 4111111111111111 é",
]


def done(spark, **options):
    return P.pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string").coalesce(1), **options)


def test_values_are_gone_and_linked(spark):
    rows = {r["doc_id"]: r for r in done(spark).collect()}
    for value in ("7713", "555.1234", "mail4", "MAIL7", "a@b", "97.51", "4111111111111111", "1111-1111-1111", "123-45", "1999-02-28", "31.12.2001"):
        assert not any(value in (r["text"] or "") for r in rows.values()), value
    assert rows[3]["pii"][0]["value"] == rows[9]["pii"][0]["value"]
    assert rows[5]["text"] == "" and rows[6]["text"] is None and rows[7]["text"] == TEXTS[7]
    assert "9807915762804490" in rows[3]["text"]  # its check digit is wrong
    assert "1.2.3.4.5" in rows[2]["text"] and "300.1.1.1" in rows[2]["text"] and "2023-02-30" in rows[4]["text"] and "1700-01-01" in rows[8]["text"]


def test_format_stays(spark):
    for r in done(spark).collect():
        plain = lambda t: re.sub(r"[0-9]", "9", re.sub(r"\S+@\S+", "mail", t or ""))
        if r["doc_id"] != 2:
            assert plain(r["text"]) == plain(TEXTS[r["doc_id"]])


def test_key_turns_it_back(spark):
    again = {r["doc_id"]: r["text"] for r in P.pseudonymise(done(spark), back=True).collect()}
    for i in (0, 2, 3, 4, 5, 6, 7, 8, 9):
        assert again[i] == TEXTS[i]
    other = {r["doc_id"]: r["text"] for r in done(spark, key="another").collect()}
    assert other[3] != {r["doc_id"]: r["text"] for r in done(spark).collect()}[3]


def test_permutations_are_one_to_one(spark):
    numbers = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    moved = numbers.select(P.permute_digits(F.col("d"), "k", "t").alias("x"))
    assert moved.distinct().count() == 1000 and moved.where("length(x) = 3").count() == 1000
    days = spark.range(P._DAYS).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    assert days.select(P.permute_date(F.col("d"), "k").alias("x")).where("x between '1900-01-01' and '2099-12-31'").distinct().count() == P._DAYS


def test_check_digits(spark):
    def right(number):
        d = [int(c) for c in number][::-1]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    numbers = ["4111111111111111", "4111111111111112", "378282246310005", "6011000990139424", "1234567890123"]
    rows = spark.createDataFrame([(n,) for n in numbers], "n string").select("n", P.permute_card(F.col("n"), "k").alias("x")).collect()
    assert all(right(r["n"]) == right(r["x"]) and len(r["n"]) == len(r["x"]) for r in rows)


def test_odd_rows(odd_docs, no_docs):
    rows = P.pseudonymise(odd_docs).collect()
    assert sorted(str(r["text"]) for r in rows) == sorted(str(r["text"]) for r in odd_docs.collect())
    assert P.pseudonymise(no_docs).count() == 0


def test_query_on_planted_values(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pattern = r"[0-9]{16}|\+1 \([0-9]{3}\) 555-[0-9]{4}|[^\s]+@mail[0-9]+\.example\.com|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
    def wrong(value):
        """Card numbers with a wrong check digit stay as they are."""
        digits = [int(c) for c in value][::-1] if value.isdigit() else []
        return (sum(digits[::2]) + sum(sum(divmod(2 * x, 10)) for x in digits[1::2])) % 10 != 0

    before = {v for r in docs.select(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("v")).collect() for v in r["v"]}
    after = {v for r in P.pseudonymise(docs).select(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("v")).collect() for v in r["v"]}
    assert len(before) > 20 and before & after == {v for v in before if wrong(v)}
