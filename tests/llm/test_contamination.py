import re

from pyspark.sql import functions as F

from playerflow.llm import decontaminate as D
from tests.llm.brute import contamination

WORDS = [f"w{i}" for i in range(200)]
ITEMS = [
    (3, " ".join(WORDS[:25])), (20, "Short item, only five"), (100, " ".join(WORDS[5:16])), (7, None), (8, " .,! "), (9, "single"), (None, " ".join(WORDS[40:52])), (3, " ".join(WORDS[:25])), (11, "É " * 10),
]
TEXTS = [
    None, "", "...", "W0, w1 W2-w3 w4 w5 w6 w7 w8 w9", "w0 w1 w2 w3 w4 w5 w6 w7 w8", " ".join(WORDS), "x short ITEM only FIVE short item only five", "a single, case", "no hit here",
    " ".join(WORDS[40:50]), " ".join(WORDS[3:30]) + " x " + " ".join(WORDS[3:30]), "é " * 12, "É " * 12, "pad " * 5000 + " ".join(WORDS[2:14]),
]


def found(spark, broadcast_windows):
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "own")], "doc_id long, text string, items string")
    return D.report(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), broadcast_windows=broadcast_windows).collect()


def check(rows):
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        n, hit, items = contamination(TEXTS[r["doc_id"]], ITEMS)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, sorted(str(i) for i in items if i is not None)), r["doc_id"]
        assert r["contaminated"] == (hit > 0) and r["n_items"] == len(r["items"])


def test_report_equals_brute_force(spark):
    check(found(spark, D.BROADCAST_WINDOWS))


def test_several_passes_give_the_same(spark):
    check(found(spark, 4))


def test_dropping_and_cutting(spark):
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "own"), (None, "clean", "own")], "doc_id long, text string, items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = D.drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    expected = [(i, t) for i, t in [*enumerate(TEXTS), (None, TEXTS[3]), (None, "clean")] if not contamination(t, ITEMS)[1]]
    assert sorted(map(str, expected)) == sorted(str((r["doc_id"], r["text"])) for r in clean.collect())
    cut = {r["doc_id"]: r["text"] for r in D.cut_spans(docs, items).collect()}
    assert cut[6] == "x        " and cut[7] == "a , case" and cut[0] is None and cut[8] == TEXTS[8] and cut[3] == ",  -      "


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = D.report(odd_docs, items).collect()
    assert len(rows) == odd_docs.count() and not any(r["contaminated"] for r in rows)
    assert D.report(no_docs, items).count() == 0
    assert {r["n_hit"] for r in D.report(odd_docs, items.where("false")).collect()} == {0}


def test_text_item_ids(spark):
    docs = spark.createDataFrame([("a", TEXTS[5]), ("b", "clean"), (None, TEXTS[6])], "doc_id string, text string")
    items = spark.createDataFrame([(f"item-{i}", t) for i, t in ITEMS if i != 3], "item_id string, text string")
    got = {r["doc_id"]: r["items"] for r in D.report(docs, items).collect()}
    assert got == {"a": ["item-100", "item-None"], "b": [], None: ["item-20"]}


def test_a_very_long_text(spark):
    """Work does not grow with the square of a text's length; for a document of hits alone neither."""
    long = [" ".join(f"x{i}" for i in range(300_000)) + " " + ITEMS[2][1], " ".join([ITEMS[2][1]] * 20_000)]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in D.report(docs, items, keep=["doc_id"]).collect()}
    assert got == {0: (300_011, 11), 1: (220_000, 220_000)}


def test_word_characters_are_told_one_by_one(spark):
    """Words are runs outside the given ranges for every character, and no class has a range, which the engine is slow on."""
    assert not re.search(r"\\x[0-9A-F]{2}-", D.WORD + D._EITHER_CASE)
    text = " ".join(f"{chr(c)}a" for c in [*range(0x500), 0x4E2D, 0xFFFD, 0x1F600, 0x10FFFF])
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    row = spark.createDataFrame([(text,)], "t string").select(D.normal_words(F.col("t")).alias("w"), F.regexp_count("t", F.lit(D._EITHER_CASE)).alias("n")).first()
    assert row["w"] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) and row["n"] == len(row["w"])
