import collections

from pyspark.sql import functions as F

from playerflow.llm import quality_classifier as C
from playerflow.llm import quality_rules as R
from tests.llm.brute import BLANK_WORD

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def figures(text):
    text = text or ""
    w = BLANK_WORD.findall(text)
    lines = [x for x in text.split("\n") if BLANK_WORD.search(x)]
    windows = collections.defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i : i + 5])].append(i)
    hit = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


TEXTS = [
    None, "", " \t\n", "a b c d e a b c d e", "x " * 30, "a b c d e f g h i j\nq\n\nq\nq ", "# * $ % & | < > plain words here for the count of ten", "one two three four five six seven eight nine ten",
    "a b c d e f a b c d e f g a b c d e", " ".join(f"w{i % 700}" for i in range(20_000)), "é ß 漢字\x0bx\x0cy\rz \x1c\xa0 q w e r t",
]


def test_figures_equal_brute_force(spark):
    rows = R.metrics(spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")).collect()
    for r in rows:
        assert tuple(r[n] for n in NAMES) == figures(TEXTS[r["doc_id"]]), (TEXTS[r["doc_id"]] or "")[:40]


def test_order_changes_cost_not_verdict(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = R.rules(F.col("text"))
    ordered = R.order_rules(docs, "text", rules, rows=50)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    both = docs.select(R.first_rejection(ordered).isNull().alias("a"), R.first_rejection(rules[::-1]).isNull().alias("b"))
    assert both.where("a != b").count() == 0


def test_filter_agrees_with_verdicts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in R.judge(docs).where("kept").collect()}
    left = R.filter_documents(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == kept


def test_good_documents_pass_the_cascade(spark):
    directory = "/root/testdata/sf0.01"
    judged = R.judge(spark.read.parquet(f"{directory}/documents.parquet"), keep=["doc_id"]).join(spark.read.parquet(f"{directory}/labels.parquet"), "doc_id")
    assert judged.where("quality = 1 and not base_failed and not kept").count() == 0
    assert judged.where("quality = 0 and kept").count() <= 0.02 * judged.where("quality = 0").count()


def test_odd_rows(odd_docs, no_docs):
    rows = R.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(not r["kept"] for r in rows if r["n_words"] < 10)
    assert list(rows[0].asDict()).count("kept") == 1 and rows[0]["host"] == "x"
    assert R.judge(no_docs).count() == 0 and R.filter_documents(no_docs).count() == 0
    assert R.filter_documents(odd_docs).columns == odd_docs.columns


def test_classifier_on_held_out_rows(spark):
    directory = "/root/testdata/sf0.01"
    scored = C.op5_quality_classifier(spark, directory).join(spark.read.parquet(f"{directory}/labels.parquet"), "doc_id").where("held_out")
    good, bad = scored.where("quality = 1"), scored.where("quality = 0")
    assert good.where("predicted = 1").count() >= 0.97 * good.count() and bad.where("predicted = 0").count() >= 0.9 * bad.count()


def test_classifier_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (5, 1), (4, 0), (None, 0), (8, None), (8, 7)], "doc_id long, quality int")
    ranking = C.train(odd_docs, labels)
    rows = C.score_documents(odd_docs, ranking).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (6, 7)}) == 1
    blank = C.train(no_docs, labels)
    assert {r["score"] for r in C.score_documents(odd_docs, blank).collect()} == {0.5}
    assert C.score_documents(no_docs, ranking).count() == 0


def test_held_out_folds(spark):
    import zlib

    rows = spark.range(200).select("id", C.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)
