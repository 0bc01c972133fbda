"""Dates of every notation, day first too, are replaced and turned back."""

import datetime as dt

from playerflow.llm import pseudonyms as P


def test_day_first_with_slashes(spark):
    texts = ["25/12/1990", "31/1/1985", "29/02/2000", "29/2/1904", "12/25/1990", "1/5/1999", "1/25/1999", "11/5/1999", "1.5.1999", "25.1.1999", "1.12.1999", "13/13/1999", "30/02/1999", "29/02/1900", "00/01/1999", "31/04/1999"]
    done = P.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    rows = [r for r in done.sort("doc_id").collect()]
    assert [len(r["pii"]) for r in rows] == [1] * 11 + [0] * 5
    assert [r["text"] == t for r, t in zip(rows, texts)] == [False] * 11 + [True] * 5
    assert [r["text"] for r in P.pseudonymise(done, back=True).sort("doc_id").collect()] == texts


def test_day_first_is_one_to_one(spark):
    days = [dt.date(1900, 1, 1) + dt.timedelta(i) for i in range(73_049)]
    for month in ("02d", "d"):
        texts = [f"{d.day:02d}/{d.month:{month}}/{d.year}" for d in days if d.day > 12 and (month == "02d" or d.month < 10)]
        frame = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
        moved = frame.select("t", P.permute_date(frame["t"], "k").alias("x"))
        back = moved.select("t", "x", P.permute_date(moved["x"], "k", back=True).alias("b")).collect()
        assert {r["x"] for r in back} == set(texts) and all(r["t"] == r["b"] for r in back)
