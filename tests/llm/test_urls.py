import random
import re

from playerflow.llm import url_filter as U


def covers(glob, text):
    pattern = "".join({"**": ".*", "*": "[^/]*"}.get(x, re.escape(x)) for x in re.split(r"(\*\*|\*)", glob))
    return re.fullmatch(pattern, text, re.S) is not None


def test_automaton_equals_regular_expressions():
    draw = random.Random(1)
    globs = tuple("".join(draw.choice(["a", "b", "/", "*", "**", "."]) for _ in range(draw.randrange(1, 9))) for _ in range(60))
    globs = tuple(re.sub(r"\*{3,}", "**", g) for g in globs)
    texts = ["", "é/a", "a" * 300 + "/b"] + ["".join(draw.choice("ab/.c") for _ in range(draw.randrange(0, 9))) for _ in range(400)]
    found = U.GlobAutomaton(globs).matches(texts)
    assert found.shape == (len(texts), len(globs)) and U.GlobAutomaton(globs).words > 1
    for i, t in enumerate(texts):
        for k, g in enumerate(globs):
            assert found[i, k] == covers(g, t), (g, t)


CASES = [
    (None, "", "", None, "allow"), ("no scheme.com/en/", "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://A.Example.COM/en/x?q=1#f", "a.example.com", "/en/x", "example.com/en/", "block"), ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://x.www.example.com/en/1", "x.www.example.com", "/en/1", "www.example.com/en/", "allow"), ("https://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
    ("ftp://b.net/es/", "b.net", "/es/", "net/es/", "block"), ("http://b.net/ES/", "b.net", "/ES/", None, "allow"), ("http://b.net/fr", "b.net", "/fr", None, "allow"), ("http://com", "com", "", None, "allow"),
    ("x://y://z.com/a", "y:", "//z.com/a", None, "allow"), ("http://É.com/\n/en/", "É.com", "/\n/en/", "com/", "allow"), ("http://spam.org/x.net/es/", "spam.org", "/x.net/es/", None, "block"),
    ("http://a.org/" + "p" * 9000 + "/login/x", "a.org", "/" + "p" * 9000 + "/login/x", None, "block"),
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, c[0], "own", "own") for i, c in enumerate(CASES)] + [(0, None, "own", "own")], "page_id int, url string, host string, other string")
    rows = U.judge_urls(pages).collect()
    assert len(rows) == len(CASES) + 1
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == CASES[r["page_id"]][1:], CASES[r["page_id"]][0]
        assert r["other"] == "own"
    assert U.judge_urls(pages.where("false")).count() == 0
