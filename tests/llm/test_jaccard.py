import random

import pytest
from pyspark.sql import functions as F

from playerflow.llm import components as K
from playerflow.llm import jaccard_join as J
from playerflow.session import arrow_rows
from tests.llm.brute import jaccard_components, shingles


def near_copies():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    common = [draw.choice(words) for _ in range(60)]
    docs = []
    for g in range(40):
        base = [draw.choice(words) for _ in range(draw.choice([5, 6, 8, 9, 10, 11, 12, 15, 20, 30, 50, 80, 150, 300]))]
        if g % 3 == 0:
            base[len(base) // 2 : len(base) // 2] = common
        for _ in range(draw.choice([1, 2, 3, 8, 20])):
            w = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, max(1, len(w) // 60), max(1, len(w) // 40)])):
                at, kind = draw.randrange(len(w)), draw.random()
                if kind < 0.4:
                    w[at] = draw.choice(words)
                elif kind < 0.7 and len(w) > 3:
                    del w[at : at + draw.choice([1, 2])]
                else:
                    w += [draw.choice(words) for _ in range(draw.choice([1, 2, 4]))]
            docs.append(" ".join(w))
    docs += ["", "  ", "one", "ONE", "a b", "A  B", "a b c d", None, "É x y z q", "é x y z q"]
    draw.shuffle(docs)
    return docs


def labels(spark, rows):
    frame = spark.createDataFrame([(i, t, 0, "h") for i, t in rows], "doc_id long, text string, n int, h string")
    return J.label_components(frame).collect()


def test_labels_equal_brute_force(spark):
    rows = list(enumerate(near_copies()))
    expected = jaccard_components(rows)
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in labels(spark, rows)}
    assert found == expected and len({c for _, c in expected.values()}) < len(rows) - 60


def test_repeated_ids_and_nulls(spark):
    rows = [(4, "a b c d e f g"), (4, "a b c d e f g"), (None, "a b c d e f g"), (4, "other words for this row here"), (None, "only one without id at all"), (None, None), (2, "A b c D e f G")]
    expected = jaccard_components(rows)
    found = sorted(labels(spark, rows), key=str)
    assert sorted((r["id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in found) == sorted((rows[i][0] or -1, n, c or -1) for i, (n, c) in expected.items())


def test_keep_one(spark):
    rows = list(enumerate(near_copies()))
    expected = jaccard_components(rows)
    frame = spark.createDataFrame([*rows, rows[0], (None, "nobody else has this text")], "doc_id long, text string")
    kept = sorted(str(r["doc_id"]) for r in J.keep_one(frame).collect())
    assert kept == sorted([str(i) for i, (n, c) in expected.items() if c == i or n == 0] + ["None"])


def test_traversal_prunes_but_keeps_links(spark):
    """Every linked pair of different components comes out at the bottom of the trees."""
    from pyspark.sql import functions as F

    docs = [t for t in near_copies() if t and len(shingles(t)) > 6][:60]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    named, planted, _ = J.link_classes(frame)
    classes = planted.where("sigs is not null").select(F.col("rid").alias("c"), "n", "spare", *J._BITS).join(named.select("c"), "c", "left_semi")
    members = classes.select(F.lit(1).cast("long").alias("sig"), "c", F.col("c").alias("comp"))
    pairs, deep = ({(r["a"], r["b"]) for r in J.traverse(members, classes, leaf=leaf).collect()} for leaf in (1_000, 2))
    assert pairs == deep
    key = {r["id"]: r["c"] for r in named.collect()}
    sets = [shingles(t) for t in docs]
    linked = {tuple(sorted((key[i], key[j]))) for i in range(len(docs)) for j in range(i) if key[i] != key[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert linked <= pairs and len(pairs) < len(set(key.values())) * (len(set(key.values())) - 1) / 4


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(300)], [(7, i) for i in range(50)] + [(100, 101), (101, 7)], [(5, 5), (3, 9), (9, 3)]])
def test_components(spark, links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = {r["member"]: r["root"] for r in K.components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert found == {x: root(x) for x in list(parent) if root(x) != x}


def test_odd_rows(spark, odd_docs, no_docs):
    found = J.label_components(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert sorted(r["component_id"] for r in found if r["id"] in (6, 7)) == [6, 6, 6]
    assert J.label_components(no_docs).count() == 0 and J.keep_one(no_docs).count() == 0


def test_a_large_group_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Many classes about the threshold from each other, and as few comparisons as a few for each class."""
    draw = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(160):
        w = list(base)
        for k in range(draw.choice([2, 3, 3, 4])):
            w[draw.randrange(len(w))] = f"x{i}_{k}"
        docs.append(" ".join(w))
    rows = list(enumerate(docs))
    compared, exact = [], J._exact

    def counted(pairs, *args):
        compared.append(pairs.count())
        return exact(pairs, *args)

    monkeypatch.setattr(J, "_exact", counted)
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in labels(spark, rows)}
    assert found == jaccard_components(rows)
    assert sum(compared) <= 16 * len(docs)


def test_rounds_compare_every_pair_between_components(spark):
    """Pairs that are left are compared until none lies between components, whatever their order."""
    draw = random.Random(3)
    pairs = [(a, b, draw.random()) for b in range(60) for a in range(b)]
    linked = {(a, b) for a, b, _ in pairs if b - a == 1 and b % 20} | {(0, 59)}
    left = spark.createDataFrame(pairs, "a long, b long, likely double")
    links = spark.createDataFrame(sorted(linked), "a long, b long")
    tried = []

    def exact(some):
        tried.extend((r["a"], r["b"]) for r in some.collect())
        return some.join(links, ["a", "b"]).select("a", "b")

    found = {r["member"]: r["root"] for r in J.connect(left, K.components(spark.createDataFrame([(5, 6)], "a long, b long")), exact).collect()}
    root = {x: 20 if 20 <= x < 40 else 0 for x in range(60)}
    assert found == {x: r for x, r in root.items() if x != r}
    assert len(tried) == len(set(tried)) < len(pairs) and {p for p in linked if p in set(tried)} <= linked
    assert all((a, b) in set(tried) for a, b, _ in pairs if root[a] != root[b])


def test_short_keys_bound_the_overlap(spark):
    """Pairs of whole sets that are linked are linked by their 16-bit keys too, also where keys of a set fall together."""
    from pyspark.sql import functions as F

    draw = random.Random(4)
    top = lambda k: (k << 48) + draw.randrange(1 << 48)
    a = [top(draw.randrange(-40, 40)) for _ in range(100)]
    sets = [(1, a), (2, a[:92] + [top(7) for _ in range(8)]), (3, [top(draw.randrange(100, 20_000)) for _ in range(100)])]
    frame = spark.createDataFrame(sets, "want long, keys array<long>").select("want", F.size("keys").alias("n"), "keys")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    short = J._compared(pairs, frame.withColumn("keys", J._short(F.col("keys"))), 85).collect()
    whole = J._compared(pairs, frame, 85).collect()
    assert [tuple(r) for r in whole] == [(1, 2)] and set(map(tuple, whole)) <= set(map(tuple, short))


def copies_of_one_text(light: int, heavy: int):
    """Copies that are linked with the text, and copies with so many edits that they are not, some of them linked with a few copies."""
    draw = random.Random(11)
    base = [f"w{i}" for i in range(150)]

    def edited(words, name, edits):
        w = list(words)
        for k in range(edits):
            at = draw.randrange(len(w))
            if draw.random() < 0.7:
                w[at] = f"x{name}_{k}"
            else:
                del w[at]
        return w

    docs = [base] + [edited(base, f"l{i}", draw.choice([1, 1, 2, 3])) for i in range(light)]
    far = [edited(base, f"h{i}", draw.choice([5, 6, 7])) for i in range(heavy)]
    docs += far + [edited(docs[1 + i], f"c{i}", draw.choice([3, 4, 5])) for i in range(light // 3)] + [edited(w, f"n{i}", 1) for i, w in enumerate(far[::4])]
    draw.shuffle(docs)
    return [" ".join(w) for w in docs]


def test_a_class_is_not_paired_with_every_class_of_a_large_component(spark, monkeypatch):
    rows = list(enumerate(copies_of_one_text(90, 90)))
    met, meet = [], J._meet

    def counted(pairs, *args):
        met.append(pairs.count())
        return meet(pairs, *args)

    monkeypatch.setattr(J, "_meet", counted)
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in labels(spark, rows)}
    assert found == jaccard_components(rows)
    assert sum(met[1:]) <= 8 * len(rows), met


@pytest.mark.parametrize("central", [True, False])
def test_differences_lose_no_link(spark, central):
    """Every linked pair of a class and a member comes out, or the class's pair with the centre, whichever member that is."""
    from pyspark.sql import functions as F

    sets = sorted((shingles(t) for t in copies_of_one_text(60, 60)), key=lambda s: sum(k[0][0] != "w" for k in s))
    number = {k: i for i, k in enumerate(sorted(set().union(*sets), key=str))}
    made = spark.createDataFrame([(i, len(s), sorted(number[k] for k in s)) for i, s in enumerate(sets)], "want long, n int, keys array<long>")
    inside, outside = range(0, len(sets), 2), range(1, len(sets), 2)
    of = lambda ids: spark.createDataFrame([(1, i) for i in ids], "comp long, c long")
    centre = inside[0] if central else inside[-1]
    centres = spark.createDataFrame([(1, centre)], "comp long, centre long")
    found = {(r["a"], r["b"]) for r in J._by_differences(of(outside), of(inside), centres, lambda wanted: made.join(wanted, F.col("want") == F.col("c"), "left_semi"), 85).collect()}
    linked = {(a, b) for a in outside for b in inside if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    by_centre = {a for a, b in linked if b == centre}
    assert {(a, b) for a, b in linked if a not in by_centre} <= found and {(a, centre) for a in by_centre} <= found
    assert {a for a, _ in linked} - by_centre and len(found) < len(inside) * len(outside) / (8 if central else 2), (len(found), len(by_centre))


def test_sets_go_to_python_in_small_batches(spark, monkeypatch):
    """However many rows a task has; the session's own setting is back afterwards."""
    name, plant = "spark.sql.execution.arrow.maxRecordsPerBatch", J._plant

    def watched(*args):
        run = plant(*args)

        def small(batches):
            for batch in batches:
                assert batch.num_rows <= 500, batch.num_rows
                yield batch

        return lambda batches: run(small(batches))

    monkeypatch.setattr(J, "_plant", watched)
    texts = spark.range(1_200).select("id", F.concat(F.lit("all words but one are alike: "), F.col("id")).alias("text")).coalesce(1)
    before = spark.conf.get(name, None)
    named, _, _ = J.link_classes(texts, key="id")
    assert named.count() == 1_200 and spark.conf.get(name, None) == before


def test_batches_of_a_session_are_not_made_larger(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "7")
    try:
        with pytest.raises(ValueError), arrow_rows(spark, 500):
            assert spark.conf.get(name) == "7"
            raise ValueError
        assert spark.conf.get(name) == "7"
        spark.conf.set(name, "0")
        with arrow_rows(spark, 500):
            assert spark.conf.get(name) == "500"
        assert spark.conf.get(name) == "0"
    finally:
        spark.conf.unset(name)
