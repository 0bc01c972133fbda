import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from playerflow.llm import merkle_manifest as M


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def text_of(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def walk(leaves, fanout):
    """Root, and for each leaf its siblings level by level with its places."""
    nodes, at, paths = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, p in enumerate(at):
            first = p - p % fanout
            paths[i].append((p - first, nodes[first:p] + nodes[p + 1 : first + fanout]))
        nodes = [h(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [p // fanout for p in at]
    return nodes[0], paths


def brute(rows, fanout=2):
    """Sorted (doc_id, leaf, subroot, root, proof, folded) of rows of doc_id, source, lang, n_chars, text."""
    trees = {}
    for r in rows:
        more = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        seen = (*r[:3], r[3] + 1 if more and r[3] is not None else r[3], r[4])
        trees.setdefault(r[2], []).append((r[0], h(map(text_of, r)), h(map(text_of, seen))))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    found = {n: walk([x[1] for x in trees[n]], fanout) for n in names}
    root, upper = walk([found[n][0] for n in names], fanout)
    out = []
    for n, more in zip(names, upper):
        for (doc, leaf, seen), path in zip(trees[n], found[n][1]):
            fold = seen
            for at, siblings in path + more:
                fold = h(siblings[:at] + [fold] + siblings[at:])
            out.append((doc, leaf, found[n][0], root, h([s for _, ss in path + more for s in ss]), fold))
    return sorted(out, key=str)


def told(frame, **options):
    more = F.pmod(F.crc32(frame["doc_id"].cast("string")), F.lit(7)) == 0
    rows = M.manifest(frame, seen={"n_chars": F.when(more, frame["n_chars"] + 1).otherwise(frame["n_chars"])}, **options).collect()
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in rows)
    return sorted([tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")) for r in rows], key=str), rows


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


@pytest.mark.parametrize("fanout, block, sizes", [(2, 4, {"en": 77, None: 5, "é": 4, "a": 1}), (3, 9, {"en": 100, "de": 27, "x": 28}), (2, 2, {"en": 33}), (5, 5, {"a": 31, "b": 126, "c": 1, "d": 2, "e": 3, "f": 5}), (2, 4096, {"en": 9, "de": 8})])
def test_manifest_equals_brute_force(spark, fanout, block, sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7919 % 100_003, None if i % 5 == 0 else f"s{i % 3}", lang, None if i % 4 == 0 else i, None if i % 6 == 0 else f"Text é {i}"))
    found, full = told(spark.createDataFrame(rows, SCHEMA).repartition(5), fanout=fanout, block_leaves=block)
    assert found == brute(rows, fanout)
    assert all(M.fold_path(r["leaf"], [p.asDict() for p in r["path"]]) == r["root"] for r in full)
    changed = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None}
    assert {r["doc_id"] for r in full if not r["verified"]} == changed


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(1, "a", "en", 3, "x"), (1, "a", "en", 3, "x"), (1, "b", "en", 3, "x"), (None, "a", "en", 3, "x"), (None, "a", "en", 3, "x"), (None, None, None, None, None), (14, "a", "", 3, ""), (14, "a", "", 3, None)]
    assert told(spark.createDataFrame(rows, SCHEMA).repartition(3), block_leaves=2)[0] == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    odd = odd_docs.withColumn("leaf", F.lit("own")).withColumn("path", F.lit(1))
    rows = M.manifest(odd, fields=("doc_id", "text", "leaf")).collect()
    assert len(rows) == odd.count() and all(r["verified"] for r in rows) and len({r["root"] for r in rows}) == 1
    assert M.manifest(no_docs, fields=("doc_id", "text")).count() == 0
