"""Merkle manifest of a dataset: a digest and a proof for every row, by butterfly exchange.

Every row is a leaf. The leaves of a tree stand in order of their key, runs of
``fanout`` consecutive nodes (the last run may be shorter) become their parent
until one node is left, and the roots of the trees, in order of the trees'
names, are the leaves of one more tree.

Leaves are numbered across the cluster by a range shuffle and dealt into blocks
of a fixed power of the fanout, so a block is a whole subtree. Blocks then
exchange roots as in a butterfly network: in round t, the groups of
``fanout ** t`` aligned blocks that make up one run swap the roots of their
subtrees, and every block hashes their parent for itself. After all rounds
each block holds the siblings of all its ancestors, so there is no pass back
down; one pass over the blocks then makes the rows' own proofs. A round moves
a few digests per block. In a ragged group the rows asked are dealt evenly.

Digests are lowercase hex sha256 of the inputs side by side. A null is ``-``,
any other value its length in UTF-8 bytes, a colon and the value. Rows with
equal keys stand in order of their digests; equal rows are leaves of their own,
and which of them has which place does not show. A null tree name is a tree of
its own that comes first, null keys come first. A null or empty text is a leaf
like any other. An empty table has no leaves and no root. Columns that have the
name of a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from playerflow.llm.registry import query, table
from playerflow.session import written

FANOUT = 2
#: Leaves, at most, in a block.
BLOCK_LEAVES = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_LEVELS = "array<struct<at:int,siblings:array<string>>>"


def field_text(value: Column) -> Column:
    """The bytes by which a value enters its leaf."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, values)), 256)


def _digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def block_size(fanout: int, leaves: int = BLOCK_LEAVES) -> int:
    """The largest power of the fanout up to ``leaves``."""
    size = fanout
    while size * fanout <= leaves:
        size *= fanout
    return size


def _parents(nodes: list[str], fanout: int) -> list[str]:
    return [_digest(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]


def _subtree(nodes: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The nodes of all levels, up to a single one, or for ``levels`` steps."""
    rows = [nodes]
    while len(rows[-1]) > 1 if levels is None else len(rows) <= levels:
        rows.append(_parents(rows[-1], fanout))
    return rows


def _steps(block: int, fanout: int) -> int:
    steps = 0
    while fanout**steps < block:
        steps += 1
    return steps


def numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, key, leaf and more) with ``pos``, the place in its tree, from 0, and ``size``, the leaves of that tree.

    After the range shuffle a partition holds consecutive rows, so a place is
    the rows of the tree in earlier partitions plus those before it in its own.
    """
    order = ["tree", "key", "leaf"]
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ranged = written(ranged.withColumn("__part", F.spark_partition_id()), "merkle-order")
    runs = ranged.groupBy("tree", "__part").agg(F.count("*").alias("n"), F.min("__at").alias("__first"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("__part")) - F.col("n")
    starts = runs.select("tree", "__part", (before - F.col("__first")).alias("__shift"), F.sum("n").over(Window.partitionBy("tree")).alias("size"))
    placed = ranged.join(starts, ["tree", "__part"])
    return placed.select(*leaves.columns, (F.col("__at") + F.col("__shift")).alias("pos"), "size")


def _block_roots(fanout: int, block: int):
    """The root of one block's subtree; in a tree of several blocks it stands on the level that all blocks have in common."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        first = rows.slice(0, 1).to_pylist()[0]
        levels = None if first["size"] <= block else _steps(block, fanout)
        top = _subtree(rows.column("leaf").to_pylist(), fanout, levels)[-1][0]
        blocks = -(-first["size"] // block)
        values = [[first["tree"]], [first["block"]], [blocks], [top], [[]]]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.list_(pa.string()))]))]
        return pa.table([pa.array(v, t) for v, t in zip(values, types)], names=["tree", "block", "blocks", "node", "path"])

    return run


def butterfly(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """tree, block, ``node`` (the tree's root) and ``path`` (place in the run and siblings, level by level) of every block.

    ``blocks`` has tree, block, blocks (of its tree), node (the subtree's root) and an empty path.
    """
    most = blocks.agg(F.coalesce(F.max("blocks"), F.lit(0)).alias("n")).first()["n"]
    width = 1  # blocks in the group that a block speaks for
    while width < most:
        group, run = F.floor(F.col("block") / width), F.floor(F.col("block") / (width * fanout))
        last_group = F.floor((F.col("blocks") - 1) / width)
        going = F.col("blocks") > width
        # one block of each other group of the run is asked; in a short last group the asking blocks take turns
        others = F.filter(F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda j: run * fanout + j), lambda g: (g != group) & (g <= last_group))
        start = F.col("__group") * width
        there = F.least(F.lit(width), F.col("blocks") - start)
        asked = blocks.where(going).select("tree", "block", "blocks", F.explode(others).alias("__group"))
        asked = asked.select("tree", "block", "__group", (start + F.pmod(F.col("block"), there)).cast("long").alias("__from"))
        answers = asked.join(blocks.select("tree", F.col("block").alias("__from"), F.col("node").alias("__node")), ["tree", "__from"])
        siblings = answers.groupBy("tree", "block").agg(F.sort_array(F.collect_list(F.struct("__group", "__node"))).alias("__got"))
        met = blocks.join(siblings, ["tree", "block"], "left").withColumn("__at", (group - run * fanout).cast("int"))
        got = F.coalesce(F.transform("__got", lambda x: x["__node"]), F.array().cast("array<string>"))
        run_nodes = F.concat(F.slice(got, F.lit(1), F.col("__at")), F.array("node"), F.slice(got, F.col("__at") + 1, F.lit(fanout)))
        step = F.array(F.struct(F.col("__at").alias("at"), got.alias("siblings")))
        met = met.select(
            "tree", "block", "blocks", F.when(going, F.sha2(F.array_join(run_nodes, ""), 256)).otherwise(F.col("node")).alias("node"),
            F.when(going, F.concat("path", step)).otherwise(F.col("path")).cast(_LEVELS).alias("path"))
        blocks, width = written(met, "merkle-round"), width * fanout
    return blocks


def fold_path(leaf: str, path: list[dict]) -> str:
    """The root that a leaf and its siblings lead to."""
    for step in path:
        at, siblings = step["at"], step["siblings"]
        leaf = _digest([*siblings[:at], leaf, *siblings[at:]])
    return leaf


def _row_proofs(fanout: int, block: int, schema: T.StructType):
    """The rows of a block with the proof inside the block, followed by that of the block, and what it gives."""
    arrow = to_arrow_schema(schema)

    def run(rows: pa.Table, tops: pa.Table) -> pa.Table:
        rows, top = rows.sort_by("pos"), tops.to_pylist()[0]
        levels = _subtree(rows.column("leaf").to_pylist(), fanout, None if rows.column("size")[0].as_py() <= block else _steps(block, fanout))
        paths = []
        for i in range(rows.num_rows):
            path = []
            for nodes in levels[:-1]:
                first = i - i % fanout
                path.append({"at": i - first, "siblings": [*nodes[first:i], *nodes[i + 1 : first + fanout]]})
                i //= fanout
            paths.append(path + top["path"])
        made = {"subroot": [top["node"]] * len(paths), "root": [top["root"]] * len(paths), "path": paths}
        made["proof_sha256"] = [_digest([s for step in path for s in step["siblings"]]) for path in paths]
        if "folded_root" in arrow.names:
            made["folded_root"] = list(map(fold_path, rows.column("seen_leaf").to_pylist(), paths))
        return pa.Table.from_arrays([pa.array(made[f.name], f.type) if f.name in made else rows.column(f.name) for f in arrow], schema=arrow)

    return run


class Trees:
    """Leaves (tree, key, leaf and more) in their places, and the blocks' proofs up to the roots of their trees."""

    def __init__(self, leaves: DataFrame, fanout: int, block_leaves: int):
        self.fanout, self.block = fanout, block_size(fanout, block_leaves)
        self.leaves = written(numbered(written(leaves, "merkle-leaves")).withColumn("block", F.floor(F.col("pos") / self.block)), "merkle-places")
        roots = self.leaves.select("tree", "block", "size", "pos", "leaf").groupBy("tree", "block").applyInArrow(
            _block_roots(fanout, self.block), f"tree string, block long, blocks long, node string, path {_LEVELS}")
        self.tops = butterfly(written(roots, "merkle-blocks"), fanout)

    def roots(self) -> DataFrame:
        return self.tops.groupBy("tree").agg(F.min("node").alias("node"))

    def rows(self, tops: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The leaves with ``columns``; ``tops`` has tree, block, node, path and root."""
        types = {"subroot": "string", "root": "string", "path": _LEVELS, "proof_sha256": "string", "folded_root": "string"}
        types |= {f.name: f.dataType.simpleString() for f in self.leaves.schema.fields}
        schema = T.StructType.fromDDL(", ".join(f"{c} {types[c]}" for c in columns))
        return self.leaves.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(_row_proofs(self.fanout, self.block, schema), schema)


def manifest(df: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", tree: str = "lang", seen: dict[str, Column] | None = None, with_path: bool = True, fanout: int = FANOUT, block_leaves: int = BLOCK_LEAVES) -> DataFrame:
    """key, leaf, subroot, root, path (place and siblings per level, up to the root), proof_sha256, seen_leaf, folded_root and verified.

    ``seen`` has columns that replace fields of the row in the leaf that is
    verified against the manifest: what a reader of the data found there.
    """
    digest = lambda columns: leaf_digest([columns.get(f, df[f]) for f in fields])
    name = F.when(df[tree].isNull(), "n").otherwise(F.concat(F.lit("v"), df[tree].cast("string")))
    trees = Trees(df.select(name.alias("tree"), df[key].alias("key"), digest({}).alias("leaf"), digest(seen or {}).alias("seen_leaf")), fanout, block_leaves)
    over = Trees(trees.roots().select(F.lit("all").alias("tree"), F.col("tree").alias("key"), F.col("node").alias("leaf")), fanout, block_leaves)
    upper = written(over.rows(over.tops.withColumn("root", F.col("node")), ["key", "root", "path"]), "merkle-upper")
    upper = upper.select(F.col("key").alias("tree"), "root", F.col("path").alias("upper"))
    tops = trees.tops.join(upper, "tree").select("tree", "block", "node", "root", F.concat("path", "upper").cast(_LEVELS).alias("path"))
    columns = ["key", "leaf", "subroot", "root", *(["path"] if with_path else []), "proof_sha256", "seen_leaf", "folded_root"]
    return trees.rows(tops, columns).withColumnRenamed("key", key).withColumn("verified", F.col("folded_root") == F.col("root"))


_SQL = r"""
WITH RECURSIVE RAW AS (
  SELECT doc_id, lang, n_chars, text, source, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
  FROM documents
), l AS (
  SELECT doc_id, lang, p || t || x AS body, p || CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1)::VARCHAR, '-') ELSE t END || x AS seen FROM (
    SELECT doc_id, lang, n_chars, crc, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS p,
      coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS t, coalesce(strlen(text) || ':' || text, '-') AS x FROM RAW)
), leaves AS (
  SELECT doc_id, lang, sha256(body) AS leaf, sha256(seen) AS seen, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(body)) - 1 AS pos FROM l
), levels AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY pos) AS nodes FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, lvl + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM levels WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM levels WHERE len(nodes) = 1
), tops AS (
  SELECT 0 AS lvl, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT lvl + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM tops WHERE len(nodes) > 1
), walk AS (
  SELECT doc_id, leaf, s.lang, subroot, height, place, pos, 0 AS lvl, seen AS folded, '' AS proof FROM leaves JOIN subroots s ON leaves.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT doc_id, leaf, w.lang, subroot, height, place, w.pos // 2 + CASE WHEN w.lvl + 1 = height THEN place ELSE 0 END, w.lvl + 1,
    sha256(CASE WHEN w.pos % 2 = 0 THEN folded || coalesce(nodes[w.pos + 2], '') ELSE nodes[w.pos] || folded END), proof || coalesce(nodes[CASE WHEN w.pos % 2 = 0 THEN w.pos + 2 ELSE w.pos END], '')
  FROM walk w JOIN (SELECT lang, lvl, nodes, true AS low FROM levels UNION ALL SELECT lang, height + tops.lvl, nodes, false FROM tops, subroots) n
    ON w.lang IS NOT DISTINCT FROM n.lang AND w.lvl = n.lvl AND low = (w.lvl < height) WHERE len(nodes) > 1
)
SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS verified
FROM walk WHERE lvl = height + (SELECT max(lvl) FROM tops)
"""


@query("op11_merkle_manifest", _SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    more = F.pmod(F.crc32(docs["doc_id"].cast("string")), F.lit(7)) == 0
    found = manifest(docs, seen={"n_chars": F.when(more, docs["n_chars"] + 1).otherwise(docs["n_chars"])}, with_path=False)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
