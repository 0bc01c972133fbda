"""Word n-gram Jaccard join with signature trees.

Texts with the same shingle set form one class; classes are joined.

*Forest.* One tree over unrelated texts has saturated upper nodes, so the
forest is planted by certain meeting points: the shingle space of a size class
is dealt into P parts. Two linked sets differ in d shingles at most, which
follows from their sizes, so P - d parts are equal in both. With the parts of
a set in one order for all sets, the first d + 1 of two linked sets have a
part in common; a set is planted under these. Parts with the most rare
shingles come first, equal ones by hash. No link can miss all trees.

*Chains.* Neighbours in a tree are compared first, if their sizes and bitmaps
allow a link, and of those of a class the few likeliest. Copies of one text so
become one component with a few comparisons each, not all pairs.

*Dual traversal.* Trees that still hold several components get nodes on
levels: size band, digits of the component, component, class. A node holds
the OR of its members' token bitmaps, their size range and the most shingles
that share a bit. Pairs of nodes go down level by level; a pair is pruned when
its sizes cannot reach the threshold, when both lie in one component, or when
the common bits plus the shared ones are fewer than the overlap that the
threshold needs. A tree of few components is one leaf. Pairs of components,
which several trees may hold, are made distinct before their nodes meet; then
the classes of the smaller component meet the other one's node, then its
classes, which are looked up by their differences if they are many. What is left at
the bottom is compared in rounds: where the pairs are many for their classes,
each class takes its likeliest ones, the links found join components, and pairs
inside one component need no comparison any more. A round takes eight times as
many for each class as the one before.

*Differences.* Against a component of many classes, a class is not paired with
each of these. One of them, the centre, which has most links, is taken off
from all by symmetric difference; what is left of two sets differs in as many
shingles as the sets. A class that is linked with the centre needs no other
link. Of any other one, linked sets share more than half of what is left of the
member, and all but the most differences of what is left of the class. So both
have a shingle in common among their first ones, rarest first, and are joined
by these. Copies of one text with edits of their own share none.

*Comparison.* Sets travel as 16-bit keys first, a quarter of the bytes: common
keys and shared ones bound the overlap as the bits of the bitmaps do, whatever
the size of a set. Only pairs that pass travel as whole sets.

Results: null and empty texts, and those without words, have no shingles and
are linked with nothing. A text with fewer words than a shingle is one shingle.
Equal rows are in one component. Rows without an id take part, but no
component is named after them. Shingles are 64-bit keys. Sets are told apart by
two such keys of the whole set, and a class is named by a row that has it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playerflow.llm.batches import TEXT_ROWS
from playerflow.llm.components import components
from playerflow.llm.native import blank_words, let, lower_ascii
from playerflow.llm.quality_rules import window_keys
from playerflow.llm.registry import query, table
from playerflow.llm.sampling import sample_rows
from playerflow.session import arrow_rows, written

WORDS = 4
PERCENT = 85
#: Longs in a bitmap.
LONGS = 16
#: Documents, about, whose shingles tell which are frequent; the answer does not depend on it, only the work.
FREQUENT_SAMPLE = 4_000
#: A shingle in so many documents of the sample is frequent.
FREQUENT_IN = 3
#: Most bytes of ids in a broadcast; more are joined by shuffling.
BROADCAST_BYTES = 32 << 20
#: Neighbours with which a class is compared before the traversal; also pairs for each class up to which all are compared at once.
NEIGHBOURS = 4
_BITS = [f"b{i}" for i in range(LONGS)]


def shingle_set(text: Column, words: int = WORDS) -> Column:
    """Sorted distinct shingle keys of a text."""
    def keys(w: Column) -> Column:
        few = F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))
        return F.when(F.size(w) < words, few).otherwise(window_keys(w, words))

    return F.sort_array(F.array_distinct(let(blank_words(lower_ascii(F.coalesce(text, F.lit("")))), keys)))


class Forest:
    """Size classes and the number of parts for a threshold in per cent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.classes: list[tuple[int, int, int, int]] = []  # lowest size, highest size, most differences, parts
        low = 1
        while low < 1 << 34:
            high = max(low, int(low * 1.7))
            differ = 2 * high * (100 - percent) // (100 + percent)
            self.classes.append((low, high, differ, differ + 1 + max(1, differ // 4)))
            low = high + 1

    def of(self, size: int) -> list[tuple[int, int]]:
        """The class of a size, and the next one if a set of that class can be linked; each with the most differences."""
        own = next(i for i, c in enumerate(self.classes) if size <= c[1])
        largest = 100 * size // self.percent
        differ = lambda i: (100 - self.percent) * (size + min(largest, self.classes[i][1])) // (100 + self.percent)
        return [(i, differ(i)) for i in (own, own + 1) if largest >= self.classes[i][0] and differ(i) > 0]

    def trees(self, keys: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        """Signatures of the trees under which a set is planted."""
        out = []
        rare = ~np.isin(keys, frequent, assume_unique=True) if len(frequent) else np.ones(len(keys), dtype=bool)
        mixed = _mix(keys)
        for k, differ in self.of(len(keys)):
            parts = self.classes[k][3]
            part = ((mixed >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
            sums = np.zeros(parts, dtype=np.uint64)
            np.add.at(sums, part, _mix(mixed))
            strong = np.bincount(part[rare], minlength=parts)
            salt = np.uint64((k + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64))
            signs = _mix(sums + np.arange(parts, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt)
            out.append(signs[np.lexsort((signs, -strong))[: differ + 1]])
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bitmap(keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * LONGS, dtype=np.uint8)
    bits[(_mix(keys) & np.uint64(64 * LONGS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _frequent(df: DataFrame, text: str, key: str, words: int) -> np.ndarray:
    sample = sample_rows(df.select(df[key].alias("k"), df[text].alias("t")), FREQUENT_SAMPLE, "k", "t")
    seen = sample.select(F.explode(shingle_set(F.col("t"), words)).alias("s")).groupBy("s").count().where(F.col("count") >= FREQUENT_IN)
    return np.sort(np.array([r["s"] for r in seen.select("s").collect()], dtype=np.int64))


def _plant(forest: Forest, frequent: np.ndarray):
    fields = [pa.field("sigs", pa.list_(pa.int64())), pa.field("spare", pa.int32()), *[pa.field(b, pa.int64()) for b in _BITS]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planted: set[tuple[int, int]] = set()  # classes that this task has planted already
        for batch in batches:
            sets, classes = batch.column(5), list(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()))
            values, ends = sets.values.to_numpy(zero_copy_only=False), sets.offsets.to_numpy()
            sigs, spare, maps = [], [], np.zeros((len(classes), LONGS), dtype=np.int64)
            for i, c in enumerate(classes):
                keys = values[ends[i] : ends[i + 1]]
                if not len(keys) or c in planted:
                    sigs.append(None)
                    spare.append(None)
                    continue
                if len(planted) < 1_000_000:
                    planted.add(c)
                sigs.append(forest.trees(keys, frequent).view(np.int64))
                maps[i] = _bitmap(keys)
                spare.append(len(keys) - int(np.bitwise_count(maps[i].view(np.uint64)).sum()))
            made = [pa.array(sigs, fields[0].type), pa.array(spare, pa.int32()), *[pa.array(maps[:, k]) for k in range(LONGS)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *made], names=["id", "h", "n", "c1", "c2", *[f.name for f in fields]])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature, those whose signature is not alone, each with its predecessor.

    The first and the last signature of a task are kept in any case: they may
    go on in a neighbouring task. One row is held back from batch to batch.
    """
    sig = row = np.zeros(0, dtype=np.int64)
    held_prev, first = None, None

    def kept(last: bool) -> pa.RecordBatch:
        same = np.append(False, sig[1:] == sig[:-1])
        if held_prev is not None:
            same[0] = True
        keep = same | np.append(same[1:], last) | (sig == first)
        prev = pa.array(np.append(held_prev or 0, row[:-1]), pa.int64(), mask=~same)
        mask = pa.array(keep if last else np.append(keep[:-1], False))
        return pa.RecordBatch.from_arrays([pa.array(sig).filter(mask), pa.array(row).filter(mask), prev.filter(mask)], names=["sig", "rid", "prev"])

    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.concatenate([sig, batch.column(0).to_numpy()])
        row = np.concatenate([row, batch.column(1).to_numpy()])
        first = sig[0] if first is None else first
        yield kept(last=False)
        if len(sig) > 1:
            held_prev = row[-2] if sig[-2] == sig[-1] else None
        sig, row = sig[-1:], row[-1:]
    if len(sig):
        yield kept(last=True)


def _small(df: DataFrame) -> DataFrame:
    """A written frame with a broadcast hint if its rows are few bytes."""
    size = df.agg(F.coalesce(F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(16 * len(df.columns)))), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _col(side: str, name: str) -> Column:
    return F.col(f"{side}.{name}")


def _most(a: str, b: str) -> Column:
    """The most shingles that a set of one node can share with one of the other."""
    both = lambda x: F.bit_count(_col(a, x).bitwiseAND(_col(b, x)))
    common = sum((both(x) for x in _BITS[1:]), both(_BITS[0]))
    return F.least(common + F.least(_col(a, "spare"), _col(b, "spare")), _col(a, "high"), _col(b, "high"))


def _able(a: str, b: str, percent: int) -> Column:
    """Whether two nodes can hold linked sets: sizes, components, and most possible overlap.

    A common shingle sets a common bit, and no more than ``spare`` shingles of
    either side share a bit with another one.
    """
    col, most = _col, _most(a, b)
    sizes = (100 * col(a, "high") >= percent * col(b, "low")) & (100 * col(b, "high") >= percent * col(a, "low"))
    apart = ~((col(a, "comp") == col(b, "comp")) & (col(a, "comp") == col(a, "comp_high")) & (col(b, "comp") == col(b, "comp_high")))
    return sizes & apart & ((100 + percent) * most >= percent * (col(a, "low") + col(b, "low")))


#: Components of a tree that is one leaf.
LEAF = 256
#: Trees by which a component tells whether another tree has told of a pair already.
FIRST_TREES = 32
#: Classes of a component that are paired with a class one by one; those of a larger one are looked up by their differences.
MANY = 16


def traverse(members: DataFrame, classes: DataFrame, percent: int = PERCENT, leaf: int = LEAF, centres: DataFrame | None = None, sets: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Pairs (a, b) of classes of different components that no level of the trees prunes, and how likely they are linked.

    ``members`` has sig, c and comp; ``classes`` has c, n, spare and the bitmap.
    ``centres`` (comp, centre) names a class of each component with several ones, ``sets`` makes
    the shingle sets (want, n, keys) of classes c; without them all classes are paired one by one.
    """
    own = members.select("c", "comp").distinct().join(classes, "c")
    own = written(own.select("c", F.col("n").alias("low"), F.col("n").alias("high"), "spare", "comp", F.col("comp").alias("comp_high"), *_BITS), "jaccard-leaves")
    whole = written(own.groupBy("comp").agg(*_union(), F.first("comp_high").alias("comp_high")), "jaccard-nodes")
    trees = members.select("sig", "comp").distinct()
    first = trees.groupBy("comp").agg(F.slice(F.sort_array(F.collect_set("sig")), 1, FIRST_TREES).alias("first"))
    sized = written(trees.join(trees.groupBy("sig").agg(F.count("*").alias("held")), "sig"), "jaccard-trees")
    few = sized.where(F.col("held") <= leaf).join(first, "comp").join(whole, "comp")
    a, b = few.alias("a"), few.alias("b")
    # of the trees that two components share, the first tells of the pair
    shared = F.array_intersect("a.first", "b.first")
    once = (F.size(shared) == 0) | (F.col("a.sig") == F.array_min(shared))
    met = (F.col("a.sig") == F.col("b.sig")) & (F.col("a.comp") < F.col("b.comp")) & _able("a", "b", percent) & once
    pairs = a.join(b, met).select(F.col("a.comp").alias("a"), F.col("b.comp").alias("b")).distinct()
    large = sized.where(F.col("held") > leaf).select("sig", "comp")
    if large.limit(1).count():
        pairs = pairs.unionAll(_descend(large, whole, percent)).distinct()
    pairs = written(pairs, "jaccard-pairs")
    # class of the smaller component and larger component, class and class
    held = written(own.groupBy("comp").agg(F.count("*").alias("held")), "jaccard-held")
    of = lambda side: held.select(F.col("comp").alias(side), F.struct("held", F.col("comp").alias("comp")).alias(f"h{side}"))
    sides = pairs.join(of("a"), "a").join(of("b"), "b").select(F.least("ha", "hb")["comp"].alias("a"), F.greatest("ha", "hb")["comp"].alias("b"))
    single = own.withColumn("key", F.col("c"))
    met = _meet(sides.join(own.select(F.col("comp").alias("a"), F.col("c").alias("x")), "a").select(F.col("x").alias("a"), "b"), single, whole.withColumn("key", F.col("comp")), percent)
    met = written(met.select("a", F.col("b").alias("comp")), "jaccard-sides")
    many = held.where(F.col("held") > MANY).join(centres, "comp").select("comp", "centre") if centres is not None else None
    many = written(many.join(met, "comp", "left_semi"), "jaccard-many") if many is not None else None
    if many is None or not many.limit(1).count():
        both = met.join(own.select("comp", F.col("c").alias("b")), "comp").select("a", "b")
    else:
        both = met.join(many, "comp", "left_anti").join(own.select("comp", F.col("c").alias("b")), "comp").select("a", "b")
        both = written(both.unionAll(_by_differences(met.join(many, "comp").select("comp", F.col("a").alias("c")), own.join(many, "comp").select("comp", "c"), many, sets, percent)), "jaccard-both")
    met = _meet(both, single, single, percent)
    return met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("likely").alias("likely"))


def _meet(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """The pairs of keys whose nodes can hold linked sets, and how much of their sizes these can share at most."""
    met = pairs.alias("p").join(left.alias("x"), F.col("p.a") == F.col("x.key")).join(right.alias("y"), (F.col("p.b") == F.col("y.key")) & _able("x", "y", percent))
    return met.select("p.a", "p.b", (_most("x", "y") / (F.col("x.low") + F.col("y.low"))).alias("likely"))


def _by_differences(outside: DataFrame, inside: DataFrame, centres: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Of the pairs of ``outside`` and ``inside`` classes (comp, c) of one comp those that may be linked: (a, b).

    All sets lose the centre's by symmetric difference. With d shingles in
    which two linked sets differ at most, C and B left of a member and of a class:
    2 |C and B| >= |C| + |B| - d, and |B| exceeds the d of class and centre,
    else these two are linked and are the only pair of the class; |C and B| >= |B| - d.
    """
    made = sets(outside.select("c").unionAll(inside.select("c")).unionAll(centres.select(F.col("centre").alias("c"))).distinct())
    centre = _small(centres.join(made, F.col("centre") == F.col("want")).select("comp", "centre", F.col("n").alias("n0"), F.col("keys").alias("k0")))

    def left(rows: DataFrame, need: Column) -> DataFrame:
        of = rows.join(made, rows["c"] == made["want"]).join(centre, "comp")
        of = of.withColumn("left", F.concat(F.array_except("keys", "k0"), F.array_except("k0", "keys"))).withColumn("size", F.size("left"))
        return of.select("comp", "c", "centre", ((100 + percent) * F.col("size") <= (100 - percent) * (F.col("n") + F.col("n0"))).alias("linked"), need.cast("long").alias("need"), "left")

    most = F.floor((100 - percent) * (F.col("n") + F.floor(100 * F.col("n") / percent)) / (100 + percent))
    more = F.floor(((100 + percent) * F.col("size") - (100 - percent) * (F.col("n") - F.col("n0"))) / (2 * (100 + percent)))
    outer = written(left(outside, F.greatest(F.lit(1), F.col("size") - most)), "jaccard-outside")
    inner = written(left(inside, more + 1).select("comp", "c", "need", F.explode("left").alias("e")), "jaccard-inside")
    common = inner.groupBy("comp", "e").agg(F.count("*").alias("in"))
    own = Window.partitionBy("comp", "c")

    def first(rows: DataFrame) -> DataFrame:
        placed = rows.join(common, ["comp", "e"]).withColumn("at", F.row_number().over(own.orderBy("in", "e"))).withColumn("size", F.count("*").over(own))
        return placed.where("at <= size - need + 1").select("comp", "e", "c")

    others = outer.where(~F.col("linked")).select("comp", "c", "need", F.explode("left").alias("e"))
    met = first(others).join(first(inner).withColumnRenamed("c", "b"), ["comp", "e"]).select(F.col("c").alias("a"), "b").distinct()
    return met.unionAll(outer.where("linked").select(F.col("c").alias("a"), F.col("centre").alias("b")))


def _union() -> list[Column]:
    return [F.min("low").alias("low"), F.max("high").alias("high"), F.max("spare").alias("spare"), *[F.bit_or(b).alias(b) for b in _BITS]]


def _descend(trees: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Dual traversal, level by level, of the trees with more components than a leaf holds; pairs of components.

    A node is named by a hash of its place; nodes that shared a name would be
    one larger node, which prunes less but loses nothing.
    """
    digit = lambda shift: F.shiftrightunsigned(F.xxhash64("comp"), shift) % 16
    place = {"band": F.floor(F.log(F.col("low").cast("double")) * 20), "d1": digit(0), "d2": digit(4), "own": F.col("comp")}
    rows = trees.join(whole, "comp").withColumn("own", F.col("comp"))
    pairs = None
    for level in range(1, len(place) + 1):
        name = lambda depth: F.xxhash64("sig", *list(place.values())[:depth])
        nodes = rows.withColumn("up", name(level - 1)).withColumn("id", name(level)).groupBy("up", "id").agg(
            *_union(), F.min("comp").alias("comp"), F.max("comp_high").alias("comp_high"), F.max("own").alias("own"))
        a, b = nodes.alias("a"), nodes.alias("b")
        going = (F.col("a.id") <= F.col("b.id")) & (_able("a", "b", percent) | ((F.col("a.id") == F.col("b.id")) & (F.col("a.comp") != F.col("a.comp_high"))))
        if pairs is None:
            found = a.join(b, (F.col("a.up") == F.col("b.up")) & going)
        else:
            # a pair of two nodes is met in either order of their children
            both = F.array_distinct(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
            both = pairs.select(F.inline(both))
            found = both.alias("p").join(a, F.col("p.a") == F.col("a.up")).join(b, (F.col("p.b") == F.col("b.up")) & going)
        last = level == len(place)
        pairs = written(found.select(F.col("a.own" if last else "a.id").alias("a"), F.col("b.own" if last else "b.id").alias("b")), "jaccard-level")
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _short(keys: Column) -> Column:
    """The distinct 16-bit keys of a set."""
    return F.array_distinct(F.transform(keys, lambda k: F.shiftright(k, 48).cast("short")))


def _sets(one: DataFrame, df: DataFrame, text: str, key: str, words: int, kept: Callable[[Column], Column]) -> DataFrame:
    """want, n and keys: ``kept`` of the shingle sets of the classes in ``one``, which are made again."""
    rows = df.select(df[key].alias("id"), df[text].alias("t")).join(_small(one.drop("copies")), F.col("id").eqNullSafe(F.col("want_id")))
    # exploded, so that the sets are made after the join and not as its key
    same = lambda k: (_name1(k) == F.col("c1")) & (_name2(k) == F.col("c2"))
    right_one = let(shingle_set(F.col("t"), words), lambda k: F.when(same(k), F.array(F.struct(F.size(k).alias("n"), kept(k).alias("keys")))))
    sets = rows.select("want", F.inline(right_one))
    return written(sets.dropDuplicates(["want"]) if one.where("copies > 1").limit(1).count() else sets, "jaccard-sets")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets can be linked. Shingles beyond a set's distinct keys share a key, and may all be common."""
    side = lambda p: sets.select(F.col("want").alias(p), F.col("n").alias(f"n{p}"), F.col("keys").alias(f"k{p}"))
    spare = F.least(F.col("na") - F.size("ka"), F.col("nb") - F.size("kb"))
    both = F.size(F.array_intersect("ka", "kb")) + spare
    linked = (100 + percent) * both >= percent * (F.col("na") + F.col("nb"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(linked).select("a", "b")


def _wanted(wanted: DataFrame, named: DataFrame) -> DataFrame:
    """A row to make the shingle set from for each of the classes c of ``wanted``, and how many have its id."""
    texts = named.where("n > 0").join(wanted, "c", "left_semi").groupBy("c", "c1", "c2", "id").agg(F.count("*").alias("copies"))
    one = texts.groupBy("c").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "copies", "c1", "c2")).alias("x"))
    return written(one.select(F.col("c").alias("want"), F.col("x.id").alias("want_id"), "x.copies", "x.c1", "x.c2"), "jaccard-wanted")


def _exact(pairs: DataFrame, df: DataFrame, named: DataFrame, text: str, key: str, words: int, percent: int) -> DataFrame:
    """The pairs of classes that are linked, by their shingle sets, which are made again for the classes in question only."""
    one = _wanted(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), named)
    near = written(_compared(pairs, _sets(one, df, text, key, words, _short), percent), "jaccard-near")
    still = near.select(F.explode(F.array("a", "b")).alias("want")).distinct()
    one = written(one.join(still, "want", "left_semi"), "jaccard-wanted")
    return _compared(near, _sets(one, df, text, key, words, lambda k: k), percent)


def _likeliest(pairs: DataFrame, each: int) -> DataFrame:
    """Of the pairs (a, b) with ``likely`` those that are among the ``each`` likeliest ones of a or of b."""
    both = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("own"), "a", "b", "likely"), F.struct(F.col("b").alias("own"), "a", "b", "likely"))))
    order = Window.partitionBy("own").orderBy(F.desc("likely"), F.xxhash64("a", "b"))
    return both.withColumn("at", F.row_number().over(order)).where(F.col("at") <= each).select("a", "b").distinct()


def connect(left: DataFrame, roots: DataFrame, exact: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(member, root) of classes linked by ``roots`` or by those pairs of ``left`` (a, b, likely) which ``exact`` finds linked.

    Every pair is compared, or lies within one component already.
    """
    each = NEIGHBOURS
    while True:
        of = lambda side: roots.select(F.col("member").alias(side), F.col("root").alias(f"r{side}"))
        apart = F.coalesce("ra", "a") != F.coalesce("rb", "b")
        left = written(left.join(of("a"), "a", "left").join(of("b"), "b", "left").where(apart).select("a", "b", "likely"), "jaccard-apart")
        pairs = left.count()
        if not pairs:
            return roots
        whole = pairs <= NEIGHBOURS * left.select(F.explode(F.array("a", "b")).alias("c")).distinct().count()
        some = left.select("a", "b") if whole else written(_likeliest(left, each), "jaccard-some")
        roots = components(roots.select(F.col("member").alias("a"), F.col("root").alias("b")).unionAll(exact(some)))
        if whole:
            return roots
        left, each = left.join(some, ["a", "b"], "left_anti"), 8 * each


def _name1(keys: Column) -> Column:
    return F.xxhash64(keys)


def _name2(keys: Column) -> Column:
    """A second key of a set: another function of the same values, chained from another seed."""
    return F.xxhash64(F.lit("set"), keys)


def link_classes(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: the rows (id, hash h of the text, n, class c), the classes' trees and bitmaps, and (member, root) of linked classes."""
    forest, frequent = Forest(percent), _frequent(df, text, key, words)
    keyed = df.select(df[key].alias("id"), F.xxhash64(df[text]).alias("h"), shingle_set(df[text], words).alias("keys"))
    keyed = keyed.select("id", "h", F.size("keys").cast("long").alias("n"), _name1(F.col("keys")).alias("c1"), _name2(F.col("keys")).alias("c2"), "keys")
    id_type = df.schema[key].dataType.simpleString()
    schema = f"id {id_type}, h long, n long, c1 long, c2 long, sigs array<long>, spare int, " + ", ".join(f"{b} long" for b in _BITS)
    planted = keyed.mapInArrow(_plant(forest, frequent), schema).withColumn("rid", F.monotonically_increasing_id())
    with arrow_rows(df.sparkSession, TEXT_ROWS):
        planted = written(planted, "jaccard-planted")
    # a class is named by its first row, which every task plants
    rows = planted.select("rid", "id", "h", "n", "c1", "c2")
    classes = rows.where("n > 0").groupBy("c1", "c2").agg(F.min("rid").alias("c"))
    named = rows.where("n > 0").join(classes, ["c1", "c2"]).select(*rows.columns, "c")
    named = written(named.unionAll(rows.where("n = 0").select("*", F.lit(None).cast("long"))), "jaccard-named")

    trees = planted.where("sigs is not null").select(F.explode("sigs").alias("sig"), "rid")
    shared = trees.repartitionByRange("sig", "rid").sortWithinPartitions("sig", "rid").mapInArrow(_runs, "sig long, rid long, prev long")
    shared = written(shared, "jaccard-shared")
    leaves = planted.where("sigs is not null").select(F.col("rid").alias("c"), "n", "spare", *_BITS)

    # chains: of the neighbours in its trees, a class is compared with the likeliest ones
    exact = lambda pairs: _exact(pairs, df, named, text, key, words, percent)
    names = named.where("n > 0").select("rid", "c")
    met = shared.where("prev is not null").select("prev", "rid").distinct()
    met = met.join(names.select(F.col("rid").alias("prev"), F.col("c").alias("x")), "prev").join(names.select("rid", F.col("c").alias("y")), "rid").where("x != y")
    met = written(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "jaccard-met")
    met_ones = met.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    alone = leaves.join(met_ones, "c", "left_semi").select(F.col("c").alias("key"), F.col("n").alias("low"), F.col("n").alias("high"), "spare", F.col("c").alias("comp"), F.col("c").alias("comp_high"), *_BITS)
    chains = written(_likeliest(_meet(met, alone, alone, percent), NEIGHBOURS), "jaccard-chains")
    links = written(exact(chains), "jaccard-links")
    roots = components(links)
    # of each component of several classes, the one with most links
    ends = links.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count("*").alias("links"))
    ends = ends.join(roots, ends["c"] == roots["member"], "left").groupBy(F.coalesce("root", "c").alias("comp"))
    centres = ends.agg(F.max(F.struct("links", "c"))["c"].alias("centre"))

    # trees with several components are traversed
    known = names.join(roots, names["c"] == roots["member"], "left").select("rid", "c", F.coalesce("root", "c").alias("comp"))
    placed = shared.select("sig", "rid").join(known, "rid")
    mixed = placed.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("sig")
    members = written(placed.join(mixed, "sig", "left_semi").select("sig", "c", "comp").distinct(), "jaccard-open")
    sets = lambda wanted: _sets(_wanted(wanted, named), df, text, key, words, lambda k: k)
    return named, planted, connect(traverse(members, leaves, percent, centres=centres, sets=sets), roots, exact)


def label_components(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """id (the key), n_shingles and component_id of every row of ``df``."""
    named, _, roots = link_classes(df, text, key, words, percent)
    rows = named.join(roots, named["c"] == roots["member"], "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("root", "c").alias("comp"))
    names = rows.where("n_shingles > 0").groupBy("comp").agg(F.min("id").alias("smallest"), F.count("*").alias("size"))
    named = rows.join(names, "comp", "left")
    alone = F.col("n_shingles") == 0
    return named.select("id", "n_shingles", F.when(alone, F.col("id")).otherwise(F.col("smallest")).alias("component_id"), F.when(alone, 1).otherwise(F.col("size")).alias("component_size"))


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that with the smallest key, unchanged; rows without shingles all stay."""
    named, _, roots = link_classes(df, text, key, words, percent)
    rows = named.join(roots, named["c"] == roots["member"], "left").withColumn("comp", F.coalesce("root", "c"))
    texts = rows.where("n > 0").groupBy("comp", "id", "h").agg(F.count("*").alias("copies"))
    first = texts.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "copies")).alias("x")).select("x.id", "x.h", "x.copies")
    bare = rows.where("n = 0").select("id", "h", F.lit(1).cast("long").alias("copies")).distinct()
    stay = written(first.unionAll(bare), "jaccard-stay")
    same = lambda some: df[key].eqNullSafe(some["id"]) & (F.xxhash64(df[text]) == some["h"])
    once, again = stay.where("copies = 1"), stay.where("copies > 1")
    return df.join(once, same(once), "left_semi").unionAll(df.join(again, same(again), "left_semi").dropDuplicates([key, text]))


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = label_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "component_size")
