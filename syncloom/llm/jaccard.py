"""Exact Jaccard similarity join of word n-gram sets, as a join in the metric space of Jaccard distance.

Documents with the same set are one point. Almost all pairs of points are at the greatest distance, 1, where a pivot tells nothing, so pivots are
sought only where one can be near: in a fixed order of all shingles, two sets with Jaccard similarity of at least s share one of the first
n - ceil(s n) + 1 shingles of each. The points that hold such a shingle are a bucket (this part is a prefix filter); its smallest id is its first
pivot, against which every point of the bucket is measured, exactly. A bucket whose points all are in one class by then is done. A larger one
is cut into Voronoi cells: some of its points become pivots, all points are measured against them, each goes to the cell of its nearest pivot, and
also to every cell whose pivot is at most 2 (1 - s) farther: by the triangle inequality, two linked points are in one cell of each other's so.
Cells are cut again while they are large, DEPTH times at most. Small cells, and what is still large, are joined: points of different classes are
compared if |d(x, p) - d(y, p)| <= 1 - s for the pivot p of the cell. Large cells are joined in blocks, every pair of blocks in a task of its own.

The order puts rare shingles first: those that stand in more than HEAVY prefixes of a first order (by hash), and all frequent shingles of the points
that hold many such, come after the others, by the logarithm of their count. A passage or line which many documents share thus
makes no bucket, and a point with many shingles of its own stands in no bucket at all. Where two points' first common shingle stands bounds their
overlap, too, so most pairs of a bucket are ruled out by number. The order is the same for all points; which shingles are
counted (HEAVY_LIST at most, 9 bytes each, are broadcast) changes only the cost, never the result.

Scale: sets are made in a few passes over the texts; only prefixes (a share 1 - s of a
set) are shuffled, then only the sets of points that share a region with another. A group of k near copies costs about k comparisons
with its pivot, not k^2, and no group is ever collected in one task. Sets are 64-bit hashes of shingles, points are named by 64-bit set
hash and size: at 10^10 different sets, a false identity has a chance of under 1 %.

Defined results: null, empty or wordless text has the empty set, no link and its own id; fewer words than a shingle are one shingle; repeated
rows with one id are one document, with the smallest of their texts; documents without an id get the class of documents with the
same set, if there are any, and link nothing; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, is_small, join_checked, map_arrow, text_chunks
from .components import components
from .textops import mix64, shingles, words

#: Points that may share a prefix shingle before it comes later in the order; how many such shingles are told to the workers.
HEAVY, HEAVY_LIST = 6, 1_000_000
#: All shingles are counted of points with this share of heavy ones in their prefix.
MANY = 1 / 2
#: Points of a region (a bucket or a cell) that aren't cut further; pivots that cut a larger one into cells; how often cells are cut.
LEAF, PIVOTS, DEPTH = 4_096, 8, 2
#: Points of a block; what cuts have left of a region is compared in pairs of blocks.
BLOCK = 4_096
#: Parts of a group of equal sets when its documents look up what stands for them.
SALT = 16
#: Rows up to which a list of ids, or of regions, is broadcast; a longer one is joined by a shuffle.
ID_ROWS, REGION_ROWS = 1_000_000, 2_000_000


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    n = len(offsets) - 1
    values, at = shingles(words(data, offsets), n, k)
    for i in range(n):
        yield np.unique(values[at[i] : at[i + 1]])


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1 if n else 0


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)), pa.array(flat))


def points(docs: DataFrame, k: int) -> DataFrame:
    """id, n, fp for every document: the size and hash of its set."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch, "text"):
                sets = list(_sets(data, offsets, k))
                with np.errstate(over="ignore"):
                    fp = [int(mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp, pa.int64())], names=["id", "n", "fp"])

    return map_arrow(docs, run, f"id {id_type}, n long, fp long")


class _Order:
    """Heavy shingles, sorted, and the class of each by the logarithm of its count."""

    def __init__(self, counts: DataFrame):
        found = counts.orderBy(F.desc("count"), "shingle").limit(HEAVY_LIST).toArrow()
        shingle = np.asarray(found.column("shingle").combine_chunks()).view(np.uint64) if found.num_rows else np.zeros(0, np.uint64)
        order = np.argsort(shingle)
        self.shingle = shingle[order]
        self.kind = (np.log2(np.asarray(found.column("count"))[order].astype(float)) + 1).astype(np.uint8) if found.num_rows else np.zeros(0, np.uint8)

    def kinds(self, s: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.shingle, s), len(self.shingle) - 1)
        return np.where(self.shingle[at] == s, self.kind[at], 0)


def heavy_counts(docs: DataFrame, k: int, percent: int, order: _Order) -> DataFrame:
    """shingle, count: how many documents with MANY heavy shingles in their prefix hold a shingle that isn't known as heavy. Counted within batches first."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            held = []
            for _, _, data, offsets in text_chunks(batch, "text"):
                for s in _sets(data, offsets, k):
                    size = _prefix_size(len(s), percent)
                    if not size:
                        continue
                    kinds = order.kinds(s)
                    if np.count_nonzero(kinds[:size]) >= MANY * size:
                        held.append(s[kinds == 0])
            if held:
                shingle, count = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(count.astype(np.int64))], names=["shingle", "count"])

    return map_arrow(docs.select("text"), run, "shingle long, count long").groupBy("shingle").agg(F.sum("count").alias("count")).filter(F.col("count") > HEAVY)


def prefixes(docs: DataFrame, k: int, percent: int, order: _Order | None = None) -> DataFrame:
    """id, n, prefix: the first shingles of every document in the order, or in order of hash without one."""
    id_type = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch, "text"):
                n, out = [], []
                for s in _sets(data, offsets, k):
                    size = _prefix_size(len(s), percent)
                    n.append(len(s))
                    kinds = order.kinds(s) if order is not None and len(order.shingle) and size else None
                    out.append(s[:size] if kinds is None or not kinds[:size].any() else s[np.argsort(kinds, kind="stable")[:size]])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), _lists(out)], names=["id", "n", "prefix"])

    return map_arrow(docs, run, f"id {id_type}, n long, prefix array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """id, shingles: whole sets."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), _lists(list(_sets(data, offsets, k)))], names=["id", "shingles"])

    return map_arrow(docs, run, f"id {id_type}, shingles array<long>")


def _may_link(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Whether two sets whose first common shingle stands at these positions of their order can overlap enough."""
    return F.least(na - pa_, nb - pb) * (100 + percent) >= (na + nb) * percent


class _Measured:
    """Exact overlaps of pairs of points, and the sets they need, each made once."""

    def __init__(self, docs: DataFrame, k: int):
        self.docs, self.k = docs, k
        self.sets: DataFrame | None = None

    def overlaps(self, pairs: DataFrame) -> DataFrame:
        """pairs (a, b, na, nb) with `common`, the size of the intersection. Big sets move once to the pairs of their point."""
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        wanted = ids if self.sets is None else ids.join(self.sets.select("id"), "id", "left_anti")
        made = checkpoint(shingle_sets(join_checked(self.docs, checkpoint(wanted), "id", "left_semi", rows=ID_ROWS), self.k).dropDuplicates(["id"]))
        self.sets = made if self.sets is None else self.sets.unionByName(made)
        a = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        b = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        with_sets = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "sa", "sb")
        kind = pairs.schema["a"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                left, right = batch.column(4), batch.column(5)
                lo, ro = np.asarray(left.offsets), np.asarray(right.offsets)
                lv, rv = np.asarray(left.values).view(np.uint64), np.asarray(right.values).view(np.uint64)
                common = [len(np.intersect1d(lv[lo[r] : lo[r + 1]], rv[ro[r] : ro[r + 1]], assume_unique=True)) for r in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(common, pa.int64())], names=["a", "b", "na", "nb", "common"])

        return checkpoint(map_arrow(with_sets, run, f"a {kind}, b {kind}, na long, nb long, common long"))


def link_classes(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n, component for every document: links are pairs with 100 * intersection >= percent * union."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    distance = float(1 - Fraction(percent, 100))
    all_points = checkpoint(points(docs, k))
    repeated = checkpoint(all_points.groupBy("id").count().filter("count > 1").select(F.col("id").alias("again")))
    if not repeated.isEmpty():
        is_repeated = F.col("id").eqNullSafe(F.col("again"))
        one = join_checked(docs, repeated, is_repeated, "left_semi").groupBy("id").agg(F.min("text").alias("text"))
        docs = join_checked(docs, repeated, is_repeated, "left_anti").unionByName(one)
        all_points = checkpoint(points(docs, k))
    # one point for each distinct set: the others are copies
    real = all_points.filter("n > 0")
    reps = real.groupBy("fp", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("holders"))
    reps = checkpoint(reps.filter("holders > 1").select("fp", "n", "rep"))
    if is_small(reps):
        looked_up = all_points.join(F.broadcast(reps), ["fp", "n"], "left")
    else:  # a set may stand in a third of all documents
        parts = reps.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        looked_up = all_points.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int")).join(parts, ["fp", "n", "part"], "left")
    alone = F.when(F.col("n") > 0, F.col("id"))
    mapped = checkpoint(looked_up.select("id", "n", F.coalesce("rep", alone).alias("rep")))
    copies = checkpoint(mapped.filter("id <> rep").select("id"))
    few = is_small(copies, ID_ROWS)
    only_points = lambda df: df.filter("n > 0 and id is not null").join(F.broadcast(copies) if few else copies, "id", "left_anti")
    # the order: frequent shingles last
    counts = only_points(prefixes(docs, k, percent)).select(F.explode("prefix").alias("shingle")).groupBy("shingle").count().filter(F.col("count") > HEAVY)
    counts = checkpoint(counts.withColumn("count", F.expr(f"`count` * 100 div {max(1, 100 - percent)}")))
    order = _Order(counts)
    if len(order.shingle):
        order = _Order(counts.unionByName(heavy_counts(docs, k, percent, order)).groupBy("shingle").agg(F.max("count").alias("count")))
    # regions of more than one point, and their pivots
    final = checkpoint(only_points(prefixes(docs, k, percent, order)))
    entries = final.select(F.posexplode("prefix").alias("pos", "region"), "id", "n")
    shared = checkpoint(entries.groupBy("region").count().filter("count > 1").select("region"))
    members = checkpoint(join_checked(entries, shared, "region", "left_semi", rows=REGION_ROWS))
    pivot = members.groupBy("region").agg(F.min("id").alias("id")).join(members, ["region", "id"]).select("region", F.col("id").alias("pivot"), F.col("n").alias("np"), F.col("pos").alias("pp"))
    pairs = members.join(pivot, "region").filter("id <> pivot").filter(_may_link(F.col("n"), F.col("pos"), F.col("np"), F.col("pp"), percent))
    pairs = pairs.select(F.col("pivot").alias("a"), F.col("id").alias("b"), F.col("np").alias("na"), F.col("n").alias("nb")).distinct()
    measured = _Measured(docs, k)
    known = measured.overlaps(checkpoint(pairs))
    linked = lambda m: m.filter(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent)
    classes = checkpoint(components(linked(known).select("a", "b")))
    classes = _closed(members, known, classes, measured, percent, distance, linked)
    found = mapped.join(classes.withColumnRenamed("id", "rep"), "rep", "left")
    return found.select("id", "n", F.coalesce("component", "rep", "id").alias("component"))


def _joined_classes(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes after more links: only the classes themselves are joined, whatever their size."""
    name = lambda end: F.coalesce(f"c_{end}", end)
    of = lambda end: classes.select(F.col("id").alias(end), F.col("component").alias(f"c_{end}"))
    between = checkpoint(edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(name("a").alias("a"), name("b").alias("b")).filter("a <> b"))
    if between.isEmpty():
        return classes
    joined = checkpoint(components(between).select(F.col("id").alias("was"), F.col("component").alias("now")))
    moved = classes.join(joined, F.col("component") == F.col("was"), "left").select("id", F.coalesce("now", "component").alias("component"))
    alone = joined.join(classes.select(F.col("id").alias("was")), "was", "left_anti").select(F.col("was").alias("id"), F.col("now").alias("component"))
    return checkpoint(moved.unionByName(alone))


def _pairs(x: DataFrame, y: DataFrame, on: list[str], keep: Column, percent: int) -> DataFrame:
    """(a, b, na, nb) with a < b, each once, of rows of x (a, na, pa, ca) and y (b, nb, pb, cb) that `keep` and their sizes leave open."""
    met = x.join(y, on).filter(F.col("a") != F.col("b")).filter(keep).filter(_may_link(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent))
    first = F.col("a") < F.col("b")
    pick = lambda p, q: F.when(first, F.col(p)).otherwise(F.col(q))
    return met.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), pick("na", "nb").alias("nlo"), pick("nb", "na").alias("nhi")).toDF("a", "b", "na", "nb").distinct()


def _closed(members: DataFrame, known: DataFrame, classes: DataFrame, measured: _Measured, percent: int, radius: float, linked) -> DataFrame:
    """Classes after all regions with points of more than one class have been joined. Rounds end after DEPTH at the latest."""
    slack = 1e-9
    spread = F.lit(1.0) - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    side = lambda df, s: df.select("region", F.col("id").alias(s), F.col("n").alias(f"n{s}"), F.col("pos").alias(f"p{s}"), F.col("class").alias(f"c{s}"), F.col("d").alias(f"d{s}"), *[F.col(c).alias(f"{c}{s}") for c in df.columns if c == "block"], *[c for c in df.columns if c in ("low", "high")])
    # the first pivot of a bucket has met all of it; distances to it are known as far as sizes left them open
    first = members.groupBy("region").agg(F.min("id").alias("a"))
    far = known.select("a", F.col("b").alias("id"), spread.alias("d"))
    members = checkpoint(members.join(first, "region").filter("id <> a").join(far, ["a", "id"], "left").select("region", "id", "n", "pos", "d"))
    for depth in range(DEPTH + 1):
        own = members.join(classes, "id", "left").withColumn("class", F.coalesce("component", "id")).drop("component")
        regions = own.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min("class").alias("least"), F.max("class").alias("most")).filter("least <> most")
        regions = checkpoint(regions.select("region", "size"))
        if regions.isEmpty():
            return classes
        rest = checkpoint(own.join(regions, "region"))
        large = rest.filter(F.col("size") > LEAF) if depth < DEPTH else rest.limit(0)
        here = rest.filter(F.col("size") <= LEAF) if depth < DEPTH else rest
        # joined now: in blocks of about BLOCK points, a point of block k takes part in every pair of blocks with k in it
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        cut = here.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        cut = cut.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        window = F.coalesce(F.abs(F.col("da") - F.col("db")) <= radius + slack, F.lit(True))
        once = (F.least("blocka", "blockb") == F.col("low")) & (F.greatest("blocka", "blockb") == F.col("high"))
        pairs = _pairs(side(cut, "a"), side(cut, "b"), ["region", "low", "high"], (F.col("ca") != F.col("cb")) & window & once & (F.col("a") < F.col("b")), percent)
        cells = not large.isEmpty()
        if cells:
            chance = F.pmod(F.xxhash64("id", F.lit(depth)), F.ceil(F.col("size") / (4 * PIVOTS))) == 0
            point = F.struct("id", "n", "class", "pos")
            chosen = large.groupBy("region").agg(F.slice(F.sort_array(F.collect_set(F.when(chance, point))), 1, PIVOTS).alias("some"), F.min(point).alias("one"))
            chosen = chosen.select("region", F.explode(F.when(F.size("some") > 0, F.col("some")).otherwise(F.array("one"))).alias("p"))
            chosen = checkpoint(chosen.select("region", "p.*").withColumn("d", F.lit(0.0)))
            pairs = pairs.unionByName(_pairs(side(large.drop("size"), "a"), side(chosen, "b"), ["region"], F.lit(True), percent)).distinct()
        new = checkpoint(pairs.join(known.select("a", "b"), ["a", "b"], "left_anti"))
        if not new.isEmpty():
            found = measured.overlaps(new)
            known = known.unionByName(found)
            classes = _joined_classes(linked(found).select("a", "b"), classes)
        if not cells:
            return classes
        # a pair that sizes rule out is unlinked at any distance; for its cell the distance is bounded by what the sizes allow
        bound = F.lit(1.0) - F.least("n", "np") / F.greatest("n", "np")
        met = large.select("region", "id", "n", "pos").join(chosen.select("region", F.col("id").alias("pivot"), F.col("n").alias("np")), "region")
        met = met.withColumn("a", F.least("id", "pivot")).withColumn("b", F.greatest("id", "pivot")).join(known.select("a", "b", spread.alias("d")), ["a", "b"], "left")
        met = met.filter("id <> pivot").withColumn("at_least", F.coalesce("d", bound)).withColumn("at_most", F.coalesce("d", F.lit(1.0)))
        nearest = met.groupBy("region", "id").agg(F.min("at_most").alias("nearest"))
        near = met.join(nearest, ["region", "id"]).filter(F.col("at_least") - F.col("nearest") <= 2 * radius + slack)
        gone = chosen.select("region", "id")  # pivots have met their whole region
        near = near.join(gone, ["region", "id"], "left_anti")
        members = checkpoint(near.select(F.xxhash64("region", "pivot").alias("region"), "id", "n", "pos", "d"))
    return classes
