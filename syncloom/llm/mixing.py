"""Mixing sources to target weights, with DataFrame functions only.

Every source's words are packed, in a fixed pseudorandom order of its documents, into blocks of `block_words` words (the last may be
shorter). A source's target fixes how many block slots it gets; every slot is dealt to an output shard by an independent uniform hash, so
that a shard's counts by source are a multinomial draw, given the totals. Slot i of a pass over the source reads block p(i), where p
is a pseudorandom permutation of the block numbers (swap-or-not rounds, keyed by source and pass); blocks are then joined by number.

Scale: texts are read once, for their sizes. Sizes are summed by (source, bucket) before any window, so that a hot source is spread over
as many buckets as its rows need; slots are made in runs and joined by (source, block), which spreads a hot source too.

Defined results: null or empty text has size 0 and is never taken; a null source is a source of its own, the last; repeated rows
count each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, join_checked

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one source that one window partition orders.
BUCKET_ROWS = 4_000
#: Slots that one row is expanded to.
RUN_SLOTS = 4_096
ROUNDS = 24


def word_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """s_id, source, docs, source_size, target: shares of budget x all sizes by weight, at most cap x the source's size each.

    Sources in code point order (null last) weigh as in `weights`, repeating. With sources ordered by cap / weight, those above the
    common level stop at their cap; the level is what the rest shares.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "s_id").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranked = per_source.withColumn("s_id", F.row_number().over(by_name) - 1).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s_id") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.lit(cap) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    before = lambda c: F.coalesce(F.sum(c).over(by_ratio), F.lit(0.0))
    left = F.lit(budget) * F.sum("source_size").over(every) - before("most")
    level = left / (F.sum("weight").over(every) - before("weight"))
    ranked = ranked.withColumn("level", level)
    final = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "s_id", "level"))).over(every)["level"]
    return ranked.withColumn("target", F.least("most", F.coalesce(final * F.col("weight"), F.col("most")))).select("s_id", "source", "docs", "source_size", "target")


def _permuted(x: Column, n: Column, *key: Column) -> Column:
    """x in 0..n-1 under a permutation of that range that `key` picks (swap-or-not shuffle)."""

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.xxhash64(*key, r) - at, n)
        return F.when(F.xxhash64(*key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), x, step)


def packed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Sizes with s_id, source_size, target and start: the words of the source before the document, in the order of packing."""
    rows = join_checked(sizes.withColumnRenamed("source", "own"), sources, F.col("own").eqNullSafe(F.col("source")), "inner").drop("own")
    spread = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("size")))  # rows without an id go by their size
    rows = rows.withColumn("bucket", F.pmod(spread, F.ceil(F.col("docs") / BUCKET_ROWS)))
    base = rows.groupBy("s_id", "bucket").agg(F.sum("size").alias("words"))
    base = base.select("s_id", "bucket", F.coalesce(F.sum("words").over(Window.partitionBy("s_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("s_id", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return join_checked(rows, checkpoint(base), ["s_id", "bucket"]).withColumn("start", F.col("base") + F.col("before")).drop("base", "before", "bucket", "docs")


def slots(sources: DataFrame, block_words: int = 256, shard_slots: int = 4096, seed: int = 17) -> DataFrame:
    """shard, s_id, pass, block, words: one row for each block that the mix takes; words < block_words only at a source's end."""
    b = F.lit(block_words)
    plan = sources.filter("source_size > 0").withColumn("words", F.round("target").cast("long"))
    plan = plan.withColumn("blocks", F.ceil(F.col("source_size") / b)).withColumn("whole", F.expr("words div source_size")).withColumn("rest", F.expr("words % source_size"))
    plan = plan.withColumn("n", F.col("whole") * F.col("blocks") + F.ceil(F.col("rest") / b)).filter("n > 0")
    total = plan.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_slots))
    runs = plan.select("s_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN_SLOTS))).alias("run"))
    dealt = runs.repartition("s_id", "run").select("s_id", F.explode(F.sequence(F.col("run") * RUN_SLOTS, F.least(F.col("n"), (F.col("run") + 1) * RUN_SLOTS) - 1)).alias("slot"))
    drawn = dealt.groupBy("s_id", F.pmod(F.xxhash64(F.lit(seed), "s_id", "slot"), F.lit(shards)).alias("shard")).agg(F.count(F.lit(1)).alias("drawn"))
    first = F.coalesce(F.sum("drawn").over(Window.partitionBy("s_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = drawn.withColumn("first", first)
    drawn = drawn.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s_id", "shard")  # few rows here, but each becomes many
    taken = drawn.select("s_id", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("drawn") - 1)).alias("slot"))
    taken = join_checked(taken, plan.select("s_id", "source_size", "blocks", "whole", "rest"), "s_id")
    taken = taken.withColumn("pass", F.expr("slot div blocks")).withColumn("i", F.expr("slot % blocks"))
    full = F.expr(f"source_size div {block_words}")
    block = F.when(F.col("i") < full, _permuted(F.col("i"), full, F.lit(seed), F.col("s_id"), F.col("pass"))).otherwise(F.col("i"))
    words = F.least(b.cast("long"), F.col("source_size") - block * b, F.when(F.col("pass") == F.col("whole"), F.col("rest") - F.col("i") * b).otherwise(b.cast("long")))
    return taken.select("shard", "s_id", "pass", block.alias("block"), words.alias("words"))


def mixed_pieces(rows: DataFrame, chosen: DataFrame, block_words: int = 256) -> DataFrame:
    """The mix itself: which words (from, to of the document) of which document each chosen block brings to which shard."""
    b = block_words
    pieces = rows.filter("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")))
    joined = pieces.join(chosen, ["s_id", "block"])
    low, high = F.greatest(F.col("start"), F.col("block") * b), F.least(F.col("start") + F.col("size"), F.col("block") * b + F.col("words"))
    return joined.withColumn("from", low - F.col("start")).withColumn("to", high - F.col("start")).filter(F.col("to") > F.col("from"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0, block_words: int = 256, shard_slots: int = 4096, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every document; taken counts repeats."""
    sizes = checkpoint(word_sizes(docs))
    sources = checkpoint(source_targets(sizes, weights, budget, cap))
    rows = checkpoint(packed(sizes, sources))  # read three times below
    pieces = mixed_pieces(rows, slots(sources, block_words, shard_slots, seed), block_words)
    took = pieces.groupBy("s_id", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    with_words = rows.filter("size > 0").join(took, ["s_id", "start"], "left")
    columns = ["doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")]
    return with_words.select(*columns).unionByName(rows.filter("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")))
