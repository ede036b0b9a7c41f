"""Key-range chunk plans without a global sort in one task.

Exact global ranks come from a range partitioning, written once so that it stays as it is: a row's rank is its number within its sorted partition
plus the sizes of the partitions before. Tiles follow from ranks by arithmetic. There are as many partitions as the session shuffles into, whatever
the number of tiles. Plans need no rows: they count keys first, so a hot key is one row; an assignment spreads rows with
equal keys by the columns that break ties and by a hash of the row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import checkpoint

#: Bits of monotonically_increasing_id that number the rows of a partition.
_ROW_BITS = 33


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """df in range partitions, written; `_part` numbers them in order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpoint(df.repartitionByRange(parts, *order)).withColumn("_part", F.spark_partition_id())


def _with_offsets(df: DataFrame, size: Column) -> tuple[DataFrame, int]:
    """(df with `_before`, the sum of sizes in all partitions before; the sum of all); a row for each partition is on the driver."""
    sizes = {r["_part"]: r["size"] for r in df.groupBy("_part").agg(F.sum(size).alias("size")).collect()}
    before, at = [], 0
    for part in sorted(sizes):
        before.append((part, at))
        at += sizes[part]
    return df.join(F.broadcast(df.sparkSession.createDataFrame(before, "_part int, _before bigint")), "_part"), at


def _hashable(name: str, kind: T.DataType) -> Column:
    """A column, or its JSON text if a map in it can't be hashed."""
    return F.to_json(F.struct(F.col(f"`{name}`"))) if "map<" in kind.simpleString() else F.col(f"`{name}`")


def tile_of(rank: Column, rows: int, tiles: int) -> Column:
    """Tile, from 1, of a 0-based rank when `rows` rows go to `tiles` tiles whose sizes differ by one at most, larger ones first."""
    q, r = divmod(rows, tiles)
    wide = r * (q + 1)
    small = F.lit(r) + F.floor((rank - wide) / max(q, 1)) + 1
    return F.when(rank < wide, F.floor(rank / (q + 1)) + 1).otherwise(small).cast("int")


def tile_count(rows: int, chunk_rows: int) -> int:
    return max(1, math.ceil(rows / chunk_rows))


def chunk_assign(df: DataFrame, key: str, tiles: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """df with chunk_no: ntile(tiles) over (order by key, ties), NULL keys first. Every row is in just one chunk; rows equal in all of these, in any.

    A column chunk_no of df's own is replaced. Columns of any type and name may stand beside the key; the row itself travels in a struct.
    """
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.xxhash64(*[_hashable(f.name, f.dataType) for f in df.schema.fields]).alias("_spread"))
    order = [F.col("_row")[key].asc_nulls_first(), *[F.col("_row")[c].asc_nulls_first() for c in ties], F.col("_spread").asc()]
    ranged = _ranged(held, order).sortWithinPartitions(*order)
    numbered = ranged.withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    ranked, n = _with_offsets(numbered, F.lit(1))
    tile = tile_of(F.col("_at") + F.col("_before"), n, tiles) if n else F.lit(None).cast("int")
    return ranked.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != "chunk_no"], tile.alias("chunk_no"))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """_key, _rows: the rows of every key."""
    return df.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))


def _first_ranks(counted: DataFrame) -> tuple[DataFrame, int]:
    """(_key, _rows and _first, the rank of its first row, for every key of `key_counts`; rows in all)."""
    counted = checkpoint(counted)
    order = Window.partitionBy("_part").orderBy(F.col("_key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    inside, n = _with_offsets(_ranged(counted, [F.col("_key").asc_nulls_first()]), F.col("_rows"))
    return inside.withColumn("_first", F.col("_before") + F.coalesce(F.sum("_rows").over(order), F.lit(0))).select("_key", "_rows", "_first"), n


def _no_chunks(counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(None).cast("int").alias("chunk_no"), F.col("_key").alias("min_key"), F.col("_key").alias("max_key"), F.lit(0).cast("bigint").alias("row_count")).limit(0)


def chunk_plan(df: DataFrame, key: str, tiles: int) -> DataFrame:
    """chunk_no, min_key, max_key, row_count. An empty table has no chunks. A key whose rows span several chunks is counted into each by arithmetic."""
    counted = key_counts(df, key)
    ranks, n = _first_ranks(counted)
    if not n:
        return _no_chunks(counted)
    last = F.col("_first") + F.col("_rows") - 1
    spread = ranks.withColumn("chunk_no", F.explode(F.sequence(tile_of(F.col("_first"), n, tiles), tile_of(last, n, tiles))))
    q, r = divmod(n, tiles)
    begin = F.least(F.col("chunk_no") - 1, F.lit(r)) + (F.col("chunk_no") - 1) * F.lit(q)
    end = F.least(F.col("chunk_no"), F.lit(r)) + F.col("chunk_no") * F.lit(q)
    held = F.least(end, last + 1) - F.greatest(begin, F.col("_first"))
    return spread.groupBy("chunk_no").agg(F.min("_key").alias("min_key"), F.max("_key").alias("max_key"), F.sum(held).alias("row_count"))


def bucket_plan(df: DataFrame, key: str, tiles: int) -> DataFrame:
    """Like chunk_plan, but rows with equal keys stay together: a key goes where its first row would."""
    return counted_bucket_plan(key_counts(df, key), tiles)


def counted_bucket_plan(counted: DataFrame, tiles: int) -> DataFrame:
    """bucket_plan of keys that have been counted already, such as by the store that holds the rows: _key, _rows."""
    ranks, n = _first_ranks(counted)
    if not n:
        return _no_chunks(counted)
    tiled = ranks.withColumn("_tile", tile_of(F.col("_first"), n, tiles))
    plan = tiled.groupBy("_tile").agg(F.min("_key").alias("min_key"), F.max("_key").alias("max_key"), F.sum("_rows").alias("row_count"))
    return plan.withColumn("chunk_no", F.row_number().over(Window.orderBy("_tile"))).select("chunk_no", "min_key", "max_key", "row_count")  # a row a tile


def chunk_scope_bounds(df: DataFrame, key: str, scope: str, tiles: int) -> DataFrame:
    """Bounds of a second column for every chunk, in one pass."""
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{scope}`").alias("_scope"))
    return chunk_assign(rows, "_key", tiles).groupBy("chunk_no").agg(F.min("_scope").alias("min_scope"), F.max("_scope").alias("max_scope"))


def chunk_filter(df: DataFrame, key: str, low, high) -> DataFrame:
    """Rows in a closed key range; NULL keys are in none."""
    return df.filter(F.col(key).between(F.lit(low), F.lit(high)))


def lag(high: Column, low: Column, committed: Column) -> Column:
    """Messages after the committed offset (a negative one: after the lowest); never negative."""
    return F.greatest(high - F.when(committed >= 0, committed).otherwise(low), F.lit(0))


def partition_plan(offsets: DataFrame) -> DataFrame:
    """chunk_no, topic, partition_id, row_count: topic partitions with messages left to read."""
    left = offsets.withColumn("row_count", lag(F.col("high_offset"), F.col("low_offset"), F.col("committed_offset"))).filter("row_count > 0")
    return left.select(F.row_number().over(Window.partitionBy("topic").orderBy("partition_id")).alias("chunk_no"), "topic", "partition_id", "committed_offset", "row_count")
