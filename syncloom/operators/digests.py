"""Change detection by bucket digests: a key belongs to a bucket, a bucket has one digest of its rows in any order, and only buckets whose digests differ are compared row by row.

Digests are 64-bit hashes added up in two ways beside the number of rows: buckets that differ have equal digests with a chance of about 2^-64 for each bucket. NULLs
count by their column, so (NULL, a) and (a, NULL) differ; types count too, so equal values of two types make buckets unlike, which costs work but no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.spec import SyncSpec
from .keys import broadcast_checked

BUCKET = "_bucket"
_LOW = (1 << 31) - 1


def _hashed(df: DataFrame, columns: Sequence[str]) -> Column:
    """64-bit hash of columns, NULLs and their places included."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def plain_one(c: str) -> Column:
        if isinstance(kinds[c], T.MapType):
            return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.col(f"`{c}`")))))
        return F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kinds[c].simpleString() else F.col(f"`{c}`")  # a map deeper down can't be hashed as it is

    plain = [plain_one(c) for c in columns]
    return F.xxhash64(*[x for c in plain for x in (c, c.isNull())]) if plain else F.lit(0).cast("bigint")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a key, by its text, so that the types of two sides don't matter."""
    texts = [x for k in keys for x in (F.col(f"`{k}`").cast("string"), F.col(f"`{k}`").isNull())]
    return F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, bucket_of(keys, buckets))


def bucket_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """_bucket, rows, digest_xor, digest_sum. One pass, combined before the shuffle: a row a bucket leaves each task."""
    h = df.select(bucket_of(keys, buckets).alias(BUCKET), _hashed(df, [*keys, *columns]).alias("h"))
    return h.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("digest_xor"), F.sum(F.col("h").bitwiseAND(F.lit(_LOW))).alias("digest_sum"))


def unlike_buckets(source: DataFrame, target: DataFrame) -> DataFrame:
    """_bucket, and rows of the target in it, of buckets whose digests differ or that only one side has."""
    s = source.select(F.col(BUCKET).alias("_s"), F.struct("rows", "digest_xor", "digest_sum").alias("_sd"))
    t = target.select(F.col(BUCKET).alias("_t"), F.struct("rows", "digest_xor", "digest_sum").alias("_td"))
    both = s.join(t, F.col("_s") == F.col("_t"), "full_outer").filter(~F.col("_sd").eqNullSafe(F.col("_td")))
    return both.select(F.coalesce("_s", "_t").alias(BUCKET), F.coalesce("_td.rows", F.lit(0)).alias("rows"))


def in_buckets(df: DataFrame, keys: Sequence[str], buckets: int, chosen: DataFrame) -> DataFrame:
    """Rows of df whose bucket is among the chosen ones (at most `buckets` rows, so they are broadcast up to a checked number)."""
    wanted = broadcast_checked(chosen.select(F.col(BUCKET).alias("_wanted")))
    return df.join(wanted, bucket_of(keys, buckets) == F.col("_wanted"), "left_semi")


def digest_changes(source: DataFrame, target: DataFrame, spec: SyncSpec, buckets: int, digests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(change set of the unlike buckets, summary of the whole run). Rows of like buckets are unchanged; they are neither joined nor, with stored digests, read.

    digests: those stored with the target (`sinks.read_digests`). Bounds of the scope are the whole source's. Unique keys aren't supported, since a conflict
    may lie in a bucket that is like.
    """
    from .apply import prepared, scope_bounds, summary, sync_changes

    if spec.unique_keys:
        raise ValueError("unique keys can't be checked by buckets of the primary key")
    source = prepared(source, spec)
    own = [c for c in target.columns if c in source.columns and c not in spec.keys]
    before = bucket_digests(target, spec.keys, own, buckets) if digests is None else digests
    after = bucket_digests(source, spec.keys, own, buckets)
    unlike = unlike_buckets(after, before)
    s, t = in_buckets(source, spec.keys, buckets, unlike), in_buckets(target, spec.keys, buckets, unlike)
    bounds = scope_bounds(source, spec.scope) if spec.scope else None
    changes = sync_changes(s, t, spec.replace(on_duplicate="allow"), bounds)
    like = before.join(broadcast_checked(unlike.select(F.col(BUCKET).alias("_unlike"))), F.col(BUCKET) == F.col("_unlike"), "left_anti")
    same = like.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("like_rows"))
    total = summary(changes).crossJoin(F.broadcast(same))  # one row each
    return changes, total.withColumn("unchanged", F.col("unchanged") + F.col("like_rows")).drop("like_rows")
