"""Keys: NULL-safe matching, key sets, duplicates, unique-key conflicts and identifier checks."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the pattern of a name or schema.name of word characters, or the same in brackets with white space.
IDENTIFIER = r"^[\w]+(?:\.[\w]+)?$|^\[[\w\s]+\](?:\.\[[\w\s]+\])?$"


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True) -> Column:
    """Join condition on all keys; NULL equals NULL if null_safe. Spark plans either as an equi-join."""
    pairs = [left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in keys]
    return reduce(Column.__and__, pairs)


def key_set(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.select(*keys).distinct()


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row holds, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def ensure_unique(df: DataFrame, keys: Sequence[str]) -> None:
    found = key_duplicates(df, keys).head(3)
    if found:
        raise ValueError(f"duplicate source keys on {list(keys)}, e.g. {[r.asDict() for r in found]}; pass on_duplicate='latest' and an order")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the greatest by `order` (NULL lowest), ties by all columns. Aggregated with map-side combining, not sorted."""
    rest = [c for c in df.columns if c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(best).select(*[F.col(f"_best.{c}").alias(c) for c in df.columns])


def broadcast_checked(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df marked for a broadcast if it has at most so many rows (it is counted), else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def top_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], most: int, parts: int = 16) -> DataFrame:
    """The first `most` rows of each group. A group is cut into parts by a hash first, so a hot one isn't sorted in one task."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(parts))
    for groups in ([*by, "_part"], list(by)):
        window = Window.partitionBy(*groups).orderBy(*order)
        df = (df.withColumn("_part", salt) if "_part" in groups else df).withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= most).drop("_n", *({"_part"} - set(groups)))
    return df


def unique_conflicts(target: DataFrame, source: DataFrame, keys: Sequence[str], unique_keys: Sequence[Sequence[str]], nulls_conflict: bool = True) -> DataFrame:
    """Target rows equal to a source row on a unique key but with another primary key.

    A unique key with a column that the source lacks is skipped. NULLs of a unique key conflict with each other, unless
    nulls_conflict is False. One semi-join for each unique key: its columns are hashed and the key's difference stays in the condition.
    """
    found = None
    for columns in unique_keys:
        if not set(columns) <= set(source.columns):
            continue
        s = source.select(*{*columns, *keys})
        condition = same_keys(target, s, columns, nulls_conflict) & ~same_keys(target, s, keys)
        part = target.join(s, condition, "left_semi")
        found = part if found is None else found.unionByName(part)
    return target.limit(0) if found is None else found.dropDuplicates(list(keys)) if len(unique_keys) > 1 else found


def bad_names(names: Sequence[str]) -> list[str]:
    return [n for n in names if not re.match(IDENTIFIER, n)]


def ensure_names(df: DataFrame) -> None:
    if bad := bad_names(df.columns):
        raise ValueError(f"not identifiers: {bad}")


def bad_field_names(df: DataFrame, json_col: str) -> DataFrame:
    """Field names of a JSON object column that are not identifiers, with the number of rows."""
    names = df.select(F.explode(F.json_object_keys(F.col(json_col))).alias("name"))
    return names.filter(~F.col("name").rlike(IDENTIFIER)).groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
