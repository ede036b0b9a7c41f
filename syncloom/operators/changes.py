"""Change detection: row hashes, column-wise differences and the change set of a source against a target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands between the column texts of a row hash; NULL is written as the text NULL.
SEPARATOR, NULL_TEXT = "\x1f", "NULL"


def row_hash(columns: Sequence[Column], algorithm: str = "sha256") -> Column:
    """Hash over the texts of any number of columns. NULL and the text 'NULL' hash alike; compare by columns where that matters."""
    text = F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(NULL_TEXT)) for c in columns])
    return F.md5(text) if algorithm == "md5" else F.sha2(text, 256)


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Whether any pair differs; NULL equals NULL only."""
    return reduce(Column.__or__, [~a.eqNullSafe(b) for a, b in pairs], F.lit(False))


def changed_columns(pairs: dict[str, tuple[Column, Column]]) -> Column:
    """Array of the names whose values differ."""
    return F.array_compact(F.array(*[F.when(~a.eqNullSafe(b), F.lit(name)) for name, (a, b) in pairs.items()]))


def change_set(source: DataFrame, target: DataFrame, keys: Sequence[str], compare: str | None = None, null_safe: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """One row for each source and target row: structs s and t, and action insert, update, unchanged or target_only.

    compare: "sha256" or "md5" for row hashes, None for column-wise differences. The one shuffle is the full outer join on the keys;
    a target that is bucketed by them isn't shuffled, if the comparison of keys isn't NULL-safe.
    """
    s = source.select(F.struct(*source.columns).alias("s"), *[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)])
    t = target.select(F.struct(*target.columns).alias("t"), *[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)])
    pairs = [F.col(f"_s{i}").eqNullSafe(F.col(f"_t{i}")) if null_safe else F.col(f"_s{i}") == F.col(f"_t{i}") for i in range(len(keys))]
    joined = s.join(t, reduce(Column.__and__, pairs), "full_outer").select("s", "t")
    shared = [c for c in (columns or target.columns) if c in source.columns and c not in keys]
    own, other = [F.col(f"s.{c}") for c in shared], [F.col(f"t.{c}") for c in shared]
    changed = differs(list(zip(own, other, strict=True))) if compare is None else row_hash(own, compare) != row_hash(other, compare)
    action = F.when(F.col("t").isNull(), "insert").when(F.col("s").isNull(), "target_only").when(changed, "update").otherwise("unchanged")
    return joined.withColumn("action", action)
