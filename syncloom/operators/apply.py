"""Applying a source to a target: inserts, updates, deletes, upserts, scoped deletion and full synchronisation.

A table is a DataFrame; the result of an operator is the table's new snapshot (or its change set). No operator loops over batches: the
whole source is evaluated at once, so the outcome doesn't depend on batch order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.spec import SyncSpec
from .changes import change_set, row_hash
from .keys import broadcast_checked, ensure_unique, key_set, latest_per_key, same_keys, unique_conflicts

ACTIONS = ("insert", "update", "unchanged", "delete", "outside", "conflict_delete")


def insert_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def update_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str = "error", order: Sequence[str] = ()) -> DataFrame:
    """Target with the source's values in matched rows; plain equality, so NULL keys match nothing; nothing is inserted.

    Repeated source keys end the run at once (the source is counted before), or with on_duplicate="latest" the greatest by `order` counts.
    """
    source = one_per_key(source, keys, on_duplicate, order)
    columns = [c for c in target.columns if c in source.columns and c not in keys]
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys], *[F.col(c).alias(f"_s_{c}") for c in columns], F.lit(True).alias("_hit"))
    condition = None
    for k in keys:
        one = F.col(k) == F.col(f"_s_{k}")
        condition = one if condition is None else condition & one
    joined = target.join(s, condition, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def delete_rows(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Target without the rows whose key is listed."""
    return target.join(keys.distinct(), list(keys.columns), "left_anti").select(*target.columns)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True, on_duplicate: str = "error", order: Sequence[str] = ()) -> DataFrame:
    """Target plus the source rows whose key it lacks; existing rows stay as they are. Repeated source keys as in `update_rows`."""
    source = one_per_key(source, keys, on_duplicate, order)
    return insert_rows(target, missing_in_target(source, target, keys, null_safe))


def missing_in_target(source: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    return source.join(target.select(*keys), same_keys(source, target, keys, null_safe), "left_anti")


def scope_bounds(source: DataFrame, column: str) -> DataFrame:
    """One row (low, high); both NULL for an empty source."""
    return source.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def missing_in_source(target: DataFrame, source: DataFrame, keys: Sequence[str], scope: str) -> DataFrame:
    """Target rows within the bounds of the source's scope column whose key the source lacks; none for an empty source."""
    bounds = scope_bounds(source, scope)
    inside = target.join(F.broadcast(bounds), target[scope].between(bounds["low"], bounds["high"]), "left_semi")  # one row
    present = key_set(source, keys).select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    condition = None
    for i, k in enumerate(keys):
        one = target[k].eqNullSafe(present[f"_{i}"])
        condition = one if condition is None else condition & one
    return inside.join(present, condition, "left_anti")


def one_per_key(source: DataFrame, keys: Sequence[str], on_duplicate: str, order: Sequence[str] = ()) -> DataFrame:
    """The source with one row for each key: checked by an aggregation of its own ("error"), reduced to the latest, or as it is ("allow")."""
    if on_duplicate == "latest":
        return latest_per_key(source, keys, order)
    if on_duplicate == "error":
        ensure_unique(source, keys)
    return source


def prepared(source: DataFrame, spec: SyncSpec) -> DataFrame:
    return one_per_key(source, spec.keys, spec.on_duplicate, spec.order)


def sync_changes(source: DataFrame, target: DataFrame, spec: SyncSpec, bounds: DataFrame | None = None) -> DataFrame:
    """Change set with the final actions of a run: ACTIONS. bounds: those of the scope, if the source is only a part.

    Rows only in the target are deleted within the bounds of the scope column, else outside. Target rows in conflict on a unique key count as
    conflict_delete; they are taken out before the join, so that the source row may come in their place.
    """
    source = prepared(source, spec)
    conflicts = None
    if spec.unique_keys:
        conflicts = unique_conflicts(target, source, spec.keys, spec.unique_keys, spec.nulls_conflict)
        target = target.join(conflicts.select(*spec.keys), same_keys(target, conflicts, spec.keys), "left_anti")
    changes = change_set(source, target, spec.keys, spec.compare, spec.null_safe)
    if spec.insert_only:
        changes = changes.withColumn("action", F.when(F.col("action") == "update", "unchanged").otherwise(F.col("action")))
    if spec.scope:
        changes = changes.join(F.broadcast(scope_bounds(source, spec.scope) if bounds is None else bounds))  # one row
        inside = F.col(f"t.{spec.scope}").between(F.col("low"), F.col("high"))
        changes = changes.withColumn("action", F.when(F.col("action") != "target_only", F.col("action")).when(inside, "delete").otherwise("outside")).drop("low", "high")
    else:
        changes = changes.withColumn("action", F.when(F.col("action") == "target_only", "outside").otherwise(F.col("action")))
    if conflicts is not None:
        gone = conflicts.select(F.lit(None).cast(changes.schema["s"].dataType).alias("s"), F.struct(*target.columns).alias("t"), F.lit("conflict_delete").alias("action"))
        changes = changes.unionByName(gone)
    return changes


def snapshot(changes: DataFrame) -> DataFrame:
    """The table after the actions: source values for inserts and updates (columns the source lacks stay), deletes left out."""
    source, target = changes.schema["s"].dataType.names, changes.schema["t"].dataType.names
    fresh = F.col("action").isin("insert", "update")
    value: list[Column] = [F.when(fresh, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in source else F.col(f"t.{c}").alias(c) for c in target]
    return changes.filter(~F.col("action").isin("delete", "conflict_delete")).select(*value)


def summary(changes: DataFrame) -> DataFrame:
    """Rows by action, in one row."""
    return changes.agg(*[F.count(F.when(F.col("action") == a, 1)).alias(a) for a in ACTIONS])


def written_sync(source: DataFrame, target: DataFrame, spec: SyncSpec, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write the new snapshot and count its rows by action in that same job, by an observation; nothing is read or joined a second time."""
    seen = Observation()
    changes = sync_changes(source, target, spec).observe(seen, *[F.count(F.when(F.col("action") == a, 1)).alias(a) for a in ACTIONS])
    write(snapshot(changes))
    return {a: seen.get[a] for a in ACTIONS}


def full_sync(source: DataFrame, target: DataFrame, spec: SyncSpec) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, summary) of an upsert with scoped deletion; both are lazy over one change set, which callers that use both may persist."""
    changes = sync_changes(source, target, spec)
    return snapshot(changes), summary(changes)


def store_changes(source: DataFrame, target: DataFrame, spec: SyncSpec, store: str = "store") -> DataFrame:
    """Fan-out over stores in one job: change set with final actions and the store, which is part of the key and of every unique key.

    The scope is taken by store, so that one store's bounds don't delete in another, and a conflict in one store deletes in no other. There is one
    row of bounds for each store; they are broadcast if their count allows.
    """
    keys = [store, *[k for k in spec.keys if k != store]]
    source = prepared(source, spec.replace(keys=keys))
    conflicts = None
    if spec.unique_keys:
        unique = [[store, *[c for c in u if c != store]] for u in spec.unique_keys]
        conflicts = unique_conflicts(target, source, keys, unique, spec.nulls_conflict)
        target = target.join(conflicts.select(*keys), same_keys(target, conflicts, keys), "left_anti")
    changes = change_set(source, target, keys, spec.compare, spec.null_safe)
    changes = changes.withColumn(store, F.coalesce(f"s.{store}", f"t.{store}"))
    if spec.insert_only:
        changes = changes.withColumn("action", F.when(F.col("action") == "update", "unchanged").otherwise(F.col("action")))
    inside = F.lit(False)
    if spec.scope:
        bounds = source.groupBy(F.col(store).alias("_store")).agg(F.min(spec.scope).alias("low"), F.max(spec.scope).alias("high"))
        changes = changes.join(broadcast_checked(bounds), F.col(store).eqNullSafe(F.col("_store")), "left").drop("_store")
        inside = F.coalesce(F.col(f"t.{spec.scope}").between(F.col("low"), F.col("high")), F.lit(False))
    changes = changes.withColumn("action", F.when(F.col("action") != "target_only", F.col("action")).when(inside, "delete").otherwise("outside")).drop("low", "high")
    if conflicts is not None:
        gone = conflicts.select(F.lit(None).cast(changes.schema["s"].dataType).alias("s"), F.struct(*target.columns).alias("t"), F.lit("conflict_delete").alias("action"), F.col(store))
        changes = changes.unionByName(gone)
    return changes


def store_summary(source: DataFrame, target: DataFrame, spec: SyncSpec, store: str = "store") -> DataFrame:
    """Rows by action for each store."""
    changes = store_changes(source, target, spec, store)
    return changes.groupBy(store).agg(*[F.count(F.when(F.col("action") == a, 1)).alias(a) for a in ("insert", "update", "unchanged", "delete")])


def store_snapshots(source: DataFrame, target: DataFrame, spec: SyncSpec, store: str = "store") -> DataFrame:
    """The tables of all stores after a fan-out, in one DataFrame; write it with `sinks.write_snapshot(..., partition_by=(store,))`, a slice for each store."""
    return snapshot(store_changes(source, target, spec, store))


def document_changes(source: DataFrame, target: DataFrame, key: str = "_id", on_duplicate: str = "error", order: Sequence[str] = ()) -> DataFrame:
    """Change set of documents by content hash: equal documents are unchanged, others are replaced whole. Repeated source keys as in `update_rows`."""
    from ..functions.documents import content_hash

    source = one_per_key(source, [key], on_duplicate, order)
    columns = sorted({*source.columns, *target.columns} - {key})
    hashed = lambda df: df.select(key, *[F.col(c) if c in df.columns else F.lit(None).cast((source if c in source.columns else target).schema[c].dataType).alias(c) for c in columns]).withColumn("content_hash", content_hash(columns))
    s, t = hashed(source), hashed(target)
    joined = s.select(F.struct(*s.columns).alias("s")).join(t.select(F.struct(*t.columns).alias("t")), F.col(f"s.{key}").eqNullSafe(F.col(f"t.{key}")), "full_outer")
    action = F.when(F.col("t").isNull(), "insert").when(F.col("s").isNull(), "outside").when(F.col("s.content_hash") != F.col("t.content_hash"), "update").otherwise("unchanged")
    return joined.withColumn("action", action)


__all__ = ["row_hash", "insert_rows", "update_rows", "delete_rows", "insert_only", "missing_in_target", "missing_in_source", "sync_changes", "snapshot", "summary", "full_sync", "written_sync", "store_changes", "store_summary", "store_snapshots", "document_changes"]
