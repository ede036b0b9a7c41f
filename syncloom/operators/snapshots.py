"""Work on tables of files behind a snapshot pointer: syncs that touch only what differs, and compaction that is planned, checked and then pointed to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.spec import SyncSpec
from ..sources import sinks
from . import apply, versions
from .digests import BUCKET, bucket_digests, in_buckets, unlike_buckets
from .keys import broadcast_checked


def sync_digested(source: DataFrame, path: str, spec: SyncSpec, buckets: int) -> dict[str, int]:
    """Sync a source into a digested snapshot (`sinks.write_digested`): rows by action.

    The source is read for its digests; of the table, one digest a bucket and the rows of the buckets that are unlike. Only those are joined and written again; the folders
    of the others stay. The counts come from the writing job itself. The numbers of unlike buckets are on the driver: at most `buckets`.
    """
    if spec.unique_keys:
        raise ValueError("unique keys can't be checked by buckets of the primary key")
    spark = source.sparkSession
    source = apply.prepared(source, spec)
    before, empty = sinks.read_digests(spark, path), sinks.read_digested(spark, path, [])
    own = [c for c in empty.columns if c in source.columns and c not in spec.keys]
    unlike = unlike_buckets(bucket_digests(source, spec.keys, own, buckets), before)
    chosen = {r[BUCKET]: r["rows"] for r in unlike.collect()}
    like = before.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"] - sum(chosen.values())
    if not chosen:
        return dict.fromkeys(apply.ACTIONS, 0) | {"unchanged": like}
    picked = spark.createDataFrame([(b,) for b in chosen], f"{BUCKET} int")
    target = sinks.read_digested(spark, path, list(chosen))
    bounds = apply.scope_bounds(source, spec.scope) if spec.scope else None
    seen = Observation()
    changes = apply.sync_changes(in_buckets(source, spec.keys, buckets, picked), target, spec.replace(on_duplicate="allow"), bounds)
    changes = changes.observe(seen, *[F.count(F.when(F.col("action") == a, 1)).alias(a) for a in apply.ACTIONS])
    sinks.write_digested(apply.snapshot(changes), path, spec.keys, buckets, list(chosen))
    return {a: seen.get[a] for a in apply.ACTIONS} | {"unchanged": seen.get["unchanged"] + like}


def packed(parts: DataFrame, target_bytes: int | None) -> DataFrame:
    """parts (partition_key, part_name, part_bytes) with bin: which file of the compacted partition a part's rows go to.

    Parts are laid end to end, largest first, and cut every target_bytes, so that a partition of B bytes gets ceil(B / target_bytes) bins; a part belongs to the bin in which it begins.
    One window a partition, over a row for each file. None: nothing is cut, so that a partition is one bin.
    """
    if target_bytes is None:
        return parts.withColumn("bin", F.lit(0))
    before = Window.partitionBy("partition_key").orderBy(F.desc("part_bytes"), "part_name").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("bin", F.floor(F.coalesce(F.sum("part_bytes").over(before), F.lit(0)) / target_bytes).cast("int"))


def compaction_plan(parts: DataFrame, threshold: int, target_bytes: int | None) -> DataFrame:
    """For each partition: partition_key, parts, stored_bytes, decision, and files, what a compaction would leave."""
    bins = packed(parts, target_bytes).groupBy("partition_key").agg(F.count(F.lit(1)).alias("parts"), F.sum("part_bytes").alias("stored_bytes"), (F.max("bin") + 1).alias("files"))
    due = (F.col("parts") >= threshold) & (F.col("files") < F.col("parts"))
    return bins.select("partition_key", "parts", "stored_bytes", F.when(due, "compact").otherwise("skip").alias("decision"), F.when(due, F.col("files")).otherwise(F.col("parts")).cast("int").alias("files"))


def _folder(path: Column, column: str) -> Column:
    """The partition folder of a file, as it is named; Spark tells paths as URIs."""
    return F.url_decode(F.replace(F.regexp_extract(path, f"/({column}=[^/]*)/[^/]*$", 1), F.lit("+"), F.lit("%2B")))


def folder_parts(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A row for each file of a table that `sinks.replace_folders` writes: partition_key (its folder), part_name, part_bytes, part_rows, modified. Only footers are read."""
    m = sinks.read_snapshot(spark, path, file="_file").select("_file.*")
    each = m.groupBy(F.col("file_path").alias("part_name"), F.col("file_size").alias("part_bytes"), F.col("file_modification_time").alias("modified")).agg(F.count(F.lit(1)).alias("part_rows"))
    return each.withColumn("partition_key", _folder(F.col("part_name"), column))


def compact_due(spark: SparkSession, path: str, column: str, threshold: int = 100, target_bytes: int | None = 128 << 20, keys: Sequence[str] | None = None, version: Sequence[str] = ("version_id",)) -> DataFrame:
    """Compact the partitions of a table on files that have `threshold` parts and more: partition_key, decision, parts_before, parts_after, rows_before, rows_after.

    target_bytes: the size of file aimed at. None: one file a partition, whatever its size, as a final merge leaves it; a file is written by one task, so that task then sorts and
    writes the whole partition.

    The due partitions are read together, rid of repeated rows (or of old versions by keys), dealt into the planned number of files each, and written beside the table. Before
    the pointer moves, the rows written are counted against those that the job has sent, and no partition may have more rows than before; otherwise nothing has
    happened. Partitions that aren't due keep their files. A plan row for each partition is on the driver.
    """
    parts = folder_parts(spark, path, column).persist()
    try:
        plan = {r["partition_key"]: r for r in compaction_plan(parts, threshold, target_bytes).collect()}
        rows = {r["partition_key"]: r["n"] for r in parts.groupBy("partition_key").agg(F.sum("part_rows").alias("n")).collect()}
    finally:
        parts.unpersist()
    due = [k for k, r in plan.items() if r["decision"] == "compact"]
    if due:
        df = sinks.read_snapshot(spark, path, due, file="_file")
        columns = [c for c in df.columns if c != "_file"]
        df = df.select(*columns, _folder(F.col("_file.file_path"), column).alias("_folder"))
        done = versions.latest_version(df, [*keys, "_folder"], version) if keys else df.distinct()
        files = spark.createDataFrame([(k, plan[k]["files"]) for k in due], "_folder string, _files int")
        numbered = done.join(broadcast_checked(files), "_folder").withColumn("_file", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.col("_files")))
        seen = Observation()
        tasks = 2 * sum(plan[k]["files"] for k in due)  # a number of its own, so that small ones aren't put together; few files share a task, and then are one
        spread = numbered.repartition(tasks, "_folder", "_file").select(*columns)  # the writer itself sorts a task's rows by the partition column
        sinks.replace_folders(spread.observe(seen, F.count(F.lit(1)).alias("rows")), path, column, due, before_pointer=lambda v, f: _all_there(spark, path, column, v, seen, rows))
    after = folder_parts(spark, path, column).groupBy("partition_key").agg(F.count(F.lit(1)).alias("parts_after"), F.sum("part_rows").alias("rows_after"))
    told = spark.createDataFrame([(k, r["decision"], r["parts"], rows[k]) for k, r in plan.items()], "partition_key string, decision string, parts_before bigint, rows_before bigint")
    return told.join(after, "partition_key", "left").select("partition_key", "decision", "parts_before", "parts_after", "rows_before", "rows_after")


def _all_there(spark: SparkSession, path: str, column: str, version: str, seen: Observation, before: dict[str, int]) -> None:
    """Whether the files written hold the rows that were sent, and no partition more than before; an error if not."""
    found = spark.read.parquet(f"{path}/{version}").groupBy(_folder(F.col("_metadata.file_path"), column).alias("folder")).count().collect()
    if sum(r["count"] for r in found) != seen.get["rows"]:
        raise RuntimeError(f"compaction of {path}: {seen.get['rows']} rows were sent, {sum(r['count'] for r in found)} are there")
    if more := [r["folder"] for r in found if r["count"] > before[r["folder"]]]:
        raise RuntimeError(f"compaction of {path}: more rows than before in {more}")
