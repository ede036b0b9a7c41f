"""Topics into keyed tables with Structured Streaming: parse, keep the latest message of each key, append, then commit.

A table is a base snapshot and the batches since: a batch writes only its own rows, and every COMPACT_BATCHES of them are merged into a new
base, so a batch's cost doesn't hang on the table's size but for that share. Readers merge the base and the batches at once. The
checkpoint takes the place of committed offsets: it moves on only after the batch has been written, so delivery is at least once, and since a
batch has its own folder and the merge is idempotent a replay changes nothing. With a guard column, a replayed older message doesn't overwrite newer
data; a NULL guard is the oldest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.messages import message_rows, quarantined, selected
from ..operators.apply import full_sync, snapshot
from ..operators.changes import change_set
from ..operators.keys import latest_per_key
from ..plans.spec import SyncSpec, TopicSpec
from ..sources.sinks import complete_folders, drop_folder, read_snapshot, write_snapshot
from ..sources.topics import Bounds, run_bounds, within

#: Folder of the batches beside the base, and how many of them there may be.
BATCHES, COMPACT_BATCHES = "_batches", 16

#: Columns that order messages: a keyed topic keeps a key in one partition, so the offset alone would do; the others break ties across partitions.
ORDER = ("msg_offset", "msg_ts", "partition_id")


#: Folder in a stream's checkpoint that tells up to which offsets an unfinished batch has been read; parts that a batch may come to.
PARTIAL, MOST_PARTS = "_partial", 1 << 20


class _Enough(Exception):
    """A run has read as many messages as it may; its last batch isn't committed."""


def batch_rows(messages: DataFrame, spec: TopicSpec) -> DataFrame:
    """Rows of a batch of messages, one for each key: that with the greatest guard, of equal ones (or without a guard) the latest."""
    rows = message_rows(messages, spec.schema, "msg_value", spec.mode, keep=ORDER)
    latest = latest_per_key(rows, spec.keys, [spec.guard, *ORDER] if spec.guard else ORDER)
    return selected(latest.drop(*ORDER), spec.excluded, spec.included)


def merged(target: DataFrame, rows: DataFrame, spec: TopicSpec) -> DataFrame:
    """Target after an upsert of rows; with a guard, a row whose guard is below the target's is skipped."""
    changes = change_set(rows, target, spec.keys, null_safe=not spec.buckets)
    if spec.guard:
        if spec.guard not in target.columns:
            raise ValueError(f"the table lacks the guard column {spec.guard!r}")
        s, t = F.col(f"s.{spec.guard}"), F.col(f"t.{spec.guard}")
        stale = (F.col("action") == "update") & F.coalesce(s < t, s.isNull() & t.isNotNull())
        changes = changes.withColumn("action", F.when(stale, "unchanged").otherwise(F.col("action")))
    return snapshot(changes)


def _batches(spark: SparkSession, path: str) -> list[str]:
    return complete_folders(spark, f"{path}/{BATCHES}")


def read_table(spark: SparkSession, path: str, spec: TopicSpec) -> DataFrame:
    """The table as it is now: the base with the batches since."""
    base, names = read_snapshot(spark, path), _batches(spark, path)
    if not names:
        return base
    rows = spark.read.parquet(*[f"{path}/{BATCHES}/{n}" for n in names])
    order = [spec.guard, "_batch"] if spec.guard else ["_batch"]
    return merged(base, latest_per_key(rows, spec.keys, order).drop("_batch"), spec)


def compact(spark: SparkSession, path: str, spec: TopicSpec) -> int:
    """Merge the batches into a new base and remove them; how many there were. A failure between leaves both, and the same table."""
    names = _batches(spark, path)
    if names:
        write_snapshot(read_table(spark, path, spec), path, bucket_by=(spec.keys, spec.buckets) if spec.buckets else None)
        for n in names:
            drop_folder(spark, f"{path}/{BATCHES}/{n}")
    return len(names)


def merge_into(path: str, spec: TopicSpec, quarantine: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that adds a batch (or a part of one) to the table at `path`; bad messages go to a folder of the batch in `quarantine` in that mode."""

    def apply(batch: DataFrame, batch_id: int, part: int = 0) -> None:
        spark = batch.sparkSession
        if spec.mode == "quarantine" and quarantine:
            quarantined(batch, spec.schema, "msg_value").write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}" + f"-{part}" * bool(part))
        rows = batch_rows(batch, spec).withColumn("_batch", F.lit(batch_id * MOST_PARTS + part).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{path}/{BATCHES}/{batch_id:012d}-{part:07d}")
        if len(_batches(spark, path)) >= COMPACT_BATCHES:
            compact(spark, path, spec)

    return apply


def _read_up_to(spark: SparkSession, batch_id: int, partial: str) -> tuple[list[Bounds], int]:
    """(up to where earlier runs have read the batch in each topic partition, number of the parts that they have read it in)."""
    if not complete_folders(spark, f"{partial}/_pointers"):
        return [], 0
    rows = read_snapshot(spark, partial).filter(F.col("batch_id") == batch_id).collect()
    return [Bounds(r["topic"], r["partition_id"], 0, r["end"], 0) for r in rows], max((r["part"] + 1 for r in rows), default=0)


def stream_upsert(messages: DataFrame, path: str, checkpoint: str, spec: TopicSpec, quarantine: str | None = None, merge_after: bool = True) -> int:
    """Read all that is there, in batches, into the table at `path`, then stop. The number of batches with messages.

    With merge_after the run's batches are merged into a new base at its end, once; else `read_table` has them. With spec.max_messages a run reads exactly so many
    messages (or all, if there are fewer), evenly from all topic partitions. A batch that it can't read whole stays uncommitted: what has been read of it stands beside the
    stream's checkpoint, and the next run, which has the same batch again, goes on behind that. Batches of an earlier run are merged first, since a new
    checkpoint would number its own from 0 again.
    """
    compact(messages.sparkSession, path, spec)
    add, partial = merge_into(path, spec, quarantine), f"{checkpoint}/{PARTIAL}"
    read = {"batches": 0, "messages": 0, "enough": 0}

    def whole(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        n = batch.count()
        if n:
            add(batch, batch_id)
        batch.unpersist()
        read["batches"] += bool(n)

    def some(batch: DataFrame, batch_id: int) -> None:
        left = spec.max_messages - read["messages"]
        done, part = _read_up_to(batch.sparkSession, batch_id, partial)
        todo = (within(batch, done, "left_anti") if done else batch).persist()
        bounds = run_bounds(todo)
        total = sum(b.take for b in bounds)
        if total > left > 0:
            bounds = run_bounds(todo, left)
        n = min(total, left)
        if n:
            add(within(todo, bounds), batch_id, part)
        todo.unpersist()
        read["batches"] += bool(n)
        read["messages"] += n
        if n < total:
            if n:
                ends = {(b.topic, b.partition_id): b.end for b in [*done, *bounds]}
                rows = [(batch_id, part, *at, end) for at, end in ends.items()]
                write_snapshot(batch.sparkSession.createDataFrame(rows, "batch_id bigint, part int, topic string, partition_id int, end bigint"), partial)
            read["enough"] = 1
            raise _Enough

    run = messages.writeStream.foreachBatch(whole if spec.max_messages is None else some).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        run.awaitTermination()
    except StreamingQueryException as e:
        if not (read["enough"] and _Enough.__name__ in str(e)):
            raise
    if merge_after:
        compact(messages.sparkSession, path, spec)
    return read["batches"]


def topic_snapshot_sync(messages: DataFrame, target: DataFrame, spec: TopicSpec, scope: str) -> tuple[DataFrame, DataFrame]:
    """(snapshot, summary) of a bounded read that holds a full snapshot: upsert, then deletion of what it lacks within the bounds of its scope column."""
    return full_sync(batch_rows(messages, spec), target, SyncSpec(spec.keys, scope=scope, on_duplicate="allow"))


__all__ = ["batch_rows", "merged", "merge_into", "read_table", "compact", "stream_upsert", "topic_snapshot_sync"]
