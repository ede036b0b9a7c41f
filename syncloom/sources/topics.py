"""Topics as message tables: topic, partition_id, msg_offset, msg_ts, key, value. A broker and a folder of message files give the same columns."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import latest_per_key, top_rows

MESSAGE_SCHEMA = "topic string, partition_id int, msg_offset bigint, msg_ts timestamp_ntz, msg_key string, msg_value string"


def from_broker(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", ending: str | None = None, assign: Mapping[str, Sequence[int]] | None = None, stream: bool = False, max_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Messages of a Kafka topic (needs the connector on the class path). assign: topic -> partitions, in place of the whole topic. ending: offsets of a bounded read (see `broker_offsets`)."""
    reader = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).option("startingOffsets", starting).options(**options)
    reader = reader.option("assign", json.dumps({k: list(v) for k, v in assign.items()})) if assign else reader.option("subscribe", topic)
    if stream and max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    if ending and not stream:
        reader = reader.option("endingOffsets", ending)
    return reader.load().select("topic", F.col("partition").alias("partition_id"), F.col("offset").alias("msg_offset"), F.col("timestamp").cast("timestamp_ntz").alias("msg_ts"), F.col("key").cast("string").alias("msg_key"), F.col("value").cast("string").alias("msg_value"))


def from_files(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).schema(MESSAGE_SCHEMA)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def by_partition(messages: DataFrame, plan: DataFrame) -> DataFrame:
    """Messages of the planned partitions (a plan of `chunks.partition_plan`), each partition's behind its committed offset, with their chunk_no.

    All partitions are read by one job; a plan has a row for each topic partition.
    """
    todo = plan.select("topic", "partition_id", "chunk_no", "committed_offset")
    return messages.join(F.broadcast(todo), ["topic", "partition_id"]).filter(F.col("msg_offset") >= F.greatest("committed_offset", F.lit(0))).drop("committed_offset")


@dataclass(frozen=True)
class Bounds:
    """What a run reads of one topic partition: the messages with offsets from start to before end, `take` in number."""

    topic: str
    partition_id: int
    start: int
    end: int
    take: int


def water_filled(counts: Sequence[int], most: int) -> list[int]:
    """How many of each partition's messages a run of `most` reads: as even as the counts allow, the odd ones to the first partitions that have more."""
    level, left, todo = 0, most, len(counts)
    for n in sorted(counts):
        if (n - level) * todo > left:
            level, left = level + left // todo, left % todo
            break
        left -= (n - level) * todo
        level, todo = n, todo - 1
    out = []
    for n in counts:
        odd = n > level and left > 0 and todo > 0
        left -= odd
        out.append(min(n, level) + odd)
    return out


def run_bounds(messages: DataFrame, most: int | None = None, each: int | None = None) -> list[Bounds]:
    """Where a run of at most `most` messages in all, or `each` of every partition, begins and ends in every topic partition.

    From counts only: no message is sorted or numbered. Offsets may have gaps; where they have, the end is searched by counting messages in ever narrower ranges of
    offsets (SEARCH ranges a partition and round, so three rounds for a billion offsets), and only those in the range found are counted again. An offset is one
    message; rows that repeat one count each and stay together. One row for each topic partition is on the driver.
    """
    found = messages.groupBy("topic", "partition_id").agg(F.min("msg_offset").alias("low"), F.max("msg_offset").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("topic", "partition_id").collect()
    takes = [r["n"] if each is None else min(r["n"], each) for r in found]
    if most is not None:
        takes = water_filled(takes, most)
    ends: dict[tuple[str, int], int] = {}
    search = []
    for r, take in zip(found, takes, strict=True):
        at = r["topic"], r["partition_id"]
        if take == r["n"]:
            ends[at] = r["high"] + 1
        elif take == 0 or r["high"] - r["low"] + 1 == r["n"]:  # nothing to read, or no gaps
            ends[at] = r["low"] + take
        else:
            search.append((*at, r["low"], r["high"] + 1, take))
    while search:
        search, done = _narrowed(messages, search)
        ends |= done
    return [Bounds(r["topic"], r["partition_id"], r["low"], ends[r["topic"], r["partition_id"]], take) for r, take in zip(found, takes, strict=True)]


#: Ranges of offsets that a round of the search counts in each topic partition.
SEARCH = 1_024


def _narrowed(messages: DataFrame, search: list[tuple]) -> tuple[list[tuple], dict[tuple[str, int], int]]:
    """One round for (topic, partition, low, high, want): the range of offsets that holds the want-th message from low on; ends that are found."""
    spark = messages.sparkSession
    todo = spark.createDataFrame([(*r, max(1, -(-(r[3] - r[2]) // SEARCH))) for r in search], "topic string, partition_id int, low bigint, high bigint, want bigint, width bigint")
    inside = messages.select("topic", "partition_id", "msg_offset").join(F.broadcast(todo), ["topic", "partition_id"]).filter((F.col("msg_offset") >= F.col("low")) & (F.col("msg_offset") < F.col("high")))
    counted = inside.groupBy("topic", "partition_id", "low", "want", "width", F.floor((F.col("msg_offset") - F.col("low")) / F.col("width")).alias("range")).count()
    up_to = Window.partitionBy("topic", "partition_id").orderBy("range")  # SEARCH rows at most
    hit = counted.withColumn("total", F.sum("count").over(up_to)).filter(F.col("total") >= F.col("want")).groupBy("topic", "partition_id").agg(F.min(F.struct("range", "total", "count", "low", "want", "width")).alias("hit"))
    left, done = [], {}
    for r in hit.select("topic", "partition_id", "hit.*").collect():
        low = r["low"] + r["range"] * r["width"]
        if r["width"] == 1:
            done[r["topic"], r["partition_id"]] = low + 1
        else:
            left.append((r["topic"], r["partition_id"], low, low + r["width"], r["want"] - (r["total"] - r["count"])))
    return left, done


def within(messages: DataFrame, bounds: Sequence[Bounds], how: str = "left_semi") -> DataFrame:
    """The messages before the bounds' ends (with left_anti: the others)."""
    rows = messages.sparkSession.createDataFrame([(b.topic, b.partition_id, b.end) for b in bounds], "_topic string, _partition int, _end bigint")
    hit = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition_id").eqNullSafe(F.col("_partition")) & (F.col("msg_offset") < F.col("_end"))
    return messages.join(F.broadcast(rows), hit, how)  # a row for each topic partition


def broker_offsets(bounds: Sequence[Bounds], end: bool = True) -> str:
    """JSON for `startingOffsets` or `endingOffsets` of a bounded read from a broker."""
    out: dict[str, dict[str, int]] = {}
    for b in bounds:
        out.setdefault(b.topic, {})[str(b.partition_id)] = b.end if end else b.start
    return json.dumps(out, sort_keys=True)


def window_of(messages: DataFrame, starting: Mapping[int, int] | None = None, cap: int | None = None, partitions: Sequence[int] | None = None) -> DataFrame:
    """A bounded read: from an offset for each partition, of some partitions, of at most `cap` messages of each partition."""
    if partitions is not None:
        messages = messages.filter(F.col("partition_id").isin(*partitions))
    for p, offset in (starting or {}).items():
        messages = messages.filter((F.col("partition_id") != p) | (F.col("msg_offset") >= offset))
    return messages if cap is None else within(messages, run_bounds(messages, each=cap))


def latest_message(messages: DataFrame, keys: Sequence[str], order: Sequence[str] = ("msg_offset",)) -> DataFrame:
    """The last message of each key, by offset (a keyed topic holds a key in one partition)."""
    return latest_per_key(messages, keys, order)


def capped(messages: DataFrame, most: int) -> DataFrame:
    """The messages of a run of at most `most`, all partitions together: the first of each partition, evenly (see `run_bounds`). The cap is the feature."""
    return within(messages, run_bounds(messages, most))


def sampled(messages: DataFrame, last: int, preview: int = 100) -> DataFrame:
    """The last messages of each partition, values cut to a preview. The feature is a bounded sample."""
    rows = top_rows(messages, ["topic", "partition_id"], [F.desc("msg_offset")], last)
    cut = F.when(F.length("msg_value") > preview, F.concat(F.substring("msg_value", 1, preview), F.lit("..."))).otherwise(F.col("msg_value"))
    return rows.withColumn("msg_value", cut)
