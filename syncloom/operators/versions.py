"""Versioned tables: stamps, latest versions, deduplication, compaction, file statistics and table health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import version_id
from .keys import broadcast_checked, latest_per_key

#: Fixed thresholds: parts of a fragmented table, unmerged parts that are many.
MOST_PARTS, MOST_UNMERGED = 300, 50


def stamped(df: DataFrame, execution_date: str | None = None, overwrite: bool = False) -> DataFrame:
    """df with version_id as bigint: stamped where absent (or always, with overwrite), else coerced."""
    stamp = version_id(F.lit(execution_date))
    if "version_id" in df.columns and not overwrite:
        return df.withColumn("version_id", F.coalesce(F.col("version_id").cast("bigint"), stamp))
    return df.withColumn("version_id", stamp)


def latest_version(df: DataFrame, keys: Sequence[str], version: Sequence[str] = ("version_id",)) -> DataFrame:
    return latest_per_key(df, keys, version)


def dedup_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or one row (the greatest) for each key."""
    return df.distinct() if keys is None else latest_per_key(df, keys, ())


def compacted(df: DataFrame, partition: Column | None, keys: Sequence[str] | None = None, version: Sequence[str] = ("version_id",)) -> DataFrame:
    """The table after one partition (or all) has been rewritten: latest versions if keys are given, else distinct rows."""
    hit = F.lit(True) if partition is None else F.coalesce(partition, F.lit(False))
    chosen = df.filter(hit)
    done = latest_version(chosen, keys, version) if keys else chosen.distinct()
    return done if partition is None else df.filter(~hit).unionByName(done)


def compact_files(spark: SparkSession, path: str, out: str, partition_by: str, values: Sequence[str] | None = None, keys: Sequence[str] | None = None, version: Sequence[str] = ("version_id",), files: int = 1) -> DataFrame:
    """Rewrite partitions of a table on files with fewer files into `out`; other partitions there are left alone. Rows before and after."""
    df = spark.read.parquet(path)
    if values is not None:
        df = df.filter(F.col(partition_by).cast("string").isin(*values))
    done = latest_version(df, [*keys, partition_by], version) if keys else df.distinct()
    spread = done.repartition(F.col(partition_by), F.pmod(F.hash(*done.columns), F.lit(files)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(out)
    after = spark.read.parquet(out)
    if values is not None:
        after = after.filter(F.col(partition_by).cast("string").isin(*values))
    return df.agg(F.count(F.lit(1)).alias("rows_before")).join(after.agg(F.count(F.lit(1)).alias("rows_after")))


def part_stats(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """total_rows, stored_bytes, raw_bytes, compression_ratio, parts, oldest, newest of part rows (part_rows, part_bytes, raw_bytes, modified)."""
    t = parts.groupBy(*by).agg(F.sum("part_rows").alias("total_rows"), F.sum("part_bytes").alias("stored_bytes"), F.sum("raw_bytes").alias("raw_bytes"), F.count(F.lit(1)).alias("parts"), F.min("modified").alias("oldest"), F.max("modified").alias("newest"))
    return t.withColumn("compression_ratio", F.when((F.col("stored_bytes") > 0) & (F.col("raw_bytes") > 0), F.round(F.col("raw_bytes") / F.col("stored_bytes"), 2)))


def part_list(parts: DataFrame) -> DataFrame:
    """Part rows in order of partition and name."""
    return parts.orderBy("partition_key", "part_name")


def file_stats(df: DataFrame) -> DataFrame:
    """part_stats of the files behind a table."""
    return part_stats(file_parts(df))


def file_parts(df: DataFrame) -> DataFrame:
    """A row for each Parquet file: part_name, part_bytes, modified, part_rows, and the bytes of its row groups, raw_bytes and packed_bytes.

    The list of files comes from the scan's own metadata, no column is read; then tasks read one footer a file. raw_bytes and packed_bytes are NULL in a
    store that the footer reader can't open.
    """
    m = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    files = m.groupBy(F.col("file_path").alias("part_name"), F.col("file_size").alias("part_bytes"), F.col("file_modification_time").alias("modified")).agg(F.count(F.lit(1)).alias("part_rows"))
    return with_footers(files)


def with_footers(files: DataFrame, name: str = "part_name") -> DataFrame:
    """files with raw_bytes and packed_bytes: sums over the row groups in each file's footer."""
    schema = T.StructType([*files.schema.fields, T.StructField("raw_bytes", T.LongType()), T.StructField("packed_bytes", T.LongType())])

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            raw, stored = [], []
            for path in batch.column(batch.schema.get_field_index(name)).to_pylist():
                try:
                    store, at = fs.FileSystem.from_uri(path)
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    raw.append(None)
                    stored.append(None)
                    continue
                footer = pq.read_metadata(at, filesystem=store)
                groups = [footer.row_group(i) for i in range(footer.num_row_groups)]
                raw.append(sum(g.total_byte_size for g in groups))
                stored.append(sum(g.column(c).total_compressed_size for g in groups for c in range(g.num_columns)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.int64()), pa.array(stored, pa.int64())], names=schema.names)

    return files.mapInArrow(read, schema)


def compaction_decision(parts: DataFrame, threshold: int = 100, by: Sequence[str] = ()) -> DataFrame:
    """parts and whether to compact (for each group): below the threshold it is skipped."""
    n = F.count(F.lit(1))
    return parts.groupBy(*by).agg(n.alias("parts"), F.when(n >= threshold, "compact").otherwise("skip").alias("decision"))


def compacted_if_fragmented(df: DataFrame, partition: Column, parts: DataFrame, threshold: int = 100, keys: Sequence[str] | None = None, version: Sequence[str] = ("version_id",)) -> DataFrame:
    """The table after the partitions whose parts (partition_key, ...) reach the threshold have been rewritten, others as they are.

    The decision is a small table of partitions, joined to the rows; no partition is looped over.
    """
    due = compaction_decision(parts, threshold, ["partition_key"]).filter("decision = 'compact'").select(F.col("partition_key").alias("_due"))
    marked = df.withColumn("_partition", partition).join(broadcast_checked(due), F.col("_partition") == F.col("_due"), "left")
    chosen = marked.filter("_due is not null").select("_partition", *df.columns)
    done = latest_version(chosen, ["_partition", *keys], version) if keys else chosen.distinct()
    return marked.filter("_due is null").select(*df.columns).unionByName(done.select(*df.columns))


def table_health(parts: DataFrame, unmerged: Column | None = None) -> DataFrame:
    """For each table: rows, bytes, parts, unmerged parts, issues and health (0, 1 or more issues: healthy, warning, critical)."""
    fresh = F.col("part_level") == 0 if unmerged is None else unmerged
    t = parts.groupBy("table_name").agg(F.sum("part_rows").alias("total_rows"), F.sum("part_bytes").alias("total_bytes"), F.count(F.lit(1)).alias("parts"), F.count(F.when(fresh, 1)).alias("unmerged_parts"))
    issues = (F.col("parts") > MOST_PARTS).cast("int") + (F.col("unmerged_parts") > MOST_UNMERGED).cast("int")
    return t.withColumn("issues", issues).withColumn("health", F.when(F.col("issues") == 0, "healthy").when(F.col("issues") == 1, "warning").otherwise("critical"))


def logged_health(parts: DataFrame, taken: Column, unmerged: Column | None = None) -> DataFrame:
    """Rows of `table_health` with `taken`, the number of the look: to be appended to a log."""
    return table_health(parts, unmerged).withColumn("taken", taken)


def health_changes(log: DataFrame) -> DataFrame:
    """Of every look at a table but its first: what it was before and is after. A table's looks are few (one a run), so one window a table.

    table_name, taken, parts_before, parts_after, parts_reduced (negative if there are more), bytes_before, bytes_after, health_before, health_after.
    """
    order = Window.partitionBy("table_name").orderBy("taken")
    before = [F.lag(c).over(order).alias(f"{c}_before") for c in ("parts", "total_bytes", "health")]
    both = log.select("table_name", "taken", "parts", "total_bytes", "health", *before).filter("parts_before is not null")
    return both.select("table_name", "taken", "parts_before", F.col("parts").alias("parts_after"), (F.col("parts_before") - F.col("parts")).alias("parts_reduced"), F.col("total_bytes_before").alias("bytes_before"), F.col("total_bytes").alias("bytes_after"), "health_before", F.col("health").alias("health_after"))
