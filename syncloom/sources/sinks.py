"""Sinks: versioned snapshots behind a pointer, message tables, JDBC, and two sinks in one pass that can be retried."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.digests import BUCKET, bucket_digests, with_bucket

_POINTERS, _DIGESTS, _DONE, _DIGITS = "_pointers", "_digests", "_SUCCESS", 12


def files(spark: SparkSession, path: str):
    """(file system, Path) of any path that Spark can read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under `path` that Spark has finished writing, in order."""
    fs, at = files(spark, f"{path}/*/{_DONE}")
    return sorted(s.getPath().getParent().getName() for s in fs.globStatus(at) or [])


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, at = files(spark, path)
    fs.delete(at, True)


def write_snapshot(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keep: int = 2, bucket_by: tuple[Sequence[str], int] | None = None) -> str:
    """Write a new version beside the old ones, then a new pointer to it: until the pointer is complete, readers have the old version.

    Pointers are numbered and never replaced, so a failure at any time leaves a readable table; one writer at a time. What the last `keep`
    pointers name stays, for readers that are under way. bucket_by: keys (never NULL) and a number of buckets, in which the rows are dealt and sorted, so that a
    merge on the keys needn't shuffle them again.
    """
    spark = df.sparkSession
    number, version = _next(spark, path)
    if bucket_by:
        keys, buckets = list(bucket_by[0]), bucket_by[1]
        name = _bucketed_name(path, version)
        _without_null_keys(df, keys).repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", f"{path}/{version}").saveAsTable(name)
        _point(spark, path, number, [_part(version, schema=_ddl(df), keys=keys, buckets=buckets)])
    else:
        writer = df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{version}")
        _point(spark, path, number, [_part(version)])
    _forget(spark, path, keep)
    return version


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    some = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        some = some & F.col(k).isNotNull()
    return df.filter(F.when(some, F.lit(True)).otherwise(F.raise_error(F.lit(f"a key of a bucketed snapshot is NULL: {list(keys)}")).cast("boolean")))


def _part(version: str, folders: list[str] | None = None, schema: str | None = None, keys: list[str] | None = None, buckets: int | None = None) -> dict:
    """One part of a snapshot: a version's folder, or some partitions of it; schema and buckets where its files don't tell them."""
    return {"version": version, "folders": folders, "schema": schema, "keys": keys, "buckets": buckets}


def _next(spark: SparkSession, path: str) -> tuple[int, str]:
    pointers = complete_folders(spark, f"{path}/{_POINTERS}")
    number = int(pointers[-1]) + 1 if pointers else 0
    return number, f"v={number:0{_DIGITS}d}-{uuid.uuid4().hex}"


def _point(spark: SparkSession, path: str, number: int, parts: list[dict]) -> None:
    rows = [(json.dumps(p),) for p in parts]
    spark.createDataFrame(rows, "part string").coalesce(1).write.mode("overwrite").text(f"{path}/{_POINTERS}/{number:0{_DIGITS}d}")


def _parts(spark: SparkSession, path: str, pointer: str) -> list[dict]:
    return [json.loads(r["value"]) for r in spark.read.text(f"{path}/{_POINTERS}/{pointer}").collect()]


def _forget(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the last `keep` pointers, and what only those named."""
    pointers = complete_folders(spark, f"{path}/{_POINTERS}")
    old, live = pointers[: max(0, len(pointers) - keep)], {p["version"] for at in pointers[-keep:] for p in _parts(spark, path, at)}
    for at in old:
        for p in _parts(spark, path, at):
            if p["version"] not in live:
                if p["buckets"]:
                    spark.sql(f"DROP TABLE IF EXISTS {_bucketed_name(path, p['version'])}")
                drop_folder(spark, f"{path}/{p['version']}")
                drop_folder(spark, f"{path}/{_DIGESTS}/{p['version']}")
        drop_folder(spark, f"{path}/{_POINTERS}/{at}")


def _bucketed_name(path: str, version: str) -> str:
    return "snapshot_" + hashlib.md5(f"{path}/{version}".encode()).hexdigest()


def _read_part(spark: SparkSession, path: str, part: dict, below: Sequence[str] | None = None) -> DataFrame:
    base = f"{path}/{part['version']}"
    if part["buckets"]:
        name, keys = _bucketed_name(path, part["version"]), ", ".join(f"`{k}`" for k in part["keys"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({part['schema']}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {part['buckets']} BUCKETS LOCATION '{base}'")
        return spark.table(name)
    reader = spark.read if part["schema"] is None else spark.read.schema(part["schema"])
    if part["folders"] is None:
        return reader.parquet(base)
    folders = [f for f in part["folders"] if below is None or f in below]
    return reader.option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]) if folders else spark.createDataFrame([], part["schema"])


def _current(spark: SparkSession, path: str) -> list[dict]:
    pointers = complete_folders(spark, f"{path}/{_POINTERS}")
    if not pointers:
        raise FileNotFoundError(f"no snapshot at {path}")
    return _parts(spark, path, pointers[-1])


def read_snapshot(spark: SparkSession, path: str, folders: Sequence[str] | None = None, file: str | None = None) -> DataFrame:
    """The table as its newest pointer tells it. folders: of a table that `replace_folders` writes, these partitions only; no other is opened.

    file: name for a column with each row's file (file_path, file_size, file_modification_time).
    """
    parts = _current(spark, path)
    found = [_read_part(spark, path, p, folders) for p in parts if folders is None or p["folders"] is None or set(p["folders"]) & set(folders)]
    if not found:
        return _read_part(spark, path, parts[0], ())
    if file:
        found = [df.select("*", F.struct("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias(file)) for df in found]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def partition_folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Folders column=value under a path."""
    fs, at = files(spark, f"{path}/{column}=*")
    return sorted(s.getPath().getName() for s in fs.globStatus(at) or [])


def replace_folders(df: DataFrame, path: str, column: str, replaced: Sequence[str] | None = None, keep: int = 2, before_pointer: Callable[[str, list[str]], None] | None = None) -> list[str]:
    """Write df partitioned by a column and point to its folders in place of the `replaced` ones (None: of all); the other folders stay where they are, untouched.

    before_pointer sees the new version and its folders, and may refuse them by an exception: then nothing has changed for readers. The folders written.
    """
    spark = df.sparkSession
    number, version = _next(spark, path)
    df.write.partitionBy(column).parquet(f"{path}/{version}")
    folders = partition_folders(spark, f"{path}/{version}", column)
    if before_pointer:
        before_pointer(version, folders)
    schema = _ddl(df.select(*[c for c in df.columns if c != column], column))
    parts = [] if replaced is None or not number else _current(spark, path)
    left = [p | {"folders": own} for p in parts if (own := [f for f in p["folders"] if f not in replaced])]
    _point(spark, path, number, [*left, _part(version, folders, schema)])
    _forget(spark, path, keep)
    return folders


def write_digested(df: DataFrame, path: str, keys: Sequence[str], buckets: int, changed: Sequence[int] | None = None) -> None:
    """A snapshot in folders by bucket of the key, with the digest of each bucket beside it. changed: the buckets that df holds whole; the others stay as they are."""
    spark = df.sparkSession
    rows = with_bucket(df, keys, buckets).repartition(buckets, BUCKET)

    def digest(version: str, folders: list[str]) -> None:
        fresh = spark.read.schema(_ddl(rows)).parquet(f"{path}/{version}").drop(BUCKET)
        bucket_digests(fresh, keys, [c for c in df.columns if c not in keys], buckets).coalesce(1).write.parquet(f"{path}/{_DIGESTS}/{version}")

    replace_folders(rows, path, BUCKET, None if changed is None else [f"{BUCKET}={b}" for b in changed], before_pointer=digest)


def read_digested(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a digested snapshot, or of some of its buckets."""
    return read_snapshot(spark, path, None if buckets is None else [f"{BUCKET}={b}" for b in buckets]).drop(BUCKET)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """The digest of each bucket of a digested snapshot: a row a bucket, no row of the table."""
    out = None
    for p in _current(spark, path):
        own = spark.read.parquet(f"{path}/{_DIGESTS}/{p['version']}").filter(F.concat(F.lit(f"{BUCKET}="), F.col(BUCKET).cast("string")).isin(p["folders"]))
        out = own if out is None else out.unionByName(own)
    return out


def publish(messages: DataFrame, servers: str | None = None, path: str | None = None, **options: str) -> None:
    """Write topic, key, value, headers to a broker (idempotent producer, all replicas) or append them to a message table."""
    if servers:
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("kafka.enable.idempotence", "true").option("includeHeaders", "true")
        writer.options(**options).save()
    else:
        messages.write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_rows: int = 10_000, **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_rows).options(**options).mode(mode).save()


def upsert_jdbc(df: DataFrame, url: str, staging: str, apply: Callable[[], None], **options: str) -> None:
    """Write rows to a staging table in parallel, then let the caller run the store's own one merge statement."""
    write_jdbc(df, url, staging, "overwrite", **options)
    apply()


def _committed(spark: SparkSession, ledger: str, run: str, sink: str) -> str:
    return f"{ledger}/{hashlib.md5(run.encode()).hexdigest()}/{sink}"


def write_both(df: DataFrame, first: Callable[[DataFrame], None] | None, second: Callable[[DataFrame], None] | None, fail_on_error: bool = True, ledger: str | None = None, run: str | None = None) -> dict[str, str]:
    """Feed up to two sinks from one read. Without fail_on_error a sink's failure is reported, and the other still runs.

    With a ledger (a folder) and a run's name (in foreachBatch: the batch's number), a sink whose commit stands there is passed over, so that a run that failed
    between the sinks can be repeated: each sink that has finished isn't fed again. A sink that fails in the middle of its own write is fed again; what
    it had written by then is its own matter (`append_once` leaves nothing behind).
    """
    spark = df.sparkSession
    if ledger is not None and run is None:
        raise ValueError("a ledger needs the run's name")
    df = df.persist()
    said = {}
    try:
        for name, sink in (("first", first), ("second", second)):
            if sink is None:
                said[name] = "off"
                continue
            commit = None if ledger is None else _committed(spark, ledger, run, name)
            if commit and exists(spark, f"{commit}/{_DONE}"):
                said[name] = "written before"
                continue
            try:
                sink(df)
                if commit:
                    spark.createDataFrame([(run, name)], "run string, sink string").coalesce(1).write.mode("overwrite").json(commit)
                said[name] = "written"
            except Exception as e:
                if fail_on_error:
                    raise
                said[name] = f"failed: {e}"
    finally:
        df.unpersist()
    return said


def append_once(df: DataFrame, path: str, run: str) -> None:
    """Append a run's rows to a table of run folders; a repeated run writes the same folder anew, so its rows stand there once."""
    df.write.mode("overwrite").parquet(f"{path}/run={hashlib.md5(run.encode()).hexdigest()}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = files(spark, path)
    return fs.exists(at)
