"""What several of the operators share: checkpoints, joins with a checked broadcast, and Arrow batch plumbing."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side with at most so many rows and bytes is broadcast; beyond that the join shuffles (adaptive execution splits hot keys).
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Bytes of text that a Python worker looks at together. Bounds its memory at some thirty times this; one longer text goes alone.
CHUNK_BYTES = 1 << 20
#: Resamples over which a threshold is averaged, since the place of the least sum itself hangs on few rows.
DRAWS = 50
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; only a local session without that setting (tests) gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder. With spark.cleaner.referenceTracking.cleanCheckpoints, Spark removes it when nothing refers to it any more; else it stays."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as a Parquet table in the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    back.written_at = path
    return back


def forget(df: DataFrame) -> None:
    """Remove the table behind a DataFrame of `written`, when nothing that is still to run reads it."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df.written_at)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _width(c: Column, kind: T.DataType) -> Column:
    """Bytes of a value, about."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType | T.BinaryType | T.ArrayType | T.StructType):
            return F.aggregate(F.coalesce(c, F.array().cast(kind)), F.lit(16), lambda total, x: total + _width(x, kind.elementType).cast("int"))
        return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * 8 + 16
    if isinstance(kind, T.StructType):
        return sum((_width(c[f.name], f.dataType) for f in kind.fields), F.lit(8))
    return F.lit(8)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether df may be broadcast, by the number of its rows and their bytes (counted where they are)."""
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return found["rows"] <= rows and found["size"] <= size


def join_checked(left: DataFrame, right: DataFrame, on: Column | list[str] | str, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join that broadcasts the right side only after counting it; a larger one is joined by a shuffle. The right side is best checkpointed before."""
    return left.join(F.broadcast(right) if is_small(right, rows) else right, on, how)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, mod `folds`; -1 without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(-1))


def send_package(df: DataFrame) -> None:
    """Send the package to the executors' Python workers (once a context)."""
    context = df.sparkSession.sparkContext
    if getattr(context, "_syncloom_sent", None) is None:
        top = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="syncloom-")) / "syncloom.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(top.rglob("*.py")):
                out.write(path, path.relative_to(top.parent))
        context.addPyFile(str(archive))
        context._syncloom_sent = str(archive)


def map_arrow(df: DataFrame, f: Callable, schema) -> DataFrame:
    """mapInArrow, with the package sent before."""
    send_package(df)
    return df.mapInArrow(f, schema)


def with_fields(schema: T.StructType, **kinds: str) -> T.StructType:
    out = T.StructType(list(schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_sample(df: DataFrame, rows: int, seed: int, labels: list | None = None) -> pa.Table:
    """At most `rows` different rows of df (label, text), picked by a hash of the text and in its order, on the driver.

    With labels, each of them has its equal part of the rows, and all its rows if they are fewer. Copies of a text count once, and are taken
    together before anything is sent.
    """
    place = F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1 << 40))
    part = rows if labels is None else rows // max(1, len(labels))
    limit = lambda n: int(min(1.0, 1.05 * part / max(1, n)) * (1 << 40)) + 1
    if labels is None:
        return df.filter(place < limit(df.count())).distinct().orderBy(place, "text", "label").limit(rows).toArrow().combine_chunks()
    counts = {r["label"]: r["count"] for r in df.filter(F.col("label").isin(labels)).groupBy("label").count().collect()} if labels else {}
    limits = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, limit(n))]) if counts else F.create_map().cast("map<string,bigint>")
    picked = df.filter(place < F.coalesce(F.try_element_at(limits, F.col("label")), F.lit(0))).distinct().withColumn("place", place)
    order = Window.partitionBy("label").orderBy("place", "text")  # a bounded number of rows by now
    ranked = picked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= part)
    return ranked.orderBy("label", "rank").select("label", "text").toArrow().combine_chunks()


def balanced_threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The score with the least sum of the share of missed texts and that of false alarms, as the mean over DRAWS resamples of the rows. y has both labels."""
    rng, found = np.random.default_rng(0), []
    for draw in range(DRAWS):
        rows = rng.integers(0, len(z), len(z)) if draw else np.arange(len(z))
        rows = rows[np.argsort(z[rows], kind="stable")]
        own, ones = z[rows], y[rows]
        if ones.min() == ones.max():
            continue
        missed, false = np.cumsum(np.append(0, ones)) / ones.sum(), 1 - np.cumsum(np.append(0, 1 - ones)) / (1 - ones).sum()
        cuts = np.concatenate([[own[0] - 1], (own[1:] + own[:-1]) / 2, [own[-1] + 1]])
        good = cuts[missed + false <= (missed + false).min() + 1e-12]
        found.append(good[(len(good) - 1) // 2])
    return float(np.mean(found))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n+1 offsets of the texts in them; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES, rows: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, end row, bytes, offsets) of a batch with at most `size` bytes of text and `rows` rows, or one longer text."""
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    n, i = len(offsets) - 1, 0
    while i < n:
        j = min(n, i + rows, max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
