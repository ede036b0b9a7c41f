"""Document fingerprints by winnowing.

Every k successive code points are hashed; of every w successive hashes the smallest is selected, the rightmost among equals. Texts that
share a run of k + w - 1 code points or more thus share a selected hash: ten, half of a text of twenty. Positions are kept beside the hashes, so a match can be found in both texts.
A text with fewer than k code points is one hash; one with fewer than w hashes has their smallest.

A fingerprint as a string is base64 of its (hash, position gap) pairs in order of position, 32 bits a pair: gaps are at most w, so they take the last few bits and
the hash the others. Likeness is the share of distinct hashes
that two fingerprints have in common (Jaccard); that of two empty ones is 1.

Scale: no row meets another, except for the successor of each document. For that, documents are dealt into ranges of (doc_id, beginning of the
text) found from a sample; there are RANGES of them for each shuffle partition that the session is set to, so what the driver holds depends on
that setting and not on the documents. The first document of each range is copied to the range before, and each range is sorted and
streamed: one shuffle of the texts, no global window. Documents that share one id, or have none, are spread by their texts.

Defined results: null text is empty, with an empty fingerprint; the document after the last is the first; documents with the same id
follow by text, those without an id come first; rows that are equal in id and text are in one range; a single document is its own
successor; an empty table gives no rows; extra columns are ignored; ids must be integers, since documents follow each other by them (others are a TypeError).
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, with_fields
from .textops import mix64

#: Code points of a hash and hashes of a window. About one hash in three is kept, so a fingerprint has some 1.7 characters for each of the text.
K, W = 6, 5
#: Bits of a position gap, which is W at most; the other bits of 32 are the hash's.
GAP_BITS = 3
#: Ranges for each shuffle partition, so that hashing them deals alike; least rows of a range; characters of a text that ranges go by; sampled rows a range.
RANGES, RANGE_ROWS, PREFIX, SAMPLE = 8, 500, 32, 4
#: Characters of fingerprints that a worker gives out together, beyond those of one row.
OUT_CHARS = 16_000_000
_FACTORS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) ** 3 % (1 << 64) | 1 for i in range(64)], np.uint64)


def fingerprint(points: np.ndarray, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes (32 - GAP_BITS bits) selected from an array of code points."""
    if w >= 1 << GAP_BITS:
        raise ValueError(f"windows of {w} hashes need more than {GAP_BITS} bits a gap")
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    k = min(k, n)
    wide = points.astype(np.uint64)
    total = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        total += wide[j : n - k + 1 + j] * _FACTORS[j]
    hashes = (mix64(total) >> np.uint64(32 + GAP_BITS)).astype(np.uint64)
    w = min(w, len(hashes))
    # smallest hash, then rightmost position: one key that can be compared
    key = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64))
    low, size = key, 1
    while 2 * size <= w:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    if size < w:
        low = np.minimum(low[: len(key) - w + 1], low[w - size : w - size + len(key) - w + 1])
    chosen = low[np.flatnonzero(np.diff(low, prepend=~low[:1]))]  # a window's choice moves to the right only
    return (np.uint64(0xFFFFFFFF) - (chosen & np.uint64(0xFFFFFFFF))).astype(np.int64), (chosen >> np.uint64(32)).astype(np.uint32)


def encoded(positions: np.ndarray, hashes: np.ndarray) -> str:
    pairs = (hashes.astype("<u4") << GAP_BITS) | np.diff(positions, prepend=0).astype("<u4")
    return base64.b64encode(pairs.astype("<u4").tobytes()).decode()


def decoded(text: str) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(base64.b64decode(text), np.dtype("<u4"))
    return np.cumsum((pairs & ((1 << GAP_BITS) - 1)).astype(np.int64)), pairs >> GAP_BITS


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """a, b: sorted distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_NONE = np.iinfo(np.int64).min  # stands for a null id


class _Ranges:
    """Edges of ranges of (id, beginning of the text), sorted, and the first such pair of each range with the range before it."""

    def __init__(self, edges: list[tuple[int, bytes]]):
        self.edges = edges
        self.ids = np.array([e[0] for e in edges], np.int64)
        self.firsts: dict[int, tuple[int, bytes, int]] = {}

    @staticmethod
    def keys(ids: pa.Array, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        return np.asarray(ids.cast(pa.int64()).fill_null(_NONE)), texts

    @staticmethod
    def prefix(text: str) -> bytes:
        return text[:PREFIX].encode("utf-8", "surrogatepass")

    def of(self, ids: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Range of each row: the number of edges not above it. Texts are looked at only where an edge has the row's id."""
        low, high = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        for r in np.flatnonzero(low < high).tolist():
            high[r] = bisect.bisect_right(self.edges, (int(ids[r]), self.prefix(texts[r].as_py())), int(low[r]), int(high[r]))
        return high


def with_successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text, range, halo), sorted within partitions so that each document is followed by its successor; halo rows only follow."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    parts = max(1, min(RANGES * partitions, -(-n // RANGE_ROWS)))
    short = rows.select("doc_id", F.substring("text", 1, PREFIX).alias("text"))
    edges: list[tuple[int, bytes]] = []
    if parts > 1:
        share = min(1.0, SAMPLE * parts / n)
        some = short.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < int(share * (1 << 40)) + 1).distinct().limit(2 * SAMPLE * parts + 100).toArrow()
        ids, texts = _Ranges.keys(some.column("doc_id").combine_chunks(), some.column("text"))
        pairs = sorted(zip(ids.tolist(), map(_Ranges.prefix, texts.to_pylist()), strict=True))
        edges = sorted({pairs[len(pairs) * i // parts] for i in range(1, parts)}) if pairs else []
    ranges = _Ranges(edges)
    shared = spark.sparkContext.broadcast(ranges)

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, bytes]] = {}
        for batch in batches:
            ids, texts = _Ranges.keys(batch.column(0), batch.column(1))
            at = shared.value.of(ids, texts)
            order = np.lexsort((ids, at))
            first = np.flatnonzero(np.diff(at[order], prepend=-1))
            for r, end in zip(first.tolist(), np.append(first[1:], len(order)).tolist(), strict=True):
                own = int(ids[order[r]])
                while r < end and ids[order[r]] == own:  # rows with the smallest id of the range
                    pair = (own, _Ranges.prefix(texts[int(order[r])].as_py()))
                    place = int(at[order[r]])
                    found[place] = min(found.get(place, pair), pair)
                    r += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([x[0] for x in found.values()], pa.int64()), pa.array([x[1] for x in found.values()], pa.binary())], names=["range", "id", "prefix"])

    firsts = map_arrow(short, lowest, "range long, id long, prefix binary").groupBy("range").agg(F.min(F.struct("id", "prefix")).alias("first")).orderBy("range").collect()
    for k, r in enumerate(firsts):  # as many as ranges
        ranges.firsts[r["range"]] = (r["first"]["id"], bytes(r["first"]["prefix"]), firsts[k - 1]["range"])
    placed = spark.sparkContext.broadcast(ranges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = placed.value
        first_ids = np.full(len(ranges.edges) + 1, _NONE)
        for r, (first, _, _) in ranges.firsts.items():
            first_ids[r] = first
        for batch in batches:
            ids, texts = _Ranges.keys(batch.column(0), batch.column(1))
            at = ranges.of(ids, texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), pa.array(np.zeros(len(at), np.int32))], names=["doc_id", "text", "range", "halo"])
            likely = [r for r in np.flatnonzero(ids == first_ids[at]).tolist() if ranges.firsts[int(at[r])][1] == _Ranges.prefix(texts[r].as_py())]
            if likely:
                copied = batch.take(pa.array(likely))
                before = np.array([ranges.firsts[int(at[r])][2] for r in likely], np.int32)
                yield pa.RecordBatch.from_arrays([*copied.columns, pa.array(before), pa.array(np.ones(len(likely), np.int32))], names=["doc_id", "text", "range", "halo"])

    dealt = map_arrow(rows, place, with_fields(rows.schema, range="integer", halo="integer"))
    return dealt.repartition(min(partitions, len(edges) + 1), "range").sortWithinPartitions("range", "halo", "doc_id", "text")


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last half (floor) replaced by as many code points from the beginning of its successor.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"documents follow each other by integer ids; {id_col} is {docs.schema[id_col].dataType.simpleString()}")
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def row(doc, points, own, next_points, next_own):
        half = len(points) // 2
        edited = np.concatenate([points[: len(points) - half], next_points[:half]])
        positions, hashes = fingerprint(edited)
        text = edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        return doc, len(points), hashlib.sha256(text).hexdigest(), encoded(*own[:2]), encoded(positions, hashes), likeness(own[2], np.unique(hashes)), likeness(own[2], next_own[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # range, doc_id, code points, (positions, hashes, distinct hashes) of the row before, and whether it is still to be given out
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for doc, text, part, halo in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if halo and (held is None or held[0] != part or held[4]):
                    continue  # only the first row after a range's last own one counts
                points = _points(text)
                positions, hashes = fingerprint(points)
                own = (positions, hashes, np.unique(hashes))
                if held is not None and held[0] == part:
                    out.append(row(held[1], held[2], held[3], points, own))
                    size += len(out[-1][3]) + len(out[-1][4])
                held = (part, doc, points, own, halo)
                if len(out) >= 1000 or size >= OUT_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(docs.schema[id_col].dataType), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return map_arrow(with_successors(docs, id_col, text_col), run, schema)
