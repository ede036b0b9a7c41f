"""Benchmark decontamination by spaced seeds.

Tokens are words of letters and digits, lower case. A fixed mask picks some of the positions of a window of tokens; the hash of the picked ones is a
seed, so that a substitution at an ignored position leaves it alone. Seeds of every position of the training texts are joined with those of the
test items. Around each hit, along its diagonal (training position - test position), tokens are compared one by one. A segment counts if it begins and
ends with a match, at least MIN_TOKENS of its tokens (or all of a shorter item) match, and MIN_IDENTITY of its length. Segments of one document and
item that meet or overlap in the document, on one or several diagonals, are one stretch; every stretch is an overlap. Items shorter than a mask
are looked for whole.

Scale: training texts stream through one pass without a shuffle. Test items are sent to the workers in blocks of at most about BLOCK_CHARS characters,
one pass for each block, so that what is broadcast is bounded for a test set of any size. Repetitive texts don't multiply: positions with one seed
are kept as runs of equal distance, two runs of one distance share as many diagonals as they have positions together, and a diagonal is only
compared if it can lengthen a stretch or hold more matches than the best segment of its stretch.

Defined results: null, empty and wordless texts and items match nothing; repeated documents are reported each by `overlaps`, and together by
`contaminated`, as are all documents without an id; items are reported each under their own item_id, copies of an item with one item_id once; where
several segments of a stretch have the most matching tokens, one of them is told; an empty table on either side gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_chunks
from .textops import mix64, words

#: Fixed masks; 1 marks the positions that count.
MASKS = ("111001011", "1101010011", "11001010011", "101101000101")
MIN_TOKENS, MIN_IDENTITY = 13, 0.8
IDENTITY = Fraction(str(MIN_IDENTITY))
BLOCK_CHARS = 20_000_000
_FACTORS = np.array([0xD1B54A32D192ED03 * (2 * i + 1) % (1 << 64) | 1 for i in range(64)], np.uint64)
_FILTER_BITS = 22
#: Pairs of runs, and diagonals, that are in memory at a time.
PAIRS = 500_000


def _seeds(hashes: np.ndarray, text: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Seed at every position where the window stays within one text, and that position."""
    whole = len(hashes) - len(mask) + 1
    if whole <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(whole, np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            total += hashes[j : j + whole] * _FACTORS[j]
    at = np.flatnonzero(text[:whole] == text[len(mask) - 1 :])
    return mix64(total[at]), at


def _runs(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in order of (key, at) as runs of equal distance: first index, distance (0 for one alone) and length of each."""
    n = len(at)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = np.diff(at)
    opens = np.ones(n, bool)
    opens[1:] = key[1:] != key[:-1]
    third = np.flatnonzero(~opens[1:-1] & ~opens[2:]) + 2  # positions with two before them under the same key
    breaks = opens.copy()
    breaks[third] = step[third - 1] != step[third - 2]
    first = np.flatnonzero(breaks)
    length = np.diff(np.append(first, n))
    return first, np.where(length > 1, step[np.minimum(first, n - 2)] if n > 1 else 0, 0), length


def _spread(first: np.ndarray, step: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All members of runs."""
    return np.repeat(first, length) + np.repeat(step, length) * (np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length))


def _merged(begin: np.ndarray, end: np.ndarray, matching: np.ndarray, tell: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches (begin, end) that segments make, and of the best segment of each its number in tell and its matching tokens."""
    order = np.lexsort((-matching, begin))
    begin, end, matching, tell = begin[order], end[order], matching[order], tell[order]
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(begin))))
    best = np.lexsort((-matching, group))[first]
    return begin[first], reach[np.append(first[1:], len(begin)) - 1], tell[best], matching[best]


def _segments(same: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, matching) of segments of a diagonal that count; together they cover all that count, and one of them has the most matching tokens."""
    matched = np.concatenate([[0], np.cumsum(same)])
    score = matched * IDENTITY.denominator - np.arange(len(matched)) * IDENTITY.numerator  # no less at a segment's end than at its begin, if enough match
    earliest = np.searchsorted(-np.minimum.accumulate(score), -score, "left")
    ends = np.flatnonzero(same) + 1
    ends = ends[matched[ends] - matched[earliest[ends]] >= need]
    if not len(ends):
        return (np.zeros(0, np.int64),) * 3
    places = np.flatnonzero(same)
    begins = places[np.searchsorted(places, earliest[ends])]
    begins, last = np.unique(begins[::-1], return_index=True)  # of one begin the last end
    ends = ends[::-1][last]
    return begins, ends, matched[ends] - matched[begins]


def _differences(a: np.ndarray, step: np.ndarray, length: np.ndarray, b: np.ndarray, b_step: np.ndarray, b_length: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(first of a's run, first of b's, difference) for all differences of the positions of pairs of runs, in bounded pieces."""
    alike = (step == b_step) | (length == 1) | (b_length == 1)
    odd = np.flatnonzero(~alike)
    own = np.repeat(odd, b_length[odd])  # runs of different distances: b's is taken position by position
    begin = np.concatenate([(a - b - (b_length - 1) * b_step)[alike], a[own] - _spread(b[odd], b_step[odd], b_length[odd])])
    by = np.concatenate([np.where(length == 1, b_step, step)[alike], step[own]])
    count = np.concatenate([(length + b_length - 1)[alike], length[own]])
    a, b = np.concatenate([a[alike], a[own]]), np.concatenate([b[alike], b[own]])
    total, i = np.cumsum(count), 0
    while i < len(count):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, "right")))
        yield np.repeat(a[i:j], count[i:j]), np.repeat(b[i:j], count[i:j]), _spread(begin[i:j], by[i:j], count[i:j])
        i = j


class Index:
    """Seeds of a block of test items."""

    def __init__(self, ids: list, texts: list):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        found = [(i, words(data, offsets, "alnum")) for i, _, data, offsets in text_chunks(batch, "text")]
        self.ids = ids
        self.hash = np.concatenate([w.hash for _, w in found] + [np.zeros(0, np.uint64)])
        self.item = np.concatenate([w.text + i for i, w in found] + [np.zeros(0, np.int64)])
        counts = np.bincount(self.item, minlength=len(ids))
        self.first = np.concatenate([[0], np.cumsum(counts)])
        least = min(map(len, MASKS))
        self.tables = []
        for mask in (*MASKS, *("1" * n for n in np.unique(counts[(counts > 0) & (counts < least)]).tolist())):
            seed, at = _seeds(self.hash, self.item, mask)
            if len(mask) < least:
                keep = counts[self.item[at]] == len(mask)
                seed, at = seed[keep], at[keep]
            order = np.lexsort((at, seed))
            seed, at = seed[order], at[order]
            flags = np.zeros(1 << _FILTER_BITS, bool)
            flags[(seed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            if len(seed):
                # a run stays within one item: its number takes part in the key
                first, step, length = _runs(mix64(seed + self.item[at].astype(np.uint64) * _FACTORS[1]), at)
                self.tables.append((mask, seed[first], at[first], step, length, flags))

    def diagonals(self, hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Distinct (text, item, position in the texts - position in the items) of all seeds in common, in order."""
        span = len(hashes) + len(self.hash)  # a triple is one number, for chunks and blocks are bounded
        seen, held = [np.zeros(0, np.int64)], 0
        for mask, table, there, there_step, there_length, flags in self.tables:
            seed, at = _seeds(hashes, text, mask)
            likely = np.flatnonzero(flags[(seed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            seed, at = seed[likely], at[likely]
            order = np.lexsort((at, seed))
            seed, at = seed[order], at[order]
            first, step, length = _runs(mix64(seed + text[at].astype(np.uint64) * _FACTORS[2]), at)
            seed, at = seed[first], at[first]
            low, high = np.searchsorted(table, seed, "left"), np.searchsorted(table, seed, "right")
            n = high - low
            pairs = np.cumsum(n)
            i = 0
            while i < len(n):  # so many pairs of runs at a time
                j = max(i + 1, int(np.searchsorted(pairs, (pairs[i - 1] if i else 0) + PAIRS, "right")))
                own = np.repeat(np.arange(i, j), n[i:j])
                other = np.repeat(low[i:j], n[i:j]) + np.arange(len(own)) - np.repeat(np.cumsum(n[i:j]) - n[i:j], n[i:j])
                for a, b, shift in _differences(at[own], step[own], length[own], there[other], there_step[other], there_length[other]):
                    seen.append(np.unique((text[a] * len(self.ids) + self.item[b]) * span + shift + len(self.hash)))
                    held += len(seen[-1])
                    if held > 8 * PAIRS:
                        seen, held = [np.unique(np.concatenate(seen))], 0
                i = j
        code = np.unique(np.concatenate(seen))
        return np.stack([code // (span * len(self.ids)), code // span % len(self.ids), code % span - len(self.hash)], axis=1) if len(code) else np.zeros((0, 3), np.int64)

    def stretches(self, hashes: np.ndarray, begin: int, end: int, item: int, shifts: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(begin, tokens) of each stretch of the text hashes[begin:end], and of its best segment begin, begin in the item, tokens, matching."""
        low, high = np.maximum(self.first[item], begin - shifts), np.minimum(self.first[item + 1], end - shifts)
        need = min(MIN_TOKENS, int(self.first[item + 1] - self.first[item]))
        able = high - low >= need
        shifts, low, high = shifts[able], low[able], high[able]
        left = np.arange(len(shifts))
        step = 1 << max(0, len(left).bit_length() - 5)
        kept: list[tuple[int, int, int]] = []  # segments told: begin, end, shift
        from_, to, who, most = (np.zeros(0, np.int64),) * 4
        while step and len(left):
            if len(from_):  # leave out what lies within a stretch and can't hold more matches than its best segment
                at = np.searchsorted(from_, low[left] + shifts[left], "right") - 1
                inside = (at >= 0) & (high[left] + shifts[left] <= to[at]) & (high[left] - low[left] <= most[at])
                left = left[~inside]
            now = left % step == 0
            found = [(from_, to, most, who)]
            for d in left[now].tolist():
                place = int(low[d] + shifts[d])
                b, e, matching = _segments(self.hash[low[d] : high[d]] == hashes[place : int(high[d] + shifts[d])], need)
                if len(b):
                    found.append((b + place, e + place, matching, np.arange(len(kept), len(kept) + len(b))))
                    kept += zip((b + place).tolist(), (e + place).tolist(), [int(shifts[d])] * len(b), strict=True)
            if len(found) > 1:
                from_, to, who, most = _merged(*(np.concatenate(x) for x in zip(*found, strict=True)))
            left, step = left[~now], step >> 1
        for f, t, w, m in zip(from_.tolist(), to.tolist(), who.tolist(), most.tolist(), strict=True):
            b, e, shift = kept[w]
            yield f - begin, t - f, b - begin, b - shift - int(self.first[item]), e - b, m

    def overlaps(self, hashes: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, ...]]:
        """(text, item, *stretch) of every overlap that counts."""
        found = self.diagonals(hashes, text)
        if not len(found):
            return
        edges = np.searchsorted(text, np.arange(text[-1] + 2))
        first = np.flatnonzero(np.append(True, (found[1:, :2] != found[:-1, :2]).any(1)))
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(found)], strict=True):
            t, item = found[i, :2].tolist()
            for stretch in self.stretches(hashes, int(edges[t]), int(edges[t + 1]), item, found[i:j, 2]):
                yield t, item, *stretch


#: Columns of an overlap after doc_id and item_id: the stretch of the document, and its best segment there and in the item.
COLUMNS = ("from_token", "stretch_tokens", "doc_token", "item_token", "tokens", "matching")


def overlaps(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id and COLUMNS: the overlaps of every document with every test item."""
    items = tests.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).filter("text is not null").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    kinds = {"doc_id": docs.schema[id_col].dataType, "item_id": tests.schema[item_col].dataType}
    schema = f"doc_id {kinds['doc_id'].simpleString()}, item_id {kinds['item_id'].simpleString()}, " + ", ".join(f"{c} long" for c in COLUMNS)

    def found(index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for i, j, data, offsets in text_chunks(batch, "text"):
                    w = words(data, offsets, "alnum")
                    rows = list(index.overlaps(w.hash, w.text)) if len(w.hash) else []
                    if rows:
                        t, item, *rest = (list(c) for c in zip(*rows, strict=True))
                        ids = batch.column(0).slice(i, j - i).take(pa.array(t))
                        yield pa.RecordBatch.from_arrays([ids, pa.array([index.ids[x] for x in item], item_type), *(pa.array(c, pa.int64()) for c in rest)], names=["doc_id", "item_id", *COLUMNS])

        return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema)

    results = []
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").toArrow()
        item_type = block.schema.field("item_id").type
        results.append(found(Index(block.column("item_id").to_pylist(), block.column("text").to_pylist())))
    return reduce(DataFrame.unionByName, results)


def contaminated(docs: DataFrame, tests: DataFrame, **columns: str) -> DataFrame:
    """One row per document and test item that overlap: doc_id, item_id, overlaps (stretches), tokens and matching (of the best segment)."""
    best = F.max(F.struct("matching", "tokens")).alias("best")
    return overlaps(docs, tests, **columns).groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("overlaps"), best).select("doc_id", "item_id", "overlaps", "best.tokens", "best.matching")
