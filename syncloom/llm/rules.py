"""Quality rules by an isolation forest on rule statistics.

`statistics` counts, in one pass over the texts, what quality rules are made of: words, symbols, repeated lines and windows, capitals, marks. An
isolation forest is trees of random splits: a document whose statistics are unusual is alone after few of them, so a short mean path is an anomaly.
The path is turned into a score from 0 to 1 (1: most anomalous), and the score from which documents are dropped is set by the labels. A document also
fails by two plain rules: fewer than MIN_WORDS words, or more than MOST_REPEATED percent of its words in repeated windows.

Scale: one map over the texts, no shuffle; statistics are some hundred bytes a document and are written once. The trees are grown from
TREES * SAMPLE / 4 labelled rows at most (drawn by a hash; copies of a row's statistics count once); the threshold is set by a histogram of the scores
of all labelled rows, whose bins are bounded, whatever their number.

Defined results: null and empty texts have no words, score like any other row and fail by the first rule; equal texts have equal statistics and
scores; windows and lines are compared by 64-bit hashes; without labelled rows of both kinds the threshold is 1, so that only the plain rules
drop; an empty table gives no rows; extra columns are kept, but those named like the results are replaced, and the text is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_chunks, with_fields
from .textops import mix64, segment_hashes, words

#: Words of a window; the plain rules' fewest words and most percent of words in repeated windows.
WINDOW, MIN_WORDS, MOST_REPEATED = 8, 20, 30
#: Trees, rows a tree, the depth at which splitting ends (log2 of the rows).
TREES, SAMPLE, DEPTH = 200, 256, 8
#: A dropped clean row weighs as much as so many junk rows that are kept; bins of a score.
CLEAN_WEIGHT, BINS = 10.0, 4_096
#: Characters that count as symbols (fixed by the rule).
SYMBOLS = "#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_top")


def _table(characters: str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(characters.encode())] = True
    return found


_ASCII = "".join(map(chr, range(33, 127)))
_SYMBOL, _UPPER, _MARK = _table(SYMBOLS), _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("".join(c for c in _ASCII if not c.isalnum()))
_SPACE = _table(" \t\n\v\f\r")


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags set between successive offsets."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each entry: whether another of its text has its key, and whether an earlier one has."""
    both = mix64(key ^ mix64(text.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = both[order[1:]] == both[order[:-1]]
    shared, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    later[order[1:]] = same
    return shared, later


def count_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text (UTF-8 bytes and offsets)."""
    n = len(offsets) - 1
    w = words(data, offsets, fold=False)
    text, size = w.text, len(w.text)
    counts = np.bincount(text, minlength=n)
    per = lambda flags: np.bincount(text[flags], minlength=n)
    starts = (data & 0xC0) != 0x80  # of code points

    repeated = np.zeros(size, bool)
    whole = size - WINDOW + 1
    if whole > 0:
        value = np.zeros(whole, np.uint64)
        for j in range(WINDOW):
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + w.hash[j : j + whole])
        first = np.flatnonzero(text[:whole] == text[WINDOW - 1 :])
        shared, _ = _repeats(text[first], value[first])
        edge = np.zeros(size + 1, np.int64)
        np.add.at(edge, first[shared], 1)
        np.add.at(edge, first[shared] + WINDOW, -1)
        repeated = np.cumsum(edge[:-1]) > 0

    ends = np.flatnonzero(data == 0x0A)
    line_start = np.unique(np.concatenate([offsets[:-1], ends + 1]))
    line_start = line_start[line_start < len(data)]
    line_text = np.searchsorted(offsets, line_start, side="right") - 1
    line_end = np.minimum(np.append(ends, len(data))[np.searchsorted(ends, line_start)], offsets[line_text + 1])
    told = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    line_start, line_end, line_text = line_start[told], line_end[told], line_text[told]
    _, later = _repeats(line_text, segment_hashes(data, line_start, line_end - line_start))

    both = mix64(w.hash ^ mix64(text.astype(np.uint64)))
    _, at, times = np.unique(both, return_index=True, return_counts=True)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text[at], times)
    return np.stack([
        counts, _sums(starts & ~_SPACE[data], offsets), _sums(_SYMBOL[data], offsets), np.bincount(line_text[later], minlength=n), per(repeated), np.bincount(line_text, minlength=n),
        _sums(_UPPER[data], offsets), _sums(_MARK[data], offsets), top,
    ], axis=1).astype(np.int64)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the text, with STATISTICS (long)."""
    docs = docs.drop(*[c for c in STATISTICS if c != text_col])
    kept = [c for c in docs.columns if c != text_col]
    schema = with_fields(docs.select(*[f"`{c}`" for c in kept]).schema, **dict.fromkeys(STATISTICS, "long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select(kept) if kept else None
            for i, j, data, offsets in text_chunks(batch, text_col):
                found = count_statistics(data, offsets)
                own = rest.slice(i, j - i).columns if kept else []
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(c) for c in found.T]], names=[*kept, *STATISTICS])

    return map_arrow(docs, run, schema)


def features(s: np.ndarray) -> np.ndarray:
    """Letters a word, and the shares of symbols, words in repeated windows, capitals, marks and the commonest word, from rows of STATISTICS.

    Shares are drawn to 0 in short texts, where one name in capitals or one repeated word is a large part.
    """
    v = dict(zip(STATISTICS, s.T.astype(np.float64), strict=True))
    n, chars = v["n_words"] + 20, v["word_chars"] + 200
    return np.stack([(v["word_chars"] + 100) / n, np.minimum(1, v["n_symbols"] / n), v["n_repeat_words"] / n, v["n_upper"] / chars, np.minimum(2, v["n_marks"] / n), v["n_top"] / n], axis=1)


class Forest(NamedTuple):
    """Trees as arrays of (tree, node): the feature split on (-1: leaf), the value, and a leaf's path length; node i has the children 2i+1, 2i+2."""

    feature: np.ndarray
    value: np.ndarray
    path: np.ndarray
    norm: float


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path of a search that fails in a random tree of n points: what is left below a leaf of n."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), (n == 2) * 1.0)


def grow(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 0) -> Forest:
    """An isolation forest over the rows of x, each tree over `sample` of them."""
    rng, size = np.random.default_rng(seed), 2 ** (DEPTH + 1) - 1
    feature, value, path = np.full((trees, size), -1, np.int16), np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        todo = [(0, x[rng.choice(len(x), min(sample, len(x)), replace=False)], 0)]
        while todo:
            node, rows, depth = todo.pop()
            low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
            open_ = np.flatnonzero(high > low)
            if depth == DEPTH or not len(open_):
                path[t, node] = depth + _mean_path(len(rows))
                continue
            k = int(rng.choice(open_))
            cut = rng.uniform(low[k], high[k])
            feature[t, node], value[t, node] = k, cut
            left = rows[:, k] <= cut
            todo += [(2 * node + 1, rows[left], depth + 1), (2 * node + 2, rows[~left], depth + 1)]
    return Forest(feature, value, path, float(_mean_path(min(sample, max(2, len(x))))))


def path_scores(forest: Forest, x: np.ndarray) -> np.ndarray:
    """2^(-mean path / norm) of each row of x."""
    trees, total = np.arange(len(forest.feature)), np.zeros(len(x))
    for begin in range(0, len(x), 1024):
        part = x[begin : begin + 1024]
        rows, node = np.arange(len(part))[:, None], np.zeros((len(part), len(trees)), np.int64)
        for _ in range(DEPTH):
            k = forest.feature[trees, node]
            node = np.where(k >= 0, 2 * node + 1 + (part[rows, np.maximum(k, 0)] > forest.value[trees, node]), node)
        total[begin : begin + 1024] = forest.path[trees, node].mean(1)
    return 2.0 ** (-total / forest.norm)


def fit(rows: DataFrame, seed: int = 0) -> Forest | None:
    """A forest over at most TREES * SAMPLE / 4 different rows of statistics, drawn by a hash; their labels aren't looked at. None without any."""
    place = F.xxhash64(F.lit(seed), *STATISTICS)
    drawn = rows.select(*STATISTICS).distinct().orderBy(place, *STATISTICS).limit(TREES * SAMPLE // 4).toArrow()
    if not drawn.num_rows:
        return None
    return grow(features(np.stack([c.to_numpy() for c in drawn.columns], axis=1)), seed=seed)


def scored(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """stats with anomaly, the score of the forest (0 without one)."""
    stats = stats.drop("anomaly")
    if forest is None:
        return stats.withColumn("anomaly", F.lit(0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS], axis=1))
            yield batch.append_column("anomaly", pa.array(path_scores(forest, x)))

    return map_arrow(stats, run, with_fields(stats.schema, anomaly="double"))


def threshold(found: DataFrame) -> float:
    """The score from which to drop, by all rows (anomaly, label): the least CLEAN_WEIGHT x share of clean rows dropped + share of junk kept; 1 if a kind is missing.

    At most BINS rows come to the driver.
    """
    bin_ = F.floor(F.col("anomaly") * BINS).cast("int")
    rows = found.filter("label is not null").groupBy(bin_.alias("bin")).agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("clean"), F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("junk")).orderBy("bin").collect()
    clean, junk = np.array([r["clean"] for r in rows], float), np.array([r["junk"] for r in rows], float)
    if not len(rows) or not clean.sum() or not junk.sum():
        return 1.0
    cost = CLEAN_WEIGHT * (1 - np.append(0, np.cumsum(clean)) / clean.sum()) + np.append(0, np.cumsum(junk)) / junk.sum()
    at = len(cost) - 1 - int(np.argmin(cost[::-1]))  # of equal costs, the one that drops least
    return 1.0 if at == len(rows) else rows[at]["bin"] / BINS


def judged(found: DataFrame, level: float) -> DataFrame:
    """found (statistics and anomaly) with base_failed and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("anomaly") < level))
