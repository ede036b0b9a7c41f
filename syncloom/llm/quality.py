"""Quality: nearest-neighbour voting among labelled latent-semantic vectors.

A text's features are hashed byte trigrams (log counts, weighted by inverse document frequency over all documents). A truncated singular
value decomposition of a bounded sample of labelled rows gives the latent space, whose axes are divided by the square root of their singular values,
so that the commonest few don't drown the rest; the sample's vectors and labels are broadcast. Every document's vector is multiplied with
all of them in blocks, exactly, and the labels of the NEIGHBOURS most similar ones (and of all as similar as the last of these) are averaged with
weights that grow with the cosine. Scores are then stretched so that LEVEL is the vote which parts the labels best, as each sampled text's
vote without itself tells.

Scale: one pass for the document frequencies (a fixed number of counters per partition), one for the scores, no shuffle of texts. What is
broadcast has a fixed bound: TRAIN_ROWS x RANK floats and 2^BITS x RANK floats, about 5 MB.

Defined results: null or empty text, and text with no trigram, has no vector and votes like the sample's share of label 1; null labels are
not learnt from; repeated rows are scored each, and learnt from once; scores have six digits; without labelled rows every score is 0.5, with one
kind of label none is stretched; an empty table gives no rows; extra columns are kept, but one named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import balanced_threshold, bounded_sample, map_arrow, text_chunks, with_fields
from .textops import byte_ngrams

BITS = 12
RANK, NEIGHBOURS, SHARPNESS = 160, 200, 15.0
#: Cosines that differ by no more are ties: products of one row come out so different in different blocks.
TIE = 1e-5
#: Score from which a text counts as label 1.
LEVEL = 0.7
#: Bounds of the sample of labelled rows that is fitted and voted with.
TRAIN_ROWS, TRAIN_CHARS, SEED = 4_000, 20_000, 11
#: Documents whose cosines are computed together.
BLOCK = 512


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    grams, text = byte_ngrams(data, offsets, 3, BITS)
    n = len(offsets) - 1
    return np.bincount((text << BITS) + grams, minlength=n << BITS).reshape(n, 1 << BITS)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each hashed trigram is, over all of them, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, offsets in text_chunks(batch, "text", rows=BLOCK):
                total += (_counts(data, offsets) > 0).sum(0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], rows))], names=["gram", "docs"])

    found = map_arrow(docs.select(F.col(text_col).alias("text")), run, "gram long, docs long").groupBy("gram").agg(F.sum("docs").alias("docs")).toArrow()
    gram, count = (np.array(found.column(c)) for c in ("gram", "docs"))
    df = np.zeros(1 << BITS)
    df[gram[gram >= 0]] = count[gram >= 0]
    return df, int(count[gram < 0].sum())


class Voter:
    def __init__(self, idf: np.ndarray):
        self.idf = idf.astype(np.float32)
        self.space = np.zeros((1 << BITS, 1), np.float32)
        self.vectors = np.zeros((0, 1), np.float32)
        self.labels = np.zeros(0, np.float32)
        self.prior = 0.5
        self.cut: float | None = None  # the vote that becomes LEVEL

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32)) * self.idf
        return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)

    def projected(self, x: np.ndarray) -> np.ndarray:
        v = x @ self.space
        return v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-9)

    def votes(self, vectors: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Votes for unit vectors; `own` is the number of a labelled row that doesn't vote for each."""
        cosine = vectors @ self.vectors.T
        if own is not None:
            cosine[np.arange(len(own)), own] = -2
        k = min(NEIGHBOURS, len(self.labels) - (own is not None))
        last = np.partition(cosine, -k, axis=1)[:, -k]
        weight = np.where(cosine >= last[:, None] - TIE, np.exp(SHARPNESS * (cosine - 1)), 0)
        return weight @ self.labels / weight.sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(x), self.prior)
        vote = np.where((x * x).sum(1) > 0, self.votes(self.projected(x)), self.prior).astype(np.float64)
        if self.cut is not None:
            vote = np.where(vote < self.cut, vote / self.cut * LEVEL, LEVEL + (vote - self.cut) / (1 - self.cut) * (1 - LEVEL))
        return np.round(np.clip(vote, 0, 1), 6)

    def calibrate(self) -> None:
        """The cut from the labelled rows' votes for each other."""
        if len(self.labels) < 2 or self.labels.min() == self.labels.max():
            return
        rows = np.arange(len(self.labels))
        votes = np.concatenate([self.votes(self.vectors[i : i + BLOCK], rows[i : i + BLOCK]) for i in range(0, len(rows), BLOCK)])
        cut = balanced_threshold(votes.astype(np.float64), self.labels)
        self.cut = min(max(cut, 1e-6), 1 - 1e-6)


def fit(docs: DataFrame, labelled: DataFrame, text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Voter:
    """Document frequencies from all of docs; space and voters from a bounded sample of different labelled texts, picked by their hash."""
    df, n = document_frequencies(docs, text_col)
    voter = Voter(np.log((1 + n) / (1 + df)) + 0.1)
    usable = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isNotNull() & F.length("text").between(1, chars))
    sample = bounded_sample(usable, rows, SEED)
    if not sample.num_rows:
        return voter
    x = np.concatenate([voter.weighted(_counts(data, offsets)) for batch in sample.to_batches() for _, _, data, offsets in text_chunks(batch, "text", rows=BLOCK)])
    rank = min(RANK, *x.shape)
    rng = np.random.default_rng(SEED)
    basis, _ = np.linalg.qr(x @ (x.T @ (x @ rng.normal(size=(x.shape[1], rank + 8)).astype(np.float32))))  # randomised range finder with a power step
    _, size, vt = np.linalg.svd(basis.T @ x, full_matrices=False)
    voter.space = np.ascontiguousarray((vt[:rank] / np.sqrt(np.maximum(size[:rank], 1e-6 * size[0] + 1e-9))[:, None]).T.astype(np.float32))
    voter.vectors = voter.projected(x)
    voter.labels = np.array(sample.column("label").to_pylist(), np.float32)
    voter.prior = float(voter.labels.mean())
    voter.calibrate()
    return voter


def scored(docs: DataFrame, voter: Voter, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with a last column `out`, the weighted share of label 1 among the nearest labelled texts; one of that name is replaced."""
    docs = docs.drop(out)
    kept = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(voter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voter = shared.value
        for batch in batches:
            score = [voter.scores(voter.weighted(_counts(data, offsets))) for _, _, data, offsets in text_chunks(batch, text_col, rows=BLOCK)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*score, np.zeros(0)]).astype(np.float64))], names=[*kept, out])

    return map_arrow(docs, run, with_fields(docs.schema, **{out: "double"}))
