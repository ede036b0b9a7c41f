"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy, with thresholds calibrated by language.

Words (letters and digits, lower case) are hashed, and so are their stems, the first STEM letters; every hash that at least LEAST_TEXTS fitted texts hold has an
embedding, the others share one. A word's embedding is the sum of its own and its stem's, so that endings that were never seen don't hide a known stem. Filters of
several widths slide over the embeddings, each takes its maximum over the whole text, and a logistic layer weighs the maxima. Overfitting to rare words
is met by leaving pooled features out at random and by averaging the logits of ROUNDS x FOLDS networks, each fitted without another fold of the
sample, which is dealt into folds ROUNDS times. A fold's rows choose the epoch of the network that hasn't seen them, and the means of their logits
by such networks set the thresholds: for each language the least sum of missed and false shares, drawn towards that of all rows, and that towards even odds. The language
is guessed from the text's own function words, never from a column; texts in a language without such a list here, or without any of the words, have the
threshold of all rows. Scores are moved so that 0.5 is the language's threshold.

Scale: fitting sees a bounded sample (at most TRAIN_ROWS different labelled texts of at most TRAIN_CHARS characters); its networks are trained in
Spark tasks, one each, from fixed seeds, so a lost one is trained again alike. Scoring is one pass without a shuffle: a filter's response is a
sum of table rows, one per word and offset, so a text of any length takes memory in proportion to its own words only, in pieces of PIECE_BYTES.

Defined results: null, empty or wordless text scores like no evidence (the bias alone); null labels are not learnt from; repeated rows
are scored each, and learnt from once; without labelled rows every score is 0; with one kind of label no threshold is set; an empty table
gives no rows; extra columns are kept, but one named like the result is replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import balanced_threshold, bounded_sample, checkpoint, map_arrow, text_chunks, with_fields
from .textops import Words, lower_latin, mix64, segment_hashes, words

BITS = 18
#: Letters of a stem, and what tells stems' hashes from words'.
STEM, STEM_SALT = 5, np.uint64(0x5354454D)
DIM, FILTERS, WIDTHS = 12, 6, (1, 2, 3)
#: Bounds of the fitting sample, and in how many of its texts a word must be to get an embedding of its own.
TRAIN_ROWS, TRAIN_CHARS = 6_000, 20_000
LEAST_TEXTS = 4
#: How often the sample is dealt into folds, and into how many; there is a network for each fold of each round.
ROUNDS, FOLDS = 2, 3
#: Most epochs, and after how many without a better one fitting ends; both last longer on few rows: STEPS steps, and STEPS / 4 without a better epoch.
EPOCHS, PATIENCE, STEPS = 12, 3, 300
#: Rows of a step; rates of the embeddings and of all else; decay of the latter.
BATCH, WORD_RATE, RATE, DECAY, SEED = 64, 0.05, 0.01, 0.1, 7
#: Bytes of text that are scored together (or read together for the fit), and kept-out texts; both bound a worker's memory, the first the driver's, too.
PIECE_BYTES, PIECE_TEXTS = 1 << 18, 128
#: Share of the pooled features that a fitting step leaves out.
DROP = 0.4
#: Frequent function words, to guess a text's language for the threshold.
FUNCTION_WORDS = {
    "de": "der die das und ist nicht ein eine zu den von mit sich auf für im dem auch als",
    "en": "the of and to in is that it was for with as on be this by are from",
    "es": "el los las y del que por con para una es en no se lo al como más",
    "fr": "le les des et est un une du que qui dans pour par sur pas avec au ce",
}
#: Texts of label 1 that even odds are worth when the threshold of all rows is set, and that one when a language's own is: few say little.
PRIOR_TEXTS = 50


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int32)


def units(data: np.ndarray, offsets: np.ndarray, stem: int = STEM) -> tuple[Words, np.ndarray]:
    """(words, buckets): a row for each word, its own bucket and that of its first `stem` letters."""
    w = words(data, offsets, "alnum")
    starts = np.flatnonzero((data & 0xC0) != 0x80)  # of code points
    first = np.searchsorted(starts, w.start)
    after = np.append(starts, len(data))[np.minimum(first + stem, len(starts))]
    length = np.minimum(after - w.start, w.length)
    begin = segment_hashes(lower_latin(data), w.start, length)
    return w, np.stack([buckets(w.hash), buckets(mix64(begin ^ STEM_SALT))], axis=1)


def _hash_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(words(data, np.array([0, len(data)]), "alnum").hash[0])


class Net:
    """One network: embeddings (the last for all unknown words), filters by width, and the logistic layer over their maxima."""

    def __init__(self, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.1, (size + 1, DIM)).astype(np.float32)
        self.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.weights = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.constant = np.zeros(1, np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.weights, self.constant]

    def tables(self, known: np.ndarray | None = None) -> list[list[np.ndarray]]:
        """Responses of every word (or of those in `known`) for each width and offset."""
        own = (self.embedding if known is None else self.embedding[known]).astype(np.float32)
        return [[own @ f[k] for k in range(len(f))] for f in self.filters]

    def logits(self, ids: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        return pooled(self.tables(), self.bias, ids, text, n)[0] @ self.weights + self.constant[0]


def pooled(tables: list[list[np.ndarray]], bias: np.ndarray, ids: np.ndarray, text: np.ndarray, n: int, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(n, widths x filters) maxima after the ramp, and with `places` the first word of each one's window; -1 where nothing is above 0."""
    size = tables[0][0].shape[1]
    best = np.zeros((n, len(tables) * size), np.float32)
    where = np.full(best.shape, -1, np.int64) if places else None
    for g, offsets in enumerate(tables):
        w = len(offsets)
        whole = len(ids) - w + 1
        inside = np.flatnonzero(text[:whole] == text[w - 1 :]) if whole > 0 else np.zeros(0, np.int64)
        if not len(inside):
            continue
        response = np.zeros((len(inside), size), np.float32)
        for k in range(w):
            for each in ids.T:
                response += offsets[k][each[inside + k]]
        first = np.flatnonzero(np.diff(text[inside], prepend=-1))
        own = text[inside[first]]
        top = np.maximum.reduceat(response, first)
        columns = slice(g * size, (g + 1) * size)
        best[own, columns] = np.maximum(top + bias[columns], 0)
        if places:
            row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(inside))))
            at, f = np.nonzero(response == top[row])
            where[own[row[at]], f + g * size] = inside[at]
    if places:
        where[best <= 0] = -1
    return best, where


def _joined(ids: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of several texts in a row, and the number of the text of each."""
    return np.concatenate([*(ids[r] for r in rows), np.zeros((0, 2), np.int32)]), np.repeat(np.arange(len(rows)), [len(ids[r]) for r in rows])


def _adam(params: list[np.ndarray], grads: list[np.ndarray], state: list, step: int) -> None:
    for p, g, (m, v) in zip(params, grads, state, strict=True):
        m *= 0.9
        m += 0.1 * g
        v *= 0.999
        v += 0.001 * g * g
        p -= RATE * (m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + DECAY * p)


def gradients(net: Net, flat: np.ndarray, text: np.ndarray, y: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the mean logistic loss over some texts: (ids of the words in them, gradient of those embeddings, gradients of all other parameters). kept: factors of the pooled features."""
    used, place = np.unique(flat, return_inverse=True)
    flat = place.reshape(flat.shape)
    embedding = net.embedding[used]
    best, where = pooled(net.tables(used), net.bias, flat, text, len(y), places=True)
    best = best * kept
    p = 1 / (1 + np.exp(-(best @ net.weights + net.constant[0])))
    d = ((p - y) / len(y)).astype(embedding.dtype)
    grads = [np.zeros_like(x) for x in net.parts()[1:]]
    grads[-1][0] = d.sum()
    grads[-2][:] = best.T @ d
    back = np.where(where >= 0, d[:, None] * net.weights * kept, 0).astype(embedding.dtype)
    grads[-3][:] = back.sum(0)
    grad = np.zeros_like(embedding)
    for g, w in enumerate(WIDTHS):
        part, place = back[:, g * FILTERS : (g + 1) * FILTERS], where[:, g * FILTERS : (g + 1) * FILTERS]
        t, f = np.nonzero(place >= 0)
        for k in range(w):
            for word in flat[place[t, f] + k].T:
                np.add.at(grads[g][k].T, f, part[t, f][:, None] * embedding[word])
                np.add.at(grad, word, part[t, f][:, None] * net.filters[g][k].T[f])
    return used, grad, grads


def train(ids: list[np.ndarray], y: np.ndarray, kept_out: np.ndarray, size: int, seed: int) -> tuple[Net, np.ndarray]:
    """A network fitted on the texts that aren't `kept_out` (on all if that leaves none), and its logits of those that are."""
    rng = np.random.default_rng(seed)
    net = Net(size, seed)
    rows = np.flatnonzero(~kept_out) if not kept_out.all() else np.arange(len(y))
    judges = np.flatnonzero(kept_out)
    dense, past = net.parts()[1:], np.full(size + 1, 1e-8, np.float32)
    state, step = [(np.zeros_like(p), np.zeros_like(p)) for p in dense], 0
    share = y[rows].mean()
    net.constant[0] = np.log((share + 1e-3) / (1 - share + 1e-3))
    lowest, waited = None, 0  # loss on the kept-out rows, parameters and logits of the best epoch; epochs since
    each = -(-len(rows) // BATCH)  # steps of an epoch
    patience = max(PATIENCE, STEPS // 4 // each)
    for _ in range(max(EPOCHS, STEPS // each)):
        rng.shuffle(rows)
        for at in range(0, len(rows), BATCH):
            own = rows[at : at + BATCH]
            flat, text = _joined(ids, own)
            kept = (rng.random((len(own), len(WIDTHS) * FILTERS)) >= DROP).astype(np.float32) / (1 - DROP)
            used, grad, grads = gradients(net, flat, text, y[own], kept)
            step += 1
            _adam(dense, grads, state, step)
            moved = np.flatnonzero(np.abs(grad).sum(1))
            past[used[moved]] += (grad[moved] ** 2).mean(1)
            net.embedding[used[moved]] -= WORD_RATE * grad[moved] / np.sqrt(past[used[moved]])[:, None]
        pieces = [judges[i : i + PIECE_TEXTS] for i in range(0, len(judges), PIECE_TEXTS)]
        tables = net.tables()
        z = np.concatenate([pooled(tables, net.bias, *_joined(ids, p), len(p))[0] @ net.weights + net.constant[0] for p in pieces] + [np.zeros(0, np.float32)])
        del tables
        loss = float(np.logaddexp(0, z * (1 - 2 * y[judges])).mean()) if len(z) else 0.0
        if lowest is None or loss <= lowest[0]:
            lowest, waited = (loss, [p.copy() for p in net.parts()], z), 0
        else:
            waited += 1
            if waited == patience:
                break
    for p, q in zip(net.parts(), lowest[1], strict=True):
        p[...] = q
    net.embedding = net.embedding.astype(np.float16)  # half the size to send and keep
    return net, lowest[2]


class Cnn:
    """Several networks as one: their tables stand side by side, and the logit is the mean of theirs."""

    def __init__(self, known: np.ndarray, nets: list[Net]):
        self.known, self.nets = known, nets  # known: sorted buckets with an embedding of their own
        self.shift: dict[int, float] = {}
        self.function = sorted((_hash_of(w), k) for k, name in enumerate(sorted(FUNCTION_WORDS)) for w in FUNCTION_WORDS[name].split())

    def ids(self, bucket: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(bucket.shape, np.int32)
        at = np.minimum(np.searchsorted(self.known, bucket), len(self.known) - 1)
        return np.where(self.known[at] == bucket, at, len(self.known)).astype(np.int32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "stacked"}  # made anew in each worker

    def logits(self, found: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """Of n texts whose words have these buckets (a row each)."""
        if "stacked" not in self.__dict__:
            tables = [[np.concatenate([net.embedding.astype(np.float32) @ net.filters[g][k] for net in self.nets], axis=1) for k in range(w)] for g, w in enumerate(WIDTHS)]
            by_width = lambda part: np.concatenate([p for g in range(len(WIDTHS)) for p in (part(net)[g * FILTERS : (g + 1) * FILTERS] for net in self.nets)])
            self.stacked = tables, by_width(lambda net: net.bias), by_width(lambda net: net.weights) / len(self.nets), np.mean([net.constant[0] for net in self.nets])
        tables, bias, weights, constant = self.stacked
        return pooled(tables, bias, self.ids(found), text, n)[0] @ weights + constant

    def languages(self, hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """Number of the language with most function words; -1 without any."""
        keys = np.array([h for h, _ in self.function], np.uint64)
        kinds = np.array([k for _, k in self.function])
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == hashes)
        counts = np.bincount(text[hit] * len(FUNCTION_WORDS) + kinds[at[hit]], minlength=n * len(FUNCTION_WORDS)).reshape(n, -1)
        return np.where(counts.sum(1) > 0, counts.argmax(1), -1)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        (w, found), n = units(data, offsets), len(offsets) - 1
        shift = np.array([*[self.shift.get(k, 0.0) for k in range(len(FUNCTION_WORDS))], self.shift.get(-1, 0.0)])
        z = self.logits(found, w.text, n) - shift[self.languages(w.hash, w.text, n)]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def calibrate(self, z: np.ndarray, y: np.ndarray, kinds: np.ndarray) -> None:
        """Thresholds from logits of rows that their network hasn't seen, their labels and their languages."""
        if y.min() == y.max():
            return
        whole = float(balanced_threshold(z, y) * y.sum() / (y.sum() + PRIOR_TEXTS))
        self.shift = {-1: whole}
        for k in range(len(FUNCTION_WORDS)):
            own = kinds == k
            ones = y[own].sum()
            t = balanced_threshold(z[own], y[own]) if 0 < ones < own.sum() else whole
            self.shift[k] = float((t * ones + whole * PRIOR_TEXTS) / (ones + PRIOR_TEXTS))


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Cnn | None:
    """From a bounded sample of different labelled texts, one Spark task for each of the networks. None without rows."""
    usable = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= chars))
    sample = bounded_sample(usable, rows, SEED)
    if not sample.num_rows:
        return None
    y = np.array(sample.column("label").to_pylist(), np.float32)
    model, held, kinds = Cnn(np.zeros(0, np.int32), []), [], []
    for batch in sample.to_batches():
        for i, j, data, offsets in text_chunks(batch, "text", PIECE_BYTES):
            w, own = units(data, offsets)
            held += np.split(own, np.searchsorted(w.text, np.arange(1, j - i)))
            kinds.append(model.languages(w.hash, w.text, j - i))
    del sample
    found, texts = np.unique(np.concatenate([*(np.unique(b) for b in held), np.zeros(0, np.int32)]), return_counts=True)
    model.known = found[texts >= LEAST_TEXTS].astype(np.int32)
    ids = [model.ids(b) for b in held]
    del held
    rng = np.random.default_rng(SEED)
    folds = np.stack([rng.permutation(len(y)) % FOLDS for _ in range(ROUNDS)])
    spark = labelled.sparkSession
    shared, size = spark.sparkContext.broadcast((ids, y, folds)), len(model.known)
    del ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for member in batch.column(0).to_pylist():
                ids, y, folds = shared.value
                net, z = train(ids, y, folds[member // FOLDS] == member % FOLDS, size, SEED + member)
                yield pa.RecordBatch.from_arrays([pa.array([member], pa.int64()), pa.array([pickle.dumps((net, z))], pa.binary())], names=["member", "made"])

    made = checkpoint(map_arrow(spark.range(0, ROUNDS * FOLDS, 1, ROUNDS * FOLDS), run, "member long, made binary"))
    z, nets = np.zeros(len(y), np.float32), {}
    for r in made.toLocalIterator():  # one at a time
        nets[r["member"]], own = pickle.loads(r["made"])
        z[folds[r["member"] // FOLDS] == r["member"] % FOLDS] += own / ROUNDS
    shared.destroy()
    model.nets = [nets[m] for m in sorted(nets)]
    model.calibrate(z, y, np.concatenate(kinds))
    return model


def scored(docs: DataFrame, model: Cnn | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with a last column `out`; one of that name is replaced."""
    docs = docs.drop(out)
    kept = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch, text_col, PIECE_BYTES):
                score = np.zeros(j - i) if model is None else model.scores(data, offsets)
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(score, pa.float64())], names=[*kept, out])

    return map_arrow(docs, run, with_fields(docs.schema, **{out: "double"}))
