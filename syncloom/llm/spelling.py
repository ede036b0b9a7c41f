"""Spelling variants by blocked Gram matrices: words that differ by one inserted, deleted or replaced code point.

A word is a vector of letter counts. One edit changes two counts by one at most, so two words that are one edit apart have a squared distance of 1 or 2
and lengths that are equal or adjacent. A block holds the words of one length and those one longer; |x|^2 + |y|^2 - 2 x.y over a block is a matrix product, and pairs
at a distance of at most two are verified letter by letter.

A length has too many words for one matrix, so its blocks are cut by counts again: the alphabet is dealt into PARTS parts, and since at most two counts differ,
words one edit apart have equal counts in at least one part. A word therefore goes to one block for each part, by a hash of its counts there, with
as many blocks a length as give BLOCK words on average: the products' work grows with the number of words, not with its square. What still is large
in a block (equal counts) is cut into tiles of TILE words, each pair of tiles a task of its own. A pair that shares several parts is kept in the first only.

Scale: words are counted with map-side combining; everything after is a table of distinct words. No group is larger than two tiles.
Following forms to the last is pointer doubling by joins: the counts of forms at least double, so few rounds are needed.

Defined results: a null text has no words; a null id counts as no characters before the colon; equal rows count each; words are compared by code points as they are
(only A-Z were lowered); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, forget, join_checked, map_arrow, send_package, with_fields, written

#: Fixed by the contract: the runs, the share of occurrences that lose a letter, the fewest letters and occurrences of a word, how much more frequent a form is.
RUN, SLIP, LETTERS, OCCURRENCES, RATIO = r"[A-Za-zÀ-ÿ]+", 97, 5, 3, 2
#: Parts of the alphabet (more than the two counts that an edit changes), words of a block on average, words of a tile, code points of a tile.
PARTS, BLOCK, TILE, TILE_LETTERS = 3, 256, 2_048, 1 << 20


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n) of the runs of letters in all texts, A-Z lowered; every run whose hash SLIP divides has lost one code point."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    low = runs.select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", ASCII_UPPER, ASCII_LOWER)).otherwise(F.col("run")).alias("run"))
    h = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = h.select(F.when(F.col("h") % SLIP == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= occurrences)


def alphabet_parts(words: DataFrame) -> list[str]:
    """The letters of all words in PARTS parts of about the same weight: dealt out by how many words hold them. One row a letter is on the driver."""
    letters = words.select(F.explode(F.array_distinct(F.filter(F.split("word", ""), lambda c: c != ""))).alias("c")).groupBy("c").count()
    ranked = [r["c"] for r in letters.orderBy(F.desc("count"), "c").collect()]
    order = [i if (turn // PARTS) % 2 == 0 else PARTS - 1 - i for turn in range(0, len(ranked), PARTS) for i in range(PARTS)]
    return ["".join(c for c, p in zip(ranked, order, strict=False) if p == part) for part in range(PARTS)]


def blocked(words: DataFrame, parts: list[str]) -> DataFrame:
    """word, n, and for every block that it is in: size (its shorter length), part, block, left (it has the shorter length).

    `block` hashes the sorted letters of the word that belong to the part.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = [str.maketrans({ord(c): None for q, other in enumerate(parts) if q != p for c in other}) for p in range(PARTS)]
        for batch in batches:
            texts = batch.column("word").to_pylist()
            keys = [pa.array(["".join(sorted(w.translate(k))) for w in texts], pa.string()) for k in keep]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(w) for w in texts], pa.int64()), *keys], names=[*batch.schema.names, "length", *names])

    names = [f"k{p}" for p in range(PARTS)]
    keyed = written(map_arrow(words, own, with_fields(words.schema, length="long", **dict.fromkeys(names, "string"))), "spelling_keys")
    sizes = keyed.groupBy("length").count().select(F.col("length").alias("size"), F.greatest(F.lit(1), F.ceil(F.col("count") / BLOCK)).alias("blocks"))
    each = keyed.select("word", "n", "length", F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.xxhash64(f"k{p}").alias("h")) for p in range(PARTS)])).alias("k"))
    roles = each.select("word", "n", "k.part", "k.h", F.explode(F.array(F.struct(F.col("length").alias("size"), F.lit(True).alias("left")), F.struct((F.col("length") - 1).alias("size"), F.lit(False).alias("left")))).alias("r"))
    return join_checked(roles.select("word", "n", "part", "h", "r.*"), sizes, "size").select("word", "n", "size", "part", "left", F.pmod("h", "blocks").alias("block"))


def tiled(rows: DataFrame) -> DataFrame:
    """Rows of `blocked` with the tasks they go to (i, j): the left words of tile i against all words of tile j. as_left and as_right tell a row's role."""
    counts = rows.groupBy("size", "part", "block").agg(F.count(F.when(F.col("left"), 1)).alias("lefts"), F.count(F.lit(1)).alias("all"))
    most = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_LETTERS) / F.col("size"))))
    counts = counts.select("size", "part", "block", F.ceil(F.col("lefts") / most).alias("ti"), F.ceil(F.col("all") / most).alias("tj")).filter("ti > 0")
    both = join_checked(rows, counts, ["size", "part", "block"])
    i, j = (F.pmod(F.xxhash64(F.lit(salt), "word"), F.col(t)).alias(name) for salt, t, name in ((1, "ti", "own_i"), (2, "tj", "own_j")))
    both = both.select("word", "n", "left", "size", "part", "block", "ti", "tj", i, j)
    right = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("ti") - 1), lambda x: F.struct(x.alias("i"), F.col("own_j").alias("j"), (F.col("left") & (x == F.col("own_i"))).alias("as_left"), F.lit(True).alias("as_right")))
    other = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("tj") - 1), lambda x: F.col("left") & (x != F.col("own_j")))
    left = F.transform(other, lambda x: F.struct(F.col("own_i").alias("i"), x.alias("j"), F.lit(True).alias("as_left"), F.lit(False).alias("as_right")))
    return both.select("word", "n", "size", "part", "block", F.explode(F.concat(right, left)).alias("t")).select("word", "n", "size", "part", "block", "t.*")


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, a row each, zeros after the end."""
    return np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), width)


def close_pairs(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) one edit apart, where left words have one length and right words that or one more. Pairs of equal length come as left < right."""
    none = np.zeros(0, np.int64)
    if not left or not right:
        return none, none
    size = len(left[0])
    longer = np.array([len(w) > size for w in right])
    a, b = _codes(left, size + 1), _codes(right, size + 1)
    letters = np.unique(np.concatenate([a.ravel(), b.ravel()]))
    letters = letters[letters > 0]
    kind = np.float32 if size <= 2_048 else np.float64  # counts' products must be exact
    x, y = (_letter_counts(m, letters, kind) for m in (a, b))
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero((distance <= 2) & (distance >= 1))  # an edit changes the counts
    p, q, more = a[i], b[j], longer[j]
    same = p == q
    once = ~more & ((~same[:, :size]).sum(1) == 1)
    before = np.where(same.all(1), size + 1, same.argmin(1))  # letters at the beginning that agree
    after = p[:, :size] == q[:, 1:]
    behind = np.where(after.all(1), size, after[:, ::-1].argmin(1))
    found = once | (more & (before + behind >= size))
    i, j, more = i[found], j[found], more[found]
    keep = more | np.fromiter((left[m] < right[n] for m, n in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))
    return i[keep], j[keep]


def _letter_counts(codes: np.ndarray, letters: np.ndarray, kind: type) -> np.ndarray:
    row, at = np.nonzero(codes)
    place = np.searchsorted(letters, codes[row, at])
    return np.bincount(row * len(letters) + place, minlength=len(codes) * len(letters)).reshape(len(codes), len(letters)).astype(kind)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) for every two words (word, n) that are one edit apart."""
    send_package(words)
    parts = alphabet_parts(words)
    part_of = {c: p for p, part in enumerate(parts) for c in part}

    def pairs(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        l, r = table.filter(table.column("as_left")), table.filter(table.column("as_right"))
        a, b = l.column("word").to_pylist(), r.column("word").to_pylist()
        i, j = close_pairs(a, b)
        if len(i):  # found in the first part with equal counts only; equal hashes may bring it here, too
            first = np.fromiter((_first_equal(a[m], b[k], part_of) == part for m, k in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))
            i, j = i[first], j[first]
        l, r = l.take(pa.array(i)), r.take(pa.array(j))
        return pa.table([l.column("word"), l.column("n"), r.column("word"), r.column("n")], names=["a", "a_n", "b", "b_n"])

    tasks = tiled(blocked(words, parts))
    return tasks.groupBy("size", "part", "block", "i", "j").applyInArrow(pairs, "a string, a_n long, b string, b_n long")


def _first_equal(a: str, b: str, part_of: dict[str, int]) -> int:
    """The first part of the alphabet in which two words one edit apart have equal counts."""
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    changed = {part_of[b[k]]} | ({part_of[a[k]]} if len(a) == len(b) else set())
    return min(set(range(PARTS)) - changed)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms are followed to the last, two steps become one in every round."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling_roots")
        forget(now)
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        now = step


def variants(words: DataFrame) -> DataFrame:
    """For every word (word, n): form, its most frequent near word (ties: the smallest) if that has RATIO times its occurrences; root, where forms end; n_near; form_n."""
    words = written(words, "spelling_words")
    found = written(near_pairs(words), "spelling_pairs")
    both = found.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(found.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    fits = -F.col("best.less") >= F.col("n") * RATIO
    joined = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"))
    joined = written(joined, "spelling_forms")
    last = roots(joined.filter("form is not null"))
    return joined.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


__all__ = ["word_counts", "alphabet_parts", "blocked", "tiled", "close_pairs", "near_pairs", "roots", "variants"]
