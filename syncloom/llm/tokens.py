"""Exact token counts of every prefix by dynamic programming over a public BPE vocabulary.

A tokenizer's own normaliser and pre-tokeniser split a text into pieces that are encoded apart. Within a piece, the encoding of each prefix is
one token longer than the encoding of a shorter one: token t may follow token s exactly if encoding the two spellings together gives s
and t again, and for every prefix just one last token fits so. One pass over a piece thus stores the count of each of its prefixes; running
sums over pieces give the count of every prefix of the text. `prefix_table` stores them, one number a code point, and questions about
truncation and budgets (`tokens_of_prefix`, `longest_within`) are look-ups in that column with Spark's array functions: nothing is encoded again.

Scale: no shuffle; texts stream through Arrow batches. Runs between white space are hashed vectorised and counted once a batch; their counts are
kept in a table of CACHE_WORDS runs a worker, which starts afresh when full, so that memory is bounded and every text is counted. The stored
table takes four bytes a code point before compression; `counted` doesn't make it.

Defined results: null text is empty and has 0 tokens; special strings inside a text are single tokens, as the library has it; a run of any
length is one piece for the library, too; repeated rows are counted each; an empty table gives no rows; extra columns are kept, but
those named like the results are replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import map_arrow, text_bytes, text_chunks, with_fields
from .textops import words

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2_048
#: Runs whose counts a worker remembers; pairs of tokens whose fit it remembers.
CACHE_WORDS, CACHE_PAIRS = 1_000_000, 500_000


class PrefixCounter:
    """Counts the tokens of prefixes for a BPE vocabulary file, with or without an end-of-word suffix."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocabulary: dict[str, int] = model["vocab"]
        self.rank = dict.fromkeys(vocabulary.values(), -1)  # of the merge that makes a token; -1 for the letters
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[int, int] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = (vocabulary[x] for x in (m if isinstance(m, list) else m.split(" ")))
            self.merge[a << 24 | b] = rank
            made = vocabulary["".join(m if isinstance(m, list) else m.split(" "))]
            if made not in self.parts:
                self.rank[made], self.parts[made] = rank, (a, b)
        closed = {t: i for t, i in vocabulary.items() if self.suffix and t.endswith(self.suffix)}
        self.open = {t: i for t, i in vocabulary.items() if t not in closed}
        self.closed = {t[: -len(self.suffix)]: i for t, i in closed.items()} if self.suffix else self.open
        self.longest_open, self.longest_closed = max(map(len, self.open)), max(map(len, self.closed))
        self.longest = max(self.longest_open, self.longest_closed)
        self.reach_open, self.reach_closed = _reach(self.open), _reach(self.closed)
        self.special = [t["content"] for t in spec["added_tokens"]]
        #: What the vocabulary's own pattern comes to on ASCII without white space, where the normaliser only lowers case.
        self.plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+") if Path(path).name == VOCABULARY else None
        self.fits: dict[int, bool] = {}
        self.sizes: dict[str, int] = {}
        self.normals: dict[str, str] = {}
        self.spelt: dict[str, tuple[str, str]] = {}
        self._piece, self._last, self._count = "", [-1], [0]

    def fit(self, a: int, b: int) -> bool:
        """Whether spelling a then b is encoded as a, b again.

        The merges of both are undone, latest first (of the same rank, the right one: merging goes from the left). A pair across the seam
        whose merge comes before the one just undone would have been merged instead.
        """
        key = a << 24 | b
        found = self.fits.get(key)
        if found is not None:
            return found
        rank, limit = self.rank, 1 << 60
        while True:
            if self.merge.get(a << 24 | b, 1 << 60) < limit:
                found = False
                break
            if rank[a] > rank[b]:
                limit, a = rank[a], self.parts[a][1]
            elif rank[b] >= 0:
                limit, b = rank[b] + 1, self.parts[b][0]
            else:
                found = True
                break
        if len(self.fits) >= CACHE_PAIRS:
            self.fits.clear()
        self.fits[key] = found
        return found

    def _step(self, piece: str, end: int, tokens: dict[str, int], longest: int) -> tuple[int, int]:
        """The one token that may end piece[:end] after the tokens of the shorter prefixes, and the count with it."""
        last, count = self._last, self._count
        for start in range(max(0, end - longest), end):
            token = tokens.get(piece[start:end])
            if token is not None and (start == 0 or self.fit(last[start], token)):
                return token, count[start] + 1
        raise ValueError(f"no token ends {piece[:end]!r}")

    def _extend(self, piece: str, end: int) -> None:
        """States of the prefixes of piece[:end]; those shared with the piece before are kept."""
        old, n = self._piece, 0
        most = min(len(old), end, len(self._last) - 1)
        while n < most and old[n] == piece[n]:
            n += 1
        last, count = self._last, self._count
        del last[n + 1 :], count[n + 1 :]
        self._piece = piece
        for at in range(n + 1, end + 1):
            token, total = self._step(piece, at, self.open, self.longest_open)
            last.append(token)
            count.append(total)

    def piece_counts(self, piece: str) -> list[int]:
        """Tokens of every non-empty prefix of a pre-tokenised piece, as a piece of its own."""
        self._extend(piece, len(piece))
        return [self._step(piece, at, self.closed, self.longest_closed)[1] for at in range(1, len(piece) + 1)] if self.suffix else self._count[1:]

    def piece_count(self, piece: str) -> int:
        """Tokens of a whole piece: the last entry of piece_counts, without closing the other prefixes."""
        found = self.sizes.get(piece)
        if found is None:
            if self.suffix:
                self._extend(piece, len(piece) - 1)
                found = self._step(piece, len(piece), self.closed, self.longest_closed)[1]
            else:
                self._extend(piece, len(piece))
                found = self._count[-1]
            if len(self.sizes) >= CACHE_WORDS:
                self.sizes.clear()
            self.sizes[piece] = found
        return found

    def pieces(self, text: str) -> list[str]:
        if self.plain is not None and text.isascii() and text.isprintable():
            return self.plain.findall(text.lower())
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def letters_of(self, c: str) -> tuple[str, str]:
        """(kind of a normalised character: L letter, N digit, O other, or a space; its letters in the vocabulary)."""
        found = self.spelt.get(c)
        if found is None:
            letters = "".join(p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(c))
            kind = unicodedata.category(c)[0]
            found = self.spelt[c] = (" " if not letters else kind if kind in "LN" else "O", letters)
        return found

    def run_count(self, run: str) -> int:
        """Tokens of a run without white space; special strings in it are one token each."""
        total, at = 0, 0
        while True:
            hits = [(run.find(s, at), -len(s)) for s in self.special if run.find(s, at) >= 0] if "<" in run else []
            end, size = min(hits, default=(len(run), 0))
            total += sum(map(self.piece_count, self.pieces(run[at:end])))
            if not hits:
                return total
            total, at = total + 1, end - size

    def _plain_counts(self, text: str) -> list[int]:
        """Tokens of every non-empty prefix of a text without ASCII white space and special strings."""
        if self.plain is None:
            return self._recounted(text)
        out, stream = [], _Stream(self)
        for begin, end in clusters(text):
            for at in range(begin + 1, end):  # a prefix that ends inside what the normaliser composes
                out.append(stream.glimpse(self._normal(text[begin:at])))
            stream.feed(self._normal(text[begin:end]))
            out.append(stream.tokens())
        return out

    def _recounted(self, text: str) -> list[int]:
        """The same by counting each prefix anew: exact for any vocabulary, but quadratic."""
        return [sum(map(self.piece_count, self.pieces(text[:j]))) for j in range(1, len(text) + 1)]

    def _normal(self, part: str) -> str:
        """What the normaliser makes of a cluster; single characters are remembered."""
        if len(part) > 1:
            return self.library.normalizer.normalize_str(part)
        found = self.normals.get(part)
        if found is None:
            found = self.normals[part] = self.library.normalizer.normalize_str(part)
        return found

    def run_counts(self, run: str) -> list[int]:
        """Tokens of every non-empty prefix of a run without white space; its last entry is run_count (checked: else each prefix is counted anew)."""
        out = self._run_counts(run)
        if out[-1] != self.run_count(run):  # other tables of characters than the library's
            out = [self.run_count(run[:j]) for j in range(1, len(run) + 1)]
        return out

    def _run_counts(self, run: str) -> list[int]:
        out: list[int] = []
        at = 0
        while True:
            hits = [(run.find(s, at), -len(s)) for s in self.special if run.find(s, at) >= 0] if "<" in run else []
            end, size = min(hits, default=(len(run), 0))
            before = out[-1] if out else 0
            out += [before + n for n in self._plain_counts(run[at:end])]
            if not hits:
                return out
            out += [before + sum(map(self.piece_count, self.pieces(run[at:j]))) for j in range(end + 1, end - size)]  # a special string that isn't whole
            out.append(before + sum(map(self.piece_count, self.pieces(run[at:end]))) + 1)
            at = end - size


#: Fixed by the vocabulary's pattern: apostrophe endings that are pieces of their own.
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Letters that may join a letter before them though their combining class is 0: Hangul vowels and finals; others are found by `_joining`.
_HANGUL = (range(0x1161, 0x1176), range(0x11A8, 0x11C3))


@cache
def _joining() -> frozenset[str]:
    """Characters of combining class 0 that a canonical composition takes as its second part."""
    found = {chr(c) for r in _HANGUL for c in r}
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.combining(second := chr(int(parts[1], 16))) == 0:
            found.add(second)
    return frozenset(found)


def clusters(text: str) -> list[tuple[int, int]]:
    """Begin and end of stretches that are composed apart: a character and what may join it."""
    begins = [i for i, c in enumerate(text) if i == 0 or c < "\u0300" or not (unicodedata.combining(c) or c in _joining())]
    return list(zip(begins, [*begins[1:], len(text)], strict=False))  # none of an empty text


def _reach(tokens: dict[str, int]) -> dict[str, int]:
    """The longest token for each two letters at its end."""
    out: dict[str, int] = {}
    for t in tokens:
        out[t[-2:]] = max(len(t), out.get(t[-2:], 0))
    return out


class _Stream:
    """Pieces and their tokens as characters come one by one: letters together, each digit alone, other marks together, endings such as 's alone.

    Holds the dynamic programme's states of the piece under way. What was fed can be taken back as long as no other character has been kept.
    """

    def __init__(self, counter: PrefixCounter):
        self.counter = counter
        self.total, self.kind, self.quoted = 0, "", None  # tokens of closed pieces; kind of the open one; tokens before an apostrophe that may begin an ending
        self.text, self.last, self.count = "", [-1], [0]  # the open piece's last letters and states
        self.size = 0

    def tokens(self) -> int:
        return self.total + self._closed()

    def feed(self, characters: str) -> None:
        for c in characters:
            self._add(c)

    def glimpse(self, characters: str) -> int:
        """Tokens with these characters, which aren't kept."""
        kept = self.__dict__.copy()
        self.feed(characters)
        found = self.tokens()
        self.__dict__.update(kept)
        del self.last[self.size + 1 :], self.count[self.size + 1 :]
        return found

    def _open(self) -> None:
        self.total += self._closed()
        self.text, self.last, self.count, self.size = "", [-1], [0], 0

    def _add(self, c: str) -> None:
        kind, letters = self.counter.letters_of(c)
        if self.quoted is not None:
            before, said = self.quoted
            said += c
            self.quoted = (before, said) if any(e.startswith(said) and e != said for e in ENDINGS) else None
            if said in ENDINGS:
                self.total, self.kind = before + self.counter.piece_count(said), "ending"
                self.text, self.last, self.count, self.size, self.quoted = "", [-1], [0], 0, None
                return
        if kind == " ":
            self._open()
            self.kind = ""
            return
        if kind != self.kind or kind == "N":
            self._open()
            self.kind = kind
            if c == "'":
                self.quoted = (self.total, c)
        for letter in letters:
            self._extend(letter)

    def _extend(self, letter: str) -> None:
        n, k = self.counter, self.size + 1
        self.text = (self.text + letter)[-n.longest :]
        token, total = self._fitting(n.open, n.reach_open, k)
        self.last.append(token)
        self.count.append(total)
        self.size = k

    def _closed(self) -> int:
        if not self.size:
            return 0
        n = self.counter
        return self._fitting(n.closed, n.reach_closed, self.size)[1] if n.suffix else self.count[-1]

    def _fitting(self, tokens: dict[str, int], reach: dict[str, int], end: int) -> tuple[int, int]:
        """The one token that may end the open piece's first `end` letters (they are the last that came), and the count with it."""
        text = self.text
        for k in range(1, min(len(text), reach.get(text[-2:], 1)) + 1):
            token = tokens.get(text[-k:])
            if token is not None and (k == end or self.counter.fit(self.last[end - k], token)):
                return token, self.count[end - k] + 1
        raise ValueError(f"no token ends {text!r}")


class _Runs:
    """Counts of runs by their 64-bit hash, in a worker, and the counter that finds new ones."""

    def __init__(self, path: str):
        self.counter = PrefixCounter(path)
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def of(self, hashes: np.ndarray, start: np.ndarray, length: np.ndarray, raw: bytes) -> np.ndarray:
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        counts = np.zeros(len(distinct), np.int64)
        counts[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            runs = sorted((raw[s : s + n].decode(), k) for s, n, k in zip(start[first[new]].tolist(), length[first[new]].tolist(), new.tolist(), strict=True))
            for run, k in runs:  # in order, so that successive ones share prefixes
                counts[k] = self.counter.run_count(run)
            if len(self.keys) + len(new) > CACHE_WORDS:
                self.keys, self.counts = distinct, counts
            else:
                self.keys = np.insert(self.keys, at[new], distinct[new])
                self.counts = np.insert(self.counts, at[new], counts[new])
        return counts[back]


_WORKER: dict[str, _Runs] = {}


def counted(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, budget: int = LIMIT) -> DataFrame:
    """docs with n_bytes, n_tokens and truncate_chars, the code points of the longest prefix of at most `budget` tokens; columns of these names are replaced.

    Sums over runs tell in which run a text passes the budget; the stored counts of that run's prefixes tell where. (A later run's prefixes have more tokens than it.)
    """
    docs = docs.drop("n_bytes", "n_tokens", "truncate_chars")
    kept = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = public_tokenizers.path(vocabulary)
        if path not in _WORKER:
            _WORKER[path] = _Runs(path)
        runs = _WORKER[path]
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch, text_col):
                w = words(data, offsets, fold=False)
                each = runs.of(w.hash, w.start, w.length, data.tobytes()) if len(w.hash) else np.zeros(0, np.int64)
                total = np.bincount(w.text, weights=each, minlength=j - i).astype(np.int64)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                fits = chars[offsets[1:]] - chars[offsets[:-1]]
                sums = np.cumsum(each)
                for k in np.flatnonzero(total > budget):
                    first = int(np.searchsorted(w.text, k))
                    before = int(sums[first] - each[first])
                    at = int(np.searchsorted(sums, before + budget, side="right"))  # the run in which the text passes the budget
                    own = runs.counter.run_counts(data[w.start[at] : w.start[at] + w.length[at]].tobytes().decode())
                    left = budget - (int(sums[at] - each[at]) - before)
                    fits[k] = chars[w.start[at]] - chars[offsets[k]] + max((m + 1 for m, n in enumerate(own) if n <= left), default=0)
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(np.diff(offsets).astype(np.int64)), pa.array(total), pa.array(fits.astype(np.int64))], names=[*kept, "n_bytes", "n_tokens", "truncate_chars"])

    return map_arrow(docs, run, with_fields(docs.schema, n_bytes="long", n_tokens="long", truncate_chars="long"))


def prefix_table(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, out: str = "prefix_tokens") -> DataFrame:
    """docs with `out`, an array with the tokens of the text's first 1, 2, ... code points; null text has an empty one."""
    docs = docs.drop(out)
    kept = docs.columns

    def table(counter: PrefixCounter, known: dict[str, np.ndarray], text: str) -> np.ndarray:
        done, total, at = np.zeros(len(text), np.int32), 0, 0
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            run = m.group()
            own = known.get(run)
            if own is None:
                own = np.array(counter.run_counts(run), np.int32)
                if len(run) <= 64:
                    if len(known) >= CACHE_WORDS // 10:
                        known.clear()
                    known[run] = own
            done[at : m.start()] = total
            done[m.start() : m.end()] = total + own
            total, at = total + int(own[-1]), m.end()
        done[at:] = total
        return done

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = public_tokenizers.path(vocabulary)
        if path not in _WORKER:
            _WORKER[path] = _Runs(path)
        counter, known = _WORKER[path].counter, {}
        for batch in batches:
            for i, j, _, _ in text_chunks(batch, text_col):
                part = batch.slice(i, j - i)
                tables = [table(counter, known, text or "") for text in part.column(part.schema.get_field_index(text_col)).to_pylist()]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in tables])]).astype(np.int32))
                made = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*tables, np.zeros(0, np.int32)])))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*kept, out])

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def tokens_of_prefix(prefix_tokens: Column, chars: Column) -> Column:
    """Tokens of the first `chars` code points (of the whole text, if it has fewer; 0 for none)."""
    at = F.least(chars, F.size(prefix_tokens))
    return F.when(at > 0, F.element_at(prefix_tokens, F.greatest(at, F.lit(1)).cast("int"))).otherwise(F.lit(0))


def longest_within(prefix_tokens: Column, budget: Column) -> Column:
    """Code points of the longest prefix with at most `budget` tokens."""
    fits = F.transform(prefix_tokens, lambda n, i: F.when(n <= budget, i + 1).otherwise(F.lit(0)))
    return F.coalesce(F.array_max(fits), F.lit(0))
