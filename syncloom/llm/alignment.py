"""Alignment of two tokenizers, in Arrow inside the tasks: which tokens of one overlap which of the other, and how often corpus-wide.

Both tokenizers spell out the same bytes. Lists of tokens are flattened, each token knows its document as the parent index, and a segmented cumulative sum of token bytes
gives its end within the document. A full outer hash join (Acero) of both tokenizers' ends on the key (document, end), sorted by that key, has one row for every pair of
occurrences that overlap: each row is a stretch between two neighbouring ends, and filling the missing side from the next row names the token that covers it.
Rows with both sides are ends in common; they close the groups. Table.group_by counts id pairs within a chunk of documents; Spark adds the chunks' counts.

What a pair counts corpus-wide comes back to the documents by chunks: a chunk's table of pairs is joined with the sums, then brought together with the
chunk's documents, whose links are stored as places in that table.

Scale: texts are read and encoded once. A chunk is at most CHUNK_TEXT bytes of text (or one longer text) of one task, so that no group is larger; within it, PIECE bytes are
encoded and aligned together. Stretches between single spaces are encoded once a piece: no token of either vocabulary crosses such a space. Only sums by B's ids (at most its
vocabulary) are broadcast. Counts of pairs are combined before they are shuffled; a common pair has one row a chunk.

Defined results: a text that is null, empty, or isn't spelt out again by both tokenizers has no tokens, zeros and an empty digest; ids of any type are kept as they are; equal rows count
each; special tokens' strings are plain text; a table without rows gives none; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_bytes, text_chunks, written

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text whose pairs share a table; bytes that are encoded and aligned together.
CHUNK_TEXT, PIECE = 32 << 20, 1 << 19
#: Runs whose tokens a worker remembers, and the bytes of those that are worth it.
CACHE_RUNS, SHORT_RUN = 200_000, 64
#: An id pair as one number: A's id times this, plus B's. A document and an end in it likewise.
ID_SPAN, END_SPAN = 1 << 24, 1 << 36


class Tokens:
    """The two encoders, the bytes and the decimal text of each id."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        letter = _byte_letters()
        plain = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = pa.array([_spelt(plain.get(i, ""), letter) for i in range(max(plain) + 1)], pa.large_binary())
        piece = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = pa.array([bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(piece)], pa.large_binary())
        self.names = pa.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))], pa.string())

        self.known: dict[bytes, tuple[bytes, bytes]] = {}

    def encode(self, runs: list[bytes]) -> tuple[pa.Array, pa.Array]:
        """Token ids of each run by A and B. A run is a space and a text in UTF-8; B adds that space itself. Short runs are remembered."""
        found = [self.known.get(r) for r in runs]
        new = [i for i, ids in enumerate(found) if ids is None]
        texts = [runs[i].decode() for i in new]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        if len(self.known) > CACHE_RUNS:
            self.known.clear()
        for i, x, y in zip(new, a, b, strict=True):
            found[i] = array("i", x).tobytes(), array("i", y).tobytes()
            if len(runs[i]) <= SHORT_RUN:
                self.known[runs[i]] = found[i]
        return _lists([ids[0] for ids in found]), _lists([ids[1] for ids in found])


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the others, in order, as the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _spelt(token: str, letter: dict[str, int]) -> bytes:
    return bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()


def _lists(ids: list[bytes]) -> pa.Array:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)])), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def cut_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A space before each non-empty text, cut where a single space stands between two characters that aren't white space: (bytes, begins of runs and the end, text of each run).

    Beside a cut stand printable ASCII or letters from U+00C0 to U+00FF only, so that it is sure.
    """
    some = np.flatnonzero(np.diff(offsets))
    out = np.full(len(data) + len(some), 0x20, np.uint8)
    at = offsets[some] + np.arange(len(some))
    body = np.ones(len(out), bool)
    body[at] = False
    out[body] = data
    inside = (out > 0x20) & (out < 0x7F)
    latin = np.zeros(len(out), bool)  # second byte of U+00C0..U+00FF
    latin[1:] = (out[:-1] == 0xC3) & (out[1:] >= 0x80)
    cut = out == 0x20
    cut[1:] &= inside[:-1] | latin[:-1]
    cut[:-1] &= inside[1:] | (out[1:] == 0xC3)
    cut[-1:] = False
    cut[at] = True
    begins = np.flatnonzero(cut)
    text = some[np.searchsorted(at, begins, side="right") - 1] if len(some) else begins
    return out, np.append(begins, len(out)), text


def _flat(lists: pa.Array, spelt: pa.Array, text_of_list: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
    """(ids, text of each, end in its text, bytes) of token lists; a segmented cumulative sum of the tokens' bytes gives the ends."""
    ids = pc.list_flatten(lists)
    parent = text_of_list[pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)]
    letters = spelt.take(ids)
    total = pc.cumulative_sum(pc.binary_length(letters)).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], total])[np.searchsorted(parent, np.arange(n))]
    return ids, parent, total - before[parent], letters


def _spells(letters: pa.Array, parent: np.ndarray, ends: np.ndarray, want: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each text: whether its tokens' bytes are the wanted ones (those from at[i] to at[i+1])."""
    n = len(at) - 1
    last = np.searchsorted(parent, np.arange(n), side="right") - 1
    size = np.zeros(n, np.int64)
    found = np.searchsorted(parent, np.arange(n)) <= last
    size[found] = ends[last[found]]
    good = size == np.diff(at)
    offsets, data = (np.frombuffer(b, t) for b, t in zip(letters.buffers()[1:], (np.int64, np.uint8), strict=True)) if len(letters) else (np.zeros(1, np.int64), np.zeros(0, np.uint8))
    offsets = offsets[letters.offset : letters.offset + len(letters) + 1]
    own = data[offsets[0] : offsets[-1]]
    if good.all():
        wrong = np.flatnonzero(own != want)
        good[np.searchsorted(at, wrong, side="right") - 1] = False
        return good
    begin = np.concatenate([[0], np.cumsum(size)])
    for i in np.flatnonzero(good):
        good[i] = np.array_equal(own[begin[i] : begin[i + 1]], want[at[i] : at[i + 1]])
    return good


def align(a_ids: pa.Array, a_text: np.ndarray, a_end: np.ndarray, b_ids: pa.Array, b_text: np.ndarray, b_end: np.ndarray) -> pa.Table:
    """key (text * END_SPAN + end), a, b, common: a row for every two overlapping token occurrences, in order."""
    a = pa.table({"key": pa.array(a_text * END_SPAN + a_end), "a": a_ids})
    b = pa.table({"key": pa.array(b_text * END_SPAN + b_end), "b": b_ids})
    joined = a.join(b, "key", join_type="full outer", use_threads=False).combine_chunks()
    joined = joined.take(pa.array(np.argsort(joined.column("key").to_numpy(), kind="stable")))
    a, b = joined.column("a"), joined.column("b")
    return pa.table({"key": joined.column("key"), "a": pc.fill_null_backward(a), "b": pc.fill_null_backward(b), "common": pc.and_(a.is_valid(), b.is_valid())})


def _joined_text(ids: pa.Array, group: np.ndarray, n: int, names: pa.Array) -> pa.Array:
    """Decimal ids of each group, with commas between."""
    at = np.searchsorted(group, np.arange(n + 1))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), names.take(ids)), ",")


def digests(a_ids: pa.Array, a_key: np.ndarray, b_ids: pa.Array, b_key: np.ndarray, common: np.ndarray, n: int, names: pa.Array) -> list[str]:
    """SHA-256 of each text's groups as a1,a2|b1;a3|b2,b3; empty without tokens. `common` holds the keys of common ends, in order."""
    groups = len(common)
    own = [_joined_text(ids, np.searchsorted(common, key), groups, names) for ids, key in ((a_ids, a_key), (b_ids, b_key))]
    each = pc.binary_join_element_wise(*own, "|")
    at = np.searchsorted(common // END_SPAN, np.arange(n + 1))
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), each), ";")
    return [hashlib.sha256(s.as_buffer()).hexdigest() if j > i else "" for s, i, j in zip(whole, at[:-1], at[1:], strict=True)]


class _Pairs:
    """A chunk's table of id pairs: their places, in order of appearance, and their partial counts."""

    def __init__(self) -> None:
        self.codes, self.places, self.counts, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Sorted distinct codes with their counts."""
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), bool)
        known[at < len(self.codes)] = self.codes[at[at < len(self.codes)]] == codes[at < len(self.codes)]
        self.counts[self.places[at[known]]] += counts[known]
        self.places = np.insert(self.places, at[~known], len(self.counts) + np.arange((~known).sum()))
        self.codes = np.insert(self.codes, at[~known], codes[~known])
        self.counts = np.append(self.counts, counts[~known])

    def of(self, codes: np.ndarray) -> np.ndarray:
        return self.places[np.searchsorted(self.codes, codes)]


def _packed(text: np.ndarray, place: np.ndarray, times: np.ndarray, n: int) -> list[bytes]:
    """Of each text: its links' places, as differences in order, and how often each, compressed."""
    order = np.lexsort((place, text))
    place, times = place[order].astype(np.uint32), times[order].astype(np.uint32)
    at = np.searchsorted(text[order], np.arange(n + 1))
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        step = np.diff(place[i:j], prepend=np.uint32(0))
        planes = np.concatenate([step, times[i:j]]).astype("<u4").view(np.uint8).reshape(-1, 4).T
        raw = np.ascontiguousarray(planes).tobytes()
        out.append(len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True))
    return out


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(packed[:8], "little")
    raw = pa.decompress(packed[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    both = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


_WORKER: dict[tuple[str, str], Tokens] = {}
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _piece(tokens: Tokens, data: np.ndarray, offsets: np.ndarray, pairs: _Pairs) -> tuple[np.ndarray, list[str], list[bytes]]:
    """Counts (a row for each text), digests and packed links of some texts; their pairs are added to the chunk's."""
    n = len(offsets) - 1
    out, begins, run_text = cut_runs(data, offsets)
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(out)]).dictionary_encode()
    a, b = tokens.encode(runs.dictionary.to_pylist())
    want_at = np.concatenate([[0], np.cumsum(np.diff(offsets) + (np.diff(offsets) > 0))])
    index = runs.indices
    a_ids, a_text, a_end, a_letters = _flat(a.take(index), tokens.a_bytes, run_text, n)
    b_ids, b_text, b_end, b_letters = _flat(b.take(index), tokens.b_bytes, run_text, n)
    good = _spells(a_letters, a_text, a_end, out, want_at) & _spells(b_letters, b_text, b_end, out, want_at)
    if not good.all():
        keep_a, keep_b = good[a_text], good[b_text]
        a_ids, a_text, a_end = a_ids.filter(pa.array(keep_a)), a_text[keep_a], a_end[keep_a]
        b_ids, b_text, b_end = b_ids.filter(pa.array(keep_b)), b_text[keep_b], b_end[keep_b]
    links = align(a_ids, a_text, a_end, b_ids, b_text, b_end)
    key = links.column("key").to_numpy()
    common = key[links.column("common").to_numpy()]
    link_text = key // END_SPAN
    code = pc.add(pc.multiply(links.column("a").cast(pa.int64()), ID_SPAN), links.column("b").cast(pa.int64()))
    own = pa.table({"text": pa.array(link_text), "code": code}).group_by(["text", "code"], use_threads=False).aggregate([([], "count_all")])
    total = own.group_by("code", use_threads=False).aggregate([("count_all", "sum")]).sort_by("code")
    pairs.add(total.column("code").to_numpy(), total.column("count_all_sum").to_numpy())
    packed = _packed(own.column("text").to_numpy(), pairs.of(own.column("code").to_numpy()), own.column("count_all").to_numpy(), n)
    found = np.stack([np.bincount(x, minlength=n) for x in (a_text, b_text, common // END_SPAN, link_text)], axis=1)
    return found, digests(a_ids, a_text * END_SPAN + a_end, b_ids, b_text * END_SPAN + b_end, common, n, tokens.names), packed


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> DataFrame:
    """Rows of documents (id, counts, digest, packed links) and of their chunk's pairs (place, code, n), told apart by `place`, null for documents."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    schema = f"chunk long, id {id_type}, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, links binary, place long, code long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (a, b) not in _WORKER:
            _WORKER[a, b] = Tokens(a, b)
        tokens, task = _WORKER[a, b], TaskContext.get().partitionId() << 32
        chunk, pairs, kind = 0, _Pairs(), None

        def table_rows() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(pairs.codes), 1 << 16):
                part = slice(i, i + (1 << 16))
                m = len(pairs.codes[part])
                none = [pa.nulls(m, t) for t in (kind, *[pa.int64()] * len(_COUNTS), pa.string(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, task + chunk)), *none, *[pa.array(x) for x in (pairs.places[part], pairs.codes[part], pairs.counts[pairs.places[part]])]], names=names)

        names = ["chunk", "id", *_COUNTS, "groups_sha256", "links", "place", "code", "n"]
        for batch in batches:
            kind = batch.column("id").type
            for i, j, data, offsets in text_chunks(batch, "text", PIECE):
                if pairs.bytes and pairs.bytes + len(data) > CHUNK_TEXT:
                    yield from table_rows()
                    chunk, pairs = chunk + 1, _Pairs()
                pairs.bytes += len(data)
                counts, sha, packed = _piece(tokens, data, offsets, pairs)
                m = j - i
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, task + chunk)), batch.column("id").slice(i, m), *[pa.array(c.astype(np.int64)) for c in counts.T], pa.array(sha, pa.string()), pa.array(packed, pa.binary()), *[pa.nulls(m, pa.int64())] * 3], names=names)
        yield from table_rows()

    return map_arrow(docs, run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(code, n, best) of rows of `encoded`: links of each id pair in the whole corpus, and whether no pair of its B id has more."""
    total = rows.filter("place is not null").groupBy("code").agg(F.sum("n").alias("n"))
    top = total.groupBy((F.col("code") % ID_SPAN).alias("b")).agg(F.max("n").alias("top"))
    return total.join(F.broadcast(top), F.col("code") % ID_SPAN == F.col("b")).select("code", "n", (F.col("n") == F.col("top")).alias("best"))  # at most one row for each of B's ids


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> DataFrame:
    """For each document: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = written(encoded(docs, id_col, text_col, a, b), "alignment")
    sums = written(pair_counts(rows), "alignment_pairs")
    places = rows.filter("place is not null").select("chunk", "place", "code").join(sums, "code").select("chunk", "place", "n", "best")
    own = rows.filter("place is null").select(F.col("chunk").alias("of"), "id", *_COUNTS, "groups_sha256", "links")
    id_type = own.schema["id"].dataType.simpleString()

    def told(documents: pa.Table, table: pa.Table) -> pa.Table:
        size = len(table)
        n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if size:
            at = table.column("place").to_numpy()
            n[at], best[at] = table.column("n").to_numpy(), table.column("best").to_numpy()
        sums_, bests = np.zeros(len(documents), np.int64), np.zeros(len(documents), np.int64)
        for k, packed in enumerate(documents.column("links")):
            place, times = _unpacked(packed.as_py())
            sums_[k], bests[k] = (n[place] * times).sum(), (best[place] * times).sum()
        return pa.table([documents.column("id"), *[documents.column(c) for c in _COUNTS], pa.array(bests), pa.array(sums_), documents.column("groups_sha256")], names=["id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    done = own.groupBy("of").cogroup(places.groupBy("chunk")).applyInArrow(told, f"id {id_type}, {', '.join(f'{c} long' for c in (*_COUNTS, 'n_best', 'count_sum'))}, groups_sha256 string")
    return done.withColumnRenamed("id", id_col)
