from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from syncloom.llm import textops
from syncloom.llm.common import text_bytes, text_chunks


def brute_words(text, kind):
    if kind == "space":
        low = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    return re.findall(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+", text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbéÉ 😀\n\x1c.,0x", max_size=12), max_size=6))
def test_words(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    for kind in ("space", "alnum"):
        w = textops.words(data, offsets, kind)
        expected = [(i, x) for i, t in enumerate(texts) for x in brute_words(t, kind)]
        assert w.text.tolist() == [i for i, _ in expected]
        assert w.length.tolist() == [len(x.encode()) for _, x in expected]
        same = {}
        for h, (_, x) in zip(w.hash.tolist(), expected, strict=True):
            key = x if kind == "space" else x.lower()
            assert same.setdefault(key, h) == h
        assert len(set(same.values())) == len(same)


def test_shingles_and_short_texts():
    data, offsets = text_bytes(pa.array(["a b c d", "", "a b", "b a", None, "a b c d"]))
    s, at = textops.shingles(textops.words(data, offsets), 6, 3)
    assert np.diff(at).tolist() == [2, 0, 1, 1, 0, 2]
    assert s[at[0] : at[1]].tolist() == s[at[5] : at[6]].tolist()
    assert s[at[2]] != s[at[3]]


def test_chunks_cover_all_rows():
    texts = ["x" * n for n in (0, 5, 200, 1, 1, 0, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    got = [(i, j, bytes(d), o.tolist()) for i, j, d, o in text_chunks(batch.slice(1), "t", size=32)]
    assert [x for i, j, _, _ in got for x in range(i, j)] == list(range(6))
    assert b"".join(d for _, _, d, _ in got).decode() == "".join(texts)
