"""Operators 11 to 13 against plain versions of their definitions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from syncloom.llm import alignment, rules, spelling
from syncloom.llm.common import text_bytes

ODD = [None, "", " ", "\n\n", "a", "é" * 30, "x" * 5_000, "tab\tand\x0bvertical\r\n same line\n same line\n", "# * $ | < >", "one two three four five six seven eight nine " * 5, "日本語 テキスト　全角", "a  b   c", " nbsp ", "▁low", "<|endoftext|> <s> </s> <unk>", "nul\0nul", "🙂🙂 x", "don't can't 's", "Áé", "﻿bom"]


def rows_of(spark, texts, more=""):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


# --- 11: rules


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    marks = sum(33 <= ord(c) < 127 and not c.isalnum() for c in text)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), len(lines), sum("A" <= c <= "Z" for c in text), marks, max(Counter(words).values(), default=0))


def random_texts(n, seed):
    rng = random.Random(seed)
    pick = lambda k: "".join(rng.choice(["a", "b", "é", " ", " ", "\n", "\t", "#", "Z", "a b c d e f g h ", "same\n", "日"]) for _ in range(k))
    return [pick(rng.randrange(60)) for _ in range(n)]


def test_statistics_equal_the_plain_ones(spark):
    texts = [*ODD, *random_texts(400, 1)]
    found = rules.statistics(rows_of(spark, texts).withColumn("n_words", F.lit("clash")).withColumn("other", F.lit(1))).collect()
    assert found[0].asDict().keys() == {"doc_id", "other", *rules.STATISTICS}
    assert {r.doc_id: tuple(r[c] for c in rules.STATISTICS) for r in found} == {i: plain_statistics(t) for i, t in enumerate(texts)}
    assert rules.statistics(rows_of(spark, [])).count() == 0


def test_forest_paths_are_those_of_a_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    forest = rules.grow(x, trees=20, sample=64, seed=1)

    def walk(tree, row):
        node = 0
        while forest.feature[tree, node] >= 0:
            node = 2 * node + (1 if row[forest.feature[tree, node]] <= forest.value[tree, node] else 2)
        return forest.path[tree, node]

    want = [2 ** (-np.mean([walk(t, row) for t in range(20)]) / forest.norm) for row in x[:50]]
    assert np.allclose(rules.path_scores(forest, x[:50]), want)
    far, near = rules.path_scores(forest, np.array([[9.0] * 4, [0.0] * 4]))
    assert far > near


def test_threshold_is_the_cheapest_of_all(spark):
    rng = random.Random(5)
    data = [(rng.random() * (0.7 if label else 1.0), label) for label in [1] * 300 + [0] * 60 + [None] * 9]
    level = rules.threshold(spark.createDataFrame(data, "anomaly double, label int"))
    cost = lambda t: rules.CLEAN_WEIGHT * np.mean([a >= t for a, y in data if y == 1]) + np.mean([a < t for a, y in data if y == 0])
    assert np.isclose(cost(level), min(cost(k / rules.BINS) for k in range(rules.BINS + 1)))
    assert rules.threshold(spark.createDataFrame([(0.5, 1)], "anomaly double, label int")) == 1.0
    assert rules.threshold(spark.createDataFrame([], "anomaly double, label int")) == 1.0


def test_junk_is_dropped_and_clean_text_kept(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9)))
    clean = [" ".join(word() for _ in range(rng.randrange(30, 200))) for _ in range(300)]
    junk = [" ".join(word().upper() + "!!" for _ in range(rng.randrange(30, 200))) for _ in range(40)]
    stats = rules.statistics(rows_of(spark, clean + junk)).withColumn("label", (F.col("doc_id") < 300).cast("int"))
    learnt, rest = stats.filter("doc_id % 2 = 0"), stats.filter("doc_id % 2 = 1")
    forest = rules.fit(learnt)
    found = rules.judged(rules.scored(rest, forest), rules.threshold(rules.scored(learnt, forest))).collect()
    assert np.mean([r.kept for r in found if r.label == 1]) > 0.95 and np.mean([r.kept for r in found if r.label == 0]) < 0.1
    none = rules.judged(rules.scored(stats, rules.fit(stats.limit(0))), 1.0)
    assert none.filter("not kept and not base_failed").count() == 0


# --- 12: spelling


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize(("block", "tile"), [(512, 1024), (8, 5)])
def test_variants_equal_the_plain_ones(spark, monkeypatch, block, tile):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "TILE", tile)
    rng = random.Random(7)
    base = ["".join(rng.choice(["an", "er", "ti", "é", "Ü", "on", "s"]) for _ in range(rng.randrange(2, 6))) for _ in range(60)]

    def slip(w):
        k = rng.randrange(len(w))
        return rng.choice([w, w, w, w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + rng.choice("aeé÷") + w[k + 1 :], w.upper(), w + "×"])

    rows = [(i if i % 9 else None, " ".join(slip(rng.choice(base)) for _ in range(120)) + ", d'été") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "y" * 3000 + " "), (103, "y" * 3000), (104, "y" * 3000), (105, "y" * 2999 + "z"), (106, "y" * 2999 + "z"), (107, "y" * 2999 + "z"), *[(9, "twice twice twicer twicer twicer")] * 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1)).repartition(3)
    n = plain_words(rows)
    words = spelling.word_counts(docs)
    assert {r.word: r.n for r in words.collect()} == n
    found = spelling.variants(words)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(n)
    assert {r.word: tuple(r)[1:] for r in found.collect()} == want and found.count() == len(want)
    assert sum(v[0] is not None for v in want.values()) > 20


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(37)] + [("other", "w020")]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert set(found.values()) == {"w037"} and len(found) == 38


def test_no_words(spark):
    assert spelling.variants(spelling.word_counts(rows_of(spark, []))).count() == 0
    assert spelling.variants(spelling.word_counts(rows_of(spark, [None, "one two"]))).count() == 0


# --- 13: alignment


def plain_tokens(text):
    import sentencepiece
    from tokenizers import Tokenizer

    if not plain_tokens.__dict__:
        plain_tokens.a = Tokenizer.from_file(public_tokenizers.path(alignment.VOCABULARY_A))
        plain_tokens.a.encode_special_tokens = True
        plain_tokens.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.VOCABULARY_B))
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        plain_tokens.letters = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    if not text:
        return None
    a = plain_tokens.a.encode(" " + text, add_special_tokens=False).ids
    b = plain_tokens.b.encode(text)
    spell_a = [bytes(plain_tokens.letters[c] for c in plain_tokens.a.id_to_token(i)) for i in a]
    pieces = [plain_tokens.b.id_to_piece(i) for i in b]
    spell_b = [bytes([int(p[3:5], 16)]) if plain_tokens.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
    want = (" " + text).encode()
    if b"".join(spell_a) != want or b"".join(spell_b) != want:
        return None
    ends = [np.cumsum([len(x) for x in spell]).tolist() for spell in (spell_a, spell_b)]
    return a, b, ends[0], ends[1]


def plain_alignment(texts):
    each = [plain_tokens(t) for t in texts]
    links, out = [], []
    for found in each:
        if found is None:
            links.append([])
            continue
        a, b, ea, eb = found
        sa, sb = [0, *ea[:-1]], [0, *eb[:-1]]
        links.append([(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if sa[i] < eb[j] and sb[j] < ea[i]])
    count = Counter(p for own in links for p in own)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    for found, own in zip(each, links, strict=True):
        if found is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, ea, eb = found
        shared, groups, i, j = sorted(set(ea) & set(eb)), [], 0, 0
        for end in shared:
            k, m = ea.index(end) + 1, eb.index(end) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j = k, m
        out.append((len(a), len(b), len(shared), len(own), sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("chunk", [32 << 20, 300])
def test_alignment_equals_the_plain_one(spark, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK_TEXT", chunk)
    monkeypatch.setattr(alignment, "PIECE", min(1 << 19, chunk))
    rng = random.Random(11)
    letters = ["a", "the ", "é", " ", "  ", "\n", "ß", "日本", "tion", "'s", "1234", "🙂", " ", "ing ", " <s> ", "　", "É", "\x1c"]
    texts = [*ODD, *["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(250)], "twice as much", "twice as much"]
    docs = spark.createDataFrame([(f"d{i}", t, 1) for i, t in enumerate(texts)], "doc_id string, text string, chunk int").repartition(3)
    found = alignment.aligned(docs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    want = {f"d{i}": row for i, row in enumerate(plain_alignment(texts))}
    assert got == want
    assert sum(row[0] == 0 for row in want.values()) >= 3  # texts that aren't spelt out again, too


def test_alignment_of_nothing(spark):
    assert alignment.aligned(rows_of(spark, [])).count() == 0
    assert [tuple(r) for r in alignment.aligned(rows_of(spark, [None, ""])).collect()] == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_cuts_are_sure():
    """Runs between cuts, encoded apart, are the whole's tokens."""
    tokens = alignment.Tokens(alignment.VOCABULARY_A, alignment.VOCABULARY_B)
    rng = random.Random(4)
    pieces = ["a", "Zoë", "naïve", " ", " ", "\n", "\t", " ", " ", "\x1f", "é", "É", "x'", "'s", "12", "!?", "日", "​", "é", "…", "\x85"]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25)))
        out, begins, _ = alignment.cut_runs(*text_bytes(pa.array([text])))
        runs = [out[i:j].tobytes() for i, j in zip(begins[:-1], begins[1:], strict=True)]
        assert b"".join(runs).decode() == " " + text
        for apart, whole in zip(tokens.encode(runs), tokens.encode([f" {text}".encode()]), strict=True):
            assert apart.flatten().to_pylist() == whole.flatten().to_pylist(), repr(text)


def test_very_long_texts(spark):
    """A million characters without a space, and a million spaces, in all three operators."""
    texts = ["ab" * 500_000, " " * 1_000_000, "\n" * 300_000, ("mot " * 4 + "mots ") * 60_000]
    docs = rows_of(spark, texts)
    got = {r.doc_id: r for r in alignment.aligned(docs).collect()}
    assert got[0].n_a == got[0].n_b == got[0].n_groups == 500_000 and got[1].n_links == 1_000_001 and got[3].n_links == got[3].n_a + got[3].n_b - got[3].n_groups
    stats = {r.doc_id: r for r in rules.statistics(docs).collect()}
    assert (stats[0].n_words, stats[0].word_chars, stats[1].n_words, stats[3].n_repeat_words) == (1, 1_000_000, 0, 300_000)
    assert spelling.word_counts(docs).count() == 0 and {r.word for r in spelling.word_counts(docs, letters=4).collect()} == {"mots"}
