"""Each operator against brute force, a round trip or held-out labels, and on odd input."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from syncloom.llm import chat, cnn, common, components, decontam, jaccard, language, mixing, quality, reputation, tokens, winnow
from syncloom.llm import queries as q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def docs_of(spark, texts, **more):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, extra columns with names that operators use."""
    long = " ".join(random.Random(1).choices(WORDS, k=60_000))
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, "   \n\t ", "en", "a", 5), (3, "x", "en", None, 1), (4, long, "en", "a", 1), (4, long, "en", "a", 1), (5, "alpha beta", "fr", "b", 1), (None, "alpha beta gamma", "en", "b", 1)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(1) for c in ("score", "id", "n", "size", "target", "range", "lid_lang", "n_tokens", "component", "prefix")})


# --- 1, 8: classifiers


def test_quality_learns(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    labels = spark.read.parquet(sf.replace("0.001", "0.01") + "/labels.parquet")
    got = q.op1_quality(spark, sf.replace("0.001", "0.01")).join(labels, "doc_id").filter("held_out")
    right = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.9
    assert got.filter("score < 0 or score > 1").count() == 0
    assert docs.count() == q.op1_quality(spark, sf.replace("0.001", "0.01")).count()


def test_quality_parts_the_labels(spark, sf):
    sf = sf.replace("0.001", "0.1")
    labels = spark.read.parquet(sf + "/labels.parquet")
    got = q.op1_quality(spark, sf).join(labels, "doc_id").filter("held_out").groupBy("quality").agg(F.avg("predicted").alias("p")).collect()
    share = {r.quality: r.p for r in got}
    assert share[1] > 0.95 and share[0] < 0.12


def test_votes_are_exact(monkeypatch):
    monkeypatch.setattr(quality, "NEIGHBOURS", 12)
    rng = np.random.default_rng(1)
    v = quality.Voter(np.ones(1 << quality.BITS))
    v.space = rng.normal(size=(1 << quality.BITS, 8)).astype(np.float32)
    x = v.weighted(rng.integers(0, 3, (40, 1 << quality.BITS)))
    v.vectors, v.labels = v.projected(x[:30]), (np.arange(30) % 2).astype(np.float32)
    v.vectors[20:] = v.vectors[:10]  # ties: each vector of the first ten votes twice, with either label
    p = v.projected(x)
    plain, others = v.votes(p), v.votes(p[:30], np.arange(30))
    for i in range(40):
        for own, score in ((None, plain[i]), *([(i, others[i])] if i < 30 else [])):
            cosine = sorted(((float(p[i] @ v.vectors[j]), v.labels[j]) for j in range(30) if j != own), reverse=True)
            near = [c for c in cosine if c[0] >= cosine[quality.NEIGHBOURS - 1][0] - quality.TIE]
            weight = [np.exp(quality.SHARPNESS * c) for c, _ in near]
            assert abs(score - sum(w * y for w, (_, y) in zip(weight, near, strict=True)) / sum(weight)) < 1e-4


def test_quality_equals_brute_force(spark):
    """The whole way from texts to scores, one row at a time, with the space that was fitted."""
    rng = random.Random(14)
    good, bad = "the river and the garden are quiet in the morning".split(), "zxq 99 $$$ click win!!! kkk 77".split()
    texts = [" ".join(rng.choices(good if i % 3 else bad, k=rng.randint(3, 30))) for i in range(90)] + ["", "ab", None]
    docs = docs_of(spark, texts)
    learnt = docs.filter("doc_id < 60").withColumn("quality", (F.col("doc_id") % 3 > 0).cast("int"))
    voter = quality.fit(docs, learnt)

    def grams(text):
        raw = (text or "").encode()
        return Counter((int.from_bytes(raw[i : i + 3], "big") * 0x9E3779B1 % 2**32) >> (32 - quality.BITS) for i in range(len(raw) - 2))

    df = Counter(g for t in texts for g in set(grams(t)))

    def vector(text):
        v = sum(np.log1p(n) * (np.log((1 + len(texts)) / (1 + df[g])) + 0.1) * voter.space[g].astype(float) for g, n in grams(text).items())
        return v / np.linalg.norm(v)

    labelled = sorted({(t, int(i % 3 > 0)) for i, t in enumerate(texts[:60])})
    vectors = np.array([vector(t) for t, _ in labelled])
    y = np.array([x for _, x in labelled])
    for r in quality.scored(docs, voter).collect():
        if len((r.text or "").encode()) < 3:
            vote = y.mean()
        else:
            weight = np.exp(quality.SHARPNESS * (vectors @ vector(r.text)))
            vote = weight @ y / weight.sum()  # fewer voters than neighbours: all vote
        expected = vote / voter.cut * quality.LEVEL if vote < voter.cut else quality.LEVEL + (vote - voter.cut) / (1 - voter.cut) * (1 - quality.LEVEL)
        assert r.score == pytest.approx(expected, abs=2e-3)


def test_toxicity_learns(spark, sf):
    sf = sf.replace("0.001", "0.1")
    labels = spark.read.parquet(sf + "/labels.parquet")
    got = q.op8_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    share = {r.toxic: r.p for r in got}
    assert share[1] > 0.85 and share[0] < 0.06  # some labels are noise


def test_classifiers_on_odd_input(spark, odd):
    empty = odd.limit(0)
    learnt = odd.select("doc_id", "text").join(spark.createDataFrame([(5, 1, 0), (3, 0, 1), (4, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int"), "doc_id")
    for voter in (quality.fit(odd, learnt), quality.fit(empty, learnt.limit(0))):
        got = quality.scored(odd, voter)
        assert got.columns.count("score") == 1 and got.count() == odd.count()
        assert got.filter("score is null or score < 0 or score > 1").count() == 0
        assert quality.scored(empty, voter).count() == 0
    for model in (cnn.fit(learnt), cnn.fit(learnt.limit(0))):
        got = cnn.scored(odd, model)
        assert got.count() == odd.count() and got.filter("score is null or score < 0 or score > 1").count() == 0
        assert cnn.scored(empty, model).count() == 0


def test_cnn_tables_equal_convolution():
    rng = np.random.default_rng(2)
    nets = [cnn.Net(20, seed) for seed in (1, 2)]
    ids, text = rng.integers(0, 21, (30, 2)), np.sort(rng.integers(0, 4, 30))
    for m in nets:
        m.bias[:] = rng.normal(0, 0.1, len(m.bias))
        best, where = cnn.pooled(m.tables(), m.bias, ids, text, 4, places=True)
        for t in range(4):
            own, begin = m.embedding[ids[text == t]].sum(1), int(np.argmax(text == t))
            for g, w in enumerate(cnn.WIDTHS):
                for f in range(cnn.FILTERS):
                    at = g * cnn.FILTERS + f
                    values = [sum(own[i + k] @ m.filters[g][k][:, f] for k in range(w)) + m.bias[at] for i in range(len(own) - w + 1)]
                    assert abs(best[t, at] - max([0, *values])) < 1e-4
                    if best[t, at] > 1e-4:
                        assert abs(values[where[t, at] - begin] - best[t, at]) < 1e-4
    found = cnn.buckets(rng.integers(0, 1 << 63, (30, 2)).astype(np.uint64))
    model = cnn.Cnn(np.unique(found[:10]), nets)
    assert model.logits(found, text, 4) == pytest.approx(np.mean([m.logits(model.ids(found), text, 4) for m in nets], axis=0), abs=1e-4)


def test_cnn_gradients_equal_differences():
    """Every parameter's gradient against the loss at two close points, in double precision."""
    rng = np.random.default_rng(8)
    net = cnn.Net(15, 3)
    net.embedding, net.filters = net.embedding.astype(float), [f.astype(float) for f in net.filters]
    net.bias, net.weights, net.constant = rng.normal(0, 0.3, len(net.bias)), net.weights.astype(float), np.array([0.2])
    ids, text, y = rng.integers(0, 16, (40, 2)), np.sort(rng.integers(0, 6, 40)), np.array([0.0, 1, 1, 0, 1, 0])
    kept = (rng.random((6, len(net.bias))) > 0.3) / 0.7

    def loss():
        z = (plain_pooled(net, ids, text, 6) * kept) @ net.weights + net.constant[0]
        return np.logaddexp(0, z * (1 - 2 * y)).mean()

    def plain_pooled(m, ids, text, n):
        out = np.zeros((n, len(m.bias)))
        for t in range(n):
            own = m.embedding[ids[text == t]].sum(1)
            for g, w in enumerate(cnn.WIDTHS):
                for i in range(len(own) - w + 1):
                    response = sum(own[i + k] @ m.filters[g][k] for k in range(w)) + m.bias[g * cnn.FILTERS : (g + 1) * cnn.FILTERS]
                    out[t, g * cnn.FILTERS : (g + 1) * cnn.FILTERS] = np.maximum(out[t, g * cnn.FILTERS : (g + 1) * cnn.FILTERS], response)
        return out

    used, words, dense = cnn.gradients(net, ids, text, y, kept)
    whole = np.zeros_like(net.embedding)
    whole[used] = words
    for p, g in zip(net.parts(), [whole, *dense], strict=True):
        for at in rng.choice(p.size, min(p.size, 25), replace=False):
            flat, before = p.reshape(-1), p.reshape(-1)[at]
            flat[at] = before + 1e-5
            up = loss()
            flat[at] = before - 1e-5
            down = loss()
            flat[at] = before
            assert abs((up - down) / 2e-5 - g.reshape(-1)[at]) < 2e-4


def test_stems_are_the_first_letters():
    texts = ["Trash réeuxê it, trashes", "", "日本語テキスト x", "réeuxment"]
    data, offsets = common.text_bytes(pa.array(texts))
    w, found = cnn.units(data, offsets)
    assert len(found) == len(w.hash) == 7
    assert found[0, 1] == found[3, 1] and found[1, 1] == found[6, 1] and found[0, 0] != found[3, 0] and len(set(found[:, 1])) == 5


def test_threshold_balances_shares(monkeypatch):
    monkeypatch.setattr(common, "DRAWS", 1)
    rng = np.random.default_rng(3)
    for _ in range(50):
        z, y = rng.normal(size=40), (rng.random(40) < 0.2).astype(np.float32)
        y[0], y[1] = 0, 1
        cost = lambda c: (z[y == 1] <= c).mean() + (z[y == 0] > c).mean()
        assert cost(common.balanced_threshold(z, y)) <= min(cost(c) for c in [*z, z.min() - 1]) + 1e-9
    z = np.array([-2.0, -1.0, 1.0, 2.0])
    assert common.balanced_threshold(z, np.array([0, 0, 1, 1])) == 0.0


def test_sample_is_bounded(spark):
    """Copies of a text don't make the sample larger, and rows are picked alike again."""
    rows = [("copy", 1)] * 3000 + [(f"text {i}", i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "text string, label int")
    first, again = (common.bounded_sample(x, 500, 3).to_pylist() for x in (df, df.repartition(7)))
    assert first == again and 200 < len(first) <= 500
    assert common.bounded_sample(df.limit(0), 5, 1).num_rows == 0


# --- 2: tokens


def test_token_counts_equal_library(spark, sf):
    path = public_tokenizers.path(tokens.VOCABULARY)
    library = Tokenizer.from_file(path)
    odd_texts = [None, "", " \n ", "<|endoftext|>abc<|startoftext|> <|endoftext|>", "ça va l’été don't I'LL 1234 !!!__x", "日本語テキスト 😀😀 e\u0301", "İstanbul ΑΣ ﬁ \x1c a\xa0b", "a" * 3000, "'s'T're" * 40]
    texts = odd_texts + [r.text for r in spark.read.parquet(sf + "/documents.parquet").limit(150).collect()]
    got = [(r.n_bytes, r.n_tokens) for r in tokens.counted(docs_of(spark, texts, n_tokens="x")).orderBy("doc_id").collect()]
    assert got == [(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for t in texts]
    assert tokens.counted(docs_of(spark, texts).limit(0)).count() == 0


def test_every_prefix():
    path = public_tokenizers.path(tokens.VOCABULARY)
    library, counter = Tokenizer.from_file(path), tokens.PrefixCounter(path)
    rng = random.Random(3)
    for _ in range(150):
        for piece in counter.pieces("".join(rng.choice("abcdeéthingus") for _ in range(rng.randint(1, 14)))):
            assert counter.piece_counts(piece)[-1] == counter.piece_count(piece)
    word = "internationalisation"
    assert counter.piece_counts(word) == [len(library.encode(word[:i], add_special_tokens=False).ids) for i in range(1, len(word) + 1)]


def test_stored_prefix_counts_answer_budgets(spark):
    """Every prefix of odd texts and the longest prefix for a budget, as the library counts them, also without white space."""
    library = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    texts = ["The quick brown fox, jumped over 12 lazy dogs' backs. I'll say we're DON'T 's", "日本語のテキストは空白がない" * 4, "QmFzZTY0IGRhdGE+/x9=" * 5, "é" * 9 + "e\u0301x\u0301y か\u3099ki", "a!<|endoftext|>b<|endoftext|><|startoftext|", "İstanbul ΑΣ ﬁ'ſ x’ll", "😀😀 👍🏽!!", "  \n x \t", "", None, "''s'st'll''"]
    table = tokens.prefix_table(docs_of(spark, texts, prefix_tokens="x", n_tokens=1))
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for r in table.collect():
        text = r.text or ""
        assert r.prefix_tokens == [count(text[:i]) for i in range(1, len(text) + 1)], text
    for budget in (0, 1, 5, 1000):
        asked = table.select("text", tokens.longest_within(F.col("prefix_tokens"), F.lit(budget)).alias("n"), tokens.tokens_of_prefix(F.col("prefix_tokens"), F.lit(budget)).alias("first"))
        for r in asked.collect():
            text = r.text or ""
            assert r.n == max([i for i in range(1, len(text) + 1) if count(text[:i]) <= budget], default=0)
            assert r.first == count(text[:budget])
    assert tokens.prefix_table(docs_of(spark, texts).limit(0)).count() == 0


# --- 3: mixing


def filled(sizes, weights, budget=1.5, cap=2.0):
    """Targets by the rule as stated: share by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), budget * sum(sizes.values())
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s], left = cap * sizes[s], left - cap * sizes[s]
        open_ -= over
    return target


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    monkeypatch.setattr(mixing, "RUN_SLOTS", 5)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.choice([0, 1, 3, 40, 300]))), None, rng.choice(["a", "b", "é", "Z", None, "a"]), 1) for i in range(120)]
    rows += [(3, "one two", None, "a", 1)] * 2 + [(200, None, None, "empty", 0), (201, "tiny", None, "tiny", 1)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df, block_words=16, shard_slots=20).collect()
    assert sorted(((r.doc_id, r.source or "") for r in got)) == sorted((r[0], r[3] or "") for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall("[^\x20\x09-\x0d]+", r[1] or ""))
    expected, took = filled(dict(sizes), (3, 1, 2)), Counter()
    for r in got:
        assert r.taken <= 2 * r.size and abs(r.target - expected[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        took[r.source] += r.taken
    assert all(abs(took[s] - expected[s]) <= 0.5 for s in expected)
    again = mixing.mix(df.repartition(3), block_words=16, shard_slots=20).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(df.limit(0)).count() == 0


def test_permutation_is_one(spark):
    n = F.lit(97).cast("long")
    got = [r[0] for r in spark.range(97).select(mixing._permuted(F.col("id"), n, F.lit(1), F.lit(2))).collect()]
    assert sorted(got) == list(range(97)) and got != list(range(97))


def test_shards_are_draws(spark):
    s = spark.createDataFrame([(0, "a", 1, 60_000, 90_000.0), (1, "b", 1, 30_000, 45_000.0)], "s_id int, source string, docs long, source_size long, target double")
    slots = mixing.slots(s, block_words=10, shard_slots=500)
    counts = slots.groupBy("shard").agg(F.count("*").alias("n"), F.sum((F.col("s_id") == 0).cast("int")).alias("a")).collect()
    assert sum(r.n for r in counts) == 13_500 and len(counts) == 27
    z = [(r.a - r.n * 2 / 3) / (r.n * 2 / 9) ** 0.5 for r in counts]
    assert 0.5 < np.std(z) < 1.5


def test_mix_packs_its_rows_once(spark):
    df = docs_of(spark, ["a b c", "d", None, "e f"])
    assert mixing.mix(df)._jdf.queryExecution().executedPlan().toString().count("Window [") == 1  # of the slots; the packing's stands behind a checkpoint


def test_mix_on_odd_input(spark, odd):
    assert mixing.mix(odd).count() == odd.count()


# --- 4: Jaccard join


def shingles_of(text, k):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = [x for x in re.split("[\x20\x09-\x0d]+", low) if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_classes(rows, k, percent):
    sets = {i: shingles_of(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.fixture(scope="module")
def near_texts():
    """Exact copies, chains of small edits, a passage that many share, short texts."""
    rng = random.Random(5)
    fresh = lambda n: [f"{rng.choice(WORDS)}{rng.randint(0, 60)}" for _ in range(n)]
    passage, base, out = fresh(30), fresh(90), []
    for _ in range(40):
        out.append(" ".join(fresh(20) + passage + fresh(30)))
    chain = list(base)
    for _ in range(25):
        chain = list(chain)
        chain[rng.randrange(90)] = "edit" + str(rng.random())
        out.append(" ".join(chain))
    for n in (1, 2, 4, 8, 15, 30):
        for _ in range(8):
            other = list(base)
            for _ in range(n):
                other[rng.randrange(90)] = "e" + str(rng.random())
            out.append(" ".join(other))
    out += [out[0], out[0].upper(), out[3], "", None, " ", "one", "One", "one two", "two one", "one two three", "one two three four"] + [" ".join(passage)] * 3
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (2, 60)])
def test_jaccard_join(spark, near_texts, k, percent):
    got = {r.id: (r.n, r.component) for r in jaccard.link_classes(docs_of(spark, near_texts), k, percent).collect()}
    assert got == brute_classes(list(enumerate(near_texts)), k, percent)


@pytest.mark.parametrize("leaf,pivots,depth", [(6, 3, 2), (9, 4, 0)])
def test_jaccard_large_regions_are_cut_into_cells(spark, near_texts, monkeypatch, leaf, pivots, depth):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "BLOCK", leaf)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard, "DEPTH", depth)
    monkeypatch.setattr(jaccard, "HEAVY", 1000)  # no order by count: passages make regions
    texts = near_texts[:60]
    got = {r.id: (r.n, r.component) for r in jaccard.link_classes(docs_of(spark, texts), 3, 80).collect()}
    assert got == brute_classes(list(enumerate(texts)), 3, 80)


def test_jaccard_hot_copies_without_broadcast(spark, near_texts, monkeypatch):
    """Many copies of one text, some without an id, looked up by a salted join."""
    monkeypatch.setattr(jaccard, "is_small", lambda *_: False)
    texts = near_texts[:20] + [near_texts[0]] * 40
    docs = docs_of(spark, texts).unionByName(docs_of(spark, [near_texts[0]] * 3).withColumn("doc_id", F.lit(None).cast("long")))
    got = [(r.id, r.n, r.component) for r in jaccard.link_classes(docs, 3, 80).collect()]
    expected = brute_classes(list(enumerate(texts)), 3, 80)
    assert {i: (n, c) for i, n, c in got if i is not None} == expected and len(got) == len(texts) + 1 and (None, *expected[0]) in got


def test_jaccard_on_odd_input(spark, odd):
    got = {(r.id, r.n): r.component for r in jaccard.link_classes(odd, 3, 90).collect()}
    assert got[(0, 0)] == 0 and got[(1, 0)] == 1 and got[(2, 0)] == 2 and got[(3, 1)] == 3 and got[(5, 1)] == 5
    assert jaccard.link_classes(odd.limit(0), 3, 90).count() == 0


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(500, 500)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_components_of_stars_take_no_round(spark, monkeypatch):
    made = []
    monkeypatch.setattr(components, "checkpoint", lambda df: made.append(df) or common.checkpoint(df))
    stars = spark.createDataFrame([(0, 5), (7, 0), (9, 3), (3, 4), (3, 4), (6, 6)], "a long, b long")
    assert {r.id: r.component for r in components.components(stars).collect()} == {0: 0, 5: 0, 7: 0, 3: 3, 4: 3, 9: 3}
    assert components.components(stars.limit(0)).count() == 0
    assert len(made) == 2


def test_regions_without_links_join_no_classes(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(jaccard, "components", lambda edges: calls.append(1) or components.components(edges))
    texts = ["alpha beta gamma " + " ".join(f"w{i}x{j}" for j in range(9)) for i in range(4)]
    got = {r.id: r.component for r in jaccard.link_classes(docs_of(spark, texts), 3, 10).collect()}
    assert got == {i: i for i in got} and len(got) == 4 and len(calls) == 1


# --- 5: decontamination


def test_decontamination(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    fresh = lambda n: rng.choices(words, k=n)
    item, short = fresh(40), fresh(5)
    swapped = list(item)
    for i in range(4, 40, 9):
        swapped[i] = "other"
    texts = [
        " ".join(fresh(50) + item + fresh(50)),  # whole
        " ".join(fresh(10) + item[5:20] + fresh(10)),  # 15 tokens
        " ".join(fresh(10) + item[5:13] + fresh(10)),  # 8 tokens: too few
        ("! ".join(fresh(30) + swapped)).upper(),  # substitutions, other case and punctuation
        " ".join(fresh(20) + short + fresh(20)),  # a whole short item
        " ".join(fresh(300)), "", None, " ".join(item[::-1]),
    ]
    tests = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(short)), (9, None), (10, ""), (11, " ".join(item))], "item_id long, text string")
    expected = {(0, 7), (0, 11), (1, 7), (1, 11), (3, 7), (3, 11), (4, 8)}
    for size in (decontam.BLOCK_CHARS, 60):
        monkeypatch.setattr(decontam, "BLOCK_CHARS", size)
        got = decontam.contaminated(docs_of(spark, texts, tokens=1), tests).collect()
        assert {(r.doc_id, r.item_id) for r in got} == expected
    spans = {(r.doc_id, r.item_id): (r.doc_token, r.tokens, r.item_token, r.matching) for r in decontam.overlaps(docs_of(spark, texts), tests).collect()}
    assert spans[(0, 7)] == (50, 40, 0, 40) and spans[(1, 7)] == (10, 15, 5, 15)
    assert decontam.contaminated(docs_of(spark, texts), tests.limit(0)).count() == 0
    assert decontam.contaminated(docs_of(spark, texts).limit(0), tests).count() == 0


def test_decontamination_equals_ngram_search(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = {}
    for r in bench.collect():
        w = split(r.text)
        for i in range(len(w) - 12):
            grams.setdefault(tuple(w[i : i + 13]), set()).add(r.item_id)
    expected = set()
    for r in docs.collect():
        w = split(r.text)
        expected |= {(r.doc_id, x) for i in range(len(w) - 12) for x in grams.get(tuple(w[i : i + 13]), ())}
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()} >= expected


def test_longer_edited_leak_is_found(spark):
    """Copying more of an item, with edits, doesn't hide the part that is a leak by itself."""
    item = [f"i{n}" for n in range(55)]
    edited = item[:13] + [w if n % 7 > 1 else f"x{n}" for n, w in enumerate(item[13:])]
    docs = docs_of(spark, [" ".join(item[:13]), " ".join(edited), " ".join(["before"] * 9 + edited + ["after"] * 9)])
    got = {r.doc_id: r for r in decontam.overlaps(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}
    assert set(got) == {0, 1, 2} and got[0].matching == 13 and got[2].doc_token == 9
    assert all(r.matching >= 13 and r.matching >= 0.8 * r.tokens for r in got.values())


def valid_segments(same, need):
    """(begin, end, matching) of all segments that meet the rule, tried one by one."""
    out = []
    for b in np.flatnonzero(same):
        for e in np.flatnonzero(same[b:]) + b + 1:
            n = int(same[b:e].sum())
            if n >= need and 5 * n >= 4 * (e - b):
                out.append((int(b), int(e), n))
    return out


def stretches_of(segments):
    """{(begin, end): most matching} of the unions of segments that meet."""
    out = []
    for b, e, n in sorted(segments):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e), max(out[-1][2], n))
        else:
            out.append((b, e, n))
    return {(b, e): n for b, e, n in out}


def test_segments_equal_all_segments():
    rng = np.random.default_rng(10)
    for _ in range(300):
        same = rng.random(rng.integers(1, 60)) < rng.choice([0.3, 0.6, 0.75, 0.9])
        need = int(rng.choice([1, 5, 13]))
        rule = valid_segments(same, need)
        found = list(zip(*(x.tolist() for x in decontam._segments(same, need)), strict=True))
        assert set(found) <= set(rule) and stretches_of(found) == stretches_of(rule)


def brute_overlaps(doc, item):
    """{(begin, end): most matching} of one text and one item, over every diagonal that any mask hits."""
    a, b = (re.findall(r"[^\W_]+", t.lower()) for t in (doc, item))
    if not a or not b:
        return {}
    masks = [m for m in decontam.MASKS if len(m) <= len(b)] + (["1" * len(b)] if len(b) < min(map(len, decontam.MASKS)) else [])
    segments = []
    for shift in range(1 - len(b), len(a)):
        low, high = max(0, -shift), min(len(b), len(a) - shift)
        same = np.array([a[i + shift] == b[i] for i in range(low, high)])
        if any(all(same[at + j] for j, bit in enumerate(m) if bit == "1") for m in masks for at in range(len(same) - len(m) + 1)):
            segments += [(s + low + shift, e + low + shift, n) for s, e, n in valid_segments(same, min(decontam.MIN_TOKENS, len(b)))]
    return stretches_of(segments)


def test_overlaps_equal_brute_force(spark, monkeypatch):
    """No stretch is missing and none is made up: substitutions, two parts of one diagonal, repetitive texts and items."""
    rng = random.Random(12)
    fresh = lambda n, v: [f"w{rng.randrange(v)}" for _ in range(n)]
    items = [fresh(60, 500), fresh(40, 500), ["ha"] * 30, ["yes", "no"] * 20, fresh(45, 2), fresh(5, 500), (fresh(7, 50) * 6)[:40], ["lone"]]
    docs = []
    for _ in range(45):
        doc = fresh(rng.randint(0, 20), 500)
        for _ in range(rng.randint(1, 3)):
            part = list(rng.choice(items))
            at = rng.randrange(len(part))
            part = part[at:] if rng.random() < 0.3 else part[: at + 1] if rng.random() < 0.3 else part
            doc += [w if rng.random() > rng.choice([0, 0.1, 0.25]) else f"x{rng.randrange(99)}" for w in part * rng.choice([1, 1, 2])] + fresh(rng.randint(0, 25), 500)
        docs.append(doc)
    docs += [items[0][:20] + fresh(30, 500) + items[0][50:] + items[0][20:34], ["ha"] * 200, ["yes", "no"] * 90, fresh(150, 2), [], ["lone"]]
    texts = [" ".join(d) for d in docs]
    tests = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    expected = {(d, i, b, e - b): n for d, t in enumerate(texts) for i, x in enumerate(items) for (b, e), n in brute_overlaps(t, " ".join(x)).items()}
    for pairs in (decontam.PAIRS, 7):
        monkeypatch.setattr(decontam, "PAIRS", pairs)
        got = decontam.overlaps(docs_of(spark, texts), tests).collect()
        assert {(r.doc_id, r.item_id, r.from_token, r.stretch_tokens): r.matching for r in got} == expected and len(got) == len(expected)
        for r in got:  # the segment told meets the rule itself
            same = [x == y for x, y in zip(docs[r.doc_id][r.doc_token : r.doc_token + r.tokens], items[r.item_id][r.item_token : r.item_token + r.tokens], strict=True)]
            assert sum(same) == r.matching and 5 * r.matching >= 4 * r.tokens and same[0] and same[-1]
            assert r.from_token <= r.doc_token and r.doc_token + r.tokens <= r.from_token + r.stretch_tokens
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs_of(spark, texts), tests).collect()} == {k[:2] for k in expected}


@pytest.mark.parametrize("words", [["ha"], ["yes", "no"], list("abcdefghij")])
def test_repetitive_text_is_cheap(words):
    import time
    import tracemalloc

    index = decontam.Index([1], [" ".join((words * 1000)[:1000])])
    data = (" ".join((words * 20_000)[:20_000])).encode()
    w = decontam.words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), "alnum")
    tracemalloc.start()
    began = time.perf_counter()
    got = list(index.overlaps(w.hash, w.text))
    seconds, peak = time.perf_counter() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(x[2], x[3], x[7]) for x in got] == [(0, 20_000, 1000)]
    assert seconds < 5 and peak < 200e6


def test_decontamination_on_odd_input(spark, odd):
    """Repeated rows are reported each, null ids and texts don't stop it, long text is read whole, extra columns don't matter."""
    end = odd.filter("doc_id = 4").first().text.split()[-40:]
    tests = spark.createDataFrame([(1, " ".join(end), 5), (1, " ".join(end), 5), (2, None, 5), (3, " ", 5), (4, "alpha beta gamma", 5)], "item_id long, text string, doc_id int").withColumn("tokens", F.lit("x"))
    got = decontam.overlaps(odd, tests).collect()
    assert [r.from_token + r.stretch_tokens for r in got if r.item_id == 1 and r.doc_id == 4 and r.matching == 40] == [60_000] * 2
    assert any(r.doc_id is None and r.item_id == 4 for r in got) and not any(r.doc_id in (0, 1, 2, 3, 5) for r in got)
    assert decontam.contaminated(odd, tests).filter("doc_id = 4 and item_id = 1").count() == 1


# --- 6: chat


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "&l &a &b & <", "", None, "a\nb", "😀" * 3]
    rows = [(c, t, "assistant" if t % 2 else "user", nasty[(c + t) % len(nasty)]) for c in range(9) for t in range(c * 3 + 1)] + [(50, 0, "assistant", "x"), (50, 0, "assistant", "x"), (None, 1, None, "y"), (None, 0, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.formatted(chat.chain(df))
    got = {r.tree: (tuple(map(tuple, r.turns)), r.loss_text) for r in chat.read_back(made).collect()}
    expected = {}
    for c in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: r[1])]
        expected["-" if c is None else f"c{c}"] = (tuple(own), "".join(t for role, t in own if role == "assistant"))
    assert got == expected
    for r in made.collect():
        assert "[INST]" not in r.conversation and "</s>" not in r.conversation
        assert r.conversation.count(chat.TURN) == r.conversation.count(chat.END)
    assert chat.formatted(chat.chain(df.limit(0))).count() == 0


def test_reply_trees(spark):
    m = spark.createDataFrame([("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 1.0), ("t", 3, 1, "assistant", "good", 2.0), ("t", 4, 2, "user", "more", 5.0), ("t", 5, 3, "user", "thanks", 1.0), ("u", 1, 99, "user", "orphan", 0.0), ("v", 1, 2, "user", "loop", 0.0), ("v", 2, 1, "user", "loop", 0.0)], "tree string, id long, parent long, role string, text string, score double")
    best = {(r.tree, r.leaf): [t.text for t in r.turns] for r in chat.read_back(chat.formatted(m)).join(chat.formatted(m).select("tree", "leaf"), "tree").collect()}
    assert best == {("t", 4): ["q", "bad", "more"], ("u", 1): ["orphan"]}
    two = chat.formatted(m, branches=2).filter("tree = 't'").orderBy("leaf").collect()
    assert [r.leaf for r in two] == [4, 5]


# --- 7: reputation


def test_url_parts(spark):
    urls = ["http://A.Example.com/en/1?x=/y#z", "https://m.x.net", "x", None, "http://h?q/p", "http://h#f/p", "a://b://c/d", "http:///p", "http://É.com/É"]
    got = [(r[0], r[1]) for r in spark.createDataFrame([(u,) for u in urls], "url string").select(reputation.url_host(F.col("url")), reputation.url_path(F.col("url"))).collect()]
    assert got == [("a.example.com", "/en/1"), ("m.x.net", ""), ("", ""), ("", ""), ("h", ""), ("h", ""), ("b:", "//c/d"), ("", "/p"), ("É.com", "/É")]


@pytest.mark.parametrize("url,rule,verdict", [("http://com/x", "com/", "allow"), ("http://x.com", None, "allow"), ("http://example.com/en/", "example.com/en/", "block"), ("http://www.example.com/en/2", "www.example.com/en/", "allow"), ("http://notexample.com/en/2", "com/", "allow"), ("http://a.b.net/es/", "net/es/", "block"), ("http://a.b.net/de/", None, "allow"), ("http://a.www.example.com/en/x", "www.example.com/en/", "allow")])
def test_rules(spark, url, rule, verdict):
    pages = spark.createDataFrame([(1, url)], "page_id long, url string")
    r = reputation.judge(pages, spark.createDataFrame([], "doc_id long, bad int")).first()
    assert (r.rule, r.verdict) == (rule, verdict)


def test_reputation_shrinks(spark):
    rows = [(i, f"http://h{i % 40}.good.org/x") for i in range(800)] + [(1000 + i, f"http://h{i % 5}.bad.org/x") for i in range(300)] + [(2000, "http://new.bad.org/"), (2001, "http://new.good.org/"), (2002, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("mean", F.lit(1))
    bad = spark.createDataFrame([(i, int(i >= 1000 or i % 17 == 0)) for i, _ in rows[:1100]] + [(None, 1)], "id long, bad int")
    got = {r.page_id: r.verdict for r in reputation.judge(pages, bad).collect()}
    assert len(got) == len(rows)
    assert {got[i] for i in range(800)} == {"allow"} and {got[i] for i in range(1000, 1300)} == {"block"}
    assert got[2001] == "allow" and got[2002] == "allow"
    assert reputation.judge(pages.limit(0), bad).count() == 0


def test_domains(spark):
    hosts = ["a.co.uk", "x.a.co.uk", "b.co.uk", "user@a.org:8080", "m.a.org", "org", "10.0.0.1:80", "[::1]", "", "co.uk"]
    got = [tuple(r) for r in spark.createDataFrame([(h,) for h in hosts], "host string").select(*reputation.hierarchy(F.col("host"))).collect()]
    assert got == [("a.co.uk", "a.co.uk", "co.uk"), ("x.a.co.uk", "a.co.uk", "co.uk"), ("b.co.uk", "b.co.uk", "co.uk"), ("a.org", "a.org", "org"), ("m.a.org", "a.org", "org"), ("org", "org", "org"), ("10.0.0.1", "10.0.0.1", "(address)"), ("[::1]", "[::1]", "(address)"), ("", "", ""), ("co.uk", "co.uk", "co.uk")]


def test_pages_without_url_have_the_prior(spark):
    """Bad pages without a url don't make a host of their own; very long urls and clashing columns do no harm."""
    rows = [(i, None if i < 50 else f"http://u:p@h{i % 7}.good.co.uk:80/{'x' * (100_000 if i == 60 else 3)}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "mean", "low", "bare", "n", "k", "rule", "verdict", "suffix")})
    bad = spark.createDataFrame([(i, int(i < 50)) for i in range(400)] + [(5, 1)] * 3, "id long, bad int")
    got = {r.page_id: r for r in reputation.judge(pages, bad).collect()}
    assert len(got) == 400 and {r.verdict for r in got.values()} == {"allow"}
    assert got[3].bad_share == pytest.approx((50 + 3 + 1) / (400 + 3 + 2), abs=1e-5) and got[60].bad_share < 0.05


# --- 9: language


def test_language(spark, sf):
    """Rows that the model wasn't fitted on, by all evidence and by the text alone."""
    found = language.identify_documents(spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")).filter(common.fold("doc_id", language.FOLDS) == language.HELD_OUT)
    right = found.agg(F.avg((F.col("lang") == F.col("lid_lang")).cast("int")), F.avg((F.col("lang") == F.col("lid_text_lang")).cast("int")), F.avg(F.col("lid_keep").cast("int"))).first()
    assert right[0] > 0.99 and right[1] > 0.97 and right[2] > 0.99


def test_language_sample_is_bounded(spark):
    """Copies don't enlarge the sample, and a rare language has all its texts in it."""
    rows = [("copy of one text", "en")] * 20_000 + [(f"text number {i}", "en") for i in range(20_000)] + [(f"texte {i}", "fr") for i in range(30)]
    df = spark.createDataFrame(rows, "text string, label string")
    sample = common.bounded_sample(df, 4_000, language.SEED, ["en", "fr"]).to_pylist()
    assert 900 < len(sample) <= 4_000 and sum(r["label"] == "fr" for r in sample) == 30
    assert "fr" in language.fit_text_model(df, "text", "label").languages


def test_fusion_equals_the_formula(spark):
    """Posteriors row by row: priors from all to suffix to host, declared likelihoods, each without the row itself."""
    rng, words_of = random.Random(13), {"aa": "mura kilo tane", "bb": "strelf gronk plim"}
    rows = []
    for i in range(60):
        lang = rng.choice(["aa", "bb"])
        words = words_of[lang if rng.random() < 0.9 else "aa"].split()
        rows.append((i, " ".join(rng.choices(words, k=rng.randint(1, 4))) if i % 15 else "", lang if i % 3 else None, rng.choice(["h1", "h2", None]) if lang == "aa" else "h3", rng.choice(["x", "y", None])))
    df = spark.createDataFrame(rows, "id int, text string, declared string, host string, suffix string")
    model = language.fit_text_model(df, "text", "declared")
    got = {r.id: r for r in language.identified(df, model, F.col("text"), F.col("declared"), F.col("host"), F.col("suffix")).collect()}
    size = len(model.languages)
    best = {}
    for i, text, *_ in rows:
        raw = text.encode()
        mean, n = model.likelihoods(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        best[i] = (int(mean[0].argmax()) if n[0] else size - 1, mean[0], int(n[0]))
    kinds = 1 + len({r[2] for r in rows} - {None})
    for i, _, declared, host, suffix in rows:
        others = [r for r in rows if r[0] != i]
        count = lambda keep: np.bincount([best[r[0]][0] for r in others if keep(r)], minlength=size).astype(float)  # noqa: B023, E731
        total = count(lambda r: True)
        prior = total + 1
        prior[-1] = 0
        prior = prior / prior.sum() * (1 - language.UND_PRIOR)
        prior[-1] = language.UND_PRIOR
        for k, value in ((4, suffix), (3, host)):
            own = count(lambda r: value is not None and r[k] == value)  # noqa: B023
            prior = (own + prior * language.HOST_ROWS) / (own.sum() + language.HOST_ROWS)
        log = best[i][1] * min(best[i][2], language.EVIDENCE) + np.log(prior)
        if declared is not None:
            likely = (count(lambda r: r[2] == declared) + language.DECLARED_ROWS / kinds) / (total + language.DECLARED_ROWS)  # noqa: B023
            likely[-1] = 1 / kinds
            log = log + np.log(likely)
        p = np.exp(log - log.max())
        p /= p.sum()
        assert got[i].lid_posterior == pytest.approx(p.max() if best[i][2] else 1.0, abs=1e-5)
        assert got[i].lid_lang == model.languages[int(p.argmax()) if best[i][2] else size - 1]


def test_language_evidence(spark, sf):
    docs = spark.read.parquet(sf + "/documents.parquet")
    model = language.fit_text_model(docs, "text", "lang")
    rows = [("", "en", "h"), (None, None, None), ("日本語のテキストです。これは長い文章です。", "en", "h"), ("12345 !!!", "fr", "h"), ("the and of that with this from", None, None)]
    got = language.identified(spark.createDataFrame(rows, "text string, declared string, host string").withColumn("lid_lang", F.lit(1)), model, F.col("text"), F.col("declared"), F.col("host")).collect()
    assert [r.lid_lang for r in got] == ["und", "und", "und", "und", "en"]
    assert [r.lid_keep for r in got] == [False] * 4 + [True]


def test_host_decides_where_text_is_unclear(spark):
    table = np.full((3, 1 << language.BITS), -12.0)
    table[2] = language.UND_LOG
    gram = lambda t: language.byte_ngrams(np.frombuffer(t.encode(), np.uint8), np.array([0, 3]), 3, language.BITS)[0][0]
    table[0, gram("aaa")] = table[1, gram("bbb")] = -1.0
    table[0, gram("ccc")], table[1, gram("ccc")] = -2.0, -2.5
    model = language.TextModel(["aa", "bb", language.UND], table)
    rows = [("ccc", "h", "x"), ("ccc", None, "x"), ("ccc", "new", "y")] + [("bbb", "h", "x")] * 30 + [("aaa", "g", "y")] * 30 + [("bbb", "k", "y")]
    got = language.identified(spark.createDataFrame(rows, "text string, host string, suffix string").coalesce(1), model, F.col("text"), None, F.col("host"), F.col("suffix")).collect()
    assert [r.lid_lang for r in got[:3]] == ["bb", "bb", "aa"]  # by host, by suffix (mostly bb), by suffix (mostly aa)
    assert [r.lid_text_lang for r in got[:3]] == ["aa", "aa", "aa"]


def test_language_on_odd_input(spark, odd):
    got = language.identify_documents(odd)
    assert got.count() == odd.count()
    assert language.identify_documents(odd.limit(0)).count() == 0


# --- 10: winnowing


def brute_fingerprint(text, k=winnow.K, w=winnow.W):
    p = [ord(c) for c in text]
    if not p:
        return []
    k = min(k, len(p))
    hashes = []
    for i in range(len(p) - k + 1):
        total = sum(p[i + j] * int(winnow._FACTORS[j]) for j in range(k)) + k
        hashes.append(int(winnow.mix64(np.array([total % 2**64], np.uint64))[0]) >> 32 + winnow.GAP_BITS)
    w, out = min(w, len(hashes)), []
    for i in range(len(hashes) - w + 1):
        low = min(hashes[i : i + w])
        at = max(j for j in range(i, i + w) if hashes[j] == low)
        if not out or out[-1] != (at, low):
            out.append((at, low))
    return out


@pytest.mark.parametrize("text", ["", "a", "abcabcabc", "abcdefghij", "a" * 130, "the quick brown fox jumps over the lazy dog " * 9 + "é😀x"])
def test_winnowing(text):
    positions, hashes = winnow.fingerprint(winnow._points(text))
    assert list(zip(positions.tolist(), hashes.tolist(), strict=True)) == brute_fingerprint(text)
    back = winnow.decoded(winnow.encoded(positions, hashes))
    assert back[0].tolist() == positions.tolist() and back[1].tolist() == hashes.tolist()


def test_match_guarantee():
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(30):
        shared = word(winnow.K + winnow.W - 1)
        a, b = (set(winnow.fingerprint(winnow._points(word(rng.randrange(200)) + shared + word(rng.randrange(200))))[1].tolist()) for _ in range(2))
        assert a & b


@pytest.mark.parametrize("range_rows", [3, 1000])
def test_successors_and_edits(spark, monkeypatch, range_rows):
    monkeypatch.setattr(winnow, "RANGE_ROWS", range_rows)
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdé😀 ") for _ in range(rng.choice([0, 1, 7, 90, 400]))) for _ in range(25)] + [None]
    ids = rng.sample(range(1000), 26)
    rows = sorted(zip(ids, texts, strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in winnow.compared(df).collect()}
    assert len(got) == 26
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, nxt = t or "", nxt or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        f, e, n = ({h for _, h in brute_fingerprint(x)} for x in (t, edited, nxt))
        jaccard_of = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].near_edited == pytest.approx(jaccard_of(f, e)) and got[i].near_next == pytest.approx(jaccard_of(f, n))


def test_successors_of_rows_without_own_ids(spark, monkeypatch):
    """A third of the rows without an id, a third with one id: they follow each other by text, and are spread over ranges."""
    monkeypatch.setattr(winnow, "RANGE_ROWS", 4)
    rng = random.Random(15)
    text = lambda: "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 60)))
    rows = [(None, text()) for _ in range(40)] + [(7, text()) for _ in range(40)] + [(i, text()) for i in range(20, 60)] + [(7, "same")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    dealt = winnow.with_successors(df)
    assert dealt.filter("halo = 0").groupBy("range").count().agg(F.max("count")).first()[0] < 40
    assert dealt.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected = []
    for (i, t), (_, nxt) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        expected.append((str(i), hashlib.sha256((t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in winnow.compared(df).collect()) == sorted(expected)


def test_edited_short_texts_stay_like(spark, monkeypatch):
    """Half of a text of 20 code points holds a hash that is certain to be kept."""
    monkeypatch.setattr(winnow, "OUT_CHARS", 3_000)  # several batches
    rng = random.Random(11)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé😀   ") for _ in range(n)) for n in [*range(20, 121)] * 2]
    got = winnow.compared(docs_of(spark, texts)).collect()
    assert len(got) == len(texts) and min(r.near_edited for r in got) > 0


def test_winnowing_on_odd_input(spark, odd):
    assert winnow.compared(odd).count() == odd.count()
    assert winnow.compared(odd.limit(0)).count() == 0
    assert winnow.compared(odd.filter("doc_id = 3")).first().near_next == 1.0


def test_registered_queries_keep_their_columns(spark, sf):
    for name, f in q.QUERIES.items():
        assert f(spark, sf).columns[0] in ("doc_id", "conv_id", "page_id"), name


def test_fingerprints_are_short_and_ids_are_integers(spark):
    text = " ".join(random.Random(9).choices(WORDS, k=3_000))
    found = winnow.encoded(*winnow.fingerprint(winnow._points(text)))
    assert len(found) < 2 * len(text)
    with pytest.raises(TypeError):
        winnow.compared(docs_of(spark, ["a"]).withColumn("doc_id", F.lit("x")))
    with pytest.raises(ValueError):
        winnow.fingerprint(winnow._points(text), w=1 << winnow.GAP_BITS)


# --- 2: stored prefix counts


MARKED = ["a", "e", "E", "s", "t", "r", "v", "l", "'", "'re", "\u2019", "\u0301", "\u0308", "\u0323", "\u0327", "\u00e9", "\u0130", "\u00df", "\u03a3", "1", "\u00b2", "!", "-", "\U0001f642", "\u200d", "\u65e5", "\u304b", "\u3099", "\u1100", "\u1161", "\u11a8", "\u00a0", "\u3000", "<", "|", "<|endoftext|>", "<|start", "\u09c7", "\u09be", "\u0344", "\x1f", "\x85", "the", "tion"]


def test_prefix_counts_of_marked_letters_are_the_librarys():
    path = public_tokenizers.path(tokens.VOCABULARY)
    library, counter, rng = Tokenizer.from_file(path), tokens.PrefixCounter(path), random.Random(21)
    runs = ["e\u0301" * 3, "x\u0302' re'", *["".join(rng.choice(MARKED) for _ in range(rng.randrange(1, 14))) for _ in range(3_000)]]
    for run in runs:
        want = [len(library.encode(run[:j], add_special_tokens=False).ids) for j in range(1, len(run) + 1)]
        assert counter._run_counts(run) == want, repr(run)
        assert counter.run_counts(run)[-1] == counter.run_count(run)


def test_prefix_counts_take_one_pass():
    """Ten times the letters with marks take about ten times the time, not a hundred times."""
    import time

    counter = tokens.PrefixCounter(public_tokenizers.path(tokens.VOCABULARY))
    counter.run_counts("e\u0301x\u0302" * 100)
    took = []
    for n in (2_000, 20_000):
        began = time.process_time()
        assert len(counter.run_counts("e\u0301x\u0302" * n)) == 4 * n
        took.append(time.process_time() - began)
    assert took[1] < 30 * took[0] + 0.5


def test_truncation_in_the_counting_pass(spark):
    """truncate_chars is what the stored table of every prefix says, on texts with and without white space."""
    rng = random.Random(5)
    texts = [None, "", "  lead", "".join(rng.choices(["e\u0301", "\u65e5", "ing", "'re"], k=60)), *[" ".join("".join(rng.choices(MARKED, k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 12))) + " \n" * (i % 3) for i in range(60)]]
    docs = docs_of(spark, texts, truncate_chars="clash")
    for budget in (0, 1, 7, 30):
        found = tokens.counted(docs, budget=budget).select("doc_id", "truncate_chars", "text", "n_tokens")
        table = tokens.prefix_table(found).select("doc_id", "truncate_chars", tokens.longest_within(F.col("prefix_tokens"), F.lit(budget)).alias("want"), F.size("prefix_tokens").alias("chars"), "n_tokens")
        for r in table.collect():
            assert r.truncate_chars == (r.chars if r.n_tokens <= budget else r.want), r


# --- 9: pages


def old_markup(html):
    bare = re.sub(r"(?is)<(script|style|nav)\b.*?</\1\s*>|<!--.*?-->", " ", html, flags=re.ASCII)
    m = re.search(r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", html, flags=re.ASCII)
    return re.sub(r"(?s)<[^>]*>", " ", bare), m.group(1).lower() if m else None


def test_markup_is_read_as_by_patterns():
    rng = random.Random(6)
    parts = ["<script>", "</script>", "<SCRIPT src=x>", "</script >", "<style>", "</style>", "<nav>", "</nav>", "<navy>", "<!--", "-->", "<!-->", "<p>", "</p>", "<", ">", "text ", "<html", ' lang="de"', " lang = FR", " xml:lang='es-MX'", "lang=e", "slang=it", "\n", "é"]
    for _ in range(4_000):
        html = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert (language.without_markup(html), language.declared_language(html)) == old_markup(html), repr(html)


def test_unclosed_tags_take_one_scan():
    import time

    for unit in ("<script>", "<!--", "<", "<html ", "<html lang ", "<style><nav>"):
        html, began = unit * (1_000_000 // len(unit)), time.process_time()
        language.without_markup(html)
        language.declared_language(html)
        assert time.process_time() - began < 2, unit


def test_pages_name_their_language(spark, sf):
    """Evidence of pages, with nulls and a page of unclosed tags."""
    labelled = spark.read.parquet(sf + "/documents.parquet")
    text = {r.lang: r.text for r in labelled.filter("length(text) > 800").collect()}
    rows = [(i, f"https://x.{k}/a", f"<html lang='{k}'><script>var the = of;</script><body>{t}") for i, (k, t) in enumerate(sorted(text.items()))]
    pages = spark.createDataFrame([*rows, (90, None, None), (91, "", "<script>" * 50_000), (92, "https://x.de", "")], "page_id int, url string, html string").withColumn("lid_lang", F.lit("clash"))
    got = {r.page_id: r for r in language.identify_pages(pages, labelled).collect()}
    assert [got[i].lid_lang for i in range(len(rows))] == sorted(text) and len(got) == len(rows) + 3
    assert not (got[90].lid_keep or got[92].lid_keep)


# --- 3: rows without ids


def test_rows_without_ids_are_spread(spark):
    docs = spark.createDataFrame([(None, " ".join(["w"] * (i % 400 + 1)), "en", "s", 1) for i in range(9_000)], DOCS)
    sizes = mixing.word_sizes(docs)
    rows = mixing.packed(sizes, mixing.source_targets(sizes))
    assert rows.count() == 9_000 and rows.agg(F.max(F.col("start") + F.col("size"))).first()[0] == sum(i % 400 + 1 for i in range(9_000))
    assert rows.groupBy("start").count().filter("count > 1").count() == 0
