"""Trained models, byte BPE and sharding."""

from __future__ import annotations

import base64
import itertools
import math
import random
import re
import warnings
from collections import Counter

import numpy as np
import pytest
import tiktoken

from layercake.llm import byte_bpe, pii, pii_model, sharding, toxicity

PATH, PATTERN = byte_bpe.public_vocabulary()


def test_bpe_equals_the_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    random.seed(4)
    texts = ["", "the cat's 12  \n\n x", "a" * 700, "in" * 300 + "g" * 200, " " * 400, "\U0001f600é" * 90, "<|endoftext|>"]
    texts += ["".join(random.choice("aabtheing é\n1!") for _ in range(300)) for _ in range(60)]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string")
    for r in byte_bpe.decode(byte_bpe.encode(df, PATH, PATTERN), PATH, PATTERN).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "") and r.n_tokens * 4 == len(r.ids)
    assert byte_bpe.encode(df.limit(0), PATH, PATTERN).count() == 0


def base_by_regex(t):
    digits = pii.digits_of
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


def test_base_spans_are_the_patterns():
    random.seed(6)
    for _ in range(5_000):
        t = "".join(random.choice("0123456789..  -()+@ab1c%é") for _ in range(random.randint(0, 60)))
        assert pii.base_spans(t) == base_by_regex(t)
    assert pii.base_spans("4" * 200_000) == []


def test_tagger_gradients():
    rng, model = np.random.default_rng(0), pii_model.Tagger(4)
    ids, tags = rng.integers(0, 100, (3, 6)), np.array([[0, 1, 2, 0, 3, 4], [0, 0, 0, 5, 6, 6], [1, 2, 2, 0, 0, 0]])
    g = model.gradients(ids, tags)[1]
    for name, at in (("x", (0, ids[0, 2], 5)), ("h", (1, 2, 3)), ("o", (1, 1)), ("b", (2,)), ("a", (0, 1)), ("s", (1,))):
        model.p[name][at] += 1e-5
        up = model.gradients(ids, tags)[0]
        model.p[name][at] -= 2e-5
        down = model.gradients(ids, tags)[0]
        model.p[name][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-6


def test_decoding_and_the_sum_over_paths_by_enumeration():
    """Viterbi and the loss against every tag sequence of short windows."""
    rng, model = np.random.default_rng(4), pii_model.Tagger(3)
    ids, k, t = rng.integers(0, 100, (3, 4)), len(pii_model.TAGS), 4
    u, a = model.scores(ids), model.p["a"] + pii_model.allowed()
    paths = np.array(list(itertools.product(range(k), repeat=t)))
    tags = np.zeros((3, t), int)
    totals = []
    for row in range(3):
        each = model.p["s"][paths[:, 0]] + u[row, np.arange(t), paths].sum(1) + a[paths[:, :-1], paths[:, 1:]].sum(1)
        assert model.decode(ids)[row].tolist() == paths[each.argmax()].tolist()
        totals.append(np.log(np.exp(each - each.max()).sum()) + each.max() - each[0])
    assert abs(model.gradients(ids, tags)[0] - np.mean(totals)) < 1e-6


def test_added_spans_overlap_none():
    rng = random.Random(5)
    pieces = ["a.b@c.example.org", "192.0.2.1", "4111 1111 1111 1111", "+1 (555) 555-0100", "x", " ", "a [at] b.org", "192 . 0 . 2 . 7"]
    tagger = pii_model.Tagger(4)
    for _ in range(60):
        text = " ".join(rng.choice(pieces) for _ in range(25))
        base = pii.base_spans(text)
        numbers, rows = pii.tag_windows(text)
        tags = np.array([[rng.randrange(len(pii_model.TAGS)) for _ in range(rows.shape[1])] for _ in rows]) if rng.random() < 0.3 else tagger.decode(rows)
        want = []
        whole = {int(n): w for n, w in zip(numbers, tags[:, pii.EDGE : pii.EDGE + pii_model.STRIDE].tolist(), strict=True)}
        runs = np.split(numbers, np.flatnonzero(np.diff(numbers) > 1) + 1) if len(numbers) else []
        for run in runs:
            for kind, x, y in pii_model.spans_of([z for n in run.tolist() for z in whole[n]]):
                x, y = int(run[0]) * pii_model.STRIDE + x, min(int(run[0]) * pii_model.STRIDE + y, len(text))
                if not any(x < e and s < y for _, s, e in base) and pii.well_formed(kind, text[x:y]):
                    want.append((kind, x, y))
        assert pii.added_spans(text, numbers, tags, base) == want


def test_pii_at_the_edges(spark):
    long = "word " * 30_000 + "a.b@c.example.org " + "7 " * 5_000
    docs = spark.createDataFrame([(1, long, "x", "y"), (1, long, "x", "y"), (2, None, "x", "y"), (3, "", "x", "y")], "doc_id long, text string, spans string, base_spans string")
    model = pii_model.Tagger()
    got = pii.find_pii(docs, model).orderBy("doc_id").collect()
    assert got[0] == got[1] and [tuple(s)[0] for s in got[0].base_spans][:1] == ["email"] and got[0].base_spans[0].start == 150_000
    assert [r.spans for r in got[2:]] == [[], []]
    assert pii.find_pii(docs.limit(0), model).collect() == []


def test_tagger_adds_spans_and_leaves_prose(spark):
    prose = "and the of in that was on it for with as by at from or an be this have not "
    docs = spark.createDataFrame([(i, prose * 4) for i in range(20)] + [(50, None), (51, "mail a.b@c.example.org now")], "doc_id long, text string")
    model = pii.train(docs)
    ids, tags = pii.training_windows([(prose, [])], 200, seed=99)
    assert (model.decode(ids) == tags)[tags > 0].mean() > 0.8
    got = {r.doc_id: r for r in pii.find_pii(docs, model).collect()}
    assert all(not got[i].spans for i in [*range(20), 50])
    assert [tuple(x) for x in got[51].spans] == [("email", 5, 22)]


def test_toxicity_held_out(spark):
    random.seed(8)
    clean = [f"{a}{b}" for a in ("ta", "lo", "mi", "sen", "gra") for b in ("ber", "tion", "ly", "nd", "ou", "est")]
    bad = ["grobnik", "skrantz", "wuffel"]
    rows = []
    for i in range(600):
        words = [random.choice(clean) for _ in range(random.randint(5, 120))]
        if i % 4 == 0:
            words[random.randrange(len(words))] = random.choice(bad)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(9000, None), (9001, ""), (9002, "a grobnikk here")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 5] + [(1, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    held = [r for r in rows if r[0] % 5 == 0]
    assert np.mean([got[r[0]].predicted == r[2] for r in held]) > 0.95
    assert got[9002].predicted == 1 and got[9000].score == got[9001].score


def test_toxicity_without_labels_and_at_the_edges(spark):
    schema = "doc_id long, text string, score string, predicted string, toxic string"
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in [(1, "a b"), (1, "a b"), (2, None), (None, ""), (3, "c " * 50_000)]], schema)
    none = spark.createDataFrame([(1, None), (2, 3)], "doc_id long, toxic int")
    for labels in (none, none.limit(0)):
        got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
        assert len(got) == 5 and len({r.score for r in got}) == 1 and got[0].score < 0.5 and not got[0].predicted
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), none)).collect() == []


def test_toxicity_sample_keeps_its_size(spark):
    """Long rows leave their place to short ones, and copies of a key do not change the model."""
    docs = spark.createDataFrame([(i, "bad word " * (200 if i % 2 else 3) if i < 40 else "good text") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "doc_id long, toxic int")
    few = toxicity.train(docs, labels, sample_rows=20, max_chars=100)
    again = toxicity.train(docs.union(docs).repartition(7), labels.union(labels), sample_rows=20, max_chars=100)
    assert (few.table == again.table).all()
    assert few.scores(["bad word bad word"])[0] > 0.5 > few.scores(["good text"])[0]


def test_toxicity_scores_are_those_of_a_plain_loop():
    rng = random.Random(2)
    model = toxicity.SubwordSoftmax(buckets=512, dim=3)
    for n in (0, 1, 7, 8, 9, 30):
        text = " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(n))
        words = toxicity.words_of(text) or [""]
        vectors = []
        for w in words:
            ids, _ = toxicity.ngrams([w], 512)
            vectors.append(np.mean([model.table[i] for i in ids], axis=0))
        best = 0.0
        for begin, end in zip(*toxicity.windows(len(words)), strict=True):
            logits = np.mean(vectors[begin:end], axis=0) @ model.softmax + model.bias
            best = max(best, math.exp(logits[1]) / np.exp(logits).sum())
        assert abs(model.scores([text])[0] - best) < 1e-5


def test_toxicity_gradients():
    model = toxicity.SubwordSoftmax(buckets=64, dim=3, seed=5)
    model.table, model.softmax = model.table.astype(np.float64), model.softmax.astype(np.float64)
    batch, labels, weights = model._batch(["a bad one here", "fine text"]), np.array([1, 0]), np.ones(2)

    def loss():
        (ids, starts, counts), flat, (begin, end), _, _ = batch
        v = model.vectors(ids, starts, counts)[flat]
        x = np.array([v[b:e].mean(0) for b, e in zip(begin, end, strict=True)]) @ model.softmax + model.bias
        return float(np.mean(np.log1p(np.exp(-(x[:, 1] - x[:, 0]) * (2 * labels - 1)))))

    g = model._gradients(batch, labels, weights, 1.0)
    for name, at in (("softmax", (1, 0)), ("softmax", (2, 1)), ("table", (batch[0][0][0], 1))):
        p = getattr(model, name)
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-4


def test_pieces_hold_every_ngram_of_a_long_word():
    for n in (1, 20, 30, 31, 36, 37, 44, 45, 500):
        word = "".join(chr(0x4E00 + i) for i in range(n))
        got = toxicity.words_of(word)
        assert got == [word] if n <= toxicity.LONGEST else max(map(len, got)) <= toxicity.PIECE
        for k in range(toxicity.SMALLEST, toxicity.LARGEST + 1):
            assert {word[i : i + k] for i in range(n - k + 1)} == {p[i : i + k] for p in got for i in range(len(p) - k + 1)}


@pytest.mark.parametrize(("glue", "n"), [("", 2400), ("，", 600), ("_", 600), ("\u200b", 600)])
def test_toxicity_reads_texts_without_spaces(glue, n):
    rng = random.Random(3)
    clean = ["".join(chr(0x4E00 + rng.randrange(300)) for _ in range(rng.randint(2, 3))) for _ in range(30)]
    bad, texts, labels = ["毒害恶", "骂咒鬼", "蠢猪狗"], [], []
    for i in range(n):
        ws = [rng.choice(clean) for _ in range(rng.randint(30, 120))]
        if i % 3 == 0:
            ws[rng.randrange(25, len(ws))] = rng.choice(bad)
        texts.append(glue.join(ws))
        labels.append(int(i % 3 == 0))
    model = toxicity.SubwordSoftmax().fit(texts[: n * 3 // 4], labels[: n * 3 // 4])
    assert np.mean((model.scores(texts[n * 3 // 4 :]) >= 0.5) == np.array(labels[n * 3 // 4 :])) > 0.95
    prefix = glue.join(clean[:25])
    harmless, toxic = model.scores([prefix, glue.join([prefix, bad[0]])])
    assert harmless < 0.5 and harmless < toxic


@pytest.mark.parametrize("rows", [0, 1, 39, 1000])
def test_shards(spark, rows):
    df = spark.range(rows).withColumnRenamed("id", "shard").repartition(3) if rows else spark.range(0)
    got = sharding.uniform_shards(df.selectExpr("*", "1 AS extra"), 40, block_rows=5).collect()
    slots = Counter(r["shard"] for r in got)
    assert len(got) == rows and (not rows or max(slots.values()) - min(slots.get(s, 0) for s in range(40)) <= 1)
    assert all(sorted(r.slot for r in got if r["shard"] == s) == list(range(n)) for s, n in slots.items())


def test_matrix_has_the_margins():
    sizes = np.array([5, 0, 17, 30, 8])
    rows = [sharding.matrix_row(np.cumsum(sizes), 7, p, 3) for p in range(5)]
    assert [int(r.sum()) for r in rows] == sizes.tolist()
    assert np.sum(rows, 0).tolist() == sharding.shard_sizes(60, 7).tolist()
    big = sharding.draw(np.random.default_rng(1), np.full(40, 10**9), 10**10)
    assert big.sum() == 10**10 and big.max() <= 10**9


@pytest.mark.parametrize(("good", "bad", "n"), [(5, 7, 6), (40, 2, 9), (3, 100, 50), (30, 30, 1)])
def test_draws_follow_the_law(good, bad, n):
    """Chi-square against the counted probabilities."""
    rng, draws = np.random.default_rng(good), 20_000
    seen = np.bincount([sharding.hypergeometric(rng, good, bad, n) for _ in range(draws)], minlength=n + 1)
    want = np.array([math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) * draws for k in range(n + 1)])
    assert seen[want == 0].sum() == 0
    often = want >= 5
    chi = ((seen - want)[often] ** 2 / want[often]).sum()
    assert chi < often.sum() + 6 * math.sqrt(2 * often.sum())


def test_draws_of_very_many_rows():
    rng, total, shards = np.random.default_rng(3), 10**11, 40
    sizes = sharding.shard_sizes(total, shards)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        drawn = np.array([sharding.draw(rng, sizes, total // 4) for _ in range(30)])
    assert (drawn.sum(1) == total // 4).all()
    spread = math.sqrt(total / 4 / shards * (1 - 1 / shards) * 0.75)
    off = (drawn - total / 4 / shards) / spread
    assert abs(off).max() < 6 and abs(off.mean(0)).max() < 5 / math.sqrt(30) and 0.9 < off.std() < 1.1


def test_whole_matrix_has_the_law_of_a_permutation():
    """Two partitions of 3 and 4 rows into two shards: the first cell as often as permutations put it there."""
    counts = np.zeros(4, int)
    for seed in range(6_000):
        counts[sharding.matrix_row(np.array([3, 7]), 2, 0, seed)[0]] += 1
    want = np.array([math.comb(3, k) * math.comb(4, 4 - k) / math.comb(7, 4) for k in range(4)]) * 6_000
    assert ((counts - want) ** 2 / want).sum() < 20
