"""Periodic runs, packing and collocations against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from layercake.llm import collocations, packing, periodic_runs

CLASH = "doc_id long, text string, lang string, runs string, collapsed string, ids string, start string, a string, rank string"
WORDS = r"[^\x20\x09-\x0D]+"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    """(id, text, language) rows with columns that clash with results."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x") for r in rows], CLASH)


# -- runs ------------------------------------------------------------------------------------------


def brute_runs(x, least=12):
    """Every maximal stretch, by its definition."""
    n, found = len(x), {}
    for q in range(1, n):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng, n):
    x = [rng.randrange(rng.choice([2, 5, 300])) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        p, at = rng.randint(1, 9), rng.randrange(n + 1)
        unit = [rng.randrange(4) for _ in range(p)]
        x[at:at] = (unit * 40)[: rng.randint(p, 40)]
    return x


@pytest.mark.parametrize("seed", range(12))
def test_runs_by_definition(seed):
    rng = random.Random(seed)
    for _ in range(60):
        x = random_words(rng, rng.randrange(120))
        assert periodic_runs.runs_of(x) == brute_runs(x)


def test_runs_of_one_word_and_of_nested_periods():
    assert periodic_runs.runs_of([7] * 20_000) == [(0, 20_000, 1)]
    unit = [1, 1, 1, 2] * 4 + [3]
    x = unit * 3
    assert periodic_runs.runs_of(x) == brute_runs(x)


def test_splitting_ends_when_each_split_takes_one_word():
    """Every split makes one more word rare: the parts are as many as the words."""
    n = 100_000
    x = [w for i in range(n) for w in (i + 1, i)]
    assert periodic_runs.surviving(x) == []
    kept = periodic_runs.surviving([*range(50), *[1, 2] * 10, *range(60, 90)])
    assert kept == [(50, 70)]


def test_collapse(spark):
    texts = ["a b c " * 10 + "end", "x " + "same " * 30, "too short " * 5, "", None, " \t\n", "p q " * 3000, "\u00a0 " * 12]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(0, texts[0], "en"), (None, texts[1], None)]
    made = periodic_runs.collapse_runs(frame(spark, rows))
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in made.collect()]
    assert {"a", "rank", "ids"} <= set(made.columns)
    for (d, t, _), (id_, runs, text) in zip(rows, got, strict=True):
        ws = re.findall(WORDS, t or "")
        want = brute_runs(ws) if len(ws) < 500 else [(0, len(ws), 2)]
        gone = {i for s, n, p in want for i in range(s + p, s + n)}
        assert (id_, runs, text) == (d, want, " ".join(w for i, w in enumerate(ws) if i not in gone))
    assert periodic_runs.collapse_runs(frame(spark, rows).limit(0)).collect() == []


def test_planted_tails(spark):
    rng = random.Random(4)
    rows = [(d, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(60))) if d % 9 else None, "en") for d in range(300)]
    df = frame(spark, rows)
    got = df.select("doc_id", periodic_runs.planted(df.doc_id, df.text).alias("t")).collect()
    for (d, t, _), r in zip(rows, got, strict=True):
        ws, h = re.findall(WORDS, t or ""), zlib.crc32(str(d).encode())
        n, g = len(ws), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
        assert re.findall(WORDS, r.t or "") == ws


# -- packing ---------------------------------------------------------------------------------------

TEXTS = ["Hello, world!", "", None, "l'\u00e9t\u00e9 e\u0301t 's it's\u00a0so", "<|endoftext|> a<|startoftext|>b \x01 c\x01d", "\u4e2d\u6587\u3002 \u03a3\u0391\u03a3. \u0130 1,2",
         "one two " * 9000, "x" * 30_000, "w\x1cv\u2028u\r\n\tz a.b.,c ..d e.. 'll. ,"]


def test_ids_as_the_library_makes_them():
    own, theirs = packing.WordIds(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    texts = [t or "" for t in TEXTS]
    for _ in range(2):  # from memory the second time
        for t, ids in zip(texts, own.encode(texts, 2), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == [*theirs.encode(t, add_special_tokens=False).ids, 2]


def test_each_part_of_a_word_is_merged_once():
    own, theirs = packing.WordIds(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    merged, merge = Counter(), own.merge

    def counted(part):
        merged[part] += 1
        return merge(part)

    def whole(text):
        raise AssertionError(f"the whole tokenizer is asked for {text!r}")

    own.merge, own._ids = counted, whole
    texts = ["a dog, a Dog.", "(dog) DOG!! dog-dog's \u00e9t\u00e9 \u00c9T\u00c9&&& '42'", "Dog (dog) dog"]
    for t in texts:
        (ids,) = own.encode([t], 2)
        assert np.frombuffer(ids, "<u4").tolist() == [*theirs.encode(t, add_special_tokens=False).ids, 2]
    assert merged["dog"] == 1 and set(merged.values()) == {1}


@pytest.mark.parametrize("remembered, few", [(1 << 25, 16), (1 << 25, 1), (0, 16), (2_000, 16)])
def test_ids_of_any_mix_of_characters(monkeypatch, remembered, few):
    monkeypatch.setattr(packing, "KNOWN_BYTES", remembered, raising=False)
    monkeypatch.setattr(packing, "FEW", few, raising=False)
    own, theirs = packing.WordIds(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    rng = random.Random(remembered + few)
    shown = [chr(c) for c in range(0x250)] + list("\u0300\u0301\u0308\u030c\u0327\u0330\u0331\u03a3\u03c3\u1e9e\u212a\u212b\u2028\u3000\u0416\u4e2d\u3042\u0661\u00b2\u037e\ufb01\U0001f600")
    strings = ["'s", "'LL", "'Ve", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>,", "\x01", " ", " ", "\n", "dog", "Stra\u00dfe", "&&", "!", ","]
    texts = [f"a{c}B {c} {c}{c}, J{c}" for c in shown]
    texts += ["".join(rng.choice(shown if rng.random() < 0.4 else strings) for _ in range(rng.randrange(60))) for _ in range(1500)]
    rng.shuffle(texts)
    want = [[*made.ids, 2] for made in theirs.encode_batch_fast(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 300):
        got = own.encode(texts[at : at + 300], 2)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want[at : at + 300]
    assert own.encode([], 2) == [] and own.encode(["", "\n "], 2) == [b"\2\0\0\0"] * 2
    cut = pa.array([None, "x", texts[0], None, texts[1]], pa.large_string()).slice(1)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode(cut, 2)][1:] == [want[0], [2], want[1]]


def test_cuts_fill_their_class():
    for n in range(1, 10_000):
        pieces = packing.cuts(n)
        assert sum(length for _, length in pieces) == n
        assert all(packing.CAPACITY * 63 // 64 <= k * length <= packing.CAPACITY for k, length in pieces)


@pytest.mark.parametrize("partitions", [1, 3])
def test_every_id_is_packed_once(spark, partitions):
    rng = random.Random(partitions)
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(rng.choice(["a", "dog", "ran"]) for _ in range(rng.randrange(1500))), "en") for i in range(400)]
    rows += [(None, "no key", "en"), *[(7, "twice", "en")] * 2]
    pieces = packing.pack(frame(spark, rows).repartition(partitions), TOKENIZER)
    made = pieces.collect()
    encode = Tokenizer.from_file(TOKENIZER).encode
    want = defaultdict(Counter)
    for d, t, _ in rows:
        want[d][b"".join(i.to_bytes(4, "little") for i in [*encode(t or "", add_special_tokens=False).ids, 2])] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in made:
        assert len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for d, texts in want.items():
        if sum(texts.values()) == 1:
            (whole,) = texts
            parts = sorted(by_doc[d], key=lambda r: r.start)
            assert b"".join(r.ids for r in parts) == whole
            assert all(r.doc_tokens == len(whole) // 4 for r in parts)
            assert [r.start for r in parts] == np.cumsum([0, *[r.length for r in parts]])[:-1].tolist()
    assert sum(r.length for r in made) == sum(len(t) // 4 * n for texts in want.values() for t, n in texts.items())
    padding = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        filled = np.cumsum([0, *[r.length for r in parts]]).tolist()
        assert [r.offset for r in parts] == filled[:-1] and filled[-1] <= 4096
        padding += 0 if filled[-1] & (filled[-1] - 1) == 0 else 4096 - filled[-1]
    assert padding < 0.02 * sum(r.length for r in made)
    joined = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    assert {s: (b"".join(r.ids for r in p), [r.doc_id for r in p]) for s, p in by_sequence.items()} == {
        s: (bytes(r.ids), list(r.documents)) for s, r in joined.items()
    }


def test_no_documents_no_pieces(spark):
    assert packing.pack(frame(spark, [(1, "a", "en")]).limit(0), TOKENIZER).collect() == []


# -- collocations ----------------------------------------------------------------------------------


def brute_phrases(rows, longest=3, least=10, top=2000, percent=50):
    counts, total = defaultdict(Counter), Counter()
    upper = {chr(c): chr(c + 32) for c in range(65, 91)}
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", "".join(upper.get(c, c) for c in text or "")):
            ws = re.findall(r"[^ \t]+", piece)
            total[lang] += len(ws)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    made = []
    for lang, f in counts.items():
        frequent = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        best = []
        for p, a in frequent.items():
            inside = any(
                len(q) > len(p) and 100 * n >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, n in frequent.items()
            )
            if not inside:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            made.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(made)


def texts_of(rng, n):
    words = [f"w{i}" for i in range(8)] + ["A", "\u00e9", "\u00c9", "z\u00a0z"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "! ", "\r\n", "; "]
    return [(i, "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "und"])) for i in range(n)]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_by_definition(spark, monkeypatch, longest):
    rng = random.Random(longest)
    rows = texts_of(rng, 150) + [(900, None, "en"), (901, "", "fr"), (902, "only one", "it"), (903, "big deal " * 4000, "es"), *[(904, "new york city", "en")] * 25]
    monkeypatch.setattr(collocations, "SHARD_WORDS", 700)
    made = collocations.collocations(frame(spark, rows).repartition(3), longest=longest, top=40)
    assert sorted(tuple(r) for r in made.collect()) == brute_phrases(rows, longest, top=40)


def test_full_filter_loses_nothing(spark, monkeypatch):
    """With a filter of 64 bits nearly every pair passes; only the work grows."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 6)
    rows = texts_of(random.Random(9), 100)
    assert sorted(tuple(r) for r in collocations.collocations(frame(spark, rows)).collect()) == brute_phrases(rows)


def test_no_documents_no_phrases(spark):
    assert collocations.collocations(frame(spark, [(1, "a", "en")]).limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_index_counts_every_phrase(seed):
    rng = np.random.default_rng(seed)
    ids = np.concatenate([[0], rng.integers(0, 6, 300), [0]]).astype(np.int32)
    ids[rng.integers(1, 300)] = 6
    for found, counts in collocations.phrases(ids, 5, lambda left, right: np.ones(len(left), bool)):
        n = found.shape[1]
        want = Counter(tuple(w) for i in range(len(ids) - n + 1) if all(w := ids[i : i + n].tolist()))
        assert {tuple(p): c for p, c in zip(found.tolist(), counts.tolist(), strict=True)} == want
