"""Queries without SQL, over whole tables, against plain loops over the same rows."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import tiktoken
from test_models import base_by_regex

from __spark_entry__ import queries
from layercake.llm import byte_bpe

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


def run(spark, name):
    return {r.doc_id: r for r in queries()[name](spark, FOLDER).collect()}


def test_toxicity(spark, texts):
    got = run(spark, "op1_toxicity")
    assert got.keys() == texts.keys()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_toxicity_of_held_out_rows(spark):
    """On the larger table: the smallest has 19 held-out rows."""
    folder = FOLDER.replace("sf0.001", "sf0.01")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in queries()["op1_toxicity"](spark, folder).collect() if r.held_out and toxic.get(r.doc_id) in (0, 1)]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.9 * len(held)


def test_sharding(spark, texts):
    got = run(spark, "op3_sharding")
    assert got.keys() == texts.keys() and {r.law for r in got.values()} == {"rows"}
    slots = defaultdict(list)
    for d, r in got.items():
        raw = texts[d].encode()
        assert (r.size, r.text_crc32, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), None)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and slots.keys() <= set(range(40))
    counts = [len(slots.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1


def test_ngram_join(spark, texts):
    got, sets = run(spark, "op5_ngram_join"), {}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d, t in texts.items():
        ws = re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower))
        sets[d] = {tuple(ws[i : i + 4]) for i in range(len(ws) - 3)} or ({tuple(ws)} if ws else set())
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders, shared = defaultdict(list), Counter()
    for d, s in sorted(sets.items()):
        for g in s:
            for other in holders[g]:
                shared[other, d] += 1
            holders[g].append(d)
    for (a, b), both in shared.items():
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == {d: (len(sets[d]), root(d)) for d in texts}


def test_pii(spark, texts):
    got = run(spark, "op9_pii")
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        found = base_by_regex(t)
        written = [":".join(map(str, s)) for s in found]
        kinds = Counter(k for k, _, _ in found)
        r = got[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",")) | {""}


def test_byte_bpe(spark, texts):
    path, pattern = byte_bpe.public_vocabulary()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = run(spark, "op10_byte_bpe")
    for d, t in texts.items():
        ids = library.encode_ordinary(t)
        want = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (len(ids), *want)
