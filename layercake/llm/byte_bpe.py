"""Byte-level BPE encoding and decoding with padded numpy matrices (operator 10).

Texts are cut into pieces by the tokenizer's pattern. Pieces that a worker has not met before are put into
matrices of rows of about the same length, one byte per cell. In each round every row looks its
neighbouring pairs up in a hashed table, merges its leftmost pair of minimum rank and closes the gap; rows
without a known pair leave the matrix. Each row stays whole, and nothing is shuffled.

Pieces longer than ``LONG`` bytes are merged one by one in the same way, but all places of the minimum
pair at once where that cannot change the result, so that a text without spaces takes few rounds.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm.text import table, without
from layercake.llm.workers import give_back, ship

NONE = np.int64(1 << 40)  # the rank of a pair that is no token
LONG = 128
ROWS_AT_ONCE = 500
KNOWN_PIECES = 100_000  # remembered per worker; beyond that it starts anew
CHARS_AT_ONCE = 1 << 19
_encoders: dict[tuple[str, str], Encoder] = {}


class PairTable:
    """(left id, right id) -> rank, as an open hash table of numpy arrays."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int64)
        slot, left = self.slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            at, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.keys[at], self.ranks[at] = keys[put], ranks[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; NONE where a side is negative (padding) or the pair is unknown."""
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        keys[((left < 0) | (right < 0)).ravel()] = -2
        slot = self.slots(keys)
        found = self.keys[slot]
        ranks = np.where(found == keys, self.ranks[slot], NONE)
        todo = np.flatnonzero((found != keys) & (found >= 0) & (keys >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            ranks[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return ranks.reshape(left.shape)


class Encoder:
    """A rank file and the pattern that cuts texts into pieces."""

    def __init__(self, path: str, pattern: str):
        lines = [x.split() for x in Path(path).read_bytes().splitlines() if x.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.table = PairTable((left << 32) | right, rank)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def merge_matrix(self, rows: Sequence[bytes], width: int) -> list[np.ndarray]:
        """Token ids of each row; no row is longer than ``width``."""
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        ids = np.full((len(rows), width), -1, np.int64)
        ids[np.arange(width) < lengths[:, None]] = self.bytes[np.frombuffer(b"".join(rows), np.uint8)]
        ranks = self.table.get(ids[:, :-1], ids[:, 1:])
        live, done = np.arange(len(rows)), [None] * len(rows)
        while len(live):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(live)), at]
            over = least >= NONE
            if over.any():
                for row, found in zip(live[over], ids[over], strict=True):
                    done[row] = found[found >= 0]
                keep = ~over
                live, ids, ranks, at, least = live[keep], ids[keep], ranks[keep], at[keep], least[keep]
                if not len(live):
                    break
            each, cells = np.arange(len(live)), np.arange(ids.shape[1])
            ids[each, at] = least
            source = np.minimum(cells + (cells > at[:, None]), ids.shape[1] - 1)
            ids = np.take_along_axis(ids, source, 1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, source[:, :-1].clip(max=ranks.shape[1] - 1), 1)
            ranks[:, -1] = NONE
            after = np.minimum(at + 1, ids.shape[1] - 1)
            ranks[each, np.minimum(at, ranks.shape[1] - 1)] = np.where(
                at < ranks.shape[1], self.table.get(ids[each, at], ids[each, after]), NONE
            )
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.table.get(ids[before, at[before] - 1], ids[before, at[before]])
            if ids.shape[1] > 8 and (used := int((ids >= 0).sum(1).max())) < ids.shape[1] // 2:
                ids, ranks = ids[:, : used + 1], ranks[:, :used]
        return done

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Token ids of one piece, all places of its minimum pair a round if no new pair comes before it."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)]
        ranks = self.table.get(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) < NONE:
            at = np.flatnonzero(ranks == least)
            if len(at) > 1:
                run = np.cumsum(np.r_[True, np.diff(at) > 1])
                place = at - at[np.searchsorted(run, run)]
                at = at[place % 2 == 0]
                merged = np.full(len(at), least)
                nearby = [
                    self.table.get(merged, np.append(ids, -1)[at + 2]),
                    self.table.get(np.append(ids, -1)[at - 1], merged),
                    self.table.get(merged[:1], merged[:1]),
                ]
                if min(x.min() for x in nearby) <= least:
                    at = at[:1]
            ids[at] = least
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids = ids[kept]
            ranks = np.append(ranks, NONE)[kept][:-1]
            at = at - np.arange(len(at))
            for side in (at - 1, at):
                side = side[(side >= 0) & (side < len(ranks))]
                ranks[side] = self.table.get(ids[side], ids[side + 1])
        return ids

    def encode_pieces(self, pieces: Sequence[str]) -> None:
        """Remembers the ids of pieces, as little-endian unsigned 32-bit numbers."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            if (rank := self.ranks.get(raw)) is not None:
                self.known[piece] = rank.to_bytes(4, "little")
            elif len(raw) > LONG:
                self.known[piece] = self.merge_long(raw).astype("<u4").tobytes()
            else:
                buckets.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, rows in buckets.items():
            for i in range(0, len(rows), block := max(64, (1 << 18) // width)):
                part = rows[i : i + block]
                for (piece, _), ids in zip(part, self.merge_matrix([raw for _, raw in part], width), strict=True):
                    self.known[piece] = ids.astype("<u4").tobytes()

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        cut = [self.pieces(t) for t in texts]
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        self.encode_pieces(list(set().union(*cut).difference(self.known)))
        known = self.known.__getitem__
        return [b"".join(map(known, c)) for c in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a file, made once per worker."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def _batches(texts: list[str]) -> Iterator[list[str]]:
    """Lists of some texts; each with some 500,000 characters at most, or one text."""
    part, chars = [], 0
    for t in texts:
        if part and chars + len(t) > CHARS_AT_ONCE:
            yield part
            part, chars = [], 0
        part.append(t)
        chars += len(t)
    yield part


def _mapped(work: Callable[[pa.RecordBatch], dict[str, pa.Array]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                columns = {n: b.column(i) for i, n in enumerate(b.schema.names)} | work(b)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                del columns
                give_back()

    return run


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", with_decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit ids of the whole text) and ``n_tokens``,
    on request also ``decoded``, the bytes that these ids decode to, in the same pass.

    ``path`` names the rank file, which every executor can read. Null counts as empty, and empty texts
    have no ids. Repeated rows are encoded alike. Input columns named like a result are replaced.
    """
    ship(docs.sparkSession)
    df = without(docs, ["ids", "n_tokens", *["decoded"] * with_decoded])

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        tokenizer = encoder(path, pattern)
        column = batch.column(batch.schema.names.index(text))
        ids = [x for part in _batches([t or "" for t in column.to_pylist()]) if part for x in tokenizer.encode(part)]
        made = {"ids": pa.array(ids, pa.binary()), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}
        return made | ({"decoded": pa.array(map(tokenizer.decode, ids), pa.binary())} if with_decoded else {})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_mapped(work), f"{fields}, ids binary, n_tokens long" + ", decoded binary" * with_decoded)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids. Null ids decode to no bytes."""
    ship(encoded.sparkSession)
    df = without(encoded, ["decoded"])

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        tokenizer = encoder(path, pattern)
        column = batch.column(batch.schema.names.index(ids))
        return {"decoded": pa.array([tokenizer.decode(x or b"") for x in column.to_pylist()], pa.binary())}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_mapped(work), f"{fields}, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number of ids, and digests of its ids and of what they decode to."""
    back = encode(docs.select("doc_id", "text"), path, pattern, with_decoded=True)
    return back.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def public_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"), *public_vocabulary())
