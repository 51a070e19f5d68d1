"""Documents packed into token sequences by harmonic classes (operator 12).

A piece of n ids is in class k when k of them, and not k + 1, fit a sequence: capacity / (k + 1) < n <= capacity / k.
A sequence of class k holds exactly k pieces, so a worker needs one open sequence per class, closes it by
counting, and no two workers ever talk: there is no shuffle, and each input partition is packed by itself.

Kept whole, a piece at the lower end of its class would leave up to half a sequence empty. So a document
whose class would waste more than ``slack`` is cut: a piece of exactly the next class's size goes there, the rest
is classed again. Cuts shrink quickly: what remains of a piece of class k is smaller than capacity / k^2.

Sequences still open when a partition ends are joined end to end and cut at full length; the last one is cut at
powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm.text import table
from layercake.llm.workers import give_back, ship

CAPACITY = 4096
SLACK = 64  # a class may waste a 64th of a sequence
KNOWN_BYTES = 1 << 25  # remembered per worker; beyond that it goes on with the parts of the last call
FEW = 16
BINS_AT_ONCE = 256
BYTES_AT_ONCE = 1 << 24  # of texts, or one text
END = 2
BETWEEN = "\x01"
WORDS_AT_ONCE = 2_000
VISIBLE = "[!-~\u00a1-\u00ff]*"  # Latin-1
LETTERS, DIGITS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"  # of these, lower-case
PART = f"('s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{LETTERS}{DIGITS}]+)"
SHOWN = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}  # how the merges write other bytes

Piece = tuple[object, int, bytes, int]  # key, start, ids, ids of the whole document
visible = re.compile(VISIBLE).fullmatch
_tokenizers: dict[str, WordIds] = {}


class WordIds:
    """A tokenizer that drops white space, with the ids of word parts it has met.

    No token of such a tokenizer reaches over a space or a line end, so a text's ids are those of its words between
    them, one after the other. Arrow cuts the texts, numbers the different words of a call, cuts these as the
    tokenizer does, into letters, single digits and marks, and puts the ids together again; Python meets only parts
    that were not met before, and gives them to the tokenizer's merges.

    Words are cut so if they are of visible Latin-1 characters, where normalizing is lower-casing, and hold no name of
    a token. The whole tokenizer encodes the others uncut, many at once, with a control character as a word of its
    own between them, whose id tells them apart again. (Not even a last comma is cut off there: normalizing may end
    letters in a combining mark, which stays with it.)
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.merge = self.tokenizer.model.tokenize
        (self.between,) = self._ids(BETWEEN)

    def encode(self, texts: Sequence[str] | pa.Array, end: int) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, and ``end``."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, Sequence) else texts.cast(pa.string()), "")
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        each = words.flatten().dictionary_encode()
        ids = self.of_words(each.dictionary).take(each.indices)
        edges = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)
        edges = edges[np.append(0, np.cumsum(words.value_lengths().to_numpy()))].tolist()
        flat, last = memoryview(ids.buffers()[2] or b""), end.to_bytes(4, "little")
        return [b"".join((flat[a:b], last)) for a, b in pairwise(edges)]

    def of_words(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """The ids of each of some different words."""
        whole = pc.invert(pc.match_substring_regex(words, f"^{VISIBLE}$"))
        for name in self.names:
            whole = pc.or_(whole, pc.match_substring(words, name))
        cut = pc.ascii_ltrim(pc.replace_substring_regex(pc.utf8_lower(words), PART, r" \1"), " ")
        parts = pc.split_pattern(pc.if_else(whole, words, cut), " ")
        each = parts.flatten().dictionary_encode()
        ids = self.of_parts(each.dictionary).take(each.indices)
        return pc.binary_join(pa.ListArray.from_arrays(parts.offsets, ids), pa.scalar(b"", pa.large_binary()))

    def of_parts(self, parts: pa.StringArray) -> pa.LargeBinaryArray:
        """The ids of each of some different parts. A few are learned faster than looked up among very many."""
        if len(parts) < len(self.known) // FEW:
            return pa.array(self.learn(parts.to_pylist()), pa.large_binary())
        at = pc.index_in(parts, value_set=self.known)
        new = parts.filter(at.is_null())
        at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).copy()
        at[at < 0] = len(self.known) + np.arange(len(new))
        self.ids = pa.concat_arrays([self.ids, pa.array(self.learn(new.to_pylist()), pa.large_binary())])
        self.known = pa.concat_arrays([self.known, new])
        ids = self.ids.take(pa.array(at))
        if self.known.nbytes + self.ids.nbytes > KNOWN_BYTES:
            self.known, self.ids = parts, ids
        return ids

    def learn(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, by the merges, or by the whole tokenizer if it was not cut."""
        made: dict[str, bytes] = {}
        uncut = []
        for p in parts:
            if not visible(p) or any(name in p for name in self.names):
                if BETWEEN in p:
                    made[p] = self._ids(p).tobytes()
                else:
                    uncut.append(p)
            else:
                shown = p if p.isascii() else p.encode().decode("latin-1").translate(SHOWN)
                made[p] = b"".join([t.id.to_bytes(4, "little") for t in self.merge(shown)])
        for at in range(0, len(uncut), WORDS_AT_ONCE):
            some = uncut[at : at + WORDS_AT_ONCE]
            ids = self._ids(f" {BETWEEN} ".join(some))
            edges = [-1, *np.flatnonzero(ids == self.between).tolist(), len(ids)]
            flat = ids.tobytes()
            made.update(zip(some, [flat[4 * a + 4 : 4 * b] for a, b in pairwise(edges)], strict=True))
        return [made[p] for p in parts]

    def _ids(self, text: str) -> np.ndarray:
        (made,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(made.ids, "<u4")


def word_ids(path: str) -> WordIds:
    """The tokenizer of a file, made once per worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def cuts(length: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document, in order."""
    pieces = [(1, capacity)] * (length // capacity)
    left = length % capacity
    while left:
        k = capacity // left
        if slack * (capacity - k * left) <= capacity:
            pieces.append((k, left))
            break
        pieces.append((k + 1, capacity // (k + 1)))
        left -= capacity // (k + 1)
    return pieces


def last_bins(pieces: Sequence[Piece], capacity: int = CAPACITY) -> list[list[Piece]]:
    """Pieces joined end to end and cut into full sequences, the rest into lengths that are powers of two."""
    total = sum(len(p[2]) // 4 for p in pieces)
    rest = total % capacity
    sizes = [capacity] * (total // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    bins, todo = [], list(reversed(pieces))
    for room in sizes:
        bins.append([])
        while room:
            key, start, ids, whole = todo.pop()
            taken = min(room, len(ids) // 4)
            bins[-1].append((key, start, ids[: 4 * taken], whole))
            if 4 * taken < len(ids):
                todo.append((key, start + taken, ids[4 * taken :], whole))
            room -= taken
    return bins


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    slack: int = SLACK,
    end: int = END,
) -> DataFrame:
    """One row per piece: the key, ``start`` (ids of its document before it), ``length``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in that sequence.

    ``path`` names the tokenizer's file, which every executor can read. Each document's ids end with ``end``, so a
    null or empty text is that id alone. Every id is in one piece, pieces of a sequence follow each other
    without gaps, and no sequence is longer than ``capacity``, a power of two. Repeated rows are packed each
    for itself; an empty table gives no piece; other columns are left out. A worker holds its open
    sequences: fewer than ``capacity`` ids for each of some 130 classes.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    key_type = docs.schema[key].dataType

    def rows(bins: list[list[Piece]], first: int, key_of: pa.DataType) -> pa.RecordBatch:
        pieces = [p for b in bins for p in b]
        lengths = [len(p[2]) // 4 for p in pieces]
        offsets = [o for b in bins for o in accumulate((len(p[2]) // 4 for p in b[:-1]), initial=0)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pieces], key_of),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array([p[2] for p in pieces], pa.binary()),
                pa.array([p[3] for p in pieces], pa.int64()),
                pa.array([first + i for i, b in enumerate(bins) for _ in b], pa.int64()),
                pa.array(offsets, pa.int64()),
            ],
            names=[key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, made = word_ids(path), TaskContext.get().partitionId() << 40
        filling: dict[int, list[Piece]] = {}
        closed: list[list[Piece]] = []
        key_of = None
        for whole in batches:
            key_of = whole.schema.field("_key").type
            before = np.cumsum(pc.fill_null(pc.binary_length(whole.column(1)), 0).to_numpy(zero_copy_only=False))
            steps = np.flatnonzero(np.diff(before // BYTES_AT_ONCE)) + 1
            for at, to in pairwise([0, *steps.tolist(), whole.num_rows]):
                b = whole.slice(at, to - at)
                encoded = tokenizer.encode(b.column(1), end)
                for k, ids in zip(b.column(0).to_pylist(), encoded, strict=True):
                    start = 0
                    for size, length in cuts(len(ids) // 4, capacity, slack):
                        open_bin = filling.setdefault(size, [])
                        open_bin.append((k, start, ids[4 * start : 4 * (start + length)], len(ids) // 4))
                        start += length
                        if len(open_bin) == size:
                            closed.append(filling.pop(size))
                    if len(closed) >= BINS_AT_ONCE:
                        yield rows(closed, made, key_of)
                        made, closed = made + len(closed), []
                del encoded
                give_back()
        closed += last_bins([p for size in sorted(filling) for p in filling[size]], capacity)
        if closed:
            yield rows(closed, made, key_of)

    fields = f"`{key}` {key_type.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return source.mapInArrow(work, fields)


def sequences(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per sequence its ``ids``, ``length`` and the ``documents`` in it, in order. No sequence has more ids than
    the capacity, so neither has a group here."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", F.col(key).alias("document"))))
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), parts.alias("parts"))
        .select(
            "sequence_id",
            "length",
            F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
            F.col("parts.document").alias("documents"),
        )
    )


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
