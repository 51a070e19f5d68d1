"""Personal data by fixed patterns and a character tagger (operator 9).

Patterns find what is written in a standard form. A character-level bidirectional LSTM with CRF transitions
adds what is not: it is trained here, in numpy, on windows around labelled spans, with digits and
separators varied, and then reads overlapping windows of every text. Each character takes its tag from the
window in whose middle it lies, and spans are read off the joined tags, so that window edges do not show.

Every kind holds a digit or an at sign, so the tagger reads the windows with one of these; the others have
no span to find. An added span must be well formed for its kind and overlap no other. Texts are read whole;
scans are linear in the text, and a proposed span is looked up among those of the patterns by bisection.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm.pii_model import KINDS, STRIDE, TAGS, WIDTH, Tagger, spans_of, symbols
from layercake.llm.text import table, without
from layercake.llm.workers import ship

Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)
EDGE = (WIDTH - STRIDE) // 2
WINDOWS_AT_ONCE = 2_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each at sign: to the left, the longest run that a local part may have."""
    found, over, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > over and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        over = m.end() if m else at + 1
        if m:
            found.append(("email", start, over))
        at = text.find("@", over)
    return found


def base_spans(text: str) -> list[Span]:
    """The spans of all patterns, by kind as listed and then by start; overlaps between kinds stay."""
    if not TRIGGER.search(text):
        return []
    found = emails(text) if "@" in text else []
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x[-4:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = digits_of(m[0]) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def well_formed(kind: str, text: str) -> bool:
    """Whether a span that the tagger proposes can be what it says."""
    digits = digits_of(text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 ./-]", text)
    if kind == "phone":
        return 9 <= len(digits) <= 15 and not re.search(r"[^0-9+ ()./-]", text) and bool(re.search(r"[ ()./-]", text))
    if kind == "ip":
        parts = [digits_of(x) for x in re.split(r"[^0-9]+", text.strip("[]() "))]
        return len(parts) == 4 and all(x and len(x) <= 3 and int(x) <= 255 for x in parts)
    return bool(re.fullmatch(r"[\w.%+-]+\s?(?:@|[\[(]at[\])])\s?[\w-]+(?:\s?(?:\.|[\[(]dot[\])])\s?[\w-]+)+", text, re.I | re.A))


def tag_windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Window numbers, and the symbols of each; window k has the characters k * STRIDE - EDGE and on."""
    hits = np.fromiter((m.start() for m in TRIGGER.finditer(text)), np.int64)
    if not len(hits):
        return hits, np.zeros((0, WIDTH), np.int64)
    last = (hits + EDGE) // STRIDE
    numbers = np.unique(np.concatenate([last, last - 1, last - 2]))
    numbers = numbers[(numbers >= 0) & (numbers * STRIDE < len(text))]
    padded = np.pad(symbols(text), (EDGE, WIDTH))
    return numbers, padded[numbers[:, None] * STRIDE + np.arange(WIDTH)]


def added_spans(text: str, numbers: np.ndarray, tags: np.ndarray, base: Sequence[Span]) -> list[Span]:
    """Spans of the joined tags that are well formed and overlap no span so far."""
    whole: dict[int, list[int]] = {int(n): t for n, t in zip(numbers, tags[:, EDGE : EDGE + STRIDE].tolist(), strict=True)}
    taken, found = sorted((s, e) for _, s, e in base), []
    starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max, initial=0))
    runs = np.split(numbers, np.flatnonzero(np.diff(numbers) > 1) + 1) if len(numbers) else []
    for run in runs:
        joined = [t for n in run.tolist() for t in whole[n]]
        at = int(run[0]) * STRIDE
        for kind, start, end in spans_of(joined):
            s, e = at + start, min(at + end, len(text))
            if reach[bisect_left(starts, e)] <= s and well_formed(kind, text[s:e]):
                found.append((kind, s, e))
    return found


def tagged(model: Tagger, texts: Sequence[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text; windows of many texts are decoded together."""
    bases, cut = [base_spans(t) for t in texts], [tag_windows(t) for t in texts]
    rows = np.concatenate([w for _, w in cut]) if cut else np.zeros((0, WIDTH), np.int64)
    parts = [model.decode(rows[i : i + WINDOWS_AT_ONCE]) for i in range(0, len(rows), WINDOWS_AT_ONCE)]
    tags = np.concatenate(parts) if parts else np.zeros((0, WIDTH), np.int64)
    ends = np.cumsum([len(n) for n, _ in cut])
    return [
        (base, added_spans(text, numbers, tags[end - len(numbers) : end], base))
        for text, base, (numbers, _), end in zip(texts, bases, cut, ends, strict=True)
    ]


# Labelled spans for kinds that a sample may lack.
SEEDS = {
    "email": ["jo.doe@mail.example.com", "a_b+c@host-1.example.org"],
    "ip": ["192.0.2.17", "203.0.113.250"],
    "card": ["4111 1111 1111 1111", "5500-0000-0000-0004"],
    "phone": ["+1 (555) 555-0100", "+44 20 7946 0958"],
}


def varied(rng: np.random.Generator, kind: str, span: str) -> str:
    """Another span of the same kind: other digits and letters, sometimes another way of writing it."""
    def pick(options: str) -> str:
        return options[rng.integers(len(options))]

    way = rng.integers(3)
    if kind == "ip":
        parts = [str(rng.integers(256)) for _ in range(4)]
        return ".".join(parts) if way else pick([" . ", "[.]", "-"]).join(parts)
    if kind == "card":
        digits = [int(rng.integers(10)) for _ in range(int(rng.choice([12, 14, 15, 15, 15, 18])))]
        digits.append(next(d for d in range(10) if luhn("".join(map(str, [*digits, d])))))
        text, gap = "".join(map(str, digits)), pick(["", " ", "-", ".", "  "])
        return gap.join(text[i : i + 4] for i in range(0, len(text), 4))
    if kind == "phone":
        text = "".join(pick("0123456789") if c.isdigit() else c for c in span)
        if not way:
            text = re.sub(r"^\+\d{1,2}[ .-]?", "", text)
            text = text if len(digits_of(text)) >= 9 else span
        return text if rng.random() < 0.6 else text.replace(" ", pick(".-/")).replace("(", "").replace(")", "")
    text = "".join(pick("abcdefghijklmnopqrstuvwxyz") if c.isalpha() and rng.random() < 0.5 else c for c in span)
    if not way:
        local, _, host = text.partition("@")
        mark, dot = pick([(" [at] ", "."), ("(at)", "."), (" (at) ", " (dot) "), (" @ ", "."), ("[at]", "[dot]")])
        text = local + mark + host.replace(".", dot)
    return text


def decoy(rng: np.random.Generator) -> str:
    """Text with digits or at signs that is no personal data."""
    n = "".join(str(rng.integers(10)) for _ in range(int(rng.integers(1, 34))))
    hexed = "".join("0123456789abcdef"[rng.integers(16)] for _ in range(int(rng.integers(16, 48))))
    day = f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
    options = [n[:8], n, hexed, f'"{hexed}"', day, f"{n[:2]}:{n[2:4]}", f"{n[:3]}.{n[3:5]}", f"v{n[:1]}.{n[1:2]}.{n[2:3]}", "@" + hexed[:6], f"#{n[:5]}", f"{n[:4]}-{n[4:8]}", "@"]
    return options[rng.integers(len(options))]


def training_windows(samples: Sequence[tuple[str, list[tuple[str, str]]]], count: int, seed: int = 3):
    """Symbols and tags of ``count`` windows made of sampled prose, labelled spans and decoys."""
    rng = np.random.default_rng(seed)
    known = {k: list(SEEDS[k]) for k in KINDS}
    for _, spans in samples:
        for kind, text in spans:
            known[kind].append(text)
    prose = [re.sub(r"[0-9@]+", "", p) for p, _ in samples if p] or ["the and of to"]
    ids, tags = np.zeros((count, WIDTH), np.int64), np.zeros((count, WIDTH), np.int64)
    for row in range(count):
        text, marks = "", []
        start = prose[rng.integers(len(prose))]
        text += start[: int(rng.integers(0, WIDTH - 8))]
        while len(text) < WIDTH + 40:
            glue = [" ", " ", "\n", ", ", ".", ": ", "=", " (", '"', "### ", "| "][rng.integers(11)]
            text += glue
            if rng.random() < 0.55:
                kind = KINDS[rng.integers(len(KINDS))]
                span = varied(rng, kind, known[kind][rng.integers(len(known[kind]))])
                if well_formed(kind, span) or base_spans(span)[:1] == [(kind, 0, len(span))]:
                    marks.append((kind, len(text), len(text) + len(span)))
                text += span
            elif rng.random() < 0.5:
                text += decoy(rng)
            word = prose[rng.integers(len(prose))]
            text += [" ", "\n", ". ", ", ", " ### "][rng.integers(5)] + word[: int(rng.integers(4, 40))]
        at = int(rng.integers(0, len(text) - WIDTH + 1))
        ids[row] = symbols(text[at : at + WIDTH])
        for kind, s, e in marks:
            s, e = max(s - at, 0), min(e - at, WIDTH)
            if s < e:
                tags[row, s:e] = TAGS.index(f"I-{kind}")
                tags[row, s] = TAGS.index(f"B-{kind}")
    return ids, tags


def train(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_docs: int = 4_000, windows: int = 2_400) -> Tagger:
    """A tagger fitted on labelled spans and prose of about ``sample_docs`` documents, chosen by their key's hash.

    A document gives the driver at most 200 characters of prose and eight spans.
    """
    ship(docs.sparkSession)
    every = max(1, docs.count() // sample_docs)
    chosen = docs.filter(F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(every)) == 0).select(F.col(f"`{text}`").alias("t"))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t[len(t) // 3 :][:200], [f"{k}:{t[s:e]}" for k, s, e in base_spans(t)[:8] if e - s < WIDTH]) for t in b["t"] if t]
            yield pd.DataFrame(rows, columns=["prose", "spans"])

    found = chosen.mapInPandas(label, "prose string, spans array<string>").sort("prose", "spans").limit(2 * sample_docs).collect()
    samples = [(r.prose, [tuple(s.split(":", 1)) for s in r.spans]) for r in found]
    model = Tagger()
    model.fit(*training_windows(samples, windows))
    return model.small()


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_pii(docs: DataFrame, model: Tagger, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (code points, end exclusive, by kind and start).

    Null counts as empty and has no spans. Repeated rows get the same spans. Input columns named like a
    result are replaced.
    """
    ship(docs.sparkSession)

    @F.pandas_udf(f"struct<base:{SPANS},found:{SPANS}>")
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            base, found = [], []
            rows = [t or "" for t in batch]
            for at in range(0, len(rows), 256):
                for b, more in tagged(model, rows[at : at + 256]):
                    ordered = sorted([*b, *more], key=lambda x: (KINDS.index(x[0]), x[1]))
                    base.append([{"kind": k, "start": s, "end": e} for k, s, e in b])
                    found.append([{"kind": k, "start": s, "end": e} for k, s, e in ordered])
            yield pd.DataFrame({"base": base, "found": found})

    df = without(docs, ["base_spans", "spans", "_pii"]).withColumn("_pii", find(F.col(f"`{text}`")))
    return df.withColumns({"base_spans": F.col("_pii.base"), "spans": F.col("_pii.found")}).drop("_pii")


def _written(spans: str):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    def of(kind: str):
        return F.filter("base_spans", lambda x: x["kind"] == kind)

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_written("base_spans"), 256).alias("base_sha256"), _written("spans").alias("spans"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digest(find_pii(docs, train(docs)))
