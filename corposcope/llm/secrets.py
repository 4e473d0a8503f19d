"""Secrets in texts: known forms, and strings whose characters look random.

Strings that could be keys are cut out of the text. A window slides over each and its Shannon entropy
follows from counts that change by one character in and one out; the windows above the threshold of the
narrowest class of characters that they lie in are joined to spans. Windows over allow-listed
identifiers and spans over allow-listed words don't count, whatever else the string holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices

# Fixed values of the contract: kind, pattern, group that is measured, its least length; in the order of the kinds.
FORMS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
# Every match of ``hex`` that is long enough, found without looking at short ones.
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

# Candidate strings, and for each class of characters its pattern and the bits of entropy that a window needs.
WINDOW = 20
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
CLASSES = [
    ("digits", re.compile(r"[0-9-]+"), 9.9),  # numbers are not keys: no window of ten digits reaches this
    ("hex", re.compile(r"[0-9a-fA-F-]+"), 3.0),
    ("alphanumeric", re.compile(r"[A-Za-z0-9]+"), 3.6),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.8),
]
# Allow-list: identifiers that are no secrets, words of example keys (EXAMPLE stands inside those of public
# documentation, the others alone), and strings without a digit or a letter.
IDENTIFIERS = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|(?i:abcdefghijklmnopqrstuvwxyz|0123456789abcdef)")
EXAMPLES = re.compile(r"EXAMPLE|(?<![A-Za-z0-9])(?i:examples?|test|dummy|placeholder|changeme)(?![A-Za-z0-9])")
_WORDY = re.compile(r"[^0-9]*|[0-9_=/+-]*")
_DIGIT = re.compile(r"[0-9]")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the known forms, leftmost first inside a kind."""
    found = []
    lower = text.lower()
    for kind, pattern, group, least in FORMS:
        if kind == "assign" and not any(n in lower for n in _NAMES) or kind == "access" and "AKIA" not in text:
            continue
        matches = (_LONG_HEX if kind == "hex" else pattern).finditer(text)
        found += [(m.start(), m.end(), kind) for m in matches if m.end(group) - m.start(group) >= least]
    return found


def window_entropies(text: str, width: int = WINDOW) -> list[float]:
    """Bits of Shannon entropy of every window of ``width`` characters; each step changes two counts."""
    logs = [0.0] + [c * float(np.log2(c)) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, c in enumerate(text):
        if i >= width:
            gone = text[i - width]
            n = counts[gone]
            total += logs[n - 1] - logs[n]
            counts[gone] = n - 1
        n = counts.get(c, 0)
        total += logs[n + 1] - logs[n]
        counts[c] = n + 1
        if i >= width - 1:
            out.append(float(np.log2(width)) - total / width)
    return out


def window_thresholds(word: str) -> list[float]:
    """The bits that each window of a candidate needs: those of the first class with a run that holds the
    window. A run of letters alone is words and has no lower threshold for being alphanumeric."""
    out = [CLASSES[-1][2]] * (len(word) - WINDOW + 1)
    for name, pattern, bits in reversed(CLASSES[:-1]):
        for m in pattern.finditer(word):
            n = m.end() - m.start() - WINDOW + 1
            if n > 0 and (name != "alphanumeric" or _DIGIT.search(m.group())):
                out[m.start() : m.start() + n] = [bits] * n
    for m in IDENTIFIERS.finditer(word):
        first = max(m.start() - WINDOW + 1, 0)
        out[first : m.end()] = [float("inf")] * len(out[first : m.end()])
    return out


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of candidate strings in which windows have the entropy of random characters."""
    found = []
    for m in _CANDIDATE.finditer(text):
        word = m.group()
        if _WORDY.fullmatch(word):
            continue
        spans: list[list[int]] = []
        for at, (bits, least) in enumerate(zip(window_entropies(word), window_thresholds(word))):
            if bits < least:
                continue
            if not spans or at > spans[-1][1]:
                spans.append([at, at])
            spans[-1][1] = at + WINDOW
        examples = [e.span() for e in EXAMPLES.finditer(word)] if spans else []
        kept = [s for s in spans if not any(s[0] < b and a < s[1] for a, b in examples)]
        found += [(m.start() + a, m.start() + b, "entropy") for a, b in kept]
    return found


def uncovered(start: int, end: int, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The parts of ``start:end`` outside of ``spans``, from left to right."""
    out = []
    for a, b, _ in sorted(spans):
        if b <= start or a >= end:
            continue
        if a > start:
            out.append((start, a))
        start = max(start, b)
    return out + [(start, end)] if start < end else out


_ORDER = {kind: i for i, kind in enumerate([f[0] for f in FORMS] + ["entropy"])}
_SPANS = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def text_spans(text: str) -> list[dict]:
    """All spans of a text by start, then kind; what known forms leave of an entropy span is judged again on its own."""
    base, more = base_spans(text), []
    for start, end, kind in entropy_spans(text):
        left = uncovered(start, end, base)
        more += [(start, end, kind)] if left == [(start, end)] else [(a + x, a + y, kind) for a, b in left for x, y, _ in entropy_spans(text[a:b])]
    ordered = sorted(base + more, key=lambda s: (s[0], _ORDER[s[2]]))
    return [{"kind": kind, "start": start, "end": end} for start, end, kind in ordered]


def with_secrets(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``, an array of ``(kind, start, end)`` in code points, end exclusive.

    Kinds are those of ``FORMS``, then ``entropy``. Null and empty texts have none; an existing
    column ``secrets`` is replaced. Row by row, so nothing is shuffled and repeats cost only themselves.
    """

    @F.arrow_udf("array<struct<kind: string, start: int, end: int>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [text_spans(t or "") for p in slices(pa.record_batch([texts], ["t"]), "t") for t in p.column(0).to_pylist()]
            yield pa.array(found, pa.list_(_SPANS))

    return docs.withColumn("secrets", scan(F.col(text).cast("string")))


def spelled(spans):
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
