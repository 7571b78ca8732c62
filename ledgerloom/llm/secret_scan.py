"""Secrets in texts: patterns of known kinds, and strings whose sliding windows have a high Shannon entropy.

Known kinds (`assign`, `access`, `hex`) are leftmost non-overlapping matches, of which too short ones are dropped.

The method adds spans of kind `entropy`. Each character class has a window length and a least entropy in bits. Candidates
are the maximal runs of the class that are at least a window long. A window slides over a candidate one character at a time:
one count grows, one shrinks, and the sum of n log2 n over the counts follows by differences of a table, in whole numbers,
so that it never drifts. Windows of at least that entropy are joined where they touch or overlap. A candidate that the
allow-list matches whole (words and paths, plain numbers, UUIDs, ruled lines), or that holds an allowed literal
(placeholders), is suppressed; so is a span that lies inside one of a known kind. Known kinds are never suppressed.

Texts are scanned whole where they lie; nothing moves. Offsets are code points.

Cases: a null text is an empty one; an empty text has no spans; rows that repeat an id give rows each; null ids stay null;
an empty table gives no rows; other columns are ignored. A text of any length is scanned in linear time.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of, text_slices

#: The kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "entropy")
#: Words that name a secret, and the shortest value, access key and hexadecimal string.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_KEYWORDS = (b"passw", b"secret", b"token", b"api_key", b"apikey")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_VALUE, _KEY, _HEX = 6, 20, 24
_FOUND = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                    ("base_sha256", pa.string()), ("spans", pa.string())])


class CharClass(NamedTuple):
    """Characters of a candidate, window length, least entropy of a window in bits."""

    characters: str
    window: int
    bits: float


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (CharClass(_DIGITS + "abcdefABCDEF", 24, 3.0), CharClass(_LOWER + _UPPER + _DIGITS + "+/_=-", 20, 3.8))
#: Candidates that one of these matches whole are no secrets.
ALLOWED = (
    r"[-_=+/]*(?:(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8})[-_=+/]+)*(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8})?",  # words, paths, dates
    r"[0-9+/_=-]+",
    r"[A-Z]?[a-z]+(?:[A-Z][a-z]+)*[0-9]{0,4}",  # words in one
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
)
#: Candidates that hold one of these, in either case, are no secrets.
PLACEHOLDERS = ("example", "placeholder", "changeme", "xxxx", "0123456789", "abcdefghij")


def spread(c: int) -> int:
    """c log2 c in units of 2^-40."""
    return round(c * math.log2(c) * (1 << 40)) if c > 1 else 0


class Scanner:
    """What one task keeps: tables of the classes and the allow-list."""

    def __init__(self, classes: tuple[CharClass, ...], allowed: tuple[str, ...], placeholders: tuple[str, ...]):
        self.classes = [(self.table(c.characters), c.window, *self.limits(c.window, c.bits)) for c in classes]
        self.hex = self.table(_DIGITS + "abcdef")
        self.allowed = [re.compile(p.encode()) for p in allowed]
        self.placeholders = [p.lower().encode() for p in placeholders]

    @staticmethod
    def table(characters: str) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(characters.encode())] = True
        return table

    @staticmethod
    def limits(window: int, bits: float) -> tuple[list[int], int]:
        """Steps of the sum when a count grows from c to c + 1, and the largest sum of a window with that entropy."""
        sums = [spread(c) for c in range(window + 2)]
        return [b - a for a, b in zip(sums, sums[1:])], math.floor((math.log2(window) - bits) * window * (1 << 40))

    @staticmethod
    def runs(data: np.ndarray, table: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
        """Maximal runs of a class that are at least so long."""
        outside = np.flatnonzero(~table[data])
        gaps = np.diff(outside, prepend=-1, append=len(data))
        for k in np.flatnonzero(gaps > least).tolist():
            start = int(outside[k - 1]) + 1 if k else 0
            yield start, start + int(gaps[k]) - 1

    @staticmethod
    def dense(run: bytes, window: int, steps: list[int], most: int) -> list[tuple[int, int]]:
        """Joined windows of a run whose sum is at most `most`, by incremental counts."""
        counts, total, spans = [0] * 256, 0, []
        for at, new in enumerate(run):
            total += steps[counts[new]]
            counts[new] += 1
            if at >= window:
                old = run[at - window]
                counts[old] -= 1
                total -= steps[counts[old]]
            if at >= window - 1 and total <= most:
                start = at - window + 1
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], at + 1)
                else:
                    spans.append((start, at + 1))
        return spans

    def suppressed(self, run: bytes) -> bool:
        low = run.lower()
        return any(p in low for p in self.placeholders) or any(p.fullmatch(run) for p in self.allowed)

    def known(self, text: bytes, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the known kinds, in bytes, in order."""
        found, low = [], text.lower()
        if any(k in low for k in _KEYWORDS):  # every match holds one of them
            found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _VALUE]
        if b"AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _KEY]
        found += [(start, 2, end) for start, end in self.runs(data, self.hex, _HEX)]
        return sorted(found)

    def added(self, text: bytes, data: np.ndarray, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the windows with high entropy that no known kind covers."""
        spans = []
        for table, window, steps, most in self.classes:
            for first, last in self.runs(data, table, window):
                run = text[first:last]
                if not self.suppressed(run):
                    spans += [(first + a, first + b) for a, b in self.dense(run, window, steps, most)]
        joined: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if joined and a <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
            else:
                joined.append((a, b))
        reach, at, left = 0, 0, []  # the furthest end of the known spans that begin no later
        for a, b in joined:
            while at < len(known) and known[at][0] <= a:
                reach, at = max(reach, known[at][2]), at + 1
            if b > reach:
                left.append((a, 3, b))
        return left

    def __call__(self, text: bytes, data: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Known and all spans of a text as (start, kind, end) in code points, in order."""
        known = self.known(text, data)
        spans = sorted(known + self.added(text, data, known))
        if not spans or len(text) == 0:
            return [], []
        before = np.cumsum((data & 0xC0) == 0x80)  # continuation bytes up to each byte
        point = lambda at: at - int(before[at - 1]) if at else 0
        spans = [(point(a), k, point(b)) for a, k, b in spans]
        return [s for s in spans if s[1] < 3], spans


def listed(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end of spans, joined by commas."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def found_secrets(docs: DataFrame, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
                  placeholders: tuple[str, ...] = PLACEHOLDERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256 (of the known spans), spans (all of them)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, none = Scanner(classes, allowed, placeholders), hashlib.sha256(b"").hexdigest()
        for batch in batches:
            out = []
            for _, data, ends in text_slices(batch, "text"):
                whole = data.tobytes()
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    known, spans = scanner(whole[a:b], data[a:b])
                    kinds = [k for _, k, _ in known]
                    name = hashlib.sha256(listed(known).encode()).hexdigest() if known else none
                    out.append((kinds.count(0), kinds.count(1), kinds.count(2), name, listed(spans)))
            if out:
                yield batch_of(_FOUND, batch.column("doc_id"), *zip(*out))

    return rows.mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
