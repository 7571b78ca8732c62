"""Benchmark passages in documents, by SimHash of item-sized windows.

An item of n words is looked for in every window of n words: both are weighted sets of five-word shingles (shorter items:
one shingle of all their words) and match at a weighted Jaccard similarity of `similarity`. A document shorter than the
item is one window, whole. Two sets with m and n shingles reach a similarity s only if they share at least
s / (1 + s) x (m + n) of them: a window in which fewer shingles occur in items at all cannot match and is passed over; the
others get a 64-bit SimHash. The items' fingerprints are indexed in four blocks of sixteen bits: of two fingerprints within `radius` bits one block differs in at
most radius // 4 bits, so the items found through the blocks are all that lie within the radius. Those within it are
verified by their exact similarity.

Items are a query set against all documents, in blocks of bounded size (`items`, `item_bytes`); each block is one pass and
is all that the tasks receive. Documents never move.

Cases: words are lower-cased and ASCII marks count as spaces; items without a word are ignored; null texts have no words;
equal items are reported each; rows that repeat an id give rows each; null ids stay null; empty tables give no rows; other columns are ignored. Whole texts are read, of any length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of
from ledgerloom.llm.substring import Rolling, WordHashes

SHINGLE = 5
#: Blocks of a fingerprint and the type that holds one: larger blocks are fewer and tell more pairs apart.
BLOCKS, _BLOCK = 4, np.uint16
_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())])
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_MAP_BITS = 20


def plain_words(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII marks."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def simhashes(shingles: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of all runs of `width` shingles: the majority of each bit."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(bits) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = 2 * (sums[width:] - sums[:-width]) > width
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]


def similarity_of(a: np.ndarray, b: Counter) -> float:
    """Weighted Jaccard similarity of a run of shingles and a count of shingles."""
    own = Counter(a.tolist())
    return (own & b).total() / (own | b).total()


class Items:
    """A block of items, by shingle length and number of shingles, with the block index of each class."""

    def __init__(self, rows: list[tuple[int, str]], radius: int, similarity: float):
        self.radius, self.similarity = radius, similarity
        # What each step has passed: windows of texts, windows hashed, pairs found by the index, pairs verified.
        self.windows = self.hashed = self.indexed = self.verified = 0
        hashes, roll = WordHashes(), Rolling(_BASE)
        classes: dict[tuple[int, int], list] = {}
        for item, text in rows:
            words = np.fromiter(map(hashes.__getitem__, plain_words(text)), dtype=np.uint64)
            if len(words):
                size = min(SHINGLE, len(words))
                found = roll(words, size)
                classes.setdefault((size, len(found)), []).append((item, simhashes(found, len(found))[0], Counter(found.tolist())))
        self.shingles: dict[int, np.ndarray] = {}
        self.seen: dict[int, np.ndarray] = {}
        self.classes = {}
        for key, members in sorted(classes.items()):
            prints = np.array([m[1] for m in members], dtype=np.uint64)
            self.classes[key] = ([m[0] for m in members], prints, [m[2] for m in members])
        for size in {k[0] for k in self.classes}:
            own = np.array(sorted({h for k, c in self.classes.items() if k[0] == size for m in c[2] for h in m}), dtype=np.uint64)
            marks = np.zeros(1 << _MAP_BITS, bool)
            marks[own & np.uint64((1 << _MAP_BITS) - 1)] = True
            self.shingles[size], self.seen[size] = own, marks

    def shared(self, shingles: np.ndarray, size: int) -> np.ndarray:
        """Places of shingles that some item has."""
        some = np.flatnonzero(self.seen[size][shingles & np.uint64((1 << _MAP_BITS) - 1)])
        own = self.shingles[size]
        at = np.minimum(np.searchsorted(own, shingles[some]), len(own) - 1)
        return some[own[at] == shingles[some]]

    def indexed_pairs(self, prints: np.ndarray, items: np.ndarray, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
        """(window, item) whose fingerprints differ in at most radius // BLOCKS bits of some block."""
        own, blocks = items.view(_BLOCK).reshape(-1, BLOCKS), prints.view(_BLOCK).reshape(-1, BLOCKS)
        rows = max(1, most // max(1, len(items)))
        for at in range(0, len(prints), rows):
            found = np.zeros((len(prints[at:at + rows]), len(items)), bool)
            for b in range(BLOCKS):
                found |= np.bitwise_count(blocks[at:at + rows, b, None] ^ own[None, :, b]) <= self.radius // BLOCKS
            for w, i in zip(*np.nonzero(found)):
                yield at + int(w), int(i)

    def matches(self, words: np.ndarray, roll: Rolling) -> Iterator[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window of each item found in a text."""
        for size in self.shingles:
            if len(words) < size:
                continue
            shingles = roll(words, size)
            hits = self.shared(shingles, size)
            if not len(hits):
                continue
            for (k, width), (ids, prints, sets) in self.classes.items():
                whole = len(shingles)
                if k != size or whole / width < self.similarity:  # too few shingles to be as similar as that
                    continue
                own, width = width, min(width, whole)  # a document shorter than the items is one window
                least = math.ceil(self.similarity / (1 + self.similarity) * (own + width) - 1e-9)
                # Shared shingles of each window: those up to its end less those before it.
                shared = np.searchsorted(hits, np.arange(width, whole + 1)) - np.searchsorted(hits, np.arange(whole - width + 1))
                starts = np.flatnonzero(shared >= least)
                self.windows += whole - width + 1
                self.hashed += len(starts)
                best: dict[int, tuple[float, int]] = {}
                for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                    for at in range(0, len(run), 1 << 14):
                        some = run[at:at + (1 << 14)]
                        got = simhashes(shingles[some[0]:some[-1] + width], width)
                        for w, i in self.indexed_pairs(got, prints):
                            self.indexed += 1
                            if (int(got[w]) ^ int(prints[i])).bit_count() <= self.radius:
                                self.verified += 1
                                start = int(some[w])
                                value = similarity_of(shingles[start:start + width], sets[i])
                                if value >= self.similarity and value > best.get(i, (0.0, 0))[0]:
                                    best[i] = (value, start)
                for i, (value, start) in best.items():
                    yield ids[i], start, size + width - 1, value


def passages(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = 23, items: int = 20_000,
             item_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, start, n_words, similarity of the best window."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    given = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    size = given.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    passes = max(1, math.ceil(size["n"] / items), math.ceil(size["b"] / item_bytes))

    def one(number: int) -> DataFrame:
        part = given.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number).orderBy("item_id", "text").collect()
        known = spark.sparkContext.broadcast([tuple(r) for r in part])  # a bounded block of items

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, hashes, roll = Items(known.value, radius, similarity), WordHashes(), Rolling(_BASE)
            for batch in batches:
                out = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    plain = plain_words(text.as_py())
                    words = np.fromiter(map(hashes.__getitem__, plain), dtype=np.uint64, count=len(plain))
                    out += [(doc, *m) for m in block.matches(words, roll)]
                if out:
                    yield batch_of(_FOUND, *zip(*out))

        return rows.mapInArrow(search, "doc_id long, item_id long, start long, n_words long, similarity double")

    found = one(0)
    for number in range(1, passes):
        found = found.unionByName(one(number))
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, in which no item is found. Rows that share an id are told apart by their text."""
    number = docs.withColumn("__id", F.xxhash64(id_col, text_col))
    bad = passages(number, benchmark, id_col="__id", text_col=text_col).select(F.col("doc_id").alias("__bad")).distinct()
    return number.join(bad, F.col("__id") == F.col("__bad"), "left_anti").drop("__id")
