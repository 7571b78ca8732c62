"""Repeated word windows by difference-cover anchors.

A difference cover of a period P is a set of residues whose differences give every residue. Anchors are hashed only at
word positions whose residue lies in the cover. Of two equal windows at any two positions, some common shift puts both on
cover positions, so windows of `size` words that are equal share an aligned anchor of size - P + 1 words. With P = 21 and
five residues that is 15 words for a window of 35, and under a quarter of all positions are hashed.

1. Anchors are dealt by hash and sorted; those equal to a neighbour are repeated (an anchor at the edge of a partition counts
   as repeated too, which only costs a comparison later). Anchors that a sample of documents holds often are repeated for
   certain and are dealt over all partitions. The sample only spreads them; which anchors are repeated is decided over all.
2. Repeated anchors are extended: each window that holds one is hashed whole (96 bits over 64-bit word hashes). The
   windows are sorted the same way, and equal neighbours are repeated windows. A group that meets the edge of a partition
   is settled with the edges of all partitions, two groups each. Of texts that are equal as a whole (128 bits) all windows
   are repeated, and the first of them alone stands for them here.
3. Words covered by a repeated window are removed; the others are joined by one space.

Anchors are hashed once, as dealing them needs no splitters. The windows are range partitions with sampled splitters over
(hash, document, position). So a passage held by a third of all documents is spread over many tasks; no task gathers a large
group, and pairs are never listed.

Cases: a null text has no words; a text shorter than a window keeps all; rows that repeat an id are told apart by their
text, and rows equal in both are copies of each other; null ids are rows like any other; an empty table gives no rows;
other columns are ignored. Rolling hashes run over whole texts, so a text of any length is one array of word hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of, cut, shuffle_width

#: A period and a difference cover of it: every residue is a difference of two of these.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
#: Word hashes that a worker remembers; beyond it starts anew. It bounds memory and changes no result.
REMEMBERED = 300_000
#: Documents whose anchors are counted to find the busy ones, counts that make one, and how many are told to all tasks.
SAMPLED, BUSY, MOST_BUSY = 10_000, 8, 100_000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_KEY = "doc_id long, copy int"
_ANCHORS = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int32()), ("pos", pa.int32())])
_PLACES = pa.schema([("doc_id", pa.int64()), ("copy", pa.int32()), ("pos", pa.int32())])
_WINDOWS = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), *_PLACES])
_EDGES = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("n", pa.int64())])
#: In place of a position: the whole text.
ALL = -1
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


class WordHashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 0)
        return found

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


class Rolling:
    """Polynomial hashes, modulo 2^64, of all runs of a number of words."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        while len(self.up) < n:
            top = [np.uint64(pow(x, len(self.up), 1 << 64)) for x in (self.base, self.inverse)]
            self.up, self.down = (np.concatenate([p, p * t]) for p, t in zip((self.up, self.down), top))

    def __call__(self, words: np.ndarray, size: int) -> np.ndarray:
        n = len(words)
        self._powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * self.up[:n], out=sums[1:])
        found = (sums[size:] - sums[:n - size + 1]) * self.down[:n - size + 1]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        return found ^ found >> np.uint64(32)


def _columns(batch: pa.RecordBatch) -> tuple[list, list, list]:
    return tuple(batch.column(c).to_pylist() for c in ("doc_id", "copy", "text"))


def _joined(schema: pa.Schema, parts: list[tuple]) -> pa.RecordBatch:
    """Rows of (arrays..., doc_id, copy, positions) of several documents as one batch."""
    sizes = np.array([len(p[-1]) for p in parts], dtype=np.int64)
    hashes = [np.concatenate([p[k] for p in parts]).astype(np.int64).astype(schema.field(k).type.to_pandas_dtype()) for k in range(len(schema) - 3)]
    ids = pa.array([p[-3] for p in parts], type=pa.int64()).take(pa.array(np.repeat(np.arange(len(parts)), sizes)))
    copies = np.repeat(np.array([p[-2] for p in parts], dtype=np.int32), sizes)
    return batch_of(schema, *hashes, ids, copies, np.concatenate([p[-1] for p in parts]).astype(np.int32))


def _in_parts(schema: pa.Schema, rows: Iterator[tuple], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0
    for row in rows:
        if len(row[-1]):
            parts.append(row)
            held += len(row[-1])
        if held >= most:
            yield _joined(schema, parts)
            parts, held = [], 0
    if parts:
        yield _joined(schema, parts)


def anchors(size: int, period: int, cover: tuple[int, ...]) -> Callable:
    """Hashes of the anchors of whole texts, at cover positions."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        hashes, roll, own = WordHashes(), Rolling(_BASES[0]), size - period + 1
        member = np.zeros(period, bool)
        member[list(cover)] = True
        for batch in batches:
            for doc, copy, text in zip(*_columns(batch)):
                words = hashes.of(text)
                if len(words) >= size:
                    at = np.flatnonzero(np.resize(member, len(words) - own + 1))
                    yield roll(words, own)[at], doc, copy, at

    return lambda batches: _in_parts(_ANCHORS, rows(batches))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, bool, bool]]:
    """Sorted batches with, for each row, whether its keys equal the row before's and the row after's.

    The last row of a batch waits for the next one. The flags say whether the part begins and ends the partition.
    """
    held, before, first = None, None, True
    def flags(part: pa.Table, before, last: bool):
        values = [part.column(k).to_numpy() for k in keys]
        same = np.ones(max(0, len(part) - 1), bool)
        for v in values:
            same &= v[1:] == v[:-1]
        with_before = np.append(before is not None and all(v[0] == b for v, b in zip(values, before)), same)
        return with_before, np.append(same, False), tuple(v[-2 if not last and len(v) > 1 else -1] for v in values)
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        part = pa.concat_tables([held, part]) if held is not None else part
        if len(part) == 1:
            held = part
            continue
        left, right, at = flags(part, before, False)
        yield part.slice(0, len(part) - 1), left[:-1], right[:-1], first, False
        held, before, first = part.slice(len(part) - 1), at, False
    if held is not None:
        left, right, _ = flags(held, before, True)
        yield held, left, right, first, True


def repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of anchors that are busy, equal a neighbour or stand at an edge of the partition."""
    for part, left, right, first, last in _runs(batches, ["h"]):
        some = left | right | part.column("busy").to_numpy()
        some[0] |= first
        some[-1] |= last
        found = part.select(_PLACES.names).filter(pa.array(some)).combine_chunks()
        yield from found.to_batches()


def windows(size: int, period: int) -> Callable:
    """Hashes of the windows that hold a repeated anchor."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        hashes, rolls = WordHashes(), [Rolling(b) for b in _BASES]
        for batch in batches:
            for doc, copy, text, places in zip(*_columns(batch), batch.column("places")):
                words, at = hashes.of(text), np.unique(places.values.to_numpy())
                step = np.zeros(len(words) + period + 1, np.int32)
                np.add.at(step, np.maximum(at - period + 1, 0), 1)
                np.add.at(step, at + 1, -1)
                starts = np.flatnonzero(np.cumsum(step)[:len(words) - size + 1] > 0)
                mixed = words ^ words >> np.uint64(29)
                both = rolls[0](words, size)[starts], rolls[1](mixed * np.uint64(0xBF58476D1CE4E5B9), size)[starts]
                yield *both, doc, copy, starts

    return lambda batches: _in_parts(_WINDOWS, rows(batches))


def _edge_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last group of a partition and their sizes."""
    groups: list[list] = []  # first and last so far
    for part, left, _, _, _ in _runs(batches, ["h1", "h2"]):
        begins = np.append(np.flatnonzero(~left), len(left))
        h1, h2 = (part.column(c).to_numpy() for c in ("h1", "h2"))
        if begins[0] > 0 and groups:
            groups[-1][2] += int(begins[0])
        if len(begins) > 1:
            for k in (0, len(begins) - 2):
                new = [int(h1[begins[k]]), int(h2[begins[k]]), int(begins[k + 1] - begins[k])]
                if not groups or groups[-1][:2] != new[:2]:
                    groups = [*groups[:1], new]
    if groups:
        yield batch_of(_EDGES, *zip(*groups))


def repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of windows that equal a neighbour; with their hashes, those at an edge that equal none inside."""
    for part, left, right, first, last in _runs(batches, ["h1", "h2"]):
        same, edge = left | right, np.zeros(len(left), bool)
        edge[0], edge[-1] = first, last or edge[-1]
        edge[0] |= first
        edge &= ~same
        some = same | edge
        found = part.filter(pa.array(some))
        open_ = edge[some]
        yield batch_of(_WINDOWS, *(pa.array(found.column(c).to_numpy(), mask=~open_) for c in ("h1", "h2")),
                       *(found.column(c).combine_chunks() for c in _PLACES.names))


def strip(size: int) -> Callable:
    """Texts without the words that repeated windows cover."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [], [])
            for doc, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("places")):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                stay = words
                at = np.unique(places.values.to_numpy()) if places.is_valid else ()
                if len(at) and at[0] == ALL:
                    stay, at = words if len(words) < size else [], ()
                if len(at):
                    step = np.zeros(len(words) + 1, np.int64)
                    step[at] += 1
                    step[at + size] -= 1
                    stay = [words[k] for k in np.flatnonzero(np.cumsum(step)[:-1] == 0)]
                body = b" ".join(stay)
                for column, value in zip(out, (doc, len(words), len(words) - len(stay), hashlib.sha256(body).hexdigest(), body.decode("utf-8", "replace"))):
                    column.append(value)
            yield batch_of(_RESULT, *out)

    return of


def without_repeats(docs: DataFrame, size: int = 35, period: int = PERIOD, cover: tuple[int, ...] = COVER,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept (the words that stay)."""
    if not period <= size or {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover must be a difference cover of a period of at most a window's size")
    parts = shuffle_width(docs.sparkSession)
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    unique = ids.groupBy("doc_id").count().filter("count > 1").isEmpty()
    texts = ids.withColumn("copy", F.lit(0) if unique else F.hash("text"))

    whole = texts.select("doc_id", "copy", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    groups = whole.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "copy")).alias("first"))
    copied = cut(whole.join(groups.filter("n > 1"), ["a", "b"]).select(
        F.col("doc_id").alias("c_doc"), F.col("copy").alias("c_copy"), (F.struct("doc_id", "copy") != F.col("first")).alias("later")))

    def places(found: DataFrame) -> DataFrame:
        return found.groupBy(F.col("doc_id").alias("of"), F.col("copy").alias("of_copy")).agg(F.collect_list("pos").alias("places"))

    def beside(found: DataFrame, how: str) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("copy") == F.col("of_copy"))
        return texts.join(places(found), same, how).select("doc_id", "copy", "text", "places")

    hashed = texts.mapInArrow(anchors(size, period, cover), "h long, " + _KEY + ", pos int")
    some = min(1.0, SAMPLED / max(1, ids.count()))
    counted = texts.sample(some, 1).mapInArrow(anchors(size, period, cover), "h long, " + _KEY + ", pos int").groupBy("h").count()
    busy = cut(counted.filter(F.col("count") >= BUSY).orderBy(F.desc("count"), "h").limit(MOST_BUSY).select(F.col("h").alias("b")))
    marked = hashed.join(F.broadcast(busy), F.col("h") == F.col("b"), "left").withColumn("busy", F.col("b").isNotNull()).drop("b")
    slot = F.when(F.col("busy"), F.pmod(F.xxhash64("doc_id", "pos"), F.lit(parts))).otherwise(0)
    ordered = marked.repartition(parts, "h", slot).sortWithinPartitions("h")
    matched = ordered.mapInArrow(repeated_anchors, _KEY + ", pos int")
    is_later = F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("copy") == F.col("c_copy")) & F.col("later")
    matched = matched.join(copied, is_later, "left_anti")
    candidates = beside(matched, "inner").mapInArrow(windows(size, period), "h1 long, h2 int, " + _KEY + ", pos int")
    sorted_ = candidates.repartitionByRange(parts, "h1", "h2", "doc_id", "pos").sortWithinPartitions("h1", "h2")
    found = sorted_.mapInArrow(repeated_windows, "h1 long, h2 int, " + _KEY + ", pos int")
    edges = sorted_.mapInArrow(_edge_groups, "h1 long, h2 int, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    across = edges.filter("n > 1").select(F.col("h1").alias("e1"), F.col("h2").alias("e2"))  # two rows a partition at most
    settled = (
        found.join(F.broadcast(across), (F.col("h1") == F.col("e1")) & (F.col("h2") == F.col("e2")), "left")
        .filter(F.col("h1").isNull() | F.col("e1").isNotNull()).select("doc_id", "copy", "pos")
    )
    settled = settled.unionByName(copied.select(F.col("c_doc").alias("doc_id"), F.col("c_copy").alias("copy"), F.lit(ALL).alias("pos")).distinct())
    return beside(settled, "left").mapInArrow(
        strip(size), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
