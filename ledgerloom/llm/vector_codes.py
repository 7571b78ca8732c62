"""Compression of vectors into codes of codebook entries, with the nearest entries found by slices and bitmasks.

A component x becomes the integer floor(scale * x); a vector is cut into equal consecutive parts, and each part position has
a codebook of its own. The codebooks start as the parts of the vectors with the smallest ids. In each round every part goes
to its nearest entry, and each entry becomes the componentwise floor of the mean of its parts; entries without parts stay.

Nearest entries are exact. For each dimension of a codebook the coordinates of its entries are sorted, and the mask of the
first i of them (one bit for each entry, in uint64 words) is kept for every i. The entries within a radius of a query in
one dimension are a slice of that order, whose mask is the prefix mask at its end without the one at its start; ANDed over
all dimensions the masks leave those within the radius in every dimension. An entry nearer than the radius is among them, so
the best of them, by full squared distance and then by index, is the nearest of all if it lies within the radius. Otherwise
the search is done again with the distance of the best one found as the radius, which settles it, or with twice the radius
where the slices are empty. The first radius is the median distance of the queries before.

A round is one pass over the vectors: each task sums the parts of each entry in its memory (parts x entries rows), Spark
sums those, and the driver holds the codebooks alone. Vectors never move; codes and errors move with the sums of labels, of
which those that hold many rows are joined by broadcast: there are at most 8 x partitions of them.

Cases: a row whose vector is null, has no component or holds a null or non-finite one is dropped; repeated rows and ids stay
rows each, and of equal ids the smaller vector comes first in the first codebooks; null ids come last there; fewer vectors
than entries give smaller codebooks; null labels are one label; an empty table gives no rows; other columns are ignored. A
vector of another length than the first, a length that the parts do not divide, and components whose squared distances do
not fit a long raise an error that says so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of, cut, shuffle_width

#: Queries that are searched at a time.
_CHUNK = 4096
_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])


class Slices:
    """The codebook of one part position: its entries (entry, dimension), sorted coordinates and prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries, (self.count, self.width) = entries, entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0).T.copy()
        words = -(-self.count // 64)
        own = np.zeros((self.count, words), np.uint64)
        each = np.arange(self.count)
        own[each, each // 64] = np.uint64(1) << (each % 64).astype(np.uint64)
        self.prefix = np.zeros((self.width, self.count + 1, words), np.uint64)
        for d in range(self.width):
            np.bitwise_or.accumulate(own[order[:, d]], axis=0, out=self.prefix[d, 1:])
        self.radius, self.passed, self.asked = 0, 0, 0
        gaps = np.sqrt(((entries[1:] - entries[:-1]).astype(np.float64) ** 2).sum(axis=1)) if self.count > 1 else np.ones(1)
        self.radius = int(np.median(gaps)) + 1

    def candidates(self, queries: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Whether (query, entry) lie within the query's radius of each other in every dimension."""
        mask = None
        for d in range(self.width):
            low = np.searchsorted(self.sorted[d], queries[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[d], queries[:, d] + radius, side="right")
            slice_ = self.prefix[d][high] & ~self.prefix[d][low]
            mask = slice_ if mask is None else mask & slice_
        return np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little", count=self.count).view(bool)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the index of its nearest entry (the lowest of equally near ones) and the squared distance."""
        index, distance = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for at in range(0, len(queries), _CHUNK):
            index[at:at + _CHUNK], distance[at:at + _CHUNK] = self._chunk(queries[at:at + _CHUNK])
        return index, distance

    def _chunk(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        largest = max(1, int(np.abs(queries).max()), int(np.abs(self.entries).max()))
        if 4 * self.width * largest * largest >= 1 << 62:
            raise ValueError("squared distances of these vectors do not fit a long")
        # Products of doubles are exact while the sums stay below 2^53.
        kind = np.float64 if 4 * self.width * largest * largest < 1 << 53 else np.int64
        entries, square = self.entries.astype(kind), (self.entries.astype(kind) ** 2).sum(axis=1)
        index, distance = np.zeros(len(queries), np.int64), np.full(len(queries), -1, np.int64)
        left, radius = np.arange(len(queries)), np.full(len(queries), self.radius, np.int64)
        while len(left):
            some = queries[left]
            near = self.candidates(some, radius)
            self.passed, self.asked = self.passed + int(near.sum()), self.asked + near.size
            union = np.flatnonzero(near.any(axis=0))
            if len(union):
                own = some.astype(kind)
                full = (own * own).sum(axis=1)[:, None] - 2 * (own @ entries[union].T) + square[union]
                far = np.iinfo(np.int64).max if kind is np.int64 else np.inf
                full[~near[:, union]] = far
                best = full.argmin(axis=1)
                value, any_ = full[np.arange(len(left)), best], near.any(axis=1)
                value = np.where(any_, value, 0).astype(np.int64)
                index[left], distance[left] = union[best], np.where(any_, value, -1)
            else:
                any_, value = np.zeros(len(left), bool), np.zeros(len(left), np.int64)
            settled = any_ & (value <= radius * radius)
            grown = np.where(any_, np.ceil(np.sqrt(value.astype(np.float64))).astype(np.int64) + 1, 2 * radius + 1)
            left, radius = left[~settled], grown[~settled]
        self.radius = int(np.sqrt(np.median(distance))) + 1
        return index, distance


class Books:
    """The codebooks of all part positions, and what a task does with them."""

    def __init__(self, books: list[np.ndarray], scale: int):
        self.slices, self.scale = [Slices(b) for b in books], scale
        self.width = books[0].shape[1]

    def integers(self, vectors: pa.Array) -> np.ndarray:
        return integers(vectors, self.scale, self.width * len(self.slices))

    def assigned(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each part position: the parts, their entries and the squared distances."""
        for p, slices in enumerate(self.slices):
            parts = np.ascontiguousarray(vectors[:, p * self.width:(p + 1) * self.width])
            yield parts, *slices.nearest(parts)


def integers(vectors: pa.Array, scale: int, length: int) -> np.ndarray:
    """Vectors of one length as rows of integers."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes != length).any():
        raise ValueError(f"all vectors must have the {length} components of the first")
    scaled = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() >= 1 << 30:
        raise ValueError("squared distances of these vectors do not fit a long")
    return scaled.astype(np.int64).reshape(-1, length)


def kept(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, vec (array of doubles) and label of the rows whose vector is whole and finite."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label"))
    finite = F.forall("vec", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return rows.filter(F.col("vec").isNotNull() & (F.size("vec") > 0) & finite)


def next_books(rows: DataFrame, books: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """The codebooks after one round over all rows."""
    width, known = books[0].shape[1], rows.sparkSession.sparkContext.broadcast(books)  # parts x entries x width numbers

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Books(known.value, scale)
        held = [(np.zeros(len(b), np.int64), np.zeros(b.shape, np.int64)) for b in known.value]
        for batch in batches:
            vectors = own.integers(batch.column(0))
            for (count, total), (parts, index, _) in zip(held, own.assigned(vectors)):
                order = np.argsort(index, kind="stable")
                some, first = np.unique(index[order], return_index=True)
                if len(some):
                    total[some] += np.add.reduceat(parts[order], first, axis=0)
                    count += np.bincount(index, minlength=len(count))
        for p, (count, total) in enumerate(held):
            used = np.flatnonzero(count)
            if len(used):
                yield batch_of(_SUMS, np.full(len(used), p), used, count[used], total[used].tolist())

    partial = rows.select("vec").mapInArrow(sums, "part int, entry int, n long, sums array<long>")
    total = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)])
    new = [b.copy() for b in books]
    for row in total.collect():  # parts x entries rows at most
        new[row["part"]][row["entry"]] = [row[f"s{k}"] // row["n"] for k in range(width)]
    known.unpersist()
    return new


def first_books(rows: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids, no codebook if there is no vector."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").select("vec").limit(entries).collect()
    if not first:
        return []
    length = len(first[0]["vec"])
    if length % parts:
        raise ValueError(f"{parts} equal parts do not divide {length} components")
    return [b.copy() for b in np.split(integers(pa.array([r["vec"] for r in first], pa.list_(pa.float64())), scale, length), parts, axis=1)]


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components, by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def train(rows: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> list[np.ndarray]:
    """Codebooks after all rounds."""
    books = first_books(rows, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = next_books(rows, books, scale)
    return books


def encode(rows: DataFrame, books: list[np.ndarray], scale: int) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part) and error of all rows."""
    known, kinds = rows.sparkSession.sparkContext.broadcast(books), dict(rows.dtypes)
    digits = 2 if max(len(b) for b in books) <= 256 else 4

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Books(known.value, scale)
        for batch in batches:
            found = list(own.assigned(own.integers(batch.column("vec"))))
            error = sum((d for _, _, d in found), np.zeros(batch.num_rows, np.int64))
            names = ["".join(f"{k:0{digits}x}" for k in row) for row in np.stack([i for _, i, _ in found], axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(names, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(codes, f"vec_id long, label {kinds['label']}, code string, error long")


def compressed(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
               id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error (errors of all rows of its label), codebooks_sha256."""
    spark, rows = vectors.sparkSession, kept(vectors, id_col, vec_col, label_col)
    books = train(rows, parts, entries, rounds, scale)
    if not books:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = cut(encode(rows, books, scale))
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    busy = max(16, coded.count() // (8 * shuffle_width(spark)))
    hot = totals.filter(F.col("n") > busy).select(F.col("label").alias("own"), F.col("label_error").alias("hot_error"))  # <= 8 x partitions rows
    marked = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("own")), "left").drop("own")
    few = totals.filter(F.col("n") <= busy).select(F.col("label").alias("own"), "label_error")
    rest = marked.filter(F.col("hot_error").isNull()).join(few, F.col("label").eqNullSafe(F.col("own")))
    joined = marked.filter(F.col("hot_error").isNotNull()).withColumn("label_error", F.col("hot_error"))
    columns = ["vec_id", "code", "error", "label_error"]
    return joined.select(*columns).unionByName(rest.select(*columns)).withColumn("codebooks_sha256", F.lit(digest(books)))
