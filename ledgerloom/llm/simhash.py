"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: words, shingles of `words` of them, a 64-bit hash for each shingle, and the majority of each bit.

Linking is exact. Every bit position gets a non-zero vector of radius + 1 bits, the positions dealt evenly over the
2^(radius+1) - 1 vectors; table v keeps the positions whose vector has odd parity with v. The vectors of any `radius`
positions leave some v with even parity on all of them, so two fingerprints within the radius agree on all kept bits of
that table: every such pair shares a bucket, without exception.

Work stays bounded where many fingerprints are alike:

* equal fingerprints become one row before anything else;
* members of a bucket differ only in the positions that its table drops. A bucket with more than `BUSY` members is dealt
  again by a covering of those positions alone, which again loses no pair, and so on; once at most 6 positions are left a
  bucket holds at most 64 fingerprints. So no bucket's pairs are listed before it is small, and no pair is left out.

Components come from `components.py`.

Cases: null and empty texts have fingerprint zero and are linked like any other; a text with fewer words than a shingle is
one shingle; null ids stay rows of their own with a fingerprint and take part in links, but never name a component unless
all its ids are null; repeated rows share their component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of, cut
from ledgerloom.llm.components import components

BITS = 64
#: Members of a bucket up to which its pairs are compared as they are.
BUSY = 64
_ROW = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprint(text: str | None, words: int) -> int:
    """The 64-bit fingerprint of a whole text."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    last = max(0, len(found) - words) + 1
    stops = (starts + lengths)[min(words, len(found)) - 1:]
    of, counts, seen = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), 0
    spans = list(zip(starts[:last].tolist(), stops.tolist()))
    for at in range(0, len(spans), 1 << 16):  # long texts by parts
        hashes = np.array([of(joined[a:b], 42) for a, b in spans[at:at + (1 << 16)]], dtype=np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        seen += len(hashes)
    return int(np.packbits(2 * counts > seen, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long), one row per document."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], dtype=np.uint64)
            yield batch_of(_ROW, batch.column("doc_id"), fps.view(np.int64))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(of, "doc_id long, fp long")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over `positions`, such that any `radius` positions are all dropped by at least one of them."""
    vectors = range(1, 1 << (radius + 1))
    dealt = [(p, 1 + k % len(vectors)) for k, p in enumerate(positions)]
    return [sum(1 << p for p, vector in dealt if (vector & v).bit_count() & 1) for v in vectors]


def signed(mask: int) -> int:
    """A 64-bit mask as a signed long."""
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def close_pairs(fps: DataFrame, radius: int) -> DataFrame:
    """Every pair (a < b) of distinct values of `fp` that differ in 1 to `radius` bits; a pair may come more than once."""
    everything = (1 << BITS) - 1
    kept, rows, found = [0], fps.select("fp", F.lit(0).alias("table")), []
    while True:
        kept = [k | mask for k in kept for mask in covering_masks([p for p in range(BITS) if not k >> p & 1], radius)]
        fan = (1 << (radius + 1)) - 1
        masks = F.array(*[F.lit(signed(k)) for k in kept])
        dealt = rows.select(
            "fp", F.explode(F.sequence(F.col("table") * fan, F.col("table") * fan + fan - 1)).alias("table")
        ).withColumn("key", F.col("fp").bitwiseAND(F.element_at(masks, F.col("table") + 1)))
        sizes = dealt.groupBy("table", "key").count().filter(F.col("count") > 1)
        last = all((everything & ~k).bit_count() <= 6 for k in kept)
        shared = cut(dealt.join(sizes, ["table", "key"]).select("fp", "table", "key", (F.col("count") > BUSY).alias("busy")))
        few = shared if last else shared.filter(~F.col("busy"))
        left = few.select("table", "key", F.col("fp").alias("a"))
        right = few.select("table", "key", F.col("fp").alias("b"))
        near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        found.append(left.join(right, ["table", "key"]).filter(near).select("a", "b"))
        rows = shared.filter("busy").select("fp", "table")
        if last or rows.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def linked(docs: DataFrame, words: int, radius: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest id it can reach)."""
    fps = cut(fingerprints(docs, words, id_col, text_col))
    each = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(close_pairs(each, radius))
    placed = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("fp", "root").join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words: int, radius: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of one document of each component: the one with the smallest id.

    Of rows that repeat an id one stays; rows without an id cannot be told apart and stay.
    """
    first = linked(docs, words, radius, id_col, text_col).filter(F.col("doc_id") == F.col("component_id"))
    stay = first.select(F.col("doc_id").alias("__stay")).distinct()
    kept = docs.join(stay, F.col(id_col) == F.col("__stay"), "left_semi").dropDuplicates([id_col])
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))
