"""Language-model scores by prediction by partial matching, with a pretrained byte-context trie.

A text is its lower-cased words joined by one space, and an end symbol. A symbol is coded in its longest known context (up
to `order` bytes): seen there c times out of t, d different symbols, its probability is (2c - 1) / 2t, and d / 2t is the
probability of an escape to the context one byte shorter, where the symbols of the longer context are excluded from
counts, totals and escapes. Below the empty context all bytes not yet excluded are equally likely. Because every symbol
seen after a context was seen after its suffixes, the excluded set is that of the context just left, so the code length of
a symbol depends on the last order + 1 bytes alone: the trie turns into one code length for each such string.

Counts follow update exclusion: a symbol counts in a shorter context once for each longer context in which it was seen.

The trie is held as tables, one for each order, and the code lengths are built by joins from the shortest context up. Words
and strings reach their documents by blocks: documents are dealt into blocks of bounded text; a block names each of its
distinct words and strings once, keys are counted by shard over all blocks, and counts and code lengths go back to the
blocks, where documents meet them (cogroup). So nothing is broadcast, nothing is pruned, and what moves is a fraction of
the text. Word and string keys are 64 bits: words by XXH64, strings of up to 8 bytes as they are.

Cases: a null text is an empty one and has the end token alone; without learnt documents every byte is equally likely;
repeated rows are learnt and scored each; null ids are kept, their remainder is that of an empty text; an empty table
gives no rows; other columns are ignored. Long texts are read in overlapping parts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, shuffle_width

END = b"\n"
_PART = 1 << 20
WORDS, STRINGS = 0, 1
_NAMED = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_COUNTED = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])
_VALUED = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean", pa.float64(): "double"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def strings_of(text: bytes, order: int) -> Iterator[np.ndarray]:
    """For each byte of a text, it and the `order` bytes before it (zeros before the text) as one number, in parts."""
    data = np.concatenate([np.zeros(order, np.uint8), np.frombuffer(text, np.uint8)])
    for at in range(0, len(data) - order, _PART):
        part = data[at:at + _PART + order]
        n = len(part) - order
        found = part[:n].astype(np.uint64)
        for k in range(1, order + 1):
            found <<= np.uint64(8)
            found |= part[k:k + n]
        yield found


class Tally:
    """Distinct keys and how often they were learnt, in bounded memory besides them."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: tuple[list, list] = ([], [])
        self.held = 0

    def add(self, keys: np.ndarray, learnt: bool) -> None:
        self.waiting[learnt].append(keys)
        self.held += len(keys)
        if self.held > 1 << 21:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [(self.keys, self.counts)]
        for learnt, waiting in enumerate(self.waiting):
            if waiting:
                keys, n = np.unique(np.concatenate(waiting), return_counts=True)
                parts.append((keys, n * learnt))
        if len(parts) > 1:
            self.keys, self.counts = merged(parts)
        self.waiting, self.held = ([], []), 0
        return self.keys, self.counts


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several lists in order, and the sums of their counts."""
    keys, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _documents(block: pa.Table) -> Iterator[tuple[int, list[bytes], bytes]]:
    texts = block.column("text")
    for row in range(block.num_rows):
        words = (texts[row].as_py() or "").encode("utf-8", "surrogatepass").lower().split()
        yield row, words, b" ".join(words) + END


class Vocabulary(dict):
    """Numbers of the distinct words of a block, in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The numbers of a document's tokens: its words and the end."""
        return np.fromiter(map(self.__getitem__, [*words, END]), dtype=np.int32, count=len(words) + 1)

    def hashed(self) -> np.ndarray:
        """The keys of the words by number."""
        import xxhash

        return np.fromiter(map(xxhash.xxh64_intdigest, self), dtype=np.uint64, count=len(self))


def packed(values: np.ndarray, ordered: bool = False) -> bytes:
    """Numbers as compressed bytes, the first byte of all, then the second; `ordered` ones as differences."""
    values = np.diff(values, prepend=values.dtype.type(0)) if ordered else values
    return zlib.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unpacked(raw: bytes, kind: type, ordered: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(size, -1).T).view(kind)[:, 0]
    return np.cumsum(values, dtype=kind) if ordered else values


def name_keys(order: int, shards: int):
    """The distinct words and strings of a block, by shard of the key, with how often learnt documents hold them."""
    def of(block: pa.Table) -> pa.Table:
        known, tally, learnt = Vocabulary(), Tally(), [np.zeros(0, np.int32)]
        held_out = block.column("held_out").to_pylist()
        for row, words, body in _documents(block):
            own = known.numbers(words)
            if not held_out[row]:
                learnt.append(own)
            for part in strings_of(body, order):
                tally.add(part, not held_out[row])
        number, rows = block.column("block")[0].as_py(), []
        word_counts = merged([(known.hashed(), np.bincount(np.concatenate(learnt), minlength=len(known)))])
        for kind, (keys, counts) in enumerate((word_counts, tally.settle())):
            shard = shard_of(keys, shards, 50 if kind == WORDS else 4 * (order + 1))
            for k in np.unique(shard):
                mine = shard == k
                rows.append((kind, int(k), number, packed(keys[mine], True), packed(counts[mine])))
        return pa.table([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _NAMED)], schema=_NAMED)

    return of


def shard_of(keys: np.ndarray, shards: int, low: int) -> np.ndarray:
    """Shards by a hash of the bits above the `low` ones: keys that begin alike stay together and compress well."""
    top = keys >> np.uint64(low)
    mixed = (top ^ top >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(shards)).astype(np.int32)


def _blobs(named: pa.Table, column: str, kind: type) -> list[np.ndarray]:
    return [unpacked(x.as_py(), kind, column == "keys") for x in named.column(column)]


def count_keys(named: pa.Table) -> pa.Table:
    """The distinct keys of a shard and their counts over all blocks."""
    keys, counts = merged(list(zip(_blobs(named, "keys", np.uint64), _blobs(named, "counts", np.int64))))
    same = [np.full(len(keys), named.column(c)[0].as_py(), np.int32) for c in ("kind", "shard")]
    return pa.table([pa.array(c) for c in (*same, keys.view(np.int64), counts)], schema=_COUNTED)


def give_values(named: pa.Table, valued: pa.Table) -> pa.Table:
    """The values of a shard's keys, for each block that named them; code lengths in single precision."""
    keys, values = valued.column("key").to_numpy().view(np.uint64), valued.column("value").to_numpy().astype(np.float64)
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    if named.column("kind")[0].as_py() == STRINGS:
        values = values.astype(np.float32).astype(np.float64)
    found = [packed(values[np.searchsorted(keys, k)]) for k in _blobs(named, "keys", np.uint64)]
    return pa.table([named.column("kind"), named.column("block"), named.column("keys"), pa.array(found, type=pa.binary())], schema=_VALUED)


class Sums:
    """Sums of the values of keys by document, looked up for many documents at a time.

    The keys of about `_PART` bytes of text are sorted, with their documents in the bits that the keys leave free, so that the
    look-up goes through the table once, in its order.
    """

    def __init__(self, table: tuple[np.ndarray, np.ndarray], bits: int, documents: int):
        self.keys, self.values = table
        self.free, self.sums = 64 - bits, np.zeros(documents)
        self.waiting, self.held = [], 0

    def add(self, document: int, keys: np.ndarray) -> None:
        if self.waiting and document - self.waiting[0][0] >= 1 << self.free:
            self.settle()
        self.waiting.append((document, keys))
        self.held += len(keys)
        if self.held > 2 * _PART:
            self.settle()

    def settle(self) -> np.ndarray:
        if self.held:
            base = self.waiting[0][0]
            keys = np.concatenate([k for _, k in self.waiting])
            owners = np.repeat([d - base for d, _ in self.waiting], [len(k) for _, k in self.waiting]).astype(np.uint64)
            keys <<= np.uint64(self.free)
            keys |= owners
            keys.sort()
            owners = (keys & np.uint64((1 << self.free) - 1)).astype(np.int64)
            keys >>= np.uint64(self.free)
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            found = np.repeat(self.values[np.searchsorted(self.keys, keys[first])], np.diff(first, append=len(keys)))
            part = np.bincount(owners, weights=found)
            self.sums[base:base + len(part)] += part
        self.waiting, self.held = [], 0
        return self.sums


def score_block(order: int, total: int, distinct: int):
    """Scores of a block's documents with the values of its keys."""
    floor = math.log10(total + 0.5 * (distinct + 1))

    def of(block: pa.Table, values: pa.Table) -> pa.Table:
        tables = []
        for kind in (WORDS, STRINGS):
            some = values.filter(pa.array(values.column("kind").to_numpy() == kind))
            keys, found = (np.concatenate([np.zeros(0, t), *_blobs(some, c, t)]) for c, t in (("keys", np.uint64), ("values", np.float64)))
            at = np.argsort(keys)
            tables.append((keys[at], found[at]))
        n, known, own = block.num_rows, Vocabulary(), []
        lengths = Sums(tables[STRINGS], 8 * (order + 1), n)
        for row, words, body in _documents(block):
            own.append(known.numbers(words))
            for part in strings_of(body, order):
                lengths.add(row, part)
        hashed = known.hashed()
        at = np.argsort(hashed)  # counts of the distinct words, by their number
        counts = np.zeros(len(hashed))
        counts[at] = tables[WORDS][1][np.searchsorted(tables[WORDS][0], hashed[at])]
        logs, seen = np.log10(counts + 0.5), counts > 0
        tokens = [len(x) for x in own]
        base = [float(logs[x].sum() - floor * len(x)) for x in own]
        columns = [block.column("doc_id"), block.column("held_out"), tokens, [int(seen[x].sum()) for x in own], np.full(n, total), base, lengths.settle()]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, type=f.type) for c, f in zip(columns, _SCORED)], schema=_SCORED)

    return of


def code_lengths(strings: DataFrame, order: int) -> DataFrame:
    """(key, value): log10 of the probability of a string's last byte after the others; strings: key, n (0: not learnt)."""
    needed = [strings.select("key", "n")]
    for k in range(order, 0, -1):
        mask = F.lit((1 << (8 * k)) - 1)
        needed.append(cut(needed[-1].groupBy(F.col("key").bitwiseAND(mask).alias("key")).agg(F.count_if(F.col("n") > 0).alias("n"))))
    needed.reverse()
    zero = needed[0].filter(F.col("n") > 0).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("d")).first()
    t0, d0 = zero["t"], zero["d"]
    if t0:
        rest = math.log10(1 / (256 - d0)) if d0 < 256 else 0.0  # below the empty context
        known = F.log10((2 * F.col("n") - 1) / F.lit(2.0 * t0))
        level = needed[0].select("key", "n", F.lit(rest).alias("after"), F.when(F.col("n") > 0, known).otherwise(math.log10(d0 / (2 * t0)) + rest).alias("value"))
    else:
        level = needed[0].select("key", "n", F.lit(0.0).alias("after"), F.lit(-math.log10(256)).alias("value"))
    contexts = None
    for k in range(1, order + 1):
        below = level.select(F.col("key").alias("tail"), F.col("n").alias("n_below"), F.col("after").alias("after_below"), F.col("value").alias("value_below"))
        joined = cut(
            needed[k].withColumn("tail", F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1))).join(below, "tail")
            .withColumn("context", F.shiftright("key", 8)).drop("tail")
        )
        own = joined.filter(F.col("n") > 0).groupBy("context").agg(
            F.sum("n").alias("t"), F.count(F.lit(1)).alias("d"), F.sum("n_below").alias("gone"))
        if contexts is None:
            wide = own.withColumn("t_below", F.lit(t0)).withColumn("d_below", F.lit(d0))
        else:
            up = contexts.select(F.col("context").alias("tail"), F.col("t").alias("t_below"), F.col("d").alias("d_below"))
            wide = own.withColumn("tail", F.col("context").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1))).join(up, "tail").drop("tail")
        contexts = cut(wide.select("context", "t", "d", (F.col("t_below") - F.col("gone")).alias("t_left"), (F.col("d_below") - F.col("d")).alias("d_left")))
        escaped = F.when(F.col("d_left") > 0, F.log10(F.try_divide(F.col("d_left"), 2 * F.col("t_left")))).otherwise(0.0) + F.col("after_below")
        # Where the longer context holds the symbol itself nothing may be left to divide by; that value is never used.
        after = F.when(F.col("n_below") > 0, F.log10(F.try_divide(2 * F.col("n_below") - 1, 2 * F.col("t_left")))).otherwise(escaped)
        value = (
            F.when(F.col("t").isNull(), F.col("value_below"))
            .when(F.col("n") > 0, F.log10((2 * F.col("n") - 1) / (2 * F.col("t"))))
            .otherwise(F.log10(F.col("d") / (2 * F.col("t"))) + F.col("after"))
        )
        level = joined.join(contexts, "context", "left").withColumn("after", after).select("key", "n", "after", value.alias("value"))
        level = level if k == order else cut(level)
    return level.select("key", "value")


def scores(docs: DataFrame, held_out: Column, order: int = 5, block_bytes: int = 48 << 20, shard_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    The model learns from the documents without `held_out`, an expression over doc_id. A block has about `block_bytes` of
    text; there is a shard of keys for each `shard_bytes` of all text at least, so that a shard's keys stay bounded.
    """
    if not 1 <= order <= 7:
        raise ValueError("an order of 1 to 7 bytes fits a key")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    width = shuffle_width(docs.sparkSession)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    blocks, shards = max(12, math.ceil(size / block_bytes)), max(width, math.ceil(size / shard_bytes))
    dealt = texts.select("doc_id", held_out.alias("held_out"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))
    named = cut(dealt.groupBy("block").applyInArrow(name_keys(order, shards), _ddl(_NAMED)))
    counted = cut(named.groupBy("kind", "shard").applyInArrow(count_keys, _ddl(_COUNTED)))
    words = counted.filter(F.col("kind") == WORDS)
    learnt = words.filter(F.col("n") > 0).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    lengths = code_lengths(counted.filter(F.col("kind") == STRINGS), order)
    by_string = counted.filter(F.col("kind") == STRINGS).select("kind", "shard", "key").join(lengths, "key").select("kind", "shard", "key", "value")
    valued = words.select("kind", "shard", "key", F.col("n").cast("double").alias("value")).unionByName(by_string)
    given = named.select("kind", "shard", "block", "keys").groupBy("kind", "shard").cogroup(valued.groupBy("kind", "shard")).applyInArrow(give_values, _ddl(_VALUED))
    return dealt.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(score_block(order, learnt["n"], learnt["v"]), _ddl(_SCORED))
