"""Packing of tokenised documents by shortest-pack-first over the length histogram.

A document is its token ids and a closing id; it is cut every `capacity` ids, so a piece is as long as the capacity or the
rest of its document. Only the histogram of piece lengths (at most `capacity` rows) reaches the driver. There lengths are
placed from the longest to the shortest, each time into the emptiest pack that has room, and whole counts move at once:
the state is packing patterns with counts, at most about two for each length, whatever the number of documents. Pieces get
a rank among those of their length, and the slots of the patterns are ranges of such ranks, so each piece finds its
sequence and offset without meeting the others.

Ranks are made in two steps (row numbers inside hashed buckets of a length, then sums over the buckets), because one
length, above all the full one, may hold most pieces.

Cases: a null text is an empty one and gives the closing id alone; repeated rows and ids are pieces like any other; null
ids are kept; an empty table gives no rows; other columns are ignored. A long text is tokenised whole, in a task of its own
arrays. Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of, cut, row_slices, shuffle_width

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
PACKED = pa.schema([*PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])
#: Words whose ids a worker remembers; beyond it starts anew. It bounds memory and changes no result.
REMEMBERED = 300_000
#: Marks that the tokenizer parts from the letters before them.
MARKS = ".,!?#$%&*|;:"
PLAIN_WORD = r"^(?P<stem>\p{L}+)(?P<tail>[.,!?#$%&*|;:]*)$"
_BOOKS: dict[str, "WordIds"] = {}


class WordIds:
    """Token ids by word for one tokenizer file.

    A word with the space before it is encoded the same wherever it stands, since the byte-level tokenizers start a new
    piece at a single space. Texts with other runs of white space are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def learn(self, words: list[str]) -> None:
        """Ids of words that hold no line end, many in one call: line ends between them show where each one ends."""
        for at in range(0, len(words), 256):
            some = words[at:at + 256]
            ids = self.whole("\n".join(some))
            raw, ends = ids.tobytes(), (4 * np.append(np.flatnonzero(ids == self.line), len(ids))).tolist()
            self.known.update(zip(some, [raw[a:b] for a, b in zip([0, *[e + 4 for e in ends]], ends)]))

    @staticmethod
    def parts(word: str) -> list[str] | None:
        """Strings without line ends or inner space whose ids make up the word's ids; None if that is not plain."""
        found = []
        for k, part in enumerate(word.split("\n")):
            if k:
                found.append("\n")
            stem = part.rstrip(MARKS)
            if stem[1:].isalpha() and (stem[0] == " " or stem[0].isalpha()):  # letters, then marks: two pieces
                found += [stem, part[len(stem):]] if len(stem) < len(part) else [stem]
            elif part and part.split() == [part.removeprefix(" ")]:
                found.append(part)
            else:
                return None
        return found

    def of(self, words: list[str], plain: bool = False) -> list[bytes]:
        """Ids of each word, little-endian; `plain`: the words are without line ends and inner space."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        self.known["\n"] = np.array([self.line], dtype="<u4").tobytes()
        if plain:
            self.learn([w for w in words if w not in self.known])
            return list(map(self.known.__getitem__, words))
        found = list(map(self.known.get, words))
        missing = {k: self.parts(words[k]) for k, ids in enumerate(found) if ids is None}
        self.learn([w for w in dict.fromkeys(p for parts in missing.values() for p in parts or ()) if w not in self.known])
        for k, parts in missing.items():
            found[k] = self.whole(words[k]).tobytes() if parts is None else b"".join(map(self.known.__getitem__, parts))
            self.known[words[k]] = found[k]
        return found


def book(path: str) -> WordIds:
    """The worker's word book for a tokenizer file."""
    if path not in _BOOKS:
        _BOOKS[path] = WordIds(path)
    return _BOOKS[path]


def _gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `pool` that `order` names (each with a start and a size), one after the other, and where each begins."""
    size = sizes[order]
    at = np.concatenate([[0], np.cumsum(size)])
    return pool[np.repeat(starts[order] - at[:-1], size) + np.arange(at[-1])], at


def token_ids(texts: pa.Array, words: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and where each text's ids begin (one more entry than texts)."""
    split = pc.split_pattern(texts, " ")
    coded = split.flatten().dictionary_encode()
    index, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    firsts = split.offsets.to_numpy()[:-1].astype(np.int64) - split.offsets[0].as_py()
    # Distinct words: letters and the marks behind them are two pieces; anything else is looked at one by one.
    parted = pc.extract_regex(names, PLAIN_WORD)
    plain = parted.is_valid().to_numpy(zero_copy_only=False)
    stems, tails = (pc.struct_field(parted.filter(pa.array(plain)), f).dictionary_encode() for f in ("stem", "tail"))
    others = names.filter(pa.array(~plain)).to_pylist()
    starts = pc.take(names, pa.array(index[firsts])).to_pylist()
    ids = [b"", *words.of([" " + w for w in stems.dictionary.to_pylist()], plain=True), *words.of(tails.dictionary.to_pylist()),
           *words.of([" " + w for w in others]), *words.of(starts)]
    odd = np.zeros(len(names) + len(starts), bool)
    odd[np.flatnonzero(~plain)] = [not w or w[0].isspace() for w in others]
    at_tails, at_others = 1 + len(stems.dictionary), 1 + len(stems.dictionary) + len(tails.dictionary)
    halves = np.zeros((len(names) + len(starts), 2), np.int64)
    halves[:len(names)][plain, 0] = 1 + stems.indices.to_numpy()
    halves[:len(names)][plain, 1] = at_tails + tails.indices.to_numpy()
    halves[:len(names)][~plain, 0] = at_others + np.arange(len(others))
    halves[len(names):, 0] = at_others + len(others) + np.arange(len(starts))
    index[firsts] = np.arange(len(names), len(halves))  # no space before the first word of a text
    counts = np.diff(np.append(firsts, len(index)))
    whole = np.flatnonzero(np.logical_or.reduceat(odd[index], firsts)) if odd.any() else np.zeros(0, np.int64)
    if len(whole):  # white space in runs: the whole text at once
        stay = np.ones(len(index), bool)
        for extra, row in enumerate(whole):
            stay[firsts[row] + 1:firsts[row] + counts[row]] = False
            index[firsts[row]] = len(halves) + extra
            ids.append(words.whole(texts[int(row)].as_py()).tobytes())
        more = np.zeros((len(whole), 2), np.int64)
        more[:, 0] = len(ids) - len(whole) + np.arange(len(whole))
        halves, index, counts[whole] = np.concatenate([halves, more]), index[stay], 1
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    distinct, at = _gathered(np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(sizes) - sizes, sizes, halves.ravel())
    taken, at = _gathered(distinct, at[:-1:2], np.diff(at[::2]), index)
    return taken, at[np.concatenate([[0], np.cumsum(counts)])]


def cut_texts(batches: Iterator[pa.RecordBatch], path: str, capacity: int, closing: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents in a partition."""
    words, end = book(path), np.array([closing], dtype="<u4").tobytes()
    for batch in batches:
        texts = batch.column("text").fill_null("").cast(pa.string())
        sizes = pc.binary_length(texts).to_numpy()
        first = 0
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + (8 << 20), side="right")) - 1)
            some = pa.concat_arrays([texts.slice(first, last - first)])
            ids, at = token_ids(some, words)
            raw, out = memoryview(ids.astype("<u4").tobytes()), ([], [], [], [], [])
            for row in range(last - first):
                own = raw[4 * at[row]:4 * at[row + 1]]
                n, doc = len(own) // 4 + 1, batch.column("doc_id")[first + row].as_py()
                for start in range(0, n, capacity):
                    stop = min(start + capacity, n)
                    crc = zlib.crc32(own[4 * start:4 * stop])
                    if stop == n:
                        crc = zlib.crc32(end, crc)
                    for column, value in zip(out, (doc, start, stop - start, crc, n)):
                        column.append(value)
            yield batch_of(PIECES, *out)
            first = last


def packing_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, number of such packs): the longest lengths first, each into the emptiest pack with room."""
    packs: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(packs, default=0)
            if room < length:
                pattern, held = (), left
            else:
                pattern, held = next(iter(packs[room].items()))
                moved = min(held, left)
                packs[room][pattern] -= moved
                if not packs[room][pattern]:
                    del packs[room][pattern]
                if not packs[room]:
                    del packs[room]
                held = moved
            into = packs.setdefault((room if pattern else capacity) - length, {})
            into[(*pattern, length)] = into.get((*pattern, length), 0) + held
            left -= held
    return sorted((pattern, n) for group in packs.values() for pattern, n in group.items())


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length, its slots in order: first rank, first sequence, offset."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            found.setdefault(length, []).append((ranks.get(length, 0), sequence, offset))
            ranks[length] = ranks.get(length, 0) + n
            offset += length
        sequence += n
    return {length: np.array(rows, dtype=np.int64) for length, rows in found.items()}


def ranked(pieces: DataFrame) -> DataFrame:
    """`pieces` with `rank`, 0 upwards among the pieces of a length."""
    buckets = shuffle_width(pieces.sparkSession)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    numbered = dealt.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["length", "bucket"]).withColumn("rank", F.col("earlier") + F.col("place"))


def pack(docs: DataFrame, path: str, capacity: int = 1024, closing: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = cut(rows.mapInArrow(lambda it: cut_texts(it, path, capacity, closing), kind))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    by_length = slots(packing_patterns(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                mine, table = np.flatnonzero(length == one), by_length[int(one)]
                slot = np.searchsorted(table[:, 0], rank[mine], side="right") - 1
                sequence[mine] = table[slot, 1] + rank[mine] - table[slot, 0]
                offset[mine] = table[slot, 2]
            yield batch_of(PACKED, *(batch.column(f.name) for f in PIECES), sequence, offset)

    return ranked(pieces).select(*PIECES.names, "rank").mapInArrow(place, kind + ", sequence_id long, offset long")
