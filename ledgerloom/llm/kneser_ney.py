"""Quality: an interpolated modified Kneser-Ney model of trusted text, and thresholds of perplexity by language.

The model is of order 4 over all 256 bytes and a symbol for the start of a text. Counts of all n-grams, their continuation
counts, the three discounts of each order and the context totals are tables; joins on the context (which shards them) turn
them into interpolated probabilities and back-off weights, each order using the table of the one below. The model stays in
tables: neither the driver nor a broadcast holds it.

Documents are dealt into blocks of bounded text. A block names each of its distinct n-grams once, with its number in trusted
documents; those numbers, summed over the blocks, are the counts of the model. The distinct n-grams of all blocks get their probability by joins with the tables, from the shortest up, and go back to the blocks that named them,
where documents meet them (cogroup). No key of these joins has more rows than there are symbols, or blocks. `train` is the
same model over the 46 most frequent bytes as one array, small enough to look at; nothing is scored with it.

The trusted documents are those that a label marks; the model learns from all of them. A caller may bound that by `trusted`
(documents in order of a hash of the id). The threshold of a language is the `quantile` of the perplexities of all its trusted documents,
learnt from or not; a language without any takes the quantile over all trusted documents. A document is kept if its perplexity does not exceed the threshold.

Cases: null and empty texts have no perplexity and are not kept; a null language is a language of its own; without trusted
text there is no model: perplexity and threshold are null and every document with text is kept; repeated rows are treated
alike; an empty table gives no rows; other columns are ignored. Long texts are read whole, in one pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of, cut, text_slices, written
from ledgerloom.llm.ppm import Tally

#: Symbols of the array that `train` gives; symbols of the model: the start of a text, then the bytes.
SYMBOLS, ALPHABET, ORDER = 48, 257, 4
_EVERY_BYTE = np.arange(1, ALPHABET, dtype=np.uint16)
_COUNTS = pa.schema([("gram", pa.int64()), ("n", pa.int64())])
_NAMED = pa.schema([("block", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_bytes", pa.int64()), ("perplexity", pa.float64())])


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(256, dtype=np.int64)
    for batch in batches:
        for _, data, _ in text_slices(batch, "text"):
            held += np.bincount(data, minlength=256)
    yield batch_of(_COUNTS, np.arange(256), held)


def _grams(data: np.ndarray, at: np.ndarray, symbol: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte, and the row of each byte; bytes before a row's start are the start symbol."""
    symbols, rows = symbol[data].astype(np.int64), np.repeat(np.arange(len(at) - 1), np.diff(at))
    gram = symbols.copy()
    since = np.arange(len(data)) - at[rows]
    for back in range(1, ORDER):
        earlier = np.concatenate([np.zeros(min(back, len(symbols)), np.int64), symbols[:-back]])[:len(symbols)]
        gram += np.where(since >= back, earlier, 0) * base**back
    return gram, rows


def _discounts(counts: DataFrame) -> list[float]:
    """Discounts for counts 0, 1, 2 and from 3 up, from the numbers of n-grams seen once to four times."""
    seen = {r["n"]: r["count"] for r in counts.filter(F.col("n") <= 4).groupBy("n").count().collect()}
    n1, n2, n3, n4 = (seen.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [k - (k + 1) * y * more / less if less else 0.5 * k for k, (less, more) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    return [0.0, *(min(max(d, 0.1), 0.9 * k) for k, d in enumerate(raw, 1))]


def _context(base: int) -> Column:
    """The n-gram without its last symbol."""
    return F.floor(F.col("gram") / base).cast("long").alias("context")


def _last(symbols: int, base: int) -> Column:
    """The last symbols of the n-gram."""
    return F.pmod(F.col("gram"), F.lit(base**symbols)).cast("long")


def _interpolated(counts: DataFrame, lower: DataFrame | None, order: int, base: int) -> tuple[DataFrame, DataFrame]:
    """(gram, p) of the seen n-grams of an order, and (context, back) of its contexts; joins on context and on suffix."""
    d = _discounts(counts)
    cost = F.when(F.col("n") >= 3, d[3]).when(F.col("n") == 2, d[2]).otherwise(d[1])
    split = counts.select("gram", "n", _context(base), cost.alias("cost"))
    contexts = split.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("cost") / F.sum("n")).alias("back"))
    joined = split.join(contexts, "context")
    own = (F.col("n") - F.col("cost")) / F.col("total")
    if lower is None:
        return joined.select("gram", (own + F.col("back") / base).alias("p")), contexts.select("context", "back")
    below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_below"))
    full = joined.withColumn("suffix", _last(order - 1, base)).join(below, "suffix")
    return full.select("gram", (own + F.col("back") * F.col("p_below")).alias("p")), contexts.select("context", "back")


def counts_of(trusted: DataFrame, symbol: np.ndarray, base: int) -> DataFrame:
    """(gram, n): how often each n-gram of the highest order stands in the texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for _, data, at in text_slices(batch, "text"):
                tally.add(_grams(data, at, symbol, base)[0].view(np.uint64), True)
        keys, n = tally.settle()
        yield batch_of(_COUNTS, keys.view(np.int64), n)

    return trusted.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def tables(counts: DataFrame, base: int) -> list[tuple[DataFrame, DataFrame]] | None:
    """For each order (gram, p) of the seen n-grams and (context, back) of their contexts; None without any.

    ``counts`` has (gram, n) of the highest order.
    """
    counted = [cut(counts)]
    if counted[0].isEmpty():
        return None
    for order in range(ORDER - 1, 0, -1):  # below the top, n is the number of different symbols seen before the n-gram
        counted.append(cut(counted[-1].groupBy(_last(order, base).alias("gram")).agg(F.count(F.lit(1)).alias("n"))))
    found, lower = [], None
    for order, counts in enumerate(reversed(counted), 1):
        seen, contexts = _interpolated(counts, lower, order, base)
        lower = cut(seen)
        found.append((lower, cut(contexts)))
    return found


def train(trusted: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Symbol of each byte, and log10 P(last symbol | the ones before) of every n-gram of few symbols; None without text."""
    found = trusted.select("text").mapInArrow(_byte_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    held = np.zeros(256, dtype=np.int64)
    held[found["gram"]] = found["n"]
    if not held.any():
        return None
    symbol = np.ones(256, dtype=np.uint8)  # 0: before the text, 1: any other byte
    frequent = [b for b in np.lexsort((np.arange(256), -held)) if held[b]][:SYMBOLS - 2]
    symbol[frequent] = np.arange(2, 2 + len(frequent))
    dense = np.full(SYMBOLS, 1 / SYMBOLS)
    for order, (seen, contexts) in enumerate(tables(counts_of(trusted, symbol, SYMBOLS), SYMBOLS), 1):
        p, back = seen.toPandas(), contexts.toPandas()  # at most 48^order rows each
        weight = np.ones(SYMBOLS ** (order - 1))
        weight[back["context"]] = back["back"]
        below = dense if order == 1 else np.tile(dense, SYMBOLS)
        dense = below * np.repeat(weight, SYMBOLS)
        dense[p["gram"]] = p["p"]
    return symbol, np.log10(dense).astype(np.float32)


def log_probabilities(grams: DataFrame, model: list[tuple[DataFrame, DataFrame]], base: int) -> DataFrame:
    """(gram, value): log10 P(last symbol | the ones before) of distinct n-grams, seen or not."""
    needed = [grams]
    for order in range(ORDER - 1, 0, -1):
        needed.append(cut(needed[-1].select(_last(order, base).alias("gram")).distinct()))
    level = None
    for order, (seen, contexts) in enumerate(model, 1):
        rows = needed[ORDER - order].select("gram", _context(base), _last(order - 1, base).alias("suffix"))
        if level is None:
            rows = rows.withColumn("p_below", F.lit(1 / base))
        else:
            rows = rows.join(level.select(F.col("gram").alias("suffix"), F.col("p").alias("p_below")), "suffix")
        rows = rows.join(seen, "gram", "left").join(contexts, "context", "left")
        level = cut(rows.select("gram", F.coalesce("p", F.coalesce("back", F.lit(1.0)) * F.col("p_below")).alias("p")))
    return level.select("gram", F.log10("p").alias("value"))


def name_grams(block: pa.Table, learnt: pa.Table) -> pa.Table:
    """The distinct n-grams of a block and how often each stands in the documents that `learnt` lists."""
    tally, ids = Tally(), learnt.column("id").to_numpy()
    for batch in block.to_batches():
        own = batch.column("doc_id")
        learns = np.isin(own.fill_null(0).to_numpy(), ids) & own.is_valid().to_numpy(zero_copy_only=False)
        for first, data, at in text_slices(batch, "text"):
            grams, rows = _grams(data, at, _EVERY_BYTE, ALPHABET)
            taken = learns[first + rows]
            tally.add(grams[taken].view(np.uint64), True)
            tally.add(grams[~taken].view(np.uint64), False)
    keys, n = tally.settle()
    number = block.column("block")[0].as_py() if block.num_rows else 0
    return pa.table([pa.array(np.full(len(keys), number, np.int32)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], schema=_NAMED)


def score_block(block: pa.Table, values: pa.Table) -> pa.Table:
    """Perplexities of a block's documents with the values of its n-grams."""
    known, value = (values.column(c).to_numpy() for c in ("gram", "value"))
    order = np.argsort(known)
    known, value = known[order], value[order]
    out = []
    for batch in block.to_batches():
        sizes, logs = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
        for first, data, at in text_slices(batch, "text"):
            own = slice(first, first + len(at) - 1)
            sizes[own] = np.diff(at)
            if len(data):
                grams, rows = _grams(data, at, _EVERY_BYTE, ALPHABET)
                logs[own] = np.bincount(rows, weights=value[np.searchsorted(known, grams)], minlength=len(at) - 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            ppl = 10.0 ** (-logs / sizes)
        out.append(batch_of(_SCORES, batch.column("doc_id"), batch.column("lang"), sizes, pa.array(ppl, mask=sizes == 0)))
    return pa.Table.from_batches(out, schema=_SCORES)


def dealt(docs: DataFrame, block_bytes: int = 48 << 20) -> DataFrame:
    """doc_id, lang, text and block: documents by a hash of id and text, blocks of about `block_bytes`."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    blocks = max(12, math.ceil((docs.agg(F.sum(size).alias("b")).first()["b"] or 0) / block_bytes))
    return docs.select("doc_id", "lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))


def named_grams(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(block, gram, n): the distinct n-grams of each block of `dealt` documents, n of them in documents whose id is in `ids`.

    The texts meet no list of ids: the ids go to the blocks of their documents as narrow rows.
    """
    learnt = docs.join(ids, "doc_id").select(F.col("block").alias("of"), F.col("doc_id").alias("id")).distinct()
    texts = docs.select("block", "doc_id", "text").groupBy("block")
    return texts.cogroup(learnt.groupBy("of")).applyInArrow(name_grams, "block int, gram long, n long")


def perplexities(docs: DataFrame, named: DataFrame, model: list[tuple[DataFrame, DataFrame]] | None) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity (for each byte) of whole texts; of `dealt` documents and their `named` n-grams."""
    if model is None:
        size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
        return docs.select("doc_id", "lang", size.alias("n_bytes"), F.lit(None).cast("double").alias("perplexity"))
    values = log_probabilities(cut(named.select("gram").distinct()), model, ALPHABET)
    given = named.join(values, "gram").select("block", "gram", "value")
    return docs.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(
        score_block, "doc_id long, lang string, n_bytes long, perplexity double")


def quality(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, trusted: int | None = None, id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """One row per document: doc_id, lang, n_bytes, perplexity, threshold, kept."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
    good_ids = (
        labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(F.col(label_col).cast("int")).alias("good"))
        .filter(F.col("doc_id").isNotNull() & (F.col("good") == 1)).select("doc_id")
    )
    ids = good_ids if trusted is None else cut(good_ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted))
    blocks = dealt(texts)
    named = written(named_grams(blocks, ids), freed=True)
    model = tables(named.filter("n > 0").groupBy("gram").agg(F.sum("n").alias("n")), ALPHABET)
    scored = cut(perplexities(blocks, named, model))
    good = scored.join(good_ids, "doc_id").filter(F.col("perplexity").isNotNull())
    at = F.percentile_approx("perplexity", quantile, 10_000)
    by_lang = good.groupBy("lang").agg(at.alias("own"))
    overall = good.agg(at.alias("threshold")).first()["threshold"]
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    return (
        scored.join(by_lang.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of")), "left")
        .select("doc_id", "lang", "n_bytes", "perplexity", limit.alias("threshold"))
        .withColumn("kept", (F.col("n_bytes") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
    )
