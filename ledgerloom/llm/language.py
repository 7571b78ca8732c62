"""Language identification as a mixture of languages.

Each language has a model of letter trigrams (lower-cased bytes, anything but letters counts as a space), learnt from
labelled texts. A document is a mixture: each of its words comes from one language, with the likelihood its trigrams have
there, and expectation-maximisation estimates the proportions. The set of languages is the one with the best likelihood
less a penalty for each language (half the logarithm of the number of words, and a constant). If the best single language
comes within one penalty of the likelihood of all languages together, no larger set can win; else languages are removed
one by one, the one with the smallest proportion first, as long as the penalised likelihood grows.

All documents of a slice run through the iterations together as arrays. The model is languages x 2^17 floats; counting it
is a sum over all labelled documents. More than `most` languages raise an error, as the model would outgrow its bound.

Cases: `und` with score 0 for a null text, a text without a letter, or when nothing was learnt; ties go to the first
language in alphabetical order; repeated rows are treated alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of, text_slices

BITS = 17
BUCKETS = 1 << BITS
#: What another language costs besides half the logarithm of the number of words.
PENALTY = 3.0
_LETTER = np.arange(256, dtype=np.uint32)
_LETTER[:128] = 32
_LETTER[97:123] = np.arange(97, 123)
_COUNTS = pa.schema([("language", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])


def _trigrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of bytes that begin with a space: places of letters, and the bucket of the trigram around each."""
    b = np.append(_LETTER[data], np.uint32(32))
    at = np.flatnonzero(b != 32)
    gram = b[at - 1] | b[at] << np.uint32(8) | b[at + 1] << np.uint32(16)
    mixed = (gram ^ gram >> np.uint32(11)) * np.uint32(2654435761)
    return at, (mixed ^ mixed >> np.uint32(15)) * np.uint32(2246822519) >> np.uint32(32 - BITS)


def mixtures(likes: np.ndarray, starts: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) with the chosen set of languages, and its penalised log-likelihood.

    `likes`: log-likelihood of each word in each language; `starts`: the first word of each document, none empty.
    """
    sizes = np.diff(np.append(starts, len(likes)))
    cost = PENALTY + 0.5 * np.log(sizes)
    singles = np.add.reduceat(likes, starts, axis=0)
    best = singles.argmax(axis=1)
    share = np.zeros((len(starts), likes.shape[1]))
    share[np.arange(len(starts)), best] = 1.0
    value = singles.max(axis=1) - cost
    if likes.shape[1] == 1:
        return share, value

    def fit(docs: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = sizes[docs]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        rows = np.repeat(starts[docs] - first, size) + np.arange(size.sum())
        owner, like = np.repeat(np.arange(len(docs)), size), likes[rows]
        top = like.max(axis=1)
        odds = np.exp(like - top[:, None])
        mix = active / active.sum(axis=1, keepdims=True)
        for _ in range(rounds):
            joint = odds * mix[owner]
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
            mix = np.add.reduceat(joint, first, axis=0) / size[:, None]
        total = np.log(np.maximum((odds * mix[owner]).sum(axis=1), 1e-300)) + top
        return mix, np.add.reduceat(total, first)

    docs = np.arange(len(starts))
    active = np.ones((len(docs), likes.shape[1]))
    mix, like = fit(docs, active)
    open_ = like - 2 * cost > value  # else no set of two or more can beat the best single language
    docs, active, mix, like = docs[open_], active[open_], mix[open_], like[open_]
    while len(docs):
        now = like - active.sum(axis=1) * cost[docs]
        better = now > value[docs]
        value[docs[better]], share[docs[better]] = now[better], mix[better]
        least = np.where(active > 0, mix, np.inf).argmin(axis=1)
        active = active.copy()
        active[np.arange(len(docs)), least] = 0
        more = active.sum(axis=1) > 1
        docs, active = docs[more], active[more]
        if len(docs):
            mix, like = fit(docs, active)
    return share, value


def learn(texts: DataFrame, most: int = 512) -> tuple[list[str], np.ndarray]:
    """The languages in `lang`, in alphabetical order, and their log-probabilities by bucket, from all of `texts`."""
    found = [r["lang"] for r in texts.select("lang").distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} languages")
    names = sorted(found)
    place = {name: k for k, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(names) * BUCKETS, dtype=np.int64)
        for batch in batches:
            own = np.array([place[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for first, data, at in text_slices(batch, "text"):
                letters, bucket = _trigrams(data)
                row = np.searchsorted(at, letters, side="right") - 1
                held += np.bincount(own[first + row] * BUCKETS + bucket, minlength=len(held))
        seen = np.flatnonzero(held)
        yield batch_of(_COUNTS, (seen // BUCKETS).astype(np.int32), (seen % BUCKETS).astype(np.int32), held[seen])

    sums = texts.select("text", "lang").mapInArrow(count, "language int, bucket int, n long")
    counts = sums.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas() if names else None
    held = np.zeros((len(names), BUCKETS))
    if names:
        held[counts["language"], counts["bucket"]] = counts["n"]
    return names, np.log((held + 0.5) / (held.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)).astype(np.float32)


def predictions(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                key_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (proportion of that language), languages (chosen set).

    With `key_col`, a long that tells rows apart, also `key`.

    Learns from the rows with a language and without `held_out`, which is an expression over doc_id.
    """
    spark = docs.sparkSession

    def prepared(df: DataFrame, *more) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("raw"), *more)

    body = F.concat(F.lit(" "), F.lower("raw")).alias("text")
    labelled = prepared(docs, F.col(lang_col).cast("string").alias("lang"))
    names, model = learn(labelled.filter(F.col("lang").isNotNull() & F.col("raw").isNotNull() & ~held_out).select(body, "lang"))
    known = spark.sparkContext.broadcast(np.ascontiguousarray(model.T))  # languages x 2^17 floats

    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())), ("key", pa.int64())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for batch in batches:
            has = batch.column("has_letter").to_numpy(zero_copy_only=False)
            who, score, sets = ["und"] * len(has), np.zeros(len(has)), [[] for _ in range(len(has))]
            for first, data, at in text_slices(batch, "text", max(1 << 16, (1 << 21) // max(1, len(names)))):
                letters, bucket = _trigrams(data)
                if not len(letters) or not names:
                    continue
                begins = np.flatnonzero(_LETTER[data[letters - 1]] == 32)
                likes = np.add.reduceat(table[bucket], begins, axis=0, dtype=np.float64)
                owner = np.searchsorted(at, letters[begins], side="right") - 1
                starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                share, _ = mixtures(likes, starts)
                top = share.argmax(axis=1)
                for k, row in enumerate(first + owner[starts]):
                    if has[row]:
                        who[row], score[row] = names[top[k]], share[k, top[k]]
                        sets[row] = [names[j] for j in np.flatnonzero(share[k] > 0)]
            yield batch_of(schema, batch.column("doc_id"), batch.column("held_out"), who, np.clip(score, 0, 1), sets, batch.column("key"))

    key = F.lit(None) if key_col is None else F.col(key_col)
    rows = prepared(docs, key.cast("long").alias("key")).select("doc_id", "key", held_out.alias("held_out"), F.coalesce(body, F.lit(" ")).alias("text"),
                                 F.coalesce(F.col("raw").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    found = rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>, key long")
    return found.drop("key") if key_col is None else found


def keep_recognised(docs: DataFrame, held_out: Column, least: float = 0.4, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The documents, all columns, whose main language makes up a share of at least `least`; `und` goes."""
    keyed = docs.withColumn("__key", F.xxhash64(id_col, text_col))
    found = predictions(keyed, held_out, id_col, text_col, lang_col, "__key")
    bad = found.filter((F.col("lang_pred") == "und") | (F.col("score") < least)).select(F.col("key").alias("__bad")).distinct()
    return keyed.join(bad, F.col("__key") == F.col("__bad"), "left_anti").drop("__key")
