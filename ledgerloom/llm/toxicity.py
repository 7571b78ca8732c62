"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

Features are the n-grams of 3, 4 and 5 bytes of the lower-cased text, present or not, hashed into 2^20 buckets. The
log-count ratio of a bucket compares the shares of toxic and other labelled documents that hold it; a logistic regression
on the features scaled by these ratios gives the weights. Scoring reads each whole text once; the model is 2^20 floats.

The regression is fitted by L-BFGS. The features of the documents it learns from are written once to the shared folder; each
step sends the weights to the tasks, which sum the slopes of their documents, and Spark adds up those sums by ranges of
features. The buckets that are features are numbered, so the driver holds weights, slopes and a short history with a number
for each feature, 2^20 at most, however long the texts are.

Bounds, as parameters: the ratios are learnt from at most `labelled` labelled documents (in order of a hash of their id),
the weights from at most `fitted` of those, up to a third of them toxic, so that the few toxic ones weigh enough. Buckets that
fewer than `SEEN` labelled documents hold have no weight. The list of labelled ids is thus at most `labelled` rows, which is
what is broadcast; texts never move.

Cases: a null text is an empty one and gets the score of no features; conflicting labels of an id count as toxic; null
labels and ids without text are ignored; without labels of both kinds every score is the share of toxic labels (0 without
any label); a repeated id is scored and learnt once for each row; an empty table gives no rows; other columns are ignored.
A text of over a megabyte is read in overlapping parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batch_of, cut, text_slices

BITS = 20
BUCKETS = 1 << BITS
#: Labelled documents that must hold a bucket for it to be a feature.
SEEN = 3
#: Features whose slopes are added up together; tasks that hold the documents of the fit, at most, and documents of a task.
_RANGE, _TASKS, _TASK_DOCS = 1 << 14, 12, 500
_PART = 1 << 20
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_COUNTS = pa.schema([("bucket", pa.int32()), ("clean", pa.int64()), ("toxic", pa.int64())])
_FEATURES = pa.schema([("toxic", pa.int32()), ("buckets", pa.list_(pa.int32()))])
_SLOPES = pa.schema([("range", pa.int32()), ("slopes", pa.binary())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])


def _hashes(text: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of a text of bytes, a space before and after it."""
    b = np.full(len(text) + 2, 32, dtype=np.uint32)
    b[1:-1] = _LOWER[text]
    found, gram, shift = [], b, np.uint32(32 - BITS)
    for n, odd in ((2, 0), (3, 2654435761), (4, 2246822519), (5, 3266489917)):
        if len(b) < n:
            break
        gram = gram[:-1] * np.uint32(16777619) ^ b[n - 1:] * np.uint32(374761393)
        if odd:
            mixed = (gram ^ gram >> np.uint32(15)) * np.uint32(odd)
            found.append((mixed ^ mixed >> np.uint32(13)) * np.uint32(668265263) >> shift)
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


class Present:
    """Distinct buckets of a text, by a scratch array that is reused from text to text."""

    def __init__(self):
        self.stamp = np.zeros(BUCKETS, dtype=np.int32)

    def __call__(self, text: np.ndarray) -> np.ndarray:
        if len(text) <= _PART:
            found = _hashes(text)
            order = np.arange(len(found), dtype=np.int32)
            self.stamp[found] = order
            return found[self.stamp[found] == order]  # of equal buckets the last
        marked = np.zeros(BUCKETS, dtype=bool)
        for at in range(0, len(text), _PART):
            marked[_hashes(text[max(0, at - 4):at + _PART])] = True
        return np.flatnonzero(marked)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for first, data, at in text_slices(batch, "text"):
        for row in range(len(at) - 1):
            yield first + row, data[at[row]:at[row + 1]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, present = np.zeros((2, BUCKETS), dtype=np.int64), Present()
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        for row, text in _texts(batch):
            held[toxic[row], present(text)] += 1
    seen = np.flatnonzero(held.any(axis=0))
    yield batch_of(_COUNTS, seen.astype(np.int32), held[0, seen], held[1, seen])


def _features(telling: np.ndarray):
    """The features of each text: the places in `telling`, a sorted list of buckets, of those that it holds."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, place = Present(), np.full(BUCKETS, -1, dtype=np.int32)
        place[telling] = np.arange(len(telling), dtype=np.int32)
        for batch in batches:
            found = [place[present(text)] for _, text in _texts(batch)]
            yield batch_of(_FEATURES, batch.column("toxic"), pa.array([f[f >= 0] for f in found], type=pa.list_(pa.int32())))

    return of


def _slopes(model, whole: bool):
    """Partial sums of a task: the slope of each feature and, as range -1, those of bias and loss. With `whole` each document
    counts once instead of by its error, which gives the number of documents by feature."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        size = len(weights)
        slopes, ends = np.zeros(size), np.zeros(2)
        for batch in batches:
            lists, toxic = batch.column("buckets"), batch.column("toxic").to_numpy()
            flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            doc = np.repeat(np.arange(len(sizes)), sizes)
            logit = np.clip(np.bincount(doc, weights=weights[flat], minlength=len(sizes)) + bias, -30, 30)
            error = np.ones(len(sizes)) if whole else 1 / (1 + np.exp(-logit)) - toxic
            slopes += np.bincount(flat, weights=error[doc], minlength=size)
            ends += error.sum(), (np.log1p(np.exp(logit)) - toxic * logit).sum()
        some = [k for k in range(-(-size // _RANGE)) if slopes[k * _RANGE:(k + 1) * _RANGE].any()]
        yield batch_of(_SLOPES, [-1, *some], [ends.tobytes(), *[slopes[k * _RANGE:(k + 1) * _RANGE].tobytes() for k in some]])

    return of


def _added(parts: pa.Table) -> pa.Table:
    """The sums of one range of features over all tasks."""
    total = sum(np.frombuffer(x.as_py()) for x in parts.column("slopes"))
    return pa.table([parts.column("range").slice(0, 1), pa.array([total.tobytes()], type=pa.binary())], schema=_SLOPES)


def _evaluated(features: DataFrame, weights: np.ndarray, bias: float, whole: bool = False) -> tuple[np.ndarray, float, float]:
    """Slopes by feature, slope of the bias and loss, each summed over all documents of the fit."""
    model = features.sparkSession.sparkContext.broadcast((weights, bias))  # 8 MB at most
    parts = features.mapInArrow(_slopes(model, whole), "range int, slopes binary")
    slopes, ends = np.zeros(len(weights)), np.zeros(2)
    for row in parts.groupBy("range").applyInArrow(_added, "range int, slopes binary").collect():  # 65 rows at most
        found = np.frombuffer(bytes(row["slopes"]))
        if row["range"] < 0:
            ends = found
        else:
            slopes[row["range"] * _RANGE:(row["range"] + 1) * _RANGE] = found
    model.destroy()  # its files go too, on the driver and where the tasks ran: a step leaves nothing on disk
    return slopes, float(ends[0]), float(ends[1])


def fit_weights(features: DataFrame, documents: int, toxic: int, ratios: np.ndarray, rounds: int = 30, ridge: float = 0.01,
                history: int = 6) -> tuple[np.ndarray, float]:
    """Weights by feature (ratios included) and intercept of a ridge logistic regression, by L-BFGS."""
    bias = float(np.log(toxic / (documents - toxic)))
    held = _evaluated(features, np.zeros(len(ratios)), bias, whole=True)[0]
    scale = ratios / (float(np.sqrt((held * ratios**2).sum() / documents)) or 1.0)

    def at(point: np.ndarray) -> tuple[float, np.ndarray]:
        slopes, bias_slope, loss = _evaluated(features, point[:-1] * scale, float(point[-1]))
        whole = np.append(slopes * scale + ridge * point[:-1], bias_slope) / documents
        return (loss + ridge / 2 * float((point[:-1] ** 2).sum())) / documents, whole

    point = np.append(np.zeros(len(ratios)), bias)
    value, slope = at(point)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        way, kept = slope.copy(), []
        for move, change, inner in reversed(steps):
            kept.append(float(move @ way) / inner)
            way -= kept[-1] * change
        if steps:
            way *= steps[-1][2] / float(steps[-1][1] @ steps[-1][1])
        else:
            way /= max(1e-12, float(np.linalg.norm(way)))
        for (move, change, inner), part in zip(steps, reversed(kept)):
            way += move * (part - float(change @ way) / inner)
        rate, down = 1.0, float(way @ slope)
        while True:
            there = point - rate * way
            new_value, new_slope = at(there)
            if new_value <= value - 1e-4 * rate * down or rate < 1e-3:
                break
            rate /= 4
        move, change = there - point, new_slope - slope
        if new_value >= value or value - new_value < 1e-7 * value:
            break
        if float(move @ change) > 1e-12:
            steps = [*steps[-history + 1:], (move, change, float(move @ change))]
        point, value, slope = there, new_value, new_slope
    return point[:-1] * scale, float(point[-1])


def scores(docs: DataFrame, labels: DataFrame, held_out: Column, labelled: int = 20_000, fitted: int = 6_000,
           id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Labels of documents with `held_out` (over doc_id) are not read."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    )
    known = cut(known)  # at most `labelled` rows
    learnt = texts.join(F.broadcast(known), "doc_id")
    rows = learnt.select("toxic", "text").mapInArrow(_count, "bucket int, clean long, toxic long")
    counts = rows.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = counts.filter(F.col("clean") + F.col("toxic") >= SEEN).toPandas()  # <= 2^20 rows
    sizes = {r["toxic"]: r["count"] for r in learnt.groupBy("toxic").count().collect()}
    weights, bias = np.zeros(BUCKETS), None
    if len(sizes) == 2:
        counts = counts.sort_values("bucket")
        telling = counts["bucket"].to_numpy()
        shares = [(counts[name].to_numpy() + 1) / (sizes[k] + 2) for k, name in enumerate(("clean", "toxic"))]
        ratios = np.log(shares[1] / shares[0])
        del counts, shares
        few = cut(known.filter("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fitted // 3).unionByName(
            known.filter("toxic = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fitted - fitted // 3)))
        sample = texts.join(F.broadcast(few), "doc_id").select("toxic", "text")
        # About `fitted` rows, written once for all steps. Each task adds up to 8 MB of slopes to a step, so few rows go to few.
        tasks = min(_TASKS, 1 + few.count() // _TASK_DOCS)
        features = cut(sample.repartition(tasks).mapInArrow(_features(telling), "toxic int, buckets array<int>"))
        taken = {r["toxic"]: r["count"] for r in features.groupBy("toxic").count().collect()}
        if len(taken) == 2:
            weights[telling], bias = fit_weights(features, sum(taken.values()), taken[1], ratios)
    if bias is None:
        share = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.0
        bias = 30.0 if share == 1 else float(np.log(share / (1 - share))) if share else None
    model = spark.sparkContext.broadcast(weights.astype(np.float32))  # 4 MB

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, by_bucket = Present(), model.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for row, text in _texts(batch):
                out[row] = by_bucket[present(text)].sum(dtype=np.float64)
            logit = np.clip(out + bias, -700, 700) if bias is not None else np.full(len(out), -700.0)
            yield batch_of(_SCORES, batch.column("doc_id"), batch.column("held_out"), 1 / (1 + np.exp(-logit)))

    scored = texts.withColumn("held_out", held_out).mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
