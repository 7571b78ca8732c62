"""Vector codes against plain loops over all entries; the bitmasks against boxes."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import FOLDER

from ledgerloom.llm import queries, vector_codes
from ledgerloom.llm.common import table
from ledgerloom.llm.vector_codes import Slices

COLUMNS = "vec_id long, embedding array<float>, label int, n string, own string, part int, hot_error string"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(vec_id, code, error, label_error, digest) by full search; rows: vec_id, vector, label."""
    whole = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [[math.floor(scale * x) for x in r[1]] for r in whole]
    if not vectors:
        return []
    w = len(vectors[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for v in vectors] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for x in cut[p]:
                held[nearest(p, x)[1]].append(x)
            for k, xs in held.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(p, cut[p][i]) for p in range(parts)] for i in range(len(whole))]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for r, e in zip(whole, errors):
        by_label[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], digest) for r, f, e in zip(whole, found, errors)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 0, "x") for r in rows], COLUMNS)


def made(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    vectors = np.float32(rng.normal(0, spread, (n, width)))
    return [(int(i), v.tolist(), [None, 0, 1, 2][k % 4]) for k, (i, v) in enumerate(zip(rng.permutation(n), vectors))]


@pytest.mark.parametrize("n, width, entries, spread", [(300, 16, 32, 0.1), (90, 8, 256, 0.02), (200, 4, 70, 30.0), (40, 16, 1, 0.1)])
def test_equals_brute_force(spark, n, width, entries, spread):
    rows = made(n, width, n, spread)
    got = vector_codes.compressed(frame(spark, rows).repartition(5), entries=entries)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows, entries=entries))


def test_odd_rows(spark):
    rows = made(60, 8, 1)
    same = rows[0][1]
    rows += [(100 + k, list(same), 7) for k in range(50)] + [rows[0], rows[0], (5, [0.5] * 8, None), (None, [0.25] * 8, 3), (None, same, None)]
    rows += [(300, None, 1), (301, [None] + [0.0] * 7, 1), (302, [math.nan] * 8, 1), (303, [math.inf] + [0.0] * 7, 1),
             (304, [-math.inf] + [0.0] * 7, 1), (305, [], 1), (306, [0.0] * 8, 1), (307, [-0.0] * 8, 1), (308, [-1e-9] * 8, 1)]
    key = lambda r: tuple((x is None, x or 0) for x in r[:1]) + tuple(r[1:])
    got = [tuple(r) for r in vector_codes.compressed(frame(spark, rows).repartition(3), entries=16).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, entries=16), key=key)
    few = vector_codes.compressed(frame(spark, rows[:3]))
    assert sorted(tuple(r) for r in few.collect()) == sorted(plain(rows[:3]))


def test_empty_tables_and_bad_shapes(spark):
    assert vector_codes.compressed(frame(spark, [])).collect() == []
    assert vector_codes.compressed(frame(spark, [(1, None, 1), (2, [math.nan], 1)])).collect() == []
    with pytest.raises(ValueError, match="do not divide"):
        vector_codes.compressed(frame(spark, [(1, [0.0] * 6, 1)]))
    for other in ([0.0] * 4, [3e38] * 8):
        with pytest.raises(Exception, match="components of the first|do not fit a long"):
            vector_codes.compressed(frame(spark, [(1, [0.0] * 8, 1), (2, other, 1)])).collect()


def test_labels_beyond_the_broadcast_ones(spark):
    """A hot label, and many that hold a few rows each."""
    rows = [(i, v, 0 if i % 3 == 0 else 1 + i // 2) for i, v, _ in made(600, 8, 3)]
    got = vector_codes.compressed(frame(spark, rows).repartition(4), entries=8)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows, entries=8))


def test_candidates_are_the_boxes():
    rng = np.random.default_rng(4)
    for count, width in ((256, 16), (64, 3), (65, 2), (7, 1)):
        entries, queries_ = rng.integers(-300, 300, (count, width)), rng.integers(-400, 400, (500, width))
        slices, radius = Slices(entries), rng.integers(0, 500, 500)
        box = (np.abs(queries_[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
        assert (slices.candidates(queries_, radius) == box).all()
        full = ((queries_[:, None] - entries[None]) ** 2).sum(axis=2)
        index, distance = slices.nearest(queries_)
        assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_large_components_stay_exact():
    rng = np.random.default_rng(5)
    entries, queries_ = rng.integers(-(1 << 28), 1 << 28, (40, 4)), rng.integers(-(1 << 28), 1 << 28, (200, 4))
    full = ((queries_[:, None] - entries[None]) ** 2).sum(axis=2)
    index, distance = Slices(entries).nearest(queries_)
    assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_masks_leave_out_entries(spark):
    """The masks pass a few entries where vectors lie in clusters, and leave some out where they lie in all directions alike."""
    rows = table(spark, FOLDER, "embeddings").orderBy("vec_id").select("embedding").collect()
    alike = vector_codes.integers(pa.array([r[0] for r in rows], pa.list_(pa.float64())), 1024, 64)[:, :16]
    rng = np.random.default_rng(6)
    clusters = (rng.integers(0, 4, (40, 16)) * 500)[rng.integers(0, 40, 600)] + rng.integers(-40, 40, (600, 16))
    for vectors, most in ((alike, 0.9), (clusters, 0.1)):
        slices, queries_ = Slices(vectors[::2].copy()), vectors[1::2]
        for _ in range(5):  # the radius settles
            slices.passed, slices.asked = 0, 0
            slices.nearest(queries_)
        assert slices.passed < most * slices.asked


def test_whole_query(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = queries.op12_vector_codes(spark, FOLDER)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows))
