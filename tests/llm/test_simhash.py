import random
import re

import numpy as np
import xxhash
from llm_fixtures import no_documents, odd_documents, texts_of
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components


def plain_fingerprint(text, words=3):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(found[k:k + words]) for k in range(max(1, len(found) - words + 1))] if found else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_masks_miss_no_pair():
    rng = random.Random(0)
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(list(range(64)), radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(500):
            bits = sum(1 << p for p in rng.sample(range(64), radius))
            assert any(bits & m == 0 for m in masks)


def test_every_close_pair_is_found_in_crowded_buckets(spark):
    rng = random.Random(1)
    centre, values = rng.getrandbits(64), {rng.getrandbits(64) for _ in range(200)}
    for _ in range(600):  # a crowd that shares buckets, and chains of close ones
        values.add(centre ^ sum(1 << p for p in rng.sample(range(20), rng.randrange(5))))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {tuple(r) for r in simhash.close_pairs(df, 2).distinct().collect()}
    words = np.array(signed, dtype=np.int64)
    want = {(signed[k], signed[k + 1 + int(j)]) for k in range(len(signed))
            for j in np.flatnonzero(np.bitwise_count((words[k + 1:] ^ words[k]).view(np.uint64)) <= 2)}
    assert got == want and len(want) > 1000
    nodes = {n for p in want for n in p}
    assert {r["node"]: r["root"] for r in components(spark.createDataFrame(list(want), "a long, b long")).collect()} == {n: r for n, r in roots(nodes, want).items() if n != r}


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(k, k + 1) for k in range(300)]
    hub = [(1000, 1001 + k) for k in range(500)]
    pairs = chain + hub + [(7, 7), (2000, 2001), (2001, 2000)]
    df = spark.createDataFrame(pairs, "a long, b long").unionByName(spark.createDataFrame([(None, 3)], "a long, b long"))
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{k: 0 for k in range(1, 301)}, **{1000 + k: 1000 for k in range(1, 501)}, 2001: 2000}


def check(df, got):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in df.select("doc_id", "text").collect()]
    prints = sorted({f for _, f in rows})
    pairs = [(a, b) for k, a in enumerate(prints) for b in prints[k + 1:] if (a ^ b).bit_count() <= 2]
    root, least = roots(prints, pairs), {}
    for i, f in rows:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert sorted(map(str, got)) == sorted(str((i, f"{f:016x}", least.get(root[f]))) for i, f in rows)


def test_documents(spark):
    rng = random.Random(2)
    base = [rng.choice(["alpha", "Beta", "gamma", "delta", "eps"]) + str(rng.randrange(9)) for _ in range(400)]
    texts = []
    for _ in range(40):
        words = list(base)
        words[rng.randrange(400)] = "other"
        texts.append(" ".join(words))
    df = texts_of(spark, texts + [" ".join(rng.choices(base, k=50)) for _ in range(40)] + ["x"] * 30, 100).select("doc_id", "text")
    df = df.unionByName(odd_documents(spark).select("doc_id", "text"))
    check(df, [tuple(r) for r in simhash.linked(df, 3, 2).collect()])
    check(odd_documents(spark), [tuple(r) for r in simhash.linked(odd_documents(spark), 3, 2).collect()])
    assert simhash.linked(no_documents(spark), 3, 2).collect() == []


def test_one_document_of_each_component_stays(spark):
    df = odd_documents(spark)
    kept = simhash.drop_near_copies(df, 3, 2)
    assert kept.columns == df.columns
    names = {r["component_id"] for r in simhash.linked(df, 3, 2).collect()} - {None}
    ids = [r["doc_id"] for r in kept.filter(F.col("doc_id").isNotNull()).collect()]
    assert sorted(ids) == sorted(names) and kept.filter(F.col("doc_id").isNull()).count() == 3
