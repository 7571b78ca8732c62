"""Language model, quality model, toxicity, language identification and decontamination against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import FOLDER, no_documents, odd_documents, texts_of
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, kneser_ney, language, ppm, toxicity
from ledgerloom.llm.common import remainder, table
from ledgerloom.llm.queries import REGISTRY

LARGER = "/root/testdata/sf0.01"


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def plain_ppm(rows, order):
    """(doc_id, held out, tokens, known, learnt, base, score) by a trie that learns one symbol after the other."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    texts = [tokens(t) for _, t in rows]
    counts = Counter(w for t, h in zip(texts, held) if not h for w in [*t, b"\n"])
    total, trie = sum(counts.values()), [defaultdict(Counter) for _ in range(order + 1)]
    bodies = [bytes(order) + b" ".join(t) + b"\n" for t in texts]
    for body, h in zip(bodies, held):
        for p in range(order, len(body) if not h else 0):
            for k in range(order, -1, -1):  # shorter contexts learn a symbol only where it was new
                seen = trie[k][body[p - k:p]]
                seen[body[p]] += 1
                if seen[body[p]] > 1:
                    break
    out = []
    for (i, _), text, body, h in zip(rows, texts, bodies, held):
        score = 0.0
        for p in range(order, len(body)):
            gone, found = set(), False
            for k in range(order, -1, -1):
                seen = trie[k].get(body[p - k:p])
                if seen is None:
                    continue
                t, d = sum(n for s, n in seen.items() if s not in gone), len(set(seen) - gone)
                if body[p] in seen:
                    score += math.log10((2 * seen[body[p]] - 1) / (2 * t))
                    found = True
                    break
                score += math.log10(d / (2 * t)) if d else 0.0
                gone = set(seen)
            if not found:
                score += math.log10(1 / (256 - len(gone)))
        own = [*text, b"\n"]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in own)
        out.append((i, h, len(own), sum(w in counts for w in own), total, base, score))
    return out


@pytest.mark.parametrize("order", [1, 3, 5])
def test_ppm_equals_a_trie(spark, order):
    small = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("length(text) < 1500").select("doc_id", "text").limit(60)
    df = small.unionByName(odd_documents(spark).filter("doc_id is null or doc_id not in (7, 8)").select("doc_id", "text"))
    key = lambda r: (str(r[0]), round(r[6], 3))
    rows = [tuple(r) for r in df.collect()]
    got = sorted((tuple(r) for r in ppm.scores(df, remainder("doc_id", 5) == 1, order, 20_000).collect()), key=key)
    want = sorted(plain_ppm(rows, order), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-6)


def test_ppm_of_odd_documents(spark):
    df = odd_documents(spark)
    got = ppm.scores(df, remainder("doc_id", 5) == 1).collect()
    assert len(got) == df.count() and all(r["score"] < 0 for r in got)
    assert ppm.scores(no_documents(spark), remainder("doc_id", 5) == 1).collect() == []
    nothing = ppm.scores(texts_of(spark, ["ab"]), F.lit(True)).first()
    assert nothing["score"] == pytest.approx(-3 * math.log10(256)) and nothing["base_score"] == 0.0


def test_ppm_beats_the_word_frequencies_on_held_out_texts(spark):
    held = REGISTRY["op4_lm_score"](spark, "/root/testdata/sf0.1").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 1.05 * held[1]  # logarithms: both are negative


def test_kneser_ney_probabilities_add_up(spark):
    symbol, logs = kneser_ney.train(texts_of(spark, ["the cat sat on the mat", "the dog sat", "abc abd", None, ""]))
    p = 10.0 ** logs.astype(float).reshape(-1, kneser_ney.SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4) and (p > 0).all()
    known = {b: s for b, s in enumerate(symbol) if s > 1}
    gram = lambda t: sum(int(symbol[b]) * kneser_ney.SYMBOLS**k for k, b in enumerate(reversed(t.encode())))
    assert len(known) == len(set("thecatsatonthematdogabcd ")) and logs[gram("the ")] > logs[gram("thea")]
    assert kneser_ney.train(texts_of(spark, [None, ""])) is None


def test_quality_tells_all_bytes_apart(spark):
    frequent = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"  # 52 bytes, more than the others below
    learnt = [frequent * 9, "call 5551 or 5552", "naïve café", "日本語の文"]
    odd = ["call 5551", "call 7397", "日本語", "語本日", "Ж", None, ""]
    df = texts_of(spark, learnt + odd).withColumn("lang", F.lit("x"))
    labels = spark.createDataFrame([(k, 1) for k in range(len(learnt))], "doc_id long, quality int")
    found = {r["doc_id"]: r["perplexity"] for r in kneser_ney.quality(df, labels).collect()}

    rows, base, model = [t.encode() for t in learnt], 257, []  # the same model, plainly
    grams = Counter(tuple([0] * 4 + [b + 1 for b in t])[p - 3:p + 1] for t in rows for p in range(4, len(t) + 4))
    for order in range(4, 0, -1):
        seen = Counter(grams.values())
        y = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] else 0.5
        raw = [k - (k + 1) * y * seen[k + 1] / seen[k] if seen[k] else 0.5 * k for k in (1, 2, 3)]
        d = [0.0, *(min(max(x, 0.1), 0.9 * k) for k, x in enumerate(raw, 1))]
        total, spare = Counter(), Counter()
        for g, n in grams.items():
            total[g[:-1]] += n
            spare[g[:-1]] += d[min(n, 3)]
        model.append((grams, d, total, spare))
        grams = Counter(g[1:] for g in grams)

    def p(gram):
        if not gram:
            return 1 / base
        n, d, total, spare = model[4 - len(gram)]
        below, t = p(gram[1:]), total[gram[:-1]]
        return below if not t else (n[gram] - d[min(n[gram], 3)]) / t + spare[gram[:-1]] / t * below

    for k, text in enumerate(learnt + odd):
        if not text:
            assert found[k] is None
            continue
        symbols = [0] * 3 + [b + 1 for b in text.encode()]
        logs = [math.log10(p(tuple(symbols[i - 3:i + 1]))) for i in range(3, len(symbols))]
        assert found[k] == pytest.approx(10 ** (-sum(logs) / len(logs)))
    assert found[len(learnt) + 1] > found[len(learnt)] and found[len(learnt) + 3] > found[len(learnt) + 2]


def test_quality_thresholds(spark):
    found = REGISTRY["op9_quality"](spark, LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    good = found.join(labels.filter("quality = 1"), "doc_id")
    bad = found.join(labels.filter("quality = 0"), "doc_id")
    share = F.avg(F.col("kept").cast("double"))
    assert found.count() == 1000 and good.agg(share).first()[0] > 0.95 and bad.agg(share).first()[0] < 0.6
    exact = {r["lang"]: r["ppl"] for r in good.groupBy("lang").agg(F.sort_array(F.collect_list("perplexity")).alias("ppl")).collect()}
    for r in found.select("lang", "threshold").distinct().collect():
        own = exact[r["lang"]]
        assert r["threshold"] == own[math.ceil(0.99 * len(own)) - 1]


def test_quality_thresholds_come_from_all_trusted_documents(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{name}.parquet") for name in ("documents", "labels"))
    found = kneser_ney.quality(docs, labels, trusted=5)  # the model learns from five of them
    good = found.join(labels.filter("quality = 1"), "doc_id")
    exact = {r["lang"]: r["ppl"] for r in good.groupBy("lang").agg(F.sort_array(F.collect_list("perplexity")).alias("ppl")).collect()}
    rows = found.select("lang", "threshold").distinct().collect()
    assert len(exact) > 1 and all(r["threshold"] == exact[r["lang"]][math.ceil(0.99 * len(exact[r["lang"]])) - 1] for r in rows)


def test_quality_learns_from_all_trusted_documents(spark, monkeypatch):
    """More trusted documents than the 50,000 that the model once learnt from, and the n-grams of each count."""
    learnt = []
    monkeypatch.setattr(kneser_ney, "tables", lambda counts, *rest: learnt.append(counts.agg(F.sum("n")).first()[0]))
    df = spark.range(0, 50_400, 1, 4).select(F.col("id").alias("doc_id"), F.lit("a bc").alias("text"), F.lit("x").alias("lang"))
    labels = df.select("doc_id", (F.col("doc_id") >= 100).cast("int").alias("quality"))
    kneser_ney.quality(df, labels)
    assert learnt == [4 * 50_300]


def test_quality_of_odd_documents(spark):
    df = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (10, 1, 0), (99, 1, 1), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    got = kneser_ney.quality(df, labels).collect()
    assert len(got) == df.count() and not any(r["kept"] for r in got if r["n_bytes"] == 0)
    none = kneser_ney.quality(df, labels.limit(0)).collect()
    assert all(r["perplexity"] is None and r["kept"] == (r["n_bytes"] > 0) for r in none)
    assert kneser_ney.quality(no_documents(spark), labels).collect() == []


def test_toxicity_on_held_out_labels(spark):
    found = REGISTRY["op1_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    rows = found.filter("held_out").select("score", "toxic").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    assert np.mean([[t > c for c in clean] for t in toxic]) > 0.85
    assert np.mean([c < 0.5 for c in clean]) > 0.98
    # In this table about half of the toxic labels stand for texts with words that no clean text has; those are found.
    assert np.mean([t >= 0.5 for t in toxic]) > 0.5


def test_toxicity_of_odd_documents(spark):
    df, held = odd_documents(spark), remainder("doc_id", 5) == 0
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 1, 0), (7, 1, 0), (9, 1, 1), (10, 1, 0), (None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.scores(df, labels, held).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["score"] == pytest.approx(1.0) for r in toxicity.scores(df, labels.filter("toxic = 1"), held).collect())
    assert all(r["score"] == pytest.approx(0.0) for r in toxicity.scores(df, labels.limit(0), held).collect())
    assert toxicity.scores(no_documents(spark), labels, held).collect() == []


def test_a_long_text_has_the_features_of_its_parts():
    rng = np.random.default_rng(1)
    text = rng.integers(32, 127, 1 << 17).astype(np.uint8)
    present = toxicity.Present()
    whole = set(present(text).tolist())
    assert whole == set(np.unique(toxicity._hashes(text)).tolist())


def test_steps_of_the_fit_leave_no_files(spark):
    """A step sends the weights as a file of 8 MB; it must be gone when the step is over. Few documents make one task."""
    from pathlib import Path

    features = spark.createDataFrame([(k % 2, [k % 7, 9 + k % 2]) for k in range(40)], "toxic int, buckets array<int>").coalesce(1)
    place = Path(spark.sparkContext._temp_dir)
    before = set(place.rglob("*"))
    toxicity.fit_weights(features, 40, 20, np.ones(toxicity.BUCKETS), rounds=3)
    assert not [f for f in set(place.rglob("*")) - before if f.is_file() and f.stat().st_size > 1 << 20]


def test_language_on_held_out_texts(spark):
    rows = REGISTRY["op6_language"](spark, LARGER).join(spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = rows.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_mixture_finds_both_languages():
    rng = np.random.default_rng(2)
    first, second = np.full((60, 4), -40.0), np.full((20, 4), -40.0)
    first[:, 1], second[:, 3] = -20.0, -20.0
    likes = np.concatenate([first, second, first[:5]]) + rng.normal(0, 0.1, (85, 4))
    share, _ = language.mixtures(likes, np.array([0, 80]))
    assert np.allclose(share[0], [0, 0.75, 0, 0.25], atol=1e-6) and share[1].tolist() == [0, 1, 0, 0]


def test_language_of_odd_documents(spark):
    df, held = odd_documents(spark), remainder("doc_id", 4) == 2
    got = {r["doc_id"]: r for r in language.predictions(df, held).collect() if r["doc_id"] is not None}
    assert [got[k]["lang_pred"] for k in (3, 4, 5, 6)] == ["und"] * 4 and got[3]["score"] == 0.0
    assert got[1]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in got.values())
    unlearnt = language.predictions(df.withColumn("lang", F.lit(None).cast("string")), held)
    assert {r["lang_pred"] for r in unlearnt.collect()} == {"und"}
    assert language.predictions(no_documents(spark), held).collect() == []
    kept = language.keep_recognised(df, held)
    assert kept.columns == df.columns and kept.filter("doc_id in (3, 4, 5, 6)").isEmpty() and kept.filter("doc_id = 10").count() == 2
    with pytest.raises(ValueError):
        language.learn(df.filter("lang is not null").select("text", "lang"), most=1)


def plain_matches(docs, items, similarity):
    out = {}
    for i, text in docs:
        words = decontaminate.plain_words(text)
        for item, passage in items:
            own = decontaminate.plain_words(passage)
            k = min(5, len(own))
            if not own:
                continue
            want = Counter(tuple(own[p:p + k]) for p in range(len(own) - k + 1))
            for start in range(len(words) - len(own) + 1):
                window = words[start:start + len(own)]
                have = Counter(tuple(window[p:p + k]) for p in range(len(own) - k + 1))
                value = (have & want).total() / (have | want).total()
                if value >= similarity and value > out.get((i, item), (0.0,))[0]:
                    out[i, item] = (value, start, len(own))
    return out


def test_decontamination_equals_all_windows(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 60)))) for k in range(30)] + [(30, ""), (31, None), (32, items_text := "one two three four five six")]
    docs = []
    for k in range(80):
        own = rng.choices(vocabulary, k=rng.randrange(200))
        words = (items[rng.randrange(30)][1] or "").split()
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = "changed"
        at = rng.randrange(len(own) + 1)
        docs.append((k, " ".join(own[:at] + [w.upper() + "," for w in words] + own[at:])))
    docs += [(100, items_text), (101, None), (102, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_matches(docs, items, 0.8)
    for size in (20_000, 7):  # one block of items, and several
        got = {(r["doc_id"], r["item_id"]): (pytest.approx(r["similarity"]), r["start"], r["n_words"]) for r in decontaminate.passages(df, bench, items=size).collect()}
        assert got == want and len(want) > 20  # enough of them, changed ones included


def test_decontamination_finds_documents_shorter_than_the_item(spark):
    rng = random.Random(7)
    items = [(k, " ".join(rng.sample([f"v{j}" for j in range(2_000)], n))) for k, n in enumerate((45, 45, 60, 30, 12, 9, 5, 3))]
    docs = []
    for k, text in items:
        words = text.split()
        for first, last in ((0, 1), (1, 0), (1, 1), (3, 0), (0, len(words) // 2), (0, len(words) - 1)):
            docs.append((len(docs), " ".join(words[first:len(words) - last])))
    docs += [(100 + k, " ".join(text.split()[:-1] + ["other"])) for k, text in items]
    shingles = lambda words, k: Counter(tuple(words[p:p + k]) for p in range(len(words) - k + 1))
    want = {}
    for i, text in docs:
        words = decontaminate.plain_words(text)
        for item, passage in items:
            own = decontaminate.plain_words(passage)
            k, best = min(5, len(own)), 0.0
            target = shingles(own, k)
            for start in range(max(1, len(words) - len(own) + 1)):
                have = shingles(words[start:start + len(own)], k)
                value = (have & target).total() / (have | target).total()
                if value >= 0.8 and value > best:
                    best = value
                    want[i, item] = (pytest.approx(value), start, min(len(words), len(own)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"], r["n_words"]) for r in decontaminate.passages(df, bench).collect()}
    assert got == want and (0, 0) in got and len(want) > 15
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(df, bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_decontamination_of_odd_documents(spark):
    df = odd_documents(spark)
    bench = spark.createDataFrame([(5, "same words again and again second line"), (6, "no id"), (7, None)], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.passages(df, bench).collect()), key=str)
    assert got == [(1, 5), (2, 5), (None, 6), (None, 6)]
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and kept.count() == df.count() - 4
    assert decontaminate.passages(no_documents(spark), bench).collect() == []
    assert decontaminate.passages(df, bench.limit(0)).collect() == []


def test_decontamination_steps_select(spark):
    """Each step passes a part of what it gets, and none passes over a match."""
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    docs = [r[0] for r in table(spark, FOLDER, "documents").select("text").collect()]
    radius = 23
    block = decontaminate.Items(items, radius, 0.8)
    hashes, roll = decontaminate.WordHashes(), decontaminate.Rolling(decontaminate._BASE)
    matches = 0
    for text in docs:
        plain = decontaminate.plain_words(text)
        matches += len(list(block.matches(np.fromiter(map(hashes.__getitem__, plain), dtype=np.uint64, count=len(plain)), roll)))
    assert 0 < matches <= block.verified <= block.indexed and block.hashed < 0.1 * block.windows
    rng = np.random.default_rng(3)  # among unlike fingerprints the blocks pass under half, and all within the radius
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64) for n in (300, 400))
    b[:100] = a[:100] ^ np.array([sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 24), replace=False)) for _ in range(100)], np.uint64)
    found = set(block.indexed_pairs(a, b))
    close = set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(a[:, None] ^ b) <= radius))))
    assert close <= found and len(found) < 0.5 * len(a) * len(b)


def test_toxicity_equals_a_plain_regression(spark):
    """Ratios, weights and scores against sets of buckets and plain gradient descent over a dense matrix."""
    rng = random.Random(9)
    mild, bad = ["sun", "tree", "river", "stone", "cloud", "bread"], ["grumf", "zlorb", "krasch"]
    rows = [(k, " ".join(rng.choices(mild, k=6) + (rng.choices(bad, k=rng.randrange(1, 3)) if k % 3 == 0 else [])), int(k % 3 == 0)) for k in range(90)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(500, None), (501, "zlorb river"), (502, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    held = remainder("doc_id", 5) == 0
    kept = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    sets = lambda t: set(toxicity._hashes(np.frombuffer((t or "").encode(), np.uint8)).tolist())
    found = [(sets(t), y) for _, t, y in kept]
    holders = Counter((b, y) for s, y in found for b in s)
    used = sorted({b for b, _ in holders if holders[b, 0] + holders[b, 1] >= toxicity.SEEN})
    n = [sum(y == k for _, y in found) for k in (0, 1)]
    ratio = np.array([math.log((holders[b, 1] + 1) / (n[1] + 2)) - math.log((holders[b, 0] + 1) / (n[0] + 2)) for b in used])
    dense = np.array([[b in s for b in used] for s, _ in found]) * ratio
    dense, y = dense / math.sqrt((dense**2).sum() / len(found)), np.array([y for _, y in found])
    spread = math.sqrt((np.array([[b in s for b in used] for s, _ in found]) * ratio**2).sum() / len(found))
    w, bias = np.zeros(len(used)), math.log(n[1] / n[0])
    for _ in range(20_000):
        error = 1 / (1 + np.exp(-(dense @ w + bias))) - y
        w -= 0.5 * (dense.T @ error + 0.01 * w) / len(y)
        bias -= 0.5 * error.mean()
    want = {i: 1 / (1 + math.exp(-(sum(w[k] * ratio[k] / spread for k, b in enumerate(used) if b in sets(t)) + bias)))
            for i, t in [tuple(r) for r in df.collect()]}
    got = {r["doc_id"]: r["score"] for r in toxicity.scores(df, labels, held).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 0.05
    assert got[501] > 0.5 > max(got[i] for i, _, y in rows if not y)


def test_a_freed_table_leaves_no_shuffle(spark):
    """The shuffle of a freed frame goes when it is written; the session's setting is as before and its rows are whole."""
    from ledgerloom.llm import common

    df = spark.range(5_000).repartition(3, "id").groupBy("id").count()
    before = spark.conf.get(common._CLEANUP, "false")
    assert common.written(df, freed=True).count() == 5_000 and spark.conf.get(common._CLEANUP, "false") == before


def test_the_fit_holds_a_number_for_each_feature(spark, monkeypatch):
    """The driver's vectors are as long as there are features, not as there are buckets."""
    seen, plain = [], toxicity._evaluated
    monkeypatch.setattr(toxicity, "_evaluated", lambda f, weights, *a, **k: seen.append(len(weights)) or plain(f, weights, *a, **k))
    docs = spark.createDataFrame([(i, "good sun" if i % 2 else "grumf bad") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.scores(docs, labels, remainder("doc_id", 5) == 0).collect()}
    assert got == {i: 1 - i % 2 for i in range(40)} and seen and max(seen) < 100
