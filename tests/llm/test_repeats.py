"""Substring and line dedup against plain loops and SQL."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from llm_fixtures import FOLDER, no_documents, odd_documents, texts_of
from pyspark.sql import functions as F

from ledgerloom.llm import line_dedup, queries, substring


def by_sql(name):
    con = duckdb.connect()
    for name_ in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{FOLDER}/{name_}.parquet'")
    found = con.sql(queries.SQL[name])
    return Counter(map(str, found.project(", ".join(sorted(found.columns))).fetchall()))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    df = queries.REGISTRY[name](spark, FOLDER)
    assert Counter(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect()) == by_sql(name)


def plain_windows(rows, size):
    starts = defaultdict(list)
    words = [(t or "").encode().split() for _, t in rows]
    for k, w in enumerate(words):
        for i in range(len(w) - size + 1):
            starts[tuple(w[i:i + size])].append((k, i))
    gone = [set() for _ in rows]
    for places in starts.values():
        if len(places) > 1:
            for k, i in places:
                gone[k].update(range(i, i + size))
    out = []
    for (i, _), w, g in zip(rows, words, gone):
        body = b" ".join(x for p, x in enumerate(w) if p not in g)
        out.append((i, len(w), len(g), hashlib.sha256(body).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("size, period, cover", [(35, 21, (0, 1, 4, 14, 16)), (8, 7, (0, 1, 3)), (5, 3, (0, 1))])
def test_windows(spark, size, period, cover):
    rng = random.Random(size)
    passage = [rng.choice("abcdefgh") for _ in range(3 * size)]
    texts = []
    for k in range(60):
        own = [f"{rng.choice('xyz')}{rng.randrange(50)}" for _ in range(rng.randrange(4 * size))]
        at = rng.randrange(len(own) + 1)
        part = passage[rng.randrange(size):][:rng.randrange(3 * size)] if k % 2 else []
        texts.append(" \n".join(own[:at] + part + own[at:]))
    texts += ["z z " * 2 * size, texts[0], texts[1] + " "]
    df = texts_of(spark, texts).select("doc_id", "text").unionByName(odd_documents(spark).select("doc_id", "text")).repartition(3)
    rows = [tuple(r) for r in df.collect()]
    got = substring.without_repeats(df, size, period, cover).drop("kept")
    assert Counter(tuple(r) for r in got.collect()) == plain_windows(rows, size)


def test_windows_of_odd_documents(spark):
    df = odd_documents(spark)
    got = substring.without_repeats(df).drop("kept").collect()
    assert Counter(tuple(r) for r in got) == plain_windows([(r["doc_id"], r["text"]) for r in df.collect()], 35)
    assert substring.without_repeats(no_documents(spark)).collect() == []
    with pytest.raises(ValueError):
        substring.without_repeats(df, 35, 21, (0, 1, 4))


def test_anchors_are_hashed_once(spark, tmp_path, monkeypatch):
    """Dealing the anchors must not hash all texts a second time; busy anchors are found and nothing is lost."""
    calls, plain = str(tmp_path / "calls"), substring.anchors

    def noted(*args):
        of = plain(*args)

        def run(batches):
            for batch in batches:
                with open(calls, "a") as file:
                    file.write(f"{batch.num_rows}\n")
                yield from of(iter([batch]))

        return run

    monkeypatch.setattr(substring, "anchors", noted)
    monkeypatch.setattr(substring, "SAMPLED", 4)
    rows = [(k, " ".join(["own" + str(k), *(f"w{j}" for j in range(60)), str(k)])) for k in range(200)]
    got = substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).drop("kept")
    assert Counter(tuple(r) for r in got.collect()) == plain_windows(rows, 35)
    assert sum(map(int, open(calls).read().split())) < 300


def plain_runs(rows):
    """For each line, the most lines from it on that also begin earlier, by full comparison; only maximal ones."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    lines = {k: (rows[k][1] or "").split("\n") for k in order}
    places = [(k, p) for k in order for p in range(len(lines[k]))]
    starts, found = defaultdict(list), {}
    for k, p in places:
        best = 0
        for j, q in starts[lines[k][p]]:
            n = 0
            while p + n < len(lines[k]) and q + n < len(lines[j]) and lines[k][p + n] == lines[j][q + n]:
                n += 1
            best = max(best, n)
        starts[lines[k][p]].append((k, p))
        found[k, p] = best
    return {(k, p): n for (k, p), n in found.items() if n and found.get((k, p - 1), 0) <= n}, lines


def plain_lines(rows, min_words):
    runs, lines = plain_runs(rows)
    gone = [set() for _ in rows]
    for (k, p), n in runs.items():
        if sum(len(x.encode().split()) for x in lines[k][p:p + n]) >= min_words:
            gone[k].update(range(p, p + n))
    return [(rows[k][0], len(lines[k]), len(gone[k]), "\n".join(x for p, x in enumerate(lines[k]) if p not in gone[k])) for k in range(len(rows))]


def made_lines(seed):
    rng = random.Random(seed)
    words = lambda: " ".join(rng.choice(["la", "le", "un", "deux", "trois"]) for _ in range(rng.choice([0, 1, 1, 2, 7])))
    pool = [words() for _ in range(12)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    whole = [rng.choice(pool) + str(k) for k in range(37)]
    for k in range(12):  # copies and parts of a longer text, so that all depths up to its length come in
        a, b = sorted((rng.randrange(38), rng.randrange(38)))
        texts.append("\n".join([f"own {k}", *whole[a:b], rng.choice(pool)]))
    return texts + ["\n".join(whole)] * 3 + ["a\n" * 70, "", None, "Les.", "Les.", "one long line that is repeated", "one long line that is repeated"]


@pytest.mark.parametrize("min_words", [1, 5, 12])
def test_lines(spark, min_words):
    df = texts_of(spark, made_lines(min_words)).repartition(4)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = line_dedup.report(df, min_words).collect()
    want = [(i, a, b, hashlib.sha256(t.encode()).hexdigest()) for i, a, b, t in plain_lines(rows, min_words)]
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_runs_are_all_maximal_ones(spark):
    df = texts_of(spark, made_lines(3)).repartition(3)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    runs, lines = plain_runs(rows)
    got = line_dedup.repeated_runs(df).collect()
    assert Counter((r["doc_id"], r["start"], r["n_lines"]) for r in got) == Counter((rows[k][0], p, n) for (k, p), n in runs.items())
    text = {rows[k][0]: x for k, x in lines.items()}
    for r in got:
        assert (r["first_id"], r["first_start"]) < (r["doc_id"], r["start"])
        assert text[r["first_id"]][r["first_start"]:][:r["n_lines"]] == text[r["doc_id"]][r["start"]:][:r["n_lines"]]


def test_long_lines_go_and_short_ones_stay(spark):
    long = " ".join(f"w{k}" for k in range(60))
    df = texts_of(spark, [f"a\n{long}\nLes.", f"Les.\n{long}\nb", f"{long}", "Les."])
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeats(df).collect()}
    assert got == {0: f"a\n{long}\nLes.", 1: "Les.\nb", 3: "Les."}


def test_lines_of_odd_documents(spark):
    df = odd_documents(spark)
    got = line_dedup.without_repeats(df)
    assert got.columns == [*df.columns, "__n_lines", "__n_removed", "__kept"] and got.count() == df.count()
    rows = {r["doc_id"]: r["__n_removed"] for r in got.filter(F.col("doc_id") < 9).collect()}
    assert rows == {1: 0, 2: 3, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 1}  # 8 is the single long line of 7 again
    kept = line_dedup.drop_repeats(df)
    assert kept.columns == df.columns and kept.filter("doc_id = 2").isEmpty() and kept.filter("doc_id = 4").count() == 1
    clashing = df.withColumns({c: F.lit("y") for c in ("__doc", "__copy", "___runs", "first", "rank", "level", "__kept")})
    again = line_dedup.drop_repeats(clashing)
    assert again.columns == clashing.columns and again.count() == kept.count() and again.filter("__kept = 'y' and __doc = 'y'").count() == kept.count()
    assert line_dedup.drop_repeats(no_documents(spark)).collect() == []
    assert line_dedup.repeated_runs(no_documents(spark)).collect() == []
