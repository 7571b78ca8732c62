"""The filter audit against plain loops that apply every order to every document."""

import re
from collections import Counter, defaultdict
from itertools import permutations

from llm_fixtures import FOLDER, no_documents, odd_documents, texts_of
from pyspark.sql import functions as F

from ledgerloom.llm import filter_audit, queries
from ledgerloom.llm.common import table

LABELS = "doc_id long, quality int, toxic int, n int, part string"


def plain(documents, labels):
    """documents: doc_id, text, source; labels: doc_id, quality, toxic."""
    good, toxic = ({r[0] for r in labels if r[0] is not None and r[k] == 1} for k in (1, 2))
    first = defaultdict(set)
    for doc, text, _ in documents:
        if doc is not None:
            first[text or ""].add(doc)
    facts = defaultdict(list)
    for doc, text, part in documents:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and doc > min(first[text]),
        }
        facts[part or ""].append(({k for k, v in fails.items() if v}, doc in good, doc in toxic))
    out = []
    for part, docs in facts.items():
        rows, total = [], Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                total[x] += len(gone)
                fail = [d for d in docs if x in d[0]]
                rows.append((x, (part, "".join(order), step + 1, len(left), len(gone), len(fail) - len(gone),
                                 sum(d[0] == {x} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone))))
        out += [(*r, total[x]) for x, r in rows]
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def check(spark, documents, labels):
    got = filter_audit.audit(documents, spark.createDataFrame(labels, LABELS))
    assert rows_of(got) == plain([tuple(r) for r in documents.select("doc_id", "text", "source").collect()], labels)


def test_equals_brute_force(spark):
    words = [" ".join(f"w{(k * 7 + j) % (40 + k % 300)}" for j in range(100 + k % 220)) for k in range(150)]
    texts = [w + [" END", " 5%", "", " CAPITALS EVERYWHERE " * 9, " a|b"][k % 5] for k, w in enumerate(words)] + words[:40] + [None, "", "", " \n"]
    df = texts_of(spark, texts).withColumn("source", F.expr("elt(1 + doc_id % 4, 'a', 'b', '', null)")).repartition(4)
    check(spark, df, [(i, i % 2, int(i % 3 == 0), 5, "x") for i in range(0, 190, 2)] + [(4, 1, 1, 5, "x"), (4, 0, None, 5, "x"), (None, 1, 1, 5, "x"), (7, None, 1, 5, "x")])


def test_odd_rows_and_empty_tables(spark):
    labels = [(9, 1, 0, 1, "x"), (10, 0, 1, 1, "x"), (None, 1, 1, 1, "x"), (77, 1, 1, 1, "x")]
    check(spark, odd_documents(spark).repartition(3), labels)
    check(spark, odd_documents(spark), [])
    same = texts_of(spark, ["one text of all rows"] * 300).withColumn("source", F.expr("concat('s', doc_id % 2)"))
    check(spark, same.unionByName(same.limit(5)).repartition(6), labels)
    assert filter_audit.audit(no_documents(spark), spark.createDataFrame(labels, LABELS)).collect() == []


def test_contraction_is_a_plain_sum():
    import numpy as np
    tensor = np.arange(32).reshape((2,) * 5)
    steps, chosen = filter_audit.selections()
    removed = filter_audit.contracted(tensor, chosen["removed"])
    assert len(steps) == 600 and removed[steps.index(("CABDE", 2))] == tensor[1, :, 0].sum()


def test_whole_query(spark):
    documents = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in table(spark, FOLDER, "labels").select("doc_id", "quality", "toxic").collect()]
    assert rows_of(queries.op13_filter_audit(spark, FOLDER)) == plain(documents, labels)
