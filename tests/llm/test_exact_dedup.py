import hashlib
import re
from collections import defaultdict

from llm_fixtures import no_documents, odd_documents, texts_of

from ledgerloom.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for body, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str), len(groups)


def check(df):
    got = exact_dedup.exact_groups(df).collect()
    want, groups = expected([(r["doc_id"], r["text"]) for r in df.collect()])
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == groups and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_odd_documents(spark):
    check(odd_documents(spark))
    assert exact_dedup.exact_groups(no_documents(spark)).collect() == []


def test_a_third_of_all_rows_is_one_text(spark):
    texts = [f"text {k}" if k % 3 else "hot\t text" for k in range(900)] + ["hot text"] * 50 + ["warm"] * 40
    check(texts_of(spark, texts).repartition(5))


def test_kept_documents_keep_their_columns(spark):
    df = texts_of(spark, ["a b", "a  b", "c"])
    assert sorted(map(tuple, exact_dedup.drop_copies(df).collect())) == sorted(map(tuple, df.filter("doc_id <> 1").collect()))
