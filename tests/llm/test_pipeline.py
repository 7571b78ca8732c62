from collections import Counter, defaultdict

import corpus_pipeline
from llm_fixtures import FOLDER, no_documents, odd_documents

from ledgerloom.llm import decontaminate, language, line_dedup, simhash
from ledgerloom.llm.common import remainder, table


def test_stages_work_on_what_the_one_before_kept(spark):
    docs = table(spark, FOLDER, "documents")
    recognised = {r["doc_id"] for r in language.predictions(docs, remainder("doc_id", 4) == 2).filter("lang_pred <> 'und' and score >= 0.4").collect()}
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language"](spark, docs, FOLDER).checkpoint()
    assert {r["doc_id"] for r in first.collect()} == recognised and first.columns == docs.columns
    second = stages["line_dedup"](spark, first, FOLDER).checkpoint()
    texts = {r["doc_id"]: r["__kept"] for r in line_dedup.without_repeats(first).collect()}
    assert {r["doc_id"]: r["text"] for r in second.collect()} == {i: t for i, t in texts.items() if t.strip(" ") or i in {r["doc_id"] for r in second.collect()}}
    assert all(r["n_chars"] == len(r["text"]) for r in second.collect() if r["text"] != "")
    third = stages["near_duplicates"](spark, second, FOLDER).checkpoint()
    assert Counter(r["doc_id"] for r in third.collect()) == Counter({r["component_id"] for r in simhash.linked(second, 3, 2).collect()})
    fourth = stages["decontamination"](spark, third, FOLDER).checkpoint()
    bad = {r["doc_id"] for r in decontaminate.passages(third, table(spark, FOLDER, "benchmark")).collect()}
    assert {r["doc_id"] for r in fourth.collect()} == {r["doc_id"] for r in third.collect()} - bad
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in fourth.collect()}
    lengths = defaultdict(int)
    for r in packed:
        lengths[r["doc_id"]] += r["length"]
    assert all(lengths[r["doc_id"]] == r["doc_tokens"] for r in packed)


def test_odd_documents_pass_every_stage(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, FOLDER).checkpoint()
            assert name == "packing" or found.columns == docs.columns
            docs = found
        assert name == "packing" and found.columns[:2] == ["doc_id", "start"]
