import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import FOLDER, no_documents, odd_documents
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.queries import REGISTRY, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(tokenizer_path())
    found.encode_special_tokens = True
    return found


def test_ids_of_any_white_space(tokenizer):
    rng = random.Random(3)
    alphabet = ["a", "B", "é", " ", "  ", "\n", ".", "'s", "7", "\t", "!!", "日", " ", "<|endoftext|>"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(25))) for _ in range(1500)] + ["", " ", "\n\n a", "a.\nB c.\n"]
    ids, at = packing.token_ids(pa.array(texts), packing.book(tokenizer_path()))
    for k, text in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check(rows, docs, tokenizer, capacity):
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[i] += [(s, min(capacity, len(ids) - s), zlib.crc32(ids[s:s + capacity].tobytes()), len(ids)) for s in range(0, len(ids), capacity)]
    assert {i: sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) for i, found in by_doc.items()} == {
        i: sorted(found) for i, found in want.items()}
    padding = used = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        used, padding = used + at, padding + (capacity - at if at & (at - 1) else 0)
    return padding / used


def test_round_trip_and_padding(spark, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert check(REGISTRY["op8_packing"](spark, FOLDER).collect(), docs, tokenizer, 1024) < 0.02


def test_odd_documents(spark, tokenizer):
    df = odd_documents(spark)
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    check(packing.pack(df, tokenizer_path(), 64).collect(), docs, tokenizer, 64)
    assert packing.pack(no_documents(spark), tokenizer_path()).collect() == []


def test_patterns_place_every_length():
    rng = random.Random(5)
    histogram = {length: rng.randrange(1, 10**9) for length in range(1, 1025)}
    patterns = packing.packing_patterns(histogram, 1024)
    assert len(patterns) < 4000  # bounded by the lengths, not by the documents
    placed = defaultdict(int)
    for pattern, n in patterns:
        assert sum(pattern) <= 1024
        for length in pattern:
            placed[length] += n
    assert placed == histogram
