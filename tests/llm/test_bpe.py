import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from headway.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DATA = bpe.read_ranks(PATH)
RANKS, TOKENS = bpe.parsed(DATA)
ENCODER = bpe.Encoder(DATA, public_tokenizers.PATTERN)
TRUE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}).encode_ordinary


def ids(*texts):
    return [np.frombuffer(x, np.int32).tolist() for x in ENCODER(list(texts))]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text_as_the_library_does(text):
    assert ids(text) == [TRUE(text)]


def test_spaces_signs_and_letters_in_all_orders():
    chance = random.Random(1)
    pool = [chr(c) for c in [*range(0x250), 0x1C, 0x85, 0xA0, 0x2028, 0x3000, 0x200B, 0x4E00, 0x1F600, 0x10400, 0x661, 0xB2, 0x301]]
    texts = ["".join(chance.choice(pool) for _ in range(chance.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(chance.choice("abthe  \n'sre1") for _ in range(chance.randint(0, 150))) for _ in range(1000)]
    assert ids(*texts) == [TRUE(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 20000, " " * 5000, "ab" * 5000, "é" * 3000, "xyzzy" * 13, "=" * 64, "=" * 65])
def test_long_matches(text):
    assert ids(text) == [TRUE(text)]
    piece = text.encode()[:60]
    assert bpe.packed(bpe.merge(piece, RANKS)) == bpe.merge_many([piece], bpe.pair_table(DATA))[0]


def test_forgetting_changes_nothing():
    small = bpe.Encoder(DATA, public_tokenizers.PATTERN, memory=3)
    texts = [f"some words number {i} and more" for i in range(50)]
    assert [small([t])[0] for t in texts] == ENCODER(texts)


def test_operator_on_edges(edges, empty):
    out = bpe.round_trip(edges, PATH, public_tokenizers.PATTERN)
    rows = sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in out.collect()), key=str)
    want = sorted(((r["doc_id"], TRUE(r["text"] or ""), (r["text"] or "").encode()) for r in edges.collect()), key=str)
    assert rows == want
    assert bpe.round_trip(empty, PATH, public_tokenizers.PATTERN).count() == 0
    apart = bpe.decode(bpe.encode(edges, PATH, public_tokenizers.PATTERN), PATH)
    assert sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in apart.collect()), key=str) == want


def test_query(spark, sf):
    rows = {r["doc_id"]: r for r in bpe.op4_byte_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        true, r = TRUE(d["text"]), rows[d["doc_id"]]
        assert r["n_tokens"] == len(true)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, true)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()
