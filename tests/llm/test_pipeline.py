import random

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from headway.llm import bpe, personal
from headway.llm.registry import QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with planted cases: toxic documents, copies, benchmark passages, personal data, clean ones."""
    chance = random.Random(1)
    words = [f"w{i}" for i in range(4000)]
    text = lambda n: " ".join(chance.choices(words, k=n))
    slurs = ["vilex", "hatew", "scorny", "bilgey"]
    docs, labels, planted = [], [], {}

    def add(kind, t):
        docs.append((len(docs), t, "en", "src", len(t)))
        planted.setdefault(kind, []).append(len(docs) - 1)
        return len(docs) - 1

    def toxic():
        t = text(80).split()
        for _ in range(6):
            t[chance.randrange(80)] = chance.choice(slurs)
        return " ".join(t)

    for _ in range(150):
        labels.append((add("toxic", toxic()), 0, 1))
    for _ in range(150):
        labels.append((add("clean", text(90)), 1, 0))
    item = text(40)
    original = text(200)
    add("first", original)
    for i in range(20):
        t = original.split()
        t[i * 9] = "changed"
        add("copy", " ".join(t))
    for _ in range(5):
        add("copy", original)
        add("leak", f"{text(50)} {item} {text(50)}")
    add("personal", f"{text(30)} ann@mail.org {text(10)} 10.1.2.3 {text(10)}")
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, planted


def test_stages_catch_what_is_planted(spark, folder, monkeypatch):
    path, rows, planted = folder
    monkeypatch.setattr(personal, "learn", lambda docs, _learn=personal.learn: _learn(docs, steps=60))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_copies", "decontamination", "personal_data", "tokens"]
    kept = stages["toxicity"](spark, docs, path)
    assert kept.columns == docs.columns
    gone = set(range(len(rows))) - ids(kept)
    assert len(gone & set(planted["toxic"])) >= 0.95 * len(planted["toxic"]) and len(gone - set(planted["toxic"])) <= 2
    before = ids(docs)
    kept = stages["near_copies"](spark, docs, path)
    assert kept.columns == docs.columns and before - ids(kept) == set(planted["copy"])
    kept = stages["decontamination"](spark, docs, path)
    assert kept.columns == docs.columns and before - ids(kept) == set(planted["leak"])
    masked = stages["personal_data"](spark, docs, path)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    text = {r["doc_id"]: r for r in masked.collect()}
    hit = planted["personal"][0]
    assert "<EMAIL>" in text[hit]["text"] and "<IP>" in text[hit]["text"] and text[hit]["n_chars"] == len(text[hit]["text"])
    assert all(text[i]["text"] == rows[i][1] for i in planted["clean"])
    done = stages["tokens"](spark, docs, path)
    ranks, _ = bpe.parsed(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    true = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r["doc_id"]: list(r["ids"]) for r in done.collect()} == {i: true.encode_ordinary(t) for i, t, *_ in rows}


def test_run(spark, folder, monkeypatch):
    path, rows, planted = folder
    monkeypatch.setattr(personal, "learn", lambda docs, _learn=personal.learn: _learn(docs, steps=30))
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, path).collect()}
    assert not got & set(planted["copy"]) and not got & set(planted["leak"])
    assert len(got & set(planted["toxic"])) <= 8
    assert len(got & set(planted["clean"])) >= 148 and set(planted["first"] + planted["personal"]) <= got


def test_stages_on_edges(spark, edges, empty, folder, monkeypatch):
    path, _, _ = folder
    monkeypatch.setattr(personal, "learn", lambda docs, _learn=personal.learn: _learn(docs, steps=5))
    for docs in (edges, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, path)
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= docs.count()


def test_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) < set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
