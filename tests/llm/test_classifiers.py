"""Language, quality and toxicity: held-out accuracy, edges, and the folds."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import languages, quality, toxicity
from headway.llm.common import fold

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def truth(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return docs, labels


def checked(rows, docs, parts, remainder):
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == remainder)
        assert 0 <= r["score"] <= 1


def test_languages(spark, truth):
    docs, _ = truth
    rows = languages.op6_language_mixture(spark, SF).collect()
    checked(rows, docs, 3, 1)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97


def test_quality(spark, truth):
    docs, labels = truth
    rows = quality.op10_nbsvm_quality(spark, SF).collect()
    checked(rows, docs, 5, 0)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]]["quality"] for r in held]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_toxicity(spark, truth):
    docs, labels = truth
    rows = toxicity.op9_zstd_toxicity(spark, SF).collect()
    checked(rows, docs, 5, 0)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]]["toxic"] for r in held]) > 0.93


def test_fold_of_ids(spark):
    df = spark.createDataFrame([(5,), (-3,), (None,)], "doc_id long")
    got = {r["doc_id"]: r["f"] for r in df.select("doc_id", fold(F.col("doc_id"), 5).alias("f")).collect()}
    assert got == {5: zlib.crc32(b"5") % 5, -3: zlib.crc32(b"-3") % 5, None: 0}


def test_mixtures_name_both_languages(spark):
    english = "the house is on the hill and they went there with all of them for the day. " * 4
    german = "das haus steht auf dem berg und sie gingen mit allen dorthin weil es schön war. " * 4
    rows = [(i, english, "en") for i in range(5)] + [(i + 5, german, "de") for i in range(5)] + [(20, None, "fr"), (21, "x", None)]
    model = languages.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    ask = [(1, english + german[:200]), (2, german * 3 + english), (3, english), (4, "123 !?"), (5, None), (6, "")]
    got = {r["doc_id"]: r for r in languages.identify(spark.createDataFrame(ask, "doc_id long, text string"), model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 7)] == ["en", "de", "en", "und", "und", "und"]
    assert got[1]["languages"] == ["en", "de"] and got[2]["languages"] == ["de", "en"] and got[3]["languages"] == ["en"]
    assert abs(sum(got[1]["shares"]) - 1) < 1e-9 and got[4]["score"] == 0.0


def test_proportions_do_not_depend_on_neighbours():
    model = languages.Model(["a", "b"], np.random.default_rng(1).normal(-6, 1, (1 << languages.BITS, 2)).astype(np.float32))
    texts = ["some words here and there " * k for k in (1, 3, 50)]
    together = languages.infer(texts, model)[0]
    for i, t in enumerate(texts):
        assert np.allclose(languages.infer([t], model)[0][0], together[i])


def test_edges_of_all_three(spark, edges, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, 1), (7, 0), (None, 1), (3, None), (99, 1)], "doc_id long, label int")
    docs = edges.drop("label")
    for module in (quality, toxicity):
        for known in (labels, labels.where("label = 1"), labels.limit(0)):
            model = module.learn(docs, known)
            got = module.score(docs, model).collect()
            assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
            # Equal texts score alike.
            assert len({r["score"] for r in got if r["doc_id"] in (1, -8)}) == 1
            assert module.score(empty, model).count() == 0
        assert module.learn(empty, labels) is not None
    for rows in (docs, empty):
        model = languages.learn(rows)
        got = languages.identify(docs, model).collect()
        assert len(got) == docs.count()
        assert all((r["lang_pred"] == "und") == (r["score"] == 0.0) for r in got)
    assert {r["lang_pred"] for r in got} == {"und"}


def test_dual_descent_finds_the_margin():
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    y = np.array([1, 1, 0, 0])
    values = [np.array([1.0, 1.0])] * 4
    w, bias = quality.dual_descent(rows, values, y, np.full(4, 10.0), rounds=500)
    margin = [w[r] @ v + bias for r, v in zip(rows, values)]
    assert np.allclose(margin, [1, 1, -1, -1], atol=0.05)


def test_features_do_not_depend_on_neighbours():
    texts = ["One two THREE!! 44", "", "the the the the the the the", "a | b | c"]
    together = [sorted(f.tolist()) for f in quality.features(texts)]
    assert together == [sorted(next(quality.features([t])).tolist()) for t in texts]
    assert all(len(set(f)) == len(f) for f in together) and together[1] == []


def test_toxic_windows_get_shorter():
    toxic = [f"plain words all around number {i} you vilexword and hatedword too" for i in range(40)]
    plain = [f"plain words all around number {i} and many others too" for i in range(40)]
    measure = toxicity.Measure(*toxicity.dictionaries(toxic, plain))
    assert measure.shorter("they said vilexword hatedword to all of them").max() > 2
    assert measure.shorter("plain words all around and many others").max() <= 1
    assert len(measure.shorter("")) == 1 and len(measure.shorter("x" * 1000)) == 8


def test_language_sets_do_not_depend_on_other_texts():
    text = "a" * 32 * 60 + "b" * 32 * 25 + "c" * 32 * 15
    log_p = np.zeros((1 << languages.BITS, 3), np.float32)
    # Two languages much alike, one apart: the third set is the best, the second worse than the first.
    for sign, row in (("a", (0, -1.61, -12)), ("b", (-1.61, 0, -12)), ("c", (-12, -12, 0))):
        buffer, _, _ = languages.joined([sign * 100], languages.N)
        log_p[languages.hashed(buffer, languages.N, languages.BITS)[10]] = np.array(row) / 32
    model = languages.Model(["x", "y", "z"], log_p)
    alone = languages.infer([text], model)[0][0]
    assert (alone > 0.1).all()
    beside = ["a" * 32 * 50 + "b" * 32 * 50, "c" * 320, "a" * 32 * 50 + "c" * 32 * 50]
    together = languages.infer([*beside, text], model)[0]
    assert np.allclose(together[3], alone)
    for t, p in zip(beside, together):
        assert np.allclose(languages.infer([t], model)[0][0], p)
