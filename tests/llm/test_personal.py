import hashlib
import random
import re

import numpy as np
import pytest

from headway.llm import personal as P


def plainly(text):
    """Base spans as the patterns are written, one search per kind."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        odd = [int(c) for c in digits[-1::-2]]
        even = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
        if 14 <= len(digits) <= 19 and sum(odd + even) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def model(spark, sf):
    return P.learn(spark.read.parquet(f"{sf}/documents.parquet"), steps=150)


def test_base_spans_as_the_patterns_say():
    chance = random.Random(1)
    for _ in range(20000):
        text = "".join(chance.choice("0123456789@.+- ()ab\n%_é") for _ in range(chance.randint(0, 60)))
        assert P.base_spans(text) == plainly(text), text


def test_cards():
    for text in ("4111 1111-1111 1111", "4111111111111111", "pay 30569309025904 now", "4111111111111112", "1" * 25):
        assert P.base_spans(text) == plainly(text)
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


def test_long_runs_are_linear():
    text = "9" * 300000 + " a@b.c " + "1.2" * 100000 + "x@" * 100000 + "+1" * 50000
    assert (300001, 0, 300006) in P.base_spans(text)


def test_query(spark, sf, monkeypatch):
    monkeypatch.setattr(P, "learn", lambda docs, _learn=P.learn: _learn(docs, steps=60))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = P.op7_lstm_personal(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        base = plainly(docs[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[1] == k for s in base) for k in range(4)]
        named = [f"{P.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(named) <= set(spans) and len(spans) == len(named) + r["n_added"]


def test_the_network_agrees_with_labels_it_has_not_seen(spark, sf, model):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    x, y = P.labelled(texts, 300, seed=77)
    tags = P.viterbi(P.emissions(x, model), np.full(len(x), P.SIZE), model.step)
    got = [{(i, *s) for s in P.tag_spans(t)} for i, t in enumerate(tags)]
    want = [{(i, *s) for s in P.tag_spans(t)} for i, t in enumerate(y)]
    right = sum(len(a & b) for a, b in zip(got, want))
    assert right > 0.8 * sum(map(len, got)) and right > 0.75 * sum(map(len, want))


def test_added_spans_are_plausible_and_apart_from_base(model):
    chance = random.Random(9)
    texts = [" ".join(["some words", P._written(chance.randrange(4), chance), "and", P._decoy(chance), "more"] * 4) for _ in range(100)]
    added = 0
    for text, (base, more) in zip(texts, P.all_spans(texts, model)):
        assert base == plainly(text)
        for a, k, b in more:
            assert P.plausible(text[a:b], k) and not any(a < d and c < b for c, _, d in base)
        added += len(more)
    assert added > 50


def test_clean_text_has_no_spans(model):
    texts = ["", "no digits here at all", "in 2024-01-05 at 12:30 it cost 19.99", 'key = "1eb9c654e721b4f812088970"', "@home 3 4 5"]
    assert P.all_spans(texts, model) == [([], [])] * len(texts)


def test_windows_do_not_depend_on_neighbours(model):
    chance = random.Random(3)
    texts = [" ".join(["word"] * chance.randint(0, 60)) + P._written(k % 4, chance) + " tail " * 30 for k in range(20)]
    together = P.decoded_spans(texts, model)
    assert together == [P.decoded_spans([t], model)[0] for t in texts]


def test_the_gradient_is_right():
    chance = np.random.default_rng(2)
    e, step = chance.normal(size=(5, 2, P.TAGS)), chance.normal(size=(P.TAGS, P.TAGS))
    y = np.array([[0, 1], [1, 2], [2, 2], [0, 0], [3, 0]])

    def loss(e, step):
        full, alpha = step + P.FORBIDDEN, e[0] + P.FORBIDDEN[0]
        gold = e[0][np.arange(2), y[0]] + P.FORBIDDEN[0][y[0]]
        for t in range(1, 5):
            alpha = P._lse(alpha[:, :, None] + full, 1) + e[t]
            gold = gold + full[y[t - 1], y[t]] + e[t][np.arange(2), y[t]]
        return float((P._lse(alpha, 1) - gold).sum())

    d_e, d_step = P._crf(e, y, step)
    for index in ((0, 0, 1), (3, 1, 0), (4, 0, 3)):
        moved = e.copy()
        moved[index] += 1e-5
        assert abs((loss(moved, step) - loss(e, step)) / 1e-5 - d_e[index]) < 1e-3
    for index in ((0, 1), (1, 2), (2, 0)):
        moved = step.copy()
        moved[index] += 1e-5
        assert abs((loss(e, moved) - loss(e, step)) / 1e-5 - d_step[index]) < 1e-3


def test_viterbi_against_all_paths():
    from itertools import product

    chance = np.random.default_rng(3)
    step = chance.normal(size=(P.TAGS, P.TAGS)) + P.FORBIDDEN
    e = chance.normal(size=(3, 4, P.TAGS))
    lengths = np.array([4, 2, 1])
    tags = P.viterbi(e, lengths, step)
    for row, n in enumerate(lengths):
        def score(path, row=row):
            return P.FORBIDDEN[0][path[0]] + sum(e[row, t, k] for t, k in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))

        best = max(product(range(P.TAGS), repeat=int(n)), key=score)
        assert tuple(tags[row, :n]) == best


def test_masking():
    assert P.masked("a@b.c x 1.2.3.4!", [(0, 0, 5), (8, 1, 15)]) == "<EMAIL> x <IP>!"
    assert P.masked("0123456789", [(2, 2, 6), (4, 3, 8)]) == "01<CARD>89"
    assert P.masked("", []) == ""


def test_edges(spark, edges, empty, model):
    got = P.find(edges, model).collect()
    assert len(got) == edges.count() and all(r["spans"] == "" for r in got)
    assert P.find(empty, model).count() == 0
    out = P.redact(edges, model)
    assert out.columns == edges.columns and sorted(map(str, out.collect())) == sorted(map(str, edges.collect()))
    mail = spark.createDataFrame([(1, "to ann.b@mail.org now", 99)], "doc_id long, text string, n_chars int")
    assert P.redact(mail, model).collect()[0][1:] == ("to <EMAIL> now", 14)


def spelled_out(chance, n):
    """Addresses without a digit or an at sign, in long texts without either."""
    word = lambda: "".join(chance.choice("abcdefghiklmnoprstuvwz") for _ in range(chance.randint(3, 9)))
    out = []
    for _ in range(n):
        new = word() + "." + word() + chance.choice([" [at] ", "(at)", " at "]) + word() + chance.choice([" [dot] ", "(dot)", " dot "]) + "com"
        before = (P.CONTEXT + " ") * chance.randint(2, 5)
        out.append((before + "write to " + new + " " + (P.CONTEXT + " ") * 3, len(before) + 9, len(before) + 9 + len(new)))
    return out


def test_spelled_addresses_without_digits_are_found(model):
    made = spelled_out(random.Random(12), 80)
    found = sum((a, 0, b) in more for (_, a, b), (_, more) in zip(made, P.all_spans([t for t, _, _ in made], model)))
    assert found >= 40
    assert P.plausible("jane.doe [at] example [dot] com", 0) and not P.plausible("at home", 0)


def test_windows_left_out_change_nothing(model, monkeypatch):
    chance = random.Random(13)
    texts = [t for t, _, _ in spelled_out(chance, 60)]
    for k in range(100):
        text = "".join((P.CONTEXT + ". ") * chance.randint(1, 4) + P._written(chance.randrange(4), chance) + " " for _ in range(3))
        texts.append(text + P._decoy(chance) + " " + P.CONTEXT * 3)
    some = P.all_spans(texts, model)
    monkeypatch.setattr(P, "marked", lambda text, x: np.ones(len(x), bool))
    assert P.all_spans(texts, model) == some


@pytest.mark.parametrize("text", [
    "jane.doe [at] example [dot] com", "a_b(at)x(dot)org", "jane dot doe at mail dot example dot org", "A.B AT EXAMPLE DOT COM",
    "x" * 200 + " { at } " + "y" * 200 + ".net", "me@here [.] org", "x ( dot ) y\n@\tz.com", "a@b.c",
])
def test_what_is_plausible_is_marked_whole(text):
    assert P.plausible(text, 0)
    whole = f"he said; {text}, of old"
    assert P.marked(whole, P.codes(whole))[9 : 9 + len(text)].all()


@pytest.mark.parametrize("text", ["dot " * 50000, "at a dot " * 30000, "x@" * 100000, "( " * 100000 + "at", "1" + " " * 200000 + "dot", "a at " * 60000])
def test_marking_is_linear(text):
    P.marked(text, P.codes(text))
