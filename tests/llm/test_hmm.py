from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ringledger.llm import hmm
from ringledger.llm.hmm import Model


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    start, step, emit = rng.random(3), rng.random((3, 3)), rng.random((5, 3))
    return Model({}, np.zeros(5), np.zeros(0), start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, sequence):
    """Every state path with its probability."""
    for states in itertools.product(range(3), repeat=len(sequence)):
        p = model.start[states[0]] * model.emit[sequence[0], states[0]]
        for (a, b), c in zip(itertools.pairwise(states), sequence[1:], strict=True):
            p *= model.step[a, b] * model.emit[c, b]
        yield states, p


SEQUENCES = [np.array(s) for s in ([0], [1, 2, 2, 4], [3, 3, 3, 0, 1, 2], [4, 0])]


def test_forward_sums_all_paths(model):
    wanted = [math.log10(sum(p for _, p in paths(model, s))) for s in SEQUENCES]
    assert hmm.forward(SEQUENCES, model) == pytest.approx(wanted)
    assert hmm.forward([], model).tolist() == []


def test_forward_of_a_very_long_sequence(model):
    long = np.tile(SEQUENCES[2], 5000)
    (whole,) = hmm.forward([long], model)
    assert math.isfinite(whole) and whole < -5000


def test_expected_counts(model):
    batch = pa.record_batch({"classes": pa.array([s.tolist() for s in SEQUENCES], pa.list_(pa.int32()))})
    starts, steps, emissions, log = hmm.expected_counts(*hmm._windows(batch), model)
    wanted = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in SEQUENCES:
        total = sum(p for _, p in paths(model, s))
        for states, p in paths(model, s):
            wanted[0][states[0]] += p / total
            for a, b in itertools.pairwise(states):
                wanted[1][a, b] += p / total
            for c, state in zip(s, states, strict=True):
                wanted[2][c, state] += p / total
    assert starts == pytest.approx(wanted[0]) and steps == pytest.approx(wanted[1]) and emissions == pytest.approx(wanted[2])
    assert log / math.log(10) == pytest.approx(sum(hmm.forward(SEQUENCES, model)))


def test_windows_cover_every_token():
    rng = np.random.default_rng(1)
    lists = [rng.integers(0, 9, n).tolist() for n in (1, 127, 128, 129, 300, 1000)]
    batch = pa.record_batch({"classes": pa.array([[7], *lists], pa.list_(pa.int32()))}).slice(1)
    matrix, size, begins = hmm._windows(batch)
    assert sorted(matrix[matrix >= 0]) == sorted(itertools.chain(*lists))
    assert size.sum() == sum(map(len, lists)) and begins.sum() == len(lists) and (np.diff(size) <= 0).all()


def test_tokens():
    assert hmm.tokens_of("A\x1cB é Ç\x0bx".encode()) == ["a\x1cb".encode(), "é Ç".encode(), b"x", hmm.END]
    assert hmm.tokens_of(None) == hmm.tokens_of(b"") == [hmm.END]


def expected_base(texts, learn):
    tokens = {d: hmm.tokens_of((t or "").encode()) for d, t in texts.items()}
    counts = Counter(itertools.chain(*(tokens[d] for d in texts if learn(d))))
    n, v = sum(counts.values()), len(counts)
    return {
        d: (len(ts), sum(t in counts for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)) for d, ts in tokens.items()
    }


def scored(docs, learn="doc_id % 5 != 0"):
    text = F.coalesce("text", F.lit("")).cast("binary")
    return hmm.score(docs.select("doc_id", F.expr(f"coalesce({learn}, true)").alias("learn"), text.alias("text"))).collect()


def test_odd_documents(documents):
    texts = {1: None, 2: "", 3: "The the  THE\n\x0bcat", 4: "é x\x1cy", 5: "unseen words", 10: "the cat", 6: "w " * 30_000, 7: " "}
    found = scored(documents(*texts.items(), (3, texts[3])))
    wanted = expected_base({**texts, 8: texts[3]}, lambda d: d % 5 != 0)
    assert len(found) == 9
    for r in found:
        n, known, total, base = wanted[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-12) and math.isfinite(r["score"]) and r["score"] < 0


def test_nothing_to_learn_from(documents):
    docs = documents((1, "a b"), (None, None))
    assert scored(docs.where("false")) == []
    assert [(r["score"], r["base_score"], r["train_tokens"]) for r in scored(docs, "false")] == [(0.0, 0.0, 0)] * 2


def test_given_documents(spark, sf_dir, small):
    from ringledger.llm.queries import QUERIES

    _, texts = small
    found = QUERIES["op3_hmm_score"](spark, sf_dir).collect()
    learn = {r["doc_id"]: not r["held_out"] for r in found}
    wanted = expected_base(texts, learn.__getitem__)
    for r in found:
        n, known, total, base = wanted[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-12)
    held_out = [r for r in found if r["held_out"]]
    assert len(held_out) > 10 and sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)


def test_rare_tokens_have_a_distribution_within_their_class(documents, monkeypatch):
    """Scores as without Spark, when most tokens share classes."""
    monkeypatch.setattr(hmm, "CLASSES", 4)
    monkeypatch.setattr(hmm, "ROUNDS", 1)
    texts = {n: f"the cat sat on word{n} word{n % 3} zz{n}" for n in range(1, 20)}
    docs = documents(*texts.items())
    slim = docs.select("doc_id", F.expr("doc_id % 5 != 0").alias("learn"), F.col("text").cast("binary").alias("text"))
    model, counts, _, _, _, frequent = hmm.fit(slim)
    n_of = {bytes(r["token"]): r["n"] for r in counts.collect()}
    top = len(model.classes)
    monkeypatch.setattr(hmm, "fit", lambda _: (model, counts, _sequences(slim, model), sum(n_of.values()), len(n_of), frequent))
    for r in hmm.score(slim).collect():
        tokens = hmm.tokens_of(texts[r["doc_id"]].encode())
        classes = [model.classes.get(t, top + hmm.shared_class(t)) for t in tokens]
        score = hmm.forward([np.array(classes)], model)[0]
        for t, c in zip(tokens, classes, strict=True):
            if t not in model.classes:
                members = [n for u, n in n_of.items() if u not in model.classes and top + hmm.shared_class(u) == c]
                once = sum(n == 1 for n in members) + 1
                score += math.log10((n_of.get(t) or once) / (sum(members) + once))
        assert r["score"] == pytest.approx(score)


def _sequences(docs, model):
    return hmm.stored(hmm._classes(docs, model), "classes")
