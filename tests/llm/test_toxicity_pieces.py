"""What the field is fitted to, and how."""

import itertools
from zlib import crc32

import numpy as np
import pytest

from corvina.llm import toxicity


def test_every_token_of_a_long_sequence_is_fitted(monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity.Field, "fit", lambda self, f, y, n: seen.append((y.sum(), n.sum(), n.max())))
    docs = [("plain words " * 60 + "zzgrudge " + "plain words " * 40, 1)] * 20 + [("plain words " * 100, 0)] * 100
    toxicity.train(docs)
    assert seen == [(20, 20 * 201 + 100 * 200, toxicity.PIECE)]


def likelihood(field, f, y, n):
    """The mean log-likelihood per token, by enumeration of all labellings."""
    total = 0.0
    for s in range(len(n)):
        e = field.w[f[s, : n[s]]].sum(1) + field.bias
        score = lambda ys, e=e: e @ np.array(ys) + sum(field.t[i, j] for i, j in zip(ys, ys[1:], strict=False))
        total += score([int(v) for v in y[s, : n[s]]]) - np.log(sum(np.exp(score(ys)) for ys in itertools.product((0, 1), repeat=int(n[s]))))
    return total / n.sum()


def test_gradient_against_finite_differences(monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 12)
    rng = np.random.default_rng(5)
    field = toxicity.Field()
    field.w, field.bias, field.t = rng.normal(size=12), -0.4, rng.normal(size=(2, 2))
    f, n = rng.integers(0, 12, (5, 6, 3)), np.array([6, 1, 3, 2, 5])
    y = rng.integers(0, 2, (5, 6)).astype(float)
    y[np.arange(6) >= n[:, None]] = 0
    g, step = field.gradient(f, y, n), 1e-5
    for i in range(17):
        def moved(by, i=i):
            other = toxicity.Field()
            v = np.concatenate([field.w, [field.bias], field.t.ravel()])
            v[i] += by
            other.w, other.bias, other.t = v[:12], v[12], v[13:].reshape(2, 2)
            return likelihood(other, f, y, n)

        assert abs((moved(step) - moved(-step)) / (2 * step) - g[i]) < 1e-6


def test_long_sentences_are_told_whole(monkeypatch):
    """Against one forward and one backward pass over each sentence in plain Python, in groups of any size."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(50)]
    field = toxicity.Field()
    field.w, field.bias, field.t = rng.normal(size=toxicity.BUCKETS), -0.5, np.array([[1.8, -1.5], [-1.4, 1.9]])
    texts = [" ".join(rng.choice(words, k)) + ". b c!\n" for k in (1, 255, 256, 257, 1500)]

    def alone(tokens):
        x, t = [np.exp(field.w[toxicity.features(w)].sum() + field.bias) for w in tokens], np.exp(field.t)
        ahead = [np.array([1.0, x[0]])]
        for v in x[1:]:
            now = ahead[-1] @ t * [1.0, v]
            ahead.append(now / now.sum())
        back = [np.ones(2)]
        for v in x[:0:-1]:
            now = t @ (back[-1] * [1.0, v])
            back.append(now / now.sum())
        both = [a * b for a, b in zip(ahead, back[::-1], strict=True)]
        return [b[1] / b.sum() for b in both]

    want = [[*alone(t.split(".")[0].split()), 0, *alone(["b", "c"]), 0, 0] for t in texts]
    for together in (1, 300, 4_000_000):
        monkeypatch.setattr(toxicity, "TOGETHER", together)
        for a, b in zip(want, toxicity.Scorer(field).marginals(texts), strict=True):
            assert np.abs(np.array(a) - b).max() < 1e-9


def test_rows_that_repeat_an_id_give_one_text(spark):
    docs = spark.createDataFrame([(i % 4, f"text {i} " * 20) for i in range(400)] + [(9, "x" * 50), (9, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (0, 1, 2, 3, 9)], "doc_id bigint, toxic int")
    got = toxicity.labelled_sample(docs, labels, "doc_id", "text", 100, 1 << 16)
    ids = {i for i in (0, 1, 2, 3, 9) if crc32(str(i).encode()) % 5}
    assert len(got) == len(ids) and all(t.startswith(("text", "xx")) for t, _ in got)
    assert len(toxicity.labelled_sample(docs, labels, "doc_id", "text", 1, 1 << 16)) == 2
    few = toxicity.labelled_sample(docs, labels, "doc_id", "text", 100, 1 << 16, total=200)
    assert all(sum(len(t) for t, y in few if y == label) <= 200 for label in (0, 1)) and len(few) < len(got)


def test_a_letter_that_grows_when_small_changes_nothing():
    docs = [("plain words stand here " * 5 + "vilebad vilebad thing", 1), ("plain words stand here " * 5, 0)] * 60
    score = toxicity.Scorer(toxicity.train(docs)).spans
    (a, x), (b, y) = score(["plain VILEBAD words plain words", "plain VILEBAD words plain words \u0130"])
    assert a > 0.5 and b > 0.5 and x[0] == y[0] == (6, 13)


def test_held_out_labels_of_the_given_tables(spark):
    """Recall and precision on rows that were not fitted."""
    from corvina.llm.queries import op8_toxicity

    d = "/root/testdata/sf0.1"
    try:
        labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        pytest.skip("the given tables are not here")
    rows = [r for r in op8_toxicity(spark, d).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert all(crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in rows)
    hit = sum(r.predicted and labels[r.doc_id] for r in rows)
    assert hit >= 0.9 * sum(labels[r.doc_id] for r in rows) and hit >= 0.9 * sum(r.predicted for r in rows)
