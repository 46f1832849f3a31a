"""Models that are asked in batches: one a worker, answers in their rows, failures as rows."""

import pytest

from corvina.operators import models


@pytest.mark.parametrize("texts", [1, 3, 32])
def test_batches_are_of_about_one_length(texts):
    lengths = [5, 900, 1, 0, 5, 70, 3000, 5, 64, 66]
    asking = models.Asking(texts=texts, characters=1000)
    got = list(models.batches_by_length(lengths, asking))
    assert sorted(i for b in got for i in b) == list(range(10))
    assert all(len(b) <= texts and (len(b) == 1 or len(b) * max(lengths[i] for i in b) <= 1000) for b in got)
    assert [lengths[i] for b in got for i in b] == sorted(lengths)


def counting():
    """A backend whose model tells its calls, is busy at first, and fails on a text of one kind; made here, so that it is pickled whole."""

    class Counting:
        key = "counting"

        def load(self):
            calls = []

            def run(texts):
                calls.append(len(texts))
                if len(calls) == 1:
                    raise TimeoutError("busy")
                if any("bad" in t for t in texts):
                    raise ValueError("bad text")
                return [None if t == "none" else f"{len(t)}" for t in texts]

            run.calls = calls
            return run

    return Counting()


def test_failures_spoil_no_other_text():
    model = counting().load()
    asking = models.Asking(tries=2, wait=0.0)
    told = models._asked(model, ["a", "bad", "none", "abc"], asking)
    assert told == [("1", None), (None, "ValueError: bad text"), (None, "no_answer"), ("3", None)]
    assert model.calls == [4, 4, 1, 1, 1, 1, 1]  # twice together, then one by one, the bad one twice
    assert models._asked(lambda texts: [], ["a"], asking) == [(None, "ValueError: 0 answers to 1 texts")]


def test_labels_stay_in_their_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(["b" * 50, None, "", " \n", "bad", "none", "a", "cc", "a"])]
    df = spark.createDataFrame(rows, "`i.d` int, text string, label string").coalesce(1)
    got = {r["i.d"]: (r.label, r.label_reason) for r in models.label(df, "text", counting(), asking=models.Asking(texts=3, wait=0.0)).collect()}
    assert got == {0: ("50", None), 1: (None, "missing_text"), 2: (None, "empty_text"), 3: (None, "empty_text"), 4: (None, "ValueError: bad text"), 5: (None, "no_answer"), 6: ("1", None), 7: ("2", None), 8: ("1", None)}
    assert models.label(df.limit(0), "text", counting()).count() == 0


def test_backends_by_name():
    terms = models.build("terms", labels=(("yes", ("good", "fine")), ("no", ("bad",))), other="?")
    assert terms.load()(["All FINE", "bad", "so", "good and bad"]) == ["yes", "no", "?", "yes"]
    with pytest.raises(ValueError, match="no backend is called 'gpu'; there are terms"):
        models.build("gpu")
    models._loaded.clear()
    one = models._model(terms)
    assert models._model(models.build("terms", labels=terms.labels, other="?")) is one and len(models._loaded) == 1
    models._model(counting())
    assert len(models._loaded) == 1
