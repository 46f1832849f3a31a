"""Aliases along a trie and by bigrams, against looking at every alias; containment joins against all pairs."""

import difflib
import random
import re

import pytest

from corvina.functions import text, vocab
from corvina.operators import aliases, containment


def by_regex(names, sentence):
    return sorted((m.start(), m.end(), a) for a in names for m in re.finditer(rf"\b{re.escape(a)}\b", sentence))


@pytest.mark.parametrize("seed", range(20))
def test_occurrences_are_those_of_whole_word_search(seed):
    rng = random.Random(seed)
    words = ["a", "b", "ab", "é", "x1", "a-b", "(a)", "a.b", "_", "a b a", "+a", "b+", " a", "--"]
    names = list({rng.choice(["", " ", "  ", "-"]).join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(30)} - {""})
    trie = aliases.Trie(names)
    for _ in range(60):
        sentence = rng.choice([" ", ", ", "", " - "]).join(rng.choice(words) for _ in range(rng.randint(0, 12)))
        assert sorted(trie.occurrences(sentence)) == by_regex(names, sentence)


def near(rng, name):
    name = list(name)
    for _ in range(rng.randint(0, 3)):
        i = rng.randrange(len(name) + 1)
        how = rng.random()
        name[i : i + (how < 0.6)] = [rng.choice("abcdefgh ")] if how < 0.7 else []
    return "".join(name)


@pytest.mark.parametrize("cutoff", [0.92, 0.85, 0.7, 0.5])
def test_the_closest_is_that_of_all(cutoff):
    rng = random.Random(int(cutoff * 100))
    names = list({"".join(rng.choice("abcd ") for _ in range(rng.randint(1, 30))) for _ in range(250)} | {"a" * n for n in range(1, 12)} | {"ab" * n for n in range(1, 8)})
    index = aliases.GramIndex(names, cutoff)
    hits = 0
    for _ in range(400):
        phrase = near(rng, rng.choice(names)) or "a"
        best = difflib.get_close_matches(phrase, names, 1, cutoff)
        assert index.closest(phrase) == (best[0] if best else None)
        hits += bool(best)
    assert hits > 100


def test_few_aliases_are_compared():
    rng = random.Random(2)
    names = list({" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3)) for _ in range(20_000)})
    index = aliases.GramIndex(names, 0.92)
    assert all(index.closest(n[:-1] + "z") == n for n in names[:50])
    assert sum(len(list(index.candidates(n))) for n in names[:200]) < 300


def test_counts_in_whole_texts(spark):
    rows = [(1, "The hot bolt, hot bolt and hotbolt; a Hot  Bolt."), (2, None), (3, ""), (4, "bolt " * 1000)]
    df = spark.createDataFrame(rows, "id int, text string")
    from pyspark.sql import functions as F

    got = df.select("id", F.inline(aliases.alias_counts(text.normalize(F.col("text")), ["hot bolt", "bolt", "cold"])))
    assert {(r.id, r.alias, r.n, r["first"]) for r in got.collect()} == {(1, "hot bolt", 3, 4), (1, "bolt", 3, 8), (4, "bolt", 1000, 0)}
    assert aliases.vocabulary(spark.createDataFrame([("b",), ("a",), (None,), ("",), ("b",)], "x string"), "x") == ["a", "b"]


def test_a_vocabulary_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr(aliases, "MOST_ALIASES", 3)
    with pytest.raises(ValueError, match="3 aliases at most"):
        aliases.vocabulary(spark.range(4).selectExpr("cast(id AS string) AS x"), "x")


def test_the_matcher_on_the_fixed_vocabulary():
    m = aliases.AliasMatcher(vocab.ALIASES)
    names = list(vocab.ALIASES)
    assert all(m.index.closest(n) == difflib.get_close_matches(n, names, 1, 0.92)[0] for n in names)


@pytest.mark.parametrize("seed", range(4))
def test_containment_is_that_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    made = lambda n: [(rng.choice(["k", "l", None]), rng.choice([None, ""]) if rng.random() < 0.05 else "".join(rng.choice("aab é𝔘") for _ in range(rng.randint(1, 9)))) for _ in range(n)]
    left, right = made(120), made(120)
    got = containment.containment_pairs(spark.createDataFrame(left, "k string, a string"), spark.createDataFrame(right, "k string, b string"), ["k"], "a", "b").collect()
    want = {(k, a, b) for k, a in left for j, b in right if k and k == j and a and b and (a in b or b in a)}
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_a_hot_key_makes_no_pairs(spark):
    """20,000 texts of one key each hold a number of their own: what is joined is about what is found."""
    left = spark.range(20_000).selectExpr("'k' AS k", "concat('disease number ', id + 100000, ' of all') AS a")
    right = spark.range(20_000).selectExpr("'k' AS k", "concat('number ', id * 2 + 100000) AS b")
    assert containment.containment_pairs(left, right, ["k"], "a", "b").count() == 10_000
