"""Long licence expressions, and what they are evaluated to."""

import random

from corvina.llm import licenses

TAG = "SPDX-License-Identifier: "


def test_long_and_deep_expressions_are_read_whole():
    ids = [f"LicenseRef-{i}" for i in range(3000)]
    ((text, tree),) = licenses.expressions(TAG + " OR ".join(ids))
    assert licenses.identifiers(tree) == {i.lower() for i in ids} and text == " OR ".join(ids)
    deep = "(" * 2000 + "MIT" + " AND ISC)" * 2000
    assert licenses.identifiers(licenses.expressions(TAG + deep)[0][1]) == {"mit", "isc"}
    ((text, tree),) = licenses.expressions(TAG + "MIT OR ISC AND (" + " OR ".join(ids))
    assert text == "MIT OR ISC" and tree == ("or", "mit", "isc")


def test_many_exceptions_are_evaluated():
    ((_, tree),) = licenses.expressions(TAG + "GPL-2.0 " + "WITH x " * 10_000)
    named, every, kind = licenses.evaluate(tree)
    assert named == every and len(named) == 1 and licenses.OBLIGATIONS[kind] == "copyleft"
    deep = "mit"
    for i in range(10_000):
        deep = ("with", deep, f"e{i}")
    assert len(licenses.evaluate(deep)[0]) == 1


def test_many_tags_on_a_line_cost_in_proportion():
    import time

    def seconds(n):
        began = time.process_time()
        found = licenses.expressions((TAG + "MIT ") * n)
        assert len(found) == n and all(t == "mit" for _, t in found)
        return time.process_time() - began

    seconds(1000)
    assert seconds(80_000) < 40 * max(seconds(4000), 0.01)
    assert licenses.expressions(f"{TAG}MIT\n{TAG}\n{TAG}ISC OR MIT") == [("MIT", "mit"), ("", None), ("ISC OR MIT", ("or", "isc", "mit"))]


def test_longest_prefix_against_brute_force():
    rng = random.Random(3)
    for _ in range(3000):
        parts = [rng.choice(["(", ")", "a", "b", "OR", "and", "with"]) for _ in range(rng.randint(0, 9))]
        assert licenses.well_formed(parts) == max((n for n in range(1, len(parts) + 1) if licenses.parse(parts[:n]) is not None), default=0)


def test_and_or_with_are_evaluated():
    say = lambda e: licenses.evaluate(licenses.expressions(TAG + e)[0][1])
    told = lambda e: (say(e)[1], licenses.OBLIGATIONS[say(e)[2]])
    assert told("MIT OR GPL-3.0-only") == (set(), "permissive")
    assert told("MIT AND GPL-3.0-only") == ({"mit", "gpl-3.0-only"}, "copyleft")
    assert told("MIT AND (GPL-3.0-only OR MIT AND ISC)") == ({"mit"}, "permissive")
    assert told("GPL-2.0+ WITH Classpath-exception-2.0") == ({"gpl-2.0+ with classpath-exception-2.0"}, "weak copyleft")
    assert told("hello OR MIT") == (set(), "permissive") and told("hello AND MIT") == ({"mit"}, "unknown")


def test_unknown_identifiers_are_no_labels():
    search = licenses.automaton([*licenses.BASE, *licenses.NOTICES, *licenses.TAGS])
    assert licenses.scan(TAG + "hello world", search)[5:] == ([], licenses.UNKNOWN_WEIGHT, ["hello"], [], "unknown")
    assert licenses.scan(TAG + "MIT", search)[5:] == (["mit"], 1.0, ["MIT"], ["mit"], "permissive")
    assert licenses.scan("nothing of the kind", search)[6:] == (0.0, [], [], None)


def test_evaluation_against_enumerated_choices():
    rng = random.Random(11)
    ids = ["mit", "isc", "gpl-3.0-only", "lgpl-2.1", "agpl-3.0", "cc-by-nc-4.0", "nobody-knows"]

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(ids)
        return (rng.choice(("and", "or")), tree(depth - 1), tree(depth - 1))

    def choices(node):
        if isinstance(node, str):
            return [frozenset([node])]
        a, b = choices(node[1]), choices(node[2])
        return a + b if node[0] == "or" else [x | y for x in a for y in b]

    for _ in range(400):
        one = tree(4)
        sets = choices(one)
        named, every, kind = licenses.evaluate(one)
        known = lambda xs: {x for x in xs if x != "nobody-knows"}
        assert named == known(set().union(*sets)) and kind == min(max(map(licenses.obligation, s)) for s in sets)
        assert every <= known(frozenset.intersection(*sets))  # what each side needs as written; a choice may need more by chance
        if "or" not in str(one):
            assert every == named


def test_nested_and_overlapping_base_phrases_are_counted(monkeypatch):
    monkeypatch.setitem(licenses.BASE, "the gnu general public license", "gpl")
    search = licenses.automaton([*licenses.BASE, *licenses.NOTICES, *licenses.TAGS])
    text = "see the GNU general public license, or the gnu general public license and cc by"
    assert licenses.scan(text, search)[:4] == (15, 5, 1, 13)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, labels string")
    out = licenses.license_scan(df)
    assert out.count() == 0 and out.columns == ["doc_id", *licenses.FIELDS]
