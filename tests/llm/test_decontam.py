"""Names that begin sentences or are spelt beyond ASCII, and the join against brute force."""

import random
import re

import pytest

from corvina.llm import decontam

TOM = "Tom has 12 apples. Tom gives 5 apples to Mary. Mary eats 2 apples. How many apples do Tom and Mary have now?"


def found(item, doc):
    return decontam.leak(item, doc)


def named(tom, mary):
    return TOM.replace("Tom", tom).replace("Mary", mary)


PAIRS = [("Anna", "Bob"), ("Émile", "Ольга"), ("İbrahim", "Łukasz")]


@pytest.mark.parametrize("tom, mary, before", [(*p, b) for p in PAIRS for b in ("", "Some words before. ", "Question: ")] + [("Anna Jones", "Bob Lee", "")])
def test_names_at_sentence_starts(tom, mary, before):
    assert found(TOM, before + named(tom, mary).replace("12", "40"))


def test_names_beyond_ascii_inside_sentences():
    item = "In the morning Émile sold 12 apples to Ольга and later İpek gave 3 more to Émile for his cake"
    assert found(item, item.replace("Émile", "Tom").replace("Ольга", "Mary").replace("İpek", "Ann"))
    assert found(item, item.replace("İpek", "Émile".upper())) and not found(item, item.replace("to Émile", "to Łukasz"))


def test_a_name_at_a_sentence_start_must_be_consistent():
    assert found(TOM, named("Anna", "Bob")) and not found(TOM, named("Anna", "Bob").replace("Anna gives", "Carl gives"))


def test_one_word_sentences_are_no_template():
    assert not found("Red. Green. Blue. Black. White. Brown.", "One. Two. Three. Four. Five. Six. Seven.")


def test_through_spark(spark):
    df = spark.createDataFrame([(1, named("Anna", "Bob")), (2, "Nothing of the kind.")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, TOM)], "item_id bigint, text string")
    assert [r.id for r in decontam.contaminated(df, bench).collect()] == [1]
    assert [r.doc_id for r in decontam.decontaminate(df, bench).collect()] == [2]


def test_a_consistent_stretch_after_a_clashing_one():
    item = "If there are 12 boxes with 7 apples in each then the 12 boxes hold how many apples in all of the 12 boxes together"
    clash, other = item.replace("12", "30", 1), "and here some words of no interest stand between one question and the next "
    assert not found(item, clash) and not found(item, (clash + " " + other) * 3)
    for doc in (clash + " " + other + item, (clash + " " + other) * 3 + item, item + " " + other + clash):
        assert found(item, doc)[3] == 0
    assert found(item, clash + " " + other + item.replace("12", "30"))[3] == 3


def test_a_document_with_a_clashing_variant_goes(spark):
    item = "If there are 12 boxes with 7 apples in each then the 12 boxes hold how many apples in all of the 12 boxes together"
    df = spark.createDataFrame([(1, item.replace("12", "30", 1) + " and then " + item), (2, item.replace("12", "30", 1))], "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, item)], "item_id bigint, text string")
    assert [r.doc_id for r in decontam.decontaminate(df, bench).collect()] == [2]


NUM, UNIT, NAME = "<num>", "<unit>", "<name>"


def brute_template(text, names):
    """(codes, fillings) of plain ASCII text; names: none, inner, alone or joined."""
    tokens = re.findall(r"[A-Za-z0-9]+(?:[.,:/](?=[0-9])[A-Za-z0-9]+)*|[.!?\n%$]", text)
    out, first, before, run = [], True, "", False
    for t in tokens:
        if t in ".!?\n":
            first, before, run = True, t, False
            continue
        number, capital = t[0].isdigit(), t[0].isupper()
        kind = NUM if number else UNIT if t.lower() in decontam.UNITS and before == NUM else ""
        mark = t in "%$"
        if not kind and not mark and capital and t.lower() not in decontam.UNITS and names != "none" and not (names == "inner" and first):
            kind = NAME
        if mark and not kind:
            before, run, first = t, False, False
            continue
        if kind == NAME and run and not (names == "alone" and alone):
            out[-1][1] += " " + t.lower()
            alone = False
        else:
            out.append([kind or t.lower(), t.lower() if kind else ""])
            alone = first
        run, before, first = kind == NAME, kind, False
    return [tuple(x) for x in out]


def brute(items, docs, size=5, share=0.8):
    """Leaks as {(document, item): (found, windows)} by looking at every stretch of every reading."""
    out = {}
    for d, text in docs:
        for i, item in items:
            best = None
            for names in ("none", "inner", "alone", "joined"):
                a, b = brute_template(item or "", names), brute_template(text or "", names)
                k = min(size, len(a))
                if not k:
                    continue
                told = lambda w, names=names: names in ("none", "inner") or not all(v for _, v in w)
                wins = [j for j in range(len(a) - k + 1) if told(a[j : j + k])]
                met = [(p, j) for p in range(len(b) - k + 1) for j in wins if [c for c, _ in b[p : p + k]] == [c for c, _ in a[j : j + k]]]
                slack = max(2, len(wins) // 5)
                stretches = []
                for s in sorted({p - j for p, j in met}):
                    part = sorted([(p - j, n) for n, (p, j) in enumerate(met) if s <= p - j <= s + slack])
                    many = {met[n][1] for _, n in part}
                    if wins and len(many) >= share * len(wins):
                        seen, took = set(), []
                        for _, n in part:  # up to where it has all of its different windows
                            took.append(n)
                            seen.add(met[n][1])
                            if seen == many:
                                break
                        stretches.append((-len(many), s, [met[n] for n in took]))
                for many, _, part in sorted(stretches):
                    shifts = [p - j for p, j in part]
                    common = min(set(shifts), key=lambda s: (-shifts.count(s), s))
                    slots = {}
                    for p, j in part:
                        for o in range(k):
                            if a[j + o][1]:
                                slots.setdefault(j + o, set()).add((abs(p - j - common), p + o))
                    stands, clash = {}, False
                    for at, places in slots.items():
                        stands.setdefault(a[at], set()).add(b[min(places)[1]][1])
                    clash = any(len(v) > 1 for v in stands.values())
                    if not clash:
                        if best is None or -many > best[0]:
                            best = (-many, len(wins))
                        break
            if best:
                out[(d, i)] = best
    return out


def corpora(seed):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}x" for i in range(14)] + ["km", "percent"]
    names = ["Tom", "Mary", "Anna", "Bob"]

    def text(n):
        out = []
        for _ in range(n):
            kind = rng.random()
            out.append(str(rng.randint(1, 9)) if kind < 0.2 else rng.choice(names) if kind < 0.35 else rng.choice(words) + ("." if rng.random() < 0.1 else ""))
        return " ".join(out)

    items = [(i, text(rng.choice([1, 3, 6, 12, 25]))) for i in range(12)] + [(50, None), (51, ""), (52, "... !")]
    docs = [(0, None), (1, ""), (2, "! . ?")]
    for i in range(40):
        parts = [text(rng.randint(0, 15))]
        for _ in range(rng.randint(0, 3)):
            ws = rng.choice(items[:12])[1].split()
            for _ in range(rng.randint(0, 3)):
                if rng.random() < 0.5:
                    a, b = rng.choice(names), rng.choice(names)
                    ws = [b if w == a else w for w in ws]
                else:
                    ws[rng.randrange(len(ws))] = rng.choice([*words, *names, "7"])
            parts += [" ".join(ws), text(rng.randint(0, 6))]
        docs.append((10 + i, " ".join(parts)))
    return items, docs + docs[5:9]


@pytest.mark.parametrize("seed", range(4))
def test_the_join_against_brute_force(spark, monkeypatch, seed):
    from corvina.llm import common

    if seed % 2:  # no side is short enough to go to all tasks
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    items, docs = corpora(seed)
    df = spark.createDataFrame([(f"d{d}", t, "x") for d, t in docs], "doc_id string, text string, item_id string").repartition(3)
    bench = spark.createDataFrame([(f"i{i}", t) for i, t in items], "item_id string, text string")
    rows = decontam.contaminated(df, bench).collect()
    got = {(r.id, r.item_id): (r.n_found, r.n_windows) for r in rows}
    want = {(f"d{d}", f"i{i}"): x for (d, i), x in brute(items, docs).items()}
    assert len(want) > 20 and got == want
    times = {f"d{d}": sum(x == d for x, _ in docs) for d, _ in docs}
    assert len(rows) == sum(times[d] for d, _ in want)
    left = {r.doc_id for r in decontam.decontaminate(df, bench).collect()}
    assert left == {f"d{d}" for d, _ in docs} - {d for d, _ in want}


def test_a_very_long_text_and_an_item_of_few_tokens(spark):
    long = "plain words of no interest stand here. " * 30_000
    df = spark.createDataFrame([(1, long + named("Anna", "Bob") + " " + long), (2, "Name it now"), (3, "Name it then")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, TOM), (10, "Name it now")], "item_id bigint, text string")
    assert sorted((r.id, r.item_id) for r in decontam.contaminated(df, bench).collect()) == [(1, 9), (2, 10)]


def test_a_document_that_holds_the_whole_benchmark(spark):
    """Every item is found in it, from the windows of that item alone."""
    rng = random.Random(7)
    items = [(i, " ".join(f"w{rng.randint(0, 300)}" for _ in range(30)) + ".") for i in range(150)]
    dump = "\n".join(t for _, t in items)
    docs = [(1, dump), (2, dump + "\n" + dump), (3, items[3][1]), (4, "nothing of them")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r.id, r.item_id): (r.n_found, r.n_windows) for r in decontam.contaminated(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert set(got) == {(d, i) for d in (1, 2) for i in range(150)} | {(3, 3)} and all(n == of for n, of in got.values())
