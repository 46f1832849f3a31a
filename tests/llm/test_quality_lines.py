from collections import Counter

from pyspark.sql import functions as F

from corvina.llm import linededup, quality


def test_quality_counts_against_brute_force(spark, corpus):
    extra = [(300, "All rights reserved.\nA good line of prose ends here.\nHome | About | Contact | Help\nNO!! WAY!! THIS!! IS!! IT!!", "s"), (301, "q w e q w e q w e. " * 30, "s")]
    df = spark.createDataFrame([(*r, "x") for r in [*corpus, *extra]], "doc_id bigint, text string, source string, n_words string")
    got = quality.quality(df.repartition(3))
    assert Counter(got.columns) == Counter(["doc_id", "text", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned_text", "kept"])
    for r in got.collect():
        text = r.text or ""
        w = [x.decode() for x in text.encode().split()]
        three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w)) and r.n_repeat_words == len(hit)
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        if r.doc_id == 300:
            assert r.cleaned_text == "A good line of prose ends here."


def test_quality_verdict(spark):
    prose = "\n".join(" ".join(f"word{k}" for k in range(i * 12, i * 12 + 12)) + "." for i in range(8))
    menu = "\n".join(["Home | About | Contact | Help | More | Even more"] * 3 + [f"word{i} without end" for i in range(40)])
    df = spark.createDataFrame([(1, prose), (2, menu), (3, None)], "doc_id bigint, text string")
    judged = quality.quality(df)
    assert {r.doc_id: r.kept for r in judged.collect()} == {1: True, 2: False, 3: False}
    assert judged.where("kept").count() == 1  # a filter on the verdict
    assert quality.quality(df.limit(0)).count() == 0


def test_line_dedup_against_brute_force(spark):
    rows = []
    for i in range(40):
        host = "big" if i < 30 else None
        rows.append((i, host, f"Header of all\nown line {i}\n\n  own line {i} \nshared by few {i % 8}" if i % 2 else f"own {i}\nHeader of all "))
    rows += [(50, "small", "a\nb"), (51, "small", None), (52, "small", ""), (53, "big", "Header of all"), (53, "big", "Header of all")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, source string, text string, page int")
    got = linededup.line_dedup(df.repartition(4), ratio=0.2, min_pages=3)
    counts, total = Counter(), Counter()
    for h, t in {(h, t or "") for _, h, t in rows}:  # a host's pages of one text are one page
        total[h] += 1
        counts.update({(h, x.strip(" \t\r")) for x in t.split("\n") if x.strip(" \t\r")})
    bad = {k for k, c in counts.items() if c >= 3 and c > 0.2 * total[k[0]]}
    want = Counter()
    for d, h, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if (h, x.strip(" \t\r")) not in bad]
        want[(d, h, "\n".join(stay), len(lines), len(lines) - len(stay))] += 1
    assert Counter((r.doc_id, r.source, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == want
    assert bad and linededup.line_dedup(df.limit(0)).count() == 0
    assert got.where(F.col("page") == 7).count() == len(rows)


def test_copies_alone_make_no_boilerplate(spark):
    rows = [(i, "h", "one text\nof two lines") for i in range(50)] + [(100 + i, "h", f"own {i}\nshared line") for i in range(20)]
    got = linededup.line_dedup(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), ratio=0.5, min_pages=5)
    assert {r.text for r in got.collect()} == {"one text\nof two lines", *(f"own {i}" for i in range(20))}


def test_prose_of_other_scripts_stays(spark):
    lines = ["यह एक वाक्य है।", "هل هذه جملة؟", "یہ ایک جملہ ہے۔", "这是一句话。", "Սա նախադասություն է։", "यह नहीं"]
    df = spark.createDataFrame([("\n".join(lines), 5)], "text string, _cv_t int")
    row = quality.quality(df).first()
    assert row.cleaned_text.split("\n") == lines[:-1] and row._cv_t == 5
