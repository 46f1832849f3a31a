"""Fill-in-middle against plain Python, and what it makes of odd rows."""

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from corvina.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(id, text, seed="42", percent=50, spm=80):
    text = text or ""
    u = UNIT.findall(text)
    assert "".join(u) == text
    hexed = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    h = [int(hexed[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(u), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [
    "tail of blanks \t\n ", " \n\t ", "\x0b\x0c lead", "no\x00nul", "wide　space and hard blanks", "emoji 👩‍👩‍👧 é é 𝔘𝔫", "almost <P or S> or <M", "<P", "P> <S", "a<P>b", "c <M>", "<<S>>",
    "x" * 70_000, "a b " * 9000 + "\n" * 50,
]


def test_every_row_against_plain_python(spark, corpus):
    rows = [(i, t) for i, t, _ in corpus] + [(200 + i, t) for i, t in enumerate(ODD * 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = fim.fill_in_middle(df.select("doc_id", "text", F.col("text").alias("given"))).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter((i, *brute(i, t)) for i, t in rows)
    assert all(r.restored == (r.given or "") for r in got)
    assert {"plain", "psm", "spm"} == {r.form for r in got}


def test_all_arranged_and_only_suffix_first(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in fim.fill_in_middle(df, seed="s", percent=100, spm_percent=100).collect()}
    assert all(got[i].output == brute(i, t, "s", 100, 100)[4] for i, t in rows)
    assert {r.form for r in got.values()} == {"plain", "spm"} and got[0].form == "plain"
    assert all(r.form == "plain" for r in fim.fill_in_middle(df, percent=0).collect())


def test_restores_from_outputs_alone(spark):
    outputs = [("<P>a <S> b<<M> <", "psm", "a  < b<"), ("<S><P><M>", "spm", ""), ("as it was <P>", "plain", "as it was <P>"), ("<S>s<P>p<M>m", "spm", "pms")]
    df = spark.createDataFrame(outputs, "output string, form string, text string")
    assert all(r.text == r.r for r in df.withColumn("r", fim.restored(F.col("output"), F.col("form"))).collect())


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert fim.fill_in_middle(df).count() == 0
    clash = spark.createDataFrame([(1, "one two three", "x", 7, "y")], "doc_id bigint, text string, form string, n int, `a.b` string")
    (row,) = fim.fill_in_middle(clash, percent=100).collect()
    assert row["a.b"] == "y" and row.n == 3 and row.form in ("psm", "spm") and row.restored == "one two three"


def test_plan_stays_in_the_jvm_and_cuts_a_text_once(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    plan = fim.digests(fim.fill_in_middle(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert plan.count("regexp_extract_all") == 1
