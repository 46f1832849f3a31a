"""Queries, downloads, settings."""

import pytest
from pyspark.sql import functions as F

from corvina.functions import vocab
from corvina.operators import graph, relations, scoring
from corvina.sources import harvest
from corvina.streaming import incremental


def test_profiles():
    assert len(vocab.SEARCH_PROFILES) == 12
    q = harvest.profile_query("microbe_bodycomp_clinical_recall")
    assert "(associat*[Title/Abstract])" in q and "review[Publication Type]" in q and q.endswith("AND (english[Language])") and q.count("(") == q.count(")")
    assert "review" not in harvest.profile_query("radiomics_disease", None)


def test_profile_on_a_corpus(spark):
    rows = [("Radiomics on CT", "the gut microbiome", "Journal Article"), ("Radiomics on CT", "the gut microbiome", "Review"), ("Radiomics on factors", "the gut microbiome", None), (None, None, None)]
    df = spark.createDataFrame(rows, "title string, abstract string, kind string")
    got = df.select(harvest.matches_profile("microbe_radiomics_strict", F.col("title"), F.col("abstract"), F.col("kind")).alias("x")).collect()
    assert [r.x for r in got] == [True, False, False, False]  # CT is a word, not a part of factors


def test_calls_are_repeated():
    seen, waits = [], []

    def shaky(x):
        seen.append(x)
        if len(seen) < 3:
            raise OSError
        return x

    assert harvest.with_retries(shaky, wait=waits.append)(7) == 7 and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        harvest.with_retries(lambda: (_ for _ in ()).throw(OSError()), 2, waits.append)()


def test_search_source_reads_windows_and_pages(spark):
    from datetime import date, timedelta

    def days(first, last):
        a, b = date.fromisoformat(first), date.fromisoformat(last)
        return [(a + timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]

    def search(first, last, offset, page):
        ids = [f"{d}#{k}" for d in days(first, last) for k in range(3)]
        return ids[offset : offset + page] + ids[offset : offset + 1]  # a page may repeat an id

    source = harvest.search_source("papers", lambda a, b: 3 * len(days(a, b)), search, lambda ids: [{"pmid": i, "title": f"T {i}"} for i in ids], "pmid string, title string", page=4, chunk=2, cap=10)
    spark.dataSource.register(source)
    df = spark.read.format("papers").option("first", "2024-01-01").option("last", "2024-01-31").load()
    assert df.count() == 93 == df.select("pmid").distinct().count() and df.rdd.getNumPartitions() > 10 and df.first().title.startswith("T 2024")


def test_downloads(spark):
    def fetch(key):
        if key == "PMC3":
            raise OSError
        return f"<p>Text of {key}</p>" if key != "PMC4" else "<p></p>"

    papers = spark.createDataFrame([("PMC1",), (" PMC2 ",), ("PMC3",), ("PMC4",), ("",), (None,)], "pmcid string")
    have = spark.createDataFrame([("PMC1", "old")], "pmcid string, full_text string")
    got = harvest.download_texts(papers, have, fetch)
    assert {r.pmcid: (r.full_text, r.download) for r in got.collect()} == {
        "PMC1": ("old", "reused_existing"), " PMC2 ": ("Text of PMC2", "downloaded"), "PMC3": (None, "failed"), "PMC4": (None, "failed"), "": (None, "missing_pmcid"), None: (None, "missing_pmcid"),
    }
    assert harvest.download_counts(got).first().asDict() == {"total_papers": 6, "with_pmcid": 4, "downloaded": 1, "reused_existing": 1, "missing_pmcid": 2, "failed": 2}
    assert {r.download for r in harvest.download_texts(papers.limit(1), have, fetch, overwrite=True).collect()} == {"downloaded"}
    figs = spark.createDataFrame([("PMC1", "Fig1", "/a.png?x"), ("PMC1", "Fig2", "//c/b.odd"), ("PMC1", "Fig3", "http://bad")], "pmcid string, fig_label string, figure_url string")
    there = spark.createDataFrame([("pmc1_figures/Fig1.png",)], "file string")
    pics = {r.figure_id: (r.file, r.download, r.content) for r in harvest.download_figures(figs, there, lambda u: u.encode() if "bad" not in u else None).collect()}
    assert pics["PMC1_Fig1"][1:] == ("reused_existing", None) and pics["PMC1_Fig2"] == ("pmc1_figures/Fig2.jpg", "downloaded", bytearray(b"https://c/b.odd")) and pics["PMC1_Fig3"][1] == "failed"


def test_settings():
    env = {"RELATION_API_KEY": "r", "OPENAI_BASE_URL": "o", "X_API_KEY": "x"}
    assert harvest.api_settings("plain", None, None, env) == ("o", "r") and harvest.api_settings("plain", "cli", "k", env) == ("cli", "k")
    assert harvest.api_settings("xm-1:v", None, None, env, {"xm-": ("X", "default")}) == ("default", "x") and harvest.api_settings(None, None, None, {}) == (None, None)


def test_evidence_without_joined_strings(spark):
    rows = spark.createDataFrame([("k", "positive", "1", "a", 0.5, 0), ("k", "positive", "1", "a", 0.7, 1), ("k", "negative", "2", "b", 0.5, 2), ("k", "unrelated", "3", "c", 0.5, 3)], "k string, label string, pmid string, evidence string, confidence double, ord int")
    net = relations.signed_evidence(rows, ["k"], joined=False).first()
    assert (net.positive_support, net.negative_support) == (2, 1) and "evidence" not in net
    assert sorted((r.label, r.pmid) for r in relations.supporting(rows, ["k"]).collect()) == [("negative", "2"), ("positive", "1")]


def test_first_rows_and_thresholds(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", None, "y"), ("b", 0, "z")], "k string, o int, v string")
    assert sorted(map(tuple, relations.first_by(df, ["k"], F.col("o")).collect())) == [("a", 1, "x"), ("b", None, "y")]
    s = spark.createDataFrame([(0.12344, True), (0.12346, False), (0.5, True), (None, True), (-0.3, False)], "score double, gold boolean")
    got = {r.threshold: (r.n_kept, round(r.precision, 4)) for r in scoring.calibrate(s, 0.0).collect()}
    assert got == {0.5: (1, 1.0), 0.1235: (1, 1.0), 0.1234: (3, 0.6667), -0.3: (4, 0.5)}  # a score can miss its own rounding


def test_late_rows_are_left_out_of_closed_windows(spark, tmp_path):
    like = spark.createDataFrame([("2024-01-01 00:00:00", "a")], "ts string, k string").select(F.to_timestamp("ts").alias("ts"), "k")
    put = lambda *rows: spark.createDataFrame(list(rows), "ts string, k string").select(F.to_timestamp("ts").alias("ts"), "k").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    put(("2024-01-01 00:10:00", "a"), ("2024-01-01 00:20:00", "a"))

    def run():
        stream = incremental.file_stream(spark, f"{tmp_path}/in", like, 1)
        q = incremental.windowed_counts(stream, "ts", "1 hour", "10 minutes", "k").writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/c")
        q.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()

    run()
    put(("2024-01-01 03:00:00", "a"))
    run()
    put(("2024-01-01 00:30:00", "a"), ("2024-01-01 03:30:00", "a"), ("2024-01-01 09:00:00", "a"))
    run()
    put(("2024-01-01 20:00:00", "a"))
    run()
    got = {(r.window.start.hour, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert (0, 2) in got and (3, 2) in got and not any(h == 0 and n > 2 for h, n in got)


def test_explorer_filter_and_nodes_keep_nulls_apart(spark):
    rels = spark.createDataFrame([("A", "", "B", "x", "R")], "source_node_type string, source_node string, target_node_type string, target_node string, rel_type string")
    assert [r.name for r in graph.nodes(rels).collect()] == ["x"]
