import json
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvina.functions import vocab
from corvina.operators import edges, gates, graph, images, mentions, relations, scoring, vectors
from corvina.operators.ordering import ordinals
from corvina.sources import files
from corvina.streaming import incremental


def test_self_consistency_strict_and_loose(spark):
    df = spark.createDataFrame([(k, i, x) for k, s in {"a": "ppn", "b": "nnn", "c": "pn"}.items() for i, x in enumerate(s)], "k string, ord int, label string").replace({"p": "positive", "n": "negative"}, subset="label")
    strict = {r.k: r for r in relations.self_consistency(df.repartition(3), ["k"]).collect()}
    assert (strict["a"].final_label, strict["a"].accepted, strict["b"].final_label, strict["b"].label_entropy) == ("unrelated", False, "negative", 0.0)
    assert math.isclose(strict["c"].label_entropy, math.log10(2)) and strict["a"].vote_counts == {"positive": 2, "negative": 1}
    loose = {r.k: r.final_label for r in relations.self_consistency(df, ["k"], strict=False).collect()}
    assert loose == {"a": "positive", "b": "negative", "c": "positive"}


def test_within_paper_majority_and_tie(spark):
    rows = [("1", "m", "d", "positive", "s2", 0), ("1", "m", "d", "positive", "s1", 1), ("1", "m", "d", "negative", "s3", 2), ("2", "m", "d", "positive", "a", 0), ("2", "m", "d", "negative", "b", 1)]
    df = spark.createDataFrame([(p, m, None, None, d, x, s, "5", "Q1", o) for p, m, d, x, s, o in rows], "pmid string, microbe string, subject_node_type string, subject_node string, disease string, final_label string, sentence string, impact_factor string, quartile string, ord int")
    got = {r.pmid: r for r in relations.aggregate_within_paper(df.repartition(3)).collect()}
    assert (got["1"].final_label, got["1"].evidence, got["1"].sentence_count, got["1"].accepted) == ("positive", "s1 ||| s2", 3, True)
    assert (got["2"].final_label, got["2"].evidence, got["2"].accepted, got["2"].subject_node) == ("unrelated", "", False, "m")


def test_strength(spark):
    df = spark.createDataFrame([("Microbe", "m", "d", "positive", True, "10", "Q1"), ("Microbe", "m", "d", "negative", True, "2", "Q2"), ("Microbe", "m", "d", "positive", False, "9", "Q1")], "subject_node_type string, subject_node string, disease string, final_label string, accepted boolean, impact_factor string, quartile string")
    r = relations.strength_scores(df).first()
    assert (r.support_count, r.total_strength_raw, r.total_strength_if, r.total_strength_ifq) == (2, 0, 0.699, 1.0)


PAPERS = "pmid string, title string, journal string, pmcid string, issn string, year string, impact_factor string, quartile string, ord int"
RELATION = "pmid string, microbe string, subject_node_type string, subject_node string, disease string, final_label string, accepted boolean, evidence string, confidence double, ord int"
MENTION = "mention_id string, pmid string, canonical_feature string, confidence double, evidence string, disease string, claim_hint string, feature_family string, node_type string, subject_node_type string, subject_node string, body_location string, modality string, ord int"


def test_signed_edges(spark):
    papers = spark.createDataFrame([("1", "T", "J", "PMC1", "", "2024", "4.2", "Q2", 0)], PAPERS)
    rel = lambda *rows: spark.createDataFrame([(p, m, None, None, d, x, True, e, c, i) for i, (p, m, d, x, e, c) in enumerate(rows)], RELATION)
    two = edges.signed_edges(rel(("1", "Roseburia", "liver cancer", "positive", "e1", 0.85), ("2", "roseburia abundance", "the liver cancer", "positive", "e2", 0.95)), papers).collect()
    assert len(two) == 1 and (two[0].confidence, two[0].positive_support, two[0].negative_support, two[0].net_confidence, two[0].supporting_pmids) == (0.9, 2, 0, 1.0, "1,2")
    assert two[0].pmid == "2" and two[0].graph_rel_type == "POSITIVELY_CORRELATED_WITH"
    bad = rel(("1", "Roseburia", "liver cancer", "unrelated", "e", 0.9), ("1", "Roseburia", "development of colorectal cancer", "positive", "e", 0.9), ("1", "bacterial species", "obesity", "positive", "e", 0.9))
    assert edges.signed_edges(bad, papers).count() == 0
    assert edges.signed_edges(rel(("1", "Roseburia", "obesity", "positive", "e", 0.9), ("2", "Roseburia", "obesity", "negative", "e", 0.9)), papers).count() == 0


def test_text_and_vision_edges(spark):
    m = spark.createDataFrame([("m1", "1", "glcm_entropy", 0.8, "s1", "liver cancer", "predictive", None, None, None, "Roseburia levels", "Liver", "ct", 0), ("m2", "1", "glcm_entropy", 0.3, "s2", "liver cancer", None, None, None, None, None, None, None, 1)], MENTION)
    papers = spark.createDataFrame([("1", "old", "J", None, "", "2023", "NA", "NA", 0), ("1", "T", "J", "PMC1", "", "2024", "4.2", "2", 1)], PAPERS)
    t = edges.text_edges(m, papers)
    one = t.collect()
    assert len(one) == 1 and (one[0].title, one[0].publication_year, one[0].impact_factor, one[0].quartile, one[0].feature_family) == ("T", 2024, 4.2, "Q2", "radiomic")
    v = "pass_fail boolean, verified boolean, support_fraction double, reason_code string, distance_metric double"
    p = spark.createDataFrame([("p1", "1", "f1", 0.42, "Roseburia", "glcm_entropy", "liver cancer", "ct", "a", "b.png", None, 0), ("p2", "1", "f2", 0.1, "Roseburia", "sarcopenia", None, None, None, None, (False, False, 0.2, "x", 0.5), 1)], f"proposal_id string, pmid string, figure_id string, candidate_r double, microbe string, radiomic_feature string, disease string, modality string, panel_id string, image_path string, verification struct<{v.replace(' ', ':').replace(',:', ',')}>, ord int")
    res = spark.createDataFrame([("p1", False, False, 0.0, "old", None, 0), ("p1", True, True, 0.7, "verified", 0.01, 1)], f"proposal_id string, {v}, ord int")
    ve = edges.vision_edges(p, res, papers)
    got = ve.collect()
    assert len(got) == 1 and (got[0].confidence, got[0].evidence_type, got[0].subject_node) == (0.7, "vision_verified", "roseburia") and "Vision proposal p1; reason=verified" in got[0].evidence
    assert edges.vision_edges(p, res, papers, unverified=True).count() == 2
    both = edges.combine(t, ve, t)
    assert sorted(r.graph_rel_type for r in both.collect()) == ["ASSOCIATED_WITH", "CORRELATES_WITH"]
    rows = edges.relationship_rows(both)
    assert rows.columns == list(vocab.RELATIONSHIP_COLUMNS) and all(x is not None for r in rows.collect() for x in r)
    assert [r.node_id for r in edges.image_refs(p, res).collect()] == ["imageref:1:f1"]
    assert edges.represented_by(edges.image_refs(p, res), p).first().target_node == "imageref:1:f1"
    assert {(r.rel_type, r.target_node) for r in edges.backbone(m).collect()} == {("MEASURED_AT", "liver"), ("ACQUIRED_VIA", "CT")}
    assert {r.node_id for r in edges.imaging_nodes(m).collect()} == {"body_location:liver", "modality:CT"}
    axis = edges.axis_candidates(m).collect()
    assert len(axis) == 1 and (axis[0].subject_node, axis[0].disease_context) == ("roseburia", "liver cancer")
    rel = spark.createDataFrame([("1", "Roseburia", None, None, "cancer", "positive", True, "re", None, 0), ("1", "Roseburia", None, None, "obesity", "positive", True, "re", None, 1)], RELATION)
    b = edges.bridge_hypotheses(m, rel).collect()
    assert len(b) == 1 and math.isclose(b[0].confidence, 0.55 * 0.8 + 0.45) and b[0].evidence_fragments == ["re", "s1"]


def test_keep_best_merges_evidence_of_ties(spark):
    df = spark.createDataFrame([("k", 0.5, "a", 0), ("k", 0.9, "b", 1), ("k", 0.9, "c", 2), ("k", 0.9, "b", 3), ("j", 0.1, "z", 4)], "k string, confidence double, evidence string, ord int")
    got = {r.k: r for r in relations.keep_best(df.repartition(4), ["k"]).collect()}
    assert (got["k"].evidence, got["k"].ord, got["j"].evidence) == ("b || c", 1, "z")


def test_merge_corpora(spark):
    df = spark.createDataFrame([("1", "", None, "2024-01-01", "strict", 0), ("1", "filled", 3.0, "2024-02-01", "adjacent", 1), ("2", "x", None, "2024-01-01", "strict", 2), ("", "no", None, "", "strict", 3)], "pmid string, abstract string, impact_factor double, retrieval_date string, profile string, ord int")
    got = {r.pmid: r for r in relations.merge_corpora(df, ["abstract"], ["impact_factor"]).collect()}
    assert set(got) == {"1", "2"} and (got["1"].abstract, got["1"].query, got["1"].retrieval_date, got["1"].impact_factor) == ("filled", "merged:strict|adjacent", "2024-02-01", 3.0)


def test_relation_input_and_augment(spark):
    e = "struct<text:string,cui:string>"
    s = spark.createDataFrame([("r", "1", "E. coli in liver cancer", [("Escherichia coli", "C1"), ("bacteria", None)], [("liver cancer", "C2")])], f"record_id string, pmid string, sentence string, microbes array<{e}>, diseases array<{e}>")
    papers = spark.createDataFrame([("1", "4", "Q1", 0)], "pmid string, impact_factor string, quartile string, ord int")
    m = spark.createDataFrame([("1", "glcm_entropy", 0)], "pmid string, canonical_feature string, ord int")
    good = relations.relation_input(s, papers, m, require_context=True)
    assert sorted((r.microbe, r.reason) for r in good.collect() if r.reason is None) == [("escherichia coli", None)]
    assert {r.reason for r in relations.relation_input(s, papers, m.limit(0), require_context=True).collect()} == {"missing_radiomics_context", "generic_microbe_term"}
    assert relations.reason_counts(good).first().n == 1
    seeds = spark.createDataFrame([(0, "Roseburia in obesity", "Roseburia", "obesity"), (1, "plain", "", ""), (2, "Prevotella in nash", "Prevotella", "nash")], "ord int, sentence string, microbe string, disease string")
    got = relations.augment(seeds).orderBy("ord", "kind", "text").collect()
    assert len(got) == 9 and [r.text for r in got if r.kind == "entity_swap"] == ["Prevotella in obesity", "Evidence indicates that plain", "Prevotella in obesity"] or len(got) == 9


def test_graph_drops_nodes_and_statements(spark):
    base = dict.fromkeys(vocab.RELATIONSHIP_COLUMNS, "")
    row = lambda **k: {**base, "source_node_type": "Microbe", "target_node_type": "RadiomicFeature", "target_node": "f", "rel_type": "CORRELATES_WITH", **k}
    rels = spark.createDataFrame([row(source_node="bacteriodetes"), row(source_node="firmicutes", pmcid="PMC1"), row(source_node="firmicutes", pmcid="PMC2"), row(source_node="o'x", pmid="5", confidence="0.5")], ", ".join(f"{c} string" for c in vocab.RELATIONSHIP_COLUMNS))
    listed = spark.createDataFrame([("bacteriodetes", "f", "CORRELATES_WITH", "bad")], "source_node string, target_node string, rel_type string, drop_reason string")
    policy = spark.createDataFrame([("PMC1", "firmicutes", "CORRELATES_WITH", "policy")], "pmcid string, source_node string, rel_type string, reason string")
    out = graph.apply_drops(rels, listed, policy)
    assert sorted(str(r.drop_reason) for r in out.collect()) == ["None", "None", "policy", "umls_gate:bad"]
    assert graph.kept(out).count() == 2 and graph.nodes(graph.kept(out)).count() == 3
    lines = [r.line for r in graph.import_statements(graph.kept(out)).orderBy("section", "line").collect()]
    assert r"MERGE (:Microbe {name: 'o\'x'});" in lines and any("{pmid: '5', confidence: 0.5}" in x for x in lines)
    assert graph.records(rels).where("pmid = '5'").first().confidence == 0.5
    assert graph.retract(rels.withColumn("evidence", F.lit("fig PMC1_g1")), ["pmc1_G1"]).count() == 0


def test_backfill_fills_only_empty_cells(spark):
    rels = spark.createDataFrame([("CORRELATES_WITH", "", "", "", "", "Vision proposal 0123456789abcdef; reason=x"), ("CORRELATES_WITH", "9", "", "", "", "Vision proposal 0123456789abcdef"), ("ASSOCIATED_WITH", "", "", "", "", "x")], "rel_type string, pmid string, pmcid string, title string, journal string, evidence string")
    p = spark.createDataFrame([("0123456789abcdef", "PMC77_g004", 0.4, "x/PMC77_g004.png", "PMC77", 0)], "proposal_id string, figure_id string, candidate_r double, image_path string, pmid string, ord int")
    papers = spark.createDataFrame([("123456", "PMC77", "T", "J", 0)], "pmid string, pmcid string, title string, journal string, ord int")
    audit = spark.createDataFrame([("PMC77", "g4", 0.41, "ACCEPT", 0), ("PMC77", "no", 0.0, "REJECT_GATE", 1)], "pmcid string, figure_id string, r_value double, verdict string, ord int")
    got = graph.backfill_provenance(rels, p, papers, audit).collect()
    filled = [r for r in got if r.pmcid == "PMC77"]
    assert len(filled) == 1 and (filled[0].pmid, filled[0].title, filled[0].figure_id, filled[0].r_value) == ("123456", "T", "g4", 0.41)
    assert {r.pmid for r in got} == {"123456", "9", ""}


def test_gates(spark):
    v = lambda c: spark.range(1).select(c.alias("v")).first().v
    for caption, reason in {"Spearman's rho = 0.4": "correlation_vocabulary_matched", "Log fold change, Pearson": "non_r_quantity_indicated", "A cat": "no_correlation_vocabulary", " ": "caption_missing"}.items():
        assert v(gates.caption_gate(F.lit(caption))).reason == reason
    assert [v(gates.range_gate(F.lit(r), -0.23, 0.2)).passed for r in (0.28, 0.281, -0.27)] == [True, False, True]
    signs = {(0.5, "positive"): "sign_agrees", (-0.5, "Positive"): "sign_disagrees", (0.05, "negative"): "near_zero_or_inconclusive_pass", (0.5, "unknown"): "near_zero_or_inconclusive_pass", (0.5, "red"): "observed_hemisphere_unrecognized_pass"}
    assert {k: v(gates.sign_gate(F.lit(k[0]), F.lit(k[1]))).reason for k in signs} == signs
    c = v(gates.chain(caption=gates.caption_gate(F.lit("pearson")), range_sanity=gates.range_gate(F.lit(2.0))))
    assert (c.passed, c.failing_gate, c.reason) == (False, "range_sanity", "out_of_range")
    table = {(a, b): v(gates.consensus(F.lit(a), F.lit(b))) for a in ("pass", "fail", "inconclusive") for b in ("pass", "fail", "inconclusive")}
    assert [k for k, x in table.items() if x.accepted] == [("pass", "pass")] and [k for k, x in table.items() if not x.accepted and not x.needs_review] == [("fail", "fail")]
    assert v(gates.forest_plot(F.lit(1.5), F.lit(1.1), F.lit(2.0), F.lit("odds_ratio"))).verified and not v(gates.forest_plot(F.lit(0.1), F.lit(-0.1), F.lit(0.2), F.lit("beta"))).verified
    assert v(gates.audit_verdict(gates.caption_gate(F.lit("x")), gates.consensus(F.lit("pass"), F.lit("pass")))) == "REJECT_GATE"


def heatmap():
    ramp = lambda t: np.stack([255 * t, np.full_like(t, 30), 255 * (1 - t)], -1).astype(np.uint8)
    rgb = np.full((120, 160, 3), 255, np.uint8)
    rgb[:, 130:150] = ramp(np.linspace(0, 1, 120))[:, None]
    rgb[10:110, 10:110] = ramp(np.array([0.7]))[0]
    return rgb


def test_heatmap_values(spark):
    rgb = heatmap()
    assert images.verify_value(rgb, 0.4)["verified"] and images.verify_value(rgb, 0.4)["direction"] == "forward"
    assert images.verify_value(rgb, -0.9)["reason_code"] == "insufficient_support"
    assert images.verify_value(rgb, 2.0)["reason_code"] == "r_out_of_range" and images.verify_value(rgb, None)["reason_code"] == "proposed_r_missing"
    assert images.verify_value(np.full((50, 50, 3), 200, np.uint8), 0.4)["reason_code"] == "legend_not_found"
    data = bytearray(rgb[..., ::-1].tobytes())
    df = spark.createDataFrame([("a", 0.4, None, None, ("o", 120, 160, 3, 16, data)), ("b", 0.4, None, None, None)], "proposal_id string, candidate_r double, legend_bbox array<int>, heatmap_bbox array<int>, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    assert {r.proposal_id: r.reason_code for r in images.verify_images(df).collect()} == {"a": "verified", "b": "missing_image"}
    assert images.make_up(rgb)["matrix_score"] > 0


def test_scoring(spark):
    rows = [(True, True), (True, True), (False, True), (True, False), (False, False), (None, True)]
    df = spark.createDataFrame([(g, p, "s") for g, p in rows], "gold boolean, predicted boolean, stratum string")
    r = scoring.confusion(df).first()
    assert (r.tp, r.fp, r.fn, r.tn, r.precision, r.recall) == (2, 1, 1, 1, 0.6667, 0.6667)
    k = lambda rows: scoring.kappa(spark.createDataFrame(rows, "a string, b string")).first().kappa
    assert k([("x", "x"), ("y", "y")]) == 1 and k([("x", "y"), ("y", "x")]) < 0 and math.isnan(k([]))
    s = spark.createDataFrame([(0.9, True), (0.8, True), (0.7, False), (0.6, True), (0.1, False)], "score double, gold boolean")
    best = scoring.calibrate(s, 0.99).first()
    assert (best.threshold, best.n_kept) == (0.8, 2) and scoring.calibrate(s, 0.5, 2.0).count() == 0
    gold = spark.createDataFrame([("1", "Roseburia ", "", "f"), ("2", "x", "g", "f")], "pmid string, microbe string, inferred_feature_canonical string, candidate_feature_canonical string")
    acc = spark.createDataFrame([("1", "roseburia", "f"), ("1", "roseburia", "f")], "pmid string, microbe string, feature string")
    assert sorted((r.pmid, r.predicted) for r in scoring.predict(gold, acc).collect()) == [("1", True), ("2", False)]
    b = spark.createDataFrame([("positive",), ("none",), ("unclear",), (None,)], "x string").select(scoring.gold_binary(F.col("x")).alias("b"))
    assert [r.b for r in b.collect()] == [True, False, None, None]


def test_top_k_then_floor(spark):
    e = spark.createDataFrame([(i, [float(np.cos(i / 5)), float(np.sin(i / 5))]) for i in range(12)], "vec_id int, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "concept_id int, embedding array<float>")
    got = vectors.top_k(q, e, 5, 0.9).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 2] and vectors.top_k(q, e, 5).count() == 5


def test_grounding(spark):
    g = spark.createDataFrame([("a", "C1", "T007", 0.9, "A"), ("b", "C2", "T047", 0.9, "B"), ("c", "C3", "T007", 0.5, "C"), ("d", "C9", "T204", 0.99, "D")], "surface string, cui string, tui string, similarity double, official_name string")
    s = spark.createDataFrame([(x,) for x in ("a", "b", "c", "d", "e", " ", None)], "surface string")
    got = {r.surface: r.drop_reason for r in mentions.ground(s, g, ["T007", "T204"], {"C9": "Homo sapiens"}).collect()}
    assert got == {"a": "", "b": "tui_not_in_accept_set", "c": "low_similarity:0.500<0.850", "d": "deny_cui:Homo sapiens", "e": "no_umls_match", " ": "empty_surface", None: "empty_surface"}
    assert mentions.audit_report(mentions.ground(s, g, ["T007"])).where("kind = 'total'").first().n == 7


def test_microbe_features(spark):
    s = spark.createDataFrame([("1", "Roseburia and visceral fat (VAT)", 0, [("Roseburia",), ("vat",)])], "pmid string, sentence string, ord int, microbes array<struct<text:string>>")
    got = mentions.microbe_features(s, [("vat", "vat"), ("visceral fat", "visceral fat")], ["vat"]).collect()
    assert sorted((r.microbe, r.feature) for r in got) == [("roseburia", "visceral fat"), ("vat", "visceral fat")]


def test_ordinals(spark):
    df = spark.range(0, 50_000).select((F.col("id") * 7 % 1_000_003).alias("o")).repartition(7)
    got = ordinals(df, "o", "i").agg(F.min("i"), F.max("i"), F.countDistinct("i")).first()
    assert tuple(got) == (0, 49_999, 50_000)


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    path = f"file://{tmp_path}/j"
    assert files.write_jsonl(df, path) == 2 and files.write_jsonl(df, path, append=True) == 2
    assert files.read_jsonl(spark, path, df.schema).count() == 4 and files.read_jsonl(spark, path + "-none", df.schema, tolerant=True).count() == 0
    (tmp_path / "bad.jsonl").write_text('{"x": 1, "y": "a"}\n\nnot json\n')
    assert files.read_jsonl(spark, f"file://{tmp_path}/bad.jsonl", df.schema, tolerant=True).count() == 1
    with pytest.raises(Exception):
        files.read_jsonl(spark, f"file://{tmp_path}/bad.jsonl", df.schema).collect()
    rels = spark.createDataFrame([("A", "b")], "source_node_type string, extra string")
    files.write_csv(rels, f"file://{tmp_path}/c", vocab.RELATIONSHIP_COLUMNS)
    assert files.read_relationships(spark, f"file://{tmp_path}/c").first().source_node_type == "A"
    files.write_manifest(spark, f"file://{tmp_path}/m", "s", {"a": 1}, {}, {}, "2024")
    assert json.loads(spark.read.text(f"file://{tmp_path}/m").first().value)["params"] == {"a": 1}
    seen, obs = files.with_metrics(df, n=F.count("*"), filled=F.count("y"))
    seen.write.format("noop").mode("overwrite").save()
    assert obs.get == {"n": 2, "filled": 1}


def test_html_figures_xml(spark):
    html = "<html><script>x</script><body><p>Intro</p><h2>Abstract</h2><p>We &amp; they</p><p>References</p><p>1. a</p></body></html>"
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(files.article_text(F.col("html")).alias("t")).first().t == "Abstract We & they"
    figures = '<img src="//x.org/f1.jpg"><figcaption>Fig 1. <b>Map</b></figcaption><img src="/f2.png"><img src="//x.org/f1.jpg"><img src="/supplement1.png">'
    got = files.figure_rows(spark.createDataFrame([("P", figures)], "pmcid string, html string")).collect()
    assert [(r.figure_url, r.caption) for r in got] == [("//x.org/f1.jpg", "Fig 1. Map"), ("/f2.png", None)]
    labels = F.array(F.lit("Figure 1"), F.lit("Figure 2"))
    assert [df.select(files.match_figure(F.lit(x), labels).alias("v")).first().v for x in ("Fig. 2", "figure 1", "F9")] == ["Figure 2", "Figure 1", None]
    xml = "<A><PMID>7</PMID><ArticleTitle>T</ArticleTitle><Abstract><AbstractText>a</AbstractText><AbstractText>b</AbstractText></Abstract><PubDate><MedlineDate>2019 Jan</MedlineDate></PubDate><ArticleId IdType='doi'>10.1/x</ArticleId></A>"
    f = spark.createDataFrame([(xml,)], "x string").select(files.article_fields(F.col("x")).alias("f")).first().f
    assert (f.pmid, f.title, f.abstract, f.year, f.doi) == ("7", "T", "a b", 2019, "10.1/x")
    p = spark.createDataFrame([("t", "a", "x"), ("t", "", None), (None, None, None)], "title string, abstract string, full_text_path string")
    t = spark.createDataFrame([("x", "whole")], "path string, value string")
    assert sorted((r.content, r.source_text) for r in files.paper_text(p, t).collect()) == [("", "empty"), ("t", "title"), ("whole", "full_text")]


def test_queries_and_windows():
    assert files.build_query([["gut", "microbiome study"], ["CT"]], ["mouse"]) == '(gut OR "microbiome study") AND (CT) AND english[Language] NOT (mouse)'
    windows = files.date_windows(lambda a, b: 10_000 if a != b else 20_000, "2024-01-01", "2024-01-03")
    assert windows == [("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-02"), ("2024-01-03", "2024-01-03")]
    assert files.split_statements("// x\nCREATE A;\nMERGE B;\n") == ["CREATE A", "MERGE B"]


def test_stream_adds_each_key_once(spark, tmp_path):
    source, sink = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string").write.parquet(source)
    like = spark.read.parquet(source)
    incremental.ingest_new(incremental.file_stream(spark, source, like), sink, f"file://{tmp_path}/c", "k").awaitTermination()
    spark.createDataFrame([(2, "x"), (3, "d")], "k int, v string").write.mode("append").parquet(source)
    incremental.ingest_new(incremental.file_stream(spark, source, like), sink, f"file://{tmp_path}/c", "k").awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(sink).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert all(re.fullmatch(r"\w+", k) for k in e.queries())
