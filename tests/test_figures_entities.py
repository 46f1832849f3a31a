"""Figures, entities, retrieval and the gold set on small rows."""

import json
import math

from pyspark.sql import functions as F

from corvina.functions import text, vocab
from corvina.operators import entities, figures, gates, goldset, images, retrieval


def test_proposal_fields(spark):
    say = lambda x: spark.createDataFrame([(x,)], "x string").select(figures.proposal_fields(F.col("x")).alias("f")).first().f
    f = say('text {"candidate_r": 1.7, "bbox": {"x": 1, "y": 2, "w": 3, "h": 4}, "microbe": "m"} text')
    assert (f.candidate_r, f.effect_type, f.bbox, f.heatmap_bbox, f.subject_node, f.panel_id) == (1.0, "correlation_r", [1, 2, 3, 4], [1, 2, 3, 4], "m", "main")
    f = say('{"candidate_r": null, "proposed_r": 0.4, "effect_type": "hazard_ratio", "bbox": [1, 2, 3], "heatmap_bbox": null}')
    assert f.candidate_r is None and f.bbox is None and f.heatmap_bbox is None  # a key that is there is not looked for under another name
    assert say('{"r": "2.5", "effect_type": "odds_ratio"}').candidate_r == 2.5 and say("no object") is None


def test_verifier_answers(spark):
    say = lambda x: spark.createDataFrame([(x,)], "x string").select(figures.vision_verdict(F.col("x")).alias("v")).first().v
    assert [say(x) for x in ('```json\n{"verdict": "PASS"}\n```', 'so: {"verdict": "fail", "x": {"y": 1}} {', "{", "none", None, '{"verdict": "maybe"}')] == ["pass", "fail", *["inconclusive"] * 4]


def test_gates_come_in_their_order(spark):
    gate = lambda ok, why: F.struct(F.lit(ok).alias("passed"), F.lit(why).alias("reason"))
    one = lambda **g: spark.range(1).select(gates.chain(**g).alias("c")).first().c
    c = one(caption=gate(True, "a"), colorbar_detect=gate(False, "legend_not_found"), range_sanity=gate(False, "out_of_range"))
    assert (c.passed, c.failing_gate, c.reason) == (False, "colorbar_detect", "legend_not_found")


def picture(bar=True):
    import numpy as np

    rgb = np.zeros((120, 160, 3), np.uint8)
    rgb[:, :100] = [180, 40, 75]
    if bar:
        for y in range(120):
            rgb[y, 130:151] = [230 - y * 200 // 119, 40, 25 + y * 200 // 119]
    return 120, 160, 3, rgb[..., ::-1].tobytes()


def test_colour_bars(spark):
    kind = "proposal_id string, candidate_r double, legend_bbox array<int>, heatmap_bbox array<int>, image struct<height:int,width:int,nChannels:int,data:binary>"
    rows = [("bar", 0.5, None, None, picture()), ("given", 0.5, [130, 0, 21, 120], None, picture()), ("none", 0.5, None, None, picture(False)), ("gone", 0.5, None, None, (0, 0, 0, None)), ("bad", 0.5, None, None, (9, 9, 3, b"x"))]
    df = spark.createDataFrame(rows, kind)
    got = {r.proposal_id: r for r in images.colourbar_gate(df.repartition(2)).collect()}
    assert got["bar"].passed and got["bar"].orientation == "vertical" and got["given"].confidence == 1.0
    assert [got[k].reason for k in ("none", "gone")] == ["legend_not_found", "image_missing"] and got["bad"].reason.startswith("detection_error:")
    assert {r.proposal_id: r.reason_code for r in images.verify_images(df).collect()}["bad"] == "runtime_error"


def test_figures_of_papers_without_figures(spark):
    df = spark.createDataFrame([("1", []), ("2", None), ("", [("Heatmap", None, "f")])], "pmid string, figure_metadata array<struct<caption:string,image_path:string,figure_id:string>>")
    rows = figures.figures_of_papers(df).collect()
    assert [(r.figure_id, r.pmid, r.topology) for r in rows] == [("f", None, "heatmap")]


def test_entities_and_prompts(spark):
    papers = spark.createDataFrame([("1", "T", "Obesity alone. It rose. Roseburia and Bacteria rose in obesity patients."), ("", "T", "Roseburia in obesity.")], "pmid string, title string, content string")
    rows = entities.entity_sentences(papers, {"obesity": "DISEASE", "obesity patients": "DISEASE"}, {"Roseburia": "MICROBE", "bacteria": "MICROBE"}).collect()
    assert len(rows) == 1 and [x.text for x in rows[0].diseases] == ["obesity"] and [x.text for x in rows[0].microbes] == ["roseburia"] and rows[0].sentence_index == 2
    p = spark.createDataFrame([("s", "m", "d")], "s string, m string, d string").select(entities.relation_prompt(F.col("s"), F.col("m"), F.col("d")).alias("p")).first().p
    assert p.system.startswith(vocab.RELATION_ROLE) and "between m and d" in p.user
    q = entities.verifier_prompt(spark.createDataFrame([("a", "b", 0.5)], "subject string, feature string, value double")).first().user_prompt
    assert 'row "a", column "b"' in q and "0.5, of a range from -1.0 to 1.0" in q


def test_retrieval(spark):
    docs = retrieval.default_concepts(spark).select("canonical", retrieval.concept_document(F.col("canonical"), F.col("synonyms"), F.lit("Term")).alias("d"))
    assert docs.count() == 9 and docs.where("canonical = 'body_fat'").first().d == "body fat | fat mass | total body fat | body fat percentage | adiposity | Term"
    e = spark.createDataFrame([("fat mass fat",), ("",), ("fat mass fat",), ("bone",)], "t string").select(retrieval.hashed_embedding(F.col("t")).alias("e")).collect()
    assert math.isclose(sum(x * x for x in e[0].e), 1) and not any(e[1].e) and e[0].e == e[2].e != e[3].e
    concepts = spark.createDataFrame([("c", "N", None, 0.5, [1.0, 0.0])], "canonical string, node_type string, cui string, threshold double, embedding array<double>")
    rows = [(1, "P1", "a", [("m",)], [0.9, 0.1]), (2, "P2", "b", [], [1.0, 0.0]), (3, "P3", "c", [("m",)], [0.6, 0.8]), (4, "P4", "d", None, [0.1, 0.9]), (5, "P5", "e", [("m",)], None)]
    s = spark.createDataFrame(rows, "sentence_id bigint, pmid string, sentence string, microbes array<struct<text:string>>, embedding array<double>")
    get = lambda **how: [r.pmid for r in retrieval.candidates(concepts, s, **how).orderBy(F.col("retrieval_similarity").desc()).collect()]
    assert get() == ["P1", "P3"] and get(require_microbe=False) == ["P2", "P1", "P3"]
    assert get(k=1) == [] and get(threshold=0.95, require_microbe=False) == ["P2"]  # the k best come first, then the threshold, then the microbe


def test_gold_strata_are_disjoint(spark):
    accepted = spark.createDataFrame([("P1", "Roseburia", "sarcopenia", "BodyCompositionFeature", "PMID P1: told: so", "f"), ("P2", "E. coli", "vat", "B", "plain", "f")], "pmid string, source_node string, target_node string, target_node_type string, evidence string, source_file string")
    rejected = spark.createDataFrame([("P1", "roseburia ", "sarcopenia", "N", "s", "f"), ("P3", "Roseburia", "vat", "N", "s3", "f")], "pmid string, microbe string, feature_canonical string, feature_node_type string, sentence string, source_file string")
    m = lambda *names: [(n,) for n in names]
    rows = [
        ("P4", "psoas muscle and x", m("Roseburia"), "f", 0), ("P4", "the psoas again", m("roseburia"), "f", 1), ("P5", "liver weight", m("Prevotella", "X"), "f", 2), ("P1", "bone of it", m("Roseburia"), "f", 3),
        ("P6", "nothing", m("Prevotella"), "f", 4), ("P7", "fat", [], "f", 5), ("P8", "", m("A"), "f", 6),
    ]
    s = spark.createDataFrame(rows, "pmid string, sentence string, microbes array<struct<text:string>>, source_file string, ord int")
    got = goldset.build(accepted, rejected, s).collect()
    by = {}
    for r in got:
        by.setdefault(r.stratum, []).append((r.pmid, r.microbe, r.candidate_feature_canonical))
    assert sorted(by["accepted_edge"]) == [("P1", "Roseburia", "sarcopenia"), ("P2", "E. coli", "vat")] and by["gemini_rejected"] == [("P3", "Roseburia", "vat")]
    assert by["vocab_excluded"] == [("P4", "roseburia", "psoas_muscle_area")] and sorted(by["recall_probe"]) == [("P5", "prevotella", None), ("P5", "x", None)]
    assert {x[0] for x in by["random_co_occurrence"]} == {"P1", "P4", "P5"} and {r.sentence for r in got if r.pmid == "P1" and r.stratum == "accepted_edge"} == {"told: so"}
    line = json.loads(goldset.unlabelled_json(goldset.build(accepted, rejected, s)).first().line)
    assert list(line) == [*goldset.ROW, *goldset.SLOTS] and line["label"] is None and line["annotator_notes"] == ""
    assert goldset.build(accepted.limit(0), rejected.limit(0), s.limit(0)).count() == 0


def test_agreement_of_two_passes(spark):
    def pair(one, two):
        of = lambda x: spark.createDataFrame([(str(i), v, 0) for i, v in x.items()], "record_id string, label string, ord int")
        return {r.classes: (r.n, r.kappa) for r in goldset.agreement(of(one), of(two)).collect()}

    a = {1: "associated_positive", 2: "not_associated", 3: "associated_negative"}
    assert pair(a, a) == {"all": (3, 1.0), "binary": (3, 1.0)}
    signs = pair(a, a | {1: "associated_negative"})
    assert signs["binary"][1] == 1.0 > signs["all"][1] and math.isnan(pair(a, {9: "unclear"})["all"][1])
    assert pair({1: "associated_positive", 2: "not_associated"}, {1: "not_associated", 2: "associated_positive"})["binary"][1] < 0


def test_microbe_names_and_captions(spark):
    ask = lambda f, x: spark.createDataFrame([(x,)], "x string").select(f(F.col("x")).alias("v")).first().v
    assert ask(figures.caption_suggests, None) is False and ask(lambda c: figures.caption_suggests(c, vocab.HEATMAP_CAPTIONS), "A Heat Map") is True
    assert ask(text.marker_label, "reduced, protective, higher") == "negative"
