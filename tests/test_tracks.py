from corvina.functions import vocab
from corvina.operators import edges
from corvina.plans import tracks


def test_text_track_to_export(spark):
    papers = spark.createDataFrame(
        [("1", "A title", "GLCM entropy on CT of the liver in liver cancer with Fusobacterium nucleatum.", "J", "PMC1", "", "2024", "4", "Q1", None, 0)],
        "pmid string, title string, abstract string, journal string, pmcid string, issn string, year string, impact_factor string, quartile string, full_text_path string, ord int",
    )
    out = tracks.text_track(papers)
    assert out["mentions"].count() == 1 and out["backbone"].count() == 2 and out["axis_candidates"].count() == 1
    rels = edges.relationship_rows(out["edges"]).unionByName(edges.relationship_rows(out["backbone"].withColumnsRenamed({"source_node_type": "subject_node_type", "source_node": "subject_node", "target_node_type": "object_node_type", "target_node": "object_node", "rel_type": "graph_rel_type"})))
    listed = spark.createDataFrame([("glcm_entropy", "liver", "MEASURED_AT", "audit")], "source_node string, target_node string, rel_type string, drop_reason string")
    policy = spark.createDataFrame([], "pmcid string, source_node string, rel_type string, reason string")
    done = tracks.export(rels, listed, policy)
    assert done["dropped"].count() == 1 and done["relationships"].count() + 1 == rels.count() == done["records"].count() + 1
    assert rels.columns == list(vocab.RELATIONSHIP_COLUMNS)


def test_relation_stage(spark):
    rows = spark.createDataFrame(
        [("r1", "1", "Roseburia was increased", "roseburia", "obesity", "Microbe", "roseburia", 4.0, "Q1", None), ("r2", "1", "x", None, None, "Microbe", None, None, None, "missing_disease")],
        "row_id string, pmid string, sentence string, microbe string, disease string, subject_node_type string, subject_node string, impact_factor double, quartile string, reason string",
    )
    out = tracks.relation_stage(rows)
    one = out["aggregated"].first()
    assert (one.final_label, one.accepted) == ("positive", True) and out["rejected"].first().n == 1
    assert out["strength"].first().total_strength_if == 0.602


def test_figure_track(spark):
    figures = spark.createDataFrame([("f1", "Heatmap of Spearman correlation"), ("f2", "A photograph")], "figure_id string, caption string")
    p = spark.createDataFrame([("p1", "f1", 0.4), ("p2", "f1", 1.4), ("p3", "f2", 0.1)], "proposal_id string, figure_id string, candidate_r double")
    out = tracks.figure_track(figures, p)
    assert {r.proposal_id: r.gate.failing_gate for r in out["gated"].collect()} == {"p1": None, "p2": "range_sanity"}
