"""Compositions of operators: from papers to edges, from figures to verdicts, from edges to an export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import edges, gates, graph, mentions, relations
from ..sources import files


def ordered(df: DataFrame, *by: str) -> DataFrame:
    """df with ord, a number from a hash of some columns: a total order that is the same in every run."""
    return df.withColumn("ord", F.xxhash64(*by))


def text_track(papers: DataFrame, texts: DataFrame | None = None, least: float = 0.6) -> dict[str, DataFrame]:
    """Mentions of papers, their edges to diseases, the backbone of places and modalities, and candidates for audit."""
    found = ordered(mentions.extract_mentions(files.paper_text(papers, texts)), "mention_id")
    return {
        "mentions": found,
        "edges": edges.text_edges(found, papers, least),
        "backbone": edges.backbone(found),
        "nodes": edges.imaging_nodes(found),
        "axis_candidates": edges.axis_candidates(found, least),
    }


def relation_stage(rows: DataFrame, labels: Sequence[Column] | None = None, strict: bool = True) -> dict[str, DataFrame]:
    """Relation input rows to predictions, within-paper votes and strength scores.

    labels are the answers of repeated calls of a labeller; offline, the marker
    label stands for each of them. Rows with a reason are left out and counted.
    """
    good = rows.where("reason IS NULL").drop("reason")
    answers = list(labels) if labels is not None else [text.marker_label(F.col("sentence"))] * len(text.temperatures())
    samples = good.select("row_id", F.posexplode(F.array(*answers)).alias("ord", "label"))
    voted = relations.self_consistency(samples, ["row_id"], strict=strict)
    predictions = ordered(good.join(voted, "row_id"), "row_id")
    aggregated = relations.aggregate_within_paper(predictions)
    return {"predictions": predictions, "rejected": relations.reason_counts(rows), "aggregated": aggregated, "strength": relations.strength_scores(aggregated)}


def figure_track(figures: DataFrame, proposals: DataFrame, topologies: Sequence[str] = ("heatmap", "scatter_plot", "dot_plot", "forest_plot"), least: float = 0.2) -> dict[str, DataFrame]:
    """Figures of a topology, and the gate verdicts of their proposals; cheap gates come first."""
    shaped = figures.withColumn("t", text.topology(F.col("caption"))).where(F.col("t.topology").isin(*topologies) & (F.col("t.confidence") >= least))
    captions = shaped.select("figure_id", "caption").distinct()
    gated = proposals.join(captions, "figure_id").withColumn("gate", gates.chain(caption=gates.caption_gate(F.col("caption")), range_sanity=gates.range_gate(F.col("candidate_r"))))
    return {"figures": shaped.select("*", "t.*").drop("t"), "gated": gated, "failing": gated.groupBy("gate.failing_gate").agg(F.count("*").alias("n"))}


def export(rels: DataFrame, listed: DataFrame, policy: DataFrame) -> dict[str, DataFrame]:
    """Kept relationships, dropped ones with their reasons, nodes, counts by type, import statements and explorer records."""
    judged = graph.apply_drops(rels, listed, policy)
    kept = graph.kept(judged)
    return {
        "relationships": kept,
        "dropped": judged.where("drop_reason IS NOT NULL"),
        "nodes": graph.nodes(kept),
        "counts": graph.count_by_type(kept),
        "statements": graph.import_statements(kept),
        "records": graph.records(kept),
    }
