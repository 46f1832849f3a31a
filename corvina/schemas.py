"""Record types as Spark schemas, and validation of rows against declared rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENTITY = "array<struct<text:string,start:int,end:int,score:double,label:string,extractor:string,cui:string,tui:string,umls_similarity:double,official_name:string>>"
_VERIFICATION = "struct<pass_fail:boolean,verified:boolean,support_fraction:double,reason_code:string,distance_metric:double>"

#: Record type -> DDL.
DDL = {
    "papers": (
        "pmid string, title string, abstract string, query string, retrieval_date string, source string, pmcid string, doi string, "
        "journal string, issn string, year int, language string, impact_factor double, quartile string, full_text_path string"
    ),
    "figures": (
        "figure_id string, pmid string, pmcid string, caption string, image_path string, topology string, topology_confidence double, "
        "heuristic_hits array<string>"
    ),
    "text_mentions": (
        "mention_id string, pmid string, sentence string, span_start int, span_end int, raw_feature string, canonical_feature string, "
        "ibsi_id string, confidence double, mapping_method string, evidence string, feature_family string, node_type string, "
        "ontology_namespace string, modality string, body_location string, disease string, claim_hint string, subject_node_type string, "
        "subject_node string"
    ),
    "entity_sentences": (
        f"record_id string, pmid string, sentence string, sentence_index int, diseases {_ENTITY}, microbes {_ENTITY}, source_text string, "
        "extraction_meta struct<disease_mode:string,microbe_model:string,umls_linker:boolean>, paper_title string"
    ),
    "relation_input": (
        "row_id string, pmid string, sentence string, microbe string, disease string, subject_node_type string, subject_node string, "
        "impact_factor double, quartile string, entity_sentence_id string, disease_cui string, microbe_cui string, "
        "radiomic_features array<string>, has_radiomics_context boolean, source string"
    ),
    "augmented_relations": (
        "row_id string, source_row_id string, kind string, text string, microbe string, disease string, metadata map<string,string>"
    ),
    "relation_predictions": (
        "prediction_id string, pmid string, microbe string, subject_node_type string, subject_node string, disease string, "
        "sentence string, final_label string, accepted boolean, full_consistency boolean, label_entropy double, zero_entropy boolean, "
        "sample_labels array<string>, vote_counts map<string,int>, model_backend string, model_family string, model_id string, "
        "temperatures array<double>, impact_factor string, quartile string"
    ),
    "relation_aggregated": (
        "pmid string, microbe string, disease string, subject_node_type string, subject_node string, final_label string, accepted boolean, "
        "evidence string, sentence_count int, vote_counts map<string,int>, impact_factor string, quartile string"
    ),
    "vision_proposals": (
        "proposal_id string, pmid string, figure_id string, panel_id string, topology string, candidate_r double, effect_type string, "
        "ci_lower double, ci_upper double, p_value double, bbox array<int>, legend_bbox array<int>, heatmap_bbox array<int>, "
        "modality string, status string, backend string, image_path string, microbe string, radiomic_feature string, disease string, "
        f"verification {_VERIFICATION}"
    ),
    "verification_results": (
        "verification_id string, proposal_id string, pmid string, figure_id string, proposed_r double, verified boolean, "
        "pass_fail boolean, reason_code string, observed_range array<double>, distance_metric double, nearest_r double, "
        "support_pixels int, required_support int, support_fraction double, diagnostics variant"
    ),
    "edge_candidates": (
        "edge_id string, pmid string, subject_node_type string, subject_node string, object_node_type string, object_node string, "
        "graph_rel_type string, r_value double, evidence_type string, confidence double, figure_id string, evidence string, "
        "verification_passed boolean, feature_family string, claim_hint string, journal string, title string, pmcid string, "
        "publication_year int, impact_factor double, quartile string, issn string, assertion_level string"
    ),
    "bridge_hypotheses": (
        "hypothesis_id string, pmid string, microbe_or_signature string, microbe_or_signature_type string, phenotype string, "
        "phenotype_node_type string, disease string, evidence_fragments array<string>, bridge_reason string, confidence double, "
        "not_for_graph_ingestion boolean"
    ),
    "axis_candidates": (
        "candidate_id string, mention_id string, pmid string, subject_node_type string, subject_node string, phenotype string, "
        "phenotype_node_type string, feature_family string, disease_context string, evidence string, confidence double, claim_hint string, "
        "not_for_graph_ingestion boolean"
    ),
    "signed_edges": (
        "edge_id string, pmid string, subject_node_type string, subject_node string, object_node_type string, object_node string, "
        "graph_rel_type string, relation_direction string, evidence string, confidence double, positive_support bigint, "
        "negative_support bigint, net_confidence double, supporting_pmids string"
    ),
    "gold_labels": (
        "record_id string, pmid string, stratum string, microbe string, candidate_feature_canonical string, "
        "inferred_feature_canonical string, label string, evidence_type string, quantitative string, confidence string"
    ),
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[name])


def _broken(path: str, test: Callable[[Column], Column]) -> Column:
    """Whether a value at a path breaks a rule; a[].b is looked at in every element of a."""

    def at(value: Column, rest: list[str]) -> Column:
        return F.exists(value, lambda e: at(_inner(e, rest[0]), rest[1:])) if rest else test(value)

    first, *rest = path.split("[].")
    return at(F.col(first), rest)


def _inner(element: Column, path: str) -> Column:
    for name in path.split("."):
        element = element[name]
    return element


def violations(
    rows: DataFrame, key: str, required: Sequence[str] = (), enums: Mapping[str, Sequence[str]] | None = None, ranges: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """One row (record_id, path, rule) per rule that a row breaks: a required value that is null, one outside its list or its range.

    A path is a column, a field a.b, or a field of array elements, a[].b. Rules
    on columns that the rows don't have are broken by every row where the column
    is required, and by none otherwise. All rules are checked in one pass.
    """
    there = lambda path: path.split("[")[0].split(".")[0] in rows.columns
    checks = [(c, "required", _broken(c, lambda x: x.isNull()) if there(c) else F.lit(True)) for c in required]
    checks += [(c, "enum", _broken(c, lambda x, v=v: x.isNotNull() & ~x.isin(*v))) for c, v in (enums or {}).items() if there(c)]
    checks += [(c, "range", _broken(c, lambda x, v=v: ~x.between(*v))) for c, v in (ranges or {}).items() if there(c)]
    if not checks:
        return rows.select(F.col(key).cast("string").alias("record_id"), F.lit("").alias("path"), F.lit("").alias("rule")).limit(0)
    found = F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(c).alias("path"), F.lit(rule).alias("rule"))) for c, rule, bad in checks])
    return rows.select(F.col(key).cast("string").alias("record_id"), F.explode(F.filter(found, lambda x: x.isNotNull())).alias("v")).select("record_id", "v.path", "v.rule")


def unknown_keys(lines: DataFrame, name: str, value: str = "value") -> DataFrame:
    """(value, path) of the keys in JSON lines that a record type doesn't declare."""
    known = F.array(*[F.lit(f.name) for f in schema(name)])
    keys = F.array_except(F.coalesce(F.json_object_keys(value), F.array().cast("array<string>")), known)
    return lines.select(value, F.explode(keys).alias("path"))
