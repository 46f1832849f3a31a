"""Edges of the evidence graph from mentions, relations and verified figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans, text, vocab
from ..storage import looked_up, scratch, spread
from .containment import containment_pairs
from .relations import first_by, keep_best, last_by, signed_evidence

#: Names that a task cleans, about.
NAMES = 2_000
META = ("journal", "title", "pmcid", "publication_year", "impact_factor", "quartile", "issn")


def _filled(c: Column) -> Column:
    trimmed = F.trim(c.cast("string"))
    return F.when(trimmed != "", trimmed)


def paper_index(papers: DataFrame) -> DataFrame:
    """One row of metadata per pmid, from the last row that has it."""
    last = last_by(papers.where(F.coalesce("pmid", F.lit("")) != ""), ["pmid"])
    year = text.present(F.col("year")).try_cast("int")
    plain = [_filled(F.col(c)).alias(c) for c in ("journal", "title", "pmcid", "issn")]
    return last.select("pmid", *plain, year.alias("publication_year"), text.impact_factor(F.col("impact_factor")).alias("impact_factor"),
        text.quartile(F.col("quartile")).alias("quartile"))


def with_papers(df: DataFrame, papers: DataFrame) -> DataFrame:
    return df.drop(*META).join(paper_index(papers), "pmid", "left")


def journal_metrics(papers: DataFrame, journals: DataFrame) -> DataFrame:
    """impact_factor, quartile and metric_source: the paper's own values, else those of its ISSN in journals(issn, factor, quartile)."""
    known = journals.select(F.col("issn").alias("_i"), text.impact_factor(F.col("factor")).alias("_f"), text.quartile(F.col("quartile")).alias("_q"))
    own_f, own_q = text.impact_factor(F.col("impact_factor")), text.quartile(F.col("quartile"))
    joined = papers.join(first_by(known, ["_i"], F.col("_f").isNull(), -F.col("_f"), F.col("_q")), F.col("issn") == F.col("_i"), "left")
    source = (
        F.when(own_f.isNotNull() | own_q.isNotNull(), "inline")
        .when(F.coalesce(F.col("issn"), F.lit("")) == "", "missing_issn")
        .when(F.col("_i").isNull(), "issn_not_found")
        .otherwise("issn")
    )
    inline = source == "inline"
    f, q = F.when(inline, own_f).otherwise(F.col("_f")), F.when(inline, own_q).otherwise(F.col("_q"))
    return joined.withColumns({"metric_source": source, "impact_factor": f, "quartile": q}).drop("_i", "_f", "_q")


def text_edges(mentions: DataFrame, papers: DataFrame, least: float = 0.6) -> DataFrame:
    """ASSOCIATED_WITH edges from supported mentions to diseases that may be nodes; the others don't appear."""
    good = mentions.where(spans.mention_supported(F.col("confidence"), F.col("canonical_feature"), F.col("evidence"), least))
    named = good.withColumn("_d", spans.clean_text_disease(F.col("disease"))["canonical"]).where(F.col("_d").isNotNull())
    named = named.where(spans.eligible_disease(F.col("_d")))
    feature = F.col("canonical_feature")
    return with_papers(named, papers).select(
        text.stable_id("text", F.col("pmid"), feature, F.col("_d"), F.col("mention_id")).alias("edge_id"),
        "pmid",
        F.coalesce(_filled(F.col("node_type")), text.feature_node_type(feature)).alias("subject_node_type"),
        feature.alias("subject_node"),
        F.lit("Disease").alias("object_node_type"),
        F.col("_d").alias("object_node"),
        F.lit("ASSOCIATED_WITH").alias("graph_rel_type"),
        F.lit(None).cast("double").alias("r_value"),
        F.lit("text_rule_verified").alias("evidence_type"),
        "confidence",
        F.lit(None).cast("string").alias("figure_id"),
        "evidence",
        F.lit(True).alias("verification_passed"),
        F.coalesce(_filled(F.col("feature_family")), text.feature_family(feature)).alias("feature_family"),
        _filled(F.col("claim_hint")).alias("claim_hint"),
        *META,
        "ord",
    )


def axis_candidates(mentions: DataFrame, least: float = 0.6) -> DataFrame:
    """Subject and phenotype pairs for audit; a disease that may be no node is left out, the row stays."""
    good = mentions.where(spans.mention_supported(F.col("confidence"), F.col("canonical_feature"), F.col("evidence"),
        least)).where(_filled(F.col("subject_node")).isNotNull())
    guess = text.subject(F.col("subject_node"), fallback=True)
    given = _filled(F.col("subject_node_type"))
    typed = good.withColumns({"_s": F.when(given.isNotNull(), F.struct(given.alias("type"), F.trim("subject_node").alias("name"))).otherwise(guess)})
    typed = typed.where(F.col("_s.type").isin("Microbe", "MicrobialSignature")).withColumn("_c", spans.clean_subject(F.col("_s.name"), F.col("_s.type"))["canonical"])
    typed = typed.where(F.col("_c").isNotNull()).withColumn("_d", spans.clean_text_disease(F.col("disease"))["canonical"])
    disease = F.when(spans.eligible_disease(F.col("_d")), F.col("_d"))
    feature = F.trim("canonical_feature")
    rows = typed.select(
        "pmid",
        F.col("_s.type").alias("subject_node_type"),
        F.col("_c").alias("subject_node"),
        text.feature_node_type(feature).alias("phenotype_node_type"),
        feature.alias("phenotype"),
        disease.alias("disease_context"),
        "mention_id",
        text.feature_family(feature).alias("feature_family"),
        F.trim("evidence").alias("evidence"),
        "confidence",
        _filled(F.col("claim_hint")).alias("claim_hint"),
        "ord",
    )
    best = keep_best(rows, ["pmid", "subject_node_type", "subject_node", "phenotype_node_type", "phenotype", "disease_context"])
    parts = (F.lit("text-axis"), *map(F.col, ("pmid", "subject_node_type", "subject_node", "phenotype", "disease_context", "mention_id")))
    return best.withColumns({"candidate_id": text.stable_id(*parts), "not_for_graph_ingestion": F.lit(True)})


def disease_match(a: Column, b: Column) -> Column:
    """Equal, or one part of the other; never for an empty one."""
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def bridge_hypotheses(mentions: DataFrame, relations: DataFrame, least: float = 0.6) -> DataFrame:
    """Relations and mentions of one paper whose diseases are equal or part of one another; for audit, never for the graph."""
    good = mentions.where(spans.mention_supported(F.col("confidence"), F.col("canonical_feature"), F.col("evidence"), least)).where("pmid <> ''")
    m = good.select("pmid", "mention_id", F.trim("canonical_feature").alias("phenotype"), F.col("confidence").alias("mc"), F.col("evidence").alias("me"),
        text.normalize(F.col("disease")).alias("md"))
    given = text.normalize(F.col("subject_node"))
    guess = text.subject(text.normalize(F.col("microbe")), fallback=True)
    who = F.when(given != "", F.struct(_filled(F.col("subject_node_type")).alias("type"), given.alias("name"))).otherwise(guess)
    r = relations.where("accepted").where("pmid <> ''").select("pmid", text.normalize(F.col("disease")).alias("disease"), who.alias("s"),
        F.lower("final_label").alias("label"), F.trim(F.coalesce("evidence", F.lit(""))).alias("re"))
    r = r.where((F.col("disease") != "") & F.col("s.type").isNotNull() & F.col("s.name").isNotNull())
    match = containment_pairs(r, m, ["pmid"], "disease", "md")
    both = r.join(match, ["pmid", "disease"]).join(m, ["pmid", "md"])
    label = F.when(F.col("label").isin("positive", "negative"), 1.0).otherwise(0.5)
    return both.select(
        text.stable_id("bridge", F.col("pmid"), F.col("s.name"), F.col("phenotype"), F.col("disease"), F.col("mention_id")).alias("hypothesis_id"),
        "pmid",
        F.col("s.name").alias("microbe_or_signature"),
        F.col("s.type").alias("microbe_or_signature_type"),
        "phenotype",
        text.feature_node_type(F.col("phenotype")).alias("phenotype_node_type"),
        "disease",
        F.array("re", "me").alias("evidence_fragments"),
        F.greatest(F.lit(0.4), F.least(F.lit(1.0), F.col("mc") * 0.55 + label * 0.45)).alias("confidence"),
        F.lit(True).alias("not_for_graph_ingestion"),
    )


def _clean_names(rows: DataFrame, key: str, made: Column, name: str) -> DataFrame:
    """(key, name): the clean form, made, of each different value of key, where there is one.

    A name is cleaned once, however many rows have it. Both tables are written:
    otherwise the optimizer would move the test for null, and with it the
    cleaning, back to the rows.
    """
    different = scratch(rows.select(key).where(F.col(key).isNotNull()).distinct())
    return scratch(spread(different, NAMES).select(key, made.alias(name))).where(F.col(name).isNotNull())


def signed_edges(relations: DataFrame, papers: DataFrame, confidence: float = 0.7) -> DataFrame:
    """Signed microbe-disease edges over all papers, from labelled relations with clean ends."""
    raw = F.coalesce(_filled(F.col("subject_node")), _filled(F.col("microbe")))
    kind = F.coalesce(_filled(F.col("subject_node_type")), F.lit("Microbe"))
    sure = F.col("confidence") if "confidence" in relations.columns else F.lit(None).cast("double")
    labelled = relations.withColumn("label", F.lower("final_label")).where(F.col("label").isin("positive", "negative")).where("pmid <> ''").select(
        F.struct(kind.alias("type"), raw.alias("name")).alias("_s"), F.col("disease").alias("_d"), "label", "pmid",
            F.trim(F.coalesce("evidence", F.lit(""))).alias("evidence"), sure.alias("confidence"), "ord")
    subjects = _clean_names(labelled, "_s", spans.clean_subject(F.col("_s.name"), F.col("_s.type"))["canonical"], "subject_node")
    diseases = _clean_names(labelled, "_d", spans.clean_text_disease(F.col("_d"))["canonical"], "object_node")
    diseases = scratch(diseases.where(spans.eligible_disease(F.col("object_node"))))
    rows = looked_up(looked_up(labelled, diseases, "_d", "ord"), subjects, "_s", "ord").select(F.col("_s.type").alias("subject_node_type"), "subject_node",
        "object_node", "label", "pmid", "evidence", "confidence", "ord")
    net = signed_evidence(rows, ["subject_node_type", "subject_node", "object_node"], confidence)
    parts = (F.lit("microbe-disease"), *map(F.col, ("subject_node_type", "subject_node", "object_node", "relation_direction")))
    return with_papers(net.withColumns({"edge_id": text.stable_id(*parts), "object_node_type": F.lit("Disease"), "evidence_type": F.lit("text_model_verified")}), papers)


def verified_proposals(proposals: DataFrame, results: DataFrame) -> DataFrame:
    """Proposals with v, their verification: the last result of their id, else the one they carry."""
    fields = ("pass_fail", "verified", "support_fraction", "reason_code", "distance_metric")
    last = last_by(results.where("proposal_id <> ''").select("proposal_id", *fields, "ord"), ["proposal_id"]).select("proposal_id", F.struct(*fields).alias("_v"))
    nested = F.struct(*[F.col(f"verification.{f}").alias(f) for f in fields])
    joined = proposals.join(last, "proposal_id", "left")
    return joined.withColumn("v", F.when(F.col("_v").isNotNull(), F.col("_v")).when(F.col("verification").isNotNull(), nested)).drop("_v")


def vision_edges(proposals: DataFrame, results: DataFrame, papers: DataFrame, unverified: bool = False) -> DataFrame:
    """CORRELATES_WITH edges from figure readings that were verified."""
    read = verified_proposals(proposals, results).withColumns({"_ok": F.coalesce("v.pass_fail", "v.verified", F.lit(False)),
        "_s": text.subject(F.col("microbe"), fallback=True)})
    read = read.where((F.col("_ok") | F.lit(unverified)) & F.col("_s.name").isNotNull())
    feature = F.coalesce(_filled(F.col("radiomic_feature")), F.lit("unknown_imaging_phenotype"))
    support = F.coalesce("v.support_fraction", F.lit(0.0))
    told = F.concat(
        F.lit("Vision proposal "), F.coalesce("proposal_id", F.lit("")), F.lit("; reason="), F.coalesce("v.reason_code", F.lit("none")), F.lit("; distance_metric="),
            F.coalesce(F.col("v.distance_metric").cast("string"), F.lit("None"))
    )
    r = F.col("candidate_r")
    none = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return with_papers(read, papers).select(
        text.stable_id("vision", F.col("pmid"), F.col("figure_id"), feature, none(F.col("disease")), none(r)).alias("edge_id"),
        "pmid",
        F.col("_s.type").alias("subject_node_type"),
        F.col("_s.name").alias("subject_node"),
        text.feature_node_type(feature).alias("object_node_type"),
        feature.alias("object_node"),
        F.lit("CORRELATES_WITH").alias("graph_rel_type"),
        r.alias("r_value"),
        F.when(F.col("_ok"), "vision_verified").otherwise("vision_unverified").alias("evidence_type"),
        F.greatest(F.lit(0.35), F.least(F.lit(1.0), F.when(F.col("_ok"), support).otherwise(support * 0.5))).alias("confidence"),
        _filled(F.col("figure_id")).alias("figure_id"),
        told.alias("evidence"),
        F.col("_ok").alias("verification_passed"),
        text.feature_family(feature).alias("feature_family"),
        F.lit(None).cast("string").alias("claim_hint"),
        *META,
        "ord",
    )


def combine(*edges: DataFrame) -> DataFrame:
    """Edges of several kinds, one per paper, ends, type and figure."""
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e, allowMissingColumns=True)
    return keep_best(out, ["pmid", "subject_node_type", "subject_node", "object_node_type", "object_node", "graph_rel_type", "figure_id"])


def imaging_nodes(mentions: DataFrame) -> DataFrame:
    """(node_id, label, name, dicom_code) of body locations, in lower case, and modalities, in upper case."""
    place, how = F.lower(F.trim("body_location")), F.upper(F.trim("modality"))
    codes = F.create_map(*[F.lit(x) for pair in vocab.DICOM_CODES.items() for x in pair])
    places = mentions.select(place.alias("name")).where("name <> ''").distinct().select(F.concat(F.lit("body_location:"), "name").alias("node_id"),
        F.lit("BodyLocation").alias("label"), "name", F.lit(None).cast("string").alias("dicom_code"))
    hows = mentions.select(how.alias("name")).where("name <> ''").distinct().select(F.concat(F.lit("modality:"), "name").alias("node_id"),
        F.lit("ImagingModality").alias("label"), "name", F.coalesce(F.try_element_at(codes, F.col("name")), "name").alias("dicom_code"))
    return places.unionByName(hows)


def backbone(mentions: DataFrame) -> DataFrame:
    """MEASURED_AT and ACQUIRED_VIA rows, one per feature and end, with the first pmid."""
    ends = F.array(
        F.struct(F.lit("BodyLocation").alias("t"), F.lower(F.trim("body_location")).alias("n"), F.lit("MEASURED_AT").alias("r")),
        F.struct(F.lit("ImagingModality").alias("t"), F.upper(F.trim("modality")).alias("n"), F.lit("ACQUIRED_VIA").alias("r")),
    )
    kind = F.coalesce("node_type", F.lit("RadiomicFeature"))
    rows = mentions.select(kind.alias("source_node_type"), F.col("canonical_feature").alias("source_node"), "pmid", "ord", F.explode(ends).alias("e")).where("e.n <> ''")
    keys = ["source_node_type", "source_node", F.col("e.t").alias("target_node_type"), F.col("e.n").alias("target_node"), F.col("e.r").alias("rel_type")]
    return rows.groupBy(*keys).agg(F.min_by("pmid", "ord").alias("pmid"))


def image_refs(proposals: DataFrame, results: DataFrame) -> DataFrame:
    """One row per figure of a verified proposal, from the first such proposal."""
    good = results.where((F.coalesce("verified", F.lit(False)) | F.coalesce("pass_fail", F.lit(False))) & (F.col("proposal_id") != "")).select("proposal_id").distinct()
    mine = proposals.join(good, "proposal_id", "left_semi").where("figure_id <> ''")
    where = F.coalesce(_filled(F.col("pmid")), F.lit(""))
    rows = mine.withColumns({"pmcid": where, "node_id": F.when(where != "",
        F.concat(F.lit("imageref:"), where, F.lit(":"), "figure_id")).otherwise(F.concat(F.lit("imageref:"), "figure_id"))})
    return first_by(rows, ["node_id"], F.col("ord")).select("node_id", "pmcid", "figure_id", "panel_id", "image_path", "modality", "ord")


def represented_by(refs: DataFrame, proposals: DataFrame) -> DataFrame:
    """REPRESENTED_BY rows from modalities to figures."""
    last = last_by(refs.select("figure_id", "node_id", "ord"), ["figure_id"]).select("figure_id", "node_id")
    rows = proposals.join(last, "figure_id").where(_filled(F.col("modality")).isNotNull())
    keys = [F.lit("ImagingModality").alias("source_node_type"), F.upper(F.trim("modality")).alias("source_node"), F.lit("ImageRef").alias("target_node_type"),
        F.col("node_id").alias("target_node"), F.lit("REPRESENTED_BY").alias("rel_type")]
    return rows.groupBy(*keys).agg(F.min_by("pmid", "ord").alias("pmid"))


def relationship_rows(edges: DataFrame) -> DataFrame:
    """Edges in the columns of a relationships table, all as text, missing values empty."""
    named = {"source_node_type": "subject_node_type", "source_node": "subject_node", "target_node_type": "object_node_type", "target_node": "object_node",
        "rel_type": "graph_rel_type"}
    columns = []
    for c in vocab.RELATIONSHIP_COLUMNS:
        source = c if c in edges.columns else named.get(c)
        value = F.col(source).cast("string") if source in edges.columns else F.lit(None).cast("string")
        columns.append(F.coalesce(value, F.lit("")).alias(c))
    return edges.select(*columns)
