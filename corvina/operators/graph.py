"""The property graph: drops with reasons, nodes, export rows, and the canonical traversals.

A graph is one relationships DataFrame with source_node_type, source_node,
target_node_type, target_node and rel_type; nodes are known by (label, name).
Every traversal ends in a total order before its limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, vocab
from .relations import first_by


def apply_drops(rels: DataFrame, listed: DataFrame, policy: DataFrame) -> DataFrame:
    """rels with drop_reason, null for rows that stay.

    listed(source_node, target_node, rel_type, drop_reason) is looked at first,
    then policy(pmcid, source_node, rel_type, reason). The last entry of a key counts in
    listed, the first in policy; both go by ord where they have it, else by reason.
    """
    key = ["source_node", "target_node", "rel_type"]
    order = "ord" if "ord" in listed.columns else "drop_reason"
    a = listed.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.max_by("drop_reason", order).alias("_a"))
    order = "ord" if "ord" in policy.columns else "reason"
    b = policy.groupBy(F.col("pmcid").alias("_p"), F.col("source_node").alias("_s"), F.col("rel_type").alias("_r")).agg(F.min_by("reason", order).alias("_b"))
    out = rels.join(a, (F.col("source_node") == F.col("_source_node")) & (F.col("target_node") == F.col("_target_node")) & (F.col("rel_type") == F.col("_rel_type")),
        "left")
    out = out.join(b, (F.col("pmcid") == F.col("_p")) & (F.col("source_node") == F.col("_s")) & (F.col("rel_type") == F.col("_r")), "left")
    reason = F.coalesce(F.concat(F.lit("umls_gate:"), F.col("_a")), F.col("_b"))
    return out.withColumn("drop_reason", reason).select(*rels.columns, "drop_reason")


def kept(dropped: DataFrame) -> DataFrame:
    return dropped.where("drop_reason IS NULL").drop("drop_reason")


def nodes(rels: DataFrame) -> DataFrame:
    """Distinct (label, name) of both ends, without empty ones."""
    ends = F.inline(F.array(*[F.struct(F.col(f"{e}_node_type").alias("label"), F.col(f"{e}_node").alias("name")) for e in ("source", "target")]))
    return rels.select(ends).where("label <> '' AND name <> ''").distinct()


def count_by_type(rels: DataFrame) -> DataFrame:
    return rels.groupBy("rel_type").agg(F.count("*").alias("n"))


def _some(df: DataFrame, limit: int, *order: Column | str) -> DataFrame:
    rest = [c for c in df.columns if c not in order]
    return df.orderBy(*order, *rest).limit(limit)


def _part(c: Column, needle: str) -> Column:
    return F.contains(F.lower(c), F.lit(needle.lower()))


def _steps(rels: DataFrame, rel_type: str, prefix: str) -> DataFrame:
    """Edges of a type, as f_type, f, and the other end's columns with a prefix: the feature is the join key."""
    r = rels.where(F.col("rel_type") == rel_type)
    return r.select(F.col("source_node_type").alias("f_type"), F.col("source_node").alias("f"), F.col("target_node_type").alias(f"{prefix}_type"),
        F.col("target_node").alias(prefix))


def _correlates(rels: DataFrame) -> DataFrame:
    r = rels.where("rel_type = 'CORRELATES_WITH' AND source_node_type = 'Microbe'")
    return r.select(F.col("source_node").alias("microbe"), F.col("target_node_type").alias("f_type"), F.col("target_node").alias("f"))


def _foremost(starts: DataFrame, limit: int, *ends: DataFrame) -> DataFrame:
    """The edges that the first limit paths in the order of microbes can begin with.

    Every edge whose feature all ends have begins a path at least, so no microbe
    beyond that of the limit-th such edge is needed: the rest is never expanded.
    Edges without ends are left to the caller's join. Only the features of the
    ends are held by a task, not the edges, which are many more.
    """
    begun = starts
    for e in ends:
        begun = begun.join(e.select("f_type", "f").distinct().hint("shuffle_hash"), ["f_type", "f"], "left_semi")
    last = begun.select("microbe").orderBy("microbe").limit(limit).agg(F.max("microbe").alias("_last"))
    return starts.join(F.broadcast(last), F.col("microbe") <= F.col("_last")).drop("_last")  # one row


def three_hop_paths(rels: DataFrame, limit: int = 200) -> DataFrame:
    """Microbe, feature, disease: one row per path, parallel edges give several."""
    d = _steps(rels, "ASSOCIATED_WITH", "disease").where("disease_type = 'Disease'")
    paths = _foremost(_correlates(rels), limit, d).join(d, ["f_type", "f"]).select("microbe", F.col("f_type").alias("feature_type"), F.col("f").alias("feature"),
        "disease")
    return _some(paths, limit, "microbe", "disease")


def features_for_disease(rels: DataFrame, disease: str, limit: int = 200) -> DataFrame:
    d = _steps(rels, "ASSOCIATED_WITH", "disease").where("disease_type = 'Disease'").where(_part(F.col("disease"), disease))
    return _some(d.select(F.col("f_type").alias("node_type"), F.col("f").alias("feature"), "disease"), limit, "feature")


def signed_microbe_disease(rels: DataFrame, limit: int = 200) -> DataFrame:
    r = rels.where("rel_type IN ('POSITIVELY_CORRELATED_WITH', 'NEGATIVELY_CORRELATED_WITH') AND source_node_type = 'Microbe' AND target_node_type = 'Disease'")
    out = r.select(F.col("source_node").alias("microbe"), F.col("rel_type").alias("direction"), F.col("target_node").alias("disease"),
        F.col("confidence").try_cast("double").alias("confidence"))
    return out.orderBy(F.col("confidence").desc_nulls_last(), "microbe", "direction", "disease").limit(limit)


def features_at_location(rels: DataFrame, location: str, limit: int = 200) -> DataFrame:
    at = _steps(rels, "MEASURED_AT", "location").where("location_type = 'BodyLocation'").where(F.lower("location") == location.lower())
    return _some(at.select(F.col("f_type").alias("node_type"), F.col("f").alias("feature"), "location"), limit, "feature")


def full_modality_chain(rels: DataFrame, limit: int = 200) -> DataFrame:
    how = _steps(rels, "ACQUIRED_VIA", "modality").where("modality_type = 'ImagingModality'")
    d = _steps(rels, "ASSOCIATED_WITH", "disease").where("disease_type = 'Disease'")
    chain = _foremost(_correlates(rels), limit, how, d).join(how, ["f_type", "f"]).join(d, ["f_type", "f"])
    return _some(chain.select("microbe", F.col("f").alias("feature"), "modality", "disease"), limit, "microbe")


def vision_verified_edges(rels: DataFrame, limit: int = 200) -> DataFrame:
    r = rels.where("rel_type = 'CORRELATES_WITH' AND source_node_type = 'Microbe'").where(F.col("evidence").contains("Vision proposal"))
    out = r.select(F.col("source_node").alias("microbe"), F.col("target_node").alias("feature"), F.col("confidence").try_cast("double").alias("confidence"), "pmid")
    return out.orderBy(F.col("confidence").desc_nulls_last(), "microbe", "feature", "pmid").limit(limit)


def entity_search(rels: DataFrame, needle: str, limit: int = 50) -> DataFrame:
    return _some(nodes(rels).where(_part(F.col("name"), needle)), limit, "label", "name")


def neighborhood(rels: DataFrame, name: str, limit: int = 100) -> DataFrame:
    """Both directions, one step; a loop is met once."""
    s, t = ("source_node_type", "source_node"), ("target_node_type", "target_node")
    columns = lambda a, b: [F.col(a[0]).alias("src_label"), F.col(a[1]).alias("src"), F.col("rel_type").alias("rel"), F.col(b[0]).alias("nb_label"),
        F.col(b[1]).alias("neighbor")]
    loop = (F.col(s[0]) == F.col(t[0])) & (F.col(s[1]) == F.col(t[1]))
    out = rels.where(F.col(s[1]) == name).select(*columns(s, t))
    back = rels.where((F.col(t[1]) == name) & ~loop).select(*columns(t, s))
    return _some(out.unionByName(back), limit, "rel", "neighbor")


CANONICAL = {
    "three_hop_paths": three_hop_paths,
    "features_for_disease": features_for_disease,
    "signed_microbe_disease": signed_microbe_disease,
    "features_at_location": features_at_location,
    "full_modality_chain": full_modality_chain,
    "vision_verified_edges": vision_verified_edges,
    "entity_search": entity_search,
    "neighborhood": neighborhood,
}


# Explorer records and the same traversals over them, which return edge rows and join on names only.


def records(rels: DataFrame) -> DataFrame:
    """Explorer records of relationship rows."""
    lookup = lambda table, other: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), F.col("rel_type")), other)
    null = lambda c: F.when(F.col(c) != "", F.col(c)) if c in rels.columns else F.lit(None).cast("string")
    s, t = F.col("source_node_type"), F.col("target_node_type")
    s_is, t_is = s.isin(*vocab.FEATURE_NODE_TYPES), t.isin(*vocab.FEATURE_NODE_TYPES)
    family = lambda c: F.when(c == "BodyCompositionFeature", "body_composition").when(c == "RadiomicFeature", "radiomic")
    empty = F.lit(None).cast("string")
    plain = ("pmid", "pmcid", "evidence", "journal", "title", "issn", "microbe_cui", "microbe_official_name", "disease_cui", "disease_official_name")
    made = {c: null(c) for c in plain} | {
        "edge_id": text.stable_id(F.col("source_node"), F.col("rel_type"), F.col("target_node")),
        "subject_node_type": s,
        "subject_node": F.col("source_node"),
        "object_node_type": t,
        "object_node": F.col("target_node"),
        "graph_rel_type": F.col("rel_type"),
        "relation_type": lookup(vocab.RELATION_TYPES, F.col("rel_type")),
        "evidence_type": lookup(vocab.EVIDENCE_TYPES, F.lit("unspecified")),
        "confidence": text.safe_float(F.col("confidence").cast("string")),
        "verification_passed": text.safe_bool(null("verification_passed")),
        "microbe": F.when(s == "Microbe", F.col("source_node")),
        "disease": F.when(t == "Disease", F.col("target_node")).when(s == "Disease", F.col("source_node")),
        "radiomic_feature": F.when(s_is, F.col("source_node")).when(t_is, F.col("target_node")),
        "feature_family": F.when(s_is, family(s)).otherwise(family(t)),
        "publication_year": text.safe_int(null("publication_year")),
        "r_value": F.lit(None).cast("double"),
        "figure_id": empty,
        "claim_hint": empty,
        "assertion_level": F.lit("direct_evidence"),
    }
    return rels.select(*[v.alias(k) for k, v in made.items()])


def _once(edges: DataFrame) -> DataFrame:
    return first_by(edges, ["edge_id"], *[F.col(c) for c in edges.columns if c != "edge_id"])


def record_three_hop(records: DataFrame) -> DataFrame:
    c, a = records.where("graph_rel_type = 'CORRELATES_WITH'"), records.where("graph_rel_type = 'ASSOCIATED_WITH'")
    left = c.join(a.select(F.col("subject_node").alias("_k")).distinct(), F.col("object_node") == F.col("_k"), "left_semi")
    right = a.join(c.select(F.col("object_node").alias("_k")).distinct(), F.col("subject_node") == F.col("_k"), "left_semi")
    return _once(left.unionByName(right))


def record_features_for_disease(records: DataFrame, needle: str = "") -> DataFrame:
    return _once(records.where("graph_rel_type = 'ASSOCIATED_WITH'").where(_part(F.col("object_node"), needle)))


def record_signed(records: DataFrame) -> DataFrame:
    return _once(records.where("graph_rel_type IN ('POSITIVELY_CORRELATED_WITH', 'NEGATIVELY_CORRELATED_WITH')"))


def record_at_location(records: DataFrame, needle: str = "") -> DataFrame:
    return _once(records.where("graph_rel_type = 'MEASURED_AT'").where(_part(F.col("object_node"), needle)))


def record_modality_chain(records: DataFrame) -> DataFrame:
    by = {r: records.where(F.col("graph_rel_type") == r) for r in ("CORRELATES_WITH", "ACQUIRED_VIA", "ASSOCIATED_WITH")}
    ends = {"CORRELATES_WITH": "object_node", "ACQUIRED_VIA": "subject_node", "ASSOCIATED_WITH": "subject_node"}
    shared = None
    for r, df in by.items():
        keys = df.select(F.col(ends[r]).alias("_k")).distinct()
        shared = keys if shared is None else shared.join(keys, "_k", "left_semi")
    out = None
    for r, df in by.items():
        part = df.join(shared, F.col(ends[r]) == F.col("_k"), "left_semi")
        out = part if out is None else out.unionByName(part)
    return _once(out)


def record_vision_verified(records: DataFrame) -> DataFrame:
    return _once(records.where("graph_rel_type = 'CORRELATES_WITH'").where(F.col("evidence").contains("Vision proposal")))


def explorer_filter(records: DataFrame, needle: str = "", limit: int = 200) -> DataFrame:
    """Rows with the needle in subject, disease, phenotype or pmid; the first by a total order."""
    parts = [_part(F.coalesce(c, F.lit("")), needle) for c in ("subject_node", "disease", "radiomic_feature", "pmid")]
    return records.where(parts[0] | parts[1] | parts[2] | parts[3]).orderBy("edge_id", "pmid").limit(limit)


def import_statements(rels: DataFrame) -> DataFrame:
    """(section, line): constraints, nodes and relationships as statements, to be written in the order of both columns."""
    quoted = lambda c: F.concat(F.lit("'"), text.escape_quotes(F.col(c)), F.lit("'"))
    n = nodes(rels)
    one = n.select(F.lit(1).alias("section"), F.format_string("CREATE CONSTRAINT %s_name IF NOT EXISTS FOR (n:%s) REQUIRE n.name IS UNIQUE;", F.lower("label"),
        F.col("label")).alias("line")).distinct()
    two = n.select(F.lit(2).alias("section"), F.concat(F.lit("MERGE (:"), "label", F.lit(" {name: "), quoted("name"), F.lit("});")).alias("line"))
    pmid = F.when(F.coalesce("pmid", F.lit("")) != "", F.concat(F.lit("pmid: "), quoted("pmid")))
    sure = F.when(F.coalesce(F.col("confidence").cast("string"), F.lit("")) != "", F.concat(F.lit("confidence: "), F.col("confidence").cast("string")))
    props = F.concat_ws(", ", pmid, sure)
    props = F.when(props != "", F.concat(F.lit(" {"), props, F.lit("}"))).otherwise("")
    three = rels.select(
        F.lit(3).alias("section"),
        F.concat(
            F.lit("MATCH (s:"), "source_node_type", F.lit(" {name: "), quoted("source_node"), F.lit("}), (t:"), "target_node_type", F.lit(" {name: "),
                quoted("target_node"), F.lit("}) MERGE (s)-[:"), "rel_type", props, F.lit("]->(t);")
        ).alias("line"),
    )
    return one.unionByName(two).unionByName(three)


def backfill_provenance(rels: DataFrame, proposals: DataFrame, papers: DataFrame, audit: DataFrame) -> DataFrame:
    """rels with empty pmid, pmcid, title, journal, figure_id and r_value of figure edges filled from their proposal, paper and audit verdict.

    Only CORRELATES_WITH rows without a pmid are touched, and only empty cells;
    proposals and papers count by their first row, audits by their last
    verdict that is ACCEPT, REVIEW or missing.
    """
    key = F.regexp_extract("evidence", r"Vision proposal ([0-9a-fA-F]{16})", 1)
    open_ = (F.col("rel_type") == "CORRELATES_WITH") & (F.coalesce("pmid", F.lit("")) == "")
    filled = lambda c: F.when(F.trim(c.cast("string")) != "", c)
    p = first_by(proposals, ["proposal_id"], F.col("ord")).select(F.col("proposal_id").alias("_id"), F.col("figure_id").alias("_fig"), F.col("candidate_r").alias("_r"),
        F.col("image_path").alias("_img"), F.col("pmid").alias("_pp"))
    out = rels.withColumn("_key", F.when(open_ & (key != ""), key)).join(p, F.col("_key") == F.col("_id"), "left")
    file = F.regexp_extract(F.coalesce("_img", F.lit("")), r"([^/]*)$", 1)
    pmc = F.coalesce(*[F.when(F.regexp_extract(x, r"^(PMC\d+)", 1) != "", F.regexp_extract(x, r"^(PMC\d+)", 1)) for x in (file, F.coalesce("_fig", F.lit("")),
        F.coalesce("_pp", F.lit("")))])
    from_file = F.regexp_extract(file, r"^(\d{6,9})_", 1)
    number = F.coalesce(F.when(from_file != "", from_file), F.when(F.coalesce("_pp", F.lit("")).rlike(r"^\d{6,9}$"), F.col("_pp")))
    out = out.withColumns({"_pmc": pmc, "_pm": number})
    columns = [F.col("pmid").alias("_a"), F.col("pmcid").alias("_b"), F.col("title").alias("_t"), F.col("journal").alias("_j")]
    by_pmc = first_by(papers.where("pmcid <> ''"), ["pmcid"], F.col("ord")).select(*columns)
    by_pm = first_by(papers.where("pmid <> ''"), ["pmid"], F.col("ord")).select(*[F.col(c).alias(f"{d}2") for c,
        d in (("pmid", "_a"), ("pmcid", "_b"), ("title", "_t"), ("journal", "_j"))])
    out = out.join(by_pmc, F.col("_pmc") == F.col("_b"), "left").join(by_pm, F.col("_pm") == F.col("_a2"), "left")
    good = audit.where(F.col("verdict").isNull() | F.col("verdict").isin("ACCEPT", "REVIEW")).where("pmcid <> ''")
    a = good.groupBy(F.col("pmcid").alias("_ap")).agg(F.max_by(F.struct("figure_id", "r_value"), "ord").alias("_audit"))
    out = out.withColumn("_any", F.coalesce("_pmc", "_b2")).join(a, F.col("_any") == F.col("_ap"), "left")
    touched = F.col("_id").isNotNull()
    fill = lambda c, *more: F.when(touched, F.coalesce(filled(F.col(c)) if c in rels.columns else None,
        *[filled(m) for m in more])) if c not in rels.columns else F.when(touched, F.coalesce(filled(F.col(c)), *[filled(m) for m in more])).otherwise(F.col(c))
    new = lambda *more: F.when(touched, F.coalesce(*more))
    made = {
        "pmid": fill("pmid", F.col("_pm"), F.col("_a"), F.col("_a2")),
        "pmcid": fill("pmcid", F.col("_pmc"), F.col("_b2")),
        "title": fill("title", F.col("_t"), F.col("_t2")),
        "journal": fill("journal", F.col("_j"), F.col("_j2")),
        "figure_id": new(filled(F.col("_audit.figure_id")), filled(F.col("_fig"))),
        "r_value": new(F.col("_audit.r_value"), F.col("_r")),
    }
    rest = [c for c in rels.columns if c not in made]
    return out.select(*rest, *[v.alias(k) for k, v in made.items()])


def retract(rels: DataFrame, figures: list[str], evidence_type: str = "vision_verified") -> DataFrame:
    """rels without the edges of some figures: by figure_id and evidence type where there are such columns, else by the figure in the evidence."""
    if "figure_id" in rels.columns:
        gone = F.col("figure_id").isin(*figures) & (F.col("evidence_type") == evidence_type)
    else:
        gone = text.contains_any(F.lower(F.coalesce("evidence", F.lit(""))), [f.lower() for f in figures])
    return rels.where(~F.coalesce(gone, F.lit(False)))
