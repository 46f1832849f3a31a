"""Queries on relation rows, edge builders, lookups and exports over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import edges, graph, relations
from .figure_queries import _case, _case_sql
from .registry import query, table

def _key():
    return F.col("p_partkey").cast("string")
def _none():
    return F.lit(None).cast("string")
#: What a mention says of its disease, and what becomes of it.
SAID = ["obesity", "the liver cancer patients", "disease", "development of colorectal cancer", "Crohn disease"]
KEPT = ["obesity", "liver cancer", None, None, "crohn disease"]
_D = _case_sql("p_partkey", KEPT)


def _papers(spark, d):
    """Two rows a paper, of which the last counts."""
    p = table(spark, d, "part")
    row = lambda title, ord_: p.select(
        F.col("p_brand").alias("pmid"), title.alias("title"), F.lit("J").alias("journal"), F.concat(F.lit("PMC"), F.col("p_brand")).alias("pmcid"),
            F.lit("").alias("issn"), F.lit("2024").alias("year"),
        F.lit("4.2").alias("impact_factor"), F.lit("2").alias("quartile"), (F.col("p_partkey") + ord_).alias("ord"),
    )
    return row(F.lit("old"), 0).unionByName(row(F.col("p_name"), 10**9))


def _mentions(spark, d):
    """One mention a part: of a feature, with a disease, a subject, a place and a modality."""
    size = F.col("p_size")
    return table(spark, d, "part").select(
        F.concat(F.lit("m"), _key()).alias("mention_id"), F.col("p_brand").alias("pmid"),
            F.when(size % 2 == 0, "glcm_entropy").otherwise("sarcopenia").alias("canonical_feature"), (size / 50).alias("confidence"),
        F.concat(F.lit("told "), _key()).alias("evidence"), _case("p_partkey", SAID).alias("disease"),
            F.when(size % 3 == 0, "predictive").otherwise("").alias("claim_hint"), _none().alias("feature_family"), _none().alias("node_type"),
        _none().alias("subject_node_type"), F.when(size % 4 == 0, "Roseburia levels").when(size % 4 == 1, "dysbiosis").otherwise(" ").alias("subject_node"),
            F.lit(" Liver").alias("body_location"),
        F.when(size % 5 == 0, " ct").otherwise("mri").alias("modality"), F.col("p_partkey").alias("ord"),
    )


_FEATURE = "CASE WHEN p_size % 2 = 0 THEN 'glcm_entropy' ELSE 'sarcopenia' END"
_LAST = "(SELECT p_brand AS b, max_by(p_name, p_partkey) AS title FROM part GROUP BY 1)"


@query(f"""
SELECT substr(sha1('text|' || p_brand || '|' || {_FEATURE} || '|' || {_D} || '|m' || p_partkey), 1, 16) AS edge_id, p_brand AS pmid, {_FEATURE} AS subject_node,
       CASE WHEN p_size % 2 = 0 THEN 'RadiomicFeature' ELSE 'BodyCompositionFeature' END AS subject_node_type, {_D} AS object_node, p_size / 50 AS confidence, l.title,
           2024 AS publication_year, 4.2::DOUBLE AS impact_factor, 'Q2' AS quartile,
       CASE WHEN p_size % 3 = 0 THEN 'predictive' END AS claim_hint
FROM part JOIN {_LAST} l ON p_brand = l.b WHERE p_size >= 30 AND {_D} IS NOT NULL""")
def e1_text_edges(spark, d):
    out = edges.text_edges(_mentions(spark, d), _papers(spark, d))
    return out.select("edge_id", "pmid", "subject_node", "subject_node_type", "object_node", "confidence", "title", "publication_year", "impact_factor", "quartile",
        "claim_hint")


@query(f"""
WITH m AS (SELECT p_brand AS pmid, CASE p_size % 4 WHEN 0 THEN 'roseburia' ELSE 'dysbiosis' END AS subject_node, {_FEATURE} AS phenotype, {_D} AS disease_context,
    p_size / 50 AS c, p_partkey AS ord
           FROM part WHERE p_size >= 30 AND p_size % 4 < 2)
SELECT pmid, subject_node, phenotype, coalesce(disease_context, 'none') AS disease_context, max(c) AS confidence, arg_max('m' || ord, (c, -ord)) AS mention_id
  FROM m GROUP BY ALL""")
def e2_axis_candidates(spark, d):
    out = edges.axis_candidates(_mentions(spark, d))
    return out.select("pmid", "subject_node", "phenotype", F.coalesce("disease_context", F.lit("none")).alias("disease_context"), "confidence", "mention_id")


@query("""
WITH r AS (SELECT p_brand AS pmid, min(p_partkey) AS k FROM part GROUP BY 1)
SELECT r.pmid, substr(sha1('bridge|' || r.pmid || '|roseburia|' || CASE WHEN p_size % 2 = 0 THEN 'glcm_entropy' ELSE 'sarcopenia' END || '|cancer|m' || p_partkey), 1,
    16) AS hypothesis_id, round(greatest(0.4, least(1, p_size / 50 * 0.55 + CASE WHEN r.k % 2 = 0 THEN 0.45 ELSE 0.225 END)), 6)::DOUBLE AS confidence
FROM r JOIN part ON r.pmid = p_brand WHERE p_size >= 30 AND p_partkey % 5 IN (1, 3)""")
def e3_bridges(spark, d):
    one = table(spark, d, "part").groupBy(F.col("p_brand").alias("pmid")).agg(F.min("p_partkey").alias("k"))
    rel = one.select(
        "pmid", F.lit("Roseburia").alias("microbe"), _none().alias("subject_node_type"), _none().alias("subject_node"), F.lit("Cancer").alias("disease"),
            F.when(F.col("k") % 2 == 0, "positive").otherwise("unrelated").alias("final_label"),
        F.lit(True).alias("accepted"), F.lit("e").alias("evidence"),
    )
    return edges.bridge_hypotheses(_mentions(spark, d), rel).select("pmid", "hypothesis_id", F.round("confidence", 6).alias("confidence"))


_SIGNED = """
WITH e AS (SELECT l_suppkey AS s, CASE l_partkey % 5 WHEN 0 THEN 'obesity' WHEN 1 THEN 'liver cancer' WHEN 4 THEN 'crohn disease' END AS o, CASE l_returnflag WHEN 'A'
    THEN 1 WHEN 'R' THEN -1 END AS v, l_discount AS c
  FROM lineitem),
g AS (SELECT s, o, count(*) FILTER (WHERE v > 0) AS p, count(*) FILTER (WHERE v < 0) AS n, avg(c) FILTER (WHERE v > 0) AS cp, avg(c) FILTER (WHERE v < 0) AS cn
  FROM e WHERE o IS NOT NULL AND v IS NOT NULL GROUP BY ALL)
"""


def _relations(spark, d):
    letter = F.chr(F.col("l_suppkey") % 26 + 97)
    name = F.concat(F.lit("Genus"), letter, (F.col("l_suppkey") / 26).cast("int").cast("string"), F.lit(" abundance"))
    label = F.when(F.col("l_returnflag") == "A", "Positive").when(F.col("l_returnflag") == "R", "negative").otherwise("unrelated")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("pmid"), name.alias("microbe"), _none().alias("subject_node_type"), _none().alias("subject_node"),
            _case("l_partkey", SAID).alias("disease"), label.alias("final_label"), F.lit(True).alias("accepted"),
        F.col("l_linestatus").alias("evidence"), F.col("l_discount").alias("confidence"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
    )


@query(_SIGNED + """
SELECT 'genus' || chr((s % 26 + 97)::INT) || (s // 26) AS subject_node, o AS object_node, CASE WHEN p > n THEN 'positive' ELSE 'negative' END AS relation_direction,
    round(CASE WHEN p > n THEN cp ELSE cn END, 3) AS confidence, p AS positive_support, n AS negative_support
FROM g WHERE p <> n""")
def e4_signed_edges(spark, d):
    papers = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("pmid"),
        *[F.lit("").alias(c) for c in ("title", "journal", "pmcid", "issn", "year", "impact_factor", "quartile")], F.lit(0).alias("ord"))
    return edges.signed_edges(_relations(spark, d), papers).select("subject_node", "object_node", "relation_direction", "confidence", "positive_support",
        "negative_support")


@query(_SIGNED + """
SELECT substr(sha1('genus' || chr((s % 26 + 97)::INT) || (s // 26) || '|' || CASE WHEN p > n THEN 'POSITIVELY' ELSE 'NEGATIVELY' END || '_CORRELATED_WITH|' || o), 1, 16)
    AS edge_id, o AS disease,
       CASE WHEN p > n THEN 'MICROBE_DISEASE_POS' ELSE 'MICROBE_DISEASE_NEG' END AS relation_type, 'text_signed_co_mention' AS evidence_type FROM g WHERE p <> n""")
def g11_record_signed(spark, d):
    papers = table(spark, d, "orders").select(F.lit("x").alias("pmid"),
        *[F.lit("").alias(c) for c in ("title", "journal", "pmcid", "issn", "year", "impact_factor", "quartile")], F.lit(0).alias("ord")).limit(1)
    rows = edges.relationship_rows(edges.signed_edges(_relations(spark, d), papers))
    return graph.record_signed(graph.records(rows)).select("edge_id", "disease", "relation_type", "evidence_type")


RESULT = "pass_fail boolean, verified boolean, support_fraction double, reason_code string, distance_metric double"


def _proposals(spark, d):
    size = F.col("p_size")
    nested = F.when(size % 7 == 0, F.struct(F.lit(True).alias("pass_fail"), F.lit(True).alias("verified"), F.lit(0.2).alias("support_fraction"),
        F.lit("nested").alias("reason_code"), F.lit(0.5).alias("distance_metric")))
    return table(spark, d, "part").select(
        _key().alias("proposal_id"), F.col("p_brand").alias("pmid"), F.concat(F.lit("f"), (F.col("p_partkey") % 50).cast("string")).alias("figure_id"),
            (size / 50).alias("candidate_r"), F.lit("Roseburia").alias("microbe"),
        F.when(size % 2 == 0, "glcm_entropy").otherwise(" ").alias("radiomic_feature"), F.lit("obesity").alias("disease"), F.when(size % 3 == 0, "ct").alias("modality"),
            F.lit("a").alias("panel_id"), F.lit("b.png").alias("image_path"),
        nested.alias("verification"), F.col("p_partkey").alias("ord"),
    )


def _results(spark, d):
    p = table(spark, d, "part").where("p_size % 7 <> 0")
    row = lambda good, share, ord_: p.select(
        _key().alias("proposal_id"), good.alias("pass_fail"), good.alias("verified"), share.alias("support_fraction"), F.lit("r").alias("reason_code"),
            F.lit(None).cast("double").alias("distance_metric"), (F.col("p_partkey") + ord_).alias("ord")
    )
    return row(F.lit(False), F.lit(0.0), 0).unionByName(row(F.col("p_size") % 2 == 0, F.col("p_size") / 50, 10**9))


_OK = "(p_size % 7 = 0 OR p_size % 2 = 0)"
_VISION = f"""
v AS (SELECT p_partkey, p_brand AS pmid, 'f' || (p_partkey % 50) AS figure_id, CASE WHEN p_size % 2 = 0 THEN 'glcm_entropy' ELSE 'unknown_imaging_phenotype' END
    AS object_node,
             greatest(0.35, CASE WHEN p_size % 7 = 0 THEN 0.2 ELSE p_size / 50 END)::DOUBLE AS confidence, CASE WHEN p_size % 7 = 0 THEN 'nested' ELSE 'r' END AS reason,
                 p_size / 50 AS r_value
               FROM part WHERE {_OK})
"""


@query(f"""
WITH {_VISION} SELECT pmid, figure_id, object_node, confidence, 'Vision proposal ' || p_partkey || '; reason=' || reason || '; distance_metric=' || CASE reason
    WHEN 'nested' THEN '0.5' ELSE 'None' END AS evidence, r_value
  FROM v""")
def e5_vision_edges(spark, d):
    return edges.vision_edges(_proposals(spark, d), _results(spark, d), _papers(spark, d)).select("pmid", "figure_id", "object_node", "confidence", "evidence", "r_value")


@query(f"""
WITH {_VISION}, a AS (
  SELECT pmid, figure_id, object_node, confidence, 'CORRELATES_WITH' AS graph_rel_type FROM v
  UNION ALL SELECT p_brand, NULL, {_FEATURE} || '>' || {_D}, p_size / 50, 'ASSOCIATED_WITH' FROM part WHERE p_size >= 30 AND {_D} IS NOT NULL)
SELECT pmid, coalesce(figure_id, '') AS figure_id, object_node AS ends, graph_rel_type, max(confidence) AS confidence FROM a GROUP BY ALL""")
def e6_combined_edges(spark, d):
    papers = _papers(spark, d)
    both = edges.combine(edges.text_edges(_mentions(spark, d), papers), edges.vision_edges(_proposals(spark, d), _results(spark, d), papers))
    ends = F.when(F.col("graph_rel_type") == "ASSOCIATED_WITH", F.concat_ws(">", "subject_node", "object_node")).otherwise(F.col("object_node"))
    return both.select("pmid", F.coalesce("figure_id", F.lit("")).alias("figure_id"), ends.alias("ends"), "graph_rel_type", "confidence")


@query("""
WITH p AS (SELECT p_brand AS pmcid, 'f' || (p_partkey % 50) AS figure_id, min(p_partkey) FILTER (WHERE p_size % 7 <> 0 AND p_size % 2 = 0) AS first
  FROM part GROUP BY ALL)
SELECT 'imageref:' || pmcid || ':' || figure_id AS node_id, figure_id, pmcid FROM p WHERE first IS NOT NULL""")
def j7_image_refs(spark, d):
    return edges.image_refs(_proposals(spark, d), _results(spark, d)).select("node_id", "figure_id", "pmcid")


@query("""
WITH p AS (SELECT p_brand AS b, 'f' || (p_partkey % 50) AS f, p_partkey AS k, p_size FROM part), r AS (SELECT b, f, min(k) AS k
  FROM p WHERE p_size % 7 <> 0 AND p_size % 2 = 0 GROUP BY ALL),
l AS (SELECT f, max_by('imageref:' || b || ':' || f, k) AS node FROM r GROUP BY f)
SELECT 'CT' AS source_node, node AS target_node, min_by(p.b, p.k) AS pmid FROM p JOIN l USING (f) WHERE p_size % 3 = 0 GROUP BY node""")
def j8_represented_by(spark, d):
    p = _proposals(spark, d)
    return edges.represented_by(edges.image_refs(p, _results(spark, d)), p).select("source_node", "target_node", "pmid")


@query("""
SELECT 'BodyLocation' AS label, 'liver' AS name, NULL AS dicom_code, 'body_location:liver' AS node_id
  UNION ALL SELECT 'ImagingModality', 'CT', 'CT', 'modality:CT'
  UNION ALL SELECT 'ImagingModality', 'MRI', 'MR', 'modality:MRI'""")
def a8_imaging_nodes(spark, d):
    return edges.imaging_nodes(_mentions(spark, d))


# Relation input.


def _sentences(spark, d):
    """Sentences with two microbes and two diseases each."""
    entity = lambda *names: F.array(*[F.struct(n.alias("text"), F.lit(c).alias("cui")) for n, c in names])
    lit = F.lit
    return table(spark, d, "part").select(
        _key().alias("record_id"), F.col("p_brand").alias("pmid"), F.when(F.col("p_size") % 6 != 0, "a sentence").otherwise(" ").alias("sentence"),
        entity((lit("Roseburia levels"), "C1"), (lit("bacteria"), None)).alias("microbes"),
            entity((lit("obesity cases"), "C2"), (_case("p_partkey", SAID), None)).alias("diseases"),
    )


_CLEAN = _case_sql("p_partkey", ["obesity", "the liver cancer", None, "development of colorectal cancer", "crohn disease"])


@query(f"""
WITH x AS (SELECT p_partkey, p_brand, p_size, m, g FROM part, (VALUES ('roseburia'), (NULL)) a(m), (VALUES (0), (1)) b(g)),
y AS (SELECT *, CASE WHEN g = 0 THEN 'obesity' ELSE {_CLEAN} END AS dis FROM x), f AS (SELECT p_brand AS b, max((p_size >= 30)::INT) AS has FROM part GROUP BY 1)
SELECT p_partkey::VARCHAR AS entity_sentence_id, CASE WHEN p_size % 6 <> 0 AND dis IS NOT NULL THEN m END AS microbe, CASE WHEN p_size % 6 <> 0 AND m IS NOT NULL
    THEN dis END AS disease,
       CASE WHEN p_size % 6 = 0 THEN 'missing_sentence' WHEN m IS NULL THEN 'generic_microbe_term' WHEN dis IS NULL THEN 'generic_disease_term' WHEN p_brand = 'Brand#11'
           THEN 'missing_radiomics_context' END AS reason,
       CASE WHEN p_size % 6 <> 0 AND m IS NOT NULL AND dis IS NOT NULL THEN 'Q2' END AS quartile FROM y""")
def e7_relation_input(spark, d):
    features = _mentions(spark, d).where("pmid <> 'Brand#11'")
    papers = _papers(spark, d).select("pmid", "impact_factor", "quartile", "ord")
    out = relations.relation_input(_sentences(spark, d), papers, features, require_context=True)
    whole = F.col("microbe").isNotNull() & F.col("disease").isNotNull()
    return out.select("entity_sentence_id", "microbe", "disease", "reason", F.when(whole, F.col("quartile")).alias("quartile"))


@query(f"""
WITH x AS (SELECT p_size, p_brand, m, CASE WHEN g = 0 THEN 'obesity' ELSE {_CLEAN} END AS dis FROM part, (VALUES ('roseburia'), (NULL)) a(m), (VALUES (0), (1)) b(g)),
r AS (SELECT CASE WHEN p_size % 6 = 0 THEN 'missing_sentence' WHEN m IS NULL THEN 'generic_microbe_term' WHEN dis IS NULL THEN 'generic_disease_term' END AS reason
  FROM x)
SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def f4_reason_counts(spark, d):
    papers = _papers(spark, d).select("pmid", "impact_factor", "quartile", "ord")
    return relations.reason_counts(relations.relation_input(_sentences(spark, d), papers))


@query("""
SELECT p_brand AS pmid, list_sort(list_distinct(list(CASE WHEN p_size % 2 = 0 THEN 'glcm_entropy' ELSE 'sarcopenia' END))) AS features, p_brand <> 'Brand#11' AS has
  FROM part GROUP BY p_brand""".replace(
    "list_sort(list_distinct(list(CASE WHEN p_size % 2 = 0 THEN 'glcm_entropy' ELSE 'sarcopenia' END))) AS features",
        "min(p_partkey) FILTER (WHERE p_size % 2 = 0) < min(p_partkey) FILTER (WHERE p_size % 2 <> 0) AS entropy_first"
))
def j2_feature_context(spark, d):
    """Features of a paper in the order in which they are first seen."""
    p = table(spark, d, "part").select(F.col("p_brand").alias("pmid")).distinct()
    one = lambda x, c: F.array(F.struct(F.lit(x).alias("text"), F.lit(c).alias("cui")))
    rows = p.select(F.col("pmid").alias("record_id"), "pmid", F.lit("s").alias("sentence"), one("Roseburia", "C").alias("microbes"),
        one("obesity", "C").alias("diseases"))
    papers = _papers(spark, d).select("pmid", "impact_factor", "quartile", "ord")
    features = _mentions(spark, d)
    out = relations.relation_input(rows, papers, features.where("pmid <> 'Brand#11'")).join(relations.relation_input(rows, papers, features).select("pmid",
        F.col("radiomic_features").alias("all")), "pmid")
    return out.select("pmid", (F.get("all", F.lit(0)) == "glcm_entropy").alias("entropy_first"), F.col("has_radiomics_context").alias("has"))


# Lookups on the graph.


def _rows(spark, d):
    """Relationship rows of customers' figures, some with a proposal in their evidence."""
    c = table(spark, d, "customer")
    key = F.col("c_custkey").cast("string")
    id_ = F.lpad(F.hex("c_custkey"), 16, "0")
    made = {
        "source_node_type": F.lit("Microbe"), "source_node": F.col("c_name"), "target_node_type": F.lit("RadiomicFeature"), "target_node": F.col("c_mktsegment"),
        "rel_type": F.when(F.col("c_custkey") % 5 == 0, "ASSOCIATED_WITH").otherwise("CORRELATES_WITH"), "pmid": F.when(F.col("c_custkey") % 3 == 0, key).otherwise(""),
        "evidence": F.concat(F.lit("Vision proposal "), id_, F.lit("; reason=x")), "confidence": F.lit("0.5"),
    }
    return c.select(*[made.get(x, F.lit("")).alias(x) for x in vocab.RELATIONSHIP_COLUMNS], "c_custkey")


@query("""
WITH t AS (SELECT *, c_custkey % 5 <> 0 AND c_custkey % 3 <> 0 AND c_custkey % 2 = 0 AS open FROM customer)
SELECT c_name AS source_node, CASE WHEN open THEN 'pm' || c_custkey WHEN c_custkey % 3 = 0 THEN c_custkey::VARCHAR ELSE '' END AS pmid, CASE WHEN open
    THEN 'PMC' || c_custkey ELSE '' END AS pmcid, CASE WHEN open THEN c_mktsegment ELSE '' END AS title,
       CASE WHEN open THEN CASE WHEN c_custkey % 7 = 0 THEN 'audited' ELSE 'fig' || c_custkey END END AS figure_id FROM t""")
def j10_backfill(spark, d):
    c = table(spark, d, "customer")
    key = F.col("c_custkey").cast("string")
    pmc = F.concat(F.lit("PMC"), key)
    one, zero = F.col("c_custkey").alias("ord"), F.lit(None).cast("double")
    proposals = c.where("c_custkey % 2 = 0").select(F.lpad(F.hex("c_custkey"), 16, "0").alias("proposal_id"), F.concat(F.lit("fig"), key).alias("figure_id"),
        F.lit(0.5).alias("candidate_r"), F.concat(F.lit("x/"), pmc, F.lit("_f.png")).alias("image_path"), F.lit("").alias("pmid"), one)
    papers = c.select(F.concat(F.lit("pm"), key).alias("pmid"), pmc.alias("pmcid"), F.col("c_mktsegment").alias("title"), F.lit("J").alias("journal"), one)
    audit = c.where("c_custkey % 7 = 0").select(pmc.alias("pmcid"), F.lit("audited").alias("figure_id"), zero.alias("r_value"), F.lit("ACCEPT").alias("verdict"), one)
    return graph.backfill_provenance(_rows(spark, d).drop("c_custkey"), proposals, papers, audit).select("source_node", "pmid", "pmcid", "title", "figure_id")


@query("SELECT c_name AS source_node FROM customer WHERE lpad(upper(to_hex(c_custkey)), 16, '0') NOT IN ('0000000000000001', '000000000000000F')")
def f13_retracted(spark, d):
    return graph.retract(_rows(spark, d), ["0000000000000001", "000000000000000f"]).select("source_node")


@query("""
SELECT c_name AS source_node, 'Microbe' AS subject_node_type, 'RadiomicFeature' AS object_node_type, c_mktsegment AS radiomic_feature, c_name AS microbe, NULL::VARCHAR AS disease,
    'radiomic' AS feature_family,
  CASE WHEN c_custkey % 5 = 0 THEN 'text_rule_verified' ELSE 'quantitatively_verified' END AS evidence_type, CASE WHEN c_custkey % 5 = 0 THEN 'TEXT_ASSOCIATION'
      ELSE 'VISION_OR_TEXT_CORRELATION' END AS relation_type,
  'direct_evidence' AS assertion_level, 0.5::DOUBLE AS confidence, CASE WHEN c_custkey % 3 = 0 THEN c_custkey::VARCHAR END AS pmid, NULL::VARCHAR AS journal, NULL::VARCHAR AS title, NULL
      AS issn, NULL::VARCHAR AS pmcid, NULL::VARCHAR AS figure_id, NULL::VARCHAR AS claim_hint, NULL::VARCHAR AS microbe_cui,
  NULL::VARCHAR AS microbe_official_name, NULL::VARCHAR AS disease_cui, NULL::VARCHAR AS disease_official_name FROM customer""")
def t38_record_columns(spark, d):
    r = graph.records(_rows(spark, d))
    columns = (
        "subject_node_type", "object_node_type", "radiomic_feature", "microbe", "disease", "feature_family", "evidence_type", "relation_type", "assertion_level",
            "confidence", "pmid", "journal", "title", "issn", "pmcid", "figure_id",
        "claim_hint", "microbe_cui", "microbe_official_name", "disease_cui", "disease_official_name",
    )
    return r.select(F.col("subject_node").alias("source_node"), *columns)


@query("""
WITH r AS (SELECT c_name AS s, c_mktsegment AS t, CASE WHEN c_custkey % 5 = 0 THEN 'ASSOCIATED_WITH' ELSE 'CORRELATES_WITH' END AS k, CASE WHEN c_custkey % 3 = 0
    THEN '{pmid: ''' || c_custkey || ''', confidence: 0.5}' ELSE '{confidence: 0.5}' END AS p
  FROM customer)
SELECT 1 AS section, 'CREATE CONSTRAINT ' || lower(x) || '_name IF NOT EXISTS FOR (n:' || x || ') REQUIRE n.name IS UNIQUE;' AS line
  FROM (VALUES ('Microbe'), ('RadiomicFeature')) v(x)
UNION ALL SELECT DISTINCT 2, 'MERGE (:Microbe {name: ''' || s || '''});' FROM r UNION ALL SELECT DISTINCT 2, 'MERGE (:RadiomicFeature {name: ''' || t || '''});' FROM r
UNION ALL SELECT 3, 'MATCH (s:Microbe {name: ''' || s || '''}), (t:RadiomicFeature {name: ''' || t || '''}) MERGE (s)-[:' || k || ' ' || p || ']->(t);' FROM r""")
def s17_import_lines(spark, d):
    return graph.import_statements(_rows(spark, d))


@query("""
SELECT c_name AS source_node, 'Microbe' AS source_node_type, c_mktsegment AS target_node, CASE WHEN c_custkey % 2 = 0 THEN 'POSITIVELY_CORRELATED_WITH'
    ELSE 'ASSOCIATED_WITH' END AS rel_type, CASE WHEN c_custkey % 2 = 0 THEN '3' ELSE '' END AS positive_support,
       CASE WHEN c_custkey % 2 = 0 THEN '1,2' ELSE '' END AS supporting_pmids, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'true' END AS verification_passed
         FROM customer""")
def t39_relationship_shapes(spark, d):
    """Both shapes of edges in one table: those of single papers, and signed ones over all papers."""
    c = table(spark, d, "customer")
    ends = [F.lit("Microbe").alias("subject_node_type"), F.col("c_name").alias("subject_node"), F.lit("Disease").alias("object_node_type"),
        F.col("c_mktsegment").alias("object_node")]
    signed = c.where("c_custkey % 2 = 0").select(*ends, F.lit("POSITIVELY_CORRELATED_WITH").alias("graph_rel_type"), F.lit(3).alias("positive_support"),
        F.lit("1,2").alias("supporting_pmids"))
    plain = c.where("c_custkey % 2 <> 0").select(*ends, F.lit("ASSOCIATED_WITH").alias("graph_rel_type"), F.lit(True).alias("verification_passed"))
    both = edges.relationship_rows(signed).unionByName(edges.relationship_rows(plain))
    return both.select("source_node", "source_node_type", "target_node", "rel_type", "positive_support", "supporting_pmids", "verification_passed")
