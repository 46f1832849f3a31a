"""Queries on figures, proposals, gates, entities and the gold set over the driver's tables, each with its SQL.

Parts stand in for papers and figures; what a figure or a reader says is made
from a part's columns, in the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import spans, text, vocab
from ..operators import entities, figures, gates, goldset, retrieval, vectors
from ..sources import files, harvest
from ..storage import dealt_join, tasks_for
from .registry import query, table

def _key():
    return F.col("p_partkey").cast("string")


def _case(column: str, values: list[str | None]) -> Column:
    """A value by the remainder of a column."""
    rest = F.col(column) % len(values)
    return text.first_of([(rest == i, v) for i, v in enumerate(values)], F.lit(None).cast("string"))


def _case_sql(column: str, values: list[str | None]) -> str:
    quoted = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"CASE {column} % {len(values)} " + " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values)) + " END"


def _topology_sql(caption: str) -> str:
    low = f"lower({caption})"
    hits = lambda words: " + ".join(f"contains({low}, '{w}')::INT" for w in words)
    scores = {t: f"least(1, {vocab.TOPOLOGY_WEIGHTS[t]} * ({hits(w)}))" for t, w in vocab.TOPOLOGY_KEYWORDS.items()}
    best = f"greatest({', '.join(scores.values())})"
    return f"CASE WHEN {best} = 0 THEN 'unknown' " + " ".join(f"WHEN {best} = {s} THEN '{t}'" for t, s in scores.items()) + " END"


CAPTIONS = ["Spearman heatmap of ", "Forest plot of odds ratio for ", "Scatter plot, ", "", "Lollipop of ", "A picture of "]


@query(f"""
WITH f AS (
  SELECT p_partkey::VARCHAR AS pmid, 'i' || p_partkey AS image_path, {_case_sql('p_size', CAPTIONS)} || p_name AS caption,
         CASE WHEN p_partkey % 2 = 0 THEN 'f' || p_partkey ELSE '' END AS id FROM part
  UNION ALL SELECT p_partkey::VARCHAR, NULL, '', NULL FROM part WHERE p_partkey % 3 = 0)
SELECT coalesce(nullif(id, ''), substr(sha1(pmid || '|' || caption || '|' || coalesce(image_path, 'na')), 1, 16)) AS figure_id, pmid, image_path, caption,
       {_topology_sql('caption')} AS topology, 'paper_metadata' AS source_context FROM f""")
def s21_figures_of_papers(spark, d):
    one = F.struct(F.concat(_case("p_size", CAPTIONS), "p_name").alias("caption"), F.concat(F.lit("i"), _key()).alias("image_path"),
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("f"), _key())).otherwise("").alias("figure_id"))
    none = F.lit(None).cast("string")
    two = F.struct(none.alias("caption"), none.alias("image_path"), none.alias("figure_id"))
    papers = table(spark, d, "part").select(_key().alias("pmid"), F.when(F.col("p_partkey") % 3 == 0, F.array(one, two)).otherwise(F.array(one)).alias("figure_metadata"))
    return figures.figures_of_papers(papers).drop("topology_confidence", "heuristic_hits")


@query(f"""
SELECT p_partkey, {' OR '.join(f"contains(lower(c), '{w}')" for w in vocab.QUALIFYING_CAPTIONS)} AS qualifying,
       {' OR '.join(f"contains(lower(c), '{w}')" for w in vocab.HEATMAP_CAPTIONS)} AS heatmap
FROM (SELECT p_partkey, {_case_sql('p_size', CAPTIONS)} || p_type AS c FROM part)""")
def f5_caption_filters(spark, d):
    caption = F.concat(_case("p_size", CAPTIONS), "p_type")
    return table(spark, d, "part").select("p_partkey", figures.caption_suggests(caption).alias("qualifying"),
        figures.caption_suggests(caption, vocab.HEATMAP_CAPTIONS).alias("heatmap"))


@query("""
SELECT p_partkey::VARCHAR AS figure_id, p_size % 6 NOT IN (0, 3) AS relevant,
       CASE p_size % 6 WHEN 0 THEN 'no_image' WHEN 1 THEN 'gate_error:no_answer' WHEN 2 THEN 'yes, it does show on' WHEN 3 THEN 'no.' WHEN 4 THEN 'gate_error:timeout'
           ELSE 'yes' END AS relevance_reason
FROM part""")
def f8_relevance_gate(spark, d):
    p = table(spark, d, "part")
    rows = p.select(_key().alias("figure_id"), F.when(F.col("p_size") % 6 != 0, "a.png").alias("image_path"))
    answers = p.where("p_size % 6 <> 1").select(
        _key().alias("figure_id"), _case("p_size", ["yes", None, "Yes, it does show one of them", "No.", None, " YES "]).alias("answer"),
            F.when(F.col("p_size") % 6 == 4, "timeout").alias("error")
    )
    return figures.relevance(rows, answers).drop("image_path")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def f12_allow_list(spark, d):
    listed = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return figures.allowed(table(spark, d, "orders").select("o_orderkey", "o_custkey"), listed, "o_custkey")


@query("""
WITH f AS (SELECT p_brand AS figure_id, max_by('i' || p_partkey, p_partkey) AS image FROM part WHERE p_size % 4 <> 0 AND p_brand <> 'Brand#11' GROUP BY 1)
SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 0 THEN 'own' || p_partkey END, f.image) AS image_path FROM part LEFT JOIN f ON p_brand = f.figure_id""")
def j6_figure_images(spark, d):
    p = table(spark, d, "part")
    rows = p.where("p_brand <> 'Brand#11'").select(F.col("p_brand").alias("figure_id"),
        F.when(F.col("p_size") % 4 != 0, F.concat(F.lit("i"), _key())).otherwise(" ").alias("image_path"), F.col("p_partkey").alias("ord"))
    own = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("own"), _key())).otherwise("")
    return figures.with_images(p.select("p_partkey", F.col("p_brand").alias("figure_id"), own.alias("image_path")), rows).select("p_partkey", "image_path")


@query("""
WITH p AS (SELECT p_brand AS f, max_by(p_retailprice / 3000, p_partkey) AS r, max_by(p_name, p_partkey) AS m, max_by(p_type, p_partkey) AS t FROM part GROUP BY 1),
v AS (SELECT CASE WHEN p_brand = 'Brand#11' THEN 'Brand#12' ELSE p_brand END AS f, * FROM part WHERE p_size % 3 = 0 OR p_size % 5 = 0)
SELECT v.f AS figure_id, round(coalesce(CASE WHEN p_size % 2 = 0 THEN p_size / 50 END, p.r), 6) AS candidate_r, coalesce(CASE WHEN p_size % 7 = 0 THEN p_name END, p.m)
    AS microbe, coalesce(p.t, 'x') AS radiomic_feature
FROM v LEFT JOIN p ON v.f = p.f WHERE v.f NOT LIKE '%3'""")
def j14_historical(spark, d):
    p = table(spark, d, "part")
    proposals = p.select(
        F.col("p_brand").alias("figure_id"), (F.col("p_retailprice") / 3000).alias("candidate_r"), F.col("p_name").alias("microbe"),
            F.col("p_type").alias("radiomic_feature"), F.lit("heatmap").alias("topology"), F.col("p_partkey").alias("ord")
    )
    v = p.select(
        F.col("p_brand").alias("figure_id"), (F.col("p_size") % 3 == 0).alias("verified"), F.when(F.col("p_size") % 5 == 0, True).alias("verification_passed"),
            F.when(F.col("p_size") % 2 == 0, F.col("p_size") / 50).alias("proposed_r"),
        F.lit(None).cast("double").alias("r_value"), F.when(F.col("p_size") % 7 == 0, F.col("p_name")).otherwise("").alias("subject_node"),
            F.lit(None).cast("string").alias("object_node"),
    )
    current = p.where("p_brand LIKE '%3'").select(F.col("p_brand").alias("figure_id"))
    out = figures.historical(v, proposals, current, {"Brand#11": "Brand#12"})
    return out.select("figure_id", F.round("candidate_r", 6).alias("candidate_r"), "microbe", F.coalesce("radiomic_feature", F.lit("x")).alias("radiomic_feature"))


@query("""
WITH c AS (SELECT p_brand AS f, max_by(trim(p_type), p_partkey) AS caption FROM part WHERE p_size > 40 GROUP BY 1)
SELECT p_partkey, coalesce(c.caption, '') AS caption FROM part LEFT JOIN c ON p_brand = c.f""")
def j15_captions(spark, d):
    p = table(spark, d, "part")
    rows = p.where("p_size > 40").select(F.concat(F.lit(" "), "p_brand").alias("figure_id"), F.concat(F.lit(" "), "p_type").alias("caption"),
        F.col("p_partkey").alias("ord"))
    return figures.with_captions(p.select("p_partkey", F.col("p_brand").alias("figure_id")), rows).select("p_partkey", "caption")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_size % 2 = 0 THEN 'a/' || p_partkey WHEN p_partkey % 5 = 0 THEN 'd/PMC' || p_partkey || '_Fig1.png'
    WHEN p_partkey % 7 = 0 THEN 'd/PMC' || p_partkey || '_Fig1.jpg' END AS resolved_path,
       CASE WHEN p_partkey % 5 = 0 THEN 'd/PMC' || p_partkey || '_Fig1.png' END AS file FROM part""")
def s23_image_paths(spark, d):
    p = table(spark, d, "part")
    made = lambda *parts: F.concat(*[F.lit(x) if x != "k" else _key() for x in parts]).alias("path")
    listed = p.where("p_partkey % 3 = 0").select(made("a/", "k")).unionByName(p.where("p_partkey % 5 = 0").select(made("d/PMC", "k", "_Fig1.png")))
    listed = listed.unionByName(p.where("p_partkey % 7 = 0").select(made("d/PMC", "k", "_Fig1.jpg")))
    rows = p.select(
        "p_partkey", F.when(F.col("p_size") % 2 == 0, made("a/", "k")).otherwise("").alias("image_path"), F.concat(F.lit("PMC"), _key()).alias("pmcid"),
            F.lit("Fig1").alias("figure_id")
    )
    one = figures.resolved_images(rows, listed, "d/").select("p_partkey", "resolved_path")
    two = figures.figure_files(p.select("p_partkey", made("PMC", "k", "_Fig1").alias("figure_id")), listed, "d/", ("png",))
    return dealt_join(one, two.select(F.col("p_partkey").alias("_k"), F.col("resolved_path").alias("file")), "p_partkey", "_k", tasks_for(p)).drop("_k")


# Proposals.

NAMES = ["candidate_r", "proposed_r", "r_value", "r"]
EFFECTS = ["correlation_r", "odds_ratio", ""]


@query(f"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN {_case_sql('l_partkey', EFFECTS)} <> 'odds_ratio' THEN greatest(-1, least(1,
    l_quantity / 20 - 0.5)) ELSE l_quantity / 20 - 0.5 END::DOUBLE AS candidate_r,
       coalesce(nullif({_case_sql('l_partkey', EFFECTS)}, ''), 'correlation_r') AS effect_type, CASE WHEN l_linestatus = 'F' THEN 'main' ELSE 'B' END AS panel_id,
       CASE WHEN l_returnflag = 'R' THEN '1,2,3,' || l_linenumber WHEN l_returnflag = 'A' THEN '9,8,7,' || l_linenumber END AS bbox, 'm' || l_suppkey AS subject_node,
           l_discount AS p_value
FROM lineitem""")
def t28_proposal_fields(spark, d):
    li = table(spark, d, "lineitem")
    s = lambda c: F.col(c).cast("string")
    r = F.when(F.col("l_linenumber") % 5 == 0, "null").otherwise((F.col("l_quantity") / 20 - 0.5).cast("string"))
    place = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("[1, 2, 3.7, "), s("l_linenumber"), F.lit("]"))).when(F.col("l_returnflag") == "A",
        F.concat(F.lit('{"x": 9, "y": 8, "w": 7, "h": '), s("l_linenumber"), F.lit("}"))).otherwise("[1, 2]")
    answer = F.concat(
        F.lit('Here it is: {"'), _case("l_linenumber", NAMES), F.lit('": '), r, F.lit(', "effect_type": "'), _case("l_partkey", EFFECTS), F.lit('", "panel_id": "'),
            F.when(F.col("l_linestatus") == "F", "").otherwise("B"),
        F.lit('", "bbox": '), place, F.lit(', "microbe": "m'), s("l_suppkey"), F.lit('", "p_value": "'), s("l_discount"), F.lit('"} and more'),
    )
    f = li.select("l_orderkey", "l_linenumber", figures.proposal_fields(answer).alias("f"))
    return f.select("l_orderkey", "l_linenumber", "f.candidate_r", "f.effect_type", "f.panel_id", F.array_join(F.col("f.bbox").cast("array<string>"), ",").alias("bbox"),
        "f.subject_node", "f.p_value")


@query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_brand END AS subject, p_type AS feature, coalesce(CASE WHEN p_size % 3 = 0 THEN p_size / 50 END,
    0.5)::DOUBLE AS value,
       CASE WHEN p_size % 4 = 0 THEN 'heatmap' ELSE 'scatter_plot' END AS topology FROM part""")
def t40_verifier_fields(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("").alias("microbe"), F.col("p_brand").alias("subject_node"),
            F.col("p_type").alias("radiomic_feature"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_size") / 50).alias("candidate_r"), F.lit(0.5).alias("proposed_r"),
            F.when(F.col("p_size") % 4 != 0, "scatter_plot").alias("topology"),
    )
    return figures.verifier_fields(p).select("p_partkey", "subject", "feature", "value", "topology")


@query("""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'missing_candidate_r' WHEN p_size % 5 = 0 THEN 'none' WHEN p_size % 3 = 0 THEN 'missing_image' WHEN p_size % 2 = 0
    THEN 'image_not_found' WHEN p_size / 20 > 1 THEN 'r_out_of_range' ELSE 'none' END AS reason
  FROM part""")
def t41_failures(spark, d):
    size = F.col("p_size")
    p = table(spark, d, "part").select("p_partkey", figures.failure(F.when(size % 7 != 0, size / 20), F.when(size % 5 == 0, "forest_plot"),
        F.when(size % 3 == 0, " ").otherwise("a.png"), size % 2 != 0).alias("reason"))
    return p.select("p_partkey", F.coalesce("reason", F.lit("none")).alias("reason"))


@query("SELECT count(*) AS n, sum(p_partkey)::BIGINT AS keys FROM part WHERE p_size % 2 = 0 AND p_size % 3 <> 0")
def t41_eligible(spark, d):
    p = table(spark, d, "part").withColumns({"status": F.when(F.col("p_size") % 2 == 0, "ok").otherwise("error"), "candidate_r": F.when(F.col("p_size") % 3 != 0, 0.1)})
    return figures.to_verify(p).agg(F.count("*").alias("n"), F.sum("p_partkey").alias("keys"))


def _audited(spark, d):
    p = table(spark, d, "part")
    size, id_ = F.col("p_size"), _key().alias("proposal_id")
    proposals = p.select(id_, _key().alias("figure_id"), ((size - 25) / 20).alias("candidate_r"),
        F.when(F.col("p_partkey") % 2 == 0, "current").otherwise("earlier").alias("provenance"))
    told = F.when(size % 4 == 0, "log fold change").otherwise("Pearson r = 0.2")
    shown = p.select(_key().alias("figure_id"), told.alias("caption"), F.col("p_partkey").alias("ord"))
    bars = p.where("p_size % 5 <> 0").select(id_, (size % 3 != 0).alias("passed"), F.when(size % 3 != 0, "legend_detected").otherwise("legend_not_found").alias("reason"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    pixel = p.select(id_, (F.col("p_partkey") % 3 == 0).alias("verified"),
        F.when(F.col("p_partkey") % 3 == 1, "legend_not_found").otherwise("insufficient_support").alias("reason_code"))
    said = F.concat(F.lit('```json\n{"verdict": "'), _case("p_partkey", ["pass", "FAIL", "inconclusive", "Pass", "fail"]),
        F.lit('", "seen": {"a": "b"}} and {more}\n```'))
    vision = p.where("p_partkey % 11 <> 0").select(id_, said.alias("answer"))
    return figures.audit(proposals, shown, bars, pixel, vision)


_AUDIT = """
WITH a AS (
  SELECT p_partkey, p_size, CASE WHEN p_partkey % 2 = 0 THEN 'current' ELSE 'earlier' END AS provenance,
         CASE p_partkey % 3 WHEN 0 THEN 'pass' WHEN 1 THEN 'inconclusive' ELSE 'fail' END AS px,
         CASE WHEN p_partkey % 11 = 0 THEN 'inconclusive' WHEN p_partkey % 5 IN (0, 3) THEN 'pass' WHEN p_partkey % 5 IN (1, 4) THEN 'fail' ELSE 'inconclusive' END AS vi,
         CASE WHEN p_size % 4 = 0 THEN 'caption' WHEN p_size % 5 = 0 OR p_size % 3 = 0 THEN 'colorbar_detect' WHEN abs((p_size - 25) / 20) > 1.05 THEN 'range_sanity' END
             AS failing_gate
           FROM part),
b AS (SELECT *, CASE WHEN failing_gate IS NOT NULL THEN 'REJECT_GATE' WHEN px = 'pass' AND vi = 'pass' THEN 'ACCEPT' WHEN px = 'fail' AND vi = 'fail' THEN 'REJECT_DUAL'
    ELSE 'REVIEW' END AS final_verdict
  FROM a)
"""


@query(
    _AUDIT
    + """SELECT p_partkey::VARCHAR AS proposal_id, failing_gate, final_verdict, px AS pixel_verdict, vi AS vision_verdict,
CASE failing_gate WHEN 'caption' THEN 'non_r_quantity_indicated' WHEN 'colorbar_detect' THEN CASE WHEN p_size % 5 = 0 THEN 'image_missing' ELSE 'legend_not_found' END
    WHEN 'range_sanity' THEN 'out_of_range' END AS gate_reason
  FROM b"""
)
def e11_audit(spark, d):
    return _audited(spark, d).select("proposal_id", "failing_gate", "gate_reason", "final_verdict", "pixel_verdict", "vision_verdict")


@query(
    _AUDIT
    + """SELECT kind, key, count(*) AS n FROM (SELECT 'verdict' AS kind, final_verdict AS key FROM b
      UNION ALL SELECT 'failing_gate', failing_gate FROM b WHERE failing_gate IS NOT NULL
UNION ALL SELECT 'by_provenance', provenance || '|' || final_verdict FROM b) GROUP BY ALL"""
)
def a16_audit_counts(spark, d):
    return figures.audit_counts(_audited(spark, d))


@query("""
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'caption_missing' WHEN 1 THEN 'non_r_quantity_indicated' WHEN 2 THEN 'correlation_vocabulary_matched' WHEN 3
    THEN 'no_correlation_vocabulary' WHEN 4 THEN 'non_r_quantity_indicated' ELSE 'correlation_vocabulary_matched' END AS reason
  FROM part""")
def t29_caption_reasons(spark, d):
    caption = _case("p_size", [" ", "Z-score heatmap, Pearson", "Correlation matrix of features", "A picture", "Differential abundance (LFC)", "Spearman's rho = 0.3"])
    return table(spark, d, "part").select("p_partkey", gates.caption_gate(caption)["reason"].alias("reason"))


# Entities.

TUIS = ["T007", "T047", "T201", "T204", "T999"]
CUIS = ["C0086418", "C1", "C2"]


def _gate_sql(name: str, tuis: tuple[str, ...], denied: bool) -> str:
    accepted = ", ".join(f"'{t}'" for t in tuis)
    deny = "WHEN p_partkey % 3 = 0 THEN 'deny_cui:Homo sapiens' " if denied else ""
    return (
        f"SELECT '{name}' AS gate, p_partkey::VARCHAR AS surface, CASE WHEN p_size % 9 = 0 THEN 'no_umls_match' WHEN {_case_sql('p_size', TUIS)} NOT IN ({accepted}) THEN 'tui_not_in_accept_set' "
        f"{deny}WHEN (p_partkey % 100) / 100 < 0.85 THEN format('low_similarity:{{:.3f}}<0.850', (p_partkey % 100) / 100) ELSE '' END AS drop_reason FROM part"
    )


@query(" UNION ALL ".join([_gate_sql("microbe", vocab.MICROBE_TUIS, True), _gate_sql("disease", vocab.DISEASE_TUIS, False),
    _gate_sql("feature", vocab.FEATURE_TUIS, False)]))
def t46_entity_gates(spark, d):
    p = table(spark, d, "part")
    g = p.where("p_size % 9 <> 0").select(_key().alias("surface"), _case("p_partkey", CUIS).alias("cui"), _case("p_size", TUIS).alias("tui"),
        ((F.col("p_partkey") % 100) / 100).alias("similarity"), F.lit("x").alias("official_name"))
    out = None
    for name, gate in (("microbe", entities.microbe_gate), ("disease", entities.disease_gate), ("feature", entities.feature_gate)):
        one = gate(p.select(_key().alias("surface")), g).select(F.lit(name).alias("gate"), "surface", "drop_reason")
        out = one if out is None else out.unionByName(one)
    return out


@query("""
WITH c AS (SELECT p_brand AS surface, p_partkey AS span, 'C' || p_partkey AS cui, CASE WHEN p_size % 2 = 0 THEN 'T007' ELSE 'T047' END AS tui, p_size / 50 AS s
  FROM part WHERE p_size % 3 <> 0)
SELECT surface, arg_max(cui, (s, -span)) AS cui, max(s)::DOUBLE AS similarity FROM c WHERE tui = 'T007' GROUP BY surface""")
def t43_best_grounding(spark, d):
    p = table(spark, d, "part")
    kinds = F.array(F.when(F.col("p_size") % 2 == 0, "T007").otherwise("T047"), F.lit("T007"))
    c = p.select(
        F.col("p_brand").alias("surface"), F.col("p_partkey").alias("span"), (F.col("p_size") % 3 == 0).cast("int").alias("rank"),
            F.concat(F.lit("C"), _key()).alias("cui"), kinds.alias("tuis"), (F.col("p_size") / 50).alias("similarity"),
        F.lit("n").alias("official_name"),
    )
    return entities.best_grounding(c, ("T007",)).select("surface", "cui", "similarity")


LIKE = ["Escherichia coli", "bacteria", "Clostridium difficile", "E. coli", "rubella", "the lactobacillus", "microbe", "Homo sapiens", "  Gut Bacteroides ",
    "faecalibacterium", "Prevotella copri", "prevotella copri", "radiomics bacterium", ""]
IS_LIKE = [True, False, True, True, False, False, False, False, True, True, True, False, False, False]


@query(f"SELECT p_partkey, ({_case_sql('p_partkey', ['yes' if x else 'no' for x in IS_LIKE])}) = 'yes' AS microbe FROM part")
def t22_microbe_like(spark, d):
    return table(spark, d, "part").select("p_partkey", spans.microbe_like(_case("p_partkey", LIKE)).alias("microbe"))


@query("""
WITH r AS (SELECT p_partkey, unnest([{'w': ' E.  coli ', 's': 1, 'e': 7, 'x': p_size / 50, 'g': 'SPECIES', 'i': 0},
    {'w': 'e. coli', 's': 1, 'e': 7, 'x': 0.5, 'g': '', 'i': 1}, {'w': p_brand, 's': -1, 'e': p_size, 'x': 0.0, 'g': 'ENTITY', 'i': 2}]) AS x
  FROM part),
n AS (SELECT p_partkey, trim(regexp_replace(x.w, '\\s+', ' ', 'g')) AS t, x.s AS s, x.e AS e, x.x AS score, coalesce(nullif(x.g, ''), 'ENTITY') AS g, x.i AS i FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, s, e, lower(t) ORDER BY score DESC, i) AS k FROM n)
SELECT p_partkey, t AS text, s AS start, e AS "end", score::DOUBLE AS score, g AS label, CASE WHEN p_partkey % 3 = 0 THEN 'openmed_speciesdetect' WHEN p_partkey % 3 = 1
    THEN 'distilbert_biomedical' ELSE 'ner_pipeline' END AS extractor
  FROM b WHERE k = 1""".replace("\\\\s", "\\s"))
def t44_shaped_entities(spark, d):
    one = lambda w, s, e, x, g: F.struct(w.alias("word"), s.cast("int").alias("start"), e.cast("int").alias("end"), x.cast("double").alias("score"),
        g.alias("entity_group"))
    lit = F.lit
    raw = F.array(
        one(lit(" E.  coli "), lit(1), lit(7), F.col("p_size") / 50, lit("SPECIES")), one(lit("e. coli"), lit(1), lit(7), lit(0.5), lit("")),
            one(F.col("p_brand"), lit(0), F.col("p_size"), lit(None), lit(None).cast("string")),
        one(lit("  "), lit(1), lit(2), lit(0.9), lit("X")),
    )
    model = _case("p_partkey", ["OpenMed/OpenMed-NER-SpeciesDetect", "d4data/biomedical-ner-all", "other"])
    return table(spark, d, "part").select("p_partkey", F.inline(entities.shaped(raw, entities.extractor_tag(model))))


SENTENCES = ["Roseburia rose in obesity patients. Nothing else here.", "Obesity was seen alone.", "Roseburia was seen alone."]


@query(f"""
WITH p AS (SELECT p_partkey::VARCHAR AS pmid, p_name FROM part WHERE p_size % 3 = 0)
SELECT substr(sha1(pmid || '|0|{SENTENCES[0].split('. ')[0]}.'), 1, 16) AS record_id, pmid, 0 AS sentence_index, 'obesity' AS disease, 'roseburia' AS microbe, p_name
    AS paper_title
  FROM p""")
def t37_entity_sentences(spark, d):
    papers = table(spark, d, "part").select(_key().alias("pmid"), F.col("p_name").alias("title"), _case("p_size", SENTENCES).alias("content"))
    out = entities.entity_sentences(papers, {"obesity": "DISEASE", "obesity patients": "DISEASE"}, {"Roseburia": "MICROBE"})
    return out.select("record_id", "pmid", "sentence_index", F.col("diseases")[0]["text"].alias("disease"), F.col("microbes")[0]["text"].alias("microbe"), "paper_title")


FAMILIES = ("mixtral_8x7b", "zephyr_7b", "llama_3", "other")


def _formed_sql(form: str, *values: str) -> str:
    parts = form.replace("'", "''").split("%s")
    quoted = lambda p: "'" + p.replace("\n", "' || chr(10) || '") + "'"
    return " || ".join(x for i, p in enumerate(parts) for x in ((quoted(p), values[i]) if i < len(values) else (quoted(p),)))


def _family_form(family: str) -> str:
    return next((f for names, f in vocab.CHAT_FORMS.items() if any(n in family for n in names)), vocab.PLAIN_FORM)


@query(
    f"WITH u AS (SELECT p_partkey, {_formed_sql(vocab.RELATION_ROLE + chr(10) + vocab.RELATION_LABELS)} AS s, {_formed_sql(vocab.RELATION_EVIDENCE, 'p_type', 'p_name', 'p_brand')} AS u FROM part) "
    + "SELECT p_partkey, "
    + ", ".join(f"{_formed_sql(_family_form(f), 's', 'u')} AS {f}" for f in FAMILIES)
    + " FROM u"
)
def t26_prompts(spark, d):
    p = table(spark, d, "part").withColumn("q", entities.relation_prompt(F.col("p_type"), F.col("p_name"), F.col("p_brand")))
    return p.select("p_partkey", *[entities.chat_prompt(F.col("q.system"), F.col("q.user"), f).alias(f) for f in FAMILIES])


# Concepts and retrieval.

@query("""
SELECT p_partkey, replace(replace(p_name, ' ', '_'), '_', ' ') || ' | ' || array_to_string(list_filter([p_type, nullif(p_brand, 'Brand#7')], lambda x: x IS NOT NULL), ' | ')
  || CASE WHEN p_size % 2 = 0 THEN ' | C' || p_size ELSE '' END AS document FROM part""")
def t42_concept_documents(spark, d):
    """Parts as concepts: their names, types and brands as synonyms, and for some a preferred term."""
    named = F.replace("p_name", F.lit(" "), F.lit("_"))
    synonyms = F.array("p_type", F.when(F.col("p_brand") != "Brand#7", F.col("p_brand")), F.lit(""))
    preferred = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("C"), F.col("p_size").cast("string")))
    return table(spark, d, "part").select("p_partkey", retrieval.concept_document(named, synonyms, preferred).alias("document"))


@query("""
WITH q AS (SELECT vec_id, embedding AS q FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS c, e.vec_id AS v, e.label, round(list_sum(list_transform(list_zip(q, embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)), 6) AS score
  FROM q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY score DESC, v) AS k FROM s)
SELECT 'p' || v AS pmid, 's' || v AS sentence, 'c' || c AS feature_canonical, 'C' || c AS feature_cui, score AS retrieval_similarity
  FROM r WHERE k <= 25 AND score >= 0.15 AND label % 2 = 0""")
def w4_candidates(spark, d):
    e = table(spark, d, "embeddings")
    id_ = F.col("vec_id").cast("string")
    concepts = e.where("vec_id % 50 = 0").select(F.concat(F.lit("c"), id_).alias("canonical"), F.lit("RadiomicFeature").alias("node_type"),
        F.concat(F.lit("C"), id_).alias("cui"), F.lit(0.15).alias("threshold"), "embedding")
    microbe = F.when(F.col("label") % 2 == 0, F.array(F.struct(F.lit("m").alias("text"))))
    sentences = e.select(F.col("vec_id").alias("sentence_id"), F.concat(F.lit("p"), id_).alias("pmid"), F.concat(F.lit("s"), id_).alias("sentence"),
        microbe.alias("microbes"), "embedding")
    return retrieval.candidates(concepts, sentences, 25).drop("microbes", "feature_node_type")


@query("""
WITH m AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x
  FROM embeddings), a AS (SELECT label, i, avg(x) AS x FROM m GROUP BY ALL),
n AS (SELECT label, sqrt(sum(x * x)) AS n FROM a GROUP BY label)
SELECT label, i::INT AS i, round(x / n, 5) AS x FROM a JOIN n USING (label)""")
def v5_centroid_components(spark, d):
    c = vectors.centroids(table(spark, d, "embeddings"))
    return c.select("label", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.round("x", 5))


# The gold set.

KEYWORD_TEXTS = ["Psoas muscle and psoas", "eating fat", "EAT volume", "T-Score of bone", "pmid 12", "PMI rose", "liver fat", "GLCM texture", "a ct scan", "doctor's act",
    "lean mass", "nothing"]


def _keyword_sql(low: str) -> str:
    test = lambda k: f"regexp_matches({low}, '\\b{k}\\b')" if k in vocab.WHOLE_KEYWORDS else f"contains({low}, '{k}')"
    return "CASE " + " ".join(f"WHEN {test(k)} THEN '{f}'" for k, f in sorted(vocab.EXTENDED_KEYWORDS.items(), key=lambda x: -len(x[0]))) + " END"


_BODY = " OR ".join([f"contains(t, '{w}')" for w in vocab.BODY_TOKENS] + [f"regexp_matches(t, '\\b{a}\\b')" for a in vocab.BODY_ABBREVIATIONS])


@query(f"""
SELECT p_partkey, {_keyword_sql('t')} AS feature, {_BODY} AS body FROM (SELECT p_partkey, lower({_case_sql('p_partkey', KEYWORD_TEXTS)}) AS t FROM part)""")
def t21_keywords(spark, d):
    t = _case("p_partkey", KEYWORD_TEXTS)
    return table(spark, d, "part").select("p_partkey", goldset.extended_feature(t).alias("feature"), goldset.generic_body_token(t).alias("body"))


@query("""
SELECT p_partkey::VARCHAR AS record_id, to_json({'record_id': p_partkey::VARCHAR, 'pmid': p_brand, 'stratum': 's', 'sentence': p_type, 'microbe': p_name, 'candidate_feature_canonical': CASE WHEN p_size % 2 = 0 THEN 'f' END,
  'candidate_feature_node_type': NULL::VARCHAR, 'pipeline_state': 'accepted', 'source_file': 'x.jsonl', 'label': NULL::VARCHAR, 'evidence_type': NULL::VARCHAR, 'quantitative': NULL::VARCHAR, 'confidence': NULL::VARCHAR, 'evidence_span': NULL::VARCHAR,
  'inferred_feature_canonical': NULL::VARCHAR, 'inferred_node_type': NULL::VARCHAR, 'annotator_notes': '', 'labeled_at': NULL::VARCHAR,
      'label_pass': NULL::VARCHAR})::VARCHAR AS line
    FROM part""")
def s22_gold_lines(spark, d):
    none = F.lit(None).cast("string")
    rows = table(spark, d, "part").select(
        _key().alias("record_id"), F.col("p_brand").alias("pmid"), F.lit("s").alias("stratum"), F.col("p_type").alias("sentence"), F.col("p_name").alias("microbe"),
            F.when(F.col("p_size") % 2 == 0, "f").alias("candidate_feature_canonical"),
        none.alias("candidate_feature_node_type"), F.lit("accepted").alias("pipeline_state"), F.lit("x.jsonl").alias("source_file"),
    )
    return goldset.unlabelled_json(rows)


@query("""
SELECT p_partkey::VARCHAR AS record_id, lower(p_name) AS microbe, coalesce(CASE WHEN p_size % 2 = 0 THEN p_brand END, CASE WHEN p_size % 3 = 0 THEN p_type END)
    AS feature, p_size % 2 = 0 AND p_partkey % 5 = 0 AS predicted
  FROM part""")
def j11_predicted(spark, d):
    p = table(spark, d, "part")
    gold = goldset.load(p.select(
        _key().alias("record_id"), _key().alias("pmid"), F.concat(F.lit(" "), F.upper("p_name")).alias("microbe"),
            F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("").alias("candidate_feature_canonical"),
        F.when((F.col("p_size") % 2 != 0) & (F.col("p_size") % 3 == 0), F.col("p_type")).otherwise("").alias("inferred_feature_canonical"),
    ))
    from ..operators import scoring

    edges = p.where("p_partkey % 5 = 0").select(_key().alias("pmid"), F.col("p_name").alias("source_node"), F.col("p_brand").alias("target_node"))
    keys = goldset.accepted_keys(edges)
    return scoring.predict(gold, keys).select("record_id", "microbe", goldset.effective_feature().alias("feature"), "predicted")


GOLD = [*vocab.ASSOCIATED_LABELS, *vocab.NOT_ASSOCIATED_LABELS, "unclear", None]


@query(f"""
WITH g AS (SELECT {_case_sql('event_id', GOLD)} AS l FROM events)
SELECT count(*) AS n_total, count(*) FILTER (WHERE l = 'unclear') AS skipped_unclear, count(*) FILTER (WHERE l IS NULL) AS skipped_no_label,
       {', '.join(f"count(*) FILTER (WHERE l = '{x}') AS {x}" for x in vocab.ASSOCIATED_LABELS)}, count(*) FILTER (WHERE l <> 'unclear') AS n_scored,
           count(*) FILTER (WHERE l = 'unclear') / count(*) AS unclear_rate
         FROM g""")
def a13_label_summary(spark, d):
    return goldset.label_summary(table(spark, d, "events").select(_case("event_id", GOLD).alias("label")))


def _kappa_sql(name: str, a: str, b: str) -> str:
    return f"""SELECT '{name}' AS classes, n, round(po, 6) AS observed, round(pe, 6) AS expected, round(CASE WHEN pe >= 1 THEN 1 ELSE (po - pe) / (1 - pe) END, 6)
        AS kappa
      FROM (
  SELECT count(*) AS n, count(*) FILTER (WHERE {a} = {b}) / count(*) AS po FROM j),
  (SELECT sum(x.n * y.n) / (SELECT count(*) * count(*) FROM j) AS pe FROM (SELECT {a} AS l, count(*) AS n FROM j GROUP BY 1) x
    JOIN (SELECT {b} AS l, count(*) AS n FROM j GROUP BY 1) y USING (l))"""


_TWO = "CASE WHEN {} LIKE 'associated%' THEN 'associated' ELSE 'not' END"


@query(
    f"""WITH f AS (SELECT event_id, {_case_sql('event_id', GOLD)} AS a FROM events
      WHERE event_id % 5 <> 0), s AS (SELECT event_id, {_case_sql('(event_id // 3)', GOLD)} AS b FROM events
      WHERE event_id % 4 <> 0),
j AS (SELECT a, b FROM f JOIN s USING (event_id) WHERE a IS NOT NULL AND b IS NOT NULL) """
    + _kappa_sql("all", "a", "b") + " UNION ALL " + _kappa_sql("binary", _TWO.format("a"), _TWO.format("b"))
)
def a14_agreement(spark, d):
    e = table(spark, d, "events")
    one = e.where("event_id % 5 <> 0").select(F.col("event_id").alias("record_id"), _case("event_id", GOLD).alias("label"), F.lit(0).alias("ord"))
    third = e.withColumn("third", F.floor(F.col("event_id") / 3))
    two = third.where("event_id % 4 <> 0").select(F.col("event_id").alias("record_id"), _case("third", GOLD).alias("label"), F.lit(0).alias("ord"))
    return goldset.agreement(one, two)


@query("""
SELECT p_partkey::VARCHAR AS record_id, CASE WHEN p_size % 3 = 0 THEN 'unclear' ELSE p_type END AS label, CASE WHEN p_size % 4 = 0 THEN 'not_associated' END
    AS suggested_label
  FROM part""")
def j13_overrides(spark, d):
    from ..operators import scoring

    p = table(spark, d, "part")
    gold = p.select(_key().alias("record_id"), F.col("p_type").alias("label"))
    over = p.where("p_size % 3 = 0").select(_key().alias("record_id"), F.lit("unclear").alias("label"))
    hints = p.where("p_size % 4 = 0").select(_key().alias("record_id"), F.lit("not_associated").alias("label"), F.lit("r").alias("reason"))
    return goldset.suggest(scoring.override_labels(gold, over), hints).drop("suggested_reason")


@query("SELECT c_custkey::VARCHAR AS record_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)")
def w9_unmatched(spark, d):
    gold = table(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_custkey").cast("string").alias("record_id"))
    return goldset.unmatched(gold, table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("record_id")))


# Harvesting.

TITLES = ["Radiomics of CT and the gut microbiome", "Sarcopenia on MRI predicts survival", "Review of PDFF and microbiota: systematic review, CT",
    "Texture features (PET) associated with outcome", "Liver stiffness by FibroScan and dysbiosis", "Emphysema on CT, microbiome",
        "Bone mineral density correlates with dysbiosis in patients", "A logbook of catalogues"]


def _profile_sql(name: str) -> str:
    def one(term: str) -> str:
        stem = term.lower().removesuffix("*")
        return f"regexp_matches(t, '(^|[^a-z0-9]){stem}" + ("" if term.endswith("*") else "([^a-z0-9]|$)") + "')"

    some = lambda block: "(" + " OR ".join(one(t) for b in block.split("+") for t in vocab.SEARCH_BLOCKS[b]) + ")"
    alternatives, primary = vocab.SEARCH_PROFILES[name]
    out = "(" + " OR ".join("(" + " AND ".join(map(some, blocks)) + ")" for blocks in alternatives) + ")"
    return out + (" AND NOT (" + " OR ".join(map(one, vocab.NOT_PRIMARY)) + ")" if primary else "")


@query(f"""
SELECT p_partkey, {', '.join(f'{_profile_sql(n)} AS {n}' for n in vocab.SEARCH_PROFILES)}
  FROM (SELECT p_partkey, lower({_case_sql('p_partkey', TITLES)}) || chr(10) || lower(p_type) AS t FROM part)""")
def s11_profiles(spark, d):
    title = _case("p_partkey", TITLES)
    return table(spark, d, "part").select("p_partkey", *[harvest.matches_profile(n, title, F.col("p_type")).alias(n) for n in vocab.SEARCH_PROFILES])


@query("""
WITH s AS (SELECT CASE WHEN p_size % 4 = 0 THEN 'missing_pmcid' WHEN p_partkey % 3 = 0 THEN 'reused_existing' ELSE 'failed' END AS s FROM part)
SELECT count(*) AS total_papers, count(*) FILTER (WHERE s <> 'missing_pmcid') AS with_pmcid, 0::BIGINT AS downloaded, count(*) FILTER (WHERE s = 'reused_existing')
    AS reused_existing,
       count(*) FILTER (WHERE s = 'missing_pmcid') AS missing_pmcid, count(*) FILTER (WHERE s = 'failed') AS failed FROM s""")
def s13_download_counts(spark, d):
    """Without a service: what is there is reused, the rest fails."""
    p = table(spark, d, "part")
    papers = p.select(F.when(F.col("p_size") % 4 != 0, F.concat(F.lit(" PMC"), _key())).alias("pmcid"))
    there = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("PMC"), _key()).alias("pmcid"), F.col("p_name").alias("full_text"))
    return harvest.download_counts(harvest.download_texts(papers, there))


@query("""
SELECT 'PMC' || p_partkey || '_Fig' || p_size AS figure_id, 'PMC' || p_partkey AS pmcid, 'Fig' || p_size AS fig_label FROM part
  WHERE p_size % 2 = 0 AND p_partkey % 3 <> 0""")
def s14_missing_figures(spark, d):
    p = table(spark, d, "part")
    name = F.concat(F.when(F.col("p_size") % 2 == 0, "PMC").otherwise("x"), _key(), F.lit("_Fig"), F.col("p_size").cast("string"))
    there = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("pmc/"), name, F.lit(".png")).alias("file"))
    return harvest.missing_figures(p.select(name.alias("figure_id")), there)


HTML = (
    '<div><img src="//c/a_Fig{k}_x.jpg"><figcaption>One <b>{b}</b></figcaption><img src="/s/M1.gif"><IMG alt="" src=\'/d/{k}.png\'>'
    '<p class="a caption b">Two\n {b}</p><img src="//c/a_Fig{k}_x.jpg"></div>'
)


@query("""
SELECT p_partkey, 0 AS figure_index, '//c/a_Fig' || p_partkey || '_x.jpg' AS figure_url, 'Fig' || p_partkey AS fig_label, 'One ' || p_brand AS caption FROM part
UNION ALL SELECT p_partkey, 1, '/d/' || p_partkey || '.png', p_partkey::VARCHAR, 'Two ' || p_brand FROM part""")
def s8_figures_of_pages(spark, d):
    html = F.replace(F.replace(F.lit(HTML), F.lit("{k}"), _key()), F.lit("{b}"), F.col("p_brand"))
    return files.figure_rows(table(spark, d, "part").select("p_partkey", html.alias("html")))
