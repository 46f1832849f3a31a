"""Mentions of imaging features in sentences: exact aliases with offsets, else fuzzy ones; candidates of microbes and features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, vocab
from .aliases import alias_matches
from .relations import first_by

def sentence_rows(papers: DataFrame, content: str = "content") -> DataFrame:
    """(pmid, title, sentence_index, sentence)"""
    return papers.select("pmid", "title", F.posexplode(text.sentences(F.col(content))).alias("sentence_index", "sentence"))


def extract_mentions(papers: DataFrame, content: str = "content", aliases: Mapping[str, tuple] = vocab.ALIASES, fuzzy: bool = True) -> DataFrame:
    """One row per feature mention of papers(pmid, title, content), with context, subject and additive confidence."""
    rows = sentence_rows(papers, content)
    s, title = F.col("sentence"), F.coalesce("title", F.lit(""))
    hits = rows.withColumn("_m", alias_matches(text.normalize(s), aliases, fuzzy)).where(F.size("_m") > 0)
    told = hits.withColumns(
        {"modality": text.modality(s), "body_location": text.body_location(s), "disease": text.disease(s, title), "claim_hint": text.claim_hint(s, title),
            "_s": text.subject(s)}
    )
    one = told.withColumn("_x", F.explode("_m"))
    part = lambda c, x: F.when(F.col(c).isNotNull(), x).otherwise(0.0)
    sure = F.lit(0.45) + F.when(F.col("_x.method") == "exact", 0.15).otherwise(0.05) + part("modality", 0.15) + part("body_location", 0.15) + part("disease",
        0.10) + part("_s.name", 0.05)
    index = F.col("sentence_index").cast("string")
    return one.select(
        text.stable_id(F.col("pmid"), index, F.col("_x.start"), F.col("_x.end"), F.col("_x.canonical")).alias("mention_id"),
        "pmid",
        "sentence",
        "sentence_index",
        F.col("_x.start").alias("span_start"),
        F.col("_x.end").alias("span_end"),
        F.col("_x.raw").alias("raw_feature"),
        F.col("_x.canonical").alias("canonical_feature"),
        F.col("_x.ontology_id").alias("ibsi_id"),
        F.least(F.lit(1.0), sure).alias("confidence"),
        F.col("_x.method").alias("mapping_method"),
        F.concat(F.lit("PMID "), F.coalesce("pmid", F.lit("")), F.lit(" sentence "), index).alias("evidence"),
        F.col("_x.family").alias("feature_family"),
        F.col("_x.node_type").alias("node_type"),
        F.when(F.col("_x.family") == "radiomic", "IBSI").otherwise("BODYCOMP").alias("ontology_namespace"),
        "modality",
        "body_location",
        "disease",
        "claim_hint",
        F.col("_s.type").alias("subject_node_type"),
        F.col("_s.name").alias("subject_node"),
    )


def first_feature(sentence: Column, terms: Sequence[tuple[str, str]], whole_words: Sequence[str] = ()) -> Column:
    """The canonical name of the longest alias in a text; some aliases count as whole words only."""
    low = F.lower(F.coalesce(sentence, F.lit("")))
    order = sorted(terms, key=lambda t: -len(t[0]))
    return text.first_of((low.rlike(text.word_bound(a)) if a in whole_words else low.contains(a), c) for a, c in order)


def microbe_features(entity_sentences: DataFrame, terms: Sequence[tuple[str, str]], whole_words: Sequence[str] = ()) -> DataFrame:
    """(pmid, sentence, microbe, feature) of microbes in sentences with a feature, the first of each pmid, microbe and feature."""
    rows = entity_sentences.withColumn("feature", first_feature(F.col("sentence"), terms, whole_words)).where(F.col("feature").isNotNull())
    one = rows.select("pmid", "sentence", "ord", "feature", F.explode("microbes").alias("m")).withColumn("microbe", text.normalize(F.col("m.text")))
    one = one.where((F.col("microbe") != "") & (F.col("microbe") != F.lower("feature")))
    return first_by(one.drop("m"), ["pmid", "microbe", "feature"], F.col("ord"), F.col("sentence"))


def gated_features(candidates: DataFrame, grounded: DataFrame) -> DataFrame:
    """microbe_features() with drop_reason, null for those that stay, and cui, tui, similarity and official_name, from grounded(surface, accepted, ...).

    Surfaces are compared trimmed and in lower case; one that was not grounded is dropped as such.
    """
    told = ("cui", "tui", "similarity", "official_name")
    g = grounded.groupBy(F.lower(F.trim("surface")).alias("_k")).agg(F.max_by(F.struct("accepted", "drop_reason", *told), F.struct("accepted", "similarity")).alias("_g"))
    joined = candidates.join(g, F.col("microbe") == F.col("_k"), "left")
    reason = F.when(F.coalesce("_g.accepted", F.lit(False)), None).otherwise(F.coalesce(F.nullif("_g.drop_reason", F.lit("")), F.lit("not_grounded")))
    return joined.withColumns({"drop_reason": reason} | {f"microbe_{c}": F.col(f"_g.{c}") for c in told}).drop("_k", "_g")


def feature_edges(candidates: DataFrame, samples: DataFrame, node_types: Mapping[str, str] | None = None) -> DataFrame:
    """CORRELATES_WITH edges of candidates(pmid, microbe, feature, sentence) that all answers call associated.

    samples(pmid, microbe, feature, label) are the answers of repeated calls; a candidate without any is no edge.
    """
    key = ["pmid", "microbe", "feature"]
    votes = samples.groupBy(*key).agg(F.bool_and(F.coalesce("label", F.lit("")) == "associated").alias("_all"), F.count("*").alias("n_samples"))
    kinds = F.create_map(*[F.lit(x) for p in (node_types or {"": ""}).items() for x in p])
    good = candidates.join(votes.where("_all"), key)
    return good.select(
        text.stable_id(*[F.col(k) for k in key]).alias("record_id"), "pmid", F.lit("Microbe").alias("source_node_type"), F.col("microbe").alias("source_node"),
        F.coalesce(F.try_element_at(kinds, F.col("feature")), text.feature_node_type(F.col("feature"))).alias("target_node_type"), F.col("feature").alias("target_node"),
        F.lit("CORRELATES_WITH").alias("rel_type"), F.concat(F.lit("PMID "), "pmid", F.lit(": "), F.substring("sentence", 1, 250)).alias("evidence"),
            F.lit(1.0).alias("confidence"), "n_samples",
    )


def ground(surfaces: DataFrame, groundings: DataFrame, tuis: Sequence[str], deny: Mapping[str, str] | None = None, floor: float = 0.85) -> DataFrame:
    """surfaces(surface, ...) with cui, tui, similarity, official_name, accepted and drop_reason.

    groundings(surface, cui, tui, similarity, official_name) stands for a
    linker. The best candidate of an accepted type counts, else the best of any;
    empty surfaces, types, denied concepts and low similarity are rejected in
    this order. Each distinct surface is looked up once.
    """
    g = groundings.withColumns({"_ok": F.col("tui").isin(*tuis), "_sim": F.coalesce("similarity", F.lit(0.0))})
    best = g.groupBy(F.trim("surface").alias("_k")).agg(F.max_by(F.struct("cui", "tui", "_sim", "official_name", "_ok"), F.struct("_ok", "_sim", "cui")).alias("_g"))
    out = surfaces.join(best, F.trim(F.coalesce("surface", F.lit(""))) == F.col("_k"), "left")
    denied = F.try_element_at(F.create_map(*[F.lit(x) for p in (deny or {"": ""}).items() for x in p]), F.col("_g.cui"))
    low = F.format_string("low_similarity:%.3f<%.3f", F.col("_g._sim"), F.lit(floor))
    reason = (
        F.when(F.trim(F.coalesce("surface", F.lit(""))) == "", "empty_surface")
        .when(F.col("_g").isNull(), "no_umls_match")
        .when(~F.col("_g._ok"), "tui_not_in_accept_set")
        .when(denied.isNotNull(), F.concat(F.lit("deny_cui:"), denied))
        .when(F.col("_g._sim") < floor, low)
        .otherwise("")
    )
    made = {"cui": F.col("_g.cui"), "tui": F.col("_g.tui"), "similarity": F.coalesce("_g._sim", F.lit(0.0)), "official_name": F.col("_g.official_name"),
        "drop_reason": reason, "accepted": reason == ""}
    return out.withColumns(made).drop("_k", "_g")


def audit_report(grounded: DataFrame) -> DataFrame:
    """(kind, key, n, share) of all rows, drops by reason and the 20 most dropped surfaces."""
    total = grounded.agg(F.lit("total").alias("kind"), F.lit("").alias("key"), F.count("*").alias("n"),
        F.round(F.count_if(~F.col("accepted")) / F.greatest(F.count("*"), F.lit(1)), 4).alias("share"))
    none = F.lit(None).cast("double").alias("share")
    dropped = grounded.where(~F.col("accepted"))
    reasons = dropped.groupBy(F.lit("reason").alias("kind"), F.col("drop_reason").alias("key")).agg(F.count("*").alias("n"), none)
    surfaces = dropped.groupBy(F.lit("surface").alias("kind"), F.col("surface").alias("key")).agg(F.count("*").alias("n"), none).orderBy(F.col("n").desc(),
        "key").limit(20)
    return total.unionByName(reasons).unionByName(surfaces)
