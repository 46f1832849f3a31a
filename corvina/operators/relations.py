"""Votes, within-paper and cross-paper evidence, strength scores, corpus merging.

Inputs whose order matters carry a column ord, the row's position; ties go to
the smaller ord, so results don't depend on partitioning.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import spans, text, vocab
from .ordering import ordinals

KEY = ("pmid", "subject_node_type", "subject_node", "disease")


def first_by(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in an order that should be total, nulls first; one aggregation that combines before the shuffle.

    The order is of values, ascending: a sort direction (desc() and the like) is refused.
    """
    if any(re.search(r" (ASC|DESC)( NULLS (FIRST|LAST))?'", repr(o)) for o in order):
        raise ValueError("first_by orders by values, without sort directions: negate a number instead of desc()")
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("_r")).select(*keys, "_r.*").select(*df.columns) if rest else df.distinct()


def last_by(df: DataFrame, keys: Sequence[str], ord: str = "ord") -> DataFrame:
    """The last row of each key, by one aggregation that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ord)).alias("_r")).select(*keys, "_r.*")


def self_consistency(samples: DataFrame, keys: Sequence[str], label: str = "label", ord: str = "ord", strict: bool = True) -> DataFrame:
    """Votes of repeated labels per key: final_label, vote_counts, full_consistency, label_entropy (log10), zero_entropy, accepted.

    The most frequent label wins, the one seen first at a tie; strictly, any
    entropy makes the key unrelated.
    """
    votes = samples.groupBy(*keys, F.col(label).alias("l")).agg(F.count("*").alias("n"), F.min(ord).alias("first"))
    total = votes.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        F.max_by("l", F.struct("n", -F.col("first"))).alias("top"),
        F.max("n").alias("most"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("l", F.col("n").cast("int"))))).alias("vote_counts"),
    )
    entropy = F.aggregate(F.map_values("vote_counts"), F.lit(0.0), lambda s, n: s - (n / F.col("total")) * F.log10(n / F.col("total")))
    out = total.withColumn("label_entropy", F.when(F.col("most") == F.col("total"), 0.0).otherwise(entropy))
    zero = F.col("label_entropy") <= 1e-12
    final = F.when(zero | F.lit(not strict), F.col("top")).otherwise("unrelated")
    out = out.withColumns({"full_consistency": F.col("most") == F.col("total"), "zero_entropy": zero, "final_label": final})
    return out.withColumn("accepted", F.col("final_label").isin("positive", "negative")).drop("total", "top", "most")


def majority(votes: Column) -> Column:
    """The label of most votes in a map of counts; unrelated where the two largest counts are equal, or without votes."""
    most = F.array_max(F.map_values(votes))
    top = F.map_keys(F.map_filter(votes, lambda _, n: n == most))
    return F.when(F.size(top) == 1, F.get(top, F.lit(0))).otherwise("unrelated")


def aggregate_within_paper(predictions: DataFrame) -> DataFrame:
    """One row per paper, subject and disease: majority label and the distinct sentences that gave it, sorted."""
    label = F.coalesce("final_label", F.lit("unrelated"))
    rows = predictions.withColumns(
        {
            "pmid": F.coalesce("pmid", F.lit("")),
            "subject_node_type": F.coalesce("subject_node_type", F.lit("Microbe")),
            "subject_node": F.coalesce(F.when(F.col("subject_node") != "", F.col("subject_node")), "microbe", F.lit("")),
            "disease": F.coalesce("disease", F.lit("")),
            "_l": label,
        }
    )
    told = F.struct(F.col("_l").alias("l"), F.col("sentence").alias("s"))
    by_label = rows.groupBy(*KEY, "_l").agg(F.count("*").cast("int").alias("n"), F.collect_set(F.when(F.col("sentence") != "", told)).alias("told"),
        F.min_by(F.struct("microbe", "impact_factor", "quartile"), "ord").alias("one"), F.min("ord").alias("ord"))
    out = by_label.groupBy(*KEY).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("_l", "n")))).alias("vote_counts"),
        F.sum("n").cast("int").alias("sentence_count"),
        F.flatten(F.collect_list("told")).alias("told"),
        F.min_by("one", "ord").alias("one"),
    )
    out = out.withColumn("final_label", majority(F.col("vote_counts")))
    mine = F.array_sort(F.transform(F.filter("told", lambda x: x["l"] == F.col("final_label")), lambda x: x["s"]))
    return out.select(
        *KEY,
        F.col("one.microbe").alias("microbe"),
        "final_label",
        F.col("final_label").isin("positive", "negative").alias("accepted"),
        F.array_join(mine, " ||| ").alias("evidence"),
        "sentence_count",
        "vote_counts",
        F.col("one.impact_factor").alias("impact_factor"),
        F.col("one.quartile").alias("quartile"),
    )


def strength_scores(aggregated: DataFrame, keys: Sequence[str] = KEY[1:], default_impact: float = 3.5, default_quartile: int = 2) -> DataFrame:
    """Signed sums per key over accepted rows: of 1, of log10(impact) and of log10(impact / quartile), rounded to 3."""
    sign = F.when(F.col("final_label") == "positive", 1).otherwise(-1)
    impact = F.coalesce(text.impact_factor(F.col("impact_factor")), F.lit(default_impact))
    quarter = text.quartile_number(F.col("quartile"))
    quarter = F.when(quarter > 0, quarter).otherwise(default_quartile)
    named = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys]
    return (
        aggregated.where("accepted")
        .groupBy(*named)
        .agg(
            F.count("*").alias("support_count"),
            F.sum(sign).alias("total_strength_raw"),
            F.round(F.sum(sign * F.log10(impact)), 3).alias("total_strength_if"),
            F.round(F.sum(sign * F.log10(impact / quarter)), 3).alias("total_strength_ifq"),
        )
    )


def supporting(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, label, pmid, evidence), each once: what stands behind the edges of signed_evidence(), however much it is for one key."""
    return rows.where(F.col("label").isin(*vocab.REL_BY_LABEL)).select(*keys, "label", "pmid", "evidence").distinct()


def signed_evidence(rows: DataFrame, keys: Sequence[str], confidence: float = 0.7, joined: bool = True) -> DataFrame:
    """Cross-paper evidence per key from rows (label, pmid, evidence, confidence, ord): the direction with more rows wins.

    Balanced keys are dropped. confidence is the mean of the winning side, best
    its row of highest confidence, the first at a tie. With joined, a row holds
    all papers and sentences of its key; where a key may have more than a row
    should hold, leave them to supporting().
    """
    plus = F.col("label") == "positive"
    sure = F.coalesce("confidence", F.lit(confidence))
    best = lambda side: F.max_by(F.struct("pmid", "ord"), F.when(side, F.struct(sure, -F.col("ord"))))
    told = lambda c, mark: F.array_join(F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c)))), mark)
    both = (
        rows.where(F.col("label").isin(*vocab.REL_BY_LABEL))
        .groupBy(*keys)
        .agg(
            F.count_if(plus).alias("positive_support"),
            F.count_if(~plus).alias("negative_support"),
            F.avg(F.when(plus, sure)).alias("cp"),
            F.avg(F.when(~plus, sure)).alias("cn"),
            best(plus).alias("bp"),
            best(~plus).alias("bn"),
            *([told("pmid", ",").alias("supporting_pmids"), told("evidence", " ||| ").alias("evidence")] if joined else []),
        )
    )
    net = F.col("positive_support") - F.col("negative_support")
    up = net > 0
    direction = F.when(up, "positive").otherwise("negative")
    return both.where(net != 0).select(
        *keys,
        direction.alias("relation_direction"),
        F.when(up, vocab.REL_BY_LABEL["positive"]).otherwise(vocab.REL_BY_LABEL["negative"]).alias("graph_rel_type"),
        F.round(F.when(up, F.col("cp")).otherwise(F.col("cn")), 3).alias("confidence"),
        "positive_support",
        "negative_support",
        F.round(net / (F.col("positive_support") + F.col("negative_support")), 3).alias("net_confidence"),
        F.when(up, F.col("bp.pmid")).otherwise(F.col("bn.pmid")).alias("pmid"),
        *(["supporting_pmids", "evidence"] if joined else []),
    )


def keep_best(df: DataFrame, keys: Sequence[str], score: str = "confidence", evidence: str | None = "evidence", ord: str = "ord", joint: str = " || ", repeats: bool = False) -> DataFrame:
    """The row of highest score per key, the first at a tie; its evidence is joined with that of the ties, in order, unless it holds them already.

    With repeats, evidence that is held already is joined as well.
    """
    rest = [c for c in df.columns if c not in keys]
    if evidence is None:
        return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(score, -F.col(ord))).alias("_r")).select(*keys, "_r.*").select(*df.columns)
    best = df.withColumn("_top", F.max(score).over(Window.partitionBy(*keys))).where(F.col(score) == F.col("_top")).drop("_top")
    grouped = best.groupBy(*keys).agg(F.min_by(F.struct(*rest), ord).alias("_r"), F.sort_array(F.collect_list(F.struct(ord, evidence))).alias("_all"))
    if repeats:
        told = F.when(F.exists("_all", lambda x: x[evidence].isNotNull()), F.array_join(F.transform("_all", lambda x: x[evidence]), joint))
        return grouped.select(*keys, "_r.*", told.alias("_told")).withColumn(evidence, F.col("_told")).select(*df.columns)
    told = F.aggregate(
        F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(0))),
        F.coalesce(F.get("_all", F.lit(0))[evidence], F.lit("")),
        lambda a, x: F.when(F.contains(a, F.coalesce(x[evidence], F.lit(""))), a).otherwise(F.concat(a, F.lit(joint), x[evidence])),
    )
    return grouped.select(*keys, "_r.*", told.alias("_told")).withColumn(evidence, F.col("_told")).select(*df.columns)


def merge_corpora(papers: DataFrame, texts: Sequence[str], numbers: Sequence[str], profile: str = "profile", ord: str = "ord") -> DataFrame:
    """One row per pmid: first filled text and number of each column in file order, latest retrieval date, profiles in the order seen."""
    filled = lambda c: F.min_by(c, F.when(F.trim(F.col(c)) != "", F.col(ord)))
    known = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ord)))
    seen = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(ord, profile))), lambda x: x[profile]))
    aggregates = [F.when(F.max(F.trim(F.col(c)) != ""), filled(c)).alias(c) for c in texts] + [F.when(F.max(F.col(c).isNotNull()), known(c)).alias(c) for c in numbers]
    merged = papers.where(F.coalesce("pmid", F.lit("")) != "").groupBy("pmid").agg(*aggregates, F.max("retrieval_date").alias("retrieval_date"), seen.alias("profiles"),
        F.count("*").alias("n_rows"))
    return merged.withColumn("query", F.concat(F.lit("merged:"), F.array_join("profiles", "|")))


# Relation input.


def relation_input(entity_sentences: DataFrame, papers: DataFrame, mentions: DataFrame | None = None, require_context: bool = False) -> DataFrame:
    """(row_id, pmid, sentence, microbe, disease, ..., reason) for every pair of a microbe and a disease in a sentence.

    Pairs are cleaned; those that can't be used carry the reason. With
    require_context a paper without imaging features rejects its pairs.
    """
    pairs = (
        entity_sentences.select("record_id", "pmid", "sentence", F.explode("microbes").alias("m"), "diseases")
        .select("record_id", "pmid", "sentence", "m", F.explode("diseases").alias("d"))
        .select(
            F.col("record_id").alias("entity_sentence_id"),
            "pmid",
            "sentence",
            F.col("m.text").alias("raw_microbe"),
            F.col("d.text").alias("raw_disease"),
            F.col("m.cui").alias("microbe_cui"),
            F.col("d.cui").alias("disease_cui"),
        )
    )
    cleaned = pairs.withColumn("c", spans.clean_pair(F.col("sentence"), F.col("raw_microbe"), F.col("raw_disease"), max_words=500, max_chars=5000))
    index = last_by(papers.where(F.coalesce("pmid", F.lit("")) != "").select("pmid", "impact_factor", "quartile", "ord"), ["pmid"]).drop("ord")
    out = cleaned.join(index, "pmid", "left")
    if mentions is not None:
        features = mentions.where("canonical_feature <> ''").groupBy("pmid").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord",
            "canonical_feature"))), lambda x: x["canonical_feature"])).alias("radiomic_features"))
        out = out.join(features, "pmid", "left")
    else:
        out = out.withColumn("radiomic_features", F.lit(None).cast("array<string>"))
    has = F.coalesce(F.size("radiomic_features") > 0, F.lit(False))
    reason = F.coalesce(F.col("c.reason"), F.when(F.lit(require_context) & ~has, "missing_radiomics_context"))
    subject, disease = F.col("c.subject"), F.col("c.disease")
    return out.select(
        text.stable_id(F.col("entity_sentence_id"), subject, disease).alias("row_id"),
        "pmid",
        "sentence",
        subject.alias("microbe"),
        disease.alias("disease"),
        F.lit("Microbe").alias("subject_node_type"),
        subject.alias("subject_node"),
        text.impact_factor(F.col("impact_factor")).alias("impact_factor"),
        text.quartile(F.col("quartile")).alias("quartile"),
        "entity_sentence_id",
        "disease_cui",
        "microbe_cui",
        "radiomic_features",
        has.alias("has_radiomics_context"),
        reason.alias("reason"),
    )


def reason_counts(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n"))


def augment(seeds: DataFrame, templates: Sequence[str] = ("Evidence indicates that {}", "In this study, {}")) -> DataFrame:
    """Three rows per seed (ord, sentence, microbe, disease): two template paraphrases and one with the entities of later seeds.

    The swap takes the next microbe and the next but one disease, in the order
    of the seeds and around its end; where it changes nothing, the first
    template stands in.
    """
    numbered = ordinals(seeds, "ord", "i")
    pools = {c: ordinals(seeds.where(F.trim(F.coalesce(c, F.lit(""))) != "").select("ord", c), "ord", "j").select("j", F.col(c).alias(f"new_{c}")) for c in ("microbe",
        "disease")}
    out = numbered
    for c, step in (("microbe", 1), ("disease", 2)):
        n = pools[c].agg(F.count("*").alias(f"n_{c}"))
        out = out.crossJoin(F.broadcast(n))
        out = out.join(pools[c], F.pmod(F.col("i") + step, F.greatest(F.col(f"n_{c}"), F.lit(1))) == F.col("j"), "left").drop("j")
    swapped = out["sentence"]
    for c in ("microbe", "disease"):
        swapped = F.when(F.coalesce(F.col(c), F.lit("")) == "", swapped).otherwise(
            F.regexp_replace(swapped, F.concat(F.lit(r"(?i)\Q"), F.col(c), F.lit(r"\E")), F.regexp_replace(F.coalesce(F.col(f"new_{c}"), F.lit("")), r"([\\$])", r"\\$1"))
        )
    paraphrased = [F.format_string(t.replace("{}", "%s"), F.col("sentence")) for t in templates]
    kinds = [F.struct(F.lit("paraphrase").alias("kind"), p.alias("text")) for p in paraphrased]
    swap = F.struct(F.lit("entity_swap").alias("kind"), F.when(swapped == F.col("sentence"), paraphrased[0]).otherwise(swapped).alias("text"))
    return out.select("ord", "microbe", "disease", F.posexplode(F.array(*kinds, swap)).alias("k", "a")).select(
        text.stable_id(F.col("ord"), F.col("k"), F.col("a.text")).alias("row_id"), "ord", "microbe", "disease", "a.kind", "a.text"
    )
