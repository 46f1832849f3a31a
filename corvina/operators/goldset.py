"""The gold set: candidates of five strata, keyword tests, loading and writing, suggestions, agreement of two passes."""

from __future__ import annotations

import random
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, vocab
from . import scoring
from .relations import first_by

ROW = ("record_id", "pmid", "stratum", "sentence", "microbe", "candidate_feature_canonical", "candidate_feature_node_type", "pipeline_state", "source_file")
#: What an annotator fills in, in the order in which it is read; notes begin empty.
SLOTS = ("label", "evidence_type", "quantitative", "confidence", "evidence_span", "inferred_feature_canonical", "inferred_node_type", "annotator_notes", "labeled_at",
    "label_pass")


def extended_feature(sentence: Column) -> Column:
    """The feature of the longest extended keyword in a text, or null; abbreviations count as whole words only."""
    low = F.lower(F.coalesce(sentence, F.lit("")))
    order = sorted(vocab.EXTENDED_KEYWORDS.items(), key=lambda x: -len(x[0]))
    return text.first_of((low.rlike(text.word_bound(k)) if k in vocab.WHOLE_KEYWORDS else low.contains(k), f) for k, f in order)


def generic_body_token(sentence: Column) -> Column:
    low = F.lower(F.coalesce(sentence, F.lit("")))
    return text.contains_any(low, vocab.BODY_TOKENS) | low.rlike(text.any_of(text.word_bound(a) for a in vocab.BODY_ABBREVIATIONS))


def accepted_keys(accepted: DataFrame) -> DataFrame:
    """Distinct (pmid, microbe, feature) of accepted edges, without incomplete ones."""
    keys = accepted.select("pmid", F.lower(F.trim("source_node")).alias("microbe"), F.trim("target_node").alias("feature"))
    return keys.where("pmid <> '' AND microbe <> '' AND feature <> ''").distinct()


def load(rows: DataFrame) -> DataFrame:
    """Gold rows as they are scored: microbes trimmed and in lower case, empty features null."""
    none = lambda c: F.when(F.col(c) != "", F.col(c))
    return rows.withColumns(
        {"microbe": F.lower(F.trim("microbe")), "candidate_feature_canonical": none("candidate_feature_canonical"),
            "inferred_feature_canonical": none("inferred_feature_canonical")}
    )


def effective_feature() -> Column:
    return F.coalesce("candidate_feature_canonical", "inferred_feature_canonical")


def unlabelled_json(rows: DataFrame) -> DataFrame:
    """(record_id, line): the JSON line of each row for an annotator, fields in the order of ROW and SLOTS."""
    empty = [F.lit("" if c == "annotator_notes" else None).cast("string").alias(c) for c in SLOTS]
    return rows.select("record_id", F.to_json(F.struct(*ROW, *empty), {"ignoreNullFields": "false"}).alias("line"))


def candidates(accepted: DataFrame, rejected: DataFrame, sentences: DataFrame) -> list[tuple[str, DataFrame]]:
    """(stratum, rows) of the five strata, before sampling, with ord and at, by which they are in the order of what they come from.

    accepted(pmid, source_node, target_node, target_node_type, evidence,
    source_file), rejected(pmid, microbe, feature_canonical, feature_node_type, sentence, source_file)
    and sentences(pmid, sentence, microbes, source_file, ord); of rows with the same key the first stays.
    """
    keys = accepted_keys(accepted)
    cut = F.when(F.col("evidence").startswith("PMID ") & F.col("evidence").contains(":"),
        F.trim(F.regexp_replace("evidence", r"(?s)^[^:]*:", ""))).otherwise(F.col("evidence"))

    def shaped(df: DataFrame, prefix: str, stratum: str, state: str, parts: list, **columns) -> DataFrame:
        made = {"record_id": text.stable_id(prefix, *parts), "stratum": F.lit(stratum), "pipeline_state": F.lit(state)} | columns
        at = F.col("at") if "at" in df.columns else F.lit(0)
        return df.select(*[made.get(c, F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in ROW], "ord", at.alias("at"))

    placed = lambda df, *key: df if "ord" in df.columns else df.withColumn("ord", F.xxhash64(*key))
    named = placed(accepted, "pmid", "source_node", "target_node")
    one = shaped(
        named, "acc", "accepted_edge", "accepted", [F.col("pmid"), F.col("source_node"), F.col("target_node")], sentence=cut,
        microbe=F.col("source_node"), candidate_feature_canonical=F.col("target_node"), candidate_feature_node_type=F.col("target_node_type"),
    )
    on = (F.col("pmid") == F.col("_p")) & (F.lower(F.trim("microbe")) == F.col("_m")) & (F.col("feature_canonical") == F.col("_f"))
    known = keys.select(F.col("pmid").alias("_p"), F.col("microbe").alias("_m"), F.col("feature").alias("_f"))
    left = placed(rejected.join(known, on, "left_anti"), "pmid", "microbe", "feature_canonical")
    two = shaped(
        left, "rej", "gemini_rejected", "rejected_by_gemini", [F.col("pmid"), F.col("microbe"), F.col("feature_canonical")],
        candidate_feature_canonical=F.col("feature_canonical"), candidate_feature_node_type=F.col("feature_node_type"),
    )
    told = sentences.where(F.coalesce("sentence", F.lit("")) != "").withColumn("feature_canonical", extended_feature(F.col("sentence")))
    each = told.select("*", F.posexplode("microbes").alias("at", "m")).withColumn("microbe", F.lower(F.trim("m.text"))).where("pmid <> '' AND microbe <> ''")
    new = first_by(each.where("feature_canonical IS NOT NULL").join(known, on, "left_anti"), ["pmid", "microbe", "feature_canonical"], F.col("ord"), F.col("at"))
    three = shaped(
        new, "vex", "vocab_excluded", "not_seen_by_pipeline", [F.col("pmid"), F.col("microbe"), F.col("feature_canonical")],
        candidate_feature_canonical=F.col("feature_canonical"), candidate_feature_node_type=F.lit("BodyCompositionFeature"),
    )
    body = each.where(generic_body_token(F.col("sentence")))
    pairs = known.select("_p", "_m").distinct()
    probe = body.where("feature_canonical IS NULL").join(pairs, (F.col("pmid") == F.col("_p")) & (F.col("microbe") == F.col("_m")), "left_anti")
    start = F.substring("sentence", 1, 60)
    probe = first_by(probe.withColumn("_s", start), ["pmid", "microbe", "_s"], F.col("ord"), F.col("at"))
    parts = [F.col("pmid"), F.col("microbe"), F.substring("sentence", 1, 80)]
    four = shaped(probe, "rec", "recall_probe", "not_seen_by_pipeline", parts)
    any_ = first_by(body.where("at = 0").withColumn("_s", start), ["pmid", "microbe", "_s"], F.col("ord"))
    five = shaped(any_, "rnd", "random_co_occurrence", "not_seen_by_pipeline", parts)
    return [("accepted_edge", one), ("gemini_rejected", two), ("vocab_excluded", three), ("recall_probe", four), ("random_co_occurrence", five)]


def build(accepted: DataFrame, rejected: DataFrame, sentences: DataFrame, targets: Mapping[str, int] = vocab.GOLD_TARGETS, seed: int = 42, generator: bool = False) -> DataFrame:
    """The gold set: a seeded sample of each stratum, without probes of sentences that an earlier stratum has, each record once.

    Samples go by hashes of the records, or, with generator, by Python's
    generator, one for all strata, in the order of ord; accepted and rejected
    need a column ord then.
    """
    rng = random.Random(seed)
    strata = dict(candidates(accepted, rejected, sentences))
    picked = {}
    for name, df in strata.items():
        if name == "recall_probe":
            used = None
            for other in picked.values():
                part = other.select(F.col("pmid").alias("_p"), F.col("microbe").alias("_m"), F.substring("sentence", 1, 80).alias("_s"))
                used = part if used is None else used.unionByName(part)
            on = (F.col("pmid") == F.col("_p")) & (F.col("microbe") == F.col("_m")) & (F.substring("sentence", 1, 80) == F.col("_s"))
            df = df.join(used.distinct(), on, "left_anti")
        target = targets.get(name, 0)
        picked[name] = scoring.generator_sample(df, target, rng, "ord", "at") if generator else scoring.stratified_sample(df, "stratum", "record_id", {name: target}, seed)
    return scoring.gold_strata([(name, df.drop("stratum", "ord", "at")) for name, df in picked.items()])


def suggest(gold: DataFrame, suggestions: DataFrame) -> DataFrame:
    """gold with suggested_label and suggested_reason, which fill nothing in: a label stays the annotator's."""
    s = suggestions.select("record_id", F.col("label").alias("suggested_label"), F.col("reason").alias("suggested_reason"))
    return gold.join(s, "record_id", "left")


def unmatched(gold: DataFrame, overrides: DataFrame) -> DataFrame:
    """Ids of overrides that the gold set has not."""
    return overrides.select("record_id").distinct().join(gold.select("record_id"), "record_id", "left_anti")


def label_summary(gold: DataFrame) -> DataFrame:
    """One row: rows, scored, unclear and unlabelled ones, the rate of unclear ones, and associations by direction."""
    n = F.count("*")
    unclear, none = F.count_if(F.col("label") == "unclear"), F.count_if(F.col("label").isNull())
    by = [F.count_if(F.col("label") == x).alias(x) for x in vocab.ASSOCIATED_LABELS]
    out = gold.agg(n.alias("n_total"), unclear.alias("skipped_unclear"), none.alias("skipped_no_label"), *by)
    scored = F.col("n_total") - F.col("skipped_unclear") - F.col("skipped_no_label")
    return out.withColumns({"n_scored": scored, "unclear_rate": F.when(F.col("n_total") > 0, F.col("skipped_unclear") / F.col("n_total")).otherwise(0.0)})


def agreement(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two rows of kappa, by all labels and by association or not, over records that both passes labelled."""
    some = lambda df, c: df.where(F.coalesce("label", F.lit("")) != "").groupBy("record_id").agg(F.max_by("label", "ord").alias(c))
    both = some(first, "a").join(some(second, "b"), "record_id")
    two = lambda c: F.when(F.col(c).isin(*vocab.ASSOCIATED_LABELS), "associated").otherwise("not")
    halves = both.select(two("a").alias("a"), two("b").alias("b"))
    return scoring.kappa(both).withColumn("classes", F.lit("all")).unionByName(scoring.kappa(halves).withColumn("classes", F.lit("binary")))
