"""Concepts, an offline encoder, and candidates retrieved for concepts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, vocab
from . import vectors


def default_concepts(spark: SparkSession) -> DataFrame:
    """The concepts that are looked for unless others are given."""
    rows = [(name, "BodyCompositionFeature", list(synonyms), None, None, vocab.CONCEPT_THRESHOLD) for name, synonyms in vocab.CONCEPTS.items()]
    return spark.createDataFrame(rows, "canonical string, node_type string, synonyms array<string>, umls_preferred string, cui string, threshold double")


def concept_document(canonical: Column, synonyms: Column, preferred: Column) -> Column:
    """Name, synonyms and preferred term in one text, without empty ones."""
    parts = F.concat(F.array(F.replace(canonical, F.lit("_"), F.lit(" "))), F.coalesce(synonyms, F.array().cast("array<string>")), F.array(preferred))
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), " | ")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), value being evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _run_lengths(s: Column) -> Column:
    """How often each value is in a sorted array that isn't empty, as a map."""
    n = F.size(s)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    lengths = lambda b: F.zip_with(b, F.concat(F.slice(b, 2, n), F.array(n)), lambda x, y: y - x)
    return _bound(starts, lambda b: F.map_from_arrays(F.transform(b, lambda i: F.get(s, i)), lengths(b)))


def hashed_embedding(content: Column, size: int = 64) -> Column:
    """An offline encoder: counts of hashed words with a sign, at unit length; all zero for a text without words. Words are looked at once, sorted by slot."""
    words = text.tokens(text.normalize(content))
    slots = F.sort_array(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(2 * size))))
    none = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda _: F.lit(0.0))

    def counts(s: Column) -> Column:
        n = lambda m, i: F.coalesce(F.try_element_at(m, F.lit(i).cast("bigint")), F.lit(0))
        return F.when(F.size(s) > 0, _bound(_run_lengths(s), lambda m: F.array(*[(n(m, i) - n(m, i + size)).cast("double") for i in range(size)]))).otherwise(none)

    return _bound(_bound(slots, counts), vectors.norm)


def candidates(concepts: DataFrame, sentences: DataFrame, k: int = 200, require_microbe: bool = True, threshold: float | None = None) -> DataFrame:
    """Sentences near a concept: its k best, of these those from its threshold on, and of these those with a microbe.

    concepts(canonical, node_type, cui, threshold, embedding) are the query set;
    sentences(sentence_id, pmid, sentence, microbes, embedding). Columns of the
    source rows beyond these are not told.
    """
    near = vectors.top_k(concepts.select(F.col("canonical").alias("concept_id"), "embedding"), sentences.select(F.col("sentence_id").alias("vec_id"), "embedding"), k)
    about = concepts.select(F.col("canonical").alias("concept_id"), F.col("node_type").alias("feature_node_type"), F.col("cui").alias("feature_cui"), "threshold")
    least = F.col("threshold") if threshold is None else F.lit(threshold)
    kept = near.join(about, "concept_id").where(F.col("score") >= least)
    rows = kept.join(sentences.select(F.col("sentence_id").alias("vec_id"), "pmid", "sentence", "microbes"), "vec_id")
    if require_microbe:
        rows = rows.where(F.size(F.coalesce("microbes", F.array().cast(sentences.schema["microbes"].dataType))) > 0)
    return rows.select(
        "pmid", "sentence", "microbes", F.col("concept_id").alias("feature_canonical"), "feature_node_type", "feature_cui", F.col("score").alias("retrieval_similarity")
    )
