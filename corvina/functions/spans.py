"""Cleaning of entity spans. Every function gives struct(canonical, reason): one of them is null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import any_of, collapse, contains_any, first_of, literal, normalize, tokens


def _words(terms: Iterable[str]) -> str:
    return any_of(literal(t) for t in terms)


def _bound(expression: Column, body) -> Column:
    """body(x) with x bound to the value of an expression, evaluated once."""
    return F.get(F.transform(F.array(expression), body), F.lit(0))


def _result(canonical: Column, reason: Column) -> Column:
    return F.struct(F.when(reason.isNull(), canonical).alias("canonical"), reason.alias("reason"))


def normalize_span(text: Column) -> Column:
    """White space collapsed, surrounding quotes and brackets and then blanks and , ; : . taken off."""
    inner = F.regexp_replace(collapse(F.coalesce(text, F.lit(""))), r"""^["'`\[\]{}()]+|["'`\[\]{}()]+$""", "")
    return collapse(F.regexp_replace(inner, r"^[ ,;:.]+|[ ,;:.]+$", ""))


def _without_trailing(text: Column, terms: Iterable[str]) -> Column:
    return F.regexp_replace(text, rf"(?:(?:^|\s+){_words(terms)})+$", "")


def generic_microbe(text: Column) -> Column:
    words = F.split(text, " ")
    n = F.size(words)
    return (
        text.isin(*vocab.GENERIC_MICROBES)
        | F.get(words, F.lit(0)).isin("bacterial", "microbial")
        | ((n <= 5) & F.element_at(words, -1).isin("bacteria", "bacterial", "microbes", "microbiome", "microbiota"))
        | text.rlike(r"^(?:bacteria|bacterial|microbial)(?:[-\s]|$)")
    )


def clean_subject(text: Column, node_type: Column | None = None) -> Column:
    """A subject's canonical name. Only microbes lose trailing context words and numbers and may be generic."""
    microbe = F.lit(True) if node_type is None else F.coalesce(node_type, F.lit("Microbe")) == "Microbe"
    trailing = (*vocab.MICROBE_TRAILING, *vocab.TRAILING_STOPS, *vocab.SUBJECT_FRAGMENTS)

    def cleaned(norm: Column) -> Column:
        bare = F.trim(F.regexp_replace(_without_trailing(norm, trailing), r"(?:(?:^|\s+)[0-9]+)+$", ""))
        return F.when(microbe, bare).otherwise(norm)

    def judged(text: Column) -> Column:
        product = F.regexp_extract(text, rf"^(\w+)-containing\s+{_words(vocab.PRODUCT_SUFFIXES)}$", 1)
        name = F.when(microbe & (product != ""), product).otherwise(text)
        reason = first_of(
            [(text == "", "missing_subject_node"), (text.contains("##"), "subject_wordpiece_fragment"), (microbe & generic_microbe(name), "generic_microbe_term")]
        )
        return _result(name, reason)

    return _bound(F.lower(normalize_span(text)), lambda norm: _bound(cleaned(norm), judged))


def clean_disease(text: Column) -> Column:
    """A disease's canonical name; prefixes, context words and findings are cut off, clauses are rejected."""

    def trimmed(low: Column) -> Column:
        for pattern in vocab.LEADING_PREFIXES:
            low = F.regexp_replace(low, pattern, "")
        low = F.trim(low)
        low = F.regexp_replace(low, rf"^(?:{_words(vocab.LEADING_CONTEXT)}\s+)+(?=\S)", "")
        return F.trim(_without_trailing(_without_trailing(low, vocab.DISEASE_TRAILING), vocab.TRAILING_STOPS))

    def told(text: Column) -> Column:
        known = F.trim(F.regexp_extract(text, vocab.FINDING_IN_DISEASE, 2))
        return F.when(known != "", known).otherwise(text)

    def judged(text: Column) -> Column:
        words = tokens(text)
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        has = lambda terms: F.arrays_overlap(words, F.array(*map(F.lit, terms)))
        clause = "disease_clause_like"
        reason = first_of(
            [
                (text == "", "missing_disease"),
                (text.contains("##"), "disease_wordpiece_fragment"),
                (text.isin(*vocab.GENERIC_DISEASES), "generic_disease_term"),
                (F.get(words, F.lit(0)).isin(*vocab.LEADING_CONTEXT) & (n > 2), clause),
                (has(vocab.RELATION_LANGUAGE), "disease_relation_language"),
                ((distinct > 4) & has(vocab.CLAUSE_PRONOUNS), clause),
                ((n > 4) & has(vocab.CLAUSE_VERBS), clause),
                ((n > 5) & has(vocab.DISEASE_CONTEXT), clause),
                (n >= 8, clause),
            ]
        )
        return _result(text, reason)

    return _bound(F.lower(normalize_span(text)), lambda low: _bound(trimmed(low), lambda t: _bound(told(t), judged)))


def clean_text_disease(text: Column) -> Column:
    """clean_disease, then leading articles and known variants, then clean_disease again."""

    def again(one: Column) -> Column:
        name = F.regexp_replace(one["canonical"], r"^(?:a|an|the|this|that)\s+(?=\S)", "")
        for pattern in vocab.DISEASE_NORMALIZED:
            name = F.trim(F.regexp_replace(name, pattern, ""))
        for variant, common in vocab.DISEASE_ALIASES.items():
            name = F.when(name == variant, common).otherwise(name)
        return F.when(one["reason"].isNotNull(), one).otherwise(clean_disease(name))

    return _bound(clean_disease(text), again)


def eligible_disease(disease: Column) -> Column:
    """Whether a disease may be a node of the graph."""

    def judged(text: Column) -> Column:
        leaked = _words(vocab.LEAKED_PHENOTYPES)
        context = F.arrays_overlap(tokens(text), F.array(*map(F.lit, vocab.DISEASE_CONTEXT_REJECT)))
        bad = (
            text.isin("", "inflammation", *vocab.DISEASE_REJECT)
            | text.rlike("^" + any_of(vocab.DISEASE_REJECT_PREFIXES))
            | text.rlike(any_of(vocab.DISEASE_REJECT_PARTS))
            | (text.endswith("inflammation") & ~text.isin(*vocab.KEPT_INFLAMMATIONS))
            | text.contains(" and ")
            | text.rlike(rf"^{leaked}(?: |$)| {leaked} ")
            | ((F.size(tokens(text)) > 4) & context)
        )
        return ~bad

    return _bound(normalize(disease), judged)


def clean_pair(sentence: Column, subject: Column, disease: Column, node_type: Column | None = None, max_words: int | None = None, max_chars: int | None = None) -> Column:
    """struct(subject, disease, reason): the sentence is judged first, then the subject, then the disease."""

    def judged(x: Column) -> Column:
        s, d = x["s"], x["d"]
        cases = [(x["t"] == "", F.lit("missing_sentence"))]
        if max_words is not None:
            cases.append((F.size(F.split(x["t"], " ")) >= max_words, F.lit("evidence_too_long_words")))
        if max_chars is not None:
            cases.append((F.length(x["t"]) >= max_chars, F.lit("evidence_too_long_chars")))
        reason = F.coalesce(first_of(cases), s["reason"], d["reason"])
        good = reason.isNull()
        return F.struct(F.when(good, s["canonical"]).alias("subject"), F.when(good, d["canonical"]).alias("disease"), reason.alias("reason"))

    whole = collapse(F.coalesce(sentence, F.lit("")))
    return _bound(F.struct(whole.alias("t"), clean_subject(subject, node_type).alias("s"), clean_disease(disease).alias("d")), judged)


def mention_supported(confidence: Column, feature: Column, evidence: Column, least: float = 0.6) -> Column:
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return (F.coalesce(confidence, F.lit(0.0)) >= least) & filled(feature) & filled(evidence)


def microbe_like(name: Column) -> Column:
    """Whether a name is a microbe's: no generic term and no running text, but with a part that microbes have, or a binomial of a common genus, or an abbreviated one."""

    def judged(x: Column) -> Column:
        low = F.lower(x)
        binomial = F.lower(F.regexp_extract(x, r"^([A-Z][a-z]+)\s[a-z]{2,}$", 1)).isin(*vocab.COMMON_GENERA)
        known = contains_any(low, vocab.MICROBE_PARTS) | binomial | x.rlike(r"^[A-Z]\.\s?[a-z]{2,}$")
        return (x != "") & ~low.isin(*vocab.GENERIC_MICROBES) & ~F.get(F.split(low, r"\s+"), F.lit(0)).isin(*vocab.NOT_MICROBE_FIRST) & known

    return _bound(F.trim(F.coalesce(name, F.lit(""))), judged)
