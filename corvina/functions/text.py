"""Scalar functions on text and on loosely typed values, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

SPACE = r"(?U)\s+"


def literal(text: str) -> str:
    return r"\Q" + text + r"\E"


def any_of(patterns: Iterable[str]) -> str:
    return "(?:" + "|".join(patterns) + ")"


def collapse(text: Column) -> Column:
    """White space of any kind as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def normalize(text: Column) -> Column:
    return collapse(F.lower(F.coalesce(text, F.lit(""))))


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    return reduce(or_, (text.contains(t) for t in terms), F.lit(False))


def count_terms(text: Column, terms: Iterable[str]) -> Column:
    """How many of the terms occur in a text, each once."""
    return reduce(lambda a, b: a + b, (text.contains(t).cast("int") for t in terms), F.lit(0))


def hits(text: Column, terms: Sequence[str]) -> Column:
    """The terms that occur in a text, in the order of the terms."""
    return F.filter(F.array(*[F.when(text.contains(t), F.lit(t)) for t in terms]), lambda x: x.isNotNull())


def first_of(cases: Iterable[tuple[Column, object]], otherwise=None) -> Column:
    """The value of the first case that holds."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def tokens(text: Column) -> Column:
    """The tokens of a normalised text; none of an empty one."""
    return F.array_remove(F.split(text, " "), "")


def word_bound(term: str) -> str:
    return rf"\b{literal(term)}\b"


# Missing and loosely typed values.


def present(value: Column) -> Column:
    """null for a missing value: null, empty or NA."""
    text = value.cast("string")
    return F.when(~text.isin("", "NA"), text)


def impact_factor(value: Column) -> Column:
    """A positive number or null."""
    number = present(value).try_cast("double")
    return F.when((number > 0) & ~F.isnan(number), number)


def quartile_number(value: Column) -> Column:
    digits = F.regexp_extract(F.upper(F.trim(present(value))), r"^Q?([0-9]+)$", 1)
    return F.when(digits != "", digits).try_cast("int")


def quartile(value: Column) -> Column:
    """Q1 to Qn, or null."""
    return F.when(quartile_number(value).isNotNull(), F.concat(F.lit("Q"), quartile_number(value).cast("string")))


def safe_float(value: Column) -> Column:
    return F.when(value != "", value).try_cast("double")


def safe_int(value: Column) -> Column:
    """Through a number, cut towards zero."""
    return safe_float(value).try_cast("bigint").try_cast("int")


def safe_bool(value: Column) -> Column:
    return F.when(value.isNotNull() & (value != ""), F.lower(F.trim(value)).isin("true", "1", "yes"))


def stable_id(*parts: Column | str) -> Column:
    """The first 16 hex digits of the sha1 of the parts joined by |; a null part counts as empty."""
    columns = [F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.substring(F.sha1(F.concat_ws("|", *columns)), 1, 16)


# Sentences and chunks.


def sentences(text: Column) -> Column:
    """Sentences of a text: cut after . ! or ? and white space, trimmed, without empty ones."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def chunks(sentence: Column, size: int = 100, stride: int = 70) -> Column:
    """Overlapping chunks of size words, one every stride words, until the end is covered; a short sentence is one chunk."""
    # The words are bound once for all chunks of a sentence.
    cut = F.transform(
        F.array(F.array_remove(F.split(collapse(sentence), " "), "")),
        lambda w: F.transform(
            F.sequence(F.lit(0), F.greatest(F.ceil((F.size(w) - size) / F.lit(stride)).cast("int"), F.lit(0))),
            lambda i: F.array_join(F.slice(w, i * stride + 1, F.lit(size)), " "),
        ),
    )
    return F.filter(F.get(cut, F.lit(0)), lambda x: x != "")


# Detection by vocabularies.


def modality(text: Column, terms: Sequence[tuple[str, str]] = vocab.MODALITIES, whole_words: bool = False) -> Column:
    """The first term's modality, in the order of the terms; as a part of the text, or as whole words only."""
    low = normalize(text)
    return first_of((low.rlike(word_bound(t)) if whole_words else low.contains(t), label) for t, label in terms)


def body_location(text: Column, terms: Sequence[str] = vocab.BODY_LOCATIONS) -> Column:
    low = normalize(text)
    return first_of((low.rlike(word_bound(t)), t) for t in terms)


def _disease_in(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(vocab.DISEASE), 1), normalize)

    def stays(x: Column) -> Column:
        words = F.split(x, " ")
        inner = F.slice(words, 1, F.size(words) - 1)
        context = F.arrays_overlap(inner, F.array(*map(F.lit, vocab.DISEASE_CONTEXT_STOPWORDS)))
        return ~F.get(words, F.lit(0)).isin(*vocab.DISEASE_LEAD_STOPWORDS) & ~((F.size(words) > 3) & context)

    return F.get(F.filter(found, stays), F.lit(0))


def disease(sentence: Column, title: Column) -> Column:
    """The first disease phrase of the sentence, else of the title, that does not start or go on like running text."""
    return F.coalesce(_disease_in(sentence), _disease_in(title))


def claim_hint(sentence: Column, title: Column) -> Column:
    low = normalize(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(sentence, F.lit(""))))
    return first_of((contains_any(low, terms), hint) for hint, terms in vocab.CLAIM_HINTS)


def binomial(text: Column) -> Column:
    """The first binomial of a known genus."""
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(vocab.BINOMIAL), 1), normalize)
    words = lambda x: F.split(x, " ")
    known = F.filter(found, lambda x: F.get(words(x), F.lit(0)).isin(*vocab.GENERA) & ~F.element_at(words(x), -1).isin(*vocab.MICROBE_STOPWORDS))
    return F.get(known, F.lit(0))


def subject(text: Column, fallback: bool = False) -> Column:
    """struct(type, name): a known binomial, a genus, a signature (longest first) or, as a fallback, the text as a microbe."""
    low = normalize(text)
    genus = first_of((low.rlike(word_bound(g)), g) for g in sorted(vocab.GENERA))
    signature = first_of((low.contains(s), s) for s in sorted(vocab.SIGNATURES, key=len, reverse=True))
    microbe = F.coalesce(binomial(text), genus)
    last = F.when(low != "", low) if fallback else F.lit(None).cast("string")
    kind = F.when(low == "", None).when(microbe.isNotNull(), "Microbe").when(signature.isNotNull(), "MicrobialSignature").when(last.isNotNull(), "Microbe")
    return F.struct(kind.alias("type"), F.when(low != "", F.coalesce(microbe, signature, last)).alias("name"))


def feature_family(feature: Column) -> Column:
    return F.when(normalize(feature).isin(*vocab.BODYCOMP_CANONICAL), "body_composition").otherwise("radiomic")


def feature_node_type(feature: Column) -> Column:
    return F.when(normalize(feature).isin(*vocab.BODYCOMP_CANONICAL), "BodyCompositionFeature").otherwise("RadiomicFeature")


def phenotype_context(text: Column) -> Column:
    return contains_any(normalize(text), (*vocab.RADIOMICS_CONTEXT, *vocab.BODYCOMP_CONTEXT))


# Relation labels.


def relation_label(answer: Column) -> Column:
    """positive, negative or unrelated, from a model's answer."""
    low = F.lower(F.trim(F.coalesce(answer, F.lit(""))))
    first = F.regexp_replace(F.regexp_extract(low, r"^(\S+)", 1), r"""^[()\[\]{}:;,."']+|[()\[\]{}:;,."']+$""", "")
    return (
        F.when(first == "a", "positive")
        .when(first == "b", "negative")
        .when(first.isin("c", "d"), "unrelated")
        .when(low.contains("positive"), "positive")
        .when(low.contains("negative"), "negative")
        .otherwise("unrelated")
    )


def marker_label(sentence: Column, positive: Sequence[str] = vocab.POSITIVE_MARKERS, negative: Sequence[str] = vocab.NEGATIVE_MARKERS) -> Column:
    """The offline labeller: more positive or more negative markers; unrelated at a tie."""
    low = F.lower(F.coalesce(sentence, F.lit("")))
    plus, minus = count_terms(low, positive), count_terms(low, negative)
    return F.when(plus > minus, "positive").when(minus > plus, "negative").otherwise("unrelated")


def temperatures(n: int = 7, low: float = 0.45, high: float = 0.85) -> list[float]:
    return [0.7] if n <= 1 else [round(low + (high - low) * i / (n - 1), 3) for i in range(n)]


def topology(caption: Column, keywords: dict[str, Sequence[str]] = vocab.TOPOLOGY_KEYWORDS, image: dict[str, Column] | None = None) -> Column:
    """struct(topology, confidence, hits) of a figure's caption; image: scores that a picture gives, by topology.

    Ties go to the topology named first; without any hit it is unknown.
    """
    low = normalize(caption)
    scores = {t: F.least(F.lit(1.0), count_terms(low, words) * F.lit(vocab.TOPOLOGY_WEIGHTS.get(t, 0.2))) for t, words in keywords.items()}
    for t, score in (image or {}).items():
        scores[t] = F.greatest(scores[t], score)
    best = F.greatest(*scores.values())
    named = first_of([(best == 0, "unknown"), *((s == best, t) for t, s in scores.items())])
    found = F.concat(*[F.transform(hits(low, words), lambda x: F.concat(F.lit("kw:"), x)) for words in keywords.values()])
    return F.struct(named.alias("topology"), F.round(best, 3).alias("confidence"), found.alias("hits"))


def json_object(text: Column) -> Column:
    """The text if it is a JSON object, else what stands from the first { to the last } if that is one, else null."""
    whole = F.trim(text)
    inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    good = lambda x: F.when(x.startswith("{") & F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(good(whole), good(F.when(inner != "", inner)))


def read_only(statement: str) -> str:
    """The statement itself; an error if it has a writing clause."""
    for clause in vocab.WRITE_CLAUSES:
        if clause in statement.upper():
            raise ValueError(f"{clause.strip()!r} writes: {statement!r}")
    return statement


def writes(statement: Column) -> Column:
    """The first writing clause that a statement has, in the order of the clauses; null for one that only reads."""
    upper = F.upper(statement)
    return first_of((upper.contains(c), c.strip()) for c in vocab.WRITE_CLAUSES)


def escape_quotes(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))


