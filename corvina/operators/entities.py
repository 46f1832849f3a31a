"""Named entities: shaping of taggers' answers, an offline tagger, gates, prompts, and the rows of sentences with pairs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import spans, text, vocab
from . import mentions

ENTITY = "struct<text:string,start:int,end:int,score:double,label:string,extractor:string>"


# Answers of taggers.


def extractor_tag(model_id: Column) -> Column:
    """Which line of models an entity comes from."""
    low = F.lower(F.coalesce(model_id, F.lit("")))
    return text.first_of([(text.contains_any(low, parts), tag) for tag, parts in vocab.EXTRACTOR_TAGS.items()], "ner_pipeline")


def shaped(raw: Column, extractor: Column, label: str = "ENTITY") -> Column:
    """Entities of a tagger's answer, array<struct<word, start, end, score, entity_group>>, each span and text once with its best score.

    Missing or zero places are -1, a missing score is 0; entries without a word go.
    """
    place = lambda x: F.when(F.coalesce(x, F.lit(0)) == 0, -1).otherwise(x).cast("int")
    rows = F.transform(
        F.coalesce(raw, F.array().cast("array<struct<word:string,start:int,end:int,score:double,entity_group:string>>")),
        lambda x: F.struct(
            text.collapse(F.coalesce(x["word"], F.lit(""))).alias("text"), place(x["start"]).alias("start"), place(x["end"]).alias("end"),
            F.coalesce(x["score"], F.lit(0.0)).alias("score"), F.coalesce(F.nullif(x["entity_group"], F.lit("")), F.lit(label)).alias("label"),
                extractor.alias("extractor"),
        ),
    )
    return best_spans(F.filter(rows, lambda x: x["text"] != ""))


def best_spans(rows: Column) -> Column:
    """Entities by (start, end, text in lower case): the best score stays, the first at a tie, at the place of the first."""
    same = lambda a, b: (a["start"] == b["start"]) & (a["end"] == b["end"]) & (F.lower(a["text"]) == F.lower(b["text"]))

    def kept(all_: Column) -> Column:
        first = F.filter(all_, lambda x, i: ~F.exists(F.slice(all_, F.lit(1), i), lambda y: same(x, y)))
        return F.transform(first, lambda x: F.aggregate(F.filter(all_, lambda y: same(x, y)), x, lambda a, y: F.when(y["score"] > a["score"], y).otherwise(a)))

    return F.get(F.transform(F.array(rows), kept), F.lit(0))


def dictionary_tagger(sentences: DataFrame, terms: Mapping[str, str], name: str, column: str = "sentence") -> DataFrame:
    """sentences with a column of entities: whole words and phrases of a dictionary {term: label}, the longest first, without overlaps.

    The offline stand-in for a tagger: a model goes into run() in its place,
    loaded once per task and given whole Arrow batches.
    """
    found = re.compile("|".join(rf"\b{re.escape(t)}\b" for t in sorted(terms, key=len, reverse=True)) or r"(?!)", re.IGNORECASE)
    low = {t.lower(): label for t, label in terms.items()}
    kind = pa.struct([("text", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("label", pa.string()), ("extractor", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.names.index(column)
            rows = [
                [{"text": m[0], "start": m.start(), "end": m.end(), "score": 1.0, "label": low[m[0].lower()],
                    "extractor": "dictionary"} for m in found.finditer(x.as_py() or "")]
                for x in b.column(at)
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.list_(kind))], [*b.schema.names, name])

    return sentences.mapInArrow(run, T.StructType([*sentences.schema, T.StructField(name, T.ArrayType(T.StructType.fromDDL(ENTITY[7:-1])))]))


def entity_sentences(papers: DataFrame, diseases: Mapping[str, str], microbes: Mapping[str, str], content: str = "content") -> DataFrame:
    """(record_id, pmid, sentence, sentence_index, diseases, microbes, paper_title) of sentences with both, cleaned.

    Diseases are looked for first, microbes only in sentences that have one.
    """
    rows = papers.where(F.coalesce("pmid", F.lit("")) != "").select("pmid", "title", F.posexplode(text.sentences(F.col(content))).alias("sentence_index", "sentence"))
    tagged = dictionary_tagger(rows, diseases, "diseases").where(F.size("diseases") > 0)
    both = dictionary_tagger(tagged, microbes, "microbes").where(F.size("microbes") > 0)
    cleaned = lambda c, how: F.filter(
        F.transform(c, lambda x: x.withField("text", F.when(how(x["text"])["reason"].isNull(), how(x["text"])["canonical"]))), lambda x: x["text"].isNotNull()
    )
    out = both.withColumns({"diseases": cleaned("diseases", spans.clean_disease), "microbes": cleaned("microbes", spans.clean_subject)})
    out = out.withColumns({c: best_by_text(F.col(c)) for c in ("diseases", "microbes")}).where((F.size("diseases") > 0) & (F.size("microbes") > 0))
    record = text.stable_id(F.col("pmid"), F.col("sentence_index"), F.col("sentence"))
    return out.select(record.alias("record_id"), "pmid", "sentence", "sentence_index", "diseases", "microbes", F.nullif("title", F.lit("")).alias("paper_title"))


def best_by_text(rows: Column) -> Column:
    """Entities by their text: the best score stays, the first at a tie, at the place of the first."""

    def kept(all_: Column) -> Column:
        first = F.filter(all_, lambda x, i: ~F.exists(F.slice(all_, F.lit(1), i), lambda y: y["text"] == x["text"]))
        return F.transform(first, lambda x: F.aggregate(F.filter(all_, lambda y: y["text"] == x["text"]), x, lambda a,
            y: F.when(y["score"] > a["score"], y).otherwise(a)))

    return F.get(F.transform(F.array(rows), kept), F.lit(0))


# Gates.


def microbe_gate(surfaces: DataFrame, groundings: DataFrame, floor: float = vocab.GROUNDING_FLOOR) -> DataFrame:
    return mentions.ground(surfaces, groundings, vocab.MICROBE_TUIS, vocab.DENIED_CUIS, floor)


def disease_gate(surfaces: DataFrame, groundings: DataFrame, floor: float = vocab.GROUNDING_FLOOR) -> DataFrame:
    return mentions.ground(surfaces, groundings, vocab.DISEASE_TUIS, None, floor)


def feature_gate(surfaces: DataFrame, groundings: DataFrame, floor: float = vocab.GROUNDING_FLOOR) -> DataFrame:
    return mentions.ground(surfaces, groundings, vocab.FEATURE_TUIS, None, floor)


def best_grounding(candidates: DataFrame, tuis: Sequence[str] | None = None) -> DataFrame:
    """(surface, cui, tui, similarity, official_name): per surface the best of its spans' first candidates of an accepted type, the first at a tie.

    candidates(surface, span, rank, cui, tuis, similarity, official_name); a candidate's type is its first.
    """
    first = candidates.where("rank = 0").withColumn("tui", F.get("tuis", F.lit(0)))
    if tuis is not None:
        first = first.where(F.col("tui").isin(*tuis))
    best = first.groupBy("surface").agg(F.max_by(F.struct("cui", "tui", "similarity", "official_name"), F.struct("similarity", -F.col("span"))).alias("b"))
    return best.select("surface", "b.*")


# Prompts.


def relation_prompt(sentence: Column, microbe: Column, disease: Column) -> Column:
    """struct(system, user) of the question which relation a sentence tells."""
    user = F.format_string(vocab.RELATION_EVIDENCE, sentence, microbe, disease)
    return F.struct(F.lit(vocab.RELATION_ROLE + "\n" + vocab.RELATION_LABELS).alias("system"), user.alias("user"))


def chat_prompt(system: Column, user: Column, family: str) -> Column:
    """One text in the form that a family of models takes."""
    low = family.lower()
    form = next((form for names, form in vocab.CHAT_FORMS.items() if any(n in low for n in names)), vocab.PLAIN_FORM)
    return F.format_string(form, system, user)


def verifier_prompt(rows: DataFrame) -> DataFrame:
    """rows(topology, subject, feature, value) with the verifier's question; a missing range is -1 to 1."""
    has = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in rows.columns else F.lit(default)
    told = [has("topology", "heatmap"), has("subject", ""), has("feature", ""), F.col("value").cast("string"), has("value_min", -1.0), has("value_max", 1.0),
        has("subject", ""), has("feature", "")]
    return rows.withColumn("user_prompt", F.format_string(vocab.VERIFIER_QUESTION, *[c.cast("string") for c in told]))
