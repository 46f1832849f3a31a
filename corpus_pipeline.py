"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. Other columns of docs are left out, whatever
their names; ids, languages and sources may be null, and rows that repeat an id
are rows of their own. An empty table goes through every stage as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.llm import bpe, decontam, linededup, minhash, quality
from corvina.llm.common import scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _retold(df: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows a text that was changed."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The cleaned texts of documents that the rules keep; a null, empty or short text goes."""
    judged = quality.quality(docs.select(*COLUMNS))
    return _retold(judged.where("kept").withColumn("text", F.col("cleaned_text")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; one of nothing else stays with an empty text, as does a null text."""
    return _retold(linededup.line_dedup(docs.select(*COLUMNS)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group; texts without words are in none and stay, and so do rows that repeat that id."""
    return minhash.near_dedup(docs.select(*COLUMNS), size=5, percent=80).where("kept").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of the benchmark; null and empty texts leak nothing, and an empty benchmark lets all stay."""
    return decontam.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text again; a null or empty text has none and is decoded to nothing."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # Written in between: a task never has two Python workers with tables of their own at once.
    both = bpe.decode(scratch(bpe.encode(docs.select(*COLUMNS), ranks)), ranks)
    whole = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return both.select("doc_id", "lang", "source", "tokens", F.size("tokens").cast("long").alias("n_tokens"), (F.col("decoded") == whole).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("tokens", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs if docs.columns == list(COLUMNS) else docs.select(*COLUMNS), sf_dir)
        if stage is not bpe_tokens:
            docs = scratch(docs)
    return docs


#: Signatures, templates and merges are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None
