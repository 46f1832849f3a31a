"""Harvesting: query profiles, a paged search source, downloads with counters, credentials.

Services are reached only through callables that are handed in; without them
everything runs on what is there already.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from operator import and_, or_

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text, vocab
from . import files

# Queries.


def _block(name: str) -> str:
    return "(" + " OR ".join(f"({t}[Title/Abstract])" for t in vocab.SEARCH_BLOCKS[name]) + ")"


def profile_query(name: str, language: str | None = "english") -> str:
    """The text of a profile's query, as a search service takes it."""
    alternatives, primary = vocab.SEARCH_PROFILES[name]
    joined = [" AND ".join(_block(b) if "+" not in b else "(" + " OR ".join(map(_block, b.split("+"))) + ")" for b in blocks) for blocks in alternatives]
    out = joined[0] if len(joined) == 1 else "(" + " OR ".join(f"({j})" for j in joined) + ")"
    if primary:
        out = f"({out}) NOT ((review[Publication Type]) OR " + " OR ".join(f"({t}[Title/Abstract])" for t in vocab.NOT_PRIMARY) + ")"
    return f"({out}) AND ({language}[Language])" if language else f"({out})"


def _matches(low: Column, term: str) -> Column:
    """A term as whole words; * at its end stands for any ending."""
    stem = term.lower().removesuffix("*")
    return low.rlike(r"(?<![a-z0-9])" + text.literal(stem) + ("" if term.endswith("*") else r"(?![a-z0-9])"))


def matches_profile(name: str, title: Column, abstract: Column, kind: Column | None = None) -> Column:
    """A profile as a predicate on a local corpus; kind is the publication type."""
    low = F.lower(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit(""))))
    some = lambda block: reduce(or_, (_matches(low, t) for b in block.split("+") for t in vocab.SEARCH_BLOCKS[b]))
    alternatives, primary = vocab.SEARCH_PROFILES[name]
    out = reduce(or_, (reduce(and_, map(some, blocks)) for blocks in alternatives))
    if primary:
        other = reduce(or_, (_matches(low, t) for t in vocab.NOT_PRIMARY))
        out &= ~other & (~F.coalesce(F.lower(kind).contains("review"), F.lit(False)) if kind is not None else F.lit(True))
    return out


# The search source.


def with_retries(call: Callable, tries: int = 5, wait: Callable[[float], None] = time.sleep) -> Callable:
    """call, tried again after 1, 2, 4, ... seconds, 60 at most; the last error is raised."""

    def run(*args):
        for k in range(tries):
            try:
                return call(*args)
            except Exception:
                if k == tries - 1:
                    raise
                wait(min(60.0, 2.0**k))

    return run


class _Window(InputPartition):
    def __init__(self, first: str, last: str):
        super().__init__((first, last))


def search_source(name: str, count: Callable[[str, str], int], search: Callable[[str, str, int, int], list[str]], fetch: Callable[[list[str]], list[dict]], schema: str,
    page: int = 5000, chunk: int = 200, cap: int = 9998):
    """A data source for spark.read.format(name).option("first", date).option("last", date): one partition per date window under the cap.

    count(first, last) says how many ids a window has, search(first, last,
    offset, page) gives a page of them, and fetch(ids) the rows of a chunk, as
    dictionaries. Calls are repeated after errors; an id that several pages or
    windows give is read once per window.
    """

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.first, self.last = options["first"], options["last"]

        def partitions(self):
            return [_Window(*w) for w in files.date_windows(with_retries(count), self.first, self.last, cap)]

        def read(self, partition):
            first, last = partition.value
            ids: dict[str, None] = {}
            for offset in range(0, with_retries(count)(first, last), page):
                ids.update(dict.fromkeys(with_retries(search)(first, last, offset, page)))
            todo, names = list(ids), [c.split()[0] for c in schema.split(",")]
            for lo in range(0, len(todo), chunk):
                for row in with_retries(fetch)(todo[lo : lo + chunk]):
                    yield tuple(row.get(n) for n in names)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader(self.options)

    return Source


# Downloads.


def download_texts(papers: DataFrame, texts: DataFrame, fetch: Callable[[str], str] | None = None, overwrite: bool = False) -> DataFrame:
    """papers(pmcid, ...) with full_text and download, what became of each: missing_pmcid, reused_existing, downloaded or failed.

    texts(pmcid, full_text) are there already and reused unless overwrite; fetch(pmcid) gives an article's HTML.
    """
    have = texts.select(F.trim("pmcid").alias("_p"), F.col("full_text").alias("_t")).groupBy("_p").agg(F.max("_t").alias("_t"))
    rows = papers.join(have, F.trim("pmcid") == F.col("_p"), "left").drop("_p")
    id_ = F.trim(F.coalesce("pmcid", F.lit("")))
    reuse = F.col("_t").isNotNull() & F.lit(not overwrite)
    rows = rows.withColumn("_todo", F.when((id_ != "") & ~reuse, id_))
    if fetch is not None:

        @F.pandas_udf("string")
        def fetched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield s.map(lambda p: _tried(fetch, p) if p else None)

        rows = rows.withColumn("_html", fetched("_todo"))
    else:
        rows = rows.withColumn("_html", F.lit(None).cast("string"))
    new = F.nullif(files.article_text(F.col("_html")), F.lit(""))
    done = F.when(id_ == "", "missing_pmcid").when(reuse, "reused_existing").when(new.isNotNull(), "downloaded").otherwise("failed")
    return rows.withColumns({"full_text": F.when(reuse, F.col("_t")).otherwise(new), "download": done}).drop("_t", "_todo", "_html")


def _tried(fetch: Callable[[str], str], key: str) -> str | None:
    try:
        return fetch(key) or None
    except Exception:
        return None  # told as failed


def download_counts(downloads: DataFrame) -> DataFrame:
    """One row of counters: total_papers, with_pmcid, downloaded, reused_existing, missing_pmcid, failed."""
    n = lambda s: F.count_if(F.col("download") == s).alias(s)
    kinds = [n(s) for s in ("downloaded", "reused_existing", "missing_pmcid", "failed")]
    return downloads.agg(F.count("*").alias("total_papers"), F.count_if(F.col("download") != "missing_pmcid").alias("with_pmcid"), *kinds)


def download_figures(figures: DataFrame, listed: DataFrame, fetch: Callable[[str], bytes] | None = None, base: str = "https://example.org") -> DataFrame:
    """figures(pmcid, fig_label, figure_url) with figure_id, file, content and download: reused_existing, downloaded or failed.

    listed(file) are there already; fetch(url) gives a picture. An odd suffix counts as .jpg.
    """
    suffix = F.lower(F.regexp_extract(F.regexp_replace("figure_url", r"\?.*$", ""), r"(\.[^./]*)$", 1))
    suffix = F.when(suffix.isin(".jpg", ".jpeg", ".png", ".gif", ".tif", ".tiff", ".webp"), suffix).otherwise(".jpg")
    file = F.concat(F.lower("pmcid"), F.lit("_figures/"), "fig_label", suffix)
    have = listed.select(F.col("file").alias("_f")).distinct().withColumn("_have", F.lit(True))
    rows = figures.withColumns({"figure_id": F.concat_ws("_", "pmcid", "fig_label"), "file": file, "_url": files.absolute_url(F.col("figure_url"), base)})
    rows = rows.join(have, F.col("file") == F.col("_f"), "left").withColumn("_have", F.coalesce("_have", F.lit(False)))

    if fetch is None:
        out = rows.withColumn("content", F.lit(None).cast("binary"))
    else:

        def run(batches):
            for b in batches:
                urls, there = b.column(b.schema.names.index("_url")), b.column(b.schema.names.index("_have"))
                got = [None if h.as_py() else _tried(fetch, u.as_py()) for u, h in zip(urls, there, strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], [*b.schema.names, "content"])

        out = rows.mapInArrow(run, rows.withColumn("content", F.lit(None).cast("binary")).schema)
    done = F.when(F.col("_have"), "reused_existing").when(F.col("content").isNotNull(), "downloaded").otherwise("failed")
    return out.withColumn("download", done).drop("_f", "_have", "_url")


def missing_figures(proposals: DataFrame, listed: DataFrame) -> DataFrame:
    """(figure_id, pmcid, fig_label) of proposals' figures that no listed file shows; ids that name no article are left out."""
    parts = proposals.select("figure_id", F.regexp_extract("figure_id", r"^(PMC\d+)_(.+)$", 1).alias("pmcid"),
        F.regexp_extract("figure_id", r"^(PMC\d+)_(.+)$", 2).alias("fig_label"))
    have = listed.select(F.regexp_replace(F.regexp_extract("file", r"([^/]*)$", 1), r"\.[^.]*$", "").alias("figure_id")).distinct()
    return parts.where("pmcid <> ''").distinct().join(have, "figure_id", "left_anti")


# Settings.


def api_settings(model_id: str | None, base_url: str | None, key: str | None, env: Mapping[str, str],
    special: Mapping[str, tuple[str, str]] | None = None) -> tuple[str | None, str | None]:
    """(base URL, key): what is given goes before the environment, a model's own variables before general ones.

    special maps the beginning of a model's name to (prefix of its variables, its default URL).
    """
    name = (model_id or "").split(":", 1)[0].strip().lower()
    own = next((v for k, v in (special or {}).items() if name.startswith(k)), None)
    first = lambda *values: next((v.strip() for v in values if v and v.strip()), None)
    if own:
        prefix, default = own
        return first(base_url, env.get(f"{prefix}_API_BASE_URL"), default), first(key, env.get(f"{prefix}_API_KEY"), env.get("RELATION_API_KEY"),
            env.get("OPENAI_API_KEY"))
    keys = (env.get(k) for k in ("RELATION_API_KEY", "HUGGINGFACE_API_KEY", "HF_TOKEN", "OPENAI_API_KEY"))
    return first(base_url, env.get("RELATION_API_BASE_URL"), env.get("OPENAI_BASE_URL")), first(key, *keys)
