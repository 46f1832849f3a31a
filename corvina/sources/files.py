"""Sources and sinks: JSON lines, CSV with a fixed header, full texts, figures, manifests, and harvested HTML and XML."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text, vocab


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, tolerant: bool = False) -> DataFrame:
    """JSON lines under a schema. Strict: a malformed line is an error. Tolerant: it is left out, and a missing file is empty."""
    if tolerant and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> int:
    """Writes JSON lines with nulls; returns the rows written, counted in the same pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def read_relationships(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in vocab.RELATIONSHIP_COLUMNS])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path).na.fill("")


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """A fixed header: other columns are ignored, missing ones are empty."""
    df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def write_manifest(spark: SparkSession, path: str, stage: str, params: dict, metrics: dict, outputs: dict, at: str, command: str = "") -> None:
    """One JSON line on a run, with the command that started it."""
    row = json.dumps({"stage": stage, "generated_at": at, "params": params, "metrics": metrics, "outputs": outputs, "command": command}, sort_keys=True)
    spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def with_metrics(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """df whose next action also gives metrics, without another pass."""
    seen = Observation()
    return df.observe(seen, *[m.alias(k) for k, m in metrics.items()]), seen


def paper_text(papers: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """papers with content and source_text: the full text of full_text_path from texts(path, value), else title and abstract, else title."""
    filled = lambda c: F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.trim(c))
    full = F.lit(None).cast("string")
    if texts is not None:
        t = texts.select(F.col("path").alias("_p"), F.col("value").alias("_v"))
        papers = papers.join(t, F.col("full_text_path") == F.col("_p"), "left")
        full = filled(F.col("_v"))
    title, abstract = filled(F.col("title")), filled(F.col("abstract"))
    short = F.when(abstract.isNotNull(), F.concat_ws(". ", title, abstract))
    source = F.when(full.isNotNull(), "full_text").when(abstract.isNotNull(), "title_abstract").when(title.isNotNull(), "title").otherwise("empty")
    return papers.withColumns({"content": F.coalesce(full, short, title, F.lit("")), "source_text": source}).drop("_p", "_v")


# HTML.

_SKIPPED, _BLOCKS = ("script", "style", "noscript"), ("p", "div", "section", "article", "br", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table")


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skipping = 0

    def handle_starttag(self, tag, attrs):
        self.skipping += tag in _SKIPPED
        if tag in _BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in _SKIPPED and self.skipping:
            self.skipping -= 1
        elif tag in _BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.skipping:
            self.parts.append(data)


def _ends(reference: re.Match) -> str:
    known = reference[1] and (reference[1].startswith("#") or reference[1] in html5)
    return reference[0] if known else "&amp;" + reference[0][1:]


def html_to_text(html: str | None, bare: bool = True) -> str:
    """The text of a page; references such as &amp count without their semicolon too, unless bare is False."""
    parser = _Text()
    parser.feed((html or "") if bare else re.sub(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[a-zA-Z][a-zA-Z0-9]*;)?", _ends, html or ""))
    parser.close()
    return " ".join("".join(parser.parts).split())


def article_text(html: Column, bare: bool = True) -> Column:
    """Text of an article's page, from the first "abstract" to the last "references" where there are such words; bare as in html_to_text()."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda h: html_to_text(h, bare))

    def cut(t: Column) -> Column:
        start = F.greatest(F.locate("abstract", F.lower(t)), F.lit(1))
        tail = F.locate("secnerefer", F.reverse(F.lower(t)))
        end = F.when(tail > 0, F.length(t) - tail - 9).otherwise(F.length(t))
        return F.trim(F.when(end > start, F.substring(t, start, end - start + 1)).otherwise(F.substring(t, start, F.length(t))))

    return F.get(F.transform(F.array(run(html)), cut), F.lit(0))


IMAGE = r"""(?i)<img[^>]*?\ssrc=["']([^"'>]+\.(?:jpg|jpeg|png|gif))["']"""
CAPTION = r"""(?is)<figcaption[^>]*>(.*?)</figcaption>|<p[^>]+class="[^"]*caption[^"]*"[^>]*>(.*?)</p>"""
SUPPLEMENT = r"(?i)^(?:M\d+|S\d+|supp|supplementary)"


def figure_rows(pages: DataFrame, html: str = "html", pattern: str = IMAGE) -> DataFrame:
    """pages with figure_index, figure_url, fig_label and caption: images in order, once each, with the caption at the same place; supplementary files are left out.

    The label is the figure's in the file's name, such as Fig6, else the name.
    Where the pattern finds nothing, images in elements of class fig are taken.
    """
    whole = F.coalesce(html, F.lit(""))
    name = lambda u: F.regexp_extract(u, r"([^/]*)$", 1)
    found = F.filter(F.array_distinct(F.regexp_extract_all(whole, F.lit(pattern), 1)), lambda u: ~name(u).rlike(SUPPLEMENT))
    older = F.array_distinct(F.regexp_extract_all(whole, F.lit(r"""(?is)<div[^>]+class="[^"]*\bfig\b[^"]*"[^>]*>.*?<img[^>]*?src=["']([^"'>]+)["']"""), 1))
    urls = F.when(F.size(found) > 0, found).otherwise(older)
    plain = lambda c: text.collapse(F.regexp_replace(c, "<[^>]+>", " "))
    told = F.zip_with(F.regexp_extract_all(whole, F.lit(CAPTION), 1), F.regexp_extract_all(whole, F.lit(CAPTION), 2), lambda a,
        b: plain(F.coalesce(F.nullif(a, F.lit("")), b, F.lit(""))))
    captions = F.filter(told, lambda c: c != "")
    rows = pages.select(*[c for c in pages.columns if c != html], captions.alias("_c"), F.posexplode(urls).alias("figure_index", "figure_url"))
    stem = F.regexp_replace(name(F.col("figure_url")), r"\.[^.]*$", "")
    label = F.regexp_extract(stem, r"(?i)(Fig\d+|f\d+|g\d+)", 1)
    return rows.withColumns({"fig_label": F.when(label != "", label).otherwise(stem), "caption": F.get("_c", F.col("figure_index"))}).drop("_c")


def match_figure(label: Column, labels: Column) -> Column:
    """The first of labels that holds the label or is held by it, else with the same number, else at the number's place."""
    low = text.normalize(label)
    number = F.regexp_extract(low, r"([0-9]+)", 1)
    part = F.get(F.filter(labels, lambda x: F.contains(text.normalize(x), low) | F.contains(low, text.normalize(x))), F.lit(0))
    token = F.get(F.filter(labels, lambda x: (number != "") & (F.regexp_extract(x, r"([0-9]+)", 1) == number)), F.lit(0))
    place = F.when(number != "", F.get(labels, number.try_cast("int") - 1))
    return F.coalesce(F.when(low != "", part), token, place)


def absolute_url(url: Column, base: str = "https://example.org") -> Column:
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(url)


# Bibliographic XML and queries.


def article_fields(xml: Column) -> Column:
    """struct(pmid, title, abstract, year, doi) of an article's XML; the year is that of the issue, the article or the medline date."""
    path = lambda p: F.nullif(F.trim(F.xpath_string(xml, F.lit(p))), F.lit(""))
    dated = F.regexp_extract(F.coalesce(path("//PubDate/MedlineDate"), F.lit("")), r"([0-9]{4})", 1)
    year = F.coalesce(path("//JournalIssue/PubDate/Year"), path("//ArticleDate/Year"), F.nullif(dated, F.lit("")))
    abstract = F.nullif(F.array_join(F.transform(F.xpath(xml, F.lit("//Abstract/AbstractText/text()")), lambda x: F.trim(x)), " "), F.lit(""))
    doi = F.coalesce(path("//ELocationID[@EIdType='doi']"), path("//ArticleId[@IdType='doi']"))
    return F.struct(path("//PMID").alias("pmid"), path("//ArticleTitle").alias("title"), abstract.alias("abstract"), year.try_cast("int").alias("year"), doi.alias("doi"))


def build_query(all_of: Sequence[Sequence[str]], none_of: Sequence[str] = (), language: str | None = "english") -> str:
    """A boolean query: groups of alternatives that must all match, and terms that must not."""
    quoted = lambda t: f'"{t}"' if " " in t else t
    out = " AND ".join("(" + " OR ".join(map(quoted, g)) + ")" for g in all_of)
    if language:
        out += f" AND {language}[Language]"
    return out + (" NOT (" + " OR ".join(map(quoted, none_of)) + ")" if none_of else "")


def matches_query(content: Column, all_of: Sequence[Sequence[str]], none_of: Sequence[str] = ()) -> Column:
    """The same query as a predicate on a local corpus."""
    low = F.lower(F.coalesce(content, F.lit("")))
    out = F.lit(True)
    for group in all_of:
        out &= text.contains_any(low, [t.lower() for t in group])
    return out & ~text.contains_any(low, [t.lower() for t in none_of])


def date_windows(counts, first: str, last: str, cap: int = 9998) -> list[tuple[str, str]]:
    """Date ranges with at most cap results each, by halving; counts(first, last) asks the service. One day is never halved."""
    from datetime import date, timedelta

    a, b = date.fromisoformat(first), date.fromisoformat(last)
    if a >= b or counts(first, last) <= cap:
        return [(first, last)]
    mid = a + (b - a) // 2
    return date_windows(counts, first, mid.isoformat(), cap) + date_windows(counts, (mid + timedelta(days=1)).isoformat(), last, cap)


def split_statements(script: str) -> list[str]:
    """Statements of an import script, without comments."""
    lines = [x for x in script.splitlines() if not x.lstrip().startswith("//")]
    return [s.strip() for s in re.split(r";\s*(?:\n|$)", "\n".join(lines)) if s.strip()]


def images(spark: SparkSession, path: str, kinds: str = "*.{png,jpg,jpeg,bmp,tif,tiff,webp}") -> DataFrame:
    """figure_id, pmid, caption and image of the pictures under a folder; the pmid is in the file's name or its folder's."""
    df = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", kinds).load(path)
    name, parent = F.regexp_extract("image.origin", r"([^/]*)$", 1), F.regexp_extract("image.origin", r"([^/]*)/[^/]*$", 1)
    number = lambda c: F.nullif(F.regexp_extract(c, r"(\d{6,9})", 1), F.lit(""))
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return df.select(text.stable_id(F.col("image.origin")).alias("figure_id"), F.coalesce(number(name), number(parent)).alias("pmid"), stem.alias("caption"), "image")
