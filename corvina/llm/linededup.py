"""Line dedup by site-relative frequency.

For each host, the pages that contain a line are divided by the pages of the
host; lines above a boilerplate ratio are dropped from the host's pages. Pages
of a host with the same text are one page: copies alone make no boilerplate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import content_key, extra_columns, quoted


def _keys(text: str) -> str:
    """SQL for the trimmed lines of a text as structs of 128 bits, in order."""
    line = "trim(BOTH ' \t\r' FROM l)"
    return f"transform(split({text}, '\n'), l -> struct(xxhash64({line}) AS h1, xxhash64(1, {line}, 7) AS h2, {line} = '' AS blank))"


def boilerplate_lines(df: DataFrame, host: str, text: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, h1, h2, pages, total) of the lines above the ratio; a null host is a host of its own.

    Counts are taken over all distinct texts of a host, told by 128 bits. Each
    step combines before its shuffle and the first is dealt by page and line, so a host,
    a line or a text that holds a third of all rows is no hot task.
    """
    pages = df.select(quoted(host).alias("host"), content_key(quoted(text)).alias("page"), F.coalesce(quoted(text), F.lit("")).alias("t"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("total"))
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.expr(_keys("t")))).alias("l")).where("not l.blank")
    once = lines.select("host", "page", "l.h1", "l.h2").distinct()
    counts = once.groupBy("host", "h1", "h2").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    t = totals.withColumnRenamed("host", "of")
    joined = counts.join(t, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    return joined.where(F.col("pages") > F.col("total") * F.lit(ratio))


def line_dedup(df: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.02, min_pages: int = 5) -> DataFrame:
    """df with the boilerplate lines of each host removed from the text.

    A line (without surrounding blanks) goes if more than ratio of its host's
    pages and at least min_pages of them contain it; a page counts once however
    often it repeats the line, and so do all pages of a host with the same text. Blank lines are never counted or dropped. Adds
    n_lines and n_dropped (long) and replaces the text; no row is dropped, so a
    page of nothing but boilerplate stays with an empty text. A null text is
    empty text with one blank line. Equal rows get equal results, a null host
    is one host, and an empty table gives an empty result.

    Only the pages' keys and line hashes are shuffled for the counts; the texts
    are shuffled once, to meet their dropped lines, or not at all where Spark
    finds these small enough to broadcast at run time.
    """
    made = ("n_lines", "n_dropped", text)
    rest = [quoted(c) for c in extra_columns(df, *made)]
    bad = boilerplate_lines(df, host, text, ratio, min_pages).select("host", "h1", "h2")
    whole = F.coalesce(quoted(text), F.lit(""))
    page = F.struct(F.xxhash64(quoted(host), whole).alias("a"), F.xxhash64(F.lit(1), quoted(host), whole, F.lit(7)).alias("b"))
    # Equal pages of a host share their lines: each is looked up once.
    lines = (
        df.select(page.alias("page"), quoted(host).alias("on"), F.posexplode(F.expr(_keys("coalesce(`" + text.replace("`", "``") + "`, '')"))).alias("at", "l"))
        .where("not l.blank")
        .select("page", "on", "at", "l.h1", "l.h2")
    )
    b = bad.select(F.col("host"), F.col("h1").alias("g1"), F.col("h2").alias("g2"))
    found = lines.join(b, F.col("on").eqNullSafe(F.col("host")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    gone = found.groupBy(F.col("page.a").alias("_cv_a"), F.col("page.b").alias("_cv_b")).agg(F.collect_set("at").alias("_cv_gone"))
    wide = df.select(*rest, whole.alias("_cv_t"), page.alias("_cv_page"))
    wide = wide.join(gone, (F.col("_cv_page.a") == F.col("_cv_a")) & (F.col("_cv_page.b") == F.col("_cv_b")), "left")
    # The lines are bound once; indices that stay are found by hashing.
    kept = "transform(array(split(_cv_t, '\n')), ls -> array_join(transform(array_except(sequence(0, size(ls) - 1), _cv_gone), i -> get(ls, i)), '\n'))[0]"
    return wide.select(
        *rest,
        F.expr(f"if(_cv_gone IS NULL, _cv_t, {kept})").alias(text),
        (F.length("_cv_t") - F.length(F.replace("_cv_t", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("_cv_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
