"""Fill-in-middle transformation in Spark SQL functions.

A text is cut into units, a word with the blanks before it, or blanks at the
end. Two numbers of a hash of the row's id cut the units into prefix, middle and
suffix, two more decide whether and in which arrangement they are told. No
arrangement is made of a text in which a sentinel stands, so that the sentinels
of an output always restore its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import extra_columns, quoted

#: The units of a text, and the sentinels before prefix, suffix and middle.
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINEL = "<[PSM]>"


def units(text: Column) -> Column:
    """The units of a text; joined they are the text again."""
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def draws(id: Column, seed: str) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of seed:id."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text of an output: its parts between the sentinels, put back in the order prefix, middle, suffix."""
    part = F.split(output, SENTINEL, -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(df: DataFrame, id: str = "doc_id", text: str = "text", seed: str = "42", percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """df with n (units, long), form (plain, psm or spm), prefix_chars, middle_chars (long, code points), output and restored.

    percent of the texts are arranged, spm_percent of them suffix first. Columns
    of df with such names are replaced. A null or empty text is plain, with an
    empty output and no units; so is a text that holds a sentinel, whatever its
    numbers. A null id counts as an empty one. Each row is told by its own id and
    text alone: rows that repeat an id are cut alike, ties and other columns
    change nothing, and an empty table gives an empty result. A very long text
    costs time and memory in proportion to its length, in one task.
    """
    made = ("n", "form", "prefix_chars", "middle_chars", "output", "restored")
    # All of the row is held in one column meanwhile, so that no name of its own can clash.
    given = F.struct(*[quoted(c) for c in extra_columns(df, *made)]).alias("_cv_row")
    h1, h2, h3, h4 = draws(F.col("_cv_id"), seed)
    row = df.select(given, quoted(id).alias("_cv_id"), F.coalesce(quoted(text), F.lit("")).alias("_cv_t"))
    cut = row.select("_cv_row", "_cv_t", units(F.col("_cv_t")).alias("_cv_u"), *[h.alias(f"_cv_h{i}") for i, h in enumerate((h1, h2, h3, h4), 1)])
    places = F.size("_cv_u").cast("bigint") + 1
    plain = (F.col("_cv_t") == "") | (F.col("_cv_h3") % 100 >= percent) | F.col("_cv_t").rlike(SENTINEL)
    told = cut.select(
        "_cv_row",
        "_cv_t",
        "_cv_u",
        (places - 1).alias("n"),
        F.when(plain, "plain").when(F.col("_cv_h4") % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
        F.least(F.col("_cv_h1") % places, F.col("_cv_h2") % places).cast("int").alias("_cv_a"),
        F.greatest(F.col("_cv_h1") % places, F.col("_cv_h2") % places).cast("int").alias("_cv_b"),
    )
    run = lambda start, length: F.array_join(F.slice("_cv_u", start, length), "")
    a, b = F.col("_cv_a"), F.col("_cv_b")
    parts = F.struct(run(F.lit(1), a).alias("p"), run(a + 1, b - a).alias("m"), run(b + 1, F.size("_cv_u") - b).alias("s"))
    three = told.select("_cv_row", "_cv_t", "n", "form", F.when(F.col("form") != "plain", parts).alias("_cv_x"))
    p, m, s = (F.col(f"_cv_x.{c}") for c in "pms")
    psm = F.concat(F.lit(PREFIX), p, F.lit(SUFFIX), s, F.lit(MIDDLE), m)
    spm = F.concat(F.lit(SUFFIX), s, F.lit(PREFIX), p, F.lit(MIDDLE), m)
    out = three.select(
        "_cv_row",
        "n",
        "form",
        F.length(p).cast("bigint").alias("prefix_chars"),
        F.length(m).cast("bigint").alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("_cv_t")).alias("output"),
    )
    return out.select("_cv_row.*", *made[:5], restored(F.col("output"), F.col("form")).alias("restored"))


def digests(df: DataFrame) -> DataFrame:
    """The columns of a transformed table, with hashes of output and restored text in place of both."""
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output"), sha("restored"))
