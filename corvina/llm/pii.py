"""Personal data: base patterns, and contextual extraction bootstrapped from seeds.

Seeds are the base entities and values whose shape alone gives them away as
drawn at random, such as a long hexadecimal key. The words before and after a
value make lexical patterns; patterns and the values that they stand around form
a graph. In each round a pattern is scored, for each kind of seed, by the share
of known values of that kind among its distinct values, and a value by the best
pattern that it stands in; patterns of high confidence make their values known.
In the end identifiers in high-confidence patterns are entities too.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extra_columns, met, quoted, scratch

KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: A run of digits is tried from its start only: from within, it goes on in the same way.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Runs that may hold an identifier that no base pattern knows: once trimmed of marks, six characters or more with a digit.
_CANDIDATE = re.compile(r"[A-Za-z0-9_-]{6,}")
#: Characters that are looked at for the words beside a value; a word that goes on beyond them makes no pattern.
_NEAR = 160
#: The kind of seeds by shape, and their shortest length.
SECRET, SECRET_CHARS = "secret", 20


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; each at sign is met once, with the longest local part before it."""
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            after = m.end()
        else:
            after = max(after, at + 1) if start == at else after
        at = text.find("@", at + 1)
    return found


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base entities of a text, by kind as listed and then start, in code points."""
    if not text:
        return []
    out = [("email", *s) for s in _emails(text)] if "@" in text else []
    if "." in text:
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def drawn_at_random(value: str) -> bool:
    """Whether a long run of letters and digits goes from one to the other as often as only a random one does."""
    if len(value) < SECRET_CHARS or not value.isalnum():
        return False
    digit = [c.isdigit() for c in value]
    return 5 * sum(x != y for x, y in zip(digit, digit[1:], strict=False)) >= len(value)


_DIGITS = re.compile(r"[0-9]+")


def _fold(pattern: str) -> str:
    return _DIGITS.sub("0", pattern.lower()) if any(map(str.isalpha, pattern)) else ""


def _context(text: str, start: int, end: int) -> tuple[str, str]:
    """The patterns before and after a value, in lower case, digits as 0; empty without a letter.

    Before it stands the nearest word with a letter and up to two marks that
    lead from there to the value, as in token = "; after it the next word. ~
    shows where a word is joined to the value.
    """
    left = text[max(0, start - _NEAR) : start]
    words = left.split()
    took = next((k for k in range(1, min(3, len(words)) + 1) if any(map(str.isalpha, words[-k]))), 0)
    before = ""
    if took and (took < len(words) or start <= _NEAR or left[0].isspace()):
        before = " ".join(words[-took:]) + ("" if left[-1].isspace() else "~")
    right = text[end : end + _NEAR]
    words = right.split(None, 1)
    after = ""
    if words and (len(words) > 1 or end + _NEAR >= len(text) or right[-1].isspace()):
        after = ("" if right[0].isspace() else "~") + words[0]
    return _fold(before), _fold(after)


def mentions(text: str | None) -> tuple[list[tuple], list[tuple]]:
    """(base spans; (start, end, kind, before, after) of all base entities and of candidates outside them).

    The kind of a candidate is secret where its shape makes it a seed, else empty.
    """
    base = base_spans(text)
    if not text:
        return base, []
    out = [(s, e, k, *_context(text, s, e)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    i = 0
    for m in _CANDIDATE.finditer(text):
        value = m[0].strip("-_")
        if len(value) < 6 or not any(map(str.isdigit, value)):
            continue
        start = m.start() + len(m[0]) - len(m[0].lstrip("-_"))
        end = start + len(value)
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if i < len(taken) and taken[i][0] < end:
            continue
        out.append((start, end, SECRET if drawn_at_random(value) else "", *_context(text, start, end)))
    return base, out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_MENTION = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("before", pa.string()), ("after", pa.string()), ("value", pa.string())])
_DDL = "base array<struct<kind:string,start:bigint,end:bigint>>, seen array<struct<start:bigint,end:bigint,kind:string,before:string,after:string,value:string>>"


def _read(batches):
    for b in batches:
        base, seen = [], []
        for x in b.column(b.num_columns - 1):
            text = x.as_py()
            spans, found = mentions(text)
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
            seen.append([{"start": s, "end": e, "kind": k, "before": p, "after": q, "value": text[s:e]} for s, e, k, p, q in found])
        made = [pa.array(base, pa.list_(_SPAN)), pa.array(seen, pa.list_(_MENTION))]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], [*b.schema.names[:-1], "_cv_base", "_cv_seen"])


def _sides(*first: str) -> list:
    """The patterns of mentions, one row each."""
    both = F.array(*[F.struct(F.lit(c).alias("side"), F.col(c).alias("word")) for c in ("before", "after")])
    return [*first, F.explode(F.filter(both, lambda p: p["word"] != "")).alias("p")]


def patterns(seen: DataFrame, rounds: int, min_values: int, confidence: float) -> DataFrame:
    """(side, word, kind, confidence) of the patterns of high confidence.

    seen: rows (kind, before, after, value). The graph's edges are the distinct
    (pattern, value) pairs. For each kind of seed, a pattern's confidence is the sum
    of the scores of its values of that kind over the number of all its distinct
    values and one; it has to reach confidence with min_values values or more. A seed scores 1,
    another value as much as the best pattern that it stands in, and it is of that
    pattern's kind. Rounds end early once the values known don't change.
    """
    edges = seen.select(*_sides(F.xxhash64("value").alias("v"), "kind")).select("p.side", "p.word", "v", "kind")
    edges = scratch(edges.groupBy("side", "word", "v").agg(F.max("kind").alias("kind")))
    scored = edges.withColumn("score", F.when(F.col("kind") != "", 1.0).otherwise(0.0))
    before = good = None
    for i in range(rounds):
        sums = scored.groupBy("side", "word", "kind").agg(F.sum("score").alias("known"), F.count("*").alias("n"))
        told = sums.groupBy("side", "word").agg(F.sum("n").alias("n"), F.max_by(F.struct("kind", "known"), F.struct("known", "kind")).alias("top"))
        told = told.select("side", "word", F.col("top.kind").alias("of"), (F.col("top.known") / (F.col("n") + 1)).alias("confidence"), "n")
        good = scratch(told.where((F.col("of") != "") & (F.col("n") >= min_values) & (F.col("confidence") >= confidence)).drop("n"))
        if i == rounds - 1:
            break
        open_ = edges.where("kind = ''").drop("kind")
        best = met(open_, good, ["side", "word"], "v").groupBy("v").agg(F.max_by("of", F.struct("confidence", "of")).alias("of"), F.max("confidence").alias("c"))
        known = scratch(best)
        now = known.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "of", "c"))).first()
        if now == before or not now[0]:
            break
        before = now
        step = met(edges, known, ["v"], "word", "left")
        scored = step.select(
            "side", "word", "v", F.when(F.col("kind") != "", F.col("kind")).otherwise(F.coalesce("of", F.lit(""))).alias("kind"),
                F.when(F.col("kind") != "", 1.0).otherwise(F.coalesce("c", F.lit(0.0))).alias("score")
        )
    return good.withColumnRenamed("of", "kind")


def personal_data(df: DataFrame, text: str = "text", rounds: int = 3, min_values: int = 3, confidence: float = 0.7) -> DataFrame:
    """df, without its text, with base and spans, arrays of (kind, start, end) in code points, end exclusive.

    base has the entities of the base patterns, by kind and start; spans adds,
    as kind id, the candidates (six or more letters, digits, - or _, with a
    digit, outside base entities) that stand in a pattern of high confidence. A shape
    alone makes no candidate an entity. A null or empty text has none. The graph
    is built over all rows, so equal rows get equal spans; with no seeds nothing
    is discovered; an empty table gives an empty result. Reading takes time in
    proportion to a text's length. Other columns are passed on whatever they
    hold; base and spans are replaced. Texts are read once; what is written and
    shuffled are mentions only.
    """
    rest = extra_columns(df, text, "base", "spans")
    wide = df.select(*[quoted(c) for c in rest], quoted(text).alias("_cv_text"))
    made = [T.StructField(f"_cv_{f.name}", f.dataType) for f in T.StructType.fromDDL(_DDL).fields]
    read = wide.mapInArrow(_read, T.StructType([*wide.schema.fields[:-1], *made]))
    read = scratch(read.withColumn("_cv_row", F.monotonically_increasing_id()))  # fixed once it is written
    seen = read.select("_cv_row", F.inline("_cv_seen"))
    good = patterns(seen.drop("_cv_row"), rounds, min_values, confidence).select("side", "word")
    open_ = seen.where(~F.col("kind").isin(*KINDS)).select(*_sides("_cv_row", "start", "end")).select("_cv_row", "start", "end", "p.side", "p.word")
    hits = met(open_, good, ["side", "word"], "_cv_row")
    new = hits.groupBy(F.col("_cv_row").alias("_cv_of")).agg(F.collect_set(F.struct(F.lit("id").alias("kind"), "start", "end")).alias("_cv_new"))
    both = read.join(new, F.col("_cv_row") == F.col("_cv_of"), "left")
    more = F.coalesce(F.sort_array("_cv_new"), F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>"))
    return both.select(*[quoted(c) for c in rest], F.col("_cv_base").alias("base"), F.concat("_cv_base", more).alias("spans"))


def digest(df: DataFrame) -> DataFrame:
    """Counts by kind, base_sha256 and spans as text, beside the other columns."""
    told = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(k) for k in KINDS]
    rest = [quoted(c) for c in extra_columns(df, "base", "spans")]
    return df.select(*rest, *counts, F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
