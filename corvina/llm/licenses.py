"""License scans: Aho-Corasick for tags and notices, a shunting-yard parser for expressions.

One automaton finds notice phrases and identifier tags in the stream of a
text's words; what follows a tag is read as a licence expression with AND, OR,
WITH, + and parentheses. It is evaluated to the identifiers that hold whatever
is chosen, which AND joins and OR cuts, and to the obligation of the choice that
asks least: AND takes the stricter side, OR the freer one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extra_columns, quoted

#: Fixed phrases and their labels that every scan has.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases: words, label and how sure a place is to be a notice.
NOTICES = {
    "gnu general public license version 2": ("gpl-2.0", 0.9),
    "gnu general public license version 3": ("gpl-3.0", 0.9),
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "apache license version 2 0": ("apache-2.0", 0.9),
    "mozilla public license": ("mpl", 0.8),
    "bsd 2 clause": ("bsd-2-clause", 0.8),
    "bsd 3 clause": ("bsd-3-clause", 0.8),
    "isc license": ("isc", 0.7),
    "creative commons attribution": ("cc-by", 0.7),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by nc sa": ("cc-by-nc-sa", 0.8),
    "cc by nc nd": ("cc-by-nc-nd", 0.8),
    "public domain dedication": ("cc0", 0.6),
    "permission is hereby granted free of charge": ("mit", 0.7),
    "redistribution and use in source and binary forms": ("bsd", 0.7),
}
BASE_WEIGHT = 0.6
#: Tags that an expression follows, as words.
TAGS = ("spdx license identifier", "license expression")
TAG_TEXT = re.compile(r"(?:spdx[^0-9a-z]+license[^0-9a-z]+identifier|license[^0-9a-z]+expression)[ \t]*[:=][ \t]*", re.ASCII | re.IGNORECASE)
PART = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.:-]*\+?")
#: Obligations, the freest first, and the identifiers of each, without + at the end. Identifiers of no class are
#: unknown: they are no labels, an expression of nothing else is worth UNKNOWN_WEIGHT, and their obligation is the last.
CLASSES = {
    "permissive": r"mit(-0|-cmu|-modern-variant)?|apache-(1\.[01]|2\.0)|0bsd|bsd-[1-4]-clause(-[a-z]+)*|isc|zlib|unlicense|cc0-1\.0|wtfpl|bsl-1\.0|ncsa|x11|curl|libpng(-2\.0)?"
    r"|postgresql|python-2\.0|psf-2\.0|php-3\.0(1)?|artistic-[12]\.0|afl-[1-3]\.[0-9]|cc-by-[1-4]\.0|ms-pl|ofl-1\.[01]|openssl|unicode-(3\.0|dfs-201[56])|vim|hpnd|ftl|ijg",
    "weak copyleft": r"lgpl-(2\.[01]|3\.0)(-only|-or-later)?|mpl-(1\.[01]|2\.0)|epl-[12]\.0|cddl-1\.[01]|cpl-1\.0|ms-rl|eupl-1\.[0-2]",
    "copyleft": r"gpl-[1-3]\.0(-only|-or-later)?|cc-by-sa-[1-4]\.0|osl-[1-3]\.[0-9]|sleepycat",
    "network copyleft": r"agpl-[13]\.0(-only|-or-later)?|sspl-1\.0",
    "restricted": r"cc-by-(nc|nd|nc-sa|nc-nd)-[1-4]\.0|busl-1\.1",
    "own": r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+",
}
OBLIGATIONS = (*CLASSES, "unknown")
_CLASS = [re.compile(p) for p in CLASSES.values()]
#: Exceptions that make a copyleft licence a weak one.
LINKING = re.compile(r"(classpath|gcc|llvm|linux-syscall|openjdk|bison|autoconf|font|u-boot|wxwindows)[a-z-]*(-[0-9.]+)?")
UNKNOWN_WEIGHT = 0.3
#: Precedence, weakest first.
RANK = {"or": 1, "and": 2, "with": 3}
#: All bytes that end a word become a space, A-Z become small letters.
_FOLD = bytes(
    32 if b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Words of ASCII letters and digits and of all characters beyond ASCII; A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def automaton(phrases: Iterable[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for p in phrases:
        found.add_word(f" {p} ", p)
    found.make_automaton()
    return found


def parse(parts: list[str]) -> tuple | None:
    """The tree of a licence expression by the shunting-yard method; None if it is malformed.

    A tree is an identifier in lower case, or (operator, left, right). With
    binds tighter than and, and tighter than or; all group to the left.
    """
    out: list = []
    ops: list[str] = []

    def reduce() -> bool:
        if len(out) < 2:
            return False
        right, left = out.pop(), out.pop()
        out.append((ops.pop(), left, right))
        return True

    operand = True  # what may come next
    for part in parts:
        low = part.lower()
        if low in RANK:
            if operand:
                return None
            while ops and ops[-1] != "(" and RANK[ops[-1]] >= RANK[low]:
                if not reduce():
                    return None
            ops.append(low)
            operand = True
        elif part == "(":
            if not operand:
                return None
            ops.append(part)
        elif part == ")":
            if operand:
                return None
            while ops and ops[-1] != "(":
                if not reduce():
                    return None
            if not ops:
                return None
            ops.pop()
        else:
            if not operand:
                return None
            out.append(low)
            operand = False
    while ops:
        if ops[-1] == "(" or not reduce():
            return None
    return out[0] if len(out) == 1 and not operand else None


def well_formed(parts: list[str]) -> int:
    """How many parts the longest prefix has that parse() takes."""
    longest = depth = 0
    operand = True
    for i, part in enumerate(parts, 1):
        if operand != (part not in (")",) and part.lower() not in RANK):
            break
        if part == "(":
            depth += 1
        elif part == ")":
            depth -= 1
            if depth < 0:
                break
        else:
            operand = part.lower() in RANK
        if not operand and not depth:
            longest = i
    return longest


def obligation(identifier: str) -> int:
    """The place of an identifier in lower case among OBLIGATIONS."""
    name = identifier.removesuffix("+")
    return next((i for i, c in enumerate(_CLASS) if c.fullmatch(name)), len(_CLASS))


def evaluate(tree) -> tuple[set[str], set[str], int]:
    """(identifiers named, those of every choice, the obligation of the freest choice) of a tree.

    An exception stays with its licence, as in gpl-2.0 with x; one for linking
    makes copyleft weak. Only known identifiers are told.
    """
    todo, done = [(tree, False)], []
    while todo:  # a stack of its own, as a tree may be as deep as its line is long
        node, ready = todo.pop()
        if isinstance(node, str):
            kind = obligation(node)
            told = {node} if kind < len(_CLASS) else set()
            done.append((told, set(told), kind))
        elif node[0] == "with":
            if not ready:
                todo += [(node, True), (node[1], False)]
                continue
            (named, every, kind), exception = done.pop(), node[2] if isinstance(node[2], str) else ""
            told = ({f"{x} with {exception}" for x in some} for some in (named, every))
            done.append((*told, 1 if kind == 2 and LINKING.fullmatch(exception) else kind))
        elif not ready:
            todo += [(node, True), (node[2], False), (node[1], False)]
        else:
            (a, x, i), (b, y, j) = done.pop(), done.pop()
            few, many = sorted((a, b), key=len)
            many |= few
            less, more = sorted((x, y), key=len)
            if node[0] == "and":
                more |= less
                done.append((many, more, max(i, j)))
            else:
                done.append((many, less & more, min(i, j)))
    return done[0]


def identifiers(tree) -> set[str]:
    """The known identifiers that a tree names."""
    return evaluate(tree)[0]


def expressions(text: str) -> list[tuple[str, tuple | str | None]]:
    """(expression, its tree) after each tag: the longest run of parts on the tag's line that is well formed."""
    found, line_end = [], -1
    for tag in TAG_TEXT.finditer(text):
        begin = tag.end()
        if begin > line_end:  # the end of a line is looked for once, however many tags the line has
            line_end = text.find("\n", begin)
            line_end = line_end if line_end >= 0 else len(text)
        parts, end, closed = [], begin, []
        for m in PART.finditer(text, begin, line_end):
            if text[end : m.start()].strip(" \t"):
                break
            # Two operands in a row: the expression is over.
            if parts and m[0].lower() not in RANK and m[0] not in "()" and parts[-1].lower() not in RANK and parts[-1] != "(":
                break
            parts.append(m[0])
            end = m.end()
            closed.append(end)
        n = well_formed(parts)
        found.append((text[begin : closed[n - 1]], parse(parts[:n])) if n else ("", None))
    return found


def scan(text: str | None, search: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base labels, labels, score, expressions, required, obligation) of a text."""
    ws = words(text)
    stream = (b" " + b" ".join(ws) + b" ").decode("latin-1")
    base, more, required, n_base, first, last, sure, tags, strictest = set(), set(), set(), 0, None, None, 1.0, False, None
    counted, at = 0, 0  # words before position at; matches come by their ends, so a longer one may begin before the last
    for end, phrase in search.iter(stream):
        if phrase in BASE:
            begin = end - len(phrase) - 1
            counted += stream.count(" ", at, begin) if begin >= at else -stream.count(" ", begin, at)
            at = begin
            n_base += 1
            first = counted if first is None else min(first, counted)
            last = counted if last is None else max(last, counted)
            base.add(BASE[phrase])
            sure *= 1 - BASE_WEIGHT
        elif phrase in NOTICES:
            label, weight = NOTICES[phrase]
            more.add(label)
            sure *= 1 - weight
        else:
            tags = True
    named = [(e, t) for e, t in expressions(text or "") if t is not None] if tags else []
    for _, tree in named:
        known, every, kind = evaluate(tree)
        more |= known
        required |= every
        sure *= 0.0 if known else 1 - UNKNOWN_WEIGHT
        strictest = kind if strictest is None else max(strictest, kind)
    told = None if strictest is None else OBLIGATIONS[strictest]
    return len(ws), n_base, first, last, sorted(base), sorted(base | more), round(1 - sure, 6), [e for e, _ in named], sorted(required), told


FIELDS = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.list_(pa.string()),
    "labels": pa.list_(pa.string()),
    "score": pa.float64(),
    "expressions": pa.list_(pa.string()),
    "required": pa.list_(pa.string()),
    "obligation": pa.string(),
}
SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, score double, "
    "expressions array<string>, required array<string>, obligation string"
)


def license_scan(df: DataFrame, text: str = "text") -> DataFrame:
    """df, without its text, with n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, required and obligation.

    n_base counts the places of the base phrases, first_word and last_word are
    the smallest and largest word index where one starts (null without any);
    labels adds those of notices and of known identifiers in well-formed
    expressions. required has the identifiers that hold whatever is chosen, and
    obligation, one of OBLIGATIONS, is that of the freest choice, the strictest
    of all expressions; null without one. score is one minus the product of each
    place's doubt, 1 with an expression that names a known identifier, 0 without
    anything. A null or empty text has no words and score 0. Rows are scanned on
    their own and whole, so repeated rows, ties and nulls elsewhere change
    nothing, and an empty table gives an empty result; columns of the names made
    are replaced.
    """
    rest = extra_columns(df, text, *FIELDS)
    wide = df.select(*[quoted(c) for c in rest], quoted(text).alias("_cv_text"))

    def run(batches):
        search = automaton([*BASE, *NOTICES, *TAGS])
        for b in batches:
            rows = [scan(x.as_py(), search) for x in b.column(b.num_columns - 1)]
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(FIELDS.values())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], [*b.schema.names[:-1], *FIELDS])

    from pyspark.sql import types as T

    schema = T.StructType([*wide.schema.fields[:-1], *T.StructType.fromDDL(SCHEMA).fields])
    return wide.mapInArrow(run, schema)


def joined_labels(df: DataFrame) -> DataFrame:
    """base_labels, labels and required as comma-joined strings; no labels give an empty one."""
    return df.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels", "required")})
