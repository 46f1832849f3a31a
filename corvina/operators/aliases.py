"""Aliases in normalised texts: exact ones along a trie of tokens, close ones by way of an index of bigrams.

Neither looks at aliases one by one: a text is walked once however many aliases
there are, and a phrase is compared only with aliases that share as many
bigrams with it as a ratio of the cutoff needs.
"""

from __future__ import annotations

import difflib
import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab

MATCH = "array<struct<start:int,end:int,raw:string,canonical:string,ontology_id:string,family:string,node_type:string,method:string>>"
#: A run of word characters, or one other character.
TOKEN = re.compile(r"\w+|\W")
#: Aliases that a vocabulary may have; it is held by every worker.
MOST_ALIASES = 1_000_000


class Trie:
    """Aliases by their tokens; what is found is what whole-word search finds for each alias on its own."""

    def __init__(self, aliases: Sequence[str]):
        self.root: dict = {}
        for alias in aliases:
            node = self.root
            for token in TOKEN.findall(alias):
                node = node.setdefault(token, {})
            if alias:
                node[None] = alias  # no token is None

    def occurrences(self, sentence: str) -> list[tuple[int, int, str]]:
        """(start, end, alias), by start and then the shorter first; the places of one alias don't overlap."""
        tokens = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(sentence)]
        out, last = [], {}
        for i, (start, _, first) in enumerate(tokens):
            node = self.root.get(first)
            if node is None or not self._bound(sentence, start):
                continue
            for k in range(i, len(tokens)):
                if k > i:
                    node = node.get(tokens[k][2])
                    if node is None:
                        break
                alias, end = node.get(None), tokens[k][1]
                if alias is not None and start >= last.get(alias, 0) and self._bound(sentence, end):
                    out.append((start, end, alias))
                    last[alias] = end
        return out

    @staticmethod
    def _bound(sentence: str, at: int) -> bool:
        """Whether a word begins or ends at a place."""
        word = [bool(re.match(r"\w", c)) for c in (sentence[at - 1 : at] if at else "", sentence[at : at + 1])]
        return word[0] != word[1]


def _bigrams(text: str) -> list[tuple[str, int]]:
    """The bigrams of a text, those that come again told apart by how often they were there before."""
    seen: Counter = Counter()
    out = []
    for i in range(len(text) - 1):
        pair = text[i : i + 2]
        out.append((pair, seen[pair]))
        seen[pair] += 1
    return out


class GramIndex:
    """The alias closest to a phrase, of those with a ratio of at least the cutoff.

    Strings of S characters together with a ratio of c have M >= c S / 2 in
    common, in at most S - 2 M + 1 stretches, so at least 3 M - S - 1 bigrams.
    Any alias with so many of a phrase's n bigrams has one of its n - (3 M - S - 2)
    rarest; only those are looked up.
    """

    def __init__(self, aliases: Sequence[str], cutoff: float):
        self.cutoff = cutoff
        self.of_length: dict[int, list[str]] = defaultdict(list)
        self.with_gram: dict[int, dict[tuple[str, int], list[str]]] = defaultdict(lambda: defaultdict(list))
        for alias in aliases:
            self.of_length[len(alias)].append(alias)
            for gram in _bigrams(alias):
                self.with_gram[len(alias)][gram].append(alias)

    def candidates(self, phrase: str) -> Iterator[str]:
        n, c = len(phrase), self.cutoff
        grams = _bigrams(phrase)
        for length in range(math.ceil(n * c / (2 - c) - 1e-9), math.floor(n * (2 - c) / c + 1e-9) + 1):
            if length not in self.of_length:
                continue
            needed = 3 * math.ceil(c * (n + length) / 2 - 1e-9) - (n + length) - 1
            if needed < 1:
                yield from self.of_length[length]
                continue
            lists = sorted((self.with_gram[length].get(g, ()) for g in grams), key=len)
            some = {a for aliases in lists[: max(0, len(lists) - needed + 1)] for a in aliases}
            counts = Counter(a for aliases in lists for a in aliases if a in some)
            yield from (a for a, k in counts.items() if k >= needed)

    def closest(self, phrase: str) -> str | None:
        matcher = difflib.SequenceMatcher()
        matcher.set_seq2(phrase)
        best = None
        for alias in self.candidates(phrase):
            matcher.set_seq1(alias)
            if matcher.quick_ratio() >= self.cutoff and (ratio := matcher.ratio()) >= self.cutoff and (best is None or (ratio, alias) > best):
                best = ratio, alias
        return best and best[1]


class AliasMatcher:
    """Finds aliases in normalised sentences as whole words, the longest at each place; else the first phrase that is close to one."""

    def __init__(self, aliases: Mapping[str, tuple], ambiguous: Sequence[str] = vocab.AMBIGUOUS_ALIASES, cutoff: float = 0.92):
        self.aliases, self.ambiguous = dict(aliases), frozenset(ambiguous)
        self.trie, self.index = Trie(list(self.aliases)), GramIndex(list(self.aliases), cutoff)
        self.context = re.compile("|".join(map(re.escape, (*vocab.RADIOMICS_CONTEXT, *vocab.BODYCOMP_CONTEXT))))

    def _allowed(self, sentence: str, start: int, end: int, alias: str) -> bool:
        if alias not in self.ambiguous:
            return True
        near = sentence[max(0, start - 40) : end + 40]
        if alias == "mean":
            return not re.search(vocab.MEAN_NOT, near) and bool(re.search(vocab.MEAN_ONLY, near))
        return bool(self.context.search(sentence))  # the window is a part of the sentence

    def exact(self, sentence: str) -> list[tuple]:
        found = [x for x in self.trie.occurrences(sentence) if self._allowed(sentence, *x)]
        out, last = [], 0
        for start, end, alias in sorted(found, key=lambda x: (x[0], -x[1])):
            if start >= last:
                out.append((start, end, alias, *self.aliases[alias], "exact"))
                last = end
        return out

    def fuzzy(self, sentence: str) -> list[tuple]:
        """The first n-gram of 4 to 2 words that is close to an alias, in a sentence with imaging context."""
        if not self.context.search(sentence):
            return []
        words = re.findall(r"[a-z0-9/\-]+", sentence)
        for n in (4, 3, 2):
            for i in range(len(words) - n + 1):
                phrase = " ".join(words[i : i + n])
                start = sentence.find(phrase) if len(phrase) >= 6 else -1
                close = self.index.closest(phrase) if start >= 0 else None
                if close and self._allowed(sentence, start, start + len(phrase), close):
                    return [(start, start + len(phrase), phrase, *self.aliases[close], "fuzzy")]
        return []


_built: dict[str, object] = {}


def _once(key: str, build):
    """What a worker has built for a column's function; it serves all its tasks."""
    if key not in _built:
        _built.clear()
        _built[key] = build()
    return _built[key]


def alias_matches(sentence: Column, aliases: Mapping[str, tuple] = vocab.ALIASES, fuzzy: bool = True) -> Column:
    """Matches of a normalised sentence as an array of structs, by an Arrow-batched function."""
    names = ("start", "end", "raw", "canonical", "ontology_id", "family", "node_type", "method")
    key = uuid.uuid4().hex

    @F.pandas_udf(MATCH)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = _once(key, lambda: AliasMatcher(aliases))
        look = lambda x: [dict(zip(names, m, strict=True)) for m in (matcher.exact(x) or (matcher.fuzzy(x) if fuzzy else []))]
        for s in batches:
            whole = s.fillna("")
            told = {x: look(x) for x in whole.unique()}  # sentences of a batch that are the same are read once
            yield whole.map(told.__getitem__)

    return run(sentence)


def alias_counts(text: Column, aliases: Sequence[str]) -> Column:
    """How often each alias occurs in a normalised text as whole words, and where first: an array of (alias, n, first)."""
    key = uuid.uuid4().hex

    def counts(trie: Trie, text: str) -> list[dict]:
        found: dict[str, list[int]] = {}
        for start, _, alias in trie.occurrences(text):
            found.setdefault(alias, []).append(start)
        return [{"alias": a, "n": len(at), "first": at[0]} for a, at in found.items()]

    @F.pandas_udf("array<struct<alias:string,n:bigint,first:bigint>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie = _once(key, lambda: Trie(aliases))
        for s in batches:
            yield s.map(lambda x: counts(trie, x or ""))

    return run(text)


def vocabulary(rows: DataFrame, column: str) -> list[str]:
    """The distinct values of a column, to be held by every worker; more than MOST_ALIASES are refused."""
    found = [r[0] for r in rows.select(column).where(F.col(column) != "").distinct().limit(MOST_ALIASES + 1).collect()]
    if len(found) > MOST_ALIASES:
        raise ValueError(f"a vocabulary has {MOST_ALIASES} aliases at most")
    return sorted(found)
