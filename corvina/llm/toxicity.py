"""Toxic spans by a linear-chain conditional random field over two states.

Token labels come from document labels: a token of a toxic document is toxic if
one of its features is far commoner in toxic documents than in clean ones. The field is fitted
to a bounded sample of labelled documents; forward-backward marginals give the
offending spans, and their sum beside the number of tokens a document's score,
by a logistic curve fitted to the same sample.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extra_columns, quoted

TOKEN = re.compile(r"\w+|[.!?\n]")
BUCKETS = 1 << 18
N_FEATURES = 6
#: Labelled documents that are fitted to at most, of either label, their longest text in characters, and all of a label's together.
SAMPLE, SAMPLE_CHARS, SAMPLE_TOTAL = 1200, 1 << 16, 1 << 25
#: Sequences are fitted to in pieces of so many tokens, and to so many pieces at most with a toxic token and without one.
PIECE, TOXIC_PIECES, OTHER_PIECES = 48, 4000, 14000
BATCH_CHARS = 4_000_000
#: Tokens of sequences that are told together, about.
TOGETHER = 4_000_000


def features(word: str) -> list[int]:
    """Hash buckets of a word, in lower case: the whole, its beginnings and its end."""
    word = word.lower()
    parts = ("w" + word, "3" + word[:3], "4" + word[:4], "5" + word[:5], "6" + word[:6], "s" + word[-4:])
    return [crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts]


def sequences(text: str | None) -> list[list[tuple[int, int]]]:
    """Spans of the tokens of each sentence."""
    out: list[list[tuple[int, int]]] = [[]]
    for m in TOKEN.finditer(text or ""):
        if m[0] in ".!?\n":
            if out[-1]:
                out.append([])
        else:
            out[-1].append(m.span())
    return [s for s in out if s]


class Field:
    """Weights of the features for state 1 over state 0, and the transitions."""

    def __init__(self):
        self.w = np.zeros(BUCKETS)
        self.bias = -4.0
        self.t = np.zeros((2, 2))
        #: Weights of aggregates(); before fitting, nothing is toxic.
        self.level = np.array([-30.0, 0.0, 0.0])

    def marginals(self, e: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(p, forward, backward) of state 1; e: (sequences, steps) of scores, n: lengths. Beyond a length all is 0."""
        t = np.exp(self.t)
        x = np.exp(np.clip(e, -30, 30))
        rows, steps = e.shape
        a, b = np.zeros((steps, rows)), np.full((steps, rows), 0.5)
        now = np.full(rows, 0.5)
        for i in range(steps):
            if i:
                one, zero = (1 - now) * t[0, 1] + now * t[1, 1], (1 - now) * t[0, 0] + now * t[1, 0]
            else:
                one = zero = np.full(rows, 0.5)
            one = one * x[:, i]
            a[i] = now = one / (one + zero)
        now = np.full(rows, 0.5)
        for i in range(steps - 1, 0, -1):
            one = t[1, 1] * x[:, i] * now + t[1, 0] * (1 - now)
            zero = t[0, 1] * x[:, i] * now + t[0, 0] * (1 - now)
            new = one / (one + zero)
            b[i - 1] = now = np.where(i < n, new, 0.5)
        both = a * b
        p = both / (both + (1 - a) * (1 - b))
        p[np.arange(steps)[:, None] >= n] = 0
        return p.T, a.T, b.T

    def gradient(self, f: np.ndarray, y: np.ndarray, n: np.ndarray, ready: tuple | None = None) -> np.ndarray:
        """That of the mean log-likelihood per token, by weights, bias and transitions; f: (sequences, steps, features), y: (sequences, steps) of 0 and 1.

        ready is what readied() makes of them, where many steps are taken with the same ones.
        """
        live, own, pair, truth = ready or readied(f, y, n)
        e = np.zeros(live.shape)
        e[live] = self.w[own].sum(1) + self.bias
        p, a, b = self.marginals(e, n)
        off = (y - p)[live]
        x, t = np.exp(np.clip(e[:, 1:], -30, 30)), np.exp(self.t)
        a0, b0 = a[:, :-1], b[:, 1:]
        xi = [[(a0 if i else 1 - a0) * t[i, j] * (x * b0 if j else 1 - b0) for j in (0, 1)] for i in (0, 1)]
        norm = xi[0][0] + xi[0][1] + xi[1][0] + xi[1][1]
        pairs = np.array([[(xi[i][j] / norm)[pair].sum() for j in (0, 1)] for i in (0, 1)])
        return np.concatenate([np.bincount(own.ravel(), np.repeat(off, own.shape[1]), len(self.w)), [off.sum()], (truth - pairs).ravel()]) / len(own)

    def fit(self, f: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 60, rate: float = 0.3, decay: float = 1e-4) -> None:
        """Adam on the mean log-likelihood; only features that occur are moved, the others stay at 0."""
        used, inner = np.unique(f, return_inverse=True)
        inner = inner.reshape(f.shape)
        whole, self.w = self.w, self.w[used]
        ready, k_w = readied(inner, y, n), len(used)
        m, v = np.zeros(k_w + 5), np.zeros(k_w + 5)
        for k in range(1, steps + 1):
            now = np.concatenate([self.w, [self.bias], self.t.ravel()])
            g = self.gradient(inner, y, n, ready) - decay * np.concatenate([self.w, np.zeros(5)]) / 10
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            now += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
            self.w, self.bias, self.t = now[:k_w], float(now[k_w]), now[k_w + 1 :].reshape(2, 2)
        whole[used] = self.w
        self.w = whole

    def score(self, p: np.ndarray) -> float:
        """A document's score from the marginals of its tokens."""
        return float(1 / (1 + np.exp(-(self.level @ aggregates(p))))) if len(p) else 0.0

    def fit_level(self, marginals: list[np.ndarray], toxic: list[int], steps: int = 30, decay: float = 0.1) -> None:
        """Newton's method on the log-likelihood of the documents' labels."""
        x, y = np.array([aggregates(p) for p in marginals]), np.array(toxic, float)
        w = np.zeros(3)
        for _ in range(steps):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w += np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + decay * np.eye(3), x.T @ (y - q) - decay * w)
        self.level = w


def readied(f: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple:
    """(which steps there are, the features of their tokens, which of them follow one, the transitions in the labels)"""
    live = np.arange(f.shape[1]) < n[:, None]
    pair = live[:, 1:]
    truth = np.array([[((y[:, :-1] == i) & (y[:, 1:] == j) & pair).sum() for j in (0, 1)] for i in (0, 1)], float)
    return live, f[live], pair, truth


def aggregates(p: np.ndarray) -> np.ndarray:
    """What a document's score is told from: a constant, the sum of its squared marginals, in which many small ones count little, and its length."""
    return np.array([1.0, np.log(float(p @ p) + 0.1), np.log(len(p) + 10.0)])


def token_labels(docs: list[tuple[str, int]], least: int = 8, ratio: float = 0.15, most: int = 5, known: dict[str, list[int]] | None = None) -> set[int]:
    """Feature buckets that are far commoner in toxic documents of a labelled sample than in clean ones.

    A document counts a bucket up to most times. A bucket is marked with least
    counts in toxic documents or more, and if its rate in clean documents is no more than
    ratio of that in toxic ones.
    """
    by = (Counter(), Counter())
    sizes = [0, 0]
    known = {} if known is None else known  # features of words
    for text, toxic in docs:
        words = Counter(w for w in TOKEN.findall(text) if w not in ".!?\n")
        own: Counter = Counter()
        for w, n in words.items():
            for k in known.get(w) or known.setdefault(w, features(w)):
                own[k] += n
        sizes[toxic] += 1
        by[toxic].update({k: min(n, most) for k, n in own.items()})
    clean, toxic = by
    return {k for k, c in toxic.items() if c >= least and (clean[k] + 0.5) / (sizes[0] + 1) <= ratio * c / max(1, sizes[1])}


def padded(seqs: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(s) for s in seqs])
    f = np.zeros((len(seqs), n.max(), N_FEATURES), np.int64)
    for i, s in enumerate(seqs):
        f[i, : len(s)] = s
    return f, n


def train(docs: list[tuple[str, int]], seed: int = 7) -> Field:
    """A field and a document level fitted to (text, toxic) pairs; without toxic or without clean ones nothing is toxic.

    Sequences are cut into pieces of PIECE tokens, each with its own labels; at
    most TOXIC_PIECES with a toxic token and OTHER_PIECES others are drawn.
    """
    field = Field()
    known: dict[str, list[int]] = {}
    marks = token_labels(docs, known=known)
    if not marks or len({t for _, t in docs}) < 2:
        return field
    rng = np.random.default_rng(seed)
    with_label, without = [], []
    for text, toxic in docs:
        for s in sequences(text):
            fs = [known.get(w := text[a:b]) or known.setdefault(w, features(w)) for a, b in s]
            y = [int(toxic and not marks.isdisjoint(f)) for f in fs]
            for at in range(0, len(fs), PIECE):
                piece = fs[at : at + PIECE], y[at : at + PIECE]
                (with_label if any(piece[1]) else without).append(piece)
    pick = rng.permutation(len(with_label))[:TOXIC_PIECES], rng.permutation(len(without))[:OTHER_PIECES]
    chosen = [with_label[i] for i in pick[0]] + [without[i] for i in pick[1]]
    f, n = padded([c[0] for c in chosen])
    y = np.zeros(f.shape[:2])
    for i, (_, one) in enumerate(chosen):
        y[i, : len(one)] = one
    field.fit(f, y, n)
    scorer = Scorer(field)
    told, lo, held = [], 0, 0
    for i, (text, _) in enumerate(docs, 1):  # as many texts together as scoring takes
        held += len(text)
        if held >= BATCH_CHARS or i == len(docs):
            told += scorer.marginals([t for t, _ in docs[lo:i]])
            lo, held = i, 0
    field.fit_level(told, [t for _, t in docs])
    return field


class Scorer(dict):
    """word -> its score; forgets all when too large."""

    def __init__(self, field: Field):
        self.field = field

    def __missing__(self, word: str) -> float:
        if len(self) > 400_000:
            self.clear()
        self[word] = e = float(self.field.w[features(word)].sum()) + self.field.bias
        return e

    def marginals(self, texts: list[str | None]) -> list[np.ndarray]:
        """The marginal of each token of each text, 0 for sentence ends."""
        es, ends, marks = [], [], []
        for text in texts:
            tokens = TOKEN.findall(text or "")
            es.append(np.fromiter(map(self.__getitem__, tokens), np.float64, len(tokens)))
            marks.append(np.fromiter(map(".!?\n".__contains__, tokens), bool, len(tokens)))
            ends.append(len(tokens))
        if not sum(ends):
            return [np.zeros(0)] * len(texts)
        e, mark = np.concatenate(es), np.concatenate(marks)
        doc = np.repeat(np.arange(len(texts)), ends)
        at = np.flatnonzero(~mark)
        p = np.zeros(len(e))
        if len(at):
            # A sequence begins after a mark and with a document.
            seq = np.cumsum(np.concatenate([[True], mark[:-1] | (doc[1:] != doc[:-1])]))[at]
            start = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            n = np.diff(np.concatenate([start, [len(at)]]))
            order = np.argsort(n, kind="stable")
            k = 0
            while k < len(order):  # sequences of about the same length together, each as long as it is
                top = max(8, int(n[order[k]] * 1.3))
                end = min(int(np.searchsorted(n[order], top, "right")), k + max(1, TOGETHER // top))
                some = order[k:end]
                steps = np.arange(int(n[some[-1]]))
                live = steps < n[some][:, None]
                index = np.minimum(start[some][:, None] + steps, len(at) - 1)
                got, _, _ = self.field.marginals(np.where(live, e[at[index]], 0.0), n[some])
                p[at[index[live]]] = got[live]
                k = end
        return np.split(p, np.cumsum(ends)[:-1])

    def spans(self, texts: list[str | None]) -> list[tuple[float, list[tuple[int, int]]]]:
        """(score, offending spans) of each text."""
        out = []
        for text, p in zip(texts, self.marginals(texts), strict=True):
            hit = np.flatnonzero(p >= 0.5)
            out.append((self.field.score(p), self._places(text, hit) if len(hit) else []))
        return out

    @staticmethod
    def _places(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
        wanted, spans = set(hit.tolist()), []
        last = -2
        for i, m in enumerate(TOKEN.finditer(text)):
            if i in wanted:
                if i == last + 1:
                    spans[-1] = (spans[-1][0], m.end())
                else:
                    spans.append(m.span())
                last = i
        return spans


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(quoted(doc_id).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, most: int, most_chars: int, total: int = SAMPLE_TOTAL) -> list[tuple[str, int]]:
    """Up to most (text, toxic) pairs of either label, and total characters of each, from rows that are not held out, in the order of the ids' hashes.

    An id gives one text, the first in order of those that its rows have; so no more than most texts and total characters of a label reach the driver.
    """
    known = labels.where(F.col("toxic").isNotNull() & ~held_out("doc_id") & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.md5(F.col("doc_id").cast("string")))
    # Somewhat more than needed, as some may have no text or too long a one.
    picked = [known.where(c).orderBy("h", "doc_id").limit(most + most // 4) for c in ("toxic = 1", "toxic = 0")]
    few = picked[0].unionByName(picked[1])
    texts = docs.select(quoted(doc_id).alias("id"), quoted(text).alias("t")).where(F.length("t").between(1, most_chars))
    one = texts.join(F.broadcast(few), F.col("id") == F.col("doc_id")).groupBy("h", "id", "toxic").agg(F.min("t").alias("t"))
    order = Window.partitionBy("toxic").orderBy("h", "id")
    so_far = F.sum(F.length("t")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = one.withColumns({"_n": F.row_number().over(order), "_c": so_far}).where((F.col("_n") <= most) & (F.col("_c") <= total)).select("h", "t", "toxic").collect()
    return [(r.t, label) for label in (1, 0) for r in sorted((r for r in rows if r.toxic == label), key=lambda r: (r.h, r.t))]


def toxicity(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """df, without its text, with score (0 to 1), predicted (1 from 0.5 on) and toxic_spans.

    The score aggregates the marginals of all tokens; spans are runs of tokens
    with a marginal of 0.5 or more, in characters, end exclusive, and a clean
    document may have one. A text without tokens, null or empty, scores 0. Whole
    texts are scored, row by row, in time in proportion to their length: repeated
    rows score alike, other columns are passed on whatever they hold, those of
    the names made are replaced, and an empty table gives an empty result.
    """
    rest = extra_columns(df, text, "score", "predicted", "toxic_spans")
    wide = df.select(*[quoted(c) for c in rest], quoted(text).alias("_cv_text"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        scorer = Scorer(field)
        for b in batches:
            sizes = np.cumsum([len(x.as_py() or "") for x in b.column(b.num_columns - 1)])
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BATCH_CHARS)))
                part = b.slice(lo, hi - lo)
                found = scorer.spans(part.column(part.num_columns - 1).to_pylist())
                made = [
                    pa.array([s for s, _ in found], pa.float64()),
                    pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                    pa.array([[{"start": x, "end": y} for x, y in spans] for _, spans in found], pa.list_(span)),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], [*part.schema.names[:-1], "score", "predicted", "toxic_spans"])
                lo = hi

    made = T.StructType.fromDDL("score double, predicted int, toxic_spans array<struct<start:bigint,end:bigint>>")
    return wide.mapInArrow(run, T.StructType([*wide.schema.fields[:-1], *made.fields]))
