"""Byte-level BPE: overlapping chunks are pre-tokenised in parallel and stitched.

The pattern that cuts a text into pre-tokens looks only to the right of where it
stands. So two chunks that overlap agree from the first boundary that both have
in the overlap: there the right one takes over from the left one. The last
pre-tokens of a chunk may be cut short by its end and are not trusted. Each
pre-token is then merged by the ranks on its own; decoding joins raw bytes.
"""

from __future__ import annotations

import base64
import heapq
import sys
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extra_columns, quoted, scratch

CHUNK, OVERLAP = 1 << 14, 1 << 9
#: Chunks of a text of more characters than this are spread over tasks; those of a shorter one, a tenth of a second's work, stay in one.
SPREAD = 1 << 16
#: From so many bytes on a pre-token is merged by a heap; pre-tokens that are held for the next time, and their longest.
HEAP_BYTES, HELD, HELD_CHARS = 256, 150_000, 64
#: Rows of which the texts and ids are held as Python objects at once.
STEP = 500


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merged(raw: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a pre-token: of all neighbours those of the lowest rank, the leftmost at a tie, are joined until none has a rank."""
    if len(raw) >= HEAP_BYTES:
        return _merged_long(raw, ranks)
    none = len(ranks) + (1 << 30)
    cut = list(range(len(raw) + 1))
    pair = [ranks.get(raw[i : i + 2], none) for i in range(len(raw) - 1)]
    while pair:
        least = min(pair)
        if least == none:
            break
        i = pair.index(least)
        del cut[i + 1], pair[i]
        if i:
            pair[i - 1] = ranks.get(raw[cut[i - 1] : cut[i + 1]], none)
        if i < len(pair):
            pair[i] = ranks.get(raw[cut[i] : cut[i + 2]], none)
    return [raw[x:y] for x, y in zip(cut, cut[1:], strict=False)]


def _merged_long(raw: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same with a heap of neighbours, in n log n steps."""
    n = len(raw)
    end, back = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at a place: its end, and the beginning of the one before
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            back[stop] = i
            if (r := ranks.get(raw[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if i and (r := ranks.get(raw[back[i] : stop])) is not None:
            heapq.heappush(heap, (r, back[i], stop))
    return [raw[i : end[i]] for i in range(n) if alive[i]]


class Pieces(dict):
    """pre-token -> its ids, as the bytes of 32-bit integers.

    Once HELD pre-tokens are known, they are set aside and only those that come
    again are taken over, so that at most twice as many are held. A long one is not.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.id_bytes = {token: rank.to_bytes(4, sys.byteorder) for token, rank in ranks.items()}
        self.aside: dict[str, bytes] = {}

    def forget(self) -> None:
        """Lets go of all pre-tokens: a worker goes on to other stages, which need the memory."""
        self.clear()
        self.aside = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.aside.get(piece)
        if ids is None:
            raw = piece.encode("utf-8", "replace")
            ids = self.id_bytes.get(raw) or b"".join(map(self.id_bytes.__getitem__, merged(raw, self.ranks)))
        if len(piece) < HELD_CHARS:
            if len(self) >= HELD:
                self.aside = dict(self)
                self.clear()
            self[piece] = ids
        return ids


_known: dict[str, Pieces] = {}


def pieces_of(ranks_path: str) -> Pieces:
    """One table of ranks for all tasks that a worker runs after one another."""
    if ranks_path not in _known:
        _known[ranks_path] = Pieces(read_ranks(ranks_path))
    return _known[ranks_path]


class Cutter:
    """Cuts texts into pre-tokens; a long text by chunks that overlap and are stitched."""

    def __init__(self, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.pattern, self.chunk, self.overlap = regex.compile(pattern), chunk, overlap

    def found(self, text: str, start: int = 0) -> list[str]:
        """The pre-tokens from a place on; a pattern that leaves something out can't be stitched by lengths and is an error."""
        out = self.pattern.findall(text, start)
        if out and isinstance(out[0], tuple) or sum(map(len, out)) != len(text) - start:
            raise ValueError("the pattern has groups or leaves out a part of the text")
        return out

    def sure(self, pieces: list[str], goes_on: bool) -> int:
        """How many pre-tokens of a chunk are not touched by its end."""
        return max(0, len(pieces) - 2) if goes_on else len(pieces)

    def heads(self, pieces: list[str], n: int) -> list[int]:
        """Boundaries in the first overlap characters, of n pre-tokens that are sure."""
        out, at = [0], 0
        for p in pieces[:n]:
            at += len(p)
            if at > self.overlap:
                break
            out.append(at)
        return out

    def tails(self, pieces: list[str], n: int) -> list[tuple[int, int]]:
        """(boundary, pre-tokens before it) from the chunk's length on, of n pre-tokens that are sure, in order."""
        out, at = [], sum(map(len, pieces[:n]))
        for k in range(n, -1, -1):
            if at < self.chunk:
                break
            out.append((at, k))
            at -= len(pieces[k - 1]) if k else 0
        return out[::-1]

    def __call__(self, text: str) -> list[str]:
        """All pre-tokens of a text."""
        n = len(text)
        if n <= self.chunk:
            return self.found(text)
        out: list[str] = []
        start, pieces = 0, self.found(text[: self.chunk + self.overlap])
        skip = 0  # pre-tokens of this chunk that the one before has told
        while True:
            goes_on = start + self.chunk + self.overlap < n
            if not goes_on:
                return out + pieces[skip:]
            after = start + self.chunk
            follow = self.found(text[after : after + self.chunk + self.overlap])
            told = self.sure(pieces, True)
            heads = self.heads(follow, self.sure(follow, after + self.chunk + self.overlap < n))
            place = {h: k for k, h in enumerate(heads)}
            met = next(((at, k) for at, k in self.tails(pieces, told) if at - self.chunk in place), None)
            if met is None or met[1] < skip:
                # No boundary in common: go on from the last one that is sure, by a stretch that grows until something is.
                last = start + sum(map(len, pieces[:told]))
                out += pieces[skip:told]
                reach = self.chunk + self.overlap
                while True:
                    pieces = self.found(text[last : last + reach])
                    if last + reach >= n:
                        return out + pieces
                    if self.sure(pieces, True):
                        break
                    reach *= 2
                told = self.sure(pieces, True)
                out += pieces[:told]
                start = last + sum(map(len, pieces[:told]))
                pieces, skip = self.found(text[start : start + self.chunk + self.overlap]), 0
                continue
            at, k = met
            out += pieces[skip:k]
            start, pieces, skip = after, follow, place[at - self.chunk]


def encoded(text: str, pieces: Pieces, cut: Cutter) -> bytes:
    return b"".join(map(pieces.__getitem__, cut(text)))


def encode_text(text: str, pieces: Pieces, cut: Cutter) -> list[int]:
    """The ids of one text, in one task."""
    return np.frombuffer(encoded(text, pieces, cut), np.int32).tolist()


def _ids(values: list[bytes]) -> pa.ListArray:
    sizes = np.cumsum([0, *(len(v) // 4 for v in values)])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.frombuffer(b"".join(values), np.int32)))


def _lists(values: list[list[int]]) -> pa.ListArray:
    sizes = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.fromiter(chain.from_iterable(values), np.int64, sizes[-1])))


def _encoder(ranks_path: str, pattern: str, chunk: int, overlap: int, at: int):
    def run(batches):
        pieces, cut = pieces_of(ranks_path), Cutter(pattern, chunk, overlap)
        try:
            for b in batches:
                for lo in range(0, b.num_rows, STEP):
                    part = b.slice(lo, STEP)
                    ids = [encoded(x or "", pieces, cut) for x in part.column(at).to_pylist()]
                    yield pa.RecordBatch.from_arrays([*part.columns, _ids(ids)], [*part.schema.names, "tokens"])
        finally:
            pieces.forget()

    return run


def _chunks(chunk: int, overlap: int):
    """(row, n, start, last, chunk) of each text."""

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                text, row = b.column(1)[r].as_py(), b.column(0)[r].as_py()
                starts = range(0, len(text), chunk)
                for n, s in enumerate(starts):
                    one = [[row], [n], [s], [n == len(starts) - 1], [text[s : s + chunk + overlap]]]
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one, kinds, strict=True)], ["row", "n", "start", "last", "chunk"])

    return run


def _cutter(pattern: str, chunk: int, overlap: int):
    """Adds the boundaries in what a chunk shares with the one before (head) and with the next (tail)."""

    def run(batches):
        cut = Cutter(pattern, chunk, overlap)
        for b in batches:
            head, tail = [], []
            for s, text in zip(b.column(2).to_pylist(), b.column(4).to_pylist(), strict=True):
                pieces = cut.found(text)
                # A whole length means that the text goes on, or ends here: then the last boundaries are sure too, but not known to be.
                n = cut.sure(pieces, len(text) == chunk + overlap)
                head.append([s + e for e in cut.heads(pieces, n)])
                tail.append([s + e for e, _ in cut.tails(pieces, n)])
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(head), _lists(tail)], [*b.schema.names, "head", "tail"])

    return run


def _piecewise(ranks_path: str, pattern: str):
    """(row, n, ids) of what a chunk has between its stitches."""

    def run(batches):
        pieces, cut = pieces_of(ranks_path), Cutter(pattern)
        try:
            for b in batches:
                ids = []
                for text, s, a, e in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                    own, at = [], a
                    for p in cut.found(text, a - s):  # the whole chunk, so that a stitch cuts no look ahead
                        at += len(p)
                        if e is not None and at > e:
                            break
                        own.append(p)
                    ids.append(b"".join(map(pieces.__getitem__, own)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _ids(ids)], ["row", "n", "ids"])
        finally:
            pieces.forget()

    return run


def _encode_long(rows: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, tokens) of rows(row, text), all of more than a chunk: a chunk is a row, and the chunks of a text are spread over tasks."""
    cut = rows.mapInArrow(_chunks(chunk, overlap), "row bigint, n bigint, start bigint, last boolean, chunk string")
    spread = cut.repartition(rows.sparkSession.sparkContext.defaultParallelism * 4, "row", "n")
    wide = "row bigint, n bigint, start bigint, last boolean, chunk string, head array<bigint>, tail array<bigint>"
    parts = scratch(spread.mapInArrow(_cutter(pattern, chunk, overlap), wide))
    # Neighbours meet at the first boundary that both have in what they share.
    left = parts.where("not last").select("row", (F.col("n") + 1).alias("n"), "tail")
    meet = left.join(parts.select("row", "n", "head"), ["row", "n"]).select("row", "n", F.array_min(F.array_intersect("tail", "head")).alias("meet"))
    meet = scratch(meet)
    apart = meet.where("meet IS NULL").select("row").distinct()
    begin = meet.select("row", "n", F.col("meet").alias("begin"))
    stop = meet.select("row", (F.col("n") - 1).alias("n"), F.col("meet").alias("stop"))
    stitched = parts.drop("head", "tail").join(apart, "row", "left_anti").join(begin, ["row", "n"], "left").join(stop, ["row", "n"], "left")
    own = stitched.select("row", "n", "chunk", "start", F.coalesce("begin", F.lit(0)).alias("begin"), "stop")
    ids = own.mapInArrow(_piecewise(ranks_path, pattern), "row bigint, n bigint, ids array<int>")
    tokens = ids.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "ids"))).alias("x")).select("row", F.flatten("x.ids").alias("tokens"))
    # A text with a pre-token that is longer than what chunks share is stitched in one task, as far on as it takes.
    rest = rows.join(apart, "row", "left_semi").mapInArrow(
        _encoder(ranks_path, pattern, chunk, overlap, 1), T.StructType([*rows.schema, T.StructField("tokens", T.ArrayType(T.IntegerType(), False))])
    )
    return tokens.unionByName(rest.select("row", "tokens"))


def encode(df: DataFrame, ranks_path: str, text: str = "text", pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD) -> DataFrame:
    """df with tokens, an array of the ids of the whole text; such a column of df is replaced.

    Equals encoding every match of pattern on its own, without special tokens.
    A text longer than chunk characters is cut into chunks that overlap and are
    pre-tokenised on their own; neighbours are stitched where their boundaries
    meet, and the pieces between are encoded. From spread characters on, each
    chunk is a row, and tasks work on the chunks of a text side by side; only
    such texts are shuffled. A null or empty text has no tokens; repeated rows,
    nulls elsewhere and an empty table need nothing special. A text's length is
    bounded only by what one row can hold.
    """
    df = df.select(*[quoted(c) for c in extra_columns(df, "tokens")])
    at = [c.lower() for c in df.columns].index(text.lower())
    made = T.StructField("tokens", T.ArrayType(T.IntegerType(), False))
    many: Column = F.coalesce(F.length(quoted(text)) > max(chunk, spread), F.lit(False))
    short = df.where(~many).mapInArrow(_encoder(ranks_path, pattern, chunk, overlap, at), T.StructType([*df.schema, made]))
    long = scratch(df.where(many).withColumn("_cv_row", F.monotonically_increasing_id()))  # fixed once it is written
    if long.isEmpty():
        return short
    tokens = _encode_long(long.select(F.col("_cv_row").alias("row"), quoted(text).alias("text")), ranks_path, pattern, chunk, overlap)
    both = long.join(tokens, F.col("_cv_row") == F.col("row")).select(*[quoted(c) for c in df.columns], "tokens")
    return short.unionByName(both)


def _decoder(ranks_path: str, at: int):
    def run(batches):
        ranks = pieces_of(ranks_path).ranks
        raw = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            raw[rank] = token
        for b in batches:
            ids, ends = np.asarray(b.column(at).values), np.asarray(b.column(at).offsets)
            for lo in range(0, b.num_rows, STEP):
                cut = ends[lo : lo + STEP + 1].tolist()
                flat = ids[cut[0] : cut[-1]].tolist()
                out = [b"".join(map(raw.__getitem__, flat[x - cut[0] : y - cut[0]])) for x, y in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*b.slice(lo, STEP).columns, pa.array(out, pa.binary())], [*b.schema.names, "decoded"])

    return run


def decode(df: DataFrame, ranks_path: str, tokens: str = "tokens") -> DataFrame:
    """df with decoded, the raw bytes of its token ids joined; null or no ids give no bytes. An id without a rank is an error."""
    df = df.select(*[quoted(c) for c in extra_columns(df, "decoded")])
    at = [c.lower() for c in df.columns].index(tokens.lower())
    return df.mapInArrow(_decoder(ranks_path, at), T.StructType([*df.schema, T.StructField("decoded", T.BinaryType())]))


def digests(df: DataFrame) -> DataFrame:
    """n_tokens and the digests of ids and decoded bytes beside the other columns of an encoded and decoded df.

    tokens and decoded are as encode() and decode() make them, never null; no ids have the digests of nothing.
    """
    ids = F.array_join(F.col("tokens").cast("array<string>"), ",")
    return df.select(
        *[quoted(c) for c in extra_columns(df, "n_tokens", "ids_sha256", "decoded_sha256", "tokens", "decoded", "text")],
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
