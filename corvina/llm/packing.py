"""Best-fit packing by levels: partitions pack what they hold, and what is left over meets in a tree.

Documents are cut into pieces of at most a sequence's length. Each partition
packs its pieces, longest first, each into the fullest bin that has room, and
gives away the bins that are nearly full. The other bins go up: groups of them
meet, first as items of their own, then opened, and are packed again. Only the
last group gives away all it has. A group's bins are bounded, and so is what a
level hands to the next: once groups are that large, a bin over half full can
meet no other such bin, so only the one bin of a group at or below half goes on.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import extra_columns, quoted, scratch

#: Room that a nearly full bin may have left; items that a task packs at once; bins that a group of the tree holds.
NEARLY, LOCAL, GROUP = 4, 200_000, 100_000
#: Characters that are tokenised at once; words that are held for the next time, and their longest.
CHARS, HELD, HELD_CHARS = 1 << 22, 400_000, 48
#: Words that are tokenised at once, and words in a text of theirs.
WORDS, JOINED = 10_000, 200
#: Marks that are cut from the end of a word before it is looked up.
MARKS = ".,;:!?"


class Words:
    """Ids of words by a tokenizer of the tokenizers library; words are held for the next time, in two generations.

    The tokenizer drops white space, and nothing it does reaches over ASCII white
    space; so a text's ids are its words' ids in a row. Nor does anything reach
    over the border of a letter or digit and marks behind it. Strings of special
    tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the machine already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.held: dict[str, bytes] = {}
        self.aside: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words. Words of letters alone are one pre-token each, whose last id alone ends a word: they are told apart in a text of many."""
        plain = [w for w in words if w.isalpha() and w.lower().isalpha() and is_normalized("NFC", w)]
        ids: dict[str, bytes] = {}
        for i in range(0, len(plain), WORDS):
            some = plain[i : i + WORDS]
            text = [" ".join(some[k : k + JOINED]) for k in range(0, len(some), JOINED)]
            flat = np.array([x for e in self.tokenizer.encode_batch_fast(text, add_special_tokens=False) for x in e.ids], "<u4")
            ends = 4 * (1 + np.flatnonzero(self.ends[flat]))
            raw, first = flat.tobytes(), 0
            if len(ends) == len(some):
                for word, end in zip(some, ends.tolist(), strict=True):
                    ids[word], first = raw[first:end], end
        order = list(words - ids.keys())
        for i in range(0, len(order), WORDS):
            some = order[i : i + WORDS]
            for word, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                ids[word] = np.array(e.ids, "<u4").tobytes()
        return ids

    def ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian numbers of 32 bits."""
        if len(self.held) >= HELD:
            self.aside, self.held = self.held, {}
        held, aside = self.held, self.aside
        out: list[bytes | None] = []
        new: dict[str, tuple[str, str]] = {}
        for w in words:
            ids = held.get(w)
            if ids is None:
                if (ids := aside.get(w)) is not None:
                    held[w] = ids
                else:
                    low = w.lower() if w.isascii() else w
                    stem = low.rstrip(MARKS)
                    whole = not stem or not (stem[-1].isalnum() if stem[-1].isascii() else ord(stem[-1]) < 0x250 and stem[-1].isalpha())
                    new[w] = (low, "") if whole else (stem, low[len(stem) :])
            out.append(ids)
        if new:
            parts = {p for both in new.values() for p in both if p}
            known = {p: ids for p in parts if (ids := held.get(p) or aside.get(p)) is not None}
            known |= self._learn(parts - known.keys()) | {"": b""}
            told = {w: known[a] + known[b] for w, (a, b) in new.items()}
            held.update((w, ids) for w, ids in told.items() if len(w) <= HELD_CHARS)
            out = [told[w] if ids is None else ids for w, ids in zip(words, out, strict=True)]
        return out  # type: ignore[return-value]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        ids = self.ids_of(coded.dictionary.to_pylist())
        n = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        first = np.cumsum(n) - n
        flat = np.frombuffer(b"".join(ids), "<u4")
        code = coded.indices.to_numpy(zero_copy_only=False)
        each = n[code]
        ends = np.concatenate([[0], np.cumsum(each)])
        at = np.repeat(first[code] - ends[:-1], each) + np.arange(ends[-1])
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return flat[at], np.diff(ends[offsets])


def _stretches(text: str) -> Iterator[str]:
    """A very long text in stretches that end at a blank; one without blanks is a stretch of its own."""
    at = 0
    while len(text) - at > CHARS:
        end = max(text.rfind(" ", at, at + CHARS), text.rfind("\n", at, at + CHARS))
        if end <= at:
            ends = [e for e in (text.find(" ", at + CHARS), text.find("\n", at + CHARS)) if e > 0]
            if not ends:
                break
            end = min(ends)
        yield text[at:end]
        at = end
    yield text[at:]


_known: dict[str, Words] = {}


def _words(path: str) -> Words:
    """One table of words for all tasks that a worker runs after one another."""
    if path not in _known:
        _known[path] = Words(path)
    return _known[path]


def _encoded(texts: pa.Array, words: Words) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from one to another with their ids in a row and how many each has, about CHARS characters at a time."""
    ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    at, n = 0, len(texts)
    while at < n:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + CHARS, "right")))
        if to == at + 1 and ends[at] - before > CHARS:
            ids = np.concatenate([words.encode(pa.array([x]))[0] for x in _stretches(texts[at].as_py())])
            yield at, to, ids, np.array([len(ids)])
        else:
            yield at, to, *words.encode(texts.slice(at, to - at))
        at = to


def pieces(df: DataFrame, tokenizer: str, text: str = "text", size: int = 2048, end_id: int = 0, ids: bool = True) -> DataFrame:
    """The pieces of each row's text: its ids by a tokenizer file, then end_id, cut every size ids.

    Adds piece (int, from 0), start and length (long), ids_crc32 (long, of
    little-endian numbers of 32 bits) and, if asked for, ids. The text itself is
    left out; columns of df with such names are replaced. A null or empty text is
    one piece of end_id alone. Rows are told one by one, so repeated rows have
    pieces of their own; an empty table has none. A very long text is tokenised
    in stretches; of one text only the ids are held.
    """
    made = ("piece", "start", "length", "ids_crc32", "ids")
    given = [quoted(c) for c in extra_columns(df, *made, text)]
    row = df.select(F.struct(F.lit(0).alias("_cv_0"), *given).alias("_cv_row"), F.coalesce(quoted(text), F.lit("")).alias("_cv_t"))
    fields = [T.StructField("_cv_row", row.schema[0].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in made[1:4]] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer)
        for b in batches:
            for at, to, flat, n in _encoded(b.column(1).cast(pa.string()), words):
                flat = np.insert(flat, np.cumsum(n), end_id).astype("<u4")
                n = n + 1
                k = -(-n // size)
                doc = np.repeat(np.arange(to - at), k)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
                length = np.minimum(size, n[doc] - piece * size)
                ends = np.cumsum(length)
                raw = memoryview(flat.tobytes())
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip((ends - length).tolist(), ends.tolist(), strict=True)]
                out = [b.column(0).take(pa.array(at + doc)), pa.array(piece.astype(np.int32)), pa.array(piece * size), pa.array(length), pa.array(crc, pa.int64())]
                if ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat.view("<i4"))))
                yield pa.RecordBatch.from_arrays(out, names)

    out = row.mapInArrow(run, T.StructType(fields))
    return out.select(*[quoted_in("_cv_row", f.name) for f in row.schema[0].dataType.fields[1:]], *names[1:])


def quoted_in(outer: str, name: str):
    return F.col(outer).getField(name).alias(name)


def best_fit(length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit, longest first: the items in the order they are put, and the bin of each.

    Items of a length go together: while bins of the least sufficient room are
    there, each takes as many as it can, as it would one by one. So the steps
    are bounded by pairs of a length and a room, however many items there are.
    """
    order = np.argsort(-length, kind="stable")
    sizes, counts = np.unique(length, return_counts=True)
    bin_of = np.empty(len(length), np.int64)
    rooms: dict[int, list[np.ndarray]] = defaultdict(list)
    mask, n_bins, at = 0, 0, 0  # mask: a bit for each room that some bin has
    for s, c in zip(sizes[::-1].tolist(), counts[::-1].tolist(), strict=True):
        while c:
            fits = mask >> s
            room = s + (fits & -fits).bit_length() - 1 if fits else size
            each = room // s
            if fits:
                bins = rooms[room].pop()
                if not rooms[room]:
                    mask ^= 1 << room
            else:
                bins = np.arange(n_bins, n_bins + -(-c // each))
                n_bins += len(bins)
            full = min(len(bins), c // each)
            for some, k in ((bins[:full], each), (bins[full : full + 1], min(c - full * each, each)), (bins[full + 1 :], 0)):
                if k:
                    bin_of[at : at + k * len(some)] = np.repeat(some, k)
                    at, c = at + k * len(some), c - k * len(some)
                left = room - k * s
                if len(some) and left:
                    rooms[left].append(some)
                    mask |= 1 << left
    return order, bin_of


def _binned(members: pa.Array, n: np.ndarray, size: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Items in bins: the items bin by bin, the place of each, where each bin ends, and how full it is."""
    order, bin_of = best_fit(n, size)
    by_bin = np.argsort(bin_of, kind="stable")
    order = order[by_bin]
    length, ends = n[order], np.cumsum(np.bincount(bin_of))
    after = np.cumsum(length)
    fill = np.diff(np.concatenate([[0], after[ends - 1]]))
    place = after - length - np.repeat(after[ends - 1] - fill, np.diff(np.concatenate([[0], ends])))
    return members.take(pa.array(order)), place, ends, fill


def _batch(row: pa.Array, n: np.ndarray, place: np.ndarray, ends: np.ndarray, done: np.ndarray, names: list[str]) -> pa.RecordBatch:
    members = pa.StructArray.from_arrays([row, pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32))], names=["row", "n", "place"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), members)
    return pa.RecordBatch.from_arrays([pa.array(done), lists], names)


def _only(ends: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The items of the bins that are kept, and where those bins end."""
    counts = np.diff(np.concatenate([[0], ends]))
    return np.flatnonzero(np.repeat(keep, counts)), np.cumsum(counts[keep])


def pack(df: DataFrame, length: str = "length", size: int = 2048) -> DataFrame:
    """df with sequence_id and offset (long): rows in as few sequences of at most size as hierarchical best fit needs.

    Rows go along whole from level to level, so df should hold ids and not
    texts. Columns of df with such names are replaced. A row whose length is
    null, below 1 or above size is in no sequence: both are null. Rows of equal
    length go in the order they are read; repeated rows are items of their own;
    an empty table gives an empty result. Sequences are numbered by where they
    lie in what each level has written, so that a task that runs again tells the
    same numbers.
    """
    made = ("sequence_id", "offset")
    given = [quoted(c) for c in extra_columns(df, *made)]
    n = quoted(length)
    items = df.select(F.struct(F.lit(0).alias("_cv_0"), *given).alias("row"), F.when(n.between(1, size), n).cast("int").alias("n"))
    row = items.schema["row"].dataType
    member = T.StructType([T.StructField("row", row), T.StructField("n", T.IntegerType()), T.StructField("place", T.IntegerType())])
    schema = T.StructType([T.StructField("done", T.BooleanType()), T.StructField("members", T.ArrayType(member))])
    names = ["done", "members"]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bins of what a partition holds, LOCAL items at a time."""
        held, n_held = [], 0
        for b in batches:
            held.append(b)
            n_held += b.num_rows
            if n_held >= LOCAL:
                yield from packed(held)
                held, n_held = [], 0
        if n_held:
            yield from packed(held)

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        if t["n"].null_count:  # rows that are in no sequence
            out = t.filter(pc.is_null(t["n"])).combine_chunks()
            nulls = pa.nulls(len(out), pa.int32())
            members = pa.StructArray.from_arrays([out["row"].combine_chunks(), nulls, nulls], names=["row", "n", "place"])
            yield pa.RecordBatch.from_arrays([pa.array([True]), pa.ListArray.from_arrays(pa.array([0, len(out)], pa.int32()), members)], names)
            t = t.filter(pc.is_valid(t["n"]))
        t = t.combine_chunks()
        if not len(t):
            return
        n = t["n"].to_numpy().astype(np.int64)
        at, place, ends, fill = _binned(pa.array(np.arange(len(n))), n, size)
        at = at.to_numpy()
        yield _batch(t["row"].combine_chunks().take(pa.array(at)), n[at], place, ends, fill >= size - NEARLY, names)

    def merge(last: bool):
        def run(t: pa.Table) -> pa.Table:
            """A group of bins: nearly full unions of whole bins, then the bins of what the others hold."""
            t = t.sort_by("_k")
            lists = t["members"].combine_chunks()
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            members = lists.flatten()
            row, n, place = (members.field(c) for c in ("row", "n", "place"))
            n, place = n.to_numpy().astype(np.int64), place.to_numpy().astype(np.int64)
            counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
            first = np.cumsum(counts) - counts
            fill = np.add.reduceat(n, first)
            # Bins as items: the members of each follow one another, moved by the bin's own place.
            order, shift, ends, filled = _binned(pa.array(np.arange(len(fill))), fill, size)
            order = order.to_numpy()
            keep = (filled >= size - NEARLY)
            some, _ = _only(ends, keep)
            whole = order[some]
            each = counts[whole]
            at = np.repeat(first[whole] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            of_bin = np.add.reduceat(counts[order], np.concatenate([[0], ends[:-1]]))
            out = [_batch(row.take(pa.array(at)), n[at], place[at] + np.repeat(shift[some], each), np.cumsum(of_bin[keep]), np.ones(keep.sum(), bool), names)]
            # The others are opened.
            rest = np.ones(len(n), bool)
            rest[at] = False
            rest = np.flatnonzero(rest)
            if len(rest):
                at, place, ends, filled = _binned(pa.array(rest), n[rest], size)
                at = at.to_numpy()
                out.append(_batch(row.take(pa.array(at)), n[at], place, ends, np.full(len(ends), True) if last else filled * 2 > size, names))
            return pa.Table.from_batches(out)

        return run

    level = scratch(items.mapInArrow(local, schema))
    done = [level.where("done")]
    while n := (left := level.where("NOT done")).count():
        groups = -(-n // GROUP)
        dealt = left.select("members", F.monotonically_increasing_id().alias("_k")).withColumn("_g", F.col("_k") % groups)
        level = scratch(dealt.groupBy("_g").applyInArrow(merge(groups == 1), schema))
        done.append(level.where("done"))
    bins = reduce(DataFrame.unionByName, done).withColumn("sequence_id", F.monotonically_increasing_id()).select("sequence_id", F.explode("members").alias("_m"))
    place = F.col("_m.place").cast("bigint")
    fields = [F.col("_m.row").getField(f.name).alias(f.name) for f in row.fields[1:]]
    return bins.select(*fields, F.when(place.isNotNull(), F.col("sequence_id")).alias("sequence_id"), place.alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of every sequence, from packed pieces that hold ids: sequence_id, n_pieces, ids."""
    piece = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.where("sequence_id IS NOT NULL").groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), piece.alias("_p"))
    return joined.select("sequence_id", "n_pieces", F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids"))
