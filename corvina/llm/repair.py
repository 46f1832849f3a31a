"""Conversations repaired at least cost, by a dynamic program that shares prefixes.

Each conversation has a signature, a letter for the role and fault of each row.
Distinct signatures are sorted and read as a prefix trie in depth-first order:
one stack of layers holds the path from the root, a signature keeps the layers
that it has in common with the one before, and only its own rows add layers.
The answer of a signature is read off where it ends. Rows of a conversation are
streamed in order, never held, so one of any length needs no more memory than
its signature.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, met_where_hot, quoted, scratch

#: What edits cost.
DELETE, RETELL, INSERT, TRUNCATED = 3, 2, 2, 1
#: Signatures of more conversations than this are dealt out when answers are given back.
HOT = 1000
#: Where a repaired conversation can stand: at its beginning, after a system row, after a user, after an assistant.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: Letters of a signature: the role's initial, s, u, a or o for any other, as a capital where the row is truncated; x where it must go.
MUST_GO = "x"


def _after(state: int, role: str) -> int | None:
    """Where one stands after a row of a role, if it may follow."""
    if role == "s":
        return SYSTEM if state == BEGIN else None
    if role == "u":
        return USER if state != USER else None
    return ASSISTANT if role == "a" and state == USER else None


def _inserted(state: int) -> list[tuple[int, str]]:
    """Where one can get by inserting rows, and the edits; a third insertion only comes back to where one has been."""
    first = _after(state, "u") if state != USER else ASSISTANT
    second = ASSISTANT if first == USER else USER
    return [(state, ""), (first, "I"), (second, "II")]


def _steps(letter: str) -> list[list[tuple[int, int, str]]]:
    """For each state after a row: the states before it, what it costs and the edits that end with the row's own."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in range(4)]
    role, extra = letter.lower(), TRUNCATED * letter.isupper()
    for source in range(4):
        for state, inserts in _inserted(source):
            cost = INSERT * len(inserts)
            out[state].append((source, cost + DELETE, inserts + "D"))
            if letter != MUST_GO:
                if (to := _after(state, role)) is not None:
                    out[to].append((source, cost + extra, inserts + "K"))
                to = ASSISTANT if state == USER else USER
                out[to].append((source, cost + extra + RETELL, inserts + "R"))
    return out


STEPS = {c: _steps(c) for c in "suaoSUAO" + MUST_GO}
#: What is inserted at the end: a conversation ends at its beginning or after an assistant.
ENDS = [(BEGIN, 0, ""), (SYSTEM, 2 * INSERT, "II"), (USER, INSERT, "I"), (ASSISTANT, 0, "")]


class Layer:
    """What can be reached after some rows: for each state its cost above the least, and its rank among the states' edits in ASCII order.

    Layers that are alike are one object, and so are the moves from them; there
    are few, as a state that can't lead to a least cost any more is left out. A
    move has the next layer, what the least cost grows by, and for each state
    the state before and the edits since.
    """

    known: dict[tuple, Layer] = {}

    def __init__(self, states: tuple):
        self.states, self.moves = states, {}

    def move(self, letter: str) -> tuple[Layer, int, tuple]:
        """All edits of a layer end with that of its row, so that none begins another:
        of two that come from different states the ranks decide, of two from one
        state the edits since.
        """
        if letter not in self.moves:
            best: list[tuple | None] = []
            for ways in STEPS[letter]:
                told = [(self.states[q][0] + cost, self.states[q][1], edits, q) for q, cost, edits in ways if self.states[q]]
                best.append(min(told) if told else None)
            whole = best[ASSISTANT][0]
            # From there all goes on that goes on from a system row, and from the beginning but for one system row, which is deleted.
            for state, more in ((BEGIN, DELETE), (SYSTEM, 0)):
                if best[state] and best[state][0] > whole + more:
                    best[state] = None
            least = min(b[0] for b in best if b)
            order = sorted(b[1:3] for b in best if b)
            states = tuple(b and (b[0] - least, order.index(b[1:3])) for b in best)
            layer = Layer.known.setdefault(states, Layer(states))
            self.moves[letter] = (layer, least, tuple(b and (b[3], b[2]) for b in best))
        return self.moves[letter]


ROOT = Layer(((0, 0), None, None, None))


class Trie:
    """Answers of sorted signatures: the moves along the path of the last one, of which the next keeps what both begin with."""

    def __init__(self):
        self.path: list[tuple] = []
        self.costs = array("q", [0])
        self.signature = ""

    def answer(self, signature: str) -> tuple[int, str]:
        """Least cost of a signature and, of the edits of that cost, the first in ASCII order."""
        n = _common(self.signature, signature)
        del self.path[n:], self.costs[n + 1 :]
        layer, cost = self.path[-1][0] if n else ROOT, self.costs[-1]
        for letter in signature[n:]:
            move = layer.move(letter)
            layer, cost = move[0], cost + move[1]
            self.path.append(move)
            self.costs.append(cost)
        self.signature = signature
        more, _, edits, q = min((layer.states[q][0] + c, layer.states[q][1], e, q) for q, c, e in ENDS if layer.states[q])
        told = [edits]
        for move in reversed(self.path):
            q, edits = move[2][q]
            told.append(edits)
        return cost + more, "".join(reversed(told))


def _common(a: str, b: str) -> int:
    """How many letters two strings begin with alike, found by halves."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults: the CRC-32 of conv_id:turn tells which row is lost, emptied, unpunctuated, repeated or told by a user.

    Nulls count as one blank, but conv_id and turn stay null in the result. A
    lost row stays as a marker with copies 0; a repeated one has copies 2.
    """
    blank = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    role = F.when(how == 4, "user").otherwise(blank("role"))
    copies = F.when(how == 0, 0).when(how == 3, 2).otherwise(1)
    return df.select(quoted("conv_id").alias("conv_id"), quoted("turn").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))


def _content() -> Column:
    return F.unhex(F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary"), 256))


def _in_order(df: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation after one another, by turn, nulls first, then role and content: a sort that spills, not a collection."""
    return df.sortWithinPartitions("conv_id", *first, *[F.col(c).asc_nulls_first() for c in ("turn", "role", "content")])


def signatures(rows: DataFrame) -> DataFrame:
    """Per conversation of rows(conv_id, turn, role, text, copies): signature, gaps, blank, duplicate, truncated and illegal."""
    kept = F.btrim("text", F.lit(SPACES))
    fault = F.when(F.col("copies") == 0, "-").when(kept == "", "b").when(~F.right(kept, F.lit(1)).isin(*".!?"), "t").otherwise("k")
    initial = F.left("role", F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    one = rows.select("conv_id", F.when(F.col("copies") > 0, F.col("turn")).alias("turn"), "role", letter.alias("letter"), fault.alias("fault"), _content().alias("content"),
        F.explode(F.sequence(F.lit(1), F.greatest(F.col("copies"), F.lit(1)))).alias("_copy"))
    seen = Window.partitionBy("conv_id", "content", F.col("fault") == "-").orderBy(F.col("turn").asc_nulls_first())
    told = one.repartition("conv_id").withColumn("_n", F.row_number().over(seen))
    code = (
        F.when(F.col("fault") == "-", "-")
        .when(F.col("fault") == "b", "b")
        .when(F.col("_n") > 1, "d")
        .when(F.col("fault") == "t", F.upper("letter"))
        .otherwise(F.col("letter"))
    )
    streamed = _in_order(told.withColumn("code", code)).select("conv_id", "turn", "letter", "code")
    names = ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order; what is open at the end of a batch goes on in the next."""
        open_: _Open | None = None
        for b in batches:
            ids, out = b.column(0), []
            turns = b.column(1).to_pylist()
            letters, codes = ("".join(b.column(i).to_pylist()) for i in (2, 3))
            starts = [0, *(1 + np.flatnonzero(_changes(ids))).tolist()]
            for x, y in zip(starts, [*starts[1:], len(ids)], strict=True):
                id = ids[x].as_py()
                if open_ is None or id != open_.id:
                    if open_ is not None:
                        out.append(open_.told())
                    open_ = _Open(id)
                open_.take(turns[x:y], letters[x:y], codes[x:y])
            if out:
                yield batch(out, ids.type)
        if open_ is not None:
            yield batch([open_.told()], ids.type)

    def batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (kind, pa.string(), *[pa.int64()] * 5), strict=True)], names)

    return streamed.mapInArrow(run, f"conv_id {_kind(streamed)}, signature string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint")


def _kind(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _changes(a: pa.Array) -> np.ndarray:
    """Where a row has another value than the one before; nulls are one value."""
    code = a.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return code[1:] != code[:-1]


class _Open:
    """A conversation that is being read: its signature so far, and counts."""

    def __init__(self, id: object):
        self.id, self.parts, self.before = id, [], ""
        self.least = self.most = self.turn = None
        self.turns = self.illegal = self.blank = self.duplicate = self.truncated = 0

    def take(self, turns: list, letters: str, codes: str) -> None:
        if "-" in codes:  # lost rows are only there for their conversation
            kept = [i for i, c in enumerate(codes) if c != "-"]
            turns, letters, codes = [turns[i] for i in kept], "".join(letters[i] for i in kept), "".join(codes[i] for i in kept)
        row = self.before + letters
        self.illegal += sum(p not in ("su", "ua", "au") for p in map("".join, zip(row, row[1:], strict=False)))
        self.before = row[-1:]
        for t in turns:
            if t is not None and t != self.turn:
                self.least = t if self.least is None else self.least
                self.most = self.turn = t
                self.turns += 1
        b, d = codes.count("b"), codes.count("d")
        self.blank, self.duplicate = self.blank + b, self.duplicate + d
        self.truncated += sum(map(codes.count, "SUAO"))
        self.parts.append(codes.replace("b", MUST_GO).replace("d", MUST_GO))

    def told(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return self.id, "".join(self.parts), gaps, self.blank, self.duplicate, self.truncated, self.illegal


def audits(signed: DataFrame) -> DataFrame:
    """signed with cost and audit: distinct signatures are counted, sorted over tasks, answered along their trie, and given back to the conversations of each."""
    distinct = signed.groupBy("signature").agg(F.count("*").alias("_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for b in batches:
            told = [trie.answer(x) for x in b.column(0).to_pylist()]
            cost, audit = zip(*told, strict=True) if told else ((), ())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cost, pa.int64()), pa.array(audit, pa.string())], ["signature", "_n", "cost", "audit"])

    ranged = distinct.repartitionByRange("signature").sortWithinPartitions("signature")
    told = scratch(ranged.mapInArrow(run, "signature string, _n bigint, cost bigint, audit string"))
    return met_where_hot(signed, told, ["signature"], "conv_id", F.col("_n") > HOT).drop("_n")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(df: DataFrame) -> DataFrame:
    """Conversations, rows(conv_id, turn, role, text, copies), repaired: a head for each, then its turns.

    A head has at = -1, the counts of faults, cost and audit; a turn at from 0,
    the edit that made it (K kept, R retold by another role, I inserted), role
    and text. The heads and turns of a conversation lie after one another in one
    partition.

    A row without copies only tells of its conversation, a conversation of
    such rows alone has a head of zeros, and an empty table gives an empty
    result. Rows of one turn go by role and then by the SHA-256 of role and
    text, so rows that are repeated are neighbours, and all but the first are
    duplicates. A null conv_id is a conversation; a null turn comes before all
    others and counts in no gap. A role without a letter may not stay. A very
    long conversation is streamed, and takes memory for its signature and audit
    alone; a very long text is held as one value. Other columns of df are left
    out.
    """
    rows = scratch(signatures(df))
    heads = audits(rows).select("conv_id", *COUNTS, "audit")
    none = [F.lit(None).cast("bigint").alias(c) for c in COUNTS] + [F.lit(None).cast("string").alias("audit")]
    told = df.where("copies > 0").select("conv_id", *none, F.lit(1).alias("_kind"), "turn", "role", "text", _content().alias("content"), F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"))
    null = [F.lit(None).cast(told.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "content", "_copy")]
    both = told.unionByName(heads.select("*", F.lit(0).alias("_kind"), *null))
    streamed = _in_order(both.repartition("conv_id"), "_kind").select("conv_id", *COUNTS, "audit", "role", "text")
    n_head = len(COUNTS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = iter(())
        id, blank = None, [None] * n_head
        for b in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[n_head] is not None:  # a head
                    if id is not None:
                        out += [(*id, *blank, *t) for t in turns.send(None)]
                    id, turns = row[:1], _edited(row[n_head])
                    next(turns)
                    out.append((*row[: n_head + 1], -1, None, None, None))
                else:
                    out += [(*id, *blank, *t) for t in turns.send(row[-2:])]
            if out:
                yield batch(out, b.schema)
        if id is not None and (out := [(*id, *blank, *t) for t in turns.send(None)]):
            yield batch(out, b.schema)

    def batch(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        kinds = [*schema.types[: n_head + 1], pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    names = ["conv_id", *COUNTS, "audit", "at", "edit", "role", "text"]
    return streamed.mapInArrow(run, f"conv_id {_kind(df)}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, at bigint, edit string, role string, text string")


def _edited(audit: str) -> Generator[list[tuple], tuple[str, str] | None, None]:
    """Gets the rows of a conversation one by one, None at its end, and gives the turns that each leads to."""
    state, at, place = BEGIN, 0, 0
    row = yield []
    while True:
        turns = []
        while place < len(audit):
            edit = audit[place]
            if edit != "I" and row is None:
                break
            place += 1
            if edit != "D":
                needed = "assistant" if state == USER else "user"
                role, text = (needed, "") if edit == "I" else (needed if edit == "R" else row[0], row[1])
                state = _after(state, role[:1])
                turns.append((at, edit, role, text))
                at += 1
            if edit != "I":
                break
        row = yield turns


def digests(repaired: DataFrame) -> DataFrame:
    """The head of every conversation with the SHA-256 of its turns, role:text, joined by newlines; read in the order that repair() tells them."""
    names = ["conv_id", *COUNTS, "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha = None, None
        for b in batches:
            heads, hashes = [], []
            for i, (at, role, text) in enumerate(zip(*(b.column(c).to_pylist() for c in ("at", "role", "text")), strict=True)):
                if at == -1:
                    if head is not None:
                        heads.append(head)
                        hashes.append(sha.hexdigest())
                    head, sha = b.slice(i, 1).select(names), hashlib.sha256()
                else:
                    sha.update(f"{chr(10) if at else ''}{role}:{text}".encode())
            if heads:
                yield batch(heads, hashes)
        if head is not None:
            yield batch([head], [sha.hexdigest()])

    def batch(heads: list[pa.RecordBatch], hashes: list[str]) -> pa.RecordBatch:
        t = pa.Table.from_batches(heads).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*t.columns, pa.array(hashes)], [*names, "repaired_sha256"])

    one = repaired.select(*names, "at", "role", "text")
    return one.mapInArrow(run, f"conv_id {_kind(one)}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, repaired_sha256 string")
