"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders, so that a question with
other values in it has the same template. Windows of the documents' templates
are joined by hash with windows of the benchmark's templates; where enough of an
item's windows lie together, the fillings of its slots are aligned and must be
consistent: one value of the item always stands for one value in the document.

A document that leaks an item holds one at least of the item's rarest windows,
of which so many are taken that the others would not be enough. Only these
probes meet the documents; all windows of an item are looked at in the pairs
that they find. Bloom filters of bounded size, of the probes and of all windows, hold back
what can have no partner before anything is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, content_key, met, quoted, scratch
from .hashing import U, bits_for, bloom, mix, passes

#: Fixed words for units of measure, as they follow a number.
UNITS = frozenset(
    "% € $ £ ° mm cm m km in ft yd mi mg g kg t oz lb lbs ml l cl s sec secs min mins h hr hrs hour hours minute minutes second seconds "
    "day days week weeks month months year years metre metres meter meters kilometre kilometres kilometer kilometers mile miles inch inches "
    "foot feet gram grams kilogram kilograms tonne tonnes pound pounds dollar dollars euro euros cent cents percent litre litres liter liters "
    "degree degrees w kw v a hz khz mhz ghz kb mb gb tb mph kmh".split()
)
WORD, NUMBER, UNIT, CAPITAL, STOP, MARK = range(6)
NUM_CODE, UNIT_CODE, NAME_CODE = U(0x1), U(0x2), U(0x3)
#: Readings of capitalised words: none is a name, those inside sentences are, all are with each sentence's
#: first on its own (as in Then Tom), all are and the first belongs to a run that it begins (as in Tom Smith).
NO_NAMES, INNER, FIRST_ALONE, FIRST_JOINED = READINGS = range(4)
WINDOW = 5
#: Characters of documents that are read together, about.
READ_CHARS = 200_000


#: Marks that stand around words.
QUOTES = "“”„«»‘’‚…–—¿¡"
_BASE = 0x9E3779B97F4A7C15


class Reader:
    """Reads texts into the kinds and codes of their tokens, by array operations on their bytes.

    Tokens are runs of ASCII letters, digits and all other bytes from 0x80 on,
    with marks of numbers (3.5, 10:30, 1,000) inside; sentence ends; and % or $.
    """

    def __init__(self):
        byte = np.arange(256)
        digit = (byte >= 48) & (byte <= 57)
        self.digit, self.upper = digit, (byte >= 65) & (byte <= 90)
        self.word = digit | self.upper | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
        self.single = np.isin(byte, np.frombuffer(b".!?\n%$", np.uint8))
        self.joint = np.isin(byte, np.frombuffer(b".,:/", np.uint8))
        self.up = self.down = np.ones(1, U)
        self.units = np.sort(np.array([self.codes(u.encode(), np.array([0]), np.array([len(u.encode())]))[0] for u in UNITS], U))

    def codes(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of raw[start:end]: differences of a running sum of bytes times powers of an odd base."""
        if len(self.up) < len(raw) + 1:
            n = max(1 << 16, 2 * len(raw))
            self.up = np.cumprod(np.concatenate([[U(1)], np.full(n, _BASE, U)]))
            self.down = np.cumprod(np.concatenate([[U(1)], np.full(n, pow(_BASE, -1, 2**64), U)]))
        sums = np.zeros(len(raw) + 1, U)
        np.cumsum((np.frombuffer(raw, np.uint8).astype(U) + U(1)) * self.up[: len(raw)], out=sums[1:])
        return mix((sums[end] - sums[start]) * self.down[start])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(kinds, codes, which text) of the tokens of all texts; between two texts there is a sentence end."""
        raws, lows, odd = [], [], []
        for i, text in enumerate(texts):
            if not text.isascii():
                for q in QUOTES:
                    text = text.replace(q, " ")
            raw, low = text.encode("utf-8", "replace"), text.lower().encode("utf-8", "replace")
            if len(low) != len(raw):  # letters whose small form has another length, like that of the dotted I, stay as they are but count as capitals
                sizes = [(c, len(c.encode("utf-8", "replace"))) for c in text]
                low = b"".join(x if len(x := c.lower().encode("utf-8", "replace")) == n else c.encode("utf-8", "replace") for c, n in sizes)
                odd.append((i, np.repeat(np.array([c.lower() != c for c, _ in sizes]), [n for _, n in sizes])))
            raws.append(raw)
            lows.append(low)
        raw, low = b"\n".join(raws), b"\n".join(lows)
        b = np.frombuffer(raw, np.uint8)
        if not len(b):
            return np.empty(0, np.int8), np.empty(0, U), np.empty(0, np.int64)
        begin = np.cumsum([0, *(len(r) + 1 for r in raws)])
        upper = b != np.frombuffer(low, np.uint8)
        for i, capitals in odd:
            upper[begin[i] : begin[i + 1] - 1] = capitals
        word = self.word[b]
        word[1:-1] |= self.joint[b[1:-1]] & word[:-2] & self.digit[b[2:]]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
        alone = np.flatnonzero(self.single[b] & ~word)
        start, end = np.concatenate([edge[::2], alone]), np.concatenate([edge[1::2], alone + 1])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
        code = self.codes(low, start, end)
        first = b[start]
        capital = self.upper[first]
        beyond = np.flatnonzero(first >= 128)
        if len(beyond) and upper.any():
            at, lead = start[beyond], first[beyond]
            width = 2 + (lead >= 0xE0) + (lead >= 0xF0)
            capital[beyond] = np.any([upper[np.minimum(at + i, len(b) - 1)] & (i < width) for i in range(4)], axis=0)
        kind = np.where(self.digit[first], NUMBER, np.where(capital, CAPITAL, WORD)).astype(np.int8)
        # A unit in capitals is as good as one in small letters.
        at = np.minimum(np.searchsorted(self.units, code), len(self.units) - 1)
        kind[(self.units[at] == code) & (kind != NUMBER)] = UNIT
        mark = ~self.word[first]
        kind[mark] = STOP
        kind[mark & ((first == 37) | (first == 36))] = MARK
        return kind, code, np.searchsorted(begin, start, "right") - 1


def initial(kind: np.ndarray) -> np.ndarray:
    """Whether each token begins a sentence."""
    return np.concatenate([[True], kind[:-1] == STOP])


def readings(kind: np.ndarray) -> list[int]:
    """The readings that make a template of their own from these tokens."""
    capital, first = kind == CAPITAL, initial(kind)
    out = [NO_NAMES]
    if (capital & ~first).any():
        out.append(INNER)
    if (capital & first).any():
        out.append(FIRST_ALONE)
        if ((capital & first)[:-1] & capital[1:]).any():
            out.append(FIRST_JOINED)
    return out


def template(kind: np.ndarray, code: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, slots, values, kept) of read tokens: template codes, whether each is a slot, a hash of what fills it, and which tokens are left.

    names is one of READINGS. Capitalised words that it takes for names are
    slots too; a run of names is one slot. Any other is an ordinary word in
    lower case.
    """
    value = code
    number = kind == NUMBER
    drop = kind == STOP
    slot = number
    if number.any() or (kind == MARK).any():
        after_number = np.concatenate([[False], number[:-1]])
        unit = ((kind == UNIT) | (kind == MARK)) & after_number
        code = np.where(number, NUM_CODE, np.where(unit, UNIT_CODE, code))
        slot = number | unit
        drop = drop | ((kind == MARK) & ~after_number)
    if names != NO_NAMES:
        begins = initial(kind)
        name = kind == CAPITAL
        if names == INNER:
            name &= ~begins
        code = np.where(name, NAME_CODE, code)
        slot = slot | name
        # A run of names is one slot, filled by all of them.
        first = name & ~np.concatenate([[False], name[:-1]])
        if names == FIRST_ALONE:
            first |= name & np.concatenate([[False], begins[:-1]])
        if first.any():
            filled = np.zeros(int(first.sum()), U)
            np.add.at(filled, (np.cumsum(first) - 1)[name], mix(value[name] + U(1)))
            value = value.copy()
            value[first] = filled
            drop = drop | (name & ~first)
    keep = ~drop
    return code[keep], slot[keep], value[keep], keep


def windows(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of hashed codes: polynomials of an odd base, mixed."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, U)
    h = codes[:n].copy()
    for i in range(1, size):
        h *= U(_BASE)
        h += codes[i : n + i]
    return mix(h)


def keyed(hashes: np.ndarray, size: int, names: int) -> np.ndarray:
    """Hashes of windows of a size in a reading; those of another size or reading differ."""
    return hashes ^ U((16 * size + names + 1) * 0xD6E8FEB86659FD93 % 2**64)


def filled(slot: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """For each window the fillings of its places, 0 where there is no slot."""
    v = np.where(slot, value | U(1), U(0))
    return v[np.arange(max(0, len(v) - size + 1))[:, None] + np.arange(size)]


def item_windows(tokens: tuple, names: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, fillings, places) of an item's windows in a reading; a shorter item is one window.

    A window of nothing but slots says nothing where any sentence begins with
    one, so it is left out in the last two readings.
    """
    codes, slot, value, _ = template(*tokens[:2], names)
    size = min(size, len(codes))
    if not size:
        return np.empty(0, U), np.empty((0, 0), U), np.empty(0, np.int64)
    at = np.arange(len(codes) - size + 1)
    h, v = keyed(windows(codes, size), size, names), filled(slot, value, size, at)
    if names >= FIRST_ALONE:
        told = ~(v != 0).all(1)
        h, v, at = h[told], v[told], at[told]
    return h, v, at


def document_windows(tokens: tuple, sizes: list[int]):
    """(reading, size, hashes, places, which text, fillings by places) of documents read together, in all readings, as the item may differ in any."""
    kind, code, of = tokens
    own = readings(kind) if len(kind) else []
    raw: dict = {}
    for names in READINGS if own else ():
        if names in own:  # else the reading before has the same template
            codes, slot, value, kept = template(kind, code, names)
            text, raw = of[kept], {}
            for size in sizes:
                if len(codes) >= size:
                    at = np.flatnonzero(text[size - 1 :] == text[: len(text) - size + 1])  # no window reaches into the next text
                    raw[size] = windows(codes, size)[at], at, text[at]
        for size, (h, at, which) in raw.items():
            yield names, size, keyed(h, size, names), at, which, lambda at, s=slot, v=value, n=size: filled(s, v, n, at)


def filled(slot: np.ndarray, value: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """The fillings of the windows at some places, 0 where there is no slot."""
    place = at[:, None] + np.arange(size)
    return np.where(slot[place], value[place] | U(1), U(0))


def placed(pos: np.ndarray, at: np.ndarray, need: float, slack: int):
    """Indices of the windows of each stretch that has enough of the item's windows together, those with the most first."""
    if len(np.unique(at)) < need:
        return
    shift = pos - at
    order = np.argsort(shift, kind="stable")
    at, shift = at[order], shift[order]
    # A stretch begins with each shift and holds those up to slack beyond it.
    start = np.flatnonzero(np.concatenate([[True], shift[1:] != shift[:-1]]))
    end = np.searchsorted(shift, shift[start] + slack, "right")
    many, ats = np.zeros(len(start), np.int64), at.tolist()
    seen: dict = {}
    lo = hi = 0
    for i, (a, b) in enumerate(zip(start.tolist(), end.tolist(), strict=True)):
        for x in ats[lo:a]:
            seen[x] -= 1
            if not seen[x]:
                del seen[x]
        for x in ats[hi:b]:
            seen[x] = seen.get(x, 0) + 1
        lo, hi = a, b
        many[i] = len(seen)
    for i in np.argsort(-many, kind="stable"):
        if many[i] < need:
            return
        a, b = start[i], end[i]
        # It ends where it has all of its different windows.
        yield order[a : a + np.unique(at[a:b], return_index=True)[1].max() + 1]


def slots(pos: np.ndarray, at: np.ndarray, item: np.ndarray, doc: np.ndarray) -> tuple[int, int, bool]:
    """(slots compared, slots filled otherwise than in the item, whether one value of the item stands for several) of matched windows."""
    step = np.arange(item.shape[1])
    i, d = (at[:, None] + step).ravel(), (pos[:, None] + step).ravel()
    a, b = item.ravel(), doc.ravel()
    slot = a != 0
    i, d, a, b = i[slot], d[slot], a[slot], b[slot]
    # Each slot of the item is aligned once, by the shift nearest to the most common one that has it.
    shifts, counts = np.unique(pos - at, return_counts=True)
    order = np.lexsort((d, i, np.abs(d - i - shifts[counts.argmax()])))
    i, a, b = i[order], a[order], b[order]
    _, one = np.unique(i, return_index=True)
    a, b = a[one], b[one]
    stands: dict = {}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        stands.setdefault(x, set()).add(y)
    return len(a), int((a != b).sum()), any(len(v) > 1 for v in stands.values())


def consistent(item: tuple, doc: tuple, share: float) -> tuple[int, int, int, int] | None:
    """(windows found, windows, slots compared, slots filled otherwise) of an item (hashes, fillings, places) in a document
    (hashes, fillings, places): of the first stretch, by its windows, that is consistent."""
    h, item_v, item_at = item
    doc_h, doc_v, doc_at = doc
    order = np.argsort(h, kind="stable")
    lo, hi = np.searchsorted(h[order], doc_h), np.searchsorted(h[order], doc_h, "right")
    times = hi - lo
    d = np.repeat(np.arange(len(doc_h)), times)
    k = order[np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
    pos, at = doc_at[d], item_at[k]
    for part in placed(pos, at, share * len(h), max(2, len(h) // 5)):
        compared, other, clash = slots(pos[part], at[part], item_v[k[part]], doc_v[d[part]])
        if not clash:
            return len(np.unique(at[part])), len(h), compared, other
    return None


def leak(item: str, text: str, size: int = WINDOW, share: float = 0.8) -> tuple[int, int, int, int] | None:
    """What consistent() says of one item in one text, by the reading with the most windows; None if the text doesn't leak it."""
    read = Reader()
    item_tokens, tokens = read([item]), read([text])
    if not len(item_tokens[0]):
        return None
    own = [item_windows(item_tokens, names, size) for names in READINGS]
    sizes = sorted({x[1].shape[1] for x in own if len(x[0])})
    best = None
    for names, width, h, at, _, fill in document_windows(tokens, sizes):
        if len(own[names][0]) and own[names][1].shape[1] == width:
            found = consistent(own[names], (h, fill(at), at), share)
            if found and (best is None or found[0] > best[0]):
                best = found
    return best


# Both sides, and their join.


def _items(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(k, item_id, names, size, h, v, at) of each item and reading with windows, h, v and at being arrays, written once."""

    def run(batches):
        read = Reader()
        for b in batches:
            rows = []
            for r in range(b.num_rows):
                tokens = read([b.column(1)[r].as_py() or ""])
                if not len(tokens[0]):
                    continue
                for names in READINGS:
                    h, v, at = item_windows(tokens, names, size)
                    if len(h):
                        rows.append((r, names, v.shape[1], h.view(np.int64), v.view(np.int64).ravel(), at))
            ids = b.column(0).take(pa.array([x[0] for x in rows], pa.int64()))
            kinds = (pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3)
            made = [pa.array([x[i + 1] for x in rows], t) for i, t in enumerate(kinds)]
            number = pa.array([x[0] for x in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, b.column(2).take(number), *made], ["item_id", "k", "names", "size", "h", "v", "at"])

    kind = benchmark.select(quoted(item_id)).schema[0].dataType
    made = T.StructType.fromDDL("k bigint, names int, size int, h array<bigint>, v array<bigint>, at array<bigint>")
    numbered = scratch(benchmark.select(quoted(item_id).alias("item_id"), quoted(text).alias("text"), F.monotonically_increasing_id().alias("k")))
    return scratch(numbered.mapInArrow(run, T.StructType([T.StructField("item_id", kind), *made])))


def _probes(items: DataFrame, share: float) -> DataFrame:
    """(k, names, h): of each item and reading so many of its rarest windows that the others are fewer than share of all."""
    each = items.select("k", "names", F.size("h").alias("n"), F.explode("h").alias("h")).groupBy("k", "names", "n", "h").agg(F.count("*").alias("times"))
    rare = each.groupBy("h").agg(F.count("*").alias("items"))
    down = Window.partitionBy("k", "names").orderBy(F.col("items").desc(), "h")
    return each.join(rare, "h").withColumn("so_far", F.sum("times").over(down)).where(F.col("so_far") >= F.col("n") * F.lit(share)).select("k", "names", "h")


def _together(texts: list[str]) -> list[tuple[int, int]]:
    """Stretches of texts that are read together: arrays of a good length, one long text alone."""
    out, first, held = [], 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= READ_CHARS or i == len(texts) - 1:
            out.append((first, i + 1))
            first, held = i + 1, 0
    return out


def _reader(sizes: list[int], probe_filter: np.ndarray, filter_: np.ndarray):
    """What may have a partner of each document, reading and size that holds what may be a probe."""

    def run(batches):
        read = Reader()
        for b in batches:
            rows: list = []
            texts = [x or "" for x in b.column(b.num_columns - 1).to_pylist()]
            for lo, hi in _together(texts):
                for names, size, h, at, of, fill in document_windows(read(texts[lo:hi]), sizes):
                    some = passes(h, probe_filter)
                    if not len(some):
                        continue
                    hit = np.zeros(hi - lo, bool)
                    hit[of[some]] = True
                    mine = np.flatnonzero(hit[of])
                    mine = mine[passes(h[mine], filter_)]
                    v = fill(at[mine]).view(np.int64)
                    cut, cut_some = np.searchsorted(of[mine], np.flatnonzero(hit)), np.searchsorted(of[some], np.flatnonzero(hit))
                    parts = (np.split(h[some].view(np.int64), cut_some[1:]), *(np.split(x, cut[1:]) for x in (h[mine].view(np.int64), v, at[mine])))
                    for r, probes, mh, mv, mat in zip(np.flatnonzero(hit) + lo, *parts, strict=True):
                        rows.append((r, names, size, probes, mh, mv.ravel(), mat))
            of = pa.array([x[0] for x in rows], pa.int64())
            kinds = (pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4)
            made = [pa.array([x[i + 1] for x in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(c.take(of) for c in b.columns[:-1]), *made], [*b.schema.names[:-1], "names", "size", "probes", "h", "v", "at"])

    return run


def _checker(share: float, n_keys: int):
    """Rows of pairs: the keys, the size, then h, v and at of the item and of the document."""

    def run(batches):
        arrays = lambda b, r, first, size: (
            np.asarray(b.column(first)[r].values).view(U),
            np.asarray(b.column(first + 1)[r].values).view(U).reshape(-1, size),
            np.asarray(b.column(first + 2)[r].values),
        )
        for b in batches:
            rows, found = [], []
            for r in range(b.num_rows):
                size = b.column(n_keys)[r].as_py()
                got = consistent(arrays(b, r, n_keys + 1, size), arrays(b, r, n_keys + 4, size), share)
                if got:
                    rows.append(r)
                    found.append(got)
            keys = [c.take(pa.array(rows, pa.int64())) for c in b.columns[:n_keys]]
            counts = [pa.array([x[i] for x in found], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*keys, *counts], [*b.schema.names[:n_keys], "n_found", "n_windows", "n_slots", "n_changed"])

    return run


def _leaks(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, size: int, share: float) -> DataFrame:
    """(the columns of docs but its last, the text; item_id, n_found, n_windows, n_slots, n_changed) of each row of docs and item."""
    items = _items(benchmark, item_id, item_text, size)
    keys = docs.columns[:-1]
    kind = items.schema["item_id"].dataType
    result = T.StructType([*docs.schema.fields[:-1], T.StructField("item_id", kind),
        *T.StructType.fromDDL("n_found bigint, n_windows bigint, n_slots bigint, n_changed bigint")])
    about = items.agg(F.collect_set("size"), F.sum(F.size("h"))).first()
    if not about[1]:
        return docs.sparkSession.createDataFrame([], result)
    probes = scratch(_probes(items, share))
    filters = bloom(probes, bits_for(probes.count())), bloom(items.select(F.explode("h").alias("h")), bits_for(about[1]))
    made = T.StructType.fromDDL("names int, size int, probes array<bigint>, h array<bigint>, v array<bigint>, at array<bigint>")
    seen = docs.mapInArrow(_reader(sorted(about[0]), *filters), T.StructType([*docs.schema.fields[:-1], *made]))
    seen = scratch(seen.withColumn("row", F.monotonically_increasing_id()))  # fixed once it is written
    # The hash join of template windows, and the windows of the pairs that it finds.
    hits = met(seen.select("row", F.explode(F.array_distinct("probes")).alias("h")), probes, ["h"], "row")
    pairs = hits.select("row", "k", "names").distinct()
    # Of a document only the windows that the pair's item has: what a pair takes along is bounded by the item's own windows and how often they come again.
    wanted = met(pairs, items.select("k", "names", F.explode(F.array_distinct("h")).alias("h")), ["k", "names"], "row", weight=about[1])
    each = F.expr("inline(transform(sequence(0, size(h) - 1), i -> struct(h[i] AS h, slice(v, i * size + 1, size) AS v, at[i] AS at)))")
    windows = seen.where("size(h) > 0").select("row", each).join(wanted.select("row", "k", "names", "h"), ["row", "h"])
    held = windows.groupBy("row", "k", "names").agg(F.array_sort(F.collect_list(F.struct("at", "h", "v"))).alias("x"))
    held = held.select("row", "k", "names", F.col("x.h").alias("h"), F.flatten("x.v").alias("v"), F.col("x.at").alias("at"))
    both = met(held, items.select("k", "names", F.col("item_id").alias("item"), "size", F.col("h").alias("ih"), F.col("v").alias("iv"), F.col("at").alias("iat")),
        ["k", "names"], "row", weight=about[1])
    sides = both.join(seen.select("row", *keys), "row").select(*keys, "row", "k", F.col("item").alias("item_id"), "names", "size", "ih", "iv", "iat", "h", "v", "at")
    fixed = [*docs.schema.fields[:-1], *T.StructType.fromDDL("row bigint, k bigint").fields, T.StructField("item_id", kind), T.StructField("names", T.IntegerType())]
    checked = sides.mapInArrow(_checker(share, len(fixed)), T.StructType([*fixed, *result.fields[-4:]]))
    return checked.select(*keys, "row", "k", "item_id", "names", *result.names[-4:])


def contaminated(
    df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW,
        share: float = 0.8
) -> DataFrame:
    """One row (id, item_id, n_found, n_windows, n_slots, n_changed) per document and item it leaks; ids keep their types.

    A document leaks an item if at least share of the item's windows of size
    template tokens stand together in it (shifts may differ by a fifth of the
    item) and no value of the item's slots stands for two values there; every such
    stretch of the document is looked at until one is consistent. Four readings
    of capitalised words are tried: as words; as names inside sentences; and as
    names everywhere, with a sentence's first word as a name of its own or as
    part of the run that it begins; the reading with the most windows is told. In the
    last two, windows of nothing but slots don't count. An item of fewer tokens
    than size is one window of all its tokens. A null or empty text, or one
    without tokens, matches nothing on either side; repeated rows give repeated
    rows; empty tables give an empty result; other columns are not looked at.

    Documents are read once, and their windows shuffled only where they may have
    a partner. Hot windows and items are dealt out by rows of documents.
    """
    docs = df.select(quoted(doc_id).alias("id"), F.monotonically_increasing_id().alias("of"), quoted(text).alias("text"))
    found = _leaks(docs, benchmark, item_id, item_text, size, share)
    if "k" not in found.columns:
        return found.drop("of")
    counts = ("n_found", "n_windows", "n_slots", "n_changed")
    best = found.groupBy("of", "k").agg(F.max_by(F.struct("id", "item_id", *counts), F.struct("n_found", -F.col("names"))).alias("x"))
    return best.select("x.*")


def decontaminate(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, share: float = 0.8
) -> DataFrame:
    """df without the rows whose text leaks an item, by the rules of contaminated().

    Equal texts share their verdict, by 128 bits of their content; rows with a
    null text stay, other columns are passed on whatever they hold.
    """
    key = content_key(quoted(text))
    found = _leaks(df.select(key.alias("key"), quoted(text).alias("text")), benchmark, item_id, item_text, size, share)
    gone = scratch(found.select(F.col("key.k1").alias("_cv_1"), F.col("key.k2").alias("_cv_2")).distinct())
    return without_keys(df, key, gone)


def without_keys(df: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """df without the rows whose key is listed in gone(_cv_1, _cv_2); rows stay where they are if the list is short."""
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return df.join(gone, (key["k1"] == F.col("_cv_1")) & (key["k2"] == F.col("_cv_2")), "left_anti")
