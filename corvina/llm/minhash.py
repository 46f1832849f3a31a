"""Near-duplicate documents by SuperMinHash signatures.

An element draws, for level j = 0, 1, ..., a value in [j, j + 1) and the j-th
slot of a random permutation of the slots; a slot keeps its least value. The
ranks of one element are correlated through the permutation, which lowers the
variance of the estimate, and levels stop once no slot can fall further.
Signatures are cut into bands; documents that share a band are compared on
their full shingle sets, and links are grouped by union-find.
"""

from __future__ import annotations

from array import array
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_KEYS, content_key, extra_columns, met, met_where_hot, quoted, scratch
from .components import components
from .hashing import U, mix

#: 32 bands of 5 slots: a pair at 0.8 is missed by all bands in 3 of 1,000,000 cases.
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
#: Two bits of each slot are compared before the texts of a pair of no hub are fetched. At a
#: similarity of 0.8, 32 of 320 bits differ, with a deviation of 6.4: this is 4.5 of them away.
MAX_BITS = 61
CHUNK = 150_000
#: Rows that a task reads of pairs and of tables with texts or shingles, about.
PAIRS, WIDE = 50_000, 5_000
#: The members of a bucket that is dealt out.
HOT = 500

class WordHashes(dict):
    """64-bit hashes of words; forgets them all when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a shorter text is one shingle, one without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII space only
    if not words:
        return np.empty(0, U)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], U)
    w = np.frombuffer(array("Q", map(hashes.__getitem__, words)), U)
    n = len(w) - size + 1
    s = w[:n].copy()
    for i in range(1, size):
        s = mix(s) * U(0x9E3779B97F4A7C15) + w[i : n + i]
    return np.unique(mix(s))


def superminhash(elements: np.ndarray, doc: np.ndarray, n_docs: int, m: int = SLOTS) -> np.ndarray:
    """(n_docs, m) signatures; elements[i] belongs to document doc[i]. Documents without elements stay infinite."""
    sig = np.full(n_docs * m, np.inf)
    x, at = elements, doc * m
    drawn: list[np.ndarray] = []
    rows = order = None
    for j in range(m):
        a = mix(x + U((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        r = (a >> U(11)).astype(np.float64) * 2.0**-53
        k = j + ((mix(a ^ U(0xD6E8FEB86659FD93)) >> U(32)) * U(m - j) >> U(32)).astype(np.int64)
        if order is None and j >= 4:  # what is left is little: hold its permutations as a whole
            order = np.tile(np.arange(m, dtype=np.int16), (len(x), 1))
            rows = np.arange(len(x))
            for i, d in enumerate(drawn):
                order[rows, d], order[:, i] = order[:, i].copy(), order[rows, d].copy()
        if order is None:
            slot = k.copy()
            for i in range(j - 1, -1, -1):  # the place before the earlier swaps
                d = drawn[i]
                slot = np.where(slot == i, d, np.where(slot == d, i, slot))
            drawn.append(k)
        else:
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
            order[:, j] = slot
        np.minimum.at(sig, at + slot, r + j)
        open_ = (sig.reshape(n_docs, m) >= j + 1).any(axis=1)[at // m]
        if not open_.all():
            x, at, drawn = x[open_], at[open_], [d[open_] for d in drawn]
            if order is not None:
                order = order[open_]
                rows = np.arange(len(x))
        if not len(x):
            break
    return sig.reshape(n_docs, m)


def _signer(size: int):
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            texts, sets, first, held = b.column("text"), [], 0, 0
            for i in range(b.num_rows):
                sets.append(shingles(texts[i].as_py(), size, hashes))
                held += len(sets[-1])
                if held >= CHUNK or i == b.num_rows - 1:
                    yield _signed(b.slice(first, len(sets)), sets)
                    first, sets, held = i + 1, [], 0

    return run


def _signed(b: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    sig = superminhash(np.concatenate(sets), np.repeat(np.arange(n), sizes), n)
    slots = mix(sig.view(U) ^ U(0xA0761D6478BD642F)).reshape(n, BANDS, ROWS)
    band = np.tile(np.arange(BANDS, dtype=U), (n, 1))
    for i in range(ROWS):
        band = mix(band * U(0x9E3779B97F4A7C15) + slots[:, :, i])
    two = np.stack([slots.reshape(n, SLOTS) & U(1), slots.reshape(n, SLOTS) >> U(1) & U(1)], 2).astype(np.uint8)
    bits = np.packbits(two.reshape(n, -1), axis=1).view(np.int64)
    full = sizes > 0
    digest = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
    lists = [
        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * x.shape[1])]), pa.int32()), pa.array(x[full].view(np.int64).ravel()))
        for x in (bits, band)
    ]
    keep = [b.column(c) for c in ("id", "k1", "k2")]
    return pa.RecordBatch.from_arrays([*keep, pa.array(sizes), pa.array(digest, pa.binary()), *lists], ["id", "k1", "k2", "n", "digest", "bits", "bands"])


def _comparer(size: int, with_rest: bool):
    """Counts of both full sets and of what they share, and, if asked, what a has and b has not."""

    def run(batches):
        hashes, sets = WordHashes(), {}

        def of(digest, text):
            if digest not in sets:
                if len(sets) > 32:
                    sets.clear()
                sets[digest] = shingles(text, size, hashes)
            return sets[digest]

        for b in batches:
            counts, rests = [], []
            for i in range(b.num_rows):
                x, y = (of(b.column(d)[i].as_py(), b.column(t)[i].as_py()) for d, t in (("a", "ta"), ("b", "tb")))
                both = np.intersect1d(x, y, assume_unique=True)
                counts.append((len(x), len(y), len(both)))
                rests.append(np.setdiff1d(x, both, assume_unique=True).view(np.int64) if with_rest else np.empty(0, np.int64))
            made = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rests])]), pa.int32())
            rest = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*rests, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), *made, rest], ["a", "b", "na", "nb", "both", "rest"])

    return run


def _texts(digests: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(digest, t): a text of each class in digests(digest), fetched once; the others stay where they lie, unless the keys are too many to be sent there."""
    keys = scratch(classes.join(digests, "digest", "left_semi").select("digest", "key.k1", "key.k2"), PAIRS)
    rows = docs.select("k.k1", "k.k2", "text")
    if keys.count() <= BROADCAST_KEYS:
        rows = rows.join(F.broadcast(keys.select("k1").distinct()), "k1", "left_semi")
    return scratch(rows.join(keys, ["k1", "k2"]).groupBy("digest").agg(F.min("text").alias("t")), WIDE)


def _compared(pairs: DataFrame, texts: DataFrame, size: int, with_rest: bool) -> DataFrame:
    """(a, b, na, nb, both, rest) of pairs(a, b) of class digests, from the full sets of their texts."""
    a, b = (texts.select(F.col("digest").alias(x), F.col("t").alias("t" + x)) for x in "ab")
    schema = "a binary, b binary, na bigint, nb bigint, both bigint, rest array<bigint>"
    return pairs.join(a, "a").join(b, "b").select("a", "ta", "b", "tb").mapInArrow(_comparer(size, with_rest), schema)


def _linked(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(digest, root) of the classes that have links, root standing for a component.

    A bucket is never expanded into all of its pairs. Its hub, the member with
    the most bucket mates, is compared with every other member, which gives most
    links; so is then the member nearest to what its mates have in common. Let
    R be the hub's shingles and those that many of its mates share besides, x
    and y two mates in different components still, c(x) the shingles of x in R,
    and t the similarity asked for. x and y are linked only if
    (1 + t) (min(c(x), c(y)) + o) >= t (|x| + |y|), o being the shingles outside
    R that both have. So either they share one of these, or the inequality
    holds with o = 0: equi-joins on the hub and the shingle, and on the hub and
    the sizes that remain, find all of these pairs. What copies have of their own
    they seldom share, so they are few.
    """
    # Hashes of different bands differ, as _signed() says.
    bands = classes.select("digest", F.explode("bands").alias("h"))
    shared = bands.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    members = scratch(bands.join(shared, "h"), PAIRS)
    degree = members.groupBy("digest").agg(F.sum("c").alias("degree"))
    top = members.join(degree, "digest").groupBy("h", "c").agg(F.max(F.struct("degree", "digest")).alias("top"))
    hubs = scratch(top.select("h", F.col("c").alias("n"), F.col("top.digest").alias("b")), PAIRS)
    pairs = met_where_hot(members.select("h", "digest"), hubs, ["h"], "digest", F.col("n") > HOT)
    pairs = scratch(pairs.where("digest <> b").select(F.col("digest").alias("a"), "b").distinct(), PAIRS)
    texts = _texts(members.select("digest").distinct(), classes, docs)
    star = scratch(_compared(pairs, texts, size, True), WIDE)
    enough = f"100 * both >= {percent} * (na + nb - both)"
    links = star.where(enough).select("a", "b")

    def rooted(df: DataFrame, links: DataFrame) -> DataFrame:
        """df with the roots of a and b, for hubs whose mates are in several components."""
        roots = components(links)
        ra, rb = (roots.select(F.col("node").alias(x), F.col("root").alias("r" + x)) for x in "ab")
        both = df.join(ra, "a", "left").join(rb, "b", "left").withColumns({"ra": F.coalesce("ra", "a"), "rb": F.coalesce("rb", "b")})
        return met(both, scratch(both.where("ra <> rb").select("b").distinct()), ["b"], "a")

    open_ = scratch(rooted(star, links), WIDE)
    outside = open_.select("a", "b", F.explode("rest").alias("s"))
    mates = open_.groupBy("b").agg(F.count("*").alias("mates"))
    often = scratch(outside.groupBy("b", "s").agg(F.count("*").alias("n")).where("n >= 3"), PAIRS)
    common = met(often, mates, ["b"], "s").where("n * 4 >= mates").select("b", "s")
    commons = scratch(common.groupBy("b").agg(F.collect_set("s").alias("common")))  # four times a set's size at most
    weight = commons.agg(F.coalesce(F.sum(F.size("common")), F.lit(0))).first()[0]
    inside = met(open_, commons, ["b"], "a", "left", weight).withColumn("own",
        F.when(F.col("common").isNull(), F.col("rest")).otherwise(F.array_except("rest", "common")))
    inside = scratch(inside.select("a", "b", "na", (F.col("na") - F.size("own")).alias("c"), "own", F.col("ra").alias("root")), WIDE)
    # The nearest mate is the second hub.
    nearest = inside.groupBy("b").agg(F.max(F.struct("c", "a", "root")).alias("m")).select("b", F.col("m.a").alias("y"), F.col("m.root").alias("ry"))
    second = met(inside.select("a", "b", "root"), scratch(nearest), ["b"], "a").where("root <> ry").select(F.least("a", "y").alias("a"),
        F.greatest("a", "y").alias("b")).distinct()
    known = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = scratch(second.join(known, ["a", "b"], "left_anti"), PAIRS)
    links = scratch(links.unionByName(_compared(second, texts, size, False).where(enough).select("a", "b")), PAIRS)
    known = known.unionByName(second)
    bits = classes.select(F.col("digest").alias("a"), "bits")
    left = scratch(rooted(inside.drop("root"), links).join(bits, "a").select("a", "b", "na", "c", "own", F.col("ra").alias("root"), "rb", "bits"), WIDE)
    differ = " + ".join(f"bit_count(x.bits[{i}] ^ y.bits[{i}])" for i in range(2 * SLOTS // 64))
    alike = F.expr(f"x.root <> y.root AND 100 * least(x.na, y.na) >= {percent} * greatest(x.na, y.na) AND {differ} <= {MAX_BITS}")
    # Pairs that share a shingle outside R: only shingles that reach over components are looked at.
    # What is shuffled for that are hashes of the hub and the root with the shingle.
    apart = left.select("a", "b", "na", "c", "root", "bits", F.xxhash64("b").alias("hub"), F.explode("own").alias("s"))
    told = left.select(F.xxhash64("b").alias("hub"), F.xxhash64("root").alias("r"), F.explode("own").alias("s"))
    across = told.groupBy("hub", "s").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).where("lo <> hi").select("hub", "s")
    apart = apart.join(across, ["hub", "s"], "left_semi").drop("hub")
    touch = apart.alias("x").join(apart.alias("y"), ["b", "s"]).where("x.a < y.a").where(alike)
    touch = touch.groupBy("b", "x.a", F.col("y.a").alias("z")).agg(F.count("*").alias("o"), F.min(F.least("x.c", "y.c")).alias("c"),
        F.min(F.col("x.na") + F.col("y.na")).alias("n"))
    one = touch.where(f"(c + o) * {100 + percent} >= {percent} * n").select("a", F.col("z").alias("b"))
    # Pairs within R, by the sizes that remain for a mate outside the hub's component.
    most = F.least(F.floor(F.col("c") * (100 + percent) / percent - F.col("na")), F.floor(F.col("na") * 100 / percent)).cast("long")
    least = F.ceil(F.col("na") * percent / 100).cast("long")
    sized = left.where("root <> rb").where(most >= least).select("a", "b", "na", "root", "bits", F.explode(F.sequence(least, most)).alias("s"))
    within = left.select("a", "b", "na", "c", "root", "bits", F.col("na").alias("s"))
    fits = F.expr(f"y.c * {100 + percent} >= {percent} * (x.na + y.na)")
    touch = sized.alias("x").join(within.alias("y"), ["b", "s"]).where(alike & fits)
    two = touch.select(F.least("x.a", "y.a").alias("a"), F.greatest("x.a", "y.a").alias("b"))
    rest = scratch(one.unionByName(two).distinct().join(known, ["a", "b"], "left_anti"), PAIRS)
    more = _compared(rest, texts, size, False).where(enough).select("a", "b")
    return components(scratch(links.unionByName(more), PAIRS)).select(F.col("node").alias("digest"), "root")


def _classes(docs: DataFrame, size: int) -> DataFrame:
    """(k1, k2, id, n, digest, ...) of every row, written once."""
    made = T.StructType.fromDDL("k1 bigint, k2 bigint, n bigint, digest binary, bits array<bigint>, bands array<bigint>")
    return scratch(docs.select("id", "k.k1", "k.k2", "text").mapInArrow(_signer(size), T.StructType([docs.schema["id"], *made])))


def near_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """df with n_shingles, component_id and kept.

    Two documents are linked if their sets of distinct shingles of size words
    have a Jaccard similarity of percent / 100 or more; component_id is the
    smallest id reachable over links, and the row with that id is kept. Texts
    with the same set form a class and are compared once. A text of fewer words
    is one shingle; a null or empty text, or one without words, has none, is
    linked with nothing and is kept. Rows that repeat an id are both kept if it
    is the smallest; in a component without any id the component_id is null and
    all are kept. Columns n_shingles, component_id and kept of df are replaced.
    An empty table gives an empty result; ids keep their type. Shingles are compared by 64-bit
    hashes; a pair of classes is decided if one of 32 bands agrees.
    """
    made = ("n_shingles", "component_id", "kept")
    docs = df.select(quoted(doc_id).alias("id"), quoted(text).alias("text"), content_key(quoted(text)).alias("k"))
    signed = _classes(docs, size)
    full = signed.where("digest IS NOT NULL")
    classes = scratch(
        full.groupBy("digest").agg(
            F.min("id").alias("least"), F.min(F.struct("k1", "k2")).alias("key"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("bands").alias("bands")
        )
    )
    links = _linked(classes, docs, size, percent)
    rooted = classes.select("digest", "least").join(links, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    # One row for each text: rows with the same content share their set.
    by_class = rooted.join(smallest, "root").select("digest", "component")
    by_text = full.select("k1", "k2", "n", "digest").distinct().join(by_class, "digest").select(F.col("k1").alias("_cv_1"), F.col("k2").alias("_cv_2"),
        F.col("n").alias("_cv_n"), F.col("component").alias("_cv_c"))
    rest = [quoted(c) for c in extra_columns(df, *made)]
    keyed = df.select(*rest, content_key(quoted(text)).alias("_cv_k"))
    joined = keyed.join(by_text, (F.col("_cv_k.k1") == F.col("_cv_1")) & (F.col("_cv_k.k2") == F.col("_cv_2")), "left")
    own = quoted(doc_id)
    component = F.when(F.col("_cv_n").isNull(), own).otherwise(F.col("_cv_c"))
    return joined.select(
        *rest, F.coalesce("_cv_n", F.lit(0)).cast("long").alias("n_shingles"), component.alias("component_id"),
            F.coalesce(own.eqNullSafe(component), F.lit(True)).alias("kept")
    )
