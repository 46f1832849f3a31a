"""Conversation repair against exhaustive search and against plain Python over damaged conversations."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from corvina.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")


def exhaustive(signature):
    """All ways to edit a signature, with up to two rows inserted anywhere; the first of the cheapest."""
    best = None
    options = []
    for c in signature:
        extra = 1 if c.isupper() else 0
        ways = [("D", 3, "")]
        if c != "x":
            ways += [("K", extra, c.lower())] + [("R", 2 + extra, r) for r in "ua"]
        options.append(ways)
    inserts = [("", 0, "")] + [("I" * n, 2 * n, "".join(r)) for n in (1, 2) for r in itertools.product("ua", repeat=n)]
    slots = [inserts]
    for ways in options:
        slots += [ways, inserts]
    for chosen in itertools.product(*slots):
        if LEGAL.fullmatch("".join(c[2] for c in chosen)):
            told = (sum(c[1] for c in chosen), "".join(c[0] for c in chosen))
            best = told if best is None or told < best else best
    return best


def backwards(signature):
    """The same from the end: for each place and state the least cost and first edits of what is still to come."""

    @cache
    def rest(i, state, inserts):
        ways = []
        if i == len(signature) and state in "ba":
            ways.append((0, ""))
        if inserts < 3:
            to = "a" if state == "u" else "u"
            cost, edits = rest(i, to, inserts + 1)
            ways.append((2 + cost, "I" + edits))
        if i < len(signature):
            c = signature[i]
            extra = 1 if c.isupper() else 0
            steps = [("D", 3, state)]
            if c != "x":
                steps.append(("R", 2 + extra, "a" if state == "u" else "u"))
                if c.lower() == "s" and state == "b":
                    steps.append(("K", extra, "s"))
                if c.lower() == "u" and state != "u" or c.lower() == "a" and state == "u":
                    steps.append(("K", extra, c.lower()))
            for edit, price, to in steps:
                cost, edits = rest(i + 1, to, 0)
                ways.append((price + cost, edit + edits))
        return min(ways) if ways else (10**9, "")

    for i in range(len(signature), 0, -50):  # so that no call goes deep
        for state in "bsua":
            rest(i, state, 0)
    return rest(0, "b", 0)


def test_trie_against_exhaustive_search():
    every = sorted("".join(x) for n in range(3) for x in itertools.product("suaoSUAOx", repeat=n))
    trie = repair.Trie()
    assert all(trie.answer(s) == exhaustive(s) == backwards(s) for s in every)


def test_trie_against_a_programme_from_the_end():
    rng = random.Random(3)
    some = {"".join(rng.choice("suaouauaSUAOxx") for _ in range(rng.randint(0, 14))) for _ in range(1500)}
    some |= {"ua" * 40, "ua" * 40 + "x", "u" * 60, "a" * 60, "s" * 60, "x" * 60, "ua" * 40 + "sa"}
    trie = repair.Trie()
    told = {s: trie.answer(s) for s in sorted(some)}
    assert told == {s: backwards(s) for s in some}
    assert len(repair.Layer.known) < 500


def test_a_shared_prefix_is_told_once():
    trie = repair.Trie()
    trie.answer("ua" * 5000)
    before = list(trie.path)
    trie.answer("ua" * 5000 + "u")
    assert all(a is b for a, b in zip(before, trie.path, strict=False)) and len(trie.path) == 10_001
    assert repair._common("abcd", "abxd") == 2 and repair._common("", "a") == 0 and repair._common("ab", "ab") == 2


SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """The whole query in plain Python; rows(conv_id, turn, role, text)."""
    by = {}
    for conv, turn, role, text in rows:
        mine = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        mine += [(turn, role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    out = {}
    for conv, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).digest()))
        seen, signature, n = set(), "", {"b": 0, "d": 0, "t": 0}
        for turn, role, text in mine:
            kept = text.strip(SPACES)
            fault = "b" if not kept else "d" if (role, text) in seen else "t" if kept[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            signature += "x" if fault in ("b", "d") and fault else letter.upper() if fault else letter
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit = backwards(signature)
        told, left, state = [], list(mine), ""
        for edit in audit:
            turn, role, text = left.pop(0) if edit != "I" else (None, "", "")
            if edit != "D":
                role = role if edit == "K" else "assistant" if state == "u" else "user"
                state = role[0]
                told.append(f"{role}:{text}")
        assert not left and LEGAL.fullmatch("".join(t[0] for t in told))
        out[conv] = (gaps, n["b"], n["d"], n["t"], illegal, cost, audit, hashlib.sha256("\n".join(told).encode()).hexdigest(), told)
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(9)
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            role = rng.choice(["system", "tool", None, ""]) if rng.random() < 0.1 else role
            text = rng.choice(["Fine.", "No end", "Why? ", " \n", None, "", "Same words.", "Ends\x0b!\t", f"Number {rng.random()}.", "über 𝔘!"])
            rows.append((conv, None if rng.random() < 0.05 else turn + (turn > 4) * rng.randint(0, 3), role, text))
    rows += [r for r in rows[:40]]
    rows += [(1000, t, ("user", "assistant")[t % 2], f"Turn {t}." if t % 7 else "same") for t in range(700)]
    rows += [(2000 + i, t, r, x) for i in range(1200) for t, (r, x) in enumerate([("user", "Hello."), ("assistant", "Yes.")])]
    return rows


@pytest.mark.parametrize("rows", ["7", "10000"])
def test_query_against_plain_python(spark, talks, rows):
    """Conversations go on from one batch of rows to the next."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    df = spark.createDataFrame(talks, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    told = repair.repair(repair.damaged(df)).persist()
    want = brute(talks)
    got = {r.conv_id: tuple(r)[1:] for r in repair.digests(told).collect()}
    assert got == {k: v[:-1] for k, v in want.items()}
    turns = {}
    for r in sorted((r for r in told.collect() if r["at"] >= 0), key=lambda r: r["at"]):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert turns == {k: v[-1] for k, v in want.items() if v[-1]}
    told.unpersist()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_tables(spark):
    schema = "conv_id string, turn int, role string, text string, signature string, audit int"
    assert repair.digests(repair.repair(repair.damaged(spark.createDataFrame([], schema)))).count() == 0
    lost = next(f"c{i}" for i in range(1000) if zlib.crc32(f"c{i}:0".encode()) % 20 == 0)
    kept = next(f"c{i}" for i in range(1000) if zlib.crc32(f"c{i}:0".encode()) % 20 > 4)
    df = spark.createDataFrame([(lost, 0, "user", "A.", "x", 1), (kept, 0, "user", "A.", "x", 1)], schema)
    got = {r.conv_id: tuple(r)[1:] for r in repair.digests(repair.repair(repair.damaged(df))).collect()}
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[kept] == (0, 0, 0, 0, 0, 2, "KI", hashlib.sha256(b"user:A.\nassistant:").hexdigest())
