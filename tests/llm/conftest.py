import random

import pytest


@pytest.fixture(scope="session")
def corpus():
    """Small documents: exact and near copies, hot sources, odd texts; (doc_id, text, source)."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for i in range(60):
        rows.append((i, text(rng.randint(3, 120)) + ".", f"s{i % 3 and 0}"))
    base = text(100)
    for i in range(60, 90):
        ws = base.split()
        for _ in range(rng.randint(0, 4)):
            ws[rng.randrange(len(ws))] = rng.choice(words)
        rows.append((i, " ".join(ws), "s0"))
    rows += [(i, "Same text for all of these\nand one more line.", "s1") for i in range(90, 100)]
    rows += [(100, None, "s0"), (101, "", None), (102, "   \n\t ", "s2"), (103, "one", "s2"), (104, "ONE", "s2"), (None, "null id text here", "s2")]
    rows += [(105, "x" * 70_000, "s2"), (106, "a b " * 6000, "s2"), (1, rows[1][1], "s0")]
    return rows
