"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from contentgate.llm import spelling
from tests.llm.helpers import docs, varied


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced character."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def slow(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = None if doc is None else zlib.crc32(f"{doc}:{low}".encode())
            if h is not None and h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1:]
            n[low] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n) if n else []


def texts(seed, kinds=250):
    """Texts of words at small distances of each other, with the classes' odd characters and upper case among them."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé÷Þz") for _ in range(rng.randrange(4, 9))) for _ in range(kinds)]
    words = []
    for w in base:
        words += [w] * rng.choice((1, 3, 7, 20))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            v = rng.choice((w[:at] + rng.choice("abç") + w[at:], w[:at] + w[at + 1:], w[:at] + "q" + w[at + 1:]))
            words += [v] * rng.choice((2, 3, 4, 9))
    words += [w.upper() if w.isascii() else w for w in words[::7]]
    rng.shuffle(words)
    step = 40
    return [(k, rng.choice((" ", "-", "1", "\n", "Ā")).join(words[k * step:(k + 1) * step])) for k in range(len(words) // step + 1)]


CASES = {
    "mixed": lambda: texts(1) + [(500 + i, t) for i, t in texts(2, 60)],
    "odd rows": lambda: varied() + [(700, "abcde " * 9), (700, "abcde " * 9), (None, "abcdf " * 4 + "x" * 30_000 + " " + "x" * 30_000 + " " + "x" * 30_001),
                                    (701, ("x" * 30_001 + " ") * 3), (702, "abcdeabcde " * 5 + "abcdeabcd " * 3 + "ßßßßßß ßßßßß " * 4)],
    "empty": lambda: [],
    "no words": lambda: [(1, None), (2, ""), (3, "a bc 123")],
    "chain": lambda: [(1, " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["abbbb"] * 48 + ["bbbbb"] * 96))],
    "tie": lambda: [(1, " ".join(["mmmmm"] * 3 + ["mmmmz"] * 6 + ["mmmma"] * 6 + ["émmmm"] * 6))],
}


@pytest.mark.parametrize("chunk, queries", [(6, 5), (20_000, 8192)])
@pytest.mark.parametrize("case", list(CASES))
def test_variants_equal_brute_force(spark, monkeypatch, case, chunk, queries):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    monkeypatch.setattr(spelling, "QUERIES", queries)
    rows = CASES[case]()
    table = docs(spark, rows).selectExpr("*", "'w' AS word", "1 AS n", "'f' AS form", "'k' AS _key", "true AS shorter")
    got = spelling.variants(table).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(slow(rows), key=repr)


def test_blocks_hold_every_near_pair():
    rng = random.Random(5)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(5, 10)))
        at = rng.randrange(len(a) + 1)
        b = rng.choice((a[:at] + "c" + a[at:], a[:at] + "c" + a[at + 1:]))
        if not one_edit(a, b):
            continue
        half = min(len(a), len(b)) // 2
        rest = min(len(a), len(b)) - half
        assert a[:half] == b[:half] or a[-rest:] == b[-rest:]
