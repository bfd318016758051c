"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, unit string, vec_id string, rank string, fingerprint string"


def docs(spark, texts, sources=None):
    """Rows (id, text) with columns that operators use as names of their own."""
    rows = [(i, t, "en", None if sources is None else sources[k], len(t or ""), 9.0, "u", "v", "r", "f") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(n, seed=0, kinds=400):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(kinds)}" for _ in range(n))


def varied(seed=1):
    """Texts (id, text) with exact copies, near copies, a null, an empty and a long text, and a repeated row."""
    rng = random.Random(seed)
    base = [words(rng.randrange(1, 300), s) for s in range(30)]
    out = [(k, t) for k, t in enumerate(base)]
    out += [(100 + k, base[k % 3]) for k in range(9)]
    out += [(200 + k, base[5] + f" tail{k}") for k in range(9)]
    out += [(300, None), (301, ""), (302, "   \n\t "), (303, words(20_000, 77)), (304, "é ß 漢字 😀 İstanbul ΑΣ"), (304, "é ß 漢字 😀 İstanbul ΑΣ"), (None, "no id"), (None, None)]
    return out
