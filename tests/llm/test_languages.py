"""Language ID against a slow version and on held-out documents."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from contentgate.llm import langid
from contentgate.llm.common import read
from tests.llm.helpers import docs, varied, words

SF = "/root/testdata/sf0.01"


def slow_grams(text, bits):
    """Bucket counts of one text, character by character."""
    chars, out = [" "], Counter()
    for c in text.lower():
        chars.append(c if c.isalpha() else " ")
    chars.append(" ")
    flat = [c for k, c in enumerate(chars) if not (c == " " and k and chars[k - 1] == " ")]
    for n in range(1, 5):
        for k in range(len(flat) - n + 1):
            gram = flat[k:k + n]
            if gram == [" "]:
                continue
            value = 0
            for c in gram:
                value = (value * 0x01000193 + ord(c)) & 0xFFFFFFFF
            out[((value + n) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - bits)] += 1
    return out


ODD = ["", "a", "  ", "Été 12 --- été", "ΑΣ Σ İ é ﬁ Ⅷ²", "漢字 😀 𞤀x", "a\0b", "one, two\n\nthree" * 40, "1234 ... 99"]


def test_counts_and_sums_equal_a_slow_version(monkeypatch):
    texts = [*ODD, *(words(50, s) for s in range(20))]
    for bits in (8, 15):
        got = langid.counts(texts, np.arange(len(texts)), len(texts), bits)
        want = [slow_grams(t, bits) for t in texts]
        assert all({int(b): int(g[b]) for b in np.flatnonzero(g)} == w for g, w in zip(got, want))
        weights = np.vstack([np.random.default_rng(1).normal(size=(1 << bits, 3)), np.zeros((1, 3))])
        for tile in (7, 1 << 20):
            monkeypatch.setattr(langid, "TILE", tile)
            found = langid.sums(texts, weights)
            slow = [[sum(n * weights[b, k] for b, n in w.items()) for k in range(3)] for w in want]
            assert np.allclose(found, slow)


def test_predictions_equal_a_slow_classifier(spark):
    table = docs(spark, varied()).withColumn("lang", F.when(F.col("doc_id") % 5 == 0, None).when(F.length("text") % 2 == 0, "").otherwise("b")).withColumn("lang_pred", F.lit("x"))
    rows = table.collect()
    train = [r for r in rows if r["lang"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    langs = sorted({r["lang"] for r in train})
    total = {lang: Counter() for lang in langs}
    for r in train:
        total[r["lang"]].update(slow_grams(r["text"] or "", 15))
    size = {lang: sum(total[lang].values()) + 0.1 * (1 << 15) for lang in langs}
    got = {}
    for r in langid.identify(table).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for r in rows:
        found = [g for g in got[r["doc_id"]]]
        grams = slow_grams(r["text"] or "", 15)
        joint = [math.log(sum(t["lang"] == lang for t in train) / len(train)) + sum(n * math.log((total[lang][b] + 0.1) / size[lang]) for b, n in grams.items()) for lang in langs]
        best = int(np.argmax(joint))
        lettered = any(c.isalpha() for c in r["text"] or "")
        want = (langs[best], 1 / sum(math.exp(j - joint[best]) for j in joint)) if lettered else ("und", 0.0)
        assert any(g["lang_pred"] == want[0] and math.isclose(g["score"], want[1], abs_tol=1e-6) for g in found), r["doc_id"]
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert all(g["held_out"] == held for g in found)


def test_held_out_accuracy(spark):
    table = read(spark, SF, "documents")
    both = langid.identify(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(both) > 200 and (both["lang_pred"] == both["lang"]).mean() > 0.98


def test_nothing_to_learn_from(spark):
    assert langid.identify(docs(spark, [])).count() == 0
    table = docs(spark, [(1, "some words"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert sorted(tuple(r) for r in langid.identify(table).select("lang_pred", "score").collect()) == [("und", 0.0)] * 2


def test_predictions_use_texts_alone(spark):
    table = docs(spark, [(k, words(20, k % 3)) for k in range(60)], [f"s{k % 2}" for k in range(60)]).withColumn(
        "lang", F.concat(F.lit("l"), (F.col("doc_id") % 3).cast("string")))
    model = langid.fit(table, "text", "lang")
    same = {t: langid.predict([t], model.langs, model.prior, model.weights)[0][0] for t in {r["text"] for r in table.collect()}}
    got = langid.identify(table.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "wrong").otherwise(F.col("lang"))))
    assert all(r["lang_pred"] == same[words(20, r["doc_id"] % 3)] for r in got.collect())


def test_buckets_shrink_with_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "CELLS", 1 << 14)
    table = docs(spark, [(k, words(5, k)) for k in range(12)]).withColumn("lang", F.col("doc_id").cast("string"))
    assert langid.fit(table, "text", "lang").weights.shape == ((1 << 10) + 1, 12)
    table = docs(spark, [(k, "a") for k in range(40)]).withColumn("lang", F.col("doc_id").cast("string"))
    try:
        langid.fit(table, "text", "lang")
    except ValueError:
        return
    raise AssertionError("too many languages must raise")
