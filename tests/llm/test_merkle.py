"""The Merkle manifest against a slow version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from contentgate.llm import merkle
from tests.llm.helpers import docs, varied


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    chars = None if row["n_chars"] is None else row["n_chars"] + more
    values = [row["doc_id"], row["source"], row["lang"], chars, row["text"]]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, at):
    out = []
    for row in levels[:-1]:
        first = at // 2 * 2
        out.append((row[first:at], row[at + 1:first + 2]))
        at //= 2
    return out


def slow(rows):
    """(doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    runs = {}
    for r in rows:
        runs.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    order = sorted(runs, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = [levels_of([x[2] for x in sorted(runs[lang], key=lambda x: x[:3])]) for lang in order]
    top, out = levels_of([t[-1][0] for t in trees]), []
    for g, lang in enumerate(order):
        for k, (_, _, _, r) in enumerate(sorted(runs[lang], key=lambda x: x[:3])):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node, way = leaf(r, int(hit)), siblings(trees[g], k) + siblings(top, g)
            for left, right in way:
                node = sha(*left, node, *right)
            proof = sha(*("".join(left + right) for left, right in way))
            out.append((r["doc_id"], lang, leaf(r), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def tampered(table):
    return {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def many(n_langs):
    def make(spark):
        rows = [(k, f"text {k}") for k in range(150)]
        return docs(spark, rows).withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % n_langs).cast("string")))
    return make


TABLES = {
    "odd rows": lambda spark: docs(spark, varied()).withColumn("lang", F.expr("CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'é' ELSE '' END"))
    .withColumn("n_chars", F.expr("CASE WHEN doc_id % 4 = 0 THEN NULL ELSE n_chars END")),
    "one hot language": lambda spark: docs(spark, [(k, f"t{k}") for k in range(130)]).withColumn("lang", F.expr("CASE WHEN doc_id < 120 THEN 'en' ELSE CAST(doc_id AS STRING) END")),
    "a language a row": many(1000),
    "one language": many(1),
    "repeated rows": lambda spark: docs(spark, [(7, "same")] * 60 + [(8, "x"), (None, None), (None, None)]),
    "one row": lambda spark: docs(spark, [(3, "only")]),
    "empty": lambda spark: docs(spark, []),
}


@pytest.mark.parametrize("size", [4, 4096])
@pytest.mark.parametrize("name", list(TABLES))
def test_manifest_equals_a_slow_version(spark, name, size):
    table = TABLES[name](spark).selectExpr("*", "1 AS g", "2 AS idx", "'h' AS hash", "'l' AS leaf", "'p' AS path", "0 AS n", "0 AS run")
    found = merkle.manifest(table, tampered, size=size)
    got = sorted((tuple(r) for r in found.select("doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)
    assert got == slow(table.collect())


def test_recorded_proofs_lead_to_the_root(spark):
    table = TABLES["odd rows"](spark)
    for r in merkle.manifest(table, size=8).collect():
        node = r["leaf"]
        for left, right in merkle.parsed(r["proof"]):
            node = sha(left, node, right)
        assert node == r["root"] and r["verified"] and r["now_leaf"] == r["leaf"]


def test_states_resume_at_every_slot():
    nodes = [sha(str(k)) for k in range(11)]
    tree = merkle.Subtree(nodes, merkle.height(11))
    assert tree.levels == levels_of(nodes)
    for k in range(11):
        changed = [*nodes[:k], "x", *nodes[k + 1:]]
        assert tree.fold(k, "x") == levels_of(changed)[-1][0]
        assert tree.fold(k, nodes[k]) == levels_of(nodes)[-1][0]


def test_any_changed_field_is_found(spark):
    table = docs(spark, [(k, f"text {k}") for k in range(30)])
    for name, value in (("text", F.concat("text", F.lit(" "))), ("source", F.lit("")), ("lang", F.lit(None).cast("string"))):
        found = merkle.manifest(table, lambda t, name=name, value=value: {name: F.when(F.col("doc_id") == 11, value).otherwise(F.col(name))}).collect()
        assert [r["doc_id"] for r in found if not r["verified"]] == [11]
