"""The stages of the corpus pipeline, each on what its predecessor kept."""

import os

import pytest

import corpus_pipeline
from contentgate.llm import mixing, quality, simhash
from contentgate.llm.common import read, save
from contentgate.session import shared_dir
from tests.llm.helpers import docs, varied, words

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, SF, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = save(stage(spark, docs, SF))
        if name != "best-fit packing":
            assert out.columns == docs.columns
        kept.append((name, docs, out))
        docs = out
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    _, before, good = kept[0]
    # the fold of clean documents is not thinned out
    labels = {r["doc_id"]: r["quality"] for r in read(spark, SF, "labels").collect()}
    lost = set(ids(before)) - set(ids(good))
    assert sum(labels.get(i) == 1 for i in lost) <= 1 and quality.THRESHOLD == 0.3
    found = simhash.near_duplicates(good).collect()
    assert ids(kept[1][2]) == sorted({r["component_id"] for r in found})
    assert ids(kept[2][2]) == ids(kept[1][2])
    copies = {r["doc_id"]: r["_mix_copies"] for r in mixing.mixture(kept[2][2]).collect()}
    assert ids(kept[3][2]) == sorted(i for i, n in copies.items() for _ in range(n))
    assert ids(kept[4][2].filter("piece = 0")) == ids(kept[3][2])
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, kept[4][2].collect()))


def odd_documents(spark):
    rows = varied() + [(k, None) for k in (600, 601)] + [(700, words(40, 9)), (700, words(50, 8)), (None, words(60, 7)), (800, "token = abcdefghijk " + words(80, 6))]
    return docs(spark, rows, [None if k % 3 == 0 else f"s{k % 4}" for k in range(len(rows))])


@pytest.mark.parametrize("empty", ["neither", "documents", "labels", "both"])
def test_odd_rows_through_all_stages(spark, tmp_path, empty):
    """Nulls, repeated ids and rows, long texts, clashing columns and empty tables as one run."""
    sf = str(tmp_path)
    table = odd_documents(spark)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(30)] + [(5, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id bigint, quality int, toxic int")
    table.limit(0 if empty in ("documents", "both") else 10_000).write.parquet(f"{sf}/documents.parquet")
    labels.limit(0 if empty in ("labels", "both") else 10_000).write.parquet(f"{sf}/labels.parquet")
    docs_, sizes = read(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs_ = docs_, save(stage(spark, docs_, sf))
        sizes.append((name, before.count(), docs_.count()))
        if name != "best-fit packing":
            assert docs_.columns == table.columns
    if empty in ("documents", "both"):
        assert all(after == 0 for _, _, after in sizes)
        return
    kept = dict((name, (before, after)) for name, before, after in sizes)
    assert kept["quality classifier"][1] > 0 and (empty != "labels" or kept["quality classifier"][1] == kept["quality classifier"][0])
    assert kept["secret scans"][0] == kept["secret scans"][1] == kept["simhash near-dedup"][1]
    # every row the mix takes is packed whole
    first = sum(r["piece"] == 0 for r in docs_.collect())
    assert first == kept["source mixing"][1]


def test_a_run_leaves_no_table_of_its_stages(spark):
    root = os.path.dirname(shared_dir(spark))
    before = set(os.listdir(root))
    out = corpus_pipeline.run(spark, SF)
    rows = out.count()
    assert rows > 0 and len(set(os.listdir(root)) - before) == 1
