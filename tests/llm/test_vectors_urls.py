"""Operators on embeddings and pages, and the registered queries."""

import hashlib
import math
import os
import random
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import TABLES, rows_of
from contentgate.llm import itq, queries, urls, vafile
from contentgate.llm.common import components

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int, score double, rank int, n_links int, v string, copies int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 0.5, 1, 2, "v", 3) for i, v in rows], VECTORS)


def odd_vectors(d=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = [(k, np.round(centres[k % 12] + 0.02 * (k % 3) * rng.normal(size=d), 3)) for k in range(150)]
    rows += [(200 + k, rows[3][1]) for k in range(40)]
    rows += [(300, None), (301, []), (302, [0.0] * d), (303, [float("nan")] * d), (304, [1.0] * (d - 1) + [None]), (305, [float("inf")] * d),
             (306, rows[5][1][: d - 2]), (307, 2 * rows[7][1]), (None, rows[0][1])]
    return rows


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(itq, "CHUNK", 8)
    rows = odd_vectors()
    got = {r["vec_id"]: tuple(r) for r in itq.near_duplicates(vectors(spark, rows)).collect() if r["vec_id"] is not None}
    d, good = 16, []
    for i, v in rows:
        if v is not None and i is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.zeros(d)
            x[: len(v)] = np.asarray(v, dtype=np.float32)
            good.append((i, x / np.linalg.norm(x)))
    n, parent = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in good:
        for j, b in good:
            if i < j and a @ b >= 0.95:
                n[i] += 1
                n[j] += 1
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    ids = [i for i, _ in rows if i is not None]
    assert len(got) == len(ids)
    assert all(got[i][1] <= n[i] for i in ids)  # nothing is linked that should not be
    assert sum(got[i][1] for i in ids) >= 0.95 * sum(n[i] for i in ids)
    assert sum(got[i][2] == find(i) for i in ids) >= 0.95 * len(ids)
    assert all(got[i][3] == (got[i][2] == i) for i in ids)


@pytest.mark.parametrize("d", [16, 64, 384])
def test_recall_on_vectors_at_known_angles(spark, d):
    """Pairs at cosines 0.95 to 0.99 among unrelated vectors, and chains of them."""
    rng = np.random.default_rng(d)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(rng.normal(size=(1200, d)))
    other = unit(np.cross(base, rng.normal(size=base.shape)) if d == 3 else (w := rng.normal(size=base.shape)) - (w * base).sum(axis=1, keepdims=True) * base)
    c = rng.uniform(0.95, 0.99, size=(1200, 1))
    x = np.concatenate([base, c * base + np.sqrt(1 - c ** 2) * other, rng.normal(size=(1600, d))]).astype(np.float32)
    got = {r["vec_id"]: r for r in itq.near_duplicates(vectors(spark, list(enumerate(x.tolist())))).collect()}
    x = unit(x.astype(float))
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    mine = np.array([got[i]["n_links"] for i in range(len(x))])
    assert want.sum() >= 2200 and (mine <= want).all() and mine.sum() >= 0.9 * want.sum()
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)


def test_wide_vectors_do_not_fill_the_driver(spark):
    """800 vectors of 1,024 numbers: 6.5 MB in double precision, more than 30 MB as Python's lists."""
    wide = spark.range(800).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(1024)), lambda x: (F.xxhash64("id", x) % 1000).cast("float")).alias("embedding"))
    wide = wide.union(wide.filter("vec_id < 5").withColumn("vec_id", F.col("vec_id") + 1000))
    tracemalloc.start()
    got = {r["vec_id"]: r for r in itq.near_duplicates(wide).collect()}
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6e6
    assert len(got) == 805 and all(got[1000 + k]["n_links"] == 1 and got[1000 + k]["component_id"] == k for k in range(5))


@pytest.mark.parametrize("kind", [pa.float32(), pa.float64()])
def test_matrix_of_lists(kind):
    rng = np.random.default_rng(2)
    rows = [rng.normal(size=rng.integers(1, 6)).tolist() for _ in range(2 * itq.ROWS + 7)]
    column = pa.array([[9.0], *rows], pa.list_(kind)).slice(1)
    x = np.zeros((len(rows), 5))
    for i, row in enumerate(column.to_pylist()):
        x[i, :len(row)] = row
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for given in (column, pa.chunked_array([column.slice(0, 100), column.slice(100, 0), column.slice(100)])):
        assert (itq.matrix(given, 5) == x).all()
    assert itq.matrix(column.slice(0, 0), 5).shape == (0, 5)


@pytest.mark.parametrize("block", [16, 4096])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vafile, "BLOCK", block)
    monkeypatch.setattr(vafile, "QUERIES", 3)
    rows = odd_vectors()
    got = sorted(tuple(r) for r in vafile.top_k(vectors(spark, rows), every=10, k=5).collect())
    good = []
    for i, v in rows:
        if v is not None and i is not None and len(v) and all(x is not None and np.isfinite(x) for x in v):
            x = np.zeros(16, dtype=np.int64)
            x[: len(v)] = np.floor(np.asarray(v, dtype=np.float32).astype(float) * 64)
            good.append((i, x))
    want = []
    for q, a in good:
        if q % 10 == 0:
            best = sorted((-int(a @ b), i) for i, b in good if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


@pytest.mark.parametrize("repeats", [1, 2, 21, 500])
def test_top_k_with_an_id_on_many_rows(spark, monkeypatch, repeats):
    """Query 20 is on several rows, equal ones and different ones, and copies of the best vector are a third of all rows."""
    monkeypatch.setattr(vafile, "BLOCK", 64)
    monkeypatch.setattr(vafile, "QUERIES", 2)
    rng = np.random.default_rng(repeats)
    x = rng.normal(size=(300, 8)).round(2)
    rows = [(k, x[k]) for k in range(300) if k != 20] + [(20, x[20])] * repeats + [(20, 3 * x[20])] * (repeats // 2) + [(7, x[20])] * repeats
    rows += [(1001 + 2 * k, x[3]) for k in range(150)] + [(40, x[20])] * (repeats // 20)
    got = [tuple(r) for r in vafile.top_k(vectors(spark, rows), every=20, k=6).collect()]
    exact = [(i, tuple(np.floor(np.asarray(v, dtype=np.float32).astype(float) * 64).astype(np.int64).tolist())) for i, v in rows]
    want = []
    for q, a in {(i, v) for i, v in exact if i % 20 == 0}:
        best = sorted((-int(np.dot(a, b)), i) for i, b in exact if i != q)[:6]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)


def test_few_and_no_vectors(spark):
    assert vafile.top_k(vectors(spark, [])).count() == 0 and itq.near_duplicates(vectors(spark, [])).count() == 0
    assert vafile.top_k(vectors(spark, [(0, [1.0, 2.0])])).count() == 0
    assert [tuple(r) for r in vafile.top_k(vectors(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5])])).collect()] == [(0, 1, 1, 64 * 32 + 128 * 32)]
    assert [tuple(r) for r in itq.near_duplicates(vectors(spark, [(4, None)])).collect()] == [(4, 0, 4, True)]


PAGES = [
    (1, "http://a.net/x"), (2, "HTTP://WWW.Example.NET/en/1?x"), (3, "https://example.com/de/"), (4, "x.org/fr/"), (5, None), (6, ""), (7, "https://b.org/fr/z#top"),
    (8, "https://notexample.net/en/"), (9, "ftp://net"), (10, "https://net/"), (11, "https://é.de/ä?q=1"), (12, "http://?x"), (13, "https://example.com/en/" + "a" * 20_000), (1, "http://a.net/x")]


def test_rules(spark):
    table = spark.createDataFrame([(i, u, "h", "r", "v", 1.0) for i, u in PAGES], "page_id bigint, url string, host string, rule string, verdict string, score double")
    got = {r["page_id"]: r for r in urls.judge(table, queries.RULES).collect()}
    want = {1: ("a.net", "/x", "net/", "block"), 2: ("www.example.net", "/en/1", "example.net/en/", "allow"), 3: ("example.com", "/de/", "example.com/de/", "block"),
            7: ("b.org", "/fr/z", "org/fr/", "allow"), 8: ("notexample.net", "/en/", "net/", "block"), 10: ("net", "/", "net/", "block")}
    for i, row in want.items():
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == row
    for i in (4, 5, 6):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == ("", "", None)
    assert got[9]["rule"] is None and got[12]["host"] == "" and got[11]["host"] == "é.de"
    assert urls.judge(table.limit(0), queries.RULES).count() == 0
    assert {r["verdict"] for r in urls.judge(table.filter("page_id in (4, 5, 6)"), queries.RULES).collect()} == {"allow"}


def test_language_model_tells_rules_apart(spark):
    """URLs that rules judge, judged by the method alone."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = urls.judge(pages, queries.RULES).select("rule", "verdict", "score").toPandas()
    ruled = got[got["rule"].notna()]
    allow = ruled["verdict"] == "allow"
    assert ruled[allow]["score"].median() > ruled[~allow]["score"].median() + 100
    assert got[got["rule"].isna()]["verdict"].nunique() == 2


def test_components_of_paths_and_stars(spark):
    edges = [(i + 1, i) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(SF, table)}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cursor = con.execute(queries.ORACLES[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_query_returns_a_row_for_each_document(spark, name):
    df = queries.QUERIES[name](spark, SF)
    key = "vec_id" if "vec_id" in df.columns else "doc_id"
    table = "embeddings" if key == "vec_id" else "documents"
    assert df.select(key).distinct().count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_native_query_has_no_python(spark, monkeypatch):
    """No table that the query writes, and no plan that reads them, has a Python node; only bounded tables are broadcast by hint."""
    plans, real = [], urls.save

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(urls, "save", seen)
    plans.append(queries.QUERIES["op3_url_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 5
    for plan in plans:
        assert not any(bad in plan for bad in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def plain_scores(rows):
    """Score per row of (url, verdict to learn or None), by counting every context anew."""
    padded = [(urls.PAD * urls.ORDER + (u or ""), v) for u, v in rows]
    symbols = {c for s, _ in padded for c in s[urls.ORDER:]}
    after = {}
    for s, v in padded:
        for i in range(urls.ORDER, len(s)):
            for k in range(urls.ORDER + 1):
                after.setdefault((v, s[i - k:i]), Counter())[s[i]] += 1

    def p(v, context, x):
        below = p(v, context[1:], x) if context else 1 / len(symbols)
        seen = after.get((v, context))
        return (seen[x] + len(seen) * below) / (seen.total() + len(seen)) if seen else below

    def ratio(s, i):
        logs = [math.log(p(v, s[i - urls.ORDER:i], s[i])) for v in ("allow", "block")]
        return math.floor(abs(logs[0] - logs[1]) * urls.UNIT + 0.5) * (1 if logs[0] >= logs[1] else -1)

    return [math.floor(sum(ratio(s, i) for i in range(urls.ORDER, len(s))) / (len(s) - urls.ORDER)) if len(s) > urls.ORDER else 0 for s, _ in padded]


@pytest.mark.parametrize("hot", [3, 1000, 10**9])
def test_scores_equal_brute_force(spark, monkeypatch, hot):
    """A third of the rows are one URL; ids repeat and are null; nothing, few or everything is broadcast."""
    monkeypatch.setattr(urls, "HOT", hot)
    rng = random.Random(5)
    made = [f"http{rng.choice(['', 's'])}://{rng.choice('abc')}.{rng.choice(['net', 'example.net', 'org', 'example.com'])}/{rng.choice(['en', 'fr', 'de'])}/{rng.randrange(300)}" for _ in range(120)]
    table = [(rng.choice([None, 7, k]), u) for k, u in enumerate(made)] + PAGES + [(3, made[0])] * 60 + [(4, "http://漢字😀.org/fr/😀😀"), (5, "http://a.net/\n\x02x")]
    got = [(r["page_id"], r["rule"], r["score"]) for r in urls.judge(spark.createDataFrame(table, "page_id bigint, url string"), queries.RULES).collect()]
    verdicts = {h + p: v for h, p, v in queries.RULES}
    rules = {r["_u"]: r["rule"] for r in urls.judge(spark.createDataFrame([(u, u) for _, u in table], "_u string, url string"), queries.RULES, id_col="_u").collect()}
    learned = [(u, None if hashlib.md5((u or "").encode()).hexdigest()[0] in "012" else verdicts.get(rules[u])) for _, u in table]
    assert sorted(got, key=repr) == sorted(((i, rules[u], s) for (i, u), s in zip(table, plain_scores(learned))), key=repr)


def test_model_tells_digits_and_scripts_apart(spark):
    """URLs that differ in digits, in letters beyond Latin or in longer strings only; more URLs give a larger table."""
    rows = [(k, f"http://{h}{k % 50}.{end}{tail}") for k in range(400) for h, end, tail in (
        ("x", "org/fr/", "1357"), ("x", "net/", "2468"), ("y", "org/fr/", "漢字"), ("y", "net/", "仮名"))]
    asked = [(1000 + k, f"http://z.info/{tail}") for k, tail in enumerate(["1357", "2468", "漢字", "仮名"])]
    got = {r["page_id"]: r["score"] for r in urls.judge(spark.createDataFrame(rows + asked, "page_id bigint, url string"), queries.RULES).collect() if r["page_id"] >= 1000}
    assert got[1000] > got[1001] and got[1002] > got[1003]


def test_entry_registers_the_operators():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
