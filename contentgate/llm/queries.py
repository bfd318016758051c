"""The registered queries of this folder, and their SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from contentgate.llm import itq, langid, merkle, mixing, packing, quality, secrets, simhash, spelling, suffixes, tokens, urls, vafile
from contentgate.llm.common import read

BYTE_FILE, WORD_FILE, RANKS_FILE = "byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def vocabulary(name: str, path=public_tokenizers.path) -> str:
    """Content of a tokenizer file; read by the driver, so executors need no file."""
    with open(path(name), encoding="utf-8") as file:
        return file.read()


def ranks(name: str = RANKS_FILE, path=public_tokenizers.path) -> bytes:
    with open(path(name), "rb") as file:
        return file.read()


@query("op1_secret_scans")
def op1(spark, sf_dir):
    return secrets.find_secrets(read(spark, sf_dir, "documents"), ranks(), public_tokenizers.PATTERN)


@query("op2_quality_classifier")
def op2(spark, sf_dir):
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query("op3_url_filters", urls.sql("pages", RULES))
def op3(spark, sf_dir):
    return urls.judge(read(spark, sf_dir, "pages"), RULES)


@query("op4_embedding_near_dedup")
def op4(spark, sf_dir):
    return itq.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op5_simhash_near_dedup")
def op5(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op6_exact_top_k", TOP_SQL)
def op6(spark, sf_dir):
    return vafile.top_k(read(spark, sf_dir, "embeddings"))


@query("op7_suffix_array_dedup")
def op7(spark, sf_dir):
    found = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        (F.size("spans") / 2).cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        # the text that remains; a cut may fall inside a character
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
        source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, coalesce(max(CASE WHEN level <= cap / w THEN level END) OVER () * w, cap)) AS target FROM l),
f AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected FROM t),
p AS (SELECT *, floor(expected)::BIGINT AS whole, expected - floor(expected) AS part FROM f),
q AS (SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS remaining,
        CASE WHEN part > 0 THEN u / (1 - u) / (part / (1 - part)) END AS odds
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
r AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id::VARCHAR, size ROWS UNBOUNDED PRECEDING) - size / 2.0 <= remaining
        AND odds IS NOT NULL AS fits FROM q),
c AS (SELECT *, coalesce(odds <= max(CASE WHEN fits THEN odds END) OVER (PARTITION BY source), false) AS drawn FROM r)
SELECT doc_id, size, source_size, target, size * (whole + drawn::BIGINT) AS taken FROM c
"""


@query("op8_source_mixing", MIX_SQL)
def op8(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixture(docs).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"))


@query("op9_token_counts")
def op9(spark, sf_dir):
    return tokens.count_tokens(read(spark, sf_dir, "documents"), vocabulary(BYTE_FILE))


@query("op10_best_fit_packing")
def op10(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary(WORD_FILE))


@query("op11_language_id")
def op11(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents"))


# The table of the CRC-32 by its rule, and a digest of a list of bytes with it.
CRC_TABLE = "SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t"


def crc_sql(list_of_bytes: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {list_of_bytes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


SPELLING_SQL = f"""
WITH RECURSIVE crc AS MATERIALIZED ({CRC_TABLE}),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT low, k, {crc_sql("""flatten(list_transform(string_split(doc_id || ':' || low, ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + (ord(x) >> 6), 128 + (ord(x) & 63)]::BIGINT[] END))""")} AS h FROM runs, crc),
words AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN left(low, (h % length(low))::INT) || substr(low, (h % length(low))::INT + 2) ELSE low END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -n, other := other)) AS b FROM near GROUP BY word),
named AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.m >= 2 * w.n THEN b.other END AS form, CASE WHEN -b.m >= 2 * w.n THEN -b.m END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root, form AS next FROM named
  UNION ALL SELECT walk.word, named.word, named.form FROM walk JOIN named ON named.word = walk.next)
SELECT word, named.form, root, n, n_near, form_n FROM named JOIN (SELECT word, root FROM walk WHERE next IS NULL) USING (word)
"""


@query("op12_spelling_variant_grouping", SPELLING_SQL)
def op12(spark, sf_dir):
    return spelling.variants(read(spark, sf_dir, "documents"))


MERKLE_SQL = f"""
WITH RECURSIVE crc AS MATERIALIZED ({CRC_TABLE}),
told AS (
  SELECT doc_id, lang, n_chars, {crc_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)")} % 7 = 0 AS hit,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents, crc),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
      sha256(head || coalesce(strlen((n_chars + hit::INT)::VARCHAR) || ':' || (n_chars + hit::INT), '-') || tail) AS now FROM told)),
tree AS (
  SELECT g, 0 AS level, idx, leaf AS hash FROM leaves
  UNION ALL SELECT g, level + 1, idx // 2, sha256(string_agg(hash, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS nodes FROM tree) WHERE nodes > 1 GROUP BY g, level, idx // 2),
subroots AS MATERIALIZED (SELECT g, max(level) AS height, arg_max(hash, level) AS subroot FROM tree GROUP BY g),
top AS (
  SELECT 0 AS level, g AS idx, subroot AS hash FROM subroots
  UNION ALL SELECT level + 1, idx // 2, sha256(string_agg(hash, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS nodes FROM top) WHERE nodes > 1 GROUP BY level, idx // 2),
root AS MATERIALIZED (SELECT max(level) AS height, arg_max(hash, level) AS root FROM top),
fold AS (
  SELECT doc_id, g, idx AS at, idx, 0 AS level, now AS node, '' AS proof FROM leaves
  UNION ALL SELECT f.doc_id, f.g, f.at, f.idx // 2, f.level + 1,
    sha256(CASE WHEN f.idx % 2 = 1 THEN s.hash ELSE '' END || node || CASE WHEN f.idx % 2 = 0 THEN coalesce(s.hash, '') ELSE '' END), proof || coalesce(s.hash, '')
  FROM fold f JOIN subroots r ON r.g = f.g LEFT JOIN tree s ON s.g = f.g AND s.level = f.level AND s.idx = xor(f.idx, 1) WHERE f.level < r.height),
rise AS (
  SELECT f.g, f.at, f.g AS idx, 0 AS level, node, proof FROM fold f JOIN subroots r ON r.g = f.g AND f.level = r.height
  UNION ALL SELECT f.g, f.at, f.idx // 2, f.level + 1,
    sha256(CASE WHEN f.idx % 2 = 1 THEN s.hash ELSE '' END || node || CASE WHEN f.idx % 2 = 0 THEN coalesce(s.hash, '') ELSE '' END), proof || coalesce(s.hash, '')
  FROM rise f CROSS JOIN root r LEFT JOIN top s ON s.level = f.level AND s.idx = xor(f.idx, 1) WHERE f.level < r.height)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM leaves l JOIN rise f ON f.g = l.g AND f.at = l.idx CROSS JOIN root r JOIN subroots s ON s.g = l.g WHERE f.level = r.height
"""


@query("op13_merkle_dataset_manifest", MERKLE_SQL)
def op13(spark, sf_dir):
    def tampered(docs):
        hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
        return {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}

    return merkle.manifest(read(spark, sf_dir, "documents"), tampered, proofs=False).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
