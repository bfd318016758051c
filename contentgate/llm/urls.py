"""URL filters: host and path rules, and a character language-model ratio where no rule fits.

Two smoothed variable-order Markov models, of the URLs that rules allow and of those that rules block, are counted over
all such URLs outside the calibration fold, in the URLs' own characters. A character follows a context of up to ORDER
characters. A context's distribution is mixed with that of the next shorter one in proportion to how many different characters
followed it (Witten-Bell), so rare contexts fall back by themselves. The table of counts grows with the data.

Everything is DataFrame operations. Each place of a URL is one row (the URL's number, the ORDER + 1 characters that end there), joined
to the log ratio of these characters. Strings that hold more than a thousandth of all places are fewer than a thousand
and are broadcast; the others are joined by shuffle, where no key can be a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentgate.llm.common import save

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 5  # characters of the longest context
PAD = "\x02"  # stands before a URL's first character
HOT = 1000  # strings with more than this part of all places are broadcast
UNIT = 1000  # log ratios are whole thousandths
WIDEST = 16000

Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def ordered(rules: tuple[Rule, ...]) -> list[Rule]:
    """Longest first."""
    return sorted(rules, key=lambda r: -len(r[0] + r[1]))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The rule that wins, as text, and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in reversed(ordered(rules)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def held_back(url: Column) -> Column:
    """The calibration fold: three sixteenths of the distinct URLs."""
    return F.substring(F.md5(F.coalesce(url, F.lit("")).cast("binary")), 1, 1).isin("0", "1", "2")


def grams(url: Column) -> Column:
    """The ORDER + 1 characters that end at each character of a URL, in one pass over it."""
    return F.regexp_extract_all(F.concat(F.lit(PAD * ORDER), F.coalesce(url, F.lit(""))), F.lit(f"(?s)(?=(.{{{ORDER + 1}}}))."), F.lit(1))


def table(places: DataFrame) -> DataFrame:
    """gram, n, ratio: log of allowed over blocked probability of a string's last character after the others, in thousandths.

    `places`: gram, and verdict where the URL is to be learned from (null elsewhere). Strings that only other URLs have are
    in the table with no counts. A window holds the different characters after one context, never the places themselves.
    """
    counted = save(places.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")))
    shorter = None
    for k in range(ORDER + 1):
        level = counted.groupBy(F.substring("gram", -(k + 1), k + 1).alias("gram")).agg(
            *[F.sum(c).alias(c) for c in ("n", "allow", "block")])
        after = Window.partitionBy(F.substring("gram", 1, k) if k else F.lit(""))
        level = level.select("*", F.count(F.lit(1)).over(after).alias("v"), *[c for s in ("allow", "block") for c in (
            F.sum(s).over(after).cast("double").alias(f"{s}_all"), F.sum((F.col(s) > 0).cast("bigint")).over(after).cast("double").alias(f"{s}_kinds"))])
        if k:
            level = level.withColumn("rest", F.substring("gram", 2, k)).join(shorter, "rest")
        else:
            level = level.withColumns({f"{s}_p": 1 / F.col("v").cast("double") for s in ("allow", "block")})
        mixed = {s: F.when(F.col(f"{s}_all") > 0, (F.col(s) + F.col(f"{s}_kinds") * F.col(f"{s}_p")) / F.greatest(
            F.col(f"{s}_all") + F.col(f"{s}_kinds"), F.lit(1.0))).otherwise(F.col(f"{s}_p")) for s in ("allow", "block")}
        level = level.select("gram", "n", *[p.alias(f"{s}_p") for s, p in mixed.items()])
        shorter = level.select(F.col("gram").alias("rest"), "allow_p", "block_p")
    return save(level.select("gram", "n", F.round((F.log("allow_p") - F.log("block_p")) * UNIT).cast("bigint").alias("ratio")))


def scores(places: DataFrame, model: DataFrame) -> DataFrame:
    """uid, score: the mean log ratio over a URL's places in thousandths, rounded down."""
    total = model.agg(F.sum("n")).first()[0] or 0
    hot = model.filter(F.col("n") * HOT > total).select("gram", "ratio")  # fewer than HOT rows: their n add up to at most total
    often = places.join(F.broadcast(hot), "gram").groupBy("uid").agg(F.sum("ratio").alias("ratio"), F.count(F.lit(1)).alias("n"))
    seldom = places.join(F.broadcast(hot.select("gram")), "gram", "left_anti").join(
        model.filter(F.col("n") * HOT <= total).select("gram", "ratio"), "gram").select("uid", "ratio", F.lit(1).cast("bigint").alias("n"))
    return often.unionByName(seldom).groupBy("uid").agg(F.floor(F.sum("ratio") / F.sum("n")).cast("bigint").alias("score"))


def threshold(scored: DataFrame) -> int:
    """The score from which on to allow: that with the fewest errors, each class weighing the same; 0 without both.

    `scored`: verdict and score of the calibration fold; counted per score, of which there are 2 x WIDEST + 1 at most.
    """
    bins = scored.groupBy(F.greatest(F.least("score", F.lit(WIDEST)), F.lit(-WIDEST)).alias("score")).agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b"))
    below = Window.partitionBy(F.lit(0)).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    wrong = (
        F.coalesce(F.sum("a").over(below), F.lit(0)) * F.sum("b").over(whole)
        + (F.sum("b").over(whole) - F.coalesce(F.sum("b").over(below), F.lit(0))) * F.sum("a").over(whole))
    best = bins.select("score", wrong.alias("wrong"), F.sum("a").over(whole).alias("na"), F.sum("b").over(whole).alias("nb")).filter(
        "na > 0 and nb > 0").orderBy("wrong", "score").limit(1).collect()
    return best[0]["score"] if best else 0


def judge(pages: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict (allow or block), and score, one row per row of `pages`.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins. Elsewhere a URL is allowed
    if its score reaches the threshold. A null URL, or one without ://, has empty host and path; a null or empty one scores 0.
    Without rules' URLs of both verdicts the threshold is 0. Without any, both models are even and all is allowed. Repeated rows count as often as they are there,
    ids may repeat or be null: rows are told apart by a number of their own.
    """
    host, path = host_and_path(F.col("_url"))
    rows = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("_url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    # the numbers hold for good once they are written
    rows = save(rows.withColumns({"rule": rule, "_rule_verdict": verdict, "_held": held_back(F.col("_url")), "uid": F.monotonically_increasing_id()}))
    places = rows.select("uid", F.when(~F.col("_held"), F.col("_rule_verdict")).alias("verdict"), F.explode(grams(F.col("_url"))).alias("gram"))
    found = scores(places.select("uid", "gram"), table(places.select("gram", "verdict")))
    scored = save(rows.join(found, "uid", "left").withColumn("score", F.coalesce("score", F.lit(0).cast("bigint"))).drop("uid", "_url"))
    cut = threshold(scored.filter("_held and _rule_verdict is not null").select(F.col("_rule_verdict").alias("verdict"), "score"))
    return scored.select(
        F.col(id_col), "host", "path", "rule",
        F.coalesce("_rule_verdict", F.when(F.col("score") >= cut, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"), "score")


def sql(pages: str, rules: tuple[Rule, ...]) -> str:
    """The same in SQL, for pages with an id of their own each."""
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in ordered(rules)]
    pick = lambda k: "CASE " + " ".join(f"WHEN {f} THEN '{k(r)}'" for f, r in zip(fits, ordered(rules))) + " END"
    levels = []
    for k in range(ORDER + 1):
        lower = f"JOIN p{k - 1} q ON q.gram = substr(l.gram, 2)" if k else ""
        mixed = ", ".join(
            f"CASE WHEN sum(l.{s}) OVER w > 0 THEN (l.{s} + (count(*) FILTER (l.{s} > 0) OVER w) * {base})::DOUBLE / (sum(l.{s}) OVER w + count(*) FILTER (l.{s} > 0) OVER w)::DOUBLE"
            f" ELSE {base} END AS {s}_p" for s in ("allow", "block") for base in [f"q.{s}_p" if k else "(1 / (count(*) OVER w)::DOUBLE)"])
        levels.append(f"""p{k} AS MATERIALIZED (SELECT l.gram, {mixed} FROM (SELECT right(gram, {k + 1}) AS gram, sum(allow) AS allow, sum(block) AS block FROM c GROUP BY 1) l {lower}
    WINDOW w AS (PARTITION BY left(l.gram, {k})))""")
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {pages}),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r AS (SELECT *, {pick(lambda r: r[0] + r[1])} AS rule, {pick(lambda r: r[2])} AS rv, substr(md5(url), 1, 1) IN ('0', '1', '2') AS held,
    repeat(chr(2), {ORDER}) || url AS s FROM h),
g AS MATERIALIZED (SELECT page_id, CASE WHEN NOT held THEN rv END AS verdict, unnest(list_transform(range(1, length(url) + 1), lambda i: substr(s, i, {ORDER + 1}))) AS gram FROM r),
c AS MATERIALIZED (SELECT gram, count(*) FILTER (verdict = 'allow') AS allow, count(*) FILTER (verdict = 'block') AS block FROM g GROUP BY gram),
{", ".join(levels)},
m AS (SELECT gram, round((ln(allow_p) - ln(block_p)) * {UNIT})::BIGINT AS ratio FROM p{ORDER}),
f AS (SELECT page_id, floor(sum(ratio)::DOUBLE / count(*))::BIGINT AS score FROM g JOIN m USING (gram) GROUP BY page_id),
z AS (SELECT r.*, coalesce(f.score, 0) AS score FROM r LEFT JOIN f USING (page_id)),
b AS (SELECT greatest(least(score, {WIDEST}), -{WIDEST}) AS score, count(*) FILTER (rv = 'allow') AS a, count(*) FILTER (rv = 'block') AS b
    FROM z WHERE held AND rv IS NOT NULL GROUP BY 1),
e AS (SELECT score, coalesce(sum(a) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * sum(b) OVER ()
    + (sum(b) OVER () - coalesce(sum(b) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * sum(a) OVER () AS wrong,
    sum(a) OVER () AS na, sum(b) OVER () AS nb FROM b),
t AS (SELECT coalesce((SELECT score FROM e WHERE na > 0 AND nb > 0 ORDER BY wrong, score LIMIT 1), 0) AS cut)
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN score >= cut THEN 'allow' ELSE 'block' END) AS verdict, score FROM z, t
"""
