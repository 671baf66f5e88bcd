"""URL filter by a ratio of two character language models, with DataFrame functions only.

Rules decide the URLs that they fit; the longest fitting rule wins. The URLs that rules allow or block
train two character models, whose difference decides the rest. A model is a variable-order Markov
model: the chance of a character mixes, from no context up to ``ORDER`` characters, the counts of
every context seen with the chance under the shorter one, weighted by how many different characters
followed the context (Witten-Bell). A URL's score is the difference of both log-likelihoods over its
length. A quarter of the ruled URLs, chosen by a hash, is held out of the models; the threshold is
the score that tells their two verdicts apart best (balanced accuracy; the smallest of equals).

Counts cover all URLs, each distinct URL once, and models grow with the contexts seen. Characters'
log ratios are found once per distinct window of ``ORDER`` + 1 characters, rounded to millionths of
a nat and summed as integers, so that results depend on no order of sums. URLs that repeat are
judged once and joined back; where one URL owns a third of the rows, the adaptive skew join splits them.
Staged tables that grow with the URLs meet in merge joins: their files are compressed more than ten times,
so by the size of the files Spark would send tables of 150 MB and more through the driver.

Defined results: a null or empty URL has empty host and path, no rule and score 0; without held-out URLs
of both verdicts the threshold is 0, and without any ruled URL of a verdict its model is uniform;
repeated rows are judged each; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import pick, stage, table

#: Longest context in characters.
ORDER = 5
#: Chance of a character under no counts at all, and log ratios per nat.
UNIFORM = 1.0 / 256
SCALE = 1_000_000
#: Scores are compared in hundredths of a nat per character, at most so many either way.
STEP = 10_000
BOUND = 2_000
#: First digits of the MD5 of a URL that is held out for the threshold.
HELD_OUT = "0123"
#: Stands before the first character of a URL.
PAD = "\u0001"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def ruled(host: Column, path: Column, rules: list[Rule] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def windows(url: Column) -> Column:
    """Of each character, itself behind the ``ORDER`` characters before it."""
    padded = F.concat(F.lit(PAD * ORDER), url)
    return F.transform(F.sequence(F.lit(1), F.length(url)), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))


def character_counts(urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(context, follower, counts) and (context, counts, numbers of followers) under both verdicts.

    ``urls`` has (url, verdict). Windows are counted first; the shorter contexts come from the distinct windows.
    """
    whole = urls.where(F.length("url") > 0).select("verdict", F.explode(windows(F.col("url"))).alias("w")).groupBy("w").agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b"))
    cut = whole.select(F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(ORDER)), lambda k: F.substring(F.col("w"), F.lit(ORDER + 1) - k, k + 1))).alias("g"), "a", "b")
    grams = cut.groupBy("g").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn(
        "c", F.expr("substring(g, 1, length(g) - 1)"))
    contexts = grams.groupBy("c").agg(
        F.sum("a").alias("n_a"), F.sum("b").alias("n_b"),
        F.count_if(F.col("a") > 0).alias("t_a"), F.count_if(F.col("b") > 0).alias("t_b"))
    return grams.select("g", "c", "a", "b"), contexts


def mixed(seen: Column, total: Column, kinds: Column, shorter: Column) -> Column:
    """Chance of a character behind a context, from its counts and its chance under the shorter context."""
    return F.when(total > 0, (seen + kinds * shorter) / (total + kinds)).otherwise(shorter)


def log_ratios(wanted: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(w, ratio) of each distinct window of ``wanted``: log of the allowed over the blocked chance, in millionths.

    Contexts are looked up from none to the longest; one that both models lack adds nothing.
    """
    cut = wanted.select("w", F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("k")).select(
        "w", "k", F.expr(f"substring(w, {ORDER + 1} - k, k)").alias("c"), F.expr(f"substring(w, {ORDER + 1} - k, k + 1)").alias("g"))
    known = cut.join(contexts.hint("merge"), "c").join(grams.drop("c").hint("merge"), "g", "left").groupBy("w").agg(F.sort_array(F.collect_list(F.struct(
        "k", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"), "n_a", "n_b", "t_a", "t_b"))).alias("x"))
    chance = F.aggregate(
        "x", F.struct(F.lit(UNIFORM).alias("a"), F.lit(UNIFORM).alias("b")),
        lambda p, x: F.struct(mixed(x["a"], x["n_a"], x["t_a"], p["a"]).alias("a"),
                              mixed(x["b"], x["n_b"], x["t_b"], p["b"]).alias("b")))
    return known.select("w", chance.alias("p")).select(
        "w", F.round((F.log(F.col("p.a")) - F.log(F.col("p.b"))) * SCALE).cast("long").alias("ratio"))


def scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(id, score): hundredths of a nat per character; ``urls`` has (id, url), ``ratios`` (w, ratio)."""
    cut = urls.where(F.length("url") > 0).select("id", F.explode(windows(F.col("url"))).alias("w"))
    total = cut.join(ratios.hint("merge"), "w").groupBy("id").agg(F.sum("ratio").alias("s"))
    found = urls.join(total, "id", "left")
    score = F.floor(F.coalesce("s", F.lit(0)) / F.greatest(F.length("url"), F.lit(1)) / STEP)
    return found.select("id", F.greatest(F.least(score, F.lit(BOUND)), F.lit(-BOUND)).cast("int").alias("score"))


def threshold(held_out: DataFrame) -> DataFrame:
    """One row (t): the score that parts held-out (score, verdict) rows best; at most 2 * ``BOUND`` + 1 scores meet."""
    by_score = held_out.groupBy("score").agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b"))
    # Scores and their counts as one array; a cut at a score allows it and all above.
    at = by_score.agg(F.sort_array(F.collect_list(F.struct("score", "a", "b"))).alias("x"))
    big = "decimal(38,0)"
    zero = F.lit(0).cast("long")
    sums = at.select("x", F.aggregate("x", zero, lambda s, r: s + r["a"]).alias("a"),
                     F.aggregate("x", zero, lambda s, r: s + r["b"]).alias("b"))
    state = F.struct(zero.alias("a"), zero.alias("b"),
                     F.lit(-1).cast(big).alias("best"), F.lit(0).alias("t"))

    def step(s, r):
        gain = ((F.col("a") - s["a"]).cast(big) * F.col("b") + s["b"].cast(big) * F.col("a")).cast(big)
        better = gain > s["best"]
        return F.struct((s["a"] + r["a"]).alias("a"), (s["b"] + r["b"]).alias("b"),
                        F.when(better, gain).otherwise(s["best"]).alias("best"),
                        F.when(better, r["score"]).otherwise(s["t"]).alias("t"))

    return sums.select(F.when((F.col("a") > 0) & (F.col("b") > 0), F.aggregate("x", state, step)["t"]).otherwise(0).alias("t"))


def judge(pages: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; score is null where a rule decided a URL of the models."""
    rows = pick(pages, "page_id", "url")
    distinct = rows.select(F.coalesce("url", F.lit("")).alias("url")).groupBy("url").agg(F.count(F.lit(1)).alias("rows"))
    host, path = host_and_path(F.col("url"))
    named = distinct.select(F.monotonically_increasing_id().alias("id"), "url", host.alias("host"), path.alias("path"))
    name, verdict = ruled(F.col("host"), F.col("path"), rules)
    held = F.substring(F.md5("url"), 1, 1).isin(*HELD_OUT)
    # Written, so that the numbers of the URLs stay.
    urls = stage(named.select("id", "url", "host", "path", name.alias("rule"), verdict.alias("verdict"), held.alias("held")), "urls")
    grams, contexts = character_counts(urls.where(F.col("verdict").isNotNull() & ~F.col("held")).select("url", "verdict"))
    grams, contexts = stage(grams, "grams"), stage(contexts, "contexts")
    open_urls = urls.where(F.col("verdict").isNull() | F.col("held"))
    wanted = open_urls.where(F.length("url") > 0).select(F.explode(windows(F.col("url"))).alias("w")).distinct()
    scored = stage(scores(open_urls.select("id", "url"), stage(log_ratios(wanted, grams, contexts), "ratios")), "scores")
    told = urls.drop("held").join(scored.hint("merge"), "id", "left")
    cut = threshold(told.where(F.col("verdict").isNotNull() & F.col("score").isNotNull()))
    chosen = F.when(F.col("score") >= cut.scalar(), F.lit("allow")).otherwise(F.lit("block"))
    judged = told.select("url", "host", "path", "rule", F.coalesce("verdict", chosen).alias("verdict"), "score")
    keyed = rows.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"))
    return keyed.join(judged, "url", "left").drop("url")


def op11_url_filter(spark, sf_dir) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _rule_sql(what: str) -> str:
    cases = "".join(
        f" WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}') THEN '{what.format(r=r)}'"
        for r in sorted(RULES, key=lambda r: -len(r.name)))
    return f"CASE{cases} END"


def _chance_sql(side: str) -> str:
    p = f"CAST({UNIFORM!r} AS DOUBLE)"
    for k in range(ORDER + 1):
        seen, n, t = (f"coalesce({x}, 0)" for x in (f"g{k}.{side}", f"c{k}.n_{side}", f"c{k}.t_{side}"))
        p = f"(CASE WHEN {n} > 0 THEN ({seen} + {t} * {p}) / ({n} + {t}) ELSE {p} END)"
    return p


ORACLE = f"""
WITH cut AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN instr(url, '://') > 0
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosted AS (SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
parts AS (SELECT page_id, url, translate(h, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM hosted),
ruled AS (SELECT *, {_rule_sql('{r.name}')} AS rule, {_rule_sql('{r.verdict}')} AS ruled,
    substr(md5(url), 1, 1) IN ({', '.join(repr(c) for c in HELD_OUT)}) AS held FROM parts),
urls AS (SELECT DISTINCT url, ruled, held FROM ruled),
win AS (SELECT url, ruled, held, substr(repeat(chr(1), {ORDER}) || url, CAST(i AS INT), {ORDER + 1}) AS w
    FROM (SELECT *, unnest(range(1, length(url) + 1)) AS i FROM urls)),
whole AS (SELECT w, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
    FROM win WHERE ruled IS NOT NULL AND NOT held GROUP BY w),
grams AS (SELECT substr(w, {ORDER + 1} - k, k + 1) AS g, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b
    FROM (SELECT *, unnest(range(0, {ORDER + 1})) AS k FROM whole) GROUP BY 1),
contexts AS (SELECT substr(g, 1, length(g) - 1) AS c, CAST(sum(a) AS BIGINT) AS n_a, CAST(sum(b) AS BIGINT) AS n_b,
    count(*) FILTER (a > 0) AS t_a, count(*) FILTER (b > 0) AS t_b FROM grams GROUP BY 1),
wanted AS (SELECT DISTINCT w FROM win WHERE ruled IS NULL OR held),
ratios AS (SELECT w, CAST(round((ln({_chance_sql('a')}) - ln({_chance_sql('b')})) * {SCALE}) AS BIGINT) AS ratio FROM wanted
    {' '.join(f"LEFT JOIN contexts c{k} ON c{k}.c = substr(w, {ORDER + 1 - k}, {k}) LEFT JOIN grams g{k} ON g{k}.g = substr(w, {ORDER + 1 - k}, {k + 1})" for k in range(ORDER + 1))}),
sums AS (SELECT url, sum(ratio) AS s FROM win JOIN ratios USING (w) WHERE ruled IS NULL OR held GROUP BY url),
scored AS (SELECT url, ruled, CAST(greatest(least(floor(CAST(coalesce(s, 0) AS DOUBLE) / greatest(length(url), 1) / {STEP}),
    {BOUND}), -{BOUND}) AS INT) AS score FROM urls LEFT JOIN sums USING (url) WHERE ruled IS NULL OR held),
hist AS (SELECT score, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
    FROM scored WHERE ruled IS NOT NULL GROUP BY score),
tot AS (SELECT coalesce(sum(a), 0) AS ta, coalesce(sum(b), 0) AS tb FROM hist),
gains AS (SELECT h.score, (SELECT coalesce(sum(a), 0) FROM hist x WHERE x.score >= h.score) * tb
    + (SELECT coalesce(sum(b), 0) FROM hist x WHERE x.score < h.score) * ta AS gain FROM hist h, tot WHERE ta > 0 AND tb > 0),
best AS (SELECT coalesce((SELECT score FROM gains ORDER BY gain DESC, score LIMIT 1), 0) AS t)
SELECT page_id, host, path, rule, coalesce(r.ruled, CASE WHEN score >= t THEN 'allow' ELSE 'block' END) AS verdict, score
FROM ruled r LEFT JOIN scored s ON s.url = r.url, best
"""
