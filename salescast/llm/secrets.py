"""Secret scans over an incremental ledger of blobs, with DataFrame functions only.

Every version of every path is content-addressed (SHA-256). A ledger holds one row per blob and
rule version with the spans found. A scan takes only blob and rule-version pairs that the ledger
lacks, appends them, and joins the findings back to all paths that hold the blob. A new version of
a rule makes that rule alone run again.

Spans are code points, end exclusive. ``split`` gives the pieces between the matches of a pattern
and ``regexp_extract_all`` the matches, both leftmost and non-overlapping; running sums of their
lengths are the places. Besides the base rules the ledger scans private-key headers and signed web
tokens, which add spans of their own. A pair that racing scans have written twice counts once.

Defined results: a null text counts as empty; repeated rows share a blob and get the same findings
each; a text without findings has counts 0, the hash of the empty string and empty spans; an empty
table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm.common import pick, table
from salescast.session import scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    #: Group of which ``least`` characters are asked for; 0 is the whole match.
    group: int
    least: int
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules. Runs are possessive, which changes no match.
RULES = [
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}+", 0, 32),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1, False),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1, False),
]
SPANS = "array<struct<s:int,e:int>>"
KEYS = "array<struct<key:string,spans:array<struct<s:int,e:int>>>>"


def found(text: Column, rule: Rule) -> Column:
    """Spans of one rule in a text; texts without a match stop after one look."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = whole if not rule.group else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    walk = F.aggregate(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("hit"), part.alias("part")),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
            F.when(F.length(x["part"]) >= rule.least, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(x["gap"])).alias("s"),
                (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("e")))))
            .otherwise(acc["spans"]).alias("spans")))
    return F.when(text.rlike(rule.pattern), walk["spans"]).otherwise(F.array().cast(SPANS))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"blob binary, rule string, spans {SPANS}")


def scan(versions: DataFrame, ledger_path: str, rules: list[Rule] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``versions`` (path, version, text) and return its findings.

    One row per (path, version): ``found``, an array of (rule key, spans) in the order of ``rules``.
    """
    spark = versions.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    known = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)
    wanted = [r.key for r in rules]
    rows = pick(versions, "path", "version", "text").select(
        "path", "version", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    blobs = rows.groupBy("blob").agg(F.first("text").alias("text"))
    if known:
        seen = spark.read.parquet(ledger_path).where(F.col("rule").isin(wanted))
        seen = seen.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    else:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    blobs = blobs.where(F.size(F.array_except(F.array(*map(F.lit, wanted)), "seen")) > 0)
    text = F.col("text")
    fresh = blobs.select("blob", F.explode(F.array(*[
        F.struct(F.lit(r.key).alias("rule"),
                 F.when(~F.array_contains("seen", r.key), found(text, r)).alias("spans")) for r in rules])).alias("x"))
    fresh.select("blob", "x.rule", "x.spans").where("spans is not null").write.mode("append").parquet(ledger_path)
    ledger = spark.read.schema(empty_ledger(spark).schema).parquet(ledger_path)
    hits = ledger.where(F.col("rule").isin(wanted) & (F.size("spans") > 0)).groupBy("blob").agg(
        F.sort_array(F.collect_set(F.struct(F.col("rule").alias("key"), "spans"))).alias("found"))
    keys = rows.select("path", "version", "blob")
    return keys.join(hits, "blob", "left").select(
        "path", "version", F.coalesce("found", F.array().cast(KEYS)).alias("found"))


def _spans_of(rule: Rule) -> Column:
    return F.flatten(F.transform(F.filter("found", lambda f: f["key"] == rule.key), lambda f: f["spans"]))


def _labelled(rule: Rule, n: int) -> Column:
    return F.transform(_spans_of(rule), lambda p: F.struct(
        p["s"].alias("s"), F.lit(n).alias("n"),
        F.concat_ws(":", F.lit(rule.kind), p["s"].cast("string"), p["e"].cast("string")).alias("t")))


def _joined(rules: list[Rule]) -> Column:
    """kind:start:end by start, then rule as listed, comma-joined."""
    flat = F.concat(*[_labelled(r, n) for n, r in enumerate(rules)])
    return F.array_join(F.transform(F.array_sort(flat), lambda x: x["t"]), ",")


def _count(rule: Rule) -> Column:
    return F.size(_spans_of(rule)).cast("long")


def secrets_of(docs: DataFrame, ledger_path: str) -> DataFrame:
    """Digest per document: counts of the base rules, hash of the base spans, all spans."""
    versions = pick(docs, "doc_id", "text").select(F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text")
    out = scan(versions, ledger_path)
    base = [r for r in RULES if r.base]
    return out.select(
        F.col("path").alias("doc_id"), *[_count(r).alias(f"n_{r.kind}") for r in base],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(RULES).alias("spans"))


def op2_secrets(spark, sf_dir) -> DataFrame:
    return secrets_of(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
