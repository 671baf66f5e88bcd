"""Soft-membership mixing of sources to target weights, with DataFrame functions only.

1. A naive Bayes classifier over hashed words and word ends learns the domains of a labelled table
   from at most ``SAMPLE`` documents a domain; only clearly telling buckets are kept, a table of at
   most ``WORD_BUCKETS + END_BUCKETS`` rows.
2. One pass over the texts gives every document its tokens (words) and domain posteriors.
   ``op7_mixing`` takes the posteriors of :mod:`salescast.llm.calibrated` instead of both.
3. Projected-gradient least squares finds document rates r >= 0 whose expected tokens of domain k,
   sum(tokens * p_k * r), meet the targets. Steps are summed before the projection (lazy projection)
   and taken in the metric that weighs a document by its tokens, whitened over domains, so a
   document's rate depends on its posteriors alone. Each step is one aggregate of (domains + 1) *
   domains numbers; the driver holds those and nothing that grows with the documents.

Defined results: a null or empty text has 0 tokens, the prior as posteriors and takes part like any
other; repeated rows get the same rate each; an id with several labels takes the first domain in
alphabetical order; labels of ids that ``docs`` lacks are left out; a domain that no labelled document
has gets posterior 0, and its target goes to the other domains in proportion (all rates are 1 where no
target or no anchor is left); without any label all posteriors are equal; an empty table gives an empty
result; extra columns are left out.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm import calibrated
from salescast.llm.common import DOC_COLS, first_of_each, pick, stage, table

#: Labelled documents a domain that the classifier is fitted on, at most.
SAMPLE = 1500
WORD_BUCKETS, END_BUCKETS = 1 << 16, 1 << 9
#: A bucket is kept if its log odds differ by ``LIFT`` and its count by ``SIGMA`` standard errors.
LIFT, SIGMA = 1.2, 6.0
STEPS, TOLERANCE = 60, 1e-4
#: How firmly rates are held near 1 where the targets cannot be met.
RIDGE = 0.1
#: Share of all tokens that each domain should have.
TARGETS = {"clean": 0.90, "low": 0.07, "toxic": 0.03}


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents: low quality, else toxic, else clean."""
    named = pick(labels, "doc_id", "quality", "toxic").where("doc_id is not null").select(
        "doc_id", F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 1, "clean").alias("domain"))
    return named.where("domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))


def own_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the documents of ``docs`` that have a label."""
    return domains(labels).join(pick(docs, "doc_id"), "doc_id", "left_semi")


def _terms(docs: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per word: its bucket and the bucket of its last two characters."""
    word = F.col("word")
    words = docs.select(*keep, F.explode(F.split(F.coalesce("text", F.lit("")), r"\s+")).alias("word"))
    return words.withColumns({
        "a": F.pmod(F.xxhash64(F.lower(word)), F.lit(WORD_BUCKETS)).cast("int"),
        "z": (F.pmod(F.xxhash64(F.substring(word, -2, 2)), F.lit(END_BUCKETS)) + WORD_BUCKETS).cast("int")})


def fit(docs: DataFrame, labelled: DataFrame, names: list[str], sample: int = SAMPLE):
    """(log priors, bucket -> weight per domain) of the classifier; ``labelled`` holds ids of ``docs``."""
    shares = {r.domain: r["count"] for r in labelled.where(F.col("domain").isin(names)).groupBy("domain").count().collect()}
    total = sum(shares.values())
    prior = np.array([math.log(shares[n] / total) if n in shares else -math.inf for n in names] if total else [0.0] * len(names))
    ids = first_of_each(labelled.where(F.col("domain").isin(names)), "domain", ["doc_id"], sample)
    # The sample is bounded: SAMPLE ids a domain.
    rows = _terms(docs.join(F.broadcast(ids), "doc_id"), "doc_id", "domain").where("word <> ''")
    # Documents that hold a bucket, not words: a document that repeats one word counts once.
    held = rows.select("doc_id", "domain", F.explode(F.array("a", "z")).alias("bucket")).distinct()
    counted = held.groupBy("bucket", "domain").count()
    size = WORD_BUCKETS + END_BUCKETS
    seen = np.zeros((len(names), size))
    for r in counted.collect():
        seen[names.index(r.domain), r.bucket] = r["count"]
    out: dict[int, list[float]] = {}
    for lo, hi in ((0, WORD_BUCKETS), (WORD_BUCKETS, size)):
        c = seen[:, lo:hi]
        smooth = c + 1.0
        w = np.log(smooth / smooth.sum(1, keepdims=True))
        for k in range(len(names)):
            if not c[k].any():
                w[k] = w[c.any(1)].mean(0) if c.any() else 0.0
        rest = np.log((smooth.sum(0) - smooth) / (smooth.sum() - smooth.sum(1, keepdims=True)))
        expected = c.sum(0) * (c.sum(1, keepdims=True) / max(c.sum(), 1.0))
        clear = (np.abs(w - rest) > LIFT) & (np.abs(c - expected) > SIGMA * np.sqrt(expected + 1.0))
        centred = w - w.mean(0)
        for b in np.flatnonzero(clear.any(0)):
            out[lo + int(b)] = [float(v) for v in centred[:, b]]
    return prior, out


def memberships(docs: DataFrame, labelled: DataFrame, names: list[str]) -> DataFrame:
    """(doc_id, rid, copies, tokens, p): posteriors ``p`` in the order of ``names``; one row per distinct row."""
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text")
    prior, weights = fit(docs, labelled, names)
    cols = [f"w{k}" for k in range(len(names))]
    known = spark.createDataFrame(
        [(b, *w) for b, w in weights.items()], "bucket int, " + ", ".join(f"{c} double" for c in cols))
    keyed = docs.withColumn("rid", F.xxhash64("doc_id", "text"))
    rows = keyed.select("doc_id", "rid", "text")
    words = rows.select("doc_id", "rid", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\s+")).alias("pos", "word"))
    words = words.withColumns({
        "a": F.pmod(F.xxhash64(F.lower("word")), F.lit(WORD_BUCKETS)).cast("int"),
        "z": (F.pmod(F.xxhash64(F.substring("word", -2, 2)), F.lit(END_BUCKETS)) + WORD_BUCKETS).cast("int")})
    for side in "az":  # at most WORD_BUCKETS + END_BUCKETS rows
        words = words.join(F.broadcast(known.toDF(side, *[f"{side}_{c}" for c in cols])), side, "left")
    real = F.col("word") != ""
    summed = words.groupBy("doc_id", "rid").agg(
        F.sum((F.col("pos") == 0).cast("long")).alias("copies"), F.sum(real.cast("long")).alias("n"),
        *[F.sum(F.when(real, F.coalesce(f"a_{c}", F.lit(0.0)) + F.coalesce(f"z_{c}", F.lit(0.0))).otherwise(0.0)).alias(c)
          for c in cols])
    logit = F.array(*[F.col(c) / F.col("copies") + float(prior[k]) for k, c in enumerate(cols)])
    odds = F.transform("logit", lambda x: F.when(x == -math.inf, 0.0).otherwise(
        F.exp(F.greatest(x - F.array_max("logit"), F.lit(-50.0)))))
    return summed.select(
        "doc_id", "rid", "copies", (F.col("n") / F.col("copies")).cast("long").alias("tokens"), logit.alias("logit")
    ).withColumn("odds", odds).select(
        "doc_id", "rid", "copies", "tokens",
        F.transform("odds", lambda x: x / F.aggregate("odds", F.lit(0.0), lambda s, y: s + y)).alias("p"))


def rate_expression(pull: np.ndarray, p: str = "p") -> Column:
    """The rate as a function of the posteriors: 1 less the summed gradient steps, projected to r >= 0."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.col(p)[k] * float(v) for k, v in enumerate(pull)), F.lit(0.0)))


def fit_rates(members: DataFrame, names: list[str], targets: dict[str, float], anchor: str | None = None, thin: bool = False) -> np.ndarray:
    """Summed steps of the projected gradient (lazy projection). Targets are shares of all tokens, or,
    with ``anchor``, are scaled so that the anchor domain's target is what it has. ``thin`` caps the target
    of a domain at what it has.

    The sum of steps is the dual variable of the targets; a step that does not lower the dual function
    is halved and tried again, so the steps also settle where many rates are 0. Targets that are not met
    within ``TOLERANCE`` are told by a warning and approached by bounded rates instead: missing them costs
    the square of the miss over 2 * RIDGE * tokens, so no rate leaves 1 by more than the miss that rates of
    1 have, as a share of all tokens, over RIDGE.
    """
    k = len(names)
    weight = F.col("tokens") * F.col("copies")
    p = [F.col("p")[i] for i in range(k)]

    def look(pull):
        """Tokens by domain at these rates, and how they answer to a step among the rates above 0."""
        rated = members.select(rate_expression(pull).alias("r"), "tokens", "copies", "p")
        on = F.when(F.col("r") > 0, weight).otherwise(0)
        zero = F.lit(0.0)
        got = rated.agg(
            F.coalesce(F.sum(weight * F.col("r") * F.col("r")) / 2, zero),
            *[F.coalesce(F.sum(weight * p[i] * F.col("r")), zero) for i in range(k)],
            *[F.coalesce(F.sum(on * p[i] * p[j]), zero) for i in range(k) for j in range(k)]).first()
        return got[0], np.array(got[1 : k + 1], float), np.array(got[k + 1 :], float).reshape(k, k)

    def steps(goal, ridge):
        """Summed steps and the tokens that they miss; ``ridge`` keeps the sum finite where the goal cannot be met."""
        pull, half, now, gram = np.zeros(k), *start
        size, dual = 1.0, half
        for _ in range(STEPS):
            miss = now - goal - ridge * pull
            if np.abs(miss).sum() <= TOLERANCE * goal.sum() or size < 1e-6:
                break
            white = np.linalg.pinv(gram + np.eye(k) * (ridge + 1e-6 * np.trace(gram) / k))
            tried = pull + size * (white @ miss)
            half, then, gram_then = look(tried)
            value = half + tried @ goal + ridge / 2 * tried @ tried
            if value < dual:
                pull, now, gram, dual, size = tried, then, gram_then, value, min(1.0, size * 2)
            else:
                size /= 2
        return pull, np.abs(now - goal).sum() / goal.sum()

    start = look(np.zeros(k))
    now = start[1]
    if not now.sum():
        return np.zeros(k)
    share = np.array([targets[n] for n in names], float) * (now > 0)
    if not share.sum() or (anchor is not None and not share[names.index(anchor)]):
        warnings.warn("mixing: no document of a domain that the targets need; all rates are 1", stacklevel=2)
        return np.zeros(k)
    share /= share.sum()
    goal = share * (now.sum() if anchor is None else now[names.index(anchor)] / share[names.index(anchor)])
    if thin:
        goal = np.minimum(goal, now)
    pull, missed = steps(goal, 0.0)
    if missed > TOLERANCE:
        pull, left = steps(goal, RIDGE * now.sum())
        warnings.warn(
            f"mixing: targets not met (missed by {missed:.3g} of the goal); bounded rates miss them by {left:.3g}", stacklevel=2)
    return pull


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, anchor: str | None = None,
        thin: bool = False, posteriors=memberships) -> DataFrame:
    """(doc_id, rid, copies, tokens, p, rate), one row per distinct row of ``docs``; ``posteriors`` gives all but the rate."""
    targets = targets or TARGETS
    names = sorted(targets)
    members = stage(posteriors(docs, stage(own_labels(docs, labels), "mix-domains"), names), "mix-members")
    return members.withColumn("rate", rate_expression(fit_rates(members, names, targets, anchor, thin)))


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float], anchor: str, thin: bool = False) -> DataFrame:
    """Documents repeated or left out at their rates: floor(rate + u), u fixed by the id."""
    rates = mix(docs, labels, targets, anchor, thin)
    u = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 20)) / float(1 << 20)
    times = rates.select("rid", F.floor(F.col("rate") + u).cast("int").alias("times")).where("times > 0")
    rows = pick(docs, *DOC_COLS).withColumn("rid", F.xxhash64("doc_id", "text")).join(times, "rid")
    return rows.withColumn("nth", F.explode(F.sequence(F.lit(1), "times"))).select(*DOC_COLS)


def op7_mixing(spark, sf_dir) -> DataFrame:
    names = sorted(TARGETS)
    out = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), posteriors=calibrated.memberships)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id", "tokens", *[F.col("p")[i].alias(f"p_{n}") for i, n in enumerate(names)], "rate")
