"""Domain posteriors calibrated on held-out labels, with DataFrame functions only.

A naive Bayes classifier over hashed words, word ends and three shapes of the whole text (words, share of
distinct words, mean length) learns the domains of a labelled table from at most ``SAMPLE`` documents a
domain; what a document holds counts once. Only clearly telling buckets are kept, a table of at most
``WORD_BUCKETS + END_BUCKETS + SHAPES`` rows. A third of the labels, by crc32 of the id, is held out.
One pass over the texts gives every document its tokens (words) and its cell: the domain that scores
best and by how much. The posteriors of a cell are the shares of tokens that domains have among the
held-out labelled documents that fall into it, all of them, so that they are calibrated for documents
without a telling word too. A thin cell leans on all cells of its domain, these on the priors.

Defined results: a null or empty text has 0 tokens and the posteriors of its cell like any other; repeated
rows make one row with their number in ``copies``; a domain that no labelled document has gets posterior 0;
without labels all posteriors are equal; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import first_of_each, mod_crc, pick, stage

#: Labelled documents a domain that the classifier is fitted on, at most.
SAMPLE = 1500
WORD_BUCKETS, END_BUCKETS = 1 << 16, 1 << 9
#: Buckets of the shapes, 16 each.
SHAPES = 48
#: A bucket is kept if its log odds are ``LIFT`` higher and its count is ``SIGMA`` standard errors off.
LIFT, SIGMA = 1.2, 4.0
#: Cells a domain and the lead in log odds that each spans; held-out labels are every third.
CELLS, LEAD = 8, 2.0
HELD_OUT, FOLDS = 1, 3


def _words(docs: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per distinct word of a text (one at least): its buckets, and in ``pos`` 0 once a text.

    ``n`` is the number of words, ``shape`` the buckets of the whole text.
    """
    size = F.col("n") + F.lit(0.0)
    ends = WORD_BUCKETS + END_BUCKETS
    shapes = [F.log2(size + 1), F.size("all") / F.greatest(size, F.lit(1.0)) * 15, F.length("text") / F.greatest(size, F.lit(1.0))]
    texts = docs.withColumn("all", F.split(F.coalesce("text", F.lit("")), r"\s+"))
    texts = texts.withColumn("n", F.size("all") - F.when(F.element_at("all", 1) == "", 1).otherwise(0)
                             - F.when((F.size("all") > 1) & (F.element_at("all", -1) == ""), 1).otherwise(0))
    texts = texts.withColumn("all", F.array_distinct("all")).withColumn("shape", F.array(*[
        (F.least(F.coalesce(v, F.lit(0.0)), F.lit(15.0)).cast("int") + (ends + 16 * i)) for i, v in enumerate(shapes)]))
    words = texts.select(*keep, "n", "shape", F.posexplode("all").alias("pos", "word"))
    return words.withColumns({
        "a": F.pmod(F.xxhash64(F.rtrim(F.lower("word"), F.lit(".,;:!?"))), F.lit(WORD_BUCKETS)).cast("int"),
        "z": (F.pmod(F.xxhash64(F.substring("word", -2, 2)), F.lit(END_BUCKETS)) + WORD_BUCKETS).cast("int")})


def fit(docs: DataFrame, labelled: DataFrame, names: list[str], sample: int = SAMPLE):
    """(shares, bucket -> weight per domain) of the classifier; ``labelled`` holds ids of ``docs``."""
    shares = {r.domain: r["count"] for r in labelled.where(F.col("domain").isin(names)).groupBy("domain").count().collect()}
    total = sum(shares.values())
    prior = np.array([shares.get(n, 0) / total for n in names] if total else [1 / len(names)] * len(names))
    learned = labelled.where(F.col("domain").isin(names) & (mod_crc("doc_id", FOLDS) != HELD_OUT))
    ids = first_of_each(learned, "domain", ["doc_id"], sample)
    # The sample is bounded: SAMPLE ids a domain.
    rows = _words(docs.join(F.broadcast(ids), "doc_id"), "doc_id", "domain")
    # Documents that hold a bucket, not words: a document that repeats one word counts once.
    held = rows.select("doc_id", "domain", F.explode(F.concat(F.when(F.col("word") != "", F.array("a", "z")).otherwise(
        F.array().cast("array<int>")), F.when(F.col("pos") == 0, F.col("shape")).otherwise(F.array().cast("array<int>")),
        F.array(F.lit(-1)))).alias("bucket")).distinct()
    seen, many = np.zeros((len(names), WORD_BUCKETS + END_BUCKETS + SHAPES)), np.zeros((len(names), 1))
    for r in held.groupBy("bucket", "domain").count().collect():
        if r.bucket < 0:  # every document holds it
            many[names.index(r.domain)] = r["count"]
        else:
            seen[names.index(r.domain), r.bucket] = r["count"]
    # A bucket speaks for the one domain that it tells best, never against one and never for the commonest: ordinary
    # words that a rarer domain has less of come in hundreds, not independently, and would outweigh a telling one.
    rest, others = seen.sum(0) - seen, many.sum() - many
    expected = seen.sum(0) * many / max(many.sum(), 1.0)
    sure = np.abs(seen - expected) / np.sqrt(expected + 1.0)
    lift = np.log((seen + 0.5) / (many + 1)) - np.log((rest + 0.5) / (others + 1))
    sure[lift < LIFT] = 0.0
    sure[prior.argmax()] = 0.0
    own = sure.argmax(0)
    clear = sure.max(0) > SIGMA
    return prior, {int(b): [float(lift[own[b], b]) if k == own[b] else 0.0 for k in range(len(names))] for b in np.flatnonzero(clear)}


def _cells(docs: DataFrame, prior: np.ndarray, weights: dict[int, list[float]]) -> DataFrame:
    """(doc_id, rid, copies, tokens, cell), one row per distinct row of ``docs``."""
    k = len(prior)
    cols = [f"w{i}" for i in range(k)]
    known = docs.sparkSession.createDataFrame(
        [(b, *w) for b, w in weights.items() if b < WORD_BUCKETS], "a int, " + ", ".join(f"{c} double" for c in cols))
    words = _words(docs.withColumn("rid", F.xxhash64("doc_id", "text")), "doc_id", "rid")
    words = words.join(F.broadcast(known), "a", "left")  # at most WORD_BUCKETS rows
    real = F.col("word") != ""
    flat = range(WORD_BUCKETS, WORD_BUCKETS + END_BUCKETS + SHAPES)
    telling = F.expr("array(" + ",".join(str(b in weights).lower() for b in flat) + ")")
    z = F.col("z") - (WORD_BUCKETS - 1)
    summed = words.groupBy("doc_id", "rid", "n", "shape").agg(
        F.sum((F.col("pos") == 0).cast("long")).alias("copies"), *[F.sum(F.when(real, F.col(c))).alias(c) for c in cols],
        F.collect_set(F.when(real & F.element_at(telling, z), F.col("z"))).alias("ends"))

    def once(i: int) -> Column:
        table_of = F.expr("array(" + ",".join(f"{weights[b][i]!r}D" if b in weights else "0D" for b in flat) + ")")
        return F.aggregate(F.concat("ends", "shape"), F.lit(0.0), lambda s, b: s + F.element_at(table_of, b - (WORD_BUCKETS - 1)))

    scores = F.array(*[
        F.coalesce(F.col(c) / F.col("copies"), F.lit(0.0)) + once(i) + (float(np.log(prior[i])) if prior[i] else -1e9)
        for i, c in enumerate(cols)])
    ranked = F.sort_array("scores", False)
    lead = F.coalesce(F.try_element_at(ranked, F.lit(1)) - F.try_element_at(ranked, F.lit(2)), F.lit(0.0))
    step = F.least(F.floor(lead / LEAD), F.lit(CELLS - 1)).cast("int")
    return summed.select("doc_id", "rid", "copies", F.col("n").cast("long").alias("tokens"), scores.alias("scores")).select(
        "doc_id", "rid", "copies", "tokens",
        ((F.array_position("scores", F.array_max("scores")).cast("int") - 1) * CELLS + step).alias("cell"))


def memberships(docs: DataFrame, labelled: DataFrame, names: list[str]) -> DataFrame:
    """(doc_id, rid, copies, tokens, p): posteriors ``p`` in the order of ``names``; one row per distinct row."""
    docs = pick(docs, "doc_id", "text")
    prior, weights = fit(docs, labelled, names)
    cells = stage(_cells(docs, prior, weights), "mix-cells")
    held_out = labelled.where(F.col("domain").isin(names) & (mod_crc("doc_id", FOLDS) == HELD_OUT))
    seen = np.zeros((len(names), CELLS, len(names)))
    many = np.zeros((len(names), CELLS, 1))
    told = cells.join(held_out, "doc_id").groupBy("cell", "domain").agg(
        F.count("*").alias("documents"), F.sum(F.col("tokens") + 1).alias("tokens"))
    for r in told.collect():
        seen[r.cell // CELLS, r.cell % CELLS, names.index(r.domain)] = r.tokens
        many[r.cell // CELLS, r.cell % CELLS] += r.documents
    seen *= many / np.maximum(seen.sum(2, keepdims=True), 1.0)  # shares of tokens, as firm as the documents are many
    best = seen.sum(1) + prior
    best /= best.sum(1, keepdims=True)
    p = seen + best[:, None, :]
    p /= p.sum(2, keepdims=True)
    shares = F.expr("array(" + ",".join(
        "array(" + ",".join(f"{float(v)!r}D" for v in row) + ")" for row in p.reshape(-1, len(names))) + ")")
    return cells.select("doc_id", "rid", "copies", "tokens", F.element_at(shares, F.col("cell") + 1).alias("p"))
