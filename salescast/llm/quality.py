"""Document quality by attention-based multiple-instance learning.

A text is a bag of passages of ``WORDS`` words. Every passage is described by surface measures and
encoded by one tanh layer; gated attention (a tanh branch times a sigmoid branch) weighs the encoded
passages; the weighted sum is scored by a logistic unit. Encoder, attention and scorer are learned
together from document labels alone, by Adam on a balanced sample of at most ``SAMPLE`` labelled
documents a class; the score is shifted back to the class shares of all training labels.

Defined results: a null or empty text is one passage without words and gets that passage's score; an
id with several labels takes the lowest, an id with several texts teaches one of them; labels other than 0 and 1 or null are left out; where a class
has no training label the score is the share of label 1 (0.5 without labels); repeated rows are scored
each; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salescast.llm.common import first_of_each, mod_crc, pick, table

WORDS = 64
#: Labelled documents a class that the model is fitted on, at most.
SAMPLE = 1500
STEPS = 400
ENCODED, GATES = 12, 8

_UPPER, _LOWER, _DIGIT = (bytes(range(ord(a), ord(b) + 1)) for a, b in ("AZ", "az", "09"))
_PLAIN = b".,;:'\"()-?\n "
_ENDS = frozenset(".,;:'\")?-")
N_FEATURES = 14


def passage(words: list[str]) -> list[float]:
    """Surface measures of one passage."""
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    raw = " ".join(words).encode("utf-8", "replace")
    size = len(raw)
    upper, lower, digit, plain = (size - len(raw.translate(None, c)) for c in (_UPPER, _LOWER, _DIGIT, _PLAIN))
    high = size - len(raw.translate(None, bytes(range(128, 256))))
    odd = size - upper - lower - digit - plain - high
    ends = sum(1 for w in words if not (w[-1].isalnum() or w[-1] in _ENDS))
    distinct = len(set(words))
    return [
        1.0, upper / size, digit / size, plain / size, high / size, odd / size, ends / n,
        distinct / n, sum(map(eq, words, words[1:])) / n, size / n / 8,
        sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n,
        sum(1 for w in words if len(w) == 1) / n, n / WORDS,
    ]


def bag(text: str | None) -> np.ndarray:
    """Measures of every passage of a whole text, one row each."""
    words = (text or "").split()
    cut = [words[i : i + WORDS] for i in range(0, len(words), WORDS)] or [[]]
    return np.array([passage(w) for w in cut], np.float32)


def _forward(m: dict, x: np.ndarray, first: np.ndarray):
    """Encoded passages, gates, attention, document vectors and logits; ``first`` row of each document."""
    h = np.tanh(((x - m["mean"]) / m["std"]) @ m["We"] + m["be"])
    t, g = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["U"])))
    e = (t * g) @ m["w"]
    doc = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    e = np.exp(e - np.maximum.reduceat(e, first)[doc])
    a = e / np.add.reduceat(e, first)[doc]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return h, t, g, a, doc, z, z @ m["c"] + m["b"][0]


def scores(m: dict, bags: list[np.ndarray]) -> np.ndarray:
    first = np.cumsum([0] + [len(b) for b in bags[:-1]])
    logit = _forward(m, np.concatenate(bags), first)[-1] + m["shift"]
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(bags: list[np.ndarray], y: np.ndarray, shift: float, steps: int = STEPS, seed: int = 7) -> dict:
    """Model fitted by Adam on all bags at once."""
    x = np.concatenate(bags).astype(np.float64)
    first = np.cumsum([0] + [len(b) for b in bags[:-1]])
    rng = np.random.default_rng(seed)
    m = {
        "We": rng.normal(0, 0.4, (N_FEATURES, ENCODED)), "be": np.zeros(ENCODED),
        "V": rng.normal(0, 0.4, (ENCODED, GATES)), "U": rng.normal(0, 0.4, (ENCODED, GATES)),
        "w": rng.normal(0, 0.4, GATES), "c": rng.normal(0, 0.4, ENCODED), "b": np.zeros(1),
    }
    fixed = {"mean": x.mean(0), "std": x.std(0) + 1e-3}
    xs = (x - fixed["mean"]) / fixed["std"]
    adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    for step in range(1, steps + 1):
        h, t, g, a, doc, z, logit = _forward(m | fixed, x, first)
        d = (1 / (1 + np.exp(-logit)) - y) / len(y)
        dz = d[:, None] * m["c"]
        dh = a[:, None] * dz[doc]
        da = (dz[doc] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, first)[doc])
        dt, dg = de[:, None] * m["w"] * g * (1 - t * t), de[:, None] * m["w"] * t * g * (1 - g)
        dh += dt @ m["V"].T + dg @ m["U"].T
        dpre = dh * (1 - h * h)
        grad = {
            "We": xs.T @ dpre, "be": dpre.sum(0), "V": h.T @ dt, "U": h.T @ dg,
            "w": ((t * g) * de[:, None]).sum(0), "c": z.T @ d, "b": np.array([d.sum()]),
        }
        for k, v in grad.items():
            v = v + 1e-4 * m[k]
            p, q = adam[k]
            p += 0.1 * (v - p)
            q += 0.001 * (v * v - q)
            m[k] -= 0.02 * (p / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
    return m | fixed | {"shift": shift}


def constant(share: float) -> dict:
    share = min(max(share, 1e-6), 1 - 1e-6)
    zero = {
        "We": np.zeros((N_FEATURES, 1)), "be": np.zeros(1), "V": np.zeros((1, 1)), "U": np.zeros((1, 1)),
        "w": np.zeros(1), "c": np.zeros(1), "b": np.zeros(1), "mean": np.zeros(N_FEATURES), "std": np.ones(N_FEATURES),
    }
    return zero | {"shift": float(np.log(share / (1 - share)))}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Model from the labelled documents of the training folds (crc32 of the id modulo 3 not 1)."""
    known = (
        pick(labels, "doc_id", "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(mod_crc("doc_id", 3) != 1).groupBy("doc_id").agg(F.min("quality").alias("quality")))
    counts = dict(known.groupBy("quality").count().collect())
    if len(counts) < 2:
        return constant(float(next(iter(counts), 0.5)))
    ids = first_of_each(known, "quality", ["doc_id"], sample)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "quality": pdf["quality"],
                "bag": [bag(t).tobytes() for t in pdf["text"]]})

    # The sample is bounded: 2 * SAMPLE ids.
    rows = (
        pick(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id")
        .mapInPandas(encode, "doc_id long, quality int, bag binary")
        .groupBy("doc_id", "quality").agg(F.min("bag").alias("bag")).collect())
    rows.sort(key=lambda r: r.doc_id)
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, N_FEATURES) for r in rows]
    y = np.array([r.quality for r in rows], float)
    if not 0 < y.sum() < len(y):
        return constant(counts[1] / (counts[0] + counts[1]))
    shift = np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return fit(bags, y, float(shift))


def scorer(model: dict):
    """Column function: text -> score between 0 and 1."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = [
                scores(model, [bag(t) for t in texts.iloc[i : i + 256]]) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    score = scorer(train(docs, labels))
    return pick(docs, "doc_id", "text").select(
        "doc_id", (mod_crc("doc_id", 3) == 1).alias("held_out"), score("text").alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_quality_classifier(spark, sf_dir) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
