"""Bounded samples, full rates, repeated ledger rows and Unicode words."""

import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.llm import calibrated, decontamination, language, mixing, quality, secrets
from salescast.llm.common import first_of_each


@pytest.mark.parametrize("n", [1, 7, 2000])
def test_first_of_each_equals_one_ranking(spark, n):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("kind"))
    hashed = [r.asDict() for r in df.withColumn("h", F.xxhash64("doc_id")).collect()]
    want = {
        r["doc_id"] for kind in ("hot", "cold")
        for r in sorted((r for r in hashed if r["kind"] == kind), key=lambda r: (r["h"], r["doc_id"]))[:n]}
    got = first_of_each(df, "kind", ["doc_id"], n, 5).collect()
    assert len(got) == len(want) and {r.doc_id for r in got} == want


def test_a_pair_written_twice_to_the_ledger_counts_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "token=abcdefgh1 token=abcdefgh1"), (2, "nothing")], "doc_id long, text string")
    path = str(tmp_path / "ledger")
    once = sorted(secrets.secrets_of(docs, path).collect())
    spark.read.parquet(path).write.mode("append").parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("append").parquet(path)
    assert sorted(secrets.secrets_of(docs, path).collect()) == once
    assert {r.doc_id: r.n_assign for r in once} == {1: 2, 2: 0}


def test_a_second_version_is_scanned_into_the_same_ledger(spark, tmp_path):
    schema, path = "path long, version int, text string", str(tmp_path / "ledger")
    old, new = [(1, 0, "token=abcdefgh1"), (2, 0, "plain")], [(1, 1, "token removed"), (2, 1, "plain"), (3, 1, "token=abcdefgh1")]
    secrets.scan(spark.createDataFrame(old, schema), path)
    found = secrets.scan(spark.createDataFrame(old + new, schema), path).collect()
    # Three texts in all: the second scan adds one blob, and findings reach every path and version.
    assert spark.read.parquet(path).count() == 3 * len(secrets.RULES)
    assert {(r.path, r.version) for r in found if r.found} == {(1, 0), (3, 1)}


PASSAGE = "the quick brown fox said that every careful reader should look at the whole page before it is turned again"


@pytest.mark.parametrize("text", [
    PASSAGE.replace("quick brown", "“quick brown”"),
    PASSAGE.replace("fox said", "fox\u2014said").replace("page before", "page \u2013 before"),
    PASSAGE.replace(" ", "\u00a0"),
    PASSAGE.replace(" careful ", " \u2018careful\u2019\u2026 ").replace(" ", "\u202f"),
    PASSAGE.upper(),
])
def test_typographic_marks_do_not_hide_an_item(spark, text):
    docs = spark.createDataFrame([(1, "ahead " * 9 + text + " behind" * 9), (2, "ahead " * 30)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, PASSAGE)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.similarity) for r in decontamination.contaminated(docs, bench).collect()] == [(1, 5, 1.0)]


def test_plain_bytes_follow_the_character_table():
    text = "".join(chr(c) for c in [*range(0x20, 0x3000), *range(0xFF00, 0xFFEF), *range(0x10000, 0x10400), 0x1F600])
    text = "".join(c for c in text if unicodedata.category(c)[0] != "C")
    out = decontamination.plain(np.frombuffer(text.encode(), np.uint8)).tobytes().decode()
    at = 0
    for c in text:
        low, size = c.lower(), len(c.encode())
        if c.isascii():
            want = low
        elif unicodedata.category(c)[0] not in "LMN":
            want = " " * size
        else:
            same = unicodedata.category(c) in ("Lu", "Lt") and len(low) == 1 and len(low.encode()) == size
            want = low if same else c
        assert out[at : at + len(want)] == want, hex(ord(c))
        at += len(want)
    assert at == len(out)


def test_language_samples_are_bounded_pieces(spark):
    long = " ".join(f"wort{i % 997}" for i in range(60_000))
    rows = [(i, f"short text number {i}", "en") for i in range(400)] + [(1, long, "de"), (1, long, "de"), (3, "anderer", "de"), (5, "", "xx")]
    got = language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 50)
    assert set(got) <= {"en", "de", "xx"} and len(got["en"]) == 50
    assert all(len(p) <= language.PIECE for pieces in got.values() for p in pieces)
    assert all(len(pieces) <= language.PIECES and max(Counter(pieces).values()) == 1 for pieces in got.values())
    whole = long.encode()
    assert all(p in whole or p == b"anderer" for p in got.get("de", []))


def test_quality_takes_one_text_of_a_repeated_id(spark):
    rows = [(i, f"Some words of text {i}." if i % 2 else "@@ ## 11 $$ 22", ) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows + rows[:20] * 5, "doc_id long, text string")
    once = quality.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    again = quality.train(docs, labels)
    assert all(np.array_equal(once[k], again[k]) for k in once)


def test_mixed_documents_keep_small_rates(spark, monkeypatch):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    rates = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), F.lit(0.004).alias("rate"))
    monkeypatch.setattr(mixing, "mix", lambda *_: rates)
    assert 50 < mixing.mixed_documents(docs, docs, {"clean": 1.0}, "clean").count() < 115


def test_block_tables_return_every_item_within_the_radius():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{v}" for v in rng.integers(0, 400, 12)) for _ in range(300)]
    index = decontamination.Index(list(range(300)), texts)
    prints = rng.integers(0, 256, (50, decontamination.BLOCKS)).astype(np.uint8)
    prints[:40] = index.prints[:40] ^ (np.packbits(rng.random((40, 128)) < 0.3, axis=1))
    got = set(zip(*(v.tolist() for v in index.candidates(12, prints))))
    apart = np.array([[bin(int.from_bytes((p ^ q).tobytes(), "big")).count("1") for q in index.prints] for p in prints])
    assert got == {(i, j) for i, j in zip(*np.nonzero(apart <= decontamination.RADIUS))} and got


def test_a_document_shorter_than_its_item_is_one_window(spark):
    item = PASSAGE.split()
    docs = spark.createDataFrame(
        [(1, " ".join(item[:-1])), (2, " ".join(item[2:-3])), (3, " ".join(item[1:])), (4, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, PASSAGE)], "item_id long, text string")
    n = len(item) - 4
    got = {(r.doc_id, r.window_start, r.window_words, round(r.similarity, 9)) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == {(1, 0, n + 3, round((n - 1) / n, 9)), (3, 0, n + 3, round((n - 1) / n, 9))}


def test_mixing_posteriors_are_calibrated_on_held_out_labels(spark):
    """Half of the rare documents tell their domain; the others look like common ones, and share their posterior."""
    rng = np.random.default_rng(8)
    rows, marks = [], []
    for i in range(2400):
        rare = i % 10 == 0
        words = [f"w{v}" for v in rng.integers(0, 300, 40)] + (["slur."] if rare and i % 20 == 0 else ["plain"])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(rare)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    names = ["clean", "low", "toxic"]
    got = calibrated.memberships(docs, mixing.own_labels(docs, labels), names).collect()
    told = [r.p for r in got if r.doc_id % 20 == 0]
    rest = [r.p for r in got if r.doc_id % 20]
    assert min(p[2] for p in told) > 0.95
    share = np.mean([p[2] for p in rest])
    assert abs(share - 120 / 2280) < 0.03 and all(p[1] == 0 and abs(sum(p) - 1) < 1e-9 for p in told + rest)
    none = calibrated.memberships(docs, mixing.own_labels(docs, labels.limit(0)), names).first()
    assert none.p == [1 / 3] * 3
    assert calibrated.memberships(docs.limit(0), mixing.own_labels(docs, labels), names).count() == 0
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9002, ""), (9003, "x")], "doc_id long, text string")
    rows = {r.doc_id: r for r in calibrated.memberships(docs.union(odd), mixing.own_labels(docs, labels), names).collect()}
    assert [(rows[i].tokens, rows[i].copies) for i in (9001, 9002, 9003)] == [(0, 1), (0, 2), (1, 1)]
