"""Alignment of two tokenizers over a corpus, each distinct text tokenised once.

Documents are shuffled by their full text, so that equal texts meet (copies are combined before the
shuffle) and each distinct text is tokenised and aligned once, with the number of documents that hold
it. Token bytes of both tokenizers cover a space and the text; places where tokens of both end cut
them into groups, and tokens whose byte ranges overlap are linked. Pair counts are sums of the
multiplicities over the distinct texts. The measures of a text are joined to its documents by a
SHA-256 of the text; where one text owns a third of the rows, the adaptive skew join splits them.

Inside a text the units of :mod:`token_counts` (a space with the word behind it) are aligned: the first
tokenizer always splits there, and the second cannot merge across, because none of its pieces holds a
space behind another character (checked when it is loaded). Units that a worker has met are looked
up in a bounded memo.

Defined results: a null or empty text, and one whose token bytes under either tokenizer differ from a
space and the text, has no tokens (zeros, empty hash) and adds to no count; a null id is kept; repeated
rows are documents each; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import pick, stage, table
from salescast.llm.token_counts import _UNITS as UNITS

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Characters of units that a worker remembers.
MEMO = 4_000_000
#: An id pair is one number: the first id times this, plus the second.
PAIR = 1 << 24
ALIGNED = ("text_id long, text_key binary, documents long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, links array<int>")
_loaded: dict = {}


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: visible ones as themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers and a memo of aligned units; one per worker."""

    def __init__(self, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B, memo: int = MEMO):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(name_a))
        self.a.no_truncation()
        self.a.no_padding()
        self.a.post_processor = None
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name_b))
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes_a[i] = bytes(map(letters.__getitem__, token))
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        if any(b" " in p.lstrip(b" ") for p in self.bytes_b):
            raise ValueError(f"{name_b}: a piece holds a space inside, units cannot be aligned on their own")
        # A lone space is the piece that the second tokenizer would add to a word, but it adds none to nothing.
        self.lone = [self.b.piece_to_id("▁")]
        self.limit = memo
        self._forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _forget(self):
        self.size = 0
        #: Unit -> first tokens, groups as text, id pairs of its links as bytes; None where bytes differ.
        self.memo: dict[str, tuple[int, str, bytes] | None] = {}

    def _learn(self, units: list[str]):
        """Align new units; a unit begins with a space, which the second tokenizer adds by itself."""
        first = self.a.encode_batch_fast(units, add_special_tokens=False)
        second = self.b.encode([u[1:] for u in units], num_threads=1)
        for unit, found, ids_b in zip(units, first, second):
            self.memo[unit] = self.aligned(unit.encode("utf-8", "surrogatepass"), found.ids, ids_b or self.lone)
        self.size += sum(map(len, units))

    def aligned(self, data: bytes, ids_a: list[int], ids_b: list[int]) -> tuple[int, str, bytes] | None:
        parts_a, parts_b = [self.bytes_a[i] for i in ids_a], [self.bytes_b[i] for i in ids_b]
        if b"".join(parts_a) != data or b"".join(parts_b) != data:
            return None
        # Walk both to the next end: each stretch between neighbouring ends is the overlap of one pair of tokens.
        pairs, text = [], []
        i = j = 0
        a, b = ids_a[0], ids_b[0]
        left, right = str(a), str(b)
        end_a, end_b = len(parts_a[0]), len(parts_b[0])
        while True:
            pairs.append(a * PAIR + b)
            if end_a == end_b:
                text.append(left + "|" + right)
                i, j = i + 1, j + 1
                if i == len(ids_a):
                    return i, ";".join(text), array("q", pairs).tobytes()
                a, b = ids_a[i], ids_b[j]
                left, right = str(a), str(b)
                end_a += len(parts_a[i])
                end_b += len(parts_b[j])
            elif end_a < end_b:
                i += 1
                a = ids_a[i]
                left += f",{a}"
                end_a += len(parts_a[i])
            else:
                j += 1
                b = ids_b[j]
                right += f",{b}"
                end_b += len(parts_b[j])

    def measure(self, texts: list[str]) -> Iterator[tuple]:
        """n_a, n_b, n_groups, n_links, hash of the groups, distinct pairs and their links of each text."""
        split = [UNITS.split(" " + t) if t else () for t in texts]
        if self.size > self.limit:
            self._forget()
        new = list({u for units in split for u in units if u not in self.memo})
        if new:
            self._learn(new)
        for units in split:
            known = [self.memo[u] for u in units]
            if not known or None in known:
                yield 0, 0, 0, 0, "", [], []
                continue
            n_a, groups, links = zip(*known)
            n_a, whole = sum(n_a), ";".join(groups)
            pairs, times = np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)
            # Every stretch but the last of a group has one end of its own.
            n_links, n_groups = int(times.sum()), whole.count(";") + 1
            yield (n_a, n_links + n_groups - n_a, n_groups, n_links, hashlib.sha256(whole.encode()).hexdigest(), pairs, times)


def aligner(name_a: str, name_b: str) -> Aligner:
    if (name_a, name_b) not in _loaded:
        _loaded[name_a, name_b] = Aligner(name_a, name_b)
    return _loaded[name_a, name_b]


def _align(name_a: str, name_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(name_a, name_b)
        types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                made = list(zip(*tool.measure(part.column(3).to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], *(pa.array(c, t) for c, t in zip(made, types))],
                    names=[c.split()[0] for c in ALIGNED.split(", ")])

    return run


def aligned_texts(docs: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """One row per distinct text: how many documents hold it, its measures, id pairs and their links."""
    texts = pick(docs, "doc_id", "text").where(F.length("text") > 0).groupBy("text").agg(
        F.count(F.lit(1)).alias("documents"))
    keyed = texts.select(F.monotonically_increasing_id().alias("text_id"), F.unhex(F.sha2("text", 256)).alias("text_key"), "documents", "text")
    return keyed.mapInArrow(_align(name_a, name_b), ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """id_a, id_b, how many documents hold the pair linked, and whether that is the first id's highest count."""
    counts = aligned.select("documents", F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.sum("documents").alias("n"))
    counts = counts.withColumn("id_a", F.shiftright("pair", 24))
    highest = counts.groupBy("id_a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "id_a").select(
        "pair", "id_a", F.col("pair").bitwiseAND(PAIR - 1).alias("id_b"), "n", (F.col("n") == F.col("highest")).alias("best"))


def align(docs: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """Measures of every row of ``docs``."""
    rows = pick(docs, "doc_id", "text")
    texts = stage(aligned_texts(docs, name_a, name_b), "aligned")
    counts = stage(pair_counts(texts), "pairs")
    linked = texts.select("text_id", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select(
        F.col("x.pairs").alias("pair"), F.col("x.links").alias("k"), "text_id")
    # Merged at every size, so that the plan at scale is the one that was measured.
    sums = linked.join(counts.select("pair", "n", "best").hint("merge"), "pair").groupBy("text_id").agg(
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("k") * F.col("n")).cast("long").alias("count_sum"))
    measures = texts.drop("documents", "pairs", "links").join(sums, "text_id", "left").drop("text_id")
    keyed = rows.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_key"))
    out = keyed.join(measures, "text_key", "left")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return out.select("doc_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
                      F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op13_token_alignment(spark, sf_dir) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
