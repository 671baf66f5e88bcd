"""Language identification by compression with raw-content dictionaries.

From a bounded sample of labelled documents each language gets ``DICTS`` zstandard dictionaries of raw
text. A lower-cased text is compressed in blocks of ``BLOCK`` bytes, so that the dictionary counts for all of a
long text, and the language with the smallest sum of sizes is chosen. ``rejected`` marks narrow
margins: the second language needs less than ``MARGIN`` more.

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; ties take
the first language in alphabetical order; without any labelled document all are ``und``; repeated rows
are answered each; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salescast.llm.common import first_of_each, mod_crc, pick, table

#: Labelled documents a language that the dictionaries are made of, at most.
SAMPLE = 200
DICTS = 1
DICT_BYTES = 1 << 16
PIECE = 512
#: Pieces of all dictionaries of a language.
PIECES = DICTS * DICT_BYTES // PIECE
BLOCK = 1 << 10
LEVEL = 6
MARGIN = 0.02

_coders: dict = {}


def dictionaries(pieces: list[bytes]) -> list[bytes]:
    """``DICTS`` dictionaries dealt from ``pieces`` of text."""
    return [b"\n".join(filter(None, pieces[k::DICTS])) or b"\n" * 16 for k in range(DICTS)]


def _mark(doc_id: int, at: int) -> int:
    return int.from_bytes(blake2b(f"{doc_id}:{at}".encode(), digest_size=7).digest())


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of lower-cased texts, at most ``PIECES`` a text: those of the least marks, from anywhere in it."""
    for pdf in batches:
        out = []
        for doc_id, lang, text in zip(pdf["doc_id"], pdf["lang"], pdf["text"]):
            raw = text.lower().encode("utf-8", "replace")
            marks = ((_mark(doc_id, i), i) for i in range(0, len(raw), PIECE))
            # An empty text has one empty piece, after all others.
            for mark, i in heapq.nsmallest(PIECES, marks) or [(1 << 56, 0)]:
                out.append((lang, mark, raw[i : i + PIECE]))
        yield pd.DataFrame(out, columns=["lang", "mark", "piece"])


def sample(docs: DataFrame, per_language: int = SAMPLE) -> dict[str, list[bytes]]:
    """Pieces of the first ``per_language`` training documents of each language, by hash of the id.

    Texts are cut where they lie; ``PIECES`` pieces a language reach the driver.
    """
    known = pick(docs, "doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (mod_crc("doc_id", 4) != 2))
    ids = first_of_each(known.select("doc_id", "lang").distinct(), "lang", ["doc_id"], per_language)
    # The sample is bounded: SAMPLE ids a language.
    cut = known.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", "text").mapInPandas(
        _pieces, "lang string, mark long, piece binary").distinct()
    order = Window.partitionBy("lang").orderBy("mark", "piece")
    rows = cut.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIECES).collect()
    out: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r["rank"])):
        out.setdefault(r.lang, []).append(bytes(r.piece))
    return out


def coders(key: tuple, dicts: dict[str, list[bytes]]):
    """Compressors with digested dictionaries, built once per worker."""
    if key not in _coders:
        import zstandard as z

        _coders.clear()
        made = []
        for lang in sorted(dicts):
            for raw in dicts[lang]:
                d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                made.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
        _coders[key] = made
    return _coders[key]


def sizes(text: str, made: list) -> np.ndarray:
    raw = text.lower().encode("utf-8", "replace")
    blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    return np.array([sum(len(c.compress(b)) for b in blocks) for c in made], float)


def identifier(dicts: dict[str, list[bytes]]):
    """Column function: text -> (lang_pred, score, margin)."""
    langs = sorted(dicts)
    key = (tuple(langs), hash(b"".join(b for k in langs for b in dicts[k])))

    @pandas_udf("lang_pred string, score double, margin double")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = coders(key, dicts)
        for texts in batches:
            out = []
            for t in texts:
                if t is None or not langs or not any(map(str.isalpha, t)):
                    out.append(("und", 0.0, 0.0))
                    continue
                by = sizes(t, made).reshape(len(langs), DICTS).sum(1)
                best = int(by.argmin())
                others = np.delete(by, best)
                margin = float(others.min() / by[best] - 1) if len(others) else 1.0
                odds = np.exp2(-np.minimum((by - by[best]) / DICTS, 60.0))
                out.append((langs[best], float(1 / odds.sum()), margin))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "margin"])

    return identify


def identify_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, margin, rejected) of every row of ``docs``."""
    dicts = {lang: dictionaries(pieces) for lang, pieces in sample(docs).items()}
    found = pick(docs, "doc_id", "text").select("doc_id", identifier(dicts)("text").alias("found"))
    return found.select(
        "doc_id", (mod_crc("doc_id", 4) == 2).alias("held_out"), "found.lang_pred", "found.score", "found.margin",
        (F.col("found.margin") < MARGIN).alias("rejected"))


def op8_language_id(spark, sf_dir) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))
