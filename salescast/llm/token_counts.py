"""Token counts of whole texts, as the tokenizer library gives them.

Huge texts: overlapping chunks are encoded with offsets and spliced where both neighbours have a
boundary between pre-tokens. Such a boundary is proven stable: the splitter reads left to right and
what it does from a boundary on depends on the text from there on only, save the last ``MARGIN``
characters of a chunk, whose splits may still change. Where no common boundary lies in the overlap,
the overlap is widened (doubled) until one does; at the widest the right chunk begins at the last
proven boundary, which always succeeds.

Other texts: a run of white space always begins a pre-token, so a text is the sum of its units (a
space with the word behind it). Units that a worker has met are looked up, new ones are encoded in
one library call per batch; the memo is bounded. Special strings hold no white space, so they stay
whole inside a unit.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows are counted each;
an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salescast.llm.common import pick, table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Characters at a chunk's end whose splits are not proven: longer than the special string and any look-ahead.
MARGIN = 32
MEMO = 500_000

# Before a single space that follows a visible ASCII character or a Latin letter.
_UNITS = re.compile(r"(?<=[!-~À-ɏ])(?= )")
_loaded: dict = {}


def tokenizer(name: str):
    """The library's tokenizer, with untrimmed offsets; loaded once per worker."""
    if name not in _loaded:
        import public_tokenizers
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(public_tokenizers.path(name))
        out.no_truncation()
        out.no_padding()
        out.post_processor = None
        _loaded[name] = out
    return _loaded[name]


def _bounds(tok, text: str, start: int, stop: int):
    """Absolute place -> tokens before it, for each place where a pre-token begins; and all tokens."""
    enc = tok.encode(text[start:stop], add_special_tokens=False)
    places, last = {}, None
    for i, (word, (at, _)) in enumerate(zip(enc.word_ids, enc.offsets)):
        if word != last:
            places[start + at] = i
            last = word
    return places, len(enc.ids)


def count_huge(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text by overlap resynchronisation."""
    total, begin, widen = 0, 0, overlap
    stop = min(len(text), chunk)
    left, n_left = _bounds(tok, text, 0, stop)
    base = 0  # tokens of the left chunk before the proven place ``begin``
    while stop < len(text):
        start = max(begin, stop - widen)
        end = min(len(text), start + chunk + widen)
        right, n_right = _bounds(tok, text, start, end)
        common = [p for p in left if begin < p <= stop - MARGIN and p in right and (p > start or start == begin)]
        if common:
            p = max(common)
            total += left[p] - base
            left, n_left, base, begin, stop, widen = right, n_right, right[p], p, end, overlap
        elif start == begin:
            # The right chunk begins at a proven place and reaches further: it replaces the left one.
            left, n_left, base, stop, widen = right, n_right, 0, end, widen * 2
        else:
            widen *= 2
    return total + n_left - base


def _memo_counts(tok, memo: dict, texts: list[str]) -> list[int]:
    split = [_UNITS.split(t) for t in texts]
    new = list({u for units in split for u in units if u not in memo})
    for unit, enc in zip(new, tok.encode_batch_fast(new, add_special_tokens=False)):
        memo[unit] = len(enc)
    get = memo.__getitem__
    out = [sum(map(get, units)) for units in split]
    if len(memo) > MEMO:
        memo.clear()
    return out


def counter(name: str = TOKENIZER, chunk: int = CHUNK):
    """Column function: text -> number of tokens."""

    @pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok, memo = tokenizer(name), _loaded.setdefault(("memo", name), {})
        for texts in batches:
            texts = texts.fillna("")
            out = [0] * len(texts)
            for first in range(0, len(texts), 256):
                some = texts.iloc[first : first + 256].tolist()
                short = [i for i, t in enumerate(some) if len(t) <= chunk]
                for i, n in zip(short, _memo_counts(tok, memo, [some[i] for i in short])):
                    out[first + i] = n
                for i, t in enumerate(some):
                    if len(t) > chunk:
                        out[first + i] = count_huge(tok, t, chunk)
            yield pd.Series(out, dtype="int64")

    return n_tokens


def count_tokens(docs: DataFrame, limit: int = LIMIT, name: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``."""
    rows = pick(docs, "doc_id", "text")
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return rows.select("doc_id", n_bytes.alias("n_bytes"), counter(name)("text").alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark, sf_dir) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
