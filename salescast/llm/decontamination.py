"""Benchmark decontamination: SimHash of item-sized windows, found by multi-index Hamming search, then verified.

Words are runs of Unicode letters, marks and numbers, lower-cased; quotes, dashes and no-break spaces part
them like any punctuation. Scripts without spaces are parted by punctuation alone. Shingles are five words.
A benchmark item of L words meets every window of L words of a document (the whole document, if that is
shorter). Only windows with enough shingles that occur in any item at all can be similar to one, so running
counts of such shingles drop the others before they are hashed; which item it may be is not asked there.
Every window left gets a 128-bit SimHash of its shingles, weighted by how often each occurs. Hamming
search cuts fingerprints into 16 blocks of 8 bits: of two fingerprints within ``RADIUS`` some block
differs in at most RADIUS // 16 bits, so the tables from block value to the items of L words return all
items within the radius. They are the only source of candidates. Those within the radius are verified by
exact weighted-shingle similarity, sum of minima over sum of maxima, at least 0.75.

Items are taken in groups of ``GROUP``, which bounds what is broadcast; each group is one pass.

Defined results: a null text or one without words, and an item without words, match nothing; an item of
fewer than five words is one shingle of all its words and matches its exact sequence; repeated items are
matched each; repeated rows give repeated results; empty tables give an empty result; extra columns are
left out. Of several windows of a document for an item the most similar, then the first, is told.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import DOC_COLS, mix, pick, shingle_hashes, slices, table, word_hashes

WORDS = 5
BITS, BLOCKS = 128, 16
RADIUS = 44
THRESHOLD = 0.75
#: Items of one pass, at most.
GROUP = 20_000
RESULT = "doc_id long, item_id long, similarity double, window_start int, window_words int"

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, mark or number, and its lower case (if that has as many bytes)."""
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)]
    low = np.arange(0x110000, dtype=np.int32)
    for c, kind in enumerate(kinds):
        if kind in ("Lu", "Lt"):
            new = chr(c).lower()
            if len(new) == 1 and len(new.encode()) == len(chr(c).encode()):
                low[c] = ord(new)
    return np.array([kind[0] in "LMN" for kind in kinds]), low


def plain(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes in lower case, with spaces for all bytes of characters beyond ASCII that part words."""
    out = _LOWER[data]
    lead = np.flatnonzero(data >= 0xC0)
    size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
    for n, mark in ((2, 0xC0), (3, 0xE0), (4, 0xF0)):
        at = lead[size == n]
        if not len(at):
            continue
        code = data[at].astype(np.int32) & (0xFF >> (n + 1))
        for i in range(1, n):
            code = code << 6 | data[at + i] & 0x3F
        inside, low = _characters()
        put, parts = low[code], ~inside[code]
        for i in range(n - 1, -1, -1):
            out[at + i] = np.where(parts, 0x20, put & 0x3F | 0x80 if i else put | mark)
            put = put >> 6
    return out


def words_of(data: np.ndarray, offsets: np.ndarray):
    return word_hashes(plain(data), offsets, _INSIDE)


def _signs(h: np.ndarray) -> np.ndarray:
    """+1 and -1 of the ``BITS`` bits of each shingle, as int16."""
    wide = np.stack([h, mix(h ^ np.uint64(0xA0761D6478BD642F))], axis=1)
    bits = np.unpackbits(np.ascontiguousarray(wide).view(np.uint8).reshape(len(h), BITS // 8), axis=1)
    return bits.astype(np.int16) * 2 - 1


def fingerprints(h: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHash of the runs h[start : start + size], as rows of ``BLOCKS`` bytes.

    A shingle that occurs twice in a run is added twice: the weight is its count.
    """
    out = np.empty((len(starts), BLOCKS), np.uint8)
    for a in range(0, len(starts), 2048):
        s, n = starts[a : a + 2048], sizes[a : a + 2048]
        at = np.repeat(s - np.cumsum(n) + n, n) + np.arange(n.sum())
        total = np.add.reduceat(_signs(h[at]), np.cumsum(n) - n, axis=0)
        out[a : a + 2048] = np.packbits(total > 0, axis=1)
    return out


_BIT_COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Index:
    """Items of one group: their shingles, fingerprints and, by number of words, block tables."""

    def __init__(self, ids: list, texts: list):
        flat = pa.array(texts, pa.string())
        self.ids, words, parts = [], [], []
        for row, data, offsets in slices(flat):
            doc, w = words_of(data, offsets)
            for i in range(len(offsets) - 1):
                own = w[doc == i]
                if len(own):
                    self.ids.append(ids[row + i])
                    words.append(len(own))
                    parts.append(shingle_hashes(np.zeros(len(own), np.int64), own, min(WORDS, len(own)))[1])
        self.counts = [Counter(h.tolist()) for h in parts]
        self.sizes = np.array([len(h) for h in parts], np.int64)
        self.lengths = sorted(set(words))
        if not parts:
            return
        flat = np.concatenate(parts)
        self.known = np.unique(flat)
        self.mask = np.zeros(1 << 16, bool)
        self.mask[(self.known & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.prints = fingerprints(flat, np.cumsum(self.sizes) - self.sizes, self.sizes)
        # near[L][b][v]: items of L words whose block b differs from v in at most RADIUS // BLOCKS bits, as a bit row.
        value = np.arange(256, dtype=np.uint8)
        within = _BIT_COUNT[value[:, None] ^ value[None, :]] <= RADIUS // BLOCKS
        self.items = {n: np.flatnonzero(np.array(words) == n) for n in self.lengths}
        self.near = {n: [np.packbits(within[:, self.prints[own, b]], axis=1) for b in range(BLOCKS)]
                     for n, own in self.items.items()}

    def occurs(self, h: np.ndarray) -> np.ndarray:
        """Whether each shingle occurs in any item."""
        out = self.mask[(h & np.uint64(0xFFFF)).astype(np.int64)]
        maybe = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(self.known, h[maybe]), len(self.known) - 1)
        out[maybe] = self.known[at] == h[maybe]
        return out

    def candidates(self, length: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs that some block table of items of ``length`` words returns, within the radius."""
        near, own = self.near[length], self.items[length]
        found = near[0][prints[:, 0]]
        for b in range(1, BLOCKS):
            found |= near[b][prints[:, b]]
        window, item = np.nonzero(np.unpackbits(found, axis=1, count=len(own)))
        item = own[item]
        close = _BIT_COUNT[prints[window] ^ self.prints[item]].sum(1) <= RADIUS
        return window[close], item[close]


def _least(many, own):
    """Shingles that a window of ``many`` and an item of ``own`` share at least, if they are similar enough."""
    return np.ceil(THRESHOLD * (many + own) / (1 + THRESHOLD) - 1e-9).astype(np.int64)


def _windows(d: np.ndarray, hits: np.ndarray, own: int):
    """(first shingle, shingles) of the windows for items of ``own`` shingles that hold enough known ones.

    ``d`` is the document of each shingle, ``hits`` how many known shingles lie before each, and after all.
    """
    first = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
    count = np.diff(np.append(first, len(d)))
    short = count < own
    held = hits[first + count] - hits[first]
    short &= (count >= THRESHOLD * own) & (held >= _least(count, own))
    starts = np.flatnonzero((d[own - 1 :] == d[: len(d) - own + 1]) & (
        hits[own:] - hits[: len(hits) - own] >= _least(own, own))) if len(d) >= own else first[:0]
    return np.concatenate([starts, first[short]]), np.concatenate([np.full(len(starts), own), count[short]])


#: Windows that are hashed and looked up at once.
AT_ONCE = 2048


def _matches(index: Index, data: np.ndarray, offsets: np.ndarray):
    """(row, item, similarity, first word, words) of the verified windows of some documents."""
    doc, w = words_of(data, offsets)
    per_doc = np.bincount(doc, minlength=len(offsets) - 1)
    base = np.cumsum(per_doc) - per_doc
    shingled = 0
    for length in index.lengths:
        k = min(WORDS, length)
        if k != shingled:
            shingled = k
            d, h, at = shingle_hashes(doc, w, k)
            known = index.occurs(h)
            some = np.bincount(d[known], minlength=len(per_doc))[d] > 0
            d, h, at = d[some], h[some], at[some]
            hits = np.append(0, np.cumsum(known[some]))
        if not len(d):
            continue
        starts, many = _windows(d, hits, length - k + 1)
        for lo in range(0, len(starts), AT_ONCE):
            s, m = starts[lo : lo + AT_ONCE], many[lo : lo + AT_ONCE]
            for window, i in zip(*(v.tolist() for v in index.candidates(length, fingerprints(h, s, m)))):
                f, n, want = int(s[window]), int(m[window]), index.counts[i]
                have = Counter(h[f : f + n].tolist())
                both = sum(min(c, want[x]) for x, c in have.items() if x in want)
                similar = both / (n + int(index.sizes[i]) - both)
                if similar >= THRESHOLD:
                    row = int(d[f])
                    yield row, i, similar, int(at[f] - base[row]), n + k - 1


def _finder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            best: dict[tuple[int, int], tuple] = {}
            for first, data, offsets in slices(batch.column(1)):
                for r, i, similar, s, z in _matches(index, data, offsets):
                    key, new = (first + r, i), (similar, -s, z)
                    if new > best.get(key, (0,)):
                        best[key] = new
            out = [(ids[r], index.ids[i], v[0], -v[1], v[2]) for (r, i), v in best.items()]
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "item_id", "similarity", "window_start", "window_words"])

    return run


def _indexes(benchmark: DataFrame, group: int):
    """The items' indexes, at most about ``group`` items each, as broadcast variables."""
    items = pick(benchmark, "item_id", "text").where("text is not null")
    groups = -(-items.count() // group)
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(groups, 1))))
    for part in range(groups):
        own = dealt.where(F.col("part") == part).select("item_id", "text").collect()
        own.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        index = Index([r.item_id for r in own], [r.text for r in own])
        if index.lengths:
            yield benchmark.sparkSession.sparkContext.broadcast(index)


def contaminated(docs: DataFrame, benchmark: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, item_id, similarity, window_start, window_words): items found in documents."""
    rows = pick(docs, "doc_id", "text")
    found = docs.sparkSession.createDataFrame([], RESULT)
    for shared in _indexes(benchmark, group):
        found = found.union(rows.mapInArrow(_finder(shared), RESULT))
    return found


def _clean(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for first, data, offsets in slices(batch.column(1)):
                for r, *_ in _matches(index, data, offsets):
                    keep[first + r] = False
            yield batch.filter(pa.array(keep))

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, group: int = GROUP) -> DataFrame:
    """The documents in which no item is found, in one pass and without a shuffle."""
    out = pick(docs, *DOC_COLS)
    for shared in _indexes(benchmark, group):
        out = out.mapInArrow(_clean(shared), out.schema)
    return out


def op5_decontamination(spark, sf_dir) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
