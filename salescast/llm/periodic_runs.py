"""Runs of repeated words, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbour extends, at least four periods
and six words long. Every run ends in a square of two periods whose halves differ in the word behind
them: the suffixes at its two halves share exactly q words, so they lie in different children of one
LCP interval of depth q. For every interval all children but the largest are searched: a suffix i
whose partner i + q or i - q (looked up in the inverse suffix array) lies in the same interval is
such a square. Two more lookups, at i - q and i - 2q, prove the four periods. Squares that hold are
rotated left as far as the words allow, and those with one place merge into the run of the smallest
period. Intervals are index ranges; no tree is built.

A word of a run occurs at least four times in its document, in a stretch of six such words at
least; other words only part stretches. Texts are taken in slices of many documents, a long one
alone; symbols are per document, so nothing crosses documents. The work needs no shuffle.

Defined results: a null or empty text has no words and no runs (four nulls, hashes of the empty
string); a null id counts as the empty string; repeated rows are judged each; an empty table
gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salescast.llm.common import pick, table

#: Periods and words that a run has at least.
LEAST_PERIODS = 4
LEAST_WORDS = 6
#: Bytes of text whose suffixes are sorted at once (a longer text is taken alone).
SLICE = 1 << 20
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


# -- suffix array of many stretches -----------------------------------------------------------

def suffix_array(symbols: np.ndarray):
    """(suffix array, its inverse, common prefixes of neighbours) by prefix doubling.

    Only groups that are still equal are sorted again. Ranks of every doubling are kept, and the
    common prefixes are added up from them.
    """
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    new = np.ones(n, bool)
    new[1:] = symbols[sa[1:]] != symbols[sa[:-1]]
    rank = np.full(2 * n + 1, -1, np.int64)
    starts = np.flatnonzero(new)
    rank[sa] = np.repeat(starts, np.diff(np.append(starts, n)))
    levels = [rank[: n + 1].astype(np.int32)]
    k = 1
    while True:
        alone = new & np.append(new[1:], True)
        act = np.flatnonzero(~alone)
        if not len(act):
            break
        group = rank[sa[act]]
        key = group * (n + 1) + rank[np.minimum(sa[act] + k, 2 * n)] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        sa[act] = sa[act][order]
        split = np.ones(len(act), bool)
        split[1:] = key[1:] != key[:-1]
        new[act] |= split
        heads = np.flatnonzero(split)
        rank[sa[act]] = np.repeat(act[heads], np.diff(np.append(heads, len(act))))
        levels.append(rank[: n + 1].astype(np.int32))
        k *= 2
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    a, b = sa[:-1].copy(), sa[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        same = (levels[level][a] == levels[level][b]) & (a < n) & (b < n)
        step = same.astype(np.int64) << level
        lcp[1:] += step
        a, b = np.minimum(a + step, n), np.minimum(b + step, n)
    return sa, isa, lcp


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated first[i] .. first[i] + size[i] - 1."""
    total = int(size.sum())
    if not total:
        return np.empty(0, np.int64)
    at = np.cumsum(size) - size
    return np.arange(total) - np.repeat(at - first, size)


def intervals(lcp: np.ndarray, least: int):
    """Of every lcp entry in an interval of ``least`` suffixes: entry, depth, first and last rank, child's end."""
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return (at,) * 5
    n = len(lcp)
    gaps = np.diff(np.append(np.flatnonzero(lcp == 0), n))
    depth = max(1, int(gaps.max()).bit_length())
    lows = [lcp]
    for t in range(depth - 1):
        half = 1 << t
        if 2 * half > n:
            break
        lows.append(np.minimum(lows[-1][: n - 2 * half + 1], lows[-1][half : n - half + 1]))
    value = lcp[at]
    left, right, child = at.copy(), at + 1, at + 1
    for t in range(len(lows) - 1, -1, -1):
        low, step = lows[t], 1 << t
        place = np.maximum(left - step, 0)
        left = np.where((left >= step) & (low[np.minimum(place, len(low) - 1)] >= value), place, left)
        for bound, over in ((right, value), (child, value + 1)):
            fits = bound < len(low)
            fits &= low[np.minimum(bound, len(low) - 1)] >= over
            bound += fits * step
    big = right - left + 1 >= least
    return at[big], value[big], left[big] - 1, right[big] - 1, child[big] - 1


def branching_squares(symbols: np.ndarray, sa, isa, lcp):
    """(start, period) of each branching square that two more periods precede."""
    n = len(symbols)
    at, depth, first, last, end = intervals(lcp, LEAST_PERIODS)
    if not len(at):
        return at, at
    order = np.lexsort((at, last, first))
    at, depth, first, last, end = at[order], depth[order], first[order], last[order], end[order]
    new = np.ones(len(at), bool)
    new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    owner = np.cumsum(new) - 1
    # Children: one from each entry on, and one before the first entry of the interval.
    heads = np.flatnonzero(new)
    c_first = np.concatenate([at, first[heads]])
    c_size = np.concatenate([end - at + 1, at[heads] - first[heads]])
    c_owner = np.concatenate([owner, owner[heads]])
    order = np.lexsort((-c_size, c_owner))
    largest = np.ones(len(order), bool)
    largest[1:] = c_owner[order][1:] != c_owner[order][:-1]
    small = order[~largest]
    size = c_size[small]
    ranks = _ranges(c_first[small], size)
    of = np.repeat(heads[c_owner[small]], size)
    q, lo, hi = depth[of], first[of], last[of]
    i = sa[ranks]
    padded = np.append(symbols, -1)
    found = []
    for start, partner in ((i, i + q), (i - q, i - q)):
        ok = (partner >= 0) & (partner < n) & (start >= 2 * q)
        s, p, lo_, hi_ = start[ok], q[ok], lo[ok], hi[ok]
        inside = isa[partner[ok]]
        ok = (inside >= lo_) & (inside <= hi_) & (padded[s + p] != padded[np.minimum(s + 2 * p, n)])
        for back in (1, 2):
            r = isa[s - back * p]
            ok &= (r >= lo_) & (r <= hi_)
        found.append((s[ok], p[ok]))
    pairs = np.unique(np.stack([np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def rotated(symbols: np.ndarray, start: int, q: int, floor: int) -> int:
    """How far left the square at ``start`` rotates, not beyond ``floor``."""
    width = 64
    while start > floor:
        low = max(floor, start - width)
        odd = np.flatnonzero(symbols[low:start] != symbols[low + q : start + q])
        if len(odd):
            return low + int(odd[-1]) + 1
        start, width = low, width * 2
    return start


def _stretches(key: np.ndarray, least: int):
    """Words that may lie in a run: places in ``key`` whose symbol is frequent, in stretches long enough."""
    place = np.arange(len(key))
    while len(place):
        _, inverse, times = np.unique(key[place], return_inverse=True, return_counts=True)
        place = place[times[inverse] >= least]
        cut = np.flatnonzero(np.diff(place) != 1) + 1
        bounds = np.concatenate([[0], cut, [len(place)]]) if len(place) else np.zeros(1, int)
        size = np.diff(bounds)
        keep = np.repeat(size >= LEAST_WORDS, size)
        if keep.all():
            break
        place = place[keep]
    return place


def runs_of(key: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of a sequence in which equal numbers are equal words of one document."""
    place = _stretches(key, LEAST_PERIODS)
    if not len(place):
        return []
    # Stretches one behind another, each closed by a symbol of its own.
    stretch = np.zeros(len(place), np.int64)
    stretch[1:] = np.cumsum(np.diff(place) != 1)
    slot = np.arange(len(place)) + stretch
    size = len(place) + int(stretch[-1]) + 1
    symbols = np.full(size, -1, np.int64)
    symbols[slot] = key[place]
    closing = symbols < 0
    symbols[closing] = int(key.max()) + 1 + np.arange(int(closing.sum()))
    home = np.zeros(size + 1, np.int64)
    home[slot] = place
    floors = slot[np.append(0, np.flatnonzero(np.diff(stretch)) + 1)]
    starts, periods = branching_squares(symbols, *suffix_array(symbols))
    known: dict[int, list[tuple[int, int]]] = {}
    out = []
    for j in np.argsort(periods, kind="stable"):
        s, q = int(starts[j]), int(periods[j])
        end = s + 2 * q
        mine = known.setdefault(end, [])
        if any(q % p == 0 and begun <= s - 2 * q for begun, p in mine):
            continue
        floor = int(floors[np.searchsorted(floors, s, "right") - 1])
        begin = rotated(symbols, s - 2 * q, q, floor)
        if any(begun == begin for begun, _ in mine):
            continue
        mine.append((begin, q))
        if end - begin >= max(LEAST_WORDS, LEAST_PERIODS * q):
            first = int(home[begin])
            out.append((first, first + end - begin, q))
    return sorted(out)


# -- documents --------------------------------------------------------------------------------

def periodic_tail(words: int, doc_id) -> np.ndarray | None:
    """Source of each word where the id asks for a periodic tail, else None."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return None
    g = h // 10
    a = g % words
    p = 1 + (words - a) // (3 + g % 8)
    i = np.arange(words)
    return np.where(i >= a, a + (i - a) % p, i)


def _row(doc_id, words: list[bytes], runs: list[tuple[int, int, int]]):
    """Result of a document from its words and its runs (start, end, period) in order."""
    best = None
    lines = hashlib.sha256()
    keep = None
    for s, e, q in runs:
        lines.update(b"%d,%d,%d\n" % (s, e - s, q))
        if best is None or (e - s) * best[2] > (best[1] - best[0]) * q:
            best = (s, e, q)
        if keep is None:
            keep = np.ones(len(words), bool)
        keep[s + q : e] = False
    text = b" ".join(words if keep is None else [words[i] for i in np.flatnonzero(keep)])
    top = (None,) * 4 if best is None else (
        best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (doc_id, len(runs), *top, lines.hexdigest(), hashlib.sha256(text).hexdigest())


def judged(ids: list, texts: list, tail=periodic_tail) -> Iterator[tuple]:
    """Results of a slice of documents, whose words are searched together."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    split, codes = [], []
    for doc_id, text in zip(ids, texts):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        code = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        source = tail(len(words), doc_id) if tail else None
        if source is not None:
            words, code = [words[i] for i in source], code[source]
        split.append(words)
        codes.append(code)
    sizes = np.array([len(c) for c in codes], np.int64)
    doc = np.repeat(np.arange(len(codes)), sizes)
    key = doc * (len(number) + 1) + np.concatenate(codes) if len(codes) else np.empty(0, np.int64)
    before = np.concatenate([[0], np.cumsum(sizes)])
    mine: dict[int, list] = defaultdict(list)
    for s, e, q in runs_of(key):
        d = int(doc[s])
        mine[d].append((s - int(before[d]), e - int(before[d]), q))
    for d, (doc_id, words) in enumerate(zip(ids, split)):
        yield _row(doc_id, words, sorted(mine[d], key=lambda r: (r[0], r[1] - r[0], r[2])))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 6 + [pa.string()] * 2
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        sizes = np.cumsum(texts.fill_null("").cast(pa.large_binary()).to_pandas().str.len().to_numpy(dtype=np.int64))
        first = 0
        while first < len(ids):
            base = sizes[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(sizes, base + SLICE, "right")))
            rows = list(judged(ids[first:stop], texts.slice(first, stop - first).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            first = stop


def find_runs(docs: DataFrame) -> DataFrame:
    """Number of runs, the run of greatest exponent, and hashes of all runs and of the collapsed text, per row."""
    rows = pick(docs, "doc_id", "text").selectExpr("cast(doc_id AS long) AS doc_id", "text")
    return rows.mapInArrow(_search, SCHEMA)


def op12_periodic_runs(spark, sf_dir) -> DataFrame:
    return find_runs(table(spark, sf_dir, "documents"))
