"""Removal of repeated 50-byte strings by merging shard Burrows-Wheeler transforms.

A window is a 50-byte string of a document. The windows of a document that share the least hash of
their 20-byte strings (the anchor) and stand next to each other are one cell: equal windows have equal
anchors, so they can only meet in cells of the same anchor, and only those are brought together.

1. Cells are dealt by anchor as two hashes, without any text. Anchors that occur in one document only are let
   go. A cell whose content also stands in a document with a smaller doc_id is covered as a whole: its document is
   told so. What is left of an anchor is one cell of each content, that of the smallest doc_id; these are asked for
   only where the anchor has several contents.
2. Cells asked for are cut out of the texts.
3. They are cut into shards. Each shard's transform is built from its own suffixes; the transforms are merged by
   iterative interleave refinement: every round deals the interleave by the symbol in front, so after t rounds
   suffixes are ordered by t symbols, and a flag tells where neighbours differ in those. No suffix is sorted again.
   Five bytes make a symbol, so 10 rounds give the intervals with a common prefix of 50 bytes; a window is covered
   if its interval holds a smaller doc_id.
4. Covered byte ranges are joined back to the texts and cut out.

Of an anchor of more than ``HOT`` documents, each window of the cells asked for becomes a cell of its own,
dealt by a hash of its 50 bytes, so that only equal windows meet, once a run of texts.

Defined results: a null text counts as empty (0 bytes, the hash of nothing); texts under 50 bytes lose
nothing; repeated rows (equal doc_id) do not cover each other and get the same result each; rows with a
null doc_id cover nothing and are covered by nothing; an empty table gives an empty result; extra columns
are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import mix, partitions_for, pick, powers, prefix_sums, slices, stage, table

LENGTH, ANCHOR = 50, 20
#: Windows of a cell, at most; a longer run is cut.
CELL = 256
#: (anchor, document) rows and cells that one task gathers.
TASK_ANCHORS, TASK_CELLS = 2_000_000, 50_000
HOT = 50_000
#: Symbols of one merge, shards it is made of.
MERGE_SYMBOLS, SHARDS = 60_000, 4
CELLS = "h long, e long, doc_id long, rid long, start int, windows int, content binary, ranges binary"


def cells_of(data: np.ndarray, offsets: np.ndarray):
    """(row, first window, windows, anchor hash, content hash) of the cells of some documents."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    sums = prefix_sums(data)
    _, down = powers(len(data) + 1)
    least = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(data) - ANCHOR + 1])
    span, width = LENGTH - ANCHOR + 1, 1
    while width * 2 <= span:
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    if span > width:
        least = np.minimum(least[: -(span - width)], least[span - width :])
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = offsets[doc + 1] - np.arange(n) >= LENGTH
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
    edge = np.flatnonzero(new | ~inside)
    run = np.arange(n) - edge[np.cumsum(new | ~inside) - 1]
    new |= run % CELL == 0
    start = np.flatnonzero(new & inside)
    edge = np.append(np.flatnonzero(new | ~inside), n)
    stop = edge[np.searchsorted(edge, start, "right")]
    end = stop - 1 + LENGTH
    content = mix(((sums[end] - sums[start]) * down[start]) ^ (stop - start).astype(np.uint64))
    return doc[start], start, stop - start, least[start], content


def _low(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Task of an anchor and 32 further bits of it. Anchors that share both are told apart by their contents."""
    return (h % np.uint64(parts)).astype(np.int32), ((h // np.uint64(parts)) & np.uint64((1 << 32) - 1)).astype(np.uint32)


def _short(low: np.ndarray) -> np.ndarray:
    """5 bytes of each number, as rows."""
    return np.ascontiguousarray(low).view(np.uint8).reshape(-1, 8)[:, :5]


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def _name(e: np.ndarray) -> np.ndarray:
    """40 bits of a content."""
    return e & np.uint64((1 << 40) - 1)


def _anchors(parts: int):
    """Packed cells of a run of texts, one row a task that judges them.

    ``ids`` and ``counts`` tell the documents and how many different cells of each follow, ``lows`` and ``names``
    their anchors and contents. A document's ids are told as differences, which compress well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in slices(batch.column(1)):
                doc, _, _, h, e = cells_of(data, offsets)
                if not len(doc):
                    continue
                task, low = _low(h, parts)
                place = task.astype(np.int64) * len(offsets) + doc
                order = np.lexsort((e, place))
                place, low, e = place[order], low[order], e[order]
                new = np.ones(len(place), bool)  # equal contents have equal anchors
                new[1:] = (place[1:] != place[:-1]) | (e[1:] != e[:-1])
                place, low, name = place[new], low[new], _name(e[new])
                owner = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                count = np.diff(np.append(owner, len(place))).astype(np.int32)
                task, doc = np.divmod(place[owner], len(offsets))
                own = ids[row + doc]
                cut = np.append(np.flatnonzero(np.append(True, task[1:] != task[:-1])), len(task))
                edge = np.append(owner, len(place))[cut]
                short = _short(name)
                out: list[list] = [[], [], [], [], []]
                for a, b, i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), edge[:-1].tolist(), edge[1:].tolist()):
                    for column, x in zip(out, (
                            int(task[a]), press.compress(np.diff(own[a:b], prepend=np.int64(0)).tobytes()),
                            press.compress(count[a:b].tobytes()), low[i:j].tobytes(), short[i:j].tobytes())):
                        column.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])],
                    ["task", "ids", "counts", "lows", "names"])

    return run


#: What a document is told of a cell: its content is wanted, the same of a hot anchor, it is covered as a whole.
WANTED, SINGLE, COVERED = 0, 1, 2


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, task, names, kind) of the cells of this partition that a document is told of."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    tasks: dict[int, list[tuple]] = {}
    for batch in batches:
        for task, *rest in zip(*(batch.column(i).to_pylist() for i in range(5))):
            tasks.setdefault(task, []).append(rest)
    for task in list(tasks):
        rows = tasks.pop(task)
        doc = np.concatenate([np.repeat(np.cumsum(np.frombuffer(press.decompress(r), np.int64)),
                                        np.frombuffer(press.decompress(c), np.int32)) for r, c, _, _ in rows])
        low = np.concatenate([np.frombuffer(x, np.uint32) for _, _, x, _ in rows])
        name = np.concatenate([_long(x) for _, _, _, x in rows])
        order = np.lexsort((doc, name, low))
        doc, low, name = doc[order], low[order], name[order]
        first = np.ones(len(low), bool)
        first[1:] = low[1:] != low[:-1]
        lead = first.copy()
        lead[1:] |= name[1:] != name[:-1]
        new = lead.copy()
        new[1:] |= doc[1:] != doc[:-1]
        start, group = np.flatnonzero(first), np.cumsum(first) - 1
        contents = np.add.reduceat(lead, start)[group]
        documents = np.add.reduceat(new, start)[group]
        least = doc[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        covered = new & (doc > least)
        # One document with several contents compares with nothing.
        several = np.minimum.reduceat(doc, start)[group] != np.maximum.reduceat(doc, start)[group]
        wanted = lead & (contents > 1) & several
        kind = np.where(covered, COVERED, np.where(documents > HOT, SINGLE, WANTED)).astype(np.int8)
        keep = covered | wanted
        doc, name, kind = doc[keep], name[keep], kind[keep]
        order = np.lexsort((kind, doc))
        doc, name, kind = doc[order], name[order], kind[order]
        if not len(doc):
            continue
        cut = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (kind[1:] != kind[:-1])))
        raw, edge = _short(name).tobytes(), np.append(cut, len(doc)) * 5
        lists = [raw[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        for a in range(0, len(cut), 5000):
            at = cut[a : a + 5000]
            yield pa.RecordBatch.from_arrays([
                pa.array(doc[at]), pa.array(np.full(len(at), task, np.int32)),
                pa.array(lists[a : a + 5000], pa.binary()), pa.array(kind[at])], ["doc_id", "task", "names", "kind"])


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle; null stays null."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [None if t is None else press.compress(t.encode()) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "rid", "packed"])


def _texts(column: pa.Array) -> list[bytes]:
    import zstandard

    press = zstandard.ZstdDecompressor()
    return [b"" if p is None else press.decompress(p) for p in column.to_pylist()]


def _ranges(rid: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Per document its byte ranges, those that touch made one, as pairs of int32."""
    order = np.lexsort((b, a, rid))
    rid, a, b = rid[order], a[order], b[order]
    cut = np.append(np.flatnonzero(np.append(True, rid[1:] != rid[:-1])), len(rid)) if len(rid) else []
    for i, j in zip(cut[:-1], cut[1:]):
        reach = np.maximum.accumulate(b[i:j])
        new = np.append(True, a[i + 1 : j] > reach[:-1])
        low = a[i:j][new]
        high = reach[np.append(np.flatnonzero(new)[1:], j - i) - 1]
        yield int(rid[i]), np.stack([low, high], axis=1).astype(np.int32).tobytes()


_CELL_NAMES = ["h", "e", "doc_id", "rid", "start", "windows", "content", "ranges"]


def _range_batch(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    """Ranges that are settled already, in the form of cells, dealt by document."""
    rid = pa.array([r for r, _ in found], pa.int64())
    n, none = len(found), pa.nulls
    return pa.RecordBatch.from_arrays([
        rid, none(n, pa.int64()), none(n, pa.int64()), rid, none(n, pa.int32()), none(n, pa.int32()), none(n, pa.binary()),
        pa.array([r for _, r in found], pa.binary())], names=_CELL_NAMES)


def _told(asked: list, parts: int, cut: np.ndarray, task: np.ndarray, name: np.ndarray) -> np.ndarray:
    """What each cell's document was told of it, -1 for nothing; the cells of document i are cut[i] to cut[i + 1]."""
    out = np.full(len(name), -1, np.int8)
    key = (task.astype(np.uint64) << np.uint64(40)) | name
    for i, told in enumerate(asked):
        if not told:
            continue
        raw = [x["names"] for x in told]
        n = np.array([len(x) // 5 for x in raw])
        known = _long(b"".join(raw)) | np.repeat(np.array([x["task"] for x in told], np.uint64) << np.uint64(40), n)
        kind = np.repeat(np.array([x["kind"] for x in told], np.int8), n)
        order = np.argsort(known)
        known, kind = known[order], kind[order]
        own = key[cut[i] : cut[i + 1]]
        at = np.searchsorted(known, own)
        at[at == len(known)] = 0
        hit = known[at] == own
        out[cut[i] : cut[i + 1]][hit] = kind[at[hit]]
    return out


def _cut_cells(parts: int):
    """Cells asked for, with their content (further equal ones of the document as places), and the ranges of those
    that a smaller doc_id covers as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rids = batch.column(1).to_numpy(zero_copy_only=False)
            asked = batch.column(3).to_pylist()
            for row, data, offsets in slices(pa.array([t.decode() for t in _texts(batch.column(2))], pa.large_string())):
                doc, start, windows, h, e = cells_of(data, offsets)
                task, _ = _low(h, parts)
                cut = np.searchsorted(doc, np.arange(len(offsets)))
                kind = _told(asked[row : row + len(offsets) - 1], parts, cut, task, _name(e))
                done = kind == COVERED
                if done.any():
                    place = (start - offsets[doc])[done]
                    yield _range_batch(list(_ranges(rids[row + doc[done]], place, place + windows[done] - 1 + LENGTH)))
                keep = (kind == WANTED) | (kind == SINGLE)
                if not keep.any():
                    continue
                doc, start, windows, h, e, hot = (x[keep] for x in (doc, start, windows, h, e, kind == SINGLE))
                if hot.any():  # every window of a hot anchor becomes a cell of its own, named by its bytes
                    n = np.where(hot, windows, 1)
                    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    doc, start, windows, h, e, hot = (np.repeat(x, n) for x in (doc, start, windows, h, e, hot))
                    start = start + at
                    windows = np.where(hot, 1, windows)
                    sums, (_, down) = prefix_sums(data), powers(len(data) + 1)
                    own = (sums[start[hot] + LENGTH] - sums[start[hot]]) * down[start[hot]]
                    h[hot], e[hot] = mix(own), mix(own ^ np.uint64(0xA0761D6478BD642F))
                doc_id = ids[row + doc]
                order = np.lexsort((start, doc_id, e, h))
                doc, start, windows, h, e, doc_id = (x[order] for x in (doc, start, windows, h, e, doc_id))
                same = np.zeros(len(doc), bool)
                same[1:] = (h[1:] == h[:-1]) & (e[1:] == e[:-1])
                done = doc_id > doc_id[np.maximum.accumulate(np.where(same, 0, np.arange(len(doc))))]
                rid, place = rids[row + doc], start - offsets[doc]
                if done.any():
                    yield _range_batch(list(_ranges(rid[done], place[done], place[done] + windows[done] - 1 + LENGTH)))
                raw, left = data.tobytes(), np.flatnonzero(~done)
                content = [None if s else raw[a : a + w - 1 + LENGTH] for s, a, w in zip(
                    same[left].tolist(), start[left].tolist(), windows[left].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(h[left].view(np.int64)), pa.array(e[left].view(np.int64)), pa.array(doc_id[left]), pa.array(rid[left]),
                    pa.array(place[left], pa.int32()), pa.array(windows[left], pa.int32()), pa.array(content, pa.binary()),
                    pa.nulls(len(left), pa.binary())], _CELL_NAMES)

    return run


# -- Burrows-Wheeler transforms -----------------------------------------------------------------

def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of the suffixes of strings that each end in a terminator of their own, by prefix doubling."""
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    step, n = 1, len(text)
    order = np.argsort(rank)
    while True:
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = rank[order][1:] != rank[order][:-1]
        dense = np.empty(n, np.int64)
        dense[order] = np.cumsum(new)
        if dense[order[-1]] == n - 1:
            return order
        ahead = np.zeros(n, np.int64)
        ahead[:-step] = dense[step:] + 1
        rank = dense * (n + 1) + ahead
        order = np.argsort(rank)
        step *= 2


def transform(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol in front of each suffix, suffixes) in suffix order; a string's first suffix has 0 in front."""
    order = suffix_order(text, ends)
    front = np.zeros(len(text), text.dtype)
    front[1:] = text[:-1]
    front[0] = 0
    return front[order], order


def _by_symbol(front: np.ndarray) -> np.ndarray:
    """Stable order of symbols, dealt by 16 bits at a time."""
    if front.dtype.itemsize == 2:
        return np.argsort(front, kind="stable")
    order = np.argsort(front.astype(np.uint16), kind="stable")
    return order[np.argsort((front >> 16).astype(np.uint16)[order], kind="stable")]


def merge(shards: list[np.ndarray], strings: list[int], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes after ``rounds`` of refinement, and where neighbours differ
    in their first ``rounds`` symbols. Symbol 0 ends a string and is like no other."""
    symbols = np.concatenate(shards)
    home = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s) for s in shards])
    ends = np.repeat(np.arange(len(shards), dtype=np.uint8), strings)
    z = home
    differ = np.zeros(len(symbols), bool)
    differ[0] = True
    front = np.empty_like(symbols)
    for _ in range(rounds):
        front[np.argsort(z, kind="stable")] = symbols
        order = _by_symbol(front)
        block = np.cumsum(differ, dtype=np.int32)[order]
        lead = front[order]
        differ = np.ones(len(symbols), bool)
        differ[1:] = (block[1:] != block[:-1]) | (lead[1:] != lead[:-1])
        z = z[order]
        z[: len(ends)] = ends
        differ[: len(ends)] = True
    return z, differ


#: Bytes of a symbol. Rounds times this is ``LENGTH``.
WIDE = 5


def _symbols(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, string, place, first symbol of each sequence) of the ``WIDE`` sequences of symbols of each string, one
    for each phase, every one ended by 0. Byte 0 counts as 255, which never occurs in UTF-8."""
    size = np.array([len(c) for c in contents])
    data = np.frombuffer(b"".join(contents) + bytes(WIDE), np.uint8).astype(np.uint64)
    data[data == 0] = 255
    wide = np.zeros(len(data) - WIDE, np.uint64)
    for i in range(WIDE):
        wide = (wide << np.uint64(8)) | data[i : i + len(wide)]
    phase = np.tile(np.arange(WIDE), len(size))
    owner = np.repeat(np.arange(len(size)), WIDE)
    n = (size[owner] - phase) // WIDE + 1
    begin = np.cumsum(n) - n
    of = np.repeat(np.arange(len(n)), n)
    place = (np.arange(n.sum()) - begin[of]) * WIDE + phase[of]
    owner = owner[of]
    symbol = wide[np.minimum((np.cumsum(size) - size)[owner] + place, len(wide) - 1)]
    symbol[begin + n - 1] = 0
    return symbol, owner, place, begin


def covered_windows(contents: list[bytes], doc: np.ndarray) -> list[np.ndarray]:
    """For each string, whether each of its windows also starts in a string of a smaller ``doc``."""
    size = np.array([len(c) - LENGTH + 1 for c in contents])
    flags = np.zeros(size.sum(), bool)
    symbol, owner, place, begin = _symbols(contents)
    named, symbol = np.unique(symbol, return_inverse=True)  # 0 stays 0
    symbol = symbol.astype(np.uint16 if len(named) <= 1 << 16 else np.int32)
    shards, take, strings = [], [], []
    for part in np.array_split(np.arange(len(contents)), min(SHARDS, len(contents))):
        if not len(part):
            continue
        lo = begin[part[0] * WIDE]
        hi = begin[(part[-1] + 1) * WIDE] if part[-1] + 1 < len(contents) else len(symbol)
        own = begin[part[0] * WIDE + 1 : (part[-1] + 1) * WIDE] - 1 - lo
        front, order = transform(symbol[lo:hi], np.append(own, hi - lo - 1))
        shards.append(front)
        take.append(order + lo)
        strings.append(len(part) * WIDE)
    z, differ = merge(shards, strings, LENGTH // WIDE)
    at = np.empty(len(z), np.int64)
    at[np.argsort(z, kind="stable")] = np.concatenate(take)
    owner, place = owner[at], place[at]
    start = np.flatnonzero(differ)
    several = np.diff(np.append(start, len(z))) > 1
    least = np.minimum.reduceat(doc[owner], start)
    block = np.cumsum(differ) - 1
    hit = np.flatnonzero(several[block] & (least[block] < doc[owner]))
    flags[(np.cumsum(size) - size)[owner[hit]] + place[hit]] = True
    return np.split(flags, np.cumsum(size)[:-1])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered byte ranges (rid, ranges) of the cells of this partition, settled ones passed on."""
    got = []
    for b in batches:
        settled = b.column(7).is_valid()
        passed = b.filter(settled)
        if passed.num_rows:
            yield passed.select(["rid", "ranges"])
        b = b.filter(pc.invert(settled))
        if b.num_rows:
            got.append(b)
    if not got:
        return
    t = pa.Table.from_batches(got)
    h, e, doc, rid, start, windows = (t[c].to_numpy() for c in ("h", "e", "doc_id", "rid", "start", "windows"))
    held = ~t["content"].is_null().to_numpy()
    order = np.lexsort((~held, doc, e, h))
    h, e, doc, rid, start, windows = (x[order] for x in (h, e, doc, rid, start, windows))
    new_h = np.ones(len(h), bool)
    new_h[1:] = h[1:] != h[:-1]
    new = new_h.copy()
    new[1:] |= e[1:] != e[:-1]
    lead = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    whole = doc > doc[lead][group]
    ranges = [(rid[whole], start[whole], start[whole] + windows[whole] - 1 + LENGTH)]
    # Leads of the anchors with several contents, in groups that are merged together.
    several = np.add.reduceat(new, np.flatnonzero(new_h))[np.cumsum(new_h) - 1] > 1
    leads = lead[several[lead]]
    content = t["content"].combine_chunks().take(pa.array(order[leads])).to_pylist() if len(leads) else []
    # Cells of the lead's document with the same content share its answer.
    twins = np.flatnonzero(several & ~whole)
    by_group = np.searchsorted(group[twins], group[leads], "left"), np.searchsorted(group[twins], group[leads], "right")
    begin = 0
    while begin < len(leads):
        end, size = begin, 0
        while end < len(leads) and (size < MERGE_SYMBOLS or h[leads[end]] == h[leads[end - 1]]):
            size += len(content[end]) + 2
            end += 1
        flags = covered_windows(content[begin:end], doc[leads[begin:end]])
        size = np.array([len(f) for f in flags])
        edge = np.zeros(size.sum() + len(size), np.int8)  # a 0 behind each string
        string = np.repeat(np.arange(len(size)), size)
        edge[np.arange(size.sum()) + string] = np.concatenate(flags)
        step = np.diff(edge, prepend=np.int8(0))
        on, off = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        if len(on):
            first_of = np.cumsum(size) - size + np.arange(len(size))
            k = np.searchsorted(first_of, on, "right") - 1
            on, off = on - first_of[k], off - first_of[k]
            lo, hi = by_group[0][begin + k], by_group[1][begin + k]
            n = hi - lo
            twin = twins[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            ranges.append((rid[twin], start[twin] + np.repeat(on, n), start[twin] + np.repeat(off, n) - 1 + LENGTH))
        begin = end
    found = list(_ranges(*(np.concatenate(x) for x in zip(*ranges))))
    for i in range(0, len(found), 20_000):
        some = found[i : i + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in some], pa.int64()), pa.array([r for _, r in some], pa.binary())], ["rid", "ranges"])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, spans, digests = [], [], [], []
        for raw, ranges in zip(_texts(batch.column(1)), batch.column(2).to_pylist()):
            cut = np.frombuffer(b"".join(ranges or []), np.int32).reshape(-1, 2)
            kept, at = [], 0
            for _, runs in _ranges(np.zeros(len(cut), np.int64), cut[:, 0], cut[:, 1]):
                cut = np.frombuffer(runs, np.int32).reshape(-1, 2)
            for lo, hi in cut.tolist():
                kept.append(raw[at:lo])
                at = hi
            kept.append(raw[at:])
            left = b"".join(kept)
            sizes.append(len(raw))
            removed.append(len(raw) - len(left))
            spans.append(len(cut))
            digests.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``."""
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text").withColumn("rid", F.xxhash64("doc_id", "text"))
    texts = rows.where("doc_id is not null and text is not null").select("doc_id", "text")
    n = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = partitions_for(spark, n // 16, TASK_ANCHORS)
    anchors = texts.mapInArrow(_anchors(parts), "task int, ids binary, counts binary, lows binary, names binary")
    shared = stage(anchors.repartition(parts, "task").mapInArrow(
        _judge, "doc_id long, task int, names binary, kind byte"), "suffix-anchors")
    total = shared.where(F.col("kind") != COVERED).agg(F.sum(F.octet_length("names") / 5)).first()[0] or 0
    asked = shared.groupBy("doc_id").agg(F.collect_list(F.struct("task", "names", "kind")).alias("asked"))
    packed = rows.select("doc_id", "rid", "text").mapInArrow(_squeeze, "doc_id long, rid long, packed binary")
    cells = packed.join(asked, "doc_id").select("doc_id", "rid", "packed", "asked").mapInArrow(_cut_cells(parts), CELLS)
    found = cells.repartition(partitions_for(spark, int(total), TASK_CELLS), "h").mapInArrow(_compare, "rid long, ranges binary")
    ranges = stage(found, "suffix-ranges").groupBy("rid").agg(F.collect_list("ranges").alias("ranges"))
    return packed.join(ranges, "rid", "left").select("doc_id", "packed", "ranges").mapInArrow(
        _strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op3_suffix_dedup(spark, sf_dir) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
