"""N-gram Jaccard self-join: rare-first prefix filtering, with length, positional and suffix filters.

Texts become sets of 5-word shingle hashes (64 bits); equal sets are one node, named by a 64-bit
signature of the set. Shingles are ordered from rare to common by a table of ``SLOTS`` counts (fixed
size, so it may be broadcast); any common order keeps the filters exact, rarity only makes them
sharp. Two sets with Jaccard >= 3/4 share a shingle among their first n - ceil(3n/4) + 1, so only
those prefixes meet, on the shingle. What two sets share before a shingle that both prefixes hold is in
both prefixes too, so the positional filter leaves out earlier shingles that no other prefix holds.

No list of a shingle is paired with itself as a whole. First every set of a list is compared with one
anchor of the list; verified links make components. Then, in a few turns, lists that still hold several
components get other anchors, and a few pairs of sets speak for each pair of components, so that stragglers
of a group find it without meeting all of it. Only what stays apart in the lists is joined as a whole, and only
sets of different components, so a group of near copies costs its size, not its square. There every entry carries
a bitmap of its set, the parity of its hashes at ``BITS`` places: two sets differ in at least so many hashes as
their bitmaps do in bits, so a list of sets that share a passage and little else makes hardly a pair. Each pair is
verified once, on whole sets, if it passes the suffix filter, whose ranges grow with the set: with a fixed number, large
sets that differ in half of their hashes passed. Sets in the same component need no further comparison, since the result is components.

A list's members are found where the shingle is dealt to; shingles whose count is over ``HOT`` are
shared for certain, so their entries are spread over tasks instead.

Defined results: a null, empty or wordless text has an empty set and is its own component; equal sets
are linked; repeated rows get the same result each; an empty table gives an empty result; extra
columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType

from salescast.llm.common import (
    DOC_COLS, components, distinct_in_rows, mix, partitions_for, pick, shingles, slices, stage, table, unstage,
)

WORDS = 5
SLOTS = 1 << 22
SLOT_BLOCK = 1 << 14
HOT = 1 << 16
#: Bits of the filter of wanted ids.
BLOOM = 1 << 23
#: Least and greatest number of hash ranges that the suffix filter compares; a set has about three ranges a hash.
RANGES = 256, 1 << 15
#: Bits of a set's bitmap, and its columns.
BITS = 256
MARKS = [f"mark{i}" for i in range(BITS // 64)]
PROFILE = ["doc_id", "n", "sig", "block", "counts", *MARKS]
#: Anchors of a list in a turn, and pairs of sets that speak for two components in each turn before what is left is joined.
ANCHORS = 16
SPEAKERS = (32,)
#: Prefix entries that one task gathers.
TASK_ENTRIES = 1_000_000


def need(n):
    """Smallest shared count that a partner of a set of ``n`` can have: ceil(3n / 4)."""
    return (3 * n + 3) // 4


def _sums(rows: int, d: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and wrapping sums of ``x`` by row; ``d`` is sorted."""
    n = np.bincount(d, minlength=rows)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=total[1:])
    end = np.cumsum(n)
    return n, total[end] - total[end - n]


def _sets(texts: pa.Array):
    """(first row, document of each shingle, sorted distinct hashes, sizes, signatures) by slices of a batch."""
    for row, data, offsets in slices(texts):
        d, h = distinct_in_rows(*shingles(data, offsets, WORDS))
        n, total = _sums(len(offsets) - 1, d, mix(h ^ np.uint64(0x5BD1E9955BD1E995)))
        yield row, d, h, n, mix(total ^ n.astype(np.uint64)).view(np.int64)


def _spread(n: np.ndarray, d: np.ndarray, h: np.ndarray) -> list[bytes]:
    """Whether the hashes of each set that fall into each range are odd in number; a set of ``n`` has 2n to 4n ranges.

    The numbers of ranges are powers of 2, so that the halves of a longer row make a shorter one.
    """
    ranges = (1 << np.ceil(np.log2(np.maximum(n, 1) * 2)).astype(np.int64)).clip(*RANGES)
    end = np.cumsum(ranges)
    at = (end - ranges)[d] + ((h >> np.uint64(40)).astype(np.int64) & (ranges[d] - 1))
    odd = np.packbits(np.bincount(at, minlength=int(ranges.sum())).astype(np.uint8) & 1).tobytes()
    return [odd[(e - r) // 8 : e // 8] for e, r in zip(end.tolist(), ranges.tolist())]


def _marks(rows: int, d: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Bitmap of each set, as rows of whole numbers: bit i is set if an odd number of hashes fall there."""
    at = d.astype(np.int64) * BITS + ((h >> np.uint64(40)) % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount(at, minlength=rows * BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).reshape(rows, len(MARKS))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        ids = batch.column(0)
        for row, d, h, n, sig in _sets(batch.column(1)):
            np.add.at(counts, (h & np.uint64(SLOTS - 1)).astype(np.int64), 1)
            k = len(n)
            yield pa.RecordBatch.from_arrays([
                ids.slice(row, k), pa.array(n, pa.int64()), pa.array(sig), pa.nulls(k, pa.int32()),
                pa.array(_spread(n, d, h), pa.binary()), *map(pa.array, _marks(k, d, h).T)],
                PROFILE)
    blocks = [i for i in range(SLOTS // SLOT_BLOCK) if counts[i * SLOT_BLOCK : (i + 1) * SLOT_BLOCK].any()]
    packed = [zlib.compress(counts[i * SLOT_BLOCK : (i + 1) * SLOT_BLOCK].tobytes(), 1) for i in blocks]
    none = pa.nulls(len(blocks), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, none, none, pa.array(blocks, pa.int32()), pa.array(packed, pa.binary()), *[none] * len(MARKS)], PROFILE)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            more = np.frombuffer(zlib.decompress(packed), np.int64)
            total[block] = total[block] + more if block in total else more
    yield pa.RecordBatch.from_arrays(
        [pa.array(total, pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["block", "counts"])


def slot_counts(profile: DataFrame) -> np.ndarray:
    """Occurrences by slot over all documents: ``SLOTS`` numbers."""
    packed = profile.where("block is not null").select("block", "counts")
    parts = min(SLOTS // SLOT_BLOCK, int(profile.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = np.zeros(SLOTS, np.int64)
    for r in packed.repartition(parts, "block").mapInArrow(_add, "block int, counts binary").collect():
        out[r.block * SLOT_BLOCK : (r.block + 1) * SLOT_BLOCK] = np.frombuffer(r.counts, np.int64)
    return out.clip(max=2**32 - 1).astype(np.uint32)


def _prefixes(shared):
    """Entries (shingle, sig, at) of the prefixes of each set, once a task for equal sets.

    ``at`` is n * 2**31 + pos, and -1 less that for a hot shingle, so that entries stay short.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        seen: set[int] = set()
        for batch in batches:
            for _, d, h, n, sig in _sets(batch.column(1)):
                count = slots[(h & np.uint64(SLOTS - 1)).astype(np.int64)]
                order = np.lexsort((h, count, d))
                start = np.cumsum(n) - n
                pos = np.arange(len(d)) - start[d]
                new = np.zeros(len(n), bool)
                for i, s in enumerate(sig.tolist()):
                    if n[i] and s not in seen:
                        seen.add(s)
                        new[i] = True
                keep = (pos < (n - need(n) + 1)[d]) & new[d]
                at = order[keep]
                packed = (n[d[keep]] << 31) + pos[keep]
                packed = np.where(count[at] > HOT, -1 - packed, packed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), pa.array(sig[d[keep]]), pa.array(packed)], ["shingle", "sig", "at"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct entries of the shingles that several sets hold (or that are hot) in this partition."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    sh, sig, at = (t[c].to_numpy() for c in ("shingle", "sig", "at"))
    order = np.lexsort((sig, sh))
    sh, sig, at = sh[order], sig[order], at[order]
    hot, at = at < 0, np.where(at < 0, -1 - at, at)
    first = np.ones(len(sh), bool)
    first[1:] = sh[1:] != sh[:-1]
    new = first.copy()
    new[1:] |= sig[1:] != sig[:-1]
    sets = np.add.reduceat(new, np.flatnonzero(first))[np.cumsum(first) - 1]
    keep = new & ((sets > 1) | hot)
    yield from pa.Table.from_arrays([
        pa.array(sh[keep]), pa.array(sig[keep]), pa.array(at[keep] >> 31, pa.int32()),
        pa.array(at[keep] & (2**31 - 1), pa.int32())], names=["shingle", "sig", "n", "pos"]).to_batches(50_000)


def _differ(a: pd.Series, b: pd.Series) -> np.ndarray:
    """In how many ranges the counts of two sets differ, at the number of ranges that both have."""
    out = np.zeros(len(a), np.int64)
    x, y = a.str.len().to_numpy(), b.str.len().to_numpy()
    for m, k in set(zip(x.tolist(), y.tolist())):
        at = np.flatnonzero((x == m) & (y == k))
        left = np.frombuffer(b"".join(a.iloc[at]), np.uint8).reshape(-1, m)
        right = np.frombuffer(b"".join(b.iloc[at]), np.uint8).reshape(-1, k)
        short = min(m, k)
        left, right = (np.bitwise_xor.reduce(z.reshape(len(at), -1, short), axis=1) for z in (left, right))
        out[at] = np.bitwise_count(left ^ right).sum(1, dtype=np.int64)
    return out


@pandas_udf(BooleanType())
def may_link(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
    """Suffix filter: sets of ``n`` hashes together differ at least as much as their odd counts by range do."""
    return pd.Series(7 * _differ(a, b) <= n.to_numpy(), dtype="bool")


@pandas_udf(BooleanType())
def verified(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two whole sets, as sorted hashes, are linked."""
    out = []
    for x, y in zip(a, b):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        out.append(7 * len(np.intersect1d(x, y, assume_unique=True)) >= 3 * (len(x) + len(y)))
    return pd.Series(out, dtype="bool")


def bloom(wanted: DataFrame) -> np.ndarray:
    """``BLOOM`` bits, set where a wanted id falls: a filter of fixed size that loses none. A null id counts as 0."""
    spots = wanted.select(F.pmod(F.coalesce("id", F.lit(0)), F.lit(BLOOM)).cast("int").alias("spot"))
    words = spots.selectExpr("spot div 32 AS word", "shiftleft(1L, spot % 32) AS bit")
    out = np.zeros(BLOOM // 32, np.uint32)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        out[r.word] = r.bits
    return out


def whole_sets(rows: DataFrame, members: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, hashes) of the wanted sets, each once, from the text of one of its rows; texts are not shuffled.

    Only texts whose id may be the least of a wanted set are made into sets again.
    """
    spark = rows.sparkSession
    holders = members.join(wanted.distinct(), "sig").groupBy("sig").agg(F.min("doc_id").alias("id"))
    spots = spark.sparkContext.broadcast(bloom(holders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            spot = pc.fill_null(batch.column(0), 0).to_numpy() % BLOOM
            hit = (spots.value[spot // 32] >> (spot % 32).astype(np.uint32)) & 1
            for _, _, h, n, sig in _sets(batch.column(1).filter(pa.array(hit > 0))):
                end, own = np.cumsum(n), []
                for i in np.flatnonzero(n > 0).tolist():
                    if int(sig[i]) not in seen:
                        seen.add(int(sig[i]))
                        own.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[own]), pa.array([h[end[i] - n[i] : end[i]].tobytes() for i in own], pa.binary())], ["sig", "hashes"])

    return rows.mapInArrow(run, "sig long, hashes binary").groupBy("sig").agg(F.first("hashes").alias("hashes"))


def _close(a: str, b: str):
    """Length and positional filter of two entries of one shingle; every entry of linked sets passes."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    p, q = F.col(f"{a}.pos"), F.col(f"{b}.pos")
    most = F.least(f"{a}.before", f"{b}.before") + F.least(n - p, m - q)
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * most >= 3 * (n + m))


def _alike(a: str, b: str):
    """Bitmap filter: the sets of two entries differ in at least so many hashes as their bitmaps do in bits."""
    differ = sum(F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in MARKS)
    return 7 * differ <= F.col(f"{a}.n") + F.col(f"{b}.n")


def need_col(n):
    return F.floor((3 * n + 3) / 4)


def by_component(nodes: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """``nodes`` with ``column`` replaced by its component in ``found``; a node without links is its own."""
    found = found.toDF("_node", "_component")
    return nodes.join(found, F.col(column) == F.col("_node"), "left").withColumn(
        column, F.coalesce("_component", column)).drop("_node", "_component")


def contracted_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) as :func:`components` finds them, from one edge a node first.

    A member of a group of near copies has links to many anchors. Its least one makes components; the other links
    are then few links between those.
    """
    now = stage(components(edges.groupBy("a").agg(F.min("b").alias("b")), name), f"{name}-first")
    return merged(now, stage(components(between(edges, now), name), f"{name}-top"))


def between(edges: DataFrame, now: DataFrame) -> DataFrame:
    """Links (a, b) of nodes as links of different components."""
    return by_component(by_component(edges, "a", now), "b", now).where("a <> b").distinct()


def merged(now: DataFrame, top: DataFrame) -> DataFrame:
    """(node, component) after the components of ``now`` were linked to those of ``top``."""
    alone = top.join(now.select("node"), "node", "left_anti")
    return by_component(now, "component", top).union(alone)


def open_lists(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of the lists that still hold several components once those of ``found`` are known."""
    placed = by_component(lists, "component", found)
    several = placed.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return placed.join(several.select("shingle"), "shingle")


def speakers(lists: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of sets, so many as ``SPEAKERS`` says for two components: members of a list with its anchors of this turn."""
    entry = F.struct(F.xxhash64("sig", F.lit(turn)).alias("order"), "sig", "n", "pos", "before", "component")
    anchors = lists.groupBy("shingle", F.pmod(F.xxhash64("sig", F.lit(turn)), F.lit(ANCHORS))).agg(
        F.min(entry).alias("t")).select("shingle", "t.*")
    near = lists.alias("l").join(anchors.alias("r"), "shingle").where(F.col("l.component") != F.col("r.component")).where(_close("l", "r"))
    place = F.xxhash64(F.col("l.sig"), F.col("r.sig"), F.lit(turn))
    pair = F.struct(place, F.col("l.sig").alias("a"), F.col("r.sig").alias("b"))
    return near.groupBy(
        F.least("l.component", "r.component").alias("c"), F.greatest("l.component", "r.component").alias("d"),
        F.pmod(place, F.lit(SPEAKERS[turn])).alias("slot"),
    ).agg(F.min(pair).alias("p")).select("p.a", "p.b")


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((doc_id, n, sig) of every row, (sig, component) by links to anchors, further links (a, b) of components)."""
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text")
    profile = stage(rows.mapInArrow(_profile,
        "doc_id long, n long, sig long, block int, counts binary, " + ", ".join(f"{c} long" for c in MARKS)), "ngram-profile")
    members = profile.where("block is null").select("doc_id", "n", "sig")
    entries = members.agg(F.sum(F.col("n") - need_col(F.col("n")) + 1)).first()[0] or 0
    shared = spark.sparkContext.broadcast(slot_counts(profile))
    parts = partitions_for(spark, entries, TASK_ENTRIES)
    prefix = rows.mapInArrow(_prefixes(shared), "shingle long, sig long, at long")
    spread = F.when(F.col("at") < 0, F.xxhash64("shingle", "sig")).otherwise(F.col("shingle"))
    lists = prefix.repartition(parts, spread).mapInArrow(_shared, "shingle long, sig long, n int, pos int")
    in_order = Window.partitionBy("sig").orderBy("pos")
    first_lists = stage(lists.withColumns({
        "before": F.row_number().over(in_order) - 1, "prev": F.lag("shingle").over(in_order)}), "ngram-lists")

    spreads = profile.where("n > 0").groupBy("sig").agg(F.first("n").alias("n"), F.first("counts").alias("spread"), *[F.first(c).alias(c) for c in MARKS])
    spreads = stage(spreads, "ngram-spreads")

    def verify(pairs: DataFrame) -> DataFrame:
        known = spreads.select("sig", "n", "spread")
        left, right = known.toDF("a", "n", "x"), known.toDF("b", "m", "y")
        pairs = pairs.join(left, "a").join(right, "b").where(may_link("x", "y", F.col("n") + F.col("m")))
        pairs = stage(pairs.select("a", "b"), "ngram-pairs")
        if pairs.isEmpty():
            return pairs
        whole = whole_sets(rows, members, pairs.select(F.explode(F.array("a", "b")).alias("sig")))
        left, right = whole.toDF("a", "x"), whole.toDF("b", "y")
        return stage(pairs.join(left, "a").join(right, "b").where(verified("x", "y")).select("a", "b"), "ngram-links")

    anchors = first_lists.groupBy("shingle").agg(F.min(F.struct("sig", "n", "pos", "before")).alias("t")).select("shingle", "t.*")
    star = first_lists.alias("l").join(anchors.alias("r"), "shingle").where(F.col("l.sig") != F.col("r.sig")).where(_close("l", "r"))
    # One candidate a set, the least anchor of its lists; what stays apart is left to the lists of several components.
    edges = verify(star.groupBy(F.col("l.sig").alias("a")).agg(F.min("r.sig").alias("b")))
    now = stage(contracted_components(edges, "ngram"), "ngram-components")
    lists = stage(open_lists(first_lists.withColumn("component", F.col("sig")), now), "ngram-open")
    unstage(spark, first_lists)
    for turn in range(len(SPEAKERS)):
        edges = between(verify(speakers(lists, turn).distinct()), now)
        if edges.isEmpty():
            break
        top = stage(components(edges, "ngram"), "ngram-top")
        now = stage(merged(now, top), "ngram-components")
        was, lists = lists, stage(open_lists(lists, top), "ngram-open")
        unstage(spark, was)
    # Two sets that also share the shingle before this one have met there.
    lists = lists.join(spreads.select("sig", *MARKS), "sig")
    cross = lists.alias("l").join(lists.alias("r"), "shingle").where(
        (F.col("l.component") < F.col("r.component")) & ~F.coalesce(F.col("l.prev") == F.col("r.prev"), F.lit(False))).where(_close("l", "r")).where(_alike("l", "r"))
    more = verify(cross.select(F.col("l.sig").alias("a"), F.col("r.sig").alias("b")).distinct())
    return members, now, between(more, now)


def placed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, n, sig, component) of every row of ``docs``."""
    members, now, more = links(docs)
    placed = by_component(members.withColumn("component", F.col("sig")), "component", now)
    return by_component(placed, "component", components(more, "ngram"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    placed = placed_rows(docs)
    least = placed.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    full = placed.where("n > 0").join(least, "component").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
    return full.union(placed.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of every group of linked documents; of repeated rows, one.

    Rows are named by id and text, so that an id with several texts loses only those that are near copies.
    """
    rows = pick(docs, *DOC_COLS).withColumn("_row", F.xxhash64("doc_id", "text"))
    placed = placed_rows(rows.select(F.col("_row").alias("doc_id"), "text")).where("n > 0")
    groups = placed.select(F.col("doc_id").alias("_row"), "component").distinct()
    groups = stage(groups.join(rows.select("_row", "doc_id").distinct(), "_row"), "ngram-groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    least = groups.groupBy("component").agg(F.min(order).alias("least"))
    drop = groups.join(least, "component").where(F.col("_row") != F.col("least._row")).select("_row")
    return rows.join(drop, "_row", "left_anti").dropDuplicates(["_row"]).select(*DOC_COLS)


def op6_ngram_join(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


_TR = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_SETS = rf"""
words AS (SELECT doc_id, list_filter(regexp_split_to_array({_TR}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
sh AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 7 * count(*) >= 3 * (a.n + b.n)),
sym AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a AS node, b AS other FROM sym UNION SELECT r.node, s.b FROM reach r JOIN sym s ON r.other = s.a),
least AS (SELECT node, min(other) AS other FROM reach GROUP BY node)
"""
ORACLE = f"""WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), {SQL_SETS}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id
FROM sets LEFT JOIN least ON node = doc_id"""
