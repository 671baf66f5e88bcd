"""Quantile gradient boosting on binned histograms.

Rows are binned once. Each round grows one regression tree per quantile and fit on the negative
gradient of the pinball loss, level by level: a level is one job for all trees together, in which
every task counts its rows per (tree, node, input, code), the counts are summed by tree and node, and
only the best splits come to the driver. Leaf values, the residual quantiles of their rows, take one
more job from counted ranges of residuals. So the jobs of a round depend on the depth alone, not on the
number of quantiles, folds or candidates, and all of these share each scan.

Counts are whole numbers: a tree does not depend on how the rows are partitioned.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from salescast.functions.quantiles import monotone, unit_quantiles
from salescast.operators.binning import Binner, binned, packed, unpacked
from salescast.operators.forest import Forest, Tree, best_split, quantile_of, ranges_of
from salescast.schema import MODEL_COLS, q_names
from salescast.session import checkpointed

#: Version of the saved tables.
SCHEMA_VERSION = 2
#: Rows of one training task.
TASK_ROWS = 1 << 21
#: Partial results that may meet on the driver in a whole fit, in bytes, what a task gathers of them, and the most that
#: the ranges of one leaf take.
MEET_BYTES = 8 << 20
GATHER_BYTES = 32 << 20
RANGE_BYTES = 1 << 17
#: Rows that are walked through the trees at once.
BLOCK = 1 << 14
COUNTS = "tree int, node int, counts binary"
SPLITS = "tree int, node int, gain double, feature int, mask binary"
RANGES = "tree int, leaf int, ranges binary, times binary"
VALUES = "tree int, leaf int, value double"
NODES = "schema_version int, round int, quantile double, node int, feature int, mask binary, left int, right int, value double"


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 60
    learning_rate: float = 0.1
    max_leaves: int = 63
    max_depth: int = 6
    min_rows: int = 100
    bins: int = 64
    checkpoint_every: int = 5


class QuantileBoostModel:
    """Boosted trees of every quantile, with the binning of their inputs."""

    def __init__(self, quantiles, params: BoostParams, binner: Binner, start: dict[float, float],
                 rounds: list[dict[float, Tree]], losses: list[dict[float, float]], train_rows: int = 0):
        self.quantiles = sorted(quantiles)
        self.params = params
        self.binner = binner
        self.start = start
        self.rounds = rounds
        self.losses = losses
        self.train_rows = train_rows

    def scorer(self) -> "Scorer":
        """What a worker needs to score rows: one flat forest, quantile by quantile."""
        trees = [stages[q] for q in self.quantiles for stages in self.rounds]
        return Scorer(Forest(trees) if trees else None, len(self.rounds),
                      [self.start[q] for q in self.quantiles], self.params.learning_rate)

    def __call__(self, rows: DataFrame) -> DataFrame:
        """Rows with non-negative, ordered quantile columns; one evaluator, whatever the number of rounds."""
        return score_each(rows, {0: self}, F.lit(0))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """All nodes of all trees as rows."""
        rows = [
            (SCHEMA_VERSION, m, q, i, *node)
            for m, stages in enumerate(self.rounds) for q, t in stages.items()
            for i, node in enumerate(zip(t.feature, map(bytearray, t.mask), t.left, t.right, t.value))
        ]
        return spark.createDataFrame(rows, NODES)

    def save(self, path: str) -> None:
        """Three tables: settings, nodes of all trees, running means of the wide columns."""
        spark = SparkSession.active()
        meta = {
            "schema_version": SCHEMA_VERSION,
            "quantiles": self.quantiles,
            "params": asdict(self.params),
            "start": [self.start[q] for q in self.quantiles],
            "rounds": len(self.rounds),
            "edges": self.binner.edges,
            "categories": self.binner.categories,
            "train_rows": self.train_rows,
            "losses": [[loss[q] for q in self.quantiles] for loss in self.losses],
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        self.binner.means.write.mode("overwrite").parquet(f"{path}/means")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "QuantileBoostModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        if meta["schema_version"] != SCHEMA_VERSION:
            raise ValueError(f"{path}: saved as version {meta['schema_version']}, this code reads {SCHEMA_VERSION}")
        rounds: list[dict[float, Tree]] = [{} for _ in range(meta["rounds"])]
        # rounds x quantiles x 2 * max_leaves rows, bounded by the parameters of the fit
        for r in spark.read.schema(NODES).parquet(f"{path}/nodes").orderBy("round", "quantile", "node").collect():
            tree = rounds[r["round"]].setdefault(r["quantile"], Tree([], [], [], [], []))
            for kept, name in zip((tree.feature, tree.left, tree.right, tree.value), ("feature", "left", "right", "value")):
                kept.append(r[name])
            tree.mask.append(bytes(r["mask"]))
        binner = Binner(meta["edges"], meta["categories"], spark.read.parquet(f"{path}/means"))
        qs = meta["quantiles"]
        return cls(qs, BoostParams(**meta["params"]), binner, dict(zip(qs, meta["start"])), rounds,
                   [dict(zip(qs, loss)) for loss in meta["losses"]], meta["train_rows"])


@dataclass
class Scorer:
    forest: Forest | None
    rounds: int
    start: list[float]
    rate: float

    def score(self, bins: np.ndarray) -> np.ndarray:
        """(rows, quantiles) of raw forecasts."""
        out = np.tile(np.array(self.start), (len(bins), 1))
        for first in range(0, len(bins), BLOCK):
            part = bins[first : first + BLOCK]
            for i in range(len(self.start) * self.rounds):
                out[first : first + BLOCK, i // self.rounds] += self.rate * self.forest.gain(i, part)
        return out


def score_each(rows: DataFrame, models: dict[int, QuantileBoostModel], which: Column) -> DataFrame:
    """Every row scored by the model that ``which`` names, in one pass; models share quantiles and binning.

    A row that names no model gets NULL quantiles.
    """
    first = next(iter(models.values()))
    binner, names = first.binner.frozen(), q_names(first.quantiles)
    scorers = {key: m.scorer() for key, m in models.items()}

    @arrow_udf("array<double>")
    def forecast(key: pa.Array, *arrays: pa.Array) -> pa.Array:
        bins, keys = binner.codes(list(arrays)), key.to_numpy(zero_copy_only=False)
        out = np.full((len(keys), len(names)), np.nan)
        for k, scorer in scorers.items():
            own = keys == k
            if own.any():
                out[own] = scorer.score(bins[own])
        offsets = np.arange(len(keys) + 1, dtype=np.int32) * len(names)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel(), from_pandas=True))

    known = first.binner.with_means(rows)
    scored = known.withColumn("_raw", forecast(which, *[e for _, e in first.binner.inputs_of(known)]))
    scored = scored.select(*rows.columns, *[F.col("_raw")[i].alias(c) for i, c in enumerate(names)])
    return monotone(scored, first.quantiles)


# -- fitting ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Fit:
    """One model to fit: which rows train it (all when None), and how."""

    params: BoostParams
    rows: Column | None = None


class Boosting:
    """Several fits over one table, grown round by round together.

    ``table`` is a direct table; rows that train no fit ride along and can be scored between rounds.
    Cuts of the numbers and values of the categories come from the rows of ``shape``.
    """

    def __init__(self, table: DataFrame, quantiles, fits: dict[object, Fit], shape: Column | None = None):
        self.qs = sorted(quantiles)
        self.fits = dict(fits)
        self.keys = list(fits)
        any_params = next(iter(fits.values())).params
        needed = ["id", "origin", "target_day", "sales", *MODEL_COLS]
        table = table.select(*dict.fromkeys(needed)).persist(StorageLevel.MEMORY_AND_DISK)
        conditions: dict[int, Column] = {}
        self.member: dict[object, int] = {}
        for key, fit in fits.items():
            conditions.setdefault(id(fit.rows), fit.rows if fit.rows is not None else F.lit(True))
            self.member[key] = list(conditions).index(id(fit.rows))
        if len(conditions) > 63:
            raise ValueError("at most 63 different row sets can be fitted together")
        bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(conditions.values())]
        member = bits[0]
        for bit in bits[1:]:
            member = member + bit
        tagged = table.withColumn("member", member)
        sets = tagged.withColumn("set", F.explode(F.filter(
            F.array(*[F.lit(i) for i in range(len(conditions))]),
            lambda i: F.getbit(F.col("member"), i) == 1))).select("set", "sales")
        counts = {r["set"]: r["n"] for r in sets.groupBy("set").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(counts) < len(conditions):
            raise ValueError("the training table has no rows")
        begin = {r["set"]: [float(r[c]) for c in q_names(self.qs)] for r in unit_quantiles(sets, ["set"], self.qs).collect()}
        self.train_rows = {key: counts[self.member[key]] for key in self.keys}
        # One tree a round for each (fit, quantile), in this order.
        self.trees_of = [(key, q) for key in self.keys for q in self.qs]
        self.start = {(key, q): begin[self.member[key]][i] for key in self.keys for i, q in enumerate(self.qs)}
        mine = shape if shape is not None else fits[self.keys[0]].rows
        if any_params.bins > 254:
            raise ValueError("a code is one byte: at most 254 bins")
        self.binner = Binner.fit(table, any_params.bins, mine)
        start = packed(np.array([[self.start[at] for at in self.trees_of]])).to_pylist()[0]
        frame = binned(tagged, self.binner).select(
            F.col("sales").cast("double").alias("y"), "member", "bins", F.lit(bytearray(start)).alias("at"))
        spark = table.sparkSession
        self.tasks = max(spark.sparkContext.defaultParallelism, -(-sum(counts.values()) // TASK_ROWS))
        self.frame = checkpointed(frame.repartition(self.tasks)).persist(StorageLevel.MEMORY_AND_DISK)
        table.unpersist()
        self.every = any_params.checkpoint_every
        self.rounds: dict[object, list[dict[float, Tree]]] = {key: [] for key in self.keys}
        self.losses: dict[object, list[dict[float, float]]] = {key: [] for key in self.keys}
        #: Bytes of partial results that may still meet on the driver.
        self.to_driver = MEET_BYTES
        #: Trees that the frame's forecasts lack, round by round: place in ``trees_of`` -> tree.
        self.pending: list[dict[int, Tree]] = []

    def retake(self, key, params: BoostParams) -> None:
        """Other parameters for a fit that has no tree yet; bins and checkpoints stay those of the start."""
        if self.rounds[key]:
            raise ValueError(f"fit {key} has trees already")
        self.fits[key] = replace(self.fits[key], params=params)

    # What a task does to a batch before its own work.
    def _reader(self):
        rates = [self.fits[key].params.learning_rate for key, _ in self.trees_of]
        steps = [(i, t) for done in self.pending for i, t in done.items()]
        forest = Forest([t for _, t in steps]) if steps else None
        owners = [i for i, _ in steps]

        def read(batch: pa.RecordBatch):
            y = batch.column(0).to_numpy()
            member = batch.column(1).to_numpy()
            bins = unpacked(batch.column(2), np.uint8)
            at = unpacked(batch.column(3), np.float64).copy()
            for k, i in enumerate(owners):
                at[:, i] += rates[i] * forest.gain(k, bins)
            return y, member, bins, at

        return read

    def _histograms(self, grown: dict[int, Tree], nodes: dict[int, list[int]]):
        """The job of one level: partial counts per (tree, node) of each task."""
        read, width, inputs = self._reader(), self.binner.width, len(self.binner.names)
        places = list(grown)
        forest = Forest([grown[i] for i in places])
        bit = [self.member[self.trees_of[i][0]] for i in places]
        cells = inputs * width
        slots = []
        for k, i in enumerate(places):
            slot = np.full(len(forest.value), -1, np.int64)
            for s, node in enumerate(nodes[i]):
                slot[forest.root[k] + node] = s
            slots.append(slot)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(len(nodes[i]) * cells * 2, np.int64) for i in places]
            base = np.arange(inputs, dtype=np.int64) * width
            for batch in batches:
                y, member, bins, at = read(batch)
                flat = 2 * (base + bins)
                for k, i in enumerate(places):
                    slot = slots[k][forest.apply(k, bins)]
                    use = (slot >= 0) & ((member >> bit[k]) & 1 == 1)
                    # One count per node, input, code and side of the forecast.
                    place = slot * (2 * cells) + (y <= at[:, i])
                    cell = flat + place[:, None] if use.all() else flat[use] + place[use, None]
                    sums[k] += np.bincount(cell.ravel(), minlength=len(sums[k]))
            out = []
            for k, i in enumerate(places):
                sides = sums[k].reshape(len(nodes[i]), cells, 2)
                both = np.stack([sides.sum(2), sides[..., 1]], 2)  # rows, and rows at or under their forecast
                out += [(i, node, both[s]) for s, node in enumerate(nodes[i])]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()),
                pa.array([r[2].tobytes() for r in out], pa.binary())], names=["tree", "node", "counts"])

        return run

    def _chooser(self):
        """Sums the counts of each (tree, node) and finds its best split."""
        categories, width = self.binner.is_category(), self.binner.width
        qs = [q for _, q in self.trees_of]
        least = [self.fits[key].params.min_rows for key, _ in self.trees_of]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for tree, node, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    counts = np.frombuffer(counts, np.int64)
                    have = sums.get((tree, node))
                    sums[tree, node] = counts.copy() if have is None else np.add(have, counts, out=have)
            out = []
            for (tree, node), counts in sums.items():
                best = best_split(counts.reshape(len(categories), width, 2), qs[tree], categories, least[tree])
                if best:
                    out.append((tree, node, *best))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.binary()))],
                names=["tree", "node", "gain", "feature", "mask"])

        return run

    def _leaf_ranges(self, grown: dict[int, Tree]):
        """The last job of a round: counted residual ranges per (tree, leaf), and the loss before the step."""
        read, places = self._reader(), list(grown)
        forest = Forest([grown[i] for i in places])
        bit = [self.member[self.trees_of[i][0]] for i in places]
        qs = [self.trees_of[i][1] for i in places]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counted: list[dict[int, np.ndarray]] = [{} for _ in places]
            loss = np.zeros(len(places))
            found: list[list[np.ndarray]] = [[] for _ in places]
            for batch in batches:
                y, member, bins, at = read(batch)
                for k, i in enumerate(places):
                    use = np.flatnonzero((member >> bit[k]) & 1 == 1)
                    residual = y[use] - at[use, i]
                    loss[k] += np.maximum(qs[k] * residual, (qs[k] - 1) * residual).sum()
                    leaf = (forest.apply(k, bins[use]) - forest.root[k]).astype(np.int64)
                    found[k].append(np.stack(np.unique((leaf << 32) + ranges_of(residual) + (1 << 31), return_counts=True)))
            out = []
            for k, i in enumerate(places):
                both = np.concatenate(found[k], 1) if found[k] else np.empty((2, 0), np.int64)
                key, at = np.unique(both[0], return_inverse=True)
                times = np.bincount(at, both[1], len(key)).astype(np.int64)
                leaf = key >> 32
                for at_leaf in np.unique(leaf):
                    own = leaf == at_leaf
                    ranges = (key[own] & 0xFFFFFFFF) - (1 << 31)
                    out.append((i, int(at_leaf), ranges.astype(np.int64).tobytes(), times[own].tobytes()))
                out.append((i, -1, np.array([loss[k]]).tobytes(), b""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in out], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                names=["tree", "leaf", "ranges", "times"])

        return run

    def _leaf_values(self):
        """Residual quantile of each (tree, leaf); the loss stands at leaf -1."""
        qs = [q for _, q in self.trees_of]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met: dict[tuple[int, int], list] = {}
            for batch in batches:
                for tree, leaf, ranges, times in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    met.setdefault((tree, leaf), []).append((ranges, times))
            out = []
            for (tree, leaf), parts in met.items():
                if leaf < 0:
                    value = float(sum(np.frombuffer(p, np.float64)[0] for p, _ in parts))
                else:
                    at = np.frombuffer(b"".join(p for p, _ in parts), np.int64)
                    times = np.frombuffer(b"".join(t for _, t in parts), np.int64)
                    value = quantile_of(at, times, qs[tree])
                out.append((tree, leaf, value))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in out], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.float64()))],
                names=["tree", "leaf", "value"])

        return run

    def _met(self, partial, partial_schema: str, key: str, finish, schema: str, groups: int, group_bytes: int) -> list:
        """Partial results of every task, met by (tree, key) and finished; one row per group comes back.

        They meet in a shuffle. The first ones of a fit meet on the driver, which saves a stage, as long as all that
        came there stays under ``MEET_BYTES``: neither rounds nor tasks add to what the driver gets of a long fit. Elsewhere
        as few tasks as can hold the partial results gather them, as the end of every task is told to the driver.
        """
        parts = self.frame.mapInArrow(partial, partial_schema)
        most = self.tasks * groups * group_bytes
        if most <= self.to_driver:
            self.to_driver -= most
            return [r for batch in finish(iter(parts.toArrow().to_batches())) for r in batch.to_pylist()]
        gather = max(1, min(self.tasks, groups, -(-most // GATHER_BYTES)))
        return parts.repartition(gather, "tree", key).mapInArrow(finish, schema).collect()

    def round(self, keys: list | None = None) -> None:
        """One more tree for every quantile of the fits ``keys`` (all by default)."""
        active = [i for i, (key, _) in enumerate(self.trees_of) if keys is None or key in keys]
        grown = {i: Tree() for i in active}
        params = {i: self.fits[self.trees_of[i][0]].params for i in active}
        open_nodes = {i: [0] for i in active}
        cell_bytes = len(self.binner.names) * self.binner.width * 16
        level = 0
        while True:
            open_nodes = {i: n for i, n in open_nodes.items() if n and level < params[i].max_depth}
            if not open_nodes:
                break
            trees = {i: grown[i] for i in open_nodes}
            found = self._met(self._histograms(trees, open_nodes), COUNTS, "node", self._chooser(), SPLITS,
                              sum(map(len, open_nodes.values())), cell_bytes)
            best: dict[int, list] = {i: [] for i in open_nodes}
            for r in found:  # one row per open node
                best[r["tree"]].append((-r["gain"], r["node"], r["feature"], bytes(r["mask"])))
            open_nodes = {i: [] for i in open_nodes}
            for i, splits in best.items():
                room = params[i].max_leaves - len(grown[i].leaves)
                for _, node, feature, mask in sorted(splits)[:room]:
                    open_nodes[i] += grown[i].split(node, feature, mask)
            level += 1
        found = self._met(self._leaf_ranges(grown), RANGES, "leaf", self._leaf_values(), VALUES,
                          sum(len(t.leaves) for t in grown.values()), RANGE_BYTES)
        loss: dict[object, dict[float, float]] = {}
        for r in found:  # one row per leaf and tree
            key, q = self.trees_of[r["tree"]]
            if r["leaf"] < 0:
                loss.setdefault(key, {})[q] = r["value"] / self.train_rows[key]
            else:
                grown[r["tree"]].value[r["leaf"]] = r["value"]
        for key, each in loss.items():
            self.losses[key].append(each)
            self.rounds[key].append({})
        for i, tree in grown.items():
            key, q = self.trees_of[i]
            self.rounds[key][-1][q] = tree
        self.pending.append(grown)
        if len(self.pending) >= self.every:
            self._move()

    def _move(self) -> None:
        """Add the pending steps to the frame's forecasts and cut its lineage."""
        read = self._reader()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = read(batch)[3]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed(at)], names=["y", "member", "bins", "at"])

        old = self.frame
        self.frame = checkpointed(old.mapInArrow(run, "y double, member long, bins binary, at binary")).persist(StorageLevel.MEMORY_AND_DISK)
        self.pending = []
        old.unpersist()

    def held_out_wape(self, keys: list) -> dict[object, float | None]:
        """WAPE of each fit's median over the rows that train no fit, after the usual post-processing."""
        read, n, median = self._reader(), len(self.qs), self.qs.index(0.5)
        places = [self.keys.index(key) for key in keys]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            error, actual = np.zeros(len(places)), 0.0
            for batch in batches:
                y, member, _, at = read(batch)
                held = member == 0
                actual += np.abs(y[held]).sum()
                for k, place in enumerate(places):
                    own = np.sort(np.maximum(at[held, place * n : place * n + n], 0), axis=1)[:, median]
                    error[k] += np.abs(y[held] - own).sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), pa.array(error), pa.array(np.full(len(places), actual))], names=["place", "error", "actual"])

        sums = self.frame.mapInArrow(run, "place int, error double, actual double").groupBy("place").agg(
            F.sum("error").alias("error"), F.sum("actual").alias("actual")).collect()
        return {self.keys[r["place"]]: r["error"] / r["actual"] if r["actual"] else None for r in sums}

    def final_losses(self) -> None:
        """Append the loss after the last round of each fit."""
        read, qs, bit = self._reader(), [q for _, q in self.trees_of], [self.member[key] for key, _ in self.trees_of]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss = np.zeros(len(qs))
            for batch in batches:
                y, member, _, at = read(batch)
                for i, q in enumerate(qs):
                    use = (member >> bit[i]) & 1 == 1
                    residual = y[use] - at[use, i]
                    loss[i] += np.maximum(q * residual, (q - 1) * residual).sum()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(qs)), pa.int32()), pa.array(loss)], names=["tree", "loss"])

        for r in self.frame.mapInArrow(run, "tree int, loss double").groupBy("tree").agg(F.sum("loss").alias("loss")).collect():
            key, q = self.trees_of[r["tree"]]
            if len(self.losses[key]) == len(self.rounds[key]):
                self.losses[key].append({})
            self.losses[key][-1][q] = r["loss"] / self.train_rows[key]

    def model(self, key) -> QuantileBoostModel:
        start = {q: self.start[key, q] for q in self.qs}
        params = replace(self.fits[key].params, rounds=len(self.rounds[key]))
        return QuantileBoostModel(self.qs, params, self.binner, start, self.rounds[key], self.losses[key], self.train_rows[key])

    def close(self) -> None:
        self.frame.unpersist()


def fit_together(table: DataFrame, quantiles, fits: dict[object, Fit], shape: Column | None = None) -> dict[object, QuantileBoostModel]:
    """Several models over one table; the jobs of a round are those of one model."""
    boosting = Boosting(table, quantiles, fits, shape)
    for m in range(max(f.params.rounds for f in fits.values())):
        boosting.round([key for key, f in fits.items() if m < f.params.rounds])
    boosting.final_losses()
    boosting.close()
    return {key: boosting.model(key) for key in fits}


def fit_quantile_boost(table: DataFrame, quantiles, params: BoostParams = BoostParams()) -> QuantileBoostModel:
    """Fit one boosted model per quantile on a direct table (label: ``sales``)."""
    return fit_together(table, quantiles, {0: Fit(params)})[0]
