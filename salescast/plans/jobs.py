"""End-to-end jobs: train, evaluate, compare, tune, batch forecast and monitor."""

from __future__ import annotations

import math
import random
import time
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salescast.functions import metrics as M
from salescast.operators import direct as D
from salescast.operators import monitor as MO
from salescast.operators import panel as P
from salescast.operators import registry as RG
from salescast.operators.boosting import Boosting, BoostParams, Fit, QuantileBoostModel, fit_quantile_boost
from salescast.operators.forecast import Forecaster, catalogue, group_priors
from salescast.operators.reshape import cap_series, eligible_series, only_state
from salescast.operators.surrogate import next_points
from salescast.plans.backtest import boost_backtest
from salescast.schema import MEDIAN, Settings
from salescast.sources.archive import latest_archive, write_archive
from salescast.sources.export import save_panel
from salescast.sources.runs import write_run

# Bounds of the hyper-parameter search.
RATE_RANGE = (0.01, 0.1)
LEAF_RANGE = (31, 255)
ROW_RANGE = (20, 200)
# Draws among which the search looks for its next candidates, and candidates that are fitted at the same time.
POOL = 2048
PARALLEL = 2


def selected(features: DataFrame, settings: Settings) -> DataFrame:
    return cap_series(only_state(features, settings.state_filter), settings.max_series, settings.seed)


def fit_on(features: DataFrame, origins: list[int], settings: Settings, params: BoostParams) -> QuantileBoostModel:
    table = D.direct_table(features, origins, settings.horizon)
    return fit_quantile_boost(table, settings.quantiles, params)


def evaluate(
    spark: SparkSession, features: DataFrame, settings: Settings, params: BoostParams, out: str
) -> DataFrame:
    """Backtest, panel and headline; the predictions are written before they are scored."""
    chosen = selected(features, settings)
    folds = D.origins_ending(D.last_day(chosen), settings.n_folds, settings.fold_stride, settings.horizon)
    boost_backtest(chosen, folds, settings, params).write.mode("overwrite").parquet(f"{out}/predictions")
    preds = spark.read.parquet(f"{out}/predictions")
    panel = P.build_panel(preds, chosen, min(folds))
    save_panel(panel, f"{out}/panel")
    P.headline(panel).coalesce(1).write.mode("overwrite").json(f"{out}/headline")
    return spark.read.json(f"{out}/headline")


def train(
    spark: SparkSession, features: DataFrame, settings: Settings, params: BoostParams, out: str,
    registry: str | None = None,
) -> QuantileBoostModel:
    """Evaluate, fit the final model on the newest origins, save it, log the run, and register what passes the gate.

    ``registry`` is the folder of the registry's log (``<out>/registry`` by default). The version that
    was registered stands in the run; it is NULL where the backtest's WAPE is over the line.
    """
    head = evaluate(spark, features, settings, params, f"{out}/evaluation")
    chosen = selected(features, settings)
    origins = D.origins_ending(D.last_day(chosen), settings.n_train_origins, settings.origin_stride, settings.horizon)
    model = fit_on(chosen, origins, settings, params)
    model.save(f"{out}/model")
    wape = head.first()["wape_item_store"]
    version = RG.register(spark, registry or f"{out}/registry", origins[-1], wape)
    run = head.withColumns({
        "version": F.lit(version).cast("int"),
        "finished": F.current_timestamp(),
        "rounds": F.lit(params.rounds),
        "learning_rate": F.lit(params.learning_rate),
        "max_leaves": F.lit(params.max_leaves),
        "model_path": F.lit(f"{out}/model"),
        "train_rows": F.lit(model.train_rows),
        "n_series": F.lit(chosen.select("id").distinct().count()),
    })
    run.write.mode("append").parquet(f"{out}/runs")
    return model


def compare(
    spark: SparkSession, features: DataFrame, settings: Settings, models: dict[str, object],
    out: str, min_history: int,
) -> DataFrame:
    """Backtests on the same series: side-by-side levels, and what each cost.

    ``models`` maps a name to a function (features, folds) -> prediction frame. Cost columns, equal on
    all rows: wall-clock seconds of the fit and its written backtest, and the rows it wrote, which are
    observed while they are written.
    """
    rows = only_state(features, settings.state_filter)
    folds = D.origins_ending(D.last_day(rows), settings.n_folds, settings.fold_stride, settings.horizon)
    chosen = eligible_series(rows, min(folds), min_history, settings.max_series, settings.seed)
    shared = rows.join(chosen.select("id"), "id", "left_semi")
    preds, costs = {}, {}
    for name, run in models.items():
        begun, seen = time.perf_counter(), Observation(f"backtest of {name}")
        run(shared, folds).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/{name}")
        costs[f"seconds_{name}"] = F.lit(time.perf_counter() - begun)
        costs[f"rows_{name}"] = F.lit(seen.get["n"])
        preds[name] = spark.read.parquet(f"{out}/{name}")
    return P.compared(preds, P.history_before(shared, min(folds))).withColumns(costs)


def candidates(n: int, seed: int, base: BoostParams) -> list[BoostParams]:
    """Random draws from the search space: log-uniform rate, leaves, rows per leaf."""
    rng = random.Random(seed)
    low, high = map(math.log, RATE_RANGE)
    return [
        replace(
            base,
            learning_rate=math.exp(rng.uniform(low, high)),
            max_leaves=rng.randint(*LEAF_RANGE),
            min_rows=rng.randint(*ROW_RANGE),
        )
        for _ in range(n)
    ]


def tune(
    spark: SparkSession, features: DataFrame, origins: list[int], settings: Settings, tries: list[BoostParams],
    rungs: int = 3,
) -> DataFrame:
    """WAPE of every candidate on the newest origin, which no candidate has trained on.

    All candidates grow in the same jobs over one binned table, which also carries the held-out rows. At each
    rung, a half, a quarter, ... of the full rounds before the last, the worse half stops; ``rounds`` says how far
    a candidate came.
    """
    known, newest = D.holdout(origins)
    table = D.direct_table(features, [*known, newest], settings.horizon)
    rows = F.col("origin") != newest
    boosting = Boosting(table, settings.quantiles, {i: Fit(p, rows) for i, p in enumerate(tries)})
    full = max(p.rounds for p in tries)
    alive, done, wape, came = list(range(len(tries))), 0, {}, {}
    for stop in sorted({max(1, full >> k) for k in range(rungs)}):
        while done < stop:
            boosting.round(alive)
            done += 1
        wape |= boosting.held_out_wape(alive)
        came |= dict.fromkeys(alive, done)
        last = alive
        alive = sorted(alive, key=lambda i: (wape[i] is None, wape[i], i))[: -(-len(alive) // 2)]
    boosting.close()
    return _scored(spark, tries, came, wape, last)


def _scored(spark: SparkSession, tries: list[BoostParams], came: dict, wape: dict, last: list[int]) -> DataFrame:
    """One row per candidate; the best one is the least of ``last``."""
    best = min(last, key=lambda i: (wape[i] is None, wape[i], i))
    return spark.createDataFrame(
        [(i, p.learning_rate, p.max_leaves, p.min_rows, came[i], wape[i], i == best) for i, p in enumerate(tries)],
        "candidate int, learning_rate double, max_leaves int, min_rows int, rounds int, val_wape double, best boolean",
    )


def place(p: BoostParams) -> list[float]:
    """A candidate as a point of the unit cube; the rate on a logarithmic scale."""
    low, high = map(math.log, RATE_RANGE)
    return [(math.log(p.learning_rate) - low) / (high - low),
            *((v - a) / (b - a) for v, (a, b) in ((p.max_leaves, LEAF_RANGE), (p.min_rows, ROW_RANGE)))]


def proposals(tried: list[BoostParams], wapes: list[float | None], n: int, seed: int, base: BoostParams) -> list[BoostParams]:
    """The next ``n`` candidates: random draws at first, then those of many draws that promise most by the WAPEs so far."""
    # To nine digits: the sums of a WAPE have no fixed order.
    seen = [(place(p), round(w, 9)) for p, w in zip(tried, wapes) if w is not None]
    if not seen:
        return candidates(n, seed + len(tried), base)
    pool = candidates(POOL, seed + len(tried), base)
    x, y = (np.array(v) for v in zip(*seen))
    return [pool[i] for i in next_points(x, y, n, np.array([place(p) for p in pool]))]


def search(
    spark: SparkSession, features: DataFrame, origins: list[int], settings: Settings, base: BoostParams, n: int, seed: int,
    parallel: int = PARALLEL,
) -> DataFrame:
    """Bayesian search: WAPE of ``n`` candidates on the newest origin, which none has trained on.

    ``parallel`` candidates grow at a time, each through all rounds; their WAPEs decide what is tried next. Nothing
    stops early: a candidate has one score, that of its whole fit. The binned table is made once and also carries
    the held-out rows. Trees may grow as deep as their leaves need. ``features`` are taken whole.
    """
    known, newest = D.holdout(origins)
    table = D.direct_table(features, [*known, newest], settings.horizon)
    rows = F.col("origin") != newest
    boosting = Boosting(table, settings.quantiles, {i: Fit(base, rows) for i in range(n)})
    tried: list[BoostParams] = []
    wape: dict[int, float | None] = {}
    while len(tried) < n:
        now = list(range(len(tried), min(len(tried) + parallel, n)))
        tried += proposals(tried, [wape[i] for i in range(len(tried))], len(now), seed, base)
        for i in now:
            depth = (tried[i].max_leaves - 1).bit_length()
            boosting.retake(i, replace(tried[i], max_depth=max(base.max_depth, depth)))
        for _ in range(base.rounds):
            boosting.round(now)
        wape |= boosting.held_out_wape(now)
    boosting.close()
    return _scored(spark, tried, dict.fromkeys(range(n), base.rounds), wape, list(range(n)))


def run_batch(
    features: DataFrame, model: Forecaster, archive: str, run_date: str, model_name: str,
    model_version: str, settings: Settings = Settings(),
) -> None:
    """Forecast the catalogue from the newest fully observed origin and archive it."""
    origin = D.latest_origin(features, settings.horizon)
    forecasts = catalogue(
        features, model, origin, settings.horizon, settings.quantiles,
        settings.min_history, group_priors(features, [origin], settings.quantiles, settings.prior_window),
    )
    write_archive(forecasts, archive, run_date, model_name, model_version, settings.quantiles)


def run_monitoring(
    spark: SparkSession, features: DataFrame, archive: str, out: str, settings: Settings = Settings(), run: str | None = None,
) -> None:
    """Health, drift, error and headline tables of the newest archived batch, committed as one run.

    The run is named after the batch's run date unless it is given.
    """
    batch = latest_archive(spark, archive)
    last = D.last_day(features)
    write_run(spark, out, run or batch.agg(F.max("run_date")).first()[0], {
        "operational": MO.operational_summary(batch),
        "forecast_error": MO.score_forecasts(batch, features, settings.quantiles),
        "data_drift": MO.drift_table(features, last, settings.drift_window),
        "headline": MO.summary(batch, features, last, settings),
    })
