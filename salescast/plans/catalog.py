"""Every registered query, as a function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.functions import metrics as M
from salescast.functions.quantiles import monotone
from salescast.operators import bias, boosting, direct, drift, eda, features as FE, forecast, monitor, panel
from salescast.operators import registry, reshape, validate
from salescast.plans import backtest, exploration, jobs
from salescast.plans.mart import SalesMart
from salescast.schema import (
    CALENDAR_ATTRS, DYNAMIC_COLS, ID_COLS, LEVELS, MODEL_COLS, MONITORED_COLS, SALES_LONG_COLS, TARGET_COLS, q_name, q_names,
)
from salescast.sources import archive, export, runs, tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Parameters of single queries.
STATE = "ASIA"
SEED = 42
CAP = 50
LOAD_CAP = 20
ELIGIBLE_CAP = 120
ELIGIBLE_HISTORY = 84
COLD_ORIGIN = 42
HISTORY_DAYS = 365
ASOF_DAY = 400
ASOF_TIME = "2001-03-01T00:00:00Z"
SAMPLE_ROWS = 2000
AB_PERCENT = 20
MIN_ROWS = 100_000
MODEL_NAME = "store-department-prior"
FILL_COLS = ["sell_price", "price_rel_dept", "price_pct_change", "wday", "snap"]
# Boosting budgets of the registered fits: half the rounds for the backtest, which fits three folds at once, and
# fewer but larger trees for the search.
BOOST = boosting.BoostParams(rounds=60, learning_rate=0.1, max_leaves=16, max_depth=4, min_rows=50, checkpoint_every=10)
FOLD_BOOST = replace(BOOST, rounds=30)
SEARCH = boosting.BoostParams(rounds=12, max_depth=6, checkpoint_every=6)
CANDIDATES = 6


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison across engines."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema
    ])


def query(fn: Callable[[SalesMart], DataFrame]) -> Callable[[SalesMart], DataFrame]:
    """Register a function of the staged tables under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: rounded(fn(SalesMart(spark, sf_dir)))
    return fn


def day_string(m: SalesMart, d: int) -> str:
    return (date.fromisoformat(m.first_day) + timedelta(days=d - 1)).isoformat()


# -- features ---------------------------------------------------------------------------

@query
def features(m):
    return m.build_features()


@query
def sales_long(m):
    return m.sales.select(*SALES_LONG_COLS)


def wide_sales(m: SalesMart) -> DataFrame:
    """The raw layout of the sales table, written once like the other inputs."""
    path = m.path("wide", lambda p: reshape.to_wide(m.sales, m.calendar.count()).write.parquet(p))
    return m.spark.read.parquet(path)


@query
def melt_wide(m):
    return reshape.to_long(wide_sales(m))


@query
def calendar_snap(m):
    return FE.attach_calendar(m.sales.select("id", "state_id", "d", "sales"), m.calendar)


@query
def price_features(m):
    daily = FE.attach_calendar(m.sales, m.calendar, attrs=["wm_yr_wk"], snap=False)
    return FE.attach_prices(daily, m.prices, m.series).select(
        "id", "d", "sell_price", "price_pct_change", "price_rel_dept"
    )


@query
def lag_features(m):
    narrow = m.sales.select("id", "d", "sales")
    return FE.with_history(narrow, m.settings.lags, []).drop("sales")


@query
def rolling_features(m):
    narrow = m.sales.select("id", "d", "sales")
    return FE.with_history(narrow, [], m.settings.windows).drop("sales")


@query
def pre_release_drop(m):
    daily = FE.attach_calendar(m.sales, m.calendar, attrs=["wm_yr_wk"], snap=False)
    return reshape.listed_only(FE.attach_prices(daily, m.prices, m.series)).select("id", "d", "sales", "sell_price")


# -- sources and sinks --------------------------------------------------------------------

@query
def ingest_roundtrip(m):
    """Raw tables as CSV, converted to validated Parquet, and summed up from there."""
    def write(path: str) -> None:
        csv = f"{path}/csv"
        wide_sales(m).write.option("header", True).csv(f"{csv}/sales")
        m.calendar.write.option("header", True).csv(f"{csv}/calendar")
        m.prices.write.option("header", True).csv(f"{csv}/prices")
        tables.convert_csv(m.spark, f"{csv}/sales", f"{csv}/calendar", f"{csv}/prices", f"{path}/parquet")

    out = m.path("ingest", write) + "/parquet"
    sales = reshape.to_long(m.spark.read.parquet(f"{out}/sales"))
    calendar = m.spark.read.parquet(f"{out}/calendar")
    prices = m.spark.read.parquet(f"{out}/prices")

    def row(df, name, keys, total):
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct(*keys).alias("n_keys"),
            F.sum(total).alias("total"),
        )

    return (
        row(sales, "sales", ["id", "d"], F.col("sales").cast("long"))
        .unionByName(row(calendar, "calendar", ["date"], F.col("wm_yr_wk").cast("long")))
        .unionByName(row(prices, "prices", ["store_id", "item_id", "wm_yr_wk"], F.round(F.col("sell_price") * 100).cast("long")))
    )


def features_path(m: SalesMart) -> str:
    return m.path("features_out", lambda p: tables.write_features(m.features, p))


@query
def load_features(m):
    return tables.load_features(m.spark, features_path(m), STATE, LOAD_CAP, SEED)


def catalogue_at(m: SalesMart, origin: int) -> DataFrame:
    s = m.settings
    priors = m.priors(origin)
    model = forecast.from_priors(priors, s.quantiles)
    return forecast.catalogue(m.features, model, origin, s.horizon, s.quantiles, s.min_history, priors)


def archive_path(m: SalesMart) -> str:
    """Two archived batches; the newer one replaces an earlier batch of the same run date."""
    def write(path: str) -> None:
        oldest, middle, newest = m.folds
        for origin, run_day in [(oldest, newest), (middle, middle), (newest, newest)]:
            archive.write_archive(
                catalogue_at(m, origin), path, day_string(m, run_day), MODEL_NAME, f"o{origin}", m.settings.quantiles
            )

    return m.path("archive", write)


@query
def archive_roundtrip(m):
    return archive.read_archive(m.spark, archive_path(m))


def newest_batch(m: SalesMart) -> DataFrame:
    return archive.latest_archive(m.spark, archive_path(m))


@query
def latest_archive(m):
    return newest_batch(m).select("run_date", "model_version", "id", "origin", "horizon", "q50")


@query
def batch_inputs(m):
    return export.batch_inputs(m.features, m.origin, m.settings.horizon)


@query
def series_json(m):
    return export.series_json(m.sales, m.first_day, m.settings.horizon)


# -- filters, sampling, grids ---------------------------------------------------------------

@query
def cap_series(m):
    return reshape.cap_series(m.features.select("id", "d", "sales"), CAP, SEED)


@query
def filter_state(m):
    return reshape.only_state(m.features, STATE).select("id", "state_id", "d", "sales")


@query
def select_series(m):
    return reshape.eligible_series(m.features, min(m.folds), ELIGIBLE_HISTORY, ELIGIBLE_CAP, SEED)


@query
def contiguous_grid(m):
    """Days without sales are taken out first, so the grid has gaps to fill."""
    sold = m.features.where(F.col("sales") > 0)
    return reshape.contiguous(sold, m.last, FILL_COLS)


@query
def event_codes(m):
    coded = reshape.with_codes(
        m.features.select("id", "d", "event_name_1", "event_type_1"),
        ["event_name_1", "event_type_1"], ["event_name_code", "event_type_code"],
    )
    return coded.select("id", "d", "event_name_code", "event_type_code")


@query
def series_windows(m):
    coded = reshape.with_codes(m.features, ["event_name_1"], ["event_name_code"])
    covariates = ["wday", "month", "snap", "event_name_code", "sell_price", "price_rel_dept"]
    return reshape.history_windows(coded, m.origin, m.settings.horizon, HISTORY_DAYS, covariates)


@query
def feature_sample(m):
    return reshape.feature_sample(m.features, m.first_day, SAMPLE_ROWS).select(
        "record_id", "event_time", "id", "d", "sales", "lag_7", "sell_price"
    )


@query
def bias_frame(m):
    return reshape.label_frame(m.sales)


@query
def asof_features(m):
    return reshape.as_of(m.features, ASOF_DAY, ["sales", "lag_7", "rolling_mean_28", "sell_price"])


@query
def asof_top10(m):
    return reshape.newest_rows(m.features, ASOF_TIME, m.first_day, 10).select(
        "record_id", "event_time", "id", "d", "sales"
    )


# -- direct table ---------------------------------------------------------------------------

def newest_origin(m: SalesMart) -> DataFrame:
    """One row: the newest origin whose horizon is fully observed."""
    return m.features.agg((F.max("d") - m.settings.horizon).alias("newest"))


@query
def origins(m):
    s = m.settings
    grid = direct.origin_grid(F.col("newest"), s.n_train_origins, s.origin_stride)
    return newest_origin(m).select(F.explode(grid).alias("origin"))


@query
def fold_grid(m):
    s = m.settings
    folds = newest_origin(m).select(
        F.explode(direct.origin_grid(F.col("newest"), s.n_folds, s.fold_stride)).alias("fold_origin")
    )
    grid = direct.origin_grid(F.col("fold_origin") - s.horizon, s.n_train_origins, s.origin_stride)
    return folds.select("fold_origin", F.explode(grid).alias("train_origin"))


@query
def holdout_split(m):
    s = m.settings
    grid = direct.origin_grid(F.col("newest"), s.n_train_origins, s.origin_stride)
    return newest_origin(m).select("newest", F.explode(grid).alias("origin")).select(
        "origin", (F.col("origin") == F.col("newest")).alias("is_holdout")
    )


@query
def direct_table(m):
    return direct.direct_table(m.features, m.origins, m.settings.horizon)


# -- forecasts ------------------------------------------------------------------------------

def raw_quantiles(m: SalesMart) -> DataFrame:
    """Normal-theory quantiles from two rolling windows: some negative, some crossing."""
    raw = {
        "q05": F.col("rolling_mean_7") - 1.645 * F.col("rolling_std_7"),
        "q25": F.col("rolling_mean_28") - 0.674 * F.col("rolling_std_28"),
        "q50": F.col("rolling_mean_7"),
        "q75": F.col("rolling_mean_28") + 0.674 * F.col("rolling_std_28"),
        "q95": F.col("rolling_mean_7") + 1.645 * F.col("rolling_std_7"),
    }
    known = m.features.where(F.col("rolling_std_28").isNotNull())
    return known.select("id", "d", *[v.alias(k) for k, v in raw.items()])


@query
def monotone_quantiles(m):
    return monotone(raw_quantiles(m), m.settings.quantiles)


@query
def archive_gate(m):
    raw = raw_quantiles(m)
    qs = m.settings.quantiles
    parts = [("raw", raw), ("processed", monotone(raw, qs)), ("archive", newest_batch(m))]
    out = [forecast.gate_counts(df, qs).withColumn("batch", F.lit(name)) for name, df in parts]
    both = out[0].unionByName(out[1]).unionByName(out[2])
    return both.withColumn("accepted", (F.col("n_negative") == 0) & (F.col("n_crossing") == 0))


@query
def reassemble(m):
    predicted = newest_batch(m).select("id", "origin", "horizon", *q_names(m.settings.quantiles))
    meta = direct.direct_table(m.features, [m.origin], m.settings.horizon).select(
        *ID_COLS, "origin", "horizon", "target_day"
    )
    return forecast.reassemble_checked(predicted, meta, m.settings.quantiles)


@query
def cold_start_ids(m):
    return forecast.cold_series(m.features, COLD_ORIGIN, m.settings.min_history)


@query
def hierarchy_priors(m):
    s = m.settings
    return forecast.group_priors(m.features, [m.origin], s.quantiles, s.prior_window)


@query
def cold_start_forecasts(m):
    s = m.settings
    cold = forecast.cold_members(m.features, COLD_ORIGIN, s.min_history)
    return forecast.cold_forecasts(cold, m.priors(COLD_ORIGIN), COLD_ORIGIN, s.horizon, s.quantiles)


@query
def forecast_catalogue(m):
    return catalogue_at(m, COLD_ORIGIN)


# -- backtest and panel -----------------------------------------------------------------------

@query
def backtest_prior(m):
    return m.prior_backtest


@query
def fold_metrics(m):
    return panel.fold_metrics(m.prior_backtest, m.settings.quantiles)


def panel_of(m: SalesMart, preds: DataFrame) -> dict[str, DataFrame]:
    return panel.build_panel(preds, m.features, min(m.folds))


@query
def by_level(m):
    return panel.by_level(m.prior_backtest, panel.history_before(m.features, min(m.folds)))


@query
def by_horizon(m):
    return panel.by_horizon(m.prior_backtest)


@query
def calibration(m):
    return panel.calibration(m.prior_backtest)


@query
def panel_headline(m):
    return panel.headline(panel_of(m, m.prior_backtest))


@query
def dollar_weights(m):
    return panel.dollar_weights(panel.history_before(m.features, min(m.folds)))


@query
def compare_models(m):
    """Prior against seasonal-naive on the series both models forecast."""
    shared = m.naive_backtest.select("id").distinct()
    prior = m.prior_backtest.join(shared, "id", "left_semi")
    naive = m.naive_backtest.join(prior.select("id").distinct(), "id", "left_semi")
    history = panel.history_before(m.features.join(shared, "id", "left_semi"), min(m.folds))
    return panel.compared({"prior": prior, "naive": naive}, history)


@query
def metric_wape(m):
    return m.prior_backtest.groupBy("store_id").agg(M.wape("actual", "q50").alias("wape"))


@query
def metric_pinball(m):
    qs = m.settings.quantiles
    return m.prior_backtest.groupBy("store_id").agg(
        *[M.pinball("actual", q_name(q), q).alias(f"pinball_{q_name(q)}") for q in qs],
        M.mean_pinball("actual", qs).alias("mean_pinball"),
    )


@query
def metric_coverage(m):
    return m.prior_backtest.groupBy("store_id").agg(
        *M.interval_coverages("actual", m.prior_backtest.columns)
    )


def series_scales(m: SalesMart) -> DataFrame:
    return M.naive_scales(panel.history_before(m.features, min(m.folds)), ["id"])


@query
def metric_naive_scales(m):
    return series_scales(m)


@query
def metric_scaled(m):
    errors = m.prior_backtest.join(series_scales(m), "id")
    return errors.groupBy("id", "seasonal_mae", "naive_mse").agg(
        M.scaled_mae("actual", "q50", F.col("seasonal_mae")).alias("mase"),
        M.scaled_rmse("actual", "q50", F.col("naive_mse")).alias("rmsse"),
    ).select("id", "mase", "rmsse")


# -- monitoring -------------------------------------------------------------------------------

@query
def operational_summary(m):
    return monitor.operational_summary(newest_batch(m))


@query
def score_forecasts(m):
    return monitor.score_forecasts(newest_batch(m), m.features, m.settings.quantiles)


@query
def psi(m):
    reference, current = drift.drift_windows(m.features, m.last, m.settings.drift_window)
    return drift.psi(reference, current, "rolling_mean_28")


@query
def feature_drift(m):
    reference, current = drift.drift_windows(m.features, m.last, m.settings.drift_window)
    return drift.feature_drift(reference, current, MONITORED_COLS)


def headline_row(m: SalesMart) -> DataFrame:
    return monitor.summary(newest_batch(m), m.features, m.last, m.settings)


@query
def monitor_summary(m):
    return headline_row(m)


@query
def monitor_metrics_long(m):
    return monitor.metric_rows(headline_row(m))


@query
def retrain_trigger(m):
    return monitor.retrain_trigger(headline_row(m))


# -- validation and governance ------------------------------------------------------------------

@query
def dq_rules(m):
    return validate.quality_rules(m.features, MIN_ROWS)


@query
def validate_sales(m):
    return validate.sales_counts(wide_sales(m))


@query
def validate_calendar(m):
    return validate.calendar_counts(m.calendar)


@query
def validate_prices(m):
    return validate.price_counts(m.prices)


@query
def bias_metrics(m):
    return bias.bias_metrics(reshape.label_frame(m.sales), "state_id", STATE)


def registry_table(m: SalesMart) -> DataFrame:
    """One model version per backtest fold with its WAPE; the newest one awaits approval."""
    newest = max(m.folds)
    folds = panel.fold_metrics(m.prior_backtest, m.settings.quantiles)
    status = F.when(F.col("fold_origin") == newest, registry.PENDING).otherwise(registry.APPROVED)
    number = F.row_number().over(Window.orderBy("fold_origin"))
    return folds.select(
        number.alias("version"), F.col("fold_origin").alias("created"), status.alias("status"), "wape"
    )


@query
def registry_latest(m):
    return registry.newest_by_status(registry_table(m))


@query
def promote_decision(m):
    return registry.promote_decision(registry_table(m))


@query
def register_gate(m):
    """Which fold's model the gate lets into the registry: its WAPE against the line."""
    path = m.path("registry-gated", lambda p: fold_registry(m, p, registry.REGISTER_WAPE))
    folds = panel.fold_metrics(m.prior_backtest, m.settings.quantiles).select(F.col("fold_origin").alias("created"), "wape")
    return folds.join(registry.state(registry.events(m.spark, path)).select(F.col("created").cast("int").alias("created"), "status"), "created", "left").select(
        "created", "wape", F.col("status").isNotNull().alias("registered")
    )


def fold_registry(m: SalesMart, path: str, line: float | None) -> None:
    """A log with one version per backtest fold; all but the newest are approved as they come."""
    folds = panel.fold_metrics(m.prior_backtest, m.settings.quantiles).orderBy("fold_origin").collect()  # one row per fold
    for r in folds:
        version = registry.register(m.spark, path, r["fold_origin"], r["wape"], line)
        if version and r is not folds[-1]:
            registry.set_status(m.spark, path, version, registry.APPROVED)


def registry_log(m: SalesMart, name: str, *commands) -> DataFrame:
    """State of the folds' log after the commands."""
    def write(path: str) -> None:
        fold_registry(m, path, None)
        for command in commands:
            command(m.spark, path)

    log = registry.events(m.spark, m.path(name, write))
    return registry.state(log).select("version", F.col("created").cast("int").alias("created"), "status", "wape")


@query
def registry_flip(m):
    """The newest pending version approved or rejected by the promotion rule."""
    return registry_log(m, "registry-flip", registry.promote)


@query
def registry_rollback(m):
    """The newest approved version withdrawn."""
    return registry_log(m, "registry-rollback", registry.roll_back)


@query
def ab_split(m):
    newest = F.col("origin") == max(m.folds)
    cols = ["id", "origin", "horizon", "target_day", "q50"]
    return registry.ab_split(
        m.prior_backtest.where(newest).select(*cols), m.naive_backtest.where(newest).select(*cols), AB_PERCENT
    )


@query
def shadow_scores(m):
    """Both models on every series of the newest fold, scored side by side."""
    newest = F.col("origin") == max(m.folds)
    cols = ["id", "origin", "horizon", "target_day", "actual", "q50"]
    both = registry.shadow(
        m.prior_backtest.where(newest).select(*cols), m.naive_backtest.where(newest).select(*cols)
    )
    return both.groupBy("variant", "served").agg(
        F.count(F.lit(1)).alias("n"), M.wape("actual", "q50").alias("wape")
    )


# -- exploration --------------------------------------------------------------------------------

@query
def eda_scale(m):
    return eda.scale(m.sales)


@query
def eda_zero_share(m):
    return eda.zero_share(m.sales)


@query
def eda_units_state(m):
    return eda.units_by(m.sales, "state_id")


@query
def eda_units_store(m):
    return eda.units_by(m.sales, "store_id")


@query
def eda_units_cat(m):
    return eda.units_by(m.sales, "cat_id")


@query
def eda_units_dept(m):
    return eda.units_by(m.sales, "dept_id")


@query
def eda_top20(m):
    return eda.top_series(m.sales)


@query
def eda_cardinality(m):
    return eda.cardinalities(m.sales)


@query
def eda_zero_hist(m):
    return eda.zero_histogram(m.sales)


@query
def eda_daily_total(m):
    return eda.daily_total(m.sales, m.calendar)


@query
def eda_weekday_mean(m):
    return eda.weekday_mean(m.sales, m.calendar)


@query
def eda_snap_lift(m):
    return eda.snap_lift(m.sales, m.calendar, "SIZED", STATE)


@query
def eda_price_change(m):
    return eda.price_changes(m.prices)


def explored(name: str, **parameters):
    """Register one SQL statement as ``sql_<name>``."""
    def run(m: SalesMart) -> DataFrame:
        tables = {"sales": m.sales, "calendar": m.calendar.withColumn("day", F.substring_index("d", "_", -1).cast("int"))}
        return exploration.explore(m.spark, name, tables, **parameters)

    run.__name__ = f"sql_{name}"
    query(run)


for _name in exploration.STATEMENTS:
    explored(_name, top=20, state="")


@query
def calendar_export(m):
    return reshape.calendar_export(m.calendar.select("date", "d", "wm_yr_wk", "weekday", "wday", "month", "year"))


@query
def panel_artifacts(m):
    """The level table of an evaluation, read back from its committed run."""
    root = m.path("panel-runs", lambda p: runs.write_run(m.spark, p, "prior", panel_of(m, m.prior_backtest)))
    return runs.read_run(m.spark, root)["by_level"]


@query
def monitor_artifacts(m):
    """The error table of a monitoring run, read back from its committed run."""
    def write(path: str) -> None:
        jobs.run_monitoring(m.spark, m.features, archive_path(m), path, m.settings, run="newest")

    return runs.read_run(m.spark, m.path("monitor-runs", write))["forecast_error"]


# -- boosted model (rows-only: an iterative fit has no SQL twin) -----------------------------------

def boosted(m: SalesMart) -> boosting.QuantileBoostModel:
    """The model fitted on the newest origins, saved once and loaded by each query."""
    path = m.path("boost", lambda p: jobs.fit_on(m.features, m.origins, m.settings, BOOST).save(p))
    return boosting.QuantileBoostModel.load(m.spark, path)


@query
def train_gbt(m):
    """Pinball loss on the training table before every round and after the last."""
    model = boosted(m)
    rows = [
        (i, q, loss[q]) for i, loss in enumerate(model.losses) for q in model.quantiles
    ]
    return m.spark.createDataFrame(rows, "round int, quantile double, pinball double")


@query
def model_roundtrip(m):
    """A model loaded from disk, saved and loaded again: largest difference per quantile."""
    model = boosted(m)
    again = m.path("boost_again", model.save)
    reloaded = boosting.QuantileBoostModel.load(m.spark, again)
    rows = direct.direct_table(m.features, [m.origin], m.settings.horizon)
    names = q_names(m.settings.quantiles)
    key = ["id", "horizon"]
    first = model(rows).select(*key, *names)
    second = reloaded(rows).select(*key, *[F.col(c).alias(f"_{c}") for c in names])
    return first.join(second, key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.max(F.abs(F.col(c) - F.col(f"_{c}"))).alias(f"diff_{c}") for c in names],
    )


@query
def forecast_gbt(m):
    return forecast.forecast_origin(
        m.features, boosted(m), m.origin, m.settings.horizon, m.settings.quantiles
    )


@query
def gate_gbt(m):
    """Rows, negative rows and crossing rows of the boosted forecasts."""
    s = m.settings
    made = forecast.forecast_origin(m.features, boosted(m), m.origin, s.horizon, s.quantiles)
    return forecast.gate_counts(made, s.quantiles)


@query
def gbt_start_loss(m):
    """Loss of the constant start per quantile, and whether no later round is worse than the one before.

    Losses are sums of doubles in no fixed order, so they are compared to nine digits.
    """
    model = boosted(m)
    rows = [
        (q, model.losses[0][q], all(b[q] <= a[q] * (1 + 1e-9) for a, b in zip(model.losses, model.losses[1:])))
        for q in model.quantiles
    ]
    return m.spark.createDataFrame(rows, "quantile double, start_loss double, never_worse boolean")


@query
def train_gbt_checks(m):
    """Per quantile: rows of the fit, losses noted, and whether all trees keep to their leaves and the loss never rose."""
    model = boosted(m)
    rows = [(
        q, model.train_rows, len(model.losses), all(len(stage[q].leaves) <= BOOST.max_leaves for stage in model.rounds),
        all(b[q] <= a[q] * (1 + 1e-9) for a, b in zip(model.losses, model.losses[1:])),
    ) for q in model.quantiles]
    return m.spark.createDataFrame(rows, "quantile double, train_rows long, n_losses long, leaves_kept boolean, never_rose boolean")


@query
def forecast_gbt_checks(m):
    """Per horizon: series forecast, units that came, and rows that break the rules of a forecast."""
    qs, names = m.settings.quantiles, q_names(m.settings.quantiles)
    scored = boosted(m)(direct.direct_table(m.features, [m.origin], m.settings.horizon))
    holes = F.count_if(F.greatest(*[F.col(c).isNull().cast("int") for c in names]) > 0)
    return scored.groupBy("horizon").agg(
        *forecast.gate_columns(qs), F.countDistinct("id").alias("n_series"), holes.alias("n_null"),
        F.sum(F.col("sales").cast("long")).alias("units"),
    )


@query
def backtest_gbt_checks(m):
    """Per fold: rows, series, units that came, broken rows, and whether the boosted median beats the last season's."""
    wape = M.wape("actual", "q50").alias("wape")
    naive = m.naive_backtest.groupBy("origin").agg(wape.alias("naive_wape"))
    boosted_folds = boosted_backtest(m).groupBy("origin").agg(
        *forecast.gate_columns(m.settings.quantiles), F.countDistinct("id").alias("n_series"),
        F.sum(F.col("actual").cast("long")).alias("units"), wape,
    )
    return boosted_folds.join(naive, "origin").withColumn("beats_naive", F.col("wape") < F.col("naive_wape")).drop("wape", "naive_wape")


def boosted_backtest(m: SalesMart) -> DataFrame:
    path = m.path("boost_backtest", lambda p: backtest.boost_backtest(m.features, m.folds, m.settings, FOLD_BOOST).write.parquet(p))
    return m.spark.read.parquet(path)


@query
def backtest_gbt(m):
    return boosted_backtest(m)


def searched(m: SalesMart) -> DataFrame:
    tries = jobs.candidates(CANDIDATES, SEED, SEARCH)
    path = m.path("search", lambda p: jobs.tune(m.spark, m.features, m.origins, m.settings, tries).coalesce(1).write.parquet(p))
    return m.spark.read.parquet(path)


@query
def tune_holdout(m):
    """Six candidates of a Bayesian search, each fitted through all rounds."""
    path = m.path("bayes", lambda p: jobs.search(
        m.spark, m.features, m.origins, m.settings, SEARCH, CANDIDATES, SEED).coalesce(1).write.parquet(p))
    return m.spark.read.parquet(path)


@query
def tune_holdout_checks(m):
    """Candidates scored, how many came through all rounds, and whether the best one is the least of those."""
    full = F.col("rounds") == SEARCH.rounds
    return searched(m).agg(
        F.count(F.lit(1)).alias("n_candidates"), F.count("val_wape").alias("n_scored"), F.count_if(full).alias("n_full"),
        F.count_if("best").alias("n_best"),
        (F.min(F.when(F.col("best"), F.col("val_wape"))) == F.min(F.when(full, F.col("val_wape")))).alias("best_is_least"),
    )
