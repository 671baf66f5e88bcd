"""The staged tables of one data folder: built once, written, and shared by all queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from salescast.operators.direct import last_day, origins_ending
from salescast.operators.features import build_features, series_table
from salescast.plans.backtest import backtest
from salescast.operators.forecast import group_priors, prior_forecaster, seasonal_naive_forecaster
from salescast.schema import Settings
from salescast.session import inputs_fingerprint, staged, staged_by_key, written_once
from salescast.sources import starschema

_last_days: dict[tuple[str, str], int] = {}
_first_days: dict[tuple[str, str], str] = {}


class SalesMart:
    """Sales, calendar, prices and features of ``sf_dir`` as written tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = Settings()):
        self.spark = spark
        self.sf_dir = sf_dir
        self.settings = settings
        paths = [f"{sf_dir}/{t}.parquet" for t in starschema.TABLES]
        self._mark = inputs_fingerprint(spark, paths)

    def _stage(self, name: str, build) -> DataFrame:
        return staged(self.spark, self._key(name), build)

    def _key(self, name: str) -> str:
        return f"{name}|{self.settings}|{self._mark}"

    def path(self, name: str, write) -> str:
        """Scratch path filled by ``write`` once for these inputs."""
        return written_once(self.spark, self._key(name), write)

    @cached_property
    def daily(self) -> DataFrame:
        return self._stage("daily", lambda: starschema.daily_sales(self.spark, self.sf_dir))

    @cached_property
    def sales(self) -> DataFrame:
        return self._stage("sales", lambda: starschema.sales_long(self.daily))

    @cached_property
    def calendar(self) -> DataFrame:
        return self._stage("calendar", lambda: starschema.calendar(self.daily))

    @cached_property
    def prices(self) -> DataFrame:
        return self._stage("prices", lambda: starschema.weekly_prices(self.daily))

    @cached_property
    def series(self) -> DataFrame:
        """One row per series with its identity."""
        return self._stage("series", lambda: series_table(self.sales))

    def build_features(self) -> DataFrame:
        return build_features(self.sales, self.calendar, self.prices, self.settings, self.series)

    @cached_property
    def features(self) -> DataFrame:
        """The feature table bucketed by series; its rows leave the feature windows that way."""
        return staged_by_key(self.spark, self._key("features"), self.build_features, "id", "d")

    @property
    def first_day(self) -> str:
        """Date of day 1, looked up once per application and inputs."""
        slot = (self.spark.sparkContext.applicationId, self._key("first"))
        if slot not in _first_days:
            _first_days[slot] = self.daily.agg({"date": "min"}).first()[0].isoformat()
        return _first_days[slot]

    @property
    def last(self) -> int:
        """Newest day of the features, looked up once per application and inputs."""
        slot = (self.spark.sparkContext.applicationId, self._key("last"))
        if slot not in _last_days:
            _last_days[slot] = last_day(self.features)
        return _last_days[slot]

    @property
    def origin(self) -> int:
        """Newest origin whose horizon is fully observed."""
        return self.last - self.settings.horizon

    @property
    def folds(self) -> list[int]:
        s = self.settings
        return origins_ending(self.last, s.n_folds, s.fold_stride, s.horizon)

    @property
    def origins(self) -> list[int]:
        s = self.settings
        return origins_ending(self.last, s.n_train_origins, s.origin_stride, s.horizon)

    def priors(self, origin: int) -> DataFrame:
        """Store-department quantiles before one origin."""
        s = self.settings
        return self._stage(f"priors-{origin}", lambda: group_priors(self.features, [origin], s.quantiles, s.prior_window))

    def _backtest(self, forecaster) -> DataFrame:
        s = self.settings
        return backtest(self.features, forecaster, self.folds, s.horizon, s.quantiles)

    @cached_property
    def prior_backtest(self) -> DataFrame:
        s = self.settings
        forecaster = prior_forecaster(self.features, self.folds, s.quantiles, s.prior_window)
        return self._stage("prior_backtest", lambda: self._backtest(forecaster))

    @cached_property
    def naive_backtest(self) -> DataFrame:
        forecaster = seasonal_naive_forecaster(self.features, self.folds, self.settings.quantiles)
        return self._stage("naive_backtest", lambda: self._backtest(forecaster))
