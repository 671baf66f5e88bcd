from dataclasses import replace
from types import SimpleNamespace

import numpy as np
import pytest
from conftest import COLD, SERIES, designed
from pyspark.sql import functions as F

from salescast.operators import direct as D
from salescast.operators import forest as FO
from salescast.operators import registry as RG
from salescast.operators.binning import Binner, binned, unpacked
from salescast.operators.boosting import Boosting, BoostParams, Fit, QuantileBoostModel, fit_quantile_boost, fit_together
from salescast.plans import jobs
from salescast.plans.backtest import boost_backtest, refit_backtest
from salescast.schema import MODEL_COLS, Settings, q_names

QS = (0.1, 0.5, 0.9)
PARAMS = BoostParams(rounds=4, learning_rate=0.5, max_depth=3, max_leaves=8, min_rows=2, bins=16, checkpoint_every=2)
KEY = ["id", "origin", "horizon"]


@pytest.fixture(scope="module")
def rows(spark):
    return designed(spark).persist()


@pytest.fixture(scope="module")
def table(rows):
    return D.direct_table(rows, [20, 34, 48], 5).persist()


@pytest.fixture(scope="module")
def model(table):
    return fit_quantile_boost(table, QS, PARAMS)


# -- the trees themselves ----------------------------------------------------------------------

def slow_split(bins, under, q, categories, min_rows):
    """Every cut of every input, row by row."""
    best = None
    for f in range(bins.shape[1]):
        codes = sorted(set(bins[:, f]))
        if categories[f]:
            codes.sort(key=lambda c: (under[bins[:, f] == c].mean(), c))
        for cut in range(1, len(codes)):
            left = np.isin(bins[:, f], codes[:cut])
            sides = [left, ~left]
            if min(s.sum() for s in sides) < min_rows:
                continue
            slope = np.where(under, q - 1, q)
            gain = sum(slope[s].sum() ** 2 / s.sum() for s in sides) - slope.sum() ** 2 / len(slope)
            if gain > 1e-9 * len(slope) and (best is None or gain > best[0] + 1e-9):
                best = (gain, f, set(codes[:cut]))
    return best


@pytest.mark.parametrize("seed", range(6))
def test_split_equals_trying_every_cut(seed):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 9, (300, 4)).astype(np.uint8)
    under = rng.random(300) < 0.2 + 0.06 * bins[:, seed % 4]
    categories = np.array([False, True, False, True])
    counts = np.zeros((4, 12, 2), np.int64)
    for f in range(4):
        counts[f, :, 0] = np.bincount(bins[:, f], minlength=12)
        counts[f, :, 1] = np.bincount(bins[under, f], minlength=12)
    for q in (0.05, 0.5, 0.9):
        gain, feature, mask = FO.best_split(counts, q, categories, 5)
        want = slow_split(bins, under, q, categories, 5)
        goes = np.unpackbits(np.frombuffer(mask, np.uint8), bitorder="little")[bins[:, feature]] == 1
        assert gain == pytest.approx(want[0])
        assert feature == want[1] and set(bins[goes, feature]) == want[2]
    assert FO.best_split(counts, 0.5, categories, 200) is None


def test_forest_walks_like_a_loop():
    rng = np.random.default_rng(3)
    trees = []
    for _ in range(5):
        tree = FO.Tree()
        for _ in range(int(rng.integers(0, 6))):
            leaf = int(rng.choice(tree.leaves))
            tree.split(leaf, int(rng.integers(0, 3)), FO.mask_of(rng.choice(20, 7, replace=False)))
        tree.value = list(rng.normal(size=len(tree.value)))
        trees.append(tree)
    bins = rng.integers(0, 20, (200, 3)).astype(np.uint8)
    forest = FO.Forest(trees)
    for t, tree in enumerate(trees):
        for row, got in zip(bins, forest.gain(t, bins)):
            node = 0
            while tree.feature[node] != FO.LEAF:
                code = int(row[tree.feature[node]])
                node = tree.left[node] if tree.mask[node][code >> 3] >> (code & 7) & 1 else tree.right[node]
            assert got == tree.value[node]


def test_counted_ranges_give_the_quantile():
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 50, 4000), np.zeros(100), rng.normal(0, 1e-3, 500)])
    at, times = np.unique(FO.ranges_of(values), return_counts=True)
    for q in (0.01, 0.3, 0.5, 0.97):
        exact = np.sort(values)[int(np.ceil(q * len(values))) - 1]
        assert FO.quantile_of(at, times, q) == pytest.approx(exact, rel=FO.WIDTH)
    assert FO.quantile_of(np.array([0]), np.array([3]), 0.5) == 0.0


# -- binning -----------------------------------------------------------------------------------

def test_codes_keep_order_and_set_missing_apart(table):
    binner = Binner.fit(table, 8)
    holes = table.withColumn("lag_28", F.when(F.col("horizon") == 1, F.lit(None)).otherwise(F.col("lag_28"))).withColumn(
        "dept_id", F.lit("never seen"))
    out = binned(holes, binner).select("lag_28", "wday", "bins").toArrow().combine_chunks()
    codes = unpacked(out["bins"], np.uint8)
    at = {c: codes[:, i] for i, c in enumerate(MODEL_COLS)}
    assert (at["dept_id"] == 0).all() and (at["wday"] > 0).all()
    lag = np.array([np.nan if v is None else v for v in out["lag_28"].to_pylist()])
    assert (at["lag_28"][np.isnan(lag)] == 0).all() and (at["lag_28"][~np.isnan(lag)] > 0).all()
    order = np.argsort(lag[~np.isnan(lag)])
    assert (np.diff(at["lag_28"][~np.isnan(lag)][order].astype(int)) >= 0).all()


def test_means_of_wide_columns_only_look_back(table):
    binner = Binner.fit(table, 8)
    seen = [(r["item_id"], r["target_day"], r["sales"]) for r in table.collect()]
    for r in binner.with_means(table).collect():
        past = [y for item, day, y in seen if item == r["item_id"] and day <= r["origin"]]
        assert r["_m_item_id"] == (pytest.approx(np.mean(past)) if past else None)
    # What happens after an origin does not move the codes of its rows.
    later = table.withColumn("sales", F.when(F.col("target_day") > 34, F.col("sales") * 50).otherwise(F.col("sales")))
    codes = lambda t: {tuple(r[:3]): bytes(r[3]) for r in binned(t, Binner.fit(t, 8, F.col("origin") == 20)).where(
        F.col("origin") <= 34).select(*KEY, "bins").collect()}
    assert codes(table) == codes(later)


@pytest.mark.parametrize("items", [64, 65, 300])
def test_a_wide_column_is_read_by_declaration(spark, items):
    base = designed(spark, [f"n{i:03d}" for i in range(items)], 45)
    model = fit_quantile_boost(D.direct_table(base, [30], 3), (0.5,), BoostParams(rounds=1, max_depth=2, min_rows=2))
    assert "item_id" not in model.binner.categories and "item_id" in model.binner.edges
    assert model.binner.means.count() == items


def test_too_many_categories_are_refused(spark):
    wide = designed(spark, [f"n{i}" for i in range(260)], 32).withColumn("dept_id", F.col("id"))
    with pytest.raises(ValueError, match="dept_id has 260 values"):
        Binner.fit(D.direct_table(wide, [30], 1), 8)


# -- fits --------------------------------------------------------------------------------------

def test_loss_falls_and_quantiles_are_ordered(model, table):
    for q in QS:
        path = [loss[q] for loss in model.losses]
        assert len(path) == 5 and all(b <= a + 1e-9 for a, b in zip(path, path[1:])) and path[-1] < path[0]
    out = model(table).select(*q_names(QS)).toPandas().to_numpy()
    assert (out >= 0).all() and (np.diff(out, axis=1) >= 0).all() and len(out) == 3 * 5 * len(SERIES)


def slow_fit(bins, y, q, params, categories):
    """The whole fit in plain numpy: returns the forecasts of the training rows."""
    at = np.full(len(y), np.quantile(y, q))
    for _ in range(params.rounds):
        leaf = np.zeros(len(y), int)
        n_leaves, fresh, open_nodes = 1, 1, [0]
        for _ in range(params.max_depth):
            found = []
            for node in open_nodes:
                own = leaf == node
                best = slow_split(bins[own], (y <= at)[own], q, categories, params.min_rows)
                if best:
                    found.append((-best[0], node, best[1], best[2]))
            open_nodes = []
            for _, node, f, left in sorted(found)[: params.max_leaves - n_leaves]:
                own = leaf == node
                goes = np.isin(bins[:, f], list(left))
                leaf[own & goes], leaf[own & ~goes] = fresh, fresh + 1
                open_nodes += [fresh, fresh + 1]
                fresh, n_leaves = fresh + 2, n_leaves + 1
        step = np.zeros(len(y))
        for node in set(leaf):
            own = np.sort((y - at)[leaf == node])
            exact = own[int(np.ceil(q * len(own) * (1 - 1e-12))) - 1]
            step[leaf == node] = FO.range_value(int(FO.ranges_of(np.array([exact]))[0]))  # the middle of its range
        at = at + params.learning_rate * step
    return at


@pytest.mark.parametrize("q", [0.1, 0.5, 0.9])
def test_fit_equals_a_plain_loop(table, q):
    model = fit_quantile_boost(table, (q,), PARAMS)
    frame = binned(table, model.binner).select("sales", "bins").toArrow().combine_chunks()
    bins, y = unpacked(frame["bins"], np.uint8), frame["sales"].to_numpy().astype(float)
    want = slow_fit(bins, y, q, PARAMS, model.binner.is_category())
    assert np.allclose(model.scorer().score(bins)[:, 0], want, rtol=1e-9, atol=1e-9)


def test_trees_do_not_depend_on_partitions(table):
    trees = [
        [{q: (t.feature, t.mask, t.value) for q, t in stages.items()} for stages in fit_quantile_boost(t, QS, PARAMS).rounds]
        for t in (table, table.repartition(7))
    ]
    assert trees[0] == trees[1]


def test_driver_and_shuffle_meet_the_same(table, monkeypatch):
    from salescast.operators import boosting

    few = BoostParams(rounds=2, learning_rate=0.5, max_depth=2, min_rows=2)
    here = fit_quantile_boost(table, QS, few)
    monkeypatch.setattr(boosting, "MEET_BYTES", 0)
    there = fit_quantile_boost(table, QS, few)
    assert [{q: vars(t) for q, t in s.items()} for s in here.rounds] == [{q: vars(t) for q, t in s.items()} for s in there.rounds]


def test_rounds_do_not_add_to_what_the_driver_gets(table, monkeypatch):
    from salescast.operators import boosting

    first = Boosting(table, QS, {0: Fit(PARAMS)})
    one_level = first.tasks * len(QS) * len(first.binner.names) * first.binner.width * 16
    monkeypatch.setattr(boosting, "MEET_BYTES", one_level)
    got, kind = [], type(first.frame)
    collect = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda df: got.append(collect(df)) or got[-1])
    fit = Boosting(table, QS, {0: Fit(PARAMS)})
    for _ in range(3):
        fit.round()
    assert 0 < sum(t.nbytes for t in got) <= 1.1 * one_level  # column offsets and keys come on top of the counts


def test_small_partial_results_are_gathered_by_one_task(table, monkeypatch):
    from salescast.operators import boosting

    monkeypatch.setattr(boosting, "MEET_BYTES", 0)
    boost = Boosting(table, QS, {0: Fit(PARAMS)})
    gathered, kind = [], type(boost.frame)
    deal = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda df, n, *by: gathered.append(n) or deal(df, n, *by))
    boost.round()
    assert gathered[0] == 1  # the roots' counts, a few KB of each task


def test_a_long_fit_leaves_the_driver_room():
    from salescast.operators import boosting

    assert boosting.MEET_BYTES <= 16 << 20  # several fits of a query count together


def test_leaf_budget_and_depth_hold(table):
    deep = fit_quantile_boost(table, (0.5,), BoostParams(rounds=2, max_depth=6, max_leaves=5, min_rows=1))
    assert all(len(s[0.5].leaves) <= 5 and s[0.5].depth <= 6 for s in deep.rounds)


def test_scoring_plan_does_not_grow_with_rounds(table):
    plans = []
    for rounds in (4, 60):
        few = fit_quantile_boost(table, (0.5,), BoostParams(rounds=1, max_depth=1, min_rows=2))
        few.rounds = few.rounds * rounds
        plan = few(table)._jdf.queryExecution().executedPlan().toString()
        plans.append((plan.count("\n"), plan.count("ArrowEvalPython"), plan.count("Exchange")))
    assert plans[0] == plans[1] and plans[0][1] == 1


def test_jobs_of_a_round_do_not_grow_with_quantiles_or_fits(spark, table):
    def jobs_of(quantiles, n):
        boosting = Boosting(table, quantiles, {i: Fit(PARAMS) for i in range(n)})
        tracker, group = spark.sparkContext.statusTracker(), f"round-{len(quantiles)}-{n}"
        spark.sparkContext.setJobGroup(group, group)
        boosting.round()
        spark.sparkContext.setJobGroup("after", "after")
        return len(tracker.getJobIdsForGroup(group))

    assert jobs_of((0.5,), 1) == jobs_of(QS, 3) == PARAMS.max_depth + 1


def test_fits_together_equal_fits_apart(table):
    early = F.col("origin") <= 34
    other = BoostParams(rounds=2, learning_rate=0.2, max_depth=2, min_rows=5, bins=16)
    both = fit_together(table, QS, {"a": Fit(PARAMS, early), "b": Fit(other)}, early)
    alone = fit_together(table, QS, {"a": Fit(PARAMS, early)}, early)["a"]
    assert [{q: vars(t) for q, t in s.items()} for s in both["a"].rounds] == [{q: vars(t) for q, t in s.items()} for s in alone.rounds]
    assert both["a"].losses == [pytest.approx(x) for x in alone.losses]
    assert len(both["b"].rounds) == 2 and both["b"].train_rows == table.count() and alone.train_rows == table.where(early).count()


def test_saved_model_predicts_the_same(spark, model, table, tmp_path):
    import os

    model.save(f"{tmp_path}/m")
    assert sorted(os.listdir(f"{tmp_path}/m")) == ["means", "meta", "nodes"]
    nodes = spark.read.parquet(f"{tmp_path}/m/nodes")
    assert nodes.select("round", "quantile").distinct().count() == PARAMS.rounds * len(QS)
    again = QuantileBoostModel.load(spark, f"{tmp_path}/m")
    names = [*KEY, *q_names(QS)]
    assert sorted(model(table).select(*names).collect()) == sorted(again(table).select(*names).collect())
    assert again.params == model.params and again.losses == model.losses


def test_another_schema_version_is_refused(spark, model, tmp_path, monkeypatch):
    from salescast.operators import boosting

    model.save(f"{tmp_path}/m")
    monkeypatch.setattr(boosting, "SCHEMA_VERSION", 99)
    with pytest.raises(ValueError, match="version"):
        QuantileBoostModel.load(spark, f"{tmp_path}/m")


def test_missing_inputs_and_unseen_items_are_scored(model, table):
    holes = table.withColumn("lag_28", F.lit(None).cast("double")).withColumn("event_name_1", F.lit(None).cast("string"))
    holes = holes.withColumn("item_id", F.lit("never seen"))
    assert model(holes).where(F.col("q50").isNull()).count() == 0
    assert model(holes).count() == table.count()


def test_no_rows_are_refused(table):
    with pytest.raises(ValueError, match="no rows"):
        fit_quantile_boost(table.where("false"), QS, PARAMS)


# -- jobs --------------------------------------------------------------------------------------

def test_backtest_of_all_folds_at_once(rows):
    settings = Settings(horizon=5, quantiles=QS, n_train_origins=3, origin_stride=14)
    out = boost_backtest(rows, [3, 63, 91], settings, PARAMS).toPandas()
    assert sorted(set(out["origin"])) == [63, 91] and len(out) == 2 * 5 * len(SERIES)
    # The oldest fold shapes the bins, so it equals a fit of its own; a later world does not move it.
    alone = refit_backtest(rows, lambda t: fit_quantile_boost(t, QS, PARAMS), [63], settings).toPandas()
    mine = out[out["origin"] == 63].sort_values(KEY, ignore_index=True)
    assert np.allclose(mine[q_names(QS)], alone.sort_values(KEY, ignore_index=True)[q_names(QS)])
    later = rows.withColumn("sales", F.when(F.col("d") > 68, F.col("sales") + 500).otherwise(F.col("sales")))
    moved = boost_backtest(later, [63, 91], settings, PARAMS).toPandas()
    moved = moved[moved["origin"] == 63].sort_values(KEY, ignore_index=True)
    assert np.allclose(mine[q_names(QS)], moved[q_names(QS)])
    with pytest.raises(ValueError):
        boost_backtest(rows, [3], settings, PARAMS)


def test_train_writes_panel_model_and_run(spark, rows, tmp_path):
    settings = Settings(horizon=5, quantiles=(0.05, 0.25, 0.5, 0.75, 0.95), n_train_origins=2, n_folds=1)
    params = BoostParams(rounds=1, learning_rate=0.5, max_depth=2, min_rows=2, checkpoint_every=1)
    jobs.train(spark, rows, settings, params, f"{tmp_path}/run")
    run = spark.read.parquet(f"{tmp_path}/run/runs").first()
    assert run["wape_item_store"] is not None and run["rounds"] == 1
    assert run["n_series"] == len(SERIES) and run["train_rows"] == len(SERIES) * 2 * 5
    assert spark.read.option("header", True).csv(f"{tmp_path}/run/evaluation/panel/by_level").count() == 6
    assert QuantileBoostModel.load(spark, f"{tmp_path}/run/model").quantiles == list(settings.quantiles)
    # The gate: at or under the line the model is registered and waits for approval.
    log = RG.state(RG.events(spark, f"{tmp_path}/run/registry")).collect()
    if run["wape_item_store"] <= RG.REGISTER_WAPE:
        assert run["version"] == 1 and [r["status"] for r in log] == [RG.PENDING]
    else:
        assert run["version"] is None and not log


def test_tuning_stops_losing_candidates_early(spark, rows):
    settings = Settings(horizon=5, quantiles=(0.5,))
    base = BoostParams(rounds=4, max_depth=2, bins=16)
    tries = jobs.candidates(6, 1, base)
    assert tries == jobs.candidates(6, 1, base)
    assert all(0.01 <= t.learning_rate <= 0.1 and 31 <= t.max_leaves <= 255 and 20 <= t.min_rows <= 200 for t in tries)
    out = {r["candidate"]: r for r in jobs.tune(spark, rows, [49, 63, 77], settings, tries).collect()}
    assert sorted(r["rounds"] for r in out.values()) == [1, 1, 1, 2, 4, 4]
    best = [r for r in out.values() if r["best"]]
    assert len(best) == 1 and best[0]["rounds"] == 4
    # The winner's score is that of a model fitted on its own and scored on the held-out origin.
    from salescast.functions import metrics as M

    table = D.direct_table(rows, [49, 63, 77], 5)
    i = best[0]["candidate"]
    known = F.col("origin") != 77
    alone = fit_together(table, (0.5,), {0: Fit(tries[i], known)})[0]
    wape = alone(table.where(~known)).agg(M.wape("sales", "q50")).first()[0]
    assert best[0]["val_wape"] == pytest.approx(wape)


def test_comparison_runs_both_models_on_shared_series(spark, rows, tmp_path):
    from salescast.operators.forecast import prior_forecaster, seasonal_naive_forecaster
    from salescast.plans.backtest import backtest

    qs = (0.5,)
    settings = Settings(horizon=5, quantiles=qs, n_folds=2, max_series=2)
    models = {
        "prior": lambda f, folds: backtest(f, prior_forecaster(f, folds, qs, 28), folds, 5, qs),
        "naive": lambda f, folds: backtest(f, seasonal_naive_forecaster(f, folds, qs), folds, 5, qs),
    }
    table = jobs.compare(spark, rows, settings, models, f"{tmp_path}/cmp", 20).collect()
    assert len(table) == 6 and all(r["seconds_prior"] > 0 and r["seconds_naive"] > 0 for r in table)
    assert {r["rows_prior"] for r in table} == {r["rows_naive"] for r in table} == {2 * 2 * 5}
    ids = [{r[0] for r in spark.read.parquet(f"{tmp_path}/cmp/{n}").select("id").distinct().collect()} for n in models]
    assert ids[0] == ids[1] and len(ids[0]) == 2


def test_cold_series_ride_along(spark, rows):
    cut = rows.where((F.col("id") != COLD) | (F.col("d") <= 10))
    model = fit_quantile_boost(D.direct_table(cut, [20, 34], 5), (0.5,), PARAMS)
    assert model.train_rows == 2 * 5 * (len(SERIES) - 1)


def test_search_fits_every_candidate_whole_and_learns_from_scores(spark, rows):
    settings = Settings(horizon=5, quantiles=(0.5,))
    base = BoostParams(rounds=3, max_depth=2, bins=16)
    out = sorted(jobs.search(spark, rows, [49, 63, 77], settings, base, 5, 1).collect())
    assert [(r["candidate"], r["rounds"]) for r in out] == [(i, 3) for i in range(5)]
    assert [r["best"] for r in out].count(True) == 1
    best = next(r for r in out if r["best"])
    assert best["val_wape"] == min(r["val_wape"] for r in out)
    made = [replace(base, learning_rate=r["learning_rate"], max_leaves=r["max_leaves"], min_rows=r["min_rows"]) for r in out]
    wapes = [r["val_wape"] for r in out]
    # Two at a time: the first are random draws, the others follow from the scores before them.
    assert made[:2] == jobs.candidates(2, 1, base)
    assert made[2:4] == jobs.proposals(made[:2], wapes[:2], 2, 1, base) and made[4:] == jobs.proposals(made[:4], wapes[:4], 1, 1, base)
    # A score is that of a model fitted on its own, deep enough for its leaves.
    from salescast.functions import metrics as M

    table, known, i = D.direct_table(rows, [49, 63, 77], 5), F.col("origin") != 77, best["candidate"]
    own = replace(made[i], max_depth=(made[i].max_leaves - 1).bit_length())
    alone = fit_together(table, (0.5,), {0: Fit(own, known)})[0]
    assert best["val_wape"] == pytest.approx(alone(table.where(~known)).agg(M.wape("sales", "q50")).first()[0])


def test_proposals_go_where_scores_are_low():
    base = BoostParams()

    def score(p):
        rate, leaves, least = jobs.place(p)
        return (rate - 0.8) ** 2 + (leaves - 0.3) ** 2 + 0.1 * least

    tried = jobs.proposals([], [], 2, 7, base)
    while len(tried) < 12:
        tried += jobs.proposals(tried, [score(p) for p in tried], 2, 7, base)
    assert len(set(tried)) == 12 and all(0 <= v <= 1 for p in tried for v in jobs.place(p))
    later = sorted(map(score, tried[2:]))
    assert later[0] < min(map(score, tried[:2])) / 4 and later[4] < sorted(map(score, jobs.candidates(2048, 7, base)))[512]
    # Candidates without a score are left out; other scores lead elsewhere.
    some = jobs.proposals(tried[:4], [0.5, None, 0.7, None], 2, 7, base)
    assert some != jobs.proposals(tried[:4], [0.7, None, 0.5, None], 2, 7, base)
    assert jobs.proposals(tried[:2], [None, None], 2, 7, base) == jobs.candidates(2, 9, base)


def test_registered_search_stops_no_candidate_early(spark, rows, tmp_path, monkeypatch):
    from salescast.plans import catalog

    def path(name, write):
        write(f"{tmp_path}/{name}")
        return f"{tmp_path}/{name}"

    monkeypatch.setattr(catalog, "SEARCH", BoostParams(rounds=4, max_depth=2, bins=16))
    settings = Settings(horizon=5, quantiles=(0.5,))
    out = catalog.tune_holdout(SimpleNamespace(spark=spark, features=rows, origins=[49, 63, 77], settings=settings, path=path)).collect()
    assert [r["rounds"] for r in out] == [4] * catalog.CANDIDATES
    assert all(r["val_wape"] is not None for r in out)
