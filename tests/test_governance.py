import math

import pytest
from pyspark.sql import functions as F

from salescast.operators import bias as B
from salescast.operators import eda as E
from salescast.operators import registry as RG
from salescast.operators.reshape import to_long


def table(spark, rows):
    return spark.createDataFrame(rows, "version int, created int, status string, wape double")


def test_newest_version_per_status(spark):
    reg = table(spark, [(1, 1, RG.APPROVED, 0.8), (2, 2, RG.APPROVED, 0.7), (3, 3, RG.PENDING, None)])
    got = {r["status"]: r for r in RG.newest_by_status(reg).collect()}
    assert got[RG.APPROVED]["version"] == 2 and got[RG.PENDING]["version"] == 3
    assert [r["version"] for r in RG.versions(reg).collect()] == [3, 2, 1]
    back = {r["version"]: r["status"] for r in RG.rolled_back(reg).collect()}
    assert back == {1: RG.APPROVED, 2: RG.REJECTED, 3: RG.PENDING}
    moved = RG.with_status(reg, 3, RG.APPROVED)
    assert moved.where(F.col("status") == RG.APPROVED).count() == 3


@pytest.mark.parametrize("incumbent, candidate, wins", [
    (None, 0.7, True), (None, None, True), (0.7, None, False), (0.7, 0.7, True), (0.7, 0.71, False), (0.7, 0.6, True),
])
def test_promotion_rule(spark, incumbent, candidate, wins):
    reg = table(spark, [(1, 1, RG.APPROVED, incumbent), (2, 2, RG.PENDING, candidate)])
    row = RG.promote_decision(reg).first()
    assert row["promote"] is wins and row["registrable"] is (candidate is not None and candidate <= 0.75)


def test_without_a_candidate_nothing_is_promoted(spark):
    row = RG.promote_decision(table(spark, [(1, 1, RG.APPROVED, 0.5)])).first()
    assert row["promote"] is False and row["candidate"] is None


def test_traffic_split_is_a_partition_of_the_series(spark):
    df = spark.createDataFrame([(f"s{i}",) for i in range(500)], "id string")
    out = RG.ab_split(df, df, 20).collect()
    assert len(out) == len({r["id"] for r in out}) == 500
    share = sum(r["variant"] == "challenger" for r in out) / 500
    assert 0.12 < share < 0.28
    assert RG.shadow(df, df).groupBy("served").count().count() == 2


def test_bias_metrics_match_their_definitions(spark):
    rows = [("CA", 1)] * 3 + [("CA", 0)] * 1 + [("TX", 1)] * 2 + [("TX", 0)] * 4
    got = {r["metric"]: r["value"] for r in B.bias_metrics(spark.createDataFrame(rows, "state_id string, sold int"), "state_id", "CA").collect()}
    pa, pd = (4 / 6, 2 / 6), (1 / 4, 3 / 4)
    mid = [(a + d) / 2 for a, d in zip(pa, pd)]
    kl = lambda p, q: sum(x * math.log(x / y) for x, y in zip(p, q))
    assert got["CI"] == pytest.approx((6 - 4) / 10) and got["DPL"] == pytest.approx(pa[1] - pd[1])
    assert got["KL"] == pytest.approx(kl(pa, pd)) and got["JS"] == pytest.approx((kl(pa, mid) + kl(pd, mid)) / 2)
    gaps = [abs(a - d) for a, d in zip(pa, pd)]
    assert got["KS"] == pytest.approx(max(gaps)) and got["TVD"] == pytest.approx(sum(gaps) / 2)
    assert got["LP"] == pytest.approx(math.sqrt(sum(g * g for g in gaps)))


def test_bias_of_an_absent_facet_is_unknown(spark):
    got = {r["metric"]: r["value"] for r in B.bias_metrics(spark.createDataFrame([("TX", 1)], "state_id string, sold int"), "state_id", "CA").collect()}
    assert got["CI"] == 1.0 and got["DPL"] is None and got["KL"] is None


def test_exploration(spark, wide, calendar, prices):
    long = to_long(wide)
    assert tuple(E.scale(long).first()) == (4, 9, 36)
    assert E.zero_share(long).first()[0] == pytest.approx(11 / 36)
    units = {r["state_id"]: r["total_units"] for r in E.units_by(long, "state_id").collect()}
    assert sum(units.values()) == long.agg(F.sum("sales")).first()[0]
    assert {r["level"]: r["n"] for r in E.cardinalities(long).collect()} == {"item_id": 3, "dept_id": 2, "cat_id": 2, "store_id": 2, "state_id": 2}
    bins = E.zero_histogram(long).orderBy("bin").collect()
    assert [r["bin"] for r in bins] == list(range(50)) and sum(r["n_series"] for r in bins) == 4
    assert (bins[0]["n_series"], bins[49]["n_series"]) == (1, 3) and {r["share_above_90"] for r in bins} == {0.0}
    assert E.daily_total(long, calendar).count() == 9 and E.weekday_mean(long, calendar).count() == 7
    lift = E.snap_lift(long, calendar, "TOOLS", "OR").first()
    assert lift["lift"] == pytest.approx(lift["snap_mean"] / lift["other_mean"] - 1)
    moves = E.price_changes(prices).first()
    assert moves["changed_share"] == pytest.approx(1 / 7) and moves["median_abs_change"] == pytest.approx(0.25)
    assert len(E.top_series(long, 2).collect()) == 2


# -- the registry's log ------------------------------------------------------------------------

def states(spark, path):
    return {r["version"]: r["status"] for r in RG.state(RG.events(spark, path)).collect()}


def test_the_gate_registers_at_or_under_the_line(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert RG.events(spark, path).count() == 0
    assert RG.register(spark, path, 10, 0.76) is None and RG.register(spark, path, 10, None) is None
    assert RG.register(spark, path, 11, 0.75) == 1 and RG.register(spark, path, 12, 0.9, line=None) == 2
    row = RG.state(RG.events(spark, path)).where("version = 1").first()
    assert (row["created"], row["status"], row["wape"]) == (11, RG.PENDING, 0.75)


def test_promotion_and_rollback_are_events(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert RG.promote(spark, path) is None and RG.roll_back(spark, path) is None
    RG.register(spark, path, 1, 0.7)
    assert RG.promote(spark, path) is True
    RG.register(spark, path, 2, 0.72)
    assert RG.promote(spark, path) is False and states(spark, path) == {1: RG.APPROVED, 2: RG.REJECTED}
    RG.register(spark, path, 3, 0.6)
    assert RG.promote(spark, path) is True and RG.promote(spark, path) is None
    assert RG.roll_back(spark, path) == 1 and states(spark, path) == {1: RG.APPROVED, 2: RG.REJECTED, 3: RG.REJECTED}
    assert RG.roll_back(spark, path) is None
    log = RG.events(spark, path).orderBy("seq").collect()
    assert [r["seq"] for r in log] == list(range(1, 9))  # nothing is rewritten
    with pytest.raises(ValueError):
        RG.set_status(spark, path, 9, RG.APPROVED)


def test_a_command_on_a_stale_state_changes_nothing(spark, tmp_path):
    from salescast.session import Conflict

    path = f"{tmp_path}/log"
    RG.register(spark, path, 1, 0.7)
    seen = RG.last_seq(RG.events(spark, path))
    RG.set_status(spark, path, 1, RG.APPROVED, seen=seen)
    with pytest.raises(Conflict):
        RG.set_status(spark, path, 1, RG.REJECTED, seen=seen)
    assert states(spark, path) == {1: RG.APPROVED}


def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path):
    from salescast.sources import runs

    root, ids = f"{tmp_path}/runs", spark.range(3)
    with pytest.raises(FileNotFoundError):
        runs.read_run(spark, root)
    broken = ids.select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        runs.write_run(spark, root, "a", {"good": ids, "bad": broken})
    with pytest.raises(FileNotFoundError):
        runs.read_run(spark, root)
    runs.write_run(spark, root, "a", {"good": ids, "bad": ids.limit(1)})
    runs.write_run(spark, root, "b", {"good": ids.limit(2)})
    assert {k: v.count() for k, v in runs.read_run(spark, root, "a").items()} == {"good": 3, "bad": 1}
    assert {k: v.count() for k, v in runs.read_run(spark, root).items()} == {"good": 2}
    with pytest.raises(ValueError):
        runs.write_run(spark, root, "a", {"good": ids})
    ids.limit(1).write.mode("overwrite").parquet(f"{root}/a/good")
    with pytest.raises(ValueError, match="manifest"):
        runs.read_run(spark, root, "a")


def test_statements_take_parameters(spark):
    from salescast.plans.exploration import explore

    sales = spark.createDataFrame([("a", "X", 1, 3), ("b", "Y", 1, 5), ("a", "X", 2, 0)], "id string, state_id string, d int, sales int")
    days = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-02")], "day int, date string")
    tables = {"sales": sales, "calendar": days}
    assert [r["id"] for r in explore(spark, "top_series", tables, top=1).collect()] == ["b"]
    got = {r["d"]: r["total_units"] for r in explore(spark, "daily_units", tables, state="X").collect()}
    assert got == {1: 3, 2: 0}
    assert explore(spark, "zero_share", tables).first()[0] == pytest.approx(1 / 3)
