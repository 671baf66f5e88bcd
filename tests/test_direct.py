import pytest
from conftest import COLD, SERIES, units

from salescast.operators import direct as D
from salescast.schema import MODEL_COLS


def test_origin_grids(feature_rows):
    last = D.last_day(feature_rows)
    assert D.origins_ending(last, 3, 14, 5) == [63, 77, 91]
    assert D.origins_ending(last, 2, 28, 5) == [63, 91]
    assert D.train_origins(63, 3, 14, 5) == [30, 44, 58]
    assert D.train_origins(20, 8, 14, 5) == [1, 15]
    assert D.latest_origin(feature_rows, 5) == 91


def test_direct_rows_carry_the_origin_and_the_target(feature_rows):
    rows = D.direct_table(feature_rows, [40], 5).collect()
    assert len(rows) == 5 * len(SERIES)
    for r in rows:
        assert r["target_day"] == r["origin"] + r["horizon"] and r["sales"] == units(r["id"], r["target_day"])
        assert r["lag_7"] == units(r["id"], 34) and r["wday"] == (r["target_day"] + 2) % 7 + 1


def test_unobserved_targets_drop_out(feature_rows):
    rows = D.direct_table(feature_rows, [95], 5).collect()
    assert {r["horizon"] for r in rows} == {1} and len(rows) == len(SERIES)


def test_origin_without_a_next_row_has_no_examples(cold_rows):
    rows = D.direct_table(cold_rows, [40], 5).collect()
    assert {r["id"] for r in rows} == set(SERIES) - {COLD}


def test_overlapping_origins_equal_a_nested_loop(cold_rows):
    origins, h = [6, 9, 30, 37], 5
    have = {(r["id"], r["d"]) for r in cold_rows.collect()}
    want = {
        (s, o, k)
        for s in SERIES for o in origins for k in range(1, h + 1)
        if (s, o + 1) in have and (s, o + k) in have
    }
    got = [(r["id"], r["origin"], r["horizon"]) for r in D.direct_table(cold_rows, origins, h).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_holdout_is_the_newest_origin():
    assert D.holdout([3, 5, 9]) == ([3, 5], 9)
    with pytest.raises(ValueError):
        D.holdout([3])


def test_model_frame_has_every_input(feature_rows):
    frame = D.model_frame(D.direct_table(feature_rows, [40], 5))
    assert set(MODEL_COLS) < set(frame.columns)
