"""NSE, ensemble, feature search, map tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catchflow.operators import evaluate, maps

T = [dt.datetime(2007, 1, 1, h) for h in range(6)]


def obs_sim(spark):
    obs = spark.createDataFrame([(T[0], 1.0), (T[1], 2.0), (T[2], 4.0), (T[3], None)], "datetime timestamp_ntz, obs double")
    sim = spark.createDataFrame([(T[0], "m", 1.0), (T[1], "m", 3.0), (T[4], "m", 9.0)], "datetime timestamp_ntz, id string, value double")
    return obs, sim


def test_nse_masked(spark):
    obs, sim = obs_sim(spark)
    assert evaluate.nse_table(obs, sim, "masked").first()["nse"] == pytest.approx(-1.0)


def test_nse_obs_all(spark):
    obs, sim = obs_sim(spark)
    assert evaluate.nse_table(obs, sim, "obs_all").first()["nse"] == pytest.approx(0.785714, abs=1e-6)


def test_nse_constant_obs_is_null(spark):
    obs = spark.createDataFrame([(T[0], 2.0), (T[1], 2.0)], "datetime timestamp_ntz, obs double")
    sim = spark.createDataFrame([(T[0], "m", 1.0), (T[1], "m", 3.0)], "datetime timestamp_ntz, id string, value double")
    assert evaluate.nse_table(obs, sim, "masked").first()["nse"] is None


def test_nse_properties(spark):
    import random
    rnd = random.Random(3)
    vals = [rnd.uniform(0, 10) for _ in range(50)]
    times = [dt.datetime(2000, 1, 1) + dt.timedelta(hours=i) for i in range(50)]
    obs = spark.createDataFrame(list(zip(times, vals)), "datetime timestamp_ntz, obs double")
    mean = sum(vals) / len(vals)
    sim = spark.createDataFrame([(t, "self", v) for t, v in zip(times, vals)] + [(t, "mean", mean) for t in times],
                                "datetime timestamp_ntz, id string, value double")
    got = {r.id: r.nse for r in evaluate.nse_table(obs, sim).collect()}
    assert got["self"] == pytest.approx(1.0)
    assert got["mean"] == pytest.approx(0.0, abs=1e-12)


def test_mean_member_scored_like_members(spark):
    obs, sim = obs_sim(spark)
    allm = evaluate.with_mean_member(sim)
    assert {r.id for r in evaluate.nse_table(obs, allm).collect()} == {"m", "mean"}


def test_ensemble_wide_does_not_multiply_duplicates(spark):
    s = spark.createDataFrame([(T[0], "a", 1.0), (T[0], "a", 1.0), (T[0], "b", 2.0), (T[1], "b", 3.0)],
                              "datetime timestamp_ntz, id string, value double")
    w = evaluate.ensemble_wide(s, ["a", "b"])
    assert w.count() == 2


def flow_df(spark, rows):
    return spark.createDataFrame(rows, "feature_id long, time timestamp_ntz, flow double")


def test_missing_is_not_nonzero(spark):
    st = evaluate.feature_stats(flow_df(spark, [(1, T[0], 0.0), (1, T[1], None)]))
    assert st.first()["nonzero"] is False


def test_peak_tie_keeps_first(spark):
    fl = flow_df(spark, [(3, T[0], 10.0), (5, T[0], 10.0), (4, T[0], 1.0)])
    idx = evaluate.position_index(fl, "feature_id", "feature_idx")
    top = evaluate.top_feature(evaluate.feature_stats(fl, idx), "peak").first()
    assert top["feature_id"] == 3


def test_duration_counts_positive_steps(spark):
    fl = flow_df(spark, [(1, T[i], v) for i, v in enumerate([0.0, 1.0, 0.0, 2.0, 3.0])])
    assert evaluate.feature_stats(fl).first()["duration"] == 3


def test_last_value_by_index(spark):
    v = spark.createDataFrame([("1", 0, 1.0), ("1", 2, 3.0), ("1", 1, 5.0)], "nex_id string, index long, value double")
    assert maps.last_value(v).first()["value"] == 3.0


def test_rescale_and_constant_frame(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 5.0), ("a", 10.0), ("b", 3.0), ("b", 3.0)], "vpu string, value double")
    got = sorted((r.vpu, r.value, round(r.scaled, 9)) for r in maps.rescale(df, "value", by=["vpu"]).collect())
    assert got == [("a", 0.0, 0.1), ("a", 5.0, 0.4), ("a", 10.0, 0.7), ("b", 3.0, 1.0), ("b", 3.0, 1.0)]


def test_map_table_fills_zero(spark):
    feats = spark.createDataFrame([("1", "nex-1"), ("1", "nex-2")], "vpu string, id string")
    vals = spark.createDataFrame([("nex-1", float("nan"))], "id string, value double")
    got = sorted((r.id, r.value) for r in maps.map_table(feats, vals, ["id"]).collect())
    assert got == [("nex-1", 0.0), ("nex-2", 0.0)]
