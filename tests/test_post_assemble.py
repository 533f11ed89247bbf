"""Rounding, water year, dates, ids (M1 M2 D1 D3 D4 P4 P5 T1) and assembly."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catchflow.functions import scalars as S
from catchflow.operators import assemble, ledger


def one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(expr.alias("r")).first()["r"]


def test_round_decimals_half_even(spark):
    assert one(spark, S.round_decimals(F.col("x"), 5), 0.000125, "double") == pytest.approx(0.00012)
    # idempotent
    df = spark.createDataFrame([(x / 7.0,) for x in range(100)], "x double")
    once = df.select(S.round_decimals("x", 4).alias("x"))
    assert sorted(once.collect()) == sorted(once.select(S.round_decimals("x", 4).alias("x")).collect())


def test_round_sigfigs(spark):
    assert one(spark, S.round_sigfigs("x", 2), 1234.5, "double") == 1200.0
    assert one(spark, S.round_sigfigs("x", 2), 0.0, "double") == 0.0
    assert one(spark, S.round_sigfigs("x", 2), None, "double") is None


def test_water_year(spark):
    assert one(spark, S.water_year("x"), dt.datetime(1999, 9, 30, 23), "timestamp_ntz") == 1999
    assert one(spark, S.water_year("x"), dt.datetime(1999, 10, 1, 0), "timestamp_ntz") == 2000


def test_clamp_to_water_year(spark):
    got = one(spark, S.clamp_to_water_year("x", 240), dt.datetime(2000, 9, 28), "timestamp_ntz")
    assert got == dt.datetime(2000, 9, 30, 23, 59, 59)


def test_hours_since_and_parse(spark):
    assert one(spark, S.hours_since("x"), 5, "bigint") == dt.datetime(1980, 1, 1, 5)
    assert one(spark, S.parse_time("x", strict=False), "bad", "string") is None
    with pytest.raises(Exception):
        one(spark, S.parse_time("x", strict=True), "bad", "string")


def test_pad_gage(spark):
    df = spark.createDataFrame([("1187300",), ("01187300",), ("187300",)], "g string")
    assert [r[0] for r in df.select(S.pad_gage("g")).collect()] == ["01187300", "01187300", "187300"]


def test_inclusive_range(spark):
    from catchflow.operators.compare import in_range
    df = spark.createDataFrame([(dt.datetime(2000, 1, 1),), (dt.datetime(2000, 1, 2),), (dt.datetime(2000, 1, 3),)], "time timestamp_ntz")
    assert in_range(df, "time", "2000-01-01", "2000-01-02").count() == 2


def runs_day(spark, missing=()):
    rows = []
    for d in (1, 2, 3):
        for h in range(24):
            t = dt.datetime(2019, 1, d, h)
            if t in missing:
                continue
            for step in range(24):
                rows.append((t, step, "TMP", float(h), d * 100 + h))
    return spark.createDataFrame(rows, "init_hour timestamp_ntz, step int, variable string, value double, seq long")


def test_forecast_alignment_h0_h2(spark):
    r = runs_day(spark)
    a0 = assemble.align_forecast(r, 0, day="2019-01-03").orderBy("time").collect()
    assert a0[0].init_hour == dt.datetime(2019, 1, 2, 23) and a0[-1].init_hour == dt.datetime(2019, 1, 3, 22)
    assert [x.time.hour for x in a0] == list(range(24))
    a2 = assemble.align_forecast(r, 2, day="2019-01-03").orderBy("time").collect()
    assert a2[0].init_hour == dt.datetime(2019, 1, 2, 21) and a2[-1].init_hour == dt.datetime(2019, 1, 3, 20)
    for h in range(24):  # property: every horizon gives exactly 24 valid hours, 00..23
        got = sorted(x.time.hour for x in assemble.align_forecast(r, h, day="2019-01-03").select("time").collect())
        assert got == list(range(24)), h
    with pytest.raises(ValueError):
        assemble.align_forecast(r, 24)


def test_forecast_missing_run_only_loses_its_hour(spark):
    r = runs_day(spark, missing={dt.datetime(2019, 1, 3, 22)})
    a0 = assemble.align_forecast(r, 0, day="2019-01-03")
    hours = sorted(x.time.hour for x in a0.collect())
    assert hours == list(range(23))


def test_dedupe_keeps_last(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "key string, seq long, v string")
    assert assemble.dedupe_last(df, ["key"]).first()["v"] == "b"


def test_merge_policies(spark):
    l = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0)], "k int, v double")
    r = spark.createDataFrame([(1, None), (2, 1.0), (3, 2.0)], "k int, v double")
    first = {x.k: x.v for x in assemble.merge_fields(l, r, ["k"], "first").collect()}
    assert first == {1: 1.0, 2: 1.0, 3: 1.0}
    null = {x.k: x.v for x in assemble.merge_fields(l, r, ["k"], "null").collect()}
    assert null[3] is None
    assert [x.k for x in assemble.merge_conflicts(l, r, ["k"], ["v"]).collect()] == [3]
    with pytest.raises(Exception):
        assemble.merge_fields(l, r, ["k"], "error").collect()


def test_required_vars(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "init_hour int, variable string")
    kept, skipped = assemble.required_vars(df, ["a", "b"])
    assert kept.count() == 2 and [x[0] for x in skipped.collect()] == [2]


def test_ledger_skip_rules(spark, tmp_dir):
    basins = spark.createDataFrame([("f",), ("p",), ("n",)], "basin_id string")
    path = f"{tmp_dir}/ledger"
    ledger.record(spark.createDataFrame([("f",), ("p",)], "basin_id string"), path, "processing")
    ledger.record(spark.createDataFrame([("f",)], "basin_id string"), path, "finished")
    led = ledger.read_ledger(spark, path)
    assert sorted(x[0] for x in ledger.pending(basins, led, "finished").collect()) == ["n", "p"]
    assert [x[0] for x in ledger.pending(basins, led, "any").collect()] == ["n"]
