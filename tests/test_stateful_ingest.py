"""Stateful ingest (ST2): steps in pieces, pieces that come again, steps that never become whole."""

import datetime as dt

import pyarrow as pa
import pytest

from catchflow.streaming import daily, stateful

ROWS = "time timestamp_ntz, iy long, ix long, variable string, value double"
DAY = dt.datetime(2000, 1, 1)


def land(spark, src, *rows):
    spark.createDataFrame([(DAY + dt.timedelta(days=d), 0, ix, v, x) for d, ix, v, x in rows], ROWS).coalesce(1).write.mode("append").parquet(src)


def test_pieces_repeats_and_late_steps(spark, tmp_dir):
    cov = spark.createDataFrame([("b", "c", 0, 0, 0, 1.0), ("b", "c", 1, 0, 1, 0.5), ("x", "c", 0, 0, 0, 1.0)],
                                "basin_id string, divide_id string, cell_id long, iy long, ix long, coverage double")
    src, out, ck = (f"{tmp_dir}/{n}" for n in ("src", "out", "ck"))

    def run():
        stateful.ingest_pieces(spark, src, ROWS, cov, ["p", "q"], out, ck, delay="3 days", max_files_per_trigger=1)
        return sorted((r.basin_id, (r.time - DAY).days, r.p, r.q, r.complete) for r in daily.read_output(spark, out).collect())

    land(spark, src, (0, 0, "p", 2.0), (0, 0, "q", 1.0), (1, 0, "p", 7.0), (1, 0, "q", 1.0))
    assert run() == [("x", 0, 2.0, 1.0, True), ("x", 1, 7.0, 1.0, True)]  # the basin with one cell is whole, b waits for its other cell
    land(spark, src, (0, 1, "p", 5.0), (0, 1, "other", 9.0))
    land(spark, src, (0, 1, "q", 1.0))
    assert run()[0] == ("b", 0, 3.0, 1.0, True)  # (2 * 1 + 5 * 0.5) / 1.5
    land(spark, src, (0, 1, "q", 1.0))  # again: nothing new
    assert len(run()) == 3
    land(spark, src, (9, 7, "p", None))  # a cell of no catchment, a week on: day 1 of b will not become whole
    got = run()
    assert got[1] == ("b", 1, None, None, False) and len(got) == 4
    land(spark, src, (1, 1, "p", 5.0), (0, 0, "p", 5.0))  # behind the watermark
    assert run() == got


def test_null_cells_poison_a_whole_step(spark, tmp_dir):
    cov = spark.createDataFrame([("b", "c", 0, 0, 0, 1.0), ("b", "c", 1, 0, 1, 1.0)],
                                "basin_id string, divide_id string, cell_id long, iy long, ix long, coverage double")
    land(spark, f"{tmp_dir}/src", (0, 0, "p", 2.0), (0, 1, "p", None))
    stateful.ingest_pieces(spark, f"{tmp_dir}/src", ROWS, cov, ["p"], f"{tmp_dir}/out", f"{tmp_dir}/ck")
    r = daily.read_output(spark, f"{tmp_dir}/out").collect()
    assert [(x.p, x.complete) for x in r] == [(None, True)]


def test_rows_are_added_up_before_the_shuffle():
    t = pa.table({"basin_id": ["b"] * 4, "divide_id": ["c"] * 4, "ms": [0, 0, 0, 5], "variable": pa.array([0, 0, 0, 0], pa.int32()),
                  "value": [2.0, None, 4.0, 1.0], "coverage": [1.0, 1.0, 0.5, 1.0], "n_cells": [3, 3, 3, 3]})
    out = pa.Table.from_batches(list(stateful._add_up(t.to_batches()))).to_pylist()
    assert out[0] == {"basin_id": "b", "divide_id": "c", "ms": 0, "variable": 0, "s": 4.0, "c": 1.5, "n": 2, "seen": 3, "n_cells": 3}
    assert out[1]["s"] == pytest.approx(1.0) and len(out) == 2
