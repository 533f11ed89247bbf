"""Outputs published as one: manifests, compaction, vacuum, and the ledger of a killed run."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from catchflow import jobs, publish, sinks
from catchflow.operators import ledger
from catchflow.plans import views
from catchflow.plans.q_sources import write_raster_stores
from catchflow.sources import containers
from small_tables import SF_SMALL

SCHEMA = "time string, v double, basin_id string"


def _stage(spark, root, run, rows):
    df = spark.createDataFrame(rows, "basin_id string, time timestamp_ntz, v double")
    sinks.write_basin_series(df, publish.staged(root, run, "basin"))
    return df.select("basin_id").distinct()


def _seen(spark, root):
    return sorted((r["basin_id"], r["v"]) for r in publish.published(spark, root, "basin", SCHEMA).collect())


def _at(spark):
    import datetime as dt
    return dt.datetime(2001, 1, 1)


def test_nothing_counts_before_its_manifest(spark, tmp_dir):
    t = _at(spark)
    assert _seen(spark, tmp_dir) == []
    one = publish.begin(spark, tmp_dir)
    ids = _stage(spark, tmp_dir, one, [("01", t, 1.0), ("02", t, 2.0)])
    assert _seen(spark, tmp_dir) == []
    publish.commit(ids, tmp_dir, one)
    assert _seen(spark, tmp_dir) == [("01", 1.0), ("02", 2.0)]  # ids keep their zeros
    two = publish.begin(spark, tmp_dir)
    assert two > one
    ids = _stage(spark, tmp_dir, two, [("02", t, 20.0), ("03", t, 30.0)])
    os.makedirs(f"{tmp_dir}/manifest/{two}")  # a manifest that was begun and not closed
    assert _seen(spark, tmp_dir) == [("01", 1.0), ("02", 2.0)]
    three = publish.begin(spark, tmp_dir)
    ids = _stage(spark, tmp_dir, three, [("02", t, 20.0), ("03", t, 30.0)])
    publish.commit(ids, tmp_dir, three)
    assert _seen(spark, tmp_dir) == [("01", 1.0), ("02", 20.0), ("03", 30.0)]


def test_a_basin_without_rows_in_its_latest_run_has_none(spark, tmp_dir):
    t = _at(spark)
    one, ids = publish.begin(spark, tmp_dir), None
    ids = _stage(spark, tmp_dir, one, [("a", t, 1.0), ("b", t, 2.0)])
    publish.commit(ids, tmp_dir, one)
    two = publish.begin(spark, tmp_dir)
    _stage(spark, tmp_dir, two, [("b", t, 3.0)])
    publish.commit(ids.union(spark.createDataFrame([(None,)], "basin_id string")), tmp_dir, two)
    assert _seen(spark, tmp_dir) == [("b", 3.0)]
    assert publish.published(spark, tmp_dir, "dense", SCHEMA).count() == 0  # an output nobody wrote


def test_compaction_and_vacuum_change_nothing_that_is_read(spark, tmp_dir):
    t = _at(spark)
    runs = []
    for i in range(3):
        runs.append(publish.begin(spark, tmp_dir))
        ids = _stage(spark, tmp_dir, runs[-1], [("a", t, float(i)), (f"b{i}", t, float(i))] if i < 2 else [("b0", t, 9.0)])
        publish.commit(ids, tmp_dir, runs[-1])
    dead = publish.begin(spark, tmp_dir)
    _stage(spark, tmp_dir, dead, [("a", t, 77.0)])
    before = _seen(spark, tmp_dir)
    assert before == [("a", 1.0), ("b0", 9.0), ("b1", 1.0)]
    assert publish.compact(spark, tmp_dir) == 3 and publish.compact(spark, tmp_dir) == 0
    assert len(os.listdir(f"{tmp_dir}/manifest")) == 1 and _seen(spark, tmp_dir) == before
    assert publish.vacuum(spark, tmp_dir) == []  # too young
    assert publish.vacuum(spark, tmp_dir, hours=0) == [runs[0], dead] and _seen(spark, tmp_dir) == before
    assert publish.begin(spark, tmp_dir) > dead


def test_ledger_compaction_keeps_first_lines(spark, tmp_dir):
    path = f"{tmp_dir}/ledger"
    assert ledger.compact(spark, path) == 0
    ids = spark.createDataFrame([("a",), ("b",), ("c d",)], "basin_id string")
    ledger.record(ids, path, "processing")
    ledger.record(ids.limit(2), path, "finished")
    before = sorted(map(tuple, ledger.read_ledger(spark, path).collect()))
    assert ledger.compact(spark, path) > 1
    assert sorted(map(tuple, ledger.read_ledger(spark, path).collect())) == before
    left = ledger.pending(ids, ledger.read_ledger(spark, path)).collect()
    assert [r["basin_id"] for r in left] == ["c d"]


@pytest.mark.parametrize("kill", ["basin", "published"])
def test_killed_job_then_resumed(spark, tmp_dir, kill):
    years = write_raster_stores(spark, SF_SMALL, f"{tmp_dir}/stores", dtype="<f8")
    containers.write_divides(views.divides(spark, SF_SMALL).where(F.col("basin_id") < "2"), f"{tmp_dir}/gpkg")
    steps = []

    def run(on_step=None):
        return jobs.forcing_job(spark, f"{tmp_dir}/stores/{{year}}", (years[0], years[0] + 1), ["qty"], f"{tmp_dir}/gpkg", views.GRID,
                                f"{tmp_dir}/out", f"{tmp_dir}/ledger", cache=f"{tmp_dir}/cache", on_step=on_step)

    def stop(name):
        steps.append(name)
        if name == kill:
            raise InterruptedError(name)
    with pytest.raises(InterruptedError):
        run(stop)
    seen = jobs.forcing_output(spark, f"{tmp_dir}/out", "basin", ["qty"]).count()
    assert (seen > 0) == (kill == "published")
    done = []
    whole = run(done.append)
    assert whole.count() > 0 and (seen in (0, whole.count()))
    # a run that was killed after it published isn't done again: only its ledger lines are added
    assert done == ([] if kill == "published" else ["catchment", "basin", "dense", "published"])
    lines = ledger.read_ledger(spark, f"{tmp_dir}/ledger").where("status = 'finished'")
    assert lines.count() == lines.select("basin_id").distinct().count() == whole.select("basin_id").distinct().count()
    with pytest.raises(ValueError):
        jobs.forcing_output(spark, f"{tmp_dir}/out", "dense", ["qty"])
