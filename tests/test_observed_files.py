from catchflow import jobs
from catchflow.plans import q_io, views


def test_observed_series_is_written_by_many_tasks(spark, monkeypatch):
    parts, job, series = [], jobs.evaluation_job, views.series

    def counted(s, nexus_root, obs_root):
        files = s.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(obs_root)
        parts.append(files.count())
        return job(s, nexus_root, obs_root)
    monkeypatch.setattr(jobs, "evaluation_job", counted)
    monkeypatch.setattr(views, "series", lambda s, sf: series(s, sf).repartition(4))
    rows = q_io.evaluation_files(spark, "/root/testdata/sf0.001").collect()
    assert parts[0] > 1 and rows and {r["gage_id"] for r in rows} == {"01187300"}
