"""Ranges of ids, gaps, and automatic filling."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillspark.operators import control, coverage

AT = datetime(2025, 3, 4, 5, 6, 7)


def ranges(ids):
    out = []
    for i in sorted(ids):
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("bits", [20, 4, 1])
@pytest.mark.parametrize("kind", ["random", "none", "all", "borders", "long"])
def test_ranges_and_gaps(spark, monkeypatch, bits, kind):
    monkeypatch.setattr(coverage, "SPAN_BITS", bits)
    start, end = 5, 300
    rng = random.Random(bits)
    ids = {
        "random": [rng.randrange(-20, 400) for _ in range(250)], "none": [], "all": list(range(-5, 500)), "borders": [15, 16, 17, 31, 32, 63, 64, 5, 300, 299],
        "long": [*range(20, 200), *range(202, 300)],
    }[kind]
    df = spark.createDataFrame([(str(i),) for i in [*ids, *ids[:5]]] + [("x",), (None,)], "id string")
    own = {i for i in ids if start <= i <= end}
    assert sorted(map(tuple, coverage.islands(df, start, end).collect())) == ranges(own)
    lacking = [i for i in range(start, end + 1) if i not in own]
    gaps = coverage.gap_ranges(df, start, end)
    assert sorted(map(tuple, gaps.collect())) == ranges(lacking)
    for limit in (1, 7, 1000):
        assert sorted(r["id"] for r in coverage.first_gaps(gaps, limit).collect()) == lacking[:limit]
    assert coverage.gap_ranges(df, 10, 9).collect() == [] and coverage.islands(df, 10, 9).collect() == []


CONFIG = "source_id long, enabled boolean, frontier_start long, batch_size long, last_job_id long, last_run_at timestamp_ntz, updated_at timestamp_ntz"
JOBS = "id long, source_id long, type string, status string, planning_status string, configuration string, discovered_count long, succeeded_count long, failed_count long, skipped_count long, created_at timestamp_ntz, updated_at timestamp_ntz"
TASKS = "id long, job_id long, source_work_id string, status string, attempts int, available_at timestamp_ntz, updated_at timestamp_ntz"


def test_automatic_filling(spark):
    sources = spark.createDataFrame([(1, False), (2, True)], "id long, paused boolean")
    none, jobs, tasks = (spark.createDataFrame([], s) for s in (CONFIG, JOBS, TASKS))
    now = F.lit(AT)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")

    def run(configs, jobs, tasks, handled, sources=sources):
        return control.auto_fill(sources, configs, jobs, tasks, handled, 7, 100, now)

    assert run(none, jobs, tasks, ids())[3] == "disabled" and run(none, jobs, tasks, ids(), sources.limit(0))[3] == "no_source" and run(none, jobs, tasks, ids(), sources.filter("id = 2"))[3] == "paused"
    off = control.update_auto_fill(none, 1, now, batch=3)
    assert tuple(off.first())[:4] == (1, False, 1, 3)
    on = control.update_auto_fill(off, 1, now, enabled=True, frontier=10)
    assert tuple(on.first())[:4] == (1, True, 10, 3) and on.count() == 1
    configs, more, queued, done = run(on, jobs, tasks, ids(*range(10, 20), 21))
    assert done == "created" and [r["source_work_id"] for r in queued.orderBy("id").collect()] == ["20", "22", "23"]
    row = configs.first()
    assert (row["last_job_id"], row["last_run_at"], row["frontier_start"]) == (7, AT, 10)  # the stretch of 300 ids fits into one window, so the frontier stays
    assert more.first()["status"] == "queued" and run(configs, more, queued, ids())[3] == "busy"
    ended = more.withColumn("status", F.lit("completed"))
    assert run(configs, ended, queued, ids(*range(10, 20)))[3] == "created"
    many = spark.createDataFrame([(k, 7, str(k), "queued", 0, AT, AT) for k in range(7)], TASKS)
    assert run(configs, ended, many, ids())[3] == "full"
    configs, more, queued, done = run(on, jobs, tasks, ids(*range(1, 400)))
    assert done == "moved" and configs.first()["frontier_start"] == 310 and more.count() == 0
