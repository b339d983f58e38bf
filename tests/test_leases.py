"""Leases: transitions as functions of tables, and logs replayed in batch and as a stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quillspark.operators import queue
from quillspark.streaming import leases

NOW = datetime(2025, 1, 2, 3, 4, 5)
EVENTS = "key long, at timestamp, seq long, action string, args map<string,string>"


def at(minutes):
    return NOW + timedelta(minutes=minutes)


def micros(t):
    return int((t - datetime(1970, 1, 1)).total_seconds()) * 1_000_000


def task_tables(spark):
    jobs = spark.createDataFrame(
        [(k, s, "completed", None, None, 0, 0, 0, None) for k, s in enumerate(["running", "paused", "cancelled", "completed", "queued"], 1)],
        "id long, status string, planning_status string, planning_lease_expires_at timestamp, planning_error string, succeeded_count long, failed_count long, skipped_count long, completed_at timestamp",
    ).withColumn("updated_at", F.lit(at(-90)))
    tasks = spark.createDataFrame(
        [(k, k, "leased", 2, at(-9), at(-1), "w", "tok", None, None) for k in range(1, 6)] + [(6, 1, "leased", 1, at(-9), at(1), "w", "tok", None, None), (7, 1, "succeeded", 1, at(-9), None, None, None, None, None)],
        "id long, job_id long, status string, attempts int, available_at timestamp, lease_expires_at timestamp, leased_by string, lease_token string, last_error_code string, last_error_message string",
    ).withColumn("updated_at", F.lit(at(-90)))
    return jobs, tasks


def test_only_leases_of_live_jobs_are_reclaimed(spark):
    jobs, tasks = task_tables(spark)
    got = {r["id"]: r for r in queue.reclaim_expired(tasks, jobs, F.lit(NOW)).collect()}
    assert {k for k, r in got.items() if r["status"] == "retryable_failed"} == {1, 5}
    assert (got[1]["available_at"], got[1]["lease_token"], got[1]["last_error_code"], got[1]["last_error_message"], got[1]["attempts"]) == (NOW, None, "worker_lease_expired", "The worker lease expired before completion.", 2)


def test_held_tasks(spark):
    jobs, tasks = task_tables(spark)
    now = F.lit(NOW)

    def one(df, k=6):
        return df.filter(F.col("id") == k).first()

    assert one(queue.heartbeat(tasks, 6, "tok", now))["lease_expires_at"] == NOW + timedelta(seconds=120)
    assert one(queue.heartbeat(tasks, 6, "other", now)) == one(tasks)
    put_back = one(queue.defer(tasks, 6, "tok", F.lit(at(5)), "daily_budget", now))
    assert (put_back["status"], put_back["attempts"], put_back["available_at"], put_back["last_error_code"], put_back["lease_token"]) == ("queued", 1, at(5), "daily_budget", None)
    assert one(queue.defer(tasks, 6, "other", F.lit(at(5)), "x", now)) == one(tasks)
    done = one(queue.complete(tasks, 6, "tok", now, "succeeded", "x", "y"))
    assert (done["status"], done["available_at"], done["last_error_code"], done["last_error_message"]) == ("succeeded", NOW, None, None)
    again = one(queue.complete(tasks, 6, "tok", now, "retryable_failed", "http", "503", F.lit(at(7))))
    assert (again["status"], again["available_at"], again["last_error_code"], again["last_error_message"]) == ("retryable_failed", at(7), "http", "503")
    for bad in (("done", None), ("succeeded", F.lit(NOW)), ("retryable_failed", None)):
        with pytest.raises(ValueError):
            queue.complete(tasks, 6, "tok", now, bad[0], available_at=bad[1])
    left = tasks.filter("id >= 6")
    t, j = queue.complete_task(left, jobs, 6, "tok", now, "not_found", code="gone")
    job = j.filter("id = 1").first()
    assert (one(t)["status"], job["status"], job["succeeded_count"], job["skipped_count"], job["completed_at"]) == ("not_found", "completed", 1, 1, NOW)
    assert j.filter("id <> 1").collect() == jobs.filter("id <> 1").collect()
    assert queue.complete_task(left, jobs, 6, "other", now, "succeeded") == (left, jobs)


def test_planning_leases(spark):
    jobs = spark.createDataFrame(
        [(1, 1, "running", "planning", "t", at(-1), 4, "x"), (2, 1, "paused", "planning", "t", at(-1), 4, None), (3, 1, "queued", "leased", "t", at(1), 4, None), (4, 2, "queued", "queued", None, None, None, None), (5, 1, "queued", "failed", None, None, None, "bad")],
        "id long, source_id long, status string, planning_status string, planning_lease_token string, planning_lease_expires_at timestamp, planning_cursor long, planning_error string",
    ).withColumn("updated_at", F.lit(at(-90)))
    sources = spark.createDataFrame([(1, False), (2, True)], "id long, paused boolean")
    now = F.lit(NOW)
    freed = {r["id"]: (r["planning_status"], r["planning_lease_token"], r["planning_error"]) for r in queue.reclaim_planning(jobs, now).collect()}
    assert freed == {1: ("queued", None, None), 2: ("planning", "t", None), 3: ("leased", "t", None), 4: ("queued", None, None), 5: ("failed", None, "bad")}
    taken = queue.claim_planning(jobs, sources, now, "new")
    assert [r["id"] for r in taken.filter("planning_lease_token = 'new'").collect()] == [1]
    moved = queue.advance_planning(taken, 1, "new", 9, now).filter("id = 1").first()
    assert (moved["planning_cursor"], moved["planning_lease_expires_at"]) == (9, NOW + timedelta(seconds=120))
    assert queue.advance_planning(taken, 1, "t", 9, now).filter("id = 1").first()["planning_cursor"] == 4
    assert queue.finish_planning(taken, 1, "new").filter("id = 1").first()["planning_status"] == "completed"
    assert queue.retry_planning(jobs, 5).filter("id = 5").first()["planning_status"] == "queued"


def test_pause_resume_reopen_cancel_clear(spark):
    jobs, tasks = task_tables(spark)
    now = F.lit(NOW)
    jobs = jobs.withColumn("planning_lease_token", F.lit("p"))
    state = lambda df, k=1: df.filter(F.col("id") == k).first()
    held = jobs.withColumn("planning_status", F.lit("planning"))
    paused = state(queue.pause_job(held, 1, now))
    assert (paused["status"], paused["planning_status"], paused["planning_lease_token"]) == ("paused", "queued", None)
    assert state(queue.pause_job(jobs, 4, now), 4)["status"] == "completed"
    assert state(queue.resume_job(jobs, 2, now), 2)["status"] == "running"
    assert [state(queue.reopen_job(jobs, k, now), k)["status"] for k in (3, 4)] == ["cancelled", "running"]
    open_ = tasks.withColumn("status", F.when(F.col("id") == 1, "queued").otherwise(F.col("status")))
    j, t = queue.cancel_job(jobs, open_, 1, now)
    assert (state(j)["status"], state(j)["completed_at"]) == ("cancelled", NOW)
    assert {r["id"]: r["status"] for r in t.filter("job_id = 1").collect()} == {1: "cancelled", 6: "leased", 7: "succeeded"}
    j, t = queue.clear_cancelled(jobs, tasks)
    assert sorted(r["id"] for r in j.collect()) == [1, 2, 4, 5] and t.filter("job_id = 3").count() == 0


RUNS = "id long, source_id long, package_id string, previous_package_id string, sequence_number long, status string, lease_token string, lease_expires_at timestamp, work_count long, archive_path string, archive_hash string, archive_bytes long, verified_at timestamp, error_message string, completed_at timestamp"


def run(id_, source, package, number, status, token=None, expires=None, before=None):
    return (id_, source, package, before, number, status, token, expires, None, None, None, None, None, None, None)


def test_export_leases(spark):
    sources = spark.createDataFrame([(1, None, None, 5), (2, "x", at(1), 1), (3, "old", at(-1), 7), (4, None, None, 2)], "id long, export_lease_token string, export_lease_expires_at timestamp, next_export_sequence long")
    runs = spark.createDataFrame([
        run(1, 1, "a", 3, "completed"), run(2, 1, "b", 4, "completed"), run(3, 1, "c", None, "queued"), run(4, 1, "d", None, "queued"), run(5, 2, "e", None, "queued"),
        run(6, 3, "f", 6, "writing", "old", at(-1), "before"), run(7, 3, "g", None, "queued"), run(8, 4, "h", 1, "failed"),
    ], RUNS)
    now = F.lit(NOW)
    leased, held = queue.claim_export(runs, sources, now, "t")
    got = {r["id"]: (r["sequence_number"], r["previous_package_id"], r["lease_expires_at"]) for r in leased.filter("lease_token = 't'").collect()}
    until = NOW + timedelta(seconds=300)
    assert got == {3: (5, "b", until), 6: (6, "before", until)}  # 6 keeps its number; source 2 is not free
    assert {r["id"]: (r["export_lease_token"], r["next_export_sequence"]) for r in held.collect()} == {1: ("t", 6), 2: ("x", 1), 3: ("t", 7), 4: (None, 2)}
    assert queue.claim_export(leased, held, now, "u")[0].filter("lease_token = 'u'").count() == 0
    later = F.lit(at(2))
    r, s = queue.heartbeat_export(leased, held, 3, "t", later)
    assert r.filter("id = 3").first()["lease_expires_at"] == at(2) + timedelta(seconds=300) and s.filter("id = 1").first()["export_lease_expires_at"] == at(2) + timedelta(seconds=300)
    r, s = queue.heartbeat_export(leased, held, 3, "u", later)
    assert r.collect() == leased.collect() and s.collect() == held.collect()
    writing = queue.begin_writing(leased, 3, "t")
    assert writing.filter("id = 3").first()["status"] == "writing" and queue.begin_writing(leased, 3, "u").filter("id = 3").first()["status"] == "leased"
    mine = held.filter("id = 1")
    r, s = queue.finish_export(writing, mine, 3, "t", now, 9, "p", "h", 70)
    x = r.filter("id = 3").first()
    assert (x["status"], x["work_count"], x["archive_hash"], x["archive_bytes"], x["verified_at"], x["lease_token"]) == ("completed", 9, "h", 70, NOW, None) and s.first()["export_lease_token"] is None
    assert [y["id"] for y in queue.claim_export(r, s, now, "v")[0].filter("lease_token = 'v'").collect()] == [4]
    assert queue.claim_export(r, s, now, "v")[0].filter("id = 4").first()["previous_package_id"] == "c"
    assert queue.finish_export(writing, mine, 3, "t", now)[0].filter("id = 3").first()["status"] == "empty"
    failed = queue.finish_export(writing, mine, 3, "t", now, error="E: x")[0].filter("id = 3").first()
    assert (failed["status"], failed["error_message"], failed["work_count"]) == ("failed", "E: x", None)
    assert queue.finish_export(writing, mine, 3, "u", now, 9)[0].filter("id = 3").first()["status"] == "writing"


def test_import_status(spark):
    runs = spark.createDataFrame([(1, "p", "not_imported", None, None, None), (2, "q", "not_imported", None, None, None)], "id long, package_id string, import_status string, import_started_at timestamp, imported_at timestamp, import_error string")
    row = lambda df: tuple(df.filter("id = 1").first())[2:]
    begun = queue.set_import_status(runs, "p", "importing", F.lit(NOW))
    assert row(begun) == ("importing", NOW, None, None) and begun.filter("id = 2").collect() == runs.filter("id = 2").collect()
    failed = queue.set_import_status(begun, "p", "failed", F.lit(at(1)))
    assert row(failed) == ("failed", NOW, None, queue.IMPORT_FAILED) and row(queue.set_import_status(begun, "p", "failed", F.lit(at(1)), "why"))[3] == "why"
    assert row(queue.set_import_status(failed, "p", "imported", F.lit(at(2)), "why")) == ("imported", NOW, at(2), None)
    with pytest.raises(ValueError):
        queue.set_import_status(runs, "p", "completed", F.lit(NOW))


def log(n=40, seed=4):
    """Events of many tasks in order of time, a minute apart."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        rows.append((rng.randrange(8), at(k * 0 + len(rows)), len(rows), "create", {}))
    for _ in range(12 * n):
        action = rng.choice(["claim", "claim", "heartbeat", "complete", "defer", "retry", "cancel", "nonsense"])
        args = {"token": rng.choice("ab"), "outcome": rng.choice(["succeeded", "retryable_failed", "terminal_failed", "not_found", "odd"]), "code": rng.choice(["x", "y"])}
        if rng.random() < 0.5:
            args["due"] = str(micros(at(len(rows) + rng.randrange(20))))
        rows.append((rng.randrange(8), at(len(rows)), len(rows), action, args))
    return rows


def test_one_task_by_hand(spark):
    rows = [
        (1, at(0), 0, "claim", {"token": "a"}), (1, at(0), 1, "create", {}), (1, at(1), 2, "claim", {"token": "a"}), (1, at(2), 3, "heartbeat", {"token": "b"}), (1, at(2), 4, "heartbeat", {"token": "a"}),
        (1, at(9), 5, "complete", {"token": "a", "outcome": "succeeded"}), (1, at(10), 6, "claim", {"token": "b"}), (1, at(11), 7, "defer", {"token": "b", "due": str(micros(at(20))), "code": "budget"}),
        (1, at(12), 8, "claim", {"token": "c"}), (1, at(20), 9, "claim", {"token": "c"}), (1, at(21), 10, "complete", {"token": "c", "outcome": "not_found", "code": "404"}), (1, at(22), 11, "claim", {"token": "c"}),
        (2, at(0), 0, "create", {}), (2, at(1), 1, "claim", {"token": "a"}), (None, at(1), 1, "create", {}), (3, at(1), 1, "create", None),
    ]
    got = leases.replay(spark.createDataFrame(rows, EVENTS), leases.Tasks(), micros(at(60))).collect()
    one = sorted(((r["at"], -1 if r["seq"] is None else r["seq"], r["action"], r["matched"], r["status"], r["attempts"]) for r in got if r["key"] == 1))
    assert [(a, m, s, n) for _, _, a, m, s, n in one] == [
        ("claim", False, None, None), ("create", True, "queued", 0), ("claim", True, "leased", 1), ("heartbeat", False, "leased", 1), ("heartbeat", True, "leased", 1), ("reclaim", True, "retryable_failed", 1),
        ("complete", False, "retryable_failed", 1), ("claim", True, "leased", 2), ("defer", True, "queued", 2), ("claim", False, "queued", 2), ("claim", True, "leased", 3), ("complete", True, "not_found", 3), ("claim", False, None, None),
    ]
    last = [r for r in got if r["key"] == 2][-1]
    assert (last["action"], last["at"], last["available_at"], last["last_error_code"]) == ("reclaim", at(3), at(3), "worker_lease_expired")
    assert leases.replay(spark.createDataFrame([], EVENTS), leases.Tasks(), 0).collect() == []


def test_exports_by_hand(spark):
    rows = [
        (1, at(0), 0, "request", {"run": "1", "package": "p1"}), (1, at(0), 1, "request", {"run": "2", "package": "p2"}), (1, at(1), 2, "claim", {"token": "a"}), (1, at(1), 3, "claim", {"token": "b"}),
        (1, at(2), 4, "write", {"run": "1", "token": "b"}), (1, at(2), 5, "write", {"run": "1", "token": "a"}), (1, at(7), 6, "claim", {"token": "b"}), (1, at(8), 7, "finish", {"run": "1", "token": "a", "works": "3"}),
        (1, at(8), 8, "finish", {"run": "1", "token": "b", "works": "3"}), (1, at(8), 9, "claim", {"token": "c"}), (1, at(9), 10, "heartbeat", {"run": "2", "token": "c"}), (1, at(10), 11, "fail", {"run": "2", "token": "c"}), (1, at(10), 12, "claim", {"token": "d"}),
    ]
    got = sorted(leases.replay(spark.createDataFrame(rows, EVENTS), leases.Exports()).collect(), key=lambda r: r["seq"])
    assert [(r["matched"], r["run"], r["status"], r["sequence_number"], r["previous_package"], r["next_sequence"]) for r in got] == [
        (True, 1, "queued", None, None, 1), (True, 2, "queued", None, None, 1), (True, 1, "leased", 1, None, 2), (False, None, None, None, None, 2), (False, None, None, None, None, 2), (True, 1, "writing", 1, None, 2),
        (True, 1, "leased", 1, None, 2), (False, None, None, None, None, 2), (True, 1, "completed", 1, None, 2), (True, 2, "leased", 2, "p1", 3), (True, 2, "leased", 2, "p1", 3), (True, 2, "failed", 2, "p1", 3), (False, None, None, None, None, 3),
    ]


@pytest.mark.parametrize("parts", [1, 7])
def test_stream_equals_batch(spark, tmp_path, parts):
    """The log arrives in several files, one micro-batch each; the last event is far ahead, so that the timers of all others fire."""
    rows = log()
    rows.append((99, at(100_000), len(rows), "create", {}))
    size = -(-len(rows) // parts)
    for k in range(parts):
        own = spark.createDataFrame(rows[k * size : (k + 1) * size], EVENTS)
        own.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", leases.STATE_STORE)
    try:
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        for _ in range(2):  # the second run goes on from the checkpoint and finds nothing new
            query = leases.replay_stream(stream, leases.Tasks()).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
            query.awaitTermination(120)
            assert query.exception() is None
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    whole = leases.replay(spark.createDataFrame(rows, EVENTS), leases.Tasks(), micros(at(90_000)))
    assert whole.filter("action = 'reclaim'").count() > 10
    assert sorted(map(repr, spark.read.parquet(f"{tmp_path}/out").select(whole.columns).collect())) == sorted(map(repr, whole.collect()))
