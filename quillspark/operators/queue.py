"""Work queues as tables: every transition is a function (state, ..., now) -> new state.

Tables are jobs (id, source_id, status, planning_status, ...), tasks (id, job_id, source_work_id, status,
attempts, available_at, lease columns, ...), sources and export runs; see the column names below. ``now`` is a
timestamp column or literal and never read from the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .relational import unused

# States of tasks and jobs, lease times, thresholds.
OPEN_TASKS = ("queued", "leased", "retryable_failed")
TASK_LEASE_SECONDS = 120
EXPORT_LEASE_SECONDS = 300
STALL_MINUTES = 30
STALL_ROWS = 200
DELETABLE = ("completed", "cancelled", "failed")
LEASE_EXPIRED = "worker_lease_expired"
LEASE_EXPIRED_MESSAGE = "The worker lease expired before completion."
IMPORT_STATES = ("not_imported", "importing", "imported", "failed")
IMPORT_FAILED = "the import failed"
OUTCOMES = ("succeeded", "not_found", "retryable_failed", "terminal_failed")


def _after(now: Column, seconds: int) -> Column:
    return now + F.expr(f"INTERVAL {seconds} SECONDS")


def set_where(df: DataFrame, where: Column, **values: Column) -> DataFrame:
    """Rewrite columns of the rows that meet a condition; all values see the old row."""
    hit = F.coalesce(where, F.lit(False))
    kinds = dict(df.dtypes)
    return df.select(*[F.when(hit, values[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def claimable(tasks: DataFrame, jobs: DataFrame, sources: DataFrame, now: Column) -> DataFrame:
    """Tasks that a worker may take: open and due, or with an expired lease, of a job and a source that are not held."""
    running = jobs.filter(F.col("status").isin("queued", "running")).select(F.col("id").alias("job_id"), "source_id")
    awake = sources.filter(~F.col("paused")).select(F.col("id").alias("source_id"))
    due = (F.col("status").isin("queued", "retryable_failed") & (F.col("available_at") <= now)) | ((F.col("status") == "leased") & (F.col("lease_expires_at") <= now))
    return tasks.filter(due).join(running, "job_id").join(awake, "source_id", "left_semi")


def claim_tasks(tasks: DataFrame, jobs: DataFrame, sources: DataFrame, now: Column, worker: str, token: str, n: int = 1) -> tuple[DataFrame, DataFrame]:
    """Lease the n (1 to 100) tasks that have waited longest. Returns tasks and jobs."""
    if not 1 <= n <= 100:
        raise ValueError("1 to 100 tasks can be claimed at once")
    taken = claimable(tasks, jobs, sources, now).orderBy("available_at", "id").limit(n).select("id", "job_id")
    marked = tasks.join(F.broadcast(taken.select("id", F.lit(True).alias("__got"))), "id", "left")  # at most 100 rows
    claimed = set_where(marked, F.col("__got"), status=F.lit("leased"), leased_by=F.lit(worker), lease_token=F.lit(token), lease_expires_at=_after(now, TASK_LEASE_SECONDS), attempts=F.col("attempts") + 1, updated_at=now)
    begun = jobs.join(F.broadcast(taken.select(F.col("job_id").alias("id"), F.lit(True).alias("__got")).distinct()), "id", "left")
    started = set_where(begun, F.col("__got"), status=F.when(F.col("status") == "queued", "running").otherwise(F.col("status")), started_at=F.coalesce("started_at", now))
    return claimed.drop("__got").select(tasks.columns), started.drop("__got").select(jobs.columns)


def _held(task_id: int, token: str) -> Column:
    return (F.col("id") == task_id) & (F.col("status") == "leased") & (F.col("lease_token") == token)


def heartbeat(tasks: DataFrame, task_id: int, token: str, now: Column) -> DataFrame:
    return set_where(tasks, _held(task_id, token), lease_expires_at=_after(now, TASK_LEASE_SECONDS), updated_at=now)


def complete(tasks: DataFrame, task_id: int, token: str, now: Column, outcome: str, code: str | None = None, message: str | None = None, available_at: Column | None = None) -> DataFrame:
    """End a held task as succeeded, not_found, retryable_failed (due again at ``available_at``) or terminal_failed. Only a task that is to be tried
    again has a time to come, the others have now; one that succeeded has no error. A token that does not hold the task changes nothing."""
    if outcome not in OUTCOMES or (outcome == "retryable_failed") != (available_at is not None):
        raise ValueError("an outcome is one of OUTCOMES, and only retryable_failed has a time")
    empty, good = F.lit(None), outcome == "succeeded"
    return set_where(
        tasks, _held(task_id, token), status=F.lit(outcome), leased_by=empty, lease_token=empty, lease_expires_at=empty, available_at=now if available_at is None else available_at, updated_at=now,
        last_error_code=F.lit(None if good else code), last_error_message=F.lit(None if good else message),
    )


def complete_task(tasks: DataFrame, jobs: DataFrame, task_id: int, token: str, now: Column, outcome: str, **more) -> tuple[DataFrame, DataFrame]:
    """``complete``, and the counters and status of the task's job. Returns tasks and jobs, as they were if the token does not hold the task."""
    held = tasks.filter(_held(task_id, token)).select("job_id").first()
    if held is None:
        return tasks, jobs
    done = complete(tasks, task_id, token, now, outcome, **more)
    return done, recompute_jobs(jobs, done.filter(F.col("job_id") == held["job_id"]), now, F.col("id") == held["job_id"])


def defer(tasks: DataFrame, task_id: int, token: str, until: Column, reason: str, now: Column) -> DataFrame:
    """Give a held task back, due later, with the reason as its last error; the attempt counts."""
    empty = F.lit(None)
    return set_where(
        tasks, _held(task_id, token), status=F.lit("queued"), leased_by=empty, lease_token=empty, lease_expires_at=empty, available_at=until, updated_at=now, last_error_code=F.lit(reason), last_error_message=empty,
    )


def reclaim_expired(tasks: DataFrame, jobs: DataFrame, now: Column) -> DataFrame:
    """Tasks of queued and running jobs whose lease has run out may be tried again at once; those of other jobs stay as they are."""
    empty = F.lit(None)
    live = jobs.filter(F.col("status").isin("queued", "running")).select(F.col("id").alias("job_id"), F.lit(True).alias("__live"))
    gone = (F.col("status") == "leased") & (F.col("lease_expires_at") <= now) & F.col("__live")
    return set_where(
        tasks.join(live, "job_id", "left"), gone, status=F.lit("retryable_failed"), leased_by=empty, lease_token=empty, lease_expires_at=empty, available_at=now, updated_at=now,
        last_error_code=F.lit(LEASE_EXPIRED), last_error_message=F.lit(LEASE_EXPIRED_MESSAGE),
    ).select(tasks.columns)


def reclaim_planning(jobs: DataFrame, now: Column) -> DataFrame:
    """Planning of queued and running jobs whose planner's lease has run out waits again."""
    empty = F.lit(None)
    gone = F.col("planning_status").isin("planning", "leased") & (F.col("planning_lease_expires_at") <= now) & F.col("status").isin("queued", "running")
    values = {"planning_status": F.lit("queued"), "planning_lease_token": empty, "planning_lease_expires_at": empty, "planning_error": empty, "updated_at": now}
    return set_where(jobs, gone, **{c: v for c, v in values.items() if c in jobs.columns})


def task_stats(tasks: DataFrame) -> DataFrame:
    """(job_id, total, pending, succeeded, failed, skipped) of each job's tasks; cancelled and missing ones are skipped."""
    s = F.col("status")
    return tasks.groupBy("job_id").agg(
        F.count("*").alias("total"), F.count_if(s.isin(*OPEN_TASKS)).alias("pending"), F.count_if(s == "succeeded").alias("succeeded"),
        F.count_if(s == "terminal_failed").alias("failed"), F.count_if(s.isin("cancelled", "not_found")).alias("skipped"),
    )


def recompute_jobs(jobs: DataFrame, tasks: DataFrame, now: Column, which: Column | None = None) -> DataFrame:
    """Counters and status of jobs (None: all) from their tasks. A job without open tasks is completed, whatever it was,
    unless it was cancelled; a cancelled one with open tasks runs on. completed_at is now or null."""
    stats = task_stats(tasks).withColumnRenamed("job_id", "id")
    joined = jobs.join(stats, "id", "left").fillna(0, ["total", "pending", "succeeded", "failed", "skipped"])
    over, cancelled = F.col("pending") == 0, F.col("status") == "cancelled"
    status = F.when(cancelled & over, "cancelled").when(over, "completed").when(cancelled, "running").otherwise(F.col("status"))
    return set_where(
        joined, F.lit(True) if which is None else which, succeeded_count=F.col("succeeded"), failed_count=F.col("failed"), skipped_count=F.col("skipped"),
        status=status, completed_at=F.when(over, now), updated_at=now,
    ).select(jobs.columns)


def numbered(df: DataFrame, first: int, *order: str) -> DataFrame:
    """``df`` with ``id`` (in place of its own): its rows numbered from ``first`` on in the given order. They are dealt out by ranges and numbered within them;
    only the ranges' sizes are added up in one place, so no task needs all rows of one key."""
    checkpoint_dir(df.sparkSession)
    place, part, base = unused(df, "__at"), unused(df, "__part"), unused(df, "__base")
    at = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()).checkpoint()
    own = F.shiftright(place, 33)
    sizes = at.groupBy(own.alias("p")).count().orderBy("p").collect()  # a row a partition
    bases, number = [], first
    for r in sizes:
        bases.append((r["p"], number - (r["p"] << 33)))
        number += r["count"]
    known = df.sparkSession.createDataFrame(bases, f"{part} long, {base} long")
    return at.join(F.broadcast(known), own == F.col(part)).withColumn("id", F.col(place) + F.col(base)).drop(place, part, base)


def enqueue(tasks: DataFrame, new: DataFrame, now: Column, first_id: int) -> DataFrame:
    """Add tasks (job_id, source_work_id) that are not there yet, each once; ids go on from ``first_id`` by job and work."""
    fresh = new.select("job_id", "source_work_id").distinct().join(tasks.select("job_id", "source_work_id"), ["job_id", "source_work_id"], "left_anti")
    rows = numbered(fresh, first_id, "job_id", "source_work_id")
    full = rows.withColumns({"status": F.lit("queued"), "attempts": F.lit(0), "available_at": now, "updated_at": now})
    return tasks.unionByName(full, allowMissingColumns=True).select(tasks.columns)


def claim_planning(jobs: DataFrame, sources: DataFrame, now: Column, token: str) -> DataFrame:
    """Lease the oldest job that waits for planning, or whose planner's lease ran out, unless its source is paused."""
    awake = sources.filter(~F.col("paused")).select(F.col("id").alias("source_id"))
    waits = F.col("status").isin("queued", "running") & ((F.col("planning_status") == "queued") | ((F.col("planning_status") == "planning") & (F.col("planning_lease_expires_at") <= now)))
    first = jobs.filter(waits).join(awake, "source_id", "left_semi").orderBy("id").limit(1).select("id", F.lit(True).alias("__got"))
    marked = jobs.join(F.broadcast(first), "id", "left")  # one row
    return set_where(marked, F.col("__got"), planning_status=F.lit("planning"), planning_lease_token=F.lit(token), planning_lease_expires_at=_after(now, TASK_LEASE_SECONDS)).select(jobs.columns)


def finish_planning(jobs: DataFrame, job_id: int, token: str, ok: bool = True) -> DataFrame:
    held = (F.col("id") == job_id) & (F.col("planning_lease_token") == token)
    return set_where(jobs, held, planning_status=F.lit("completed" if ok else "failed"), planning_lease_token=F.lit(None), planning_lease_expires_at=F.lit(None))


def advance_planning(jobs: DataFrame, job_id: int, token: str, cursor: int, now: Column) -> DataFrame:
    held = (F.col("id") == job_id) & (F.col("planning_lease_token") == token)
    return set_where(jobs, held, planning_cursor=F.lit(cursor), planning_lease_expires_at=_after(now, TASK_LEASE_SECONDS))


def retry_planning(jobs: DataFrame, job_id: int) -> DataFrame:
    return set_where(jobs, (F.col("id") == job_id) & (F.col("planning_status") == "failed"), planning_status=F.lit("queued"))


def stalled_jobs(jobs: DataFrame, tasks: DataFrame, sources: DataFrame, now: Column) -> DataFrame:
    """(id, source_id, stall): why jobs that are queued or running have not changed for STALL_MINUTES: source_paused,
    planning_stalled (planned in part or not at all), retry_backoff or worker_stalled (tasks wait, none or some are due). Jobs
    with none of these are left out; the STALL_ROWS oldest quiet jobs are looked at."""
    s = F.col("status")
    quiet = jobs.filter(s.isin("queued", "running") & (F.col("updated_at") <= now - F.expr(f"INTERVAL {STALL_MINUTES} MINUTES"))).orderBy("id").limit(STALL_ROWS)
    own = tasks.filter(s.isin("queued", "retryable_failed")).groupBy("job_id").agg(F.count_if(F.col("available_at") <= now).alias("due")).withColumnRenamed("job_id", "id")
    held = sources.select(F.col("id").alias("source_id"), "paused")
    joined = quiet.join(own, "id", "left").join(held, "source_id", "left")
    why = (
        F.when(F.coalesce("paused", F.lit(False)), "source_paused").when(F.col("planning_status") != "completed", "planning_stalled")
        .when(F.col("due") > 0, "worker_stalled").when(F.col("due") == 0, "retry_backoff")
    )
    return joined.select("id", "source_id", why.alias("stall")).filter("stall is not null")


def heal_cancelled(jobs: DataFrame, tasks: DataFrame, now: Column) -> DataFrame:
    """Cancelled jobs that never ended although a planner held them or tasks wait run again; planning that was not complete is queued."""
    waiting = tasks.filter(F.col("status").isin("queued", "retryable_failed")).select(F.col("job_id").alias("id")).distinct().withColumn("__open", F.lit(True))
    marked = jobs.join(waiting, "id", "left")
    wrong = (F.col("status") == "cancelled") & F.col("completed_at").isNull() & (F.col("planning_status").isin("planning", "leased") | F.coalesce("__open", F.lit(False)))
    planning = F.when(F.col("planning_status") == "completed", "completed").otherwise("queued")
    return set_where(marked, wrong, status=F.lit("running"), completed_at=F.lit(None), planning_status=planning, planning_error=F.lit(None), updated_at=now).select(jobs.columns)


def pause_job(jobs: DataFrame, job_id: int, now: Column) -> DataFrame:
    """A planner that holds the job loses it."""
    held = F.col("planning_status").isin("leased", "planning")
    return set_where(
        jobs, (F.col("id") == job_id) & F.col("status").isin("queued", "running"), status=F.lit("paused"), updated_at=now,
        planning_status=F.when(held, "queued").otherwise(F.col("planning_status")), **{c: F.when(~held, F.col(c)) for c in ("planning_lease_token", "planning_lease_expires_at") if c in jobs.columns},
    )


def resume_job(jobs: DataFrame, job_id: int, now: Column) -> DataFrame:
    return set_where(jobs, F.col("id") == job_id, status=F.lit("running"), updated_at=now)


def retry_failures(tasks: DataFrame, job_id: int | None, now: Column) -> DataFrame:
    """Failed tasks of a job (None: of all) are queued again with no attempts made; ``reopen_job`` is the job's part of it."""
    failed, empty = F.col("status") == "terminal_failed", F.lit(None)
    return set_where(
        tasks, failed if job_id is None else failed & (F.col("job_id") == job_id), status=F.lit("queued"), attempts=F.lit(0), available_at=now,
        lease_expires_at=empty, leased_by=empty, last_error_code=empty, last_error_message=empty, updated_at=now,
    )


def reopen_job(jobs: DataFrame, job_id: int, now: Column) -> DataFrame:
    again = (F.col("id") == job_id) & F.col("status").isin("completed", "failed", "paused", "running")
    return set_where(jobs, again, status=F.lit("running"), completed_at=F.lit(None), updated_at=now)


def cancel_job(jobs: DataFrame, tasks: DataFrame, job_id: int, now: Column) -> tuple[DataFrame, DataFrame]:
    """The job ends, planning too; tasks that wait are cancelled, those that a worker holds are left to it."""
    empty = F.lit(None)
    stopped = set_where(tasks, (F.col("job_id") == job_id) & F.col("status").isin("queued", "retryable_failed"), status=F.lit("cancelled"), lease_expires_at=empty, leased_by=empty, updated_at=now)
    ended = set_where(jobs, F.col("id") == job_id, status=F.lit("cancelled"), planning_status=F.lit("completed"), planning_lease_token=empty, planning_lease_expires_at=empty, completed_at=now, updated_at=now)
    return ended, stopped


def delete_job(jobs: DataFrame, tasks: DataFrame, job_id: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Jobs and tasks without an ended job, and one row (outcome): deleted, not_found or not_deletable."""
    state = jobs.filter(F.col("id") == job_id).agg(F.max("status").alias("s"))
    outcome = state.select(F.when(F.col("s").isNull(), "not_found").when(F.col("s").isin(*DELETABLE), "deleted").otherwise("not_deletable").alias("outcome"))
    goes = jobs.filter((F.col("id") == job_id) & F.col("status").isin(*DELETABLE)).select("id")
    return jobs.join(goes, "id", "left_anti"), tasks.join(goes.withColumnRenamed("id", "job_id"), "job_id", "left_anti"), outcome


def clear_cancelled(jobs: DataFrame, tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    goes = jobs.filter("status = 'cancelled'").select(F.col("id").alias("job_id"))
    return jobs.filter("status <> 'cancelled'"), tasks.join(goes, "job_id", "left_anti")


def display_status(status: Column, planning: Column) -> Column:
    return F.when(planning == "failed", "planning_failed").when(planning.isin("queued", "planning") & status.isin("queued", "running"), "planning").otherwise(status)


def job_advice(count: Column, collect_ms: Column, planning_ms: Column, batch: Column) -> Column:
    """Warnings on a job's size, the gravest first."""
    day = 86_400_000.0
    return (
        F.when(count > 10_000_000, "too_many_ids").when(collect_ms > 365 * day, "over_a_year").when(collect_ms > 7 * day, "over_a_week")
        .when(planning_ms > 3_600_000.0, "long_planning").when(batch > 500, "large_batches").otherwise("none")
    )


def _waits(now: Column) -> Column:
    """Whether an export run can be taken: it is queued, or its lease ran out."""
    return (F.col("status") == "queued") | (F.col("status").isin("leased", "writing") & (F.col("lease_expires_at") <= now))


def claim_export(runs: DataFrame, sources: DataFrame, now: Column, token: str) -> tuple[DataFrame, DataFrame]:
    """For each source that is free and has runs that wait: lease the oldest. A run that never was leased gets the source's next number and
    is told its predecessor, the completed run of highest number; one whose lease ran out keeps both. Returns runs and sources."""
    free = sources.filter(F.col("export_lease_expires_at").isNull() | (F.col("export_lease_expires_at") <= now)).select(F.col("id").alias("source_id"), "next_export_sequence")
    first = runs.filter(_waits(now)).groupBy("source_id").agg(F.min("id").alias("id"), F.min_by(F.col("sequence_number").isNull(), "id").alias("__new")).join(free, "source_id")
    last = runs.filter("status = 'completed'").groupBy("source_id").agg(F.max_by("package_id", "sequence_number").alias("__previous"))
    picked = first.join(last, "source_id", "left").select("id", "__new", F.col("next_export_sequence").alias("__sequence"), "__previous", F.lit(True).alias("__got"))
    until = _after(now, EXPORT_LEASE_SECONDS)
    leased = set_where(
        runs.join(picked, "id", "left"), F.col("__got"), status=F.lit("leased"), lease_token=F.lit(token), lease_expires_at=until,
        sequence_number=F.when(F.col("__new"), F.col("__sequence")).otherwise(F.col("sequence_number")), previous_package_id=F.when(F.col("__new"), F.col("__previous")).otherwise(F.col("previous_package_id")),
    )
    marked = sources.join(first.select(F.col("source_id").alias("id"), F.col("__new").cast("int").alias("__more"), F.lit(True).alias("__got")), "id", "left")
    held = set_where(marked, F.col("__got"), export_lease_token=F.lit(token), export_lease_expires_at=until, next_export_sequence=F.col("next_export_sequence") + F.col("__more"))
    return leased.select(runs.columns), held.select(sources.columns)


def _holds_export(run_id: int, token: str) -> Column:
    return (F.col("id") == run_id) & (F.col("lease_token") == token)


def heartbeat_export(runs: DataFrame, sources: DataFrame, run_id: int, token: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """A run that is held and its source keep their leases longer. Returns runs and sources."""
    until, held = _after(now, EXPORT_LEASE_SECONDS), _holds_export(run_id, token) & F.col("status").isin("leased", "writing")
    known = runs.filter(held).select(F.lit(True).alias("__held")).limit(1)
    marked = sources.join(F.broadcast(known), F.col("export_lease_token") == token, "left")
    return set_where(runs, held, lease_expires_at=until), set_where(marked, F.col("__held"), export_lease_expires_at=until).select(sources.columns)


def begin_writing(runs: DataFrame, run_id: int, token: str) -> DataFrame:
    return set_where(runs, _holds_export(run_id, token) & (F.col("status") == "leased"), status=F.lit("writing"))


def finish_export(runs: DataFrame, sources: DataFrame, run_id: int, token: str, now: Column, works: int = 0, path: str | None = None, digest: str | None = None, size: int | None = None, error: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A run that the token holds ends: failed with its error, completed with its archive, or empty without works. The source is free again
    for the next export. Returns runs and sources."""
    empty = F.lit(None)
    values = {"status": F.lit("failed" if error is not None else "completed" if works else "empty"), "completed_at": now, "lease_token": empty, "lease_expires_at": empty}
    if error is not None:
        values["error_message"] = F.lit(error)
    else:
        values["work_count"] = F.lit(works)
    if works and error is None:
        values |= {"archive_path": F.lit(path), "archive_hash": F.lit(digest), "archive_bytes": F.lit(size), "verified_at": now}
    ended = set_where(runs, _holds_export(run_id, token), **{c: v for c, v in values.items() if c in runs.columns})
    return ended, set_where(sources, F.col("export_lease_token") == token, export_lease_token=empty, export_lease_expires_at=empty)


def set_import_status(runs: DataFrame, package_id: str, status: str, now: Column, error: str | None = None, run_id: str | None = None) -> DataFrame:
    """Note how the import of a package goes: not_imported, importing, imported or failed. What earlier transitions set is cleared but for the start; a failure without
    a reason has IMPORT_FAILED."""
    if status not in IMPORT_STATES:
        raise ValueError(f"an import is one of {', '.join(IMPORT_STATES)}")
    values = {
        "import_status": F.lit(status), "imported_at": now if status == "imported" else F.lit(None), "import_error": F.lit((error or IMPORT_FAILED) if status == "failed" else None),
        "import_run_id": F.lit(run_id), "updated_at": now,
    }
    if status == "importing":
        values["import_started_at"] = now
    return set_where(runs, F.col("package_id") == package_id, **{k: v for k, v in values.items() if k in runs.columns})
