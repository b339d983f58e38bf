"""Jobs and sources as they are created, tag subscriptions, settings, reports: small tables that an operator changes.

As in ``queue``, every change is a function from tables to new tables, and ``now`` is given.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Files
from ..sources.packages import raw_pages
from . import extract, queue
from .coverage import BATCHES_AHEAD, MAX_TAG_PENDING, PENDING, filter_uncollected, find_gaps, next_cursor

#: Most ids that one planning request may span.
MAX_RANGE = 10_000_000
#: Rows of each part of a diagnostics bundle.
DIAGNOSTIC_JOBS = 100
DIAGNOSTIC_FAILURES = 100
DIAGNOSTIC_EVENTS = 200
DEFAULT_BATCH = 250
#: What a source without a configuration of automatic filling has.
AUTO_FILL = {"enabled": False, "frontier_start": 1, "batch_size": 200}

# Codes of errors that pass by themselves.
TRANSIENT_CODES = ("ER_LOCK_DEADLOCK", "ER_LOCK_WAIT_TIMEOUT", "1213", "1205", "PROTOCOL_CONNECTION_LOST", "ECONNRESET", "ETIMEDOUT", "ER_QUERY_INTERRUPTED", "ER_SERVER_SHUTDOWN")


def _one(df: DataFrame, **values: Column) -> DataFrame:
    """One row with the columns of ``df``; those that are not given are null."""
    kinds = dict(df.dtypes)
    return df.sparkSession.range(1).select(*[values.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in df.columns])


def create_range_job(jobs: DataFrame, job_id: int, source_id: int, start: int, end: int, batch: int, now: Column) -> DataFrame:
    """Add a job over the ids from start to end, which waits for planning."""
    if start < 1 or end < start or end - start >= MAX_RANGE or not 1 <= batch <= 1000:
        raise ValueError(f"a range holds 1 to {MAX_RANGE} ids from 1 on, in batches of 1 to 1000")
    config = json.dumps({"start": start, "end": end, "batchSize": batch}, separators=(",", ":"))
    zero = dict.fromkeys(("discovered_count", "succeeded_count", "failed_count", "skipped_count"), F.lit(0))
    new = _one(jobs, id=F.lit(job_id), source_id=F.lit(source_id), type=F.lit("id_range"), status=F.lit("queued"), planning_status=F.lit("queued"), configuration=F.lit(config), created_at=now, updated_at=now, **zero)
    return jobs.unionByName(new)


def create_ids_job(jobs: DataFrame, tasks: DataFrame, job_id: int, source_id: int, ids: DataFrame, first_task: int, now: Column) -> tuple[DataFrame, DataFrame]:
    """Add a job with a task for each of ``ids`` (source_work_id), each once; nothing is left to plan. Returns jobs and tasks."""
    grown = queue.enqueue(tasks, ids.select(F.lit(job_id).cast("bigint").alias("job_id"), "source_work_id"), now, first_task)
    found = ids.agg(F.countDistinct("source_work_id")).first()[0]
    config = json.dumps({"count": found}, separators=(",", ":"))
    zero = dict.fromkeys(("succeeded_count", "failed_count", "skipped_count"), F.lit(0))
    new = _one(jobs, id=F.lit(job_id), source_id=F.lit(source_id), type=F.lit("explicit_ids"), status=F.lit("queued"), planning_status=F.lit("completed"), configuration=F.lit(config), discovered_count=F.lit(found), created_at=now, updated_at=now, **zero)
    return jobs.unionByName(new), grown


def _budgets(values: dict) -> dict:
    """A budget of zero is none."""
    return {k: F.lit(None) if k in ("daily_request_budget", "daily_byte_budget") and v == 0 else F.lit(v) for k, v in values.items()}


def create_source(sources: DataFrame, source_id: int, now: Column, **values: object) -> DataFrame:
    """Add a source; it starts paused."""
    return sources.unionByName(_one(sources, **(_budgets(values) | {"id": F.lit(source_id), "paused": F.lit(True), "updated_at": now})))


def update_source(sources: DataFrame, source_id: int, now: Column, **values: object) -> DataFrame:
    return queue.set_where(sources, F.col("id") == source_id, **(_budgets(values) | {"updated_at": now}))


def subscribe(subscriptions: DataFrame, new_id: int, source_id: int, name: str, slug: str, kind: str, now: Column) -> DataFrame:
    """Follow a tag from its first page on; one that is followed already keeps its page and whether it is enabled."""
    same = (F.col("source_id") == source_id) & (F.col("tag_slug") == slug)
    renamed = queue.set_where(subscriptions, same, tag_name=F.lit(name), tag_type=F.lit(kind), updated_at=now)
    new = _one(subscriptions, id=F.lit(new_id), source_id=F.lit(source_id), tag_name=F.lit(name), tag_slug=F.lit(slug), tag_type=F.lit(kind), next_page=F.lit(1), enabled=F.lit(True), created_at=now, updated_at=now)
    return renamed.unionByName(new.join(subscriptions.select("source_id", "tag_slug"), ["source_id", "tag_slug"], "left_anti").select(subscriptions.columns))


def unsubscribe(subscriptions: DataFrame, subscription_id: int) -> DataFrame:
    return subscriptions.filter(F.col("id") != subscription_id)


def set_enabled(subscriptions: DataFrame, subscription_id: int, enabled: bool, now: Column) -> DataFrame:
    return queue.set_where(subscriptions, F.col("id") == subscription_id, enabled=F.lit(enabled), updated_at=now)


def record_run(subscriptions: DataFrame, subscription_id: int, next_page: int, job_id: int | None, now: Column) -> DataFrame:
    """Without a job the last one stays."""
    job = F.col("last_job_id") if job_id is None else F.lit(job_id)
    return queue.set_where(subscriptions, F.col("id") == subscription_id, next_page=F.lit(next_page), last_job_id=job, last_run_at=now, updated_at=now)


def with_subscribed(tags: DataFrame, subscriptions: DataFrame, slug: str = "slug") -> DataFrame:
    """``tags`` with ``subscribed``: whether a subscription follows the tag."""
    followed = subscriptions.select(F.col("tag_slug").alias(slug)).distinct().withColumn("subscribed", F.lit(True))
    return tags.drop("subscribed").join(followed, slug, "left").withColumn("subscribed", F.coalesce("subscribed", F.lit(False)))


def tag_fill_plan(subscriptions: DataFrame, jobs: DataFrame, tasks: DataFrame, source_id: int) -> DataFrame:
    """(id, tag_slug, next_page, decision) of a source's enabled subscriptions: busy (its last job still runs), full (more than
    MAX_TAG_PENDING tasks wait) or fetch."""
    own = jobs.filter(F.col("source_id") == source_id).select(F.col("id").alias("job_id"))
    waiting = tasks.filter(F.col("status").isin(*PENDING)).join(own, "job_id", "left_semi").count()
    last = jobs.select(F.col("id").alias("last_job_id"), F.col("status").isin("queued", "running").alias("active"))
    wanted = subscriptions.filter((F.col("source_id") == source_id) & F.col("enabled")).join(last, "last_job_id", "left")
    decision = F.when(F.coalesce("active", F.lit(False)), "busy").when(F.lit(waiting > MAX_TAG_PENDING), "full").otherwise("fetch")
    return wanted.select("id", "tag_slug", "next_page", decision.alias("decision")).orderBy("id")


def tag_fill(subscriptions: DataFrame, jobs: DataFrame, tasks: DataFrame, subscription_id: int, listed: DataFrame, known: dict[str, DataFrame], job_id: int, first_task: int, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One page of a subscription's tag (``listed``: source_work_id, ord) as a job of what is new in it. A page without works leaves the
    subscription where it is; one without new works only moves it on. known: works, not_found and queued, each (source_work_id).
    Returns subscriptions, jobs and tasks."""
    if listed.isEmpty():
        return subscriptions, jobs, tasks
    own = subscriptions.filter(F.col("id") == subscription_id).first()
    fresh = filter_uncollected(listed, known["works"], known["not_found"], known["queued"], "source_work_id")
    if fresh.isEmpty():
        return record_run(subscriptions, subscription_id, own["next_page"] + 1, None, now), jobs, tasks
    jobs, tasks = create_ids_job(jobs, tasks, job_id, own["source_id"], fresh, first_task, now)
    return record_run(subscriptions, subscription_id, own["next_page"] + 1, job_id, now), jobs, tasks


def update_auto_fill(configs: DataFrame, source_id: int, now: Column, enabled: bool | None = None, frontier: int | None = None, batch: int | None = None) -> DataFrame:
    """Change a source's configuration of automatic filling (source_id, enabled, frontier_start, batch_size, last_job_id, last_run_at, updated_at); what is not given stays, or has its
    default where the source has none yet."""
    given = {k: F.lit(v) for k, v in (("enabled", enabled), ("frontier_start", frontier), ("batch_size", batch)) if v is not None}
    changed = queue.set_where(configs, F.col("source_id") == source_id, **given, updated_at=now)
    new = _one(configs, **({k: F.lit(v) for k, v in AUTO_FILL.items()} | given | {"source_id": F.lit(source_id), "updated_at": now}))
    return changed.unionByName(new.join(configs.select("source_id"), "source_id", "left_anti").select(configs.columns))


def auto_fill(sources: DataFrame, configs: DataFrame, jobs: DataFrame, tasks: DataFrame, handled: DataFrame, job_id: int, first_task: int, now: Column) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """One run of automatic filling for the source of lowest id. handled: (id), what need not be asked for again. Returns configurations, jobs, tasks and what was
    done: no_source, paused, disabled, busy (the last job still runs), full (more tasks wait than BATCHES_AHEAD batches), moved (no gap as far as it looked: the frontier
    moves on) or created (a job of the first gaps; the frontier moves on if the whole stretch was looked at)."""
    source = sources.orderBy("id").select("id", "paused").first()
    if source is None or source["paused"]:
        return configs, jobs, tasks, "paused" if source else "no_source"
    own = configs.filter(F.col("source_id") == source["id"]).first()
    config = AUTO_FILL | ({k: own[k] for k in (*AUTO_FILL, "last_job_id")} if own else {"last_job_id": None})
    if not config["enabled"]:
        return configs, jobs, tasks, "disabled"
    if config["last_job_id"] is not None and not jobs.filter((F.col("id") == config["last_job_id"]) & F.col("status").isin("queued", "running")).isEmpty():
        return configs, jobs, tasks, "busy"
    of_source = jobs.filter(F.col("source_id") == source["id"]).select(F.col("id").alias("job_id"))
    if tasks.filter(F.col("status").isin(*PENDING)).join(of_source, "job_id", "left_semi").count() > BATCHES_AHEAD * config["batch_size"]:
        return configs, jobs, tasks, "full"
    begin, batch = config["frontier_start"], config["batch_size"]
    end = begin + 100 * batch
    gaps = sorted(r["id"] for r in find_gaps(jobs.sparkSession, handled, begin, end, batch).collect())  # a batch at most
    found = jobs.sparkSession.createDataFrame([(i,) for i in gaps], "id long")
    ahead = next_cursor(found, begin, end, batch).first()["next_cursor"]
    if not gaps:
        return update_auto_fill(configs, source["id"], now, frontier=end if ahead is None else ahead), jobs, tasks, "moved"
    jobs, tasks = create_ids_job(jobs, tasks, job_id, source["id"], found.select(F.col("id").cast("string").alias("source_work_id")), first_task, now)
    moved = {} if ahead is None else {"frontier_start": F.lit(ahead)}
    return queue.set_where(configs, F.col("source_id") == source["id"], last_job_id=F.lit(job_id), last_run_at=now, updated_at=now, **moved), jobs, tasks, "created"


def read_settings(spark: SparkSession, path: str, timezone: str = "UTC") -> DataFrame:
    """One row (backup_retention_days, default_batch_size, timezone) of a JSON file; what is missing, of another kind or cannot be read is its default."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)
    text = spark.read.text(path, wholetext=True).agg(F.first("value").alias("value")) if there else spark.range(1).select(F.lit(None).cast("string").alias("value"))
    v = text.select(F.try_parse_json("value").alias("v"))

    def number(name: str) -> Column:
        raw = F.try_variant_get("v", f"$.{name}", "variant")
        return F.when(F.schema_of_variant(raw).rlike("BIGINT|DECIMAL|DOUBLE"), F.try_variant_get("v", f"$.{name}", "bigint"))

    zone = F.when(F.schema_of_variant(F.try_variant_get("v", "$.timezone", "variant")) == "STRING", F.try_variant_get("v", "$.timezone", "string"))
    return v.select(
        number("backupRetentionDays").alias("backup_retention_days"), F.coalesce(number("defaultBatchSize"), F.lit(DEFAULT_BATCH)).cast("bigint").alias("default_batch_size"),
        F.coalesce(F.nullif(zone, F.lit("")), F.lit(timezone)).alias("timezone"),
    )


def expired_backups(backups: DataFrame, now: Column, days: int | None) -> DataFrame:
    """Backups (created_at, ...) older than ``days``; none if there is no limit."""
    return backups.filter(F.col("created_at") < now - F.expr(f"INTERVAL {days} DAYS")) if days else backups.limit(0)


def diagnostics(sources: DataFrame, jobs: DataFrame, tasks: DataFrame, events: DataFrame, configs: DataFrame | None = None) -> DataFrame:
    """One row of lists: all sources, the newest jobs, failed tasks and events, each newest first; with ``configs`` also ``auto_fill``, how the source of lowest id is filled, by default
    if it has no configuration, and null if there is no source."""
    def top(df: DataFrame, name: str, *order: str, limit: int | None = None) -> DataFrame:
        some = df.orderBy(*[F.desc(c) for c in order]).limit(limit) if limit else df
        key = F.struct(*[F.col(c) for c in order], F.struct(*df.columns).alias("row"))
        return some.agg(F.transform(F.sort_array(F.collect_list(key), asc=False), lambda x: x["row"]).alias(name))

    parts = [
        top(sources, "sources", "id"), top(jobs, "jobs", "id", limit=DIAGNOSTIC_JOBS),
        top(tasks.filter("status = 'terminal_failed'"), "failures", "updated_at", "id", limit=DIAGNOSTIC_FAILURES), top(events, "logs", "id", limit=DIAGNOSTIC_EVENTS),
    ]
    found = parts[0]
    for p in parts[1:]:
        found = found.crossJoin(p)  # single rows
    if configs is None:
        return found
    first = sources.agg(F.min("id").alias("source_id"))
    own = first.join(configs.drop("updated_at"), "source_id", "left")
    filled = [F.coalesce(F.col(c), F.lit(AUTO_FILL[c])).alias(c) if c in AUTO_FILL else F.col(c) for c in own.columns]
    return found.crossJoin(own.select(F.when(F.col("source_id").isNotNull(), F.struct(*filled)).alias("auto_fill")))  # single rows


def update_settings(settings: DataFrame, **values: object) -> DataFrame:
    """Change settings, as ``read_settings`` gives them: days that backups are kept (1 or more, None for ever), default size of a batch (1 to 1000), timezone. What is not given stays."""
    unknown = set(values) - {"backup_retention_days", "default_batch_size", "timezone"}
    days, batch, zone = values.get("backup_retention_days", 1), values.get("default_batch_size", 1), values.get("timezone", "UTC")
    if unknown or (days is not None and not (isinstance(days, int) and days >= 1)) or not (isinstance(batch, int) and 1 <= batch <= 1000) or not zone:
        raise ValueError(f"no such settings: {values}")
    kinds = dict(settings.dtypes)
    return settings.select([F.lit(values[c]).cast(kinds[c]).alias(c) if c in values else F.col(c) for c in settings.columns])


def write_settings(settings: DataFrame, path: str) -> None:
    """Write settings as the JSON file that ``read_settings`` reads, whole or not at all."""
    row = settings.first()
    known = {"backupRetentionDays": row["backup_retention_days"], "defaultBatchSize": row["default_batch_size"], "timezone": row["timezone"]}
    folder, _, name = path.rpartition("/")
    disk = Files(settings.sparkSession, folder)
    disk.replace(name, json.dumps({k: v for k, v in known.items() if v is not None}))


def capture_report(parsed: DataFrame, error: str = "error") -> DataFrame:
    """One row (requested, parsed, failed) of pages that were read, with their errors."""
    return parsed.agg(F.count("*").alias("requested"), F.count_if(F.col(error).isNull()).alias("parsed"), F.count_if(F.col(error).isNotNull()).alias("failed"))


def _causes(error: BaseException, most: int) -> list[BaseException]:
    found: list[BaseException] = []
    at: BaseException | None = error
    while at is not None and len(found) < most:
        found.append(at)
        at = at.__cause__
    return found


def is_transient(error: BaseException) -> bool:
    """Whether an error or one of its four nearest causes has a code of those that pass by themselves."""
    return any(str(getattr(e, "code", "")) in TRANSIENT_CODES for e in _causes(error, 5))


def describe_error(error: object) -> str:
    """Kind and message of an error, and code and detail of the nearest of its causes that has any."""
    if not isinstance(error, BaseException):
        return str(error)
    text = f"{type(error).__name__}: {error}"
    for e in _causes(error, 5)[1:]:
        known = [str(x) for x in (getattr(e, "code", None), getattr(e, "detail", None)) if x not in (None, "")]
        if known:
            return f"{text} ({': '.join(known)})"
    return text


def range_configuration(jobs: DataFrame) -> DataFrame:
    """(id, start, end, batch_size, problem): what the JSON of each range job's configuration says, 250 ids a batch by
    default; problem is null where a job can be planned."""
    c = F.from_json("configuration", "start bigint, end bigint, batchSize bigint")
    read = jobs.filter("type = 'id_range'").select("id", c["start"].alias("start"), c["end"].alias("end"), F.coalesce(c["batchSize"], F.lit(DEFAULT_BATCH)).alias("batch_size"))
    problem = (
        F.when(F.col("start").isNull() | F.col("end").isNull(), "no range").when(F.col("end") < F.col("start"), "the range ends before it starts")
        .when(~F.col("batch_size").between(1, 1000), "batches hold 1 to 1000 ids")
    )
    return read.withColumn("problem", problem)


def plan_range(jobs: DataFrame, tasks: DataFrame, job_id: int, token: str, first_task: int, now: Column) -> tuple[DataFrame, DataFrame]:
    """Plan a range job that ``token`` holds from its cursor on: all ids that have no task yet are queued at once, and the job
    is planned. A range that cannot be planned fails. Returns jobs and tasks."""
    held = jobs.filter((F.col("id") == job_id) & (F.col("planning_lease_token") == token))
    found = range_configuration(held).join(held.select("id", "planning_cursor"), "id").first()
    if found is None:
        return jobs, tasks
    if found["problem"]:
        return queue.finish_planning(jobs, job_id, token, ok=False), tasks
    begin = found["start"] if found["planning_cursor"] is None else max(found["start"], found["planning_cursor"])
    ids = jobs.sparkSession.range(begin, found["end"] + 1).select(F.lit(job_id).cast("bigint").alias("job_id"), F.col("id").cast("string").alias("source_work_id"))
    grown = queue.enqueue(tasks, ids, now, first_task)
    total = grown.filter(F.col("job_id") == job_id).count()
    moved = queue.set_where(jobs, F.col("id") == job_id, planning_cursor=F.lit(found["end"] + 1), discovered_count=F.lit(total), updated_at=now)
    return queue.finish_planning(moved, job_id, token), grown


def reparse(spark: SparkSession, folder: str, origin: str, now: Column) -> DataFrame:
    """Works of a folder of saved pages ``<id>.html`` as ``extract.parse_works`` gives them; pages that cannot be read have an error."""
    return extract.parse_works(raw_pages(spark, folder).select(F.concat(F.lit(f"{origin}/works/"), "work_id").alias("url"), "html", now.alias("captured_at")))
