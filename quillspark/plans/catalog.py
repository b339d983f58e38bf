"""The archive's queries over the tables at hand, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import timing as TM
from ..operators import coverage as C
from ..operators import extract, integrity, merge, packages, queue
from ..operators import relational as R
from ..sources.packages import blobs
from ..streaming import usage
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The model's tables in SQL, as CTEs that the queries' SQL begins with.
_CTE = {
    "sources": "SELECT n_nationkey::BIGINT AS id, n_name AS source_key, 10000 AS minimum_delay_ms, CASE WHEN n_nationkey % 3 <> 0 THEN 250 END AS daily_request_budget, n_nationkey % 5 = 0 AS paused FROM nation",
    "jobs": "SELECT c_custkey AS id, c_nationkey::BIGINT AS source_id, ['queued','running','cancelled','paused'][(c_custkey % 4 + 1)::INT] AS status, CASE WHEN c_custkey % 7 = 0 THEN 'queued' ELSE 'completed' END AS planning_status, TIMESTAMP '1997-06-01' AS updated_at FROM customer",
    "tasks": """SELECT o_orderkey AS id, o_custkey AS job_id, o_orderkey::VARCHAR AS source_work_id, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 6 = 0 THEN 'terminal_failed' ELSE 'succeeded' END
        WHEN o_orderkey % 10 = 3 THEN 'leased' WHEN o_orderstatus = 'O' THEN 'queued' ELSE 'retryable_failed' END AS status, (o_orderkey % 8)::INT AS attempts, o_orderdate AS available_at,
        CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 10 = 3 THEN o_orderdate + INTERVAL 120 SECOND END AS lease_expires_at, o_orderdate AS updated_at FROM orders""",
    "works": "SELECT doc_id AS id, doc_id::VARCHAR AS source_work_id, source AS source_key, lang AS language, n_chars AS words, split_part(text, chr(10), 1) AS title, 'sha256:' || sha256(text) AS content_hash FROM documents",
    "obs": "SELECT event_id AS id, user_id::VARCHAR AS source_work_id, ts AS observed_at, CASE WHEN event_type = 'error' THEN 'not_found' ELSE 'public' END AS availability, event_type, value FROM events",
}


def _with(sql: str, *names: str) -> str:
    head = ", ".join(f"{n} AS ({_CTE[n]})" for n in names)
    return f"WITH RECURSIVE {head} {sql}" if names else sql


def query(name: str, sql: str | None = None, *ctes: str):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = _with(sql, *ctes) if ctes else sql
        return f

    return keep


_OPEN = "('queued', 'leased', 'retryable_failed')"
_NOW = f"TIMESTAMP '{V.NOW}'"


@query("q_coverage", """
, e AS (SELECT max(o_orderkey) AS hi FROM orders),
c AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_orderkey BETWEEN 1 AND (SELECT hi FROM e)),
m AS (SELECT user_id AS id FROM events WHERE event_type = 'error' AND user_id BETWEEN 1 AND (SELECT hi FROM e)),
t AS (SELECT id FROM tasks WHERE status = 'retryable_failed' AND id BETWEEN 1 AND (SELECT hi FROM e)),
h AS (SELECT id FROM c UNION SELECT id FROM m UNION SELECT id FROM t)
SELECT hi AS total, (SELECT count(*) FROM c) AS collected, (SELECT count(*) FROM m) AS not_found, (SELECT count(DISTINCT id) FROM t) AS attempted,
(SELECT count(*) FROM h) AS handled, greatest(0, hi - (SELECT count(*) FROM h))::BIGINT AS missing FROM e""", "tasks")
def q_coverage(spark, sf):
    last = V.table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    missing = V.observations(spark, sf).filter("availability = 'not_found'").select("source_work_id")
    attempted = V.tasks(spark, sf).filter("status = 'retryable_failed'").select("source_work_id")
    return C.coverage(V.work_tags(spark, sf), missing, attempted, 1, last)


_GAPS = "gaps AS (SELECT r.id FROM (SELECT unnest(range(1, least(10000, (SELECT max(l_orderkey) FROM lineitem)) + 1)) AS id) r WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = r.id) ORDER BY 1 LIMIT 100)"


def _last_work(spark, sf) -> int:
    return V.work_tags(spark, sf).agg(F.max("source_work_id")).first()[0]


@query("q_find_gaps", f"WITH {_GAPS} SELECT id FROM gaps")
def q_find_gaps(spark, sf):
    return C.find_gaps(spark, V.work_tags(spark, sf).select(F.col("source_work_id").alias("id")), 1, _last_work(spark, sf), 100)


@query("q_gap_cursor", f"""
WITH {_GAPS}, e AS (SELECT max(l_orderkey) AS hi, least(10000, max(l_orderkey)) AS last FROM lineitem),
s AS (SELECT CASE WHEN (SELECT count(*) FROM gaps) >= 100 THEN least(last, (floor(((SELECT max(id) FROM gaps) - 1) / 3000) + 1) * 3000) ELSE last END + 1 AS c, hi FROM e)
SELECT CASE WHEN c <= hi THEN c END::BIGINT AS next_cursor FROM s""")
def q_gap_cursor(spark, sf):
    return C.next_cursor(q_find_gaps(spark, sf), 1, _last_work(spark, sf), 100).select(F.col("next_cursor").cast("bigint"))


@query("q_filter_uncollected", "SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AND o_orderkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error') AND o_orderkey NOT IN (SELECT id FROM tasks WHERE status IN ('queued', 'retryable_failed'))", "tasks")
def q_filter_uncollected(spark, sf):
    gone = V.observations(spark, sf).filter("availability = 'not_found'").select(F.col("source_work_id").cast("bigint").alias("id"))
    queued = V.tasks(spark, sf).filter("status in ('queued', 'retryable_failed')").select("id")
    return C.filter_uncollected(V.tasks(spark, sf).select("id"), V.work_tags(spark, sf).select(F.col("source_work_id").alias("id")), gone, queued)


@query("q_ordered_minus", "SELECT ord, id FROM (SELECT unnest(range(0, 4)) AS ord, unnest([c_custkey, c_custkey * 7, c_custkey, 90000000000 + c_custkey]) AS id FROM customer) WHERE id NOT IN (SELECT o_orderkey FROM orders)")
def q_ordered_minus(spark, sf):
    k = F.col("c_custkey").cast("bigint")
    ids = V.table(spark, sf, "customer").select(F.array(k, k * 7, k, k + 90_000_000_000).alias("ids"))
    return R.ordered_minus(ids, "ids", V.tasks(spark, sf)).select(F.col("ord").cast("bigint"), "id")


@query("q_not_found_ids", "SELECT DISTINCT source_work_id FROM obs WHERE availability = 'not_found'", "obs")
def q_not_found_ids(spark, sf):
    return V.observations(spark, sf).filter("availability = 'not_found'").select("source_work_id").distinct()


@query("q_pending_tasks_by_source", f"SELECT source_id, count(*) AS pending FROM tasks t JOIN jobs j ON t.job_id = j.id WHERE t.status IN {_OPEN} GROUP BY source_id", "tasks", "jobs")
def q_pending_tasks_by_source(spark, sf):
    j = V.jobs(spark, sf).select(F.col("id").alias("job_id"), "source_id")
    return V.tasks(spark, sf).filter(F.col("status").isin(*C.PENDING)).join(j, "job_id").groupBy("source_id").agg(F.count("*").alias("pending"))


@query("q_claimable_topk", f"SELECT t.id, t.job_id, j.source_id FROM tasks t JOIN jobs j ON t.job_id = j.id JOIN sources s ON j.source_id = s.id WHERE NOT s.paused AND j.status IN ('queued', 'running') AND (t.status IN ('queued', 'retryable_failed') AND t.available_at <= {_NOW} OR t.status = 'leased' AND t.lease_expires_at <= {_NOW}) ORDER BY t.available_at, t.id LIMIT 100", "tasks", "jobs", "sources")
def q_claimable_topk(spark, sf):
    due = queue.claimable(V.tasks(spark, sf), V.jobs(spark, sf), V.sources(spark, sf), V.now())
    return due.orderBy("available_at", "id").limit(100).select("id", "job_id", "source_id")


@query("q_claim_state", f", x AS (SELECT t.id FROM tasks t JOIN jobs j ON t.job_id = j.id JOIN sources s ON j.source_id = s.id WHERE NOT s.paused AND j.status IN ('queued', 'running') AND (t.status IN ('queued', 'retryable_failed') AND t.available_at <= {_NOW} OR t.status = 'leased' AND t.lease_expires_at <= {_NOW}) ORDER BY t.available_at, t.id LIMIT 50) SELECT CASE WHEN x.id IS NOT NULL THEN 'leased' ELSE t.status END AS status, count(*) AS n, sum(t.attempts + CASE WHEN x.id IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS attempts FROM tasks t LEFT JOIN x ON t.id = x.id GROUP BY 1", "tasks", "jobs", "sources")
def q_claim_state(spark, sf):
    j = V.jobs(spark, sf).withColumn("started_at", F.lit(None).cast("timestamp_ntz"))
    claimed, _ = queue.claim_tasks(V.tasks(spark, sf), j, V.sources(spark, sf), V.now(), "worker-1", "token-1", 50)
    return claimed.groupBy("status").agg(F.count("*").alias("n"), F.sum("attempts").cast("bigint").alias("attempts"))


@query("q_works_page", "SELECT id, title, language, words FROM works ORDER BY id DESC LIMIT 25 OFFSET 50", "works")
def q_works_page(spark, sf):
    return R.page(V.works(spark, sf).select("id", "title", "language", "words"), F.desc("id"), limit=25, offset=50)


@query("q_works_search", "SELECT p_partkey AS source_tag_id, p_name AS name FROM part WHERE p_name ILIKE '%RED%' OR p_partkey::VARCHAR ILIKE '%RED%'")
def q_works_search(spark, sf):
    return R.search(V.tags(spark, sf), "RED", "name", "source_tag_id").select("source_tag_id", "name")


@query("q_search_collated", "SELECT p_partkey AS source_tag_id FROM part WHERE contains(lower(strip_accents(p_name)), 'ring')")
def q_search_collated(spark, sf):
    return R.search_collated(V.tags(spark, sf), "RíNG", "name").select("source_tag_id")


@query("q_tags_local_search", "SELECT p_partkey AS source_tag_id, p_name AS name, p_type AS type FROM part WHERE lower(p_name) LIKE '%ring%' OR lower(p_partkey::VARCHAR) LIKE '%ring%' ORDER BY p_partkey DESC LIMIT 25")
def q_tags_local_search(spark, sf):
    return R.search_folded(V.tags(spark, sf), " Ring ", "name", "source_tag_id").orderBy(F.desc("source_tag_id")).limit(25).select("source_tag_id", "name", "type")


@query("q_works_total", "SELECT count(*) AS total, count(DISTINCT content_hash) AS distinct_bodies FROM works", "works")
def q_works_total(spark, sf):
    return V.works(spark, sf).agg(F.count("*").alias("total"), F.countDistinct("content_hash").alias("distinct_bodies"))


@query("q_page_count", "SELECT greatest(1, ceil(count(*) / 25.0))::BIGINT AS pages FROM documents")
def q_page_count(spark, sf):
    return V.works(spark, sf).agg(F.count("*").alias("n")).select(R.page_count("n", 25).alias("pages"))


@query("q_failures_page", "SELECT id, job_id, status FROM tasks WHERE status IN ('retryable_failed', 'terminal_failed') ORDER BY updated_at DESC, id DESC LIMIT 25", "tasks")
def q_failures_page(spark, sf):
    failed = V.tasks(spark, sf).filter(F.col("status").isin("retryable_failed", "terminal_failed"))
    return R.page(failed, F.desc("updated_at"), F.desc("id")).select("id", "job_id", "status")


@query("q_job_task_counts", "SELECT job_id, status, count(*) AS n FROM tasks GROUP BY job_id, status", "tasks")
def q_job_task_counts(spark, sf):
    return V.tasks(spark, sf).groupBy("job_id", "status").agg(F.count("*").alias("n"))


@query("q_job_status_map", "SELECT job_id, string_agg(status || '=' || n::VARCHAR, ',' ORDER BY status) AS counts FROM (SELECT job_id, status, count(*) AS n FROM tasks GROUP BY 1, 2) GROUP BY job_id", "tasks")
def q_job_status_map(spark, sf):
    counts = R.counts_by_status(V.tasks(spark, sf), "job_id")
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return counts.select("job_id", F.array_join(entries, ",").alias("counts"))


@query("q_statistics", f"SELECT (SELECT count(*) FROM works) AS works, (SELECT coalesce(sum(words), 0)::BIGINT FROM works) AS words, (SELECT count(*) FROM supplier) AS authors, (SELECT count(*) FROM tasks WHERE status IN {_OPEN}) AS pending, (SELECT count(*) FROM tasks WHERE status = 'terminal_failed') AS failed", "works", "tasks")
def q_statistics(spark, sf):
    w = V.works(spark, sf).agg(F.count("*").alias("works"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
    a = V.authors(spark, sf).agg(F.count("*").alias("authors"))
    t = V.tasks(spark, sf).agg(F.count_if(F.col("status").isin(*C.PENDING)).alias("pending"), F.count_if(F.col("status") == "terminal_failed").alias("failed"))
    return w.crossJoin(a).crossJoin(t)  # three single rows


_STATS = f"st AS (SELECT job_id, count(*) AS total, count(*) FILTER (status IN {_OPEN}) AS pending, count(*) FILTER (status = 'succeeded') AS succeeded, count(*) FILTER (status = 'terminal_failed') AS failed FROM tasks GROUP BY job_id)"


@query("q_job_recompute", f"""
SELECT id, (SELECT count(*) FROM tasks WHERE job_id = jobs.id AND status = 'succeeded') AS succeeded_count, (SELECT count(*) FROM tasks WHERE job_id = jobs.id AND status = 'terminal_failed') AS failed_count,
       (SELECT count(*) FROM tasks WHERE job_id = jobs.id AND status IN ('cancelled', 'not_found')) AS skipped_count,
       CASE WHEN EXISTS (SELECT 1 FROM tasks WHERE job_id = jobs.id AND status IN {_OPEN}) THEN CASE status WHEN 'cancelled' THEN 'running' ELSE status END WHEN status = 'cancelled' THEN 'cancelled' ELSE 'completed' END AS status,
       CASE WHEN NOT EXISTS (SELECT 1 FROM tasks WHERE job_id = jobs.id AND status IN {_OPEN}) THEN {_NOW} END AS completed_at, {_NOW} AS updated_at
FROM jobs""", "tasks", "jobs")
def q_job_recompute(spark, sf):
    return queue.recompute_jobs(V.jobs(spark, sf), V.tasks(spark, sf), V.now()).select("id", "succeeded_count", "failed_count", "skipped_count", "status", "completed_at", "updated_at")


@query("q_sources_usage", ", u AS (SELECT user_id AS id, count(*) AS n FROM events WHERE ts::DATE = DATE '2024-01-10' GROUP BY 1) SELECT s.id, source_key, coalesce(n, 0) AS today FROM sources s LEFT JOIN u ON s.id = u.id", "sources")
def q_sources_usage(spark, sf):
    day = V.table(spark, sf, "events").filter(F.to_date("ts") == F.lit("2024-01-10").cast("date")).groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("n"))
    return V.sources(spark, sf).join(day, "id", "left").select("id", "source_key", F.coalesce("n", F.lit(0)).alias("today"))


def _requests(spark, sf):
    return V.table(spark, sf, "events").select(F.col("user_id").alias("source"), "ts", F.floor(F.col("value") * 100).cast("bigint").alias("bytes"))


@query("q_daily_usage", "SELECT user_id AS source, strftime(ts, '%Y-%m-%d') AS usage_date, count(*) AS request_count, sum(floor(value * 100)::BIGINT)::BIGINT AS response_bytes FROM events GROUP BY 1, 2")
def q_daily_usage(spark, sf):
    return usage.daily_usage(_requests(spark, sf)).withColumn("usage_date", F.date_format("usage_date", "yyyy-MM-dd"))


@query("q_daily_usage_window", "SELECT user_id AS source, strftime(date_trunc('day', ts), '%Y-%m-%d') AS usage_date, count(*) AS request_count, sum(floor(value * 100)::BIGINT)::BIGINT AS response_bytes FROM events GROUP BY 1, 2")
def q_daily_usage_window(spark, sf):
    timed = _requests(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    return usage.daily_usage_stream(timed).withColumn("usage_date", F.date_format("usage_date", "yyyy-MM-dd"))


@query("q_budget_exhausted_days", "SELECT user_id AS source, strftime(ts, '%Y-%m-%d') AS usage_date, count(*) AS request_count FROM events GROUP BY 1, 2 HAVING count(*) >= 5")
def q_budget_exhausted_days(spark, sf):
    return q_daily_usage(spark, sf).filter("request_count >= 5").drop("response_bytes")


@query("q_min_delay_violations", "SELECT event_id FROM (SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events) WHERE gap < 600000000")
def q_min_delay_violations(spark, sf):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = micros - F.lag(micros).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return V.table(spark, sf, "events").select("event_id", gap.alias("gap")).filter("gap < 600000000").select("event_id")


@query("q_rate_limit_grants")
def q_rate_limit_grants(spark, sf):
    return usage.rate_limit(_requests(spark, sf), usage.Limiter(600_000, requests=5, hours=(6, 2)))


@query("q_work_authors_ordered", "SELECT l_orderkey AS source_work_id, l_linenumber AS position, s_name AS name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def q_work_authors_ordered(spark, sf):
    return V.work_authors(spark, sf).join(V.authors(spark, sf), "source_author_id").orderBy("source_work_id", "position").select("source_work_id", "position", "name")


@query("q_work_tags_grouped", "SELECT l_orderkey AS source_work_id, p_type AS type, string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS names FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def q_work_tags_grouped(spark, sf):
    rows = V.work_tags(spark, sf).join(V.tags(spark, sf), "source_tag_id")
    return rows.groupBy("source_work_id", "type").agg(F.array_join(F.array_sort(F.collect_set("name")), "|").alias("names"))


@query("q_dedupe_work_authors", "SELECT l_orderkey AS source_work_id, l_suppkey AS source_author_id, min(l_linenumber) AS position FROM lineitem GROUP BY 1, 2")
def q_dedupe_work_authors(spark, sf):
    return R.lowest_place(V.work_authors(spark, sf), ["source_work_id", "source_author_id"], "position")


@query("q_unique_first", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1")
def q_unique_first(spark, sf):
    rows = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return R.first_by_key(rows, ["l_orderkey", "l_linenumber"], "l_partkey", "l_suppkey").drop("l_suppkey")


@query("q_duplicate_identities", "SELECT l_orderkey AS source_work_id, l_linenumber AS position, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_duplicate_identities(spark, sf):
    return integrity.duplicates(V.work_tags(spark, sf), ["source_work_id", "position"])


@query("q_fk_violations", "SELECT DISTINCT 'work' AS kind, l_orderkey::VARCHAR AS key FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM documents WHERE doc_id = l_orderkey) UNION ALL SELECT DISTINCT 'tag', l_partkey::VARCHAR FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)")
def q_fk_violations(spark, sf):
    bridge = V.work_tags(spark, sf)
    w = integrity.orphans(bridge, V.works(spark, sf), "source_work_id", "id").select(F.lit("work").alias("kind"), F.col("source_work_id").cast("string").alias("key")).distinct()
    t = integrity.orphans(bridge, V.tags(spark, sf), "source_tag_id").select(F.lit("tag").alias("kind"), F.col("source_tag_id").cast("string").alias("key")).distinct()
    return w.unionByName(t)


@query("q_fk_semi", "SELECT doc_id, quality, toxic FROM labels WHERE EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = labels.doc_id AND lang = 'en')")
def q_fk_semi(spark, sf):
    english = V.works(spark, sf).filter("language = 'en'").select(F.col("id").alias("doc_id"))
    return V.table(spark, sf, "labels").join(english, "doc_id", "left_semi")


@query("q_jobs_with_pending", f"SELECT id FROM jobs WHERE EXISTS (SELECT 1 FROM tasks t WHERE t.job_id = jobs.id AND t.status IN {_OPEN})", "jobs", "tasks")
def q_jobs_with_pending(spark, sf):
    pending = V.tasks(spark, sf).filter(F.col("status").isin(*C.PENDING)).select(F.col("job_id").alias("id"))
    return V.jobs(spark, sf).join(pending, "id", "left_semi").select("id")


@query("q_jobs_without_pending", f"SELECT id FROM jobs WHERE NOT EXISTS (SELECT 1 FROM tasks t WHERE t.job_id = jobs.id AND t.status IN {_OPEN})", "jobs", "tasks")
def q_jobs_without_pending(spark, sf):
    pending = V.tasks(spark, sf).filter(F.col("status").isin(*C.PENDING)).select(F.col("job_id").alias("id"))
    return R.minus_keys(V.jobs(spark, sf), pending, "id").select("id")


@query("q_self_heal_jobs", f"""
, h AS (SELECT id FROM jobs WHERE status = 'cancelled' AND (planning_status IN ('planning', 'leased') OR EXISTS (SELECT 1 FROM tasks t WHERE t.job_id = jobs.id AND t.status IN ('queued', 'retryable_failed'))))
SELECT id, CASE WHEN id IN (SELECT id FROM h) THEN 'running' ELSE status END AS status, CASE WHEN id IN (SELECT id FROM h) AND planning_status <> 'completed' THEN 'queued' ELSE planning_status END AS planning_status,
       CASE WHEN id IN (SELECT id FROM h) THEN {_NOW} ELSE updated_at END AS updated_at FROM jobs""", "jobs", "tasks")
def q_self_heal_jobs(spark, sf):
    return queue.heal_cancelled(V.jobs(spark, sf), V.tasks(spark, sf), V.now()).select("id", "status", "planning_status", "updated_at")


@query("q_stalled_jobs", f"""
, quiet AS (SELECT * FROM jobs WHERE status IN ('queued', 'running') AND updated_at <= {_NOW} - INTERVAL 30 MINUTE ORDER BY id LIMIT 200),
why AS (SELECT id, source_id, CASE WHEN (SELECT paused FROM sources s WHERE s.id = source_id) THEN 'source_paused' WHEN planning_status <> 'completed' THEN 'planning_stalled'
  WHEN NOT EXISTS (SELECT 1 FROM tasks t WHERE t.job_id = quiet.id AND t.status IN ('queued', 'retryable_failed')) THEN NULL
  WHEN EXISTS (SELECT 1 FROM tasks t WHERE t.job_id = quiet.id AND t.status IN ('queued', 'retryable_failed') AND t.available_at <= {_NOW}) THEN 'worker_stalled' ELSE 'retry_backoff' END AS stall FROM quiet)
SELECT id, source_id, stall FROM why WHERE stall IS NOT NULL""", "jobs", "tasks", "sources")
def q_stalled_jobs(spark, sf):
    return queue.stalled_jobs(V.jobs(spark, sf), V.tasks(spark, sf), V.sources(spark, sf), V.now())


@query("q_reclaim_expired", f"""
, x AS (SELECT t.status, t.status = 'leased' AND t.lease_expires_at <= {_NOW} AND j.status IN ('queued', 'running') AS gone FROM tasks t LEFT JOIN jobs j ON j.id = t.job_id)
SELECT CASE WHEN gone THEN 'retryable_failed' ELSE status END AS status, CASE WHEN gone THEN 'worker_lease_expired' END AS code, CASE WHEN gone THEN 'The worker lease expired before completion.' END AS message, count(*) AS n FROM x GROUP BY 1, 2, 3""", "tasks", "jobs")
def q_reclaim_expired(spark, sf):
    freed = queue.reclaim_expired(V.tasks(spark, sf), V.jobs(spark, sf), V.now())
    return freed.groupBy("status", F.col("last_error_code").alias("code"), F.col("last_error_message").alias("message")).agg(F.count("*").alias("n"))


@query("q_retry_failures", "SELECT CASE WHEN status = 'terminal_failed' THEN 'queued' ELSE status END AS status, sum(CASE WHEN status = 'terminal_failed' THEN 0 ELSE attempts END)::BIGINT AS attempts, count(*) AS n FROM tasks GROUP BY 1", "tasks")
def q_retry_failures(spark, sf):
    return queue.retry_failures(V.tasks(spark, sf), None, V.now()).groupBy("status").agg(F.sum("attempts").cast("bigint").alias("attempts"), F.count("*").alias("n"))


@query("q_enqueue", "SELECT count(*) AS n, count(DISTINCT id) AS ids, max(id) AS last FROM (SELECT id FROM tasks UNION ALL SELECT 10000000 + row_number() OVER (ORDER BY job_id, source_work_id) - 1 FROM (SELECT DISTINCT c_custkey AS job_id, 'n' || (c_custkey % 3)::VARCHAR AS source_work_id FROM customer))", "tasks")
def q_enqueue(spark, sf):
    new = V.jobs(spark, sf).select(F.col("id").alias("job_id"), F.concat(F.lit("n"), (F.col("id") % 3).cast("string")).alias("source_work_id"))
    grown = queue.enqueue(V.tasks(spark, sf), new, V.now(), 10_000_000)
    return grown.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.max("id").alias("last"))


@query("q_display_status", "SELECT CASE WHEN planning_status = 'failed' THEN 'planning_failed' WHEN planning_status IN ('queued', 'planning') AND status IN ('queued', 'running') THEN 'planning' ELSE status END AS shown, count(*) AS n FROM jobs GROUP BY 1", "jobs")
def q_display_status(spark, sf):
    return V.jobs(spark, sf).groupBy(queue.display_status(F.col("status"), F.col("planning_status")).alias("shown")).agg(F.count("*").alias("n"))


@query("q_job_advice", "SELECT id, CASE WHEN id * 1000 > 10000000 THEN 'too_many_ids' WHEN id * 1000 * 345600.0 > 365 * 86400000.0 THEN 'over_a_year' WHEN id * 1000 * 345600.0 > 7 * 86400000.0 THEN 'over_a_week' WHEN id * 20000.0 > 3600000 THEN 'long_planning' ELSE 'none' END AS advice FROM jobs", "jobs")
def q_job_advice(spark, sf):
    n = F.col("id") * 1000
    return V.jobs(spark, sf).select("id", queue.job_advice(n, TM.collect_eta_ms(n, F.lit(10_000), F.lit(250)), TM.planning_eta_ms(n), F.lit(250)).alias("advice"))


@query("q_record_counts", "SELECT 'works' AS name, count(*) AS n FROM documents UNION ALL SELECT 'workTags', count(*) FROM lineitem UNION ALL SELECT 'tags', count(*) FROM part UNION ALL SELECT 'authors', count(*) FROM supplier UNION ALL SELECT 'comments', count(*) FROM conversations")
def q_record_counts(spark, sf):
    return integrity.record_counts({"works": V.works(spark, sf), "workTags": V.work_tags(spark, sf), "tags": V.tags(spark, sf), "authors": V.authors(spark, sf), "comments": V.comments(spark, sf)})


def _exported(spark, sf):
    last = V.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good"))
    return V.works(spark, sf).join(last, "id", "left").withColumn("last_exported_hash", F.when(F.col("good"), F.col("content_hash")).when(~F.col("good"), "sha256:old"))


@query("q_changed_since_export", "SELECT w.id, w.content_hash FROM works w LEFT JOIN labels l ON l.doc_id = w.id WHERE w.content_hash IS DISTINCT FROM CASE WHEN l.quality = 1 THEN w.content_hash WHEN l.quality = 0 THEN 'sha256:old' END ORDER BY w.id LIMIT 500", "works")
def q_changed_since_export(spark, sf):
    return packages.changed_works(_exported(spark, sf), 500).select("id", "content_hash")


def _two_sides(spark, sf):
    w = V.works(spark, sf).select("source_work_id", "id", "title", "content_hash", "language", "words")
    old = w.filter("language <> 'fr'").withColumn("content_hash", F.when(F.col("words") > 1000, "sha256:old").otherwise(F.col("content_hash")))
    new = w.filter("language <> 'de'").withColumn("operation", F.when(F.col("words") < 100, "hide").otherwise("upsert"))
    return old.drop("language", "words"), new.drop("language", "words")


_SIDES = "o AS (SELECT source_work_id, id, title, CASE WHEN words > 1000 THEN 'sha256:old' ELSE content_hash END AS content_hash FROM works WHERE language <> 'fr'), n AS (SELECT source_work_id, id, title, content_hash, CASE WHEN words < 100 THEN 'hide' ELSE 'upsert' END AS operation FROM works WHERE language <> 'de')"


@query("q_incremental_diff", f", {_SIDES} SELECT n.source_work_id, CASE WHEN o.content_hash = n.content_hash THEN 'skipped' WHEN operation = 'hide' AND o.id IS NULL THEN 'failed' WHEN operation = 'hide' THEN 'hidden' WHEN o.id IS NULL THEN 'created' ELSE 'updated' END AS outcome FROM n LEFT JOIN o ON n.source_work_id = o.source_work_id", "works")
def q_incremental_diff(spark, sf):
    old, new = _two_sides(spark, sf)
    return packages.diff(old, new, ["source_work_id"], "content_hash", "operation")


@query("q_import_outcomes", f", {_SIDES}, d AS (SELECT CASE WHEN o.content_hash = n.content_hash THEN 'skipped' WHEN operation = 'hide' AND o.id IS NULL THEN 'failed' WHEN operation = 'hide' THEN 'hidden' WHEN o.id IS NULL THEN 'created' ELSE 'updated' END AS outcome FROM n LEFT JOIN o ON n.source_work_id = o.source_work_id) SELECT count(*) FILTER (outcome = 'created') AS created, count(*) FILTER (outcome = 'updated') AS updated, count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'hidden') AS hidden, count(*) FILTER (outcome = 'failed') AS failed FROM d", "works")
def q_import_outcomes(spark, sf):
    return packages.outcome_counts(q_incremental_diff(spark, sf))


@query("q_upsert_works", f", {_SIDES} SELECT coalesce(o.source_work_id, n.source_work_id) AS source_work_id, CASE WHEN n.id IS NULL THEN o.content_hash ELSE n.content_hash END AS content_hash, CASE WHEN o.id IS NULL THEN 'second' ELSE 'first' END AS first_seen_at, CASE WHEN n.id IS NULL THEN 'unknown' ELSE 'public' END AS availability FROM o FULL JOIN n ON o.source_work_id = n.source_work_id", "works")
def q_upsert_works(spark, sf):
    old, new = _two_sides(spark, sf)
    state = old.withColumns({"source_id": F.lit(1), "availability": F.lit("unknown"), "first_seen_at": F.lit("first"), "last_seen_at": F.lit("first"), "last_successful_capture_at": F.lit("first")})
    return merge.upsert_works(state, new.withColumn("source_id", F.lit(1)), F.lit("second")).select("source_work_id", "content_hash", "first_seen_at", "availability")


@query("q_replace_set", "SELECT l_orderkey AS source_work_id, l_partkey AS source_tag_id, l_linenumber AS position FROM lineitem WHERE l_returnflag <> 'A' AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') UNION ALL SELECT l_orderkey, l_partkey, min(l_linenumber) FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2")
def q_replace_set(spark, sf):
    l = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("source_work_id"), F.col("l_partkey").alias("source_tag_id"), F.col("l_linenumber").alias("position"), "l_returnflag")
    return merge.replace_work_tags(l.filter("l_returnflag <> 'A'").drop("l_returnflag"), l.filter("l_returnflag = 'A'").drop("l_returnflag"))


@query("q_reconcile_children", """
WITH l AS (SELECT l_orderkey AS w, l_linenumber AS c, min(l_partkey) AS p, bool_or(l_returnflag = 'A') AS stays FROM lineitem GROUP BY 1, 2)
SELECT w AS source_work_id, c AS source_chapter_id, CASE WHEN stays THEN p + 1 ELSE p END AS content FROM l l1
WHERE stays OR NOT EXISTS (SELECT 1 FROM l l2 WHERE l2.w = l1.w AND l2.stays)""")
def q_reconcile_children(spark, sf):
    l = V.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("source_work_id"), F.col("l_linenumber").alias("source_chapter_id")).agg(F.min("l_partkey").alias("content"), F.bool_or(F.col("l_returnflag") == "A").alias("stays"))
    new = l.filter("stays").withColumn("content", F.col("content") + 1)
    return merge.reconcile_chapters(l.drop("stays"), new.drop("stays"))


@query("q_first_write_wins", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def q_first_write_wins(spark, sf):
    e = V.table(spark, sf, "events").select("user_id", "event_id", "ts")
    half = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    first = lambda df: R.first_by_key(df, ["user_id"], "ts", "event_id")
    return merge.first_write(first(e.filter(half)), first(e.filter(~half)), ["user_id"]).select("user_id", "event_id")


@query("q_latest_observation", "SELECT source_work_id, arg_max(availability, observed_at) AS availability FROM obs GROUP BY 1", "obs")
def q_latest_observation(spark, sf):
    return R.latest_by_key(V.observations(spark, sf), ["source_work_id"], ["observed_at", "id"], "availability")


@query("q_export_lineage", ", r AS (SELECT id, job_id AS source_id, 'package-' || id::VARCHAR AS package_id FROM tasks WHERE status = 'succeeded') SELECT package_id, source_id, row_number() OVER w AS sequence_number, lag(package_id) OVER w AS previous_package_id FROM r WINDOW w AS (PARTITION BY source_id ORDER BY id)", "tasks")
def q_export_lineage(spark, sf):
    runs = V.tasks(spark, sf).filter("status = 'succeeded'").select("id", F.col("job_id").alias("source_id"), F.concat(F.lit("package-"), F.col("id").cast("string")).alias("package_id"))
    return packages.lineage(runs).select("package_id", "source_id", "sequence_number", "previous_package_id")


@query("q_import_plan", ", p AS (SELECT id, 'p' || id::VARCHAR AS package_id, CASE WHEN id > 0 THEN 'p' || (id - 1)::VARCHAR END AS previous_package_id FROM works), d AS (SELECT 'p' || id::VARCHAR AS package_id FROM works WHERE language = 'en') SELECT package_id, CASE WHEN package_id IN (SELECT package_id FROM d) THEN 'already_imported' WHEN previous_package_id IS NOT NULL AND previous_package_id NOT IN (SELECT package_id FROM d) THEN 'missing_predecessor' ELSE 'import' END AS decision FROM p", "works")
def q_import_plan(spark, sf):
    name = lambda n: F.concat(F.lit("p"), n.cast("string"))
    w = V.works(spark, sf).select("id", "language")
    package = w.select(name(F.col("id")).alias("package_id"), F.when(F.col("id") > 0, name(F.col("id") - 1)).alias("previous_package_id"))
    done = w.filter("language = 'en'").select(name(F.col("id")).alias("package_id"), F.lit("completed").alias("status"))
    return packages.import_plan(package, done).select("package_id", "decision")


@query("q_distinct_sources", "SELECT DISTINCT source_id FROM jobs ORDER BY 1 LIMIT 50", "jobs")
def q_distinct_sources(spark, sf):
    return V.jobs(spark, sf).select("source_id").distinct().orderBy("source_id").limit(50)


@query("q_content_address", "SELECT DISTINCT 'sha256:' || sha256(html) AS body_hash, 'sha256/' || substr(sha256(html), 1, 2) || '/' || substr(sha256(html), 3, 2) || '/' || sha256(html) || '.html.gz' AS storage_key, octet_length(encode(html))::INT AS byte_length FROM pages")
def q_content_address(spark, sf):
    return blobs(V.table(spark, sf, "pages")).select("body_hash", "storage_key", "byte_length")


@query("q_snapshot_dedupe", "SELECT body_hash, min(id) AS id FROM (SELECT doc_id AS id, sha256(text) AS body_hash FROM documents) GROUP BY body_hash")
def q_snapshot_dedupe(spark, sf):
    snaps = V.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.lit(1).alias("source_id"), F.lit("u").alias("url_hash"), F.sha2("text", 256).alias("body_hash"), F.col("doc_id").alias("fetched_at"), F.lit("v1").alias("parser_version")
    )
    state = merge.add_snapshots(snaps.limit(0), snaps)
    return state.select("body_hash", "id")


@query("q_url_hash", "SELECT page_id, sha256(url) AS url_hash FROM pages")
def q_url_hash(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", X.url_hash("url").alias("url_hash"))


@query("q_url_parts", r"SELECT page_id, CASE WHEN regexp_matches(lower(url), '^https://') THEN lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1)) END AS origin, regexp_replace(url, '/$', '') AS bare FROM pages")
def q_url_parts(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", X.url_origin("url").alias("origin"), X.without_slash("url").alias("bare"))


@query("q_compact_text", r"SELECT doc_id, sha256(trim(regexp_replace(text, '[\s\p{Z}\x{FEFF}\x{85}]+', ' ', 'g'))) AS digest FROM documents")
def q_compact_text(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", F.sha2(X.compact("text"), 256).alias("digest"))


@query("q_parse_count", "SELECT p_partkey, CASE WHEN regexp_matches(trim(replace(t, ',', '')), '^[0-9]+$') THEN trim(replace(t, ',', ''))::BIGINT END AS n FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE ' 1,' || p_partkey::VARCHAR || ' ' END AS t FROM part)")
def q_parse_count(spark, sf):
    t = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.concat(F.lit(" 1,"), F.col("p_partkey").cast("string"), F.lit(" ")))
    return V.table(spark, sf, "part").select("p_partkey", X.parse_count(t).alias("n"))


@query("q_json_extract", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def q_json_extract(spark, sf):
    return V.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("q_language_default", "SELECT doc_id, CASE lang WHEN 'fr' THEN 'fr' WHEN 'de' THEN 'de' ELSE 'en' END AS code FROM documents")
def q_language_default(spark, sf):
    name = F.when(F.col("lang") == "fr", "Français").when(F.col("lang") == "de", "Deutsch").otherwise("Klingon")
    return V.table(spark, sf, "documents").select("doc_id", X.language_code(name).alias("code"))


@query("q_byte_length", "SELECT doc_id, octet_length(encode(text))::INT AS bytes FROM documents")
def q_byte_length(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", X.byte_length("text").alias("bytes"))


@query("q_backoff", "SELECT o_orderkey, round(least(21600000.0, greatest(60000.0, pow(2.0, greatest(0, o_orderkey % 12 - 1)) * 60000.0)))::BIGINT AS delay_ms FROM orders")
def q_backoff(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", TM.retry_delay_ms(F.col("o_orderkey") % 12).alias("delay_ms"))


@query("q_http_class", "SELECT event_id, s = 429 OR s >= 500 AS retryable, CASE s WHEN 404 THEN 'not_found' WHEN 403 THEN 'restricted' ELSE 'unavailable' END AS availability, 'http_' || s::VARCHAR AS code FROM (SELECT event_id, [404, 403, 429, 500, 503][(event_id % 5 + 1)::INT] AS s FROM events)")
def q_http_class(spark, sf):
    s = F.element_at(F.array(*map(F.lit, (404, 403, 429, 500, 503))), (F.col("event_id") % 5 + 1).cast("int"))
    return V.table(spark, sf, "events").select("event_id", TM.is_retryable(s).alias("retryable"), TM.availability_of(s).alias("availability"), TM.failure_code(s).alias("code"))


@query("q_operating_window", "SELECT event_id, hour(ts) >= 22 OR hour(ts) < 6 AS night, hour(ts) >= 8 AND hour(ts) < 18 AS day FROM events")
def q_operating_window(spark, sf):
    return V.table(spark, sf, "events").select("event_id", TM.in_window("ts", F.lit(22), F.lit(6)).alias("night"), TM.in_window("ts", F.lit(8), F.lit(18)).alias("day"))


@query("q_next_utc_day", "SELECT event_id, strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS next_day, strftime(CASE WHEN hour(ts) < 6 THEN date_trunc('day', ts) + INTERVAL 6 HOUR ELSE date_trunc('day', ts) + INTERVAL 30 HOUR END, '%Y-%m-%d %H:%M:%S') AS opens FROM events")
def q_next_utc_day(spark, sf):
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return V.table(spark, sf, "events").select("event_id", text(TM.next_utc_day("ts")).alias("next_day"), text(TM.window_opens("ts", F.lit(6))).alias("opens"))


@query("q_progress_eta", f", {_STATS} SELECT job_id, round(100.0 * (succeeded + failed) / nullif(total, 0), 2)::DOUBLE AS percent, round((60000.0 / nullif(succeeded + failed, 0)) * greatest(0, total - succeeded - failed), 3)::DOUBLE AS remaining_ms FROM st", "tasks")
def q_progress_eta(spark, sf):
    st = queue.task_stats(V.tasks(spark, sf)).withColumn("done", F.col("succeeded") + F.col("failed"))
    return st.select("job_id", TM.progress_percent("done", "total").cast("double").alias("percent"), F.round(TM.remaining_ms(F.lit(60_000.0), "done", "total"), 3).alias("remaining_ms"))


@query("q_comment_depth", """
WITH RECURSIVE c AS (SELECT conv_id, turn, CASE WHEN turn > 0 THEN turn - 1 END AS parent FROM conversations),
d AS (SELECT conv_id, turn, 0 AS depth FROM c c1 WHERE parent IS NULL OR NOT EXISTS (SELECT 1 FROM c c2 WHERE c2.conv_id = c1.conv_id AND c2.turn = c1.parent)
UNION ALL SELECT c.conv_id, c.turn, d.depth + 1 FROM c JOIN d ON c.conv_id = d.conv_id AND c.parent = d.turn)
SELECT conv_id AS work_id, turn::VARCHAR AS comment_id, depth FROM d""")
def q_comment_depth(spark, sf):
    return R.thread_depth(V.comments(spark, sf), ["work_id"], "comment_id", "parent_id").select("work_id", "comment_id", "depth")


@query("q_comments_page", "SELECT conv_id AS work_id, turn AS depth FROM conversations ORDER BY turn, conv_id LIMIT 100 OFFSET 100")
def q_comments_page(spark, sf):
    return R.page(V.comments(spark, sf).select("work_id", F.col("turn").alias("depth")), "depth", "work_id", limit=100, offset=100)


@query("q_creator_replies", "SELECT conv_id AS work_id, count(*) FILTER (role = 'assistant') AS replies, count(*) AS comments FROM conversations GROUP BY 1")
def q_creator_replies(spark, sf):
    return V.comments(spark, sf).groupBy("work_id").agg(F.count_if(F.col("role") == "assistant").alias("replies"), F.count("*").alias("comments"))


@query("q_default_tags", "WITH t AS (SELECT DISTINCT l_orderkey AS w, p_type AS type, CASE WHEN p_name = 'red widget' THEN 'scarlet widget' ELSE p_name END AS name FROM lineitem JOIN part ON l_partkey = p_partkey), r(type, name) AS (VALUES ('ECONOMY', 'Not Rated'), ('MISSING', 'None')) SELECT w AS source_work_id, type, name FROM t UNION ALL SELECT w, r.type, r.name FROM (SELECT DISTINCT w FROM t) d, r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.w = d.w AND t.type = r.type)")
def q_default_tags(spark, sf):
    rows = V.work_tags(spark, sf).join(V.tags(spark, sf), "source_tag_id").select("source_work_id", "type", "name")
    named = R.with_defaults(rows, "source_work_id", "type", "name", {"ECONOMY": "Not Rated", "MISSING": "None"}, {"red widget": "scarlet widget"})
    return named.distinct()


@query("q_byline", "SELECT l_orderkey AS source_work_id, CASE WHEN bool_and(s_suppkey % 3 = 0) THEN 'Anonymous' ELSE string_agg(s_name, ', ' ORDER BY l_linenumber, s_name) END AS byline FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def q_byline(spark, sf):
    return packages.bylines(V.work_authors(spark, sf), V.authors(spark, sf))


@query("q_event_log_page", "SELECT event_id, event_type FROM events WHERE event_type = 'error' ORDER BY event_id DESC LIMIT 100")
def q_event_log_page(spark, sf):
    return R.page(R.maybe(V.table(spark, sf, "events"), event_type="error", user_id=None), F.desc("event_id"), limit=100).select("event_id", "event_type")


@query("q_event_retention", "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 14 DAY GROUP BY 1")
def q_event_retention(spark, sf):
    log = V.table(spark, sf, "events").withColumn("created_at", F.col("ts"))
    return usage.retained(log, F.lit("2024-01-30").cast("timestamp_ntz")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("q_id_batches", "SELECT batch, count(*) AS n, min(id) AS first, max(id) AS last FROM (SELECT id, floor((id - lo) / 250)::BIGINT AS batch FROM (SELECT unnest(range(min(l_orderkey), max(l_orderkey) + 1)) AS id, min(l_orderkey) AS lo FROM lineitem)) GROUP BY batch")
def q_id_batches(spark, sf):
    lo, hi = V.work_tags(spark, sf).agg(F.min("source_work_id"), F.max("source_work_id")).first()
    return R.sequence_in_batches(lo, hi, 250, spark).groupBy("batch").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))


@query("q_works_by_author", "SELECT l_suppkey AS source_author_id, count(DISTINCT l_orderkey) AS works FROM lineitem GROUP BY 1")
def q_works_by_author(spark, sf):
    return V.work_authors(spark, sf).groupBy("source_author_id").agg(F.countDistinct("source_work_id").alias("works"))


@query("q_childless", "SELECT id FROM works WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = works.id)", "works")
def q_childless(spark, sf):
    return integrity.childless(V.works(spark, sf), V.table(spark, sf, "labels").withColumnRenamed("doc_id", "id"), "id").select("id")


@query("q_title_case_words", r"SELECT p_partkey AS id, regexp_replace(regexp_replace(replace(p_name, ' ', '_') || p_brand || 'Of' || p_type, '([a-z])([A-Z])', '\1 \2', 'g'), '_', ' ', 'g') AS words FROM part")
def q_title_case_words(spark, sf):
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), "p_brand", F.lit("Of"), "p_type")
    return V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), X.spaced_words(name).alias("words"))


@query("q_html_title_h1", r"SELECT page_id, trim(regexp_extract(html, '<h1[^>]*>([^<]*)', 1)) AS heading, octet_length(encode(regexp_extract(html, '<h1[^>]*>([^<]*)', 1)))::BIGINT AS heading_bytes FROM pages")
def q_html_title_h1(spark, sf):
    heading = F.regexp_extract("html", "<h1[^>]*>([^<]*)", 1)
    return V.table(spark, sf, "pages").select("page_id", F.trim(heading).alias("heading"), X.byte_length(heading).cast("bigint").alias("heading_bytes"))


@query("q_html_links")
def q_html_links(spark, sf):
    p = V.table(spark, sf, "pages")
    return p.select("page_id", "url", F.posexplode(extract.page_links(F.col("html"))).alias("ord", "href")).select("page_id", "ord", X.absolute_url("href", "url").alias("link"))


@query("q_html_text")
def q_html_text(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", X.html_text("html").alias("text"))
