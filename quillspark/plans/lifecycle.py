"""Queries of leases, exports and files. What the tables at hand don't hold as files is written from them into the shared folder and read back; the SQL gives the same rows
straight from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import control, coverage, detail, merge, packages, queue
from ..session import checkpoint_dir
from ..sources import files, replay
from ..sources import packages as P
from ..streaming import leases, usage
from . import views as V
from .catalog import _NOW, query


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _files(rows: DataFrame, folder: str, name: str) -> None:
    """Rows (file, ord, value) as text files of a folder, ``<name>-<file>``, lines by ord. There are few files, each is written by one task."""
    spark = rows.sparkSession
    rows.repartition("file").sortWithinPartitions("file", "ord").select("file", "value").write.partitionBy("file").text(f"{folder}/parts")
    fs = spark._jvm.org.apache.hadoop.fs
    root = fs.Path(folder)
    disk = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for part in disk.listStatus(fs.Path(root, "parts")):
        if part.isDirectory():
            found = [f.getPath() for f in disk.listStatus(part.getPath()) if f.getPath().getName().startswith("part-")]
            disk.rename(found[0], fs.Path(root, f"{name}-{part.getPath().getName().split('=')[1]}"))
    disk.delete(fs.Path(root, "parts"), True)


# Each user's events as a task's log: leases of twelve hours, work put off by six.
_LEASE_HOURS, _LATER_HOURS = 12, 6


@query("q_lease_log", f"""
WITH RECURSIVE log AS (SELECT user_id AS key, event_id AS seq, ts AS "at", CASE event_type WHEN 'signup' THEN 'claim' WHEN 'view' THEN 'heartbeat' WHEN 'purchase' THEN 'complete' WHEN 'click' THEN 'defer' ELSE 'retry' END AS action,
    't' || (event_id % 2) AS token, CASE WHEN event_id % 20 = 0 THEN 'succeeded' WHEN event_id % 3 = 0 THEN 'terminal_failed' ELSE 'retryable_failed' END AS outcome, ts + INTERVAL {_LATER_HOURS} HOUR AS later, 'c' || (event_id % 5) AS code,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
run AS (SELECT user_id AS key, 0::BIGINT AS n, min(ts) AS "at", -1::BIGINT AS seq, 'create' AS action, true AS matched, 'queued' AS status, 0::BIGINT AS attempts, NULL::VARCHAR AS lease_token, NULL::TIMESTAMP AS lease_expires_at,
    min(ts) AS available_at, NULL::VARCHAR AS last_error_code, NULL::TIMESTAMP AS lost, 0::BIGINT AS had FROM events GROUP BY user_id
  UNION ALL SELECT key, n, "at", seq, action, ok, CASE WHEN NOT ok THEN s WHEN action IN ('claim', 'heartbeat') THEN 'leased' WHEN action = 'complete' THEN outcome ELSE 'queued' END,
    CASE WHEN ok AND action = 'claim' THEN a + 1 WHEN ok AND action = 'retry' THEN 0 ELSE a END, CASE WHEN ok AND action = 'claim' THEN token WHEN ok AND action IN ('complete', 'defer') THEN NULL ELSE t END,
    CASE WHEN ok AND action IN ('claim', 'heartbeat') THEN "at" + INTERVAL {_LEASE_HOURS} HOUR WHEN ok AND action IN ('complete', 'defer') THEN NULL ELSE x END,
    CASE WHEN ok AND (action = 'defer' OR action = 'complete' AND outcome = 'retryable_failed') THEN later WHEN ok AND action IN ('complete', 'retry') THEN "at" ELSE d END,
    CASE WHEN ok AND (action = 'retry' OR action = 'complete' AND outcome = 'succeeded') THEN NULL WHEN ok AND action IN ('complete', 'defer') THEN code ELSE c END, lost, a
  FROM (SELECT *, coalesce(CASE action WHEN 'claim' THEN s IN ('queued', 'retryable_failed') AND d <= "at" WHEN 'retry' THEN s = 'terminal_failed' ELSE s = 'leased' AND t = token END, false) AS ok
    FROM (SELECT l.*, CASE WHEN gone THEN 'retryable_failed' WHEN NOT over THEN r.status END AS s, CASE WHEN NOT over THEN r.attempts END AS a, CASE WHEN NOT gone AND NOT over THEN r.lease_token END AS t,
        CASE WHEN NOT gone AND NOT over THEN r.lease_expires_at END AS x, CASE WHEN gone THEN r.lease_expires_at WHEN NOT over THEN r.available_at END AS d,
        CASE WHEN gone THEN 'worker_lease_expired' WHEN NOT over THEN r.last_error_code END AS c, CASE WHEN gone THEN r.lease_expires_at END AS lost
      FROM (SELECT run.*, coalesce(run.status = 'leased' AND run.lease_expires_at <= log."at", false) AS gone, coalesce(run.status, 'succeeded') = 'succeeded' AS over FROM run JOIN log ON log.key = run.key AND log.n = run.n + 1) r
      JOIN log l ON l.key = r.key AND l.n = r.n + 1))),
ends AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC) AS back FROM run)
SELECT key, "at", seq, action, matched, status, attempts, lease_token, lease_expires_at, available_at, last_error_code FROM run
UNION ALL SELECT key, lost, NULL, 'reclaim', true, 'retryable_failed', had, NULL, NULL, lost, 'worker_lease_expired' FROM run WHERE lost IS NOT NULL
UNION ALL SELECT key, lease_expires_at, NULL, 'reclaim', true, 'retryable_failed', attempts, NULL, NULL, lease_expires_at, 'worker_lease_expired' FROM ends
    WHERE back = 1 AND status = 'leased' AND lease_expires_at <= (SELECT max(ts) FROM events)""")
def q_lease_log(spark, sf):
    e = V.table(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    kinds = {"signup": "claim", "view": "heartbeat", "purchase": "complete", "click": "defer"}
    action = F.lit("retry")
    for kind, name in kinds.items():
        action = F.when(F.col("event_type") == kind, name).otherwise(action)
    i = F.col("event_id")
    args = F.create_map(
        F.lit("token"), F.concat(F.lit("t"), (i % 2).cast("string")), F.lit("outcome"), F.when(i % 20 == 0, "succeeded").when(i % 3 == 0, "terminal_failed").otherwise("retryable_failed"),
        F.lit("due"), F.unix_micros(F.col("at") + F.expr(f"INTERVAL {_LATER_HOURS} HOURS")).cast("string"), F.lit("code"), F.concat(F.lit("c"), (i % 5).cast("string")),
    )
    log = e.select(F.col("user_id").alias("key"), "at", i.alias("seq"), action.alias("action"), args.alias("args"))
    begun = log.groupBy("key").agg(F.min("at").alias("at")).select("key", "at", F.lit(-1).cast("bigint").alias("seq"), F.lit("create").alias("action"), F.create_map().cast("map<string,string>").alias("args"))
    last = log.agg(F.max(F.unix_micros("at"))).first()[0]
    played = leases.replay(begun.unionByName(log), leases.Tasks(_LEASE_HOURS * 3600), last)
    return played.select([F.col(c).cast("timestamp_ntz") if c in ("at", "lease_expires_at", "available_at") else F.col(c) for c in played.columns])


_RUNS = f"""
s AS (SELECT n_nationkey::BIGINT AS id, CASE n_nationkey % 3 WHEN 1 THEN {_NOW} - INTERVAL 1 MINUTE WHEN 2 THEN {_NOW} + INTERVAL 1 MINUTE END AS until, 1000 + n_nationkey::BIGINT AS next FROM nation),
r AS (SELECT c_custkey AS id, c_nationkey::BIGINT AS source_id, ['completed', 'queued', 'leased', 'writing', 'failed'][(c_custkey % 5 + 1)::INT] AS status, CASE WHEN c_custkey % 5 IN (0, 2, 3) THEN c_custkey END AS number, {_NOW} + ((c_custkey % 7) - 3) * INTERVAL 1 MINUTE AS until FROM customer)"""


def _exports(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Customers as export runs of their nations, in all states."""
    n, k = F.col("n_nationkey"), F.col("c_custkey")
    lease = F.when(n % 3 == 1, V.now() - F.expr("INTERVAL 1 MINUTE")).when(n % 3 == 2, V.now() + F.expr("INTERVAL 1 MINUTE"))
    sources = V.table(spark, sf, "nation").select(n.cast("bigint").alias("id"), F.when(n % 3 != 0, "old").alias("export_lease_token"), lease.alias("export_lease_expires_at"), (n + 1000).cast("bigint").alias("next_export_sequence"))
    status = F.element_at(F.array(*map(F.lit, ("completed", "queued", "leased", "writing", "failed"))), (k % 5 + 1).cast("int"))
    until = F.timestamp_add("MINUTE", (k % 7 - 3).cast("int"), V.now())
    runs = V.table(spark, sf, "customer").select(
        k.alias("id"), F.col("c_nationkey").cast("bigint").alias("source_id"), F.concat(F.lit("p"), k.cast("string")).alias("package_id"), F.when((k % 5).isin(2, 3), "before").alias("previous_package_id"),
        F.when((k % 5).isin(0, 2, 3), k).alias("sequence_number"), status.alias("status"), F.when((k % 5).isin(2, 3), "old").alias("lease_token"), F.when((k % 5).isin(2, 3), until).alias("lease_expires_at"),
    )
    return runs, sources


@query("q_export_claims", f"""
WITH {_RUNS}, c AS (SELECT r.*, s.next, row_number() OVER (PARTITION BY source_id ORDER BY r.id) AS n FROM r JOIN s ON s.id = source_id
    WHERE (s.until IS NULL OR s.until <= {_NOW}) AND (status = 'queued' OR status IN ('leased', 'writing') AND r.until <= {_NOW}))
SELECT id, source_id, coalesce(number, next) AS sequence_number, CASE WHEN number IS NULL THEN (SELECT 'p' || arg_max(x.id, x.number) FROM r x WHERE x.source_id = c.source_id AND x.status = 'completed') ELSE 'before' END AS previous_package_id,
    next + (number IS NULL)::INT AS next_export_sequence FROM c WHERE n = 1""")
def q_export_claims(spark, sf):
    runs, held = queue.claim_export(*_exports(spark, sf), V.now(), "new")
    taken = held.filter("export_lease_token = 'new'").select(F.col("id").alias("source_id"), "next_export_sequence")
    return runs.filter("lease_token = 'new'").join(taken, "source_id").select("id", "source_id", "sequence_number", "previous_package_id", "next_export_sequence")


@query("q_reclaim_planning", f"SELECT CASE WHEN id % 7 = 0 AND status IN ('queued', 'running') AND id % 3 <> 0 THEN 'queued' WHEN id % 7 = 0 THEN 'planning' ELSE 'completed' END AS planning_status, id % 7 = 0 AND (id % 3 = 0 OR status NOT IN ('queued', 'running')) AS held, count(*) AS n FROM jobs GROUP BY ALL", "jobs")
def q_reclaim_planning(spark, sf):
    due = (F.col("id") % 7) == 0
    jobs = V.jobs(spark, sf).withColumns({
        "planning_status": F.when(due, "planning").otherwise(F.col("planning_status")), "planning_lease_token": F.when(due, "p"),
        "planning_lease_expires_at": F.when(due, F.when(F.col("id") % 3 == 0, V.now() + F.expr("INTERVAL 1 MINUTE")).otherwise(V.now())), "planning_error": F.lit(None).cast("string"),
    })
    return queue.reclaim_planning(jobs, V.now()).groupBy("planning_status", F.col("planning_lease_token").isNotNull().alias("held")).agg(F.count("*").alias("n"))


@query("q_record_violations", """
WITH t AS (SELECT p_partkey AS k, p_size % 5 AS f, row_number() OVER (PARTITION BY p_size % 5 ORDER BY p_partkey) AS line FROM part)
SELECT 'tags-' || f AS file, line, CASE WHEN k % 11 = 0 THEN 'not a JSON object' WHEN k % 13 = 0 THEN 'name: Required' WHEN k % 17 = 0 THEN 'type: Invalid value' ELSE 'canonical: Expected boolean, received string' END AS problem
FROM t WHERE k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 OR k % 19 = 0
UNION ALL SELECT 'tags-' || f, line, 'type: Invalid value' FROM t WHERE k % 11 <> 0 AND k % 13 = 0 AND k % 17 = 0
UNION ALL SELECT 'tags-' || f, line, 'canonical: Expected boolean, received string' FROM t WHERE k % 11 <> 0 AND k % 19 = 0 AND (k % 13 = 0 OR k % 17 = 0)""")
def q_record_violations(spark, sf):
    k = F.col("p_partkey")
    tag = F.to_json(F.struct(
        F.concat(F.lit("t"), k.cast("string")).alias("sourceTagId"), F.when(k % 17 == 0, "Odd").otherwise("Fandom").alias("type"), F.when(k % 13 != 0, F.col("p_name")).alias("name"),
    ))
    more = F.concat(F.expr("substring(tag, 1, length(tag) - 1)"), F.when(k % 19 == 0, ',"canonical":"yes"').otherwise(',"canonical":null'), F.lit(',"sourceUrl":null}'))
    rows = V.table(spark, sf, "part").withColumn("tag", tag).select((F.col("p_size") % 5).alias("file"), k.alias("ord"), F.when(k % 11 == 0, "{").otherwise(more).alias("value"))
    folder = _folder(spark, "records")
    _files(rows, folder, "tags")
    return P.scan_records(spark, folder, "tags")[1]


@query("q_file_digests", """
SELECT 'customers-' || c_nationkey AS name, octet_length(encode(body))::BIGINT AS bytes, sha256(body) AS sha256
FROM (SELECT c_nationkey, string_agg(c_custkey || ' ' || c_name || chr(10), '' ORDER BY c_custkey) AS body FROM customer GROUP BY 1)""")
def q_file_digests(spark, sf):
    rows = V.table(spark, sf, "customer").select(F.col("c_nationkey").alias("file"), F.col("c_custkey").alias("ord"), F.concat_ws(" ", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    folder = _folder(spark, "customers")
    _files(rows, folder, "customers")
    return files.folder_digests(spark, folder)


@query("q_replayed_pages", "SELECT page_id::VARCHAR AS work_id, octet_length(encode(coalesce(html, '')))::BIGINT AS bytes, sha256(coalesce(html, '')) AS digest FROM pages")
def q_replayed_pages(spark, sf):
    folder = _folder(spark, "pages")
    replay.save_pages(V.table(spark, sf, "pages"), folder, "page_id").write.format("noop").mode("overwrite").save()
    replay.register(spark)
    found = spark.read.format("replay").load(folder)
    return found.select("work_id", "bytes", F.sha2("html", 256).alias("digest"))


_HANDLED = "h AS (SELECT DISTINCT l_orderkey AS id FROM lineitem UNION SELECT user_id FROM events WHERE event_type = 'error'), e AS (SELECT max(o_orderkey) AS hi FROM orders)"


def _handled(spark, sf) -> DataFrame:
    missing = V.observations(spark, sf).filter("availability = 'not_found'").select(F.col("source_work_id").cast("bigint").alias("id"))
    return V.work_tags(spark, sf).select(F.col("source_work_id").alias("id")).unionByName(missing)


def _last(spark, sf) -> int:
    return V.table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]


@query("q_handled_ranges", f"""
WITH {_HANDLED}, r AS (SELECT id, id - row_number() OVER (ORDER BY id) AS run FROM h, e WHERE id BETWEEN 1 AND hi)
SELECT min(id) AS first, max(id) AS last FROM r GROUP BY run""")
def q_handled_ranges(spark, sf):
    return coverage.islands(_handled(spark, sf), 1, _last(spark, sf))


@query("q_gap_ranges", f"""
WITH {_HANDLED}, x AS (SELECT id FROM h, e WHERE id BETWEEN 1 AND hi UNION SELECT 0 UNION SELECT hi + 1 FROM e), n AS (SELECT id, lead(id) OVER (ORDER BY id) AS after FROM x)
SELECT id + 1 AS first, after - 1 AS last FROM n WHERE after > id + 1""")
def q_gap_ranges(spark, sf):
    return coverage.gap_ranges(_handled(spark, sf), 1, _last(spark, sf))


@query("q_first_gaps", f"WITH {_HANDLED} SELECT x.id FROM (SELECT unnest(range(1, hi + 1)) AS id FROM e) x LEFT JOIN h ON h.id = x.id WHERE h.id IS NULL ORDER BY 1 LIMIT 5000")
def q_first_gaps(spark, sf):
    return coverage.first_gaps(q_gap_ranges(spark, sf), 5000)


@query("q_auto_fill", f"""
WITH {_HANDLED}, g AS (SELECT x.id FROM (SELECT unnest(range(1, 10001)) AS id) x LEFT JOIN h ON h.id = x.id WHERE h.id IS NULL ORDER BY 1 LIMIT 50),
c AS (SELECT count(*) AS n, CASE WHEN count(*) >= 50 THEN (floor((max(id) - 1) / 3000) + 1) * 3000 + 1 ELSE 10001 END AS cursor FROM g WHERE id <= 5001)
SELECT id::VARCHAR AS source_work_id, 1000000 + row_number() OVER (ORDER BY id::VARCHAR) - 1 AS task_id, (SELECT least(cursor, 5002) FROM c)::BIGINT AS frontier FROM g WHERE id <= 5001""")
def q_auto_fill(spark, sf):
    sources = spark.createDataFrame([(1, False)], "id long, paused boolean")
    configs = spark.createDataFrame([(1, True, 1, 50, None, None, None)], "source_id long, enabled boolean, frontier_start long, batch_size long, last_job_id long, last_run_at timestamp_ntz, updated_at timestamp_ntz")
    jobs, tasks = V.jobs(spark, sf).filter("id < 0"), V.tasks(spark, sf).filter("id < 0")
    configs, _, tasks, _ = control.auto_fill(sources, configs, jobs, tasks, _handled(spark, sf), 7, 1_000_000, V.now())
    return tasks.select("source_work_id", F.col("id").alias("task_id")).crossJoin(F.broadcast(configs.select(F.col("frontier_start").alias("frontier"))))  # one row


@query("q_observations_merge", f"""
, n AS (SELECT source_work_id, observed_at, 'new' AS content_hash FROM obs WHERE id % 3 = 0 UNION ALL SELECT source_work_id, observed_at + INTERVAL 1 SECOND, 'new' FROM obs WHERE id % 5 = 0)
SELECT coalesce(o.source_work_id, n.source_work_id) AS source_work_id, coalesce(o.observed_at, n.observed_at) AS observed_at, coalesce(n.content_hash, 'old') AS content_hash, coalesce(o.availability, 'unknown') AS availability
FROM obs o FULL JOIN n ON n.source_work_id = o.source_work_id AND n.observed_at = o.observed_at""", "obs")
def q_observations_merge(spark, sf):
    old = V.observations(spark, sf).select("id", "source_id", "source_work_id", "observed_at", "availability", F.lit("old").alias("content_hash"))
    again = old.filter("id % 3 = 0").withColumns({"content_hash": F.lit("new"), "availability": F.lit("odd")})
    later = old.filter("id % 5 = 0").withColumns({"content_hash": F.lit("new"), "availability": F.lit("unknown"), "observed_at": F.col("observed_at") + F.expr("INTERVAL 1 SECOND")})
    return merge.record_observations(old, again.unionByName(later).drop("id")).select("source_work_id", "observed_at", "content_hash", "availability")


@query("q_availability", f"SELECT w.id, coalesce((SELECT arg_max(o.availability, (o.observed_at, o.id)) FROM obs o WHERE o.source_work_id = w.source_work_id), 'unseen') AS availability FROM works w", "works", "obs")
def q_availability(spark, sf):
    works = V.works(spark, sf).withColumn("availability", F.lit("unseen"))
    return merge.propagate_availability(works, V.observations(spark, sf)).select("id", "availability")


@query("q_comments_merge", """
WITH o AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE conv_id % 3 <> 0), n AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE conv_id % 2 = 0)
SELECT coalesce(o.conv_id, n.conv_id) AS source_work_id, coalesce(o.turn, n.turn)::VARCHAR AS source_comment_id, CASE WHEN o.conv_id IS NULL THEN 'second' ELSE 'first' END AS first_seen_at, n.conv_id IS NULL AS hidden
FROM o FULL JOIN n ON n.conv_id = o.conv_id AND n.turn = o.turn""")
def q_comments_merge(spark, sf):
    c = V.comments(spark, sf).select(F.col("work_id").alias("source_work_id"), F.col("comment_id").alias("source_comment_id")).distinct()
    old = c.filter("source_work_id % 3 <> 0").withColumns({"first_seen_at": F.lit("first"), "hidden": F.lit(True)})
    return merge.upsert_comments(old, c.filter("source_work_id % 2 = 0").withColumn("first_seen_at", F.lit("second")))


@query("q_series_merge", """
WITH o AS (SELECT ps AS s, w, min(position) AS position FROM (SELECT l_suppkey AS ps, l_orderkey AS w, l_linenumber AS position FROM lineitem WHERE l_linenumber <= 3) GROUP BY ALL),
n AS (SELECT l_suppkey AS s, l_orderkey AS w, min(l_linenumber) + 10 AS position FROM lineitem WHERE l_linenumber >= 3 GROUP BY ALL),
m AS (SELECT coalesce(o.s, n.s) AS s, coalesce(n.position, o.position) AS position FROM o FULL JOIN n ON n.s = o.s AND n.w = o.w)
SELECT s AS source_series_id, position, count(*) AS n FROM m GROUP BY ALL HAVING count(*) > 1""")
def q_series_merge(spark, sf):
    rows = V.work_authors(spark, sf).select(F.col("source_author_id").alias("source_series_id"), "source_work_id", "position")
    old = rows.filter("position <= 3").groupBy("source_series_id", "source_work_id").agg(F.min("position").alias("position"))
    new = rows.filter("position >= 3").withColumn("position", (F.col("position") + 10).cast(old.schema["position"].dataType))
    return merge.series_collisions(merge.upsert_series_works(old, new))


@query("q_missing_works", "SELECT DISTINCT o_orderkey AS source_work_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def q_missing_works(spark, sf):
    asked = V.tasks(spark, sf).select(F.col("id").alias("source_work_id"))
    return packages.missing_works(asked, V.work_tags(spark, sf).select("source_work_id").distinct())


@query("q_children_of", """
WITH w AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F')
SELECT 'tags' AS name, count(*) AS n, sum(l_partkey)::BIGINT AS keys FROM lineitem WHERE l_orderkey IN (SELECT k FROM w) UNION ALL SELECT 'authors', count(*), sum(l_suppkey)::BIGINT FROM lineitem WHERE l_orderkey IN (SELECT k FROM w)""")
def q_children_of(spark, sf):
    works = V.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("source_work_id"))
    own = packages.children_of(works, {"tags": V.work_tags(spark, sf), "authors": V.work_authors(spark, sf)}, {"tags": "source_work_id", "authors": "source_work_id"})
    counted = [own[name].agg(F.count("*").alias("n"), F.sum(key).cast("bigint").alias("keys")).select(F.lit(name).alias("name"), "n", "keys") for name, key in (("tags", "source_tag_id"), ("authors", "source_author_id"))]
    return counted[0].unionByName(counted[1])


@query("q_fetch_log", """
SELECT event_id AS id, ts AS fetched_at, CASE WHEN event_id % 3 = 0 THEN floor(value * 100)::BIGINT END AS response_bytes, (SELECT count(*) FROM events) AS total FROM events ORDER BY ts DESC, event_id DESC LIMIT 100 OFFSET 50""")
def q_fetch_log(spark, sf):
    headers = F.when(F.col("event_id") % 3 == 0, F.to_json(F.create_map(F.lit("content-length"), F.floor(F.col("value") * 100).cast("string")))).otherwise("{}")
    fetches = V.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("source_work_id"), F.col("event_type").alias("url"), F.lit(200).alias("http_status"), F.col("ts").alias("fetched_at"), F.lit("1").alias("parser_version"),
        headers.alias("response_headers"), F.lit(1).alias("attempts"),
    )
    return detail.fetch_log(fetches, 100, 50).select("id", "fetched_at", "response_bytes", "total")


@query("q_work_details", """
WITH a AS (SELECT l_orderkey AS w, string_agg(s_name, '|' ORDER BY l_linenumber, s_suppkey) AS authors FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1),
t AS (SELECT l_orderkey AS w, string_agg(p_name, '|' ORDER BY l_linenumber, p_partkey::VARCHAR) AS tags FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
c AS (SELECT conv_id AS w, count(*) AS n FROM conversations WHERE turn % 3 <> 2 GROUP BY 1), k AS (SELECT user_id AS w, count(*) AS n FROM events GROUP BY 1)
SELECT o_orderkey::VARCHAR AS work, coalesce(authors, '') AS authors, coalesce(tags, '') AS tags, coalesce(c.n, 0)::BIGINT AS comments, coalesce(k.n, 0)::BIGINT AS kudos
FROM orders LEFT JOIN a ON a.w = o_orderkey LEFT JOIN t ON t.w = o_orderkey LEFT JOIN c ON c.w = o_orderkey LEFT JOIN k ON k.w = o_orderkey""")
def q_work_details(spark, sf):
    def record_set(df: DataFrame, kind: str, **columns) -> DataFrame:
        """Rows with the columns of a record set; those that are not given are null."""
        return df.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in P.record_schema(kind).fields])

    t, line, w = (lambda name: V.table(spark, sf, name)), V.table(spark, sf, "lineitem"), F.col("l_orderkey")
    none = spark.createDataFrame([], "x int")
    store = {
        "works": record_set(t("orders"), "works", sourceWorkId=F.col("o_orderkey")), "chapters": record_set(none, "chapters"), "series": record_set(none, "series"), "seriesWorks": record_set(none, "seriesWorks"), "bookmarks": record_set(none, "bookmarks"),
        "authors": record_set(t("supplier"), "authors", sourceAuthorId=F.lpad(F.col("s_suppkey").cast("string"), 12, "0"), name=F.col("s_name")),
        "workAuthors": record_set(line, "workAuthors", sourceWorkId=w, sourceAuthorId=F.lpad(F.col("l_suppkey").cast("string"), 12, "0"), position=F.col("l_linenumber")),
        "tags": record_set(t("part"), "tags", sourceTagId=F.col("p_partkey"), name=F.col("p_name")), "workTags": record_set(line, "workTags", sourceWorkId=w, sourceTagId=F.col("l_partkey"), position=F.col("l_linenumber")),
        "comments": record_set(t("conversations"), "comments", operation=F.when(F.col("turn") % 3 == 2, "hide").otherwise("upsert"), sourceWorkId=F.col("conv_id"), sourceCommentId=F.col("turn"), depth=F.col("turn")),
        "kudos": record_set(t("events"), "kudos", sourceWorkId=F.col("user_id"), sourceKudoId=F.col("event_id")),
    }
    names = lambda c: F.array_join(F.transform(c, lambda x: x["name"]), "|").alias(c)
    return detail.work_details(store).select(F.col("sourceWorkId").alias("work"), names("authors"), names("tags"), F.size("comments").cast("bigint").alias("comments"), F.col("kudosCount").cast("bigint").alias("kudos"))


@query("q_snapshot", """
SELECT 'jobs' AS event, to_json({'jobs': (SELECT list({'id': id, 'status': status} ORDER BY id DESC) FROM (SELECT * FROM jobs ORDER BY id DESC LIMIT 100))})::VARCHAR AS payload
UNION ALL SELECT 'exports', to_json({'exports': (SELECT list({'id': o_orderkey, 'status': o_orderstatus} ORDER BY o_orderkey DESC) FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 100)), 'total': (SELECT count(*) FROM orders)})::VARCHAR""", "jobs")
def q_snapshot(spark, sf):
    runs = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return usage.snapshot(V.jobs(spark, sf).select("id", "status"), runs)
