from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.functions import timing as TM
from quillspark.operators import coverage, integrity, merge, packages, queue
from quillspark.operators import relational as R
from quillspark.sources import packages as P

NOW = datetime(2024, 1, 1, 12)


def at(minutes=0):
    return NOW + timedelta(minutes=minutes)


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'bigint'}" for k, v in values.items())).select(column).first()[0]


def test_text_functions(spark):
    assert one(spark, X.compact("t"), t="  a \t﻿b\n") == "a b"
    assert [one(spark, X.parse_count("t"), t=t) for t in ("1,234", " 7 ", "x", "")] == [1234, 7, None, None]
    assert one(spark, X.content_hash("t"), t="") == "sha256:e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert one(spark, X.id_from_href("h", F.lit("f")), h="/tags/A%20B+C/works") == "A B+C"
    assert one(spark, X.id_from_href("h", F.lit("f")), h="/other") == "/other"
    assert one(spark, X.id_from_href("h", F.lit("f")), h=None) == "f"
    assert one(spark, X.percent_encode("t"), t="a b/(c)!") == "a%20b%2F(c)!"
    assert one(spark, X.canonical_json(F.col("t").alias("a"), F.lit(None).cast("string").alias("b")), t='q"\x1f') == '{"a":"q\\"\\u001f","b":null}'
    assert one(spark, X.tag_works_url(F.lit("https://a.example"), "t", 3), t="S") == "https://a.example/tags/S/works?page=3"
    assert one(spark, X.url_origin("t"), t="http://127.0.0.1:80/x") == "http://127.0.0.1:80" and one(spark, X.url_origin("t"), t="http://a.example/") is None
    assert one(spark, X.is_iso_date("t"), t="2024-02-30") is False and one(spark, X.is_iso_datetime("t"), t="2024-02-03T04:05:06Z") is True
    assert one(spark, X.html_paragraphs("t"), t="<p>a<p>b <b>c</b><script>x</script><li>d") == ["a", "b c", "d"]


def test_timing(spark):
    assert [one(spark, TM.retry_delay_ms("n"), n=n) for n in (1, 2, 20)] == [60_000, 120_000, 21_600_000]
    assert one(spark, TM.pace_ms("n", F.lit(250)), n=10_000) == 345_600
    assert one(spark, TM.http_retry_ms("n", F.lit(10_000)), n=9) == 300_000
    assert one(spark, TM.http_retry_ms("n", F.lit(10_000), F.lit("20")), n=1) == 20_000
    assert one(spark, TM.unlimited("n"), n=0) is None


def tables(spark):
    sources = spark.createDataFrame([(1, False), (2, True)], "id long, paused boolean")
    jobs = spark.createDataFrame(
        [(1, 1, "queued", "completed", at(-90), None, None), (2, 2, "running", "completed", at(-90), None, None), (3, 1, "cancelled", "completed", at(-90), None, None)],
        "id long, source_id long, status string, planning_status string, updated_at timestamp, started_at timestamp, completed_at timestamp",
    )
    tasks = spark.createDataFrame(
        [(1, 1, "10", "queued", 0, at(-5), None, None, None), (2, 1, "11", "leased", 1, at(-9), at(-1), "w", "old"), (3, 1, "12", "queued", 0, at(5), None, None, None), (4, 2, "13", "queued", 0, at(-5), None, None, None), (5, 3, "14", "terminal_failed", 3, at(-5), None, None, None)],
        "id long, job_id long, source_work_id string, status string, attempts int, available_at timestamp, lease_expires_at timestamp, leased_by string, lease_token string",
    ).withColumns({"last_error_code": F.lit(None).cast("string"), "last_error_message": F.lit(None).cast("string"), "updated_at": F.col("available_at")})
    return sources, jobs, tasks


def test_claims(spark):
    sources, jobs, tasks = tables(spark)
    now = F.lit(NOW)
    claimed, started = queue.claim_tasks(tasks, jobs, sources, now, "w2", "tok", 5)
    assert {r["id"]: (r["status"], r["attempts"]) for r in claimed.filter("lease_token = 'tok'").collect()} == {1: ("leased", 1), 2: ("leased", 2)}
    assert started.filter("id = 1").first()["status"] == "running"
    done = queue.complete(claimed, 1, "tok", now, "succeeded")
    assert done.filter("id = 1").first()["status"] == "succeeded"
    assert queue.complete(claimed, 1, "other", now, "succeeded").filter("id = 1").first()["status"] == "leased"
    assert queue.reclaim_expired(tasks, jobs, now).filter("id = 2").first()["last_error_code"] == "worker_lease_expired"
    assert queue.retry_failures(tasks, 3, now).filter("id = 5").first()["attempts"] == 0
    with pytest.raises(ValueError):
        queue.claim_tasks(tasks, jobs, sources, now, "w", "t", 101)


def test_job_states(spark):
    sources, jobs, tasks = tables(spark)
    now = F.lit(NOW)
    assert {r["id"]: r["status"] for r in queue.recompute_jobs(jobs, tasks, now).collect()} == {1: "queued", 2: "running", 3: "cancelled"}
    assert {r["id"]: r["stall"] for r in queue.stalled_jobs(jobs, tasks.withColumn("updated_at", F.lit(at(-60))), sources, now).collect()} == {1: "worker_stalled", 2: "source_paused"}
    j, t, outcome = queue.delete_job(jobs, tasks, 3)
    assert (outcome.first()[0], j.count(), t.count()) == ("deleted", 2, 4)
    assert queue.delete_job(jobs, tasks, 1)[2].first()[0] == "not_deletable" and queue.delete_job(jobs, tasks, 9)[2].first()[0] == "not_found"
    grown = queue.enqueue(tasks, spark.createDataFrame([(1, "10"), (1, "20"), (1, "20"), (2, "20")], "job_id long, source_work_id string"), now, 100)
    assert sorted(r["id"] for r in grown.filter("id >= 100").collect()) == [100, 101]


def test_coverage_and_gaps(spark):
    ids = lambda *x: spark.createDataFrame([(str(i),) for i in x], "source_work_id string")
    got = coverage.coverage(ids(1, 2, 2, 50), ids(3, 3), ids(2, 4, "x"), 1, 10).first().asDict()
    assert got == {"total": 10, "collected": 2, "not_found": 2, "attempted": 2, "handled": 4, "missing": 6}
    empty = coverage.coverage(ids(), ids(), ids(), 1, 3).first().asDict()
    assert empty["missing"] == 3 and empty["collected"] == 0
    gaps = coverage.find_gaps(spark, ids(2, 3, 4), 1, 10, 5, "source_work_id")
    assert [r["id"] for r in gaps.collect()] == [1, 5, 6, 7, 8]
    assert coverage.next_cursor(gaps, 1, 10, 5).first()[0] is None


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "k long, v string, first string")
    new = spark.createDataFrame([(2, None, "y"), (3, "c", "y")], "k long, v string, first string")
    got = {r["k"]: (r["v"], r["first"]) for r in merge.merge(old, new, ["k"], {"first": "keep"}).collect()}
    assert got == {1: ("a", "x"), 2: (None, "x"), 3: ("c", "y")}
    assert {r["k"]: r["v"] for r in merge.merge(old, new, ["k"], {"v": "fill"}).collect()}[2] == "b"
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "o long, k long, v string")
    fresh = spark.createDataFrame([(1, 2, "B"), (1, 3, "d")], "o long, k long, v string")
    assert sorted(map(tuple, merge.reconcile(rows, fresh, ["o"], ["o", "k"]).collect())) == [(1, 2, "B"), (1, 3, "d"), (2, 1, "c")]
    assert merge.reconcile(rows, fresh.limit(0), ["o"], ["o", "k"]).count() == 3
    sets = merge.merge_record_sets([old, new], ["k"]).collect()
    assert {r["k"]: r["first"] for r in sets} == {1: "x", 2: "x", 3: "y"}


def test_thread_depth(spark):
    rows = [("t", str(i), str(i - 1) if i else None) for i in range(40)] + [("u", "1", "2"), ("u", "2", "1"), ("u", "3", "9")]
    df = spark.createDataFrame(rows, "w string, id string, up string")
    got = {(r["w"], r["id"]): r["depth"] for r in R.thread_depth(df, ["w"], "id", "up").collect()}
    assert all(got["t", str(i)] == i for i in range(40))
    assert (got["u", "1"], got["u", "2"], got["u", "3"]) == (2, 2, 0)
    named = df.select(F.col("w").alias("n"), F.col("id").alias("rows"), F.col("up").alias("moved"), F.lit("own").alias("path"), F.lit(-1).alias("depth"))
    assert {(r["n"], r["rows"]): r["depth"] for r in R.thread_depth(named, ["n"], "rows", "moved").collect()} == got


def test_relational(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    with pytest.raises(Exception, match="value is missing: 2"):
        R.strict_lookup(df, df.filter("k = 1").select("k"), "k", "value").collect()
    assert R.search(df, None, "v").count() == 2 and R.search_folded(df, "  ", "v").count() == 0
    with pytest.raises(ValueError):
        R.page(df, "k", limit=101)


def record_sets(spark):
    sets = {name: spark.createDataFrame([], P.record_schema(name)) for name in P.FILES}
    h = "sha256:" + "0" * 64
    sets["works"] = spark.createDataFrame([("upsert", "12", "https://a.example/works/12", "T", "", "en", None, "2024-01-01", True, False, 1, 5, "", "", h)], P.record_schema("works"))
    sets["chapters"] = spark.createDataFrame([("12", "1", 1, "é", "", "", "<p>x</p>", "", None, None, h)], P.record_schema("chapters"))
    sets["authors"] = spark.createDataFrame([("user:a", "a", None, False, False)], P.record_schema("authors"))
    sets["workAuthors"] = spark.createDataFrame([("12", "user:a", 1)], P.record_schema("workAuthors"))
    return sets


MANIFEST = {
    "format": "f", "formatVersion": 1, "packageId": "123e4567-e89b-42d3-a456-426614174000", "packageType": "snapshot", "source": {"key": "s", "origin": "https://a.example"},
    "createdAt": "2024-01-01T00:00:00Z", "collectorVersion": "1", "previousPackageId": None,
}


def test_package_round_trip(spark, tmp_path):
    folder = f"{tmp_path}/p"
    P.write_package(spark, folder, MANIFEST, record_sets(spark))
    _, sets, violations = P.read_package(spark, folder, "f")
    assert violations.collect() == []
    assert sets["chapters"].first()["title"] == "é" and sets["comments"].count() == 0
    (tmp_path / "p" / "authors.jsonl").write_text('{"sourceAuthorId":5,"name":"","profileUrl":null,"anonymous":false}\nnope\n')
    _, _, violations = P.read_package(spark, folder, "g")
    found = {(r["kind"], r["key"]) for r in violations.collect()}
    assert ("checksum mismatch", "authors.jsonl") in found and ("manifest", "format") in found
    assert {k for kind, k in found if kind == "row"} == {"authors.jsonl:1: sourceAuthorId: Expected string, received bigint", "authors.jsonl:1: name: Invalid value", "authors.jsonl:1: orphaned: Required", "authors.jsonl:2: not a JSON object"}
    assert ("count", "authors") in found and ("workAuthors refers to missing authors", "user:a") in found
    with pytest.raises(ValueError, match="checksum mismatch"):
        P.require(violations)


def test_bad_references_are_not_written(spark, tmp_path):
    sets = record_sets(spark)
    sets["authors"] = sets["authors"].limit(0)
    with pytest.raises(ValueError, match="workAuthors refers to missing authors"):
        P.write_package(spark, f"{tmp_path}/p", MANIFEST, sets)
    assert {r["kind"] for r in integrity.incomplete(record_sets(spark) | {"chapters": sets["chapters"].limit(0)}).collect()} == {"work without chapters"}


def test_import_and_export(spark):
    works = spark.createDataFrame([(1, "a", None), (2, "b", "b"), (3, "c", "x")], "id long, content_hash string, last_exported_hash string").withColumns({"last_exported_at": F.lit(None).cast("timestamp"), "last_export_package_id": F.lit(None).cast("string")})
    changed = packages.changed_works(works, 10)
    assert [r["id"] for r in changed.collect()] == [1, 3]
    marked = packages.mark_exported(works, changed, "p", F.lit(NOW))
    assert packages.changed_works(marked, 10).count() == 0
    with pytest.raises(ValueError):
        packages.changed_works(works, 0)
