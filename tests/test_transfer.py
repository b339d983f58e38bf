"""Imports, exports, publication, listings and the tables that an operator changes."""

import gzip
import hashlib
import io
import tarfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillspark.operators import control, extract, transfer
from quillspark.sources import packages as P

AT = datetime(2025, 3, 4, 5, 6, 7)
RUNS = "package_id string, status string, works_created long, works_updated long, works_skipped long, works_failed long, completed_at timestamp_ntz"


def sets_of(spark, works, chapters=None, tags=(), work_tags=()):
    h = lambda x: "sha256:" + hashlib.sha256(x.encode()).hexdigest()
    sets = {name: spark.createDataFrame([], P.record_schema(name)) for name in P.FILES}
    sets["works"] = spark.createDataFrame([(op, i, f"https://a.example/works/{i}", f"T{i}", "", "en", None, None, True, False, None, 5, "", "", h(v)) for i, op, v in works], P.record_schema("works"))
    own = [(i, "1", "x") for i, _, _ in works] if chapters is None else chapters
    sets["chapters"] = spark.createDataFrame([(i, c, k + 1, "", "", "", body, "", None, None, h(body)) for k, (i, c, body) in enumerate(own)], P.record_schema("chapters"))
    sets["authors"] = spark.createDataFrame([("user:a", "a", None, False, False)], P.record_schema("authors"))
    sets["workAuthors"] = spark.createDataFrame([(i, "user:a", 1) for i, _, _ in works], P.record_schema("workAuthors"))
    sets["tags"] = spark.createDataFrame([(t, "Fandom", t, None, None) for t in tags], P.record_schema("tags"))
    sets["workTags"] = spark.createDataFrame(list(work_tags), P.record_schema("workTags"))
    return sets


def test_import(spark):
    store, runs = transfer.empty_store(spark), spark.createDataFrame([], RUNS)
    first = sets_of(spark, [("1", "upsert", "a"), ("2", "upsert", "a"), ("3", "upsert", "a"), ("4", "hide", "a"), ("5", "upsert", "a")], [("1", "1", "x"), ("1", "2", "y"), ("2", "1", "x"), ("5", "1", "x")], ["t"], [("1", "t", 0), ("5", "lost", 0)])
    same, tried = transfer.apply_import(store, first, runs, "p1", None, F.lit(AT), dry_run=True)
    assert tried.first()["status"] == "verified" and same["works"].count() == 0
    store, runs = transfer.apply_import(store, first, runs, "p1", None, F.lit(AT))
    run = runs.first()
    # 3 has no chapters, 4 is hidden and unknown, 5 has a tag that the package lacks
    assert (run["status"], run["works_created"], run["works_failed"], run["works_skipped"]) == ("partial", 2, 3, 0)
    assert {r["sourceWorkId"] for r in store["works"].collect()} == {"1", "2"} and store["workTags"].count() == 1
    store = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in store.items()}
    whole = sets_of(spark, [("1", "upsert", "b"), ("2", "upsert", "a"), ("6", "upsert", "a")], [("1", "2", "z"), ("2", "1", "x"), ("6", "1", "x")])
    store, runs = transfer.apply_import(store, whole, runs, "p1", None, F.lit(AT))
    run = runs.first()
    assert runs.count() == 1 and (run["status"], run["works_created"], run["works_updated"], run["works_skipped"]) == ("completed", 1, 1, 1)
    assert sorted((r["sourceWorkId"], r["sourceChapterId"], r["contentHtml"]) for r in store["chapters"].collect()) == [("1", "2", "z"), ("2", "1", "x"), ("6", "1", "x")]
    assert transfer.apply_import(store, first, runs, "p1", None, F.lit(AT))[1].collect() == runs.collect()
    with pytest.raises(ValueError, match="comes first"):
        transfer.apply_import(store, first, runs, "p3", "p2", F.lit(AT))
    hide = sets_of(spark, [("2", "hide", "gone")], [])
    store, runs = transfer.apply_import(store, hide, runs, "p2", "p1", F.lit(AT))
    assert [r["sourceWorkId"] for r in store["works"].filter("hidden").collect()] == ["2"]
    assert runs.filter("package_id = 'p2'").first()["works_updated"] == 1


SERIES = {"series": "sourceSeriesId string, name string, sourceUrl string, summaryHtml string, complete boolean", "seriesWorks": "sourceSeriesId string, sourceWorkId string, position long"}


def with_series(spark, sets, series):
    """``sets`` with series: a dict from ids to their works in order."""
    rows = [(s, w, k) for s, own in series.items() for k, w in enumerate(own, 1)]
    return sets | {"series": spark.createDataFrame([(s, f"S{s}", f"https://a.example/series/{s}", "", None) for s in series], SERIES["series"]), "seriesWorks": spark.createDataFrame(rows, SERIES["seriesWorks"])}


def test_import_keeps_hidden_works_and_replaces_series(spark):
    def load(store, runs, package, before, works, series):
        store, runs = transfer.apply_import(store, with_series(spark, sets_of(spark, works), series), runs, package, before, F.lit(AT))
        store = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in store.items()}
        return store, spark.createDataFrame(runs.collect(), runs.schema)

    def places(store):
        return sorted((r["sourceSeriesId"], r["sourceWorkId"], r["position"]) for r in store["seriesWorks"].collect())

    def state(runs, package):
        return tuple(runs.filter(F.col("package_id") == package).select("status", "error_message").first())

    store, runs = transfer.empty_store(spark), spark.createDataFrame([], RUNS + ", error_message string")
    store, runs = load(store, runs, "p1", None, [(k, "upsert", "a") for k in "123"], {"s": ["1", "2", "3"], "t": ["3"]})
    assert state(runs, "p1") == ("completed", None) and places(store) == [("s", "1", 1), ("s", "2", 2), ("s", "3", 3), ("t", "3", 1)]
    store, runs = load(store, runs, "p2", "p1", [("2", "hide", "b")], {})
    store, runs = load(store, runs, "p3", "p2", [("2", "upsert", "c"), ("1", "upsert", "c")], {"s": ["3", "1"]})
    assert {r["sourceWorkId"]: r["hidden"] for r in store["works"].collect()} == {"1": False, "2": True, "3": False}
    assert places(store) == [("s", "1", 2), ("s", "3", 1), ("t", "3", 1)]  # s lost 2, t was not named
    # u has no works, v names a work that nobody knows: nothing from u on is imported, works and series before it are
    failed = with_series(spark, sets_of(spark, [("4", "upsert", "a")]), {"r": ["4"], "u": [], "v": ["9"], "w": ["4"]})
    dry, tried = transfer.apply_import(store, failed, runs, "p4", "p3", F.lit(AT), dry_run=True)
    assert state(tried, "p4") == ("failed", "Series u has no works in the package") and dry is store
    new, grown = transfer.apply_import(store, failed, runs, "p4", "p3", F.lit(AT))
    assert state(grown, "p4") == ("failed", "Series u has no works in the package")
    assert {r["sourceSeriesId"] for r in new["series"].collect()} == {"r", "s", "t"} and ("r", "4", 1) in places(new)
    strange = with_series(spark, sets_of(spark, [("4", "upsert", "a")]), {"v": ["4", "9"]})
    assert state(transfer.apply_import(store, strange, runs, "p4", "p3", F.lit(AT))[1], "p4") == ("failed", "Series v has a work that was not imported: 9")
    assert state(transfer.apply_import(store, strange, runs, "p4", "p3", F.lit(AT), dry_run=True)[1], "p4") == ("verified", None)
    with pytest.raises(ValueError, match="comes first"):  # a failed import is no predecessor
        transfer.apply_import(store, strange, grown, "p5", "p4", F.lit(AT))


def test_import_gives_works_their_required_tags(spark):
    sets = sets_of(spark, [("1", "upsert", "a"), ("2", "upsert", "a")], None, ["Z", "A"], [("1", "Z", 0), ("1", "A", 1), ("1", "w", 2), ("1", "f", 3)])
    more = spark.createDataFrame([("w", "ArchiveWarning", "Creator Chose Not To Use Archive Warnings", None, None), ("f", "Freeform", "Creator Chose Not To Use Archive Warnings", None, None)], P.record_schema("tags"))
    sets["tags"] = sets["tags"].unionByName(more)
    store, _ = transfer.apply_import(transfer.empty_store(spark), sets, spark.createDataFrame([], RUNS), "p1", None, F.lit(AT))
    got = {(r["sourceWorkId"], r["type"]): r["names"] for r in store["tagNames"].collect()}
    plain = ["Choose Not To Use Archive Warnings"]
    assert got == {
        ("1", "Fandom"): ["Z", "A"], ("1", "ArchiveWarning"): plain, ("1", "Freeform"): ["Creator Chose Not To Use Archive Warnings"], ("1", "Rating"): ["Not Rated"],
        ("2", "Fandom"): ["No Fandom"], ("2", "ArchiveWarning"): plain, ("2", "Rating"): ["Not Rated"],
    }


def test_publish_is_whole(spark, tmp_path):
    folder = f"file://{tmp_path}/store"
    one = {"a": spark.range(3), "b": spark.range(1)}
    transfer.publish(spark, folder, one)
    assert {k: v.count() for k, v in transfer.load_store(spark, folder).items()} == {"a": 3, "b": 1}
    (tmp_path / "store" / "half" / "a").mkdir(parents=True)  # a writer that was lost
    transfer.publish(spark, folder, {"a": spark.range(5), "b": spark.range(2)})
    assert {k: v.count() for k, v in transfer.load_store(spark, folder).items()} == {"a": 5, "b": 2}


def test_export(spark, tmp_path):
    sets = sets_of(spark, [("1", "upsert", "a"), ("2", "upsert", "a")], None, ["t", "u"], [("1", "t", 0)])
    store = transfer.merge_capture(transfer.empty_store(spark), sets)
    works = store["works"].select(F.col("sourceWorkId").cast("long").alias("id"), F.lit(7).cast("long").alias("source_id"), "sourceWorkId", F.col("contentHash").alias("content_hash")).withColumns({
        "last_exported_hash": F.when(F.col("sourceWorkId") == "2", F.col("content_hash")), "last_exported_at": F.lit(None).cast("timestamp_ntz"), "last_export_package_id": F.lit(None).cast("string")})
    runs = spark.createDataFrame([(k, 7, "pkg", "leased", "tok", None, None, None) for k in (1, 2)], "id long, source_id long, package_id string, status string, lease_token string, work_count long, archive_hash string, completed_at timestamp_ntz")
    sources = spark.createDataFrame([(7, "tok", datetime(2025, 3, 4, 6))], "id long, export_lease_token string, export_lease_expires_at timestamp_ntz")
    manifest = {"format": "f", "formatVersion": 1, "packageId": "123e4567-e89b-42d3-a456-426614174000", "packageType": "snapshot", "source": {"key": "s", "origin": "https://a.example"}, "createdAt": "2024-01-01T00:00:00Z", "collectorVersion": "1", "previousPackageId": None}
    folder = f"{tmp_path}/pkg"
    after, done, freed = transfer.export_changes(spark, works, store, runs, sources, 1, "tok", folder, manifest, 100, F.lit(AT))
    run = done.filter("id = 1").first()
    assert freed.first()["export_lease_token"] is None
    with pytest.raises(ValueError, match="not held"):
        transfer.export_changes(spark, works, store, runs, sources, 1, "other", folder, manifest, 100, F.lit(AT))
    data = (tmp_path / "pkg.tar.gz").read_bytes()
    assert (run["status"], run["work_count"], run["archive_hash"]) == ("completed", 1, hashlib.sha256(data).hexdigest())
    names = tarfile.open(fileobj=io.BytesIO(gzip.decompress(data))).getnames()
    assert names == sorted(names) and "pkg/works.jsonl" in names and "pkg/checksums.sha256" in names
    counts = transfer.verify_package(spark, folder)
    assert (counts["works"], counts["tags"], counts["authors"], counts["chapters"]) == (1, 1, 1, 1)
    assert transfer.archive(spark, folder).first()["sha256"] == run["archive_hash"]
    assert transfer.export_changes(spark, after, store, runs, sources, 2, "tok", folder, manifest, 100, F.lit(AT))[1].filter("id = 2").first()["status"] == "empty"


def test_walk_and_social_records(spark):
    def listing(names, after):
        rows = "".join(f"<a href='/users/{n}'>{n}</a>" for n in names)
        return f"<div id=kudos>{rows}</div>" + (f"<ol class=pagination><li class=next><a href='{after}'>more</a></li></ol>" if after else "")

    at = "https://a.example/works/7"
    pages = spark.createDataFrame([(f"{at}/x", listing(["ann"], f"{at}/x?page=2")), (f"{at}/x?page=2", listing(["bo", "ann"], f"{at}/x")), (f"{at}/y", listing(["cy"], f"{at}/x?page=2")), (f"{at}/z", listing(["di"], f"{at}/lost"))], "url string, html string")
    starts = spark.createDataFrame([("7", 1, f"{at}/x"), ("7", 2, f"{at}/y"), ("7", 3, f"{at}/z")], "sourceWorkId string, chain int, url string")
    walked = transfer.walk_pages(starts, pages)
    assert sorted((r["chain"], r["n"], r["url"][len(at):]) for r in walked.collect()) == [(1, 1, "/x"), (1, 2, "/x?page=2"), (2, 1, "/y"), (3, 1, "/z")]
    assert sorted((r["chain"], r["n"]) for r in transfer.walk_pages(starts, pages, 3).collect()) == [(1, 1), (1, 2), (2, 1)]
    read = extract.kudos(walked.withColumns({"origin": F.lit("https://a.example"), "observedAt": F.lit("t")}), "chain", "n")
    got = transfer.social_records(read, ["sourceWorkId", "sourceKudoId"])
    assert sorted(r["sourceKudoId"] for r in got.collect()) == ["user:ann", "user:bo", "user:cy", "user:di"]
    assert transfer.walk_pages(starts.limit(0), pages).count() == 0


def test_walk_of_long_chains_and_circles(spark, monkeypatch):
    def page(after):
        return f"<ol class=pagination><li class=next><a href='{after}'>more</a></li></ol>" if after else "<p>end"

    at = "https://a.example/w"
    rows = [(f"{at}/l{k}", page(f"{at}/l{k + 1}" if k < 36 else None)) for k in range(37)]
    rows += [(f"{at}/c{k}", page(f"{at}/c{k + 1 if k < 6 else 2}")) for k in range(7)]  # a circle that does not begin at the start
    rows += [(f"{at}/s", page(f"{at}/s"))]
    pages = spark.createDataFrame(rows, "url string, html string")
    starts = spark.createDataFrame([("1", 1, f"{at}/l0"), ("2", 1, f"{at}/c0"), ("3", 1, f"{at}/s"), ("4", 1, f"{at}/none"), ("5", 1, f"{at}/l30"), ("5", 2, f"{at}/l28")], "sourceWorkId string, chain int, url string")
    got = {}
    for r in transfer.walk_pages(starts, pages).collect():
        got.setdefault((r["sourceWorkId"], r["chain"]), []).append((r["n"], r["url"][len(at) + 1 :]))
    want = {("1", 1): [(k + 1, f"l{k}") for k in range(37)], ("2", 1): [(k + 1, f"c{k}") for k in range(7)], ("3", 1): [(1, "s")], ("5", 1): [(k + 1, f"l{30 + k}") for k in range(7)], ("5", 2): [(1, "l28"), (2, "l29")]}
    assert {k: sorted(v) for k, v in got.items()} == want
    assert sorted((r["sourceWorkId"], r["n"]) for r in transfer.walk_pages(starts, pages, 3).filter("sourceWorkId < '3'").collect()) == [(w, n) for w in "12" for n in (1, 2, 3)]


def test_blobs(spark, tmp_path):
    pages = spark.createDataFrame([("<p>a",), ("<p>a",), ("é",), (None,)], "html string")
    got = transfer.put_blobs(pages, str(tmp_path)).collect()
    assert len(got) == 2
    for r in got:
        data = (tmp_path / r["storage_key"]).read_bytes()
        assert len(data) == r["compressed_bytes"] and "sha256:" + hashlib.sha256(gzip.decompress(data)).hexdigest() == r["body_hash"]
    before = {r["storage_key"]: (tmp_path / r["storage_key"]).stat().st_mtime_ns for r in got}
    transfer.put_blobs(pages, str(tmp_path)).collect()
    assert before == {k: (tmp_path / k).stat().st_mtime_ns for k in before}


JOBS = "id long, source_id long, type string, status string, planning_status string, configuration string, discovered_count long, succeeded_count long, failed_count long, skipped_count long, created_at timestamp_ntz, updated_at timestamp_ntz"
TASKS = "id long, job_id long, source_work_id string, status string, attempts int, available_at timestamp_ntz, updated_at timestamp_ntz"
SUBS = "id long, source_id long, tag_name string, tag_slug string, tag_type string, next_page int, enabled boolean, last_job_id long, last_run_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"


def test_jobs_and_sources(spark):
    jobs, tasks = spark.createDataFrame([], JOBS), spark.createDataFrame([], TASKS)
    jobs = control.create_range_job(jobs, 1, 7, 1, 100, 10, F.lit(AT))
    ids = spark.createDataFrame([("5",), ("6",), ("5",)], "source_work_id string")
    jobs, tasks = control.create_ids_job(jobs, tasks, 2, 7, ids, 50, F.lit(AT))
    assert {r["id"]: (r["type"], r["planning_status"], r["discovered_count"]) for r in jobs.collect()} == {1: ("id_range", "queued", 0), 2: ("explicit_ids", "completed", 2)}
    assert sorted((r["id"], r["source_work_id"], r["status"]) for r in tasks.collect()) == [(50, "5", "queued"), (51, "6", "queued")]
    with pytest.raises(ValueError):
        control.create_range_job(jobs, 3, 7, 10, 1, 10, F.lit(AT))
    sources = spark.createDataFrame([], "id long, source_key string, paused boolean, daily_request_budget long, updated_at timestamp_ntz")
    sources = control.create_source(sources, 1, F.lit(AT), source_key="k", daily_request_budget=0)
    assert sources.first()["paused"] and sources.first()["daily_request_budget"] is None
    assert control.update_source(sources, 1, F.lit(AT), daily_request_budget=9).first()["daily_request_budget"] == 9


def test_subscriptions(spark):
    subs, jobs, tasks = (spark.createDataFrame([], s) for s in (SUBS, JOBS, TASKS))
    subs = control.subscribe(subs, 1, 7, "A", "a", "Fandom", F.lit(AT))
    subs = control.subscribe(control.record_run(subs, 1, 4, None, F.lit(AT)), 2, 7, "A!", "a", "Freeform", F.lit(AT))
    row = subs.first()
    assert subs.count() == 1 and (row["tag_name"], row["next_page"], row["enabled"]) == ("A!", 4, True)
    assert [r["decision"] for r in control.tag_fill_plan(subs, jobs, tasks, 7).collect()] == ["fetch"]
    listed = spark.createDataFrame([(0, "5"), (1, "6")], "ord int, source_work_id string")
    known = {"works": listed.filter("ord = 0").select("source_work_id"), "not_found": listed.limit(0).select("source_work_id"), "queued": listed.limit(0).select("source_work_id")}
    subs2, jobs2, tasks2 = control.tag_fill(subs, jobs, tasks, 1, listed, known, 9, 100, F.lit(AT))
    assert (subs2.first()["next_page"], subs2.first()["last_job_id"], [r["source_work_id"] for r in tasks2.collect()]) == (5, 9, ["6"])
    assert [r["decision"] for r in control.tag_fill_plan(subs2, jobs2, tasks2, 7).collect()] == ["busy"]
    assert control.tag_fill(subs, jobs, tasks, 1, listed.limit(0), known, 9, 100, F.lit(AT))[0].first()["next_page"] == 4
    assert control.tag_fill_plan(control.set_enabled(subs, 1, False, F.lit(AT)), jobs, tasks, 7).count() == 0 and control.unsubscribe(subs, 1).count() == 0
    tags = spark.createDataFrame([("a",), ("b",)], "slug string")
    assert {r["slug"]: r["subscribed"] for r in control.with_subscribed(tags, subs).collect()} == {"a": True, "b": False}


def test_planning_and_reparse(spark, tmp_path):
    jobs = spark.createDataFrame([(1, 7, "id_range", "running", "planning", '{"start":3,"end":9}', 0, 5, "tok", None), (2, 7, "id_range", "running", "planning", '{"start":9,"end":3}', 0, None, "bad", None)],
        "id long, source_id long, type string, status string, planning_status string, configuration string, discovered_count long, planning_cursor long, planning_lease_token string, planning_lease_expires_at timestamp_ntz")
    tasks = spark.createDataFrame([(1, 1, "3", "queued", 0, None, None), (2, 1, "6", "succeeded", 0, None, None)], TASKS)
    j, t = control.plan_range(jobs, tasks, 1, "tok", 10, F.lit(AT))
    assert sorted(r["source_work_id"] for r in t.filter("id >= 10").collect()) == ["5", "7", "8", "9"]
    row = j.filter("id = 1").first()
    assert (row["planning_status"], row["planning_cursor"], row["discovered_count"], row["planning_lease_token"]) == ("completed", 10, 6, None)
    assert control.plan_range(jobs, tasks, 2, "bad", 10, F.lit(AT))[0].filter("id = 2").first()["planning_status"] == "failed"
    assert control.plan_range(jobs, tasks, 1, "other", 10, F.lit(AT))[1].count() == 2
    (tmp_path / "11.html").write_text("<div id=workskin><h2 class='title heading'>T</h2><div id=chapters><div class=userstuff>x</div></div></div>")
    (tmp_path / "12.html").write_text("<p>gone")
    got = {r["work_id"]: r["error"] for r in control.reparse(spark, str(tmp_path), "https://a.example", F.lit(AT)).collect()}
    assert got == {"11": None, "12": "title missing: work 12"}


def test_settings_reports_errors(spark, tmp_path):
    def settings(text):
        at = tmp_path / f"s{abs(hash(text))}.json"
        at.write_text(text)
        return tuple(control.read_settings(spark, str(at)).first())

    assert settings('{"backupRetentionDays": 7, "defaultBatchSize": "x", "timezone": ""}') == (7, 250, "UTC")
    assert settings('{"defaultBatchSize": 9, "timezone": "Asia/Tokyo"}') == (None, 9, "Asia/Tokyo")
    assert settings("no json") == (None, 250, "UTC") == tuple(control.read_settings(spark, str(tmp_path / "none.json")).first())
    days = spark.createDataFrame([(datetime(2025, 3, 1),), (datetime(2025, 1, 1),)], "created_at timestamp_ntz")
    assert control.expired_backups(days, F.lit(AT), 10).count() == 1 and control.expired_backups(days, F.lit(AT), None).count() == 0
    jobs, tasks = spark.createDataFrame([], JOBS), spark.createDataFrame([(k, 1, "x", "terminal_failed", 0, None, datetime(2025, 1, k + 1)) for k in range(5)], TASKS)
    got = control.diagnostics(spark.range(2), jobs, tasks, spark.range(250)).first()
    assert [r["id"] for r in got["failures"]] == [4, 3, 2, 1, 0] and len(got["logs"]) == 200 and got["logs"][0]["id"] == 249 and got["jobs"] == []
    report = control.capture_report(spark.createDataFrame([(None,), ("bad",), (None,)], "error string")).first()
    assert tuple(report) == (3, 2, 1)

    class Lock(Exception):
        code = "1213"

    try:
        try:
            raise Lock("wait")
        except Lock as e:
            raise ValueError("outer") from e
    except ValueError as e:
        assert control.is_transient(e) and control.describe_error(e) == "ValueError: outer (1213)"
    assert not control.is_transient(ValueError("x")) and control.describe_error("plain") == "plain"


def test_deep_pages_and_repeated_comments(spark):
    deep = "<div id=workskin><h2 class='title heading'>T</h2><div id=chapters><div class=userstuff>" + "<b>" * 5000 + "x" + "</b>" * 5000 + "</div></div></div>"
    pages = spark.createDataFrame([("https://a.example/works/9", deep, datetime(2024, 5, 1))], "url string, html string, captured_at timestamp")
    sets = extract.record_sets(extract.parse_works(pages))
    assert sets["chapters"].first()["contentHtml"].count("<b>") == 5000
    one = "<li class='comment group' id='comment_1'><h4 class='heading byline'>a</h4><blockquote class=userstuff><p>x</p></blockquote></li>"
    df = spark.createDataFrame([("12", "https://a.example", None, f"<ol>{one}<li id='comment_2' class='comment group'><h4 class=byline>b</h4><blockquote class=userstuff>y</blockquote></li>{one}</ol>")], "sourceWorkId string, origin string, creatorProfileUrls array<string>, html string")
    assert sorted(r["sourceCommentId"] for r in extract.comments(df).collect()) == ["1", "1", "2"]
