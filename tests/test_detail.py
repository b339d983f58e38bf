"""Works in detail, the fetch log, captures of many works, the sample package, settings and diagnostics."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillspark.operators import control, detail, transfer
from quillspark.sources import packages as P

AT = datetime(2025, 3, 4, 5, 6, 7)
MANIFEST = {"format": "f", "formatVersion": 1, "packageId": "123e4567-e89b-42d3-a456-426614174000", "packageType": "snapshot", "source": {"key": "s", "origin": "https://a.example"}, "createdAt": "2024-01-01T00:00:00Z", "collectorVersion": "1", "previousPackageId": None}


def page(title, authors, tags, chapters, series=""):
    """A work's page written by hand, in the shapes that archives write them."""
    by = ", ".join(f'<a rel="author" href="/users/{a}/pseuds/{a}">{a}</a>' for a in authors) or "Anonymous"
    listed = "".join(f'<dd class="{kind} tags"><ul class="commas">' + "".join(f'<li><a class="tag" href="/tags/{t}/works">{t}</a></li>' for t in own) + "</ul></dd>" for kind, own in tags.items())
    body = "".join(f'<div class="chapter" id="chapter-{k}"><h3 class="title"><a href="/works/1/chapters/{90 + k}">Chapter {k}</a></h3><div class="userstuff module" role="article"><p>{c}</p></div></div>' for k, c in enumerate(chapters, 1))
    return f"<html><body><dl class='work meta group'>{listed}{series}</dl><div id=workskin><div class='preface group'><h2 class='title heading'> {title}\n</h2><h3 class='byline heading'>{by}</h3></div><div id='chapters'>{body}</div></div></body></html>"


def test_capture_to_package(spark, tmp_path):
    rows = [
        ("https://a.example/works/7", page("One", ["ann"], {"fandom": ["F"], "freeform": ["x", "y"]}, ["a", "b"]), AT), ("https://a.example/works/8", "<p>gone", AT),
        ("https://a.example/works/9", page("Two", ["bo", "ann"], {"fandom": ["F"]}, ["c"]), AT), ("https://a.example/works/9?again", page("Later", [], {}, ["d"]), datetime(2025, 4, 1)),
    ]
    pages = spark.createDataFrame(rows, "url string, html string, captured_at timestamp")
    asked = spark.createDataFrame([(k,) for k in ("7", "8", "9", "10")], "sourceWorkId string")
    folder = f"{tmp_path}/package"
    report = {r["sourceWorkId"]: r for r in transfer.capture_to_package(spark, pages, folder, MANIFEST, asked).collect()}
    assert {k: (r["status"], r["chapters"], r["tags"]) for k, r in report.items()} == {"7": ("parsed", 2, 3), "8": ("failed", None, None), "9": ("parsed", 1, 1), "10": ("failed", None, None)}
    assert report["7"]["bytes"] == len(rows[0][1].encode()) and "title" in report["8"]["error"] and report["10"]["error"] == "was not fetched"
    counts = transfer.verify_package(spark, folder)
    assert (counts["works"], counts["chapters"], counts["authors"], counts["workAuthors"], counts["tags"], counts["observations"]) == (2, 3, 2, 3, 3, 2)
    sets = P.read_package(spark, folder)[1]
    assert {r["title"] for r in sets["works"].collect()} == {"One", "Two"}
    none = transfer.capture_to_package(spark, pages.filter("url like '%8'"), f"{tmp_path}/none", MANIFEST)
    assert [r["status"] for r in none.collect()] == ["failed"] and not (tmp_path / "none").exists()


def test_sample_and_details(spark, tmp_path):
    folder = f"{tmp_path}/sample"
    counts = transfer.sample_package(spark, folder, MANIFEST["packageId"], "2024-02-03T04:05:06Z", "f")
    assert (counts["works"], counts["tags"], counts["series"], counts["comments"]) == (1, 3, 1, 0)
    sets = P.read_package(spark, folder, "f")[1]
    comments = [(op, "1001", i, None, "a", None, "t", depth, False, f"<p>{i}", "sha256:0") for op, i, depth in (("upsert", "c2", 1), ("upsert", "c1", 0), ("hide", "c3", 0))]
    store = sets | {"comments": spark.createDataFrame(comments, P.record_schema("comments")), "kudos": spark.createDataFrame([("1001", f"k{k}", "a", None, "t") for k in range(4)], P.record_schema("kudos"))}
    store["works"] = store["works"].unionByName(store["works"].withColumn("sourceWorkId", F.lit("2")))
    got = {r["sourceWorkId"]: r for r in detail.work_details(store).collect()}
    work = got["1001"]
    assert [t["type"] for t in work["tags"]] == ["Rating", "Fandom", "Freeform"] and [c["sourceCommentId"] for c in work["comments"]] == ["c1", "c2"]
    assert (work["kudosCount"], work["bookmarksCount"], work["series"][0]["name"], work["authors"][0]["name"], work["chapters"][0]["wordCount"]) == (4, 0, "Samples", "Sample", 7)
    assert (got["2"]["chapters"], got["2"]["kudosCount"]) == ([], 0)
    assert [r["sourceWorkId"] for r in detail.work_details(store, spark.createDataFrame([("2",)], "sourceWorkId string")).collect()] == ["2"]
    assert detail.chapter(store, "1001", "2001").first()["contentHtml"].startswith("<p>") and detail.chapter(store, "2", "2001").count() == 0


def test_fetch_log(spark):
    rows = [(k, str(k), "u", 200, datetime(2025, 1, 1 + k // 2), "1", h, 1) for k, h in enumerate(['{"content-length":"12"}', "{}", None, '{"content-length":"7 bytes"}', '{"content-length":"x"}'])]
    df = spark.createDataFrame(rows, "id long, source_work_id string, url string, http_status int, fetched_at timestamp, parser_version string, response_headers string, attempts int")
    got = detail.fetch_log(df, 2, 1).collect()
    assert [(r["id"], r["response_bytes"], r["total"]) for r in got] == [(3, 7, 5), (2, None, 5)]
    assert [r["response_bytes"] for r in detail.fetch_log(df, 5).collect()] == [None, 7, None, None, 12]
    with pytest.raises(ValueError):
        detail.fetch_log(df, 101)


def test_settings_and_diagnostics(spark, tmp_path):
    path = f"file://{tmp_path}/settings.json"
    settings = control.read_settings(spark, path)
    changed = control.update_settings(settings, backup_retention_days=9, timezone="Asia/Tokyo")
    control.write_settings(changed, path)
    assert tuple(control.read_settings(spark, path).first()) == (9, 250, "Asia/Tokyo")
    control.write_settings(control.update_settings(changed, backup_retention_days=None, default_batch_size=10), path)
    assert tuple(control.read_settings(spark, path).first()) == (None, 10, "Asia/Tokyo") and "backupRetentionDays" not in json.loads((tmp_path / "settings.json").read_text())
    for bad in ({"backup_retention_days": 0}, {"default_batch_size": 1001}, {"timezone": ""}, {"colour": 1}):
        with pytest.raises(ValueError):
            control.update_settings(settings, **bad)
    jobs = spark.createDataFrame([], "id long, status string")
    tasks = spark.createDataFrame([], "id long, status string, updated_at timestamp")
    configs = spark.createDataFrame([], "source_id long, enabled boolean, frontier_start long, batch_size long, last_job_id long, last_run_at timestamp_ntz, updated_at timestamp_ntz")
    first = control.diagnostics(spark.range(3, 5), jobs, tasks, spark.range(1), configs).first()["auto_fill"]
    assert (first["source_id"], first["enabled"], first["frontier_start"], first["batch_size"]) == (3, False, 1, 200)
    own = control.update_auto_fill(configs, 3, F.lit(AT), enabled=True, frontier=44)
    assert control.diagnostics(spark.range(3, 5), jobs, tasks, spark.range(1), own).first()["auto_fill"]["frontier_start"] == 44
    assert control.diagnostics(spark.range(0), jobs, tasks, spark.range(1), own).first()["auto_fill"] is None
