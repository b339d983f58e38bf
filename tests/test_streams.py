"""Streams: rate limits with timers, snapshots by epoch, logs, retention, fetched addresses, events as text."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quillspark.sources import packages as P
from quillspark.streaming import leases, usage
from quillspark.streaming.usage import Limiter

DAY = datetime(2025, 1, 2)


def at(minutes):
    return DAY + timedelta(minutes=minutes)


@pytest.fixture
def timers(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", leases.STATE_STORE)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run(stream, path):
    query = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start()
    query.awaitTermination(180)
    assert query.exception() is None
    return stream.sparkSession.read.parquet(f"{path}/out")


def test_limits_by_hand(spark):
    rows = [(1, at(0), 10), (1, at(1), 10), (1, at(2), 10), (1, at(11), 10), (1, at(22), 10), (1, at(24 * 60), 10), (2, at(0), 5), (2, at(1), None), (2, at(700), 5)]
    df = spark.createDataFrame(rows, "source long, ts timestamp_ntz, bytes long")
    got = usage.rate_limit_with_wakes(df, Limiter(600_000, requests=2, size=15), at(3000)).collect()
    assert sorted((r["source"], r["ts"], r["decision"], r["next_request_at"]) for r in got) == [
        (1, at(0), "grant", at(10)), (1, at(1), "delay", at(10)), (1, at(2), "delay", at(10)), (1, at(10), "wake", at(10)), (1, at(11), "grant", at(21)), (1, at(22), "daily_budget", at(21)),
        (1, at(24 * 60), "grant", at(24 * 60 + 10)), (1, at(24 * 60), "wake", at(21)), (2, at(0), "grant", at(10)), (2, at(1), "delay", at(10)), (2, at(10), "wake", at(10)), (2, at(700), "grant", at(710)),
    ]
    shut = usage.rate_limit_with_wakes(spark.createDataFrame([(1, at(60), 1), (2, at(23 * 60), 1)], df.schema), Limiter(1000, hours=(6, 22)), at(5000)).collect()
    assert sorted((r["source"], r["ts"], r["decision"]) for r in shut) == [(1, at(60), "operating_window"), (1, at(360), "wake"), (2, at(23 * 60), "operating_window"), (2, at(30 * 60), "wake")]
    assert [r["decision"] for r in usage.rate_limit_with_wakes(df.limit(1), Limiter(1000, paused=True), at(5000)).collect()] == ["paused"]


@pytest.mark.parametrize("parts", [1, 6])
def test_limiter_stream_equals_batch_and_forgets(spark, tmp_path, timers, parts):
    rng = random.Random(3)
    rows = sorted((rng.randrange(5), at(rng.randrange(5 * 24 * 60)), rng.randrange(100)) for _ in range(400))
    rows = sorted(set(rows), key=lambda r: r[1]) + [(99, at(60 * 24 * 60), 1)]
    schema, size = "source long, ts timestamp_ntz, bytes long", -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * size : (k + 1) * size], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    limiter = Limiter(3_600_000, requests=6, size=400, hours=(4, 2))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = run(usage.rate_limit_stream(stream, limiter), tmp_path)
    df = spark.createDataFrame(rows, schema)
    want = usage.rate_limit_with_wakes(df, limiter, at(50 * 24 * 60))
    assert want.filter("decision = 'wake'").count() > 20
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    plain = usage.rate_limit(df, limiter).select("source", "ts", "decision")  # which never forgets a next request that has passed
    assert sorted(map(repr, want.filter("decision <> 'wake'").select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    left = spark.read.format("statestore").option("stateVarName", "lease").load(f"{tmp_path}/c")
    assert [r["key"][0] for r in left.select("key").collect()] == [99]  # its day is not over yet


def test_feed(spark, tmp_path):
    jobs = spark.range(150).select("id", F.lit("queued").alias("status"))
    runs = spark.range(3).select("id", F.lit("completed").alias("status"))
    state = {"now": datetime(2025, 1, 1), "jobs": jobs, "runs": runs}

    def build():
        if state["jobs"] is None:
            raise OSError("no database")
        return usage.snapshot(state["jobs"], state["runs"])

    def step(epoch, seconds, **more):
        state.update(more)
        state["now"] = datetime(2025, 1, 1) + timedelta(seconds=seconds)
        return usage.Feed(spark, f"file://{tmp_path}/feed", build, lambda: state["now"]).step(epoch)

    first = step(0, 0)
    sent = {r["event"]: json.loads(r["data"]) for r in P.parse_sse(spark.createDataFrame([("".join(first),)], "value string")).collect()}
    assert [j["id"] for j in sent["jobs"]["jobs"]] == list(range(149, 49, -1)) and (sent["exports"]["total"], len(sent["exports"]["exports"])) == (3, 3)
    assert sent["jobs"]["observedAt"] == "2025-01-01T00:00:00"
    assert step(1, 2) == [] and step(2, 14) == []
    assert step(3, 15) == [": heartbeat\n\n"] and step(4, 20) == []
    changed = step(5, 22, runs=spark.range(4).select("id", F.lit("completed").alias("status")))
    assert len(changed) == 1 and changed[0].startswith("event: exports\n")
    assert step(5, 23) == [changed[0].replace("00:00:22", "00:00:23")]  # the epoch runs again
    assert step(6, 24) == []
    assert [b.split("\n")[0] for b in step(7, 26, jobs=None)] == ["event: system"] and step(8, 28) == []
    assert step(9, 30, jobs=jobs) == [] and [b.split("\n")[0] for b in step(10, 32, jobs=None)] == ["event: system"]
    files = sorted(p.name for p in (tmp_path / "feed" / "events").iterdir() if p.suffix == ".txt")
    assert files == [f"{k:012d}.txt" for k in (0, 3, 5, 7, 10)]
    assert len([p for p in (tmp_path / "feed" / "state").iterdir() if p.suffix == ".json" and not p.name.startswith(".")]) == 3


def test_feed_over_a_stream_that_starts_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    ticks = spark.readStream.schema("n long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    jobs, calls = spark.range(2).select("id", F.lit("x").alias("status")), []
    feed = usage.Feed(spark, f"file://{tmp_path}/feed", lambda: calls.append(1) or usage.snapshot(jobs, jobs), lambda: datetime(2025, 1, 1))
    for k in (1, 2):
        for n in range(2):
            spark.createDataFrame([(n,)], "n long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        query = usage.snapshots(ticks, feed, f"{tmp_path}/c", None)
        query.awaitTermination(120)
        assert query.exception() is None
    assert len(calls) == 4 and [p.name for p in (tmp_path / "feed" / "events").iterdir() if p.suffix == ".txt"] == [f"{0:012d}.txt"]


def test_logs_fetches_and_blocks(spark, tmp_path):
    events = spark.createDataFrame([(1, at(0)), (2, at(5)), (3, at(3000))], "id long, created_at timestamp")
    events.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    for _ in range(2):
        usage.append_events(stream, f"{tmp_path}/log", f"{tmp_path}/c").awaitTermination(120)
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.count() == 3 and {str(r["day"]) for r in log.select("day").distinct().collect()} == {"2025-01-02", "2025-01-04"}
    assert sorted(r["id"] for r in usage.retained(log, F.lit(at(3000)), 2).collect()) == [3] and usage.retained(log, F.lit(at(3000)), 14).count() == 3
    fetches = spark.createDataFrame([("a", at(0)), ("a", at(1)), ("b", at(2)), ("a", at(2))], "url string, ts timestamp")
    fetches.coalesce(1).write.parquet(f"{tmp_path}/f")
    once = usage.distinct_fetches(spark.readStream.schema(fetches.schema).parquet(f"{tmp_path}/f"), "ts", "url")
    assert sorted(r["url"] for r in run(once, tmp_path / "d").collect()) == ["a", "b"]
    block = spark.createDataFrame([("jobs", '{"a":1}')], "e string, p string").select(P.sse_blocks(F.col("e"), F.col("p")).alias("value"))
    assert block.first()[0] == 'event: jobs\ndata: {"a":1}\n\n'
    text = spark.createDataFrame([('event: jobs\ndata: {"a":1}\n\nevent: x\ndata: no json\n\n: heartbeat\n\nevent: y\n\n',)], "value string")
    assert [tuple(r) for r in P.parse_sse(text).collect()] == [("jobs", '{"a":1}')]
    lines = spark.createDataFrame([("f", 1, "a"), ("f", 2, "b"), ("g", 1, "c")], "file string, line long, value string")
    assert sorted((r["file"], r["value"]) for r in P.latest_line(lines).collect()) == [("f", "b"), ("g", "c")]
    (tmp_path / "ids.txt").write_text(" 1 \r\n\n2\n  \n3")
    assert [r["id"] for r in P.id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["1", "2", "3"]
