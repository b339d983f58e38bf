"""Streams: daily usage, a keyed rate limiter, event logs, snapshots of job lists."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import Files
from . import leases

GRANT_SCHEMA = "source long, ts timestamp_ntz, decision string, next_request_at timestamp_ntz"


def daily_usage(events: DataFrame, source: str = "source", ts: str = "ts", size: str = "bytes") -> DataFrame:
    """(source, usage_date, request_count, response_bytes): requests and bytes of each UTC day, batch or stream."""
    return events.groupBy(F.col(source).alias("source"), F.to_date(ts).alias("usage_date")).agg(F.count("*").alias("request_count"), F.sum(size).alias("response_bytes"))


def daily_usage_stream(events: DataFrame, source: str = "source", ts: str = "ts", size: str = "bytes", late: str = "1 day") -> DataFrame:
    """As ``daily_usage`` over event-time windows; a day is final ``late`` after its end and its state is dropped."""
    windowed = events.withWatermark(ts, late).groupBy(F.col(source).alias("source"), F.window(ts, "1 day").alias("w"))
    return windowed.agg(F.count("*").alias("request_count"), F.sum(size).alias("response_bytes")).select("source", F.to_date("w.start").alias("usage_date"), "request_count", "response_bytes")


class Limiter:
    """The rules of one source, applied to requests in order of time: paused, operating window, daily requests, daily
    bytes, delay; a grant counts the request and moves the next one by the delay."""

    def __init__(self, delay_ms: int, requests: int | None = None, size: int | None = None, hours: tuple[int, int] | None = None, paused: bool = False):
        self.delay, self.requests, self.size, self.hours, self.paused = timedelta(milliseconds=delay_ms), requests, size, hours, paused

    def decide(self, state: tuple | None, ts: datetime, size: int) -> tuple[str, tuple]:
        day, used, total, next_at = state or (ts.date(), 0, 0, None)
        if day != ts.date():
            day, used, total = ts.date(), 0, 0
        if self.paused:
            return "paused", (day, used, total, next_at)
        if self.hours and self.hours[0] != self.hours[1]:
            a, b = self.hours
            if not (a <= ts.hour < b if a < b else ts.hour >= a or ts.hour < b):
                return "operating_window", (day, used, total, next_at)
        if self.requests is not None and used >= self.requests:
            return "daily_budget", (day, used, total, next_at)
        if self.size is not None and total >= self.size:
            return "daily_byte_budget", (day, used, total, next_at)
        if next_at is not None and ts < next_at:
            return "delay", (day, used, total, next_at)
        return "grant", (day, used + 1, total + size, ts + self.delay)

    def retry_at(self, decision: str, ts: datetime, next_at: datetime | None) -> datetime | None:
        """When a request that was put off may be made again; None if nobody knows."""
        midnight = datetime(ts.year, ts.month, ts.day)
        if decision == "delay":
            return next_at
        if decision in ("daily_budget", "daily_byte_budget"):
            return midnight + timedelta(days=1)
        if decision == "operating_window":
            opens = midnight + timedelta(hours=self.hours[0])
            return opens if opens > ts else opens + timedelta(days=1)
        return None


def rate_limit(requests: DataFrame, limiter: Limiter) -> DataFrame:
    """Decisions on the requests (source, ts, bytes) of a batch. A source's requests depend on each other in order of time, so they
    are read in sorted runs: rows are dealt by source and sorted, and a task keeps one source's state at a time."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, state = None, None
        for f in frames:
            rows = []
            for s, ts, size in zip(f["source"], f["ts"], f["bytes"]):
                if s != source:
                    source, state = s, None
                decision, state = limiter.decide(state, ts.to_pydatetime(), int(size or 0))
                rows.append((s, ts, decision, state[3]))
            out = pd.DataFrame(rows, columns=["source", "ts", "decision", "next_request_at"])
            out["next_request_at"] = pd.to_datetime(out["next_request_at"])
            yield out

    return requests.select("source", "ts", "bytes").repartition("source").sortWithinPartitions("source", "ts", "bytes").mapInPandas(work, GRANT_SCHEMA)


class Requests:
    """The limiter as a machine of ``leases``: events ``request`` with ``bytes``; ``matched`` says whether one was granted. A request that was put off, and could be made at a known time, wakes its source then:
    a row ``wake``, one for the earliest time. A source is forgotten once its day is over and its delay has passed, and would decide alike from then on."""

    columns = "decision string, next_request_at long"

    def __init__(self, limiter: Limiter):
        self.limiter = limiter

    def row(self, s: dict | None) -> tuple:
        return (s["decision"], s["next"]) if s else (None, None)

    def ends(self, s: dict | None) -> int | None:
        if s is None:
            return None
        return max(_micros(_day(s["day"]) + timedelta(days=1)), s["next"] or 0) if s["wake"] is None else s["wake"]

    def lapse(self, s: dict) -> tuple[dict | None, str | None]:
        return (None, None) if s["wake"] is None else (s | {"wake": None, "decision": "wake"}, "wake")

    def step(self, s: dict | None, at: int, action: str, args: dict) -> tuple[dict | None, bool]:
        if action != "request":
            return s, False
        ts = _EPOCH + timedelta(microseconds=at)
        had = None if s is None else (_day(s["day"]).date(), s["used"], s["total"], None if s["next"] is None else _EPOCH + timedelta(microseconds=s["next"]))
        decision, (day, used, total, next_at) = self.limiter.decide(had, ts, int(args.get("bytes") or 0))
        again = None if decision == "grant" else self.limiter.retry_at(decision, ts, next_at)
        wakes = [w for w in (s and s["wake"], again and _micros(again)) if w]
        return {"day": day.isoformat(), "used": used, "total": total, "next": next_at and _micros(next_at), "decision": decision, "wake": min(wakes) if wakes else None}, decision == "grant"

    def done(self, s: dict | None) -> bool:
        return s is None


_EPOCH = datetime(1970, 1, 1)


def _micros(ts: datetime) -> int:
    return (ts - _EPOCH) // timedelta(microseconds=1)


def _day(text: str) -> datetime:
    return datetime.fromisoformat(text)


def _requests(requests: DataFrame) -> DataFrame:
    """Requests (source, ts, bytes) as a log; of requests of one source and instant the smaller one goes first."""
    size = F.coalesce(F.col("bytes").cast("long"), F.lit(0))
    return requests.select(F.col("source").cast("long").alias("key"), F.col("ts").cast("timestamp").alias("at"), size.alias("seq"), F.lit("request").alias("action"), F.create_map(F.lit("bytes"), size.cast("string")).alias("args"))


def _decisions(played: DataFrame) -> DataFrame:
    return played.select(F.col("key").alias("source"), F.col("at").cast("timestamp_ntz").alias("ts"), "decision", F.col("next_request_at").cast("timestamp_ntz").alias("next_request_at"))


def rate_limit_with_wakes(requests: DataFrame, limiter: Limiter, until: datetime | None = None) -> DataFrame:
    """As ``rate_limit``, with a row ``wake`` where a source that was put off may ask again, up to ``until`` after its last request."""
    return _decisions(leases.replay(_requests(requests), Requests(limiter), None if until is None else _micros(until)))


def rate_limit_stream(requests: DataFrame, limiter: Limiter, late: str = "0 seconds") -> DataFrame:
    """As ``rate_limit_with_wakes`` over a stream. Timers wake sources and forget them when their day is over, so the state is empty after it. Requests must come in order of time but for
    ``late``; the session's state store must be ``leases.STATE_STORE``."""
    return _decisions(leases.replay_stream(_requests(requests), Requests(limiter), late))


def distinct_fetches(fetches: DataFrame, ts: str, *keys: str, late: str = "1 day") -> DataFrame:
    """Each fetched address once within the watermark."""
    return fetches.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def append_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of events to a Parquet log, one folder a day, exactly once."""
    dated = events.withColumn("day", F.to_date("created_at"))
    return dated.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("day").trigger(availableNow=True).start()


def retained(events: DataFrame, now, days: int = 14) -> DataFrame:
    """Events that are not older than the retention."""
    return events.filter(F.col("created_at") >= now - F.expr(f"INTERVAL {days} DAYS"))


#: Rows of a snapshot's lists, and seconds without news after which a feed says that it lives.
SNAPSHOT_ROWS = 100
HEARTBEAT_SECONDS = 15


def snapshot(jobs: DataFrame, exports: DataFrame, limit: int = SNAPSHOT_ROWS) -> DataFrame:
    """(event, payload): the latest jobs, and the latest export runs with the number of all, as JSON; newest first."""

    def latest(df: DataFrame) -> DataFrame:
        rows = df.orderBy(F.desc("id")).limit(limit).agg(F.sort_array(F.collect_list(F.struct(F.col("id").alias("o"), F.struct(*df.columns).alias("row"))), asc=False).alias("x"))
        return rows.select(F.transform("x", lambda r: r["row"]).alias("rows"))

    own = latest(jobs).select(F.lit("jobs").alias("event"), F.to_json(F.struct(F.col("rows").alias("jobs"))).alias("payload"))
    total = exports.agg(F.count("*").alias("total"))
    others = latest(exports).crossJoin(F.broadcast(total))  # single rows
    return own.unionByName(others.select(F.lit("exports").alias("event"), F.to_json(F.struct(F.col("rows").alias("exports"), "total")).alias("payload")))


class Feed:
    """Events for listeners, one file of blocks an epoch in a folder: ``events/<epoch>.txt``. A snapshot that says what the last one of its kind said is not sent; after HEARTBEAT_SECONDS
    without news a comment line is. If the snapshot can't be built, that is sent, once. What was sent last is kept beside them by epoch, and an epoch that runs again starts from
    the one before it and replaces its own file, so each event is there once."""

    def __init__(self, spark: SparkSession, folder: str, build: Callable[[], DataFrame], clock: Callable[[], datetime], heartbeat: int = HEARTBEAT_SECONDS):
        self.spark, self.folder, self.build, self.clock, self.heartbeat = spark, folder, build, clock, heartbeat

    def step(self, epoch: int) -> list[str]:
        """Send what there is to say. Returns the blocks."""
        disk = Files(self.spark, self.folder)
        known = sorted(int(n.removesuffix(".json")) for n in disk.names("state") if n.endswith(".json") and not n.startswith("."))
        before = [n for n in known if n < epoch]
        last = json.loads(disk.read(f"state/{before[-1]:012d}.json")) if before else {"sent": {}, "at": None}
        now = self.clock()
        try:
            found = {r["event"]: r["payload"] for r in self.build().collect()}  # two rows of bounded lists
        except Exception:
            found = {"system": json.dumps({"status": "database_unavailable"})}
        digests = {event: hashlib.sha256(payload.encode()).hexdigest() for event, payload in found.items()}
        news = [event for event in found if last["sent"].get(event) != digests[event]]
        blocks = [f"event: {event}\ndata: {json.dumps(json.loads(found[event]) | {'observedAt': now.isoformat()})}\n\n" for event in news]
        if not blocks and last["at"] is not None and (now - datetime.fromisoformat(last["at"])).total_seconds() >= self.heartbeat:
            blocks = [": heartbeat\n\n"]
        sent = {"system": digests["system"]} | last["sent"] if "system" in found else {k: v for k, v in (last["sent"] | digests).items() if k != "system"}
        for name, text in ((f"events/{epoch:012d}.txt", "".join(blocks)), (f"state/{epoch:012d}.json", json.dumps({"sent": sent, "at": now.isoformat() if blocks else last["at"]}))):
            disk.delete(name)
            if text:
                disk.create(name, text)
        for n in before[:-2]:
            disk.delete(f"state/{n:012d}.json")
        return blocks


def snapshots(trigger: DataFrame, feed: Feed, checkpoint: str, every: str | None = "2 seconds") -> StreamingQuery:
    """Run a feed at each tick of a stream (``every`` None: for what is there, then end)."""
    ticks = trigger.writeStream.foreachBatch(lambda _, epoch: feed.step(epoch) and None).option("checkpointLocation", checkpoint)
    return (ticks.trigger(availableNow=True) if every is None else ticks.trigger(processingTime=every)).start()
