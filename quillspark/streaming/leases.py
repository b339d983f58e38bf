"""State machines over ordered logs, above all leases: each event is replayed under its guard.

A machine's ``step`` takes a key's state and one event and says whether the event's guard held. Its ``ends`` says when something in a state ends by itself, and ``lapse`` what it is then: a
lease that has run out by the time of an event is given up before it, as by a sweeper that never sleeps. The same machine replays a batch and a stream: a batch is dealt out by key and sorted, and a
task holds one key's state at a time, however long its log is; a stream keeps each open key's state in the state store, and an event-time timer ends what nothing else has ended. A key that is done
leaves no state.

Events are (key long, at timestamp, seq long, action string, args map<string,string>); at and seq order a key's log, and a stream must bring a key's events in that
order. Times in ``args`` are microseconds since 1970. Rows that come out have the event (for what ended by itself: seq null, the machine's word as action, at its end), ``matched`` and
the machine's columns. Events with a null key are left out; of equal (at, seq) the action by name goes first. An unknown action matches nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SECOND = 1_000_000
_EVENT = "key long, at long, seq long, action string, matched boolean"


class Tasks:
    """A task (key): created as queued, claimed by a token for ``lease`` seconds, prolonged, completed with an outcome, deferred, retried after it
    failed for good. A task that succeeded, was not found or was cancelled is over."""

    columns = "status string, attempts long, lease_token string, lease_expires_at long, available_at long, last_error_code string"
    over = ("succeeded", "not_found", "cancelled")

    def __init__(self, lease: int = 120, expired: str = "worker_lease_expired"):
        self.lease, self.expired = lease * SECOND, expired

    def row(self, s: dict | None) -> tuple:
        return (s["status"], s["attempts"], s["token"], s["expires"], s["due"], s["code"]) if s else (None,) * 6

    def ends(self, s: dict | None) -> int | None:
        """When the lease that the state holds runs out."""
        return s["expires"] if s and s["status"] == "leased" else None

    def lapse(self, s: dict) -> tuple[dict, str]:
        return s | {"status": "retryable_failed", "due": s["expires"], "token": None, "expires": None, "code": self.expired}, "reclaim"

    def step(self, s: dict | None, at: int, action: str, args: dict) -> tuple[dict | None, bool]:
        token = args.get("token")
        if s is None:
            new = {"status": "queued", "attempts": 0, "token": None, "expires": None, "due": int(args.get("due") or at), "code": None}
            return (new, True) if action == "create" else (None, False)
        free = {"token": None, "expires": None}
        held = s["status"] == "leased" and s["token"] == token
        if action == "claim" and s["status"] in ("queued", "retryable_failed") and s["due"] <= at:
            return s | {"status": "leased", "attempts": s["attempts"] + 1, "token": token, "expires": at + self.lease}, True
        if action == "heartbeat" and held:
            return s | {"expires": at + self.lease}, True
        if action == "complete" and held and args.get("outcome") in ("succeeded", "not_found", "retryable_failed", "terminal_failed"):
            outcome = args["outcome"]
            due = int(args["due"]) if outcome == "retryable_failed" and args.get("due") else at
            return s | free | {"status": outcome, "due": due, "code": None if outcome == "succeeded" else args.get("code")}, True
        if action == "defer" and held:
            return s | free | {"status": "queued", "due": int(args.get("due") or at), "code": args.get("code")}, True
        if action == "retry" and s["status"] == "terminal_failed":
            return s | {"status": "queued", "attempts": 0, "due": at, "code": None}, True
        if action == "cancel" and s["status"] in ("queued", "retryable_failed"):
            return s | {"status": "cancelled"}, True
        return s, False

    def done(self, s: dict | None) -> bool:
        return s is None or s["status"] in self.over


class Exports:
    """The export runs of a source (key): requested, claimed in order of id by one token at a time, prolonged, written, finished or failed. A claim takes the oldest run
    that waits or whose lease ran out, if the source's own lease is free; a run gets its number and its predecessor when it is claimed first and keeps them. Leases that run out
    are not given up but can be taken. A source is never over: its next number stays."""

    columns = "run long, status string, sequence_number long, previous_package string, lease_token string, next_sequence long"

    def __init__(self, lease: int = 300):
        self.lease = lease * SECOND

    def row(self, s: dict | None) -> tuple:
        r = s and s["shown"]
        return (r["id"], r["status"], r["number"], r["before"], r["token"], s["next"]) if r else (None,) * 5 + (s["next"] if s else None,)

    def ends(self, s: dict | None) -> None:
        return None

    def step(self, s: dict | None, at: int, action: str, args: dict) -> tuple[dict, bool]:
        s = s or {"token": None, "expires": None, "next": 1, "last": None, "runs": [], "shown": None}
        s = s | {"shown": None}
        token, run = args.get("token"), int(args["run"]) if args.get("run") else None
        own = next((r for r in s["runs"] if r["id"] == run), None)
        if action == "request" and own is None and run is not None:
            new = {"id": run, "package": args.get("package"), "status": "queued", "number": None, "before": None, "token": None, "expires": None}
            return s | {"runs": sorted([*s["runs"], new], key=lambda r: r["id"]), "shown": new}, True
        if action == "claim" and (s["expires"] is None or s["expires"] <= at):
            waits = [r for r in s["runs"] if r["status"] == "queued" or r["expires"] <= at]
            if not waits:
                return s, False
            fresh = waits[0]["number"] is None
            numbered = {"number": s["next"], "before": s["last"]} if fresh else {}
            taken = waits[0] | numbered | {"status": "leased", "token": token, "expires": at + self.lease}
            return self._put(s | {"token": token, "expires": at + self.lease, "next": s["next"] + fresh}, taken), True
        if own is None or own["token"] is None or own["token"] != token:
            return s, False
        if action == "heartbeat":
            return self._put(s | ({"expires": at + self.lease} if s["token"] == token else {}), own | {"expires": at + self.lease}), True
        if action == "write" and own["status"] == "leased":
            return self._put(s, own | {"status": "writing"}), True
        if action in ("finish", "fail"):
            status = "failed" if action == "fail" else "completed" if int(args.get("works") or 0) else "empty"
            ended = own | {"status": status, "token": None, "expires": None}
            free = {"token": None, "expires": None} if s["token"] == token else {}
            last = {"last": own["package"]} if status == "completed" else {}
            return s | free | last | {"runs": [r for r in s["runs"] if r["id"] != run], "shown": ended}, True
        return s, False

    def _put(self, s: dict, run: dict) -> dict:
        return s | {"runs": [run if r["id"] == run["id"] else r for r in s["runs"]], "shown": run}

    def done(self, s: dict | None) -> bool:
        return s is None


def _lapsed(machine, key: int, s: dict | None, until: int) -> tuple[dict | None, list[tuple]]:
    """A state at the time ``until``: what ends by then has ended, with the rows that say so."""
    rows = []
    while (ends := machine.ends(s)) is not None and ends <= until:
        s, action = machine.lapse(s)
        if action is not None:
            rows.append((key, ends, None, action, True, *machine.row(s)))
    return s, rows


def _played(machine, key: int, s: dict | None, at: int, seq: int, action: str, args) -> tuple[dict | None, list[tuple]]:
    s, rows = _lapsed(machine, key, s, at)
    s, matched = machine.step(s, at, action, dict(args or {}))
    return (None if machine.done(s) else s), [*rows, (key, at, seq, action, matched, *machine.row(s))]


def _schema(machine) -> T.StructType:
    return T.StructType.fromDDL(f"{_EVENT}, {machine.columns}")


def _times(rows: DataFrame, machine) -> DataFrame:
    """Microseconds as times."""
    fields = T.StructType.fromDDL(machine.columns).names
    return rows.select("key", F.timestamp_micros("at").alias("at"), "seq", "action", "matched", *[F.timestamp_micros(c).alias(c) if c.endswith("_at") else F.col(c) for c in fields])


def replay(events: DataFrame, machine, until: int | None = None) -> DataFrame:
    """The log's rows with what came of each, and what ended by itself by the next event or, after a key's last, by ``until`` (microseconds; None: never)."""
    names = _schema(machine).names
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), *[pa.int64() if f.dataType == T.LongType() else pa.string() for f in T.StructType.fromDDL(machine.columns)]]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for b in batches:
            rows: list[tuple] = []
            for key, at, seq, action, args in zip(*(c.to_pylist() for c in b.columns)):
                if key != held:
                    if held is not None and until is not None:
                        rows += _lapsed(machine, held, state, until)[1]
                    held, state = key, None
                state, found = _played(machine, key, state, at, seq, action, args)
                rows += found
            yield batch(rows)
        if held is not None and until is not None:
            yield batch(_lapsed(machine, held, state, until)[1])

    log = events.filter("key is not null").select("key", F.unix_micros(F.col("at").cast("timestamp")).alias("at"), "seq", "action", "args")
    order = ("key", "at", "seq", "action")
    return _times(log.repartition("key").sortWithinPartitions(*order).mapInArrow(work, _schema(machine)), machine)


class _Processor(StatefulProcessor):
    """Keeps one key's state as JSON, and a timer at the end of its lease."""

    def __init__(self, machine):
        kinds = {T.LongType(): "Int64", T.BooleanType(): "boolean"}
        self.machine, self.fields = machine, [(f.name, kinds.get(f.dataType, object)) for f in _schema(machine)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("lease", "state string")

    def _load(self) -> dict | None:
        return json.loads(self.state.get()[0]) if self.state.exists() else None

    def _keep(self, s: dict | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if s is None:
            self.state.clear()
            return
        self.state.update((json.dumps(s),))
        ends = self.machine.ends(s)
        if ends is not None:
            self.handle.registerTimer(-(-ends // 1000))

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({name: pd.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(self.fields)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        s, found = self._load(), []
        events = pd.concat(list(rows)).sort_values(["micros", "seq", "action"])
        for at, seq, action, args in zip(events["micros"], events["seq"], events["action"], events["args"]):
            s, more = _played(self.machine, key[0], s, int(at), int(seq), action, json.loads(args) if args else {})
            found += more
        self._keep(s)
        yield self._frame(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s, found = _lapsed(self.machine, key[0], self._load(), expiredTimerInfo.getExpiryTimeInMs() * 1000)
        self._keep(s)
        if found:
            yield self._frame(found)

    def close(self) -> None:
        pass


#: The state store that timers need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def replay_stream(events: DataFrame, machine, late: str = "0 seconds") -> DataFrame:
    """As ``replay`` over a stream: what ends by itself ends when the watermark, ``late`` behind the latest event, has passed that time. The session's state store
    must be STATE_STORE."""
    log = events.filter("key is not null").select("key", F.col("at").cast("timestamp").alias("at"), F.unix_micros(F.col("at").cast("timestamp")).alias("micros"), "seq", "action", F.to_json("args").alias("args"))
    played = log.withWatermark("at", late).groupBy("key").transformWithStateInPandas(_Processor(machine), _schema(machine), "Append", "EventTime")
    return _times(played, machine)
