"""Lines read in splits, digests in chunks, archives checked again, streams of records, and replayed pages."""

import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quillspark.sources import files, lines, replay
from quillspark.sources import packages as P


def numbered_by_hand(path):
    with open(path, newline="") as f:
        text = f.read()
    rows = text.split("\n")
    return [(os.path.basename(path), n, x) for n, x in enumerate(rows[:-1] if rows[-1] == "" else rows, 1)]


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_line_numbers_over_splits(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(lines, "BROADCAST_SPLITS", broadcast)
    rng = random.Random(2)
    for k, n in enumerate([0, 1, 3000, 5000, 7]):
        rows = ["".join(rng.choice("aé  \r,{}") for _ in range(rng.choice([0, 3, 80]))) for _ in range(n)]
        (tmp_path / f"f{k}.txt").write_text("\n".join(rows) + ("\n" if k % 2 else ""), newline="")
    (tmp_path / "long.txt").write_text("x" * 300_000 + "\n\ny\n\n")
    was = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        found = lines.scan_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 40
        got = sorted((r["file"], r["line"], r["value"]) for r in found.collect())
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    assert got == sorted(r for p in tmp_path.iterdir() for r in numbered_by_hand(p))


def test_violations_name_the_line(spark, tmp_path):
    good = {"sourceTagId": "t", "type": "Fandom", "name": "n", "canonical": None, "sourceUrl": None}
    rows = [json.dumps(good | {"sourceTagId": f"t{k}"}) for k in range(2000)]
    rows[7], rows[1500], rows[1999] = "{", json.dumps(good | {"name": ""}), "[]"
    (tmp_path / "tags.jsonl").write_text("\n".join(rows) + "\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        records, problems = P.scan_records(spark, str(tmp_path / "tags.jsonl"), "tags")
        assert records.count() == 1997
        assert sorted(map(tuple, problems.collect())) == [("tags.jsonl", 8, "not a JSON object"), ("tags.jsonl", 1501, "name: Invalid value"), ("tags.jsonl", 2000, "not a JSON object")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_streamed_records_and_their_problems(spark, tmp_path):
    good = {"sourceTagId": "t", "type": "Fandom", "name": "n", "canonical": None, "sourceUrl": None}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text(json.dumps(good) + "\n \t\n\n{oops\n")
    (tmp_path / "in" / "b.jsonl").write_text(json.dumps(good | {"type": "Odd"}) + "\n" + json.dumps(good | {"sourceTagId": "u"}))
    for k, stream in enumerate(P.stream_records(spark, str(tmp_path / "in"), "tags")):
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/o{k}").option("checkpointLocation", f"{tmp_path}/c{k}").trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(r["sourceTagId"] for r in spark.read.parquet(f"{tmp_path}/o0").collect()) == ["t", "u"]
    assert sorted((r["file"], r["problem"]) for r in spark.read.parquet(f"{tmp_path}/o1").collect()) == [("a.jsonl", "not a JSON object"), ("b.jsonl", "type: Invalid value")]


def test_digests_and_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "CHUNK", 1000)
    bodies = {"a": b"", "b": b"x" * 2500, "c": os.urandom(1000), "d": b"old"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    want = {name: (len(b), hashlib.sha256(b).hexdigest()) for name, b in bodies.items()}
    assert {r["name"]: (r["bytes"], r["sha256"]) for r in files.folder_digests(spark, str(tmp_path)).collect()} == want
    assert {r["name"]: (r["bytes"], r["sha256"]) for r in files.folder_digests(spark, f"file://{tmp_path}").collect()} == want
    runs = [(k, "completed", f"{tmp_path}/{n}", want[n][1], want[n][0]) for k, n in enumerate("abcd")]
    runs += [(4, "completed", f"{tmp_path}/lost", "0", 1), (5, "failed", f"{tmp_path}/a", want["a"][1], 0), (6, "completed", None, "0", 1), (7, "completed", f"{tmp_path}/a", None, 0)]
    (tmp_path / "c").write_bytes(os.urandom(1000))
    (tmp_path / "d").write_bytes(b"longer")
    df = spark.createDataFrame(runs, "id long, status string, archive_path string, archive_hash string, archive_bytes long")
    got = {r["id"]: (r["verified"], r["outcome"]) for r in files.verify_archives(df).collect()}
    assert got == {0: (True, "verified"), 1: (True, "verified"), 2: (False, "tampered"), 3: (False, "resized"), 4: (False, "missing"), 5: (False, "unavailable"), 6: (False, "unavailable"), 7: (False, "unavailable")}
    named = df.filter("id = 1").withColumn("archive_hash", F.concat(F.lit("sha256:"), "archive_hash"))
    assert files.verify_archives(named, "sha256:").first()["current_hash"] == "sha256:" + want["b"][1]
    with pytest.raises(ValueError, match="taken"):
        files.digests(spark.createDataFrame([("x", 1)], "path string, bytes long"))


def test_replay_goes_on_where_it_was(spark, tmp_path):
    replay.register(spark)
    folder = tmp_path / "pages"
    folder.mkdir()

    def save(*ids, at):
        for i in ids:
            part = folder / f"{i}.part"
            part.write_bytes(f"<p>é {i}".encode())
            os.utime(part, ns=(at, at))
            part.rename(folder / f"{i}.html")

    def run():
        stream = spark.readStream.format("replay").option("pages", 2).load(str(folder))
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(r["work_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect())

    save("9", "10", "b", "a", "7", at=10**18)
    (folder / "note.txt").write_text("no page")
    assert run() == ["10", "7", "9", "a", "b"]
    save("1", "c", at=10**18 + 5)
    assert run() == ["1", "10", "7", "9", "a", "b", "c"]
    assert run() == ["1", "10", "7", "9", "a", "b", "c"]  # nothing new
    batch = spark.read.format("replay").option("pages", 3).load(str(folder))
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, spark.read.schema(batch.schema).parquet(f"{tmp_path}/out").collect()))
    assert batch.filter("work_id = '9'").first()["html"] == "<p>é 9"
    assert spark.read.format("replay").load(str(tmp_path / "none")).count() == 0
