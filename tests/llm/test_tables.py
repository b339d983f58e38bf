"""URL rules, WARC bundles, neighbours, packing and the token store against brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.llm import ann, packing, token_store, url_filter, warc
from quillspark.llm.common import scratch

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df, *names):
    return sorted(map(repr, (tuple(r[n] for n in names) for r in df.select(*names).collect())))


# URL rules

URLS = [None, "", "no scheme", "://", "http://", "http://com", "HTTP://WWW.Example.COM/en/a?b#c", "https://example.com/en", "https://example.com/en/", "https://a.example.com/en/x://y",
        "https://notexample.com/en/", "https://x.net/es/1", "https://x.net/fr/", "https://x.net/de/", "https://net/es/", "https://example.com?en/", "https://example.com#/en/", "https://exámple.com/en/\nz",
        "https://www.example.com.net/fr/2", "https://com./en/", "https://a.b.c.d.www.example.com/en/9"]


def brute_rule(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:at]), rest[at:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h) + len(p), len(h), f"{h}/{p}", v) for h, p, v in rules if (host == h or host.endswith("." + h)) and (not p or path.startswith("/" + p))]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("rules", [url_filter.CONTRACT_RULES, [("b.a", "", "block"), ("a", "x", "allow"), ("c.b.a", "x/y", "block"), ("a", "", "block"), ("d.c.b.a", "", "allow"), ("a", "x/", "block")]])
def test_urls(spark, rules):
    rng = random.Random(1)
    made = [f"http://{'.'.join(rng.choices('abcd', k=rng.randrange(1, 6)))}/{''.join(rng.choices('xy/', k=rng.randrange(5)))}" for _ in range(300)]
    urls = [*URLS, *made, *made[:50]]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = url_filter.judge_urls(pages, spark.createDataFrame(list(rules), "host string, path string, verdict string")).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_rule(urls[r["page_id"]], rules), urls[r["page_id"]]


def test_urls_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in url_filter.judge_urls(pages, none, default="block").collect()} == {"block"}
    odd = spark.createDataFrame([(None, "", "block"), ("com", None, "block"), ("com", "", None), ("", "", "block")], none.schema)
    assert {r["rule"] for r in url_filter.judge_urls(pages, odd).collect()} == {None}
    assert url_filter.judge_urls(pages.limit(0), none).count() == 0


def test_op9_matches_sql(spark):
    got = url_filter.op9_url_filter(spark, SF)
    names = ["page_id", "host", "path", "rule", "verdict"]
    want = duckdb.sql(url_filter.OP9_SQL.replace("FROM pages", f"FROM '{SF}/pages.parquet'")).select(*names).fetchall()
    assert rows_of(got, *names) == sorted(map(repr, want))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# WARC

def brute_warc(pages):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    largest = {}
    for i, _, h in pages:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", i), i)
    out = []
    for i, _, h in pages:
        to = largest.get(h or "")
        out.append((i, len((h or "").encode()), digest(h), "response" if to is None or to == i else "revisit", None if to is None or to == i else to))
    return sorted(map(repr, out))


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 200)
    pages = [(i, f"http://a/{i}", f"<p>{i % 7} é</p>" * (i % 5)) for i in range(60)] + [(100, None, None), (101, "http://a b\n/\tc", ""), (None, "u", "x"), (None, "u", "x"), (102, "u", "x"), (103, "http://c", "y" * 300_000), (104, "z", "\r\n\r\n"), (104, "z", "\r\n\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    store = scratch(spark, "warc-test")
    bundles = warc.write_bundles(df, store)
    back = warc.read_bundles(spark, store)
    assert bundles.agg(F.sum("n_records")).first()[0] == len(pages)
    assert rows_of(back, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute_warc(pages)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in back.filter("record_type = 'response'").collect()} <= {(i, h or "") for i, _, h in pages}
    # the bundle is one zstandard stream, and single records come by their id
    uri = bundles.orderBy(F.desc("n_records")).first()["bundle"]
    bundle = warc.Bundle(uri)
    with open(uri.removeprefix("file://"), "rb") as f:
        plain = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert plain == b"".join(bundle.records())
    for own in bundle.index["record_id"].to_pylist():
        assert warc.parse_record(bundle.read(own))["headers"]["warc-record-id"] == f"<{own}>"
    assert bundle.read("urn:page:none:x") is None


def test_warc_least_bytes_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    store = scratch(spark, "warc-test")
    warc.write_bundles(pages, store, least_bytes=3)
    assert {(r["page_id"], r["record_type"]) for r in warc.read_bundles(spark, store).collect()} == {(1, "response"), (2, "response"), (3, "revisit"), (4, "response")}
    store = scratch(spark, "warc-test")
    warc.write_bundles(pages.limit(0), store)
    assert warc.read_bundles(spark, store).count() == 0


def test_op5(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert rows_of(warc.op5_warc(spark, SF), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute_warc(pages)


# Neighbours

def brute_neighbours(vectors, queries, k):
    ids = np.array([i for i, _ in vectors])
    m = np.array([v for _, v in vectors], np.float64)
    norms = np.linalg.norm(m, axis=1)
    out = {}
    for i, v in queries:
        score = m @ np.array(v, np.float64) / norms / np.linalg.norm(v)
        score[ids == i] = -9
        at = np.lexsort((ids, -np.round(score, 12)))[:k]
        out[i] = [(int(ids[a]), score[a]) for a in at if score[a] > -9]
    return out


def test_op3_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_neighbours(rows, [r for r in rows if r[0] % 50 == 0], 5)
    got = {}
    for r in ann.op3_ann(spark, sf).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(want[q]) + 1))
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in zip(found, found[1:]))
        exact = dict(brute_neighbours([x for x in rows if x[0] in {f[1] for f in found}], [(q, dict(rows)[q])], 5)[q]) if q % 1000 == 0 else {}
        assert all(abs(exact[f[1]] - f[2]) < 1e-9 for f in found if exact)
        hits += len({f[1] for f in found} & {i for i, _ in want[q]})
    assert hits / sum(map(len, want.values())) >= 0.95


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, [-1.0, 0.0]), (None, [1.0, 1.0]), (50, [0.0, 0.0]), (9, [-1.0, 0.0])]
    v = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(v, v.filter("vec_id % 50 = 0"), k=5).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 9, -1.0), (0, 4, 9, -1.0)]
    assert ann.search(v.limit(0), v.limit(0)).count() == 0


def test_neighbours_extreme_components(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [5e-324, 0.0]), (4, [-1e308, 1e308])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["score"] for r in ann.search(v, v.filter("vec_id = 0"), k=5).collect()}
    want = {1: 3 / 10**0.5, 2: 3 / 10**0.5, 3: 1 / 5**0.5, 4: 1 / 10**0.5}
    assert set(got) == set(want) and all(abs(got[i] - want[i]) < 1e-12 for i in want)


@pytest.mark.parametrize("vectors, queries, leaves", [(4096, 512, 1_000_000), (7, 3, 0)])
def test_neighbours_beyond_the_sample(spark, monkeypatch, vectors, queries, leaves):
    """A table larger than the sample: full leaves are split in the tasks, and recall holds; also in small blocks, joined by a shuffle."""
    for name, value in (("BLOCK_VECTORS", vectors), ("BLOCK_QUERIES", queries), ("BROADCAST_LEAVES", leaves)):
        monkeypatch.setattr(ann, name, value)
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 400)
    monkeypatch.setattr(ann, "LEAF_LIMIT", 80)
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((60, 16))
    m = centers[rng.integers(0, 60, 6000)] + 0.4 * rng.standard_normal((6000, 16))
    rows = [(i, x.tolist()) for i, x in enumerate(m)] + [(10_001, m[0].tolist())] * 100
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    filed = {}
    monkeypatch.setattr(ann, "_leaf_counts", lambda df, f=ann._leaf_counts: filed.setdefault(len(filed), f(df)))
    got = {}
    for r in ann.search(v, v.filter("vec_id % 50 = 0"), k=5).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute_neighbours(rows[:6000], [rows[i] for i in range(50, 6000, 50)], 5)
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) / (5 * len(want)) >= 0.9
    assert all(len(got[q]) == 5 for q in want) and len(filed) > 1
    last = {leaf: n for counts in filed.values() for leaf, n in counts.items()}
    split = {leaf for k, counts in filed.items() for leaf, n in counts.items() if n > ann.LEAF_LIMIT and k < len(filed) - 1}
    assert all(sum(filed[k].values()) <= sum(filed[k - 1].values()) for k in range(1, len(filed)))  # those of split leaves alone are filed anew
    assert sum(n > ann.LEAF_LIMIT for leaf, n in last.items() if leaf not in split) <= 1  # the copies of one vector


# Packing and the token store

TEXTS = [None, "", " ", "a", "Hello, World. Hello", "x" * 5000, "word " * 5000, "É\u0301 ﬁ Ⅷ 中文 ª. º, İ ǅ", "<|endoftext|> a", "a <|endoftext|> b<|startoftext|><|EndOfText|>", "it's. we're, 12.5", "a\u00a0b\u2028c\u200bd", "ß. À, ÿ.", "été, naïve. über"]


def encoded(texts, end):
    t = Tokenizer.from_file(WORDS)
    return [[*e.ids, end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_equal_the_library(spark):
    from quillspark.llm.words import WordEncoder

    rng = random.Random(2)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices("ab.,' 1é\u00a0ÀſK中\n-", k=200)) for _ in range(300)]
    texts += ["".join(chr(rng.randrange(1, 0x3000)) for _ in range(200)) for _ in range(50)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for text, packed, ids in zip(texts, WordEncoder(WORDS).encode_packed(texts), encoded(texts, 0)):
        assert np.frombuffer(packed, "<u4").tolist() == ids[:-1], text[:80]


def check_packing(rows, want, capacity):
    by_doc, bins = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, ids in want.items():
        parts = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(-(-len(ids) // capacity)))
        for p in parts:
            assert p["start"] == p["piece"] * capacity and p["length"] == min(capacity, len(ids) - p["start"])
            assert p["ids_crc32"] == crc(ids[p["start"] : p["start"] + p["length"]])
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = dict(enumerate(encoded(TEXTS, 0)))
    rows = packing.pack_documents(docs, WORDS, 0, 2048).collect()
    assert len({r["doc_id"] for r in rows}) == len(TEXTS)
    check_packing(rows, want, 2048)
    again = packing.pack_documents(docs.unionByName(docs), WORDS, 0, 2048).collect()
    assert len(again) == 2 * len(rows) and len({(r["sequence_id"], r["offset"]) for r in again}) == len(again)
    assert packing.pack_documents(docs.limit(0), WORDS, 0, 2048).count() == 0


def test_op4_is_nearly_full(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = dict(zip([d["doc_id"] for d in docs], encoded([d["text"] for d in docs], 0)))
    bins = check_packing(packing.op4_packing(spark, SF).collect(), want, 2048)
    assert bins <= 1.02 * -(-sum(map(len, want.values())) // 2048) + 1


def test_fullest_is_the_best_sum():
    rng = random.Random(4)
    for _ in range(300):
        counts = {rng.randrange(1, 40): rng.randrange(1, 5) for _ in range(rng.randrange(1, 6))}
        free = rng.randrange(0, 90)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1)}
        taken = packing.fullest(free, counts)
        assert sum(taken) == max(s for s in sums if s <= free) and all(c <= counts[x] for x, c in Counter(taken).items())


def test_plan_uses_every_piece_once():
    rng = random.Random(6)
    histogram = dict(Counter(rng.randrange(1, 101) for _ in range(5000)))
    used = Counter()
    for times, pattern in packing.plan_bins(histogram, 100):
        assert sum(pattern) <= 100
        for x in pattern:
            used[x] += times
    assert used == Counter(histogram)


def test_token_store(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_BYTES", 500)
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(3, "a second text"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    store = scratch(spark, "tokens-test")
    manifest = token_store.write_store(docs, store, WORDS, 1, 49408)
    assert manifest.agg(F.sum("n_docs")).first()[0] == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = encoded([t for _, t in order], 1)
    starts = np.cumsum([0, *map(len, ids)])
    want = sorted((int(s), d, len(x), x) for (d, _), s, x in zip(order, starts, ids))
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_store.read_store(spark, store).collect())
    assert got == want
    shard = token_store.Shard(manifest.orderBy(F.desc("start")).first()["shard"], store)
    last = rows[len(TEXTS) - 1]
    assert shard.find(last[0]) == encoded([last[1]], 1)[0] and shard.find(-5) is None
    store = scratch(spark, "tokens-test")
    monkeypatch.setattr(token_store, "SHARD_BYTES", 1 << 20)
    large = spark.createDataFrame([(None, "no id"), ((1 << 53) + 1, "odd"), ((1 << 53) + 2, "even")], "doc_id long, text string").coalesce(1)
    for r in token_store.write_store(large, store, WORDS, 1, 49408).collect():
        shard = token_store.Shard(r["shard"], store)
        for k, i in enumerate(shard.index["doc_id"].to_pylist()):
            assert i is None or shard.find(i) == np.frombuffer(shard.packed(k), "<u4").tolist()
    store = scratch(spark, "tokens-test")
    token_store.write_store(docs.limit(0), store, WORDS, 1, 49408)
    assert token_store.read_store(spark, store).count() == 0


def test_op10(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    ids = encoded([t for _, t in docs], 1)
    starts = np.cumsum([0, *map(len, ids)])
    want = sorted(repr((d, int(s), len(x), crc(x))) for (d, _), s, x in zip(docs, starts, ids))
    assert rows_of(token_store.op10_token_store(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == want
