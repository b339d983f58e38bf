"""The whole pipeline against brute-force versions of its stages, one after the other; and rows that crowd one key."""

import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from test_dedup import brute_lines, brute_simhash, near_texts, shingles, union
from test_tables import check_packing, encoded

import corpus_pipeline
from quillspark.llm import common, repetition, simhash, token_store, toxicity

SF = "/root/testdata/sf0.001"
WORDS = corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")


def keeps_quality(text):
    """Whether a text passes, from its n-grams: words in repeats of 16 words or more are those in windows of 16 that are found twice."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def twice(n):
        seen, found = {}, set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            found |= {i, seen[gram]} if gram in seen else set()
            seen.setdefault(gram, i)
        return found

    def inside(n):
        return len({j for i in twice(n) for j in range(i, i + n)})

    if len(words) < 50 or 100 * inside(3) > 50 * len(words):
        return False
    low, high = 15, len(words)  # the longest repeat
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if twice(mid) else (low, mid - 1)
    return inside(16) <= repetition.MAX_COVERED * len(words) and (low if low > 15 else 0) <= repetition.MAX_LONGEST


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity._load(toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet")).dump())
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if toxicity.curve_at(model.curve, *toxicity.features(model, t or "")) < corpus_pipeline.TOXIC]
    rows = [(i, t) for i, t in rows if keeps_quality(t)]
    gone = {(i, n) for _, i, _, n in brute_lines(rows)}
    rows = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)) for i, t in rows]
    sets = {i: shingles(t) for i, t in rows}
    root = union(sets, [(a, b) for a, b in combinations(sets, 2) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    rows = [(i, t) for i, t in rows if root[i] == i]
    want = dict(zip([i for i, _ in rows], encoded([t for _, t in rows], corpus_pipeline.END_ID)))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(want) and 50 < len(want) < docs.count()
    bins = check_packing(got, want, corpus_pipeline.CAPACITY)
    assert bins <= 1.05 * -(-sum(map(len, want.values())) // corpus_pipeline.CAPACITY) + 1


def test_toxicity_learns_one_row_an_id(spark, monkeypatch):
    """Two labelled ids, one of them on very many rows with other texts."""
    docs = spark.range(3000).select((F.col("id") % 2).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    sizes, real = [], toxicity.cut
    monkeypatch.setattr(toxicity, "cut", lambda df, name: sizes.append(df.count()) or real(df, name))
    toxicity.train(docs, labels)
    assert sizes == [2]


def test_rows_of_one_id_are_many_tasks(spark, tmp_path):
    docs = spark.range(400).select(F.when(F.col("id") < 390, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 200).cast("string")).alias("text"))
    store = f"file://{tmp_path}/store"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little would be one task
    try:
        token_store.write_store(docs, store, WORDS, end_id=1, vocab_size=49408)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{store}/written").select("task").distinct().count() > 1
    got = sorted(token_store.read_store(spark, store).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [7] * 390 + list(range(390, 400))
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(400)]
    want = sorted(zip([r["doc_id"] for r in docs.collect()], map(tuple, encoded([r["text"] for r in docs.collect()], 1))))
    assert sorted((r["doc_id"], tuple(memoryview(bytes(r["ids"])).cast("I"))) for r in got) == want


@pytest.mark.parametrize("heavy", [3, 20])
def test_heavy_fingerprints(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY_ROWS", heavy)
    texts = near_texts()
    rows = [*enumerate(texts), *[(1000 + k, texts[8]) for k in range(30)], *[(2000 + k, None) for k in range(25)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs, 3).collect()
    assert sorted((r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in found) == brute_simhash(rows)
    near = simhash.near_copies(docs.filter("doc_id >= 100"))
    assert sorted((r["doc_id"], r["component_id"]) for r in near.collect() if r["doc_id"] >= 1000) == [(1000 + k, min(i for i, t in rows if i >= 100 and len(shingles(t) & shingles(texts[8])) >= 0.8 * len(shingles(t) | shingles(texts[8])))) for k in range(30)] + [(2000 + k, 2000) for k in range(25)]
