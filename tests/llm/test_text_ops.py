"""Repetition, BPE and toxicity against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from quillspark.llm import bpe, repetition, toxicity, words

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "\n\n", "a", "a b c", "word " * 300, "x" * 50_000, "É à\u00a0b\u2003c 中文。 a\x00b", "one two three\n" * 40, "# $ % & | < > *"]


def odd_docs(spark, *more):
    rows = [(i, t, None, "s", None) for i, t in enumerate([*ODD, *more])]
    return spark.createDataFrame([*rows, rows[6], rows[6]], DOCS)


def brute_repetition(text, min_words=16):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    lines = (text or "").split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:k] for k, x in enumerate(lines))
    grams = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    inside = {j for i in range(n - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    best = [0] * n
    if n < 1000:
        table = [[0] * (n + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(n - 1, i, -1):
                if words[i] == words[j]:
                    table[i][j] = 1 + table[i + 1][j + 1]
                    best[i], best[j] = max(best[i], table[i][j]), max(best[j], table[i][j])
    covered = {k for i in range(n) if best[i] >= min_words for k in range(i, i + best[i])}
    longest = max([b for b in best if b >= min_words], default=0)
    base = n < 50 or 100 * len(inside) > 50 * n
    kept = not base and len(covered) <= repetition.MAX_COVERED * n and longest <= repetition.MAX_LONGEST
    return [n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(inside), base, len(covered), longest, kept]


def test_repetition_is_exact(spark):
    rng = random.Random(3)
    passages = [" ".join(rng.choices("abcdefghijkl", k=30)) for _ in range(3)]
    texts = []
    for k in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.3 else " ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 8))]
        texts.append(rng.choice([" ", "\n", "\t\x0b"]).join(parts))
    docs = odd_docs(spark, *texts)
    got = repetition.with_repetition(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert [r[name] for name, _ in repetition.FIELDS] == brute_repetition(r["text"]), r["doc_id"]


def test_repetition_keeps_other_columns(spark):
    docs = odd_docs(spark).withColumn("kept", F.lit("own")).withColumn("n_words", F.lit("own"))
    got = repetition.with_repetition(docs, prefix="r_", fields=("kept",))
    assert got.columns == [*docs.columns, "r_kept"] and got.filter("kept = 'own'").count() == docs.count()
    assert dict(repetition.with_repetition(docs).dtypes)["n_words"] == "bigint"
    assert repetition.with_repetition(docs.limit(0)).count() == 0


def test_op1_columns(spark):
    got = repetition.op1_repetition(spark, SF)
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "covered_words"] and "kept" in got.columns
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.fixture(scope="module")
def tik():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark, tik):
    rng = random.Random(5)
    noise = ["".join(rng.choices("ab \n'é中😀0", k=400)) for _ in range(20)] + ["".join(chr(rng.randrange(1, 0xD7FF)) for _ in range(300)) for _ in range(10)]
    docs = odd_docs(spark, *noise).unionByName(spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000), allowMissingColumns=True)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    want = {}
    for r in docs.collect():
        ids = tik.encode_ordinary(r["text"] or "")
        packed = np.array(ids, "<u4").tobytes()
        want[r["doc_id"]] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(tik.decode_bytes(ids)).hexdigest(), packed)
    got = bpe.digest_documents(docs, path, pattern).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want[r["doc_id"]][:3]
    both = bpe.decode_documents(bpe.encode_documents(docs, path, pattern), path, pattern)
    for r in both.join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        assert bytes(r["ids"]) == want[r["doc_id"]][3] and bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe.digest_documents(docs.limit(0), path, pattern).count() == 0


def test_toxicity_folding():
    assert toxicity.fold("Ѕtup1d  IDI0T!") == " stupid idiot "
    model = toxicity._load(toxicity.seed_model().dump())
    score = lambda t: toxicity.curve_at(model.curve, *toxicity.features(model, t))
    assert score("you stup1d ідіот") > 0.5 > score("a class clown near the trash can") and score("") < 0.5
    assert score("the idiot proof box") == score("the plain box")


def test_toxicity_hits_by_a_naive_matcher():
    """Every word by its heaviest entry at its start, none within an exception phrase."""
    rng = random.Random(17)
    weights = {" idiot ": 4.0, " idi": 1.5, " scum": 3.0, " trash ": 4.0, " tras": 2.0, " clown ": 2.5, " can ": 0.5}
    model = toxicity._load(toxicity.Model(weights, toxicity.SEED_CURVE).dump())

    def naive(folded):
        spans = [(m.start(), m.start() + len(p) + 1) for p in toxicity.EXCEPTIONS for m in re.finditer(f"(?={re.escape(f' {p} ')})", folded)]
        starts = {k: max([w for e, w in weights.items() if folded.startswith(e, k)], default=0.0) for k in range(len(folded))}
        return sum(w for k, w in starts.items() if not any(a <= k < b for a, b in spans))

    for _ in range(400):
        text = toxicity.fold(" ".join(rng.choices(["idiot", "idiotic", "proof", "scum", "line", "trash", "can", "class", "clown", "fish", "x"], k=rng.randrange(12))))
        assert abs(toxicity.hits(model, text) - (naive(text) if len(text) > 2 else 0.0)) < 1e-9, text


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = toxicity.op8_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    pairs = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if r["held_out"] and labels.get(r["doc_id"]) in (0, 1):
            pairs.append((r["predicted"], labels[r["doc_id"]]))
    right = Counter(pairs)
    assert right[1, 1] / max(1, right[1, 1] + right[0, 1]) > 0.9 and right[1, 0] / len(pairs) < 0.02


def test_toxicity_edges(spark):
    docs = odd_docs(spark).withColumn("score", F.lit("own"))
    labels = spark.createDataFrame([(0, 1), (1, None), (99, 1), (2, 7), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.with_score(docs, model)
    assert got.count() == docs.count() and dict(got.dtypes)["score"] == "double" and got.filter("score is null").count() == 0
    assert toxicity.with_score(docs.limit(0), toxicity.train(docs.limit(0), labels.limit(0))).count() == 0


def test_a_worker_keeps_a_bounded_number_of_words(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(words, "KEPT", 20)
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = words.WordEncoder(path), Tokenizer.from_file(path)
    texts = [" ".join(f"the word{k * j}x is Ünlike {k}, {chr(0x4E00 + k)}." for k in range(40)) for j in range(1, 6)]
    got = [np.frombuffer(x, "<u4").tolist() for t in texts for x in own.encode_packed([t])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, (own, own.older, own.parts, own.older_parts))) <= 20 and b"the" in own
