"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded before matching: lower case, look-alike letters of other scripts to the Latin
letters they imitate, digits between or beside letters to the letters they stand for, everything but
letters to single blanks. Lexicon entries are whole words or beginnings of words; an
Aho-Corasick automaton finds all in one pass. Exception phrases are entries
of the same automaton: what lies inside one does not count.

The lexicon holds a short fixed list and what labelled rows teach: beginnings and words that are
found in far more toxic documents than clean ones (likelihood-ratio test), weighted by their
log odds. Matches are summed by weight and normalised by the number of words; a logistic curve over the
density and the sum turns them into a score. Training takes a bounded sample of the labelled rows (TRAIN_ROWS,
lowest hashes of the id first); candidates are counted in the tasks and summed by Spark.

Edge cases: null and empty texts, and texts without letters, have no matches and take the curve's value there.
Labels other than 0 and 1, and labels of documents that are not there, are ignored. Repeated rows are scored
each. With too few labels of either class to train on, the fixed list and curve hold.
"""

from __future__ import annotations

import json
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table

#: Labelled rows that training takes, and the most lexicon entries it may learn.
TRAIN_ROWS = 20_000
LEXICON_ENTRIES = 4096
#: Learned entries: letters in a beginning of a word, documents they are in at least, likelihood ratio at least.
PREFIX_LETTERS = (3, 8)
LEAST_DOCS = 3
LEAST_RATIO = 25.0

# Words that count before anything is learned, and phrases in which they do not.
SEED_WORDS = ("idiot", "moron", "stupid", "scum", "loser", "trash", "worthless", "pathetic", "disgusting", "clown")
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "circus clown", "sore loser", "loser bracket", "idiot proof", "scum line")
SEED_WEIGHT = 4.0
#: Used where there are too few labels: intercept, and factors of the density and of the sum.
SEED_CURVE = (-4.0, 20.0, 1.2)

# Letters that look like Latin ones, and digits that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a"}

_LOOKS = str.maketrans(HOMOGLYPHS)
_STANDS = str.maketrans(DIGITS)
_LEET = regex.compile(r"\p{L}[\p{L}013457@8]*[013457@8][\p{L}013457@8]*|[013457@8]+\p{L}[\p{L}013457@8]*")
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_WIDE = regex.compile("[\uff01-\uff60\u200b-\u200d\u00ad]")


def fold(text: str) -> str:
    """Folded words with one blank before, between and after them."""
    if not text.isascii():
        if _WIDE.search(text):
            text = unicodedata.normalize("NFKC", regex.sub("[\u200b-\u200d\u00ad]", "", text))
        text = text.lower().translate(_LOOKS)
    else:
        text = text.lower()
    text = _LEET.sub(lambda m: m[0].translate(_STANDS), text)
    return f" {_OTHER.sub(' ', text).strip()} "


@dataclass(frozen=True)
class Model:
    """Weights of entries (" word " or " beginning") and the curve."""

    weights: dict[str, float]
    curve: tuple[float, float, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    automaton: object = field(default=None, compare=False)

    def dump(self) -> str:
        return json.dumps([self.weights, self.curve, self.exceptions])


def seed_model() -> Model:
    return Model({f" {w} ": SEED_WEIGHT for w in SEED_WORDS}, SEED_CURVE)


@lru_cache(maxsize=2)
def _load(dumped: str) -> Model:
    weights, curve, exceptions = json.loads(dumped)
    auto = ahocorasick.Automaton()
    for p in exceptions:
        auto.add_word(f" {p} ", (len(p) + 2, None))
    for p, w in weights.items():
        auto.add_word(p, (len(p), w))
    auto.make_automaton()
    return Model(weights, tuple(curve), tuple(exceptions), auto)


def hits(model: Model, folded: str) -> float:
    """Sum of the weights of matched words: each word counts once, by its heaviest entry."""
    if len(folded) < 3 or not model.weights:
        return 0.0
    words: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (n, w) in model.automaton.iter(folded):
        start = end + 1 - n
        if w is None:
            spared.append((start, end))
        elif w > words.get(start, 0.0):
            words[start] = w
    if not spared:
        return sum(words.values())
    # words and spans by their starts: a word lies in a span if it starts before the furthest end of those that began
    spared.sort()
    total, reach, k = 0.0, -1, 0
    for at in sorted(words):
        while k < len(spared) and spared[k][0] <= at:
            reach = max(reach, spared[k][1])
            k += 1
        if at >= reach:
            total += words[at]
    return total


def features(model: Model, text: str) -> tuple[float, float]:
    """Weight of the matches for each word, and the logarithm of one and their sum."""
    folded = fold(text)
    total = hits(model, folded)
    return (total / max(1, folded.count(" ") - 1), math.log1p(total)) if total else (0.0, 0.0)


def curve_at(curve: tuple[float, float, float], density: float, total: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, curve[0] + curve[1] * density + curve[2] * total))))


def _terms(folded: str) -> set[str]:
    low, high = PREFIX_LETTERS
    found = set()
    for w in set(folded.split()):
        if len(w) >= low:
            found.add(f" {w} ")
            found.update(f" {w[:n]}" for n in range(low, min(high, len(w)) + 1))
    return found


def _likelihood_ratio(a: int, b: int, n1: int, n0: int) -> float:
    """Twice the log likelihood ratio of an entry in a of n1 toxic and b of n0 clean documents."""
    def part(k: float, n: float, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n - k else 0.0)

    p = (a + b) / (n1 + n0)
    if not 0 < p < 1:
        return 0.0
    return 2 * (part(a, n1, a / n1) + part(b, n0, b / n0) - part(a, n1, p) - part(b, n0, p))


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small ridge, by Newton's method; its factors are not negative."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + 0.1 * w * [0, 1, 1]
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-6, 0.1, 0.1]), grad)
        w -= step
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1] / scale[0]), float(w[2] / scale[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn the lexicon's weights and the curve from at most TRAIN_ROWS labelled documents. Of rows that repeat a labelled id with other texts one is learnt from, that
    of the smallest hash."""
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter("y in (0, 1) and id is not null")
        .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)
    )
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    sample = found.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("x")).select("x.y", "x.text")
    rows = cut(sample, "toxicity-sample")  # read twice

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found[y].update(_terms(fold(t or "")))
                found[y][""] += 1
        terms = list(found[0].keys() | found[1].keys())
        for i in range(0, max(1, len(terms)), 10_000):
            part = terms[i : i + 10_000]
            yield pa.record_batch([pa.array(part, pa.string()), pa.array([found[1][t] for t in part], pa.int64()), pa.array([found[0][t] for t in part], pa.int64())], names=["term", "toxic", "clean"])

    counts = rows.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    kept = counts.filter(f"term = '' or a >= {LEAST_DOCS} and a >= b").orderBy(F.expr("term = ''").desc(), F.expr("a - b").desc(), "term").limit(16 * LEXICON_ENTRIES)
    table_ = {r[0]: (r[1], r[2]) for r in kept.collect()}  # at most 16 * LEXICON_ENTRIES rows
    n1, n0 = table_.pop("", (0, 0))
    if n1 < LEAST_DOCS or n0 < LEAST_DOCS:
        return seed_model()
    weights = seed_model().weights
    scored = [(t, a, b, _likelihood_ratio(a, b, n1, n0)) for t, (a, b) in table_.items()]
    for t, a, b, ratio in sorted(scored, key=lambda x: (-x[3], len(x[0]), x[0])):
        if len(weights) >= LEXICON_ENTRIES:
            break
        odds = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
        if ratio >= LEAST_RATIO and odds >= math.log(10):
            weights[t] = max(weights.get(t, 0.0), round(odds, 4))
    dumped = Model(weights, SEED_CURVE).dump()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _load(dumped)
        for b in batches:
            got = [features(model, t or "") for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64())], names=["y", "density", "total"])

    got = rows.mapInArrow(measure, "y long, density double, total double").toArrow()  # at most TRAIN_ROWS rows
    m = np.column_stack([c.to_numpy().astype(np.float64) for c in got.columns])
    m = m[np.lexsort(m.T[::-1])]  # the fit adds in one order whatever the partitions
    return Model(weights, _fit_curve(m[:, 1:], m[:, 0]))


def with_score(df: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of ``df``, and the score (0 to 1) as column ``name`` (replaced if there)."""
    df = df.drop(name)
    dumped, at = model.dump(), df.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _load(dumped)
        for b in batches:
            scores = [curve_at(own.curve, *features(own, t.as_py() or "")) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, name])

    return df.mapInArrow(work, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    scored = with_score(docs, train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
