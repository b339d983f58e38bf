"""Quality rules on repetition, by suffix arrays over words.

The suffixes of a document's word sequence are sorted by prefix doubling: ranks by the
first 2^j words come from pairs of ranks by 2^(j-1) words. The intervals of the order with a common prefix are the maximal repeated
substrings; a suffix lies deepest in the interval of its longer common prefix with a neighbour, so
the union of the intervals' spans is the union of [start, start + that prefix). A
document is rejected if the covered fraction of its words or its longest repeat is over
a limit.

All documents of a slice are sorted in one array; ranks begin from pairs of document and
word, so no suffix matches one of another document. Common prefixes of neighbours are found by Kasai's scan,
so only one array of ranks is kept. Only documents in which a window
of three words is repeated so often that a repeat of MIN_WORDS words is possible are sorted.

Edge cases: a null text has no words and fails the base rule. A document without words has a
covered fraction of zero. Repeats may overlap themselves. Texts are judged whole; memory
grows with the longest text of a slice, about 200 bytes a word, however often it repeats itself. Repeated rows are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, table

#: A repeat counts from this many words on. Limits: covered fraction of the words, words of the longest repeat.
MIN_WORDS = 16
MAX_COVERED = 0.30
MAX_LONGEST = 200
#: Base rules: words that a text needs, and its share of words (in percent) in repeated windows.
LEAST_TEXT_WORDS = 50
WINDOW = 3
MAX_REPEAT_PERCENT = 50

# The characters that part words, and those that count as symbols.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

FIELDS = (
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
    ("base_failed", "boolean"), ("covered_words", "long"), ("longest_repeat", "long"), ("kept", "boolean"),
)


def _paired(first: np.ndarray, second: np.ndarray, n_second: int) -> np.ndarray:
    """One key for each pair; equal for equal pairs and in their order."""
    if len(first) and int(first.max()) >= (1 << 62) // max(1, n_second):
        first = _ranks(first)
    return first * n_second + second


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of keys: equal for equal keys, in their order."""
    order = np.argsort(keys)
    ranked = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1]))) if len(keys) else 0
    return rank


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys are found more than once."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.concatenate(([False], ranked[1:] == ranked[:-1], [False]))
    found = np.empty(len(keys), bool)
    found[order] = same[1:] | same[:-1]
    return found


def _union(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def longest_matches(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each suffix the longest prefix that it shares with another suffix of its document.

    words: word ids; doc: the number of the document of each word, ascending; end: for each word the place after
    the last word of its document.
    """
    n = len(words)
    at = np.arange(n)
    rank = _ranks(_paired(doc, words, int(words.max()) + 1))
    step = 1
    while rank.max() < n - 1:
        after = at + step
        second = np.where(after < end, rank[np.minimum(after, n - 1)] + 1, 0)
        rank = _ranks(_paired(rank, second, n + 1))
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = at
    # Kasai's scan in text order: the prefix that a suffix shares with the one before it in the order shrinks by one word at most
    common = np.zeros(n, np.int64)
    before = np.where(rank > 0, order[rank - 1], -1).tolist()
    ids, ends, shared = words.tolist(), end.tolist(), 0
    for i in range(n):
        j, stop = before[i], ends[i]
        if j < 0 or ends[j] != stop:  # the first of a document: documents do not share suffixes
            shared = 0
            continue
        most = stop - max(i, j)
        while shared < most and ids[i + shared] == ids[j + shared]:
            shared += 1
        common[rank[i]] = shared
        shared = max(0, shared - 1)
    longest = common.copy()  # by place in the order: the longer of the prefixes shared with the neighbours
    longest[:-1] = np.maximum(longest[:-1], common[1:])
    return longest[rank]


def _dup_lines(text: str) -> int:
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, n = set(), 0
    for line in lines:
        if line in seen:
            n += bool(line.strip(BLANKS))
        seen.add(line)
    return n


def judge_texts(texts: list[str], min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> list[np.ndarray]:
    """The columns of FIELDS for some texts."""
    split = [t.encode().split() for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    word_chars = np.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], np.int64)
    symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64)
    dup_lines = np.array([_dup_lines(t) for t in texts], np.int64)
    repeat_words, covered, longest = (np.zeros(len(texts), np.int64) for _ in range(3))
    n = int(counts.sum())
    if n:
        words = pd.factorize(np.array([w for s in split for w in s], dtype=object))[0].astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), counts)
        end = np.repeat(np.cumsum(counts), counts)
        vocabulary = int(words.max()) + 1
        starts = np.flatnonzero(np.arange(n) + WINDOW <= end)
        key = doc[starts]
        for k in range(WINDOW):
            key = _paired(key, words[starts + k], vocabulary)
        again = starts[_repeated(key)]
        inside = _union(again, WINDOW, n)
        repeat_words = np.bincount(doc[inside], minlength=len(texts))
        # a repeat of min_words words begins with min_words - WINDOW + 1 repeated windows in a row
        run = np.zeros(n + 1, np.int64)
        run[1:] = np.cumsum(np.bincount(again, minlength=n))
        need = max(1, min_words - WINDOW + 1)
        may = again[(again + need <= n) & (run[np.minimum(again + need, n)] - run[again] == need)]
        chosen = np.zeros(len(texts), bool)
        chosen[doc[may]] = True
        if chosen.any():
            sub = np.flatnonzero(chosen[doc])
            sizes = counts[chosen]
            matches = longest_matches(words[sub], doc[sub], np.repeat(np.cumsum(sizes), sizes))
            long = np.flatnonzero(matches >= min_words)
            where = doc[sub][_union(long, matches[long], len(sub))]
            covered = np.bincount(where, minlength=len(texts))
            np.maximum.at(longest, doc[sub][long], matches[long])
    base = (counts < LEAST_TEXT_WORDS) | (100 * repeat_words > MAX_REPEAT_PERCENT * counts)
    kept = ~base & (covered <= max_covered * counts) & (longest <= max_longest)
    return [counts, word_chars, symbols, dup_lines, repeat_words, base, covered, longest, kept]


def with_repetition(df: DataFrame, text_col: str = "text", prefix: str = "", fields: tuple[str, ...] = tuple(n for n, _ in FIELDS)) -> DataFrame:
    """All rows and columns of ``df`` and the chosen columns of FIELDS, each with ``prefix`` before its
    name; columns of ``df`` with such a name are replaced."""
    df = df.drop(*[prefix + f for f in fields])
    at = df.columns.index(text_col)
    kinds = {"long": pa.int64(), "boolean": pa.bool_()}
    picked = [(k, prefix + f, kinds[kind]) for k, (f, kind) in enumerate(FIELDS) if f in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            for i, j in slices(texts):
                found = judge_texts(texts[i:j])
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(found[k], kind) for k, _, kind in picked]], names=[*b.schema.names, *[name for _, name, _ in picked]])

    schema = T.StructType([*df.schema.fields, *[T.StructField(prefix + f, T.LongType() if kind == "long" else T.BooleanType()) for f, kind in FIELDS if f in fields]])
    return df.mapInArrow(work, schema)


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = with_repetition(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[F.col(name) for name, _ in FIELDS])
