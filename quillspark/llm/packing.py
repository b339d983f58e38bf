"""Best-fit packing of token sequences by minimum bin slack.

Lengths are whole numbers up to the capacity, so the lengths of all pieces are one histogram of at most
``capacity`` counts, however many pieces there are. Bins are filled from it one
pattern at a time: the longest length that is left opens the bin, and a subset-sum
dynamic program over the lengths left, held as one bitset, finds the fullest feasible
combination for the rest, read back from larger lengths to smaller. The pattern found is removed
as often as the counts allow, as each further bin would be filled by the same one. After it some length x has fewer pieces left than
the pattern needs, capacity / x at most, so x can be the one that ends a pattern at most 1 + capacity / x times. Over all lengths that makes
at most capacity * (2 + ln capacity) patterns: the plan's size does not grow with the data.

The plan is then dealt out: pieces of a length are numbered (within blocks of documents
first, then block after block) and the n-th piece of a length takes the n-th place that
patterns have for that length. Both sides are joined by length and range of numbers; no task
needs all pieces of a length.

Edge cases: a null text is empty. Documents longer than the capacity, and only those, are cut; a piece may be
as long as the capacity and then fills its sequence. Documents without tokens
have no pieces. Rows that repeat a doc_id are packed each; so are equal texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import stretches
from .common import cut, table
from .words import encoder

#: Documents are numbered in blocks of this many hash values.
BLOCKS = 4096


def fullest(free: int, counts: dict[int, int]) -> list[int]:
    """Lengths from ``counts`` (length: pieces left) whose sum is the largest up to ``free``.

    Bit s of a bitset is set if some of the lengths sum to s. A length that is there n times
    enters as 1, 2, 4, ... times itself, the last part being what is left of n.
    """
    items: list[tuple[int, int]] = []
    reach, limit = 1, (1 << free + 1) - 1
    history = []
    for length in sorted((x for x in counts if x <= free), reverse=True):
        left, times = min(counts[length], free // length), 1
        while left:
            times = min(times, left)
            history.append(reach)
            items.append((length, times))
            reach |= (reach << length * times) & limit
            left -= times
            times *= 2
        if reach >> free & 1:
            break
    total, taken = reach.bit_length() - 1, []
    for (length, times), before in zip(reversed(items), reversed(history)):
        if not before >> total & 1:
            taken += [length] * times
            total -= length * times
    return taken


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Patterns (times, lengths) that together use every piece of the histogram once."""
    counts = {x: n for x, n in histogram.items() if n > 0}
    plan = []
    while counts:
        pattern = [max(counts)]
        counts[pattern[0]] -= 1
        pattern += fullest(capacity - pattern[0], {x: n for x, n in counts.items() if n})
        counts[pattern[0]] += 1
        needs = {x: pattern.count(x) for x in pattern}
        times = min(counts[x] // n for x, n in needs.items())
        for x, n in needs.items():
            counts[x] -= times * n
            if not counts[x]:
                del counts[x]
        plan.append((times, pattern))
    return plan


def places(plan: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each pattern and length (length, first, last, per bin, first sequence, offset): pieces of that
    length numbered first..last stand in it, ``per bin`` of them in each bin from ``offset`` on."""
    used: dict[int, int] = {}
    found, sequence = [], 0
    for times, pattern in plan:
        offset = 0
        for length in dict.fromkeys(pattern):
            n = pattern.count(length)
            first = used.get(length, 0)
            found.append((length, first, first + times * n - 1, n, sequence, offset))
            used[length] = first + times * n
            offset += n * length
        sequence += times
    return found


def pieces(docs: DataFrame, path: str, end_id: int | None, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts and cut the ids: (doc_id, piece, start, length, ids_crc32)."""
    tail = b"" if end_id is None else end_id.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for b in batches:
            for i, j in stretches(b.column(1)):
                ids, texts = (c.slice(i, j - i).to_pylist() for c in b.columns)
                rows = []
                for doc_id, packed in zip(ids, words.encode_packed(texts)):
                    packed += tail
                    for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                        part = packed[at : at + 4 * capacity]
                        rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=names)

    texts = docs.select(F.col(id_col).cast("long"), F.coalesce(text_col, F.lit("")))
    return texts.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(parts: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to ``parts`` (doc_id, piece, length and more). ``parts`` must read the
    same rows again, so it comes from a written table."""
    spark = parts.sparkSession
    histogram = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}  # at most `capacity` rows
    found = places(plan_bins(histogram, capacity))
    grid = spark.createDataFrame(found or [(0, 0, -1, 1, 0, 0)], "length long, first long, last long, per long, sequence long, at long")
    own = parts.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BLOCKS)).cast("int"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = own.groupBy("length", "block").count().select("length", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "block").orderBy(*parts.columns)
    numbered = own.withColumn("nth", F.row_number().over(within) - 1).join(bases, ["length", "block"]).withColumn("nth", F.col("nth") + F.col("base"))
    ranges = grid.groupBy(F.col("length").alias("l")).agg(F.array_sort(F.collect_list(F.struct("first", "last", "per", "sequence", "at"))).alias("ranges"))
    # a place a pattern and length of it: bounded by the capacity, as the module says
    placed = numbered.join(F.broadcast(ranges), F.col("length") == F.col("l")).withColumn(
        "r", F.element_at(F.filter("ranges", lambda r: (r["first"] <= F.col("nth")) & (F.col("nth") <= r["last"])), 1)
    )
    k = F.col("nth") - F.col("r.first")
    return placed.withColumn("sequence_id", F.col("r.sequence") + F.floor(k / F.col("r.per")).cast("long")).withColumn(
        "offset", F.col("r.at") + (k % F.col("r.per")) * F.col("length")
    ).drop("block", "nth", "base", "l", "ranges", "r")


def pack_documents(docs: DataFrame, path: str, end_id: int | None, capacity: int) -> DataFrame:
    return pack(cut(pieces(docs, path, end_id, capacity), "pieces"), capacity)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 0, 2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
