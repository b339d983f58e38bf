"""How document filters interact: what each of five filters removes in each order that they can run in.

Every document gets a mask of the filters that it fails. A table of 32 masks by 120 orders holds the step at which a document
with that mask is removed. Documents are counted by part, mask and labels first, so a part of any size is at most 128 rows;
``mapInArrow`` looks these up in the table, ``np.bincount`` adds their counts up by part, order and step, and a part's partial arrays
are summed.

Filters: A: under LEAST_WORDS words; B: fewer than LEAST_DISTINCT percent of the words are distinct; C: more than MOST_CAPITALS
percent of the code points are A to Z; D: holds one of MARKS; E: a row of smaller doc_id has the same text (by 128 bits of hash).

Edge cases: a null text is empty, and equal to an empty one; without words B and C are passed. A null part is the empty string. Rows with a null
doc_id have no smaller one and no labels, and are smaller than none. Rows that repeat a doc_id are counted each; with equal
texts they don't make each other fail E. Of several label rows of a doc_id any that says so counts. An empty table has no parts and no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, join_counted, table

LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
MARKS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
CELLS = len(ORDERS) * STEPS
#: Counted rows that a task looks up at a time.
SLICE_ROWS = 1024
#: What is counted in each cell (order, step).
COUNTS = ["total", "failed", "removed", "unique_fails", "good_lost", "toxic_lost"]

_BITS = np.array([[1 << FILTERS.index(f) for f in order] for order in ORDERS])


def first_failures() -> np.ndarray:
    """(32, 120): the step, from 0, at which a document with these failures is removed in this order; STEPS: never."""
    fails = (np.arange(1 << STEPS)[:, None, None] & _BITS[None]) > 0
    return np.where(fails.any(axis=2), fails.argmax(axis=2), STEPS)


FIRST = first_failures()


def text_failures(text: bytes, points: int) -> int:
    """The mask of A to D for a text in UTF-8 with so many code points."""
    words = text.split()
    n = len(words)
    return (
        (n < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * n) << 1
        | (100 * (len(text) - len(text.translate(None, CAPITALS))) > MOST_CAPITALS * points) << 2 | (len(text.translate(None, MARKS)) < len(text)) << 3
    )


def _texts_judged(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(id, part, mask, k1, k2): the mask of A to D, and the hash of the text."""
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(text_col, F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = pc.utf8_length(b.column(2)).to_pylist()
            texts = b.column(2).cast(pa.binary()).to_pylist()
            masks = [text_failures(t, n) for t, n in zip(texts, points)]
            keys = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), "<i8").reshape(-1, 2)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=["id", "part", "mask", "k1", "k2"])

    return own.mapInArrow(work, f"id {own.schema['id'].dataType.simpleString()}, part string, mask int, k1 long, k2 long")


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask) for each row: bit k of the mask is set if it fails the k-th of FILTERS."""
    judged = cut(_texts_judged(docs, id_col, text_col, part_col), "filter-texts")
    repeated = cut(judged.groupBy("k1", "k2").agg(F.min("id").alias("least"), F.count("*").alias("n")).filter("n > 1"), "filter-repeated")
    copied = F.when(F.col("id") > F.col("least"), 1 << FILTERS.index("E")).otherwise(0)
    return join_counted(judged, repeated, ["k1", "k2"]).select("id", "part", F.col("mask").bitwiseOR(copied).alias("mask"))


def _partial(b: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
    """The parts of counted rows (part, mask, good, toxic, n) in order, and (COUNTS, parts, CELLS): what these rows add to each."""
    part = b.column(0).dictionary_encode()
    codes, parts = part.indices.to_numpy(), len(part.dictionary)
    mask, good, toxic, n = (b.column(k).to_numpy().astype(np.int64) for k in range(1, 5))
    place = (codes[:, None] * len(ORDERS) + np.arange(len(ORDERS))) * (STEPS + 1) + FIRST[mask]

    def removals(weights: np.ndarray) -> np.ndarray:
        found = np.bincount(place.ravel(), np.repeat(weights, len(ORDERS)), parts * len(ORDERS) * (STEPS + 1))
        return found.reshape(parts, len(ORDERS), STEPS + 1)[:, :, :STEPS]

    def each(holds: Callable[[int], np.ndarray]) -> np.ndarray:
        """Counts by part of the rows that hold for a filter's bit, at the cells of that filter."""
        by_filter = np.stack([np.bincount(codes, n * holds(1 << k), parts) for k in range(STEPS)], axis=1)
        return by_filter[:, np.log2(_BITS).astype(int)]

    total = np.broadcast_to(np.bincount(codes, n, parts)[:, None, None], (parts, len(ORDERS), STEPS))
    found = [total, each(lambda bit: mask & bit > 0), removals(n), each(lambda bit: mask == bit), removals(n * good), removals(n * toxic)]
    return part.dictionary.to_pylist(), np.stack([f.reshape(parts, CELLS) for f in found]).astype(np.int64)


def _cells(counted: DataFrame) -> DataFrame:
    """(part, COUNTS as arrays of CELLS numbers) of counted rows (part, mask, good, toxic, n). A part's rows, 128 at most, are read one after another; the partial arrays of
    the slices that they are in are added up."""

    def batch(part: str, sums: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([part]), *[pa.array([row], pa.list_(pa.int64())) for row in sums]], names=["part", *COUNTS])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, None
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                parts, partial = _partial(b.slice(at, SLICE_ROWS))
                for k, part in enumerate(parts):
                    if part == held:
                        sums = sums + partial[:, k]
                    else:
                        if held is not None:
                            yield batch(held, sums)
                        held, sums = part, partial[:, k]
        if held is not None:
            yield batch(held, sums)

    rows = counted.select("part", "mask", "good", "toxic", "n").repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(work, "part string, " + ", ".join(f"{c} array<long>" for c in COUNTS))


def interactions(failed: DataFrame, labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for each part of ``failed``: (id, part,
    mask), order of FILTERS and step. labels: (label_id, quality, toxic)."""
    known = labels.groupBy(F.col(label_id).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = failed.join(known, "id", "left").select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    counted = marked.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    cells = _cells(counted).select("part", F.posexplode(F.arrays_zip(*COUNTS)).alias("cell", "x")).select("part", "cell", "x.*")
    order = F.get(F.lit(ORDERS), F.floor(F.col("cell") / STEPS).cast("int"))
    named = cells.withColumns({"filter_order": order, "step": (F.col("cell") % STEPS + 1).cast("int")})
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    own = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return named.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed", (F.col("failed") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", F.sum("removed").over(own).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(failures(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (SELECT doc_id, part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
counted AS (SELECT part, mask, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic, count(*) AS n FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS c, (SELECT bit FROM x WHERE x.c = substr(filter_order, step, 1)) AS bit FROM orders, (SELECT unnest(range(1, 6)) AS step)),
placed AS (SELECT *, coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS before FROM steps),
r AS (SELECT part, filter_order, step, c, sum(n) FILTER (mask & (before + bit) = 0) AS kept, sum(n) FILTER (mask & bit > 0 AND mask & before = 0) AS removed,
    sum(n) FILTER (mask & bit > 0 AND mask & before > 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
    sum(n) FILTER (mask & bit > 0 AND mask & before = 0 AND good = 1) AS good_lost, sum(n) FILTER (mask & bit > 0 AND mask & before = 0 AND toxic = 1) AS toxic_lost
    FROM counted, placed GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    coalesce(sum(removed) OVER (PARTITION BY part, c), 0)::BIGINT AS shapley FROM r"""
