"""SimHash near-duplicates by an inverted index over the bytes of fingerprints.

``near_duplicates``: two 64-bit fingerprints that differ in at most DISTANCE = 2 bits differ in at most two of their eight
bytes, so they agree in at least six byte positions. The index's postings hold four
positional bytes each: two of the four pairs of neighbouring bytes, six combinations
a fingerprint. Two differing bytes touch at most two pairs, so a linked pair meets in
at least one posting, while unrelated fingerprints rarely do (one posting of a single positional byte would
hold every 256th fingerprint, and its pairs would grow with the square of the input). A posting vouches for four
bytes of each pair that meets in it; the other four are tallied, pairs that share fewer than six in all are dropped, and the rest are verified bit
by bit. All that happens within the join, which emits verified links alone.

``near_copies``: texts whose five-word shingles have a Jaccard similarity of 0.8 differ in about 15 % of the bits of any
SimHash of them, ten of 64, which no guarantee on eight bytes covers. So fingerprints have WIDE_BYTES bytes here, of distinct
shingles of WIDE_SHINGLE words, of which a scattered edit touches fewer. The index has WIDE_KEYS postings a fingerprint, each of
three positional bytes; pairs that meet share 6 of the 64 bytes at least (a pair right at 0.8 shares 17 on average,
unrelated ones a quarter of one) and are then verified by the exact Jaccard similarity of their five-word shingles.

In both a posting's members are compared with one pivot first, its least node, and merged; then those that still are in different
components are compared with each other, dealt out in blocks, so a crowded posting is neither cut off nor expanded in one task. Equal fingerprints are
one node from the start, so copies cost nothing here. Components come from the distributed union-find.

Edge cases: null and empty texts, and texts without words, have fingerprint zero and are linked like any
other; fewer words than a shingle has are one shingle. Rows that repeat a doc_id are fingerprinted each, and are linked by their fingerprints
alone, not by the id. Rows with a null doc_id have a fingerprint and belong to its component, but never name it; where
no other row has that component, component_id is null.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, join_counted, table
from .components import components

SEED = 42
DISTANCE = 2
#: Members of one posting that a task compares with the others at a time.
BLOCK = 4096
_PAIR_BYTES = tuple(0xFFFF << 16 * k for k in range(4))
#: Masks of the six postings: two of the four pairs of neighbouring bytes.
MASKS = tuple(a | b for a, b in combinations(_PAIR_BYTES, 2))
#: Wide fingerprints: their bytes, words of a shingle, postings of each, bytes of a posting, and bytes that a pair shares at least.
WIDE_BYTES = 64
WIDE_SHINGLE = 3
WIDE_KEYS = 256
KEY_BYTES = 3
WIDE_SHARED = 6
_WIDE_WORDS = WIDE_BYTES // 8
#: Every eighth bit of a word; so many rows can be added before a lane of eight bits overflows.
_LANES = np.uint64(0x0101010101010101)
_LANE_ROWS = 255
WIDE = [f"w{k}" for k in range(_WIDE_WORDS)]


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """The unsigned 64-bit hashes of a text's word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    of = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([of(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.array([of(joined[i:j], SEED) for i, j in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())], np.uint64)


def _ones(rows: np.ndarray) -> np.ndarray:
    """(words, 64) from (words, n) unsigned 64-bit numbers: how many have each bit set."""
    total = np.zeros((len(rows), 64), np.int64)
    starts = np.arange(0, rows.shape[1], _LANE_ROWS)
    for shift in range(8):
        lanes = np.add.reduceat((rows >> np.uint64(shift)) & _LANES, starts, axis=1)
        total[:, shift::8] += lanes.astype("<u8").view(np.uint8).reshape(len(rows), len(starts), 8).sum(axis=1, dtype=np.int64)
    return total


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")[..., 0]


def fingerprint(text: str | None, width: int) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles."""
    h = shingle_hashes(text, width)
    return int(_packed(2 * _ones(h[None, :])[0] > len(h))) if len(h) else 0


def _spread(h: np.ndarray) -> np.ndarray:
    """(_WIDE_WORDS, n): further hashes of each hash, by the finaliser of the SplitMix generator."""
    x = h[None, :] + (np.arange(_WIDE_WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(text: str | None, width: int) -> np.ndarray:
    """A SimHash of _WIDE_WORDS unsigned 64-bit words, of the distinct shingles, as likeness is of sets. Where the number of shingles is even the whole text has
    a vote of its own, so that no bit is tied."""
    h = np.unique(shingle_hashes(text, width))
    if not len(h):
        return np.zeros(_WIDE_WORDS, np.uint64)
    if len(h) % 2 == 0:
        h = np.append(h, np.uint64(xxhash.xxh64_intdigest(h.tobytes(), SEED)))
    ones = np.zeros((_WIDE_WORDS, 64), np.int64)
    for k in range(0, len(h), 1 << 14):  # so a very long text takes no more memory than its hashes
        ones += _ones(_spread(h[k : k + (1 << 14)]))
    return _packed(2 * ones > len(h))


def with_fingerprint(df: DataFrame, text_col: str, width: int, name: str = "fp") -> DataFrame:
    """(all columns but the text, ``name``): the fingerprint as a signed long with the same bits."""
    return _with_words(df, text_col, [name], lambda text: np.array([fingerprint(text, width)], np.uint64))


def with_wide_fingerprint(df: DataFrame, text_col: str, width: int) -> DataFrame:
    """(all columns but the text, w0, w1, ...): the words of the wide fingerprint as signed longs."""
    return _with_words(df, text_col, WIDE, lambda text: wide_fingerprint(text, width))


def _with_words(df: DataFrame, text_col: str, names: list[str], of: Callable[[str | None], np.ndarray]) -> DataFrame:
    rest = [c for c in df.columns if c != text_col and c not in names]
    picked = df.select(text_col, *rest)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                got = np.stack([of(t.as_py()) for t in b.column(0)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns[1:], *map(pa.array, got.T)], names=[*rest, *names])

    fields = picked.schema.fields[1:]
    return picked.mapInArrow(work, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"`{n}` long" for n in names)]))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shared_bytes(a: str, b: str, words: list[str]) -> Column:
    """In how many byte positions two fingerprints, structs ``a`` and ``b`` of long ``words``, agree."""
    same = []
    for w in words:
        x = F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))
        same += [F.when(x.bitwiseAND(F.lit(_signed(0xFF << 8 * k))) == 0, 1).otherwise(0) for k in range(8)]
    return sum(same[1:], same[0])


def close(a: str, b: str) -> Column:
    """Whether two 64-bit fingerprints share enough bytes and are at most DISTANCE bits apart."""
    return (shared_bytes(a, b, ["fp"]) >= 8 - DISTANCE) & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= DISTANCE)


def met_by(postings: DataFrame, name: str) -> DataFrame:
    """(key, node, pivot): the postings (key, node) of more than one node, and the least node of each. They are
    dealt out by key once."""
    dealt = postings.repartition("key")
    shared = dealt.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).filter("pivot <> last").select("key", "pivot")
    # by a hash table of a partition's shared postings, one row each however many nodes are in it: the many lone ones need no sort
    return cut(dealt.join(shared.hint("shuffle_hash"), "key"), name)


def open_members(met: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (key, node, root) besides the pivots of postings in which they are in different components, and those postings (key, blocks)."""
    own = met.filter("node <> pivot").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    own = cut(own, "open-members")
    sizes = own.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return own, cut(sizes.filter("lo <> hi").select("key", "blocks"), "open-postings")


def in_blocks(left: DataFrame, like: Column) -> DataFrame:
    """Links (a, b) among the members of each posting that are in different components and meet ``like``. left: (key, blocks, node, root, x);
    one side is dealt out in blocks, the other goes to all of them. ``like`` compares columns p.x and q.x."""
    one = left.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("blocks")
    all_ = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    p = one.select("key", "block", F.struct("node", "root", "x").alias("p"))
    q = all_.select("key", "block", F.struct("node", "root", "x").alias("q"))
    found = p.join(q, ["key", "block"]).filter((F.col("p.root") < F.col("q.root")) & like)
    return found.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()


def merged(roots: DataFrame, more: DataFrame) -> DataFrame:
    return roots if more.isEmpty() else components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def close_components(nodes: DataFrame) -> DataFrame:
    """(node, root) of fingerprints that are linked to smaller ones; nodes: (node), distinct signed fingerprints."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("node").bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(MASKS)])
    met = met_by(nodes.select("node", F.explode(keys).alias("key")), "postings")
    firsts = met.filter("node <> pivot").select(F.struct(F.col("node").alias("fp")).alias("p"), F.struct(F.col("pivot").alias("fp")).alias("q"))
    roots = components(firsts.filter(close("p", "q")).select(F.col("p.fp").alias("a"), F.col("q.fp").alias("b")))
    own, open_ = open_members(met, roots)
    if open_.isEmpty():
        return roots
    left = own.join(open_, "key").withColumn("x", F.struct(F.col("node").alias("fp")))
    return merged(roots, cut(in_blocks(left, close("p.x", "q.x")), "more-links"))


def near_duplicates(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for each row of ``docs``; fp is the signed fingerprint."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = cut(with_fingerprint(own, "text", width), "fingerprints")
    nodes = cut(marked.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("rows")), "fingerprint-nodes")
    roots = close_components(nodes.select(F.col("fp").alias("node")))
    grouped = cut(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "id", "rows", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    named = grouped.groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    found = cut(join_counted(grouped, named, ["root"]).select("fp", F.col("rows").alias("n"), "component_id"), "fingerprint-components")
    return join_counted(marked, found, ["fp"]).select(F.col("id").alias(id_col), "fp", "component_id")


def wide_postings(nodes: DataFrame) -> DataFrame:
    """(key, node): the postings of nodes (node, w0, w1, ...); a key is its number and KEY_BYTES positional bytes."""
    rng = random.Random(SEED)
    places = np.array([sorted(rng.sample(range(WIDE_BYTES), KEY_BYTES)) for _ in range(WIDE_KEYS)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.column_stack([c.to_numpy() for c in b.columns[1:]]).astype("<i8").view(np.uint8)
            keys = np.arange(len(places), dtype=np.int64)[None, :].repeat(len(fp), axis=0)
            for k in range(KEY_BYTES):
                keys = (keys << 8) | fp[:, places[:, k]]
            offsets = pa.array(np.arange(len(fp) + 1, dtype=np.int32) * len(places))
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], names=["node", "keys"])

    return nodes.select("node", *WIDE).mapInArrow(work, "node long, keys array<long>").select(F.explode("keys").alias("key"), "node")


def shingle_sets(df: DataFrame, text_col: str, width: int) -> DataFrame:
    """(all columns but the text, shingles): 64-bit hashes of each text's distinct shingles."""
    rest = [c for c in df.columns if c != text_col]
    picked = df.select(text_col, *rest)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.unique(shingle_hashes(t.as_py(), width)).view(np.int64) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(got, pa.list_(pa.int64()))], names=[*rest, "shingles"])

    return picked.mapInArrow(work, T.StructType([*picked.schema.fields[1:], T.StructField("shingles", T.ArrayType(T.LongType()))]))


def alike(x: Column, y: Column, similarity: float) -> Column:
    """Whether two shingle sets are alike; their sizes are looked at first."""
    both = F.size(F.array_intersect(x, y))
    sized = F.least(F.size(x), F.size(y)) >= F.lit(similarity) * F.greatest(F.size(x), F.size(y))
    return sized & (both >= F.lit(similarity) * (F.size(x) + F.size(y) - both))


def wide_components(nodes: DataFrame, texts: DataFrame, similarity: float, width: int) -> DataFrame:
    """(node, root) of nodes that are linked to smaller ones. nodes: (node, w0, w1, ..., id, th), fingerprints distinct; texts: (id, th, text)."""
    met = met_by(wide_postings(nodes), "near-postings")
    words = nodes.select("node", F.struct(*WIDE).alias("w"))
    pairs = met.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    tallied = pairs.join(words.select(F.col("node").alias("a"), F.col("w").alias("p")), "a").join(words.select(F.col("node").alias("b"), F.col("w").alias("q")), "b")
    pairs = cut(tallied.filter(shared_bytes("p", "q", WIDE) >= WIDE_SHARED).select("a", "b"), "near-pairs")
    roots = components(_verified(pairs, nodes, texts, similarity, width))
    own, open_ = open_members(met, roots)
    if open_.isEmpty():
        return roots
    # the pairs that share enough bytes are found within the join; only their texts are asked for
    left = own.join(open_, "key").join(words, "node").withColumnRenamed("w", "x")
    more = cut(in_blocks(left, shared_bytes("p.x", "q.x", WIDE) >= WIDE_SHARED), "more-pairs")
    return merged(roots, _verified(more, nodes, texts, similarity, width))


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float, width: int) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets are alike, all of them compared."""
    asked = nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi").select("node", F.col("id").alias("i"), F.col("th").alias("t"))
    own = texts.join(asked, F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t"))).select("node", "text")
    sets = cut(shingle_sets(own, "text", width).dropDuplicates(["node"]), "near-sets")
    x, y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return cut(pairs.join(x, "a").join(y, "b").filter(alike(F.col("x"), F.col("y"), similarity)).select("a", "b"), "near-links")


def near_copies(docs: DataFrame, similarity: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, component_id, first) for each row of ``docs``: texts whose shingles of ``width`` words have this similarity are
    linked. th is the hash of the text; first says whether the row is the one its component is named by (lowest id, then th)."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    marked = cut(with_wide_fingerprint(texts, "text", WIDE_SHINGLE), "fingerprints")
    place = F.struct(F.col("id").isNull().alias("late"), "id", "th")
    nodes = marked.groupBy(*WIDE).agg(F.min(place).alias("place"), F.count("*").alias("rows")).select(*WIDE, "rows", "place.id", "place.th")
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    roots = wide_components(nodes, texts, similarity, width)
    grouped = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = grouped.groupBy("root").agg(F.min(place).alias("best"))
    found = cut(grouped.join(named, "root").select(*WIDE, F.col("rows").alias("n"), "best"), "near-components")
    same = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("th") == F.col("best.th"))
    return join_counted(marked, found, WIDE).select(F.col("id").alias(id_col), "th", F.col("best.id").alias("component_id"), same.alias("first"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
