"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A signature has SLOTS minimum hashes of a text's distinct word shingles, BITS = 8 bits of each. Two texts of similarity s differ in a
slot with a probability near 1 - s, and the distance of two signatures is the number of slots in which they differ. A signature is split into
CHUNKS chunks. Two signatures at a distance of at most DISTANCE = 2 * CHUNKS - 1 have, by pigeonhole, a chunk in which they differ in one slot at most.
All allowed errors of a chunk are enumerated: each of its slots is masked in turn, which makes SLOTS keys a text of five slots each. So
all pairs within DISTANCE meet in a key, and others often do: a pair right at 0.8 misses all keys with a probability near 0.0002
(each of 8 chunks holds two errors or more, 0.345 each). Pairs that meet are compared by size, by signature (at most FAR slots apart, which a pair
right at 0.8 exceeds with a probability of about one in a million), and then by their full sets, in whole numbers.

Equal sets are one node from the start. A key's nodes are compared with its pivot, the node of smallest number, and merged by the distributed
union-find, and then with two more pivots where they still are in different components. Those that are still apart after that are compared with each other in blocks: the
intersections of all pairs of two blocks are counted at once, and only links that join components leave the tasks. A crowded key is neither cut off nor expanded into its pairs.

Edge cases: a text of fewer words than a shingle has is one shingle; null texts and texts without words have an empty set and are linked with nothing. Rows
that repeat a doc_id are judged each, linked by their sets alone. Rows with a null doc_id belong to a component but never name it; where no other row has
that component, component_id is null and kept is false. Other columns may have any names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, join_counted, table
from .components import components
from .simhash import merged, met_by, open_members, shared_bytes, shingle_hashes, shingle_sets

SEED = 42
SLOTS = 48
CHUNKS = 8
CHUNK_SLOTS = SLOTS // CHUNKS
BITS = 8
#: Slots in which two signatures may differ that are sure to meet, and in which those may that are compared in full.
DISTANCE = 2 * CHUNKS - 1
FAR = 24
WORDS = [f"w{k}" for k in range(SLOTS // 8)]
#: Members and shingles of a block of a key's members, in the mean; two blocks are in a task's memory at a time.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 21
#: Shingles of the keys of one block that are one group, in the mean: most keys are small, and a group has a cost of its own.
PACK_SHINGLES = 1 << 18
#: Hashes whose members are multiplied at a time.
COLUMNS = 1024
#: Shingles hashed at a time, so that a very long text takes no more memory than its hashes.
STRETCH = 1 << 13

#: Orders by which a key's further pivots are chosen, after the one of smallest number.
ROUNDS = [lambda: -F.col("node"), lambda: F.xxhash64("node")]

_RANDOM = random.Random(SEED)
_FACTORS = np.array([_RANDOM.getrandbits(64) | 1 for _ in range(SLOTS)], np.uint64)
_FINISH = np.uint64(0x9E3779B97F4A7C15)
#: The slots of each key: a chunk without one of its slots.
KEYS = [[c * CHUNK_SLOTS + k for k in range(CHUNK_SLOTS) if k != masked] for c in range(CHUNKS) for masked in range(CHUNK_SLOTS)]


def signature(hashes: np.ndarray) -> np.ndarray:
    """SLOTS bytes: bits of the minimum of the hashes in SLOTS orders."""
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), STRETCH):
        least = np.minimum(least, (hashes[None, k : k + STRETCH] * _FACTORS[:, None]).min(axis=1))
    return ((least * _FINISH) >> np.uint64(64 - BITS)).astype(np.uint8)


def with_signature(docs: DataFrame, width: int) -> DataFrame:
    """(id, th, n, d1, d2, w0, w1, ...): the size of each text's shingle set, 128 bits of its hash, and the signature. docs: (id, th, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, digests, signatures = [], [], []
            for t in b.column(2):
                h = np.unique(shingle_hashes(t.as_py(), width))
                sizes.append(len(h))
                digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                signatures.append(signature(h))
            d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            w = np.concatenate([*signatures, np.zeros(0, np.uint8)]).reshape(-1, SLOTS).view("<i8")
            yield pa.record_batch([b.column(0), b.column(1), pa.array(sizes, pa.int64()), *map(pa.array, d.T), *map(pa.array, w.T)], names=["id", "th", "n", "d1", "d2", *WORDS])

    return docs.select("id", "th", "text").mapInArrow(work, f"id {docs.schema['id'].dataType.simpleString()}, th long, n long, d1 long, d2 long, " + ", ".join(f"{w} long" for w in WORDS))


def postings(nodes: DataFrame) -> DataFrame:
    """(key, node): the keys of nodes (node, w0, w1, ...); a key is its number and the bytes of its slots."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.column_stack([c.to_numpy() for c in b.columns[1:]]).astype("<i8").view(np.uint8)
            keys = np.repeat(np.arange(len(KEYS), dtype=np.int64)[None, :], len(sig), axis=0)
            for k in range(CHUNK_SLOTS - 1):
                keys = (keys << BITS) | sig[:, [key[k] for key in KEYS]]
            offsets = pa.array(np.arange(len(sig) + 1, dtype=np.int32) * len(KEYS))
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], names=["node", "keys"])

    return nodes.select("node", *WORDS).mapInArrow(work, "node long, keys array<long>").select(F.explode("keys").alias("key"), "node")


def _may(x: str, y: str, percent: int) -> Column:
    """Whether the sizes and signatures of two nodes, structs (size, w0, w1, ...), allow that they are alike."""
    sized = F.least(F.col(f"{x}.size"), F.col(f"{y}.size")) * 100 >= F.greatest(F.col(f"{x}.size"), F.col(f"{y}.size")) * percent
    return sized & (shared_bytes(x, y, WORDS) >= SLOTS - FAR)


def _alike(x: Column, y: Column, percent: int) -> Column:
    """100 * both >= percent * (x + y - both), written so that the intersection is made once: a join's condition would make it twice."""
    return F.size(F.array_intersect(x, y)) * (100 + percent) >= (F.size(x) + F.size(y)) * percent


def _verified(pairs: DataFrame, marks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets are alike; marks: (node, x), x as ``_may`` takes it; sets: (node, shingles)."""
    near = pairs.join(marks.select(F.col("node").alias("a"), F.col("x").alias("p")), "a").join(marks.select(F.col("node").alias("b"), F.col("x").alias("q")), "b")
    near = cut(near.filter(_may("p", "q", percent)).select("a", "b"), "minhash-pairs")
    x, y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return cut(near.join(x, "a").join(y, "b").filter(_alike(F.col("x"), F.col("y"), percent)).select("a", "b"), "minhash-links")


def _with_roots(met: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, root): the members of each key and the root of the component that they are in so far."""
    return met.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))


def _apart(met: DataFrame, roots: DataFrame, order: Column) -> DataFrame:
    """(a, b): each member of a key, and the one that is first in ``order``, where they are in different components."""
    own = _with_roots(met, roots)
    first = own.groupBy("key").agg(F.min_by(F.struct("node", "root"), order).alias("first"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key", "first")
    return own.join(first, "key").filter("root <> first.root").select(F.col("node").alias("a"), F.col("first.node").alias("b")).distinct()


def alike_matrix(one: np.ndarray, other: np.ndarray, values: np.ndarray, offsets: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets ``one`` and ``other`` (numbers of sets) are alike, for all pairs; set k is values[offsets[k]:offsets[k + 1]], each value once.
    Intersections are counted as products of the 0/1 matrices of members and hashes, COLUMNS hashes at a time."""
    sizes = np.diff(offsets)
    rows, (codes, seen) = np.repeat(np.arange(len(sizes)), sizes), pd.factorize(values)
    shared = np.bincount(codes, minlength=len(seen)) > 1  # a hash that one member has alone is in no intersection
    keep = shared[codes]
    rows, column = rows[keep], (np.cumsum(shared) - 1)[codes[keep]]
    order = np.argsort(column // COLUMNS, kind="stable")
    rows, column = rows[order], column[order]
    ends = np.searchsorted(column // COLUMNS, np.arange(shared.sum() // COLUMNS + 2))
    both = np.zeros((len(one), len(other)), np.float32)  # whole numbers below 2 ** 24 are exact
    for i, j in zip(ends[:-1], ends[1:]):
        held = np.zeros((len(sizes), COLUMNS), np.float32)
        held[rows[i:j], column[i:j] % COLUMNS] = 1
        both += held[one] @ held[other].T
    return both.astype(np.int64) * (100 + percent) >= (sizes[one][:, None] + sizes[other][None, :]) * percent


def forest(like: np.ndarray, one: np.ndarray, other: np.ndarray, roots: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of members that join all components which alike pairs join: one fewer than components joined, however many pairs are alike.
    like: whether members ``one`` and ``other`` are alike; roots: the component of each member."""
    like = like & (roots[one][:, None] != roots[other][None, :])
    rows, columns = like.any(axis=1), like.any(axis=0)
    like, one, other = like[rows][:, columns], one[rows], other[columns]
    members = np.unique(np.concatenate([one, other]))
    links, unseen = [], np.zeros(len(roots), bool)
    unseen[members] = True
    for start in members.tolist():
        todo = members[unseen[members] & (roots[members] == roots[start])].tolist()
        unseen[todo] = False
        while todo:
            x = todo.pop()
            near = np.concatenate([other[like[one == x].any(axis=0)], one[like[:, other == x].any(axis=1)]])
            near = near[unseen[near]]
            for y in near[np.unique(roots[near], return_index=True)[1]].tolist():
                links.append((x, y))
                more = members[unseen[members] & (roots[members] == roots[y])].tolist()
                unseen[more] = False
                todo += more
    return links


def _in_blocks(met: DataFrame, roots: DataFrame, marks: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links (a, b) that join the components of alike members of one key; None if no key has members in different components. A key's members are dealt
    out in blocks bounded by members and by shingles, and each two blocks are compared in one group, by their full sets; keys of one block share groups.
    A group gives at most one link a component, so no crowded key is expanded into its pairs."""
    own, open_ = open_members(met, roots)
    if open_.isEmpty():
        return None
    own = own.join(open_.select("key"), "key").join(marks.select("node", F.col("x.size").alias("size")), "node")
    own = cut(own, "minhash-open")
    dealt = own.groupBy("key").agg(F.sum("size").alias("shingles"), F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = cut(dealt, "minhash-open-keys")
    packs = 1 + (dealt.filter("blocks = 1").agg(F.sum("shingles")).first()[0] or 0) // PACK_SHINGLES
    pack = F.when(F.col("blocks") == 1, -1 - F.pmod(F.xxhash64("key"), F.lit(packs))).otherwise(F.col("key"))  # no key is negative
    block, with_ = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = own.join(dealt.select("key", "blocks", pack.alias("pack")), "key").select("key", "pack", "node", "root", block.alias("block"), with_.alias("with")).join(sets, "node")

    def work(group: pa.Table) -> pa.Table:
        group = group.sort_by("key").combine_chunks()
        keys, nodes, roots, blocks = (group[c].to_numpy() for c in ("key", "node", "root", "block"))
        sets = pa.concat_arrays(group["shingles"].chunks)
        values, offsets = sets.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sets.value_lengths().to_numpy())))
        starts, found = np.flatnonzero(np.diff(keys, prepend=-1)), []
        for i, j in zip(starts, [*starts[1:], len(keys)]):
            one, other = (np.flatnonzero(blocks[i:j] == x) for x in (blocks[i:j].min(), blocks[i:j].max()))
            like = alike_matrix(one, other, values[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], percent)
            found += [sorted((nodes[i + x], nodes[i + y])) for x, y in forest(like, one, other, roots[i:j])]
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    groups = left.groupBy("pack", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"))
    return cut(groups.applyInArrow(work, "a long, b long").distinct(), "minhash-links")


def alike_nodes(nodes: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """(node, root) of nodes that are linked to smaller ones. nodes: (node, size, w0, w1, ..., id, th), sets distinct; texts: (id, th, text)."""
    met = met_by(postings(nodes), "minhash-postings")
    asked = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", F.col("id").alias("i"), F.col("th").alias("t"))
    own = texts.join(asked, F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t"))).select("node", "text")
    sets = cut(shingle_sets(own, "text", width).dropDuplicates(["node"]), "minhash-sets")
    marks = nodes.select("node", F.struct("size", *WORDS).alias("x"))
    pairs = met.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    links = _verified(pairs, marks, sets, percent)
    roots = components(links)
    for order in ROUNDS:
        more = _verified(_apart(met, roots, order()), marks, sets, percent)
        roots = merged(roots, more)
    more = _in_blocks(met, roots, marks, sets, percent)
    return roots if more is None else merged(roots, more)


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``. Texts are linked whose distinct shingles of ``width`` words share ``percent`` percent
    of their union; component_id is the smallest id that links lead to, and the row that has it is kept."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    marked = cut(with_signature(texts, width), "minhash-signatures")
    place = F.struct(F.col("id").isNull().alias("late"), "id", "th")
    filled = marked.filter("n > 0")
    nodes = filled.groupBy("d1", "d2").agg(F.min(place).alias("place"), F.count("*").alias("rows"), F.first("n").alias("size"), *[F.first(w).alias(w) for w in WORDS])
    nodes = cut(nodes.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "rows", "size", *WORDS, "place.id", "place.th"), "minhash-nodes")
    roots = alike_nodes(nodes, texts, percent, width)
    grouped = nodes.join(roots, "node", "left").select("d1", "d2", "rows", "id", F.coalesce("root", "node").alias("root"))
    named = grouped.groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    found = cut(join_counted(grouped, named, ["root"]).select("d1", "d2", F.col("rows").alias("n"), "component_id"), "minhash-components")
    rows = join_counted(filled.select("id", F.col("n").alias("size"), "d1", "d2"), found, ["d1", "d2"]).select("id", "size", "component_id")
    rows = rows.unionByName(marked.filter("n = 0").select("id", F.col("n").alias("size"), F.col("id").alias("component_id")))
    return rows.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 80, 4)


OP12_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest([array_to_string(words[i:i + 3], ' ') FOR i IN range(1, greatest(1, len(words) - 3) + 1)]) AS shingle FROM w WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN sizes USING (doc_id)"""
