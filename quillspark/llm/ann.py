"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample (SAMPLE_ROWS vectors, lowest hashes of the id first) by
splitting nodes with spherical k-means until they hold LEAF_ROWS of the sample. Every vector is then filed in the leaf
that it reaches from the root. A leaf that more than LEAF_LIMIT vectors reach is split further in the tasks, by a tree fitted on
about SAMPLE_ROWS of its own vectors, until none is (copies of one vector excepted), so leaves do not grow with the table; only the vectors of split leaves are filed anew. What does grow is the
tree, by a centre for some thousand vectors: it must fit into the driver and every task. A query walks the tree best bin first: a priority queue
holds the branches not taken, and the most similar one is opened next, until enough leaves
are visited. How many are enough is calibrated on the sample: visits are
widened until queries from the sample find TARGET_RECALL of their true neighbours in it. A query goes on beyond
that until its leaves hold k + 1 vectors.

Leaves and the queries that visit them meet by leaf. A crowded leaf is split into blocks of vectors and of
queries, so a vector that very many rows repeat is spread over tasks. Each block keeps each query's best; ties are broken
by the smaller id everywhere, and the final scores are cosines in double precision of the original vectors.

Edge cases: vectors that are null, zero, hold null or non-finite components, have no id or another length than most of the
sample take no part. The query's own id is never its neighbour. Fewer candidates than k: all that are found. Queries that
repeat an id count once (the smallest vector by its bytes); candidates that repeat one are listed each.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Vectors that the tree is fitted on, children of a node, sampled vectors in a leaf.
SAMPLE_ROWS = 16_384
BRANCHES = 16
LEAF_ROWS = 64
#: Vectors of the whole table beyond which a leaf is split, and rounds of such splits.
LEAF_LIMIT = 16_384
SPLITS = 8
ROUNDS = 12
#: Recall that visits are widened to on the sample, and queries that it is measured with.
TARGET_RECALL = 0.98
CALIBRATION_QUERIES = 256
#: Vectors and queries in one block of a leaf.
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 512
#: Leaves (24 bytes each) whose blocks are broadcast at most; beyond, they are joined by a shuffle.
BROADCAST_LEAVES = 1_000_000
#: Candidates beyond k that are scored exactly for every query; where more are nearly tied all of them are.
SPARE = 8


class Tree:
    """children[i]: the child nodes of node i, empty for leaves; centers: a unit vector for each node."""

    def __init__(self, centers: np.ndarray, children: list[list[int]]):
        self.centers = centers
        self.children = children

    def file(self, units: np.ndarray, start: int = 0) -> np.ndarray:
        """The leaf that each vector reaches from the root, or from the node ``start``."""
        node = np.full(len(units), start, np.int64)
        todo = [start]
        while todo:
            i = todo.pop()
            kids = self.children[i]
            if kids:
                at = np.flatnonzero(node == i)
                if len(at):
                    node[at] = np.array(kids)[np.argmax(units[at] @ self.centers[kids].T, axis=1)]
                todo += kids
        return node

    def graft(self, leaf: int, centers: np.ndarray, children: list[list[int]]) -> None:
        """Hang another tree's nodes, all but its root, under a leaf."""
        base = len(self.centers) - 1  # its node n becomes base + n
        self.centers = np.concatenate([self.centers, centers[1:]])
        self.children[leaf] = [base + c for c in children[0]]
        self.children += [[base + c for c in kids] for kids in children[1:]]

    def walk(self, unit: np.ndarray) -> Iterator[int]:
        """Leaves in the order of a best-bin-first traversal."""
        queue = [(-2.0, 0)]
        while queue:
            _, i = heapq.heappop(queue)
            while kids := self.children[i]:
                near = self.centers[kids] @ unit
                best = int(np.argmax(near))
                for k, child in enumerate(kids):
                    if k != best:
                        heapq.heappush(queue, (-float(near[k]), child))
                i = kids[best]
            yield i


def _kmeans(units: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Cluster numbers by spherical k-means from distinct starting points."""
    starts = np.unique(units, axis=0)
    centers = starts[rng.permutation(len(starts))[:k]]
    for _ in range(ROUNDS):
        own = np.argmax(units @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, units)
        norms = np.linalg.norm(sums, axis=1)
        centers = np.where(norms[:, None] > 1e-12, sums / np.maximum(norms, 1e-12)[:, None], centers)
    return np.argmax(units @ centers.T, axis=1)


def fit_tree(units: np.ndarray, seed: int = 7, leaf_rows: int | None = None) -> Tree:
    most = leaf_rows or LEAF_ROWS
    rng = np.random.default_rng(seed)
    centers, children, todo = [np.zeros(units.shape[1])], [[]], [(0, np.arange(len(units)))]
    while todo:
        i, rows = todo.pop()
        if len(rows) <= most:
            continue
        own = _kmeans(units[rows], min(BRANCHES, 1 + len(rows) // most), rng)
        parts = [rows[own == c] for c in np.unique(own)]
        if len(parts) < 2:
            continue  # copies of one vector
        for part in parts:
            mean = units[part].sum(axis=0)
            centers.append(mean / max(np.linalg.norm(mean), 1e-12))
            children.append([])
            children[i].append(len(centers) - 1)
            todo.append((len(centers) - 1, part))
    return Tree(np.array(centers), children)


def calibrate(tree: Tree, units: np.ndarray, k: int, seed: int = 11) -> int:
    """Leaf visits after which queries from the sample find TARGET_RECALL of their k neighbours in it."""
    rng = np.random.default_rng(seed)
    queries = rng.permutation(len(units))[:CALIBRATION_QUERIES]
    leaf = tree.file(units)
    need = []
    for q in queries:
        near = units @ units[q]
        near[q] = -2
        top = np.argsort(-near, kind="stable")[:k]
        wanted, order = set(leaf[top].tolist()), {}
        for n, x in enumerate(tree.walk(units[q]), 1):  # no further than to the last of them
            if x in wanted:
                order[x] = n
                if len(order) == len(wanted):
                    break
        need += [order[leaf[t]] for t in top]
    visits = 1
    while np.mean(np.array(need) <= visits) < TARGET_RECALL:
        visits += 1
    return visits


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): ids and double arrays of the vectors that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(~bad & F.exists("vec", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scaled(m: np.ndarray) -> np.ndarray:
    """Rows times powers of two, largest components from 0.5 to 1: no square of them is too large or too small,
    and cosines are those of the vectors as they are."""
    return np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, keepdims=True))[1])


def _units(m: np.ndarray) -> np.ndarray:
    scaled = _scaled(m)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _best(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k nearest of one block. A matrix product finds who can be among them; their
    scores are then summed vector by vector, so equal vectors have equal scores whatever their block."""
    if not len(queries) or not len(vectors):
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    q = _scaled(np.frombuffer(b"".join(queries["vec"]), np.float64).reshape(len(queries), -1))
    v = _scaled(np.frombuffer(b"".join(vectors["vec"]), np.float64).reshape(len(vectors), -1))
    qn, vn = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    rough = (q @ v.T) / np.outer(qn, vn)
    qid, vid = queries["query_id"].to_numpy(), vectors["vec_id"].to_numpy()
    rough[qid[:, None] == vid[None, :]] = -np.inf
    m = min(len(v), k + SPARE)
    at = np.argpartition(-rough, m - 1, axis=1)[:, :m]
    kth = np.sort(np.take_along_axis(rough, at, axis=1), axis=1)[:, max(0, m - k)]
    crowded = (rough >= kth[:, None] - 1e-9).sum(axis=1) > m  # more near ties than there is room for: these queries look at all of them
    score = (v[at] * q[:, None, :]).sum(axis=2) / (qn[:, None] * vn[at])
    score[np.take_along_axis(rough, at, axis=1) == -np.inf] = -np.inf
    top = np.lexsort((vid[at], -score), axis=1)[:, :k]  # ties fall to the smaller id
    near, score = np.take_along_axis(vid[at], top, axis=1), np.take_along_axis(score, top, axis=1)
    good = (score > -np.inf) & ~crowded[:, None]
    parts = [(np.repeat(qid, good.sum(axis=1)), near[good], score[good])]
    for r in np.flatnonzero(crowded):
        some = np.flatnonzero((rough[r] >= kth[r] - 1e-9) & (rough[r] > -np.inf))
        own = (v[some] * q[r]).sum(axis=1) / (qn[r] * vn[some])
        best = np.lexsort((vid[some], -own))[:k]
        parts.append((np.full(len(best), qid[r]), vid[some][best], own[best]))
    return pd.DataFrame({name: np.concatenate(x) for name, x in zip(("query_id", "vec_id", "score"), zip(*parts))})


def _filer(tree: Tree):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(1))
                packed = pa.array([r.tobytes() for r in m], pa.binary())
                yield pa.record_batch([b.column(0), packed, pa.array(tree.file(_units(m)))], names=["vec_id", "vec", "leaf"])

    return work


def _refiler(tree: Tree):
    """Files vectors of leaves that have become nodes, from there on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                units = _units(np.frombuffer(b"".join(b.column(1).to_pylist()), np.float64).reshape(b.num_rows, -1))
                was = b.column(2).to_numpy()
                leaf = was.copy()
                for x in np.unique(was):
                    leaf[was == x] = tree.file(units[was == x], int(x))
                yield pa.record_batch([b.column(0), b.column(1), pa.array(leaf)], names=["vec_id", "vec", "leaf"])

    return work


def _leaf_counts(filed: DataFrame) -> dict[int, int]:
    """Vectors filed in each leaf; one row for each LEAF_ROWS to LEAF_LIMIT vectors, eight bytes of a vector's centre to a row."""
    return {r[0]: r[1] for r in filed.groupBy("leaf").count().collect()}


def _split(filed: DataFrame, over: dict[int, int]) -> list[tuple[int, np.ndarray, list[list[int]]]]:
    """A tree for each overfull leaf (leaf: vectors) whose vectors are not all alike, fitted in the tasks on about SAMPLE_ROWS
    vectors of the leaf, by hashes of their ids; its leaves hold LEAF_LIMIT / 4 of the leaf's vectors."""
    if not over:
        return []
    sizes = filed.sparkSession.createDataFrame(list(over.items()), "leaf long, n long")
    chosen = filed.join(F.broadcast(sizes), "leaf").filter(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("n")) < SAMPLE_ROWS)  # one row a leaf

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        units = _units(np.frombuffer(b"".join(rows["vec"]), np.float64).reshape(len(rows), -1))
        sub = fit_tree(units, leaf_rows=max(2, int(LEAF_LIMIT / 4 * len(units) / rows["n"].iloc[0])))
        return pd.DataFrame({"leaf": rows["leaf"].iloc[:1], "tree": [pickle.dumps((sub.centers, sub.children))]})

    found = chosen.groupBy("leaf").applyInPandas(fit, "leaf long, tree binary").orderBy("leaf").collect()  # trees of some hundred centres
    trees = [(r["leaf"], *pickle.loads(bytes(r["tree"]))) for r in found]
    return [x for x in trees if x[2][0]]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k nearest rows of ``vectors`` found by the tree."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    own = usable(vectors, id_col, vec_col)
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vec").toArrow()["vec"]
    lengths = np.array([len(x) for x in sample], np.int64)
    if not len(lengths):
        return spark.createDataFrame([], schema)
    size = int(np.bincount(lengths).argmax())
    units = _units(np.array([x.as_py() for x in sample if len(x) == size], np.float64))
    tree = fit_tree(units)
    own = own.filter(F.size("vec") == size)
    asked = usable(queries, id_col, vec_col).filter(F.size("vec") == size).groupBy("vec_id").agg(F.min("vec").alias("vec"))

    kind = "vec_id long, vec binary, leaf long"
    filed = cut(own.mapInArrow(_filer(tree), kind), "ann-vectors")
    counts = _leaf_counts(filed)
    settled: list[DataFrame] = []
    for _ in range(SPLITS):
        over = {leaf: n for leaf, n in counts.items() if n > LEAF_LIMIT}
        trees = _split(filed, over)
        if not trees:
            break
        for leaf, centers, children in trees:
            tree.graft(leaf, centers, children)
        # only the vectors of these leaves are filed anew; the others stay where they are
        split = spark.createDataFrame([(leaf,) for leaf, _, _ in trees], "leaf long")
        settled.append(filed.join(F.broadcast(split), "leaf", "left_anti").select("vec_id", "vec", "leaf"))
        filed = cut(filed.join(F.broadcast(split), "leaf", "left_semi").select("vec_id", "vec", "leaf").mapInArrow(_refiler(tree), kind), "ann-vectors")
        counts = {leaf: n for leaf, n in counts.items() if leaf not in {x for x, _, _ in trees}} | _leaf_counts(filed)
    for part in settled:
        filed = filed.unionByName(part)
    visits = calibrate(tree, units, k)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(1))
                rows = []
                for i, r, u in zip(b.column(0).to_pylist(), m, _units(m)):
                    seen = 0
                    for n, leaf in enumerate(tree.walk(u)):
                        if n >= visits and seen > k:
                            break
                        seen += counts.get(leaf, 0)
                        rows.append((i, r.tobytes(), leaf))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.int64()))], names=["query_id", "vec", "leaf"])

    probes = cut(asked.mapInArrow(probe, "query_id long, vec binary, leaf long"), "ann-probes")
    # one row for each leaf, so one for LEAF_LIMIT / 4 vectors or so
    blocks = filed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("nv")).join(
        probes.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("nq")), "leaf"
    )
    blocks = cut(blocks, "ann-blocks")
    few = F.broadcast(blocks) if blocks.count() <= BROADCAST_LEAVES else blocks
    parts = filed.join(few, "leaf").select(
        "leaf", "vec_id", "vec", F.pmod(F.xxhash64("vec_id"), F.col("nv")).cast("int").alias("bv"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("bq")
    )
    sent = probes.join(few, "leaf").select(
        "leaf", "query_id", "vec", F.pmod(F.xxhash64("query_id"), F.col("nq")).cast("int").alias("bq"), F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("bv")
    )

    def best(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        return _best(q, v, k)

    found = sent.groupBy("leaf", "bv", "bq").cogroup(parts.groupBy("leaf", "bv", "bq")).applyInPandas(best, "query_id long, vec_id long, score double")
    nearest = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nearest).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 50 = 0"), k=5)
