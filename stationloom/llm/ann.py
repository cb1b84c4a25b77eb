"""Nearest neighbours by a forest of random-projection trees.

Every tree splits space by hyperplanes halfway between two random vectors of a bounded sample, down to leaves of some sample
vectors. All rows are then put into a leaf of every tree. A query walks all trees through one priority queue, ordered by the
squared margins it has crossed, and takes leaves until they hold a share of all entries. That share is measured when the
forest is fitted: the smallest of ``SHARES`` that finds ``RECALL`` of the true neighbours inside the sample. Where vectors
have structure it is small; for vectors spread evenly in many dimensions no index can leave out much.

Spark brings queries and rows of a leaf together, in blocks of bounded size on either side. Each block gives every query its
nearest rows by exact distance, and the nearest of all blocks are the answer. Equal vectors are one entry of the index, with
the smallest ids that an answer can need, so a vector that a third of the rows have fills no leaf.

Defined results: vectors that are NULL, zero, of another length than most, or hold NULL or non-finite components take no
part; rows that repeat a vec_id are one candidate each id; a table without vectors gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationloom.storage import materialize

#: The forest is fitted on at most so many vectors.
SAMPLE = 20_000
TREES = 6
#: Sample vectors of a leaf.
LEAF = 128
#: Shares of all entries that the leaves of a query may hold; an entry counts once in each tree.
SHARES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0, 1.5, 2.0, 3.0)
#: Wanted share of true neighbours, inside the sample.
RECALL = 0.96
MEASURED_QUERIES = 200
#: A query sees at least so many entries.
LEAST = 2000
#: Entries and queries of a leaf that are compared in one block.
ENTRY_BLOCK, QUERY_BLOCK = 4096, 1024


def usable(v: Column) -> Column:
    """No NULL or non-finite component, and not zero."""
    d = lambda x: x.cast("double")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(d(x)) & (F.abs(d(x)) != float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: d(x) != 0), F.lit(False))


@dataclass
class Forest:
    """All trees in arrays: a node's hyperplane and children; negative children are leaves."""

    roots: list[int]
    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            while (on := np.nonzero(at >= 0)[0]).size:
                n = at[on]
                right = np.einsum("ij,ij->i", x[on], self.normals[n]) > self.offsets[n]
                at[on] = self.children[n, right.astype(int)]
            out[:, t] = at
        return out

    def search(self, x: np.ndarray, sizes: dict[int, int], enough: float) -> list[int]:
        """Leaves by the squared margins crossed on the way from a root, until they hold enough rows."""
        queue, found, held = [(0.0, r) for r in self.roots], [], 0
        margins = self.normals @ x - self.offsets
        while queue and held < enough:
            crossed, node = heapq.heappop(queue)
            if node < 0:
                if node in sizes:
                    found.append(node)
                    held += sizes[node]
                continue
            m = margins[node]
            near, far = self.children[node, int(m > 0)], self.children[node, int(m <= 0)]
            heapq.heappush(queue, (crossed, int(near)))
            heapq.heappush(queue, (crossed + m * m, int(far)))
        return found


def grow(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    normals, offsets, children, leaves = [], [], [], 0

    def split(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            for _ in range(5):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                normal = a - b
                length = np.linalg.norm(normal)
                if not length:
                    continue
                normal /= length
                offset = normal @ (a + b) / 2
                right = sample[rows] @ normal > offset
                if 0.05 < right.mean() < 0.95:
                    node = len(normals)
                    normals.append(normal)
                    offsets.append(offset)
                    children.append([0, 0])
                    children[node] = [split(rows[~right]), split(rows[right])]
                    return node
        leaves += 1
        return -leaves

    roots = [split(np.arange(len(sample))) for _ in range(trees)]
    d = sample.shape[1]
    return Forest(roots, np.array(normals).reshape(-1, d), np.array(offsets), np.array(children, int).reshape(-1, 2))


def search_share(forest: Forest, sample: np.ndarray, k: int) -> float:
    """The smallest of ``SHARES`` that finds ``RECALL`` of the true ``k`` neighbours inside the sample."""
    leaves = forest.leaves(sample)
    names, counts = np.unique(leaves, return_counts=True)
    sizes = dict(zip(names.tolist(), counts.tolist()))
    step = max(1, len(sample) // MEASURED_QUERIES)
    hits, wanted = np.zeros(len(SHARES)), 0
    for i in range(0, len(sample), step):
        d = ((sample - sample[i]) ** 2).sum(1)
        d[i] = np.inf
        true = leaves[np.argsort(d, kind="stable")[: min(k, len(sample) - 1)]]
        order = forest.search(sample[i], sizes, np.inf)
        held = np.cumsum([sizes[n] for n in order])
        place = {n: j for j, n in enumerate(order)}
        # a neighbour is found with the first of its leaves
        first = [min(place[n] for n in row) for row in true.tolist()]
        wanted += len(first)
        for s, share in enumerate(SHARES):
            last = int(np.searchsorted(held, share * len(sample)))
            hits[s] += sum(f <= last for f in first)
    good = np.nonzero(hits >= RECALL * max(1, wanted))[0]
    return SHARES[int(good[0])] if len(good) else float(len(forest.roots))


def _vectors(rows: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in rows])


def index(table: DataFrame, k: int = 10) -> tuple[DataFrame, DataFrame, Forest, float]:
    """The usable rows (vec_id, v), the entries (entry, v, ids, leaves), the forest and the share to search."""
    rows = table.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v")
    )
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("v") == (lengths["d"] if lengths else 0))
    # k neighbours and the query itself are all that an answer can need of equal vectors
    near = F.dense_rank().over(W.partitionBy("v").orderBy("vec_id"))
    entries = rows.withColumn("r", near).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    entries = materialize(entries.select(F.element_at("ids", 1).alias("entry"), "v", "ids"), "entries")
    sample = [r[0] for r in entries.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("v").collect()]
    points = np.array(sample, np.float64).reshape(len(sample), lengths["d"] if lengths else 1)
    forest = grow(points)
    share = search_share(forest, points, k) if len(points) else 1.0
    cast = table.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("array<long>")
    def place(v: pd.Series) -> pd.Series:
        return pd.Series(list(cast.value.leaves(_vectors(v)))) if len(v) else pd.Series([], dtype=object)

    return rows, materialize(entries.withColumn("leaves", place("v")), "placed"), forest, share


def nearest(table: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row that ``queries`` holds for, Euclidean."""
    rows, entries, forest, share = index(table, k)
    each = entries.select("entry", "v", "ids", F.explode("leaves").alias("leaf"))
    # as many rows as the forest has leaves, which the sample bounds
    sizes = {r[0]: r[1] for r in each.groupBy("leaf").count().collect()}
    enough = max(LEAST, share * entries.count())
    cast = table.sparkSession.sparkContext.broadcast((forest, sizes))

    @F.pandas_udf("array<long>")
    def walk(v: pd.Series) -> pd.Series:
        f, s = cast.value
        return pd.Series([f.search(np.asarray(x, np.float64), s, enough) for x in v], dtype=object)

    asked = rows.where(queries).distinct().withColumn("leaves", walk("v"))
    asked = materialize(asked, "asked").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.explode("leaves").alias("leaf"))
    blocks = lambda n, size: F.ceil(n / F.lit(size)).cast("long")
    plan = each.groupBy("leaf").agg(F.count("*").alias("e")).join(asked.groupBy("leaf").agg(F.count("*").alias("a")), "leaf")
    plan = materialize(plan.select("leaf", blocks(F.col("e"), ENTRY_BLOCK).alias("eb"), blocks(F.col("a"), QUERY_BLOCK).alias("qb")), "blocks")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    entry_side = each.join(plan, "leaf").withColumn("i", F.pmod(F.xxhash64("entry"), "eb")).withColumn("j", upto("qb"))
    query_side = asked.join(plan, "leaf").withColumn("j", F.pmod(F.xxhash64("query_id"), "qb")).withColumn("i", upto("eb"))
    keys = ["leaf", "i", "j"]

    def compare(e: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(e) and len(a):
            v, ids = _vectors(e["v"]), [np.asarray(x, np.int64) for x in e["ids"]]
            for query_id, q in zip(a["query_id"].tolist(), a["q"]):
                d = np.sqrt(((v - np.asarray(q, np.float64)) ** 2).sum(1))
                take = min(len(d), k + 1)
                # ties at the edge all stay
                best = np.nonzero(d <= np.partition(d, take - 1)[take - 1])[0]
                near = sorted((d[b], i) for b in best for i in ids[b].tolist() if i != query_id)[:k]
                found += [(query_id, i, s) for s, i in near]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    pairs = (
        entry_side.select(*keys, "v", "ids").groupBy(*keys)
        .cogroup(query_side.select(*keys, "query_id", "q").groupBy(*keys))
        .applyInPandas(compare, "query_id long, vec_id long, score double")
    )
    best = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
