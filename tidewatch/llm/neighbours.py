"""Nearest neighbours by inner product with a forest of random-projection trees.

The trees are grown on a bounded sample; every vector is then put into one
leaf of each tree. A query walks all trees at once through one priority
queue, nearest margin first, until it has seen its number of leaves and its
share of the sample; the vectors in those leaves are its candidates and are reranked by the exact
inner product. For inner products of vectors that differ in length, they get
one more component that makes all equally long, and queries a zero.

Equal vectors are one entry that lists the smallest ids with it, so copies
neither crowd a leaf nor fill it with pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import stage

TREES = 20
#: Vectors the trees are grown on, about; raise it with the table to keep leaves small.
SAMPLE_ROWS = 65_536
#: Sample vectors in a leaf, at most.
LEAF_ROWS = 512
#: Leaves a query sees at least, over all trees.
LEAVES = 110
#: Sample vectors in the leaves a query sees at least, as a share of the sample (trees count each on their own).
#: The sample's size decides whether leaves are full or half full, so their number alone doesn't fix the share.
COVERED = 0.86
#: Vectors of a leaf in one group, about; larger leaves are dealt to several.
GROUP_ROWS = 50_000
SEED = 20


class Forest:
    """Hyperplanes of all trees: node i sends x to ``near[i]`` if normal . x > offset, else to ``far[i]``.

    Children below 0 are leaves: -1 - (number of the leaf, over all trees).
    """

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.roots, normals, offsets, near, far = [], [], [], [], []
        self.leaves, self.rows, self.sizes = 0, len(sample), []

        def grow(rows) -> int:
            if len(rows) <= leaf_rows:
                self.sizes.append(len(rows))
                self.leaves += 1
                return -self.leaves
            a, b = sample[rng.choice(rows, 2, replace=False)]
            normal = (a - b) / max(np.linalg.norm(a - b), 1e-12)
            side = sample[rows] @ normal
            cut = np.median(side)
            right = side > cut
            if not right.any() or right.all():  # equal projections: part them evenly all the same
                self.sizes.append(len(rows))
                self.leaves += 1
                return -self.leaves
            i = len(normals)
            normals.append(normal)
            offsets.append(cut)
            near.append(0)
            far.append(0)
            near[i], far[i] = grow(rows[right]), grow(rows[~right])
            return i

        for _ in range(trees):
            self.roots.append(grow(np.arange(len(sample))))
        self.normals = np.array(normals, np.float32).reshape(-1, sample.shape[1])
        self.offsets = np.array(offsets, np.float32)
        self.near, self.far = np.array(near, np.int64), np.array(far, np.int64)

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            while (go := np.flatnonzero(at >= 0)).size:
                i = at[go]
                right = np.einsum("ij,ij->i", x[go], self.normals[i]) > self.offsets[i]
                at[go] = np.where(right, self.near[i], self.far[i])
            out[:, t] = -1 - at
        return out

    def search(self, q: np.ndarray, leaves: int, covered: float = COVERED) -> list[list[int]]:
        """The first leaves of each row by the smallest margin on the way: ``leaves`` of them, and as many more as
        it takes until they hold ``covered`` times the sample."""
        near, far, found = self.near.tolist(), self.far.tolist(), []
        for s in range(0, len(q), 64):
            for margins in (q[s : s + 64] @ self.normals.T - self.offsets).tolist():
                queue = [(-np.inf, r) for r in self.roots]
                heapq.heapify(queue)
                seen: list[int] = []
                rows = 0
                while queue and (len(seen) < leaves or rows < covered * self.rows):
                    missed, node = heapq.heappop(queue)
                    while node >= 0:
                        m = margins[node]
                        better, other = (near[node], far[node]) if m > 0 else (far[node], near[node])
                        heapq.heappush(queue, (max(missed, abs(m)), other))
                        node = better
                    seen.append(-1 - node)
                    rows += self.sizes[-1 - node]
                found.append(seen)
        return found


def lengthened(x: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
    """Unit vectors with one more component: of length ``longest`` for entries, of their own for queries."""
    x = x.astype(float)
    if query:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        more = np.zeros((len(x), 1))
    else:
        x = x / longest
        more = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1, keepdims=True)))
    return np.hstack([x, more]).astype(np.float32)


def matrix(column) -> np.ndarray:
    """List column to a matrix (lists of one length)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def best_in_leaf(k: int):
    """For each query of a group its best ``k`` members, of equal scores those with the smaller id.

    The matrix product only tells which members may be among them; scores are sums in component order, in double.
    """

    def run(key, t):
        vectors = matrix(t["vector"]).astype(float)
        entry, first, asks = (t[c].to_numpy(zero_copy_only=False) for c in ("entry", "first", "asks"))
        asks = asks.astype(bool)
        q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
        out = ([np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)])
        step = max(1, (4 << 20) // max(1, len(m)))
        take = min(len(m), k)
        for s in range(0, len(q) if len(m) else 0, step):
            rows = q[s : s + step]
            scores = vectors[rows] @ vectors[m].T
            room = 1e-12 * vectors.shape[1] * np.abs(vectors[rows]).max(1) * np.abs(vectors[m]).max()
            least = np.partition(scores, len(m) - take, axis=1)[:, len(m) - take] - room
            a, b = np.nonzero(scores >= least[:, None])
            exact = (vectors[rows[a]] * vectors[m[b]]).cumsum(1)[:, -1]
            order = np.lexsort((first[m[b]], -exact, a))
            a, b, exact = a[order], b[order], exact[order]
            place = np.arange(len(a)) - np.searchsorted(a, a)
            a, b, exact = a[place < take], b[place < take], exact[place < take]
            out[0].append(entry[rows[a]])
            out[1].append(entry[m[b]])
            out[2].append(exact)
        return pa.table({"query": np.concatenate(out[0]), "entry": np.concatenate(out[1]), "score": np.concatenate(out[2])})

    return run


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    leaves: int = LEAVES,
    leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    covered: float = COVERED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where ``queries`` holds, their ``k`` nearest found.

    Every other row is a candidate; equal scores rank by the smaller id.
    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    null ids and vectors of another length than the commonest (the shorter on
    a tie). A row repeated with its id and vector counts once. Without
    candidates a query has no rows. Other columns are not read.
    """
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), v.alias("vector"), F.size(v).alias("d"), queries.alias("asks")
    ).where(F.col("id").isNotNull() & v.isNotNull() & fine)
    rows = stage(rows, "vectors")
    common = rows.groupBy("d").count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = common[0]["d"] if common else 1
    rows = rows.where(F.col("d") == d)

    # distinct vectors with their k + 1 smallest ids
    few = rows.select("id", "vector").withColumn("nr", F.dense_rank().over(W.partitionBy("vector").orderBy("id"))).where(F.col("nr") <= k + 1)
    entries = few.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    entries = stage(entries.withColumn("entry", F.monotonically_increasing_id()), "entries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, longest = entries.agg(F.count("*"), F.max(norm)).first()
    share = min(1.0, sample_rows / max(n, 1))
    sample = entries.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30))).select("vector")
    sample = np.array([r[0] for r in sample.collect()], np.float32).reshape(-1, d)
    longest = longest or 1.0
    forest = Forest(lengthened(sample[np.lexsort(sample.T)], longest), trees, leaf_rows)
    blocks = max(1, int(n / max(1, forest.leaves / trees) / GROUP_ROWS))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = forest.place(lengthened(matrix(batch["vector"]), longest))
            index = pa.array(np.repeat(np.arange(batch.num_rows), trees))
            entry = batch["entry"].take(index)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at.ravel()),
                    pa.array(entry.to_numpy() % blocks),
                    entry,
                    batch["first"].take(index),
                    batch["vector"].take(index),
                    pa.array(np.zeros(len(index), bool)),
                ],
                names=["leaf", "block", "entry", "first", "vector", "asks"],
            )

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = forest.search(lengthened(matrix(batch["vector"]), longest, True), leaves, covered)
            seen = np.repeat(np.array([x for f in found for x in f], np.int64), blocks)
            index = pa.array(np.repeat(np.arange(batch.num_rows), [len(f) * blocks for f in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(seen),
                    pa.array(np.tile(np.arange(blocks), len(seen) // blocks)),
                    batch["entry"].take(index),
                    batch["first"].take(index),
                    batch["vector"].take(index),
                    pa.array(np.ones(len(index), bool)),
                ],
                names=["leaf", "block", "entry", "first", "vector", "asks"],
            )

    # vectors travel in their own type; scores are those of the original numbers
    kind = "array<float>" if entries.schema["vector"].dataType.elementType.typeName() == "float" else "array<double>"
    schema = f"leaf bigint, block bigint, entry bigint, first bigint, vector {kind}, asks boolean"
    to_ask = stage(
        rows.where("asks")
        .select(F.col("id").alias("query_id"), F.col("vector").alias("qv"))
        .distinct()
        .join(entries.select("entry", "vector"), F.col("qv") == F.col("vector"))
        .select("query_id", F.col("entry").alias("query")),
        "queries",
    )
    asking = entries.join(to_ask.select(F.col("query").alias("entry")).distinct(), "entry", "left_semi")
    sides = [
        e.select("entry", F.col("ids")[0].alias("first"), F.col("vector").cast(kind).alias("vector")).mapInArrow(f, schema)
        for e, f in ((entries, placed), (asking, asked))
    ]
    found = sides[0].unionByName(sides[1]).groupBy("leaf", "block")
    found = found.applyInArrow(best_in_leaf(k + 1), "query bigint, entry bigint, score double")
    found = found.groupBy("query", "entry").agg(F.max("score").alias("score"))
    # k + 1 distinct vectors are enough for k others, and as many ids of them
    by_score = W.partitionBy("query").orderBy(F.desc("score"))
    found = found.withColumn("r", F.rank().over(by_score)).where(F.col("r") <= k + 1)
    ids = found.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("id"))
    ids = ids.withColumn("r", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id")))
    lists = ids.where(F.col("r") <= k + 1).groupBy("query")
    lists = lists.agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("best"))
    answer = to_ask.join(lists, "query")
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)
    answer = answer.select("query_id", F.posexplode(others).alias("i", "x"))
    return answer.select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )
