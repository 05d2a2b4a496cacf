"""Approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is built and cut into balanced partitions, and a
small network learns to tell a vector's partition. It then deals out every row of the
table to its most probable partition and every query to several. Partitions that get
very many rows are cut again in the same way, each by a network of its own. They are
searched in blocks of bounded size, so that a frequent vector is no one task's work, and
all distances are exact ones on the original vectors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.storage import stored

#: Vectors that the partitions are learned from, at most, and neighbours of each in the graph.
SAMPLE, EDGES = 16_384, 10
#: There are about sqrt(rows) / THIN partitions, while the sample has LEAST vectors for each.
THIN, LEAST = 4, 64
#: Partitions of more rows are cut again, into MOST_INNER at most: what all tasks hold is at most
#: SAMPLE / LEAST networks for so many partitions.
PART_ROWS, MOST_INNER = 32_768, 64
#: A partition may hold so many times its share of the sample.
SLACK = 1.15
HIDDEN, EPOCHS = 96, 12
#: Share of true neighbours in the sample that the number of probes is chosen for.
RECALL = 0.96
#: Rows and queries of a block.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024


def nearest(queries: np.ndarray, rows: np.ndarray, k: int, skip_self: bool) -> np.ndarray:
    """Numbers of the k nearest rows of each query."""
    out = np.empty((len(queries), k), np.int64)
    norms = (rows**2).sum(axis=1)
    for a in range(0, len(queries), 512):
        q = queries[a : a + 512]
        d = norms[None, :] - 2 * (q @ rows.T)
        if skip_self:
            d[np.arange(len(q)), np.arange(a, a + len(q))] = np.inf
        out[a : a + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Cut a neighbour graph into `parts` (a power of two) of nearly equal size with few edges between.

    Halving along the widest direction gives a start; then vertices move to the partition
    that most of their neighbours are in, largest gain first, as long as there is room.
    """
    label = np.zeros(len(x), np.int64)
    width = 1
    while width < parts:
        for p in range(width):
            own = np.flatnonzero(label == p)
            centred = x[own] - x[own].mean(axis=0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            label[own[np.argsort(centred @ axis, kind="stable")[len(own) // 2 :]]] += width
        width *= 2
    n, k = graph.shape
    ends = (np.concatenate([np.repeat(np.arange(n), k), graph.ravel()]), np.concatenate([graph.ravel(), np.repeat(np.arange(n), k)]))
    room = int(np.ceil(SLACK * n / parts))
    floor = int(n / parts / SLACK)
    for _ in range(20):
        votes = np.bincount(ends[0] * parts + label[ends[1]], minlength=n * parts).reshape(n, parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        size = np.bincount(label, minlength=parts)
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if size[best[v]] < room and size[label[v]] > floor:
                size[best[v]] += 1
                size[label[v]] -= 1
                label[v] = best[v]
                moved += 1
        if moved < n // 500:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer: probabilities of partitions."""

    centre: np.ndarray
    scale: float
    weights: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    parts: int
    probes: int
    inner: dict[int, Router] = field(default_factory=dict)

    def scores(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum((x - self.centre) / self.scale @ w1 + b1, 0) @ w2 + b2

    def top(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n most probable partitions of each vector, the likeliest first."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n]

    def deal(self, x: np.ndarray, probes: Callable[[Router], int]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of vectors, and the partitions to which each goes."""
        top = self.top(x, probes(self))
        rows, outer = np.repeat(np.arange(len(x)), top.shape[1]), top.ravel()
        whole = ~np.isin(outer, list(self.inner))
        out = [(rows[whole], outer[whole] * (MOST_INNER + 1))]
        for p, router in self.inner.items():
            own = rows[outer == p]
            if len(own):
                below, part = router.deal(x[own], probes)
                out.append((own[below], p * (MOST_INNER + 1) + 1 + part // (MOST_INNER + 1)))
        return np.concatenate([r for r, _ in out]), np.concatenate([p for _, p in out])


def _train(x: np.ndarray, label: np.ndarray, parts: int) -> Router:
    random = np.random.default_rng(7)
    centre, scale = x.mean(axis=0), float(x.std()) or 1.0
    z = (x - centre) / scale
    d = x.shape[1]
    w = [random.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN),
         random.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]
    first, second, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for epoch in range(EPOCHS):
        rate = 0.01 * 0.8**epoch
        order = random.permutation(len(z))
        for a in range(0, len(z), 256):
            own = order[a : a + 256]
            h = np.maximum(z[own] @ w[0] + w[1], 0)
            s = h @ w[2] + w[3]
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(own)), label[own]] -= 1
            p /= len(own)
            back = (p @ w[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((z[own].T @ back, back.sum(axis=0), h.T @ p, p.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                w[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(centre, scale, tuple(w), parts, parts)


def learn(sample: np.ndarray, rows: int, most: int = SAMPLE) -> Router:
    """Partitions, `most` at most, and router for a table of `rows` vectors."""
    n = len(sample)
    parts = 1
    while parts * 2 * THIN <= rows**0.5 and parts * 2 * LEAST <= n and parts * 2 <= most:
        parts *= 2
    k = min(EDGES, n - 1)
    if parts == 1 or k < 1:
        zero = np.zeros((sample.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)
        return Router(np.zeros(sample.shape[1]), 1.0, zero, 1, 1)
    graph = nearest(sample, sample, k, True)
    router = _train(sample, balanced_parts(sample, graph, parts), parts)
    # as many probes as the sample needs: rank, among a vector's partitions, of those of its neighbours
    order = router.top(sample, parts)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(n, 0), axis=1)
    needed = rank[np.repeat(np.arange(n), k), order[graph.ravel(), 0]]
    router.probes = int(np.quantile(needed, RECALL, method="higher")) + 1
    return router


def valid_vectors(table: DataFrame) -> DataFrame:
    """vec_id, vector (array<double>) of the rows that take part: all of the length that most have,
    finite, not zero."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1)
    size = sizes.collect()
    return rows.filter(F.size("vector") == (size[0]["size"] if size else 0))


def _dealt(router: Router, probes: Callable[[Router], int]):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            rows, parts = router.deal(flat.reshape(batch.num_rows, -1), probes)
            again = batch.take(pa.array(rows))
            yield pa.record_batch(
                [again.column("vec_id"), again.column("vector"), pa.array(parts.astype(np.int32))],
                names=["vec_id", "vector", "part"],
            )

    return run


def _drawn(rows: DataFrame, n: int | Column, sample: int, *key: str) -> DataFrame:
    """About `sample` of `n` rows, by a hash."""
    return rows.filter(F.pmod(F.xxhash64(*key), F.lit(n) if isinstance(n, int) else n) < sample)


def _inner_routers(index: DataFrame, router: Router, sample: int) -> dict[int, Router]:
    """Routers of the partitions that have got more than PART_ROWS rows. Each is learned in a task
    from the partition's own sample of different vectors."""
    sizes = index.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PART_ROWS)
    sizes = stored(sizes, "sizes")  # a row per partition of the outer router
    if sizes.isEmpty():
        return {}
    drawn = _drawn(index.join(F.broadcast(sizes), "part"), F.col("n"), sample, "vector")

    def learned(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(group.vector.to_numpy())
        own = learn(x, int(group.n.iloc[0]), MOST_INNER)
        numbers = [[own.centre.tolist()], *[[w.ravel().tolist()] for w in own.weights]]
        columns = dict(zip(("centre", "w1", "b1", "w2", "b2"), numbers, strict=True))
        return pd.DataFrame(
            {"part": [group.part.iloc[0]], "scale": [own.scale], "parts": [own.parts], "probes": [own.probes], **columns}
        )

    shape = "part int, scale double, parts int, probes int, " + ", ".join(
        f"{c} array<double>" for c in ("centre", "w1", "b1", "w2", "b2")
    )
    out = {}
    for r in drawn.select("part", "n", "vector").distinct().groupBy("part").applyInPandas(learned, shape).collect():
        centre, w1, b1, w2, b2 = (np.array(r[c]) for c in ("centre", "w1", "b1", "w2", "b2"))
        weights = w1.reshape(len(centre), -1), b1, w2.reshape(-1, r.parts), b2
        out[r.part // (MOST_INNER + 1)] = Router(centre, r.scale, weights, r.parts, r.probes)
    return out


_DEALT = "vec_id long, vector array<double>, part int"
_FOUND = "query_id long, vec_id long, score double"


def _searched(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(queries):
            ids, x = rows.vec_id.to_numpy(), np.stack(rows.vector.to_numpy())
            for q, v in zip(queries.vec_id, queries.vector, strict=True):
                d = np.sqrt(((x - v) ** 2).sum(axis=1))
                d[ids == q] = np.inf
                near = np.lexsort((ids, d))[:k]
                near = near[ids[near] != q]
                out["query_id"] += [q] * len(near)
                out["vec_id"] += ids[near].tolist()
                out["score"] += d[near].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def _search(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Both dealt to partitions -> the k nearest of each query in each block of its partitions."""

    def blocks(table: DataFrame, size: int, name: str) -> DataFrame:
        return table.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    shape = blocks(rows, BLOCK_ROWS, "row_blocks").join(blocks(queries, BLOCK_QUERIES, "query_blocks"), "part")

    def cut(table: DataFrame, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        """Each row to one block of its side, and to every block of the other side."""
        return table.join(shape, "part").select(
            "vec_id", "vector", "part",
            F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int").alias(own_name),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_name),
        )

    keys = ["part", "i", "j"]
    left = cut(queries, "query_blocks", "row_blocks", "i", "j").groupBy(*keys)
    right = cut(rows, "row_blocks", "query_blocks", "j", "i").groupBy(*keys)
    return left.cogroup(right).applyInPandas(_searched(k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(table: DataFrame, is_query, k: int = 10, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows (Euclidean) found for every row of `table`
    (vec_id, embedding) that meets the condition `is_query`, except the query's own vec_id.

    Partitions are learned from the `sample` rows that come first by a hash of vec_id; all rows
    are indexed. Partitions of more than PART_ROWS rows are cut again, from a sample each. A query that finds fewer than k in its partitions searches all of them.
    Vectors that are null, zero, or hold null or non-finite numbers take no part, nor those
    of another length than most. Ties go to the smaller vec_id. A repeated row is a
    candidate as often as it occurs; a repeated query is asked once, with its least vector.
    An empty table gives an empty table; other columns are ignored.
    """
    rows = stored(valid_vectors(table), "vectors")
    n = rows.count()
    likely = _drawn(rows, max(1, n), 2 * sample, "vec_id")  # far fewer than all to sort
    picked = likely.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow().column("vector")
    flat = picked.combine_chunks().flatten().to_numpy()
    router = learn(flat.reshape(len(picked), -1) if len(picked) else np.zeros((0, 1)), n)
    index = stored(rows.mapInArrow(_dealt(router, lambda r: 1), _DEALT), "index")
    router.inner = _inner_routers(index, router, sample)
    if router.inner:
        index = stored(rows.mapInArrow(_dealt(router, lambda r: 1), _DEALT), "index")
    asked = stored(rows.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")

    def found(queries: DataFrame, probes: Callable[[Router], int]) -> DataFrame:
        return _best(_search(queries.mapInArrow(_dealt(router, probes), _DEALT), index, k), k)

    near = stored(found(asked, lambda r: r.probes), "neighbours")
    if router.probes < router.parts or router.inner:
        short = asked.join(near.groupBy("query_id").count().filter(F.col("count") >= k), F.col("vec_id") == F.col("query_id"), "left_anti")
        short = stored(short, "queries")
        if short.count():
            near = near.join(short, F.col("query_id") == short["vec_id"], "left_anti")
            near = near.unionByName(found(short, lambda r: r.parts))
    return near.select("query_id", "rank", "vec_id", "score")


def op6_neighbours(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
