"""Exact top-k inner products: a ball tree per shard, searched best node first.

Vectors become whole numbers, floor(SCALE * x) with x as double, so scores are exact. They are dealt
to shards of about ``SHARD_ROWS`` rows and queries to groups of about ``QUERY_ROWS``; each task holds one
shard and one group. A shard's tree halves its rows along the line between two far points; a
node with centre c and radius r bounds every score below it by q.c + |q| r. Nodes whose bound is
under the query's current kth score are dropped with all below them, leaves are read in descending
order of their bounds. The current kth score is shared: each query first searches its own shard, and
what it finds there starts the search of all others.

Ties go to the smaller vec_id. A vector that is null, empty or holds a null or non-finite
component takes no part, nor does a row without vec_id. However large, all others do: products that might leave 64 bits
are formed in whole numbers of any size, and a component or score of 2**62 or more ends the job. Vectors are only
compared with those of their own length. A query is not compared with rows of its own vec_id;
other repeated rows each count. Without candidates a query gives no rows. Columns other than vec_id
and embedding are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyra.llm.ship import ship

SCALE = 256
SHARD_ROWS = 16384
QUERY_ROWS = 2048
LEAF_ROWS = 256
LARGEST = 1 << 62
NOTHING = -(1 << 62)  # below every score, and safe to negate


class BallTree:
    """Levels of nodes over rows that were put into tree order; node i of a level has a row range."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.arange(len(ids))
        exact = vectors.astype(np.float64)
        self.levels = []
        bounds = [0, len(ids)]
        while True:
            starts, ends = bounds[:-1], bounds[1:]
            centres = np.array([exact[order[a:b]].mean(axis=0) for a, b in zip(starts, ends)])
            radii = np.array([
                np.sqrt(((exact[order[a:b]] - c) ** 2).sum(axis=1).max()) for a, b, c in zip(starts, ends, centres)])
            self.levels.append((centres, radii, starts, ends))
            if max(b - a for a, b in zip(starts, ends)) <= LEAF_ROWS:
                break
            bounds = [0]
            for a, b in zip(starts, ends):
                rows = exact[order[a:b]]
                far = rows[((rows - rows[0]) ** 2).sum(axis=1).argmax()]
                other = rows[((rows - far) ** 2).sum(axis=1).argmax()]
                along = rows @ (far - other)
                order[a:b] = order[a:b][np.argsort(along, kind="stable")]
                bounds += [(a + b) // 2, b]
        self.leaves = []
        for a, b in zip(self.levels[-1][2], self.levels[-1][3]):
            rows = order[a:b][np.argsort(ids[order[a:b]], kind="stable")]
            self.leaves.append((ids[rows], vectors[rows]))

    def search(self, query_ids, queries, kth, k: int):
        """Scores and ids (Q x k, best first) of the rows that may beat each query's kth score."""
        n = len(queries)
        least = NOTHING
        scores = np.full((n, k), least)
        found = np.full((n, k), np.iinfo(np.int64).max)
        kth = kth.copy()
        exact = queries.astype(np.float64)
        norms = np.sqrt((exact**2).sum(axis=1))
        alive = np.ones((n, 1), bool)
        for level, (centres, radii, _, _) in enumerate(self.levels):
            if level:
                alive = np.repeat(alive, 2, axis=1)
            bound = exact @ centres.T + norms[:, None] * radii
            # rounding must not cut a tie
            bound += 1e-9 * norms[:, None] * (np.sqrt((centres**2).sum(axis=1)) + radii) + 1e-6
            alive &= bound >= kth[:, None]
        bound[~alive] = -np.inf
        order = np.argsort(-bound, axis=1, kind="stable")
        for j in range(bound.shape[1]):
            leaf = order[:, j]
            best = bound[np.arange(n), leaf]
            active = np.flatnonzero((best >= kth) & (best > -np.inf))
            if not len(active):
                break
            for x in np.unique(leaf[active]):
                own = active[leaf[active] == x]
                ids, rows = self.leaves[x]
                got = _products(queries[own], rows)
                got[query_ids[own, None] == ids[None, :]] = least
                first = np.argsort(-got, axis=1, kind="stable")[:, :k] if len(ids) > k else np.argsort(-got, axis=1, kind="stable")
                all_s = np.concatenate([scores[own], np.take_along_axis(got, first, axis=1)], axis=1)
                all_i = np.concatenate([found[own], ids[first]], axis=1)
                top = np.lexsort((all_i, -all_s), axis=1)[:, :k]
                scores[own] = np.take_along_axis(all_s, top, axis=1)
                found[own] = np.take_along_axis(all_i, top, axis=1)
                kth[own] = np.maximum(kth[own], scores[own, k - 1].astype(np.float64))
        return scores, found


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; by floating point where that is exact."""
    most = float(max(np.abs(a).max(), 1)) * float(max(np.abs(b).max(), 1)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < LARGEST:
        return a @ b.T
    # only the rows with large components need wide numbers
    limit = int((LARGEST / a.shape[1]) ** 0.5)
    wide_a, wide_b = (np.abs(x).max(axis=1) >= limit for x in (a, b))
    out = np.zeros((len(a), len(b)), np.int64)
    out[np.ix_(~wide_a, ~wide_b)] = a[~wide_a] @ b[~wide_b].T
    for rows, columns in ((wide_a, np.ones(len(b), bool)), (~wide_a, wide_b)):
        if rows.any() and columns.any():
            exact = a[rows].astype(object) @ b[columns].astype(object).T
            if max(abs(int(x)) for x in exact.ravel()) >= LARGEST:
                raise OverflowError("a score of 2**62 or more")
            out[np.ix_(rows, columns)] = exact.astype(np.int64)
    return out


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _search(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({x: pa.array([], pa.int64()) for x in ("query_id", "vec_id", "score")})
        if not left.num_rows or not right.num_rows:
            return empty
        tree = BallTree(left["vec_id"].to_numpy(), _matrix(left["v"]))
        query_ids = right["query_id"].to_numpy()
        kth = right["kth"].to_numpy().astype(np.float64)
        scores, ids = tree.search(query_ids, _matrix(right["q"]), kth, k)
        held = (scores > NOTHING) & (scores >= kth[:, None])
        at = np.nonzero(held)
        return pa.table({"query_id": query_ids[at[0]], "vec_id": ids[at], "score": scores[at]})

    return run


RESULT = "query_id long, vec_id long, score long"


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, v (whole numbers) and n (length) of the rows that take part."""
    def whole(x):
        wide = F.lit(float(SCALE)) * x.cast("double")
        return F.when(F.abs(wide) < float(LARGEST), F.floor(wide)).otherwise(
            F.raise_error(F.lit("a component of 2**62 or more after scaling")).cast("long"))

    scaled = F.transform("embedding", whole)
    bad = F.exists("embedding", lambda x: F.coalesce(
        F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")), F.lit(True)))
    return rows.where("vec_id IS NOT NULL AND size(embedding) > 0").where(~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"), F.size("embedding").alias("n"))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs have vec_id and embedding."""
    spark = ship(rows.sparkSession)
    vectors, wanted = whole_vectors(rows), whole_vectors(queries)
    sizes = {r.n: [r.rows, 0] for r in vectors.groupBy("n").agg(F.count("*").alias("rows")).collect()}
    for r in wanted.groupBy("n").agg(F.count("*").alias("rows")).collect():
        if r.n in sizes:
            sizes[r.n][1] = r.rows
    parts = None
    for n, (held, asked) in sorted(sizes.items()):
        if not asked:
            continue
        shards, groups = -(-held // SHARD_ROWS), -(-asked // QUERY_ROWS)
        v = vectors.where(F.col("n") == n).select(
            "vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"))
        q = wanted.where(F.col("n") == n).select(
            F.col("vec_id").alias("query_id"), F.col("v").alias("q"),
            F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("home"),
            F.pmod(F.xxhash64("v", "vec_id"), F.lit(groups)).cast("int").alias("part"))
        none = F.lit(float("-inf"))
        if shards > 1:
            at_home = v.groupBy("shard").cogroup(q.select("query_id", "q", F.col("home").alias("shard"), none.alias("kth")).groupBy("shard"))
            ranked = _ranked(at_home.applyInArrow(_search(k), RESULT), k).where(F.col("rank") == k)
            kth = ranked.groupBy("query_id").agg(F.max("score").cast("double").alias("kth"))
            q = q.join(kth, "query_id", "left").withColumn("kth", F.coalesce("kth", none))
        else:
            q = q.withColumn("kth", none)
        spread_v = v.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        spread_q = q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        found = spread_v.groupBy("shard", "part").cogroup(spread_q.groupBy("shard", "part")).applyInArrow(_search(k), RESULT)
        parts = found if parts is None else parts.unionAll(found)
    if parts is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _ranked(parts, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
