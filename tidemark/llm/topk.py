"""Exact top-k inner products by pivot-table elimination.

Vectors are turned into integers floor(scale * x). Inner products of vectors of any length become distances by one more
component: with R the largest squared length, x' = (x, sqrt(R - |x|^2)) and q' = (q, 0) have
|q' - x'|^2 = |q|^2 + R - 2 q.x, so the largest products are the smallest distances. The pivot table, written once, holds
every row's distances to PIVOTS pivots, which are far apart: each one is the row of a bounded sample that is farthest from those before it. By the triangle
inequality the largest |d(q, p) - d(x, p)| over the pivots is a lower
bound of d(q, x). A query takes the candidates in the order of their bounds, computes exact integer products, and
stops once the bound rules out all that follow, ties included.

Candidates are dealt into blocks of bounded size, each row once. A block's rows come before the queries in one sorted
partition; queries stream by, and each leaves the block's k best, of which the k best of all blocks are the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import equal_runs, keep

PIVOTS, SCALE = 64, 256
#: Rows, those with the smallest hash, from which pivots are chosen on the driver.
SAMPLE = 2_000
#: Rows of a candidate block at most on average, and the least that are worth a block of their own.
CANDIDATES, LEAST = 50_000, 2_000
#: Candidates that a query evaluates first, and by how many times more each further step has.
STEP, GROWTH = 256, 4
#: Share by which a bound may be off through rounding; distances in the table have 24 bits.
SLACK = 1e-6


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, q): floor(scale * x) of each component. Null vectors, and those with a null or non-finite component, are left out.

    A vector shorter than another reads as followed by zeros. Null ids are left out. Components beyond 64 bits become the largest or smallest that fit.
    """
    x = F.col("v").cast("array<double>")
    whole = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null").select("id", x.alias("v"))
    fine = whole.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return fine.select("id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("q"))


def _matrix(column, width: int, kind):
    """The lists of an Arrow column as rows, filled up with zeros."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), kind)
    out[np.arange(width)[None] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def farthest(points, pivots: int):
    """Rows of points that are far apart: the longest, then always the one farthest from those chosen."""
    import numpy as np

    x = points.astype(float)
    nearest, chosen = (x * x).sum(1), []
    for _ in range(min(pivots, len(x))):
        chosen.append(int(nearest.argmax()))
        away = ((x - x[chosen[-1]]) ** 2).sum(1)
        nearest = away if len(chosen) == 1 else np.minimum(nearest, away)
    return points[chosen]


class Pivots:
    """Distances of lifted vectors: candidates and pivots get sqrt(reach - |x|^2) as last component, queries 0."""

    def __init__(self, points, reach: float):
        import numpy as np

        self.points, self.reach = points.astype(float), reach
        self.squares = (self.points**2).sum(1)
        self.lift = np.sqrt(np.maximum(reach - self.squares, 0))

    def of_rows(self, x):
        import numpy as np

        x = x.astype(float)
        xx = (x * x).sum(1)
        lift = np.sqrt(np.maximum(self.reach - xx, 0))
        return np.sqrt(np.maximum(xx[:, None] + self.squares[None] - 2 * x @ self.points.T + (lift[:, None] - self.lift[None]) ** 2, 0)).astype(np.float32)

    def of_query(self, row):
        import numpy as np

        row = row.astype(float)
        return np.sqrt(np.maximum((row * row).sum() + self.reach - 2 * self.points @ row, 0)).astype(np.float32)


class _Block:
    """A block of candidates: ids in order, vectors, and their rows of the pivot table."""

    def __init__(self, ids, x, table):
        import numpy as np

        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.table = ids[order], x[order], table[order]
        self.floats = self.x.astype(float)
        self.longest = float((self.floats**2).sum(1).max()) if len(ids) else 0.0

    def scores(self, part, row):
        """Exact products, beyond 64 bits the largest or smallest long. No sum of a product's terms exceeds the product of lengths."""
        import numpy as np

        most = np.sqrt(self.longest * float((row.astype(float) ** 2).sum()))
        if most < 2.0**52:
            return (self.floats[part] @ row.astype(float)).astype(np.int64)
        if most < 2.0**62:
            return self.x[part] @ row
        exact = self.x[part].astype(object) @ row.astype(object)
        return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in exact], np.int64)

    def best(self, row, mine, far: float, k: int):
        """(ids, scores, evaluated): the k best by score, then id."""
        import numpy as np

        bound = np.abs(self.table - mine[None]).max(1) if len(mine) else np.zeros(len(self.ids), np.float32)
        todo = np.argpartition(bound, STEP - 1)[:STEP] if len(bound) > STEP else np.arange(len(bound))
        ids, best, done, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, STEP
        first = True
        while len(todo):
            part, todo = todo[:step], todo[step:]
            ids, best = np.concatenate([ids, self.ids[part]]), np.concatenate([best, self.scores(part, row)])
            top = np.lexsort((ids, -best.astype(float))) if len(best) and abs(best).max() < 2**52 else np.array(sorted(range(len(best)), key=lambda i: (-int(best[i]), int(ids[i]))), int)
            ids, best = ids[top[:k]], best[top[:k]]
            done, step = done + len(part), step * GROWTH
            limit = (np.sqrt(max(far - 2 * float(best[-1]), 0.0)) if len(best) == k else np.inf) * (1 + SLACK) + SLACK * np.sqrt(far)
            if first:  # only candidates that the first step leaves open are put in order
                first, open_ = False, bound <= limit
                open_[part] = False
                todo = np.flatnonzero(open_)
                todo = todo[np.argsort(bound[todo], kind="stable")]
            elif len(todo) and bound[todo[0]] > limit:
                break
        return ids, best, done


def _search(k: int, pivots: Pivots, width: int):
    """The k best of each block for each query, from a stream in which a block's candidates come before the queries."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        block, parts, now = None, [], None
        for batch in batches:
            cells = batch.column(0).to_numpy()
            for lo, hi in equal_runs(cells):
                if cells[lo] != block:
                    block, parts, now = cells[lo], [], None
                rows = batch.slice(lo, hi - lo)
                n = int(rows.column(1).null_count)  # candidates have no cell of their own row
                if n:
                    own = rows.slice(0, n)
                    parts.append((own.column(2).to_numpy(), _matrix(own.column(3), width, np.int64), _matrix(own.column(4), len(pivots.points), np.float32)))
                if n == hi - lo:
                    continue
                if now is None:
                    now, parts = _Block(*(np.concatenate(c) for c in zip(*parts))) if parts else None, []
                if now is None:
                    continue
                asked, found = rows.slice(n), ([], [], [], [])
                for cell, qid, row in zip(asked.column(1).to_pylist(), asked.column(2).to_pylist(), _matrix(asked.column(3), width, np.int64)):
                    far = float((row.astype(float) ** 2).sum()) + pivots.reach
                    ids, best, done = now.best(row, pivots.of_query(row), far, k + 1)
                    own = np.flatnonzero((ids == qid) & (best == _Block(ids[:1], row[None], np.zeros((1, 0))).scores([0], row)[0])) if cell == block else ids[:0]
                    ids, best = np.delete(ids, own[:1])[:k], np.delete(best, own[:1])[:k]
                    for column, values in zip(found, ([qid] * len(best), ids.tolist(), best.tolist(), [done] * len(best))):
                        column += values
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score", "evaluated"])

    return run


def block_bests(vectors: DataFrame, queries, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, vec_id, score, evaluated): each candidate block's k best for each query, and how many candidates the query evaluated there."""
    import numpy as np

    spark = vectors.sparkSession
    rows = integers(vectors, id_col, vector_col, scale)
    length = F.expr("aggregate(q, 0D, (s, c) -> s + cast(c as double) * c)")
    n, width, reach = rows.agg(F.count("*"), F.max(F.size("q")), F.max(length)).first()
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score"), F.lit(0).cast("long").alias("evaluated"))
    drawn = [r["q"] for r in rows.orderBy(F.xxhash64("q"), "q").limit(SAMPLE).collect()]
    points = np.zeros((len(drawn), width), np.int64)
    for i, v in enumerate(drawn):
        points[i, : len(v)] = v
    table = Pivots(farthest(points, pivots), reach * (1 + 1e-12))

    def distances(batches):
        import pyarrow as pa

        for batch in batches:
            d = table.of_rows(_matrix(batch.column(1), width, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1]), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "q", "d"])

    blocks = max(-(-n // CANDIDATES), min(spark.sparkContext.defaultParallelism, n // LEAST), 1)
    dealt = keep(rows.mapInArrow(distances, "id long, q array<long>, d array<float>").withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")), "vectors")
    own = F.lit(None).cast("int")
    asked = dealt.where(queries).groupBy("id").agg(F.min(F.struct("q", "block")).alias("own"))
    everywhere = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.col("own.block").alias("own"), "id", F.col("own.q").alias("q"), F.lit(None).cast("array<float>").alias("d"))
    both = dealt.select("block", own.alias("own"), "id", "q", "d").union(everywhere)
    # more partitions than blocks, so that few tasks get two of them
    return both.repartition(4 * blocks, "block").sortWithinPartitions("block", F.col("own").isNotNull()).mapInArrow(_search(k, table, width), "query_id long, vec_id long, score long, evaluated long")


def top_k(vectors: DataFrame, queries, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer products among all other rows, ties to the smaller id.

    queries is a condition on the column `id` that picks the query rows. Every row is a candidate but the query's own. Of query rows that share an id the one with the
    smallest components is the query, the others are candidates of it. Fewer rows give fewer ranks, an empty table none. Scores beyond 64 bits become the
    largest or smallest that fit. See integers() for nulls and lengths. Extra columns are ignored, whatever their names.
    """
    near = block_bests(vectors, queries, k, id_col, vector_col, scale, pivots)
    ranked = near.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
