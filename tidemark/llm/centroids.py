"""Centroid clustering with zone maps along a space-filling curve.

Vectors are put in the order of a Hilbert curve through their components of greatest variance and cut into blocks, each stored as one row with the
least and the greatest value of every component: its zone. A round reads the blocks. The zone bounds the distance of all of a block's vectors to a
centroid from below and above, and a centroid whose lower bound exceeds another one's upper bound can't be the nearest of any of them. The
other ones, the block's candidates, are compared with its vectors as arrays, exactly. Blocks are narrow: a round moves sums and counts of the
centroids alone, added up in each task first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, keep_told
from .vectors import exact, floors, integer_vectors, matrix, packed, saturated, squares, unpacked

SCALE, WIDTH, CENTROIDS, ROUNDS, SEED = 1024, 64, 8, 10, 3
#: Components that the curve goes through, and bits of each.
CURVE_COMPONENTS, CURVE_BITS = 15, 4
#: Vectors of a block at most, and of a partition on average.
BLOCK, PARTITION = 256, 200_000


def hilbert_keys(x, bits: int):
    """Places of the rows of x, whole numbers of so many bits, on a Hilbert curve; columns times bits may be 63 at most."""
    import numpy as np

    x = x.astype(np.int64).T.copy()
    n, top = len(x), 1 << bits - 1
    # the curve's inverse: undo the exchanges and inversions of each level, then Gray-decode
    q = top
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] ^= np.where(high, p, t)
            x[i] ^= np.where(high, 0, t)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros(x.shape[1], np.int64), top
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> b & 1
    return key


def candidates(low, high, centres):
    """Numbers of the centroids that may be the nearest one of a vector in the zone, ascending."""
    import numpy as np

    low, high, centres = exact(low, high, centres)
    under, over = low[None] - centres, centres - high[None]
    out = np.maximum(np.maximum(under, over), 0)
    far = np.maximum(abs(centres - low[None]), abs(high[None] - centres))
    lower, upper = (out * out).sum(1), (far * far).sum(1)
    return np.flatnonzero(lower <= upper.min())


def assigned(x, low, high, centres):
    """(number of the nearest centroid, squared distance) of the rows of a block, ties to the smaller number; and the number of distances computed."""
    import numpy as np

    some = candidates(low, high, centres)
    x, centres = exact(x, centres)
    d = np.stack([squares(x, centres[c]) for c in some.tolist()])
    best = d.argmin(0)
    return some[best], d[best, np.arange(len(x))], d.size


def _curve(rows: DataFrame) -> tuple[list[int], list[float], list[float]]:
    """The components of greatest variance, and the least and greatest value of each."""
    parts = rows.select(F.posexplode("q").alias("k", "x")).groupBy("k").agg(F.var_pop(F.col("x").cast("double")).alias("v"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    chosen = sorted(parts.collect(), key=lambda r: (-r["v"], r["k"]))[:CURVE_COMPONENTS]
    return [r["k"] for r in chosen], [float(r["lo"]) for r in chosen], [float(r["hi"]) for r in chosen]


def zone_maps(rows: DataFrame, n: int, width: int = WIDTH) -> DataFrame:
    """(ids, data, width, low, high): blocks of rows (id, q) in the order of the curve. Equal places are told apart by where a row was read, so that no partition has them all."""
    where, lo, hi = _curve(rows)

    def keys(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 33
        scale = np.maximum(np.array(hi) - np.array(lo), 1.0)
        for batch in batches:
            x = matrix(batch.column(1), width)[:, where].astype(float)
            cells = np.clip(((x - np.array(lo)) / scale * (1 << CURVE_BITS)).astype(np.int64), 0, (1 << CURVE_BITS) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hilbert_keys(cells, CURVE_BITS)), pa.array(np.arange(at, at + len(x)))], names=["id", "q", "key", "place"])
            at += len(x)

    def blocks(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                x = matrix(part.column(1), width)
                data, size = packed(x)
                yield pa.RecordBatch.from_pydict({"ids": [part.column(0).to_pylist()], "data": [data], "width": pa.array([size], pa.int32()), "low": [x.min(0).tolist()], "high": [x.max(0).tolist()]})

    spark = rows.sparkSession
    parts = max(-(-n // PARTITION), min(spark.sparkContext.defaultParallelism, -(-n // (4 * BLOCK))), 1)
    placed = rows.mapInArrow(keys, "id long, q array<long>, key long, place long")
    placed = placed.repartitionByRange(parts, "key", "place").sortWithinPartitions("key", "place").select("id", "q")
    return keep(placed.mapInArrow(blocks, "ids array<long>, data binary, width int, low array<long>, high array<long>"), "zones")


def _totals(zones: DataFrame, centres):
    """(cluster, n, per component its sum), added up in each task and then over all tasks."""
    width = centres.shape[1]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        counts, sums, compared = [0] * len(centres), [[0] * width for _ in centres], 0
        for batch in batches:
            for row in range(batch.num_rows):
                x = unpacked(batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), width)
                number, _, n = assigned(x, *(np.array(batch.column(k)[row].as_py(), np.int64) for k in (2, 3)), centres)
                compared += n
                (x,) = exact(x)
                for c in np.unique(number).tolist():
                    mine = x[number == c]
                    counts[c] += len(mine)
                    sums[c] = [a + int(b) for a, b in zip(sums[c], mine.sum(0))]
        kinds = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.decimal128(38, 0))), ("compared", pa.int64())])
        rows = [{"cluster": c, "n": counts[c], "total": [Decimal(s) for s in sums[c]], "compared": compared if not c else 0} for c in range(len(centres)) if counts[c] or not c]
        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    each = zones.select("data", "width", "low", "high").mapInArrow(run, "cluster int, n long, total array<decimal(38,0)>, compared long")
    return each.select("cluster", "n", "compared", F.posexplode("total").alias("k", "t")).groupBy("cluster", "k").agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum("compared").alias("compared"))


def _nearest(zones: DataFrame, centres) -> DataFrame:
    """(vec_id, cluster, d) of every vector; d is its squared distance as a decimal."""
    width = centres.shape[1]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                ids, data, size, low, high = (batch.column(k)[row].as_py() for k in range(5))
                number, d, _ = assigned(unpacked(data, size, width), np.array(low, np.int64), np.array(high, np.int64), centres)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(number.astype(np.int32)), pa.array([Decimal(int(x)) for x in d], pa.decimal128(38, 0))], names=["vec_id", "cluster", "d"])

    return zones.select("ids", "data", "width", "low", "high").mapInArrow(run, "vec_id long, cluster int, d decimal(38,0)")


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, width: int = WIDTH, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of exactly `width` components, none null or non-finite.

    Components are floor(scale * x). Centroids start as the vectors with the smallest SHA-256 of `seed:id` in hexadecimal (of equal ids the smaller vector first, null
    ids last; fewer vectors make fewer centroids). A round assigns every vector to the nearest centroid, ties to the smaller number, and moves centroids
    to the componentwise floor of their mean; empty ones stay. After the rounds vectors are assigned once more. distance is squared;
    cluster_inertia and inertia are its sums over the cluster and over all; centroid_sha256 is that of the final centroid's components, with commas.

    Rows with equal or null ids all stay. Integers beyond 64 bits, of components or results, become the largest or smallest that fit. An empty table gives
    no rows; extra columns are ignored, whatever their names.
    """
    import numpy as np
    from hashlib import sha256

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), integer_vectors(vectors, scale, vector_col).alias("q")).where(F.col("q").isNotNull() & (F.size("q") == width))
    n = rows.count()
    if not n:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).alias("cluster"), F.col("id").alias("distance"), F.col("id").alias("cluster_inertia"), F.col("id").alias("inertia"), F.lit("").alias("centroid_sha256"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = rows.orderBy(F.asc_nulls_last(order), "q").limit(centroids).collect()
    centres = np.array([r["q"] for r in start], np.int64)
    zones = zone_maps(rows, n, width)
    for _ in range(rounds):
        moved = centres.copy()
        for r in _totals(zones, centres).where("n > 0").collect():
            moved[r["cluster"], r["k"]] = floors([int(r["t"])], r["n"])[0]
        if (moved == centres).all():
            break  # further rounds would change nothing
        centres = moved
    each, _ = keep_told(_nearest(zones, centres), "clusters", F.count("*"))
    sums = {r["cluster"]: int(r["s"]) for r in each.groupBy("cluster").agg(F.sum("d").alias("s")).collect()}
    told = [(c, Decimal(sums.get(c, 0)), sha256(",".join(str(int(v)) for v in row).encode()).hexdigest()) for c, row in enumerate(centres)]
    names = each.sparkSession.createDataFrame(told, "cluster int, sum decimal(38,0), centroid_sha256 string")
    total = F.lit(Decimal(sum(sums.values()))).cast("decimal(38,0)")
    return each.join(F.broadcast(names), "cluster").select("vec_id", "cluster", saturated(F.col("d")).alias("distance"), saturated(F.col("sum")).alias("cluster_inertia"), saturated(total).alias("inertia"), "centroid_sha256")
