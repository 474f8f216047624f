"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, large, word_count

#: Words of a shard of one source, the largest group that one task orders, and of a block.
SHARD_WORDS, BLOCK_WORDS = 1_000_000, 64
#: A table of so many sources is small enough to broadcast.
BROADCAST_SOURCES = 100_000
#: Copies of a repeated row that one row of an intermediate table stands for at most.
COPIES = 4096


def capped_targets(sizes: list[int], weights: list[int], share: Fraction) -> list[Fraction]:
    """Shares of share * sum(sizes) by weight, each at most twice its size, the excess reshared until none is above."""
    left, open_, out = share * sum(sizes), set(range(len(sizes))), [Fraction(0)] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / total > 2 * sizes[i]}
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = Fraction(2 * sizes[i])
            left -= out[i]
        open_ -= over
    return out


def sainte_lague(weights: list, seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients weight / (2 k + 1), no party above its most; ties go to the earlier party.

    A divisor found by bisection hands out almost all seats at once, the rest go one by one.
    """
    import numpy as np

    w, cap = np.array([float(x) for x in weights]), np.array(most, np.int64)
    seats = min(seats, int(cap[w > 0].sum())) if len(w) else 0
    if seats <= 0:
        return [0] * len(w)

    def at(divisor: float):
        return np.minimum(cap, np.minimum(w / divisor + 0.5, 2.0**62).astype(np.int64))

    low, high = 0.0, 2.5 * float(w.sum())  # at high nobody has a seat
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if middle > 0 and at(middle).sum() <= seats else (middle, high)
    # seats near the divisor go by exact quotients, where equal ones count as equal
    got = at(high * (1 + 1e-9))
    exact = [Fraction(x) for x in weights]
    quotients = [(-exact[i] / (2 * int(got[i]) + 1), i) for i in np.flatnonzero((got < cap) & (w > 0)).tolist()]
    heapq.heapify(quotients)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(quotients)
        got[i] += 1
        if got[i] < cap[i]:
            heapq.heappush(quotients, (-exact[i] / (2 * int(got[i]) + 1), i))
    return got.tolist()


def _quotas(cells: DataFrame, keys: list[str], part: str, seats: str, quota: str) -> DataFrame:
    """cells with the column quota: the seats of each group of keys over its parts, by highest quotients of `cell`, at most `most` each.

    A group is ordered in one task; callers bound the number of its parts.
    """
    from pyspark.sql import types as T

    def run(rows):
        rows = rows.sort_values(part)
        got = sainte_lague(rows["cell"].tolist(), int(rows[seats].iloc[0]), rows["most"].tolist())
        return rows.assign(**{quota: got})

    return cells.groupBy(*keys).applyInPandas(run, T.StructType([*cells.schema.fields, T.StructField(quota, T.LongType())]))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2), seed: int = 9, block: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row.

    Sources in code point order, null last, take the weights in turn and share the given part of all words. Each
    source's rows go by a seeded hash of id, text and number among equal rows into shards; a shard's rows, in seeded order, are cut into blocks of equally many
    words, `block` each as nearly as the shard divides. Sources get blocks by highest quotients, then each source's groups of shards do, then each group's shards, which gives an integer quota per
    shard; a quota above the shard's blocks takes every block once and the rest again. Which blocks those are
    is drawn by a seeded hash. taken sums a row's words over its blocks' times and is at most twice its size.

    Repeated rows stand side by side as single rows of their own, in an order without meaning: swapping equal rows changes
    no result. Null ids are told apart by their texts. Null texts have size 0 and are never taken; a long text takes part in as many blocks as it spans. An empty table gives no rows. Extra columns are ignored, whatever their names.
    One row per source passes through the driver, nothing that grows with the rows.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("hash"))
    sized = keep(sized, "sizes")
    spark = docs.sparkSession
    found = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    found = sorted(((r["source"], r["n"] or 0) for r in found), key=lambda x: (x[0] is None, (x[0] or "").encode()))
    sizes = [n for _, n in found]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share)
    seats = sainte_lague(targets, round(sum(targets) / block), [2 * max(1, round(n / block)) if n else 0 for n in sizes])
    shards = [max(1, -(-n // SHARD_WORDS)) for n in sizes]
    table = spark.createDataFrame(
        [(s, n, float(t), q, k, math.isqrt(k - 1) + 1) for (s, n), t, q, k in zip(found, targets, seats, shards)],
        "source string, source_size long, target double, seats long, shards long, sets long",
    )
    side = F.broadcast(table) if len(found) <= BROADCAST_SOURCES else large(table)
    # equal rows as one, then as rows of their own again: they spread over shards, whatever their number
    equal = sized.groupBy("doc_id", "source", "size", "hash").agg(F.count("*").alias("copies"))
    some = equal.withColumn("k", F.explode(F.expr(f"sequence(0, (copies - 1) div {COPIES})")))
    each = some.withColumn("copy", F.explode(F.expr(f"sequence(k * {COPIES}, least(copies, (k + 1) * {COPIES}) - 1)"))).drop("k", "copies")
    parts = each.join(side, each["source"].eqNullSafe(table["source"])).drop(table["source"])
    drawn = lambda n: F.xxhash64("doc_id", "hash", "copy", F.lit(n))
    parts = parts.withColumn("order", drawn(seed)).withColumn("shard", F.pmod(drawn(seed + 1), F.col("shards")))
    cells = parts.where("size > 0").groupBy("source", "shard").agg(F.sum("size").alias("cell"), F.first("seats").alias("seats"), F.first("sets").alias("sets"))
    cells = cells.withColumn("blocks", F.expr(f"greatest(1L, cast(round(cell / {block}) as long))")).withColumn("most", F.expr("2 * blocks")).withColumn("set", F.expr("shard % sets"))
    cells = keep(cells.drop("sets"), "cells")
    # about as many sets of shards as shards in a set: groups of some thousands at 100 TB
    sets = cells.groupBy("source", "set").agg(F.sum("cell").alias("cell"), F.sum("most").alias("most"), F.first("seats").alias("seats"))
    sets = _quotas(sets, ["source"], "set", "seats", "own").select(F.col("source").alias("s"), F.col("set").alias("t"), "own")
    cells = cells.join(sets, cells["source"].eqNullSafe(sets["s"]) & (cells["set"] == sets["t"])).drop("s", "t", "seats")
    cells = _quotas(cells, ["source", "set"], "shard", "own", "quota")
    # the blocks with the smallest hashes stand once more than the others
    hashes = F.expr(f"array_sort(transform(sequence(0L, blocks - 1), b -> xxhash64(b, shard, {seed + 2})))")
    cells = cells.withColumn("more", F.expr("quota % blocks")).withColumn("last", F.when(F.col("more") > 0, F.element_at(hashes, F.col("more").cast("int"))))
    shape = cells.select(F.col("source").alias("s2"), F.col("shard").alias("h2"), "cell", "blocks", F.expr("quota div blocks").alias("times"), "last")
    placed = parts.where("size > 0").withColumn("end", F.expr("sum(size) over (partition by source, shard order by order, doc_id, size, hash, copy rows between unbounded preceding and current row)"))
    placed = placed.withColumn("begin", F.col("end") - F.col("size")).join(shape, placed["source"].eqNullSafe(shape["s2"]) & (placed["shard"] == shape["h2"]))
    upto = "((b + {}) * cell) div blocks"
    part = f"(times + if(xxhash64(b, shard, {seed + 2}) <= last, 1, 0)) * greatest(0L, least(end, {upto.format(1)}) - greatest(begin, {upto.format(0)}))"
    spans = "sequence(greatest(0L, (begin * blocks) div cell - 1), least(blocks - 1, (end * blocks) div cell + 1))"
    full = placed.withColumn("taken", F.expr(f"aggregate({spans}, 0L, (s, b) -> s + {part})"))
    none = parts.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    out = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return full.select(out).union(none.select(out))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", draw: int | None = None, **options) -> DataFrame:
    """The rows of docs as the mix repeats them, 0 to 2 times.

    With a seed to draw by, a row's expected number is taken / size, for documents of any length: along a shard's documents by
    size, then in seeded order, the rest of each rounding goes to the next, from a drawn start. So neighbours in size get
    their words together. Rows that share an id, as null ids do, have the ratio of all of them and a draw of their own by id and text.
    Without one, a row appears as often as half of its words or more were taken, and rows that share an id as often as the one taken
    most; that drops or keeps documents of many blocks together. Columns are those of docs, whatever their names. Rows with a null id follow the same rule.
    Null and empty texts are never taken, an empty table gives no rows.
    """
    taken = mix(docs, id_col, text_col, source_col, **options).where("size > 0").groupBy("doc_id")
    if draw is None:
        times = taken.agg(F.floor(F.max(F.col("taken") / F.col("size")) + F.lit(0.5)).alias("_ratio")).withColumn("_copies", F.col("_ratio"))
    else:
        ids = taken.agg((F.sum("taken") / F.sum("size")).alias("_ratio"), F.count("*").alias("n"), F.min("source").alias("source"), F.max("source_size").alias("all"), F.max("size").alias("size"))
        ids = ids.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(draw + 1)), F.expr(f"(all + {SHARD_WORDS - 1}) div {SHARD_WORDS}")))
        # in units of 2^-32, so that sums are exact
        ids = ids.withColumn("unit", F.expr("cast(round(_ratio * 4294967296D) as long)"))
        upto = F.expr(f"sum(unit) over (partition by source, shard order by size, xxhash64(doc_id, {draw}), doc_id rows between unbounded preceding and current row) + pmod(xxhash64(source, shard, {draw}), 4294967296L)")
        ids = ids.withColumn("upto", upto).withColumn("copies", F.expr("upto div 4294967296L - (upto - unit) div 4294967296L"))
        times = ids.select("doc_id", "_ratio", F.when(F.col("n") == 1, F.col("copies")).alias("_copies"))
    times = times.where("_ratio > 0").withColumnRenamed("doc_id", "_id")
    # the row as one column, so that its names can't clash with others
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), F.xxhash64(docs[id_col], docs[text_col], F.lit(draw)).alias("u"))
    again = rows.join(times, rows["id"].eqNullSafe(times["_id"]))
    own = F.floor(F.col("_ratio") + F.pmod(F.col("u"), F.lit(1 << 32)) / F.lit(float(1 << 32)))
    again = again.withColumn("times", F.coalesce("_copies", own).cast("int")).where("times > 0")
    return again.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
