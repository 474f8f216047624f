"""SimHash near-duplicate groups through a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 16 segments of 4 bits. The Manhattan distance of two such
vectors is never above the Hamming distance of the fingerprints, so a range join of the vectors on a grid of unit
cells finds every pair within the radius: vectors at distance 2 or less have a cell within 1 of both. What
shares a cell is then verified bit by bit.

A cell of up to FEW fingerprints compares its pairs. In a fuller one, as the variants of a widely copied text make it,
pairs aren't formed: there fingerprints are linked through the points that differ from them in at most one bit. Two
fingerprints share such a point exactly if they differ in at most two bits, so rows grow with the number of
fingerprints and no link is lost.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import similar
from .common import keep, large, majority, small, text_bytes
from .components import connected_components

SEGMENT_MASKS = (0x5555555555555555, 0x3333333333333333)
#: Fingerprints of a cell whose pairs are compared one by one.
FEW = 16
#: XXH64 seed of a shingle's hash.
SEED = 42


def simhash(words: list[bytes], shingle: int = 3) -> int:
    """The unsigned fingerprint: a bit is 1 if it is set in over half of the shingles' hashes; no words: 0."""
    import numpy as np
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, n)
    return majority(hashes)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) of every row: fp is the fingerprint as a signed long. Null texts count as empty."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = np.array([simhash(t.lower().split(), shingle) for t in text_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(run, "id long, fp long")


def popcount_vector(fp):
    """16 bit counts of 4-bit segments, each in 4 bits of a long. Pairs are added bit by bit, as a long has a sign."""
    low, pair = (F.lit(m).cast("long") for m in SEGMENT_MASKS)
    a, b = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    x = a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))
    return x.bitwiseAND(pair) + F.shiftrightunsigned(x, 2).bitwiseAND(pair)


def _cells(fps: DataFrame) -> DataFrame:
    """(cell, fp): the unit cells within Manhattan distance 1 of each vector, counts outside 0..4 left out."""
    z = F.col("z")
    moves = [z]
    for k in range(16):
        one, at = F.lit(1 << (4 * k) if k < 15 else (1 << 60)).cast("long"), F.shiftrightunsigned(z, 4 * k).bitwiseAND(F.lit(15).cast("long"))
        moves += [F.when(at < 4, z + one), F.when(at > 0, z - one)]
    cells = fps.select("fp", popcount_vector(F.col("fp")).alias("z"))
    return cells.select("fp", F.explode(F.array(*moves)).alias("cell")).where("cell is not null")


def links(fps: DataFrame, made: list | None = None) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints of fps (column fp) differing in at most 2 bits. The table they read is appended to `made`."""
    cells = large(_cells(fps))
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    near = keep(cells.join(shared, "cell"), "cells")
    if made is not None:
        made.append(near)
    few = near.where(F.col("n") <= FEW).groupBy("cell").agg(F.collect_list("fp").alias("fps"))
    found = few.select(F.explode(F.expr("flatten(transform(fps, a -> transform(filter(fps, b -> b < a and bit_count(a ^ b) <= 2), b -> struct(a, b))))")).alias("l")).select("l.a", "l.b")

    flips = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(b if b < 1 << 63 else b - (1 << 64)).cast("long")) for b in (1 << k for k in range(64))]]
    points = large(near.where(F.col("n") > FEW).select("fp").distinct().select("fp", F.explode(F.array(*flips)).alias("point")))
    hubs = points.groupBy("point").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1").select("point", "hub")
    pairs = points.join(hubs, "point").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return found.union(pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row: rows whose fingerprints link directly or through others share a component.

    Fingerprints are those of the lower-cased (A-Z) words' shingles; two link if they differ in 2 bits or fewer.
    component_id is the smallest id of the component. Null or empty texts have fingerprint 0, linked like any other.
    Repeated rows stay. A null id stays and lends its component no name; a group of null ids alone has a null name.
    Long texts count whole. Extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    marked = keep(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    named = keep(marked.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    ab = links(named.select("fp"))
    groups = connected_components(ab.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = named.join(groups, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    names = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(names, "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int | None = None, similarity: Fraction | None = None) -> DataFrame:
    """The rows of docs that stay when one document of each group is kept: the one with the smallest id.

    Groups are those of near_duplicates (shingles of 3 words by default) or, if a similarity is given, of similar_groups (5 words).
    Null and empty texts are one group, long texts count whole. Rows with a null id stay. Of rows that repeat both id and text one stays.
    Columns are those of docs, whatever their names; an empty table gives an empty one.
    """
    if similarity is None:
        groups = keep(near_duplicates(docs, id_col, text_col, shingle or 3), "groups")
    else:
        groups = similar.similar_groups(docs, id_col, text_col, shingle or 5, similarity)
    ids = groups.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n"))
    gone = ids.where(~F.col("stays")).select(F.col("doc_id").alias("_gone"))
    repeats, leave = ids.agg(F.count_if(F.col("n") > 1), F.count_if(~F.col("stays"))).first()
    kept = docs.join(small(gone, leave), docs[id_col].cast("long") == gone["_gone"], "left_anti")
    return kept.dropDuplicates([id_col, text_col]) if repeats else kept
