"""Merkle roots over fixed-size chunks of files, and proofs for single chunks.

A leaf's id is H(H(data hash) + H(end offset)), a branch's H(H(left) + H(right) + H(end of the left)), with offsets as
32-byte big-endian numbers; a last node without a partner goes up unchanged. All files' layers are built at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import discard, stored

#: Largest and smallest chunk in bytes.
CHUNK, LEAST = 256 * 1024, 32 * 1024


def digest(x: Column) -> Column:
    return F.unhex(F.sha2(x, 256))


def number(n: Column) -> Column:
    """32 bytes, big-endian."""
    return F.unhex(F.lpad(F.hex(n), 64, "0"))


def cuts(files: DataFrame, n: str, size: int = CHUNK, least: int = LEAST) -> DataFrame:
    """The rows of files, one for each chunk, with pos, start and end; n is the column of their bytes.

    Chunks have the given size; if a remainder would be smaller than the least one, the last two share their bytes, the
    first of them rounded up. A file whose size is a multiple of the chunk size ends with an empty chunk, an empty file has that alone.
    """
    whole, rest = F.expr(f"{n} div {size}"), F.col(n) % size
    # with a balanced end, the last whole chunk and the rest are cut anew
    cut = F.when((whole >= 1) & (rest > 0) & (rest < least), F.expr(f"({size} + {n} % {size} + 1) div 2"))
    rows = files.withColumn("_whole", whole).withColumn("_cut", cut).withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_whole"))))
    start = F.when(F.col("_cut").isNotNull() & (F.col("pos") == F.col("_whole")), (F.col("_whole") - 1) * size + F.col("_cut")).otherwise(F.col("pos") * size)
    end = F.when(F.col("_cut").isNotNull() & (F.col("pos") == F.col("_whole") - 1), F.col("pos") * size + F.col("_cut")).otherwise(F.least((F.col("pos") + 1) * size, F.col(n)))
    return rows.withColumn("start", start).withColumn("end", end).drop("_whole", "_cut")


def chunks(files: DataFrame, by: str = "path", content: str = "content", size: int = CHUNK, least: int = LEAST) -> DataFrame:
    """(by, pos, start, end, data_hash) of each file's chunks, as cuts() has them. Files are values here; sources.files.chunk_hashes() reads them by ranges."""
    rows = cuts(files.select(by, F.col(content).alias("_c"), F.octet_length(content).cast("long").alias("_n")), "_n", size, least)
    return rows.select(by, "pos", "start", "end", F.sha2(F.expr("substring(_c, cast(start + 1 as int), cast(end - start as int))"), 256).alias("data_hash"))


def leaves(found: DataFrame, by: str = "path") -> DataFrame:
    """(by, pos, id, end)"""
    return found.select(by, "pos", digest(F.concat(digest(F.unhex("data_hash")), digest(number(F.col("end"))))).alias("id"), "end")


def parents(layer: DataFrame, by: str = "path") -> DataFrame:
    """The layer above: neighbours by position in twos."""
    pair = layer.groupBy(by, F.expr("pos div 2").alias("pos")).agg(F.min_by(F.struct("id", "end"), "pos").alias("l"), F.max_by(F.struct("id", "end"), "pos").alias("r"), F.count("*").alias("n"))
    both = digest(F.concat(digest(F.col("l.id")), digest(F.col("r.id")), digest(number(F.col("l.end")))))
    return pair.select(by, "pos", F.when(F.col("n") == 1, F.col("l.id")).otherwise(both).alias("id"), F.col("r.end").alias("end"))


def layers(found: DataFrame, by: str = "path") -> list[DataFrame]:
    """All layers from the leaves to the root; as many as the longest file needs. Shorter files' roots go up unchanged.

    Each layer is written once, so that files are read and hashed once whatever is made of them.
    """
    out = [stored(leaves(found, by), "leaves")]
    most = out[0].agg(F.max("pos")).first()[0]
    while most:
        out.append(stored(parents(out[-1], by), "layer"))
        most //= 2
    return out


def roots(found: DataFrame, by: str = "path") -> DataFrame:
    """(by, bytes, root)"""
    return layers(found, by)[-1].select(by, F.col("end").alias("bytes"), F.lower(F.hex("id")).alias("root"))


def proofs(found: DataFrame, by: str = "path") -> DataFrame:
    """(by, pos, start, end, data_hash, proof): proof lists, from the leaf up, (level, sibling, sibling_left, left_end) for levels with a sibling.

    The empty chunk that ends a file of whole chunks has a part in the root but no proof.
    """
    found = stored(found, "chunks")
    walk = found.where("end > start").select(by, "pos", "start", "end", "data_hash", F.array().cast("array<struct<level:int,sibling:string,sibling_left:boolean,left_end:bigint>>").alias("proof"), F.col("pos").alias("_at"))
    for level, layer in enumerate(layers(found, by)[:-1]):
        ends = layer.select(F.col(by).alias("_f"), F.col("pos").alias("_p"), F.col("id").alias("_id"), F.col("end").alias("_end"))
        own = layer.select(F.col(by).alias("_g"), F.col("pos").alias("_q"), F.col("end").alias("_own"))
        step = walk.join(own, (F.col(by) == F.col("_g")) & (F.col("_at") == F.col("_q"))).join(ends, (F.col(by) == F.col("_f")) & (F.col("_at").bitwiseXOR(F.lit(1).cast("long")) == F.col("_p")), "left")
        left = F.col("_p") < F.col("_at")
        here = F.struct(F.lit(level).alias("level"), F.lower(F.hex("_id")).alias("sibling"), left.alias("sibling_left"), F.when(left, F.col("_end")).otherwise(F.col("_own")).alias("left_end"))
        walk = step.select(by, "pos", "start", "end", "data_hash", F.when(F.col("_p").isNull(), F.col("proof")).otherwise(F.concat("proof", F.array(here))).alias("proof"), F.expr("_at div 2").alias("_at"))
    return walk.drop("_at")


def check_proofs(found: DataFrame, known: DataFrame, by: str = "path") -> DataFrame:
    """(by, pos, ok): whether a proof leads from the chunk to the file's known root."""
    start = digest(F.concat(digest(F.unhex("data_hash")), digest(number(F.col("end")))))
    up = F.aggregate("proof", start, lambda node, p: digest(F.concat(digest(F.when(p["sibling_left"], F.unhex(p["sibling"])).otherwise(node)), digest(F.when(p["sibling_left"], node).otherwise(F.unhex(p["sibling"]))), digest(number(p["left_end"])))))
    return found.join(known.select(by, "root"), by).select(by, "pos", (F.lower(F.hex(up)) == F.col("root")).alias("ok"))


class Tree:
    """A stored Merkle tree of files: one table a level, from the leaves up, sorted by (by, pos) so that a few nodes are a few row groups."""

    def __init__(self, found: DataFrame, by: str = "path"):
        # written once: whatever reads chunks later reads this, not the files
        self.by, self.spans = by, stored(found.select(by, "pos", "start", "end", "data_hash"), "spans")
        below = leaves(self.spans, by)
        self.levels, most = [], None
        while most is None or most:
            self.levels.append(stored(below.repartitionByRange(by, "pos").sortWithinPartitions(by, "pos"), "level"))
            most = self.levels[0].agg(F.max("pos")).first()[0] or 0 if most is None else most // 2
            below = parents(self.levels[-1], by)

    def level(self, k: int) -> DataFrame:
        """(by, pos, id, end) of a level; above the root it goes up unchanged."""
        return self.levels[min(k, len(self.levels) - 1)]

    def nodes(self, k: int, wanted: DataFrame, n: int) -> DataFrame:
        """Nodes of a level at wanted (by, pos), of which there are n. Few ones reach the scan as a filter, so that it reads their row groups alone."""
        layer = self.level(k)
        if n <= PUSHED:
            places = [tuple(r) for r in wanted.select(self.by, "pos").collect()]
            layer = layer.where(F.col("pos").isin([p for _, p in places]) & F.col(self.by).isin(list({f for f, _ in places})))
        return layer.join(F.broadcast(wanted) if n <= PUSHED else wanted, [self.by, "pos"], "left_semi")


#: Nodes of a level that are looked up by a filter on the scan.
PUSHED = 1_000


def differences(old: Tree, new: Tree) -> tuple[DataFrame, int]:
    """((by, pos, start, end, change), nodes compared): the chunks that differ between two trees, found from the roots down.

    A level compares only the children of nodes that differ, so what is read grows with the differing chunks times the height, not with the files.
    change is changed, added or removed; start and end are those of the new chunk, of the old one if it is removed. Files of one tree only are added or removed whole.
    """
    by, top = new.by, max(len(old.levels), len(new.levels)) - 1
    both = old.level(top).select(by, "pos").union(new.level(top).select(by, "pos")).distinct()
    open_, compared = stored(both, "open"), 0
    for k in range(top, -1, -1):
        n = open_.count()
        compared += n
        a, b = (t.nodes(k, open_, n).select(by, "pos", F.col("id").alias(c)) for t, c in ((old, "_old"), (new, "_new")))
        met = open_.join(a, [by, "pos"], "left").join(b, [by, "pos"], "left").where(~F.col("_old").eqNullSafe(F.col("_new")))
        differing = stored(met.select(by, "pos", F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed").alias("change")), "differing")
        discard(open_)
        if not k:
            break
        # a node stands for its children; those beyond a file's end are in neither tree and drop out
        children = differing.select(by, F.explode(F.array(F.col("pos") * 2, F.col("pos") * 2 + 1)).alias("pos"))
        open_ = stored(children, "open")
    spans = [t.spans.drop("data_hash").join(differing.where(where), [by, "pos"]) for t, where in ((new, "change <> 'removed'"), (old, "change = 'removed'"))]
    return spans[0].unionByName(spans[1]).select(by, "pos", "start", "end", "change"), compared


def joint_proof(tree: Tree, chosen: DataFrame) -> DataFrame:
    """(by, level, pos, id, left_end): one proof for many chunks (by, pos) together: the nodes beside their paths to the root that the chunks don't give themselves.

    id is hexadecimal. left_end is the end of the left one of each two nodes that are joined on the way, whether it is beside the path or on it; the
    nodes on it have a null id.
    """
    by, out = tree.by, []
    here = chosen.select(by, "pos").distinct()
    for k in range(len(tree.levels) - 1):
        here = stored(here, "paths")
        n = here.count()
        pairs = here.select(by, F.explode(F.array("pos", F.col("pos").bitwiseXOR(F.lit(1).cast("long")))).alias("pos")).distinct()
        found = tree.nodes(k, pairs, 2 * n).join(here.withColumn("_on", F.lit(True)), [by, "pos"], "left")
        out.append(found.select(by, F.lit(k).alias("level"), "pos", F.when(F.col("_on").isNull(), F.lower(F.hex("id"))).alias("id"), F.col("end").alias("left_end")).where("id is not null or pos % 2 = 0"))
        here = here.select(by, F.expr("pos div 2").alias("pos")).distinct()
    return reduce(DataFrame.union, out) if out else chosen.select(by, F.lit(0).alias("level"), "pos", F.lit("").alias("id"), F.col("pos").alias("left_end")).where("1 = 0")


def check_joint_proof(found: DataFrame, proof: DataFrame, known: DataFrame, by: str = "path") -> DataFrame:
    """(by, ok): whether the chunks (by, pos, end, data_hash) and their proof lead to each file's known root."""
    here = found.select(by, "pos", digest(F.concat(digest(F.unhex("data_hash")), digest(number(F.col("end"))))).alias("id"))
    proof = stored(proof, "proof")
    for k in range((proof.agg(F.max("level")).first()[0] or 0) + 1 if not proof.isEmpty() else 0):
        level = proof.where(F.col("level") == k)
        beside = level.where("id is not null").select(by, "pos", F.unhex("id").alias("id"))
        pair = here.unionByName(beside).groupBy(by, F.expr("pos div 2").alias("up")).agg(F.min_by("id", "pos").alias("l"), F.max_by("id", "pos").alias("r"), F.count("*").alias("n"))
        ends = level.where("pos % 2 = 0").select(by, F.expr("pos div 2").alias("up"), "left_end")
        both = digest(F.concat(digest(F.col("l")), digest(F.col("r")), digest(number(F.col("left_end")))))
        here = stored(pair.join(ends, [by, "up"], "left").select(by, F.col("up").alias("pos"), F.when(F.col("n") == 1, F.col("l")).otherwise(both).alias("id")), "above")
    return here.join(known.select(by, "root"), by).select(by, F.coalesce(F.lower(F.hex("id")) == F.col("root"), F.lit(False)).alias("ok"))
