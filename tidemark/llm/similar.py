"""Groups of texts by the Jaccard similarity of their shingles: SimHash links of near_dedup first, each decided exactly, an exact join by prefixes for what they leave apart, connected components.

A text's 64-bit SimHash is that of its shingles. near_dedup.links finds through segment popcounts and grid cells which fingerprints differ in at most 2 bits; texts of equal or
linked fingerprints are decided on their whole sets and connected. At a similarity of 0.8 fingerprints differ in some 10 bits, where no grid is selective, so the texts that these links leave apart meet by prefixes.

A text is the set of the hashes of its shingles, n of them. At similarity p / q two sets share a shingle among the first
n - ceil(p n / q) + 1 of each in any order that all sets use, so only those meet in a join on the shingle. The order puts
shingles that are common in a sample of the texts last; a bad sample costs time, no result. The first shingle that two
sets share, at places i and j of their orders, leaves them at most min(n - i, m - j) to share, which drops most of what met.

What remains is bounded from below before any set is moved: a text's vector counts its shingles in PARTS parts of the
hash space, and the Manhattan distance of two vectors is never above the number of shingles that only one of the two
texts has. Nor is the Hamming distance of their sketches, fingerprints of BITS bits each of which is the parity of the shingles that fall on it. Pairs beyond
the distance that the similarity allows go; every other pair is decided on the whole sets. Sketches tell short texts apart, vectors long ones.

Each text is decided first against one other, the hub of the early shingle that most texts share with it, together with the links of fingerprints. Then a shingle of up to FEW texts gives its pairs of texts in different components, one of more, as the
variants of a widely copied text have it, a star around a text drawn for the shingle, and in the end its pairs of texts that are still in different components.
A pair within a component can't change a group, so none is lost. Of such a pair the smaller text must have the shingle
among its first (q - p) / (p + q) n ones (a ninth at 0.8), where a shingle of many texts, which the order puts last, hardly ever stands.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_dedup
from .common import discard, keep, keep_told, large, majority, small, text_bytes
from .components import connected_components

#: Texts of a shingle whose pairs are formed at once, and the rounds of stars for the others.
FEW, ROUNDS = 16, 1
#: The sample that tells which shingles are common is an eighth of the texts, or so many; common is what so many of them have, and so many are kept.
LEAST_SAMPLE, LEAST, COMMON = 4000, 3, 200_000
#: Parts of a text's vector, a power of two. A count beyond 255 reads as 255, which makes no distance larger.
PARTS = 64
#: Bits of a text's sketch, a multiple of 64 and a power of two.
BITS = 1024
#: Texts of a batch whose sets are in memory at once, and their bytes, but for a longer text alone.
SLICE, SLICE_BYTES = 250, 1 << 20
#: Shingles of prefixes that a task sorts and counts on average.
KEYS_A_TASK = 150_000
_P = 0x9E3779B97F4A7C15


def shingle_hashes(words: list[bytes], shingle: int):
    """The distinct shingles' hashes, sorted; fewer words than a shingle are one."""
    import numpy as np
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(_P) + w[i : i + n]
    h ^= h >> np.uint64(29)
    return np.unique(h * np.uint64(0xBF58476D1CE4E5B9))


def _slices(batches):
    """(ids, texts) of some rows (id, text) at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            texts, start, size = text_bytes(part.column(1)), 0, 0
            for i, t in enumerate(texts):
                if i > start and size + len(t) > SLICE_BYTES:
                    yield part.column(0).slice(start, i - start), texts[start:i]
                    start, size = i, 0
                size += len(t)
            yield part.column(0).slice(start), texts[start:]


def _told(text: bytes) -> tuple[int, list[bytes]]:
    """A text's class, the hash of its lower-cased words as a signed long, and the words. They take many times the text's memory, so they are let go before the next text."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    h = xxh64_intdigest(b" ".join(words))
    return h - (h >> 63 << 64), words


def _lists(values, sizes):
    import numpy as np
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _marked(rows: DataFrame, shingle: int) -> DataFrame:
    """(id, cls, n, vec, fp, bits) of rows (id, t): n is the size of the set, vec its counts by part, fp its SimHash, bits its sketch."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for ids, texts in _slices(batches):
            cls, sets = [], []
            for c, words in map(_told, texts):
                cls.append(c)
                sets.append(shingle_hashes(words, shingle))
            n = np.array([len(s) for s in sets], np.int64)
            every, row = np.concatenate([np.zeros(0, np.uint64), *sets]), np.repeat(np.arange(len(n)), n)
            part = every >> np.uint64(64 - PARTS.bit_length() + 1)
            counts = np.bincount(row * PARTS + part.astype(np.int64), minlength=PARTS * len(n))
            vec = _lists(np.minimum(counts, 255).astype(np.int16), np.full(len(n), PARTS))
            odd = np.bincount(row * BITS + (every & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS * len(n)).astype(np.uint8) & 1
            bits = _lists(np.packbits(odd, bitorder="little").view(np.int64), np.full(len(n), BITS // 64))
            fps = np.array([majority(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cls, pa.int64()), pa.array(n.astype(np.int32)), vec, pa.array(fps), bits], names=["id", "cls", "n", "vec", "fp", "bits"])

    return rows.mapInArrow(run, "id long, cls long, n int, vec array<smallint>, fp long, bits array<long>")


def _sets(rows: DataFrame, shingle: int, p: int = 0, q: int = 1, common=()) -> DataFrame:
    """(cls, n, h) of the texts of rows (id, t), a text once for each task: h is the set and n its size.

    With p / q, h is only what a set of that similarity or more shares one shingle of, in order; common ones come last, the most common at the end.
    """
    import numpy as np

    known = np.array(common, np.int64)
    by = np.argsort(known)
    side = rows.sparkSession.sparkContext.broadcast((known[by], len(known) - by))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known, late = side.value
        seen: set[int] = set()
        for _, texts in _slices(batches):
            if len(seen) > 1_000_000:
                seen.clear()
            new, sets = [], []
            for c, words in map(_told, texts):
                if c not in seen:
                    seen.add(c)
                    new.append(c)
                    sets.append(shingle_hashes(words, shingle))
            n = np.array([len(s) for s in sets], np.int64)
            h, kept = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64), n
            if p:
                row, rank = np.repeat(np.arange(len(n)), n), np.zeros(len(h), np.int64)
                if len(known) and len(h):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    rank = np.where(known[at] == h, late[at], 0)
                kept = np.where(n > 0, n - (-(-n * p // q)) + 1, 0)
                h = h[np.lexsort((h, rank, row))][np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n) < kept[row]]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.int64()), pa.array(n.astype(np.int32)), _lists(h, kept)], names=["cls", "n", "h"])

    return rows.mapInArrow(run, "cls long, n int, h array<long>")


class _Join:
    """The pairs of texts that are similar, decided step by step; tables it has written are in `made`."""

    def __init__(self, rows: DataFrame, shingle: int, similarity: Fraction):
        self.rows, self.shingle, self.p, self.q, self.made = rows, shingle, similarity.numerator, similarity.denominator, []
        marked, (self.places,) = keep_told(_marked(rows, shingle), "marked", F.sum(F.expr(f"n - (n * {self.p} + {self.q - 1}) div {self.q} + 1")))
        self.made.append(marked)
        self.marked = marked.select("id", "cls")
        self.texts, (self.count,) = keep_told(marked.groupBy("cls").agg(F.min("id").alias("first"), *[F.first(c).alias(c) for c in ("n", "vec", "fp", "bits")]), "texts", F.count("*"))
        self.made.append(self.texts)
        self.links = None
        self.roots = self.texts.where("1 = 0").select("cls", F.col("cls").alias("root"))

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.made.append(keep(df, name))
        return self.made[-1]

    def may(self, x: str, y: str) -> str:
        """True unless sizes or the places of a shared shingle rule a pair out; `at` holds a size and, lowest, a place."""
        p, q = self.p, self.q
        (n, i), (m, j) = ((f"({s}.at >> 32)", f"({s}.at & 4294967295)") for s in (x, y))
        return f"least({n}, {m}) * {q} >= greatest({n}, {m}) * {p} and least({n} - {i}, {m} - {j}) * {p + q} >= ({n} + {m}) * {p}"

    def near(self, x: str, y: str) -> str:
        """True unless the Hamming distance of the sketches or the Manhattan distance of the vectors is beyond what the similarity allows."""
        most = f"(({x}.at >> 32) + ({y}.at >> 32)) * {self.q - self.p}"
        differ = " + ".join(f"bit_count({x}.bits[{k}] ^ {y}.bits[{k}])" for k in range(BITS // 64))
        far = f"aggregate(zip_with({x}.vec, {y}.vec, (a, b) -> abs(cast(a as int) - b)), 0, (s, v) -> s + v)"
        return f"({differ}) * {self.p + self.q} <= {most} and {far} * {self.p + self.q} <= {most}"

    def keys(self) -> DataFrame:
        """(key, cls, at, m): the shingles of prefixes that m > 1 texts have there."""
        import numpy as np

        rows = self.rows
        share = min(1, max(1 / 8, LEAST_SAMPLE / max(1, rows.count())))
        drawn = rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(1 << 20)) < int((1 << 20) * share))
        counts = _sets(drawn, self.shingle).select(F.explode("h").alias("key")).groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") >= LEAST)
        # written first: a limit that is collected sends so many rows of every task through the driver
        self.made.append(keep(counts.orderBy(F.desc("c"), "key").limit(COMMON), "common"))
        known = self.made[-1].toArrow()
        common = known.column("key").to_numpy()[np.lexsort((known.column("key").to_numpy(), -known.column("c").to_numpy()))]
        found = _sets(rows, self.shingle, self.p, self.q, common).select("cls", "n", F.posexplode("h").alias("i", "key"))
        found = found.select("key", "cls", F.expr("shiftleft(cast(n as long), 32) + i").alias("at")).repartition(max(1, -(-(self.places or 0) // KEYS_A_TASK)), "key").groupBy("key", "cls").agg(F.min("at").alias("at"))
        return self.keep(found.withColumn("m", F.expr("count(*) over (partition by key)")).where("m > 1"), "keys")

    def marks(self) -> DataFrame:
        """(a, b): texts of equal fingerprints with one of them, and one each of fingerprints that differ in at most 2 bits. Their number grows with that of texts."""
        named = self.keep(self.texts.groupBy("fp").agg(F.min("cls").alias("hub")), "fingerprints")
        equal = self.texts.join(named, "fp").where("cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b"))
        ends = [named.select(F.col("fp").alias(s), F.col("hub").alias(f"h{s}")) for s in "ab"]
        linked = near_dedup.links(named.select("fp"), self.made).join(ends[0], "a").join(ends[1], "b")
        return equal.union(linked.select("ha", "hb"))

    def close(self, pairs: DataFrame) -> DataFrame:
        """The pairs a < b whose sketches and vectors are within the distance."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        for s in "ab":
            pairs = pairs.join(self.texts.select(F.col("cls").alias(s), *[F.col(c).alias(c[0] + s) for c in ("n", "vec", "bits")]), s)
        p, q = self.p, self.q

        def within(batches):
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                va, vb = (batch.column(k).flatten().to_numpy().reshape(-1, PARTS) for k in (4, 5))
                ba, bb = (batch.column(k).flatten().to_numpy().reshape(-1, BITS // 64) for k in (6, 7))
                n = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
                far = np.maximum(np.abs(va - vb).sum(1), np.bitwise_count((ba ^ bb).view(np.uint64)).sum(1, dtype=np.int64))
                yield batch.select(["a", "b"]).filter(pa.array(far * (p + q) <= n * (q - p)))

        return pairs.select("a", "b", "na", "nb", "va", "vb", "ba", "bb").mapInArrow(within, "a long, b long")

    def alike(self, pairs: DataFrame, count: int) -> DataFrame:
        """The pairs (a, b), at most count of them, whose sets have the similarity or more."""
        wanted, n = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct(), 2 * count
        first = self.texts.join(small(wanted, n), "cls", "left_semi").select("first")
        here = self.rows.join(small(first, n), F.col("id").eqNullSafe(F.col("first")), "left_semi")
        sets = self.keep(_sets(here, self.shingle).join(small(wanted, n), "cls", "left_semi").dropDuplicates(["cls"]), "sets")
        both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("h").alias("ha")), "a").join(sets.select(F.col("cls").alias("b"), F.col("h").alias("hb")), "b")
        shared = F.size(F.array_intersect("ha", "hb"))
        return self.keep(both.where(shared * (self.p + self.q) >= (F.size("ha") + F.size("hb")) * self.p).select("a", "b"), "alike")

    def link(self, pairs: DataFrame, one_each: bool = False, near: bool = False) -> None:
        """Decide the pairs (a, b) and connect what is alike: each text with one other first, then what that left apart. With one_each, or if no more pairs than texts are close, all at once. With near() pairs that passed it are a < b, each once.

        Every step is a plan of many exchanges, each of which costs the driver threads and memory whatever its rows, so there are no more of them than the pairs need.
        """
        close, (n,) = keep_told(pairs if near else self.close(pairs), "close", F.count("*"))
        self.made.append(close)
        if not n:
            return
        one_each = one_each or n <= self.count
        self.add(self.alike(close if one_each else close.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), n))
        if one_each:
            return
        ends = [self.roots.select(F.col("cls").alias(s), F.col("root").alias(f"r{s}")) for s in "ab"]
        apart = close.join(ends[0], "a", "left").join(ends[1], "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")
        apart, (n,) = keep_told(apart, "apart", F.count("*"))
        self.made.append(apart)
        if n:
            self.add(self.alike(apart, n))

    def add(self, links: DataFrame) -> None:
        """Connect what the links (a, b) join. Only the names of components so far meet, so later links need few rounds; the smallest class names a component as if all links were connected at once."""
        self.links = links if self.links is None else self.links.union(links)
        ends = [self.roots.select(F.col("cls").alias(s), F.col("root").alias(f"r{s}")) for s in "ab"]
        over = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("ra", "a").alias("u"), F.coalesce("rb", "b").alias("v"))
        found = connected_components(over, self.made)
        moved = self.roots.join(found, F.col("root") == F.col("node"), "left").select("cls", F.coalesce("component", "root").alias("root"))
        fresh = found.join(self.roots, F.col("node") == F.col("cls"), "left_anti").select(F.col("node").alias("cls"), F.col("component").alias("root"))
        self.roots = self.keep(moved.union(fresh), "roots")

    def run(self) -> DataFrame:
        """(id, component) of every row."""
        keys = self.keys()
        early = f"({{}} & 4294967295) * {self.p + self.q} <= ({{}} >> 32) * {self.q - self.p}"
        # each text with one other, so that the variants of one text meet without their pairs: by the one of its early shingles that most texts have
        mine = keys.where(early.format("at", "at")).groupBy("cls").agg(F.max_by(F.struct("key", "at"), F.struct("m", "key")).alias("k")).select("k.key", F.struct("cls", "k.at").alias("x"))
        hubs = mine.groupBy("key").agg(F.min_by("x", F.xxhash64("x.cls")).alias("y"))
        met = mine.join(hubs, "key").where(f"x.cls <> y.cls and {self.may('x', 'y')}").select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
        self.link(self.marks().union(met), True)
        for step in range(ROUNDS + 1):
            here = keys.join(self.roots, "cls", "left").select("key", "cls", "at", "m", F.coalesce("root", "cls").alias("root"))
            open_ = here.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
            # after the first step the pairs of small keys have all been decided
            here, (left,) = keep_told(here.join(open_, "key").where(F.lit(not step) | (F.col("m") > FEW)), "open", F.count("*"))
            self.made.append(here)
            if not left:
                break
            many = here.where(F.col("m") > FEW)
            # a text's shingles in order, so that a pair is formed at the first one it shares alone
            ordered = F.transform(F.array_sort(F.collect_list(F.struct((F.col("at").bitwiseAND(F.lit((1 << 32) - 1))).alias("i"), "key"))), lambda k: k["key"])
            if step == ROUNDS:
                many = large(many).join(many.groupBy("cls").agg(ordered.alias("keys")), "cls").join(large(self.texts.select("cls", "vec", "bits")), "cls")
            else:
                many = many.withColumns({"keys": F.lit(None).cast("array<long>"), "vec": F.lit(None).cast("array<smallint>"), "bits": F.lit(None).cast("array<long>")})
            x, y = (many.select("key", F.struct("cls", "at", "root", "keys", "vec", "bits").alias(s)) for s in "xy")
            y = y.where(early.format("y.at", "y.at"))
            fits = f"x.root <> y.root and {self.may('x', 'y')}"
            if step < ROUNDS:
                y = y.groupBy("key").agg(F.min_by("y", F.xxhash64("y.cls", F.lit(step))).alias("y"))
            # the last step forms whatever pairs the stars left apart, each once
            # also where both have its first shingle early; and only those within the distance leave the join
            one_way = f"(x.cls < y.cls or not ({early.format('x.at', 'x.at')}))"
            once = f"{one_way} and {self.near('x', 'y')} and key = element_at(array_intersect(x.keys, y.keys), 1)" if step == ROUNDS else "true"
            met = large(x).join(y, "key").where(f"{fits} and {once}").select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))
            if not step:
                few = here.where(F.col("m") <= FEW).groupBy("key").agg(F.collect_list(F.struct("cls", "at", "root")).alias("l"))
                pairs = few.select(F.explode(F.expr(f"flatten(transform(l, x -> transform(filter(l, y -> y.cls < x.cls and {fits}), y -> struct(x.cls as a, y.cls as b))))")).alias("e")).select("e.a", "e.b")
                met = pairs.union(met)
            self.link(met, near=bool(step) and step == ROUNDS)
        rooted = self.texts.select("cls", "first").join(self.roots, "cls", "left").select("cls", "first", F.coalesce("root", "cls").alias("root"))
        least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
        names = rooted.join(least, "root").select("cls", "component_id")
        return self.marked.join(names, "cls").select(F.col("id").alias("doc_id"), "component_id")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: Fraction = Fraction(4, 5)) -> DataFrame:
    """(doc_id, component_id) of every row: rows that are similar directly or through others share a component.

    Two texts are similar if the sets of their lower-cased (A-Z) words' shingles have the Jaccard similarity or more; fewer
    words than a shingle are one shingle. component_id is the smallest id of the component. Null and empty texts
    are one group. Repeated rows stay. A null id stays and lends its component no name. Long texts count whole. Extra columns
    are ignored, whatever their names; an empty table gives no rows. Texts are told apart by a 64-bit hash.
    """
    join = _Join(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")), shingle, similarity)
    groups = keep(join.run(), "similar")
    discard(*join.made)
    return groups
