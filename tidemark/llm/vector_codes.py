"""Vector codes by ball k-means: each of a vector's parts becomes the index of its codebook's nearest entry.

The vectors are stored in blocks with their present codes. A round is one pass over them, without a shuffle of vectors. In a block the members of an entry make a
ball around it, whose radius is the largest distance of a member. Only entries whose distance from it is at most twice the radius can be
nearer to a member: its neighbours. With neighbours in the order of their distance from the entry, a member at distance r has the candidates
within 2 r of the entry: none in the stable core below half the nearest neighbour's distance, where nothing is computed, and one more in each ring around
it. All comparisons are of squared integers, 4 r^2 against the entries' squared distance, so bounds and ties are exact.
A block leaves sums and counts for each entry; their totals, one row an entry, give the next codebooks.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, keep, small
from .vectors import exact, floors, integer_vectors, matrix, packed, saturated, squares, unpacked

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
_BLOCK = "ids array<long>, labels array<string>, data binary, width int, codes binary, sums array<struct<part: int, entry: int, n: long, total: array<decimal(38,0)>>>, compared long"
#: Bytes of a block's numbers at most, but for a single vector.
BLOCK_BYTES = 4 << 20


def nearest(x, code, book):
    """(code, squared distance, distances computed) of the rows of x, from their present entries: exact, ties to the smaller entry."""
    import numpy as np

    x, book = exact(x, book)
    own = squares(x, book[code]) if len(x) else np.zeros(0, np.int64)
    best, where, compared = own.copy(), code.copy(), len(x)
    for entry in np.unique(code).tolist():
        ball = np.flatnonzero(code == entry)
        apart = squares(book, book[entry])
        order = np.argsort(apart, kind="stable")
        order = order[order != entry]
        radius = own[ball].max()
        order = order[apart[order] <= 4 * radius]  # the neighbours
        if not len(order):
            continue
        rings = np.searchsorted(apart[order], 4 * own[ball], "right")
        for k, other in enumerate(order.tolist()):
            some = ball[rings > k]
            if not len(some):
                break
            d = squares(x[some], book[other])
            compared += len(some)
            nearer = (d < best[some]) | ((d == best[some]) & (other < where[some]))
            best[some[nearer]], where[some[nearer]] = d[nearer], other
    return where, best, compared


def _moved(x, code, books):
    """(codes, errors, distances computed) of the rows of x, part by part; errors are lists of whole numbers, one for each part."""
    import numpy as np

    wide, codes, errors, compared = books[0].shape[1], np.zeros(code.shape, np.uint8), [], 0
    for p, book in enumerate(books):
        codes[:, p], error, n = nearest(x[:, p * wide : (p + 1) * wide], code[:, p].astype(np.int64), book)
        errors.append(error)
        compared += n
    return codes, errors, compared


def _row(ids, labels, x, code, books):
    """A block's row after a round with these codebooks."""
    import numpy as np

    codes, _, compared = _moved(x, code, books)
    wide, sums = books[0].shape[1], []
    for p in range(len(books)):
        (values,) = exact(x[:, p * wide : (p + 1) * wide])
        for entry in np.unique(codes[:, p]).tolist():
            members = values[codes[:, p] == entry]
            sums.append({"part": p, "entry": entry, "n": len(members), "total": [Decimal(int(t)) for t in members.sum(0)]})
    data, width = packed(x)
    return {"ids": ids, "labels": labels, "data": data, "width": width, "codes": codes.tobytes(), "sums": sums, "compared": compared}


def _schema():
    import pyarrow as pa

    total = pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.decimal128(38, 0)))])
    return pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("data", pa.binary()), ("width", pa.int32()), ("codes", pa.binary()), ("sums", pa.list_(total)), ("compared", pa.int64())])


def _first_round(rows: DataFrame, books) -> DataFrame:
    """Blocks of rows (id, label, q), whose codes are all 0 before the round."""
    columns = books[0].shape[1] * len(books)
    size = max(1, BLOCK_BYTES // (8 * columns))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                x = matrix(part.column(2), columns)
                yield pa.RecordBatch.from_pylist([_row(part.column(0).to_pylist(), part.column(1).to_pylist(), x, np.zeros((len(x), len(books)), np.uint8), books)], schema=_schema())

    return rows.mapInArrow(run, _BLOCK)


def _blocks(batches, books):
    """(ids, labels, vectors, codes) of each block of Arrow batches."""
    import numpy as np

    for batch in batches:
        for row in range(batch.num_rows):
            ids, labels, data, width, codes = (batch.column(k)[row].as_py() for k in range(5))
            yield ids, labels, unpacked(data, width, books[0].shape[1] * len(books)), np.frombuffer(codes, np.uint8).reshape(-1, len(books))


def _next_round(blocks: DataFrame, books) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for block in _blocks(batches, books):
            yield pa.RecordBatch.from_pylist([_row(*block, books)], schema=_schema())

    return blocks.select("ids", "labels", "data", "width", "codes").mapInArrow(run, _BLOCK)


def _assigned(blocks: DataFrame, books) -> DataFrame:
    """(vec_id, label, code, e) of every vector: the last assignment, e the squared distances of all parts."""

    def run(batches):
        import pyarrow as pa

        for ids, labels, x, code in _blocks(batches, books):
            codes, errors, _ = _moved(x, code, books)
            digits, n = codes.tobytes().hex(), 2 * len(books)
            told = [Decimal(sum(map(int, e))) for e in zip(*errors)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array([digits[k : k + n] for k in range(0, len(digits), n)], pa.string()), pa.array(told, pa.decimal128(38, 0))], names=["vec_id", "label", "code", "e"])

    return blocks.select("ids", "labels", "data", "width", "codes").mapInArrow(run, "vec_id long, label string, code string, e decimal(38,0)")


def _updated(blocks: DataFrame, books):
    """The codebooks after a round: of each entry with parts the componentwise floor of their mean. One row an entry comes to the driver."""
    import numpy as np

    each = blocks.select(F.explode("sums").alias("s")).select("s.part", "s.entry", "s.n", F.posexplode("s.total").alias("k", "t"))
    totals = each.groupBy("part", "entry", "k").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    new = [b.copy() for b in books]
    for r in totals.collect():
        new[r["part"]][r["entry"], r["k"]] = floors([int(r["t"])], r["n"])[0]
    return [np.array(b, np.int64) for b in new]


def compressed(rows: DataFrame, width: int, parts: int, entries: int, rounds: int) -> tuple[DataFrame, list]:
    """(blocks, codebooks) of rows (id, label, q) after the rounds: stored blocks with the codes of the last one, and one array a part."""
    import numpy as np

    wide = max(1, -(-width // parts))
    start = [r["q"] for r in rows.select("id", "q").orderBy(F.asc_nulls_last("id"), "q").limit(entries).collect()]
    first = np.zeros((len(start), wide * parts), np.int64)
    for k, q in enumerate(start):
        first[k, : len(q)] = q
    books = [first[:, p * wide : (p + 1) * wide] for p in range(parts)]
    blocks = keep(_first_round(rows, books), "codes")
    for k in range(rounds):
        books = _updated(blocks, books)
        if k < rounds - 1:
            before, blocks = blocks, keep(_next_round(blocks, books), "codes")
            discard(before)
    return blocks, books


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that isn't null and has no null or non-finite component.

    Components are floor(scale * x); a vector's equal consecutive parts each have a codebook, which starts as that part of the vectors with the smallest
    ids (of equal ids the smaller vector first, null ids last; fewer vectors make fewer entries, at most 256). A round assigns every part to the nearest entry, ties to the
    smaller one, and moves entries to the componentwise floor of their mean; entries without parts stay. After the rounds parts are assigned once more.
    code has two hexadecimal digits for each part, error is the sum of the parts' squared distances, label_error its sum over equal labels, null ones together.

    Vectors shorter than the longest, or than a multiple of the parts, read as followed by zeros. Rows with equal or null ids all stay. Integers beyond 64
    bits, of components or results, become the largest or smallest that fit. An empty table gives no rows; extra columns are ignored, whatever their names.
    """
    from hashlib import sha256

    if not (1 <= entries <= 256 and parts >= 1 and rounds >= 1):
        raise ValueError("a codebook has 1 to 256 entries, and there is a part and a round at least")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), integer_vectors(vectors, scale, vector_col).alias("q")).where("q is not null")
    width = rows.agg(F.max(F.size("q"))).first()[0]
    if width is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.col("id").alias("error"), F.col("id").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    blocks, books = compressed(rows, width, parts, entries, rounds)
    told = sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()
    each = keep(_assigned(blocks, books), "assigned")
    discard(blocks)
    labels = keep(each.groupBy("label").agg(F.sum("e").alias("sum")), "label_errors")
    same = each["label"].eqNullSafe(labels["label"])
    joined = each.join(small(labels, labels.count()), same, "left")
    return joined.select("vec_id", "code", saturated(F.col("e")).alias("error"), saturated(F.col("sum")).alias("label_error"), F.lit(told).alias("codebooks_sha256"))
